"""Main text of web pages from flat text blocks and a decision tree.

A page is read once into text blocks, cut at block-level tags.  A block has its
words and link density, those of its neighbours, whether it lies in what marks an
article or what marks a page's furniture, and how much of the page's prose the marked
article has.  A small decision tree keeps or drops it.  It is trained on the blocks of
the labelled pages below, each with its marks and once more without any, so that it
also works by words and links alone, and where the marks are on the wrong block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import named, unused

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes template noscript svg math object select datalist head".split())
# of these the rest of the page is content if the end tag is missing
SWALLOWS = frozenset("script style title textarea xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption button".split()
)
# page furniture by element, whatever lies inside
FURNITURE = frozenset("nav aside footer menu dialog button fieldset".split())
# by a word of class or id: furniture unless an article is marked inside, and furniture whatever lies inside
HINTS_OUT = "nav navbar navigation menu sidebar side footer header masthead banner notice alert overlay widget signup login search pagination pager toolbar tags copyright legal skip form".split()
HINTS_NEVER = (
    "ad ads adv advert advertisement advertising sponsor sponsored promo promoted promotion cookie cookies consent gdpr popup modal comment comments commentary reply replies respond "
    "disqus discussion related recommended recommendations share sharing social breadcrumb breadcrumbs newsletter subscribe subscription"
).split()
# words that make a class name a remark about the layout
HINTS_LAYOUT = "no has with without wide full".split()
HINTS_IN = "article content post entry story main maincontent body text prose".split()
_OUT, _NEVER, _LAYOUT, _IN = map(frozenset, (HINTS_OUT, HINTS_NEVER, HINTS_LAYOUT, HINTS_IN))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-label)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSES_P = BLOCK - {"body", "html"}


class Block(NamedTuple):
    text: str
    words: int
    link_words: int
    place: int  # 1 in an article, -1 in furniture, 0 in neither; from 2 on while it isn't settled whether its element is the article
    heading: int


def _place(name: str, attrs: str) -> int | None:
    """Of an element: 1 marks an article, -1 furniture, -2 furniture whatever lies inside, 2 an article or main element with a name of furniture; None if it doesn't say."""
    if name in FURNITURE:
        return -2
    tokens, roles = set(), set()
    if attrs and name not in ("html", "body"):
        for m in _ATTR.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                roles.add(value.lower())
            elif m[1].lower() == "hidden":
                return -2
            elif m[1].lower() != "aria-label":
                for part in value.split():
                    found = {x.lower() for x in _PARTS.findall(part)}
                    if not found & _LAYOUT:
                        tokens |= found
    if roles & {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"}:
        return -2
    if tokens & _NEVER:
        return 2 if name in ("article", "main") else -2
    if tokens & _OUT and name not in ("article", "main"):
        return -1
    if name in ("article", "main") or "main" in roles or "article" in roles:
        return 1
    if name == "form" or name == "header":
        return -1
    return 1 if tokens & _IN and name in ("div", "section", "td") else None


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, int | None, int]] = []  # name, what it says of the place, the place in it
    parts: list[str] = []
    linked: list[str] = []
    links = heading = doubts = 0
    at, n, place = 0, len(page), 0

    def end() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, text.count(" ") + 1, len(unescape("".join(linked)).split()), place, heading))
            parts, linked = [], []

    def pop(name: str) -> None:
        nonlocal place, links
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                links -= sum(x[0] == "a" for x in stack[k:])
                del stack[k:]
                place = stack[-1][2] if stack else 0
                return

    def add(text: str) -> None:
        parts.append(text)
        if links:
            linked.append(text)

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name in RAW:
            if name == "head" or m[1]:
                continue
            if not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if close is not None:
                    at = close.end()
                elif name in SWALLOWS:
                    break
            continue
        if name == "option" and not m[1]:
            at = page.find("<", at) if "<" in page[at:] else n
            continue
        if name in ("br", "wbr", "img", "input"):
            if name == "br":
                add(" ")
            continue
        is_block = name in BLOCK
        if is_block:
            end()
        if m[1]:
            pop(name)
        elif name not in VOID:
            if name in _CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        pop("p")
                        break
                    if stack[k][0] in BLOCK:
                        break
            if name == "li" and any(x[0] == "li" for x in stack):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ("ul", "ol", "menu"):
                        break
                    if stack[k][0] == "li":
                        pop("li")
                        break
            says = _place(name, m[3])
            if name == "header" and place > 0:
                says = None  # an article's own heading
            if says == 2:
                doubts += 1
                says = 1 + doubts
            inner = place if says is None or place == -2 else says
            stack.append((name, says, inner))
            place = inner
            links += name == "a"
        heading = int(any(x[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for x in stack)) if is_block else heading
    end()
    if doubts:
        # an article element named like furniture is the article if it holds most of the page's prose
        prose = Counter()
        for b in out:
            prose[b.place] += b.words if 2 * b.link_words < b.words else 0
        real = {k for k, v in prose.items() if k > 1 and 2 * v > prose.total()}
        out = [b._replace(place=(1 if b.place in real else -1) if b.place > 1 else b.place) for b in out]
    return [b._replace(place=max(b.place, -1)) for b in out]


FEATURES = ["words", "link_density", "previous_words", "previous_link_density", "next_words", "next_link_density", "in_article", "in_furniture", "article_share", "heading"]


def block_features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block of a page; beyond its ends stand empty blocks.

    article_share is the share of the page's words outside furniture and links that
    the marked article has, 0 without one, and in_article the same for the blocks in
    the article and 0 for the others.
    """
    n = len(found)
    if not n:
        return np.zeros((0, len(FEATURES)))
    words = np.array([0, *(b.words for b in found), 0], float)
    density = np.array([0, *(min(1.0, b.link_words / b.words) for b in found), 0], float)
    place = np.array([b.place for b in found])
    prose = words[1:-1] * (density[1:-1] < 0.5)
    share = prose[place == 1].sum() / max(1.0, prose[place >= 0].sum())
    return np.stack(
        [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], np.where(place == 1, share, 0.0), (place == -1).astype(float), np.full(n, share), np.array([b.heading for b in found], float)], 1
    )


# The labelled pages: of each block m for main text, h for a heading of it, x for anything
# else; its words, and behind / the linked ones; ! in a marked article, ~ in marked furniture.
PAGES = (
    "x2/2~ x2/2~ x3/3~ x1/1~ x8~ h9! m45! m60! m12! m80! m3! m25! x11~",
    "x1~ x2/2~ x2/2~ h6! m4! m120! m18/4! m2! m90! m1! x3~ x40~ x35~ x7~",
    "x1/1~ x1/1~ x1/1~ h3! m30! h2! m22! m14! h4! m50! m9! m6! x5/5~ x9~",
    "x2/2~ x2/2~ x7! h8 m70 m55 m16 m90 x10~",
    "x2/2~ x1/1~ h7! m50! m35/3! x3/3! x4/4! x3/3! x5/5! m40! x6~",
    "x35~ x2/2~ x2/2~ h5! m28! m33! m11! x14~ x25~",
    "x1/1~ x1/1~ x9~ h5! m14! m10! x12~",
    "x1/1~ x1/1~ x1/1~ x1/1~ x8~ h12! m15! m9! m40! m110! x14~",
    "x1/1~ x1/1~ x4~ h3! m1! m2! m70! m1! m5! m2! x9~",
    "x3~ h4! m40! m6/6! m50! m8/8! m75! x6/2~ x20~",
    "x1/1~ h6! x7~",
    "x2/2~ x3/3~ h8 m60 m20 m7 m85 x9~ x4/4~",
    "x2/2~ x30 h6! m90! m12! m45! x22 x11~",
    "x4/4~ x12/8~ h10! m200! m150! m31/6! m18! m260! x55~ x48~ x16~ x3/3~",
    "x5! x4! h7 m45 m62 m38 m12 m80 x9~ x2/2~",
    "x1/1~ x2/2~ x16~ h8! m9! m7! m4! m12! m3! m8! x10~",
    "x1/1~ x1/1~ x9~ h10! m300! m2! m400! m3! m12! m350! m1! x12~",
    "x1/1~ x8~ h6! m600! m1! m8! m45! m1! m500! m60! m240! m2! x8~",
    "x2/2~ x7~ h9! m1! m1! m500! m2! m250! m260! m300! m30! x13~",
    "x2/2~ x1/1~ h5! m40! m6!",
    "x2/2~ x3/3~ h9! m30! m80! m250!",
    "x1/1~ h7! m12! m9!",
    "x2/2~ h4! m100! m5!",
    "h8! m20! m30! m2! m70!",
    "x9~ h3! m8!",
    "h6! m220! m14!",
    "m25! m60! x7~",
    "m90! m3! m12!",
    "x8~ h9! m3! m2! m30!",
    "h2! m1! m2! m45! x30~",
    "h3! m60! m12! x4/4! x3/3! x6/6! m30! m9! x5/5! x5/5!",
    "x2/2~ m90! m18! m5/5! m14! m44! x9~",
    "m30! m8! m7/7! m11! m22! m6/6! m35!",
    "x1/1~ x1/1~ h8 m40 m9 m80 m5 m30 m12 m60 m3 m45 x11~",
    "h5! m90! x3/3! x4/4! x3/3! x2/2!",
    "h6! m150! x5/5! x3/3! m70! x4/4! x4/4!",
    "m40 x40/40 m40",
    "m50 x20/20 m70 m45",
    "h4 m100 m60 m48",
    "x1/1~ x1/1~ h12 m15 m250 m300 m4 m420 m90 m2 m35 x11~",
)


SIZES = (0.4, 1, 2.5, 6)


def labelled(pages=PAGES) -> np.ndarray:
    """FEATURES and label of every block of the labelled pages, with paragraphs of more than ten words at several SIZES and in several orders, as they are and without marks."""
    rows = []
    for page, size, turn in product(pages, SIZES, range(4)):
        found = [(k[0], *map(int, (k[1:].rstrip("!~") + "/0").split("/")[:2]), {"!": 1, "~": -1}.get(k[-1], 0)) for k in page.split()]
        found = [(k, int(max(10, w * size)) if k == "m" and w > 10 and not l else w, l, place) for k, w, l, place in found]
        spots = [k for k, b in enumerate(found) if b[0] == "m" and not b[2]]
        if turn and len(spots) <= turn:
            continue
        sizes = [found[k][1] for k in spots]
        for k, w in zip(spots, sizes[turn:] + sizes[:turn]):
            found[k] = ("m", w, 0, found[k][3])
        for marked in (1, 0):
            x = block_features([Block("", w, l, place * marked, int(kind == "h")) for kind, w, l, place in found])
            rows.append(np.column_stack([x, [kind != "x" for kind, *_ in found]]))
    return np.concatenate(rows)


class Tree(NamedTuple):
    feature: int
    cut: float
    left: object
    right: object


def _gini(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return 2 * p * (1 - p) * len(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 12) -> Tree | int:
    """Classification tree by Gini impurity with at least ``least`` rows on either side of a cut; ties go to the earlier feature and the smaller cut."""
    label = int(2 * y.sum() >= len(y))
    if not depth or y.min() == y.max():
        return label
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= cut
            if min(low.sum(), len(low) - low.sum()) < least:
                continue
            cost = _gini(y[low]) + _gini(y[~low])
            if best is None or cost < best[0] - 1e-9:
                best = (cost, k, float(cut))
    if best is None or best[0] >= _gini(y) - 1e-9:
        return label
    low = x[:, best[1]] <= best[2]
    return Tree(best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def decide(tree: Tree | int, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Tree):
        return np.full(len(x), bool(tree))
    out = np.zeros(len(x), bool)
    low = x[:, tree.feature] <= tree.cut
    out[low] = decide(tree.left, x[low])
    out[~low] = decide(tree.right, x[~low])
    return out


def trained(pages=PAGES) -> Tree | int:
    table = labelled(pages)
    return grow(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree: Tree | int) -> str:
    found = blocks(page or "")
    keep = decide(tree, block_features(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", labelled_pages=PAGES) -> DataFrame:
    """``pages`` without the html, with its main text and n_chars, the text's code points.

    Blocks are joined in page order by one \\n; in a block character references
    are decoded and white space is one space.  A null or empty page, or one without
    main text, gives ''.  Pages are read whole, however long.  An end tag that is
    missing loses no text behind it, but for script, style, title, textarea and xmp,
    whose content the rest of the page is.  Repeated rows stay.  Other columns stay,
    whatever their names; columns of the two new names are replaced.  An empty table
    gives an empty result.
    """
    rest = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower(), "n_chars")]
    src = pages.select(*[f"`{c}`" for c in rest], F.col(f"`{named(pages, html_col)}`").cast("string").alias(unused(rest, "_html")))
    tree = trained(labelled_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(p, tree) for p in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*rest, text_col, "n_chars"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1]) + f"`{text_col}` string, n_chars long"
    return src.mapInArrow(run, schema)
