"""Jaccard similarity join of documents on word shingles, with several global token orders.

Prefix filter: if |x & y| >= 3/4 |x | y|, the first |x| - ceil(3/4 |x|) + 1 tokens
of x and the like of y, both sorted in one global order of the tokens, have a
token in common.  That holds under every order, so a candidate must share a
prefix token under all of them:

* order 1 takes rare tokens first, by document frequency over all documents.  It
  is applied by shuffles, and it leaves only documents whose prefix holds a token
  that another document has too;
* orders 2 and 3 are two unrelated orders by hash.  They are applied where the
  survivors of order 1 meet, and intersected with it before any verification.

Verification counts the intersection of the whole sets exactly.

How it runs.  Token frequencies are counted by an exchange of packed blocks: a
map task sorts the tokens of a few million shingles, cuts them into buckets by
their top bits and sends a bucket's block as one row, so 5 to 6 bytes a shingle
are shuffled rather than a row each.  A bucket sends back what is not unique.
Documents with equal sets are one node from then on.  Nodes that share a prefix
token form candidate groups; the sets of a group are verified in one task while
they have at most ``block_tokens`` shingles.  Members of a larger group are first
held against a few of its sets, which joins most of a large group of near copies;
then it is cut into blocks by what is joined, and two blocks that aren't joined
meet in a task, which emits a star for each of its components, never the pairs.
So no group, whatever its size, meets in one task.

Truncating a token to 40 bits and its bucket can only make a token look less
rare; it never loses a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import MUL, chunks, mix, shingle_sets, trimmed
from .components import components
from .store import discard, stage, unused

FLUSH = 1_000_000  # shingles in one sorted run of a map task
BLOCK_TOKENS = 250_000  # shingles in one block of a candidate group: 2 MB
PIVOTS = 3  # sets that each member of a larger group is held against first
BROADCAST_IDS = 1_000_000  # ids, 8 MB
TOKEN_BITS = 40


def prefix_len(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def _node(tokens: np.ndarray) -> bytes:
    """128-bit hash of a set."""
    a = mix(tokens * MUL + np.uint64(1)).sum(dtype=np.uint64)
    b = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def _pack(x: np.ndarray) -> bytes:
    """Sorted integers as the byte planes of their differences; the shuffle's compression removes the empty planes."""
    gaps = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    return gaps.view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8].T.tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(TOKEN_BITS // 8, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, : TOKEN_BITS // 8] = planes.T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


FORWARD = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("tokens", pa.binary()), ("owner", pa.binary()), ("ids", pa.binary()), ("known", pa.binary()), ("sizes", pa.binary()), ("nodes", pa.binary())])
FORWARD_SQL = "bucket int, part long, tokens binary, owner binary, ids binary, known binary, sizes binary, nodes binary"


def _forward(buckets: int):
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    low = np.uint64((1 << TOKEN_BITS) - 1)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, place = 0, TaskContext.get().partitionId()
        ids, sizes, nodes, sets, seen, held = [], [], [], [], set(), 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, ids, sizes, nodes, sets, seen, held
            owner = np.repeat(np.array([k for k, _ in sets], np.uint32), [len(s) for _, s in sets])
            tokens = np.concatenate([s for _, s in sets]) if sets else np.zeros(0, np.uint64)
            order = np.argsort(tokens)
            tokens, owner = tokens[order], owner[order]
            cut = np.searchsorted(tokens >> shift, np.arange(buckets + 1, dtype=np.uint64)) if buckets > 1 else np.array([0, len(tokens)])
            keys = (tokens >> np.uint64(int(shift) - TOKEN_BITS)) & low if int(shift) >= TOKEN_BITS else tokens & low
            rows = {n: [] for n in FORWARD.names}
            for b in range(buckets):
                i, j = cut[b], cut[b + 1]
                if i < j or not b:
                    rows["bucket"].append(b)
                    rows["part"].append((place << 32) + seq)
                    rows["tokens"].append(_pack(keys[i:j]))
                    rows["owner"].append(owner[i:j].astype("<u2" if len(ids) <= 65536 else "<u4").tobytes())
                    for name, blob in (("ids", np.array([x or 0 for x in ids], "<i8")), ("known", np.array([x is not None for x in ids], np.uint8)), ("sizes", np.array(sizes, "<u4"))):
                        rows[name].append(None if b else blob.tobytes())
                    rows["nodes"].append(None if b else b"".join(nodes))
            seq += 1
            ids, sizes, nodes, sets, seen, held = [], [], [], [], set(), 0
            return pa.RecordBatch.from_pydict(rows, schema=FORWARD)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for texts in chunks(batch.column(1)):
                for k, s in enumerate(shingle_sets(texts)):
                    node = _node(s) if len(s) else bytes(16)
                    if len(s) and node not in seen:
                        seen.add(node)
                        sets.append((len(ids), s))
                        held += len(s)
                    ids.append(doc_ids[texts.first + k])
                    sizes.append(len(s))
                    nodes.append(node)
                if held >= FLUSH or len(ids) >= 1_000_000:
                    yield flush()
        if ids:
            yield flush()

    return run


BACK = pa.schema([("part", pa.int64()), ("tokens", pa.binary()), ("owner", pa.binary()), ("df", pa.binary()), ("ids", pa.binary()), ("known", pa.binary()), ("sizes", pa.binary()), ("nodes", pa.binary())])
BACK_SQL = "part long, tokens binary, owner binary, df binary, ids binary, known binary, sizes binary, nodes binary"


def _count(key: tuple, table: pa.Table) -> pa.Table:
    """One bucket: document frequency of each token; back to each part go its tokens of frequency 2 and more."""
    rows = table.to_pylist()
    parts = [_unpack(r["tokens"]) for r in rows]
    every = np.concatenate(parts)
    values, at, df = np.unique(every, return_inverse=True, return_counts=True)
    df = np.minimum(df, np.iinfo(np.uint32).max).astype(np.uint32)[at]
    out = {n: [] for n in BACK.names}
    a = 0
    for r, x in zip(rows, parts):
        f = df[a : a + len(x)]
        a += len(x)
        shared = np.flatnonzero(f > 1)
        width = len(r["owner"]) // max(1, len(x))
        owner = np.frombuffer(r["owner"], "<u2" if width == 2 else "<u4")
        out["part"].append(r["part"])
        out["tokens"].append((x[shared] | np.uint64(key[0].as_py() << TOKEN_BITS)).astype("<u8").tobytes())
        out["owner"].append(owner[shared].astype("<u4").tobytes())
        out["df"].append(f[shared].astype("<u4").tobytes())
        for n in ("ids", "known", "sizes", "nodes"):
            out[n].append(r[n])
    return pa.Table.from_pydict(out, schema=BACK)


GATHERED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("prefix", pa.list_(pa.int64()))])
GATHERED_SQL = "doc_id long, n long, node binary, prefix array<long>"


def _gather(key: tuple, table: pa.Table) -> pa.Table:
    """One part: the prefix of each document in the order of rare tokens first, without its unique tokens."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["ids"] is not None)
    n = np.frombuffer(head["sizes"], "<u4").astype(np.int64)
    whole = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
    tokens, owner, df = whole("tokens", "<u8"), whole("owner", "<u4"), whole("df", "<u4")
    order = np.lexsort((tokens, df, owner))
    tokens, owner = tokens[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(n) + 1))
    shared = np.diff(first)
    known = np.frombuffer(head["known"], np.uint8)
    ids = np.frombuffer(head["ids"], "<i8")
    out = {"doc_id": [int(i) if k else None for i, k in zip(ids, known)], "n": n.tolist(), "node": [], "prefix": []}
    for k, size in enumerate(n.tolist()):
        out["node"].append(head["nodes"][16 * k : 16 * k + 16] if size else None)
        take = prefix_len(size) - (size - int(shared[k])) if size else 0
        out["prefix"].append(tokens[first[k] : first[k] + take].astype(np.int64).tolist() if shared[k] and take > 0 else None)
    return pa.Table.from_pydict(out, schema=GATHERED)


@trimmed
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch.column(0)):
            sets = [s for s in shingle_sets(texts) if len(s)]
            yield pa.RecordBatch.from_pydict({"node": pa.array([_node(s) for s in sets], pa.binary()), "tokens": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())})


def _csr(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Postings of a list of token arrays: starts, members, and each list's token numbers."""
    size = np.array([len(x) for x in lists])
    owner = np.repeat(np.arange(len(lists)), size)
    _, at = np.unique(np.concatenate(lists), return_inverse=True)
    order = np.argsort(at, kind="stable")
    starts = np.searchsorted(at[order], np.arange(at.max() + 2 if len(at) else 1))
    return starts, owner[order], np.split(at, np.cumsum(size)[:-1])


def forest(sets: list[np.ndarray], first_prefix: list[np.ndarray]) -> list[tuple[int, int]]:
    """A star (first member, other member) for each component of the links between some sets.

    Breadth first: a set is compared with sets that no tree has reached yet, and
    only with those that share a prefix token with it under each of three orders.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    orders = [_csr(first_prefix)]
    for salt in (0x51ED270B27B4F3CF, 0x2545F4914F6CDD1D):
        keys = [mix(s ^ np.uint64(salt)) for s in sets]
        orders.append(_csr([np.partition(k, p - 1)[:p] if (p := prefix_len(len(k))) < len(k) else k for k in keys]))
    left = np.ones(m, bool)
    edges = []
    for root in range(m):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue and left.any():
            x = queue.pop()
            near = left & (4 * size >= 3 * size[x]) & (3 * size <= 4 * size[x])
            for starts, members, own in orders:
                if not near.any():
                    break
                hit = np.zeros(m, bool)
                for t in own[x].tolist():
                    hit[members[starts[t] : starts[t + 1]]] = True
                near &= hit
            found = np.flatnonzero(near)
            if not len(found):
                continue
            both = np.concatenate([sets[y] for y in found])
            at = np.minimum(np.searchsorted(sets[x], both), len(sets[x]) - 1)
            common = np.add.reduceat((sets[x][at] == both).astype(np.int64), np.concatenate([[0], np.cumsum(size[found])[:-1]]))
            for y in found[100 * common >= 75 * (size[x] + size[found] - common)].tolist():
                left[y] = False
                edges.append((root, y))
                queue.append(y)
    return edges


def _verify(key: tuple, table: pa.Table) -> pa.Table:
    rows = {r["node"]: r for r in table.to_pylist()}
    nodes = sorted(rows)
    sets = [np.frombuffer(rows[k]["tokens"], "<u8") for k in nodes]
    found = forest(sets, [np.array(rows[k]["prefix"], np.int64) for k in nodes])
    return pa.Table.from_pydict({"a": pa.array([nodes[x] for x, _ in found], pa.binary()), "b": pa.array([nodes[y] for _, y in found], pa.binary())})


@trimmed
def _near_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows (pivot, p, node, tokens)."""
    for batch in batches:
        found = []
        for pivot, p, node, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            x, y = np.frombuffer(p, "<u8"), np.frombuffer(tokens, "<u8")
            common = np.isin(y, x, assume_unique=True).sum()
            if pivot != node and 100 * common >= 75 * (len(x) + len(y) - common):
                found.append((pivot, node))
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})


def _blocks(cand: DataFrame, sets: DataFrame, block_tokens: int) -> tuple[DataFrame, DataFrame | None]:
    """Candidates with their sets and the pairs of blocks (i, j) of their group that they meet others in, and links that are known already.

    A group of up to ``block_tokens`` shingles is one block.  Members of a larger
    one are first held against PIVOTS of it.  What those link is connected, so
    blocks are made up by component, and no two blocks of one component meet:
    a group of very many near copies of one text costs about as many block pairs
    as it has blocks.
    """
    total = cand.groupBy("root").agg(F.sum("n").alias("total"))
    sized = cand.join(total, "root")
    one = sized.where(F.col("total") <= block_tokens).select("root", "node", "prefix", F.expr("array(struct(0 as i, 0 as j))").alias("pairs"))
    if not total.where(F.col("total") > block_tokens).limit(1).count():
        return one.join(sets, "node"), None
    big = stage(sized.where(F.col("total") > block_tokens).select("root", "node", "n", "prefix").join(sets, "node"), "large-groups")
    order = F.struct(F.xxhash64("node").alias("h"), "node")
    low = big.select("root", order.alias("o"))
    found = []
    for _ in range(PIVOTS):
        pick = stage(low.groupBy("root").agg(F.min("o").alias("o")), "pivots")
        found.append(pick)
        low = low.join(pick.select("root", F.col("o").alias("last")), "root").where(F.col("o") > F.col("last")).drop("last")
    chosen = found[0]
    for pick in found[1:]:
        chosen = chosen.union(pick)
    with_tokens = chosen.select("root", F.col("o.node").alias("node")).join(big.select("node", "tokens"), "node").select("root", F.col("node").alias("pivot"), F.col("tokens").alias("p"))
    known = stage(big.select("root", "node", "tokens").join(with_tokens, "root").select("pivot", "p", "node", "tokens").mapInArrow(_near_pivots, "a binary, b binary"), "pivot-links")
    label = components(known, "a", "b")
    part = big.select("root", "node", "n").join(label.withColumnRenamed("root", "label"), "node", "left")
    size = part.groupBy("root", "label").agg(F.sum("n").alias("tokens"))
    # a component of half a block or more has blocks of its own, the rest shares blocks
    own = (F.col("tokens") * 2 > block_tokens) & F.col("label").isNotNull()
    kind = size.select("root", "label", F.when(own, F.hex("label")).otherwise(F.lit("")).alias("kind"), "tokens")
    count = stage(kind.groupBy("root", "kind").agg(F.ceil(F.sum("tokens") / F.lit(block_tokens)).cast("int").alias("count")), "blocks")
    kind = kind.select(F.col("root").alias("r"), F.col("label").alias("l"), "kind")
    placed = part.join(kind, (F.col("root") == F.col("r")) & F.col("label").eqNullSafe(F.col("l"))).select("root", "node", "kind").join(count, ["root", "kind"])
    placed = placed.select("node", F.concat_ws("/", "kind", F.pmod(F.xxhash64("node"), "count")).alias("block"), "root")
    named = count.select("root", "kind", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("k")).select("root", "kind", F.concat_ws("/", "kind", "k").alias("block"))
    other = named.select(F.col("root").alias("r2"), F.col("kind").alias("kind2"), F.col("block").alias("block2"))
    # blocks of one component don't meet; a block alone in its group meets itself
    meet = named.join(other, (F.col("root") == F.col("r2")) & ((F.col("kind") != F.col("kind2")) | (F.col("kind") == "")))
    pairs = meet.where("block <= block2").groupBy("root", "block").agg(F.collect_list("block2").alias("up"))
    down = meet.where("block > block2").groupBy("root", "block").agg(F.collect_list("block2").alias("down"))
    per = pairs.join(down, ["root", "block"], "full").select(
        "root", "block",
        F.concat(F.transform(F.coalesce("up", F.array()), lambda b: F.struct(F.col("block").alias("i"), b.alias("j"))), F.transform(F.coalesce("down", F.array()), lambda b: F.struct(b.alias("i"), F.col("block").alias("j")))).alias("pairs"),
    )
    many = big.drop("n").join(placed.select("node", "block"), "node").join(per, ["root", "block"]).select("root", "node", "prefix", "pairs", "tokens")
    one = one.withColumn("pairs", F.transform("pairs", lambda p: F.struct(p["i"].cast("string").alias("i"), p["j"].cast("string").alias("j"))))
    return one.join(sets, "node").select(many.columns).union(many), known


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for every row of ``docs``.

    Two documents link when their sets of distinct 5-word shingles (ASCII-folded
    words; fewer than five words are one shingle) have a Jaccard similarity of
    0.75 or more; component_id is the smallest id reachable by links.

    Null and blank texts have n_shingles 0, link with nothing and are their own
    component.  A null id stays null and takes the component of its text, which
    is null if no member has an id.  Repeated rows stay.  An empty table gives an
    empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(64, 1 << (4 * parts - 1).bit_length())
    there = docs.mapInArrow(_forward(buckets), FORWARD_SQL)
    back = there.groupBy("bucket").applyInArrow(_count, BACK_SQL)
    sig = stage(back.groupBy("part").applyInArrow(_gather, GATHERED_SQL), "signatures")

    # nodes whose prefix holds a token of another node's prefix
    alive = sig.where("prefix is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    posted = stage(alive.select("node", "doc_id", "n", "prefix"), "prefixes")
    post = posted.select("node", F.explode("prefix").alias("token"))
    lists = post.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    groups = stage(components(post.join(lists.select("token", "low"), "token"), "node", "low"), "groups")

    cand = stage(posted.join(groups, "node"), "candidates")
    discard(posted)
    discard(groups)
    ids = cand.where("doc_id is not null").select("doc_id").distinct()
    if cand.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.join(ids, "doc_id", "left_semi").select("text")
    if cand.where("doc_id is null").limit(1).count():
        texts = texts.union(docs.where("doc_id is null").select("text"))
    sets = texts.mapInArrow(_sets, "node binary, tokens binary")
    held, large = _blocks(cand, sets, block_tokens)
    keyed = held.select("root", F.explode("pairs").alias("p"), "node", "prefix", "tokens").select("root", "p.i", "p.j", "node", "prefix", "tokens")
    links = keyed.groupBy("root", "i", "j").applyInArrow(_verify, "a binary, b binary")
    if large is not None:
        links = links.union(large)
    comps = stage(components(links, "a", "b"), "components")
    discard(cand)

    # equal sets are one node, so a node's smallest id comes first, then a component's
    member = sig.select("doc_id", "n", "node")
    low = member.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    rooted = low.join(comps, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component"))
    label = rooted.join(least, "root").select("node", "component")
    return member.join(label, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component of :func:`ngram_jaccard_join`, that with the smallest id.

    Documents without words link with nothing and stay.  Where ids are null or
    repeat, rows are numbered and the first of a component stays.
    """
    ids = docs.groupBy(id_col).count()
    key, numbered = id_col, docs
    if ids.where((F.col("count") > 1) | F.col(id_col).isNull()).limit(1).count():
        key = unused(docs.columns, "_row")
        numbered = stage(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    gone = stage(ngram_jaccard_join(numbered, key, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "near-duplicates")
    few = gone.count() <= BROADCAST_IDS
    return numbered.join(F.broadcast(gone) if few else gone, numbered[key] == gone["_gone"], "left_anti").select(*[numbered[c] for c in docs.columns])
