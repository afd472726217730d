"""Quotation linking of messages and conversations in reply order without quotes.

A line's quote level is the number of leading ``>``.  Runs of lines of one level
are passages; level 0 is a message's own text.  Passages and lines are hashed after
normalisation (white space to one space, lower case) and looked for in the own text
of earlier messages of the conversation: the whole passage first, then its lines.

The latest earlier message that has a hash is found as an as-of join on
(conversation, hash): running maxima within runs of RUN turns, and over the runs'
own maxima.  So a line that very many messages of one conversation repeat or quote
is never gathered in one task, and no pairs are formed.  Threads are found by
pointer doubling: a round joins each message with the message its pointer names.
Reply order comes from a range-partitioned sort, so a very long conversation spans
partitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .store import discard, named, stage, unused

_QUOTE = re.compile(r"^(?:[ \t]{0,3}>)+[ ]?")
# fixed values: how mail programs end the line before a quotation
_ATTRIBUTION = re.compile(r"(wrote|schrieb|a écrit|escribió)\s*:\s*$", re.I)


SHARE = 0.5  # of a passage's lines that one message must have, where none has the whole passage
RUN = 1000  # turns of one conversation that are looked through together


def normal(text: str) -> str:
    return " ".join(text.split()).lower()


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text and its quoted passages with their levels, in order.

    A line that ends like an attribution and stands right before a quotation
    belongs to it.  Line feeds around removed quotations collapse to one blank line.
    """
    own: list[str] = []
    quoted: list[tuple[int, list[str]]] = []
    before = 0
    for line in (text or "").split("\n"):
        m = _QUOTE.match(line)
        level = m[0].count(">") if m else 0
        if level:
            if not before:
                for _ in range(2):  # blank lines, and again behind an attribution
                    while own and not own[-1].strip():
                        own.pop()
                    if own and _ATTRIBUTION.search(own[-1]):
                        own.pop()
                own.append("")
            body = line[m.end() :]
            if level != before or not body.strip() or not quoted:
                quoted.append((level, []))
            if body.strip():
                quoted[-1][1].append(body)
        elif before and not line.strip():
            continue
        else:
            own.append(line)
        before = level if level or line.strip() else before
    return "\n".join(own).strip("\n") if quoted else (text or ""), [(k, "\n".join(p)) for k, p in quoted if p]


def _hash(text: str) -> bytes | None:
    return xxh3_128_digest(n.encode()) if (n := normal(text)) else None


def _paragraphs(text: str) -> list[str]:
    return [p for p in re.split(r"\n[ \t]*\n", text) if p.strip()]


def _own_units(own: str) -> set[bytes]:
    """Hashes of what a quotation may quote: the whole text, its paragraphs and its lines."""
    return {h for x in (own, *_paragraphs(own), *own.split("\n")) if (h := _hash(x))}


WHOLE, LINE = 0, 1
UNITS = ["conv", "turn", "passage", "level", "kind", "hash", "lines"]
UNITS_SQL = "conv long, turn long, passage int, level int, kind int, hash binary, lines int"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of UNITS of (conv, turn, text): own text has level 0 and no passage; of a passage, the hash of the whole and those of its distinct lines, with their number."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
    for batch in batches:
        rows: list[tuple] = []
        for conv, turn, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if conv is None or turn is None:
                continue
            own, quoted = parse(text)
            rows += [(conv, turn, -1, 0, WHOLE, h, 0) for h in sorted(_own_units(own))]
            for k, (level, p) in enumerate(quoted):
                lines = {h for x in p.split("\n") if (h := _hash(x))}
                rows.append((conv, turn, k, level, WHOLE, _hash(p), len(lines)))
                rows += [(conv, turn, k, level, LINE, h, len(lines)) for h in sorted(lines)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], UNITS)


def _latest_before(units: DataFrame) -> DataFrame:
    """The quoted rows of UNITS with origin: the latest earlier turn of the conversation whose own text has the hash, or null."""
    key = ["conv", "hash"]
    span = F.floor(F.col("turn") / RUN)
    marks = units.groupBy(*key, "turn").agg(F.max((F.col("level") == 0).cast("int")).alias("own"), F.max((F.col("level") > 0).cast("int")).alias("quoted")).withColumn("run", span)
    here = F.when(F.col("own") == 1, F.col("turn"))
    last = marks.groupBy(*key, "run").agg(F.max(here).alias("last"))
    above = F.max("last").over(Window.partitionBy(*key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    last = last.select(*key, "run", above.alias("above"))
    near = F.max(here).over(Window.partitionBy(*key, "run").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    found = marks.select(*key, "turn", "run", "quoted", near.alias("near")).where("quoted = 1").join(last, [*key, "run"])
    return units.where("level > 0").join(found.select(*key, "turn", F.coalesce("near", "above").alias("origin")), [*key, "turn"])


NEW = ["n_quotes", "n_linked", "reply_to", "thread", "depth", "position"]


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """``messages`` with its own text, and n_quotes, n_linked, reply_to, thread, depth and position.

    n_quotes counts quoted passages and n_linked those found in an earlier message
    of the conversation.  A passage is found in the latest earlier message whose own
    text, a paragraph or a line of it is the whole passage; where there is none, each
    line counts for the latest earlier message that has it, and the message with most
    of them, the later of equal ones, needs ``share`` of the passage's distinct lines.
    reply_to is the turn of the latest message quoted at level 1, else of the latest
    quoted at all, else null; thread is the turn of the first message up the chain of
    reply_to, and depth the steps to it.  position numbers a conversation's rows from
    0 by thread, then turn: the reply order.

    Null texts are empty.  Messages with a null conversation or turn are linked with
    nothing, are their own thread and have no position.  Rows that repeat a
    conversation's turn share its links, and have positions of their own in no fixed
    order among them.  Very long texts and conversations are taken whole.  Other
    columns stay, whatever their names; columns of the new names are replaced.  An
    empty table gives an empty result.
    """
    base = messages.drop(*NEW)
    conv_col, turn_col, text_col = (named(base, c) for c in (conv_col, turn_col, text_col))
    conv, turn = (F.col(f"`{c}`").cast("long") for c in (conv_col, turn_col))
    core = base.select(conv.alias("conv"), turn.alias("turn"), F.col(f"`{text_col}`").cast("string").alias("text"))
    units = stage(core.mapInArrow(_units, UNITS_SQL), "passages")
    found = stage(_latest_before(units), "origins").where("origin is not null")
    of = ["conv", "turn", "passage"]
    whole = found.where(F.col("kind") == WHOLE).groupBy(*of).agg(F.min("level").alias("level"), F.max("origin").alias("origin"))
    line = found.where(F.col("kind") == LINE).groupBy(*of, "origin").agg(F.min("level").alias("level"), F.count("*").alias("n"), F.max("lines").alias("lines"))
    line = line.groupBy(*of).agg(F.max(F.struct("n", "origin", "level", "lines")).alias("m")).where(F.col("m.n") >= share * F.col("m.lines"))
    per = whole.union(line.select(*of, "m.level", "m.origin").join(whole.select(*of), of, "left_anti"))
    links = per.groupBy("conv", "turn").agg(
        F.count("*").alias("n_linked"), F.coalesce(F.max(F.when(F.col("level") == 1, F.col("origin"))), F.max("origin")).alias("reply_to")
    )
    chain = stage(links.select("conv", "turn", "n_linked", "reply_to", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "reply-chains")
    discard(units)
    while True:
        up = chain.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("steps"))
        joined = chain.join(up, ["conv", "thread"], "left")
        after = stage(
            joined.select("conv", "turn", "n_linked", "reply_to", F.coalesce("above", "thread").alias("thread"), (F.col("depth") + F.coalesce("steps", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved")),
            "reply-chains",
        )
        moved = after.where("moved").limit(1).count()
        discard(chain)
        chain = after
        if not moved:
            break
    typed = base.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    names = typed.columns
    where = names.index(text_col)

    def own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(t) for t in batch.column(where).to_pylist()]
            columns = [*batch.columns]
            columns[where] = pa.array([x for x, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(q) for _, q in found], pa.int64())], [*names, "n_quotes"])

    plain = typed.mapInArrow(own_text, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed.schema) + ", n_quotes long")
    c, t, part = (unused([*names, *NEW], x) for x in ("_c", "_t", "_part"))
    at = chain.select(F.col("conv").alias(c), F.col("turn").alias(t), "n_linked", "reply_to", "thread", "depth")
    linked = plain.withColumns({c: conv, t: turn}).join(at, [c, t], "left").select(
        *[f"`{x}`" for x in names], "n_quotes", c, t, F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "reply_to",
        F.coalesce("thread", t).alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    return _positions(linked, c, t, part).drop(c, t)


def _positions(linked: DataFrame, conv: str, turn: str, part: str) -> DataFrame:
    """``linked`` sorted in reply order, with position: rows are numbered within written range partitions, and a conversation's numbers go on from one partition to the next."""
    keys = [conv, "thread", turn]
    rows = stage(linked.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(part, F.spark_partition_id()), "reply-order")
    of, at, above = (unused(rows.columns, x) for x in ("_of", "_at", "_above"))
    size = rows.groupBy(F.col(conv).alias(of), F.col(part).alias(at)).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(of).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begin = size.select(of, at, before.alias(above))
    number = F.row_number().over(Window.partitionBy(conv, part).orderBy("thread", turn)) - 1
    numbered = rows.withColumn("position", number).join(begin, (F.col(conv).eqNullSafe(F.col(of))) & (F.col(part) == F.col(at)))
    known = F.col(conv).isNotNull() & F.col(turn).isNotNull()
    return numbered.withColumn("position", F.when(known, F.col("position") + F.col(above)).cast("long")).drop(of, at, above, part)


def quoting_replies(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``messages`` as mail would hold them: a reply begins with the message it answers, and that one's own quotation, behind ``>``.

    A table of turns has no quotations, so they are made by rule: turn t answers turn
    t - 1, or turn t - 2 where t is a multiple of 3, and quotes the whole of it at level
    1 and the turn that one answers at level 2.  A message that answers no turn there
    is stays as it is, as do null turns.  Of rows that repeat a turn, the smallest text
    is quoted.  Other columns stay; an empty table gives an empty result.
    """
    conv_col, turn_col, text_col = (named(messages, c) for c in (conv_col, turn_col, text_col))
    c, t, up, q1, q2, c1, t1, head = (unused(messages.columns, x) for x in ("_c", "_t", "_up", "_q1", "_q2", "_c1", "_t1", "_head"))
    answers = lambda n: F.col(n) - F.when(F.col(n) % 3 == 0, 2).otherwise(1)
    rows = messages.withColumns({c: F.col(f"`{conv_col}`").cast("long"), t: F.col(f"`{turn_col}`").cast("long")}).withColumn(up, answers(t))
    said = rows.where(F.col(c).isNotNull() & F.col(t).isNotNull()).groupBy(c, t).agg(F.min(F.col(f"`{text_col}`").cast("string")).alias(q1))
    quoted = lambda x, mark: F.regexp_replace(x, "(?m)(?d)^", mark)
    above = said.select(c, answers(t).alias(up), F.col(t).alias(t1), q1).join(said.select(c, F.col(t).alias(up), F.col(q1).alias(q2)), [c, up], "left")
    above = above.select(F.col(c).alias(c1), t1, F.concat_ws("\n", quoted(q2, ">> "), quoted(q1, "> ")).alias(head))
    both = rows.join(above, (F.col(c) == F.col(c1)) & (F.col(up) == F.col(t1)), "left")
    text = F.when(F.col(head) != "", F.concat(F.concat(F.lit("On turn "), F.col(up), F.lit(", they wrote:\n")), F.col(head), F.lit("\n\n"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).otherwise(F.col(f"`{text_col}`"))
    return both.select(*[text.alias(x) if x == text_col else F.col(f"`{x}`") for x in messages.columns])
