"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import small
from .common import written

#: Words of a block.
BLOCK = 1024
#: Documents of a source that one window orders together.
WINDOW_ROWS = 20_000
#: Slots that one row is exploded into.
SLOT_RUN = 4096
#: Slots of a task.
SLOT_TASK = 65_536
WORD = r"[^\x20\x09-\x0D]+"


def _running(df: DataFrame, order: Sequence, values: dict[str, str], name: str) -> DataFrame:
    """Adds sums of columns over the rows before each one in a global order: within ranges of it, with the ranges' totals carried on.  ``values``: new name -> column."""
    ranged = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), name)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    carried = ranged.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in values.items()])
    carried = carried.select("__part", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in values])
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(small(carried), "__part")
    return out.withColumns({n: F.col(f"__{n}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in values.items()}).drop("__part", *[f"__{n}" for n in values])


def targets(sources: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """``sources`` (source, source_size, n_docs) with number (by code point, null last), weight and target.

    ``share`` of all sizes is shared by weight; a target stops at ``most`` times its source's size, and the excess is shared anew among
    the others until none is above.  Each round is an aggregate over the sources; the driver holds two sums.
    """
    if share > most:
        raise ValueError("no target can be met: share exceeds most")
    listed = _running(sources.withColumn("__one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], {"number": "__one"}, "sources").drop("__one")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    listed = written(listed.withColumn("weight", weight.cast("long")), "weights")
    limit = most * F.col("source_size")
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1  # words a unit of weight; sources that are at their limit
    while total:
        # sources stay full: the level only rises
        above = F.coalesce(limit <= level * F.col("weight"), F.lit(False))
        n, spent, rest = listed.agg(F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == full or not rest:
            break
        full, level = n, (share * total - spent) / rest
    return listed.withColumn("target", F.least(limit.cast("double"), level * F.col("weight")))


def keyed(docs: DataFrame, seed: str) -> DataFrame:
    """(doc_id, source, size, shuffle): words of the whole text (null: 0), and a hash of seed, id and text by which a source is shuffled."""
    text = F.coalesce("text", F.lit(""))
    shuffle = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), shuffle.alias("shuffle"))


def positions(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Shuffled documents with their place in their source: nth, and pos, the words before it.

    A source is cut into ranges of the hash of about WINDOW_ROWS documents; windows run within a range, and the ranges' sums are carried on.
    """
    # shuffles of documents by source would bring a large one together; sources go out to them while they are few, beyond that Spark splits a large key
    rows = rows.withColumn("source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).join(small(listed.withColumn("source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))), "source")
    parts = F.ceil(F.col("n_docs") / WINDOW_ROWS)
    rows = rows.withColumn("range", F.floor(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / 2.0**32 * parts))
    sums = rows.groupBy("number", "range").agg(F.sum("size").alias("__size"), F.count("*").alias("__n"))
    before = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sums = sums.select("number", "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("__size", "__n")])
    within = Window.partitionBy("number", "range").orderBy("shuffle", "doc_id")
    rows = rows.withColumn("pos", F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nth", F.row_number().over(within))
    out = rows.join(small(sums), ["number", "range"])
    return out.withColumn("pos", F.col("pos") + F.col("__size")).withColumn("nth", F.col("nth") + F.col("__n")).drop("__size", "__n", "range")


def _before(j: str, x: str, v: str, bits: int) -> str:
    """How many numbers below ``j`` have a reversal below ``x``; ``v`` is the reversal of ``j``.

    Numbers below j agree with it down to a bit that j has and they have not; what follows is free and becomes the reversal's leading bits.
    """
    return f"""aggregate(sequence(0, {bits - 1}), 0L, (n, p) -> n + CASE WHEN (shiftright({j}, p) & 1L) = 0 THEN 0L
        ELSE least(shiftleft(1L, p), shiftright({x} - ({v} & (shiftleft(1L, {bits - 1} - p) - 1L)) + shiftleft(1L, {bits} - p) - 1L, {bits} - p)) END)"""


def schedule(listed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, number, nth_block): which source, and which of its blocks, each slot of the mix takes.

    A source has as many slots as blocks of its target.  Slots are van der Corput points: the numbers 0, 1, 2, ... with their bits reversed,
    of which those below the number of slots count.  A point falls into a source's part of the cumulative slots, so every source gets exactly its own number
    and is spread evenly over the whole.  Its rank among its source's points, and among all, is counted from their digits, without a sort or a shuffle.
    """
    quota = F.ceil(F.col("words") / block)
    quotas = _running(listed.select("number", "words").withColumn("quota", quota), ["number"], {"start": "quota"}, "quotas")
    slots = quotas.agg(F.sum("quota")).first()[0] or 0
    bits = max(1, (int(slots) - 1).bit_length())
    if bits > 60:
        raise ValueError("blocks are too small for so many words")
    runs = quotas.where("quota > 0").select("number", "start", "quota", F.explode(F.expr(f"sequence(0L, (quota - 1) div {SLOT_RUN})")).alias("run")).repartition(-(-int(slots) // SLOT_TASK) or 1, "number", "run")
    points = runs.select("number", "start", (F.col("start") + F.col("quota")).alias("stop"), F.explode(F.expr(f"sequence(start + run * {SLOT_RUN}, start + least(quota, (run + 1) * {SLOT_RUN}) - 1)")).alias("v"))
    points = points.withColumn("j", F.conv(F.reverse(F.lpad(F.bin("v"), bits, "0")), 2, 10).cast("long"))
    return points.select(F.expr(_before("j", f"{slots}L", "v", bits)).alias("slot"), "number", (F.expr(_before("j", "stop", "v", bits)) - F.expr(_before("j", "start", "v", bits))).alias("nth_block"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, block: int = BLOCK, seed: str = "tapeloom") -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, source, text), and its documents.

    Documents: (number, nth, doc_id, source, size, source_size, target), one a row of ``docs``.  Mix: (slot, offset, number, nth, doc_id, epoch, start, length):
    the words from ``start`` on of a document's whole text that lie at ``offset`` of a slot; a slot has ``block`` words, a source's last one the rest.

    A source's documents, shuffled by hash and laid end to end ``most`` times, are cut into blocks of equal words, and the schedule joins blocks by their number.
    A source gives its target, rounded, and no word more than ``most`` times.  Null texts and texts without words have size 0 and no piece; a null
    source is a source, the last one; null and repeated ids and repeated rows are documents of their own; long documents go through several
    blocks; an empty table mixes to nothing.  The same rows give the same mix, however they are partitioned; other columns don't matter.
    """
    rows = written(keyed(docs, seed), "keyed")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    listed = written(targets(sources, weights, share, most).withColumn("words", F.least(most * F.col("source_size"), F.floor(F.col("target") + 0.5))), "targets")
    placed = written(positions(rows, listed).withColumn("source", F.expr("CASE WHEN source <> '' THEN substring(source, 2) END")), "placed")
    pieces = placed.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(most)])))
    pieces = pieces.withColumn("a", F.col("epoch") * F.col("source_size") + F.col("pos")).withColumn("b", F.least(F.col("a") + F.col("size"), F.col("words"))).where("b > a")
    pieces = pieces.withColumn("nth_block", F.explode(F.expr(f"sequence(a div {block}, (b - 1) div {block})")))
    lo, hi = F.greatest("a", F.col("nth_block") * block), F.least("b", (F.col("nth_block") + 1) * block)
    pieces = pieces.select("number", "nth_block", "nth", "doc_id", "epoch", (lo - F.col("nth_block") * block).alias("offset"), (lo - F.col("a")).alias("start"), (hi - lo).alias("length"))
    # Spark can't tell how many slots a run makes, so it is told to shuffle them
    mixed = pieces.join(schedule(listed, block).hint("merge"), ["number", "nth_block"]).select("slot", "offset", "number", "nth", "doc_id", "epoch", "start", "length")
    return mixed, placed.select("number", "nth", "doc_id", "source", "size", "source_size", "target")


def taken(mixed: DataFrame, documents: DataFrame) -> DataFrame:
    """``documents`` with ``taken``, the words that the mix takes of each, repeats counted."""
    words = mixed.groupBy("number", "nth").agg(F.sum("length").alias("taken"))
    return documents.join(words, ["number", "nth"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
