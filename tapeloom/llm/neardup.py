"""Near-duplicate embeddings by collision counting over sorted one-dimensional projections.

Vectors of one label are projected on many random directions.  In each projection a pair collides if its two values lie
within a window centred on either of them; windows are found by an equality join on value buckets of the window's width.
So that a label with many vectors doesn't collide with itself, each projection also deals a label into cells by the signs of
further random directions; their number grows with the logarithm of the largest label, and that of projections with the recall asked for.
Pairs with at least ``least`` collisions are verified by their cosine in double precision.  ``plan`` derives projections and
count from the binomial distribution of collisions at the threshold, so that a pair just at it is found with probability ``recall``.

Equal vectors of a label are one class from the start, compared once and counted by their number.

Edge cases: a null label or vector, a zero vector, and one with null or non-finite components link with nothing; vectors
of different lengths don't link; ties end in the smallest id; repeated ids are separate vectors of the same id; an
empty table gives no rows; further columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, written
from .graph import components


@dataclass(frozen=True)
class Settings:
    """``window``: half-width of the windows, for unit vectors; ``cell``: vectors of a label that share a cell on average."""

    threshold: float = 0.93
    recall: float = 0.998
    window: float = 0.4
    cell: int = 64
    least: int = 3
    projections: int = 24
    seed: int = 5


@dataclass(frozen=True)
class Plan:
    signs: int
    projections: int
    least: int


def collision_probability(cosine: float, signs: int, window: float) -> float:
    """Of a pair in one projection: all signs agree, and the values differ by at most ``window``."""
    apart = math.sqrt(max(2 - 2 * cosine, 1e-12))
    return (1 - math.acos(min(1, cosine)) / math.pi) ** signs * math.erf(window / apart / math.sqrt(2))


def at_least(n: int, p: float, k: int) -> float:
    return 1 - sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k))


def plan(largest: int, s: Settings = Settings()) -> Plan:
    """Signs by the largest label, then the fewest projections that reach the recall with ``least`` collisions, then the highest count that still does."""
    signs = max(0, round(math.log2(max(1, largest) / s.cell)))
    p = collision_probability(s.threshold, signs, s.window)
    m = s.projections
    while at_least(m, p, s.least) < s.recall:
        m += 4
    least = s.least
    while at_least(m, p, least + 1) >= s.recall:
        least += 1
    return Plan(signs, m, least)


def project_batches(batches: Iterator[pa.RecordBatch], p: Plan, window: float, seed: int) -> Iterator[pa.RecordBatch]:
    directions: dict[int, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            vectors = part.column(2).to_pylist()
            for d in sorted({len(v) for v in vectors}):
                if d not in directions:
                    directions[d] = np.random.default_rng([seed, d]).normal(size=(d, p.projections * (1 + p.signs)))
                here = np.flatnonzero([len(v) == d for v in vectors])
                x = np.array([vectors[i] for i in here], np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                y = (x @ directions[d]).reshape(len(x), p.projections, 1 + p.signs)
                cell = ((y[:, :, 1:] > 0) @ (1 << np.arange(p.signs, dtype=np.int64))).astype(np.int64) if p.signs else np.zeros(y.shape[:2], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(p.projections, dtype=np.int32) + np.int32(d << 12), len(x))),
                        pc_repeat(part.column(1), here, p.projections),
                        pa.array(cell.ravel()),
                        pa.array(np.floor(y[:, :, 0].ravel() / window).astype(np.int32)),
                        pa.array(y[:, :, 0].ravel()),
                        pc_repeat(part.column(0), here, p.projections),
                    ],
                    names=["projection", "label", "cell", "bucket", "value", "id"],
                )


def pc_repeat(column: pa.Array, rows: np.ndarray, times: int) -> pa.Array:
    return column.take(pa.array(np.repeat(rows, times)))


def cosine_batches(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4000):
            part = batch.slice(at, 4000)
            keep = np.zeros(part.num_rows, bool)
            n, m = (pc.list_value_length(part.column(c)).to_numpy(zero_copy_only=False) for c in (2, 3))
            for d in np.unique(n[n == m]):
                rows = np.flatnonzero((n == d) & (m == d))
                x, y = (part.column(c).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d) for c in (2, 3))
                x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
                dot = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
                keep[rows] = dot >= threshold
            yield part.select(["a", "b"]).filter(pa.array(keep))


def classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Usable vectors, one row for each distinct one of a label: class (a number of its own, as ids may repeat), id (the smallest), label, vector, copies."""
    v = F.col("vector")
    usable = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    found = rows.where(usable).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    return written(found.withColumn("class", F.monotonically_increasing_id()), "classes")


def candidates(found: DataFrame, p: Plan, s: Settings) -> DataFrame:
    """Pairs (a, b) of classes with at least ``p.least`` collisions, found by window."""
    window, seed = s.window, s.seed
    kind = found.schema["label"].dataType.simpleString()
    rows = found.select(F.col("class").alias("id"), "label", "vector").mapInArrow(lambda b: project_batches(b, p, window, seed), f"projection int, label {kind}, cell long, bucket int, value double, id long")
    rows = rows.withColumn("lower", F.explode(F.array(F.lit(0), F.lit(1))))
    x = rows.where("lower = 0").alias("x")
    y = rows.withColumn("bucket", F.col("bucket") - F.col("lower")).alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("projection", "label", "cell", "bucket")]
    near = (F.abs(F.col("x.value") - F.col("y.value")) <= s.window) & ((F.col("y.lower") == 1) | (F.col("x.id") < F.col("y.id")))
    pairs = x.join(y, [*same, near]).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("collisions")).where(F.col("collisions") >= p.least).select("a", "b")


def find(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(members, links).  members, one row a vector: vec_id, n_links, component_id, kept.  links: (a, b), verified pairs of
    classes by their smallest ids."""
    s = settings
    shared_dir(vectors.sparkSession)
    found = classes(vectors, id_col, vector_col, label_col)
    largest = found.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    p, threshold = plan(largest, s), s.threshold
    pairs = candidates(found, p, s)
    left, right = found.select(F.col("class").alias("a"), F.col("vector").alias("x")), found.select(F.col("class").alias("b"), F.col("vector").alias("y"))
    links = written(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lambda b: cosine_batches(b, threshold), "a long, b long"), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = found.select(F.col("class").alias("b"), "copies")
    others = both.join(copies, "b").groupBy(F.col("a").alias("class")).agg(F.sum("copies").alias("others"))
    parts = written(components(links).withColumnRenamed("node", "class").join(found.select("class", "id"), "class"), "parts")
    least = parts.groupBy("component").agg(F.min("id").alias("least_id"))
    per_class = found.join(others, "class", "left").join(parts.select("class", "component"), "class", "left").join(least, "component", "left")
    per_class = per_class.select("label", "vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("least_id", "id").alias("component_id"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    out = rows.join(per_class, ["label", "vector"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    smallest = found.select("class", "id")
    by_id = links.join(smallest.toDF("a", "ida"), "a").join(smallest.toDF("b", "idb"), "b").select(F.least("ida", "idb").alias("a"), F.greatest("ida", "idb").alias("b"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")), by_id
