"""Helpers that several operators share: text batches, shared scratch tables, word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text that one slice of an Arrow batch holds at most (a longer single text makes a slice of its own).
SLICE_BYTES = 2 << 20
#: Spark's bound of an Arrow batch, and what an executor with little memory beside its heap stands (a longer row makes a batch of its own).
BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Spark send texts to Python workers by BATCH_BYTES, unless the session has a bound of its own.

    By default a batch is a whole file split; while it is written it lies outside the executor's heap more than once, and in the worker too.
    """
    if spark.conf.get(BATCH_BOUND, None) is None:
        spark.conf.set(BATCH_BOUND, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset a temporary one, in local mode only (tests)."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir")
    if not where:
        where = getattr(sc, "_tapeloom_dir", None)
        if not where:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            where = sc._tapeloom_dir = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives the loss of executors, is removed at the session's end."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Each batch in runs of rows of about SLICE_BYTES, with the UTF-8 bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type):
            col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
        sizes = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=float))
        part = (np.cumsum(sizes) // SLICE_BYTES).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a), col.slice(a, b - a).to_pylist()
    give_back()


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a run of texts, A-Z lower-cased, as 64-bit hashes end to end; text i has those from ``ends[i-1]`` to ``ends[i]``.

    Hashes are made from the texts' bytes as they lie in memory, eight at a time, without an object a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = np.frombuffer(data.tobytes().lower() + bytes(8), np.uint8)
        n = len(data) - 8
        space = _IS_SPACE[data[:n]]
        edge = np.empty(n + 1, bool)  # whether a word can't go on across the place before each byte
        edge[0] = edge[n] = True
        edge[1:n] = space[1:] | space[:-1]
        edge[offsets] = True
        inside = ~space
        starts = np.flatnonzero(inside & edge[:n])
        stops = np.flatnonzero(inside & edge[1:]) + 1
        self.ends = np.searchsorted(starts, offsets[1:])
        self.hashes = _hashed(data, starts, stops - starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word from which on it is hashed on its own.
_LONG = 256


def _hashed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    with np.errstate(over="ignore"):
        h = mix((eights[starts] & _KEEP[np.minimum(sizes, 8)]) + sizes.astype(np.uint64) * _ODD)
        at, k = np.flatnonzero(sizes > 8), 8
        while len(at):
            rest = sizes[at] - k
            h[at] = mix(h[at] * _ODD + (eights[starts[at] + k] & _KEEP[np.minimum(rest, 8)]))
            k += 8
            at = at[rest > 8]
            if k > _LONG:
                break
    for i in at.tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return h


def word_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Each batch in runs of rows of about a megabyte of text, with the words of ``column`` (null: none)."""
    for batch in batches:
        if batch.num_rows:
            yield from ((batch.slice(a, b - a), Words(data, offsets)) for a, b, data, offsets in _flat(batch.column(batch.schema.get_field_index(column))))
    give_back()


def words_of(texts: list[bytes | None]) -> Words:
    data = [t or b"" for t in texts]
    return Words(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def _flat(col: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    col = pc.fill_null(col.cast(pa.large_binary() if wide else pa.binary()), b"")
    _, at, data = col.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    part = (offsets[1:] - offsets[0]) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(col)]
    for a, b in zip(edges, edges[1:]):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


_HELD: dict[str, Callable[[], object]] = {}


def hold(name: str, forget: Callable[[], object] = lambda: None) -> None:
    """Say that operator ``name`` works in this process now: what others have remembered here goes back to the system first.

    Spark keeps Python workers for the next job, so without this a pipeline would pile up every stage's memory.
    """
    others = [n for n in _HELD if n != name]
    for n in others:
        _HELD.pop(n)()
    _HELD[name] = forget
    if others:
        give_back()


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a task's Python worker, idle, beside the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Numbered(dict):
    """key -> its number by order of first lookup; ``new`` has the keys numbered since it was last emptied."""

    def __init__(self) -> None:
        self.new: list = []

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


def numbers(keys: list, known: Numbered) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shifts and odd multipliers)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i]:starts[i]+lengths[i]]`` for each i of ``which``, end to end."""
    n = lengths[which]
    ends = np.cumsum(n)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[which] - (ends - n), n)
    return flat[at]


def crc_bucket(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``: fixes which rows are held out."""
    return F.crc32(F.col(column).cast("string")) % modulus


#: A long text is trained on in runs of about this length.
RUN_BYTES = 400
_SPACE = re.compile(rb"\s")


def runs_of(text: bytes, limit: int) -> bytes:
    """``text``; where it is longer than ``limit`` bytes, runs of its words from all over it, chosen by hash, in their order."""
    if len(text) <= limit:
        return text
    cuts = [0]
    for at in range(RUN_BYTES, len(text), RUN_BYTES):
        space = _SPACE.search(text, at, at + RUN_BYTES)
        while not space and at < len(text) and text[at] & 0xC0 == 0x80:  # without white space, between two characters
            at += 1
        cuts.append(space.end() if space else at)
    cuts.append(len(text))
    order = sorted(range(len(cuts) - 1), key=lambda k: xxhash.xxh64_intdigest(text[cuts[k] : cuts[k + 1]], k))
    chosen, room = [], limit
    for k in order:
        room -= cuts[k + 1] - cuts[k] + 1
        if room < 0 and chosen:
            break
        chosen.append(k)
    chosen.sort()
    return b"".join(text[cuts[k] : cuts[k + 1]] + (b"" if k + 1 == after else b" ") for k, after in zip(chosen, [*chosen[1:], -1]))


def fair_share(sizes: list[int], total: int, most: int) -> int:
    """The largest limit up to ``most`` at which texts of ``sizes``, each cut to it, have ``total`` bytes at most."""
    left, rest = total, sorted(sizes)
    for k, size in enumerate(rest):
        if min(size, most) * (len(rest) - k) > left:
            return left // (len(rest) - k)
        left -= min(size, most)
    return most


def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        limits = batch.column(batch.schema.get_field_index("most")).to_pylist()
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array([runs_of(t, m) for t, m in zip(texts, limits)], pa.binary()))


def training_sample(keys: DataFrame, texts: DataFrame, rows: int, text_bytes: int, group_bytes: int, same: Column | None = None):
    """A pandas table (id, grp, text, lang), one row an id, of at most ``rows`` ids of each group: the lowest by a hash of the id.

    ``keys`` has id, unique, with its grp and the size of its text in bytes; ``texts`` has id, text, lang, and ``same`` says which of an id's rows
    is meant, besides that size.  A text over ``text_bytes``, or over its fair share of ``group_bytes``, comes as runs of words from all over it,
    cut in the tasks, so that no length keeps a text out and only the bounded sample reaches the driver.
    """
    by = Window.partitionBy("grp").orderBy("h", "id")
    ranked = keys.withColumn("h", F.xxhash64("id")).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= rows)
    chosen = ranked.select("id", "grp", "size").collect()
    sizes: dict = {}
    for r in chosen:
        sizes.setdefault(r.grp, []).append(r.size)
    most = {g: fair_share(s, group_bytes, text_bytes) for g, s in sizes.items()}
    types = dict(keys.dtypes)
    limits = keys.sparkSession.createDataFrame([(r.id, r.grp, r.size, most[r.grp]) for r in chosen], f"id {types['id']}, grp {types['grp']}, size int, most int")
    found = texts.join(F.broadcast(limits), "id").where(F.octet_length("text") == F.col("size"))
    if same is not None:
        found = found.where(same)
    found = found.select("id", "grp", "text", "lang", "most").mapInArrow(run_batches, f"id {types['id']}, grp {types['grp']}, text binary, lang string, most int")
    return found.groupBy("id").agg(F.min(F.struct("text", "grp", "lang")).alias("x")).select("id", "x.grp", "x.text", "x.lang").toArrow().to_pandas().sort_values("id")
