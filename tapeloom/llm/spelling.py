"""Grouping of spelling variants by a bit-sliced position index."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, importable, written

#: Letters at a word's start, and at its end, of which one edit leaves one end whole.
AFFIX = 3
#: Letters of words that one index holds, on average and at most twice.
INDEX_LETTERS = 80_000
#: Distinct words that a task counts before it hands them on.
COUNTED = 300_000
#: Bytes of one matrix of bitsets, queries by words.
MATRIX_BYTES = 2 << 20


def count_words(docs: DataFrame, least_length: int = 6, drop_one_in: int = 199) -> DataFrame:
    """(word, n): how often each word of at least ``least_length`` code points occurs in the whole texts of ``docs`` (doc_id, text; null: none).

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased.  A run whose crc32 of ``<doc_id>:<run>`` is a multiple of ``drop_one_in`` counts
    without its code point number crc32 % length (0: none is changed), as a mistyped one would.  Counts are combined in each task first.  A null id is empty text.
    """
    importable(docs.sparkSession)
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")  # a shorter run can't make a word

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            texts = pc.ascii_lower(batch.column(1))
            for at, doc in enumerate(batch.column(0).to_pylist()):
                text = texts[at].as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                found = Counter(runs.findall(text))
                if drop_one_in:
                    for run in [r for r in found if zlib.crc32(r.encode(), start) % drop_one_in == 0]:
                        k = zlib.crc32(run.encode(), start) % len(run)
                        n, short = found.pop(run), run[:k] + run[k + 1 :]
                        if len(short) >= least_length:
                            total[short] += n
                total.update(found)
                if len(total) >= COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
                    total = Counter()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Sliced:
    """Words of one length, the most frequent first, as a bitset over them for each (position, letter)."""

    def __init__(self, letters: np.ndarray):
        self.size, self.length = letters.shape
        codes = np.arange(self.length, dtype=np.int64) * 256 + letters
        self.codes, row = np.unique(codes, return_inverse=True)
        width = (self.size + 63) // 64
        flat = np.zeros((len(self.codes) + 1) * width * 64, bool)  # the last row is of letters that no word has there
        flat[row.reshape(codes.shape) * (width * 64) + np.arange(self.size)[:, None]] = True
        self.rows = np.packbits(flat, bitorder="little").view("<u8").reshape(-1, width)
        self.full = np.packbits(np.arange(width * 64) < self.size, bitorder="little").view("<u8")

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """For each of ``letters`` the words that have it at ``position``."""
        want = position * 256 + letters.astype(np.int64)
        k = np.minimum(np.searchsorted(self.codes, want), len(self.codes) - 1)
        return self.rows[np.where((self.codes[k] == want) & (0 <= position < self.length), k, len(self.codes))]


def near(index: _Sliced, letters: np.ndarray, apart: bool) -> np.ndarray:
    """For each query (a row of ``letters``) the words of ``index`` that differ from it by exactly one inserted, deleted or replaced letter, as a bitset.

    Two sets go along the query's letters at once: words that have matched without an error, and those with one, whose positions
    are shifted by the difference of lengths.  With ``apart`` only words that don't begin with the query's AFFIX letters count, else only those that do.
    """
    shift = index.length - letters.shape[1]
    exact = np.broadcast_to(index.full, (len(letters), len(index.full))).copy()
    once, head = np.zeros_like(exact), None
    for i in range(letters.shape[1]):
        here = index.at(i, letters[:, i])
        if shift == 0:  # replaced
            once = (once & here) | (exact & ~here)
        elif shift == 1:  # the word has one more
            once = (once | exact) & index.at(i + 1, letters[:, i])
        else:  # the word lacks this letter
            once = (once & index.at(i - 1, letters[:, i])) | exact
        exact &= here
        if i == AFFIX - 1:
            head = exact.copy()
    if shift == 1:
        once |= exact
    return once & (~head if apart else head)


def _first_bits(sets: np.ndarray) -> np.ndarray:
    """The number of the lowest bit of each row; rows have one."""
    word = (sets != 0).argmax(axis=1)
    x = sets[np.arange(len(sets)), word]
    low = x & (~x + np.uint64(1))
    return word * 64 + np.log2(low.astype(float)).astype(np.int64)


def _matrix(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def compare(cell: pd.DataFrame) -> pd.DataFrame:
    """Of one cell's words: for each asking word how many of the indexed ones are near, and the most frequent of them (ties: the smallest)."""
    apart = bool(cell["is_end"].iloc[0])
    size = cell["word"].str.len()
    asking = {k: g for k, g in cell[cell["asks"]].groupby(size)}
    out = []
    for length, own in cell[cell["indexed"]].groupby(size):
        own = own.sort_values(["n", "word"], ascending=[False, True])
        words, n = own["word"].to_numpy(), own["n"].to_numpy()
        index = _Sliced(_matrix(list(words)))
        for k in (length - 1, length, length + 1):
            if k not in asking:
                continue
            queries = asking[k]["word"].to_numpy()
            step = max(1, MATRIX_BYTES // (8 * len(index.full)))
            for at in range(0, len(queries), step):
                some = queries[at : at + step]
                sets = near(index, _matrix(list(some)), apart)
                hit = np.flatnonzero(sets.any(axis=1))
                if len(hit):
                    best = _first_bits(sets[hit])
                    out.append(pd.DataFrame({"word": some[hit], "n_near": np.bitwise_count(sets[hit]).sum(axis=1, dtype=np.int64), "best_n": n[best], "best": words[best]}))
    give_back()
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"word": pd.Series([], dtype=str), "n_near": pd.Series([], dtype="int64"), "best_n": pd.Series([], dtype="int64"), "best": pd.Series([], dtype=str)})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n; distinct, of 2 * AFFIX letters of U+0000 to U+00FF or more) that have a near one.

    Of two near words the first AFFIX letters are equal, or else the last ones, so words meet in bins by their start, where pairs of equal starts count, and in bins
    by their end, where the others do.  Bins hold about INDEX_LETTERS letters; a bin of more, as of a frequent ending, is cut into parts, and each pair of parts makes a
    cell: one part's index asked by the other part's words.  Pairs aren't given out, only their number and the best for each word.
    """
    importable(words.sparkSession)
    letters = words.agg(F.sum(F.length("word"))).first()[0] or 0
    bins = max(1, -(-int(letters) // INDEX_LETTERS))
    ends = F.array(F.struct(F.lit(False).alias("is_end"), F.substring("word", 1, AFFIX).alias("affix")), F.struct(F.lit(True).alias("is_end"), F.expr(f"right(word, {AFFIX})").alias("affix")))
    rows = words.select("word", "n", F.explode(ends).alias("e")).select("word", "n", "e.is_end", F.pmod(F.xxhash64("e.affix"), F.lit(bins)).alias("bin"))
    parts = rows.groupBy("is_end", "bin").agg(F.ceil(F.sum(F.length("word")) / (2 * INDEX_LETTERS)).cast("int").alias("parts"))
    rows = rows.join(parts, ["is_end", "bin"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    others = F.explode(F.expr("sequence(0, parts - 1)"))
    one = rows.where("parts = 1").select("is_end", "bin", F.lit(0).alias("i"), F.lit(0).alias("q"), "word", "n", F.lit(True).alias("indexed"), F.lit(True).alias("asks"))
    many = rows.where("parts > 1")
    held = many.select("is_end", "bin", F.col("part").alias("i"), others.alias("q"), "word", "n", F.lit(True).alias("indexed"), F.lit(False).alias("asks"))
    asking = many.select("is_end", "bin", others.alias("i"), F.col("part").alias("q"), "word", "n", F.lit(False).alias("indexed"), F.lit(True).alias("asks"))
    found = one.unionByName(held).unionByName(asking).groupBy("is_end", "bin", "i", "q").applyInPandas(compare, "word string, n_near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("rest"), F.col("best").alias("best"))).alias("b"))
    return best.select("word", "n_near", (-F.col("b.rest")).alias("best_n"), F.col("b.best").alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form; no cycles): where following forms ends.  Each round doubles the steps; it ends when no root has a form itself."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(ahead, "root", "left")
        roots = written(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def group(docs: DataFrame, least_length: int = 6, least_n: int = 5, times: int = 5, drop_one_in: int = 0) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row a word of ``docs`` with at least ``least_n`` occurrences.

    A word's form is the most frequent near word (ties: the smallest), if it occurs at least ``times`` as often; else null.  Its root is where following forms ends, the
    word itself if it has none.  Null and empty texts have no words; repeated rows count each; an empty table gives no rows; other columns don't matter.
    """
    if least_length < 2 * AFFIX:
        raise ValueError(f"words need at least {2 * AFFIX} code points")
    words = written(count_words(docs, least_length, drop_one_in).where(F.col("n") >= least_n), "words")
    found = words.join(near_words(words), "word", "left")
    fits = F.col("best_n") >= times * F.col("n")
    found = written(found.select("word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n")), "forms")
    roots = follow(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
