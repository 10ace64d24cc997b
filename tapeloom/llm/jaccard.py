"""Size-aware heavy-light self join of documents on the Jaccard similarity of their word n-grams.

1. A pass over the texts gives each document's shingle set (64-bit hashes) a size and a 128-bit fingerprint; documents
   of equal sets are one class from here on.  The same pass counts shingles that several sets of one task hold.
2. All sets are read in one global order: shingles not known as frequent first, then frequent ones by count; the order steers
   cost only, never the result.  Sets of n and m shingles link with an overlap of at least t = ceil(s / (1 + s) * (n + m)), and then
   share l shingles among the first n - t + l of the one and the first m - t + l of the other.  A small (light) set enumerates its
   2-subsets of its longest such prefix (l = 2); a large (heavy) one is entered in the inverted lists of its prefix (l = 1), as
   are light sets within reach of a heavy one.  Entries keep their position, so two sets meet only in lists within the prefixes of
   their own pair of sizes.  The boundary between light and heavy is the size of least estimated cost: subsets written,
   against list entries written and scanned, as often as the counted shingles that aren't read last say.
3. In each list, the set that has the list's shingle earliest in its order is compared with all others, and verified links are
   joined to components.  What a list then still holds of different components is compared pair by pair, so no link between
   components is missed, and a group of g near copies costs about g comparisons a list instead of g*g/2.  A list of a frequent
   shingle is dealt to several tasks; its earliest set is the earliest of theirs.
   Before texts are sent for it, a pair's sketches (how many of a set's shingles lie in each of RANGES ranges of hashes, or more for large sets) are held together:
   the sum of the smaller counts is at least the overlap, and where even that would be too little the pair is done.
4. Components follow from the verified links of both rounds.  The links returned are those that were needed: a subset that connects
   each component, not every pair in it.

Comparisons are made on the sets, rebuilt from the two texts.  Words and shingles are compared by 64-bit hashes of their bytes.

Edge cases: null, empty and white-space texts have empty sets, link with nothing and are their own component; texts of fewer
words than a shingle are one shingle of all words; equal texts and ties end in the smallest id; repeated ids keep one row
each; an empty table gives no rows; only id and text are read, so further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, give_back, hold, mix, shared_dir, word_slices, words_of, written
from .graph import components

SETS = "doc_id long, n long, set_id long, check long, sketch binary, shingle long, held long"
POSTINGS = "list long, set_id long, at long, key long"
#: Ranges of hashes whose shingles a sketch counts; larger sets have as many more, powers of two, as leave DENSE shingles a range at most.
RANGES, DENSE = 256, 4


@dataclass(frozen=True)
class Settings:
    """``threshold`` in hundredths.  ``local_count``: sets of one task from which on a shingle is counted; of those counted
    ``least_count`` times or more the ``frequent`` most common are read last.  ``list_rows``: counted sets of a list from which on it is dealt to
    several tasks; ``text_pairs``: pairs from which on a text is sent to several.  ``broadcast_ids``: up to so many ids are broadcast, beyond it they are joined by a shuffle."""

    words: int = 5
    threshold: int = 75
    local_count: int = 2
    least_count: int = 8
    frequent: int = 200_000
    boundaries: tuple[int, ...] = (0, 4, 8, 12, 16, 20, 24, 32, 40, 48, 64)
    list_rows: int = 2000
    text_pairs: int = 128
    broadcast_ids: int = 2_000_000


def _factor(k: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1) * (2 * k + 1)) % (1 << 64) | 1)


class Sets:
    """The sorted distinct hashes of each text's word n-grams, end to end; ``sets[i]`` is a view of text i's."""

    def __init__(self, words: Words, n: int):
        w, count = words.hashes, words.counts()
        begin = words.ends - count
        own = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        with np.errstate(over="ignore"):
            run = np.zeros(max(0, len(w) - n + 1), np.uint64)
            for k in range(n):
                run += w[k : k + len(run)] * _factor(k)
            run = mix(run + _factor(n + n))
            ends = np.cumsum(own)
            whole = count >= n
            flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
            at = np.repeat(begin[whole] - (ends - own)[whole], own[whole]) + np.flatnonzero(np.repeat(whole, own))
            flat[np.repeat(whole, own)] = run[at]
            for k in range(1, n):  # texts of k words, fewer than a shingle
                some = np.flatnonzero(count == k)
                flat[ends[some] - 1] = mix(sum((w[begin[some] + j] * _factor(j) for j in range(k)), np.zeros(len(some), np.uint64)) + _factor(n + k))
        last = 0
        for end in ends.tolist():
            flat[last:end].sort()
            last = end
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        new[(ends - own)[own > 0]] = True
        self.flat, self.ends = flat[new], np.cumsum(new)[ends - 1] * (ends > 0) if len(flat) else np.zeros(len(ends), np.int64)
        self.sizes = np.diff(self.ends, prepend=0)

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] - self.sizes[i] : self.ends[i]]


def least_overlap(n: int, threshold: int) -> int:
    return -(-threshold * n // 100)


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= threshold * (len(a) + len(b) - common)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    raw = s.tobytes()
    return xxhash.xxh3_64_intdigest(raw), xxhash.xxh64_intdigest(raw)


def sketched(sets: Sets) -> list[bytes]:
    """Of each set, its shingles by range; 255 stands for that many or more."""
    where = np.repeat(np.arange(len(sets)), sets.sizes) * RANGES + (sets.flat >> np.uint64(56)).astype(np.int64)
    counts = np.bincount(where, minlength=len(sets) * RANGES).reshape(len(sets), RANGES)
    out = [r.tobytes() for r in np.minimum(counts, 255).astype(np.uint8)]
    for i in np.flatnonzero(sets.sizes > DENSE * RANGES).tolist():
        bits = (-(-int(sets.sizes[i]) // DENSE) - 1).bit_length()
        counts = np.bincount((sets[i] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        out[i] = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return out


def most_common(x: bytes, y: bytes) -> int:
    """The most shingles that sets of these sketches can share; of the finer one, neighbouring ranges are taken together."""
    a, b = (np.frombuffer(v, np.uint8) for v in (x, y))
    if (a == 255).any() or (b == 255).any():
        return 1 << 40
    n = min(len(a), len(b))
    return int(np.minimum(a.reshape(n, -1).sum(1, dtype=np.int64), b.reshape(n, -1).sum(1, dtype=np.int64)).sum())


def possible_batches(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose sketches allow enough overlap."""
    for batch in batches:
        column = {c: batch.column(batch.schema.get_field_index(c)) for c in ("n_a", "n_b", "sketch_a", "sketch_b")}
        both = column["n_a"].to_numpy() + column["n_b"].to_numpy()
        x, y = (column[c].to_pylist() for c in ("sketch_a", "sketch_b"))
        most = np.fromiter(map(most_common, x, y), np.int64, len(x))
        yield batch.select(["a", "b"]).filter(pa.array(100 * most >= threshold * (both - most)))


def signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def set_batches(batches: Iterator[pa.RecordBatch], words: int, local_count: int, flush: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows of SETS: one for each document, and one for each shingle that several different sets of this task hold."""
    names = [x.split()[0] for x in SETS.split(", ")]
    hold("jaccard")
    seen: set[int] = set()
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        s, c = np.unique(np.concatenate(held) if held else np.empty(0, np.uint64), return_counts=True)
        s, c = s[c >= local_count], c[c >= local_count]
        none = pa.nulls(len(s), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(s), pa.binary()), pa.array(s.view(np.int64)), pa.array(c.astype(np.int64))], names=names)

    for batch, text in word_slices(batches):
        sets = Sets(text, words)
        marks = [fingerprint(sets[i]) for i in range(len(sets))]
        for i, (x, _) in enumerate(marks):
            if x not in seen:
                seen.add(x)
                held.append(sets[i])
        none = pa.nulls(len(sets), pa.int64())
        sketches = pa.array(sketched(sets), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets.sizes), signed([x for x, _ in marks]), signed([y for _, y in marks]), sketches, none, none], names=names)
        if sum(map(len, held)) > flush:
            yield counted()
            held = []
    yield counted()


class Order:
    """The global order of shingles: not frequent before frequent, these by count, ties by hash."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray):
        at = np.argsort(frequent)
        self.frequent, self.counts = frequent[at], counts[at]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.frequent >> np.uint64(42)] = True

    def count(self, h: np.ndarray) -> np.ndarray:
        """Sets that were counted with each shingle, 0 for those not frequent."""
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(self.maybe[h >> np.uint64(42)])
        if len(some):
            at = np.minimum(np.searchsorted(self.frequent, h[some]), len(self.frequent) - 1)
            out[some] = np.where(self.frequent[at] == h[some], self.counts[at], 0)
        return out


def keys_of(s: np.ndarray, held: np.ndarray, threshold: int, boundary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists that a set enters, the position that each entry counts with, and how many sets were counted with it.  ``held``: of each shingle, in how many
    sets it was counted.  A pair of sets of n and m that links meets in a list where both positions are at most their size less the pair's overlap."""
    n = len(s)
    t = least_overlap(n, threshold)
    if held.any():
        first = np.argsort(held, kind="stable")[: n - t + 2]
        s, held = s[first], held[first]
    else:
        s, held = s[: n - t + 2], held[: n - t + 2]
    keys, at, counts = [], [], []
    if n < boundary and t >= 2:
        i, j = np.triu_indices(len(s), 1)
        with np.errstate(over="ignore"):
            keys.append(mix(mix(np.minimum(s[i], s[j])) + np.maximum(s[i], s[j])))
        at.append(j - 1), counts.append(np.minimum(held[i], held[j]))
    if 100 * n >= threshold * boundary or t < 2:
        keys.append(s[: n - t + 1])
        at.append(np.arange(len(keys[-1]))), counts.append(held[: n - t + 1])
    return np.concatenate(keys), np.concatenate(at), np.concatenate(counts)


def posting_batches(batches: Iterator[pa.RecordBatch], order: Order, words: int, threshold: int, boundary: int, list_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of POSTINGS, once for each distinct set of this task: the list, and the size and position in one number.  Where a list is dealt to several tasks, these are lists of their own, and ``key`` says of which they are parts."""
    hold("jaccard")
    seen: set[int] = set()
    for _, text in word_slices(batches):
        sets = Sets(text, words)
        held = order.count(sets.flat)
        entries, ids, sizes = [], [], []
        for i in range(len(sets)):
            s = sets[i]
            x, _ = fingerprint(s)
            if not len(s) or x in seen:
                continue
            seen.add(x)
            entries.append(keys_of(s, held[sets.ends[i] - len(s) : sets.ends[i]], threshold, boundary))
            ids.append(x), sizes.append(len(s))
        if entries:
            keys, at, counts = (np.concatenate(x) for x in zip(*entries))
            times = [len(k) for k, _, _ in entries]
            ids = np.repeat(np.array(ids, np.uint64), times)
            at += np.repeat(np.array(sizes, np.int64), times) << 32
            parts = (1 + counts // list_rows).astype(np.uint64)
            with np.errstate(over="ignore"):
                lists = np.where(parts > 1, mix(keys + mix(ids) % parts), keys)
            columns = [pa.array(lists.view(np.int64)), pa.array(ids.view(np.int64)), pa.array(at), pa.array(keys.view(np.int64), mask=parts == 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in POSTINGS.split(", ")])


def within(a: str, b: str, threshold: int) -> Column:
    """Whether entries (n, pos) of two sets are both in the prefixes of their pair of sizes."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    overlap = F.ceil((n + m) * threshold / (100 + threshold))
    return (F.col(f"{a}pos") <= n - overlap) & (F.col(f"{b}pos") <= m - overlap)


def linked_batches(batches: Iterator[pa.RecordBatch], words: int, threshold: int) -> Iterator[pa.RecordBatch]:
    hold("jaccard")
    for batch, text in word_slices(batches, "text_b"):
        column = {c: batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "text_a")}
        a, b = (column[c].to_numpy().view(np.uint64).tolist() for c in "ab")
        turns = [i for i in range(len(a)) if i == 0 or a[i] != a[i - 1] or column["text_a"][i] != column["text_a"][i - 1]]
        left, right = Sets(words_of(column["text_a"].take(pa.array(turns)).cast(pa.large_binary()).to_pylist()), words), Sets(text, words)
        keep, k = [], -1
        for i in range(len(a)):
            if k + 1 < len(turns) and turns[k + 1] == i:
                k += 1
                named = fingerprint(left[k])[0]
            # where ids repeat, an id's other texts have come along too
            keep.append(named == a[i] and fingerprint(right[i])[0] == b[i] and similar(left[k], right[i], threshold))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def boundary_of(sets: DataFrame, counted: DataFrame, last: int, s: Settings) -> int:
    """The size below which enumerating 2-subsets is estimated cheaper than list entries and their scans.  An entry is written by each task that has its set, and
    scanned with its list: of those shingles counted less than ``last`` times, and so not read last, the lists' lengths are known."""
    n, t = F.col("n"), F.ceil(F.col("n") * s.threshold / 100)
    subsets, entries = (n - t + 2) * (n - t + 1) / 2, n - t + 1
    row = sets.where("n > 0").agg(F.sum("n").alias("all"), *[F.coalesce(F.sum(F.when(n < x, subsets)), F.lit(0.0)).alias(f"light{x}") for x in s.boundaries], *[F.coalesce(F.sum(F.when(n * 100 >= s.threshold * x, entries)), F.lit(0.0)).alias(f"heavy{x}") for x in s.boundaries]).first()
    lists = counted.where(F.col("held") < last).agg(F.sum(F.col("held") * F.col("held"))).first()[0]
    scan = 1 + float(lists or 0) / float(row["all"] or 1)
    return min(s.boundaries, key=lambda x: (row[f"light{x}"] + scan * float(row[f"heavy{x}"]), x))


def dealt(pairs: DataFrame, text: DataFrame, side: str, other: str, s: Settings) -> DataFrame:
    """``pairs`` with the text of the set in column ``side``; a set in many pairs has its text sent to several tasks, each with some of them."""
    named = text.select(F.col("set_id").alias(side), F.col("text").alias(f"text_{side}"))
    many = written(pairs.groupBy(side).count().where(F.col("count") > s.text_pairs).select(side, F.ceil(F.col("count") / s.text_pairs).cast("int").alias("parts")), "many")
    n = many.count()
    if not n:
        return pairs.join(named, side)
    many = F.broadcast(many) if n <= s.broadcast_ids else many
    one = F.coalesce("parts", F.lit(1))
    pairs = pairs.join(many, side, "left").withColumn("part", F.pmod(F.xxhash64(other), one).cast("int")).drop("parts")
    named = named.join(many, side, "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    return pairs.join(named, [side, "part"]).drop("part")


def possible(pairs: DataFrame, sketches: DataFrame, s: Settings) -> DataFrame:
    """Of pairs (a, b) of set ids, those that their sketches don't rule out."""
    held, threshold = F.struct("n", "sketch"), s.threshold
    known = sketches.select("set_id", held.alias("text"))
    both = dealt(dealt(pairs, known, "b", "a", s), known, "a", "b", s).select("a", "b", *[F.col(f"text_{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in ("n", "sketch")])
    return written(both.mapInArrow(lambda x: possible_batches(x, threshold), "a long, b long"), "possible")


def verified(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Of pairs (a, b) of set ids, those whose texts' sets are similar enough.  ``texts``: (set_id, doc_id of one document with that set, text by doc_id)."""
    ids = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = written(ids.join(texts[0], "set_id"), "wanted")
    small = wanted.count() <= s.broadcast_ids
    text = texts[1].join(F.broadcast(wanted) if small else wanted, "doc_id").select("set_id", "text")
    both = dealt(dealt(pairs, text, "b", "a", s), text, "a", "b", s)
    words, threshold = s.words, s.threshold
    return both.select("a", "b", "text_a", "text_b").mapInArrow(lambda x: linked_batches(x, words, threshold), "a long, b long")


def join(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links).  members: doc_id, n_shingles, set_id, representative (the smallest id with the same set), and component_id.
    links: (a, b), pairs of representatives that are verified links and join all members of each component."""
    s = settings
    spark = docs.sparkSession
    shared_dir(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words, local_count, threshold = s.words, s.local_count, s.threshold
    found = written(rows.mapInArrow(lambda b: set_batches(b, words, local_count), SETS), "sets")
    sets = found.where("shingle is null").select("doc_id", "n", "set_id", "check")
    counted = written(found.where("shingle is not null").groupBy("shingle").agg(F.sum("held").alias("held")), "counted")
    common = counted.where(F.col("held") >= s.least_count).orderBy(F.desc("held"), "shingle").limit(s.frequent).toArrow()
    order = spark.sparkContext.broadcast(Order(common["shingle"].to_numpy().view(np.uint64), common["held"].to_numpy()))
    last = int(common["held"].to_numpy().min()) + 1 if len(common) == s.frequent else s.least_count
    del common
    give_back()
    boundary, list_rows = boundary_of(sets, counted, last, s), s.list_rows
    postings = rows.mapInArrow(lambda b: posting_batches(b, order.value, words, threshold, boundary, list_rows), POSTINGS)

    by_list = Window.partitionBy("list")
    entry = F.struct(F.col("at").bitwiseAND(0xFFFFFFFF).alias("pos"), "set_id", "at")
    lists = postings.withColumn("first", F.min(entry).over(by_list)).withColumn("low", F.min("set_id").over(by_list)).withColumn("high", F.max("set_id").over(by_list))
    lists = written(lists.where("low <> high or key is not null").select("list", "key", "set_id", "at", "first"), "lists")
    split = lists.where("key is not null").groupBy("key").agg(F.min("first").alias("first"))
    whole = lists.where("key is null").withColumn("key", F.col("list"))
    lists = whole.unionByName(lists.where("key is not null").drop("first").join(F.broadcast(split) if split.count() <= s.broadcast_ids else split, "key"))

    def place(at: Column, name: str) -> list[Column]:
        return [F.shiftright(at, 32).alias(f"{name}n"), at.bitwiseAND(0xFFFFFFFF).alias(f"{name}pos")]

    lists = lists.select("key", "set_id", *place(F.col("at"), ""), F.col("first.set_id").alias("first_id"), *place(F.col("first.at"), "first_"))
    distinct = found.where("n > 0").groupBy("set_id", "check").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    representatives = written(distinct, "representatives")
    texts = representatives.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")), rows
    sketches = representatives.groupBy("set_id").agg(F.first(F.struct("n", "sketch")).alias("x")).select("set_id", "x.n", "x.sketch")

    stars = lists.where((F.col("set_id") != F.col("first_id")) & within("", "first_", threshold)).select(F.col("first_id").alias("a"), F.col("set_id").alias("b")).distinct()
    stars = written(stars, "stars")
    links = written(verified(possible(stars, sketches, s), texts, s), "links")
    label = components(links)
    near = written(lists.join(label.withColumnRenamed("node", "set_id"), "set_id", "left").select("key", "set_id", "n", "pos", F.coalesce("component", "set_id").alias("component")).distinct(), "near")
    mixed = near.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    left = near.join(mixed, "key", "left_semi")
    x, y = left.alias("x"), left.alias("y")
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & within("x.", "y.", threshold)).select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    more = written(verified(possible(rest, sketches, s), texts, s), "links")
    links = links.unionByName(more)

    # different sets that rows of one id have are one component too; it is named by the smallest id of its sets
    shared = sets.where("n > 0").groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("z")).where("a <> z").select("doc_id", "a")
    same = sets.where("n > 0").join(shared, "doc_id").select("a", F.col("set_id").alias("b"))
    label = components(links.unionByName(same)).withColumnRenamed("node", "set_id")
    names = texts[0]
    labelled = names.join(label, "set_id")
    named = labelled.join(labelled.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("set_id", "component_id")
    members = sets.join(representatives.select("set_id", "check", F.col("doc_id").alias("representative")), ["set_id", "check"], "left").join(named, "set_id", "left")
    members = members.withColumn("representative", F.coalesce("representative", "doc_id"))
    pairs = links.join(names.select(F.col("set_id").alias("a"), F.col("doc_id").alias("name_a")), "a").join(names.select(F.col("set_id").alias("b"), F.col("doc_id").alias("name_b")), "b")
    members = members.select("doc_id", F.col("n").alias("n_shingles"), "set_id", "representative", F.coalesce("component_id", "representative").alias("component_id"))
    return members, pairs.select(F.col("name_a").alias("a"), F.col("name_b").alias("b"))


def keep_first(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, in all their columns, whose document is the first of its component, each text of an id once.  A row without an id counts as one with an id
    after all others, which equal texts share."""
    key = next(f"key{k}" for k in range(len(docs.columns) + 1) if f"key{k}" not in docs.columns)
    named = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(text_col), F.lit(1 << 61))))
    members, _ = join(named, settings, key, text_col)
    # of each id, how many of its rows are first; texts stay where they are, unless too many ids are left out to be told to every task
    firsts = members.groupBy(F.col("doc_id").alias(key)).agg(F.count(F.when(F.col("doc_id") == F.col("component_id"), 1)).alias("count"))
    others = written(firsts.where("count <> 1"), "others")
    small = others.count() <= settings.broadcast_ids
    out, more = ((F.broadcast(x) if small else x) for x in (others.select(key), others.where("count > 1").select(key)))
    single = named.join(out, key, "left_anti")
    several = named.join(more, key, "left_semi").dropDuplicates([key, text_col])
    return single.unionByName(several).select(*docs.columns)
