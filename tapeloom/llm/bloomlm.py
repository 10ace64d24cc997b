"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Each task counts its training texts' words and word pairs and deals the sorted counts, as binary runs, to blocks of the hash
space; a block sums its runs and is built into a filter of its own size.  Counts are quantised: a count c has level
1 + floor(log2 c), and an n-gram enters the filter once for each level up to its own.  Probing levels upward until the first
miss gives the level back, so a count is known to lie from 2^(level-1) to 2^level - 1.

The probability of a word after another is the pair's share of its context, interpolated with the word's own share by how well
the context is known.  All counts in it come from membership probes; n-grams count with the least and contexts with the most that their level
allows, so the probabilities after a context add up to one at most (but for false hits of the filter).  The base score uses exact word counts, kept by block as sorted hashes.

Up to ``broadcast_bytes``, of the training texts and of the blocks, measured beforehand, all blocks go to every worker.  Beyond it the n-grams travel instead: texts are dealt to chunks
by hash, each chunk's distinct n-grams go to the blocks with their counts, a block builds its filter from the counts and probes it once for each of its distinct n-grams, and the answers
go back to the chunks, which are scored from them.  Each is one shuffle in proportion to the texts, at any size, with one block or one chunk in memory; both ways give the same rows.

Edge cases: null and empty texts are the end token alone; a text is scored whole; equal texts get equal scores; repeated and null ids stay
rows of their own; without training texts every count is 0; an empty table gives no rows; only id, text and the training condition are read, so further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, give_back, hold, mix, shared_dir, small_batches, word_slices, written

SCHEMA = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
RUNS = "block int, words binary, word_counts binary, pairs binary, pair_counts binary"
BLOCKS = "block int, total long, distinct long, size long, field binary, known binary, counts binary, many binary, many_counts binary"
#: Of a block: the filter, its words' hashes and counts in a byte, and the words that occur OFTEN times or more with their counts.
PARTS = {"field": np.uint8, "known": np.uint64, "counts": np.uint8, "many": np.uint64, "many_counts": np.int64}
OFTEN = 255
#: A part is a range of a block's hashes.  Sorted hashes go as their LOW_BYTES, with how many of them (``spread``) have each value of the bits above these.
ASKED = "block int, part int, chunk long, words binary, word_spread binary, word_counts binary, pairs binary, pair_spread binary, pair_counts binary"
LOW_BYTES = 6
ANSWERS = "chunk long, part int, total long, distinct long, levels binary, exact binary, pair_levels binary"
#: Bytes that a text counts besides its own when texts are dealt to chunks.
ROW_BYTES = 32
#: Hashes of the two tokens that no word can be: words hold no white space.
START, END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b" start", b" end"))


@dataclass(frozen=True)
class Settings:
    """``bits`` and ``probes``: of the filter, for each level of each n-gram.  ``trust``: occurrences of a context at which its pairs weigh half.
    ``block_bytes``: training text a block of the hash space, of which there are 2^``least_blocks`` at least.  ``broadcast_bytes``: of a model that is broadcast, and of its
    training texts.  ``chunk_bytes``, ``part_bytes``: text whose n-grams a chunk asks for, and a part of a block brings together at once."""

    bits: int = 8
    probes: int = 4
    trust: float = 60.0
    broadcast_bytes: int = 128 << 20
    block_bytes: int = 128 << 20
    least_blocks: int = 10
    chunk_bytes: int = 6 << 20
    part_bytes: int = 10 << 20


def tokens_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts end to end: their tokens, the token before each, and where each text ends."""
    ends = words.ends + np.arange(1, len(words.ends) + 1)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    word = np.ones(len(flat), bool)
    word[ends - 1] = False
    flat[word], flat[~word] = words.hashes, END
    before = np.concatenate([[START], flat[:-1]])[: len(flat)]
    before[ends[:-1]] = START
    return flat, before, ends


def pair_hashes(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(before) + tokens)


def cuts(h: np.ndarray, block_bits: int) -> np.ndarray:
    """Where each block of the hash space begins and the last ends in sorted hashes."""
    return np.concatenate([np.searchsorted(h, np.arange(1 << block_bits, dtype=np.uint64) << np.uint64(64 - block_bits)), [len(h)]])


def by_block(columns: list[list[bytes]], schema: str) -> pa.RecordBatch:
    """A row for each block that has any bytes."""
    some = np.flatnonzero(np.any([[len(x) > 0 for x in c] for c in columns], axis=0))
    arrays = [pa.array(some.astype(np.int32)), *[pa.array([c[i] for i in some], pa.binary()) for c in columns]]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])


def count_batches(batches: Iterator[pa.RecordBatch], block_bits: int, flush: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows of RUNS: this task's counts of words and of word pairs, by block and sorted."""
    hold("bloomlm")
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def counted() -> pa.RecordBatch:
        columns = []
        for part in zip(*held):
            h, n = np.unique(np.concatenate(part), return_counts=True)
            at = cuts(h, block_bits).tolist()
            n = n.astype(np.uint32)
            columns += [[x[a:b].tobytes() for a, b in zip(at, at[1:])] for x in (h, n)]
        held.clear()
        return by_block(columns, RUNS)

    size = 0
    for _, words in word_slices(batches):
        tokens, before, ends = tokens_of(words)
        held.append((np.concatenate([np.full(len(ends), START), tokens]), pair_hashes(before, tokens)))
        size += len(tokens)
        if size > flush:
            yield counted()
            size = 0
    if held:
        yield counted()


def levels_of(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1]  # the exponent: 1 for 1, 2 for 2 and 3, 3 for 4 to 7


def spots(h: np.ndarray, level, probe: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(level, np.uint64) * np.uint64(64) + np.uint64(probe + 1)))


def summed(h: np.ndarray, n: np.ndarray, places: bool = False) -> tuple[np.ndarray, ...]:
    """Sorted distinct hashes with the sums of their counts, and where each of ``h`` is among them if asked for."""
    order = np.argsort(h)
    h, n = h[order], n[order].astype(np.int64)
    new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
    first = np.flatnonzero(new)
    out = h[first], np.add.reduceat(n, first) if len(first) else n
    if not places:
        return out
    at = np.empty(len(h), np.int32)
    at[order] = np.cumsum(new) - 1
    return *out, at


def field_of(h: np.ndarray, n: np.ndarray, g: np.ndarray, m: np.ndarray, bits: int, probes: int) -> tuple[int, np.ndarray]:
    """Of a block with words ``h`` and pairs ``g``, counted ``n`` and ``m`` times: its filter's bits, and their number."""
    all_h, levels = np.concatenate([h, g]), np.concatenate([levels_of(n), levels_of(m)])
    at = np.repeat(np.arange(len(all_h)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    size = -(-len(at) * bits // 64) * 64
    field = np.zeros(size, bool)
    for j in range(probes):
        field[(spots(all_h[at], level, j) % np.uint64(max(size, 1))).astype(np.int64)] = True
    return size, np.packbits(field)


def build_batches(batches: Iterator[pa.RecordBatch], bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Rows of BLOCKS, from a partition that has all runs of its blocks, in block order."""

    def built(block: int, words: list, pairs: list) -> pa.RecordBatch:
        (h, n), (g, m) = (summed(*(np.frombuffer(b"".join(x), t) for x, t in zip(zip(*runs), (np.uint64, np.uint32)))) for runs in (words, pairs))
        size, field = field_of(h, n, g, m, bits, probes)
        real = h != START
        h, n = h[real], n[real]
        parts = field, h, np.minimum(n, OFTEN).astype(np.uint8), h[n >= OFTEN], n[n >= OFTEN]
        row = [block, int(n.sum()), len(h), size, *[x.tobytes() for x in parts]]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * len(parts)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[x.split()[0] for x in BLOCKS.split(", ")])

    now, words, pairs = None, [], []
    for batch in batches:
        for block, *run in zip(*(c.to_pylist() for c in batch.columns)):
            if now is not None and block != now:
                yield built(now, words, pairs)
                words, pairs = [], []
            now = block
            words.append(run[:2]), pairs.append(run[2:])
    if now is not None:
        yield built(now, words, pairs)


def looked_up(known: np.ndarray, values: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, values[at], 0).astype(np.int64)


class Filter:
    """Blocks of the hash space laid end to end: levels by membership probes, and exact counts of words."""

    def __init__(self, blocks: list[tuple[int, int, dict]], block_bits: int, probes: int):
        """``blocks``: number, size in bits, and PARTS as bytes or buffers."""
        self.block_bits, self.probes = block_bits, probes
        self.size, self.start = np.zeros(1 << block_bits, np.uint64), np.zeros(1 << block_bits, np.int64)
        blocks, at = sorted(blocks, key=lambda b: b[0]), 0
        for block, size, _ in blocks:
            self.size[block], self.start[block] = size, at
            at += size
        for name, kind in PARTS.items():
            setattr(self, name, np.concatenate([np.empty(0, kind), *[np.frombuffer(b[2][name], kind) for b in blocks]]))

    def level(self, h: np.ndarray) -> np.ndarray:
        block = (h >> np.uint64(64 - self.block_bits)).astype(np.int64)
        size, start = self.size[block], self.start[block]
        level = np.zeros(len(h), np.uint8)
        alive = np.flatnonzero(size > 0)
        k = 0
        while len(alive):
            k += 1
            for j in range(self.probes):
                at = start[alive] + (spots(h[alive], k, j) % size[alive]).astype(np.int64)
                alive = alive[(self.field[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1) > 0]
            level[alive] = k
        return level

    def exact(self, h: np.ndarray) -> np.ndarray:
        found = looked_up(self.known, self.counts, h)
        often = np.flatnonzero(found == OFTEN)
        found[often] = looked_up(self.many, self.many_counts, h[often])
        return found

    def answer(self, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Levels and exact counts of words, levels of pairs."""
        return self.level(h), self.exact(h), self.level(g)


@dataclass(frozen=True)
class Corpus:
    """``total`` and ``distinct``: tokens of the training texts."""

    total: int
    distinct: int
    settings: Settings


def distinct_grams(tokens: np.ndarray, before: np.ndarray, ends: np.ndarray):
    """What score needs of tokens: sorted distinct words (with the start) and pairs, where each token's are, and where texts end."""
    h, back = np.unique(np.concatenate([[START], tokens]), return_inverse=True)
    g, pair = np.unique(pair_hashes(before, tokens), return_inverse=True)
    context = np.concatenate([[back[0]], back[1:-1]])[: len(tokens)]
    context[ends[:-1]] = back[0]
    return h, g, back[1:], context, pair, ends


def score_texts(tokens: tuple[np.ndarray, np.ndarray, np.ndarray], corpus: Corpus, answer: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Of each text: tokens, known tokens, base and model log10 probabilities."""
    h, g, word, context, pair, ends = distinct_grams(*tokens)
    level, exact, pair_level = answer(h, g)
    room = corpus.total + corpus.distinct + 1
    least, most = np.where(level > 0, 2.0 ** (level - 1.0), 0), 2.0**level - 1
    own, weight = (least + 1) / room, most / (most + corpus.settings.trust)
    share = np.where(pair_level > 0, 2.0 ** (pair_level - 1.0), 0)[pair] / np.maximum(most[context], 1)
    model = np.log10(weight[context] * np.minimum(share, 1) + (1 - weight[context]) * own[word])
    sums = [exact > 0, np.log10((exact + 1) / room)]
    begins = np.concatenate([[0], ends[:-1]])[: len(ends)]
    # a text's own sums, wherever it stands in the slice
    return [ends - begins, *[np.add.reduceat(x, begins) if len(begins) else x for x in (sums[0][word].astype(np.int64), sums[1][word], model)]]


def scored_batch(ids: pa.Array, sums: list[np.ndarray], total: int) -> pa.RecordBatch:
    n, known, base, score = sums
    columns = [ids, pa.array(n), pa.array(known), pa.array(np.full(len(n), total)), pa.array(base), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])


def score_batches(batches: Iterator[pa.RecordBatch], model: tuple[Corpus, Filter]) -> Iterator[pa.RecordBatch]:
    hold("bloomlm")
    corpus, grams = model
    for batch, words in word_slices(batches):
        yield scored_batch(batch.column(0), score_texts(tokens_of(words), corpus, grams.answer), corpus.total)


def runs_array(x: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values: the runs of the rows of ``x`` between places ``at``."""
    x = np.ascontiguousarray(x)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * x.strides[0]).astype(np.int32)), pa.py_buffer(x)])


def packed(h: np.ndarray, part_bits: int) -> list[pa.Array]:
    """Sorted distinct hashes by part: their low bytes, and their spread over the bits above these."""
    bits = max(part_bits, 64 - 8 * LOW_BYTES)
    spread = np.diff(cuts(h, bits)).astype(np.uint16)
    return [runs_array(h.view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES], cuts(h, part_bits)), runs_array(spread, np.arange((1 << part_bits) + 1) << (bits - part_bits))]


def unpacked(low: list[bytes], spread: list[bytes], part: int, part_bits: int) -> np.ndarray:
    """The hashes of runs of one part, end to end."""
    more = max(0, 64 - 8 * LOW_BYTES - part_bits)
    out = np.zeros((sum(map(len, low)) // LOW_BYTES, 8), np.uint8)
    out[:, :LOW_BYTES] = np.frombuffer(b"".join(low), np.uint8).reshape(-1, LOW_BYTES)
    high = np.tile((np.uint64(part) << np.uint64(more)) + np.arange(1 << more, dtype=np.uint64), len(spread)) << np.uint64(64 - part_bits - more)
    keep = np.uint64((1 << 64) - (1 << 8 * LOW_BYTES))
    return out.view(np.uint64).ravel() | np.repeat(high & keep, np.frombuffer(b"".join(spread), np.uint16))


def ask_batches(batches: Iterator[pa.RecordBatch], block_bits: int, part_bits: int, flush: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows of ASKED, from a partition in order of chunk: each chunk's distinct n-grams, with their counts in its training texts (0: in others only).

    Every part gets a row from every chunk, so that every chunk is told each part's totals.
    """
    hold("bloomlm")
    now, held, size = None, [], 0
    parts = np.arange(1 << block_bits + part_bits, dtype=np.int32)

    def grams() -> list[tuple[np.ndarray, ...]]:
        return [summed(np.concatenate([h for h, _ in x]), np.concatenate([n for _, n in x])) for x in zip(*held)]

    def asked() -> pa.RecordBatch:
        runs = [x for h, n in grams() for x in (*packed(h, block_bits + part_bits), runs_array(n.astype(np.uint32), cuts(h, block_bits + part_bits)))]
        arrays = [pa.array(parts >> part_bits), pa.array(parts), pa.array(np.full(len(parts), now)), *runs]
        return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in ASKED.split(", ")])

    for batch in batches:
        chunk = batch.column(batch.schema.get_field_index("chunk")).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for a, b in zip(edges, edges[1:]):
            if held and chunk[a] != now:
                yield asked()
                held, size = [], 0
            now = chunk[a]
            for some, words in word_slices(iter([batch.slice(a, b - a)])):
                trained = some.column(some.schema.get_field_index("trained")).to_numpy(zero_copy_only=False).astype(np.uint32)
                tokens, before, ends = tokens_of(words)
                each = np.repeat(trained, np.diff(ends, prepend=0))
                held.append(((np.concatenate([np.full(len(ends), START), tokens]), np.concatenate([trained, each])), (pair_hashes(before, tokens), each)))
                size += len(tokens)
                if size > flush:
                    held = [tuple(grams())]
                    size = len(held[0][1][0])
    if held:
        yield asked()


def answer_batches(batches: Iterator[pa.RecordBatch], block_bits: int, part_bits: int, bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Rows of ANSWERS, from a partition that has all that is asked of its blocks, in order of part.

    A part's n-grams are brought together as soon as it ends; a block's are looked up together, each once, however many chunks ask for it.
    """
    hold("bloomlm")
    block, part, rows, ended = None, None, [], []

    def end_part() -> None:
        chunks, *runs = zip(*rows)
        rows.clear()
        sizes = [np.cumsum([0, *(len(x) // LOW_BYTES for x in runs[k])]) for k in (0, 3)]
        counted = [summed(unpacked(low, spread, part, block_bits + part_bits), np.frombuffer(b"".join(n), np.uint32), places=True) for low, spread, n in (runs[:3], runs[3:])]
        ended.append((part, np.array(chunks), sizes, *counted))

    def answered() -> Iterator[pa.RecordBatch]:
        found = [np.concatenate([x[k][i] for x in ended]) for k in (3, 4) for i in (0, 1)]
        known = [x[n > 0] for h, n in (found[:2], found[2:]) for x in (h, n)]
        size, field = field_of(*known, bits, probes)
        none = {name: b"" for name in PARTS}
        grams = Filter([(block, size, none | {"field": field})], block_bits, probes)
        del found, known
        for part, chunks, (at, pair_at), (h, n, place), (g, _, pair_place) in ended:
            exact = np.where(h == START, 0, n)
            answers = [(grams.level(h)[place], at), (exact[place], at), (grams.level(g)[pair_place], pair_at)]
            same = [pa.array(np.full(len(chunks), x, t)) for x, t in ((part, np.int32), (exact.sum(), np.int64), (np.count_nonzero(exact), np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(chunks), *same, *[runs_array(*x) for x in answers]], names=[x.split()[0] for x in ANSWERS.split(", ")])
        ended.clear()

    for batch in batches:
        for its_block, its_part, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and its_part != part:
                end_part()
            if ended and its_block != block:
                yield from answered()
            block, part = its_block, its_part
            rows.append(row)
    if rows:
        end_part()
        yield from answered()


def score_chunk(texts: pa.Table, answers: pa.Table, settings: Settings) -> pa.Table:
    """Rows of SCHEMA: a chunk's texts scored by the answers of all parts."""
    hold("bloomlm")
    answers = answers.sort_by("part")
    got = [np.frombuffer(b"".join(answers[c].to_pylist()), t) for c, t in (("levels", np.uint8), ("exact", np.int64), ("pair_levels", np.uint8))]
    corpus = Corpus(*(sum(answers[c].to_pylist()) for c in ("total", "distinct")), settings)
    ids, tokens, before, ends = [], [], [], [np.empty(0, np.int64)]
    for batch, words in word_slices(iter(texts.to_batches())):
        ids.append(batch.column(batch.schema.get_field_index("doc_id")))
        flat, last, at = tokens_of(words)
        ends.append(at + sum(map(len, tokens)))
        tokens.append(flat), before.append(last)
    sums = score_texts((np.concatenate(tokens), np.concatenate(before), np.concatenate(ends)), corpus, lambda h, g: got)
    return pa.Table.from_batches([scored_batch(pa.concat_arrays(ids), sums, corpus.total)])


def fitted(texts: DataFrame, block_bits: int, s: Settings) -> DataFrame:
    """A table in the shared folder with rows of BLOCKS."""
    bits, probes = s.bits, s.probes
    runs = texts.mapInArrow(lambda b: count_batches(b, block_bits), RUNS)
    return written(runs.repartition("block").sortWithinPartitions("block").mapInArrow(lambda b: build_batches(b, bits, probes), BLOCKS), "blocks")


def by_broadcast(rows: DataFrame, block_bits: int, s: Settings) -> DataFrame | None:
    """Scores by a model that every worker has whole; None if it is too large for that."""
    blocks = fitted(rows.where("trained").select("text"), block_bits, s)
    size = sum((F.octet_length(c) for c in PARTS), F.lit(0))
    total, distinct, size = (int(x or 0) for x in blocks.agg(F.sum("total"), F.sum("distinct"), F.sum(size)).first())
    if size > s.broadcast_bytes:
        return None
    got = blocks.select("block", "size", *PARTS).toArrow().combine_chunks().to_batches()
    found = [(b.column(0)[i].as_py(), b.column(1)[i].as_py(), {c: b.column(c)[i].as_buffer() for c in PARTS}) for b in got for i in range(b.num_rows)]
    grams = Filter(found, block_bits, s.probes)
    del got, found
    model = rows.sparkSession.sparkContext.broadcast((Corpus(total, distinct, s), grams))
    give_back()
    return rows.select("doc_id", "text").mapInArrow(lambda b: score_batches(b, model.value), SCHEMA)


def by_routing(rows: DataFrame, text_bytes: int, block_bits: int, s: Settings) -> DataFrame:
    """Scores by answers that the blocks send back to the chunks."""
    small_batches(rows.sparkSession)
    bits, probes = s.bits, s.probes
    part_bits = (int(text_bytes // s.part_bytes) >> block_bits).bit_length()
    # by what a row holds, so that a row that is read again comes to the same chunk
    texts = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(int(text_bytes // s.chunk_bytes) + 1))).repartition("chunk")
    asked = texts.sortWithinPartitions("chunk").mapInArrow(lambda b: ask_batches(b, block_bits, part_bits), ASKED)
    answers = asked.repartition("block").sortWithinPartitions("part").mapInArrow(lambda b: answer_batches(b, block_bits, part_bits, bits, probes), ANSWERS)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda x, y: score_chunk(x, y, s), SCHEMA)


def score(docs: DataFrame, training: Column, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA: every document scored by a model of those for which ``training`` holds."""
    s = settings
    shared_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("trained"))
    octets = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    text_bytes, trained_bytes = (x or 0 for x in rows.agg(F.sum(octets + ROW_BYTES), F.sum(F.when(F.col("trained"), octets))).first())
    block_bits = max(s.least_blocks, int(trained_bytes // s.block_bytes).bit_length())
    scored = by_broadcast(rows, block_bits, s) if trained_bytes <= s.broadcast_bytes else None
    return scored if scored is not None else by_routing(rows, text_bytes, block_bits, s)
