"""Byte-level BPE by recursive queries.

Encoding: each task cuts its texts with the pre-tokenising pattern, and only words not met before go to an in-memory DuckDB
of the task's process.  There a recursive query holds one row per token position of each word; every step joins
neighbouring positions with the merge table, and contracts each word's leftmost pair of minimum rank, until no
word has a pair left.  An ordered aggregation over the positions gives each word's ids, and documents are strung together from their words' ids.

Decoding: rows of a document, position and id are joined with the vocabulary, and an ordered aggregation over the positions gives the bytes.  The digests
decode each document's own ids that way.

A single word of over LONG_WORD bytes would take the query a step, over all its positions, for each of its contractions; such
words are contracted in the same order from a heap instead.

The merge table has every pair of ranked tokens whose concatenation is ranked; its size is fixed by the vocabulary.

Edge cases: null or empty text: no ids, and the hash of nothing; texts of any length, in words; repeated rows give
equal results; an empty table gives no rows; further columns are neither read nor returned.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, gather, hold, numbers, slices

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Bytes of a word from which on a heap contracts it.
LONG_WORD = 256
#: A query's words: so many at most, and so many squared bytes, as the rows of all its steps grow with these.
BLOCK_WORDS, BLOCK_SQUARES = 20_000, 4_000_000
#: Words remembered, and chunks (runs between spaces) remembered; beyond it all of them are forgotten, and met anew.
HELD_WORDS, HELD_CHUNKS = 900_000, 500_000
#: Ids of a document that one string of the decoding query holds.
PIECE = 1 << 16
_ENCODERS: dict[tuple[str, str], WordEncoder] = {}

#: One row per word and position, with the position and token after it and the rank of the pair that they form; ``step`` counts
#: contractions.  A word that has no pair left makes no further rows, so its last step is its fixpoint.
CONTRACT = """
WITH RECURSIVE state(word, step, pos, tok, after, next_tok, rank) AS (
    SELECT s.word, 0, s.pos, s.tok, s.pos + 1, s.next_tok, m.rank
    FROM start s LEFT JOIN merges m ON m.a = s.tok AND m.b = s.next_tok
  UNION ALL
    SELECT n.word, n.step, n.pos, n.tok, n.after, n.next_tok, coalesce(n.rank, m.rank)
    FROM (
        SELECT s.word, s.step + 1 AS step, s.pos,
               CASE WHEN s.pos = hit THEN merged ELSE s.tok END AS tok,
               CASE WHEN s.pos = hit THEN g.after ELSE s.after END AS after,
               CASE WHEN s.pos = hit THEN g.next_tok WHEN s.after = hit THEN merged ELSE s.next_tok END AS next_tok,
               CASE WHEN s.pos = hit OR s.after = hit THEN NULL ELSE s.rank END AS rank,
               CASE WHEN s.pos = hit THEN merged WHEN s.after = hit THEN s.tok END AS asked
        FROM state s
        JOIN (
            SELECT word, (best >> 20) % 1048576 AS hit, best >> 40 AS merged, best % 1048576 AS gone
            FROM (SELECT word, min((rank::BIGINT << 40) + (pos::BIGINT << 20) + after) AS best FROM state WHERE rank IS NOT NULL GROUP BY word)
        ) h USING (word)
        LEFT JOIN state g ON g.word = s.word AND s.pos = hit AND g.pos = gone
        WHERE s.pos <> gone
    ) n
    LEFT JOIN merges m ON m.a = n.asked AND m.b = n.next_tok
)
SELECT word, array_agg(tok ORDER BY pos) AS ids
FROM state
JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) AS fixpoint USING (word, step)
GROUP BY word ORDER BY word
"""

#: The connection has one thread, so an aggregate takes its rows in the order of the query below it.
DECODE = """
SELECT doc, piece, string_agg(hex, '') AS hex
FROM (SELECT doc, piece, pos, hex FROM coded JOIN vocab USING (tok) ORDER BY doc, piece, pos)
GROUP BY doc, piece ORDER BY doc, piece
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class WordEncoder:
    """Ids by word (pre-token) and by chunk, and the way back."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "400MB", "temp_directory": ""})
        pairs = [(a, b, r) for token, r in self.ranks.items() for k in range(1, len(token)) if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None]
        self._table("merges", a=[p[0] for p in pairs], b=[p[1] for p in pairs], rank=[p[2] for p in pairs])
        self._table("vocab", tok=list(self.ranks.values()), hex=[t.hex() for t in self.ranks])
        self.byte_ids = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.words, self.chunks = Remembered(), Remembered()

    def _table(self, name: str, **columns) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def contract_long(self, raw: bytes) -> list[int]:
        """One long word's ids: leftmost pair of minimum rank first, from a heap of (rank, position)."""
        parts: list[bytes | None] = [raw[i : i + 1] for i in range(len(raw))]
        after, before = list(range(1, len(raw) + 1)), list(range(-1, len(raw) - 1))

        def pair(i: int) -> tuple[int, int, int] | None:
            if i < 0 or after[i] >= len(parts) or (rank := self.ranks.get(parts[i] + parts[after[i]])) is None:
                return None
            return rank, i, after[after[i]]

        heap = [p for p in map(pair, range(len(raw))) if p]
        heapify(heap)
        while heap:
            rank, i, end = heappop(heap)
            if parts[i] is None or pair(i) != (rank, i, end):
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = parts[i] + parts[gone], None, end
            if end < len(parts):
                before[end] = i
            for k in (before[i], i):
                if found := pair(k):
                    heappush(heap, found)
        return [self.ranks[p] for p in parts if p is not None]

    def word_numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of words in ``self.words``, those not met before learnt by the recursive query; long ones by the heap."""
        at = numbers(words, self.words.known)
        new = self.words.taken()
        found: list[np.ndarray | None] = [None] * len(new)
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        for i, r in enumerate(raw):
            if len(r) > LONG_WORD:
                found[i] = np.array(self.contract_long(r), np.uint32)
        self._contract(raw, found)
        self.words.add(found)
        return at

    def _contract(self, raw: list[bytes], found: list[np.ndarray | None]) -> None:
        """Words of like length together, so that they end after a like number of steps."""
        left = sorted((i for i, f in enumerate(found) if f is None), key=lambda i: len(raw[i]))
        squares = np.cumsum([len(raw[i]) ** 2 for i in left])
        block = np.maximum(squares // BLOCK_SQUARES, np.arange(len(left)) // BLOCK_WORDS) if left else np.zeros(0, int)
        for part in np.split(np.array(left, np.int64), np.flatnonzero(np.diff(block)) + 1):
            part = part.tolist()
            if not part:
                continue
            some = [raw[i] for i in part]
            whole = np.fromiter((self.ranks.get(r, -1) for r in some), np.int64, len(some))
            sizes = np.where(whole >= 0, 1, np.fromiter(map(len, some), np.int64, len(some)))
            word = np.repeat(np.arange(len(some)), sizes)
            pos = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            tok = np.empty(len(word), np.int64)
            known = np.repeat(whole >= 0, sizes)
            tok[known] = whole[whole >= 0]
            tok[~known] = self.byte_ids[np.frombuffer(b"".join(r for r, k in zip(some, whole) if k < 0), np.uint8)]
            after = np.append(tok[1:], -1)
            after[np.cumsum(sizes) - 1] = -1
            self._table("start", word=word.astype(np.int32), pos=pos.astype(np.int32), tok=tok.astype(np.int32), next_tok=after.astype(np.int32))
            ids = self.db.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
            ends, flat = ids.offsets.to_numpy(), ids.flatten().to_numpy().astype(np.uint32)
            for i, a, b in zip(part, ends.tolist(), ends[1:].tolist()):
                found[i] = flat[a:b]

    def learn_chunks(self) -> None:
        """Ids of new chunks: a str is a run between spaces with the space before it, bytes are a text's first run.

        Where no run of a text has white space at its ends, runs are whole pre-tokens; others are marked odd and not learnt."""
        keys = self.chunks.taken()
        texts = [c if isinstance(c, str) else c.decode() for c in keys]
        odd = [(not t or t[0].isspace() or t[-1].isspace()) if isinstance(c, str) else t != "" and (t[0].isspace() or t[-1].isspace()) for c, t in zip(keys, texts)]
        split = [[] if o else self.pattern.findall(" " + t if isinstance(c, str) else t) for c, t, o in zip(keys, texts, odd)]
        at = self.word_numbers([w for ws in split for w in ws])
        n = np.fromiter(map(len, split), np.int64, len(split))
        total = np.concatenate([[0], np.cumsum(self.words.lengths[at])])
        ends = np.cumsum(n)
        self.chunks.extend(gather(self.words.flat, self.words.starts, self.words.lengths, at), np.where(odd, -1, total[ends] - total[ends - n]))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Of each text, its ids.  A text is cut at single spaces, unless white space meets such a space anywhere; then it is cut by the pattern as a whole."""
        if len(self.words.known) > HELD_WORDS:
            self.words = Remembered()
        if len(self.chunks.known) > HELD_CHUNKS:
            self.chunks = Remembered()
        cut = []
        for t in texts:
            runs = t.split(" ")
            runs[0] = runs[0].encode()
            cut.append(numbers(runs, self.chunks.known))
        self.learn_chunks()
        odd = [bool((self.chunks.lengths[c] < 0).any()) for c in cut]
        whole = [self.word_numbers(self.pattern.findall(t)) if o else None for t, o in zip(texts, odd)]
        for c, w in zip(cut, whole):
            yield (self.chunks if w is None else self.words).ids(c if w is None else w)

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Of each document, the bytes of its ids."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self._table("coded", doc=np.repeat(np.arange(len(ids), dtype=np.int32), sizes), piece=(pos // PIECE).astype(np.int32), pos=(pos % PIECE).astype(np.int32), tok=np.concatenate([*ids, []]).astype(np.int32))
        got = self.db.sql(DECODE).to_arrow_table()
        out: list[list[bytes]] = [[] for _ in ids]
        for doc, text in zip(got.column("doc").to_pylist(), got.column("hex").to_pylist()):
            out[doc].append(bytes.fromhex(text))
        return [b"".join(x) for x in out]


class Remembered:
    """Keys by number, and the ids of each end to end."""

    def __init__(self) -> None:
        self.known = Numbered()
        self.flat, self.starts, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def taken(self) -> list:
        """The keys numbered since this was last asked."""
        new, self.known.new = self.known.new, []
        return new

    def add(self, ids: list[np.ndarray]) -> None:
        if ids:
            self.extend(np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        """A length of -1 says that a key has no ids of its own."""
        ends = np.cumsum(np.maximum(lengths, 0))
        self.starts = np.concatenate([self.starts, len(self.flat) + ends - np.maximum(lengths, 0)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])

    def ids(self, which: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts, self.lengths, which)


def encoder(path: str, pattern: str) -> WordEncoder:
    hold("bpe", _ENCODERS.clear)
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = WordEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def digest_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        words = encoder(path, pattern)
        got = list(words.encode([(t or b"").decode() for t in texts]))
        rows = [(len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()) for ids, back in zip(got, words.decode(got))]
        n, ids, back = zip(*rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def ids_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        got = list(encoder(path, pattern).encode([(t or b"").decode() for t in texts]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i.astype(np.int32) for i in got], pa.list_(pa.int32()))], names=["doc_id", "ids"])


def text_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.nan_to_num(np.asarray(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=float))
        edges = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            ids = [np.array(x or [], np.int64) for x in batch.column(1).slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(encoder(path, pattern).decode(ids), pa.binary())], names=["doc_id", "decoded"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of each row."""
    return _rows(docs, id_col, text_col).mapInArrow(lambda b: ids_batches(b, ranks_path, pattern), "doc_id long, ids array<int>")


def decode(coded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, decoded (bytes) of each row's ids; null ids give no bytes, and an id that isn't in the vocabulary none of its own."""
    rows = coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(lambda b: text_batches(b, ranks_path, pattern), "doc_id long, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA: the number and hash of each text's ids and the hash of what they decode to."""
    return _rows(docs, id_col, text_col).mapInArrow(lambda b: digest_batches(b, ranks_path, pattern), SCHEMA)
