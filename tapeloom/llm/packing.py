"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

Attention over a piece of n tokens costs about ``linear*n + quadratic*n*n``.  Within a group of some hundred
sequences, pieces are taken in descending order of that cost and each goes to the lowest-cost sequence that
still has room.  A piece that fits nowhere whole is cut over the sequences with most room, so that every
sequence is full; what exceeds a whole number of sequences waits for the task's next group, and the last
rest of a task is laid out in sequences whose lengths are powers of two, which need no padding.

Every task tokenises and packs its own documents as they stream by: no shuffle, memory bounded by one group.

Edge cases: a null or empty text is one document of the end token alone; a text longer than a sequence is cut;
equal and repeated rows are packed as often as they occur; an empty table gives no rows; input columns other
than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, gather, give_back, hold, numbers, slices, small_batches

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
#: Tokens and documents after which a group is packed.
GROUP_TOKENS, GROUP_DOCS = 1 << 20, 4096
#: Sets words apart when many are encoded at once; words that hold it are encoded alone.
MARK = "|"
_TOKENIZERS: dict[str, tuple] = {}
#: A word of Latin letters, with ASCII marks at its end or none: it is encoded as its letters in lower case, then its marks, by tokenizers that normalise and split as
#: NORMALIZERS and SPLIT say.  These letters are composed already, and none of the marks joins them or is part of a special token (MARK isn't among them).
LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{}~]*)")
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def folded(text: bytes) -> bytes:
    """``text`` with A-Z in lower case, which such a tokenizer does anyway, after NFC; so not where a combining mark (U+0300 to U+036F) might join a letter of one
    case only, or MARK be part of a special token."""
    return text if MARK.encode() in text or b"\xcc" in text or b"\xcd" in text else text.lower()


def letters_only(tokenizer):
    """A tokenizer of lower-case letters between white space, with the same ids but without normalising and splitting by patterns; None if ``tokenizer`` isn't of the kind that LETTERS is for."""
    from tokenizers import Tokenizer, pre_tokenizers

    spec = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != NORMALIZERS or [x["type"] for x in splits] != ["Split", "ByteLevel"] or splits[0]["pattern"] != {"Regex": SPLIT} or splits[1]["use_regex"] or splits[1]["add_prefix_space"]:
        return None
    if spec["post_processor"] or any(MARK not in x["content"] for x in spec["added_tokens"]):
        return None
    plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "added_tokens": []}))
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return plain


class WordTokens:
    """Token ids by whitespace-separated word, each distinct word encoded once while it is remembered.

    The tokenizer drops white space before it splits, so words between ASCII white space are independent.  Beyond ``limit`` words only
    those met again are kept, the half of ``limit`` met most often at most, so words that occur once don't fill the memory.
    """

    def __init__(self, path: str, limit: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.letters = letters_only(self.tokenizer)
        self.index = Numbered()
        self.flat, self.starts, self.lengths, self.uses = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)

    def forget(self) -> None:
        """Drop the words met once, and the least met beyond half of ``limit``; what is kept counts half as often from now on."""
        kept = np.flatnonzero(self.uses > 1)
        kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[: self.limit // 2]])
        self.flat = gather(self.flat, self.starts, self.lengths, kept)
        self.lengths, self.uses = self.lengths[kept], self.uses[kept] // 2
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        words = list(self.index)
        self.index = Numbered()
        self.index.update({words[k]: i for i, k in enumerate(kept.tolist())})

    def encoded(self, tokenizer, words: list[str], block: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, and where each word's start, and how many they are).  Words are encoded in short runs, set apart by a mark that is one token."""
        lengths, starts, parts, end = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64), [np.empty(0, np.uint32)], 0
        marked = np.fromiter((MARK in w for w in words), bool, len(words))
        plain = np.flatnonzero(~marked)
        mark = tokenizer.encode(MARK, add_special_tokens=False).ids

        def take(which, ids: np.ndarray, sizes) -> None:
            nonlocal end
            lengths[which], starts[which] = sizes, end + np.cumsum(sizes) - sizes
            parts.append(ids)
            end += len(ids)

        for at in range(0, len(plain), block):
            which = plain[at : at + block]
            text = f" {MARK} ".join([words[i] for i in which.tolist()])
            got = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)  # without offsets
            if len(mark) != 1 or len(cuts := np.flatnonzero(got == mark[0])) != len(which) - 1:
                raise ValueError(f"this tokenizer has no single token for {MARK!r}")
            take(which, got[got != mark[0]], np.diff(cuts, prepend=-1, append=len(got)) - 1)
        for i in np.flatnonzero(marked).tolist():
            ids = np.array(tokenizer.encode(words[i], add_special_tokens=False).ids, np.uint32)
            take([i], ids, np.array([len(ids)]))
        return np.concatenate(parts), starts, lengths

    def learn(self, words: list[bytes]) -> None:
        """Ids of words not met before; letters that are known, or are in several of these words, aren't encoded again."""
        match, known, n = LETTERS.fullmatch if self.letters else lambda text: None, self.index.get, len(self.starts)
        letters, others = Numbered(), Numbered()
        # a word is two runs of ids: from 0 those of known words, then those of letters; from -1 downwards those of others
        runs, nothing = [], ~others[""]
        for word in words:
            text = word.decode("utf-8", "replace")
            if found := match(text):
                stem = found[1].lower()
                k = known(stem.encode(), n)
                runs += k if k < n else n + letters[stem], ~others[found[2]]
            else:
                runs += ~others[text], nothing
        flat, starts, lengths = self.flat, self.starts, self.lengths
        for tokenizer, new in (self.letters, letters), (self.tokenizer, others):
            if new:
                ids, at, sizes = self.encoded(tokenizer, list(new))
                flat, starts, lengths = np.concatenate([flat, ids]), np.concatenate([starts, at + len(flat)]), np.concatenate([lengths, sizes])
        runs = np.array(runs, np.int64)
        runs = np.where(runs < 0, n + len(letters) + ~runs, runs)
        ids, sizes = gather(flat, starts, lengths, runs), lengths[runs].reshape(-1, 2).sum(1, dtype=np.int32)
        at = len(self.flat) + np.cumsum(sizes, dtype=np.int64) - sizes
        self.flat, self.starts, self.lengths = np.concatenate([self.flat, ids]), np.concatenate([self.starts, at]), np.concatenate([self.lengths, sizes])

    def encode(self, texts: list[bytes | None], end: int) -> list[np.ndarray]:
        if len(self.index) > self.limit:
            self.forget()
        fold = folded if self.letters else bytes
        at = [numbers(fold(t or b"").split(), self.index) for t in texts]
        self.learn(self.index.new)
        self.index.new = []
        uses = np.bincount(np.concatenate([np.empty(0, np.int64), *at]), minlength=len(self.index))
        uses[: len(self.uses)] += self.uses
        self.uses = np.minimum(uses, 1 << 30).astype(np.int32)
        tail = np.array([end], np.uint32)
        return [np.concatenate([gather(self.flat, self.starts, self.lengths, a), tail]) for a in at]


def piece_cost(n, linear: float, quadratic: float):
    """Estimated cost of attention over one piece of n tokens."""
    return linear * n + quadratic * n * n


def fill(pieces: list[tuple[int, int, int]], sizes: list[int], linear: float, quadratic: float) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Assign (document, start, length) pieces to sequences of ``sizes``; returns each sequence's pieces and what found no room."""
    room, cost = np.array(sizes, np.int64), np.zeros(len(sizes))
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    rest = []

    def put(k: int, doc: int, start: int, n: int) -> None:
        out[k].append((doc, start, n))
        room[k] -= n
        cost[k] += piece_cost(n, linear, quadratic)

    for doc, start, n in sorted(pieces, key=lambda p: (-p[2], p[0], p[1])):
        if len(sizes):
            fits = np.where(room >= n, cost, np.inf)
            k = int(fits.argmin())
            if np.isfinite(fits[k]):
                put(k, doc, start, n)
                continue
        while n:
            k = int(room.argmax()) if len(sizes) else 0
            if not len(sizes) or not room[k]:
                rest.append((doc, start, n))
                break
            m = int(min(n, room[k]))
            put(k, doc, start, m)
            start, n = start + m, n - m
    return out, rest


def powers(n: int) -> list[int]:
    """n as a sum of distinct powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs one task's documents group by group."""

    def __init__(self, capacity: int, linear: float, quadratic: float):
        self.capacity, self.linear, self.quadratic = capacity, linear, quadratic
        self.docs: dict[int, tuple[int, np.ndarray]] = {}
        self.pieces: list[tuple[int, int, int]] = []
        self.tokens = self.seen = self.sequences = 0

    def add(self, doc_id: int, ids: np.ndarray) -> Iterator[tuple]:
        k, self.seen = self.seen, self.seen + 1
        self.docs[k] = (doc_id, ids)
        at = 0
        while len(ids) - at >= self.capacity:
            yield from self.rows([[(k, at, self.capacity)]])
            at += self.capacity
        if at < len(ids):
            self.pieces.append((k, at, len(ids) - at))
            self.tokens += len(ids) - at
        else:
            del self.docs[k]
        if self.tokens >= GROUP_TOKENS or len(self.pieces) >= GROUP_DOCS:
            yield from self.close(last=False)

    def close(self, last: bool) -> Iterator[tuple]:
        whole, tail = divmod(self.tokens, self.capacity)
        sizes = [self.capacity] * whole + (powers(tail) if last else [])
        packed, self.pieces = fill(self.pieces, sizes, self.linear, self.quadratic)
        yield from self.rows(packed)
        self.tokens = sum(n for _, _, n in self.pieces)
        self.docs = {k: self.docs[k] for k, _, _ in self.pieces}

    def rows(self, packed: list[list[tuple[int, int, int]]]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        for pieces in packed:
            seq, at = (part << 36) + self.sequences, 0
            self.sequences += 1
            total = sum(n for _, _, n in pieces)
            for k, start, n in pieces:
                doc_id, ids = self.docs[k]
                crc = zlib.crc32(np.ascontiguousarray(ids[start : start + n], "<u4").tobytes())
                yield doc_id, start, n, crc, len(ids), seq, at, total
                at += n


def pack_batches(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, linear: float, quadratic: float) -> Iterator[pa.RecordBatch]:
    hold("packing", _TOKENIZERS.clear)
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokens(path)
        give_back()
    tokens, packer = _TOKENIZERS[path], Packer(capacity, linear, quadratic)
    for batch, texts in slices(batches):
        rows: list[tuple] = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(texts, end_id)):
            rows.extend(packer.add(doc_id, ids))
        yield _batch(rows)
    yield _batch(list(packer.close(last=True)))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA, one per piece.  ``linear`` and ``quadratic`` weigh the cost estimate; ``end_id`` closes each document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: pack_batches(batches, tokenizer_path, capacity, end_id, linear, quadratic), SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(names))], names=names)
