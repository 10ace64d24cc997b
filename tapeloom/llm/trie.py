"""Prefix trie of conversations by truncation peeling."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, importable, written

#: Turns of conversations that one task peels together (a longer conversation is peeled alone).
BLOCK_TURNS = 100_000
#: Ids of conversations that one row of a node's ends holds.
END_IDS = 512
ROOT = bytes(16)
NEVER = 1 << 62

STEPS = "array<struct<digest:binary,size:bigint>>"
PEELED = "key binary, depth bigint, above binary, conv bigint, longest bigint, first_end bigint, ends string"
SUMMED = "key binary, depth bigint, conv bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint"


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, steps): each conversation's turns in order, a turn as 16 bytes of the SHA-256 of its role and text, and its text's size in bytes.

    Turns are ordered by ``turn``, null first, equal ones by role and digest.  A null role or text is empty.  Rows without a conv_id belong to no
    conversation.  Texts stay where they are read; only digests are shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("step"))
    ordered = F.transform(F.array_sort(F.collect_list("step"), _earlier), lambda s: F.struct(s["digest"].alias("digest"), s["size"].alias("size")))
    return rows.groupBy("conv_id").agg(ordered.alias("steps"))


def _earlier(a, b):
    by = lambda x, y: F.when(x < y, -1).when(x > y, 1)
    nulls = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return F.coalesce(nulls, by(a["turn"], b["turn"]), by(a["role"], b["role"]), by(a["digest"], b["digest"]), F.lit(0))


def with_shared_heads(seqs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % family, where h is crc32(c) % most; none if that one is absent."""
    heads = seqs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("steps", 1, most - 1).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    rows = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", h.cast("int")).join(heads, "base", "left")
    own = F.expr("slice(steps, h + 1, size(steps))")
    return rows.select("conv_id", F.concat(F.coalesce(F.expr("slice(head, 1, h)"), F.array().cast(STEPS)), own).alias("steps"))


class _Node:
    """A surviving node: its smallest member so far, and what has been gathered from below."""

    __slots__ = ("first", "n", "longest", "leaves", "saved", "children")

    def __init__(self, first: int):
        self.first, self.n, self.longest, self.leaves, self.saved, self.children = first, 0, 0, 0, 0, 0


class _Block:
    """Conversations that one task peels together."""

    def __init__(self, rows: list[dict]):
        self.ids = [r["conv_id"] for r in rows]
        self.sizes = [[0, *(s["size"] for s in r["steps"])] for r in rows]
        self.owned_from = [NEVER if r.get("owned_from") is None else r["owned_from"] for r in rows]
        self.parent = [r.get("parent") for r in rows]
        self.leaf = [bool(r.get("leaf")) for r in rows]
        self.keys = []
        for r in rows:
            path = [ROOT]
            for s in r["steps"]:
                path.append(hashlib.blake2b(path[-1] + s["digest"], digest_size=16).digest())
            self.keys.append(path)

    def peel(self) -> Iterator[tuple[int, bytes, _Node, list[int]]]:
        """(depth, key, node, those that end there) of every node among these conversations, from the greatest depth down to the root.

        At each depth the conversations that end there join the nodes that have survived; each node is given out, then its last
        turn is stripped and equal rests become one node, which takes over their sums.
        """
        ended = defaultdict(list)
        for c, path in enumerate(self.keys):
            ended[len(path) - 1].append(c)
        live: dict[bytes, _Node] = {}
        for depth in range(max(ended, default=-1), -1, -1):
            ends = defaultdict(list)
            for c in ended.pop(depth, ()):
                key = self.keys[c][depth]
                node = self._merged(live, key, c)
                node.n += 1
                node.longest = max(node.longest, depth)
                node.leaves += self.leaf[c]
                ends[key].append(self.ids[c])
            above: dict[bytes, _Node] = {}
            for key, node in live.items():
                owned = self.owned_from[node.first] <= depth
                node.saved += (node.n - owned) * self.sizes[node.first][depth]
                yield depth, key, node, ends.get(key, [])
                if depth:
                    up = self._merged(above, self.keys[node.first][depth - 1], node.first)
                    up.n += node.n
                    up.longest = max(up.longest, node.longest)
                    up.leaves += node.leaves
                    up.saved += node.saved
                    up.children += owned
            live = above

    def _merged(self, live: dict[bytes, _Node], key: bytes, first: int) -> _Node:
        node = live.get(key)
        if node is None:
            node = live[key] = _Node(first)
        elif self.ids[first] < self.ids[node.first]:
            node.first = first
        return node


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    held, turns = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for row in batch.slice(at, 64).to_pylist():
                if held and turns + len(row["steps"]) > BLOCK_TURNS:
                    yield _Block(held)
                    held, turns = [], 0
                held.append(row)
                turns += len(row["steps"]) + 1
    if held:
        yield _Block(held)
    give_back()


def _tables(rows: Iterator[tuple], schema: pa.Schema, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_LONG, _KEY, _TEXT = pa.int64(), pa.binary(), pa.string()
_PEELED = pa.schema([("key", _KEY), ("depth", _LONG), ("above", _KEY), ("conv", _LONG), ("longest", _LONG), ("first_end", _LONG), ("ends", _TEXT)])
_SUMMED = pa.schema([("key", _KEY), ("depth", _LONG), ("conv", _LONG), ("parent", _LONG), ("n", _LONG), ("children", _LONG), ("leaves", _LONG), ("saved", _LONG)])
_HASHED = pa.schema([("key", _KEY), ("ends_sha256", _TEXT)])


def _discover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each block with their smallest member and greatest length, and beside them the ids that end at a node, ascending, in runs of END_IDS."""

    def rows():
        for b in _blocks(batches):
            for depth, key, node, ends in b.peel():
                yield key, depth, b.keys[node.first][depth - 1] if depth else None, b.ids[node.first], node.longest, None, None
                ends.sort()
                for k in range(0, len(ends), END_IDS):
                    yield key, depth, None, None, None, ends[k], ",".join(map(str, ends[k : k + END_IDS]))

    yield from _tables(rows(), _PEELED)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each block with its share of their sums; a node's parent is known to its owner."""

    def rows():
        for b in _blocks(batches):
            for depth, key, node, _ in b.peel():
                c = node.first
                parent = None if b.owned_from[c] > depth or not depth else b.ids[c] if b.owned_from[c] < depth else b.parent[c]
                yield key, depth, b.ids[c], parent, node.n, node.children, node.leaves, node.saved

    yield from _tables(rows(), _SUMMED)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's runs of ids, which come in order; only the running hash is held."""

    def rows():
        now, digest = None, None
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != now:
                    if digest:
                        yield now, digest.hexdigest()
                    now, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
        if digest:
            yield now, digest.hexdigest()

    yield from _tables(rows(), _HASHED)


def build(seqs: DataFrame) -> DataFrame:
    """One row a node of the trie of ``seqs`` (conv_id, steps; conv_ids are unique): key, depth, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Truncation peeling: each task descends from its conversations' greatest depth, merges newly ended conversations with surviving nodes, strips the
    last turn and regroups, gathering sums on the way; an aggregate by key then merges what the tasks have found, so no subtree, however
    large, has to lie in one task.  For sums to be free of double counts between tasks each node belongs to one conversation: its smallest member.
    What a conversation owns is the end of its path, from some depth on.  So the peeling is done twice: once to discover nodes and owners, once to sum
    with each conversation's depth of ownership known; a node's children, leaves and texts then are counted where their owner is.
    Nodes are told apart by 128 bits of chained hashes.  Without conversations there is no node, not even the root.
    """
    importable(seqs.sparkSession)
    seqs = written(seqs.select("conv_id", "steps"), "sequences")
    peeled = written(seqs.repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(_discover, PEELED), "peeled")
    nodes = peeled.where("ends IS NULL").groupBy("key").agg(F.min("conv").alias("conv"), F.max("longest").alias("longest"), F.first("depth").alias("depth"), F.first("above").alias("above"))
    nodes = written(nodes, "nodes")
    owners = nodes.groupBy("conv").agg(F.min("depth").alias("owned_from"), F.min_by("above", "depth").alias("above"), F.max(F.col("longest") == F.col("depth")).alias("leaf"))
    owners = owners.join(nodes.select(F.col("key").alias("above"), F.col("conv").alias("parent")), "above", "left").select(F.col("conv").alias("conv_id"), "owned_from", "leaf", "parent")
    sums = seqs.join(owners, "conv_id", "left").mapInArrow(_sum_up, SUMMED)
    total = sums.groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv").alias("conv_id"), F.max("parent").alias("parent_conv_id"), F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    runs = peeled.where("ends IS NOT NULL").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    out = total.join(runs.mapInArrow(_hash_ends, "key binary, ends_sha256 string"), "key", "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
