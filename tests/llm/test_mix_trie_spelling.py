"""Mixing, prefix trie and spelling variants: SQL on the given tables, brute force on small ones with every kind of row."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from helpers import SF, empty, hard
from oracle import differences
from pyspark.sql import functions as F

from tapeloom.llm import mixing, queries, spelling, trie


@pytest.mark.parametrize("name", ["op11_mixing", "op12_prefix_trie", "op13_spelling"])
def test_queries_equal_their_sql(spark, name):
    assert differences(spark, queries.queries()[name], queries.oracle_sql()[name], SF) == []


# --- mixing ---------------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    """Share by weight, cut at the limit, and share the excess again."""
    out, open_ = {s: Fraction(0) for s in sizes}, {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    rest = share * sum(sizes.values())
    while rest and open_:
        each = rest / sum(open_.values())
        for s, w in open_.items():
            out[s] += each * w
        rest = sum(max(0, out[s] - most * n) for s, n in sizes.items())
        out = {s: min(t, Fraction(most * sizes[s])) for s, t in out.items()}
        open_ = {s: w for s, w in open_.items() if out[s] < most * sizes[s]}
    return out


def mixture(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for source, n in (("a", 40), ("b", 3), (None, 12), ("", 9), ("É", 30), ("none", 4), ("z", 200)):
        rows += [(len(rows), " ".join("w" for _ in range(0 if source == "none" else rng.choice([0, 1, 5, 40, 700]))), source, 5, "x") for _ in range(n)]
    rows += [(5, "same row twice", "a", 1, "y")] * 2 + [(None, "no id", "b", 1, "y"), (None, None, None, None, None), (9001, "w " * 9000, "z", 1, "y")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string")


def test_a_mix_meets_its_targets(spark):
    rows, docs = mixture(spark)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    mixed, documents = mixing.mix(docs, block=64)
    got = mixing.taken(mixed, documents).collect()
    assert len(got) == len(rows)
    want = brute_targets(dict(sizes))
    took = Counter()
    for r in got:
        took[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source])) and r.taken <= 2 * r["size"]
    assert all(abs(took[s] - want[s]) <= 1 for s in sizes)
    pieces = mixed.collect()
    slots = defaultdict(list)
    words = {(r.number, r.nth): r["size"] for r in got}
    spans = defaultdict(list)
    for p in pieces:
        slots[p.slot].append(p)
        spans[p.number, p.nth, p.epoch].append((p.start, p.start + p.length))
        assert 0 <= p.start and p.start + p.length <= words[p.number, p.nth] and p.length > 0
    assert sorted(slots) == list(range(len(slots)))
    for k, parts in slots.items():  # gapless, of one source, and full but for a source's last one
        parts.sort(key=lambda p: p.offset)
        assert len({p.number for p in parts}) == 1
        assert [p.offset for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
    short = Counter(parts[0].number for parts in slots.values() if sum(p.length for p in parts) != 64)
    assert all(n == 1 for n in short.values())
    for parts in spans.values():  # no word twice in one epoch
        parts.sort()
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    share = Counter(p[0].number for p in slots.values())
    for number, n in share.items():  # evenly spread: near its share of every beginning of the mix
        seen = 0
        for k in range(len(slots)):
            seen += slots[k][0].number == number
            assert abs(seen - (k + 1) * n / len(slots)) < 2 + np.log2(len(slots))


def test_reruns_of_a_mix_agree_and_ranges_join_up(spark, monkeypatch):
    rows, docs = mixture(spark)
    a = sorted(map(tuple, mixing.mix(docs, block=32)[0].collect()), key=repr)
    b = sorted(map(tuple, mixing.mix(docs.repartition(5).withColumn("number", F.lit(1)), block=32)[0].collect()), key=repr)
    monkeypatch.setattr(mixing, "WINDOW_ROWS", 7)
    monkeypatch.setattr(mixing, "SLOT_RUN", 3)
    assert a == b == sorted(map(tuple, mixing.mix(docs, block=32)[0].collect()), key=repr)


def test_mixes_of_hard_and_empty_tables(spark):
    mixed, documents = mixing.mix(hard(spark))
    assert mixing.taken(mixed, documents).count() == 9
    mixed, documents = mixing.mix(empty(spark))
    assert mixed.count() == documents.count() == 0
    assert mixing.mix(hard(spark).where("doc_id IN (2, 3, 4)"))[0].count() == 0  # no words at all


# --- trie -----------------------------------------------------------------------------------------------------------------


def brute_trie(paths):
    """Nodes by their whole prefixes."""
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = {}
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = sorted(c for c in m if len(paths[c]) == len(p))
        out[min(m), len(p)] = (min(members[p[:-1]]) if p else None, len(m), len(children), len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def found(df):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()}


def conversations(seed, n=60, most=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 500), n):
        turns = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["ja", "né", "", None])) for t in range(rng.randrange(1, most))]
        rows += turns + ([turns[0]] if rng.random() < 0.1 else []) + ([(c, None, "user", "before all")] if rng.random() < 0.1 else [])
    rows += [(1000 + c, t, "user", f"t{t}") for c in range(30) for t in range(3)]  # one common conversation
    rows += [(2000, t, "user", "x" * t) for t in range(300)] + [(2001, 0, "user", ""), (None, 0, "user", "of none")]
    rng.shuffle(rows)
    return rows


def paths_of(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
            own[c].append((t is not None, t or 0, role or "", digest, text or ""))
    return {c: [(r, x) for _, _, r, _, x in sorted(turns)] for c, turns in own.items()}


@pytest.mark.parametrize("turns", [100_000, 12])
def test_trie_against_whole_prefixes(spark, monkeypatch, turns):
    monkeypatch.setattr(trie, "BLOCK_TURNS", turns)
    monkeypatch.setattr(trie, "END_IDS", 4)
    rows = conversations(turns)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, depth int, key string").repartition(6)
    paths = paths_of(rows)
    assert found(trie.build(trie.sequences(df))) == brute_trie(paths)
    rebuilt = {}
    for c in paths:
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = paths.get(base, [])[:h] + paths[c][h:]
    assert found(trie.build(trie.with_shared_heads(trie.sequences(df)))) == brute_trie(rebuilt)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.build(trie.sequences(none)).count() == 0
    one = spark.createDataFrame([(4, None, None, None)], "conv_id long, turn long, role string, text string")
    assert sorted(found(trie.build(trie.sequences(one)))) == [(4, 0), (4, 1)]


# --- spelling -------------------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_spelling(rows, drop):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if drop and h % drop == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    out = {}
    for w in n:
        close = [x for x in n if one_edit(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 5 * n[w] else None
        out[w] = [form, None, n[w], len(close), n[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def misspelt(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÀ÷") for _ in range(rng.choice([6, 7, 8, 9]))) for _ in range(120)] + ["Straße" + "x" * 200, "straße" + "x" * 201, "É" * 6, "é" * 6, "éÉéééé"]
    rows = []
    for i in range(60):
        text = []
        for w in rng.choices(words, [1 / (k + 1) ** 1.3 for k in range(len(words))], k=400):
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "a", "b" + w[k]]) + w[k + 1 :]
            text.append(w)
        rows.append((i, rng.choice([" ", "1", "\n-"]).join(text)))
    chain = "chainsaw " * 200 + "chainsa " * 30 + "hainsa " * 5
    return rows + [(60, chain), (61, None), (62, ""), (None, "abcdefgh " * 9), (3, "abcdefgh " * 9), (3, "abcdefgh " * 9), (63, "z" * 100_000 + " Z"), (64, "x \x00 ŁŁŁŁŁŁŁ")]


@pytest.mark.parametrize(("drop", "letters"), [(0, 80_000), (7, 300)])
def test_spelling_against_all_pairs(spark, monkeypatch, drop, letters):
    monkeypatch.setattr(spelling, "INDEX_LETTERS", letters)  # several bins, and bins of several parts
    monkeypatch.setattr(spelling, "COUNTED", 100)
    rows = misspelt(drop)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n int, word string").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group(df, drop_one_in=drop).collect()}
    want = brute_spelling(rows, drop)
    assert got == want
    assert any(v[0] and v[0] != v[1] for v in want.values())  # chains of forms are among them


def test_spelling_of_nothing(spark):
    assert spelling.group(empty(spark)).count() == 0
    assert spelling.group(hard(spark).where("doc_id < 5")).count() == 0
    with pytest.raises(ValueError):
        spelling.group(hard(spark), least_length=5)
