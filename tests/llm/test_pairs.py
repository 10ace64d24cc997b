"""Jaccard join, embedding near-duplicates, components: brute force over all pairs."""

import random

import numpy as np
import pytest
from helpers import HARD, SF, documents, empty, hard
from oracle import differences
from pyspark.sql import functions as F

from tapeloom.llm import graph, jaccard, neardup, queries


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(4)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(140)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(60)]
    want = roots({x for e in links for x in e}, links)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in links)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute(rows):
    s = sets_of(rows)
    ids = sorted(s)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (o := len(s[a] & s[b])) and 100 * o >= 75 * len(s[a] | s[b])]
    return s, links, roots(ids, links)


def near_copies(seed=2, groups=6, copies=25):
    """Groups of texts of all sizes, edited to either side of the threshold, with a passage that all share."""
    rng = random.Random(seed)
    passage = [f"common{k}" for k in range(60)]
    rows, i = [], 0
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range((6, 9, 14, 40, 120, 300)[g % 6])]
        if g >= 3:
            base[5:5] = passage
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(1 + len(w) // 25 + (rng.random() < 0.3))):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            if rng.random() < 0.2:
                w = w[: -rng.randrange(1, 4)]
            rows.append((i, " ".join(w)))
            i += 1
    return rows


@pytest.mark.parametrize("settings", [jaccard.Settings(), jaccard.Settings(boundaries=(0,)), jaccard.Settings(boundaries=(64,)), jaccard.Settings(least_count=10**9, broadcast_ids=0), jaccard.Settings(list_rows=3, text_pairs=2)])
def test_join_equals_brute_force(spark, settings):
    rows = near_copies()
    s, links, want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    members, found = jaccard.join(docs, settings)
    got = {r.doc_id: r for r in members.collect()}
    assert {i: r.component_id for i, r in got.items()} == want and all(got[i].n_shingles == len(s[i]) for i in s)
    assert len(set(want.values())) < len(want)
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in found.collect()} <= set(links)


def test_join_on_documents_and_hard_rows(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    members, _ = jaccard.join(documents(spark))
    assert {r.doc_id: r.component_id for r in members.collect()} == brute(rows)[2]
    got = {r.doc_id: r for r in jaccard.join(hard(spark))[0].collect()}
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, 6: 6, 7: 7, 8: 8, 9: 8}
    assert [got[i].n_shingles for i in (2, 3, 4, 8)] == [0, 0, 0, 1]
    assert jaccard.join(empty(spark))[0].count() == 0


def test_keep_first(spark):
    """A copy without an id goes, one of several texts without an id and of several rows of an id stays, and a column named like a helper passes through."""
    nameless = [(None, "the quick brown fox jumps over the lazy dog"), (None, "a text without an id"), (None, "a text without an id"), (6, dict(HARD)[6])]
    docs = hard(spark).unionByName(hard(spark, nameless)).withColumn("key0", F.lit("x"))
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns[:1] + [c for c in docs.columns if c != "doc_id"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8] and kept.where("doc_id is null").first().text == "a text without an id"


def test_keep_first_moves_no_text(spark, capsys):
    """Texts aren't shuffled for the rows that stay, whatever Spark itself would broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.keep_first(spark.createDataFrame(near_copies(), "doc_id long, text string"))
        kept.explain()
        single = capsys.readouterr().out.split("SortAggregate")[0].split("HashAggregate")[0]
        want = set(brute(near_copies())[2].values())
        assert "BroadcastHashJoin" in single and "Exchange hashpartitioning(key" not in single
        assert {r.doc_id for r in kept.collect()} == want
        wide = jaccard.keep_first(spark.createDataFrame(near_copies(), "doc_id long, text string"), jaccard.Settings(broadcast_ids=0))
        assert {r.doc_id for r in wide.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sketches_tell_long_texts_apart():
    """Sets of thousands of shingles that share few are ruled out by their sketches; those at the threshold are not, whatever their sizes."""
    rng = np.random.default_rng(3)
    for n in (300, 3000, 20_000):
        a, b = (np.sort(rng.integers(0, 1 << 63, n, np.uint64) * 2) for _ in range(2))
        c = np.sort(np.concatenate([a[: n * 9 // 10], b[: n // 20]]))
        for other, ok in ((b, False), (c, True), (a[: n * 3 // 4], True), (a, True)):
            sets = jaccard.Sets.__new__(jaccard.Sets)
            sets.flat, sets.sizes = np.concatenate([a, other]), np.array([len(a), len(other)])
            sets.ends = np.cumsum(sets.sizes)
            x, y = jaccard.sketched(sets)
            most = jaccard.most_common(x, y)
            assert most >= len(np.intersect1d(a, other)) and (100 * most >= 75 * (len(a) + len(other) - most)) == ok, (n, ok)


def test_texts_that_share_an_id_are_compared_rightly(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " more"), (3, b + " more")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(docs)[0].collect()}
    assert got == {(1, 36, 1), (2, 37, 1), (3, 37, 1)}


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for label in (0, 1):
        centres = rng.normal(size=(60, 32))
        for c in centres:
            for _ in range(int(rng.integers(1, 6))):
                rows.append((i, (c + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.28])).astype(np.float32).tolist(), label))
                i += 1
    return rows + [(i, None, 0), (i + 1, [0.0] * 32, 0), (i + 2, [float("nan")] + [1.0] * 31, 0), (i + 3, [1.0, None], 1), (i + 4, rows[0][1], None), (i + 5, [], 1), (i + 6, [1.0, 2.0], 1)]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_embedding_links_and_recall(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, k, "x") for i, v, k in rows], "vec_id long, embedding array<float>, label int, a string")
    links = []
    good = [(i, np.float64(np.float32(v)), k) for i, v, k in rows if k is not None and usable(v)]
    for n, (i, x, k) in enumerate(good):
        links += [(i, j) for j, y, m in good[n + 1 :] if k == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93]
    members, _ = neardup.find(df)
    got = {r.vec_id: r for r in members.collect()}
    assert len(got) == len(rows)
    true = {i: sum(i in e for e in links) for i, _, _ in rows}
    assert all(got[i].n_links <= true[i] for i in true)
    assert sum(r.n_links for r in got.values()) >= 0.98 * sum(true.values()) > 0
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert neardup.find(df.limit(0))[0].count() == 0


def test_plan_reaches_its_recall():
    for largest in (10, 1000, 10**6):
        p = neardup.plan(largest)
        assert neardup.at_least(p.projections, neardup.collision_probability(0.93, p.signs, 0.4), p.least) >= 0.998


def test_embedding_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert neardup.find(rows)[0].count() == rows.count()


@pytest.mark.parametrize("name", ["op3_ngram_jaccard", "op4_embedding_neardup"])
def test_queries_equal_their_sql(spark, name):
    assert differences(spark, queries.queries()[name], queries.oracle_sql()[name], SF) == []


def test_vectors_with_repeated_ids_are_counted_apart(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (2, [1.0, 0.01]), (None, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, label string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in neardup.find(df)[0].collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (1, 2, 1, True), (3, 2, 1, False), (0, 2, 1, None)], key=repr)
