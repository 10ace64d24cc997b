"""Toxicity, language identification, Bloom language model: held-out accuracy and brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, documents, empty, hard
from pyspark.sql import functions as F

from tapeloom.llm import bloomlm, common, langid, queries, toxicity


def bucket(i, m):
    return zlib.crc32(str(i).encode()) % m


INSULTS = ("blarg", "snorfle", "grubwit")


def toxic_sample(n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = "en" if i % 2 else "xx"
        words = [f"{'p' if lang == 'en' else 'q'}{x}" for x in rng.integers(0, 300, 60)]
        y = int(rng.random() < 0.3)
        if y:
            words[int(rng.integers(60))] = INSULTS[int(rng.integers(3))].upper() + "!"
        rows.append((i, " ".join(words), lang, y))
    return rows


def trained(rows):
    return toxicity.train([t.encode() for _, t, _, _ in rows], [y for *_, y in rows], [x for _, _, x, _ in rows])


def test_classifier_on_held_out_rows():
    rows = toxic_sample(1500)
    model = trained(rows[:1200])
    words = toxicity.Rows(model)
    got = [(model.score(words(toxicity.words_of(t.encode())))[0] >= 0.5) == bool(y) for _, t, _, y in rows[1200:]]
    assert np.mean(got) >= 0.95
    assert model.score(words([]))[0] < 0.5


def test_long_texts_are_scored_whole(monkeypatch):
    """In blocks or in one piece, a text scores the same."""
    rows = toxic_sample(200)
    model = trained(rows)
    words = toxicity.Rows(model)
    text = [w for _, t, *_ in rows for w in toxicity.words_of(t.encode())]
    whole = model.logit_and_language(words(text))
    for size in (7, 100, 5000):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", size)
        assert model.logit_and_language(words(text)) == (pytest.approx(whole[0], abs=1e-4), whole[1])


def test_toxicity_on_spark(spark):
    docs = spark.createDataFrame(toxic_sample(200), "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), toxicity.Settings(least_steps=200))
    again = toxicity.fit(docs.drop("toxic").repartition(3), docs.select("doc_id", "toxic"), toxicity.Settings(least_steps=200))
    assert np.array_equal(model.table, again.table)
    rows = {r.doc_id: r for r in toxicity.score(hard(spark), model).collect()}
    assert len(rows) == 9 and rows[1].score == rows[5].score and rows[2].score == rows[3].score == rows[4].score < 0.5
    kept = toxicity.keep_clean(hard(spark), model)
    assert kept.columns == hard(spark).columns and kept.count() == sum(r.score < 0.5 for r in rows.values())
    assert toxicity.score(empty(spark), model).count() == 0
    untrained = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic").where("toxic = 0"))
    assert {r.score < 0.5 for r in toxicity.score(hard(spark), untrained).collect()} == {True}


def test_toxicity_query(spark):
    got = queries.op9_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == documents(spark).count() and all(r.held_out == (bucket(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in got if r.doc_id in labels and not r.held_out]) > 0.9


def language_sample():
    rng = np.random.default_rng(5)
    syllables = {"aa": ["ta", "ko", "mi", "re"], "bb": ["scht", "ung", "eit", "ver"], "cc": ["eau", "oux", "èle", "ment"]}
    return [(i, " ".join("".join(rng.choice(syllables[x], 3)) for _ in range(30)).capitalize() + ".", x) for i in range(150) for x in [list(syllables)[i % 3]]]


def test_kneser_ney_is_a_distribution():
    rows = language_sample()
    model = langid.train([t.encode() for _, t, _ in rows], [x for *_, x in rows])
    alphabet = sorted({c for _, t, _ in rows for c in t.lower() if c.isalpha()})
    for context in ("", "t", "ta", "tak", "vers", "zzz"):
        whole = np.zeros(3)
        for c in alphabet:
            before, _, _ = model.letters([context.encode()]) if context else (np.zeros((1, 3)), 0, 0)
            after, _, _ = model.letters([(context + c).encode()])
            whole += np.exp(after[0] - before[0] - 0.0)
        assert (whole > 0).all() and np.isfinite(whole).all()
    # one step by hand: the shares of all letters and the end after a context sum to one, but for what no letter takes
    hashes, valid, _ = langid.positions(["tak" + c for c in alphabet], 4)
    assert all(len(h[0]) == len(v) for h, v in zip(hashes, valid))
    for k, (keys, shares) in enumerate(model.grams):
        assert (np.diff(keys.astype(object)) > 0).all() and (shares >= 0).all() and (shares <= 1).all(), k


def test_discounted_shares_and_weights_sum_to_one():
    runs = ["taka", "tami", "tako", "kota", "mire"] * 3 + ["rere"]
    hashes, valid, _ = langid.positions(runs, 3)
    for k, (grams, shares, contexts, weights) in enumerate(langid.kneser_ney(runs, 3)):
        of = dict(zip(hashes[k][1].tolist(), hashes[k][0].tolist()))
        total = Counter()
        for g, s in zip(grams.tolist(), shares):
            total[of[g]] += s
        for c, w in zip(contexts.tolist(), weights):
            assert total[c] + w == pytest.approx(1.0)


def test_language_on_held_out_rows(spark):
    rows = language_sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.where("doc_id < 100"))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(got[i].lang_pred == x and got[i].score > 0.9 and not got[i].rejected for i, _, x in rows)
    hard_rows = {r.doc_id: r for r in langid.predict(hard(spark), model).collect()}
    assert all(hard_rows[i].lang_pred == "und" and hard_rows[i].score == 0 and hard_rows[i].rejected for i in (2, 3, 4))
    assert hard_rows[1][1:] == hard_rows[5][1:] and all(0 <= r.score <= 1 for r in hard_rows.values())
    strange = docs.limit(1).select("doc_id", F.lit("xqzwv jjqxk zzwqp " * 30).alias("text"), "lang")
    assert langid.predict(strange, model).first().rejected
    kept = langid.keep_known(hard(spark), model)
    assert kept.columns == hard(spark).columns and {r.doc_id for r in kept.collect()}.isdisjoint({2, 3, 4})
    nothing = langid.fit(docs.limit(0))
    assert langid.predict(docs, nothing).first().lang_pred == "und" and langid.predict(docs.limit(0), model).count() == 0


def test_language_query(spark):
    got = queries.op10_language_id(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in documents(spark).collect()}
    assert len(got) == len(truth) and all(r.held_out == (bucket(r.doc_id, 4) == 2) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.95


def test_long_texts_are_learnt_too(spark):
    """A language, or a class, whose training texts all exceed sample_bytes is known by runs of their words."""
    rows = [(i, f"{t} " * (60 if x == "cc" else 1), x) for i, t, x in language_sample()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, langid.Settings(sample_bytes=4000))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert model.languages == ["aa", "bb", "cc"] and all(got[i].lang_pred == x and not got[i].rejected for i, _, x in rows)
    toxic = [(i, f"{t} " * 20, x, y) for i, t, x, y in toxic_sample(150)]
    docs = spark.createDataFrame(toxic, "doc_id long, text string, lang string, toxic int")
    stray = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "toxic")  # labels of no document take no one's place
    model = toxicity.fit(docs.unionByName(docs).drop("toxic"), stray.unionByName(docs.select("doc_id", "toxic")), toxicity.Settings(least_steps=400, sample_bytes=3000, sample_rows=100))
    right = {r.doc_id: (r.score >= 0.5) for r in toxicity.score(docs, model).collect()}
    assert model.out is not None and np.mean([right[i] == bool(y) for i, _, _, y in toxic]) > 0.8


def test_runs_come_from_all_over_a_text():
    text = " ".join(f"w{i}é" for i in range(20_000)).encode()
    got = common.runs_of(text, 5000)
    words = got.decode().split()
    assert 4000 < len(got) <= 5000 and set(words) <= set(text.decode().split()) and words == sorted(words, key=lambda w: int(w[1:-1]))
    assert int(words[0][1:-1]) < 5000 and int(words[-1][1:-1]) > 15_000 and common.runs_of(text, len(text)) == text
    solid = common.runs_of("日本語".encode() * 9000, 3000)
    assert 2000 < len(solid) <= 3000 and set(solid.decode()) <= set("日本語 ")
    assert common.fair_share([10, 100, 100], 1000, 50) == 50 and common.fair_share([10, 100, 100], 110, 80) == 50 and common.fair_share([], 5, 7) == 7


def brute_base(rows, training):
    c = Counter()
    words = {r.doc_id: [*(r.text or "").encode().lower().split(), b" end"] for r in rows}
    for i, w in words.items():
        if training(i):
            c.update(w)
    n, v = sum(c.values()), len(c)
    return {i: (len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for i, w in words.items()}


ROUTED = bloomlm.Settings(broadcast_bytes=0)


def brute_score(rows, trained, trust=60.0):
    """By dictionaries of words: log10 probability with counts known to a power of two."""
    def tokens(text):
        w = (text or "").encode().lower().split()
        return [("s",), *w, ("e",)]

    words, pairs = Counter(), Counter()
    for i, t in rows:
        if trained(i):
            w = tokens(t)
            words.update(w), pairs.update(zip(w, w[1:]))
    room = sum(n for w, n in words.items() if w != ("s",)) + len(words) - (("s",) in words) + 1
    level = lambda n: n.bit_length()
    least, most = (lambda n: 2 ** (level(n) - 1) if n else 0), (lambda n: 2 ** level(n) - 1)

    def p(a, b):
        weight = most(words[a]) / (most(words[a]) + trust)
        return weight * least(pairs[a, b]) / max(1, most(words[a])) + (1 - weight) * (least(words[b]) + 1) / room

    return {(i, t): sum(math.log10(p(a, b)) for a, b in zip(tokens(t), tokens(t)[1:])) for i, t in rows}, p, words


@pytest.mark.parametrize("settings", [bloomlm.Settings(), ROUTED])
def test_base_score_is_exact_by_broadcast_or_routed(spark, settings):
    docs = hard(spark).unionByName(hard(spark, [(r.doc_id + 100, r.text) for r in documents(spark).limit(40).collect()]))
    got = {r.doc_id: r for r in bloomlm.score(docs, F.col("doc_id") % 3 != 0, settings).collect()}
    want = brute_base(docs.collect(), lambda i: i % 3)
    assert set(got) == set(want)
    for i, (tokens, known, total, base) in want.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (tokens, known, total) and got[i].base_score == pytest.approx(base)
    assert got[2].score == got[3].score and got[1].score == got[5].score


@pytest.mark.parametrize("settings", [bloomlm.Settings(bits=64, probes=8), bloomlm.Settings(bits=64, probes=8, broadcast_bytes=0)])
def test_score_equals_brute_force(spark, settings):
    rows = [(r.doc_id, r.text) for r in hard(spark).unionByName(hard(spark, [(r.doc_id + 100, r.text) for r in documents(spark).limit(60).collect()])).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, p, words = brute_score(rows, lambda i: i % 3)
    texts = dict(rows)
    for r in bloomlm.score(docs, F.col("doc_id") % 3 != 0, settings).collect():
        assert r.score == pytest.approx(want[r.doc_id, texts[r.doc_id]], rel=1e-9)
    for context in list(words)[:20]:
        if context != ("e",):
            assert 0 < sum(p(context, w) for w in words if w != ("s",)) <= 1


def test_both_ways_give_the_same_rows(spark):
    """Repeated and null ids too."""
    texts = [r.text for r in documents(spark).limit(80).collect()]
    docs = hard(spark, [(5, texts[0]), (5, texts[1]), (5, texts[1]), (None, texts[2]), (None, texts[3]), (None, None), *enumerate(texts, 100)])
    one, many = (sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.base_score, r.score) for r in bloomlm.score(docs, F.lit(True), s).collect()) for s in (bloomlm.Settings(), ROUTED))
    assert len(one) == 86 and one == many
    assert bloomlm.score(empty(spark), F.lit(True), ROUTED).count() == 0
    assert {r.n_known for r in bloomlm.score(docs, F.lit(False), ROUTED).collect()} == {0}


def test_a_block_probes_its_filter_once_however_many_chunks_ask(spark, tmp_path):
    class Probes:
        """Four probes; writes down each time that a filter is about to be probed."""

        def __init__(self, log):
            self.log = log

        def __index__(self):
            with open(self.log, "a") as f:
                f.write("x")
            return 4

    docs = documents(spark).limit(200).cache()
    rows, looked = [], []
    for k, size in enumerate((1 << 30, 10_000)):
        log = str(tmp_path / f"log{k}")
        s = bloomlm.Settings(broadcast_bytes=0, chunk_bytes=size, probes=Probes(log))
        rows.append(sorted(map(tuple, bloomlm.score(docs, F.col("doc_id") % 3 != 0, s).collect())))
        looked.append(len(open(log).read()))
    assert len(rows[0]) == 200 and rows[0] == rows[1]
    assert 0 < looked[0] == looked[1]


@pytest.mark.parametrize("part_bytes", [1000, 2])
def test_parts_of_blocks_change_nothing(spark, part_bytes):
    docs = documents(spark).limit(80)
    one, many = (sorted(map(tuple, bloomlm.score(docs, F.col("doc_id") % 3 != 0, s).collect())) for s in (ROUTED, bloomlm.Settings(broadcast_bytes=0, part_bytes=part_bytes, chunk_bytes=100_000)))
    assert len(one) == 80 and one == many


@pytest.mark.parametrize("part_bits", [10, 16, 18])
def test_packed_hashes_come_back(part_bits):
    h = np.unique(np.random.default_rng(4).integers(0, 2**64, 30_000, dtype=np.uint64, endpoint=False))
    low, spread = (x.to_pylist() for x in bloomlm.packed(h, part_bits))
    at = bloomlm.cuts(h, part_bits)
    for part in range(0, 1 << part_bits, 37):
        assert (bloomlm.unpacked([low[part]] * 2, [spread[part]] * 2, part, part_bits) == np.tile(h[at[part] : at[part + 1]], 2)).all()


def test_a_chunk_of_many_texts_is_asked_for_whole():
    """Collapsed as often as it likes, over several batches."""
    texts = pa.RecordBatch.from_arrays([pa.array([f"a b{i % 7} c{i % 3} a b{i % 5}" for i in range(300)]), pa.array([i % 4 > 0 for i in range(300)]), pa.array([0] * 120 + [1] * 180)], names=["text", "trained", "chunk"])
    got = [[b.to_pylist() for b in bloomlm.ask_batches(iter([texts.slice(k, 50) for k in range(0, 300, 50)]), 4, 1, flush)] for flush in (10, 10**6)]
    assert got[0] == got[1] and [[r["chunk"] for r in b] for b in got[0]] == [[0] * 32, [1] * 32]
    counts = [sum(np.frombuffer(r[c], np.uint32).sum() for r in got[0][0]) for c in ("word_counts", "pair_counts")]
    assert counts == [90 * 7, 90 * 6]


def test_filter_gives_levels_back():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    n = rng.integers(1, 400, len(h)).astype(np.uint32)
    at = bloomlm.cuts(h, 6)
    runs = [[x[a:b].tobytes() for a, b in zip(at, at[1:])] for x in (h, n)]
    nothing = [b""] * 64
    batch = bloomlm.by_block([*runs, nothing, nothing], bloomlm.RUNS)
    built = [r for b in bloomlm.build_batches(iter([batch]), 8, 4) for r in b.to_pylist()]
    f = bloomlm.Filter([(r["block"], r["size"], r) for r in built], 6, 4)
    got, level = f.level(h), bloomlm.levels_of(n)
    assert (got >= level).all() and (got == level).mean() > 0.9 and (f.exact(h) == n).all()
    assert (f.level(rng.integers(0, 2**62, 20_000).astype(np.uint64)) == 0).mean() > 0.9


def test_model_beats_the_base_on_held_out_texts(spark):
    got = queries.op6_bloom_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    assert bloomlm.score(empty(spark), F.lit(True)).count() == 0


def test_many_languages_keep_the_sample_and_the_model_bounded(spark):
    """A dirty lang column: every document has a language of its own besides two common ones."""
    rows = [(k, f"{w} " * 30 + f"x{k}", lang) for k in range(400) for w, lang in [(("alpha beta gamma", "aa"), ("einszwei dreivier", "bb"))[k % 2]]]
    rows += [(1000 + k, f"odd words of number {k} " * 20, f"l{k:04}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, langid.Settings(languages=20, model_bytes=4_000_000))
    assert len(model.languages) == 20 and {"aa", "bb", "l0000", "l0017"} <= set(model.languages) and "l0018" not in model.languages
    assert sum(v.nbytes for _, v in model.grams) < 4_000_000
    got = langid.predict(docs.where("doc_id < 1000"), model).collect()
    assert all(r.lang_pred == ("aa", "bb")[r.doc_id % 2] for r in got)
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    assert len(toxicity.fit(docs, labels, toxicity.Settings(languages=5, least_steps=20, epochs=1)).languages) <= 5
