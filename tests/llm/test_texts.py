"""Packing, media, byte-level BPE: exact round trips and brute force."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, empty, hard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tapeloom.llm import bpe, media, packing

WORDS, RANKS = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_packing(rows, packed):
    t = Tokenizer.from_file(WORDS)
    ids = {}
    for r in rows:
        ids.setdefault(r.doc_id, np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4"))
    by_doc, by_seq = {}, {}
    for p in packed:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(ids[d])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == ps[0].sequence_tokens and (at == 4096 or at & (at - 1) == 0)


def test_packing_of_documents(spark):
    docs = documents(spark).repartition(3)
    check_packing(docs.collect(), packing.pack(docs, WORDS).collect())


def test_words_that_are_dropped_are_encoded_again():
    """With room for few words, what was met once goes, what is met often stays, and ids are the tokenizer's throughout."""
    t, words = Tokenizer.from_file(WORDS), packing.WordTokens(WORDS, 40)
    for k in range(30):
        texts = [f"the fox {k} number{k * 7} a|b || the", "", None, "日本語 don't the", " ".join(f"w{k}x{i}" for i in range(k))]
        got = words.encode([None if x is None else x.encode() for x in texts], 2)
        assert [g.tolist() for g in got] == [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]
        assert b"the" in words.index and len(words.index) == len(words.starts) == len(words.uses) <= 40 + 35
    assert words.encode([], 2) == []


def test_words_split_into_letters_and_marks_keep_their_ids(monkeypatch):
    """Case, marks at the end, composed and combining letters and special tokens come out as the tokenizer has them; letters met before aren't encoded again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, tokens = Tokenizer.from_file(path), packing.WordTokens(path)
    words = "Word word, WORD!? word's WORD'S it'll' Été été. ÉTÉ%%% e\u0301te\u0301 J\u030c j\u030c, K\u030c \u212aelvin Stra\u1e9ee STRASSE a\u0338= =\u0338 x|y <|endoftext|> <|ENDOFTEXT|> 12ab, ab12. --ab ªb ΣΑΣ. a\u00a0b, \x1c".split(" ")
    for texts in ([" ".join(words)], words, [w * 3 for w in words], [w.swapcase() for w in words]):
        got = tokens.encode([t.encode() for t in texts], 2)
        assert [g.tolist() for g in got] == [[k for w in t.encode().split() for k in whole.encode(w.decode(), add_special_tokens=False).ids] + [2] for t in texts]
    sent, encoded = [], tokens.encoded
    monkeypatch.setattr(tokens, "encoded", lambda tokenizer, words: sent.extend(words) or encoded(tokenizer, words))
    tokens.encode([b"word... WORD??! Word;"], 2)
    assert sorted(sent) == ["", "...", ";", "??!"]


def test_packing_of_hard_rows(spark):
    docs = hard(spark)
    check_packing(docs.collect(), packing.pack(docs, WORDS).collect())
    assert packing.pack(empty(spark), WORDS).count() == 0


def test_descending_pieces_go_to_the_cheapest_sequence_with_room():
    out, rest = packing.fill([(0, 0, 6), (1, 0, 5), (2, 0, 4), (3, 0, 3), (4, 0, 2)], [10, 10], 1.0, 0.1)
    assert out[0] == [(0, 0, 6), (3, 0, 3), (4, 0, 1)] and out[1] == [(1, 0, 5), (2, 0, 4), (4, 1, 1)] and rest == []


@given(st.lists(st.integers(1, 5000), max_size=60), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_fill_keeps_every_token(lengths, n):
    out, rest = packing.fill([(i, 0, x) for i, x in enumerate(lengths)], [4096] * n, 1.0, 0.001)
    cover = {}
    for p in [*sum(out, []), *rest]:
        cover.setdefault(p[0], []).append(p[1:])
    for i, x in enumerate(lengths):
        at = 0
        for start, m in sorted(cover[i]):
            assert start == at
            at += m
        assert at == x
    assert all(sum(m for _, _, m in s) <= 4096 for s in out)


@given(st.binary(max_size=9000))
@settings(max_examples=80, deadline=None)
def test_transport_stream_round_trip(text):
    payload = media.padded(text)
    stored = media.mux(payload)
    got = media.demux(stored)
    assert got.payload == payload and len(stored) % 188 == 0 and got.continuity_errors == 0 and got.random_access[0] == 0
    assert got.timestamps == [3600 * k for k in range(len(got.timestamps))]


def test_transport_stream_faults_are_seen():
    stored = media.mux(bytes(range(256)) * 40)
    lost = stored[: 188 * 5] + stored[188 * 6 :]
    assert media.demux(lost).continuity_errors == 1
    with pytest.raises(ValueError, match="checksum"):
        media.demux(stored[:20] + bytes([stored[20] ^ 1]) + stored[21:])
    with pytest.raises(ValueError):
        media.demux(b"x" + stored[1:])


def test_media_columns(spark):
    docs = hard(spark)
    got = {r.doc_id: r for r in media.features(media.store(docs)).collect()}
    for r in docs.collect():
        raw = (r.text or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        g = got[r.doc_id]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert got[1][3:] == got[5][3:] and got[2][3:] == got[3][3:]
    lines = {r.doc_id: r for r in media.timeline(media.store(docs)).collect()}
    assert len(lines[7].random_access) == -(-len(lines[7].timestamps) // 8) and bytes(lines[8].payload).rstrip(b"\0") == b"short"
    assert media.features(media.store(empty(spark))).count() == 0


def check_bpe(rows, got):
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for r in rows:
        ids = ref.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert g.n_tokens == len(ids) and g.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_bpe_equals_tiktoken(spark):
    for docs in (documents(spark), hard(spark)):
        check_bpe(docs.collect(), {r.doc_id: r for r in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()})
    got = {r.doc_id: r for r in bpe.encode(hard(spark), RANKS, public_tokenizers.PATTERN).collect()}
    assert got[2].ids == []
    coded = bpe.encode(hard(spark), RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {r.doc_id: (r.text or "").encode() for r in hard(spark).collect()}
    assert bpe.digests(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.fixture(scope="module")
def encoders():
    own = bpe.WordEncoder(RANKS, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@given(st.lists(st.text(max_size=40), max_size=4))
@settings(max_examples=60, deadline=None)
def test_bpe_on_any_text(encoders, texts):
    own, ref = encoders
    got = list(own.encode(texts))
    assert [g.tolist() for g in got] == [ref.encode_ordinary(t) for t in texts] and own.decode(got) == [t.encode() for t in texts]


def test_chunks_that_look_like_other_keys(encoders):
    own, ref = encoders
    texts = ["a \0fb", "a \0wb", "\0f x", "b'x' b", "a  b", " a", "a ", "x\ny z", "", " "]
    assert [g.tolist() for g in own.encode(texts)] == [ref.encode_ordinary(t) for t in texts]


def test_words_of_any_length(encoders):
    own, ref = encoders
    rng = np.random.default_rng(2)
    texts = ["a" * 100_000, "ab" * 40_000, "".join(rng.choice(list("abcdehinorst"), 30_000)), "é" * 5000 + " x", "the" * 300]
    got = list(own.encode(texts))
    assert own.decode(got) == [t.encode() for t in texts]
    assert all(len(t) > 50_000 or ids.tolist() == ref.encode_ordinary(t) for t, ids in zip(texts, got))
    short = ["".join(rng.choice(list("abcdehinorst"), 200)) for _ in range(20)]
    assert [own.contract_long(t.encode()) for t in short] == [ref.encode_ordinary(t) for t in short]


def test_texts_without_spaces_take_no_longer_than_their_length():
    import random
    import resource
    import time

    import public_tokenizers
    import tiktoken

    encoder = bpe.WordEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    known = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("的是了不在有abcdefghij") for _ in range(n))
    began, before = time.process_time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for n, count in ((140, 1500), (250, 1000), (600, 500), (500_000, 1)):  # middle-sized words, and one without end
        text = "\n".join(word(n) for _ in range(count))
        assert next(encoder.encode([text])).tolist() == known.encode_ordinary(text)
    assert time.process_time() - began < 60 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000
    assert encoder.db.sql("SELECT current_setting('temp_directory')").fetchall()[0][0] in ("", None)
