"""Toxicity scores from a small convolutional text classifier, trained here in numpy.

A word (lower-cased, without leading and trailing marks) has the sum of two rows of an embedding table keyed by hash, one of
the whole word and one of its first bytes, so that inflected forms share what they learn.  Hashes that fewer than
``least_documents`` training texts hold can't tell classes apart and have a row of zeros.  Filters of widths 1, 2 and 3 pass over
the word sequence, the maximum of each filter over the whole text is kept, and a logistic output follows.  A bounded sample
of labelled texts trains it by Adam.  Thresholds are calibrated by language: a multinomial model over the same hashed
words, learned from the training rows' language tags, guesses a text's language from the text alone; on rows set aside
from training, each guessed language gets the threshold that divides its labels best, and a score is shifted so that this threshold becomes 0.5.

At scoring time every word's contribution to each filter position is multiplied out once, so a text costs one gather and a few
additions a word.  Whole texts are scored, in blocks that overlap by the widest filter; nothing is shuffled.

Edge cases: null or empty text has no word and gets the score of an empty sequence (below 0.5); repeated rows get equal scores; without any
labelled row of both classes every score is 0; an empty table gives no rows; only id and text are read from the
table scored, so further columns don't matter.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, give_back, hold, numbers, slices, small_batches, training_sample

SCHEMA = "doc_id long, score double, language_guess string"
MARKS = (string.punctuation + string.whitespace).encode()
BLOCK_WORDS = 1 << 15


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` and ``class_bytes`` bound the labelled rows that training uses, and their text, per class.  Of a text over ``sample_bytes``,
    or over its fair share of ``class_bytes``, training uses runs of words from all over it, up to that length.
    Training passes over them ``epochs`` times, more often if that makes fewer than ``least_steps`` updates;
    each time a text shows each of its words with probability ``keep_words``, so that no single one is learnt by heart.
    Thresholds are calibrated for the ``languages`` most frequent ones of the sample; texts of others count without a language."""

    least_documents: int = 3
    dimensions: int = 8
    filters: int = 5
    prefix_bytes: int = 4
    widths: tuple[int, ...] = (1, 2, 3)
    sample_rows: int = 4000
    sample_bytes: int = 20_000
    class_bytes: int = 24_000_000
    languages: int = 32
    epochs: int = 8
    least_steps: int = 800
    batch: int = 32
    rate: float = 0.02
    keep_words: float = 0.5
    shrink: float = 0.01
    decay: float = 1e-5
    calibration_share: float = 0.2
    seed: int = 11


@dataclass
class Model:
    """``known``: sorted hashes of the rows from 1 on; row 0 stands for all others.  ``table``: of each embedding row its contribution to each (width, position) of each filter, then its log probability in each language."""

    settings: Settings
    known: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    table: np.ndarray | None = None
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    out_bias: float = -20.0
    languages: list[str] = field(default_factory=list)
    threshold: np.ndarray | None = None  # logits by guessed language

    def logit_and_language(self, rows: np.ndarray) -> tuple[float, int]:
        """Of a whole text's words, as their sums of table rows."""
        if self.out is None:
            return self.out_bias, -1
        s = self.settings
        best = np.zeros((len(s.widths), s.filters), np.float32)
        logs = np.zeros(max(1, len(self.languages)))
        overlap = max(s.widths) - 1
        for at in range(0, len(rows), BLOCK_WORDS):
            block = rows[at : at + BLOCK_WORDS + overlap]
            logs[: len(self.languages)] += block[:BLOCK_WORDS, sum(s.widths) * s.filters :].sum(0)
            col = 0
            for i, width in enumerate(s.widths):
                n = len(block) - width + 1
                if n > 0:
                    act = block[:n, col : col + s.filters]
                    for k in range(1, width):
                        act = act + block[k : k + n, col + k * s.filters : col + (k + 1) * s.filters]
                    np.maximum(best[i], act.max(0) + self.bias[i], out=best[i])
                col += width * s.filters
        return float(best.ravel() @ self.out + self.out_bias), int(logs.argmax()) if self.languages else -1

    def score(self, rows: np.ndarray) -> tuple[float, str | None]:
        z, k = self.logit_and_language(rows)
        if self.threshold is not None:
            z -= float(self.threshold[max(k, 0)])
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30)))), self.languages[k] if k >= 0 else None


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def hashes_of(words: list[bytes], settings: Settings) -> np.ndarray:
    """The two hashes of each word, as rows."""
    bare = [w.strip(MARKS) for w in words]
    return np.array([[xxhash.xxh64_intdigest(b), xxhash.xxh64_intdigest(b[: settings.prefix_bytes], 1)] for b in bare], np.uint64).reshape(-1, 2)


def rows_of(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(hashes.shape, np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


class Rows:
    """Words' sums of table rows, each distinct word summed once and remembered up to ``limit`` words."""

    def __init__(self, model: Model, limit: int = 120_000):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.known = Numbered()
        self.sums = np.empty((1024, self.model.table.shape[1] if self.model.table is not None else 0), np.float32)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.clear()
        at = numbers(words, self.known)
        if new := self.known.new:
            self.known.new = []
            if self.model.table is not None:
                while len(self.sums) < len(self.known):
                    self.sums = np.concatenate([self.sums, np.empty_like(self.sums)])
                pairs = rows_of(self.model.known, hashes_of(new, self.model.settings))
                self.sums[len(self.known) - len(new) : len(self.known)] = self.model.table[pairs[:, 0]] + self.model.table[pairs[:, 1]]
        return self.sums[at] if self.model.table is not None else np.empty((len(at), 0), np.float32)


def train(texts: list[bytes | None], toxic: list[int], langs: list[str | None], settings: Settings = Settings()) -> Model:
    """Fit on the given rows; deterministic in their order."""
    model, rng = Model(settings), np.random.default_rng(settings.seed)
    y = np.array(toxic, np.float32)
    if not 0 < y.sum() < len(y):
        return model
    words = Numbered()
    split = [numbers(words_of(t), words) for t in texts]
    hashes = hashes_of(words.new, settings)
    names, documents = np.unique(np.concatenate([np.unique(hashes[w]) for w in split]), return_counts=True)
    model.known = names[documents >= settings.least_documents]
    pairs = rows_of(model.known, hashes)
    ids = [pairs[w] for w in split]
    order = rng.permutation(len(ids))
    held = order[: max(1, int(len(ids) * settings.calibration_share))]
    used = order[len(held) :]
    model.table = np.concatenate([_fit_filters(model, [ids[i] for i in used], y[used], rng), _fit_language(model, [ids[i] for i in used], [langs[i] for i in used])], 1)
    _calibrate(model, ids, y, held)
    return model


def _fit_language(model: Model, ids: list[np.ndarray], langs: list[str | None]) -> np.ndarray:
    model.languages = sorted({x for x in langs if x})
    counts = np.full((len(model.known) + 1, len(model.languages)), 0.1)
    for i, lang in zip(ids, langs):
        if lang:
            counts[:, model.languages.index(lang)] += np.bincount(i.ravel(), minlength=len(counts))
    logs = np.log(counts / counts.sum(0)).astype(np.float32)
    logs[0] = 0
    return logs


def _fit_filters(model: Model, ids: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    s = model.settings
    n_out = s.filters * len(s.widths)
    p = {"emb": rng.normal(0, 0.1, (len(model.known) + 1, s.dimensions)).astype(np.float32), "out": rng.normal(0, 0.3, n_out).astype(np.float32), "b": np.zeros(1, np.float32)}
    p["emb"][0] = 0
    for w in s.widths:
        p[f"w{w}"] = rng.normal(0, 0.3, (w, s.dimensions, s.filters)).astype(np.float32)
        p[f"b{w}"] = np.zeros(s.filters, np.float32)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    balance = (len(y) - y.sum()) / max(1, y.sum())
    for _ in range(max(s.epochs, -(-s.least_steps * s.batch // max(1, len(ids))))):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), s.batch):
            step += 1
            grad = {k: np.zeros_like(v) for k, v in p.items() if k != "emb"}
            rows_all, grads_all = [], []
            chosen = order[at : at + s.batch]
            for k in chosen:
                x = ids[k][rng.random(len(ids[k])) < s.keep_words]
                if not len(x):
                    continue
                e = p["emb"][x[:, 0]] + p["emb"][x[:, 1]]
                best, where = np.zeros(n_out, np.float32), np.full(n_out, -1)
                for i, w in enumerate(s.widths):
                    n = len(x) - w + 1
                    if n <= 0:
                        continue
                    act = sum(e[j : j + n] @ p[f"w{w}"][j] for j in range(w)) + p[f"b{w}"]
                    top = act.argmax(0)
                    value = act[top, np.arange(s.filters)]
                    cut = slice(i * s.filters, (i + 1) * s.filters)
                    best[cut] = np.maximum(value, 0)
                    where[cut] = np.where(value > 0, top, -1)
                z = float(best @ p["out"] + p["b"][0])
                g = (1 / (1 + np.exp(-z)) - y[k]) * (balance if y[k] else 1.0) / len(chosen)
                grad["b"][0] += g
                grad["out"] += g * best
                for i, w in enumerate(s.widths):
                    for f in range(s.filters):
                        o = i * s.filters + f
                        if where[o] < 0:
                            continue
                        d = g * p["out"][o]
                        grad[f"b{w}"][f] += d
                        window = x[where[o] : where[o] + w]
                        grad[f"w{w}"][:, :, f] += d * e[where[o] : where[o] + w]
                        rows_all += [window[:, 0], window[:, 1]]
                        grads_all += [d * p[f"w{w}"][:, :, f]] * 2
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                p[k] -= s.rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8) + s.decay * p[k]
            if rows_all:  # the embedding's moments are kept and moved only for rows that a filter's maximum touched
                where, back = np.unique(np.concatenate(rows_all), return_inverse=True)
                g = np.zeros((len(where), s.dimensions), np.float32)
                np.add.at(g, back, np.concatenate(grads_all))
                g[where == 0] = 0
                first["emb"][where] = 0.9 * first["emb"][where] + 0.1 * g
                second["emb"][where] = 0.99 * second["emb"][where] + 0.01 * g * g
                p["emb"][where] *= 1 - s.shrink
                p["emb"][where] -= s.rate * first["emb"][where] / (np.sqrt(second["emb"][where]) + 1e-6)
    model.bias = np.stack([p[f"b{w}"] for w in s.widths])
    model.out, model.out_bias = p["out"], float(p["b"][0])
    return np.concatenate([p["emb"] @ p[f"w{w}"][j] for w in s.widths for j in range(w)], 1)


def _calibrate(model: Model, ids: list[np.ndarray], y: np.ndarray, held: np.ndarray) -> None:
    """By guessed language, the logit that divides the rows set aside best; the middle of the best range, drawn towards all languages' for few rows."""
    got = [model.logit_and_language(model.table[ids[i][:, 0]] + model.table[ids[i][:, 1]]) for i in held]
    z, lang = np.array([z for z, _ in got]), np.array([k for _, k in got])

    def cut(z: np.ndarray, y: np.ndarray, prior: float) -> float:
        if not len(z) or not 0 < y.sum() < len(y):
            return prior
        at = np.sort(np.concatenate([z, [z.min() - 1, z.max() + 1]]))
        mids = (at[1:] + at[:-1]) / 2
        weight = np.where(y > 0, (len(y) - y.sum()) / y.sum(), 1.0) ** 0.5
        loss = np.array([weight[(z >= m) != (y > 0)].sum() for m in mids]) + 0.01 * np.abs(mids - prior) / (1 + np.abs(mids - prior))
        return float(mids[loss.argmin()])

    prior = cut(z, y[held], 0.0)
    model.threshold = np.array([cut(z[lang == k], y[held][lang == k], prior) if (lang == k).sum() >= 40 else prior for k in range(max(1, len(model.languages)))])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang") -> Model:
    """Train on at most ``settings.sample_rows`` of the labelled documents of each class, the lowest by a hash of the id; long texts by runs of words.
    Only that sample reaches the driver.  Of documents that share an id the shortest counts; an id labelled both ways is toxic."""
    s = settings
    y = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("grp"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("text").isNotNull())
    keys = rows.groupBy("id").agg(F.min(F.octet_length("text")).alias("size")).join(y, "id")
    got = training_sample(keys, rows, s.sample_rows, s.sample_bytes, s.class_bytes)
    found = Counter(x for x in got["lang"] if isinstance(x, str))
    usual = set(sorted(found, key=lambda x: (-found[x], x))[: s.languages])
    model = train([bytes(t) for t in got["text"]], got["grp"].tolist(), [x if x in usual else None for x in got["lang"]], settings)
    del got
    give_back()
    return model


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    hold("toxicity")
    rows = Rows(model)
    for batch, texts in slices(batches):
        got = [model.score(rows(words_of(t))) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in got], pa.float64()), pa.array([g for _, g in got], pa.string())], names=["doc_id", "score", "language_guess"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA.  The model is of fixed size (hashes known from the sample x widths x filters) and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda b: score_batches(b, shared.value), SCHEMA)


def keep_batches(batches: Iterator[pa.RecordBatch], model: Model, text_col: str, limit: float) -> Iterator[pa.RecordBatch]:
    hold("toxicity")
    rows = Rows(model)
    for batch, texts in slices(batches, text_col):
        keep = pa.array([model.score(rows(words_of(t)))[0] < limit for t in texts], pa.bool_())
        yield batch.filter(keep)


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, in all their columns, that score below ``limit``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda b: keep_batches(b, shared.value, text_col, limit), docs.schema)
