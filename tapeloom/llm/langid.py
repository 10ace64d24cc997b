"""Language identification by interpolated Kneser-Ney character models.

Of each language a bounded sample of texts trains a model over the characters of its words (letter runs, lower-cased, between
word boundaries): absolute discounting by order, continuation counts below the highest order, interpolation down to a uniform
distribution.  All languages' models share sorted arrays of hashed n-grams and contexts, each entry with one column a
language, found by binary search.  A text goes to the language of the lowest cross-entropy a character; it is rejected
if it has no letter, or if that cross-entropy lies beyond a limit calibrated on rows set aside from each language's sample.

Distinct words are scored once and remembered, so a text costs a lookup and an addition a word; nothing is shuffled but the sample's keys.

Edge cases: null, empty and letterless texts get ``und`` with score 0 and are rejected; ties go to the first language by name;
repeated rows get equal results; an empty table, or one without language tags, teaches nothing: every text is ``und``;
only id and text are read from the table predicted, so further columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, give_back, hold, mix, numbers, slices, small_batches, training_sample

SCHEMA = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
UNKNOWN = "und"
#: Words scored at once.
BLOCK_WORDS = 10_000
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` and ``language_bytes`` bound the texts a language and their bytes.  Of a text over ``sample_bytes``, or over its
    fair share of ``language_bytes``, training uses runs of words from all over it, up to that length.

    ``languages`` bounds the languages that are learned: those with the most tagged documents (ties: first by name).  The model has a column a language for each n-gram of any,
    so it grows with bytes times languages squared; ``model_bytes`` bounds that product, and with it what the driver holds and broadcasts: beyond ten
    languages of ``language_bytes`` each learns from less."""

    order: int = 4
    sample_rows: int = 400
    sample_bytes: int = 20_000
    language_bytes: int = 3_000_000
    languages: int = 200
    model_bytes: int = 300_000_000
    calibration_share: float = 0.25
    quantile: float = 0.995
    margin: float = 0.5
    short_margin: float = 6.0
    sharpness: float = 30.0


@dataclass
class Model:
    settings: Settings
    languages: list[str] = field(default_factory=list)
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # by order: sorted hashes, discounted shares
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # by order: sorted hashes, weights of the next lower order
    floor: float = 1e-4
    limits: np.ndarray | None = None

    def letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words: log probability by language summed over its letters and word ends, number of these, of letters."""
        n = len(words)
        total, counts, letters = np.zeros((n, len(self.languages))), np.zeros(n), np.zeros(n)
        runs, owner = [], []
        for i, w in enumerate(words):
            for run in LETTERS.findall(w.decode("utf-8", "replace").lower()):
                runs.append(run)
                owner.append(i)
        if not runs or not self.languages:
            return total, counts, letters
        hashes, valid, which = positions(runs, self.settings.order)
        p = np.full((len(which), len(self.languages)), self.floor)
        for k in range(self.settings.order):
            here = valid[k]
            share = lookup(self.grams[k], hashes[k][1][here], 0.0)
            weight = lookup(self.contexts[k], hashes[k][0][here], 1.0)
            p[here] = share + weight * p[here]
        at = np.array(owner)[which]
        logs = np.log(p)
        for j in range(len(self.languages)):
            total[:, j] = np.bincount(at, logs[:, j], n)
        counts += np.bincount(at, minlength=n)
        letters += np.bincount(np.array(owner), [len(r) for r in runs], n)
        return total, counts, letters

    def predict(self, sums: np.ndarray, count: float, letters: float) -> tuple[str, float, float | None, bool]:
        if not letters or not self.languages:
            return UNKNOWN, 0.0, None, True
        entropy = -sums / count
        best = int(entropy.argmin())
        score = float(1 / np.exp(-(entropy - entropy[best]) * self.settings.sharpness).sum())
        limit = self.limits[best] + self.settings.short_margin / np.sqrt(count)
        return self.languages[best], score, float(entropy[best]), bool(entropy[best] > limit)


def positions(runs: list[str], order: int):
    """Hashes of each run's n-grams and their contexts: for k = 1..order, (context, n-gram) at each predicted position and where it fits in its word; which run a position is in.

    A run is read as a word boundary, its letters, and a boundary; all but the first are predicted.
    """
    codes = np.frombuffer((" " + " ".join(runs) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = codes == 32
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], space[:-1]]), np.arange(len(codes)) - 1, -1))  # the boundary before
    depth = np.arange(len(codes)) - begin  # characters since that boundary, itself included
    which = np.cumsum(np.concatenate([[0], space[:-1]]))[1:] - 1
    with np.errstate(over="ignore"):
        spread = codes * np.uint64(0x9E3779B97F4A7C15)
        before = np.zeros(len(codes), np.uint64)
        hashes, valid = [], []
        for k in range(1, order + 1):
            gram = mix(before + spread + np.uint64(k))
            hashes.append((before[1:], gram[1:]))
            valid.append(depth[1:] >= k - 1 if k > 1 else np.ones(len(codes) - 1, bool))
            before = np.concatenate([[np.uint64(0)], gram[:-1]])
    return hashes, valid, which


def lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    known, values = table
    if not len(known):
        return np.full((len(keys), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where((known[at] == keys)[:, None], values[at], missing)


def kneser_ney(runs: list[str], order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of one language, by order: n-gram hashes and their discounted shares, context hashes and the weight left to lower orders."""
    hashes, valid, _ = positions(runs, order)
    out = []
    for k in range(order):
        context, gram = (h[valid[k]] for h in hashes[k])
        if k + 1 < order:  # continuation counts; an n-gram that begins a word has no left neighbour and keeps its count
            longer = valid[k + 1]
            _, first = np.unique(hashes[k + 1][1][longer], return_index=True)
            starts = valid[k] & ~longer
            gram = np.concatenate([hashes[k][1][longer][first], hashes[k][1][starts]])
            context = np.concatenate([hashes[k][0][longer][first], hashes[k][0][starts]])
        keys, first, count = np.unique(gram, return_index=True, return_counts=True)
        of = context[first]
        ones, twos = int((count == 1).sum()), int((count == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        names, back = np.unique(of, return_inverse=True)
        sums = np.bincount(back, count)
        out.append((keys, np.maximum(count - discount, 0) / sums[back], names, discount * np.bincount(back) / sums))
    return out


def train(texts: list[bytes], langs: list[str], settings: Settings = Settings()) -> Model:
    model = Model(settings, sorted(set(langs)))
    if not model.languages:
        return model
    kept: dict[str, list[bytes]] = {x: [] for x in model.languages}
    for t, x in zip(texts, langs):
        kept[x].append(t)
    held = {x: t[: int(len(t) * settings.calibration_share)] for x, t in kept.items()}
    tables, alphabet = [], set()
    for x in model.languages:
        runs = [r for t in kept[x][len(held[x]) :] for r in LETTERS.findall(t.decode("utf-8", "replace").lower())] or ["a"]
        alphabet.update(*set(runs))
        tables.append(kneser_ney(runs, settings.order))
    model.floor = 1 / (len(alphabet) + 2)
    for k in range(settings.order):
        for part, into, missing in ((0, model.grams, 0.0), (2, model.contexts, 1.0)):
            keys = np.unique(np.concatenate([t[k][part] for t in tables]))
            values = np.full((len(keys), len(tables)), missing)
            for j, t in enumerate(tables):
                values[np.searchsorted(keys, t[k][part]), j] = t[k][part + 1]
            into.append((keys, values))
    limits = []
    for j, x in enumerate(model.languages):
        entropies = []
        for t in held[x]:
            total, count, letters = model.letters(list(t.split()))
            if letters.sum() >= 100:
                entropies.append(-total[:, j].sum() / count.sum())
        limits.append(np.quantile(entropies, settings.quantile) + settings.margin if entropies else np.inf)
    model.limits = np.array(limits)
    return model


def fit(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on at most ``settings.sample_rows`` tagged texts of each of at most ``settings.languages``, the lowest by a hash of the id; long ones by runs of words.
    Only that sample, bounded over all languages, reaches the driver.  Of documents that share an id, the first by language, then the shortest, counts."""
    s = settings
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    keys = rows.groupBy("id").agg(F.min(F.struct("lang", F.octet_length("text").alias("size"))).alias("x")).select("id", F.col("x.lang").alias("grp"), "x.size")
    chosen = [r.grp for r in keys.groupBy("grp").count().orderBy(F.desc("count"), "grp").limit(s.languages).collect()]
    each = min(s.language_bytes, s.model_bytes // max(1, len(chosen)) ** 2)
    got = training_sample(keys.where(F.col("grp").isin(chosen)), rows, s.sample_rows, s.sample_bytes, each, F.col("lang") == F.col("grp"))
    got = got.iloc[np.argsort([hash_of(i) for i in got["id"]])] if len(got) else got
    model = train([bytes(t) for t in got["text"]], got["lang"].tolist(), settings)
    del got
    give_back()
    return model


def hash_of(i) -> int:
    return int(mix(np.array([int(i)], np.int64).view(np.uint64))[0])


class Words:
    """Word sums by distinct word, remembered up to ``limit`` words."""

    def __init__(self, model: Model, limit: int = 150_000):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.known, self.sums = Numbered(), np.zeros((1024, len(self.model.languages) + 2), np.float32)

    def __call__(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, float, float]]:
        if len(self.known) > self.limit:
            self.clear()
        at = [numbers((t or b"").split(), self.known) for t in texts]
        if new := self.known.new:
            self.known.new = []
            while len(self.sums) < len(self.known):
                self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            first = len(self.known) - len(new)
            for k in range(0, len(new), BLOCK_WORDS):
                part = new[k : k + BLOCK_WORDS]
                self.sums[first + k : first + k + len(part)] = np.column_stack(self.model.letters(part))
        for a in at:
            got = self.sums[a].sum(0, dtype=np.float64)
            yield got[:-2], float(got[-2]), float(got[-1])


def predict_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    hold("langid")
    words = Words(model)
    for batch, texts in slices(batches):
        lang, score, entropy, rejected = zip(*[model.predict(*x) for x in words(texts)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())], names=[x.split()[0] for x in SCHEMA.split(", ")])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA.  The model's size is bounded by its sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda b: predict_batches(b, shared.value), SCHEMA)


def keep_batches(batches: Iterator[pa.RecordBatch], model: Model, text_col: str) -> Iterator[pa.RecordBatch]:
    hold("langid")
    words = Words(model)
    for batch, texts in slices(batches, text_col):
        yield batch.filter(pa.array([not model.predict(*x)[3] for x in words(texts)], pa.bool_()))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, in all their columns, that aren't rejected."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda b: keep_batches(b, shared.value, text_col), docs.schema)
