"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features of a whole text, each a rate per word or character: hits and weight of a word lexicon and of a stem lexicon (the strongest
stem too), hits near a word in the second person, capitals, words in capitals, punctuation, exclamation and question marks, digits or
signs inside words and stretched letters (obfuscation), and the logarithm of the length. Nothing else is an input: no label, lang,
source or id.

Learning uses labelled rows with ``crc32(doc_id as text) % 4 <> 2`` alone, at most ``SAMPLE`` of them, those with the smallest hashes of
their ids; every other step covers all rows. They make three folds by the same remainder (0, 1, 3). A lexicon is learned from the
numbers of toxic and other documents that have a word or stem (its first four letters, signs that stand for letters undone); the
features of a fold come from the lexicons of the other folds, so that the trees see weights as they are for unseen texts. The
trees' predictions of each fold, by trees of the other folds, calibrate the scores.

The lexicons (at most ``ENTRIES`` entries each), trees and steps are small and of a fixed size; they go to the tasks with the job.

Defined results: null and empty texts have features of 0 and a score like any other; without labels of both kinds the score is
the share of toxic labels, or 0; labels that are null count for nothing, of several labels for a doc_id the largest counts; a null
doc_id is never held out nor learned from; repeated rows are scored alike. Only the columns named are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import freed, small_batches
from tapelake.plans.staging import stage

SAMPLE = 20_000
ENTRIES = 5_000
THRESHOLD = 0.3
FOLDS = (0, 1, 3)
HELD_OUT = 2
NEAR = 3
STEM = 4
VOCABULARY = 60_000  # words whose properties a worker remembers
COUNTED = 100_000  # words and stems it counts at a time

# Words in the second person (English, German, French, Spanish).
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros".split())
# Insults that are known without learning.
INSULTS = frozenset(
    "idiot idiots moron morons loser losers stupid dumb pathetic scum trash garbage worthless disgusting clown fool imbecile "
    "idiota estúpido imbécil basura dumm dummkopf abschaum idiotin crétin stupide ordure minable débile".split()
)
# Signs that stand for letters.
LETTERS = str.maketrans("013457@$!", "oieastasi")


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def plain(word: str) -> str:
    """A word in lower case without outer punctuation, signs inside it undone."""
    word = word.strip(".,;:!?\"'()[]{}<>-_*|").lower()
    inner = word.translate(LETTERS) if not word.isdigit() else word
    return re.sub(r"[^\w]", "", inner)


_OUTER = ".,;:!?\"'()[]{}<>-_*|"
_THRICE = re.compile(r"(.)\1\1")
# What is known of a word: hit and weight in the word lexicon, the same for stems, whether it is in the second person, its length,
# capitals, whether it is all capitals, punctuation, exclamation and question marks, signs inside, stretched letters.
N_PROPERTIES = 12


def properties(word: str, words: dict[str, float], stems: dict[str, float]) -> tuple:
    core = word.strip(_OUTER)
    if core.isalpha():  # most words
        bare, letters, punctuation, inside = core.lower(), len(core), len(word) - len(core), 0
    else:
        bare, letters = plain(word), sum(map(str.isalpha, word))
        punctuation, inside = len(word) - sum(map(str.isalnum, word)), int(letters > 0)
    capitals = 0 if word.islower() else sum(map(str.isupper, word))
    marks = word.count("!") + word.count("?") if punctuation else 0
    weight, stem = words.get(bare, 0.0), stems.get(bare[:STEM], 0.0) if len(bare) > STEM else 0.0
    return (
        weight > 0,
        weight,
        stem > 0,
        stem,
        bare in SECOND_PERSON,
        len(word),
        capitals,
        letters > 1 and capitals == letters,
        punctuation,
        marks,
        inside,
        _THRICE.search(word) is not None,
    )


N_FEATURES = 14


class Featurizer:
    """Feature rows of texts under one pair of lexicons; remembers the properties of words."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], remembered: int = VOCABULARY) -> None:
        self.words, self.stems, self.remembered = words, stems, remembered
        self.numbers: dict[bytes, int] = {}
        self.table = np.empty((1024, N_PROPERTIES))

    def learn(self, words: set[bytes]) -> None:
        """Find the properties of words that aren't known."""
        if len(self.numbers) > self.remembered:
            self.numbers.clear()
        numbers, first = self.numbers, len(self.numbers)
        found = []
        for word in words - numbers.keys():
            numbers[word] = len(numbers)
            found.append(properties(word.decode("utf-8", "replace"), self.words, self.stems))
        if len(numbers) > len(self.table):
            self.table = np.concatenate([self.table[:first], np.empty((2 * len(numbers) - first, N_PROPERTIES))])
        if found:
            self.table[first : len(numbers)] = found

    def rows(self, texts: list[bytes | None]) -> np.ndarray:
        """Feature rows of a batch of texts."""
        split = [text.split() if text else [] for text in texts]
        self.learn(set().union(*split))
        return np.stack([self.row(words) for words in split]) if split else np.zeros((0, N_FEATURES))

    def row(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(N_FEATURES)
        known = self.numbers
        rows = self.table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
        sums = rows.sum(axis=0)
        n, chars = len(words), max(sums[5], 1.0)
        hits = np.flatnonzero(rows[:, 0] + rows[:, 2])
        second = np.flatnonzero(rows[:, 4])
        near = 0
        if len(hits) and len(second):
            at = np.searchsorted(second, hits)
            after = second[np.minimum(at, len(second) - 1)] - hits
            before = hits - second[np.maximum(at - 1, 0)]
            near = int((((after >= 0) & (after <= NEAR)) | ((before >= 0) & (before <= NEAR))).sum())
        return np.array(
            [
                sums[0] / n,
                sums[1] / n,
                sums[2] / n,
                sums[3] / n,
                rows[:, 1].max(),
                rows[:, 3].max(),
                near / n,
                sums[6] / chars,
                sums[7] / n,
                sums[8] / chars,
                sums[9] / n,
                sums[10] / n,
                sums[11] / n,
                np.log1p(n),
            ]
        )


# ---- trees --------------------------------------------------------------------------------------------------------------
class Trees(NamedTuple):
    """Boosted trees of a fixed depth, as arrays (tree, node): the children of node k are 2k + 1 and 2k + 2."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray


def predict(trees: Trees, rows: np.ndarray) -> np.ndarray:
    """Log-odds."""
    out = np.full(len(rows), trees.base)
    every = np.arange(len(rows))
    for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
        node = np.zeros(len(rows), np.int64)
        while True:
            inner = node < len(feature)
            if not inner.any():
                break
            node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
        out += leaf[node - len(feature)]
    return out


def boost(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, least: float = 1.0) -> Trees:
    """Fit trees to the logistic loss by Newton steps over histograms of the features."""
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(c, rows[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    inner, score = 2**depth - 1, np.full(len(rows), base)
    features, values, leaves = [], [], []
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-score))
        gradient, hessian = labels - chance, chance * (1 - chance)
        feature, value = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first = 2**level - 1
            place = node - first
            size = 2**level
            best = np.full(size, 1e-9)
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                slot = place * (bins + 1) + binned[:, k]
                g = np.bincount(slot, gradient, size * (bins + 1)).reshape(size, -1)
                h = np.bincount(slot, hessian, size * (bins + 1)).reshape(size, -1)
                left_g, left_h = np.cumsum(g, axis=1)[:, : len(c)], np.cumsum(h, axis=1)[:, : len(c)]
                all_g, all_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
                gain = left_g**2 / (left_h + least) + (all_g - left_g) ** 2 / (all_h - left_h + least) - all_g**2 / (all_h + least)
                at = gain.argmax(axis=1)
                gain = gain[np.arange(size), at]
                better = gain > best
                best = np.where(better, gain, best)
                feature[first : first + size] = np.where(better, k, feature[first : first + size])
                value[first : first + size] = np.where(better, c[at], value[first : first + size])
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > value[node])
        leaf_of = node - inner
        g = np.bincount(leaf_of, gradient, inner + 1)
        h = np.bincount(leaf_of, hessian, inner + 1)
        leaf = rate * g / (h + least)
        score = score + leaf[leaf_of]
        features.append(feature)
        values.append(value)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(values), np.array(leaves))


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (score, share of label 1) of the best rising step function, by pooling adjacent violators."""
    values, inverse = np.unique(scores, return_inverse=True)
    weights = np.bincount(inverse).astype(float)
    means = np.bincount(inverse, labels) / weights
    pools: list[list[float]] = []  # mean, weight, first, last
    for k, (mean, weight) in enumerate(zip(means, weights, strict=True)):
        pools.append([mean, weight, k, k])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            mean_b, weight_b, _, last = pools.pop()
            mean_a, weight_a, first, _ = pools.pop()
            pools.append([(mean_a * weight_a + mean_b * weight_b) / (weight_a + weight_b), weight_a + weight_b, first, last])
    x = [values[int(p[j])] for p in pools for j in (2, 3)]
    y = [p[0] for p in pools for _ in (2, 3)]
    return np.array(x), np.array(y)


# ---- learning -----------------------------------------------------------------------------------------------------------
class Model(NamedTuple):
    words: dict[str, float]
    stems: dict[str, float]
    trees: Trees | None
    x: np.ndarray
    y: np.ndarray
    share: float


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, entry, fold, toxic, documents) of the words and stems of a task's texts."""
    counts: dict[tuple, list[int]] = {}

    def rows() -> pa.RecordBatch:
        kind, entry, fold = zip(*counts, strict=True)
        toxic, all_ = zip(*counts.values(), strict=True)
        return pa.record_batch({"kind": pa.array(kind), "entry": pa.array(entry), "fold": pa.array(fold, pa.int64()), "toxic": pa.array(toxic, pa.int64()), "n": pa.array(all_, pa.int64())})

    for batch in small_batches(batches, "text"):
        for fold, label, text in zip(*(batch.column(c).to_pylist() for c in ("fold", "label", "text")), strict=True):
            bare = {plain(word) for word in set((text or "").split())} - {""}
            for entry in [("word", w) for w in bare] + [("stem", s) for s in {w[:STEM] for w in bare if len(w) > STEM}]:
                count = counts.setdefault((*entry, fold), [0, 0])
                count[0] += label
                count[1] += 1
        if len(counts) > COUNTED:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def lexicons(rows: list, toxic: dict[int, int], total: dict[int, int], folds: tuple[int, ...]) -> tuple[dict, dict]:
    """Weights of the words and stems that mark toxic documents of the given folds, the strongest ``ENTRIES`` of each kind."""
    n_toxic = sum(toxic.get(f, 0) for f in folds)
    n_other = sum(total.get(f, 0) for f in folds) - n_toxic
    counted: dict[tuple[str, str], list[int]] = {}
    for kind, entry, fold, bad, n in rows:
        if fold in folds:
            count = counted.setdefault((kind, entry), [0, 0])
            count[0] += bad
            count[1] += n - bad
    found: dict[str, dict[str, float]] = {"word": dict.fromkeys(INSULTS, 3.0), "stem": {}}
    weights = []
    for (kind, entry), (bad, other) in counted.items():
        weight = float(np.log((bad + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1)))
        if bad >= 3 and weight > 2:
            weights.append((-weight, kind, entry))
    for weight, kind, entry in sorted(weights):
        if len(found[kind]) < ENTRIES:
            found[kind][entry] = -weight
    return found["word"], found["stem"]


def _features(models: dict[int, tuple[dict, dict]]):
    """Rows (doc_id, fold, label, text) -> (fold, label, own features under the fold's lexicons)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {fold: Featurizer(*model, VOCABULARY // len(models)) for fold, model in models.items()}
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            out = [made[fold].rows([text])[0].tolist() for fold, text in zip(batch.column("fold").to_pylist(), texts, strict=True)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fold": batch.column("fold"), "label": batch.column("label"), "row": pa.array(out, pa.list_(pa.float64()))})

    return rows


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit the lexicons, trees and calibration."""
    fold = remainder(F.col("doc_id"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.withColumn("fold", fold).where(F.col("fold") != HELD_OUT).groupBy("doc_id", "fold").agg(F.max(F.col("toxic").cast("long")).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded, so it may be broadcast
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Of several texts with one doc_id the one with the smallest hash is learned from, so reruns agree.
    one = F.min(F.struct(F.xxhash64("text"), "text")).alias("one")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "fold", "label").agg(one)
    rows = stage(rows.select("doc_id", "fold", "label", F.col("one.text").alias("text")), "labelled")
    sums = rows.groupBy("fold").agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).collect()
    toxic, total = {r.fold: r.toxic for r in sums}, {r.fold: r.n for r in sums}
    n_toxic, n = sum(toxic.values()), sum(total.values())
    nothing = np.zeros(0)
    if n_toxic in (0, n):
        return Model(dict.fromkeys(INSULTS, 3.0), {}, None, nothing, nothing, n_toxic / max(n, 1))
    words = rows.mapInArrow(freed(_vocabulary), "kind string, entry string, fold long, toxic long, n long")
    counted = words.groupBy("kind", "entry", "fold").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    # Only entries that could get a weight above 2 in some union of folds: at most the strongest few thousand reach the driver.
    marked = counted.groupBy("kind", "entry").agg(F.sum("toxic").alias("bad"), F.sum("n").alias("all"), F.collect_list(F.struct("fold", "toxic", "n")).alias("folds"))
    odds = (F.col("bad") + 0.5) / (F.col("all") - F.col("bad") + 0.5)
    marked = marked.where((F.col("bad") >= 3) & (odds > (n_toxic + 1) / (n - n_toxic + 1) * 4)).orderBy(odds.desc(), "kind", "entry").limit(4 * ENTRIES)
    entries = [(r.kind, r.entry, f.fold, f.toxic, f.n) for r in marked.collect() for f in r.folds]
    parts = {one: tuple(f for f in FOLDS if f != one) for one in FOLDS}
    models = {one: lexicons(entries, toxic, total, others) for one, others in parts.items()}
    made = rows.mapInArrow(freed(_features(models)), "doc_id long, fold long, label long, row array<double>").orderBy("doc_id").collect()
    folds, marks, matrix = np.array([r.fold for r in made]), np.array([float(r.label) for r in made]), np.array([r.row for r in made])
    unseen = np.zeros(len(made))
    for one in FOLDS:
        mine = folds == one
        unseen[mine] = predict(boost(matrix[~mine], marks[~mine]), matrix[mine]) if mine.any() and not mine.all() else 0.0
    x, y = isotonic(unseen, marks)
    return Model(*lexicons(entries, toxic, total, FOLDS), boost(matrix, marks), x, y, n_toxic / n)


def scores(model: Model, rows: np.ndarray) -> np.ndarray:
    """Calibrated scores; a small share of the trees' own chance tells apart what the steps make equal."""
    if model.trees is None:
        return np.full(len(rows), model.share)
    odds = predict(model.trees, rows)
    return 0.98 * np.interp(odds, model.x, model.y) + 0.02 / (1 + np.exp(-odds))


def _scored(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer(model.words, model.stems)
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores(model, make.rows(texts)))})

    return rows


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document (doc_id, text): doc_id, held_out, score, predicted."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(freed(_scored(model)), "doc_id long, score double")
    held = F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _accepted(model: Model, threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Featurizer(model.words, model.stems)
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield batch.filter(pa.array(scores(model, make.rows(texts)) < threshold))

    return rows


def accepted(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, all columns as they are."""
    return documents.mapInArrow(freed(_accepted(model, threshold)), documents.schema)
