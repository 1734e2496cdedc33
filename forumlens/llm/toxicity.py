"""Toxicity scores by a classifier with counterfactual regularisation.

Features of a text are its distinct words and the prefixes of ``PREFIXES`` characters of them (word families of
inflected languages).  Every labelled training row takes part in choosing features: documents per feature and label are
counted in hashed buckets, and the ``FEATURES`` buckets with the largest standardised difference are kept.
A logistic model is then fitted on at most ``SAMPLE`` training rows, the ones with the least hash of doc_id (of rows with
one doc_id the one with the least hash of the text), of which only the kept features are gathered: at most
SAMPLE x FEATURES small numbers, and far fewer in practice.

For each of these rows the identity terms are swapped for their counterparts, and the loss has, beside log loss and
a ridge, ``COUNTERFACTUAL`` times the squared change of the score's logit: naming a group neither raises nor
lowers a score.

Scores need only the text; labels, language, source and id are never inputs.

Defined results: null or empty text is scored by the intercept; labels are joined by doc_id, any above 0 is 1 and others 0, several
labels of one id count as the highest, null labels not at all; without a label 1 and a label 0 in training there is nothing to learn: all scores are 0.25.
Repeated rows get equal scores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.text import words_of
from forumlens.session import freeze

FOLDS = 5
PREFIXES = (3, 4, 5, 6)
BUCKETS = 1 << 20
FEATURES = 2048
SAMPLE = 20_000
RIDGE = 1.0
COUNTERFACTUAL = 4.0
ROUNDS = 300

# Identity terms and what each is swapped for.
IDENTITY_PAIRS = [
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("black", "white"), ("gay", "straight"),
    ("lesbian", "heterosexual"), ("muslim", "christian"), ("muslims", "christians"), ("jewish", "catholic"), ("jews", "catholics"),
    ("immigrants", "citizens"), ("immigrant", "citizen"), ("disabled", "healthy"), ("old", "young"), ("asian", "european"),
    ("african", "american"), ("transgender", "cisgender"), ("femmes", "hommes"), ("femme", "homme"), ("frauen", "männer"),
    ("frau", "mann"), ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmans", "chrétiens"), ("muslime", "christen"),
    ("musulmanes", "cristianos"),
]


def swaps(pairs=IDENTITY_PAIRS) -> dict[bytes, bytes]:
    return {x.encode(): y.encode() for a, b in pairs for x, y in ((a, b), (b, a))}


def _bucket(name: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name, digest_size=4).digest(), "big") % BUCKETS


class Features:
    """Buckets of a word and its prefixes, remembered up to a bound."""

    def __init__(self, kept: dict[int, int] | None = None):
        self.kept, self.known = kept, {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            chars = word.decode(errors="replace")
            names = {b"w:" + word, *(b"p:" + chars[:n].encode() for n in PREFIXES if len(chars) >= n)}
            found = tuple(sorted({_bucket(n) for n in names}))
            if self.kept is not None:
                found = tuple(self.kept[b] for b in found if b in self.kept)
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[word] = found
        return found

    def of(self, words: set[bytes]) -> set[int]:
        return {f for fs in map(self.of_word, words) if fs for f in fs}


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` outside the held-out fold that have a label, with ``label``.

    Labels grow with the documents, so they are merged at every size and never broadcast.
    """
    known = labels.filter(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    return docs.filter(fold(F.col("doc_id")) != 0).join(known.hint("merge"), F.col("doc_id") == F.col("_id")).drop("_id")


def sample_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The SAMPLE labelled training ids with the least hash: at (the hash), label."""
    rows = training_rows(docs.select("doc_id"), labels)
    return rows.select(F.xxhash64("doc_id").alias("at"), "label").distinct().orderBy("at").limit(SAMPLE)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bucket and label of a task; one row a bucket that occurs, however many rows it saw."""
    features, counts, docs = Features(), np.zeros((2, BUCKETS), dtype=np.int64), [0, 0]
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[label][list(features.of(set(words_of(text))))] += 1
            docs[label] += 1
    hit = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(hit, -1)), pa.array(np.append(counts[0][hit], docs[0])), pa.array(np.append(counts[1][hit], docs[1]))],
        names=["bucket", "clean", "toxic"])


@dataclass
class Model:
    kept: dict[int, int]
    weights: np.ndarray
    intercept: float

    def score(self, features: set[int]) -> float:
        z = self.intercept + float(self.weights[list(features)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit(rows: list[tuple[int, list[int], list[int]]], n: int, counterfactual: float = COUNTERFACTUAL, ridge: float = RIDGE,
        rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept from (label, features, features with identity terms swapped); accelerated gradient steps."""
    y = np.array([r[0] for r in rows], dtype=np.float64)
    at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    col = np.array([f for r in rows for f in r[1]], dtype=np.int64)
    # Change of each row's features under the swap, as signed entries.
    moved = [(i, f, s) for i, r in enumerate(rows) for s, fs in ((1.0, set(r[1]) - set(r[2])), (-1.0, set(r[2]) - set(r[1]))) for f in fs]
    d_at = np.array([m[0] for m in moved], dtype=np.int64)
    d_col = np.array([m[1] for m in moved], dtype=np.int64)
    d_sign = np.array([m[2] for m in moved], dtype=np.float64)
    times = lambda w: np.bincount(at, w[col], len(rows))
    change = lambda w: np.bincount(d_at, d_sign * w[d_col], len(rows))
    sizes = np.bincount(at, minlength=len(rows)).astype(float)
    # Step per coordinate from a bound on its curvature, so rare and frequent features move alike.
    curve = np.bincount(col, sizes[at] + 1, n) / 4 + ridge
    if len(moved):
        curve += 2 * counterfactual * np.bincount(d_col, np.bincount(d_at, minlength=len(rows))[d_at], n)
    curve0 = (sizes + 1).sum() / 4 + 1e-9
    w, b = np.zeros(n), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    v, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(vb + times(v), -500, 500)))
        grad = np.bincount(col, (p - y)[at], n) + ridge * v
        if len(moved):
            grad += 2 * counterfactual * np.bincount(d_col, d_sign * change(v)[d_at], n)
        w2, b2 = v - grad / curve, vb - (p - y).sum() / curve0
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def train(docs: DataFrame, labels: DataFrame, pairs=IDENTITY_PAIRS) -> Model:
    whole = F.coalesce("text", F.lit("")).alias("text")
    sums = training_rows(docs.select("doc_id", whole), labels).select("text", "label").mapInArrow(_count, "bucket long, clean long, toxic long")
    # Read twice below: at most BUCKETS small rows, written so that the texts are counted once.
    sums = freeze(sums.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "counts")
    total = sums.filter("bucket = -1").first()
    n0, n1 = (total["clean"], total["toxic"]) if total else (0, 0)
    if not n0 or not n1:
        return Model({}, np.zeros(0), -float(np.log(3)))
    share = (F.col("clean") + F.col("toxic") + 1) / (n0 + n1 + 2)
    spread = F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    gain = F.abs(F.col("toxic") / n1 - F.col("clean") / n0) / spread
    best = sums.filter("bucket >= 0 and clean + toxic >= 3").orderBy(gain.desc(), "bucket").limit(FEATURES).select("bucket").collect()
    swap = swaps(pairs)
    own = sorted({b for w in swap for b in Features().of_word(w)})
    kept = {b: i for i, b in enumerate(dict.fromkeys([*[r[0] for r in best], *own]))}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(kept)
        for batch in batches:
            one, two = [], []
            for text in batch.column(3).to_pylist():
                words = set(words_of(text))
                one.append(sorted(features.of(words)))
                two.append(sorted(features.of({swap.get(w, w) for w in words})) if not words.isdisjoint(swap) else one[-1])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(one, kind), pa.array(two, kind)],
                names=["at", "th", "label", "one", "two"])

    # The sample is named by ids first, at most SAMPLE rows of two numbers, so its texts are met without a shuffle.
    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.xxhash64("doc_id").alias("at"), F.xxhash64("text").alias("th"), whole)
    met = rows.join(F.broadcast(sample_ids(docs, labels)), "at").select("at", "th", "label", "text")
    cut = met.mapInArrow(gather, "at long, th long, label int, one array<int>, two array<int>")
    sample = cut.groupBy("at").agg(F.min(F.struct("th", "label", "one", "two")).alias("r")).select("at", "r.*").collect()
    sample.sort(key=lambda r: r["at"])
    weights, intercept = fit([(r["label"], r["one"], r["two"]) for r in sample], len(kept))
    return Model(kept, weights, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and th (hash of the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        features = Features(model.kept)
        for batch in batches:
            found = [model.score(features.of(set(words_of(t)))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["doc_id", "th", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, score double")
    return scored.select("doc_id", "th", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier does not call toxic; the text decides, so equal texts share their fate."""
    model = train(docs.select("doc_id", "text"), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        features = Features(model.kept)
        for batch in batches:
            fine = [model.score(features.of(set(words_of(t)))) < 0.5 for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
