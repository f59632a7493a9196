"""Toxicity by multiple-instance learning.

Only documents carry labels, so a document is a bag of sentences: sentence s
with features gets p(s) = sigmoid(bias + weights of its words), and the document the
noisy-or 1 - (1 - leak) prod(1 - p(s)). A sentence without any gets zero, and the
leak counts once a document, so length alone is no evidence. Bias, leak and
weights are fitted on document labels through that product. A sentence's own
score then shows where the offence is.

Fitting takes a sample of at most ``SAMPLE`` labelled documents, those with the
lowest hash of their identifier, whatever the size of the corpus. Features are
words and their beginnings, which reach inflected forms that no labelled
document has; counts over the sample pick those tied to the label, at most
``FEATURES``. Scoring sees texts only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import unused

SAMPLE = 20_000
FEATURES = 4_096
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
BEGINNINGS = (4, 5, 6)  # letters
LEAST_DOCS = 5
LEAST_Z = 4.0
STEPS = 400
RATE = 0.1
DECAY = 1e-4
START_BIAS = -8.0
KNOWN_WORDS = 500_000  # words whose weight a task remembers

SENTENCE = re.compile(r"[^.!?\n]+")
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]
    leak: float = START_BIAS  # log odds of a document with words but no evidence


def features_of(word: str) -> list[str]:
    """The word and its beginnings; a beginning ends in an asterisk."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]


def held_out(doc_id: Column) -> Column:
    fold = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of at most SAMPLE labelled documents outside the held-out fold."""
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("_doc"), "_doc")
        .limit(SAMPLE)
    )
    texts = docs.select("doc_id", "text")
    # SAMPLE bounds what is broadcast.
    return texts.join(F.broadcast(marked), texts["doc_id"] == marked["_doc"]).select(
        "text", "label"
    )


def _counts(batches):
    seen: dict[str, list[int]] = {}

    def out():
        return pa.record_batch(
            [
                pa.array(list(seen), pa.string()),
                pa.array([c[0] for c in seen.values()], pa.int64()),
                pa.array([c[1] for c in seen.values()], pa.int64()),
            ],
            ["feature", "clean", "toxic"],
        )

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(LETTERS.findall((text or "").lower()))
            for feature in {f for w in words for f in features_of(w)}:
                seen.setdefault(feature, [0, 0])[1 if label else 0] += 1
            if len(seen) > KNOWN_WORDS:
                yield out()
                seen = {}
    yield out()


def tied_features(sample: DataFrame) -> list[str]:
    """Features that mark toxic documents, by the z-score of their log odds ratio."""
    totals = sample.agg(
        F.count_if(F.col("label") == 0).alias("clean"), F.count_if(F.col("label") != 0).alias("toxic")
    ).first()
    if not totals["toxic"] or not totals["clean"]:
        return []
    counts = (
        sample.mapInArrow(_counts, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
        .where(F.col("t") >= LEAST_DOCS)
    )
    c, t = F.col("c") + 0.5, F.col("t") + 0.5
    no_c, no_t = totals["clean"] - F.col("c") + 0.5, totals["toxic"] - F.col("t") + 0.5
    z = (F.log(t / no_t) - F.log(c / no_c)) / F.sqrt(1 / t + 1 / no_t + 1 / c + 1 / no_c)
    best = counts.withColumn("z", z).where(F.col("z") >= LEAST_Z)
    return [r["feature"] for r in best.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()]


def _bags(number: dict[str, int]):
    """Per document: its label, its number of sentences, and the features of those with any."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total, hits = 0, []
                for sentence in SENTENCE.findall((text or "").lower()):
                    words = set(LETTERS.findall(sentence))
                    total += bool(words)
                    found = [number[f] for w in words for f in features_of(w) if f in number]
                    if found:
                        hits.append(found)
                rows.append((int(bool(label)), total, hits))
            yield pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.list_(pa.int32()))),
                ],
                ["label", "sentences", "hits"],
            )

    return run


def _softplus(z):
    return np.logaddexp(0.0, z)


def fit_noisy_or(labels, sentences, hits, n_features: int) -> tuple[float, float, np.ndarray]:
    """Bias, leak and weights that maximise the likelihood of document labels."""
    y = np.asarray(labels, dtype=float)
    worded = np.asarray([n > 0 for n in sentences], dtype=float)
    doc_of = np.asarray([d for d, h in enumerate(hits) for _ in h], dtype=np.int64)
    flat = [s for h in hits for s in h]
    sentence_of = np.asarray([k for k, s in enumerate(flat) for _ in s], dtype=np.int64)
    feature = np.asarray([f for s in flat for f in s], dtype=np.int64)
    theta = np.zeros(n_features + 2)
    theta[-2:] = START_BIAS
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        bias, leak = theta[-2:]
        z = bias + np.bincount(sentence_of, theta[feature], minlength=len(flat))
        none = np.bincount(doc_of, _softplus(z), minlength=len(y)) + worded * _softplus(leak)
        # d loss / d none, where exp(-none) is the chance that no sentence offends
        pull = np.where(y > 0, -1.0 / np.expm1(np.maximum(none, 1e-9)), 1.0) / max(len(y), 1)
        at = pull[doc_of] / (1.0 + np.exp(-z))
        grad = DECAY * theta / max(1, n_features)
        grad[:-2] += np.bincount(feature, at[sentence_of], minlength=n_features)
        grad[-2] = at.sum()
        grad[-1] = (pull * worded).sum() / (1.0 + math.exp(-leak))
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        theta = theta - RATE * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-9
        )
    return float(theta[-2]), float(theta[-1]), theta[:-2]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents; without both kinds of label it scores near zero."""
    sample = training_sample(docs, labels)
    names = tied_features(sample)
    if not names:
        return Model(START_BIAS, {})
    bags = sample.mapInArrow(
        _bags({name: k for k, name in enumerate(names)}),
        "label int, sentences long, hits array<array<int>>",
    ).collect()
    bias, leak, weights = fit_noisy_or(
        [b["label"] for b in bags],
        [b["sentences"] for b in bags],
        [b["hits"] for b in bags],
        len(names),
    )
    return Model(bias, {n: float(w) for n, w in zip(names, weights)}, leak)


def _word_weights(model: Model):
    weights, known = model.weights, {}

    def weight(word: str) -> float | None:
        if word not in known:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            found = [weights[f] for f in features_of(word) if f in weights]
            known[word] = sum(found) if found else None
        return known[word]

    return weight


def score_sentences(text: str | None, weight, bias: float):
    """(start, end, score) of each sentence that has a word; zero without a feature."""
    for match in SENTENCE.finditer(text or ""):
        words = set(LETTERS.findall(match.group().lower()))
        if words:
            found = [v for v in map(weight, words) if v is not None]
            score = 0.0
            if found:
                score = 1.0 / (1.0 + math.exp(-max(min(bias + sum(found), 500.0), -500.0)))
            yield match.start(), match.end(), score


def _worst(text: str | None, weight, model: Model) -> tuple[float, int | None, int | None]:
    """The noisy-or of leak and sentences, and the place of the one that scores highest."""
    none, worst, place = 0.0, -1.0, (None, None)
    for start, end, score in score_sentences(text, weight, model.bias):
        if place[0] is None:
            none = float(_softplus(model.leak))
        none -= math.log1p(-min(score, 1.0 - 1e-15))
        if score > worst:
            worst, place = score, (start, end)
    return -math.expm1(-none), *place


SCORED = "score double, worst_start int, worst_end int"


def score_column(model: Model):
    """Column function: text -> struct of document score and place of the worst sentence."""

    @F.arrow_udf(SCORED)
    def scored(texts: pa.Array) -> pa.Array:
        weight = _word_weights(model)
        rows = [_worst(t, weight, model) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.float64()),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.int32()),
            ],
            ["score", "worst_start", "worst_end"],
        )

    return scored


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Every row's score: doc_id, held_out, score, predicted, worst_start, worst_end.

    Null and empty texts have no sentence and score 0 (the place is null then);
    texts are read whole. A null doc_id stays and is not held out. Repeated rows
    give repeated results, other columns are not read, an empty table gives none.
    """
    return (
        docs.select("doc_id", score_column(model)(F.col("text")).alias("s"))
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "s.*")
        .select(
            "doc_id",
            "held_out",
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
            "worst_start",
            "worst_end",
        )
    )


def offending_sentences(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end, sentence, score of each sentence that scores ``least`` or more."""

    def run(batches):
        weight = _word_weights(model)
        for batch in batches:
            rows = [
                (doc, start, end, text[start:end], score)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for start, end, score in score_sentences(text, weight, model.bias)
                if score >= least
            ]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch(columns, ["doc_id", "start", "end", "sentence", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start int, end int, sentence string, score double"
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns."""
    own = unused(docs, "_tox")
    scored = docs.withColumn(own, score_column(model)(F.col("text"))["score"])
    return scored.where(F.col(own) < THRESHOLD).drop(own)
