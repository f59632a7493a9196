"""Quality by hierarchical empirical Bayes.

A document's own evidence is a logistic regression on shares of its characters
and words. Where it was published is the other part: labelled documents are
counted per host and per path of a host, and the shares of good ones are shrunk,
a path's towards its host's and a host's towards the corpus's. How strongly is
learnt from the spread between hosts and between the paths of a host beyond what
chance would give. The posterior of a document adds the log odds of its path,
relative to the corpus, to those of its own evidence.

Counts and shares cover all labelled documents outside the held-out fold; only
the regression is fitted on a sample, of at most ``SAMPLE`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import kept, let
from marketbars.llm.toxicity import held_out

SAMPLE = 20_000
KEEP = 0.5
RIDGE = 1e-2
STEPS = 30
FEW_SITES = 100_000  # paths that may be broadcast, some 60 bytes each
STRENGTH = (1.0, 1e6)  # pseudo-counts of a prior lie between these


@dataclass(frozen=True)
class Evidence:
    """Standardised features and their weights; the bias comes last."""

    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]


def features(text: Column) -> Column:
    """Array of numbers that describe a text; all zero but the size for an empty one."""
    full = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(full), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(full, F.lit(pattern)) / chars

    def of_words(words: Column) -> Column:
        n = F.size(words)
        distinct = F.size(F.array_distinct(words)) / F.greatest(n, F.lit(1))
        size = F.log1p(n)
        return F.array(
            size,
            distinct,
            distinct * size,
            F.sqrt(share(r"[^\p{L}\p{N}\s.,]")),
            F.sqrt(share(r"\p{Lu}")),
            F.sqrt(share(r"\p{N}")),
            F.sqrt(share(r"\n")),
            F.least(F.length(full) / F.greatest(n, F.lit(1)), F.lit(40.0)),
        )

    words = F.filter(F.split(F.lower(full), r"\s+"), lambda w: w != F.lit(""))
    return let(words, of_words)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> Evidence:
    """Ridge-penalised logistic regression by Newton steps."""
    means, scales = x.mean(axis=0), x.std(axis=0)
    scales[scales < 1e-12] = 1.0
    design = np.column_stack([(x - means) / scales, np.ones(len(x))])
    weights = np.zeros(design.shape[1])
    penalty = RIDGE * len(x) * np.eye(len(weights))
    penalty[-1, -1] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (p - y) + penalty @ weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return Evidence(tuple(means), tuple(scales), tuple(weights))


def evidence(model: Evidence, values: Column) -> Column:
    """Log odds of the document's own features."""
    z = F.lit(float(model.weights[-1]))
    for k, (mean, scale) in enumerate(zip(model.means, model.scales)):
        z = z + (values[k] - float(mean)) * float(model.weights[k] / scale)
    return z


def _log_odds(p: Column) -> Column:
    safe = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(safe / (1 - safe))


def _strength(counts: DataFrame, prior: Column) -> float:
    """Pseudo-counts of the prior, from the spread of shares beyond chance."""
    n, good = F.col("n"), F.col("good")
    share = good / n
    sums = counts.agg(
        F.sum(n * (share - prior) ** 2).alias("spread"),
        F.sum(prior * (1 - prior)).alias("chance"),
        F.sum(n * prior * (1 - prior)).alias("inside"),
        F.sum(n).alias("n"),
    ).first()
    if not sums["n"] or not sums["inside"]:
        return STRENGTH[1]
    between = (sums["spread"] - sums["chance"]) / sums["n"]
    inside = sums["inside"] / sums["n"]
    if between <= inside / STRENGTH[1]:
        return STRENGTH[1]
    return float(np.clip(inside / between - 1.0, *STRENGTH))


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Hosts and paths with their shrunk shares of good documents, and the corpus's share.

    ``labelled`` has host, path and good (0 or 1). Null names are names.
    """
    paths = kept(
        labelled.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")
        )
    )
    hosts = kept(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((total["good"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)
    m = _strength(hosts, F.lit(overall))
    hosts = hosts.select(
        F.col("host").alias("_host"),
        ((F.col("good") + m * overall) / (F.col("n") + m)).alias("host_quality"),
    )
    placed = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    m = _strength(placed, F.col("host_quality"))
    paths = placed.select(
        F.col("host").alias("_path_host"),
        F.col("path").alias("_path"),
        ((F.col("good") + m * F.col("host_quality")) / (F.col("n") + m)).alias("path_quality"),
    )
    return hosts, paths, overall


def score(
    docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang"
) -> DataFrame:
    """Every row's posterior: doc_id, held_out, evidence, host_quality, path_quality, score, kept.

    Labels are learnt from rows outside the held-out fold. Null and empty texts
    have the features of no words; null hosts and paths are names of their own;
    a host without labels has the corpus's share, a path without its host's. A
    null doc_id has no label. Repeated rows give repeated results, other columns
    are not read, an empty table gives no rows. Without both kinds of label the
    evidence is the corpus's share for all. ``kept`` is a score of KEEP or more.
    """
    own = F.col("doc_id")
    rows = kept(
        docs.select(
            own,
            F.col(host_col).alias("host"),
            F.col(path_col).alias("path"),
            features(F.col("text")).alias("f"),
        )
    )
    marked = (
        labels.where(own.isNotNull() & F.col("quality").isNotNull() & ~held_out(own))
        .groupBy(own.alias("_doc"))
        .agg(F.max("quality").alias("good"))
    )
    labelled = kept(
        rows.join(marked, own == F.col("_doc")).select("_doc", "host", "path", "f", "good")
    )
    hosts, paths, overall = site_posteriors(labelled)
    sample = labelled.orderBy(F.xxhash64("_doc"), "_doc").limit(SAMPLE).select("f", "good").collect()
    y = np.array([r["good"] for r in sample], dtype=float)
    if len(set(y)) == 2:
        model = fit_logistic(np.array([r["f"] for r in sample], dtype=float), y)
    else:
        model = Evidence((), (), (float(np.log(overall / (1 - overall))),))
    n_paths = paths.count()

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_paths <= FEW_SITES else df

    placed = rows.join(
        near(hosts), F.col("host").eqNullSafe(F.col("_host")), "left"
    ).join(
        near(paths),
        F.col("host").eqNullSafe(F.col("_path_host")) & F.col("path").eqNullSafe(F.col("_path")),
        "left",
    )
    host_quality = F.coalesce("host_quality", F.lit(overall))
    path_quality = F.coalesce("path_quality", "host_quality", F.lit(overall))
    z = F.col("evidence") + _log_odds(F.col("path_q")) - _log_odds(F.lit(overall))
    return (
        placed.select(
            "doc_id",
            held_out(own).alias("held_out"),
            evidence(model, F.col("f")).alias("evidence"),
            host_quality.alias("host_q"),
            path_quality.alias("path_q"),
        )
        .withColumn("score", 1 / (1 + F.exp(-z)))
        .select(
            "doc_id",
            "held_out",
            "evidence",
            F.col("host_q").alias("host_quality"),
            F.col("path_q").alias("path_quality"),
            "score",
            (F.col("score") >= KEEP).alias("kept"),
        )
    )
