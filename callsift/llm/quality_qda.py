"""Quality scores from a regularised quadratic discriminant.

Each class is a Gaussian over transformed document statistics. Means and
covariances come from one grouped pass of sums and cross products over all training
rows, so nothing but two small matrices reaches the driver. Covariances are shrunk
towards the pooled diagonal; their Cholesky factors are inverted once and kept in
the model, and a score is a difference of Mahalanobis log densities, as plain Spark
expressions.

Documents without words or text get the score of their all-zero statistics.
Repeated rows weigh as often as they stand. With labels of one class only, or none,
every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.llm import doc_stats


def features(stats: str = "") -> dict[str, Column]:
    """Statistics on scales on which ordinary documents spread evenly."""
    share = doc_stats.shares(stats)
    at = f"{stats}." if stats else ""
    words = F.log1p(F.col(f"{at}n_words").cast("double"))
    return {
        "words": words,
        "word_length": F.log1p(share["word_length"]),
        "symbols": F.log1p(10 * share["symbols_per_word"]),
        "upper": F.sqrt(share["upper_share"]),
        "digits": F.sqrt(share["digit_share"]),
        "marks": F.sqrt(share["marks_per_word"]),
        "distinct": F.log1p(F.col(f"{at}n_distinct_words").cast("double")) / F.greatest(words, F.lit(1.0)),
        "echo": F.sqrt(share["echo_share"]),
        "repeat": F.sqrt(share["repeat_share"]),
        "dup_lines": F.sqrt(share["dup_line_share"]),
    }


@dataclass(frozen=True)
class Gaussian:
    """A class: mean, inverse Cholesky factor of its covariance, log prior and scale."""

    mean: np.ndarray
    whiten: np.ndarray
    offset: float

    def log_density(self, names: list[str]) -> Column:
        """Log of prior times density at the columns ``names``, up to a shared constant."""
        distance = F.lit(0.0)
        for k, row in enumerate(self.whiten):
            shift = float(row @ self.mean)
            part = F.lit(-shift)
            for j in range(k + 1):
                part = part + F.lit(float(row[j])) * F.col(names[j])
            distance = distance + part * part
        return F.lit(self.offset) - 0.5 * distance


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    low: Gaussian | None
    high: Gaussian | None
    share: float

    def score(self, df: DataFrame, to: str) -> DataFrame:
        """``df``, which holds the features by name, with the probability of label 1."""
        if self.low is None or self.high is None:
            return df.withColumn(to, F.lit(self.share))
        names = list(self.names)
        odds = self.high.log_density(names) - self.low.log_density(names)
        odds = F.least(F.greatest(odds, F.lit(-700.0)), F.lit(700.0))
        return df.withColumn(to, 1 / (1 + F.exp(-odds)))


def fit(df: DataFrame, names: list[str], label: str, shrinkage: float = 0.1, ridge: float = 1e-4) -> Model:
    """Learns from all rows whose label is 0 or 1 and whose features are not null."""
    rows = df.where(F.col(label).isin(0, 1)).na.drop(subset=names)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    sums = rows.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count("*").alias("n"),
        *[F.sum(name).alias(f"s{i}") for i, name in enumerate(names)],
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs],
    )
    found = {row["label"]: row for row in sums.collect()}  # two rows at most
    counts = {k: row["n"] for k, row in found.items()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    if len(found) < 2:
        return Model(tuple(names), None, None, share)
    means, spreads = {}, {}
    for k, row in found.items():
        mean = np.array([row[f"s{i}"] for i in range(len(names))]) / row["n"]
        second = np.zeros((len(names), len(names)))
        for i, j in pairs:
            second[i, j] = second[j, i] = row[f"p{i}_{j}"] / row["n"]
        means[k], spreads[k] = mean, second - np.outer(mean, mean)
    pooled = sum(np.diag(spreads[k]) * counts[k] for k in found) / total
    classes = {}
    for k in found:
        spread = (1 - shrinkage) * spreads[k] + shrinkage * np.diag(pooled) + ridge * np.eye(len(names))
        factor = np.linalg.cholesky(spread)
        offset = np.log(counts[k] / total) - np.log(np.diag(factor)).sum()
        classes[k] = Gaussian(means[k], np.linalg.inv(factor), float(offset))
    return Model(tuple(names), classes[0], classes[1], share)
