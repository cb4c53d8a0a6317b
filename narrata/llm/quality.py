"""Document quality by a regularised quadratic discriminant.

Each document becomes a fixed vector of transformed statistics of its whole text (lengths, shares of character kinds, word
and line variety). Per class the labelled vectors give a mean and a covariance, the latter shrunk towards the pooled one and
its diagonal. The score is the posterior of class 1: a logistic of the difference of the two log densities, each a
Mahalanobis distance through a Cholesky factor that is inverted once and shared.

Sums of the labelled rows are made on the executors, so the fit takes every labelled row that may be learned from; the
driver receives one row per class and matrix cell. Labels, language, source and id never enter a score.

Null text counts as empty; an empty text has its own finite vector. A null label is skipped; a document with several
labels counts once for each different one. With a single class present the score is 1 or 0 throughout, with none 0.5.
Repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import cut, held_out, may_learn, table

SHRINK_POOLED = 0.1
SHRINK_DIAGONAL = 0.05
RIDGE = 1e-2
THRESHOLD = 0.7
CLIP = 8.0
#: Words of ordinary prose that every text is taken to have besides its own, so that short texts are not outliers.
PRIOR = 12

_KIND = np.full(256, 7)
for _name, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 11, 12, 13, 32), (10,), b".,;:?'\"-()", b"!")):
    _KIND[list(_bytes)] = _name
_KIND[ord("|")] = 8
_KIND[128:] = 9
_KIND[:9] = 10
_KIND[14:32] = 10
_KIND[127] = 10
FEATURES = 11


def statistics(text: str) -> np.ndarray:
    """The transformed statistics of one text, whole."""
    data = text.encode("utf-8", "replace")
    histogram = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    upper, lower, digit, _, feed, point, bang, symbol, pipe, high, control = np.bincount(_KIND, weights=histogram, minlength=11)
    words = data.split()
    k, letters = len(words) + PRIOR, upper + lower + high
    n = letters + 5 * PRIOR
    repeated = len(words) - len(set(words))
    return np.array(
        [
            np.sqrt((upper + 0.15 * PRIOR) / (upper + lower + 5 * PRIOR)), np.sqrt(digit / n), np.log1p(10 * bang / k), np.log1p(10 * pipe / k), np.log1p(10 * symbol / k),
            np.log1p(10 * point / k), np.log1p(100 * feed / k), np.log1p(100 * control / n), np.log((letters + 5 * PRIOR) / k), np.sqrt(repeated / k),
            np.log1p(10 * sum(map(eq, words, words[1:])) / k),
        ]
    )


def _vector(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t or "") for t in texts], dtype=object)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each class the sums of (1, x) outer (1, x), as cells."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for label, part in batch.groupby("quality"):
            x = np.column_stack([np.ones(len(part)), np.stack(part["x"].to_numpy())])
            total[label] = total.get(label, 0) + x.T @ x
    for label, m in total.items():
        yield pd.DataFrame({"quality": label, "cell": np.arange(m.size), "v": m.ravel()})


class Discriminant:
    """Means, inverted Cholesky factors and constants of both classes."""

    def __init__(self, sums: dict[int, np.ndarray], pooled: float = SHRINK_POOLED, diagonal: float = SHRINK_DIAGONAL, ridge: float = RIDGE):
        own = {k: (m[0, 0], m[0, 1:] / m[0, 0], m[1:, 1:] / m[0, 0]) for k, m in sums.items()}
        n = sum(c for c, _, _ in own.values())
        centre = sum(c * mean for c, mean, _ in own.values()) / n
        spread = np.sqrt(np.maximum(sum(c * np.diag(second) for c, _, second in own.values()) / n - centre**2, 1e-8))
        self.centre, self.spread, self.parts = centre, spread, {}
        covs = {k: (second - np.outer(mean, mean)) / np.outer(spread, spread) for k, (_, mean, second) in own.items()}
        common = sum(own[k][0] * covs[k] for k in own) / n
        for k, (c, mean, _) in own.items():
            cov = (1 - pooled - diagonal) * covs[k] + pooled * common + diagonal * np.diag(np.diag(covs[k])) + ridge * np.eye(len(mean))
            factor = np.linalg.cholesky(cov)
            self.parts[k] = ((mean - centre) / spread, np.linalg.inv(factor), np.log(c / n) - np.log(np.diag(factor)).sum())

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(self.parts) == 1:
            return np.full(len(x), float(next(iter(self.parts))))
        z = np.clip((x - self.centre) / self.spread, -CLIP, CLIP)
        density = {k: const - 0.5 * np.square((z - mean) @ inverse.T).sum(axis=1) for k, (mean, inverse, const) in self.parts.items()}
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(_vector, "array<double>")(F.col(text_col).cast("string")).alias("x"))


def fit(vectors: DataFrame, labels: DataFrame) -> Discriminant | None:
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    rows = vectors.where(may_learn(F.col("doc_id"))).join(known, "doc_id").select("quality", "x")
    cells = rows.mapInPandas(_sums, "quality int, cell int, v double").groupBy("quality", "cell").agg(F.sum("v").alias("v")).toPandas()
    sums = {int(k): part.sort_values("cell")["v"].to_numpy().reshape(FEATURES + 1, -1) for k, part in cells.groupby("quality")}
    return Discriminant(sums) if sums else None


def score(vectors: DataFrame, model: Discriminant | None) -> DataFrame:
    """``vectors`` with score."""
    if model is None:
        return vectors.withColumn("score", F.lit(0.5))
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def density(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return vectors.withColumn("score", density("x"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut(vectors(table(spark, sf_dir, "documents")))
    scored = score(found, fit(found, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
