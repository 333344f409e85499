"""Regularised quadratic discriminant over statistics of a text.

Two Gaussian classes over transformed statistics; each covariance is shrunk
towards the pooled one and towards a multiple of the identity. The model is
fitted from sums over all labelled rows, so nothing but a few matrices reaches
the driver. Scoring solves one triangular system per class with the cached
Cholesky factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored
from tidemark.llm.tokens import words_of

UPPER, LOWER = slice(65, 91), slice(97, 123)
DIGITS = slice(48, 58)
SYMBOLS = [ord(c) for c in "#*$%&|<>@^~=+_{}[]\\/"]
FEATURES = 13


def statistics(text: str | None) -> list[float]:
    """The transformed statistics; an empty text has those of no words."""
    text = text or ""
    raw = text.encode()
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = words_of(text)
    lines = [line for line in raw.split(b"\n") if line]
    n = len(words)
    letters = int(byte[UPPER].sum() + byte[LOWER].sum() + byte[128:].sum() // 2)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))

    def share(count: int, of: int) -> float:
        return float(np.log((count + 0.5) / (of + 1)))

    return [
        float(np.log1p(n)),
        float(np.log((letters + 1) / (n + 1))),
        share(int(byte[UPPER].sum()), letters),
        share(int(byte[DIGITS].sum()), n),
        share(int(byte[SYMBOLS].sum()), n),
        share(int(byte[ord("!")]), n),
        share(int(byte[ord("|")]), n),
        share(int(byte[ord(".")] + byte[ord(",")]), n),
        share(sum(map(eq, words, words[1:])), n),
        float(np.log1p(distinct) / np.log(n + 2)),
        share(max(n - 1, 0) - pairs, n),
        share(len(lines) - len(set(lines)), len(lines)),
        share(len(lines), n),
    ]


def matrix(texts: pd.Series) -> np.ndarray:
    rows = np.empty((len(texts), FEATURES))
    for at, text in enumerate(texts):
        rows[at] = statistics(None if text is None else str(text))
    return rows


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): mean, lower Cholesky factor and the constant of its log density."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher where class 1 is likelier; 0.5 where both are alike.

        The log-density difference is divided by the number of statistics
        before it is squashed, so that clear cases still differ.
        """
        density = [
            c - 0.5 * sum(z * z for z in solved(low, (x - m).T))
            for m, low, c in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip((density[0] - density[1]) / x.shape[1], -500, 500)))


def solved(low: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """The rows of z with low @ z = right; a column's last digits hang on no other column."""
    z: list[np.ndarray] = []
    for row, own in zip(low, right, strict=True):
        for factor, known in zip(row, z, strict=False):
            own = own - factor * known
        z.append(own / row[len(z)])
    return z


def fit(
    docs: DataFrame, labels: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.01
) -> Discriminant | None:
    """The model from all documents with a label (``doc_id``, ``quality``).

    Null ids and null labels teach nothing, a repeated row counts each time.
    None if a class has no row. Sums of doubles hang on their order, so rows are dealt by id
    and sorted, and the sums of tasks are added in an order of theirs: files do not matter.
    """
    shape = "label int, n long, total array<double>, squares array<double>"

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + FEATURES + FEATURES**2))
        for batch in batches:
            x = np.stack(batch["x"].to_list()) if len(batch) else np.empty((0, FEATURES))
            for k in (0, 1):
                own = x[batch["quality"].to_numpy() == k]
                total[k, 0] += len(own)
                total[k, 1 : 1 + FEATURES] += own.sum(axis=0)
                total[k, 1 + FEATURES :] += (own.T @ own).ravel()
        yield packed_sums(total)

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = sorted(zip(*(map(tuple, group[c]) for c in ("total", "squares")), strict=True))
        total, squares = zip(*parts, strict=True)
        return pd.DataFrame(
            {
                "label": [key[0]],
                "n": [group["n"].sum()],
                "total": [np.sum(total, axis=0)],
                "squares": [np.sum(squares, axis=0)],
            }
        )

    def packed_sums(total: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "label": [0, 1],
                "n": total[:, 0].astype(np.int64),
                "total": list(total[:, 1 : 1 + FEATURES]),
                "squares": list(total[:, 1 + FEATURES :]),
            }
        )

    @F.pandas_udf("array<double>")
    def measured(text: pd.Series) -> pd.Series:
        return pd.Series(list(matrix(text)))

    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    # Written, since two Python steps in a task would take two workers, which then stay.
    measurements = stored(
        docs.where("doc_id is not null").select("doc_id", measured("text").alias("x")),
        "measurements",
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        measurements.join(known, "doc_id")
        .repartition(parts, "doc_id")
        .sortWithinPartitions("doc_id", "quality", "x")
        .select("quality", "x")
        .mapInPandas(sums, shape)
        .groupBy("label")
        .applyInPandas(add, shape)
        .orderBy("label")
        .collect()
    )
    if len(rows) < 2 or not all(row["n"] for row in rows):
        return None
    n = np.array([row["n"] for row in rows], float)
    means = np.array([row["total"] for row in rows]) / n[:, None]
    spread = [
        np.array(row["squares"]).reshape(FEATURES, FEATURES) - c * np.outer(m, m)
        for row, c, m in zip(rows, n, means, strict=True)
    ]
    pooled = sum(spread) / n.sum()
    factors, constants = [], []
    for own, count in zip(spread, n, strict=True):
        shrunk = (1 - to_pooled) * own / count + to_pooled * pooled
        ridge = to_identity * np.trace(shrunk) / FEATURES + 1e-9
        factor = np.linalg.cholesky((1 - to_identity) * shrunk + ridge * np.eye(FEATURES))
        factors.append(factor)
        constants.append(np.log(count / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(factors), np.array(constants))


def score(model: Discriminant | None, text: Column) -> Column:
    """The quality of a text; 0.5 for all texts without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(texts)))

    return scored(text)
