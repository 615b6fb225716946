"""Linear models from one pass of sums of products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Penalties of the models.
ALPHA = 1.0
# Coordinate descent ends when no coefficient moves more than this share of the largest.
TOLERANCE, ROUNDS = 1e-12, 100_000


@dataclass(frozen=True)
class Moments:
    """Rows, means, and centred sums of products of the features and, last, the label."""

    rows: int
    means: np.ndarray
    products: np.ndarray


@dataclass(frozen=True)
class LinearFit:
    features: list[str]
    coefficients: list[float]
    intercept: float

    def column(self) -> Column:
        """The prediction, null where a feature is null."""
        out = F.lit(self.intercept)
        for name, w in zip(self.features, self.coefficients, strict=True):
            out = out + F.col(name).cast("double") * F.lit(w)
        return out

    def frame(self, spark) -> DataFrame:
        rows = [("intercept", self.intercept), *zip(self.features, self.coefficients, strict=True)]
        return spark.createDataFrame([(t, float(w)) for t, w in rows], "term string, coefficient double")


def moments(df: DataFrame, features: list[str], label: str) -> Moments:
    """Sums over all rows that have every feature and the label.

    Each task multiplies its own batches; only (features + 2)**2 / 2 sums leave it, and that
    many reach the driver. Values are taken relative to those of one row, so that large
    offsets (years, coordinates) cost no digits when the sums are centred.
    """
    names = [*features, label]
    known = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    known = known.dropna()
    first = known.first()
    if first is None:
        raise ValueError("no row has all features and the label")
    shift, size = np.array(first, float), len(names) + 1
    upper = np.triu_indices(size)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) - s for c, s in zip(batch.columns, shift, strict=True)]])
                total += x.T @ x
        i, j = upper
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[upper])], names=["i", "j", "s"])

    sums = np.zeros((size, size))
    for r in known.mapInArrow(multiply, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        sums[r["i"], r["j"]] = sums[r["j"], r["i"]] = r["s"]
    n = sums[0, 0]
    offset = sums[0, 1:] / n
    return Moments(int(round(n)), shift + offset, sums[1:, 1:] - n * np.outer(offset, offset))


def _ridge(gram: np.ndarray, target: np.ndarray, alpha: float) -> np.ndarray:
    """Cholesky where the penalised matrix is safely positive, least squares of the smallest size elsewhere."""
    penalised = gram + alpha * np.eye(len(gram))
    scale = np.sqrt(np.maximum(np.diag(penalised), 0.0))
    scale[scale == 0] = 1.0
    even = penalised / np.outer(scale, scale)
    try:
        if np.linalg.eigvalsh(even)[0] < 1e-12:
            raise np.linalg.LinAlgError
        low = np.linalg.cholesky(even)
        return np.linalg.solve(low.T, np.linalg.solve(low, target / scale)) / scale
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(even, target / scale, rcond=1e-12)[0] / scale


def _lasso(gram: np.ndarray, target: np.ndarray, penalty: float) -> np.ndarray:
    """Coordinate descent on the sums; `penalty` is the rows times alpha."""
    w = np.zeros(len(target))
    for _ in range(ROUNDS):
        most = moved = 0.0
        for j in range(len(w)):
            if gram[j, j] <= 0:
                continue
            rho = target[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - penalty, 0.0) / gram[j, j]
            moved = max(moved, abs(new - w[j]) * np.sqrt(gram[j, j]))
            most = max(most, abs(new) * np.sqrt(gram[j, j]))
            w[j] = new
        if moved <= TOLERANCE * most:
            break
    return w


def solve(found: Moments, features: list[str], kind: str, alpha: float = ALPHA) -> LinearFit:
    """`linear`, `ridge` (penalty alpha on the sum of squares) or `lasso` (alpha on the mean loss); the intercept is free."""
    gram, target = found.products[:-1, :-1], found.products[:-1, -1]
    if kind == "lasso":
        w = _lasso(gram, target, alpha * found.rows)
    elif kind in ("ridge", "linear"):
        w = _ridge(gram, target, alpha if kind == "ridge" else 0.0)
    else:
        raise ValueError(f"unknown model {kind}")
    return LinearFit(list(features), [float(x) for x in w], float(found.means[-1] - found.means[:-1] @ w))


def fit(df: DataFrame, kind: str, features: list[str], label: str = "traffic_volume", alpha: float = ALPHA) -> LinearFit:
    """Fit on all rows in one pass over them. Rows with a null feature or label don't train."""
    return solve(moments(df, features, label), features, kind, alpha)


def fit_all(df: DataFrame, kinds: list[str], features: list[str], label: str = "traffic_volume", alpha: float = ALPHA) -> dict[str, LinearFit]:
    """Several models from the same pass."""
    found = moments(df, features, label)
    return {kind: solve(found, features, kind, alpha) for kind in kinds}
