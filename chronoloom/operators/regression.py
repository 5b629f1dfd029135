"""Least squares per group from sums that merge, so that batches add up to one fit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Features that correlate more closely than 1 less this are taken as one.
DEPENDENT = 1e-8


def _pairs(size: int) -> list[tuple[int, int]]:
    """Places of the upper triangle of a matrix."""
    return [(i, j) for i in range(size) for j in range(i, size)]


def gram_sums(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """Per key ``n``, the means ``m0..`` and the centred sums of products ``c0_0..`` of the features and, last, the label.

    These are the normal equations of a fit with an intercept. They are combined before the shuffle, so a key with very many rows
    costs one row a task, and they are centred, so large offsets lose no digits. Rows with a missing feature or label are left out.
    """
    columns = [F.col(c).cast("double") for c in (*features, label)]
    whole = reduce(and_, [c.isNotNull() & ~F.isnan(c) for c in columns])
    rows = df.select(*keys, *[c.alias(f"x{i}") for i, c in enumerate(columns)], whole.alias("whole")).where("whole")
    n = F.count(F.lit(1))
    means = [F.avg(f"x{i}").alias(f"m{i}") for i in range(len(columns))]
    products = [(F.covar_pop(f"x{i}", f"x{j}") * n).alias(f"c{i}_{j}") for i, j in _pairs(len(columns))]
    return rows.groupBy(*keys).agg(n.alias("n"), *means, *products)


def merged_sums(sums: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per key from several, as if all rows had been summed at once. A key has a row for each batch."""
    size = len(features) + 1
    of_key = W.partitionBy(*keys)
    total = F.sum("n").over(of_key)
    apart = {f"d{i}": F.col(f"m{i}") - F.sum(F.col("n") * F.col(f"m{i}")).over(of_key) / total for i in range(size)}
    moved = sums.withColumns(apart)
    means = [(F.sum(F.col("n") * F.col(f"m{i}")) / F.sum("n")).alias(f"m{i}") for i in range(size)]
    products = [F.sum(F.col(f"c{i}_{j}") + F.col("n") * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"c{i}_{j}") for i, j in _pairs(size)]
    return moved.groupBy(*keys).agg(F.sum("n").alias("n"), *means, *products)


def coefficients(sums: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Per key ``n``, ``intercept``, ``coefficients`` (as ``features`` are ordered) and ``r2``.

    Where features depend on each other, up to ``DEPENDENT``, or rows are too few, it is the solution of least norm in standard units. ``r2`` is null where the label does not vary.
    The table has a row per key; many keys are solved at once.
    """
    size = len(features)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            gram = np.empty((len(rows), size + 1, size + 1))
            for i, j in _pairs(size + 1):
                gram[:, i, j] = gram[:, j, i] = rows[f"c{i}_{j}"]
            means = rows[[f"m{i}" for i in range(size + 1)]].to_numpy()
            unit = np.sqrt(np.einsum("kii->ki", gram[:, :size, :size]))
            unit[unit == 0] = 1
            standard = gram[:, :size, :size] / (unit[:, :, None] * unit[:, None, :])
            inverse = np.linalg.pinv(standard, rcond=DEPENDENT, hermitian=True)
            slopes = (inverse @ (gram[:, :size, size] / unit)[:, :, None])[:, :, 0] / unit
            explained, spread = (slopes * gram[:, :size, size]).sum(axis=1), gram[:, size, size]
            out = rows[[*keys, "n"]].copy()
            out["intercept"] = means[:, size] - (slopes * means[:, :size]).sum(axis=1)
            out["coefficients"] = list(slopes)
            out["r2"] = np.divide(explained, spread, out=np.full(len(rows), np.nan), where=spread > 0)
            yield out

    kinds = {f.name: f.dataType.simpleString() for f in sums.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "n bigint, intercept double, coefficients array<double>, r2 double"])
    return sums.mapInPandas(solve, schema)


def fitted_value(features: Sequence[str]) -> Column:
    """The prediction of a row that holds its key's ``intercept`` and ``coefficients``."""
    terms = [F.col("coefficients")[i] * F.col(f) for i, f in enumerate(features)]
    return reduce(lambda a, b: a + b, terms, F.col("intercept"))
