"""Exact interpolated quantiles per group, without ordering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.functions.numeric import present
from chronoloom.session import scratch_path

# Values are first counted in buckets of a fixed relative width, then the buckets that hold a
# wanted rank are cut again, evenly between their smallest and largest value.
PER_OCTAVE = 256
CUTS = 65536
# Larger magnitudes share the outermost bucket.
LARGEST = 1e300
# Rows of one value that may meet in one task in any case, and how many values at most are broadcast beyond that.
FREQUENT = 100_000
MOST_FREQUENT = 20_000


def _coarse(v: Column) -> Column:
    """A bucket number that never falls as the value rises."""
    size = F.least(F.abs(v), F.lit(LARGEST))
    return F.floor(F.signum(v) * F.log2(size + 1.0) * PER_OCTAVE)


def _fine(v: Column, low: Column, high: Column) -> Column:
    """An even cut of ``low..high``, never falling either."""
    cut = F.least(F.floor((v - low) / (high - low) * CUTS), F.lit(CUTS - 1))
    return F.when((high > low) & (high - low < LARGEST), cut).otherwise(F.lit(0))


def value_counts(df: DataFrame, keys: Sequence[str], value: str, inside: Column | None = None) -> DataFrame:
    """How often each group has each value: ``k`` (a struct of the keys), ``v``, its bucket ``b`` and the number ``m``, as a table.

    Counts are combined before the only wide shuffle, so a frequent value is one row from there on, and written, as several
    steps read them. Missing values count as null, and so do all where ``inside`` does not hold, so that every group has a row.
    """
    if not keys:
        raise ValueError("values are counted by at least one key column")
    # A struct of the keys: null keys form groups, and equal each other in joins. Adding zero turns
    # -0.0 into 0.0.
    v = present(F.col(value).cast("double")) + F.lit(0.0)
    values = df.select(F.struct(*keys).alias("k"), (v if inside is None else F.when(inside, v)).alias("v"))
    counts = values.groupBy("k", "v").agg(F.count(F.lit(1)).alias("m")).withColumn("b", _coarse(F.col("v")))
    path = scratch_path(df.sparkSession, "value-counts")
    counts.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """One row per group, one column per named probability, linearly interpolated. Groups without values give no row."""
    return quantiles_of(value_counts(df, keys, value), keys, probabilities)


def quantiles_of(counts: DataFrame, keys: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """Quantiles of counted values (``value_counts``), by selection.

    Counts are summed per bucket, and a running sum over the buckets, whose number does not depend on
    the number of rows, tells which of them hold the wanted ranks. Only the counts in those buckets
    go on: they are summed in finer buckets, and finally ordered by value in the finer buckets that
    matter.
    """
    names, probs = list(probabilities), list(probabilities.values())
    ranks = [side((F.col("n") - 1) * F.lit(p)).cast("long") for p in probs for side in (F.floor, F.ceil)]
    values = counts.where("v IS NOT NULL")

    def located(counts: DataFrame, within: Sequence[str], by: str, base: Column) -> DataFrame:
        """Counts with ``at``, the rank at which each begins, in order of ``by``."""
        before = W.partitionBy(*within).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return counts.withColumn("at", base + F.coalesce(F.sum("c").over(before), F.lit(0)))

    def holds(rank: Column) -> Column:
        return (F.col("at") <= rank) & (rank < F.col("at") + F.col("c"))

    def chosen(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
        return counts.where(reduce(or_, [holds(rank) for rank in ranks])).select(*columns)

    buckets = values.groupBy("k", "b").agg(F.sum("m").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
    buckets = buckets.withColumn("n", F.sum("c").over(W.partitionBy("k")))
    coarse = chosen(located(buckets, ["k"], "b", F.lit(0)), ["k", "b", "n", F.col("at").alias("base"), "low", "high"])
    narrowed = values.join(coarse, ["k", "b"]).withColumn("f", _fine(F.col("v"), F.col("low"), F.col("high")))

    cuts = narrowed.groupBy("k", "b", "n", "base", "f").agg(F.sum("m").alias("c"))
    fine = chosen(located(cuts, ["k", "b"], "f", F.col("base")), ["k", "b", "f", F.col("at").alias("start")])
    last = narrowed.join(fine, ["k", "b", "f"])

    singles = last.groupBy("k", "b", "f", "n", "start", "v").agg(F.sum("m").alias("c"))
    ordered = located(singles, ["k", "b", "f"], "v", F.col("start"))
    found = ordered.groupBy("k", "n").agg(
        *[F.max(F.when(holds(rank), F.col("v"))).alias(f"v{i}") for i, rank in enumerate(ranks)]
    )
    out = []
    for i, (name, p) in enumerate(zip(names, probs)):
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        part = (F.col("n") - 1) * F.lit(p) - ranks[2 * i]
        out.append(F.when(high == low, low).otherwise(low + (high - low) * part).alias(name))
    return found.select(*[F.col("k")[k].alias(k) for k in keys], *out)


def ranks(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with each row's rank in its group by ``value``: one more than the group's rows of smaller values, as SQL's ``rank()``.

    NaN is above all numbers, null above NaN. Values are counted and the counts summed per bucket and finer bucket, as for
    ``quantiles``; running sums over both tell where a value begins. Rows take their value's rank by a join, rows of very
    frequent values by a broadcast, so that they don't meet in one task.
    """
    if not keys:
        raise ValueError("ranks need at least one key column")
    v = F.col(value).cast("double") + F.lit(0.0)
    rows = df.withColumn("__kv", F.struct(F.struct(*keys).alias("k"), v.alias("v")))
    values = rows.groupBy("__kv").agg(F.count(F.lit(1)).alias("m")).select("__kv.k", "__kv.v", "m")
    odd = F.when(F.col("v").isNull(), F.lit((1 << 62) + 1)).when(F.isnan("v"), F.lit(1 << 62))
    path = scratch_path(df.sparkSession, "value-counts")
    values.withColumn("b", F.coalesce(odd, _coarse(F.col("v")))).write.parquet(path)
    values = df.sparkSession.read.parquet(path)
    total = values.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    frequent = F.col("m") > max(FREQUENT, total // MOST_FREQUENT)

    def before(within: Sequence[str], by: str, count: str) -> Column:
        return F.coalesce(F.sum(count).over(W.partitionBy(*within).orderBy(by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    buckets = values.groupBy("k", "b").agg(F.sum("m").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
    buckets = buckets.select("k", "b", "low", "high", before(["k"], "b", "c").alias("base"))
    cut = F.coalesce(_fine(F.col("v"), F.col("low"), F.col("high")), F.lit(0))
    values = values.join(buckets, ["k", "b"]).withColumn("f", cut).drop("low", "high")
    cuts = values.groupBy("k", "b", "f").agg(F.sum("m").alias("c"))
    cuts = cuts.select("k", "b", "f", before(["k", "b"], "f", "c").alias("start"))
    rank = F.col("base") + F.col("start") + before(["k", "b", "f"], "v", "m") + 1
    ranked = values.join(cuts, ["k", "b", "f"]).select(F.struct("k", "v").alias("__kv"), "m", rank.alias(name))

    often = F.broadcast(ranked.where(frequent).drop("m"))
    rare = ranked.where(~frequent).drop("m")
    return rows.join(often, "__kv").unionByName(rows.join(often, "__kv", "left_anti").join(rare, "__kv")).drop("__kv")
