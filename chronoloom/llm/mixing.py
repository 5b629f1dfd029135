"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.stored import fresh, stored

MAX_NEWTON = 60
NEWTON_TOLERANCE = 1e-6
ROUNDING_PASSES = 6
ROUNDING_WAYS = 8


def n_words(text: Column) -> Column:
    """Number of maximal runs of characters other than white space (space, tab to carriage return); null has none."""
    # A run ends where a white character follows or the text ends; counting ends needs no array of words.
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "\u0001")
    return F.length(F.regexp_replace(marked, r"[\x20\x09-\x0D]+", "")).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source by code point, null last, from 0.

    Sources are dealt to sorted ranges; a range's first position is the number of sources in the ranges before it. Only these
    few numbers per range meet in one task.
    """
    ordered = stored(
        sources.withColumn("no_name", F.col("source").isNull()).repartitionByRange("no_name", "source").withColumn("part", F.spark_partition_id()), "mix-ranges"
    )
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("in_part"))
    before = F.coalesce(F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("no_name", "source")) - 1
    starts = sizes.select("part", before.alias("start"))
    return ordered.withColumn("inside", inside).join(starts, "part").withColumn("position", F.col("start") + F.col("inside")).drop("part", "no_name", "start", "inside")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: float = 3.0) -> DataFrame:
    """Targets of sources: rows (source, source_size, target) of a table (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn and share the sum of all sizes by weight. No target is above
    ``max_repeats`` times its source's size; what is over is shared again by weight among the others until none is above. Only the
    totals of each round come to the driver.
    """
    ranked = _ranked(sizes)
    given = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(
        ranked.withColumn("weight", F.element_at(given, (F.col("position") % len(weights) + 1).cast("int"))).withColumn("most", max_repeats * F.col("source_size")),
        "mix-sources",
    )
    total = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, full = 0.0, -1
    while True:  # a source once at its most stays there, since the level only rises; so this ends
        over = F.col("most") <= level * F.col("weight")
        row = ranked.agg(
            F.sum(F.when(over, F.col("most")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.sum(F.when(over, 1).otherwise(0))
        ).first()
        if row[0] is None or row[2] == full or not row[1]:
            break
        full, level = row[2], (total - row[0]) / row[1]
    return ranked.select("source", "source_size", F.least(F.col("most"), level * F.col("weight")).alias("target"))


def _joined(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join on the source, null equal to null. ``per_source`` has one row a source."""
    return rows.join(per_source.withColumnRenamed("source", "source_"), F.expr("source <=> source_")).drop("source_")


def balanced_tilts(histogram: DataFrame, targets: DataFrame, max_repeats: float = 3.0) -> DataFrame:
    """The dual solution: rows (source, tilt, scale) for which rates meet the targets.

    Of all document rates from 0 to ``max_repeats`` whose tokens sum to each source's target, entropy balancing takes those
    nearest to 1 in relative entropy: ``rate = min(max_repeats, exp(tilt * size / scale))``. The dual over the tilts is convex;
    its gradient is the tokens taken less the target and its Hessian is diagonal, since a document counts in one source's constraint only. Newton
    steps are kept inside a bracket that shrinks with each sign of the gradient. ``histogram`` is (source, size, n), counted once before,
    so that an iteration reads distinct sizes and not documents; every iteration is one aggregation on Spark.
    """
    state = stored(
        targets.select(
            "source",
            "target",
            (F.col("target") >= max_repeats * F.col("source_size") * (1 - 1e-12)).alias("full"),
            F.lit(0.0).alias("tilt"),
            F.lit(float("-inf")).alias("low"),
            F.lit(float("inf")).alias("high"),
            F.lit(1.0).alias("gap"),
        ),
        "mix-dual",
    )
    scales = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    scaled = stored(_joined(histogram, scales), "mix-histogram")
    raw = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(50.0)))
    rate = F.least(raw, F.lit(float(max_repeats)))
    tokens = F.col("size") * F.col("n")
    for _ in range(MAX_NEWTON):
        sums = (
            _joined(scaled, state.select("source", "tilt"))
            .groupBy("source")
            .agg(F.sum(tokens * rate).alias("taken"), F.sum(F.when(raw < max_repeats, tokens * rate * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"))
        )
        open_ = ~F.col("full") & (F.abs(F.col("taken") - F.col("target")) > NEWTON_TOLERANCE * F.col("target"))
        low = F.when(F.col("taken") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("taken") > F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + F.when(F.col("slope") > 0, (F.col("target") - F.col("taken")) / F.col("slope")).otherwise(F.lit(0.0))
        inside = (step > F.col("low")) & (step < F.col("high")) & (F.abs(step - F.col("tilt")) <= 4.0) & (step != F.col("tilt"))
        far = F.when(F.col("high") == float("inf"), 2 * F.abs("tilt") + 2.0).when(F.col("low") == float("-inf"), -2 * F.abs("tilt") - 2.0).otherwise((F.col("low") + F.col("high")) / 2)
        state = stored(
            _joined(state, sums)
            .withColumn("low", low)
            .withColumn("high", high)
            .withColumn("gap", F.when(open_, F.abs(F.col("taken") - F.col("target"))).otherwise(0.0))
            .withColumn("tilt", F.when(open_, F.when(inside, step).otherwise(far)).otherwise(F.col("tilt")))
            .select("source", "target", "full", "tilt", "low", "high", "gap"),
            "mix-dual",
        )
        gap = state.agg(F.max(F.col("gap") / F.col("target"))).first()[0] or 0.0
        if not gap:
            break
    else:
        warnings.warn(f"a source is {gap:.2g} of its target away after {MAX_NEWTON} Newton steps; rounding starts from there", stacklevel=2)
    full_tilt = F.when(F.col("full"), F.lit(1e300)).otherwise(F.col("tilt"))
    return _joined(state.select("source", full_tilt.alias("tilt")), scales)


def _draw(hashed: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return F.pmod(hashed, F.lit(1 << 52)) / F.lit(float(1 << 52))


def _rate(tilt: Column, size: Column, scale: Column, max_repeats: float) -> Column:
    power = tilt * size / scale
    return F.when(power > 50.0, F.lit(float(max_repeats))).otherwise(F.least(F.exp(F.least(power, F.lit(50.0))), F.lit(float(max_repeats))))


def _copies(shift: Column, max_repeats: float) -> Column:
    """Whole copies of the ``m`` rows of one id, source and size together: their rates, plus a fixed number in [0, 1), plus their source's
    shift for each, rounded down."""
    return F.least(F.greatest(F.floor(F.col("m") * (F.col("rate") + shift) + F.col("draw")), F.lit(0)), F.col("m") * int(max_repeats))


ALIKE = ["doc_id", "source", "size"]
"""What copies depend on. Rows alike in all three share out their copies by their places."""


@dataclass
class Mix:
    """A fitted mix: per source its size, target, tilt, scale and shift; and the rows that are alike, with their number ``m``."""

    sources: DataFrame
    alike: DataFrame
    max_repeats: int

    def copies_of(self, rows: DataFrame, size: str, name: str) -> DataFrame:
        """``rows`` with the column ``name``, how often the mix takes each. Other rows than those it was fitted on give other sums."""
        known, place, m = fresh(rows, "mix_source", "mix_place", "mix_m")
        at = self.sources.select(F.col("source").alias(known), F.struct("tilt", "scale", "shift").alias(f"{known}_fit"))
        alike = self.alike.select(*[F.col(c).alias(f"{known}_{c}") for c in ALIKE], F.col("m").alias(m))
        same = F.lit(True)
        for c, own in zip(ALIKE, ("doc_id", "source", size), strict=True):
            same = same & F.col(own).eqNullSafe(F.col(f"{known}_{c}"))
        hidden = [f"{known}_{c}" for c in ALIKE]
        if self.alike.isEmpty():
            placed = rows.select("*", F.lit(1).cast("bigint").alias(m), F.lit(0).cast("bigint").alias(place))
        else:
            single = rows.join(alike, same, "left_anti").select("*", F.lit(1).cast("bigint").alias(m), F.lit(0).cast("bigint").alias(place))
            several = rows.join(alike, same).drop(*hidden)
            placed = single.unionByName(_placed(several, ["doc_id", "source", size], place))
        joined = placed.join(at, F.col("source").eqNullSafe(F.col(known)), "left")
        fit = F.col(f"{known}_fit")
        rate = _rate(fit["tilt"], F.col(size), fit["scale"], self.max_repeats)
        draw = _draw(F.xxhash64("doc_id", "source", size))
        together = F.floor(F.col(m) * (rate + fit["shift"]) + draw)
        together = F.least(F.greatest(together, F.lit(0)), F.col(m) * self.max_repeats)
        each = F.floor(together / F.col(m)) + F.when(F.col(place) < together % F.col(m), 1).otherwise(0)
        return joined.select(*[F.col(c) for c in rows.columns], F.when(F.col(size) > 0, each).otherwise(0).cast("int").alias(name))


def _placed(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with each row's place among those alike, from 0. They are written with their task and numbered within it; the places of a task
    begin after those of the tasks before it, so rows that are all alike need not meet."""
    part, n, before = fresh(rows, "mix_part", "mix_n", "mix_before")
    held = stored(rows.withColumn(part, F.spark_partition_id()), "mix-alike")
    sizes = held.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(n))
    earlier = F.sum(n).over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*[F.col(k).alias(f"{before}_{i}") for i, k in enumerate(keys)], F.col(part).alias(f"{before}_part"), F.coalesce(earlier, F.lit(0)).alias(before))
    same = F.col(part) == F.col(f"{before}_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"{before}_{i}"))
    inside = F.row_number().over(Window.partitionBy(*keys, part).orderBy(F.lit(0))) - 1
    return held.withColumn(n, inside).join(starts, same).select(*[F.col(c) for c in rows.columns], (F.col(before) + F.col(n)).cast("bigint").alias(name))


def fit_mix(rows: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> Mix:
    """Fit the mix of rows ``(doc_id, source, size)``. Targets are those of ``source_targets``, rates those of ``balanced_tilts``.

    Rates are rounded to whole copies, 0 to ``max_repeats``, by a number in [0, 1) hashed from id, source and size; a shift for each source,
    searched for in passes that each try ``ROUNDING_WAYS`` values in one aggregation, brings the tokens taken to the target as nearly as
    whole documents allow.
    """
    grouped = stored(rows.groupBy(*ALIKE).agg(F.count(F.lit(1)).alias("m")), "mix-groups")
    histogram = stored(grouped.groupBy("source", "size").agg(F.sum("m").alias("n")), "mix-counts")
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = stored(source_targets(totals, weights, max_repeats), "mix-targets")
    tilts = stored(balanced_tilts(histogram.where("size > 0"), targets.where("source_size > 0"), max_repeats), "mix-tilts")
    draw = _draw(F.xxhash64(*ALIKE)).alias("draw")
    rate = _rate(F.col("tilt"), F.col("size"), F.col("scale"), max_repeats).alias("rate")
    rated = stored(_joined(grouped.where("size > 0"), tilts).select("source", "size", "m", rate, draw), "mix-rates")

    shifts = targets.where("source_size > 0").select("source", "target", F.lit(0.0).alias("shift"))
    width = 2.0
    for _ in range(ROUNDING_PASSES):
        tried = [width * (2 * k / ROUNDING_WAYS - 1) for k in range(ROUNDING_WAYS + 1)]
        sums = _joined(rated, shifts.select("source", "shift")).groupBy("source")
        sums = sums.agg(*[F.sum(F.col("size") * _copies(F.col("shift") + F.lit(t), max_repeats)).alias(f"t{k}") for k, t in enumerate(tried)])
        best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("gap"), F.lit(abs(t)).alias("far"), F.lit(t).alias("t")) for k, t in enumerate(tried)]))
        shifts = stored(_joined(shifts, sums).select("source", "target", (F.col("shift") + best["t"]).alias("shift")), "mix-shifts")
        width = 2 * width / ROUNDING_WAYS
    fitted = _joined(tilts.select("source", "tilt", "scale"), shifts.select("source", "shift"))
    renamed = fitted.withColumnRenamed("source", "source_")
    sources = targets.join(renamed, F.expr("source <=> source_"), "left").drop("source_")
    return Mix(stored(sources, "mix-fitted"), grouped.where("m > 1 and size > 0"), max_repeats)


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """Copies of every document for a mix of given source weights, as large as all documents together.

    One row for each row of ``docs(doc_id, text, source)``: doc_id, source, size, source_size, target, rate, copies, taken. Sizes
    are words. See ``fit_mix``.

    Null and empty texts have size 0 and are taken 0 times; null sources form a source of their own. Rows of one id, size and source get
    their copies together, as evenly as whole copies allow, and which of them has one more depends on their order only; reruns
    agree in the rows as a whole. An empty table gives an empty table. Other columns are ignored.
    """
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    mix = fit_mix(sized, weights, max_repeats)
    rated = _joined(mix.copies_of(sized, "size", "copies"), mix.sources)
    rate = F.coalesce(F.when(F.col("size") > 0, _rate(F.col("tilt"), F.col("size"), F.col("scale"), max_repeats)), F.lit(0.0))
    return rated.select(
        "doc_id", "source", "size", "source_size", "target", rate.alias("rate"), "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as ``mix_sources`` takes it, with its own columns.

    Documents with no copies are gone. Copies follow from a document's own row and what was fitted for its source, so texts are not shuffled.
    """
    size, copies = fresh(docs, "mix_size", "mix_copies")
    rows = docs.withColumn(size, n_words(F.col("text")))
    mix = fit_mix(rows.select("doc_id", "source", F.col(size).alias("size")), weights, max_repeats)
    taken = mix.copies_of(rows, size, copies).where(F.col(copies) > 0)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies)).drop(copies)
