"""Mixing sources to target sizes by entropy balancing.

For each source, document rates r(size) minimise the sum of r log r - r under the constraint that the
taken words meet the source's target and no rate exceeds ``most``. The solution is the
exponential tilt r = min(most, exp(lambda * size / mean size)); its lambda solves a convex dual, found by
Newton steps on the logarithm inside a bracket that halves when a step would leave it. A step is one
Spark aggregation over the staged counts of documents per source and size, which hold all that the
dual needs. Rates become whole copies by running sums of rates over each source in order of size: a row
gets a copy whenever the sum passes a whole number, so the taken words differ from the target by no more than
the longest document of the source. The sums' start is the one of ``PHASES`` that comes nearest.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and share ``total`` times all
sizes; none exceeds ``most`` times its size, and what it leaves is shared out again by weight.

Defined results: null texts have size 0 and are never taken; null sources are one source, the last; null or repeated
ids are separate rows; a corpus without words has targets of 0; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import text_of, unused, word_count
from reviewmill.session import keep

#: Rows of one source and size that one task numbers, at most about.
PART_ROWS = 500
#: Starts of the running sums that are tried for each source.
PHASES = 32


def water_level(sources: DataFrame, weights: tuple[float, ...], total: float, most: float) -> DataFrame:
    """``sources`` (source, source_size) with ``target``; one narrow row per source, so one task orders them."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The level if all sources before this one stand at their cap.
    wanted = F.sum("source_size").over(everywhere) * float(total)
    level = (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level).withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    # Levels fall from the first open source on.
    final = F.max(F.when(F.col("open"), F.col("level"))).over(everywhere)
    share = F.least(F.col("cap"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    return levels.withColumn("target", share).select("source", "source_size", "target")


def _rate(lam: Column, size: Column, mean: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(lam * size / mean, F.lit(50.0))))


def solve(counts: DataFrame, targets: DataFrame, most: float, steps: int = 40, near: float = 1e-6) -> DataFrame:
    """``targets`` with ``lam`` and ``mean``: Newton steps until every source meets its target to ``near``.

    Sources at their cap need no tilt; their ``lam`` is infinite. The driver reads one number a step.
    """
    means = counts.groupBy(F.col("source").alias("_s")).agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    open_ = (F.col("target") < F.col("source_size") * most * (1 - 1e-12)) & (F.col("target") > 0)
    state = targets.join(means, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumns(
        {
            "lam": F.when(open_, F.lit(0.0)).when(F.col("target") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))),
            "low": F.lit(float("-inf")),
            "high": F.lit(float("inf")),
        }
    )
    state = keep(state, "dual")
    for _ in range(steps):
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), most)
        tilt = state.filter("lam > double('-inf') and lam < double('inf')").select(F.col("source").alias("_s"), "lam", "mean")
        words = F.col("n") * F.col("size") * rate
        sums = counts.join(tilt, F.col("source").eqNullSafe(F.col("_s"))).groupBy("_s").agg(
            F.sum(words).alias("f"),
            F.sum(F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)).alias("g"),
        )
        met = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        newton = F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("g")
        low = F.when(F.col("f") <= F.col("target"), F.col("lam")).otherwise(F.col("low"))
        high = F.when(F.col("f") > F.col("target"), F.col("lam")).otherwise(F.col("high"))
        inside = (F.col("g") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        half = (
            F.when(F.col("high") == float("inf"), F.col("lam") * 2 + 1)
            .when(F.col("low") == float("-inf"), F.col("lam") * 2 - 1)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        off = F.abs(F.col("f") / F.col("target") - 1)
        met = met.withColumns({"low": F.coalesce(low, "low"), "high": F.coalesce(high, "high"), "newton": newton, "off": off})
        met = met.withColumn("next", F.when(F.col("f").isNull() | (off <= near), F.col("lam")).when(inside, F.col("newton")).otherwise(half))
        met = keep(met, "dual")
        state = met.select("source", "source_size", "target", "mean", F.col("next").alias("lam"), "low", "high")
        worst = met.agg(F.max("off")).first()[0]
        if worst is None or worst <= near:
            break
    return state


def _phases(rated: DataFrame) -> DataFrame:
    """For each source the start of its running sum whose taken words come nearest to its target."""
    tried = F.explode(F.array(*(F.lit((i + 0.5) / PHASES) for i in range(PHASES)))).alias("phase")
    rows = rated.select("source", "target", "size", "n", "rate", "before", tried)
    start = F.col("before") + F.col("phase")
    taken = F.col("size") * (F.floor(start + F.col("n") * F.col("rate")) - F.floor(start))
    sums = rows.groupBy("source", "phase").agg(F.sum(taken).alias("taken"), F.max("target").alias("target"))
    off = F.struct(F.abs(F.col("taken") - F.col("target")), F.abs(F.col("phase") - 0.5), "phase")
    return sums.groupBy("source").agg(F.min_by("phase", off).alias("phase"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """``docs`` with a struct ``mix``: size, source_size, target, copies and taken words of each row.

    A column of that name is replaced.
    """
    whole = [F.col(f"`{c}`") for c in docs.columns if c != "mix"]
    # Packed, so that no column of the caller meets a working column.
    sized = docs.select(
        F.struct(*whole).alias("row"), "source", F.col(key).alias("key"),
        word_count(text_of(text)).alias("_size"), F.xxhash64(key).alias("_spread"),
    )
    counts = keep(
        sized.groupBy("source", F.col("_size").alias("size")).agg(F.count("*").alias("n")).repartition("source", "size"), "sizes"
    )
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    state = solve(counts, water_level(sources, weights, total, most), most)
    # Sums of floats depend on the order of tasks in their last digits; the rates must not.
    state = state.withColumn("lam", F.round("lam", 9))
    rated = counts.join(
        state.select(F.col("source").alias("_s"), "source_size", "target", "lam", "mean"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    tilted = (
        F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("lam") == float("inf"), F.lit(float(most)))
        .when(F.col("lam") == float("-inf"), F.lit(0.0)).otherwise(_rate(F.col("lam"), F.col("size"), F.col("mean"), most))
    )
    rated = rated.withColumn("rate", tilted)
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(smaller), F.lit(0.0)))
    rated = rated.join(_phases(rated).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # Rows of one source and size are numbered in parts of bounded size; each part knows the rows before it.
    most_alike = counts.agg(F.max("n")).first()[0] or 1
    parts = max(1, -(-most_alike // PART_ROWS))
    sized = sized.withColumn("_part", F.pmod("_spread", F.lit(parts)))
    in_part = sized.groupBy("source", "_size", "_part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("source", "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    in_part = in_part.withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    in_part = in_part.select(F.col("source").alias("_s2"), F.col("_size").alias("_z2"), F.col("_part").alias("_p2"), "offset")
    # Sources may be null: the keys of this join are made plain so that rows meet by hash.
    plan = rated.join(
        in_part, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("size") == F.col("_z2"))
    ).select("_s2", "_z2", "_p2", F.struct("size", "source_size", "target", "rate", "before", "phase", "offset").alias("_plan"))
    met = sized.join(
        plan,
        F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_size") == F.col("_z2")) & (F.col("_part") == F.col("_p2")),
    )
    order = Window.partitionBy("_s2", "_z2", "_p2").orderBy("_spread", "key")
    nth = F.col("_plan.offset") + F.row_number().over(order)
    start = F.col("_plan.before") + F.col("_plan.phase")
    copies = (F.floor(start + F.col("_plan.rate") * F.col("_nth")) - F.floor(start + F.col("_plan.rate") * (F.col("_nth") - 1))).cast("long")
    met = met.withColumn("_nth", nth).withColumn("_copies", F.least(copies, F.lit(int(most)).cast("long")))
    return met.select(
        "row.*",
        F.struct(
            F.col("_plan.size").alias("size"), F.col("_plan.source_size").alias("source_size"),
            F.col("_plan.target").alias("target"), F.col("_copies").alias("copies"),
            (F.col("_copies") * F.col("_plan.size")).alias("taken"),
        ).alias("mix"),
    )


def repeated(docs: DataFrame, **how) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it."""
    key, text = how.get("key", "doc_id"), how.get("text", "text")
    whole = unused(["source", key, text], "whole")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(whole), "source", key, text)
    mixed = mix(rows, **how).filter("mix.copies > 0")
    return mixed.select(whole, F.explode(F.expr("sequence(1L, mix.copies)"))).select(f"{whole}.*")
