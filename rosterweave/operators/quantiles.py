"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.plans.staging import Stage

#: Cells that a bracket is cut into per round; a task sums up so many counts at most.
CELLS = 4_096


def _narrowed(values: DataFrame, open_: DataFrame, group: str, cells: int) -> DataFrame:
    """The brackets, each replaced by the cell of it that holds its rank."""
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    inner = F.floor(F.nanvl((v - low) / ((high - low) / cells), F.lit(0.0)))
    # Both ends have a cell of their own, so every round takes values off a bracket.
    cell = F.when(v == low, 0).when(v == high, cells).otherwise(
        F.least(F.greatest(inner, F.lit(1)), F.lit(cells - 1))
    )
    key = [group, "name", "rank"]
    counted = (
        values.join(open_, group)
        .where((v >= low) & (v <= high))
        .groupBy(*key, "below", cell.alias("cell"))
        .agg(F.sum("c").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    upward = Window.partitionBy(*key).orderBy("cell")
    end = F.col("below") + F.sum("n").over(upward)
    found = counted.withColumn("end", end).withColumn("below", F.col("end") - F.col("n"))
    return found.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("end"))).select(
        *key, "low", "high", "below"
    )


def exact_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    probabilities: dict[str, float],
    stage: Stage | None = None,
    cells: int = CELLS,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column each, with n, min and max.

    The built-in exact percentile holds every distinct value of a group in one task. Here each value
    is counted once per group, and the two ranks of a quantile are searched for: a bracket, at first
    from the least to the greatest value, is cut into cells, the counts of the cells are summed up,
    and the one that holds the rank is the next bracket, until it is a single value. A round is one
    aggregate over the counts; their number grows with the logarithm of the number of values.
    """
    stage = stage or Stage(df.sparkSession)
    v = F.col(value)
    counts = df.where(v.isNotNull()).groupBy(group, v.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    values = stage(counts, "value_counts")
    totals = stage(
        values.groupBy(group).agg(
            F.sum("c").alias("n"), F.min("v").alias("min"), F.max("v").alias("max")
        ),
        "value_totals",
    )
    last = F.col("n") - 1
    ranks = [
        F.struct(F.lit(f"{name}_{end}").alias("name"), to(F.lit(p) * last).cast("long").alias("rank"))
        for name, p in probabilities.items()
        for end, to in (("a", F.floor), ("b", F.ceil))
    ]
    brackets = totals.select(
        group, "min", "max", F.inline(F.array(*ranks))
    ).select(group, "name", "rank", F.col("min").alias("low"), F.col("max").alias("high"),
             F.lit(0).cast("long").alias("below"))
    done, turn = [], 0
    brackets = stage(brackets, "brackets_0")
    while True:
        done.append(brackets.where("low = high").select(group, "name", F.col("low").alias("found")))
        open_ = brackets.where("low <> high")
        if open_.isEmpty():
            break
        turn += 1
        brackets = stage(_narrowed(values, open_, group, cells), f"brackets_{turn}")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    ends = found.groupBy(group).agg(
        *[F.max(F.when(F.col("name") == f"{n}_{e}", F.col("found"))).alias(f"{n}_{e}")
          for n in probabilities for e in "ab"]
    )
    both = totals.join(ends, group)
    new = {
        n: F.col(f"{n}_a") + (F.col(f"{n}_b") - F.col(f"{n}_a")) * (F.lit(p) * last - F.floor(F.lit(p) * last))
        for n, p in probabilities.items()
    }
    return both.withColumns(new).select(group, "n", "min", "max", *probabilities)
