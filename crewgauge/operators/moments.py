"""Grouped moments, Welch's t-test and Cohen's d over any number of features in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from crewgauge.functions.numeric import ratio
from crewgauge.functions.tails import t_p_value


def grouped_moments(df: DataFrame, flag: str, features: Mapping[str, str]) -> DataFrame:
    """Per feature: rows, missing values, mean and sample deviation of the 1 and the 0 group.

    All features are aggregated side by side, two groups in all; the reshaping to one row per
    feature then works on the two result rows.
    """
    parts = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(label).alias("feature"),
            F.count(column).alias("n"),
            F.sum(F.when(F.col(column).isNull(), 1).otherwise(0)).alias("missing"),
            F.avg(column).alias("mean"),
            F.stddev_samp(column).alias("sd"),
        ).alias(column)
        for i, (column, label) in enumerate(features.items())
    ]
    halves = df.groupBy(F.col(flag).alias("flag")).agg(*parts)
    long = halves.select("flag", F.inline(F.array(*features)))
    pick = lambda value, name: F.max(F.when(F.col("flag") == value, F.col(name)))
    return long.groupBy("position", "feature").agg(
        *(
            pick(value, name).alias(f"{name}_{group}")
            for value, group in ((1, "leavers"), (0, "stayers"))
            for name in ("n", "missing", "mean", "sd")
        )
    )


def welch(moments: DataFrame) -> DataFrame:
    """Add t, its degrees of freedom, the two-sided p and Cohen's d.

    A feature with missing values has no defined test: its statistics are NULL, and the missing
    counts say why.
    """
    n1, n0, v1, v0 = F.col("n_leavers"), F.col("n_stayers"), F.col("_v1"), F.col("_v0")
    gap = F.col("mean_leavers") - F.col("mean_stayers")
    complete = F.coalesce(F.col("missing_leavers") + F.col("missing_stayers"), F.lit(0)) == 0
    e1, e0 = ratio(v1, n1), ratio(v0, n0)
    freedom = ratio((e1 + e0) * (e1 + e0), ratio(e1 * e1, n1 - 1) + ratio(e0 * e0, n0 - 1))
    pooled = F.sqrt(ratio((n1 - 1) * v1 + (n0 - 1) * v0, n1 + n0 - 2))
    return (
        moments.withColumns({
            "_v1": F.col("sd_leavers") * F.col("sd_leavers"),
            "_v0": F.col("sd_stayers") * F.col("sd_stayers"),
        })
        .withColumns({
            "t": F.when(complete, ratio(gap, F.sqrt(e1 + e0))),
            "df": F.when(complete, freedom),
            "cohens_d": F.when(complete, F.when(pooled == 0, F.lit(0.0)).otherwise(ratio(gap, pooled))),
        })
        .withColumn("p", t_p_value("t", "df"))
        .drop("_v1", "_v0")
    )
