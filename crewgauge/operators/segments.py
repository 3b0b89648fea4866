"""One-pass marts in long format: (segment_type, segment, measures)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def by_segments(
    df: DataFrame,
    segments: Mapping[str, Column],
    totals: Mapping[str, Column],
    whole: tuple[str, str] | None = None,
    type_name: str = "segment_type",
    label_name: str = "segment",
) -> DataFrame:
    """Aggregate ``df`` once and report the totals for every level of every segment.

    ``totals`` must be additive (sums or counts). A first aggregation over all segment columns
    together reads the input once and shrinks each task's share before the shuffle; only its
    groups, not the input rows, are then repeated per segment. One query per segment would scan
    once per segment. A NULL level stays a level of its own.

    ``whole`` is the (type, label) of a row over everything, which is there for an empty ``df`` too.
    """
    levels = {f"_level{i}": column for i, column in enumerate(segments.values())}
    sums = [total.alias(n) for n, total in totals.items()]
    profile = df.groupBy(*(column.cast("string").alias(n) for n, column in levels.items())).agg(*sums)

    def entry(segment_type: str, label: Column) -> Column:
        return F.struct(F.lit(segment_type).alias("type"), label.alias("label"))

    entries = [entry(segment_type, F.col(n)) for segment_type, n in zip(segments, levels)]
    if whole:
        entries.append(entry(whole[0], F.lit(whole[1])))
    long = profile.select(F.explode(F.array(*entries)).alias("_entry"), *totals)
    if whole:
        # Totals of no rows: zero counts and NULL sums, neutral when added to others.
        nothing = df.limit(0).agg(*sums).select(entry(whole[0], F.lit(whole[1])).alias("_entry"), *totals)
        long = long.unionByName(nothing)
    return long.groupBy(F.col("_entry.type").alias(type_name), F.col("_entry.label").alias(label_name)).agg(
        *(F.sum(n).alias(n) for n in totals)
    )
