"""Consecutive row numbers over a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from crewgauge.sinks.tables import stored

# monotonically_increasing_id keeps the partition in the upper bits, the position in the lower 33.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def number_rows(
    df: DataFrame, order: list[str], name: str, partitions: int | None = None, distinct: bool = False
) -> DataFrame:
    """Add ``name`` = ROW_NUMBER() OVER (ORDER BY ``order``), NULLs first.

    Rows are range-partitioned and sorted, so every task numbers one slice of the order; adding
    the sizes of the slices before it makes the number global. Columns outside ``order`` and the number of a copy among copies of its row
    break ties, so that no set of equal keys, or even of copies of one row, has
    to fit into one slice. ``distinct`` says that no two rows agree in ``order``; then only these
    columns are keys.

    Two things must not change when a lost executor's work is repeated: the keys that rows are moved by, and the slices whose
    sizes are taken. The keys are made of the row alone: copies are counted, with partial counts in every task, and counted out
    again. The slices are stored, which is the only copy made.

    Without ``partitions`` adaptive execution merges neighbouring slices of a small input. The
    only broadcast is one row per slice, a number set by configuration, not by the data.
    """
    if distinct:
        keyed, keys = df, list(order)
    else:
        keyed = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
        keyed = keyed.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_copy"))
        keys = [*order, *(c for c in df.columns if c not in order), "_copy"]
    sliced = stored(
        keyed.repartitionByRange(*([partitions] if partitions else []), *keys)
        .sortWithinPartitions(*keys)
        .select(*df.columns, F.monotonically_increasing_id().alias("_slot")),
        "slices",
    ).withColumn("_slice", F.shiftright("_slot", _POSITION_BITS))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    position = F.col("_slot").bitwiseAND(F.lit(_POSITION_MASK))
    return sliced.join(F.broadcast(before), "_slice").select(
        (F.col("_before") + position + 1).alias(name), *df.columns
    )
