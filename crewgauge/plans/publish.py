"""Write, audit, publish: new versions of several tables become visible only if their keys and references hold."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from crewgauge.plans import quality
from crewgauge.sinks.tables import AUDIT, Staged, Warehouse


class ConstraintError(ValueError):
    """Tables were not published. ``report`` is the stored table of the values that break a constraint."""

    def __init__(self, layer: str, broken: list[tuple[str, str, str, int, int]], report: DataFrame) -> None:
        lines = (f"{table}.{column}: {rule}, {keys} values in {rows} rows" for table, column, rule, keys, rows in broken)
        super().__init__(f"{layer} is not published; " + "; ".join(lines))
        self.broken, self.report = broken, report


def publish_checked(
    warehouse: Warehouse,
    layer: str,
    staged: Mapping[str, Staged],
    audit: Callable[[Mapping[str, DataFrame]], DataFrame] = quality.violations,
) -> dict[str, DataFrame]:
    """Publish all of ``staged`` if ``audit`` finds nothing in them; otherwise discard them all and raise ``ConstraintError``.

    The audit reads the staged versions and, for tables of the layer that are not staged, the published ones. What it finds
    is stored as the table of that layer in the audit database, where the last report stays readable, empty after a
    success; only one count for each broken constraint comes to the driver. Readers keep the old rows until every table has passed. The
    views are then switched one after the other: each is old or new at any moment, a reader of several may meet both.
    """
    tables = {name: warehouse.table(layer, name) for name in warehouse.table_names(layer)}
    tables |= {name: version.rows for name, version in staged.items()}
    warehouse.create_layers(AUDIT)
    report = warehouse.replace(AUDIT, layer, audit(tables))
    broken = (
        report.groupBy("table_name", "column_name", "rule")
        .agg(F.count("*").alias("keys"), F.sum("row_count").alias("rows"))
        .orderBy("table_name", "column_name", "rule")
        .collect()
    )
    if broken:
        for version in staged.values():
            version.discard()
        raise ConstraintError(layer, [tuple(b) for b in broken], report)
    return {name: warehouse.publish(version) for name, version in staged.items()}
