"""Layer databases and replaceable Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from crewgauge.session import scratch_path

LAYERS = ("bronze", "silver", "gold")
#: The database of audit reports, one table for each audited layer.
AUDIT = "audit"
# Between a table's name and the number of its version.
_VERSION = "__version_"
# The property of a table's view that holds the number of the version it shows.
_PROPERTY = "crewgauge.version"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a frame that several plans of one call read: it is computed once, readers still get only
    their columns, and a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Warehouse:
    """One database per layer, named ``<prefix><layer>``, below ``root`` if given.

    ``buckets`` is the bucket count of the tables with one row per employee, to be chosen for
    the size of the workforce; without it they are plain tables.
    """

    spark: SparkSession
    prefix: str = ""
    root: str | None = None
    buckets: int | None = None

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def create_layers(self, *layers: str) -> None:
        for layer in layers or LAYERS:
            place = f" LOCATION '{self.root}/{layer}'" if self.root else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{place}")

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(f"{self.database(layer)}.{name}")

    def table_names(self, layer: str) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database(layer)) if _VERSION not in t.name)

    def versions(self, layer: str, name: str) -> list[int]:
        """The stored versions of a table, oldest first."""
        names = (t.name for t in self.spark.catalog.listTables(self.database(layer)))
        start = f"{name}{_VERSION}".lower()
        return sorted(int(n[len(start) :]) for n in names if n.lower().startswith(start))

    def published(self, layer: str, name: str) -> int | None:
        """The version that readers of the table see."""
        if not self.spark.catalog.tableExists(f"{self.database(layer)}.{name}"):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.database(layer)}.{name}").collect()
        return next((int(r["value"]) for r in rows if r["key"] == _PROPERTY), None)

    def stage(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        unique_key: str | None = None,
        order: tuple[str, ...] = (),
    ) -> Staged:
        """Write ``df`` as a new version of the table, which no reader sees before it is published.

        ``unique_key`` names the key of a table that has one row per key. Where buckets are in
        use the table is bucketed on it, so such tables join without a shuffle. A table in which one key may own a large share of the rows
        must not be bucketed on it, as a bucket is read by one task; it gets ``order`` instead,
        spread by ranges of all the named columns. Other tables are rebalanced: adaptive
        execution merges small pieces and splits large ones, so small marts end up in one file.
        """
        if order:
            laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order)
        elif unique_key and self.buckets:
            laid_out = df.hint("rebalance", self.buckets, unique_key)
        else:
            laid_out = df.hint("rebalance")
        writer = laid_out.write.mode("overwrite").format("parquet")
        if unique_key and self.buckets:
            writer = writer.bucketBy(self.buckets, unique_key).sortBy(unique_key)
        staged = Staged(self, layer, name, max(self.versions(layer, name), default=0) + 1)
        writer.saveAsTable(staged.full_name)
        return staged

    def publish(self, staged: Staged) -> DataFrame:
        """Switch the table's readers to a staged version.

        The content is a table of its own, and the name is a view on it, so readers see the old or the new rows at every
        moment. The version before is kept for those who still read it; all others are dropped.
        """
        layer, name, before = staged.layer, staged.name, self.published(staged.layer, staged.name)
        view = f"{self.database(layer)}.{name}"
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_PROPERTY}' = '{staged.version}') AS SELECT * FROM {staged.full_name}"
        )
        for number in self.versions(layer, name):
            if number < staged.version and number != before:
                Staged(self, layer, name, number).discard()
        return self.table(layer, name)

    def replace(self, layer: str, name: str, df: DataFrame, **options) -> DataFrame:
        """Write ``df`` as the table's new content, show it to readers and return the stored table. Options as in ``stage``."""
        return self.publish(self.stage(layer, name, df, **options))

    def stage_all(self, layer: str, tables: Mapping[str, DataFrame], **options: dict) -> dict[str, Staged]:
        """Stage tables that do not read each other, submitting their jobs side by side.

        ``options`` gives the ``stage`` arguments of single tables by name.
        """
        with ThreadPoolExecutor(max_workers=max(len(tables), 1)) as pool:
            writes = {
                name: pool.submit(self.stage, layer, name, df, **options.get(name, {}))
                for name, df in tables.items()
            }
            return {name: write.result() for name, write in writes.items()}

    def replace_all(self, layer: str, tables: Mapping[str, DataFrame], **options: dict) -> dict[str, DataFrame]:
        """``replace`` for tables that do not read each other."""
        return {name: self.publish(staged) for name, staged in self.stage_all(layer, tables, **options).items()}


@dataclass(frozen=True)
class Staged:
    """A stored version of a table."""

    warehouse: Warehouse
    layer: str
    name: str
    version: int

    @property
    def full_name(self) -> str:
        return f"{self.warehouse.database(self.layer)}.{self.name}{_VERSION}{self.version}"

    @property
    def rows(self) -> DataFrame:
        return self.warehouse.spark.table(self.full_name)

    def discard(self) -> None:
        self.warehouse.spark.sql(f"DROP TABLE IF EXISTS {self.full_name}")
