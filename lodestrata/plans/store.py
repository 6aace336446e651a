"""Where the tables of a pipeline live: catalog schemas or folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lodestrata.sources import catalog, sinks


@dataclass(frozen=True)
class Store:
    """Reads and writes tables by layer and name.

    With ``folder`` a table is a Parquet folder ``<folder>/<layer>/<name>``; without it
    a catalog table ``<prefix><layer>.<name>``.
    """

    spark: SparkSession
    folder: str | None = None
    prefix: str = ""

    def prepare(self, layers: Sequence[str]) -> None:
        if self.folder is None:
            catalog.ensure_schemas(self.spark, [self.prefix + layer for layer in layers])

    def location(self, layer: str, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{layer}/{name}" if self.folder else f"{self.prefix}{layer}.{name}"

    def write(self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table and return a scan of it."""
        placed = sinks.clustered(df, cluster_by) if cluster_by else df
        if self.folder:
            sinks.overwrite_path(placed, self.location(layer, name))
            return self.spark.read.schema(df.schema).parquet(self.location(layer, name))
        sinks.overwrite_table(placed, self.location(layer, name))
        return self.read(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        if self.folder:
            return self.spark.read.parquet(self.location(layer, name))
        return self.spark.table(self.location(layer, name))

    def find(self, layer: str, names: Sequence[str]) -> dict[str, DataFrame]:
        """The named tables that exist."""
        found = {}
        for name in names:
            try:
                found[name] = self.read(layer, name)
            except AnalysisException:
                continue
        return found
