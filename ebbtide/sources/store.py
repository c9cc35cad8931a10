"""The stored tables under one folder, by name, with their schemas enforced."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbtide.schemas import PARTITIONED_BY, TableNames, conform, table_schema
from ebbtide.sources import catalog, readers, writers


@dataclass(frozen=True)
class Store:
    """Tables below ``root``. With ``names``, each has an external catalog table, which every write keeps up to date."""

    spark: SparkSession
    root: str
    names: TableNames | None = None

    def path(self, table: str) -> str:
        table_schema(table)
        return f"{self.root.rstrip('/')}/{table}"

    def exists(self, table: str) -> bool:
        return writers.path_exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        """The table; an empty frame of its schema before the first write."""
        if not self.exists(table):
            return self.spark.createDataFrame([], table_schema(table))
        schema = table_schema(table)
        return self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.names)  # partitions come last

    def named(self, table: str) -> DataFrame:
        """The table by its name in the catalog: the rows of ``read``, with the statistics that were computed last."""
        if self.names is None:
            raise ValueError("the store has no names in a catalog")
        return readers.read_table(self.spark, self.names[table]).select(*table_schema(table).names)

    def append(self, df: DataFrame, table: str) -> None:
        parts = PARTITIONED_BY.get(table, ())
        self._write(conform(df, table_schema(table)), table, lambda rows: writers.append(rows, self.path(table), partition_by=parts))

    def overwrite(self, df: DataFrame, table: str) -> None:
        parts = PARTITIONED_BY.get(table, ())
        writers.overwrite(conform(df, table_schema(table)), self.path(table), parts)
        if self.names is not None:
            self._table(table)
            if parts:
                catalog.forget_partitions(self.spark, self.names[table])
            else:
                self.spark.catalog.refreshTable(self.names[table])

    def replace(self, df: DataFrame, table: str) -> None:
        """Write the partitions of ``df`` anew; the files of the others stay."""
        parts = PARTITIONED_BY[table]
        self._write(conform(df, table_schema(table)), table, lambda rows: writers.replace_partitions(rows, self.path(table), parts))

    def upsert(self, df: DataFrame, table: str, keys: tuple[str, ...]) -> None:
        parts = PARTITIONED_BY.get(table, ())
        self._write(conform(df, table_schema(table)), table, lambda rows: writers.upsert_table(rows, self.path(table), keys, parts))

    def analyze(self, table: str) -> None:
        """Compute the statistics that plans over ``named`` tables use."""
        if self.names is None:
            raise ValueError("the store has no names in a catalog")
        self._table(table)
        catalog.analyze(self.spark, self.names[table])

    def _table(self, table: str) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.names.schema}")
        if not self.spark.catalog.tableExists(self.names[table]):
            catalog.create_external(self.spark, self.names[table], table_schema(table), self.path(table), PARTITIONED_BY.get(table, ()))

    def _write(self, rows: DataFrame, table: str, write: Callable[[DataFrame], object]) -> None:
        """Write, and tell the catalog of the partitions that the rows were in."""
        parts = PARTITIONED_BY.get(table, ())
        if self.names is None:
            write(rows)
            return
        if not parts:
            write(rows)
            self._table(table)
            self.spark.catalog.refreshTable(self.names[table])
            return
        watched, seen = catalog.written_partitions(rows, parts)
        write(watched)
        self._table(table)
        catalog.add_partitions(self.spark, self.names[table], parts, seen.get["partitions"])
