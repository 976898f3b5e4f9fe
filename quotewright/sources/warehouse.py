"""Catalog tables over Parquet folders: typed RAW tables that switch to a verified
copy, mart tables, append-only audit tables and replaceable control tables."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.operators.clean import conform
from quotewright.schemas import CONTROL_TICKER, DQ_RESULTS, LOAD_LOG, TableSpec, control_schema
from quotewright.session import together


COMMIT = T.StructType(
    [T.StructField(c, T.TimestampType() if c == "at" else T.StringType()) for c in ("run_id", "at", "layer", "table", "path", "columns")]
)


class Warehouse:
    """Databases raw, model and mart (with an optional name prefix) under ``root``.

    New data goes to a folder of its run first. ``publish`` then points the table
    at that folder, a catalog change readers see at once or not at all.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def run_path(self, run_id: str, layer: str, table: str) -> str:
        return f"{self.root}/runs/{run_id}/{layer}/{table}"

    def create(self, specs: Mapping[str, TableSpec], source_a: str, source_b: str) -> None:
        """Databases, empty typed RAW tables and audit tables, where missing."""
        for layer in ("raw", "model", "mart"):
            home = f"{self.root}/tables/{layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION '{home}'")
        run, day = "run_id", "report_ingest_date"
        controls = control_schema(source_a, source_b)
        together(
            [partial(self._create, "raw", spec.name, spec.schema) for spec in specs.values()]
            + [
                partial(self._create, "mart", "load_log", LOAD_LOG, run),
                partial(self._create, "mart", "dq_results", DQ_RESULTS, run),
                partial(self._create, "mart", "recon_report_control", controls, day),
                partial(self._create, "mart", "recon_report_control_ticker", CONTROL_TICKER, day),
            ]
        )

    def _create(self, layer: str, table: str, schema: T.StructType, partition: str = "") -> None:
        name, home = self.name(layer, table), f"{self.root}/tables/{layer}/{table}"
        if self.spark.catalog.tableExists(name):
            return
        # an existing folder of rows stays as it is: nothing is appended to it
        empty = self.spark.createDataFrame([], schema).write.mode("ignore")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = f"PARTITIONED BY ({partition})" if partition else ""
        (empty.partitionBy(partition) if partition else empty).parquet(home)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{home}'")
        if partition:
            self.spark.catalog.recoverPartitions(name)

    def stage(self, df: DataFrame, run_id: str, layer: str, table: str) -> DataFrame:
        """Write to the run's folder and read it back; nothing is visible yet."""
        path = self.run_path(run_id, layer, table)
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self, staged: DataFrame, run_id: str, layer: str, table: str) -> None:
        """Point the table at the run's folder, creating it where it is missing or
        has other columns."""
        name, path = self.name(layer, table), self.run_path(run_id, layer, table)
        exists = self.spark.catalog.tableExists(name)
        if exists and self.spark.table(name).schema != staged.schema:
            self.spark.sql(f"DROP TABLE {name}")
            exists = False
        if exists:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.catalog.createTable(name, path, source="parquet", schema=staged.schema)

    def commit(self, staged: Mapping[tuple[str, str], DataFrame], run_id: str, at: datetime) -> None:
        """Make the staged tables of a run, by (layer, table), the warehouse's: one file that
        names them all appears at once. Its size is that of the list of tables."""
        rows = [(run_id, at, layer, table, self.run_path(run_id, layer, table), df.schema.json()) for (layer, table), df in staged.items()]
        record = self.spark.createDataFrame(rows, COMMIT).coalesce(1)
        record.write.mode("overwrite").json(f"{self.root}/commits/{run_id}")

    def commits(self) -> DataFrame:
        """run_id, at, layer, table, path, columns: a row for each table of each committed run."""
        home = f"{self.root}/commits"
        self.spark.createDataFrame([], COMMIT).write.mode("ignore").json(f"{home}/none")
        return self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true").json(home)

    def _last(self) -> list[Row]:
        newest = F.max(F.struct("at", "run_id")).over(W.partitionBy())
        commits = self.commits().withColumn("newest", newest).where("run_id = newest.run_id")
        return commits.orderBy("layer", "table").collect()

    def committed(self) -> dict[tuple[str, str], DataFrame]:
        """All tables of the run committed last, by (layer, table): never of two runs. What
        is read stays that run's, also when others are committed meanwhile."""
        return {
            (r.layer, r.table): self.spark.read.schema(T.StructType.fromJson(json.loads(r.columns))).parquet(r.path)
            for r in self._last()
        }

    def catch_up(self) -> list[str]:
        """Point the catalog's tables at the run committed last; returns those that were not.
        A run stopped after its commit is completed by this, and one stopped before it
        leaves nothing to do."""
        behind = []
        for r in self._last():
            name = self.name(r.layer, r.table)
            if self._location(name) != r.path:
                staged = self.spark.read.schema(T.StructType.fromJson(json.loads(r.columns))).parquet(r.path)
                self.publish(staged, r.run_id, r.layer, r.table)
                behind.append(name)
        return behind

    def _location(self, name: str) -> str | None:
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
        path = rows[0].data_type if rows else ""
        return path if "://" in self.root or ":" in self.root.split("/")[0] else path.removeprefix("file:")

    def append(self, df: DataFrame, table: str) -> None:
        """Append audit rows. A run's rows are few, so they go into one file."""
        name = self.name("mart", table)
        target = self.spark.table(name).schema
        conform(df, target).repartition(1).write.mode("append").insertInto(name)

    def record(self, df: DataFrame, table: str, run_id: str) -> None:
        """All audit rows of a run in a table, in place of any it already has there: a
        repeated or restarted run records the same rows once."""
        self.replace(df.repartition(1), table, "run_id", run_id)

    def replace(self, df: DataFrame, table: str, column: str, value: str) -> None:
        """Replace the rows of one partition value, also when ``df`` has none."""
        name = self.name("mart", table)
        target = self.spark.table(name).schema
        kept = T.StructType([f for f in target if f.name != column])
        kind = target[column].dataType
        literal = f"'{value}'" if isinstance(kind, T.StringType) else f"{kind.simpleString()} '{value}'"
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = {literal}) SELECT * FROM {{rows}}",
            rows=conform(df, kept),
        )
