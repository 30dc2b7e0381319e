"""The processed store: one Parquet folder per table, partitioned by dataset (and,
for snapshot tables, by retrieval day), replaced partition by partition."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DatasetUnavailableError
from ..operators.features import TARGET_COLUMNS
from ..schema import TABLES, TableSpec, enforce_schema, table_spec


_COMMITS = "_commits"


def equality_filters(df: DataFrame, filters: Mapping[str, Any] | None, *, lenient: bool) -> DataFrame:
    """``column = value`` / ``column IN values``; None is no condition, an empty
    list matches nothing. ``lenient`` skips columns the frame does not have."""
    for name, value in (filters or {}).items():
        if value is None or (lenient and name not in df.columns):
            continue
        condition: Column
        if isinstance(value, list | tuple | set | frozenset):
            condition = F.col(name).isin(list(value)) if value else F.lit(False)
        else:
            condition = F.col(name) == value
        df = df.where(condition)
    return df


class Lake:
    """Reads, writes and queries the canonical tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------------- paths

    def table_path(self, table: str) -> str:
        return f"{self.root}/processed/{table}"

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/manifests/ingestion_runs"

    def _files(self, path: str):
        """The Hadoop path and the store that it lies in."""
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location, location.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        location, system = self._files(path)
        return system.exists(location)

    def children(self, path: str) -> list[str]:
        """Names below a folder; none where there is no such folder."""
        location, system = self._files(path)
        return sorted(s.getPath().getName() for s in system.listStatus(location)) if system.exists(location) else []

    def delete(self, path: str) -> None:
        location, system = self._files(path)
        system.delete(location, True)

    def tables(self) -> list[str]:
        return [name for name in TABLES if self.exists(self.table_path(name))]

    # ----------------------------------------------------------------- writing

    def write_parquet(self, df: DataFrame, path: str) -> str:
        """Replace a whole folder: the data go into a new version below ``path``, and an
        empty file whose name says which version is current is created once they are complete.

        Nothing is renamed, so it works alike on object stores. A reader sees the version
        before or the one after, and a failed job leaves no file and so the old data as they were. The
        version before is kept for readers that still have it open. Read it with :meth:`read_parquet`.
        """
        known = self.children(path)
        commits = self._commits(path)
        version = f"{int(commits[-1].split('-')[0]) + 1 if commits else 1:012d}-{uuid.uuid4().hex}"
        try:
            df.write.option("compression", "zstd").parquet(f"{path}/data-{version}")
        except Exception:
            self.delete(f"{path}/data-{version}")
            raise
        location, system = self._files(f"{path}/{_COMMITS}/{version}")
        system.create(location, False).close()
        kept = {f"data-{v}" for v in self._commits(path)[-2:]}
        committed = {f"data-{v}" for v in commits}
        for name in known:
            # Versions before the last; files of a folder that was written without versions.
            if name != _COMMITS and name not in kept and (name in committed or not name.startswith("data-")):
                self.delete(f"{path}/{name}")
        for old in commits[:-1]:
            self.delete(f"{path}/{_COMMITS}/{old}")
        return path

    def _commits(self, path: str) -> list[str]:
        return self.children(f"{path}/{_COMMITS}")

    def current_version(self, path: str) -> str:
        """Where the data of a folder are now: its newest version, or itself if it has none."""
        commits = self._commits(path)
        return f"{path}/data-{commits[-1]}" if commits else path

    def write_processed(self, df: DataFrame, table: str, dataset_id: str) -> str:
        """Replace exactly this dataset's rows (of this retrieval day, for snapshot
        tables) and leave every other partition alone."""
        spec = table_spec(table)
        rows = enforce_schema(df, spec).withColumn("dataset_id", F.lit(dataset_id))
        parts = ["dataset_id", "retrieval_date"] if spec.snapshots else ["dataset_id"]
        # Rebalancing gathers each output partition into few files and splits the
        # ones that are too big, from measured sizes: a hot partition stays parallel.
        (
            rows.hint("rebalance", *parts)
            .write.mode("overwrite")
            .option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(self.table_path(table))
        )
        return self.table_path(table)

    def write_staging(self, df: DataFrame, dataset_id: str, retrieval_date: str) -> str:
        """The table as received, per dataset and retrieval day."""
        path = f"{self.root}/staging"
        (
            df.withColumns(
                {"dataset_id": F.lit(dataset_id), "retrieval_date": F.lit(retrieval_date)}
            )
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dataset_id", "retrieval_date")
            .parquet(path)
        )
        return f"{path}/dataset_id={dataset_id}/retrieval_date={retrieval_date}"

    def write_features(self, build) -> str:
        """A modelling table, its families' provenance, and one row about the build:
        rows, columns, targets, share of NULLs per column, and when it was stored."""
        tail = f"office={build.office}/year={build.year}/as_of={build.as_of}"
        path = f"{self.root}/features/{tail}"
        self.write_parquet(build.frame, path)
        build.families.write.mode("overwrite").json(f"{self.root}/features_metadata/{tail}")
        stored = self.read_parquet(path)
        names = stored.columns
        missing = [F.round(F.avg(F.col(c).isNull().cast("int")), 3) for c in names]
        about = stored.agg(
            F.count(F.lit(1)).alias("rows"),
            F.lit(len(names)).alias("columns"),
            F.array(*[F.lit(c) for c in TARGET_COLUMNS if c in names]).alias("target_columns"),
            F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*missing)).alias("missingness"),
            F.current_timestamp().alias("built_at"),
        )
        about.write.mode("overwrite").json(f"{self.root}/features_builds/{tail}")
        return path

    # ----------------------------------------------------------------- reading

    def read_parquet(self, path: str) -> DataFrame:
        """A Parquet folder, in its newest version where it has versions."""
        return self.spark.read.parquet(self.current_version(path))

    def load_features(self, path: str) -> DataFrame:
        return self.read_parquet(path)

    def read_table(self, table: str, *, missing_ok: bool = False) -> DataFrame:
        """All datasets of a table. The schema is given, not inferred, so files of
        different age read alike and no footers are scanned for planning."""
        spec = table_spec(table)
        path = self.table_path(table)
        if not self.exists(path):
            if missing_ok:
                return spec.empty(self.spark)
            raise DatasetUnavailableError(f"nothing is stored for {table!r} below {self.root}")
        return enforce_schema(self.spark.read.schema(spec.schema).parquet(path), spec, stored=True)

    def loaded_tables(self) -> dict[str, DataFrame]:
        return {name: self.read_table(name) for name in self.tables()}

    # -------------------------------------------------------------------- views

    def rebuild_views(self) -> list[str]:
        """Temporary views of what is stored now: the tables, and the last record of
        each load run as ``ingestion_runs``. Views of what has gone are dropped."""
        from .manifest import Manifest

        frames = self.loaded_tables()
        if self.exists(self.manifest_path):
            frames["ingestion_runs"] = Manifest(self).read()
        for gone in {*TABLES, "ingestion_runs"}.difference(frames):
            self.spark.catalog.dropTempView(gone)
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
        return list(frames)

    def list_views(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables() if t.isTemporary)

    def query(self, sql: str, params: Sequence[Any] | Mapping[str, Any] | None = None) -> DataFrame:
        """Ad-hoc SQL with positional (``?``) or named (``:name``) parameters."""
        return run_query(self.spark, sql, params)

    def query_table(
        self,
        table: str,
        filters: Mapping[str, Any] | None = None,
        *,
        columns: Sequence[str] | None = None,
        order_by: Sequence[str] | None = None,
    ) -> DataFrame:
        return select_from(self.read_table(table), filters, columns=columns, order_by=order_by)

    # ---------------------------------------------------------------- inventory

    def inventory(self) -> DataFrame:
        """Rows, columns, bytes and last change per table and dataset."""
        parts = [
            table_inventory(self.spark.read.parquet(self.table_path(name)), name)
            for name in self.tables()
        ]
        if not parts:
            return self.spark.createDataFrame([], INVENTORY_SCHEMA)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


INVENTORY_SCHEMA = (
    "table string, dataset_id string, rows bigint, columns int, files bigint, size_bytes bigint, "
    "modified timestamp"
)


def table_inventory(df: DataFrame, table: str) -> DataFrame:
    """Inventory of a Parquet folder from the file metadata column: first per
    file, then per dataset."""
    columns = len(df.columns)
    per_file = df.groupBy(
        F.col("dataset_id").alias("dataset_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("dataset_id").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("size_bytes"),
        F.max("changed").alias("modified"),
    ).select(
        F.lit(table).alias("table"), "dataset_id", "rows", F.lit(columns).alias("columns"), "files",
        "size_bytes", "modified",
    )


def select_from(
    df: DataFrame,
    filters: Mapping[str, Any] | None = None,
    *,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    out = equality_filters(df, filters, lenient=False)
    if order_by:
        out = out.orderBy(*order_by)
    return out.select(*columns) if columns else out


def run_query(
    spark: SparkSession, sql: str, params: Sequence[Any] | Mapping[str, Any] | None = None
) -> DataFrame:
    try:
        if params is None:
            return spark.sql(sql)
        args = dict(params) if isinstance(params, Mapping) else list(params)
        return spark.sql(sql, args=args)
    except AnalysisException as exc:
        if exc.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            raise DatasetUnavailableError(str(exc)) from exc
        raise


__all__ = ["Lake", "TableSpec", "equality_filters", "run_query", "select_from", "table_inventory"]
