"""Typed, ordered Parquet exports with a manifest of exact fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import partial, reduce
from operator import add

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.columns import plain_number
from quotewright.operators.clean import clean_columns, clean_decimals, conform, is_nan, resolve
from quotewright.operators.fingerprint import VALUE, content_metrics, digest_hex, digest_parts, metric_columns
from quotewright.schemas import MANIFEST, TableSpec
from quotewright.session import drop_folder, keep, new_folder, together

# Files stay small enough to be hashed as one binary value: so many rows, and fewer where
# texts make them wide, that a file's plain values hold about so many bytes.
ROWS_PER_FILE = 2_000_000
BYTES_PER_FILE = 512 << 20


class SourceChangedError(RuntimeError):
    """Files of a source changed while its snapshot was taken."""


class WriteGuardError(RuntimeError):
    """Rows written, rows counted before and rows read back do not agree."""


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table as exactly ``schema``, columns matched by name."""
    return conform(spark.read.parquet(path), schema)


def write_ordered(
    df: DataFrame, path: str, keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE
) -> Observation:
    """Write Snappy Parquet sorted by ``keys`` across and within files.

    Ranges are cut on the keys plus the number of the input partition, so copies
    of one key can spread over files too. The row count is observed in the stage
    that writes, where a task that is run again counts once.
    """
    written = Observation()
    (
        df.withColumn("_slice", F.spark_partition_id())
        .repartitionByRange(*keys, "_slice")
        .sortWithinPartitions(*keys)
        .drop("_slice")
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
    return written


def guard_write(
    spark: SparkSession, path: str, schema: T.StructType, counted: int, written: int
) -> None:
    """Raise unless rows counted = rows written = rows in the files."""
    stored = spark.read.schema(schema).parquet(path).count()
    if not counted == written == stored:
        raise WriteGuardError(f"{path}: counted {counted}, wrote {written}, files hold {stored}")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of every Parquet file under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def write_listing(hashes: DataFrame, table: str, path: str) -> dict:
    """Write the file listing of a table; returns its number of files and bytes."""
    totals = Observation()
    (
        hashes.select(F.lit(table).alias("table_name"), "*")
        .observe(totals, F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .write.mode("overwrite")
        .json(path)
    )
    return totals.get


def listing_digest(spark: SparkSession, path: str) -> str:
    """One hash of a table: of its files' hashes in order, one to a line."""
    hashes = spark.read.schema("sha256 STRING").json(path)
    joined = F.array_join(F.array_sort(F.collect_list("sha256")), "\n")
    return hashes.agg(F.sha2(joined, 256).alias("digest")).first()["digest"]


def profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: fingerprints and content digest of the cleaned table, NaN counts of the raw
    one and the mean bytes of a row's texts, from a single scan."""
    names = resolve(df, spec.schema)
    flags = {f"_nan_{c}": is_nan(df, names[c]) for c in spec.decimals}
    wide = df.select(*clean_columns(df, spec.schema), *[c.alias(f) for f, c in flags.items()])
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in spec.schema if isinstance(f.dataType, T.StringType)]
    width = F.avg(reduce(add, texts, F.lit(0))).alias("_text_bytes")
    nans = [F.count_if(f).alias(f) for f in flags]
    figures = wide.agg(*metric_columns(spec.fingerprints), *nans, width, *digest_parts(spec.schema))
    return figures.select(*spec.fingerprints, *flags, "_text_bytes", digest_hex().alias("_content"))


def export_table(df: DataFrame, spec: TableSpec, out_dir: str) -> Row:
    """Export one table to ``<name>.parquet`` and return its manifest entry.

    Only the profile (one row of figures) and the file totals reach the driver.
    """
    spark, file = df.sparkSession, f"{spec.name}.parquet"
    path = f"{out_dir}/{file}"
    metrics = list(spec.fingerprints)
    nans = [f"_nan_{c}" for c in spec.decimals]
    before = (
        profile(df, spec)
        .select(*[plain_number(m).alias(m) for m in metrics], *nans, "_text_bytes", "_content")
        .first()
    )
    rows = int(before["row_count"])
    width = 16 * len(spec.schema) + (before["_text_bytes"] or 0)
    most = max(1, min(ROWS_PER_FILE, int(BYTES_PER_FILE / width)))
    written = write_ordered(clean_decimals(df, spec.schema), path, spec.key, most)
    guard_write(spark, path, spec.schema, rows, int(written.get["rows"]))
    listing = f"{out_dir}/manifest_files/{spec.name}"
    totals = write_listing(file_hashes(spark, path), spec.name, listing)
    return Row(
        rows=rows,
        file=file,
        bytes=totals["bytes"] or 0,
        sha256=listing_digest(spark, listing),
        nan_to_null={c: before[f"_nan_{c}"] for c in spec.decimals if before[f"_nan_{c}"]},
        fingerprints={m: before[m] for m in metrics if m != "row_count"},
        files=totals["files"],
        content=before["_content"],
    )


def snapshot(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """A copy of every source, each read once: an export reads its input several times.
    The tables are copied side by side; ``pinned_snapshot`` refuses sources that
    change while they are copied."""
    return dict(zip(tables, together(partial(keep, df) for df in tables.values())))


def listing(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """source, path, length, modified of every file of the sources; contents are not read."""
    parts = []
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        columns = ("path", "length", F.col("modificationTime").alias("modified"))
        parts.append(files.select(F.lit(name).alias("source"), *columns))
    return reduce(DataFrame.unionAll, parts)


def pinned_snapshot(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Copies of Parquet sources (name to path) as they were at one moment.

    The files of all sources (path, length, time of modification) are listed before the
    first copy and again after the last. As nothing changed between the two listings, all
    copies show the moment of the first; if a file was added, removed or rewritten
    meanwhile, in whichever source, all copies are deleted and the snapshot is refused.
    """
    pinned = keep(listing(spark, paths))
    copies: dict[str, str] = {name: new_folder(spark) for name in paths}

    def copy(name: str) -> DataFrame:
        source = spark.read.parquet(paths[name])
        source.write.parquet(copies[name])
        return spark.read.schema(source.schema).parquet(copies[name])

    def changes() -> list[str]:
        now = keep(listing(spark, paths))
        differing = pinned.exceptAll(now).unionAll(now.exceptAll(pinned))
        return [f"{r.source}: {r.path}" for r in differing.select("source", "path").distinct().orderBy("source", "path").limit(5).collect()]

    changed: list[str] = []
    try:
        out = dict(zip(paths, together(partial(copy, name) for name in paths)))
        changed = changes()
    except Exception as e:
        # a file that went while it was read is a change as well
        changed = changes()
        if not changed:
            raise
        raise SourceChangedError(f"changed during the snapshot: {changed}") from e
    finally:
        if changed:
            for folder in copies.values():
                drop_folder(spark, folder)
    if changed:
        raise SourceChangedError(f"changed during the snapshot: {changed}")
    return out


def export_all(
    tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], out_dir: str, at: datetime
) -> DataFrame:
    """Export every table and write ``manifest.json``; returns its entries.

    All reads of an input must see the same rows: pass Parquet that does not change,
    or a ``snapshot`` of anything else.
    """
    spark = next(iter(tables.values())).sparkSession
    entries = together(partial(export_table, tables[name], spec, out_dir) for name, spec in specs.items())
    document = (at.isoformat(timespec="seconds"), dict(zip(specs, entries)))
    spark.createDataFrame([document], MANIFEST).coalesce(1).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(f"{out_dir}/manifest.json")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, export_dir: str) -> DataFrame:
    """One row per table of ``manifest.json``, a file or a folder."""
    document = spark.read.schema(MANIFEST).option("multiLine", True).json(f"{export_dir}/manifest.json")
    return document.select("exported_at_utc", F.explode("tables").alias("table_name", "t")).select(
        "exported_at_utc", "table_name", "t.*"
    )


def manifest_fingerprints(manifest: DataFrame) -> DataFrame:
    """The manifest's expectations in the long form of ``fingerprint``."""
    counts = manifest.select(
        "table_name", F.lit("row_count").alias("metric"), F.col("rows").cast(VALUE).alias("value")
    )
    metrics = manifest.select("table_name", F.explode("fingerprints").alias("metric", "value"))
    return counts.unionByName(metrics.withColumn("value", F.col("value").cast(VALUE)))


def manifest_contents(manifest: DataFrame) -> DataFrame:
    """The content digests of the manifest in the same form; a manifest from elsewhere may
    have none."""
    metrics = [F.struct(F.lit(m).alias("metric"), c.alias("value")) for m, c in content_metrics(F.col("content")).items()]
    return manifest.where("content is not null").select("table_name", F.inline(F.array(*metrics)))
