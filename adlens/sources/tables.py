"""Reading and writing impression tables."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlens.operators.normalize import normalise_log
from adlens.operators.sampling import random_sample
from adlens.schemas import RAW_LOG

LARGE_TABLE = 1_000_000


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet by suffix, otherwise CSV with a header.

    Without a schema a CSV column type is inferred by an extra pass; name one for large files.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return _read_csv(spark, path, schema)


def _read_csv(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_table_auto(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Choose the format by the path's suffix, or by the names of all files inside it; a mix is an error."""
    names = [path.rstrip("/")]
    if not names[0].endswith((".parquet", ".csv", ".csv.gz", ".gz")):
        names = spark.read.text(path).inputFiles()  # the listing; nothing is read
    parquet = [".parquet" in n.rsplit("/", 1)[-1] for n in names]
    if any(parquet) and not all(parquet):
        raise ValueError(f"{path} holds parquet and other files: {names[parquet.index(False)]}")
    return spark.read.parquet(path) if any(parquet) else _read_csv(spark, path, schema)


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[str, str]:
    """The first line of every file by its path.

    Every file is a task of its own, which stops after the first rows it gets.
    """
    conf, name = spark.conf, "spark.sql.files.openCostInBytes"
    before = conf.get(name, None)
    conf.set(name, str(1 << 62))  # so that no task gets a second file

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                if batch.column("start")[0].as_py() == 0:
                    yield batch.slice(0, 1)
                return

    try:
        lines = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
        )
        # Size bound: one row per file, as the listing of files that the driver has anyway.
        rows = lines.mapInArrow(first_line, "file string, start long, line string").collect()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)
    return {unquote(r["file"]): r["line"].removeprefix("\ufeff") for r in rows}


def read_raw_log(
    spark: SparkSession,
    path: str,
    n_rows: int | None = None,
    sample_frac: float | None = None,
    seed: int = 42,
    schema: StructType = RAW_LOG,
    partitions: int | None = None,
) -> DataFrame:
    """Gzip CSV log with a fixed schema.

    One gzip file is read by one task; `partitions` spreads its rows before further work. The sample is a seeded
    random one, not the first rows of the file. Files may have their columns in different orders, or have other
    columns: each group of files with one header is read by it, and the groups are put together by name, with nulls
    where a file has no such column. Files without a line have no rows.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(file_headers(spark, path).items()):
        groups.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    known = {f.name: f for f in schema.fields}
    parts = []
    for names, files in groups.items() or [(tuple(schema.names), [path])]:
        present = StructType([known[n] if n in known else StructType().add(n, "string").fields[0] for n in names])
        parts.append(spark.read.option("header", True).option("enforceSchema", False).schema(present).csv(files))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if n_rows:
        df = df.limit(n_rows)
    elif sample_frac:
        df = random_sample(df, sample_frac, seed)
    return df.repartition(partitions) if partitions else df


def load_and_prepare(spark: SparkSession, path: str, convert: bool = True, **options) -> DataFrame:
    df = read_raw_log(spark, path, **options)
    return normalise_log(df) if convert else df


def write_features(df: DataFrame, path: str) -> None:
    """Parquet or CSV by suffix, replacing what is there."""
    if path.rstrip("/").endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        _write_csv(df, path)


def write_table_sized(df: DataFrame, path: str, limit: int = LARGE_TABLE) -> str:
    """More than `limit` rows go to parquet, fewer to CSV; returns the path written.

    The decision reads only `limit` + 1 rows, not the table.
    """
    large = df.select(F.lit(1)).limit(limit + 1).count() > limit
    stem = path.rsplit(".", 1)[0] if "." in path.rsplit("/", 1)[-1] else path
    target = f"{stem}.parquet" if large else f"{stem}.csv"
    write_features(df, target)
    return target


def _write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Nested values become JSON text; times keep their microseconds."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    writer = flat.write.mode("overwrite").option("header", True)
    for option in ("timestampFormat", "timestampNTZFormat"):
        writer = writer.option(option, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    writer.csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small result table as one CSV file."""
    _write_csv(report.coalesce(1), path)
