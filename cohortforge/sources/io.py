"""Table readers and sinks.

Sources arrive as text (CSV read without schema inference) and are typed by
an explicit projection; Parquet is the format inside the engine. gzip CSV is
not splittable, so text sources are converted once to Parquet and every later
job reads the Parquet copy.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.functions import hash_bin, tolerant_double, tolerant_timestamp
from cohortforge.session import materialize, shuffles_end_with_jobs

@dataclass(frozen=True)
class TableSpec:
    """Typed projection of a text table: column -> kind (string, double,
    double_strict, timestamp, timestamp_strict, long)."""
    name: str
    columns: Mapping[str, str] = field(default_factory=dict)


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_csv_text(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
                  lower: bool = True) -> DataFrame:
    """Every column as text; header-derived names, lower-cased."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))
    return lower_headers(df) if lower else df


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of a folder's files and sub-folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def read_table_folder(spark: SparkSession, folder: str, names: Iterable[str] | None = None,
                      skip: Iterable[str] = ("icloud",)) -> dict[str, DataFrame]:
    """Each ``NAME.csv`` / ``NAME.csv.gz`` of a folder as a text table keyed by
    lower-case name (dictionary registry instead of module globals). The folder
    is listed by Spark's file system, so it may be on any store Spark reads."""
    out: dict[str, DataFrame] = {}
    wanted = {n.lower() for n in names} if names else None
    for fname in _names(spark, folder):
        low = fname.lower()
        if not (low.endswith(".csv") or low.endswith(".csv.gz")) or any(s in low for s in skip):
            continue
        table = low[:-7] if low.endswith(".csv.gz") else low[:-4]
        if wanted is not None and table not in wanted:
            continue
        out[table] = read_csv_text(spark, f"{folder.rstrip('/')}/{fname}")
    return out


def write_text_folder(tables: Mapping[str, DataFrame], folder: str, rows_per_file: int = 250_000) -> None:
    """Each table as gzip CSV ``NAME.csv.gz`` with upper-case headers. A gzip file is read
    by one task, so none holds more than ``rows_per_file`` rows."""
    for name, df in tables.items():
        upper = df.select(*[F.col(c).cast("string").alias(c.upper()) for c in df.columns])
        with shuffles_end_with_jobs(df.sparkSession):
            (upper.write.option("header", True).option("compression", "gzip").option("encoding", "ISO-8859-1")
             .option("maxRecordsPerFile", rows_per_file).csv(f"{folder.rstrip('/')}/{name.upper()}.csv.gz"))


def parquet_copies(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as they are, from Parquet: text is unpacked and parsed once, however
    many features read it, and later reads split the files and skip columns."""
    return {name: materialize(df, f"text-{name}") for name, df in tables.items()}


def apply_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project text columns to their declared types. Tolerant kinds turn bad
    text into null; strict kinds raise under ANSI mode."""
    exprs = []
    for c in df.columns:
        kind = spec.columns.get(c, "string")
        col = F.col(c)
        if kind == "double":
            col = tolerant_double(col)
        elif kind == "double_strict":
            col = col.cast("double")
        elif kind == "long":
            col = col.try_cast("bigint")
        elif kind == "timestamp":
            col = tolerant_timestamp(col)
        elif kind == "timestamp_strict":
            col = F.to_timestamp(col).cast("timestamp_ntz")
        exprs.append(col.alias(c))
    return df.select(*exprs)


def read_features(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
                  key: str = "hadm_id", key_type: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Reload a saved feature or model table: chosen columns only (pruned at
    the scan) and the key in a given type."""
    df = spark.read.format(fmt).option("header", True).load(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    if columns is not None:
        cols = list(columns)
        df = df.select(*([key] if key not in cols else []), *cols)
    if key_type is not None:
        df = df.withColumn(key, F.col(key).cast(key_type))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Iterable[str] | None = None, measure: Mapping[str, Column] | None = None) -> dict:
    """Feature / model-set sink (Parquet by default, CSV with header).

    ``measure`` names aggregates over the table; they are taken from the written
    files, so only the columns they name are read again and nothing before the write
    runs twice. (``DataFrame.observe`` would take them on the way, but once a
    session has an Observation it can't be serialised any more, and MLlib's fitted
    models, which hold their session, then fail.) Returns the values, with ``rows``
    and ``columns`` among them; without ``measure`` an empty dict."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_end_with_jobs(df.sparkSession):
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.format(fmt).save(path)
    if measure is None:
        return {}
    back = df.sparkSession.read.schema(df.schema).option("header", True).format(fmt).load(path)
    row = back.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in measure.items()]).first()
    return {"columns": len(df.columns), **row.asDict()}


def write_report(spark: SparkSession, path: str, reports: Mapping[str, Mapping]) -> None:
    """Report sink: (report, metric, value) rows of what :func:`write_table` returned,
    as CSV. A few rows for each table that was written."""
    rows = [(name, metric, None if value is None else float(value)) for name, metrics in reports.items() for metric, value in metrics.items()]
    spark.createDataFrame(rows, "report string, metric string, value double").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("report string, metric string, value double").csv(path)


def with_hash_bin(df: DataFrame, key: str, bin_col: str = "bin_id", digits: int = 2) -> DataFrame:
    return df.withColumn(bin_col, hash_bin(F.col(key), digits))


def write_hash_bins(df: DataFrame, path: str, key: str, bin_col: str = "bin_id",
                    mode: str = "append", digits: int = 2) -> None:
    """Hash-partitioned, appendable sink: one folder per bin.

    Rows are rebalanced by bin before writing: AQE joins small bins into one
    task and splits large ones (a hot key inside them too) by their actual size,
    so the number of writers and files follows the data. Which task writes a
    row does not change what is written. Parquet carries the schema, so no
    header rows enter the data."""
    binned = with_hash_bin(df, key, bin_col, digits)
    binned.hint("rebalance", bin_col).write.mode(mode).partitionBy(bin_col).parquet(path)


def read_bins(spark: SparkSession, path: str, bins: Iterable[str] | None = None,
              bin_col: str = "bin_id") -> DataFrame:
    """Read the binned table; a bin list becomes a partition filter, so only
    those folders are listed and scanned."""
    from pyspark.sql.types import StringType, StructField, StructType
    inferred = spark.read.option("basePath", path).parquet(path).schema
    schema = StructType([StructField(f.name, StringType(), True) if f.name == bin_col else f for f in inferred.fields])
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if bins is not None:
        df = df.where(F.col(bin_col).isin(list(bins)))
    return df
