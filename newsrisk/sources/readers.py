"""Scans: raw tables, extract CSVs, the clean table, curated read-backs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DateLike = str | _dt.date | None

# Column layout of a daily extract CSV (all text on read; the clean step coerces).
EXTRACT_COLUMNS = [
    "SQLDATE",
    "CountryCode",
    "EventRootCode",
    "EventCount",
    "AvgTone",
    "AvgGoldstein",
    "TotalMentions",
    "TotalArticles",
    "TotalSources",
]
EXTRACT_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in EXTRACT_COLUMNS])

# The preview's columns in the published order.
PREVIEW_COLUMNS = [
    "SQLDATE",
    "Actor1CountryCode",
    "Actor2CountryCode",
    "EventCode",
    "EventRootCode",
    "GoldsteinScale",
    "NumMentions",
    "NumSources",
    "NumArticles",
    "AvgTone",
]


def _date_lit(d: DateLike):
    return F.lit(str(d)).cast("date")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A ``dt=YYYY-MM-DD``-partitioned Parquet dataset; ``dt`` filters prune directories."""
    return spark.read.option("basePath", path).parquet(path)


def scan_window(raw: DataFrame, start: DateLike = None, end: DateLike = None, col: str = "dt") -> DataFrame:
    """Half-open partition window ``start <= dt < end`` with constant bounds.

    Constant date literals on the partition column become ``PartitionFilters``
    (whole directories are skipped) and ``PushedFilters`` on plain columns.
    Either bound may be ``None`` (open).
    """
    if start is not None:
        raw = raw.where(F.col(col) >= _date_lit(start))
    if end is not None:
        raw = raw.where(F.col(col) < _date_lit(end))
    return raw


def sample_preview(raw: DataFrame, start: DateLike = None, end: DateLike = None, n: int = 10) -> DataFrame:
    """Smoke preview: ten projected columns of one window, ``n`` rows.

    Rows are taken in event-id order so the preview is repeatable
    (a TakeOrderedAndProject: each task keeps its own top ``n``).
    """
    w = scan_window(raw, start, end)
    return w.orderBy("GLOBALEVENTID").select(*PREVIEW_COLUMNS).limit(n)


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for HDFS/object stores)."""
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def latest_extract(spark: SparkSession, directory: str, by: str = "name", pattern: str = "events_daily_*.csv") -> str:
    """Newest extract under ``directory``: greatest name (default) or latest mtime.

    Extract names carry their window, so "by name" is deterministic; "mtime"
    picks the most recently written one. Only file-system metadata is read.
    """
    fs, p = _fs_and_path(spark, directory.rstrip("/") + "/" + pattern)
    statuses = fs.globStatus(p) or []
    found = [(s.getPath().toString(), s.getPath().getName(), s.getModificationTime()) for s in statuses]
    if not found:
        raise FileNotFoundError(f"{directory} holds no file named like {pattern}")
    if by == "name":
        return max(found, key=lambda x: x[1])[0]
    if by == "mtime":
        return max(found, key=lambda x: (x[2], x[1]))[0]
    raise ValueError("by must be 'name' or 'mtime'")


def read_extract_csv(spark: SparkSession, path: str) -> DataFrame:
    """Extract CSV with a fixed all-text schema (codes keep leading zeros; no inference pass).

    A line with too few fields has nulls for the rest; one with too many has no telling which are right and is left
    out. ``faulty_lines`` has both kinds.
    """
    return _extract_lines(spark, path).where(~(_is_faulty() & _too_many_fields())).drop(FAULTY_LINE)


FAULTY_LINE = "_line"


def _extract_lines(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*EXTRACT_CSV_SCHEMA.fields, T.StructField(FAULTY_LINE, T.StringType(), True)])
    # without pruning: a line's fields are counted whatever columns a query asks for
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": FAULTY_LINE, "columnPruning": False}
    return spark.read.options(**options).schema(schema).csv(path)


def _is_faulty():
    """Whether a line was kept as faulty. Spark refuses to read that column alone, so another one takes part: it adds to its length."""
    date = F.coalesce("SQLDATE", F.lit(""))
    return F.length(F.concat(date, F.coalesce(F.col(FAULTY_LINE), F.lit("")))) > F.length(date)


def _too_many_fields():
    """Whether a faulty line has more fields than columns (commas between quotes do not count)."""
    plain = F.regexp_replace(FAULTY_LINE, '"[^"]*"', "")
    return F.coalesce(F.size(F.split(plain, ",")) > len(EXTRACT_COLUMNS), F.lit(False))


def faulty_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, kept) of an extract's lines that have not as many fields as the extract has columns."""
    found = _extract_lines(spark, path).where(_is_faulty())
    return found.select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]*$", 1).alias("file"), F.col(FAULTY_LINE).alias("line"), (~_too_many_fields()).alias("kept"))


def read_clean(spark: SparkSession, directory: str) -> DataFrame:
    """Clean table: Parquet if present, else the gzipped CSV copy, else an error."""
    base = directory.rstrip("/")
    pq, gz = f"{base}/events_daily_clean.parquet", f"{base}/events_daily_clean.csv.gz"
    if path_exists(spark, pq):
        return spark.read.parquet(pq)
    if path_exists(spark, gz):
        from newsrisk.operators.clean import CLEAN_CSV_SCHEMA, retype_clean

        return retype_clean(spark.read.option("header", True).schema(CLEAN_CSV_SCHEMA).csv(gz))
    raise FileNotFoundError(f"{directory} holds neither {pq} nor {gz}")


def risk_series(risk: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Read-back of the curated risk table: projection, non-null keys, (CountryCode, date) order."""
    cols = columns or ["date", "CountryCode", "risk_raw"]
    return (
        risk.where(F.col("date").isNotNull() & F.col("CountryCode").isNotNull())
        .select(*cols)
        .orderBy("CountryCode", "date")
    )
