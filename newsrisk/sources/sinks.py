"""Sinks: extract CSV, Parquet tables, full-replace publishes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.session import checkpoint_dir
from newsrisk.sources.readers import DateLike


def extract_path(out_dir: str, start: DateLike, end: DateLike) -> str:
    """``<out_dir>/events_daily_<start>_<end>.csv`` (window in the name, dashes dropped)."""
    s, e = str(start).replace("-", ""), str(end).replace("-", "")
    return f"{out_dir.rstrip('/')}/events_daily_{s}_{e}.csv"


def write_extract_csv(extract: DataFrame, out_dir: str, start: DateLike, end: DateLike) -> str:
    """Write an extract as a header CSV directory named after its window; returns the path."""
    path = extract_path(out_dir, start, end)
    extract.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_clean_csv_gz(clean: DataFrame, directory: str) -> str:
    """The gzipped CSV copy of the clean table, which ``readers.read_clean`` falls back to."""
    path = f"{directory.rstrip('/')}/events_daily_clean.csv.gz"
    clean.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
    return path


def write_days(df: DataFrame, path: str, day: str = "date") -> str:
    """Replace only the days that ``df`` holds of a table that is partitioned by ``day``."""
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return path


def _swap_in(spark, staging: str, target: str) -> None:
    """Move the fully written ``staging`` folder to ``target``; the old table comes back if that fails."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    src, dst, old = path(staging), path(target), path(staging + "_old")
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(dst)
    if had and not fs.rename(dst, old):
        raise OSError(f"could not set {target} aside")
    try:
        moved = _rename(fs, src, dst)
    except Exception:
        moved = False
    if not moved:
        if had:
            fs.rename(old, dst)
        raise OSError(f"could not move {staging} to {target}; the old table is in place")
    if had:
        fs.delete(old, True)


def _rename(fs, src, dst) -> bool:
    return bool(fs.rename(src, dst))


def publish(
    df: DataFrame,
    target: str,
    drop_null: str | None = None,
    partition_by: list[str] | None = None,
) -> str:
    """Full replace of a published table.

    ``target`` is a path (contains ``/``) or a catalog table name
    (``saveAsTable``). ``drop_null`` names a column whose null rows are dropped
    first (the clean table is published without undated rows). The rows are
    written to a staging folder first, so a failed job leaves the old table in
    place and a DataFrame may be derived from the table it replaces. A path is
    then replaced by two renames; between them the old table stands beside the
    target, and comes back if the second one fails. A reader that must not see
    that instant reads through a catalog table.

    An unpartitioned catalog table lives in a folder of its own per publish: the new version is written
    in full, then the table's location is changed, so a reader sees the old or the new version, never
    none and never a part. The version before stays for readers that began with it; older ones go.
    """
    if drop_null:
        df = df.where(F.col(drop_null).isNotNull())
    if "/" in target:
        staging = f"{target.rstrip('/')}._staging_{uuid.uuid4().hex[:12]}"
        write_parquet(df, staging, partition_by)
        _swap_in(df.sparkSession, staging, target)
        return target
    spark = df.sparkSession
    if not partition_by:
        return _publish_version(df, target)
    staging = f"{checkpoint_dir(spark).rstrip('/')}/publish-{uuid.uuid4().hex[:12]}"
    write_parquet(df, staging)
    w = spark.read.schema(df.schema).parquet(staging).write.mode("overwrite").format("parquet")
    w.partitionBy(*partition_by).saveAsTable(target)
    remove(spark, staging)
    return target


def _publish_version(df: DataFrame, table: str) -> str:
    """Write a new version folder and point the catalog table at it."""
    spark = df.sparkSession
    base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions/{table}"
    versions = table_versions(spark, table)
    number = int(versions[-1].rsplit("/v", 1)[1]) + 1 if versions else 1
    path = f"{base}/v{number:09d}"
    write_parquet(df, path)
    if spark.catalog.tableExists(table) and spark.table(table).schema == spark.read.parquet(path).schema and _location(spark, table).find("/versions/") >= 0:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:  # the first publish, or other columns: the table is described anew
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    for old in versions[:-1]:
        remove(spark, old)
    return table


def _location(spark, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def table_versions(spark, table: str) -> list[str]:
    """The folders of a published catalog table's versions that are written in full, oldest first."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions/{table}/v*/_SUCCESS")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    return sorted(f.getPath().getParent().toString() for f in found)


def remove(spark, path: str) -> None:
    """Delete a scratch folder through the Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_top_csv(df: DataFrame, path: str, k: int = 50) -> str:
    """Ranked report (e.g. the top-50 anomalies): the first ``k`` rows as one CSV file with header."""
    df.limit(k).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
