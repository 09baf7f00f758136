"""Clean/label step: typed, labelled, fixed-layout daily events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsrisk.functions.codes import normalize_root_code, root_label
from newsrisk.functions.scalars import parse_yyyymmdd, to_bigint, to_double, tone_bucket

INT_COLUMNS = ["EventCount", "TotalMentions", "TotalArticles", "TotalSources"]
FLOAT_COLUMNS = ["AvgTone", "AvgGoldstein"]

# The published column order of the clean table.
CLEAN_COLUMNS = [
    "SQLDATE",
    "CountryCode",
    "EventRootCode",
    "EventCount",
    "AvgTone",
    "AvgGoldstein",
    "TotalMentions",
    "TotalArticles",
    "TotalSources",
    "date",
    "EventRootLabel",
    "ToneBucket",
]
CLEAN_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CLEAN_COLUMNS])


def coerce_numeric(df: DataFrame, int_columns=INT_COLUMNS, float_columns=FLOAT_COLUMNS) -> DataFrame:
    """Coercing numeric parse of the columns that are present; bad values -> null."""
    cols = set(df.columns)
    out = {c: to_bigint(c) for c in int_columns if c in cols}
    out.update({c: to_double(c) for c in float_columns if c in cols})
    return df.withColumns(out) if out else df


def clean_events(extract: DataFrame) -> DataFrame:
    """Extract (typed or all-text) -> ``events_daily_clean``.

    Codes are stripped and zero-padded to two characters, SQLDATE becomes text
    and a strict ``date``, numerics are coerced, and each row gets its root
    label and tone bucket. Rows with bad dates are kept (``date`` null); the
    publish step drops them. Narrow transformations only: no shuffle.
    """
    df = extract.withColumns(
        {
            "CountryCode": F.col("CountryCode").cast("string"),
            "EventRootCode": normalize_root_code("EventRootCode"),
            "SQLDATE": F.col("SQLDATE").cast("string"),
        }
    )
    df = coerce_numeric(df).withColumn("date", parse_yyyymmdd("SQLDATE"))
    df = df.withColumns(
        {"EventRootLabel": root_label("EventRootCode"), "ToneBucket": tone_bucket("AvgTone")}
    )
    return df.select(*CLEAN_COLUMNS)


def retype_clean(df: DataFrame) -> DataFrame:
    """Re-type a clean table read back from text (CSV fallback); bad dates become null."""
    return coerce_numeric(df).withColumn("date", F.col("date").try_cast("date"))


def drop_null_dates(df: DataFrame, col: str = "date") -> DataFrame:
    return df.where(F.col(col).isNotNull())
