"""Theme-day roll-up of article themes (top-k themes only)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsrisk.functions.scalars import first_csv_double
from newsrisk.session import broadcast_list, materialize
from newsrisk.sources.readers import DateLike, scan_window


class ArticleFields(NamedTuple):
    """The columns that hold an article's themes and tone."""

    themes: str = "V2Themes"
    tone: str = "V2Tone"


#: The older layout of the article table.
PLAIN_FIELDS = ArticleFields("Themes", "Tone")


def article_fields(articles: DataFrame) -> ArticleFields:
    """The current column where the table has it, else the older one (Spark reports a column that is missing)."""
    return ArticleFields(*(new if new in articles.columns else old for new, old in zip(ArticleFields(), PLAIN_FIELDS)))


def exploded_themes(
    articles: DataFrame, start: DateLike = None, end: DateLike = None, strip_offsets: bool = False, fields: ArticleFields | None = None,
) -> DataFrame:
    """One row per (article, theme item): ``split(';')`` + ``explode``, empty items dropped.

    ``strip_offsets=True`` cuts a ``,offset`` suffix from each item.
    """
    themes, tone = fields or article_fields(articles)
    base = scan_window(articles, start, end).where(F.col(themes).isNotNull())
    # parse the tone once per article, before the explode multiplies the rows
    per_article = base.select(F.col("dt").alias("date"), F.col(themes).alias("_themes"), first_csv_double(tone).alias("Tone"))
    items = per_article.select("date", F.explode(F.split("_themes", ";")).alias("theme"), "Tone")
    if strip_offsets:
        items = items.withColumn("theme", F.substring_index("theme", ",", 1))
    return items.where(F.col("theme").isNotNull() & (F.col("theme") != ""))


def theme_daily(
    articles: DataFrame,
    start: DateLike = None,
    end: DateLike = None,
    top_k: int = 200,
    strip_offsets: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """(date, theme) ArticleCount and AvgTone for the top-k themes.

    ``ArticleCount`` counts theme mentions. One pass counts by theme alone and
    keeps the top ``top_k`` (a list of that many rows); a second pass over the
    pruned scan drops every other theme before the day aggregate, whose shuffle
    then carries at most ``top_k`` x days partial rows per task.
    """
    items = exploded_themes(articles, start, end, strip_offsets)
    top = top_themes_of_articles(articles, start, end, top_k, strip_offsets).select("theme")
    out = (
        items.join(broadcast_list(top, top_k), "theme", "left_semi")
        .groupBy("date", "theme")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("ArticleCount"),
            F.try_divide(F.sum("Tone"), F.count("Tone").cast("double")).alias("AvgTone"),
        )
    )
    return out.orderBy("date", "theme") if ordered else out


def theme_counts(articles: DataFrame, start: DateLike = None, end: DateLike = None, strip_offsets: bool = False) -> DataFrame:
    """Mentions per theme over the window (all themes)."""
    return (
        exploded_themes(articles, start, end, strip_offsets)
        .groupBy("theme")
        .agg(F.count(F.lit(1)).cast("bigint").alias("mentions"))
    )


#: Themes are told apart in so many hash buckets; of every SAMPLE_STEP-th article (by hash) the themes are counted first.
BUCKETS = 1 << 16
SAMPLE_STEP = 64
LIKELY_PER_K = 4


def top_themes_of_articles(
    articles: DataFrame, start: DateLike = None, end: DateLike = None, k: int = 200, strip_offsets: bool = False
) -> DataFrame:
    """The top-k theme list (exact, ties by name) without a shuffle of all distinct themes.

    1. Likely themes: the ``LIKELY_PER_K * k`` most frequent of a hash sample of the articles.
    2. One pass counts the likely themes, and all others together per hash bucket: at most
       ``BUCKETS`` + likely groups leave a task. A bucket's count is a bound on each of its themes.
    3. The k-th largest count of the likely themes is a floor: a theme in a bucket below it cannot be among the top k. If
       no bucket reaches the floor the likely themes hold the answer; else the themes of the buckets that do are
       counted as well. How good the sample was decides only how many these are.
    """
    themes = article_fields(articles).themes
    sampled = articles.where(F.pmod(F.xxhash64(themes), F.lit(SAMPLE_STEP)) == 0)
    most = [F.col("mentions").desc(), F.col("theme")]
    likely = theme_counts(sampled, start, end, strip_offsets).orderBy(*most).limit(LIKELY_PER_K * k).select("theme")
    likely = F.broadcast(materialize(likely).withColumn("likely", F.lit(True)))  # a few names per k
    bucket = F.xxhash64("theme").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    items = exploded_themes(articles, start, end, strip_offsets).select("theme", bucket.alias("bucket")).join(likely, "theme", "left")
    grouped = items.groupBy(F.when(F.col("likely"), F.col("theme")).alias("theme"), F.when(F.col("likely").isNull(), F.col("bucket")).alias("bucket"))
    counts = materialize(grouped.agg(F.count(F.lit(1)).cast("bigint").alias("mentions")))
    known = counts.where(F.col("theme").isNotNull()).select("theme", "mentions")
    floor, found = known.orderBy(*most).limit(k).agg(F.min("mentions"), F.count(F.lit(1))).first()
    open_ = counts.where(F.col("theme").isNull() & (F.col("mentions") >= (floor if found == k else 0))).select("bucket")
    if not open_.isEmpty():
        rest = items.where(F.col("likely").isNull()).join(F.broadcast(open_), "bucket", "left_semi")  # at most BUCKETS numbers
        known = known.unionByName(rest.groupBy("theme").agg(F.count(F.lit(1)).cast("bigint").alias("mentions")))
    return known.orderBy(*most).limit(k)
