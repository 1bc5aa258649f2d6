"""URL handling on the pages table: cut at a marker, host and UTM parameters,
and a distinct-then-enrich dimension (classify each host once, join back)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.rules import regex_ladder
from martforge.functions.urls import split_at, strip_query, url_host, url_param
from martforge.sources.io import read_table

# Host patterns -> site kind, in rule order.
SITE_RULES = [("^blog\\.", "Blog"), ("^m\\.", "Mobile"), ("\\.org$", "Organisation")]


def _pages(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "pages", ["page_id", "url"])


def url_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url -> (text before 'utm_source=', text after it); missing part NULL."""
    before, after = split_at("url", "utm_source=")
    return _pages(spark, sf_dir).select("page_id", before.alias("url"), after.alias("utm_tail"))


def url_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(
        "page_id", url_host("url").alias("host"),
        url_param("url", "utm_source").alias("utm_source"),
        url_param("url", "utm_medium").alias("utm_medium"),
        url_param("url", "utm_campaign").alias("utm_campaign"),
        strip_query("url").alias("first_page"))


def distinct_dim_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify each distinct host once, then join the small dimension back."""
    pages = _pages(spark, sf_dir).withColumn("host", url_host("url"))
    dim = pages.select("host").distinct().withColumn("site_kind", regex_ladder("host", SITE_RULES, default="Web"))
    return pages.join(dim, "host", "left").select("page_id", "host", "site_kind")
