"""Campaign facts and raw exports made from the star-schema tables.

Used by the registered queries, the benchmark and the tests; the library itself
does not depend on it. ``workloads/oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfacts.schema import CANONICAL_SCHEMA
from adfacts.session import shared_folder

PLATFORM_OF_FLAG = {"A": "google_ads", "N": "meta_ads", "R": "microsoft_ads"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _canonical(df: DataFrame) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in CANONICAL_SCHEMA])


def _campaign_id() -> Column:
    return F.substring(F.md5(F.concat_ws("::", "platform", "campaign_name").cast("binary")), 1, 16)


def _cents(value: Column) -> Column:
    """Money in whole hundredths, so that sums are exact in any order."""
    return F.round(value * 100).cast("bigint")


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts from ``events``: one row per day, platform and campaign."""

    def cents_of(kind: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("event_type") == kind, _cents(F.col("value")))), F.lit(0)
        )

    def count_of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    platform = (
        F.when(F.col("user_id") % 3 == 0, "google_ads")
        .when(F.col("user_id") % 3 == 1, "meta_ads")
        .otherwise("microsoft_ads")
    )
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.to_date("ts").alias("date"),
            platform.alias("platform"),
            F.concat(F.lit("Campaign "), (F.col("user_id") % 10).cast("string")).alias(
                "campaign_name"
            ),
        )
        .agg(
            (cents_of("error") / 100.0).alias("spend"),
            (cents_of("purchase") / 100.0).alias("sales"),
            count_of("signup").alias("conversions"),
            count_of("click").alias("clicks"),
            (count_of("view") * 100).alias("impressions"),
        )
    )
    return _canonical(
        daily.withColumn("campaign_id", _campaign_id()).withColumn(
            "revenue", F.when(F.col("platform") != "meta_ads", F.col("sales"))
        )
    )


def _platform_of_flag() -> Column:
    return F.coalesce(
        *[F.when(F.col("l_returnflag") == flag, F.lit(p)) for flag, p in PLATFORM_OF_FLAG.items()]
    )


def shipment_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts from ``lineitem``: one row per day, platform and campaign (100 each)."""
    price = F.round("l_extendedprice").cast("bigint")  # read as hundredths
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.to_date("l_shipdate").alias("date"),
            _platform_of_flag().alias("platform"),
            F.concat(F.lit("Campaign "), (F.col("l_partkey") % 100).cast("string")).alias(
                "campaign_name"
            ),
        )
        .agg(
            (F.sum(F.round(F.col("l_discount") * 100).cast("bigint") * 125) / 100.0).alias("spend"),
            (F.sum(price) / 100.0).alias("sales"),
            F.sum("l_linenumber").alias("conversions"),
            F.sum((F.col("l_orderkey") + F.col("l_linenumber")) % 5).alias("clicks"),
            (F.sum(F.col("l_quantity").cast("bigint") % 10) * 100).alias("impressions"),
        )
    )
    return _canonical(
        daily.withColumn("campaign_id", _campaign_id()).withColumn(
            "revenue", F.when(F.col("platform") != "meta_ads", F.col("sales"))
        )
    )


def skewed_shipment_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ``lineitem`` row, equal days and equal rows included.

    A third of all rows belong to one campaign of one platform.
    """
    hot = F.col("l_partkey") % 3 == 0
    rows = table(spark, sf_dir, "lineitem").select(
        F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
        .cast("timestamp_ntz")
        .alias("date"),
        F.when(hot, F.lit("google_ads")).otherwise(_platform_of_flag()).alias("platform"),
        F.when(hot, F.lit("Everything"))
        .otherwise(F.concat(F.lit("Campaign "), (F.col("l_partkey") % 100).cast("string")))
        .alias("campaign_name"),
        (F.round(F.col("l_discount") * 100).cast("bigint") * 125 / 100.0).alias("spend"),
        (F.round(F.col("l_extendedprice") / 1000).cast("bigint") / 100.0).alias("sales"),
        F.col("l_linenumber").alias("conversions"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 5).alias("clicks"),
        (F.col("l_quantity").cast("bigint") % 10 * 100).alias("impressions"),
    )
    return _canonical(
        rows.withColumn("campaign_id", _campaign_id()).withColumn(
            "revenue", F.when(F.col("platform") != "meta_ads", F.col("sales"))
        )
    )


def one_campaign_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ``lineitem`` row, all of one campaign; most rows equal thousands of others."""
    odd = F.col("l_linenumber") % 2
    rows = table(spark, sf_dir, "lineitem").select(
        F.date_trunc("year", F.col("l_shipdate").cast("timestamp"))
        .cast("timestamp_ntz")
        .alias("date"),
        F.lit("google_ads").alias("platform"),
        F.lit("Everything").alias("campaign_name"),
        F.lit(1.25).alias("spend"),
        (odd * 5).alias("revenue"),
        F.lit(2).alias("conversions"),
        (odd + 3).alias("clicks"),
        F.lit(100).alias("impressions"),
    )
    return _canonical(rows.withColumn("campaign_id", _campaign_id()))


def raw_exports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three platforms' export columns as text, one row per ``lineitem`` row.

    Dirt follows from the row's keys: unreadable numbers and dates, missing-value
    texts, negative amounts, blanks around names, commas in numbers.
    """
    line = table(spark, sf_dir, "lineitem").withColumn(
        "k", F.col("l_orderkey") * 7 + F.col("l_linenumber")
    )
    k = F.col("k")

    def dirty(value: Column, modulus: int, bad: str) -> Column:
        return F.when(k % modulus == 0, F.lit(bad)).otherwise(value)

    name = F.concat(F.lit("Campaign "), (F.col("l_partkey") % 100).cast("string"))
    name = (
        F.when(k % 53 == 0, F.lit("N/A"))
        .when(k % 11 == 0, F.concat(F.lit("  "), name, F.lit("\t")))
        .when(k % 19 == 0, F.concat(F.lit('The "big", '), name))
        .otherwise(name)
    )
    impressions = F.col("l_quantity").cast("bigint") * 1000
    clicks = (F.col("l_orderkey") + F.col("l_linenumber")) % 97
    spend_cents = F.round("l_extendedprice").cast("bigint")
    spend_cents = F.when(k % 23 == 0, -spend_cents).otherwise(spend_cents)
    revenue_cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    revenue_cents = (
        F.when(k % 13 == 0, F.lit(0)).when(k % 29 == 0, -revenue_cents).otherwise(revenue_cents)
    )
    conversions = F.concat(F.col("l_linenumber").cast("string"), F.lit(".5"))

    def money(cents: Column) -> Column:
        sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
        size = F.abs(cents)
        whole = (size - size % 100) / 100
        return F.concat(
            sign,
            whole.cast("bigint").cast("string"),
            F.lit("."),
            F.lpad((size % 100).cast("string"), 2, "0"),
        )

    def commas(cents: Column) -> Column:
        return F.format_number((cents / 100).cast("decimal(20,2)"), 2)

    iso = F.date_format("l_shipdate", "yyyy-MM-dd")
    google = line.where("l_returnflag = 'A'").select(
        dirty(iso, 17, "not a date").alias("segments_date"),
        name.alias("campaign_name"),
        dirty(impressions.cast("string"), 31, "bad").alias("metrics_impressions"),
        dirty(clicks.cast("string"), 37, "").alias("metrics_clicks"),
        dirty((spend_cents * 10_000).cast("string"), 41, "12d").alias("metrics_cost_micros"),
        dirty(conversions, 43, "NaN").alias("metrics_conversions"),
        dirty(money(revenue_cents), 47, "NA").alias("metrics_conversions_value"),
    )
    meta = line.where("l_returnflag = 'N'").select(
        dirty(F.date_format("l_shipdate", "d-MMM-yyyy"), 17, "2024-02-30").alias("date_start"),
        F.when(k % 59 == 0, F.lit("2001-01-01"))
        .otherwise(dirty(F.date_format("l_shipdate", "d-MMM-yyyy"), 17, "2024-02-30"))
        .alias("date_stop"),
        name.alias("campaign_name"),
        dirty(impressions.cast("string"), 31, "1,600").alias("impressions"),
        dirty(F.concat(clicks.cast("string"), F.lit(".9")), 37, "null").alias("clicks"),
        dirty(money(spend_cents), 41, "<NA>").alias("spend"),
        dirty(conversions, 43, "1e1").alias("conversion"),
        F.lit("0.01").alias("ctr"),
        F.lit("0.5").alias("cpc"),
        F.lit("5.0").alias("cpm"),
    )
    microsoft = line.where("l_returnflag = 'R'").select(
        dirty(F.date_format("l_shipdate", "M/d/yyyy"), 17, "10:30").alias("TimePeriod"),
        name.alias("CampaignName"),
        dirty(F.format_number(impressions, 0), 31, "0x1A").alias("Impressions"),
        dirty(clicks.cast("string"), 37, "-5").alias("Clicks"),
        dirty(commas(spend_cents), 41, "inf").alias("Spend"),
        dirty(conversions, 43, "#N/A").alias("Conversions"),
        dirty(commas(revenue_cents), 47, "n/a").alias("Revenue"),
    )
    return {"google_ads": google, "meta_ads": meta, "microsoft_ads": microsoft}


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship days as ``date_text``, in further shapes that exports use, one row per ``lineitem`` row."""
    shapes = [
        "yyyy-MM-dd'T10:00:00Z'", "yyyy-MM-dd'T00:30:00+02:00'", "MMM d yyyy", "yyyy-MMM-dd",
        "yyyy-MM-dd'T10'", "MMMM d, yyyy", "M/d/yyyy '1:05 PM'", "yyyy-MM-dd '23:59:59 UTC'",
        "E, dd MMM yyyy", "yyyy.MM.dd", "yyyyMMdd", "yyyy-MM-dd'T04:00:00.250-0530'",
    ]
    line = table(spark, sf_dir, "lineitem")
    which = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % len(shapes)
    text = F.lit(None).cast("string")
    for number, shape in enumerate(shapes):
        text = F.when(which == number, F.date_format("l_shipdate", shape)).otherwise(text)
    return line.select(text.alias("date_text"))


_written: dict[tuple[str, str], dict[str, str]] = {}


def export_paths(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """CSV folders holding ``raw_exports``, written once per session to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        root = f"{shared_folder(spark)}/exports-{uuid.uuid4().hex}"
        paths = {}
        for platform, raw in raw_exports(spark, sf_dir).items():
            paths[platform] = f"{root}/{platform}"
            # blanks are part of the text; a quote inside quotes is doubled
            raw.write.option("header", True).option("escape", '"').option(
                "ignoreLeadingWhiteSpace", False
            ).option("ignoreTrailingWhiteSpace", False).csv(paths[platform])
        _written[key] = paths
    return _written[key]


def dirty_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed canonical rows that break the validation rules, one per ``lineitem`` row."""
    line = table(spark, sf_dir, "lineitem").withColumn(
        "k", F.col("l_orderkey") * 7 + F.col("l_linenumber")
    )
    k = F.col("k")

    def lost(value: Column, modulus: int) -> Column:
        return F.when(k % modulus != 0, value)

    def turned(value: Column, modulus: int) -> Column:
        return F.when(k % modulus == 0, -value).otherwise(value)

    rows = line.select(
        lost(F.to_date("l_shipdate"), 17).alias("date"),
        _platform_of_flag().alias("platform"),
        F.concat(F.lit("Campaign "), (F.col("l_partkey") % 100).cast("string")).alias("name"),
        lost(turned(F.round("l_extendedprice").cast("bigint"), 23) / 100.0, 19).alias("spend"),
        lost(F.round("l_extendedprice").cast("bigint") / 10.0, 13).alias("revenue"),
        lost(turned(F.col("l_linenumber") + 0.5, 29), 31).alias("conversions"),
        lost(turned(F.col("l_orderkey") % 97, 37), 41).alias("clicks"),
        lost(turned(F.col("l_quantity").cast("bigint") * 100, 43), 47).alias("impressions"),
        (k % 53 == 0).alias("unnamed"),
    )
    named = rows.withColumn("campaign_name", F.col("name")).withColumn(
        "campaign_id", _campaign_id()
    )
    return _canonical(
        named.withColumn("campaign_name", F.when(~F.col("unnamed"), F.col("name")))
    )
