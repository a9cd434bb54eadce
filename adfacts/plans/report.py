"""Business report of a prediction table: text lines and a JSON summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfacts.operators.rollups import date_range_label
from adfacts.session import written

TOP_CAMPAIGNS = 5


def _money(value: Column, width: int = 0) -> Column:
    return _pad_left(F.format_number(value, 2), width)


def _pad_left(text: Column, width: int) -> Column:
    return F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(0), width - F.length(text))), text)


def _pad_right(text: Column, width: int) -> Column:
    """Unlike rpad this keeps a longer text whole."""
    return F.concat(text, F.repeat(F.lit(" "), F.greatest(F.lit(0), width - F.length(text))))


def campaign_rollup(df: DataFrame) -> DataFrame:
    """All a report needs, one row per platform and campaign name.

    Written to the shared folder, so that the report's many small figures read
    these few rows and the predictions are read once.
    """
    rollup = (
        df.groupBy("platform", "campaign_name")
        .agg(
            F.sum("prediction").alias("total_revenue"),
            F.count("prediction").alias("row_count"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
    )
    return written(rollup, "campaign-rollup")


def _figures() -> list[Column]:
    total, rows = F.sum("total_revenue"), F.sum("row_count")
    return [total.alias("total_revenue"), F.try_divide(total, rows).alias("mean_revenue")]


def _ranked(name: str, *values: str) -> Column:
    """All rows as one array, largest revenue first; ties go by name, missing revenue comes last."""
    revenue = F.col("total_revenue")
    entry = F.struct(
        revenue.isNull().alias("missing"), (-revenue).alias("rank"), F.col(name).alias("name"), *values
    )
    return F.array_sort(F.collect_list(entry))


def _overview(rollup: DataFrame) -> DataFrame:
    """One row of everything a report needs, from one aggregation per platform and one per campaign.

    ``platforms`` has an entry per platform, ``campaigns`` one per top campaign.
    """
    platforms = rollup.groupBy("platform").agg(
        *_figures(),
        F.sum("row_count").alias("rows"),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
    )
    total = F.sum("total_revenue")
    overall = platforms.agg(
        date_range_label(F.min("min_date"), F.max("max_date")).alias("date_range"),
        total.alias("total_revenue"),
        F.try_divide(total, F.sum("rows")).alias("mean_revenue"),
        _ranked("platform", "total_revenue", "mean_revenue").alias("platforms"),
    )
    totals = rollup.groupBy("campaign_name").agg(F.sum("total_revenue").alias("total_revenue"))
    top = totals.orderBy(F.desc("total_revenue"), "campaign_name").limit(TOP_CAMPAIGNS)
    campaigns = top.agg(_ranked("campaign_name", "total_revenue").alias("m")).scalar()
    return overall.select("*", campaigns.alias("campaigns")).select(
        "*",
        F.get("platforms", F.lit(0))["name"].alias("best"),
        F.try_element_at("platforms", F.lit(-1))["name"].alias("worst"),
        F.get("campaigns", F.lit(0))["name"].alias("top_campaign"),
    )


def insights_report(
    df: DataFrame, elapsed_seconds: float | None = None, rollup: DataFrame | None = None
) -> DataFrame:
    """The report as (line_no, line).

    Its length is fixed but for one line per platform, so one row may hold all lines. The execution time closes the report only when it is passed in.
    """
    rollup = campaign_rollup(df) if rollup is None else rollup
    one = _overview(rollup)

    # The report's wording and widths.
    rule = "=" * 30
    head: list[str | Column] = [
        rule,
        "Business Insights",
        rule,
        "",
        "Overall Forecast",
        "-" * 16,
        F.concat(F.lit("Date Range                : "), F.col("date_range")),
        F.concat(F.lit("Total Predicted Revenue   : $"), _money(F.col("total_revenue"))),
        F.concat(F.lit("Average Predicted Revenue : $"), _money(F.col("mean_revenue"))),
        "",
        "Platform Performance",
        "-" * 20,
        F.concat(F.lit("Best Performing Platform  : "), F.col("best")),
        F.concat(F.lit("Lowest Performing Platform: "), F.col("worst")),
        "",
        "Revenue Contribution by Platform",
        "-" * 32,
    ]
    middle: list[str | Column] = ["", "Top 5 Campaigns by Revenue", "-" * 26]
    tail: list[str | Column] = [
        "",
        "Recommendations",
        "-" * 15,
        F.concat(
            F.lit("- Double down on the highest performing campaign: "),
            F.col("top_campaign"),
            F.lit("."),
        ),
        F.concat(
            F.lit("- Analyze "),
            F.col("worst"),
            F.lit(" to improve ROI, as it currently has the lowest predicted revenue."),
        ),
        F.concat(
            F.lit("- Investigate top performing campaigns in "),
            F.col("best"),
            F.lit(" to identify successful patterns."),
        ),
        "- Use these forecasts to guide future budget allocation.",
        "- Retrain the forecasting model periodically with fresh marketing data.",
    ]
    if elapsed_seconds is not None:
        tail += ["", "Execution Time", "-" * 14, f"{elapsed_seconds:.2f} seconds"]

    def platform_line(entry: Column) -> Column:
        share = F.when(
            F.col("total_revenue") > 0, entry["total_revenue"] / F.col("total_revenue") * 100
        ).otherwise(F.lit(0.0))
        return F.concat(
            _pad_right(entry["name"], 15),
            F.lit(" : $"),
            _money(entry["total_revenue"], 12),
            F.lit(" ("),
            _pad_left(F.format_number(share, 1), 5),
            F.lit("%) | Mean: $"),
            _money(entry["mean_revenue"], 10),
        )

    def campaign_line(entry: Column, position: Column) -> Column:
        return F.concat(
            (position + 1).cast("string"),
            F.lit(". "),
            _pad_right(entry["name"], 30),
            F.lit(" : $"),
            _money(entry["total_revenue"], 12),
        )

    def texts(lines: list[str | Column]) -> Column:
        return F.array(*[F.lit(line) if isinstance(line, str) else line for line in lines])

    lines = F.concat(
        texts(head),
        F.transform("platforms", platform_line),
        texts(middle),
        F.transform("campaigns", campaign_line),
        texts(tail),
    )
    numbered = one.select(F.posexplode(lines).alias("position", "line"))
    return numbered.select((F.col("position") + 1).cast("bigint").alias("line_no"), "line")


def summary_json(
    df: DataFrame,
    timestamp: str | None = None,
    elapsed_seconds: float | None = None,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """One row, one JSON document (column ``value``).

    Its maps hold one entry per platform and per top campaign, largest first.
    """
    rollup = campaign_rollup(df) if rollup is None else rollup

    def ordered_map(entries: str, value) -> Column:
        pairs = F.transform(entries, lambda e: F.struct(e["name"].alias("k"), value(e).alias("v")))
        return F.map_from_entries(pairs)

    def figures(entry: Column) -> Column:
        return F.struct(
            entry["total_revenue"].alias("total_revenue"), entry["mean_revenue"].alias("mean_revenue")
        )

    stamp = F.lit(timestamp) if timestamp else F.date_format(F.now(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    overall = _overview(rollup)
    document = F.struct(
        stamp.alias("timestamp"),
        "date_range",
        F.col("total_revenue").alias("total_predicted_revenue"),
        F.col("mean_revenue").alias("mean_prediction"),
        ordered_map("platforms", figures).alias("platform_summary"),
        ordered_map("campaigns", lambda e: e["total_revenue"]).alias("top_5_campaigns"),
        F.lit(elapsed_seconds).cast("double").alias("execution_time_seconds"),
    )
    return overall.select(F.to_json(document, {"pretty": "true"}).alias("value"))


def write_lines(report: DataFrame, path: str) -> None:
    """The report as one text file in ``path``; it has a few dozen lines."""
    report.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode(
        "overwrite"
    ).text(path)


def write_document(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").text(path)
