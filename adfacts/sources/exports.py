"""Read platform exports and bring them to the canonical table.

Everything stays lazy: reading checks the header, and no count is taken, unless ``multi_line=None``
asks for a scan of the lines.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfacts.functions import cleaning
from adfacts.operators.validation import observed, validate
from adfacts.schema import CANONICAL_COLUMNS, CANONICAL_SCHEMA, SERIES_KEYS, require_columns
from adfacts.sources.registry import SOURCES, SourceSpec

Paths = str | Sequence[str]


def files_with_broken_rows(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path`` in which a line may end within a row, found by one split scan.

    A row that goes on in the next line leaves a quote open, so its first line holds an odd number
    of quotes (a doubled quote counts twice). A carriage return amid a line is taken as a
    sign too. In all other files every line is a row.
    """
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    broken = (quotes % 2 == 1) | line.rlike(r"(?s)\r.")
    lines = spark.read.option("lineSep", "\n").text(path).where(broken)
    return sorted(r[0] for r in lines.select("_metadata.file_path").distinct().collect())


def _read_one(spark: SparkSession, path: str, multi_line: bool | None) -> DataFrame:
    def reader(several: bool):
        # escape: a doubled quote inside quotes is one quote
        return spark.read.option("header", True).option("escape", '"').option("multiLine", several)

    try:
        header = reader(multi_line is not False).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    # enforceSchema=False makes a file whose header differs fail, not swap columns
    def rows(several: bool) -> DataFrame:
        return reader(several).schema(schema).option("enforceSchema", False).csv(path)

    if multi_line is not None:
        return rows(multi_line)
    whole = files_with_broken_rows(spark, path)
    if not whole:
        return rows(False)
    # a condition on the file alone: Spark leaves the other files out of each scan
    apart = F.col("_metadata.file_path").isin(whole)
    return rows(False).where(~apart).unionByName(rows(True).where(apart))


def read_export(
    spark: SparkSession,
    paths: Paths,
    required: Sequence[str] = (),
    multi_line: bool | None = True,
) -> DataFrame:
    """Headered CSV with every column as text and missing-value texts as NULL.

    All files under one path share a header. Exports whose column order differs
    are passed as separate paths and matched by name. ``multi_line`` allows line
    breaks inside quotes, at the price of one task per file; without it a large file is split
    among tasks, and a row that holds a line break falls apart. With None the lines are
    scanned once, at this call, and only files that may hold such rows are read by one task each.
    """
    parts = []
    for path in [paths] if isinstance(paths, str) else paths:
        raw = _read_one(spark, path, multi_line)
        require_columns(raw.columns, list(required), f"export {path}")
        parts.append(raw)
    if not parts:
        raise ValueError("no export path given")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.select([cleaning.null_tokens(c).alias(c) for c in merged.columns])


def normalise(
    raw: DataFrame, spec: SourceSpec, audit: bool = False, hash_trimmed_name: bool = False
) -> DataFrame:
    """A platform's text columns as the nine canonical columns.

    ``audit`` adds two flags that only the raw text can tell: ``negative_revenue``
    and ``grain_mismatch``. The campaign id is a hash of the name as exported, so
    ``"A "`` and ``"A"`` differ; ``hash_trimmed_name`` makes them equal.
    """
    require_columns(raw.columns, spec.required, f"source {spec.platform}")
    if not {"date", "campaign_name"} <= set(spec.columns):
        raise ValueError(f"source {spec.platform}: date and campaign_name must be mapped")

    def text(canonical: str) -> Column:
        column = F.col(f"`{spec.columns[canonical]}`")
        if canonical == "date":
            column = cleaning.strip_whitespace(column)
        elif canonical != "campaign_name" and spec.thousands_commas:
            column = cleaning.strip_commas(column)
        clean = spec.cleaners.get(canonical)
        return clean(column) if clean else column

    # The cleaned text is its own projection: typing refers to it several times.
    cleaned = [text(c).alias(c) for c in spec.columns]
    if audit and spec.grain_end in raw.columns:
        # a missing day never equals another day, not even another missing one
        same = F.col(f"`{spec.columns['date']}`") == F.col(f"`{spec.grain_end}`")
        cleaned.append(F.coalesce(~same, F.lit(True)).alias("grain_mismatch"))
    texts = raw.select(cleaned)

    def number(canonical: str) -> Column:
        if canonical not in spec.columns:
            return F.lit(None).cast("double")
        return cleaning.to_double(F.col(canonical))

    def count(canonical: str) -> Column:
        if canonical not in spec.columns:
            return F.lit(0).cast("bigint")
        return cleaning.to_count(F.col(canonical))

    name = F.col("campaign_name")
    trimmed = cleaning.strip_whitespace(name)
    spend = number("spend")
    if spec.spend_divisor != 1:
        spend = spend / F.lit(float(spec.spend_divisor))
    values = {
        "date": cleaning.to_date_time(F.col("date"), spec.date_patterns),
        "platform": F.lit(spec.platform),
        "campaign_id": cleaning.campaign_id(spec.platform, trimmed if hash_trimmed_name else name),
        "campaign_name": trimmed,
        "spend": spend,
        "revenue": cleaning.sanitise_revenue(number("revenue")),
        "conversions": number("conversions"),
        "clicks": count("clicks"),
        "impressions": count("impressions"),
    }
    columns = [values[f.name].cast(f.dataType).alias(f.name) for f in CANONICAL_SCHEMA]
    if audit:
        negative = F.coalesce(number("revenue") < 0, F.lit(False))
        mismatch = F.col("grain_mismatch") if "grain_mismatch" in texts.columns else F.lit(False)
        columns += [negative.alias("negative_revenue"), mismatch.alias("grain_mismatch")]
    return texts.select(columns)


def load_source(
    spark: SparkSession, paths: Paths, spec: SourceSpec, multi_line: bool | None = True
) -> DataFrame:
    """One platform's export as canonical rows, not yet validated."""
    return normalise(read_export(spark, paths, spec.required, multi_line), spec)


def _parsed_once(df: DataFrame) -> DataFrame:
    """Keep later filters above the projection that parses text.

    Spark moves a filter below a projection by repeating the projected expressions in
    it, which would parse every date and number twice. It leaves alone a projection
    that holds a task-dependent value.
    """
    task = "_task"
    return df.withColumn(task, F.spark_partition_id()).where(F.col(task) >= 0).drop(task)


def ingest(
    spark: SparkSession,
    paths: Mapping[str, Paths | None],
    sources: Mapping[str, SourceSpec] = SOURCES,
    multi_line: bool | None = True,
    audits: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Validated union of the platforms that have a path; at least one must.

    Row order is not promised: see ``in_canonical_order`` for the sink. A platform's
    observation in ``audits`` receives its counts of ``quality_audit`` (its day: today) when
    the result is computed. The filters of later steps then stay above all parsing.
    """
    given = {platform: path for platform, path in paths.items() if path}
    if not given:
        raise ValueError("at least one platform export is needed")
    unknown = sorted(set(given) - set(sources))
    if unknown:
        raise ValueError(f"unknown platforms {unknown}; known: {sorted(sources)}")
    parts = []
    for platform, path in given.items():
        spec = sources[platform]
        watch = (audits or {}).get(platform)
        raw = read_export(spark, path, spec.required, multi_line)
        parsed = _parsed_once(normalise(raw, spec, audit=watch is not None))
        if watch is not None:
            today = F.lit(datetime.date.today())
            parsed = observed(parsed, watch, today).select(CANONICAL_COLUMNS)
        # stated again on top, so that a filter on platform skips the other exports
        parts.append(validate(parsed.withColumn("platform", F.lit(spec.platform))))
    return reduce(DataFrame.unionByName, parts)


def in_canonical_order(df: DataFrame) -> DataFrame:
    """Global order by date, platform and campaign, for a sink that wants one.

    The further keys let Spark cut a day of one campaign into several sort ranges;
    the row number does so even for equal rows.
    """
    first = ["date", "platform", "campaign_id"]
    rest = [c for c in df.columns if c not in first]
    return df.orderBy(*first, *rest, F.monotonically_increasing_id())


def ingest_summary(df: DataFrame) -> DataFrame:
    """Rows, campaigns and date range per platform."""
    return df.groupBy("platform").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("campaign_id").alias("campaign_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def unified_summary(df: DataFrame) -> DataFrame:
    """One row over all platforms. Campaigns are counted by id alone."""
    per_campaign = df.groupBy(*SERIES_KEYS).agg(
        F.count("*").alias("n"), F.min("date").alias("low"), F.max("date").alias("high")
    )
    return per_campaign.agg(
        F.sum("n").alias("row_count"),
        F.array_join(F.array_sort(F.collect_set("platform")), ",").alias("platforms"),
        F.count_distinct("campaign_id").alias("campaign_count"),
        F.min("low").alias("min_date"),
        F.max("high").alias("max_date"),
    )
