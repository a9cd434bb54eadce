"""The registered queries in SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

METRICS = ["spend", "revenue", "clicks", "conversions"]
SERIES = "PARTITION BY platform, campaign_id ORDER BY date, campaign_name, spend, revenue NULLS FIRST, conversions, clicks, impressions"  # noqa: E501

PLATFORM = """CASE l_returnflag WHEN 'A' THEN 'google_ads' WHEN 'N' THEN 'meta_ads'
    WHEN 'R' THEN 'microsoft_ads' END"""

CANONICAL = "date, platform, campaign_id, campaign_name, spend, revenue, conversions, clicks, impressions"  # noqa: E501


def _finish(daily: str) -> str:
    """Columns of a canonical table over one with ``day`` and ``sales``."""
    return f"""SELECT CAST(day AS TIMESTAMP) AS date, platform,
        substr(md5(platform || '::' || campaign_name), 1, 16) AS campaign_id, campaign_name,
        CAST(spend AS DOUBLE) AS spend,
        CASE WHEN platform <> 'meta_ads' THEN CAST(sales AS DOUBLE) END AS revenue,
        CAST(conversions AS DOUBLE) AS conversions, CAST(clicks AS BIGINT) AS clicks,
        CAST(impressions AS BIGINT) AS impressions FROM ({daily})"""


SHIPMENTS = _finish(f"""
    SELECT CAST(l_shipdate AS DATE) AS day, {PLATFORM} AS platform,
        'Campaign ' || (l_partkey % 100) AS campaign_name,
        sum(CAST(round(l_discount * 1e2) AS BIGINT) * 125) / 1e2 AS spend,
        sum(CAST(round(l_extendedprice) AS BIGINT)) / 1e2 AS sales,
        sum(l_linenumber) AS conversions,
        sum((l_orderkey + l_linenumber) % 5) AS clicks,
        sum(CAST(l_quantity AS BIGINT) % 10) * 100 AS impressions
    FROM lineitem GROUP BY ALL""")

EVENTS = _finish("""
    SELECT CAST(ts AS DATE) AS day,
        CASE user_id % 3 WHEN 0 THEN 'google_ads' WHEN 1 THEN 'meta_ads'
            ELSE 'microsoft_ads' END AS platform,
        'Campaign ' || (user_id % 10) AS campaign_name,
        coalesce(sum(CAST(round(value * 1e2) AS BIGINT)) FILTER (event_type = 'error'), 0) / 1e2
            AS spend,
        coalesce(sum(CAST(round(value * 1e2) AS BIGINT)) FILTER (event_type = 'purchase'), 0) / 1e2
            AS sales,
        count(*) FILTER (event_type = 'signup') AS conversions,
        count(*) FILTER (event_type = 'click') AS clicks,
        count(*) FILTER (event_type = 'view') * 100 AS impressions
    FROM events GROUP BY ALL""")

SKEWED = _finish(f"""
    SELECT date_trunc('month', l_shipdate) AS day,
        CASE WHEN l_partkey % 3 = 0 THEN 'google_ads' ELSE {PLATFORM} END AS platform,
        CASE WHEN l_partkey % 3 = 0 THEN 'Everything'
            ELSE 'Campaign ' || (l_partkey % 100) END AS campaign_name,
        CAST(round(l_discount * 1e2) AS BIGINT) * 125 / 1e2 AS spend,
        CAST(round(l_extendedprice / 1e3) AS BIGINT) / 1e2 AS sales,
        l_linenumber AS conversions,
        (l_orderkey + l_linenumber) % 5 AS clicks,
        CAST(l_quantity AS BIGINT) % 10 * 100 AS impressions
    FROM lineitem""")

ONE_CAMPAIGN = _finish("""
    SELECT date_trunc('year', l_shipdate) AS day, 'google_ads' AS platform,
        'Everything' AS campaign_name, 1.25 AS spend, l_linenumber % 2 * 5 AS sales,
        2 AS conversions, l_linenumber % 2 + 3 AS clicks, 100 AS impressions
    FROM lineitem""")

# Raw exports: the value each cell should be read as, from the keys that made it dirty.
RAW = f"""
    SELECT *, CASE WHEN name_text IS NULL THEN NULL ELSE trim(name_text, ' ' || chr(9)) END
            AS campaign_name,
        substr(md5(platform || '::' || coalesce(name_text, 'nan')), 1, 16) AS campaign_id,
        CASE WHEN revenue_read >= 0 THEN revenue_read END AS revenue,
        coalesce(revenue_read < 0, false) AS negative_revenue
    FROM (SELECT k, {PLATFORM} AS platform, day, name,
        CASE WHEN k % 17 <> 0 THEN CAST(day AS TIMESTAMP) END AS date,
        CASE WHEN k % 53 = 0 THEN NULL WHEN k % 11 = 0 THEN '  ' || name || chr(9)
            WHEN k % 19 = 0 THEN 'The "big", ' || name ELSE name END AS name_text,
        CASE WHEN k % 41 <> 0 THEN spend_cents / 1e2 END AS spend,
        CASE WHEN l_returnflag = 'N' OR k % 47 = 0 THEN NULL ELSE revenue_cents / 1e2 END
            AS revenue_read,
        CASE WHEN k % 43 <> 0 THEN l_linenumber + 0.5e0
            WHEN l_returnflag = 'N' THEN 1e1 END AS conversions,
        CASE WHEN k % 37 <> 0 THEN click_count WHEN l_returnflag = 'R' THEN -5 ELSE 0 END
            AS clicks,
        CASE WHEN k % 31 <> 0 THEN impression_count ELSE 0 END AS impressions,
        l_returnflag = 'N' AND k % 59 = 0 AS grain_mismatch,
        l_linenumber, spend_cents, revenue_cents, click_count, impression_count
    FROM (SELECT l_orderkey * 7 + l_linenumber AS k, l_returnflag, l_linenumber,
        CAST(l_shipdate AS DATE) AS day, 'Campaign ' || (l_partkey % 100) AS name,
        CAST(round(l_extendedprice) AS BIGINT)
            * CASE WHEN (l_orderkey * 7 + l_linenumber) % 23 = 0 THEN -1 ELSE 1 END AS spend_cents,
        CAST(round(l_extendedprice * 1e2) AS BIGINT)
            * CASE WHEN (l_orderkey * 7 + l_linenumber) % 13 = 0 THEN 0
                WHEN (l_orderkey * 7 + l_linenumber) % 29 = 0 THEN -1 ELSE 1 END AS revenue_cents,
        CAST((l_orderkey + l_linenumber) % 97 AS BIGINT) AS click_count,
        CAST(l_quantity AS BIGINT) * 1000 AS impression_count
    FROM lineitem))"""

RAW_CANONICAL = f"SELECT {CANONICAL} FROM ({RAW})"

DIRTY = f"""
    SELECT CASE WHEN k % 17 <> 0 THEN CAST(l_shipdate AS TIMESTAMP) END AS date, platform,
        substr(md5(platform || '::' || name), 1, 16) AS campaign_id,
        CASE WHEN k % 53 <> 0 THEN name END AS campaign_name,
        CASE WHEN k % 19 <> 0 THEN
            CAST(round(l_extendedprice) AS BIGINT) * CASE WHEN k % 23 = 0 THEN -1 ELSE 1 END / 1e2
            END AS spend,
        CASE WHEN k % 13 <> 0 THEN CAST(round(l_extendedprice) AS BIGINT) / 1e1 END AS revenue,
        CASE WHEN k % 31 <> 0 THEN
            (l_linenumber + 0.5e0) * CASE WHEN k % 29 = 0 THEN -1 ELSE 1 END END AS conversions,
        CASE WHEN k % 41 <> 0 THEN
            l_orderkey % 97 * CASE WHEN k % 37 = 0 THEN -1 ELSE 1 END END AS clicks,
        CASE WHEN k % 47 <> 0 THEN
            CAST(l_quantity AS BIGINT) * 100 * CASE WHEN k % 43 = 0 THEN -1 ELSE 1 END END
            AS impressions
    FROM (SELECT *, l_orderkey * 7 + l_linenumber AS k, {PLATFORM} AS platform,
        'Campaign ' || (l_partkey % 100) AS name FROM lineitem)"""

COMPLETE = """date IS NOT NULL AND platform IS NOT NULL AND campaign_id IS NOT NULL
    AND campaign_name IS NOT NULL AND spend IS NOT NULL AND conversions IS NOT NULL
    AND clicks IS NOT NULL AND impressions IS NOT NULL"""


def _validated(facts: str) -> str:
    return f"""SELECT date, platform, campaign_id, campaign_name,
        CASE WHEN spend < 0 THEN 0 ELSE spend END AS spend, revenue,
        CASE WHEN conversions < 0 THEN 0 ELSE conversions END AS conversions,
        CAST(CASE WHEN clicks < 0 THEN 0 ELSE clicks END AS BIGINT) AS clicks,
        CAST(CASE WHEN impressions < 0 THEN 0 ELSE impressions END AS BIGINT) AS impressions
        FROM ({facts}) WHERE {COMPLETE}"""


TIME = """CAST(isodow(date) - 1 AS BIGINT) AS day_of_week, dayname(date) AS day_name,
    CAST(month(date) AS BIGINT) AS month, monthname(date) AS month_name,
    CAST(quarter(date) AS BIGINT) AS quarter, CAST(week(date) AS BIGINT) AS week_of_year,
    CAST(day(date) AS BIGINT) AS day_of_month, CAST(dayofyear(date) AS BIGINT) AS day_of_year,
    CAST(isodow(date) IN (6, 7) AS BIGINT) AS is_weekend"""

KPI = """CAST(clicks AS DOUBLE) / nullif(impressions, 0) AS ctr,
    nullif(spend, 0) / nullif(clicks, 0) AS cpc,
    nullif(spend, 0) / nullif(impressions, 0) * 1e3 AS cpm,
    conversions / nullif(clicks, 0) AS conversion_rate,
    revenue / nullif(spend, 0) AS roas,
    revenue / nullif(clicks, 0) AS revenue_per_click,
    revenue / nullif(impressions, 0) AS revenue_per_impression"""

LAG = ", ".join(
    f"CAST(lag({m}, {n}) OVER ({SERIES}) AS DOUBLE) AS {m}_lag_{n}" for m in METRICS for n in (1, 7)
)


def _rolling() -> str:
    parts = []
    for m in METRICS:
        for n in (7, 14):
            over = f"OVER ({SERIES} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            value = f"CAST({m} AS DOUBLE)"
            parts += [
                f"round(avg({value}) {over}, 6) AS {m}_rolling_mean_{n}",
                f"round(coalesce(stddev_samp({value}) {over}, 0), 4) AS {m}_rolling_std_{n}",
                f"min({value}) {over} AS {m}_rolling_min_{n}",
                f"max({value}) {over} AS {m}_rolling_max_{n}",
            ]
    return ", ".join(parts)


def _features(facts: str) -> str:
    return f"SELECT *, {TIME}, {KPI}, {LAG}, {_rolling()} FROM ({facts})"


KEYS = ["date", "platform", "campaign_id", "campaign_name"]
LEAKY = ["roas", "revenue_per_click", "revenue_per_impression"]


def _matrix(leaky: bool) -> str:
    left_out = ["revenue", "day_name", "month_name", *([] if leaky else LEAKY)]
    return f"""SELECT * EXCLUDE ({', '.join(left_out)}), revenue AS label
        FROM ({_features(SHIPMENTS)}) WHERE revenue IS NOT NULL"""


# Yesterday's revenue as forecast: exact on both sides.
NAIVE = f"""SELECT {CANONICAL}, prediction FROM (
    SELECT *, lag(revenue, 1) OVER ({SERIES}) AS prediction FROM ({SHIPMENTS}))
    WHERE revenue IS NOT NULL AND prediction IS NOT NULL"""


def _metrics(rows: str, group: str = "") -> str:
    comma = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""SELECT {comma}count(*) AS row_count, CAST(0 AS BIGINT) AS missing_rows,
        round(sqrt(avg((revenue - prediction) * (revenue - prediction))), 6) AS rmse,
        round(avg(abs(revenue - prediction)), 6) AS mae,
        round(1 - sum((revenue - prediction) * (revenue - prediction))
            / (var_pop(revenue) * count(*)), 6) AS r2,
        round(avg(abs(revenue - prediction) / greatest(abs(revenue), 2.220446049250313e-16)), 6)
            AS mape,
        round(avg(abs(revenue - prediction) / nullif(abs(revenue), 0)), 6) AS mape_nonzero,
        count(*) FILTER (revenue = 0) AS zero_actuals FROM ({rows}) {by}"""


def _bucket(value: str, low: str, high: str) -> str:
    return f"""CAST(least(coalesce(floor(({value} - {low}) / nullif(({high} - {low}) / 2e1, 0)), 0),
        19) AS BIGINT)"""


PLATFORM_TOTALS = f"""SELECT platform, sum(prediction) AS total, avg(prediction) AS mean
    FROM ({NAIVE}) GROUP BY platform"""
CAMPAIGN_TOTALS = f"""SELECT campaign_name, sum(prediction) AS total
    FROM ({NAIVE}) GROUP BY campaign_name"""


def _money(value: str) -> str:
    cents = f"CAST(round({value} * 100) AS BIGINT)"
    return f"(format('{{:,}}', {cents} // 100) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"  # noqa: E501


def _left(text: str, width: int) -> str:
    return f"(repeat(' ', greatest(0, {width} - length({text}))) || {text})"


def _right(text: str, width: int) -> str:
    return f"({text} || repeat(' ', greatest(0, {width} - length({text}))))"


def _insights() -> str:
    best = "(SELECT platform FROM p ORDER BY total DESC, platform LIMIT 1)"
    worst = "(SELECT platform FROM p ORDER BY total, platform DESC LIMIT 1)"
    top = "(SELECT campaign_name FROM c ORDER BY total DESC, campaign_name LIMIT 1)"
    days = "(SELECT strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') FROM n)"  # noqa: E501
    total = f"(SELECT {_money('sum(prediction)')} FROM n)"
    mean = f"(SELECT {_money('avg(prediction)')} FROM n)"
    head = [
        f"'{'=' * 30}'", "'Business Insights'", f"'{'=' * 30}'", "''", "'Overall Forecast'",
        f"'{'-' * 16}'", f"'Date Range                : ' || {days}",
        f"'Total Predicted Revenue   : $' || {total}",
        f"'Average Predicted Revenue : $' || {mean}", "''", "'Platform Performance'",
        f"'{'-' * 20}'", f"'Best Performing Platform  : ' || {best}",
        f"'Lowest Performing Platform: ' || {worst}", "''", "'Revenue Contribution by Platform'",
        f"'{'-' * 32}'",
    ]
    middle = ["''", "'Top 5 Campaigns by Revenue'", f"'{'-' * 26}'"]
    tail = [
        "''", "'Recommendations'", f"'{'-' * 15}'",
        f"'- Double down on the highest performing campaign: ' || {top} || '.'",
        f"'- Analyze ' || {worst} || ' to improve ROI, as it currently has the lowest predicted revenue.'",  # noqa: E501
        f"'- Investigate top performing campaigns in ' || {best} || ' to identify successful patterns.'",  # noqa: E501
        "'- Use these forecasts to guide future budget allocation.'",
        "'- Retrain the forecasting model periodically with fresh marketing data.'",
    ]
    fixed = [
        f"SELECT {section} AS section, {position} AS position, {line} AS line"
        for section, lines in ((1, head), (3, middle), (5, tail))
        for position, line in enumerate(lines)
    ]
    share = "printf('%.1f', total / (SELECT sum(total) FROM p) * 100)"
    platforms = f"""SELECT 2, row_number() OVER (ORDER BY total DESC, platform),
        {_right('platform', 15)} || ' : $' || {_left(_money('total'), 12)} || ' (' ||
        {_left(share, 5)} || '%) | Mean: $' || {_left(_money('mean'), 10)} FROM p"""
    campaigns = f"""SELECT 4, place, CAST(place AS VARCHAR) || '. ' ||
        {_right('campaign_name', 30)} || ' : $' || {_left(_money('total'), 12)}
        FROM (SELECT *, row_number() OVER (ORDER BY total DESC, campaign_name) AS place FROM c)
        WHERE place <= 5"""
    lines = " UNION ALL ".join([*fixed, platforms, campaigns])
    return f"""WITH n AS ({NAIVE}), p AS ({PLATFORM_TOTALS}), c AS ({CAMPAIGN_TOTALS})
        SELECT row_number() OVER (ORDER BY section, position) AS line_no, line FROM ({lines})"""


def _evaluation_report() -> str:
    """Row count and two sums per table; the tables themselves have queries of their own."""
    per_day = f"""SELECT sum(revenue) AS actual, sum(prediction) AS predicted
        FROM ({NAIVE}) GROUP BY date"""
    tables = {
        "metrics": (_metrics(NAIVE, "platform"), "rmse", "mae"),
        "actual_vs_predicted": (per_day, "actual", "abs(actual - predicted)"),
        "residuals": (NAIVE, "abs(revenue - prediction)", "prediction"),
        "residual_buckets": (
            f"""WITH n AS ({NAIVE}),
                b AS (SELECT min(prediction) AS low, max(prediction) AS high FROM n)
            SELECT {_bucket('prediction', 'low', 'high')} AS bucket, count(*) AS row_count,
                max(revenue - prediction) AS max_residual FROM n, b GROUP BY 1""",
            "bucket * row_count",
            "max_residual",
        ),
        "prediction_error": (
            f"""WITH n AS ({NAIVE}),
                b AS (SELECT least(min(revenue), min(prediction)) AS low,
                    greatest(max(revenue), max(prediction)) AS high FROM n)
            SELECT {_bucket('revenue', 'low', 'high')} * 20
                + {_bucket('prediction', 'low', 'high')} AS position, count(*) AS row_count,
                any_value(high - low) AS width FROM n, b GROUP BY 1""",
            "position * row_count",
            "width",
        ),
        "feature_importance": (
            " UNION ALL ".join(
                f"SELECT '{m}' AS feature, max({m}) AS importance FROM ({NAIVE})" for m in METRICS
            ),
            "importance",
            "length(feature)",
        ),
    }
    return " UNION ALL ".join(
        f"""SELECT '{part}' AS part, count(*) AS row_count,
            round(sum(CAST({first} AS DOUBLE)), 2) AS sum_1,
            round(sum(CAST({second} AS DOUBLE)), 2) AS sum_2 FROM ({rows})"""
        for part, (rows, first, second) in tables.items()
    )


def _audit() -> str:
    required = [c.strip() for c in CANONICAL.split(",") if c.strip() != "revenue"]
    dropped = []
    for i, column in enumerate(required):
        before = " AND ".join(f"{c} IS NOT NULL" for c in required[:i]) or "true"
        dropped.append(f"count(*) FILTER ({before} AND {column} IS NULL) AS dropped_{column}")
    negative = [
        f"count(*) FILTER (kept AND {c} < 0) AS negative_{c}"
        for c in ("spend", "conversions", "clicks", "impressions")
    ]
    return f"""SELECT platform, count(*) AS row_count, count(*) FILTER (kept) AS kept_rows,
        {', '.join(dropped)}, {', '.join(negative)},
        count(*) FILTER (negative_revenue) AS negative_revenue_rows,
        count(*) FILTER (grain_mismatch) AS grain_mismatch_rows,
        count(*) FILTER (kept AND revenue IS NULL) AS revenue_nulls,
        count(*) FILTER (kept AND date > TIMESTAMP '2001-06-01') AS future_rows,
        min(date) FILTER (kept) AS min_date, max(date) FILTER (kept) AS max_date,
        CAST(date_diff('day', min(date) FILTER (kept), max(date) FILTER (kept)) + 1 AS BIGINT)
            AS calendar_days
        FROM (SELECT *, {COMPLETE} AS kept FROM ({RAW})) GROUP BY platform"""


def _decimal_text(cents: str) -> str:
    size = f"abs({cents})"
    return f"""(CASE WHEN {cents} < 0 THEN '-' ELSE '' END || CAST({size} // 100 AS VARCHAR) || '.'
        || lpad(CAST({size} % 100 AS VARCHAR), 2, '0'))"""


LINEAR_DATA = f"""SELECT {', '.join(KEYS)}, revenue, conversions,
    ('0x' || substr(md5(concat_ws('|', platform, campaign_id,
        strftime(date, '%Y-%m-%d %H:%M:%S'), '42')), 1, 7))::BIGINT % 10000 < 2000 AS is_validation
    FROM ({SHIPMENTS}) WHERE revenue IS NOT NULL"""

ORACLE: dict[str, str] = {
    "scan_csv_strings": f"""SELECT
        CASE WHEN k % 17 = 0 THEN 'not a date' ELSE strftime(day, '%Y-%m-%d') END AS segments_date,
        name_text AS campaign_name,
        CASE WHEN k % 31 = 0 THEN 'bad' ELSE CAST(impression_count AS VARCHAR) END
            AS metrics_impressions,
        CASE WHEN k % 37 <> 0 THEN CAST(click_count AS VARCHAR) END AS metrics_clicks,
        CASE WHEN k % 41 = 0 THEN '12d' ELSE CAST(spend_cents * 10000 AS VARCHAR) END
            AS metrics_cost_micros,
        CASE WHEN k % 43 <> 0 THEN l_linenumber || '.5' END AS metrics_conversions,
        CASE WHEN k % 47 <> 0 THEN {_decimal_text('revenue_cents')} END
            AS metrics_conversions_value
        FROM ({RAW}) WHERE platform = 'google_ads'""",
    "ingest_google": f"SELECT * FROM ({RAW_CANONICAL}) WHERE platform = 'google_ads'",
    "ingest_meta": f"SELECT * FROM ({RAW_CANONICAL}) WHERE platform = 'meta_ads'",
    "ingest_bing": f"SELECT * FROM ({RAW_CANONICAL}) WHERE platform = 'microsoft_ads'",
    "ingest_unified": _validated(RAW_CANONICAL),
    "ingest_ordered": f"{_validated(RAW_CANONICAL)} ORDER BY date, platform, campaign_id",
    "ingest_summary": f"""SELECT platform, count(*) AS row_count,
        count(DISTINCT campaign_id) AS campaign_count, min(date) AS min_date, max(date) AS max_date
        FROM ({_validated(RAW_CANONICAL)}) GROUP BY platform""",
    "unified_summary": f"""SELECT count(*) AS row_count,
        string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms,
        count(DISTINCT campaign_id) AS campaign_count, min(date) AS min_date, max(date) AS max_date
        FROM ({_validated(RAW_CANONICAL)})""",
    "clean_thousands": f"""SELECT
        CASE WHEN k % 31 = 0 THEN '0x1A' ELSE CAST(impression_count AS VARCHAR) END AS impressions,
        CASE WHEN k % 41 = 0 THEN 'inf' ELSE {_decimal_text('spend_cents')} END AS spend,
        CASE WHEN k % 47 <> 0 THEN {_decimal_text('revenue_cents')} END AS revenue
        FROM ({RAW}) WHERE platform = 'microsoft_ads'""",
    "campaign_identity": f"""SELECT platform, campaign_name, campaign_id, count(*) AS row_count
        FROM ({RAW}) GROUP BY ALL""",
    "coerce_numeric": f"SELECT platform, spend, conversions FROM ({RAW})",
    "coerce_counts": f"""SELECT platform, CAST(clicks AS BIGINT) AS clicks,
        CAST(impressions AS BIGINT) AS impressions FROM ({RAW})""",
    "revenue_sanitise": f"""SELECT platform, revenue, negative_revenue, count(*) AS row_count
        FROM ({RAW}) GROUP BY ALL""",
    "parse_dates": f"""SELECT CASE platform
            WHEN 'google_ads' THEN
                CASE WHEN date IS NULL THEN 'not a date' ELSE strftime(day, '%Y-%m-%d') END
            WHEN 'meta_ads' THEN
                CASE WHEN date IS NULL THEN '2024-02-30' ELSE strftime(day, '%-d-%b-%Y') END
            ELSE CASE WHEN date IS NULL THEN '10:30' ELSE strftime(day, '%-m/%-d/%Y') END
        END AS date_text, date, count(*) AS row_count FROM ({RAW}) GROUP BY ALL""",
    "parse_date_shapes": """SELECT date_text, date, count(*) AS row_count FROM (
            SELECT CASE which
                WHEN 0 THEN strftime(day, '%Y-%m-%dT10:00:00Z')
                WHEN 1 THEN strftime(day, '%Y-%m-%dT00:30:00+02:00')
                WHEN 2 THEN strftime(day, '%b %-d %Y')
                WHEN 3 THEN strftime(day, '%Y-%b-%d')
                WHEN 4 THEN strftime(day, '%Y-%m-%dT10')
                WHEN 5 THEN strftime(day, '%B %-d, %Y')
                WHEN 6 THEN strftime(day, '%-m/%-d/%Y 1:05 PM')
                WHEN 7 THEN strftime(day, '%Y-%m-%d 23:59:59 UTC')
                WHEN 8 THEN strftime(day, '%a, %d %b %Y')
                WHEN 9 THEN strftime(day, '%Y.%m.%d')
                WHEN 10 THEN strftime(day, '%Y%m%d')
                ELSE strftime(day, '%Y-%m-%dT04:00:00.250-0530') END AS date_text,
            CAST(day AS TIMESTAMP) + CASE which
                WHEN 0 THEN INTERVAL 10 HOUR WHEN 1 THEN INTERVAL (-90) MINUTE
                WHEN 4 THEN INTERVAL 10 HOUR WHEN 6 THEN INTERVAL 785 MINUTE
                WHEN 7 THEN INTERVAL 86399 SECOND WHEN 11 THEN INTERVAL 34200250 MILLISECOND
                ELSE INTERVAL 0 HOUR END AS date
            FROM (SELECT CAST(l_shipdate AS DATE) AS day, (l_orderkey * 7 + l_linenumber) % 12 AS which
                FROM lineitem)) GROUP BY date_text, date""",
    "validate_canonical": _validated(DIRTY),
    "quality_audit": _audit(),
    "revenue_null_audit": f"""WITH v AS ({_validated(DIRTY)})
        SELECT coalesce(platform, 'all') AS platform, count(*) AS row_count,
        count(*) FILTER (revenue IS NULL) AS revenue_nulls,
        1e2 * count(*) FILTER (revenue IS NULL) / count(*) AS revenue_null_pct
        FROM v GROUP BY ROLLUP (platform)""",
    "revenue_null_map": f"""SELECT platform, count(*) AS revenue_nulls
        FROM ({_validated(DIRTY)}) WHERE revenue IS NULL GROUP BY platform""",
    "time_features": f"SELECT *, {TIME} FROM ({SHIPMENTS})",
    "marketing_kpis": f"SELECT *, {KPI} FROM ({SHIPMENTS})",
    "lag_features": f"SELECT *, {LAG} FROM ({SHIPMENTS})",
    "rolling_features": f"SELECT *, {_rolling()} FROM ({SHIPMENTS})",
    "feature_table": _features(SHIPMENTS),
    "feature_table_events": _features(EVENTS),
    "feature_table_default": _features(SHIPMENTS),
    "feature_table_skewed": _features(SKEWED),
    "feature_table_one_campaign": _features(ONE_CAMPAIGN),
    "model_matrix": _matrix(leaky=False),
    "model_matrix_all_features": _matrix(leaky=True),
    "train_validation_split": f"""SELECT is_validation, count(*) AS row_count
        FROM ({LINEAR_DATA}) GROUP BY is_validation""",
    "train_contract": f"""SELECT count(*) FILTER (NOT is_validation) AS train_rows,
        count(*) FILTER (is_validation) AS validation_rows, true AS errors_are_plausible,
        true AS r2_is_plausible FROM ({LINEAR_DATA})""",
    "score_coverage": f"""SELECT platform, count(*) AS row_count, count(*) AS finite_predictions,
        count(DISTINCT campaign_id) AS campaign_count FROM ({SHIPMENTS}) GROUP BY platform""",
    "train_linear": f"""WITH d AS ({LINEAR_DATA}), fit AS (SELECT
            regr_slope(revenue, conversions) AS slope, regr_intercept(revenue, conversions) AS base
            FROM d WHERE NOT is_validation),
        s AS (SELECT revenue, base + slope * conversions AS p FROM d, fit WHERE is_validation)
        SELECT count(*) AS validation_rows,
            (SELECT count(*) FROM d WHERE NOT is_validation) AS train_rows,
            round(sqrt(avg((revenue - p) * (revenue - p))), 4) AS rmse,
            round(avg(abs(revenue - p)), 4) AS mae,
            round(1 - sum((revenue - p) * (revenue - p)) / (var_pop(revenue) * count(*)), 4) AS r2
        FROM s""",
    "score_linear": f"""WITH d AS ({LINEAR_DATA}), fit AS (SELECT
            regr_slope(revenue, conversions) AS slope, regr_intercept(revenue, conversions) AS base
            FROM d WHERE NOT is_validation)
        SELECT {', '.join(KEYS)}, round(base + slope * conversions, 4) AS prediction
        FROM ({SHIPMENTS}), fit""",
    "regression_metrics": _metrics(NAIVE),
    "regression_metrics_by_platform": _metrics(NAIVE, "platform"),
    "eval_actual_vs_predicted": f"""SELECT date, round(sum(revenue), 4) AS actual,
        round(sum(prediction), 4) AS predicted FROM ({NAIVE}) GROUP BY date""",
    "eval_residuals": f"""SELECT {', '.join(KEYS)}, revenue AS actual, prediction AS predicted,
        revenue - prediction AS residual FROM ({NAIVE})""",
    "eval_residual_buckets": f"""WITH n AS ({NAIVE}),
        b AS (SELECT min(prediction) AS low, max(prediction) AS high FROM n)
        SELECT {_bucket('prediction', 'low', 'high')} AS bucket, count(*) AS row_count,
            min(prediction) AS min_predicted, max(prediction) AS max_predicted,
            round(avg(revenue - prediction), 4) AS mean_residual,
            min(revenue - prediction) AS min_residual, max(revenue - prediction) AS max_residual
        FROM n, b GROUP BY 1""",
    "eval_prediction_error": f"""WITH n AS ({NAIVE}),
        b AS (SELECT least(min(revenue), min(prediction)) AS low,
            greatest(max(revenue), max(prediction)) AS high FROM n)
        SELECT {_bucket('revenue', 'low', 'high')} AS actual_bucket,
            {_bucket('prediction', 'low', 'high')} AS predicted_bucket, count(*) AS row_count,
            any_value(low) AS line_low, any_value(high) AS line_high
        FROM n, b GROUP BY 1, 2""",
    "evaluation_report": _evaluation_report(),
    "prediction_stats": f"""SELECT count(*) AS row_count, round(sum(prediction), 2)
            AS total_revenue, round(avg(prediction), 4) AS mean_prediction,
        round(median(prediction), 6) AS median_prediction,
        round(stddev_samp(prediction), 4) AS std_prediction,
        min(prediction) AS min_prediction, max(prediction) AS max_prediction FROM ({NAIVE})""",
    "date_range": f"""SELECT coalesce(strftime(min(date), '%Y-%m-%d') || ' to ' ||
        strftime(max(date), '%Y-%m-%d'), 'N/A') AS date_range FROM ({NAIVE})""",
    "platform_summary": f"""WITH p AS ({PLATFORM_TOTALS})
        SELECT platform, round(total, 2) AS total_revenue, round(mean, 4) AS mean_revenue,
        round(total / (SELECT sum(total) FROM p) * 100, 6) AS share_pct FROM p""",
    "top_campaigns": f"""SELECT campaign_name, round(total, 2) AS total_revenue
        FROM ({CAMPAIGN_TOTALS}) ORDER BY total DESC, campaign_name LIMIT 5""",
    "top_campaigns_by_platform": f"""SELECT platform, campaign_id,
        round(sum(prediction), 2) AS total_revenue FROM ({NAIVE}) GROUP BY platform, campaign_id
        ORDER BY sum(prediction) DESC, platform, campaign_id LIMIT 5""",
    "summary_json": f"""WITH n AS ({NAIVE}), p AS ({PLATFORM_TOTALS}), c AS ({CAMPAIGN_TOTALS}),
        entries AS (SELECT platform AS name, total, mean FROM p UNION ALL
            SELECT * FROM (SELECT campaign_name, total, NULL FROM c
                ORDER BY total DESC, campaign_name LIMIT 5)),
        o AS (SELECT strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d')
                AS date_range, sum(prediction) AS total, avg(prediction) AS mean FROM n)
        SELECT '2024-01-01T00:00:00Z' AS timestamp, date_range,
            round(o.total, 2) AS total_predicted_revenue, round(o.mean, 4) AS mean_prediction,
            name, round(entries.total, 2) AS total_revenue,
            CAST(round(entries.mean, 4) AS DOUBLE) AS mean_revenue FROM entries, o""",
    "insights_report": _insights(),
}
