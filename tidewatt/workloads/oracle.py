"""SQL for DuckDB that yields what each query should yield."""

from __future__ import annotations

from tidewatt.workloads.tables import (
    BAD_TIME,
    EMPTY_VALUE,
    EXPECTED_YEARS,
    KIND_LABELS,
    NAN_VALUE,
    ONE_STATUS,
    RECORD_BUCKETS,
    SHORT_LINE,
    STATUS_LABELS,
    T_TIME,
    UPDATED_KEY,
    WORD_VALUE,
)


def mean(column: str, places: int = 6) -> str:
    """Exact sum, one division: ``avg`` of doubles misses ties (48.0321875 in the strict events)."""
    total = f"CAST(sum(CAST({column} AS DECIMAL(18,6))) AS DOUBLE)"
    return f"round({total} / count({column}), {places})"


def yearly(source: str = "lineitem", entity: str = "l_linestatus") -> str:
    return f"""
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, {entity} AS status,
            {mean('l_extendedprice')} AS "price-mean",
            round(min(l_extendedprice), 2) AS "price-min",
            round(max(l_extendedprice), 2) AS "price-max",
            {mean('l_discount')} AS "discount-mean",
            round(min(l_discount), 2) AS "discount-min",
            round(max(l_discount), 2) AS "discount-max"
        FROM {source} GROUP BY year(l_shipdate), {entity}"""


MONTHLY = f"""
    SELECT strftime(l_shipdate, '%Y-%m') AS date,
        {mean('l_extendedprice')} AS "extended-price",
        {mean('l_discount')} AS discount
    FROM lineitem WHERE l_linestatus = '{ONE_STATUS}'
    GROUP BY strftime(l_shipdate, '%Y-%m')"""

RANKINGS = (
    ("price_desc", "extended-price", "DESC"),
    ("price_asc", "extended-price", "ASC"),
    ("discount_desc", "discount", "DESC"),
    ("discount_asc", "discount", "ASC"),
)


def top(source: str, k: int, within: str = "") -> str:
    columns = f"{within}, " if within else ""
    groups = f"PARTITION BY {within} " if within else ""
    branches = [
        f"""SELECT date, {columns}"extended-price", discount, '{name}' AS order_type,
            CAST(row_number() OVER ({groups}ORDER BY "{column}" {direction}, date) AS INTEGER) AS rank
        FROM months"""
        for name, column, direction in RANKINGS
    ]
    union = " UNION ALL ".join(branches)
    return f"WITH months AS ({source}) SELECT * FROM ({union}) WHERE rank <= {k}"


EVENT_READINGS = """
    SELECT ts, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM events"""


def hourly(source: str = EVENT_READINGS) -> str:
    return f"""
        SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type AS kind,
            {mean('value')} AS "mean-value", {mean('k')} AS k
        FROM ({source}) GROUP BY hour(ts), event_type"""


PROBABILITIES = (("min", 0.0), ("25-perc", 0.25), ("50-perc", 0.5), ("75-perc", 0.75), ("max", 1.0))


def percentile(p: float) -> str:
    """Linear interpolation at position p * (n - 1), in doubles, rounded HALF_UP.

    The detour through text rounds the digits that are shown: ``round`` of a double
    multiplies first and may lift a value that lies just below a tie.
    """
    at = f"{p}::DOUBLE * (n - 1)"
    below = f"max(v) FILTER (WHERE i = floor({at}))"
    above = f"max(v) FILTER (WHERE i = ceil({at}))"
    place = f"{p}::DOUBLE * (max(n) - 1)"
    value = f"""CASE WHEN floor({place}) = ceil({place}) THEN {below}
        ELSE (ceil({place}) - {place}) * {below} + ({place} - floor({place})) * {above} END"""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), 6) AS DOUBLE)"


def stats(source: str = EVENT_READINGS) -> str:
    percentiles = ", ".join(f'{percentile(p)} AS "{name}"' for name, p in PROBABILITIES)
    return f"""
        WITH hours AS ({hourly(source)}), long AS (
            SELECT kind, 'mean-value' AS data, "mean-value" AS v FROM hours
            UNION ALL SELECT kind, 'k', k FROM hours
        ), placed AS (
            SELECT kind, data, v,
                row_number() OVER (PARTITION BY kind, data ORDER BY v) - 1 AS i,
                count(*) OVER (PARTITION BY kind, data) AS n
            FROM long WHERE v IS NOT NULL
        )
        SELECT kind, data, {percentiles} FROM placed GROUP BY kind, data"""


# What the spoiled raw event lines hold.
RAW_TIME = f"""CASE WHEN {BAD_TIME} THEN 'bad'
    WHEN {T_TIME} THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""
RAW_VALUE = f"""CASE WHEN {WORD_VALUE} THEN 'abc' WHEN {EMPTY_VALUE} THEN NULL
    WHEN {NAN_VALUE} THEN 'nan' ELSE CAST(value AS VARCHAR) END"""
GOOD_TIME = f"NOT ({BAD_TIME} OR {T_TIME})"
GOOD_VALUE = f"NOT ({WORD_VALUE} OR {EMPTY_VALUE} OR {NAN_VALUE})"
GOOD_K = f"NOT ({SHORT_LINE})"
PER_METRIC = f"""
    SELECT date_trunc('second', ts) AS ts, event_type,
        CASE WHEN {GOOD_VALUE} THEN value END AS value, CASE WHEN {GOOD_K} THEN k END AS k
    FROM ({EVENT_READINGS}) WHERE {GOOD_TIME}"""
STRICT = f"SELECT * FROM ({PER_METRIC}) WHERE value IS NOT NULL AND k IS NOT NULL"
REASON = f"""CASE WHEN NOT ({GOOD_TIME}) THEN 'time' WHEN NOT ({GOOD_VALUE}) THEN 'value'
    WHEN NOT ({GOOD_K}) THEN 'k' END"""
REJECTS = f"""
    SELECT {RAW_TIME} AS ts, event_type, {RAW_VALUE} AS value,
        CASE WHEN {GOOD_K} THEN CAST(k AS VARCHAR) END AS k, {REASON} AS reason
    FROM ({EVENT_READINGS}) WHERE {REASON} IS NOT NULL"""
REPORT = f"""
    SELECT 'clean' AS verdict, event_type AS kind, CAST(year(ts) AS VARCHAR) AS year,
        '' AS reason, count(*) AS rows
    FROM ({STRICT}) GROUP BY event_type, year(ts)
    UNION ALL
    SELECT 'rejected', '', '', reason, count(*) FROM ({REJECTS}) GROUP BY reason"""


def ingested(source: str) -> str:
    return f"SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, k FROM ({source})"


def as_text(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), '')"


MEASURES = [f"{m}-{what}" for m in ("price", "discount") for what in ("mean", "min", "max")]


def yearly_records(source: str = "lineitem") -> str:
    fields = ", ".join(f'{as_text(chr(34) + c + chr(34))} AS {c.replace("-", "_")}' for c in MEASURES)
    return f"SELECT concat('Q1:', status, ':', year) AS key, {fields} FROM ({yearly(source)})"


RANKING_RECORDS = f"""
    SELECT concat('Q2:{ONE_STATUS}:', order_type, ':', rank) AS key, date,
        {as_text('"extended-price"')} AS price, {as_text('discount')} AS discount
    FROM ({top(MONTHLY, 5)})"""


def percentile_records(source: str = EVENT_READINGS) -> str:
    fields = ", ".join(f'{as_text(chr(34) + name + chr(34))} AS "{name}"' for name, _ in PROBABILITIES)
    return f"SELECT concat('Q3:', kind, ':', data) AS key, {fields} FROM ({stats(source)})"


UPSERTED = f"""
    SELECT key, coalesce(n.price_mean, o.price_mean) AS price_mean, o.price_min, o.price_max,
        coalesce(n.discount_mean, o.discount_mean) AS discount_mean, o.discount_min, o.discount_max
    FROM ({yearly_records()}) o
    LEFT JOIN ({yearly_records("(SELECT * FROM lineitem WHERE l_returnflag = 'R')")}) n USING (key)"""


def split_series(source: str, time: str, entity: str, value: str, labels: dict[str, str]) -> str:
    columns = ", ".join(
        f"max(\"{value}\") FILTER (WHERE {entity} = '{name}') AS \"{label}\""
        for name, label in labels.items()
    )
    return f"SELECT {time} AS time, {columns} FROM ({source}) GROUP BY {time}"


def single_series(value: str) -> str:
    return f"SELECT concat(date, '-01') AS time, \"{value}\" FROM ({MONTHLY})"


YEAR_TIME = "concat(year, '-01-01')"
HOUR_TIME = "concat(lpad(CAST(hour AS VARCHAR), 2, '0'), ':00:00')"


# Whole prices and a quarter: the sum is taken in whole numbers, the quarter added after the division.
WIDE = f"""
    SELECT year, status, CAST(whole // n AS DOUBLE) + round((whole % n) / n + 0.25, 6) AS "price-mean",
        low + 0.25 AS "price-min", high + 0.25 AS "price-max", "discount-mean", "discount-min", "discount-max"
    FROM (
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus AS status, count(*) AS n,
            sum(CAST(round_even(l_extendedprice * 1e9, 0) AS HUGEINT)) AS whole,
            min(round_even(l_extendedprice * 1e9, 0)) AS low, max(round_even(l_extendedprice * 1e9, 0)) AS high,
            {mean('l_discount')} AS "discount-mean", round(min(l_discount), 2) AS "discount-min",
            round(max(l_discount), 2) AS "discount-max"
        FROM lineitem GROUP BY year(l_shipdate), l_linestatus)"""
ZONED = f"SELECT ts + INTERVAL 2 HOUR AS ts, event_type, value, k FROM ({EVENT_READINGS})"
MISSING = f"""
    SELECT status, CAST(year AS INTEGER) AS year
    FROM (SELECT unnest({list(STATUS_LABELS)}) AS status), (SELECT unnest({EXPECTED_YEARS}) AS year)
    WHERE (status, year) NOT IN (SELECT (l_linestatus, year(l_shipdate)) FROM lineitem)"""


BUCKET = f"CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % {RECORD_BUCKETS}"
CHANGED = ", ".join(
    f"CASE WHEN key = '{UPDATED_KEY}' THEN {m}_mean || '!' ELSE {m}_mean END AS {m}_mean, {m}_min, {m}_max"
    for m in ("price", "discount")
)
TOUCHED = f"""
    SELECT key, CAST(CASE WHEN {BUCKET} = (SELECT {BUCKET} FROM (SELECT '{UPDATED_KEY}' AS key)) AND seen THEN 2 ELSE 1 END AS INTEGER)
        AS version, {CHANGED}
    FROM (SELECT *, bool_or(key = '{UPDATED_KEY}') OVER () AS seen FROM ({yearly_records()}))"""
MERGED = """
    SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, count(*) AS rows, 0 AS headers, 1 AS files
    FROM lineitem GROUP BY year(l_shipdate) UNION ALL SELECT 'year', 1, 1, 1"""


def oracle_sql() -> dict[str, str]:
    found = {}
    for face in ("df", "sql", "rdd"):
        found[f"q1_{face}"] = yearly()
        found[f"q2_all_{face}"] = MONTHLY
        found[f"q2_top_{face}"] = top(MONTHLY, 5)
        found[f"q3_hourly_{face}"] = hourly()
        found[f"q3_stats_{face}"] = stats()
    months = MONTHLY.replace("SELECT ", "SELECT l_linestatus AS status, ", 1)
    months = months.replace(f"WHERE l_linestatus = '{ONE_STATUS}'", "") + ", l_linestatus"
    found |= {
        "q1_union_by_name": yearly(),
        "q1_literal_entity": yearly("(SELECT *, 'all' AS name FROM lineitem)", "name"),
        "q3_union_all_sql": hourly(),
        "top_k_per_entity": top(months, 3, "status"),
        "row_counts": """
            SELECT l_linestatus AS status, CAST(year(l_shipdate) AS INTEGER) AS year,
                count(*) AS rows
            FROM lineitem GROUP BY l_linestatus, year(l_shipdate)""",
        "ingest_strict": ingested(STRICT),
        "ingest_per_metric": ingested(PER_METRIC),
        "ingest_rejects": REJECTS,
        "ingest_report": REPORT,
        "q3_hourly_csv": hourly(PER_METRIC),
        "q3_hourly_text_rdd": hourly(STRICT),
        "q3_stats_text_rdd": stats(STRICT),
        "dual_format_roundtrip": f"""
            SELECT *, 'csv' AS copy FROM ({yearly()})
            UNION ALL SELECT *, 'parquet' FROM ({yearly()})""",
        "result_roundtrip": yearly(),
        "top_roundtrip": top(MONTHLY, 5),
        "stats_roundtrip": stats(),
        "latest_run": f"SELECT *, '20240102000000' AS run FROM ({yearly()})",
        "single_csv_roundtrip": f"SELECT *, 1 AS files FROM ({MONTHLY})",
        "q1_records": yearly_records(),
        "q2_records": RANKING_RECORDS,
        "q3_records": percentile_records(),
        "records_upsert": UPSERTED,
        "series_yearly_a": split_series(yearly(), YEAR_TIME, "status", "price-mean", STATUS_LABELS),
        "series_yearly_b": split_series(
            yearly(), YEAR_TIME, "status", "discount-mean", STATUS_LABELS
        ),
        "series_monthly_a": single_series("extended-price"),
        "series_monthly_b": single_series("discount"),
        "series_hourly_a": split_series(hourly(), HOUR_TIME, "kind", "mean-value", KIND_LABELS),
        "series_hourly_b": split_series(hourly(), HOUR_TIME, "kind", "k", KIND_LABELS),
        "timing_summary": f"""
            SELECT l_returnflag AS query, l_linestatus AS api, count(*) AS runs,
                {mean('l_extendedprice', 2)} AS mean_seconds,
                round(coalesce(stddev_samp(l_extendedprice), 0), 2) AS stdev_seconds
            FROM lineitem GROUP BY l_returnflag, l_linestatus""",
        "run_times": """
            SELECT l_returnflag AS query, l_linestatus AS api,
                l_orderkey * 10 + l_linenumber AS run_no, round(l_extendedprice, 2) AS seconds
            FROM lineitem""",
        "full_run_df": hourly(STRICT),
        "full_run_sql": percentile_records(STRICT),
        "full_run_rdd": percentile_records(STRICT),
    }
    for face in ("df", "sql", "rdd"):
        found[f"full_run_q1_{face}"] = yearly() if face == "df" else yearly_records()
        found[f"full_run_q2_{face}"] = RANKING_RECORDS if face == "rdd" else top(MONTHLY, 5)
        found[f"wide_means_{face}"] = WIDE
    found |= {
        "q1_two_inputs_rdd": yearly(),
        "q3_hourly_zoned": hourly(ZONED),
        "records_backfill": yearly_records(),
        "ingest_missing_sources": MISSING,
        "ingest_two_layouts": """
            SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, l_linestatus, l_extendedprice, l_discount
            FROM lineitem""",
        "ingest_report_counted": REPORT,
        "full_run_gate": f"SELECT *, 0 AS results FROM ({MISSING})",
        "merged_csv": MERGED,
        "records_buckets": TOUCHED,
        "timing_report_roundtrip": f"SELECT *, runs AS listed FROM ({found['timing_summary']})",
    }
    found["source_inventory"] = found["row_counts"]
    found["source_files"] = """
        SELECT DISTINCT l_linestatus AS entity, CAST(year(l_shipdate) AS INTEGER) AS year
        FROM lineitem"""
    return found
