"""SQL for visits, regional aggregates and mobility indicators, written from their definitions."""

from __future__ import annotations

from verification.feature_sql import with_clause
from verification.tables import CDR_SQL, CELLS_SQL

START, END, AS_OF = "DATE '2024-01-01'", "DATE '2024-01-30'", "DATE '2024-01-31'"
# Whole weeks of the period: Monday 1 to Sunday 28 January.
WEEKS = "call_date >= DATE '2024-01-01' AND call_date <= DATE '2024-01-28'"
IN_PERIOD = f"call_datetime >= {START} AND call_datetime < DATE '2024-01-31'"
UP_TO_DATE = f"call_date >= {START} AND call_date <= {AS_OF}"

VISITS_SQL = """
sides AS (
  SELECT caller_id AS msisdn, timestamp AS call_datetime, caller_antenna AS location_id, CAST(timestamp AS DATE) AS call_date,
    event_id FROM cdr WHERE caller_antenna IS NOT NULL
  UNION ALL
  SELECT recipient_id, timestamp, recipient_antenna, CAST(timestamp AS DATE), event_id
  FROM cdr WHERE recipient_antenna IS NOT NULL),
calls AS (SELECT * FROM sides WHERE length(msisdn) >= 20)"""

MAPPED_SQL = "\nmapped AS (SELECT calls.*, region FROM calls JOIN cells ON location_id = cell_id)"
REGIONAL_SQL = """
regional AS (
  SELECT calls.*, coalesce(region, '99999') AS region, date_trunc('hour', call_datetime) AS hour,
    date_trunc('day', call_datetime) AS day, date_trunc('week', call_datetime) AS week, date_trunc('month', call_datetime) AS month
  FROM calls LEFT JOIN cells ON location_id = cell_id)"""

HOMES_SQL = f"""
last_of_day AS (
  SELECT msisdn, region, call_date FROM mapped WHERE call_date >= {START} AND call_date <= {END}
  QUALIFY row_number() OVER (PARTITION BY msisdn, call_date ORDER BY call_datetime DESC, region) = 1),
times AS (SELECT msisdn, region, count(*) AS total, max(call_date) AS latest FROM last_of_day GROUP BY 1, 2),
homes AS (
  SELECT msisdn, region FROM times
  QUALIFY row_number() OVER (PARTITION BY msisdn ORDER BY total DESC, latest DESC, region) = 1)"""

BASE = (CDR_SQL, CELLS_SQL, VISITS_SQL, MAPPED_SQL)
REGIONAL = (CDR_SQL, CELLS_SQL, VISITS_SQL, REGIONAL_SQL)


def per_day(name: str, where: str, source: str = "mapped", least: int | None = 15) -> str:
    return f"""
{name} AS (
  SELECT call_date AS visit_date, region, count(DISTINCT msisdn) AS subscriber_count
  FROM {source} WHERE {where} GROUP BY 1, 2 {f"HAVING count(DISTINCT msisdn) >= {least}" if least else ""})"""


def per_week(name: str, source: str = "mapped", least: int | None = 15) -> str:
    return f"""
{name} AS (
  SELECT CAST(weekofyear(call_date) AS BIGINT) AS visit_week, region, count(DISTINCT msisdn) AS subscriber_count
  FROM {source} WHERE {WEEKS} GROUP BY 1, 2 {f"HAVING count(DISTINCT msisdn) >= {least}" if least else ""})"""


RESIDENT_VISITS = "\nat_home AS (SELECT mapped.* FROM mapped JOIN homes ON mapped.msisdn = homes.msisdn AND mapped.region = homes.region)"
DAY_KEYS = "CAST(visit_date AS VARCHAR) AS visit_date, region, CAST(subscriber_count AS BIGINT) AS subscriber_count"


def day_visitors(inner: int | None, least: int) -> str:
    return with_clause(
        *BASE, HOMES_SQL, RESIDENT_VISITS, per_day("everyone", UP_TO_DATE, least=inner),
        per_day("residents", "true", "at_home", inner),
    ) + f"""
SELECT CAST(e.visit_date AS VARCHAR) AS visit_date, e.region,
  e.subscriber_count - coalesce(r.subscriber_count, 0) AS subscriber_count
FROM everyone e LEFT JOIN residents r ON e.visit_date = r.visit_date AND e.region = r.region
WHERE e.subscriber_count - coalesce(r.subscriber_count, 0) >= {least}"""


PAIRS = f"""
spans AS (
  SELECT msisdn, call_date, region, min(call_datetime) AS earliest, max(call_datetime) AS latest
  FROM mapped WHERE {UP_TO_DATE} GROUP BY 1, 2, 3),
directed AS (
  SELECT a.call_date AS connection_date, a.msisdn, a.region AS region_from, b.region AS region_to
  FROM spans a JOIN spans b ON a.msisdn = b.msisdn AND a.call_date = b.call_date
  WHERE a.region <> b.region AND a.earliest < b.latest)"""

MOVES = f"""
steps AS (
  SELECT *, lag(region) OVER w AS region_lag, lag(call_datetime) OVER w AS datetime_lag, lag(call_date) OVER w AS date_lag
  FROM regional WHERE {IN_PERIOD}
  WINDOW w AS (PARTITION BY msisdn ORDER BY call_datetime, region)),
moves AS (
  SELECT msisdn, call_date AS connection_date, region_lag AS region_from, region AS region_to FROM steps
  WHERE region_lag <> region AND call_date > date_lag
    AND epoch_us(call_datetime) // 1000000 - epoch_us(datetime_lag) // 1000000 <= 7 * 24 * 60 * 60)"""


def origin_destination(keys: str, pair_least: int | None, move_more: int | None) -> str:
    selected = keys.replace("connection_date", "CAST(connection_date AS VARCHAR) AS connection_date")
    return with_clause(*BASE, REGIONAL_SQL, PAIRS, MOVES, f"""
within_days AS (
  SELECT {keys}, count(*) AS subscriber_count FROM directed GROUP BY {keys}
  {f"HAVING count(*) >= {pair_least}" if pair_least else ""})""", f"""
between_days AS (
  SELECT {keys}, count(msisdn) AS od_count FROM moves GROUP BY {keys}
  {f"HAVING count(msisdn) > {move_more}" if move_more else ""})""") + f"""
SELECT {selected}, coalesce(subscriber_count, 0) AS subscriber_count, coalesce(od_count, 0) AS od_count,
  coalesce(subscriber_count, 0) + coalesce(od_count, 0) AS total_count
FROM within_days FULL JOIN between_days USING ({keys})"""


def time_key(frequency: str) -> str:
    return f"strftime({frequency}, '%Y-%m-%d %H:%M:%S') AS {frequency}"


def counts(frequency: str, measure: str, keys: str = "region", more_than: int | None = 15) -> str:
    keys = f", {keys}" if keys else ""
    return with_clause(*REGIONAL) + f"""
SELECT {time_key(frequency)}{keys}, {measure} AS count FROM regional WHERE {IN_PERIOD}
GROUP BY {frequency}{keys} {f"HAVING {measure} > {more_than}" if more_than is not None else ""}"""


def home_regions_ctes(frequency: str) -> str:
    return f"""
ends AS (
  SELECT *, CASE WHEN call_datetime = max(call_datetime) OVER (PARTITION BY msisdn, day) THEN 1 ELSE 0 END AS is_last
  FROM regional WHERE {IN_PERIOD}),
tallies AS (
  SELECT msisdn, {frequency}, region, sum(is_last) AS n, max(call_datetime) AS latest FROM ends GROUP BY 1, 2, 3),
home_regions AS (
  SELECT msisdn, {frequency}, region AS home_region FROM tallies
  QUALIFY row_number() OVER (PARTITION BY msisdn, {frequency} ORDER BY n DESC, latest DESC, region) = 1)"""


def home_regions(frequency: str) -> str:
    return with_clause(*REGIONAL, home_regions_ctes(frequency)) + f"""
SELECT msisdn, {time_key(frequency)}, home_region FROM home_regions"""


def home_region_counts(frequency: str, more_than: int = 15) -> str:
    return with_clause(*REGIONAL, home_regions_ctes(frequency)) + f"""
SELECT {time_key(frequency)}, home_region, count(*) AS count FROM home_regions
GROUP BY {frequency}, home_region HAVING count(*) > {more_than}"""


VISIT_COLUMNS = "msisdn, strftime(call_datetime, '%Y-%m-%d %H:%M:%S') AS call_datetime, location_id, CAST(call_date AS VARCHAR) AS call_date, event_id"
ENRICHED = with_clause(*BASE, HOMES_SQL, REGIONAL_SQL, """
neighbours AS (
  SELECT *, lag(region) OVER w AS region_lag, lead(region) OVER w AS region_lead,
    lag(call_datetime) OVER w AS call_datetime_lag, lead(call_datetime) OVER w AS call_datetime_lead
  FROM regional WINDOW w AS (PARTITION BY msisdn ORDER BY call_datetime, event_id, location_id, region))""") + f"""
SELECT n.{VISIT_COLUMNS}, n.region, homes.region AS home_region, coalesce(region_lag, '99999') AS region_lag,
  coalesce(region_lead, '99999') AS region_lead,
  strftime(call_datetime_lag, '%Y-%m-%d %H:%M:%S') AS call_datetime_lag,
  strftime(call_datetime_lead, '%Y-%m-%d %H:%M:%S') AS call_datetime_lead,
  CAST(hour(call_datetime) AS BIGINT) AS hour_of_day, {time_key("hour")}, {time_key("day")}, {time_key("week")},
  {time_key("month")}, CAST(1 AS BIGINT) AS constant
FROM neighbours n LEFT JOIN homes ON n.msisdn = homes.msisdn"""

ENRICHED_OPEN_ENDS = ENRICHED.replace(
    "coalesce(region_lag, '99999') AS region_lag", "region_lag").replace(
    "coalesce(region_lead, '99999') AS region_lead", "region_lead")

# The tables of the mobility job, published above 5.
JOB = {
    "transactions_per_hour": counts("hour", "count(*)", more_than=5),
    "unique_subscribers_country_per_day": counts("day", "count(DISTINCT msisdn)", "", 5),
    "origin_destination_per_day": origin_destination("connection_date, region_from, region_to", 15, 5),
    "home_regions_per_month": home_region_counts("month", 5),
    "unique_subscribers_per_hour": counts("hour", "count(DISTINCT msisdn)", more_than=5),
}
SUBSCRIBER_JOB = {
    "transactions_per_hour": counts("hour", "count(*)", "region, msisdn", None),
    "unique_subscribers_country_per_day": counts("day", "count(DISTINCT msisdn)", "", None),
    "origin_destination_per_day": origin_destination("connection_date, msisdn, region_from, region_to", None, None),
    "home_regions_per_month": home_region_counts("month"),
    "unique_subscribers_per_hour": counts("hour", "count(DISTINCT msisdn)", "region", None),
    "subscriber_home_regions_per_day": home_regions("day"),
}

REGIONS = {
    "subscribers_per_region_per_day": with_clause(*BASE, per_day("x", UP_TO_DATE)) + f"SELECT {DAY_KEYS} FROM x",
    "subscribers_per_region_per_day_at_least_80":
        with_clause(*BASE, per_day("x", UP_TO_DATE, least=80)) + f"SELECT {DAY_KEYS} FROM x",
    "home_locations": with_clause(*BASE, HOMES_SQL) + "SELECT msisdn, region FROM homes",
    "residents_per_region_per_day":
        with_clause(*BASE, HOMES_SQL, RESIDENT_VISITS, per_day("x", "true", "at_home")) + f"SELECT {DAY_KEYS} FROM x",
    "visitors_per_region_per_day": day_visitors(15, 15),
    "visitors_per_region_per_day_exact": day_visitors(None, 15),
    "subscribers_per_region_per_week": with_clause(*BASE, per_week("x")) + "SELECT * FROM x",
    "residents_per_region_per_week":
        with_clause(*BASE, HOMES_SQL, RESIDENT_VISITS, per_week("x", "at_home")) + "SELECT * FROM x",
    "visitors_per_region_per_week":
        with_clause(*BASE, HOMES_SQL, RESIDENT_VISITS, per_week("everyone"), per_week("residents", "at_home")) + """
SELECT e.visit_week, e.region, e.subscriber_count - coalesce(r.subscriber_count, 0) AS subscriber_count
FROM everyone e LEFT JOIN residents r ON e.visit_week = r.visit_week AND e.region = r.region
WHERE e.subscriber_count - coalesce(r.subscriber_count, 0) >= 15""",
    "region_pairs_per_day": with_clause(*BASE, PAIRS) + """
SELECT CAST(a.call_date AS VARCHAR) AS connection_date, a.region AS region1, b.region AS region2, count(*) AS subscriber_count
FROM spans a JOIN spans b ON a.msisdn = b.msisdn AND a.call_date = b.call_date WHERE a.region < b.region
GROUP BY 1, 2, 3 HAVING count(*) >= 15""",
    "directed_region_pairs_per_day": with_clause(*BASE, PAIRS) + """
SELECT CAST(connection_date AS VARCHAR) AS connection_date, region_from, region_to, count(*) AS subscriber_count
FROM directed GROUP BY 1, 2, 3 HAVING count(*) >= 15""",
    "directed_region_pairs_per_day_by_subscriber": with_clause(*BASE, PAIRS) + """
SELECT CAST(connection_date AS VARCHAR) AS connection_date, msisdn, region_from, region_to, count(*) AS subscriber_count
FROM directed GROUP BY 1, 2, 3, 4""",
    "calls_per_region_per_day": with_clause(*BASE) + f"""
SELECT CAST(call_date AS VARCHAR) AS call_date, region, count(*) AS total_calls FROM mapped WHERE {UP_TO_DATE}
GROUP BY 1, 2 HAVING count(DISTINCT msisdn) >= 15""",
    "residents_per_region": with_clause(*BASE, HOMES_SQL) + """
SELECT region, count(msisdn) AS subscriber_count FROM homes GROUP BY 1 HAVING count(msisdn) >= 15""",
}

INDICATORS = {
    **{f"transactions_per_{f}": counts(f, "count(*)") for f in ("hour", "day", "week", "month")},
    **{f"unique_subscribers_per_{f}": counts(f, "count(DISTINCT msisdn)") for f in ("hour", "day", "week", "month")},
    **{f"unique_subscribers_country_per_{f}": counts(f, "count(DISTINCT msisdn)", "") for f in ("hour", "day", "week", "month")},
    **{f"home_regions_per_{f}": home_regions(f) for f in ("hour", "day", "week", "month")},
    **{f"home_region_counts_per_{f}": home_region_counts(f) for f in ("day", "week", "month")},
    "origin_destination_per_day": origin_destination("connection_date, region_from, region_to", 15, 15),
    "origin_destination_per_day_by_subscriber":
        origin_destination("connection_date, msisdn, region_from, region_to", None, None),
    "transactions_per_hour_by_subscriber": counts("hour", "count(*)", "region, msisdn", None),
    "transactions_per_hour_more_than_5": counts("hour", "count(*)", more_than=5),
    "unique_subscribers_per_hour_more_than_5": counts("hour", "count(DISTINCT msisdn)", more_than=5),
    "unique_subscribers_per_hour_all": counts("hour", "count(DISTINCT msisdn)", "region", None),
    "unique_subscribers_country_per_day_all": counts("day", "count(DISTINCT msisdn)", "", None),
    "enriched_visits": ENRICHED,
}
