"""All checked results: name to Spark query, and name to SQL."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from callgrain.functions.calendar import first_monday, last_sunday
from callgrain.operators import visits as v
from callgrain.operators.categories import group_with_totals
from callgrain.operators.conversations import tag_conversations
from callgrain.operators.interactions import directed_interactions
from callgrain.params import FREQUENCIES, MORE_THAN_15, Calendar, FeatureParams, GroupSplit, Privacy
from callgrain.plans import indicators, jobs, regions
from callgrain.plans.features import FEATURES
from callgrain.sources import cdr as source
from callgrain.sources.sinks import land_cdr, land_with_quarantine, save, stage, staging_folder
from verification import feature_sql, mobility_sql as m
from verification.tables import (
    ANTENNAS_SQL, AS_OF, BURSTS_SQL, CDR_SQL, CELLS_SQL, PERIOD, antennas, bursts, cdr, cells, feature_inputs,
)

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame, as_double: tuple[str, ...] = ()) -> DataFrame:
    """Plain types that compare across engines: times as text, whole numbers as bigint, rounded doubles."""
    def plain(field: T.StructField):
        column = F.col(field.name)
        if field.name in as_double or isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(column.cast("double"), 6) + F.lit(0.0)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string")
        if isinstance(field.dataType, T.IntegralType):
            return column.cast("bigint")
        return column

    return df.select(*[plain(field).alias(field.name) for field in df.schema.fields])


def _long(name: str, records=cdr, split: GroupSplit | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = feature_inputs(spark, sf_dir, FeatureParams(split=split or GroupSplit()), records)
        return portable(FEATURES[name].long(inputs), ("median", "min", "max"))

    return query


def _wide(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = FEATURES[name].wide(feature_inputs(spark, sf_dir))
        return portable(df, tuple(c for c in df.columns if c != "caller_id"))

    return query


def _fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature job: tables by caller laid out, twenty tables written, and all of them side by side."""
    paths = jobs.write_features(cdr(spark, sf_dir), antennas(spark, sf_dir), _fresh_folder(spark, "features"), table=True)
    table = spark.read.parquet(paths[jobs.ALL_FEATURES])
    return portable(table, tuple(c for c in table.columns if c != "caller_id"))


def _job_folder(spark: SparkSession, *arguments: object) -> str:
    """One folder for all tables of a job in a session: called again, the job finds them there, unless its inputs have changed."""
    name = hashlib.sha256(repr((spark.sparkContext.applicationId, *arguments)).encode()).hexdigest()[:16]
    return f"{staging_folder(spark).rstrip('/')}/job-{name}"


def _mobility_job(name: str, by_subscriber: bool, publish: Privacy = MORE_THAN_15) -> Query:
    """A table of the job, which runs once in a session for all its tables."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _job_folder(spark, "mobility", sf_dir, by_subscriber, publish)
        paths = jobs.write_mobility(
            cdr(spark, sf_dir), cells(spark, sf_dir), folder, PERIOD, AS_OF, by_subscriber, publish=publish)
        return portable(spark.read.parquet(paths[name]))

    return query


def _region_job(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = jobs.write_regions(
            cdr(spark, sf_dir), cells(spark, sf_dir), _job_folder(spark, "regions", sf_dir), PERIOD, AS_OF)
        return portable(spark.read.parquet(paths[name]))

    return query


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.visits(cdr(spark, sf_dir))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.mapped_visits(_visits(spark, sf_dir), cells(spark, sf_dir))


def _presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.presence(_mapped(spark, sf_dir))


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.regional_visits(_visits(spark, sf_dir), cells(spark, sf_dir))


def _regional_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.presence(_regional(spark, sf_dir))


def _bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table that distinct subscribers of all frequencies come from."""
    return stage(indicators.subscriber_bitmaps(v.presence_per_hour(_regional(spark, sf_dir))), "bitmaps")


def _homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.home_locations(_presence(spark, sf_dir), PERIOD)


def _on(table: Callable, result: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: portable(result(table(spark, sf_dir), *args, **kwargs))


def _on_homes(result: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: portable(result(
        regions.with_homes(_presence(spark, sf_dir), PERIOD), None, *args, **kwargs))


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(indicators.origin_destination(_regional_presence(spark, sf_dir), PERIOD, "day", AS_OF))


def _matrix_by_subscriber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(indicators.origin_destination(
        _regional_presence(spark, sf_dir), PERIOD, "day", AS_OF, None, None, by_subscriber=True
    ))


def _enriched(split: GroupSplit, records=cdr, fill_ends: bool = True) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = records(spark, sf_dir)
        located = v.regional_visits(v.visits(found), cells(spark, sf_dir))
        mapped = v.mapped_visits(v.visits(found), cells(spark, sf_dir))
        homes = regions.home_locations(v.presence(mapped), PERIOD)
        return portable(indicators.enriched_visits(located, homes, split, 2 * found.count(), fill_ends))

    return query


def _tagged(split: GroupSplit, records=cdr) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tagged = tag_conversations(records(spark, sf_dir), FeatureParams(split=split)).select(
            "event_id", "caller_id", "recipient_id", "timestamp", "txn_type", "duration", "caller_antenna",
            "recipient_antenna", "weekday", "daytime", "direction", "wait", "conversation",
        )
        return portable(tagged, ("wait", "conversation"))

    return query


def _directed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(directed_interactions(cdr(spark, sf_dir), Calendar()))


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    directed = directed_interactions(cdr(spark, sf_dir), Calendar())
    return group_with_totals(directed, ["txn_type"], ["weekday", "daytime", "direction"], F.count(F.lit(1)).alias("n"))


def _some_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(source.filter_dates(cdr(spark, sf_dir), date(2024, 1, 8), date(2024, 1, 14)))


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = cdr(spark, sf_dir).agg(F.min("day").cast("date").alias("start"), F.max("day").cast("date").alias("end"))
    return portable(days.select(first_monday("start").alias("first_monday"), last_sunday("end").alias("last_sunday")))


def _full_week_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_visits(spark, sf_dir).where(PERIOD.full_weeks().covers("call_datetime")))


def _through_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as the text files the jobs start from, then read and cleaned."""
    folder = _fresh_folder(spark, "csv")
    text = cdr(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", source.TIMESTAMP_FORMAT))
    text.select(*source.CDR_COLUMNS).write.csv(folder, header=True)
    return portable(source.clean_cdr(source.read_cdr(spark, f"{folder}/*.csv")).drop("event_id"))


def _antennas_through_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _fresh_folder(spark, "csv")
    antennas(spark, sf_dir).write.csv(folder, header=True)
    return portable(source.read_antennas(spark, folder))


def _cells_through_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _fresh_folder(spark, "csv")
    table = cells(spark, sf_dir)
    table.select(F.col("cell_id").alias("Cell_ID_LAC"), F.col("region").alias("UA")).write.csv(folder, header=True)
    return source.read_cells(spark, folder)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _fresh_folder(spark, "landed")
    records = cdr(spark, sf_dir)
    land_cdr(records, folder)
    stored = spark.read.parquet(folder).withColumn("day", F.col("day").cast("timestamp"))
    return portable(stored.select(*records.columns))


def _saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _fresh_folder(spark, "saved")
    save(_homes(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def _spoilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 11th record gets an unreadable time, every 13th duration is no number or too large, every 17th id is missing."""
    return cdr(spark, sf_dir).withColumns({
        "timestamp": F.expr(f"if(event_id % 11 = 0, 'bad', date_format(timestamp, '{source.TIMESTAMP_FORMAT}'))"),
        "duration": F.expr("CASE event_id % 26 WHEN 0 THEN 'x' WHEN 13 THEN '1e15' ELSE CAST(duration AS string) END"),
        "caller_id": F.expr("if(event_id % 17 = 0, NULL, caller_id)"),
    })


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.rejects(_spoilt(spark, sf_dir))


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that cannot be landed, with the reasons."""
    rejected = land_with_quarantine(_spoilt(spark, sf_dir), _fresh_folder(spark, "landed"))[1]
    return rejected.select(
        "event_id", "caller_id", "timestamp", "duration", F.array_join("reasons", ",").alias("reasons"))


def _landed_beside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records landed in the same pass as the others are kept apart."""
    landed = land_with_quarantine(_spoilt(spark, sf_dir), _fresh_folder(spark, "landed"))[0]
    return portable(landed.select(*cdr(spark, sf_dir).columns))


RECORD = """event_id, caller_id, recipient_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, txn_type,
  round(duration, 6) AS duration, caller_antenna, recipient_antenna"""
DAY = "strftime(day, '%Y-%m-%d %H:%M:%S') AS day"
SMALL_GROUPS = GroupSplit(rows_per_group=25)
# Sizes and spans from a fifth of the rows.
SAMPLED_GROUPS = GroupSplit(rows_per_group=25, rows_to_see=5)
REGION_JOB = (
    "subscribers_per_region_per_day", "subscribers_per_region_per_week", "home_locations", "residents_per_region",
    "residents_per_region_per_day", "residents_per_region_per_week", "visitors_per_region_per_day",
    "visitors_per_region_per_week", "region_pairs_per_day", "directed_region_pairs_per_day", "calls_per_region_per_day",
)
CUT_FEATURES = (
    "interevent_time", "response_delay_text", "response_rate_text", "percent_initiated_conversations",
    "percent_pareto_durations",
)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "cdr_from_csv": _through_csv,
        "antennas_from_csv": _antennas_through_csv,
        "cells_from_csv": _cells_through_csv,
        "rejected_records": _rejects,
        "quarantined_records": _quarantined,
        "landed_beside_quarantine": _landed_beside,
        "filter_dates": _some_dates,
        "landed_cdr": _landed,
        "saved_home_locations": _saved,
        "full_week_bounds": _weeks,
        "directed_interactions": _directed,
        "category_totals": _repeated,
        "outgoing_visits": _on(cdr, v.outgoing_visits),
        "incoming_visits": _on(cdr, v.incoming_visits),
        "visits": lambda spark, sf_dir: portable(_visits(spark, sf_dir)),
        "full_week_visits": _full_week_visits,
        "regional_visits": lambda spark, sf_dir: portable(_regional(spark, sf_dir)),
        "tag_conversations": _tagged(GroupSplit()),
        "tag_conversations_cut": _tagged(SMALL_GROUPS),
    }
    found.update({name: _long(name) for name in FEATURES})
    found.update({f"{name}_wide": _wide(name) for name in FEATURES})
    found["all_features_wide"] = _all_features
    found.update({
        "subscribers_per_region_per_day": _on(_presence, regions.subscribers_per_region_per_day, AS_OF),
        "subscribers_per_region_per_day_at_least_80":
            _on(_presence, regions.subscribers_per_region_per_day, AS_OF, Privacy(80)),
        "home_locations": _homes,
        "residents_per_region_per_day": _on_homes(regions.residents_per_region_per_day),
        "visitors_per_region_per_day": _on_homes(regions.visitors_per_region_per_day, AS_OF),
        "visitors_per_region_per_day_exact":
            _on_homes(regions.visitors_per_region_per_day, AS_OF, threshold_inputs=False),
        "subscribers_per_region_per_week":
            _on(_presence, regions.subscribers_per_region_per_week, PERIOD.full_weeks()),
        "residents_per_region_per_week": _on_homes(regions.residents_per_region_per_week, PERIOD.full_weeks()),
        "visitors_per_region_per_week": _on_homes(regions.visitors_per_region_per_week, PERIOD.full_weeks()),
        "region_pairs_per_day": _on(_presence, regions.region_pairs_per_day, AS_OF),
        "directed_region_pairs_per_day": _on(_presence, regions.directed_region_pairs_per_day, AS_OF),
        "directed_region_pairs_per_day_by_subscriber":
            _on(_presence, regions.directed_region_pairs_per_day, AS_OF, None, by_subscriber=True),
        "calls_per_region_per_day": _on(_presence, regions.calls_per_region_per_day, AS_OF),
        "residents_per_region": lambda spark, sf_dir: regions.residents_per_region(_homes(spark, sf_dir)),
    })
    for frequency in FREQUENCIES:
        found[f"transactions_per_{frequency}"] = _on(_regional, indicators.transactions, PERIOD, frequency)
        found[f"unique_subscribers_per_{frequency}"] = _on(_regional, indicators.unique_subscribers, PERIOD, frequency)
        found[f"unique_subscribers_country_per_{frequency}"] = _on(
            _regional, indicators.unique_subscribers_country, PERIOD, frequency
        )
        found[f"home_regions_per_{frequency}"] = _on(_regional, indicators.home_regions, PERIOD, frequency)
        found[f"unique_subscribers_per_{frequency}_from_bitmaps"] = _on(
            _bitmaps, indicators.unique_from_bitmaps, PERIOD, frequency, Privacy(5, strict=True) if frequency == "hour" else MORE_THAN_15)
        found[f"unique_subscribers_country_per_{frequency}_from_bitmaps"] = _on(
            _bitmaps, indicators.unique_from_bitmaps, PERIOD, frequency, by_region=False)
    for frequency in ("day", "week", "month"):
        found[f"home_region_counts_per_{frequency}"] = _on(_regional, indicators.home_region_counts, PERIOD, frequency)
    found.update({
        "origin_destination_per_day": _matrix,
        "origin_destination_per_day_by_subscriber": _matrix_by_subscriber,
        "transactions_per_hour_by_subscriber":
            _on(_regional, indicators.transactions, PERIOD, "hour", None, by_subscriber=True),
        "transactions_per_hour_more_than_5":
            _on(_regional, indicators.transactions, PERIOD, "hour", Privacy(5, strict=True)),
        "unique_subscribers_per_hour_more_than_5":
            _on(_regional, indicators.unique_subscribers, PERIOD, "hour", Privacy(5, strict=True)),
        "unique_subscribers_per_hour_all": _on(_regional, indicators.unique_subscribers, PERIOD, "hour", None),
        "unique_subscribers_country_per_day_all":
            _on(_regional, indicators.unique_subscribers_country, PERIOD, "day", None),
        "enriched_visits": _enriched(GroupSplit()),
        "enriched_visits_cut": _enriched(SMALL_GROUPS),
        "enriched_visits_open_ends": _enriched(GroupSplit(), fill_ends=False),
        "enriched_visits_cut_sampled": _enriched(SAMPLED_GROUPS, bursts),
        "tag_conversations_cut_sampled": _tagged(SAMPLED_GROUPS, bursts),
        **{f"{name}_cut_sampled": _long(name, bursts, SAMPLED_GROUPS) for name in CUT_FEATURES},
        "mobility_job_origin_destination": _mobility_job("origin_destination_per_day", by_subscriber=False),
        "mobility_job_subscriber_homes": _mobility_job("subscriber_home_regions_per_day", by_subscriber=True),
        **{f"mobility_job_{name}": _mobility_job(name, False, Privacy(5, strict=True)) for name in m.JOB},
        **{f"mobility_job_by_subscriber_{name}": _mobility_job(name, True) for name in m.SUBSCRIBER_JOB},
        **{f"region_job_{name}": _region_job(name) for name in REGION_JOB},
    })
    return found


def oracle_sql() -> dict[str, str]:
    with_cdr = feature_sql.with_clause(CDR_SQL)
    with_mirrored = feature_sql.with_clause(*feature_sql.BASE)
    with_visits = feature_sql.with_clause(CDR_SQL, m.VISITS_SQL)
    tagged = feature_sql.with_clause(*feature_sql.BASE, feature_sql.TAGGED_SQL) + f"""
SELECT {RECORD}, weekday, daytime, direction, CAST(wait AS DOUBLE) AS wait, CAST(conversation AS DOUBLE) AS conversation
FROM tagged"""
    found = {
        "cdr_from_csv": with_cdr + f"SELECT {RECORD.removeprefix('event_id, ')}, {DAY} FROM cdr",
        "antennas_from_csv": feature_sql.with_clause(ANTENNAS_SQL)
            + "SELECT antenna_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM antennas",
        "cells_from_csv": feature_sql.with_clause(CELLS_SQL) + "SELECT cell_id, region FROM cells",
        "rejected_records": with_cdr + """
SELECT count(*) AS records, count(*) FILTER (event_id % 17 = 0) AS without_ids,
  count(*) FILTER (event_id % 11 = 0) AS bad_timestamp, count(*) FILTER (event_id % 13 = 0) AS bad_duration FROM cdr""",
        "quarantined_records": with_cdr + """
SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN caller_id END AS caller_id,
  CASE WHEN event_id % 11 = 0 THEN 'bad' ELSE strftime(timestamp, '%Y-%m-%d %H:%M:%S') END AS timestamp,
  CASE event_id % 26 WHEN 0 THEN 'x' WHEN 13 THEN '1e15' ELSE CAST(duration AS VARCHAR) END AS duration,
  concat_ws(',', CASE WHEN event_id % 11 = 0 THEN 'timestamp' END, CASE WHEN event_id % 13 = 0 THEN 'duration' END) AS reasons
FROM cdr WHERE event_id % 11 = 0 OR event_id % 13 = 0""",
        "landed_beside_quarantine": with_cdr + f"""
SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN caller_id END AS caller_id, {RECORD.removeprefix('event_id, caller_id, ')}, {DAY}
FROM cdr WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""",
        "filter_dates": with_cdr + f"""
SELECT {RECORD}, {DAY} FROM cdr WHERE timestamp >= DATE '2024-01-08' AND timestamp < DATE '2024-01-15'""",
        "landed_cdr": with_cdr + f"SELECT {RECORD}, {DAY} FROM cdr",
        "saved_home_locations": m.REGIONS["home_locations"],
        "full_week_bounds": with_cdr + """
SELECT CAST(min(day) FILTER (isodow(day) = 1) AS DATE)::VARCHAR AS first_monday,
  CAST(max(day) FILTER (isodow(day) = 7) AS DATE)::VARCHAR AS last_sunday FROM cdr""",
        "directed_interactions": with_mirrored + f"SELECT {RECORD}, {DAY}, weekday, daytime, direction FROM mirrored",
        "category_totals": feature_sql.with_clause(*feature_sql.NINE) + """
SELECT weekday, daytime, x.direction, txn_type, count(*) AS n
FROM cells9 t, unnest([t.direction, 'alldir']) AS x(direction) GROUP BY ALL""",
        "outgoing_visits": with_cdr + f"""
SELECT {m.VISIT_COLUMNS} FROM (SELECT caller_id AS msisdn, timestamp AS call_datetime, caller_antenna AS location_id,
  CAST(timestamp AS DATE) AS call_date, event_id FROM cdr) WHERE location_id IS NOT NULL""",
        "incoming_visits": with_cdr + f"""
SELECT {m.VISIT_COLUMNS} FROM (SELECT recipient_id AS msisdn, timestamp AS call_datetime, recipient_antenna AS location_id,
  CAST(timestamp AS DATE) AS call_date, event_id FROM cdr) WHERE location_id IS NOT NULL""",
        "visits": with_visits + f"SELECT {m.VISIT_COLUMNS} FROM calls",
        "full_week_visits": with_visits + f"SELECT {m.VISIT_COLUMNS} FROM calls WHERE {m.WEEKS}",
        "regional_visits": feature_sql.with_clause(*m.REGIONAL) + f"SELECT {m.VISIT_COLUMNS}, region FROM regional",
        "tag_conversations": tagged,
        "tag_conversations_cut": tagged,
        **feature_sql.LONG,
        **{f"{name}_wide": feature_sql.wide(name) for name in FEATURES},
        "all_features_wide": feature_sql.all_wide(list(FEATURES)),
        **m.REGIONS,
        **m.INDICATORS,
        **{f"{name}_from_bitmaps": m.INDICATORS[f"{name}_more_than_5" if name == "unique_subscribers_per_hour" else name]
           for f in FREQUENCIES for name in (f"unique_subscribers_per_{f}", f"unique_subscribers_country_per_{f}")},
        "enriched_visits_cut": m.ENRICHED,
        "enriched_visits_open_ends": m.ENRICHED_OPEN_ENDS,
        "enriched_visits_cut_sampled": m.ENRICHED.replace(CDR_SQL, BURSTS_SQL),
        "tag_conversations_cut_sampled": tagged.replace(CDR_SQL, BURSTS_SQL),
        **{f"{name}_cut_sampled": feature_sql.LONG[name].replace(CDR_SQL, BURSTS_SQL) for name in CUT_FEATURES},
        "mobility_job_origin_destination": m.INDICATORS["origin_destination_per_day"],
        "mobility_job_subscriber_homes": m.INDICATORS["home_regions_per_day"],
        **{f"mobility_job_{name}": text for name, text in m.JOB.items()},
        **{f"mobility_job_by_subscriber_{name}": text for name, text in m.SUBSCRIBER_JOB.items()},
        **{f"region_job_{name}": m.REGIONS[name] for name in REGION_JOB},
    }
    return {name: found[name] for name in queries()}
