"""SQL for the subscriber features, written from their definitions: every record is mirrored, then
repeated under each total, then grouped. Each query yields the long form of a feature."""

from __future__ import annotations

from itertools import product

from verification.tables import ANTENNAS_SQL, CDR_SQL

# The labels of the wide tables' column names, and the categories and values of each feature, written out
# here so that a wrong label in the library shows.
LABELS = {
    "weekday": ("weekday", "weekend", "allweek"), "daytime": ("day", "night", "allday"),
    "direction": ("in", "out", "alldir"), "txn_type": ("call", "text"),
}
STATISTICS = ("mean", "std", "median", "skewness", "kurtosis", "min", "max")
CELL, TYPED = ("weekday", "daytime"), ("weekday", "daytime", "txn_type")
CATEGORIES = {
    "active_days": CELL, "number_of_contacts": TYPED, "call_duration": TYPED, "percent_nocturnal": ("weekday", "txn_type"),
    "percent_initiated_conversations": CELL, "percent_initiated_interactions": CELL, "response_delay_text": CELL,
    "response_rate_text": CELL, "entropy_of_contacts": TYPED, "balance_of_contacts": TYPED, "interactions_per_contact": TYPED,
    "interevent_time": TYPED, "percent_pareto_interactions": TYPED, "percent_pareto_durations": CELL,
    "number_of_interactions": ("direction", *TYPED), "number_of_antennas": CELL, "entropy_of_antennas": CELL,
    "frequent_antennas": CELL, "percent_at_home": CELL, "radius_of_gyration": CELL,
}
WITH_STATISTICS = {
    "call_duration", "response_delay_text", "balance_of_contacts", "interactions_per_contact", "interevent_time",
}

MIRRORED_SQL = """
labelled AS (
  SELECT *, CASE WHEN dayofweek(day) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS weekday,
    CASE WHEN hour(timestamp) >= 7 AND hour(timestamp) < 19 THEN 'day' ELSE 'night' END AS daytime
  FROM cdr WHERE caller_id IS NOT NULL AND recipient_id IS NOT NULL),
mirrored AS (
  SELECT event_id, caller_id, recipient_id, timestamp, day, txn_type, duration, caller_antenna, recipient_antenna,
    weekday, daytime, 'out' AS direction, epoch_us(timestamp) // 1000000 AS second FROM labelled
  UNION ALL
  SELECT event_id, recipient_id, caller_id, timestamp, day, txn_type, duration, recipient_antenna, caller_antenna,
    weekday, daytime, 'in', epoch_us(timestamp) // 1000000 FROM labelled)"""

TAGGED_SQL = """
gaps AS (
  SELECT *, lag(txn_type) OVER w AS before, second - lag(second) OVER w AS wait FROM mirrored
  WINDOW w AS (PARTITION BY caller_id, recipient_id ORDER BY timestamp, event_id, direction)),
openings AS (
  SELECT *, CASE WHEN txn_type = 'text' AND (before = 'call' OR before IS NULL OR wait >= 3600) THEN second END AS opening
  FROM gaps),
tagged AS (
  SELECT * EXCLUDE (before, opening),
    CASE WHEN txn_type = 'text' THEN last_value(opening IGNORE NULLS) OVER (
      PARTITION BY caller_id, recipient_id ORDER BY timestamp, event_id, direction
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS conversation
  FROM openings)"""


def repeated(table: str, name: str = "cells9") -> str:
    """Each row under its own labels and under the totals."""
    return f"""
{name} AS (
  SELECT t.* EXCLUDE (weekday, daytime), w.weekday, d.daytime FROM {table} t,
    unnest([t.weekday, 'allweek']) AS w(weekday), unnest([t.daytime, 'allday']) AS d(daytime))"""


def with_clause(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (CDR_SQL, MIRRORED_SQL)
NINE = (*BASE, repeated("mirrored"))


def statistics(ctes: tuple[str, ...], keys: str, value: str, source: str, mean: str = "avg(x)") -> str:
    """The seven statistics of `value`, from centred values."""
    centred = f"""
centred AS (
  SELECT *, x - avg(x) OVER (PARTITION BY {keys}) AS d FROM (SELECT {keys}, {value} AS x FROM {source}))"""
    return with_clause(*ctes, centred) + f"""
SELECT {keys}, round({mean}, 6) + 0.0 AS mean, round(sqrt(sum(d * d) / count(x)), 6) + 0.0 AS std,
  round(CAST(quantile_disc(x, 0.5) AS DOUBLE), 6) + 0.0 AS median,
  CASE WHEN max(x) > min(x) THEN round(sqrt(count(x)) * sum(d * d * d) / pow(sum(d * d), 1.5), 6) + 0.0 END AS skewness,
  CASE WHEN max(x) > min(x) THEN round(count(x) * sum(d * d * d * d) / pow(sum(d * d), 2) - 3, 6) + 0.0 END AS kurtosis,
  round(CAST(min(x) AS DOUBLE), 6) + 0.0 AS min, round(CAST(max(x) AS DOUBLE), 6) + 0.0 AS max
FROM centred GROUP BY {keys}"""


# Durations have two decimals, so their means often end in a 5 that rounding must treat alike.
EXACT_MEAN = "CAST(sum(CAST(x AS DECIMAL(20, 6))) AS DOUBLE) / count(x)"
CELL = "caller_id, weekday, daytime"
TYPED = f"{CELL}, txn_type"


def per_contact(keys: str = TYPED, source: str = "cells9") -> str:
    return f"""
contacts AS (
  SELECT {keys}, recipient_id, count(*) AS n, count(*) FILTER (direction = 'out') AS n_out, sum(duration) AS seconds
  FROM {source} GROUP BY {keys}, recipient_id)"""


PER_ANTENNA = f"""
per_antenna AS (SELECT {CELL}, caller_antenna, count(*) AS n FROM cells9 GROUP BY {CELL}, caller_antenna)"""


def entropy(keys: str, source: str) -> str:
    return f"""
SELECT {keys}, round(-sum(share * ln(share)), 6) + 0.0 AS value
FROM (SELECT {keys}, n / sum(n) OVER (PARTITION BY {keys}) AS share FROM {source}) GROUP BY {keys}"""


def pareto(keys: str, value: str, source: str, result: str) -> str:
    """Ranked one by one, with the running share of the total."""
    return f"""
SELECT {keys}, {result} AS value FROM (
  SELECT {keys}, place, CAST(sum(v) OVER (PARTITION BY {keys} ORDER BY place) AS DOUBLE)
    / nullif(CAST(sum(v) OVER (PARTITION BY {keys}) AS DOUBLE), 0) AS reached
  FROM (SELECT {keys}, {value} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY {value} DESC NULLS LAST) AS place
        FROM {source}))
GROUP BY {keys}"""


SHARE_OF_ITEMS = "round(min(place) FILTER (reached >= 0.8) / count(*), 6) + 0.0"


def share(keys: str, condition: str, source: str) -> str:
    return f"SELECT {keys}, round(avg(CASE WHEN {condition} THEN 1 ELSE 0 END), 6) + 0.0 AS value FROM {source} GROUP BY {keys}"


DELAYS = f"""
texts AS (
  SELECT *, lag(direction) OVER (PARTITION BY caller_id, recipient_id, conversation
    ORDER BY timestamp, event_id, direction) AS before FROM tagged WHERE txn_type = 'text'),
delays AS (SELECT *, CASE WHEN direction = 'out' AND before = 'in' THEN wait END AS delay FROM texts)"""

ANSWERED = """
answered AS (
  SELECT *, max(CASE WHEN direction = 'out' THEN 1 ELSE 0 END)
    OVER (PARTITION BY caller_id, recipient_id, conversation) AS responded FROM tagged WHERE txn_type = 'text')"""

WAITS = f"""
waits AS (
  SELECT *, second - lag(second) OVER (PARTITION BY {TYPED} ORDER BY timestamp) AS gap FROM cells9)"""

HOMES = """
nights AS (
  SELECT caller_id, caller_antenna, count(*) AS n FROM mirrored
  WHERE daytime = 'night' AND caller_antenna IS NOT NULL GROUP BY 1, 2),
homes AS (
  SELECT caller_id, caller_antenna AS home FROM nights
  QUALIFY row_number() OVER (PARTITION BY caller_id ORDER BY n DESC, caller_antenna) = 1),
placed AS (SELECT * FROM cells9 JOIN homes USING (caller_id) WHERE caller_antenna IS NOT NULL)"""

DISTANCES = f"""
located AS (
  SELECT {CELL}, latitude, longitude,
    avg(latitude) OVER (PARTITION BY {CELL}) AS bar_lat, avg(longitude) OVER (PARTITION BY {CELL}) AS bar_lon
  FROM cells9 JOIN antennas ON caller_antenna = antenna_id WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
distances AS (
  SELECT {CELL}, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(latitude - bar_lat) / 2), 2)
    + cos(radians(latitude)) * cos(radians(bar_lat)) * pow(sin(radians(longitude - bar_lon) / 2), 2)))) AS km
  FROM located)"""

LONG = {
    "active_days": with_clause(*NINE) + f"SELECT {CELL}, count(DISTINCT day) AS value FROM cells9 GROUP BY {CELL}",
    "number_of_contacts":
        with_clause(*NINE) + f"SELECT {TYPED}, count(DISTINCT recipient_id) AS value FROM cells9 GROUP BY {TYPED}",
    "call_duration": statistics(NINE, TYPED, "duration", "cells9 WHERE txn_type = 'call'", EXACT_MEAN),
    "percent_nocturnal": with_clause(*BASE) + """
SELECT caller_id, w.weekday, txn_type, round(avg(CASE WHEN daytime = 'night' THEN 1 ELSE 0 END), 6) + 0.0 AS value
FROM mirrored t, unnest([t.weekday, 'allweek']) AS w(weekday) GROUP BY 1, 2, 3""",
    "percent_initiated_conversations": with_clause(*BASE, TAGGED_SQL, repeated("tagged"))
        + share(CELL, "direction = 'out'", "cells9 WHERE conversation = second"),
    "percent_initiated_interactions":
        with_clause(*NINE) + share(CELL, "direction = 'out'", "cells9 WHERE txn_type = 'call'"),
    "response_delay_text": statistics((*BASE, TAGGED_SQL, DELAYS, repeated("delays")), CELL, "delay", "cells9"),
    "response_rate_text": with_clause(*BASE, TAGGED_SQL, ANSWERED, repeated("answered"))
        + share(CELL, "responded = 1", "cells9 WHERE conversation = second AND direction = 'in'"),
    "entropy_of_contacts": with_clause(*NINE, per_contact()) + entropy(TYPED, "contacts"),
    "balance_of_contacts": statistics((*NINE, per_contact()), TYPED, "n_out / n", "contacts"),
    "interactions_per_contact": statistics((*NINE, per_contact()), TYPED, "n", "contacts"),
    "interevent_time": statistics((*NINE, WAITS), TYPED, "gap", "waits"),
    "percent_pareto_interactions": with_clause(*NINE, per_contact()) + pareto(TYPED, "n", "contacts", SHARE_OF_ITEMS),
    "percent_pareto_durations": with_clause(*NINE, per_contact(CELL, "cells9 WHERE txn_type = 'call'"))
        + pareto(CELL, "CAST(seconds AS DECIMAL(30, 6))", "contacts", SHARE_OF_ITEMS),
    "number_of_interactions": with_clause(*NINE) + f"""
SELECT {TYPED}, x.direction, count(*) AS value
FROM cells9 t, unnest([t.direction, 'alldir']) AS x(direction) GROUP BY {TYPED}, x.direction""",
    "number_of_antennas":
        with_clause(*NINE) + f"SELECT {CELL}, count(DISTINCT caller_antenna) AS value FROM cells9 GROUP BY {CELL}",
    "entropy_of_antennas": with_clause(*NINE, PER_ANTENNA) + entropy(CELL, "per_antenna"),
    "frequent_antennas":
        with_clause(*NINE, PER_ANTENNA) + pareto(CELL, "n", "per_antenna", "min(place) FILTER (reached >= 0.8)"),
    "percent_at_home": with_clause(*NINE, HOMES) + share(CELL, "caller_antenna = home", "placed"),
    "radius_of_gyration": with_clause(*NINE, ANTENNAS_SQL, DISTANCES)
        + f"SELECT {CELL}, round(sqrt(sum(km * km) / count(*)), 6) + 0.0 AS value FROM distances GROUP BY {CELL}",
}


def wide_columns(name: str) -> list[tuple[str, str]]:
    """Column name and expression of each cell of a feature."""
    types = ("call",) if name == "call_duration" else LABELS["txn_type"]
    categories = CATEGORIES[name]
    columns = []
    for labels in product(*[types if c == "txn_type" else LABELS[c] for c in categories]):
        where = " AND ".join(f"{c} = '{label}'" for c, label in zip(categories, labels))
        for value in STATISTICS if name in WITH_STATISTICS else ("value",):
            column = "_".join([name, *labels, *([value] if name in WITH_STATISTICS else [])])
            columns.append((column, f'max(CAST("{value}" AS DOUBLE)) FILTER ({where})'))
    return columns


def wide(name: str) -> str:
    columns = ",\n  ".join(f"{expression} AS {column}" for column, expression in wide_columns(name))
    return f"SELECT caller_id,\n  {columns}\nFROM ({LONG[name]}) GROUP BY caller_id"


def all_wide(names: list[str]) -> str:
    joined = f"({wide(names[0])})"
    for name in names[1:]:
        joined += f"\nFULL JOIN ({wide(name)}) USING (caller_id)"
    return f"SELECT * FROM {joined}"
