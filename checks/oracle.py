"""The same questions in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from wattfold.config import DEFAULT_GAPS

STORED = (60, 120)
IDS = {
    "house": ["house_id"],
    "household": ["house_id", "household_id"],
    "device": ["house_id", "household_id", "device_id"],
}
NOW = "TIMESTAMP '2024-01-31 00:00:00'"

READINGS = """
readings AS (
  SELECT event_id AS id, epoch_us(ts) // 1000000 AS timestamp, value,
         (CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)::INTEGER AS property,
         (user_id // 15)::INTEGER AS plug_id,
         ((user_id // 5) % 3)::INTEGER AS household_id,
         (user_id % 5)::INTEGER AS house_id,
         event_type
  FROM events)"""


def half_up(expr, places=6):
    return f"floor(({expr}) * 1e{places} + 5.01e-1) / 1e{places}"


def r(expr, name, places=6):
    return f"{half_up(expr, places)} AS {name}"


def date(s):
    return f"strftime(make_timestamp(({s}) * 1000000), '%Y-%m-%d')"


def index(s, gap="slice_gap"):
    return f"((({s}) % 86400) // ({gap} * 60))::INTEGER"


PARTS = f"slice_gap, {date('s')} AS slice_date, {index('s')} AS slice_index"


def cols(level):
    return ", ".join(IDS[level])


def gaps_cte(gaps=DEFAULT_GAPS):
    return f"gaps AS (SELECT unnest({list(gaps)})::INTEGER AS slice_gap)"


def slices_cte(gaps=DEFAULT_GAPS, source="readings", suffix=""):
    return f"""
device{suffix} AS (
  SELECT house_id, household_id, plug_id AS device_id, slice_gap,
         (timestamp // (slice_gap * 60)) * (slice_gap * 60) AS s,
         sum(round(value * 100))::BIGINT AS cents, count(*)::DOUBLE AS n, cents / 1e2 AS total, total / n AS avg
  FROM {source}, gaps WHERE property = 1 GROUP BY ALL),
household{suffix} AS (
  SELECT house_id, household_id, slice_gap, s, sum(avg) AS avg FROM device{suffix} GROUP BY ALL),
house{suffix} AS (
  SELECT house_id, slice_gap, s, sum(avg) AS avg FROM device{suffix} GROUP BY ALL)"""


def sql(body, *ctes, gaps=DEFAULT_GAPS):
    parts = [READINGS, gaps_cte(gaps), slices_cte(), *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def running_cte(level):
    ids = cols(level)
    return f"""
running_{level} AS (
  SELECT *, coalesce(min(nullif(avg, 0)) OVER w, 0.0::DOUBLE) AS prior_min,
         coalesce(sum(avg) OVER w / nullif(count(nullif(avg, 0)) OVER w, 0), 0.0::DOUBLE) AS prior_avg,
         coalesce(max(avg) OVER w, 0.0::DOUBLE) AS prior_max,
         count(nullif(avg, 0)) OVER w AS prior_count
  FROM {level}
  WINDOW w AS (PARTITION BY {ids}, slice_gap ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def alerts_cte(level):
    shown = f"{cols(level)}, slice_gap, s, avg AS value, prior_min AS min, prior_avg AS avg, prior_max AS max"
    return (
        running_cte(level)
        + f""",
alert_{level} AS (
  SELECT 1::INTEGER AS type, {shown} FROM running_{level}
  WHERE prior_max <> 0 AND avg - prior_max >= prior_max * 20 / 100
  UNION ALL
  SELECT 0::INTEGER, {shown} FROM running_{level}
  WHERE prior_avg <> 0 AND avg - prior_avg >= prior_avg * 20 / 100
  UNION ALL
  SELECT (-1)::INTEGER, {shown} FROM running_{level}
  WHERE prior_min <> 0 AND prior_min - avg >= prior_min * 20 / 100)"""
    )


def baseline_sql(level):
    return f"""
  SELECT {cols(level)}, slice_gap, {r('coalesce(min(nullif(avg, 0)), 0)', 'min')},
         {r('coalesce(avg(nullif(avg, 0)), 0)', 'avg')}, {r('coalesce(max(avg), 0)', 'max')},
         count(nullif(avg, 0)) AS count
  FROM {level} GROUP BY {cols(level)}, slice_gap"""


ALERT = ", ".join(r(c, c) for c in ("value", "min", "avg", "max"))


def forecast_cte(level, name="said"):
    """v0 by its definition: a slice joined to its older slices at the target's time of day."""
    ids = cols(level)
    same = " AND ".join(f"h.{c} = c.{c}" for c in [*IDS[level], "slice_gap"])
    mine = ", ".join(f"c.{c}" for c in IDS[level])
    return f"""
{name} AS (
  SELECT 'v0' AS version, {ids}, slice_gap, s + 2 * slice_gap * 60 AS s, coalesce(m, 0) AS median,
         CASE WHEN m > 0 THEN (avg + m) / 2 ELSE avg END AS avg, history
  FROM (
    SELECT {mine}, c.slice_gap, c.s, c.avg, median(h.avg) AS m, count(h.avg) AS history
    FROM {level} c LEFT JOIN {level} h ON {same} AND h.s < c.s
      AND h.s % 86400 = (c.s + 2 * c.slice_gap * 60) % 86400
    GROUP BY {mine}, c.slice_gap, c.s, c.avg))"""


def windowed_cte(version, name):
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    by = {
        "v1": ("house", "house_id, slice_gap"),
        "v2": ("chained", "house_id, slice_gap, s % 604800, chain"),
        "v3": ("house", "house_id, slice_gap, s % 86400"),
    }[version]
    return f"""
{name} AS (
  SELECT '{version}' AS version, house_id, slice_gap, s + 2 * slice_gap * 60 AS s, coalesce(m, 0) AS median,
         CASE WHEN m > 0 THEN (avg + m) / 2 ELSE avg END AS avg, history
  FROM (
    SELECT *, median(avg) OVER w AS m, count(avg) OVER w AS history FROM {by[0]}
    WINDOW w AS (PARTITION BY {by[1]} ORDER BY s {earlier})))"""


CHAINED = """
chained AS (
  SELECT *, row_number() OVER (PARTITION BY house_id, slice_gap, s % 604800, chain ORDER BY s)::INTEGER AS chain_week
  FROM (
    SELECT *, s // 604800 - row_number() OVER (
      PARTITION BY house_id, slice_gap, s % 604800 ORDER BY s) AS chain
    FROM house))"""


def said_out(level):
    return f"""
  SELECT version, {cols(level)}, {PARTS}, {r('avg', 'avg')}, {r('median', 'median')}, history FROM said"""


def score_sql(versions, where=""):
    union = " UNION ALL ".join(f"SELECT version, house_id, slice_gap, s, avg FROM said_{v}" for v in versions)
    names = ", ".join(f"'{v}'" for v in versions)
    return f"""
  , f AS ({union}), v AS (SELECT unnest([{names}]) AS version),
  a AS (SELECT version, house_id, slice_gap, s, avg FROM house, v),
  both_ AS (SELECT *, 0 AS is_f FROM a UNION ALL SELECT *, 1 FROM f),
  stat AS (
    SELECT version, slice_gap, sum(is_f)::BIGINT AS count, avg(avg) AS mean, var_samp(avg) AS variance,
           stddev_samp(avg) AS standard_deviation
    FROM both_ GROUP BY version, slice_gap),
  err AS (
    SELECT version, slice_gap, avg((a.avg - f.avg) ** 2) AS e
    FROM a JOIN f USING (version, house_id, slice_gap, s) GROUP BY version, slice_gap)
  SELECT version, slice_gap, count, {r('mean', 'mean', 4)}, {r('variance', 'variance', 4)},
         {r('standard_deviation', 'standard_deviation', 4)}, {r('e / variance', 'mse', 4)}
  FROM stat LEFT JOIN err USING (version, slice_gap) {where}"""


CLOCK = """(lpad(((s % 86400) // 3600)::VARCHAR, 2, '0') || ':' || lpad(((s % 3600) // 60)::VARCHAR, 2, '0')
  || '->' || lpad(((s % 86400 + slice_gap * 60) // 3600)::VARCHAR, 2, '0')
  || ':' || lpad((((s % 86400 + slice_gap * 60) % 3600) // 60)::VARCHAR, 2, '0'))"""
SLASH = "strftime(make_timestamp(s * 1000000), '%Y/%m/%d')"
SLICE_ID = f"({date('s')} || '-' || {index('s')} || '-' || slice_gap)"

AGE = """(CASE WHEN age < 2 THEN 'Just now'
  WHEN age < 60 THEN age || ' second(s) ago'
  WHEN age < 3600 THEN (age // 60) || ' minute(s) ago'
  WHEN age < 86400 THEN (age // 3600) || ' hour(s) ago'
  ELSE (age // 86400) || ' day(s) ago' END)"""

BASE_VALUE = "(CASE type WHEN -1 THEN min WHEN 0 THEN avg ELSE max END)"


def fixed(expr):
    return f"printf('%.2f', {expr} + 1e-9)"


CHANGE = f"""((CASE WHEN value - {BASE_VALUE} < 0 THEN '' ELSE '+' END) || {fixed(f'(value - {BASE_VALUE})')} || 'W ('
  || {fixed(f'(value - {BASE_VALUE}) * 100 / {BASE_VALUE}')} || '%)')"""

ROUNDED_ALERT = "type, {ids}, slice_gap, s, " + ", ".join(r(c, c) for c in ("value", "min", "avg", "max"))


def three_levels(select):
    return " UNION ALL ".join(select(level) for level in IDS)


def all_alerts(body, gaps=(60,)):
    ctes = [alerts_cte(level) for level in IDS]
    ctes += [
        f"a_{level} AS (SELECT {ROUNDED_ALERT.format(ids=cols(level))} FROM alert_{level})" for level in IDS
    ]
    return sql(body, *ctes, gaps=gaps)


def topics_sql(gaps=(60,)):
    def keys(level):
        named = {"house_id": "houseId", "household_id": "householdId", "device_id": "deviceId"}
        return " || ".join(f"'\"{named[c]}\":' || {c} || ','" for c in IDS[level])

    def select(level):
        topics = ["'home/house-' || house_id || '-notification'"]
        if level != "house":
            topics.append("'home/household-' || house_id || '-' || household_id || '-notification'")
        if level == "device":
            topics.append(
                "'home/device-' || house_id || '-' || household_id || '-' || device_id || '-notification'"
            )
        topics.append("'home/iot-notification'")
        doubles = " || ".join(f"'\"{c}\":' || {c} || ','" for c in ("min", "max", "avg", "value"))
        stamp = "strftime(make_timestamp(s * 1000000), '\"year\":\"%Y\",\"month\":\"%m\",\"day\":\"%d\",')"
        value = (
            f"'{{\"type\":' || type || ',' || {keys(level)} || {doubles} || {stamp} || "
            f"'\"sliceIndex\":' || {index('s')} || ',\"sliceGap\":' || slice_gap || '}}'"
        )
        return f"SELECT unnest([{', '.join(topics)}]) AS topic, {value} AS value FROM a_{level}"

    return all_alerts(three_levels(select), gaps)


def messages_sql(gaps=(60,)):
    subjects = {
        "device": "'Device ' || device_id || ' of household ' || household_id || ' of house ' || house_id",
        "household": "'Household ' || household_id || ' of house ' || house_id",
        "house": "'House ' || house_id",
    }
    words = "(CASE type WHEN -1 THEN 'under utilized' WHEN 0 THEN 'use more power than usual' ELSE 'over utilized' END)"
    figure = "(CASE type WHEN -1 THEN 'Min' WHEN 0 THEN 'Average' ELSE 'Max' END)"

    def select(level):
        return f"""
  SELECT '{level.capitalize()} ' || {words} AS title,
         {subjects[level]} || ' ' || {words} || chr(10) || {figure} || ': ' || {fixed(BASE_VALUE)} || ' (W)' || chr(10)
         || 'Value: ' || {fixed('value')} || ' (W) (' || {CHANGE} || ')' || chr(10)
         || 'Time: ' || {SLASH} || ' ' || {CLOCK} || ' (' || {AGE} || ')' AS body
  FROM (SELECT *, epoch_us({NOW}) // 1000000 - (s + slice_gap * 60) AS age FROM a_{level})"""

    return all_alerts(three_levels(select), gaps)


def change_sql(gaps=(60,)):
    def select(level):
        return f"""
  SELECT '{level}' AS level, type, house_id, {date('s')} AS slice_date, {index('s')} AS slice_index,
         {CHANGE} AS change FROM a_{level}"""

    return all_alerts(three_levels(select), gaps)


def history_sql(condition):
    return sql(f"""
  , latest AS (SELECT house_id, slice_gap, max(s) AS request_start FROM house GROUP BY ALL)
  SELECT house_id, {PARTS}, request_start, {r('avg', 'avg')}
  FROM house JOIN latest USING (house_id, slice_gap) WHERE s <= request_start AND {condition}""")


def weekly_sql():
    # Walk back a week at a time from each request until a week is missing.
    ctes = [READINGS, gaps_cte(), slices_cte()]
    return "WITH RECURSIVE " + ",\n".join(ctes) + f""",
latest AS (SELECT house_id, slice_gap, max(s) AS request_start FROM house GROUP BY ALL),
walk AS (
  SELECT h.house_id, h.slice_gap, h.s, h.avg, request_start, 0 AS weeks_back
  FROM house h JOIN latest l ON h.house_id = l.house_id AND h.slice_gap = l.slice_gap AND h.s = l.request_start
  UNION ALL
  SELECT h.house_id, h.slice_gap, h.s, h.avg, w.request_start, w.weeks_back + 1
  FROM walk w JOIN house h ON h.house_id = w.house_id AND h.slice_gap = w.slice_gap AND h.s = w.s - 604800)
SELECT house_id, {PARTS}, request_start, weeks_back::INTEGER AS weeks_back, {r('avg', 'avg')} FROM walk"""


def export_sql():
    labels = [f"{h:02d}:00->{h + 1:02d}:00" for h in range(24)]
    wide = ", ".join(
        r(f"max(avg) FILTER ({index('s')} = {i})", f'"{label}"', 4) for i, label in enumerate(labels)
    )
    return sql(
        f"""
  SELECT house_id, {date('s')} AS slice_date, count(*) AS count, {wide}, {r('avg(avg)', 'mean', 4)},
         {r('var_pop(avg)', 'variance', 4)}, {r('stddev_pop(avg)', 'standard_deviation', 4)}
  FROM house GROUP BY house_id, {date('s')}""",
        gaps=(60,),
    )


def tree_sql():
    def node(level):
        path = " || '-' || ".join(IDS[level])
        parent = " || '-' || ".join(IDS[level][:-1]) or "''"
        if len(IDS[level]) == 2:
            parent = "house_id::VARCHAR"
        if level == "house":
            path = "house_id::VARCHAR"
        return f"SELECT DISTINCT '{level}' AS level, {path} AS node, {parent} AS parent, {SLASH} AS text FROM device"

    return sql(
        f"""
  SELECT level, node, parent,
         '[' || string_agg('{{"year":"' || text[1:4] || '","month":"' || text[6:7] || '","day":"' || text[9:10]
           || '","text":"' || text || '"}}', ',' ORDER BY text) || ']' AS dates
  FROM ({three_levels(node)}) GROUP BY level, node, parent"""
    )


def dates_sql(level):
    stamp = "make_timestamp(s * 1000000)"
    return sql(
        f"""
  SELECT DISTINCT {cols(level)}, strftime({stamp}, '%Y') AS year, strftime({stamp}, '%m') AS month,
         strftime({stamp}, '%d') AS day, {SLASH} AS date_text FROM {level}"""
    )


READING = "id, timestamp, value, property, plug_id, household_id, house_id"
TOPIC = "(CASE WHEN event_type = 'error' THEN 'iot-errors' ELSE 'iot-data' END)"
DEVICE_OUT = f"{cols('device')}, {PARTS}, {r('total', 'value')}, {r('n', 'count')}, {r('avg', 'avg')}"


def slice_out(level):
    return f"SELECT {cols(level)}, {PARTS}, {r('avg', 'avg')} FROM {level}"


def alert_out(level):
    return f"SELECT type, {cols(level)}, {PARTS}, {ALERT} FROM alert_{level}"


def build() -> dict[str, str]:
    plain = f"WITH {READINGS} "
    decoded = plain + f"SELECT {READING} FROM readings WHERE property = 1"
    day = "make_timestamp(s * 1000000)"
    q = {
        "decode_readings": decoded,
        "decode_quarantine": plain
        + "SELECT id || ',notatime,' || value || ',' || property || ',' || plug_id || ',' || household_id || ',' "
        "|| house_id AS message FROM readings WHERE property <> 1",
        "load_only": decoded,
        "ingest_stream": decoded,
        "drop_repeats_stream": decoded,
        "ingest_feed_stream": plain + f"SELECT {TOPIC} AS topic, {READING} FROM readings",
        "union_topics": plain + f"SELECT {TOPIC} AS topic, {READING} FROM readings",
        "ingest_rate": plain
        + f"""SELECT {TOPIC} AS topic, timestamp // 10 * 10 AS interval_start, count(*) AS total,
  count(*) FILTER (property = 1) AS load, {r('count(*) / 10', 'total_speed')},
  {r('count(*) FILTER (property = 1) / 10', 'load_speed')} FROM readings GROUP BY 1, 2""",
        "ingest_rollup": plain
        + f""", m AS (
  SELECT *, {TOPIC} AS topic, timestamp > (SELECT max(timestamp) FROM readings) - 86400 AS waits FROM readings),
 t AS (
  SELECT topic, timestamp // 10 * 10 AS i, count(*) AS total, count(*) FILTER (property = 1) AS load
  FROM m WHERE NOT waits AND id % 5 <> 0 GROUP BY 1, 2),
 f AS (
  SELECT topic, max(i) >= (SELECT max(timestamp) FROM m WHERE NOT waits AND id % 5 <> 0) - 3600 AS connect,
         arg_max(total, i) / 10 AS ts, arg_max(load, i) / 10 AS ls, sum(load)::BIGINT AS load FROM t GROUP BY topic),
 c AS (
  SELECT topic, count(*) FILTER (NOT waits) AS total, count(*) FILTER (waits) AS queue,
         count(*) FILTER (NOT waits AND id % 5 <> 0) AS success, count(*) FILTER (NOT waits AND id % 5 = 0) AS fail
  FROM m GROUP BY topic)
 SELECT bool_and(coalesce(connect, false)) AS connect, {r('sum(coalesce(ts, 0))', 'total_speed')},
   {r('sum(coalesce(ls, 0))', 'load_speed')}, sum(total)::BIGINT AS total, sum(coalesce(load, 0))::BIGINT AS load,
   sum(queue)::BIGINT AS queue, sum(success)::BIGINT AS success, sum(fail)::BIGINT AS fail
 FROM c LEFT JOIN f USING (topic)""",
        "assign_slice": plain
        + f"SELECT id, 15::INTEGER AS slice_gap, {date('timestamp')} AS slice_date, "
        f"{index('timestamp', '15')} AS slice_index FROM readings",
        "multi_window": plain
        + f", {gaps_cte()} SELECT id, slice_gap, {date('timestamp')} AS slice_date, {index('timestamp')} AS slice_index "
        "FROM readings, gaps",
        "slice_labels": sql(
            f"SELECT house_id, {SLICE_ID} AS slice_id, {SLASH} || ' ' || {CLOCK} AS slice_label, "
            f"{SLASH} AS date_label FROM house"
        ),
        "parse_slice_id": sql(f"SELECT house_id, {SLICE_ID} AS slice_id, {PARTS} FROM house"),
        "next_slice": sql(
            f"SELECT house_id, {PARTS}, strftime({day} + to_minutes(2 * slice_gap), '%Y-%m-%d') AS next_date, "
            f"{index('s + 2 * slice_gap * 60')} AS next_index FROM house"
        ),
        "entity_keys": sql(
            "SELECT house_id || '-' || household_id || '-' || device_id AS device_key, "
            "house_id || '-' || household_id AS household_key, house_id::VARCHAR AS house_key, "
            f"house_id || '-' || household_id || '-' || device_id || '-' || {SLICE_ID} AS device_slice_key FROM device"
        ),
        "device_slices": sql(f"SELECT {DEVICE_OUT} FROM device"),
        "device_slices_stream": sql(f"SELECT {DEVICE_OUT} FROM device", gaps=STORED),
        "household_slices": sql(slice_out("household")),
        "house_slices": sql(slice_out("house")),
        "hierarchy_rollup": sql(
            f"SELECT 'household' AS level, house_id, household_id, {PARTS}, {r('avg', 'avg')} FROM household "
            f"UNION ALL SELECT 'house', house_id, -1, {PARTS}, {r('avg', 'avg')} FROM house"
        ),
        "stale_slices": plain
        + f""", {gaps_cte()}, t AS (
  SELECT slice_gap, timestamp // (slice_gap * 60) * (slice_gap * 60) AS s, house_id, household_id,
         max(timestamp) AS last FROM readings, gaps WHERE property = 1 GROUP BY ALL),
 n AS (SELECT max(timestamp) AS now FROM readings WHERE property = 1),
 h AS (SELECT slice_gap, s, house_id, max(last) AS last FROM t GROUP BY ALL),
 idle AS (
  SELECT slice_gap, s FROM h, n WHERE last < now - slice_gap * 300
  INTERSECT SELECT slice_gap, s FROM t, n WHERE last < now - slice_gap * 300)
 SELECT {PARTS} FROM idle""",
        "load_baselines": sql(baseline_sql("house")),
        "upsert_baselines": sql(baseline_sql("device"), gaps=STORED),
        "attach_baseline": sql(f"""
  , b AS (
    SELECT house_id, slice_gap, min(nullif(avg, 0)) AS mn, avg(nullif(avg, 0)) AS av, max(avg) AS mx,
           count(nullif(avg, 0)) AS n FROM house WHERE day({day}) <= 15 GROUP BY ALL)
  SELECT house_id, {PARTS}, {r('avg', 'avg')}, {r('coalesce(mn, 0)', 'prior_min')},
         {r('coalesce(av, 0)', 'prior_avg')}, {r('coalesce(mx, 0)', 'prior_max')}, coalesce(n, 0) AS prior_count
  FROM house LEFT JOIN b USING (house_id, slice_gap)"""),
        "record_breakers": sql(alert_out("house") + " WHERE type = 1", alerts_cte("house"), gaps=(120,)),
        "alert_topics": topics_sql(),
        "alert_change": change_sql(),
        "alert_messages": messages_sql(),
        "time_ago": plain
        + f"SELECT id, {AGE} AS age FROM (SELECT id, epoch_us({NOW}) // 1000000 - timestamp AS age FROM readings)",
        "batch_metrics": sql(
            "SELECT level, slice_gap, sum(k)::BIGINT AS slices_saved, sum(a)::BIGINT AS alerts_raised FROM ("
            + " UNION ALL ".join(
                f"SELECT '{level}' AS level, slice_gap, 1 AS k, 0 AS a FROM {level} "
                f"UNION ALL SELECT '{level}', slice_gap, 0, 1 FROM alert_{level}"
                for level in IDS
            )
            + ") GROUP BY level, slice_gap",
            *[alerts_cte(level) for level in IDS],
        ),
        "forecast_score": sql(
            score_sql(("v0", "v2", "v3")),
            forecast_cte("house", "said_v0"),
            CHAINED,
            windowed_cte("v2", "said_v2"),
            windowed_cte("v3", "said_v3"),
        ),
        "get_forecast_score": sql(score_sql(("v0",), "WHERE slice_gap = 60"), forecast_cte("house", "said_v0")),
        "upsert_scores": sql(score_sql(("v0",)), forecast_cte("house", "said_v0"), gaps=STORED),
        "actual_vs_forecast": sql(
            f"""
  SELECT house_id, {PARTS},
         row_number() OVER (PARTITION BY house_id, slice_gap ORDER BY s) - 1 AS position,
         {r('coalesce(a.avg, 0)', 'actual')}, {r('coalesce(f.avg, 0)', 'forecast')}
  FROM house a FULL JOIN said f USING (house_id, slice_gap, s)""",
            forecast_cte("house"),
        ),
        "series_stats": sql(
            f"SELECT house_id, slice_gap, count(avg) AS count, {r('avg(avg)', 'mean', 4)}, "
            f"{r('var_pop(avg)', 'variance', 4)}, {r('stddev_pop(avg)', 'standard_deviation', 4)} "
            "FROM house GROUP BY house_id, slice_gap"
        ),
        "history_same_day": history_sql("s // 86400 = request_start // 86400"),
        "history_all": history_sql("true"),
        "history_same_index": history_sql("s % 86400 = request_start % 86400"),
        "history_weekly": weekly_sql(),
        "weekly_chains": sql(f"SELECT house_id, {PARTS}, chain_week FROM chained", CHAINED),
        "query_slices": sql(slice_out("house") + f" WHERE slice_gap = 60 AND month({day}) = 1 AND year({day}) = 2024"),
        "query_slices_household": sql(slice_out("household") + " WHERE house_id = 2 AND household_id = 1"),
        "query_slices_device": sql(
            slice_out("device") + " WHERE house_id = 0 AND household_id = 0 AND device_id = 0 AND slice_gap = 20"
        ),
        "query_week": sql(slice_out("house") + f" WHERE slice_gap = 30 AND day({day}) BETWEEN 8 AND 14"
                          f" AND month({day}) = 1 AND year({day}) = 2024"),
        "query_forecast": sql(
            f"SELECT house_id, household_id, {PARTS}, {r('avg', 'avg')} FROM said "
            f"WHERE household_id = 1 AND slice_gap = 60 AND month({day}) = 1",
            forecast_cte("household"),
        ),
        "query_forecast_week": sql(
            f"SELECT house_id, {PARTS}, {r('avg', 'avg')} FROM said WHERE slice_gap = 120 "
            f"AND day({day}) BETWEEN 15 AND 21 AND month({day}) = 1 AND year({day}) = 2024",
            forecast_cte("house"),
        ),
        "export_wide": export_sql(),
        "meta_gaps": sql("SELECT DISTINCT slice_gap FROM house"),
        "meta_tree": tree_sql(),
        "upsert_slices": sql(slice_out("household"), gaps=STORED),
        "upsert_forecasts": sql(
            f"SELECT version, house_id, {PARTS}, {r('avg', 'avg')} FROM said", forecast_cte("house"), gaps=STORED
        ),
        "upsert_alerts": sql(alert_out("house"), alerts_cte("house"), gaps=STORED),
        "alerts_stream": sql(alert_out("house"), alerts_cte("house"), gaps=STORED),
        "flush_stream": sql(
            f"SELECT version, house_id, household_id, {PARTS}, {r('avg', 'avg')} FROM said",
            forecast_cte("household"),
            gaps=STORED,
        ),
        "late_data_stream": plain
        + f""", wrong AS (
  SELECT *, epoch_us(ts + INTERVAL 40 YEARS) // 1000000 AS ahead FROM events
  WHERE event_type IN ('view', 'click') ORDER BY event_id LIMIT 1),
 loads AS (
  SELECT house_id, household_id, plug_id, value, timestamp, event_type IN ('view', 'click') AS first
  FROM readings WHERE property = 1
  UNION ALL SELECT house_id, household_id, plug_id, wrong.value, ahead, true FROM wrong JOIN readings ON id = event_id),
 mark AS (
  SELECT house_id, household_id, plug_id, max(timestamp) - 600 * 60 AS wm FROM loads WHERE first GROUP BY ALL)
 SELECT house_id, household_id, plug_id AS device_id, timestamp // 60 * 60 AS slice_start,
        {r('sum(value)', 'total')}, count(*) AS count
 FROM loads LEFT JOIN mark USING (house_id, household_id, plug_id)
 WHERE first OR wm IS NULL OR timestamp // 60 * 60 + 60 > wm GROUP BY ALL""",
    }
    pages = {
        "device": "LIMIT 10",
        "household": "LIMIT 20 OFFSET 10",
        "house": "LIMIT 10",
    }
    for level in IDS:
        ids = cols(level)
        where = "WHERE house_id = 2" if level == "house" else ""
        q[f"baselines_{level}"] = sql(baseline_sql(level))
        q[f"running_baseline_{level}"] = sql(
            f"SELECT {ids}, {PARTS}, {r('avg', 'avg')}, {r('prior_min', 'prior_min')}, {r('prior_avg', 'prior_avg')}, "
            f"{r('prior_max', 'prior_max')}, prior_count FROM running_{level}",
            running_cte(level),
        )
        q[f"alerts_{level}"] = sql(alert_out(level), alerts_cte(level))
        q[f"alerts_page_{level}"] = sql(
            f"SELECT * EXCLUDE (s) FROM (SELECT type, {ids}, {PARTS}, {ALERT}, s FROM alert_{level} {where} "
            f"ORDER BY s + slice_gap * 60 DESC, slice_gap, {ids}, type {pages[level]})",
            alerts_cte(level),
        )
        q[f"forecast_v0_{level}"] = sql(said_out(level), forecast_cte(level))
        q[f"meta_{level}_dates"] = dates_sql(level)
        q[f"upsert_slices_{level}"] = sql(slice_out(level))
        q[f"upsert_baselines_{level}"] = sql(baseline_sql(level))
        q[f"upsert_forecasts_{level}"] = q[f"flush_stream_{level}"] = sql(
            f"SELECT version, {ids}, {PARTS}, {r('avg', 'avg')} FROM said", forecast_cte(level)
        )
        q[f"upsert_alerts_{level}"] = q[f"alerts_stream_{level}"] = q[f"alerts_{level}"]
    q["score_job"] = q["forecast_score"]
    q["upsert_scores_all_gaps"] = sql(score_sql(("v0",)), forecast_cte("house", "said_v0"))
    q["device_slices_stream_all_gaps"] = q["device_slices"]
    q["alert_topics_all_gaps"] = topics_sql(DEFAULT_GAPS)
    q["alert_change_all_gaps"] = change_sql(DEFAULT_GAPS)
    q["alert_messages_all_gaps"] = messages_sql(DEFAULT_GAPS)
    for version in ("v1", "v2", "v3"):
        ctes = [CHAINED] if version == "v2" else []
        q[f"forecast_{version}_house"] = sql(said_out("house"), *ctes, windowed_cte(version, "said"))
    return q
