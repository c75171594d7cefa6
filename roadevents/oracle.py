"""DuckDB SQL for the registered queries, written from the meaning of each query.

``ev`` is the incident view, ``txt`` its landed text form, ``dirty`` the text form with
missing-value markers and bad values.
"""

from __future__ import annotations

_EV = """ev AS (
  SELECT event_id,
    CASE user_id % 5 WHEN 0 THEN '고속도로' WHEN 1 THEN '국도' WHEN 2 THEN '지방도'
      WHEN 3 THEN '시군도' END AS type,
    CASE event_type WHEN 'error' THEN '교통사고' WHEN 'click' THEN '공사'
      WHEN 'view' THEN '기타돌발' WHEN 'purchase' THEN '기상' END AS eventType,
    json_extract_string(props, '$.k') AS eventDetailType,
    ts AS startDate,
    126.0::double + (user_id % 100) / 100.0::double AS coordX,
    35.0::double + (event_id % 50) / 50.0::double AS coordY,
    user_id + 1000000000 AS linkId,
    'road-' || (user_id % 40) AS roadName,
    user_id % 300 AS roadNo,
    CASE WHEN user_id % 2 = 0 THEN '기점' ELSE '종점' END AS roadDrcType,
    NULL::varchar AS lanesBlockType,
    (user_id % 4 + 1) || '차로 차단' AS lanesBlocked,
    '구간 "' || event_id || '",' || chr(10) || '우회 요망' AS message,
    CASE WHEN event_type <> 'error'
      THEN ts + to_seconds(round(value * 60)::bigint) END AS endDate
  FROM events
)"""

_TXT = """txt AS (
  SELECT * REPLACE (
    strftime(startDate, '%Y%m%d%H%M%S') AS startDate,
    strftime(endDate, '%Y%m%d%H%M%S') AS endDate,
    coordX::varchar AS coordX, coordY::varchar AS coordY,
    linkId::varchar AS linkId, roadNo::varchar AS roadNo)
  FROM ev
)"""

_DIRTY = """dirty AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 10 = 0 THEN '-' WHEN event_id % 10 = 1 THEN ''
      WHEN event_id % 23 = 0 THEN 'abc' ELSE coordX END AS coordX,
    CASE WHEN event_id % 17 = 0 THEN 'NULL' WHEN event_id % 5 = 0 THEN linkId || '.0'
      WHEN event_id % 29 = 0 THEN 'L' || linkId ELSE linkId END AS linkId,
    CASE WHEN event_id % 31 = 0 THEN startDate[1:7] ELSE startDate END AS startDate,
    CASE WHEN event_id % 37 = 0 THEN '20241399000000' WHEN event_id % 7 = 0 THEN ''
      ELSE endDate END AS endDate)
  FROM txt
)"""

_BLANK = "('', '-', 'NULL', 'nan', 'None')"
_TYPED = f"""typed AS (
  SELECT * REPLACE (
      CASE WHEN length(startDate) = 14
        THEN try_strptime(startDate, '%Y%m%d%H%M%S') END AS startDate,
      try_strptime(endDate, '%Y%m%d%H%M%S') AS endDate,
      CASE WHEN coordX NOT IN {_BLANK} THEN try_cast(coordX AS double) END AS coordX,
      try_cast(coordY AS double) AS coordY,
      CASE WHEN linkId NOT IN {_BLANK}
        THEN round(try_cast(linkId AS decimal(38,6)))::bigint END AS linkId,
      try_cast(roadNo AS bigint) AS roadNo),
    nullif(concat_ws(',',
      CASE WHEN startDate IS NOT NULL AND length(startDate) <> 14 THEN 'startDate' END,
      CASE WHEN coordX NOT IN {_BLANK} AND try_cast(coordX AS double) IS NULL
        THEN 'coordX' END,
      CASE WHEN linkId NOT IN {_BLANK} AND try_cast(linkId AS decimal(38,6)) IS NULL
        THEN 'linkId' END,
      CASE WHEN endDate <> '' AND try_strptime(endDate, '%Y%m%d%H%M%S') IS NULL
        THEN 'endDate' END), '') AS reject_reason
  FROM dirty
)"""

_SEC = """sec AS (
  SELECT * REPLACE (date_trunc('second', startDate) AS startDate,
    date_trunc('second', endDate) AS endDate)
  FROM ev
)"""

# The events of the second poll; with the first poll's (event_id % 3 <> 0) all are read.
_AGAIN = "(event_id % 2 = 0 OR event_id % 3 = 0)"
_REVISED = "concat_ws('/', eventType, '변경') AS eventType"
_MINUTES = (
    "date_diff('minute', startDate, coalesce(endDate, timestamp '2024-02-01 00:00:00'))"
)
_AVG_MINUTES = f"round(sum({_MINUTES})::double / count({_MINUTES}), 6)"
_FIELDS = (
    "type, eventType, eventDetailType, startDate, coordX, coordY, linkId, roadName, "
    "roadNo, roadDrcType, lanesBlockType, lanesBlocked, message, endDate"
)


def _sql(select: str, *parts: str) -> str:
    return f"WITH {', '.join([_EV, *parts])}\n{select}"


def _clean(select: str) -> str:
    return _sql(select, _TXT, _DIRTY, _TYPED)


_SNAPSHOT = _sql(
    f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY startDate, coordX, coordY ORDER BY createdAt DESC) AS rn
      FROM (
        SELECT *, timestamp '2024-01-31 00:00:00' AS createdAt
        FROM nulled WHERE event_id % 3 <> 0
        UNION ALL
        SELECT * REPLACE ({_REVISED}), timestamp '2024-02-01 00:00:00'
        FROM nulled WHERE {_AGAIN}))
    WHERE rn = 1""",
    """nulled AS (SELECT * REPLACE (
      CASE WHEN event_id % 10 <> 0 THEN coordX END AS coordX) FROM ev)""",
)


def _merge(target: str) -> str:
    updated = ", ".join(
        f"CASE WHEN b.event_id IS NULL THEN t.{c} ELSE b.{c} END AS {c}"
        for c in ("event_id", *_FIELDS.split(", "))
        if c not in ("startDate", "linkId")
    )
    columns = f"event_id, {_FIELDS}".replace("startDate, ", "").replace("linkId, ", "")
    return _sql(
        f"""SELECT t.startDate, t.linkId, {updated},
          CASE WHEN b.event_id IS NULL THEN timestamp '2024-01-31 00:00:00'
            ELSE timestamp '2024-02-01 00:00:00' END AS ingestion_timestamp
        FROM t LEFT JOIN b ON t.startDate = b.startDate AND t.linkId = b.linkId
        UNION ALL
        SELECT startDate, linkId, {columns}, timestamp '2024-02-01 00:00:00'
        FROM b WHERE NOT EXISTS (
          SELECT 1 FROM t WHERE t.startDate = b.startDate AND t.linkId = b.linkId)""",
        """base AS (SELECT * REPLACE (
          CASE WHEN event_id % 13 <> 0 THEN linkId END AS linkId) FROM ev)""",
        f"t AS ({target})",
        f"b AS (SELECT * REPLACE ({_REVISED}) FROM base WHERE {_AGAIN})",
    )


def _without(columns: str, sql: str) -> str:
    return f"SELECT * EXCLUDE ({columns}) FROM ({sql})"


_SUMMARY = _sql(
    """SELECT eventType, count(*) AS event_count,
      round(count(*) * 100.0 / (SELECT count(*) FROM ev), 2)::double AS percentage
    FROM ev GROUP BY eventType"""
)

_DQ = _sql(
    """SELECT 'daily_event_count' AS model, t.* FROM daily, LATERAL (VALUES
      ('event_date', 'not_null', null_dates),
      ('event_count', 'not_null', null_counts),
      ('event_count', 'accepted_range', outside)) AS t("column", test, failures)""",
    """daily AS (
      SELECT count(*) FILTER (event_date IS NULL) AS null_dates,
        count(*) FILTER (event_count IS NULL) AS null_counts,
        count(*) FILTER (event_count NOT BETWEEN 0 AND 1000) AS outside
      FROM (SELECT startDate::date AS event_date, count(*) AS event_count
        FROM ev GROUP BY 1))""",
)


def _text_dates(road_number: str) -> str:
    """The dirty records whose numbers convert, with their dates as landed."""
    return _clean(
        f"""SELECT {_FIELDS} FROM (
          SELECT dirty.* REPLACE (typed.coordX AS coordX, typed.coordY AS coordY,
            typed.linkId AS linkId, {road_number} AS roadNo)
          FROM dirty JOIN typed USING (event_id)
          WHERE reject_reason IS NULL
            OR NOT regexp_matches(reject_reason, 'coord|link'))"""
    )


def _two_polls(replaced: str) -> str:
    """Events as revised by the second poll, those it leaves out as first polled."""
    return _sql(
        f"""SELECT {_FIELDS} FROM (
          SELECT * REPLACE ({replaced}, coordY::double AS coordY,
            roadNo::bigint AS roadNo,
            CASE WHEN {_AGAIN} THEN concat_ws('/', eventType, '변경')
              ELSE eventType END AS eventType)
          FROM txt)""",
        _TXT,
    )


_MERGED_POLLS = _two_polls(
    f"""coordX::double AS coordX, event_id + 2000000000 AS linkId,
    CASE WHEN {_AGAIN} THEN endDate ELSE '' END AS endDate"""
)

_LATEST_POLLS = _two_polls(
    f"""strptime(startDate, '%Y%m%d%H%M%S') AS startDate,
    event_id::double AS coordX, linkId::bigint AS linkId,
    CASE WHEN {_AGAIN}
      THEN strptime(endDate, '%Y%m%d%H%M%S') END AS endDate"""
)


def _reports() -> str:
    """The nine reports' values, from the events themselves."""
    bands = """CASE WHEN m < 30 THEN '00~30분' WHEN m < 60 THEN '30~60분'
      WHEN m < 120 THEN '1~2시간' WHEN m < 240 THEN '2~4시간'
      WHEN m < 1440 THEN '4~24시간' ELSE '24시간 이상' END"""
    mean = "round(sum(m)::double / count(m), 6)"
    day, number = "startDate::date", "(dayofweek(startDate) + 1)::varchar"
    label = "['일', '월', '화', '수', '목', '금', '토'][dayofweek(startDate) + 1]"
    hours = "round(sum(s)::double / count(s) / 3600.0::double, 6)"
    share = "round(count(*) * 100.0 / (SELECT count(*) FROM ev), 2)::double"
    null = "NULL"
    rows = [
        ("event_type_summary", "e", "count(*)", null, null, null, share, "true"),
        ("daily_event_count", f"coalesce({day}::varchar, '-')", "count(*)", null, null, null, null, "true"),
        (
            "hourly_event_heatmap", f"{label} || '|' || hour(startDate) || '|' || {number}",
            "count(*)", null, null, null, null, "startDate IS NOT NULL",
        ),
        (
            "weekday_event_count", f"strftime(startDate, '%a') || '|' || {number}",
            "count(*)", null, null, null, null, "startDate IS NOT NULL",
        ),
        ("avg_duration_by_type", "t || '|' || e", "count(*)", mean, null, null, null, "true"),
        (
            "avg_duration_by_hour", "coalesce(date_trunc('hour', startDate)::varchar, '-')",
            null, mean, null, null, null, "true",
        ),
        ("avg_duration_hours_by_road_type", "t", null, hours, null, null, null, "type IS NOT NULL"),
        ("duration_buckets", bands, "count(*)", null, null, null, null, "true"),
        ("event_type_duration_stats", "e", "count(*)", mean, "min(m)", "max(m)", null, "true"),
    ]
    parts = [
        f"""SELECT '{name}' AS model, {key} AS key, {events}::bigint AS events,
          {average}::double AS mean, {least}::bigint AS least, {most}::bigint AS most,
          {part}::double AS share
        FROM timed WHERE {where} GROUP BY {key}"""
        for name, key, events, average, least, most, part, where in rows
    ]
    timed = f"""timed AS (
      SELECT *, coalesce(type, '-') AS t, coalesce(eventType, '-') AS e, {_MINUTES} AS m,
        abs(date_diff('second', startDate, endDate)) AS s FROM ev)"""
    return _sql(" UNION ALL ".join(parts), timed)


_BAD_ROWS = _sql(
    """SELECT startDate,
      CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN linkId END AS linkId,
      CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN ''
        ELSE 'column_count' END AS reason
    FROM sec""",
    _SEC,
)

ORACLE_SQL: dict[str, str] = {
    "src_events": _sql("SELECT * FROM ev"),
    "stg_event_info": _sql(
        "SELECT eventType, eventDetailType, startDate, endDate, coordX, coordY FROM ev"
    ),
    "event_type_summary": _SUMMARY,
    "events_by_road_type": _sql(
        """SELECT type AS road_type, count(*) AS total_events,
          count(DISTINCT roadName) AS total_roads,
          count(DISTINCT startDate::date) AS active_days,
          count(DISTINCT linkId) AS unique_locations
        FROM ev WHERE type IS NOT NULL GROUP BY type"""
    ),
    "daily_event_count": _sql(
        """SELECT startDate::date AS event_date, count(*) AS event_count
        FROM ev GROUP BY event_date"""
    ),
    "hourly_event_heatmap": _sql(
        """SELECT ['일', '월', '화', '수', '목', '금', '토'][weekday_order] AS weekday,
          hour, event_count, weekday_order
        FROM (
          SELECT (dayofweek(startDate) + 1)::int AS weekday_order,
            hour(startDate)::int AS hour, count(*) AS event_count
          FROM ev WHERE startDate IS NOT NULL GROUP BY 1, 2)"""
    ),
    "weekday_event_count": _sql(
        """SELECT strftime(startDate, '%a') AS weekday_short,
          (dayofweek(startDate) + 1)::int AS weekday_num, count(*) AS event_count
        FROM ev WHERE startDate IS NOT NULL GROUP BY 1, 2"""
    ),
    "avg_duration_by_type": _sql(
        f"""SELECT type, eventType, count(*) AS total_cnt,
          {_AVG_MINUTES} AS avg_duration_min
        FROM ev GROUP BY type, eventType"""
    ),
    "avg_duration_by_hour": _sql(
        f"""SELECT date_trunc('hour', startDate) AS hour_block,
          {_AVG_MINUTES} AS avg_duration_min
        FROM ev GROUP BY hour_block"""
    ),
    "avg_duration_hours_by_road_type": _sql(
        """SELECT type AS road_type,
          round(sum(seconds)::double / count(seconds) / 3600.0::double, 6)
            AS average_duration_hours
        FROM (SELECT type, abs(date_diff('second', startDate, endDate)) AS seconds
          FROM ev WHERE type IS NOT NULL)
        GROUP BY type"""
    ),
    "duration_buckets": _sql(
        f"""SELECT CASE WHEN m < 30 THEN '00~30분' WHEN m < 60 THEN '30~60분'
            WHEN m < 120 THEN '1~2시간' WHEN m < 240 THEN '2~4시간'
            WHEN m < 1440 THEN '4~24시간' ELSE '24시간 이상' END AS duration_range,
          count(*) AS event_count
        FROM (SELECT {_MINUTES} AS m FROM ev) GROUP BY 1"""
    ),
    "event_type_duration_stats": _sql(
        f"""SELECT eventType, count(*) AS event_count,
          {_AVG_MINUTES} AS avg_duration_min,
          min({_MINUTES}) AS min_duration_min, max({_MINUTES}) AS max_duration_min
        FROM ev GROUP BY eventType"""
    ),
    "event_durations": _sql(
        f"""SELECT type, eventType, eventDetailType, startDate, endDate,
          {_MINUTES} AS duration_minutes FROM ev"""
    ),
    "normalize_typed": _clean(
        "SELECT * EXCLUDE (reject_reason) FROM typed WHERE reject_reason IS NULL"
    ),
    "load_rejects": _clean(
        """SELECT dirty.*, reject_reason FROM dirty JOIN typed USING (event_id)
        WHERE reject_reason IS NOT NULL"""
    ),
    "null_markers": _clean(
        """SELECT * REPLACE (nullif(coordX, '-') AS coordX,
          nullif(linkId, 'NULL') AS linkId) FROM dirty"""
    ),
    "stringify": _sql(
        "SELECT COLUMNS(*)::varchar FROM ev"
    ),
    "dedup_first": _sql(
        """SELECT * EXCLUDE (rn) FROM (
          SELECT *, startDate || '_' || linkId AS unique_id,
            row_number() OVER (PARTITION BY startDate, linkId ORDER BY seq) AS rn
          FROM (
            SELECT *, event_id AS seq FROM txt
            UNION ALL
            SELECT * REPLACE ('copy' AS eventType), event_id + 1000000000000
            FROM txt WHERE event_id % 4 = 0))
        WHERE rn = 1""",
        _TXT,
    ),
    "dedup_latest": _sql(
        """SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY day, coordX, coordY
            ORDER BY startDate DESC NULLS FIRST, event_id DESC) AS rn
          FROM (SELECT *, startDate::date AS day FROM ev))
        WHERE rn = 1"""
    ),
    "snapshot_rewrite": _SNAPSHOT,
    "snapshot_rewrite_table": _without("event_id", _SNAPSHOT),
    "distinct_rows": _sql("SELECT * FROM ev"),
    "merge_upsert": _merge(
        """SELECT * FROM base WHERE event_id % 3 <> 0
        UNION ALL SELECT * FROM base WHERE event_id % 3 <> 0 AND event_id % 30 = 1"""
    ),
    "merge_table": _without(
        "event_id", _merge("SELECT * FROM base WHERE event_id % 3 <> 0")
    ),
    "merge_bucketed": _without(
        "event_id", _merge("SELECT * FROM base WHERE event_id % 3 <> 0")
    ),
    "json_envelope": _sql(
        f"SELECT (event_id % 500)::int AS seq, {_FIELDS} FROM sec", _SEC
    ),
    "json_envelope_files": _sql(
        f"SELECT (event_id % 500)::int AS seq, {_FIELDS} FROM sec", _SEC
    ),
    "json_one_file": _sql(
        f"SELECT (event_id % 500)::int AS seq, {_FIELDS} FROM sec WHERE event_id < 500", _SEC
    ),
    "csv_by_position": _sql(
        f"SELECT {_FIELDS}, date '2024-02-01' AS ingestion_date FROM sec", _SEC
    ),
    "csv_by_name": _text_dates("NULL::bigint"),
    "load_append": _text_dates("typed.roadNo"),
    "load_append_rerun": _text_dates("typed.roadNo"),
    "table_switch": _sql(
        """SELECT seen, eventType, count(*) AS event_count,
          round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY seen), 2)::double AS percentage
        FROM ev JOIN (VALUES ('first'), ('after_failure'), ('begun_before'), ('next')) s(seen)
          ON seen = 'next' OR event_id % 3 <> 0
        GROUP BY seen, eventType"""
    ),
    "insert_with_default": _sql(
        """SELECT *, CASE WHEN event_id % 3 <> 0 THEN timestamp '2024-02-01 00:00:00'
          ELSE timestamp '2024-01-31 00:00:00' END AS ingestion_timestamp FROM ev"""
    ),
    "csv_by_name_per_file": _sql(
        f"""SELECT {_FIELDS}, ingestion_date FROM (
          SELECT txt.* REPLACE (coordX::double AS coordX, coordY::double AS coordY,
              linkId::bigint AS linkId,
              CASE WHEN event_id % 2 = 0 THEN roadNo::bigint END AS roadNo),
            CASE WHEN event_id % 2 = 0 THEN date '2024-01-31'
              ELSE date '2024-02-01' END AS ingestion_date
          FROM txt)""",
        _TXT,
    ),
    "parquet_by_name": _sql(f"SELECT {_FIELDS} FROM sec", _SEC),
    "zip_csv": _sql(
        f"""SELECT {_FIELDS}, 'zip' AS archive, 'events.csv' AS entry
        FROM sec""",
        _SEC,
    ),
    "partition_scan": _sql(
        """SELECT *, startDate::date AS ingestion_date FROM ev
        WHERE startDate::date = date '2024-01-15'"""
    ),
    "append_load": _sql(
        f"""SELECT * FROM ev WHERE event_id % 3 <> 0
        UNION ALL SELECT * REPLACE ({_REVISED}) FROM ev WHERE {_AGAIN}"""
    ),
    "full_refresh": _sql(f"SELECT {_FIELDS} FROM txt", _TXT),
    "stream_ingest": _sql(
        f"SELECT startDate::date AS ingestion_date, {_FIELDS} FROM sec", _SEC
    ),
    "stream_upsert": _MERGED_POLLS,
    "load_merge": _MERGED_POLLS,
    "stream_unchanged": _sql(
        f"""SELECT date '2024-01-30' AS ingestion_date, {_FIELDS} FROM linked WHERE event_id % 3 <> 0
        UNION ALL
        SELECT date '2024-02-01', {_FIELDS} FROM (
          SELECT * REPLACE ({_REVISED}) FROM linked) WHERE {_AGAIN}""",
        _TXT,
        "linked AS (SELECT * REPLACE ((event_id + 2000000000)::varchar AS linkId) FROM txt)",
    ),
    "stream_latest": _LATEST_POLLS,
    "load_snapshot": _LATEST_POLLS,
    "dq_report": _DQ,
    "run_models": _DQ,
    "dq_observed": _DQ,
    "materialized_table": _SUMMARY,
    "one_pass_reports": _reports(),
    "rollup_incremental": _reports(),
    "compacted_days": _sql(
        f"""SELECT kind, date '2024-01-30' + (event_id % 2)::int AS ingestion_date,
          true AS fewer, {_FIELDS}
        FROM sec CROSS JOIN (VALUES ('csv'), ('parquet')) k(kind)""",
        _SEC,
    ),
    "events_by_road_type_sketch": _sql(
        """SELECT type AS road_type, count(*) AS total_events,
          count(DISTINCT roadName) AS total_roads,
          count(DISTINCT startDate::date) AS active_days,
          count(DISTINCT linkId) AS unique_locations, true AS near_total_events,
          true AS near_total_roads, true AS near_active_days, true AS near_unique_locations
        FROM ev WHERE type IS NOT NULL GROUP BY type"""
    ),
    "temporary_like": _sql("SELECT * FROM ev"),
    "persistent_view": _sql(
        "SELECT eventType, eventDetailType, startDate, endDate, coordX, coordY FROM ev"
    ),
    "load_archives": _sql(
        f"SELECT {_FIELDS}, date '2024-02-01' AS ingestion_date FROM sec", _SEC
    ),
    "load_snapshot_bad_rows": _BAD_ROWS,
    "load_archives_bad_rows": _BAD_ROWS,
    "stream_csv_rejects": _BAD_ROWS,
    "hourly_event_heatmap_text": _clean(
        """SELECT ['일', '월', '화', '수', '목', '금', '토'][weekday_order] AS weekday,
          hour, count(*) AS event_count, weekday_order
        FROM (
          SELECT (dayofweek(CASE WHEN length(d) >= 8
              THEN try_strptime(d[1:8], '%Y%m%d') END) + 1)::int AS weekday_order,
            CASE WHEN length(d) >= 10 THEN try_cast(d[9:10] AS int) END AS hour
          FROM (
            SELECT regexp_replace(s, '[^0-9]', '', 'g') AS d FROM (
              SELECT CASE WHEN event_id % 41 = 0 THEN '  '
                WHEN event_id % 43 = 0 THEN startDate[1:8]
                WHEN event_id % 47 = 0
                  THEN concat_ws('-', startDate[1:4], startDate[5:6], startDate[7:14])
                WHEN event_id % 53 = 0 THEN startDate[1:8] || (event_id % 76 + 24)
                ELSE startDate END AS s
              FROM dirty)
            WHERE s IS NOT NULL AND trim(s) <> ''))
        GROUP BY weekday_order, hour"""
    ),
}
