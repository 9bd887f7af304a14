"""The registered queries as DuckDB SQL over the test tables."""

from __future__ import annotations

from checks import literals
from checks.fixtures import CUT, DUCK_ADAPTER
from checks.literals import RELATIONS, STREAM_ERROR_FORMULA, TABLES

RUN_TS = "2024-02-01 00:00:00"
RAW_COLUMNS = ", ".join(literals.RAW)
TRACKED = ("username", "device_type", "app_version", "region_code", "city")
SIG = "concat_ws('|', " + ", ".join(TRACKED) + ")"
END = "TIMESTAMP '9999-12-31 23:59:59'"

# Dimension table: key, columns.
DIMS = {
    "dim_company": ("company_id", ["company_id", "company_name", "'General' AS industry"]),
    "dim_branch": ("branch_id", ["branch_id", "branch_name", "company_id", "region_code"]),
    "dim_manager": ("manager_id", ["manager_id", "manager_name", "branch_id", "department"]),
    "dim_employee": (
        "employee_id",
        ["employee_id", "employee_name", "manager_id", "branch_id", "project_code"],
    ),
    "dim_project": ("project_code", ["project_code", "project_name", "company_id", "department"]),
}
PLAIN = {t: [c.split(" AS ")[-1] for c in columns] for t, (_, columns) in DIMS.items()}


def pick(table: str, source: str = "raw", last: bool = True) -> str:
    """One row per key of the dimension: its last (or first) event."""
    key, columns = DIMS[table]
    way = "DESC" if last else "ASC"
    return f"""SELECT {", ".join(columns)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_ts {way}, event_id {way}) AS rn
      FROM {source}) t WHERE rn = 1"""


def ctes(*parts: str) -> str:
    base = [
        f"num AS ({DUCK_ADAPTER})",
        "raw AS (SELECT * EXCLUDE (i, watch_time_raw), "
        "coalesce(try_cast(watch_time_raw AS DOUBLE), 0.0) AS watch_time FROM num)",
    ]
    return "WITH " + ",\n".join([*base, *parts]) + "\n"


DIM_CTES = [f"{t} AS ({pick(t)})" for t in DIMS]
FACT_COLUMNS = ", ".join(literals.FACT_USER_ACTIVITY)
FACT = f"fact AS (SELECT {FACT_COLUMNS} FROM raw)"
BATCHES = (
    f"one AS (SELECT * FROM raw WHERE event_ts <= TIMESTAMP '{CUT}')",
    f"two AS (SELECT * FROM raw WHERE event_ts > TIMESTAMP '{CUT}')",
)
BROKEN = """CASE WHEN mod(i, 113) = 0 THEN 'not json' WHEN mod(i, 127) = 0 THEN '[1,2]'
  WHEN mod(i, 131) = 0 THEN 'null' END"""
MESSAGES = f"msg AS (SELECT *, {BROKEN} AS broken, mod(i, 89) = 0 AS late FROM num)"
BUCKET = "time_bucket(INTERVAL '15 minutes', event_ts)"
BUCKET_KEY = f"strftime({BUCKET}, '%Y%m%d%H%M')"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def user_sk(ts: str = "event_ts") -> str:
    return f"sha1(user_id || '|' || {text(ts)})"


def versions(source: str, lag_order: str) -> str:
    """Versions from ``source`` rows whose attributes differ from the row before."""
    return f"""SELECT {user_sk()} AS user_sk, user_id, {", ".join(TRACKED)},
        event_ts AS effective_from,
        coalesce(lead(event_ts) OVER w, {END}) AS effective_to,
        lead(event_ts) OVER w IS NULL AS is_current
      FROM (SELECT *, {SIG} AS sig, lag({SIG}) OVER (PARTITION BY user_id ORDER BY {lag_order}) AS psig
            FROM {source}) p
      WHERE psig IS NULL OR sig <> psig
      WINDOW w AS (PARTITION BY user_id ORDER BY event_ts, event_id)"""


LAST_PER_BATCH = f"""lastrows AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY b, user_id ORDER BY event_ts DESC, event_id DESC) AS rn
  FROM (SELECT *, CASE WHEN event_ts <= TIMESTAMP '{CUT}' THEN 1 ELSE 2 END AS b FROM raw) x) t
  WHERE rn = 1)"""
APPLIED = f"applied AS ({versions('lastrows', 'b')})"
# The last state of each user and second counts.
HISTORY = f"""lastsec AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_ts ORDER BY event_id DESC) AS rn FROM raw) t
  WHERE rn = 1),
history AS ({versions('lastsec', 'event_ts')})"""
# A payload as the producer writes it: fields in order, NULL ones left out.
PAYLOAD = "'{' || concat_ws(',', " + ", ".join(
    f"""'"{c}":' || """
    + (
        f"CAST({c} AS VARCHAR)"
        if c in ("lat", "lon")
        else f"""'"' || {text("event_ts") if c == "event_ts" else "watch_time_raw" if c == "watch_time" else c} || '"'"""
    )
    for c in literals.EVENT_TEXT
) + ") || '}'"
AS_OF = """e JOIN {v} v ON e.user_id = v.user_id
  AND e.event_ts >= v.effective_from AND e.event_ts < v.effective_to"""


def values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(repr(c) for c in r) + ")" for r in rows) + ")"


def upserted(old: str, new: str, key: str) -> str:
    return f"SELECT * FROM ({old}) WHERE {key} NOT IN (SELECT {key} FROM ({new})) UNION ALL SELECT * FROM ({new})"


SEEDS = {
    "dim_company": literals.COMPANIES,
    "dim_branch": literals.BRANCHES,
    "dim_manager": literals.MANAGERS,
    "dim_project": literals.PROJECTS,
}
SEED_EMPLOYEES = """SELECT 'E' || CAST(1000 + n AS VARCHAR) AS employee_id,
  'Employee_' || CAST(n AS VARCHAR) AS employee_name,
  'M00' || CAST(1 + mod(n, 4) AS VARCHAR) AS manager_id,
  'B00' || CAST(1 + mod(n, 4) AS VARCHAR) AS branch_id,
  'P00' || CAST(1 + mod(n, 3) AS VARCHAR) AS project_code
  FROM range(1, 21) t(n)"""


def seeded(table: str) -> str:
    names = ", ".join(PLAIN[table])
    return f"SELECT * FROM {values(SEEDS[table])} s({names})"


def joined(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(columns) + ")"


WIDE = f"""wide AS (
  SELECT sha1(e.employee_id || '|' || {text("s.at")}) AS employee_sk, e.employee_id, e.employee_name,
    e.manager_id, m.manager_name, m.department, e.branch_id, b.branch_name, c.company_name,
    s.at AS effective_from
  FROM dim_employee e
  JOIN (SELECT employee_id, min(event_ts) AS at FROM raw GROUP BY 1) s ON s.employee_id = e.employee_id
  LEFT JOIN dim_manager m ON m.manager_id = e.manager_id
  LEFT JOIN dim_branch b ON b.branch_id = e.branch_id
  LEFT JOIN dim_company c ON c.company_id = b.company_id)"""

EXPORTED = " UNION ALL ".join(
    [
        f"SELECT '{t}' AS table_name, '{','.join(PLAIN[t])}' AS line, count(*) AS row_count FROM {t} "
        f"UNION ALL SELECT '{t}', {" || ',' || ".join(f"coalesce({c}, '')" for c in PLAIN[t])}, 1 FROM {t}"
        for t in DIMS
    ]
    + [
        "SELECT 'fact_user_activity' AS table_name, "
        f"'{','.join(literals.FACT_USER_ACTIVITY)}' AS line, count(*) AS row_count FROM fact"
    ]
)


def orphan_report(child: str, key: str, parent: str) -> str:
    source = "strayed" if child == "fact_user_activity" else child
    return f"""SELECT '{child}' AS child_table, '{key}' AS fk_column, '{parent}' AS parent_table,
      count(*) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys
      FROM {source} c WHERE {key} IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"""


def meta_count(name: str, source: str) -> str:
    kind, about = next((k.lower(), d) for t, k, d in TABLES if t == name)
    return f"""SELECT 'etl.{name}' AS table_name, 'etl' AS schema_name, '{kind}' AS table_type,
      '{about}' AS description, count(*) AS record_count, TIMESTAMP '{RUN_TS}' AS last_updated
      FROM {source}"""


def meta_columns(name: str, columns: list[str], text_columns: set[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'etl.{name}' AS table_name, '{c}' AS column_name,
          '{"string" if c in text_columns else literals.TYPES.get(c, "string")}' AS data_type,
          (SELECT CASE WHEN count(*) > count({c}) THEN 'YES' ELSE 'NO' END FROM {source}) AS is_nullable,
          '{c} of {name}' AS description"""
        for c in columns
    )


def shape(name: str, item: str, measure: str) -> str:
    return f"SELECT '{name}' AS shape, {item} AS item, {measure} AS measure FROM num WHERE mod(i, 113) <> 0"


WATCH = "round(sum(watch_time), 2)"

ORACLE: dict[str, str] = {
    "stream_source": ctes(MESSAGES)
    + f"""SELECT i, CASE WHEN broken = 'null' THEN NULL WHEN broken IS NOT NULL THEN broken
      ELSE {PAYLOAD} END AS value FROM msg""",
    "json_decode": ctes(MESSAGES)
    + "SELECT "
    + ", ".join(
        text("event_ts") + " AS event_ts" if c == "event_ts" else c
        for c in literals.EVENT_TEXT
        if c != "watch_time"
    )
    + ", coalesce(try_cast(watch_time_raw AS DOUBLE), 0.0) AS watch_time FROM msg WHERE broken IS NULL",
    "raw_append": ctes(MESSAGES)
    + "SELECT "
    + ", ".join(
        {
            "ingestion_ts": f"TIMESTAMP '{RUN_TS}' AS ingestion_ts",
            "watch_time": "coalesce(try_cast(watch_time_raw AS DOUBLE), 0.0) AS watch_time",
        }.get(c, c)
        for c in literals.RAW
    )
    + " FROM msg WHERE broken IS NULL AND NOT late",
    "raw_append_idempotent": ctes(MESSAGES)
    + "SELECT "
    + ", ".join(
        {
            "ingestion_ts": f"TIMESTAMP '{RUN_TS}' AS ingestion_ts",
            "watch_time": "coalesce(try_cast(watch_time_raw AS DOUBLE), 0.0) AS watch_time",
        }.get(c, c)
        for c in literals.RAW
    )
    + ", strftime(event_ts, '%Y-%m-%d') AS event_date FROM msg WHERE broken IS NULL",
    "ingest_stamp": ctes()
    + f"""SELECT event_id, TIMESTAMP '{RUN_TS}' AS ingestion_ts,
      date_diff('second', event_ts, TIMESTAMP '{RUN_TS}') AS lag_seconds FROM raw""",
    "ingest_shapes": ctes()
    + " UNION ALL ".join(
        [
            shape("sensor", "city", "lat"),
            shape("live", "CAST(i AS VARCHAR)", "try_cast(watch_time_raw AS DOUBLE)"),
            shape("user", "event_id", "try_cast(watch_time_raw AS DOUBLE)"),
        ]
    ),
    "incremental_load": ctes() + f"SELECT {RAW_COLUMNS} FROM raw WHERE event_ts > TIMESTAMP '{CUT}'",
    "incremental_load_14col": ctes()
    + "SELECT "
    + ", ".join(
        "substr(user_id, 2) AS user_id" if c == "user_id" else c for c in literals.RAW_USER
    )
    + f" FROM raw WHERE event_ts > TIMESTAMP '{CUT}'",
    "csv_export": ctes(*DIM_CTES, FACT) + EXPORTED,
    "csv_scan": ctes(*DIM_CTES)
    + " UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, {joined(PLAIN[t])} AS content, CAST(0.0 AS DOUBLE) AS watch_time FROM {t}" for t in DIMS]
        + [
            "SELECT 'fact_user_activity', "
            + joined([text(c) if c.endswith("_ts") else c for c in literals.FACT_USER_ACTIVITY if c != "watch_time"])
            + ", watch_time FROM raw"
        ]
    ),
    "csv_export_by_days": ctes(FACT) + "SELECT * FROM fact",
    "table_recreate": ctes(*DIM_CTES)
    + """SELECT 'filled' AS step, count(*) AS row_count FROM dim_employee
      UNION ALL SELECT 'recreated', 0""",
    "table_ensure": ctes()
    + """SELECT 'missing' AS step, CAST(0 AS BIGINT) AS row_count
      UNION ALL SELECT 'filled', count(*) FROM raw UNION ALL SELECT 'ensured', count(*) FROM raw""",
    "safe_float": ctes() + "SELECT event_id, watch_time FROM raw",
    "strict_float": ctes()
    + """SELECT event_id, try_cast(watch_time_raw AS DOUBLE) AS watch_time, lat, lon FROM num
      WHERE try_cast(watch_time_raw AS DOUBLE) IS NOT NULL""",
    "null_to_zero": ctes()
    + """SELECT event_id, CASE WHEN watch_time_raw IS NULL THEN 0.0
      ELSE CAST(watch_time_raw AS DOUBLE) END AS watch_time FROM num
      WHERE watch_time_raw IS NULL OR watch_time_raw <> 'n/a'""",
    "normalize_ts": ctes()
    + f"""SELECT event_id,
      CASE WHEN mod(i, 7) IN (3, 4) THEN TIMESTAMP '{RUN_TS}' ELSE event_ts END AS from_text,
      event_ts AS from_number, event_ts AS from_clock FROM num""",
    "fact_project": ctes()
    + "SELECT "
    + ", ".join(
        "coalesce(try_cast(watch_time_raw AS DOUBLE), 0.0) AS watch_time" if c == "watch_time" else c
        for c in literals.FACT_USER_ACTIVITY
    )
    + " FROM num WHERE watch_time_raw IS NULL OR watch_time_raw <> 'n/a'",
    "org_columns_select": ctes()
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, columns, count(*) AS events FROM "
        f"(SELECT {joined([c.split(' AS ')[0] for c in columns])} AS columns FROM raw) x GROUP BY 2"
        for t, (_, columns) in DIMS.items()
    ),
    "required_columns": ctes()
    + """SELECT event_id, CASE WHEN watch_time_raw IS NULL THEN 'rejected' ELSE 'kept' END AS verdict
      FROM num""",
    "stream_errors": ctes(MESSAGES)
    + f"""SELECT 'stream_insert_error' AS metric_name, '{STREAM_ERROR_FORMULA}' AS metric_formula,
      'Failed to insert event ' || event_id || ' | Error: event_ts is not a timestamp: yesterday'
      AS description FROM msg WHERE broken IS NULL AND late""",
    "quarantine": ctes(MESSAGES)
    + """SELECT CASE WHEN broken <> 'null' THEN broken END AS value,
      CASE broken WHEN 'not json' THEN 'not json' WHEN 'null' THEN 'null payload'
      ELSE 'not a json object' END AS reason FROM msg WHERE broken IS NOT NULL""",
    "fact_errors": ctes()
    + """SELECT 'fact_insert_error' AS metric_name, 'cast(float)' AS metric_formula,
      event_id || ' failed: could not convert string to float: ''n/a''' AS description
      FROM num WHERE watch_time_raw = 'n/a'""",
    "batch_counts": ctes(MESSAGES)
    + """SELECT CAST(floor(i / 1000) AS BIGINT) AS batch_id,
      count(*) FILTER (WHERE broken IS NULL AND NOT late) AS inserted,
      count(*) FILTER (WHERE broken IS NULL AND late) AS skipped,
      count(*) FILTER (WHERE broken IS NOT NULL) AS quarantined FROM msg GROUP BY 1""",
    "run_counts": ctes(*DIM_CTES)
    + " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS row_count FROM {source}"
        for step, source in [("raw_loaded", "raw"), *[(t, t) for t in DIMS], ("fact_user_activity", "raw")]
    ),
    "dedupe_by_key": ctes(*BATCHES) + "SELECT event_id, event_ts, ingestion_ts, user_id FROM two",
    "stream_dedupe": ctes() + "SELECT event_id, event_ts, user_id FROM raw",
    "fk_orphans": ctes(
        *DIM_CTES,
        "strayed AS (SELECT * REPLACE (CASE WHEN mod(i, 211) = 0 THEN 'B9' ELSE branch_id END AS branch_id) FROM num)",
    )
    + " UNION ALL ".join(orphan_report(*r) for r in RELATIONS),
    "region_conformance": ctes()
    + """SELECT region_code, count(*) AS events FROM raw
      WHERE region_code NOT IN ('NCR', 'WST', 'EST', 'SOU', 'NTH') GROUP BY 1""",
    **{t: ctes() + pick(t) for t in DIMS},
    **{f"{t}_first": ctes() + pick(t, last=False) for t in DIMS},
    "dim_upsert": ctes(*BATCHES)
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {joined(PLAIN[t])} AS columns FROM "
        f"({upserted(pick(t, 'one'), pick(t, 'two'), DIMS[t][0])}) u"
        for t in DIMS
    ),
    "seed_dims": ctes(*DIM_CTES)
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {joined(PLAIN[t])} AS columns FROM "
        f"({upserted(f'SELECT * FROM {t}', seeded(t), DIMS[t][0])}) u"
        for t in SEEDS
    ),
    "seed_employees": ctes(*DIM_CTES)
    + upserted("SELECT * FROM dim_employee", SEED_EMPLOYEES, "employee_id"),
    "seed_region_boxes": ctes(
        f"boxes AS (SELECT * FROM {values(literals.REGION_BOXES)} "
        f"b({', '.join(literals.DIM_REGION_BOX)}))"
    )
    + """SELECT b.region_code, region_name, b.city, CAST(min_lat AS DOUBLE) AS min_lat,
      CAST(max_lat AS DOUBLE) AS max_lat, CAST(min_lon AS DOUBLE) AS min_lon,
      CAST(max_lon AS DOUBLE) AS max_lon, count(r.lat) AS events
      FROM boxes b LEFT JOIN raw r ON r.lat BETWEEN CAST(min_lat AS DOUBLE) AND CAST(max_lat AS DOUBLE)
      AND r.lon BETWEEN CAST(min_lon AS DOUBLE) AND CAST(max_lon AS DOUBLE)
      GROUP BY ALL""",
    "dim_time": ctes()
    + """SELECT t AS time_bucket_start, t + INTERVAL '15 minutes' AS time_bucket_end,
      strftime(t, '%Y%m%d_%H%M') AS time_key
      FROM (SELECT unnest(generate_series(date_trunc('day', min(event_ts))::TIMESTAMP,
        date_trunc('day', max(event_ts))::TIMESTAMP + INTERVAL '1425 minutes',
        INTERVAL '15 minutes')) AS t FROM raw) s""",
    "dim_time_calendar": ctes()
    + """SELECT strftime(t, '%Y%m%d%H%M') AS time_15min_sk, t AS bucket_start_ts,
      strftime(t, '%Y-%m-%d') AS day, CAST(hour(t) AS INTEGER) AS hour,
      CAST(minute(t) AS INTEGER) AS minute, CAST(isodow(t) AS INTEGER) AS dow,
      CAST(weekofyear(t) AS INTEGER) AS week, CAST(month(t) AS INTEGER) AS month,
      CAST(year(t) AS INTEGER) AS year
      FROM (SELECT unnest(generate_series(
        time_bucket(INTERVAL '15 minutes', max(event_ts) - INTERVAL '30 days'),
        max(event_ts) + INTERVAL '30 days', INTERVAL '15 minutes')) AS t FROM raw) s""",
    "time_bucket_key": ctes() + f"SELECT event_id, {BUCKET_KEY} AS time_15min_sk FROM raw",
    "surrogate_key": ctes() + f"SELECT event_id, {user_sk()} AS user_sk FROM raw",
    "scd2_apply": ctes(LAST_PER_BATCH, APPLIED)
    + f"SELECT * REPLACE ({text('effective_to')} AS effective_to) FROM applied",
    "scd2_counts": ctes(LAST_PER_BATCH)
    + f"""SELECT CAST(b AS INTEGER) AS batch, count(*) FILTER (WHERE psig IS NULL OR sig <> psig) AS inserts,
      count(*) FILTER (WHERE sig <> psig) AS updates
      FROM (SELECT *, {SIG} AS sig, lag({SIG}) OVER (PARTITION BY user_id ORDER BY b) AS psig FROM lastrows) p
      GROUP BY 1""",
    "scd2_history": ctes(HISTORY)
    + f"SELECT * REPLACE ({text('effective_to')} AS effective_to) FROM history",
    "asof_lookup": ctes(HISTORY)
    + f"""SELECT event_id, user_sk, effective_from, {text("effective_to")} AS effective_to
      FROM raw {AS_OF.format(v="history")}""",
    "fact_user_watch": ctes(LAST_PER_BATCH, APPLIED)
    + f"""SELECT event_id, event_ts, {BUCKET_KEY} AS time_15min_sk, user_sk, e.region_code, lat, lon,
      watch_time, e.device_type, e.app_version, ingestion_ts
      FROM raw {AS_OF.format(v="applied")}""",
    "dim_employee_wide": ctes(*DIM_CTES, WIDE) + "SELECT * FROM wide",
    "fact_org_watch": ctes(*DIM_CTES, WIDE)
    + f"""SELECT event_id, event_ts, {BUCKET_KEY} AS time_15min_sk, employee_sk, r.project_code,
      r.region_code, lat, lon, watch_time, device_type, app_version, ingestion_ts, r.manager_id,
      r.branch_id, r.department, r.company_name
      FROM raw r LEFT JOIN wide w ON w.employee_id = r.employee_id""",
    "project_first_seen": ctes()
    + """SELECT project_code, project_name, company_name, event_ts AS created_at FROM (
      SELECT *, row_number() OVER (PARTITION BY project_code ORDER BY event_ts, event_id) AS rn FROM raw) t
      WHERE rn = 1""",
    "watermark_read": ctes(*BATCHES)
    + """SELECT 'live_stream' AS pipeline_name, max(event_ts) AS last_run_ts FROM one
      UNION ALL SELECT 'never_ran', TIMESTAMP '1970-01-01 00:00:00'""",
    "watermark_write": ctes(*BATCHES)
    + """SELECT 'live_stream' AS pipeline_name, max(event_ts) AS last_run_ts FROM two
      UNION ALL SELECT 'other', max(event_ts) FROM one""",
    "watermark_next": ctes(*BATCHES)
    + """SELECT 'one' AS pipeline_name, max(event_ts) AS last_run_ts FROM one
      UNION ALL SELECT 'two', max(event_ts) FROM two""",
    "watermark_init": ctes(*BATCHES)
    + """SELECT 'epoch' AS init, count(*) AS loadable FROM raw
      UNION ALL SELECT 'setup', count(*) FROM two""",
    "silver_run": ctes(*BATCHES, *DIM_CTES)
    + " UNION ALL ".join(
        [
            f"SELECT '{t}' AS table_name, {joined(PLAIN[t])} AS content, CAST(0.0 AS DOUBLE) AS watch_time "
            f"FROM ({upserted(SEED_EMPLOYEES if t == 'dim_employee' else seeded(t), f'SELECT * FROM {t}', DIMS[t][0])}) u"
            for t in DIMS
        ]
        + [
            "SELECT 'fact_user_activity', "
            + joined(
                [
                    text(c) if c.endswith("_ts") else c
                    for c in literals.FACT_USER_ACTIVITY
                    if c != "watch_time"
                ]
            )
            + ", watch_time FROM raw",
            f"SELECT 'etl_watermarks', 'live_stream|' || {text('max(event_ts)')}, 0.0 FROM raw",
        ]
    ),
    "silver_run_late": ctes(FACT) + "SELECT * FROM fact",
    "user_star_run": ctes(LAST_PER_BATCH, APPLIED)
    + f"""SELECT 'user' AS kind, user_sk, {joined(["user_id", *TRACKED])} AS content,
      {text("effective_from")} AS effective_from, {text("effective_to")} AS effective_to FROM applied
      UNION ALL SELECT 'fact', user_sk, event_id, {text("event_ts")}, NULL
      FROM raw {AS_OF.format(v="applied")}""",
    "empty_batch_guard": ctes(MESSAGES)
    + """SELECT 'none' AS batch, false AS written, CAST(0 AS BIGINT) AS raw_rows
      UNION ALL SELECT 'all', true, count(*) FROM msg WHERE broken IS NULL""",
    "meta_table": ctes()
    + f"""SELECT 'etl.' || t.n AS table_name, t.k AS type, t.d AS description,
      lo AS created_ts, hi AS updated_ts FROM {values(TABLES)} t(n, k, d),
      (SELECT min(ingestion_ts) AS lo, max(ingestion_ts) AS hi FROM raw) b""",
    "meta_table_counts": ctes(*DIM_CTES)
    + " UNION ALL ".join(
        [
            meta_count("raw_user_stream_events", "raw"),
            *[meta_count(t, t) for t in DIMS],
            meta_count("fact_user_activity", "raw"),
        ]
    ),
    "meta_column": ctes(
        "rawtext AS (SELECT * EXCLUDE (watch_time_raw), watch_time_raw AS watch_time FROM num)", FACT
    )
    + meta_columns("raw_user_stream_events", literals.RAW, {"watch_time"}, "rawtext")
    + " UNION ALL "
    + meta_columns("fact_user_activity", literals.FACT_USER_ACTIVITY, set(), "fact"),
    "metric_eval": ctes()
    + f"""SELECT unnest(['events', 'watch_time_total', 'watch_time_per_event', 'active_users',
        'active_employees', 'idle_events']) AS metric_name,
      unnest([n, w, w / n, u, e, z]) AS metric_value
      FROM (SELECT CAST(count(*) AS DOUBLE) AS n, {WATCH} AS w,
        CAST(count(DISTINCT user_id) AS DOUBLE) AS u, CAST(count(DISTINCT employee_id) AS DOUBLE) AS e,
        CAST(count(*) FILTER (WHERE watch_time = 0) AS DOUBLE) AS z FROM raw) m""",
    "watch_by_org": ctes(*DIM_CTES)
    + f"""SELECT company_id, CASE WHEN grouping(company_id) = 0 THEN max(company_name) END AS company_name,
      branch_id, CASE WHEN grouping(branch_id) = 0 THEN max(branch_name) END AS branch_name,
      count(*) AS events, {WATCH} AS watch_time,
      CAST(grouping(company_id, branch_id) AS BIGINT) AS grouping_level,
      {WATCH} / count(*) AS avg_watch_time
      FROM (SELECT r.company_id, c.company_name, r.branch_id,
          CASE b.branch_name WHEN 'Gurgaon' THEN 'Noida' ELSE b.branch_name END AS branch_name, r.watch_time
        FROM raw r LEFT JOIN dim_company c ON c.company_id = r.company_id AND c.company_id <> 'C2'
        LEFT JOIN dim_branch b ON b.branch_id = r.branch_id) x
      GROUP BY ROLLUP (company_id, branch_id)""",
    "watch_by_department": ctes(*DIM_CTES)
    + f"""SELECT m.department, count(*) AS events, count(DISTINCT r.user_id) AS users,
      {WATCH} AS watch_time FROM raw r
      LEFT JOIN dim_manager m ON m.manager_id = r.manager_id AND m.manager_id <> 'M_C1_1' GROUP BY 1""",
    "watch_by_project": ctes(*DIM_CTES)
    + f"""SELECT r.project_code, p.project_name, c.company_name, count(*) AS events, {WATCH} AS watch_time
      FROM raw r LEFT JOIN dim_project p ON p.project_code = r.project_code AND p.project_code <> 'P_C1_1'
      LEFT JOIN dim_company c ON c.company_id = p.company_id GROUP BY 1, 2, 3""",
    "watch_15min": ctes()
    + f"""SELECT strftime(t, '%Y%m%d_%H%M') AS time_key, t AS time_bucket_start,
      count(r.event_id) AS events, coalesce({WATCH}, 0.0) AS watch_time
      FROM (SELECT unnest(generate_series(date_trunc('day', min(event_ts))::TIMESTAMP,
        date_trunc('day', max(event_ts))::TIMESTAMP + INTERVAL '1425 minutes',
        INTERVAL '15 minutes')) AS t FROM raw) s
      LEFT JOIN raw r ON r.event_ts >= t AND r.event_ts < t + INTERVAL '15 minutes' GROUP BY 1, 2""",
    "top_employees": ctes(*DIM_CTES)
    + f"""SELECT t.branch_id, CAST(place AS INTEGER) AS place, t.employee_id, e.employee_name, events, watch_time
      FROM (SELECT *, row_number() OVER (PARTITION BY branch_id ORDER BY watch_time DESC, employee_id) AS place
        FROM (SELECT branch_id, employee_id, count(*) AS events, {WATCH} AS watch_time
          FROM raw GROUP BY 1, 2) g) t
      LEFT JOIN dim_employee e ON e.employee_id = t.employee_id WHERE place <= 3""",
    "session_summary": ctes()
    + f"""SELECT session_id, min(event_ts) AS first_event, max(event_ts) AS last_event,
      count(*) AS events, {WATCH} AS watch_time FROM raw GROUP BY 1""",
    "region_by_box": ctes(
        f"boxes AS (SELECT * FROM {values(literals.REGION_BOXES)} "
        f"b({', '.join(literals.DIM_REGION_BOX)}))"
    )
    + """SELECT event_id, lat, lon, b.region_code AS box_region FROM raw r LEFT JOIN boxes b
      ON r.lat BETWEEN CAST(min_lat AS DOUBLE) AND CAST(max_lat AS DOUBLE)
      AND r.lon BETWEEN CAST(min_lon AS DOUBLE) AND CAST(max_lon AS DOUBLE)""",
    "stream_watch_15min": ctes()
    + f"""SELECT {BUCKET} AS time_bucket_start, count(*) AS events, {WATCH} AS watch_time
      FROM raw GROUP BY 1""",
}

# Runs have the results of one pass over all events, however these are cut into batches.
ORACLE |= {
    "raw_compact": ctes() + f"SELECT {RAW_COLUMNS}, strftime(event_ts, '%Y-%m-%d') AS event_date FROM raw",
    "user_history_run": ORACLE["scd2_history"],
    "dim_employee_wide_run": ORACLE["dim_employee_wide"],
    "fact_org_watch_run": ORACLE["fact_org_watch"],
    "project_first_seen_run": ORACLE["project_first_seen"],
    "metric_definitions": ORACLE["metric_eval"],
}
