"""Reference results in DuckDB SQL, written independently of the library."""

from __future__ import annotations

from verification.fixtures import FIXTURES

HASHED = {
    "schedule": ["employee_id", "position_id", "project_id", "schedule_type", "schedule_status",
                 "#schedule_start_date", "#schedule_end_date"],
    "timeline": ["#period_start_date", "#period_end_date", "$allocated_hours"],
    "cost": ["project_id", "cost_center", "cost_type", "cost_category", "currency"],
    "cost_timeline": ["#period_date", "$amount", "forecast_type"],
}


def _text(column: str) -> str:
    if column[0] == "#":
        return f"strftime({column[1:]}, '%Y-%m-%d')"
    if column[0] == "$":
        plain = f"rtrim(rtrim(CAST({column[1:]} AS VARCHAR), '0'), '.')"
        return f"regexp_replace({plain}, '^(-?)0\\.', '\\1.')"
    return column


def _hash(kind: str) -> str:
    return "upper(sha256(" + " || chr(1) || ".join(f"coalesce({_text(c)}, 'NULL')" for c in HASHED[kind]) + "))"


def _with(body: str, **ctes: str) -> str:
    """Put the projections named in the text, and the given CTEs, in front of a query."""
    texts = [*ctes.values(), body]
    used = [n for n in FIXTURES if any(n in t for t in texts)]
    parts = [f"{n} AS ({FIXTURES[n].strip()})" for n in used] + [f"{n} AS ({t.strip()})" for n, t in ctes.items()]
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()


def _latest(source: str, columns: str, low: str, high: str, key: str, month: str = "", extra: str = "") -> str:
    by = f"{key}, date_trunc('month', {month})" if month else key
    return f"""SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY reporting_date DESC, src_seq DESC) AS pick
      FROM {source} WHERE reporting_date > DATE '{low}' AND reporting_date <= DATE '{high}'
       AND {key} IS NOT NULL {extra}) WHERE pick = 1"""


def _tags(run: int, kind: str) -> str:
    return (f"CAST({run} AS BIGINT) AS stg_run_id, 'PENDING' AS stg_status, CAST(NULL AS VARCHAR) AS stg_action, "
            f"CAST(NULL AS VARCHAR) AS stg_reject_reason, {_hash(kind)} AS stg_record_hash")


SCHEDULE_COLUMNS = ("schedule_id, employee_id, position_id, project_id, schedule_type, schedule_status, "
                    "schedule_start_date, schedule_end_date")
TIMELINE_COLUMNS = "schedule_id, dt_period, period_start_date, period_end_date, allocated_hours"
COST_COLUMNS = "cost_id, project_id, cost_center, cost_type, cost_category, currency"
COST_TIMELINE_COLUMNS = "cost_id, dt_period, period_date, amount, curve_type, forecast_type"
CURVE = """CASE WHEN upper(forecast_type) IN ('ACTUALS', 'ACTUAL') THEN 'ACTUAL'
 WHEN upper(forecast_type) IN ('FC', 'FORECAST') THEN 'FORECAST' WHEN curve_type IS NOT NULL THEN upper(curve_type) END"""


HASHED["run_cost_timeline"] = ["#period_date", "$amount", CURVE, "forecast_type"]


def _staged(kind: str, run: int, low: str, high: str) -> str:
    if kind == "schedule":
        return _latest("staffing_src", f"{_tags(run, kind)}, {SCHEDULE_COLUMNS}, reporting_date", low, high, "schedule_id")
    if kind == "timeline":
        cols = TIMELINE_COLUMNS.replace("dt_period", "strftime(period_start_date, '%Y%m') AS dt_period")
        return _latest("staffing_src", f"{_tags(run, kind)}, {cols}, reporting_date", low, high, "schedule_id",
                       "period_start_date")
    if kind == "cost":
        return _latest("cost_src", f"{_tags(run, kind)}, {COST_COLUMNS}, reporting_date", low, high, "cost_id")
    cols = (COST_TIMELINE_COLUMNS.replace("dt_period", "strftime(period_date, '%Y%m') AS dt_period")
            .replace("curve_type", f"{CURVE} AS curve_type"))
    return _latest("cost_src", f"{_tags(run, kind)}, {cols}, reporting_date", low, high, "cost_id", "period_date",
                   "AND period_date IS NOT NULL")


# (rule id, condition under which a row breaks it, reason)
RULES = {
    "schedule": [
        (1, "project_id IS NULL", " [PROJECT_ID_REQUIRED: PROJECT_ID IS NULL]"),
        (2, "position_id IS NULL", " [POSITION_ID_REQUIRED: POSITION_ID IS NULL]"),
        (3, "NOT (schedule_type IS NULL OR schedule_type IN ('Exempt','Non-Exempt','Exempt Agency','Non-Exempt Agency'))",
         " [SCHEDULE_TYPE_CHECK: SCHEDULE_TYPE check failed]"),
        (4, "NOT (schedule_status IS NULL OR schedule_status IN ('Open','Filled','Canceled','Approved','Rejected',"
            "'Withdrawn','Pending'))", " [SCHEDULE_STATUS_CHECK: SCHEDULE_STATUS check failed]"),
        (5, "schedule_start_date > schedule_end_date", " [SCHEDULE_DATE_ORDER: SCHEDULE_START_DATE check failed]")],
    "timeline": [
        (6, "dt_period IS NULL", " [DERIVED:DT_PERIOD could not be derived]"),
        (7, "allocated_hours IS NULL", " [ALLOCATED_HOURS_REQUIRED: ALLOCATED_HOURS IS NULL]"),
        (8, "allocated_hours < 0", " [ALLOCATED_HOURS_NON_NEGATIVE: ALLOCATED_HOURS check failed]"),
        (9, "period_start_date > period_end_date", " [PERIOD_DATE_ORDER: PERIOD_START_DATE check failed]")],
    "cost": [
        (10, "project_id IS NULL", " [PROJECT_ID_REQUIRED: PROJECT_ID IS NULL]"),
        (11, "cost_type IS NULL", " [COST_TYPE_REQUIRED: COST_TYPE IS NULL]"),
        (12, "upper(cost_category) NOT IN ('COMPANY','CLIENT')", " [COST_CATEGORY_CHECK: COST_CATEGORY check failed]")],
    "cost_timeline": [
        (13, "curve_type IS NULL", " [DERIVED:CURVE_TYPE could not be derived]"),
        (14, "dt_period IS NULL", " [DERIVED:DT_PERIOD could not be derived]"),
        (15, "amount IS NULL", " [AMOUNT_REQUIRED: AMOUNT IS NULL]"),
        (16, "forecast_type IS NULL", " [FORECAST_TYPE_REQUIRED: FORECAST_TYPE IS NULL]"),
        (17, "curve_type NOT IN ('ACTUAL','BUDGET','FORECAST')", " [CURVE_TYPE_VALUE_CHECK: CURVE_TYPE check failed]")],
}


def _checked(kind: str, source: str, only: list[int] | None = None) -> str:
    """Rows of ``source`` with the first broken rule."""
    rules = [r for r in RULES[kind] if only is None or r[0] in only]
    first = "CASE " + " ".join(f"WHEN {c} THEN {i}" for i, c, _ in rules) + " END"
    texts = "CASE stg_rule_id " + " ".join(f"WHEN {i} THEN '{t}'" for i, _, t in rules) + " END"
    return f"""SELECT * EXCLUDE (stg_status, stg_reject_reason, stg_rule_id), CAST(stg_rule_id AS BIGINT) AS stg_rule_id,
      CASE WHEN stg_rule_id IS NULL THEN 'PENDING' ELSE 'REJECTED' END AS stg_status, {texts} AS stg_reject_reason
      FROM (SELECT *, {first} AS stg_rule_id FROM {source})"""


ALL = ("1900-01-01", "2001-12-31")
BEFORE = ("1900-01-01", "1999-06-30")
AFTER = ("1997-06-30", "2001-12-31")
TAGS = "stg_run_id, stg_status, stg_reject_reason, stg_rule_id"

STATE = f"""SELECT {SCHEDULE_COLUMNS}, DATE '1999-06-30' AS effective_start_date,
  CASE WHEN reporting_date <= DATE '1996-06-30' THEN DATE '1999-06-30' ELSE DATE '9999-12-31' END AS effective_end_date,
  CASE WHEN reporting_date <= DATE '1996-06-30' THEN 'N' ELSE 'Y' END AS is_current,
  stg_record_hash AS record_hash, reporting_date, CAST(1 AS BIGINT) AS etl_run_id, DATE '1999-06-30' AS etl_load_date
  FROM staged_before"""


def _actions(staged: str, state: str, key: str) -> str:
    return f"""SELECT s.*, CASE WHEN t.{key} IS NULL THEN 'INSERT' WHEN t.record_hash = s.stg_record_hash THEN 'UNCHANGED'
      ELSE 'UPDATE' END AS todo FROM {staged} s LEFT JOIN {state} t ON t.{key} = s.{key} AND t.is_current = 'Y'"""


def _expired(state: str, key: str, columns: str) -> str:
    hit = f"is_current = 'Y' AND {key} IN (SELECT {key} FROM acted WHERE todo = 'UPDATE')"
    return f"""SELECT {columns}, effective_start_date,
      CASE WHEN {hit} THEN DATE '2001-12-30' ELSE effective_end_date END AS effective_end_date,
      CASE WHEN {hit} THEN 'N' ELSE is_current END AS is_current, record_hash, reporting_date, etl_run_id, etl_load_date
      FROM {state}"""


def _inserted(columns: str) -> str:
    return f"""SELECT {columns}, DATE '2001-12-31' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
      'Y' AS is_current, stg_record_hash AS record_hash, DATE '2001-12-31' AS reporting_date,
      CAST(2 AS BIGINT) AS etl_run_id, DATE '2001-12-31' AS etl_load_date FROM acted WHERE todo IN ('INSERT', 'UPDATE')"""


SCD = {"staged_before": _staged("schedule", 1, *BEFORE), "state": STATE, "staged": _staged("schedule", 2, *AFTER),
       "acted": _actions("staged", "state", "schedule_id")}


def _merged(columns: str, keys: list[str]) -> str:
    """State and pending rows joined in full; changed and new rows take the incoming values."""
    names = columns.split(", ")
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    new = "(t.record_hash IS NULL OR (s.stg_record_hash IS NOT NULL AND t.record_hash <> s.stg_record_hash))"
    picks = ", ".join(f"CASE WHEN {new} THEN s.{n} ELSE t.{n} END AS {n}" for n in names)
    return f"""SELECT {picks}, CASE WHEN {new} THEN s.stg_record_hash ELSE t.record_hash END AS record_hash,
      CASE WHEN {new} THEN DATE '2001-12-31' ELSE t.reporting_date END AS reporting_date,
      CASE WHEN {new} THEN CAST(2 AS BIGINT) ELSE t.etl_run_id END AS etl_run_id,
      CASE WHEN {new} THEN DATE '2001-12-31' ELSE t.etl_load_date END AS etl_load_date
      FROM state t FULL JOIN (SELECT * FROM staged WHERE stg_status = 'PENDING') s ON {on}"""


def _merge_ctes(kind: str, columns: str, rules: bool = True) -> dict[str, str]:
    ctes = {"raw_before": _staged(kind, 1, *BEFORE), "raw_after": _staged(kind, 2, *AFTER)}
    ctes["staged_before"] = _checked(kind, "raw_before") if rules else "SELECT * FROM raw_before"
    ctes["staged"] = _checked(kind, "raw_after") if rules else "SELECT * FROM raw_after"
    ctes["state"] = f"""SELECT {columns}, stg_record_hash AS record_hash, reporting_date, CAST(1 AS BIGINT) AS etl_run_id,
      DATE '1999-06-30' AS etl_load_date FROM staged_before WHERE stg_status = 'PENDING'"""
    return ctes


def _stamped(sql: str, source: str) -> str:
    """Rows of a run carry the newest date that the run had seen."""
    for day in ("1999-06-30", "2001-12-31"):
        newest = f"(SELECT max(reporting_date) FROM {source} WHERE reporting_date <= DATE '{day}')"
        sql = sql.replace(f"DATE '{day}' AS reporting_date", f"{newest} AS reporting_date")
        sql = sql.replace(f"THEN DATE '{day}' ELSE t.reporting_date", f"THEN {newest} ELSE t.reporting_date")
    return sql


ERROR_OF = "CASE WHEN stg_rule_id IN (6, 13, 14) THEN 'VAL_DERIVED_NULL' WHEN stg_rule_id IN (1, 2, 7, 10, 11, 15, 16) THEN 'VAL_NOT_NULL' ELSE 'VAL_CHECK_FAILED' END"


def _stopped(ctes: dict[str, str]) -> dict[str, str]:
    """The second load meets rows without a project, which stops it."""
    body = """SELECT 'ETL-20030' AS error_code,
      '-20030: ' || count(*) FILTER (stg_rule_id = 1) || ' row(s) break rule PROJECT_ID_REQUIRED, which stops the load' AS error_message,
      (SELECT count(*) FROM state) AS dimension_rows, CAST(1 AS BIGINT) AS newest_run,
      count(*) FILTER (stg_status = 'REJECTED') AS captured_rows, CAST(1 AS BIGINT) AS committed_run FROM whole"""
    return {"run_fail_rule": _with(body, **{k: ctes[k] for k in ("raw_before", "checked_before", "state", "raw_after")},
                                   whole=_checked("schedule", "raw_after"))}


def _error_records(late: tuple[str, str]) -> str:
    ctes, parts = {}, []
    for run, window in ((1, BEFORE), (2, late)):
        for kind, target in (("cost", "dim_cost"), ("cost_timeline", "dim_timeline_cost")):
            ctes[f"raw_{kind}_{run}"] = _staged(kind, run, *window)
            key = "'COST_ID=' || cost_id" + (" || '|DT_PERIOD=' || coalesce(dt_period, '')" if kind == "cost_timeline" else "")
            project = "project_id" if kind == "cost" else "CAST(NULL AS VARCHAR)"
            parts.append(f"""SELECT CAST({run} AS BIGINT) AS run_id, 'COST' AS entity_name, '{target}' AS target_table, {ERROR_OF} AS error_code,
              trim(stg_reject_reason) AS error_message, {key} AS record_key, {project} AS project_id,
              strftime(reporting_date, '%Y-%m-%d') AS day FROM ({_checked(kind, f"raw_{kind}_{run}")}) WHERE stg_status = 'REJECTED'""")
    return _with(" UNION ALL ".join(parts), **ctes)


def _all_log() -> str:
    """Runs 1 and 2: staffing fails, costs load; runs 3 and 4: staffing loads, costs bring nothing."""
    none = ", ".join(f"CAST(NULL AS BIGINT) AS {c}" for c in ("rows_read", "rows_inserted", "rows_updated", "rows_rejected"))
    rows = [f"SELECT CAST({run} AS BIGINT) AS run_id, CAST({entity} AS BIGINT) AS entity_id, CAST({mapping} AS BIGINT) AS mapping_id, '{status}' AS status, {none}"
            for run, entity, mapping, status in ((1, 1, 1, "FAILED"), (1, 1, "NULL", "FAILED"), (2, 2, "NULL", "SUCCESS"), (3, 1, "NULL", "SUCCESS"), (4, 2, "NULL", "SUCCESS"))]
    ctes = {}
    for run, entity, mapping, kind in ((2, 2, 3, "cost"), (2, 2, 4, "cost_timeline"), (3, 1, 1, "schedule"), (3, 1, 2, "timeline")):
        ctes[f"raw_{kind}"] = _staged(kind, run, *ALL)
        rows.append(f"""SELECT CAST({run} AS BIGINT), CAST({entity} AS BIGINT), CAST({mapping} AS BIGINT), 'SUCCESS', count(*),
          count(*) FILTER (stg_status = 'PENDING'), CAST(0 AS BIGINT), count(*) FILTER (stg_status = 'REJECTED') FROM ({_checked(kind, f"raw_{kind}")})""")
    return _with(" UNION ALL ".join(rows), **ctes)


def _runs() -> dict[str, str]:
    """Two whole loads of each entity."""
    late = ("1999-06-30", "2001-12-31")
    bodies, found = {}, {}
    for name, kind, key, columns, source in (
            ("dim_staffing_schedule", "schedule", "schedule_id", SCHEDULE_COLUMNS, "staffing_src"),
            ("dim_cost", "cost", "cost_id", COST_COLUMNS, "cost_src")):
        ctes = {
            "raw_before": _staged(kind, 1, *BEFORE), "checked_before": _checked(kind, "raw_before"),
            "state": f"""SELECT {columns}, DATE '1999-06-30' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
              'Y' AS is_current, stg_record_hash AS record_hash, DATE '1999-06-30' AS reporting_date,
              CAST(1 AS BIGINT) AS etl_run_id, DATE '1999-06-30' AS etl_load_date FROM checked_before WHERE stg_status = 'PENDING'""",
            "raw_after": _staged(kind, 2, *late),
            "staged": f"SELECT * FROM ({_checked(kind, 'raw_after')}) WHERE stg_status = 'PENDING'",
            "acted": _actions("staged", "state", key)}
        body = f"{_expired('state', key, columns)} UNION ALL BY NAME {_inserted(columns)}"
        bodies[name] = _stamped(_with(body, **ctes), source)
        if kind == "cost":
            found["run_renamed_cost"] = f"SELECT * EXCLUDE (cost_id, project_id), cost_id AS record_id, project_id AS project_code FROM ({bodies[name]})"
        if kind == "schedule":
            found |= _stopped(ctes)
            found["run_lineage"] = _with(f"""SELECT schedule_id, etl_run_id, 'SUCCESS' AS etl_run_status FROM ({body})
              WHERE is_current = 'Y'""", **ctes)
    for name, kind, keys, columns, source in (
            ("dim_staffing_timeline", "timeline", ["schedule_id", "dt_period"], TIMELINE_COLUMNS, "staffing_src"),
            ("dim_timeline_cost", "cost_timeline", ["cost_id", "dt_period"], COST_TIMELINE_COLUMNS, "cost_src")):
        ctes = {
            "raw_before": _staged(kind, 1, *BEFORE), "checked_before": _checked(kind, "raw_before"),
            "state": f"""SELECT {columns}, stg_record_hash AS record_hash, DATE '1999-06-30' AS reporting_date,
              CAST(1 AS BIGINT) AS etl_run_id, DATE '1999-06-30' AS etl_load_date FROM checked_before WHERE stg_status = 'PENDING'""",
            "raw_after": _staged(kind, 2, *late), "staged": _checked(kind, "raw_after")}
        # A run hashes all tracked columns, the curve included.
        ctes = {n: t.replace(_hash("cost_timeline"), _hash("run_cost_timeline")) for n, t in ctes.items()}
        bodies[name] = _stamped(_with(_merged(columns, keys), **ctes), source)
    for name, key in (("run_staffing_schedule", "dim_staffing_schedule"), ("run_staffing_timeline", "dim_staffing_timeline"),
                      ("run_cost", "dim_cost"), ("run_cost_timeline", "dim_timeline_cost")):
        found[name] = bodies[key]
    found["run_entity_keys"] = " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS rows, count(*) AS distinct_keys "
        f"FROM ({body})" for name, body in bodies.items())
    found["run_error_records"] = _error_records(late)
    found["run_all_log"] = _all_log()
    found["run_control"] = _with("""SELECT 'COST' AS entity_name, 'SUCCESS' AS status, max(reporting_date) AS last_watermark,
      CAST(2 AS BIGINT) AS last_run_id FROM cost_src WHERE reporting_date <= DATE '2001-12-31'""")
    return found


# ---------------------------------------------------------------- coded feed
CODES = [("project_id", "project_id"), ("business_unit", "business_unit_id"),
         ("substr(execution_center, 1, 2)", "operating_center_id"), ("substr(bill_type, 1, 2)", "bill_type_id"),
         ("wbs_1_code", "wbs1_id"), ("wbs_2_code", "wbs2_id"), ("substr(cost_type, 1, 5)", "cost_type_id"),
         ("substr(cbs, 1, 7)", "cbs_id")]
FULL_CODES = ["project_id", "business_unit", "execution_center", "bill_type", "wbs_1_code", "wbs_2_code", "cost_type", "cbs"]
PREFIXES = ", ".join(f"{src} AS {name}" for src, name in CODES)
NAMES = "portfolio_id, " + ", ".join(name for _, name in CODES)
NOW_FEED = """SELECT * REPLACE (DATE '1998-01-31' AS reporting_date) FROM coded_src
  WHERE reporting_date > DATE '1997-06-30' AND reporting_date <= DATE '2001-12-31'"""
NOW_SCOPE = "SELECT * FROM feed WHERE portfolio_id = 'P1' AND reporting_date = DATE '1998-01-31'"


def _keyed(source: str, portfolio: str) -> str:
    on = " AND ".join(f"r.{name} = {src.replace('(', '(s.') if '(' in src else 's.' + src}" for src, name in CODES)
    return (f"SELECT s.*, r.gcs_key FROM {source} s JOIN coding_reference_src r "
            f"ON r.portfolio_id = '{portfolio}' AND {on} AND r.is_valid = 1")


def _dotted(portfolio: str) -> str:
    return " || '.' || ".join([portfolio, *[f"coalesce({c}, '')" for c in FULL_CODES]])


def _coded_columns(portfolio: str) -> str:
    return f"'{portfolio}' AS project_id, " + ", ".join(f"{s} AS {n}" for s, n in CODES if n != "project_id")


def _stamp(moment: str, user: str) -> str:
    return (f"1 AS is_valid, TIMESTAMP '{moment}' AS dt_created, '{user}' AS created_by, "
            f"TIMESTAMP '{moment}' AS dt_modified, '{user}' AS modified_by")


def _schedule_rows(source: str, portfolio: str, day: str, moment: str, user: str) -> str:
    dotted = _dotted("'" + portfolio + "'")
    return f"""SELECT gcs_key, DATE '{day}' AS dt_reporting, {_coded_columns(portfolio)},
      {dotted} AS sts_global_structure, position_number, employee_id,
      plan_start_date AS dt_plan_start, plan_end_date AS dt_plan_end, forecast_start_date AS dt_forecast_start,
      forecast_end_date AS dt_forecast_end, hours_per_week, 1 AS is_current, {_stamp(moment, user)} FROM {source}"""


def _months(source: str, columns: str) -> str:
    """One row per month number of each row's own range."""
    return f"""SELECT {columns}, dt_period,
      CASE WHEN dt_period BETWEEN date_trunc('month', plan_start_date) AND date_trunc('month', plan_end_date)
           THEN hours_per_week END AS plan_hours,
      CASE WHEN dt_period BETWEEN date_trunc('month', forecast_start_date) AND date_trunc('month', forecast_end_date)
           THEN hours_per_week END AS forecast_hours
      FROM (SELECT *, CAST(first + to_months(CAST(n AS INTEGER)) AS DATE) AS dt_period FROM (
        SELECT *, CAST(date_trunc('month', least(plan_start_date, forecast_start_date)) AS DATE) AS first,
          CAST(date_trunc('month', greatest(plan_end_date, forecast_end_date)) AS DATE) AS last FROM {source}) b
        , unnest(range(0, coalesce(date_diff('month', first, last), -1) + 1)) AS nums(n))"""


def _timeline_rows(source: str, portfolio: str, day: str, moment: str, user: str) -> str:
    cols = (f"gcs_key, DATE '{day}' AS dt_reporting, '{portfolio}' AS project_id, position_number, employee_id, "
            f"1 AS is_current, {_stamp(moment, user)}")
    return _months(source, cols)


CLASSES = {
    "COMPANY": [("OB COMPANY", "original_budget"), ("BUDGET", "current_budget"), ("EAC COMPANY", "forecast_budget"),
                ("FORECAST", "etc_budget"), ("EARNED", "earned_budget")],
    "CLIENT": [("OB CLIENT", "original_budget"), ("BUDGET CLIENT", "current_budget"), ("EAC CLIENT", "forecast_budget"),
               ("FORECAST CLIENT", "etc_budget"), ("EARNED CLIENT", "earned_budget"), ("ACTUAL CLIENT", None)]}


def _classes(source: str, columns: str) -> str:
    branches = []
    for basis, classes in CLASSES.items():
        for name, stem in classes:
            hours, cost = (f"{stem}_hours", f"{stem}_cost") if stem else ("client_hours", "value_of_work_done")
            branches.append(f"SELECT {columns}, '{name}' AS class, {hours} AS hours, {cost} AS cost FROM {source} "
                            f"WHERE upper(cost_basis) = '{basis}'")
    return " UNION ALL ".join(branches)


def _cost_rows(source: str, portfolio: str, day: str, moment: str, user: str) -> str:
    dotted = _dotted("'" + portfolio + "'")
    return _classes(source, f"""gcs_key, DATE '{day}' AS dt_reporting, {_coded_columns(portfolio)},
      {dotted} AS sts_global_structure, cost_basis, forecast_start_date AS dt_forecast_start,
      forecast_end_date AS dt_forecast_end, 'GENERIC LOAD' AS data_source, {_stamp(moment, user)}""")


def _reload_ctes(build) -> dict[str, str]:
    old = "SELECT * FROM coded_src WHERE reporting_date > DATE '1900-01-01' AND reporting_date <= DATE '1999-06-30'"
    states = [("P1", "1998-01-31"), ("P2", "1998-01-31"), ("P0", "1998-01-31"), ("P1", "1997-12-31")]
    ctes = {"feed": NOW_FEED, "scope": NOW_SCOPE, "keyed": _keyed("scope", "P1"), "old_feed": old,
            "old_p0": f"SELECT * FROM ({_keyed('old_feed', 'P0')}) WHERE portfolio_id = 'P0'",
            "old_p1": f"SELECT * FROM ({_keyed('old_feed', 'P1')}) WHERE portfolio_id = 'P1'",
            "old_p2": f"SELECT * FROM ({_keyed('old_feed', 'P2')}) WHERE portfolio_id = 'P2'"}
    ctes["before"] = " UNION ALL ".join(
        f"SELECT * FROM ({build(f'old_{p.lower()}', p, day, '1998-01-31 06:00:00', 'before')})" for p, day in states)
    ctes["added"] = build("keyed", "P1", "1998-01-31", "1998-02-01 06:00:00", "load")
    return ctes


def _reloaded(hit: str) -> str:
    return f"""SELECT * REPLACE (CASE WHEN {hit} THEN 0 ELSE is_valid END AS is_valid,
      CASE WHEN {hit} THEN TIMESTAMP '1998-02-01 06:00:00' ELSE dt_modified END AS dt_modified,
      CASE WHEN {hit} THEN 'load' ELSE modified_by END AS modified_by) FROM before
      UNION ALL BY NAME SELECT * FROM added"""


SCOPE = "project_id = 'P1' AND dt_reporting = DATE '1998-01-31' AND is_valid = 1"
MATCHED = SCOPE + """ AND EXISTS (SELECT 1 FROM keyed k WHERE k.gcs_key = before.gcs_key
  AND k.employee_id = before.employee_id AND k.position_number = before.position_number)"""


def _scope_runs() -> dict[str, str]:
    """Two scope loads of each portfolio: the whole scope, one center, and rows that come again are replaced.

    The loads number combinations of codes themselves, so the codes stand for the key here.
    """
    code = "concat_ws('|', portfolio_id, " + ", ".join(src for src, _ in CODES) + ")"
    whole = " AND ".join(f"{c} IS NOT NULL" for c in FULL_CODES)
    keyed = f"SELECT *, {code} AS gcs_key FROM coded_src WHERE {whole} AND reporting_date > DATE '{{}}' AND reporting_date <= DATE '{{}}'"
    ctes = {"old_keyed": keyed.format(*BEFORE), "new_keyed": keyed.format(*AFTER)}
    for p in ("P0", "P1", "P2"):
        ctes[f"old_{p.lower()}"] = f"SELECT * FROM old_keyed WHERE portfolio_id = '{p}'"
        ctes[f"new_{p.lower()}"] = f"SELECT * FROM new_keyed WHERE portfolio_id = '{p}'" + (" AND substr(execution_center, 1, 2) = 'AU'" if p == "P2" else "")
    again = """EXISTS (SELECT 1 FROM new_p0 k WHERE k.gcs_key = before.gcs_key AND k.employee_id = before.employee_id
      AND k.position_number = before.position_number)"""
    hit = f"(project_id = 'P1' OR (project_id = 'P2' AND split_part(gcs_key, '|', 4) = 'AU') OR (project_id = 'P0' AND {again}))"
    found, parts = {}, []
    for name, table, build, hits in (
            ("run_scope_schedule", "valid_staffing_schedule", _schedule_rows, hit),
            ("run_scope_timeline", "valid_staffing_timeline", _timeline_rows, hit), ("run_scope_cost", "valid_cost", _cost_rows, "true")):
        mine = dict(ctes)
        if name == "run_scope_cost":
            mine["new_p2"] = "SELECT * FROM new_keyed WHERE portfolio_id = 'P2'"
        for state, moment, user in (("before", "1998-01-31 06:00:00", "before"), ("added", "1998-02-01 06:00:00", "load")):
            mine[state] = " UNION ALL ".join(f"SELECT * FROM ({build(f'{w}_{p.lower()}', p, '1998-01-31', moment, user)})"
                                             for w in (("old",) if state == "before" else ("new",)) for p in ("P0", "P1", "P2"))
        body = f"SELECT * EXCLUDE (gcs_key) FROM ({_reloaded(hits)})"
        found[name] = _with(body, **mine)
        parts.append(f"""SELECT '{table}' AS tbl, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS rows, count(*) AS distinct_keys FROM ({found[name]})""")
    # Combinations with missing codes are in the reference too; the second load of P2 brings one center only.
    both = f"""SELECT DISTINCT portfolio_id, {PREFIXES} FROM coded_src WHERE portfolio_id IN ('P0', 'P1', 'P2') AND
      (reporting_date <= DATE '1999-06-30' OR (reporting_date > DATE '1997-06-30' AND reporting_date <= DATE '2001-12-31'
        AND (portfolio_id <> 'P2' OR substr(execution_center, 1, 2) = 'AU')))"""
    parts.append("SELECT 'coding_reference' AS tbl, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS rows, count(*) AS distinct_keys "
                 f"FROM ({_with(both)})")
    found["run_scope_keys"] = " UNION ALL ".join(parts)
    return found


def _prefixed(ctes: dict[str, str], prefix: str) -> dict[str, str]:
    """The same CTEs under other names, so two sets fit in one query."""
    import re
    out = {}
    for name, text in ctes.items():
        for other in ctes:
            text = re.sub(rf"(?<![\w.']){other}(?![\w(])", f"{prefix}{other}", text)
        out[f"{prefix}{name}"] = text
    return out


# ---------------------------------------------------------------- logs
NAMED = """(SELECT 1 AS entity_id, 'STAFFING_SCHEDULE' AS entity_name UNION ALL SELECT 2, 'COST')"""
TARGETS = """(SELECT 1 AS mapping_id, 'dim_staffing_schedule' AS target_table UNION ALL SELECT 2, 'dim_staffing_timeline'
  UNION ALL SELECT 3, 'dim_cost' UNION ALL SELECT 4, 'dim_timeline_cost')"""
SECS = "date_diff('second', r.start_time, r.end_time)"
RUNS = f"FROM run_log_src r JOIN {NAMED} e ON e.entity_id = r.entity_id LEFT JOIN {TARGETS} m ON m.mapping_id = r.mapping_id"
RUN_COUNTS = "rows_inserted, rows_updated, rows_expired, rows_rejected"
SUMMARY = f"""SELECT run_id, entity_name, target_table, start_time, end_time, {SECS} AS elapsed_secs, status, {RUN_COUNTS},
  error_message {RUNS} WHERE start_time >= TIMESTAMP '2024-01-23 12:00:00'"""
TODAY = f"""SELECT run_id, r.mapping_id, entity_name, target_table, status, start_time, end_time, {SECS} AS elapsed_secs,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in RUN_COUNTS.split(', '))}, error_message
  {RUNS} WHERE CAST(start_time AS DATE) = DATE '2024-01-30'"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["incremental_window"] = _with("""SELECT schedule_id, employee_id, reporting_date, src_seq FROM staffing_src
      WHERE reporting_date > DATE '1997-06-30' AND reporting_date <= DATE '2001-12-31'""")
    o["max_source_watermark"] = _with("SELECT max(reporting_date) AS max_watermark FROM staffing_src")
    o["max_stored_watermark"] = "SELECT max(l_orderkey) AS max_watermark FROM lineitem"
    o["watermark_state"] = _with("""SELECT entity_id, coalesce(last_watermark, DATE '1900-01-01') AS from_watermark,
      top AS to_watermark, CASE WHEN top > coalesce(last_watermark, DATE '1900-01-01') THEN top ELSE last_watermark END
      AS next_watermark FROM control_src, (SELECT max(reporting_date) AS top FROM cost_src)""")
    o["scope_filter"] = _with("""SELECT portfolio_id, project_id, employee_id, position_number, order_ref,
      last_day(reporting_date) AS reporting_date FROM coded_src
      WHERE portfolio_id = 'P1' AND last_day(reporting_date) = DATE '1998-01-31'""")
    o["source_probe"] = _with("SELECT CAST(count(*) AS INTEGER) AS source_ok FROM (SELECT 1 FROM staffing_src LIMIT 1)")
    o["source_scope_counts"] = _with("""SELECT portfolio_id, reporting_date AS reporting_day, count(*) AS row_count
      FROM coded_src GROUP BY portfolio_id, reporting_date""")
    o["mapped_projection"] = _with("""SELECT cost_id AS record_id, reporting_date AS day, project_id, cost_center, cost_type,
      cost_category, currency FROM cost_src""")
    o["derive_curve_type"] = _with(f"SELECT cost_id, src_seq, forecast_type, {CURVE} AS derived_curve FROM cost_src")
    o["derive_period"] = _with(
        "SELECT schedule_id, src_seq, strftime(period_start_date, '%Y%m') AS dt_period FROM staffing_src")
    o["record_hash"] = _with(f"""SELECT schedule_id, src_seq, {_hash('schedule')} AS schedule_hash,
      {_hash('timeline')} AS timeline_hash FROM staffing_src""")
    o["coding_prefixes"] = _with(f"SELECT portfolio_id, {PREFIXES} FROM coded_src")
    o["composite_code"] = _with(
        f"SELECT order_ref, position_number, {_dotted('portfolio_id')} AS sts_global_structure FROM coded_src")
    o["three_valued_not"] = _with("""SELECT schedule_id, src_seq, schedule_type FROM staffing_src
      WHERE NOT (schedule_type IN ('Exempt', 'Casual'))""")

    o["latest_per_key"] = _with(_latest("staffing_src", "* EXCLUDE (pick)", *BEFORE, "schedule_id"))
    o["latest_per_key_month"] = _with(_latest(
        "staffing_src", "schedule_id, period_start_date, allocated_hours, reporting_date, src_seq", *BEFORE, "schedule_id",
        "period_start_date"))
    for key, kind in (("transform_staffing", "schedule"), ("transform_staffing_timeline", "timeline"),
                      ("transform_cost", "cost"), ("transform_cost_timeline", "cost_timeline")):
        o[key] = _with(_staged(kind, 1, *ALL))

    cost = {"raw": _staged("cost", 1, *ALL)}
    o["rule_not_null"] = _with(f"SELECT cost_id, {TAGS} FROM ({_checked('cost', 'raw', [10, 11])})", **cost)
    curve = "CASE WHEN upper(forecast_type) IN ('ACTUALS','ACTUAL') THEN 'ACTUAL' " \
            "WHEN upper(forecast_type) IN ('FC','FORECAST') THEN 'FORECAST' END"
    # The second rule fills the period only where the first one was met.
    o["rule_derived"] = _with(
        f"""SELECT cost_id, period_date, curve_type, dt_period, {TAGS}
        FROM ({_checked('cost_timeline', 'filled', [13, 14])})""",
        raw=_staged("cost_timeline", 1, *ALL),
        filled=f"""SELECT * REPLACE ({curve} AS curve_type,
          CASE WHEN {curve} IS NOT NULL THEN dt_period END AS dt_period) FROM raw""")
    schedule = {"raw": _staged("schedule", 1, *ALL)}
    o["rule_check"] = _with(f"SELECT schedule_id, {TAGS} FROM ({_checked('schedule', 'raw', [3, 4, 5])})", **schedule)
    o["validate_rules"] = _with(f"SELECT schedule_id, {TAGS} FROM ({_checked('schedule', 'raw')})", **schedule)
    o["validate_staffing_timeline"] = _with(f"SELECT schedule_id, dt_period, {TAGS} FROM ({_checked('timeline', 'raw')})",
                                            raw=_staged("timeline", 1, *ALL))
    o["validate_cost"] = _with(f"SELECT cost_id, {TAGS} FROM ({_checked('cost', 'raw')})", **cost)
    o["validate_cost_timeline"] = _with(
        f"SELECT cost_id, dt_period, curve_type, {TAGS} FROM ({_checked('cost_timeline', 'raw')})",
        raw=_staged("cost_timeline", 1, *ALL))
    everything: dict[str, str] = {}
    for kind in RULES:
        everything[f"raw_{kind}"] = _staged(kind, 1, *ALL)
        everything[f"checked_{kind}"] = _checked(kind, f"raw_{kind}")
    o["rejection_counts"] = _with(" UNION ALL ".join(
        f"SELECT stg_rule_id AS rule_id, count(*) AS rejected_rows FROM checked_{k} WHERE stg_rule_id IS NOT NULL "
        "GROUP BY stg_rule_id" for k in RULES), **everything)
    o["rejected_rows"] = _with(" UNION ALL ".join(
        f"""SELECT '{name}' AS staging_table, stg_run_id, {key} AS record_key, dt_period, stg_reject_reason, reporting_date
        FROM checked_{kind} WHERE stg_status = 'REJECTED'""" for name, kind, key in (
            ("stg_staffing_timeline", "timeline", "schedule_id"), ("stg_timeline_cost", "cost_timeline", "cost_id"))),
        **everything)
    o["purge_pending"] = _with(" UNION ALL ".join(
        f"SELECT '{name}' AS staging_table, {key} AS record_key, {TAGS} FROM checked_{kind} WHERE stg_status <> 'PENDING'" for name, kind, key in (
            ("stg_staffing_schedule", "schedule", "schedule_id"), ("stg_staffing_timeline", "timeline", "schedule_id"),
            ("stg_cost", "cost", "cost_id"), ("stg_timeline_cost", "cost_timeline", "cost_id"))), **everything)
    summary = dict(everything, staged_before=_staged("schedule", 1, *BEFORE), state=STATE,
                   acted=_actions("checked_schedule", "state", "schedule_id"))
    loaded = "CASE stg_status WHEN 'PENDING' THEN 'LOADED' ELSE stg_status END"

    def counted(name: str, source: str, action: str) -> str:
        return f"""SELECT '{name}' AS staging_table, stg_run_id, {loaded} AS stg_status,
          CASE WHEN stg_status = 'PENDING' THEN {action} END AS stg_action, count(*) AS row_count FROM {source}
          GROUP BY ALL"""

    o["staging_summary"] = _with(" UNION ALL ".join([
        counted("stg_staffing_schedule", "acted", "todo"), counted("stg_staffing_timeline", "checked_timeline", "'MERGE'"),
        counted("stg_cost", "acted_cost", "todo"), counted("stg_timeline_cost", "checked_cost_timeline", "'MERGE'")]),
        **summary, before_cost=_staged("cost", 1, *BEFORE),
        cost_state="SELECT cost_id, stg_record_hash AS record_hash, 'Y' AS is_current FROM before_cost",
        acted_cost=_actions("checked_cost", "cost_state", "cost_id"))
    o["run_metrics"] = _with("""SELECT stg_run_id AS run_id, count(*) AS rows_read,
      count(*) FILTER (stg_status = 'PENDING' AND todo = 'INSERT') AS rows_inserted,
      count(*) FILTER (stg_status = 'PENDING' AND todo = 'UPDATE') AS rows_updated,
      count(*) FILTER (stg_status = 'PENDING' AND todo = 'UPDATE') AS rows_expired,
      count(*) FILTER (stg_status = 'PENDING' AND todo = 'UNCHANGED') AS rows_skipped,
      count(*) FILTER (stg_status = 'REJECTED') AS rows_rejected FROM acted GROUP BY stg_run_id""",
        **{k: v for k, v in summary.items() if k in ("raw_schedule", "checked_schedule", "staged_before", "state", "acted")})

    o["scd2_classify"] = _with("SELECT schedule_id, todo AS stg_action, stg_record_hash FROM acted", **SCD)
    o["new_keys_anti"] = _with("""SELECT schedule_id, stg_record_hash FROM staged
      WHERE schedule_id NOT IN (SELECT schedule_id FROM state WHERE is_current = 'Y')""", **SCD)
    expired = _expired("state", "schedule_id", SCHEDULE_COLUMNS)
    o["scd2_expire"] = _with(expired, **SCD)
    o["scd2_insert"] = _with(_inserted(SCHEDULE_COLUMNS), **SCD)
    after = f"{expired} UNION ALL BY NAME {_inserted(SCHEDULE_COLUMNS)}"
    o["scd2_apply"] = _with(after, **SCD)
    o["version_history"] = _with(f"""SELECT {SCHEDULE_COLUMNS}, effective_start_date, effective_end_date, is_current,
      reporting_date, etl_run_id FROM ({after}) ORDER BY schedule_id, effective_start_date""", **SCD)
    o["duplicate_current"] = _with("""SELECT schedule_id, count(*) AS duplicate_count FROM staffing_src
      WHERE schedule_status = 'Open' GROUP BY schedule_id HAVING count(*) > 1""")
    o["surrogate_keys"] = _with("""SELECT CAST(1001 AS BIGINT) AS lowest, 1000 + count(*) AS highest, count(*) AS rows,
      count(*) AS distinct_keys FROM staged
      WHERE schedule_id NOT IN (SELECT schedule_id FROM state WHERE is_current = 'Y')""", **SCD)
    o["incremental_merge"] = _with(_merged(TIMELINE_COLUMNS, ["schedule_id", "dt_period"]),
                                   **_merge_ctes("timeline", TIMELINE_COLUMNS))
    o["incremental_merge_cost"] = _with(_merged(COST_TIMELINE_COLUMNS, ["cost_id", "dt_period"]),
                                        **_merge_ctes("cost_timeline", COST_TIMELINE_COLUMNS))
    o["scd1_upsert"] = _with(_merged(COST_COLUMNS, ["cost_id"]), **_merge_ctes("cost", COST_COLUMNS, rules=False))
    loads = {
        "raw_before": _staged("cost", 1, *BEFORE), "checked_before": _checked("cost", "raw_before"),
        "state": f"""SELECT {COST_COLUMNS}, DATE '1999-06-30' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
          'Y' AS is_current, stg_record_hash AS record_hash, DATE '1999-06-30' AS reporting_date,
          CAST(1 AS BIGINT) AS etl_run_id, DATE '1999-06-30' AS etl_load_date
          FROM checked_before WHERE stg_status = 'PENDING'""",
        "raw_after": _staged("cost", 2, "1999-06-30", "2001-12-31"),
        "staged": f"SELECT * FROM ({_checked('cost', 'raw_after')}) WHERE stg_status = 'PENDING'",
        "acted": _actions("staged", "state", "cost_id")}
    o["cost_entity_load"] = _with(
        f"{_expired('state', 'cost_id', COST_COLUMNS)} UNION ALL BY NAME {_inserted(COST_COLUMNS)}", **loads)
    cost_after = f"{_expired('state', 'cost_id', COST_COLUMNS)} UNION ALL BY NAME {_inserted(COST_COLUMNS)}"
    o["cost_version_history"] = _with(f"""SELECT {COST_COLUMNS}, effective_start_date, effective_end_date, is_current,
      reporting_date, etl_run_id FROM ({cost_after}) ORDER BY cost_id, effective_start_date""", **loads)
    o["cost_current_with_lineage"] = _with(f"""SELECT s.* REPLACE (r.run_id AS etl_run_id), r.start_time AS etl_run_start,
      r.status AS etl_run_status FROM ({cost_after}) s,
      (SELECT * FROM run_log_src WHERE run_id = (SELECT max(run_id) FROM run_log_src)) r WHERE is_current = 'Y'""", **loads)
    o["duplicate_report"] = _with("""SELECT 'dim_staffing_schedule' AS dimension, schedule_id AS record_key,
      count(*) AS duplicate_count FROM staffing_src WHERE schedule_status = 'Open' GROUP BY schedule_id HAVING count(*) > 1
      UNION ALL SELECT 'dim_cost', cost_id, count(*) FROM cost_src WHERE currency = 'USD' GROUP BY cost_id HAVING count(*) > 1""")
    o |= _runs()
    o |= _scope_runs()
    whole = dict(SCD, raw_after=SCD["staged"],
                 staged=f"SELECT * FROM ({_checked('schedule', 'raw_after')}) WHERE stg_status = 'PENDING'")
    whole = {k: whole[k] for k in ("staged_before", "state", "raw_after", "staged", "acted")}
    o["staffing_entity_load"] = _with(after, **whole)
    o["current_with_lineage"] = _with("""SELECT s.* REPLACE (CAST(schedule_id AS BIGINT) AS etl_run_id),
      r.start_time AS etl_run_start, r.status AS etl_run_status FROM state s LEFT JOIN run_log_src r
      ON r.run_id = CAST(s.schedule_id AS BIGINT) WHERE is_current = 'Y'""",
        staged_before=SCD["staged_before"], state=STATE)

    feed = {"feed": NOW_FEED, "scope": NOW_SCOPE}
    o["distinct_codings"] = _with(f"SELECT DISTINCT portfolio_id, {PREFIXES} FROM scope", **feed)
    o["gcs_stage_codings"] = _with(f"""SELECT DISTINCT portfolio_id, {PREFIXES}, 1 AS staffing_flag,
      CAST(NULL AS INTEGER) AS cost_flag, 1 AS is_valid, TIMESTAMP '1998-01-31 06:00:00' AS dt_created,
      'before' AS created_by FROM feed WHERE portfolio_id = 'P2'
      UNION ALL SELECT DISTINCT portfolio_id, {PREFIXES}, CAST(NULL AS INTEGER), 1, 1, TIMESTAMP '1998-02-01 06:00:00',
      'load' FROM scope""", **feed)
    o["gcs_lookup"] = _with(f"SELECT gcs_key, project_id, employee_id, position_number, order_ref "
                            f"FROM ({_keyed('scope', 'P1')})", **feed)
    o["gcs_unmatched"] = _with(f"SELECT (SELECT count(*) FROM scope) - (SELECT count(*) FROM ({_keyed('scope', 'P1')})) "
                               "AS unmatched_rows", **feed)
    new_codes = f"""SELECT {NAMES} FROM codings EXCEPT SELECT {NAMES} FROM known"""
    same = " AND ".join(f"k.{n} IS NOT DISTINCT FROM c.{n}" for n in NAMES.split(", "))
    codings = dict(feed, codings=f"SELECT DISTINCT portfolio_id, {PREFIXES} FROM scope",
                   known="SELECT * FROM coding_reference_src WHERE business_unit_id = 'A'", fresh=new_codes)
    o["gcs_reference_upsert"] = _with(f"""SELECT k.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM codings c WHERE {same})
      THEN 1 ELSE cost_flag END AS cost_flag) FROM known k
      UNION ALL BY NAME SELECT *, CAST(NULL AS BIGINT) AS gcs_key, 0 AS staffing_flag, 1 AS cost_flag, 1 AS is_valid
      FROM fresh""", **codings)
    o["gcs_new_keys"] = _with("""SELECT top + 1 AS lowest, top + n AS highest, n AS rows, n AS distinct_keys
      FROM (SELECT max(gcs_key) AS top FROM known), (SELECT count(*) AS n FROM fresh)""", **codings)

    o["monthly_expansion"] = _with(_months("coded_src", "order_ref, position_number, employee_id"))
    o["cost_class_unpivot"] = _with(_classes("coded_src", "order_ref, position_number, cost_basis"))
    schedule_ctes, timeline_ctes, cost_ctes = (_reload_ctes(b) for b in (_schedule_rows, _timeline_rows, _cost_rows))
    in_center = SCOPE + " AND operating_center_id = 'AU'"
    o["replace_all_reload"] = _with(_reloaded(in_center), **schedule_ctes)
    o["add_update_reload"] = _with(_reloaded(MATCHED), **schedule_ctes)
    o["timeline_replace_all"] = _with(_reloaded(SCOPE), **timeline_ctes)
    o["timeline_add_update"] = _with(_reloaded(MATCHED), **timeline_ctes)
    o["cost_full_reload"] = _with(_reloaded(SCOPE), **cost_ctes)
    o["timeline_key_ranges"] = _with("""SELECT CAST(5001 AS BIGINT) AS lowest, 5000 + count(*) AS highest, count(*) AS rows,
      count(*) AS distinct_keys FROM added""", **{k: timeline_ctes[k] for k in ("feed", "scope", "keyed", "added")})
    sets, parts = {}, []
    for prefix, table, ctes, hit in (("s_", "dim_staffing_schedule", schedule_ctes, in_center),
                                     ("t_", "dim_staffing_timeline", timeline_ctes, SCOPE),
                                     ("c_", "dim_cost", cost_ctes, SCOPE)):
        sets |= _prefixed(ctes, prefix)
        parts.append(f"""SELECT '{table}' AS tbl, CAST(sum(CASE WHEN is_valid = 1 THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
          CAST(sum(CASE WHEN is_valid = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_rows FROM (
          SELECT CASE WHEN {hit} THEN 0 ELSE is_valid END AS is_valid FROM {prefix}before
          UNION ALL SELECT is_valid FROM {prefix}added)""")
    o["validity_counts"] = _with(" UNION ALL ".join(parts), **sets)
    o["valid_by_portfolio"] = _with(f"""SELECT project_id AS portfolio_id, count(*) AS valid_rows
      FROM ({_reloaded(in_center)}) WHERE is_valid = 1 GROUP BY project_id""", **schedule_ctes)

    o["active_entities"] = _with("""SELECT e.entity_id, entity_name, source_table, watermark_column, mapping_id, target_table,
      staging_table, load_type, load_order, last_watermark, status AS ctrl_status, last_run_date, last_run_id
      FROM entity_src e JOIN mapping_src m ON m.entity_id = e.entity_id AND m.is_active = 'Y'
      JOIN control_src c ON c.entity_id = e.entity_id WHERE e.is_active = 'Y'""")
    o["entity_status"] = _with("""SELECT entity_name, status, last_watermark, last_run_date, last_run_id
      FROM control_src c JOIN entity_src e ON e.entity_id = c.entity_id""")
    o["column_registry"] = _with("""SELECT entity_name, target_table, load_type, target_column, is_business_key, is_tracked,
      column_order FROM entity_src e JOIN mapping_src m ON m.entity_id = e.entity_id
      JOIN column_src c ON c.mapping_id = m.mapping_id
      WHERE e.is_active = 'Y' AND m.is_active = 'Y' AND c.is_active = 'Y'""")
    live = "mapping_src m WHERE m.is_active = 'Y'"
    o["registry_checks"] = _with(f"""SELECT entity_id, CAST(NULL AS BIGINT) AS mapping_id, -20010 AS code FROM entity_src e
      WHERE NOT EXISTS (SELECT 1 FROM {live} AND m.entity_id = e.entity_id)
      UNION ALL SELECT entity_id, mapping_id, -20011 FROM {live} AND load_type IN ('SCD1', 'SCD2')
       AND (surrogate_key_col IS NULL OR surrogate_seq_name IS NULL)
      UNION ALL SELECT entity_id, mapping_id, -20012 FROM {live} AND NOT EXISTS (SELECT 1 FROM column_src c
       WHERE c.mapping_id = m.mapping_id AND c.is_business_key = 'Y' AND c.is_active = 'Y')
      UNION ALL SELECT entity_id, mapping_id, -20013 FROM {live} AND load_type = 'INCREMENTAL' AND surrogate_key_col IS NULL""")
    o["registry_counts"] = _with(" UNION ALL ".join(
        f"SELECT '{n} rows' AS check_name, count(*) AS row_count FROM {n}_src"
        for n in ("entity", "mapping", "column", "rule", "control", "source_system")))
    o["schema_contract"] = _with("""SELECT e.table_name, e.column_name, CASE WHEN EXISTS (SELECT 1 FROM actual_columns_src a
      WHERE a.table_name = e.table_name AND a.column_name = e.column_name) THEN 'FOUND' ELSE 'MISSING' END AS result
      FROM expected_columns_src e""")
    o["stale_watermarks"] = _with("""SELECT entity_name, last_watermark, last_run_date,
      CAST(date_diff('day', last_watermark, DATE '2024-01-30') AS INTEGER) AS watermark_age_days, status
      FROM control_src c JOIN entity_src e ON e.entity_id = c.entity_id WHERE e.is_active = 'Y' AND status <> 'DISABLED'
      AND (last_watermark IS NULL OR date_diff('day', last_watermark, DATE '2024-01-30') > 2)""")

    o["run_summary"] = _with(SUMMARY)
    o["recent_runs"] = _with(f"{SUMMARY} ORDER BY run_id DESC LIMIT 10")
    o["todays_runs"] = _with(TODAY)
    totals = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c.replace('rows_', 'total_')}" for c in RUN_COUNTS.split(", "))
    o["daily_volume_trend"] = _with(f"""SELECT CAST(start_time AS DATE) AS load_date, entity_name, {totals},
      count(*) AS run_count, CAST(sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failure_count,
      round(avg({SECS}), 1) AS avg_elapsed_secs FROM run_log_src r JOIN {NAMED} e ON e.entity_id = r.entity_id
      WHERE CAST(start_time AS DATE) >= DATE '2023-12-31' GROUP BY CAST(start_time AS DATE), entity_name""")

    def pivot(entity: str, column: str) -> str:
        return f"max(CASE WHEN entity_name = '{entity}' THEN {column} END)"

    o["run_pivot"] = _with(f"""SELECT '2024-01-30 12:00:00' AS run_date,
      {pivot('STAFFING_SCHEDULE', 'run_id')} AS staffing_run_id, {pivot('COST', 'run_id')} AS cost_run_id,
      {pivot('STAFFING_SCHEDULE', 'status')} AS staffing_status, {pivot('COST', 'status')} AS cost_status,
      coalesce({pivot('STAFFING_SCHEDULE', 'rows_inserted')}, 0) AS staffing_rows_inserted,
      coalesce({pivot('COST', 'rows_inserted')}, 0) AS cost_rows_inserted FROM ({TODAY})""")
    o["pre_check"] = _with(f"""SELECT (SELECT count(*) FROM run_log_src r JOIN {NAMED} e ON e.entity_id = r.entity_id
        WHERE CAST(start_time AS DATE) = DATE '2024-01-30' AND end_time IS NULL) AS blocked_count,
      (SELECT 1 FROM staffing_src LIMIT 1) AS staffing_source_ok, (SELECT 1 FROM cost_src LIMIT 1) AS cost_source_ok,
      '2024-01-30 12:00:00' AS check_time""")
    o["step_detail"] = _with("""SELECT run_id, step_id, step_name, status, rows_affected,
      date_diff('second', start_time, end_time) AS elapsed_secs, step_message FROM step_log_src""")
    o["todays_errors"] = _with("SELECT * FROM error_log_src WHERE CAST(error_time AS DATE) = DATE '2024-01-30'")
    o["errors_last_day"] = _with("SELECT * FROM error_log_src WHERE error_time >= TIMESTAMP '2024-01-29 12:00:00'")
    o["error_digest"] = _with("""SELECT count(*) AS error_count, string_agg('[' || strftime(error_time, '%H:%M:%S')
      || '] ' || entity_name || ' | ' || error_code || ' | ' || error_message, chr(10)
      ORDER BY error_time, err_id) AS error_summary FROM (SELECT * FROM error_log_src
      WHERE CAST(error_time AS DATE) = DATE '2024-01-30' ORDER BY error_time DESC, err_id DESC LIMIT 10)""")
    return o
