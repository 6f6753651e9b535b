"""The tables of a warehouse directory: dimensions, staging, control and logs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimloom.operators.keys import assign_keys
from dimloom.operators.latest import latest_per_key
from dimloom.plans.registry import Mapping, Registry
from dimloom.sources.tables import BatchTable, read_or_none, run_ids

# Column types of the tables.
TYPES = {
    "allocated_hours": "decimal(18,4)", "amount": "decimal(22,6)",
    "schedule_start_date": "date", "schedule_end_date": "date", "period_start_date": "date",
    "period_end_date": "date", "period_date": "date", "effective_start_date": "date",
    "effective_end_date": "date", "reporting_date": "date", "etl_load_date": "date",
    "etl_run_id": "bigint", "stg_run_id": "bigint", "stg_rule_id": "bigint",
}

CONTROL = ("entity_id bigint, entity_name string, run_id bigint, last_watermark timestamp_ntz, last_run_date date, "
           "last_keys map<string,bigint>")
RUN_LOG = ("run_id bigint, entity_id bigint, mapping_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, "
           "status string, rows_read bigint, rows_inserted bigint, rows_updated bigint, rows_expired bigint, "
           "rows_skipped bigint, rows_rejected bigint, error_message string, entry int")
STEP_LOG = ("step_id bigint, run_id bigint, step_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
            "status string, rows_affected bigint, step_message string")
ERROR_LOG = ("err_id bigint, run_id bigint, entity_name string, target_table string, error_code string, error_message string, "
             "error_time timestamp_ntz, record_key string, record_data string")


def schema_of(names: list[str], keys: tuple[str, ...] = (), sources: dict[str, str] | None = None) -> T.StructType:
    """Types by column name; a renamed column has the type of its source column."""
    kinds = {k: "bigint" for k in keys} | TYPES
    return T.StructType([T.StructField(n, T._parse_datatype_string(kinds.get((sources or {}).get(n, n), "string"))) for n in names])


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    # ---- control and logs: small tables that only grow by one file per entry
    def _log(self, name: str, ddl: str) -> DataFrame:
        found = read_or_none(self.spark, "parquet", f"{self.root}/{name}", ddl)
        return self.spark.createDataFrame([], ddl) if found is None else found

    def _append(self, name: str, ddl: str, rows: list[dict]) -> None:
        if rows:
            columns = T._parse_datatype_string(ddl)
            data = [{c: list(v.items()) if isinstance(v := r.get(c), dict) else v for c in columns.fieldNames()} for r in rows]
            table = pa.Table.from_pylist(data, to_arrow_schema(columns))
            self.spark.createDataFrame(table, columns).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def control_log(self) -> DataFrame:
        return self._log("control", CONTROL)

    def control(self, entity_name: str) -> dict | None:
        """State after the newest committed run of an entity."""
        row = self.control_log().filter(F.col("entity_name") == entity_name).orderBy(F.col("run_id").desc()).first()
        return row.asDict() if row else None

    def control_table(self) -> DataFrame:
        """One row per entity that ever ran: state after its newest committed run, status of its newest run."""
        state = latest_per_key(self.control_log(), ["entity_id"], "run_id", "last_run_date").select(
            "entity_id", "last_watermark", "last_run_date")
        runs = self.run_log().filter("mapping_id IS NULL AND entity_id IS NOT NULL")
        newest = latest_per_key(runs, ["entity_id"], "run_id", "status").select(
            "entity_id", "status", F.col("run_id").alias("last_run_id"))
        return newest.join(state, "entity_id", "left")

    def committed(self, *more: int) -> DataFrame:
        """Run ids whose output counts: one per finished load, and ``more``."""
        known = self.control_log().select("run_id")
        return (known.union(run_ids(self.spark, *more)) if more else known).distinct()

    def commit(self, **row) -> None:
        """Publish a run.  One appended file makes all its tables visible at once."""
        self._append("control", CONTROL, [row])

    def run_log(self) -> DataFrame:
        """One row per run and mapping: its last entry."""
        rows = self._log("run_log", RUN_LOG).withColumn("_mapping", F.coalesce("mapping_id", F.lit(0)))
        return latest_per_key(rows, ["run_id", "_mapping"], "entry", "status").drop("_mapping", "entry")

    def error_log(self) -> DataFrame:
        return self._log("error_log", ERROR_LOG)

    def step_log(self) -> DataFrame:
        return self._log("step_log", STEP_LOG)

    def log_steps(self, rows: list[dict]) -> None:
        self._append("step_log", STEP_LOG, rows)

    def open_run(self, entity_id: int | None, now: dt.datetime) -> int:
        """Take the next run id by logging the run as RUNNING; a failed run keeps its id."""
        last = self._log("run_log", RUN_LOG).agg(F.max("run_id")).first()[0] or 0
        self.log_run(run_id=last + 1, entity_id=entity_id, start_time=now, status="RUNNING", entry=0)
        return last + 1

    def log_run(self, **row) -> None:
        self._append("run_log", RUN_LOG, [row])

    def _last_error(self, run_id: int) -> int:
        """Highest error id of a run; each run has 2^32 of its own."""
        return self.error_log().filter(F.col("run_id") == run_id).agg(F.max("err_id")).first()[0] or run_id << 32

    def log_errors(self, rows: list[dict]) -> None:
        """Append errors of one run, numbered within it."""
        if rows:
            last = self._last_error(rows[0]["run_id"])
            self._append("error_log", ERROR_LOG, [r | {"err_id": last + i} for i, r in enumerate(rows, 1)])

    def log_records(self, rows: DataFrame, by: list[str], run_id: int) -> None:
        """Append one error per row of ``rows``, which has the log's columns but the id; ``by`` tells its rows apart."""
        numbered = assign_keys(rows, by, "err_id", self._last_error(run_id))
        names = T._parse_datatype_string(ERROR_LOG).fieldNames()
        numbered.select(*names).write.mode("append").parquet(f"{self.root}/error_log")

    # ---- data tables
    def table_of(self, registry: Registry, mapping: Mapping) -> BatchTable:
        """The table of a mapping, from its columns in the registry."""
        n = mapping.mapping_id
        return self.dimension(mapping, [*registry.keys(n), *registry.attributes(n)], registry.sources(n), registry.keys(n))

    def staging(self, mapping: Mapping, payload: list[str]) -> BatchTable:
        """Staged rows, under the names of the source."""
        names = ["stg_run_id", "stg_status", "stg_action", "stg_reject_reason", "stg_record_hash",
                 *payload, "reporting_date", "stg_rule_id"]
        return BatchTable(self.spark, f"{self.root}/staging/{mapping.staging_table}", schema_of(names), only_grows=True)

    def dimension(self, mapping: Mapping, payload: list[str], sources: dict[str, str] | None = None, keys: list[str] | None = None) -> BatchTable:
        """The table of a mapping; ``sources`` names the source column of each payload column, ``keys`` the business keys.

        Master dimensions keep closed versions apart, so a load neither reads nor rewrites them, and
        their rows in ``key_buckets`` hash buckets of the key, so a load rewrites the buckets of changed
        keys alone.  Monthly dimensions are partitioned by month, so a load touches the months it brings.
        """
        audit = ["reporting_date", "etl_run_id", "etl_load_date"]
        key = mapping.surrogate_key_col
        path = f"{self.root}/{mapping.target_table}"
        buckets = (tuple(keys or payload[:1]), mapping.key_buckets)
        if mapping.load_type == "SCD2":
            names = [key, *payload, mapping.start_col, mapping.end_col, mapping.hash_col, *audit, mapping.current_col]
            return BatchTable(self.spark, path, schema_of(names, (key,), sources), (mapping.current_col,),
                              (mapping.current_col, str(mapping.expired_flag)), False, *buckets)
        parts = tuple(p for p in payload if (sources or {}).get(p, p) == "dt_period")
        names = [key, *[p for p in payload if p not in parts], mapping.hash_col, *audit, *parts]
        schema = schema_of(names, (key,), sources)
        if mapping.load_type == "SCD1" and not parts:
            return BatchTable(self.spark, path, schema, (), None, False, *buckets)
        return BatchTable(self.spark, path, schema, parts, only_grows=mapping.load_type == "APPEND")
