"""Data checks, the audit row and the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.guards import DataCheckError
from barloom.sinks.files import output_state

CHECK_SCHEMA = "check string, ok boolean, detail string"


def missing_from(required: DataFrame, present: DataFrame) -> DataFrame:
    """Distinct required ``table_name`` values that ``present`` lacks."""
    return required.select("table_name").distinct() \
        .join(present.select("table_name"), "table_name", "left_anti")


def missing_names(required: list[str], present: DataFrame) -> DataFrame:
    wanted = present.sparkSession.createDataFrame([(n,) for n in required], "table_name string")
    return missing_from(wanted, present)


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    shown = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return shown.select(F.col("tableName").alias("table_name"))


def table_state(missing: DataFrame, ticks: DataFrame) -> DataFrame:
    """Sorted missing tables and tick count in one row."""
    names = missing.agg(F.array_sort(F.collect_list("table_name"))).scalar()
    return ticks.agg(F.count("*").alias("tick_count")).withColumn("missing", names).select(
        (F.size("missing") == 0).alias("tables_ok"),
        F.array_join("missing", ",").alias("missing_tables"), "tick_count")


def has_rows(spark: SparkSession, table: str) -> tuple[str, bool, str]:
    """The table exists and is not empty."""
    if not spark.catalog.tableExists(table):
        return (f"table {table}", False, "does not exist")
    empty = spark.table(table).isEmpty()
    return (f"table {table}", not empty, "has no rows" if empty else "")


def output_complete(spark: SparkSession, path: str) -> tuple[str, bool, str]:
    """A Parquet output has data files and its success marker."""
    files, marker = output_state(spark, path)
    ok = files > 0 and marker
    return (f"output {path}", ok, "" if ok else f"parquet_files={files}, success_marker={marker}")


def checks_frame(spark: SparkSession, checks: list[tuple[str, bool, str]]) -> DataFrame:
    return spark.createDataFrame(checks, CHECK_SCHEMA)


def audit_row(checks: DataFrame, run_id: str, parts: dict[str, str] | None = None,
              facts: dict[str, object] | None = None) -> DataFrame:
    """One audit row over all checks of a run.

    ``parts`` adds a flag ``<part>_ok`` for each part: whether all checks whose name starts with the
    given text passed (null if there is none). ``facts`` adds columns with given values, such as counts,
    a marker or names.
    """
    flags = [F.bool_and(F.when(F.startswith("check", F.lit(start)), F.col("ok"))).alias(f"{part}_ok")
             for part, start in (parts or {}).items()]
    failed = F.when(~F.col("ok"), F.concat_ws("=", "check", "detail"))
    return checks.agg(
        F.bool_and("ok").alias("all_ok"), F.count("*").alias("n_checks"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        F.array_join(F.array_sort(F.collect_list(failed)), " | ").alias("failures"), *flags).select(
            F.lit(run_id).alias("run_id"), F.current_timestamp().alias("checked_at"), "all_ok",
            "n_checks", "n_failed", *(f"{part}_ok" for part in parts or {}),
            *(F.lit(v).alias(n) for n, v in (facts or {}).items()),
            F.when(F.col("n_failed") == 0, "all checks completed")
            .otherwise(F.col("failures")).alias("notes"))


def append_audit(row: DataFrame, path: str) -> None:
    """A row may have columns that earlier ones lack, or lack some of theirs."""
    row.write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All audit rows as one table: the columns of every file, null where a row was written without."""
    return spark.read.option("mergeSchema", True).parquet(path)


def run_gate(checks: DataFrame, run_id: str, audit_path: str, parts: dict[str, str] | None = None,
             facts: dict[str, object] | None = None) -> None:
    """Write the audit row first, then raise one error that lists every failure."""
    row = audit_row(checks, run_id, parts, facts)
    append_audit(row, audit_path)
    failed = checks.filter(~F.col("ok")).orderBy("check").collect()
    if failed:
        raise DataCheckError(" | ".join(f"{r['check']}: {r['detail']}" for r in failed))
