"""Sinks. Every write is one distributed job; a table version counts only once its log entry is committed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions import text as T
from shelfwise.operators.prepared import report
from shelfwise.sources.keyed import folder_names, publish, read_text


def write_report_csv(rows: DataFrame, layout, path: str) -> None:
    """``layout`` is one of the fixed report layouts, or any (column, field, default) list."""
    report(rows, layout).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines with decimals as plain text."""
    columns = [T.plain_decimal_text(F.col(n)).alias(n) if t.startswith("decimal") else F.col(n) for n, t in rows.dtypes]
    rows.select(*columns).write.mode("overwrite").json(path)


def write_run(rows: DataFrame, root: str, stamp: str) -> None:
    """One run as a partition ``run_stamp=<stamp>``; running it again replaces that run only."""
    rows.write.mode("overwrite").parquet(f"{root}/run_stamp={stamp}")


def commit_version(rows: DataFrame, root: str) -> int:
    """Write the next full table version and publish its number in the log; gives the number.

    The rows lie in a folder of their own, which counts once the log names it. Of two writers with one number the second fails
    (``keyed.LostRace``) and its folder is of no version.
    """
    spark = rows.sparkSession
    version = (current_version(spark, root) or 0) + 1
    folder = f"version={version}-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(f"{root}/data/{folder}")
    publish(spark, f"{root}/log", f"{version:012d}", folder)
    return version


def _entries(spark: SparkSession, root: str) -> list[str]:
    return sorted(n for n in folder_names(spark, f"{root}/log") if not n.startswith("."))


def current_version(spark: SparkSession, root: str) -> int | None:
    """Newest committed version; none before the first one."""
    entries = _entries(spark, root)
    return int(entries[-1]) if entries else None


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/data/{read_text(spark, f'{root}/log/{version:012d}')}")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return read_version(spark, root, current_version(spark, root))
