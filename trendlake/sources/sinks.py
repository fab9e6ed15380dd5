"""Dated tables: writing, and publishing the newest partitions.

``publish_latest`` mirrors the newest partition of each table. ``publish_snapshot`` makes all
tables visible at once: their files are written to a folder of the run's own, and one small
manifest, which is moved into place, is the commit. Readers go by the newest manifest, so
they never see a part of a run, and a run that ends early is never seen at all.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendlake.sources.partitions import file_system, latest_partition_date, latest_partition_path

MANIFESTS, RUNS = "_manifests", "runs"


def write_dated(df: DataFrame, path: str, day: date, small: bool = False, resize: bool = True) -> int:
    """Replace the day's partition of a Parquet table; the row count comes from the same job.

    ``small`` writes one file and is meant for aggregates of bounded size only;
    otherwise Spark sizes the files itself, unless ``resize`` is off for rows that come
    in files of good size already.
    """
    counted = Observation()
    sized = df.coalesce(1) if small else df.hint("rebalance") if resize else df
    rows = sized.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.withColumn("dt", F.lit(day).cast("date")).write.partitionBy("dt")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return counted.get["rows"]


def write_json(df: DataFrame, path: str, day: date) -> None:
    """Replace the day's partition of a JSON landing table."""
    writer = df.withColumn("dt", F.lit(day).cast("date")).write.partitionBy("dt").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").json(path)


def publish_latest(spark: SparkSession, base: str, target: str, tables: list[str]) -> DataFrame:
    """Copy the newest partition of each table to ``target``, mirroring the layout.

    The scheme of ``target`` picks the file system.
    """
    published = []
    for table in tables:
        day = latest_partition_date(spark, f"{base}/{table}")
        if day is None:
            continue
        part = spark.read.parquet(latest_partition_path(spark, f"{base}/{table}", required=True))
        rows = write_dated(part, f"{target}/{table}", date.fromisoformat(day), resize=False)
        published.append((table, day, rows))
    return spark.createDataFrame(published, "table string, dt string, rows bigint")


def stage_snapshot(tables: dict[str, DataFrame], target: str, run: str) -> dict[str, int]:
    """Write the tables to the run's own folder, where no reader looks; rows of each."""
    staged = {}
    for name, df in tables.items():
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{target}/{RUNS}/{run}/{name}")
        staged[name] = counted.get["rows"]
    return staged


def commit_snapshot(spark: SparkSession, target: str, run: str, staged: dict[str, int]) -> None:
    """Make a staged run the one that readers see; the manifest appears whole or not at all."""
    rows = [{"table": name, "path": f"{RUNS}/{run}/{name}", "rows": n} for name, n in sorted(staged.items())]
    system, written = file_system(spark, f"{target}/{MANIFESTS}/.{run}")
    stream = system.create(written, True)
    try:
        stream.write(bytearray(json.dumps(rows).encode("utf-8")))
    finally:
        stream.close()
    if not system.rename(written, file_system(spark, f"{target}/{MANIFESTS}/{run}.json")[1]):
        raise OSError(f"run {run} could not be committed")


def new_run() -> str:
    """A name that sorts after those of earlier runs."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish_snapshot(spark: SparkSession, tables: dict[str, DataFrame], target: str) -> str:
    """Stage all tables and commit them together; the run's name."""
    run = new_run()
    commit_snapshot(spark, target, run, stage_snapshot(tables, target, run))
    return run


def published_runs(spark: SparkSession, target: str) -> list[str]:
    """Names of the committed runs, oldest first; one small file each."""
    system, path = file_system(spark, f"{target}/{MANIFESTS}")
    names = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))


def read_published(spark: SparkSession, target: str, table: str, run: str | None = None) -> DataFrame:
    """A table of the newest committed run, or of a named one."""
    runs = published_runs(spark, target)
    if not runs:
        raise FileNotFoundError(f"nothing is published under {target}")
    manifest = spark.read.schema("table string, path string, rows bigint").option("multiLine", True).json(f"{target}/{MANIFESTS}/{run or runs[-1]}.json")
    found = manifest.filter(F.col("table") == table).first()
    if found is None:
        raise FileNotFoundError(f"run {run or runs[-1]} has no table {table}")
    return spark.read.parquet(f"{target}/{found['path']}")


def drop_old_runs(spark: SparkSession, target: str, keep: int = 3) -> list[str]:
    """Delete all but the newest ``keep`` committed runs, manifests first, and what uncommitted runs before them left."""
    runs = published_runs(spark, target)
    kept = runs[-keep:] if keep else []
    for name in [r for r in runs if r not in kept]:
        system, path = file_system(spark, f"{target}/{MANIFESTS}/{name}.json")
        system.delete(path, False)
    system, path = file_system(spark, f"{target}/{RUNS}")
    folders = [s.getPath() for s in system.listStatus(path)] if system.exists(path) else []
    old = [p for p in folders if p.getName() not in kept and (not kept or p.getName() < kept[0])]
    for folder in old:
        system.delete(folder, True)
    return sorted(p.getName() for p in old)
