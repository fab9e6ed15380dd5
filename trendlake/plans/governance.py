"""The governance fact table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.constants import (
    ARTICLE_TEXT_COLUMNS, EXPECTED_ARTICLE_COLUMNS, EXPECTED_RECIPE_COLUMNS, RECIPE_NUMERIC_COLUMNS, RECIPE_TEXT_COLUMNS,
)
from trendlake.functions.values import present_columns
from trendlake.operators import profile as p
from trendlake.operators.longform import kpi_row, long_rows
from trendlake.sources.drift import union_all
from trendlake.sources.partitions import inventory


def table_facts(
    df: DataFrame,
    source: str,
    run_ts: datetime,
    key: str,
    expected: Sequence[str],
    text_columns: Sequence[str],
    numeric_columns: Sequence[str] = (),
    compression: tuple[str, str] | None = None,
    outlier_method: str = "approximate",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All KPIs of one table: a wide pass over its columns and a narrow one over its key and numbers."""
    measures = [p.null_measure(df, source), p.volume_measure(source), p.text_measure(df, text_columns, source)]
    if compression and set(compression) <= set(df.columns):
        measures.append(p.compression_measure(*compression, source))
    numbers = present_columns(df, numeric_columns)
    if key in df.columns or numbers:
        rows = p.keyed_profile(df, measures, key if key in df.columns else None, numbers, source, run_ts, outlier_method)
    else:
        rows = p.profile(df, measures, run_ts)
    return union_all([rows, p.schema_compliance(df, expected, source, run_ts, columns)])


def recipe_facts(
    df: DataFrame, run_ts: datetime, source: str = "api", columns: Sequence[str] | None = None, outlier_method: str = "approximate"
) -> DataFrame:
    return table_facts(
        df, source, run_ts, "id", EXPECTED_RECIPE_COLUMNS, RECIPE_TEXT_COLUMNS, RECIPE_NUMERIC_COLUMNS,
        outlier_method=outlier_method, columns=columns,
    )


def article_facts(
    df: DataFrame, run_ts: datetime, source: str = "webscraping", columns: Sequence[str] | None = None
) -> DataFrame:
    return table_facts(
        df, source, run_ts, "article_id", EXPECTED_ARTICLE_COLUMNS, ARTICLE_TEXT_COLUMNS,
        compression=("article_summary", "article_summary_clean"), columns=columns,
    )


def silver_file_facts(files: DataFrame, run_ts: datetime) -> DataFrame:
    """Files in the newest partition of each source."""
    finding = F.format_string("%d files of %s on %s", "latest_files", "source", F.col("latest_date").cast("string"))
    row = kpi_row("source_file_count", "volume", F.col("source"), None, F.col("latest_files"), "files", finding)
    return long_rows(inventory(files), [row], run_ts)


def ingestion_facts(files: DataFrame, run_ts: datetime) -> DataFrame:
    """Distinct ingestion dates and files per landed source."""
    dates = F.format_string(
        "%s landed on %d days: %s", "source", "distinct_dates", F.array_join("dates", ", "),
    )
    counted = F.format_string("%d landed files of %s", "files", "source")
    rows = [
        kpi_row("ingestion_distinct_dates", "timeliness", F.col("source"), None, F.col("distinct_dates"), "dates", dates),
        kpi_row("ingestion_file_count", "timeliness", F.col("source"), None, F.col("files"), "files", counted),
    ]
    return long_rows(inventory(files), rows, run_ts)


def reject_facts(rejects: DataFrame, run_ts: datetime) -> DataFrame:
    """Rejected payloads by source and reason."""
    counted = rejects.groupBy("source", "reason").agg(F.count("*").alias("n"))
    finding = F.format_string("%d payloads of %s are %s", "n", "source", "reason")
    row = kpi_row("rejected_payloads", "validity", F.col("source"), F.col("reason"), F.col("n"), "payloads", finding)
    return long_rows(counted, [row], run_ts)


def governance_facts(
    recipes: DataFrame,
    articles: DataFrame,
    run_ts: datetime,
    silver_files: DataFrame | None = None,
    bronze_files: DataFrame | None = None,
    targets: DataFrame | None = None,
    found_targets: DataFrame | None = None,
    recipe_columns: Sequence[str] | None = None,
    article_columns: Sequence[str] | None = None,
    outlier_method: str = "approximate",
    rejects: DataFrame | None = None,
) -> DataFrame:
    """The whole table; file and target KPIs need the listings, and schema KPIs of landed files the columns seen there."""
    parts = [recipe_facts(recipes, run_ts, columns=recipe_columns, outlier_method=outlier_method), article_facts(articles, run_ts, columns=article_columns)]
    if silver_files is not None:
        parts.append(silver_file_facts(silver_files, run_ts))
    if targets is not None and found_targets is not None:
        parts.append(p.target_coverage(targets, found_targets, targets.columns[0], "api", run_ts))
    if bronze_files is not None:
        parts.append(ingestion_facts(bronze_files, run_ts))
    if rejects is not None:
        parts.append(reject_facts(rejects, run_ts))
    return union_all(parts)
