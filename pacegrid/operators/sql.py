"""SQL transforms: SELECT texts with named parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession


def sql_transform(spark: SparkSession, text: str, args: dict[str, object] | None = None) -> DataFrame:
    """Run one SELECT. Anything else is no subquery, so Spark's parser refuses it.

    Parameters are `:name` markers; table names take `IDENTIFIER(:name)`.
    """
    body = text.strip().rstrip(";")
    try:
        return spark.sql(f"SELECT * FROM (\n{body}\n)", args=args or {})
    except ParseException as error:
        raise ValueError("Only SELECT queries allowed") from error


def sql_directory(folder: str) -> dict[str, str]:
    """Target table (file stem) to SQL text for every `*.sql` file of a folder."""
    return {f.stem: f.read_text(encoding="utf-8") for f in sorted(Path(folder).glob("*.sql"))}
