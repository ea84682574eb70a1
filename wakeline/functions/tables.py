"""Small fixed tables as inline SQL rows, whose size the planner knows exactly."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return f"{value!r}D" if isinstance(value, float) else str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
