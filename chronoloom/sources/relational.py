"""Relational tables: JDBC scans and writes, and parameterised SQL over registered views."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import check_identifier

# Fixed value: rows per insert statement.
BATCH_ROWS = 500

# Column types of written tables.
SQL_TYPES = {"integer": "BIGINT", "fraction": "FLOAT", "time": "TIMESTAMP", "boolean": "BOOLEAN", "other": "TEXT"}


def sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return SQL_TYPES["integer"]
    if isinstance(kind, T.NumericType):
        return SQL_TYPES["fraction"]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return SQL_TYPES["time"]
    return SQL_TYPES["boolean"] if isinstance(kind, T.BooleanType) else SQL_TYPES["other"]


def column_types(schema: T.StructType) -> str:
    """The ``createTableColumnTypes`` text, in types that Spark's parser accepts for a schema."""
    spark_names = {"TEXT": "STRING", "FLOAT": "DOUBLE"}
    typed = [(f.name, sql_type(f.dataType)) for f in schema]
    return ", ".join(f"`{name}` {spark_names.get(kind, kind)}" for name, kind in typed)


def scan_options(
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
) -> dict[str, str]:
    """Reader options: a table or query, split over ``partitions`` ranges of a column.

    Bounds only place the cuts; rows outside them are read too, by the first and last range.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    if partition_column is None:
        return {"dbtable": table} if table else {"query": query}
    if bounds is None:
        raise ValueError("a partition column needs bounds")
    low, high = bounds
    return {
        "dbtable": table or f"({query}) AS q",
        "partitionColumn": partition_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None, **scan) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).options(**(properties or {}), **scan_options(**scan)).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = BATCH_ROWS,
    connections: int = 32,
) -> bool:
    """Replace a table; an empty frame leaves it alone. Returns whether anything was written.

    At most ``connections`` tasks write at a time, whatever the number of partitions.
    """
    check_identifier(table)
    if df.isEmpty():
        return False
    writer = df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", batch_rows).option("createTableColumnTypes", column_types(df.schema))
    writer.option("numPartitions", connections).options(**(properties or {})).save()
    return True


def run_sql(
    spark: SparkSession,
    lines: str | Sequence[str],
    params: Mapping[str, object] | None = None,
    identifiers: Sequence[str] = ("table", "filter_field"),
) -> DataFrame:
    """Run SQL text, or lines to be joined, with ``{name}`` placeholders bound as parameters.

    Names in ``identifiers`` are bound as table or column names, all others as values, so that no
    parameter is ever spliced into the text.
    """
    text = lines if isinstance(lines, str) else "\n".join(lines)
    used = {name: value for name, value in (params or {}).items() if "{" + name + "}" in text}
    for name in used:
        marker = f"IDENTIFIER(:{name})" if name in identifiers else f":{name}"
        for quote in ("'", '"'):  # a quoted placeholder is the parameter too, not text
            text = text.replace(f"{quote}{{{name}}}{quote}", marker)
        text = text.replace("{" + name + "}", marker)
    inside = [literal for literal in re.findall(r"'[^']*'", text) if any(re.search(rf":{name}\b", literal) for name in used)]
    if inside:
        raise ValueError(f"a placeholder cannot be part of the text {inside[0]}")
    return spark.sql(text, args=used) if used else spark.sql(text)


def rows_above(df: DataFrame, column: str, value: object, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The parameterised query as DataFrame calls, with an order that makes the limit repeatable."""
    kept = df.where(F.col(column) > F.lit(value))
    return (kept.orderBy(*order) if order else kept).limit(n)
