"""Named SQL functions for callers who write SQL text."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession


def add_three(a: Column, b: Column, c: Column) -> Column:
    """Sum of three values; NULL if any is NULL."""
    return a + b + c


def register_add_three(spark: SparkSession, name: str = "add_three") -> None:
    """``name(a, b, c)`` for SQL text in this session."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
        "(a DECIMAL(18,4), b DECIMAL(18,4), c DECIMAL(18,4)) "
        "RETURNS DECIMAL(20,4) RETURN a + b + c"
    )


def drop_function(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")


def set_variable(spark: SparkSession, name: str, sql_type: str, value: object) -> None:
    """Session variable usable as a plain name in later SQL text."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {sql_type}")
    spark.sql(f"SET VARIABLE {name} = :value", args={"value": value})


def variables_sum(spark: SparkSession, **values: int) -> int:
    """Sum of session variables, set from ``values`` first."""
    for name, value in values.items():
        set_variable(spark, name, "BIGINT", value)
    return spark.sql(f"SELECT {' + '.join(values)} AS total").first()["total"]
