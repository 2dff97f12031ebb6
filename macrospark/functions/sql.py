"""The period and number parsers as SQL functions, for ad-hoc queries over registered views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from macrospark.functions.scalars import NUMBER_PATTERN

SQL_FUNCTIONS = (
    rf"""
    CREATE OR REPLACE TEMPORARY FUNCTION safe_double(x STRING) RETURNS DOUBLE
    RETURN CASE WHEN x RLIKE r'{NUMBER_PATTERN}' THEN try_cast(x AS DOUBLE) END
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION period_date(period STRING, frequency STRING) RETURNS DATE
    RETURN try_cast(CASE frequency
      WHEN 'A' THEN concat(period, '-01-01')
      WHEN 'Q' THEN concat(left(period, 4),
        CASE substring(period, 6, 1) WHEN '1' THEN '-01-01' WHEN '2' THEN '-04-01' WHEN '3' THEN '-07-01' WHEN '4' THEN '-10-01' END)
      WHEN 'M' THEN concat(left(period, 4), '-', lpad(substring(period, 6, 2), 2, '0'), '-01')
    END AS DATE)
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION code_month(letter STRING, number INT) RETURNS INT
    RETURN CASE
      WHEN letter = 'M' AND number BETWEEN 1 AND 12 THEN number
      WHEN letter = 'Q' AND number BETWEEN 1 AND 4 THEN number * 3 - 2
      WHEN letter = 'A' AND number IS NOT NULL THEN 1
      WHEN letter = 'S' AND number BETWEEN 1 AND 2 THEN number * 6 - 5
    END
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION code_date(y STRING, code STRING) RETURNS DATE
    RETURN try_cast(concat(y, '-',
      lpad(code_month(upper(left(code, 1)), try_cast(substring(code, 2, 9) AS INT)), 2, '0'), '-01') AS DATE)
    """,
)


def register_functions(spark: SparkSession) -> None:
    for statement in SQL_FUNCTIONS:
        spark.sql(statement)
