"""Named functions for SQL text. Both are SQL functions, so Catalyst inlines their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

from aerolith.functions.rules import heat_index_sql, pm25_to_aqi_sql


def register_sql_functions(spark: SparkSession) -> None:
    define = "CREATE OR REPLACE TEMPORARY FUNCTION"
    spark.sql(
        f"{define} calculateHeatIndex(t DOUBLE, h DOUBLE) RETURNS DOUBLE RETURN {heat_index_sql('t', 'h')}"
    )
    spark.sql(f"{define} pm25ToAQI(c DOUBLE) RETURNS INT RETURN {pm25_to_aqi_sql('c')}")
