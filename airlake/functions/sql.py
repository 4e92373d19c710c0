"""The AQI rules as SQL functions, for users who write SQL.

``register_functions(spark)`` creates session-scoped SQL functions. They are SQL
bodies, not Python: Catalyst inlines them into the plan (whole-stage codegen), so
``spark.sql("select prominent_index(...) ...")`` costs the same as the Column helpers.

Arguments are declared ``DECIMAL(38,0)`` like the original functions' whole-number
parameters: fractional inputs are rounded half up on the way in.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from airlake.functions.aqi import na_to_int_sql, prominent_sql, sub_index_sql

_ARGS = ["pm25", "pm10", "so2", "no2", "nh3", "co", "o3"]
_PARAMS = ", ".join(f"{a} DECIMAL(38,0)" for a in _ARGS)


def register_functions(spark: SparkSession) -> list[str]:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION prominent_index({_PARAMS}) RETURNS STRING "
              f"RETURN {prominent_sql(_ARGS)}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION three_sub_index_criteria({_PARAMS}) "
              f"RETURNS DECIMAL(38,0) RETURN {sub_index_sql(_ARGS)}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION get_int(input_value STRING) RETURNS DECIMAL(38,0) "
              f"RETURN {na_to_int_sql('input_value')}")
    return ["prominent_index", "three_sub_index_criteria", "get_int"]
