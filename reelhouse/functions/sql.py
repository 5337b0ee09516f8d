"""SQL-callable versions of the column rules (SQL functions, not Python UDFs).

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` is inlined by the analyzer, so
SQL users of the report pack get the same codegen'd expressions as the
DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .columns import AGE_BAND_DEFAULT, AGE_BANDS, HIGH_PCT, MEDIUM_PCT


def _age_group_body() -> str:
    arms = " ".join(f"WHEN a < {b} THEN '{label}'" for b, label in AGE_BANDS)
    return f"CASE {arms} ELSE '{AGE_BAND_DEFAULT}' END"


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION age_group(a INT) RETURNS STRING "
        f"RETURN {_age_group_body()}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION engagement_level(p DOUBLE) RETURNS STRING "
        f"RETURN CASE WHEN isnan(p) THEN 'LOW' WHEN p >= {HIGH_PCT} THEN 'HIGH' "
        f"WHEN p >= {MEDIUM_PCT} THEN 'MEDIUM' ELSE 'LOW' END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION engagement_score(p DOUBLE, m INT) RETURNS DOUBLE "
        "RETURN round(p * 0.6D + least(m / 120.0D * 100.0D, 100.0D) * 0.4D, 1)"
    )
