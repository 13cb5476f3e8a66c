"""The queries that are written as Spark SQL over the telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.fixed_values import DEFAULT_VIEW

SQL = {
    "offline_prediction_sql": """
        WITH counted AS (
            SELECT forklift_id, shift, COUNT(*) AS total_records,
                   COUNT_IF(status = 'offline') AS offline_count
            FROM {telemetry}
            GROUP BY forklift_id, shift
        )
        SELECT *, ROUND(offline_count / total_records, 4) AS predicted_offline_risk
        FROM counted
        ORDER BY predicted_offline_risk DESC, forklift_id, shift
    """,
}


def run_sql(name: str, df: DataFrame) -> DataFrame:
    """A named query over ``df``, which needs no registered view."""
    return df.sparkSession.sql(SQL[name], telemetry=df)


def run_sql_on_view(spark: SparkSession, name: str, view: str = DEFAULT_VIEW) -> DataFrame:
    """A named query over a registered view."""
    return spark.sql(SQL[name].format(telemetry=view))
