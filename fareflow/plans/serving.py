"""SQL over the registered marts, and the merged view for serving."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.keys import best_row

# Names that decide between equal values are part of every ordering, so results
# repeat. Sums of rounded marts are taken in DECIMAL to be exact.
QUERIES = {
    "top_cities_revenue": """
        SELECT city_id, double(sum(CAST(total_revenue_inr AS DECIMAL(18,2)))) AS total_revenue,
               double(round(sum(CAST(avg_fare_inr AS DECIMAL(18,2))) / count(avg_fare_inr), 2)) AS avg_fare
        FROM city_stats GROUP BY city_id ORDER BY total_revenue DESC, city_id""",
    "top_driver_earnings": """
        SELECT driver_id, city_id, total_earnings_inr, total_trips
        FROM driver_earnings
        ORDER BY total_earnings_inr DESC, driver_id, city_id, total_trips DESC LIMIT 10""",
    "surge_by_city": """
        SELECT city_id, surge_bucket, trip_count, round(cancellation_rate_pct, 1) AS cancel_rate
        FROM surge_analysis ORDER BY city_id, surge_bucket""",
    "zone_peak_hours": """
        SELECT city_id, pickup_zone, pickup_hour, trip_count, round(avg_surge, 2) AS avg_surge
        FROM zone_heatmap WHERE pickup_hour BETWEEN 7 AND 22
        ORDER BY trip_count DESC, city_id, pickup_zone, pickup_hour, date LIMIT 20""",
    "city_completion": """
        SELECT city_id, round(completion_rate_pct, 1) AS completion_pct, round(avg_surge, 2) AS avg_surge
        FROM city_stats ORDER BY completion_rate_pct DESC, city_id""",
    "surge_cancellation": """
        SELECT surge_bucket, sum(trip_count) AS trips,
               double(round(sum(CAST(cancellation_rate_pct AS DECIMAL(18,2))) / count(cancellation_rate_pct), 1))
                 AS avg_cancel_rate
        FROM surge_analysis GROUP BY surge_bucket ORDER BY surge_bucket""",
    "revenue_by_date": """
        SELECT date, sum(total_trips) AS trips, double(sum(CAST(total_revenue_inr AS DECIMAL(18,2)))) AS revenue
        FROM city_stats GROUP BY date ORDER BY date""",
}


def query(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """Run a saved query on registered tables, or on the DataFrames given, which
    stand in for this query only: no view of the session is replaced."""
    sql = QUERIES[name]
    for table in tables:
        sql = re.sub(rf"\b{table}\b", f"{{{table}}}", sql)
    return spark.sql(sql, **tables)


def serving_view(speed: DataFrame, batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Fresh and historical rows as one table, the newest version of each key."""
    return best_row(speed.unionByName(batch, allowMissingColumns=True), keys, [-F.unix_micros(version)])
