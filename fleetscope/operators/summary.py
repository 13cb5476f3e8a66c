"""The nested summary document: totals, top vehicles and zone counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions import predicates as is_
from fleetscope.operators.rollup import rows


def summary_document(df: DataFrame, k: int = 5) -> DataFrame:
    """One row with scalar totals and two arrays of ``{_id, count}``.

    One scan feeds all parts: the facts shrink to a row per vehicle and zone,
    and grouping sets over these give total, vehicle and zone counts. Ranking
    keeps k vehicles before anything is collected; Spark applies the limit on
    the map side too."""
    pairs = df.groupBy("forklift_id", "zone").agg(
        rows(df).alias("n"),
        rows(df, is_.active()).alias("active"),
        rows(df, is_.unauthorized()).alias("unauthorized"),
        rows(df, is_.offline()).alias("offline"),
    )
    vehicle, zone = F.col("forklift_id"), F.col("zone")
    sums = [F.sum(c).alias(c) for c in ("n", "active", "unauthorized", "offline")]
    parts = pairs.groupingSets([[], [vehicle], [zone]], vehicle, zone).agg(
        F.grouping_id().alias("part"), *sums
    )
    # bits of the set id: forklift_id left out = 2, zone left out = 1
    of_total, of_vehicle, of_zone = (F.col("part") == bits for bits in (3, 1, 2))

    # vehicles share one ranking, every zone and the total have their own
    ranking = Window.partitionBy("part", "zone").orderBy(F.desc("unauthorized"), "forklift_id")
    kept = (
        parts.filter(~of_vehicle | (F.col("unauthorized") > 0))
        .withColumn("place", F.row_number().over(ranking))
        .filter(F.col("place") <= k)
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(of_total, F.col(name))), F.lit(0))

    def ranked(part: Column, key: Column, count: str) -> Column:
        entries = F.collect_list(
            F.when(part, F.struct((-F.col(count)).alias("order"), key.alias("_id")))
        )
        return F.transform(
            F.sort_array(entries),
            lambda e: F.struct(e["_id"].alias("_id"), (-e["order"]).alias("count")),
        )

    return kept.agg(
        F.lit(fixed.SUMMARY_TYPE).alias("report_type"),
        total("n").alias("total_records"),
        total("active").alias("active_work_count"),
        total("unauthorized").alias("unauthorized_count"),
        total("offline").alias("offline_count"),
        ranked(of_vehicle, vehicle, "unauthorized").alias("top_unauthorized_forklifts"),
        ranked(of_zone, zone, "n").alias("zone_counts"),
    )


def flattened(document: DataFrame) -> DataFrame:
    """The document with its arrays as ``id:count`` text."""

    def text(name: str) -> Column:
        entries = F.transform(
            name, lambda e: F.concat_ws(":", e["_id"], e["count"].cast("string"))
        )
        return F.array_join(entries, ",").alias(name)

    arrays = ("top_unauthorized_forklifts", "zone_counts")
    return document.select(*[text(c) if c in arrays else F.col(c) for c in document.columns])
