"""The named queries: each maps telemetry to a result.

Dates and timestamps leave the catalog as ISO text, the form in which the
stored documents carry them. Aggregates of aggregates are rounded to six
places here, because their last bits depend on the order of merging.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions import derive
from fleetscope.operators import counts, fleet, presence, quality, rates, reshape, summary, topk
from fleetscope.plans import loads
from fleetscope.plans.sql_queries import run_sql
from fleetscope.schema import TELEMETRY
from fleetscope.sinks.storage import Scratch
from fleetscope.sources import events
from fleetscope.sources.dimensions import anchors, lookup

Query = Callable[[DataFrame], DataFrame]

READINGS_EXPECTED_PER_DAY = 24  # one an hour: what the events table roughly holds


def _with_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def derive_shift(df: DataFrame) -> DataFrame:
    return df.select("event_id", derive.shift_of(F.col("timestamp")).alias("shift"))


def derive_zone(df: DataFrame) -> DataFrame:
    return lookup(df.select("event_id", "anchor"), anchors(df.sparkSession), "anchor").select(
        "event_id", "anchor", "zone"
    )


def derive_day_index(df: DataFrame) -> DataFrame:
    dated = derive.with_day(df.select("event_id", "timestamp"), events.FIRST_DAY)
    return _with_text(dated.select("event_id", "date", "day_index"), "date")


def classify_downtime(df: DataFrame) -> DataFrame:
    inputs = [F.col(c) for c in ("status", "visible", "mov", "occ", "zone")]
    return df.select("event_id", derive.downtime_category(*inputs).alias("downtime_category"))


def signal_sentinel(df: DataFrame) -> DataFrame:
    return df.select("event_id", derive.signal_of(F.col("visible"), F.col("rssi")).alias("rssi"))


def record_keys(df: DataFrame) -> DataFrame:
    key = derive.record_key(F.col("forklift_id"), F.col("timestamp"))
    return df.select("event_id", key.alias("_id"))


def shift_status_crosstab(df: DataFrame) -> DataFrame:
    return reshape.observed_crosstab(df, Scratch(df.sparkSession, "crosstab"))


def shift_status_crosstab_normalized(df: DataFrame) -> DataFrame:
    return reshape.observed_crosstab(df, Scratch(df.sparkSession, "crosstab"), normalized=True)


def composite_risk_matrix_observed(df: DataFrame) -> DataFrame:
    return reshape.observed_risk_matrix(df, Scratch(df.sparkSession, "matrix"))


def repeated_key_days(df: DataFrame) -> DataFrame:
    return _with_text(quality.repeated_key_days(df), "date")


def cadence_gaps(df: DataFrame) -> DataFrame:
    gaps = presence.cadence_gaps(df, Scratch(df.sparkSession, "gaps"), slot=3600)
    return _with_text(gaps, "first_missing", "last_missing")


def zone_anchors(df: DataFrame) -> DataFrame:
    return counts.zone_anchors(df).withColumn("anchors", F.array_join("anchors", ","))


def unauthorized_spread(df: DataFrame) -> DataFrame:
    return counts.unauthorized_spread(df).withColumn("std_count", F.round("std_count", 6))


def first_records(df: DataFrame) -> DataFrame:
    tie_breakers = [name for name in ("timestamp", "event_id") if name in df.columns]
    first = topk.first_records_by_forklift(df, 5, tie_breakers)
    return _with_text(first.select(*TELEMETRY.fieldNames()), "timestamp", "date")


def cadence_completeness(df: DataFrame) -> DataFrame:
    return _with_text(quality.cadence_completeness(df, READINGS_EXPECTED_PER_DAY), "date")


def summary_document(df: DataFrame) -> DataFrame:
    return summary.flattened(summary.summary_document(df))


def _sql(name: str) -> Query:
    return lambda df: run_sql(name, df)


# a row per reading, by the number of its event
DERIVED: dict[str, Query] = {
    "derive_shift": derive_shift,
    "derive_zone": derive_zone,
    "derive_day_index": derive_day_index,
    "classify_downtime": classify_downtime,
    "record_keys": record_keys,
}

ANALYSES: dict[str, Query] = {
    # counts
    "category_counts": counts.category_counts,
    "shift_counts": counts.shift_counts,
    "shift_counts_by_size": counts.shift_counts_by_size,
    "zone_counts": counts.zone_counts,
    "status_counts": counts.status_counts,
    "flag_counts": counts.flag_counts,
    "active_work_by_forklift": counts.active_work_by_forklift,
    "unauthorized_by_forklift_flags": counts.unauthorized_by_forklift_flags,
    "unauthorized_by_forklift_category": counts.unauthorized_by_forklift_category,
    "offline_summary": counts.offline_summary,
    "offline_by_shift_ranked": counts.offline_by_shift_ranked,
    "shift_status_counts": counts.shift_status_counts,
    "record_count": counts.record_count,
    "status_totals": counts.status_totals,
    "distinct_values": counts.distinct_values,
    "zone_anchors": zone_anchors,
    # signal and spread
    "avg_rssi_by_zone": counts.avg_rssi_by_zone,
    "zone_shift_summary": counts.zone_shift_summary,
    "unauthorized_spread": unauthorized_spread,
    # rates
    "offline_risk_by_forklift_shift": rates.offline_risk_by_forklift_shift,
    "unauthorized_risk_by_forklift_shift": rates.unauthorized_risk_by_forklift_shift,
    "offline_risk_by_zone_shift": rates.offline_risk_by_zone_shift,
    "offline_prediction_sql": _sql("offline_prediction_sql"),
    "downtime_by_forklift": rates.downtime_by_forklift,
    "predict_offline_risk": rates.predict_offline_risk,
    "predict_unauthorized_risk": rates.predict_unauthorized_risk,
    "composite_risk_zone_shift": rates.composite_risk_zone_shift,
    "zone_risk": rates.zone_risk,
    "shift_risk": rates.shift_risk,
    "all_rates": rates.all_rates,
    # cross tabulations
    "shift_status_crosstab": shift_status_crosstab,
    "shift_status_crosstab_normalized": shift_status_crosstab_normalized,
    "composite_risk_matrix": reshape.composite_risk_matrix,  # its SQL names three shifts
    # top k
    "top_unauthorized_forklifts": topk.top_unauthorized_forklifts,
    "top_forklifts_by_records": topk.top_forklifts_by_records,
    "first_records_by_forklift": first_records,
    "top3_downtime": lambda df: topk.top_downtime(df, 3),
    "top10_downtime": lambda df: topk.top_downtime(df, 10),
    # profiles and expectations
    "profile_enriched_counts": fleet.profile_enriched_counts,
    "preferred_zone_share": fleet.preferred_zone_share,
    "state_mix_drift": fleet.state_mix_drift,
    # completeness and uniqueness
    "duplicate_keys": quality.duplicate_keys,
    "repeated_key_days": repeated_key_days,
    "cadence_completeness": cadence_completeness,
    # summary and placement
    "summary_document": summary_document,
    "shard_balance": counts.shard_balance,
}

LOADS: dict[str, Query] = {
    "csv_scan": loads.csv_scan,
    "parquet_scan": loads.parquet_scan,
    "parquet_text_scan": loads.parquet_text_scan,
    "csv_quarantine": loads.csv_quarantine,
    "document_scan": loads.document_scan,
    "full_replace_load": loads.full_replace_load,
    "snapshot_load": loads.snapshot_load,
    "append_load": loads.append_load,
    "slice_replace_load": loads.slice_replace_load,
    "vehicle_layout": loads.vehicle_layout,
    "time_layout": loads.time_layout,
    "clustered_layout": loads.clustered_layout,
    "result_tables": loads.result_tables,
}

CHECKS: dict[str, Query] = {
    "null_counts": quality.null_counts,
    "value_distributions": quality.value_distributions,
    "logic_checks": quality.logic_checks,
    "domain_violations": quality.domain_violations,
    "classification_mismatch": quality.classification_mismatch,
    "rssi_out_of_range": quality.rssi_out_of_range,
    "zone_anchor_mismatch": quality.zone_anchor_mismatch,
    "validation_report": quality.validation_report,
}

CLEAN: dict[str, Query] = DERIVED | ANALYSES | LOADS
DAMAGED: dict[str, Query] = {
    **CHECKS,
    "signal_sentinel": signal_sentinel,
    # analyses again, where null and doubly counted rows make a difference
    "category_counts_damaged": counts.category_counts,
    "downtime_by_forklift_damaged": rates.downtime_by_forklift,
    "composite_risk_zone_shift_damaged": rates.composite_risk_zone_shift,
    "composite_risk_matrix_observed": composite_risk_matrix_observed,
}
# readings of which some vehicles and days are silent
SILENCED: dict[str, Query] = {"cadence_gaps": cadence_gaps}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over(source: Callable[[SparkSession, str], DataFrame], query: Query):
        return lambda spark, sf_dir: query(source(spark, sf_dir))

    registered = {name: over(events.telemetry, query) for name, query in CLEAN.items()}
    registered |= {name: over(events.damaged_telemetry, query) for name, query in DAMAGED.items()}
    registered |= {name: over(events.silenced_telemetry, query) for name, query in SILENCED.items()}
    return registered
