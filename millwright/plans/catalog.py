"""Every registered query by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..schemas import FAMILIES, Family
from . import explore_queries as explore
from . import model_queries as model
from . import sensor_queries as sensor
from . import service_queries as service
from . import stream_queries as stream

Query = Callable[[SparkSession, str], DataFrame]

PER_FAMILY: dict[str, Callable[[SparkSession, str, Family], DataFrame]] = {
    "q_sensor_flatten": sensor.sensor_flatten,
    "q_ratio_features": sensor.ratio_features,
    "q_feature_align": sensor.feature_align,
    "q_train_features": sensor.train_features,
    "q_serving_prev": sensor.serving_prev,
    "q_risk_class": sensor.risk_class,
    "q_upsert": sensor.upsert_rows,
    "q_corr_matrix": explore.correlation_matrix,
    "q_histogram": explore.histogram,
    "q_kde": explore.density,
    "q_standardize": explore.standardize,
    "q_top_features": explore.top_features,
}

SINGLE: dict[str, Query] = {
    "q_daily_slice": sensor.daily_slice,
    "q_crm_today": sensor.crm_today,
    "q_serving_features": sensor.serving_features,
    "q_union_predictions": sensor.union_predictions,
    "q_risk_daily": sensor.risk_daily,
    "q_cdc_classify": sensor.cdc_classify,
    "q_cdc_rejects": sensor.cdc_rejects,
    "q_upsert_dups": sensor.upsert_duplicates,
    "q_upsert_latest": sensor.upsert_latest,
    "q_star_fact": service.star_fact,
    "q_star_dealer": partial(service.star_table, table="dim_dealer"),
    "q_star_vehicle": partial(service.star_table, table="dim_vehicle"),
    "q_star_customer": partial(service.star_table, table="dim_customer"),
    "q_star_services": partial(service.star_table, table="dim_services_performed"),
    "q_star_parts": partial(service.star_table, table="dim_parts_used"),
    "q_parts_total": service.parts_total,
    "q_star_join": service.star_join,
    "q_tz": service.two_zones,
    "q_dq_violations": service.violations,
    "q_accept_reject": service.accept_reject,
    "q_first_rule": service.first_rule,
    "q_posted_verdict": service.posted_verdict,
    "q_kv_items": service.kv_items,
    "q_exact_numbers": service.exact_numbers,
    "q_ingest_to_star": service.ingest_to_star,
    "q_document_commits": service.document_commits,
    "q_paths": service.paths,
    "q_status_counts": explore.status_counts,
    "q_failure_by_hour": explore.failure_by_hour,
    "q_failure_by_weekday": explore.failure_by_weekday,
    "q_dataset_stats": explore.dataset_stats,
    "q_dataset_head": explore.dataset_head,
    "q_density_2d": explore.density_2d,
    "q_confusion": explore.confusion,
    "q_binary_metrics": explore.binary_metrics,
    "q_class_report": explore.class_report,
    "q_metrics_long": explore.metrics_long,
    "q_best_model": explore.best_model,
    "q_split": explore.split,
    "q_split_shares": explore.split_shares,
    "ml_train": model.train,
    "ml_tune": model.tuned,
    "ml_score": model.score,
    "ml_boost_tree": model.first_trees,
    "st_score": stream.score,
    "st_trained_model": stream.trained_model,
    "st_sensor_to_lake": stream.sensor_to_lake,
    "st_lake_to_upsert": stream.lake_to_upsert,
    "st_cdc_log": stream.cdc_log,
    "st_risk_counts": stream.risk_counts,
    "st_risk_tally": stream.risk_tally,
    "st_prev_state": stream.prev_state,
    "st_star": stream.star_rows,
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        f"{name}_{key}": partial(run, family=family)
        for name, run in PER_FAMILY.items()
        for key, family in FAMILIES.items()
    }
    return out | SINGLE
