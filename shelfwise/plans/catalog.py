"""Registry of the query keys: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import new_scratch
from ..sources.star import build_star
from ..streaming import jobs as S
from ..streaming import warehouse as SW
from . import aggregates as A
from . import dimensions as D
from . import fact as FT
from . import ingest as I
from . import load as L
from . import quality as QC
from . import queries as Q

Runner = Callable[[SparkSession, str], DataFrame]


def _star(fn) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(build_star(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


OLAP: dict[str, Runner] = {
    "q1_supplier_drilldown": _star(Q.q1_supplier_drilldown),
    "q2_rollup_compat": _star(Q.q2_rollup_compat),
    "q2_grouping_sets": _star(Q.q2_grouping_sets),
    "q3_weekend_top5": _star(Q.q3_weekend_top5),
    "q4_quarter_pivot": _star(Q.q4_quarter_pivot),
    "q5_sigma_anomaly": _star(Q.q5_sigma_anomaly),
    "q6_store_product_mv": _star(Q.q6_store_product_mv),
    "q6_line": _star(Q.q6_line),
    "q7_store_slice": _star(Q.q7_store_slice),
    "q7_line": _star(Q.q7_line),
    "q8_supplier_month_mv": _star(Q.q8_supplier_month_mv),
    "q9_compat": _star(Q.q9_compat),
    "q9_line": _star(Q.q9_line),
    "q10_entity_month_mv_compat": _star(Q.q10_entity_month_mv_compat),
    "q10_entity_month_mv_line": _star(Q.q10_entity_month_mv_line),
}


def _scratch(fn, name: str) -> Runner:
    """A job that writes: it gets a fresh folder below the shared checkpoint dir."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(build_star(spark, sf_dir), new_scratch(spark, name))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.calendar_parts(build_star(spark, sf_dir).t.events)


LOAD: dict[str, Runner] = {
    "clean_price": _star(I.clean_price_rows),
    "parse_order_date": _star(I.parse_order_date_rows),
    "reject_bad_dates": _star(I.reject_bad_dates),
    "calendar_parts": _calendar,
    "dim_time": _star(I.dim_time),
    "dim_supplier": _star(D.dim_supplier),
    "dim_product": _star(D.dim_product),
    "dim_store": _star(D.dim_store),
    "dim_customer": _star(D.dim_customer),
    "dim_conflicts": _star(D.dim_conflicts),
    "dim_incremental_anti": _star(D.dim_incremental_anti),
    "surrogate_key": _star(D.surrogate_key),
    "check_primary_key": _star(QC.check_primary_key),
    "check_foreign_key": _scratch(QC.check_foreign_key, "check_foreign_key"),
    "check_constraints": _scratch(QC.check_constraints, "check_constraints"),
    "check_lengths": _star(QC.check_lengths),
    "load_audit_counts": _scratch(QC.load_audit_counts, "load_audit"),
    "csv_roundtrip_scan": _scratch(I.csv_roundtrip_scan, "csv_roundtrip"),
    "lookup_time_first": _star(FT.lookup_time_first),
    "lookup_store_first": _star(FT.lookup_store_first),
    "fact_load_compat": _star(FT.fact_load_compat),
    "fact_load_line": _star(FT.fact_load_line),
    "fact_readback_semi": _scratch(FT.fact_readback_semi, "fact_readback"),
    "csv_load_fact": _scratch(L.csv_load_fact, "csv_load"),
    "csv_load_rejects": _scratch(L.csv_load_rejects, "csv_load_rejects"),
    "fact_line_rejects": _scratch(L.fact_line_rejects, "fact_line_rejects"),
    "mv_refresh_full": _scratch(A.mv_refresh_full, "mv_full"),
    "mv_refresh_mixed": _scratch(A.mv_refresh_mixed, "mv_mixed"),
    "refresh_all": _scratch(A.refresh_set, "refresh_all"),
    "mv_refresh_incremental": _scratch(A.mv_refresh_incremental, "mv_incremental"),
}

STREAM: dict[str, Runner] = {
    "stream_microbatch_ingest": _scratch(S.stream_microbatch_ingest, "stream_ingest"),
    "stream_enrich_fact": _scratch(S.stream_enrich_fact, "stream_enrich"),
    "stream_dim_incremental": _scratch(S.stream_dim_incremental, "stream_dim"),
    "stream_mv_refresh": _scratch(S.stream_mv_refresh, "stream_mv"),
    "stream_q9_line": _scratch(S.stream_q9_line, "stream_q9"),
    "stream_q9_sketch": _scratch(S.stream_q9_sketch, "stream_q9_sketch"),
    "stream_q5_sigma": _scratch(S.stream_q5_sigma, "stream_q5_sigma"),
    "stream_controlled": _scratch(S.stream_controlled, "stream_controlled"),
    "stream_csv_ingest": _scratch(S.stream_csv_ingest, "stream_csv"),
    "stream_rows_by_key": _scratch(S.stream_rows_by_key, "stream_rows_by_key"),
    "stream_rate_report": _scratch(S.stream_rate_report, "stream_rate"),
    "stream_then_q4": _scratch(SW.stream_then_q4, "stream_then_q4"),
    "stream_then_q9": _scratch(SW.stream_then_q9, "stream_then_q9"),
    "reload_then_stream": _scratch(SW.reload_then_stream, "reload_then_stream"),
    "late_products": _scratch(SW.late_products, "late_products"),
    "stream_master_dims": _scratch(SW.stream_master_dims, "stream_master_dims"),
    "stream_constraints": _scratch(SW.stream_constraints, "stream_constraints"),
    "stream_fact_compat": _scratch(S.stream_fact_compat, "stream_fact_compat"),
}


def all_queries() -> dict[str, Runner]:
    out: dict[str, Runner] = {}
    out.update(OLAP)
    out.update(LOAD)
    out.update(STREAM)
    return out


def all_oracles() -> dict[str, str]:
    from .oracle import QUERIES
    return dict(QUERIES)
