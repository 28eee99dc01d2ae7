"""Registers queries with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Tables, duck

#: Sums that DuckDB widens to 128 bits or decimals, by query; their twins cast them back.
CASTS = {
    "ag10_mosaic_counters": {"candidates": "BIGINT"},
    "ag11_split_summary": {"objects": "BIGINT", "val_objects": "BIGINT"},
    "ag13_stitched_weighted": {"weight": "BIGINT"},
    "ag14_coverage": {"least": "BIGINT", "most": "BIGINT"},
    "ag17_final_objects": {"pixels": "BIGINT"},
    "ag22_job_metrics": {"total": "BIGINT"},
    "ag24_class_inventory": {"objects": "BIGINT"},
    "ag27_last_samples": {"bytes": "BIGINT"},
    "ag8_tile_summary": {"objects": "BIGINT", "pixels": "BIGINT"},
    "jn12_block_tiles": {"index_sum": "BIGINT"},
    "jn8_annotated_windows": {"mask_area": "BIGINT"},
    "mt7_tile_kinds": {"pixels": "BIGINT"},
    "rg10_vertex_count": {"vertices": "BIGINT"},
    "rg4_window_polygon": {"px0": "DOUBLE", "py0": "DOUBLE", "px2": "DOUBLE", "py2": "DOUBLE"},
    "snk9_retention": {"bytes": "BIGINT"},
    "so7_differing_tiles": {"score": "BIGINT"},
    "src2_layout_status": {"bytes": "BIGINT"},
    "st6_scenes_in_flight": {"in_flight": "BIGINT"},
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Decorates (tables) -> DataFrame; without sql the query has no twin and is tested otherwise."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = duck(sql)
            if casts := CASTS.get(name):
                told = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in casts.items())
                SQL[name] = f"SELECT * REPLACE ({told}) FROM ({SQL[name]}) q"
        return f

    return add
