from __future__ import annotations


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["class_slug", "dataset_version", "run_id", "pixel_f1", "train_date"]
    assert set(e.oracle_sql()) <= set(e.queries())
