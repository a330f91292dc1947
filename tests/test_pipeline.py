import pytest
from pyspark.sql import functions as F

from salesmart.operators.quality import QualityError
from salesmart.params import FIXTURE_PARAMS, Params
from salesmart.plans.pipeline import land, rebuild
from salesmart.plans.warehouse import Warehouse
from salesmart.session import new_run_dir
from salesmart.sources.fixture import fixture_sources
from tests.conftest import SF001

SMALL = Params(high_tier_min=1_300_000, medium_tier_min=700_000, growth_min_prev_revenue=0, late_states_min_orders=1)


def _warehouse(spark):
    return Warehouse.from_fixture(spark, SF001, SMALL)


def test_rebuild_sf0001_counts_and_gates(spark):
    report = rebuild(spark, fixture_sources(spark, SF001), SMALL)
    # Expected counts measured independently (FIXTURES.md §2).
    assert report.rows["stg_order_items"] == 4599
    assert report.rows["stg_orders"] == 493
    assert report.rows["dim_customers"] == 150
    assert report.rows["dim_products"] == 200
    assert report.rows["dim_dates"] == 446
    assert report.rows["fact_order_items"] == 1524
    assert report.rows["mart_customer_value"] == 145
    assert report.profile["order_items"]["rows"] == 6000
    assert report.duplicates["order_items"] == 6000 - 4599
    assert all(r["violations"] == 0 for r in report.checks["star_keys"])
    assert {r["check"] for r in report.checks["star_keys"]} == {"primary_key", "foreign_key", "star_join"}
    assert report.accounting["order_items"]["in_fact"] == 1524
    assert report.accounting["order_items"]["after_dedup"] == 4599
    profile = {(r.table_name, r.metric, r.column_name): r.value for r in _warehouse(spark).source_profile().collect()}
    assert {(t, m.partition(":")[0], m.partition(":")[2] or None): v
            for t, cells in report.profile.items() for m, v in cells.items()} == profile
    assert report.duplicates == {r.table_name: r.duplicate_rows for r in _warehouse(spark).source_duplicates().collect()}
    assert report.rows["q1_top_categories"] > 0 and report.rows["eda_correlation"] == 16
    written = spark.read.parquet(f"{report.out_dir}/fact_order_items")
    assert written.count() == 1524


def test_rebuild_from_landed_sources_matches(spark):
    src = land(spark, fixture_sources(spark, SF001))
    report = rebuild(spark, src, SMALL, answers=False)
    assert report.rows["fact_order_items"] == 1524


def test_empty_source_fails_loudly(spark):
    src = fixture_sources(spark, SF001)
    src["products"] = src["products"].where(F.lit(False))
    with pytest.raises(QualityError, match="products"):
        rebuild(spark, src, SMALL, answers=False)


def test_fixture_thresholds_filter_everything_at_sf0001(spark):
    # FIXTURES.md: at sf0.001 the Q2/Q6 fixture thresholds keep no rows,
    # and the answers gate refuses empty results, as the reference does.
    with pytest.raises(QualityError):
        rebuild(spark, fixture_sources(spark, SF001), FIXTURE_PARAMS)


def test_later_stages_run_on_a_written_warehouse(spark):
    report = rebuild(spark, fixture_sources(spark, SF001), SMALL, answers=False)
    w = Warehouse.from_written(spark, report.out_dir, SMALL)
    assert w.question("q3_top_customers").count() == 10
    assert {r.table_name: r.rows for r in w.row_counts().collect()} == report.rows
    marts_only = Warehouse.from_written(spark, report.out_dir, SMALL, layers=("marts",))
    assert marts_only.question("q3_top_customers").count() == 10
    with pytest.raises(FileNotFoundError, match="no finished build"):
        Warehouse.from_written(spark, report.out_dir + "-missing", SMALL, layers=("marts",))
    with pytest.raises(FileExistsError):
        rebuild(spark, fixture_sources(spark, SF001), SMALL, out_dir=report.out_dir)
    w.register_views("w_")
    rows = spark.sql("SELECT count(*) AS n FROM w_fact_order_items JOIN w_dim_products USING (product_key)").first()
    assert rows.n == 1524


def test_failed_build_cannot_be_opened(spark):
    # Items that point at a product nobody lists: the key gate must fail and
    # the folder must not open as a warehouse.
    src = fixture_sources(spark, SF001)
    src["order_items"] = src["order_items"].withColumn(
        "product_id", F.when(F.col("product_id") % 7 == 0, F.lit(-1)).otherwise(F.col("product_id")))
    out = new_run_dir(spark, "broken")
    with pytest.raises(QualityError, match="star_keys"):
        rebuild(spark, src, SMALL, out_dir=out)
    with pytest.raises(FileNotFoundError, match="no finished build"):
        Warehouse.from_written(spark, out, SMALL)


def test_rebuild_refuses_a_session_that_hides_bad_values(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            rebuild(spark, fixture_sources(spark, SF001), SMALL)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_preview_is_deterministic(spark):
    from salesmart.operators.quality import preview
    df = spark.range(100).selectExpr("id % 7 AS a", "id AS b")
    first = [tuple(r) for r in preview(df.repartition(5), 5).collect()]
    assert first == [(0, 0), (0, 7), (0, 14), (0, 21), (0, 28)]


def test_command_line_rebuild_and_answer(spark, capsys, tmp_path):
    import json

    from salesmart.__main__ import main
    src = fixture_sources(spark, SF001)
    raw = tmp_path / "raw"
    for name, df in src.items():
        from salesmart.sources import SOURCES
        df.write.parquet(str(raw / SOURCES[name].file_name))
    args = ["--high", "1300000", "--medium", "700000", "--min-prev", "0", "--min-orders", "1"]
    assert main(["rebuild", str(raw), "--format", "parquet", *args]) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["rows"]["fact_order_items"] == 1524
    assert main(["answer", out["out_dir"], "--rows", "3", *args]) == 0
    shown = capsys.readouterr().out
    assert "== q6_worst_late_states" in shown and "more rows)" in shown
    assert main(["answer", out["out_dir"], *args]) == 0
    assert "more rows)" not in capsys.readouterr().out
