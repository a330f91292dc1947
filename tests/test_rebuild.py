"""The rebuild's plans and bookkeeping: one pass over each source, items stored
in buckets, one integrity scan, file order, the current build."""

import re
import threading

import pytest
from pyspark.sql import functions as F

from salesmart.operators import dedup as dd
from salesmart.operators import quality
from salesmart.operators.staging import PIECE, clustered_items, dedup_source
from salesmart.params import Params
from salesmart.plans import builds, pipeline
from salesmart.plans.pipeline import land_csv, rebuild
from salesmart.plans.warehouse import Warehouse
from salesmart.session import new_run_dir
from salesmart.sources import SOURCES, read_source, read_sources
from salesmart.sources.fixture import fixture_sources
from salesmart.sources.readers import POSITION
from tests.builders import ITEMS, d, order, sources
from tests.conftest import SF001
from tests.test_skew import _sources as skewed_sources
from tests.test_skew import skew_conf  # noqa: F401

SMALL = Params(high_tier_min=1_300_000, medium_tier_min=700_000, growth_min_prev_revenue=0, late_states_min_orders=1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def built(spark):
    raw = land_csv(spark, fixture_sources(spark, SF001))
    seen = {name: spark.sparkContext.accumulator(0) for name in SOURCES}

    def counted(name, df):
        def count(batches):
            for batch in batches:
                seen[name].add(len(batch))
                yield batch
        return df.mapInArrow(count, df.schema)

    report = rebuild(spark, {n: counted(n, df) for n, df in read_sources(spark, raw).items()}, SMALL, answers=False)
    return raw, report, {n: a.value for n, a in seen.items()}


def test_each_source_is_read_once(spark, built):
    raw, report, seen = built
    assert seen == {n: report.source_rows[f"raw_{n}"] for n in SOURCES} and seen["order_items"] == 6000
    w = Warehouse(read_sources(spark, raw), SMALL)
    accounting = {}
    for r in w.row_accounting().collect():
        accounting.setdefault(r.table_name, {})[r.step] = r.rows
    assert report.accounting == accounting
    assert report.duplicates == {r.table_name: r.duplicate_rows for r in w.source_duplicates().collect()}
    profile = {}
    for r in w.source_profile().collect():
        profile.setdefault(r.table_name, {})["rows" if r.metric == "rows" else f"nulls:{r.column_name}"] = r.value
    assert report.profile == profile
    assert len(report.previews["mart_monthly_sales"]) == 5


def test_fact_join_reads_stored_items_as_they_lie(spark, built):
    w = Warehouse.from_written(spark, built[1].out_dir, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(w.star_builders()["fact_order_items"]()).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "price" in line.split("Batched")[0]]
    assert len(scans) == 1 and "Bucketed: true" in lines[scans[0]]
    depth = lambda line: re.search(r"[A-Z]", line).start()
    above, at = [], depth(lines[scans[0]])
    for line in reversed(lines[:scans[0]]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    # The other side has one row per order and piece: no line-grain exchange at all.
    for line in lines:
        if "Exchange" in line:
            assert "price" not in line


def test_stored_items_open_in_any_session(spark, built):
    report = built[1]
    name = f"salesmart_build_{report.build_id}_stg_order_items"
    before = rows(Warehouse.from_written(spark, report.out_dir, SMALL).table("stg_order_items"))
    spark.sql(f"DROP TABLE `{name}`")
    w = Warehouse.from_written(spark, report.out_dir, SMALL)
    assert PIECE not in w.table("stg_order_items").columns
    assert rows(w.table("stg_order_items")) == before and len(before) == 4599
    assert spark.catalog.tableExists(name)


def test_hot_order_and_hot_copies_through_the_rebuild(spark, skew_conf, monkeypatch):  # noqa: F811
    monkeypatch.setattr(dd, "HOT_COPIES", 50)
    src = skewed_sources(spark)
    lazy = Warehouse(src, SMALL)
    report = rebuild(spark, src, SMALL, answers=False)
    w = Warehouse.from_written(spark, report.out_dir, SMALL)
    for name in ("stg_order_items", "fact_order_items", "mart_sales_by_category", "mart_customer_value"):
        columns = lazy.table(name).columns
        assert rows(w.table(name).select(*columns)) == rows(lazy.table(name)), name
    # The hot order's lines lie in many buckets, the copies of one key were cut first.
    stored = spark.read.parquet(f"{report.out_dir}/stg_order_items")
    files = stored.where("order_id = 'o7'").select(F.input_file_name()).distinct().count()
    assert files >= 4
    hot = dd.hot_keys(src["order_items"], SOURCES["order_items"].pk, src["order_items"].count()).collect()
    assert [tuple(r) for r in hot] == [("o8", 2)]
    dealt = clustered_items(src["order_items"], 2300, 8)
    assert "WindowGroupLimit" in plan(dealt) and "Partial" in plan(dealt)


def test_clustered_dedup_with_null_keys(spark):
    data = [("a", 1, "p", 1), ("a", 1, "o", 2), ("a", None, "q", 3), ("a", None, "q", 3), (None, 1, "r", 4), (None, 1, "s", 5),
            (None, None, "t", 6), ("a", 64, "u", 7), ("a", 65, "v", 8), ("b", 1, None, None), ("b", 1, "z", 9)] * 3
    items = spark.createDataFrame([(o, n, p, v, v) for o, n, p, v in data], ITEMS.replace("decimal(10,2)", "int")).repartition(5)
    got = clustered_items(items, len(data), 4).drop(PIECE)
    assert rows(got) == rows(dedup_source("order_items", items)) and got.count() == 7


def test_integrity_is_one_scan_and_agrees_with_the_joins(spark, built):
    w = Warehouse.from_written(spark, built[1].out_dir, SMALL)
    p = plan(w.integrity())
    assert p.count("order_date_key") and len(re.findall(r"FileScan parquet \[customer_key#\d+L?,product_key", p)) == 1
    got = w.integrity().collect()
    assert {r.joined_rows for r in got} == {w.star_join().count()} and not any(r.orphan_rows for r in got)
    fact = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (3, None), (9, 9), (1, 1)], "a int, b int")
    one = spark.createDataFrame([(1,), (3,), (None,), (1,)], "k int")
    two = spark.createDataFrame([(1,), (2,)], "k int")
    cells = {r.key_column: r for r in quality.fact_integrity(fact, [("a", one, "k"), ("b", two, "k")], "f").collect()}
    assert (cells["a"].orphan_rows, cells["a"].null_rows) == (1, 1)
    assert (cells["b"].orphan_rows, cells["b"].null_rows) == (1, 1)
    assert {r.joined_rows for r in cells.values()} == {3}
    none = quality.fact_integrity(fact.limit(0), [("a", one, "k")], "f").collect()
    assert [(r.orphan_rows, r.null_rows, r.joined_rows) for r in none] == [(0, 0, 0)]


def test_marts_join_no_lines(spark, built):
    w = Warehouse.from_written(spark, built[1].out_dir, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {name: plan(build()) for name, build in w.mart_builders().items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    category, monthly = plans["mart_sales_by_category"], plans["mart_monthly_sales"]
    # Lines are summed before any join: the aggregate stands below the join.
    assert re.search(r"SortMergeJoin \[product_key#\d+L?, _salt#\d+\]", category)
    for p, keys in ((category, "product_key"), (monthly, "order_date_key")):
        after = p[p.index("SortMergeJoin"):]
        assert re.search(rf"HashAggregate\(keys=\[{keys}#", after) and "Expand" not in p


@pytest.fixture(scope="module")
def repeated_csv(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("repeats")
    lines = ["order_id,order_item_id,product_id,price,freight_value"]
    lines += [f"o{i % 400},1,p{(997 * i) % 1000:03d},{i}.00,1.00" for i in range(2000)]
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    return str(folder / "a.csv")


@pytest.mark.parametrize("splits", [1, 8])
def test_first_row_in_file_order_stays(spark, repeated_csv, splits):
    import os
    size = os.path.getsize(repeated_csv)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(-(-size // splits)))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_source(spark, SOURCES["order_items"], repeated_csv, positions=True)
        assert df.rdd.getNumPartitions() >= splits
        for got in (dedup_source("order_items", df.repartition(3)), clustered_items(df.repartition(3), 2000, 4)):
            assert POSITION not in got.columns
            assert sorted((r.order_id, int(r.price)) for r in got.collect()) == sorted((f"o{i}", i) for i in range(400))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_of_a_source_are_ordered_by_name(spark, tmp_path):
    for name, price in (("b.csv", 2), ("a.csv", 1), ("c.csv", 3)):
        (tmp_path / name).write_text(f"order_id,order_item_id,product_id,price,freight_value\no,1,p{9 - price},{price}.00,1.00\n" + "x,1,p,1,1\n" * price * 50)
    df = read_source(spark, SOURCES["order_items"], str(tmp_path), positions=True)
    assert {r.order_id: int(r.price) for r in dedup_source("order_items", df).collect()} == {"o": 1, "x": 1}


def tiny(spark, product="p1"):
    return sources(spark, [order("o1", "c1")], [("o1", 1, product, d(10), d(1))], [("c1", "u1", "x", "S")], [("p1", "cat")], [("cat", "category")])


def test_the_current_build_is_the_last_finished_one(spark, monkeypatch):
    root = new_run_dir(spark, "builds")
    assert builds.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        Warehouse.from_written(spark, root)
    first = rebuild(spark, tiny(spark), answers=False, root=root)
    assert builds.current(spark, root) == first.out_dir
    # A failing build never becomes current.
    with pytest.raises(quality.QualityError):
        rebuild(spark, tiny(spark, "nobody's"), answers=False, root=root)
    assert builds.current(spark, root) == first.out_dir
    # While another one is being written, the parent opens the finished one.
    waiting, go = threading.Event(), threading.Event()
    published = builds.publish

    def slow(*args):
        waiting.set()
        go.wait(60)
        return published(*args)

    monkeypatch.setattr(pipeline.builds, "publish", slow)
    out = {}
    other = threading.Thread(target=lambda: out.update(report=rebuild(spark, tiny(spark), answers=False, root=root)))
    other.start()
    assert waiting.wait(120)
    assert builds.current(spark, root) == first.out_dir and Warehouse.from_written(spark, root).table("dim_dates").count() == 1
    go.set()
    other.join(120)
    assert builds.current(spark, root) == out["report"].out_dir != first.out_dir


def test_versions_are_taken_once_and_kept_as_asked(spark):
    root = new_run_dir(spark, "builds")
    folders = [builds.new_folder(root) for _ in range(4)]
    for f in folders:
        spark.range(1).write.parquet(f)
    assert [builds.publish(spark, root, f) for f in folders[:3]] == [1, 2, 3]
    assert not builds._create(spark, f"{root}/{builds.VERSIONS}/{3:010d}", "other")
    assert builds.publish(spark, root, folders[3], keep=2) == 4
    assert sorted(builds.versions(spark, root)) == [3, 4] and builds.current(spark, root) == folders[3]
    from salesmart.session import has_files
    assert [has_files(spark, f) for f in folders] == [False, False, True, True]
    for bad in (f"{root}/a/b", "/elsewhere/x"):
        with pytest.raises(ValueError):
            builds.publish(spark, root, bad)
    with pytest.raises(ValueError):
        builds.publish(spark, root, folders[3], keep=0)
