import os
import tempfile
from decimal import Decimal

import pytest

from salesmart.sources import SOURCES, read_source, read_sources
from salesmart.sources.specs import SourceSpec


def _write(text: str) -> str:
    folder = tempfile.mkdtemp(prefix="salesmart-csv-")
    path = os.path.join(folder, "f.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_csv_by_name_with_null_tokens_quotes_and_extras(spark):
    path = _write("product_id,extra,price,freight_value,order_item_id,order_id\n"
                  'p1,"a, b",10.50,,1,o1\n'
                  "p2,NA,NA,1.00,2,o1\n")
    df = read_source(spark, SOURCES["order_items"], path)
    rows = sorted(df.collect(), key=lambda r: r.order_item_id)
    assert df.columns[:5] == ["order_id", "order_item_id", "product_id", "price", "freight_value"]
    assert rows[0].price == Decimal("10.50") and rows[0].freight_value is None and rows[0].extra == "a, b"
    assert rows[1].price is None and rows[1].extra is None


def test_csv_bad_number_fails(spark):
    path = _write("order_id,order_item_id,product_id,price,freight_value\no1,x,p,1.00,1.00\n")
    with pytest.raises(Exception):
        read_source(spark, SOURCES["order_items"], path).collect()


def test_csv_timestamps_parse(spark):
    path = _write("order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date,"
                  "order_estimated_delivery_date\no1,c1,delivered,2017-10-02 10:56:33,,2017-10-18 00:00:00\n")
    r = read_source(spark, SOURCES["orders"], path).first()
    assert r.order_purchase_timestamp.isoformat() == "2017-10-02T10:56:33" and r.order_delivered_customer_date is None


def test_missing_file_and_missing_column(spark):
    with pytest.raises(FileNotFoundError):
        read_source(spark, SOURCES["orders"], "/nonexistent/salesmart/orders.csv")
    path = _write("order_id,customer_id\no1,c1\n")
    with pytest.raises(ValueError, match="missing columns"):
        read_source(spark, SOURCES["orders"], path)


def test_csv_files_with_differing_headers_fail(spark):
    # Read by position, the second file would swap key and category.
    folder = tempfile.mkdtemp(prefix="salesmart-csv-")
    for name, text in (("a.csv", "product_id,product_category_name\np1,toys\n"),
                       ("b.csv", "product_category_name,product_id\nbeauty,p2\n")):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, SOURCES["products"], folder).collect()


def test_read_source_refuses_a_session_without_ansi(spark):
    path = _write("product_id,product_category_name\np1,toys\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            read_source(spark, SOURCES["products"], path)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_header_only_file_reads_empty(spark):
    path = _write("product_id,product_category_name\n")
    assert read_source(spark, SOURCES["products"], path).isEmpty()


def test_read_sources_uses_registry_file_names(spark):
    folder = tempfile.mkdtemp(prefix="salesmart-raw-")
    spec = {"products": SourceSpec("products", "p.csv", ("product_id",), {"product_id": "string"})}
    with open(os.path.join(folder, "p.csv"), "w") as fh:
        fh.write("product_id\nx\n")
    assert read_sources(spark, folder, specs=spec)["products"].count() == 1


def test_csv_sources_end_to_end(spark):
    """The five sources written as CSV with a header, read back by name and
    typed, give the same warehouse as the Parquet mapping."""
    from salesmart.params import Params
    from salesmart.plans.pipeline import rebuild
    from salesmart.sources.fixture import fixture_sources
    from tests.conftest import SF001

    folder = tempfile.mkdtemp(prefix="salesmart-raw-csv-")
    for name, df in fixture_sources(spark, SF001).items():
        path = f"{folder}/{SOURCES[name].file_name}"
        cols = [c for c in df.columns]
        df.select(*cols).write.option("header", True).csv(path)
    sources = read_sources(spark, folder)
    # CSV has no types: ids arrive as strings, the rest as declared.
    assert dict(sources["order_items"].dtypes)["price"] == "decimal(10,2)"
    assert dict(sources["orders"].dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    small = Params(high_tier_min=1_300_000, medium_tier_min=700_000, growth_min_prev_revenue=0,
                   late_states_min_orders=1)
    report = rebuild(spark, sources, small, answers=False)
    assert report.rows["stg_order_items"] == 4599 and report.rows["fact_order_items"] == 1524
    assert report.rows["dim_customers"] == 150 and report.rows["dim_dates"] == 446
