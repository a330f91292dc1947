"""Lazy handles to every table of the warehouse.

Nothing runs when a :class:`Warehouse` is built or a table is asked for:
each attribute is a DataFrame plan over the sources (or over tables the
pipeline has written, see :mod:`salesmart.plans.pipeline`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import eda, marts, questions, quality, staging, star
from salesmart.operators.staging import STAGING_NAMES
from salesmart.params import Params
from salesmart.plans import builds
from salesmart.sources.fixture import fixture_sources
from salesmart.sources.sinks import Buckets, open_bucketed
from salesmart.sources.specs import SOURCES

QUESTION_NAMES = ("q1_top_categories", "q2_growth_extremes", "q3_top_customers", "q4_repeat_vs_one_time",
                  "q5_top_products", "q6_worst_late_states")
CHART_NAMES = ("eda_top_categories", "eda_monthly_trend", "eda_value_tiers", "eda_correlation")
LAYERS = {
    "staging": tuple(STAGING_NAMES.values()),
    "star": ("dim_customers", "dim_products", "dim_dates", "fact_order_items"),
    "marts": ("mart_sales_by_category", "mart_monthly_sales", "mart_customer_value"),
}
TABLE_NAMES = tuple(name for names in LAYERS.values() for name in names)
BUILD_RECORD = "build_record"
RECORD_SCHEMA = "build_id string, table_name string, rows long, buckets int"
BUILD_TABLE = "salesmart_build_"  # catalog names of bucketed tables: this, build id, table
BUCKET_COLUMNS = ("order_id", staging.PIECE)


class Warehouse:
    def __init__(self, sources: dict[str, DataFrame], params: Params = Params(),
                 tables: dict[str, DataFrame] | None = None, recorded_rows: dict[str, int] | None = None):
        self.sources = sources
        self.params = params
        self._given = dict(tables or {})
        self._recorded = dict(recorded_rows or {})

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, params: Params = Params()) -> "Warehouse":
        return cls(fixture_sources(spark, sf_dir), params)

    @classmethod
    def from_written(cls, spark: SparkSession, run_dir: str, params: Params = Params(),
                     layers: tuple[str, ...] = tuple(LAYERS)) -> "Warehouse":
        """Open the tables of a finished build (B6), or of the current one of a
        folder of builds. A build writes its record last, after every gate; a
        folder without one, or whose record lacks a table asked for, raises
        ``FileNotFoundError``."""
        path = builds.current(spark, run_dir) or run_dir.rstrip("/")
        try:
            record = spark.read.schema(RECORD_SCHEMA).parquet(f"{path}/{BUILD_RECORD}").collect()  # one row per table
            rows = {r["table_name"]: r["rows"] for r in record}
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            raise FileNotFoundError(f"no finished build under {run_dir}: its {BUILD_RECORD} is missing") from err
        wanted = [name for layer in layers for name in LAYERS[layer]]
        missing = [name for name in wanted if name not in rows]
        if missing:
            raise FileNotFoundError(f"the build under {run_dir} did not write {missing}")
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in wanted}
        for r in record:
            if r["buckets"] and r["table_name"] in tables:
                name = r["table_name"]
                spec = Buckets(r["buckets"], BUCKET_COLUMNS, f"{BUILD_TABLE}{r['build_id']}_{name}")
                tables[name] = open_bucketed(spark, f"{path}/{name}", spec, tables[name].schema)
        return cls({}, params, tables, rows)

    # -- layers ---------------------------------------------------------
    def _layer(self, names, build) -> dict[str, DataFrame]:
        """Given (written) tables win; the plan is built only if one is missing."""
        if all(n in self._given for n in names):
            return {n: self._given[n] for n in names}
        return {k: self._given.get(k, v) for k, v in build().items()}

    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        return self._layer(LAYERS["staging"], lambda: staging.staging(self.sources, self.params))

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return self._layer(LAYERS["star"], lambda: star.star(self.stg, self.params))

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        return self._layer(LAYERS["marts"], lambda: marts.marts(self.star, self.params))

    # -- per-table plan builders, for callers that build in parallel ------
    def star_builders(self) -> dict[str, Callable[[], DataFrame]]:
        return star.star_builders(self.stg, self.params)

    def mart_builders(self) -> dict[str, Callable[[], DataFrame]]:
        return marts.mart_builders(self.table, self.params)

    def answer_builders(self) -> dict[str, Callable[[], DataFrame]]:
        names = [*QUESTION_NAMES, *CHART_NAMES]
        return {n: (lambda n=n: self._answer(n)) for n in names}

    def _answer(self, name: str) -> DataFrame:
        p, t = self.params, self.table
        build = {
            "q1_top_categories": lambda: questions.q1_top_categories(t("mart_sales_by_category"), p.top_categories_n),
            "q2_growth_extremes": lambda: questions.q2_growth_extremes(t("mart_monthly_sales"),
                                                                       p.growth_min_prev_revenue, p.growth_n),
            "q3_top_customers": lambda: questions.q3_top_customers(t("mart_customer_value"), p.top_customers_n),
            "q4_repeat_vs_one_time": lambda: questions.q4_repeat_vs_one_time(t("mart_customer_value")),
            "q5_top_products": lambda: questions.q5_top_products(t("fact_order_items"), t("dim_products"),
                                                                 p.top_products_n),
            "q6_worst_late_states": lambda: questions.q6_worst_late_states(
                t("fact_order_items"), t("dim_customers"), p.late_states_min_orders, p.late_states_n),
            "eda_top_categories": lambda: eda.eda_top_categories(t("mart_sales_by_category"),
                                                                 p.chart_top_categories_n),
            "eda_monthly_trend": lambda: eda.eda_monthly_trend(t("mart_monthly_sales")),
            "eda_value_tiers": lambda: eda.eda_value_tiers(t("mart_customer_value")),
            "eda_correlation": lambda: eda.eda_correlation(t("fact_order_items")),
        }
        return build[name]()

    def table(self, name: str) -> DataFrame:
        """A table as given (written), else its plan; only the layer it
        belongs to is built."""
        if name in self._given:
            return self._given[name].drop(staging.PIECE)  # how it is stored is not part of the table
        if name in LAYERS["staging"]:
            return self.stg[name]
        if name in LAYERS["star"]:
            return self.star[name]
        return self.marts[name]

    def register_views(self, prefix: str = "", names: tuple[str, ...] = TABLE_NAMES) -> None:
        """Temp views of the tables (A5), so SQL can query them by name."""
        for name in names:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")

    # -- answers ----------------------------------------------------------
    def question(self, name: str) -> DataFrame:
        return self._memo(name)

    def chart(self, name: str) -> DataFrame:
        return self._memo(name)

    def _memo(self, name: str) -> DataFrame:
        cache = self.__dict__.setdefault("_answers", {})
        if name not in cache:
            cache[name] = self._answer(name)
        return cache[name]

    def questions(self) -> dict[str, DataFrame]:
        return {n: self._answer(n) for n in QUESTION_NAMES}

    def charts(self) -> dict[str, DataFrame]:
        return {n: self._answer(n) for n in CHART_NAMES}

    # -- checks -----------------------------------------------------------
    def source_profile(self) -> DataFrame:
        return quality.union_all([quality.profile(df, name) for name, df in self.sources.items()])

    def source_duplicates(self) -> DataFrame:
        return quality.union_all([quality.duplicates(df, SOURCES[name].pk, name) for name, df in self.sources.items()])

    def primary_keys(self, include_raw: bool = True) -> DataFrame:
        """Declared keys of the star, plus the raw item key (which does
        repeat) when ``include_raw`` and the sources are at hand."""
        t = self.table
        raw = ([quality.primary_key_report(self.sources["order_items"], SOURCES["order_items"].pk, "order_items")]
               if include_raw and "order_items" in self.sources else [])
        return quality.union_all(raw + [
            quality.primary_key_report(t("dim_customers"), ["customer_key"], "dim_customers"),
            quality.primary_key_report(t("dim_products"), ["product_key"], "dim_products"),
            quality.primary_key_report(t("dim_dates"), ["date_key"], "dim_dates"),
            quality.primary_key_report(t("fact_order_items"), ["order_id", "order_item_id"], "fact_order_items"),
        ])

    def integrity(self) -> DataFrame:
        """The fact's references and the rows that the star join keeps, from
        one scan of the fact."""
        t = self.table
        parents = [("customer_key", "dim_customers", "customer_key"), ("product_key", "dim_products", "product_key"),
                   ("order_date_key", "dim_dates", "date_key")]
        names = F.array(*[F.lit(name) for _, name, _ in parents])
        return (quality.fact_integrity(t("fact_order_items"), [(key, t(name), pk) for key, name, pk in parents], "fact_order_items")
                .withColumn("parent_table", F.element_at(names, F.col("parent") + 1)).drop("parent"))

    def foreign_keys(self, include_staging: bool = True) -> DataFrame:
        """The fact's three references, plus staging items -> staging orders
        when ``include_staging`` (non-empty: items of undelivered orders)."""
        columns = ["child_table", "parent_table", "key_column", "orphan_rows"]
        fact = self.integrity().select(*columns)
        if not include_staging:
            return fact
        t = self.table
        return fact.unionByName(quality.foreign_key_report(t("stg_order_items"), t("stg_orders"), "order_id", "order_id",
                                                           "stg_order_items", "stg_orders").select(*columns))

    def row_accounting(self) -> DataFrame:
        return quality.row_accounting(self.sources, self.stg, self.params.delivered_status)

    def star_join(self) -> DataFrame:
        t = self.table
        return quality.star_join(t("fact_order_items"), t("dim_customers"), t("dim_products"), t("dim_dates"))

    def row_counts(self, names: list[str] | None = None) -> DataFrame:
        """Rows per table: from the build record where there is one."""
        names = list(names or TABLE_NAMES)
        if all(n in self._recorded for n in names):
            spark = self.table(names[0]).sparkSession
            return spark.createDataFrame([(n, self._recorded[n]) for n in names], "table_name string, rows long")
        return quality.union_all([self.table(n).agg(F.count(F.lit(1)).alias("rows"))
                                  .select(F.lit(n).alias("table_name"), "rows") for n in names])
