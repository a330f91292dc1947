"""The rebuild job (K21): raw -> staging -> star -> marts -> answers.

Every source is opened once: it is written as typed Parquet, and the QA profile,
the duplicates, the row accounting and the staging tables all come from that and
from what is stored next. Items are stored in buckets of (order, piece), so the
fact join reads them as they lie.

Each build goes to a folder of its own. Each layer is written once as Parquet
and read back, so later layers start from the written table (lineage is cut; a
lost executor re-runs only the tasks of the current layer). The tables of one
layer do not depend on each other, so their jobs are submitted together from a
small pool of driver threads and share the executors. Gates run as Spark jobs
after each layer: every table non-empty, keys unique and present, foreign keys
resolved, the star join whole. Only when all have passed is the build record
written, and only a folder with a record can be opened. Row counts and quality
figures come from stored rows, never from counters of tasks that may run twice;
only summaries of a few rows reach the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import quality
from salesmart.operators.quality import QualityError
from salesmart.operators.schemas import schema_mismatches, star_schemas
from salesmart.operators.staging import STAGING_NAMES, apply_rules, clustered_items, dedup_source
from salesmart.params import Params
from salesmart.plans import builds
from salesmart.plans.warehouse import BUCKET_COLUMNS, BUILD_RECORD, BUILD_TABLE, RECORD_SCHEMA, Warehouse
from salesmart.session import has_files, new_run_dir, require_ansi
from salesmart.sources.readers import POSITION
from salesmart.sources.sinks import Buckets, EmptyTableError, write_table
from salesmart.sources.specs import SOURCES


# Jobs of one layer submitted at once; they are small next to a cluster and
# mostly overlap scheduling and commit latency.
LAYER_THREADS = 6
RAW, FIRST = "raw_", "first_"  # tables of a build that hold sources, as read and deduplicated


@dataclass
class RunReport:
    out_dir: str
    build_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    rows: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    checks: dict[str, list[dict]] = field(default_factory=dict)
    table_seconds: dict[str, float] = field(default_factory=dict)
    profile: dict[str, dict[str, int]] = field(default_factory=dict)
    duplicates: dict[str, int] = field(default_factory=dict)
    accounting: dict[str, dict[str, int]] = field(default_factory=dict)
    previews: dict[str, list[dict]] = field(default_factory=dict)
    buckets: dict[str, int] = field(default_factory=dict)
    source_rows: dict[str, int] = field(default_factory=dict)  # of the tables that hold sources


class _Writer:
    def __init__(self, spark: SparkSession, out_dir: str, report: RunReport):
        self.spark, self.out_dir, self.report = spark, out_dir, report

    def __call__(self, name: str, df: DataFrame, partitions: int | None = None, what: str | None = None,
                 buckets: Buckets | None = None, preview: int = 0) -> DataFrame:
        """Write ``df`` as ``name``, fail on an empty result (of ``what``),
        return the written table; the report shows its first ``preview`` rows."""
        start = time.perf_counter()
        try:
            table, rows = write_table(self.spark, df, f"{self.out_dir}/{name}", name=what or name, partitions=partitions,
                                      buckets=buckets)
        except EmptyTableError as err:
            raise QualityError(str(err)) from err
        self.report.table_seconds[name] = round(time.perf_counter() - start, 3)
        (self.report.source_rows if name.startswith((RAW, FIRST)) else self.report.rows)[name] = rows
        if buckets:
            self.report.buckets[name] = buckets.n
        if preview:
            self.report.previews[name] = [r.asDict() for r in quality.preview(table, preview).collect()]
        return table

    def layer(self, frames: dict[str, Callable[[], DataFrame]], **kw) -> dict[str, DataFrame]:
        """Build and write independent tables concurrently (plan analysis
        overlaps too); the first failure is raised."""
        def one(name: str, build: Callable[[], DataFrame]) -> DataFrame:
            return self(name, build(), **kw)
        with ThreadPoolExecutor(max_workers=min(LAYER_THREADS, len(frames))) as pool:
            futures = {name: pool.submit(one, name, build) for name, build in frames.items()}
            return {name: f.result() for name, f in futures.items()}


def _gate(report: RunReport, name: str, summary: DataFrame, failed) -> None:
    start = time.perf_counter()
    rows = [r.asDict() for r in summary.collect()]  # one row per checked table
    report.table_seconds[f"gate:{name}"] = round(time.perf_counter() - start, 3)
    report.checks[name] = rows
    bad = [r for r in rows if failed(r)]
    if bad:
        raise QualityError(f"{name} failed: {bad}")


def _stage(write: _Writer, name: str, source: DataFrame, params: Params) -> dict[str, DataFrame]:
    """One source: written once as it is read, then deduplicated and cleaned
    from there. Returns all its tables."""
    report, raw_name, stg_name, pk = write.report, f"{RAW}{name}", STAGING_NAMES[name], SOURCES[name].pk
    raw = write(raw_name, source, what=f"source {name}")
    rows = report.source_rows[raw_name]
    tables = {raw_name: raw}
    if name == "order_items":
        n = int(write.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = Buckets(n, BUCKET_COLUMNS, f"{BUILD_TABLE}{report.build_id}_{stg_name}")
        tables[stg_name] = write(stg_name, apply_rules(name, clustered_items(raw, rows, n), params), buckets=buckets)
    elif name == "orders":  # its rules drop rows, which the accounting tells apart
        first = tables[f"{FIRST}{name}"] = write(f"{FIRST}{name}", dedup_source(name, raw))
        tables[stg_name] = write(stg_name, apply_rules(name, first, params))
    else:
        tables[stg_name] = write(stg_name, apply_rules(name, dedup_source(name, raw), params))
    report.duplicates[name] = rows - report.source_rows.get(f"{FIRST}{name}", report.rows[stg_name])
    return tables


def _inspect(report: RunReport, name: str, raw: DataFrame) -> None:
    cells = quality.profile(raw.drop(POSITION), name).collect()  # one row per column at most
    report.profile[name] = {"rows" if r.metric == "rows" else f"nulls:{r.column_name}": r.value for r in cells}


def _account_orders(report: RunReport, first_orders: DataFrame, params: Params) -> None:
    """Where the rows of the orders went (B9)."""
    kept = quality.order_steps(first_orders, params.delivered_status).first()
    report.accounting["orders"] = {"raw": report.source_rows[f"{RAW}orders"], "after_dedup": kept["kept"],
                                   "not_delivered": kept["not_delivered"], "null_purchase_time": kept["no_purchase_time"]}


def _account_items(report: RunReport, stg: dict[str, DataFrame]) -> None:
    """Where the rows of the items went: what the joins lose, less the lines of
    orders without a customer, had no delivered order."""
    lost = quality.lines_without_customer(stg["stg_order_items"], stg["stg_orders"], stg["stg_customers"]).first()["lines"]
    kept, fact = report.rows["stg_order_items"], report.rows["fact_order_items"]
    report.accounting["order_items"] = {
        "raw": report.source_rows[f"{RAW}order_items"], "after_dedup": kept, "order_not_delivered_or_missing": kept - lost - fact,
        "order_without_customer": lost, "in_fact": fact}


def rebuild(spark: SparkSession, sources: dict[str, DataFrame], params: Params = Params(),
            out_dir: str | None = None, answers: bool = True, root: str | None = None, keep: int | None = None,
            preview_rows: int = 5) -> RunReport:
    """Run the whole build; return row counts, stage times and check results.

    ``out_dir`` defaults to a fresh folder under ``root`` or else under
    ``spark.checkpoint.dir``; a folder that already holds something is refused.
    With ``root``, the finished build becomes its current one, and builds older
    than the last ``keep`` are removed (none unless asked for).
    """
    require_ansi(spark)
    if out_dir and root:
        raise ValueError("give out_dir, or root for a new folder under it")
    if out_dir and has_files(spark, out_dir):
        raise FileExistsError(f"{out_dir} is not empty; every build needs a folder of its own")
    report = RunReport(out_dir or (builds.new_folder(root) if root else new_run_dir(spark)))
    write = _Writer(spark, report.out_dir, report)
    clock = time.perf_counter()

    def lap(stage: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        report.seconds[stage] = round(now - clock, 3)
        clock = now

    # Stage 1: the raw sources, each read once, and their staging tables.
    stg: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(max_workers=LAYER_THREADS) as pool:
        # The largest source first: jobs are served in the order they come.
        largest_first = sorted(sources.items(), key=lambda item: item[0] != "order_items")
        for done in [pool.submit(_stage, write, n, s, params) for n, s in largest_first]:
            stg |= done.result()
    first_orders = stg.pop(f"{FIRST}orders")
    raw = {n: stg.pop(f"{RAW}{n}") for n in sources}
    lap("staging")

    # Stage 2: star schema from the written staging tables, then its gates;
    # beside it the QA profile of the sources, which nothing waits for.
    w = Warehouse(sources, params, tables=stg)
    side = ThreadPoolExecutor(max_workers=LAYER_THREADS)
    profiled = [side.submit(_inspect, report, n, t) for n, t in raw.items()]
    profiled.append(side.submit(_account_orders, report, first_orders, params))
    star = write.layer(w.star_builders())
    declared = star_schemas(dict(stg["stg_orders"].dtypes)["order_id"])
    wrong = {n: m for n, t in star.items() if (m := schema_mismatches(t, declared[n]))}
    if wrong:
        raise QualityError(f"star tables differ from their declared types: {wrong}")
    w = Warehouse(sources, params, tables={**stg, **star})
    # One job for the gates: declared keys of the star, and from one scan of
    # the fact its references and the rows that find all their dimensions.
    pk = (w.primary_keys(include_raw=False)
          .select(F.lit("primary_key").alias("check"), "table_name",
                  (F.col("duplicate_keys") + F.col("null_key_rows")).alias("violations")))
    missing = F.lit(report.rows["fact_order_items"]) - F.col("joined_rows")
    parents = w.integrity().select(F.explode(F.array(
        F.struct(F.lit("foreign_key").alias("check"), F.concat_ws("->", "child_table", "parent_table").alias("table_name"),
                 F.col("orphan_rows").alias("violations")),
        F.struct(F.lit("star_join").alias("check"), F.col("child_table").alias("table_name"), missing.alias("violations"))))
        .alias("c")).select("c.*").distinct()
    profiled.append(side.submit(_account_items, report, stg))
    _gate(report, "star_keys", pk.unionByName(parents), lambda r: r["violations"])
    for done in profiled:
        done.result()
    side.shutdown()
    lap("star")

    # Stage 3: marts.
    marts = write.layer(w.mart_builders(), preview=preview_rows)
    w = Warehouse(sources, params, tables={**stg, **star, **marts})
    lap("marts")

    if answers:
        # Stages 4 and 5: the questions and chart tables (small; AQE sizes
        # their final stages, no forced file count).
        write.layer(w.answer_builders())
        lap("answers")
    # Last: the record that makes this folder a finished build.
    record = [(report.build_id, name, rows, report.buckets.get(name)) for name, rows in sorted(report.rows.items())]
    (spark.createDataFrame(record, RECORD_SCHEMA).coalesce(1).write.parquet(f"{report.out_dir}/{BUILD_RECORD}"))
    if root:
        builds.publish(spark, root, report.out_dir, keep)
    report.seconds["total"] = round(sum(report.seconds.values()), 3)
    return report


def land_csv(spark: SparkSession, sources: dict[str, DataFrame], out_dir: str | None = None) -> str:
    """Write source frames as the raw CSV files ``read_sources`` expects;
    returns their folder."""
    out_dir = out_dir or new_run_dir(spark, "raw")
    cores = spark.sparkContext.defaultParallelism
    for name, df in sources.items():
        df.repartition(cores).write.option("header", True).option("escape", '"').csv(f"{out_dir}/{SOURCES[name].file_name}")
    return out_dir


def land(spark: SparkSession, sources: dict[str, DataFrame], out_dir: str | None = None) -> dict[str, DataFrame]:
    """Write source frames once as Parquet files (a raw landing zone) and
    return readers over them: the form raw inputs have on a cluster."""
    report = RunReport(out_dir or new_run_dir(spark, "landing"))
    write = _Writer(spark, report.out_dir, report)
    # Spread round-robin: a source that arrives in one large split gives
    # readers parallel files.
    cores = spark.sparkContext.defaultParallelism
    return write.layer({name: (lambda df=df: df.repartition(cores)) for name, df in sources.items()})
