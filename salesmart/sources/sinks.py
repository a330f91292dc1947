"""Table sink (A6, A10, A11, B4): create a Parquet table and count its rows
from the written files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class EmptyTableError(ValueError):
    """A table came out with no rows."""


@dataclass(frozen=True)
class Buckets:
    """Stored in ``n`` buckets of ``columns``; Spark keeps that with the table
    ``table`` of its catalog, whose files lie where they are written."""
    n: int
    columns: tuple[str, ...]
    table: str


def open_bucketed(spark: SparkSession, path: str, buckets: Buckets, schema: StructType) -> DataFrame:
    """A bucketed table from its files, in whatever session."""
    by = ", ".join(f"`{c}`" for c in buckets.columns)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{buckets.table}` ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets.n} BUCKETS LOCATION '{path}'")
    return spark.table(buckets.table)


def write_table(spark: SparkSession, df: DataFrame, path: str, *, name: str | None = None,
                partitions: int | None = None, require_rows: bool = True,
                buckets: Buckets | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` as Parquet to ``path``, which must not hold a table yet,
    and return the written table with its row count. The count is read from
    the files' footers, so a task that ran twice cannot change it;
    ``require_rows`` fails an empty result. ``partitions`` narrows a small
    result to that many files through a shuffle, so the stages computing it
    keep their parallelism (a ``coalesce`` would pull the whole upstream stage
    into that many tasks). With ``buckets``, rows already dealt by their columns
    into as many partitions give one file per bucket."""
    if buckets:
        (df.write.format("parquet").bucketBy(buckets.n, *buckets.columns).sortBy(*buckets.columns)
         .option("path", path).saveAsTable(buckets.table))
        table = spark.table(buckets.table)
        rows = spark.read.schema(df.schema).parquet(path).count()
    else:
        (df.repartition(partitions) if partitions else df).write.parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
        rows = table.count()
    if require_rows and rows == 0:
        raise EmptyTableError(f"{name or path} has 0 rows")
    return table, rows
