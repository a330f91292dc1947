"""CSV whose quoted fields hold line breaks, read in splits (A1).

Whether a line begins inside a quoted field depends on all quotes before it in
its file, which a task that starts in the middle cannot know. The lines are
therefore read once, splittable, and stored with the parity of the quotes before
them *in their split*; the parities of whole splits, one row each, are summed
along the file, and say in which splits the stored parity has to be turned.
A record of one line is parsed where it lies. Only lines of records of several
are shuffled, to meet under the first line of their record.

Quotes follow RFC 4180: a field with quotes or line breaks is quoted, quotes
within it are doubled. Lines end with ``\\n`` or ``\\r\\n``; line breaks within a
field stay as they are. Blank lines between records are dropped. A file whose
quotes do not close fails, as do files whose headers differ and records with
more or fewer fields than the header.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.session import new_run_dir

_LINES = "file string, block long, row long, value string, odd boolean, before boolean, head boolean"


def _with_parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to every line whether its quotes are odd in number, whether those
    before it in its split are, and whether it is its file's header. The lines
    of a split come in order."""
    split, parity, headed = None, 0, False
    for batch in batches:
        file, block, row, value = batch.columns
        odd = pc.bit_wise_and(pc.count_substring(value, '"'), 1).to_numpy(zero_copy_only=False).astype(np.int64)
        blank = pc.equal(pc.utf8_trim_whitespace(value), "").to_numpy(zero_copy_only=False)
        before, head = np.zeros(len(odd), bool), np.zeros(len(odd), bool)
        files, blocks = file.dictionary_encode(), block.to_numpy(zero_copy_only=False)
        codes = files.indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(odd)]):
            if start == end:
                continue
            here = (files.dictionary[int(codes[start])].as_py(), int(blocks[start]))
            if here != split:
                split, parity, headed = here, 0, here[1] > 0
            total = parity + np.cumsum(odd[start:end])
            before[start:end] = (total - odd[start:end]) & 1
            parity = int(total[-1]) & 1
            if not headed and not blank[start:end].all():
                head[start + int(np.argmin(blank[start:end]))] = headed = True
        yield pa.RecordBatch.from_arrays(
            [file, block, row, value, pa.array(odd == 1), pa.array(before), pa.array(head)],
            ["file", "block", "row", "value", "odd", "before", "head"])


def _stored_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw text, opened once: what follows has to see the same splits."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")
    where = f"{new_run_dir(spark, 'csv-lines')}/lines"
    lines.mapInArrow(_with_parities, _LINES).write.parquet(where)
    return spark.read.schema(_LINES).parquet(where)


def _header(lines: DataFrame, path: str) -> list[str]:
    found = [r["value"] for r in lines.where("head").select(F.rtrim(F.col("value"), F.lit("\r")).alias("value"))
             .distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"files under {path} differ in their header: {found}")
    if not found:
        raise ValueError(f"no header under {path}: the files are empty")
    if found[0].count('"') % 2:
        raise ValueError(f"the header under {path} holds a line break")
    return [name or f"_c{i}" for i, name in enumerate(next(csv.reader(found)))]


def _open_splits(lines: DataFrame, path: str) -> DataFrame:
    """The splits that start inside a quoted field, with the first line of the
    record they start in: file, block, opened (block, row). The windows run over
    one row per split."""
    splits = lines.groupBy("file", "block").agg(
        F.pmod(F.count_if("odd"), F.lit(2)).alias("parity"),
        F.max(F.when(~F.col("before"), F.col("row"))).alias("closed_start"),
        F.max(F.when(F.col("before"), F.col("row"))).alias("open_start"))
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = splits.withColumn("open", F.pmod(F.coalesce(F.sum("parity").over(w), F.lit(0)), F.lit(2)) == 1)
    # The last record a split begins, should it begin any.
    last = F.when(F.col("open"), F.col("open_start")).otherwise(F.col("closed_start"))
    began = whole.withColumn("last", F.when(last.isNotNull(), F.struct("block", last.alias("row"))))
    unclosed = [r["file"] for r in splits.groupBy("file").agg((F.sum("parity") % 2).alias("odd")).where("odd = 1")
                .select("file").limit(3).collect()]
    if unclosed:
        raise ValueError(f"a quote is not closed in {unclosed}")
    return (began.withColumn("opened", F.last("last", ignorenulls=True).over(w)).where("open")
            .select("file", "block", "opened"))


def read_quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """The records of the CSV files under ``path``, all columns as strings, and
    ``place``: file, block and row of the line each begins with. Runs a job that
    stores the lines."""
    lines = _stored_lines(spark, path)
    names = _header(lines, path)
    opened = _open_splits(lines, path)
    placed = lines.join(opened, ["file", "block"], "left")
    begins = F.col("before") == F.col("opened").isNotNull()
    placed = placed.withColumn("begins", begins)
    place = F.struct("file", "block", "row")
    alone = F.col("begins") & ~F.col("odd")
    single = placed.where(alone).where("not head").select(place.alias("place"), "value")

    # Lines of a record that goes on: the record of a line is the last one
    # begun in its split, or else the one the split starts in. The shuffle and
    # window are by split, which bounds them.
    w = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col("begins"), F.struct("block", "row")), ignorenulls=True).over(w)
    first = F.coalesce(F.col("own"), F.col("opened"))
    pieces = (placed.where(~alone).withColumn("own", own)
              .select("file", first["block"].alias("first_block"), first["row"].alias("first_row"), "block", "row", "value"))
    several = (pieces.groupBy("file", "first_block", "first_row")
               .agg(F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("lines"))
               .select(F.struct("file", F.col("first_block").alias("block"), F.col("first_row").alias("row")).alias("place"),
                       F.array_join(F.col("lines")["value"], "\n").alias("value")))

    records = (single.unionByName(several).withColumn("value", F.rtrim(F.col("value"), F.lit("\r")))
               .where(F.trim("value") != ""))
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true"}
    return records.select("place", F.from_csv("value", schema, options).alias("record")).select("place", "record.*")
