"""Readers for raw sources (A1-A3, B5).

CSV is read with a header and **no inference**: every field arrives as a
string, null tokens are mapped to null, then the registry's columns are
selected and cast *by name* (a reader schema would apply by position).
ANSI casts make a malformed number or timestamp fail the job.

With ``positions``, every row carries its place in the files (``POSITION``):
file, start of its block, and a number that rises through the block. It tells
which of two rows comes first in file order, whatever the splits, so "keep the
first row" means the same as reading the file from its top.

A line break within a quoted field is read with ``line_breaks``
(``quoted_lines``), which stores the lines first; without it such a record
fails the job.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import require_ansi
from salesmart.sources.quoted_lines import read_quoted_lines
from salesmart.sources.specs import SOURCES, SourceSpec

# The tokens the reference's CSV reader treats as missing
# (pandas' default ``na_values``), besides the empty field.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


POSITION = "__file_position"


def with_positions(raw: DataFrame) -> DataFrame:
    """``raw``, just read from files, with the place of each row. Rows of a
    block are read in order by one task, whose ids rise from row to row."""
    return raw.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                    F.monotonically_increasing_id().alias("row")).alias(POSITION))


def _null_tokens(name: str):
    c = F.col(f"`{name}`")
    return F.when(c.isin(*NA_TOKENS), F.lit(None)).otherwise(c)


def type_columns(raw: DataFrame, spec: SourceSpec, keep_extra: bool = True) -> DataFrame:
    """Select the registry's columns by name with their types; carry the rest."""
    missing = [c for c in spec.columns if c not in raw.columns]
    if missing:
        raise ValueError(f"source {spec.name!r} is missing columns {missing}; has {raw.columns}")
    typed = [_null_tokens(c).cast(t).alias(c) for c, t in spec.columns.items()]
    extra = [F.col(c) if c == POSITION else _null_tokens(c).alias(c) for c in raw.columns
             if c not in spec.columns and (keep_extra or c == POSITION)]
    return raw.select(*typed, *extra)


def read_source(spark: SparkSession, spec: SourceSpec, path: str, fmt: str = "csv", positions: bool = False,
                line_breaks: bool = False) -> DataFrame:
    """Read one raw source. Lazy, but for ``line_breaks``: no job runs here.

    CSV files are read splittable (``multiLine`` off), so one large file is
    spread over many tasks; with ``line_breaks`` too, and quoted fields may then
    hold line breaks. Raises ``FileNotFoundError`` with the path when
    it does not exist, and refuses a session whose casts would hide bad values.
    """
    require_ansi(spark)
    try:
        if fmt == "csv" and line_breaks:
            raw = read_quoted_lines(spark, path)
            return type_columns(raw.withColumnRenamed("place", POSITION) if positions else raw.drop("place"), spec)
        if fmt == "csv":
            # enforceSchema off: a file whose header differs from the first
            # one's fails instead of being read by position.
            raw = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
                   .option("mode", "FAILFAST").option("escape", '"').csv(path))
            return type_columns(with_positions(raw) if positions else raw, spec)
        raw = spark.read.format(fmt).load(path)
        raw = with_positions(raw) if positions else raw
        return raw.select(*[F.col(c).cast(t).alias(c) for c, t in spec.columns.items()],
                          *[c for c in raw.columns if c not in spec.columns])
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            raise FileNotFoundError(f"missing raw file for source {spec.name!r}: {path}") from err
        raise


def read_sources(spark: SparkSession, raw_dir: str, fmt: str = "csv",
                 specs: dict[str, SourceSpec] = SOURCES, line_breaks: Collection[str] = ()) -> dict[str, DataFrame]:
    """All registered sources from one folder, by their registry file names,
    with the position of every row; those named in ``line_breaks`` may hold
    line breaks in quoted fields."""
    unknown = set(line_breaks) - set(specs)
    if unknown:
        raise ValueError(f"no such source: {sorted(unknown)}")
    return {name: read_source(spark, spec, f"{raw_dir.rstrip('/')}/{spec.file_name}", fmt, positions=True,
                              line_breaks=name in line_breaks)
            for name, spec in specs.items()}
