"""Bronze (raw text) sources: S1 read_bronze, S2 read_typed, S3 land_csv,
S8 read_month, S9 read_file_slice, A2 rows_per_file.

Schemas are fixed (no inference).  Raw files are read with every column as
STRING; typing happens in silver with guarded casts.  CSV quoting follows the
writer of the landed files: ``"`` quotes, a doubled ``""`` inside quotes.  An
empty unquoted field is NULL here (the reference's reader gives an empty text);
an order by a text column therefore puts it last, not first.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.dq import RID, with_row_id
from tallyhouse.operators.warehouse import TYPED, typed

# Column lists of the raw feeds, in file order (all STRING in bronze).
RAW_COLUMNS = {t: list(cols) for t, cols in TYPED.items()}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


def _csv(spark: SparkSession, schema: T.StructType, sep: str = ",", corrupt_col: str | None = None):
    """``corrupt_col``: a column of ``schema`` for the text of lines with too many
    or too few fields; all columns are parsed then, as a line is judged whole."""
    if corrupt_col:
        return _csv(spark, schema, sep).option("columnNameOfCorruptRecord", corrupt_col).option("columnPruning", False)
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))


def read_bronze(spark: SparkSession, table: str, path: str, row_id: bool = True,
                multiline: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """All-STRING CSV scan of one raw table (header line skipped).

    Records are lines, as in the reference's CSV table definition (no line
    breaks inside quoted fields), which keeps large files splittable;
    ``multiline=True`` reads quoted line breaks at one task per file.
    ``row_id`` attaches ``_rid`` right on the scan (see dq.with_row_id).
    ``corrupt_col`` keeps the raw text of malformed lines (wrong field count)
    in that column (PERMISSIVE mode); well-formed lines have NULL there.
    """
    schema = raw_schema(table)
    r = _csv(spark, schema.add(corrupt_col, T.StringType()) if corrupt_col else schema, corrupt_col=corrupt_col)
    df = r.option("multiLine", multiline).csv(path)
    return with_row_id(df) if row_id else df


def read_typed(spark: SparkSession, table: str, path: str, corrupt_col: str | None = None) -> DataFrame:
    """The typed external table: declared types, unparsable text -> NULL."""
    return typed(read_bronze(spark, table, path, row_id=False, corrupt_col=corrupt_col), table)


def read_month(spark: SparkSession, table: str, base: str, run_month: str,
               row_id: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """One ``year=Y/month=M`` partition of a Hive-style partitioned raw table.

    Only that folder is named to the reader, so nothing else is listed; the
    partition columns come from its path below ``basePath``.
    """
    return read_months(spark, table, base, [run_month], row_id, corrupt_col)


def month_folder(base: str, run_month: str) -> str:
    y, m = (int(x) for x in run_month.split("-"))
    return f"{base.rstrip('/')}/year={y}/month={m}"


def read_months(spark: SparkSession, table: str, base: str, run_months: list[str],
                row_id: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """Several ``year=/month=`` partitions in one scan of their folders alone."""
    schema = raw_schema(table)
    if corrupt_col:
        schema = schema.add(corrupt_col, T.StringType())
    schema = schema.add("year", T.IntegerType()).add("month", T.IntegerType())
    df = _csv(spark, schema, corrupt_col=corrupt_col).option("basePath", base).csv([month_folder(base, m) for m in run_months])
    return with_row_id(df) if row_id else df


def read_delivery(spark: SparkSession, src: str, multiline: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """A delivered CSV with its own header, every column as text.  Line records
    keep large files splittable; ``multiline`` reads quoted line breaks (one task
    per file).  ``corrupt_col``: as in ``read_bronze``."""
    r = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
         .option("encoding", "UTF-8"))
    if not corrupt_col:
        return r.csv(src)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*r.csv(src).columns, corrupt_col]])   # the header alone
    return (r.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .option("columnPruning", False).csv(src))


def file_path_col() -> Column:
    return F.col("_metadata.file_path")


def as_uri(path: str) -> str:
    """File-path pseudo-column values are URIs; make a local path comparable."""
    return path if "://" in path or path.startswith("file:") else "file:" + os.path.abspath(path)


def read_file_slice(df: DataFrame, path: str) -> DataFrame:
    """Rows of one physical file (the ``"$path" = ...`` predicate).  Spark
    prunes the scan to that file from the metadata filter."""
    return df.where(file_path_col() == F.lit(as_uri(path)))


def rows_per_file(df: DataFrame) -> DataFrame:
    """A2: COUNT(*) per physical file."""
    return df.groupBy(file_path_col().alias("file_path")).agg(F.count(F.lit(1)).alias("n"))


def land_csv(spark: SparkSession, src: str, dst: str, mode: str = "errorifexists",
             multiline: bool = False) -> int:
    """S3: take a whole delivered CSV (UTF-8, bad bytes replaced, header kept)
    and rewrite it to bronze with the same header and columns.  Records are
    lines, so a large delivery is split; ``multiline=True`` reads quoted fields
    that span lines at one task per file.

    Returns the number of data rows written (counted while writing).
    """
    from pyspark.sql import Observation

    df = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
          .option("encoding", "UTF-8").option("inferSchema", False).csv(src))
    obs = Observation("landed")
    (df.observe(obs, F.count(F.lit(1)).alias("n"))
     .write.mode(mode).option("header", True).option("escape", '"').csv(dst))
    return int(obs.get["n"])


__all__ = ["RAW_COLUMNS", "RID", "raw_schema", "read_bronze", "read_typed", "read_month",
           "read_months", "read_delivery", "month_folder", "read_file_slice", "rows_per_file", "land_csv", "as_uri", "file_path_col"]
