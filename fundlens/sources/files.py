"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer_schema: bool = False, **options) -> DataFrame:
    """CSV with a header line.  An explicit schema avoids the extra full
    pass that ``inferSchema`` costs; inference stays available."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_csv_checked(spark: SparkSession, path: str, bad: str = "_bad", multi_line: bool = True,
                     **options) -> DataFrame:
    """S1 with a channel for bad records: types inferred, and a column ``bad``
    that holds the whole text of a record whose number of fields is not the
    header's (its first fields are kept, the others null) and null for a good
    one.  Quoted fields may span lines (with ``multi_line``, for which a file is
    read by one task).  Inference is a pass of its own."""
    common = {"header": True, "escape": '"', "multiLine": multi_line, **options}
    schema = spark.read.options(**common).option("inferSchema", True).csv(path).schema
    return (spark.read.options(**common).schema(StructType([*schema.fields, StructField(bad, StringType())]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).csv(path))


def observed_write(df: DataFrame, path: str, metrics: dict, fmt: str = "parquet", mode: str = "overwrite",
                   **options) -> dict:
    """S5 with A7/P6: write a table and return ``metrics`` (name -> aggregate
    Column) of the rows written, counted by the write job itself."""
    seen = Observation()
    write_table(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), path, fmt, mode, **options)
    return seen.get


def read_lines(spark: SparkSession, path: str, line_sep: str | None = "\n") -> DataFrame:
    """A text file as one ``value`` row per line."""
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                single_file: bool = False, partition_by: Sequence[str] | None = None,
                **options) -> str:
    """Write a table.

    ``mode`` defaults to Spark's (fail if the target exists); "overwrite"
    replaces it.  ``single_file`` coalesces to one partition first - only
    meant for small, already aggregated results, since one task then writes
    everything; with ``partition_by`` it gives one file per partition value.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)
    return path


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` (a folder in the shared
    checkpoint location) and read it back: the lineage is cut, a later
    multi-pass use reads the table instead of recomputing it, and a lost
    executor costs a re-read, not a recomputation."""
    write_table(df, path, "parquet", mode="overwrite")
    return df.sparkSession.read.parquet(path)
