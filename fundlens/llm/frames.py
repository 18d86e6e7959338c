"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm.batches import SPACES
from fundlens.session import shared_dir
from fundlens.sources.files import materialize

#: Java pattern of one separator between words.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared checkpoint location and
    read back: computed once, and a lost executor costs a re-read."""
    return materialize(df, shared_dir(df.sparkSession, name))


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def unspaced(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name, itself or a variant that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Let Spark hand Python at most ``rows`` rows of whole texts at once;
    with its default of 10,000 a batch of long texts fills the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
