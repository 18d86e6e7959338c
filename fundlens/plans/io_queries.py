"""Source/sink round trips and the user-function path (step 8)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fundlens.functions.udfs import clean_currency_udf, identity_udf
from fundlens.operators import prepare as P
from fundlens.operators import words as W
from fundlens.operators.train import persisted
from fundlens.operators.votes import vote_tally
from fundlens.session import shared_dir
from fundlens.sources import campaigns, table, votes
from fundlens.sources.files import materialize, observed_write, read_csv, read_csv_checked, read_lines, write_table
from fundlens.sources.tables import spread
from fundlens.sources.views import VOTE_COLUMNS


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S5: write ``customer`` as CSV with a header, read it back with
    the schema pinned."""
    customer = table(spark, sf, "customer")
    path = write_table(customer, shared_dir(spark, "customer-csv"), "csv", mode="overwrite",
                       header=True)
    return read_csv(spark, path, schema=customer.schema)


def text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + text sink: documents written as lines, read back per line, and
    word-counted."""
    docs = table(spark, sf, "documents", ["text"])
    path = write_table(docs, shared_dir(spark, "documents-text"), "text", mode="overwrite")
    return W.word_count(read_lines(spark, path, "\n"), "value")


def single_file_export(spark: SparkSession, sf: str) -> DataFrame:
    """S6 + C2: the vote tally written as CSV, one file per rank (the
    reference writes one file per choice column), read back."""
    tally = vote_tally(votes(spark, sf), VOTE_COLUMNS)
    path = write_table(tally, shared_dir(spark, "votes-csv"), "csv", mode="overwrite",
                       single_file=True, partition_by=["choice_rank"], header=True)
    back = read_csv(spark, path, schema="sponsor string, count long")
    w = Window.partitionBy("choice_rank")
    return back.withColumn("files_in_rank",
                           F.size(F.collect_set(F.input_file_name()).over(w)))


def campaign_csv_prepare(spark: SparkSession, sf: str) -> DataFrame:
    """The preparation job end to end: the campaigns written as a CSV file
    with a header (the reference's input format), read back as text
    columns, prepared and written as Parquet (with the file's column name
    ``desc``), read back."""
    from fundlens.plans.jobs import CAMPAIGN_COLUMNS, campaign_schema, preprocess
    base = shared_dir(spark, "campaign-job")
    raw = campaigns(spark, sf).withColumnRenamed("descr", "desc").select(*CAMPAIGN_COLUMNS)
    csv = write_table(raw, os.path.join(base, "raw-csv"), "csv", mode="overwrite", header=True)
    return preprocess(spark, csv, os.path.join(base, "prepared"), schema=campaign_schema())


def udf_types(spark: SparkSession, sf: str) -> DataFrame:
    """U5 over a bigint and a double column with nulls (every seventh)."""
    events = table(spark, sf, "events", ["event_id", "value"])
    known = F.when(F.col("event_id") % 7 != 0, F.lit(True))
    events = events.select("event_id", F.when(known, F.col("event_id") + (1 << 53) + 1).alias("big"),
                           F.when(known, F.col("value")).alias("value"))
    return events.select("event_id", identity_udf("long")("big").alias("big"),
                         identity_udf("double")("value").alias("value"))


def udf_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The currency rule as an Arrow-batched, null-safe user function."""
    df = campaigns(spark, sf).transform(P.cast_campaigns)
    return df.select("project_id", "currency",
                     clean_currency_udf()(F.col("currency")).alias("currency2"))


def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as CSV with notes that hold quotes, commas and line
    breaks, beside broken records of one field (every fiftieth customer's key);
    read with inferred types, the broken ones told apart."""
    rows = table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_name"])
    good = rows.select("c_custkey", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"),
                       F.concat("c_name", F.lit(' says "yes, no"\nand more')).alias("note"))
    path = write_table(good, shared_dir(spark, "customers-csv"), "csv", mode="overwrite", header=True, escape='"',
                       ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    broken = rows.where("c_custkey % 50 = 0").select(F.col("c_custkey").cast("string").alias(",".join(good.columns)))
    # with another separator the header is no quoted field, and is right in whichever file is read first
    write_table(broken, path, "csv", mode="append", header=True, sep="\t")
    back = read_csv_checked(spark, path)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"),
                       F.col("c_nationkey").cast("long").alias("c_nationkey"),
                       F.col("c_acctbal").cast("double").alias("c_acctbal"), "note",
                       F.col("_bad").isNotNull().alias("broken"))


def prepare_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The preparation written as Parquet; rows, labels and filled cells
    are counted by the write itself."""
    prepared = campaigns(spark, sf).transform(P.prepare)
    counts = observed_write(prepared, shared_dir(spark, "prepared-observed"), {
        "n_rows": F.count(F.lit(1)), "n_successful": F.count_if(F.col("final_status") == 1),
        "currency2_filled": F.count_if(F.col("currency2") == "unknown"),
        "country2_filled": F.count_if(F.col("country2") == "unknown"),
        "goal_filled": F.count_if(F.col("goal") == -1)})
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def word_count_cached(spark: SparkSession, sf: str) -> DataFrame:
    """The words persisted, counted, and released again."""
    words = W.words(spread(table(spark, sf, "documents", ["doc_id", "text"]), "doc_id"), "text")
    with persisted(words) as cached:
        return materialize(cached.groupBy("word").count(), shared_dir(spark, "word-count"))
