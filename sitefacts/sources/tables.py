"""Captured pages, stored answers, hits and usage as tables, and the profile exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sitefacts import params, schemas
from sitefacts.operators.profiles import FIELDS, flat_profiles


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.PAGES)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.RESPONSES)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.HITS)


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.USAGE)


def write_json(profiles: DataFrame, path: str, mode: str = "error") -> None:
    """One profile per line with its nested fields; absent values are written as null."""
    profiles.select(*FIELDS).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_arrays(profiles: DataFrame, path: str, rows: int = 1000, mode: str = "error") -> None:
    """Files that each hold one JSON array of about ``rows`` profiles, dealt out by a hash of text and row.

    An array is one text in memory, which ``rows`` bounds, however often a profile repeats.
    """
    items = profiles.select(F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"}).alias("item"), F.monotonically_increasing_id().alias("row"))
    files = max(1, -(-profiles.count() // rows))
    dealt = items.groupBy(F.pmod(F.xxhash64("item", "row"), F.lit(files)).alias("file"))
    arrays = dealt.agg(F.array_join(F.sort_array(F.collect_list("item")), ",\n").alias("items"))
    arrays.select("file", F.concat(F.lit("[\n"), "items", F.lit("\n]")).alias("value")).write.mode(mode).partitionBy("file").text(path)


def read_json(spark: SparkSession, path: str, array_file: bool = False, bad_records: str | None = None) -> DataFrame:
    """Profiles back from lines, or from files that each hold one JSON array.

    ``bad_records`` names a column for the text of what is no profile; without it such rows have nulls only.
    """
    schema, reader = schemas.PROFILE, spark.read.option("multiLine", array_file)
    if bad_records:
        schema, reader = StructType([*schema.fields, StructField(bad_records, StringType())]), reader.option("columnNameOfCorruptRecord", bad_records)
    return reader.schema(schema).json(path).select(*schema.names)


CSV_OPTIONS = {"header": True, "escape": '"', "multiLine": True}
CSV_SCHEMA = (
    "domain string, company_name string, company_overview string, target_audience_icp string, "
    "contact_points string, key_leadership string, data_confidence_score double, "
    "confidence_reasoning string, total_tokens bigint, estimated_cost_usd string"
)


def write_csv(profiles: DataFrame, path: str, mode: str = "error") -> None:
    flat_profiles(profiles).write.mode(mode).options(**CSV_OPTIONS, emptyValue="").csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The flat export back. It has no nulls, so an empty field is an empty text."""
    return spark.read.schema(CSV_SCHEMA).options(**CSV_OPTIONS).csv(path).fillna("")


def spread_small(df: DataFrame) -> DataFrame:
    """Give a small input enough partitions for all cores before per-row work.

    A table of one or few row groups reads as one or few tasks. Inputs that already have a partition per
    core, as large ones do, pass unchanged and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def spread_text(df: DataFrame, text: str, size: int = params.TASK_BYTES) -> DataFrame:
    """Deal rows out anew, into partitions of about ``size`` bytes of text, if a partition holds more than that.

    Tasks then keep their length as the input grows. The number and size of files says little about that: a row group
    is never split, and repeated text is small in a file. The bytes are counted in a pass over the text.
    """
    held = df.select(F.spark_partition_id().alias("part"), F.octet_length(text).alias("bytes")).groupBy("part")
    total, most = held.agg(F.sum("bytes").alias("bytes")).agg(F.sum("bytes"), F.max("bytes")).first()
    return df if (most or 0) <= size else df.repartition(-(-total // size))


def spread_rows(df: DataFrame, rows: int = params.TASK_ROWS) -> DataFrame:
    """Deal short rows out, about ``rows`` to a partition, before each grows to several pages; so few pass unchanged."""
    count = df.count()
    return df if count <= rows else df.repartition(-(-count // rows))
