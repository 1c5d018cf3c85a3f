"""Seed domains from text files, from the caller or from any table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefacts import params, schemas
from sitefacts.functions import urls as U
from sitefacts.functions.common import strip


def read_seed_file(spark: SparkSession, path: str) -> DataFrame:
    """One domain per line; blank lines and lines that begin with ``#`` are left out."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    return lines.select(strip(F.col("value")).alias("domain")).where("domain != ''")


def given_seeds(spark: SparkSession, domains: Iterable[str] = params.DEFAULT_SEEDS) -> DataFrame:
    return clean_seeds(spark.createDataFrame([(d,) for d in domains], schemas.SEEDS), F.col("domain"))


def clean_seeds(table: DataFrame, domain: Column) -> DataFrame:
    """Seeds from a column of any table: trimmed, blanks left out, other columns kept."""
    others = [c for c in table.columns if c != "domain"]
    return table.select(*others, strip(domain).alias("domain")).where("domain != ''")


def normalized_seeds(seeds: DataFrame) -> DataFrame:
    """``(..., raw_domain, domain, root_url, company_name)``: the seed as given and what follows from it."""
    return (
        seeds.withColumnRenamed("domain", "raw_domain")
        .withColumn("domain", U.normalize_domain(F.col("raw_domain")))
        .withColumn("root_url", U.root_url(F.col("domain")))
        .withColumn("company_name", U.name_from_domain(F.col("domain")))
    )
