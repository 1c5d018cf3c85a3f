"""Running token and cost totals as calls arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitefacts.operators.costs import TOTALS, usage_costs

TOTAL_COST = "decimal(38,6)"


def running_totals(usage: DataFrame) -> DataFrame:
    """Totals per domain and model over a stream of calls.

    The price list is static, so calls join it within their task. The state is one row per domain and
    model; calls carry no time, so there is no watermark and totals never expire.
    """
    sums = [F.sum(c).alias(c) for c in TOTALS]
    cost = F.sum("cost_usd").cast(TOTAL_COST).alias("cost_usd")
    return usage_costs(usage).groupBy("domain", "model_name").agg(*sums, cost)


def start_totals(
    usage: DataFrame, sink: str, name: str, checkpoint: str | None = None, mode: str = "complete", **options
) -> StreamingQuery:
    """Run the totals over everything that has arrived so far, then stop.

    With a checkpoint folder that all nodes share, a later run goes on where this one ended.
    """
    writer = running_totals(usage).writeStream.format(sink).queryName(name).outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.options(**options).trigger(availableNow=True).start()


COLUMNS = f"domain string, model_name string, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint, cost_usd {TOTAL_COST}"
COMPACTED_EVERY = 10  # micro-batches


def stored_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Every row in the store: ``slot``, the micro-batch that made it, and the totals after that batch."""
    return spark.read.schema(f"slot string, batch bigint, {COLUMNS}").parquet(f"{folder}/state")


def latest_totals(stored: DataFrame) -> DataFrame:
    """The last totals of each domain and model, with the batch that made them."""
    last = F.max_by(F.struct("batch", *TOTALS, "cost_usd"), "batch").alias("t")
    return stored.groupBy("domain", "model_name").agg(last).select("t.batch", "domain", "model_name", *[f"t.{c}" for c in (*TOTALS, "cost_usd")])


def store_batch(changed: DataFrame, batch: int, folder: str, every: int) -> None:
    """Write the rows that a micro-batch changed, and after each ``every`` batches a snapshot of the last totals.

    The store has a slot for each batch of a round of ``every``, and two for snapshots, in turns; writing replaces a slot.
    A round's slots are written over only after its snapshot is complete, and that snapshot replaces the one before the last.
    So there is always a whole snapshot and all changes since, whenever a run ends, and a batch that runs again writes the
    same rows to the same slots. The store holds at most three rows for a key, and the rows of the batches of one round.
    """
    write = lambda rows, slot: rows.write.mode("overwrite").parquet(f"{folder}/state/slot={slot}")
    columns = [c for c in stored_totals(changed.sparkSession, folder).columns if c != "slot"]
    write(changed.withColumn("batch", F.lit(batch).cast("bigint")).select(*columns), f"change{batch % every}")
    if batch % every == every - 1:
        turn = batch // every % 2
        known = stored_totals(changed.sparkSession, folder).where(F.col("slot") != f"snapshot{turn}")
        write(latest_totals(known).select(*columns), f"snapshot{turn}")


def final_totals(usage: DataFrame, folder: str, every: int = COMPACTED_EVERY) -> DataFrame:
    """Totals once everything available has been read; a later run with the same folder goes on from there.

    Each micro-batch writes what it changed, see :func:`store_batch`; the last totals of every key count.
    """
    spark = usage.sparkSession
    # a slot without rows, so that there is a store to read if the source has none
    spark.createDataFrame([], f"batch bigint, {COLUMNS}").write.mode("overwrite").parquet(f"{folder}/state/slot=none")
    query = (
        running_totals(usage)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(lambda changed, batch: store_batch(changed, batch, folder, every))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return latest_totals(stored_totals(spark, folder)).drop("batch")
