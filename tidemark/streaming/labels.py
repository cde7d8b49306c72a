"""Late labels and user activity as streams; the batch operators do the work of each batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import jobs
from tidemark.operators.audit import changed, compared, with_first_day
from tidemark.plans.transactions import with_day
from tidemark.sources import writers
from tidemark.sources.lake import Lake


def activity(stream: DataFrame, late: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Counts and sums of each user in windows of event time; rows later than the watermark are left out, as state must end."""
    return stream.withWatermark("transaction_date", late).groupBy("user_id", F.window("transaction_date", width)).agg(F.count("*").alias("txn_count"), F.sum("amount").alias("amount_sum"))


RAW_LABELS = "transaction_id string, is_fraud string"
BATCHES = "batch long, labels long, changes long, days long, knowledge_date date"


def restate_late_labels(stream: DataFrame, lake: Lake, knowledge_date: date, checkpoint: str) -> StreamingQuery:
    """Raw labels (transaction_id, is_fraud) from a stream to restated tables: each batch is compared with the history, its changes go to manifest and history, the days that they
    touch are restated, and all of that is published together with the batch's number.

    A batch that comes again, after a failure anywhere, finds its number published and changes nothing, or finds nothing of it. Numbers are those of the query that the checkpoint
    belongs to: with another checkpoint, labels come again as new deliveries, of which those that are known change nothing. Labels of transactions that the index doesn't
    have wait in audit/waiting_labels, as many as there are, and come again with each later batch. The table audit/label_batches has a row for each batch.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with lake.change(spark) as change:
            mark = f"batch of {spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
            done = change.mark("audit", "label_batches", mark)
            if done is not None and done >= number:
                return
            waiting = change.read("audit", "waiting_labels", default=RAW_LABELS)
            now = jobs.labels_of(batch.select("transaction_id", "is_fraud").unionByName(waiting.join(batch, "transaction_id", "left_anti")))
            index = change.read("audit", "transaction_index")
            known, aside = change.read("audit", "label_history", default=jobs.HISTORY), writers.work_folder(spark)
            named = {"change_id": F.concat_ws("-", "change_id", F.lit(number)), "_detected_at": F.lit(knowledge_date).cast("timestamp"), "_batch_id": F.lit(f"stream-{number}")}
            # Labels are compared once; manifest, history and labels that wait come from what was found.
            seen = with_first_day(with_day(compared(now, known, index, F.lit(knowledge_date), ["is_fraud_raw"])).withColumn("changed", changed()))
            with writers.in_parts(spark):
                seen.write.parquet(aside)
            seen = spark.read.parquet(aside).withColumns(named)
            found = seen.filter("changed and change_type <> 'UNINDEXED'")
            got = change.append("audit", "impact_manifest", found.select(*[f.name for f in change.read("audit", "impact_manifest", default=jobs.MANIFEST).schema]), ["knowledge_date"], gathered=True)
            history = found.filter("first_day").select("transaction_id", F.col("new_is_fraud").alias("is_fraud"), "is_fraud_raw", F.lit(f"stream-{number}").alias("source_batch_id"), F.lit(knowledge_date).cast("timestamp").alias("_recorded_at"), F.lit(knowledge_date).alias("knowledge_date"))
            change.append("audit", "label_history", history, ["knowledge_date"], gathered=True)
            change.put("audit", "waiting_labels", seen.filter("change_type = 'UNINDEXED'").select("transaction_id", F.col("is_fraud_raw").alias("is_fraud")))
            writers.discard(spark, aside)
            done = jobs.restate(spark, lake, knowledge_date, f"stream-{number}", change=change)
            change.append("audit", "label_batches", batch.agg(F.count("*").alias("labels")).select(F.lit(number).cast("long").alias("batch"), "labels", F.lit(got["rows"]).cast("long").alias("changes"), F.lit(done["days"]).cast("long").alias("days"), F.lit(knowledge_date).alias("knowledge_date")))
            change.mark("audit", "label_batches", mark, number)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
