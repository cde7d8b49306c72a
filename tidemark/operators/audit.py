"""Labels that come late: history, changes and the partitions they touch, restatement, reports, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.tables import latest


def latest_labels(history: DataFrame) -> DataFrame:
    """Of each transaction the label known last."""
    return latest(history, ["transaction_id"], [F.desc("knowledge_date"), F.desc("_recorded_at"), F.desc_nulls_last("is_fraud")], seldom=True)


def changed() -> Column:
    return ~F.col("old_is_fraud").eqNullSafe(F.col("new_is_fraud"))


def compared(labels: DataFrame, history: DataFrame, index: DataFrame, knowledge_date: Column, keep: Sequence[str] = ()) -> DataFrame:
    """All labels, with the columns keep of theirs, beside those known before and the day of the transaction; `changed` tells which of them differ.

    labels has one row per transaction. A label that was null or missing and still is makes no change. Transactions that the index
    doesn't know come as UNINDEXED, without a day: their labels must wait, outside history, until the index has them.
    """
    known = latest_labels(history).select("transaction_id", F.col("is_fraud").alias("old_is_fraud"))
    joined = labels.select("transaction_id", F.col("is_fraud").alias("new_is_fraud"), *keep).join(known, "transaction_id", "left")
    kind = F.when(F.col("old_is_fraud").isNull(), "NEW_LABEL").when(F.col("new_is_fraud").isNull(), "LABEL_CLEARED").otherwise("LABEL_CHANGED")
    days = index.select("transaction_id", "event_date", F.lit(True).alias("indexed"))
    out = joined.withColumns({"change_type": kind, "knowledge_date": knowledge_date}).join(days, "transaction_id", "left")
    out = out.withColumn("change_type", F.when(F.col("indexed"), F.col("change_type")).otherwise("UNINDEXED")).drop("indexed")
    return out.withColumn("change_id", F.concat_ws("-", F.col("transaction_id").cast("string"), F.col("knowledge_date").cast("string")))


def label_changes(labels: DataFrame, history: DataFrame, index: DataFrame, knowledge_date: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Labels that differ from those known before, with the day of the transaction: what has to be restated, and why."""
    return compared(labels, history, index, knowledge_date, keep).filter(changed())


def with_first_day(changes: DataFrame) -> DataFrame:
    """changes with first_day: whether a row is the first of its transaction, which the index may have on several days."""
    return changes.withColumn("first_day", F.lag(F.lit(1)).over(Window.partitionBy("transaction_id").orderBy("event_date")).isNull())


def pending(changes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Changes that can be applied and that no run has applied yet; running twice therefore applies none twice. Where the ledger has a status,
    rows of another one than APPLIED don't count."""
    done = ledger.filter("status = 'APPLIED'") if "status" in ledger.columns else ledger
    return changes.filter("change_type <> 'UNINDEXED'").join(done.select("change_id"), "change_id", "left_anti")


def restate(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """rows with the new labels over the old ones; a cleared label becomes null."""
    new = changes.filter("change_type <> 'UNINDEXED'").select("transaction_id", "new_is_fraud", "change_type")
    return relabelled(rows.join(new, "transaction_id", "left"))


def relabelled(joined: DataFrame) -> DataFrame:
    """Rows beside their change, if they have one, with its label."""
    return joined.withColumn("is_fraud", F.when(F.col("change_type").isNull(), F.col("is_fraud")).otherwise(F.col("new_is_fraud"))).drop("new_is_fraud", "change_type")


def affected(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """The days that a change touches, whole: only these are read, restated and written again."""
    return rows.join(changes.select("event_date").distinct(), "event_date", "left_semi")


def daily_report(rows: DataFrame) -> DataFrame:
    fraud = F.coalesce("is_fraud", F.lit(False))
    return rows.groupBy("event_date").agg(
        F.count_if(fraud).alias("fraud_txn_count"),
        F.coalesce(F.sum(F.when(fraud, F.col("amount"))), F.lit(0.0)).alias("fraud_amount_sum"),
        F.count("*").alias("total_txn_count"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_amount_sum"),
    )


def restatement_report(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Reports of the affected days before and after."""
    days = affected(rows, changes)
    return daily_report(days).withColumn("snapshot_type", F.lit("BEFORE")).unionByName(daily_report(restate(days, changes)).withColumn("snapshot_type", F.lit("AFTER")))


def reconcile(raw: DataFrame, accepted: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Per day: every raw row is a repeat of an id, accepted or quarantined; the rest is unexplained and must be 0. Rows without
    an id count as one id, as they do where the latest row of each id is taken."""
    per_id = raw.groupBy("event_date", "transaction_id").agg(F.count("*").alias("n"))
    repeats = F.sum(F.col("n") - 1)
    counts = per_id.groupBy("event_date").agg(F.sum("n").alias("raw_count"), repeats.alias("duplicate_count"))
    for name, df in (("accepted_count", accepted), ("quarantined_count", quarantined)):
        counts = counts.join(df.groupBy("event_date").agg(F.count("*").alias(name)), "event_date", "left")
    counts = counts.fillna(0, ["accepted_count", "quarantined_count"])
    rest = F.col("raw_count") - F.col("duplicate_count") - F.col("accepted_count") - F.col("quarantined_count")
    return counts.withColumn("unexplained_difference", rest).withColumn("invariant_ok", F.col("unexplained_difference") == 0)


def key_checks(df: DataFrame, name: str, key: str, accepted: dict[str, list] | None = None) -> DataFrame:
    """One row: rows, null keys, repeated keys, values outside the accepted ones."""
    odd = [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in (accepted or {}).items()]
    per = df.groupBy(key).agg(F.count("*").alias("n"), sum(odd, F.lit(0)).alias("odd"))
    null = F.col(key).isNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per.agg(F.lit(name).alias("table_name"), total("n").alias("n_rows"), total(F.when(null, F.col("n"))).alias("null_keys"), F.count_if(~null & (F.col("n") > 1)).alias("repeated_keys"), total("odd").alias("unaccepted"))
