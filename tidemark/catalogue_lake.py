"""Queries over what the jobs leave on disk: a lake is filled from the driver's tables, the jobs run, their tables are read back and compared with SQL."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
import zipfile
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import date
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import catalogue, jobs, runs
from tidemark.catalogue import _LABEL, _LATER, _NUMBERS, _VALUE, _query
from tidemark.sources import catalog, readers, writers
from tidemark.sources.lake import Lake
from tidemark.sources.readers import table
from tidemark.streaming import labels as label_streams

KNOWN, LATER, TODAY = date(2024, 2, 1), date(2024, 3, 1), date(2024, 3, 2)
TRACKED = ["credit_band", "age_group", "yearly_income"]
#: Lakes by application, source, how far their jobs have run and the state of the source; filled once, since the jobs leave the same tables each time.
_LAKES: dict[tuple, Lake] = {}
_COUNTS: dict[str, dict] = {}


def raw_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    text = f"case when ({label}) then 'Yes' when not ({label}) then 'no' else 'unknown' end"
    return table(spark, sf_dir, "events").selectExpr("cast(event_id as string) as transaction_id", f"{text} as is_fraud")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as id", "cast(10 + c_custkey % 80 as string) as current_age", "'x' as birth_year", "cast(1 + c_custkey % 12 as string) as birth_month", "cast(c_custkey % 90 + 0.5 as string) as latitude",
        "concat('$', c_custkey * 10) as yearly_income", "cast(250 + c_custkey % 650 as string) as credit_score",
    )


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three cards for each customer, one in seven of them delivered again with another limit."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")).withColumn("id", F.col("c_custkey") * 10 + F.col("k"))
    c = c.withColumn("again", F.explode(F.when(F.col("c_custkey") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return c.selectExpr(
        "cast(id as string) as id", "cast(c_custkey as string) as client_id", "case when id % 2 = 0 then 'Visa' else 'Mastercard' end as card_brand", "'Debit' as card_type", "concat('4111-2222-3333-', lpad(cast(id % 10000 as string), 4, '0')) as card_number",
        "concat(1 + c_custkey % 12, '/2030') as expires", "'123' as cvv", "case when k = 0 then 'YES' else 'NO' end as has_chip", "concat('$', id + again * 1000) as credit_limit", "case when id % 50 = 0 then 'Yes' else 'No' end as card_on_dark_web",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, again) as _loaded_at",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.raw_transactions(spark, sf_dir, by_day=True).withColumn("_loaded_at", F.expr("timestamp'2024-02-01 00:00:00' + make_interval(0, 0, 0, again)"))


def _raw(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw transactions alone, as the lake has them too."""
    lake = Lake(writers.work_folder(spark))
    jobs.ingest(spark, lake, "transactions", raw_transactions(spark, sf_dir), KNOWN, "b1", jobs.transaction_days, gathered=True)
    return lake


def _base(spark: SparkSession, sf_dir: str) -> Lake:
    """All sources ingested, cleaned and enriched, and the index of what came of it."""
    lake, rows = Lake(writers.work_folder(spark)), raw_transactions(spark, sf_dir)
    codes = spark.range(6).selectExpr("cast(5000 + id as string) as mcc_code", "concat('Category ', id) as description")
    sources = {"transactions": rows, "fraud_labels": raw_labels(spark, sf_dir, _LABEL), "users": raw_users(spark, sf_dir), "cards": raw_cards(spark, sf_dir), "mcc_codes": codes}
    ingested = {r["table"]: r["rows"] for r in jobs.ingest_all(spark, lake, sources, KNOWN, "b1", gathered=["transactions", "cards"])}  # cards have two partitions
    jobs.clean_dimensions(spark, lake, KNOWN)
    cleaned, enriched = jobs.clean_and_enrich(spark, lake, KNOWN)
    _COUNTS[lake.root] = {"ingest": {"rows": ingested["transactions"]}, "clean": {k: cleaned[k] for k in ("rows", "accepted", "rejected")}, "enrich": enriched}
    jobs.build_index(spark, lake, KNOWN, "b1")
    return lake


def _story(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake in which labels became known later: baseline, delivery, detection, restatement; the last two run twice, as after a failure."""
    lake = _base(spark, sf_dir)
    jobs.detect(spark, lake, KNOWN, "b1")
    jobs.ingest(spark, lake, "fraud_labels", raw_labels(spark, sf_dir, _LATER), LATER, "b2")
    for _ in range(2):
        jobs.detect(spark, lake, LATER, "b2")
        jobs.restate(spark, lake, LATER, "b2")
    return lake


def _cleaned_again(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake, of which one day, the first, is cleaned once more after it was enriched, and all days are indexed after that: it stays as it was."""
    lake = lake_of(spark, sf_dir)
    jobs.clean(spark, lake, LATER, date(2024, 1, 1))
    jobs.build_index(spark, lake, LATER, "b2")
    return lake


def _streamed(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose later labels come as a stream of three batches of files, run a second time from its start."""
    lake, path = _base(spark, sf_dir), writers.work_folder(spark)
    jobs.detect(spark, lake, KNOWN, "b1")
    for part in range(3):
        raw_labels(spark, sf_dir, _LATER).filter(F.crc32("transaction_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{path}/in")
    for run in range(2):
        stream = spark.readStream.schema(label_streams.RAW_LABELS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        label_streams.restate_late_labels(stream, lake, LATER, f"{path}/checkpoint-{run}").awaitTermination()
    return lake


def _two_tiers(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw transactions of two months, the first of which has moved to the warm tier."""
    lake = Lake(writers.work_folder(spark))
    rows = _raw_rows(spark, sf_dir)
    february = rows.filter("day <= 3").withColumns({"month": F.lit(2), "id": F.concat("id", F.lit("-2"))})
    with lake.change(spark) as change:
        change.put("raw", "transactions", rows.unionByName(february), readers.DAY, gathered=True)  # a file of a day has rows of one day in february
    jobs.compact_month(spark, lake, "raw", "transactions", 2024, 1, "id", "client_id")
    return lake


def _age(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the files that lakes are filled from, so that a changed table fills a new lake."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet") for name in ("events", "customer")]
    found = [p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p) for p in paths]
    return tuple((s.getPath().toString(), s.getLen(), s.getModificationTime()) for statuses in found for s in statuses)


def _key(spark: SparkSession, sf_dir: str, fill) -> tuple:
    return spark.sparkContext.applicationId, sf_dir, fill.__name__, _age(spark, sf_dir)


def lake_of(spark: SparkSession, sf_dir: str, fill=_base) -> Lake:
    at = _key(spark, sf_dir, fill)
    if at not in _LAKES:
        _LAKES[at] = fill(spark, sf_dir)
    return _LAKES[at]


def _read(spark: SparkSession, sf_dir: str, zone: str, name: str, fill=_base) -> DataFrame:
    return lake_of(spark, sf_dir, fill).read(spark, zone, name)


def _raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions of the lake if it has been filled, else of one that has nothing else."""
    return _read(spark, sf_dir, "raw", "transactions", _base if _key(spark, sf_dir, _base) in _LAKES else _raw)


_GOOD = f"""{_NUMBERS}, good AS (SELECT event_id, CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, user_id * 10 + event_id % 3 AS card, ts, CAST(ts AS DATE) AS event_date, CAST({_VALUE} AS DOUBLE) AS amount,
 {_LABEL} AS is_fraud, {_LATER} AS later, user_id IN (SELECT c_custkey FROM customer) AS has_card FROM n WHERE event_id % 8 NOT IN (5, 6))"""
_DAY = "CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day"


@_query(f"""WITH {_GOOD} SELECT transaction_id, amount, is_fraud, CASE WHEN event_id % 7 = 6 THEN 'UNKNOWN' ELSE concat('Category ', event_id % 7) END AS mcc_description,
 CASE WHEN has_card THEN CASE WHEN card % 2 = 0 THEN 'Visa' ELSE 'Mastercard' END END AS card_brand, CASE WHEN has_card THEN card % 50 = 0 END AS card_on_dark_web, {_DAY} FROM good""")
def lake_transactions(spark, sf_dir):
    return _read(spark, sf_dir, "staging", "transactions").select("transaction_id", F.col("amount").cast("double").alias("amount"), "is_fraud", "mcc_description", "card_brand", "card_on_dark_web", "year", "month", "day")


@_query("SELECT CAST(event_id AS VARCHAR) AS transaction_id, CASE event_id % 8 WHEN 5 THEN 'INVALID' ELSE 'AMBIGUOUS' END AS amount_format, CAST(day(ts) AS INTEGER) AS day FROM events WHERE event_id % 8 IN (5, 6) AND event_id % 3 <> 0")
def lake_quarantine(spark, sf_dir):
    """After retention: what was resolved long ago has gone."""
    lake = Lake(writers.work_folder(spark))
    number = F.col("transaction_id").cast("long") % 3
    resolved = F.when(number == 0, F.lit(date(2024, 1, 1))).when(number == 1, F.lit(date(2024, 2, 25))).cast("timestamp")
    with lake.change(spark) as change:
        change.put("quarantine", "transactions", _read(spark, sf_dir, "quarantine", "transactions").withColumn("resolved_at", resolved), readers.DAY)
    jobs.vacuum_quarantine(spark, lake, TODAY)
    return lake.read(spark, "quarantine", "transactions").select("transaction_id", "amount_format", "day")


@_query(f"WITH {_GOOD} SELECT transaction_id, user_id, event_date, amount, is_fraud, {_DAY} FROM good", "event_date")
def lake_index(spark, sf_dir):
    return _read(spark, sf_dir, "audit", "transaction_index").drop("transaction_date", "_indexed_at", "_batch_id")


@_query(f"""WITH {_GOOD}, e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM good WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'),
 f AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) - 1 AS txn_count_last_7d, sum(amount) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) - amount AS s,
 avg(amount) OVER (PARTITION BY user_id ORDER BY sec, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a FROM e)
 SELECT transaction_id, txn_count_last_7d, round(s, 6) AS amount_sum_last_24h, round(CASE WHEN a > 0 THEN amount / a END, 6) AS amount_vs_user_avg_ratio, CAST(NULL AS INTEGER) AS risk_score FROM f WHERE event_date = DATE '2024-01-15'""")
def lake_features_of_a_day(spark, sf_dir):
    lake = lake_of(spark, sf_dir)
    jobs.build_features(spark, lake, date(2024, 1, 15))
    rounded = [F.round(c, 6).alias(c) for c in ("amount_sum_last_24h", "amount_vs_user_avg_ratio")]
    return lake.read(spark, "warehouse", "fraud_features", date(2024, 1, 15)).select("transaction_id", "txn_count_last_7d", *rounded, "risk_score")


@_query(catalogue.ORACLES["reconciliation"].split(" FROM (", 1)[1].removesuffix(")"), "event_date")
def lake_reconciliation(spark, sf_dir):
    return jobs.reconcile(spark, lake_of(spark, sf_dir)).drop(*readers.DAY)


@_query("SELECT CAST(event_id AS VARCHAR) AS transaction_id FROM events WHERE event_id % 8 NOT IN (5, 6) AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
def lake_days(spark, sf_dir):
    """Days of a partitioned table; other folders aren't read."""
    return lake_of(spark, sf_dir).read(spark, "staging", "transactions", date(2024, 1, 10), date(2024, 1, 12)).select("transaction_id")


@_query("""SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_custkey * 10.0 AS yearly_income, CAST(250 + c_custkey % 650 AS INTEGER) AS credit_score, 250 + c_custkey % 650 < 300 OR 250 + c_custkey % 650 > 850 AS credit_invalid, CAST(NULL AS INTEGER) AS birth_year,
 CAST(1 + c_custkey % 12 AS INTEGER) AS birth_month, c_custkey % 90 + 0.5::DOUBLE AS latitude FROM customer""")
def lake_users(spark, sf_dir):
    return _read(spark, sf_dir, "staging", "users").select("user_id", "yearly_income", "credit_score", "credit_invalid", "birth_year", "birth_month", "latitude")


@_query("""SELECT CAST(c_custkey * 10 + k AS VARCHAR) AS card_id, concat('XXXX-XXXX-XXXX-', lpad(CAST((c_custkey * 10 + k) % 10000 AS VARCHAR), 4, '0')) AS card_number, CAST(2030 AS INTEGER) AS expires_year, CAST(6 * 12 + c_custkey % 12 - 1 AS INTEGER) AS months_to_expiry,
 k = 0 AS has_chip, c_custkey * 10 + k + CASE WHEN c_custkey % 7 = 0 THEN 1000.0 ELSE 0 END AS credit_limit FROM customer, (SELECT unnest([0, 1, 2]) AS k)""")
def lake_cards(spark, sf_dir):
    """Of cards delivered twice the later row."""
    return _read(spark, sf_dir, "staging", "cards").select("card_id", "card_number", "expires_year", "months_to_expiry", "has_chip", "credit_limit")


@_query("""WITH s AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_custkey % 5 = 0 AS moved, c_custkey * 10.0 AS yearly_income FROM customer)
 SELECT user_id, yearly_income, DATE '2024-02-01' AS valid_from, CASE WHEN moved THEN DATE '2024-03-01' ELSE DATE '9999-12-31' END AS valid_to, NOT moved AS is_current FROM s
 UNION ALL SELECT user_id, yearly_income + 1, DATE '2024-03-01', DATE '9999-12-31', true FROM s WHERE moved""", "valid_from", "valid_to")
def lake_user_versions(spark, sf_dir):
    """Users as versions after two deliveries, the second one run twice."""
    lake, raw = Lake(writers.work_folder(spark)), raw_users(spark, sf_dir)
    raised = raw.withColumn("yearly_income", F.when(F.col("id").cast("long") % 5 == 0, F.concat(F.lit("$"), F.col("id").cast("long") * 10 + 1)).otherwise(F.col("yearly_income")))
    for name, rows in (("cards", raw_cards(spark, sf_dir)), ("mcc_codes", spark.sql("select '1' as mcc_code, 'x' as description"))):
        jobs.ingest(spark, lake, name, rows, KNOWN, "b1")
    for day, rows in ((KNOWN, raw), (LATER, raised), (LATER, raised)):
        jobs.ingest(spark, lake, "users", rows, day, str(day))
        jobs.clean_dimensions(spark, lake, day)
        jobs.dimensions(spark, lake, day, TRACKED)
    return lake.read(spark, "warehouse", "dim_users").select("user_id", "yearly_income", "valid_from", "valid_to", "is_current")


_CHANGED = f"""{_GOOD}, ch AS (SELECT *, CASE WHEN is_fraud IS NULL THEN 'NEW_LABEL' WHEN later IS NULL THEN 'LABEL_CLEARED' ELSE 'LABEL_CHANGED' END AS change_type FROM good WHERE is_fraud IS DISTINCT FROM later)"""


@_query(f"""WITH {_CHANGED} SELECT concat(transaction_id, '-2024-03-01') AS change_id, transaction_id, event_date, is_fraud AS old_is_fraud, later AS new_is_fraud, change_type FROM ch
 UNION ALL SELECT concat(event_id, '-2024-03-01'), CAST(event_id AS VARCHAR), NULL, {_LABEL}, {_LATER}, 'UNINDEXED' FROM events WHERE event_id % 8 IN (5, 6) AND ({_LABEL}) IS DISTINCT FROM ({_LATER})""", "event_date")
def lake_manifest(spark, sf_dir):
    """What the later labels change, those of quarantined transactions waiting as UNINDEXED."""
    return _read(spark, sf_dir, "audit", "impact_manifest", _story).select("change_id", "transaction_id", "event_date", "old_is_fraud", "new_is_fraud", "change_type")


@_query(f"""WITH {_CHANGED} SELECT CAST(event_id AS VARCHAR) AS transaction_id, {_LABEL} AS is_fraud, DATE '2024-02-01' AS knowledge_date FROM events
 UNION ALL SELECT transaction_id, later, DATE '2024-03-01' FROM ch""", "knowledge_date")
def lake_label_history(spark, sf_dir):
    return _read(spark, sf_dir, "audit", "label_history", _story).select("transaction_id", "is_fraud", "knowledge_date")


@_query(f"WITH {_GOOD} SELECT transaction_id, later AS is_fraud, amount, {_DAY} FROM good")
def lake_restated(spark, sf_dir):
    return _read(spark, sf_dir, "staging", "transactions", _story).select("transaction_id", "is_fraud", F.col("amount").cast("double").alias("amount"), "year", "month", "day")


@_query(f"WITH {_GOOD} SELECT transaction_id, later AS is_fraud FROM good")
def lake_restated_index(spark, sf_dir):
    return _read(spark, sf_dir, "audit", "transaction_index", _story).select("transaction_id", "is_fraud")


@_query(f"""WITH {_CHANGED}, b AS (SELECT event_date, amount, is_fraud AS f, 'BEFORE' AS snapshot_type FROM good UNION ALL SELECT event_date, amount, later, 'AFTER' FROM good)
 SELECT event_date AS report_date, snapshot_type, count(*) FILTER (f) AS fraud_txn_count, round(coalesce(sum(amount) FILTER (f), 0), 6) AS fraud_amount_sum, count(*) AS total_txn_count, round(sum(amount), 6) AS total_amount_sum
 FROM b WHERE event_date IN (SELECT event_date FROM ch) GROUP BY ALL""", "report_date")
def lake_snapshots(spark, sf_dir):
    rows = _read(spark, sf_dir, "audit", "report_snapshots", _story)
    return rows.select("report_date", "snapshot_type", "fraud_txn_count", F.round("fraud_amount_sum", 6).alias("fraud_amount_sum"), "total_txn_count", F.round("total_amount_sum", 6).alias("total_amount_sum"))


@_query(f"WITH {_CHANGED} SELECT concat(transaction_id, '-2024-03-01') AS change_id, 'APPLIED' AS status, CAST(event_date AS VARCHAR) AS partitions_touched FROM ch")
def lake_ledger(spark, sf_dir):
    """Each change once, although detection and restatement ran twice."""
    return _read(spark, sf_dir, "audit", "applied_ledger", _story).select("change_id", "status", "partitions_touched")


@_query("SELECT CAST(event_id AS VARCHAR) AS id, CAST(day(ts) AS INTEGER) AS day, 'warm' AS tier FROM events WHERE ts < TIMESTAMP '2024-02-01' UNION ALL SELECT CAST(event_id AS VARCHAR), 7, 'hot' FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-07'")
def lake_compacted(spark, sf_dir):
    """A day compacted in place and a month in the warm tier, each id once."""
    lake = Lake(writers.work_folder(spark))
    with lake.change(spark) as change:
        change.append("raw", "transactions", _raw_rows(spark, sf_dir), readers.DAY, gathered=True)
    jobs.compact_day(spark, lake, "raw", "transactions", date(2024, 1, 7), "id", "client_id")
    jobs.compact_month(spark, lake, "raw", "transactions", 2024, 1, "id", "client_id", move=False)
    warm, hot = lake.read(spark, "warm", "transactions"), lake.read(spark, "raw", "transactions", date(2024, 1, 7))
    return warm.select("id", "day", F.lit("warm").alias("tier")).unionByName(hot.select("id", "day", F.lit("hot").alias("tier")))


@_query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN concat('a,\"', c_mktsegment) END AS note FROM customer")
def csv_rows(spark, sf_dir):
    """Text columns through CSV: quotes and commas come back, empty fields are null."""
    path = writers.work_folder(spark)
    rows = table(spark, sf_dir, "customer").selectExpr("cast(c_custkey as string) as id", "c_name as name", "case when c_custkey % 3 <> 0 then concat('a,\"', c_mktsegment) end as note")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return readers.csv(spark, path, ["id", "name", "note"])


@_query("SELECT 'events' AS table_name, count(*) AS n FROM events UNION ALL SELECT 'raw', count(*) + count(*) FILTER (event_id % 10 = 0) FROM events UNION ALL SELECT 'staging', count(*) FILTER (event_id % 8 NOT IN (5, 6)) FROM events UNION ALL SELECT 'quarantine', count(*) FILTER (event_id % 8 IN (5, 6)) FROM events")
def union_counts(spark, sf_dir):
    parts = {"events": table(spark, sf_dir, "events"), "raw": _read(spark, sf_dir, "raw", "transactions"), "staging": _read(spark, sf_dir, "staging", "transactions"), "quarantine": _read(spark, sf_dir, "quarantine", "transactions")}
    out = None
    for name, rows in parts.items():
        count = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = count if out is None else out.unionByName(count)
    return out


@_query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS is_fraud, event_id % 4 = 0 AS yes FROM events WHERE event_id % 4 < 3 UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 4 = 3")
def label_texts(spark, sf_dir):
    from tidemark.functions import cleaning as C

    text = table(spark, sf_dir, "events").selectExpr("event_id", "case event_id % 4 when 0 then 'yEs' when 1 then 'NO' when 2 then 'maybe' end as t")
    return text.select("event_id", C.yes_or_no(F.col("t")).alias("is_fraud"), C.yes(F.col("t")).alias("yes"))


@_query(f"WITH {_GOOD} SELECT transaction_id, is_fraud FROM good")
def lake_cleaned_again(spark, sf_dir):
    """All labels are there although a day was cleaned after enrichment."""
    return _read(spark, sf_dir, "audit", "transaction_index", _cleaned_again).select("transaction_id", "is_fraud")


@_query(f"WITH {_GOOD} SELECT transaction_id, later AS is_fraud, amount FROM good")
def stream_restated(spark, sf_dir):
    """Late labels from files through a stream: what the batch job leaves."""
    return _read(spark, sf_dir, "staging", "transactions", _streamed).select("transaction_id", "is_fraud", F.col("amount").cast("double").alias("amount"))


@_query(f"""WITH {_CHANGED} SELECT transaction_id, is_fraud AS old_is_fraud, later AS new_is_fraud, change_type FROM ch""")
def stream_changes(spark, sf_dir):
    """Each change once in the manifest, although the stream ran twice."""
    return _read(spark, sf_dir, "audit", "impact_manifest", _streamed).select("transaction_id", "old_is_fraud", "new_is_fraud", "change_type")


@_query("""SELECT CAST(event_id AS VARCHAR) AS id, CAST(1 AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-31'
 UNION ALL SELECT concat(event_id, '-2'), CAST(2 AS INTEGER), CAST(day(ts) AS INTEGER) FROM events, (SELECT unnest([0, 1]) AS again) WHERE day(ts) <= 2 AND (again = 0 OR event_id % 10 = 0)""")
def lake_tiers(spark, sf_dir):
    """Days over both tiers, the hot days of the first month gone: each row once."""
    return jobs.tiers(spark, lake_of(spark, sf_dir, _two_tiers), "raw", "transactions", date(2024, 1, 2), date(2024, 2, 2)).select("id", "month", "day")


@_query("SELECT event_id, ts AS at, value FROM events WHERE event_id % 3 <> 2 OR event_id % 2 = 0")
def append_by_mark(spark, sf_dir):
    """Three batches in order of time, the middle one delivered twice: rows above the mark, each once."""
    lake = Lake(writers.work_folder(spark))
    rows = table(spark, sf_dir, "events").filter("event_id % 3 <> 2 or event_id % 2 = 0").select("event_id", F.col("ts").alias("at"), "value")
    ends = [date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21), date(2024, 12, 31)]
    for k in (0, 1, 1, 2):
        jobs.append_batch(spark, lake, "warehouse", "events", rows.filter((F.col("at") >= F.lit(ends[k])) & (F.col("at") < F.lit(ends[k + 1]))), "at", "event_id")
    return lake.read(spark, "warehouse", "events")


@_query("""SELECT 'ingest' AS job, 'rows' AS what, count(*) + count(*) FILTER (event_id % 10 = 0) AS n FROM events UNION ALL SELECT 'clean', 'rows', count(*) FROM events
 UNION ALL SELECT 'clean', 'accepted', count(*) FILTER (event_id % 8 NOT IN (5, 6)) FROM events UNION ALL SELECT 'clean', 'rejected', count(*) FILTER (event_id % 8 IN (5, 6)) FROM events
 UNION ALL SELECT 'enrich', 'rows', count(*) FROM events WHERE event_id % 8 NOT IN (5, 6) UNION ALL SELECT 'enrich', 'with_label', count(*) FROM events WHERE event_id % 8 NOT IN (5, 6) AND event_id % 7 <> 1
 UNION ALL SELECT 'enrich', 'with_category', count(*) FROM events WHERE event_id % 8 NOT IN (5, 6) AND event_id % 7 <> 6 UNION ALL SELECT 'enrich', 'with_card', count(*) FROM events WHERE event_id % 8 NOT IN (5, 6) AND user_id IN (SELECT c_custkey FROM customer)""")
def job_counts(spark, sf_dir):
    """What jobs say of their rows, counted while they write: rows, accepted and rejected ones, those that found a label, a category, a card."""
    lake = lake_of(spark, sf_dir, _base)
    return spark.createDataFrame([(job, what, n) for job, counts in _COUNTS[lake.root].items() for what, n in counts.items()], "job string, what string, n long")


@_query(f"WITH {_GOOD} SELECT transaction_id, amount, is_fraud, CAST(day(event_date) AS INTEGER) AS day FROM good WHERE day(event_date) <> 5 AND day(event_date) <= 9 UNION ALL SELECT concat(transaction_id, 'x'), amount, is_fraud, 9 FROM good WHERE day(event_date) = 5")
def catalogued(spark, sf_dir):
    """By SQL alone: an external table, days that were written behind the catalogue's back and found by repair, one day put in place of another by INSERT OVERWRITE, a day dropped."""
    path, name, source = writers.work_folder(spark), f"days_{uuid.uuid4().hex}", f"staged_{uuid.uuid4().hex}"
    rows = _read(spark, sf_dir, "staging", "transactions").select("transaction_id", F.col("amount").cast("double").alias("amount"), "is_fraud", "year", "month", "day").filter("day <= 10")
    catalog.published_table(spark, lake_of(spark, sf_dir), "staging", "transactions", source)
    catalog.external_table(spark, name, path, rows.schema, readers.DAY)
    rows.write.partitionBy(*readers.DAY).mode("append").parquet(path)
    catalog.repair(spark, name)
    spark.sql(f"INSERT OVERWRITE {name} PARTITION (year = 2024, month = 1, day = 9) SELECT concat(transaction_id, 'x'), CAST(amount AS double), is_fraud FROM {source} WHERE day = 5")
    rows.filter("day = 9").write.partitionBy(*readers.DAY).mode("append").parquet(path)
    catalog.repair(spark, name)
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (year = 2024, month = 1, day = 5)")
    return spark.sql(f"SELECT transaction_id, amount, is_fraud, day FROM {name} WHERE day <= 9")


@_query(f"WITH {_GOOD} SELECT transaction_id, amount, is_fraud FROM good WHERE day(event_date) BETWEEN 3 AND 5")
def catalogued_lake(spark, sf_dir):
    """A published table of the lake through the catalogue, some days by SQL."""
    name = f"staged_{uuid.uuid4().hex}"
    catalog.published_table(spark, lake_of(spark, sf_dir), "staging", "transactions", name)
    return spark.sql(f"SELECT transaction_id, CAST(amount AS double) AS amount, is_fraud FROM {name} WHERE day BETWEEN 3 AND 5")


def bucketed(spark: SparkSession, sf_dir: str, buckets: int = 16) -> DataFrame:
    path, run = writers.work_folder(spark), uuid.uuid4().hex
    events = table(spark, sf_dir, "events").selectExpr("cast(event_id as string) as transaction_id", "user_id", "value as amount")
    catalog.bucketed_table(events, f"bucketed_events_{run}", "transaction_id", buckets, f"{path}/events")
    catalog.bucketed_table(jobs.labels_of(raw_labels(spark, sf_dir, _LABEL)).filter("is_fraud is not null"), f"bucketed_labels_{run}", "transaction_id", buckets, f"{path}/labels")
    return spark.table(f"bucketed_events_{run}").join(spark.table(f"bucketed_labels_{run}").hint("merge"), "transaction_id", "left").select("transaction_id", "user_id", "amount", "is_fraud")


@_query(f"SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id, value AS amount, {_LABEL} AS is_fraud FROM events")
def bucketed_labels(spark, sf_dir):
    """Transactions and labels as bucketed tables, joined without an exchange."""
    return bucketed(spark, sf_dir)


@_query("SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(250 + c_custkey % 650 AS INTEGER) AS credit_score, c_custkey * 10.0 AS yearly_income FROM customer WHERE 250 + c_custkey % 650 BETWEEN 300 AND 850")
def view_valid_users(spark, sf_dir):
    catalog.views(spark, lake_of(spark, sf_dir))
    return spark.sql("SELECT user_id, credit_score, yearly_income FROM valid_users")


@_query(f"WITH {_CHANGED} SELECT transaction_id, event_date, change_type, later AS new_is_fraud FROM ch", "event_date")
def view_label_impact(spark, sf_dir):
    catalog.views(spark, lake_of(spark, sf_dir, _story))
    return spark.sql("SELECT transaction_id, event_date, change_type, new_is_fraud FROM label_impact")


@_query(f"""WITH {_CHANGED} SELECT event_date AS report_date, count(*) FILTER (is_fraud) AS fraud_before, count(*) FILTER (later) AS fraud_after, count(*) AS total_txn_count,
 round(coalesce(sum(amount) FILTER (later), 0) - coalesce(sum(amount) FILTER (is_fraud), 0), 6) AS fraud_amount_change FROM good WHERE event_date IN (SELECT event_date FROM ch) GROUP BY 1""", "report_date")
def view_restatement_report(spark, sf_dir):
    catalog.views(spark, lake_of(spark, sf_dir, _story))
    return spark.sql("SELECT report_date, fraud_before, fraud_after, total_txn_count, round(fraud_amount_change, 6) AS fraud_amount_change FROM restatement_report")


#: Derby comes with Spark; it lacks REPLACE, which is declared here by a function that Spark has on its path.
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
_REPLACE = """CREATE FUNCTION REPLACE(A VARCHAR(20), B VARCHAR(20), C VARCHAR(20)) RETURNS VARCHAR(20) PARAMETER STYLE JAVA NO SQL LANGUAGE JAVA EXTERNAL NAME 'org.apache.commons.lang3.StringUtils.replace'"""


#: Tables at most that the rows of one are filled into, all at once; a view makes one of them.
PARTS = 16


def _together(parts: list[str]) -> str:
    """All rows of tables, by a union as shallow as can be, since each row passes all unions above its table."""
    if len(parts) == 1:
        return f"SELECT * FROM {parts[0]}"
    half = len(parts) // 2
    return f"SELECT * FROM ({_together(parts[:half])}) a UNION ALL SELECT * FROM ({_together(parts[half:])}) b"


def derby(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    """A database with these tables, all columns text: a source to read over JDBC. The driver fills it and packs it into an archive in the folder that the driver and all executors share,
    from which any number of processes read it, whereas a Derby database in memory or in a folder belongs to one process. The folder has to be one that files are opened in by name.
    Each file of rows goes to a table of its own, by a connection of its own: an empty table is loaded without being logged row by row."""
    shared, aside = writers.work_folder(spark), tempfile.mkdtemp(prefix="spark-")
    local = re.sub("^file:/*", "/", shared)
    if not local.startswith("/"):
        raise ValueError(f"Derby opens files of this machine alone, not {shared}")
    url, connect = f"jdbc:derby:{aside}/source", spark._jvm.java.sql.DriverManager.getConnection
    connection = connect(f"{url};create=true")
    run = lambda sql: connection.createStatement().execute(sql)
    run(_REPLACE)
    # All tables are there before the first is loaded, so that none waits for a lock on the database's catalogue.
    for name, rows in tables.items():
        for k in range(PARTS):
            run(f"CREATE TABLE {name}__{k} ({', '.join(f'"{c}" VARCHAR(100)' for c in rows.columns)})")

    def load(part: str, file: Path) -> None:
        own = connect(url)
        own.createStatement().execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(null, '{part.upper()}', '{file}', null, null, 'UTF-8', 0)")
        own.close()
        file.unlink()

    loads: dict[str, list[Future]] = {}
    with ThreadPoolExecutor(os.cpu_count()) as pool:
        for name, rows in tables.items():
            rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns]).coalesce(PARTS).write.option("escape", '"').csv(f"{shared}/{name}")
            loads[name] = [pool.submit(load, f"{name}__{k}", file) for k, file in enumerate(sorted(Path(local, name).glob("part-*")))]
    for name, parts in loads.items():
        for part in parts:
            part.result()
        run(f"CREATE VIEW {name} AS {_together([f'{name}__{k}' for k in range(max(1, len(parts)))])}")
        writers.discard(spark, f"{shared}/{name}")
    connection.close()
    try:
        connect(f"{url};shutdown=true")
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # that it was shut down
            raise
    Path(local).mkdir(parents=True, exist_ok=True)
    # Pages are read where they lie, so that none is packed.
    with zipfile.ZipFile(f"{local}/source.jar", "w", zipfile.ZIP_STORED) as jar:
        for file in sorted(Path(aside, "source").rglob("*")):
            if file.is_file() and file.suffix != ".lck":
                with open(file, "rb") as pages, jar.open(zipfile.ZipInfo.from_file(file, file.relative_to(aside)), "w") as packed:
                    shutil.copyfileobj(pages, packed, 1 << 20)
    shutil.rmtree(aside)
    return f"jdbc:derby:jar:({local}/source.jar)source"


def _over_jdbc(spark: SparkSession, sf_dir: str) -> Lake:
    """All five sources read over JDBC, with as many connections as each has, into the raw zone."""
    lake = Lake(writers.work_folder(spark))
    rows = readers.raw_transactions(spark, sf_dir).drop("again")
    codes = spark.range(6).selectExpr("cast(5000 + id as string) as mcc_code", "concat('Category ', id) as description")
    # Most ids lie close together, a few far off.
    far = F.when(F.col("id").cast("long") % 50 == 0, F.concat("id", F.lit("00000000"))).otherwise(F.col("id")).alias("id")
    sources = {"transactions": rows.withColumn("id", far), "fraud_labels": raw_labels(spark, sf_dir, _LABEL), "users": raw_users(spark, sf_dir), "cards": raw_cards(spark, sf_dir).drop("_loaded_at"), "mcc_codes": codes}
    # Customers are a small file, of which many cards are made.
    sources |= {name: sources[name].repartition(spark.sparkContext.defaultParallelism) for name in ("users", "cards")}
    url = derby(spark, sources)
    read, seen = jobs.jdbc_sources(spark, url, DERBY), Observation()
    # Counted as they are ingested: to read them for that alone would be another eight scans of the source.
    ranges = {f"range_{k}": F.count_if(F.col("__range") == k) for k in range(readers.CONNECTIONS["transactions"])}
    counted = read["transactions"].withColumn("__range", F.spark_partition_id()).observe(seen, *[n.alias(k) for k, n in ranges.items()]).drop("__range")
    jobs.ingest_all(spark, lake, read | {"transactions": counted}, KNOWN, "b1")
    _RANGES[lake.root] = [n for n in seen.get.values() if n]
    return lake


_RANGES: dict[str, list[int]] = {}


@_query("""SELECT 'transactions' AS table_name, count(*) + count(*) FILTER (event_id % 10 = 0) AS n, 8 AS ranges, true AS even, false AS has_cvv FROM events UNION ALL SELECT 'fraud_labels', count(*), 8, true, false FROM events
 UNION ALL SELECT 'users', count(*), 8, true, false FROM customer UNION ALL SELECT 'cards', 3 * (count(*) + count(*) FILTER (c_custkey % 7 = 0)), 8, true, false FROM customer UNION ALL SELECT 'mcc_codes', 6, 8, true, false""")
def jdbc_tables(spark, sf_dir):
    """Rows of the five sources that came over JDBC; ranges of transactions hold rows within a factor of two of each other, though their ids are skewed; card verification numbers didn't enter."""
    lake = lake_of(spark, sf_dir, _over_jdbc)
    ranges, out = _RANGES[lake.root], None
    for name in jobs.SOURCES:
        rows = lake.read(spark, "raw", name)
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n", F.lit(len(ranges)).alias("ranges"), F.lit(max(ranges) <= 2 * min(ranges)).alias("even"), F.lit("cvv" in rows.columns).alias("has_cvv"))
        out = one if out is None else out.unionByName(one)
    return out


@_query("SELECT event_id % 10 = 0 AS twice, CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 50 = 0 THEN concat(event_id, '00000000') ELSE CAST(event_id AS VARCHAR) END AS far, CAST(user_id AS VARCHAR) AS client_id FROM events, (SELECT unnest([0, 1]) AS again) WHERE again = 0 OR event_id % 10 = 0")
def jdbc_transactions(spark, sf_dir):
    rows = lake_of(spark, sf_dir, _over_jdbc).read(spark, "raw", "transactions")
    number = F.when(F.col("id").endswith("00000000") & (F.length("id") > 8), F.expr("substring(id, 1, length(id) - 8)")).otherwise(F.col("id"))
    return rows.select((number.cast("long") % 10 == 0).alias("twice"), number.alias("id"), F.col("id").alias("far"), "client_id")


def _with_story(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake, on which the story is told twice; each time it puts the label back."""
    lake = lake_of(spark, sf_dir)
    _STORIES[lake.root] = [runs.late_label_story(spark, lake, day) for day in (LATER, TODAY)]
    return lake


_STORIES: dict[str, list[dict]] = {}


@_query(f"""WITH {_GOOD}, v AS (SELECT transaction_id, event_date, amount FROM good WHERE is_fraud IS DISTINCT FROM true ORDER BY transaction_id LIMIT 1),
 d AS (SELECT count(*) AS total, count(*) FILTER (is_fraud) AS fraud, coalesce(sum(amount) FILTER (is_fraud), 0) AS sum FROM good WHERE event_date = (SELECT event_date FROM v))
 SELECT transaction_id, CAST(event_date AS VARCHAR) AS event_date, unnest(['2024-03-01', '2024-03-02']) AS knowledge_date, total AS total_txn, fraud AS fraud_txn_before, round(sum, 2) AS fraud_amount_before, fraud + 1 AS fraud_txn_after,
 round(sum + amount, 2) AS fraud_amount_after, CAST(1 AS BIGINT) AS fraud_txn_delta, round(round(sum + amount, 2) - round(sum, 2), 2) AS fraud_amount_delta, CAST(1 AS BIGINT) AS partitions_restated, CAST(1 AS BIGINT) AS changes_applied,
 CAST(0 AS BIGINT) AS unexplained_difference, true AS invariant_ok, fraud AS restored_fraud_txn FROM v, d""")
def late_label_story(spark, sf_dir):
    """A late label from delivery to restated reports and back, told twice."""
    lake = lake_of(spark, sf_dir, _with_story)
    schema = "transaction_id string, event_date string, knowledge_date string, total_txn long, fraud_txn_before long, fraud_amount_before double, fraud_txn_after long, fraud_amount_after double, fraud_txn_delta long, fraud_amount_delta double, partitions_restated long, changes_applied long, unexplained_difference long, invariant_ok boolean, restored_fraud_txn long"
    return spark.createDataFrame([tuple(s.values()) for s in _STORIES[lake.root]], schema)


@_query("""SELECT CAST(1 + c_custkey % 12 AS INTEGER) AS month, CAST(NULL AS INTEGER) AS year, CAST(NULL AS VARCHAR) AS brand, count(*) AS n FROM customer GROUP BY 1
 UNION ALL SELECT NULL, 2030, CASE WHEN (c_custkey * 10 + k) % 2 = 0 THEN 'visa' ELSE 'mastercard' END, count(*) FROM customer JOIN (SELECT unnest([0, 1, 2]) AS k) ON true JOIN (SELECT unnest([0, 1]) AS again) ON again = 0 OR c_custkey % 7 = 0 GROUP BY 3""")
def lake_partition_keys(spark, sf_dir):
    """Rows of each partition of raw users (month of birth; the years are no numbers) and raw cards (brand, year of expiry)."""
    users, cards = (_read(spark, sf_dir, "raw", name) for name in ("users", "cards"))
    out = users.groupBy(F.col("created_month").alias("month"), F.col("created_year").alias("year")).agg(F.count("*").alias("n")).withColumn("brand", F.lit(None).cast("string"))
    return out.unionByName(cards.groupBy(F.col("card_brand_part").alias("brand"), F.col("expires_year_part").alias("year")).agg(F.count("*").alias("n")).withColumn("month", F.lit(None).cast("int"))).select("month", "year", "brand", "n")
