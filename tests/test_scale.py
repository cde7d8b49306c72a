"""Hot users, many versions, tables joined without exchange, the catalogue and the stream: against plain forms of the same, and what the plans say."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_jobs import Killed, ingest, killed, late_label_lake, row, states
from tidemark import catalogue_lake, jobs
from tidemark.operators import features, tables
from tidemark.sources import catalog, readers
from tidemark.streaming import labels

SMALL = "/root/testdata/sf0.001"
FACTS = "user_id string, transaction_id string, transaction_date timestamp, amount double, merchant_state string"


def plain_windows(df):
    """The same features with one window of all rows of a user."""
    user, at = Window.partitionBy("user_id"), F.unix_timestamp("transaction_date")
    df = df.withColumn("at", at)
    frames = {k: user.orderBy("at").rangeBetween(-s, 0) for k, s in {"1h": 3600, "24h": 86400, "7d": 7 * 86400}.items()}
    before = user.orderBy("at", "transaction_id").rowsBetween(Window.unboundedPreceding, -1)
    out = {f"txn_count_last_{k}": F.count("*").over(w) - 1 for k, w in frames.items()} | {f"amount_sum_last_{k}": F.round(F.sum("amount").over(frames[k]) - F.col("amount"), 6) for k in ("1h", "24h")}
    return df.select("transaction_id", *[c.alias(k) for k, c in out.items()], F.round(F.avg("amount").over(before), 6).alias("user_avg_amount"))


def facts(spark):
    """A third of all rows are one user's; times within a second of the limits of windows, ties, null amounts and users."""
    rng, start, rows = random.Random(1), datetime(2024, 1, 1), []
    for k in range(6000):
        user = "hot" if k % 3 == 0 else f"u{rng.randrange(400)}" if k % 50 else None
        rows.append((user, f"t{k:05d}", start + timedelta(seconds=rng.randrange(40 * 86400)), rng.choice([None, 1.0, 2.5, -4.0, 100.25]), rng.choice([None, "CA", "ONLINE", "NY"])))
    edge = [0, 1, 3599, 3600, 3601, 86399, 86400, 86401, 7 * 86400 - 1, 7 * 86400, 7 * 86400 + 1, 8 * 86400]
    rows += [("edge", f"e{k:02d}", start + timedelta(hours=5, seconds=s), float(k), "CA") for k, s in enumerate(edge + edge)]
    return spark.createDataFrame(rows, FACTS)


def test_windows_of_hot_users(spark):
    df = facts(spark)
    got = features.point_in_time(df).select("transaction_id", *[f"txn_count_last_{k}" for k in ("1h", "24h", "7d")], *[F.round(f"amount_sum_last_{k}", 6).alias(k) for k in ("1h", "24h")], F.round("user_avg_amount", 6).alias("user_avg_amount"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain_windows(df).collect()))
    assert features.point_in_time(df).columns[: len(df.columns)] == df.columns
    no_time = spark.createDataFrame([("u", "a", None, 1.0, "CA"), ("u", "b", datetime(2024, 1, 1), 2.0, "CA")], FACTS)
    assert {r.transaction_id: (r.txn_count_last_7d, r.user_avg_amount) for r in features.point_in_time(no_time).collect()} == {"a": (0, None), "b": (0, None)}


def test_a_hot_user_is_no_single_task(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = [r.n for r in features.point_in_time(facts(spark)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) == 4 and max(per_task) <= 2 * sum(per_task) / 4


def test_reference_case(spark):
    at = lambda h, m=0: datetime(2018, 6, 15, h, m)
    df = spark.createDataFrame([("u", "t1", at(10), 100.0, "CA"), ("u", "t2", at(10, 30), 200.0, "CA"), ("u", "t3", at(12), 50.0, "CA")], FACTS)
    got = {r.transaction_id: r for r in features.point_in_time(df).collect()}
    assert (got["t1"].txn_count_last_1h, got["t1"].amount_sum_last_1h, got["t1"].user_avg_amount) == (0, 0.0, None)
    assert (got["t2"].txn_count_last_1h, got["t2"].amount_sum_last_1h, got["t2"].user_avg_amount) == (1, 100.0, 100.0)
    assert (got["t3"].txn_count_last_1h, got["t3"].txn_count_last_24h, got["t3"].amount_sum_last_24h) == (0, 2, 300.0)


def test_versions_are_carried_forward(spark):
    """10,000 versions of one key: no row is multiplied, and the result is that of the interval join. Gaps, versions that begin within a day, null keys and times."""
    rng, start = random.Random(2), datetime(2020, 1, 1)
    versions = [("hot", f"v{k}", start + timedelta(hours=k), start + timedelta(hours=k + (0.5 if k % 10 == 0 else 1))) for k in range(10_000)]
    versions += [("open", "first", start, start + timedelta(days=3)), ("open", "last", start + timedelta(days=3), None), (None, "x", start, None)]
    rows = [("hot", k, start + timedelta(minutes=rng.randrange(-5000, 700_000))) for k in range(2000)] + [("open", 5000 + k, start + timedelta(days=k)) for k in range(-2, 8)] + [(None, 9000, start), ("hot", 9001, None), ("none", 9002, start)]
    dim = spark.createDataFrame(versions, "k string, name string, valid_from timestamp, valid_to timestamp")
    df = spark.createDataFrame(rows, "k string, n int, at timestamp")
    got = tables.version_at(df, dim, "k", "at", ["name"])
    by = {}
    for k, name, low, high in versions:
        by.setdefault(k, []).append((low, high, name))
    want = [(k, n, t, next((name for low, high, name in by.get(k, []) if k and t and low <= t and (high is None or t < high)), None)) for k, n, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_tables_join_without_exchange(spark):
    out = catalogue_lake.bucketed(spark, SMALL, buckets=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert out.count() == readers.table(spark, SMALL, "events").count()


def test_catalogue_prunes_and_repairs(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "2024 as year", "1 as month", "cast(id % 3 + 1 as int) as day")
    catalog.external_table(spark, "repaired", str(tmp_path / "t"), rows.schema, readers.DAY)
    rows.write.partitionBy(*readers.DAY).parquet(str(tmp_path / "t"))
    assert spark.table("repaired").count() == 0
    assert catalog.repair(spark, "repaired") == [f"year=2024/month=1/day={d}" for d in (1, 2, 3)]
    some = spark.sql("SELECT id FROM repaired WHERE day = 2")
    assert sorted(r.id for r in some.collect()) == [1, 4, 7] and len(some.inputFiles()) < len(spark.table("repaired").inputFiles())
    (tmp_path / "t" / "year=2024" / "month=1" / "day=3").rename(tmp_path / "gone")
    assert len(catalog.repair(spark, "repaired")) == 2 and spark.table("repaired").count() == 7
    lake = jobs.Lake(str(tmp_path / "lake"))
    for _ in range(2):
        with lake.change(spark) as change:
            change.append("z", "t", rows, readers.DAY)
    with pytest.raises(ValueError, match="several folders"):
        catalog.published_table(spark, lake, "z", "t", "twice")
    with lake.change(spark) as change:
        change.put("z", "t", change.read("z", "t"), readers.DAY)
    catalog.published_table(spark, lake, "z", "t", "published")
    assert spark.sql("SELECT count(*) AS n FROM published WHERE day = 1").first().n == 8
    spark.sql("DROP TABLE repaired")
    spark.sql("DROP TABLE published")


def test_stream_stopped_anywhere(spark, tmp_path, monkeypatch):
    """The stream is killed after each write of a batch: the tables stay as they were, the next start does the batch again, and its end is that of the batch jobs."""
    lake = late_label_lake(spark, str(tmp_path / "lake"))
    jobs.detect(spark, lake, date(2024, 2, 1), "b1")
    want = {"a": True, "b": None, "c": False}
    batches = [{"a": "Yes", "b": "No", "x": "Yes"}, {"b": "unknown", "c": "No", "a": "Yes"}]

    def run():
        stream = spark.readStream.schema(labels.RAW_LABELS).parquet(str(tmp_path / "in"))
        query = labels.restate_late_labels(stream, lake, date(2024, 3, 1), str(tmp_path / "c"))
        try:
            query.awaitTermination()
        except Exception:
            raise Killed from None

    for number, batch in enumerate(batches):
        spark.createDataFrame(list(batch.items()), labels.RAW_LABELS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        before, at = states(spark, lake), 0 if number else 99
        while killed(monkeypatch, at, run):
            assert states(spark, lake) == before
            at += 3  # every third write of the second batch, as each start takes some seconds
        assert at >= 6 and list(lake.state(spark).tables["audit/label_batches"].marks.values()) == [number]
    assert {r.transaction_id: r.is_fraud for r in lake.read(spark, "staging", "transactions").collect()} == want
    assert sorted((r.transaction_id, r.change_type) for r in lake.read(spark, "audit", "impact_manifest").collect()) == [("a", "LABEL_CHANGED"), ("b", "LABEL_CLEARED"), ("c", "NEW_LABEL")]
    assert [r.transaction_id for r in lake.read(spark, "audit", "waiting_labels").collect()] == ["x"]
    history = lake.read(spark, "audit", "label_history").filter("knowledge_date = date'2024-03-01'")
    assert sorted((r.transaction_id, r.is_fraud) for r in history.collect()) == [("a", True), ("b", None), ("c", False)]
    # A batch that was published and not noted in the checkpoint comes again: nothing changes.
    before = states(spark, lake)
    (tmp_path / "c" / "commits" / "1").unlink()
    for extra in (tmp_path / "c" / "commits").glob(".1*"):
        extra.unlink()
    run()
    assert states(spark, lake) == before


def test_label_before_its_transaction(spark, tmp_path):
    """A label that comes before its transaction is indexed waits, and is applied once with the next batch after; one that comes again meanwhile takes its place."""
    lake = late_label_lake(spark, str(tmp_path / "lake"))
    jobs.detect(spark, lake, date(2024, 2, 1), "b1")

    def run(batch):
        spark.createDataFrame(list(batch.items()), labels.RAW_LABELS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(labels.RAW_LABELS).parquet(str(tmp_path / "in"))
        labels.restate_late_labels(stream, lake, date(2024, 3, 1), str(tmp_path / "c")).awaitTermination()
        return sorted((r.transaction_id, r.change_type, r.new_is_fraud) for r in lake.read(spark, "audit", "impact_manifest").collect())

    assert run({"late": "Yes"}) == [] and run({"late": "No"}) == []
    ingest(spark, lake, [row("late", "2024-01-02", "$9.00"), row("b", "2024-01-02", "$1.00"), row("c", "2024-01-02", "$2.00")])
    jobs.clean(spark, lake, date(2024, 1, 3), date(2024, 1, 2))
    jobs.build_index(spark, lake, date(2024, 1, 3), "b", date(2024, 1, 2))
    assert run({"a": "No"}) == [("late", "NEW_LABEL", False)]
    assert {r.transaction_id: r.is_fraud for r in lake.read(spark, "staging", "transactions").collect()} == {"a": False, "b": False, "c": None, "late": False}
    assert lake.read(spark, "audit", "waiting_labels").count() == 0


def test_stream_from_its_start_repeats_no_history(spark, tmp_path):
    """A second run from another checkpoint finds nothing new: its first batch, of the same number, adds no rows to the history."""
    lake = late_label_lake(spark, str(tmp_path / "lake"))
    jobs.detect(spark, lake, date(2024, 2, 1), "b1")
    spark.createDataFrame([("a", "Yes"), ("x", "No")], labels.RAW_LABELS).coalesce(1).write.parquet(str(tmp_path / "in"))
    for run in range(2):
        stream = spark.readStream.schema(labels.RAW_LABELS).parquet(str(tmp_path / "in"))
        labels.restate_late_labels(stream, lake, date(2024, 3, 1), str(tmp_path / f"c{run}")).awaitTermination()
    assert [r.transaction_id for r in lake.read(spark, "audit", "label_history").filter("knowledge_date = date'2024-03-01'").collect()] == ["a"]
    assert [r.transaction_id for r in lake.read(spark, "audit", "waiting_labels").collect()] == ["x"]
