"""The core queries against DuckDB, and single operators on cases that the tables lack."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import catalogue
from tidemark.functions import cleaning as C
from tidemark.functions.amounts import with_amount
from tidemark.operators import audit, features, tables
from tidemark.sources import readers
from tidemark.sources.lake import Lake

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    show = lambda x: None if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)) or x is pd.NA else f"{x:.6g}" if isinstance(x, float) else str(x)
    return sorted((tuple(map(show, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


AMOUNTS = [
    ("$1,234.56", 1234.56, "US", "USD", False),
    ("$-77.00", -77, "CLEAN", "USD", True),
    ("1.234,56", 1234.56, "EU", None, False),
    ("1234.56", 1234.56, "CLEAN", None, False),
    ("₫200,000", 200000, "VN", "VND", False),
    ("(500.00)", -500, "CLEAN", None, True),
    ("1,234", None, "AMBIGUOUS", None, False),
    ("1.234", None, "AMBIGUOUS", None, False),
    ("₫1,234", 1234, "VN", "VND", False),
    (None, None, "INVALID", None, False),
    ("N/A", None, "INVALID", None, False),
    (" ", None, "INVALID", None, False),
    ("1.234.567", 1234567, "VN", None, False),
    ("1,234,567", 1234567, "US", None, False),
    ("1234,56", 1234.56, "EU", None, False),
    ("-$5", None, "INVALID", None, True),
    ("--5", 5, "CLEAN", None, True),
    ("USD1", None, "INVALID", None, False),
    ("12 usd", 12, "CLEAN", "USD", False),
    ("nan", None, "INVALID", None, False),
    ("5d", None, "INVALID", None, False),
    ("1_000", None, "INVALID", None, False),
    ("1e5", 100000, "CLEAN", None, False),
    ("1 234,56", 1234.56, "EU", None, False),
]


def test_amounts(spark):
    got = with_amount(spark.createDataFrame([(i, a[0]) for i, a in enumerate(AMOUNTS)], "i int, t string"), "t", "a").orderBy("i").collect()
    for want, r in zip(AMOUNTS, got, strict=True):
        value = None if want[1] is None else Decimal(str(want[1])).quantize(Decimal("0.01"))
        assert (r.a.amount, r.a.format, r.a.currency, r.a.is_negative) == (value, *want[2:]), want[0]


def test_fields(spark):
    one = lambda value, f: spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y
    assert [one(x, C.normal_zip) for x in (None, "ONLINE", "1234.0", "123456", "abc", "58523.0")] == [None, "ONLINE", "01234", "123456", "abc", "58523"]
    assert [one(x, C.mask_card) for x in (None, "", "12", "4111-2222-3333-4444")] == [None, None, "XXXX-XXXX-XXXX-0012", "XXXX-XXXX-XXXX-4444"]
    assert [one(x, C.yes_or_no) for x in ("Yes", "NO", "maybe", None)] == [True, False, None, None]
    assert [one(x, lambda c: C.months_until(c, F.lit("2022-10-05").cast("date"))) for x in ("12/2022", "12", None)] == [2, None, None]
    assert [one(x, C.is_foreign) for x in ("CA", "DC", "ONLINE", None)] == [False, True, True, None]


def test_point_in_time(spark):
    at = lambda h, m=0, s=0: datetime(2018, 6, 15, h, m, s)
    rows = [("u", "t1", at(10), 100.0, "CA"), ("u", "t2", at(10, 30), 200.0, "CA"), ("u", "t3", at(12), 50.0, None), ("v", "a", at(1), None, "DC"), ("v", "b", at(1), 5.0, "DC"), ("v", "c", at(2), 1.0, "DC"), ("v", "d", at(3, 0, 1), 1.0, "DC")]
    got = {r.transaction_id: r for r in features.point_in_time(spark.createDataFrame(rows, "user_id string, transaction_id string, transaction_date timestamp, amount double, merchant_state string")).collect()}
    assert (got["t1"].txn_count_last_1h, got["t1"].amount_sum_last_1h, got["t1"].user_avg_amount) == (0, 0.0, None)
    assert (got["t2"].txn_count_last_1h, got["t2"].amount_sum_last_1h, got["t2"].user_avg_amount) == (1, 100.0, 100.0)
    assert (got["t3"].txn_count_last_1h, got["t3"].txn_count_last_24h, got["t3"].amount_sum_last_24h) == (0, 2, 300.0)
    assert [got[k].txn_count_last_1h for k in "abcd"] == [1, 1, 2, 0]
    assert got["a"].amount_sum_last_1h is None and got["a"].is_foreign_merchant is True


def test_versions_twice(spark):
    day = lambda d: F.lit(d).cast("date")
    dim = spark.createDataFrame([(1, "a", date(2024, 1, 1), None, True), (2, None, date(2024, 1, 1), None, True)], "k int, x string, valid_from date, valid_to date, is_current boolean")
    once = tables.merge_versions(dim, spark.createDataFrame([(1, "b"), (2, None), (3, "n")], "k int, x string"), "k", ["x"], day("2024-02-01"))
    twice = tables.merge_versions(once, spark.createDataFrame([(1, "c"), (3, "n")], "k int, x string"), "k", ["x"], day("2024-03-01"))
    assert once.count() == 4 and twice.filter("k = 1").count() == 3
    assert twice.filter("is_current").orderBy("k").select("k", "x").collect() == [(1, "c"), (2, None), (3, "n")]


def test_split_and_reconcile(spark):
    raw = spark.createDataFrame([(date(2024, 1, 1), "a"), (date(2024, 1, 1), "a"), (date(2024, 1, 1), None), (date(2024, 1, 2), "b")], "event_date date, transaction_id string")
    ok, bad = tables.split(raw.distinct(), F.col("transaction_id") == "a")
    got = {str(r.event_date): r for r in audit.reconcile(raw, ok, bad).collect()}
    assert all(r.invariant_ok for r in got.values()) and got["2024-01-01"].duplicate_count == 1


def test_unindexed_and_cleared(spark):
    labels = spark.createDataFrame([("a", None), ("b", True), ("c", True)], "transaction_id string, is_fraud boolean")
    history = spark.createDataFrame([("a", True, date(2024, 1, 1), datetime(2024, 1, 1))], "transaction_id string, is_fraud boolean, knowledge_date date, _recorded_at timestamp")
    rows = spark.createDataFrame([("a", date(2024, 1, 1), True), ("b", date(2024, 1, 1), False), ("d", date(2024, 1, 1), True)], "transaction_id string, event_date date, is_fraud boolean")
    changes = audit.label_changes(labels, history, rows, F.lit("2024-02-01").cast("date"))
    assert {r.transaction_id: (r.change_type, r.event_date is None) for r in changes.collect()} == {"a": ("LABEL_CLEARED", False), "b": ("NEW_LABEL", False), "c": ("UNINDEXED", True)}
    assert {r.transaction_id for r in audit.pending(changes, changes.limit(0)).collect()} == {"a", "b"}
    assert {r.transaction_id: r.is_fraud for r in audit.restate(rows, changes).collect()} == {"a": None, "b": True, "d": True}


def test_partitions(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = spark.createDataFrame([(2024, 1, 1, "a"), (2024, 1, 2, "b")], "year int, month int, day int, x string")
    for part in (rows, rows.filter("day = 2").withColumn("x", F.lit("c"))):
        with lake.change(spark) as change:
            change.put("z", "t", part, readers.DAY)
    got = lake.read(spark, "z", "t", date(2024, 1, 1), date(2024, 1, 2))
    assert sorted(r.x for r in got.collect()) == ["a", "c"]
    assert len(lake.read(spark, "z", "t", date(2024, 1, 2)).inputFiles()) == 1
    plain = str(tmp_path / "plain")
    rows.write.partitionBy(*readers.DAY).parquet(plain)
    days = readers.days(spark, plain, date(2024, 1, 2), date(2024, 1, 2))
    assert [r.x for r in days.collect()] == ["b"] and "PartitionFilters: [" in days._jdf.queryExecution().toString()
    assert readers.optional(spark, str(tmp_path / "none"), "x string").count() == 0
