"""Jobs that are run again, and what they leave; the lake queries compare most of it with SQL."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import jobs, runs
from tidemark.operators import tables
from tidemark.sources import lake as lakes
from tidemark.sources import readers
from tidemark.sources.lake import Lake

RAW = "id string, date string, client_id string, card_id string, amount string, use_chip string, merchant_id string, merchant_city string, merchant_state string, zip string, mcc string, errors string, _loaded_at timestamp"


def row(i, day, amount, user="u", loaded=0):
    return (i, f"{day} 10:00:00" if day else None, user, "c", amount, "Chip Transaction", "m", "City", "NY", "1234.0", "5000", None, __import__("datetime").datetime(2024, 1, 1, loaded))


def ingest(spark, lake, rows):
    jobs.ingest(spark, lake, "transactions", spark.createDataFrame(rows, RAW), date(2024, 1, 2), "b", jobs.transaction_days)


def test_better_second_run(spark, tmp_path):
    """A day that becomes valid leaves no stale quarantine, a day that loses its rows no stale staging; other days stay. Rows without a date are kept."""
    lake = Lake(str(tmp_path))
    ingest(spark, lake, [row("a", "2024-01-01", "N/A"), row("b", "2024-01-02", "$1.00"), row("b", "2024-01-02", "$2.00", loaded=5), row("c", None, "$3.00")])
    jobs.clean(spark, lake, date(2024, 1, 3))
    read = lambda zone: {(r.transaction_id, r.day): r.amount for r in lake.read(spark, zone, "transactions").collect()}
    assert {k: float(v) for k, v in read("staging").items()} == {("b", 2): 2.0} and set(read("quarantine")) == {("a", 1), ("c", None)}
    ingest(spark, lake, [row("a", "2024-01-01", "$5.00"), row("b", "2024-01-02", "x")])
    jobs.clean(spark, lake, date(2024, 1, 3), date(2024, 1, 1), date(2024, 1, 2))
    assert {k: float(v) for k, v in read("staging").items()} == {("a", 1): 5.0} and set(read("quarantine")) == {("b", 2), ("c", None)}
    assert all(r.invariant_ok for r in jobs.reconcile(spark, lake, date(2024, 1, 1), date(2024, 1, 2)).collect())


def test_raw_checks(spark, tmp_path):
    lake = Lake(str(tmp_path))
    ingest(spark, lake, [row("a", "2024-01-01", "$1"), row(None, "2024-01-02", "$1")])
    jobs.ingest(spark, lake, "mcc_codes", spark.sql("select '1' as mcc_code, 'x' as description"), date(2024, 1, 1), "b")
    jobs.raw_checks(spark, lake, date(2024, 1, 1))
    for day in (date(2024, 1, 2), date(2024, 1, 3)):
        with pytest.raises(ValueError):
            jobs.raw_checks(spark, lake, day)


def test_nothing_to_restate(spark, tmp_path):
    assert jobs.restate(spark, Lake(str(tmp_path)), date(2024, 1, 1), "b") == {"changes": 0, "days": 0}


def states(spark, lake):
    """All rows of all published tables."""
    return {k: sorted(map(str, lake.read(spark, *k.split("/")).collect())) for k in lake.state(spark).tables}


def test_a_table_reads_what_it_replaces(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with lake.change(spark) as change:
        change.put("z", "t", spark.range(3))
    with lake.change(spark) as change:
        change.put("z", "t", change.read("z", "t").withColumn("id", F.col("id") + 10), files=1)
        assert sorted(r.id for r in lake.read(spark, "z", "t").collect()) == [0, 1, 2]
        assert sorted(r.id for r in change.read("z", "t").collect()) == [10, 11, 12]
    assert sorted(r.id for r in lake.read(spark, "z", "t").collect()) == [10, 11, 12]
    assert lake.expire(spark) == 1 and lake.state(spark).number == 2 and sorted(r.id for r in lake.read(spark, "z", "t").collect()) == [10, 11, 12]


def test_columns_of_partitions(spark, tmp_path):
    """A table keeps all columns that any partition was written with, in whatever order they came; another type is an error."""
    lake, rows = Lake(str(tmp_path)), lambda text, schema: spark.createDataFrame(text, schema)
    with lake.change(spark) as change:
        change.put("z", "t", rows([("a", 2024, 1, 1, True), ("b", 2024, 1, 2, None)], "id string, year int, month int, day int, flag boolean"), readers.DAY)
    with lake.change(spark) as change:
        got = change.put("z", "t", rows([(1.5, 2024, 1, 1, "c")], "more double, year int, month int, day int, id string"), readers.DAY)
        assert got["rows"] == 1
    out = lake.read(spark, "z", "t")
    assert out.columns == ["id", "flag", "more", "year", "month", "day"] and sorted(map(tuple, out.collect()), key=str) == [("b", None, None, 2024, 1, 2), ("c", None, 1.5, 2024, 1, 1)]
    assert [r.id for r in lake.read(spark, "z", "t", date(2024, 1, 2)).collect()] == ["b"] and lake.read(spark, "z", "t", date(2025, 1, 1)).count() == 0
    with pytest.raises(TypeError, match="flag"), lake.change(spark) as change:
        change.put("z", "t", rows([("a", 2024, 1, 1, "x")], "id string, year int, month int, day int, flag string"), readers.DAY)
    with pytest.raises(ValueError, match="partitioned"), lake.change(spark) as change:
        change.put("z", "t", spark.range(1))
    with pytest.raises(FileNotFoundError):
        lake.read(spark, "z", "none")
    with lake.change(spark) as change:
        change.put("z", "t", out.filter("false"), readers.DAY, ["year=2024/month=1/day=1"])
    assert [r.id for r in lake.read(spark, "z", "t").collect()] == ["b"]


def test_two_changes_at_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    one, two = lake.change(spark), lake.change(spark)
    one.put("z", "t", spark.range(1))
    two.put("z", "t", spark.range(2))
    one.publish()
    with pytest.raises(OSError):
        two.publish()
    assert lake.read(spark, "z", "t").count() == 1


class Killed(Exception):
    pass


def killed(monkeypatch, at, job):
    """Whether job was killed: after its write number `at`, or before the file is moved in that publishes all, if it has so many writes."""
    seen, write = [0], lakes.Change._write

    def written(self, *a, **k):
        out = write(self, *a, **k)
        seen[0] += 1
        if seen[0] > at:
            raise Killed
        return out

    def moved(*_):
        if seen[0] == at:
            raise Killed
        return rename(*_)

    rename = lakes._rename
    monkeypatch.setattr(lakes.Change, "_write", written)
    monkeypatch.setattr(lakes, "_rename", moved)
    try:
        job()
        return False
    except Killed:
        return True
    finally:
        monkeypatch.undo()


def late_label_lake(spark, path):
    """A lake in which labels changed: two days, three transactions, one of them with a new label."""
    lake = Lake(path)
    ingest(spark, lake, [row("a", "2024-01-01", "$5.00"), row("b", "2024-01-02", "$1.00"), row("c", "2024-01-02", "$2.00"), row("x", "2024-01-02", "N/A")])
    deliver(spark, lake, {"a": "No", "b": "No"}, date(2024, 2, 1))
    jobs.ingest(spark, lake, "mcc_codes", spark.sql("select '5000' as mcc_code, 'x' as description"), date(2024, 1, 1), "b")
    jobs.ingest(spark, lake, "cards", spark.sql("select 'c' as id, 'u' as client_id, 'Visa' as card_brand, 'Debit' as card_type, '4111' as card_number, '1/2030' as expires, '1' as cvv, 'YES' as has_chip, '$5' as credit_limit, 'No' as card_on_dark_web"), date(2024, 1, 1), "b")
    jobs.ingest(spark, lake, "users", spark.sql("select 'u' as id, '30' as current_age, '600' as credit_score, '$5' as yearly_income"), date(2024, 1, 1), "b")
    jobs.clean(spark, lake, date(2024, 1, 3))
    jobs.clean_dimensions(spark, lake, date(2024, 1, 3))
    assert jobs.enrich(spark, lake) == {"rows": 3, "with_category": 3, "with_card": 3, "with_label": 2}
    jobs.build_index(spark, lake, date(2024, 1, 3), "b")
    return lake


def deliver(spark, lake, labels, day):
    jobs.ingest(spark, lake, "fraud_labels", spark.createDataFrame(list(labels.items()), "transaction_id string, is_fraud string"), day, str(day))


def test_killed_jobs_leave_old_or_new_tables(spark, tmp_path, monkeypatch):
    """Each job is killed after each of its writes and before they are published: all tables stay as they were, nothing is left over once it ran again, and then they are as if it had never failed."""
    lake = late_label_lake(spark, str(tmp_path))
    jobs.detect(spark, lake, date(2024, 2, 1), "b1")
    deliver(spark, lake, {"a": "Yes", "b": "No", "c": "Yes"}, date(2024, 3, 1))
    steps = [
        lambda: jobs.clean(spark, lake, date(2024, 1, 3), date(2024, 1, 2)),
        lambda: jobs.detect(spark, lake, date(2024, 3, 1), "b2"),
        lambda: jobs.restate(spark, lake, date(2024, 3, 1), "b2"),
        lambda: jobs.compact_month(spark, lake, "raw", "transactions", 2024, 1),
    ]
    for step in steps:
        before, at = states(spark, lake), 0
        while killed(monkeypatch, at, step):
            assert states(spark, lake) == before
            at += 1
        assert at >= 2
        after = states(spark, lake)
        assert after != before or step is steps[0]
    lake.expire(spark)
    there = {f"{k}/{v}" for k, t in lake.state(spark).tables.items() for vs in t.parts.values() for v in vs}
    assert {f"{k}/{v}" for k, v in lake._folders(spark)} == there
    assert {r.transaction_id: r.is_fraud for r in lake.read(spark, "staging", "transactions").collect()} == {"a": True, "b": False, "c": True}
    assert sorted((r.snapshot_type, r.report_date.day, r.fraud_txn_count) for r in lake.read(spark, "audit", "report_snapshots").collect()) == [("AFTER", 1, 1), ("AFTER", 2, 1), ("BEFORE", 1, 0), ("BEFORE", 2, 0)]
    assert lake.read(spark, "audit", "applied_ledger").count() == 2
    assert jobs.tiers(spark, lake, "raw", "transactions").count() == 4 and lake.read(spark, "raw", "transactions").count() == 0


def test_a_day_cleaned_again_keeps_what_enrich_added(spark, tmp_path):
    lake = late_label_lake(spark, str(tmp_path))
    for day in (date(2024, 1, 1), date(2024, 1, 2)):
        jobs.clean(spark, lake, date(2024, 1, 4), day)
        jobs.build_index(spark, lake, date(2024, 1, 4), "b")
        assert {r.transaction_id: r.is_fraud for r in lake.read(spark, "audit", "transaction_index").collect()} == {"a": False, "b": False, "c": None}
    assert {r.card_brand for r in lake.read(spark, "staging", "transactions").collect()} == {"Visa"}


def test_two_restatements_of_one_date(spark, tmp_path):
    """The second run of a date of knowledge replaces the report of after and keeps that of before."""
    lake = late_label_lake(spark, str(tmp_path))
    jobs.detect(spark, lake, date(2024, 2, 1), "b1")
    for labels, fraud in (({"b": "Yes"}, 1), ({"b": "Yes", "c": "Yes"}, 2)):
        deliver(spark, lake, labels, date(2024, 3, 1))
        jobs.detect(spark, lake, date(2024, 3, 1), "b2")
        jobs.restate(spark, lake, date(2024, 3, 1), "b2")
        got = {(r.snapshot_type, r.report_date.day): r.fraud_txn_count for r in lake.read(spark, "audit", "report_snapshots").collect()}
        assert got["BEFORE", 2] == 0 and got["AFTER", 2] == fraud


def test_counts_come_from_the_write(spark, tmp_path):
    lake = Lake(str(tmp_path))
    got = jobs.ingest(spark, lake, "transactions", spark.createDataFrame([row("a", "2024-01-01", "$1"), row(None, "2024-01-01", "$1"), row("a", "2024-01-01", "$2", loaded=3), row("b", None, "x")], RAW), date(2024, 1, 2), "b", jobs.transaction_days)
    assert got == {"table": "transactions", "batch": "b", "rows": 4, "null_keys": 1}
    assert jobs.clean(spark, lake, date(2024, 1, 3)) == {"rows": 3, "accepted": 1, "rejected": 2, "null_keys": 1}


def test_append_by_mark(spark, tmp_path):
    """Three batches, the middle one twice, the last one with one more row of the last moment."""
    lake, schema = Lake(str(tmp_path)), "id string, at timestamp"
    at = lambda d: __import__("datetime").datetime(2024, 1, d)
    batches = [[("a", at(1)), ("b", at(2))], [("b", at(2)), ("c", at(2)), ("d", at(3))], [("b", at(2)), ("c", at(2)), ("d", at(3))], [("a", at(1)), ("d", at(3)), ("e", at(3)), ("f", None)]]
    added = [jobs.append_batch(spark, lake, "warehouse", "t", spark.createDataFrame(b, schema), "at", "id")["rows"] for b in batches]
    assert added == [2, 2, 0, 1] and sorted(r.id for r in lake.read(spark, "warehouse", "t").collect()) == ["a", "b", "c", "d", "e"]
    assert jobs.append_batch(spark, Lake(str(tmp_path / "x")), "w", "t", spark.createDataFrame([], schema), "at", "id") == {"rows": 0, "mark": None}


def test_latest_is_total(spark):
    rows = [("k", i, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    found = {tables.latest(df.repartition(n), ["k"], []).first().v for n in (1, 3, 7)}
    assert len(found) == 1


def test_ledger_status(spark):
    from tidemark.operators.audit import pending

    changes = spark.createDataFrame([("a", "NEW_LABEL"), ("b", "NEW_LABEL"), ("c", "UNINDEXED")], "change_id string, change_type string")
    ledger = spark.createDataFrame([("a", "APPLIED"), ("b", "FAILED")], "change_id string, status string")
    assert [r.change_id for r in pending(changes, ledger).collect()] == ["b"]


def test_optional(spark, tmp_path):
    assert readers.optional(spark, str(tmp_path / "none"), "x int").collect() == []


def test_runs(spark, tmp_path):
    """A day, then audits with late labels, then upkeep on the first of a month that moves the month before last."""
    lake = Lake(str(tmp_path))
    one = lambda sql: spark.sql(sql)
    sources = {
        "transactions": spark.createDataFrame([row("a", "2024-01-01", "$5.00"), row("b", "2024-01-01", "$1.00"), row("x", "2024-01-01", "N/A")], RAW), "mcc_codes": one("select '5000' as mcc_code, 'x' as description"),
        "fraud_labels": spark.createDataFrame([("a", "No")], "transaction_id string, is_fraud string"), "users": one("select 'u' as id, '30' as current_age, '600' as credit_score, '$5' as yearly_income, '1990' as birth_year, 'x' as birth_month"),
        "cards": one("select 'c' as id, 'u' as client_id, 'Visa' as card_brand, 'Debit' as card_type, '4111' as card_number, '1/2030' as expires, '1' as cvv, 'YES' as has_chip, '$5' as credit_limit, 'No' as card_on_dark_web"),
    }
    got = runs.daily(spark, lake, sources, date(2024, 1, 1), "b1", ["credit_band"])
    assert got["ingested"]["transactions"] == 3 and got["cleaned"] == {"rows": 3, "accepted": 2, "rejected": 1, "null_keys": 0} and got["enriched"]["with_label"] == 1 and got["features"] == 2
    raw = lake.state(spark).tables
    assert list(raw["raw/users"].parts) == ["created_year=1990/created_month=__HIVE_DEFAULT_PARTITION__"] and list(raw["raw/cards"].parts) == ["card_brand_part=visa/expires_year_part=2030"]
    assert "cvv" not in lake.read(spark, "raw", "cards").columns and "created_year" not in lake.read(spark, "staging", "users").columns
    assert {r._source_file for r in lake.read(spark, "raw", "cards").collect()} == {"cards"} and {r._batch_id for r in lake.read(spark, "raw", "users").collect()} == {"b1"}
    assert runs.audited(spark, lake, date(2024, 1, 1), "b1")["mode"] == "baseline"
    deliver(spark, lake, {"a": "Yes", "b": "No"}, date(2024, 3, 1))
    assert runs.audited(spark, lake, date(2024, 3, 1), "b2") == {"mode": "changes", "changes": 2, "restated": {"changes": 2, "days": 1}}
    with pytest.raises(ValueError, match="raw data"):
        runs.daily(spark, lake, {"transactions": sources["transactions"].withColumn("id", F.lit(None).cast("string"))}, date(2024, 1, 1), "b3", ["credit_band"])
    assert lake.read(spark, "staging", "transactions").count() == 2
    ingest(spark, lake, [row(str(k), "2024-02-29", f"${k}", user=f"u{k % 7}") for k in range(20)])
    runs.upkeep(spark, lake, date(2024, 3, 1))
    assert jobs.tiers(spark, lake, "raw", "transactions").count() == 23 and {r.month for r in lake.read(spark, "raw", "transactions").collect()} == {2}
    users = [r.client_id for r in lake.read(spark, "raw", "transactions").collect()]
    assert users == sorted(users)  # one file, in order
    empty = Lake(str(tmp_path / "none"))
    with empty.change(spark) as change:
        change.put("audit", "transaction_index", lake.read(spark, "audit", "transaction_index").limit(0), readers.DAY)
    with pytest.raises(ValueError, match="empty"):
        runs.late_label_story(spark, empty, date(2024, 3, 1))


def test_baseline_takes_labels_of_later_transactions(spark, tmp_path):
    """A label of the baseline whose transaction is indexed later comes to it by enrichment; it is known, so that later runs find no change."""
    lake = late_label_lake(spark, str(tmp_path))
    deliver(spark, lake, {"a": "No", "later": "Yes"}, date(2024, 2, 1))
    assert jobs.detect(spark, lake, date(2024, 2, 1), "b1") == {"mode": "baseline", "changes": 0}
    assert {r.transaction_id: r.is_fraud for r in lake.read(spark, "audit", "label_history").collect()} == {"a": False, "later": True}
    ingest(spark, lake, [row("later", "2024-01-03", "$9.00")])
    jobs.clean(spark, lake, date(2024, 2, 2), date(2024, 1, 3))
    jobs.enrich(spark, lake, date(2024, 1, 3))
    jobs.build_index(spark, lake, date(2024, 2, 2), "b2", date(2024, 1, 3))
    assert {r.transaction_id: r.is_fraud for r in lake.read(spark, "audit", "transaction_index", date(2024, 1, 3)).collect()} == {"later": True}
    assert jobs.detect(spark, lake, date(2024, 3, 1), "b3") == {"mode": "changes", "changes": 0}


def test_tables_are_written_in_small_parts(spark, tmp_path):
    """No side is broadcast by its estimated size, no id is sorted before its shuffle; the session's settings come back, also after an error."""
    from tidemark.sources import writers

    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.codegen.hugeMethodLimit"]
    before, lake = [spark.conf.get(k, None) for k in keys], Lake(str(tmp_path))
    with lake.change(spark) as change:
        change.put("z", "a", spark.range(100).withColumn("x", F.col("id") % 7))
        change.put("z", "b", spark.range(50))
    with pytest.raises(KeyError), writers.in_parts(spark):
        joined = lake.read(spark, "z", "a").join(lake.read(spark, "z", "b"), "id", "left")
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        raise KeyError
    assert [spark.conf.get(k, None) for k in keys] == before
    rows = lake.read(spark, "z", "a")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    first, same = tables.latest(rows, ["x"], [F.desc("id")], seldom=True), tables.latest(rows, ["x"], [F.desc("id")])
    assert "WindowGroupLimit" not in plan(first) and "WindowGroupLimit" in plan(same)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, same.collect())) and first.columns == rows.columns


def test_wide_rows_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Staged rows are dealt once when they get facts or new labels, narrow ones go to the sides; the index, and labels of one date of knowledge, are written where they are. A day of
    several parts is whole afterwards."""
    import re

    from tidemark.sources import writers

    lake, seen = late_label_lake(spark, str(tmp_path)), []
    monkeypatch.setattr(lakes, "PART_BYTES", 8192)  # each day has some parts
    write = lakes.Change._write

    def noted(self, zone, name, rows, *by, **how):
        with writers.in_parts(spark):
            text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString((rows if how.get("gathered") else rows.hint("rebalance"))._jdf.queryExecution(), "formatted")
        seen.append((f"{zone}/{name}", set(re.findall(r"Exchange\s*\nInput \[\d+\]: \[(.*?)\]", text))))  # one that is listed with subqueries too counts once
        return write(self, zone, name, rows, *by, **how)

    monkeypatch.setattr(lakes.Change, "_write", noted)
    jobs.enrich(spark, lake)
    jobs.build_index(spark, lake, date(2024, 1, 3), "b")
    jobs.detect(spark, lake, date(2024, 2, 1), "b1")
    deliver(spark, lake, {"a": "Yes", "b": "No", "c": "Yes"}, date(2024, 3, 1))
    jobs.detect(spark, lake, date(2024, 3, 1), "b2")
    jobs.restate(spark, lake, date(2024, 3, 1), "b2")
    staged = [sum("merchant_city" in x for x in found) for key, found in seen if key == "staging/transactions"]
    assert staged == [1, 1]
    assert not any(found for key, found in seen if key in ("audit/transaction_index", "audit/impact_manifest"))
    assert [len(found) for key, found in seen if key == "audit/label_history"] == [1, 0]
    for zone, name in (("staging", "transactions"), ("audit", "transaction_index")):
        assert {r.transaction_id: r.is_fraud for r in lake.read(spark, zone, name).collect()} == {"a": True, "b": False, "c": True}


def test_tiers_need_raw_rows_alone(spark, monkeypatch):
    """Raw rows are ingested for tiers, nothing is cleaned; a month is compacted to one file, as it is small."""
    from tidemark import catalogue_lake

    monkeypatch.setattr(catalogue_lake, "_LAKES", {})
    assert catalogue_lake.lake_tiers(spark, "/root/testdata/sf0.001").count() > 0
    found = {key[2]: lake for key, lake in catalogue_lake._LAKES.items()}
    assert set(found) == {"_raw", "_two_tiers"} and set(found["_raw"].state(spark).tables) == {"raw/transactions"}
    assert len(found["_two_tiers"].read(spark, "warm", "transactions").inputFiles()) == 1


def test_raw_rows_are_dealt_once_to_be_clean_and_enriched(spark, tmp_path, monkeypatch):
    """Cleaned and enriched at once is cleaned and then enriched, and the latest row of each id: with ids on several days, with several cards, without a card, an id, a date. Wide rows are
    dealt once, by day and part of it; staging and quarantine are written where they are."""
    import re

    from tidemark.plans import transactions
    from tidemark.sources import writers

    monkeypatch.setattr(lakes, "PART_BYTES", 8192)  # each day has some parts
    at, put = date(2024, 1, 3), lakes.Change.put
    some = [row(f"i{k}", f"2024-01-0{1 + k % 3}", "N/A" if k % 5 == 0 else f"${k}.00", user=f"u{k % 7}", loaded=k % 4)[:3] + (None if k % 6 == 0 else f"c{k % 4}",) + row("", "2024-01-01", "N/A" if k % 5 == 0 else f"${k}.00", loaded=k % 4)[4:] for k in range(120)]
    again = [x[:1] + ("2024-01-03 10:00:00",) + x[2:3] + ("c2",) + x[4:-1] + (x[-1].replace(hour=k % 9),) for k, x in enumerate(some) if k % 4 == 0]  # on another day, mostly, with another card
    odd = [row(None, "2024-01-01", "$1"), row(None, "2024-01-02", "$2", loaded=3), row("i1", None, "$3"), row("n", None, "$4"), row("n", None, "$5", loaded=1)]
    cards = spark.sql("select 'c' || id as id, 'u' as client_id, 'Visa' || id as card_brand, 'Debit' as card_type, '4111' as card_number, '1/2030' as expires, '1' as cvv, 'YES' as has_chip, '$5' as credit_limit, 'No' as card_on_dark_web from range(3)")
    codes = spark.sql("select '5000' as mcc_code, 'x' as description")
    for name, rows in (("one day", some), ("days", [*some, *again, *odd])):
        seen, found = [], {}
        for together in (False, True):
            lake = Lake(str(tmp_path / f"{name} {together}"))
            ingest(spark, lake, rows)
            deliver(spark, lake, {f"i{k}": ("Yes", "No", "?")[k % 3] for k in range(90)}, at)
            for table, source in (("cards", cards), ("mcc_codes", codes), ("users", spark.sql("select 'u' as id, '30' as current_age, '600' as credit_score, '$5' as yearly_income"))):
                jobs.ingest(spark, lake, table, source, at, "b")
            jobs.clean_dimensions(spark, lake, at)
            monkeypatch.setattr(lakes.Change, "put", lambda self, zone, table, *a, **k: seen.append((together, zone, k.get("gathered"))) or put(self, zone, table, *a, **k))
            counts = jobs.clean_and_enrich(spark, lake, at) if together else (jobs.clean(spark, lake, at), jobs.enrich(spark, lake))
            monkeypatch.setattr(lakes.Change, "put", put)
            found[together] = counts, {z: sorted(str(sorted(r.asDict().items(), key=str)) for r in lake.read(spark, z, "transactions").collect()) for z in ("staging", "quarantine")}
        assert found[True] == found[False] and found[True][0][1]["with_card"] > 0 and found[True][0][1]["with_label"] > 0
        assert seen == [(False, "staging", True), (False, "quarantine", True), (False, "staging", True), (True, "staging", True), (True, "quarantine", True)]
        raw = lake.read(spark, "raw", "transactions")
        plain = transactions.typed_transactions(tables.latest(raw.drop(*readers.DAY, "_ingested_at", "_source_file"), ["id"], [F.desc_nulls_last("_loaded_at")])).select("transaction_id", "transaction_date", "amount_raw", "card_id")
        kept = [lake.read(spark, z, "transactions").select("transaction_id", "transaction_date", "amount_raw", "card_id") for z in ("staging", "quarantine")]
        assert sorted(map(str, plain.collect())) == sorted(map(str, kept[0].unionByName(kept[1]).collect()))
        if name == "one day":
            with lake.change(spark) as change, writers.in_parts(spark):
                latest = jobs._latest_by_day(spark, change, raw, None, None, str(tmp_path / "keys"), True)
                text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(latest._jdf.queryExecution(), "formatted")
            assert sum("merchant_city" in x for x in re.findall(r"Exchange\s*\nInput \[\d+\]: \[(.*?)\]", text)) == 1


def test_a_feed_by_day_is_dealt_before_its_texts_are_made(spark, tmp_path, monkeypatch):
    """Raw transactions of the lake: events are dealt by day, four narrow columns, texts aren't; each row is there as in the feed that is not by day."""
    import re

    from tidemark import catalogue_lake

    feed = catalogue_lake.raw_transactions(spark, "/root/testdata/sf0.001")
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(jobs.transaction_days(feed)._jdf.queryExecution(), "formatted")
    dealt = re.findall(r"Exchange\s*\nInput \[\d+\]: \[(.*?)\]", text)
    assert len(dealt) == 1 and "event_type" in dealt[0] and "merchant" not in dealt[0] and "date" not in dealt[0]
    lake = catalogue_lake._raw(spark, "/root/testdata/sf0.001")
    rows = lambda df: sorted(map(tuple, df.select(*[c for c in feed.columns if c != "_loaded_at"]).collect()), key=str)
    assert rows(lake.read(spark, "raw", "transactions")) == rows(readers.raw_transactions(spark, "/root/testdata/sf0.001"))


def test_dimensions_are_dealt_raw(spark, tmp_path, monkeypatch):
    """Raw users and cards are shuffled, not what they are cleaned to; of a key delivered twice the later row stays, rows without one go. Cards that come by their partitions aren't dealt by them."""
    import re

    from tidemark.sources import writers

    lake, plans, write = Lake(str(tmp_path)), {}, lakes.Change._write

    def noted(self, zone, name, rows, *by, **how):
        with writers.in_parts(spark):
            text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
        plans[f"{zone}/{name}"] = re.findall(r"Exchange\s*\nInput \[\d+\]: \[(.*?)\]", text)
        return write(self, zone, name, rows, *by, **how)

    monkeypatch.setattr(lakes.Change, "_write", noted)
    cards = spark.sql("select if(id < 2, 'c', if(id = 2, 'd', null)) as id, 'u' as client_id, 'Visa' as card_brand, 'Debit' as card_type, '4111' as card_number, '1/2030' as expires, '1' as cvv, 'YES' as has_chip, concat('$', id) as credit_limit, 'No' as card_on_dark_web, timestamp'2024-01-01' + make_interval(0, 0, 0, id) as _loaded_at from range(4)")
    users = spark.sql("select if(id = 3, null, 'u' || id) as id, '30' as current_age, '600' as credit_score, '$5' as yearly_income, '1990' as birth_year, '1' as birth_month from range(4)")
    sources = {"cards": cards, "users": users, "mcc_codes": spark.sql("select '5000' as mcc_code, 'x' as description")}
    jobs.ingest_all(spark, lake, sources, date(2024, 1, 1), "b", gathered=["cards"])
    jobs.clean_dimensions(spark, lake, date(2024, 1, 1))
    assert not plans["raw/cards"] and len(plans["raw/users"]) == 1 and "_source_file" not in plans["raw/users"][0]
    for name, cleaned in (("users", "credit_band"), ("cards", "months_to_expiry")):
        assert len(plans[f"staging/{name}"]) == 1 and cleaned not in plans[f"staging/{name}"][0]
    assert {(r.card_id, float(r.credit_limit)) for r in lake.read(spark, "staging", "cards").collect()} == {("c", 1.0), ("d", 2.0)}
    assert {(r.user_id, r.credit_band is not None) for r in lake.read(spark, "staging", "users").collect()} == {(f"u{k}", True) for k in range(3)}
