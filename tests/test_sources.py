"""Readers and writers that no query uses, and the streams, on small inputs of their own."""

import os
import random
import subprocess
import sys
from collections import Counter
from datetime import datetime
from pathlib import Path

import pyspark
from pyspark.sql import functions as F

from tidemark import catalogue_lake, jobs
from tidemark.sources import readers, writers
from tidemark.sources.lake import Lake
from tidemark.streaming import labels


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,amount\n1,$5.00\n2,\n"3","1,234.56"\n')
    got = readers.csv(spark, str(tmp_path), ["id", "amount"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", "$5.00"), ("2", None), ("3", "1,234.56")]


def test_jdbc(spark):
    """Ranges and one connection read the same rows, null ids among them; ranges hold about as many rows each, though most ids lie close together."""
    rows = [(str(k if k % 20 else 10**11 + k * 10**9), f"x{k}") for k in range(1, 1001)] + [(None, "no id"), ("7-7", "with a dash")]
    url = catalogue_lake.derby(spark, {"t": spark.createDataFrame(rows, "id string, x string")})
    one, four = readers.jdbc(spark, url, "t", catalogue_lake.DERBY), readers.jdbc(spark, url, "t", catalogue_lake.DERBY, "id", 4)
    assert one.columns == four.columns == ["id", "x"] and one.rdd.getNumPartitions() == 1 and four.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, four.collect()), key=str) == sorted(rows, key=str)
    sizes = [len(p) for p in four.rdd.glom().collect()]
    assert max(sizes) <= 2 * min(sizes)
    empty = catalogue_lake.derby(spark, {"t": spark.createDataFrame([], "id string, x string")})
    assert readers.jdbc(spark, empty, "t", catalogue_lake.DERBY, "id", 4).count() == 0


def test_source_is_read_by_other_processes(spark):
    """Executors are processes of their own: two of them read the source's tables while the driver has it open."""
    url = catalogue_lake.derby(spark, {"t": spark.range(50).selectExpr("cast(id as string) as id", "'é,\"' as x")})
    assert readers.jdbc(spark, url, "t", catalogue_lake.DERBY, "id", 2).count() == 50
    code = f"""
import sys
from pyspark.sql import SparkSession
from tidemark import catalogue_lake, jobs
from tidemark.sources import readers
s = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
rows = readers.jdbc(s, {url!r}, "t", catalogue_lake.DERBY, "id", 4)
print("read", rows.count(), rows.select("x").distinct().first().x == 'é,"')
"""
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1]), "SPARK_SCALA_VERSION": "2.13", "SPARK_HOME": os.environ.get("SPARK_HOME") or str(Path(pyspark.__file__).parent)}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    assert "read 50 True" in subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180, check=True).stdout


def scans(spark, of):
    """What `of` returns, and how many jobs of Spark it took."""
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    got = of()
    return got, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)


def test_ranges_are_found_by_one_count(spark):
    """Each count is a scan of the whole source, which has no order by number: one is enough though a few ids are far off; ids that lie close together far from all others take a few."""
    far = [(str(k if k % 50 else k * 10**8), "x") for k in range(1, 3001)]
    near = [(str(10**15 + k), "x") for k in range(1000)] + [("7", "x"), (str((1 << 63) - 1), "x")]
    url = catalogue_lake.derby(spark, {"far_off": spark.createDataFrame(far, "id string, x string"), "near": spark.createDataFrame(near, "id string, x string")})
    for name, rows, most in (("far_off", far, 1), ("near", near, 5)):
        read, n = scans(spark, lambda name=name: readers.jdbc(spark, url, name, catalogue_lake.DERBY, "id", 8))
        sizes = [len(p) for p in read.rdd.glom().collect()]
        assert n <= most and len(sizes) == 8 and max(sizes) <= 2 * min(sizes) and sum(sizes) == len(rows)


def test_source_is_filled_in_parts(spark):
    """Files of rows are loaded at the same time, each to a table of its own, of which there are a few however many files come; quotes, commas and nulls in place."""
    rows = [(str(k), None if k % 3 else f'"{k},') for k in range(100)]
    url = catalogue_lake.derby(spark, {"t": spark.createDataFrame(rows, "id string, x string").repartition(40)})
    read = readers.jdbc(spark, url, "t", catalogue_lake.DERBY, "id", 4)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(rows, key=str)
    parts = [readers.jdbc(spark, url, f"t__{k}", catalogue_lake.DERBY).count() for k in range(catalogue_lake.PARTS)]
    assert sum(parts) == len(rows) and min(parts) > 0


def test_ranges_are_counted_as_they_are_ingested(spark, monkeypatch):
    """Between the counts in the source and the ingest nothing reads the source, and their rows are those of the table."""
    between, jdbc_sources, ingest_all = [], jobs.jdbc_sources, jobs.ingest_all
    at = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    monkeypatch.setattr(jobs, "jdbc_sources", lambda *a: (jdbc_sources(*a), between.append(at()))[0])
    monkeypatch.setattr(jobs, "ingest_all", lambda *a: (between.append(at()), ingest_all(*a))[1])
    lake = catalogue_lake._over_jdbc(spark, "/root/testdata/sf0.001")
    assert len(between) == 2 and between[0] == between[1]
    ranges = catalogue_lake._RANGES[lake.root]
    assert len(ranges) == 8 and sum(ranges) == lake.read(spark, "raw", "transactions").count()


def test_balanced_cuts():
    rng = random.Random(4)
    for keys in ([rng.randrange(10) for _ in range(1000)], [int(rng.lognormvariate(10, 5)) for _ in range(1000)], [5] * 400 + list(range(600)), [0], list(range(8)), [-50, -3, 10**15]):
        asked = []

        def histogram(low, width, high, keys=keys, asked=asked):
            asked.append(low)
            return sorted(Counter((k - low) // width for k in keys if low <= k < high).items())

        cuts = readers.balanced_cuts(histogram, min(keys), max(keys), 8)
        sizes = Counter(sum(c <= k for c in cuts) for k in keys)
        most = Counter(keys).most_common(1)[0][1]
        assert cuts == sorted(set(cuts)) and len(cuts) <= 7 and len(asked) < 200
        assert max(sizes.values()) <= max(1.5 * len(keys) / 8 + 1, most + len(keys) / 8)


def test_append_and_retention(spark, tmp_path):
    rows = spark.createDataFrame([(2024, 1, 1, "a"), (2024, 1, 2, "b")], "year int, month int, day int, x string")
    for _ in range(2):
        with Lake(str(tmp_path)).change(spark) as change:
            change.append("z", "t", rows, readers.DAY)
    assert sorted(r.x for r in Lake(str(tmp_path)).read(spark, "z", "t").collect()) == ["a", "a", "b", "b"]
    bad = spark.createDataFrame([("open", None), ("new", datetime(2024, 2, 20)), ("old", datetime(2024, 1, 1))], "x string, resolved_at timestamp")
    assert sorted(r.x for r in writers.retained(bad, F.lit("2024-03-01").cast("date")).collect()) == ["new", "open"]


def test_activity(spark, tmp_path):
    """Windows add up; what comes after the watermark has passed its window is left out."""
    at = lambda day, hour, minute=0: datetime(2018, 6, day, hour, minute)
    batches = [[("u", at(15, 10), 1.0), ("u", at(15, 10, 30), 2.0), ("v", at(20, 1), 5.0)], [("v", at(20, 2), 7.0)], [("u", at(15, 10, 45), 100.0)]]
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(batches):
        file = source / f"{i}.json"
        file.write_text("\n".join(f'{{"user_id": "{u}", "transaction_date": "{t.isoformat()}Z", "amount": {a}}}' for u, t, a in rows))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("user_id string, transaction_date timestamp, amount double").option("maxFilesPerTrigger", 1).json(str(source))
    query = labels.activity(stream).writeStream.format("memory").queryName("activity").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.user_id, r.start, r.txn_count, r.amount_sum) for r in spark.table("activity").select("user_id", F.date_format("window.start", "d H").alias("start"), "txn_count", "amount_sum").collect()}
    assert got == {("u", "15 10", 2, 3.0), ("v", "20 1", 1, 5.0), ("v", "20 2", 1, 7.0)}
