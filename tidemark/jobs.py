"""Jobs that read tables of a lake and change others: ingest, clean, enrich, dimensions, features, index, late labels, restatement, upkeep.

Each takes the session, the lake and the day or the date of knowledge that it runs for; none asks for the time of day. What a job writes is published at once, when it
is complete (`sources.lake`); a job that fails leaves all tables as they were, one that is run again leaves the same tables. Several jobs can share a change
and are then published together. Days are whole partitions, and only those that a job touches are written.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.cleaning import yes_or_no
from tidemark.operators import audit, features, tables
from tidemark.plans import transactions as T
from tidemark.sources import readers, writers
from tidemark.sources.lake import NULL_PARTITION, Change, Lake, day_number
from tidemark.sources.readers import DAY

HISTORY = "transaction_id string, is_fraud boolean, is_fraud_raw string, source_batch_id string, _recorded_at timestamp, knowledge_date date"
MANIFEST = "change_id string, transaction_id string, event_date date, old_is_fraud boolean, new_is_fraud boolean, change_type string, _detected_at timestamp, _batch_id string, year int, month int, day int, knowledge_date date"
LEDGER = "change_id string, transaction_id string, event_date date, knowledge_date date, applied_at timestamp, status string, partitions_touched string, _batch_id string"
SNAPSHOTS = "report_date date, snapshot_type string, fraud_txn_count bigint, fraud_amount_sum double, total_txn_count bigint, total_amount_sum double, _snapshotted_at timestamp, _batch_id string, knowledge_date date"
#: Optional columns of features: absent ones come as null.
FEATURE_COLUMNS = {"card_on_dark_web": "boolean", "is_fraud": "boolean", "mcc_description": "string", "risk_score": "int"}
#: What enrich adds to staged transactions.
ENRICHED = ["mcc_description", "card_brand", "card_type", "card_on_dark_web", "is_fraud"]


def _at(day: date) -> Column:
    return F.lit(day).cast("timestamp")


@contextmanager
def _changing(spark: SparkSession, lake: Lake, change: Change | None) -> Iterator[Change]:
    """The change that a job is part of, or one of its own."""
    if change is not None:
        yield change
    else:
        with lake.change(spark) as own:
            yield own


def _names(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.split(",")]


def ingest(
    spark: SparkSession, lake: Lake, name: str, source: DataFrame, day: date, batch: str, keys: Callable[[DataFrame], DataFrame] | None = None, by: list[str] = DAY, whole: bool = False, change: Change | None = None, gathered: bool = False
) -> dict:
    """Raw rows of a source as they are, with where they came from; partitioned if keys derives the columns of by (year, month and day). Partitions that don't come stay, or go if the source is
    delivered as a whole. A source that is gathered has few partitions in each of its parts, and isn't dealt by them. Card verification numbers don't enter. Returns the rows and, if the source has an id, those without one, counted while they were written."""
    rows = source.drop("cvv") if not keys else keys(source.drop("cvv")) if gathered else keys(source.drop("cvv")).hint("rebalance", *by)
    rows = readers.with_lineage(rows, name, batch, _at(day))  # what all rows have alike isn't shuffled
    key = next((c for c in ("id", "transaction_id") if c in rows.columns), None)
    with _changing(spark, lake, change) as change:
        count = {"null_keys": F.count_if(F.col(key).isNull())} if key else None
        got = change.put("raw", name, rows, by, change.partitions("raw", name) if whole else None, count=count, gathered=True) if keys else change.put("raw", name, rows, count=count)
    return {"table": name, "batch": batch, **got}


def transaction_days(rows: DataFrame) -> DataFrame:
    return T.with_day(rows.withColumn("__day", F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd HH:mm:ss")))), "__day").drop("__day")


def birth_month(rows: DataFrame) -> DataFrame:
    """Users by year and month of birth; what is no number is null."""
    return rows.withColumns({"created_year": F.col("birth_year").try_cast("int"), "created_month": F.col("birth_month").try_cast("int")})


def brand_and_expiry(rows: DataFrame) -> DataFrame:
    """Cards by brand in lower case and year of expiry, the second part of month/year."""
    return rows.withColumns({"card_brand_part": F.lower("card_brand"), "expires_year_part": F.get(F.split("expires", "/"), F.lit(1)).try_cast("int")})


@dataclass(frozen=True)
class Source:
    """How a table of the source is kept: what derives its partition columns, and whether it comes as a whole each time."""

    keys: Callable[[DataFrame], DataFrame] | None = None
    by: tuple[str, ...] = ()
    whole: bool = True


#: The tables of the source, in the order in which later jobs need them.
SOURCES: dict[str, Source] = {
    "mcc_codes": Source(),
    "fraud_labels": Source(),
    "users": Source(birth_month, ("created_year", "created_month")),
    "cards": Source(brand_and_expiry, ("card_brand_part", "expires_year_part")),
    "transactions": Source(transaction_days, tuple(DAY), whole=False),
}


def ingest_all(spark: SparkSession, lake: Lake, sources: dict[str, DataFrame], day: date, batch: str, gathered: Collection[str] = ()) -> list[dict]:
    """All sources at the same time, as one may be read by few tasks, and published together; those named gathered come by their partitions."""
    todo = {name: s for name, s in SOURCES.items() if name in sources}
    # Each write sets how it is planned and puts it back, here to the same.
    with lake.change(spark) as change, writers.in_parts(spark), ThreadPoolExecutor(len(SOURCES)) as pool:
        return list(pool.map(lambda name: ingest(spark, lake, name, sources[name], day, batch, todo[name].keys, list(todo[name].by), todo[name].whole, change, name in gathered), todo))


def jdbc_sources(spark: SparkSession, url: str, properties: dict[str, str]) -> dict[str, DataFrame]:
    """The source's tables over JDBC, each with as many connections as readers.CONNECTIONS grants it. Their ranges are counted at the same time."""
    column = {name: "transaction_id" if name == "fraud_labels" else "id" for name in SOURCES}
    read = lambda name: readers.jdbc(spark, url, name, properties, column[name], readers.CONNECTIONS[name])
    with ThreadPoolExecutor(len(SOURCES)) as pool:
        return dict(zip(SOURCES, pool.map(read, SOURCES), strict=True))


def clean(spark: SparkSession, lake: Lake, at: date, first: date | None = None, last: date | None = None, change: Change | None = None) -> dict:
    """Raw transactions of the days first to last, or of all, to staging and quarantine. Of each id the latest row in that scope counts. Days without rows for
    either table lose what they had there, so that a better second run leaves no stale quarantine. What enrich had added to a transaction stays with its id until enrich runs again.

    Raw rows are read and parsed once; returns how many ids there were, how many of them were accepted and rejected, and rows without an id.
    """
    return _clean(spark, lake, at, first, last, change)[0]


def clean_and_enrich(spark: SparkSession, lake: Lake, at: date, first: date | None = None, last: date | None = None, change: Change | None = None) -> tuple[dict, dict]:
    """`clean` and then `enrich` of the same days, for which staging is written once. Returns what the two say."""
    return _clean(spark, lake, at, first, last, change, with_facts=True)


def _clean(spark: SparkSession, lake: Lake, at: date, first: date | None, last: date | None, change: Change | None, with_facts: bool = False) -> tuple[dict, dict]:
    with _changing(spark, lake, change) as change:
        raw, scope, aside, seen = change.read("raw", "transactions", first, last), change.partitions("raw", "transactions", first, last), writers.work_folder(spark), Observation()
        rows = _latest_by_day(spark, change, raw, first, last, f"{aside}/keys", with_facts)
        facts = ENRICHED[1:] if with_facts else []
        rows = T.typed_transactions(rows, facts).withColumn("__valid", F.coalesce(T.is_valid(), F.lit(False)))
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if("__valid").alias("accepted"), F.count_if(~F.col("__valid")).alias("rejected"), F.count_if(F.col("transaction_id").isNull()).alias("null_keys")]
        with writers.in_parts(spark):
            rows.observe(seen, *counts).write.parquet(f"{aside}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{aside}/rows")
        good, kept = T.with_day(rows.filter("__valid").drop("__valid")), not with_facts and change.has("staging", "transactions", "is_fraud")
        if with_facts:
            good = T.add_category(good, F.broadcast(change.read("staging", "mcc_codes")))  # codes have four digits
        elif kept:
            known = change.read("staging", "transactions", first, last).select("transaction_id", "event_date", *ENRICHED)
            good = good.join(tables.latest(known, ["transaction_id"], [F.desc("event_date")], seldom=True).drop("event_date"), "transaction_id", "left")
        found = change.put("staging", "transactions", good, DAY, scope, gathered=not kept, count=_found() if with_facts else None)
        change.put("quarantine", "transactions", T.quarantine_rows(rows.filter("not __valid").drop("__valid", *facts), _at(at)), DAY, scope, gathered=True)
        writers.discard(spark, aside)
    return seen.get, found


def _latest_by_day(spark: SparkSession, change: Change, raw: DataFrame, first: date | None, last: date | None, aside: str, with_facts: bool) -> DataFrame:
    """Of each id the latest raw row, dealt by day, so that what comes of it can be written as gathered; with the facts of its card and its label, if they are asked for.

    Wide rows are dealt by day alone, and the latest of an id is taken within its day. Narrow keys, kept aside, tell which ids are on several days: of these alone the latest of their days is
    taken, by id. Rows without an id count as one id.
    """
    names = [c for c in raw.columns if c not in (*DAY, "_ingested_at", "_source_file")]
    order = [F.desc_nulls_last("_loaded_at")] * ("_loaded_at" in names) + [F.xxhash64(*[F.col(f"`{c}`") for c in names])]
    part, several, card, seen = change.part_of_day("raw", "transactions", first, last), Window.partitionBy("id"), ["card_id"] * with_facts, Observation()
    keys = raw.select("id", *card, day_number().alias("__day"))
    if with_facts:
        cards = change.read("staging", "cards").select("card_id", "card_brand", "card_type", "card_on_dark_web")
        keys = keys.join(cards, "card_id", "left").repartition("id").distinct().join(labels_by_id(change.read("raw", "fraud_labels")).withColumnRenamed("transaction_id", "id"), "id", "left")
    else:
        keys = keys.repartition("id").distinct()
    keys = keys.withColumn("__several", (F.min("__day").over(several) != F.max("__day").over(several)) | F.col("id").isNull())
    keys = keys if with_facts else keys.filter("__several")
    with writers.in_parts(spark):
        keys.observe(seen, F.count_if("__several").alias("several")).write.parquet(aside)
    # Raw rows are narrower than parsed ones, and those that go needn't be parsed. Sorted after the shuffle, as ids seldom repeat; the hash is worked out there.
    rows = raw.select(*names, day_number().alias("__day")).withColumn("__part", part("id", F.col("__day"))).repartition("__day", "__part")
    rows = rows.withColumn("__before", F.lag(F.lit(1)).over(Window.partitionBy("__day", "__part", "id").orderBy(*order))).filter("__before is null").drop("__before")
    if with_facts or seen.get["several"]:
        side = spark.read.schema(keys.schema).parquet(aside).withColumnsRenamed({c: f"{c}_" for c in ("id", "__day", *card)})
        side = side.withColumn("__part_", part("id_", F.col("__day_"))).repartition("__day_", "__part_")
        same = [F.col(c) == F.col(f"{c}_") for c in ("__day", "__part", "id")] + [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in card]
        rows = rows.join(side, reduce(and_, same), "left").drop(*(c for c in side.columns if c.endswith("_")))
    if seen.get["several"]:
        several = F.coalesce(F.col("__several"), F.col("id").isNull())
        once = tables.latest(rows.filter(several), ["id"], order, seldom=True).repartition("__day", "__part")
        rows = rows.filter(~several).unionByName(once)
    return rows


def clean_dimensions(spark: SparkSession, lake: Lake, day: date, change: Change | None = None) -> None:
    """Users, cards and categories, each as a whole; of several rows of a key the one ingested last."""
    with _changing(spark, lake, change) as change:
        users, cards = (change.read("raw", name).drop(*SOURCES[name].by) for name in ("users", "cards"))
        # Raw rows are narrower than clean ones.
        latest = lambda rows: tables.latest(rows.filter("id is not null"), ["id"], [F.desc_nulls_last(c) for c in ("_loaded_at", "_ingested_at") if c in rows.columns], seldom=True)
        change.put("staging", "users", T.clean_users(latest(users)))
        change.put("staging", "cards", T.clean_cards(latest(cards), F.lit(day)))
        change.put("staging", "mcc_codes", T.clean_categories(change.read("raw", "mcc_codes")), files=1)


def labels_of(raw: DataFrame) -> DataFrame:
    """(transaction_id, is_fraud, is_fraud_raw) of raw labels, each id once: true, false or null."""
    rows = raw.select("transaction_id", F.col("is_fraud").alias("is_fraud_raw"), yes_or_no(F.col("is_fraud")).alias("is_fraud"))
    return tables.latest(rows.filter("transaction_id is not null"), ["transaction_id"], [F.desc_nulls_last("is_fraud")], seldom=True)


def labels_by_id(raw: DataFrame) -> DataFrame:
    """(transaction_id, is_fraud) of `labels_of`: of several labels true counts before false, and null last."""
    return raw.filter("transaction_id is not null").groupBy("transaction_id").agg(F.max(yes_or_no(F.col("is_fraud"))).alias("is_fraud"))


def _found() -> dict[str, Column]:
    return {"with_category": F.count_if(F.col("mcc_description") != "UNKNOWN"), "with_card": F.count("card_brand"), "with_label": F.count("is_fraud")}


def enrich(spark: SparkSession, lake: Lake, first: date | None = None, last: date | None = None, change: Change | None = None) -> dict:
    """Staged transactions with category texts, card facts and labels, written over the days that were read. Returns the rows, and those that found a
    category, a card and a label, counted while they were written."""
    with _changing(spark, lake, change) as change:
        rows = change.read("staging", "transactions", first, last).drop(*ENRICHED)
        cards = change.read("staging", "cards").select("card_id", "card_brand", "card_type", "card_on_dark_web")
        labels = labels_by_id(change.read("raw", "fraud_labels"))
        # Keys alone go to cards and labels; an id is in a day once, as it is cleaned by days, and has a day.
        facts = T.add_facts(rows.select("transaction_id", "card_id", *DAY), cards, labels).drop("card_id")
        out = T.add_category(rows, F.broadcast(change.read("staging", "mcc_codes")))  # codes have four digits
        out = change.join_by_day("staging", "transactions", out, facts, "transaction_id", first, last)
        return change.put("staging", "transactions", out, DAY, gathered=True, count=_found())


def dimensions(spark: SparkSession, lake: Lake, day: date, tracked: list[str], change: Change | None = None) -> None:
    """Users as versions, cards as they are now."""
    with _changing(spark, lake, change) as change:
        users = change.read("staging", "users")
        dim = change.read("warehouse", "dim_users", default=users.select("user_id", *tracked, F.lit(day).alias("valid_from"), F.lit(day).alias("valid_to"), F.lit(True).alias("is_current")).schema)
        change.put("warehouse", "dim_users", tables.merge_versions(dim, users, "user_id", tracked, F.lit(day)))
        change.put("warehouse", "dim_cards", change.read("staging", "cards"))


def build_features(spark: SparkSession, lake: Lake, day: date | None = None, history_days: int = 7, change: Change | None = None) -> dict:
    """Features of a day, with history_days of look-back for its windows and means, or of all days with all history."""
    with _changing(spark, lake, change) as change:
        rows = change.read("staging", "transactions", day and day - timedelta(days=history_days), day)
        more = {c: F.lit(None).cast(t) for c, t in FEATURE_COLUMNS.items() if c not in rows.columns}
        out = features.point_in_time(rows.withColumns(more | {"amount": F.col("amount").cast("double")}))
        out = out.filter(F.col("event_date") == F.lit(day)) if day else out
        names = ["transaction_id", "user_id", "event_date", "amount", *FEATURE_COLUMNS, *(c for c in out.columns if c.startswith(("txn_", "amount_", "is_night", "is_week", "is_foreign")) and c not in ("amount_raw", "amount_format", "amount_currency"))]
        return change.put("warehouse", "fraud_features", out.select(*names, *DAY), DAY)


def build_index(spark: SparkSession, lake: Lake, at: date, batch: str, first: date | None = None, last: date | None = None, change: Change | None = None) -> dict:
    with _changing(spark, lake, change) as change:
        return change.put("audit", "transaction_index", T.index_of(change.read("staging", "transactions", first, last).drop(*DAY), _at(at), batch), DAY, gathered=True)


def detect(spark: SparkSession, lake: Lake, knowledge_date: date, batch: str, change: Change | None = None) -> dict:
    """What the labels of knowledge_date change: to the manifest, and to the history that later runs compare with. The first run has nothing to compare with: it
    writes all its labels as the baseline and changes nothing (enrich gives them to transactions that are indexed later). In later runs labels of transactions that the
    index lacks wait outside history and are found again."""
    with _changing(spark, lake, change) as change:
        known, now = change.read("audit", "label_history", default=HISTORY), labels_of(change.read("raw", "fraud_labels"))
        known = known.filter(F.col("knowledge_date") < F.lit(knowledge_date))  # a run that is repeated replaces what it wrote
        named = lambda df: df.select("transaction_id", "is_fraud", "is_fraud_raw", F.lit(batch).alias("source_batch_id"), _at(knowledge_date).alias("_recorded_at"), F.lit(knowledge_date).alias("knowledge_date"))
        if known.isEmpty():
            change.put("audit", "label_history", named(now), ["knowledge_date"], gathered=True)
            return {"mode": "baseline", "changes": 0}
        # Labels are compared once; manifest and history come from what was found.
        changes, aside = T.with_day(audit.label_changes(now, known, change.read("audit", "transaction_index"), F.lit(knowledge_date), ["is_fraud_raw"])), writers.work_folder(spark)
        with writers.in_parts(spark):
            audit.with_first_day(changes).write.parquet(aside)
        changes = spark.read.parquet(aside).withColumns({"_detected_at": _at(knowledge_date), "_batch_id": F.lit(batch)})
        scope, applicable = [f"knowledge_date={knowledge_date}"], F.count_if(F.col("change_type") != "UNINDEXED")
        got = change.put("audit", "impact_manifest", changes.select(*_names(MANIFEST)), ["knowledge_date"], scope, gathered=True, count={"changes": applicable})
        change.put("audit", "label_history", named(changes.filter("change_type <> 'UNINDEXED' and first_day").withColumnRenamed("new_is_fraud", "is_fraud")), ["knowledge_date"], scope, gathered=True)
        writers.discard(spark, aside)
        return {"mode": "changes", "changes": got["changes"]}


def restate(spark: SparkSession, lake: Lake, knowledge_date: date, batch: str, change: Change | None = None) -> dict:
    """Applies the changes found up to knowledge_date that the ledger doesn't have: the touched days of staging and of the index with the new labels, reports of these days
    before and after, and the ledger, all published together. Without changes it does nothing.

    Of a day and date of knowledge the first report of before stays, and the last one of after, so that what two runs on one date have done is the difference of the two.
    """
    with _changing(spark, lake, change) as change:
        manifest = change.read("audit", "impact_manifest", default=MANIFEST).filter(F.col("knowledge_date") <= F.lit(knowledge_date))
        todo, aside = audit.pending(manifest, change.read("audit", "applied_ledger", default=LEDGER)), writers.work_folder(spark)
        with writers.in_parts(spark):
            todo.write.parquet(aside)
        todo = spark.read.parquet(aside)
        # Of each touched day the partition is read whole; the list is as long as the days that late labels reach.
        touched = [r.event_date for r in todo.select("event_date").distinct().orderBy("event_date").collect()]
        if not touched:
            writers.discard(spark, aside)
            return {"changes": 0, "days": 0}
        staged = lambda: change.read("staging", "transactions", touched[0], touched[-1]).filter(readers.day_column().isin(touched))
        before = staged()
        last_ones = tables.latest(todo, ["transaction_id"], [F.desc("knowledge_date")], seldom=True)
        # Keys alone go to the changes, whichever day these say.
        keys = before.select("transaction_id", *DAY).repartition("transaction_id").distinct()
        news = keys.join(last_ones.select("transaction_id", "new_is_fraud", "change_type"), "transaction_id")
        out = audit.relabelled(change.join_by_day("staging", "transactions", before, news, "transaction_id", touched[0], touched[-1]))
        change.put("staging", "transactions", out.select(*before.columns), DAY, gathered=True)
        after = staged()
        _report(change, before, after, knowledge_date, batch)
        change.put("audit", "transaction_index", T.index_of(after.drop(*DAY), _at(knowledge_date), batch), DAY, gathered=True)
        # All that was pending is applied: of several changes of one transaction the last one holds.
        done = todo.select("change_id", "transaction_id", "event_date", F.lit(knowledge_date).alias("knowledge_date"), _at(knowledge_date).alias("applied_at"), F.lit("APPLIED").alias("status"), F.col("event_date").cast("string").alias("partitions_touched"), F.lit(batch).alias("_batch_id"))
        got = change.append("audit", "applied_ledger", done)
        writers.discard(spark, aside)
        return {"changes": got["rows"], "days": len(touched)}


def _report(change: Change, before: DataFrame, after: DataFrame, knowledge_date: date, batch: str) -> None:
    """Daily reports of the days before and after, with those of the same date of knowledge that are there: of before the older one stays, of after the newer one."""
    more = lambda kind: {"report_date": F.col("event_date"), "snapshot_type": F.lit(kind), "knowledge_date": F.lit(knowledge_date), "_snapshotted_at": _at(knowledge_date), "_batch_id": F.lit(batch)}
    report = lambda rows, kind: audit.daily_report(rows).withColumns(more(kind)).select(*_names(SNAPSHOTS))
    there = change.read("audit", "report_snapshots", default=SNAPSHOTS).filter(F.col("knowledge_date") == F.lit(knowledge_date)).select(*_names(SNAPSHOTS))
    was, is_now = there.filter("snapshot_type = 'BEFORE'"), report(after, "AFTER")
    out = was.unionByName(report(before, "BEFORE").join(was, "report_date", "left_anti"))
    out = out.unionByName(there.filter("snapshot_type = 'AFTER'").join(is_now, "report_date", "left_anti")).unionByName(is_now)
    change.put("audit", "report_snapshots", out, ["knowledge_date"])


def reconcile(spark: SparkSession, lake: Lake, first: date | None = None, last: date | None = None) -> DataFrame:
    """Raw, repeated, accepted and quarantined rows of each day, written to audit and returned from there."""
    with lake.change(spark) as change:
        read = lambda zone: change.read(zone, "transactions", first, last)
        raw = read("raw").select(F.col("id").alias("transaction_id"), readers.day_column().alias("event_date"))
        change.put("audit", "reconciliation", T.with_day(audit.reconcile(raw, read("staging"), read("quarantine"))), DAY)
    return lake.read(spark, "audit", "reconciliation", first, last)


def raw_checks(spark: SparkSession, lake: Lake, day: date) -> None:
    """Raises if the day has no raw transactions, or some without an id, or there are no categories."""
    found = lake.read(spark, "raw", "transactions", day, day).agg(F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("no_id")).first()
    if not found.n or found.no_id or lake.read(spark, "raw", "mcc_codes").isEmpty():
        raise ValueError(f"raw data of {day}: {found.n} transactions, {found.no_id} without id")


def vacuum_quarantine(spark: SparkSession, lake: Lake, today: date, keep_days: int = 30) -> int:
    """Drops what was resolved more than keep_days ago; only days that lose rows are written, and those that lose all of them go. Returns the number of these days."""
    with lake.change(spark) as change:
        rows = change.read("quarantine", "transactions")
        old = rows.filter(F.to_date("resolved_at") < F.date_sub(F.lit(today), keep_days)).select(*DAY).distinct().collect()
        if not old:
            return 0
        days = F.broadcast(spark.createDataFrame(old, "y int, m int, d int"))  # one row for each partition at most
        there = rows.join(days, F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m")) & F.col("day").eqNullSafe(F.col("d")), "left_semi")
        change.put("quarantine", "transactions", writers.retained(there, F.lit(today), keep_days), DAY, [partition_of(r) for r in old])
    return len(old)


def partition_of(day: date | tuple) -> str:
    year, month, day_no = (day.year, day.month, day.day) if isinstance(day, date) else day
    return "/".join(f"{c}={NULL_PARTITION if v is None else v}" for c, v in zip(DAY, (year, month, day_no), strict=True))


def _compacted(spark: SparkSession, lake: Lake, change: Change, zone: str, name: str, first: date, last: date, key: str | None, file_bytes: int) -> tuple[DataFrame, int]:
    """Rows of the days, each key once if one is given, and how many of them make a file of file_bytes, by what they take now."""
    found = change.read(zone, name, first, last)
    table = change.state.tables[f"{zone}/{name}"]
    paths = [f"{lake.path(zone, name)}/{v}/{p}" for p in table.select(first, last) for v in table.parts[p]]
    return (tables.latest(found, [key], [], seldom=True) if key else found), writers.file_rows(spark, paths, found.count(), file_bytes)


def compact_day(spark: SparkSession, lake: Lake, zone: str, name: str, day: date, key: str | None = None, sort: str | None = None) -> None:
    with lake.change(spark) as change:
        rows, most = _compacted(spark, lake, change, zone, name, day, day, key, writers.FILE_BYTES)
        change.put(zone, name, rows, DAY, gathered=key is not None, file_rows=most, sort=sort)  # of one partition, and dealt by key


def compact_month(spark: SparkSession, lake: Lake, zone: str, name: str, year: int, month: int, key: str | None = None, sort: str | None = None, move: bool = True) -> None:
    """The month in fewer, larger files, more strongly compressed, in the table warm/name by year and month. With move its days leave the lake's own table in the
    same change, so that `tiers` finds each row once at any time."""
    first, last = date(year, month, 1), (date(year, month, 28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
    with lake.change(spark) as change:
        rows, most = _compacted(spark, lake, change, zone, name, first, last, key, writers.WARM_FILE_BYTES)
        change.put("warm", name, rows, DAY[:2], gathered=key is not None, file_rows=most, sort=sort, compression="zstd")
        if move:
            change.drop(zone, name, change.partitions(zone, name, first, last))


def tiers(spark: SparkSession, lake: Lake, zone: str, name: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows of a table whose older months were moved to the warm tier: those months from there, other days from the table itself, all of one published state."""
    state = lake.state(spark)
    hot = lake._read(spark, state, f"{zone}/{name}", first, last)
    if f"warm/{name}" not in state.tables:
        return hot
    warm = lake._read(spark, state, f"warm/{name}")
    if first:
        month = F.col("year") * 100 + F.col("month")
        end = last or first
        warm = warm.filter(month.between(first.year * 100 + first.month, end.year * 100 + end.month) & readers.day_column().between(F.lit(first), F.lit(end)))
    return hot.unionByName(warm, allowMissingColumns=True)


def append_batch(spark: SparkSession, lake: Lake, zone: str, name: str, rows: DataFrame, column: str, key: str, change: Change | None = None) -> dict:
    """Adds those rows whose column is above the table's high-water mark, or at it with a key that isn't there yet, and moves the mark, in one change. A batch that comes again adds
    nothing, and one that brings more rows of the last moment adds these; rows without a column are never newer, a key that repeats at one moment counts once."""
    with _changing(spark, lake, change) as change:
        mark = change.mark(zone, name, column)
        fresh = rows.filter(F.col(column).isNotNull()).dropDuplicates([key, column])
        if mark is not None:
            at = F.lit(mark).cast(rows.schema[column].dataType)
            last_ones = change.read(zone, name).filter(F.col(column) >= at).select(key, column)
            fresh = fresh.filter(F.col(column) >= at).join(last_ones, [key, column], "left_anti")
        got = change.append(zone, name, fresh, count={"mark": F.max(column).cast("string")})
        if got["mark"] is not None:
            change.mark(zone, name, column, got["mark"])
        return {"rows": got["rows"], "mark": change.mark(zone, name, column)}


def relabel(spark: SparkSession, lake: Lake, transaction_id: str, day: date, is_fraud: bool | None) -> None:
    """Gives one transaction of a day another label, in staging and in the index."""
    with lake.change(spark) as change:
        for zone, name in (("staging", "transactions"), ("audit", "transaction_index")):
            rows = change.read(zone, name, day)
            change.put(zone, name, rows.withColumn("is_fraud", F.when(F.col("transaction_id") == transaction_id, F.lit(is_fraud).cast("boolean")).otherwise(F.col("is_fraud"))), DAY, gathered=True)
