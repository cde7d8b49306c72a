"""Readers: partitioned Parquet, JDBC in ranges, CSV, JSON objects of labels; and the raw shapes of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = ["year", "month", "day"]
#: Connections by table, as far as the source stands them.
CONNECTIONS = {"transactions": 8, "users": 4, "cards": 4, "fraud_labels": 4, "mcc_codes": 1}
#: Cells in which the source counts the keys of a range.
CELLS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, or none where there is no folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet at path, or no rows of that schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def day_column() -> Column:
    return F.make_date("year", "month", "day")


def days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Rows of the day partitions from first to last. The condition is on partition columns alone, so that other folders aren't read."""
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    as_number = lambda d: d.year * 10000 + d.month * 100 + d.day
    return spark.read.parquet(path).filter(number.between(as_number(first), as_number(last)))


def balanced_cuts(histogram: Callable[[int, int, int], list[tuple[int, int]]], low: int, high: int, parts: int, fine: int = 64) -> list[int]:
    """Keys at which low..high is cut into parts of about equally many rows. histogram(low, width, high) counts rows by (key - low) // width, for keys from low to below high."""
    return cuts_by_level(lambda ranges: [histogram(*r) for r in ranges], [(low, high + 1)], parts, fine)


def cuts_by_level(histograms: Callable[[list[tuple[int, int, int]]], list[list[tuple[int, int]]]], ranges: list[tuple[int, int]], parts: int, fine: int) -> list[int]:
    """Keys at which ranges, from the first key to before the second, are cut into parts of about equally many rows.

    histograms([(low, width, high), ...]) counts rows of each range by (key - low) // width, for keys from low to below high, of all ranges of a level at once. A cell with more than a fourth of a
    part's rows is a range of the next level, so that where keys are is found by a few counts, whatever their distribution; rows of one key stay together.
    """
    cells, total = [], None
    while ranges:
        asked = [(start, -(-(end - start) // fine), end) for start, end in ranges]
        found = [(start + b * width, min(end, start + (b + 1) * width), n) for (start, width, end), counts in zip(asked, histograms(asked), strict=True) for b, n in counts]
        total = total or sum(n for _, _, n in found)
        heavy = [c for c in found if c[2] * 4 * parts > total and c[1] - c[0] > 1]
        ranges = [c[:2] for c in heavy]
        cells += [c for c in found if c not in heavy]
    cuts, so_far = [], 0
    for start, _, n in sorted(cells):
        # A cell goes to the part in which its middle lies.
        while len(cuts) < parts - 1 and so_far and (so_far + n / 2) * parts > total * (len(cuts) + 1):
            cuts.append(start)
        so_far += n
    return sorted(set(cuts))


def jdbc(spark: SparkSession, url: str, name: str, properties: dict[str, str], column: str | None = None, connections: int = 1, fetch_rows: int = 10_000) -> DataFrame:
    """A table over JDBC. With a column of numbers in text form, as so many ranges of it at once, each read by its own task and with about as many rows as the others, which the source
    counts; rows without a number are in the first range. The source has no order by that number, so that each count goes over the whole table: one is enough unless a few numbers have many rows."""
    # A reader keeps the options that it was given, so that each load takes one of its own.
    reader = lambda: spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_rows)).options(**properties)
    if not column or connections < 2:
        return reader().option("dbtable", name).load()
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    number = f"CAST(REPLACE({quoted}, '-', '0') AS BIGINT)"  # never below zero

    def histograms(ranges: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
        cases = " ".join(f"WHEN k >= {low}{f' AND k < {high}' * (high < 1 << 63)} THEN {i * CELLS} + (k - {low}) / {width}" for i, (low, width, high) in enumerate(ranges))
        cells = f"SELECT CASE {cases} END AS b FROM (SELECT {number} AS k FROM {name}) r"
        found = [[] for _ in ranges]
        for b, n in reader().option("query", f"SELECT b, COUNT(*) AS n FROM ({cells}) s GROUP BY b").load().collect():
            if b is not None:
                found[int(b) // CELLS].append((int(b) % CELLS, int(n)))
        return found

    # By number of digits first, as ids of more digits may be few and far off.
    cuts = cuts_by_level(histograms, [(10**d if d else 0, min(10 ** (d + 1), 1 << 63)) for d in range(19)], connections, CELLS)
    edges = [None, *cuts, None]
    predicates = [" AND ".join([f"range_key >= {a}"] * (a is not None) + [f"range_key < {b}"] * (b is not None)) or "1 = 1" for a, b in zip(edges, edges[1:], strict=False)]
    if cuts:
        predicates[0] = f"({predicates[0]} OR range_key IS NULL)"
    return spark.read.jdbc(url, f"(SELECT t.*, {number} AS range_key FROM {name} t) r", predicates=predicates, properties=properties | {"fetchsize": str(fetch_rows)}).drop("range_key")


def csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text; an empty field is null, quotes inside quotes are doubled."""
    return spark.read.csv(path, schema=", ".join(f"`{c}` string" for c in columns), header=True, nullValue="", escape='"', mode="PERMISSIVE")


def json_pairs(df: DataFrame, column: str) -> DataFrame:
    """(key, value) of each JSON object of text values in column, or of the one under "target" in it; the first value of a key in text order."""
    whole = F.from_json(column, "map<string,string>")
    inner = F.coalesce(F.from_json(whole["target"], "map<string,string>"), whole)
    return df.select(F.explode(inner).alias("key", "value")).groupBy("key").agg(F.min("value").alias("value"))


def with_lineage(df: DataFrame, source: str, batch: str, at: Column) -> DataFrame:
    return df.withColumns({"_ingested_at": at, "_source_file": F.lit(source), "_batch_id": F.lit(batch)})


def raw_transactions(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """events in the shape of the raw transaction feed: all text, amounts in eight notations, one row in ten sent twice. A feed by day has few days in each of its parts."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    if by_day:  # events are narrower than the texts that are made of them
        e = e.withColumn("day", F.to_date("ts")).hint("rebalance", "day")
    twice = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = e.withColumn("again", F.explode(twice))
    # A feed comes in many files, with its texts ready made.
    e = e.selectExpr(*RAW_COLUMNS)
    return e if by_day else e.repartition(spark.sparkContext.defaultParallelism)


# The same expressions serve Spark and, where they are plain SQL, the comparison in DuckDB.
_WHOLE, _CENTS = "(event_id * 7919 % 5000)", "lpad(cast(event_id * 7919 % 100 as string), 2, '0')"
AMOUNT_SQL = f"""case event_id % 8 when 0 then concat('$', {_WHOLE}, '.', {_CENTS}) when 1 then concat('$-', {_WHOLE}, '.', {_CENTS})
 when 2 then concat({_WHOLE}, ',', {_CENTS}) when 3 then concat('(', {_WHOLE}, '.', {_CENTS}, ')') when 4 then concat('₫', {_WHOLE}, ',000')
 when 5 then 'N/A' when 6 then concat({_WHOLE}, ',234') else concat('USD ', {_WHOLE}, '.', {_CENTS}) end"""
RAW_COLUMNS = [
    "cast(event_id as string) as id",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss') as date",
    "cast(user_id as string) as client_id",
    "cast(user_id * 10 + event_id % 3 as string) as card_id",
    f"{AMOUNT_SQL} as amount",
    "case event_id % 3 when 0 then 'Swipe Transaction' when 1 then 'Chip Transaction' else 'Online Transaction' end as use_chip",
    "cast(event_id % 97 as string) as merchant_id",
    "case when event_type = 'click' then 'Online' else concat('City', event_id % 5) end as merchant_city",
    "case when event_type = 'click' then null when event_id % 5 = 0 then 'DC' when event_id % 5 = 1 then 'CA' else 'NY' end as merchant_state",
    "case event_id % 4 when 0 then '58523.0' when 1 then '1234.0' when 2 then null else 'abc' end as zip",
    "cast(5000 + event_id % 7 as string) as mcc",
    "case event_id % 11 when 0 then 'Bad PIN,Technical Glitch' when 1 then 'Insufficient Balance' else null end as errors",
    "again",
]
