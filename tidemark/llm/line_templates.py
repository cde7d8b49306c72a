"""Line dedup by trees of log templates: token count, leading or last tokens, then tokens as common in their place as the line's others; the rest is variable."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, key_of, map_texts, small_side, spare, text_or_empty, written

#: Bytes up to which a narrow side is broadcast here: few, so that a table of any size is joined in the same way.
NARROW = 128 << 10
#: Depth of the tree below the token count: so many leading tokens.
LEADING = 3
#: Documents that a template must occur in to be recurring.
DOCUMENTS = 5
#: Lines of so many tokens recur from so few documents on.
LONG, LONG_DOCUMENTS = 20, 2
#: The share of a line's tokens that must be constant for it to fall under a template. Lines of under SHORTEST tokens match whole but for
#: digits: of so few words, constant ones are common by chance.
CONSTANT, SHORTEST = 0.7, 6
#: A token is constant if it is in so large a share of the lines that hold the least common of the tokens that CONSTANT asks for.
AS_COMMON = 0.5
_DIGIT = re.compile(rb"[0-9]")
_LINES = "key long, doc_id long, line_no int, tokens int, leaf long, line long, first boolean, fresh boolean, tail boolean, head boolean"
_ARROW = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("line_no", pa.int32()), ("tokens", pa.int32()), ("leaf", pa.int64()), ("line", pa.int64()), *((x, pa.bool_()) for x in ("first", "fresh", "tail", "head"))])


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def tokens_of(line: bytes) -> list[bytes]:
    """The words of a line; one with a digit is variable from the start."""
    words = line.split()
    return [b"<*>" if _DIGIT.search(w) else w for w in words] if _DIGIT.search(line) else words


def _enough(documents: int) -> Column:
    """The documents that lines of so many tokens must occur in."""
    return F.when(F.col("tokens") >= LONG, min(documents, LONG_DOCUMENTS)).otherwise(documents)


def _lines(docs: DataFrame, shortest: int, leading: int) -> DataFrame:
    """A row for each line with a word: its leaf (token count and leading tokens), its masked tokens' hash, whether the leaf is new in the document
    (first), whether the line is (fresh), and whether it is the document's first one (head).

    Lines that can have variable tokens get a second row (tail), with a leaf of their last tokens, so that the first ones may vary too.
    """

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in _ARROW]
            for key, doc_id, text in zip(b.column("key").to_pylist(), b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                leaves, seen, head = set(), set(), True
                for no, line in enumerate((text or b"").split(b"\n")):
                    if words := tokens_of(line):
                        line_hash = _hash(b" ".join(words))
                        for tail in (False, True) if len(words) >= shortest else (False,):
                            leaf = _hash(b"%d. " % len(words) + b" ".join(words[-leading:])) if tail else _hash(b"%d " % len(words) + b" ".join(words[:leading]))
                            for c, x in zip(cols, (key, doc_id, no, len(words), leaf, line_hash, leaf not in leaves, line_hash not in seen, tail, head), strict=True):
                                c.append(x)
                            leaves.add(leaf)
                            head = False
                        seen.add(line_hash)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)

    return map_texts(docs.select(key_of().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"), parse, _LINES)


def _tokens(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(line, hashes, rows): the tokens of one occurrence (key, line_no) of each line; as often as there are rows with that key."""
    found = docs.select(key_of().alias("key"), "text").join(small_side(places), "key")

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, hashes, rows = [], [], []
            for text, nos, n in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("nos").to_pylist(), b.column("rows").to_pylist(), strict=True):
                all_lines = (text or b"").split(b"\n")
                for no in nos:
                    words = tokens_of(all_lines[no])
                    lines.append(_hash(b" ".join(words)))
                    hashes.append([_hash(w) for w in words])
                    rows.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(hashes, pa.list_(pa.int64())), pa.array(rows, pa.int64())], names=["line", "hashes", "rows"])

    return map_texts(found.select("text", "nos", "rows"), split, "line long, hashes array<long>, rows long")


def _alike(lines: DataFrame, documents: int) -> DataFrame:
    """Of lines (line, leaf, tokens, n, below) those of which some quarter of the tokens below the leaf is that of other lines of the leaf, in enough documents all together."""
    size = F.size("below")
    quarter = lambda j: F.struct(F.xxhash64(j, F.slice("below", F.floor(size * j / 4).cast("int") + 1, F.floor(size * (j + 1) / 4).cast("int") - F.floor(size * j / 4).cast("int"))).alias("h"), (F.floor(size * (j + 1) / 4) > F.floor(size * j / 4)).alias("any"))
    parts = lines.select("line", "leaf", "tokens", "n", F.explode(F.array(*[quarter(F.lit(j)) for j in range(4)])).alias("part")).filter("part.any").select("line", "leaf", "tokens", "n", F.col("part.h").alias("part"))
    again = parts.groupBy("leaf", "tokens", "part").agg(F.sum("n").alias("n"), F.min("line").alias("a"), F.max("line").alias("b")).filter((F.round("n") >= _enough(documents)) & (F.col("a") < F.col("b")))
    again = written(again.select("leaf", "part"), "line-quarters")
    wanted = written(parts.join(small_side(again, limit=NARROW), ["leaf", "part"]).select("line", "leaf").distinct(), "line-alike")
    out = written(lines.join(small_side(wanted), ["line", "leaf"]), "line-compared")
    forget(again, wanted)
    return out


def templates(docs: DataFrame, documents: int = DOCUMENTS, leading: int = LEADING, constant: float = CONSTANT, shortest: int = SHORTEST) -> tuple[DataFrame, DataFrame]:
    """(lines, recurring): lines (key, doc_id, line_no, template) whose leaf occurs in enough documents, once or twice each, and
    (template, n_docs) of the templates that do so themselves.

    A line's place in the first tree is its token count and its leading tokens, in the second its token count and its last ones. Of a leaf, lines
    are compared that have a quarter of their other tokens in common with some (any template with up to three fields leaves it one). Their
    tokens are counted at their place, each once for every document that has it. Of a line of `shortest` tokens and more,
    those are constant that are AS_COMMON as the last of the most common ones that make up the share `constant` (which must be in enough lines): this
    measures a token by its own template's lines, whatever else is in the leaf, and doesn't change as the table grows. A line is under the
    template of its constant tokens in each tree, or is a template of its own in the first. The outcome doesn't depend on the order of lines,
    and all counts are sums that are combined before the shuffle, so that no leaf is gathered in one task.
    """
    shortest = max(shortest, leading + 1)
    parsed = written(_lines(docs, shortest, leading), "lines")
    leaves = written(parsed.groupBy("leaf", "tokens").agg(F.count_if("first").alias("n")).filter(F.col("n") >= _enough(documents)).select("leaf"), "line-leaves")
    lines = written(parsed.drop("first").join(small_side(leaves), "leaf"), "line-busy")
    forget(leaves)
    distinct = lines.filter(F.col("tokens") >= shortest).groupBy("line", "leaf", "tokens", "tail").agg(F.count_if("fresh").alias("n"), F.min(F.struct("key", "line_no")).alias("at"))
    long = written(distinct.select("line", "leaf", "tokens", "tail", "n", "at.key", "at.line_no"), "line-long")
    # A leaf of one line has no variable tokens, and leaves of the same lines in both trees have the same ones: neither needs its tokens.
    sets = long.groupBy("leaf", "tail").agg(F.count("*").alias("size"), F.bit_xor("line").alias("xor"), F.bit_xor(F.xxhash64("line")).alias("xor2")).filter("size > 1")
    only = written(sets.groupBy("size", "xor", "xor2").agg(F.min(F.struct("tail", "leaf")).alias("one")).select("one.leaf"), "line-sets")
    varied = written(long.join(small_side(only, limit=NARROW), "leaf"), "line-varied")
    forget(long, only)
    repeats = parsed.filter("head").groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    places = varied.groupBy("line").agg(F.min(F.struct("key", "line_no")).alias("at")).groupBy("at.key").agg(F.collect_set("at.line_no").alias("nos"))
    places = written(places.join(repeats, "key", "left").fillna(1, ["rows"]), "line-places")
    below = F.when(F.col("tail"), F.slice("hashes", 1, F.col("tokens") - leading)).otherwise(F.slice("hashes", leading + 1, F.col("tokens") - leading))
    whole = _tokens(docs, places).join(small_side(varied, varied.drop("key", "line_no")), "line").select("line", "leaf", "tokens", (F.col("n") / F.col("rows")).alias("n"), below.alias("below"))
    whole = written(whole, "line-tokens")
    forget(parsed, varied, places)
    alike = _alike(whole, documents)
    forget(whole)
    tokens = alike.select("line", "leaf", "tokens", "n", F.posexplode("below").alias("pos", "token"))
    common = tokens.groupBy("leaf", "tokens", "pos", "token").agg(F.round(F.sum("n")).cast("long").alias("total")).filter(F.col("total") >= _enough(documents)).drop("tokens")
    common = written(common, "line-common")
    least = F.col("tokens") - leading - F.floor(F.lit(1 - constant + 1e-9) * F.col("tokens"))
    # Where some line may do without any constant token below its leaf, lines without common ones count as well.
    how = "inner" if shortest - leading - int((1 - constant + 1e-9) * shortest) > 0 else "left"
    seen = F.when(F.col("total").isNotNull(), F.struct("pos", "token", "total"))
    found = tokens.join(small_side(common, limit=NARROW), ["leaf", "pos", "token"], how).groupBy("line", "leaf", "tokens").agg(F.collect_set(seen).alias("found"))
    last = F.get(F.sort_array(F.transform("found", lambda x: x["total"]), asc=False), F.greatest(least, F.lit(1)).cast("int") - 1)
    found = found.filter(F.size("found") >= least).withColumn("last", last)
    constants = F.sort_array(F.transform(F.filter("found", lambda x: x["total"] >= AS_COMMON * F.col("last")), lambda x: F.struct(x["pos"], x["token"])))
    # `last` is stored too: a column that is used but once would be worked out again for each element.
    shapes = written(found.select("line", "leaf", F.xxhash64("leaf", constants).alias("general"), "last"), "line-shapes")
    forget(alike, common)
    busy, lines = lines, lines.select("key", "doc_id", "line_no", "line", "leaf", "tokens", "tail").join(small_side(shapes, shapes.drop("last"), NARROW), ["line", "leaf"], "left").filter("not tail or general is not null")
    lines = written(lines.select("key", "doc_id", "line_no", "tokens", F.coalesce("general", "line").alias("template")), "line-templates")
    forget(busy, shapes)
    each = lines.select("template", "tokens", "key").distinct()
    return lines, each.groupBy("template", "tokens").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= _enough(documents)).drop("tokens")


def dropped_lines(docs: DataFrame, documents: int = DOCUMENTS, leading: int = LEADING, constant: float = CONSTANT, shortest: int = SHORTEST, keep_first: bool = True) -> DataFrame:
    """(key, gone), stored: the line numbers, from 0 on, that go from each text; key is xxhash64 of doc_id and text."""
    lines, recurring = templates(docs, documents, leading, constant, shortest)
    recurring = written(recurring, "line-recurring")
    found = lines.drop("tokens").join(small_side(recurring, limit=NARROW), "template")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "line_no")
    found = found.groupBy("key", "line_no").agg(F.max(F.struct("n_docs", "template")).alias("widest"), F.min(place).alias("place")).select("key", "line_no", "place", "widest.template")
    found = written(found, "line-found")
    forget(lines, recurring)
    left = found
    if keep_first:
        first = written(found.groupBy("template").agg(F.min("place").alias("first")).select("first.key", "first.line_no"), "line-first")
        left = found.join(small_side(first, limit=NARROW), ["key", "line_no"], "left_anti")
    out = written(left.groupBy("key").agg(F.collect_set("line_no").alias("gone")), "line-drops")
    forget(found, *([first] if keep_first else []))
    return out


def _without(rows: DataFrame, gone: str) -> DataFrame:
    """rows with text less the \n-split lines of the numbers in gone; as it is where that is null. gone holds its lines afterwards."""
    split = rows.withColumn(gone, F.when(F.col(gone).isNotNull(), F.struct(F.split("text", "\n").alias("lines"), F.col(gone).alias("numbers"))))
    lines, numbers = F.col(f"{gone}.lines"), F.col(f"{gone}.numbers")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
    return split.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")))


def drop_recurring_lines(docs: DataFrame, documents: int = DOCUMENTS, leading: int = LEADING, constant: float = CONSTANT, shortest: int = SHORTEST, keep_first: bool = True) -> DataFrame:
    """docs with recurring lines taken out of text, all rows and other columns as they were.

    A line recurs if its template occurs in `documents` documents or more, or that of a line of LONG tokens in LONG_DOCUMENTS; it goes from all places but the first in doc_id order (null
    last; of a line's two templates the one in more documents counts), or from all with keep_first=False. Lines are \\n-split; lines without a word stay. Null texts stay null. Rows alike in doc_id
    and text are one document here. n_chars, where there is such a column, becomes the number of characters left. No rows in, no rows out.
    """
    drops, key, gone = dropped_lines(docs, documents, leading, constant, shortest, keep_first), spare(docs, "key"), spare(docs, "gone")
    rows = docs.withColumn(key, key_of()).join(small_side(drops, drops.select(F.col("key").alias(key), F.col("gone").alias(gone))), key, "left")
    rows = _without(rows, gone)
    rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, documents: int = DOCUMENTS, leading: int = LEADING, constant: float = CONSTANT, shortest: int = SHORTEST) -> DataFrame:
    """One row per document: doc_id, n_lines (those with a word), n_dropped, and n_chars and crc32 of the text that is left."""
    drops = dropped_lines(docs, documents, leading, constant, shortest)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key_of().alias("key"), text_or_empty().alias("text")).join(small_side(drops), "key", "left")
    n_lines = F.regexp_count("text", F.lit(r"(?m)^[^\n]*[^\x20\x09-\x0D\n][^\n]*$"))
    rows = _without(rows.withColumns({"n_lines": n_lines.cast("long"), "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long")}), "gone")
    return rows.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("long").alias("n_chars"), F.crc32("text").alias("text_crc32"))
