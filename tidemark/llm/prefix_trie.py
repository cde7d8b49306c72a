"""Prefix trie of conversations: sorted runs with the lengths of common prefixes, merged by a loser tree; nodes end on a stack of the open path."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import md5, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_counted, written

#: A turn is told apart by 16 bytes of a hash, a conversation by those of its turns one after the other, so that bytes sort as turns do.
TURN = 16
#: Conversations of a run. A task merges a range of one in RANGES of all bytes of turns, but at least and at most so many; summaries of FAN ranges are merged at once.
RUN, RANGES, LEAST_BYTES, MOST_BYTES, FAN = 2048, 4096, 256 << 10, 64 << 20, 64
EMPTY = sha256(b"").hexdigest()


def head(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its five: unsigned crc32 of the decimal id, mod 9."""
    return (F.crc32(conv_id.cast("string")) % 9).cast("int")


def rebuilt(conversations: DataFrame, group: int = 5) -> DataFrame:
    """(conv_id, turns binary, sizes array<int>) of each conversation as it is rebuilt: the first turns of the first one of its group, then its own after as many.

    Texts stay where they are read: a turn travels as its hash and the bytes of its text. A null role or text is empty; turns are in order of their number, null first, and those
    of one number in order of their hashes; turns without conv_id belong to none. A conversation is one row, of 20 bytes for each turn.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    c = F.col("conv_id").cast("long")
    turns = conversations.select(
        c.alias("c"), (c - c % group).alias("first"), F.col("turn").cast("long").alias("turn"), F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("h"), F.octet_length(text).alias("n")
    ).filter("c is not null")
    by = turns.groupBy("first").agg(F.sort_array(F.collect_list(F.struct("c", "turn", "h", "n"))).alias("t"))
    by = by.select("first", "t", F.explode(F.array_distinct(F.transform("t", lambda x: x["c"]))).alias("conv_id")).withColumn("head", head(F.col("conv_id")))
    of = lambda which: F.filter("t", lambda x: x["c"] == F.col(which))
    both = by.select("conv_id", "head", of("first").alias("theirs"), of("conv_id").alias("own"))
    both = both.select("conv_id", F.concat(F.slice("theirs", F.lit(1), F.col("head")), F.slice("own", F.col("head") + 1, F.greatest(F.size("own") - F.col("head"), F.lit(0)))).alias("t"))
    return both.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["h"])), "")).alias("turns"), F.transform("t", lambda x: x["n"]).alias("sizes"))


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Turns that a and b begin with alike, known to be `start` at least."""
    low, high = start, min(len(a), len(b)) // TURN
    if a[start * TURN : high * TURN] == b[start * TURN : high * TURN]:
        return high
    while high - low > 1:  # a and b differ before high and agree before low
        mid = (low + high) // 2
        if a[low * TURN : mid * TURN] == b[low * TURN : mid * TURN]:
            low = mid
        else:
            high = mid
    return low


class Run:
    """Conversations (turns, conv_id, sizes) in order, each with the number of turns that it shares with the one before it."""

    def __init__(self, rows: list[tuple[bytes, int, list[int]]]) -> None:
        self.rows, self.at = sorted(rows, key=lambda r: r[:2]), 0
        self.lcps = [0, *(shared(x[0], y[0]) for x, y in zip(self.rows, self.rows[1:], strict=False))]

    def head(self) -> tuple[bytes, int, list[int]] | None:
        return self.rows[self.at] if self.at < len(self.rows) else None


def merged(runs: list[Run]) -> Iterator[tuple[int, tuple[bytes, int, list[int]]]]:
    """(turns shared with the one before, conversation) of all runs in order, by a tree of losers.

    Heads of runs that wait carry the turns that they share with the last winner they met. Of two heads the one that shares more with the last that went out is the
    smaller one, without a look at either; only those that share equally many are compared, and from that turn on.
    """
    if not runs:
        return
    size = 1
    while size < len(runs):
        size *= 2
    heads = [r.head() for r in runs] + [None] * (size - len(runs))
    lcps = [0] * size
    losers = [-1] * size

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's count becomes what it shares with the winner."""
        a, b = heads[x], heads[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if lcps[x] != lcps[y]:
            return (x, y) if lcps[x] > lcps[y] else (y, x)
        n = shared(a[0], b[0], lcps[x])
        at, bt = a[0][n * TURN : (n + 1) * TURN], b[0][n * TURN : (n + 1) * TURN]
        won, lost = (x, y) if (at, a[1]) <= (bt, b[1]) else (y, x)
        lcps[lost] = n
        return won, lost

    winners = [-1] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while heads[best] is not None:
        yield lcps[best], heads[best]
        run = runs[best]
        run.at += 1
        heads[best] = run.head()
        lcps[best] = run.lcps[run.at] if heads[best] is not None else 0
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


class Node:
    """A prefix as far as its conversations have been seen. kids, leaves and saved count nodes below it that are finished."""

    __slots__ = ("ends", "kids", "leaves", "low", "n", "saved", "size", "waiting")

    def __init__(self, n: int, low: int, size: int, kids: int = 0, leaves: int = 0, saved: int = 0) -> None:
        self.n, self.low, self.size, self.kids, self.leaves, self.saved = n, low, size, kids, leaves, saved
        self.ends, self.waiting = [], []


class Path:
    """The stack of open nodes. A node that the first conversation of all goes through stays unfinished, as those before may have it too; so do, at the
    end, those of the last one. All other nodes are finished when the next conversation leaves them."""

    def __init__(self, key, named: bool) -> None:
        self.open: list[Node] = []
        self.on_first, self.left = 0, []  # depths of the open path that are the first one's too; nodes of the first path that were left
        self.key, self.done = key, []  # key(depth): what tells the open node of that depth apart
        self.named = named  # whether finished nodes need their key: others wait for them, or their ends are stored elsewhere

    def close(self, depth: int) -> None:
        """Leaves the nodes deeper than depth (the root has depth 0; -1 leaves all)."""
        while len(self.open) > depth + 1:
            at = len(self.open) - 1
            node = self.open[at]
            if at < self.on_first:
                self.left.append((at, self.key(at), self.key(at - 1), node))
                self._send(at, node)
                self.on_first = at
            else:
                leaves = node.leaves if node.kids else 1
                saved = node.saved + (node.n - 1) * node.size
                row = (at, node.low, node.n, node.kids, leaves, saved, *((self.key(at), None) if self.named else (None, sha256(",".join(node.ends).encode()).hexdigest())))
                for child in node.waiting:
                    self.done.append((*child, node.low, None))
                if at:
                    up = self.open[at - 1]
                    up.kids, up.leaves, up.saved = up.kids + 1, up.leaves + leaves, up.saved + saved
                    if at - 1 < self.on_first:
                        self.done.append((*row, None, self.key(at - 1)))
                    else:
                        up.waiting.append(row)
                else:
                    self.done.append((*row, None, None))
            self.open.pop()

    def _send(self, at: int, node: Node) -> None:
        """What waits for the node goes without its parent's conversation; it is joined once the node is finished."""
        self.done.extend((*child, None, self.key(at)) for child in node.waiting)
        node.waiting = []

    def rest(self) -> list[tuple[str, int, bytes, bytes | None, Node]]:
        """(path, depth, key, parent's key, node) of the nodes that are not finished, the first path's and the last path's."""
        out = [("both" if at < self.on_first else "last", at, self.key(at), self.key(at - 1) if at else None, n) for at, n in enumerate(self.open)]
        for _, at, _, _, n in out:
            self._send(at, n)
        return out + [("first", at, key, up, n) for at, key, up, n in self.left]


_NODE = "depth int, low long, n long, kids long, leaves long, saved long"
#: Finished nodes have no path; texts are pieces of the list of a node's own conversations.
SCHEMA = f"part int, path string, key binary, parent binary, {_NODE}, size long, parent_low long, ends string, piece string"
_ARROW = pa.schema(
    [("part", pa.int32()), ("path", pa.string()), ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32())]
    + [(c, pa.int64()) for c in ("low", "n", "kids", "leaves", "saved", "size", "parent_low")]
    + [("ends", pa.string()), ("piece", pa.string())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)] if rows else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)


def _finished(path: Path) -> list[tuple]:
    out = [(None, None, key, parent, depth, low, n, kids, leaves, saved, None, parent_low, ends, None) for depth, low, n, kids, leaves, saved, key, ends, parent_low, parent in path.done]
    path.done = []
    return out


def _unfinished(path: Path, part: int) -> list[tuple]:
    return [(part, side, key, up, at, x.low, x.n, x.kids, x.leaves, x.saved, x.size, None, None, ",".join(x.ends) if x.ends else None) for side, at, key, up, x in path.rest()]


def _merge_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one range: its finished nodes, and the unfinished ones on its first and last path."""
    from pyspark import TaskContext

    runs, rows = [], []
    for b in batches:
        for row in zip(b["turns"].to_pylist(), b["conv_id"].to_pylist(), b["sizes"].to_pylist(), strict=True):
            rows.append(row)
            if len(rows) == RUN:
                runs.append(Run(rows))
                rows = []
    if rows:
        runs.append(Run(rows))
    if not runs:
        return
    now = b""
    keys: list[bytes] = []  # of the open path, as far as they have been asked for

    def key(depth: int) -> bytes:
        while len(keys) <= depth:
            keys.append(md5(keys[-1] + now[(len(keys) - 1) * TURN : len(keys) * TURN]).digest() if keys else md5(b"").digest())
        return keys[depth]

    path = Path(key, named=False)
    for lcp, (turns, conv_id, sizes) in merged(runs):
        if path.open:
            path.close(lcp)
        del keys[lcp + 1 :]
        now = turns
        for node in path.open:
            node.n += 1
            node.low = min(node.low, conv_id)
        if not path.open:
            path.open.append(Node(1, conv_id, 0))
            path.on_first = len(sizes) + 1
        path.open.extend(Node(1, conv_id, sizes[d]) for d in range(len(path.open) - 1, len(sizes)))
        path.open[-1].ends.append(str(conv_id))
        if len(path.done) >= 4096:
            yield _batch(_finished(path))
    open_ones = _unfinished(path, TaskContext.get().partitionId())
    yield _batch(open_ones + _finished(path))


def _merge_summaries(part: int, rows: list[dict], last: bool) -> list[tuple]:
    """The unfinished nodes of neighbouring ranges, in order of part, become finished ones and those that are unfinished still; with last, all are finished."""
    keys: list[bytes] = []
    path = Path(lambda depth: keys[depth], named=True)
    by: dict[int, list[dict]] = {}
    for r in rows:
        by.setdefault(r["part"], []).append(r)

    def add(nodes: list[dict], start: int) -> None:
        """Opens nodes from depth start on."""
        for r in nodes[start:]:
            keys.append(r["key"])
            path.open.append(Node(r["n"], r["low"], r["size"], r["kids"], r["leaves"], r["saved"]))

    for number in sorted(by):
        side = lambda *which, number=number: sorted((r for r in by[number] if r["path"] in which), key=lambda r: r["depth"])
        first, tail, common = side("both", "first"), side("last"), len(side("both"))
        if not path.open:
            add(first, 0)
            path.on_first = len(first)
        else:
            same = 0
            while same < min(len(first), len(keys)) and keys[same] == first[same]["key"]:
                same += 1
            path.close(same - 1)
            del keys[same:]
            for node, r in zip(path.open, first[:same], strict=True):
                node.n, node.low, node.kids, node.leaves, node.saved = node.n + r["n"], min(node.low, r["low"]), node.kids + r["kids"], node.leaves + r["leaves"], node.saved + r["saved"]
            add(first, same)
        if len(first) > common or tail:
            path.close(common - 1)
            del keys[common:]
            add(tail, 0)
    if last:
        return _settled(path)
    return _unfinished(path, part) + _finished(path)


def _settled(path: Path) -> list[tuple]:
    """All nodes that are not finished, from the deepest one up, once nothing comes before or after them."""
    above: dict[bytes | None, list[tuple]] = {}
    for _, at, key, up, node in sorted(path.rest(), key=lambda r: -r[1]):
        for kid, leaves, saved in above.pop(key, ()):
            node.kids, node.leaves, node.saved = node.kids + kid, node.leaves + leaves, node.saved + saved
        leaves, saved = (node.leaves if node.kids else 1), node.saved + (node.n - 1) * node.size
        above.setdefault(up, []).append((1, leaves, saved))
        path.done.append((at, node.low, node.n, node.kids, leaves, saved, key, None, None, up))
    return _finished(path)


def _hash_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each key, which come one after the other in order, joined by commas."""
    now, so_far, out = None, sha256(), []
    for b in batches:
        for key, piece in zip(b["key"].to_pylist(), b["piece"].to_pylist(), strict=True):
            if key != now:
                if now is not None:
                    out.append((now, so_far.hexdigest()))
                now, so_far = key, sha256()
                so_far.update(piece.encode())
            else:
                so_far.update(b"," + piece.encode())
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([h for _, h in out])], names=["key", "sha"])
            out = []
    if now is not None:
        out.append((now, so_far.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([h for _, h in out])], names=["key", "sha"])


def prefix_trie(conversations: DataFrame, group: int = 5, least_bytes: int = LEAST_BYTES, fan: int = FAN) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are dealt in ranges of their turns, those alike by conv_id, so that no group of copies is one task's. Each task merges its runs and finishes nodes; those that
    neighbours may share are merged `fan` ranges at a time, until one is left. The list of a node's own conversations is hashed piece by piece, as SHA-256 can't be
    taken in parts; its memory stays that of a piece. Repeated turns are turns; extra columns are not read; no conversations in, no rows out.
    """
    rows = written(rebuilt(conversations, group), "trie-conversations")
    ranges = max(1, -(-rows.stored.bytes // max(least_bytes, min(MOST_BYTES, rows.stored.bytes // RANGES))))
    ranged = rows.repartitionByRange(ranges, "turns", "conv_id").select("turns", "conv_id", "sizes")
    nodes = written(ranged.mapInArrow(_merge_task, SCHEMA), "trie-nodes", top=F.max("part"))
    hashed = nodes.filter("piece is not null").select("key", "part", "piece").repartition("key").sortWithinPartitions("key", "part").mapInArrow(_hash_pieces, "key binary, sha string")
    finished, still, top = nodes.filter("path is null"), nodes.filter("path is not null"), nodes.stored.found["top"] or 0
    levels = []
    while not levels or top:
        top //= fan
        blocks = still.withColumn("block", F.floor(F.col("part") / fan).cast("int")).drop("piece")
        level = written(_merge_blocks(blocks, last=not top), "trie-level")
        levels.append(level.filter("path is null"))
        still = level.filter("path is not null")
    late = levels[0]
    for x in levels[1:]:
        late = late.unionByName(x)
    late = written(late.drop("ends").join(hashed, "key", "left").withColumnRenamed("sha", "ends"), "trie-late", kids=F.sum("kids"))
    parents = late.select(F.col("key").alias("parent"), F.col("low").alias("parent_conv_id"), F.col("kids").alias("__kids"))
    columns = ["low", "depth", "n", "kids", "leaves", "saved", "ends", "parent", "parent_low"]
    every = finished.select(*columns).unionByName(late.select(*columns))
    there = every.filter("parent is null").select(*columns[:7], F.col("parent_low").alias("parent_conv_id"))
    sought = join_counted(every.filter("parent is not null").select(*columns[:8]), parents, ["parent"], "__kids", late.stored.found["kids"] or 0)
    return there.unionByName(sought.select(*columns[:7], "parent_conv_id")).select(
        F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )


def _merge_blocks(blocks: DataFrame, last: bool) -> DataFrame:
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(_merge_summaries(key[0].as_py(), table.to_pylist(), last))])

    return blocks.groupBy("block").applyInArrow(merge, SCHEMA)


#: One byte after the other: a set bit at the end shifts in the polynomial of CRC-32 (a fixed value).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda x: list_prepend(CAST(ascii(x) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

ORACLE = f"""WITH t AS (SELECT conv_id AS c, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, 2) AS place
 FROM conversations WHERE conv_id IS NOT NULL), ids AS (SELECT DISTINCT c, {_CRC.format(c="c")} % 9 AS head FROM t),
 parts AS (SELECT ids.c, h, size, 0 AS own, place FROM ids JOIN t ON t.c = ids.c - ids.c % 5 AND place <= head UNION ALL SELECT ids.c, h, size, 1, place FROM ids JOIN t ON t.c = ids.c AND place > head),
 turns AS (SELECT c, size, row_number() OVER w AS depth, md5(string_agg(h, '') OVER w) AS node FROM parts WINDOW w AS (PARTITION BY c ORDER BY own, place)),
 steps AS (SELECT c, size, depth, node, coalesce(lag(node) OVER (PARTITION BY c ORDER BY depth), '') AS up, lead(node) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ends FROM turns
  UNION ALL SELECT c, 0, 0, '', NULL, c NOT IN (SELECT c FROM turns) FROM ids),
 nodes AS (SELECT node, up, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM steps GROUP BY ALL),
 kids AS (SELECT up AS node, count(*) AS n FROM nodes GROUP BY 1),
 below AS (SELECT DISTINCT a.node AS top, d.node FROM steps a JOIN steps d ON a.c = d.c AND d.depth >= a.depth),
 sums AS (SELECT top, count(*) FILTER (k.n IS NULL) AS n_leaves, CAST(sum((d.n_convs - 1) * d.size) AS BIGINT) AS saved_tokens FROM below b JOIN nodes d ON d.node = b.node LEFT JOIN kids k ON k.node = d.node GROUP BY 1)
 SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
 FROM nodes n JOIN sums s ON s.top = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes p ON p.node = n.up"""
