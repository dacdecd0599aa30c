"""Operator 12: a prefix trie over rebuilt conversations, with subtree totals by time-forward processing.

Turns are put in order by one range sort, so that a conversation of any length spreads over many tasks. A node is named
by its depth and the sum of the hashes of its turns with their places (128 bits): sums over prefixes need no task to
see a whole conversation. Nodes with one member are paths of which all totals are known at once; only nodes with two
members or more are processed.

A node is light if at most `shard_rows` turns of its members lie below it. The highest light nodes are roots of shards,
whose nodes are sorted in reverse level order (deepest first) by Spark's external sort. A node takes what its children
sent from a priority queue, adds its own and sends the sum to its parent's place in the order, which always comes later.
The queue spills sorted runs to the shared folder. What shard roots send, summed by parent, is what the heavy nodes
above start from; they are processed in the same way, across shards.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch

GROUP, HEADS = 5, 9  # conversation c takes its first h turns, h below HEADS, from c - c % GROUP
SHARD_ROWS, QUEUE_ROWS, CHUNK = 1 << 16, 1 << 18, 1 << 20
_BLOCK = 12  # prefix sums are taken within 2**12 turns, then over such blocks
_LOW = (1 << 32) - 1
_TOTALS = "k1 long, k2 long, q1 long, q2 long, n_convs long, shard_root boolean, n_children long, n_leaves long, saved_tokens long"


class SpillingQueue:
    """A priority queue of (key, sums): sums under one key are added up; above `limit` keys sorted runs go to `folder` (a URI)."""

    def __init__(self, folder: str, limit: int = QUEUE_ROWS):
        self.folder, self.limit = folder, limit
        self.heap: list[tuple[int, ...]] = []
        self.sums: dict[tuple[int, ...], list[int]] = {}
        self.runs: list[tuple[tuple[int, ...], int, list[int], Iterator]] = []  # a heap of the first entry of each run
        self.paths: list[str] = []

    def push(self, key: tuple[int, ...], sums: list[int]) -> None:
        have = self.sums.get(key)
        if have is not None:
            self.sums[key] = [a + b for a, b in zip(have, sums, strict=True)]
            return
        self.sums[key] = sums
        heapq.heappush(self.heap, key)
        if len(self.heap) > self.limit:
            self._spill()

    def pop(self, key: tuple[int, ...], width: int = 4) -> list[int]:
        """The sums sent to key, which must not be above any key still in the queue."""
        out = [0] * width
        if self.heap and self.heap[0] == key:
            heapq.heappop(self.heap)
            out = self.sums.pop(key)
        while self.runs and self.runs[0][0] == key:
            _, number, sums, rest = heapq.heappop(self.runs)
            out = [a + b for a, b in zip(out, sums, strict=True)]
            self._front(number, rest)
        return out

    def close(self) -> None:
        for path in self.paths:
            fs, name = pa.fs.FileSystem.from_uri(path)
            fs.delete_file(name)
        self.paths = []

    def _spill(self) -> None:
        keys = sorted(self.heap)
        path = f"{self.folder}/run-{uuid.uuid4().hex}.arrow"
        fs, name = pa.fs.FileSystem.from_uri(path)
        fs.create_dir(name.rpartition("/")[0])
        columns = [*zip(*keys, strict=True), *zip(*(self.sums[k] for k in keys), strict=True)]
        table = pa.table([pa.array(c, pa.int64()) for c in columns], [f"c{i}" for i in range(len(columns))])
        with fs.open_output_stream(name) as out, pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table, max_chunksize=1 << 13)
        self.paths.append(path)
        self._front(len(self.paths) - 1, self._read(path, len(keys[0])))
        self.heap, self.sums = [], {}

    def _front(self, number: int, rest: Iterator) -> None:
        first = next(rest, None)
        if first is not None:
            heapq.heappush(self.runs, (first[0], number, first[1], rest))

    @staticmethod
    def _read(path: str, width: int) -> Iterator[tuple[tuple[int, ...], list[int]]]:
        fs, name = pa.fs.FileSystem.from_uri(path)
        with fs.open_input_stream(name) as source, pa.ipc.open_stream(source) as reader:
            for batch in reader:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield row[:width], list(row[width:])


def _forward(folder: str, limit: int):
    """Totals of nodes that come in reverse level order; of a shard's root they go on by its row, of others by the queue."""

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, limit)
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            totals = []
            for depth, k1, k2, q1, q2, n, ends, size, root, *given in zip(*(c[x] for x in ("depth", "k1", "k2", "q1", "q2", "n_convs", "enders", "bytes", "shard_root", "children", "leaves", "saved", "members")), strict=True):
                children, leaves, saved, members = (a + b for a, b in zip(queue.pop((-depth, k1, k2)), given, strict=True))
                alone = n - ends - members  # members that go on by themselves: each is a child and a leaf's path
                children, leaves, saved = children + alone, (leaves + alone) or 1, saved + (n - 1) * size
                totals.append((children, leaves, saved))
                if not root:
                    queue.push((1 - depth, q1, q2), [1, leaves, saved, n])
            columns = [batch.column(x) for x in ("k1", "k2", "q1", "q2", "n_convs", "shard_root")]
            names = [x.split()[0] for x in _TOTALS.split(", ")]
            yield pa.record_batch([*columns, *(pa.array([t[i] for t in totals], pa.int64()) for i in range(3))], names)
        queue.close()

    return forward


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[tuple[int, int], list]]:
    """The column's values in rows of equal (k1, k2) that stand together, a batch's part at a time."""
    for batch in batches:
        keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True))
        values, at = batch.column(column).to_pylist(), 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[at]:
                yield keys[at], values[at:i]
                at = i


def _chunks(chunk: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of a node's enders, in order, as comma-joined pieces of about `chunk` bytes."""
        key, first, parts, size = None, 0, [], 0
        for now, ids in _runs(batches, "conv_id"):
            for i in ids:
                if parts and (now != key or size > chunk):
                    yield pa.record_batch([[key[0]], [key[1]], [first], [",".join(parts)]], ["k1", "k2", "first", "part"])
                    parts, size = [], 0
                if not parts:
                    key, first = now, i
                parts.append(str(i))
                size += len(parts[-1]) + 1
        if parts:
            yield pa.record_batch([[key[0]], [key[1]], [first], [",".join(parts)]], ["k1", "k2", "first", "part"])

    return chunks


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order; the hash is fed a piece at a time."""
    key, state = None, None
    row = lambda: pa.record_batch([[key[0]], [key[1]], [state.hexdigest()]], ["k1", "k2", "ends"])
    for now, parts in _runs(batches, "part"):
        if now != key:
            if key is not None:
                yield row()
            key, state = now, hashlib.sha256()
        else:
            state.update(b",")
        state.update(",".join(parts).encode())
    if key is not None:
        yield row()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (grows with conv_id, turn, role and text), two hashes of role and text, and the text's bytes; rows without id go."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")).filter("conv_id is not null")
    rows = rows.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return rows.select("conv_id", F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"), F.octet_length("text").cast("long").alias("bytes"))


def _rebuilt(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows of the rebuilt conversations (conv_id, depth from 1, h1, h2, bytes, total turns), and conv_id, total of each."""
    part = F.shiftright("at", 33)
    turns = turns.withColumn("part", part)
    parts = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = scratch.settled(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    own = parts.groupBy("conv_id").agg(F.sum("n").alias("own"))
    donors = own.select(F.col("conv_id").alias("donor"), F.col("own").alias("donor_own"))
    convs = own.withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % HEADS, "donor": F.col("conv_id") - F.col("conv_id") % GROUP}).join(donors, "donor", "left")
    convs = convs.withColumn("take", F.least("h", F.coalesce("donor_own", F.lit(0)))).withColumn("total", F.col("take") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = scratch.settled(convs.select("conv_id", "donor", "h", "take", "total"))
    numbered = turns.join(parts.join(convs, "conv_id"), ["conv_id", "part"]).withColumn("k", F.col("at") - F.col("first") + F.col("before") + 1)
    rest = numbered.filter("k > h").select("conv_id", (F.col("k") - F.col("h") + F.col("take")).alias("depth"), "h1", "h2", "bytes", "total")
    heads = numbered.filter((F.col("k") < HEADS) & (F.col("conv_id") % GROUP == 0)).select(F.col("conv_id").alias("donor"), "k", "h1", "h2", "bytes")
    taken = heads.join(convs, "donor").filter("k <= h").select("conv_id", F.col("k").alias("depth"), "h1", "h2", "bytes", "total")
    return rest.unionByName(taken), convs.select("conv_id", "total")


def _with_prefixes(rows: DataFrame, long: bool) -> DataFrame:
    """s0 to s3: sums of hash parts over the turns up to each one; e0 to e3: those of the turn itself."""
    one, two = F.xxhash64("depth", "h1", "h2"), F.xxhash64("h2", "h1", "depth", F.lit(1))
    pieces = [x for h in (one, two) for x in (h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))]
    rows = rows.withColumns({f"e{i}": p for i, p in enumerate(pieces)} | {"block": F.shiftright("depth", _BLOCK)})
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({f"s{i}": F.sum(f"e{i}").over(upto) for i in range(4)})
    if long:
        earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = rows.filter(F.col("total") >= 1 << _BLOCK).groupBy("conv_id", "block").agg(*(F.sum(f"e{i}").alias(f"e{i}") for i in range(4)))
        blocks = blocks.select("conv_id", "block", *(F.sum(f"e{i}").over(earlier).alias(f"b{i}") for i in range(4)))
        out = out.join(blocks, ["conv_id", "block"], "left").withColumns({f"s{i}": F.col(f"s{i}") + F.coalesce(f"b{i}", F.lit(0)) for i in range(4)})
    return out


def _name(depth: Column, sums: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(depth, *sums), F.xxhash64(*reversed(sums), depth)


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, queue_rows: int = QUEUE_ROWS, chunk: int = CHUNK) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conv_id is the node's smallest member. Turns without conv_id belong to no conversation and are left out; turns of one
    number stand by role and text, so repeated rows follow each other. An empty table has no nodes, not even a root.
    """
    scratch = Scratch(conversations.sparkSession)
    turns = scratch.settled(ordered_turns(conversations))
    rows, convs = _rebuilt(turns, scratch)
    long = (convs.agg(F.max("total")).first()[0] or 0) >= 1 << _BLOCK
    sums, own = [F.col(f"s{i}") for i in range(4)], [F.col(f"s{i}") - F.col(f"e{i}") for i in range(4)]
    (k1, k2), (q1, q2) = _name(F.col("depth"), sums), _name(F.col("depth") - 1, own)
    zero = F.lit(0).cast("long")
    r1, r2 = _name(zero, [zero] * 4)
    at_root = convs.select("conv_id", zero.alias("depth"), r1.alias("k1"), r2.alias("k2"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"), zero.alias("bytes"), F.col("total").alias("rest"))
    below = _with_prefixes(rows, long).select("conv_id", "depth", k1.alias("k1"), k2.alias("k2"), q1.alias("q1"), q2.alias("q2"), "bytes", (F.col("total") - F.col("depth")).alias("rest"))
    paths = scratch.settled(at_root.unionByName(below))
    scratch.drop(turns)
    nodes = paths.groupBy("k1", "k2").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("rest") + 1).alias("weight"), F.min("bytes").alias("bytes"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        F.count_if(F.col("rest") == 0).alias("enders"), F.min(F.when(F.col("rest") == 0, F.col("conv_id"))).alias("end"))
    nodes = scratch.settled(nodes)
    shared = (F.col("n_convs") > 1) | (F.col("depth") == 0)
    is_heavy = (F.col("weight") > shard_rows) | (F.col("depth") == 0)
    heavy, light = nodes.filter(shared & is_heavy), nodes.filter(shared & ~is_heavy)

    # shards: every light node lies below the highest light node on the path of its smallest member
    roots = light.join(heavy.select(F.col("k1").alias("q1"), F.col("k2").alias("q2")), ["q1", "q2"], "left_semi").select("k1", "k2")
    members = paths.join(roots, ["k1", "k2"]).select("conv_id", F.col("k1").alias("r1"), F.col("k2").alias("r2"))
    nothing = {c: zero for c in ("children", "leaves", "saved", "members")}
    dealt = light.join(members, "conv_id").withColumns(nothing | {"shard_root": (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))})
    fields = ["depth", "k1", "k2", "q1", "q2", "n_convs", "enders", "bytes", "shard_root", "children", "leaves", "saved", "members"]
    order = [F.desc("depth"), "k1", "k2"]
    forward = _forward(f"{scratch.path}/spill-{uuid.uuid4().hex}", queue_rows)
    done = scratch.settled(dealt.repartition("r1", "r2").sortWithinPartitions(*order).select(*fields).mapInArrow(forward, _TOTALS))
    # across shard roots: few nodes have more than shard_rows turns below them
    sent = done.filter("shard_root").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.sum("n_convs").alias("members"))
    top = heavy.join(sent, ["k1", "k2"], "left").fillna(0, list(nothing)).withColumn("shard_root", F.col("depth") == 0)
    top = top.select(*fields).repartition(1).sortWithinPartitions(*order).mapInArrow(forward, _TOTALS)
    totals = done.union(top).select("k1", "k2", "n_children", "n_leaves", "saved_tokens")

    several = nodes.filter("enders > 1").select("k1", "k2")
    ids = paths.filter("rest = 0").join(several, ["k1", "k2"], "left_semi").select("k1", "k2", "conv_id").orderBy("k1", "k2", "conv_id")
    pieces = ids.mapInArrow(_chunks(chunk), "k1 long, k2 long, first long, part string")
    ends = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(_digests, "k1 long, k2 long, ends string")

    parents = nodes.filter(shared).select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent"))
    out = nodes.join(totals, ["k1", "k2"], "left").join(ends, ["k1", "k2"], "left").join(parents, ["q1", "q2"], "left")
    one = F.sha2(F.when(F.col("enders") == 1, F.col("end").cast("string")).otherwise("").cast("binary"), 256)
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.col("n_convs") - F.col("enders")).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends", one).alias("ends_sha256"))


# A node is named by a hash of its turns, each with the lengths of its role and text; the CRC is computed bit by bit.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), i AS (
  SELECT conv_id, conv_id - conv_id % 5 AS donor, conv_id::VARCHAR AS s FROM t GROUP BY conv_id
), c AS (
  SELECT conv_id, donor, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(s) + 1), lambda p: ascii(s[p])::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h FROM i
), r AS (
  SELECT c.conv_id, k AS d, role, text FROM c JOIN t ON t.conv_id = c.donor AND k <= h
  UNION ALL
  SELECT c.conv_id, k - h + least(h, (SELECT count(*) FROM t x WHERE x.conv_id = c.donor)), role, text FROM c JOIN t ON t.conv_id = c.conv_id AND k > h
), p AS (
  SELECT conv_id, d, octet_length(encode(text)) AS bytes, sha256(string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS path FROM r
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM c
), m AS (
  SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY d) AS above, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM p
), n AS (
  SELECT path, d, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saves, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY path, d
), kids AS (
  SELECT above AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1
), f AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path)
), below AS (
  SELECT a.path, sum(f.saves) AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM (SELECT DISTINCT x.path, y.path AS under FROM m x JOIN m y ON x.conv_id = y.conv_id AND y.d >= x.d) a JOIN f ON f.path = a.under GROUP BY a.path
)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN below USING (path) LEFT JOIN f u ON u.path = f.above
"""
