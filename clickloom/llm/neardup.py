"""Operator 10: near-duplicate groups by MinHash bands with sequential Bayesian verification.

Texts with equal shingle sets fall into one class first. Class representatives that agree in a band of their signature
are candidates; signature batches of a candidate are compared one after another and the pair is dropped as soon as the
posterior probability that its similarity reaches the threshold is below `miss` (uniform prior). Survivors are verified
on their full shingle sets. Members of a bucket are first compared with its middle one; what is linked needs no more
pairs. What stays apart meets three more pivots and then every member of another component: one by one in small buckets,
and in crowded ones, by blocks of members, on what their sets have over or lack of the bucket's middle, from which a
pair's similarity follows exactly; only links that join components leave a block. So no link between components is
lost. Components grow by smallest labels with pointer jumping.

Chance of losing a pair at the threshold: (1 - 0.8**5)**32 = 3e-6 by the bands, and `miss` by each of four comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrays import Words, by_group, lean, lean_group, mix, ragged, slices
from .store import Scratch

BANDS, ROWS, BATCH = 32, 5, 40
SHINGLE, PERCENT, MISS = 2, 80, 1e-6
MAX_IDS = 1_000_000
CROWD, BLOCK = 16, 2048
_RNG = np.random.Generator(np.random.PCG64(7))
_A = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, by text and hash: rows and hashes. A shorter text, not empty, is one shingle."""
    h = words.hashes()
    room = np.minimum(words.first[words.doc + 1] - np.arange(len(h)), size)
    whole = words.count[words.doc]
    starts = np.flatnonzero((room == size) | ((whole < size) & (room == whole)))
    length = room[starts]
    value = length.astype(np.uint64)
    for k in range(size):
        inside = length > k
        value[inside] = mix(value[inside] * _STEP + h[starts[inside] + k])
    rows = words.doc[starts]
    order = by_group(rows, value)
    rows, value = rows[order], value[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
    return rows[new], value[new]


def _sketch(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows, value = shingle_hashes(Words(batch.column("text")), size)
                n = np.bincount(rows, minlength=batch.num_rows)
                used = np.flatnonzero(n)
                first = np.concatenate([[0], np.cumsum(n[used])[:-1]]).astype(np.int64)
                least = np.zeros((len(used), BANDS * ROWS), dtype=np.uint32)
                sums = np.zeros((2, batch.num_rows), dtype=np.uint64)
                if len(used):
                    for i in range(BANDS * ROWS):
                        least[:, i] = np.minimum.reduceat(((value * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), first)
                    sums[0, used] = np.add.reduceat(mix(value), first)
                    sums[1, used] = np.add.reduceat(mix(value * _STEP), first)
                band = np.zeros((len(used), BANDS), dtype=np.uint64)
                for r in range(ROWS):
                    band = mix(band * _STEP + least[:, r::ROWS])
                band = mix(band + np.arange(BANDS, dtype=np.uint64))
                sign = mix(least).astype(np.uint8)
                bands: list = [[]] * batch.num_rows
                signs: list = [b""] * batch.num_rows
                for at, row in enumerate(used):
                    bands[row], signs[row] = band[at].view(np.int64), sign[at].tobytes()
                yield pa.record_batch([
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary()),
                ], ["doc_id", "n", "c1", "c2", "bands", "sign"])

    return sketch


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows, value = shingle_hashes(Words(batch.column("text")), size)
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64)))
                yield pa.record_batch([batch.column("doc_id"), lists], ["doc_id", "items"])

    return sets


def least_matches(percent: int = PERCENT, miss: float = MISS, hashes: int = BANDS * ROWS, batch: int = BATCH) -> list[int]:
    """After each batch, the matches from which the posterior chance of a similarity of percent/100 is at least `miss`.

    Signs have 8 bits, so texts of similarity s agree in one with probability s + (1 - s) / 256.
    """
    grid = np.linspace(0, 1, 20_001)
    agree = grid + (1 - grid) / 256
    out = []
    for n in range(batch, hashes + 1, batch):
        for m in range(n + 1):
            with np.errstate(divide="ignore", invalid="ignore"):
                log = m * np.log(agree) + (np.nan_to_num((n - m) * np.log(1 - agree), nan=0.0) if n > m else 0.0)
            weight = np.exp(log - log.max())
            if weight[grid >= percent / 100].sum() / weight.sum() >= miss:
                out.append(m)
                break
    return out


def _survivors(percent: int, miss: float):
    need = least_matches(percent, miss)

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, BANDS * ROWS) for c in ("sign_a", "sign_b"))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            for k, least in enumerate(need):
                part = slice(k * BATCH, (k + 1) * BATCH)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return survivors


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """v, label: the smallest id that each end of a link (a, b) can reach."""
    edges = scratch.settled(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = scratch.settled(edges.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("label")))
    while True:
        near = edges.join(labels, edges.b == labels.v).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.v == near.a).select("v", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("v").alias("at"), F.col("label").alias("to"))
        step = scratch.settled(step.join(jump, step.label == jump.at).select("v", "was", F.least("label", "to").alias("label")))
        scratch.drop(labels)
        labels = step
        if step.filter("was <> label").isEmpty():
            scratch.drop(edges)
            return labels.select("v", "label")


def _linked(percent: int):
    def linked(table: pa.Table) -> pa.Table:
        """a, b: links between members of one pivot's blocks, as many as join their components.

        With D(x) the symmetric difference of x's set and the pivot's, x and y differ in |D(x)| + |D(y)| - 2 |D(x) and D(y)|
        shingles. Rows of the second block (second = true) meet those of the first; a block alone meets itself.
        """
        second = table.column("second").to_numpy()
        n, label, gap = table.column("n").to_numpy(), table.column("lab").to_numpy(), table.column("gap").combine_chunks()
        ends = gap.offsets.to_numpy()
        element = np.unique(gap.flatten().to_numpy(), return_inverse=True)[1]
        m, ends = np.diff(ends), ends - ends[0]
        owner = np.repeat(np.arange(len(m)), m)
        first = np.flatnonzero(~second)
        of_first = ~second[owner]
        order = np.argsort(element[of_first], kind="stable")
        posting, sizes = owner[of_first][order], np.bincount(element[of_first], minlength=element.max() + 1 if len(element) else 0)
        starts = np.cumsum(sizes) - sizes
        top = {x: x for x in np.unique(label).tolist()}

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = x = top[top[x]]
            return x

        left, right = [], []
        for y in np.flatnonzero(second) if second.any() else first:
            mine = element[ends[y] : ends[y + 1]]
            length = sizes[mine]
            met = np.bincount(posting[np.repeat(starts[mine], length) + ragged(length)], minlength=len(m))[first]
            near = ((100 + percent) * (m[first] + m[y] - 2 * met) <= (100 - percent) * (n[first] + n[y])) & (label[first] != label[y])
            for x in first[near].tolist():
                a, b = root(int(label[x])), root(int(label[y]))
                if a != b:
                    top[a] = b
                    left.append(x)
                    right.append(y)
        ids = table.column("doc_id")
        return pa.table({"a": ids.take(pa.array(left, pa.int64())), "b": ids.take(pa.array(right, pa.int64()))})

    return linked


class _Finder:
    """Candidates, their verification and the components of one table of class representatives."""

    def __init__(self, docs: DataFrame, reps: DataFrame, size: int, percent: int, miss: float, scratch: Scratch):
        self.docs, self.size, self.percent, self.miss, self.scratch, self.block = docs, size, percent, miss, scratch, BLOCK
        self.kind = docs.schema["doc_id"].dataType.simpleString()
        self.signs = reps.select("doc_id", "sign", "n")
        members = reps.select("doc_id", "n", F.explode("bands").alias("bucket"))
        shared = members.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
        # a text that shares large buckets in many bands lies in the middle of its neighbours
        score = F.sum("members").over(Window.partitionBy("doc_id"))
        self.members = self.scratch.settled(members.join(shared, "bucket").withColumn("score", score).select("bucket", "doc_id", "n", "score"))

    def sets(self, ids: DataFrame) -> DataFrame:
        """doc_id, items: the full shingle sets of some texts. Up to MAX_IDS ids are broadcast, so texts aren't shuffled."""
        ids = self.scratch.settled(ids.distinct())
        small = ids.count() <= MAX_IDS
        texts = self.docs.select("doc_id", "text").join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
        return self.scratch.settled(texts.mapInArrow(lean(_sets(self.size)), f"doc_id {self.kind}, items array<bigint>").dropDuplicates(["doc_id"]))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """a, b: pairs that reach the threshold on full sets."""
        a, b = (self.signs.select(F.col("doc_id").alias(x), F.col("sign").alias(f"sign_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
        # sizes alone rule out a pair whose smaller set is below percent of the larger one
        near = pairs.join(a, "a").join(b, "b").filter(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
        alive = self.scratch.settled(near.select("a", "b", "sign_a", "sign_b").mapInArrow(lean(_survivors(self.percent, self.miss)), f"a {self.kind}, b {self.kind}"))
        sets = self.sets(alive.select(F.explode(F.array("a", "b")).alias("doc_id")))
        x, y = (sets.select(F.col("doc_id").alias(k), F.col("items").alias(f"items_{k}")) for k in "ab")
        both = alive.join(y, "b").join(x, "a")
        met = F.size(F.array_intersect("items_a", "items_b"))
        return self.scratch.settled(both.filter(100 * met >= self.percent * (F.size("items_a") + F.size("items_b") - met)).select("a", "b"))

    def apart(self, links: DataFrame) -> DataFrame:
        """Members, with their component, of the buckets that still hold several components."""
        label = components(links, self.scratch).withColumnRenamed("v", "doc_id")
        members = self.members.join(label, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        return self.scratch.settled(_mixed(members))

    def links(self) -> DataFrame:
        """Links that join the same components as all links do."""
        middle = self.members.groupBy("bucket").agg(F.max(F.struct("score", "doc_id")).alias("m")).select("bucket", F.col("m.doc_id").alias("a"))
        pairs = self.members.join(middle, "bucket").filter("doc_id <> a").select("a", F.col("doc_id").alias("b"))
        found = self.verified(pairs.distinct())

        # three more pivots for what the first one left apart
        apart = self.apart(found)
        third = [F.max(F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == k, F.struct("score", "doc_id", "label"))) for k in range(3)]
        pivots = apart.groupBy("bucket").agg(F.array(*third).alias("m")).select("bucket", F.explode("m").alias("m")).select("bucket", F.col("m.doc_id").alias("a"), F.col("m.label").alias("la"))
        pairs = apart.join(pivots, "bucket").filter("label <> la").select("a", F.col("doc_id").alias("b"))
        found = self.scratch.settled(found.union(self.verified(pairs.distinct())))

        # The rest meets every member of other components: directly in small buckets, by difference sets in crowded ones.
        apart = self.apart(found)
        size = apart.groupBy("bucket").agg(F.count("*").alias("c"), F.max(F.struct("score", "doc_id")).alias("m")).select("bucket", "c", F.col("m.doc_id").alias("p"))
        apart = apart.join(size, "bucket")
        x, y = (apart.filter(F.col("c") <= CROWD).select("bucket", *(F.col(c).alias(f"{c}_{k}") for c in ("doc_id", "label", "n"))) for k in "ab")
        near = (F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("label_a") != F.col("label_b")) & (100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
        rest = x.join(y, (x.bucket == y.bucket) & near).select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
        crowded = self.scratch.settled(apart.filter((F.col("c") > CROWD) & (F.col("doc_id") != F.col("p"))).select("p", "doc_id", "n", "label").distinct())
        return found.union(self.verified(rest.distinct())).union(self.within(crowded))

    def within(self, crowded: DataFrame) -> DataFrame:
        """a, b: links of members with their pivot p, and with each other, that join the components all links join.

        Pivots of more than `block` members are split into blocks, which meet in pairs.
        """
        sets = self.sets(crowded.select("doc_id").union(crowded.select("p")))
        both = crowded.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("p"), F.col("items").alias("middle")), "p")
        gap = F.array_union(F.array_except("items", "middle"), F.array_except("middle", "items"))
        rows = self.scratch.settled(both.select("p", "doc_id", "n", F.xxhash64("label").alias("lab"), F.size("middle").alias("np"), gap.alias("gap")))
        with_p = rows.filter((100 + self.percent) * F.size("gap") <= (100 - self.percent) * (F.col("n") + F.col("np"))).select(F.col("p").alias("a"), F.col("doc_id").alias("b"))
        blocks = rows.join(rows.groupBy("p").agg(F.ceil(F.count("*") / self.block).cast("int").alias("k")), "p").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int"))
        meets = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
        meets = blocks.select("p", "doc_id", "n", "lab", "gap", "own", meets).select("p", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc_id", "n", "lab", "gap", (F.col("own") > F.col("other")).alias("second"))
        inner = meets.groupBy("p", "i", "j").applyInArrow(lean_group(_linked(self.percent)), f"a {self.kind}, b {self.kind}")
        return self.scratch.settled(with_p.union(inner))


def _mixed(members: DataFrame) -> DataFrame:
    several = members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("bucket")
    return members.join(several, "bucket", "left_semi")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Shingles: `size` words in a row, A-Z lowered; a shorter text is one shingle, null and empty texts have none and are
    linked with nothing. Texts are linked if 100 * intersection >= percent * union. component_id: the smallest doc_id
    that links reach. Rows that repeat a doc_id are told apart by their texts, each in the component of its text; rows
    without id stay alone (null, kept).
    """
    key = _key(docs)
    found = _found(docs.select(key.alias("doc_id"), "text"), size, percent, miss)
    if isinstance(found.schema["doc_id"].dataType, StructType) and not isinstance(docs.schema["doc_id"].dataType, StructType):
        found = found.withColumns({c: F.col(f"{c}.id") for c in ("doc_id", "component_id")})
    return found


def kept_rows(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """The rows of docs with the smallest id of each component, rows of equal doc_id and text once; all rows without id stay."""
    key = _key(docs)
    kept = _found(docs.select(key.alias("doc_id"), "text"), size, percent, miss).filter("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias("key")).distinct()
    rows = docs.filter("doc_id is not null").select(key.alias("key"), F.struct("*").alias("given"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("given.*").unionByName(docs.filter("doc_id is null"))


def _key(docs: DataFrame) -> Column:
    """What tells texts apart: doc_id or, in tables where an id has several texts, doc_id with the text's hash."""
    th = F.xxhash64(F.col("text").cast("string"))
    ids = docs.filter("doc_id is not null").select("doc_id", th.alias("th")).groupBy("doc_id").agg(F.min("th").alias("lo"), F.max("th").alias("hi"))
    if ids.filter("lo < hi").isEmpty():
        return F.col("doc_id")
    return F.when(F.col("doc_id").isNotNull(), F.struct(F.col("doc_id").alias("id"), th.alias("th")))


def _found(docs: DataFrame, size: int, percent: int, miss: float) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {kind}, n long, c1 long, c2 long, bands array<bigint>, sign binary"
    scratch = Scratch(docs.sparkSession)
    sketches = scratch.settled(docs.mapInArrow(lean(_sketch(size)), schema))
    classes = sketches.filter("n > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"))
    reps = sketches.join(classes.select(F.col("rep").alias("doc_id"), "c1", "c2"), ["doc_id", "c1", "c2"], "left_semi").dropDuplicates(["doc_id"])
    label = components(_Finder(docs, scratch.settled(reps), size, percent, miss, scratch).links(), scratch)
    named = classes.join(label, classes.rep == label.v, "left").select("c1", "c2", F.coalesce("label", "rep").alias("top"))
    out = sketches.select("doc_id", "n", "c1", "c2").join(named, ["c1", "c2"], "left")
    top = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("top")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), top.alias("component_id"), F.coalesce(F.col("doc_id") == top, F.lit(True)).alias("kept"))


# All pairs with a common shingle, then everything that is reachable.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN smallest USING (doc_id)
"""
