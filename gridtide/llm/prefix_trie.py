"""The prefix trie of conversations, with totals of every subtree.

A node is a distinct sequence of first turns. It is named by a 128-bit sum of hashes of its numbered turns, so that
names along a conversation are running sums and no task needs a whole conversation. Nodes with the same members
form a segment, named by their smallest member and their number.

Totals go from children to parents by time-forward processing: segments are sorted by reverse level order, and a
segment sends its totals to its parent through a priority queue that spills. Subtrees of at most `limit` members
are dealt to shards; what their roots send is added up for each parent outside, and the few nodes with more
members follow in the same way, across the roots of the shards.

Cases: null role or text becomes empty. Turns are in the order of `turn` (null first), equal ones in that of the
MD5 of role and text, so repeated rows stand one after another. Rows without a conversation id belong to no
conversation. Further columns are not read. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.operators.ordering import places
from gridtide.session import cut

BLOCK = 4096  # turns of a conversation that are summed up in one group
HELD = 100_000  # messages of a queue in memory
TOP = 100_000  # about so many nodes with more than `limit` members at most
LEAST = 256
CHUNK = 65_536  # ids that are joined to one text

NODE = ["depth", "k1", "k2"]
LOW = 0xFFFFFFFF


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `pos` (from 1), `token` (of role and text) and `bytes` of the text; written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    own = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", token.alias("token"), F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("uid")
    )
    return cut(places(own, ["conv_id"], ["turn", "token", "uid"], name="pos").select("conv_id", "pos", "token", "bytes"), "turns")


def spliced(turns: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """Rebuilt conversations: `conv_id`, `depth` (from 0, the root), `token`, `bytes` and `length`.

    The first h turns are those of conversation c - c % every, then follow c's own after its first h, where h is
    the CRC-32 of c's decimal digits modulo most + 1.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    base = F.col("conv_id") - F.col("conv_id") % every
    # at most `most` turns of a conversation
    first = turns.where((F.col("pos") <= most) & (F.col("conv_id") == base))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "token", "bytes"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", h).withColumn("base", base)
    convs = convs.join(heads, "base", "left").withColumn("head", F.coalesce(F.expr("slice(head, 1, cast(h as int))"), F.array()))
    convs = convs.withColumn("n_head", F.size("head").cast("long")).withColumn("length", F.expr("n_head + greatest(own - h, 0)"))
    convs = cut(convs.select("conv_id", "own", "h", "n_head", "length", "head"), "conversations")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("token"), F.lit(0).cast("long").alias("bytes"), "length")
    shared = convs.select("conv_id", "length", F.explode("head").alias("e")).select("conv_id", F.col("e.pos").alias("depth"), "e.token", "e.bytes", "length")
    # a row for each block of turns, so that a long conversation is many keys
    parts = convs.where("own > h").select("conv_id", "h", "n_head", "length", F.explode(F.expr(f"sequence(0L, (own - 1) div {BLOCK})")).alias("part"))
    rest = (
        turns.withColumn("part", F.expr(f"(pos - 1) div {BLOCK}"))
        .join(parts, ["conv_id", "part"])
        .where("pos > h")
        .select("conv_id", F.expr("pos - h + n_head").alias("depth"), "token", "bytes", "length")
    )
    return root.unionByName(shared).unionByName(rest)


def paths(turns: DataFrame) -> DataFrame:
    """Adds the names of each turn's node (`k1`, `k2`) and of its parent (`p1`, `p2`, null for the root); written."""
    a, b = F.xxhash64("depth", "token"), F.xxhash64(F.lit("second"), "token", "depth")
    own = [a.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(a, 32), b.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(b, 32)]
    rows = turns.withColumn("part", F.expr(f"depth div {BLOCK}"))
    for k, lane in enumerate(own):
        rows = rows.withColumn(f"own{k}", F.when(F.col("depth") == 0, 0).otherwise(lane))
    lanes = range(len(own))
    # only conversations of several blocks need what lies before a block
    sums = rows.where(F.col("length") >= BLOCK).groupBy("conv_id", "part").agg(*[F.sum(f"own{k}").alias(f"sum{k}") for k in lanes])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv_id", "part", *[F.coalesce(F.sum(f"sum{k}").over(before), F.lit(0)).alias(f"off{k}") for k in lanes])
    here = Window.partitionBy("conv_id", "part").orderBy("depth")
    running = rows.select("*", *[F.sum(f"own{k}").over(here).alias(f"run{k}") for k in lanes]).join(offsets, ["conv_id", "part"], "left")
    total = [F.col(f"run{k}") + F.coalesce(F.col(f"off{k}"), F.lit(0)) for k in lanes]
    parent = [F.when(F.col("depth") > 0, t - F.col(f"own{k}")) for k, t in enumerate(total)]
    names = [_name(*x).alias(c) for x, c in ((total[:2], "k1"), (total[2:], "k2"), (parent[:2], "p1"), (parent[2:], "p2"))]
    return cut(running.select("conv_id", "depth", *names, "bytes", "length"), "paths")


def _name(low: Column, high: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(F.lit(LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(LOW)))


class SpillingQueue:
    """A priority queue that keeps at most `held` entries in memory.

    Beyond that all it holds becomes a sorted run in a scratch file of the task, gone with the queue; a run is
    read a little at a time.
    """

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.heads, self.runs = held, [], [], 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.held:
            file = tempfile.TemporaryFile()
            self.heap.sort()
            for start in range(0, len(self.heap), 1000):
                pickle.dump(self.heap[start : start + 1000], file)
            file.seek(0)
            self.heap, self.runs = [], self.runs + 1
            self._refill(self.runs, _entries(file))

    def _refill(self, number: int, run: Iterator[tuple]) -> None:
        entry = next(run, None)
        if entry is not None:
            heapq.heappush(self.heads, (entry, number, run))

    def first(self) -> tuple | None:
        return min([*self.heap[:1], *(h[0] for h in self.heads[:1])], default=None)

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            entry, number, run = heapq.heappop(self.heads)
            self._refill(number, run)
            return entry
        return heapq.heappop(self.heap)


def _entries(file) -> Iterator[tuple]:
    with file:
        while True:
            try:
                yield from pickle.load(file)
            except EOFError:
                return


TOTALS = "conv_id long, n_convs long, lo long, hi long, up long, outside boolean, children long, leaves long, below long, total long"


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of segments that come by reverse level order (`hi` descending, `conv_id`).

    A parent's last level is the one above its child's first, so its time is known to the child.
    """
    queue = SpillingQueue()
    for batch in batches:
        out = []
        for conv, n, lo, hi, up, outside, gain, children, leaves, below in zip(*(c.to_pylist() for c in batch.columns)):
            while (message := queue.first()) and message[:2] == (-hi, conv):
                queue.pop()
                children, leaves, below = children + 1, leaves + message[2], below + message[3]
            leaves = leaves if children else 1
            out.append((conv, n, lo, hi, up, outside, children, leaves, below, below + gain))
            if not outside:
                queue.push((1 - lo, up, leaves, below + gain))
        names = [f.split()[0] for f in TOTALS.split(", ")]
        kinds = [pa.bool_() if c == "outside" else pa.int64() for c in names]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)
    if queue.first():
        raise RuntimeError("totals were sent to a segment that is not in its child's shard")


def _sent(segments: DataFrame, by: list[str], ranges: int) -> DataFrame:
    fields = ["conv_id", "n_convs", "lo", "hi", "up", "outside", "gain", "children", "leaves", "below"]
    spread = segments.repartition(ranges, *by) if by else segments.repartition(1)
    return spread.sortWithinPartitions(F.desc("hi"), "conv_id").select(*fields).mapInArrow(_forward, TOTALS)


def _segments(nodes: DataFrame, steps: DataFrame, limit: int) -> DataFrame:
    """Segments with `up`, the smallest member of their parent, and `shard`, the root of their subtree with at most
    `limit` members; null for those with more. `outside`: the parent is in no shard, or there is none."""
    large = nodes.where(F.col("n_convs") > limit).select(*NODE, F.col("conv_id").alias("owner"))
    # each has more than `limit` rows in `steps`, so there are at most TOP of them, or of rows / LEAST if that is less
    large = F.broadcast(cut(large, "large"))
    above = large.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "owner")
    roots = steps.join(above.drop("owner"), ["depth", "p1", "p2"], "left_semi").unionByName(steps.where("depth = 0"))
    shards = roots.join(large, NODE, "left_anti").select("conv_id", F.struct(*NODE).alias("shard"))
    first = F.min(F.struct("depth", "p1", "p2")).alias("first")
    segments = nodes.groupBy("conv_id", "n_convs").agg(F.max("depth").alias("hi"), F.sum("gain").alias("gain"), first)
    segments = segments.select("conv_id", "n_convs", F.col("first.depth").alias("lo"), "hi", "gain", F.col("first.p1").alias("p1"), F.col("first.p2").alias("p2"))
    tops = segments.withColumn("depth", F.col("lo"))
    near = tops.join(above, ["depth", "p1", "p2"], "left")
    small = nodes.where(F.col("n_convs") <= limit).select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("mother"))
    far = near.where("owner is null and depth > 0").join(small, ["depth", "p1", "p2"])
    outside = [c.alias(n) for c, n in ((F.col("owner"), "up"), (F.lit(True), "outside"))]
    inside = [c.alias(n) for c, n in ((F.col("mother"), "up"), (F.lit(False), "outside"))]
    fields = ["conv_id", "n_convs", "lo", "hi", "gain"]
    linked = near.where("owner is not null or depth = 0").select(*fields, *outside).unionByName(far.select(*fields, *inside))
    light = linked.where(F.col("n_convs") <= limit).join(shards, "conv_id")
    heavy = linked.where(F.col("n_convs") > limit).withColumn("shard", F.lit(None).cast(light.schema["shard"].dataType))
    return cut(light.unionByName(heavy, allowMissingColumns=True), "segments")


def _totals(segments: DataFrame) -> DataFrame:
    """`children`, `leaves` and `below` (saved under its last node) of each segment."""
    ranges = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = {c: F.lit(0).cast("long") for c in ("children", "leaves", "below")}
    within = cut(_sent(segments.where("shard is not null").withColumns(none), ["shard"], ranges), "within")
    to_top = (
        within.where("outside and up is not null")
        .groupBy(F.col("up").alias("conv_id"), (F.col("lo") - 1).alias("hi"))
        .agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("total").alias("below"))
    )
    # at most TOP rows; among them a parent is in no shard either
    top = segments.where("shard is null").join(to_top, ["conv_id", "hi"], "left").na.fill(0, list(none)).withColumn("outside", F.col("up").isNull())
    return within.unionByName(_sent(top, [], 1)).drop("outside", "total")


def end_digests(steps: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending and comma-joined.

    Ids are sorted over all ranges and joined to texts there; a digest takes a node's texts one after another.
    """
    ranges = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = steps.where("depth = length").select(*NODE, "conv_id")
    texts = ends.repartitionByRange(ranges, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(_joined, "depth long, k1 long, k2 long, first long, ids string")
    return texts.repartition(ranges, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digested, "depth long, k1 long, k2 long, ends_sha256 string")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _packed(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    for some in itertools.batched(rows, 4096):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some)], names)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def texts():
        for node, rows in itertools.groupby(_rows(batches), lambda r: r[:3]):
            for some in itertools.batched((r[3] for r in rows), CHUNK):
                yield *node, some[0], ",".join(map(str, some))

    yield from _packed(texts(), [*NODE, "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests():
        for node, rows in itertools.groupby(_rows(batches), lambda r: r[:3]):
            digest = hashlib.sha256(next(rows)[4].encode())
            for row in rows:
                digest.update(b"," + row[4].encode())
            yield *node, digest.hexdigest()

    yield from _packed(digests(), [*NODE, "ends_sha256"])


def build_trie(turns: DataFrame, limit: int | None = None) -> DataFrame:
    """The nodes of the trie over `conv_id`, `depth` (0, the root, and each turn), `token`, `bytes`, `length`.

    `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs` members, `n_children`, `n_leaves` (childless
    nodes of the subtree), `saved_tokens` (over the subtree, (n_convs - 1) * bytes of the last turn) and
    `ends_sha256`. `limit`: members of a subtree that one shard may hold.
    """
    steps = paths(turns)
    grouped = steps.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    nodes = cut(grouped.withColumn("gain", (F.col("n_convs") - 1) * F.col("bytes")).drop("bytes"), "nodes")
    if limit is None:
        rows = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
        limit = max(LEAST, -(-rows // TOP))
    totals = _totals(_segments(nodes, steps, limit))
    own = ["conv_id", "n_convs"]
    parts = nodes.withColumn("part", F.expr(f"depth div {BLOCK}"))
    deeper = Window.partitionBy(*own).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy(*own, "part").agg(F.sum("gain").alias("gain"))
    sums = sums.select(*own, "part", F.coalesce(F.sum("gain").over(deeper), F.lit(0)).alias("rest")).join(totals, own)
    here = Window.partitionBy(*own, "part").orderBy(F.desc("depth"))
    found = parts.withColumn("inner", F.sum("gain").over(here)).join(sums, [*own, "part"])
    digests = end_digests(steps)
    last = F.col("depth") == F.col("hi")
    return found.join(digests, NODE, "left").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("lo"), F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("inner") + F.col("rest") + F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
