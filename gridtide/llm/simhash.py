"""SimHash near-duplicates through Gray-order hierarchical indexes.

Fingerprints are reduced to different values first. The 64 bits are cut into blocks; with more blocks
than differing bits, two linked fingerprints agree on some choice of blocks. For each choice, an order
puts these blocks first and sorts by Gray rank. A node of the index is a run of fingerprints in that
order with the bits all of them share; the upper nodes are the chosen blocks, and the comparison of two
nodes on their shared bits leaves out whole groups. The orders are range-partitioned, so a node with
many fingerprints spreads over partitions. Each partition returns a spanning forest of its links, not
the pairs. Nodes that lie on several partitions are then compared across these, in blocks, but only
where more than one component is left in them.

Cases: a text without words (null, empty, white space) has fingerprint zero and is linked like any
other. Each row has a fingerprint; repeated rows share a component. A null id never names a component
unless all ids of the component are null. An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.components import components
from gridtide.session import cut

SEED = 42
LEAF = 32  # children of a node of the index
LINK, SPLIT = 0, 1


def fingerprint(text: str | None, shingle: int) -> int:
    """The majority bits of the XXH64 of all shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], "<u8")
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _tag(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `doc_tag` (a hash of id and text) and `code`, the fingerprint as a signed long."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes)], ["doc_id", "doc_tag", "code"])

    rows = docs.select(F.col(id_col).alias("doc_id"), _tag(id_col, text_col).alias("doc_tag"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(read, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, doc_tag long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The places of 64-bit codes in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Orders:
    """Arrangements of the bits in which each choice of `blocks - distance` blocks comes first."""

    def __init__(self, distance: int, blocks: int):
        cuts = np.linspace(0, 64, blocks + 1).round().astype(int)
        parts = [range(cuts[k], cuts[k + 1]) for k in range(blocks)]
        self.bits, self.key_bits = [], []
        for chosen in itertools.combinations(range(blocks), blocks - distance):
            order = [*chosen, *(k for k in range(blocks) if k not in chosen)]
            self.bits.append([parts[k] for k in order])
            self.key_bits.append(sum(len(parts[k]) for k in chosen))

    def arrange(self, codes: np.ndarray, order: int) -> np.ndarray:
        """The codes with their blocks in the given order, from the highest bit on."""
        out, left = np.zeros_like(codes), 64
        for part in self.bits[order]:
            left -= len(part)
            out |= (codes >> np.uint64(part.start) & np.uint64((1 << len(part)) - 1)) << np.uint64(left)
        return out


class Forest:
    """Components of numbered items, grown by links."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


class GrayIndex:
    """Nodes over codes in Gray order: the bits that all codes below a node share, level by level."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        ands, ors = codes, codes
        self.shared, self.pattern, self.below = [], [], []
        while True:
            starts = np.arange(0, len(ands), LEAF)
            self.below.append(len(ands))
            ands, ors = np.bitwise_and.reduceat(ands, starts), np.bitwise_or.reduceat(ors, starts)
            self.shared.append(~(ands ^ ors))
            self.pattern.append(ands)
            if len(starts) == 1:
                return

    def link(self, forest: Forest, distance: int) -> None:
        """Adds all links among the codes to `forest`, whose items are the places of the codes."""
        beside = np.flatnonzero(_near(self.codes[1:], self.codes[:-1], distance))
        forest.add(beside, beside + 1)
        top = len(self.pattern) - 1
        self._descend(forest, distance, self, 0, [(top, np.zeros(1, int), np.zeros(1, int))])

    def link_with(self, other: GrayIndex, forest: Forest, distance: int) -> None:
        """Adds the links with the codes of `other`, whose items follow those of this index."""
        if len(other.pattern) > len(self.pattern):
            return other._lift(len(other.pattern), self, forest, distance, swapped=True)
        return self._lift(len(self.pattern), other, forest, distance, swapped=False)

    def _lift(self, levels: int, other: GrayIndex, forest: Forest, distance: int, swapped: bool) -> None:
        while len(other.pattern) < levels:
            other.below.append(len(other.pattern[-1]))
            other.shared.append(other.shared[-1])
            other.pattern.append(other.pattern[-1])
        mine, theirs = (other, self) if swapped else (self, other)
        mine._descend(forest, distance, theirs, len(mine.codes), [(levels - 1, np.zeros(1, int), np.zeros(1, int))])

    def _children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kids = nodes[:, None] * LEAF + np.arange(LEAF)
        return kids, kids < self.below[level]

    def _descend(self, forest: Forest, distance: int, other: GrayIndex, shift: int, stack: list) -> None:
        own = other is self
        while stack:
            level, a, b = stack.pop()
            if len(a) > 2048:
                stack += [(level, a[k : k + 2048], b[k : k + 2048]) for k in range(0, len(a), 2048)]
                continue
            # differences on the bits that both nodes share only grow further down
            both = self.shared[level][a] & other.shared[level][b]
            open_ = np.bitwise_count((self.pattern[level][a] ^ other.pattern[level][b]) & both) <= distance
            if own:  # groups that are one component need no links
                starts = np.arange(0, len(self.codes), LEAF ** (level + 1))
                low, high = np.minimum.reduceat(forest.root, starts), np.maximum.reduceat(forest.root, starts)
                open_ &= (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
            a, b = a[open_], b[open_]
            if not len(a):
                continue
            left, has_left = self._children(level, a)
            right, has_right = other._children(level, b)
            pairs = has_left[:, :, None] & has_right[:, None, :]
            if own:
                pairs &= left[:, :, None] < right[:, None, :] if level == 0 else left[:, :, None] <= right[:, None, :]
            row, x, y = np.nonzero(pairs)
            x, y = left[row, x], right[row, y]
            if level:
                stack.append((level - 1, x, y))
                continue
            apart = forest.root[x] != forest.root[y + shift]
            x, y = x[apart], y[apart]
            near = _near(self.codes[x], other.codes[y], distance)
            forest.add(x[near], y[near] + shift)


def _link_sorted(order: np.ndarray, key: np.ndarray, codes: np.ndarray, distance: int) -> Forest:
    """Links inside each run of equal (order, key)."""
    forest = Forest(len(codes))
    begins = np.flatnonzero(np.concatenate([[True], (order[1:] != order[:-1]) | (key[1:] != key[:-1])]))
    ends = np.append(begins[1:], len(codes))
    size = np.repeat(ends - begins, ends - begins)
    run_end = np.repeat(ends, ends - begins)
    small = np.flatnonzero((size > 1) & (size <= 2 * LEAF))
    step = 1
    while len(small):
        small = small[small + step < run_end[small]]
        near = small[_near(codes[small], codes[small + step], distance)]
        forest.add(near, near + step)
        step += 1
    for a, b in zip(begins.tolist(), ends.tolist()):
        if b - a > 2 * LEAF:
            part = Forest(b - a)
            GrayIndex(codes[a:b]).link(part, distance)
            forest.add(np.arange(a, b), a + part.root)
    return forest


def _runs(orders: Orders, distance: int):
    """Streams one range partition; a run that goes on in the next batch waits for it."""
    key_bits = np.array(orders.key_bits, np.uint64)

    def found(kind: int, order, key, a, b) -> pa.RecordBatch:
        n = len(a)
        arrays = [pa.array(np.full(n, kind, np.int8)), pa.array(order.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "place", "bucket", "a", "b"])

    def links(order, key, codes) -> pa.RecordBatch:
        root = _link_sorted(order, key, codes, distance).root
        moved = np.flatnonzero(root != np.arange(len(root)))
        return found(LINK, order[moved], key[moved], codes[root[moved]], codes[moved])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[tuple] = []
        first = True
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                order = batch.column(0).to_numpy().astype(np.int64)
                rank = batch.column(1).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
                codes = batch.column(2).to_numpy().view(np.uint64)
                wait.append((order, rank >> (np.uint64(64) - key_bits[order]), codes.copy()))
                if wait[0][0][0] == order[-1] and wait[0][1][0] == wait[-1][1][-1]:
                    continue  # still the run that waits
            if not wait:
                return
            order, key, codes = (np.concatenate(x) for x in zip(*wait))
            changes = np.flatnonzero((order[1:] != order[:-1]) | (key[1:] != key[:-1])) + 1
            last = changes[-1] if len(changes) else 0
            done = len(codes) if batch is None else last
            wait = [(order[done:], key[done:], codes[done:])] if done < len(codes) else []
            ends = changes[0] if len(changes) else len(codes)
            if done:
                yield links(order[:done], key[:done], codes[:done])
            if first and done:  # this run may have begun in the partition before
                yield found(SPLIT, order[:ends], key[:ends], codes[:ends], codes[:ends])
                first = False
                if batch is None and not last:
                    return
            if batch is None and last < len(codes):  # and this one may go on in the next
                yield found(SPLIT, order[last:], key[last:], codes[last:], codes[last:])

    return stream


def _across(distance: int):
    """Links between the sides of a block, or inside it where both sides are the same rows."""

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["side", "code"])
        sides = []
        for side in (0, 1):
            part = rows[rows["side"] == side]
            codes = part["code"].to_numpy().view(np.uint64)
            by_rank = np.argsort(gray_rank(codes), kind="stable")
            sides.append((codes[by_rank], part["comp"].to_numpy()[by_rank]))
        codes, comp = (np.concatenate(x) for x in zip(*sides))
        forest = Forest(len(codes))
        _, first, which = np.unique(comp, return_index=True, return_inverse=True)
        forest.add(np.arange(len(codes)), first[which])
        known = forest.root.copy()
        if len(sides[0][0]) and len(sides[1][0]):
            GrayIndex(sides[0][0]).link_with(GrayIndex(sides[1][0]), forest, distance)
        elif len(codes):
            GrayIndex(codes).link(forest, distance)
        new = np.flatnonzero((known == np.arange(len(known))) & (forest.root != known))
        return pd.DataFrame({"a": codes[forest.root[new]].view(np.int64), "b": codes[new].view(np.int64)})

    return link


def _cross_links(split: DataFrame, linked: DataFrame, distance: int, block: int) -> DataFrame:
    """Links inside index nodes that lie on several partitions, between components of `linked`.

    The rows of the largest component of a node meet all others, and the others each other, in blocks
    of about `block` rows; rows of one component need no comparison.
    """
    node = ["place", "bucket"]
    comp = F.coalesce("root", "code").alias("comp")
    rows = split.join(linked.withColumnRenamed("node", "code"), "code", "left").select(*node, "code", comp)
    sizes = rows.groupBy(*node, "comp").agg(F.count("*").alias("n"))
    largest = sizes.groupBy(*node).agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"), F.count("*").alias("comps")
    )
    mixed = largest.where(F.col("comps") > 1).select(
        *node,
        F.col("top.comp").alias("main"),
        F.ceil(F.col("top.n") / block).cast("int").alias("main_blocks"),
        F.ceil((F.col("total") - F.col("top.n")) / block).cast("int").alias("rest_blocks"),
    )
    rows = rows.join(mixed, node)
    is_main = F.col("comp") == F.col("main")
    mine = F.pmod(F.xxhash64("code"), F.when(is_main, F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("is_main", is_main)
    meets = F.explode(F.expr("sequence(0, if(is_main, rest_blocks, main_blocks) - 1)"))
    with_main = rows.select(*node, F.lit(0).alias("task"), "code", "comp", "is_main", "mine", meets.alias("other")).select(
        *node, "task", "code", "comp",
        F.expr("if(is_main, mine, other)").alias("i"), F.expr("if(is_main, other, mine)").alias("j"),
        F.expr("if(is_main, 0, 1)").alias("side"),
    )
    rest = rows.where(~F.col("is_main")).select(*node, F.lit(1).alias("task"), "code", "comp", "mine", F.explode(F.expr("sequence(0, rest_blocks - 1)")).alias("other")).select(
        *node, "task", "code", "comp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        F.expr("if(mine <= other, 0, 1)").alias("side"),
    )
    return with_main.unionByName(rest).groupBy(*node, "task", "i", "j").applyInPandas(_across(distance), "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int | None = None, block: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `doc_tag`, `code`, `component_id` (the smallest id reachable through links) and `root`.

    `root` is a fingerprint that names the component.

    `blocks` (more than `distance`) trades orders against the size of upper nodes; whatever it is, no
    link is lost. By default it grows with the number of fingerprints. `block` is the number of rows
    compared at once where a node lies on several partitions.
    """
    prints = cut(fingerprints(docs, shingle, id_col, text_col), "prints")
    codes = cut(prints.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    if blocks is None:
        blocks = distance + (2 if codes.count() < 1 << 26 else 3)
    orders = Orders(distance, blocks)

    def arranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for order in range(len(orders.bits)):
                rank = gray_rank(orders.arrange(values, order)) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), order, np.int32)), pa.array(rank.view(np.int64)), batch.column(0)], ["place", "rank", "code"]
                )

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = codes.select("code").mapInArrow(arranged, "place int, rank long, code long")
    dealt = rows.repartitionByRange(parts, "place", "rank").sortWithinPartitions("place", "rank")
    found = cut(dealt.mapInArrow(_runs(orders, distance), "kind byte, place int, bucket long, a long, b long"), "links")
    links = found.where(F.col("kind") == LINK).select("a", "b")
    linked = cut(components(links), "linked")
    split = found.where(F.col("kind") == SPLIT).select("place", "bucket", F.col("a").alias("code"))
    across = cut(_cross_links(split, linked, distance, block), "links")
    if not across.isEmpty():
        forest = linked.select(F.col("node").alias("a"), F.col("root").alias("b"))
        linked = cut(components(forest.unionByName(across)), "linked")
    grouped = codes.join(linked.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("code", "component_id", "root")
    return prints.join(named, "code").select("doc_id", "doc_tag", "code", "component_id", "root")


def first_of_groups(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: that with the smallest id; an id before none."""
    groups = near_duplicates(docs, shingle, distance, id_col=id_col, text_col=text_col)
    first = groups.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "doc_tag")).alias("first"))
    kept = first.select(F.col("first.doc_tag").alias("doc_tag_"))
    rows = docs.withColumn("doc_tag_", _tag(id_col, text_col)).join(kept, "doc_tag_", "left_semi")
    return rows.dropDuplicates(["doc_tag_"]).select(docs.columns)
