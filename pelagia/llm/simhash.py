"""SimHash near-duplicates by a self-join of the binary trie of all fingerprints.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's shingles. Distinct fingerprints are the
leaves of a binary trie. The join walks down pairs of nodes together, adds up the bits in which they differ, and leaves a
pair as soon as these are more than allowed. Its upper part runs as joins of tables of nodes: only pairs that hold many
leaves are opened, a few bits a round, so a crowded prefix goes deeper than others. Every pair of nodes with few leaves is
then walked to the end inside a task, and a pair without any bits left is a join by the bits below.

A fingerprint has at most 2,080 others within two bits, so the pairs are bounded however the texts are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pelagia.llm.common import (chunks, lowered, partitions, ranges, read, spaced_words, text_bytes, with_id, without_id,
                                word_spans)
from pelagia.llm.registry import query
from pelagia.operators.components import connected_components
from pelagia.runtime import attach, stage, stage_counting

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
DISTANCE = 2
# A pair of nodes with more leaves than this is opened by a join, by so many bits at once.
PAIR_LEAVES = 1024
STEP_BITS = 3
# Leaves that a task walks at once, pairs of nodes that it holds at once, and hashes that it counts at once.
CELL_LEAVES = 32_768
FRONT_PAIRS = 1 << 20
HASHES = 1 << 16


def shingle_spans(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased words joined by one space, where each shingle begins and ends in them, and its row.

    A row with fewer than ``words`` words has one shingle, its whole sequence; a row without words has none.
    """
    inside = spaced_words()
    starts, ends, first = word_spans(data, bounds, inside)
    kept = inside[data]
    body = kept.copy()
    gaps = ends[ends < len(data)]
    kept[gaps] = True  # one separator after every word; a word that ends its row may have none
    body, data = body[kept], lowered()[data][kept]
    data[~body] = 0x20
    place = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(kept, out=place[1:])
    starts, ends = place[starts], place[ends]
    count = np.diff(first)
    shingles = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    row = np.repeat(np.arange(len(count)), shingles)
    begin = ranges(first[:-1], shingles)
    last = begin + np.minimum(count, words)[row] - 1
    return data.tobytes(), starts[begin], ends[last], row


def fingerprints_of(column: pa.Array, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of every row of a text column, as signed 64-bit numbers; 0 for null and wordless texts."""
    data, bounds = text_bytes(column)
    raw, begin, end, row = shingle_spans(data, bounds, words)
    ones = np.zeros((len(column), BITS), np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(row), HASHES):
        some = slice(at, at + HASHES)
        hashes = b"".join([digest(raw[a:b], seed) for a, b in zip(begin[some].tolist(), end[some].tolist())])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        rows, first = np.unique(row[some], return_index=True)
        ones[rows] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    total = np.bincount(row, minlength=len(column))
    packed = np.packbits(2 * ones > total[:, None], axis=1)
    return packed.view(">u8").reshape(-1).astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, fingerprint`` (a signed long) of every row of ``docs(doc_id, text)``."""
    def compute(batches):
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints_of(batch.column("text"), words, seed))],
                                             ["doc_id", "fingerprint"])

    return docs.select(with_id(), "text").mapInArrow(compute, "doc_id long, fingerprint long")


# --- the upper part of the trie ------------------------------------------------------------------------

def _node(leaf: Column, depth: int) -> Column:
    """The node at ``depth`` above a leaf: its first bits, as a number."""
    return F.shiftrightunsigned(leaf, BITS - depth) if depth else F.lit(0).cast("long")


def walk_rows(leaves: DataFrame, distance: int, limit: int) -> DataFrame:
    """``unit, side, leaf, depth, inside``: what tasks have to walk, whole units at a time.

    The walk starts with the root beside itself. A pair of nodes with more than ``limit`` leaves together is joined with the children
    of both, and differing bits are added up. Pairs with fewer leaves are units: the leaves of both nodes on a side each, or on one
    if a node is beside itself. A pair whose bits are used up by the ones above ``depth`` has leaves in common only if all
    bits below are equal, so these make a unit of all leaves with equal ones, which is a single leaf mostly and left out then.
    ``inside`` is the number of leaves of the node that was opened there.
    """
    spark, n = leaves.sparkSession, leaves.count()
    none = F.lit(None).cast("long").alias("inside")
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("differ"),
                                  F.lit(n).alias("n_a"), F.lit(n).alias("n_b"))
    out, depth = None, 0
    while True:
        crowded = F.col("n_a") + F.col("n_b") > limit
        pairs, rest = stage_counting(pairs, crowded, "pairs")
        side_a, side_b = (F.struct(F.lit(i).alias("side"), F.col(c).alias("node")) for i, c in enumerate("ab"))
        sides = F.when(F.col("a") == F.col("b"), F.array(side_a)).otherwise(F.array(side_a, side_b))
        units = pairs.where(~crowded).select(F.xxhash64(F.lit(depth), "a", "b").alias("unit"), F.explode(sides).alias("s"))
        below = leaves.withColumn("node", _node(F.col("leaf"), depth))
        rows = below.join(units.select("unit", "s.side", "s.node"), "node").select("unit", "side", "leaf", F.lit(0).alias("depth"), none)
        out = rows if out is None else out.unionByName(rows)
        if not rest:
            return out
        opened = pairs.where(crowded)
        step = min(STEP_BITS, BITS - depth)
        depth += step
        if depth < BITS:
            inside = opened.select(F.col("a").alias("node"), F.col("n_a").alias("inside")).union(opened.select("b", "n_b")).distinct()
            equal = F.shiftleft("leaf", depth)
            alike = Window.partitionBy("equal")
            rows = (below.join(inside, "node").withColumn("equal", equal).withColumn("alike", F.count(F.lit(1)).over(alike))
                    .where("alike > 1"))
            out = out.unionByName(rows.select(F.xxhash64(F.lit(depth), "equal", F.lit("equal")).alias("unit"), F.lit(0).alias("side"),
                                              "leaf", F.lit(depth).alias("depth"), "inside"))
        nodes = stage(leaves.groupBy(_node(F.col("leaf"), depth).alias("child")).agg(F.count(F.lit(1)).alias("n")), "nodes")
        parent = F.shiftrightunsigned("child", step)
        left = nodes.select(parent.alias("a"), F.col("child").alias("child_a"), F.col("n").alias("m_a"))
        right = nodes.select(parent.alias("b"), F.col("child").alias("child_b"), F.col("n").alias("m_b"))
        met = opened.select("a", "b", "differ").join(left, "a").join(right, "b")
        # the bits above the children are counted already
        new_bits = F.col("child_a").bitwiseXOR(F.col("child_b")).bitwiseAND(F.lit((1 << step) - 1).cast("long"))
        differ = F.col("differ") + F.bit_count(new_bits)
        most = F.lit(distance if depth == BITS else distance - 1)
        pairs = (met.where((F.col("a") != F.col("b")) | (F.col("child_a") <= F.col("child_b"))).where(differ <= most)
                 .select(F.col("child_a").alias("a"), F.col("child_b").alias("b"), differ.alias("differ"),
                         F.col("m_a").alias("n_a"), F.col("m_b").alias("n_b")))


# --- the lower part ------------------------------------------------------------------------------------

def walk(leaf: np.ndarray, a: np.ndarray, b: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of leaves that differ by at most ``distance`` bits.

    ``leaf`` holds unsigned numbers, ascending inside every range; ``a`` and ``b`` (2 x pairs) are the ranges of the nodes to
    begin with, a node beside itself has equal ones. Ranges are nodes: the leaves below a node whose next bit is 0 come first,
    so a count of ones splits a range into its children.
    """
    ones = np.zeros((BITS, len(leaf) + 1), np.int32)
    for bit in range(BITS):
        np.cumsum(((leaf >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), out=ones[bit, 1:])
    todo = [(BITS - 1, np.concatenate([a, b, np.zeros((1, a.shape[1]), np.int64)]))]
    while todo:
        bit, front = todo.pop()
        if front.shape[1] > FRONT_PAIRS:
            middle = front.shape[1] // 2
            todo += [(bit, front[:, :middle]), (bit, front[:, middle:])]
            continue
        al, ah, bl, bh, differ = front
        one = ones[bit]
        am, bm = ah - (one[ah] - one[al]), bh - (one[bh] - one[bl])
        apart = al != bl
        more = np.concatenate([np.stack([al, am, bl, bm, differ]), np.stack([am, ah, bm, bh, differ]),
                               np.stack([al, am, bm, bh, differ + 1]),
                               np.stack([am, ah, bl, bm, differ + 1])[:, apart]], axis=1)
        size_a, size_b = more[1] - more[0], more[3] - more[2]
        # a leaf beside itself is no pair
        keep = (size_a > 0) & (size_b > 0) & (more[4] <= distance) & ((more[0] != more[2]) | (size_a > 1))
        more, single = more[:, keep], ((size_a == 1) & (size_b == 1))[keep]
        left, right = more[0, single], more[2, single]
        near = np.bitwise_count(leaf[left] ^ leaf[right]) <= distance
        if near.any():
            yield left[near], right[near]
        if bit and not single.all():
            todo.append((bit - 1, more[:, ~single]))


def smallest_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least number of each one's component among ``n`` numbers linked by ``u, v``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


def neighbours(leaves: DataFrame, distance: int = DISTANCE, limit: int = PAIR_LEAVES) -> DataFrame:
    """``leaf, root, links``: linked leaves, once per task that finds links of theirs.

    ``leaves(leaf)`` are distinct. ``links`` is the number of other leaves within ``distance`` bits, to be added up, and ``root``
    the least one that the links of the task lead to, so that the pairs ``leaf, root`` have the components of all links.
    """
    rows = stage(walk_rows(leaves, distance, limit), "walks")
    cells = max(partitions(leaves.sparkSession), -(-rows.count() // CELL_LEAVES))

    def join(table: pa.Table) -> pa.Table:
        unit, side = table.column("unit").to_numpy(), table.column("side").to_numpy()
        leaf = table.column("leaf").to_numpy().view(np.uint64)
        order = np.lexsort((leaf, side, unit))
        unit, side, leaf = unit[order], side[order], leaf[order]
        depth, inside = (table.column(c).fill_null(0).to_numpy()[order] for c in ("depth", "inside"))
        new = np.ones(len(unit), bool)
        new[1:] = (unit[1:] != unit[:-1]) | (side[1:] != side[:-1])
        cuts = np.append(np.flatnonzero(new), len(unit))
        low, high, side, unit = cuts[:-1], cuts[1:], side[cuts[:-1]], unit[cuts[:-1]]
        first = np.flatnonzero(side == 0)
        other = np.where(np.append(unit[1:] == unit[:-1], False)[first], first + 1, first)
        pairs = list(walk(leaf, np.stack([low[first], high[first]]), np.stack([low[other], high[other]]), distance))
        u, v = (np.concatenate(side) if pairs else np.zeros(0, np.int64) for side in (zip(*pairs) if pairs else ((), ())))
        # leaves with equal bits below a depth: only pairs that have used all bits right above it, and were opened there
        above = np.where(depth[u] > 0, BITS - depth[u] + STEP_BITS, 0).astype(np.uint64)
        differ = leaf[u] ^ leaf[v]
        here = (np.bitwise_count(differ) == distance) & (np.bitwise_count(differ >> above) < distance) & (inside[u] + inside[v] > limit)
        mine = (depth[u] == 0) | here
        u, v = u[mine], v[mine]
        # a leaf stands in several pairs of nodes: number the distinct ones
        value, number = np.unique(leaf, return_inverse=True)
        u, v = number[u], number[v]
        links = np.bincount(u, minlength=len(value)) + np.bincount(v, minlength=len(value))
        root = value[smallest_labels(len(value), u, v)]
        some = links > 0
        return pa.table({"leaf": pa.array(value[some].view(np.int64)), "root": pa.array(root[some].view(np.int64)),
                         "links": pa.array(links[some].astype(np.int64))})

    return rows.groupBy(F.pmod(F.xxhash64("unit"), F.lit(cells)).alias("cell")).applyInArrow(
        join, "leaf long, root long, links long")


def near_fingerprints(docs: DataFrame, distance: int = DISTANCE, words: int = SHINGLE_WORDS,
                      limit: int = PAIR_LEAVES) -> DataFrame:
    """``doc_id, fingerprint, component_id, n_links`` for every row of ``docs(doc_id, text)``; other columns are ignored.

    Documents are linked if their fingerprints (16 lowercase hex digits) differ by at most ``distance`` bits; ``component_id`` is the
    least doc_id that links lead to, a document's own if there are none, and ``n_links`` the number of other
    fingerprints linked to its own. Null, empty and wordless texts have the fingerprint 0, linked like any other. Rows with
    one doc_id, or none, count by their own texts; a null doc_id comes after all others and stays null. An empty table
    gives an empty result.
    """
    signed = stage(fingerprints(docs, words), "fingerprints")
    classes = stage(signed.groupBy(F.col("fingerprint").alias("leaf")).agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    found = stage(neighbours(classes.select("leaf"), distance, limit), "neighbours")
    degree = found.groupBy("leaf").agg(F.sum("links").alias("n_links"))
    edges = found.where("leaf != root").select(F.lit(0).alias("run"), F.col("leaf").alias("u"), F.col("root").alias("v"))
    nodes = degree.select(F.lit(0).alias("run"), F.col("leaf").alias("id"))
    roots = stage(connected_components(nodes, edges).select(F.col("id").alias("leaf"), "root"), "roots")
    leads = roots.join(classes, "leaf").groupBy("root").agg(F.min("first").alias("lead"))
    linked = attach(roots, leads, ["root"]).join(degree, "leaf").select("leaf", "lead", "n_links")
    # the rest are documents with a fingerprint of their own
    shared = classes.join(linked, "leaf", "left").where("n > 1 OR n_links IS NOT NULL").select(
        F.col("leaf").alias("fingerprint"), F.coalesce("lead", "first").alias("lead"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = attach(signed, shared, ["fingerprint"], "left")
    return out.select(without_id(), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                      F.coalesce("lead", "doc_id").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")).withColumn(
        "component_id", without_id("component_id"))


@query()
def op12_binary_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and the component of documents with near fingerprints."""
    return near_fingerprints(read(spark, folder, "documents"))
