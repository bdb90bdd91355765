"""Near-duplicate documents by an LSH forest, confirmed on full shingle sets.

Documents with equal shingle sets form a class with a number of its own. Every class gets 24 labels of
eight MinHash values, one for each tree. In a tree, classes that share a prefix of four values are a region; a region
with more than ``REGION`` classes goes one value deeper, and so on, and one that is still larger at full depth is
compared in tiles. Each member proposes its most similar neighbour of the region, proposals are confirmed on the full
sets and joined to components. A second pass then looks at every region that still holds several components:
all its pairs that may reach the threshold are confirmed too. A link is lost if no tree puts its ends into one region, or
if their MinHash values agree so rarely that the pair isn't confirmed. At the threshold the first has a chance of 2e-8 for
85 % and 3e-6 for 80 %, and up to 1e-3 if every region of both is crowded down to full depth (see :func:`last_depth`); the
second has a chance of at most 1e-9 (see :func:`least_agreement`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pelagia.llm.common import (chunks, lowered, mixed, packed, partitions, read, spaced_words, text_bytes, window_sums, with_id,
                                without_id, word_hashes, word_spans)
from pelagia.llm.registry import query
from pelagia.operators.components import connected_components
from pelagia.runtime import attach, stage

SHINGLE_WORDS = 3
PERCENT = 85
TREES, DEPTH, FIRST_DEPTH = 24, 8, 4
REGION = 1024
# Text handled at once inside a task; its hashes take many times as much.
TEXT_BYTES = 1 << 20
#: Chances that a pair at the threshold agrees too rarely to be confirmed, and that crowded regions part it in all trees.
AGREEMENT_LOSS, CROWDED_LOSS = 1e-9, 1e-3

_RANDOM = np.random.default_rng(7)
_XOR = _RANDOM.integers(0, 2**32, TREES * DEPTH, np.uint32)
_FACTOR = _RANDOM.integers(0, 2**31, TREES * DEPTH, np.uint32) * np.uint32(2) + np.uint32(1)


def least_agreement(percent: int) -> int:
    """Number of agreeing MinHash values below which a pair has a similarity of ``percent`` % by a chance of 1e-9 at most.

    Every value of a pair agrees with the chance of its similarity, so their number is binomial.
    """
    n, p, below, count = TREES * DEPTH, percent / 100, 0.0, 0
    while count < n and (below := below + math.comb(n, count) * p**count * (1 - p)**(n - count)) <= AGREEMENT_LOSS:
        count += 1
    return count


def last_depth(percent: int) -> int:
    """How deep regions go at most: all trees part a pair at ``percent`` % there by a chance of 1e-3 or less."""
    p = percent / 100
    return max([d for d in range(FIRST_DEPTH, DEPTH + 1) if (1 - p**d) ** TREES <= CROWDED_LOSS], default=FIRST_DEPTH)


def shingle_sets(column: pa.Array, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First position of each row's set (one more at the end), and the sorted distinct shingle hashes of all rows.

    A row with fewer than ``words`` words has one shingle, its whole sequence; a row without words has none.
    """
    data, bounds = text_bytes(column)
    data = lowered()[data]
    starts, ends, first = word_spans(data, bounds, spaced_words())
    codes = word_hashes(data, starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    use = np.arange(len(codes)) + words <= first[1:][row]
    value = np.zeros(len(codes), np.uint64)
    sums = window_sums(codes, words)
    value[:len(sums)] = sums
    rows, values = [row[use]], [value[use]]
    for k in range(1, words):
        short = np.flatnonzero(count == k)
        rows.append(short)
        values.append(mixed(window_sums(codes, k)[first[short]] + np.uint64(k)) if len(short) else value[:0])
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return np.searchsorted(row, np.arange(len(count) + 1)), value


def labels_of(first: np.ndarray, value: np.ndarray) -> np.ndarray:
    """``rows x (TREES * DEPTH)`` MinHash values of 16 bits; rows without shingles are 0."""
    rows = len(first) - 1
    out = np.zeros((rows, TREES * DEPTH), np.uint16)
    short = (value >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(first))
    at = 0
    while at < len(full):  # pieces that stay in the processor's cache
        to = max(at + 1, int(np.searchsorted(first[full], first[full[at]] + 65536)))
        some = full[at:to]
        begin, end = first[some[0]], first[some[-1] + 1]
        piece = short[begin:end]
        for i in range(TREES * DEPTH):
            least = np.minimum.reduceat((piece ^ _XOR[i]) * _FACTOR[i], first[some] - begin)
            out[some, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
        at = to
    return out


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, key1, key2, labels`` of every row; the keys are equal for equal sets."""
    def sign(batches):
        for batch in chunks(batches, limit=TEXT_BYTES):
            first, value = shingle_sets(batch.column("text"), words)
            rows, full = batch.num_rows, np.flatnonzero(np.diff(first))
            keys = np.zeros((2, rows), np.uint64)
            if len(full):
                keys[0, full] = np.add.reduceat(mixed(value), first[full])
                keys[1, full] = np.add.reduceat(mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[full])
            packed = pa.Array.from_buffers(pa.binary(), rows, [
                None, pa.py_buffer(np.arange(rows + 1, dtype=np.int32) * (2 * TREES * DEPTH)),
                pa.py_buffer(labels_of(first, value).tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(first)), pa.array(keys[0].view(np.int64)),
                 pa.array(keys[1].view(np.int64)), packed], ["doc_id", "text_hash", "n_shingles", "key1", "key2", "labels"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        sign, "doc_id long, text_hash long, n_shingles long, key1 long, key2 long, labels binary")


def tree_rows(classes: DataFrame) -> DataFrame:
    """``tree, hi, lo, rep`` for every class and tree: its first four values and the other four."""
    def spread(batches):
        for batch in batches:
            rep = batch.column("rep").to_numpy()
            table = np.frombuffer(b"".join(batch.column("labels").to_pylist()), np.uint16).reshape(-1, TREES, 2, 4)
            packed = np.ascontiguousarray(table).view(np.int64)[..., 0]
            tree = np.tile(np.arange(TREES, dtype=np.int32), len(rep))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree), pa.array(packed[:, :, 0].reshape(-1)), pa.array(packed[:, :, 1].reshape(-1)),
                 pa.array(np.repeat(rep, TREES))], ["tree", "hi", "lo", "rep"])

    return classes.select("rep", "labels").mapInArrow(spread, "tree int, hi long, lo long, rep long")


def regions(rows: DataFrame, limit: int, last: int = DEPTH) -> DataFrame:
    """``region, tile_a, tile_b, side, rep``: members of every region that has at least two, split where it is crowded.

    Counts of prefixes are pre-aggregated; only members of crowded regions are counted again one value deeper.
    A region above the limit at depth ``last`` is cut into tiles, and each pair of tiles is one unit of work.
    """
    done, rest = [], rows.withColumn("region", F.xxhash64("tree", "hi"))
    for depth in range(FIRST_DEPTH, last + 1):
        counts = rest.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rest = stage(rest.join(counts, "region"), "regions")
        fits = rest if depth == last else rest.where(F.col("n") <= limit)
        done.append(fits.select("region", "rep", "n"))
        rest = rest.where(F.col("n") > limit).drop("n")
        if depth < last:
            if rest.isEmpty():
                break
            above = 64 - 16 * (depth - FIRST_DEPTH + 1)
            rest = rest.withColumn("region", F.xxhash64("tree", "hi", F.lit(depth), F.shiftleft("lo", above)))
    members = done[0]
    for more in done[1:]:
        members = members.unionByName(more)
    tiles = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    members = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    # a tile meets itself and every other one; a small region is one tile
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    members = members.withColumn("other", other)
    return members.select("region", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"),
                          (F.col("tile") > F.col("other")).cast("int").alias("side"), "rep")


UNIT = ["region", "tile_a", "tile_b"]


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many MinHash values each row of ``a`` shares with each row of ``b``."""
    if len(a) * len(b) <= 2048:
        return (a[:, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int16)
    out = np.zeros((len(a), len(b)), np.uint8)
    for i in range(a.shape[1]):
        out += a[:, i, None] == b[None, :, i]
    return out.astype(np.int16)


def _units(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the two sides of every unit in ``table``; a tile that meets itself is both."""
    keys = [table.column(c).to_numpy() for c in ("side", "tile_b", "tile_a", "region")]
    order = np.lexsort(keys)
    side, tile_b, tile_a, region = (k[order] for k in keys)
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(region) != 0) | (np.diff(tile_a) != 0) | (np.diff(tile_b) != 0)
    cuts = np.append(np.flatnonzero(new), len(order)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        if tile_a[a] == tile_b[a]:
            both = order[a:b]
            yield both, both
        else:
            middle = a + int(np.searchsorted(side[a:b], 1))
            yield order[a:middle], order[middle:b]


def _cells(members: DataFrame) -> DataFrame:
    """Whole units, a few at a time: a group holds many small units, so that none is handed over alone."""
    cells = 16 * partitions(members.sparkSession)
    return members.withColumn("cell", F.pmod(F.xxhash64(*UNIT), F.lit(cells)))


def _label_table(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TREES * DEPTH)


def proposals(members: DataFrame, least: int) -> DataFrame:
    """``a, b``: for each member of a unit the other member that agrees with it most."""
    def best(table: pa.Table) -> pa.Table:
        label, rep = _label_table(table.column("labels")), table.column("rep").to_numpy()
        pairs = [np.zeros((2, 0), np.int64)]
        for left, right in _units(table):
            count = _agreement(label[left], label[right])
            count[rep[left][:, None] == rep[right][None, :]] = -1
            for agree, own, other in ((count, left, right), (count.T, right, left)):
                if agree.size:
                    to = agree.argmax(axis=1)
                    good = agree[np.arange(len(to)), to] >= least
                    pairs.append(np.stack([rep[own][good], rep[other][to[good]]]))
        pairs = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    return _cells(members).groupBy("cell").applyInArrow(best, "a long, b long").distinct()


def _linked(common: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n_a + n_b - common)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, words: int = SHINGLE_WORDS) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    def check(batches):
        for whole in batches:
            for batch in chunks([whole], "text_a", TEXT_BYTES):
                sets = [shingle_sets(batch.column(c), words) for c in ("text_a", "text_b")]
                row = [np.repeat(np.arange(batch.num_rows), np.diff(first)) for first, _ in sets]
                row, value = np.concatenate(row), np.concatenate([v for _, v in sets])
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
                common = np.bincount(row[1:][twice], minlength=batch.num_rows)
                good = _linked(common, np.diff(sets[0][0]), np.diff(sets[1][0]), percent)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    rows = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def unsettled(members: DataFrame, least: int) -> DataFrame:
    """Members of units that have a partner in another component which may be similar enough."""
    def involved(table: pa.Table) -> pa.Table:
        root, label = table.column("root").to_numpy(), _label_table(table.column("labels"))
        keep = np.zeros(len(root), bool)
        for left, right in _units(table):
            if left is right and len(left) <= 2:
                continue  # the only pair of two has been proposed already
            roots = root[np.concatenate([left, right])]
            if (roots == roots[0]).all():
                continue
            near = _agreement(label[left], label[right]) >= least
            near &= root[left][:, None] != root[right][None, :]
            keep[left] |= near.any(axis=1)
            keep[right] |= near.any(axis=0)
        return table.select([*UNIT, "side", "rep", "root"]).filter(pa.array(keep))

    kept = _cells(members.select(*UNIT, "side", "rep", "root", "labels"))
    return kept.groupBy("cell").applyInArrow(involved, "region long, tile_a int, tile_b int, side int, rep long, root long")


def links_across(members: DataFrame, percent: int, words: int = SHINGLE_WORDS) -> DataFrame:
    """``a, b``: links between different components, found on the full sets of the members of each unit.

    Two sets can share no more than either shares with all others of the unit, which settles most pairs at once. A
    member that has been linked to a component isn't compared with the rest of that component.
    """
    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rep, root = table.column("rep").to_numpy(), table.column("root").to_numpy().copy()
        first, value = shingle_sets(table.column("text").chunk(0), words)
        n = np.diff(first)
        _, code, times = np.unique(value, return_inverse=True, return_counts=True)
        shared = np.bincount(np.repeat(np.arange(len(n)), n), (times > 1)[code], len(n))
        sets = np.split(value, first[1:-1])
        left, right = next(_units(table))
        found = []
        for i in left:
            need = np.ceil(percent * (n[i] + n[right]) / (100 + percent) - 1e-9)
            for j in right[(np.minimum(shared[i], shared[right]) >= need) & (root[right] != root[i])]:
                if root[i] == root[j]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if _linked(common, n[i], n[j], percent):
                    found.append(sorted((rep[i], rep[j])))
                    root[root == root[j]] = root[i]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return members.groupBy(*UNIT).applyInArrow(link, "a long, b long").distinct()


def rows_of_components(docs: DataFrame, percent: int = PERCENT, region: int = REGION,
                       words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, first`` for every row of ``docs(doc_id, text)``; see :func:`near_duplicates`.

    ``first`` is the least ``doc_id, text_hash`` of the row's component, the row's own if it has no links. A null doc_id is
    the largest number here.
    """
    docs = docs.select(with_id(), F.xxhash64("text").alias("text_hash"), "text")
    signed = stage(signatures(docs, words), "signatures")
    keys, row = ["n_shingles", "key1", "key2"], F.struct("doc_id", "text_hash")
    classes = signed.where("n_shingles > 0").groupBy(*keys).agg(F.min(row).alias("first"), F.min("labels").alias("labels"))
    # with fewer shingles only equal sets can reach the threshold, at 85 % below six
    least = next(n for n in range(1, 102) if 100 * n >= percent * (n + 1))
    # written once, so that the numbers stay
    classes = stage(classes.select(*keys, "first", F.monotonically_increasing_id().alias("rep"), "labels"), "classes")
    large = classes.where(F.col("n_shingles") >= least)
    members = regions(tree_rows(large), region, last_depth(percent)).join(large.select("rep", "labels"), "rep")
    members = stage(members, "members")
    agreement = least_agreement(percent)
    near = stage(proposals(members, agreement), "proposals")
    named = classes.join(members.select("rep").distinct(), "rep", "left_semi").select("first.*", "rep")
    # rows of one id and one text hash have one text
    texts = stage(docs.join(named, ["doc_id", "text_hash"]).groupBy("rep").agg(F.max("text").alias("text")), "texts")
    linked = stage(confirm(near, texts, percent, words), "links")
    roots = _components(linked)
    root = F.coalesce("root", "rep").alias("root")
    open_members = unsettled(members.join(roots, "rep", "left").select(*UNIT, "side", "rep", "labels", root), agreement)
    more = links_across(open_members.join(texts, "rep"), percent, words)
    roots = stage(_components(stage(linked.unionByName(more), "links")), "roots")
    lead = roots.join(classes.select("rep", "first"), "rep").groupBy("root").agg(F.min("first").alias("lead"))
    lead = attach(roots, lead, ["root"]).select("rep", "lead")
    belongs = classes.select(*keys, "rep", "first").join(lead, "rep", "left").select(
        *keys, F.coalesce("lead", "first").alias("first"))
    out = signed.select("doc_id", "text_hash", *keys).join(belongs, keys, "left")
    return out.select("doc_id", "text_hash", "n_shingles", F.coalesce("first", row).alias("first"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, region: int = REGION,
                    words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``; other columns are ignored.

    Documents are linked if they share at least ``percent`` % of the shingles of ``words`` words of both, and ``component_id`` is the
    least id that links lead to, a document's own if there are none. Null and wordless texts have no shingles and no
    links. Equal texts are in one class; rows with one doc_id, or none, but different texts are linked each by its own
    text; a null doc_id comes after all others. An empty table gives an empty result.
    """
    found = rows_of_components(docs, percent, region, words)
    return found.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS) -> DataFrame:
    """The row with the least doc_id, then the least text hash, of every component, with all its columns.

    Of rows that are equal in both, the least one by all columns stays. Null and wordless texts all stay.
    """
    found = stage(rows_of_components(docs, percent, words=words), "found")
    row, is_first = ["doc_id", "text_hash"], F.struct("doc_id", "text_hash") == F.col("first")
    keys = ["doc_key", "text_key"]
    gone = found.where(~is_first).select(*row).distinct().toDF(*keys)
    twice = found.where(is_first & (F.col("n_shingles") > 0)).groupBy(*row).count().where("count > 1").select(*row).toDF(*keys)
    rest = packed(docs).join(gone, keys, "left_anti")
    if not twice.isEmpty():
        one = rest.join(twice, keys, "left_semi").groupBy(*keys).agg(F.min("row").alias("row")).select("row")
        rest = rest.join(twice, keys, "left_anti").select("row").unionByName(one)
    return rest.select("row.*")


def _components(links: DataFrame) -> DataFrame:
    """``rep, root`` of all linked classes."""
    edges = links.select(F.lit(0).alias("run"), F.col("a").alias("u"), F.col("b").alias("v"))
    nodes = edges.select("run", F.col("u").alias("id")).union(edges.select("run", "v")).distinct()
    return connected_components(nodes, edges).select(F.col("id").alias("rep"), "root")


@query()
def op10_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near duplicates of every document."""
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select(without_id(), "n_shingles", without_id("component_id"),
                        (F.col("doc_id") == F.col("component_id")).alias("kept"))
