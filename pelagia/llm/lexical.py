"""Ranked lexical search by presence masks over an inverted index.

The index is a table of segments, each holding some documents and, for every term, the documents with it and how often.
In a segment, an item's documents are grouped by their mask: the bitmap of those of the item's terms that they hold. Every
mask has a highest possible score, from the most occurrences and the shortest document of each term in it. Masks are scored
in descending order of that, and as soon as the next one can't reach the worst of the best documents found so far, the
rest is settled without being scored. The best documents go along from segment to segment of a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pelagia.llm.common import (batches_of, chunks, give_back, lowered, ranges, read, span_array, text_bytes, with_id, without_id,
                                word_spans)
from pelagia.llm.registry import query
from pelagia.runtime import stage

TOP = 20
SEGMENT_BYTES = 4 << 20
# What a document adds to a segment besides its text; empty ones count too.
ROW_BYTES = 16
# Text of the items that one search carries to the tasks; more items are searched block by block.
ITEM_BYTES = 8 << 20
# Masks that are scored first; each further step takes twice as many.
FIRST_MASKS = 32
# The best documents of all tasks are cut in so many parts before they meet.
PARTS = 64
INDEX = ("doc_ids array<long>, sizes array<int>, terms array<string>, first array<int>, docs array<int>, times array<int>, "
         "most array<int>, least array<int>")


def _inside() -> np.ndarray:
    """Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x41:0x5B] = inside[0x61:0x7B] = inside[0x80:] = True
    return inside


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a text column, A-Z lower-cased, and the number of the first term of each row (one more at the end)."""
    data, bounds = text_bytes(column)
    starts, ends, first = word_spans(data, bounds, _inside())
    return span_array(starts, ends, lowered()[data]).cast(pa.string()), first


def filled(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut so that each holds about ``limit`` bytes of text and row numbers, or a single longer row."""
    held, size = [], 0
    for piece in chunks(batches, limit=limit):
        own = (pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0) + ROW_BYTES * piece.num_rows
        if held and size + own > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(piece)
        size += own
    if held:
        yield pa.concat_batches(held)


def build_index(docs: DataFrame) -> DataFrame:
    """A row per segment of about four megabytes of text, or of one longer document.

    ``doc_ids`` and ``sizes`` (numbers of terms) of its documents; its ``terms``; from ``first`` on, per term, the numbers ``docs`` of
    the documents that hold it and how many ``times``; the ``most`` of these times and the ``least`` size among them.
    ``docs(doc_id, text)``: other columns are ignored, null text has no terms, a null doc_id is kept as the largest number.
    """
    def segments(batches):
        for batch in filled(batches, SEGMENT_BYTES):
            tokens, bounds = terms_of(batch.column("text"))
            coded = tokens.dictionary_encode()
            sizes, rows = np.diff(bounds), batch.num_rows
            row = np.repeat(np.arange(rows), sizes)
            key, times = np.unique(coded.indices.to_numpy().astype(np.int64) * rows + row, return_counts=True)
            term, doc = key // rows, key % rows
            first = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
            most = np.maximum.reduceat(times, first[:-1]) if len(times) else times
            least = np.minimum.reduceat(sizes[doc], first[:-1]) if len(times) else times

            def one(values) -> pa.Array:
                values = values if isinstance(values, pa.Array) else pa.array(values.astype(np.int32))
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            yield pa.RecordBatch.from_arrays(
                [one(batch.column("doc_id")), one(sizes), one(coded.dictionary), one(first), one(doc), one(times), one(most),
                 one(least)], ["doc_ids", "sizes", "terms", "first", "docs", "times", "most", "least"])

    return docs.select(with_id(), "text").mapInArrow(segments, INDEX)


class Items:
    """Some items: their terms as numbers of a vocabulary, with repeats counted."""

    def __init__(self, keys: list[int], texts: list[str | None]):
        tokens, first = terms_of(pa.array(texts, pa.string()))
        coded = tokens.dictionary_encode()
        code = coded.indices.to_numpy()
        self.keys, self.vocabulary = keys, coded.dictionary
        self.terms = [np.unique(code[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]


def statistics(index: DataFrame, vocabulary: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the number of documents with each term of the vocabulary."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        documents = terms = 0
        found = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                sizes = batch.column("sizes")[at].values.to_numpy()
                documents, terms = documents + int((sizes > 0).sum()), terms + int(sizes.sum(dtype=np.int64))
                place = pc.index_in(batch.column("terms")[at].values, value_set=shared.value)
                known = place.is_valid().to_numpy(zero_copy_only=False)
                lists = np.diff(batch.column("first")[at].values.to_numpy())
                found[place.drop_null().to_numpy()] += lists[known]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some]).astype(np.int64)), pa.array(np.concatenate([[documents, terms], found[some]]).astype(np.int64))],
            ["term", "n"])
        give_back()

    counted = index.select("sizes", "terms", "first").mapInArrow(count, "term long, n long")
    # a row per term of the vocabulary, whose size is bounded by the block of items
    table = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return table.get(-2, 0), table.get(-1, 0), np.array([table.get(t, 0) for t in range(len(vocabulary))], np.int64)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(size: int, documents: int, terms: int) -> int:
    return 75 + 25 * size * documents // terms


def saturation(times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 12 * norm)


class Segment:
    """One segment's lists, for the terms of a vocabulary only, and what a document can get from each at most."""

    def __init__(self, cell, vocabulary: pa.Array, documents: int, terms: int):
        place = pc.index_in(vocabulary, value_set=cell("terms")).fill_null(-1).to_numpy().astype(np.int64)
        first = cell("first").to_numpy().astype(np.int64)
        known = place >= 0
        place = np.maximum(place, 0)
        self.first = np.where(known, first[place], 0)
        self.count = np.where(known, first[np.minimum(place + 1, len(first) - 1)] - first[place], 0)
        self.docs, self.times = cell("docs").to_numpy(), cell("times").to_numpy()
        self.doc_ids = cell("doc_ids").to_numpy()
        self.norms = np.array([length_norm(n, documents, terms) if terms else 75 for n in cell("sizes").to_pylist()], np.int64)
        self.most = np.zeros(len(place), np.int64)
        if known.any():
            some = place[known]
            least = [length_norm(n, documents, terms) for n in cell("least").to_numpy()[some].tolist()]
            self.most[known] = saturation(cell("most").to_numpy()[some].astype(np.int64), np.array(least, np.int64))

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct masks of the documents that hold any term (words x masks), the documents by mask, and where each begins."""
        mask = np.zeros((-(-len(terms) // 64), len(self.doc_ids)), np.uint64)
        for j, t in enumerate(terms.tolist()):
            mask[j >> 6, self.docs[self.first[t]:self.first[t] + self.count[t]]] |= np.uint64(1) << np.uint64(j & 63)
        doc = np.flatnonzero(mask.any(axis=0))
        mask = mask[:, doc]
        order = np.lexsort(mask)
        mask, doc = mask[:, order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (mask[:, 1:] != mask[:, :-1]).any(axis=0)
        start = np.flatnonzero(new)
        return mask[:, start], doc, np.append(start, len(doc))

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents, in ascending order."""
        score = np.zeros(len(docs), np.int64)
        for t, w in zip(terms.tolist(), weights.tolist()):
            part = slice(self.first[t], self.first[t] + self.count[t])
            at = np.searchsorted(self.docs[part], docs)
            hit = np.flatnonzero(self.docs[part][np.minimum(at, self.count[t] - 1)] == docs)
            score[hit] += w * saturation(self.times[part][at[hit]].astype(np.int64), self.norms[docs[hit]])
        return score


def best_of(segment: Segment, terms: np.ndarray, weights: np.ndarray, top: tuple[np.ndarray, np.ndarray],
            k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents (scores, doc_ids) of the ones known and those of a segment; equal scores by doc_id."""
    def worst() -> int:
        return int(top[0][-1]) if len(top[0]) == k else 1  # a score has to be above 0

    present = segment.count[terms] > 0
    terms, weights = terms[present], weights[present]
    reach = weights * segment.most[terms]
    if reach.sum() < worst():
        return top
    masks, docs, start = segment.masks(terms)
    bits = np.arange(len(terms))
    held = (masks[bits >> 6] >> (bits & 63).astype(np.uint64)[:, None]) & np.uint64(1)
    bound = reach @ held.astype(np.int64)
    order = np.argsort(-bound, kind="stable")
    at, step = 0, FIRST_MASKS
    while at < len(order) and bound[order[at]] >= worst():
        some = order[at:at + step]
        some = some[bound[some] >= worst()]
        chosen = np.sort(docs[ranges(start[some], start[some + 1] - start[some])])
        score = segment.scores(chosen, terms, weights)
        good = score >= worst()
        score, ids = np.concatenate([top[0], score[good]]), np.concatenate([top[1], segment.doc_ids[chosen[good]]])
        first = np.lexsort((ids, -score))[:k]
        top = score[first], ids[first]
        at, step = at + step, step * 2
    return top


def _search_block(index: DataFrame, items: Items, k: int) -> DataFrame:
    documents, terms, holding = statistics(index, items.vocabulary)
    weight = np.array([term_weight(documents, int(n)) for n in holding], np.int64)
    shared = index.sparkSession.sparkContext.broadcast((items, weight))

    def search(batches):
        items, weight = shared.value
        weights = [weight[of] * times for of, times in items.terms]
        tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.keys]
        for batch in batches:
            for at in range(batch.num_rows):
                segment = Segment(lambda name: batch.column(name)[at].values, items.vocabulary, documents, terms)
                for i, (of, _) in enumerate(items.terms):
                    if len(of):
                        tops[i] = best_of(segment, of, weights[i], tops[i], k)
        lengths = [len(s) for s, _ in tops]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(items.keys, np.int64), lengths)), pa.array(np.concatenate([d for _, d in tops] or [[]]).astype(np.int64)),
             pa.array(np.concatenate([s for s, _ in tops] or [[]]).astype(np.int64))], ["key", "doc_id", "score"])
        give_back()

    return index.mapInArrow(search, "key long, doc_id long, score long")


def ranked(index: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items(item_id, text)`` its ``k`` best documents with a score above 0.

    Rank 1 is the highest score, equal scores go by ascending doc_id, null last, and rows of documents with one doc_id stay
    apart. Every row of ``items`` is an item of its own, also if its item_id is null or repeated; null and wordless texts
    have no rows. An empty table on either side gives an empty result. Items are searched in blocks of a bounded size, each against
    all segments, so their number is not limited.
    """
    spark = index.sparkSession
    items = stage(items.select("item_id", "text", F.monotonically_increasing_id().alias("key")), "items")
    blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES) or 1
    found = None
    for block in range(blocks):
        # one block of a bounded size reaches the driver at a time
        part = items.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).select("key", "text").collect()
        # a segment takes more memory than its text, so a task is handed one at a time
        with batches_of(spark, SEGMENT_BYTES):
            rows = _search_block(index, Items([r.key for r in part], [r.text for r in part]), k)
            # the best of each part of the tasks first, so that no item meets all its rows at once
            rows = rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
            rows = stage(_first_rows(rows, ["key", "part"], k).drop("part", "rank"), "found")
        found = rows if found is None else found.unionByName(rows)
    top = _first_rows(found, ["key"], k).join(items.select("key", "item_id"), "key")
    return top.select("item_id", "rank", without_id(), "score")


def _first_rows(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "doc_id")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """:func:`ranked` over a new index of ``docs``, whose files are written and read a segment at a time."""
    with batches_of(docs.sparkSession, SEGMENT_BYTES // 8):
        index = stage(build_index(docs), "index", rows=1)
    return ranked(index, items, k)


SQL = r"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sizes AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM lists WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM lists) GROUP BY doc_id, term),
wanted AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held CROSS JOIN totals WHERE term IN (SELECT term FROM wanted) GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id) CROSS JOIN totals
  GROUP BY item_id, doc_id),
places AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS "rank", doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM places WHERE "rank" <= 20
"""


@query(SQL)
def op11_presence_masks(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
