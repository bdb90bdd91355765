"""Benchmark passages in documents, found with a positional inverted index over the documents.

The index is a table of segments, each holding some documents: every term with the positions where it occurs. A
search takes the windows of the benchmark items and, in each segment, starts from the postings of the window's rarest
term, moves them back by the term's offset and intersects them with the lists of the next rarer terms, until
all terms agree. Items also match by proximity if their rarest terms stand close together in any order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pelagia.llm.common import chunks, lowered, packed, ranges, read, span_array, text_bytes, with_id, without_id, word_spans
from pelagia.llm.registry import query
from pelagia.runtime import stage

WINDOW_WORDS = 13
SEGMENT_BYTES = 1 << 20
# Text of the benchmark items that one search carries to the tasks; more items are searched block by block.
QUERY_CHARS = 4 << 20
CANDIDATES = 1 << 20
NEAR_TERMS, NEAR_WORDS = 3, 20
INDEX = ("doc_ids array<long>, hashes array<long>, bounds array<int>, terms array<string>, first array<int>, postings array<int>")


def _inside() -> np.ndarray:
    """Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x41:0x5B] = inside[0x61:0x7B] = inside[0x80:] = True
    return inside


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a text column, and the number of the first word of each row (one more at the end)."""
    data, bounds = text_bytes(column)
    starts, ends, first = word_spans(data, bounds, _inside())
    return span_array(starts, ends, lowered()[data]).cast(pa.string()), first


def build_index(docs: DataFrame) -> DataFrame:
    """A row per segment: its ``doc_ids``, text ``hashes``, the word ``bounds`` of its documents, ``terms`` and their ``postings``.

    ``docs(doc_id, text)``; other columns are ignored, null text has no words, a null doc_id is kept as the largest
    number. A segment holds about a megabyte of text or one longer document, so a task holds one segment at a time. The numbers of
    the segments stay as long as the table is written before it is read.
    """
    def segments(batches):
        for batch in chunks(batches, limit=SEGMENT_BYTES):
            tokens, bounds = words(batch.column("text"))
            coded = tokens.dictionary_encode()
            code = coded.indices.to_numpy()
            counts = np.bincount(code, minlength=len(coded.dictionary))
            postings = np.argsort(code, kind="stable").astype(np.int32)
            first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

            def one(values: pa.Array) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            yield pa.RecordBatch.from_arrays(
                [one(batch.column("doc_id")), one(batch.column("text_hash")), one(pa.array(bounds.astype(np.int32))), one(coded.dictionary),
                 one(pa.array(first)), one(pa.array(postings))], ["doc_ids", "hashes", "bounds", "terms", "first", "postings"])

    return docs.select(with_id(), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(segments, INDEX).withColumn(
        "segment", F.monotonically_increasing_id())


class Windows:
    """The windows of some items: terms as numbers of a vocabulary, -1 behind the end of a short window."""

    def __init__(self, names: list[str], texts: list[str | None], size: int = WINDOW_WORDS):
        tokens, first = words(pa.array(texts, pa.string()))
        coded = tokens.dictionary_encode()
        code = coded.indices.to_numpy()
        count = np.diff(first)
        self.names, self.vocabulary = names, coded.dictionary
        windows = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
        self.item = np.repeat(np.arange(len(names)), windows)
        start = ranges(first[:-1], windows)
        self.length = np.minimum(count, size)[self.item]
        at = start[:, None] + np.arange(size)
        inside = np.arange(size) < self.length[:, None]
        self.terms = np.where(inside, code[np.minimum(at, max(len(code) - 1, 0))] if len(code) else -1, -1)
        # in the order of the item, which decides between equally rare terms
        self.item_terms = [code[a:b][np.sort(np.unique(code[a:b], return_index=True)[1])] for a, b in zip(first[:-1], first[1:])]


class Segment:
    """One segment's lists, for the terms of a vocabulary only."""

    def __init__(self, terms: pa.Array, first: np.ndarray, postings: np.ndarray, bounds: np.ndarray, vocabulary: pa.Array):
        place = pc.index_in(vocabulary, terms).to_numpy(zero_copy_only=False)
        place = np.nan_to_num(place.astype(float), nan=-1).astype(np.int64)
        self.first = np.where(place >= 0, first[place], 0)
        self.count = np.where(place >= 0, first[place + 1] - first[place], 0)
        self.postings, self.bounds = postings, bounds
        self.n = int(bounds[-1])
        # the postings of the vocabulary by position, to intersect moved lists by looking up
        self.term_at = np.full(self.n + 1, -2, np.int64)
        self.term_at[postings[ranges(self.first, self.count)]] = np.repeat(np.arange(len(place)), self.count)

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Window and first position of every occurrence within one document."""
        counts = np.where(windows.terms >= 0, self.count[windows.terms], np.iinfo(np.int64).max)
        possible = np.flatnonzero(counts.min(axis=1, initial=np.iinfo(np.int64).max) > 0)
        order = np.argsort(counts[possible], axis=1, kind="stable")  # rarest first, padding last
        lists = counts[possible, order[:, 0]]
        found_w, found_s = [], []
        ends = np.cumsum(lists)
        at = 0
        while at < len(possible):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, "right")))
            which = np.repeat(np.arange(at, to), lists[at:to])
            term = windows.terms[possible[at:to], order[at:to, 0]]
            start = self.postings[ranges(self.first[term], lists[at:to])] - order[which, 0]
            length = windows.length[possible[which]]
            keep = (start >= 0) & (start + length <= self.n)
            which, start = which[keep], start[keep]
            for rank in range(1, windows.terms.shape[1]):
                offset = order[which, rank]
                term = windows.terms[possible[which], offset]
                keep = (term < 0) | (self.term_at[np.minimum(start + offset, self.n)] == term)
                which, start = which[keep], start[keep]
            found_w.append(possible[which])
            found_s.append(start)
            at = to
        window = np.concatenate(found_w) if found_w else np.zeros(0, np.int64)
        start = np.concatenate(found_s) if found_s else np.zeros(0, np.int64)
        row = np.searchsorted(self.bounds, start, "right") - 1
        keep = start + windows.length[window] <= self.bounds[row + 1]
        return window[keep], start[keep]

    def near(self, windows: Windows, terms: int, within: int) -> tuple[np.ndarray, np.ndarray]:
        """Item and document of every place where the item's rarest terms stand within some words of the rarest one."""
        items, documents = [], []
        around = np.arange(-within, within + 1)
        for i, of in enumerate(windows.item_terms):
            count = self.count[of]
            if not len(of) or count.min() == 0:
                continue
            chosen = of[np.argsort(count, kind="stable")[:terms]]
            places = self.postings[ranges(self.first[chosen[:1]], self.count[chosen[:1]])].astype(np.int64)
            row = np.searchsorted(self.bounds, places, "right") - 1
            for other in chosen[1:]:
                if not len(places):
                    break
                at = places[:, None] + around
                inside = (at >= self.bounds[row][:, None]) & (at < self.bounds[row + 1][:, None])
                keep = (inside & (self.term_at[np.clip(at, 0, self.n)] == other)).any(axis=1)
                places, row = places[keep], row[keep]
            row = np.unique(row)
            items.append(np.full(len(row), i))
            documents.append(row)
        if not items:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(items), np.concatenate(documents)


def _search_block(index: DataFrame, windows: Windows, near_terms: int, near_words: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def search(batches):
        windows = shared.value
        names = np.array(windows.names, object)
        for batch in batches:
            for at in range(batch.num_rows):
                def cell(name):
                    return batch.column(name)[at].values

                doc_ids, bounds = cell("doc_ids"), cell("bounds").to_numpy().astype(np.int64)
                segment = Segment(cell("terms"), cell("first").to_numpy().astype(np.int64),
                                  cell("postings").to_numpy(), bounds, windows.vocabulary)
                window, start = segment.phrases(windows)
                rows = len(doc_ids)
                row = np.searchsorted(bounds, start, "right") - 1
                length = windows.length[window]
                spans = np.unique(np.stack([row, windows.item[window], start - bounds[row], length]), axis=1)
                near_item, near_row = segment.near(windows, near_terms, near_words)
                order = np.argsort(near_row, kind="stable")

                def lists(row, values):
                    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
                    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

                phrase = pa.StructArray.from_arrays(
                    [pa.array(names[spans[1]], pa.string()), pa.array(spans[2], pa.int64()), pa.array(spans[3], pa.int64())],
                    ["item_id", "first", "words"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, batch.column("segment")[at].as_py(), np.int64)), pa.array(np.arange(rows)), doc_ids, cell("hashes"),
                     pa.array(np.diff(bounds)), lists(spans[0], phrase), lists(near_row[order], pa.array(names[near_item[order]], pa.string()))],
                    ["segment", "place", "doc_id", "text_hash", "n_words", "phrases", "near"])

    return index.mapInArrow(search, "segment long, place long, doc_id long, text_hash long, n_words long, "
                                    "phrases array<struct<item_id:string,first:long,words:long>>, near array<string>")


def search(index: DataFrame, items: DataFrame, near_terms: int = NEAR_TERMS, near_words: int = NEAR_WORDS) -> DataFrame:
    """``doc_id, text_hash, n_words, phrases, near`` of every document in the index, with empty lists where nothing matches.

    ``items(item_id, text)``: null or wordless texts match nothing, a null item_id is the empty name, rows with one
    item_id count as one item. ``phrases`` holds every occurrence of a window of 13 words of an item (of a shorter
    item as a whole), ``near`` the items whose rarest terms stand close together. Items are searched in blocks of a
    bounded size, each against all segments, so their number is not limited.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    whole = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-whole // QUERY_CHARS) or 1
    found = None
    for block in range(blocks):
        # one block of a bounded size reaches the driver at a time
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        windows = Windows([r.item_id for r in part], [r.text for r in part])
        rows = _search_block(index, windows, near_terms, near_words)
        found = rows if found is None else found.unionByName(rows)
    if blocks > 1:  # the lists of the blocks belong to the same row, which its place in the index tells
        found = found.groupBy("segment", "place").agg(
            *[F.first(c).alias(c) for c in ("doc_id", "text_hash", "n_words")],
            F.flatten(F.collect_list("phrases")).alias("phrases"), F.flatten(F.collect_list("near")).alias("near"))
    return found.drop("segment", "place")


def hit_words(phrases: Column) -> Column:
    """Number of words inside any of the spans."""
    spans = F.sort_array(F.transform(phrases, lambda p: F.struct(p["first"].alias("a"), (p["first"] + p["words"]).alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, lambda s, p: F.struct(
        F.greatest(s["end"], p["b"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), p["b"] - F.greatest(s["end"], p["a"]))).cast("long").alias("n")))["n"]


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, items, near, contaminated``: contaminated if at least one word in 20 is hit.

    Every row of ``docs`` gives a row; see :func:`build_index` and :func:`search` for nulls, ties and empty tables.
    """
    found = search(stage(build_index(docs), "index"), items)
    found = found.withColumn("n_hit", hit_words(F.col("phrases")))
    return found.select(without_id(), "text_hash", "n_words", "n_hit", F.array_sort(F.array_distinct("phrases.item_id")).alias("items"),
                        F.array_sort(F.array_distinct("near")).alias("near"),
                        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, told apart by doc_id and text, with all their columns."""
    gone = contamination(docs, items).where("contaminated").select(with_id().alias("doc_key"), F.col("text_hash").alias("text_key"))
    return packed(docs).join(gone.distinct(), ["doc_key", "text_key"], "left_anti").select("row.*")


@query()
def op9_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in every document, and whether it is contaminated."""
    found = contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                        F.size("near").cast("long").alias("n_near"))
