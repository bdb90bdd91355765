"""Removing repeated passages of words by level-wise doubling.

Windows of 50 words are judged by ever longer pieces: first by a piece of 13 words that the window's content selects,
then of 26, and at last by all 50. A window goes on to the next level only if its piece is found in another document,
so nearly all text is settled at the first level, where neighbouring windows share one piece. The last level
compares whole windows by 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pelagia.llm import repeats
from pelagia.llm.common import chunks, read, spaced_words, text_bytes, window_sums, without_id, word_hashes, word_spans
from pelagia.llm.registry import query
from pelagia.runtime import stage

WINDOW = 50
SETTLED = "doc_id long, text_hash long, text string, starts binary, counts binary, n_words long, kept_sha256 string"


def word_units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column)
    starts, ends, first = word_spans(data, bounds, spaced_words())
    return word_hashes(data, starts, ends), first


def levels(window: int) -> list[int]:
    """Lengths that double up to the window, which is the last."""
    shortest = window
    while shortest > 13:
        shortest = -(-shortest // 2)
    out = []
    while shortest < window:
        out.append(shortest)
        shortest *= 2
    return out


def _kept(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _extend(docs: DataFrame, replies: DataFrame, k: int, window: int, limited: bool) -> DataFrame:
    """Rows still in question with the windows whose piece was found, and the results of all others."""
    def settle(batches):
        for batch in chunks(batches, limit=repeats.CHUNK_BYTES):
            runs = repeats.live_runs(batch, word_units, window_sums, k, window, limited)
            data, bounds = text_bytes(batch.column("text"))
            a, b, first = word_spans(data, bounds, spaced_words())
            raw = data.tobytes()
            rows = []
            for i, (starts, counts, _) in enumerate(runs):
                here = slice(first[i], first[i + 1])
                sha = None if starts else _kept([raw[x:y] for x, y in zip(a[here], b[here])])
                rows.append((starts or None, counts or None, int(first[i + 1] - first[i]), sha))
            starts, counts, n, sha = zip(*rows)
            text = pa.array([t if s else None for t, s in zip(batch.column("text").to_pylist(), starts)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), text, pa.array(starts, pa.binary()),
                 pa.array(counts, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                [c.split()[0] for c in SETTLED.split(", ")])

    names = ["doc_id", "text_hash", "text", *(["starts", "counts"] if limited else [])]
    return repeats.with_answers(docs.select(*names), replies).mapInArrow(settle, SETTLED)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs(doc_id, text)``.

    Removed is each word covered by ``window`` consecutive words that also begin in a document with a smaller doc_id;
    windows are judged on the input. ``kept`` holds the words left, joined by one space, where any was removed, else
    null. Null text has no words; a null doc_id counts as the largest; rows with one doc_id don't remove each other's
    words; other columns are ignored; an empty table gives an empty result.
    """
    docs = repeats.numbered(docs)
    results, limited = [], False
    for k in levels(window):
        replies = repeats.ask_runs(docs, word_units, window_sums, k, window)
        settled = stage(_extend(docs, replies, k, window, limited), "level")
        results.append(settled.where("kept_sha256 is not null").select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256",
            F.lit(None).cast("string").alias("kept")))
        docs, limited = settled.where("kept_sha256 is null"), True
    asker = repeats.Asker(repeats.buckets_of(docs))

    def ask(batches):
        for batch in chunks(batches, limit=repeats.CHUNK_BYTES):
            data, bounds = text_bytes(batch.column("text"))
            a, b, first = word_spans(data, bounds, spaced_words())
            starts, row = repeats.limited_starts(batch, first)
            keys = [window_sums(word_hashes(data, a, b, f), window, f)[starts] if len(starts) else np.zeros(0, np.uint64)
                    for f in range(2)]
            yield asker.batch(batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy(), row, *keys,
                              starts - first[row], smaller=True)

    def remove(batches):
        for batch in chunks(batches, limit=repeats.CHUNK_BYTES):
            data, bounds = text_bytes(batch.column("text"))
            a, b, first = word_spans(data, bounds, spaced_words())
            raw, rows = data.tobytes(), []
            for i, places in enumerate(repeats.keys_found(batch.column("found"), np.int32)):
                inside, _ = repeats.covered(int(first[i + 1] - first[i]), places, window)
                here = np.arange(first[i], first[i + 1])[~inside]
                words = [raw[a[w]:b[w]] for w in here]
                rows.append((len(inside), int(inside.sum()), _kept(words),
                             b" ".join(words).decode() if len(places) else None))
            n, removed, sha, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    replies = repeats.answers(docs.mapInArrow(ask, repeats.ASK), smaller=True)
    last = repeats.with_answers(docs.select("doc_id", "text_hash", "text"), replies).mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    for more in results:
        last = last.unionByName(more)
    return last.withColumn("doc_id", without_id())


@query()
def op7_level_doubling(spark: SparkSession, folder: str) -> DataFrame:
    """Words that repeat passages of smaller documents, removed from every document."""
    return remove_repeats(read(spark, folder, "documents")).drop("kept")
