"""Finding stretches of documents that may repeat in others, by hashes that tasks ask each other about.

A document is a sequence of units (words or bytes). The windows of a document are summed up by the least hash of any
``k`` neighbouring units inside each window: equal windows have equal values, and neighbouring windows mostly share
one, so a document is a short list of *runs* (value, first window, number of windows). Tasks send their values to
the bucket of each value and learn which ones other documents have too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pelagia.llm.common import chunks, partitions, ranges, with_id

CHUNK_BYTES = 2 << 20
#: Units of a text column: a code for each, and the first unit of each row (one more at the end).
Units = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
ASK = "bucket int, known boolean, ids binary, texts binary, counts binary, keys binary, seconds binary, places binary"
#: Answers to the documents of one destination: their ids, and for each a number of 32-bit values.
REPLY = "dest int, ids binary, texts binary, counts binary, found binary"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def window_starts(first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and row of every window that lies within one row."""
    count = np.maximum(np.diff(first) - window + 1, 0)
    return ranges(first[:-1], count), np.repeat(np.arange(len(count)), count)


def runs_of(sums: np.ndarray, starts: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Value, first window, number of windows and row of every run of the windows at ``starts``.

    ``sums`` are the hashes of ``k`` units, ``width`` how many of them lie in a window.
    """
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    value = sliding_min(sums, width)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return value[at], starts[at], np.diff(np.append(at, len(starts))), row[at]


def packed(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


class Asker:
    """Rows of questions of one chunk: for each bucket the documents and their keys."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def batch(self, ids: np.ndarray, texts: np.ndarray, row: np.ndarray, key: np.ndarray, second: np.ndarray | None,
              place: np.ndarray | None, smaller: bool) -> pa.RecordBatch:
        """Questions about ``key`` (with ``second`` as more bits of it) of each ``row``.

        Keys that several documents of this chunk have are settled here: of those only one question is sent, by the
        document with the least id. So a key that very many rows share is asked once per chunk. ``smaller`` asks
        whether a document with a smaller id has the key, otherwise whether any other has it.
        """
        order = np.lexsort((ids[row], key) if second is None else (ids[row], second, key))
        row, key = row[order], key[order]
        second = None if second is None else second[order]
        place = None if place is None else place[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        if second is not None:
            new[1:] |= second[1:] != second[:-1]
        group = np.cumsum(new) - 1
        doc = ids[row]
        least = doc[new][group] if len(key) else doc
        known = doc > least
        if not smaller and len(key):  # the least document has company, too
            shared = np.zeros(group[-1] + 1, bool)
            shared[group[known]] = True
            known_all = known | shared[group]
        else:
            known_all = known
        rows = []
        for settled, chosen in ((False, np.flatnonzero(~known)), (True, np.flatnonzero(known_all))):
            bucket = (key[chosen] % np.uint64(self.buckets)).astype(np.int64)
            if settled:  # answers go by document, as no other question has to meet them
                bucket = (texts[row[chosen]].astype(np.uint64) % np.uint64(self.buckets)).astype(np.int64)
            by = np.lexsort((row[chosen], bucket))
            chosen, bucket = chosen[by], bucket[by]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket)) if len(cuts) else []):
                part = chosen[a:b]
                docs, counts = np.unique(row[part], return_counts=True)
                rows.append([int(bucket[a]), settled, *packed(ids[docs], texts[docs], counts.astype(np.int32)),
                             *(packed(key[part]) if second is not None else packed((key[part] >> np.uint64(32)).astype(np.uint32))),
                             *(packed(second[part]) if second is not None else [b""]),
                             *(packed(place[part].astype(np.int32)) if place is not None else [b""])])
        names = [c.split()[0] for c in ASK.split(", ")]
        kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def answers(asked: DataFrame, smaller: bool) -> DataFrame:
    """``doc_id, text_hash, found``: the keys (places, if they were sent) of each document that others have too."""
    def settle(table: pa.Table) -> pa.Table:
        known = table.column("known").to_numpy(zero_copy_only=False)

        def all_of(name, kind, rows=None):
            return np.frombuffer(b"".join(x for i, x in enumerate(table.column(name).to_pylist())
                                          if rows is None or rows[i]), kind)

        ids, texts, counts = all_of("ids", np.int64), all_of("texts", np.int64), all_of("counts", np.int32)
        wide = any(len(x) for x in table.column("seconds").to_pylist())
        keys = all_of("keys", np.uint64 if wide else np.uint32)
        back = all_of("places", np.int32) if wide else keys
        owner = np.repeat(np.arange(len(ids)), counts)
        done = np.repeat(np.repeat(known, [len(x) // 4 for x in table.column("counts").to_pylist()]), counts)
        asking = np.flatnonzero(~done)
        key, doc = keys[asking], ids[owner[asking]]
        second = all_of("seconds", np.uint64)[asking] if wide else np.zeros(0, np.uint64)
        order = np.lexsort((doc, second, key) if wide else (doc, key))
        key, doc = key[order], doc[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        if wide:
            second = second[order]
            new[1:] |= second[1:] != second[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(key)))
        least = np.repeat(doc[begin], size)
        hit = doc > least
        if not smaller:
            hit |= np.repeat(doc[begin + size - 1] > doc[begin], size) if len(begin) else hit
        found = np.sort(np.concatenate([asking[order[hit]], np.flatnonzero(done)]))
        return pa.Table.from_batches([reply(ids, texts, owner[found], back[found], dests)])

    dests = partitions(asked.sparkSession)
    return gathered(asked.groupBy("bucket").applyInArrow(settle, REPLY))


def reply(ids: np.ndarray, texts: np.ndarray, owner: np.ndarray, values: np.ndarray, dests: int) -> pa.RecordBatch:
    """Rows of REPLY for ``values`` (32 bits, or rows of them) of the documents number ``owner``: one for each destination."""
    width = values.shape[1] if values.ndim > 1 else 1
    dest = (texts.astype(np.uint64) % np.uint64(dests)).astype(np.int64)[owner]
    order = np.lexsort((owner, dest))
    dest, owner, values = dest[order], owner[order], values[order]
    cuts = np.append(np.flatnonzero(np.diff(dest, prepend=-1)), len(dest))
    rows = []
    for a, b in zip(cuts, cuts[1:]):
        docs, counts = np.unique(owner[a:b], return_counts=True)
        rows.append((int(dest[a]), *packed(ids[docs], texts[docs], (counts * width).astype(np.int32), values[a:b])))
    names = [c.split()[0] for c in REPLY.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32(), *[pa.binary()] * 4])], names)


def gathered(replies: DataFrame) -> DataFrame:
    """``doc_id, text_hash, found``: all answers to each document in one row."""
    def gather(table: pa.Table) -> pa.Table:
        ids, texts, counts, found = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (
            ("ids", np.int64), ("texts", np.int64), ("counts", np.int32), ("found", np.int32)))
        counts = counts.astype(np.int64)
        order = np.lexsort((texts, ids))
        values = found[ranges((np.cumsum(counts) - counts)[order], counts[order])]
        ids, texts = ids[order], texts[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1])
        total = np.add.reduceat(counts[order], np.flatnonzero(new)) if len(ids) else counts
        offsets = np.concatenate([[0], 4 * np.cumsum(total)]).astype(np.int32)
        body = pa.Array.from_buffers(pa.binary(), len(total), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])
        return pa.table({"doc_id": pa.array(ids[new]), "text_hash": pa.array(texts[new]), "found": body})

    return replies.groupBy("dest").applyInArrow(gather, "doc_id long, text_hash long, found binary")


def with_answers(docs: DataFrame, replies: DataFrame, how: str = "left") -> DataFrame:
    """``docs`` with ``found``, all answers to each document."""
    return docs.join(replies, ["doc_id", "text_hash"], how)


def numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, text`` with no nulls."""
    return docs.select(with_id(), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text")


def buckets_of(docs: DataFrame) -> int:
    """Buckets for questions: half the shuffle partitions, since every bucket lists the documents that ask it."""
    return -(-partitions(docs.sparkSession) // 2)


def keys_found(column: pa.Array, kind) -> list[np.ndarray]:
    """The answers of each row, sorted; empty without any."""
    return [np.unique(np.frombuffer(x, kind)) if x else np.zeros(0, kind) for x in column.to_pylist()]


def ask_runs(docs: DataFrame, units: Units, sums: Callable[[np.ndarray], np.ndarray], k: int, window: int) -> DataFrame:
    """Which run values of each document other documents have, too: :func:`answers` with 32-bit keys.

    ``docs(doc_id, text_hash, text)`` may have ``starts`` and ``counts`` (binary int32) that limit the windows.
    """
    asker = Asker(buckets_of(docs))
    limited = "starts" in docs.columns

    def ask(batches):
        for batch in chunks(batches, limit=CHUNK_BYTES):
            value, _, _, row = document_runs(batch, units, sums, k, window, limited)
            yield asker.batch(batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy(), row, value, None,
                              None, smaller=False)

    return answers(docs.mapInArrow(ask, ASK), smaller=False)


def limited_starts(batch: pa.RecordBatch, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position and row of the windows that ``starts`` and ``counts`` of each row allow."""
    a = [np.frombuffer(x, np.int32).astype(np.int64) for x in batch.column("starts").to_pylist()]
    n = [np.frombuffer(x, np.int32).astype(np.int64) for x in batch.column("counts").to_pylist()]
    begin = np.concatenate([x + f for x, f in zip(a, first)]) if a else np.zeros(0, np.int64)
    count = np.concatenate(n) if n else np.zeros(0, np.int64)
    return ranges(begin, count), np.repeat(np.repeat(np.arange(len(a)), [len(x) for x in a]), count)


def document_runs(batch: pa.RecordBatch, units: Units, sums, k: int, window: int, limited: bool) -> tuple[np.ndarray, ...]:
    codes, first = units(batch.column("text"))
    starts, row = limited_starts(batch, first) if limited else window_starts(first, window)
    return runs_of(sums(codes, k), starts, row, window - k + 1)


def live_runs(batch: pa.RecordBatch, units: Units, sums, k: int, window: int, limited: bool) -> list[tuple[bytes, bytes, bytes]]:
    """For each row the first window (in the row), number of windows and value of the runs that were found."""
    codes, first = units(batch.column("text"))
    starts, row = limited_starts(batch, first) if limited else window_starts(first, window)
    value, start, count, owner = runs_of(sums(codes, k), starts, row, window - k + 1)
    short = (value >> np.uint64(32)).astype(np.uint32)
    cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    out = []
    for i, live in enumerate(keys_found(batch.column("found"), np.uint32)):
        a, b = cuts[i], cuts[i + 1]
        keep = np.isin(short[a:b], live)
        out.append(tuple(packed((start[a:b][keep] - first[i]).astype(np.int32), count[a:b][keep].astype(np.int32),
                                value[a:b][keep])))
    return out


def covered(length: int, starts: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """Which units the windows at the sorted ``starts`` cover, and in how many maximal pieces."""
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    inside = np.cumsum(change[:-1]) > 0
    return inside, int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
