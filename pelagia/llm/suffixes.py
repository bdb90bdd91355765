"""Removing repeated byte strings with suffix arrays built by external induced sorting.

Stretches of documents that may repeat are dealt to shards by a value of their content, so that equal strings meet in
one shard. A shard sorts the suffixes of its stretches by induction: suffixes that begin a rise after a fall are sorted
first, then a pass from small to large bytes induces the falling suffixes from those behind them, and a pass
back induces the rising ones. Both passes carry tuples (position, length of the prefix shared with the tuple before)
through one first-in-first-out queue per byte, which is what a priority queue by (byte, order of arrival) comes to;
queues beyond a memory limit go to disk. Neighbours in the result that share 50 bytes are equal strings.

The first suffixes are sorted by naming: eight bytes at a time, only those still equal going on. That takes the place
of a recursion on the reduced text, whose large alphabet would need a loop over single names.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pelagia.llm import repeats
from pelagia.llm.common import BYTE_CODES, CHUNK_BYTES, chunks, partitions, ranges, read, text_bytes, window_sums, without_id
from pelagia.llm.registry import query

WINDOW = 50
ANCHOR = 24
#: A task sorts its shard in this many parts, one after another.
SLICES = 8
#: Bytes of queued tuples that a task keeps in memory, and tuples handled at once.
QUEUE_BYTES = 96 << 20
PIECE = 1 << 20
TUPLE = np.dtype([("place", "<i8"), ("shared", "u1")])
#: The first 0 to 8 bytes of eight.
FRONT = np.array([(1 << 64) - (1 << 64 - 8 * k) for k in range(9)], np.uint64)


class Queues:
    """A queue of tuples for each byte; the longest go to a file when all together exceed the limit."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self.limit, self.held, self.file = limit, 0, None
        self.chunks: list[list] = [[] for _ in range(256)]

    def push(self, byte: int, place: np.ndarray, shared: np.ndarray) -> None:
        chunk = np.empty(len(place), TUPLE)
        chunk["place"], chunk["shared"] = place, shared
        self.chunks[byte].append(chunk)
        self.held += chunk.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for line in self.chunks:
            for i, chunk in enumerate(line):
                if isinstance(chunk, np.ndarray):
                    line[i] = (self.file.tell(), len(chunk))
                    self.file.write(chunk.tobytes())
        self.held = 0

    def _load(self, chunk) -> np.ndarray:
        if isinstance(chunk, np.ndarray):
            self.held -= chunk.nbytes
            return chunk
        self.file.seek(chunk[0])
        return np.frombuffer(self.file.read(chunk[1] * TUPLE.itemsize), TUPLE)

    def pop(self, byte: int, last: bool = False) -> np.ndarray | None:
        """The next tuples of a queue, some pushes together; from its end if ``last``."""
        line = self.chunks[byte]
        if not line:
            return None
        if last:
            return self._load(line.pop())
        parts, n = [], 0
        while line and n < PIECE:
            parts.append(self._load(line.pop(0)))
            n += len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Carry:
    """The least shared prefix seen since the last push to each queue."""

    def __init__(self):
        self.least = np.full(256, 255, np.uint8)
        self.used = np.zeros(256, bool)

    def push(self, queues: Queues, byte: np.ndarray, place: np.ndarray, at: np.ndarray, shared: np.ndarray) -> None:
        """Queue the predecessors ``place`` (beginning with ``byte``) of the scanned tuples number ``at``."""
        order = np.argsort(byte, kind="stable")
        byte, place, at = byte[order], place[order], at[order]
        new = np.ones(len(byte), bool)
        new[1:] = byte[1:] != byte[:-1]
        least = np.minimum.accumulate(shared)[at]  # from the beginning; behind the first of a byte from the one before
        inner = np.flatnonzero(~new)
        if len(inner):
            least[inner] = self._range(shared, at[inner - 1] + 1, at[inner] + 1)
        cuts = np.append(np.flatnonzero(new), len(byte))
        whole = shared.min() if len(shared) else 255
        touched = byte[cuts[:-1]]
        head = np.minimum(least[cuts[:-1]], self.least[touched])
        value = np.minimum(least, 254) + np.uint8(1)
        value[cuts[:-1]] = np.where(self.used[touched], np.minimum(head, 254) + 1, 0)
        self.least = np.minimum(self.least, whole)
        end = at[cuts[1:] - 1] + 1
        rest = np.full(len(touched), 255, np.uint8)
        more = end < len(shared)
        rest[more] = np.minimum.accumulate(shared[::-1])[::-1][end[more]]
        self.least[touched] = rest
        self.used[touched] = True
        for b, x, y in zip(touched, cuts[:-1], cuts[1:]):
            queues.push(int(b), place[x:y], value[x:y])

    @staticmethod
    def _range(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least of each range of ``values``, none of which is empty."""
        level = np.frexp((end - begin).astype(float))[1] - 1
        table = [values]  # least values of 1, 2, 4, … neighbours, as far as the ranges are long
        for i in range(int(level.max())):
            table.append(np.minimum(table[-1][:-1 << i], table[-1][1 << i:]))
        first = np.cumsum([0, *map(len, table[:-1])])[level]
        table = np.concatenate(table) if len(table) > 1 else values
        return np.minimum(table[first + begin], table[first + end - (1 << level)])


class Shard:
    """Stretches one after another, each with a 0 behind it; other bytes are raised by one (0xFF is not in UTF-8)."""

    def __init__(self, text: np.ndarray, first: np.ndarray):
        n = int(first[-1])
        self.count = len(first) - 1
        lengths = np.diff(first)
        self.begin = first[:-1] + np.arange(self.count)
        self.padded = np.zeros(n + self.count + 8, np.uint8)
        self.text = self.padded[:n + self.count]
        self.text[ranges(self.begin, lengths)] = text + np.uint8(1)
        self.end = self.begin + lengths
        t = self.text
        # a suffix rises if the first byte that differs from its own is greater; an end always rises
        change = np.flatnonzero(t[1:] != t[:-1])
        last = np.concatenate([change, [len(t) - 1]])
        size = np.diff(np.concatenate([[-1], last]))
        up = np.concatenate([t[change + 1] > t[change], [True]])
        self.rises = np.repeat(up, size)
        self.rises[self.end] = True
        back = np.arange(len(t)) - np.repeat(last, size)
        self.same = np.minimum(1 - back, 255).astype(np.uint8)  # how often the byte repeats from here
        self.first = np.flatnonzero(self.rises[1:] & ~self.rises[:-1]) + 1

    def words(self, place: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Eight bytes at each place as a number, zeros behind the end of the stretch."""
        at_any_byte = np.ndarray(len(self.text), ">u8", self.padded, strides=(1,))
        return at_any_byte[place].astype(np.uint64) & FRONT[np.clip(left, 0, 8)]

    def sorted_first(self) -> tuple[np.ndarray, np.ndarray]:
        """The rising suffixes after a fall in order, and the prefix that each shares with the one before."""
        place = self.first
        left = self.end[np.searchsorted(self.end, place)] - place
        key = self.words(place, left)
        order = np.argsort(key, kind="stable")
        place, left, key = place[order], left[order], key[order]
        shared = np.zeros(len(place), np.uint8)
        open_ = np.arange(len(place))  # members of groups that are still equal, group by group
        group = np.zeros(len(place), np.int64)
        depth = 0
        while len(open_):
            # position in the order stays with the group; members are ordered by key, ties by place
            same = np.zeros(len(open_), bool)
            same[1:] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
            inside = np.zeros(len(open_), bool)
            inside[1:] = group[1:] == group[:-1]
            differ = key[1:] ^ key[:-1]
            lead = np.zeros(len(open_), np.int64)
            lead[1:] = 8
            some = np.flatnonzero(inside[1:] & (differ != 0)) + 1
            if len(some):
                x, exact = differ[some - 1], np.zeros(len(some), np.int64)
                going = np.ones(len(some), bool)
                for k in range(8):
                    going &= (x >> np.uint64(56 - 8 * k)) & np.uint64(0xFF) == 0
                    exact += going
                lead[some] = exact
            both = np.minimum(left[open_], np.concatenate([[0], left[open_][:-1]]))
            value = np.minimum(depth + lead, np.minimum(both, 255))
            shared[open_[inside]] = value[inside]
            new_group = np.cumsum(~same)
            going_on = left[open_] >= depth + 8  # one that ends just here has to go before the others
            follow = np.zeros(len(open_), bool)
            follow[:-1] = same[1:]
            keep = (same | follow)
            # in a group whose members ended, nothing is left to compare: ties stay in order of place
            keep &= going_on
            open_, group = open_[keep], new_group[keep]
            depth += 8
            if not len(open_):
                break
            key = self.words(place[open_] + depth, left[open_] - depth)
            by = np.lexsort((key, group))
            place[open_], left[open_] = place[open_][by], left[open_][by]
            key = key[by]
        return place, shared

    def order(self, limit: int = QUEUE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes from the greatest to the least, in pieces, with the prefix shared with the one before.

        Ends of stretches are left out.
        """
        t = self.text
        first, first_shared = self.sorted_first()
        cuts = np.searchsorted(t[first], np.arange(257))
        falling, kept, carry = Queues(limit), Queues(limit), Carry()

        def induce(place, shared, queues, carry, rising):
            before = place - 1
            at = np.flatnonzero(before >= 0)
            before = before[at]
            use = (self.rises[before] == rising) & (t[before] > 0)
            at, before = at[use], before[use]
            carry.push(queues, t[before], before, at, shared)

        for byte in range(256):
            last = None
            while (piece := falling.pop(byte)) is not None:
                place, shared = piece["place"], piece["shared"]
                kept.push(byte, place, shared)
                last = place[-1]
                induce(place, shared, falling, carry, False)
            for a in range(cuts[byte], cuts[byte + 1], PIECE):
                b = min(a + PIECE, cuts[byte + 1])
                place, shared = first[a:b], first_shared[a:b].copy()
                if a == cuts[byte]:
                    shared[0] = 0 if last is None else min(self.same[last], self.same[place[0]])
                induce(place, shared, falling, carry, False)
        falling.close()
        rising, carry = Queues(limit), Carry()
        for byte in range(255, 0, -1):
            last = None
            while (piece := rising.pop(byte)) is not None:
                place, shared = piece["place"], piece["shared"]
                last = place[-1]
                yield place, shared
                induce(place, shared, rising, carry, True)
            above = None
            while (piece := kept.pop(byte, last=True)) is not None:
                place = piece["place"][::-1]
                shared = np.empty(len(place), np.uint8)
                shared[1:] = piece["shared"][:0:-1]
                if above is None:
                    shared[0] = 0 if last is None else min(self.same[last], self.same[place[0]])
                else:
                    shared[0] = above
                above = piece["shared"][0]
                yield place, shared
                induce(place, shared, rising, carry, True)
        kept.close()
        rising.close()

    def smaller(self, owner: np.ndarray, window: int) -> np.ndarray:
        """For every place whether its ``window`` bytes also begin in a stretch with a smaller owner."""
        group_of = np.full(len(self.text), -1, np.int64)
        groups = 0
        for place, shared in self.order():
            new = np.cumsum(shared < window)
            group_of[place] = groups + new
            groups += int(new[-1]) if len(new) else 0
        stretch = np.repeat(np.arange(self.count), self.end - self.begin + 1)
        valid = np.arange(len(self.text)) + window <= self.end[stretch]
        least = np.full(groups + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group_of[valid], owner[stretch[valid]])
        return valid & (least[group_of] < owner[stretch])


def byte_units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column)
    return BYTE_CODES[0][data], bounds


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, body``: texts compressed one by one, as they are to cross a shuffle."""
    def pack(batches):
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches):
            data, bounds = text_bytes(batch.column("text"))
            raw = memoryview(np.ascontiguousarray(data))
            body = [squeeze.compress(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(body, pa.binary())],
                                             ["doc_id", "text_hash", "body"])

    return docs.mapInArrow(pack, "doc_id long, text_hash long, body binary")


def unpacked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``limit`` bytes of text, with the text in place of the body."""
    import zstandard
    stretch = zstandard.ZstdDecompressor()
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            texts, size, to = [], 0, at
            while to < batch.num_rows and (to == at or size < limit):
                texts.append(stretch.decompress(batch.column("body")[to].as_py()))
                size += len(texts[-1])
                to += 1
            yield batch.slice(at, to - at).append_column("text", pa.array(texts, pa.binary()).cast(pa.string())).drop_columns(["body"])
            at = to


#: Columns of the stretches packed into one row, and their kinds.
PARTS = (("slice", np.uint8), ("length", np.int32), ("doc_id", np.int64), ("text_hash", np.int64), ("start", np.int32),
         ("windows", np.int32), ("text", np.uint8))


def stretches(docs: DataFrame, window: int) -> DataFrame:
    """``shard, body``: stretches in question, a compressed row for each chunk and shard; equal strings meet in one shard.

    ``docs(doc_id, text_hash, body, found)`` comes with the answers to its runs. Of equal stretches in a chunk only the
    least document's is sent with its text; the others are settled. So content that very many documents share reaches
    its shard once per chunk.
    """
    shards = partitions(docs.sparkSession)

    def cut(batches):
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in unpacked(batches, repeats.CHUNK_BYTES):
            runs = repeats.live_runs(batch, byte_units, window_sums, ANCHOR, window, False)
            data, bounds = text_bytes(batch.column("text"))
            cells = [[np.frombuffer(x, kind) for x in c] for c, kind in zip(zip(*runs), (np.int32, np.int32, np.uint64))]
            row = np.repeat(np.arange(batch.num_rows), [len(x) for x in cells[0]])
            start, count, value = (np.concatenate(c) for c in cells)
            length = count + np.int32(window - 1)
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            text = pa.Array.from_buffers(pa.binary(), len(row), [
                None, pa.py_buffer(offsets), pa.py_buffer(data[ranges(bounds[row] + start, length)].tobytes())])
            code = text.dictionary_encode().indices.to_numpy()
            doc, texts = (batch.column(c).to_numpy()[row] for c in ("doc_id", "text_hash"))
            least = np.full(int(code.max(initial=-1)) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, code, doc)
            settled = doc > least[code]
            shard = (value % np.uint64(shards)).astype(np.int64)
            shard[settled] = shards  # behind all others
            part = (value // np.uint64(shards) % np.uint64(SLICES)).astype(np.uint8)
            order = np.argsort(shard, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(order))
            out = []
            for x, y in zip(cuts, cuts[1:]):
                some = order[x:y]
                to = int(shard[some[0]])
                size = length[some] if to < shards else np.zeros(len(some), np.int32)
                body = data[ranges(bounds[row[some]] + start[some], size)]
                if to == shards:
                    to = int(texts[0] % shards)
                out.append((to, squeeze.compress(join_parts(part[some], size, doc[some], texts[some], start[some], count[some], body))))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())],
                                             ["shard", "body"])

    return docs.mapInArrow(cut, "shard int, body binary")


def join_parts(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(a) for a in arrays], np.int64)
    return b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def split_parts(body: bytes) -> dict[str, np.ndarray]:
    sizes, at, out = np.frombuffer(body, np.int64, len(PARTS)), 8 * len(PARTS), {}
    for (name, kind), n in zip(PARTS, sizes):
        out[name] = np.frombuffer(body, kind, int(n), at)
        at += int(n) * np.dtype(kind).itemsize
    return out


def judged(pieces: DataFrame, window: int) -> DataFrame:
    """``doc_id, text_hash, found``: pairs (first window, number of windows) that also begin in a smaller document.

    Each task writes the different stretches of its shard to disk as they arrive and sorts their suffixes from there.
    """
    def sort(batches):
        import zstandard
        stretch, parts = zstandard.ZstdDecompressor(), [Slice() for _ in range(SLICES)]
        for batch in batches:
            for body in batch.column("body"):
                cells = split_parts(stretch.decompress(body.as_py()))
                ends = np.cumsum(cells["length"], dtype=np.int64)
                text, bounds = cells["text"].tobytes(), (ends - cells["length"]).tolist()
                for i in np.unique(cells["slice"]):
                    parts[i].add(np.flatnonzero(cells["slice"] == i), cells, text, bounds, ends.tolist())
        while parts:
            yield from parts.pop().answers(window, dests)

    dests = partitions(pieces.sparkSession)
    return repeats.gathered(pieces.repartition(dests, "shard").mapInArrow(sort, repeats.REPLY))


class Slice:
    """Stretches that are sorted together: their bytes in a file, each different stretch once, and where they occur."""

    def __init__(self):
        self.spool, self.number = tempfile.TemporaryFile(), {}
        self.lengths, self.least, self.seen = array("i"), array("q"), []

    def add(self, chosen: np.ndarray, cells: dict[str, np.ndarray], text: bytes, begin: list[int], end: list[int]) -> None:
        """The ``chosen`` of the stretches in ``cells``; those without text are settled."""
        index, doc = np.full(len(chosen), -1, np.int64), cells["doc_id"][chosen]
        for i, (at, d) in enumerate(zip(chosen.tolist(), doc.tolist())):
            if end[at] > begin[at]:
                body = text[begin[at]:end[at]]
                number = self.number.setdefault(hashlib.blake2b(body, digest_size=16).digest(), len(self.number))
                if number == len(self.lengths):
                    self.spool.write(body)
                    self.lengths.append(len(body))
                    self.least.append(d)
                elif d < self.least[number]:
                    self.least[number] = d
                index[i] = number
        self.seen.append((index, doc, *(cells[c][chosen] for c in ("text_hash", "start", "windows"))))

    def answers(self, window: int, dests: int) -> Iterator[pa.RecordBatch]:
        """Pairs (first window, number of windows) to the documents of each destination."""
        if not self.seen:
            return
        index, doc, texts, start, windows = (np.concatenate(x) for x in zip(*self.seen))
        owner, lengths = np.array(self.least, np.int64), np.array(self.lengths, np.int64)
        self.number = self.seen = None
        whole = index < 0
        flags, first = np.zeros(1, bool), np.zeros(1, np.int64)
        if len(owner):
            self.spool.flush()
            shard = Shard(np.memmap(self.spool, np.uint8, "r", shape=int(lengths.sum())), np.concatenate([[0], np.cumsum(lengths)]))
            flags, first = shard.smaller(owner, window), shard.begin
            whole |= doc > owner[index]
        self.spool.close()
        # the least document of a stretch has the windows that were flagged, all others have all
        some = np.flatnonzero(~whole)
        at = ranges(first[index[some]], windows[some].astype(np.int64))
        by = np.repeat(some, windows[some])
        inner = at - first[index[by]]
        on = flags[at]
        before = np.concatenate([[False], on[:-1]]) & (inner > 0)
        after = np.concatenate([on[1:], [False]]) & (inner < windows[by] - 1)
        head, tail = np.flatnonzero(on & ~before), np.flatnonzero(on & ~after)
        rows = np.concatenate([np.flatnonzero(whole), by[head]])
        begin = np.concatenate([start[whole], start[by[head]] + inner[head]]).astype(np.int32)
        count = np.concatenate([windows[whole], tail - head + 1]).astype(np.int32)
        order = np.lexsort((texts, doc))
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc[order]) != 0) | (np.diff(texts[order]) != 0)
        owner = np.empty(len(doc), np.int64)
        owner[order] = np.cumsum(new) - 1
        one = order[new]
        yield repeats.reply(doc[one], texts[one], owner[rows], np.stack([begin, count], axis=1), dests)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every row of ``docs(doc_id, text)``.

    Removed is each byte covered by ``window`` bytes that also begin in a document with a smaller doc_id; strings are
    judged on the input and lie in one document. ``spans`` lists ``first`` byte and number of ``bytes`` of each removed
    piece. Null text is empty; a null doc_id counts as the largest; rows with one doc_id don't remove each other's
    bytes; other columns are ignored; an empty table gives an empty result.
    """
    docs = repeats.numbered(docs)
    replies = repeats.ask_runs(docs, byte_units, window_sums, ANCHOR, window)
    pieces = stretches(repeats.with_answers(packed(docs), replies, "inner"), window)
    found = repeats.with_answers(packed(docs), judged(pieces, window))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())]))

    def remove(batches):
        for batch in unpacked(batches, CHUNK_BYTES):
            data, bounds = text_bytes(batch.column("text"))
            rows = []
            for i, parts in enumerate(batch.column("found").to_pylist()):
                pairs = np.frombuffer(parts or b"", np.int32).reshape(-1, 2).astype(np.int64)
                change = np.zeros(int(bounds[i + 1] - bounds[i]) + 1, np.int32)
                np.add.at(change, pairs[:, 0], 1)
                np.add.at(change, pairs[:, 0] + pairs[:, 1] + window - 1, -1)
                inside = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))).reshape(-1, 2)
                sha = hashlib.sha256(data[bounds[i]:bounds[i + 1]][~inside].tobytes()).hexdigest()
                rows.append((len(inside), int(inside.sum()), len(edge), sha,
                             [{"first": int(a), "bytes": int(b - a)} for a, b in edge]))
            size, removed, n, sha, spans = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(removed), pa.array(n), pa.array(sha), pa.array(spans, kind)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return found.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                    "spans array<struct<first:long,bytes:long>>").withColumn("doc_id", without_id())


@query()
def op3_induced_sorting(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes that repeat 50-byte strings of smaller documents, removed from every document."""
    return remove_repeats(read(spark, folder, "documents")).drop("spans")
