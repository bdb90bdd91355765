"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of its documents one after another, cut into blocks of 128. Every block stores its least id,
a width chosen so that nine in ten offsets from it fit, the low bits of all offsets in that width, and a list of
exceptions (position and high bits) for the others. Layout, little-endian::

    "PFR1"
    block*     u32 least, u8 width, u8 exceptions, u16 ids, width x 16 bytes of bit planes,
               exceptions x u8 position, exceptions x u32 high bits
    index      u64 offset of each block's start
    documents  i64 doc_id and u64 number of ids of each document
    footer     u64 blocks, u64 documents, u64 ids, u64 offset of the index, "PFR1"
"""

from __future__ import annotations

import codecs
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pelagia.llm.common import (chunks, lowered, partitions, ranges, read, span_array, spaced_words, text_bytes, with_id,
                                without_id, word_spans)
from pelagia.llm.registry import query
from pelagia.runtime import scratch_path, stage

BLOCK = 128
PERCENTILE = 0.9
MAGIC = b"PFR1"
HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "u1"), ("ids", "<u2")])
FOOT = np.dtype([("blocks", "<u8"), ("documents", "<u8"), ("ids", "<u8"), ("index", "<u8")])
BATCH_BLOCKS = 4096
ENCODE_BYTES = 2 << 20


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of ``ids`` and the size of each; only the last block may be shorter than 128."""
    ids = ids.astype(np.uint32)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return b"", np.zeros(0, np.int64)
    table = np.full((blocks, BLOCK), ids[-1] if len(ids) else 0, np.uint32)
    table.reshape(-1)[:len(ids)] = ids
    head = np.zeros(blocks, HEAD)
    head["ids"] = BLOCK
    head["ids"][-1] = len(ids) - (blocks - 1) * BLOCK
    head["least"] = table.min(axis=1)
    table -= head["least"][:, None]
    bits = np.zeros(table.shape, np.uint8)  # bits that each offset needs
    for b in range(int(table.max()).bit_length()):
        bits += (table >> np.uint32(b)) > 0
    width = np.partition(bits, int(BLOCK * PERCENTILE), axis=1)[:, int(BLOCK * PERCENTILE)]
    head["width"] = width
    outside = bits > width[:, None]
    head["exceptions"] = outside.sum(axis=1)
    size = HEAD.itemsize + 16 * width.astype(np.int64) + 5 * head["exceptions"].astype(np.int64)
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    out[begin[:, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(blocks, -1)
    for b in range(int(width.max())):
        at = np.flatnonzero(width > b)
        plane = np.packbits(((table[at] >> np.uint32(b)) & 1).astype(np.uint8), axis=1)
        out[(begin[at] + HEAD.itemsize + 16 * b)[:, None] + np.arange(16)] = plane
    row, place = np.nonzero(outside)
    count = head["exceptions"].astype(np.int64)
    rank = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    after = begin[row] + HEAD.itemsize + 16 * width[row].astype(np.int64)
    out[after + rank] = place
    high = (table[row, place] >> width[row].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(after + count[row] + 4 * rank)[:, None] + np.arange(4)] = high
    return out.tobytes(), size


def unpack(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``begin`` in ``data``."""
    head = data[begin[:, None] + np.arange(HEAD.itemsize)].reshape(-1).view(HEAD)
    width, count = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    table = np.zeros((len(begin), BLOCK), np.uint32)
    for b in range(int(width.max(initial=0))):
        at = np.flatnonzero(width > b)
        plane = np.unpackbits(data[(begin[at] + HEAD.itemsize + 16 * b)[:, None] + np.arange(16)], axis=1)
        table[at] |= plane.astype(np.uint32) << np.uint32(b)
    row = np.repeat(np.arange(len(begin)), count)
    rank = ranges(np.zeros(len(begin), np.int64), count)
    after = begin[row] + HEAD.itemsize + 16 * width[row]
    place = data[after + rank]
    high = data[(after + count[row] + 4 * rank)[:, None] + np.arange(4)].reshape(-1).view("<u4")
    table[row, place] |= high.astype(np.uint32) << width[row].astype(np.uint32)
    table += head["least"][:, None]
    return table.reshape(-1)[(np.arange(BLOCK) < head["ids"][:, None]).reshape(-1)]


class Writer:
    """Writes one file; ids arrive document by document and only a few blocks are held."""

    def __init__(self, sink):
        self.sink, self.at = sink, len(MAGIC)
        self.waiting, self.held = [], 0
        self.sizes, self.doc_ids, self.counts = [], [], []
        sink.write(MAGIC)

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.counts.append(counts)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BATCH_BLOCKS * BLOCK:
            self.flush(self.held // BLOCK * BLOCK)

    def flush(self, many: int) -> None:
        held = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, many, BATCH_BLOCKS * BLOCK):
            body, sizes = pack(held[at:min(at + BATCH_BLOCKS * BLOCK, many)])
            self.sink.write(body)
            self.sizes.append(sizes)
        self.waiting, self.held = [held[many:]], len(held) - many

    def close(self) -> tuple[int, int]:
        self.flush(self.held)
        sizes, doc_ids, counts = (np.concatenate(x) if x else np.zeros(0, np.int64)
                                  for x in (self.sizes, self.doc_ids, self.counts))
        starts = len(MAGIC) + np.cumsum(sizes) - sizes
        self.sink.write(starts.astype("<u8").tobytes())
        documents = np.zeros(len(doc_ids), [("doc_id", "<i8"), ("n", "<u8")])
        documents["doc_id"], documents["n"] = doc_ids, counts
        self.sink.write(documents.tobytes())
        foot = np.array([(len(sizes), len(doc_ids), counts.sum(), len(MAGIC) + sizes.sum())], FOOT)
        self.sink.write(foot.tobytes() + MAGIC)
        return len(doc_ids), int(counts.sum())


def read_file(source, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``doc_ids, counts, ids`` of a file, some blocks' documents at a time; a document's ids come whole."""
    tail = FOOT.itemsize + len(MAGIC)
    last = source.read_at(tail, size - tail)
    if last[-4:] != MAGIC or source.read_at(4, 0) != MAGIC:
        raise ValueError("not a complete token file")
    foot = np.frombuffer(last[:-4], FOOT)[0]
    index = np.frombuffer(source.read_at(8 * int(foot["blocks"]), int(foot["index"])), "<u8").astype(np.int64)
    documents = np.frombuffer(source.read_at(16 * int(foot["documents"]), int(foot["index"]) + 8 * len(index)), "<i8").reshape(-1, 2)
    ends = np.append(index, int(foot["index"]))
    held, done = [np.zeros(0, np.uint32)], 0
    need = np.cumsum(documents[:, 1])
    decoded = given = 0
    for at in range(0, max(len(index), 1), BATCH_BLOCKS):
        to = min(at + BATCH_BLOCKS, len(index))
        if to > at:
            data = np.frombuffer(source.read_at(int(ends[to] - ends[at]), int(ends[at])), np.uint8)
            ids = unpack(data, index[at:to] - index[at])
            held.append(ids)
            decoded += len(ids)
        ready = int(np.searchsorted(need, decoded, "right"))
        if ready > done:
            ids, many = np.concatenate(held), int(need[ready - 1]) - given
            yield documents[done:ready, 0], documents[done:ready, 1], ids[:many]
            held, given, done = [ids[many:]], given + many, ready


LETTERS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
#: The letters by which byte-level vocabularies write the bytes that aren't printable in Latin-1.
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(
    b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}
#: The letter of each byte, but for the line feed, which stays.
BYTE_NAMES = "".join(chr(BYTE_LETTERS.get(b, b)) if b != 10 else "\n" for b in range(256))


class WordEncoder:
    """Ids of texts with a tokenizer that cuts at white space; every word is encoded once and remembered.

    White space (ASCII) and a full stop or comma between a letter and white space are always token boundaries of the
    vocabulary this is meant for, so a text's ids are those of its pieces. Texts that may hold special tokens are
    encoded whole. Of more than ``WORDS`` words, those that occurred in one batch only are forgotten.
    """

    WORDS = 1 << 19

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, int] = {}
        self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.used = np.zeros(0, np.int32)  # batches that had the word
        # a word of letters, lower-cased, is one piece for the model; asked directly, if the two agree
        self.direct = False
        tries = ["a", "word", "straße", "éclair", "übermäßig", "naïveté", "zzzxqy", "Éclair", "ÀÖØÞà"]
        self.direct = self.encode_words(tries) == self.whole(tries) == self.pieces(tries)

    def forget(self) -> None:
        """Keep the words that occurred in several batches, at most half of those there may be."""
        keep = np.argsort(-self.used, kind="stable")[:self.WORDS // 2]
        keep = np.sort(keep[self.used[keep] > 1])
        words = list(self.known)  # in the order of their numbers
        self.known = {words[i]: k for k, i in enumerate(keep.tolist())}
        self.flat = self.flat[ranges((np.cumsum(self.lengths) - self.lengths)[keep], self.lengths[keep])]
        self.lengths, self.used = self.lengths[keep], np.zeros(len(keep), np.int32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, words: list[str]) -> list[list[int]]:
        """Ids of words of letters, asked of the model without the steps before it."""
        tokenize = self.tokenizer.model.tokenize
        names = codecs.charmap_decode("\n".join(words).lower().encode(), "strict", BYTE_NAMES)[0].split("\n")
        return [[t.id for t in tokenize(name)] for name in names] if words else []

    def encode_words(self, words: list[str]) -> list[list[int]]:
        if not self.direct:
            return self.whole(words)
        out, plain = [None] * len(words), [LETTERS.fullmatch(w) is not None for w in words]
        for some, ask in ((True, self.pieces), (False, self.whole)):
            chosen = [i for i, x in enumerate(plain) if x is some]
            for i, ids in zip(chosen, ask([words[i] for i in chosen])):
                out[i] = ids
        return out

    def learn(self, words: list[bytes]) -> None:
        """Encode new words and give them the next numbers."""
        lengths, flat = [self.lengths], [self.flat]
        for k in range(0, len(words), 4096):
            lists = self.encode_words([w.decode() for w in words[k:k + 4096]])
            lengths.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            flat.append(np.fromiter(chain.from_iterable(lists), np.uint32))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.lengths, self.flat = np.concatenate(lengths), np.concatenate(flat)
        self.used = np.concatenate([self.used, np.zeros(len(words), np.int32)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids."""
        data, bounds = text_bytes(column)
        starts, ends, first = word_spans(data, bounds, spaced_words())
        letter = np.zeros(256, bool)
        letter[65:91] = letter[97:123] = True
        end = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        stop = ((end == 0x2E) | (end == 0x2C)) & (ends - starts > 1)
        last = data[ends[stop] - 2]
        # a letter of Latin-1 has two bytes; the two signs among them are no letters
        latin = (ends[stop] - starts[stop] > 2) & (data[ends[stop] - 3] == 0xC3) & (last >= 0x80) & (last < 0xC0) & (last != 0x97) & (last != 0xB7)
        stop[stop] = letter[last] | latin
        # a stopped word becomes two pieces
        pieces = 1 + stop.astype(np.int64)
        at = np.cumsum(pieces) - pieces
        total = int(pieces.sum())
        a, b = np.empty(total, np.int64), np.empty(total, np.int64)
        a[at], b[at] = starts, ends - stop
        a[at[stop] + 1], b[at[stop] + 1] = ends[stop] - 1, ends[stop]
        first = np.append(at, total)[first]
        # A-Z is lower-cased by the vocabulary anyway
        words = span_array(a, b, lowered()[data] if self.direct else data).dictionary_encode()
        _, bound, body = words.dictionary.buffers()
        bound, body = np.frombuffer(bound, np.int32)[:len(words.dictionary) + 1].tolist(), body.to_pybytes() if body else b""
        unique = [body[x:y] for x, y in zip(bound, bound[1:])]
        if len(self.known) > self.WORDS:
            self.forget()
        place = np.fromiter(map(self.known.get, unique, repeat(-1)), np.int64, len(unique))
        new = np.flatnonzero(place < 0)
        place[new] = np.arange(len(self.known), len(self.known) + len(new))
        self.learn([unique[i] for i in new])
        self.used[place] += 1
        number = place[words.indices.to_numpy()]
        n = self.lengths[number]
        ids = self.flat[ranges((np.cumsum(self.lengths) - self.lengths)[number], n)]
        total_before = np.concatenate([[0], np.cumsum(n)])
        counts = total_before[first[1:]] - total_before[first[:-1]]
        special = self._special(data, bounds)
        if len(special):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in special:
                parts[i] = np.array(self.whole([data[bounds[i]:bounds[i + 1]].tobytes().decode()])[0], np.uint32)
            counts, ids = np.array([len(p) for p in parts], np.int64), np.concatenate(parts)
        return counts, ids

    @staticmethod
    def _special(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows with ``<|``, the beginning of every special token."""
        at = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) > 1 else np.zeros(0, np.int64)
        return np.unique(np.searchsorted(bounds, at, "right") - 1)


_encoders: dict[str, WordEncoder] = {}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, files: int | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write the ids to files under ``path``; returns ``file, documents, ids``.

    Documents are put in ascending order of doc_id (rows with one doc_id by the hash of their text, a null doc_id
    last), ``end_id`` follows each, null and empty texts have only that; other columns are ignored. ``file`` is the
    number of a file in that order; its name holds the attempt that wrote it, so a repeated task leaves at most a
    file that no list names. ``path`` must be reachable by all executors. An empty table writes no documents.
    """
    spark = docs.sparkSession
    rows = docs.select(with_id(), F.xxhash64("text").alias("_hash"), "text")
    rows = rows.repartitionByRange(files or partitions(spark), "doc_id", "_hash").sortWithinPartitions("doc_id", "_hash")
    rows = rows.select(F.spark_partition_id().alias("_file"), "doc_id", "text")

    def write(batches):
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, WordEncoder(tokenizer))
        system, folder = pafs.FileSystem.from_uri(path)
        name = writer = None
        for batch in chunks(batches, limit=ENCODE_BYTES):
            if writer is None:
                number = batch.column("_file")[0].as_py()
                name = f"part-{number:06d}-{uuid.uuid4().hex}.pfr"
                system.create_dir(folder, recursive=True)
                sink = system.open_output_stream(f"{folder}/{name}")
                writer = Writer(sink)
            counts, ids = encoder.encode(batch.column("text"))
            out = np.full(len(ids) + len(counts), end_id, np.uint32)
            out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            writer.add(batch.column("doc_id").to_numpy(), counts + 1, out)
        if writer is not None:
            documents, total = writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int32()), "file": [name], "documents": [documents], "ids": [total]})

    return stage(rows.mapInArrow(write, "number int, file string, documents long, ids long"), "files")


def read_tokens(files: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document in the files that :func:`write_tokens` listed.

    ``start`` counts the ids of all documents before it.
    """
    line = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.withColumn("_base", F.coalesce(F.sum("ids").over(line), F.lit(0)))
    files = files.repartition(partitions(files.sparkSession), "file")

    def load(batches):
        system, folder = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("_base").to_pylist()):
                place = f"{folder}/{name}"
                with system.open_input_file(place) as source:
                    for doc_ids, counts, ids in read_file(source, source.size()):
                        ends = np.cumsum(counts)
                        body = memoryview(ids.astype("<u4").tobytes())
                        crc = [zlib.crc32(body[4 * a:4 * b]) for a, b in zip(ends - counts, ends)]
                        for at in range(0, len(counts), 4096):
                            cut = slice(at, at + 4096)
                            low, high = (ends - counts)[cut][0], ends[cut][-1]
                            lists = pa.ListArray.from_arrays(
                                pa.array(np.append((ends - counts)[cut], high) - low, pa.int32()),
                                pa.array(ids[low:high].astype(np.int32)))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(doc_ids[cut]), pa.array(base + (ends - counts)[cut]), pa.array(counts[cut]),
                                 pa.array(crc[cut], pa.int64()), lists],
                                ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                        base += int(ends[-1])

    rows = files.select("file", "_base").mapInArrow(
        load, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")
    return rows.select(without_id(), "start", "n_tokens", "ids_crc32", "ids")


@query()
def op1_patched_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from the files."""
    import public_tokenizers
    path = scratch_path(spark, "tokens")
    files = write_tokens(read(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    return read_tokens(files, path).drop("ids")
