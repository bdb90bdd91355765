"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-sized blocks.

Documents of a source are laid out in a seeded order inside shards and cut into blocks of equal word counts. A source has shards
by its own size, so a small one is in a single shard and rounded once, however large the others are.
Inside each shard the blocks to take are given to the sources one by one, always to the highest quotient
``target / (2 * taken + 1)``; that yields whole quotas. Which blocks of a source are taken is then a seeded choice, where the last
block of a source counts by the words it has.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pelagia.llm.common import chunks, ranges, read, spaced_words, text_bytes, word_spans
from pelagia.llm.registry import query
from pelagia.runtime import stage

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
MAX_REPEATS = 3
# Text handled at once inside a task.
TEXT_BYTES = 1 << 20


def sizes(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """``doc_id, source, text_hash, size``: words of each text, 0 for null; with ``whole_rows`` also each row as ``row``."""
    names = ["doc_id", "source", "text_hash"]
    columns = ["doc_id", "source", F.xxhash64("text").alias("text_hash")]
    if whole_rows:
        # the text is handed over once, inside the row
        docs, text = docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "row"
        kind, at = docs.schema, docs.schema["row"].dataType.names.index("text")
        names = [*names, "row"]
    else:
        docs, text, at = docs.select(*columns, "text"), "text", None
        kind = docs.drop("text").schema

    def count(batches):
        inside = spaced_words()
        for batch in batches:
            column = batch.column(text) if at is None else batch.column(text).flatten()[at]
            batch = batch.append_column("_size_text", column)
            for part in chunks([batch], "_size_text", TEXT_BYTES):
                _, _, first = word_spans(*text_bytes(part.column("_size_text")), inside)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(np.diff(first))], [*names, "size"])

    return docs.mapInArrow(count, T.StructType(list(kind.fields)).add("size", "long"))


def targets(by_source: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the whole size. A target stops at
    ``most`` times the size of its source and the excess is shared again by weight. Sharing until none is above
    is the same as raising one common level until all is given out, so one pass over the sources in the order in
    which they fill up is enough. The table has a row per source, not per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1))
    table = by_source.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = (table.withColumn("_total", F.sum("source_size").over(whole))
             .withColumn("_full", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             .withColumn("_left", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    level = (F.col("_total") - F.col("_full")) / F.col("_left")
    # the level is that of the first source that it doesn't fill
    table = table.withColumn("_level", F.when(F.col("_cap") / F.col("_w") >= level, level))
    table = table.withColumn("_level", F.coalesce(F.max("_level").over(whole), F.lit(float("inf"))))
    return table.select("source", "source_size",
                        F.least(F.col("_cap"), F.col("_w") * F.col("_level")).alias("target"))


def apportion(weights: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Sainte-Laguë seats for each weight, at most ``most`` of them; ties go to the earlier entry.

    Seats up to a common quotient are found by halving; what equal quotients leave is handed out in order.
    """
    weights, most = np.asarray(weights, float), np.asarray(most, np.int64)
    seats = int(min(seats, most[weights > 0].sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def at(quotient: float) -> np.ndarray:
        return np.minimum(most, np.floor((weights / quotient + 1) / 2).astype(np.int64))

    high, low = weights.max() * 2, weights[weights > 0].min() / (2.0 * most.max() + 3)
    for _ in range(100):
        middle = (high * low) ** 0.5
        if at(middle).sum() <= seats:
            high = middle
        else:
            low = middle
    given = at(high)
    while (rest := seats - int(given.sum())) > 0:  # equal quotients only
        quotients = np.where(given < most, weights / (2 * given + 1), -1)
        given[np.argsort(-quotients, kind="stable")[:min(rest, int((quotients > 0).sum()))]] += 1
    return given


def _planned(docs: DataFrame, weights: tuple[float, ...], most: int, block_words: int, shard_words: int, seed: int,
             whole_rows: bool) -> DataFrame:
    """:func:`mix`, with each row of ``docs`` as ``row`` if asked for."""
    light = stage(sizes(docs), "sizes")
    goal = targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    goal = stage(goal.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")), "targets")
    of = goal.select(F.col("source").alias("_source"), "shards")

    def sharded(sized: DataFrame) -> DataFrame:
        """Every row with its shard; equal ids are kept side by side unless their texts differ."""
        shard = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), F.col("shards")).alias("shard")
        return sized.join(of, sized["source"].eqNullSafe(of["_source"])).select(*sized.columns, shard)

    parts = sharded(light).groupBy("source", "shard").agg(F.sum("size").alias("part"))
    # a source's share of its target follows its share of words in the shard
    parts = parts.join(goal, parts["source"].eqNullSafe(goal["source"])).select(
        parts["source"], "shard", "part", "source_size", "target")

    def quotas(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("source", na_position="last", ignore_index=True)
        share, part = (frame.target * frame.part / frame.source_size.clip(lower=1)).to_numpy(), frame.part.to_numpy()
        given = apportion(share, round(share.sum() / block_words), -(-most * part // block_words))
        return frame[["source", "shard", "part", "source_size", "target"]].assign(quota=np.minimum(given * block_words, most * part))

    text = docs.select("source").schema[0].dataType.simpleString()
    quota = stage(parts.groupBy("shard").applyInPandas(
        quotas, f"source {text}, shard long, part long, source_size long, target double, quota long"), "quotas")
    quota = quota.withColumnsRenamed({"source": "_source", "shard": "_shard"})
    line = Window.partitionBy("source", "shard").orderBy("_order", "doc_id", "text_hash", "size")
    place = sharded(sizes(docs, True) if whole_rows else light).withColumn("_order", F.xxhash64(F.lit(seed + 1), "doc_id"))
    place = place.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    placed = place.join(quota, place["source"].eqNullSafe(F.col("_source")) & (place["shard"] == F.col("_shard")))
    carried = ["row"] if whole_rows else []

    def spans(batches):
        for batch in batches:
            get = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "_end", "part", "quota", "_salt")}
            start, end, part = get["_end"] - get["size"], get["_end"], np.maximum(get["part"], 1)
            first = start // block_words
            count = np.where(get["size"] > 0, (end - 1) // block_words - first + 1, 0)
            row = np.repeat(np.arange(len(count)), count)
            block = ranges(first, count)
            blocks = -(-part // block_words)
            passes, rest = get["quota"] // part, get["quota"] % part
            # blocks in the order of a seeded step through all of them; the first ones get one more
            step = _coprime(get["_salt"], blocks)
            turns = (get["_salt"] & 0xFFFF) % blocks
            last, short = ((blocks - 1) * step + turns) % blocks, blocks * block_words - part
            more = (2 * rest + block_words) // (2 * block_words)
            # the last block has fewer words: with it among the first ones, one block more may come nearer
            lacking = rest - more * block_words + np.where(last < more, short, 0)
            more = more + (2 * lacking >= block_words)
            turn = (block * step[row] + turns[row]) % blocks[row]
            times = passes[row] + (turn < more[row])
            a, b = np.maximum(block * block_words, start[row]), np.minimum((block + 1) * block_words, end[row])
            use = times > 0
            taken = np.bincount(row, (b - a) * times, len(count)).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[use], minlength=len(count)))]).astype(np.int32)
            struct = pa.StructArray.from_arrays([pa.array((a - start[row])[use]), pa.array((b - a)[use]),
                                                 pa.array(times[use])], ["first", "words", "times"])
            names = ["doc_id", "text_hash", "source", "size", "source_size", "target", *carried]
            columns = [*[batch.column(c) for c in names], pa.array(taken), pa.ListArray.from_arrays(pa.array(offsets), struct)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "taken", "spans"])

    salt = F.abs(F.xxhash64(F.lit(seed), place["source"], "shard") % (1 << 30)).alias("_salt")
    placed = placed.select("doc_id", "text_hash", place["source"], "size", "source_size", "target", *carried, "_end", "part", "quota", salt)
    kind = placed.drop("_end", "part", "quota", "_salt").schema
    piece = T.StructType().add("first", "long").add("words", "long").add("times", "long")
    return placed.mapInArrow(spans, T.StructType(list(kind.fields)).add("taken", "long").add("spans", T.ArrayType(piece)))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MAX_REPEATS,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 0) -> DataFrame:
    """Spans of words to take: ``doc_id, text_hash, source, size, source_size, target, taken, spans``.

    ``docs(doc_id, text, source)``; other columns are ignored. ``spans`` lists ``first`` word, number of ``words``
    and ``times`` for every piece taken, ``taken`` is their sum with repeats. Null text has size 0 and takes nothing;
    null is a source of its own, ordered last; rows with equal doc_id and text are laid out side by side; an empty table gives
    an empty result. A source is spread over as many shards as its own size asks for, so a hot source is split; what it takes
    in a shard is within a block of its share there.
    """
    return _planned(docs, weights, most, block_words, shard_words, seed, False)


def _coprime(salt: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each row a step that visits all of 0..n-1; equal rows get equal steps."""
    keys, back = np.unique(np.stack([salt, n]), axis=1, return_inverse=True)
    steps = []
    for s, m in keys.T:
        step = int(s) % int(m) or 1
        while np.gcd(step, int(m)) != 1:
            step += 1
        steps.append(step)
    return np.array(steps, np.int64)[back.reshape(-1)]


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MAX_REPEATS,
                    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 0) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each pass over a document.

    The text of pass *p* is made of the pieces taken at least *p* times, their words joined by one space. Every row carries its own
    pieces, also if its doc_id and text are repeated; see :func:`mix` for nulls and empty tables.
    """
    plan = _planned(docs, weights, most, block_words, shard_words, seed, True).where(F.size("spans") > 0).select("row", "spans")
    inside, kind = spaced_words(), docs.schema
    at = kind.names.index("text")

    def cut(batches):
        for whole in batches:
            whole = whole.append_column("_size_text", whole.column("row").flatten()[at])
            for batch in chunks([whole], "_size_text", TEXT_BYTES):
                data, bounds = text_bytes(batch.column("_size_text"))
                starts, ends, first = word_spans(data, bounds, inside)
                raw, rows, texts = data.tobytes(), [], []
                for i, spans in enumerate(batch.column("spans").to_pylist()):
                    for p in range(max((s["times"] for s in spans), default=0)):
                        words = [raw[starts[w]:ends[w]] for s in spans if s["times"] > p
                                 for w in range(first[i] + s["first"], first[i] + s["first"] + s["words"])]
                        rows.append(i)
                        texts.append(b" ".join(words).decode())
                fields = [f.take(pa.array(rows, pa.int64())) for f in batch.column("row").flatten()]
                fields[at] = pa.array(texts, fields[at].type)
                yield pa.RecordBatch.from_arrays(fields, kind.names)

    return plan.mapInArrow(cut, kind)


@query()
def op5_sainte_lague(spark: SparkSession, folder: str) -> DataFrame:
    """Which words of which documents the mix of all documents takes."""
    return mix(read(spark, folder, "documents")).drop("text_hash")
