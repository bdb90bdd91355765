"""One result at every size: small sources in mixes, repeated rows, several blocks of items, and clashing column names."""

import collections
import random
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pelagia.llm import contamination, lexical, mixing, neardup, simhash, spelling, suffixes, tokens, toxicity
from pelagia.llm.common import ARROW_BYTES


def prose(rng, n):
    return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(n))


@pytest.mark.parametrize("weights,shard_words", [((1, 2, 3), 1 << 20), ((1, 2, 3), 2500), ((3000, 1, 1), 2500), ((3000, 1, 1), 1 << 20)])
def test_small_sources_meet_their_targets_in_any_number_of_shards(spark, weights, shard_words):
    rng = random.Random(2)
    rows = [(i, prose(rng, 750), "a") for i in range(200)] + [(1000 + i, prose(rng, 30), "b") for i in range(40)]
    rows += [(2000 + i, prose(rng, 10), "c") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, weights=weights, shard_words=shard_words).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    for r in found:
        shards = max(1, -(-150_000 // shard_words)) if r.source == "a" else 1
        assert abs(r.taken - r.target) <= 64 * shards and r.over <= 0, (r, shards)
    assert {r.source for r in found} == {"a", "b", "c"}


@pytest.mark.parametrize("seed", [0, 1])
def test_mixed_rows_hold_the_words_taken(spark, seed):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(1, 200)), "a", 1) for i in range(30)] + [(7, "one two three four five six", "b", k) for k in range(10)]
    rows += [(None, prose(rng, 70), None, 0), (None, None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row long").withColumns({"_spans": F.lit(1), "_size_text": F.lit("t")})
    taken = {r.source: r.n for r in mixing.mix(docs, seed=seed, block_words=4).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    mixed = mixing.mixed_documents(docs, seed=seed, block_words=4)
    assert mixed.schema == docs.schema
    written = collections.Counter()
    for r in mixed.collect():
        written[r.source] += len(r.text.split(" "))
    assert written == {k: n for k, n in taken.items() if n}


def test_blocks_of_items_keep_every_row(spark, monkeypatch):
    rng = random.Random(6)
    passage = prose(rng, 40)
    rows = [(1, passage), (1, passage), (None, passage), (None, passage), (None, None), (2, prose(rng, 30)), (2, "clean text"), (3, None)]
    items = [(i, passage if i == 3 else prose(rng, 20)) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, contamination.contamination(docs, items).collect()), key=repr)
    monkeypatch.setattr(contamination, "QUERY_CHARS", 150)
    assert sorted(map(tuple, contamination.contamination(docs, items).collect()), key=repr) == whole
    assert len(whole) == len(rows) and sum(r[-1] for r in whole) == 4


def test_clashing_columns_change_nothing(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60) for _ in range(6)]
    rows = [(i, texts[i % 6] + (" end" if i > 8 else "")) for i in range(12)]
    plain = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    names = ["_doc_id", "_text_hash", "_spans", "_text", "_id", "_label", "_row", "row", "doc_key", "text_key", "carried", "tid", "size", "shard",
             "first", "part", "key", "leaf", "word", "n", "_order", "_end", "_source", "_shard", "rep", "root", "labels", "segment", "place", "terms"]
    docs = plain.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    items = spark.createDataFrame([(1, texts[2])], "item_id long, text string")
    labels = plain.select("doc_id", (F.col("doc_id") % 6 == 0).cast("int").alias("toxic"))

    def outcome(d):
        model = toxicity.train(d, labels)
        tables = [neardup.near_duplicates(d), simhash.near_fingerprints(d), spelling.variants(d), lexical.search(d, items),
                  contamination.contamination(d, items), toxicity.score(d, model), mixing.mix(d),
                  *[t.select("doc_id", "text") for t in (neardup.without_near_duplicates(d), contamination.without_contaminated(d, items),
                                                         toxicity.without_toxic(d, model), mixing.mixed_documents(d))]]
        return [sorted(map(repr, t.collect())) for t in tables]

    assert outcome(docs) == outcome(plain)
    assert neardup.without_near_duplicates(docs).columns == docs.columns


def test_machine_learns_terms_that_matter_only_together(spark):
    rng = random.Random(1)

    def text(*words):
        return " ".join([*words, *(f"w{rng.randint(0, 60)}" for _ in range(8))])

    rows = [text("insult") for _ in range(570)] + [text("mention") for _ in range(570)]
    toxic = [text("insult", "mention") for _ in range(30)] + [text("slur") for _ in range(300)]
    rows += [text() for _ in range(4530)]
    docs = spark.createDataFrame(list(enumerate(rows + toxic)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") >= len(rows)).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    asked = spark.createDataFrame([(1, "insult mention w3"), (2, "insult w3"), (3, "mention w3"), (4, "w3 w4"), (5, "slur w3")], docs.schema)
    found = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
    assert found[1] > 0.5 and found[5] > 0.5 and max(found[2], found[3], found[4]) < 0.1


def test_word_encoder_forgets_rare_words_only():
    import public_tokenizers
    import pyarrow as pa
    encoder = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.WORDS = 40
    texts = ["Éveil. éclair, ÀÇÑÞß. naïf× x÷. ×. é. É,\nþé.. œuvre. Ünïçödé, e\u0301t\u0301. ÿŸ. don't."] + [
        f"often und {'abcdefghij'[i % 10] * (i + 1)}É {i}é. Ø{i}, nächste" for i in range(60)]
    expected = encoder.whole(texts)
    asked, learn = [], encoder.learn
    encoder.learn = lambda words: (asked.extend(words), learn(words))
    for at in range(0, len(texts), 3):
        counts, ids = encoder.encode(pa.array(texts[at:at + 3]))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [list(e) for e in expected[at:at + 3]]
    assert len(encoder.known) < 100 and asked.count(b"often") == 1 and asked.count(b".") <= 2
    assert b"\xc3\xa9clair," not in asked


def test_suffix_helpers_against_their_definition():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 256, 300).astype(np.uint8)
    begin = rng.integers(0, 299, 500)
    end = begin + rng.integers(1, 301 - begin)
    assert suffixes.Carry._range(values, begin, end).tolist() == [int(values[a:b].min()) for a, b in zip(begin, end)]
    parts = [b"abcdefghijkl", b"abc", b"z" * 9]
    shard = suffixes.Shard(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
    for begin, part in zip(shard.begin, parts):
        raised = bytes(x + 1 for x in part)
        got = shard.words(begin + np.arange(len(part)), len(part) - np.arange(len(part)))
        assert got.tolist() == [int.from_bytes(raised[i:i + 8].ljust(8, b"\0"), "big") for i in range(len(part))]


def test_a_task_of_the_search_holds_one_segment_at_a_time(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, prose(rng, 60)) for i in range(120)] + [(None, None), (500, ""), (501, prose(rng, 2000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(i, prose(rng, 30)) for i in range(5)], "item_id long, text string")
    whole = sorted(map(tuple, lexical.search(docs, items).collect()), key=repr)
    before = spark.conf.get(ARROW_BYTES)
    real_stage, real_block, files, handed = lexical.stage, lexical._search_block, [], []

    def staged(df, name, **options):
        table = real_stage(df, name, **options)
        files.extend(table.inputFiles() if name == "index" else [])
        return table

    def sizes(batches):
        yield from (pa.record_batch({"n": pa.array([b.num_rows], pa.int64())}) for b in batches)

    def block(index, *rest):
        handed.extend(r.n for r in index.mapInArrow(sizes, "n long").collect())
        return real_block(index, *rest)

    monkeypatch.setattr(lexical, "SEGMENT_BYTES", 2000)
    monkeypatch.setattr(lexical, "stage", staged)
    monkeypatch.setattr(lexical, "_search_block", block)
    assert sorted(map(tuple, lexical.search(docs, items).collect()), key=repr) == whole and len(whole) == 100
    held = [pq.ParquetFile(urlparse(f).path).metadata for f in files]
    groups = [m.row_group(g).num_rows for m in held for g in range(m.num_row_groups)]
    # written, decoded and handed to Python one by one; the small batches they are made of are put together
    assert set(groups) == set(handed) == {1} and 5 < len(groups) == len(handed) < 40
    assert spark.conf.get(ARROW_BYTES) == before


def test_segments_are_filled_from_small_batches():
    texts = ["a" * n for n in (10, 10, 300, 5, 90, 20)] + [None, ""] * 60
    batches = [pa.record_batch({"doc_id": [i], "text": pa.array([t], pa.string())}) for i, t in enumerate(texts)]
    got = [b.column("doc_id").to_pylist() for b in lexical.filled(iter(batches), 160)]
    assert sum(got, []) == list(range(len(texts))) and got[:4] == [[0, 1], [2], [3, 4], [5, 6, 7, 8, 9, 10, 11, 12]]
    # rows without text fill segments too
    assert {len(g) for g in got[4:-1]} == {10}
    assert list(lexical.filled(iter([]), 160)) == []
