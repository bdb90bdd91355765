"""Each operator against a brute-force version on a small table with nulls, empty and long texts, ties and copies."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pelagia.llm import chat, common, contamination, fingerprint, langid, mixing, neardup, substrings, suffixes, tokens, toxicity
from pelagia.runtime import scratch_path

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, found string"


def make_rows():
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abdeiknorstu"), rng.integers(2, 8))) for _ in range(400)] + ["é", "straße", "Ünal."]

    def prose(n):
        return " ".join(rng.choice(vocabulary, n))

    passage = prose(70)
    base = prose(120).split(" ")
    texts = [None, "", "  \t\n", "one", "two words", "Three short words", "...", "don't stop <|endoftext|> ('s) it's", prose(3000)]
    texts += [prose(int(n)) for n in rng.integers(1, 150, 25)]
    texts += [prose(10) + " " + passage + "\n" + prose(15) for _ in range(4)] + [prose(90)] * 1 + [passage] * 3
    for _ in range(25):  # near copies of different degree
        copy = list(base)
        for i in rng.integers(0, len(copy), rng.integers(0, 9)):
            copy[i] = "x" + str(rng.integers(0, 99))
        texts.append(" ".join(copy))
    texts += ["a" * 300, "b" * 40 + "a" * 120, "same text"] + ["copy of one text with several more words"] * 30
    return [(i * 7 % 1009, t, None if i % 5 == 0 else "en", None if i % 11 == 0 else f"s{i % 3}", 1, 0.5, "r", "f")
            for i, t in enumerate(texts)]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_tokens_equal_the_tokenizer(spark, docs, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, start, expected = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted((r[0], r[1] or "") for r in ROWS):
        ids = whole.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    folder = scratch_path(spark, "tokens")
    got = tokens.read_tokens(tokens.write_tokens(docs, folder, path, 2, files=3), folder).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected
    folder = scratch_path(spark, "tokens")
    assert tokens.read_tokens(tokens.write_tokens(empty, folder, path, 2), folder).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [2**32 - 1], list(range(5000)), [7] * 300 + [2**31] + [1] * 127])
def test_blocks_round_trip(ids):
    body, sizes = tokens.pack(np.array(ids, np.uint32))
    data = np.frombuffer(body, np.uint8)
    assert tokens.unpack(data, np.cumsum(sizes) - sizes).tolist() == ids if ids else body == b""


def brute_removal(units, window):
    seen, out = set(), {}
    for doc_id, u in sorted(units):
        wins = [tuple(u[k:k + window]) for k in range(len(u) - window + 1)]
        gone = set()
        for k, w in enumerate(wins):
            if w in seen:
                gone.update(range(k, k + window))
        seen.update(wins)
        out[doc_id] = (u, gone)
    return out


def test_word_passages_equal_brute_force(docs, empty):
    expected = {}
    for doc_id, (u, gone) in brute_removal([(r[0], SPACED.findall(r[1] or "")) for r in ROWS], 50).items():
        kept = " ".join(w for k, w in enumerate(u) if k not in gone)
        expected[doc_id] = (len(u), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substrings.remove_repeats(docs).drop("kept").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected and len(got) == len(ROWS)
    assert sum(v[1] for v in expected.values()) > 300
    assert substrings.remove_repeats(empty).count() == 0


def test_bytes_equal_brute_force(docs, empty):
    expected = {}
    for doc_id, (u, gone) in brute_removal([(r[0], (r[1] or "").encode()) for r in ROWS], 50).items():
        spans = sum(1 for k in gone if k - 1 not in gone)
        kept = bytes(b for k, b in enumerate(u) if k not in gone)
        expected[doc_id] = (len(u), len(gone), spans, hashlib.sha256(kept).hexdigest())
    got = suffixes.remove_repeats(docs).collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == expected
    assert all(sum(s["bytes"] for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans for r in got)
    assert suffixes.remove_repeats(empty).count() == 0


def test_suffix_order_and_shared_prefixes_with_spilled_queues():
    rng = np.random.default_rng(3)

    def shared(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for _ in range(150):
        strings = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 40)).astype(np.uint8))
                   for _ in range(rng.integers(1, 8))]
        shard = suffixes.Shard(np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0] + [len(s) for s in strings]))
        parts = list(shard.order(limit=64))
        at = {int(shard.begin[i]) + k: s[k:] for i, s in enumerate(strings) for k in range(len(s))}
        order = [at[int(p)] for piece, _ in parts for p in piece]
        assert order == sorted(at.values(), reverse=True)
        common_ = [int(n) for _, piece in parts for n in piece]
        assert common_ == [0] + [shared(a, b) for a, b in zip(order, order[1:])]


def test_near_duplicates_equal_brute_force(docs, empty):
    sets = {}
    for r in ROWS:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in SPACED.findall(r[1] or "")]
        sets[r[0]] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if root[a] < root[b] and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    root[b], changed = root[a], True
                elif root[a] > root[b] and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    root[a], changed = root[b], True
    expected = {d: (len(s), root[d]) for d, s in sets.items()}
    for limit in (neardup.REGION, 4):  # the second splits regions by depth and tile
        got = neardup.near_duplicates(docs, region=limit).collect()
        assert {r[0]: tuple(r)[1:] for r in got} == expected
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_by_other_shingles(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:180] + [f"v{i}" for i in range(20)]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    # 176 of 216 five-word shingles are shared, and 178 of 218 of three words, which is less than 85 %
    found = {r[0]: tuple(r)[1:] for r in neardup.near_duplicates(table, 80, words=5).collect()}
    assert found == {1: (196, 1), 2: (196, 1)}
    assert {r[0]: r[2] for r in neardup.near_duplicates(table).collect()} == {1: 1, 2: 2}


@pytest.mark.parametrize("percent", [75, 80, 85, 95])
def test_pairs_at_the_threshold_are_confirmed(percent):
    n, p = neardup.TREES * neardup.DEPTH, percent / 100
    least = neardup.least_agreement(percent)
    assert sum(math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(least)) <= 1e-9
    assert (1 - p**neardup.last_depth(percent)) ** neardup.TREES <= 1e-3 or neardup.last_depth(percent) == neardup.FIRST_DEPTH
    rng = np.random.default_rng(percent)
    agree = []
    for _ in range(150):  # two sets of hashes with 2 * percent common ones of 200
        value = rng.integers(0, 2**64, 200, np.uint64)
        one = 2 * percent + (200 - 2 * percent) // 2
        a, b = np.sort(value[:one]), np.sort(np.concatenate([value[:2 * percent], value[one:]]))
        labels = neardup.labels_of(np.array([0, len(a), 200 + 2 * percent]), np.concatenate([a, b]))
        agree.append(int((labels[0] == labels[1]).sum()))
    assert np.mean(agree) == pytest.approx(n * p, abs=3) and min(agree) >= least


def test_rows_without_an_id_of_their_own(spark):
    texts = {n: " ".join(f"{n}{i}" for i in range(100)) for n in "abcd"}
    rows = [(None, texts["a"], "1"), (None, texts["b"], "2"), (None, texts["b"] + " end", "3"), (7, texts["a"] + " end", "4"),
            (7, texts["c"], "5"), (7, texts["c"], "6"), (9, texts["c"] + " end", "7"), (None, None, "8"), (None, None, "9"),
            (7, texts["d"], "10"), (None, "clean text", "11")]
    table = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted(tuple(r) for r in neardup.near_duplicates(table).collect())
    none = common.NO_ID
    assert got == sorted([(none, 98, 7), (none, 98, none), (none, 99, none), (7, 99, 7), (7, 98, 7), (7, 98, 7), (9, 99, 7),
                          (none, 0, none), (none, 0, none), (7, 98, 7), (none, 1, none)])
    kept = {r.row for r in neardup.without_near_duplicates(table).collect()}
    assert len(kept & {"2", "3"}) == 1 and kept - {"2", "3"} == {"4", "5", "8", "9", "10", "11"}
    items = spark.createDataFrame([(1, texts["d"]), (2, texts["b"])], "item_id long, text string")
    kept = {r.row for r in contamination.without_contaminated(table, items).collect()}
    assert kept == {"1", "4", "5", "6", "7", "8", "9", "11"}


def test_contamination_equals_brute_force(spark, docs, empty):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    long = next(r[1] for r in ROWS if r[1] and len(r[1]) > 9000)
    items = [(1, " ".join(long.split(" ")[100:130])), (10, "Two WORDS"), (2, None), (3, "..."), (4, "copy of one text"),
             (10, "several more"), (5, "never seen " * 9)]
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    expected = {}
    for r in ROWS:
        w, hit, found = words(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        expected[r[0]] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.contamination(docs, table).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in got} == expected
    assert contamination.contamination(empty, table).count() == 0
    assert contamination.contamination(docs, table.limit(0)).where("n_hit > 0").count() == 0


def test_apportionment_equals_quotients():
    rng = np.random.default_rng(5)
    for _ in range(100):
        weights, most = rng.integers(0, 9, 6).astype(float), rng.integers(0, 12, 6)
        seats, given = int(rng.integers(0, 40)), np.zeros(6, int)
        for _ in range(seats):
            q = np.where((given < most) & (weights > 0), weights / (2 * given + 1), -1)
            if q.max() <= 0:
                break
            given[q.argmax()] += 1
        assert mixing.apportion(weights, seats, most).tolist() == given.tolist()


def test_mix_meets_its_targets(docs, empty):
    rows = [r.asDict() for r in mixing.mix(docs, block_words=4, shard_words=3000).collect()]
    again = [r.asDict() for r in mixing.mix(docs.repartition(3), block_words=4, shard_words=3000).collect()]
    assert sorted(rows, key=repr) == sorted(again, key=repr)
    source = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and r["taken"] == sum(s["words"] * s["times"] for s in r["spans"])
        s = source.setdefault(r["source"], [r["source_size"], r["target"], 0, 0])
        s[2], s[3] = s[2] + r["taken"], s[3] + r["size"]
    sizes = {k: v[0] for k, v in source.items()}
    weight = {k: i % 3 + 1 for i, k in enumerate(sorted(sizes, key=lambda k: (k is None, k or "")))}
    target, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        full = {k for k in open_ if left * weight[k] / sum(weight[x] for x in open_) > 3 * sizes[k]}
        for k in full or open_:
            target[k] = 3.0 * sizes[k] if full else left * weight[k] / sum(weight[x] for x in open_)
        left -= sum(target[k] for k in full)
        open_ -= full or open_
    for k, (size, goal, taken, seen) in source.items():
        assert size == seen and goal == pytest.approx(target[k]) and abs(taken - goal) < 40
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(docs, block_words=4)
    assert mixed.schema == docs.schema and mixed.count() > 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|im_end|> b <\\|x <|im_start|>assistant ok"), (1, 2, "assistant", None),
            (2, 0, "we<ird\n\\role", ""), (None, 0, None, "x\n<|im_end|>\n"), (2, 0, "we<ird\n\\role", ""), (3, None, "assistant", "é" * 9)]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    out = out.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t in rows[:3]]
    assert got[1].loss == rows[1][3] and got[3].loss == "é" * 9 and got[2].loss == ""
    assert [tuple(t) for t in got[2].turns] == [("we<ird\n\\role", "")] * 2 and got[None].turns[0].text == "x\n<|im_end|>\n"
    assert got[1].formatted.count("<|im_start|>") == 3 == got[1].formatted.count("<|im_end|>\n")


def test_sketches(spark, docs, empty):
    rows = sorted(((r[0], r[1] or "") for r in ROWS), reverse=True)
    expected = {}
    for (d, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        expected[d] = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
    got = {r.doc_id: r for r in fingerprint.edited_documents(docs).collect()}
    assert {d: r.edited for d, r in got.items()} == expected
    prints = collections.defaultdict(set)
    for r in got.values():
        prints[r.text].add(tuple(r.sketch))
    assert all(len(p) == 1 for p in prints.values())

    def shingles(t):
        w = SPACED.findall(t)
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    pairs = docs.sparkSession.createDataFrame([(d, r.sketch, r.edited_sketch) for d, r in got.items()],
                                              "doc_id long, a array<long>, b array<long>")
    for d, near, count, inside in pairs.select("doc_id", fingerprint.resemblance(F.col("a"), F.col("b")),
                                               fingerprint.distinct_count(F.col("a")), fingerprint.containment(F.col("a"), F.col("b"))).collect():
        a, b = shingles(got[d].text), shingles(got[d].edited)
        assert abs(near - (len(a & b) / len(a | b) if a | b else 1)) < 0.2
        assert abs(count - len(a)) <= 0.35 * len(a) and 0 <= inside <= 1
    parts = spark.createDataFrame([(1, [1, 5, 9]), (1, [2, 5]), (2, [])], "k int, s array<long>")
    assert [tuple(r) for r in fingerprint.merge_sketches(parts, "k", "s", k=3).collect()] == [(1, [1, 2, 5])]
    assert fingerprint.edited_documents(empty).count() == 0


def test_factorization_machine_learns_pairs():
    rng = np.random.default_rng(1)
    rows, label = [], []
    for _ in range(3000):  # terms 0 and 1 are bad only together
        terms = set(rng.integers(2, 30, 6).tolist()) | {t for t in (0, 1) if rng.random() < 0.4}
        rows.append(sorted(terms))
        label.append(float({0, 1} <= terms))
    machine = toxicity.FactorizationMachine(30)
    first = np.cumsum([0] + [len(r) for r in rows])
    machine.fit(np.concatenate(rows), first, np.array(label))
    raw, _ = machine.parts(np.array([0, 1, 5, 0, 5, 1, 5]), np.array([0, 0, 0, 1, 1, 2, 2]), 3)
    assert raw[0] > 1 and raw[1] < -1 and raw[2] < -1


def test_toxicity_and_language_on_odd_rows(spark, docs, empty):
    labels = docs.select("doc_id", F.when(F.col("text").like("%copy%"), 1).otherwise(0).alias("toxic"))
    model = toxicity.train(docs, labels)
    scored = {r.doc_id: r for r in toxicity.score(docs, model, carry={"source": F.col("source")}).collect()}
    assert len(scored) == len(ROWS) and all(scored[r[0]].predicted == int("copy" in (r[1] or "")) for r in ROWS)
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).where("score = 0.5").count() == len(ROWS)
    assert toxicity.score(empty, model).count() == 0
    found = {r.doc_id: r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert all((found[r[0]].lang_pred == "und") == (not re.search(r"[^\W\d_]", r[1] or "")) for r in ROWS)
    assert {r.lang_pred for r in langid.predict(docs, langid.train(empty)).collect()} == {"und"}


def test_toxicity_stage_without_usable_labels(spark, docs):
    null = docs.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    for labels in (null, null.limit(0)):
        assert toxicity.without_toxic(docs, toxicity.train(docs, labels)).count() == len(ROWS)


def test_mixture_finds_both_languages(spark):
    folder = "/root/testdata/sf0.001"
    docs = common.read(spark, folder, "documents")
    model = langid.train(docs)
    two = {lang: docs.where(F.col("lang") == lang).orderBy(F.desc("n_chars")).first().text for lang in ("en", "de")}
    n = min(len(t) for t in two.values()) // 64 * 64
    mixed = spark.createDataFrame([(1, two["en"][:n] + two["de"][:n])], "doc_id long, text string")
    share = langid.predict(mixed, model).first().proportions
    assert share["en"] == pytest.approx(0.5, abs=0.1) and share["de"] == pytest.approx(0.5, abs=0.1)


def test_pipeline_on_a_small_table(spark):
    import corpus_pipeline
    folder = "/root/testdata/sf0.001"
    docs = common.read(spark, folder, "documents")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    components = neardup.near_duplicates(docs).where("doc_id = component_id").count()
    assert kept.count() == components
    out = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert out[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:]))
