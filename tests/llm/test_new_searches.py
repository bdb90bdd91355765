"""Ranked search, SimHash groups and spelling variants against brute force, through their registered queries."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from pelagia.llm import catalog, lexical, simhash, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = ("doc_id long, text string, lang string, source string, key long, word string, leaf long, n long, lead long, part string, "
        "fingerprint string, rank int, _doc_id long")


def make_rows():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdeéñü") for _ in range(rng.randint(3, 11))) for _ in range(120)]

    def prose(n):
        return " ".join(rng.choice(stems) for _ in range(n))

    base = prose(1200).split(" ")
    texts = [None, "", " \t\n", "...!?", "one", "Two Words", "ZWEIÜNDÄ zweiÜndÄ", "x" * 9000, prose(20_000)]
    texts += [prose(rng.randint(1, 120)) for _ in range(60)] + ["same text of a few words"] * 25
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = "y" + str(rng.randint(0, 9))
        texts.append(" ".join(copy))
    ids = [i * 13 % 1009 for i in range(len(texts))]
    # no id, a repeated row, and one id with several texts
    more = [(None, prose(30)), (None, base[0] * 2), (None, None), (5, texts[20]), (5, texts[20]), (5, "other text")]
    return [*zip(ids, texts), *more]


ROWS = make_rows()
ITEMS = [(1, " ".join((ROWS[10][1] or "").split(" ")[:40])), (2, "same TEXT of"), (3, None), (4, "..."), (None, "few words words"), (2, "one"),
         (6, "never seen words9"), (7, " ".join(f"w{i}" for i in range(80)) + " " + (ROWS[30][1] or "")), (8, ROWS[8][1])]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts"))
    rows = [(i, t, "en", "s", 1, "w", 2, 3, 4, "p", "f", 5, 6) for i, t in ROWS]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_repr(rows):
    return sorted(rows, key=repr)


def ranked_by_hand(docs, items):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(i, collections.Counter(term.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        terms, scores = term.findall((text or "").translate(LOWER)), []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:20], 1)]
    return out


def test_ranked_search_equals_brute_force(spark, folder, empty, monkeypatch):
    expected = by_repr(ranked_by_hand(ROWS, ITEMS))
    assert len(expected) > 60
    got = catalog.QUERIES["op11_presence_masks"](spark, folder)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert by_repr(map(tuple, got.collect())) == expected
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    # several blocks of items, small segments
    monkeypatch.setattr(lexical, "ITEM_BYTES", 60_000)
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", 400)
    assert by_repr(map(tuple, lexical.search(docs, items).collect())) == expected
    assert lexical.search(empty, items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0


def test_masks_that_cannot_win_are_not_scored(spark, monkeypatch):
    rows = [(i, " ".join(["common"] + (["rare"] if i % 50 == 0 else []) + (["third"] if i % 3 == 0 else []))) for i in range(3000)]
    index = lexical.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()[0]
    cells = {c: pa.array(index[c]) for c in index.asDict()}
    vocabulary = pa.array(["common", "rare", "third"])
    terms = sum(len(t.split(" ")) for _, t in rows)
    segment = lexical.Segment(lambda name: cells[name], vocabulary, 3000, terms)
    scored = []
    real = lexical.Segment.scores
    monkeypatch.setattr(lexical.Segment, "scores", lambda self, docs, *a: scored.append(len(docs)) or real(self, docs, *a))
    monkeypatch.setattr(lexical, "FIRST_MASKS", 1)
    none = np.zeros(0, np.int64)
    score, ids = lexical.best_of(segment, np.arange(3), np.array([1, 4000, 3000]), (none, none), 20)
    # documents with all three terms are every 150th, and just twenty of them
    assert sorted(ids.tolist()) == list(range(0, 3000, 150)) and sum(scored) == 20


def fingerprint_by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, distance=2):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_near_fingerprints_equal_brute_force(spark, folder, empty):
    last = 2**63 - 1
    rows = sorted(ROWS, key=lambda r: last if r[0] is None else r[0])
    prints = [fingerprint_by_hand(t) for _, t in rows]
    expected = by_repr((i, f"{p:016x}", rows[r][0]) for (i, _), p, r in zip(rows, prints, components_by_hand(prints)))
    got = catalog.QUERIES["op12_binary_trie"](spark, folder)
    assert by_repr(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect())) == expected
    links = {f"{p:016x}": sum((p ^ q).bit_count() <= 2 for q in set(prints)) - 1 for p in prints}
    assert {r.fingerprint: r.n_links for r in got.collect()} == links and max(links.values()) > 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    opened = simhash.near_fingerprints(docs, limit=3)  # the upper part of the trie goes deep
    assert by_repr(map(tuple, opened.select("doc_id", "fingerprint", "component_id").collect())) == expected
    assert simhash.near_fingerprints(empty).count() == 0


@pytest.mark.parametrize("limit", [simhash.PAIR_LEAVES, 6])
def test_trie_walk_finds_every_near_pair(spark, limit, monkeypatch):
    rng = np.random.default_rng(limit)
    centre = rng.integers(0, 2**64, 12, np.uint64)
    noise = np.array([sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))) for _ in range(25 * len(centre))], np.uint64)
    leaf = np.unique(np.concatenate([centre, np.repeat(centre, 25) ^ noise, np.array([0, 1, 3, 7, 2**64 - 1, 2**63], np.uint64)]))
    near = np.bitwise_count(leaf[:, None] ^ leaf[None, :]) <= 2
    monkeypatch.setattr(simhash, "FRONT_PAIRS", 64)  # the walk goes on in pieces
    whole = np.array([[0], [len(leaf)]])
    pairs = {(int(a), int(b)) for us, vs in simhash.walk(leaf, whole, whole, 2) for a, b in zip(us, vs)}
    assert {tuple(sorted(p)) for p in pairs} == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
    table = spark.createDataFrame([(int(v),) for v in leaf.view(np.int64)], "leaf long")
    found = collections.Counter()
    for r in simhash.neighbours(table, limit=limit).collect():
        found[r.leaf] += r.links
    assert found == {int(v): int(n) - 1 for v, n in zip(leaf.view(np.int64), near.sum(axis=1)) if n > 1}


def edits_by_hand(words):
    letters, out = sorted({c for w in words for c in w}), {}
    for w in words:
        near = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        out[w] = (near | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}) & set(words) - {w}
    return out


def test_composition_equals_brute_force():
    rng = random.Random(3)
    for round_ in range(150):
        letters = "abcé"[:rng.randint(1, 4)]
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 50))})
        expected = {tuple(sorted((a, b))) for a, near in edits_by_hand(words).items() for b in near}
        got = [tuple(sorted(pair)) for pair in spelling.near_pairs(words)]
        assert set(got) == expected and len(got) == len(expected)
    long = ["a" * 3000, "a" * 3001, "a" * 1500 + "b" + "a" * 1499]
    assert {tuple(sorted(map(len, p))) for p in spelling.near_pairs(sorted(long))} == {(3000, 3000), (3000, 3001)}


def test_acceptor_is_minimal():
    machine = spelling.Acceptor(sorted(a + b for a in ("a", "bc", "d") for b in ("", "ing", "ed", "s")))
    # three stems lead to one state, the endings to one end: begin, after b, endings, i, in, e, end
    assert len(machine.arcs) == 7


def variants_by_hand(rows, damage=31, times=10):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 7
    words = {w: k for w, k in n.items() if k >= 2}
    near = edits_by_hand(words)
    best = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: b if b is not None and words[b] >= times * words[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return by_repr((w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words)


def test_spelling_variants_equal_brute_force(spark, folder, empty):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    got = catalog.QUERIES["op13_finite_state"](spark, folder).select(columns)
    assert by_repr(map(tuple, got.collect())) == variants_by_hand(ROWS)
    assert spelling.variants(empty).count() == 0


@pytest.mark.parametrize("part_words", [spelling.PART_WORDS, 10])
def test_forms_and_roots_in_parts(spark, part_words):
    rng = random.Random(8)
    stems = ["vergleich" + "".join(rng.choice("abß") for _ in range(rng.randint(0, 5))) for _ in range(60)]
    rows = [(i, " ".join([rng.choice(stems)] * rng.choice([1, 1, 12, 150, 1800]) + [rng.choice(stems).upper()])) for i in range(300)]
    rows += [(None, None), (None, "vergleich vergleich"), (7, ""), (7, "x" * 5000 + " " + "x" * 5000)]
    expected = variants_by_hand(rows, damage=7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = spelling.variants(docs, part_words=part_words, damage=7)
    assert by_repr(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == expected
    assert any(r[1] and r[2] != r[1] for r in expected)
