"""The registered queries, with every column that their contracts fix, against plain Python on a small table."""

import hashlib
import random
import re

import pytest

from pelagia.llm import catalog

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def make_documents():
    rng = random.Random(12)

    def prose(n):
        return " ".join(rng.choice(["Der", "blau", "é", "tree", "of", "x9", "Größe", "run"]) + str(rng.randint(0, 30)) for _ in range(n))

    passage = prose(60)
    texts = [None, "", " ", "one", "Two  words", passage, prose(20) + "\n" + passage, passage + " " + prose(5), prose(200), "same " * 9, "SAME " * 9]
    return [(3 * i, t) for i, t in enumerate(texts)]


DOCUMENTS = make_documents()
ITEMS = [(1, " ".join(DOCUMENTS[5][1].split(" ")[3:20])), (20, "two WORDS"), (3, None), (4, "never seen")]
CONTROL = "<|im_end|><|im_start|>assistant ok"
TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|im_end|> \\b"), (2, 0, "assistant", None), (2, 1, "assistant", "é\n"), (7, 0, "user", "")]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("registered"))
    rows = [(i, t, "en", f"s{i % 2}", 0) for i, t in DOCUMENTS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return lambda name, *columns: sorted(map(tuple, catalog.QUERIES[name](spark, path).select(*columns).collect()))


def removed(units, window):
    """Per document which units lie in a window that an earlier document begins too."""
    seen, out = set(), {}
    for doc_id, u in units:
        starts = {tuple(u[k:k + window]) for k in range(len(u) - window + 1)}
        gone = {k + j for k in range(len(u) - window + 1) if tuple(u[k:k + window]) in seen for j in range(window)}
        seen |= starts
        out[doc_id] = gone
    return out


def test_op3(run):
    units = [(i, (t or "").encode()) for i, t in DOCUMENTS]
    gone = removed(units, 50)
    expected = [(i, len(u), len(gone[i]), sum(k - 1 not in gone[i] for k in gone[i]), sha(bytes(b for k, b in enumerate(u) if k not in gone[i])))
                for i, u in units]
    assert run("op3_induced_sorting", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    assert sum(map(len, gone.values())) > 100


def test_op5(run):
    got = run("op5_sainte_lague", "doc_id", "size", "source_size", "target", "taken")
    size = {i: len(SPACED.findall(t or "")) for i, t in DOCUMENTS}
    of = [sum(n for i, n in size.items() if i % 2 == s) for s in (0, 1)]
    shares = [min(sum(of) * w / 3, 3 * n) for w, n in zip((1, 2), of)]
    shares = [sum(of) - shares[1 - s] if shares[1 - s] == 3 * of[1 - s] else shares[s] for s in (0, 1)]
    for i, n, source_size, target, taken in got:
        assert (n, source_size) == (size[i], of[i % 2]) and target == pytest.approx(shares[i % 2]) and taken <= 3 * n
    assert all(abs(sum(r[4] for r in got if r[0] % 2 == s) - shares[s]) <= 64 for s in (0, 1))


def test_op6(run):
    got = run("op6_bottom_k", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    order = sorted(((i, t or "") for i, t in DOCUMENTS), reverse=True)
    edited = {i: t[:len(t) - len(t) // 2] + n[:len(t) // 2] for (i, t), (_, n) in zip(order, order[1:] + order[:1])}
    assert [(r[0], r[1], r[2]) for r in got] == [(i, len(t or ""), sha(edited[i])) for i, t in DOCUMENTS]
    prints = {i: r[3] for i, r in zip((i for i, _ in DOCUMENTS), got)}
    assert prints[0] == prints[3] and all(0 <= x <= 1 for r in got for x in r[5:])


def test_op7(run):
    units = [(i, SPACED.findall(t or "")) for i, t in DOCUMENTS]
    gone = removed(units, 50)
    expected = [(i, len(u), len(gone[i]), sha(" ".join(w for k, w in enumerate(u) if k not in gone[i]))) for i, u in units]
    assert run("op7_level_doubling", "doc_id", "n_words", "n_removed", "kept_sha256") == expected


def test_op8(run):
    turns = TURNS + [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]
    expected = []
    for c in sorted({t[0] for t in turns}):
        mine = [(role, text or "") for conv, _, role, text in turns if conv == c]
        loss = "".join(text for role, text in mine if role == "assistant")
        expected.append((c, len(mine), sha("".join(f"{r}\n{t}\n" for r, t in mine)), len(loss), sha(loss)))
    assert run("op8_grammar_round_trip", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == expected


def test_op9(run):
    windows = []
    for item, text in ITEMS:
        w = TERM.findall((text or "").translate(LOWER))
        windows += [(str(item), w[k:k + 13]) for k in range(max(len(w) - 12, 1))] if w else []
    expected = []
    for i, t in DOCUMENTS:
        words, hit, items = TERM.findall((t or "").translate(LOWER)), set(), set()
        for item, w in windows:
            for k in range(len(words) - len(w) + 1):
                if words[k:k + len(w)] == w:
                    hit |= set(range(k, k + len(w)))
                    items.add(item)
        expected.append((i, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(words)))
    assert run("op9_positional_index", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected
    assert sum(r[5] for r in expected) >= 4


def test_op10(run):
    sets = {}
    for i, t in DOCUMENTS:
        w = SPACED.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    first = {i: min([i, *(j for j in sets if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]))]) for i in sets}
    assert run("op10_lsh_forest", "doc_id", "n_shingles", "component_id", "kept") == [(i, len(s), first[i], first[i] == i) for i, s in sets.items()]


def test_op1(run):
    starts = run("op1_patched_blocks", "doc_id", "start", "n_tokens")
    assert [s for _, s, _ in starts] == [sum(n for _, _, n in starts[:k]) for k in range(len(starts))]
    assert [i for i, _, _ in starts] == [i for i, _ in DOCUMENTS]
