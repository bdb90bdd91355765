"""Spelling variants: pairs of words one edit apart, found by composing finite-state machines.

The vocabulary is an acceptor V. A transducer T passes a word on with exactly one letter inserted, deleted or replaced; it has two
states, before and after the edit. The paths of the composition V . T . V are the pairs sought. Before the edit both
acceptors stand in the same state, which is a prefix; after it both read the same letters. So the composition falls into
parts by the prefix where it begins:

* A prefix with few words is a part for a task: the acceptor of these words is minimised, and its composition is walked from
  that state on, which gives all pairs that share the prefix.
* A prefix with many words is opened on the cluster instead. A pair that is edited inside it has equal letters from there on,
  so one key holds both words: the word without the letter at the place of the edit. Such a key has at most
  a word per letter of the alphabet.

Each pair comes from one part only: the place of its edit is the length of the words' common prefix.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pelagia.llm.common import chunks, partitions, read
from pelagia.llm.registry import query
from pelagia.runtime import stage, stage_counting

LEAST_LETTERS = 7
LEAST_TIMES = 2
DAMAGE = 31
MORE_OFTEN = 10
# A prefix with more words than this is opened by a shuffle.
PART_WORDS = 8192
# Distinct words that a task counts at once.
COUNTED_WORDS = 200_000

_RUNS = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def word_counts(docs: DataFrame, damage: int = DAMAGE) -> DataFrame:
    """``word, n``: the words of ``docs(doc_id, text)`` with at least 7 letters, and how often each occurs.

    A run of letters, A-Z lower-cased, loses one if ``damage`` divides the crc32 of ``<doc_id>:<run>``, the one at that checksum modulo
    its length. A null doc_id is the empty text there. Shorter runs can't give a word and are passed over.
    """
    def count(batches):
        def table(found):
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

        found = Counter()
        for batch in chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                # bytes.lower() changes A-Z only
                for run, n in Counter(_RUNS.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % damage == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < LEAST_LETTERS:
                            continue
                    found[run] += n
                if len(found) > COUNTED_WORDS:
                    yield table(found)
                    found = Counter()
        yield table(found)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- inside a task -------------------------------------------------------------------------------------

class Acceptor:
    """The smallest deterministic acceptor of some words: ``arcs[state]`` maps letters to states, ``final[state]`` tells words' ends.

    Words come in ascending order, so a state is finished, and merged with an equal one, as soon as the next word has left it.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        register: dict[tuple, int] = {}
        open_final, open_arcs, letters = [False], [{}], []

        def close(depth: int) -> int:
            state = -1
            while len(open_arcs) > depth:
                ends, arcs = open_final.pop(), open_arcs.pop()
                key = (ends, *arcs.items())
                state = register.get(key, -1)
                if state < 0:
                    state = register[key] = len(self.arcs)
                    self.arcs.append(arcs)
                    self.final.append(ends)
                if letters:
                    open_arcs[-1][letters.pop()] = state
            return state

        last = ""
        for word in words:
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            close(same + 1)
            for letter in word[same:]:
                letters.append(letter)
                open_final.append(False)
                open_arcs.append({})
            open_final[-1] = True
            last = word
        self.root = close(0)


class Composition:
    """The states of V . T . V after the edit, two states of ``acceptor`` that read the same letters, cut to those that lead to an end."""

    def __init__(self, acceptor: Acceptor):
        self.of = acceptor
        # a pair's arcs to pairs that lead to an end; None if no common word is left
        self.live: dict[tuple[int, int], list[tuple[str, tuple[int, int]]] | None] = {}

    def shared(self, p: int, q: int) -> list[tuple[str, tuple[int, int]]]:
        """Letters that both states read, and the pairs of states they lead to."""
        a, b = self.of.arcs[p], self.of.arcs[q]
        if len(b) < len(a):
            return [(letter, _pair(a[letter], to)) for letter, to in b.items() if letter in a]
        return [(letter, _pair(to, b[letter])) for letter, to in a.items() if letter in b]

    def leads_on(self, pair: tuple[int, int]) -> bool:
        """Whether both states accept a common word."""
        todo = [pair]
        while todo:
            at = todo[-1]
            if at in self.live:
                todo.pop()
                continue
            arcs = self.shared(*at)
            unknown = [to for _, to in arcs if to not in self.live]
            if unknown:
                todo += unknown
                continue
            arcs = [(letter, to) for letter, to in arcs if self.live[to] is not None]
            self.live[at] = arcs if arcs or (self.of.final[at[0]] and self.of.final[at[1]]) else None
            todo.pop()
        return self.live[pair] is not None

    def common(self, pair: tuple[int, int], without: str = "") -> list[str]:
        """The words that both states accept, but for those that begin with the letter ``without``."""
        if not self.leads_on(pair):
            return []
        found = [""] if self.of.final[pair[0]] and self.of.final[pair[1]] else []
        todo = [(letter, to) for letter, to in self.live[pair] if letter != without]
        while todo:
            text, (p, q) = todo.pop()
            if self.of.final[p] and self.of.final[q]:
                found.append(text)
            todo += [(text + letter, to) for letter, to in self.live[(p, q)]]
        return found

    def edits(self, state: int) -> list[tuple[str, str]]:
        """The rests of all pairs of words that are edited right at ``state``."""
        found, arcs = [], list(self.of.arcs[state].items())
        for i, (x, p) in enumerate(arcs):
            for y, q in arcs[i + 1:]:
                found += [(x + rest, y + rest) for rest in self.common(_pair(p, q))]
            # an inserted letter equal to the next one is an edit further on
            found += [(rest, x + rest) for rest in self.common(_pair(state, p), without=x)]
        return found


def _pair(p: int, q: int) -> tuple[int, int]:
    return (p, q) if p <= q else (q, p)


def near_pairs(words: list[str]) -> list[tuple[str, str]]:
    """All pairs of different words one edit apart, once each. ``words`` are distinct and ascending."""
    if len(words) < 2:
        return []
    machine = Acceptor(words)
    composed = Composition(machine)
    # children have smaller numbers than parents
    edits = [composed.edits(state) for state in range(len(machine.arcs))]
    leads = []
    for state, arcs in enumerate(machine.arcs):
        leads.append(bool(edits[state]) or any(leads[to] for to in arcs.values()))
    found, todo = [], [("", machine.root)] if leads[machine.root] else []
    while todo:
        prefix, state = todo.pop()
        found += [(prefix + a, prefix + b) for a, b in edits[state]]
        todo += [(prefix + letter, to) for letter, to in machine.arcs[state].items() if leads[to]]
    return found


def _near_in_parts(parts: DataFrame, part_words: int) -> DataFrame:
    """``word, n_near, best`` from ``part, word, n``: pairs that share the prefix ``part``."""
    cells = max(partitions(parts.sparkSession), -(-parts.count() // part_words))

    def compose(table: pa.Table) -> pa.Table:
        parts: dict[str, list[str]] = {}
        n = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
        for word, part in zip(n, table.column("part").to_pylist()):
            parts.setdefault(part, []).append(word)
        near: Counter = Counter()
        best: dict[str, tuple[int, str]] = {}
        for part, words in parts.items():
            for a, b in near_pairs(sorted(word[len(part):] for word in words)):
                a, b = part + a, part + b
                near[a] += 1
                near[b] += 1
                best[a] = min(best.get(a, (0, "")), (-n[b], b))
                best[b] = min(best.get(b, (0, "")), (-n[a], a))
        struct = pa.StructArray.from_arrays([pa.array([best[w][0] for w in near], pa.int64()),
                                             pa.array([best[w][1] for w in near], pa.string())], ["less", "near"])
        return pa.table({"word": pa.array(list(near), pa.string()), "n_near": pa.array(near.values(), pa.int64()), "best": struct})

    return parts.groupBy(F.pmod(F.xxhash64("part"), F.lit(cells)).alias("cell")).applyInArrow(compose, NEAR)


NEAR = "word string, n_near long, best struct<less: long, near: string>"


# --- on the cluster ------------------------------------------------------------------------------------

def _edited_rows(words: DataFrame, low: int, high: int) -> DataFrame:
    """``at, rest, less, word, whole, last`` for every place ``low <= at < high`` where a word may be edited.

    A word stands under itself without the letter at the place, and whole under itself, where it meets the words that
    have one letter more there. ``last`` tells that a letter differs from the next one: only the last of equal letters
    counts as the inserted one.
    """
    at, word = F.col("at"), F.col("word")
    rows = words.select("word", (-F.col("n")).alias("less"), F.explode(F.sequence(
        F.lit(low), F.least(F.lit(high - 1), F.length("word")))).alias("at"))
    letter, after = F.substring(word, at + 1, F.lit(1)), F.substring(word, at + 2, F.lit(1))
    without = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    forms = F.array(F.struct(word.alias("rest"), F.lit(True).alias("whole"), F.lit(False).alias("last")),
                    F.struct(without.alias("rest"), F.lit(False).alias("whole"), (letter != after).alias("last")))
    rows = rows.select("at", "word", "less", F.explode(forms).alias("form")).select("at", "form.*", "less", "word")
    return rows.where(F.col("whole") | (at < F.length(word)))


def _near_by_edits(rows: DataFrame) -> DataFrame:
    """``word, n_near, best``: words under one key are near; there are at most as many as letters in the alphabet."""
    group = F.sort_array(F.collect_list(F.struct("less", "word", "whole", "last"))).alias("group")
    groups = rows.groupBy("at", "rest").agg(group).where(F.size("group") > 1)

    def meets(one: Column, other: Column) -> Column:
        replaced = ~one["whole"] & ~other["whole"]
        return (one["word"] != other["word"]) & (replaced | (one["whole"] & other["last"]) | (other["whole"] & one["last"]))

    each = groups.select(F.explode("group").alias("one"), "group")
    near = F.filter("group", lambda other: meets(F.col("one"), other))
    return each.select(F.col("one.word").alias("word"), near.alias("near")).where(F.size("near") > 0).select(
        "word", F.size("near").cast("long").alias("n_near"),
        F.struct(F.col("near")[0]["less"].alias("less"), F.col("near")[0]["word"].alias("near")).alias("best"))


def near_words(vocabulary: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``word, n_near, best`` for words of ``vocabulary(word, n)`` with near words; a word may have several rows, to be added up.

    ``best`` holds the near word of the largest ``n``, the first in code-point order of equal ones, under minus that ``n``.
    """
    # prefixes with many words get longer: none, then 1 letter, 2, 4, 8 ...
    if vocabulary.count() <= part_words:
        return _near_in_parts(vocabulary.select(F.lit("").alias("part"), "word", "n"), part_words)
    rest, depth, parts, edited = vocabulary, 1, None, _edited_rows(vocabulary, 0, 1)
    while True:
        part = F.substring("word", 1, depth)
        counts = rest.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("words"))
        crowded = F.col("words") > part_words
        placed, many = stage_counting(rest.select("word", "n", part.alias("part")).join(counts, "part"), crowded, "prefixes")
        done = placed.where(~crowded).select("part", "word", "n")
        parts = done if parts is None else parts.unionByName(done)
        if not many:
            break
        rest = placed.where(crowded).select("word", "n")
        edited = edited.unionByName(_edited_rows(rest, depth, 2 * depth))
        depth *= 2
    return _near_in_parts(parts, part_words).unionByName(_near_by_edits(edited))


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: where the forms lead in the end.

    Every form is more frequent by a constant factor, so chains are short; each round doubles the steps taken.
    """
    roots, moved = stage(forms.select("word", F.col("form").alias("root")), "roots"), 1
    while moved:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots, moved = stage_counting(roots.join(further, "root", "left"), F.col("next").isNotNull(), "roots")
        roots = roots.select("word", F.coalesce("next", "root").alias("root"))
    return roots


def variants(docs: DataFrame, more_often: int = MORE_OFTEN, least: int = LEAST_TIMES, part_words: int = PART_WORDS,
             damage: int = DAMAGE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs(doc_id, text)`` that occurs at least ``least`` times.

    ``n_near`` counts the words one edit away, ``form`` is the most frequent of them if it occurs ``more_often`` times as often as
    the word (ties: the first in code-point order), else null, and ``root`` where forms lead in the end, the word itself if it has
    none. Null texts have no words, equal rows count each, other columns are ignored, an empty table gives an empty result.
    See :func:`word_counts` for null doc_ids.
    """
    vocabulary = stage(word_counts(docs, damage).where(F.col("n") >= least), "vocabulary")
    none = F.lit(None).cast("struct<less: long, near: string>")
    found = near_words(vocabulary, part_words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best")
    every = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best")).unionByName(found)
    every = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    often = -F.col("best.less") >= more_often * F.col("n")
    words = stage(every.select("word", "n", "n_near", F.when(often, F.col("best.near")).alias("form"),
                               F.when(often, -F.col("best.less")).alias("form_n")), "words")
    roots = roots_of(words.where("form IS NOT NULL"))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query()
def op13_finite_state(spark: SparkSession, folder: str) -> DataFrame:
    """Near words, usual form and root of every word in the documents."""
    return variants(read(spark, folder, "documents"))
