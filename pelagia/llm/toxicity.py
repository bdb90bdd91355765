"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its hashed words. Its score is the logistic of a bias, a weight per term and the inner
products of the factors of all pairs of terms, so pairs count that a sum of weights can't see.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pelagia.llm.common import chunks, lowered, read, text_bytes, word_hashes, word_spans
from pelagia.llm.registry import query

TERM_BITS = 18
FACTORS = 8
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
# Text handled at once inside a task.
TEXT_BYTES = 1 << 20


def _term_bytes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


def document_terms(column: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and term of every distinct hashed word of each row, in that order."""
    data, bounds = text_bytes(column)
    starts, ends, first = word_spans(data, bounds, _term_bytes())
    term = (word_hashes(lowered()[data], starts, ends) >> np.uint64(64 - TERM_BITS)).astype(np.int64)
    row = np.repeat(np.arange(len(column), dtype=np.int64), np.diff(first))
    if known is not None:
        row, term = row[known[term]], term[known[term]]
    both = np.unique((row << TERM_BITS) | term)
    return both >> TERM_BITS, both & ((1 << TERM_BITS) - 1)


class FactorizationMachine:
    """Weights and factors of terms 0..n-1; features are present or absent.

    Factors begin near zero, where they are easily pulled to zero; those of the terms in ``paired`` begin large enough to stay.
    """

    def __init__(self, n: int, factors: int = FACTORS, seed: int = 1, paired: np.ndarray | None = None):
        self.bias = 0.0
        self.weights = np.zeros(n)
        self.factors = np.random.default_rng(seed).normal(0, 0.02, (n, factors))
        if paired is not None:
            self.factors[paired] *= 15

    def parts(self, term: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Raw score of each row, and the sums of its terms' factors."""
        chosen = self.factors[term]
        first = np.searchsorted(row, np.arange(rows))
        sums, squares = np.zeros((2, rows, chosen.shape[1]))
        full = np.flatnonzero(np.bincount(row, minlength=rows))
        if len(full):
            sums[full] = np.add.reduceat(chosen, first[full], axis=0)
            squares[full] = np.add.reduceat(chosen * chosen, first[full], axis=0)
        linear = np.bincount(row, self.weights[term], rows)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def fit(self, term: np.ndarray, first: np.ndarray, label: np.ndarray, epochs: int = 12, batch: int = 128,
            rate: float = 0.1, shrink: float = 5e-4, seed: int = 2) -> None:
        """Adaptive gradient steps on the logistic loss; ``shrink`` pulls weights and factors to exactly zero."""
        rng = np.random.default_rng(seed)
        seen_w, seen_v, seen_b = np.full(len(self.weights), 1e-8), np.full(self.factors.shape, 1e-8), 1e-8
        rows = len(label)
        for _ in range(epochs):
            order = rng.permutation(rows)
            for at in range(0, rows, batch):
                chosen = order[at:at + batch]
                count = first[chosen + 1] - first[chosen]
                inside = np.arange(count.sum()) + np.repeat(first[chosen] - (np.cumsum(count) - count), count)
                t, r = term[inside], np.repeat(np.arange(len(chosen)), count)
                raw, sums = self.parts(t, r, len(chosen))
                slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[chosen]) / len(chosen)
                seen_b += slope.sum() ** 2
                self.bias -= rate * slope.sum() / seen_b ** 0.5
                if not len(t):
                    continue
                by = np.argsort(t, kind="stable")
                used, begin = np.unique(t[by], return_index=True)
                dw = np.add.reduceat(slope[r[by]], begin)
                dv = np.add.reduceat(slope[r[by], None] * (sums[r[by]] - self.factors[t[by]]), begin, axis=0)
                seen_w[used] += dw * dw
                seen_v[used] += dv * dv
                step = rate / np.sqrt(seen_w[used])
                w = self.weights[used] - step * dw
                self.weights[used] = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0)
                step = rate / np.sqrt(seen_v[used])
                v = self.factors[used] - step * dv
                self.factors[used] = np.sign(v) * np.maximum(np.abs(v) - step * shrink, 0)
        raw, _ = self.parts(term, np.repeat(np.arange(rows), np.diff(first)), rows)
        for _ in range(30):  # the bias that makes the mean score the share of label 1
            p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            move = np.clip((label - p).sum() / max((p * (1 - p)).sum(), 1e-6), -1, 1)
            self.bias, raw = self.bias + move, raw + move


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS,
          least_documents: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, factors and bias over all terms, learned from at most ``sample_rows`` labelled documents.

    The sample is the labelled ids with the least hashes, the same at every run; of rows with one id one is used, an id
    with several labels counts as 1 if any is. Terms in fewer than ``least_documents`` sampled documents are left out.
    Null ids and labels are ignored. Without any labelled row the model is the constant 1/2. A term enters the machine if it says
    something by itself (:func:`informative`) or beside another one (:func:`in_pairs`); all others would fit noise.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id")
              .agg(F.max(F.col(label).cast("double")).alias("_label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))

    def terms(batches):
        for batch in chunks(batches, limit=TEXT_BYTES):
            row, term = document_terms(batch.column("text"))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32) * 4
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(cuts), pa.py_buffer(term.astype(np.int32).tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_label"), packed],
                                             ["doc_id", "_label", "terms"])

    # at most sample_rows ids are broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "_label", "text").mapInArrow(
        terms, "doc_id long, _label double, terms binary")
    table = sample.groupBy("doc_id").agg(F.min(F.struct("_label", "terms")).alias("row")).select(
        "doc_id", "row.*").toPandas().sort_values("doc_id")
    weights, factors = np.zeros(1 << TERM_BITS, np.float32), np.zeros((1 << TERM_BITS, FACTORS), np.float32)
    if not len(table):
        return weights, factors, 0.0
    lists = [np.frombuffer(t, np.int32) for t in table.terms]
    label_of = table["_label"].to_numpy(float)
    paired = in_pairs(lists, label_of, least_documents)
    kept = np.flatnonzero(informative(lists, label_of, least_documents) | paired)
    number = np.full(1 << TERM_BITS, -1)
    number[kept] = np.arange(len(kept))
    lists = [n[n >= 0] for n in (number[t] for t in lists)]
    machine = FactorizationMachine(len(kept), paired=paired[kept])
    machine.fit(np.concatenate(lists), np.concatenate([[0], np.cumsum([len(t) for t in lists])]),
                label_of)
    weights[kept], factors[kept] = machine.weights, machine.factors
    return weights, factors, machine.bias


def informative(lists: list[np.ndarray], label: np.ndarray, least_documents: int) -> np.ndarray:
    """Terms whose share of label 1 differs from the average by more than chance explains among that many terms.

    The bound is Bernstein's for the largest deviation over all terms, taken at 0.6 since terms may also matter in pairs.
    """
    n, p = len(label), label.mean()
    term = np.concatenate(lists)
    documents = np.bincount(term, minlength=1 << TERM_BITS)
    positive = np.bincount(term, np.repeat(label, [len(t) for t in lists]), 1 << TERM_BITS)
    terms = np.log(max((documents >= least_documents).sum(), 2))
    chance = np.sqrt(2 * terms * documents / n * p * (1 - p) / n) + terms / (3 * n)
    return (documents >= least_documents) & (np.abs(positive - p * documents) / n > 0.6 * chance)


def in_pairs(lists: list[np.ndarray], label: np.ndarray, least_documents: int) -> np.ndarray:
    """Terms of a pair whose share of label 1 is above the average and above that of either term, beyond chance among all pairs.

    So a term counts that says nothing by itself, but something beside another one. The bound is Bernstein's for the largest
    deviation over all pairs. Documents are bits of a term: those with label 1 rule out most pairs, the others are counted for the rest.
    """
    n, p = len(label), label.mean()
    term = np.concatenate(lists)
    documents = np.bincount(term, minlength=1 << TERM_BITS)
    positive = np.zeros(1 << TERM_BITS, np.int64)
    for i in np.flatnonzero(label):
        positive[lists[i]] += 1  # a document has a term once
    out = np.zeros(1 << TERM_BITS, bool)

    def beyond(k, count, share, chances):
        return k - share * count > np.sqrt(2 * chances * count * share * (1 - share)) + chances / 3

    # a pair has no more documents with label 1 than either term, and at least as many documents
    usable = np.flatnonzero(documents >= least_documents)
    chances = np.log(max(len(usable) * (len(usable) - 1) / 2, 2))
    usable = usable[beyond(positive[usable], positive[usable], np.maximum(p, positive[usable] / documents[usable]), chances)]
    if len(usable) < 2:
        return out
    share = np.maximum(p, positive[usable] / documents[usable])
    order = np.argsort(-label, kind="stable")  # documents with label 1 first
    place, ones = np.empty(n, np.int32), int(label.sum())
    split = -(-ones // 64)  # documents with label 0 begin in a word of their own
    place[order] = np.where(np.arange(n) < ones, np.arange(n), np.arange(n) - ones + split * 64)
    number = np.full(1 << TERM_BITS, -1, np.int32)
    number[usable] = np.arange(len(usable))
    term = number[term]
    at = np.repeat(place, [len(t) for t in lists])[term >= 0]
    term = term[term >= 0]
    bits = np.zeros((len(usable), split + -(-(n - ones) // 64)), np.uint64)
    np.bitwise_or.at(bits, (term, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    found = np.zeros(len(usable), bool)
    for i in range(len(usable) - 1):
        k = np.bitwise_count(bits[i, :split] & bits[i + 1:, :split]).sum(axis=1, dtype=np.int64)
        q = np.maximum(share[i], share[i + 1:])
        others = np.flatnonzero(beyond(k, k, q, chances))
        if len(others):
            rest = np.bitwise_count(bits[i, split:] & bits[i + 1 + others, split:]).sum(axis=1, dtype=np.int64)
            good = others[beyond(k[others], k[others] + rest, q[others], chances)]
            found[i] |= len(good) > 0
            found[i + 1 + good] = True
    out[usable[found]] = True
    return out


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = THRESHOLD,
          carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, carried columns, score, predicted`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have no terms and get the score of the bias alone. Equal texts score alike; an empty table
    gives an empty result. The broadcast model has a fixed size.
    """
    carry = {"doc_id": F.col("doc_id"), **(carry or {})}
    names = list(carry)
    docs = docs.select(F.struct(*[c.alias(n) for n, c in carry.items()]).alias("carried"), "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema["carried"].dataType)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        machine, known = _machine(shared.value)
        for batch in chunks(batches, limit=TEXT_BYTES):
            p = _probability(machine, known, batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.column("carried").flatten(), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             [*names, "score", "predicted"])

    return docs.mapInArrow(apply, f"{fields}, score double, predicted int")


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns.

    A model that has learned nothing of any term scores all rows alike, and all of them stay.
    """
    if not _machine(model)[1].any():
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        machine, known = _machine(shared.value)
        for batch in chunks(batches, limit=TEXT_BYTES):
            yield batch.filter(pa.array(_probability(machine, known, batch.column("text")) < threshold))

    return docs.mapInArrow(apply, docs.schema)


def _machine(model: tuple[np.ndarray, np.ndarray, float]) -> tuple[FactorizationMachine, np.ndarray]:
    """The machine of a model, and which terms it knows."""
    machine = FactorizationMachine(0)
    machine.weights, machine.factors, machine.bias = model
    return machine, (model[0] != 0) | (model[1] != 0).any(axis=1)


def _probability(machine: FactorizationMachine, known: np.ndarray, text: pa.Array) -> np.ndarray:
    row, term = document_terms(text, known)
    return 1 / (1 + np.exp(-np.clip(machine.parts(term, row, len(text))[0], -30, 30)))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


@query()
def op2_factorization_machine(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from three quarters of the labels."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return score(docs, train(docs, labels.where(~held_out())), carry={"held_out": held_out()})
