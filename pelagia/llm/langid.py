"""Language proportions of documents by expectation-maximisation over n-gram likelihoods.

Letters are lower-cased (ASCII), everything else is a space, and hashed byte trigrams are counted per language. A
document is cut into segments; its languages are a mixture whose proportions are estimated by
expectation-maximisation from the segments' likelihoods. Languages leave the mixture one by one, least proportion
first, and the set with the best penalised likelihood is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pelagia.llm.common import chunks, read, text_bytes
from pelagia.llm.registry import query

BUCKET_BITS = 17
SEGMENT_BYTES = 64
ROUNDS = 8
MAX_LANGUAGES = 256


def _letters() -> np.ndarray:
    table = np.full(256, 0x20, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each byte, and which of them lie within a row and hold a letter."""
    d = _letters()[data].astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    use = code != 0x202020
    for back in (1, 2):
        cut = bounds[1:] - back
        use[cut[(cut >= 0) & (cut < len(use))]] = False
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS), use


class LanguageModel:
    """Log likelihood of every trigram bucket in every language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        counts = counts.astype(np.float64) + 0.05
        self.log = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def train(docs: DataFrame) -> LanguageModel:
    """Model of ``docs(text, lang)``; rows with a null text or lang teach nothing.

    All rows count. Each task adds up its own rows, and at most 2**17 numbers per language reach the driver.
    """
    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in chunks(batches):
            data, bounds = text_bytes(batch.column("text"))
            bucket, use = trigrams(data, bounds)
            lang = batch.column("lang").dictionary_encode()
            row = np.repeat(lang.indices.to_numpy(), np.diff(bounds))[:len(use)]
            for i, name in enumerate(lang.dictionary.to_pylist()):
                n = np.bincount(bucket[use & (row == i)], minlength=1 << BUCKET_BITS)
                found[name] = found[name] + n if name in found else n
        for name, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                                             ["lang", "bucket", "n"])

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    known = docs.where("lang is not null").select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if known > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the table of the model is bounded by that number")
    table = counts.toPandas()
    languages = sorted(table.lang.unique())
    dense = np.zeros((len(languages), 1 << BUCKET_BITS))
    dense[pd.Categorical(table.lang, languages).codes, table.bucket.to_numpy()] = table.n.to_numpy()
    return LanguageModel(languages, dense)


def mixture(likelihood: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (rows x languages) of the best language set of every row.

    ``likelihood`` has the log likelihood of each segment in each language; the segments of row *i* begin at
    ``first[i]``. Every row has at least one segment.
    """
    rows, languages = len(first) - 1, likelihood.shape[1]
    row = np.repeat(np.arange(rows), np.diff(first))
    n = np.diff(first)[:, None]
    top = likelihood.max(axis=1)
    scaled = np.exp(likelihood - top[:, None])
    base = np.add.reduceat(top, first[:-1])
    allowed = np.ones((rows, languages), bool)
    best, best_score = np.zeros((rows, languages)), np.full(rows, -np.inf)
    while True:
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            weight = scaled * share[row] + 1e-300
            weight /= weight.sum(axis=1, keepdims=True)
            share = np.where(allowed, np.add.reduceat(weight, first[:-1], axis=0) / n, 0)
            share /= share.sum(axis=1, keepdims=True)
        score = base + np.add.reduceat(np.log((scaled * share[row]).sum(axis=1) + 1e-300), first[:-1])
        score -= allowed.sum(axis=1) * np.log(n[:, 0] + 1.0)
        better = score > best_score
        best[better], best_score[better] = share[better], score[better]
        if allowed.sum(axis=1).max() <= 1:
            return best, best_score
        # the least language leaves, and with it all that have practically nothing
        worst = np.where(allowed, share, np.inf).argmin(axis=1)
        keep = allowed & (share >= 1e-3)
        keep[np.arange(rows), worst] = False
        last = allowed.sum(axis=1) <= 1
        keep[last] = allowed[last]
        none = ~keep.any(axis=1)
        keep[none, share[none].argmax(axis=1)] = True
        allowed = keep


def predict(docs: DataFrame, model: LanguageModel, carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score, proportions`` of every row of ``docs(doc_id, text)``.

    ``lang_pred`` is the language with the greatest proportion and ``score`` that proportion. A null text or one
    without a letter, and every text if nothing was learned, is ``und`` with score 0. A text too short for a trigram
    has equal proportions and the first language. Repeated rows are predicted alike, an empty table gives no rows.
    """
    carry = carry or {}
    docs = docs.select("doc_id", *[c.alias(n) for n, c in carry.items()],
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"), "text")
    names = ["doc_id", *carry]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log))

    def apply(batches):
        languages, log = shared.value
        for batch in chunks(batches):
            data, bounds = text_bytes(batch.column("text"))
            bucket, use = trigrams(data, bounds)
            many = np.maximum(-(-np.diff(bounds) // SEGMENT_BYTES), 1)
            first = np.concatenate([[0], np.cumsum(many)])
            at = np.arange(len(bucket))
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))[:len(bucket)]
            segment = first[row] + (at - bounds[row]) // SEGMENT_BYTES
            likelihood = np.stack([np.bincount(segment[use], line[bucket[use]], first[-1]) for line in log], axis=1) \
                if languages else np.zeros((first[-1], 1))
            share, _ = mixture(likelihood, first)
            best = share.argmax(axis=1)
            known = batch.column("_letters").to_numpy(zero_copy_only=False) & bool(languages)
            label = np.where(known, np.array(languages or ["und"], object)[best], "und")
            score = np.where(known, share[np.arange(len(best)), best], 0.0)
            maps = [list(zip(languages, p)) if k else [] for k, p in zip(known, share.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(label, pa.string()), pa.array(np.clip(score, 0, 1)),
                 pa.array(maps, pa.map_(pa.string(), pa.float64()))], [*names, "lang_pred", "score", "proportions"])

    return docs.mapInArrow(apply, f"{fields}, lang_pred string, score double, proportions map<string,double>")


@query()
def op4_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = read(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    model = train(docs.where(~held_out))
    return predict(docs, model, {"held_out": held_out}).drop("proportions")
