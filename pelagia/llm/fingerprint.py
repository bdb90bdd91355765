"""Bottom-k sketches of shingle hashes (built-in functions only).

A sketch is the ``K`` smallest distinct hashes of the shingles of five words of a text (a shorter text is one shingle,
a text without words has none). Sketches of parts merge into the sketch of the whole, and estimate the resemblance
and containment of two texts and their number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pelagia.llm.common import partitions, read, with_id, without_id
from pelagia.llm.registry import query

K = 128
SHINGLE_WORDS = 5
_SPAN = 2.0**64


def sketch(text: Column, k: int = K, words: int = SHINGLE_WORDS) -> Column:
    """``array<long>``: the least ``k`` distinct shingle hashes in order; empty for null or wordless text."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(parts, lambda w: F.xxhash64(w))
    # the hashes are named once by a one-element array, so that they are computed once for all shingles
    shingles = F.transform(F.array(hashes), lambda h: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(h) - (words - 1), F.least(F.size(h), F.lit(1)))),
        lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(words)])))
    least = F.slice(F.sort_array(F.array_distinct(F.element_at(shingles, 1))), 1, k)
    return F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"), least).otherwise(
        F.array().cast("array<long>"))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(table: DataFrame, key: str, sketches: str, k: int = K) -> DataFrame:
    """``key, sketches``: the sketch of all rows of each key. Every task keeps only the ``k`` least of a key first."""
    rows = table.select(key, F.explode(sketches).alias("_hash")).distinct()
    order = Window.partitionBy(key).orderBy("_hash")
    least = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    return least.groupBy(key).agg(F.sort_array(F.collect_list("_hash")).alias(sketches))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of both; 1 for two texts without words."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the position of the k-th hash."""
    place = (F.element_at(a, -1).cast("double") + _SPAN / 2) / _SPAN
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 if ``a`` has none."""
    shared = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    """Fixed text of a sketch: its hashes as 16 hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def bucket_of(column: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``column``, by halving."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(int(b)) for b in bounds])
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(held, at + step - 1) <= column), at + step).otherwise(at))


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``doc_id, text, next_text, …`` rows in descending doc_id order cut into ranges, each with a last row of the next range.

    Returns ``doc_id, text, _range, _tail``: rows with ``_tail`` are the first row of the following range (of the
    first range after the last) and only serve as neighbour of the last row of a range.
    """
    parts = parts or 4 * partitions(docs.sparkSession)
    bounds = docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    docs = docs.withColumn("_range", -bucket_of(F.col("doc_id"), sorted(set(bounds))))
    # of rows with one doc_id the first in the order of texts leads
    heads = docs.groupBy("_range").agg(F.min(F.struct(-F.col("doc_id"), F.col("text"))).alias("_head"))
    line = Window.orderBy("_range")  # a row for each range
    heads = heads.withColumn("_before", F.coalesce(F.lag("_range").over(line), F.max("_range").over(
        Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    tails = heads.select((-F.col("_head.col1")).alias("doc_id"), F.col("_head.text").alias("text"),
                         F.col("_before").alias("_range"), F.lit(True).alias("_tail"))
    return docs.withColumn("_tail", F.lit(False)).unionByName(tails)


def edited_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document with an edited text and the sketches of both: ``doc_id, text, edited, sketch, edited_sketch, next_sketch``.

    The edited text keeps the first half of the code points and takes the rest from the beginning of the next
    document in descending doc_id order, the first following the last. ``docs(doc_id, text)``, other columns are
    ignored; null text is empty; a null doc_id comes first; rows with one doc_id follow in the order of their texts;
    a single document is its own next one; an empty table gives an empty result.
    """
    rows = with_next(docs.select(with_id(), F.coalesce("text", F.lit("")).alias("text")))
    line = Window.partitionBy("_range").orderBy("_tail", F.desc("doc_id"), "text")
    rows = rows.withColumn("_next", F.lead("text").over(line))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("_next", F.lit(1), half))
    rows = rows.withColumn("edited", F.when(F.col("_tail"), F.lit("")).otherwise(edited))
    rows = rows.withColumn("sketch", sketch(F.col("text"), k)).withColumn("edited_sketch", sketch(F.col("edited"), k))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(line)).where(~F.col("_tail"))
    return rows.select(without_id(), "text", "edited", "sketch", "edited_sketch", "next_sketch")


@query()
def op6_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    rows = edited_documents(read(spark, folder, "documents"))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
