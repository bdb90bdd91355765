"""Delimited text whose quoted fields hold line breaks, read by many tasks.

A line of such a file may begin inside a field, which only the quotes before it tell. So each range of bytes is first read for
what it does to that state, from either state it may begin in: inside a field or outside. Chained along a file these say how every
range begins. The lines of a range are then put together to records in a second pass; the pieces of a record that
runs over the end of its range meet in a small shuffle.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pelagia.runtime import fits_broadcast, stage

PIECES = "file string, start long, place int, text string, opens boolean, closes boolean"
# Records handed over at once.
BATCH_ROWS = 4096


def ends_inside(line: str, inside: bool, sep: str, quote: str = '"') -> bool:
    """Whether a line, begun inside a quoted field or not, ends inside one. A field is quoted if it begins with a quote."""
    if quote not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if not line.startswith(quote, at):
                found = line.find(sep + quote, at)
                if found < 0:
                    return False
                at = found + len(sep)
            at += 1
        # the next quote that isn't doubled ends the field
        while True:
            at = line.find(quote, at)
            if at < 0:
                return True
            if not line.startswith(quote, at + 1):
                break
            at += 2
        inside = False
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, value``: lines with the range of bytes that they were read in; ranges are read in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _ranges(lines: DataFrame, sep: str) -> DataFrame:
    """``file, start``: the ranges that begin inside a quoted field."""
    def run(batches):
        now, states, out = None, [False, True], []
        for batch in batches:
            for file, start, value in zip(batch["file"], batch["start"], batch["value"]):
                if (file, start) != now:
                    if now is not None:
                        out.append((*now, *states))
                    now, states = (file, start), [False, True]
                if '"' in value:
                    states = [ends_inside(value, state, sep) for state in states]
        if now is not None:
            out.append((*now, *states))
        yield pd.DataFrame(out, columns=["file", "start", "after_outside", "after_inside"])

    effects = stage(lines.mapInPandas(run, "file string, start long, after_outside boolean, after_inside boolean"), "ranges")
    # a row per range: the state before it follows from the last range whose end doesn't depend on its beginning
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("after_outside") == F.col("after_inside")
    settled = F.last(F.when(same, F.struct(F.col("start").alias("at"), F.col("after_outside").alias("state"))), ignorenulls=True).over(before)
    turns = F.when(~same & F.col("after_outside"), 1).otherwise(0)  # outside becomes inside and the other way round
    turned = F.sum(turns).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    rows = effects.select("file", "start", settled.alias("settled"), F.coalesce(turned, F.lit(0)).alias("turned"))
    marks = rows.select("file", F.col("start").alias("at"), F.col("turned").alias("turned_at"))
    rows = rows.withColumn("at", F.col("settled.at")).join(marks, ["file", "at"], "left")
    turned = F.pmod(F.col("turned") - F.coalesce("turned_at", F.lit(0)), F.lit(2)) == 1
    return rows.where(F.coalesce("settled.state", F.lit(False)) != turned).select("file", "start")


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``file, first, text``: the records of all files as texts; ``first`` marks the first one of each file.

    The order of records isn't kept, and a last record whose quote is never closed ends with its file.
    """
    lines = _lines(spark, path)
    inside = stage(_ranges(lines, sep), "inside").withColumn("inside", F.lit(True))
    if fits_broadcast(inside):
        marked = lines.join(F.broadcast(inside), ["file", "start"], "left")
    else:  # ranges of too many files begin in a field: bring each range's lines to one task, in their order
        keyed = lines.withColumn("line", F.monotonically_increasing_id()).join(inside, ["file", "start"], "left")
        marked = keyed.repartition("file", "start").sortWithinPartitions("file", "start", "line").drop("line")

    def assemble(batches):
        """Records of every range, and the pieces at its ends: ``opens`` a record, or ``closes`` one that was open."""
        now, state, held, begun, place, out = None, False, [], False, 0, []

        def table():
            nonlocal out
            rows, out = out, []
            return pa.RecordBatch.from_pylist(rows, schema=kind)

        def finish():
            if held:  # what is still open at the end of the range
                out.append({"file": now[0], "start": now[1], "place": place, "text": "\n".join(held), "opens": begun, "closes": False})

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "start", "value", "inside")]
            for file, start, value, begins in zip(*columns):
                if (file, start) != now:
                    if now is not None:
                        finish()
                    now, state, held, begun, place = (file, start), bool(begins), [], not begins, 0
                held.append(value)
                state = ends_inside(value, state, sep)
                if not state:
                    text = held[0] if len(held) == 1 else "\n".join(held)
                    out.append({"file": file, "start": start, "place": place, "text": text.removesuffix("\r"), "opens": begun, "closes": True})
                    held, begun, place = [], True, place + 1
                if len(out) >= BATCH_ROWS:
                    yield table()
        if now is not None:
            finish()
        yield table()

    kind = pa.schema([("file", pa.string()), ("start", pa.int64()), ("place", pa.int32()), ("text", pa.string()),
                      ("opens", pa.bool_()), ("closes", pa.bool_())])
    pieces = stage(marked.select("file", "start", "value", "inside").mapInArrow(assemble, PIECES), "records")
    whole = pieces.where("opens AND closes").select("file", ((F.col("start") == 0) & (F.col("place") == 0)).alias("first"), "text")
    # a record in pieces is named by the range where it was opened
    cut = pieces.where("NOT (opens AND closes)")
    opened = F.max(F.when(F.col("opens"), F.col("start"))).over(Window.partitionBy("file").orderBy("start", "place"))
    cut = cut.withColumn("opened", opened).groupBy("file", "opened").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("parts"))
    joined = cut.select("file", ((F.col("opened") == 0) & (F.col("parts")[0]["place"] == 0)).alias("first"),
                        F.regexp_replace(F.array_join("parts.text", "\n"), r"\r\z", "").alias("text"))
    return whole.unionByName(joined)


def _names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names; Spark reads the first record of one file for them."""
    return spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", True).csv(path).columns


def read_quoted(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """All columns as text; see :func:`records`. Blank lines are no rows, missing fields are null."""
    names = _names(spark, path, sep)
    cells = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records(spark, path, sep).where(~F.col("first") & (F.trim("text") != ""))
    parsed: Column = F.from_csv("text", cells, {"sep": sep, "escape": '"', "quote": '"'})
    return rows.select(parsed.alias("row")).select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(names)])
