"""Delimited text in and out."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pelagia.runtime import stage
from pelagia.sources.quoted import read_quoted

# Texts that mean "missing" to the usual data-frame readers.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

DELIMITERS = "\t,;|"


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Delimiter of the header line; tab when it cannot be told. Only that line reaches the driver."""
    line = spark.read.text(path).limit(1).collect()
    try:
        return csv.Sniffer().sniff(line[0][0], DELIMITERS).delimiter
    except (csv.Error, IndexError, TypeError):
        return "\t"


def normalize_nulls(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Missing-value texts to null in string columns, NaN to null in floating columns."""
    tokens = MISSING_TOKENS if tokens is None else tokens
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(tokens), c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types; unreadable text becomes null, absent columns are null."""
    return df.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema.fields])


# What the text of each type looks like, from the narrowest type on; a cast alone would also read "y" or "1d".
TYPE_PATTERNS = {
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false|True|False|TRUE|FALSE)$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$",
}


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns to the narrowest of long, double, boolean, timestamp whose pattern and range fit every value."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    kinds = list(TYPE_PATTERNS)
    tests = [F.count_if(F.col(f"`{c}`").isNotNull() & ~(F.col(f"`{c}`").rlike(TYPE_PATTERNS[k])
                                                      & F.col(f"`{c}`").try_cast(k).isNotNull())).alias(f"{i}_{k}")
             for i, c in enumerate(text) for k in kinds]
    if not tests:
        return df
    failures = df.agg(*tests, *[F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(text)]).first()

    def typed(i: int, c: str):
        fits = [k for k in kinds if failures[f"{i}_{k}"] == 0 and failures[f"{i}_n"] > 0]
        return F.col(f"`{c}`").try_cast(fits[0]) if fits else F.col(f"`{c}`")

    return df.withColumns({c: typed(i, c) for i, c in enumerate(text)})


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", infer: bool = False,
                   schema: T.StructType | str | None = None, null_tokens: list[str] | None = None,
                   multi_line: bool = False) -> DataFrame:
    """Table with a header line.

    ``multi_line`` reads line breaks inside quotes, by many tasks as well; it takes two passes over the text, so leave it off for
    files that have none.

    All columns are text unless ``schema`` (preferred: no extra pass) or ``infer`` says otherwise.
    ``sep="auto"`` looks at the header line. ``null_tokens`` turns missing-value texts into null first.
    """
    if sep == "auto":
        sep = sniff_delimiter(spark, path)
    if multi_line:
        text = read_quoted(spark, path, sep)
    else:
        text = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    if null_tokens is not None:
        text = normalize_nulls(text, null_tokens)
    if schema is not None:
        return cast_to(text, T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    return infer_types(text) if infer else text


def write_delimited(df: DataFrame, path: str, sep: str = ",", single_file: bool = False,
                    mode: str = "errorifexists") -> None:
    """Delimited text with a header, written in parallel; one file only on request."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("encoding", "UTF-8").csv(path))


def convert_delimited(spark: SparkSession, src: str, dst: str, mode: str = "errorifexists") -> None:
    """Text with any delimiter to UTF-8 CSV."""
    write_delimited(read_delimited(spark, src, sep="auto"), dst, mode=mode)


def write_cluster_outputs(labelled: DataFrame, stats: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Rows with their labels, and the statistics per cluster."""
    write_delimited(labelled, f"{folder}/clusters", mode=mode)
    write_delimited(stats, f"{folder}/cluster_stats", mode=mode)


def write_distributions_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, arrays kept as arrays."""
    df.write.mode(mode).json(path)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows once and for all: the ids are written, so later reads all see the same ones."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
