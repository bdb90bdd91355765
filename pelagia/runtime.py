"""Session-level helpers: shared scratch tables, size-checked broadcasts and joins that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# A side is broadcast only when its files are known to be at most this large …
BROADCAST_BYTES = 4 << 20
# … or after it was read and found to have at most this many rows, whose values take at most this much memory.
BROADCAST_ROWS = 200_000
BROADCAST_MEMORY = 64 << 20
# A join key with more rows than this is split into several tasks.
HOT_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder for scratch tables, taken from the session.

    ``spark.checkpoint.dir`` names a folder every executor can reach. A local session without it (as in
    tests) gets a temporary folder; a cluster session without it is an error, since a machine-local folder
    would be lost with its machine.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="pelagia-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this process has written; results that still read them must be saved first."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, name: str = "table", rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy cuts the lineage, survives the loss of executors and has a known size, so Spark picks the
    join strategy of whatever reads it from real numbers. Files are buffered and decoded by row group, of at most
    ``rows`` rows if given: else a group can take 100 rows or more, however large they are.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write if rows is None else df.write.option("parquet.block.row.count.limit", rows)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counting(df: DataFrame, condition: Column, name: str = "table") -> tuple[DataFrame, int]:
    """:func:`stage`, and the number of rows meeting ``condition``, counted while they are written."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count_if(condition).alias("rows")), name)
    return staged, int(seen.get["rows"] or 0)


def planned_bytes(df: DataFrame) -> int:
    """Size Spark's planner puts on ``df``: file sizes for tables, never less than that for joins of them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _multiplies_rows(df: DataFrame) -> bool:
    """Whether the plan has a step that makes several rows of one, which the planner's sizes leave out."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(step in plan for step in ("Generate ", "Expand ", "MapInPandas", "MapInArrow", "FlatMapGroups"))


def is_small(df: DataFrame) -> bool:
    return planned_bytes(df) <= BROADCAST_BYTES and not _multiplies_rows(df)


def _value_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: texts and nested values by their length, others by a fixed width."""
    size = F.lit(16)
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(value), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0))
        size = size + 8
    return size.cast("bigint")


def fits_broadcast(df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``df`` has few enough rows, and these are small enough, to be sent to every task."""
    rows = BROADCAST_ROWS if rows is None else rows
    held = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_value_bytes(df)), F.lit(0)).alias("bytes")).first()
    return held["rows"] <= rows and held["bytes"] <= BROADCAST_MEMORY


def attach(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
           broadcast_rows: int | None = None, hot_rows: int | None = None,
           left_counts: DataFrame | None = None) -> DataFrame:
    """Join a lookup table: broadcast when it is known to be small, otherwise a join that splits hot keys.

    The size is taken from the planner when ``right`` rests on small files. If that does not settle it,
    ``right`` is written once, and its rows and their bytes are counted. ``left_counts(keys…, n)``, when the caller has it,
    saves counting the keys of ``left``.
    """
    if broadcast_rows is None and is_small(right):
        return _left_first(left, left.join(F.broadcast(right), keys, how))
    right = stage(right, "lookup")
    if fits_broadcast(right, broadcast_rows):
        return _left_first(left, left.join(F.broadcast(right), keys, how))
    left_parts = None if left_counts is None else parts_of_counts(left_counts, keys, hot_rows)
    return skew_join(left, right, keys, how, hot_rows, left_parts=left_parts)


def _left_first(left: DataFrame, joined: DataFrame) -> DataFrame:
    """The columns of ``left`` in their order, then the added ones."""
    added = [c for c in joined.columns if c not in left.columns]
    return joined.select(*[F.col(f"`{c}`") for c in (*left.columns, *added)])


def hot_parts(df: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    """``(keys…, parts)`` for the keys of ``df`` with more than ``hot_rows`` rows; the null key counts too.

    Rows are counted per key inside each map task first. The table has at most rows / ``hot_rows`` rows; if
    that is still too many to broadcast, the limit is raised.
    """
    return parts_of_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, hot_rows)


def parts_of_counts(counts: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = stage(counts.where(F.col("n") > hot_rows).select(*keys, "n"), "hot")
    while not is_small(hot) and not fits_broadcast(hot):
        hot_rows *= 4
        hot = hot.where(F.col("n") > hot_rows)
    return hot.select(*keys, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("parts"))


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def _with_parts(df: DataFrame, parts: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Add the number of parts of each row's key, 1 unless it is hot."""
    named = parts.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], F.col("parts").alias("_parts"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_hot_{i}"))
    return (df.join(F.broadcast(named), same, "left").withColumn(out, F.coalesce("_parts", F.lit(1)))
            .drop("_parts", *[f"_hot_{i}" for i in range(len(keys))]))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hot_rows: int | None = None,
              left_parts: DataFrame | None = None, right_parts: DataFrame | None = None) -> DataFrame:
    """Equi-join in which a key with very many rows on either side is spread over many tasks.

    Keys above ``hot_rows`` are counted first (a pre-aggregated count per key) unless the caller passes their
    parts. Without any, this is a plain join. Otherwise rows of a hot key get a part number on their own side
    and are copied once per part of the other side, so every matching pair still meets exactly once.
    Supports ``inner``, ``left``, ``left_semi`` and ``left_anti``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    exists_only = how in ("left_semi", "left_anti")
    right = right.where(_all_present(keys))
    if exists_only:
        right = right.select(*keys).distinct()
    if left_parts is None:
        left_parts = hot_parts(left, keys, hot_rows)
    if right_parts is None and not exists_only:
        right_parts = hot_parts(right, keys, hot_rows)
    left_hot = not left_parts.isEmpty()
    right_hot = right_parts is not None and not right_parts.isEmpty()
    if not left_hot and not right_hot:
        return _left_first(left, left.join(right, keys, how))

    def counted(df: DataFrame) -> DataFrame:
        df = _with_parts(df, left_parts, keys, "_lparts") if left_hot else df.withColumn("_lparts", F.lit(1))
        return _with_parts(df, right_parts, keys, "_rparts") if right_hot else df.withColumn("_rparts", F.lit(1))

    def part(cols: list[str], parts: str) -> Column:
        # the input partition is part of the hash, so exact copies of one row are spread as well
        return F.pmod(F.xxhash64(*cols, F.spark_partition_id()), F.col(parts)).cast("int")

    def copies(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    lefts = (counted(left).withColumn("_lpart", part(left.columns, "_lparts"))
             .withColumn("_rpart", copies("_rparts")).drop("_lparts"))
    rights = (counted(right).withColumn("_rpart", part(right.columns, "_rparts"))
              .withColumn("_lpart", copies("_lparts")).drop("_lparts", "_rparts"))
    on = [*keys, "_lpart", "_rpart"]
    if how == "left" and right_hot:
        joined = lefts.join(rights.withColumn("_hit", F.lit(True)), on, "left")
        # a copied left row belongs to a key that exists on the right: its unmatched copies are artefacts
        joined = joined.where((F.col("_rparts") == 1) | F.col("_hit").isNotNull()).drop("_hit")
    else:
        joined = lefts.join(rights, on, how)
    return _left_first(left, joined.drop("_lpart", "_rpart", "_rparts"))


# Size of a range partition, and the most partitions a range shuffle is given.
PARTITION_BYTES = 128 << 20
MAX_PARTITIONS = 50_000


def spread_partitions(df: DataFrame) -> int:
    """Partitions for a range shuffle of ``df``: the session's number, more when its size asks for it."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, min(planned_bytes(df) // PARTITION_BYTES, MAX_PARTITIONS))
