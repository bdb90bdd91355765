import pytest
from conftest import rows
from pyspark.sql import functions as F

from pelagia import runtime
from pelagia.operators import joins
from pelagia.plans import taxon


@pytest.fixture
def skewed(spark):
    left = spark.createDataFrame(
        [(1, f"l{i}") for i in range(20)] + [(2, "m")] * 9 + [(3, "n"), (4, "o")] + [(None, "p")] * 8, "k int, a string")
    right = spark.createDataFrame(
        [(1, f"r{i}") for i in range(7)] + [(2, "copy")] * 6 + [(3, "s"), (9, "t"), (None, "u")], "k int, b string")
    return left.repartition(3), right.repartition(3)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [2, 5, 1000])
def test_skew_join_equals_plain_join(skewed, how, hot_rows):
    left, right = skewed
    assert rows(runtime.skew_join(left, right, ["k"], how, hot_rows)) == rows(left.join(right, ["k"], how))


def test_skew_join_spreads_a_hot_key(skewed):
    left, right = skewed
    plan = runtime.skew_join(left, right, ["k"], "inner", 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "_lpart" in plan and "_rpart" in plan


def test_attach_without_broadcast(skewed):
    left, right = skewed
    table = right.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        expected = rows(left.join(table, ["k"], how))
        assert rows(runtime.attach(left, table, ["k"], how, broadcast_rows=1, hot_rows=4)) == expected
        counts = left.groupBy("k").agg(F.count("*").alias("n"))
        assert rows(runtime.attach(left, table, ["k"], how, broadcast_rows=1, hot_rows=4, left_counts=counts)) == expected


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_left_join_chain(spark, hot_rows):
    base = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], "taxonID string, name string")
    names = spark.createDataFrame([("1", "x"), ("1", "y"), ("9", "z")], "taxonID string, name string")
    places = spark.createDataFrame([("1", "NA"), ("1", "SE"), ("2", "NO")], "taxonID string, code string")
    nothing = spark.createDataFrame([], "taxonID string, flag int")
    out = joins.left_join_chain(base, [(names, "_vern"), (nothing, "_none"), (places, "_dist")], "taxonID", hot_rows)
    assert out.columns == ["taxonID", "name", "name_vern", "code"]
    assert rows(out) == sorted([("1", "A", n, c) for n in "xy" for c in ("NA", "SE")]
                               + [("2", "B", None, "NO"), ("3", "C", None, None)], key=repr)


def test_join_one_per_key(spark):
    a = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c")], "taxonID string, name string")
    b = spark.createDataFrame([("1", 4), ("1", 3), ("3", 5)], "taxonID string, cluster int")
    assert rows(joins.join_one_per_key(a, b, "taxonID")) == [("1", "a", 3)]


def test_lookup_and_groups(spark):
    df = spark.createDataFrame([(0,), (1,), (7,)], "cluster int")
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "cluster int, name string")
    assert rows(joins.lookup(df, names, "cluster")) == [(0, "zero"), (1, "one"), (7, None)]
    assert rows(joins.restrict_to_groups(df, names, "cluster")) == [(0,), (1,)]
    long = joins.match_groups(
        spark.createDataFrame([(1, "a", "x"), (2, "a", ""), (3, None, "x")], "id int, family string, genus string"),
        spark.createDataFrame([("genus", "x"), ("family", "q")], "taxonomic_level string, taxonomic_group string"),
        ["family", "genus"], ["id"])
    assert rows(long.select("id", "taxonomic_level", "taxonomic_group")) == [(1, "genus", "x"), (3, "genus", "x")]


def test_taxon_table(spark):
    taxa = spark.createDataFrame(
        [("1", "Gadus", "Animalia"), ("1", "Gadus", "Animalia"), (None, "x", "y"), ("2", None, "y"), ("3", "Salmo", None)],
        " taxonID string, scientificName string, kingdom string".replace(" taxonID", "taxonID"))
    taxa = taxa.withColumnRenamed("taxonID", " taxonID ")
    names = spark.createDataFrame([("1", "cod", "ENG"), ("1", "torsk", "NOB")], "taxonID string, vernacularName string, language string")
    profile = spark.createDataFrame([("1", "1", "0"), ("3", "1", None)], "taxonID string, isMarine string, isBrackish string")
    places = spark.createDataFrame([("1", "Oslo", "NO"), (None, "x", "y")], "taxonID string, locality string, countryCode string")
    out = taxon.build_taxon_table(taxa, names, profile, places)
    assert out.columns == ["taxonID", "scientificName", "kingdom", "vernacularName", "language", "isMarine", "isBrackish",
                           "locality", "countryCode"]
    assert rows(out) == [("1", "Gadus", "Animalia", "cod", "ENG", "1", "0", "Oslo", "NO"),
                         ("3", "Salmo", None, None, None, None, None, None, None)]
