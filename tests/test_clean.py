import pytest
from conftest import rows
from pyspark.sql import functions as F

from pelagia.operators import clean
from pelagia.plans import taxon


def test_names_and_selection(spark):
    df = spark.createDataFrame([("1", "a")], [" taxonID ", "genus"])
    named = clean.strip_column_names(df)
    assert named.columns == ["taxonID", "genus"]
    assert clean.select_existing(named, ["genus", "family", "taxonID"]).columns == ["genus", "taxonID"]


def test_require_and_resolve(spark):
    df = spark.createDataFrame([(1.0, 2)], ["water_TEMP", "genus"])
    assert clean.resolve_column(df, "sst", "temp") == "water_TEMP"
    assert clean.require_columns(df, ["genus", "family"], any_of=True) is df
    with pytest.raises(ValueError, match="family"):
        clean.require_columns(df, ["genus", "family"])
    with pytest.raises(ValueError):
        clean.require_columns(df, ["family"], any_of=True)
    with pytest.raises(ValueError):
        clean.resolve_column(df, "sst", "salt")


def test_valid_coordinates_bounds(spark):
    df = spark.createDataFrame(
        [("90", "180"), ("-90", "-180"), ("90.0001", "0"), ("abc", "0"), (None, "0"), ("NaN", "1"), ("0", "-180.5")],
        ["decimalLatitude", "decimalLongitude"])
    cast = clean.cast_select(df, {"decimalLatitude": ("latitude", "double"), "decimalLongitude": ("longitude", "double")})
    assert rows(clean.valid_coordinates(cast)) == [(-90.0, -180.0), (90.0, 180.0)]
    assert df.where(clean.coordinate_in_range("decimalLatitude", "decimalLongitude")).count() == 2


def test_blank_handling(spark):
    df = spark.createDataFrame([("1", "a"), ("2", ""), ("3", " "), ("4", None)], ["taxonID", "order"])
    assert rows(clean.drop_any_null(clean.blank_to_null(df))) == [("1", "a"), ("3", " ")]
    assert rows(clean.drop_blank_rows(clean.trim_all(df))) == [("1", "a")]
    assert rows(taxon.clean_taxon_csv(df)) == [("1", "a"), ("3", " ")]
    assert rows(taxon.clean_taxon_csv(df, trim=True)) == [("1", "a")]


def test_language_is_case_sensitive(spark):
    df = spark.createDataFrame(
        [("1", "cod", "ENG"), ("1", "codfish", "ENG"), ("2", "morue", "FRA"), ("3", "x", "eng"), ("4", "y", None), (None, "z", "ENG")],
        "taxonID string, vernacularName string, language string")
    assert rows(taxon.clean_vernacular(df)) == [("1", "cod", "ENG"), ("1", "codfish", "ENG")]


def test_dedupe_is_independent_of_partitions(spark):
    data = [("k", "b", 2), ("k", "a", 3), ("k", None, 9), ("j", "z", 1)] * 5
    df = spark.createDataFrame(data, "key string, name string, n int")
    for parts in (1, 7):
        assert rows(clean.dedupe(df.repartition(parts), ["key"])) == [("j", "z", 1), ("k", None, 9)]
        assert rows(clean.dedupe(df.repartition(parts), ["key"], ["n"])) == [("j", "z", 1), ("k", "b", 2)]
    assert rows(clean.dedupe(df.select("key"), ["key"])) == [("j",), ("k",)]


def test_group_filters(spark):
    df = spark.createDataFrame([("a", 1.0)] * 10 + [("b", 1.0)] * 9 + [("b", None)] + [("", 1.0)] * 10 + [(None, 1.0)] * 10,
                               "g string, v double")
    kept = clean.min_group_size(clean.drop_blank_groups(df, "g"), "g", "v", 10)
    assert {r[0] for r in kept.collect()} == {"a"} and kept.count() == 10
    assert clean.rows_of_group(df, "g", "b").count() == 10


def test_noise_labels(spark):
    df = spark.createDataFrame([(-1,), (0,), (12,)], "cluster int")
    named = clean.with_cluster_name(clean.with_noise_flag(df))
    assert rows(named) == [(-1, True, "Noise"), (0, False, "Cluster 0"), (12, False, "Cluster 12")]
    assert clean.without_noise(df).count() == 2 and clean.only_noise(df).count() == 1
    assert clean.with_cluster_name(df, out="cluster").columns == ["cluster"]


def test_append_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, parent_class string")
    b = spark.createDataFrame([("y", 2)], "parent_phylum string, id int")
    out = clean.append_by_name([a, b])
    assert rows(out.select("id", "parent_class", "parent_phylum")) == [(1, "x", None), (2, None, "y")]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = clean.drop_if_exists(clean.with_columns(clean.rename_columns(df, {"a": "x"}), {"y": F.col("x") + 1}), ["b", "no"])
    assert out.columns == ["x", "y"] and rows(out) == [(1, 2)]
