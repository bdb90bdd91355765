import os

import pytest
from conftest import rows

from pelagia import runtime
from pelagia.sources import delimited, paged


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("text,sep", [("a\tb c\n1\t2\n", "\t"), ("a,b\n1,2\n", ","), ("a|b\n1|2\n", "|"), ("a;b\n1;2\n", ";"), ("name\nx\n", "\t"), ("", "\t")])
def test_sniffing(spark, tmp_path, text, sep):
    assert delimited.sniff_delimiter(spark, write(tmp_path, "t.txt", text)) == sep


def test_read_modes(spark, tmp_path):
    path = write(tmp_path, "t.csv", "id,code,x,flag,empty\n1,NA,1.5,true,\n2,SE,nan,false,\n3,, ,true,\n")
    text = delimited.read_delimited(spark, path, sep=",")
    assert {t for _, t in text.dtypes} == {"string"}
    assert rows(text.select("code")) == [("NA",), ("SE",), (None,)]
    typed = delimited.read_delimited(spark, path, sep="auto", infer=True, null_tokens=delimited.MISSING_TOKENS)
    assert dict(typed.dtypes) == {"id": "bigint", "code": "string", "x": "string", "flag": "boolean", "empty": "string"}
    assert rows(typed.select("code", "x")) == sorted([(None, "1.5"), ("SE", None), (None, " ")], key=repr)
    declared = delimited.read_delimited(spark, path, sep=",", schema="id int, x double, extra string")
    assert rows(declared.select("id", "extra")) == [(1, None), (2, None), (3, None)]
    nan = spark.createDataFrame([(float("nan"), "NA"), (1.0, "x")], "v double, t string")
    assert rows(delimited.normalize_nulls(nan)) == [(1.0, "x"), (None, None)]


def test_round_trip_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([("a, \"b\"", " padded ", None), ("tab\there", "é", "x")], "a string, b string, c string")
    for sep in (",", "\t"):
        path = str(tmp_path / f"out{ord(sep)}")
        delimited.write_delimited(df, path, sep=sep, single_file=True)
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
        assert rows(delimited.read_delimited(spark, path, sep=sep)) == rows(df)
        with pytest.raises(Exception, match="(?i)exists"):
            delimited.write_delimited(df, path, sep=sep)
        delimited.write_delimited(df.limit(1), path, sep=sep, mode="overwrite")
        assert delimited.read_delimited(spark, path, sep=sep).count() == 1


def test_other_sinks(spark, tmp_path):
    source = write(tmp_path, "t.txt", "a|b\n1|é\n")
    delimited.convert_delimited(spark, source, str(tmp_path / "csv"))
    assert rows(delimited.read_delimited(spark, str(tmp_path / "csv"), sep=",")) == [("1", "é")]
    df = spark.createDataFrame([("genus", [1.0, 2.0])], "taxonomic_level string, all_temperatures array<double>")
    delimited.write_distributions_json(df, str(tmp_path / "json"))
    assert rows(spark.read.json(str(tmp_path / "json")).select(*df.columns)) == rows(df)
    flat = spark.createDataFrame([(0, 1.0)], "cluster int, lat double")
    delimited.write_cluster_outputs(flat, flat.select("cluster"), str(tmp_path / "both"))
    assert sorted(os.listdir(tmp_path / "both")) == ["cluster_stats", "clusters"]


def feed(n, short_at=None, fail_at=None):
    def fetch(offset, limit):
        if fail_at is not None and offset >= fail_at:
            raise OSError("unavailable")
        size = limit - 1 if short_at is not None and offset == short_at else limit
        return [{"id": i, **({"depth": i / 2} if i % 3 else {})} for i in range(offset, min(offset + size, n))]
    return fetch


def ids(df):
    return [r["id"] for r in paged.records_to_table(df, "id long").orderBy("page", "position").collect()]


@pytest.mark.parametrize("partitions", [1, 3])
def test_paged_feeds(spark, partitions):
    assert ids(paged.read_paged(spark, feed(23), 5, 100, "empty", partitions=partitions)) == list(range(23))
    assert ids(paged.read_paged(spark, feed(23), 5, 100, "short", partitions=partitions)) == list(range(23))
    assert ids(paged.read_paged(spark, feed(23), 5, 12, "short", cap=True, partitions=partitions)) == list(range(12))
    assert ids(paged.read_paged(spark, feed(23), 5, 12, "empty", partitions=partitions)) == list(range(15))
    # a short page in the middle ends the second style of feed
    assert ids(paged.read_paged(spark, feed(23, short_at=10), 5, 100, "short", partitions=partitions)) == list(range(14))
    assert ids(paged.read_paged(spark, feed(0), 5, 100, "empty", partitions=partitions)) == []
    assert ids(paged.read_paged(spark, feed(99, fail_at=10), 5, 100, "short", partitions=partitions, on_error="stop")) == list(range(10))


def test_paged_errors_and_order(spark):
    # in order, a short page does not end the first style, and no row is skipped
    assert ids(paged.read_paged(spark, feed(23, short_at=5), 5, 100, "empty")) == list(range(23))
    assert ids(paged.read_paged(spark, feed(23, short_at=5), 5, 8, "empty", cap=True)) == list(range(8))
    with pytest.raises(Exception, match="unavailable"):
        paged.read_paged(spark, feed(9, fail_at=5), 5, 100)
    with pytest.raises(ValueError):
        paged.read_paged(spark, feed(9), stop="never")


def test_records_take_the_union_of_keys(spark):
    table = paged.records_to_table(paged.read_paged(spark, feed(4), 5, 100))
    assert table.columns == ["page", "position", "depth", "id"]
    assert rows(table.select("id", "depth")) == [(0, None), (1, 0.5), (2, 1.0), (3, None)]
    assert paged.feed_parameters("from", 20, 10) == {"size": 10, "from": 20}
    assert paged.feed_parameters("offset", 20, 10)["hasCoordinate"] == "true"


def test_scratch_folder_comes_from_the_session(spark):
    folder = runtime.shared_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir() == runtime.shared_dir(spark)
    ids_ = delimited.with_row_id(spark.createDataFrame([("a",), ("b",)], "x string").repartition(2))
    assert rows(ids_) == rows(ids_) and ids_.select("row_id").distinct().count() == 2


def test_clear_scratch_deletes_only_its_own_tables(spark, tmp_path):
    kept = str(tmp_path / "kept")
    spark.range(3).write.parquet(kept)
    staged = runtime.stage(spark.read.parquet(kept))
    assert staged.count() == 3
    runtime.clear_scratch(spark)
    assert spark.read.parquet(kept).count() == 3 and not runtime._written
    with pytest.raises(Exception):
        staged.count()


def test_types_need_their_pattern(spark):
    table = [("y", "1d", "007", "2024-02-03", "true", "1.5"), ("n", "2f", "12", "2024-02-03 10:00:00", "false", None)]
    df = delimited.infer_types(spark.createDataFrame(table, "a string, b string, c string, d string, e string, f string"))
    assert [t for _, t in df.dtypes] == ["string", "string", "bigint", "timestamp", "boolean", "double"]


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"one\ntwo"\n2,x\n')
    df = delimited.read_delimited(spark, str(tmp_path / "x.csv"), sep=",", multi_line=True)
    assert rows(df) == [("1", "one\ntwo"), ("2", "x")]


@pytest.mark.parametrize("partitions", [1, 3])
def test_short_page_in_the_middle_loses_nothing(spark, partitions):
    feed_ = feed(23, short_at=5)
    assert ids(paged.read_paged(spark, feed_, 5, 100, "empty", partitions=partitions)) == list(range(23))


def test_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    import random

    from pelagia.sources import quoted
    rng = random.Random(3)
    pieces = ['plain', '"quoted, text"', '"two\nlines"', '"a ""b""\n\n""c"""', 'x"y', '""', '', '"long ' + 'line\n' * 30 + 'end"', "5\"", '" sp "']
    for k in range(2):
        body = "".join(f"{i},{rng.choice(pieces)},{rng.choice(pieces)}\n" for i in range(400))
        (tmp_path / f"f{k}.csv").write_text("id,a,b\n" + body)
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    size, usual = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(size, "701")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = delimited.read_delimited(spark, str(tmp_path), sep=",", multi_line=True)
        assert quoted._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
        assert rows(got) == rows(whole) and got.columns == ["id", "a", "b"]
    finally:
        spark.conf.set(size, usual)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("line,inside,ends", [
    ('a,b', False, False), ('a,"b', False, True), ('"a""', False, True), ('"a"""', False, False), ('x"y,z', False, False), ('b",c', True, False),
    ('no quote', True, True), ('b","c', True, True), ('""', True, True), ('a,""', False, False), ('"a",x"y,"', False, True)])
def test_state_after_a_line(line, inside, ends):
    from pelagia.sources import quoted
    assert quoted.ends_inside(line, inside, ",") is ends


def test_feed_of_unknown_length_is_shared_by_tasks(spark, tmp_path):
    seen = str(tmp_path)

    def fetch(offset, limit):
        import os
        import uuid
        open(f"{seen}/{limit}-{offset}-{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return [{"id": i} for i in range(offset, min(offset + limit, 1234))]

    assert sorted(ids(paged.read_paged(spark, fetch, 10, 1_000_000))) == list(range(1234))
    import os
    calls = [f.split("-") for f in os.listdir(seen)]
    pages = [int(c[1]) for c in calls if c[0] == "10" and int(c[1]) < 1234]
    assert len(set(pages)) == 124 and len(pages) < 124 + 25  # the search for the end
    assert len({c[2] for c in calls}) > 2


def test_records_of_differing_shapes(spark):
    texts = ['{"id": 1, "x y": 1.5, "m": 1, "n": null}', '{"id": 2.5, "m": "t", "o": {"k": 1}}', '{"z": [1, 2]}', '{}', '[1]', 'broken']
    records = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "page long, position long, record string")
    table = paged.records_to_table(records)
    assert table.dtypes[2:] == [("id", "double"), ("m", "string"), ("n", "string"), ("o", "struct<k:bigint>"), ("x y", "double"), ("z", "array<bigint>")]
    got = {r["position"]: r for r in table.collect()}
    assert (got[0]["x y"], got[0]["m"], got[1]["m"], got[1]["id"], got[2]["z"]) == (1.5, "1", "t", 2.5, [1, 2]) and len(got) == 6
    assert paged.records_to_table(records.limit(0)).columns == ["page", "position"]
