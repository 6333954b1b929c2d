"""Golden values on small tables."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row, functions as F, types as T

from sendero.functions import vectorized
from sendero.functions.dates import calendar, date_time_text, instant_utc, parse_date, unreadable, wall_clock_utc
from sendero.functions.hashing import short_hash, unit_hash
from sendero.functions.text import lines_of, words_by_space, words_by_whitespace
from sendero.functions.wordcount import (first_seen, merged_sketches, search_counts, top_words, top_words_first_seen, vocabulary_sketches,
                                         vocabulary_size, word_counts)
from sendero.operators import ordering, summaries
from sendero.sources import readers, writers

BOATS = [(11, "Möwe", 9.5, "Kiel"), (12, "Tern", 22.0, "Hull"), (17, "Skua", 14.25, "Kiel"), (19, "Gull", 6.75, "Kiel"),
         (23, "Auk", 31.0, "Oban")]
TIDES = [("Kiel", 3, 1.5), ("Kiel", 4, 2.5), ("Hull", 5, 7.0), ("Hull", 9, 5.0), ("Hull", 14, 6.0), ("Oban", 2, 4.0)]


@pytest.fixture(scope="module")
def boats(spark):
    return readers.from_rows(spark, BOATS, "hull int, name string, metres double, port string")


@pytest.fixture(scope="module")
def tides(spark):
    return readers.from_rows(spark, TIDES, ["port", "hour", "level"])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_boats(boats):
    assert rows(boats.groupBy("port").agg(F.max("metres"))) == [("Hull", 22.0), ("Kiel", 14.25), ("Oban", 31.0)]
    assert rows(boats.where((F.col("metres") < 10) & (F.col("port") == "Kiel")).select("hull")) == [(11,), (19,)]
    assert rows(boats.select("hull", F.col("metres") / 2).where("hull > 17")) == [(19, 3.375), (23, 15.5)]
    assert [r.hull for r in boats.sort(boats.metres.desc()).collect()] == [23, 12, 17, 11, 19]


def test_rows_by_every_kind_of_schema(spark):
    day, at = dt.date(2000, 1, 1), dt.datetime(2000, 1, 1, 12)
    assert readers.from_rows(spark, [Row(a=1, b=2.0, c="x", d=day, e=at)]).dtypes == [
        ("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "date"), ("e", "timestamp")]
    typed = readers.from_rows(spark, [(1, 2.0, "x", day, at)], "a long, b double, c string, d date, e timestamp")
    assert typed.first().d == day
    words = readers.from_rows(spark, ["a", "b", "c", "d", "e"], T.StringType(), partitions=4)
    assert words.rdd.getNumPartitions() == 4 and words.count() == 5


def test_pandas_missing_is_null(spark):
    series = pd.DataFrame({"x": [0.5, np.nan, 2.0, np.nan, 11.5]})
    df = readers.from_pandas(spark, series, index_col="i")
    assert df.columns == ["i", "x"] and df.where("x is null").count() == 2
    assert summaries.column_means(df, ["x"]).first().x == pytest.approx(14 / 3)
    assert df.fillna(4).agg(F.sum("x")).first()[0] == 22 and df.dropna("any").count() == 3


def test_pandas_api(spark, tides):
    frame = readers.to_pandas_api(tides, "hour")
    assert frame["level"].sum() == 26.0 and list(frame.sort_index(ascending=False).head(2).index.to_numpy()) == [14, 9]


CSV = '''berth,boat,note
0017,Skua,"says ""ahoy"", twice"
0420,"Auk, grey",
0042,,"plain"
'''


def test_csv_quotes_and_codes(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    df = readers.read_csv(spark, str(tmp_path / "a.csv"))
    assert set(dict(df.dtypes).values()) == {"string"}
    got = {r.berth: (r.boat, r.note) for r in df.collect()}
    assert got == {"0017": ("Skua", 'says "ahoy", twice'), "0420": ("Auk, grey", None), "0042": (None, "plain")}
    assert readers.read_csv(spark, str(tmp_path / "a.csv"), header=False).count() == 4
    assert dict(readers.read_csv(spark, str(tmp_path / "a.csv"), infer=True).dtypes)["berth"] == "int"


def test_csv_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text("hull;name;berth\n11;Tern;3\n12;Gull;\n")
    df = readers.read_csv(spark, str(tmp_path / "p.csv"), schema="hull int, name string, berth int", sep=";")
    assert rows(df.fillna(0)) == [(11, "Tern", 3), (12, "Gull", 0)]


def test_unreadable_lines_are_errors_or_kept(spark, tmp_path):
    (tmp_path / "p.csv").write_text("hull,metres\n11,9.5\ntwelve,22\n17,14,Kiel\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, str(tmp_path / "p.csv"), schema="hull int, metres double").collect()
    kept = readers.read_csv(spark, str(tmp_path / "p.csv"), schema="hull int, metres double", rejects="bad")
    assert sorted(r.bad or "" for r in kept.collect()) == ["", "17,14,Kiel", "twelve,22"]
    (tmp_path / "p.json").write_text('{"hull": 11}\n{"hull": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_json(spark, str(tmp_path / "p.json"), schema="hull int").collect()
    assert readers.read_json(spark, str(tmp_path / "p.json"), schema="hull int", rejects="bad").where(
        "bad is not null and hull is null").count() == 1


def test_csv_keeps_line_breaks_and_empty_texts(spark, tmp_path):
    texts = [(1, 'two\nlines, "quoted"'), (2, ""), (3, None), (4, "  edges ")]
    df = readers.from_rows(spark, texts, "k int, t string")
    writers.write_csv(df, f"{tmp_path}/c", null="\\N")
    assert rows(readers.read_csv(spark, f"{tmp_path}/c", "k int, t string", multiline=True, null="\\N")) == texts


def test_edge_lists_take_names_and_refuse_unreadable_numbers(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\nx1,3\n3,x1\n,4\n")
    assert rows(readers.load_edges(spark, f"{tmp_path}/e.csv")) == [("3", "x1")]
    with pytest.raises(Exception, match="MALFORMED"):
        readers.load_edges(spark, f"{tmp_path}/e.csv", node_type="bigint").collect()


def test_json_array_document(spark, tmp_path):
    (tmp_path / "p.json").write_text('[\n {"port": "Oban", "berths": 25},\n {"port": "Hull", "berths": 30}\n]')
    df = readers.read_json(spark, str(tmp_path / "p.json"), multiline=True)
    assert df.dtypes == [("berths", "bigint"), ("port", "string")] and df.count() == 2


def test_writes(spark, boats, tmp_path):
    writers.write_json(boats, f"{tmp_path}/j")
    assert rows(readers.read_json(spark, f"{tmp_path}/j", boats.schema)) == sorted(BOATS)
    writers.write_partitioned(boats, f"{tmp_path}/p", "port")
    back = readers.scan_parquet(spark, f"{tmp_path}/p")
    assert back.columns == ["hull", "name", "metres", "port"]
    kiel = back.where("port = 'Kiel'")
    assert "PartitionFilters: [isnotnull(port" in kiel._jdf.queryExecution().toString() and kiel.count() == 3
    writers.write_table(boats, "sendero_boats", path=f"{tmp_path}/t")
    assert spark.table("sendero_boats").count() == 5
    spark.sql("DROP TABLE sendero_boats")
    with pytest.raises(AnalysisException):
        writers.write_json(boats, f"{tmp_path}/j")


def test_lines_and_files(spark, tmp_path):
    for name, text in (("a.txt", "one two\ntwo\n"), ("b.txt", "Two\n")):
        (tmp_path / name).write_text(text)
    lines = readers.read_lines(spark, f"{tmp_path}/*.txt")
    assert rows(lines) == [("Two",), ("one two",), ("two",)]
    assert readers.preview_lines(spark, f"{tmp_path}/a.txt", 1).collect()[0].line == "one two"
    assert rows(readers.file_manifest(readers.read_lines(spark, f"{tmp_path}/*.txt"))) == [("a.txt", 12, 2), ("b.txt", 4, 1)]
    assert rows(search_counts(lines, "line", {"n1": "TWO", "n2": "one"})) == [(3, 1)]


def test_avro_round_trip(spark, boats, tmp_path):
    try:
        boats.write.format("avro").save(f"{tmp_path}/a")
    except AnalysisException:
        pytest.skip("spark-avro is not on the class path")
    assert readers.read_avro(spark, f"{tmp_path}/a").count() == 5


def test_row_ids_and_normals(spark, boats):
    ids = [r.row_id for r in readers.add_row_id(boats.repartition(3)).collect()]
    assert len(set(ids)) == 5
    normal = readers.random_normals(spark.range(20000), ["A", "B"], seed=3)
    stats = {r.col: r for r in summaries.describe(normal, ["A", "B"]).collect()}
    assert abs(stats["A"].mean) < 0.05 and abs(stats["B"].sd - 1) < 0.05
    assert abs(normal.agg(F.corr("A", "B")).first()[0]) < 0.05


def test_keyed_normals_depend_on_the_key_alone(spark):
    draw = lambda df, **kw: rows(readers.random_normals(df, ["A", "B"], **kw, key=["id"]))
    base = spark.range(5000)
    first = draw(base.repartition(1), seed=3)
    assert first == draw(base.repartition(7), seed=3) and first != draw(base, seed=4)
    assert draw(base.where("id in (7, 4000)"), seed=3) == [r for r in first if r[0] in (7, 4000)]
    values = np.array([r[1:] for r in first])
    assert np.isfinite(values).all() and abs(values.mean(axis=0)).max() < 0.05 and abs(values.std(axis=0) - 1).max() < 0.05
    assert abs(np.corrcoef(values.T)[0, 1]) < 0.05 and (abs(values) > 1.96).mean() == pytest.approx(0.05, abs=0.015)
    assert len(draw(spark.createDataFrame([(None,), (None,)], "id bigint"), seed=1)) == 2


def test_equal_counts_in_first_seen_order(spark, tmp_path):
    texts = [["b a", None, "c  c a"], ["", "d b z", "z d e"], ["e\tq q"]]
    for i, some in enumerate(texts):
        spark.createDataFrame([(t,) for t in some], "text string").coalesce(1).write.parquet(f"{tmp_path}/t/part={i}")
    scan = spark.read.parquet(f"{tmp_path}/t")
    seen, counts = [], {}
    for word in [w for some in texts for t in some for w in (t or "").split()]:
        counts[word] = counts.get(word, 0) + 1
        seen += [word] if counts[word] == 1 else []
    want = sorted(seen, key=lambda w: -counts[w])
    assert [tuple(r) for r in top_words_first_seen(scan, "text", 6).orderBy("rank").collect()] == [
        (i + 1, w, counts[w]) for i, w in enumerate(want[:6])]
    places = {r.word: (r.n, r.row, r.place) for r in first_seen(scan, "text").collect()}
    assert places["c"] == (2, 2, 0) and places["z"] == (2, 1, 2) and places["q"] == (2, 0, 1)
    assert first_seen(scan.where("text is null"), "text").count() == 0


def test_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.concat(F.lit("w"), (F.col("id") % 7000).cast("string"), F.lit(" x")).alias("t"))
    sketches = vocabulary_sketches(df, "t", "k")
    size = lambda d: [r[0] for r in d.select(F.hll_sketch_estimate("sketch")).collect()]
    exact = [r[0] for r in df.groupBy("k").agg(F.count_distinct("t") + 1).select(F.col("(count(DISTINCT t) + 1)")).collect()]
    assert sorted(size(sketches)) == [pytest.approx(n, rel=0.02) for n in sorted(exact)]
    assert size(merged_sketches(sketches)) == [pytest.approx(7001, rel=0.02)]
    assert size(vocabulary_sketches(df, "t")) == [pytest.approx(7001, rel=0.02)]
    assert size(vocabulary_sketches(df.where("k < 0"), "t", "k")) == []


def test_group_summaries(spark, tides):
    assert rows(summaries.group_means(tides, "port")) == [
        ("Hull", pytest.approx(28 / 3), 6.0), ("Kiel", 3.5, 2.0), ("Oban", 2.0, 4.0)]
    sums = summaries.group_sums(tides, "port")
    assert sums.columns == ["port", "sum_hour", "sum_level"] and rows(sums)[0] == ("Hull", 28, 18.0)
    want = {3: -0.5, 4: 0.5, 5: 1.0, 9: -1.0, 14: 0.0, 2: 0.0}
    for df in (summaries.center(tides, "port", "level"),
               vectorized.map_groups(tides, "port", {"m": F.avg("level")},
                                     lambda f: f.assign(centered=f.level - f.m)[["hour", "centered"]],
                                     "hour bigint, centered double")):
        assert {r.hour: r.centered for r in df.collect()} == pytest.approx(want)


def test_nan_is_missing_in_sums_centers_and_bins(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 2.0), ("a", nan), ("a", 4.0), ("b", nan), ("b", None)], "g string, v double")
    assert rows(summaries.group_sums(df, "g")) == [("a", 6.0), ("b", None)]
    for centered in (summaries.center(df, "g", "v"), vectorized.center_in_pandas(df.withColumn("k", F.monotonically_increasing_id()), "k", "g", "v")):
        assert sorted(r.centered for r in centered.collect() if r.centered is not None and r.centered == r.centered) == [-1.0, 1.0]
    assert rows(summaries.histogram(df, "v", 2)) == [(0, 1), (1, 1)]


@pytest.mark.parametrize("parts", [1, 7])
def test_map_groups_does_not_depend_on_sizes(spark, parts):
    df = spark.range(40).select((F.col("id") % 2).alias("g"), "id").repartition(parts)
    above = vectorized.map_groups(df, "g", {"n": F.count("*"), "top": F.max("id")},
                                  lambda f: f.assign(left=f.top - f.id)[["id", "n", "left"]], "id bigint, n bigint, left bigint")
    assert rows(above) == [(i, 20, 38 + i % 2 - i) for i in range(40)]


def test_group_stats_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert rows(summaries.center(df, "g", "v").select("v", "centered")) == [(1.0, -1.0), (3.0, 1.0), (5.0, 0.0)]


def test_numeric_columns(boats, tides):
    assert summaries.numeric_columns(boats) == ["hull", "metres"] and summaries.numeric_columns(tides, "int", "double") == ["level"]


def test_describe_skips_missing(spark):
    df = spark.createDataFrame([(1.0, "b"), (float("nan"), "a"), (None, None), (3.0, "c")], "x double, s string")
    assert rows(summaries.describe(df)) == [("x", 2, 2.0, pytest.approx(2 ** 0.5), 1.0, 3.0)]
    assert rows(summaries.describe_text(df, ["s"])) == [("s", 3, "a", "c")]


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).integers(0, 1000, 500).astype(float)
    counts, _ = np.histogram(values, bins=90)
    got = dict(rows(summaries.histogram(readers.from_pandas(spark, pd.DataFrame({"x": values})), "x", 90)))
    assert [got.get(i, 0) for i in range(90)] == counts.tolist()
    constant = spark.createDataFrame([(7.0,), (7.0,), (None,)], "x double")
    assert rows(summaries.histogram(constant, "x", 90)) == [(45, 2)]


def test_correlations(spark):
    frame = pd.DataFrame(np.random.default_rng(2).normal(size=(50, 3)), columns=["y", "a", "b"])
    got = dict(rows(summaries.correlations(readers.from_pandas(spark, frame), "y")))
    assert got == pytest.approx(frame.corr()["y"].drop("y").to_dict())


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_quantiles_match_pandas(spark, size):
    rng = np.random.default_rng(size)
    frame = pd.DataFrame({"a": rng.normal(size=size), "b": rng.integers(0, 3, size).astype(float)})
    frame.loc[frame.index % 5 == 4, "a"] = np.nan
    got = {(r.col, r.p): r.value for r in ordering.quantiles(
        readers.from_pandas(spark, frame), ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    assert got == pytest.approx({(c, p): frame[c].quantile(p) for c in "ab" for p in (0.0, 0.25, 0.5, 0.75, 1.0)})


def test_positions_with_a_hot_value_and_nulls(spark):
    frame = pd.DataFrame({"k": range(3000), "v": [5.0 if i % 3 else None if i % 2 else float(i % 11) for i in range(3000)]})
    df = readers.from_pandas(spark, frame).repartition(7)
    placed = ordering.with_position(df, F.asc_nulls_last("v"), F.asc("k"))
    got = {r.k: r.rn for r in placed.collect()}
    want = frame.sort_values(["v", "k"], na_position="last").k.tolist()
    assert [got[k] for k in want] == list(range(1, 3001))


def test_reindex_and_assign(spark):
    days = calendar(spark.createDataFrame([(dt.date(2013, 1, 1),), (dt.date(2013, 1, 6),)], "d date"), "d")
    assert days.count() == 6
    data = spark.createDataFrame([(dt.date(2013, 1, 1), 1.0), (dt.date(2013, 1, 9), 9.0)], "d date, a double")
    wanted = summaries.reindex(data, "d", days.orderBy("d").limit(4), F.lit(None).cast("double").alias("e"))
    assert [r.a for r in wanted.orderBy("d").collect()] == [1.0, None, None, None]
    marked = summaries.assign_between(wanted.drop("e"), "d", dt.date(2013, 1, 1), dt.date(2013, 1, 2), "e", 1.0)
    assert [r.e for r in marked.orderBy("d").collect()] == [1.0, 1.0, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("10/18/2014",), ("1/7/2014",), ("2014-01-07",), (None,)], "t string")
    assert [r[0] for r in df.select(date_time_text("t")).collect()] == [
        "2014-10-18 00:00:00", "2014-01-07 00:00:00", None, None]
    assert [r[0] for r in df.select(parse_date("t", "MM/dd/yyyy")).collect()] == [dt.date(2014, 10, 18), None, None, None]
    assert unreadable(df, "t").first().n == 1


def test_wall_clock_does_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2018-11-04 00:59:59.999999' AS ts").withColumn("at", instant_utc("ts"))
        assert df.select((wall_clock_utc("at") == F.col("ts")).alias("same")).first().same
        days = spark.createDataFrame([("11/4/2018",)], "t string").select(date_time_text("t"))
        assert days.first()[0] == "2018-11-04 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hashes(spark):
    df = spark.createDataFrame([("a.com",), (None,)], "x string")
    assert [r[0] for r in df.select(short_hash("x")).collect()] == ["87ec0ec3", None]
    units = spark.range(10000).select(unit_hash("id", seed=1).alias("u"))
    assert units.where("u < 0 or u >= 1").count() == 0 and abs(units.agg(F.avg("u")).first()[0] - 0.5) < 0.02


def test_tokens(spark):
    df = spark.createDataFrame([("a  b",), (" a\tB\n",)], "t string")
    assert [r[0] for r in df.select(words_by_whitespace("t")).collect()] == [["a", "b"], ["a", "B"]]
    assert df.select(words_by_space("t")).first()[0] == ["a", "", "b"]
    assert [r.line for r in lines_of(df, "t").collect()] == ["a  b", " a\tB", ""]
    assert rows(word_counts(df, "t")) == [("B", 1), ("a", 2), ("b", 1)]
    assert vocabulary_size(df, "t").first().n == 3
    assert [tuple(r) for r in top_words(df, "t", 2).collect()] == [("a", 2), ("B", 1)]


def test_python_functions(spark, tides):
    assert [r[0] for r in tides.select(vectorized.plus_one("hour")).collect()] == [4, 5, 6, 10, 15, 3]
    vectorized.register_sql_functions(spark)
    tides.createOrReplaceTempView("tide_hours")
    added = spark.sql("SELECT add_one(hour) AS x FROM tide_hours")
    assert added.dtypes == [("x", "int")] and added.count() == 6
    assert spark.sql("SELECT count(*) > 0 FROM tide_hours").first()[0] is True
    assert rows(vectorized.keep_equal(tides.select("hour", "level"), "hour", 9)) == [(9, 5.0)]


def test_large_integers_beside_nulls(spark):
    df = spark.createDataFrame([(2**53 + 1,), (None,)], "x bigint").coalesce(1)
    assert [r[0] for r in df.select(vectorized.plus_one("x")).collect()] == [2**53 + 2, None]
    assert rows(vectorized.keep_equal(df, "x", 2**53 + 1)) == [(2**53 + 1,)]


def test_merge_positions_with_a_hot_key_and_nulls(spark):
    left = pd.DataFrame({"k": [1.0 if i % 3 else float(i % 10) for i in range(400)], "n": range(400)})
    left.loc[left.n % 50 == 7, "k"] = np.nan
    right = pd.DataFrame({"k": [1.0, 3.0, 77.0, np.nan], "w": ["a", "b", "c", "d"]})
    placed = ordering.merge_ordered_positions(readers.from_pandas(spark, left, "k double, n bigint").repartition(5),
                                              readers.from_pandas(spark, right), ["k"], ["n"])
    got = [(r.k, r.n, r.w) for r in placed.orderBy("position").collect()]
    assert [r.position for r in placed.orderBy("position").collect()] == list(range(1, len(got) + 1))
    want = pd.merge(left, right, on="k", how="outer").sort_values(["k", "n"], na_position="last")
    clean = lambda v: None if pd.isna(v) else v
    assert got == [tuple(map(clean, r)) for r in want.itertuples(index=False)]


def test_merge_ordered(spark):
    left = spark.createDataFrame([("Kiel", 3, 1.5), ("Kiel", 4, 2.5), (None, 3, 9.0)], "port string, hour int, level double")
    right = spark.createDataFrame([("Kiel", 4, "ebb"), ("Oban", 3, "flood"), (None, 3, "slack")], "port string, hour int, tide string")
    want = [("", 3, 9.0, "slack"), ("Kiel", 3, 1.5, None), ("Kiel", 4, 2.5, "ebb"), ("Oban", 3, None, "flood")]

    def seen(df):
        return sorted((r[0] or "", *r[1:]) for r in df.collect())
    for group_rows in (100, 1):
        assert seen(vectorized.merge_ordered_in_pandas(
            left, right, ["port", "hour"], "port string, hour int, level double, tide string", group_rows)) == want
    assert seen(ordering.merge_ordered(left, right, ["port", "hour"])) == want
