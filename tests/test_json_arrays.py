"""JSON arrays read in ranges: the same rows for any range size, records and texts across ranges."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from sendero.sources import json_arrays

SCHEMA = "id bigint, text string, tags array<string>, inner struct<a:string,b:array<bigint>>"
ODD = ['plain', '', 'quote " and \\" more', 'brace } in { text ] [ ,', 'line\nbreak\r\n\t', 'back\\', '\\\\"}', 'é 日本語 😀', '}' * 40, None, '],["x":{}]']


def records(n, seed=1):
    rng = random.Random(seed)
    return [{"id": i, "text": rng.choice(ODD), "tags": rng.choices(ODD, k=rng.randint(0, 3)),
             "inner": rng.choice([None, {"a": rng.choice(ODD), "b": [1, 2]}])} for i in range(n)]


def as_rows(found):
    return sorted(map(repr, found))


def rows_of(df):
    return as_rows(json.loads(r.j) for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).collect())


@pytest.mark.parametrize("range_bytes", [64, 700, 1 << 27])
@pytest.mark.parametrize("indent", [None, 1])
def test_rows_do_not_depend_on_ranges(spark, tmp_path, range_bytes, indent):
    folder = tmp_path / "in"
    folder.mkdir()
    every = []
    for i, n in enumerate((60, 0, 1, 30)):
        some = records(n, seed=i)
        every += some
        (folder / f"{i}.json").write_text(json.dumps(some, indent=indent, ensure_ascii=i % 2 == 0) + ("\n" if i else ""))
    (folder / "far.json").write_text(" \n [" + " " * 2000 + json.dumps({"id": 900, "text": "x}" * 3000, "tags": [], "inner": None}) + " , " + " " * 2000
                                     + json.dumps({"id": 901, "text": None, "tags": ["}" * 500], "inner": None}) + "]\n\n")
    every += [{"id": 900, "text": "x}" * 3000, "tags": [], "inner": None}, {"id": 901, "text": None, "tags": ["}" * 500], "inner": None}]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        parts = spark.read.option("lineSep", "}").text(str(folder)).rdd.getNumPartitions()
        got = json_arrays.read_json_arrays(spark, str(folder), SCHEMA)
        assert rows_of(got) == as_rows(every)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (parts > 40) == (range_bytes == 64)


def test_written_arrays_come_back(spark, tmp_path):
    df = spark.createDataFrame(records(50), SCHEMA).repartition(6)
    path = json_arrays.write_json_arrays(df, f"{tmp_path}/out")
    assert rows_of(json_arrays.read_json_arrays(spark, path, SCHEMA)) == rows_of(df)
    for file in (tmp_path / "out").glob("*.txt"):
        json.loads(file.read_text())
    none = json_arrays.write_json_arrays(df.where("id < 0"), f"{tmp_path}/none")
    assert json_arrays.read_json_arrays(spark, none, SCHEMA).count() == 0


@pytest.mark.parametrize("text", ['{"id": 1}', '[{"id": 1}] x', 'x [{"id": 1}]', '[{"id": 1}][{"id": 2}]', '[{"id": "no number"}]'])
def test_what_is_no_array_of_such_records_fails(spark, tmp_path, text):
    (tmp_path / "f.json").write_text(text)
    if text.startswith("[{\"id\": 1}]["):  # two arrays in a row read as one longer one
        assert json_arrays.read_json_arrays(spark, f"{tmp_path}/f.json", "id bigint").count() == 2
        return
    with pytest.raises((PythonException, Exception), match="does not hold one JSON array|MALFORMED_RECORD"):
        json_arrays.read_json_arrays(spark, f"{tmp_path}/f.json", "id bigint").collect()


def test_effects_of_a_range():
    assert json_arrays.effect('{"a": [1, "x}', False) == (True, 2)
    assert json_arrays.effect('y", 2]}', True) == (False, -2)
    assert json_arrays.effect('a \\" b }', True) == (True, 0)
    assert json_arrays.effect("", True) == (True, 0) and json_arrays.effect("", False) == (False, 0)
    for piece in ('a \\" b "}', '"a" \\\\" }', '\\"}', '{"k": "v\\\\"}'):
        assert json_arrays.effect(piece, True)[0] != json_arrays.effect(piece, False)[0]
