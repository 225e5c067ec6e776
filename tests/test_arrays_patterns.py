"""Splittable JSON arrays against the whole-file parser, and patterns by their literals against every pair."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.operators.patterns import literal_runs, pattern_names
from recspark.session import scratch_path
from recspark.sources.files import read_json_lines, read_json_records, write_json_lines

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
                       T.StructField("more", T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())]))])


def rows(n, seed=1):
    rng = random.Random(seed)
    bits = ['"', "\\", "}", "{", "[", "]", ",", "\n", "é", "😀", " ", "\\\"", "}{", "x", "\t", "\\\\", '"}', "\u2028"]
    word = lambda: "".join(rng.choices(bits, k=rng.randint(0, 9)))
    return [{"id": k, "text": word(), "tags": [word() for _ in range(rng.randint(0, 3))], "more": {"a": k % 7, "b": word()} if k % 3 else None} for k in range(n)]


def folder(spark, **files):
    path = scratch_path(spark, "arrays").replace("file:", "")
    os.makedirs(path)
    for name, text in files.items():
        with open(f"{path}/{name}.json", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return path


def small_splits(spark, size):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return old


@pytest.mark.parametrize("size, dump", [(101, {}), (303, {"indent": 2}), (1000, {"ensure_ascii": False}), (10_000_000, {"separators": (",", ":")})])
def test_arrays_equal_the_records_at_any_split_size(spark, size, dump):
    data = rows(50)
    long = [{"id": 1000, "text": "}\"" * 300, "tags": ["[" * 50], "more": None}, {"id": 1001, "text": "", "tags": [], "more": {"a": 1, "b": None}}]
    path = folder(spark, a=json.dumps(data, **dump), b=json.dumps(long, **dump) + "\n", empty="[]", blank=" [\n ] ", one=json.dumps(long[1:]))
    old = small_splits(spark, size)
    try:
        got = [r.asDict(True) for r in read_json_records(spark, path, SCHEMA).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, data + long + long[1:]))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_large_array_is_read_by_many_tasks_and_equals_json_lines(spark):
    data = rows(40_000, seed=3)
    path = folder(spark, big=json.dumps(data))
    lines = scratch_path(spark, "lines")
    write_json_lines(spark.createDataFrame([(d["id"], d["text"], d["tags"], d["more"]) for d in data], SCHEMA), lines)
    old = small_splits(spark, 256_000)
    try:
        a, b = read_json_records(spark, path, SCHEMA), read_json_lines(spark, lines, SCHEMA)
        from recspark.sources.json_arrays import _pieces

        assert _pieces(spark, path).rdd.getNumPartitions() >= 10
        assert a.count() == 40_000 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("text", ['{"id": 1}', '[1, 2]', '[{"id": 1} x {"id": 2}]', '[[{"id": 1}]]', '[{"id": "no number"}]', '[{"id": 1}, 5]'])
def test_what_is_no_array_of_records_fails(spark, text):
    with pytest.raises(Exception):
        read_json_records(spark, folder(spark, a=text), SCHEMA).collect()


# ---- patterns ----

@pytest.mark.parametrize("pattern, runs", [("small ring", ["small ring"]), ("^new", ["new"]), ("plate$", ["plate"]), ("a.c", ["a", "c"]), ("colou?r", ["colo", "r"]),
                                           ("ab+c", ["ab", "c"]), ("x{2,3}yz", ["yz"]), ("a\\.b", ["a.b"]), ("a|b", []), ("(ab)c", []), ("[ab]c", []), ("\\w+", []),
                                           ("ab*?cd", ["a", "cd"]), ("", []), ("(?i)abc", [])])
def test_literal_runs(pattern, runs):
    assert literal_runs(pattern) == runs


def test_patterns_by_literals_equal_every_pair(spark):
    rng = random.Random(2)
    words = ["small", "red", "cold", "ring", "anvil", "gear", "x.y", "o", "plate", "new+"]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(300)] + ["", "ab", None]
    pieces = [*words[:6], "re.", "^new\\+", "plate$", "co?ld", "ri+ng", "gea[rn]", "a|o", ".*", "x\\.y", "an{1,2}vil", "zzz", "^", "o"]
    patterns = {("".join(rng.choices(pieces, k=rng.randint(1, 2))), bool(rng.randint(0, 1))) for _ in range(150)} | {(None, True)}
    df = pattern_names(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(sorted(patterns, key=repr), "pattern string, match boolean"))
    want = set()
    for p, prefix in patterns:
        try:
            test = re.compile(p or "(")
        except re.error:
            continue
        want |= {(p, prefix, n) for n in names if n is not None and (test.match(n) if prefix else test.search(n))}
    assert {tuple(r) for r in df.collect()} == want and want


def test_ten_thousand_patterns_without_a_nested_loop(spark):
    names = spark.range(20_000).select(F.concat(F.lit("shop "), F.sha1(F.col("id").cast("string"))).alias("name"))
    patterns = spark.range(10_000).select(F.substring(F.sha1((F.col("id") * 3).cast("string")), 5, 12).alias("pattern"), (F.col("id") < 0).alias("match"))
    df = pattern_names(names, patterns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert df.count() == 6667  # the multiples of 3 below 20,000
