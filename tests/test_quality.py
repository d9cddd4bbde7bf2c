"""Record checks and store comparison."""

import json

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from fleetstats.operators import quality
from fleetstats.operators import reconcile as rec
from fleetstats.schemas import ALLOWED_JOB_VALUES

EXAMPLE = {"s": "s", "i": 1, "d": {"ds": "s", "di": 1}, "l": [1, 2], "f": 0.5, "b": True, "n": None}


@pytest.mark.parametrize(("doc", "offending", "unknown"), [
    ({"s": "s", "i": 1, "d": {"ds": "s", "di": 1}, "l": [1, 2]}, [], []),
    ({"s": 1}, ["s"], []),
    ({"l": [1, "2"]}, ["l"], []),
    ({"l": ["1"]}, ["l"], []),
    ({"l": []}, ["l"], []),
    ({"l": [None]}, ["l"], []),
    ({"l": [1, True]}, ["l"], []),
    ({"l": [1, 2.5]}, ["l"], []),
    ({"l": 1}, ["l"], []),
    ({"d": {"ds": 1, "di": 1}}, ["d"], []),
    ({"d": {"new": 1}}, [], []),
    ({"d": 5}, ["d"], []),
    ({"d": [1]}, ["d"], []),
    ({"x": 1, "a": 2}, [], ["a", "x"]),
    ({"i": True}, [], []),
    ({"i": 1.0}, ["i"], []),
    ({"i": 123456789012345678901}, [], []),
    ({"f": 1}, [], []),
    ({"f": 1e300}, [], []),
    ({"f": "1"}, ["f"], []),
    ({"b": 1}, ["b"], []),
    ({"s": None, "l": None, "d": None}, [], []),
    ({"n": 1}, ["n"], []),
    ({}, [], []),
])
def test_types_by_example(spark, doc, offending, unknown):
    df = spark.createDataFrame([(json.dumps(doc),)], "doc STRING")
    checked = quality.validate_records(df, "doc", EXAMPLE).first()
    assert (checked.offending_keys, checked.unknown_keys) == (offending, unknown)
    assert json.loads(checked.payload) == doc


def test_keys_that_look_like_paths(spark):
    df = spark.createDataFrame([(json.dumps({"d\u0001ds": 1, "d": {"ds": "s"}, "d\u0002ads": 1, 'q"uote': 1}),)], "doc STRING")
    checked = quality.validate_records(df, "doc", EXAMPLE | {'q"uote': "text"}).first()
    assert (checked.offending_keys, checked.unknown_keys) == (['q"uote'], ["d\u0001ds", "d\u0002ads"])


def test_deep_examples(spark):
    example = {"a": {"b": {"c": {"d": 1}}, "x": "s"}}
    docs = [{"a": {"b": {"c": {"d": "no"}}}}, {"a": {"b": {"c": {"d": 2}}, "x": "t"}}, {"a": {"b": {"c": 5}}}, {"a": {"x": None}}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc STRING")
    assert rows(quality.validate_records(df, "doc", example), "offending_keys") == [(["a"],), ([],), (["a"],), ([],)]


def test_wide_examples_cost_what_the_document_has(spark):
    import time

    wide = {f"key{i}": [1, "x", 0.5, True][i % 4] for i in range(600)}
    docs = [{"key0": "bad", "key1": "x", "new": 1}, {"key3": False}, wide]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc STRING")
    found = quality.validate_records(df, "doc", wide)
    assert rows(found, "offending_keys", "unknown_keys") == [(["key0"], ["new"]), ([], []), ([], [])]
    # the expressions of the plan do not grow with the example: one lookup table, a rule for each kind of value
    assert plan_text(found).count("schema_of_variant") == plan_text(quality.validate_records(df, "doc", dict(list(wide.items())[:4]))).count("schema_of_variant")

    def seconds(example):
        many = spark.range(20000).select(F.lit(json.dumps({"key0": 1, "key1": "x"})).alias("doc"))
        checked = quality.validate_records(many, "doc", example)
        checked.write.format("noop").mode("overwrite").save()
        began = time.perf_counter()
        checked.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    assert seconds(wide) < 5 * seconds(dict(list(wide.items())[:4])) + 1


def test_bad_keys_can_be_dropped(spark):
    df = spark.createDataFrame([('{"s":1,"i":2,"zz":3}',), ("nonsense",)], "doc STRING")
    both = quality.validate_records(df, "doc", EXAMPLE, True, True)
    assert rows(both, "payload") == [('{"i":2}',), (None,)]
    assert rows(quality.validate_records(df, "doc", EXAMPLE, drop_unknown=True), "payload")[0] == ('{"i":2,"s":1}',)


def test_allowed_values(spark):
    df = spark.createDataFrame(
        [("Global", 0, None), ("Bla", 1, None), (None, None, ""), (None, None, None)],
        "Pool STRING, JobFailed INT, P STRING",
    )
    checked = quality.validate_enums(df, ALLOWED_JOB_VALUES, df.columns)
    assert [r[0] for r in rows(checked, "bad_keys")] == [[], ["Pool"], ["P"], []]


def test_contract(spark):
    contract = {"required": ["a", "b"], "properties": {
        "a": {"type": "integer"}, "b": {"type": ["string", "null"]}, "c": {"type": "number"}, "d": {},
    }}
    df = spark.createDataFrame([
        ('{"a":1,"b":"x","c":2.5,"d":[]}',), ('{"a":2.0,"b":null}',), ('{"a":2.5,"b":"x"}',), ('{"a":1}',),
        ('{"a":1,"b":2,"c":"x"}',), ("[]",),
    ], "doc STRING")
    checked = rows(quality.validate_contract(df, "doc", contract), "missing_keys", "mistyped_keys", "valid")
    assert checked == [
        ([], [], True), ([], [], True), ([], ["a"], False), (["b"], [], False), ([], ["b", "c"], False),
        (["a", "b"], [], False),
    ]


def test_rejects_carry_their_reasons(spark):
    good, bad = quality.split_rejects(spark.range(4), {"odd": F.col("id") % 2 == 1, "big": F.col("id") > 2})
    assert sorted(rows(good)) == [(0,), (2,)]
    assert sorted(rows(bad)) == [(1, ["odd"]), (3, ["odd", "big"])]


def test_fingerprint_is_that_of_sorted_json(spark):
    import hashlib

    df = spark.createDataFrame([(1, "x\"y", None, 2.5)], "b INT, a STRING, c STRING, d DOUBLE")
    text = json.dumps({"b": 1, "a": 'x"y', "c": None, "d": 2.5}, sort_keys=True)
    assert rows(df.select(quality.fingerprint(df, df.columns))) == [(hashlib.md5(text.encode()).hexdigest(),)]


def test_ids_missing_on_either_side(spark):
    a = spark.createDataFrame([("d1", 1), ("d1", 2), ("d1", 2), ("d2", 3)], "day STRING, id INT")
    b = spark.createDataFrame([("d1", 2), ("d1", 9), ("d2", 3), ("d3", 4)], "day STRING, id INT")
    found = rec.id_diff(a, b, "id", "day").select("day", "only_a", "only_b", "ids_a", "ids_b", "missing")
    assert sorted(rows(found)) == [("d1", 1, 1, 2, 2, 2), ("d3", 0, 1, 0, 1, 1)]


def test_threshold(spark):
    def store(n):
        return spark.range(n).withColumn("s", F.lit("Completed")), {"Completed": F.col("s") == "Completed"}

    empty = store(0)
    table = rec.reconcile({"a": store(10_000), "b": store(9_901), "c": store(9_801), "d": empty}, 0.01).first()
    assert (table.a_b_flag, table.b_c_flag, table.c_d_flag) == (False, True, True)
    assert table.a_b_diff == pytest.approx(0.0099)
    df = spark.range(10)
    overlapping = {"even": F.col("id") % 2 == 0, "small": F.col("id") < 3, "none": F.col("id") < 0}
    counted = rec.reconcile({"a": (df, overlapping), "b": (df, {"even": F.lit(True)})})
    assert sorted(rows(counted, "status", "a", "b")) == [("even", 5, 10), ("none", 0, 0), ("small", 3, 0)]
    back = rec.reconcile({"a": empty, "b": store(1)}).first()
    assert (back.a_b_diff, back.a_b_flag) == (None, True)


def test_canonical_json_is_that_of_the_reference_language(spark):
    import json

    floats = [0.0, -0.0, 1.0, -1.5, 1e-7, 1.25e-5, 0.0001, 0.00012345, 123456.789, 1e7, 12345678.0, 1e15, 1e16, 1.5e16,
              1.7976931348623157e308, 2.5e-300, 3.14159, 100.0, 0.1, 123e-10, 9007199254740993.0]
    texts = ["plain", "é日本", 'q"\\', "\n\t\r\b\f", "\x01\x1f\x7f", "\U0001f600x", "", None, "a/b"]
    data = [(texts[i % len(texts)], x, i, i % 2 == 0) for i, x in enumerate(floats)]
    df = spark.createDataFrame(data, "s STRING, d DOUBLE, i INT, b BOOLEAN")
    made = {r["i"]: r["j"] for r in df.select("i", quality.canonical_json(df, df.columns).alias("j")).collect()}
    for s, d, i, b in data:
        assert made[i] == json.dumps({"s": s, "d": d, "i": i, "b": b}, sort_keys=True)


def test_canonical_json_of_times_and_nested_values(spark):
    import datetime as dt
    from decimal import Decimal

    df = spark.createDataFrame(
        [(dt.date(2022, 5, 15), dt.datetime(2022, 5, 15, 1, 2, 3, 500000), ["a\"", None], {"b": 1.5, "a": None}, (2, "é"), Decimal("1.50"), [(1,)]),
         (None,) * 7],
        'day DATE, at TIMESTAMP, list ARRAY<STRING>, map MAP<STRING, DOUBLE>, `in"ner é` STRUCT<z: INT, a: STRING>, money DECIMAL(5,2), '
        "deep ARRAY<STRUCT<x: INT>>",
    )
    made = [r[0] for r in df.select(quality.canonical_json(df, df.columns)).collect()]
    first = {"day": "2022-05-15", "at": "2022-05-15 01:02:03.5", "list": ['a"', None], "map": {"a": None, "b": 1.5},
             'in"ner é': {"a": "é", "z": 2}, "money": 1.5, "deep": [{"x": 1}]}
    assert made[0] == json.dumps(first, sort_keys=True).replace('"money": 1.5', '"money": 1.50')
    assert made[1] == json.dumps(dict.fromkeys(first), sort_keys=True)
