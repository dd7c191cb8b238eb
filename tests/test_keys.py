"""Nested key clean-up (JSN-1)."""

import json

from pyspark.sql import functions as F

from lodestone.functions.keys import sanitize_column, sanitize_json, sanitize_keys, sanitize_name, sanitized_type


def test_name_rules():
    assert sanitize_name("total price") == "total_price"
    assert sanitize_name("1st") == "_1st"
    assert sanitize_name("ok_Name9") == "ok_Name9"
    assert sanitize_name("é-x") == "__x"


def test_map_collision_keeps_first_position_and_last_value(spark):
    df = spark.sql("SELECT map('a-b', 1, 'x', 2, 'a_b', 3, '9z', 4) AS m")
    out = sanitize_keys(df, "m").select(F.map_entries("m").alias("e")).first()["e"]
    assert [(e["key"], e["value"]) for e in out] == [("a_b", 3), ("x", 2), ("_9z", 4)]


def test_nested_struct_array_map(spark):
    schema = "s struct<`a b`: int, `c.d`: array<struct<`1x`: string>>, m: map<string, struct<`k-k`: int>>>"
    df = spark.createDataFrame([((1, [("v",)], {"p q": (5,)}),)], schema)
    t = df.schema["s"].dataType
    out = df.select(sanitize_column(F.col("s"), t).alias("s"))
    assert out.schema["s"].dataType == sanitized_type(t)
    r = out.first()["s"]
    assert r["a_b"] == 1 and r["c_d"][0]["_1x"] == "v" and r["m"]["p_q"]["k_k"] == 5


def test_struct_collision_last_wins(spark):
    df = spark.createDataFrame([((1, 2),)], "s struct<`a.b`: int, a_b: int>")
    out = df.select(sanitize_column(F.col("s"), df.schema["s"].dataType).alias("s"))
    assert out.first()["s"].asDict() == {"a_b": 2}


def test_null_map_stays_null(spark):
    df = spark.createDataFrame([(None,)], "m map<string,int>")
    assert sanitize_keys(df).first()["m"] is None


def test_values_of_top_level_maps_are_cleaned(spark):
    df = spark.createDataFrame([(1, {"a b": {"c d": 1}})], "i int, m map<string,struct<`c d`:int>>")
    clean = sanitize_keys(df, "m")
    assert clean.schema["m"].dataType.valueType.fieldNames() == ["c_d"] and clean.first()["m"]["a_b"]["c_d"] == 1


def cleaned(obj):
    """The rule on Python values."""
    import re
    if isinstance(obj, dict):
        out = {}
        for k, v in obj.items():
            new = re.sub(r"[^a-zA-Z0-9_]", "_", k)
            out["_" + new if re.match("[0-9]", new) else new] = cleaned(v)
        return out
    return [cleaned(x) for x in obj] if isinstance(obj, list) else obj


JSON_TEXTS = [
    '{"a b": {"c-d": [1, {"1x": null}, "e f: \\"g h\\": "]}, "a-b": 2}', "[]", "{}", "3", "null", "true", '"k: v"', "{broken", "", None,
    '{"\\u0041\\u00e9\\ud83d\\ude00z": 1, "q\\"w\\\\e\\n": "\\"r\\\\", "\\/": 2}', '{"same": 1, "same": {"x y": [[["z z"]]]}}',
    '{"": 1, "9": {"": {"8": "}:,\\"{"}}}', '[{"é è": [{"é-è": 1.5}, -2e3, 12345678901234567890]}]', '{"a.b": {"x": 1}, "a_b": {"y": 2}}',
    "{" + ", ".join(f'"k {i}": ' + "[" * 20 + f'{{"v {i}": {i}}}' + "]" * 20 for i in range(300)) + "}", '{"long ' + "x" * 40_000 + '": "' + '\\"' * 20_000 + '"}']


def test_json_of_any_shape(spark):
    df = spark.createDataFrame(list(enumerate(JSON_TEXTS)), "i int, doc string")
    got = {r["i"]: r["doc"] for r in sanitize_json(df, "doc").collect()}
    for i, t in enumerate(JSON_TEXTS):
        try:
            want = cleaned(json.loads(t))
        except (TypeError, ValueError):
            assert got[i] is None, t
        else:
            assert json.loads(got[i]) == want, t
