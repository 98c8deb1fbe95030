import json
import uuid

from pyspark.sql import functions as F

from tallyloom.functions.json import joined_texts, json_fields, json_kind, name_uuid, struct_text


def test_fields_of_any_shape(spark):
    texts = ['{"k": 9, "a": {"b": [1, 2]}}', '{"k": "x"}', '{"k": 2.5}', "[1]", "no json", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    f = json_fields("t", {"k": "$.k bigint", "b1": "$.a.b[1] int", "text": "$.k string"})
    got = [tuple(r) for r in df.select(f["k"], f["b1"], f["text"], json_kind("t")).collect()]
    assert got[0] == (9, 2, "9", "OBJECT<a: OBJECT<b: ARRAY<BIGINT>>, k: BIGINT>")
    assert got[1][:3] == (None, None, "x") and got[2][2] == "2.5"
    assert got[3][:3] == (None, None, None) and got[3][3] == "ARRAY<BIGINT>"
    assert got[4] == got[5] == got[6] == (None, None, None, None)


def test_struct_text_and_joined(spark):
    df = spark.createDataFrame([(1, 'a"b', None, [(1, "x"), (2, None)]), (2, "é\n", 2.5, [])],
                               "a int, b string, c double, d array<struct<i:int,s:string>>")
    got = df.select(struct_text("a", "b", "c").alias("t"), joined_texts("d").alias("j")).collect()
    assert [json.loads(r.t) for r in got] == [{"a": 1, "b": 'a"b', "c": None}, {"a": 2, "b": "é\n", "c": 2.5}]
    assert [r.j for r in got] == ['{"i":1,"s":"x"}; {"i":2,"s":null}', ""]


def test_name_uuid(spark):
    names = ["", "a", "event/17", "ñ 漢字", *map(str, range(200))]
    df = spark.createDataFrame([(n,) for n in [*names, None]], "n string")
    for space in (uuid.NAMESPACE_URL, uuid.NAMESPACE_DNS):
        got = [r[0] for r in df.select(name_uuid(F.col("n"), space)).collect()]
        assert got == [str(uuid.uuid5(space, n)) for n in names] + [None]
