import pytest
from pyspark.sql import functions as F

from fieldsync.functions import documents as doc
from fieldsync.functions.text import concat_skip_null, date_of_text, differs, spaced_name
from fieldsync.operators.pivot import attribute, wide_by_key
from fieldsync.operators.quarantine import document_counts, split_documents

TEXTS = {
    '{"a":1}': True,
    ' {"a":1} ': True,
    '{"a":1,"a":2}': True,
    "123": True,
    "-1": True,
    "true": True,
    "null": True,
    '"x"': True,
    "[1,2]": True,
    "": False,
    "  ": False,
    "AB12": False,
    "0123": False,
    "nul": False,
    "[1": False,
    "1 2": False,
    "1,2": False,
    '{"a":1} xyz': False,
    '{"a":1}{"b":2}': False,
    '{"a":1},"b":2': False,
    '{"a":1}] xyz': False,
    "{'a':1}": False,
    '{"a":NaN}': False,
    '{"a":01}': False,
    '{"a":1,}': False,
    "{a:1}": False,
}


def test_is_json(spark):
    rows = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = {r["t"]: r["ok"] for r in rows.select("t", doc.is_json(F.col("t")).alias("ok")).collect()}
    assert got == {**TEXTS, None: False}


def test_quarantine_keeps_null_and_counts(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "id int, t string")
    parts = split_documents(rows, "t")
    assert parts["valid"].count() == sum(TEXTS.values()) + 1
    assert parts["rejected"].count() == len(TEXTS) - sum(TEXTS.values())
    counts = document_counts(rows.withColumn("g", F.lit(1)), "t", ["g"]).first()
    assert (counts["n_rows"], counts["n_valid"], counts["n_rejected"]) == (27, 9, 17)


def test_property_lists(spark):
    texts = {
        1: '{"propertiesBean":[{"categorypropertyallocationid":"57","value":"x"},{"categorypropertyallocationid":5,"value":{"a":[1]}}]}',
        2: '{"propertiesBean":[{"categorypropertyallocationid":"57","value":"x"},5,null,"s"]}',
        3: '{"propertiesBean":[]}',
        4: '{"other":1}',
        5: '{"propertiesBean":null}',
        6: '{"propertiesBean":{"a":1}}',
        7: '{"propertiesBean":[{"value":"x"}]} tail',
        8: None,
        9: '[{"propertiesBean":[{"value":"x"}]}]',
        10: '{"propertiesBean":[{"categorypropertyallocationid":1,"value":"a","value":"b"}]}',
    }
    rows = spark.createDataFrame(list(texts.items()), "id int, d string")
    read = doc.read_documents(rows, "d").withColumn("reason", doc.broken_document("d"))
    got = {r["id"]: r for r in read.collect()}

    def pairs(i):
        return None if got[i]["properties"] is None else [tuple(p) if p else None for p in got[i]["properties"]]

    assert pairs(1) == [("57", "x"), ("5", '{"a":[1]}')]
    assert pairs(2)[0] == ("57", "x") and len(pairs(2)) == 4
    assert pairs(3) == [] and got[3]["reason"] is None
    assert pairs(4) is None and got[4]["reason"] is None
    assert got[5]["reason"] == got[6]["reason"] == "properties are not a list"
    assert pairs(7) is None and got[7]["reason"] == "document does not parse"
    assert pairs(8) is None and got[8]["reason"] is None
    assert pairs(9) is None and got[9]["reason"] is None
    assert pairs(10) == [("1", "b")]


def test_payload_keeps_null_members(spark):
    row = spark.range(1).select(doc.payload([F.lit(None).cast("string").alias("a"), F.lit(True).alias("b")]).alias("p"))
    assert row.first()["p"] == '{"a":null,"b":true}'


@pytest.mark.parametrize("day,expected", [("05/01/2024", "2024-01-05"), ("5/1/2024", "2024-01-05"), ("2024-01-05", None), (None, None)])
def test_date_of_text(spark, day, expected):
    got = spark.range(1).select(date_of_text(F.lit(day), F.lit("9:05:07")).cast("string").alias("d")).first()["d"]
    assert got == expected


def test_text_rules(spark):
    null = F.lit(None).cast("string")
    row = spark.range(1).select(
        concat_skip_null(F.lit("A"), null).alias("skip"),
        spaced_name(null, F.lit("B")).alias("name"),
        differs([(F.lit(None).cast("int"), F.lit(1)), (F.lit(2), F.lit(3))]).alias("yes"),
        differs([(F.lit(None).cast("int"), F.lit(1)), (F.lit(2), F.lit(2))]).alias("unknown"),
    ).first()
    assert tuple(row) == ("A", " B", True, None)


def test_greatest_text_by_collation(spark):
    """Neighbours in a collation are told apart by case, equal texts by bytes, in any order; unknown ones don't count."""
    from itertools import permutations

    values = ["b", "A", "a", "B", None, "Z", "é"]
    rows = [(i, [(v,) for v in order]) for i, order in enumerate([*permutations(values[:4]), values, values[::-1], [None], []])]
    table = spark.createDataFrame(rows, "i int, p array<struct<v:string>>")
    told = table.select("i", *[attribute(F.transform("p", lambda x: F.struct(F.lit(1).alias("id"), x["v"].alias("v"))), "v", (1,), collation=c).alias(n) for n, c in (("bytes", None), ("folded", "UNICODE_CI"), ("unicode", "UNICODE"))])
    got = {r["i"]: (r["bytes"], r["folded"], r["unicode"]) for r in told.collect()}
    assert set(list(got[i] for i in range(24))) == {("b", "b", "B")}
    assert got[24] == got[25] == ("é", "Z", "Z") and got[26] == got[27] == (None, None, None)
    flat = table.where("i < 26").selectExpr("1 as id", "explode(p.v) as v")
    assert tuple(wide_by_key(flat, ["id"], "id", {"v": ("v", (1,))}, collation="UNICODE").first()) == (1, "Z")


NUMBERS = [
    '{"a":1.50,"b":-0.0,"c":[1.10,2,"x 1.50 \\" 2.50"],"d":1e5,"e":1.5e3,"f":123.45}',
    '{"a":1.50}{"b":2.0}', '{"a" : 1.50 }', '{"a":"1.50"}', "1.50", '{1.5:2}', '{"a":01.50}', '{"a":1.5.2}',
    '{"a":1.50', '["s":-]1.5', '{"a":1.0,"b":"unclosed 2.0}', '{"a":1.5e}', '[1.5"x"]', "-1.50", "--1.5", '["a"1.5]',
    '[' + '"y",' * 20_000 + "1.50]",
]


def test_marks_leave_validity_alone(spark):
    """Also of texts cut, doubled and stirred at random."""
    import json
    import random

    rng = random.Random(4)
    texts = [t for t in NUMBERS]
    for _ in range(1500):
        t = list(rng.choice(NUMBERS[:-1]))
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(t))
            t[at : at + rng.randint(0, 2)] = rng.choice(['"', "1.5", "0", "-", ".", "e", "{", "}", ",", ":", " ", "\\", ""])
        texts.append("".join(t))
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    marked = doc.as_written(F.col("t"))
    rows = table.select("i", doc.is_json(F.col("t")).alias("before"), doc.is_json(marked).alias("after"), doc.written(marked, F.lit(True)).alias("back")).collect()
    assert all(r["before"] == r["after"] for r in rows)

    def exact(text):
        return json.loads(text, parse_float=str, parse_int=str)

    valid = [(exact(texts[r["i"]]), exact(r["back"])) for r in rows if r["before"]]
    assert len(valid) > 20 and all(a == b for a, b in valid)


def test_numbers_as_written(spark):
    texts = ['{"a":1.50}', '{"a":0.10000000000000000000}', '{"a":{"b":[1.0,{"c":-2.50}]}}', '{"a":"1.50"}', '{"a":null,"b":1.50}', '{"a":12345678901234567890.0}', '{"a":"␝1.50","b":1.5}', '{"a":1e5}', '{"a":"\\u241d1.50","b":1.5}']
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in table.select(doc.member(F.col("t"), "a")).collect()]
    assert got == ["1.50", "0.10000000000000000000", '{"b":[1.0,{"c":-2.50}]}', "1.50", None, "12345678901234567890.0", "␝1.50", "100000.0", "␝1.50"]
    lists = ['{"propertiesBean":[{"categorypropertyallocationid":1,"value":2.50},{"value":"2.50"}]}', '{"propertiesBean":[7, {"value":{"x":2.50}}, null]}']
    read = doc.read_documents(spark.createDataFrame([(t,) for t in lists], "t string"), "t").collect()
    assert [[p and tuple(p) for p in r["properties"]] for r in read] == [[("1", "2.50"), (None, "2.50")], [None, (None, '{"x":2.50}'), None]]


def test_members_are_read_at_once(spark):
    """As one by one, and with one read of the text however many they are."""
    texts = ['{"a": 1.50, "b": {"c": [2.0, 3]}, "a.b": "x"}', ' {"a": null, "b": "\\u241d1.5"}', "[1.5]", "1.5", "", None, '{"a": 1.5', '{"a": 1.5, "b": {"c": [1.0, nulls]}}', '{"a": 1, "b": x}', '{"b": [1, 2}, "a": 1.5}', '{"a": 1.5, "d": [1}', '{"a": 1.5} x', '{"a": 1.0, "a": 2.0}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    read = doc.read_members(rows, "t", ["a", "b", "a.b"])
    single = rows.select("t", *[doc.member(F.col("t"), m).alias(m) for m in ("a", "b", "a.b")])
    assert [tuple(r) for r in read.collect()] == [tuple(r) for r in single.collect()]
    assert read._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
