import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import encode as E
from tidemark.plans import document as D


def doc(df, **options):
    return D.documents(df, **options).first()["doc"]


def test_primitives(spark):
    schema = "a boolean, b tinyint, c smallint, d int, e bigint, f float, g double, h string"
    df = spark.createDataFrame([(True, 127, 32767, 2147483647, 9223372036854775807, 3.14, 2.718281828, "varchar_test")], schema)
    assert {k: v[0] for k, v in doc(df).items()} == {
        "a": "true", "b": "127", "c": "32767", "d": "2147483647", "e": "9223372036854775807", "f": "3.14", "g": "2.718281828", "h": "varchar_test",
    }


def test_decimal_dates_binary(spark):
    df = spark.createDataFrame(
        [(Decimal("123.45"), dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 12), bytearray(b"test_data"), bytearray(bytes(100)))],
        "a decimal(10,2), b date, c timestamp, d timestamp_ntz, e binary, f binary",
    )
    made = {k: v[0] for k, v in doc(df).items()}
    assert made["a"] == "123.45" and made["b"] == "19723" and made["c"] == made["d"] == "1704110400000" and made["e"] == "dGVzdF9kYXRh"
    assert len(made["f"]) == 136 and "\n" not in made["f"]


def test_timestamps_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        kind = T.TimestampNTZType()
        got = spark.range(1).select(*[E.epoch_millis(F.lit(s).cast(kind), kind) for s in ("2024-01-01 12:00:00.0019", "1969-12-31 23:59:59.9995")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(got) == (1704110400001, -1)


def test_arrays(spark):
    rows = [([-0.12345, 0.6789, 1.5, 0.0], ["machine_learning", "データ", None], ['q"t', "n\nl", "b\\s", "t\tt"])]
    df = spark.createDataFrame(rows, "a array<double>, b array<string>, c array<string>")
    made = {k: v[0] for k, v in doc(df).items()}
    assert made["a"] == "[-0.12345,0.6789,1.5,0.0]" and made["b"] == '["machine_learning","データ",null]'
    assert made["c"] == '["q\\"t","n\\nl","b\\\\s","t\\tt"]'
    assert doc(df, policy=E.TOPIC)["b"] == ["machine_learning", "データ"]


def test_empty_and_null_arrays(spark):
    df = spark.createDataFrame([([], [None], None)], "a array<string>, b array<string>, c array<string>")
    assert doc(df) == {"a": ["[]"], "b": ["[null]"]}
    assert doc(df, policy=E.TOPIC) == {}


def test_maps_and_structs(spark):
    df = spark.createDataFrame([({"k2": "v2", "k1": None}, {2: [1, 2]}, ("x", 42))], "m map<string,string>, n map<int,array<int>>, s struct<innerField:string,innerNumber:int>")
    made = {k: v[0] for k, v in doc(df).items()}
    assert made == {"m": '{"k1":null,"k2":"v2"}', "n": '{"2":[1,2]}', "s": '{"innerField":"x","innerNumber":42}'}
    assert doc(df, policy=E.STRICT_LAKE)["s"] == [E.PLACEHOLDER]
    assert doc(df, policy=E.TOPIC)["s_innerField"] == ["x"]


def test_records_in_arrays(spark):
    df = spark.createDataFrame([([("Alice",), ("Bob",)],)], "people array<struct<name:string>>")
    assert doc(df, policy=E.TOPIC) == {"people": ['{"name":"Alice"}', '{"name":"Bob"}']}


def test_nulls_and_empty_schema(spark):
    df = spark.createDataFrame([("not_null", None, 42)], "a string, b string, c int")
    assert doc(df) == {"a": ["not_null"], "c": ["42"]}
    assert doc(spark.range(1).select()) == {}
    with pytest.raises(ValueError):
        D.compile_projection(None)


@pytest.mark.parametrize(
    ("columns", "options", "kept"),
    [
        (["old_field_name", "unchanged"], {"rename": {"old_field_name": "new_field_name"}}, {"new_field_name", "unchanged"}),
        (["user_id", "__internal__metadata", "title", "__debug_trace"], {"drop_prefixes": ["__internal__", "__debug_"]}, {"user_id", "title"}),
        (["user_id", "__internal__metadata"], {"drop_prefixes": []}, {"user_id", "__internal__metadata"}),
        (["old_name", "__temp_data", "keep_as_is"], {"drop_prefixes": ["__temp_"], "rename": {"old_name": "new_name", "__temp_data": "x"}}, {"new_name", "keep_as_is"}),
        (["normal_field", "_private", "sys_config", "tmpdata", "temp_file", "system"], {"drop_prefixes": ["_", "sys_", "tmp"]}, {"normal_field", "temp_file", "system"}),
        (["A_x", "a_y"], {"drop_prefixes": ["a_"]}, {"A_x"}),
    ],
)
def test_drop_and_rename(spark, columns, options, kept):
    df = spark.createDataFrame([tuple("v" for _ in columns)], columns)
    assert set(doc(df, **options)) == kept


def test_dropped_columns_are_not_read(spark, tmp_path):
    spark.range(3).selectExpr("id", "id as __internal_a", "id as b").write.parquet(str(tmp_path / "t"))
    made = D.documents(spark.read.parquet(str(tmp_path / "t")), drop_prefixes=["__internal_"])
    assert "ReadSchema: struct<id:bigint,b:bigint>" in made._jdf.queryExecution().executedPlan().toString()


def test_later_source_of_a_target_wins_if_it_is_not_null(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "a int, b int")
    got = [r["doc"]["x"] for r in D.documents(df, rename={"a": "x", "b": "x"}).collect()]
    assert got == [["2"], ["3"]]


def test_flatten(spark):
    df = spark.createDataFrame([((1, ("v",)), "w")], "a struct<b:int,c:struct<d:string>>, a_b string")
    assert D.flatten(df).first().asDict() == {"a_b": "w", "a_c_d": "v"}
    assert doc(df, policy=E.TOPIC) == {"a_b": ["w"], "a_c_d": ["v"]}


def test_ids(spark):
    df = spark.createDataFrame([(5, None)], "a long, b string")
    assert df.select(E.id_text(F.col("a"), T.LongType())).first()[0] == "5"
    with pytest.raises(Exception, match="needs an id"):
        df.select(E.id_text(F.col("b"), T.StringType(), "b")).collect()
    assert df.select(E.id_text(F.col("b"), T.StringType(), "b", "keep")).first()[0] is None
    with pytest.raises(TypeError):
        E.id_text(F.col("a"), T.DateType())


def test_unions():
    assert E.non_null_branch(["null", "string"]) == "string" and E.non_null_branch(["int", "string"]) == "int"
    with pytest.raises(ValueError):
        E.non_null_branch(["null"])
