import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docbridge import ReadConfig, ReadSchemaMismatch, WriteConfig, read_coerce
from docbridge.functions import decode as dec
from docbridge.functions import encode as enc
from docbridge.sources.scan import typed

CFG = ReadConfig(hosts="store:x", api_key="k", index="i")


def both(spark, value, ddl):
    """The value through Catalyst and through the scalar twin."""
    t = T._parse_datatype_string(f"v {ddl}")["v"].dataType
    df = spark.createDataFrame([(json.dumps({"v": value}),)], "j string")
    col = dec.decode(F.variant_get(F.parse_json("j"), "$.v", "variant"), t)
    return df.select(col.alias("v")).first().v, read_coerce(value, t)


GOOD = [
    (None, "int", None), ("x", "string", "x"), (True, "string", "true"), (5, "string", "5"), (3.0, "int", 3), ("42", "bigint", 42), (True, "int", 1), (127, "tinyint", 127), (-32768, "smallint", -32768),
    (2**63 - 1, "bigint", 2**63 - 1), (1.5, "double", 1.5), (2, "double", 2.0), ("1.25", "decimal(10,2)", Decimal("1.25")), (" TRUE ", "boolean", True), ("n", "boolean", False), (0, "boolean", False), (2.5, "boolean", True),
    (-1, "date", dt.date(1969, 12, 31)), (86400000, "date", dt.date(1970, 1, 2)), (1622548800000, "timestamp_ntz", dt.datetime(2021, 6, 1, 12)), (-1, "timestamp_ntz", dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
    ("7.000", "int", 7), (1e3, "int", 1000), ("2e2", "bigint", 200), (" 12 ", "smallint", 12), (1e300, "double", 1e300), (0.5, "float", 0.5), ("1.500", "decimal(10,2)", Decimal("1.50")), (12, "decimal(4,1)", Decimal("12.0")),
    ([1, None, 3], "array<int>", [1, None, 3]), (7, "array<int>", [7]), ({"a": 1}, "map<string,int>", {"a": 1}),
]


@pytest.mark.parametrize("value,ddl,want", GOOD)
def test_values_that_fit(spark, value, ddl, want):
    a, b = both(spark, value, ddl)
    assert a == want and b == want


def test_binary_struct_and_timestamp(spark):
    assert both(spark, "AQI=", "binary")[0] == bytearray(b"\x01\x02") and both(spark, "AQI=", "binary")[1] == b"\x01\x02"
    row, plain = both(spark, {"a": "1", "z": 9}, "struct<a:int,b:string>")
    assert (row.a, row.b) == (1, None) and plain == {"a": 1, "b": None}
    assert read_coerce(1609459200000, T.TimestampType()) == dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc)


BAD = [
    (1.0000001, "int"), (0.9999999, "int"), (1e-7, "bigint"), ("1.0000004", "int"), ("3.5e-1", "int"), ("x", "int"), ("x", "double"), ("x", "decimal(5,1)"), (1.999, "decimal(10,2)"), (12345, "decimal(4,1)"), (1e300, "float"),
    (3.7, "int"), (128, "tinyint"), (40000, "smallint"), (2**31, "int"), (2**63, "bigint"), ("maybe", "boolean"), ("", "boolean"), ([1], "string"), ({"a": 1}, "int"), ([1, 2.5], "array<int>"), ({"a": 1.5}, "map<string,int>"), (5, "map<string,int>"), (5, "struct<a:int>"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value,ddl", BAD)
def test_values_that_do_not_fit(spark, value, ddl, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        refused(spark, value, ddl)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def refused(spark, value, ddl):
    t = T._parse_datatype_string(f"v {ddl}")["v"].dataType
    with pytest.raises(ReadSchemaMismatch):
        read_coerce(value, t)
    with pytest.raises(Exception, match="schema mismatch"):
        both_col = dec.decode(F.variant_get(F.parse_json(F.lit(json.dumps({"v": value}))), "$.v", "variant"), t)
        spark.range(1).select(both_col).collect()


def test_schemas_are_refused_before_reading():
    for ddl in ("v map<int,string>", "v struct<a:array<map<bigint,int>>>", "v void"):
        with pytest.raises(ReadSchemaMismatch):
            dec.check_schema(T._parse_datatype_string(ddl))
    with pytest.raises(ReadSchemaMismatch):
        dec.check_schema(T.StructType([T.StructField("c", T.VarcharType(3))]))
    with pytest.raises(ReadSchemaMismatch):
        read_coerce(None, T.CharType(2))
    with pytest.raises(ValueError):
        dec.check_schema(T.StructType([]))
    dec.check_schema(T._parse_datatype_string("v map<string,array<struct<k:int>>>"))


def test_id_fills_only_an_absent_key(spark):
    raw = spark.createDataFrame([("1", '{"n":5}'), ("2", '{"id":null,"n":6}'), ("3", '{"id":9}')], "_id string, _source string")
    schema = T._parse_datatype_string("id bigint, n int")
    cfg = ReadConfig(hosts="store:x", api_key="k", index="i", id_field="id")
    assert [tuple(r) for r in typed(raw, schema, cfg).collect()] == [(1, 5), (None, 6), (9, None)]
    off = ReadConfig(hosts="store:x", api_key="k", index="i", id_field="id", include_id=False)
    assert [r.id for r in typed(raw, schema, off).collect()] == [None, None, 9]


leaf = st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1), st.text(max_size=5))


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 10**6), st.one_of(st.none(), st.text(max_size=8)), st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)), st.one_of(st.none(), st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=3)), st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1)).map(lambda x: x.replace(microsecond=x.microsecond // 1000 * 1000))), min_size=1, max_size=6))
def test_round_trip(spark, rows):
    df = spark.createDataFrame([(a, b, c, d, (e, [e])) for a, b, c, d, e in rows], "id bigint, `s.x` string, f double, a array<int>, n struct<t:timestamp_ntz,l:array<timestamp_ntz>>")
    docs = enc.documents(df, WriteConfig(hosts="store:x", api_key="k", index="i", id_field="id"))
    back = typed(docs.select("_id", "_source"), df.schema, CFG)
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]
