"""Cleaning of rows, column names, and mappings."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions import columns, documents, mapping

# An SQL value, and the JSON value that stands in the document.
VALUES = [
    ("CAST(NULL AS STRING)", None),
    ("1", 1),
    ("true", True),
    ("'text'", "text"),
    ("2.5D", 2.5),
    ("double('NaN')", None),
    ("double('Infinity')", None),
    ("double('-Infinity')", None),
    ("float('NaN')", None),
    ("float(0.1)", 0.10000000149011612),
    ("timestamp_ntz'2024-01-01 00:00:00'", "2024-01-01T00:00:00"),
    ("timestamp_ntz'2024-01-01 00:00:00.17'", "2024-01-01T00:00:00.170000"),
    ("timestamp_ntz'0099-01-01 00:00:00'", "0099-01-01T00:00:00"),
    ("timestamp'2024-01-01 00:00:00'", "2024-01-01T00:00:00+00:00"),
    ("timestamp'2024-01-01 10:00:00.5'", "2024-01-01T10:00:00.500000+00:00"),
    ("CAST(NULL AS TIMESTAMP_NTZ)", None),
    ("date'2024-02-29'", "2024-02-29"),
    ("1.50BD", "1.50"),
    ("x'0102'", "AQI="),
    ("array(1, null, 3)", [1, None, 3]),
    ("array(double('NaN'), 1.5D)", [None, 1.5]),
    ("array(timestamp_ntz'2024-01-01 00:00:00')", ["2024-01-01T00:00:00"]),
    ("array(array(double('Infinity')))", [[None]]),
    ("CAST(NULL AS ARRAY<DOUBLE>)", None),
    ("map('k', double('NaN'))", {"k": None}),
    ("map(1, date'2024-01-01')", {"1": "2024-01-01"}),
    ("named_struct('p', double('NaN'), 'q', named_struct('r', date'2024-01-01'))", {"p": None, "q": {"r": "2024-01-01"}}),
    ("CAST(NULL AS STRUCT<p: DOUBLE>)", None),
    ("array(named_struct('p', double('NaN')))", [{"p": None}]),
    ("interval '1 02:03:04' day to second", "INTERVAL '1 02:03:04' DAY TO SECOND"),
]


def test_every_kind_of_value(spark):
    row = spark.range(1).select(*[F.expr(sql).alias(f"c{i}") for i, (sql, _) in enumerate(VALUES)])
    docs = documents.prepare_documents(row, "docs")
    text = docs.select(documents.source_json()).first()[0]
    assert json.loads(text) == {f"c{i}": expected for i, (_, expected) in enumerate(VALUES)}
    assert docs.first()["_id"] is None


def test_document_ids(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "key long, v string")
    assert [r._id for r in documents.prepare_documents(df, "i", "key").collect()] == ["1", None]
    assert [r._id for r in documents.prepare_documents(df, "i", "absent").collect()] == [None, None]
    assert documents.prepare_documents(df, "i", "key").columns == ["_index", "_id", "_source"]


def test_cleaning_is_one_projection_without_python(spark):
    df = spark.createDataFrame([(1.0, [2.0])], "x double, xs array<double>")
    plan = documents.prepare_documents(df, "i")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_column_names():
    assert columns.undotted(["a.b", "a_b", "a_b_1", "c"]) == ["a_b", "a_b_1", "a_b_1_1", "c"]
    assert columns.undotted(["a.b", "a.b", "a_b"]) == ["a_b", "a_b_1", "a_b_2"]


def test_wrong_number_of_names(spark):
    with pytest.raises(ValueError, match="2 names for 1"):
        columns.rename_positional(spark.range(1), ["a", "b"])


def test_mapping_to_schema():
    schema = mapping.mapping_to_schema(mapping.sample_mapping())
    assert schema.names == ["timestamp", "id", "text_field", "numeric_field", "boolean_field"]
    assert schema["timestamp"].dataType == T.TimestampNTZType() and schema["numeric_field"].dataType == T.DoubleType()
    with pytest.raises(ValueError, match="unknown mapping type"):
        mapping.mapping_to_schema({"properties": {"x": {"type": "vector"}}})


DATES = [
    ("2024", "2024-01-01 00:00:00"),
    ("2024-03", "2024-03-01 00:00:00"),
    ("2024-01-02", "2024-01-02 00:00:00"),
    ("2024-01-02T03", "2024-01-02 03:00:00"),
    ("2024-01-02T03:04", "2024-01-02 03:04:00"),
    ("2024-01-02T03:04:05.5", "2024-01-02 03:04:05.5"),
    ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
    ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"),
    ("2024-01-02T03:04-0230", "2024-01-02 05:34:00"),
    ("1704067200123", "2024-01-01 00:00:00.123"),
    ("-1500", "1969-12-31 23:59:58.5"),
    ("99999999999999999", None),
    ("-9223372036854775808", None),
    ("99999999999999999999999", None),
    ("2024-13-01", None),
    ("2024-01-02 03:04:05", None),
    ("soon", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates(spark, zone):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(DATES)], "i int, text string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = mapping.date_multi_format(F.col("text")).cast("string")
        assert [r[0] for r in df.orderBy("i").select(moments).collect()] == [expected for _, expected in DATES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# An SQL value, a mapping type, and the coerced value; "error" if it does not fit.
COERCIONS = [
    ("'12'", "integer", 12),
    ("'1.9'", "integer", 1),
    ("3000000000", "integer", "error"),
    ("3000000000", "long", 3000000000),
    ("'x'", "long", "error"),
    ("200", "byte", "error"),
    ("'2.5'", "double", 2.5),
    ("7", "double", 7.0),
    ("'NaN'", "double", "error"),
    ("true", "double", "error"),
    ("'true'", "boolean", True),
    ("false", "boolean", False),
    ("'yes'", "boolean", "error"),
    ("5", "keyword", "5"),
    ("true", "text", "true"),
    ("map('a', 1)", "keyword", "error"),
    ("named_struct('a', 1)", "text", "error"),
    ("array('1', '2')", "integer", [1, 2]),
    ("array('1', 'b')", "integer", "error"),
    ("array(1, null)", "keyword", ["1", None]),
    ("CAST(NULL AS STRING)", "integer", None),
    ("CAST(NULL AS ARRAY<STRING>)", "integer", None),
]


def test_coercions(spark):
    names = [f"c{i}" for i in range(len(COERCIONS))]
    row = spark.range(1).select(*[F.expr(sql).alias(n) for n, (sql, _, _) in zip(names, COERCIONS)], F.lit(1).alias("other"))
    fields = {n: {"type": kind} for n, (_, kind, _) in zip(names, COERCIONS)}
    checked = mapping.apply_mapping(
        documents.prepare_documents(row, "docs"), {"properties": {**fields, "absent": {"type": "date"}}}
    ).first()
    failed = {e.field for e in checked._errors}
    for n, (sql, kind, expected) in zip(names, COERCIONS):
        assert (n in failed) == (expected == "error"), (sql, kind)
        if expected != "error":
            assert checked._source[n] == expected, (sql, kind)
    assert checked._source["other"] == 1 and checked._source["absent"] is None
    assert json.loads(checked._given)["c4"] == "x"


def test_split(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    docs = mapping.apply_mapping(documents.prepare_documents(df, "i"), {"properties": {"v": {"type": "integer"}}})
    accepted, rejected = mapping.split_accepted(docs)
    assert sorted([r._source.v for r in accepted.collect()], key=str) == [1, None]
    assert [(e.field, e.type, e.value) for r in rejected.collect() for e in r._errors] == [("v", "integer", "x")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zoned_dates_do_not_depend_on_the_session(spark, zone):
    texts = ["2024-11-03T06:30:00Z", "2024-11-03T05:30:00Z", "2024-03-10T02:30:00-05:00", "2024-03-10T02:30:00", "1710037800000"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(t,) for t in texts], "t string")
        moments = documents.prepare_documents(frame.select(mapping.date_multi_format(F.col("t")).alias("at")), "i")
        got = [json.loads(r.doc)["at"] for r in moments.select(documents.source_json().alias("doc")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-11-03T06:30:00", "2024-11-03T05:30:00", "2024-03-10T07:30:00", "2024-03-10T02:30:00", "2024-03-10T02:30:00"]


def test_map_keys_without_a_clean_value(spark):
    frame = spark.sql("SELECT map(CAST('NaN' AS DOUBLE), 1, CAST('Infinity' AS DOUBLE), 2, 0.5D, 3) AS m")
    doc = documents.prepare_documents(frame, "i").select(documents.source_json().alias("doc")).first().doc
    assert json.loads(doc) == {"m": {"NaN": 1, "Infinity": 2, "0.5": 3}}
