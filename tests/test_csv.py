"""Delimited files: every reader option, on files written by the test."""

from __future__ import annotations

import csv
import hashlib
import io
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from docgraph.sources.csv import column_names, read_csv


@pytest.fixture
def write(tmp_path):
    def put(text, name="t.csv", encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))
        return str(path)

    return put


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_types_are_inferred(spark, write):
    path = write("i,f,b,s,n,m\n1,1.5,true,x,,1\n-2,inf,False,1d,NA,t\n,1e3,TRUE,,null,2\n")
    table = read_csv(spark, path).rows
    assert dict(table.dtypes) == {"i": "bigint", "f": "double", "b": "boolean", "s": "string", "n": "double", "m": "string"}
    assert rows(table) == [
        (1, 1.5, True, "x", None, "1"),
        (-2, float("inf"), False, "1d", None, "t"),
        (None, 1000.0, True, None, None, "2"),
    ]


def test_whole_numbers_beyond_long_stay_exact(spark, write):
    table = read_csv(spark, write("a,b,c\n1,1.5,1\n99999999999999999999,99999999999999999999," + "9" * 40 + "\n")).rows
    assert table.dtypes == [("a", "decimal(38,0)"), ("b", "string"), ("c", "string")]
    assert [str(r.a) for r in table.collect()] == ["1", "99999999999999999999"]


def test_header_names(spark, write):
    assert read_csv(spark, write("x,x,a.b,a_b,,x.1\n1,2,3,4,5,6\n")).rows.columns == ["x", "x.2", "a.b", "a_b", "Unnamed: 4", "x.1"]
    assert read_csv(spark, write("x,a.b,a_b\n1,2,3\n"), replace_dots=True).rows.columns == ["x", "a_b", "a_b_1"]
    assert column_names([["x", "x.1", "x", "x"]], 4) == ["x", "x.1", "x.2", "x.3"]
    assert column_names([["a", "a", "a.1", "a"]], 4) == ["a", "a.2", "a.1", "a.3"]
    assert column_names([["a", "a"], ["b", "c"]], 2) == ["a_b", "a_c"]
    assert column_names([], 2) == ["0", "1"]


def test_short_and_long_lines(spark, write):
    read = read_csv(spark, write('a,b,c\n1,2,3\n4,5\n6,7,8,9\n6,7,,\n"x,y",2,3\n"p,q",2\n'))
    assert rows(read.rows) == [("1", 2, 3), ("4", 5, None), ("x,y", 2, 3), ("p,q", 2, None)]
    assert sorted(rows(read.rejects)) == [("6,7,,", "more than 3 fields"), ("6,7,8,9", "more than 3 fields")]
    assert read.rejects.count() == 2 and read.rejects.select("_raw").count() == 2


@pytest.mark.parametrize("delimiter", ["|", "\t", ";"])
def test_delimiters(spark, write, delimiter):
    text = "a,b\n1,x y\n2,\n".replace(",", delimiter)
    assert rows(read_csv(spark, write(text), delimiter=delimiter).rows) == [(1, "x y"), (2, None)]


@pytest.mark.parametrize("extra", [{}, {"nrows": 2}])
def test_encodings(spark, write, extra):
    path = write("größe,n\nmüde,1\nété,2\n", encoding="latin-1")
    table = read_csv(spark, path, encoding="latin-1", **extra).rows
    assert table.columns == ["größe", "n"] and sorted(rows(table)) == [("müde", 1), ("été", 2)]


def test_byte_order_mark(spark, write):
    assert read_csv(spark, write("﻿a,b\n1,2\n")).rows.columns == ["a", "b"]


@pytest.mark.parametrize("extra", [{}, {"nrows": 5}])
def test_quotes_and_escapes(spark, write, extra):
    assert rows(read_csv(spark, write('a,b\n"x ""y"", z",1\n'), **extra).rows) == [('x "y", z', 1)]
    assert rows(read_csv(spark, write("a,b\n'x,''y''',1\n"), quotechar="'", **extra).rows) == [("x,'y'", 1)]
    assert rows(read_csv(spark, write('a,b\n"x\\"y",1\n'), escapechar="\\", **extra).rows) == [('x"y', 1)]


def test_records_over_several_lines(spark, write):
    path = write('a,b\n"x\ny",1\nz,2\n')
    assert rows(read_csv(spark, path).rows) == [("x\ny", 1), ("z", 2)]
    assert rows(read_csv(spark, path, nrows=1).rows) == [("x\ny", 1)]
    assert rows(read_csv(spark, write('top,\n"a\nb",c\n1,2\n', "u.csv"), header=1).rows.select("*")) == [(1, 2)]
    assert sorted(rows(read_csv(spark, path, skiprows=1, header=None).rows)) == [("x\ny", 1), ("z", 2)]
    assert rows(read_csv(spark, path, skiprows=[1]).rows) == [("z", 2)]
    read = read_csv(spark, path, multiline=False)
    assert ('"x', "a quote is not closed") in [tuple(r) for r in read.rejects.collect()]
    crlf = write('a,b\r\n"x\r\n\r\ny",1\r\n"",2\r\n', "crlf.csv")
    assert sorted(rows(read_csv(spark, crlf).rows), key=str) == [("x\r\n\r\ny", 1), (None, 2)]


def test_unclosed_quotes_cost_one_line(spark, write):
    read = read_csv(spark, write('a,b\n0,"p\nq"\n1,"abc\n2,def\n3,"g"\n4,"h\n5,i\n'))
    # The quote of line 4 opens last, as that of line 1 ends at the next one.
    assert sorted(r.a for r in read.rows.collect()) == [0, 1, 5]
    assert [tuple(r) for r in read.rejects.collect()] == [('4,"h', "a quote is not closed")]
    only = read_csv(spark, write('a,b\n1,"abc\n2,def\n3,ghi\n', "only.csv"))
    assert sorted(rows(only.rows)) == [(2, "def"), (3, "ghi")]
    assert [tuple(r) for r in only.rejects.collect()] == [('1,"abc', "a quote is not closed")]


def test_names_of_any_kind(spark, write):
    read = read_csv(spark, write("a,A,_raw,_problem,c0,t1\n1,2,3,4,5,6\n7,8,9,10,11,12,13\n"))
    assert read.rows.columns == ["a", "A", "_raw", "_problem", "c0", "t1"] and rows(read.rows) == [(1, 2, 3, 4, 5, 6)]
    assert [tuple(r) for r in read.rejects.collect()] == [("7,8,9,10,11,12,13", "more than 6 fields")]


def test_records_over_many_splits_equal_one_task(spark, write):
    """A file cut into splits of a few bytes, at all kinds of places of its records, against a plain reader."""
    rng = random.Random(9)
    pieces = ["x", "yy", "\n", '""', ",", "é", "\n\n", " ", "zzzz", '"",""\n']
    field = lambda: f'"{"".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12)))}"' if rng.random() < 0.5 else rng.choice(["p", 'q"r', "s t"])
    text = "k,l,m\n" + "".join(f"{k},{field()},{field()}\n" for k in range(150))
    expected = [tuple(v if v not in ("",) else None for v in r) for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    settings = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        read = read_csv(spark, write(text), dtype={"k": "str", "l": "str", "m": "str"})
        assert sorted(rows(read.rows), key=str) == sorted(expected, key=str) and read.rejects.count() == 0
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_quotes_that_close(spark, write):
    """None of these lines opens a quote without closing it; the separator may be a sign of patterns."""
    lines = ['"a|""b"|c', '"|"""|x', 'a|5" pipe', '|', '"a"|"b"', 'x|""']
    read = read_csv(spark, write("\n".join(lines) + "\n"), delimiter="|", header=None, multiline=False)
    assert read.rejects.collect() == []
    assert [r["0"] for r in read.rows.collect()] == ['a|"b', '|"', "a", None, "a", "x"]
    assert read_csv(spark, write("a|b\n1|" + "y" * 200_000 + "\n"), delimiter="|", multiline=False).rows.count() == 1


def test_each_file_by_its_own_header(spark, write):
    paths = [write("id,name\n1,ann\n", "p/1.csv"), write("name,id\nbob,2\n", "p/2.csv"), write("id,more\n3,x\n", "q.csv")]
    table = read_csv(spark, [paths[0].rsplit("/", 1)[0], paths[2]]).rows
    assert table.columns == ["id", "name", "more"]
    assert sorted(rows(table)) == [(1, "ann", None), (2, "bob", None), (3, None, "x")]


def test_lists_with_repeats_and_globs(spark, write):
    one, two = write("a\n1\n", "d/one.csv"), write("a\n2\n", "d/two[1].csv")
    folder = one.rsplit("/", 1)[0]
    assert sorted(rows(read_csv(spark, [one, f"{folder}/*.csv", one]).rows)) == [(1,), (1,), (1,), (2,)]
    assert sorted(rows(read_csv(spark, folder).rows)) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no such file"):
        read_csv(spark, f"{folder}/none.csv")


LINES = "top\n\na,b\nu,v\n1,x\n2,y\n\n3,z\n4,w\n"


@pytest.mark.parametrize(
    "settings, columns, expected",
    [
        ({"header": 1}, ["a", "b"], [("u", "v"), ("1", "x"), ("2", "y"), ("3", "z"), ("4", "w")]),
        ({"header": [1, 2]}, ["a_u", "b_v"], [(1, "x"), (2, "y"), (3, "z"), (4, "w")]),
        ({"header": [1, 3]}, ["a_1", "b_x"], [(2, "y"), (3, "z"), (4, "w")]),
        ({"skiprows": 3}, ["u", "v"], [(1, "x"), (2, "y"), (3, "z"), (4, "w")]),
        ({"skiprows": [0, 3, 5]}, ["a", "b"], [(1, "x"), (3, "z"), (4, "w")]),
        ({"skiprows": 2, "nrows": 3}, ["a", "b"], [("u", "v"), ("1", "x"), ("2", "y")]),
        ({"skiprows": 3, "nrows": 0}, ["u", "v"], []),
        ({"skiprows": 4, "header": None, "nrows": 2}, ["0", "1"], [(1, "x"), (2, "y")]),
        ({"skiprows": 4, "header": "none"}, ["0", "1"], [(1, "x"), (2, "y"), (3, "z"), (4, "w")]),
        ({"skiprows": 3, "usecols": ["v"]}, ["v"], [("x",), ("y",), ("z",), ("w",)]),
        ({"skiprows": 3, "column_names": ["p", "q"]}, ["p", "q"], [(1, "x"), (2, "y"), (3, "z"), (4, "w")]),
    ],
)
def test_lines(spark, write, settings, columns, expected):
    table = read_csv(spark, write(LINES), **settings).rows
    assert table.columns == columns and sorted(rows(table)) == sorted(expected)


def test_lines_are_numbered_over_many_splits(spark, write):
    """Files of many input splits: line numbers go through each file in order."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        for name, first in (("d/a.csv", 0), ("d/b.csv", 5000)):
            path = write("n,text\n" + "".join(f"{first + i},{'x' * (i % 37)}{i}\n" for i in range(2000)), name)
        folder = path.rsplit("/", 1)[0]
        table = read_csv(spark, folder, skiprows=[5, 700, 1999], nrows=1500).rows
        assert spark.read.text(folder).rdd.getNumPartitions() > 20
        skipped = {4, 699, 1998}
        expected = [i for i in range(2000) if i not in skipped][:1500]
        assert sorted(r.n for r in table.select("n").collect()) == expected + [5000 + i for i in expected]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_chosen_columns_keep_file_order(spark, write):
    path = write("a,b,c\n1,2,3\n")
    assert rows(read_csv(spark, path, usecols=["c", "a"]).rows.select("*")) == [(1, 3)]
    assert read_csv(spark, path, usecols=["c", "a"], column_names=["x", "y"]).rows.columns == ["x", "y"]
    with pytest.raises(ValueError, match="no such columns"):
        read_csv(spark, path, usecols=["d"])
    with pytest.raises(ValueError, match="2 names for 3"):
        read_csv(spark, path, column_names=["x", "y"])


def test_forced_types(spark, write):
    path = write("a,b,c,d\n01,1,true,2024-01-02\nx,2,no,3/4/2024\n5,,false,\n")
    read = read_csv(spark, path, dtype={"a": "str", "b": "float64", "c": "bool", "d": "datetime64[ns]"})
    assert dict(read.rows.dtypes) == {"a": "string", "b": "double", "c": "boolean", "d": "timestamp_ntz"}
    assert rows(read.rows) == [("01", 1.0, True, datetime(2024, 1, 2)), ("5", None, False, None)]
    assert rows(read.rejects) == [("x,2,no,3/4/2024", "c: not bool")]
    with pytest.raises(ValueError, match="unknown dtype"):
        read_csv(spark, path, dtype={"a": "complex"})


def test_dates_all_or_nothing(spark, write):
    path = write("a,b,c,d\n2024-01-02,2024-01-02,1/2/2024,2024/01/02\n2024-01-02 03:04:05,soon,12/31/2024 10:00,NA\n")
    table = read_csv(spark, path, parse_dates=["a", "b", "c", "d"]).rows
    assert dict(table.dtypes) == {"a": "timestamp_ntz", "b": "string", "c": "timestamp_ntz", "d": "timestamp_ntz"}
    assert rows(table)[1] == (datetime(2024, 1, 2, 3, 4, 5), "soon", datetime(2024, 12, 31, 10), None)
    assert read_csv(spark, path, parse_dates=True).rows.dtypes[0] == ("a", "string")


def test_more_date_formats(spark, write):
    path = write("a;b;c;d\n02-Jan-2024;20240102;2 January 2024;January 2, 2024\n", "t.csv")
    table = read_csv(spark, path, delimiter=";", parse_dates=["a", "b", "c", "d"]).rows
    assert rows(table) == [(datetime(2024, 1, 2),) * 4]


def test_missing_texts(spark, write):
    path = write("a,b\n-,1\nNA,-\nn/a,2\nx,7\n\"\",3\n")
    assert rows(read_csv(spark, path, na_values=["-"]).rows) == [(None, 1), (None, None), (None, 2), ("x", 7), (None, 3)]
    assert rows(read_csv(spark, path, na_values={"b": ["-", "7"]}).rows)[3] == ("x", None)


def test_several_files(spark, write):
    paths = [write("a,b\n1,x\n", "one.csv"), write("a,b\n2,y\n", "two.csv")]
    assert sorted(rows(read_csv(spark, paths).rows)) == [(1, "x"), (2, "y")]
    assert sorted(rows(read_csv(spark, paths, nrows=1).rows)) == [(1, "x"), (2, "y")]


def test_empty_files(spark, write):
    with pytest.raises(ValueError, match="no columns"):
        read_csv(spark, write(""))
    with pytest.raises(ValueError, match="no columns"):
        read_csv(spark, write("a\n"), header=3)
    assert read_csv(spark, write("a,b\n")).rows.count() == 0


@pytest.mark.parametrize("name", ["f/*.csv", "f"])
@pytest.mark.parametrize("settings", [{}, {"multiline": False}, {"nrows": 5}, {"encoding": "utf-16"}])
def test_empty_files_beside_others_have_no_records(spark, write, tmp_path, name, settings):
    charset = settings.get("encoding", "utf-8")
    for n, text in enumerate(["", "1,x\n2,y\n", "\n\n", "3,z\n"]):
        write(text, f"f/{n}.csv", charset)
    read = read_csv(spark, str(tmp_path / name), header=None, **settings)
    assert sorted(rows(read.rows)) == [(1, "x"), (2, "y"), (3, "z")] and read.rejects.isEmpty()


def test_only_empty_files(spark, write, tmp_path):
    paths = [write("", "f/0.csv"), write("\n", "f/1.csv")]
    for path in (str(tmp_path / "f"), paths, [write("1,x\n", "g.csv"), paths[0]]):
        with pytest.raises(ValueError, match="no columns"):
            read_csv(spark, path, header=None)


@pytest.mark.parametrize("name", ["csv_header_none", "csv_split_rejects"])
def test_queries_with_an_empty_first_partition(spark, tmp_path, name):
    """One row group over several splits: only the split with its middle has rows, and Spark still writes a file for the first one."""
    rows = spark.range(500).selectExpr(
        "id AS c_custkey", "concat('Customer#', sha2(CAST(id AS STRING), 512)) AS c_name", "CAST(id % 25 AS INT) AS c_nationkey", "id / 4 AS c_acctbal", "'BUILDING' AS c_mktsegment"
    )
    rows.coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "customer.parquet"))
    known = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16000")
        found = queries()[name](spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", known)
    if name == "csv_header_none":
        assert sorted(found["a"]) == list(range(500)) and found["b"].str.startswith("Customer#").all()
    else:
        assert sorted(found.value_counts("problem").items()) == [("", 500), ("a quote is not closed", 50)]


@pytest.mark.parametrize("split", ["2000", "16000"])
def test_split_rejects_returns_every_row_of_many_splits(spark, tmp_path, split):
    """Splits without rows come first, of the only row group and of a file without rows; the text file written from it is split in records."""
    names = {i: f"Customer#{hashlib.sha512(str(i).encode()).hexdigest()}" for i in range(500)}
    rows = spark.createDataFrame(list(names.items()), "c_custkey long, c_name string").coalesce(1)
    for part in (rows.limit(0), rows):
        part.write.mode("append").option("compression", "none").parquet(str(tmp_path / "customer.parquet"))
    known = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        found = [tuple(r) for r in queries()["csv_split_rejects"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", known)
    broken = [i for i in names if i % 10 == 0]
    expected = [(str(i), name, "") for i, name in names.items() if i % 10] + [('2nd line"', None, "")] * len(broken)
    expected += [(f'{i},"{names[i]}', None, "a quote is not closed") for i in broken]
    assert Counter(found) == Counter(expected)


def test_only_wanted_columns_are_typed(spark, write):
    """One aggregate decides all types; forced columns need no pass over the file."""
    table = read_csv(spark, write("a,b\n1,2\n"), dtype={"a": "int64", "b": "int64"}).rows
    assert table.select(F.sum("a")).first()[0] == 1
