"""Loads into an index, and whole imports."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.functions.documents import prepare_documents
from docgraph.plans.imports import import_csv, import_parquet
from docgraph.sinks import index

MAPPING = {"properties": {"id": {"type": "integer"}, "name": {"type": "text"}, "value": {"type": "double"}, "at": {"type": "date"}}}


def _docs(spark, rows, key="id", layout="id long, v string"):
    return prepare_documents(spark.createDataFrame(rows, layout), "i", key)


def _content(spark, root, name="i"):
    return {r._id: r._source.v for r in index.index_scan(spark, root, name).collect()}


def test_create_keeps_the_first_mapping(spark, tmp_path):
    root = str(tmp_path)
    assert index.create_index(spark, root, "i", MAPPING) and index.create_index(spark, root, "i", {"properties": {}})
    assert index.index_mapping(spark, root, "i") == MAPPING
    empty = index.index_scan(spark, root, "i")
    assert empty.count() == 0 and empty.schema["_source"].dataType.names == ["id", "name", "value", "at"]
    assert index.index_info(spark, root, "i").first()[:4] == ("i", 0, 0, "exists")
    with pytest.raises(ValueError, match="no such index"):
        index.index_scan(spark, root, "other")
    info = index.index_info(spark, root, "other").first()
    assert info.status == "error" and info.document_count is None


def test_upsert(spark, tmp_path):
    root = str(tmp_path)
    index.bulk_index(_docs(spark, [(1, "a"), (2, "b")]), root, "i")
    index.bulk_index(_docs(spark, [(3, "c")]), root, "i")
    before = list(index.IndexFolder(spark, root, "i").manifest()["segments"])
    index.bulk_index(_docs(spark, [(2, "B"), (4, "d")]), root, "i")
    assert _content(spark, root) == {"1": "a", "2": "b".upper(), "3": "c", "4": "d"}
    after = list(index.IndexFolder(spark, root, "i").manifest()["segments"])
    # The segment with key 2 was written anew, the other one was not touched.
    assert before[1] in after and before[0] not in after and len(after) == 3
    assert index.index_info(spark, root, "i").first().document_count == 4


def test_info_reads_no_segment(spark, tmp_path):
    """Counts come from the manifest, whatever loads and upserts have written; a manifest without them is counted."""
    root = str(tmp_path)
    index.bulk_index(_docs(spark, [(1, "a"), (2, "b"), (2, "c"), (5, "x")]), root, "i")
    index.bulk_index(_docs(spark, [(3, "c")]), root, "i")
    index.bulk_index(_docs(spark, [(2, "B"), (4, "d")]), root, "i")
    info = index.index_info(spark, root, "i")
    assert "FileScan" not in info._jdf.queryExecution().toString()
    folder = index.IndexFolder(spark, root, "i")
    state = folder.manifest()
    sizes = [f.stat().st_size for s in state["segments"] for f in (tmp_path / "i" / "segments" / s.rsplit("/", 1)[1]).glob("*.parquet")]
    assert tuple(info.first()[:4]) == ("i", 5, sum(sizes), "exists") and index.index_scan(spark, root, "i").count() == 5
    segments = {p: index.StructType.fromJson(fields) for p, fields in state["segments"].items()}
    folder.commit(state["version"] + 1, None, segments, index.StructType.fromJson(state["schema"]))
    assert tuple(index.index_info(spark, root, "i").first()) == tuple(info.first())


def test_last_of_equal_keys_wins_by_order(spark, tmp_path):
    root = str(tmp_path)
    # One key holds a third of all rows.
    df = spark.range(900).selectExpr("IF(id % 3 = 0, 7, id + 1000) AS id", "id AS pos", "CAST(id AS STRING) AS v").repartition(6)
    docs = prepare_documents(df, "i", "id", keep=["pos"])
    load = index.bulk_index(docs, root, "i", order=["pos"])
    assert load.stats.first() == (900, 900, 0)
    content = _content(spark, root)
    assert len(content) == 601 and content["7"] == "897"


def test_documents_without_key_always_add(spark, tmp_path):
    root = str(tmp_path)
    docs = _docs(spark, [(None, "a"), (None, "b"), (5, "c"), (5, "d")])
    index.bulk_index(docs, root, "i")
    index.bulk_index(docs, root, "i")
    assert sorted(_content(spark, root).values()) == ["a", "a", "b", "b", "d"]


def test_loads_of_other_types(spark, tmp_path):
    """Fields are added, whole numbers widen, values convert, and a document that does not fit is rejected alone."""
    root = str(tmp_path)
    index.bulk_index(_docs(spark, [(1, 4)], layout="id long, v long"), root, "i")
    index.bulk_index(_docs(spark, [(2, 1.5, "x")], layout="id long, v double, w string"), root, "i")
    load = index.bulk_index(_docs(spark, [(3, "7", 8), (4, "much", 9)], layout="id long, v string, w long"), root, "i")
    got = {r._id: (r._source.v, r._source.w) for r in index.index_scan(spark, root, "i").collect()}
    assert got == {"1": (4.0, None), "2": (1.5, "x"), "3": (7.0, "8")}
    reject = load.rejects.first()
    assert (reject._id, [tuple(e) for e in reject.errors]) == ("4", [("v", "double", "much")])
    index.bulk_index(_docs(spark, [(1, [1])], layout="id long, z array<long>"), root, "i")
    load = index.bulk_index(_docs(spark, [(9, "t")], layout="id long, z string"), root, "i")
    assert load.stats.first() == (1, 0, 1) and index.index_scan(spark, root, "i").count() == 3


def test_equal_places_leave_one_document(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(90).selectExpr("id % 3 AS id", "0 AS pos", "CAST(id AS STRING) AS v").repartition(4)
    index.bulk_index(prepare_documents(df, "i", "id", keep=["pos"]), root, "i", order=["pos"])
    assert sorted(_content(spark, root)) == ["0", "1", "2"] and index.index_scan(spark, root, "i").count() == 3


def test_old_states_can_be_removed(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        index.bulk_index(_docs(spark, [(1, str(n)), (10 + n, "x")]), root, "i")
    index.remove_old(spark, root, "i")
    assert len(list((tmp_path / "i" / "manifests").glob("[0-9]*"))) == 1
    state = index.IndexFolder(spark, root, "i").manifest()
    assert len(list((tmp_path / "i" / "segments").iterdir())) == len(state["segments"])
    assert _content(spark, root) == {"1": "2", "10": "x", "11": "x", "12": "x"}


def test_chunks_and_bulk_files(spark, tmp_path):
    root = str(tmp_path)
    docs = prepare_documents(spark.range(50).coalesce(1).selectExpr("id", "CAST(NULL AS STRING) AS v"), "i", "id")
    index.bulk_index(docs, root, "i", chunk_size=10)
    files = list((tmp_path / "i" / "segments").glob("*/part-*.parquet"))
    assert len(files) == 5
    index.bulk_ndjson(docs, f"{root}/bulk", chunk_size=20)
    bodies = [f.read_text().splitlines() for f in sorted((tmp_path / "bulk").glob("part-*"))]
    assert sorted(len(b) for b in bodies) == [20, 40, 40]
    pairs = [(json.loads(a), json.loads(s)) for b in bodies for a, s in zip(b[::2], b[1::2])]
    assert sorted(p[1]["id"] for p in pairs) == list(range(50))
    assert all(p == ({"index": {"_index": "i", "_id": str(p[1]["id"])}}, {"id": p[1]["id"], "v": None}) for p in pairs)


def test_keyless_load_is_only_written(spark, tmp_path, monkeypatch):
    """Documents without keys replace nothing: what was written is not read again, and columns that no document has are not written."""
    root = str(tmp_path)
    index.bulk_index(_docs(spark, [(1, "a")]), root, "i")
    jobs, own = [], DataFrame.isEmpty
    monkeypatch.setattr(DataFrame, "isEmpty", lambda self: jobs.append("isEmpty") or own(self))
    monkeypatch.setattr(index, "_without", lambda *given: jobs.append("_without"))
    load = index.bulk_index(_docs(spark, [(n, "b") for n in range(25)], key=None), root, "i", chunk_size=10)
    assert jobs == [] and load.stats.first() == (25, 25, 0) and load.rejects.count() == 0
    found = index.index_scan(spark, root, "i")
    assert sorted(tuple(r["_source"]) for r in found.collect()) == sorted([(1, "a")] + [(n, "b") for n in range(25)])
    assert found.select("_id").distinct().count() == 26 and index.index_info(spark, root, "i").first().document_count == 26
    state = index.IndexFolder(spark, root, "i").manifest()
    written = spark.read.parquet(list(state["segments"])[-1]).columns
    assert not {"_rejected", "_errors", "_file"} & set(written)


def test_keyless_load_with_rejects(spark, tmp_path):
    root = str(tmp_path)
    index.bulk_index(_docs(spark, [(1, 4)], layout="id long, v long"), root, "i")
    load = index.bulk_index(_docs(spark, [(2, "x"), (3, "5")], layout="id long, v string", key=None), root, "i", chunk_size=1)
    assert load.stats.first() == (2, 1, 1) and load.rejects.count() == 1
    assert sorted(tuple(r["_source"]) for r in index.index_scan(spark, root, "i").collect()) == [(1, 4), (3, 5)]
    load = index.bulk_index(_docs(spark, [(2, "x")], layout="id long, v string"), root, "i")
    assert load.stats.first() == (1, 0, 1) and index.index_scan(spark, root, "i").count() == 2


def test_keyless_bulk_action_has_no_id(spark, tmp_path):
    index.bulk_ndjson(_docs(spark, [(1, "a")], key=None), str(tmp_path / "b"))
    lines = [line for f in (tmp_path / "b").glob("part-*") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"index": {"_index": "i"}}, {"id": 1, "v": "a"}]


@pytest.fixture
def parquet(spark, tmp_path):
    def write(name, rows, layout="id long, name string, value string, at timestamp_ntz"):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, layout).coalesce(1).write.parquet(path)
        return path

    return write


def test_import_parquet_with_mapping(spark, tmp_path, parquet):
    path = parquet("in", [(1, "a", "1.5", None), (2, "b", "much", None), (3, None, None, None)])
    root = str(tmp_path / "root")
    load = import_parquet(spark, path, root, "i", "id", mapping=MAPPING)
    assert load.stats.first() == (3, 2, 1)
    reject = load.rejects.first()
    assert reject._id == "2" and json.loads(reject._source)["value"] == "much"
    assert [(e.field, e.value) for e in reject.errors] == [("value", "much")]
    assert load.error_head().count() == 1
    got = {r._id: r._source.value for r in index.index_scan(spark, root, "i").collect()}
    assert got == {"1": 1.5, "3": None}


def test_failfast_leaves_the_index(spark, tmp_path, parquet):
    root = str(tmp_path / "root")
    import_parquet(spark, parquet("good", [(1, "a", "1", None)]), root, "i", "id", mapping=MAPPING)
    with pytest.raises(ValueError, match="1 documents rejected"):
        import_parquet(spark, parquet("bad", [(1, "b", "x", None)]), root, "i", "id", mode="failfast")
    assert [r._source.name for r in index.index_scan(spark, root, "i").collect()] == ["a"]
    assert len(list((tmp_path / "root" / "i" / "segments").iterdir())) == 1


def test_files_count_in_list_order(spark, tmp_path):
    root, paths = str(tmp_path / "root"), []
    for name, value in (("z 1", "first"), ("a", "second")):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"id,v\n1,{value}\n2,{name}\n3\n4,5,6\n")
        paths.append(str(path))
    load = import_csv(spark, paths, root, "i", "id")
    content = {r._id: r._source.v for r in index.index_scan(spark, root, "i").collect()}
    assert content == {"1": "second", "2": "a", "3": None}
    assert load.stats.first() == (8, 6, 2)
    by_file = {None if r.is_total else r.file.rsplit("/", 1)[1]: (r.total_documents, r.successful, r.failed) for r in load.batch_stats.collect()}
    assert by_file == {"z%201.csv": (4, 3, 1), "a.csv": (4, 3, 1), None: (8, 6, 2)}
    assert {(r._source, r.errors[0].type) for r in load.rejects.collect()} == {("4,5,6", "more than 2 fields")}


def test_folders_count_in_list_order(spark, tmp_path, parquet):
    paths = [parquet(name, [(1, name, None, datetime(2024, 1, n + 1))]) for n, name in enumerate(["z", "a", "m"])]
    root = str(tmp_path / "root")
    import_parquet(spark, paths, root, "i", "id", mapping=MAPPING)
    got = index.index_scan(spark, root, "i").first()
    assert got._source.name == "m" and got._source["at"] == datetime(2024, 1, 3)


def test_import_csv_with_all_options(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("# top\nthe.id|name|value|at\n1|a|-|2024-01-02\n2|b|2|2024-01-03\n2|c|3|2024-01-04\n")
    load = import_csv(
        spark, str(path), str(tmp_path / "r"), "i", "the_id", delimiter="|", skiprows=1, na_values=["-"], replace_dots=True,
        parse_dates=["at"], mapping={"properties": {"at": {"type": "date"}, "the_id": {"type": "keyword"}}},
    )
    got = {r._id: (r._source.name, r._source.value, str(r._source["at"])) for r in index.index_scan(spark, str(tmp_path / "r"), "i").collect()}
    assert got == {"1": ("a", None, "2024-01-02 00:00:00"), "2": ("c", 3, "2024-01-04 00:00:00")}
    assert load.stats.first() == (3, 3, 0)


def test_a_load_based_on_an_older_state_fails(spark, tmp_path):
    root = str(tmp_path)
    index.bulk_index(_docs(spark, [(1, "a")]), root, "i")
    folder = index.IndexFolder(spark, root, "i")
    state = folder.manifest()
    with pytest.raises(Exception, match="exists"):
        folder.commit(state["version"], None, {}, None)


def test_scan_reads_only_wanted_fields(spark, tmp_path):
    index.bulk_index(_docs(spark, [(1, "a")]), str(tmp_path), "i")
    plan = index.index_scan(spark, str(tmp_path), "i").select(F.col("_source.v"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_source:struct<v:string>,_rejected:string>" in plan
