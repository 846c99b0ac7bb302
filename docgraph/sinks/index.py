"""Named document collections in a folder.

An index is a folder of segments, each a Parquet folder written once and never changed, and of
numbered manifests, each a small text file that lists the segments in force with their fields, accepted documents and bytes. A load writes its
segments first, then the next manifest aside, and renames it into place; readers see the old or the new state. Two loads that
finish at the same time cannot both take the same number: the second fails and can be repeated.

A field keeps the type of its first value; only whole numbers become doubles when a fraction comes. Values of another type are converted,
and a document with a value that doesn't convert is rejected. A field that has had no value yet has no type.
"""

from __future__ import annotations

import functools
import json
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from docgraph.functions.documents import source_json
from docgraph.functions.mapping import ERRORS, conform, mapping_to_schema
from docgraph.plans.scratch import remove_path, write_table


REJECTED = "_rejected"


class IndexFolder:
    """The manifests and segments of one index."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self.path = f"{root.rstrip('/')}/{name}"
        self._jvm = spark._jvm
        self._files = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _versions(self) -> list[int]:
        folder = self._hadoop(f"{self.path}/manifests")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def manifest(self) -> dict | None:
        versions = self._versions()
        if not versions:
            return None
        stream = self._files.open(self._hadoop(f"{self.path}/manifests/{versions[-1]:09d}"))
        try:
            return {"version": versions[-1], **json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))}
        finally:
            stream.close()

    def commit(
        self, version: int, mapping: dict | None, segments: dict[str, StructType], schema: StructType | None, documents: dict[str, int] | None = None
    ) -> None:
        """Write the next manifest; ``documents`` are the accepted documents of segments, where they were counted."""
        counts = {p: [n, self._files.getContentSummary(self._hadoop(p)).getLength()] for p, n in (documents or {}).items() if p in segments}
        state = {"mapping": mapping, "segments": {p: s.jsonValue() for p, s in segments.items()}, "schema": schema and schema.jsonValue(), "counts": counts}
        aside = self._files.makeQualified(self._hadoop(f"{self.path}/manifests/.{uuid4().hex}"))
        stream = self._files.create(aside, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        # A rename that does not replace: the number is taken once.
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(aside, self._files.makeQualified(self._hadoop(f"{self.path}/manifests/{version:09d}")), no_options)
        except Exception:
            self._files.delete(aside, False)
            raise

    def new_segment(self) -> str:
        return f"{self.path}/segments/{uuid4().hex}"

    def read(self, segments: dict[str, StructType], schema: StructType) -> DataFrame:
        """The accepted documents of some segments, with the fields of ``schema``.

        A segment as first written also holds the rejected documents, as text in a column of their
        own; it is null for accepted ones, and absent in segments written anew.
        """
        alike: dict[str, list[str]] = {}
        for path, fields in segments.items():
            alike.setdefault(fields.json(), []).append(path)
        frames = []
        for fields, paths in alike.items():
            own = StructType.fromJson(json.loads(fields))
            layout = [StructField("_id", StringType()), StructField("_source", own), StructField(REJECTED, StringType())]
            rows = self.spark.read.schema(StructType(layout)).parquet(*paths).filter(F.col(REJECTED).isNull()).drop(REJECTED)
            if own != schema:
                known = {f.name: F.col("_source")[f.name] for f in own}
                source = F.struct(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
                rows = rows.withColumn("_source", source)
            frames.append(rows)
        if not frames:
            return self.spark.createDataFrame([], StructType([StructField("_id", StringType()), StructField("_source", schema)]))
        return functools.reduce(DataFrame.unionByName, frames)


def _source_schema(state: dict) -> StructType:
    if state["schema"]:
        return StructType.fromJson(state["schema"])
    return mapping_to_schema(state["mapping"]) if state["mapping"] else StructType([])


def _segments(state: dict) -> dict[str, StructType]:
    return {path: StructType.fromJson(fields) for path, fields in state["segments"].items()}


def _merged(old: StructType | None, new: StructType) -> StructType:
    """All fields of both; a field keeps its type, but whole numbers next to fractions become doubles."""
    fields = {f.name: f.dataType for f in old or []}
    for f in new:
        known = fields.setdefault(f.name, f.dataType)
        if isinstance(known, LongType) and isinstance(f.dataType, DoubleType):
            fields[f.name] = f.dataType
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def create_index(spark: SparkSession, root: str, name: str, mapping: dict | None = None) -> bool:
    """Create the index if it is missing; an existing one keeps its mapping. Always true."""
    folder = IndexFolder(spark, root, name)
    if folder.manifest() is None:
        if mapping:
            mapping_to_schema(mapping)
        folder.commit(1, mapping, {}, None)
    return True


def index_mapping(spark: SparkSession, root: str, name: str) -> dict | None:
    state = IndexFolder(spark, root, name).manifest()
    return state and state["mapping"]


def index_scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The documents of an index: ``_id`` and ``_source``."""
    folder = IndexFolder(spark, root, name)
    state = folder.manifest()
    if state is None:
        raise ValueError(f"no such index: {name}")
    return folder.read(_segments(state), _source_schema(state))


def index_info(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Name, document count, bytes on disk and status; a missing index is reported, not raised."""
    folder = IndexFolder(spark, root, name)
    state = folder.manifest()
    layout = "index_name string, document_count long, size_in_bytes long, status string, error string"
    if state is None:
        return spark.createDataFrame([(name, None, None, "error", f"no such index: {name}")], layout)
    counts = state.get("counts", {})
    known = [sum(counts[p][k] for p in state["segments"] if p in counts) for k in (0, 1)]
    uncounted = {p: fields for p, fields in _segments(state).items() if p not in counts}
    if not uncounted:
        return spark.createDataFrame([(name, *known, "exists", None)], layout)
    # Manifests of an older kind don't tell the counts.
    count = (F.count(F.lit(1)) + known[0]).alias("document_count")
    counted = folder.read(uncounted, _source_schema(state)).agg(count)
    parts = counted.withColumn("size_in_bytes", F.lit(known[1]).cast(LongType()))
    # Only the listing is read: the content column is never selected.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(uncounted))
    size = F.sum("length").alias("size_in_bytes")
    parts = parts.unionByName(files.agg(size).withColumn("document_count", F.lit(0).cast(LongType())))
    return parts.agg(
        F.lit(name).alias("index_name"),
        F.sum("document_count").alias("document_count"),
        F.sum("size_in_bytes").alias("size_in_bytes"),
        F.lit("exists").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


class Load:
    """The written result of one load: statistics and rejected documents, read back from its files."""

    def __init__(self, staged: DataFrame):
        self._staged = staged

    @property
    def stats(self) -> DataFrame:
        return self._staged.agg(*_tallies())

    @property
    def batch_stats(self) -> DataFrame:
        """Statistics per input file, and in total: the row that ``is_total``."""
        tallies = self._staged.rollup("_file").agg(*_tallies(), (F.grouping("_file") == 1).alias("is_total"))
        return tallies.withColumnRenamed("_file", "file")

    @property
    def rejects(self) -> DataFrame:
        rejected = self._staged.filter(F.col(REJECTED).isNotNull())
        return rejected.select("_id", F.col(REJECTED).alias("_source"), F.col("_errors").alias("errors"))

    def error_head(self, n: int = 5) -> DataFrame:
        return self.rejects.orderBy("_id", "_source").limit(n)


def _tallies() -> list:
    return [
        F.count(F.lit(1)).alias("total_documents"),
        F.count_if(F.col(REJECTED).isNull()).alias("successful"),
        F.count_if(F.col(REJECTED).isNotNull()).alias("failed"),
    ]


def bulk_index(
    documents: DataFrame,
    root: str,
    name: str,
    order: list[str] | None = None,
    chunk_size: int | None = None,
    mode: str = "collect",
) -> Load:
    """Write documents to an index; a known ``_id`` replaces the earlier document.

    ``documents`` has ``_id`` and ``_source``, and may have ``_errors`` (documents with errors are
    rejected) and ``_file``. Among documents with the same ``_id`` the last by ``order`` wins, and of equally late ones the last
    by a number written with them. Fields are converted to the types that the index has, see above.
    ``chunk_size`` limits the records per written file. ``mode="failfast"`` raises on any rejected
    document and leaves the index as it was.
    """
    spark = documents.sparkSession
    folder = IndexFolder(spark, root, name)
    create_index(spark, root, name)
    state = folder.manifest()
    old_schema = StructType.fromJson(state["schema"]) if state["schema"] else None
    fields = StructType([StructField(f.name, f.dataType) for f in documents.schema["_source"].dataType])
    schema = _merged(old_schema, fields)
    own = StructType([f for f in schema if f.name in fields.names])
    if own != fields:
        documents = conform(documents, own)
        documents = documents.withColumn("_source", F.struct(*[F.col("_source")[f.name].alias(f.name) for f in own]))

    errors = F.col("_errors") if "_errors" in documents.columns else F.array().cast(ERRORS)
    rejected = F.size(errors) > 0
    place = F.struct(*(order or []), F.monotonically_increasing_id().alias("_written"))
    staged_path = folder.new_segment()
    limit = {"maxRecordsPerFile": chunk_size} if chunk_size else {}
    # One write for accepted and rejected documents, so that the input is read once.
    staged = documents.select(
        F.coalesce("_id", F.uuid()).alias("_id"),
        F.when(~rejected, F.col("_source")).alias("_source"),
        F.when(rejected, F.col("_given") if "_given" in documents.columns else source_json()).alias(REJECTED),
        errors.alias("_errors"),
        (F.col("_file") if "_file" in documents.columns else F.lit(None).cast("string")).alias("_file"),
        F.col("_id").isNotNull().alias("_keyed"),
        F.when(F.col("_id").isNotNull(), place).alias("_place"),
    )
    seen = Observation()
    good = F.col(REJECTED).isNull()
    seen_rows = staged.observe(seen, F.count_if(good).alias("rows"), F.count_if(good & F.col("_keyed")).alias("keyed"))
    # Columns that the documents do not have are not written; they are read back as null.
    absent = ([] if "_errors" in documents.columns else [REJECTED, "_errors"]) + ([] if "_file" in documents.columns else ["_file"])
    seen_rows.drop(*absent).write.options(**limit).parquet(staged_path)
    documents_of = {p: n for p, (n, _) in state.get("counts", {}).items()}
    documents_of[staged_path] = seen.get["rows"]
    staged = spark.read.schema(staged.schema).parquet(staged_path)
    load = Load(staged)
    if mode == "failfast":
        failed = load.rejects.count()
        if failed:
            remove_path(spark, staged_path)
            raise ValueError(f"{failed} documents rejected")

    segments, new = _segments(state), staged_path
    accepted = staged.filter(F.col(REJECTED).isNull())
    keyed = accepted.filter("_keyed")
    last = keyed.groupBy("_id").agg(F.max("_place").alias("_place"), F.count(F.lit(1)).alias("_n"))
    # Documents without a key replace nothing.
    if seen.get["keyed"]:
        last = write_table(last, "last") if segments else last
        if not last.filter(F.col("_n") > 1).isEmpty():
            new = folder.new_segment()
            # Joined on key and place together, a key with many documents spreads over all tasks.
            kept = keyed.join(last.drop("_n"), ["_id", "_place"], "left_semi").unionByName(accepted.filter("not _keyed"))
            documents_of[new] = _write_counted(kept.select("_id", "_source"), new, limit)
        if segments:
            segments = _without(folder, segments, schema, last.select("_id"), limit, documents_of)
    if documents_of[staged_path]:
        segments[new] = StructType([f for f in own])
    folder.commit(state["version"] + 1, state["mapping"], segments, schema, documents_of)
    return load


def _write_counted(df: DataFrame, path: str, limit: dict) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**limit).parquet(path)
    return seen.get["rows"]


def _without(
    folder: IndexFolder, segments: dict[str, StructType], schema: StructType, ids: DataFrame, limit: dict, documents_of: dict[str, int]
) -> dict[str, StructType]:
    """The segments without the given keys: those that hold one of them are written anew, as one segment and by one job. What is written is counted."""
    layout = f"_id string, {REJECTED} string"
    stored = folder.spark.read.schema(layout).parquet(*segments).filter(F.col(REJECTED).isNull())
    stored = stored.select("_id", F.regexp_extract("_metadata.file_path", r"segments/([0-9a-f]+)", 1).alias("segment"))
    # At most one row per segment.
    touched = {row["segment"] for row in stored.join(ids, "_id", "left_semi").select("segment").distinct().collect()}
    hit = {p: s for p, s in segments.items() if p.split("segments/")[1].split("/")[0] in touched}
    kept = {p: s for p, s in segments.items() if p not in hit}
    if hit:
        rewritten = folder.new_segment()
        documents_of[rewritten] = _write_counted(folder.read(hit, schema).join(ids, "_id", "left_anti"), rewritten, limit)
        kept[rewritten] = schema
    return kept


def remove_old(spark: SparkSession, root: str, name: str) -> None:
    """Delete the segments and manifests that the newest manifest does not need; readers of older states and running loads
    must have ended."""
    folder = IndexFolder(spark, root, name)
    state = folder.manifest()
    if state is None:
        return
    needed = {path.rsplit("/", 1)[1] for path in state["segments"]} | {f"{state['version']:09d}"}
    for part in ("segments", "manifests"):
        path = folder._hadoop(f"{folder.path}/{part}")
        for status in folder._files.listStatus(path) if folder._files.exists(path) else []:
            if status.getPath().getName() not in needed:
                folder._files.delete(status.getPath(), True)


def bulk_ndjson(documents: DataFrame, path: str, chunk_size: int = 1000) -> None:
    """The documents as bulk request bodies: an action line and a source line each, ``chunk_size``
    documents per file."""
    action = F.to_json(F.struct(F.struct("_index", "_id").alias("index")))
    lines = F.concat_ws("\n", action, source_json())
    documents.select(lines.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", chunk_size).text(path)
