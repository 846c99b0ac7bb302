"""Token counts of documents in flat token files without an index, by a scan for separators.

A token file is the ids of documents end to end, in fixed-width little-endian numbers, each document ended by ``end_id``. Files are
cut into blocks of equal bytes, wherever these fall. A task reads a block, and one vectorised comparison finds its separators. What
a block cannot know (how many documents ended before it, and where the last one did) is two prefix scans over the blocks of a file: a running sum of separator
counts and a running maximum of separator positions. A document's length is then the distance of its separator from the one before.

Files are read through ``pyarrow.fs`` from the folder that all executors share.

Defined results: a document without ids is a separator alone and has 0 tokens. Ids after the last separator of a file are a document that
isn't ``ended``. An empty file has no document. A file's length must be a multiple of the width; the rest of a last, cut-off number is not read.
Writing: null and empty texts are documents without ids; every row is a document, whether or not its ``doc_id`` repeats or is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgraph.llm.files import open_store, own_file
from docgraph.llm.text import slices, small_batches
from docgraph.llm.tokens import encoder_for, ranked_merges
from docgraph.plans.scratch import scratch_path, write_table

BLOCK_BYTES = 8 << 20
WIDTHS = {2: "<u2", 4: "<u4"}


def _writer(path: str, ranks: dict[bytes, int] | None, end_id: int, width: int, folder: str):
    """A task's documents to a token file of its own; returns which document stands where in the order of the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path, ranks, specials_are_text=True)
        out, name, at, written = None, "", 0, 0
        for part in slices(batches, "text"):
            if out is None:
                system, target, name = own_file(folder, ".bin")
                out = system.open_output_stream(target, compression=None)
            ids, offsets = encoder.encode(part.column("text"))
            if len(ids) and int(ids.max()) >= 1 << (8 * width):
                raise ValueError(f"ids of this tokenizer need more than {width} bytes")
            # Each text's ids move on by the number of separators before.
            flat = np.insert(ids, offsets[1:], np.uint32(end_id)).astype(WIDTHS[width])
            out.write(flat.tobytes())
            written += flat.nbytes
            n = part.num_rows
            columns = [part.column("doc_id").cast(pa.int64()), pa.array([name] * n, pa.string()), pa.array(np.arange(at, at + n)), pa.array([written] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "file", "ordinal", "bytes"])
            at += n
        if out is not None:
            out.close()

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 2) -> tuple[str, DataFrame]:
    """Write the documents (``doc_id``, ``text``) as token files of ``width`` bytes an id.

    Returns the folder and the order of the documents: ``doc_id``, ``file``, ``ordinal``, and ``bytes``, the length of the file up to some
    place after the document.
    """
    small_batches(docs.sparkSession)
    folder = scratch_path(docs.sparkSession, "tokens")
    writer = _writer(tokenizer_path, ranked_merges(tokenizer_path), end_id, width, folder)
    order = docs.select("doc_id", "text").mapInArrow(writer, "doc_id bigint, file string, ordinal bigint, bytes bigint")
    return folder, write_table(order, "order")


def _separators(folder: str, end_id: int, width: int, block_bytes: int):
    """For each block the positions (in ids, from the start of the file) of its separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_store(folder)
        for batch in batches:
            for file, block, size in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "bytes"))):
                start = block * block_bytes
                with system.open_input_file(f"{root}/{file}") as opened:
                    data = opened.read_at(min(block_bytes, size - start), start)
                found = np.flatnonzero(np.frombuffer(data, WIDTHS[width]) == end_id) + start // width
                columns = [pa.array([file], pa.string()), pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["file", "block", "bytes", "ends"])

    return run


def scan_token_files(folder: str, files: DataFrame, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file``, ``ordinal``, ``start`` (in ids), ``n_tokens`` (without the separator) and ``ended`` of every document in
    ``files`` (``file``, ``bytes``) of the folder."""
    spark = files.sparkSession
    block_bytes -= block_bytes % width
    whole = F.col("bytes") - F.col("bytes") % width
    blocks = files.filter(whole > 0).select("file", whole.alias("bytes"))
    blocks = blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("bytes") / block_bytes) - 1)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scan = _separators(folder, end_id, width, block_bytes)
    found = blocks.repartition(parts, "file", "block").mapInArrow(scan, "file string, block bigint, bytes bigint, ends array<bigint>")
    found = write_table(found, "separators")

    # The prefix scans: one row per block, however many documents it holds.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    carried = found.select("file", "block", F.size("ends").alias("count"), last.alias("last"))
    carried = carried.select("file", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ordinal"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"))
    ends = found.join(carried, ["file", "block"])
    starts = F.transform(F.concat(F.array("previous"), "ends"), lambda x: x + 1)
    each = ends.select("file", "ordinal", F.posexplode(F.arrays_zip(F.slice(starts, 1, F.size("ends")).alias("start"), F.col("ends").alias("end"))).alias("k", "of"))
    ended = each.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "of.start", (F.col("of.end") - F.col("of.start")).alias("n_tokens"), F.lit(True).alias("ended"))
    tails = found.groupBy("file").agg(F.sum(F.size("ends")).cast("long").alias("ordinal"), F.coalesce(F.max(last) + 1, F.lit(0)).alias("start"), F.max("bytes").alias("bytes"))
    left = F.col("bytes") / width - F.col("start")
    tails = tails.select("file", "ordinal", "start", left.cast("long").alias("n_tokens"), F.lit(False).alias("ended")).filter("n_tokens > 0")
    return ended.union(tails)


def token_counts(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of each document, counted in token files that are written for it."""
    folder, order = write_token_files(docs, tokenizer_path, end_id, width)
    files = order.groupBy("file").agg(F.max("bytes").alias("bytes"))
    found = scan_token_files(folder, files, end_id, width, block_bytes)
    return order.select("doc_id", "file", "ordinal").join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")
