"""Complete imports: scan, create the index, clean and check the rows, write, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from docgraph.functions.documents import prepare_documents
from docgraph.functions.mapping import ERRORS, apply_mapping, mapping_to_schema
from docgraph.sinks.index import Load, bulk_index, create_index, index_mapping
from docgraph.sources import csv, parquet


def _load(
    rows: DataFrame,
    root: str,
    index_name: str,
    doc_id_column: str | None,
    chunk_size: int | None,
    mapping: dict | None,
    mode: str,
    position: list[str],
    extra: list[str],
) -> Load:
    spark = rows.sparkSession
    create_index(spark, root, index_name, mapping)
    # An index that already exists keeps its mapping; a new one given here has no effect.
    in_force = index_mapping(spark, root, index_name)
    # Timestamps that become date fields need no way through text.
    dates = {f.name for f in mapping_to_schema(in_force) if isinstance(f.dataType, TimestampNTZType)} if in_force else set()
    dates &= {f.name for f in rows.schema if isinstance(f.dataType, TimestampNTZType)}
    # A column without values declares no type.
    declared = mapping_to_schema(in_force).names if in_force else []
    rows = rows.drop(*[f.name for f in rows.schema if f.metadata.get("empty") and f.name not in declared])
    documents = prepare_documents(rows, index_name, doc_id_column, keep=[*position, *extra], as_is=dates)
    if in_force:
        documents = apply_mapping(documents, in_force)
    if extra:
        known = F.col("_errors") if in_force else F.array().cast(ERRORS)
        unread = F.struct(F.lit(None), F.col(csv.PROBLEM), F.col(csv.RAW))
        unread = F.array(unread).cast(ERRORS)
        given = F.col("_given") if in_force else F.lit(None).cast("string")
        lost = F.col(csv.PROBLEM).isNotNull()
        documents = documents.withColumns(
            {"_errors": F.when(lost, unread).otherwise(known), "_given": F.when(lost, F.col(csv.RAW)).otherwise(given)}
        )
    return bulk_index(documents, root, index_name, position, chunk_size, mode)


def import_parquet(
    spark: SparkSession,
    paths: str | list[str],
    root: str,
    index_name: str,
    doc_id_column: str | None = None,
    chunk_size: int | None = None,
    mapping: dict | None = None,
    mode: str = "collect",
) -> Load:
    """Import one or more Parquet files into an index."""
    rows = parquet.read_parquet(spark, paths, position=True)
    return _load(rows, root, index_name, doc_id_column, chunk_size, mapping, mode, parquet.POSITION, [])


def import_csv(
    spark: SparkSession,
    paths: str | list[str],
    root: str,
    index_name: str,
    doc_id_column: str | None = None,
    chunk_size: int | None = None,
    mapping: dict | None = None,
    mode: str = "collect",
    **settings,
) -> Load:
    """Import one or more delimited files into an index; ``settings`` as for ``read_csv``."""
    rows = csv.parse_csv(spark, paths, position=True, **settings)
    extra = [csv.RAW, csv.PROBLEM]
    return _load(rows, root, index_name, doc_id_column, chunk_size, mapping, mode, csv.POSITION, extra)
