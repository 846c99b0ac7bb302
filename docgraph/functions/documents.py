"""Rows to JSON-able documents: one ``select`` built from the schema, no Python per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose values pass unchanged.
PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def iso_text(column: Column, zoned: bool) -> Column:
    """ISO 8601 text: six fraction digits, or none if the fraction is zero."""
    if zoned:
        return F.replace(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"), F.lit(".000000"), F.lit(""))
    # Formatting a time without zone would take it for one of the session's zone, where it need not exist.
    text = F.replace(column.cast("string"), F.lit(" "), F.lit("T"))
    fraction = F.rpad(F.substring_index(text, ".", -1), 6, "0")
    return F.when(text.contains("."), F.concat_ws(".", F.substring_index(text, ".", 1), fraction)).otherwise(text)


def _is_plain(kind: T.DataType) -> bool:
    """Whether no value of the type needs any change."""
    if isinstance(kind, T.ArrayType):
        return _is_plain(kind.elementType)
    if isinstance(kind, T.MapType):
        return isinstance(kind.keyType, T.StringType) and _is_plain(kind.valueType)
    if isinstance(kind, T.StructType):
        return all(_is_plain(field.dataType) for field in kind)
    return isinstance(kind, PLAIN)


def clean_value(column: Column, kind: T.DataType) -> Column:
    """A value as it may stand in a document.

    NaN and the infinities become null, timestamps ISO text, binary base64 text; arrays, maps and
    structs are cleaned inside; dates, decimals, intervals and anything else become text.
    """
    if _is_plain(kind):
        return column
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        finite = ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))
        return F.when(finite, column.cast("double"))
    if isinstance(kind, T.TimestampNTZType):
        return iso_text(column, zoned=False)
    if isinstance(kind, T.TimestampType):
        return iso_text(column, zoned=True)
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: clean_value(item, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                # A key that has no clean value, like NaN, stays as its text.
                F.coalesce(clean_value(e["key"], kind.keyType).cast("string"), e["key"].cast("string")).alias("key"),
                clean_value(e["value"], kind.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    if isinstance(kind, T.StructType):
        fields = [clean_value(column[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column.cast("string")


def prepare_documents(
    df: DataFrame,
    index_name: str,
    doc_id_column: str | None = None,
    keep: Iterable[str] = (),
    as_is: Iterable[str] = (),
) -> DataFrame:
    """``(_index, _id, _source)`` for every row.

    ``_id`` is the text of the id column; it is null where that is null, and for all documents if
    there is no such column. ``keep`` names further columns, such as an order, left out of ``_source``;
    ``as_is`` names fields that stay uncleaned.
    """
    source = [
        (quoted(f.name) if f.name in as_is else clean_value(quoted(f.name), f.dataType)).alias(f.name)
        for f in df.schema
        if f.name not in keep
    ]
    doc_id = F.lit(None).cast("string")
    if doc_id_column in df.columns:
        doc_id = clean_value(quoted(doc_id_column), df.schema[doc_id_column].dataType).cast("string")
    return df.select(
        F.lit(index_name).alias("_index"), doc_id.alias("_id"), F.struct(*source).alias("_source"), *map(quoted, keep)
    )


def source_json(column: str = "_source") -> Column:
    """The document as JSON text; null fields stay explicit."""
    return F.to_json(column, {"ignoreNullFields": "false"})
