"""Field mappings: the declared types of an index, and the check of documents against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions.documents import clean_value, source_json

# Mapping type to Spark type.
TYPES = {
    "date": T.TimestampNTZType(),
    "keyword": T.StringType(),
    "text": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
}

# The ready-made sample mapping.
SAMPLE_MAPPING = {
    "properties": {
        "timestamp": {"type": "date", "format": "strict_date_optional_time||epoch_millis"},
        "id": {"type": "keyword"},
        "text_field": {"type": "text", "analyzer": "standard"},
        "numeric_field": {"type": "double"},
        "boolean_field": {"type": "boolean"},
    }
}

# The two date formats, as patterns.
ISO_DATE = r"^\d{4}(-\d{2}(-\d{2}(T\d{2}(:\d{2}(:\d{2}([.]\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?$"
EPOCH_MILLIS = r"^-?\d+$"
LAST_MILLI = 253402300799999
ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def sample_mapping() -> dict:
    return SAMPLE_MAPPING


def mapping_to_schema(mapping: dict) -> T.StructType:
    """The mapping as a ``StructType``; text analyzers and other search settings have no part in it."""
    fields = []
    for name, settings in mapping["properties"].items():
        if settings.get("type") not in TYPES:
            raise ValueError(f"field {name!r}: unknown mapping type {settings.get('type')!r}")
        fields.append(T.StructField(name, TYPES[settings["type"]]))
    return T.StructType(fields)


def date_multi_format(column: Column) -> Column:
    """ISO text or epoch milliseconds to a timestamp in UTC; null for anything else."""
    text = column.cast("string")
    # A zone counts only after a time of day; the end of 2024-01-02 is none.
    has_zone = text.contains("T") & text.rlike(ZONE)
    padded = F.regexp_replace(text, r"(T\d{2})(?=$|Z|[+-])", "$1:00")
    padded = F.regexp_replace(padded, r"(T\d{2}:\d{2})(?=$|Z|[+-])", "$1:00")
    padded = F.when(has_zone, F.regexp_replace(padded, r"([+-]\d{2})(\d{2})$", "$1:$2")).otherwise(padded)
    local = padded.try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    after_epoch = lambda seconds: epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    # By the instant: the session's wall time skips or repeats an hour twice a year.
    shifted = after_epoch(F.unix_micros(padded.try_cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000))
    millis = text.try_cast("bigint")
    since_epoch = after_epoch(F.when(F.abs(millis.try_cast("decimal(20,0)")) <= LAST_MILLI, millis / F.lit(1000)))
    return F.when(text.rlike(ISO_DATE), F.when(has_zone, shifted).otherwise(local)).when(
        text.rlike(EPOCH_MILLIS), since_epoch
    )


def _coerced(column: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """The value as the wanted type, null where it does not fit."""
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.lit(None).cast(wanted)
    if isinstance(wanted, T.TimestampNTZType):
        return column.cast(wanted) if isinstance(kind, T.TimestampNTZType) else date_multi_format(column)
    if isinstance(wanted, T.StringType):
        return clean_value(column, kind).cast("string")
    if isinstance(wanted, T.BooleanType):
        if isinstance(kind, T.BooleanType):
            return column
        text = column.cast("string")
        return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
    if isinstance(wanted, T.IntegralType):
        if isinstance(kind, T.IntegralType):
            return column.try_cast(wanted)
        # A fraction is cut off, as in 1.5 for an integer field.
        return F.coalesce(column.cast("string").try_cast(wanted), column.cast("string").try_cast("double").try_cast(wanted))
    if isinstance(kind, (T.BooleanType, T.TimestampNTZType, T.TimestampType)):
        return F.lit(None).cast(wanted)
    number = column.cast("string").try_cast(wanted) if isinstance(kind, T.StringType) else column.try_cast(wanted)
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def conform(documents: DataFrame, wanted: T.StructType, names: dict[str, str] | None = None) -> DataFrame:
    """Coerce the fields of ``_source`` to the wanted types and add ``_errors``, one entry per value that does not fit.

    Wanted fields that the documents lack become null; other fields pass as they are. A document without errors has an empty array; one with
    errors keeps its original text in ``_given``. ``names`` are the names of the types in errors. Errors that are there already stay.
    """
    present = {field.name: field.dataType for field in documents.schema["_source"].dataType}
    result, errors = {}, []
    for name, kind in present.items():
        value = F.col("_source")[name]
        if name not in wanted.names or wanted[name].dataType == kind:
            result[name] = value
            continue
        to = wanted[name].dataType
        nested = (T.ArrayType, T.StructType, T.MapType)
        if isinstance(to, nested):
            coerced = F.lit(None).cast(to)
            bad = value.isNotNull()
        elif isinstance(kind, T.ArrayType):
            coerced = F.transform(value, lambda item: _coerced(item, kind.elementType, to))
            bad = F.exists(value, lambda item: item.isNotNull() & _coerced(item, kind.elementType, to).isNull())
            bad = F.coalesce(bad, F.lit(False))
        else:
            coerced = _coerced(value, kind, to)
            bad = value.isNotNull() & coerced.isNull()
        result[name] = coerced
        shown = F.to_json(value) if isinstance(kind, nested) else value.cast("string")
        called = (names or {}).get(name, to.simpleString())
        errors.append(F.when(bad, F.struct(F.lit(name).alias("field"), F.lit(called).alias("type"), shown.alias("value"))))
    for field in wanted:
        if field.name not in present:
            result[field.name] = F.lit(None).cast(field.dataType)
    source = F.struct(*[column.alias(name) for name, column in result.items()])
    found = F.array_compact(F.array(*errors)) if errors else F.array()
    found = found.cast(ERRORS)
    given = F.when(F.size(found) > 0, source_json())
    if "_errors" in documents.columns:
        found = F.concat("_errors", found)
    if "_given" in documents.columns:
        given = F.coalesce("_given", given)
    return documents.withColumns({"_errors": found, "_given": given, "_source": source})


def apply_mapping(documents: DataFrame, mapping: dict) -> DataFrame:
    """Coerce ``_source`` to the mapping and add ``_errors``; see ``conform``."""
    names = {name: settings["type"] for name, settings in mapping["properties"].items()}
    return conform(documents, mapping_to_schema(mapping), names)


ERRORS = T.ArrayType(
    T.StructType([T.StructField(name, T.StringType()) for name in ("field", "type", "value")])
)


def split_accepted(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted documents, and rejected ones with their errors."""
    return checked.filter(F.size("_errors") == 0).drop("_errors", "_given"), checked.filter(F.size("_errors") > 0)
