"""Delimited files to typed tables, with the options of the usual single-machine CSV reader.

Every file is read by its own header; columns are matched by name, and a column that a file lacks is null there. Files, folders and
globs count in the caller's order, and what is listed twice is read twice. A file without records is left out; if all that a name stands for are, it is
an error.

Large files are split, and a quoted field may hold line breaks: see ``quotes``. A quote that is not closed rejects its line; the lines after it are read
one by one. With ``multiline=False`` each line is a record. ``nrows``, ``skiprows`` and header rows other than the first number the records of each file:
they are counted per input split, and the counts turned into offsets. Blank lines count for ``skiprows`` only. Only files in a character set in which a
line break isn't the byte 10 (UTF-16, UTF-32) are read by one task each.

The records are parsed once and written as texts of the wanted columns; inference and the typed result read these. Columns are known by
their position until the result is named, so any header will do.
"""

from __future__ import annotations

import codecs
import csv
import functools
import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions.columns import undotted
from docgraph.plans.scratch import write_observed, write_table
from docgraph.sources.files import escaped, first_lines, listed_files
from docgraph.sources.quotes import OPENS, joined_records, turn

# Texts read as missing.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Type names accepted by ``dtype``.
DTYPES = {
    "int": T.LongType(), "int64": T.LongType(), "Int64": T.LongType(), "int32": T.IntegerType(),
    "int16": T.ShortType(), "int8": T.ByteType(), "float": T.DoubleType(), "float64": T.DoubleType(),
    "float32": T.FloatType(), "str": T.StringType(), "string": T.StringType(), "object": T.StringType(),
    "category": T.StringType(), "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "datetime64[ns]": T.TimestampNTZType(),
}

# Character sets that Spark knows under another name. Further Java character sets need
# spark.sql.legacy.javaCharsets in the session.
CHARSETS = {"iso8859-1": "iso-8859-1", "ascii": "us-ascii"}

# Texts of whole numbers, numbers and truth values. The patterns go before any cast: they
# are cheaper than a cast that fails, and a cast alone would also take type suffixes.
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?((\d+[.]?\d*|[.]\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
TRUTH = ["true", "True", "TRUE", "false", "False", "FALSE"]

# Date formats tried in this order, with a pattern that goes before each; the first under which no value fails is taken.
DATE_FORMATS = {
    "iso": r"^\d{4}-",
    "M/d/yyyy[ H:mm[:ss]]": "/",
    "yyyy/M/d[ H:mm[:ss]]": "/",
    "yyyyMMdd": r"^\d{8}$",
    "d-MMM-yyyy[ H:mm[:ss]]": r"^\d{1,2}-[A-Za-z]{3}-\d{4}",
    "d MMM yyyy[ H:mm[:ss]]": r"^\d{1,2} [A-Za-z]{3} \d{4}",
    "d MMMM yyyy[ H:mm[:ss]]": r"^\d{1,2} [A-Za-z]+ \d{4}",
    "MMMM d, yyyy[ H:mm[:ss]]": r"^[A-Za-z]+ \d{1,2}, \d{4}",
}

RAW, PROBLEM = "_raw", "_problem"

# Place of a record: its file's position in the caller's list, its file, its input split there, and a rising number within the split.
POSITION = ["_listed", "_file", "_split", "_at"]

# Metadata of a column in which no record has a value.
EMPTY = {"empty": True}


class CsvRead(NamedTuple):
    """The records, and the lines that are none: ``_raw`` text and ``_problem``."""

    rows: DataFrame
    rejects: DataFrame


@dataclass
class CsvOptions:
    delimiter: str = ","
    encoding: str = "utf-8"
    header: int | list[int] | str | None = 0
    skiprows: int | list[int] | None = None
    nrows: int | None = None
    usecols: list[str] | None = None
    dtype: dict[str, str] | None = None
    parse_dates: bool | list[str] | None = None
    na_values: list[str] | dict[str, list[str]] | None = None
    quotechar: str = '"'
    escapechar: str | None = None
    replace_dots: bool = False
    column_names: list[str] | None = None
    multiline: bool = True

    @property
    def charset(self) -> str:
        name = codecs.lookup(self.encoding).name
        return CHARSETS.get(name, name)

    @property
    def header_rows(self) -> list[int]:
        if self.header is None or self.header == "none":
            return []
        return [self.header] if isinstance(self.header, int) else list(self.header)

    @property
    def needs_numbers(self) -> bool:
        return bool(self.skiprows) or self.nrows is not None or self.header_rows not in ([], [0])

    def spark_options(self) -> dict:
        return {
            "sep": self.delimiter,
            "encoding": self.charset,
            "quote": self.quotechar,
            "escape": self.escapechar or self.quotechar,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": RAW,
        }

    def records(self, lines: Iterable[str]) -> Iterator[list[str]]:
        """The records of a file's first lines, without blank ones."""
        skipped = set(range(self.skiprows)) if isinstance(self.skiprows, int) else set(self.skiprows or [])
        lines = (line.removeprefix("\ufeff") if n == 0 else line for n, line in enumerate(lines))
        settings = dict(delimiter=self.delimiter, quotechar=self.quotechar, escapechar=self.escapechar)
        if self.multiline:
            found = csv.reader((line + "\n" for line in lines), **settings)
        else:
            found = (next(csv.reader([line], **settings), []) for line in lines)
        return (record for n, record in enumerate(found) if n not in skipped and record and (len(record) > 1 or record[0].strip()))


def column_names(header: list[list[str]], width: int) -> list[str]:
    """Names from the header rows: levels joined by ``_``, blanks named, repeats numbered."""
    if not header:
        return [str(i) for i in range(width)]
    given = ["_".join(levels) or f"Unnamed: {i}" for i, levels in enumerate(zip(*header))]
    names, counts = [], {}
    for base in given:
        name = base
        # A numbered name must not be one that the header itself has, wherever it stands.
        while name in names or (name != base and name in given):
            counts[base] = counts.get(base, 0) + 1
            name = f"{base}.{counts[base]}"
        names.append(name)
    return names


def _layout(width: int) -> T.StructType:
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
    return T.StructType([*fields, T.StructField(RAW, T.StringType())])


def _heads(spark: SparkSession, file: str, options: CsvOptions) -> tuple[str, ...] | None:
    """The column names of a file, from its header rows, or the width of its first record; none if it has no record at all."""
    wanted = options.header_rows or [0]
    tops = list(itertools.islice(options.records(first_lines(spark, file, options.charset)), wanted[-1] + 1))
    if not tops:
        return None
    if len(tops) <= wanted[-1]:
        raise ValueError(f"no columns to read from {file}")
    fields = [tops[n] for n in wanted]
    return tuple(column_names(fields if options.header_rows else [], len(fields[0])))


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split")]


def _records(spark: SparkSession, files: list[str], width: int, options: CsvOptions) -> DataFrame:
    """Records that may span lines: one task reads a file, so its records have rising numbers."""
    numbered = options.needs_numbers
    lines = (
        spark.read.schema(_layout(width))
        .options(**options.spark_options(), header=bool(options.header_rows) and not numbered, multiLine=True)
        # The corrupt-record column is only filled when whole records are parsed.
        .option("columnPruning", False)
        .csv([escaped(f) for f in files])
        .select("*", *_place(), F.monotonically_increasing_id().alias("_at"))
    )
    if not numbered:
        return lines
    starts = write_table(lines.groupBy("_file").agg(F.min("_at").alias("_start")), "starts")
    lines = lines.join(starts, "_file").withColumn("_record", F.col("_at") - F.col("_start"))
    return _wanted_records(lines, options).drop("_start", "_record")


def _wanted_records(lines: DataFrame, options: CsvOptions) -> DataFrame:
    first = options.header_rows[-1] + 1 if options.header_rows else 0
    lines = lines.filter(F.col("_record") >= first)
    return lines if options.nrows is None else lines.filter(F.col("_record") < first + options.nrows)


def _number(lines: DataFrame, name: str) -> DataFrame:
    """Number the lines of each file from 0, in file order: ranks within an input split, plus the counts of the splits before."""
    within = Window.partitionBy("_file", "_split").orderBy("_at")
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_lines"))
    splits = counts.select("_file", "_split", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_offset"))
    numbered = lines.withColumn("_rank", F.row_number().over(within) - 1).join(splits, ["_file", "_split"])
    return numbered.withColumn(name, F.col("_rank") + F.col("_offset")).drop("_rank", "_offset")


def _lines(spark: SparkSession, files: list[str], width: int, options: CsvOptions) -> DataFrame:
    """The records of files that are split, parsed."""
    text = spark.read.option("lineSep", "\n").text([escaped(f) for f in files]).select("value", *_place())
    if options.charset != "utf-8":
        text = text.withColumn("value", F.decode(F.col("value").cast("binary"), options.charset))
    # Line feeds with or without a carriage return end a line, and so do carriage returns alone.
    parts = F.when(F.col("value").rlike(r"(?s)\r."), F.split("value", r"(?s)\r(?=.)")).otherwise(F.array("value"))
    text = text.select(F.explode_outer(parts).alias("value"), "_file", "_split")
    marked = (F.col("_split") == 0) & F.col("value").startswith("\ufeff")
    text = text.withColumn("value", F.when(marked, F.substring("value", 2, 2**31 - 1)).otherwise(F.col("value")))
    text = text.withColumn("_at", F.monotonically_increasing_id())
    if options.multiline:
        # Written, so that the lines' numbers within a split are the same whenever they are read.
        text = text.withColumn("_turn", turn(F.col("value"), options.quotechar, *_open_patterns(options)))
        text, opening = write_observed(text, "lines", F.count_if(F.col("_turn") >= OPENS))
        # If no line leaves a quote open, each one is a record.
        text = write_table(joined_records(text), "joined") if opening else text.drop("_turn")
    elif options.needs_numbers:
        text = write_table(text, "lines")
    text = text.withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    if options.skiprows:
        text = _number(text, "_line")
        skipped = F.col("_line") < options.skiprows if isinstance(options.skiprows, int) else F.col("_line").isin(list(options.skiprows))
        text = text.filter(~skipped)
    text = text.filter(F.trim("value") != "")
    if options.needs_numbers:
        text = _wanted_records(_number(text, "_record"), options)
    elif options.header_rows:
        text = text.join(text.filter("_split = 0").groupBy("_file").agg(F.min("_at").alias("_at")), ["_file", "_at"], "left_anti")
    settings = {k: v for k, v in options.spark_options().items() if k != "encoding"}
    ddl = ", ".join(f"{f.name} string" for f in _layout(width))
    parsed = text.select(F.from_csv("value", F.lit(ddl), {**settings, "multiLine": "true"}).alias("_csv"), "value", "_file", "_split", "_at")
    return parsed.select("_csv.*", "value", "_file", "_split", "_at")


def _fields_pattern(options: CsvOptions) -> tuple[str, str]:
    """Patterns of a whole quoted field, and of one that does not close."""
    quote = f"\\x{ord(options.quotechar):02x}"
    if options.escapechar and options.escapechar != options.quotechar:
        escape = f"\\x{ord(options.escapechar):02x}"
        inner = f"[^{quote}{escape}]*+(?:(?:{quote}{quote}|{escape}.)[^{quote}{escape}]*+)*+"
    else:
        inner = f"[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+"
    return f"{quote}{inner}{quote}", f"{quote}{inner}"


def _open_patterns(options: CsvOptions) -> tuple[str, str]:
    """Patterns of lines that end inside quotes if they begin outside, and if they begin inside."""
    closed, opened = _fields_pattern(options)
    separator, quote = re.escape(options.delimiter), f"\\x{ord(options.quotechar):02x}"
    rest = f"[^{separator}]*+" if len(options.delimiter) == 1 else f"(?:(?!{separator}).)*+"
    # A field begins with a quote or isn't quoted; what follows a closing quote belongs to the field.
    fields = f"(?:(?:{closed}|(?!{quote})){rest}{separator})*+{opened}$"
    return f"(?s)^{fields}", f"(?s)^{opened[len(quote):]}(?:$|{quote}{rest}{separator}{fields})"


def _field_count(raw: Column, options: CsvOptions) -> Column:
    """Fields of a line: separators outside quotes, plus one."""
    bare = F.regexp_replace(raw, f"(?s){_fields_pattern(options)[0]}", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(options.delimiter))) + 1


def _fits(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return column.rlike(WHOLE) & column.try_cast(kind).isNotNull()
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return column.rlike(NUMBER)
    if isinstance(kind, T.BooleanType):
        return column.isin(TRUTH)
    return F.lit(True)


def _date(column: Column, form: str) -> Column:
    parsed = column.try_cast("timestamp_ntz") if form == "iso" else F.try_to_timestamp(column, F.lit(form)).cast("timestamp_ntz")
    return F.when(column.rlike(DATE_FORMATS[form]), parsed)


def _converted(column: Column, kind: T.DataType | str) -> Column:
    if isinstance(kind, str):
        return _date(column, kind)
    if isinstance(kind, T.TimestampNTZType):
        return F.coalesce(*[_date(column, form) for form in DATE_FORMATS])
    return column if isinstance(kind, (T.StringType, T.NullType)) else column.try_cast(kind)


# Whole numbers that do not fit a long stay exact up to so many digits, and are text beyond.
BIG_TYPE = T.DecimalType(38, 0)

# Bits that say which kinds of value a column has: narrowest type of each value.
LONG, DOUBLE, BOOLEAN, TEXT, BIG = 1, 2, 4, 8, 16


def _kind_of(column: Column) -> Column:
    whole = F.when(column.try_cast("bigint").isNotNull(), LONG).when(column.try_cast(BIG_TYPE).isNotNull(), BIG).otherwise(TEXT)
    kind = F.when(column.rlike(WHOLE), whole).when(column.rlike(NUMBER), DOUBLE).when(column.isin(TRUTH), BOOLEAN)
    return F.when(column.isNotNull(), kind.otherwise(TEXT))


def _type_for(kinds: int | None) -> T.DataType:
    if kinds is None:
        return T.NullType()
    if kinds == LONG:
        return T.LongType()
    if not kinds & ~(LONG | BIG):
        return BIG_TYPE
    if not kinds & ~(LONG | DOUBLE):
        return T.DoubleType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def _infer(texts: DataFrame, names: list[str], dates: list[str]) -> dict[str, T.DataType | str]:
    """Type of each named column, from one aggregate over the whole table.

    A date column takes the first format under which no value fails, or stays text; any other column
    takes the first of whole number, number, truth value and text that all its values are; whole numbers beyond a long next
    to fractions stay text, as a double would not keep them apart. A column without values has no type.
    """
    if not names:
        return {}
    tests = []
    for i, name in enumerate(names):
        column = F.col(name)
        if name in dates:
            misfits = [F.count_if(column.isNotNull() & _date(column, form).isNull()) for form in DATE_FORMATS]
            tests.append(F.struct(F.count(column).alias("values"), F.array(*misfits).alias("misfits")).alias(str(i)))
        else:
            tests.append(F.bit_or(_kind_of(column)).alias(str(i)))
    found = texts.agg(*tests).first()
    result = {}
    for i, name in enumerate(names):
        if name not in dates:
            result[name] = _type_for(found[str(i)])
        elif found[str(i)]["values"] == 0:
            result[name] = T.NullType()
        else:
            fitting = [form for form, misfits in zip(DATE_FORMATS, found[str(i)]["misfits"]) if misfits == 0]
            result[name] = fitting[0] if fitting else T.StringType()
    return result


def _dtype(name: str, wanted: str) -> T.DataType:
    if wanted not in DTYPES:
        raise ValueError(f"column {name!r}: unknown dtype {wanted!r}")
    return DTYPES[wanted]


def _texts(spark: SparkSession, files: list[str], head: tuple[str, ...], options: CsvOptions) -> tuple[DataFrame, dict[str, str]]:
    """The wanted columns of files with the same header as text, the problems of their records, and the names of the columns."""
    whole_files = options.charset.startswith(("utf-16", "utf-32"))
    lines = (_records if whole_files else _lines)(spark, files, len(head), options)
    kept = list(range(len(head)))
    if options.usecols:
        missing = [c for c in options.usecols if c not in head]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        kept = [i for i in kept if head[i] in options.usecols]

    def text(i: int) -> Column:
        extra = options.na_values or []
        extra = extra.get(head[i], []) if isinstance(extra, dict) else extra
        return F.when(~F.col(f"c{i}").isin(NA_TEXTS + [str(v) for v in extra]), F.col(f"c{i}"))

    last = F.col(f"c{len(head) - 1}")
    too_long = F.col(RAW).isNotNull() & (last.isNotNull() | (_field_count(F.col(RAW), options) > len(head)))
    problem = F.when(too_long, F.lit(f"more than {len(head)} fields"))
    raw = F.col(RAW)
    if not whole_files:
        unclosed = F.contains("value", F.lit(options.quotechar)) & F.col("value").rlike(_open_patterns(options)[0])
        problem = F.when(unclosed, "a quote is not closed").otherwise(problem)
        raw = F.when(unclosed, F.col("value")).otherwise(raw)
    place = [F.col(c) for c in POSITION if c != "_listed"]
    return lines.select(*[text(i).alias(f"c{i}") for i in kept], raw.alias(RAW), problem.alias(PROBLEM), *place), {f"c{i}": head[i] for i in kept}


@dataclass
class _Parsed:
    """All records with columns known by their position: texts, problems and places, the result's columns, and what is wrong with a record."""

    texts: DataFrame
    columns: list[Column]
    names: list[str]
    raw: Column
    problem: Column


def _parse(spark: SparkSession, paths: str | list[str], options: CsvOptions) -> _Parsed:
    frames, names = [], []
    for number, path in enumerate([paths] if isinstance(paths, str) else paths):
        by_head: dict[tuple[str, ...], list[str]] = {}
        for file in listed_files(spark, path):
            # Writers leave empty files for empty partitions; they have nothing to read.
            if head := _heads(spark, file, options):
                by_head.setdefault(head, []).append(file)
        if not by_head:
            raise ValueError(f"no columns to read from {path}")
        for head, files in by_head.items():
            frame, kept = _texts(spark, files, head, options)
            names += [c for c in kept.values() if c not in names]
            columns = [F.col(c).alias(f"t{names.index(name)}") for c, name in kept.items()]
            frames.append(frame.select(*columns, RAW, PROBLEM, F.lit(number).alias("_listed"), *[c for c in POSITION if c != "_listed"]))
    texts = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    at = {name: f"t{i}" for i, name in enumerate(names)}

    forced = {c: _dtype(c, t) for c, t in (options.dtype or {}).items() if c in names}
    dates = options.parse_dates if isinstance(options.parse_dates, list) else []
    free = [c for c in names if c not in forced]
    if free:
        # Parsed once: the types are told from what the result is made of.
        texts = write_table(texts, "records")
    inferred = _infer(texts.filter(F.col(PROBLEM).isNull()), [at[c] for c in free], [at[c] for c in dates if c in free])
    kinds = {**{c: inferred[at[c]] for c in free}, **forced}
    typed = [_converted(F.col(at[c]), kinds[c]) for c in names]
    unfit = [
        F.when(
            F.col(at[c]).isNotNull() & (~_fits(F.col(at[c]), kind) | _converted(F.col(at[c]), kind).isNull()),
            F.lit(f"{c}: not {options.dtype[c]}"),
        )
        for c, kind in forced.items()
        if not isinstance(kind, T.StringType)
    ]
    # A line whose field count is right has no raw text; give the rejected ones theirs.
    found = F.coalesce(F.col(PROBLEM), *unfit)
    again = F.coalesce(F.col(RAW), F.concat_ws(options.delimiter, *[F.coalesce(at[c], F.lit("")) for c in names]))

    shown = names
    if options.column_names:
        if len(options.column_names) != len(names):
            raise ValueError(f"{len(options.column_names)} names for {len(names)} columns")
        shown = list(options.column_names)
    if options.replace_dots:
        shown = undotted(shown)
    # A column without values is shown as doubles, and marked.
    empty = [isinstance(kinds[c], T.NullType) for c in names]
    typed = [F.lit(None).cast("double").alias(n, metadata=EMPTY) if e else c.alias(n) for c, n, e in zip(typed, shown, empty)]
    return _Parsed(texts, typed, shown, F.when(found.isNotNull(), again), found)


def parse_csv(spark: SparkSession, paths: str | list[str], position: bool = False, **settings) -> DataFrame:
    """All records in one frame, with ``_raw`` and ``_problem`` set for the lines that are none.

    A line with too few fields is filled with nulls; one with too many, or with a value that its
    ``dtype`` does not allow, is a problem. ``position`` adds the place of each record. Columns of the file must not differ from
    these or from each other by case only; ``read_csv`` takes any.
    """
    parsed = _parse(spark, paths, CsvOptions(**settings))
    added = [RAW, PROBLEM, *(POSITION if position else [])]
    taken = [n.lower() for n in [*parsed.names, *added]]
    twice = sorted({n for n in parsed.names if taken.count(n.lower()) > 1})
    if twice:
        raise ValueError(f"columns that can't be told apart, rename them by column_names: {twice}")
    return parsed.texts.select(*parsed.columns, parsed.raw.alias(RAW), parsed.problem.alias(PROBLEM), *added[2:])


def read_csv(spark: SparkSession, paths: str | list[str], **settings) -> CsvRead:
    """Records and rejected lines of one or more files; see ``CsvOptions`` for the settings."""
    parsed = _parse(spark, paths, CsvOptions(**settings))
    rows = parsed.texts.filter(parsed.problem.isNull()).select(*parsed.columns)
    return CsvRead(rows, parsed.texts.filter(parsed.problem.isNotNull()).select(parsed.raw.alias(RAW), parsed.problem.alias(PROBLEM)))
