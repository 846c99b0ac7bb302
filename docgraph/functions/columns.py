"""Column names: replacement by position, and names without dots."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def undotted(names: list[str]) -> list[str]:
    """Names with ``_`` for ``.``; a repeated name gets ``_1``, ``_2``, ... until it is unique."""
    taken: set[str] = set()
    result = []
    for name in names:
        base = candidate = name.replace(".", "_")
        number = 0
        while candidate in taken:
            number += 1
            candidate = f"{base}_{number}"
        taken.add(candidate)
        result.append(candidate)
    return result


def replace_dots(df: DataFrame) -> DataFrame:
    return df.toDF(*undotted(df.columns))
