"""Resolve differently named source fields and project any source to the normalized schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.config import ALIASES
from perimetry.functions.text import plain_name
from perimetry.schema import GEOM, ID_COLUMNS, NORMALIZED_COLUMNS, NORMALIZED_DDL, TEXT_COLUMNS


class AliasIndex:
    """Which columns a field name may fill, and how good an alias it is for them.

    Built once from the aliases; a file's fields are then walked once. Names alone count, whether a field
    holds nulls is no matter. Of two fields that are spelled alike the later one counts.
    """

    def __init__(self, aliases: Mapping[str, Sequence[str]], exact: bool = False) -> None:
        self.spelling = str if exact else plain_name
        self.uses: dict[str, list[tuple[str, int]]] = {}
        self.columns = list(aliases)
        for column, names in aliases.items():
            for rank, name in enumerate(names):
                self.uses.setdefault(self.spelling(name), []).append((column, rank))

    def resolve(self, fields: Sequence[str]) -> dict[str, str | None]:
        """Column -> field, None where no field fits."""
        best: dict[str, tuple[int, str]] = {}
        for field in fields:
            for column, rank in self.uses.get(self.spelling(field), ()):
                if column not in best or rank <= best[column][0]:
                    best[column] = (rank, field)
        return {c: best[c][1] if c in best else None for c in self.columns}


def first_present(df: DataFrame, names: Sequence[str], type_: str = "string") -> Column:
    """The first of ``names`` that is a column of ``df`` (exact spelling), else nulls."""
    found = next((n for n in names if n in df.columns), None)
    return F.lit(None).cast(type_) if found is None else F.col(f"`{found}`")


def _as_text(df: DataFrame, column: str, field: str | None) -> Column:
    if field is None:
        return F.lit(None).cast("string").alias(column)
    value = F.col(f"`{field}`")
    if column in ID_COLUMNS and isinstance(df.schema[field].dataType, T.NumericType):
        value = F.when(value != 0, value)  # a numeric zero is no identifier
    return value.cast("string").alias(column)


def normalize(
    df: DataFrame,
    source: str,
    aliases: Mapping[str, Sequence[str]] = ALIASES,
    geom: str = "geom",
    row_id: str = "row_id",
) -> DataFrame:
    """One projection: every normalized column as text, absent ones null, plus the source name."""
    attributes = [c for c in df.columns if c not in (geom, row_id)]
    found = AliasIndex(aliases).resolve(attributes)
    text = [_as_text(df, c, found.get(c)) for c in TEXT_COLUMNS]
    return df.select(
        *text,
        F.lit(source).alias("source_dataset"),
        F.col(geom).cast(GEOM).alias("geom"),
        F.col(row_id).cast("bigint").alias("row_id"),
    )


def union_all(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of normalized frames; an empty typed frame when there are none."""
    empty = spark.createDataFrame([], NORMALIZED_DDL)
    return reduce(DataFrame.unionByName, frames, empty).select(*NORMALIZED_COLUMNS)
