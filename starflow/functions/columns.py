"""Column helpers shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ref(name: str) -> Column:
    """Column by exact name, whatever blanks, dots or signs the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def refs(names: Iterable[str]) -> list[Column]:
    return [ref(n) for n in names]


def is_plain(kind: T.DataType) -> bool:
    """A type whose equal values have one hash, once -0.0 is 0.0."""
    return isinstance(kind, (T.NumericType, T.DatetimeType, T.BooleanType, T.BinaryType)) or kind == T.StringType()


def hashable(df: DataFrame, names: Iterable[str]) -> list[Column]:
    """The columns with 0.0 for -0.0, as in a group's key; equal values then have one hash."""
    zero = {"double": F.lit(0.0), "float": F.lit(0.0).cast("float")}
    types = {n: df.schema[n].dataType.simpleString() for n in names}
    return [ref(n) + zero[t] if t in zero else ref(n) for n, t in types.items()]


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Fail while the plan is built, with all missing names in one message."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")


def normalize_name(name: str) -> str:
    """Trim a header cell and turn every inner run of whitespace into one blank."""
    return " ".join(name.split())
