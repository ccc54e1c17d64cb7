"""Column-list and expression helpers shared by the operators.

Expressions over generated column lists are kept as SQL text: wide tables then cost one call into
the JVM per column, instead of one per function in the expression.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: the end date of a version that is still open.
OPEN_END = dt.date(2099, 12, 31)


def parse_run_date(value: dt.date | int | str | None = None) -> dt.date:
    """Turn a run date given as date or ``YYYYMMDD`` into a date; today when absent."""
    if value is None:
        return dt.date.today()
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(str(value), "%Y%m%d").date()


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def date_literal(day: dt.date) -> str:
    return f"DATE'{day.isoformat()}'"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def require_free(names: Iterable[str], cols: Iterable[str], what: str) -> None:
    """Technical columns of a result must not meet columns of the entity by name."""
    taken = {c.lower() for c in cols}
    if clash := [n for n in names if n.lower() in taken]:
        raise ValueError(f"{what}: column(s) {', '.join(clash)} exist already; choose other names")


def tracked_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """All columns of ``df`` but the excluded (technical or key) ones."""
    excluded = set(exclude)
    return [c for c in df.columns if c not in excluded]


def require_columns(df: DataFrame, cols: Iterable[str], what: str) -> None:
    present = set(df.columns)
    missing = [c for c in cols if c not in present]
    if missing:
        raise ValueError(f"{what} lacks column(s) {', '.join(missing)}")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return False


def require_comparable(df: DataFrame, cols: Iterable[str]) -> None:
    """Maps and variants have no equality in Spark, so they cannot be compared for change."""
    schema = df.schema
    bad = [c for c in cols if _holds_map(schema[c].dataType)]
    if bad:
        raise TypeError(f"column(s) {', '.join(bad)} hold a map or variant and cannot be compared")


def same_values(left: Sequence[str], right: Sequence[str]) -> str:
    """NULL-safe equality of two equally long lists of expressions, exact (no hash)."""
    pairs = [f"{a} <=> {b}" for a, b in zip(left, right, strict=True)]
    return f"({' AND '.join(pairs)})" if pairs else "true"


def align_to(df: DataFrame, like: DataFrame, cols: Sequence[str]) -> list[str]:
    """``cols`` of ``df``, cast where needed to the types the columns have in ``like``."""
    have, want = df.schema, like.schema
    out = []
    for c in cols:
        kind = want[c].dataType
        cast = have[c].dataType != kind
        out.append(f"CAST({quoted(c)} AS {kind.simpleString()}) AS {quoted(c)}" if cast else quoted(c))
    return out
