"""Text-assembly helpers: number formats and numbered lists as Catalyst
expressions (no Python per row)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fixed(c: Column, digits: int, grouping: bool = False) -> Column:
    """Fixed-point text of a number, half-even on the exact binary value (the
    rounding of Python's ``format(x, '.2f')``); ``grouping`` adds thousands commas."""
    s = F.format_number(c.cast("double"), digits)
    return s if grouping else F.regexp_replace(s, ",", "")


def py_bool(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("None")).when(c, F.lit("True")).otherwise(F.lit("False"))


def json_string_list(arr: Column) -> Column:
    """``json.dumps`` of a list of plain strings: ``["a", "b"]`` (comma + space)."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def numbered(arr: Column, indent: str = "  ") -> Column:
    """``["a", "b"]`` -> ``["  1. a", "  2. b"]``."""
    return F.transform(arr, lambda x, i: F.concat(F.lit(indent), (i + 1).cast("string"), F.lit(". "), x))


class Spliced:
    """An array<string> column whose elements are lines of their own."""

    def __init__(self, col: Column):
        self.col = col


def lines(*parts) -> Column:
    """Join text lines with newlines.  A part is a literal ``str``, a string
    ``Column`` (one line) or a ``Spliced`` array of lines."""
    arrays = []
    for p in parts:
        if isinstance(p, str):
            arrays.append(F.array(F.lit(p)))
        elif isinstance(p, Spliced):
            arrays.append(p.col)
        else:
            arrays.append(F.array(p))
    return F.array_join(F.concat(*arrays), "\n")


def or_else(arr: Column, fallback: str) -> Spliced:
    """``arr`` when it has elements, else the one line ``fallback``."""
    return Spliced(F.when(F.size(arr) > 0, arr).otherwise(F.array(F.lit(fallback))))


# ---------------------------------------------------------------------------
# Python-style ``{field}`` / ``{field:.2f}`` / ``{field:,.2f}`` templates over columns
# ---------------------------------------------------------------------------
_FIELD = re.compile(r"\{(\w+)(?::([^}]*))?\}")
_FIXED = re.compile(r"(,)?\.(\d+)f")


def value_text(c: Column, dtype: T.DataType | None, spec: str | None) -> Column:
    if spec:
        m = _FIXED.fullmatch(spec)
        if not m:
            raise ValueError(f"unsupported format spec {spec!r}")
        return fixed(c, int(m.group(2)), grouping=bool(m.group(1)))
    if isinstance(dtype, T.BooleanType):
        return py_bool(c)
    return F.coalesce(c.cast("string"), F.lit("None"))


def render(template: str, dtypes: dict[str, T.DataType], defaults: dict | None = None) -> Column | None:
    """Fill a template from columns.  A field the frame lacks takes ``defaults``;
    with no default the result is None (callers keep the raw template).  A NULL
    value under a numeric spec makes the whole text NULL."""
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        parts.append(F.lit(template[pos:m.start()]))
        name, spec = m.group(1), m.group(2)
        if name in dtypes:
            parts.append(value_text(F.col(name), dtypes[name], spec))
        elif defaults and name in defaults:
            parts.append(F.lit(format(defaults[name], spec or "")))
        else:
            return None
        pos = m.end()
    parts.append(F.lit(template[pos:]))
    return F.concat(*parts)
