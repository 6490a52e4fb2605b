"""Column expressions for dirty business data. All run inside JVM codegen."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns of the source system.
DIGITS = r"^[0-9]+$"
FIRST_NUMBER = r"(\d+\.?\d*)"
FULL_WIDTH_DIGITS = "０１２３４５６７８９"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def offset_id(column: str | Column, offset: int, missing: int | None = None) -> Column:
    """Move an id into another id space; a null id becomes ``missing``."""
    moved = _col(column) + F.lit(offset)
    return moved if missing is None else F.coalesce(moved, F.lit(missing))


def digits_to_long(column: str | Column) -> Column:
    """Text made of digits only as a long, anything else null."""
    text = _col(column)
    return F.when(text.rlike(DIGITS), text.try_cast("long"))


def first_number(column: str | Column) -> Column:
    """First decimal number found in a text (full-width digits count), null if there is none."""
    text = F.translate(_col(column), FULL_WIDTH_DIGITS, "0123456789")
    found = F.regexp_extract(text, FIRST_NUMBER, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def blank_to_null(column: str | Column) -> Column:
    return F.nullif(_col(column), F.lit(""))


def blank_to_default(column: str | Column, default: str | Column) -> Column:
    return F.coalesce(blank_to_null(column), default if isinstance(default, Column) else F.lit(default))


def falsy_to_default(column: str | Column, default: Column, falsy: str | int | float) -> Column:
    """``a or default`` of scripting languages: null and the ``falsy`` value give way."""
    return F.coalesce(F.nullif(_col(column), F.lit(falsy)), default)


def first_known(*columns: str | Column) -> Column:
    return F.coalesce(*[_col(c) for c in columns])


def code_map(column: str | Column, mapping: Mapping, default=None) -> Column:
    """Simple CASE over constants; without ``default`` an unknown code is null."""
    value = _col(column)
    branches = list(mapping.items())
    expr = F.when(value == F.lit(branches[0][0]), F.lit(branches[0][1]))
    for code, mapped in branches[1:]:
        expr = expr.when(value == F.lit(code), F.lit(mapped))
    return expr if default is None else expr.otherwise(F.lit(default))


def value_map(column: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values, keep every other one."""
    value = _col(column)
    return F.coalesce(code_map(value, mapping), value)


def is_set(column: str | Column) -> Column:
    """1 when the column holds a value, else 0 (soft-delete time to flag)."""
    return F.when(_col(column).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def any_true(*columns: str | Column) -> Column:
    return reduce(lambda a, b: a | b, [_col(c) for c in columns])


def localized(**names: str | Column) -> Column:
    """Multilingual name as JSON text; null languages fall back to the first one."""
    (first_lang, first), *others = names.items()
    base = _col(first)
    parts = [base.alias(first_lang)]
    parts += [F.coalesce(_col(c), base).alias(lang) for lang, c in others]
    return document(F.struct(*parts))


def json_field(column: str | Column, field: str) -> Column:
    return F.get_json_object(_col(column), f"$.{field}")


def document(struct: Column) -> Column:
    """JSON text that keeps null fields, as the consumers expect."""
    return F.to_json(struct, {"ignoreNullFields": "false"})


def bracket_ids(column: str | Column, size: int) -> list[Column]:
    """``"[1,2,3]"`` as ``size`` long columns; missing or blank entries are null."""
    parts = F.split(F.trim(_col(column), F.lit("[]")), ",")
    return [
        F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit("")).try_cast("long")
        for i in range(size)
    ]


def bracket_list(items: Column) -> Column:
    """Array as ``"[a,b]"`` text."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def timestamp_text(column: str | Column) -> Column:
    return F.date_format(_col(column), TIMESTAMP_FORMAT)


def date_text(column: str | Column) -> Column:
    return F.date_format(_col(column), DATE_FORMAT)


def decimal_text(column: str | Column, scale: int = 2) -> Column:
    return _col(column).cast(f"decimal(18,{scale})").cast("string")


def newer_than(column: str | Column, as_of: str, interval: str) -> Column:
    """``column > as_of - interval`` with a fixed ``as_of``, so a run can be repeated."""
    bound = F.expr(f"timestamp_ntz'{as_of}' - interval {interval}")
    return _col(column) > bound


def differs(left: Column, right: Column, null_safe: bool = True) -> Column:
    """Change test. The plain form misses changes from or to null."""
    return ~left.eqNullSafe(right) if null_safe else left != right
