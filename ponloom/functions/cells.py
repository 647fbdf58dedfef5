"""Reading numbers and three-state cells out of text.

Numbers follow the rules of Python's ``int()`` and ``float()`` (signs, underscores between
digits, ``nan``/``inf``), which differ from Spark's casts: Spark accepts ``1.5d`` and ``0x1p3``
and refuses ``1_000``.

Functions take a SQL expression, mostly a column name. Those that end in ``_sql`` give SQL text to
build on, the others a Column.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python strips as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_DIGITS = "[0-9]+(_[0-9]+)*"
INT_PATTERN = f"^[+-]?{_DIGITS}$"
FLOAT_PATTERN = (
    f"^([+-]?({_DIGITS}[.]?({_DIGITS})?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?"
    "|(?i:[+-]?(nan|inf|infinity)))$"
)


def strip_sql(text: str) -> str:
    return f"btrim({text}, '{WHITESPACE}')"


def is_int_sql(text: str) -> str:
    return f"rlike({text}, '{INT_PATTERN}')"


def is_float_sql(text: str) -> str:
    return f"rlike({text}, '{FLOAT_PATTERN}')"


def to_int_sql(text: str, type_: str = "bigint") -> str:
    """The integer written in stripped text, NULL if it is none or does not fit the type."""
    return f"if({is_int_sql(text)}, try_cast(replace({text}, '_', '') AS {type_}), NULL)"


def to_float_sql(text: str) -> str:
    """The float written in stripped text, NULL if it is none."""
    # A sign before nan means nothing, and Spark does not read it.
    number = f"if(rlike({text}, '^(?i:[+-]nan)$'), 'nan', replace({text}, '_', ''))"
    return f"if({is_float_sql(text)}, try_cast({number} AS double), NULL)"


def parse_dbm(text: str, missing: str = "zero") -> Column:
    """Power in dBm from device text such as ``-22.5 dBm``.

    Absent or unreadable power becomes 0.0, or NULL with ``missing='null'``, which keeps a
    missing reading apart from a real 0 dBm.
    """
    if missing not in ("zero", "null"):
        raise ValueError("missing must be 'zero' or 'null'")
    value = to_float_sql(strip_sql(f"replace({text}, ' dBm', '')"))
    return F.expr(f"coalesce({value}, 0.0D)" if missing == "zero" else value)


def first_truthy_sql(record: str, *keys: str) -> str:
    """First of the keys of a record whose value is neither NULL nor empty."""
    values = ", ".join(f"{record}['{k}']" for k in keys)
    return f"get(filter(array({values}), x -> x <> ''), 0)"


def first_truthy(record: str, *keys: str) -> Column:
    return F.expr(first_truthy_sql(record, *keys))


def clean_cell(text: str) -> Column:
    """Cell text without white space around it; blank for a missing cell."""
    return F.expr(f"coalesce({strip_sql(text)}, '')")


def cell(clean: str, kind: str = "text") -> Column:
    """Three-state cell from clean text: ``struct(is_set, value, bad)``.

    Blank keeps the stored value (``is_set`` false); the word null, in any case, sets NULL;
    anything else sets the value. ``bad`` marks text that is not a number of the wanted kind.
    """
    if kind == "text":
        value, good = clean, "true"
    elif kind == "int":
        value, good = to_int_sql(clean, "int"), is_int_sql(clean)
    elif kind == "float":
        value, good = to_float_sql(clean), is_float_sql(clean)
    else:
        raise ValueError("kind must be 'text', 'int' or 'float'")
    has_value = f"{clean} <> '' AND lower({clean}) <> 'null'"
    return F.expr(
        f"named_struct('is_set', {clean} <> '', 'value', if({has_value}, {value}, NULL),"
        f" 'bad', {has_value} AND NOT {good})"
    )
