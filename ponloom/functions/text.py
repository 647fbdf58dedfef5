"""Names and search patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ponloom.functions.cells import WHITESPACE


def display_name(description: str, id_: str) -> Column:
    """The description, or the id where there is none."""
    return F.expr(f"coalesce(nullif({description}, ''), {id_})")


def contains_pattern(q: str, literal: bool = False) -> str:
    """LIKE pattern for "contains q". ``%`` and ``_`` in q stay wildcards unless literal.

    A backslash stands for the next character as it is; one at the end stands for itself.
    """
    q = q.strip(WHITESPACE)
    if literal:
        q = q.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    # LIKE takes a backslash only before a wildcard or another backslash.
    q = re.sub(r"\\(.?)", lambda m: m[0] if m[1] and m[1] in "%_\\" else m[1] or "\\\\", q, flags=re.DOTALL)
    return f"%{q}%"


def match_rank(q: str, uuid: str, name: str) -> Column:
    """How well a box matches a search: 0 is the exact uuid, 4 a name that contains it, NULL none."""
    needle = F.lit(q.strip().lower())
    code, label = (F.expr(f"lower(coalesce({c}, ''))") for c in (uuid, name))
    return (
        F.when(code == needle, 0)
        .when(F.startswith(code, needle), 1)
        .when(F.contains(code, needle), 2)
        .when(F.startswith(label, needle), 3)
        .when(F.contains(label, needle), 4)
    )
