"""Search for a part of a text by an index of trigrams.

The index has a row for each unit and each run of three characters of its id or serial, in lower case, written by ranges of the trigram. A
search takes the trigrams of the longest stretch of its pattern that has no wildcard, keeps the units that have all of them, and
checks these against the pattern itself. A pattern without such a stretch reads all units.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ponloom.functions.text import contains_pattern
from ponloom.operators.lineage import stored

SIZE = 3


def _grams(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    starts = F.sequence(F.lit(1), F.greatest(F.length(lowered) - (SIZE - 1), F.lit(1)))
    return F.filter(F.transform(starts, lambda at: F.substr(lowered, at, F.lit(SIZE))), lambda g: F.length(g) == SIZE)


def trigram_index(units: DataFrame, columns: tuple[str, ...] = ("vendor_ont_id", "serial"), key: str = "id") -> DataFrame:
    """(gram, id): which units have which trigram in any of the columns."""
    grams = F.array_distinct(F.flatten(F.array(*[_grams(F.col(c)) for c in columns])))
    rows = units.select(F.col(key).alias("id"), F.explode(grams).alias("gram"))
    return stored(rows.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id"), "trigrams")


def longest_literal(pattern: str) -> str:
    """The longest stretch of a LIKE pattern without wildcards."""
    parts, now = [], ""
    for escaped, plain in re.findall(r"\\(.)|(.)", pattern, flags=re.DOTALL):
        if plain in ("%", "_") and not escaped:
            parts.append(now)
            now = ""
        else:
            now += escaped or plain
    return max([*parts, now], key=len)


def search_by_trigrams(
    units: DataFrame, index: DataFrame, q: str, literal: bool = False, columns: tuple[str, ...] = ("vendor_ont_id", "serial"), key: str = "id",
) -> DataFrame:
    """Units of which a column contains the text, case aside: the rows that a scan with ILIKE finds."""
    like = contains_pattern(q, literal)
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.col(c), F.lit("")).ilike(like)
    known = longest_literal(like).lower()
    grams = sorted({known[k:k + SIZE] for k in range(len(known) - SIZE + 1)})
    # Letters whose lower case is longer or shorter than they are would need other trigrams.
    if not grams or not known.isascii():
        return units.where(found)
    hits = index.where(F.col("gram").isin(grams)).groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select(F.col("id").alias(key))
    return units.join(hits, key, "left_semi").where(found)
