"""One naming rule, usable on column names (driver) and on values (as a column)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and letters of the naming rule.
WORD_START = r"([a-z0-9])([A-Z])"
BLANKS = r"\s+"
OTHER_SIGNS = r"[^a-zA-Z0-9áéíóúÁÉÍÓÚâêîôÂÊÎÔãõÃÕçÇ_]+"
DOUBLE_MARK = "__"
ACCENTED = "áéíóúâêîôãõç"
UNACCENTED = "aeiouaeioaoc"


def snake_name(name: str) -> str:
    """A column name in snake case without the listed accents."""
    lowered = re.sub(WORD_START, r"\1_\2", name).lower()
    joined = re.sub(BLANKS, "_", lowered)
    plain = re.sub(OTHER_SIGNS, "_", joined)
    single = re.sub(DOUBLE_MARK, "_", plain)
    return single.translate(str.maketrans(ACCENTED, UNACCENTED)).strip("_")


def snake_label(value: Column) -> Column:
    """The same rule for values, evaluated in the JVM."""
    lowered = F.lower(F.regexp_replace(value, WORD_START, "$1_$2"))
    joined = F.regexp_replace(lowered, BLANKS, "_")
    plain = F.regexp_replace(joined, OTHER_SIGNS, "_")
    single = F.regexp_replace(plain, DOUBLE_MARK, "_")
    return F.trim(F.translate(single, ACCENTED, UNACCENTED), F.lit("_"))
