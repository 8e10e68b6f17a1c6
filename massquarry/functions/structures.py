"""Normal forms of structure names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What stands for a missing name, in any letter case.
PLACEHOLDERS = ("", "-", "na", "n/a", "nan", "none", "null", "unknown")

_EDGES = r"""^[\s "']+|[\s "']+$"""


def inchikey14(name: Column) -> Column:
    """The 14 capital letters of an InChIKey's first block, however written; null where none is named."""
    k = F.regexp_extract(F.upper(F.regexp_replace(name, _EDGES, "")), "^(?:INCHIKEY=)?([A-Z]{14})(?:-.*)?$", 1)
    return F.when(k != "", k)


def smiles(name: Column) -> Column:
    """SMILES without surrounding blanks and quotes; null for placeholders."""
    s = F.regexp_replace(name, _EDGES, "")
    return F.when(~F.lower(s).isin(*PLACEHOLDERS), s)


def instrument(name: Column) -> Column:
    """Spelling variants of an instrument as one: letters and digits in capitals."""
    return F.upper(F.regexp_replace(name, "[^A-Za-z0-9]", ""))


def polarity(name: Column) -> Column:
    n = F.lower(F.trim(name))
    return F.when(n.startswith("pos") | n.isin("+", "p", "1"), "positive").when(n.startswith("neg") | n.isin("-", "n", "-1"), "negative")
