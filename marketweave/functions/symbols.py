"""Symbol rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BLANKS = " \t\r\n"


def clean_text(col: Column) -> Column:
    """Trim and upper-case; null stays null."""
    return F.upper(F.btrim(col.cast("string"), F.lit(_BLANKS)))


def normalize_symbol(col: Column) -> Column:
    """``Q530036`` -> ``530036``, ``5930`` -> ``005930``, null -> ``''``, other text unchanged.

    One chain of replacements: a CASE would repeat its input, and again in every
    filter that is pushed below it.
    """
    text = F.coalesce(clean_text(col), F.lit(""))
    bare = F.regexp_replace(text, "^Q([0-9]{6})$", "$1")
    marked = F.regexp_replace(bare, "^([0-9]{1,5})$", "#00000$1")
    return F.regexp_replace(marked, "^#0*([0-9]{6})$", "$1")


def is_q_symbol(col: Column) -> Column:
    return F.coalesce(clean_text(col).rlike("^Q[0-9]{6}$"), F.lit(False))


def prefer_symbol(existing: Column, new: Column) -> Column:
    """The longer canonical symbol; on equal length the existing one."""
    old, fresh = normalize_symbol(existing), normalize_symbol(new)
    keep = (old != "") & (F.length(old) >= F.length(fresh))
    return F.when(keep, old).when(fresh != "", fresh).otherwise(old)
