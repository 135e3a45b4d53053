"""Numbers out of text, leniently and strictly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for "no number".
PLACEHOLDERS = ("", "-", "—", "–", "n/a", "na", "null")


def _clean(c: Column) -> Column:
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*PLACEHOLDERS), F.replace(t, F.lit(","), F.lit("")))


def lenient_decimal(c: Column, kind: str = "decimal(10,2)") -> Column:
    return _clean(c).try_cast(kind)


def lenient_int(c: Column) -> Column:
    """Through a double, cut towards zero; infinite and unparsable values are null."""
    d = _clean(c).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 2147483648.0), d.cast("int"))


def strict_decimal_ok(c: Column) -> Column:
    """True unless a value is there that is no decimal; such a value rejects its row."""
    return c.isNull() | c.try_cast("decimal(38,10)").isNotNull()


def percentage(c: Column) -> Column:
    """Fractions (up to and with 1, negatives too) to per cent; half-even to two places."""
    d = c.try_cast("decimal(20,10)")
    return F.bround(F.when(d <= 1, d * 100).otherwise(d), 2).cast("decimal(10,2)")


def star_count(c: Column) -> Column:
    """"1,234" and "1.2k"; 0 for anything else."""
    t = F.lower(F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(""))))
    k = F.round(F.replace(t, F.lit("k"), F.lit("")).try_cast("decimal(18,6)") * 1000, 6)
    return F.coalesce(F.when(t.contains("k"), k.cast("bigint")).otherwise(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))), F.lit(0).cast("bigint"))


def first_int(*cs: Column) -> Column:
    """The first that is there, 0 if none, never negative."""
    return F.greatest(F.coalesce(*cs, F.lit(0)), F.lit(0))


def truthy(c: Column, kind: str = "int") -> Column:
    """Null where a value counts as missing: 0 for numbers, "" for text."""
    return F.nullif(c, F.lit(0 if kind == "int" else ""))
