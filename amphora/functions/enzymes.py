"""Enzyme metadata as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from amphora import fixed


def _literal_map(values: dict) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])


def conditions(enzymes: str | Column) -> tuple[Column, Column]:
    """Optimum pH and temperature of every enzyme of an ARRAY<STRING>
    column, in combination order (a single enzyme gives 1-arrays). Lookup is
    by exact name, as the conditions table is keyed; unknown names give
    null entries."""
    enzymes = F.col(enzymes) if isinstance(enzymes, str) else enzymes
    ph = _literal_map({e.name: float(e.ph_optimum) for e in fixed.ENZYMES})
    temp = _literal_map({e.name: int(e.temp_optimum_celsius) for e in fixed.ENZYMES})
    return (F.transform(enzymes, lambda e: F.try_element_at(ph, e)).alias("ph"),
            F.transform(enzymes, lambda e: F.try_element_at(temp, e)).alias("temp"))


def resolve_enzyme_name(name: str | Column, strict: bool = True) -> Column:
    """P11 on data: case-insensitive lookup of an enzyme name against the
    rule table (a literal map, no join). Unknown names raise in strict mode
    and give null otherwise (see ``unknown_enzymes`` for a report)."""
    name = F.col(name) if isinstance(name, str) else name
    known = _literal_map({e.name: e.name for e in fixed.ENZYMES})
    found = F.try_element_at(known, F.lower(name))
    if not strict:
        return found
    return F.when(found.isNotNull() | name.isNull(), found).otherwise(
        F.raise_error(F.concat(F.lit("Unknown enzyme: "), name)))


def unknown_enzymes(df, name: str):
    """P11 non-strict report: rows whose enzyme name is not a known rule."""
    return df.where(resolve_enzyme_name(name, strict=False).isNull() & F.col(name).isNotNull())


def resolve_combos(df, name: str):
    """P11 on a combination column ARRAY<STRING>: ``enzymes`` (the known names
    as the rule table has them, in order) and ``unknown`` (the names, as they
    are given, that no rule has); a null combination stays null in both."""
    known = lambda e: resolve_enzyme_name(e, strict=False)
    given = F.col(name)
    return df.withColumns({
        "enzymes": F.filter(F.transform(given, known), lambda e: e.isNotNull()),
        "unknown": F.filter(given, lambda e: known(e).isNull() & e.isNotNull())})
