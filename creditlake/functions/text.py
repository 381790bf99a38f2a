"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spelling variants (trimmed, lower case) and the city each one stands for.
CITY_VARIANTS_PY = {
    "bogot": "Bogotá",
    "bogota": "Bogotá",
    "bogota d.c.": "Bogotá",
    "bogotá d.c.": "Bogotá",
    "bogota dc": "Bogotá",
    "bogotá dc": "Bogotá",
    "medellin": "Medellín",
    "medellín": "Medellín",
    "barranquila": "Barranquilla",
    "barranquilla": "Barranquilla",
    "cali": "Cali",
    "ibagué": "Ibagué",
    "soacha": "Soacha",
    "villavicencio": "Villavicencio",
    "manizales": "Manizales",
    "pereira": "Pereira",
    "bucaramanga": "Bucaramanga",
    "cúcuta": "Cúcuta",
    "cartagena": "Cartagena",
}
# The SQL dialect only knows these three cities.
CITY_VARIANTS_SQL = {
    variant: city
    for variant, city in CITY_VARIANTS_PY.items()
    if city in ("Bogotá", "Medellín", "Barranquilla")
}


def strip_py(c: Column) -> Column:
    """Trim all Unicode white space, as Python's `str.strip`; SQL `trim` only takes spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _capitalise_runs(c: Column, word_class: str, other_class: str) -> Column:
    runs = F.regexp_extract_all(F.lower(c), F.lit(f"{word_class}+|{other_class}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def title_py(c: Column) -> Column:
    """Python's `str.title`: a capital after any non-letter, so `D.C.` and `O'Brien`."""
    return _capitalise_runs(c, r"\p{L}", r"\P{L}")


def initcap_pg(c: Column) -> Column:
    """PostgreSQL's INITCAP: digits belong to the word, so `2da` keeps its small `d`."""
    return _capitalise_runs(c, r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]")


def _lookup(key: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def city_py(c: Column) -> Column:
    """Canonical city; unknown names fall back to the title case of the untrimmed text."""
    return F.coalesce(_lookup(F.lower(strip_py(c)), CITY_VARIANTS_PY), title_py(c))


def city_sql(c: Column) -> Column:
    """Canonical city in the SQL dialect: three known names, else INITCAP of the trimmed text."""
    return F.coalesce(_lookup(F.lower(F.trim(c)), CITY_VARIANTS_SQL), initcap_pg(F.trim(c)))
