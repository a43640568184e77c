"""Column functions for faculty and program labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions import classify, text, urls

UNKNOWN = "Невідомий факультет"


def faculty_of(locator: Column, faculties: dict[str, str], fallback: Column | None = None) -> Column:
    """The faculty of an address's host (or of the host it lies below), else the fallback, else unknown."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in faculties.items()))
    h = urls.host(locator)
    parent = F.regexp_extract(h, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    other = F.lit("") if fallback is None else text.flat(fallback)
    return F.coalesce(F.element_at(table, h), F.element_at(table, parent), F.nullif(other, F.lit("")), F.lit(UNKNOWN))


def first_meaningful(*labels: Column, fallback: str = "") -> Column:
    """The first label that is neither blank, a placeholder, an address, an id nor a technical name."""
    return F.coalesce(*[F.when(classify.is_meaningful_label(x), text.flat(x)) for x in labels], F.lit(fallback))


def path_label(locator: Column) -> Column:
    """The last part of a path that means something, without its suffix, separators as spaces."""
    parts = F.split(F.regexp_replace(urls.without_fragment(locator), r"[?].*$", ""), "[/:]+")
    named = F.transform(F.reverse(parts), lambda p: F.trim(F.translate(F.regexp_replace(p, r"\.[A-Za-z0-9]{1,5}$", ""), "_-", "  ")))
    return F.coalesce(F.get(F.filter(named, lambda p: p.rlike(r"\p{L}{3}") & ~classify.is_technical(p) & ~classify.is_storage_id(p)), 0), F.lit(""))
