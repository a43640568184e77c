"""Column functions for messy cell text.  Null reads as ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rx(pattern: str) -> str:
    """A case-blind, Unicode-aware Java pattern."""
    return "(?iuU)" + pattern


def let(x: Column, f) -> Column:
    """``f`` of ``x``, worked out once: inside, ``x`` is a variable, so a rule that names it often does not repeat the work in plan and code."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def flat(x: Column) -> Column:
    """White space of any kind, no-break space and line ends included, to single spaces; trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"(?U)\s+", " "))


def header_key(x: Column) -> Column:
    """A header cell's lookup key: lower case, letters, digits and apostrophes only."""
    plain = F.replace(F.replace(F.lower(flat(x)), F.lit("(якщо є)"), F.lit("")), F.lit("’"), F.lit("'"))
    return flat(F.regexp_replace(plain, r"[^0-9a-zа-яіїєґ' ]+", " "))


#: A flat text without any of these is canonical as it stands.
SERVICE_MARKS = r"лек|практ|сем|лаб|lek|prac|sem|lab|ауд |[|/;]|^[ ,;]|[ ,;]$"


def service_tokens(x: Column) -> Column:
    """Canonical spacing and dots of room and lesson abbreviations and of separators."""
    return let(flat(x), lambda t: F.when(t.rlike(rx(SERVICE_MARKS)), _service_tokens(t)).otherwise(t))


def _service_tokens(t: Column) -> Column:
    t = F.replace(F.replace(t, F.lit("ауд "), F.lit("ауд. ")), F.lit("АУД "), F.lit("ауд. "))
    for short in ("лек", "практ"):
        t = F.regexp_replace(t, rx(rf"\b{short}\b"), f"{short}.")
    t = F.regexp_replace(t, rx(r"\b(лек|практ|сем|лаб|lek|prac|sem|lab)\.{2,}"), "$1.")
    t = F.regexp_replace(t, r"(?U)\s*([|/;])\s*", " $1 ")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"^[ ,;]+|[ ,;]+$", "")


def without_zero_fraction(x: Column) -> Column:
    """``12.0`` -> ``12``: a spreadsheet's number shown as text."""
    return F.regexp_replace(flat(x), r"^(\d+)\.0$", "$1")


def compact(x: Column) -> Column:
    """Lower case without anything but letters and digits."""
    return F.regexp_replace(F.lower(flat(x)), r"(?U)[\W_]+", "")


def segments(x: Column) -> Column:
    """Non-empty parts between bars, semicolons and slashes."""
    return F.filter(F.transform(F.split(flat(x), r"\s*[|;/]\s*"), F.trim), lambda s: s != "")


def behind_first(xs: Column) -> Column:
    """An array without its first element."""
    return F.slice(xs, 2, F.greatest(F.size(xs) - 1, F.lit(0)))


def joined_distinct(x: Column, sep: str = "; ") -> Column:
    return F.array_join(F.array_distinct(F.filter(x, lambda s: s != "")), sep)


def file_slug(x: Column, fallback: str = "untitled", longest: int = 120) -> Column:
    """A file name without reserved characters, of at most ``longest`` characters."""
    safe = F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r'[<>:"/\\|?*]+', "_"), r"(?U)\s+", " ")
    trimmed = F.regexp_replace(F.substring(F.regexp_replace(safe, r"^[ .]+|[ .]+$", ""), 1, longest), r"[ .]+$", "")
    # a name of letters, digits and inner signs stands as it is
    plain = (F.length(x) <= longest) & x.rlike(r"^[\p{L}\p{Nd}]+(?:[ .,()'_-][\p{L}\p{Nd}]+)*\z")
    return F.when(plain, x).otherwise(F.when(trimmed == "", fallback).otherwise(trimmed))


def sheet_title(x: Column, fallback: str = "Аркуш1") -> Column:
    """A worksheet title: reserved characters dropped, at most 31 characters."""
    t = F.trim(F.substring(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"[\[\]:*?/\\]", " ")), 1, 31))
    return F.when(t == "", fallback).otherwise(t)


def excerpt(values: list[Column], most: int = 6) -> Column:
    """The first filled values of a row, for a reviewer."""
    filled = F.filter(F.array(*[flat(v) for v in values]), lambda v: v != "")
    return F.array_join(F.slice(filled, 1, most), " | ")


def unspaced_letters(x: Column, least: int = 6, share: float = 0.6) -> Column:
    """``Л е к ц і я`` -> ``Лекція`` where most tokens are single characters."""
    t = flat(x)
    tokens = F.split(t, " ")
    single = F.size(F.filter(tokens, lambda w: F.length(w) == 1))
    return F.when((F.size(tokens) >= least) & (single >= F.size(tokens) * F.lit(share)), F.replace(t, F.lit(" "), F.lit(""))).otherwise(t)


def first_filled(*values: Column, fallback: str = "") -> Column:
    return F.coalesce(*[F.nullif(flat(v), F.lit("")) for v in values], F.lit(fallback))
