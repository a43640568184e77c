"""Column functions for links, file kinds and page text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Storage hosts, file kinds, and words that mark schedule pages.
STORAGE_HOSTS = ("docs.google.com", "drive.google.com", "onedrive.live.com", "1drv.ms")
SUFFIX_TYPES = {
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".xls": "application/vnd.ms-excel", ".csv": "text/csv",
    ".pdf": "application/pdf", ".html": "text/html", ".htm": "text/html", ".zip": "application/zip",
}


def without_fragment(url: Column) -> Column:
    """The address before ``#``, entities decoded."""
    return F.replace(F.split_part(F.coalesce(url, F.lit("")), F.lit("#"), F.lit(1)), F.lit("&amp;"), F.lit("&"))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def suffix(url: Column) -> Column:
    """Lower-case file suffix of an address or path, '' if it has none."""
    return F.lower(F.regexp_extract(F.regexp_replace(without_fragment(url), r"[?].*$", ""), r"(\.[A-Za-z0-9]{1,5})$", 1))


def allowed_domain(url: Column, allowed: list[str]) -> Column:
    """Whether the host is, or is below, an allowed domain; storage hosts always are."""
    h = host(url)
    ok = h.isin(*STORAGE_HOSTS)
    for d in allowed:
        ok = ok | (h == d) | h.endswith("." + d)
    return ok


def keyword_score(text: Column, keywords: list[str]) -> Column:
    """How many of the keywords the text holds."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return sum((F.when(F.contains(low, F.lit(k.lower())), 1).otherwise(0) for k in keywords), F.lit(0))


def asset_kind(url: Column) -> Column:
    """google_sheet, file_url or web_link."""
    h, s = host(url), suffix(url)
    return F.when((h == "docs.google.com") & F.contains(url, F.lit("/spreadsheets/")), "google_sheet").when(
        s.isin(*SUFFIX_TYPES) & ~s.isin(".html", ".htm"), "file_url").otherwise("web_link")


def content_type(name: Column) -> Column:
    types = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in SUFFIX_TYPES.items()))
    return F.coalesce(F.element_at(types, suffix(name)), F.lit("application/octet-stream"))


def sniffed_type(content: Column, fallback: Column) -> Column:
    """Content type from the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    return F.when(head.startswith("25504446"), "application/pdf").when(head.startswith("504B0304"), SUFFIX_TYPES[".xlsx"]).when(
        head.startswith("D0CF11E0"), SUFFIX_TYPES[".xls"]).otherwise(fallback)


def google_id(url: Column) -> Column:
    """The document id of a storage link, '' if it has none."""
    path = F.regexp_extract(url, r"/d/(?!e/)([A-Za-z0-9_-]+)", 1)
    return F.when(path != "", path).otherwise(F.regexp_extract(url, r"[?&]id=([A-Za-z0-9_-]+)", 1))


def links(html: Column) -> Column:
    """All href targets of a page, in order."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?i)href\s*=\s*"([^"]*)"'), F.lit(1))


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))
