"""Assets as rows: folders, zip entries, manual seeds; one row an asset, bytes only where parsed."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import urls
from tabulon.operators.rows import first_wins

# What can be parsed.
SUFFIXES = (".xlsx", ".xls", ".csv", ".html", ".htm", ".pdf")
ASSET = "source_name string, asset_kind string, locator string, display_name string, content binary, error string"


def folder(spark: SparkSession, path: str, source_name: str, recurse: bool = True) -> DataFrame:
    """Files of a folder with a known suffix; content is read only by what parses it."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recurse).lower())
             .option("pathGlobFilter", "*.{xlsx,xls,csv,html,htm,pdf,zip}").load(path))
    return files.select(
        F.lit(source_name).alias("source_name"), F.when(F.lower("path").endswith(".zip"), "zip").otherwise("local_file").alias("asset_kind"),
        F.col("path").alias("locator"), F.regexp_extract("path", r"([^/]+)$", 1).alias("display_name"), "content", F.lit(None).cast("string").alias("error"))


def expand_zips(assets: DataFrame) -> DataFrame:
    """Zip assets replaced by their entries; an unreadable archive gives a row with ``error``."""
    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                try:
                    with zipfile.ZipFile(io.BytesIO(r.content)) as z:
                        for name in sorted(z.namelist()):
                            base = name.rsplit("/", 1)[-1]
                            if name.lower().endswith(SUFFIXES) and not base.startswith("~$"):
                                out.append((r.source_name, "zip_entry", f"{r.locator}::{name}", base, z.read(name), None))
                except (zipfile.BadZipFile, OSError) as e:
                    out.append((r.source_name, "zip", r.locator, r.display_name, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ASSET.split(", ")])

    names = [c.split()[0] for c in ASSET.split(", ")]
    entries = assets.where("asset_kind = 'zip'").select(names).mapInPandas(run, ASSET)
    return assets.where("asset_kind <> 'zip'").select(names).unionByName(entries)


def described(assets: DataFrame) -> DataFrame:
    """Assets with content type (from the name, then the first bytes) and content hash, one per source and locator."""
    typed = assets.withColumn("content_type", urls.sniffed_type(F.col("content"), urls.content_type(F.col("display_name"))))
    return first_wins(typed.withColumn("content_hash", F.sha2("content", 256)), ["source_name", "locator"], ["display_name"])


def page_links(pages: DataFrame, source_name: str, keywords: list[str], allowed: list[str]) -> DataFrame:
    """Candidate assets on crawled pages: absolute links of allowed hosts, best pages first, one per locator."""
    link = F.col("link")
    base = F.regexp_extract("url", r"^([A-Za-z]+://[^/]+)", 1)
    each = pages.select("url", urls.keyword_score(F.col("html"), keywords).alias("score"), F.posexplode(urls.links(F.col("html"))).alias("nth", "link"))
    whole = F.when(link.rlike(r"^[A-Za-z]+://"), link).when(link.startswith("/"), F.concat(base, link))
    found = each.withColumn("locator", urls.without_fragment(whole)).where(F.col("locator").isNotNull() & urls.allowed_domain(F.col("locator"), allowed))
    best = first_wins(found, ["locator"], [F.desc("score"), "url", "nth"])
    return best.select(F.lit(source_name).alias("source_name"), urls.asset_kind(F.col("locator")).alias("asset_kind"), "locator", F.col("url").alias("page_url"), "score")
