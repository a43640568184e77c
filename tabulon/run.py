"""Whole runs: sources to rows, rows to accepted and review, workbooks, manifest and reports; and the command line.

Sources that need a network give issues, not assets; what they would bring can be placed in a folder source.
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon import config as settings
from tabulon import models
from tabulon.functions import fields, text
from tabulon.functions import segments as seg
from tabulon.operators import continuation, gridrecords, merge, normalize, quality, records, report, splitgrid
from tabulon.operators.rows import ordered
from tabulon.sinks import workbooks
from tabulon.sources import assets as asset_sources
from tabulon.sources import cells as cell_sources
from tabulon.sources.scratch import kept

LOCAL_KINDS = ("folder", "zip", "file")
REQUIRED = ["day", "start_time", "end_time", "subject"]
# What issues say, and why a source is blocked.
BLOCKERS = (
    (("http 500", "500 internal server error", "500 server error"), "Official source returns HTTP 500"),
    (("http 403", "403 client error", "blocked", "cloudflare"), "Access to the official source is blocked (HTTP 403 / Cloudflare)"),
    (("http 410", "410 client error", "gone for url"), "Official schedule asset is no longer publicly available (HTTP 410)"),
)
NOISY = "Extracted rows are too noisy to form a reliable timetable"
INCOMPLETE = "Rows were extracted but key schedule fields are incomplete"
UNPARSED = "Assets were discovered but parsers did not yield complete schedule rows"
NOTHING = "No public schedule assets discovered from the official source"
STATUSES = ("parsed", "review-only", "confirmed-blocker")


def discovered(spark: SparkSession, sources: Iterable[models.Source]) -> tuple[DataFrame, DataFrame]:
    """(assets, issues): files and zip entries of local sources with type and hash; (source_name, issue) of the others and of seeds."""
    found, issues = None, []
    for s in sources:
        issues += [(s.name, f"not fetched: {a.url}") for a in s.manual_assets]
        if s.kind not in LOCAL_KINDS or not s.path:
            issues.append((s.name, f"source kind {s.kind} needs a network"))
            continue
        one = asset_sources.folder(spark, s.path, s.name, s.recurse)
        found = one if found is None else found.unionByName(one)
    found = spark.createDataFrame([], asset_sources.ASSET) if found is None else asset_sources.expand_zips(found)
    return asset_sources.described(found), spark.createDataFrame(issues, "source_name string, issue string")


def sheet_records(cells: DataFrame) -> DataFrame:
    """Records of every sheet by its layout: split-cell grids, tables under a header row with all required fields, else grids with a day and a time axis.

    ``nth`` orders the records of a row.
    """
    columns = [*splitgrid.SHEET, "row_index", *records.FIELDS, "raw_excerpt"]

    def shaped(df: DataFrame, *order: str) -> DataFrame:
        have = df.withColumns({c: F.lit("") for c in records.FIELDS if c not in df.columns})
        if "raw_excerpt" not in have.columns:
            have = have.withColumn("raw_excerpt", text.excerpt([F.col(c) for c in records.FIELDS]))
        return have.select(*columns, F.struct(*[F.col(c).cast("int").alias(f"k{i}") if i < len(order) else F.lit(0).alias(f"k{i}") for i, c in enumerate([*order, *["row_index"] * 3][:3])]).alias("nth"))

    known = cells.where("error IS NULL")
    split = kept(splitgrid.split_sheets(known).select(*splitgrid.SHEET), "run-split")
    rest = known.join(split, splitgrid.SHEET, "left_anti")
    out = []
    if not split.isEmpty():
        out.append(shaped(splitgrid.split_grid_records(known.join(split, splitgrid.SHEET, "left_semi")), "min_row", "min_col", "nth"))
    out.append(shaped(records.tabular_records(rest)))
    headed = records.header_rows(records.named_cells(rest))
    free = kept(rest.join(headed, splitgrid.SHEET, "left_anti"), "run-unheaded")
    if not free.isEmpty():
        out.append(shaped(gridrecords.grid_records(free), "col_index"))
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole


def merged_rows(rows: DataFrame) -> DataFrame:
    """Rows with metadata-only rows merged into the one row of their slot that fits, and continued subjects joined; orphans of neither group nor course go."""
    rows = kept(rows.withColumn("place", F.row_number().over(ordered(["asset_locator", "sheet_ord"], ["row_index", "nth"]))).drop("nth"), "run-placed")
    bare = F.concat("teacher", "room", "link", "notes") == ""
    fits = fields.same_context(fields.slot_key(F.col("h.course")), fields.slot_key(F.col("g.course"))) & fields.same_context(fields.slot_key(F.col("h.groups")), fields.slot_key(F.col("g.groups")))
    slot = ["asset_locator", "sheet_ord", "day", "start_time", "end_time"]
    has = F.col("subject") != ""
    done = lambda name: F.when(F.col("merged") > 0, F.array_union("autofix_actions", F.array(F.lit(name)))).otherwise(F.col("autofix_actions"))
    met = merge.unique_match(rows, slot, ["place"], has, ~has & ~bare, fits, ["teacher", "room", "link", "notes"], {"link": " "}, by=("course", "groups"))
    met = met.withColumn("autofix_actions", done("slot_metadata_merged")).where(has | bare | (F.col("merged") > 0) | (F.concat("groups", "course") != "")).drop("merged")
    told = continuation.with_continuations(met, ["asset_locator", "sheet_ord"], "place", ["source_name", "sheet_name", "day", "start_time", "end_time"])
    return told.withColumn("autofix_actions", done("subject_continuation_merged")).drop("merged", "place")


def collected(spark: SparkSession, sources: Iterable[models.Source]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, assets, issues) of some sources; files that fail give issues and the others go on."""
    sources = list(sources)
    found, issues = discovered(spark, sources)
    found = kept(found, "run-assets")
    cells = kept(cell_sources.cells(found), "run-cells")
    failed = cells.where("error IS NOT NULL").select("locator", "error").join(found.select("locator", "source_name"), "locator").select("source_name", F.col("error").alias("issue"))
    broken = found.where("error IS NOT NULL").select("source_name", F.col("error").alias("issue"))
    kinds = spark.createDataFrame([(s.name, s.kind) for s in sources], "source_name string, source_kind string")
    rows = merged_rows(normalize.normalized(sheet_records(cells), found)).join(F.broadcast(kinds), "source_name", "left")  # one row a configured source
    return rows, found.drop("content"), issues.unionByName(failed).unionByName(broken)


def judged(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows with confidence, flags, severity and ``accepted``, after the demotion of bare groups and of whole buckets."""
    has = [F.coalesce(F.col(c), F.lit("")) != "" for c in REQUIRED]
    rows = kept(rows.withColumn("confidence", quality.confidence(*has, F.size("warnings"))), "run-unflagged")
    df = kept(quality.flagged(rows), "run-flagged")
    df = df.withColumn("accepted", quality.accepted(F.col("flags"), F.col("confidence"), REQUIRED, threshold))
    bare = F.col("sheet_name").startswith("pdf") & (F.concat("teacher", "room", "link", "notes") == "")
    df = quality.demoted(df, ["asset_locator", "sheet_name", "day", "start_time", "end_time", "course", "groups"], bare, seg.is_fragment_subject(F.trim("subject")))
    return df.withColumnRenamed("flags", "qa_flags").withColumn("qa_severity", quality.severity(F.col("qa_flags")))


def status(accepted: Column, review: Column, found: Column, issues: Column, warnings: Column, flags: Column) -> Column:
    """struct(status, note) of a source from its counts, issues and most frequent review warnings and flags."""
    low = F.lower(F.array_join(issues, "\n"))
    holds = lambda marks: F.greatest(*[F.contains(low, F.lit(m)) for m in marks])
    blocker = F.coalesce(*[F.when(holds(marks), F.lit(why)) for marks, why in BLOCKERS], F.lit(""))
    any_of = lambda xs, *names: F.arrays_overlap(xs, F.array(*map(F.lit, names)))
    incomplete = ("missing_day", "missing_subject", "missing_time")
    noisy = any_of(flags, "garbage_text", "inconsistent_columns", "subject_too_long")
    both = lambda s, note: F.struct(F.lit(s).alias("status"), (F.lit(note) if isinstance(note, str) else note).alias("note"))
    most = F.array_join(F.slice(F.when(F.size(warnings) > 0, warnings).otherwise(flags), 1, 3), ", ")
    return (F.when((accepted > 0) & (review > 0), both("parsed", F.concat(review.cast("string"), F.lit(" review rows remain")))).when(accepted > 0, both("parsed", ""))
            .when(blocker != "", both("confirmed-blocker", blocker))
            .when((review > 0) & noisy & any_of(warnings, "garbage_text_subject"), both("confirmed-blocker", NOISY))
            .when((review > 0) & any_of(warnings, *incomplete), both("review-only", INCOMPLETE))
            .when((review > 0) & noisy & ~any_of(flags, *incomplete), both("confirmed-blocker", NOISY))
            .when(review > 0, both("review-only", most)).when(found > 0, both("confirmed-blocker", UNPARSED)).otherwise(both("confirmed-blocker", NOTHING)))


def source_summaries(spark: SparkSession, sources: Iterable[models.Source], rows: DataFrame, assets: DataFrame, issues: DataFrame) -> DataFrame:
    """One row a configured source: counts, status, issues and the most frequent review flags (``models.SOURCE_SUMMARY``)."""
    base = spark.createDataFrame([(s.name, s.url or s.path or "") for s in sources], "source_name string, source_root_url string")
    fixed = F.size("autofix_actions") > 0
    counted = report.source_counts(base, rows, "source_name", {"accepted_rows": F.count_if("accepted"), "review_rows": F.count_if(~F.col("accepted")), "autofix_rows": F.count_if(fixed)})
    found = report.source_counts(counted, assets, "source_name", {"discovered_assets": F.count("*"), "attempted_assets": F.count_if(F.col("error").isNull())})
    review, none = rows.where("NOT accepted"), F.array().cast("array<string>")
    for column, name in (("warnings", "top_review_warnings"), ("qa_flags", "top_review_qa_flags")):
        top = report.top_elements(review, ["source_name"], column, 5, "x").groupBy("source_name").agg(F.array_sort(F.collect_list(F.struct("rank", "x"))).alias("xs"))
        found = found.join(top.select("source_name", F.transform("xs", lambda s: s["x"]).alias(name)), "source_name", "left").withColumn(name, F.coalesce(name, none))
    said = issues.groupBy("source_name").agg(F.array_sort(F.collect_set("issue")).alias("runtime_issues"))
    out = found.join(said, "source_name", "left").withColumns({"runtime_issues": F.coalesce("runtime_issues", none), "discovery_issues": none})
    judged_ = status(*map(F.col, ("accepted_rows", "review_rows", "discovered_assets", "runtime_issues", "top_review_warnings", "top_review_qa_flags")))
    return out.withColumn("__s", judged_).select(
        "source_name", "source_root_url", "__s.status", "accepted_rows", "review_rows", "autofix_rows", "discovered_assets", "attempted_assets", "discovery_issues",
        "runtime_issues", "top_review_warnings", "top_review_qa_flags", "__s.note")


def with_kept_metadata(summaries: DataFrame, previous: DataFrame, refreshed: list[str]) -> DataFrame:
    """Status, note, asset counts and issues of sources that were not refreshed come from the run before."""
    names = ["status", "note", "discovered_assets", "attempted_assets", "discovery_issues", "runtime_issues"]
    old = previous.where(~F.col("source_name").isin(*refreshed)).select("source_name", *[F.col(c).alias(f"__{c}") for c in names])
    joined = summaries.join(old, "source_name", "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in names else F.col(c) for c in summaries.columns])


def markdown(summaries: list) -> str:
    """The source summary as a page, by status."""
    lines = ["# Source Summary", ""]
    for s in STATUSES:
        lines.append(f"## {s}")
        for r in [r for r in summaries if r["status"] == s] or [None]:
            if r is None:
                lines.append("- none")
                continue
            title = r["source_name"].replace("_", " ").replace("-", " ").title()
            note = f" - {r['note']}" if r["note"] else ""
            lines.append(f"- {title} - accepted={r['accepted_rows']}, review={r['review_rows']}, autofix={r['autofix_rows']}, assets={r['discovered_assets']} - {r['source_root_url']}{note}")
        lines.append("")
    return "\n".join(lines).strip() + "\n"


def _save(path: str, content: str | bytes) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content.encode() if isinstance(content, str) else content)
    return path


def _report(folder: str, name: str, df: DataFrame) -> dict[str, str]:
    """A report of bounded size (sources, flags or files by counts) as JSON and as a workbook."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    table = [list(df.columns), *[[json.dumps(v, ensure_ascii=False) if isinstance(v, (list, dict)) else "" if v is None else str(v) for v in r.values()] for r in rows]]
    return {f"{name}_json": _save(f"{folder}/{name}.json", json.dumps(rows, ensure_ascii=False, sort_keys=True, indent=1)),
            f"{name}_xlsx": _save(f"{folder}/{name}.xlsx", workbooks.xlsx_bytes([(name[:31], table)]))}


def finished(spark: SparkSession, config: models.Config, rows: DataFrame, assets: DataFrame, issues: DataFrame, sources: Iterable[models.Source],
             refreshed: list[str] | None = None) -> models.RunOutput:
    """Judge all rows and write everything below the output folder, which tasks and driver share."""
    out = config.output_dir
    df = kept(judged(rows, config.confidence_threshold), "run-rows")
    accepted, review = df.where("accepted"), quality.without_dropped(df.where("NOT accepted"))
    previous_path, previous = f"{out}/source_summary", None
    if os.path.isdir(previous_path):
        previous = kept(spark.read.schema(models.SOURCE_SUMMARY).json(previous_path), "run-previous")
    summaries = source_summaries(spark, sources, df, assets, issues)
    if previous is not None and refreshed is not None:
        summaries = with_kept_metadata(summaries, previous, refreshed)
    summaries = kept(summaries, "run-summaries")

    def save(r) -> None:
        path = f"{out}/workbooks/{r['file']}" if not r["part"] else f"{out}/workbooks/{r['file'][:-5]} ({r['part'] + 1}).xlsx"
        _save(path, bytes(r["content"]))

    named = accepted.withColumns({"faculty": text.first_filled(F.col("faculty"), fallback="Невідомий факультет"), "program": text.first_filled(F.col("program"), fallback="Невідома програма")})
    workbooks.workbooks(named, ["asset_locator", "row_index"]).foreach(save)
    kept_columns = [c.split()[0] for c in models.NORMALIZED_ROW.split(", ")]
    workbooks.write_manifest(accepted.select(kept_columns), f"{out}/manifest")
    workbooks.write_manifest(review.select(kept_columns), f"{out}/review_queue")
    summaries.write.mode("overwrite").json(previous_path)
    excerpt = F.substring(F.trim(F.coalesce(F.nullif(F.col("raw_excerpt"), F.lit("")), F.nullif(F.col("subject"), F.lit("")), F.col("notes"))), 1, 240)
    top = report.top_with_examples(review.withColumn("__text", excerpt), ["source_name"], "qa_flags", "__text", ["asset_locator", "row_index"], 3, "flag")
    fixes = df.select(F.explode("autofix_actions").alias("action")).groupBy("action").agg(F.count("*").alias("n"))
    audits = quality.audit(named.withColumn("file", F.concat("faculty", F.lit("/"), "program")), "file", "course")
    reports = _report(out, "review_summary", top) | _report(out, "autofix_report", fixes) | _report(out, "qa_report", audits)
    if previous is not None:
        reports |= _report(out, "run_delta", report.delta(previous, summaries, "source_name", ["accepted_rows", "review_rows", "autofix_rows"]))
    reports["source_report"] = _save(f"{out}/source_summary.md", markdown(summaries.orderBy("source_name").collect()))  # one row a configured source
    counts = df.agg(F.count_if("accepted"), F.count_if(F.size("autofix_actions") > 0)).first()
    found = {r["status"]: r["n"] for r in audits.groupBy("status").agg(F.count("*").alias("n")).collect()}
    return models.RunOutput(f"{out}/workbooks", f"{out}/manifest", f"{out}/review_queue", reports, counts[0], review.count(), counts[1], found.get("warning", 0), found.get("fail", 0))


def run(spark: SparkSession, config: models.Config) -> models.RunOutput:
    rows, found, issues = collected(spark, config.sources)
    return finished(spark, config, rows, found, issues, config.sources)


def run_batched(spark: SparkSession, config: models.Config, size: int = 5, merge_existing: bool = False, all_sources: Iterable[models.Source] = ()) -> models.RunOutput:
    """Sources in batches; with ``merge_existing`` rows of all other sources come from the manifest of the run before."""
    if size < 1:
        raise ValueError("the batch size must be at least 1")
    sources, refreshed = list(config.sources), [s.name for s in config.sources]
    total = None
    for at in range(0, len(sources), size):
        batch = collected(spark, sources[at : at + size])
        rows = kept(batch[0], "run-batch")
        total = (rows, *batch[1:]) if total is None else tuple(a.unionByName(b) for a, b in zip(total, (rows, *batch[1:])))
    rows, found, issues = total
    if merge_existing:
        if not os.path.isdir(f"{config.output_dir}/manifest"):
            raise FileNotFoundError(f"no manifest to merge with below {config.output_dir}")
        old = kept(workbooks.read_manifest(spark, f"{config.output_dir}/manifest", models.NORMALIZED_ROW, refreshed), "run-old")
        old = old.drop("confidence", "qa_flags", "qa_severity").fillna("")
        rows = rows.unionByName(old, allowMissingColumns=True)
    return finished(spark, config, rows, found, issues, all_sources or config.sources, refreshed if merge_existing else None)


def inspected(spark: SparkSession, config: models.Config, source: str | None = None) -> DataFrame:
    """What the sources would bring: assets without their bytes."""
    return discovered(spark, settings.selected(config, [source] if source else None).sources)[0].drop("content")


def reference_audit(spark: SparkSession, path: str, most_rows: int = 200, most_values: int = 10) -> DataFrame:
    """(field, value, n): the most frequent values of each body column in the first rows of every sheet of a zip of filled workbooks."""
    entries = asset_sources.expand_zips(asset_sources.folder(spark, path, "reference"))
    rows = records.tabular_records(cell_sources.cells(entries)).where(F.col("row_index") <= most_rows + 2)
    values = F.array(*[F.struct(F.lit(c).alias("field"), F.regexp_replace(text.flat(F.col(c)), r"^(\d+)\.0$", "$1").alias("value")) for c in records.FIELDS])
    each = rows.select(F.explode(values).alias("v")).select("v.field", "v.value").where("value <> ''")
    ranked = report.top_elements(each.select("field", F.array("value").alias("xs")), ["field"], "xs", most_values, "value")
    return ranked.select("field", "value", "n")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabulon")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("run", "run-batched", "inspect-source"):
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--sources", nargs="*")
    batched = commands.choices["run-batched"]
    batched.add_argument("--batch-size", type=int, default=5)
    batched.add_argument("--merge-existing", action="store_true")
    audit = commands.add_parser("audit-reference")
    audit.add_argument("--zip", required=True)
    audit.add_argument("--max-rows-per-sheet", type=int, default=200)
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("tabulon").getOrCreate()
    if args.command == "audit-reference":
        print(json.dumps([r.asDict() for r in reference_audit(spark, args.zip, args.max_rows_per_sheet).orderBy("field", F.desc("n"), "value").collect()], ensure_ascii=False))
        return 0
    whole = settings.load(args.config)
    config = settings.selected(whole, args.sources)
    if args.command == "inspect-source":
        for asset in inspected(spark, config).toLocalIterator():  # a partition at a time, however many there are
            print(json.dumps(asset.asDict(), ensure_ascii=False, default=str))
        return 0
    if args.command == "run-batched":
        if args.merge_existing and not args.sources:
            p.error("--merge-existing needs --sources")
        done = run_batched(spark, config, args.batch_size, args.merge_existing, whole.sources if args.merge_existing else ())
    else:
        done = run(spark, config)
    print(json.dumps(done.__dict__, ensure_ascii=False, indent=1))
    return 0 if not done.qa_failures else 1


if __name__ == "__main__":
    raise SystemExit(main())
