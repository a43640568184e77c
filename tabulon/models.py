"""Relations and settings of a run: schemas of records, rows, summaries and audits, and the configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

TEXT_FIELDS = ("program", "faculty", "week_type", "day", "start_time", "end_time", "subject", "teacher", "lesson_type", "link", "room", "groups", "course", "notes")

#: A record as a sheet gives it.
RAW_RECORD = ("source_name string, locator string, sheet_name string, row_index int, " + ", ".join(f"{c} string" for c in TEXT_FIELDS)
              + ", raw_excerpt string, warnings array<string>")
#: A row of the manifest.
NORMALIZED_ROW = (", ".join(f"{c} string" for c in TEXT_FIELDS) + ", week_source string, sheet_name string, source_name string, source_kind string, source_root_url string, "
                  "asset_locator string, source_url_or_path string, confidence double, warnings array<string>, autofix_actions array<string>, qa_flags array<string>, "
                  "qa_severity string, raw_excerpt string, content_hash string")
SOURCE_SUMMARY = ("source_name string, source_root_url string, status string, accepted_rows long, review_rows long, autofix_rows long, discovered_assets long, "
                  "attempted_assets long, discovery_issues array<string>, runtime_issues array<string>, top_review_warnings array<string>, "
                  "top_review_qa_flags array<string>, note string")
SHEET_AUDIT = "sheet_name string, row_count long, issue_count long, issues array<string>"
WORKBOOK_AUDIT = f"file_path string, status string, row_count long, issue_count long, issues array<string>, sheets array<struct<{SHEET_AUDIT}>>"


@dataclass(frozen=True)
class ManualAsset:
    """An asset that a user names beside what is discovered."""

    url: str
    display_name: str = ""
    asset_kind: str = "file_url"


@dataclass(frozen=True)
class Source:
    name: str
    kind: str
    path: str | None = None
    url: str | None = None
    recurse: bool = True
    allow_domains: tuple[str, ...] = ()
    schedule_keywords: tuple[str, ...] = ()
    follow_links_depth: int = 0
    manual_assets: tuple[ManualAsset, ...] = ()


@dataclass(frozen=True)
class Config:
    template_path: str
    output_dir: str
    cache_dir: str
    confidence_threshold: float
    ocr_enabled: bool
    sources: tuple[Source, ...]
    manual_assets_path: str | None = None


@dataclass(frozen=True)
class RunOutput:
    """Where a run's results lie, and how many there are."""

    workbooks: str
    manifest: str
    review_queue: str
    reports: dict[str, str] = field(default_factory=dict)
    accepted_rows: int = 0
    review_rows: int = 0
    autofix_rows: int = 0
    qa_warnings: int = 0
    qa_failures: int = 0
