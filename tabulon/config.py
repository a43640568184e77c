"""The configuration file: YAML (or JSON, which YAML holds), with paths relative to it."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import replace
from pathlib import Path

from tabulon.models import Config, ManualAsset, Source

try:
    import yaml
except ImportError:  # JSON files still load
    yaml = None

# What a configuration leaves out.
KEYWORDS = ("розклад", "schedule", "занять", "пари", "semester", "lessons", "timetable")
OUTPUT, CACHE, THRESHOLD = "out", ".cache/tabulon", 0.74


def _read(path: Path) -> dict:
    text = path.read_text(encoding="utf-8")
    found = yaml.safe_load(text) if yaml else json.loads(text)
    return found or {}


def resolved(base: Path, raw: str | None) -> str | None:
    """A path of the file, absolute; addresses with a scheme stay."""
    if raw is None or "://" in raw:
        return raw
    return str((base / raw).resolve())


def required(base: Path, raw: str | None, name: str) -> str:
    found = resolved(base, raw)
    if found is None:
        raise ValueError(f"Config field '{name}' is required")
    return found


def manual_assets(path: str | None) -> dict[str, tuple[ManualAsset, ...]]:
    """Source name -> assets of the manual assets file."""
    if path is None:
        return {}
    block = _read(Path(path)).get("sources", {})
    if not isinstance(block, dict):
        raise ValueError("the manual assets file must hold a mapping 'sources'")
    found = {}
    for name, items in block.items():
        if not isinstance(name, str) or not isinstance(items, list):
            raise ValueError(f"manual assets of source {name!r} must be a list under a name")
        if not all(isinstance(i, dict) and isinstance(i.get("url"), str) for i in items):
            raise ValueError(f"every manual asset of source {name!r} needs a 'url'")
        found[name] = tuple(ManualAsset(i["url"], str(i.get("display_name", "")), str(i.get("asset_kind", "file_url"))) for i in items)
    return found


def load(path: str | Path) -> Config:
    path = Path(path).resolve()
    data, base = _read(path), path.parent
    seeds_path = resolved(base, data.get("manual_assets_path"))
    seeds = manual_assets(seeds_path)
    sources = []
    for n, item in enumerate(data.get("sources", []), start=1):
        name = item.get("name", f"source-{n}")
        sources.append(Source(
            name, item["kind"], resolved(base, item.get("path")), item.get("url"), bool(item.get("recurse", True)), tuple(item.get("allow_domains", ())),
            tuple(item.get("schedule_keywords", KEYWORDS)), int(item.get("follow_links_depth", 0)), seeds.get(name, ())))
    return Config(
        required(base, data.get("template_path"), "template_path"), required(base, data.get("output_dir", OUTPUT), "output_dir"),
        required(base, data.get("cache_dir", CACHE), "cache_dir"), float(data.get("confidence_threshold", THRESHOLD)), bool(data.get("ocr_enabled", True)),
        tuple(sources), seeds_path)


def source_names(wanted: Iterable[str] | None) -> set[str]:
    """Names that stand alone or between commas."""
    return {name for raw in wanted or () for name in (x.strip() for x in raw.split(",")) if name}


def selected(config: Config, wanted: Iterable[str] | None) -> Config:
    """The configuration with the wanted sources only (all, if none is named); an unknown name is an error."""
    names = source_names(wanted)
    unknown = sorted(names - {s.name for s in config.sources})
    if unknown:
        raise ValueError(f"Unknown source names: {', '.join(unknown)}")
    return replace(config, sources=tuple(s for s in config.sources if s.name in names)) if names else config
