"""A run from a configuration to workbooks and reports, and what it is made of."""

import json
import zipfile

import pytest

from tabulon import config as settings
from tabulon import models, run
from tabulon.sinks import workbooks
from tabulon.sources import cells

HEAD = ["Тиждень", "День", "Початок", "Кінець", "Назва предмета", "Викладач", "Тип заняття", "Посилання (якщо є)", "Аудиторія (якщо є)", "Групи", "Курс", "Примітки"]
ROWS = [
    ["верхній", "Понеділок", "09:30", "10:50", "Алгебра (лек)", "Вовна О. В.", "", "", "214", "група 1", "2 курс", ""],
    ["", "", "", "", "Геометрія", "ВовнаО. В.", "", "", "", "група 1", "2.0", ""],
    ["", "Вівторок", "11:00", "", "12.09 Логіка та методи", "доц.; Коваль І. П.", "", "https://meet.example/a", "", "", "1", "інше"],
    ["", "Середа", "", "", "", "", "", "", "", "", "", "День самостійної роботи"],
    ["", "Середа", "13:00", "14:20", "ауд. 12", "", "", "", "", "", "1", ""],
]


@pytest.fixture
def project(tmp_path):
    source = tmp_path / "in" / "Хімічний факультет"
    source.mkdir(parents=True)
    (source / "Хімія полімерів.xlsx").write_bytes(workbooks.xlsx_bytes([("Розклад", [["назва"], HEAD, *ROWS])]))
    other = tmp_path / "law"
    other.mkdir()
    with zipfile.ZipFile(other / "all.zip", "w") as z:
        z.writestr("Право.csv", ",".join(HEAD) + "\n" + ",".join(ROWS[0]) + "\n")
        z.writestr("broken.xlsx", b"nothing")
    (tmp_path / "manual.yaml").write_text(json.dumps({"sources": {"web": [{"url": "https://example.org/a.xlsx", "display_name": "A"}]}}))
    config = {"template_path": "t.xlsx", "output_dir": "out", "manual_assets_path": "manual.yaml", "sources": [
        {"name": "chem-schedule", "kind": "folder", "path": "in"}, {"name": "law-schedule", "kind": "folder", "path": "law"}, {"name": "web", "kind": "web_page", "url": "https://example.org"}]}
    (tmp_path / "config.yaml").write_text(json.dumps(config))
    return tmp_path


def test_configuration(project):
    c = settings.load(project / "config.yaml")
    assert [s.name for s in c.sources] == ["chem-schedule", "law-schedule", "web"] and c.confidence_threshold == 0.74
    assert c.output_dir == str(project / "out") and c.sources[2].manual_assets == (models.ManualAsset("https://example.org/a.xlsx", "A"),)
    assert c.sources[0].schedule_keywords == settings.KEYWORDS and c.sources[0].recurse
    assert [s.name for s in settings.selected(c, ["web,chem-schedule"]).sources] == ["chem-schedule", "web"] and settings.selected(c, None) is c
    with pytest.raises(ValueError, match="Unknown source names: x"):
        settings.selected(c, ["x"])
    (project / "bad.yaml").write_text("{}")
    with pytest.raises(ValueError, match="template_path"):
        settings.load(project / "bad.yaml")
    (project / "m.yaml").write_text(json.dumps({"sources": {"a": [{}]}}))
    with pytest.raises(ValueError, match="url"):
        settings.manual_assets(str(project / "m.yaml"))


def test_run_and_refresh(spark, project):
    c = settings.load(project / "config.yaml")
    done = run.run(spark, c)
    rows = [r.asDict() for r in spark.read.schema(models.NORMALIZED_ROW).json(done.manifest).collect()]
    got = {(r["source_name"], r["subject"]): r for r in rows}
    first = got["chem-schedule", "Алгебра"]
    assert (first["week_type"], first["day"], first["start_time"], first["end_time"], first["lesson_type"], first["course"], first["program"]) == (
        "Верхній", "Понеділок", "09:30", "10:50", "лекція", "2", "Хімія полімерів")
    second = got["chem-schedule", "Геометрія"]
    assert (second["teacher"], second["start_time"], second["course"]) == ("Вовна О. В.", "09:30", "2")
    third = got["chem-schedule", "Логіка та методи"]
    assert third["teacher"] == "доц. Коваль І. П." and third["end_time"] == "12:20" and "12.09" in third["notes"] and "end_time_repaired" in third["autofix_actions"]
    review = spark.read.schema(models.NORMALIZED_ROW).json(done.review_queue).collect()
    assert done.accepted_rows == len(rows) and done.review_rows == len(review)
    assert any("missing_subject" in r.qa_flags and r.room == "ауд. 12" for r in review) and not any("самостійної" in r.notes for r in review)
    books = sorted(p.relative_to(project / "out" / "workbooks").as_posix() for p in (project / "out" / "workbooks").rglob("*.xlsx"))
    assert any(b.endswith("Хімія полімерів.xlsx") for b in books)
    texts = [x[-1] for x in cells.xlsx_cells((project / "out" / "workbooks" / next(b for b in books if "Хімія" in b)).read_bytes())]
    assert "Геометрія" in texts and "Назва предмета" in texts
    summary = {r["source_name"]: r.asDict() for r in spark.read.schema(models.SOURCE_SUMMARY).json(f"{c.output_dir}/source_summary").collect()}
    assert summary["chem-schedule"]["status"] == "parsed" and summary["web"]["status"] == "confirmed-blocker" and len(summary["web"]["runtime_issues"]) == 2
    assert any("BadZipFile" in x for x in summary["law-schedule"]["runtime_issues"]) and summary["law-schedule"]["discovered_assets"] == 2
    page = (project / "out" / "source_summary.md").read_text()
    assert page.startswith("# Source Summary\n\n## parsed\n- Chem Schedule - accepted=")
    assert {"review_summary_json", "autofix_report_xlsx", "qa_report_json", "source_report"} <= set(done.reports) and "run_delta_json" not in done.reports

    # one source is refreshed, the others keep rows and status
    again = run.run_batched(spark, settings.selected(c, ["law-schedule"]), size=1, merge_existing=True, all_sources=c.sources)
    assert again.accepted_rows == done.accepted_rows
    delta = {r["source_name"]: r for r in json.loads(open(again.reports["run_delta_json"]).read())}
    assert delta["chem-schedule"]["accepted_rows_delta"] == 0
    assert {r["source_name"]: r["status"] for r in spark.read.schema(models.SOURCE_SUMMARY).json(f"{c.output_dir}/source_summary").collect()}["web"] == "confirmed-blocker"
    with pytest.raises(ValueError):
        run.run_batched(spark, c, size=0)


def test_inspection_reference_audit_and_command_line(spark, project):
    c = settings.load(project / "config.yaml")
    assert sorted(r.asset_kind for r in run.inspected(spark, c).collect()) == ["local_file", "zip_entry", "zip_entry"]
    audit = {(r.field, r.value): r.n for r in run.reference_audit(spark, str(project / "law")).collect()}
    assert audit["subject", "Алгебра (лек)"] == 1 and ("course", "2 курс") in audit
    args = run.parser().parse_args(["run-batched", "--config", "x", "--sources", "a", "b,c", "--merge-existing"])
    assert (args.batch_size, args.sources, args.merge_existing) == (5, ["a", "b,c"], True)


def test_status_of_sources(spark):
    import pyspark.sql.functions as F

    rows = [(1, 0, 1, [], [], [], "parsed"), (0, 2, 1, ["HTTP 403 Forbidden"], [], [], "confirmed-blocker"), (0, 2, 1, [], ["missing_day"], [], "review-only"),
            (0, 2, 1, [], [], ["garbage_text"], "confirmed-blocker"), (0, 2, 1, [], ["odd"], [], "review-only"), (0, 0, 1, [], [], [], "confirmed-blocker"), (0, 0, 0, [], [], [], "confirmed-blocker")]
    df = spark.createDataFrame(rows, "a long, r long, f long, i array<string>, w array<string>, q array<string>, want string")
    got = df.select(run.status(*map(F.col, "arfiwq")).alias("s"), "want").collect()
    assert all(r.s.status == r.want for r in got)
    assert [r.s.note for r in got][1:3] == ["Access to the official source is blocked (HTTP 403 / Cloudflare)", run.INCOMPLETE]


def test_layouts_and_merges_of_a_run(spark):
    """A split-cell grid, a grid with axes and a table in one relation of cells; a table's metadata rows and continued subjects are merged."""
    grid = {"split": {(2, 1): "день", (2, 2): "час", (2, 3): "1 курс ІПЗ", (2, 4): "2 курс", (3, 3): "група А-1", (5, 1): "середа", (5, 2): "8:00-9:20", (5, 3): "Теорія поля (лек)", (8, 3): "Вовна О. В.", (12, 4): "1"},
            "axes": {(1, 3): "1 курс", (2, 3): "група 1", (4, 1): "Понеділок", (4, 2): "8:40-10:15", (4, 3): "Алгебра (лек)", (8, 1): "Вівторок", (8, 2): "10:35-12:10", (8, 3): "Геометрія"}}
    table = [["", "Середа", "13:00", "14:20", "Логіка та методи", "", "", "", "", "група 2", "", ""], ["", "Середа", "13:00", "14:20", "наукового пошуку", "Вовна О. В.", "", "", "", "група 2", "", ""],
             ["", "Четвер", "13:00", "14:20", "Психологія", "", "", "", "", "група 2", "", ""], ["", "Четвер", "13:00", "14:20", "", "", "", "https://meet.example/z", "214", "", "", ""],
             ["", "П'ятниця", "13:00", "14:20", "", "", "", "https://meet.example/y", "", "", "", ""]]
    places = [(s, r, c, x) for s, cs in grid.items() for (r, c), x in cs.items()] + [("table", r, c, x) for r, row in enumerate([HEAD, *table], 1) for c, x in enumerate(row, 1) if x]
    found = spark.createDataFrame([("f/a.xlsx", 0, s, r, r, c, c, x, None) for s, r, c, x in places], cells.CELLS)
    rows = run.sheet_records(found)
    assets = spark.createDataFrame([("f/a.xlsx", "fit-schedule", "file", "h")], "locator string, source_name string, asset_kind string, content_hash string")
    got = run.merged_rows(run.normalize.normalized(rows, assets)).collect()
    by = {(r.sheet_name, r.subject): r for r in got}
    assert set(by) == {("split", "Теорія поля"), ("axes", "Алгебра"), ("axes", "Геометрія"), ("table", "Логіка та методи наукового пошуку"), ("table", "Психологія")} and len(got) == 5
    split, cont, host = by["split", "Теорія поля"], by["table", "Логіка та методи наукового пошуку"], by["table", "Психологія"]
    assert (split.day, split.start_time, split.teacher, split.lesson_type, split.course) == ("Середа", "08:00", "Вовна О. В.", "лекція", "1")
    assert cont.teacher == "Вовна О. В." and "subject_continuation_merged" in cont.autofix_actions
    assert (host.room, host.link) == ("214", "https://meet.example/z") and "slot_metadata_merged" in host.autofix_actions
