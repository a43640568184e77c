"""Split-cell grids given as cells come out as records."""

import pytest
from pyspark.sql import functions as F

from tabulon.functions import splitcells, text, times
from tabulon.operators.grid import covering
from tabulon.operators.splitgrid import split_grid_records
from tabulon.sources.cells import CELLS

HEAD = {"A2": "день", "B2": "час", "C2:D2": "1 курс ІПЗ", "C3:D3": "група ІПЗ-11", "C4:D4": "підгрупа ІПЗ-11/1"}


SHEETS = {
    "block": HEAD | {"A5": "понеділок", "B5": "9:00-10:20", "C5:D7": "Архітектура комп'ютера (лаб) 12т", "C8:D8": "I тиждень", "C9:D9": "Вовна О. В.", "C10": "109 ауд.", "D10": "meet"},
    "teacher": HEAD | {"A5": "вівторок", "B5": "13:40-15:00", "C5:D5": "Блокчейн технології (Л) Меркулова К. В.", "C8:D8": "I тиждень", "C10": "203 ауд.", "D10": "meet"},
    "inline": HEAD | {"A5": "понеділок", "B5": "9:00-10:20", "C5:D7": "Алг. та прогр. [24.11] 307 ауд. ас. Гамоцька С.Л.", "C8:D8": "I тиждень", "C10": "306 ауд.", "D10": "https://meet.example/class"},
    "two": HEAD | {"A5": "вівторок", "B5": "13:40-15:00", "C5:D7": "Професійна та корпоративна етика [14.11] (C) [21.11] Методика викладання професійної освіти (C)",
                   "C8:D8": "I тиждень", "C9:D9": "доц. Іваненко І.І.", "C10": "211 ауд.", "D10": "https://meet.example/split"},
    "carried": {"A2": "день", "B2": "час", "C2:D2": "1 курс", "E2": "час", "F2": "2 курс", "C3": "А-1", "D3": "Б-1", "F3": "В-1", "A5": "середа", "B5:B6": "8:00-9:20", "B9": "9:30-10:50", "B10": "9:30",
                "C5": "Теорія ймовірностей", "D9:F9": "Історія науки", "E9": "Хибна колонка", "C10": "Вовна О. В."},
    "contents": {"A1": "Зміст", "B2": "Алгебра"}, "bare": HEAD | {"A12": "x"},
}


@pytest.fixture(scope="module")
def records(spark):
    """sheet -> its records; all sheets go through one run."""
    rows = []
    at = lambda r: (int(r[1:]), ord(r[0]) - 64)
    for sheet, cells in SHEETS.items():
        for ref, text in cells.items():
            first, _, last = ref.partition(":")
            (r0, c0), (r1, c1) = at(first), at(last or first)
            rows.append(("g.xlsx", 0, sheet, r0, r1, c0, c1, text, None))
    rows.append(("bad.xlsx", *[None] * 7, "BadZipFile"))
    out = {sheet: [] for sheet in SHEETS}
    for r in split_grid_records(spark.createDataFrame(rows, CELLS)).orderBy("row_index", "min_row", "min_col", "nth").collect():
        out[r.sheet_name].append(r)
    return out


def test_a_block_with_week_teacher_room_and_link(records):
    (r,) = records["block"]
    assert (r.day, r.start_time, r.end_time, r.subject, r.lesson_type) == ("Понеділок", "09:00", "10:20", "Архітектура комп'ютера", "лабораторне заняття")
    assert (r.week_type, r.teacher, r.room, r.link, r.groups, r.course, r.program) == ("Верхній", "Вовна О. В.", "109 ауд.", "meet", "підгрупа ІПЗ-11/1", "1", "block")
    assert r.notes == "T=12; I тиждень"


def test_a_teacher_behind_the_subject(records):
    (r,) = records["teacher"]
    assert (r.subject, r.teacher, r.lesson_type, r.room) == ("Блокчейн технології", "Меркулова К. В.", "лекція", "203 ауд.")


def test_date_room_and_teacher_inside_the_subject(records):
    (r,) = records["inline"]
    assert r.subject == "Алг. та прогр" and "Гамоцька С.Л." in r.teacher and "[24.11]" in r.notes
    assert (r.room, r.link) == ("306 ауд.; ауд. 307", "https://meet.example/class")


def test_two_dated_subjects_in_a_cell(records):
    a, b = records["two"]
    assert [r.subject for r in (a, b)] == ["Професійна та корпоративна етика", "Методика викладання професійної освіти"]
    assert "[14.11]" in a.notes and "[21.11]" in b.notes and "[21.11]" not in a.notes
    assert all((r.teacher, r.room, r.lesson_type) == ("доц. Іваненко І.І.", "211 ауд.", "семінар") for r in (a, b))


def test_headers_days_and_overlapping_blocks_are_carried(records):
    assert [(r.row_index, r.subject, r.day, r.groups, r.course, r.teacher) for r in records["carried"]] == [
        (5, "Теорія ймовірностей", "Середа", "А-1", "1", "Вовна О. В."), (5, "Історія науки", "Середа", "Б-1; В-1", "1; 2", ""),
        (6, "Історія науки", "Середа", "Б-1; В-1", "1; 2", ""), (9, "Історія науки", "Середа", "Б-1; В-1", "1; 2", "")]


def test_other_sheets_have_no_records(records):
    assert records["contents"] == [] and records["bare"] == []


def test_points_meet_the_rectangle_that_holds_them(spark):
    rects = [("s", 1, 1, 1, 40, "a"), ("s", 2, 70, 1, 1, "b"), ("s", 2, 2, 2, 2, "c"), ("t", 1, 1, 1, 1, "d")]
    cells = spark.createDataFrame(rects, "sheet string, min_row int, max_row int, min_col int, max_col int, text string")
    points = spark.createDataFrame([(s, r, c) for s in "st" for r in (1, 2, 33, 70, 71) for c in (1, 2, 40, 41)], "sheet string, row int, col int")
    got = {(r.sheet, r.row, r.col): r.text for r in covering(points, cells, ["sheet"]).collect()}
    assert got == {(p.sheet, p.row, p.col): x for p in points.collect() for s, a, b, c, d, x in rects if (s, True, True) == (p.sheet, a <= p.row <= b, c <= p.col <= d)}


KINDS = {"": "ignore", "12.0": "ignore", "понеділок": "ignore", "9:00-10:20": "ignore", "Zoom 123": "link", "ауд. 12": "room", "доц. Вовна О. В.": "teacher", "доц.": "teacher",
         "Архітектура комп'ютера Вовна О. В.": "subject", "[02.10, 09.10]": "week", "Pwd9xA7": "ignore", "***": "ignore", "Теорія поля": "subject"}


def test_kinds(spark):
    df = spark.createDataFrame([(t,) for t in KINDS], "t string").select("t", splitcells.kind(F.col("t")).alias("k"))
    assert {r.t: r.k for r in df.collect()} == KINDS


def test_sheets_and_blocks_meet_without_the_driver(spark, capsys):
    """steps kept as small files have a row for every sheet or block; none of them is broadcast."""
    rows = [("g.xlsx", 0, "s", int(a[1:]), int(a[1:]), ord(a[0]) - 64, ord(a[0]) - 64, t, None)
            for a, t in {"A2": "день", "B2": "час", "C2": "1 курс", "C3": "А-1", "A5": "середа", "B5": "9:00-10:20", "C5": "Теорія поля", "C12": "ауд. 12", "D13": "x"}.items()]
    found = split_grid_records(spark.createDataFrame(rows, CELLS))
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert [(r.row_index, r.day, r.subject, r.groups, r.room) for r in found.collect()] == [(5, "Середа", "Теорія поля", "А-1", "ауд. 12")]


def test_points_meet_rectangles_of_any_size_once(spark):
    """rectangles inside one bin, over its edge and over many bins, on both sides of zero, against all pairs."""
    edges = (-70, -9, -8, -1, 0, 7, 8, 31, 32, 63, 64, 255, 256, 300)
    rects = [("s", a, b, c, d, f"{a},{b},{c},{d}") for a in edges[::2] for b in edges[1::2] if a <= b for c in edges[1::3] for d in edges[2::3] if c <= d]
    cells = spark.createDataFrame(rects, "sheet string, min_row int, max_row int, min_col int, max_col int, text string")
    points = [(r, c) for r in edges for c in edges]
    got = covering(spark.createDataFrame([("s", *p) for p in points], "sheet string, row int, col int"), cells, ["sheet"])
    assert sorted((r.row, r.col, r.text) for r in got.collect()) == sorted((r, c, x) for r, c in points for _, a, b, e, f, x in rects if a <= r <= b and e <= c <= f)


def test_a_rectangle_is_shuffled_once_or_nearly(spark, monkeypatch):
    """rectangles up to forty columns wide were spread over bins of eight columns, 3.6 rows each."""
    rects = spark.range(1000).selectExpr("'s' AS sheet", "1 AS min_row", "1 AS max_row", "cast(id % 11 AS int) AS min_col", "cast(id % 11 + id % 40 AS int) AS max_col", "id AS text")
    sides, real = [], F.explode
    monkeypatch.setattr(F, "explode", lambda x: (sides.append(x), real(x))[1])
    covering(spark.createDataFrame([], "sheet string, row int, col int"), rects, ["sheet"])
    assert rects.select(F.sum(F.size(sides[0]))).first()[0] <= 1100


def test_cells_meet_their_texts_and_then_are_dealt_by_sheet_once(spark, capsys):
    """blocks met cells, metadata, subjects and headers by joins of their own, a dozen shuffles; subjects of one place share what stands under the wider one."""
    rows = [("g.xlsx", 0, "s", r0, r1, c0, c1, t, None) for r0, r1, c0, c1, t in (
        (2, 2, 1, 1, "день"), (2, 2, 2, 2, "час"), (2, 2, 3, 3, "1 курс"), (2, 2, 4, 4, "2 курс"), (5, 5, 1, 1, "середа"), (5, 6, 2, 2, "9:00-10:20"), (8, 8, 2, 2, "10:30-"),
        (6, 6, 3, 3, "Теорія поля"), (6, 6, 3, 4, "Теорія чисел"), (13, 13, 4, 4, "ауд. 12"), (13, 13, 5, 5, "ауд. 13"))]
    found = split_grid_records(spark.createDataFrame(rows, CELLS))
    found.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") <= 4
    got = sorted((r.row_index, r.subject, r.room, r.course) for r in found.collect())
    assert got == [(5, "Теорія поля", "", "1; 2"), (5, "Теорія чисел", "", "1; 2"), (6, "Теорія поля", "ауд. 12", "1; 2"), (6, "Теорія чисел", "ауд. 12", "1; 2")]


def test_quick_looks_change_no_text(spark):
    """texts without a mark are canonical as they stand, plain weekdays need no closer look."""
    texts = ["", " ", None, "Алгебра", "ауд 12", "АУД  12 ;", "лек", "лек...", "ПРАКТ x", "a|b", "a / b", " ,a", "a;", "Sem..", "lab", "a\u00a0 b", "аудит", "ауд\u00a012", ";", "середа", "СЕРЕДА", " середа", "сереДа\n", "ц е р"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.service_tokens(F.col("t")).alias("a"), text._service_tokens(text.flat(F.col("t"))).alias("b"), times.weekday(F.col("t")).alias("d"))
    got = df.collect()
    assert [r.a for r in got] == [r.b for r in got] and [r.d for r in got if r.t and "серед" in r.t.lower()] == ["Середа"] * 4
