"""Printed timetables: lines against a line reader with state, tables against expected records."""

import random

import pytest
from pyspark.sql import functions as F

from tabulon.functions import linecells
from tabulon.operators.linerecords import line_records, rowwise_records, table_records

LINES = "doc string, n int, text string"
CELLS = "sheet string, row int, col int, text string"
VOCABULARY = {
    "ПОНЕДІЛОК": ("day", "Понеділок"), "Середа": ("day", "Середа"), "9:00-10:20": ("time", "09:00", "10:20", ""), "10.40 – 12.00 Алгебра і геометрія": ("time", "10:40", "12:00", "Алгебра і геометрія"),
    "Історія науки": ("subject", "Історія науки"), "Теорія поля (лек)": ("subject", "Теорія поля (лек)"), "доц. Шашкова Л.О.": ("teacher", "доц. Шашкова Л.О."), "ауд.325": ("room", "ауд.325"),
    "https://zoom.us/j/1": ("link", "https://zoom.us/j/1"), "": ("blank",), "2 група": ("groups", "2 група"), "В10 Філософія": ("notes", "В10 Філософія"),
}


def read(lines):
    """Records by a reader with state."""
    day, pending, buffer, out, seen = "", None, [], [], set()

    def flush(index):
        nonlocal buffer, pending
        fields = {k: list(dict.fromkeys(x for kind, x in buffer if kind == k)) for k in ("subject", "teacher", "room", "link", "groups", "notes")}
        key = (day, pending, tuple(fields["subject"]), tuple(fields["groups"]), tuple(fields["teacher"]))
        if day and fields["subject"] and key not in seen:
            seen.add(key)
            out.append((index, day, *pending, *(sep.join(fields[k]) for k, sep in (("subject", " / "), ("teacher", "; "), ("room", "; "), ("link", " "), ("groups", "; "), ("notes", "; ")))))
        buffer, pending = [], None

    filled = [x for x in lines if x]
    for index, line in enumerate(filled, 1):
        kind, *said = VOCABULARY[line]
        if kind in ("day", "time") and buffer and pending:
            flush(index)
        if kind == "day":
            day = said[0]
        elif kind == "time":
            pending = said[0], said[1]
            buffer += [("subject", said[2])] if said[2] else []
        elif pending:
            buffer.append((kind, said[0]))
    if buffer and pending:
        flush(len(filled) + 1)
    return out


def test_lines_against_a_reader_with_state(spark):
    rnd = random.Random(4)
    docs = {f"d{k}": [rnd.choice([*VOCABULARY, "9:00-10:20", "Історія науки", "ПОНЕДІЛОК"]) for _ in range(rnd.randint(0, 25))] for k in range(120)}
    rows = [(d, i, x) for d, xs in docs.items() for i, x in enumerate(xs)] + [("null", 0, None)]
    names = ("row_index", "day", "start_time", "end_time", "subject", "teacher", "room", "link", "groups", "notes")
    got = {}
    for r in line_records(spark.createDataFrame(rows, LINES), ["doc"], "n", "text").collect():
        got.setdefault(r.doc, []).append(tuple(r[c] for c in names))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, xs in docs.items() if (x := read(xs))}


def test_roles(spark):
    cases = {
        "Удовиченко В.В. 506": {"teacher": "Удовиченко В.В.", "room": "506"}, "Аріон О.В. 402 https://knu-ua.zoom.us/j/8?pwd=t": {"teacher": "Аріон О.В.", "room": "402", "link": "https://knu-ua.zoom.us/j/8?pwd=t"},
        "Аріон О.В. Passcode: 12": {"teacher": "Аріон О.В.", "note": "Passcode: 12"}, "Аріон О.В. Методика викладання": {"subject": "Аріон О.В. Методика викладання"}, "ауд.325": {"room": "ауд.325"}, "ауд. 325": {"subject": "ауд. 325"},
        "1 група 2 група - Логіка": {"groups": ["1 група", "2 група"], "subject": "Логіка"}, "1 група": {"groups": ["1 група"]}, "для 1 групи": {"subject": "для 1 групи"}, "101 Екологія": {"note": "101 Екологія"},
        "Понеділок": {}, "9:00-10:20": {}, "Л е к ц і я": {"subject": "Лекція"}, "Zoom 123": {"link": "Zoom 123"},
    }
    df = spark.createDataFrame([(x,) for x in cases], "x string").select("x", linecells.role(linecells.line_text(F.col("x"))).alias("r"))
    empty = {"groups": [], "teacher": "", "room": "", "link": "", "note": "", "subject": ""}
    assert {r.x: r.r.asDict() for r in df.collect()} == {x: empty | want for x, want in cases.items()}


TABLES = {
    "grid": [["В10 Філософія", None, "1 курс", None], [None, None, "1 ГРУПА", None], ["КОЛІДЕНОП", "13.05 – 14.25", "", None], [None, "14.40 – 16.00", "Історія науки й техніки\nдоц. Шашкова Л.О.\nауд. 325", None]],
    "room": [["Програма", None, "ГЕОГРАФІЯ", None], ["", "ПОНЕДІЛОК", "1 курс", None], ["", "10.00 – 11.20", "Ландшафти України (пр)", None], ["", "", "Удовиченко В.В. 506", None]],
    "link": [["Програма", None, "ГЕОГРАФІЯ", None], ["", "ВІВТОРОК", "1 курс", None], ["", "10.00 – 11.20", "Міське планування (сем)", None], ["", "", "Аріон О.В. 402 https://knu-ua.zoom.us/j/84855063638?pwd=test", None]],
    "between": [["день", "час", "1 група", "2 група"], ["Середа", "8:00-9:20", "Логіка роботи", None], [None, None, "ауд.1", "Теорія поля"], [None, None, "Етика знання", "ауд.2"], ["Четвер", "8:00-9:20", None, "Етика знання"], [None, "9:30-10:50", "Етика знання", None]],
    "no axes": [["Зміст", "Логіка"], ["1", "2"]],
}


def as_cells(spark, tables):
    return spark.createDataFrame([(s, i, j, x) for s, rows in tables.items() for i, r in enumerate(rows) for j, x in enumerate(r)], CELLS)


@pytest.fixture(scope="module")
def tables(spark):
    out = {s: [] for s in TABLES}
    for r in table_records(as_cells(spark, TABLES), ["sheet"]).orderBy("row_index", "col", "subject").collect():
        out[r.sheet].append(r)
    return out


def test_grid_tables(tables):
    (r,) = tables["grid"]
    assert (r.day, r.start_time, r.end_time, r.subject, r.teacher, r.room, r.groups, r.course) == ("Понеділок", "14:40", "16:00", "Історія науки й техніки / ауд. 325", "доц. Шашкова Л.О.", "", "1 курс; 1 ГРУПА", "1")
    (r,) = tables["room"]
    assert (r.subject, r.teacher, r.room, r.day) == ("Ландшафти України (пр)", "Удовиченко В.В.", "506", "Понеділок")
    (r,) = tables["link"]
    assert (r.subject, r.teacher, r.room) == ("Міське планування (сем)", "Аріон О.В.", "402") and "zoom.us" in r.link
    assert tables["no axes"] == []


def test_cells_without_a_subject_go_to_both_neighbours(tables):
    got = [(r.row_index, r.col, r.day, r.start_time, r.subject, r.room, r.groups) for r in tables["between"]]
    assert got == [(2, 2, "Середа", "08:00", "Етика знання", "ауд.1", "1 група"), (2, 2, "Середа", "08:00", "Логіка роботи", "ауд.1", "1 група"), (2, 3, "Середа", "08:00", "Теорія поля", "ауд.2", "2 група"),
                   (5, 3, "Четвер", "08:00", "Етика знання", "", "2 група"), (6, 2, "Четвер", "09:30", "Етика знання", "", "1 група")]


def test_rowwise_tables(spark):
    table = [["№", "Шифр", "Назва дисципліни", "П.І.Б. викладача", "Понеділок", "Вівторок", "Середа"],
             ["1", "ОК.01", "Академічне письмо\nанглійською мовою\nдля всіх\nВ10 код", "доц. Александрук І.В.", "", "12:20-13:55", "8:00-9:20, 9:30-10:50"], ["2", "", "", "", "8:00-9:20", "", ""]]
    got = rowwise_records(as_cells(spark, {"rowwise": table} | TABLES), ["sheet"]).orderBy("day").collect()
    want = ("Академічне письмо; англійською мовою", "доц. Александрук І.В.", "для всіх; В10 код", 2)
    assert [(r.sheet, r.day, r.start_time, r.end_time, r.subject, r.teacher, r.notes, r.row_index) for r in got] == [("rowwise", "Вівторок", "12:20", "13:55", *want), ("rowwise", "Середа", "08:00", "10:50", *want)]


def test_tables_are_dealt_by_sheet_once_and_store_nothing(spark, monkeypatch):
    monkeypatch.setattr("tabulon.operators.linerecords.kept", lambda *_: pytest.fail("a table is stored"))
    for cells in (as_cells(spark, TABLES), as_cells(spark, TABLES).repartition(3, "sheet")):
        plan = table_records(cells, ["sheet"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_days_behind_the_quick_look(spark):
    cases = {"Понеділок": "Понеділок", "КОЛІДЕНОП": "Понеділок", "П'ЯТНИЦЯ (02.09)": "П'ятниця", "с е р е д а": "Середа", "авдерес": "", "второк, лекції": "Вівторок", "Предмет роботи": "", "дереса": "", "се(парна)реда": "Середа", "": ""}
    df = spark.createDataFrame([(x,) for x in cases], "x string").select("x", linecells.day(F.col("x")).alias("d"))
    assert {r.x: r.d for r in df.collect()} == cases


def test_tables_work_out_what_cells_say_once(spark, capsys):
    """filters on roles and subjects went below what works these out, so it ran once more for every mention."""
    cells = [("s", r, c, t) for r, row in enumerate([["день", "час", "1 група"], ["середа", "9:00-10:20", "Теорія поля"], [None, None, "\x1c"]]) for c, t in enumerate(row) if t]
    found = table_records(spark.createDataFrame(cells, CELLS), ["sheet"])
    found.explain()
    plan = [line for line in capsys.readouterr().out.splitlines() if "Filter" in line]
    assert plan and not any("zoom" in line for line in plan) and all(line.count("array_join") <= 1 for line in plan)
    assert [(r.day, r.start_time, r.subject, r.groups) for r in found.collect()] == [("Середа", "09:00", "Теорія поля", "1 група")]


def test_quick_looks_find_all_that_patterns_find(spark):
    """case-blind patterns also match long s and old forms of Cyrillic letters; a quick look must not miss these."""
    texts = ["teamſ", "ZOOM", "кᲂд 5", "КОД: 5", "İd: 7", "ıd: 7", "pin:", "Meet", "аᲃ", "доᲁ.", "onlİne", "ONLINE", "Каб. 5", "корпуᲃ 2", "АУД 1", "2 ГРУПА", "PhD", "Шашкова Л.О.", "викл", "Алгебра", ""]
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string").withColumn("low", linecells._folded(t))
    pairs = {"link": (linecells.LINK, linecells.may_hold_link(t, F.col("low"))), "room": (linecells.ROOM, linecells.may_hold_room(F.col("low"))),
             "teacher": (linecells.TEACHER, linecells.may_hold_teacher(t, F.col("low"))), "group": (linecells.GROUP, linecells.may_hold_group(F.col("low")))}
    missed = df.where(F.greatest(*[t.rlike(linecells.rx(p)) & ~may for p, may in pairs.values()])).collect()
    assert missed == [] and df.where(F.greatest(*[t.rlike(linecells.rx(p)) for p, _ in pairs.values()])).count() >= 17
