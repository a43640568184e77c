"""Grid timetables, given as cells, come out as records."""

from tabulon.operators.gridrecords import grid_records
from tabulon.sources.cells import CELLS


def _run(spark, cells):
    rows = []
    for ref, text in cells.items():
        first, _, last = ref.partition(":")
        at = lambda r: (int(r[1:]), ord(r[0]) - 64)
        (r0, c0), (r1, c1) = at(first), at(last or first)
        rows.append(("g.xlsx", 0, "1 курс", r0, r1, c0, c1, text, None))
    return grid_records(spark.createDataFrame(rows, CELLS)).orderBy("row_index").collect()


def test_ranges_with_metadata_below_the_subject(spark):
    got = _run(spark, {"C1": "1 курс", "C2": "група 1", "A4": "Понеділок", "B4": "8:40-10:15", "C4": "Алгебра (лек)", "C5": "доц. Іваненко І.І.", "C6": "ауд. 101",
                       "A8": "Вівторок", "B8": "10:35-12:10", "C8": "Геометрія"})
    assert [(r.day, r.start_time, r.end_time, r.subject) for r in got] == [("Понеділок", "08:40", "10:15", "Алгебра"), ("Вівторок", "10:35", "12:10", "Геометрія")]
    assert (got[0].lesson_type, got[0].teacher, got[0].room, got[0].groups, got[0].course) == ("лекція", "доц. Іваненко І.І.", "ауд. 101", "група 1", "1")


def test_lone_starts_end_before_the_next(spark):
    got = _run(spark, {"C1": "1 курс", "C2": "група 1", "A4": "Понеділок (02.09.2019)", "B4:B5": "14:10", "C4": "Вступ до журналістики", "C5": "доц. Іваненко І.І.",
                       "A6": "Вівторок (03.09.2019)", "B6:B7": "15:50", "C6": "Медіаправо", "A8": "Середа (04.09.2019)", "B8": "17:30", "C8": "Практикум"})
    assert [(r.day, r.start_time, r.end_time, r.subject) for r in got] == [
        ("Понеділок", "14:10", "15:40", "Вступ до журналістики"), ("Вівторок", "15:50", "17:20", "Медіаправо"), ("Середа", "17:30", "18:50", "Практикум")]


def test_a_sheet_without_axes_has_no_records(spark):
    assert _run(spark, {"A1": "Зміст", "B2": "Алгебра"}) == []
