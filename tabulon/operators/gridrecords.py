"""Two-dimensional timetables: a grid of cells to schedule records, by joins only.

Days and times stand on two axis columns, subjects right of them, and teachers,
rooms and links in cells near the subject they belong to.  Every step is keyed by
sheet, so sheets spread over tasks; a sheet's cells never meet in one Python object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import classify, text, times
from tabulon.functions.text import flat, rx
from tabulon.operators.grid import overlap_join
from tabulon.operators.rows import argmax_first, first_wins, next_distinct

SHEET = ["locator", "sheet_ord", "sheet_name"]
#: Axes are looked for in the sheet's first rows and columns.
AXIS_ROWS, AXIS_COLUMNS = 150, 4
NEAR_ROWS = 2
# Lesson marks in brackets, header words, group codes and noise in headers.
LESSON_MARKS = {
    "л": "лекція", "лек": "лекція", "лекція": "лекція", "lec": "лекція", "лаб": "лабораторне заняття", "лабораторна": "лабораторне заняття",
    "лабораторне": "лабораторне заняття", "пр": "практичне заняття", "практ": "практичне заняття", "практична": "практичне заняття",
    "практичне": "практичне заняття", "практика": "практика", "сем": "семінар", "с": "семінар", "семінар": "семінар",
}
HEADER_WORDS = ("дні", "години", "день", "час", "час занять", "курс", "група", "підгрупа")
COURSE = r"\b(\d+)\s*курс\b"
GROUP = r"\b(?:група|підгрупа|subgroup|кластер|cluster|потік|stream)\b"
GROUP_CODE = r"^[A-ZА-ЯІЇЄҐ]{1,8}-\d{1,2}[A-ZА-ЯІЇЄҐa-zа-яіїєґ0-9-]{0,8}$"
HEADER_NOISE = (r"\b(?:https?://|zoom|teams|meet|факультет|інститут|навчальний рік|семестр|погоджую|затверджую|декан|настановчої сесії|екзаменаційної сесії"
                r"|січня|лютого|березня|квітня|травня|червня|липня|серпня|вересня|жовтня|листопада|грудня)\b")
WEEK_MARKS = ((r"\bч/т\b", "Через тиждень"), (r"\b(?:i|1)\s*тиж", "Верхній"), (r"\b(?:ii|2)\s*тиж", "Нижній"), (r"\bверх", "Верхній"), (r"\bниж", "Нижній"),
              (r"\bнепар", "Верхній"), (r"\bпарн", "Нижній"))


def _is_day(x: Column) -> Column:
    return times.weekday(x).isin(*dict.fromkeys(times.WEEKDAYS.values()))


def cell_kind(x: Column) -> Column:
    """day, time, link, room, teacher, subject or ignore."""
    t, key = flat(x), text.header_key(x)
    timed = (times.parse_range(t)["end"] != "") | t.rlike(r"^\d{1,2}[:.]\d{2}\s*[-–—]?\s*$")
    return (F.when((t == "") | key.rlike(rx(r"^(?:[ivxіх]+|\d+)\s*курс$")) | key.isin(*HEADER_WORDS), "ignore").when(_is_day(t), "day").when(timed, "time")
            .when(classify.has_link(t), "link").when(classify.is_roomish_subject(t) | classify.is_room(t) | t.rlike(rx(r"\d\s*ауд\b")), "room")
            .when(classify.is_teacher(t), "teacher").when(~t.rlike(r"\p{L}"), "ignore").otherwise("subject"))


def row_gap(a: str, b: str) -> Column:
    return F.greatest(F.lit(0), F.col(f"{b}_min_row") - F.col(f"{a}_max_row"), F.col(f"{a}_min_row") - F.col(f"{b}_max_row"))


def axes(cells: DataFrame) -> DataFrame:
    """(sheet, day_col, time_col, first_day_row) of the sheets that have both axes, ties to the left column."""
    near = cells.where((F.col("min_row") <= AXIS_ROWS) & (F.col("min_col") <= AXIS_COLUMNS) & F.col("kind").isin("day", "time"))
    score = near.groupBy(*SHEET, "kind", F.col("min_col").alias("axis")).agg(
        F.sum(F.col("max_row") - F.col("min_row") + 1).alias("hits"), F.min("min_row").alias("first_row"))
    day = argmax_first(score.where("kind = 'day'"), SHEET, "axis", "hits").select(*SHEET, F.col("axis").alias("day_col"))
    time = argmax_first(score.where("kind = 'time'"), SHEET, "axis", "hits").select(*SHEET, F.col("axis").alias("time_col"))
    first = score.where("kind = 'day'").groupBy(*SHEET).agg(F.min("first_row").alias("first_day_row"))
    return day.join(time, SHEET).join(first, SHEET)


def slots(placed: DataFrame) -> DataFrame:
    """Time cells with start, end and the rows they rule; a lone start ends ten minutes before the next, or after a slot."""
    axis = placed.where((F.col("kind") == "time") & (F.col("min_col") == F.col("time_col"))).select(
        *SHEET, "min_row", "max_row", times.parse_range(flat(F.col("text"))).alias("r"), times.parse(F.col("text")).alias("one"))
    axis = axis.withColumn("start", F.when(F.col("r.end") != "", F.col("r.start")).otherwise(F.col("one"))).withColumn("has_end", F.col("r.end") != "")
    runs = next_distinct(axis, SHEET, ["min_row"], "start", "following")
    after = F.lead("min_row").over(Window.partitionBy(*SHEET).orderBy("min_row"))
    end = F.when(F.col("has_end"), F.col("r.end")).otherwise(F.coalesce(times.shift(F.col("following"), -10), times.shift(F.col("start"), times.SLOT_MINUTES)))
    ruled = runs.withColumn("next_row", after).withColumn("end", end).withColumn(
        "max_row", F.when(~F.col("has_end") & F.col("next_row").isNotNull(), F.greatest("max_row", F.col("next_row") - 1)).otherwise(F.col("max_row")))
    whole = axis.where("has_end").select(*SHEET, "min_row", "max_row", F.col("start"), F.col("r.end").alias("end"))
    return ruled.where("NOT has_end").select(*SHEET, "min_row", "max_row", "start", "end").unionByName(whole)


def _side(df: DataFrame, p: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{p}_{c}") for c in df.columns])


def _meet(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, [F.col(f"a_{s}") == F.col(f"b_{s}") for s in SHEET])


def grid_records(cells: DataFrame) -> DataFrame:
    """Records (sheet, row_index, day, start_time, end_time, subject, ...) of every grid sheet; repeats of a record count once."""
    known = cells.where("error IS NULL").withColumn("kind", cell_kind(F.col("text")))
    placed = known.join(axes(known), SHEET).withColumn("body_col", F.greatest("day_col", "time_col") + 1)
    body = placed.where(F.col("min_row") >= F.col("first_day_row"))
    id_ = ["a_locator", "a_sheet_ord", "a_sheet_name", "a_min_row", "a_max_row", "a_min_col", "a_max_col", "a_text"]
    place = [*SHEET, "min_row", "max_row", "min_col", "max_col", "text"]
    subjects = body.where((F.col("kind") == "subject") & (F.col("min_col") >= F.col("body_col"))).select(*place, "body_col")
    a = _side(subjects, "a")

    # time: the slots nearest in rows, from the earliest start to the latest end
    timed = _meet(a, _side(slots(body), "b")).withColumn("gap", row_gap("a", "b")).where(F.col("gap") <= NEAR_ROWS)
    by_gap = timed.groupBy(*id_, "gap").agg(F.min("b_start").alias("s"), F.max("b_end").alias("e"))
    when = by_gap.groupBy(*id_).agg(F.min_by(F.struct("s", "e"), "gap").alias("t"))

    # day: over the subject's own columns, else on the axis, else the nearest at all
    gap, off = row_gap("a", "b"), F.abs(F.col("a_min_row") - F.col("b_min_row"))
    over = (F.col("a_min_col") <= F.col("b_max_col")) & (F.col("b_min_col") <= F.col("a_max_col"))
    tier = F.when(over & (gap <= NEAR_ROWS), 1).when((F.col("b_max_col") < F.col("a_body_col")) & (gap <= 3), 2).otherwise(3)
    days = _meet(a, _side(body.where("kind = 'day'").select(*place), "b"))
    day = days.groupBy(*id_).agg(F.min_by("b_text", F.struct(tier, gap, off, F.col("b_min_row"), F.col("b_min_col"))).alias("day_text"))

    # teachers, rooms and links: cells that share a column and lie within two rows
    extras = body.where(F.col("kind").isin("teacher", "room", "link")).select(*place, "kind")
    pairs = overlap_join(subjects.drop("body_col"), extras, SHEET, "min_col", "max_col", gap=row_gap("a", "b") <= NEAR_ROWS)
    ordered = lambda kind: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(
        F.col("b_kind") == kind, F.struct("b_min_row", "b_min_col", flat(F.col("b_text")).alias("x"))))), lambda s: s["x"])), "; ")
    meta = pairs.groupBy(*id_).agg(*[ordered(k).alias(k) for k in ("teacher", "room", "link")])

    # courses and groups: header cells above the first day that share a column
    heads = placed.where((F.col("max_row") < F.col("first_day_row")) & (F.col("max_col") >= F.col("body_col"))).select(*place)
    course = F.regexp_extract(text.header_key(F.col("b_text")), rx(COURSE), 1)
    is_group = (course == "") & ~flat(F.col("b_text")).rlike(rx(HEADER_NOISE)) & (text.header_key(F.col("b_text")).rlike(rx(GROUP)) | flat(F.col("b_text")).rlike(GROUP_CODE))
    above = overlap_join(subjects.drop("body_col"), heads, SHEET, "min_col", "max_col")
    in_order = lambda cond, value: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(
        F.when(cond, F.struct("b_min_col", "b_min_row", value.alias("x"))))), lambda s: s["x"])), "; ")
    context = above.groupBy(*id_).agg(in_order(course != "", course).alias("course"), in_order(is_group, flat(F.col("b_text"))).alias("groups"))

    on = lambda l, r: [F.col(f"{l}.{c}").eqNullSafe(F.col(f"{r}.{c}")) for c in id_]
    whole = (when.alias("w").join(day.alias("d"), on("w", "d")).join(meta.alias("m"), on("w", "m"), "left").join(context.alias("c"), on("w", "c"), "left"))
    raw = flat(F.col("w.a_text"))
    mark = F.lower(F.regexp_extract(raw, r"\((\p{L}{1,12})\.?\)", 1))
    lesson = F.coalesce(*[F.when(mark == k, F.lit(v)) for k, v in LESSON_MARKS.items()], F.lit(""))
    subject = F.when(lesson == "", raw).otherwise(flat(F.regexp_replace(raw, r"\s*\(\p{L}{1,12}\.?\).*$", "")))
    week = F.coalesce(*[F.when(raw.rlike(rx(p)), F.lit(v)) for p, v in WEEK_MARKS], F.lit(""))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    records = whole.select(
        F.col("w.a_locator").alias("locator"), F.col("w.a_sheet_ord").alias("sheet_ord"), F.col("w.a_sheet_name").alias("sheet_name"),
        F.col("w.a_min_row").alias("row_index"), F.col("w.a_min_col").alias("col_index"), times.weekday(F.col("d.day_text")).alias("day"),
        F.col("t.s").alias("start_time"), F.col("t.e").alias("end_time"), subject.alias("subject"), lesson.alias("lesson_type"), week.alias("week_type"),
        blank("m.teacher").alias("teacher"), blank("m.room").alias("room"), blank("m.link").alias("link"), blank("c.groups").alias("groups"), blank("c.course").alias("course"))
    records = records.where((F.col("start_time") != "") & (F.col("end_time") != "") & (F.length("subject") >= 3) & ~classify.is_forbidden_subject(F.col("subject")))
    return first_wins(records, [*SHEET, "day", "start_time", "end_time", "subject", "groups", "course"], ["row_index", "col_index"])
