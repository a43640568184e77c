"""Printed timetables: lines and tables of cells to schedule records.

A line reader's state (day, pending time, buffered lines) is told by islands: a time begins a segment, a segment's text runs from its first
content line to the next day line, and the day is the last one before that content.  Tables find their axes by scores, their blocks by rows that hold a day or
time, and in a block's column every cell with a subject takes the cells without one around it.  In all of them a record's fields are folded from the
roles of its lines.  Line readers work these out once a distinct line; tables do so in place, since to meet a list of distinct lines all cells would
have to be shuffled by text and back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import linecells
from tabulon.functions.text import flat
from tabulon.operators.rows import fill_down, first_wins, island, ordered
from tabulon.sources.scratch import kept

FIELDS = ("teacher", "room", "link", "note", "subject")


def assembled(items: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, subject, teacher, link, room, groups, course, notes) of records from their ``items``.

    An item has the record's keys, its order, a clean ``line`` and ``is_header``; header lines give groups and courses only.  Records without a subject are left out.
    Distinct values of a field are joined in order: subjects by a stroke, links by a space, others by a semicolon.
    """
    header = F.col("is_header")
    roles = kept(items.where(~header).select("line").distinct().withColumn("r", linecells.role(F.col("line"))), "line-roles")
    known = items.join(roles, "line", "left")
    of = lambda xs: F.when(header, F.array().cast("array<string>")).otherwise(xs)
    groups = F.when(header, F.array(linecells.header_groups(F.col("line")))).otherwise(F.col("r.groups"))
    course = F.when(header, F.array(linecells.header_course(F.col("line")))).otherwise(F.array().cast("array<string>"))
    fields = {f: of(F.array(f"r.{f}")) for f in FIELDS} | {"groups": groups, "course": course}
    seq = {"subject": " / ", "link": " "}
    joined = lambda f, xs: F.array_join(F.array_distinct(F.filter(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*order, xs.alias("x")))), lambda s: s["x"])), lambda v: v != "")), seq.get(f, "; "))
    found = known.groupBy(*keys).agg(*[joined(f, xs).alias(f) for f, xs in fields.items()])
    return found.where("subject <> ''").withColumnRenamed("note", "notes")


def valid(records: DataFrame, source: list[str], order: list) -> DataFrame:
    """Records with day, times and a subject that may stand, the first of those equal in day, times, subject, groups and teacher."""
    # by one name, as the filter goes below what works the subject out and would do so once a mention
    whole = (F.col("day") != "") & (F.col("start_time") != "") & (F.col("end_time") != "") & linecells.let(F.col("subject"), linecells.may_be_subject)
    return first_wins(records.where(whole), [*source, "day", "start_time", "end_time", "subject", "groups", "teacher"], order)


def _timed(df: DataFrame, line: str) -> DataFrame:
    """``df`` plus day, start_time and end_time of a line, worked out once a distinct line."""
    known = df.select(line).distinct().withColumn("__clean", linecells.line_text(F.col(line))).withColumn("__span", linecells.span(linecells.time_ranges(F.col("__clean"))))
    known = known.select(line, linecells.day(F.col("__clean")).alias("day"), F.col("__span.start").alias("start_time"), F.col("__span.end").alias("end_time"))
    return df.join(kept(known, "line-times"), line)


def _times_of(line: Column) -> Column:
    """struct(day, start, end) of a clean line."""
    return linecells.let(line, lambda t: linecells.let(linecells.span(linecells.time_ranges(t)), lambda s: F.struct(linecells.day(t).alias("day"), s["start"].alias("start"), s["end"].alias("end"))))


def _heads(lines: Column) -> Column:
    """struct(groups, course) of each header line that tells neither a day nor a time."""
    plain = F.filter(lines, lambda t: linecells.let(_times_of(t), lambda s: (s["day"] == "") & (s["start"] == "")))
    return F.transform(plain, lambda t: F.struct(linecells.header_groups(t).alias("groups"), linecells.header_course(t).alias("course")))


def line_records(lines: DataFrame, doc: list[str], place: str, line: str) -> DataFrame:
    """(doc, row_index, day, start_time, end_time, subject, ...) from ordered lines of documents.

    Blank lines don't count; ``row_index`` is the number of the line that ends a record, one past the last for an open one.  Lines before a document's first
    time, and those between a day that ends a record and the next time, belong to none.  A time line's own rest is content; a day between a time and its
    first content is that record's day.  Repeated line numbers are read in the order of their texts.
    """
    clean = lines.select(*doc, F.col(place).alias("__place"), linecells.line_text(F.col(line)).alias("line")).where("line <> ''")
    placed = clean.withColumn("n", F.row_number().over(ordered(doc, ["__place", "line"])))
    known = kept(_timed(placed.drop("__place"), "line"), "line-kinds")
    is_day, is_time = F.col("day") != "", (F.col("day") == "") & (F.col("start_time") != "")
    known = island(known.withColumns({"is_day": is_day, "is_time": is_time}), doc, ["n"], is_time, "seg")
    text = F.when(F.col("is_time"), linecells.without_times(F.col("line"))).when(~F.col("is_day"), F.col("line")).otherwise("")
    known = fill_down(known.withColumns({"content": text, "said": F.col("day")}), doc, ["n"], ["said"]).where("seg > 0")
    mine = ordered([*doc, "seg"], ["n"]).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = known.withColumn("first", F.min(F.when(F.col("content") != "", F.col("n"))).over(mine)).withColumn("last", F.max("n").over(mine))
    known = known.withColumn("stop", F.min(F.when(F.col("is_day") & (F.col("n") > F.col("first")), F.col("n"))).over(mine)).withColumn("stop", F.coalesce("stop", F.col("last") + 1))
    known = kept(known.where((F.col("n") < F.col("stop")) & F.col("first").isNotNull()), "line-segments")
    time = lambda c: F.max(F.when(F.col("is_time"), F.col(c))).alias(c)
    about = known.groupBy(*doc, "seg").agg(F.max("stop").alias("row_index"), F.coalesce(F.max(F.when(F.col("n") == F.col("first"), F.col("said"))), F.lit("")).alias("day"), time("start_time"), time("end_time"))
    items = known.where("content <> ''").select(*doc, "seg", "n", F.col("content").alias("line"), F.lit(False).alias("is_header"))
    found = about.join(assembled(items, [*doc, "seg"], ["n"]), [*doc, "seg"])
    return valid(found, doc, ["seg"]).drop("seg")


def _on_axis(sheet: list[str], column: list[str], found: str, word: str) -> tuple[Column, Column]:
    """(score, headed) of a cell's column for an axis: its cells that have what is ``found``, with the first one's row; whether its word heads it."""
    hit, here = F.col(found) != "", Window.partitionBy(*column)
    score = F.struct((-F.count_if(hit).over(here)).alias("less"), F.min(F.when(hit, F.col("row"))).over(here).alias("at"), F.col("col"))
    return score, F.max((F.col("row") == F.col("first") - 1) & (F.lower(flat(F.col("text"))) == word)).over(here)


def table_records(cells: DataFrame, sheet: list[str], row: str = "row", col: str = "col", text: str = "text") -> DataFrame:
    """(sheet, row_index, col, day, start_time, end_time, subject, ...) of grid tables: days and times on axis columns, subjects in the others.

    ``row`` and ``col`` count from 0; ``row_index`` is the number, from 1, of a block's first row.  Tables without both axes give none.  Cells of one place must be one.

    Every step is a window or a grouping within a sheet, so the cells are dealt by sheet once, or not at all where they come dealt so; nothing is stored between.
    """
    cells = cells.select(*sheet, F.col(row).alias("row"), F.col(col).alias("col"), F.col(text).alias("text")).where(F.col("text").rlike(r"(?U)\S"))
    known = cells.withColumn("t", _times_of(linecells.line_text(F.col("text")))).select("*", F.col("t.day").alias("day"), F.col("t.start").alias("start"), F.col("t.end").alias("end")).drop("t")
    whole, column = Window.partitionBy(*sheet), [*sheet, "col"]
    known = known.withColumn("first", F.min(F.when((F.col("day") != "") | (F.col("start") != ""), F.col("row"))).over(whole)).where("first IS NOT NULL")

    # an axis is every column with two hits or headed by its word; the best-scored column where there is none
    for name, found, word in (("days", "day", "день"), ("hours", "start", "час")):
        score, headed = _on_axis(sheet, column, found, word)
        known = known.withColumns({"score": score, "sure": headed}).withColumn("sure", F.col("sure") | (F.col("score.less") <= -2))
        known = known.withColumns({"any": F.max("sure").over(whole), "best": F.min(F.when(F.col("score.less") < 0, F.col("score"))).over(whole)})
        known = known.where(F.col("any") | F.col("best").isNotNull()).withColumn(name, F.when(F.col("any"), F.col("sure")).otherwise(F.col("col") == F.col("best.col"))).drop("score", "sure", "any", "best")
    above = F.when((F.col("row") < F.col("first")) & ~F.col("days") & ~F.col("hours"), F.struct("row", _heads(linecells.cell_lines(F.col("text"))).alias("said")))
    known = known.withColumn("above", above).withColumn("above", F.array_sort(F.collect_list("above").over(Window.partitionBy(*column))))

    # a block begins where a row tells a day or a time; day and times last until the next are told
    body, in_row, upto = known.where(F.col("row") >= F.col("first")), Window.partitionBy(*sheet, "row"), ordered(sheet, ["row"])
    on_hours = F.col("hours") & (F.col("start") != "")
    body = body.withColumns({"next_day": F.min(F.when(F.col("days") & (F.col("day") != ""), F.struct("col", "day"))).over(in_row)["day"],
                             "next_start": F.min(F.when(on_hours, F.col("start"))).over(in_row), "next_end": F.max(F.when(on_hours, F.col("end"))).over(in_row)})
    begins = F.col("next_day").isNotNull() | F.col("next_start").isNotNull() | (F.col("row") == F.col("first"))
    told = {"block": F.max(F.when(begins, F.col("row"))).over(upto), "day": F.last("next_day", ignorenulls=True).over(upto),
            "start_time": F.last("next_start", ignorenulls=True).over(upto), "end_time": F.last("next_end", ignorenulls=True).over(upto)}
    body = body.withColumns(told).where(~F.col("days") & ~F.col("hours") & F.col("day").isNotNull() & F.col("start_time").isNotNull())

    # cells with a filled line, told by their texts: a filter on what is said would work it out twice
    body = body.where(F.col("text").rlike(r"(?U)[^\s\x1c-\x1e]"))
    mine = body.select(*sheet, "block", "col", "row", "day", "start_time", "end_time", "above", F.transform(linecells.cell_lines(F.col("text")), linecells.role).alias("said"))
    mine = mine.withColumn("at", F.when(F.exists("said", lambda r: r["subject"] != ""), F.col("row")))
    w = ordered([*column, "block"], ["row"])
    back, on = F.last("at", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0)), F.first("at", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    items = mine.withColumns({"back": back, "on": on}).withColumn("record", F.explode(F.array_distinct(F.array_compact(F.array("back", "on")))))
    of = [*sheet, "block", "col", "record"]
    said = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row", "said"))), lambda s: s["said"]))
    found = items.groupBy(*of).agg(*[F.first(c).alias(c) for c in ("day", "start_time", "end_time", "above")], said.alias("said"))
    heads = F.flatten(F.transform("above", lambda s: s["said"]))
    joined = lambda xs, seq="; ": F.array_join(F.array_distinct(F.filter(xs, lambda v: v != "")), seq)
    fields = {f: joined(F.col(f"said.{f}"), {"subject": " / ", "link": " "}.get(f, "; ")) for f in FIELDS}
    fields |= {"groups": joined(F.concat(F.transform(heads, lambda h: h["groups"]), F.flatten("said.groups"))), "course": joined(F.transform(heads, lambda h: h["course"]))}
    found = found.select(*of, (F.col("block") + 1).alias("row_index"), "day", "start_time", "end_time", *[xs.alias(f) for f, xs in fields.items()])
    found = found.withColumnRenamed("note", "notes")
    return valid(found, sheet, ["block", "col", "record"]).drop("block", "record")


def _rowwise_subject(lines: Column) -> Column:
    """struct(subject, notes): the first line without a code and one more that may be a subject; codes and the rest are notes."""
    coded = F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"), x.rlike(linecells.rx(linecells.CODE)).alias("code")))
    first = lambda xs: F.coalesce(F.array_min(F.transform(F.filter(xs, lambda s: ~s["code"]), lambda s: s["i"])), F.lit(-1))
    return linecells.let(coded, lambda xs: linecells.let(first(xs), lambda a: linecells.let(
        F.coalesce(F.array_min(F.transform(F.filter(xs, lambda s: ~s["code"] & (s["i"] > a) & linecells.may_be_subject(s["x"])), lambda s: s["i"])), F.lit(-1)),
        lambda b: F.struct(F.array_join(F.array_distinct(F.transform(F.filter(xs, lambda s: (s["i"] == a) | (s["i"] == b)), lambda s: s["x"])), "; ").alias("subject"),
                           F.array_join(F.array_distinct(F.transform(F.filter(xs, lambda s: (s["i"] != a) & (s["i"] != b)), lambda s: s["x"])), "; ").alias("notes")))))


def rowwise_records(cells: DataFrame, sheet: list[str], row: str = "row", col: str = "col", text: str = "text") -> DataFrame:
    """(sheet, row_index, day, start_time, end_time, subject, teacher, notes) of tables with a column for every day: a record for every time in a day's column.

    The header is the first of six rows with three days or more; the last columns that name disciplines and teachers hold these, else the first column does.
    """
    cells = cells.select(*sheet, F.col(row).alias("row"), F.col(col).alias("col"), F.col(text).alias("text")).where(flat(F.col("text")) != "")
    known = kept(_timed(cells, "text"), "rowwise-cells")
    header = known.where("row < 6").groupBy(*sheet, "row").agg(F.count_if(F.col("day") != "").alias("n")).where("n >= 3").groupBy(*sheet).agg(F.min("row").alias("header"))
    placed = kept(known.join(header, sheet), "rowwise-placed")
    heads = placed.where(F.col("row") == F.col("header"))
    named = lambda word: F.coalesce(F.max(F.when(F.contains(F.lower(flat(F.col("text"))), F.lit(word)), F.col("col"))), F.lit(0))
    where = heads.groupBy(*sheet).agg(named("назва дисципліни").alias("subject_col"), named("викладача").alias("teacher_col"))
    days = heads.where("day <> ''").select(*sheet, "col", F.col("day").alias("head"))
    body = placed.where(F.col("row") > F.col("header")).join(where, sheet)
    lines = lambda c: F.max(F.when(F.col("col") == F.col(c), linecells.cell_lines(F.col("text"))))
    about = body.groupBy(*sheet, "row").agg(lines("subject_col").alias("s"), lines("teacher_col").alias("t")).withColumn("p", _rowwise_subject(F.coalesce("s", F.array().cast("array<string>"))))
    timed = body.where("start_time <> ''").select(*sheet, "row", "col", "start_time", "end_time").join(days, [*sheet, "col"])
    found = timed.join(about.where("p.subject <> ''"), [*sheet, "row"])
    teacher = F.array_join(F.array_distinct(F.coalesce("t", F.array().cast("array<string>"))), "; ")
    found = found.select(*sheet, "col", (F.col("row") + 1).alias("row_index"), F.col("head").alias("day"), "start_time", "end_time", F.col("p.subject").alias("subject"), teacher.alias("teacher"),
                         F.col("p.notes").alias("notes"), F.lit("").alias("groups"))
    return valid(found, sheet, ["row_index", "col"]).drop("groups", "col")
