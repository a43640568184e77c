"""Split-cell grids: eight-row blocks on a grid of merged cells under a three-level header.

Row 2 names courses (and the columns of day and time), rows 3 and 4 groups and subgroups; every level is carried to the right.  A time in
column 2 begins a block of eight rows.  A block's cells are subjects and, in columns that a subject shares, its teachers, rooms, links
and weeks.  All that a text says is worked out once a distinct text.  Cells meet their texts and are then dealt by sheet once: blocks are told by
windows over a sheet's rows, and only a block's cells or a sheet's header cells meet in one object.  Texts and sheets are far smaller as files than
as rows, so joins with them are sort-merge joins: by the file's size they would be broadcast from the driver's memory.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import splitcells, text, times
from tabulon.functions.text import flat, let, rx
from tabulon.operators.rows import ordered
from tabulon.sources.scratch import kept

SHEET = ["locator", "sheet_ord", "sheet_name"]
BLOCK_ROWS = 8
FIRST_BODY_ROW, FIRST_BODY_COLUMN = 5, 3
DAY_COLUMN, TIME_COLUMN = 1, 2
HEADER_COLUMNS = 16
COURSE = r"\b(\d+)\s*курс\b"
_PLACE = ["min_row", "max_row", "min_col", "max_col"]


def _is_word(x: Column, word: str) -> Column:
    """Whether a header says the word alone; its key is made only where all letters of the word stand in it."""
    held = lambda low: reduce(and_, (F.contains(low, F.lit(c)) for c in dict.fromkeys(word)))
    return held(F.lower(x)) & (text.header_key(x) == word)


def split_sheets(cells: DataFrame) -> DataFrame:
    """(sheet, rows, columns) of the sheets of this layout: day and time among the first headers of row 2, ten rows and four columns at least."""
    head = (F.col("min_row") == 2) & (F.col("min_col") <= HEADER_COLUMNS)
    named = lambda word: F.max(F.when(head, _is_word(F.col("text"), word)))  # noqa: E731  # header cells only
    found = cells.groupBy(*SHEET).agg(F.max("max_row").alias("rows"), F.max("max_col").alias("columns"), named("день").alias("d"), named("час").alias("t"))
    return found.where((F.col("rows") >= 10) & (F.col("columns") >= 4) & F.col("d") & F.col("t")).drop("d", "t")


def _levels(heads: Column) -> Column:
    """(col, course, number, group, subgroup) of every column under the header cells, each level carried to the right; a day or time header clears all three."""
    first = lambda h: F.greatest(h["c0"], F.lit(FIRST_BODY_COLUMN))
    under = F.flatten(F.transform(heads, lambda h: F.when(first(h) <= h["c1"], F.sequence(first(h), h["c1"])).otherwise(F.array().cast("array<int>"))))
    at = lambda xs, c: F.array_max(F.transform(F.filter(xs, lambda h: (h["c0"] <= c) & (c <= h["c1"])), lambda h: h["said"]))
    level = lambda row: F.filter(heads, lambda h: (h["r0"] <= row) & (h["r1"] >= row)).alias(f"l{row}")
    rows = F.struct(level(2), level(3), level(4))
    wide = let(rows, lambda r: F.transform(F.array_sort(F.array_distinct(under)), lambda c: let(at(r["l2"], c), lambda head: F.struct(
        c.alias("col"), F.coalesce(head["axis"], F.lit(False)).alias("axis"), F.when(~head["axis"], head["text"]).alias("course"), F.when(~head["axis"], head["number"]).alias("number"),
        at(r["l3"], c)["text"].alias("group"), at(r["l4"], c)["text"].alias("subgroup")))))
    names = ("course", "number", "group", "subgroup")
    none = F.array(F.struct(F.lit(0).alias("col"), F.lit(True).alias("axis"), *[F.lit("").alias(c) for c in names]))

    def carried(done: Column, x: Column) -> Column:
        keep = lambda last, c, of: F.when(F.coalesce(x[of], F.lit("")) != "", x[c]).when(x["axis"], "").otherwise(last[c]).alias(c)
        return F.concat(done, let(F.element_at(done, -1), lambda last: F.array(F.struct(x["col"].alias("col"), x["axis"].alias("axis"), *[keep(last, c, "course" if c == "number" else c) for c in names]))))

    return F.aggregate(wide, none, carried, lambda done: F.slice(done, 2, F.greatest(F.size(done) - 1, F.lit(0))))


def sheet_headers(cells: DataFrame) -> DataFrame:
    """(sheet, program, levels, courses) of the sheets of this layout; ``courses`` are the columns under a course."""
    heads = cells.where((F.col("min_row") <= 4) & (F.col("max_row") >= 2) & (F.col("max_col") >= FIRST_BODY_COLUMN))
    in_two = F.col("min_row") <= 2
    said = F.struct(flat(F.col("text")).alias("text"), F.coalesce(in_two & (_is_word(F.col("text"), "день") | _is_word(F.col("text"), "час")), F.lit(False)).alias("axis"),
                    F.when(in_two, F.regexp_extract(F.lower(flat(F.col("text"))), rx(COURSE), 1)).alias("number"))
    found = heads.groupBy(*SHEET).agg(F.collect_list(F.struct(F.col("min_row").alias("r0"), F.col("max_row").alias("r1"), F.col("min_col").alias("c0"), F.col("max_col").alias("c1"), said.alias("said"))).alias("heads"))
    found = found.join(split_sheets(cells).select(*SHEET).hint("merge"), SHEET)
    found = found.select(*SHEET, flat(F.col("sheet_name")).alias("program"), _levels(F.col("heads")).alias("levels"))
    return found.withColumn("courses", F.transform(F.filter("levels", lambda v: v["course"] != ""), lambda v: v["col"]))


def cell_texts(body: DataFrame) -> DataFrame:
    """(text, flat, kind, week, teacher, notes, entries) of distinct texts that are not ignored: what each says as a subject or beside one."""
    # filtered as read: before, the filter would go below the distinct and judge every cell
    each = body.select("text").distinct().withColumn("flat", flat(F.col("text")))
    kinds = kept(each.withColumn("kind", splitcells.kind(F.col("flat"))), "split-kinds").where("kind <> 'ignore'")
    week = lambda x: splitcells.week_type(F.array(x))
    noted = F.when(F.col("kind") == "teacher", splitcells.bracketed(F.col("flat"))["notes"]).when(F.col("kind") == "week", F.array("flat")).otherwise(F.array().cast("array<string>"))
    kinds = kinds.select("text", "flat", "kind", week(F.col("flat")).alias("week"), F.when(F.col("kind") == "teacher", flat(splitcells.bracketed(F.col("flat"))["text"])).alias("teacher"),
                         F.transform(noted, lambda x: F.struct(flat(x).alias("note"), week(x).alias("week"))).alias("notes"))
    entries = subject_entries(kinds.where("kind = 'subject'").select(F.col("flat").alias("text")).distinct())
    entry = F.struct("nth", "subject", "lesson_type", flat(F.col("entry_notes")).alias("entry_notes"), week(F.col("entry_notes")).alias("week"), "inline_notes", "inline_teacher", flat(F.col("inline_room")).alias("inline_room"))
    entries = entries.groupBy(F.col("text").alias("flat")).agg(F.collect_list(entry).alias("entries"))
    return kinds.join(entries.hint("merge"), "flat", "left")


def block_cells(cells: DataFrame) -> DataFrame:
    """(sheet, slot, day, start_time, end_time, cells): blocks with the cells that begin in their eight rows; blocks that overlap share cells.

    A row whose time column holds a whole time range begins a block; days are carried down over all rows with a time.
    """
    body = cells.where((F.col("min_row") >= FIRST_BODY_ROW) & (F.col("min_col") >= FIRST_BODY_COLUMN)).select(*SHEET, F.col("min_row").alias("row"), "min_col", "max_col", "text")
    texts = kept(cell_texts(body), "split-texts")
    body = body.join(texts.hint("merge"), "text").drop("text")
    # a time or day cell stands in every row that it covers
    down = F.when(F.greatest("min_row", F.lit(FIRST_BODY_ROW)) <= F.col("max_row"), F.sequence(F.greatest("min_row", F.lit(FIRST_BODY_ROW)), F.col("max_row")))
    covers = lambda c: F.when(F.col("min_col").between(1, c) & (F.col("max_col") >= c), F.col("text"))
    marks = cells.where(F.col("min_col") <= TIME_COLUMN).select(*SHEET, F.explode(down).alias("row"), covers(DAY_COLUMN).alias("day"), covers(TIME_COLUMN).alias("time"))
    placed = body.unionByName(marks, allowMissingColumns=True).repartition(*SHEET)  # once: all that follows stays within a sheet

    here, upto = Window.partitionBy(*SHEET, "row"), ordered(SHEET, ["row"])
    # a subject reaches as far as the widest of its place
    placed = placed.withColumn("reach", F.max(F.when(F.col("kind") == "subject", F.col("max_col"))).over(Window.partitionBy(*SHEET, "row", "min_col")))
    placed = placed.withColumns({"said_day": F.max("day").over(here), "said_time": F.max("time").over(here)})
    told = F.struct(times.weekday(F.col("said_day")).alias("day"), times.parse_range(flat(F.col("said_time"))).alias("r"))
    placed = placed.withColumn("told", F.when(F.col("time").isNotNull(), told)).drop("day", "time", "said_day", "said_time")
    timed = F.col("told.r.start") != ""
    placed = placed.withColumn("day", F.last(F.when(timed & (F.col("told.day") != ""), F.col("told.day")), ignorenulls=True).over(upto.rangeBetween(Window.unboundedPreceding, 0)))
    begun = F.when(timed & (F.col("told.r.end") != ""), F.struct(F.col("row").alias("slot"), F.coalesce("day", F.lit("")).alias("day"), F.col("told.r.start").alias("start_time"), F.col("told.r.end").alias("end_time")))
    placed = placed.withColumn("begun", begun).withColumn("blocks", F.collect_set("begun").over(upto.rangeBetween(-(BLOCK_ROWS - 1), 0)))
    cell = F.struct("row", "min_col", "max_col", "reach", "kind", "flat", "week", "teacher", "notes", "entries")
    met = placed.where("kind IS NOT NULL").select(*SHEET, F.explode("blocks").alias("b"), cell.alias("cell"))
    return met.groupBy(*SHEET, F.col("b.slot").alias("slot")).agg(*[F.first(f"b.{c}").alias(c) for c in ("day", "start_time", "end_time")], F.collect_list("cell").alias("cells"))


def subject_entries(texts: DataFrame) -> DataFrame:
    """(text, nth, subject, lesson_type, entry_notes, inline_notes, inline_teacher, inline_room): the entries of distinct subject cells."""
    raw = texts.select("text", F.posexplode(splitcells.dated_entries(F.col("text"))).alias("nth", "entry"))
    parts = kept(raw.withColumn("m", splitcells.marked(F.col("entry"))).where("m.subject <> ''").select("text", "nth", "m.*"), "split-marked")
    notes = F.array_join("notes", "; ")
    named = text.service_tokens(F.col("subject"))
    inner = parts.where(named != "").select("text", "nth", "lesson_type", text.service_tokens(notes).alias("entry_notes"), splitcells.inline(named).alias("i"))
    return inner.where("i.subject <> ''").select("text", "nth", "lesson_type", "entry_notes", F.col("i.subject").alias("subject"), F.col("i.notes").alias("inline_notes"),
                                                 F.col("i.teacher").alias("inline_teacher"), F.col("i.room").alias("inline_room"))


def _beside(near: Column, kind: str, value) -> Column:
    """The distinct texts of a kind of cells in block order; a cell gives one or more."""
    some = F.transform(F.filter(near, lambda c: c["kind"] == kind), lambda c: F.struct(c["row"], c["min_col"], F.array(value(c)).alias("x")))
    return F.array_distinct(F.filter(F.flatten(F.transform(F.array_sort(some), lambda s: s["x"])), lambda x: x != ""))


def _context(levels: Column, subject: Column) -> Column:
    """struct(groups, course) of a subject from the header columns it spans: subgroups, or groups where there are none."""
    seen = lambda xs, c: F.array_distinct(F.filter(F.transform(xs, lambda v: v[c]), lambda x: x != ""))
    spanned = F.filter(levels, lambda v: (v["col"] >= subject["min_col"]) & (v["col"] <= subject["reach"]))
    return let(spanned, lambda xs: F.struct(
        F.array_join(let(seen(xs, "subgroup"), lambda s: F.when(F.size(s) > 0, s).otherwise(seen(xs, "group"))), "; ").alias("groups"), F.array_join(seen(xs, "number"), "; ").alias("course")))


def split_grid_records(cells: DataFrame) -> DataFrame:
    """Records (sheet, row_index, min_row, min_col, nth, day, start_time, ..., notes) of every sheet of this layout.

    ``row_index`` is the block's first row; (min_row, min_col, nth) orders records inside it.  Sheets without blocks give none; error rows are
    passed over.  A time cell merged over rows begins a block in each of them, as every row of it holds the time.
    """
    known = kept(cells.where("error IS NULL").select(*SHEET, *_PLACE, "text"), "split-cells")
    sheets = kept(sheet_headers(known), "split-sheets")
    blocks = block_cells(known).join(sheets.hint("merge"), SHEET)
    blocks = blocks.withColumn("cells", F.filter("cells", lambda c: F.array_contains(F.col("courses"), c["min_col"])))
    others = F.filter("cells", lambda c: c["kind"] != "subject")
    subjects = blocks.withColumn("others", others).withColumn("s", F.explode(F.filter("cells", lambda c: (c["kind"] == "subject") & c["entries"].isNotNull()))).drop("cells", "courses")
    s = F.col("s")
    near = F.filter("others", lambda c: (c["min_col"] <= s["reach"]) & (s["min_col"] <= c["max_col"]))
    found = subjects.withColumn("near", near).withColumn("context", _context(F.col("levels"), s)).drop("levels", "others")
    noted = F.transform(F.filter("near", lambda c: c["kind"].isin("teacher", "week")), lambda c: F.struct(c["row"], c["min_col"], c["notes"].alias("x")))
    noted = F.flatten(F.transform(F.array_sort(noted), lambda c: c["x"]))
    found = found.withColumns({"teacher": F.array_join(_beside(F.col("near"), "teacher", lambda c: c["teacher"]), "; "), "room": F.array_join(_beside(F.col("near"), "room", lambda c: c["flat"]), "; "),
                               "link": F.array_join(_beside(F.col("near"), "link", lambda c: c["flat"]), " "), "noted": noted}).drop("near").withColumn("e", F.explode("s.entries"))
    filled = lambda *xs: F.array_distinct(F.filter(F.concat(*xs), lambda x: x != ""))
    weeks = F.filter(F.concat(F.array("s.week", "e.week"), F.transform("noted", lambda x: x["week"])), lambda x: x != "")
    return found.select(
        *SHEET, F.col("slot").alias("row_index"), F.col("s.row").alias("min_row"), F.col("s.min_col").alias("min_col"), F.col("e.nth").alias("nth"), "program", "day", "start_time", "end_time",
        F.col("e.subject").alias("subject"), F.col("e.lesson_type").alias("lesson_type"), F.coalesce(F.get(weeks, F.lit(0)), F.lit("")).alias("week_type"),
        splitcells.with_teacher(F.col("teacher"), F.col("e.inline_teacher")).alias("teacher"), F.array_join(filled(F.array("room", "e.inline_room")), "; ").alias("room"), "link",
        F.col("context.groups").alias("groups"), F.col("context.course").alias("course"), F.array_join(filled(F.array("e.entry_notes"), F.col("e.inline_notes"), F.transform("noted", lambda x: x["note"])), "; ").alias("notes"))
