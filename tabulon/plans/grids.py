"""Queries over grids of cells: rectangles, split-cell timetables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.operators import grid, splitgrid
from tabulon.plans.sched import DAYS, ENDS, STARTS, read
from tabulon.sources.cells import CELLS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


@query("""WITH c AS (SELECT l_orderkey AS sheet, (l_linenumber * 5 + l_partkey % 3)::INT AS min_row, (l_linenumber * 5 + l_partkey % 3 + l_suppkey % 3)::INT AS max_row,
    (l_suppkey % 11)::INT AS min_col, (l_suppkey % 11 + l_partkey % 40)::INT AS max_col, l_partkey AS part FROM lineitem),
  p AS (SELECT o_orderkey AS sheet, (o_orderkey % 41)::INT AS row, (o_custkey % 53)::INT AS col FROM orders)
  SELECT p.sheet, p.row, p.col, c.part FROM p JOIN c ON c.sheet = p.sheet AND p.row BETWEEN c.min_row AND c.max_row AND p.col BETWEEN c.min_col AND c.max_col""")
def grid_point_lookup(spark, sf_dir):
    """Points of a sheet with the rectangles that hold them."""
    c = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sheet"), (F.col("l_linenumber") * 5 + F.col("l_partkey") % 3).cast("int").alias("min_row"), (F.col("l_suppkey") % 11).cast("int").alias("min_col"),
        (F.col("l_linenumber") * 5 + F.col("l_partkey") % 3 + F.col("l_suppkey") % 3).cast("int").alias("max_row"), (F.col("l_suppkey") % 11 + F.col("l_partkey") % 40).cast("int").alias("max_col"), F.col("l_partkey").alias("part"))
    p = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sheet"), (F.col("o_orderkey") % 41).cast("int").alias("row"), (F.col("o_custkey") % 53).cast("int").alias("col"))
    return grid.covering(p, c, ["sheet"]).select("sheet", "row", "col", "part")


#: A sheet's headers: (first row, last row, first column, last column, text).
_HEADS = ((2, 2, 1, 1, "день"), (2, 2, 2, 2, "час"), (2, 2, 3, 6, "1 курс ІПЗ"), (2, 2, 8, 9, "2 курс КН"), (2, 2, 7, 7, "час"), (3, 3, 3, 4, "група А-1"), (3, 3, 5, 6, "група Б-2"), (3, 3, 8, 9, "група В-3"),
          (4, 4, 4, 4, "підгрупа 1"), (12, 12, 12, 12, "1"))
#: Subject cells by kind: text before and after the part's number.
_SUBJECTS = (("Матеріали деталі ", " (лек)"), ("Основи обробки ", " (лаб) 12т"), ("Професійна етика роботи ", " [14.11] (C) [21.11] Методика викладання освіти (C)"),
             ("Матем. логіка ", " [24.11] 307 ауд. ас. Гамоцька С.Л."), ("Блокчейн технології ", " (Л) Меркулова К. В."))


def _cells(spark, sf_dir):
    """A sheet for every order, a block for every line: eight rows apart, or four apart where blocks overlap."""
    line = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    row = (F.lit(5) + (F.col("l_linenumber") - 1) * F.when(F.col("l_orderkey") % 3 == 0, 4).otherwise(8)).cast("int")
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
    slot, kind, left = F.col("l_suppkey") % 5, F.col("l_partkey") % 5, (F.lit(3) + F.col("l_partkey") % 4).cast("int")
    cell = lambda r0, r1, c0, c1, text: F.struct(r0.cast("int").alias("min_row"), r1.cast("int").alias("max_row"), c0.cast("int").alias("min_col"), c1.cast("int").alias("max_col"), text.alias("text"))
    subject = F.concat(pick([a for a, _ in _SUBJECTS], kind), F.col("l_partkey").cast("string"), pick([b for _, b in _SUBJECTS], kind))
    right = left + F.col("l_suppkey") % 3
    body = line.select("l_orderkey", F.explode(F.array_compact(F.array(
        cell(row, row, F.lit(2), F.lit(2), F.concat(pick(STARTS, slot), F.lit("-"), pick(ENDS, slot))),
        F.when(F.col("l_linenumber") % 2 == 1, cell(row, row, F.lit(1), F.lit(1), pick(DAYS, F.col("l_orderkey") % 6))),
        cell(row, row + 1, left, right, subject),
        F.when(F.col("l_partkey") % 7 < 5, cell(row + 2, row + 2, right, right + 2, F.concat(F.lit("Вовна О. В. [0"), F.col("l_linenumber").cast("string"), F.lit(".10]")))),
        F.when(F.col("l_suppkey") % 4 < 3, cell(row + 3, row + 3, left, left, F.concat((F.col("l_suppkey") % 90 + 10).cast("string"), F.lit(" ауд.")))),
        F.when(F.col("l_suppkey") % 2 == 0, cell(row + 3, row + 3, left + 1, left + 1, F.concat(F.lit("https://meet.example/"), F.col("l_suppkey").cast("string")))),
        F.when(F.col("l_partkey") % 2 == 0, cell(row + 1, row + 1, F.lit(3), F.lit(9), F.lit("I тиждень")))))).alias("c")).select("l_orderkey", "c.*")
    heads = F.array(*[cell(*map(F.lit, h)) for h in _HEADS])
    top = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(heads).alias("c")).select("l_orderkey", "c.*")
    names = [c.split()[0] for c in CELLS.split(", ")]
    out = body.unionByName(top).withColumns({"locator": F.concat(F.lit("o-"), F.col("l_orderkey").cast("string")), "sheet_ord": F.lit(0), "sheet_name": F.lit("ІПЗ"), "error": F.lit(None).cast("string")})
    return out.select(names)


@query("""WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_partkey) AS p, min(l_suppkey) AS s, (5 + (l_linenumber - 1) * CASE WHEN l_orderkey % 3 = 0 THEN 4 ELSE 8 END)::INT AS r FROM lineitem GROUP BY l_orderkey, l_linenumber),
  b AS (SELECT *, 3 + p % 4 AS c0, 3 + p % 4 + s % 3 AS c1 FROM l),
  cells AS (
    SELECT o, r AS r0, c0, c1, 'subject' AS kind, p AS v, NULL AS t FROM b
    UNION ALL SELECT o, r + 2, c1, c1 + 2, 'teacher', n, '[0' || n || '.10]' FROM b WHERE p % 7 < 5
    UNION ALL SELECT o, r + 3, c0, c0, 'room', s, (s % 90 + 10) || ' ауд.' FROM b WHERE s % 4 < 3
    UNION ALL SELECT o, r + 3, c0 + 1, c0 + 1, 'link', s, 'https://meet.example/' || s FROM b WHERE s % 2 = 0
    UNION ALL SELECT o, r + 1, 3, 9, 'week', 0, 'I тиждень' FROM b WHERE p % 2 = 0),
  cols(c, course, grp, sub) AS (VALUES (3, '1', 'група А-1', ''), (4, '1', 'група А-1', 'підгрупа 1'), (5, '1', 'група Б-2', 'підгрупа 1'), (6, '1', 'група Б-2', 'підгрупа 1'), (8, '2', 'група В-3', ''), (9, '2', 'група В-3', '')),
  k AS (SELECT * FROM cells WHERE c0 <> 7 AND c0 <= 9),
  blocks AS (SELECT o, r, min(n) AS n, min(s % 5) AS slot FROM l GROUP BY o, r),
  mine AS (SELECT b.o, b.r, b.n, b.slot, k.r0, k.c0, k.c1, k.v AS p FROM blocks b JOIN k ON k.o = b.o AND k.kind = 'subject' AND k.r0 BETWEEN b.r AND b.r + 7),
  meta AS (SELECT m.o, m.r, m.r0, m.c0, m.p, array_to_string(list(DISTINCT x.t) FILTER (x.kind = 'room'), '') AS rooms1, string_agg(x.t, '|' ORDER BY x.r0, x.c0) FILTER (x.kind = 'room') AS rooms, string_agg(x.t, '|' ORDER BY x.r0, x.c0) FILTER (x.kind = 'link') AS links,
      count(*) FILTER (x.kind = 'teacher') AS teachers, string_agg(x.t, '|' ORDER BY x.r0, x.c0) FILTER (x.kind IN ('teacher', 'week')) AS notes, count(*) FILTER (x.kind = 'week') AS weeks
    FROM mine m JOIN k x ON x.o = m.o AND x.kind <> 'subject' AND x.r0 BETWEEN m.r AND m.r + 7 AND x.c0 <= m.c1 AND m.c0 <= x.c1 GROUP BY ALL),
  head AS (SELECT m.o, m.r0, m.c0, string_agg(DISTINCT nullif(sub, ''), '|') AS sub, list(grp ORDER BY c) AS grps, list(course ORDER BY c) AS courses
    FROM (SELECT DISTINCT o, r0, c0, c1 FROM mine) m JOIN cols ON c BETWEEN m.c0 AND m.c1 GROUP BY ALL),
  flat AS (SELECT m.*, x.rooms, x.links, coalesce(x.teachers, 0) AS teachers, x.notes, coalesce(x.weeks, 0) AS weeks, h.sub, h.grps, h.courses FROM mine m LEFT JOIN meta x USING (o, r, r0, c0, p) LEFT JOIN head h USING (o, r0, c0)),
  u AS (SELECT *, unnest(CASE WHEN p % 5 = 2 THEN [0, 1] ELSE [0] END) AS nth FROM flat),
  d AS (SELECT u.*, CASE p % 5 WHEN 0 THEN [] WHEN 1 THEN ['T=12'] WHEN 2 THEN [CASE nth WHEN 0 THEN '[14.11]' ELSE '[21.11]' END] WHEN 3 THEN ['[24.11]'] ELSE [] END AS own,
      ['Понеділок', 'Вівторок', 'Середа', 'Четвер', 'П''ятниця', 'Субота'][(CASE WHEN u.n >= f.n THEN o % 6 + 1 END)::INT] AS day FROM u LEFT JOIN (SELECT o, min(n) AS n FROM l WHERE n % 2 = 1 GROUP BY o) f USING (o)),
  e AS (SELECT *, list_concat(own, string_split(coalesce(notes, ''), '|')) AS ns, string_split(coalesce(rooms, ''), '|') AS rs, string_split(coalesce(links, ''), '|') AS ls FROM d)
  SELECT 'o-' || o AS locator, r AS row_index, r0 AS min_row, c0::INT AS min_col, nth::INT AS nth, coalesce(day, '') AS day,
    ['08:00', '09:30', '11:00', '12:30', '14:00'][(slot + 1)::INT] AS start_time, ['09:20', '10:50', '12:20', '13:50', '15:20'][(slot + 1)::INT] AS end_time,
    CASE p % 5 WHEN 0 THEN 'Матеріали деталі ' || p WHEN 1 THEN 'Основи обробки ' || p WHEN 2 THEN CASE nth WHEN 0 THEN 'Професійна етика роботи ' || p ELSE 'Методика викладання освіти' END WHEN 3 THEN 'Матем. логіка ' || p ELSE 'Блокчейн технології ' || p END AS subject,
    CASE p % 5 WHEN 0 THEN 'лекція' WHEN 1 THEN 'лабораторне заняття' WHEN 2 THEN 'семінар' WHEN 3 THEN '' ELSE 'лекція' END AS lesson_type,
    CASE WHEN weeks > 0 THEN 'Верхній' ELSE '' END AS week_type,
    CASE WHEN teachers > 0 THEN 'Вовна О. В.' ELSE '' END || CASE WHEN p % 5 IN (3, 4) THEN CASE WHEN teachers > 0 THEN '; ' ELSE '' END || CASE p % 5 WHEN 3 THEN 'ас. Гамоцька С.Л.' ELSE 'Меркулова К. В.' END ELSE '' END AS teacher,
    array_to_string(list_filter(list_concat([x FOR x, i IN rs IF list_position(rs, x) = i], CASE p % 5 WHEN 3 THEN ['ауд. 307'] ELSE [] END), lambda x: x <> ''), '; ') AS room,
    array_to_string(list_filter([x FOR x, i IN ls IF list_position(ls, x) = i], lambda x: x <> ''), ' ') AS link,
    array_to_string(CASE WHEN sub IS NOT NULL THEN ['підгрупа 1'] ELSE [x FOR x, i IN coalesce(grps, []) IF list_position(grps, x) = i] END, '; ') AS groups,
    array_to_string([x FOR x, i IN coalesce(courses, []) IF list_position(courses, x) = i], '; ') AS course,
    array_to_string(list_filter([x FOR x, i IN ns IF list_position(ns, x) = i], lambda x: x <> ''), '; ') AS notes FROM e""")
def split_grid_records(spark, sf_dir):
    """Records of split-cell sheets, one an order; the SQL joins by row and column numbers and knows what each cell says."""
    return splitgrid.split_grid_records(_cells(spark, sf_dir)).drop("sheet_ord", "sheet_name", "program")
