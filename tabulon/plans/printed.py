"""Queries over printed timetables: lines of documents and tables of cells."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulon.operators import linerecords
from tabulon.plans.sched import DAYS, ENDS, STARTS, read

#: Shuffle partitions of printed tables are so many times the session's: a line of few bytes becomes several cells with texts, which are sorted within tasks.
TASKS = 4

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


def _pick(values, i):
    return F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))


def _range(i):
    return F.concat(_pick(STARTS, i), F.lit(" – "), _pick(ENDS, i))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents),
  c AS (SELECT doc_id, k, length(line) AS size, (doc_id * 7 + k * 5 + length(line)) % 13 AS code FROM l),
  f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS n, code IN (1, 2) AS timed FROM c WHERE code <> 11),
  s AS (SELECT *, sum(timed::INT) OVER (PARTITION BY doc_id ORDER BY n) AS seg, last_value(CASE WHEN code = 0 THEN size % 6 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n) AS said FROM f),
  b AS (SELECT *, min(CASE WHEN code NOT IN (0, 1) THEN n END) OVER (PARTITION BY doc_id, seg) AS begun, max(n) OVER (PARTITION BY doc_id, seg) AS ended FROM s WHERE seg > 0),
  e AS (SELECT *, coalesce(min(CASE WHEN code = 0 AND n > begun THEN n END) OVER (PARTITION BY doc_id, seg), ended + 1) AS stop FROM b),
  t AS (SELECT doc_id, seg, n, code, CASE WHEN code = 2 THEN 'Предмет ' || size WHEN code BETWEEN 3 AND 6 THEN 'Предмет роботи ' || size WHEN code = 12 THEN 'Вступ до теми ' || size WHEN code = 7 THEN 'доц. Шашкова Л.О.'
      WHEN code = 8 THEN 'ауд.' || (size % 900 + 100) WHEN code = 9 THEN 'https://meet.example/' || size WHEN code = 10 THEN (size % 4 + 1) || ' група' END AS x FROM e WHERE n < stop AND code NOT IN (0, 1)),
  u AS (SELECT doc_id, seg, CASE code WHEN 7 THEN 't' WHEN 8 THEN 'r' WHEN 9 THEN 'l' WHEN 10 THEN 'g' ELSE 's' END AS kind, x, min(n) AS n FROM t GROUP BY ALL),
  v AS (SELECT doc_id, seg, string_agg(x, ' / ' ORDER BY n) FILTER (kind = 's') AS subject, string_agg(x, '; ' ORDER BY n) FILTER (kind = 't') AS teacher, string_agg(x, '; ' ORDER BY n) FILTER (kind = 'r') AS room,
      string_agg(x, ' ' ORDER BY n) FILTER (kind = 'l') AS link, string_agg(x, '; ' ORDER BY n) FILTER (kind = 'g') AS groups FROM u GROUP BY doc_id, seg),
  h AS (SELECT doc_id, seg, max(stop) AS stop, max(CASE WHEN timed THEN size % 5 END) AS slot, max(CASE WHEN n = begun THEN said END) AS day FROM e WHERE begun IS NOT NULL GROUP BY doc_id, seg),
  w AS (SELECT doc_id, stop AS row_index, ['Понеділок', 'Вівторок', 'Середа', 'Четвер', 'П''ятниця', 'Субота'][(day + 1)::INT] AS day, ['08:00', '09:30', '11:00', '12:30', '14:00'][(slot + 1)::INT] AS start_time,
      ['09:20', '10:50', '12:20', '13:50', '15:20'][(slot + 1)::INT] AS end_time, subject, coalesce(teacher, '') AS teacher, coalesce(room, '') AS room, coalesce(link, '') AS link, coalesce(groups, '') AS groups, seg FROM h JOIN v USING (doc_id, seg) WHERE day IS NOT NULL AND subject IS NOT NULL)
  SELECT doc_id, row_index::INT AS row_index, day, start_time, end_time, subject, teacher, room, link, groups FROM w QUALIFY row_number() OVER (PARTITION BY doc_id, day, start_time, end_time, subject, groups, teacher ORDER BY seg) = 1""")
def printed_line_records(spark, sf_dir):
    """Records from lines that days, times and roles are laid over, by line length and number, in every document."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("k", "line"))
    size, s = F.length("line"), F.length("line").cast("string")
    code = ((F.col("doc_id") * 7 + F.col("k") * 5 + size) % 13).cast("int")
    say = (F.when(code == 0, _pick(DAYS, size % 6)).when(code == 1, _range(size % 5)).when(code == 2, F.concat(_range(size % 5), F.lit(" Предмет "), s)).when(code == 7, "доц. Шашкова Л.О.")
           .when(code == 8, F.concat(F.lit("ауд."), (size % 900 + 100).cast("string"))).when(code == 9, F.concat(F.lit("https://meet.example/"), s))
           .when(code == 10, F.concat((size % 4 + 1).cast("string"), F.lit(" група"))).when(code == 11, " ").when(code == 12, F.concat(F.lit("Вступ до теми "), s)).otherwise(F.concat(F.lit("Предмет роботи "), s)))
    out = linerecords.line_records(d.select("doc_id", "k", say.alias("line")), ["doc_id"], "k", "line")
    return out.select("doc_id", "row_index", "day", "start_time", "end_time", "subject", "teacher", "room", "link", "groups")


@query("""WITH l AS (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey, l_linenumber),
  b AS (SELECT *, sum((r % 3 = 1 OR r % 2 = 1)::INT) OVER (PARTITION BY o ORDER BY r) AS block, last_value(CASE WHEN r % 2 = 1 THEN s % 5 END IGNORE NULLS) OVER (PARTITION BY o ORDER BY r) AS slot FROM l),
  h AS (SELECT o, block, min(r) AS first, min_by(slot, r) AS slot FROM b GROUP BY o, block),
  e AS (SELECT o, block, r, 2 AS col, CASE p % 4 WHEN 0 THEN 's' WHEN 1 THEN 'r' WHEN 2 THEN 't' END AS kind, CASE p % 4 WHEN 0 THEN 'Предмет роботи ' || p WHEN 1 THEN 'ауд.' || (p % 900 + 100) WHEN 2 THEN 'доц. Шашкова Л.О.' END AS x FROM b
    UNION ALL SELECT o, block, r, 3, CASE s % 3 WHEN 0 THEN 's' WHEN 1 THEN 'r' END, CASE s % 3 WHEN 0 THEN 'Вступ до теми ' || s WHEN 1 THEN 'ауд.' || (s % 900 + 100) END FROM b),
  a AS (SELECT *, lag(r, 1, 0) OVER w AS before, lead(r, 1, 1000) OVER w AS behind FROM e WHERE kind = 's' WINDOW w AS (PARTITION BY o, block, col ORDER BY r)),
  m AS (SELECT a.o, a.block, a.col, a.r, a.x AS subject, x.kind, x.x, min(x.r) AS pos FROM a LEFT JOIN e x ON x.o = a.o AND x.block = a.block AND x.col = a.col AND x.kind <> 's' AND x.r > a.before AND x.r < a.behind GROUP BY ALL),
  g AS (SELECT o, block, col, r, subject, coalesce(string_agg(x, '; ' ORDER BY pos) FILTER (kind = 't'), '') AS teacher, coalesce(string_agg(x, '; ' ORDER BY pos) FILTER (kind = 'r'), '') AS room FROM m GROUP BY o, block, col, r, subject)
  SELECT o AS sheet, (first + 1)::INT AS row_index, col, ['Понеділок', 'Вівторок', 'Середа', 'Четвер', 'П''ятниця', 'Субота'][(o % 6 + 1)::INT] AS day, ['08:00', '09:30', '11:00', '12:30', '14:00'][(slot + 1)::INT] AS start_time,
    ['09:20', '10:50', '12:20', '13:50', '15:20'][(slot + 1)::INT] AS end_time, subject, teacher, room, (col - 1) || ' група' AS groups FROM g JOIN h USING (o, block)
  QUALIFY row_number() OVER (PARTITION BY o, slot, subject, col, teacher ORDER BY block, r) = 1""")
def printed_table_records(spark, sf_dir):
    """Records of printed tables, one an order: days and times on two axes, subjects, rooms and teachers in two group columns."""
    line = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sheet"), "l_linenumber", "l_partkey", "l_suppkey")
    line = line.repartition(TASKS * int(spark.conf.get("spark.sql.shuffle.partitions")), "sheet")  # the one shuffle: all that follows stays within a sheet
    line = line.groupBy("sheet", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    line = line.withColumn("row", F.row_number().over(Window.partitionBy("sheet").orderBy("l_linenumber")))
    cell = lambda col, text, row=F.col("row"): F.struct(row.alias("row"), F.lit(col).alias("col"), text.alias("text"))
    p, s = F.col("p"), F.col("s")
    room = lambda x: F.concat(F.lit("ауд."), (x % 900 + 100).cast("string"))
    left = F.when(p % 4 == 0, F.concat(F.lit("Предмет роботи "), p.cast("string"))).when(p % 4 == 1, room(p)).when(p % 4 == 2, "доц. Шашкова Л.О.")
    right = F.when(s % 3 == 0, F.concat(F.lit("Вступ до теми "), s.cast("string"))).when(s % 3 == 1, room(s))
    body = F.array(cell(0, F.when(F.col("row") % 3 == 1, _pick(DAYS, F.col("sheet") % 6))), cell(1, F.when(F.col("row") % 2 == 1, _range(s % 5))), cell(2, left), cell(3, right))
    heads = F.array(*[cell(k, F.lit(x), F.lit(0)) for k, x in enumerate(("день", "час", "1 група", "2 група"))])
    cells = line.select("sheet", F.explode(F.when(F.col("row") == 1, F.concat(heads, body)).otherwise(body)).alias("c")).where("c.text IS NOT NULL")
    out = linerecords.table_records(cells.select("sheet", "c.*"), ["sheet"])
    return out.select("sheet", "row_index", "col", "day", "start_time", "end_time", "subject", "teacher", "room", "groups")
