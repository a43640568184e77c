"""Queries over merges of rows in their order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulon.operators import continuation
from tabulon.plans.sched import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


@query("""WITH RECURSIVE l AS (SELECT l_suppkey AS doc, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS place, (l_orderkey + l_linenumber * 3 + l_partkey) % 9 AS code, l_partkey % 3 AS n, l_orderkey % 4 AS c FROM lineitem),
  t AS (SELECT doc, place, place // 7 AS slot, doc % 2 = 0 AS rep, code, n, CASE c WHEN 0 THEN '' ELSE (c % 2 + 1)::VARCHAR END AS course,
    CASE WHEN code < 2 THEN 'Вища математика ' || n WHEN code < 4 THEN 'та її застосування ' || n WHEN code = 4 THEN 'і методика' WHEN code = 5 THEN 'СОЦІАЛЬНИХ ДОСЛІДЖЕНЬ' WHEN code = 6 THEN 'ВИЩА МАТЕМАТИКА ' || n WHEN code = 7 THEN '(Л - 2 год.)' ELSE 'Одне' END AS subject,
    CASE WHEN code IN (2, 3) THEN 'Вовна О. В.' ELSE '' END AS teacher, CASE WHEN code = 5 THEN 'ауд. ' || n ELSE '' END AS room, CASE WHEN code = 7 THEN 'https://meet.example/' || n ELSE '' END AS link FROM l),
  r AS (SELECT doc, slot, list({'place': place, 'begins': CASE WHEN rep THEN code IN (0, 1, 5, 6, 7) ELSE code IN (0, 1, 6) END, 'rep': rep, 'key': replace(replace(replace(replace(replace(lower(subject), ' ', ''), '(', ''), ')', ''), '-', ''), '.', ''),
      'goes': code IN (2, 3) OR (rep AND code IN (5, 7)), 'course': course, 'adds': rep AND code = 7} ORDER BY place) AS rs FROM t GROUP BY doc, slot),
  s AS (
    SELECT doc, slot, rs, 1 AS i, rs[1].key AS key, 0 AS turn, []::BIGINT[] AS gone, []::STRUCT(place BIGINT, host BIGINT, turn INT, again BOOLEAN)[] AS out FROM r
    UNION ALL
    SELECT doc, slot, rs, CASE WHEN f IS NULL THEN i + 1 ELSE i END, CASE WHEN f IS NULL THEN rs[i + 1].key WHEN rs[f].adds THEN key ELSE key || rs[f].key END, CASE WHEN f IS NULL THEN 0 ELSE turn + 1 END,
      CASE WHEN f IS NULL THEN gone ELSE list_concat(gone, list_concat([f], again)) END,
      CASE WHEN f IS NULL THEN out ELSE list_concat(out, list_concat([{'place': rs[f].place, 'host': rs[i].place, 'turn': turn + 1, 'again': false}], [{'place': rs[j].place, 'host': rs[i].place, 'turn': turn + 1, 'again': true} FOR j IN again])) END
    FROM (SELECT *, CASE WHEN f IS NULL THEN [] ELSE list_filter(range(i + 1, f), lambda j: NOT list_contains(gone, j) AND rs[i].rep AND rs[j].key = key AND (rs[i].course = '' OR rs[j].course = '' OR rs[i].course = rs[j].course)) END AS again
      FROM (SELECT *, CASE WHEN rs[i].begins AND NOT list_contains(gone, i::BIGINT) THEN list_filter(range(i + 1, least(i + 4, len(rs)) + 1), lambda j: NOT list_contains(gone, j) AND rs[j].goes AND rs[j].key <> key
          AND (rs[i].course = '' OR rs[j].course = '' OR rs[i].course = rs[j].course))[1] END AS f FROM s WHERE i <= len(rs)))),
  o AS (SELECT doc, unnest(out, recursive := true) FROM s WHERE i > len(rs)),
  p AS (SELECT o.doc, o.host, string_agg(CASE WHEN t.rep AND t.code = 7 THEN '' ELSE ' ' || t.subject END, '' ORDER BY o.turn) AS more, count(*) AS merged, max(t.teacher) AS teacher, string_agg(DISTINCT nullif(t.link, ''), '') AS links, count(*) FILTER (t.code = 7) AS hours,
      list(nullif(t.room, '') ORDER BY o.turn) AS rooms, list(nullif(t.link, '') ORDER BY o.turn) AS ls FROM o JOIN t ON t.doc = o.doc AND t.place = o.place WHERE NOT again GROUP BY ALL)
  SELECT t.doc, t.place, t.subject || coalesce(p.more, '') AS subject, CASE WHEN p.merged > 0 AND t.teacher = '' THEN p.teacher ELSE t.teacher END AS teacher, CASE WHEN p.hours > 0 THEN 'лекція' ELSE '' END AS lesson_type,
    CASE WHEN p.hours > 0 THEN 'Л - 2 год.' ELSE '' END AS notes, (SELECT count(DISTINCT x) FROM unnest(list_concat([nullif(t.room, '')], coalesce(p.rooms, []))) q(x)) AS rooms,
    (SELECT count(DISTINCT x) FROM unnest(list_concat([nullif(t.link, '')], coalesce(p.ls, []))) q(x)) AS links, coalesce(p.merged, 0) AS merged
  FROM t LEFT JOIN p ON p.doc = t.doc AND p.host = t.place WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.doc = t.doc AND o.place = t.place)""")
def continuation_search(spark, sf_dir):
    """Rows of a supplier in slots of seven, whose subjects go on, in small letters, capitals or hours, up to four rows further down."""
    n, c, code = F.col("l_partkey") % 3, F.col("l_orderkey") % 4, (F.col("l_orderkey") + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 9
    place = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")).cast("long")
    with_n = lambda a: F.concat(F.lit(a), n.cast("string"))
    rows = read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("doc"), place.alias("place"), F.when(F.col("l_suppkey") % 2 == 0, continuation.REPEATING_SOURCE).otherwise("other").alias("source_name"),
        F.when(code < 2, with_n("Вища математика ")).when(code < 4, with_n("та її застосування ")).when(code == 4, "і методика").when(code == 5, "СОЦІАЛЬНИХ ДОСЛІДЖЕНЬ").when(code == 6, with_n("ВИЩА МАТЕМАТИКА "))
        .when(code == 7, "(Л - 2 год.)").otherwise("Одне").alias("subject"), F.when(code.isin(2, 3), "Вовна О. В.").otherwise("").alias("teacher"), F.when(code == 5, with_n("ауд. ")).otherwise("").alias("room"),
        F.when(code == 7, with_n("https://meet.example/")).otherwise("").alias("link"), F.when(c == 0, "").otherwise((c % 2 + 1).cast("string")).alias("course"),
        *[F.lit("").alias(x) for x in ("lesson_type", "notes", "groups")])
    out = continuation.with_continuations(rows.withColumn("slot", F.floor(F.col("place") / 7)), ["doc"], "place", ["source_name", "slot"])
    count = lambda x, sep: F.when(F.col(x) == "", 0).otherwise(F.size(F.split(x, sep))).cast("long")
    return out.select("doc", "place", "subject", "teacher", "lesson_type", "notes", count("room", "; ").alias("rooms"), count("link", " ").alias("links"), "merged")
