"""Look-ahead merges: a subject that goes on in one of the next four rows of its slot.

A row that may begin a subject takes, again and again, the first row among the next four that continues it; rows in between that repeat it go with
the first such take.  What an earlier row took, a later one does not see.  Two rows can only meet if they lie within four places, in one run of a slot,
and their contexts fit; runs are therefore cut wherever no such pair spans the gap.  What is left are clusters of a few rows, and only
clusters of two or more are read in order, as a stream that holds five rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import fields
from tabulon.functions.text import compact, rx, service_tokens
from tabulon.operators.rows import ordered
from tabulon.sources.scratch import kept

AHEAD = 4
REPEATING_SOURCE = "sociology-schedule"
# Words that begin the second line of a subject printed in capitals, and hours that stand for one.
TAIL_WORDS = ("В", "І", "Й", "ТА", "СОЦІОЛОГІЇ", "ДОСЛІДЖЕННЯ", "КОМУНІКАЦІЙ", "КУЛЬТУРИ", "КУЛЬТУРНИХ", "МАРКЕТИНГУ", "ПУБЛІЧНОГО", "УПРАВЛІНСЬКИХ", "СОЦІАЛЬНИХ", "ПРАЦІ", "ДАНИХ", "СОЦІОЛОГІЧНИХ")
HOURS = r"^\(?\s*(?:(?:[ЛПРСC]{1,2}\s*-\s*)?\d+\s*год\.?(?:\s*[,/]\s*(?:[ЛПРСC]{1,2}\s*-\s*)?\d+\s*год\.?)*)\s*\)?$"
HOUR_MARKS = ((r"\bл\b", "лекція"), (r"\bпр\b", "практичне заняття"), (r"\b[сc]\b", "семінар"))


def subject_key(subject: Column) -> Column:
    return compact(service_tokens(subject))


def is_lower(x: Column) -> Column:
    first = F.substring(x, 1, 1)
    return (first == F.lower(first)) & (first != F.upper(first))


def continues_in_capitals(subject: Column) -> Column:
    """A second line of a subject in capitals, its translation in brackets, or its hours."""
    t = service_tokens(subject)
    tail = ~t.rlike(r"\p{Ll}") & t.rlike(f"^(?U)(?:{'|'.join(TAIL_WORDS)})\\b")
    return (t != "") & (tail | (t.startswith("(") & t.endswith(")") & t.rlike(r"\p{Ll}")) | t.rlike(rx(HOURS)))


def _taken(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(place, host, turn, repeats) of the rows that a row takes, from the ordered rows of one cluster, of which five are held.

    A row: place, begins, repeating, key, has_payload, goes_on, course, groups, and what its key adds to a row that takes it.
    """
    window: deque[dict] = deque()

    def fits(a: str, b: str) -> bool:
        return not a or not b or a in b or b in a

    def settle() -> Iterator[tuple]:
        host = window.popleft()
        if host["gone"] or not host["begins"]:
            return
        key, turn = host["key"], 0
        while True:
            repeats, found = [], None
            for c in list(window)[:AHEAD]:
                if c["gone"]:
                    continue
                near = fits(host["course"], c["course"]) and fits(host["groups"], c["groups"])
                if near and host["repeating"] and c["key"] == key:
                    repeats.append(c)
                elif near and c["has_payload"] and c["goes_on"] and c["key"] != key:
                    found = c
                    break
            if found is None:
                return
            turn += 1
            for c, again in [(found, False), *((r, True) for r in repeats)]:
                c["gone"] = True
                yield c["place"], host["place"], turn, again
            key += found["adds"]

    names = ("place", "begins", "repeating", "key", "has_payload", "goes_on", "course", "groups", "adds")
    for row in rows:
        window.append(dict(zip(names, row), gone=False))
        if len(window) > AHEAD:
            yield from settle()
    while window:
        yield from settle()


def claims(df: DataFrame, doc: list[str], place: str, slot: list[str]) -> DataFrame:
    """(doc, place, host, turn, repeats): every row that another one takes, from rows with subject, teacher, lesson_type, link, room, course, groups and source_name."""
    filled = lambda *names: F.greatest(*[F.trim(F.col(n)) != "" for n in names])
    repeating, subject = F.col("source_name") == REPEATING_SOURCE, F.trim("subject")
    payload = filled("teacher", "lesson_type", "link", "room")
    # texts are judged once a distinct (subject, course, groups), not once a row
    texts = ["subject", "course", "groups"]
    judged = df.select(*texts).distinct().select(
        *texts, subject_key(F.col("subject")).alias("key"), ((subject != "") & ~is_lower(subject) & (F.size(F.split(subject, r"(?U)\s+")) >= 2)).alias("may_begin"),
        ((subject != "") & is_lower(subject)).alias("lower"), continues_in_capitals(F.col("subject")).alias("capitals"), service_tokens(F.col("subject")).rlike(rx(HOURS)).alias("hours"),
        *[fields.slot_key(F.col(c)).alias(f"__{c}") for c in ("course", "groups")])
    known = df.join(judged, texts)
    facts = known.select(*doc, F.col(place).alias("place"), F.struct(*slot).alias("slot"), repeating.alias("repeating"), payload.alias("has_payload"), "key",
                         (F.col("may_begin") & (repeating | ~payload)).alias("begins"), "lower", "capitals", F.col("__course").alias("course"), F.col("__groups").alias("groups"), "hours")
    facts = kept(facts, "continuation-facts")
    w = ordered(doc, ["place"])
    mine = facts.withColumn("run", F.sum(F.when(F.col("slot").eqNullSafe(F.lag("slot").over(w)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    w = ordered([*doc, "run"], ["place"])
    fit = lambda a, b: (a == "") | (b == "") | F.contains(a, b) | F.contains(b, a)

    def may_meet(k: int) -> Column:
        """This row may be taken by the one ``k`` places before, whatever that one took till then."""
        host = F.lag(F.struct("begins", "repeating", "key", "course", "groups"), k).over(w)
        goes_on = F.col("has_payload") & (F.col("lower") | (host["repeating"] & F.col("capitals")))
        again = host["repeating"] & F.startswith("key", host["key"])
        return F.coalesce(host["begins"] & fit(host["course"], F.col("course")) & fit(host["groups"], F.col("groups")) & (goes_on | again), F.lit(False))

    back = F.greatest(*[F.when(may_meet(k), F.lit(k)).otherwise(F.lit(0)) for k in range(1, AHEAD + 1)])
    mine = mine.withColumn("back", back)
    # a row begins a cluster if neither it nor one of the next three reaches back over it
    spans = F.greatest("back", *[F.coalesce(F.lead("back", k).over(w), F.lit(0)) - k for k in range(1, AHEAD)])
    mine = mine.withColumn("spans", spans).withColumn("cluster", F.sum(F.when(F.col("spans") > 0, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    mine = kept(mine.drop("slot"), "continuation-clusters")
    met = mine.where("spans > 0").select(*doc, "run", "cluster").distinct()
    goes_on = F.col("lower") | (F.col("repeating") & F.col("capitals"))
    held = mine.join(met, [*doc, "run", "cluster"], "left_semi").select(
        *doc, "run", "cluster", "place", "begins", "repeating", "key", "has_payload", goes_on.alias("goes_on"), "course", "groups",
        F.when(F.col("repeating") & F.col("hours"), "").otherwise(F.col("key")).alias("adds"))
    held = held.repartition(*doc, "run", "cluster").sortWithinPartitions(*doc, "run", "cluster", "place")
    n = len(doc)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema if f.name in doc) + f", place {dict(held.dtypes)['place']}, host {dict(held.dtypes)['place']}, turn int, repeats boolean"

    def run(frames):
        def flowing():
            for frame in frames:
                yield from frame.itertuples(index=False, name=None)

        out, rows = [], flowing()
        row = next(rows, None)
        while row is not None:
            at = row[: n + 2]

            def cluster(at=at):
                nonlocal row
                while row is not None and row[: n + 2] == at:
                    mine = row
                    row = next(rows, None)
                    yield mine[n + 2 :]

            for found in _taken(cluster()):
                out.append((*at[:n], *found))
                if len(out) == 5000:
                    yield pd.DataFrame(out, columns=[*doc, "place", "host", "turn", "repeats"])
                    out = []
        if out:
            yield pd.DataFrame(out, columns=[*doc, "place", "host", "turn", "repeats"])

    return held.mapInPandas(run, schema)


def _also(old: Column, more: Column, sep: str) -> Column:
    return F.array_join(F.array_distinct(F.filter(F.concat(F.array(old), more), lambda x: x != "")), sep)


def with_continuations(df: DataFrame, doc: list[str], place: str, slot: list[str]) -> DataFrame:
    """Rows of documents, ordered by ``place``, with continuations merged into the rows they continue; ``merged`` counts them.

    Subjects are joined by a space; teachers, lesson kinds, rooms and notes gain each new value, links by a space.  Of the source that repeats its
    subjects, hours in place of a subject give lesson kinds and a note.  Rows that only repeat a merged subject go.  Null texts read as empty; places must
    differ within a document.
    """
    text = ["subject", "teacher", "lesson_type", "link", "room", "notes", "course", "groups", "source_name"]
    df = kept(df.withColumns({c: F.coalesce(c, F.lit("")) for c in text}), "continuation-input")
    taken = kept(claims(df, doc, place, slot), "continuation-claims")
    clean = service_tokens(F.col("subject"))
    hours = (F.col("source_name") == REPEATING_SOURCE) & clean.rlike(rx(HOURS))
    lessons = F.array_join(F.array_compact(F.array(*[F.when(clean.rlike(rx(p)), F.lit(v)) for p, v in HOUR_MARKS])), "; ")
    parts = df.join(taken.where("NOT repeats").withColumnRenamed("place", place), [*doc, place]).select(
        *doc, "host", "turn", F.when(hours, "").otherwise(F.regexp_replace("subject", "^[/ ]+", "")).alias("subject"), "teacher", "link", "room",
        F.when(hours, _also(F.col("lesson_type"), F.array(lessons), "; ")).otherwise(F.col("lesson_type")).alias("lesson_type"),
        F.when(hours, _also(F.col("notes"), F.array(F.btrim(clean, F.lit("() "))), "; ")).otherwise(F.col("notes")).alias("notes"))
    names = ["subject", "teacher", "lesson_type", "link", "room", "notes"]
    in_turn = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("turn", c))), lambda s: s[c])
    more = parts.groupBy(*doc, "host").agg(F.count("*").alias("merged"), *[in_turn(c).alias(f"__{c}") for c in names]).withColumnRenamed("host", place)
    gone = taken.select(*doc, F.col("place").alias(place))
    rest = df.join(gone, [*doc, place], "left_anti").join(more, [*doc, place], "left")
    none, has = F.array().cast("array<string>"), F.col("merged").isNotNull()
    fold = lambda c, sep="; ": F.when(has, _also(F.col(c), F.coalesce(f"__{c}", none), sep)).otherwise(F.col(c))
    whole = F.when(has, F.aggregate("__subject", F.col("subject"), lambda a, x: F.when(x == "", a).otherwise(service_tokens(F.concat(F.regexp_replace(a, "[ /]+$", ""), F.lit(" "), x))))).otherwise(F.col("subject"))
    out = rest.withColumns({"subject": whole, **{c: fold(c) for c in ("teacher", "lesson_type", "room", "notes")}, "link": fold("link", " "), "merged": F.coalesce("merged", F.lit(0)).cast("long")})
    return out.select(*df.columns, "merged")
