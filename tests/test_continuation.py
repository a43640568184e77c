"""Look-ahead merges against a reader that goes through the rows one by one."""

import contextlib
import io
import random
import re

from tabulon.operators import continuation
from tabulon.operators.continuation import REPEATING_SOURCE, with_continuations

SCHEMA = "doc string, n int, day string, source_name string, subject string, teacher string, lesson_type string, link string, room string, notes string, course string, groups string"
SUBJECTS = ["Вища математика", "та її історія", "вища математика", "ВИЩА МАТЕМАТИКА", "ДОСЛІДЖЕННЯ ринку", "ДОСЛІДЖЕННЯ РИНКУ", "(Переклад назви)", "Л - 2 год., ПР - 4 год.", "Одне", "", "Вища математика та її історія"]


def key(x):
    return re.sub(r"[\W_]+", "", x.lower())


def merged(rows):
    """{place: (subject, merged)} of one document."""
    rows = [dict(zip(("place", "day", "source", "subject", "room", "course"), r), gone=False, merged=0, key=key(r[3])) for r in rows]
    for i, row in enumerate(rows):
        soc, s = row["source"] == REPEATING_SOURCE, row["subject"]
        if row["gone"] or not s or (not soc and row["room"]) or s[0].islower() or len(s.split()) < 2:
            continue
        while True:
            again, found = [], None
            for c in rows[i + 1 : i + 5]:
                if c["gone"]:
                    continue
                if c["day"] != row["day"]:
                    break
                near = not c["course"] or not row["course"] or c["course"] == row["course"]
                if soc and near and c["key"] == row["key"]:
                    again.append(c)
                    continue
                t = c["subject"]
                goes_on = t and (t[0].islower() or (soc and (t == "ДОСЛІДЖЕННЯ РИНКУ" or t[0] == "(" or t[0] == "Л")))
                if c["room"] and near and goes_on and c["key"] != row["key"]:
                    found = c
                    break
            if not found:
                break
            for c in [found, *again]:
                c["gone"] = True
            row["merged"] += 1
            if not (soc and found["subject"][0] == "Л"):
                row["subject"] += " " + found["subject"]
                row["key"] += found["key"]
    return {r["place"]: (r["subject"], r["merged"]) for r in rows if not r["gone"]}


def test_against_a_reader_of_rows(spark):
    rnd, rows, want = random.Random(8), [], {}
    for d in range(150):
        source = REPEATING_SOURCE if d % 2 else "other"
        mine = [(n, f"day {n // rnd.choice((3, 9, 30))}", source, rnd.choice(SUBJECTS), rnd.choice(["", "101", "102"]), rnd.choice(["", "1", "2"])) for n in range(rnd.randint(1, 30))]
        rows += [(f"d{d}", n, day, s, subject, "", "", "", room, "", course, None) for n, day, s, subject, room, course in mine]
        want |= {(f"d{d}", n): v for n, v in merged(mine).items()}
    out = with_continuations(spark.createDataFrame(rows, SCHEMA).repartition(4), ["doc"], "n", ["source_name", "day"]).collect()
    assert {(r.doc, r.n): (r.subject, r.merged) for r in out} == want and len(out) == len(want)
    assert sum(m > 1 for _, m in want.values()) > 5


def test_fields_of_merged_rows(spark):
    rows = [("a", 1, "Понеділок", "geo", "Педагогіка вищої школи та педагогічна", "", "", "", "", "", "", "ГЕОГРАФІЯ"),
            ("a", 2, "Понеділок", "geo", "майстерність викладача", "Литвинчук Л.М.", "лекція", "", "", "", "", "ГЕОГРАФІЯ"),
            ("b", 1, "Понеділок", REPEATING_SOURCE, "CURRENT ISSUES IN SOCIAL SCIENCES", "", "", "", "ауд. 312", "", "1", "1 підгрупа"),
            ("b", 2, "Понеділок", REPEATING_SOURCE, "CURRENT ISSUES IN SOCIAL SCIENCES", "", "", "", "ауд. 312", "", "1", "1 підгрупа"),
            ("b", 3, "Понеділок", REPEATING_SOURCE, "(Актуальні проблеми в соціальних науках)", "", "", "https://z", "ауд. 312", "", "1", "1 підгрупа"),
            ("b", 4, "Понеділок", REPEATING_SOURCE, "Л - 20 год., ПР - 4 год.", "", "", "https://y", "", "", "1", "1 підгрупа")]
    got = {r.doc: r for r in with_continuations(spark.createDataFrame(rows, SCHEMA), ["doc"], "n", ["source_name", "day"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.subject, a.teacher, a.lesson_type, a.merged) == ("Педагогіка вищої школи та педагогічна майстерність викладача", "Литвинчук Л.М.", "лекція", 1)
    assert (b.subject, b.room, b.link) == ("CURRENT ISSUES IN SOCIAL SCIENCES (Актуальні проблеми в соціальних науках)", "ауд. 312", "https://z https://y")
    assert (b.lesson_type, b.notes, b.merged) == ("лекція; практичне заняття", "Л - 20 год., ПР - 4 год.", 2)


def test_empty_table(spark):
    assert with_continuations(spark.createDataFrame([], SCHEMA), ["doc"], "n", ["source_name", "day"]).count() == 0


def test_texts_are_judged_once_each(spark, monkeypatch):
    """the rules on subjects stand behind a grouping of texts; before, they ran on every row."""
    plans = []
    real = continuation.kept
    monkeypatch.setattr(continuation, "kept", lambda df, name: (name == "continuation-facts" and plans.append(df), real(df, name))[1])
    rows = [("a", n, "Понеділок", "geo", "Педагогіка вищої школи та", "", "", "", "", "", "", "") for n in range(4)]
    assert with_continuations(spark.createDataFrame(rows, SCHEMA), ["doc"], "n", ["source_name", "day"]).count() == 4
    with contextlib.redirect_stdout(io.StringIO()) as out:
        plans[0].explain()
    assert "keys=[subject#" in out.getvalue() and plans[0].count() == 4
