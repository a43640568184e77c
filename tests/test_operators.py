"""Operators on small inputs where the right answer is written out."""

from pyspark.sql import functions as F

from tabulon.operators import graph, grid, merge, quality, report, rows
from tabulon.operators.records import tabular_records
from tabulon.sinks.workbooks import xlsx_bytes
from tabulon.sources import assets, cells

HEAD = ["Тиждень", "День", "Початок", "Кінець", "Назва предмета", "Викладач", "Тип заняття", "Посилання (якщо є)", "Аудиторія (якщо є)", "Групи", "Курс", "Примітки"]


def _records(spark, body):
    book = xlsx_bytes([("розклад", body)])
    files = spark.createDataFrame([("a.xlsx", bytearray(book))], "locator string, content binary")
    return tabular_records(cells.cells(files)).orderBy("row_index").collect()


def test_fill_down_takes_slot_from_above(spark):
    got = _records(spark, [HEAD, ["Обидва", "Понеділок", "09:30", "10:50", "Анатомія"], ["", "", "", "", "Біохімія", "Вовна О. В."]])
    assert [(r.day, r.start_time, r.subject) for r in got] == [("Понеділок", "09:30", "Анатомія"), ("Понеділок", "09:30", "Біохімія")]


def test_titles_and_repeated_headers_clear_what_is_carried(spark):
    got = _records(spark, [HEAD, ["Обидва", "Понеділок", "09:30", "10:50", "Анатомія"], ["Другий курс"], HEAD, ["", "", "", "", "Біохімія", "Вовна О. В."]])
    assert [(r.day, r.subject) for r in got] == [("Понеділок", "Анатомія"), ("", "Біохімія")]


def test_sheet_without_header_has_no_records(spark):
    assert _records(spark, [["a", "b"], ["c", "d"]]) == []


def test_workbook_cells_are_text_even_if_they_look_like_formulas(spark):
    files = spark.createDataFrame([("a.xlsx", bytearray(xlsx_bytes([("s", [["=1+1", "<&>"]])])))], "locator string, content binary")
    assert {c.text for c in cells.cells(files).collect()} == {"=1+1", "<&>"}


def test_broken_file_gives_an_error_row_and_others_go_on(spark):
    files = spark.createDataFrame([("a.xlsx", bytearray(b"x")), ("b.csv", bytearray(b"1,2"))], "locator string, content binary")
    got = cells.cells(files).collect()
    assert [c.locator for c in got if c.error] == ["a.xlsx"] and {c.text for c in got if not c.error} == {"1", "2"}


def test_html_spans(spark):
    html = b"<table><tr><td colspan=2>a</td><td rowspan=2>b</td></tr><tr><td>c</td><td>d</td></tr></table>"
    files = spark.createDataFrame([("p.html", bytearray(html))], "locator string, content binary")
    got = {c.text: (c.min_row, c.max_row, c.min_col, c.max_col) for c in cells.cells(files).collect()}
    assert got == {"a": (1, 1, 1, 2), "b": (1, 2, 3, 3), "c": (2, 2, 1, 1), "d": (2, 2, 2, 2)}


def test_folder_and_zip_assets(spark, tmp_path):
    import zipfile

    (tmp_path / "a.csv").write_text("x,y")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in/b.csv", "1")
        z.writestr("in/~$b.csv", "1")
        z.writestr("c.exe", "1")
    found = assets.described(assets.expand_zips(assets.folder(spark, str(tmp_path), "s"))).collect()
    assert sorted(a.display_name for a in found) == ["a.csv", "b.csv"]


def test_overlap_join_has_each_pair_once(spark):
    a = spark.createDataFrame([("s", 1, 0, 30)], "sheet string, id int, lo int, hi int")
    b = spark.createDataFrame([("s", 2, 5, 25), ("s", 3, 31, 40), ("t", 4, 0, 9)], "sheet string, id int, lo int, hi int")
    assert [(r.a_id, r.b_id) for r in grid.overlap_join(a, b, ["sheet"], "lo", "hi").collect()] == [(1, 2)]


def test_unique_match_keeps_ambiguous_guests(spark):
    def run(data):
        df = spark.createDataFrame(data, "slot string, n int, subject string, teacher string")
        out = merge.unique_match(df, ["slot"], ["n"], F.col("subject") != "", F.col("subject") == "", F.lit(True), ["teacher"])
        return sorted((r.n, r.subject, r.teacher, r.merged) for r in out.collect())

    assert run([("a", 1, "X", ""), ("a", 2, "", "T")]) == [(1, "X", "T", 1)]
    assert len(run([("a", 1, "X", ""), ("a", 2, "Y", ""), ("a", 3, "", "T")])) == 3


def test_continuation_folds_runs(spark):
    df = spark.createDataFrame([(1, 1, "Методи"), (1, 2, "в соціології"), (1, 3, "Алгебра")], "doc int, n int, subject string")
    out = merge.continuation_runs(df, ["doc"], ["n"], F.col("subject").rlike("^[а-яіїєґ]"), "subject", ["n"])
    assert sorted(r.subject for r in out.collect()) == ["Алгебра", "Методи в соціології"]


def test_first_wins_and_fill_with_nulls(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, ""), (None, 1, "b")], "k int, n int, v string")
    assert {(r.k, r.n) for r in rows.first_wins(df, ["k"], ["n"]).collect()} == {(1, 1), (None, 1)}
    assert [r.v for r in rows.fill_down(df, ["k"], ["n"], ["v"]).where("k = 1").orderBy("n").collect()] == [None, "a", "a"]


def test_flags_and_severity(spark):
    df = spark.createDataFrame([("Алгебра", "Понеділок", "08:00", "09:20", "Вовна О. В.", "ауд. 1"), ("ауд. 12", "", "08:00", "08:10", "", "")],
                               "subject string, day string, start_time string, end_time string, teacher string, room string")
    got = quality.flagged(df, notes=None).withColumn("severity", quality.severity(F.col("flags"))).collect()
    assert (got[0].flags, got[0].severity) == ([], "none")
    assert got[1].severity == "fail" and {"missing_day", "subject_contains_room", "implausible_time"} <= set(got[1].flags)


def test_delta_and_reachability(spark):
    old = spark.createDataFrame([("a", 10)], "s string, n int")
    new = spark.createDataFrame([("a", 14), ("b", 1)], "s string, n int")
    assert sorted(tuple(r) for r in report.delta(old, new, "s", ["n"]).collect()) == [("a", 4), ("b", 1)]
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src long, dst long")
    roots = spark.createDataFrame([(1,)], "node long")
    assert sorted(tuple(r) for r in graph.reachable(edges, roots, 2).collect()) == [(1, 0), (2, 1), (3, 2)]


def test_overlap_join_by_distance_equals_all_pairs(spark):
    side = lambda k: spark.range(60).selectExpr("'s' AS sheet", "id", f"id * {k} % 31 AS lo", f"id * {k} % 31 + id % 5 AS hi", f"id * {k} % 17 - 8 AS r")
    a, b = side(7), side(11)
    got = sorted((r.a_id, r.b_id) for r in grid.overlap_join(a, b, ["sheet"], "lo", "hi", near=("r", 2)).collect())
    want = sorted((x.id, y.id) for x in a.collect() for y in b.collect() if x.lo <= y.hi and y.lo <= x.hi and abs(x.r - y.r) <= 2)
    assert got == want and len(want) > 50
    plan = grid.overlap_join(a, b, ["sheet"], "lo", "hi", near=("r", 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "a_stripe" in plan  # rows far apart in r never meet


def test_nearest_by_tiers_equals_all_pairs_without_making_them(spark):
    left = spark.range(80).selectExpr("id AS a", "if(id % 13 = 0, 'x', 's' || id % 3) AS sheet", "id % 4 AS lo", "id * 7 % 40 AS r")
    right = spark.range(60).selectExpr("id AS b", "'s' || id % 3 AS sheet", "id % 5 AS lo", "id * 11 % 37 AS r")
    tiers = [(["sheet", "lo"], 2), (["sheet"], 3), (["sheet"], None)]
    found = grid.nearest(left, right, ["a"], "r", "b", tiers, "b")

    def best(x):
        d = lambda y: abs(x.r - y.r)
        mine = [y for y in right.collect() if y.sheet == x.sheet]
        return min(((1 if y.lo == x.lo and d(y) <= 2 else 2 if d(y) <= 3 else 3, d(y), y.b) for y in mine), default=(None, None, None))

    want = {x.a: best(x) for x in left.collect()}
    assert {r.a: (r.tier, r.distance, r.b) for r in found.collect()} == want
    assert {t for t, *_ in want.values()} == {None, 1, 2, 3}


def test_places_beside_a_spot_are_the_last_and_the_next_mark(spark):
    spots = spark.createDataFrame([("s", 1), ("s", 5), ("s", 5), ("s", 9), ("t", 1)], "sheet string, r int")
    marks = spark.createDataFrame([("s", 3, "a"), ("s", 5, "b"), ("s", 7, "c")], "sheet string, r int, v string")
    got = {(x.sheet, x.r): (x.before and x.before.v, x.after and x.after.v) for x in grid.beside(spots, marks, ["sheet"], "r").collect()}
    assert got == {("s", 1): (None, "a"), ("s", 5): ("b", "b"), ("s", 9): ("c", None), ("t", 1): (None, None)}


def test_many_small_files_share_batches():
    got = list(cells.batched((f"c-{i}.csv", b"name,segment\n\n\"a\",b\n") for i in range(2000)))
    assert [b.num_rows for b in got] == [5000, 3000]
    assert len(set(got[0].column("locator").to_pylist())) == 1250


def test_workbooks_are_deflated_and_neither_written_nor_read_as_a_whole():
    import tracemalloc

    body = [["Понеділок", f"Основи програмування {i}", f"Вовна О. В. {i}"] for i in range(20000)]
    tracemalloc.start()
    book = xlsx_bytes([("a", body)])
    assert sum(1 for _ in cells.xlsx_cells(book)) == 60000
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(book) < 1_000_000 and most < 8_000_000


def test_parts_of_a_large_workbook_keep_all_records(spark, monkeypatch):
    from conftest import SF, as_rows

    from tabulon.plans import files
    from tabulon.sinks import workbooks

    whole = as_rows(files.workbook_roundtrip(spark, SF).toPandas())
    monkeypatch.setattr(workbooks.workbooks, "__defaults__", (20,))  # most rows of a part
    assert as_rows(files.workbook_roundtrip(spark, SF).toPandas()) == whole


def test_unique_match_folds_hosts_and_guests_to_kinds(spark):
    """One slot with many rows: no kind is met more than once, and ambiguous guests stay as they are."""
    df = spark.range(3000).selectExpr("'a' AS slot", "id AS n", "if(id < 1000, 'X', '') AS subject", "if(id < 1000, '', 'T' || id) AS teacher",
                                      "if(id = 0 OR id % 2 = 1, id % 2, 2)::string AS k")
    fits = F.col("h.k") == F.col("g.k")
    out = merge.unique_match(df, ["slot"], ["n"], F.col("subject") != "", F.col("subject") == "", fits, ["teacher"], by=("k",)).collect()
    assert len(out) == 3000 and sum(r.merged for r in out) == 0
    one = df.where("n = 1 OR n >= 1000")
    out = merge.unique_match(one, ["slot"], ["n"], F.col("subject") != "", F.col("subject") == "", fits, ["teacher"], by=("k",)).collect()
    assert {r.n: r.merged for r in out if r.merged} == {1: 1000} and len(out) == 1001


def test_service_rows_are_judged_by_distinct_text(spark, capsys):
    """repeated rows stay as often as they stand, nulls read as empty, and the rules run behind a grouping of texts, not on every row."""
    rows = [(1, "Алгебра", "декан"), (1, "Алгебра", "декан"), (2, "вільний день", "x"), (3, None, "вільний день"), (4, " ", None), (5, "", "x"), (5, "", "x"), (6, None, "Google Classroom"), (7, "Право", None)]
    kept = quality.without_dropped(spark.createDataFrame(rows, "id int, subject string, notes string"), evidence=("notes",))
    assert kept.columns == ["id", "subject", "notes"] and sorted(r.id for r in kept.collect()) == [1, 1, 4, 5, 5, 7]
    kept.explain()
    assert "Aggregate(keys=[x#" in capsys.readouterr().out


def test_the_quality_chain_reads_its_rows_once(spark, capsys):
    """flags and the texts of each column read kept rows; the joins and the window before them ran four times."""
    from conftest import SF

    from tabulon.plans import flow

    flow.full_row_quality(spark, SF).explain()
    plan = capsys.readouterr().out
    assert "lineitem" not in plan and "Window" not in plan


def test_an_audit_joins_texts_that_are_kept(spark, capsys):
    """by the rows' size the join could not know how few texts there are, so it shuffled all rows by subject."""
    row = ("f", "s", "Алгебра", "Т", "Обидва", "Середа", "09:30", "10:50")
    df = spark.createDataFrame([row, row, (*row[:2], None, *row[3:])], "file string, sheet string, subject string, teacher string, week_type string, day string, start_time string, end_time string")
    found = quality.audit(df, "file", "sheet")
    found.explain()
    assert "keys=[x#" not in capsys.readouterr().out and [r.row_count for r in found.collect()] == [3]


def test_bare_groups_and_buckets_are_demoted(spark):
    """only accepted rows are demoted and counted; a demoted row does not count in its bucket; null faculties are a bucket."""
    row = lambda i, subject="Алгебра", slot="a", teacher="", program="Хімія полімерів", faculty="Ф", src="law-schedule", ok=True, flags=(): (
        i, src, faculty, program, slot, subject, teacher, "", "", list(flags), ok)
    rows = [row(1, "Фізика!"), row(2), row(3, teacher="Т"), row(4, slot="b"), row(5, "Фізика!", slot="b", ok=False, flags=["missing_day"]), *[row(i, slot="c", teacher="Т") for i in range(6, 9)],
            *[row(i, slot="d", teacher="Т", program="розклад", faculty=None) for i in (10, 11, 12)], row(13, slot="d", program="розклад", faculty=None, ok=False),
            *[row(i, slot="d", teacher="Т", program="розклад", faculty="Г") for i in (14, 15, 16, 17)], row(18, slot="d", teacher="Т", program="розклад", faculty="В"),
            row(19, "Фізика!", slot="e", program="розклад", faculty="Д"), row(20, slot="e", program="розклад", faculty="Д"), *[row(i, slot="f", teacher="Т", program="розклад", faculty="Д") for i in (21, 22, 23)],
            *[row(i, slot="g", teacher="Т", program="Timetable", faculty="Є", src="phys-schedule") for i in (30, 31, 32, 33)], row(40, program="", faculty="Ж", teacher="Т")]
    df = spark.createDataFrame(rows, "id int, source_name string, faculty string, program string, slot string, subject string, teacher string, groups string, notes string, flags array<string>, accepted boolean")
    found = {r.id: (r.accepted, r.flags) for r in quality.demoted(df, ["faculty", "slot"], F.col("teacher") == "", F.col("subject").endswith("!")).collect()}
    mixed, bad = (False, ["inconsistent_columns"]), (False, ["bad_program_label"])
    assert len(found) == len(rows) and found[1] == found[2] == mixed and found[19] == found[20] == mixed and found[5] == (False, ["missing_day"]) and found[13] == (False, [])
    assert {i for i, f in found.items() if f == bad} == {10, 11, 12, 18, 21, 22, 23, 30, 31, 32, 33, 40}
    assert all(found[i] == (True, []) for i in (3, 4, 6, 7, 8, 14, 15, 16, 17))


def test_the_quality_chain_ends_with_demotion(spark, tmp_path):
    """accepted rows of a small bucket whose program is no program go to review; the chain ended before that."""
    from tabulon.plans import flow

    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write("nation", [(1, "Факультет", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(1, 1, "розклад"), (2, 1, "Хімія полімерів")], "c_custkey long, c_nationkey int, c_mktsegment string")
    write("supplier", [(1, "Вовна О. В.")], "s_suppkey long, s_name string")
    write("part", [(i, f"Основи програмування {i}", i) for i in range(1, 8)], "p_partkey long, p_name string, p_size int")
    write("orders", [(1, 1), (2, 2)], "o_orderkey long, o_custkey long")
    write("lineitem", [(1 + (i > 2), i % 6 + 1, i, 1, 10.0, float(i), 0.05, "N", "F") for i in range(1, 8)],
          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string")
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet").withColumn("l_shipdate", F.lit("1995-01-01").cast("timestamp"))
    lines.write.parquet(f"{tmp_path}/dated/lineitem.parquet")
    (tmp_path / "lineitem.parquet").rename(tmp_path / "undated")
    (tmp_path / "dated" / "lineitem.parquet").rename(tmp_path / "lineitem.parquet")
    found = {(r.severity, r.accepted, r.flags): r.n for r in flow.full_row_quality(spark, str(tmp_path)).collect()}
    assert found == {("fail", False, "bad_program_label"): 2, ("none", True, ""): 5}


def test_sheets_are_read_as_streamed_elements_say(spark):
    """cells are read with fewer steps each; nested, empty, repeated and split texts come out as from the general reader."""
    import io
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    long = "ж&amp;" * 9000
    body = (f'<row><c r="A1" t="inlineStr"><is><r><t>a</t></r> <r><t> b</t></r></is></c><c r="B1"><v>1</v><v>2</v></c><c r="C1"/><c r="D1"><v></v></c><c><f>1</f><v>{long}</v></c></row>'
            f'<c r="AB12"><v>5</v><x:t xmlns:x="y">no</x:t></c><t>no</t><v>no</v><c t="inlineStr"><is><t>{long}</t><t/></is></c>')
    sheet = f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>".encode()
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("s.xml", sheet)
    with zipfile.ZipFile(book) as z:
        want = [(a, "".join(x.get("t", ())), x["v"][0] if "v" in x else None) for a, x in cells._streamed(z, "s.xml", "c", ("t", "v"))]
    got = [(a, "".join(t), None if v is None else "".join(v)) for a, t, v in cells._sheet_cells(io.BytesIO(sheet))]
    assert got == want and len(got) == 7
    place = cells._places()
    assert all(place(r) == cells.column_number(r) for r in ("A1", "Z9", "AA10", "ZZ3", "A7", "A1B2"))


def test_quick_looks_find_all_headers_and_keep_names(spark):
    """cells without a header's letters are not made to keys, plain names stand as they are."""
    from tabulon.functions import text
    from tabulon.operators import records

    heads = [f(h) for h in records.HEADERS for f in (str, str.upper, str.title, lambda x: f" {x}\u00a0(якщо є) ", lambda x: "-".join(x.split(" ")) + ":")]
    df = spark.createDataFrame([(h,) for h in heads], "t string").where(text.header_key(F.col("t")).isin(*records.HEADERS))
    assert df.count() >= 4 * len(records.HEADERS) and df.where(~records.may_head(F.col("t"))).count() == 0
    names = {"a b": "a b", "UNITED STATES": "UNITED STATES", " a": "a", "a.": "a", "a  b": "a b", "a/b": "a_b", "": "untitled", ". .": "untitled", "a\n": "a", "a\u00a0b": "a b", "ж" * 130: "ж" * 120, "a.b": "a.b", "a..b": "a..b", None: "untitled"}
    got = spark.createDataFrame([(n,) for n in names], "t string").select("t", text.file_slug(F.col("t")).alias("s")).collect()
    assert {r.t: r.s for r in got} == names
