"""Row quality: confidence, flags, routing, group and bucket demotion, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import classify, programs, times
from tabulon.functions import segments as seg
from tabulon.functions.text import behind_first, let, service_tokens
from tabulon.sources.scratch import kept

#: Flags that send a row to review.
HARD_FLAGS = (
    "bad_program_label", "missing_day", "missing_time", "missing_subject", "subject_contains_room", "subject_contains_teacher",
    "subject_contains_link", "subject_too_long", "teacher_too_long", "garbage_text", "inconsistent_columns", "implausible_time",
    "service_text_subject",
)
THRESHOLD = 0.74
# Patterns of subjects, teachers and rooms that stand in the wrong column.
A_TRAILING_ROOM = r"(?:\s*/\s*|\s+)(?:\d{3,4}[А-ЯІЇЄҐA-Z]?|[А-ЯІЇЄҐA-Z]-?\d{2,4}|(?:хімічний|географічний)\s+ф-?т\s+\d{2,4})$"
C_SURNAME_INITIAL = r"\b[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.(?!\s*[А-ЯІЇЄҐ]\.)"
A_LESSON = r"\((?:лек|прак|сем|лаб|lek|sem|prac)"
A_NUMBER = r"\b\d{3,4}\b"
A_CLOCK = r"\b\d{1,2}[.:]\d{2}\b"
A_TITLE = r"\b(?:доц|проф|ас|асист|викл)\.?\b"
PASSWORD_MARKS = ("?pwd=", "?p=", ".us")
DASHES = ("-----", "––––", "лек.....", "практ.....")
FOREIGN_LANGUAGE = ("іноземна мова", "англійська мова")
W_SOLID_CODE = r"^[A-Za-z0-9=._-]{10,}$"
TINY_BAD = (
    r"^розклад\b", r"^начитка!?$", r"^постій", r"^увага", r"^початок\s+занять", r"^навчання\s+з\s+використанням", r"^\d+\s*магістр\w*$",
    r"^\d+\s*курс\s*\([^)]{2,}\)$", r"^.+\s+\((?:л|пр|лаб|сем)\)$",
)
FRAGMENTED = (
    r"^[А-ЯІЇЄҐ'’ʼ-]+\s+[А-ЯІЇЄҐ]$", r"^\([^)]{1,12}\)\s*\d.*$", r"^\d{1,2}\.\d{1,2}\..*$",
    r"^(?:dr|prof|associate|assistant)\.?\s+[A-ZА-ЯІЇЄҐ][A-Za-zА-ЯІЇЄҐа-яіїєґ'’ʼ.-]+(?:\s+[A-ZА-ЯІЇЄҐ][A-Za-zА-ЯІЇЄҐа-яіїєґ'’ʼ.-]+){0,3}$",
    r"^\d{1,2}\s*курс$", r"^\d+\s*магістр\w*$", r"^\d+\s*курс\s*\([^)]{2,}\)$", r"\((?:л|пр|лаб|сем)\)$", r"^(?:rozklad |schedule of classes )",
    r"^(?:та|і|й|and)(?: |$)", r"(?:^| )(?:та|і|й|and)$", r";", r"\b\d+\s*год\.?",
)
A_UPPER_MARKS = (r"\((?:с|л|пр)\)?", r"\b\d+\s*год\.?")
C_ECONOM_NAME = r"[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐA-Z]\.(?:[А-ЯІЇЄҐA-Z]\.?)?"
C_SHOUTED_NAME = r"[А-ЯІЇЄҐ][А-ЯІЇЄҐ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.(?:\s*[А-ЯІЇЄҐ]\.?)?"
C_SHORT_UPPER = r"[A-ZА-ЯІЇЄҐ]{2,5}"
C_LONG_UPPER = r"[А-ЯІЇЄҐA-Z][А-ЯІЇЄҐA-Z-]{3,}"
W_PHYS_TITLE = r"акад|чл\.-?кор|с\.н\.с|[дк]\.[а-яіїєґ]\.-?[а-яіїєґ]\.[а-яіїєґ]\.?"
A_PHYS_BAD = (r"\b(?:timetable|sem\.)", r"\b20\d{2}\b")
PHYS_SAFE = ("груп", "курс", "бакалавр", "магістр", "фізик", "оптик", "астроном", "мат-во", "матем", "івт", "наносистем")
BIOMED_SUBJECTS = ("іноземна мова", "основи підприємництва")
LAB_PROGRAMS, LAB_SUBJECT = ("лаб.діагностика бакалавр", "лаб.діагностика"), "Ендокринологія з оцінкою результатів досліджень"
#: No rule for buckets fits a larger one than this, but for this source's.
TINY, ANY_SIZE = 3, "phys-schedule"
MILITARY, PRACTICE = "Базова загальновійськова підготовка", "Захист навчальної практики"


def confidence(has_day: Column, has_start: Column, has_end: Column, has_subject: Column, warnings: Column) -> Column:
    """0.28 day + 0.24 each of start, end and subject - 0.05 a warning (four at most), within 0 and 1."""
    part = lambda has, w: F.when(has, F.lit(w)).otherwise(F.lit(0.0))
    total = part(has_day, 0.28) + part(has_start, 0.24) + part(has_end, 0.24) + part(has_subject, 0.24)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total - F.lit(0.05) * F.least(warnings, F.lit(4))))


def _facts(df: DataFrame, column: str, facts: dict[str, Column]) -> DataFrame:
    """(__x, facts) of every distinct text of a column."""
    each = df.select(F.coalesce(F.col(column), F.lit("")).alias("x")).distinct()
    return each.withColumn("t", F.trim("x")).select(F.col("x").alias("__x"), *[c.alias(n) for n, c in facts.items()])


def is_wrapped(t: Column) -> Column:
    """A subject that was broken over lines: three or more parts between slashes that go on in lower case or brackets, a lesson mark among them."""
    pieces = F.filter(F.transform(F.split(t, " / "), F.trim), lambda p: p != "")
    bad = classify.has_link(t) | classify.is_teacher(t) | classify.is_room(t) | classify.is_roomish_subject(t) | seg.somewhere(t, A_TRAILING_ROOM, r"\d{2}\.\d{2}\.\d{4}")
    goes_on = F.forall(behind_first(pieces), lambda p: p.startswith("(") | seg.lead_lower(p))
    return ~bad & (F.size(pieces) >= 3) & F.forall(pieces, lambda p: p.rlike(r"\p{L}")) & goes_on & seg.somewhere(t, A_LESSON)


def subject_facts(t: Column) -> dict[str, Column]:
    has, marked = t != "", lambda marks: seg.holds(t, marks)
    slashes = (F.length(t) - F.length(F.replace(t, F.lit(" / "), F.lit("")))) / 3
    solid = ~F.contains(t, F.lit(" ")) & (classify.is_code_token(t) | t.rlike(W_SOLID_CODE))
    return {
        "s_room": has & (classify.is_room(t) | classify.is_roomish_subject(t) | seg.somewhere(t, A_TRAILING_ROOM)),
        "s_teacher": has & (classify.is_teacher(t) | t.rlike("(?U)" + C_SURNAME_INITIAL)),
        "s_link": has & classify.has_link(t),
        "s_service": has & (classify.is_admin(t) | classify.is_service(t) | classify.is_forbidden_subject(t)),
        "s_long": F.length(t) > 140,
        "s_garbage": has & (classify.is_garbage(t) | marked(PASSWORD_MARKS) | t.startswith("=") | t.rlike(r"^\d+$") | ~t.rlike(r"\p{L}")
                            | seg.whole(t, seg.W_ABBREVIATION) | solid),
        "s_columns": has & (((slashes >= 2) & ~is_wrapped(t)) | t.rlike(r"\d{2}\.\d{2}\.\d{4}") | marked(DASHES) | seg.is_fragment_subject(t)),
        "s_language": F.lower(service_tokens(t)).isin(*FOREIGN_LANGUAGE),
    }


def teacher_facts(t: Column) -> dict[str, Column]:
    semicolons = F.length(t) - F.length(F.replace(t, F.lit(";"), F.lit("")))
    mixed = seg.somewhere(t, A_LESSON, A_NUMBER, A_CLOCK)
    return {
        "t_long": F.length(t) > 180, "t_many": semicolons >= 5, "t_columns": mixed | seg.holds(t, ("лек", "практ")),
        "t_parallel": (semicolons >= 3) & ~classify.has_link(t) & ~mixed,
    }


def room_facts(t: Column) -> dict[str, Column]:
    return {"r_columns": (t != "") & (classify.is_teacher(t) | classify.has_link(t) | (F.length(t) > 80) | seg.somewhere(t, A_TITLE))}


def notes_facts(t: Column) -> dict[str, Column]:
    return {"n_columns": (F.length(t) > 240) | ((F.length(t) > 80) & classify.is_service(t))}


def flagged(df: DataFrame, source: str = "source_name", subject: str = "subject", day: str = "day", start: str = "start_time", end: str = "end_time",
            teacher: str = "teacher", room: str = "room", notes: str | None = "notes") -> DataFrame:
    """``df`` plus ``flags``: the distinct quality flags of each row, in the order of ``RULES``.

    Texts are classified once for every distinct subject, teacher, room and note.  Parallel foreign-language classes of
    one source may name many teachers.
    """
    t = F.col("t")
    wide = df if notes else df.withColumn("n_columns", F.lit(False))
    for column, facts in ((subject, subject_facts(t)), (teacher, teacher_facts(t)), (room, room_facts(t)), (notes, notes_facts(t))):
        if column:
            wide = wide.join(_facts(df, column, facts), F.coalesce(F.col(column), F.lit("")) == F.col("__x")).drop("__x")
    fit = F.lower(source) == "fit-schedule" if source in df.columns else F.lit(False)
    parallel = fit & F.col("s_language") & F.col("t_parallel")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rules = [
        ("missing_day", blank(day)),
        ("missing_time", blank(start) | blank(end)),
        ("missing_subject", F.trim(F.coalesce(F.col(subject), F.lit(""))) == ""),
        ("subject_contains_room", F.col("s_room")),
        ("subject_contains_teacher", F.col("s_teacher")),
        ("subject_contains_link", F.col("s_link")),
        ("service_text_subject", F.col("s_service")),
        ("subject_too_long", F.col("s_long")),
        ("teacher_too_long", F.col("t_long") & ~parallel),
        ("inconsistent_columns", F.col("t_columns") | (F.col("t_many") & ~parallel) | F.col("r_columns") | F.col("n_columns") | F.col("s_columns")),
        ("garbage_text", F.col("s_garbage")),
        ("implausible_time", times.implausible(F.col(start), F.col(end), F.col(subject))),
    ]
    flags = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))
    return wide.select(*df.columns, flags.alias("flags"))


def severity(flags: Column) -> Column:
    hard = F.size(F.array_intersect(flags, F.array(*map(F.lit, HARD_FLAGS)))) > 0
    return F.when(hard, "fail").when(F.size(flags) > 0, "warning").otherwise("none")


def accepted(flags: Column, score: Column, required: list[str], threshold: float = THRESHOLD) -> Column:
    """Whether a row needs no review: all required fields, enough confidence, no hard flag."""
    whole = F.lit(True)
    for c in required:
        whole = whole & (F.col(c) != "")
    return whole & (score >= threshold) & (F.size(F.array_intersect(flags, F.array(*map(F.lit, HARD_FLAGS)))) == 0)


def demote_bare_groups(df: DataFrame, group: list[str], is_bare: Column, is_fragment: Column) -> DataFrame:
    """``demoted``: bare rows of a group that has two or more of them, a fragment among them."""
    w = Window.partitionBy(*group)
    return (df.withColumn("__bare", F.coalesce(is_bare, F.lit(False)))
            .withColumn("__n", F.sum(F.when(F.col("__bare"), 1).otherwise(0)).over(w))
            .withColumn("__frag", F.max(F.when(F.col("__bare") & is_fragment, 1).otherwise(0)).over(w))
            .withColumn("demoted", F.col("__bare") & (F.col("__n") >= 2) & (F.col("__frag") == 1)).drop("__bare", "__n", "__frag"))


def demote_buckets(df: DataFrame, bucket: list[str], rules: dict[str, Column], most: int = 3) -> DataFrame:
    """``demoted`` and ``reason`` of whole buckets of at most ``most`` rows.

    Rules are aggregates over a bucket; sizes come from a grouped count that joins
    back, so a bucket of any size is never held by one task.
    """
    facts = df.groupBy(*bucket).agg(F.count("*").alias("bucket_rows"), *[c.alias(f"__{n}") for n, c in rules.items()])
    why = F.coalesce(*[F.when(F.col(f"__{n}"), F.lit(n)) for n in rules])
    small = facts.select(*bucket, "bucket_rows", F.when(F.col("bucket_rows") <= most, why).alias("reason"))
    return df.join(small, bucket).withColumn("demoted", F.col("reason").isNotNull())


def is_anchored(notes: Column, program: Column) -> Column:
    """Notes that are the program's label, or begin with it and a sign."""
    rest = F.substr(notes, F.length(program) + 1)
    return (notes != "") & (program != "") & F.startswith(notes, program) & ((rest == "") | rest.rlike(r"^\s*[:;,.]"))


def is_fragmented_program(t: Column) -> Column:
    unbalanced = F.length(F.replace(t, F.lit("("), F.lit(""))) != F.length(F.replace(t, F.lit(")"), F.lit("")))
    return ((t == "") | classify.is_teacher(t) | unbalanced | seg.somewhere(t, *FRAGMENTED) | seg.is_opaque_code(t) | seg.lead_lower(t)
            | (F.contains(t, F.lit("+")) & seg.somewhere(t, A_LESSON)))


def is_shouted_program(t: Column) -> Column:
    """Mostly capitals with a lesson mark or hours: a subject, not a program."""
    letters = F.length(F.regexp_replace(t, r"\P{L}", ""))
    return (letters > 0) & (F.length(F.regexp_replace(t, r"\P{Lu}", "")) >= letters * F.lit(0.9)) & seg.somewhere(t, *A_UPPER_MARKS)


def bucket_reasons(df: DataFrame, source: str = "source_name", faculty: str = "faculty", program: str = "program", subject: str = "subject",
                   groups: str = "groups", notes: str = "notes") -> DataFrame:
    """(faculty, program, n, reason): why a whole bucket goes to review, null if it need not.

    Every rule is a condition on a bucket's size, its program and on what holds for all or any of its rows, so one grouping with
    partial aggregation decides, however large a bucket is.
    """
    tokens = lambda c: service_tokens(F.coalesce(F.col(c), F.lit("")))
    rows = programs.labelled(df.select(F.lower(source).alias("src"), F.col(faculty).alias("fac"), F.col(program).alias("prog"), tokens(subject).alias("subj"),
                                       tokens(groups).alias("grp"), tokens(notes).alias("note")), "prog", "p")
    rows = rows.withColumn("anchored", is_anchored(F.col("note"), F.col("p_candidate")))
    words = F.regexp_extract_all(F.lower("p_candidate"), F.lit(r"([а-яіїєґa-z]{5,})"), F.lit(1))
    named = F.exists(words, lambda w: F.contains(F.lower("note"), w))
    filled, s = F.col("subj") != "", F.col("subj")
    every, some = (lambda c: F.bool_and(F.coalesce(c, F.lit(False)))), (lambda c: F.bool_or(F.coalesce(c, F.lit(False))))
    study = seg.whole(F.col("note"), seg.W_DROP_SERVICE)
    facts = rows.groupBy("fac", "prog").agg(
        F.count("*").alias("n"), F.min("src").alias("src"), F.first("p_candidate").alias("c"), F.first("p_bad").alias("bad"),
        every(F.col("grp") == "").alias("no_groups"), every(F.col("anchored")).alias("anchored"), every(~F.col("anchored")).alias("loose"),
        F.min(F.when(filled, s)).alias("low"), F.max(F.when(filled, s)).alias("high"), every(F.col("note") != "").alias("noted"), every(named).alias("named"),
        every(filled & (s != F.col("p_candidate"))).alias("others"), every(~filled | (s != F.col("p_candidate"))).alias("none_same"),
        some(F.contains(F.col("note"), F.lit(" ; "))).alias("listed"), some(seg.is_fragment_subject(s)).alias("fragment"),
        some(classify.is_room(s) | classify.is_roomish_subject(s) | seg.is_fragment_subject(s)).alias("loose_subject"), some(study).alias("study"),
        every(F.col("note") == F.col("p_candidate")).alias("notes_are_program"), every(seg.cased(s, C_LONG_UPPER)).alias("shouted"),
        some(s == MILITARY).alias("military"), every(F.startswith(F.lower("note"), F.lower(service_tokens(F.col("prog"))))).alias("notes_begin"))
    n, c, low = F.col("n"), F.col("c"), F.lower("c")
    one = F.col("low").isNotNull() & (F.col("low") == F.col("high"))
    only = lambda *names: one & F.col("low").isin(*names)
    of = lambda name, most: (F.col("src") == f"{name}-schedule") & (n <= most)
    bio = F.coalesce(only(*BIOMED_SUBJECTS), F.lit(False))
    numbered = c.rlike(r"^\d{3}\s+")
    anchored, no_groups = F.col("anchored"), F.col("no_groups")
    rules = [
        ("history", (of("history", 3) & numbered & no_groups & F.col("low").isNotNull() & F.col("none_same") & (anchored | (F.col("noted") & F.col("named"))))
         | (of("history", 1) & anchored & F.col("others"))),
        ("biomed", (of("biomed", 2) & bio & no_groups & (anchored | F.col("notes_begin"))) | (of("biomed", 2) & (F.col("fragment") | ((low == "іноземна мова") & anchored & F.col("others"))))
         | (of("biomed", 3) & low.isin(*LAB_PROGRAMS) & F.col("noted") & only(LAB_SUBJECT) & F.col("listed") & F.col("loose"))),
        ("chem", of("chem", 3) & anchored & no_groups & one & seg.cased(F.col("low"), C_SHORT_UPPER)),
        ("phys", (F.col("src") == "phys-schedule") & (seg.whole(c, W_PHYS_TITLE) | seg.somewhere(c, *A_PHYS_BAD))),
        ("phys_small", (of("phys", 3) & (classify.is_teacher(c) | ~seg.holds(c, PHYS_SAFE) | F.col("loose_subject")))),
        ("iht", of("iht", 3) & (seg.program_codes(c) >= 1)),
        ("law", of("law", 3) & seg.whole(c, r"\d+\s*академ\w*")),
        ("econom", of("econom", 2) & seg.cased(c, C_ECONOM_NAME)),
        ("sociology", of("sociology", 3) & (low.isin("english", "англ.мова") | seg.whole(c, r"\d+\s*маг\b.*", r"[лпс]-\d+\s*год\.?") | is_shouted_program(c) | classify.is_teacher(c)
                                            | seg.cased(c, C_SHOUTED_NAME) | (F.col("notes_are_program") & F.col("shouted")) | (one & (F.col("low") != c) & no_groups & anchored))),
        ("psy", of("psy", 3) & (((n == 1) & F.col("study")) | only(MILITARY) | (F.col("study") & F.col("military")) | ((n == 1) & only(PRACTICE) & F.col("noted") & ~anchored)
                                | ((n <= 2) & F.col("study") & no_groups))),
        ("mechmat", of("mechmat", 1) & (F.contains(c, F.lit("+")) | seg.somewhere(c, A_LESSON))),
        ("any", (n <= 3) & (F.col("bad") | seg.somewhere(c, *TINY_BAD) | is_fragmented_program(c) | (F.length(c) >= 70)
                            | low.isin("", "unknown program", "невідома програма") | (low == F.lower(programs.humanized(F.col("src")))) | (low == F.col("src")) | (low == F.lower("fac")))),
    ]
    reason = F.coalesce(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules])
    return facts.select(F.col("fac").alias(faculty), F.col("prog").alias(program), "n", reason.alias("reason"))


def demoted(df: DataFrame, group: list[str], is_bare: Column, is_fragment: Column, source: str = "source_name", faculty: str = "faculty", program: str = "program") -> DataFrame:
    """``df`` with its ``flags`` and ``accepted`` after both demotions: of a group's bare rows, then of whole buckets of (faculty, program).

    Only accepted rows are demoted, and only those count.  Groups are looked for among the bare ones alone; texts of a bucket are judged where a rule may fit its size or source.
    """
    add = lambda cond, name: {"flags": F.when(cond, F.array_union("flags", F.array(F.lit(name)))).otherwise(F.col("flags")), "accepted": F.col("accepted") & ~cond}
    bare = F.coalesce(F.col("accepted") & is_bare, F.lit(False))
    met = demote_bare_groups(df.where(bare), group, F.lit(True), is_fragment).withColumns(add(F.col("demoted"), "inconsistent_columns")).drop("demoted")
    df = df.where(~bare).unionByName(kept(met, "demoted-bare"))

    unnamed, bucket = F.coalesce(program, F.lit("")) == "", [faculty, program]
    named = df.where(F.col("accepted") & ~unnamed)
    sizes = named.groupBy(*bucket).agg(F.count("*").alias("n"), F.min(F.lower(source)).alias("src"))
    # kept, so that the joins know how few buckets there are
    may = kept(sizes.where((F.col("n") <= TINY) | (F.col("src") == ANY_SIZE)).select(*bucket), "demoted-sizes")
    same = lambda other: F.col(f"d.{faculty}").eqNullSafe(other[faculty]) & (F.col(f"d.{program}") == other[program])
    why = bucket_reasons(named.alias("d").join(may, same(may), "left_semi"), source, faculty, program).where("reason IS NOT NULL").select(*bucket, "reason")
    why = kept(why, "demoted-buckets")
    bad = F.col("accepted") & (unnamed | F.col("reason").isNotNull())
    found = df.alias("d").join(why, same(why), "left").select("d.*", "reason")
    return found.withColumns(add(bad, "bad_program_label")).drop("reason")


def without_dropped(review: DataFrame, subject: str = "subject", evidence: tuple[str, ...] = ("lesson_type", "notes", "raw_excerpt")) -> DataFrame:
    """Review rows that may hold a class: neither a service subject, nor no subject and service text elsewhere.

    Every distinct text is judged once; null says that it holds nothing.
    """
    wide, marks = review, {}
    for c in dict.fromkeys((subject, *evidence)):
        marks[c] = f"__drop{len(marks)}"
        judged = let(service_tokens(F.col("t")), lambda t: F.when(t != "", seg.is_drop_review(t)))
        wide = wide.join(_facts(review, c, {marks[c]: judged}), F.coalesce(F.col(c), F.lit("")) == F.col("__x")).drop("__x")
    elsewhere = F.exists(F.array(*[F.coalesce(marks[c], F.lit(False)) for c in evidence]), lambda x: x) if evidence else F.lit(False)
    return wide.where(~F.coalesce(marks[subject], elsewhere)).select(*review.columns)


def audit(rows: DataFrame, file: str, sheet: str) -> DataFrame:
    """Per file: rows, issues by name and status, from per-sheet counters; subjects are classified once a distinct text."""
    needed = list(dict.fromkeys([file, sheet, "subject", "teacher", "week_type", "day", "start_time", "end_time"]))
    rows, x = kept(rows.select(needed), "audit-rows"), F.col("t")
    has = x != ""
    facts = {"s_room": has & classify.is_room(x), "s_teacher": has & classify.is_teacher(x), "s_link": has & classify.has_link(x), "s_admin": has & classify.is_admin(x),
             "s_garbage": has & classify.is_garbage(x)}
    # kept, so that the join knows how few texts there are and need not shuffle the rows by subject
    known = kept(_facts(rows, "subject", facts), "audit-facts")
    rows = rows.join(known, F.coalesce("subject", F.lit("")) == F.col("__x")).drop("__x")
    s, t = F.trim("subject"), F.trim("teacher")
    issues = {
        "missing_week_type": F.trim("week_type") == "",
        "missing_required_cells": (F.trim("day") == "") | (F.trim("start_time") == "") | (F.trim("end_time") == "") | (s == ""),
        "subject_contains_room": F.col("s_room"),
        "subject_contains_teacher": F.col("s_teacher"),
        "subject_contains_link": F.col("s_link"),
        "service_text_subject": F.col("s_admin"),
        "garbage_text": F.col("s_garbage"),
        "subject_too_long": F.length(s) > 140,
        "teacher_too_long": F.length(t) > 180,
        "implausible_time": times.implausible(F.col("start_time"), F.col("end_time"), s),
    }
    sheets = rows.groupBy(file, sheet).agg(F.count("*").alias("n"), *[F.count_if(c).alias(n) for n, c in issues.items()])
    found = F.filter(F.array(*[F.when(F.col(n) > 0, F.lit(n)) for n in issues]), lambda x: x.isNotNull())
    files = sheets.withColumn("__names", found).groupBy(file).agg(
        F.sum("n").alias("row_count"), F.count("*").alias("sheets"), F.sum(F.size("__names")).cast("long").alias("issue_count"),
        F.sum("missing_required_cells").alias("missing_required_cells"))
    status = F.when((F.col("missing_required_cells") > 0) | (F.col("row_count") == 0), "fail").when(F.col("issue_count") > 0, "warning").otherwise("pass")
    return files.withColumn("status", status)
