"""Program labels: what is none, and the clean form of what is one.

Rules look at a label many times, so ``judged`` works them out once for every distinct label, in stages, and ``with_label`` joins them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions import classify
from tabulon.functions import segments as seg
from tabulon.functions.text import behind_first, compact, flat, rx, service_tokens
from tabulon.sources.scratch import kept

# Whole labels that name no program.
BAD_LABELS = (
    r"розклад\b.*", r"rozklad\b.*", r"schedule(?:\s+of\s+classes)?", r"schedule\s+of\s+classes\b.*", r"[a-z]+(?:[-_\s]+[a-z]+)*[-_\s]+schedule",
    r"timetable\b.*", r"uploads", r"upload", r"wp[-_\s]*content", r"spreadsheets?", r"files?", r"schedule", r"sociology\s+schedule",
    r"«?\s*затверджую\s*»?", r"розклад(?:\s+занять)?", r"(?:денна|заочна)\s+форма\s+навчання", r"\d+\s*пара\b.*(?:\d{1,2}[:.]\d{2})",
    r"(?:[ivx]+|\d+)\s+група", r"[12]\s*підгр\.?", r"\d+\s*курс\b.*", r"\d+\s*магістр\w*.*", r"\d+\s*бакалавр\w*.*", r"\d{4}\s+\d{4}\s+\d+\s*sem\b.*",
    r"\d+\s*sem\.?(?:\s+\d.*)?", r"\d+\s*[кk]\s*\d+\s*[сc]\s*(?:\d{2}(?:\s*[-–—]?\s*\d{2})?)?", r"\d+\s*[сc]\s*(?:\d{2}(?:\s*[-–—]?\s*\d{2})?)?",
    r"\d+\s*(?:mag|маг)\b.*(?:\d{2}\s*\d{2})?", r"(?:\d{2}\.\d{2}(?:\s*[-–—]\s*\d{2}\.\d{2})?\s+){1,2}.+", r"факультету\s+.+",
    r"(?:\d+\s+){1,3}[A-Za-z0-9+/=_-]{6,}", r"начитка!?", r"настановча(?:\s+сесія)?(?:\s+\d.*)?", r"постійний(?:\s+розклад)?!?", r"постійне!?",
    r"списки?\s+груп", r"початок\s+занять.*", r"навчання\s+з\s+використанням.*", r"увага[!.\s].*", r"nachytka\b.*", r"завантажити", r"рік\s+навчання",
    r"\d+\s+рік\s+навчання", r"\d{4}\s+навчальний\s+рік", r"\d+\s*[-–— ]\s*\d+\s*(?:курс(?:и)?|маг)\s*", r"r\.?\s*n\.?\s+or\s+mahistr\b.*",
    r"розкд[аa]д\s+занять\b.*", r"\d+\s+kurs\s+os\s+bakalavr\b.*", r"[а-яіїєґ'’ʼ-]+\s+факультету", r"інституту\s+журналістики.*",
    r"dr\.?\s+[A-ZА-ЯІЇЄҐ].*", r"(?:асп|доц|проф|асист|викл)\.?\s*[A-ZА-ЯІЇЄҐ].*", r"[ivxlcdm]+\s*потік\b.*", r"практ\.?\s+.*", r"чл\.-?кор\.?\s+.*",
    r"[A-Za-z]", r"english", r"english\s+\d+\s*c", r"англ\.?\s*мова", r"настановча\s+бак\d{2}(?:\s*[-–—]?\s*\d{2})?", r"кластер\s*\d+\s*(?:\([сc]\))?",
    r"(?:\d+\s*[а-яіїєґa-z]\s*[. ]*){2,}(?:\s*[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.?\s*[А-ЯІЇЄҐ]\.?)?", r"[лпс]-\d+\s*год\.?",
)
BAD_LABEL_CASED = r"[А-ЯІЇЄҐA-Z\s'’ʼ-]{8,}\s*\([ЛПРСC]\)"
BAD_COMPACT = (
    "розклад", "розкладзанять", "rozklad", "деннаформанавчання", "заочнаформанавчання", "затверджую", "wpcontent", "spreadsheets", "spreadsheet",
    "upload", "uploads", "files", "file", "спискигруп", "начитка", "постійний", "постійне",
)
LONG_MARKS = ("розклад", "начитк", "постійн", "тимчасов", "увага", "навчання з використанням")
ALIASES = {
    "генетичнии аналіз": "Генетичний аналіз",
    "доклінічнии аналіз продуктів біотехнологіі": "Доклінічний аналіз продуктів біотехнології",
    "планування та озеленення": "Планування та озеленення",
    "r.n. or mahistr pravo": "Право",
    "r.n. or mahistr iv": "Інтелектуальна власність",
    "r.n. or mahistr zdnu": "ЗДНУ",
}
LAW = {"pravo": "Право", "iv": "Інтелектуальна власність", "zdnu": "ЗДНУ"}
LAW_LABEL = r"^(?:\d+\s*)?r\.?\s*n\.?\s+or\s+mahistr\s+(iv|pravo|zdnu)\b"
#: What a program's name stands in: the pattern, and whether it must be the whole label.
WRAPPED = (
    r"\bосвітн(?:я|і)\s+програм(?:а|и)\s+\"([^\"]{3,120})\"?",
    r"\bосвітн(?:я|і)\s+програм(?:а|и)\s+([^,;]{3,120}?)\s+\bОС\b",
    r"^\d+\s*[-–— ]\s*\d+\s*курси?\s*\(([^)]+)\)$",
    r"^(.+?)\s+\d+\s*курс\s*[_\"“”']*(?:магістр|бакалавр)[_\"“”']*$",
)
DATED = r"^(?:\d{1,2}\.\d{1,2}(?:\.\d{2,4})?(?:\s*[-–—]\s*\d{1,2}\.\d{1,2}(?:\.\d{2,4})?)?\s+){1,3}(.+)$"
EDGE = r"^[ .,:;-]+|[ .,:;-]+$"
CONJUNCTIONS = ("та", "і", "й", "and")


def parts(t: Column) -> Column:
    """The parts of a label between semicolons, without edge signs; empty ones are left out."""
    return F.filter(F.transform(F.split(t, r"\s*;\s*"), lambda s: F.regexp_replace(F.trim(s), EDGE, "")), lambda s: s != "")


def is_technical_part(s: Column) -> Column:
    return (seg.whole(s, seg.W_DATE_TIME, seg.W_MEETING_CODE) | seg.is_opaque_code(s) | F.lower(s).isin(".com", "com") | classify.is_room(s)
            | classify.is_urlish(s) | classify.is_technical(s))


def is_meaningful_part(s: Column) -> Column:
    letters = F.regexp_extract_all(s, F.lit(r"([A-Za-zА-ЯІЇЄҐа-яіїєґ'’ʼ-]{3,})"), F.lit(1))
    return ~is_technical_part(s) & (F.length(F.array_join(letters, "")) >= 6) & ~classify.is_admin(s)


def has_technical_parts(p: Column) -> Column:
    """Two or more parts of which technical ones leave nothing, or one, that means something."""
    technical, meaningful = F.size(F.filter(p, is_technical_part)), F.size(F.filter(p, is_meaningful_part))
    return (F.size(p) >= 2) & (technical > 0) & ((meaningful == 0) | (technical >= F.size(p) - 1))


def is_no_program_part(s: Column) -> Column:
    return (seg.whole(s, seg.W_DATE_TIME, seg.W_NUMBERED_GROUP) | F.lower(s).isin(".com", "com") | classify.is_room(s) | classify.is_roomish_subject(s)
            | seg.is_room_fragment(s) | classify.is_forbidden_subject(s) | seg.is_any_teacher(s))


def is_no_program_combination(p: Column) -> Column:
    return (F.size(p) >= 2) & F.forall(p, is_no_program_part)


def has_dangling_conjunction(p: Column) -> Column:
    return F.exists(p, lambda s: F.lower(s).rlike("(?:^| )(?:" + "|".join(CONJUNCTIONS) + ")$"))


def has_lower_continuation(p: Column) -> Column:
    return (F.size(p) >= 2) & F.exists(behind_first(p), seg.lead_lower)


def is_group_aggregate(p: Column) -> Column:
    many = lambda *patterns: F.size(F.filter(p, lambda s: seg.somewhere(s, *patterns)))
    groups, streams = many(r"\bгрупа\b"), many(r"\b(?:[ivxlcdm]+|\d+)\s*потік\b")
    academic, numbers = many(r"\b(?:акад\w*|к[-\s]*ад\w*)\b"), many(r"^\d+$")
    return (groups >= 2) | ((streams >= 1) & (groups >= 1)) | ((academic >= 1) & ((numbers >= 1) | (F.size(p) >= 2)))


def _bad(t: Column, p: Column, clean: Column) -> Column:
    """Bad by what the label (service tokens ``t``, parts ``p``) shows; names, rooms and forbidden words count only if they stay in its ``clean`` form."""
    solid, bare = compact(t), F.regexp_replace(clean, r"^[ .,:;-]+", "")
    one_word = ~F.contains(t, F.lit(" "))
    count = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    coded = t.rlike(r"\d") | t.rlike("[-+/=_;:]") | (t.rlike("[A-Z].*[A-Z]") & t.rlike("[a-z]"))
    return (
        (one_word & (F.length(t) >= 8) & t.rlike(r"\d") & t.rlike(r"\p{L}")) | (one_word & classify.is_storage_id(t)) | classify.is_urlish(t)
        | classify.is_technical(t) | (count('"') % 2 == 1) | (count("«") != count("»")) | classify.is_admin(t)
        | ((F.length(t) >= 20) & seg.holds(t, LONG_MARKS)) | seg.is_month_only(t) | seg.is_date_week(t) | (seg.program_codes(t) >= 2)
        | seg.somewhere(t, r"\b\d{3}\s+\d{3}\s+\d{4}\b", r"\b(?:ауд|корп)\.?\b") | has_dangling_conjunction(p) | has_lower_continuation(p)
        | is_group_aggregate(p) | seg.is_any_teacher(bare) | classify.is_forbidden_subject(bare) | is_no_program_combination(p)
        | seg.whole(t, seg.W_NUMBERED_GROUP) | seg.is_opaque_code(t) | has_technical_parts(p) | (classify.is_garbage(t) & coded & ~seg.is_cohort(t))
        | seg.is_room_fragment(bare) | classify.is_room(t) | classify.is_roomish_subject(t) | seg.whole(t, *BAD_LABELS) | seg.cased(t, BAD_LABEL_CASED)
        | solid.isin(*BAD_COMPACT) | (solid.startswith("розклад") & (F.length(t) <= 24)))


def _plain(x: Column) -> Column:
    """A label without quotes of other kinds, degrees, and words that only surround it."""
    t = F.regexp_replace(F.translate(service_tokens(x), "_", " "), EDGE, "")
    t = F.translate(t, "“”«»", '\"\"\"\"')
    t = F.regexp_replace(F.regexp_replace(t, rx(r"\bдоставити\b"), " "), rx(r"\(\s*укр\s*\)"), " ")
    t = F.regexp_replace(F.regexp_replace(t, rx(r"\bОП\s*\"([^\"]+)\""), "$1"), rx(r"\bОП\s+([^,;]+)"), "$1")
    t = F.regexp_replace(F.regexp_replace(t, rx(r"\bОС\s*\"?(?:бакалавр|магістр)\"?"), " "), rx(r"\s+\b(?:бакалавр|магістр)\b$"), " ")
    return F.regexp_replace(service_tokens(F.regexp_replace(t, r"\s*,\s*,+", ", ")), r"^[ .,:;\"'-]+|[ .,:;\"'-]+$", "")


def _unwrapped(t: Column, tail_is_bad: Column) -> Column:
    """The name inside the first wrapping that fits, else the label."""
    law = F.regexp_extract(t, rx(LAW_LABEL), 1)
    found = F.when(law != "", F.element_at(F.create_map(*[F.lit(x) for kv in LAW.items() for x in kv]), F.lower(law)))
    for pattern in WRAPPED:
        inner = F.regexp_extract(t, rx(pattern), 1)
        found = found.when(inner != "", inner)
    tail = F.regexp_replace(service_tokens(F.regexp_extract(t, rx(DATED), 1)), EDGE, "")
    return found.when((tail != "") & ~tail_is_bad, tail).otherwise(t)


def _named(p: Column) -> Column:
    """What is left of a label's parts when those that name no program go, joined."""
    bare = F.transform(p, lambda s: F.regexp_replace(F.regexp_replace(s, r"^[. ]+", ""), r"^[ ,]+|[ ,]+$", ""))
    kept = F.filter(bare, lambda s: (s != "") & ~(seg.whole(s, seg.W_DATE_TIME) | F.lower(s).isin(".com", "com") | classify.is_room(s)
                    | classify.is_roomish_subject(s) | seg.is_room_fragment(s) | classify.is_forbidden_subject(s) | seg.is_any_teacher(s)
                    | classify.is_technical(s) | classify.is_urlish(s)))
    joined = F.array_join(kept, " ; ")
    known = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    return F.coalesce(F.element_at(known, F.lower(joined)), joined)


def judged(labels: DataFrame) -> DataFrame:
    """(label, candidate, bad) of every distinct label in the one column of ``labels``: its clean form ('' if nothing is left); null reads as ''."""
    each = labels.toDF("l").select(F.coalesce("l", F.lit("")).alias("l")).distinct().withColumn("t", service_tokens(F.col("l")))
    each = each.withColumn("p", parts(F.col("t"))).withColumn("c", _plain(F.col("l")))
    while True:  # wrappings may hold each other: until no label changes
        tail = F.regexp_replace(service_tokens(F.regexp_extract("c", rx(DATED), 1)), EDGE, "")
        each = each.withColumn("tail", tail).withColumn("tail_bad", _bad(F.col("tail"), parts(F.col("tail")), F.col("tail")))
        each = kept(each.withColumn("inner", _plain(_unwrapped(F.col("c"), F.col("tail_bad")))), "labels-unwrapped")
        done = each.where("inner <> c").isEmpty()
        each = each.withColumn("c", F.col("inner"))
        if done:
            break
    each = each.withColumn("cp", parts(F.col("c"))).withColumn("candidate", _named(F.col("cp")))
    each = each.withColumn("bad", (F.col("t") != "") & ((F.col("candidate") == "") | _bad(F.col("t"), F.col("p"), F.col("candidate"))))
    return each.select(F.col("l").alias("label"), "candidate", "bad")


def with_label(df: DataFrame, label: str, names: DataFrame, prefix: str = "program") -> DataFrame:
    """``df`` plus ``<prefix>_candidate`` and ``<prefix>_bad`` of a column, from ``judged`` labels."""
    of = names.select(F.col("label").alias("__l"), F.col("candidate").alias(f"{prefix}_candidate"), F.col("bad").alias(f"{prefix}_bad"))
    return df.join(of, F.coalesce(F.col(label), F.lit("")) == F.col("__l")).drop("__l")


def labelled(df: DataFrame, label: str, prefix: str = "program") -> DataFrame:
    """``df`` plus the clean form of its labels and whether they are bad."""
    return with_label(df, label, judged(df.select(label)), prefix)


def is_label(candidate: Column, bad: Column) -> Column:
    """Whether a worked-out candidate may stand as a program label."""
    return (candidate != "") & ~bad & classify.is_meaningful_label(candidate)


def humanized(name: Column) -> Column:
    """A source's name as a title: ``fit-schedule`` -> ``Fit Schedule``."""
    return F.initcap(flat(F.translate(name, "_-", "  ")))
