"""Column functions for cells of split-cell grids: what a cell is, and the entries that one subject cell holds."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions import classify, times
from tabulon.functions.text import flat, header_key, let, rx, service_tokens

# Lesson marks in brackets, and the patterns that tell cells apart.
LESSON_MARKS = {
    "л": "лекція", "лек": "лекція", "лекція": "лекція", "лаб": "лабораторне заняття", "лабораторна": "лабораторне заняття",
    "лабораторне": "лабораторне заняття", "пр": "практичне заняття", "практ": "практичне заняття", "практична": "практичне заняття",
    "практичне": "практичне заняття", "практика": "практика", "сем": "семінар", "с": "семінар", "c": "семінар", "семінар": "семінар", "lec": "лекція",
}
SUBJECT_MARKS = ("(", "лаб", "лек", "пр", "сем", "основи", "архітект", "матем", "комп", "кібер", "інозем")
ROOM = r"(ауд(?:\.|\b)|корпус|корп(?:\.|\b)|клінік|лаборатор|каб(?:\.|\b)|online|онлайн)"
LINK = (r"(https?://|zoom|meet|teams|microsoft|google meet|knu-ua\.zoom|meeting\s*id|passcode|pwd=|id:\s*\d|код(?:[:\s]|\s+доступу))")
WEEK = r"(\[[^\]]+\]|\bч/т\b|\bпо\s+\d{2}\.\d{2}\b|\bз\s+\d{2}\.\d{2}\b|\b(?:i|ii|1|2)\s*тиж)"
WEEK_MARKS = ((r"\bч/т\b", "Через тиждень"), (r"\b(?:i|1)\s*тиж", "Верхній"), (r"\b(?:ii|2)\s*тиж", "Нижній"), (r"\bверх", "Верхній"), (r"\bниж", "Нижній"),
              (r"\bнепар", "Верхній"), (r"\bпарн", "Нижній"))
NAMED = r"[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\.?"
DATES = r"\[\d{2}\.\d{2}(?:\s*,\s*\d{2}\.\d{2})*\]"
TWO_DATED = (rf"^(.+?)\s+({DATES})\s*\(([A-Za-zА-ЯІЇЄҐа-яіїєґ]{{1,6}})\)\s+({DATES})\s+(.+?)\s*\(([A-Za-zА-ЯІЇЄҐа-яіїєґ]{{1,6}})\)$")
TRAILING_WEEKS = r"\s*(\[[^\]]+\])+\s*$"
TRAILING_TEACHER = r"^(.+?)\s+((?:(?:проф|доц|ас|ст\.викл|викл)\.?\s+)?[А-ЯІЇЄҐ][А-ЯІЇЄҐа-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\.?)$"
ROOM_SUFFIX = r"^(.+?)\s+((?:\d{1,4}[A-Za-zА-ЯІЇЄҐ]?\s*ауд\.?|ауд\.?\s*\d{1,4}[A-Za-zА-ЯІЇЄҐ]?))$"
ROOM_NUMBER = r"^(?:ауд\.?\s*(\d{1,4}[A-Za-zА-ЯІЇЄҐ]?)|(\d{1,4}[A-Za-zА-ЯІЇЄҐ]?)\s*ауд\.?)$"
WEEK_COUNT = r"\b(\d+)\s*т\b"
NOISE_WORDS = ("ст", "ас", "доц", "проф", "викл")


def trimmed(x: Column, signs: str) -> Column:
    return F.btrim(x, F.lit(signs))


def unique(xs: Column) -> Column:
    """Flattened, filled, distinct texts in their order."""
    return F.array_distinct(F.filter(F.transform(xs, flat), lambda x: x != ""))


def has_subject_mark(x: Column) -> Column:
    return let(F.lower(x), lambda low: F.greatest(*[F.contains(low, F.lit(m)) for m in SUBJECT_MARKS]))


def is_noise(x: Column) -> Column:
    """Bits of titles, codes and passwords."""
    code = lambda solid: solid.rlike(r"^[A-Za-z0-9._=+-]{6,}$") & ((solid.rlike(r"\d") & solid.rlike("[A-Za-z]")) | F.lower(solid).rlike("^(?:pwd|id)"))
    product = lambda solid: solid.startswith(".") & F.contains(F.lower(solid), F.lit("microsoft"))
    return let(flat(x), lambda t: (t == "") | ((F.length(t) <= 3) & t.endswith(".")) | header_key(t).isin(*NOISE_WORDS)
               | let(F.replace(t, F.lit(" "), F.lit("")), lambda solid: product(solid) | code(solid)))


def is_room(x: Column) -> Column:
    return x.rlike(rx(ROOM))


def names_teacher_behind_subject(x: Column) -> Column:
    """A subject of eight characters or more with a teacher's name behind it in one cell."""
    ahead = lambda t: trimmed(F.regexp_extract(t, rx(f"^(.*?){NAMED}"), 1), " ,;/")
    fits = lambda a: ((F.length(a) >= 8) & (times.parse_range(a)["start"] == "") & ~classify.is_roomish_subject(a) & ~(is_room(a) & ~has_subject_mark(a)) & ~is_noise(a)
                      & (has_subject_mark(a) | F.contains(a, F.lit(" "))))
    return let(flat(x), lambda t: classify.is_teacher(t) & let(ahead(t), fits))


def kind(x: Column) -> Column:
    """subject, teacher, room, link, week or ignore."""
    day = lambda t: times.weekday(t).isin(*dict.fromkeys(times.WEEKDAYS.values()))
    return let(flat(x), lambda t: (
        F.when((t == "") | t.rlike(r"^\d+(?:\.0)?$") | header_key(t).isin("день", "час") | day(t) | (times.parse_range(t)["start"] != ""), "ignore")
        .when(t.rlike(rx(LINK)), "link").when(classify.is_roomish_subject(t) | (is_room(t) & ~names_teacher_behind_subject(t) & ~has_subject_mark(t)), "room")
        .when(classify.is_teacher(t), F.when(names_teacher_behind_subject(t), "subject").otherwise("teacher")).when(t.rlike(rx(WEEK)) & ~has_subject_mark(t), "week")
        .when(is_noise(t) | ~t.rlike(r"\p{L}"), "ignore").otherwise("subject")))


def may_be_split_off(x: Column) -> Column:
    """A text that may be one of two subjects of a cell: two words and twelve characters at least, no teacher, room or noise."""
    words = lambda t: F.size(F.regexp_extract_all(t, F.lit("[A-Za-zА-ЯІЇЄҐа-яіїєґ]{2,}"), F.lit(0)))
    return let(trimmed(service_tokens(x), " ,;/"), lambda t: (F.length(t) >= 12) & ~classify.is_teacher(t) & ~classify.is_roomish_subject(t) & ~(is_room(t) & ~has_subject_mark(t))
               & ~is_noise(t) & (words(t) >= 2))


def _two_entries(t: Column) -> Column:
    """The two entries of a text of two dated subjects of one kind, else the text alone."""
    part = lambda k: F.regexp_extract(t, rx(TWO_DATED), k)
    parts = F.struct(*[trimmed(service_tokens(part(k)), " ,;/").alias(f"s{k}") for k in (1, 5)], *[F.lower(service_tokens(part(k))).alias(f"m{k}") for k in (3, 6)],
                     trimmed(service_tokens(part(3)), " .,:;").alias("mark"), part(2).alias("d1"), part(4).alias("d5"))
    one = lambda p, k: F.concat(p[f"s{k}"], F.lit(" ("), p["mark"], F.lit(") "), p[f"d{k}"])
    return let(parts, lambda p: F.when(t.rlike(rx(TWO_DATED)) & (p["m3"] == p["m6"]) & may_be_split_off(p["s1"]) & may_be_split_off(p["s5"]),
                                       F.array(one(p, 1), one(p, 5))).otherwise(F.array(t)))


def dated_entries(x: Column) -> Column:
    """One text for every subject of a cell: two where two dated subjects share it, each with its date and their mark."""
    return let(service_tokens(x), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(_two_entries(t)))


def _without(t: Column, pattern: str) -> Column:
    """A text without every match of a pattern, trimmed if there was one."""
    return F.when(t.rlike(pattern), F.trim(F.regexp_replace(t, pattern, ""))).otherwise(t)


def marked(x: Column) -> Column:
    """struct(subject, lesson_type, notes): trailing weeks, lesson mark and count of weeks taken out; subject '' if nothing is left."""
    mark = r"\(([^()]{1,12})\)"
    names = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in LESSON_MARKS.items()))
    lesson = lambda m: F.coalesce(F.element_at(names, F.regexp_replace(F.lower(F.trim(m)), r"\.+$", "")), F.trim(m))
    left = lambda t: F.when(t.rlike(mark), F.trim(F.replace(t, F.regexp_extract(t, mark, 0), F.lit("")))).otherwise(t)
    tidy = lambda t, kind: F.when(kind != "", trimmed(F.regexp_replace(t, r"(?U)\s{2,}", " "), " -/;")).otherwise(t)
    done = lambda t: F.when(is_noise(t) | classify.is_roomish_subject(t), "").otherwise(t)
    found = lambda whole, t, kind: let(left(t), lambda s: F.struct(
        let(tidy(_without(s, rx(WEEK_COUNT)), kind), done).alias("subject"), kind.alias("lesson_type"),
        unique(F.array(F.regexp_extract(whole, TRAILING_WEEKS, 1), F.when(s.rlike(rx(WEEK_COUNT)), F.concat(F.lit("T="), F.regexp_extract(s, rx(WEEK_COUNT), 1))))).alias("notes")))
    return let(flat(x), lambda whole: let(_without(whole, TRAILING_WEEKS), lambda t: let(lesson(F.regexp_extract(t, mark, 1)), lambda kind: found(whole, t, kind))))


def room_number(x: Column) -> Column:
    """``307 ауд.`` and ``ауд 307`` as ``ауд. 307``."""
    number = lambda t: F.concat(F.regexp_extract(t, rx(ROOM_NUMBER), 1), F.regexp_extract(t, rx(ROOM_NUMBER), 2))
    return let(trimmed(service_tokens(x), " ."), lambda t: F.when(t.rlike(rx(ROOM_NUMBER)), F.concat(F.lit("ауд. "), number(t))).otherwise(t))


def inline(x: Column) -> Column:
    """struct(subject, notes, teacher, room): dates, a teacher and a room that stand inside a subject; it stays whole if under four characters were left."""
    part = lambda t, pattern, k: trimmed(service_tokens(F.regexp_extract(t, rx(pattern), k)), " ,;/")
    none = F.array().cast("array<string>")

    def found(whole: Column, t: Column) -> Column:
        ahead = F.when(t.rlike(rx(TRAILING_TEACHER)), part(t, TRAILING_TEACHER, 1)).otherwise(t)
        inner = lambda u: let(trimmed(service_tokens(F.when(u.rlike(rx(ROOM_SUFFIX)), part(u, ROOM_SUFFIX, 1)).otherwise(u)), " ,;/.-"), lambda s: F.when(
            (F.length(s) < 4) | ~s.rlike(r"\p{L}"), F.struct(whole.alias("subject"), none.alias("notes"), F.lit("").alias("teacher"), F.lit("").alias("room"))).otherwise(F.struct(
                s.alias("subject"), unique(F.regexp_extract_all(whole, F.lit(DATES), F.lit(0))).alias("notes"), part(t, TRAILING_TEACHER, 2).alias("teacher"),
                F.when(u.rlike(rx(ROOM_SUFFIX)), room_number(F.regexp_extract(u, rx(ROOM_SUFFIX), 2))).otherwise("").alias("room"))))
        return let(ahead, inner)

    return let(flat(x), lambda whole: let(service_tokens(F.regexp_replace(whole, DATES, " ")), lambda t: found(whole, t)))


def bracketed(x: Column) -> Column:
    """struct(text, notes): bracketed notes taken out of a teacher's cell."""
    return F.struct(F.trim(F.regexp_replace(x, r"\[[^\]]+\]", "")).alias("text"), unique(F.regexp_extract_all(x, F.lit(r"\[[^\]]+\]"), F.lit(0))).alias("notes"))


def teacher_key(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(service_tokens(x)), rx(r"^(?:проф|доц|ас|ст\.викл|викл)\.?\s+"), ""), r"(?U)[\W_]+", "")


def with_teacher(first: Column, second: Column) -> Column:
    """Both teachers, or the first alone where they are one person."""
    both = lambda a, b: F.when(a == "", b).when((b == "") | (teacher_key(a) == teacher_key(b)), a).otherwise(F.array_join(unique(F.array(a, b)), "; "))
    return let(service_tokens(first), lambda a: let(service_tokens(second), lambda b: both(a, b)))


def week_type(candidates: Column) -> Column:
    """The week kind that the first of the texts names, '' if none does."""
    of = lambda t: F.coalesce(*[F.when(t.rlike(rx(p)), F.lit(v)) for p, v in WEEK_MARKS], F.lit(""))
    return F.coalesce(F.get(F.filter(F.transform(candidates, lambda t: let(flat(t), of)), lambda v: v != ""), F.lit(0)), F.lit(""))
