"""Column functions that clean one field of a record: groups, teachers, rooms, and what a subject cell holds besides the subject."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions import classify, programs
from tabulon.functions import segments as seg
from tabulon.functions.text import behind_first, rx, service_tokens, without_zero_fraction

# Lesson marks and what they stand for; patterns with the parts they give.
LESSON_MARKS = {
    "лекція": ("л", "лек", "лекція", "лекц", "лекції", "lek", "lecture", "lec"),
    "практичне заняття": ("пр", "практ", "практична", "практичне", "практичні", "prac", "practical"),
    "лабораторне заняття": ("лаб", "лабораторна", "лабораторне", "лабораторні", "lab"),
    "семінар": ("сем", "семінар", "семінари", "с", "c", "sem", "seminar"),
}
LEADING_LESSON = (r"^(?:[\[(]?\s*)?(л|л\.|лек|лек\.|лекц|лекц\.|лекції|лекція|lek|lek\.|lec|lec\.|lecture|пр|пр\.|практ|практ\.|практична|практичне|практичні|prac|prac\.|practical"
                  r"|лаб|лаб\.|лабораторна|лабораторне|лабораторні|lab|lab\.|сем|сем\.|семінар|семінари|с|c|sem|sem\.|seminar)\s*[\])\].,:-]+\s*(.+)$")
TRAILING_ROOM = r"^(.+?)(?:\s*/\s*|\s+)(\d{3,4}[А-ЯІЇЄҐA-Z]?|[А-ЯІЇЄҐA-Z]-?\d{2,4}|(?:хімічний|географічний)\s+ф-?т\s+\d{2,4})$"
TRAILING_TEACHER = (r"^(.+?)\s*[.;,]?\s*((?:(?:проф|доц|ас|асист|викл|dr|prof)\.?\s+)?[А-ЯІЇЄҐA-Z][А-ЯІЇЄҐA-Zа-яіїєґa-z'’ʼ-]+"
                    r"(?:\s+[А-ЯІЇЄҐA-Z]\.(?:\s*[А-ЯІЇЄҐA-Z]\.?)?|\s+[А-ЯІЇЄҐA-Z]\.?\s+[А-ЯІЇЄҐA-Z]\.?))$")
TRAILING_INITIAL = r"^(.+?)\s*[.;,]?\s*([А-ЯІЇЄҐA-Z]\.\s*[А-ЯІЇЄҐA-Z][А-ЯІЇЄҐа-яіїєґa-z'’ʼ-]+)$"
LEADING_TEACHER = r"^(?:(?:проф|доц|ас|викл)\.?\s+)?[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\.?$"
TIME_NOTE = r"^(.+?)\s+(на\s+\d{1,2}[:.]\d{2})$"
PREFIXES = (
    r"^((?:лекц(?:ії|ія|\.|)|лек(?:ція|\.|)|практ(?:ичні|ична|\.|)|лаб(?:ораторні|ораторна|\.|))?\s*початок\s+о\s+\d{1,2}[:.]\d{2})\s+(.+)$",
    r"^(\d{1,2}[:.]\d{2})\s+(.+)$",
    r"^(\d{1,2}\.\d{1,2}\.\d{2,4}\s+\d{1,2}[:.]\d{2})\s+(.+)$",
    r"^(\d{1,2}\.\d{1,2}\.?(?:\s+модул\w*\.?)?)\s+(.+)$",
    r"^((?:\d{1,2}(?:\.\d{1,2}(?:\.\d{2,4})?)?)(?:\s*,\s*\d{1,2}(?:\.\d{1,2}(?:\.\d{2,4})?)?)+(?:\s+[а-яіїєґ]+(?:\s+\d{4})?)?)\s+(.+)$",
    r"^(\d{1,2}\.\d{1,2}\s*,\s*[^-]{3,80}-)\s*(.+)$",
)
ELECTIVES = (r"^курс\s+за\s+вибором\s*:?\s*(.+)$", r"^дисципліни\s+вільного\s+вибору(?:\s+студента)?\s*:?\s*(.+)$")
ELECTIVE_TAIL = r"\s*(?:\+\s*\d+\s*пари?|;\s*\d+.*)$"
COURSE = r"\b(\d{1,2})\s*курс\s*[_\"“”']*(магістр|бакалавр|маг)?"
GROUP_SIGNALS = (r"^оп\s+(.+)$", r"^освітні?\s+програми?\s*[\":«]?\s*(.+?)\s*[»\"]?$", r"^спеціальність\s*[\":«]?\s*(.+?)\s*[»\"]?$")
QUOTED = r"[«\"]([^»\"]{3,})[»\"]"
COMPACT_NAME = r"^([А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+)([А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\.?)$"
W_TITLE = r"проф|доц|ас|асист|викл|ст\.?\s*викл|phd|к\.\s*[юф]\.\s*н|д\.\s*[юф]\.\s*н"
PROGRAM_HINT = r"(?:0\d{2}|1\d{2}|E\d)\s+.+"
HANGING = r" (?:та|і|й|з|до|по)$"
CONTINUATION = r"[А-ЯІЇЄҐа-яіїєґ][А-ЯІЇЄҐа-яіїєґ'’\-\s]{2,}"
LABEL_NAMES = {
    "начитка!": "Начитка", "начитка!!!": "Начитка", "начитка": "Начитка", "начітка": "Начитка", "постійний!!!": "Постійний", "постійний": "Постійний",
    "постіиний": "Постійний", "постіиниии": "Постійний", "постійне": "Постійне", "постійний розклад": "Постійний розклад", "постiйний розклад": "Постійний розклад",
    "генетичнии аналіз": "Генетичний аналіз", "доклінічнии аналіз продуктів біотехнологіі": "Доклінічний аналіз продуктів біотехнології",
}


def parts(t: Column) -> Column:
    """The parts of a cell between bars, semicolons and slashes."""
    return F.filter(F.transform(F.split(t, r"\s*[|;/]\s*"), service_tokens), lambda s: s != "")


def joined(xs: Column, sep: str = "; ") -> Column:
    return F.array_join(F.array_distinct(F.filter(xs, lambda s: s != "")), sep)


def _cut(t: Column, signs: str) -> Column:
    return F.regexp_replace(t, rf"^[{signs}]+|[{signs}]+$", "")


def room_name(s: Column) -> Column:
    """``214`` and ``214 ауд.`` -> ``ауд. 214``; named rooms and online ones stay."""
    t = F.regexp_replace(s, r"(?<=\d)\.0\b", "")
    hall, cabinet = (F.regexp_extract(t, rx(rf"^(\d{{1,4}}[A-Za-zА-ЯІЇЄҐ]?)\s*{w}\.?$"), 1) for w in ("ауд", "каб"))
    named = F.lower(t).rlike(r"^(?:ауд\.|каб\.|корп\.)") | F.lower(t).isin("online", "онлайн")
    return F.when(hall != "", F.concat(F.lit("ауд. "), hall)).when(cabinet != "", F.concat(F.lit("каб. "), cabinet)).when(named, t).otherwise(F.concat(F.lit("ауд. "), t))


def group_signal(s: Column) -> Column:
    """The group that a part names, without what surrounds it; '' for years, dates and head counts."""
    t = without_zero_fraction(_cut(s, r"\[\]{} "))
    found = F.when(t == "", F.lit(""))
    for pattern in (*GROUP_SIGNALS, QUOTED):
        inner = without_zero_fraction(service_tokens(_cut(F.regexp_extract(t, rx(pattern), 1), r"\[\]{} ")))
        found = found.when((inner != "") & ~seg.is_group_noise(inner), inner)
    return found.when(seg.whole(t, seg.W_STUDENT_COUNT, seg.W_YEAR) | seg.somewhere(t, seg.A_GROUP_DATE), F.lit("")).otherwise(t)


def group_field(t: Column) -> Column:
    """The groups of a cell (service tokens): explicit ones if there are any, else what is left without noise."""
    kept = F.filter(F.transform(parts(t), group_signal), lambda s: (s != "") & ~seg.is_group_noise(s))
    explicit = joined(F.filter(kept, seg.is_explicit_group))
    noisy = classify.has_link(t) | classify.is_service(t) | classify.is_admin(t) | seg.somewhere(t, seg.A_GROUP_DATE)
    rest = joined(kept)
    return F.when(explicit != "", explicit).when(noisy, F.lit("")).when(rest != "", rest).when(seg.is_group_noise(t), F.lit("")).otherwise(t)


def teacher_field(t: Column) -> Column:
    """Teachers of a cell: glued initials are parted, and a title that stands alone goes to the name behind it."""
    names = F.transform(parts(t), lambda s: F.regexp_replace(s, rx(COMPACT_NAME), "$1 $2"))
    start = F.struct(F.array().cast("array<string>").alias("found"), F.lit("").alias("title"))

    def add(state: Column, s: Column) -> Column:
        alone = seg.whole(s, rf"(?:{W_TITLE})\.?")
        titled = (state["title"] != "") & (seg.is_teacher_name(s) | classify.is_teacher(s))
        name = F.when(titled, F.concat(state["title"], F.lit(". "), s)).otherwise(s)
        return F.struct(F.when(alone, state["found"]).otherwise(F.concat(state["found"], F.array(name))).alias("found"),
                        F.when(alone, F.regexp_replace(s, r"\.+$", "")).otherwise(F.lit("")).alias("title"))

    return joined(F.aggregate(names, start, add)["found"])


def without_lesson_mark(t: Column) -> tuple[Column, Column]:
    """(subject, lesson kind): a lesson mark before the subject is taken off."""
    mark, rest = F.lower(F.regexp_extract(t, rx(LEADING_LESSON), 1)), _cut(F.regexp_extract(t, rx(LEADING_LESSON), 2), " ,;/-")
    bare = _cut(mark, " .,:;")
    kind = F.coalesce(*[F.when(bare.isin(*marks), F.lit(k)) for k, marks in LESSON_MARKS.items()], F.lit(""))
    taken = (kind != "") & (rest != "")
    return F.when(taken, rest).otherwise(t), F.when(taken, kind).otherwise(F.lit(""))


def without_room(t: Column) -> tuple[Column, Column]:
    """(subject, room): a room behind the subject is taken off."""
    room = F.regexp_extract(t, rx(TRAILING_ROOM), 2)
    return F.when(room != "", _cut(F.regexp_extract(t, rx(TRAILING_ROOM), 1), " /")).otherwise(t), F.when(room != "", room_name(room)).otherwise(F.lit(""))


def without_trailing_teacher(t: Column) -> tuple[Column, Column]:
    """(subject, teacher): a name with initials behind the subject is taken off."""
    named = F.regexp_extract(t, rx(TRAILING_TEACHER), 2) != ""
    at = lambda k: _cut(F.when(named, F.regexp_extract(t, rx(TRAILING_TEACHER), k)).otherwise(F.regexp_extract(t, "(?U)" + TRAILING_INITIAL, k)), " ,;/-")
    taken = (at(1) != "") & (at(2) != "")
    return F.when(taken, at(1)).otherwise(t), F.when(taken, at(2)).otherwise(F.lit(""))


def without_leading_teacher(t: Column) -> tuple[Column, Column]:
    """(subject, teacher): the first part of several, if it is a name, goes."""
    p = parts(t)
    first, rest = F.get(p, 0), F.array_join(F.array_distinct(behind_first(p)), " / ")
    taken = (F.size(p) >= 2) & seg.somewhere(first, LEADING_TEACHER) & (rest != "") & ~classify.is_room(rest) & ~classify.has_link(rest)
    return F.when(taken, rest).otherwise(t), F.when(taken, first).otherwise(F.lit(""))


def without_time_note(t: Column) -> tuple[Column, Column]:
    """(subject, note): ``на 9:30`` behind the subject is a note."""
    note = F.regexp_extract(t, rx(TIME_NOTE), 2)
    return F.when(note != "", _cut(F.regexp_extract(t, rx(TIME_NOTE), 1), " /,;")).otherwise(t), note


def without_prefix(t: Column) -> tuple[Column, Column]:
    """(subject, prefix): one date, time or event before the subject is taken off."""
    rest, prefix = F.lit(None).cast("string"), F.lit(None).cast("string")
    for p in PREFIXES:
        fits = t.rlike(rx(p))
        rest = F.coalesce(rest, F.when(fits, _cut(F.regexp_extract(t, rx(p), 2), " ,;")))
        prefix = F.coalesce(prefix, F.when(fits, _cut(F.regexp_extract(t, rx(p), 1), " ,;")))
    taken = F.coalesce(rest != "", F.lit(False))
    return F.when(taken, rest).otherwise(t), F.when(taken, prefix).otherwise(F.lit(""))


def without_prefixes(t: Column) -> tuple[Column, Column]:
    """(subject, array of prefixes): dates, times and events before the subject are taken off one after the other till none is left.

    Each takes a word at least, so as many steps as there are words are enough; texts that begin with none take no step.
    """
    def step(at: Column, _: Column) -> Column:
        subject, prefix = without_prefix(at["subject"])
        return F.struct(subject.alias("subject"), F.when(prefix == "", at["taken"]).otherwise(F.concat(at["taken"], F.array(prefix))).alias("taken"))

    begun = F.struct(t.alias("subject"), F.array().cast("array<string>").alias("taken"))
    some = F.greatest(*[t.rlike(rx(p)) for p in PREFIXES])
    words = F.when(some, F.sequence(F.lit(1), F.size(F.split(t, " ")))).otherwise(F.array().cast("array<int>"))
    found = F.aggregate(words, begun, step)
    return found["subject"], found["taken"]


def unwrapped(t: Column) -> Column:
    """A subject that was broken over lines, its pieces (between slashes) joined again."""
    pieces = F.filter(F.transform(F.split(t, " / "), service_tokens), lambda p: p != "")
    bad = (classify.has_link(t) | classify.is_teacher(t) | classify.is_room(t) | classify.is_roomish_subject(t) | seg.is_code_segment(t)
           | t.rlike(r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"))
    goes_on = F.forall(behind_first(pieces), lambda p: p.startswith("(") | seg.lead_lower(p))
    return F.when(~bad & (F.size(pieces) >= 3) & F.forall(pieces, lambda p: p.rlike(r"\p{L}")) & goes_on, F.array_join(pieces, " ")).otherwise(t)


def capitalised(t: Column) -> Column:
    """``соціол.культури`` -> ``Соціол.культури``."""
    return F.when(seg.whole(t, seg.W_DOTTED_LOWER), F.concat(F.upper(F.substring(t, 1, 1)), F.substr(t, F.lit(2)))).otherwise(t)


def elective(t: Column) -> Column:
    """The subject that an elective course's heading names, '' if it names none."""
    inner = F.coalesce(*[F.when(F.regexp_extract(t, rx(p), 1) != "", F.regexp_extract(t, rx(p), 1)) for p in ELECTIVES], F.lit(""))
    name = _cut(F.regexp_replace(inner, rx(ELECTIVE_TAIL), ""), " :;,+-")
    bad = (name == "") | name.rlike(r"^\d+$") | classify.is_service(name) | classify.is_garbage(name) | ~seg.is_subject_candidate(name)
    return F.when(bad, F.lit("")).otherwise(name)


def course_level(t: Column) -> Column:
    """``2 курс магістр`` -> ``2 магістр``; without a degree the number alone."""
    number, level = F.regexp_extract(t, rx(COURSE), 1), F.lower(F.regexp_extract(t, rx(COURSE), 2))
    return F.when(level.startswith("маг"), F.concat(number, F.lit(" магістр"))).when(level == "бакалавр", F.concat(number, F.lit(" бакалавр"))).otherwise(number)


def program_hint(notes: Column) -> Column:
    """The first numbered program that notes (service tokens) name; a hanging conjunction takes the next part that can go on."""
    p = F.filter(parts(notes), lambda s: ~(classify.has_link(s) | classify.is_teacher(s) | classify.is_room(s) | classify.is_service(s) | classify.is_garbage(s)))
    goes_on = F.coalesce(F.get(F.filter(p, lambda s: seg.whole(s, CONTINUATION)), 0), F.lit(""))
    hinted = F.filter(p, lambda s: seg.whole(s, PROGRAM_HINT) & (F.regexp_count(s, F.lit(rx(r"\b(?:0\d{2}|1\d{2}|E\d)\b"))) <= 1))
    whole = F.transform(hinted, lambda s: F.when(F.lower(s).rlike(HANGING), F.trim(F.concat(s, F.lit(" "), goes_on))).otherwise(s))
    return F.coalesce(F.get(F.filter(whole, lambda s: ~F.lower(s).rlike(HANGING)), 0), F.lit(""))


def program_name(t: Column, bad: Column) -> Column:
    """A program's name for an exported file: scripts parted, capitalised, aliases resolved; '' for a bad label."""
    plain = F.translate(t, "_-", "  ")
    plain = F.regexp_replace(F.regexp_replace(plain, "(?<=[A-Za-z])(?=[А-ЯІЇЄҐа-яіїєґ])", " "), "(?<=[А-ЯІЇЄҐа-яіїєґ])(?=[A-Za-z])", " ")
    plain = _cut(service_tokens(plain), " !.,;:-")
    name = F.when(seg.lead_lower(plain) & F.substr(plain, F.lit(2)).rlike(r"\p{Lu}"), F.concat(F.upper(F.substring(plain, 1, 1)), F.substr(plain, F.lit(2)))).otherwise(plain)
    known = F.create_map(*[F.lit(x) for kv in LABEL_NAMES.items() for x in kv])
    return F.when(bad, F.lit("")).otherwise(F.coalesce(F.element_at(known, F.lower(name)), name))


def slot_key(x: Column) -> Column:
    """What two rows of a slot compare of their groups or courses."""
    return F.regexp_replace(F.lower(service_tokens(x)), r"(?U)[\W_]+", "")


def same_context(a: Column, b: Column) -> Column:
    """Whether two slot keys can belong together: equal, one within the other, or one of them blank."""
    return (a == "") | (b == "") | F.contains(a, b) | F.contains(b, a)


def is_program_label(candidate: Column, bad: Column) -> Column:
    return programs.is_label(candidate, bad)
