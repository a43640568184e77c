"""Column functions for lines of printed timetables: clean text, days, times and the role that a line plays."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions import times
from tabulon.functions.text import flat, let, rx

# Patterns that tell the lines of printed timetables apart.
LINK = r"(https?://|zoom|teams|meet|id:\s*\d|pin:|код[:\s])"
ROOM = r"\b(?:ауд\.?|аудиторія|корпус|корп\.|каб\.?|online|онлайн)\b(?:\s*[\w./-]+)?"
TITLES = r"(?:проф\.?|доц\.?|ас\.?|ст\.?\s*викл\.?|викл\.?|phd\.?|д\.\s*ю\.\s*н\.?|к\.\s*ю\.\s*н\.?|к\.\s*філос\.\s*н\.?)"
NAMED = r"[А-ЯІЇЄҐ][а-яіїєґ'-]+\s+[А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\."
TEACHER = rf"{TITLES}|{NAMED}"
GROUP = r"\b\d+\s*група\b"
COURSE = r"\b(\d+)\s*(?:курс|бакалавр|магістр|р\.?н\.?)\b"
CODE = r"^[A-ZА-ЯІЇЄҐ]\d+(?:\.\d+)?\b|^\d{3}\s+[А-Яа-яіїєґA-Za-z]"
ROOM_TOKEN = r"^(?:(?:ауд\.?|аудиторія|корпус|корп\.|каб\.?)\s*)?(?:\d{2,4}(?:[-/][0-9A-Za-zА-ЯІЇЄҐа-яіїєґ]+)?|online|онлайн)\b"
TEACHER_AHEAD = rf"^(?:{TITLES}\s+)?{NAMED}"
LINK_INSIDE = r"https?://\S+|(?:us\d{2}web|knu-ua|zoom|meet|teams)\S*"
ACCESS = r"^(?:meeting\s*id|passcode|код\s+доступу|ідентифікатор\s+конференції)[:\s0-9A-Za-z._=-]*$"
GROUP_PREFIX = r"\d+\s*група"
_EDGES = " ,;/"


def line_text(x: Column) -> Column:
    """A line with plain apostrophes and single spaces; spaced letters are joined where six tokens or more are mostly single characters."""
    single = lambda w: F.length(F.regexp_replace(w, r"(?U)[^\w]", "")) <= 1
    spaced = lambda t: let(F.split(t, " "), lambda ws: F.when(F.size(F.filter(ws, single)) >= F.size(ws) * F.lit(0.6), F.replace(t, F.lit(" "), F.lit(""))).otherwise(t))
    return let(F.translate(flat(x), "’`", "''"), lambda t: F.when(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) >= 5, spaced(t)).otherwise(t))


def _folded(x: Column) -> Column:
    """A text as case-blind patterns see it (long s and old Cyrillic forms match their letters), for quick looks: these may find too much, never too little."""
    return F.translate(F.lower(x), "ſᲀᲁᲂᲃᲄᲅ", "sвдостт")


def _holds_any(low: Column, *marks: str) -> Column:
    return reduce(or_, (F.contains(low, F.lit(m)) for m in marks))


def may_hold_link(t: Column, low: Column) -> Column:
    return F.contains(t, F.lit(":")) | _holds_any(low, "zoom", "teams", "meet", "код")


def may_hold_room(low: Column) -> Column:
    return _holds_any(low, "ауд", "корп", "каб", "онл", "onl")


def may_hold_teacher(t: Column, low: Column) -> Column:
    return F.contains(t, F.lit(".")) | _holds_any(low, "ас", "проф", "доц", "викл", "phd")


def may_hold_group(low: Column) -> Column:
    return F.contains(low, F.lit("група"))


def cell_lines(x: Column) -> Column:
    """The filled lines of a cell."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"\r\n|[\r\n\x0b\f\x1c-\x1e\x85  ]"), line_text), lambda t: t != "")


def _may_hold_day(line: Column) -> Column:
    """Whether all letters of a weekday stand in a line, as they must wherever it is one: most lines need no closer look."""
    held = lambda low, name: reduce(and_, (F.contains(low, F.lit(x)) for x in sorted(set(name) - {"'"}, key="цчсбляпкдвнітрауиео".index)))
    return let(F.lower(line), lambda low: reduce(or_, (held(low, name) for name in times.WEEKDAYS)))


def day(line: Column) -> Column:
    """The weekday that a clean line is, '' if none."""
    names = [*dict.fromkeys(times.WEEKDAYS.values())]
    return F.when(_may_hold_day(line), let(times.weekday(line), lambda d: F.when(d.isin(*names), d).otherwise(""))).otherwise("")


def time_ranges(line: Column) -> Column:
    """Every whole time range in a clean line: array of struct(start, end)."""
    found = F.transform(F.regexp_extract_all(line, F.lit(times.RANGE), F.lit(0)), times.parse_range)
    whole = F.filter(found, lambda r: (r["start"] != "") & (r["end"] != ""))
    return F.when(line.rlike("[-–—]"), whole).otherwise(F.array().cast("array<struct<start:string,end:string>>"))


def span(ranges: Column) -> Column:
    """struct(start, end): the earliest start and the latest end, '' without ranges."""
    return F.struct(F.coalesce(F.array_min(F.transform(ranges, lambda r: r["start"])), F.lit("")).alias("start"), F.coalesce(F.array_max(F.transform(ranges, lambda r: r["end"])), F.lit("")).alias("end"))


def without_times(line: Column) -> Column:
    return flat(F.regexp_replace(line, times.RANGE, " "))


def besides_teacher_and_room(x: Column) -> Column:
    """What a line says besides rooms and teachers."""
    def bare(t: Column, low: Column) -> Column:
        without = let(F.when(may_hold_room(low), F.regexp_replace(t, rx(ROOM), " ")).otherwise(t), lambda u: F.regexp_replace(F.regexp_replace(u, rx(TEACHER), " "), r"(?U)\s+", " "))
        return F.btrim(F.when(may_hold_room(low) | may_hold_teacher(t, low), without).otherwise(t), F.lit(" ,.;"))

    return let(flat(x), lambda t: let(_folded(t), lambda low: bare(t, low)))


def may_be_subject(x: Column) -> Column:
    """Four letters, digits or signs at least, one of them a letter, that are more than rooms, teachers or a heading."""
    solid = lambda t: F.regexp_replace(t, r"(?U)[\s|._:/()\-]+", "")
    return (F.length(x) >= 4) & (besides_teacher_and_room(x) != "") & ~F.contains(F.lower(x), F.lit("розклад")) & ~F.lower(x).isin("час", "день") & (F.length(solid(x)) >= 4) & x.rlike(r"\p{L}")


_NONE = {"teacher": "", "room": "", "link": "", "note": ""}


def _fields(**given) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in (_NONE | given).items()])


def _behind_teacher(t: Column) -> Column:
    """struct(teacher, room, link, note) of a line that begins with a teacher and goes on with a room, a link or access data; '' in all if it says more."""
    teacher = lambda: F.btrim(F.regexp_extract(t, rx(TEACHER_AHEAD), 0), F.lit(_EDGES))
    rest = F.btrim(F.regexp_replace(t, rx(TEACHER_AHEAD), ""), F.lit(_EDGES))
    token = lambda u: F.regexp_extract(u, rx(ROOM_TOKEN), 0)

    def rested(r: Column) -> Column:
        at = F.regexp_extract(r, "(?s)" + rx(f"^(.*?)(?:{LINK_INSIDE})"), 1)
        linked = r.rlike(rx(LINK_INSIDE))
        link = F.when(linked, F.btrim(F.substring(r, F.length(at) + 1, F.length(r)), F.lit(_EDGES))).otherwise("")
        ahead = F.when(linked, F.btrim(at, F.lit(_EDGES))).otherwise(r)

        def with_link(p: Column) -> Column:
            left = F.btrim(F.substring(p["ahead"], F.length(token(p["ahead"])) + 1, F.length(p["ahead"])), F.lit(_EDGES))
            room = F.btrim(token(p["ahead"]), F.lit(_EDGES))
            return let(left, lambda u: F.when(u == "", _fields(teacher=teacher(), room=room, link=p["link"])).when(token(u) == u, _fields(teacher=teacher(), room=u, link=p["link"]))
                       .when(u.rlike(rx(ACCESS)), _fields(teacher=teacher(), room=room, link=p["link"], note=u)).otherwise(_fields()))

        return F.when(r == "", _fields(teacher=teacher())).otherwise(let(F.struct(ahead.alias("ahead"), link.alias("link")), with_link))

    return F.when(~F.contains(t, F.lit(".")) | ~t.rlike(rx(TEACHER_AHEAD)), _fields()).otherwise(let(rest, rested))


def role(line: Column) -> Column:
    """struct(groups, teacher, room, link, note, subject) of a clean line: at most one of the last five is filled but for teachers with room and link."""
    shape = lambda groups=None, f=None, subject="": F.struct(
        (F.array().cast("array<string>") if groups is None else groups).alias("groups"), *[(_fields() if f is None else f)[k].alias(k) for k in _NONE],
        (subject if isinstance(subject, Column) else F.lit(subject)).alias("subject"))

    def told(t: Column, groups: Column) -> Column:
        alone = lambda may, pattern: may & t.rlike(rx(pattern)) & (besides_teacher_and_room(t) == "")
        said = lambda f, low: (F.when(F.concat(f["teacher"], f["room"], f["link"], f["note"]) != "", shape(groups, f))
                               .when(may_hold_link(t, low) & t.rlike(rx(LINK)), shape(groups, _fields(link=t))).when(alone(may_hold_room(low), ROOM), shape(groups, _fields(room=t)))
                               .when(alone(may_hold_teacher(t, low), TEACHER), shape(groups, _fields(teacher=t))).when(may_hold_group(low) & t.rlike(rx(GROUP)), shape(F.concat(groups, F.array(t))))
                               .when(t.rlike(rx(CODE)), shape(groups, _fields(note=t))).otherwise(shape(groups, subject=t)))
        return F.when((t == "") | (day(t) != "") | (F.size(time_ranges(t)) > 0), shape(groups)).otherwise(let(_behind_teacher(t), lambda f: let(_folded(t), lambda low: said(f, low))))

    none = F.array().cast("array<string>")
    prefixed = may_hold_group(_folded(line)) & line.rlike(rx(f"^.{{0,3}}?{GROUP_PREFIX}"))
    parts = F.when(prefixed, F.struct(F.regexp_extract_all(line, F.lit(rx(GROUP_PREFIX)), F.lit(0)).alias("g"), F.btrim(F.regexp_extract(line, rx(f"^.*{GROUP_PREFIX}(.*)$"), 1), F.lit(" -")).alias("t")))
    return let(parts.otherwise(F.struct(none.alias("g"), line.alias("t"))), lambda p: let(p["t"], lambda t: told(t, p["g"])))


def header_groups(line: Column) -> Column:
    """A header line where it names groups: by word, in capitals or short."""
    return F.when(line.rlike(rx(GROUP)) | ((line == F.upper(line)) & (line != F.lower(line))) | (F.length(line) <= 24), line).otherwise("")


def header_course(line: Column) -> Column:
    return F.regexp_extract(line, rx(COURSE), 1)
