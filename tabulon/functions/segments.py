"""Boolean column functions of one short cell text, as ``text.service_tokens`` leaves it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions import classify
from tabulon.functions.text import compact, rx

# Patterns of whole texts (W), anywhere in a text (A), or case-sensitive whole texts (C).
W_ROOM_FRAGMENT = r"(?:ауд|каб|корп)\.?|\d{2,4}[а-яіїєґa-z]?|[а-яіїєґa-z]-?\d{2,4}|\d{2,4}[-/][а-яіїєґa-z]"
W_ROOM_SEGMENT = r"\d{3,4}(?:\.0)?[А-ЯІЇЄҐA-Z]?(?:/\d+)?|[А-ЯІЇЄҐA-Z]-?\d{2,4}|online|онлайн"
C_TEACHER_COMPACT = r"[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+(?:\s+[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+)?\s+[А-ЯІЇЄҐ]\.(?:\s*[А-ЯІЇЄҐ]\.?)?"
C_TEACHER_LATIN = r"(?:dr|prof|professor|associate professor|assistant|lecturer)\.?\s+[A-Z][A-Za-z'’ʼ-]+(?:\s+[A-Z][A-Za-z'’ʼ-]+){1,3}"
W_NAME_INITIALS = r"[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+\s+[А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\.?"
W_SURNAME = r"[А-ЯІЇЄҐ][а-яіїєґ'’ʼ-]+"
W_INITIALS = r"[А-ЯІЇЄҐ]\.\s*[А-ЯІЇЄҐ]\.?"
MONTHS = ("січ", "лют", "берез", "квіт", "трав", "черв", "лип", "серп", "верес", "жовт", "листоп", "груд")
A_PROGRAM_CODE = r"\b(?:E\d{1,3}|0\d{2}|1\d{2})\b"
W_DATE_TIME = r"\d{2}\.\d{2}\.\d{4}(?:\s+\d{1,2}[:._]\d{2})?"
W_MEETING_CODE = r"[a-z]{3}-[a-z]{4}-[a-z]{3,4}"
C_OPAQUE = r"[A-Za-z0-9]{6,}(?:\.\d+)?"
W_NUMBERED_GROUP = r"(?:[ivxlcdmі]+|\d+)\s+група"
W_LESSON_GROUP = r"\d+\s*(?:підгрупа|підгр\.?|група|гр\.?)"
A_EXPLICIT_GROUP = r"\b(?:група|підгрупа|кластер|cluster|потік|stream)\b"
W_GROUP_CODE = r"[A-ZА-ЯІЇЄҐ]{1,8}-\d{1,2}[A-ZА-ЯІЇЄҐa-zа-яіїєґ0-9-]{0,8}"
A_GROUP_NOISE = (
    r"\b(?:денн(?:а|ої)|заочн(?:а|ої))\s+форм[аи]\s+навчання\b",
    r"\bкиївського\s+національного\s+університету\b",
    r"\bекономічного\s+факультету\b",
    r"\bнавчального\s+року\b",
    r"\bнауково-?методичний\b",
    r"\bнавчально-?методичний\b",
    r"\bекзаменаційної\s+сесії\b",
    r"\bнастановчої\s+сесії\b",
    r"\bпочаток\s+занять\b",
    r"\bстудент(ів|а)\b",
    r"\bдекан(?:а)?\b",
    r"\bвідділ\b",
)
A_GROUP_DATE = r"\b\d{4}\b.*\b(?:н\.?р\.?|року)\b"
W_STUDENT_COUNT = r"\d+\s+студент\w+.*"
W_YEAR = r"\d{4}|\d{4}\s*н\.?р\.?"
GROUP_NOISE_COMPACT = (
    "розклад", "занятьстудентів", "деннаформанавчання", "заочнаформанавчання", "студентівісторичногофакультету", "семестр", "навчальнийрік",
    "погоджую", "затверджую", "навчальнометодичнийвідділ", "київськогонаціональногоуніверситетуіменітарасашевченка", "економічногофакультету",
    "освітніпрограми", "освітняпрограма", "науковометодичнийцентр", "організаціїнавчальногопроцесу", "екзаменаційноїсесії", "настановчоїсесії",
    "початокзанять", "спискигруп", "длястудентів", "студентів",
)
W_CODE = r"(?:meeting id|passcode|код доступу|ідентифікатор конференції|идентификатор конференции|t=\d+)|[A-Za-z0-9+/=_-]{10,}"
W_CODE_PARTS = r"[a-z]{3,4}(?:-[a-z]{3,4}){2,3}"
C_CODE_MIXED = r"[A-Za-z0-9._=+-]{6,}"
W_ABBREVIATION = r"(?:ст|ас|доц|проф|викл)\.?"
SELF_STUDY_DAY = ("день самостійної роботи", "день самостiйної роботи")
DAY_OFF = ("вихідний", "вихiдний")
NON_SCHEDULE = (
    "деньсамостійноїроботи", "деньсамостiйноїроботи", "курсзавибором", "дисциплінивільноговиборустудента", "дисциплінивільноговибору",
    "вибірковадисципліна", "вибірковідисципліни", "іноземнамованормативнийкурс",
)
NON_SCHEDULE_WORDS = (
    "самостійної", "самостiйної", "самостійна", "самостiйна", "роботи", "робота", "вибору", "вибіркова", "вибіркові", "вибірковадисципліна",
)
INFORMATIONAL = ("розклад занять", "з'явиться пізніше", "з`явиться пізніше")
W_SUBJECT_NOISE = (
    r"\d{2}\.\d{2}\.\d{4}(?:\s+\d{1,2}[:.]\d{2})?",
    r"\[\d{2}\.\d{2}(?:,\s*\d{2}\.\d{2})+\]",
    r"\[\d{2}\.\d{2}(?:,\s*\d{2}\.\d{2})*\]\.?",
    r"(?:classroom|google\s+classroom|гугл\s+клас:?\.?)",
    r"(?:іd|id)\s*:\s*\d+(?:\s+\d+)+",
    r"вкл\.?\s*\d{2}\.\d{2}\.?",
)
A_MEETING = r"\b(?:meeting id|passcode|код доступу|ідентифікатор конференції|идентификатор конференции)\b"
A_MEETING_SHORT = r"^(?:ік|кд|id|pwd)\s*:"
A_LINK_FRAGMENT = r"(?:\?pwd=|[?&][a-z]{1,5}=|pwd=|zoom|teams|meet|us\d{2}web|knu-ua|meeting\s*id|passcode|\.com\b|\.us\b)"
W_DOTTED_LOWER = r"[а-яіїєґ]{4,}(?:\.[а-яіїєґ]{2,}){1,}"
C_TWO_INITIALS = r"[А-ЯІЇЄҐA-Z]\.\s*[А-ЯІЇЄҐA-Z]\.?"
FRAGMENT_MARKS = (".us", "?pwd=", "pwd=", "ідентифікатор", "идентификатор", "конференції", "конференции")
W_DROP_SERVICE = (r"день\s+самост[іi]йної\s+роботи|тижні\s+самост[іi]йної\s+роботи|самост[іi]й[-\s/]*н\w*(?:\s*/\s*|\s+)робот\w*"
                  r"|вільний\s+день|посвята\s+в\s+першокурсники")
W_DROP_TECHNICAL = (
    r"classroom\.?|google\s+classroom\.?|гугл\s+клас:?\.?"
    r"|\[\d{2}\.\d{2}(?:,\s*\d{2}\.\d{2})*\](?:\s*(?:\.|\((?:пр|л|лек|практ|сем|лаб|с|c)\))\s*)?"
    r"|вкл\.?\s*\d{2}\.\d{2}\.?|(?:іd|id)\s*:\s*\d+(?:\s+\d+)+"
    r"|понедельник|вторник|среда|четверг|пятница|суббота|воскресенье|понеділок|вівторок|середа|четвер|п'ятниця|субота|неділя")
DATE_LIST = r"\[\d{2}\.\d{2}(?:\s*,\s*\d{2}\.\d{2})*\s*\]"
W_DROP_DATES = rf"{DATE_LIST}(?:\s*;\s*{DATE_LIST})*|{DATE_LIST}(?:\s*(?:\.|\((?:пр|л|лек|практ|сем|лаб|с|c)\)))*"
A_EXAM = r"\b(?:іспит|залік|захист|екзамен)\b"
PHYSICS = ("фіз", "астроном", "оптик", "оптотех", "наносистем", "наномат", "матеріал", "мат-во", "м-во", "ядер", "елементар", "коледж")


def whole(t: Column, *patterns: str) -> Column:
    return t.rlike(rx("^(?:" + "|".join(patterns) + ")$"))


def cased(t: Column, pattern: str) -> Column:
    return t.rlike("(?U)^(?:" + pattern + ")$")


def somewhere(t: Column, *patterns: str) -> Column:
    return t.rlike(rx("(?:" + ")|(?:".join(patterns) + ")"))


def holds(t: Column, marks: tuple[str, ...]) -> Column:
    """Any of the marks anywhere in the lower-cased text."""
    low = F.lower(t)
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(low, F.lit(m))
    return found


def lead_lower(t: Column) -> Column:
    """Begins with a lower-case letter."""
    return t.rlike(r"^\p{Ll}")


def is_room_fragment(t: Column) -> Column:
    return whole(t, W_ROOM_FRAGMENT)


def is_room_segment(t: Column) -> Column:
    return whole(t, W_ROOM_SEGMENT)


def is_compact_teacher(t: Column) -> Column:
    return cased(F.trim(F.regexp_replace(t, r"^[. ]+", "")), C_TEACHER_COMPACT)


def is_latin_teacher(t: Column) -> Column:
    return cased(F.trim(F.regexp_replace(t, r"^[. ]+", "")), C_TEACHER_LATIN)


def is_teacher_name(t: Column) -> Column:
    return whole(t, W_NAME_INITIALS)


def is_any_teacher(t: Column) -> Column:
    return classify.is_teacher(t) | is_latin_teacher(t) | is_compact_teacher(t) | classify.is_person_name(t)


def is_month_only(t: Column) -> Column:
    words = F.filter(F.split(F.lower(t), r"[^0-9a-zа-яіїєґ]+"), lambda w: w != "")
    return (F.size(words) > 0) & F.forall(words, lambda w: w.rlike("^(?:" + "|".join(MONTHS) + ")"))


def is_date_week(t: Column) -> Column:
    return holds(t, MONTHS) & F.contains(F.lower(t), F.lit("тиж")) & t.rlike(r"\d")


def is_cohort(t: Column) -> Column:
    words = F.regexp_count(t, F.lit(r"[A-Za-zА-ЯІЇЄҐа-яіїєґ'’ʼ-]{3,}"))
    return (words >= 2) & t.rlike(r"\d") & ~classify.is_technical(t) & ~classify.is_urlish(t)


def program_codes(t: Column) -> Column:
    return F.regexp_count(t, F.lit(rx(A_PROGRAM_CODE)))


def is_opaque_code(t: Column) -> Column:
    return cased(t, C_OPAQUE) & t.rlike(r"\d") & t.rlike("[A-Z]") & t.rlike("[a-z]")


def is_code_segment(t: Column) -> Column:
    solid = F.replace(t, F.lit(" "), F.lit(""))
    mixed = solid.rlike("^" + C_CODE_MIXED + "$") & solid.rlike("[A-Za-z]") & solid.rlike("[0-9]")
    return whole(t, W_CODE) | solid.rlike("^[0-9]{6,}$") | solid.rlike("(?i)^" + W_CODE_PARTS + "$") | mixed


def is_lesson_group(t: Column) -> Column:
    return whole(t, W_LESSON_GROUP, W_NUMBERED_GROUP)


def is_explicit_group(t: Column) -> Column:
    return somewhere(t, A_EXPLICIT_GROUP) | whole(t, W_GROUP_CODE)


def is_group_noise(t: Column) -> Column:
    solid = compact(t)
    marked = F.lit(False)
    for m in GROUP_NOISE_COMPACT:
        marked = marked | F.contains(solid, F.lit(m))
    return (classify.is_technical(t) | classify.is_urlish(t) | classify.is_service(t) | classify.is_admin(t) | classify.is_teacher(t)
            | whole(t, W_SURNAME, W_INITIALS, W_STUDENT_COUNT, W_YEAR) | somewhere(t, *A_GROUP_NOISE, A_GROUP_DATE) | marked)


def is_non_class(t: Column) -> Column:
    return holds(t, DAY_OFF + SELF_STUDY_DAY)


def non_class_subject(t: Column) -> Column:
    """The canonical subject of a day off or a self-study day."""
    return F.when(holds(t, DAY_OFF), "Вихідний").when(holds(t, SELF_STUDY_DAY), "День самостійної роботи").otherwise(t)


def is_non_schedule(t: Column) -> Column:
    return compact(t).rlike("|".join(NON_SCHEDULE))


def is_non_schedule_word(t: Column) -> Column:
    return compact(t).isin(*NON_SCHEDULE_WORDS)


def is_informational(t: Column) -> Column:
    return holds(t, INFORMATIONAL)


def is_subject_candidate(t: Column) -> Column:
    solid = F.regexp_replace(t, r"(?U)[^\w]+", "")
    bad = (classify.is_forbidden_subject(t) | whole(t, W_ABBREVIATION) | classify.is_roomish_subject(t) | is_code_segment(t) | classify.is_service(t)
           | classify.is_garbage(t) | (~F.contains(t, F.lit(" ")) & (F.length(solid) < 4) & ~F.contains(t, F.lit(","))))
    shouted = t.rlike(r"\p{Lu}") & ~t.rlike(r"\p{Ll}")
    plain = (t.rlike(r"\p{L}") & ~shouted) | F.contains(t, F.lit(","))
    return (t != "") & (holds(t, SELF_STUDY_DAY) | (~bad & plain))


def is_subject_noise(t: Column) -> Column:
    latin = ~t.rlike("[А-ЯІЇЄҐа-яіїєґ]")
    return (whole(t, *W_SUBJECT_NOISE) | classify.has_link(t) | somewhere(t, A_MEETING, A_MEETING_SHORT)
            | (latin & (t.rlike("(?i)" + A_LINK_FRAGMENT) | F.lower(t).isin("j", "com"))))


def is_fragment_subject(t: Column) -> Column:
    """A piece of a subject: initials, a lower-case beginning, a broken bracket, a hanging sign, meeting data."""
    unbalanced = F.length(t) - F.length(F.replace(t, F.lit("("), F.lit(""))) != F.length(t) - F.length(F.replace(t, F.lit(")"), F.lit("")))
    piece = lead_lower(t) | holds(t, FRAGMENT_MARKS) | unbalanced | t.rlike("[-/:]$") | t.rlike(r"^\([^)]{1,12}\)\s*[0-9]{1,4}$")
    return (t == "") | cased(t, C_TWO_INITIALS) | (~whole(t, W_DOTTED_LOWER) & piece)


def is_drop_review(t: Column) -> Column:
    """Text of a review row that is no class at all."""
    return (whole(t, W_DROP_SERVICE, W_DROP_TECHNICAL, W_DROP_DATES) | classify.is_admin(t) | (classify.is_service(t) & ~somewhere(t, A_EXAM)))


def is_physics_hint(t: Column) -> Column:
    return holds(t, PHYSICS)
