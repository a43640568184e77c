"""Queries of text classes and program labels over labels that every row of ``part`` fills in, each beside SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import classify, fields, programs, text
from tabulon.functions import segments as seg
from tabulon.operators import quality
from tabulon.plans.sched import read

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Labels; # stands for a part's size (1 to 50).
LABELS = (
    "Алгебра", "Алгебра та геометрія", "алгебра та", "ауд. #", "ауд.", "каб", "21#", "А-21#", "13#/2", "online", "корп. #", "корпоративне право", "Іваненко І. І.",
    "Іваненко І.", "Іваненко Олена Петрівна", "Мамедов Алі Гасан огли", "Dr. John Smith", "professor Ann Mary Lee", "січень - лютий", "# тиждень вересня", "жовтень",
    "Група # механіка", "1# група", "II група", "ІПЗ-1#", "кластер #", "потік #", "акад. # ; #", "група 1 ; група #", "I потік ; група #", "125 право ; 126 E#", "E#",
    "122 Комп'ютерні науки", "Aa1Bb#", "Zx9Qw7Er#", "abc-defg-hij", "meeting id 123 #", "passcode: #", "12345#7", "t=#", "12.05.2024 1#:30", "[12.05, 13.05]", "[12.05]",
    "вкл. 12.05", "classroom", "id: # 123", "zoom", "https://zoom.us/j/#", "wp-content", "sheet#", "com", ".com ; Право", "Право ; та", "Право ; економіка", "Право ; ауд. #",
    "Розклад занять", "розклад на весну # курсу магістратури", "# курс", "1 - # курси (Право)", "Право # курс магістр", "12.09 - 15.09 Філософія", "12.09 Розклад",
    "освітня програма \"Соціологія\"", "освітні програми Психологія ОС бакалавр", "ОП \"Туризм\" ОС \"магістр\"", "ОП Туризм та готелі", "R.N. or mahistr pravo", "# r.n. or mahistr IV",
    "генетичнии аналіз", "Начитка!", "постійний", "ENGLISH", "english # c", "Л-# год.", "декан факультету", "вихідний", "День самостійної роботи", "самостійна робота",
    "Самостійна / робота", "дисципліна за вибором", "Курс за вибором: Логіка", "вибору", "розклад занять з'явиться пізніше", "ст.", "доц", "Ф", "ЛОГІКА", "ЛОГІКА (Л) # год",
    "Логіка (лек)", "Логіка (", "Логіка -", "(лаб) 12#", "А. Б.", "соціол.культури", "Фізика плазми", "Оптика та лазери", "2# студентів", "202# н.р.", "2024 навчальний рік",
    "початок занять о 9", "денна форма навчання", "\"Право", "Право \"", "097 123 4567", "слово", "A1b2C3d4E5 F6", "Доставити: Географія (укр)", "Географія бакалавр", "понеділок", "M O N D A Y",
    "Вільний день", "посвята в першокурсники", "Google Classroom", "захист дипломів", "# підгр.", "III курс Право", "Право ; Коваль І. П.", "Соціологія ; доц. Коваль І. П.",
)


def labels(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    drawn = F.element_at(F.array(*map(F.lit, LABELS)), (F.col("p_partkey") % len(LABELS) + 1).cast("int"))
    return part.select(F.replace(drawn, F.lit("#"), F.col("p_size").cast("string")).alias("label")).distinct()


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


LABELS_SQL = f"labels AS (SELECT DISTINCT replace(([{_quoted(LABELS)}])[(p_partkey % {len(LABELS)} + 1)::INT], '#', p_size::VARCHAR) AS l FROM part)"
_IN, _OUT = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def re2(pattern: str) -> str:
    """A fixed pattern in the syntax of SQL's regular expressions, which know word ends of ASCII only."""
    out, at = "", 0
    while at < len(pattern):
        two = pattern[at : at + 2]
        if two == r"\b":
            opens = not out or out.endswith(("|", "(?:", "("))
            out, at = out + (_IN if opens else _OUT), at + 2
        elif two == r"\w":
            out, at = out + (r"\p{L}\p{N}_" if out.rfind("[") > out.rfind("]") else r"[\p{L}\p{N}_]"), at + 2
        elif two[:1] == "\\":
            out, at = out + two, at + 2
        else:
            out, at = out + two[:1], at + 1
    return out.replace("'", "''")


def some(x: str, *patterns: str) -> str:
    return f"regexp_matches({x}, '(?i)" + "|".join(f"(?:{re2(p)})" for p in patterns) + "')"


def all_of(x: str, *patterns: str, flags: str = "i") -> str:
    mark = f"(?{flags})" if flags else ""
    return f"regexp_full_match({x}, '{mark}" + "|".join(f"(?:{re2(p)})" for p in patterns) + "')"


def has(x: str, marks) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{m.replace(chr(39), chr(39) * 2)}')" for m in marks) + ")"


def compact_sql(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', '', 'g')"


_TOKENS = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace({x}, 'ауд ', 'ауд. '), 'АУД ', 'ауд. '),
  '(?i)(^|[^\p{{L}}\p{{N}}_])лек($|[^\p{{L}}\p{{N}}_.])', '\1лек.\2', 'g'), '(?i)(^|[^\p{{L}}\p{{N}}_])практ($|[^\p{{L}}\p{{N}}_.])', '\1практ.\2', 'g'),
  '\s*([|/;])\s*', ' \1 ', 'g'), '\s+', ' ', 'g'), '^[ ,;]+|[ ,;]+$', '', 'g')"""


def tokens_sql(x: str) -> str:
    """Canonical spacing; the labels here hold no doubled dots."""
    return _TOKENS.format(x=x)


def person_sql(x: str) -> str:
    words = f"string_split({x}, ' ')"
    return (f"(NOT regexp_matches({x}, '[0-9]') AND ({all_of(x, classify.PERSON_INITIALS, flags='')} OR CASE WHEN len({words}) >= 4 AND list_contains([{_quoted(classify.FOREIGN_PATRONYMICS)}], lower({words}[-1])) "
            f"THEN len(list_filter({words}[:-2], lambda w: NOT {all_of('w', classify.CAPITALIZED, flags='')})) = 0 "
            f"ELSE len({words}) >= 3 AND {all_of(x, classify.PERSON_FULL, flags='')} AND (list_contains([{_quoted(classify.FOREIGN_PATRONYMICS)}], lower({words}[-1])) OR {some(words + '[-1]', classify.PATRONYMIC)}) END))")


def weekday_sql(x: str) -> str:
    return f"(contains({x}, ' ') AND list_contains([{_quoted(classify.SPACED_WEEKDAYS)}], lower(replace({x}, ' ', ''))))"


def forbidden_sql(x: str) -> str:
    return f"({some(x, *classify.FORBIDDEN)} OR {weekday_sql(x)} OR {person_sql(x)})"


def service_sql(x: str) -> str:
    return f"({weekday_sql(x)} OR {some(x, *classify.SERVICE)} OR regexp_matches({compact_sql(x)}, '{'|'.join(classify.SERVICE_COMPACT)}'))"


def technical_sql(x: str) -> str:
    return (f"({some(x, *classify.TECHNICAL)} OR (NOT contains({x}, ' ') AND contains({x}, '=') AND (contains({x}, '?') OR (contains({x}, '&') AND regexp_matches({x}, '[A-Za-z]')))))")


def room_sql(x: str) -> str:
    # what a word end closes is a letter or digit
    return some(x, classify.ROOM[0].replace(r"[\w./-]+", r"[\w./-]*\w"), classify.ROOM[1])


def code_token_sql(x: str) -> str:
    return f"(regexp_full_match({x}, '[A-Za-z0-9+/=_-]{{8,}}') AND (regexp_matches({x}, '[0-9+/=_-]') OR (regexp_matches({x}, '[A-Z]') AND regexp_matches({x}, '[a-z]'))))"


def garbage_sql(x: str) -> str:
    """Of texts up to 80 characters: letter-spaced or one code-like token."""
    w = f"string_split({x}, ' ')"
    return f"((len({w}) >= 8 AND len(list_filter({w}, lambda y: length(regexp_replace(y, '[^\\p{{L}}\\p{{N}}_]', '', 'g')) <= 1)) >= len({w}) * 0.45) OR {code_token_sql(x)})"


def teachers_sql(x: str) -> str:
    b = f"trim(regexp_replace({x}, '^[. ]+', ''))"
    return f"({some(x, classify.TEACHER)} OR {all_of(b, seg.C_TEACHER_LATIN, flags='')} OR {all_of(b, seg.C_TEACHER_COMPACT, flags='')} OR {person_sql(b)})"


def opaque_sql(x: str) -> str:
    return f"({all_of(x, seg.C_OPAQUE, flags='')} AND regexp_matches({x}, '[0-9]') AND regexp_matches({x}, '[A-Z]') AND regexp_matches({x}, '[a-z]'))"


def parts_sql(x: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({x}, '\\s*;\\s*'), lambda s: regexp_replace(trim(s), '^[ .,:;-]+|[ .,:;-]+$', '', 'g')), lambda s: s <> '')"


def months_sql(x: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({x}), '[^0-9a-zа-яіїєґ]+'), lambda w: w <> '')"
    return f"(len({words}) > 0 AND len(list_filter({words}, lambda w: NOT regexp_matches(w, '^(?:{'|'.join(seg.MONTHS)})'))) = 0)"


def cohort_sql(x: str) -> str:
    return (f"(len(regexp_extract_all({x}, '[A-Za-zА-ЯІЇЄҐа-яіїєґ''’ʼ-]{{3,}}')) >= 2 AND regexp_matches({x}, '[0-9]') AND NOT {technical_sql(x)} AND NOT {some(x, *classify.URLISH)})")


def codes_sql(x: str) -> str:
    """How many words are program codes."""
    return f"len(list_filter(regexp_split_to_array({x}, '[^\\p{{L}}\\p{{N}}_]+'), lambda w: {all_of('w', seg.A_PROGRAM_CODE[2:-2])}))"


def aggregate_sql(p: str) -> str:
    n = lambda *ps: f"len(list_filter({p}, lambda s: {some('s', *ps)}))"
    groups, streams = n(r"\bгрупа\b"), n(r"\b(?:[ivxlcdm]+|\d+)\s*потік\b")
    academic, numbers = n(r"\b(?:акад\w*|к[-\s]*ад\w*)\b"), n(r"^\d+$")
    return f"({groups} >= 2 OR ({streams} >= 1 AND {groups} >= 1) OR ({academic} >= 1 AND ({numbers} >= 1 OR len({p}) >= 2)))"


def no_part_sql(s: str) -> str:
    return (f"({all_of(s, seg.W_DATE_TIME, seg.W_NUMBERED_GROUP)} OR lower({s}) IN ('.com', 'com') OR {room_sql(s)} OR {some(s, *classify.ROOMISH)} OR {all_of(s, seg.W_ROOM_FRAGMENT)} "
            f"OR {forbidden_sql(s)} OR {teachers_sql(s)})")


def technical_part_sql(s: str) -> str:
    return f"({all_of(s, seg.W_DATE_TIME, seg.W_MEETING_CODE)} OR {opaque_sql(s)} OR lower({s}) IN ('.com', 'com') OR {room_sql(s)} OR {some(s, *classify.URLISH)} OR {technical_sql(s)})"


def meaningful_part_sql(s: str) -> str:
    return (f"(NOT {technical_part_sql(s)} AND length(array_to_string(regexp_extract_all({s}, '[A-Za-zА-ЯІЇЄҐа-яіїєґ''’ʼ-]{{3,}}'), '')) >= 6 AND NOT {some(s, *classify.ADMIN)})")


def _count(p: str, test) -> str:
    return f"len(list_filter({p}, lambda s: {test('s')}))"


def dangling_sql(p: str) -> str:
    return f"len(list_filter({p}, lambda s: regexp_matches(lower(s), '(?:^| )(?:та|і|й|and)$'))) > 0"


def lower_sql(p: str) -> str:
    return f"(len({p}) >= 2 AND len(list_filter({p}[2:], lambda s: regexp_matches(s, '^\\p{{Ll}}'))) > 0)"


def technical_parts_sql(p: str) -> str:
    t, m = _count(p, technical_part_sql), _count(p, meaningful_part_sql)
    return f"(len({p}) >= 2 AND {t} > 0 AND ({m} = 0 OR {t} >= len({p}) - 1))"


def combination_sql(p: str) -> str:
    return f"(len({p}) >= 2 AND {_count(p, no_part_sql)} = len({p}))"


def storage_sql(x: str) -> str:
    return f"regexp_matches({x}, '^[A-Za-z0-9_-]{{16,}}$|^[0-9]+(?:[._-][0-9]+)*$|^https?://')"


def bad_sql(t: str, p: str, clean: str) -> str:
    bare = f"regexp_replace({clean}, '^[ .,:;-]+', '')"
    count = lambda c: f"(length({t}) - length(replace({t}, '{c}', '')))"
    coded = f"(regexp_matches({t}, '[0-9]') OR regexp_matches({t}, '[-+/=_;:]') OR (regexp_matches({t}, '[A-Z].*[A-Z]') AND regexp_matches({t}, '[a-z]')))"
    tests = [
        f"(NOT contains({t}, ' ') AND length({t}) >= 8 AND regexp_matches({t}, '[0-9]') AND regexp_matches({t}, '\\p{{L}}'))", f"(NOT contains({t}, ' ') AND {storage_sql(t)})",
        some(t, *classify.URLISH), technical_sql(t), f"{count(chr(34))} % 2 = 1", f"{count('«')} <> {count('»')}", some(t, *classify.ADMIN),
        f"(length({t}) >= 20 AND {has(t, programs.LONG_MARKS)})", months_sql(t), f"({has(t, seg.MONTHS)} AND contains(lower({t}), 'тиж') AND regexp_matches({t}, '[0-9]'))",
        f"{codes_sql(t)} >= 2", some(t, r"\b\d{3}\s+\d{3}\s+\d{4}\b", r"\b(?:ауд|корп)\.?\b"), dangling_sql(p), lower_sql(p), aggregate_sql(p), teachers_sql(bare),
        forbidden_sql(bare), combination_sql(p), all_of(t, seg.W_NUMBERED_GROUP), opaque_sql(t), technical_parts_sql(p), f"({garbage_sql(t)} AND {coded} AND NOT {cohort_sql(t)})",
        all_of(bare, seg.W_ROOM_FRAGMENT), room_sql(t), some(t, *classify.ROOMISH), all_of(t, *programs.BAD_LABELS), all_of(t, programs.BAD_LABEL_CASED, flags=""),
        f"list_contains([{_quoted(programs.BAD_COMPACT)}], {compact_sql(t)})", f"(starts_with({compact_sql(t)}, 'розклад') AND length({t}) <= 24)",
    ]
    return "(" + "\n OR ".join(tests) + ")"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f
    return add


_T = f"WITH {LABELS_SQL}, t AS (SELECT l, {tokens_sql('l')} AS t FROM labels), p AS (SELECT l, t, {parts_sql('t')} AS p FROM t)"


@query(f"""{_T} SELECT l AS label, {all_of('t', seg.W_ROOM_FRAGMENT)} AS room_fragment, {all_of('t', seg.W_ROOM_SEGMENT)} AS room_segment,
  {all_of('t', seg.C_TEACHER_COMPACT, flags='')} AS compact_teacher, {all_of('t', seg.C_TEACHER_LATIN, flags='')} AS latin_teacher, {all_of('t', seg.W_NAME_INITIALS)} AS teacher_name,
  {person_sql('t')} AS person, {months_sql('t')} AS month_only, ({has('t', seg.MONTHS)} AND contains(lower(t), 'тиж') AND regexp_matches(t, '[0-9]')) AS date_week,
  {cohort_sql('t')} AS cohort, {codes_sql('t')}::INT AS codes, {opaque_sql('t')} AS opaque, {forbidden_sql('t')} AS forbidden, {service_sql('t')} AS service, {room_sql('t')} AS room FROM p""")
def label_classes(spark, sf_dir):
    """Classes of whole labels: rooms, teachers and persons, months, cohorts, codes."""
    t = F.col("t")
    return labels(spark, sf_dir).withColumn("t", text.service_tokens(F.col("label"))).select(
        "label", seg.is_room_fragment(t).alias("room_fragment"), seg.is_room_segment(t).alias("room_segment"), seg.is_compact_teacher(t).alias("compact_teacher"),
        seg.is_latin_teacher(t).alias("latin_teacher"), seg.is_teacher_name(t).alias("teacher_name"), classify.is_person_name(t).alias("person"),
        seg.is_month_only(t).alias("month_only"), seg.is_date_week(t).alias("date_week"), seg.is_cohort(t).alias("cohort"), seg.program_codes(t).alias("codes"),
        seg.is_opaque_code(t).alias("opaque"), classify.is_forbidden_subject(t).alias("forbidden"), classify.is_service(t).alias("service"), classify.is_room(t).alias("room"))


_SOLID = "replace(t, ' ', '')"
_CODE = (f"({all_of('t', seg.W_CODE)} OR regexp_full_match({_SOLID}, '[0-9]{{6,}}') OR {all_of(_SOLID, seg.W_CODE_PARTS)} OR ({all_of(_SOLID, seg.C_CODE_MIXED, flags='')} "
         f"AND regexp_matches({_SOLID}, '[A-Za-z]') AND regexp_matches({_SOLID}, '[0-9]')))")
_NOISE_SQL = (f"({technical_sql('t')} OR {some('t', *classify.URLISH)} OR {service_sql('t')} OR {some('t', *classify.ADMIN)} OR {some('t', classify.TEACHER)} "
              f"OR {all_of('t', seg.W_SURNAME, seg.W_INITIALS, seg.W_STUDENT_COUNT, seg.W_YEAR)} OR {some('t', *seg.A_GROUP_NOISE, seg.A_GROUP_DATE)} "
              f"OR {has(compact_sql('t'), seg.GROUP_NOISE_COMPACT)})")
_SUBJECT_SQL = (f"(t <> '' AND ({has('t', seg.SELF_STUDY_DAY)} OR (NOT ({forbidden_sql('t')} OR {all_of('t', seg.W_ABBREVIATION)} OR {some('t', *classify.ROOMISH)} OR {_CODE} OR {service_sql('t')} "
                f"OR {garbage_sql('t')} OR (NOT contains(t, ' ') AND length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}_]+', '', 'g')) < 4 AND NOT contains(t, ','))) "
                f"AND ((regexp_matches(t, '\\p{{L}}') AND NOT (regexp_matches(t, '\\p{{Lu}}') AND NOT regexp_matches(t, '\\p{{Ll}}'))) OR contains(t, ',')))))")
_FRAGMENT_SQL = (f"(t = '' OR {all_of('t', seg.C_TWO_INITIALS, flags='')} OR (NOT {all_of('t', seg.W_DOTTED_LOWER)} AND (regexp_matches(t, '^\\p{{Ll}}') OR {has('t', seg.FRAGMENT_MARKS)} "
                 f"OR length(replace(t, '(', '')) <> length(replace(t, ')', '')) OR regexp_matches(t, '[-/:]$') OR regexp_matches(t, '^\\([^)]{{1,12}}\\)\\s*[0-9]{{1,4}}$'))))")


@query(f"""{_T} SELECT l AS label, {_CODE} AS code, {all_of('t', seg.W_LESSON_GROUP, seg.W_NUMBERED_GROUP)} AS lesson_group,
  ({some('t', seg.A_EXPLICIT_GROUP)} OR {all_of('t', seg.W_GROUP_CODE)}) AS explicit_group, {_NOISE_SQL} AS group_noise, {has('t', seg.DAY_OFF + seg.SELF_STUDY_DAY)} AS non_class,
  CASE WHEN {has('t', seg.DAY_OFF)} THEN 'Вихідний' WHEN {has('t', seg.SELF_STUDY_DAY)} THEN 'День самостійної роботи' ELSE t END AS non_class_subject,
  {has(compact_sql('t'), seg.NON_SCHEDULE)} AS non_schedule, list_contains([{_quoted(seg.NON_SCHEDULE_WORDS)}], {compact_sql('t')}) AS non_schedule_word,
  {has('t', seg.INFORMATIONAL)} AS informational, {_SUBJECT_SQL} AS subject_candidate,
  ({all_of('t', *seg.W_SUBJECT_NOISE)} OR {some('t', classify.LINK, seg.A_MEETING, seg.A_MEETING_SHORT)} OR (NOT regexp_matches(t, '[А-ЯІЇЄҐа-яіїєґ]')
    AND (regexp_matches(t, '(?i){seg.A_LINK_FRAGMENT}') OR lower(t) IN ('j', 'com')))) AS subject_noise, {_FRAGMENT_SQL} AS fragment,
  ({all_of('t', seg.W_DROP_SERVICE, seg.W_DROP_TECHNICAL, seg.W_DROP_DATES)} OR {some('t', *classify.ADMIN)} OR ({service_sql('t')} AND NOT {some('t', seg.A_EXAM)})) AS drop_review,
  {has('t', seg.PHYSICS)} AS physics FROM p""")
def segment_classes(spark, sf_dir):
    """Classes of parts of cells: codes, groups and their noise, what is no class, fragments."""
    t = F.col("t")
    return labels(spark, sf_dir).withColumn("t", text.service_tokens(F.col("label"))).select(
        "label", seg.is_code_segment(t).alias("code"), seg.is_lesson_group(t).alias("lesson_group"), seg.is_explicit_group(t).alias("explicit_group"),
        seg.is_group_noise(t).alias("group_noise"), seg.is_non_class(t).alias("non_class"), seg.non_class_subject(t).alias("non_class_subject"),
        seg.is_non_schedule(t).alias("non_schedule"), seg.is_non_schedule_word(t).alias("non_schedule_word"), seg.is_informational(t).alias("informational"),
        seg.is_subject_candidate(t).alias("subject_candidate"), seg.is_subject_noise(t).alias("subject_noise"), seg.is_fragment_subject(t).alias("fragment"),
        seg.is_drop_review(t).alias("drop_review"), seg.is_physics_hint(t).alias("physics"))


@query(f"""{_T} SELECT l AS label, {dangling_sql('p')} AS dangling, {lower_sql('p')} AS lower_continuation, {aggregate_sql('p')} AS group_aggregate,
  {technical_parts_sql('p')} AS technical_parts, {combination_sql('p')} AS combination, {_count('p', meaningful_part_sql)}::INT AS meaningful,
  {_count('p', technical_part_sql)}::INT AS technical FROM p""")
def program_parts(spark, sf_dir):
    """What the parts of a program label say together."""
    p = F.col("p")
    return labels(spark, sf_dir).withColumn("p", programs.parts(text.service_tokens(F.col("label")))).select(
        "label", programs.has_dangling_conjunction(p).alias("dangling"), programs.has_lower_continuation(p).alias("lower_continuation"),
        programs.is_group_aggregate(p).alias("group_aggregate"), programs.has_technical_parts(p).alias("technical_parts"),
        programs.is_no_program_combination(p).alias("combination"), F.size(F.filter(p, programs.is_meaningful_part)).alias("meaningful"),
        F.size(F.filter(p, programs.is_technical_part)).alias("technical"))


def _plain_sql(x: str) -> str:
    steps = [(r"(?i)(^|[^\p{L}\p{N}_])доставити($|[^\p{L}\p{N}_])", r"\1 \2"), (r"(?i)\(\s*укр\s*\)", " "), (r'(?i)(^|[^\p{L}\p{N}_])ОП\s*"([^"]+)"', r"\1\2"),
             (r"(?i)(^|[^\p{L}\p{N}_])ОП\s+([^,;]+)", r"\1\2"), (r'(?i)(^|[^\p{L}\p{N}_])ОС\s*"?(?:бакалавр|магістр)"?', r"\1 "), (r"(?i)\s+(?:бакалавр|магістр)$", " "),
             (r"\s*,\s*,+", ", ")]
    t = f"translate(regexp_replace(replace({tokens_sql(x)}, '_', ' '), '^[ .,:;-]+|[ .,:;-]+$', '', 'g'), '“”«»', '\"\"\"\"')"
    for pattern, to in steps:
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'g')"
    edge = "^[ .,:;\"''-]+|[ .,:;\"''-]+$"
    return f"regexp_replace({tokens_sql(t)}, '{edge}', '', 'g')"


_DATED = r"^(?:\d{1,2}\.\d{1,2}(?:\.\d{2,4})?(?:\s*[-–—]\s*\d{1,2}\.\d{1,2}(?:\.\d{2,4})?)?\s+){1,3}(.+)$"


def _steps() -> str:
    """Wrappings off, three times, each a table of its own: no label of this list has more."""
    out, before = f", c0 AS (SELECT l, t, p, {_plain_sql('l')} AS c FROM p)", "c0"
    for k in range(1, 4):
        law = f"regexp_extract(c, '(?i)^(?:\\d+\\s*)?r\\.?\\s*n\\.?\\s+or\\s+mahistr\\s+(iv|pravo|zdnu)(?:$|[^\\p{{L}}\\p{{N}}_])', 1)"
        wraps = " ".join(f"WHEN regexp_extract(c, '(?i){re2(w)}', 1) <> '' THEN regexp_extract(c, '(?i){re2(w)}', 1)" for w in programs.WRAPPED)
        tail = f"regexp_replace({tokens_sql(f'regexp_extract(c, {chr(39)}{_DATED}{chr(39)}, 1)')}, '^[ .,:;-]+|[ .,:;-]+$', '', 'g')"
        out += (f", a{k} AS MATERIALIZED (SELECT *, {tail} AS tail FROM {before}), b{k} AS MATERIALIZED (SELECT *, {parts_sql('tail')} AS tp FROM a{k}), "
                f"d{k} AS MATERIALIZED (SELECT l, t, p, CASE lower({law}) WHEN 'pravo' THEN 'Право' WHEN 'iv' THEN 'Інтелектуальна власність' WHEN 'zdnu' THEN 'ЗДНУ' ELSE "
                f"CASE {wraps} WHEN tail <> '' AND NOT {bad_sql('tail', 'tp', 'tail')} THEN tail ELSE c END END AS c FROM b{k}), "
                f"c{k} AS MATERIALIZED (SELECT l, t, p, {_plain_sql('c')} AS c FROM d{k})")
        before = f"c{k}"
    return out + f", e AS MATERIALIZED (SELECT *, {parts_sql('c')} AS cp FROM {before})"


_KEPT = (f"list_filter(list_transform(cp, lambda s: regexp_replace(regexp_replace(s, '^[. ]+', ''), '^[ ,]+|[ ,]+$', '', 'g')), lambda s: s <> '' AND NOT ({all_of('s', seg.W_DATE_TIME)} "
         f"OR lower(s) IN ('.com', 'com') OR {room_sql('s')} OR {some('s', *classify.ROOMISH)} OR {all_of('s', seg.W_ROOM_FRAGMENT)} OR {forbidden_sql('s')} OR {teachers_sql('s')} "
         f"OR {technical_sql('s')} OR {some('s', *classify.URLISH)}))")
_ALIAS = "CASE lower(j) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in programs.ALIASES.items()) + " ELSE j END"


@query(f"""{_T}{_steps()}, j AS MATERIALIZED (SELECT *, array_to_string({_KEPT}, ' ; ') AS j FROM e), f AS MATERIALIZED (SELECT *, {_ALIAS} AS candidate FROM j)
  SELECT l AS label, candidate, (t <> '' AND (candidate = '' OR {bad_sql('t', 'p', 'candidate')})) AS bad FROM f""")
def program_labels(spark, sf_dir):
    """The clean form of every program label, and whether it may stand."""
    return programs.labelled(labels(spark, sf_dir), "label").select("label", F.col("program_candidate").alias("candidate"), F.col("program_bad").alias("bad"))


TEACHERS = ("", "Вовна О. В.", "доц. Коваль І. П. (лек)", "Коваль І. П. 214", "Коваль І. П. 9:30", "А ; Б ; В ; Г ; Д ; Е", "Довгий список ; " * 14, "практична Марія")
ROOMS = ("", "214", "ауд. 214", "доц. Коваль", "https://meet.example/abc", "аудиторія в далекому корпусі номер два на третьому поверсі біля великої сходової клітки справа")
NOTES = ("", "Право", "звіт декана " * 8, "примітка " * 30, "Розклад занять на весну та осінь цього навчального року для всіх студентів факультету і кафедр")
#: Clock times of a slot; the third is too long, the fourth too short, the fifth too late.
SLOTS = (("08:00", "09:20"), ("09:30", "10:50"), ("09:00", "14:30"), ("11:00", "11:10"), ("22:00", "23:20"), ("", "09:20"))
MORE_SUBJECTS = ("Іноземна мова", "Англійська мова", "Хімія 214", "Хімія / А-12", "Біологія хімічний ф-т 12", "Логіка Коваль І. та інші", "a?pwd=b", "=SUM(A1)", "12345", "???",
                 "Аналіз / продовження / (лек)", "Аналіз / Геометрія / Логіка", "Аналіз / продовження / ще", "Іспит 12.05.2024", "Історія -----", "кваліфікаційна робота", "Практика виробнича",
                 "Довга назва предмета про все на світі " * 5)


def schedule_rows(spark, sf_dir):
    """One row a part, its cells drawn from the lists by its key."""
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        "p_partkey", pick(("fit-schedule", "chem-schedule"), k).alias("source_name"), F.trim(pick(LABELS + MORE_SUBJECTS, k)).alias("subject"),
        F.when(F.col("p_size") == 1, "").otherwise("Середа").alias("day"), pick([a for a, _ in SLOTS], F.floor(k / 3)).alias("start_time"),
        pick([b for _, b in SLOTS], F.floor(k / 3)).alias("end_time"), pick(TEACHERS, F.floor(k / 7)).alias("teacher"),
        pick(ROOMS, F.floor(k / 11)).alias("room"), pick(NOTES, F.floor(k / 13)).alias("notes"))


def _pick_sql(values, i) -> str:
    return f"([{_quoted(values)}])[({i} % {len(values)} + 1)::INT]"


ROWS_SQL = f"""rows AS (SELECT p_partkey, {_pick_sql(("fit-schedule", "chem-schedule"), "p_partkey")} AS source, trim({_pick_sql(LABELS + MORE_SUBJECTS, "p_partkey")}) AS s,
  CASE WHEN p_size = 1 THEN '' ELSE 'Середа' END AS day, {_pick_sql([a for a, _ in SLOTS], "(p_partkey // 3)")} AS a, {_pick_sql([b for _, b in SLOTS], "(p_partkey // 3)")} AS b,
  trim({_pick_sql(TEACHERS, "(p_partkey // 7)")}) AS t, trim({_pick_sql(ROOMS, "(p_partkey // 11)")}) AS r, trim({_pick_sql(NOTES, "(p_partkey // 13)")}) AS n FROM part)"""
_MIX = some("t", quality.A_LESSON, quality.A_NUMBER, quality.A_CLOCK)
_SEMI = "(length(t) - length(replace(t, ';', '')))"
_PARALLEL = f"(source = 'fit-schedule' AND lower(s) IN ('іноземна мова', 'англійська мова') AND {_SEMI} >= 3 AND NOT {some('t', classify.LINK)} AND NOT {_MIX})"
_PIECES = "list_filter(list_transform(string_split(s, ' / '), lambda x: trim(x)), lambda x: x <> '')"
_WRAPPED = (f"(NOT ({some('s', classify.LINK, classify.TEACHER, quality.A_TRAILING_ROOM, r'[0-9]{2}.[0-9]{2}.[0-9]{4}')} OR {room_sql('s')} OR {some('s', *classify.ROOMISH)}) AND len({_PIECES}) >= 3 "
            f"AND len(list_filter({_PIECES}, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) = 0 AND len(list_filter({_PIECES}[2:], lambda x: NOT regexp_matches(x, '^(\\(|\\p{{Ll}})'))) = 0 "
            f"AND {some('s', quality.A_LESSON)})")
_LONG = f"(length(s) > 220 OR {garbage_sql('s')})"
_FLAGS = {
    "missing_day": "day = ''", "missing_time": "(a = '' OR b = '')", "missing_subject": "s = ''",
    "subject_contains_room": f"({room_sql('s')} OR {some('s', *classify.ROOMISH, quality.A_TRAILING_ROOM)})",
    "subject_contains_teacher": f"({some('s', classify.TEACHER)} OR len(list_filter(regexp_extract_all(s, '[А-ЯІЇЄҐ][а-яіїєґ''’ʼ-]+\\s+[А-ЯІЇЄҐ]\\.\\s*(?:[А-ЯІЇЄҐ]\\.)?'), "
                                "lambda x: NOT regexp_matches(x, '[А-ЯІЇЄҐ]\\.\\s*[А-ЯІЇЄҐ]\\.$'))) > 0)",
    "subject_contains_link": some("s", classify.LINK),
    "service_text_subject": f"({some('s', *classify.ADMIN)} OR {service_sql('s')} OR {forbidden_sql(tokens_sql('s'))})",
    "subject_too_long": "length(s) > 140", "teacher_too_long": f"(length(t) > 180 AND NOT {_PARALLEL})",
    "inconsistent_columns": (f"({_MIX} OR {has('t', ('лек', 'практ'))} OR ({_SEMI} >= 5 AND NOT {_PARALLEL}) OR (r <> '' AND ({some('r', classify.TEACHER, classify.LINK, quality.A_TITLE)} OR length(r) > 80)) "
                             f"OR length(n) > 240 OR (length(n) > 80 AND {service_sql('n')}) OR ((length(s) - length(replace(s, ' / ', ''))) / 3 >= 2 AND NOT {_WRAPPED}) "
                             f"OR regexp_matches(s, '[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{4}}') OR {has('s', quality.DASHES)} OR {_FRAGMENT_SQL.replace('(t', '(s').replace(' t ', ' s ')})"),
    "garbage_text": (f"({_LONG} OR {has('s', quality.PASSWORD_MARKS)} OR starts_with(s, '=') OR regexp_full_match(s, '[0-9]+') OR NOT regexp_matches(s, '\\p{{L}}') OR {all_of('s', seg.W_ABBREVIATION)} "
                     f"OR (NOT contains(s, ' ') AND ({code_token_sql('s')} OR regexp_full_match(s, '[A-Za-z0-9=._-]{{10,}}'))))"),
    "implausible_time": ("(list_contains(list_transform(list_filter([a, b], lambda x: x <> ''), lambda x: split_part(x, ':', 1)::INT * 60 + split_part(x, ':', 2)::INT < 420 "
                         "OR split_part(x, ':', 1)::INT * 60 + split_part(x, ':', 2)::INT > 1350), true) OR (a <> '' AND b <> '' AND (m < 30 OR m > "
                         "CASE WHEN regexp_matches(lower(s), 'кваліфікаційн[а-яі]+ робот|захист[а-яі]|атестаці[а-яі]|практик[а-яі]') THEN 360 ELSE 240 END)))"),
}


@query(f"""WITH {ROWS_SQL}, m AS (SELECT *, CASE WHEN a <> '' AND b <> '' THEN split_part(b, ':', 1)::INT * 60 + split_part(b, ':', 2)::INT - split_part(a, ':', 1)::INT * 60 - split_part(a, ':', 2)::INT END AS m FROM rows)
  SELECT p_partkey, array_to_string(list_sort(list_filter([{", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _FLAGS.items())}], lambda x: x IS NOT NULL)), ',') AS flags FROM m""")
def full_row_flags(spark, sf_dir):
    """Every quality flag over rows in which each is raised."""
    return quality.flagged(schedule_rows(spark, sf_dir)).select("p_partkey", F.array_join(F.array_sort("flags"), ",").alias("flags"))


@query(f"""WITH {ROWS_SQL}, d AS (SELECT p_partkey, {tokens_sql('s')} AS s, {tokens_sql('n')} AS n FROM rows),
  t AS (SELECT p_partkey, CASE WHEN s <> '' THEN s ELSE n END AS t FROM d)
  SELECT p_partkey FROM t WHERE NOT ({all_of('t', seg.W_DROP_SERVICE, seg.W_DROP_TECHNICAL, seg.W_DROP_DATES)} OR {some('t', *classify.ADMIN)} OR ({service_sql('t')} AND NOT {some('t', seg.A_EXAM)}))""")
def review_without_service_rows(spark, sf_dir):
    """Review rows without those that hold no class at all."""
    return quality.without_dropped(schedule_rows(spark, sf_dir), evidence=("notes",)).select("p_partkey")


#: Buckets: source, program, subjects, groups, notes; rows of a bucket take its subjects and notes in turn.
BUCKETS = (
    ("history-schedule", "032 Історія України", "Методика", "", "032 Історія України: семінар"), ("history-schedule", "032 Архівна справа", "Методика", "", "про архівна справа"),
    ("history-schedule", "Археологія", "Методика", "", "Археологія."), ("biomed-schedule", "Біологія клітини", "іноземна мова", "", "Біологія клітини; лаб"),
    ("biomed-schedule", "Біофізика", "(лаб", "G-1", ""), ("biomed-schedule", "Лаб.діагностика", "Ендокринологія з оцінкою результатів досліджень", "G", "перше ; друге"),
    ("biomed-schedule", "Іноземна мова", "Логіка мови", "G", "Іноземна мова, друге"), ("chem-schedule", "Хімія полімерів", "ВМС", "", "Хімія полімерів."),
    ("phys-schedule", "акад", "Оптика", "G", ""), ("phys-schedule", "Фізика timetable", "Оптика", "G", ""), ("phys-schedule", "Ботаніка та зоологія", "Оптика", "G", ""),
    ("phys-schedule", "Оптика хвиль", "ауд. 21", "G", ""), ("iht-schedule", "Матеріали E12", "Логіка", "G", ""), ("law-schedule", "2 академічна", "Право", "G", ""),
    ("econom-schedule", "Коваль І.", "Логіка", "G", ""), ("sociology-schedule", "English", "Логіка", "G", ""), ("sociology-schedule", "СОЦІОЛОГІЯ ПРАЦІ (С)", "Логіка", "G", ""),
    ("sociology-schedule", "Соціальна структура", "МЕТОДИ", "G", "Соціальна структура"), ("sociology-schedule", "Соціальна робота", "Методи", "", "Соціальна робота."),
    ("psy-schedule", "Психологія", "Логіка", "G", "вільний день"), ("psy-schedule", "Психологія праці", "Базова загальновійськова підготовка", "G", ""),
    ("psy-schedule", "Психологія мови", "Захист навчальної практики", "G", "інше"), ("mechmat-schedule", "Математика + лек", "Аналіз", "G", ""),
    ("geo-schedule", "Розклад", "Карти", "G", ""), ("geo-schedule", "Географія", "Карти", "G", "Географія"), ("geo-schedule", "geo-schedule", "Карти", "G", ""),
    ("geo-schedule", "Геоморфологія та палеогеографія", "Карти", "G", ""), ("geo-schedule", "географія малих міст", "Карти", "G", ""), ("geo-schedule", "Географія (пр)", "Карти", "G", ""),
    ("geo-schedule", "невідома програма", "Карти", "G", ""), ("geo-schedule", "Дуже довга назва програми про географію всіх материків і всіх океанів світу", "Карти", "G", ""),
)


def bucket_rows(spark, sf_dir):
    """Buckets of one to four rows, one bucket a supplier nation and list entry."""
    draw = lambda i: F.element_at(F.array(*[F.lit(b[i]) for b in BUCKETS]), (F.col("s_suppkey") % len(BUCKETS) + 1).cast("int"))
    rows = read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("faculty "), F.floor(F.col("s_suppkey") / (len(BUCKETS) * 4)).cast("string"), F.lit("-"), (F.col("s_suppkey") % 4).cast("string")).alias("faculty"), draw(0).alias("source_name"),
        draw(1).alias("program"), draw(2).alias("subject"), draw(3).alias("groups"), draw(4).alias("notes"), (F.col("s_suppkey") % 5).alias("k"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("k") % 4).cast("int"))))


_B = "(s_suppkey % {n} + 1)::INT".format(n=len(BUCKETS))
_BSQL = ", ".join(f"([{_quoted(b[i] for b in BUCKETS)}])[{_B}] AS {name}" for i, name in enumerate(("src", "prog", "subj", "grp", "note")))
_ANCHOR = "(note <> '' AND c <> '' AND starts_with(note, c) AND (substr(note, length(c) + 1) = '' OR regexp_matches(substr(note, length(c) + 1), '^\\s*[:;,.]')))"
_FRAG = _FRAGMENT_SQL.replace("(t", "(subj").replace(" t ", " subj ")


def _rule_sql() -> str:
    of = lambda name, most: f"(src = '{name}-schedule' AND n <= {most})"
    one, no_parts = "(low IS NOT NULL AND low = high)", parts_sql("c")
    opaque = opaque_sql("c")
    fragmented = (f"(c = '' OR {some('c', classify.TEACHER, *quality.FRAGMENTED)} OR length(replace(c, '(', '')) <> length(replace(c, ')', '')) OR {opaque} OR regexp_matches(c, '^\\p{{Ll}}') "
                  f"OR (contains(c, '+') AND {some('c', quality.A_LESSON)}))")
    letters, upper = "length(regexp_replace(c, '\\P{L}', '', 'g'))", "length(regexp_replace(c, '\\P{Lu}', '', 'g'))"
    shouted = f"({letters} > 0 AND {upper} >= {letters} * 0.9 AND {some('c', *quality.A_UPPER_MARKS)})"
    rules = [
        ("history", f"({of('history', 3)} AND regexp_matches(c, '^[0-9]{{3}}\\s+') AND no_groups AND low IS NOT NULL AND none_same AND (anchored OR (noted AND named))) OR ({of('history', 1)} AND anchored AND others)"),
        ("biomed", f"({of('biomed', 2)} AND {one} AND low IN ({_quoted(quality.BIOMED_SUBJECTS)}) AND no_groups AND (anchored OR notes_begin)) OR ({of('biomed', 2)} AND (fragment OR (lower(c) = 'іноземна мова' AND anchored AND others))) "
                   f"OR ({of('biomed', 3)} AND lower(c) IN ({_quoted(quality.LAB_PROGRAMS)}) AND noted AND {one} AND low = '{quality.LAB_SUBJECT}' AND listed AND loose)"),
        ("chem", f"{of('chem', 3)} AND anchored AND no_groups AND {one} AND {all_of('low', quality.C_SHORT_UPPER, flags='')}"),
        ("phys", f"src = 'phys-schedule' AND ({all_of('c', quality.W_PHYS_TITLE)} OR {some('c', r'(?:^| )(?:timetable|sem[.])', r'(?:^|[^0-9])20[0-9][0-9](?:$|[^0-9])')})"),
        ("phys_small", f"{of('phys', 3)} AND ({some('c', classify.TEACHER)} OR NOT {has('c', quality.PHYS_SAFE)} OR loose_subject)"),
        ("iht", f"{of('iht', 3)} AND {codes_sql('c')} >= 1"), ("law", f"{of('law', 3)} AND {all_of('c', r'[0-9]+ *академ[а-яіїєґ]*')}"),
        ("econom", f"{of('econom', 2)} AND {all_of('c', quality.C_ECONOM_NAME, flags='')}"),
        ("sociology", f"{of('sociology', 3)} AND (lower(c) IN ('english', 'англ.мова') OR {shouted} OR {some('c', classify.TEACHER)} OR (notes_are_program AND shouted) OR ({one} AND low <> c AND no_groups AND anchored))"),
        ("psy", f"{of('psy', 3)} AND ((n = 1 AND study) OR ({one} AND low = '{quality.MILITARY}') OR (study AND military) OR (n = 1 AND {one} AND low = '{quality.PRACTICE}' AND noted AND NOT anchored) OR (n <= 2 AND study AND no_groups))"),
        ("mechmat", f"{of('mechmat', 1)} AND (contains(c, '+') OR {some('c', quality.A_LESSON)})"),
        ("any", f"n <= 3 AND (bad OR {some('c', *quality.TINY_BAD)} OR {fragmented} OR length(c) >= 70 OR lower(c) IN ('', 'unknown program', 'невідома програма') OR lower(c) = replace(src, '-', ' ') OR lower(c) = src OR lower(c) = lower(fac))"),
    ]
    del no_parts
    return "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in rules) + " END"


@query(f"""WITH labels AS (SELECT DISTINCT ([{_quoted(b[1] for b in BUCKETS)}])[{_B}] AS l FROM supplier),
  t AS (SELECT l, {tokens_sql('l')} AS t FROM labels), p AS (SELECT l, t, {parts_sql('t')} AS p FROM t){_steps()},
  j AS MATERIALIZED (SELECT *, array_to_string({_KEPT}, ' ; ') AS j FROM e), f AS MATERIALIZED (SELECT *, {_ALIAS} AS candidate FROM j),
  named AS MATERIALIZED (SELECT l, candidate AS c, (t <> '' AND (candidate = '' OR {bad_sql('t', 'p', 'candidate')})) AS bad FROM f),
  raw AS (SELECT 'faculty ' || (s_suppkey // {len(BUCKETS) * 4}) || '-' || (s_suppkey % 4) AS fac, {_BSQL}, unnest(range(0, (s_suppkey % 5) % 4 + 1)) AS copy FROM supplier),
  r AS (SELECT fac, src, prog, {tokens_sql('subj')} AS subj, {tokens_sql('grp')} AS grp, {tokens_sql('note')} AS note, c, bad FROM raw JOIN named ON prog = l),
  g AS (SELECT fac, prog, count(*) AS n, min(src) AS src, any_value(c) AS c, any_value(bad) AS bad, bool_and(grp = '') AS no_groups, bool_and({_ANCHOR}) AS anchored, bool_and(NOT {_ANCHOR}) AS loose,
    min(subj) FILTER (subj <> '') AS low, max(subj) FILTER (subj <> '') AS high, bool_and(note <> '') AS noted,
    bool_and(len(list_filter(regexp_extract_all(lower(c), '[а-яіїєґa-z]{{5,}}'), lambda w: contains(lower(note), w))) > 0) AS named, bool_and(subj <> '' AND subj <> c) AS others,
    bool_and(subj = '' OR subj <> c) AS none_same, bool_or(contains(note, ' ; ')) AS listed, bool_or({_FRAG}) AS fragment,
    bool_or({room_sql('subj')} OR {some('subj', *classify.ROOMISH)} OR {_FRAG}) AS loose_subject, bool_or({all_of('note', seg.W_DROP_SERVICE)}) AS study, bool_and(note = c) AS notes_are_program,
    bool_and({all_of('subj', quality.C_LONG_UPPER, flags='')}) AS shouted, bool_or(subj = '{quality.MILITARY}') AS military, bool_and(starts_with(lower(note), lower(prog))) AS notes_begin
    FROM r GROUP BY fac, prog)
  SELECT fac AS faculty, prog AS program, n, {_rule_sql()} AS reason FROM g""")
def bucket_reasons(spark, sf_dir):
    """Why small buckets go to review, by rule list; null where they don't."""
    return quality.bucket_reasons(bucket_rows(spark, sf_dir)).select("faculty", "program", "n", "reason")


#: Subject and group cells; # stands for a part's size.
CELLS = (
    "Логіка 21#", "Логіка / А-12", "Логіка хімічний ф-т 12", "лек. Логіка", "(пр) Логіка та методи", "с: Логіка", "лаб) Хімія", "Логіка доц. Коваль І. П.", "Логіка, Коваль І. П.", "Логіка І. Коваль",
    "Логіка на 9:30", "12.09 Логіка", "9:30 Логіка", "12.09.2024 10:15 Логіка", "12.09, 13.09 вересня Логіка", "початок о 9:00 Логіка", "12.09 , Зустріч груп - Логіка", "соціол.культури",
    "Курс за вибором: Логіка мови + 2 пари", "Дисципліни вільного вибору студента: Етика", "Курс за вибором: 12", "# курс магістр", "2 курс бакалавр", "1 курс", "1 курс маг", "Історія / філософії / (лекції)",
    "Історія / Філософії / права", "група 1# ; декан факультету", "ОП Психологія", "освітні програми «Економіка»", "спеціальність: Право", "[1.0]", "ІПЗ-1# / ІПЗ-12", "12 студентів", "2024 н.р.", "потік 1 ; Право",
    "\"Міжнародне право\" денна форма навчання", "Коваль І. П. / Логіка", "Логіка", "214 ауд.", "12а каб", "307.0", "online", "корп. 3", "Б-21", "сем. ",
)


def cells(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    drawn = F.element_at(F.array(*map(F.lit, CELLS)), (F.col("p_partkey") % len(CELLS) + 1).cast("int"))
    return part.select(F.replace(drawn, F.lit("#"), F.col("p_size").cast("string")).alias("label")).distinct().withColumn("t", text.service_tokens(F.col("label")))


CELLS_SQL = f"""labels AS (SELECT DISTINCT replace(([{_quoted(CELLS)}])[(p_partkey % {len(CELLS)} + 1)::INT], '#', p_size::VARCHAR) AS l FROM part), t AS (SELECT l, {tokens_sql('l')} AS t FROM labels)"""


def _got(pattern: str, k: int, flags: str = "(?i)", x: str = "t") -> str:
    return f"regexp_extract({x}, '{flags}{re2(pattern)}', {k})"


def _trim_sql(x: str, signs: str) -> str:
    return f"regexp_replace({x}, '^[{signs}]+|[{signs}]+$', '', 'g')"


def _room_sql(x: str) -> str:
    r = f"regexp_replace({x}, '([0-9])\\.0($|[^\\p{{L}}\\p{{N}}_])', '\\1\\2')"
    return (f"CASE WHEN regexp_matches({r}, '(?i)^[0-9]{{1,4}}[A-Za-zА-ЯІЇЄҐ]?\\s*ауд\\.?$') THEN 'ауд. ' || regexp_extract({r}, '(?i)^([0-9]{{1,4}}[A-Za-zА-ЯІЇЄҐ]?)', 1) "
            f"WHEN regexp_matches({r}, '(?i)^[0-9]{{1,4}}[A-Za-zА-ЯІЇЄҐ]?\\s*каб\\.?$') THEN 'каб. ' || regexp_extract({r}, '(?i)^([0-9]{{1,4}}[A-Za-zА-ЯІЇЄҐ]?)', 1) "
            f"WHEN regexp_matches(lower({r}), '^(ауд\\.|каб\\.|корп\\.)') OR lower({r}) IN ('online', 'онлайн') THEN {r} ELSE 'ауд. ' || {r} END")


_MARK, _AFTER = _trim_sql(f"lower({_got(fields.LEADING_LESSON, 1)})", " .,:;"), _trim_sql(_got(fields.LEADING_LESSON, 2), " ,;/-")
_KIND = "CASE " + " ".join(f"WHEN {_MARK} IN ({_quoted(m)}) THEN '{k}'" for k, m in fields.LESSON_MARKS.items()) + " ELSE '' END"
_NAMED = f"{_got(fields.TRAILING_TEACHER, 2)} <> ''"
_TT = lambda k: _trim_sql(f"CASE WHEN {_NAMED} THEN {_got(fields.TRAILING_TEACHER, k)} ELSE {_got(fields.TRAILING_INITIAL, k, '')} END", " ,;/-")
_PREFIX = lambda k: "CASE " + " ".join(f"WHEN {some('t', p)} THEN {_trim_sql(_got(p, k), ' ,;')}" for p in fields.PREFIXES) + " ELSE '' END"


@query(f"""WITH {CELLS_SQL} SELECT l AS label, {_room_sql('t')} AS room,
  CASE WHEN {_KIND} <> '' AND {_AFTER} <> '' THEN {_AFTER} ELSE t END AS lesson_subject, CASE WHEN {_AFTER} <> '' THEN {_KIND} ELSE '' END AS lesson,
  CASE WHEN {_got(fields.TRAILING_ROOM, 2)} <> '' THEN {_trim_sql(_got(fields.TRAILING_ROOM, 1), ' /')} ELSE t END AS room_subject,
  CASE WHEN {_got(fields.TRAILING_ROOM, 2)} <> '' THEN {_room_sql(_got(fields.TRAILING_ROOM, 2))} ELSE '' END AS subject_room,
  CASE WHEN {_TT(1)} <> '' AND {_TT(2)} <> '' THEN {_TT(1)} ELSE t END AS teacher_subject, CASE WHEN {_TT(1)} <> '' THEN {_TT(2)} ELSE '' END AS subject_teacher,
  CASE WHEN {_got(fields.TIME_NOTE, 2)} <> '' THEN {_trim_sql(_got(fields.TIME_NOTE, 1), ' /,;')} ELSE t END AS note_subject, {_got(fields.TIME_NOTE, 2)} AS subject_note,
  CASE WHEN {_PREFIX(2)} <> '' THEN {_PREFIX(2)} ELSE t END AS dated_subject, CASE WHEN {_PREFIX(2)} <> '' THEN {_PREFIX(1)} ELSE '' END AS prefix,
  CASE WHEN {all_of('t', seg.W_DOTTED_LOWER)} THEN upper(t[1]) || t[2:] ELSE t END AS capitalised,
  CASE WHEN lower({_got(fields.COURSE, 2)}) LIKE 'маг%' THEN {_got(fields.COURSE, 1)} || ' магістр' WHEN lower({_got(fields.COURSE, 2)}) = 'бакалавр' THEN {_got(fields.COURSE, 1)} || ' бакалавр'
    ELSE {_got(fields.COURSE, 1)} END AS course FROM t""")
def field_peeling(spark, sf_dir):
    """What a subject cell holds besides the subject, taken off one kind at a time."""
    t = F.col("t")
    pairs = {"lesson": fields.without_lesson_mark(t), "room": fields.without_room(t), "teacher": fields.without_trailing_teacher(t), "note": fields.without_time_note(t), "dated": fields.without_prefix(t)}
    rest = {"lesson": "lesson", "room": "subject_room", "teacher": "subject_teacher", "note": "subject_note", "dated": "prefix"}
    columns = [c for k, (subject, other) in pairs.items() for c in (subject.alias(f"{k}_subject"), other.alias(rest[k]))]
    return cells(spark, sf_dir).select("label", fields.room_name(t).alias("room"), *columns, fields.capitalised(t).alias("capitalised"), fields.course_level(t).alias("course"))


def _noise_of(x: str) -> str:
    return (f"({technical_sql(x)} OR {some(x, *classify.URLISH)} OR {service_sql(x)} OR {some(x, *classify.ADMIN)} OR {some(x, classify.TEACHER)} "
            f"OR {all_of(x, seg.W_SURNAME, seg.W_INITIALS, seg.W_STUDENT_COUNT, seg.W_YEAR)} OR {some(x, *seg.A_GROUP_NOISE, seg.A_GROUP_DATE)} OR {has(compact_sql(x), seg.GROUP_NOISE_COMPACT)})")


_SIG = [f"regexp_replace({tokens_sql(_trim_sql(_got(p, 1, x='s'), chr(92) + '[' + chr(92) + ']{} '))}, '^([0-9]+)\\.0$', '\\1')" for p in (*fields.GROUP_SIGNALS, fields.QUOTED)]
_EXPLICIT = f"({some('s', seg.A_EXPLICIT_GROUP)} OR {all_of('s', seg.W_GROUP_CODE)})"
_FILLED = "FILTER (s <> '')"


@query(f"""WITH {CELLS_SQL}, u AS (SELECT l, t, unnest(range(1, len(x) + 1)) AS k, unnest(x) AS raw FROM (SELECT l, t, regexp_split_to_array(t, '\\s*[|;/]\\s*') AS x FROM t)),
  v AS (SELECT l, t, k, regexp_replace({_trim_sql(tokens_sql('raw'), chr(92) + '[' + chr(92) + ']{} ')}, '^([0-9]+)\\.0$', '\\1') AS s FROM u WHERE raw <> ''),
  w AS (SELECT l, t, k, CASE WHEN s = '' THEN '' {" ".join(f"WHEN {x} <> '' AND NOT {_noise_of(x)} THEN {x}" for x in _SIG)}
    WHEN {all_of('s', seg.W_STUDENT_COUNT, seg.W_YEAR)} OR {some('s', seg.A_GROUP_DATE)} THEN '' ELSE s END AS s FROM v),
  f AS (SELECT l, t, s, min(k) AS k, {_EXPLICIT} AS explicit FROM w WHERE s <> '' AND NOT {_noise_of('s')} GROUP BY l, t, s),
  g AS (SELECT l, coalesce(string_agg(s, '; ' ORDER BY k) FILTER (explicit), '') AS explicit, coalesce(string_agg(s, '; ' ORDER BY k), '') AS kept FROM f GROUP BY l)
  SELECT t.l AS label, CASE WHEN coalesce(explicit, '') <> '' THEN explicit
    WHEN {some('t', classify.LINK)} OR {service_sql('t')} OR {some('t', *classify.ADMIN)} OR {some('t', seg.A_GROUP_DATE)} THEN ''
    WHEN coalesce(kept, '') <> '' THEN kept WHEN {_noise_of('t')} THEN '' ELSE t END AS groups FROM t LEFT JOIN g ON t.l = g.l""")
def group_fields(spark, sf_dir):
    """The groups that a cell names."""
    return cells(spark, sf_dir).select("label", fields.group_field(F.col("t")).alias("groups"))


_CONTEXT = lambda a, b: f"({a} = '' OR {b} = '' OR contains({a}, {b}) OR contains({b}, {a}))"
GROUP_NAMES = ("", "ІПЗ - 1", "ІПЗ-11", "КН-2", "кн 2")


@query(f"""WITH r AS (SELECT p_partkey AS k, p_brand AS slot, p_size % 6 = 0 AS guest, ([{_quoted(GROUP_NAMES)}])[(p_partkey % 5 + 1)::INT] AS grp, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE (p_partkey % 3)::VARCHAR END AS course FROM part),
  n AS (SELECT *, {compact_sql('grp')} AS g FROM r), h AS (SELECT * FROM n WHERE NOT guest AND k % 8 = 1), q AS (SELECT * FROM n WHERE guest),
  m AS (SELECT h.k AS host, q.k AS guest, count(*) OVER (PARTITION BY q.k) AS hosts FROM h JOIN q ON h.slot = q.slot AND {_CONTEXT('h.g', 'q.g')} AND {_CONTEXT('h.course', 'q.course')})
  SELECT h.k, coalesce(count(m.guest), 0) AS merged, coalesce(string_agg('T' || m.guest, '; ' ORDER BY m.guest), '') AS teacher FROM h LEFT JOIN m ON h.k = m.host AND m.hosts = 1 GROUP BY h.k""")
def slot_context_merge(spark, sf_dir):
    """Guests go to the one host of their slot whose group and course can be theirs; blank ones fit any."""
    from tabulon.operators import merge

    k = F.col("p_partkey")
    names = F.element_at(F.array(*map(F.lit, GROUP_NAMES)), (k % 5 + 1).cast("int"))
    rows = read(spark, sf_dir, "part").select(
        k.alias("k"), F.col("p_brand").alias("slot"), (F.col("p_size") % 6 == 0).alias("guest"), fields.slot_key(names).alias("g"),
        F.when(k % 3 == 0, "").otherwise((k % 3).cast("string")).alias("course"))
    rows = rows.withColumn("teacher", F.when(F.col("guest"), F.concat(F.lit("T"), F.col("k").cast("string"))).otherwise(""))
    fits = fields.same_context(F.col("h.g"), F.col("g.g")) & fields.same_context(F.col("h.course"), F.col("g.course"))
    host = ~F.col("guest") & (F.col("k") % 8 == 1)
    out = merge.unique_match(rows, ["slot"], ["k"], host, F.col("guest"), fits, ["teacher"], by=("g", "course"))
    return out.where(host).select("k", "merged", "teacher")
