"""Records of sheets to normalized schedule rows, field by field, in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions import cleanup, fields, labels, programs, times
from tabulon.functions import segments as seg
from tabulon.functions.text import service_tokens
from tabulon.sources.scratch import kept

# Programs of sources that teach one.
SOURCE_PROGRAMS = {
    "chem-schedule": "Хімія", "geology-schedule": "Геологія", "journ-schedule": "Журналістика", "law-schedule": "Право",
    "philosophy-schedule": "Філософія", "sociology-schedule": "Соціологія",
}
BOTH_WEEKS = "Обидва"


def _also(a: Column, b: Column) -> Column:
    return F.array_join(F.array_distinct(F.filter(F.array(a, b), lambda x: x != "")), "; ")


def clean_subjects(df: DataFrame) -> DataFrame:
    """Subject, teacher, room, link, lesson kind and notes, with all that subject cells hold besides the subject moved to where it belongs."""
    df = df.withColumn("subject", service_tokens(F.col("subject")))
    subject, prefixes = fields.without_prefixes(F.col("subject"))
    df = df.withColumns({"subject": subject, "notes": F.array_join(F.array_distinct(F.filter(F.concat(F.array("notes"), prefixes), lambda x: x != "")), "; ")})
    df = df.withColumn("__p", cleanup.subject_parts(F.col("subject")))
    df = df.withColumns({"subject": service_tokens(F.col("__p.subject")), "teacher": _also(fields.teacher_field(service_tokens(F.col("teacher"))), F.col("__p.teacher")),
                         "room": _also(service_tokens(F.col("room")), F.col("__p.room")), "link": _also(F.col("link"), F.col("__p.link")),
                         "lesson_type": _also(F.col("lesson_type"), F.col("__p.lesson_type"))}).drop("__p")
    for taken, into in ((fields.without_lesson_mark, "lesson_type"), (fields.without_leading_teacher, "teacher"), (fields.without_time_note, "notes"),
                        (fields.without_room, "room"), (fields.without_trailing_teacher, "teacher")):
        subject, other = taken(F.col("subject"))
        df = df.withColumns({"subject": subject, into: _also(F.col(into), other)})
    subject = seg.non_class_subject(fields.capitalised(fields.unwrapped(F.col("subject"))))
    named = fields.elective(F.col("subject"))
    return df.withColumns({"subject": F.when(named != "", named).otherwise(subject), "groups": fields.group_field(service_tokens(F.col("groups"))),
                           "course": F.coalesce(F.nullif(fields.course_level(F.col("course")), F.lit("")), F.regexp_replace("course", r"^(\d+)\.0$", "$1"))})


def clean_times(df: DataFrame) -> DataFrame:
    """Day, week and clock times in their canonical forms; a missing bound and an impossible end are worked out."""
    given = times.parse_range(F.col("start_time"))
    df = df.withColumns({"day": times.weekday(F.col("day")), "__range": given})
    df = df.withColumns({"start_time": F.coalesce(F.nullif(F.col("__range.start"), F.lit("")), times.parse(F.col("start_time"))),
                         "end_time": F.coalesce(F.nullif(F.col("__range.end"), F.lit("")), times.parse(F.col("end_time")))}).drop("__range")
    df = df.withColumn("__b", times.filled_bounds(F.col("start_time"), F.col("end_time"), F.col("subject") != ""))
    df = df.withColumns({"__inferred": (F.col("__b.start") != F.col("start_time")) | (F.col("__b.end") != F.col("end_time")), "start_time": F.col("__b.start"), "end_time": F.col("__b.end")})
    df = df.withColumn("__end", times.repaired_end(F.col("start_time"), F.col("end_time")))
    df = df.withColumns({"__repaired": F.coalesce(F.col("__end") != F.col("end_time"), F.lit(False)), "end_time": F.coalesce("__end", "end_time")}).drop("__b", "__end")
    week = times.week_kind(F.col("week_type"))
    note = times.week_range_note(F.col("week_type"))
    return df.withColumns({"week_source": F.when(week != "", "explicit").otherwise("default"), "notes": _also(F.col("notes"), note),
                           "week_type": F.when(week != "", week).otherwise(BOTH_WEEKS)})


def is_no_class(df_columns: tuple[str, ...] = ("subject", "notes", "lesson_type")) -> Column:
    """A row without teacher, room and link that only says that there is no class."""
    marker = F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in df_columns])
    bare = (F.col("teacher") == "") & (F.col("room") == "") & (F.col("link") == "")
    return bare & (seg.is_non_schedule(marker) | seg.is_non_schedule_word(F.col("subject")))


def with_program(df: DataFrame) -> DataFrame:
    """The first label that may stand: of the row, its file, its sheet, or the source; '' if none may."""
    df = kept(df.withColumn("__file", labels.path_label(F.col("asset_locator"))), "normalized")
    every = df.select(F.explode(F.array_distinct(F.array("program", "__file", "sheet_name"))).alias("l")).distinct()
    names = kept(programs.judged(every), "program-labels")
    for c, name in (("program", "__row"), ("__file", "__path"), ("sheet_name", "__sheet")):
        df = programs.with_label(df, c, names, name)
    chosen = [F.when(programs.is_label(F.col(f"{n}_candidate"), F.col(f"{n}_bad")), F.col(f"{n}_candidate")) for n in ("__row", "__path", "__sheet")]
    source = F.element_at(F.create_map(*[F.lit(x) for kv in SOURCE_PROGRAMS.items() for x in kv]), F.lower("source_name"))
    out = df.withColumn("program", F.coalesce(*chosen[:2], source, chosen[2], F.lit("")))
    return out.drop("__file", *[f"{n}_{k}" for n in ("__row", "__path", "__sheet") for k in ("candidate", "bad")])


def normalized(records: DataFrame, assets: DataFrame) -> DataFrame:
    """Schedule rows of records (``records.tabular_records``); assets give source, name and hash by locator."""
    about = assets.select("locator", "source_name", "asset_kind", "content_hash")
    df = records.join(about, "locator").withColumnRenamed("locator", "asset_locator")
    df = df.withColumns({"program": F.lit(""), "__subject": F.col("subject"), "source_url_or_path": F.col("asset_locator"), "source_root_url": F.col("asset_locator")})
    # stored here: a later filter or join key would be pushed through all these steps, and each names its column many times
    df = kept(clean_times(clean_subjects(df)), "normalized-fields")
    actions = [("time_bounds_inferred", F.col("__inferred")), ("end_time_repaired", F.col("__repaired")), ("subject_cleaned", service_tokens(F.col("__subject")) != F.col("subject"))]
    df = df.withColumn("autofix_actions", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in actions]))).drop("__subject", "__inferred", "__repaired")
    warned = [(f"missing_{n}", F.col(c) == "") for n, c in (("day", "day"), ("time", "start_time"), ("subject", "subject"))]
    df = df.where(~is_no_class()).withColumn("warnings", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in warned])))
    return with_program(df.withColumn("faculty", labels.first_meaningful(F.element_at(F.split("asset_locator", "/"), -2), F.col("source_name"), fallback=labels.UNKNOWN)))
