"""Queries of the scalar functions, over given tables and small fixed inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import classify, text, times, urls
from tabulon.plans.catalog import sql_values, values
from tabulon.plans.sched import SCHED_SQL, read, sched

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{sched}", SCHED_SQL)
        return f
    return add


@query(r"SELECT page_id, count(*) AS links, count(*) FILTER (l LIKE '/%') AS local_links FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)href\s*=\s*\"([^\"]*)\"', 1)) AS l FROM pages) GROUP BY page_id")
def page_link_extract(spark, sf_dir):
    each = read(spark, sf_dir, "pages").select("page_id", F.explode(urls.links(F.col("html"))).alias("l"))
    return each.groupBy("page_id").agg(F.count("*").alias("links"), F.count_if(F.col("l").startswith("/")).alias("local_links"))


@query(r"SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def page_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.title(F.col("html")).alias("title"))


@query("SELECT page_id, ((contains(lower(html), 'the '))::INT + (contains(lower(html), 'article'))::INT + (contains(lower(html), 'und'))::INT) AS score FROM pages")
def keyword_score(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.keyword_score(F.col("html"), ["the ", "Article", "und"]).alias("score"))


@query(r"""SELECT page_id, regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1) AS host, regexp_matches(url, '^[A-Za-z]+://([^/?#:]*\.)?example\.(org|net)([/?#:]|$)') AS allowed,
  split_part(url, '#', 1) AS address FROM pages""")
def domain_filter(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.allowed_domain(u, ["example.org", "example.net"]).alias("allowed"), urls.without_fragment(u).alias("address"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT page_id AS src, p.page_id * 7 % (SELECT count(*) FROM pages) AS dst FROM pages p UNION SELECT page_id, (page_id * 3 + 1) % (SELECT count(*) FROM pages) FROM pages),
  b AS (SELECT 1::BIGINT AS node, 0 AS depth UNION SELECT e.dst, b.depth + 1 FROM b JOIN e ON e.src = b.node WHERE b.depth < 4)
  SELECT node, min(depth)::INT AS depth FROM b GROUP BY node""")
def link_graph_bfs(spark, sf_dir):
    from tabulon.operators.graph import reachable
    pages = read(spark, sf_dir, "pages").select("page_id")
    n = pages.agg(F.count("*").alias("n"))
    p = pages.join(F.broadcast(n))  # one row
    edges = p.select(F.col("page_id").alias("src"), F.explode(F.array(F.col("page_id") * 7 % F.col("n"), (F.col("page_id") * 3 + 1) % F.col("n"))).alias("dst"))
    return reachable(edges, values(spark, [(1,)], "node long"), 4)


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g'))) AS flat_md5 FROM documents")
def text_normalize(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.flat(F.col("text")).cast("binary")).alias("flat_md5"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT::VARCHAR AS quantity FROM lineitem")
def numeric_artifact(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.without_zero_fraction(F.col("l_quantity").cast("string")).alias("quantity"))


SPACED = [("Л е к ц і я", "Лекція"), ("a b c d e f", "abcdef"), ("one two three four five six", "one two three four five six"), ("А л г е б р а", "Алгебра"), ("x y", "x y")]


@query(f"SELECT raw, want AS joined FROM ({sql_values([r for r in SPACED])}) t(raw, want)")
def collapse_letter_spacing(spark, sf_dir):
    return values(spark, [(r,) for r, _ in SPACED], "raw string").select("raw", text.unspaced_letters(F.col("raw")).alias("joined"))


TOKENS = [("ауд 12/лек", "ауд. 12 / лек."), ("практ....", "практ."), (" ; a|b ,", "a | b"), ("лек..", "лек."), ("x;y", "x ; y")]


@query(f"SELECT raw, want AS tokens FROM ({sql_values(TOKENS)}) t(raw, want)")
def service_tokens(spark, sf_dir):
    return values(spark, [(r,) for r, _ in TOKENS], "raw string").select("raw", text.service_tokens(F.col("raw")).alias("tokens"))


@query(r"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g')) AS t FROM documents),
  s AS (SELECT doc_id, t, string_split(t, ' ') AS w FROM t)
  SELECT doc_id, length(t) > 220 OR (len(w) >= 8 AND len(list_filter(w, lambda x: length(regexp_replace(x, '[^\p{L}\p{N}\p{M}_]', '', 'g')) <= 1)) >= len(w) * 0.45)
    OR (length(t) >= 80 AND length(t) - length(translate(t, '/|[]{}_=+', '')) >= length(t) * 0.18)
    OR (regexp_matches(t, '^[A-Za-z0-9+/=_-]{8,}$') AND (regexp_matches(t, '[0-9+/=_-]') OR (regexp_matches(t, '[A-Z]') AND regexp_matches(t, '[a-z]'))))
    OR (length(regexp_replace(lower(t), '[^\p{L}\p{N}\p{M}]', '', 'g')) >= 60 AND len(list_distinct(string_split(regexp_replace(lower(t), '[^\p{L}\p{N}\p{M}]', '', 'g'), ''))) <= 8) AS garbage FROM s""")
def garbage_classifier(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", classify.is_garbage(F.col("text")).alias("garbage"))


@query(r"""SELECT conv_id, turn, regexp_matches(text, '(?i)https?://\S|zoom|teams|meet') AS link, regexp_matches(text, '(?i)https?\s*:\s*/\s*/|www\.\S+') AS urlish,
  regexp_matches(trim(text), '^[A-Za-z0-9_-]{16,}$|^[0-9]+([._-][0-9]+)*$|^https?://') AS storage FROM conversations""")
def link_classifiers(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", classify.has_link(t).alias("link"), classify.is_urlish(t).alias("urlish"), classify.is_storage_id(t).alias("storage"))


LABELS = [("ауд. 215", "room"), ("корп. 2", "room"), ("корпоративна", "none"), ("проф. Іваненко І. І.", "teacher"), ("Вовна О. В.", "teacher"), ("декан факультету", "admin"),
          ("M O N D A Y", "spaced_weekday"), ("sheet3", "technical"), ("Залік", "forbidden"), ("Розклад занять на осінь", "service"), ("Алгебра", "none"), ("Computer Science", "none"),
          ("https://zoom.us/j/1", "link"), ("Іваненко Олена Петрівна", "person")]


@query(f"SELECT label, want AS kind FROM ({sql_values(LABELS)}) t(label, want)")
def label_classifiers(spark, sf_dir):
    x = F.col("label")
    kind = (F.when(classify.has_link(x), "link").when(classify.is_spaced_weekday(x), "spaced_weekday").when(classify.is_technical(x), "technical").when(classify.is_teacher(x), "teacher")
            .when(classify.is_room(x), "room").when(classify.is_admin(x), "admin").when(classify.is_service(x), "service").when(classify.is_person_name(x), "person")
            .when(classify.is_forbidden_subject(x), "forbidden").otherwise("none"))
    return values(spark, [(r,) for r, _ in LABELS], "label string").select("label", kind.alias("kind"))


TIMES = [("9.30", "09:30"), ("0930", "09:30"), ("800", "08:00"), ("8 0 0", "08:00"), ("25:99", "25:99"), ("2460", ""), ("о 14:10", "14:10"), ("12.05.2024", ""), ("", ""), ("пара", "")]


@query(f"SELECT raw, want AS parsed FROM ({sql_values(TIMES)}) t(raw, want)")
def time_parse(spark, sf_dir):
    return values(spark, [(r,) for r, _ in TIMES], "raw string").select("raw", times.parse(F.col("raw")).alias("parsed"))


RANGES = [("800-920", "08:00", "09:20"), ("8.40 – 10.15", "08:40", "10:15"), ("8 0 0 - 9 2 0", "08:00", "09:20"), ("840–925", "08:40", "09:25"), ("лекція 9:00-10:20 ауд", "09:00", "10:20"), ("нема", "", "")]


@query(f"SELECT raw, a AS start_time, b AS end_time FROM ({sql_values(RANGES)}) t(raw, a, b)")
def time_range(spark, sf_dir):
    r = times.parse_range(F.col("raw"))
    return values(spark, [(r[0],) for r in RANGES], "raw string").select("raw", r["start"].alias("start_time"), r["end"].alias("end_time"))


@query("""WITH {sched} SELECT k1, k2, k3, k4, k5, CASE WHEN end_time = '' AND subject <> '' THEN strftime(strptime(start_time, '%H:%M') + INTERVAL 80 MINUTE, '%H:%M') ELSE end_time END AS end_time,
  CASE WHEN k2 = 1 THEN strftime(strptime(start_time, '%H:%M') + INTERVAL 80 MINUTE, '%H:%M') ELSE start_time END AS repaired FROM sched""")
def time_infer_repair(spark, sf_dir):
    df = sched(spark, sf_dir)
    bounds = times.filled_bounds(F.col("start_time"), F.col("end_time"), F.col("subject") != "")
    wrong = F.when(F.col("k2") == 1, times.repaired_end(F.col("start_time"), F.lit("07:50"))).otherwise(F.col("start_time"))
    return df.select("k1", "k2", "k3", "k4", "k5", bounds["end"].alias("end_time"), wrong.alias("repaired"))


SPANS = [("08:00", "09:20", "Алгебра", 0), ("06:59", "09:00", "Алгебра", 1), ("08:00", "08:20", "Алгебра", 1), ("08:00", "13:00", "Алгебра", 1), ("08:00", "13:00", "Захисти робіт", 0), ("08:00", "14:30", "Практика", 1), ("", "22:40", "x", 1), ("", "", "x", 0)]


@query(f"SELECT a AS start_time, b AS end_time, s AS subject, w = 1 AS implausible FROM ({sql_values(SPANS)}) t(a, b, s, w)")
def implausible_time(spark, sf_dir):
    df = values(spark, [r[:3] for r in SPANS], "start_time string, end_time string, subject string")
    return df.withColumn("implausible", times.implausible(F.col("start_time"), F.col("end_time"), F.col("subject")))


WEEKS = [("Вехній", "Верхній"), ("Нижнй", "Нижній"), ("1-13 верхній", "Верхній"), ("2.0-8.0", "Обидва"), ("верхній / нижній", "Обидва"), ("ч/т", "Через тиждень"), ("щось", ""), ("", "")]


@query(f"SELECT raw, want AS week_type FROM ({sql_values(WEEKS)}) t(raw, want)")
def week_type(spark, sf_dir):
    return values(spark, [(r,) for r, _ in WEEKS], "raw string").select("raw", times.week_kind(F.col("raw")).alias("week_type"))


WEEKDAYS = [("ПОНЕДІЛОК", "Понеділок"), ("С е р е д а", "Середа"), ("КОЛІДЕНОП", "Понеділок"), ("п’ятниця (дистанційно)", "П'ятниця"), ("второк", "Вівторок"), ("вівторок 12.05", "Вівторок"), ("щось", "щось"), ("", "")]


@query(f"SELECT raw, want AS day FROM ({sql_values(WEEKDAYS)}) t(raw, want)")
def day_normalize(spark, sf_dir):
    return values(spark, [(r,) for r, _ in WEEKDAYS], "raw string").select("raw", times.weekday(F.col("raw")).alias("day"))


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def content_hash_dedup(spark, sf_dir):
    hashed = read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"))
    return hashed.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query(r"""SELECT DISTINCT p_type, regexp_replace(trim(regexp_replace(regexp_replace(p_type || ': v1/2?', '[<>:"/\\|?*]+', '_', 'g'), '\s+', ' ', 'g')), '^[ .]+|[ .]+$', '', 'g') AS slug FROM part""")
def slugify(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_type", text.file_slug(F.concat("p_type", F.lit(": v1/2?"))).alias("slug")).distinct()


@query("WITH {sched} SELECT DISTINCT course, trim(substr(course || ' курс ' || faculty || ' ' || faculty || ' ' || faculty, 1, 31)) AS label, faculty FROM sched")
def sheet_label(spark, sf_dir):
    long = F.concat_ws(" ", F.concat("course", F.lit(" курс")), "faculty", "faculty", "faculty")
    return sched(spark, sf_dir).select("course", text.sheet_title(long).alias("label"), "faculty").distinct()


@query("WITH {sched} SELECT k1, k2, k3, k4, k5, coalesce(nullif(trim(subject), ''), nullif(trim(teacher), ''), nullif(lesson_type, ''), 'Без назви') AS label FROM sched")
def coalesce_label(spark, sf_dir):
    return sched(spark, sf_dir).select("k1", "k2", "k3", "k4", "k5", text.first_filled(F.col("subject"), F.col("teacher"), F.col("lesson_type"), fallback="Без назви").alias("label"))


MIXED = [
    ("Алгебра (лек)", "Алгебра", "", "", "", "лекція"),
    ("Геометрія доц. Іваненко І. І. ауд. 101", "Геометрія", "доц. Іваненко І.І.", "ауд. 101", "", ""),
    ("[02.09, 09.09] Медіаправо (сем.)", "Медіаправо", "", "", "", "семінар"),
    ("Фізика 307", "Фізика", "", "ауд. 307", "", ""),
    ("Оптика https://zoom.us/j/1", "Оптика", "", "", "https://zoom.us/j/1", ""),
    ("12.05.2024 9:00 Захист практики", "Захист практики", "", "", "", ""),
    ("", "", "", "", "", ""),
]


@query(f"SELECT raw, a AS subject, b AS teacher, c AS room, d AS link, e AS lesson_type FROM ({sql_values(MIXED)}) t(raw, a, b, c, d, e)")
def record_cleanup(spark, sf_dir):
    from tabulon.functions import cleanup

    return values(spark, [(r[0],) for r in MIXED], "raw string").select("raw", cleanup.subject_parts(F.col("raw")).alias("p")).select("raw", "p.*")


ROOMS = [("307.0", "ауд. 307"), ("ауд307", "ауд. 307"), ("каб 12", "каб. 12"), ("online", "online"), ("", "")]


@query(f"SELECT raw, want AS room FROM ({sql_values(ROOMS)}) t(raw, want)")
def room_labels(spark, sf_dir):
    from tabulon.functions import cleanup

    return values(spark, [(r,) for r, _ in ROOMS], "raw string").select("raw", cleanup.room_label(F.col("raw")).alias("room"))


PLACES = [
    ("https://it.example.edu/files/IPZ_2_kurs.xlsx", "Факультет інформаційних технологій", "IPZ 2 kurs"),
    ("https://law.example.edu/uploads/pravo-magistry.pdf", "Юридичний факультет", "pravo magistry"),
    ("https://example.org/wp-content/uploads/12", "Невідомий факультет", "example"),
    ("archive.zip::Хімія/розклад.csv", "Невідомий факультет", "розклад"),
]


@query(f"SELECT locator, a AS faculty, b AS label FROM ({sql_values(PLACES)}) t(locator, a, b)")
def locator_labels(spark, sf_dir):
    from tabulon.functions import labels

    x = F.col("locator")
    hosts = {"it.example.edu": "Факультет інформаційних технологій", "law.example.edu": "Юридичний факультет"}
    return values(spark, [(r[0],) for r in PLACES], "locator string").select("locator", labels.faculty_of(x, hosts).alias("faculty"), labels.path_label(x).alias("label"))
