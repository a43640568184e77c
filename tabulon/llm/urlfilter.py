"""URL filter: rules by host and path, then naive Bayes over the words that host names are made of.

Names run words together, so every run of letters of a host or path is split by a unigram model: the words of all pages'
texts are counted, and Viterbi finds the cheapest split.  A known word costs the negative log of its share, an unknown
run of n letters that of 10 / (all words * 10^n).  Costs are whole millionths, so sums don't depend on their order; ties go to
fewer words, then to the split that sorts first.

A token counts once in a host and once in a path (a binary multinomial model), so one long url can't outweigh the others.

The training labels are ``SEEDS``: a page counts as bad if its segmented host holds one of these words.  A multinomial model over
all pages' host and path tokens (numbers read as 0) then gives the words beside them a weight as well, and scores every url.

Work is done once a distinct run, host and path shape; a page joins its pair's score.  The split's candidates come from a join of
substrings with the counted words, so no vocabulary is cut or held in a task, and a hot word, host or path is a hot side of a
sort-merge join, which AQE splits.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import slices, stored, table

#: (host, path, verdict): a rule fits its host and all subdomains, where the path begins with the rule's.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Words of a host that mark its pages as bad for training.
SEEDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "viagra")
#: A longer run of letters than a host label can be is read in parts of this length.
LONGEST = 63
_RUNS = rf"\p{{L}}{{1,{LONGEST}}}|[0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    return F.translate(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does; of equally long ones the first in code-point order."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r), reverse=True):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(pages: DataFrame, html_col: str = "html", seeds=SEEDS) -> DataFrame:
    """(word, n) over the texts of all pages, markup left out; every seed counts once more."""
    shown = F.regexp_replace(F.coalesce(html_col, F.lit("")), "<[^<>]*>", " ")
    words = pages.select(F.explode(F.regexp_extract_all(F.lower(shown), F.lit(rf"\p{{L}}{{1,{LONGEST}}}"), F.lit(0))).alias("word"))
    extra = pages.sparkSession.createDataFrame([(s,) for s in seeds], "word string")
    return words.groupBy("word").agg(F.count("*").alias("n")).unionByName(extra.withColumn("n", F.lit(1).cast("long"))).groupBy("word").agg(F.sum("n").alias("n"))


def cheapest_split(run: str, known: dict[tuple[int, int], int], base: int) -> list[str]:
    """The Viterbi split of ``run``; ``known`` has the costs of (start, length), ``base`` that of an unknown run of no letters."""
    best: list[tuple[int, int, str]] = [(0, 0, "")]
    for end in range(1, len(run) + 1):
        best.append(min((cost + known.get((at, end - at), base + 1_000_000 * (end - at)), n + 1, f"{words} {run[at:end]}")
                        for at, (cost, n, words) in enumerate(best)))
    return best[-1][2].split()


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, words): the distinct ``runs`` of letters, split."""
    total = words.agg(F.sum("n")).first()[0] or 1
    price = F.round(F.lit(1e6) * (F.log10(F.lit(float(total))) - F.log10(F.col("n").cast("double")))).cast("long")
    ends = "transform(sequence(1, length(run)), i -> transform(sequence(1, length(run) - i + 1), k -> struct(i, k, substr(run, i, k) AS word)))"
    parts = runs.select("run", F.explode(F.flatten(F.expr(ends))).alias("p")).select("run", "p.i", "p.k", "p.word")
    edges = parts.join(words.select("word", price.alias("cost")), "word").groupBy("run").agg(F.collect_list(F.struct("i", "k", "cost")).alias("known"))

    def split(batches):
        import math

        base = round(1e6 * (math.log10(total) - 1))
        for b in slices(batches):
            found = [cheapest_split(run, {(e["i"] - 1, e["k"]): e["cost"] for e in known or ()}, base) for run, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], names=["run", "words"])

    return runs.join(edges, "run", "left").select("run", "known").mapInArrow(split, "run string, words array<string>")


def unit_tokens(units: DataFrame, words: DataFrame) -> DataFrame:
    """(kind, key, token) of distinct (kind, key, unit) texts, each once: segmented words, and 0 for numbers."""
    runs = units.select("kind", "key", F.explode(F.regexp_extract_all(F.lower("unit"), F.lit(_RUNS), F.lit(0))).alias("run"))
    runs = stored(runs.distinct(), "url-runs")
    number = F.col("run").rlike("^[0-9]")
    split = segmented(runs.where(~number).select("run").distinct(), words)
    named = runs.where(~number).join(split, "run").select("kind", "key", F.explode("words").alias("token"))
    return named.unionByName(runs.where(number).select("kind", "key", F.lit("0").alias("token"))).distinct()


def judged(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules=RULES, seeds=SEEDS) -> DataFrame:
    """All columns of ``pages`` in a struct ``row``, with host, path, rule, verdict and score (millionths of a natural log ratio).

    The verdict is the fitting rule's, else block if the score is above 0.  A null url, or one without ``://``, has an empty host and
    path, and no tokens: only the share of bad pages speaks.  Null html counts as no words.  Repeated rows repeat; an empty table
    gives an empty result; extra columns of any name stay inside ``row``.
    """
    urls = pages.select(F.struct(*[c for c in pages.columns if c != html_col]).alias("row"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    shape = F.regexp_replace(F.lower("path"), "[0-9]+", "0")
    urls = stored(urls.select("row", "host", "path", F.md5(F.col("host").cast("binary")).alias("h"), F.md5(shape.cast("binary")).alias("p"), shape.alias("shape")), "url-parts")
    words = stored(word_counts(pages, html_col, seeds), "url-words")
    pairs = stored(urls.groupBy("h", "p").agg(F.count("*").alias("pages"), F.min("host").alias("host"), F.min("shape").alias("shape")), "url-pairs")
    units = pairs.select(F.explode(F.array(F.struct(F.lit("host").alias("kind"), F.col("h").alias("key"), F.col("host").alias("unit")),
                                           F.struct(F.lit("path").alias("kind"), F.col("p").alias("key"), F.col("shape").alias("unit")))).alias("u")).select("u.*")
    tokens = stored(unit_tokens(units.groupBy("kind", "key").agg(F.min("unit").alias("unit")), words), "url-tokens")

    bad_hosts = tokens.where((F.col("kind") == "host") & F.col("token").isin(*seeds)).select(F.col("key").alias("h"), F.lit(1).cast("long").alias("bad")).distinct()
    labelled = stored(pairs.join(bad_hosts, "h", "left").select("h", "p", "pages", F.coalesce("bad", F.lit(0).cast("long")).alias("bad")), "url-labelled")
    weight = labelled.select(F.explode(F.array(F.struct(F.lit("host").alias("kind"), F.col("h").alias("key")), F.struct(F.lit("path").alias("kind"), F.col("p").alias("key")))).alias("u"),
                             (F.col("pages") * F.col("bad")).alias("bad"), (F.col("pages") * (1 - F.col("bad"))).alias("good"))
    weight = weight.groupBy("u.kind", "u.key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = tokens.join(weight, ["kind", "key"]).groupBy("kind", "token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = stored(counts, "url-counts")
    v, bad, good = counts.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    million = lambda ratio: F.round(F.lit(1e6) * F.ln(ratio)).cast("long")
    share = ((F.col("bad") + 1.0) / F.lit(float(bad + v))) / ((F.col("good") + 1.0) / F.lit(float(good + v)))
    scores = tokens.join(counts.select("kind", "token", million(share).alias("w")), ["kind", "token"]).groupBy("kind", "key").agg(F.sum("w").alias("s"))
    scores = stored(scores, "url-scores")
    prior = labelled.agg(million((F.coalesce(F.sum(F.col("pages") * F.col("bad")), F.lit(0)) + 1.0) / (F.coalesce(F.sum(F.col("pages") * (1 - F.col("bad"))), F.lit(0)) + 1.0))).first()[0]
    of = lambda kind, key: scores.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("s").alias(f"s_{key}"))
    both = pairs.select("h", "p").join(of("host", "h"), "h", "left").join(of("path", "p"), "p", "left")
    zero = F.lit(0).cast("long")
    both = both.select("h", "p", (F.lit(prior) + F.coalesce("s_h", zero) + F.coalesce("s_p", zero)).alias("score"))
    found = ruled(F.col("host"), F.col("path"), rules)
    return urls.join(both, ["h", "p"]).withColumn("found", found).select(
        "row", "host", "path", "found.rule", F.coalesce("found.verdict", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "score")


def query(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages")).select("row.page_id", "host", "path", "rule", "verdict", "score")


SQL = r"""
WITH RECURSIVE u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest, coalesce(html, '') AS html FROM pages),
u2 AS (SELECT *, regexp_extract(rest, '(?s)^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '(?s)^[^?#]*') AS path, html FROM u2),
seeds AS (SELECT unnest(['adult', 'ads', 'bets', 'casino', 'pills', 'porn', 'spam', 'viagra']) AS word),
words AS (SELECT word, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(lower(regexp_replace(html, '<[^<>]*>', ' ', 'g')), '\p{L}{1,63}')) AS word FROM p UNION ALL SELECT word FROM seeds) GROUP BY word),
priced AS (SELECT word, round(1e6 * (log10((SELECT sum(n) FROM words)::DOUBLE) - log10(n::DOUBLE)))::BIGINT AS cost FROM words),
base AS (SELECT round(1e6 * (log10((SELECT sum(n) FROM words)::DOUBLE) - 1))::BIGINT AS b),
shaped AS (SELECT page_id, host, path, regexp_replace(lower(path), '[0-9]+', '0', 'g') AS shape FROM p),
units AS (SELECT DISTINCT 'host' AS kind, host AS unit FROM shaped UNION SELECT DISTINCT 'path', shape FROM shaped),
runs AS (SELECT kind, unit, unnest(regexp_extract_all(lower(unit), '\p{L}{1,63}|[0-9]+')) AS run FROM units),
letters AS (SELECT DISTINCT run FROM runs WHERE NOT regexp_matches(run, '^[0-9]')),
grown AS (
  SELECT run, 0::BIGINT AS pos, 0::BIGINT AS cost, 0 AS k, '' AS split FROM letters
  UNION ALL
  SELECT run, pos + n, e.cost + coalesce(w.cost, b + 1000000 * n), k + 1, split || ' ' || substr(run, pos + 1, n)
  FROM (SELECT g.run, g.pos, g.cost, g.k, g.split, unnest(range(1, length(g.run) - g.pos + 1)) AS n FROM grown g WHERE g.pos < length(g.run)) e
  CROSS JOIN base LEFT JOIN priced w ON w.word = substr(e.run, e.pos + 1, e.n)),
best AS (SELECT run, trim(arg_min(split, (cost, k, split))) AS split FROM grown WHERE pos = length(run) GROUP BY run),
tokens AS (SELECT DISTINCT kind, unit, token FROM (
    SELECT r.kind, r.unit, unnest(CASE WHEN b.run IS NULL THEN ['0'] ELSE string_split(b.split, ' ') END) AS token FROM runs r LEFT JOIN best b ON b.run = r.run)),
bad AS (SELECT DISTINCT unit AS host FROM tokens WHERE kind = 'host' AND token IN (SELECT word FROM seeds)),
labelled AS (SELECT s.*, s.host IN (SELECT host FROM bad) AS bad FROM shaped s),
counts AS (SELECT t.kind, t.token, count(*) FILTER (l.bad) AS b, count(*) FILTER (NOT l.bad) AS g
  FROM labelled l JOIN tokens t ON t.unit = CASE t.kind WHEN 'host' THEN l.host ELSE l.shape END GROUP BY ALL),
totals AS (SELECT count(*) AS v, sum(b) AS b, sum(g) AS g FROM counts),
weights AS (SELECT kind, token, round(1e6 * ln(((c.b + 1.0::DOUBLE) / (t.b + t.v)::DOUBLE) / ((c.g + 1.0::DOUBLE) / (t.g + t.v)::DOUBLE)))::BIGINT AS w FROM counts c CROSS JOIN totals t),
scores AS (SELECT kind, unit, sum(w)::BIGINT AS s FROM tokens JOIN weights USING (kind, token) GROUP BY ALL),
prior AS (SELECT round(1e6 * ln((count(*) FILTER (bad) + 1.0::DOUBLE) / (count(*) FILTER (NOT bad) + 1.0::DOUBLE)))::BIGINT AS s FROM labelled),
rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (SELECT s.page_id, s.host, s.path, s.shape,
    (SELECT arg_max(r.host || r.path || ' ' || r.verdict, length(r.host || r.path)) FROM rules r
      WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)) AS found FROM shaped s)
SELECT page_id, f.host, f.path, split_part(found, ' ', 1) AS rule,
  coalesce(split_part(found, ' ', 2), CASE WHEN pr.s + coalesce(h.s, 0) + coalesce(q.s, 0) > 0 THEN 'block' ELSE 'allow' END) AS verdict,
  (pr.s + coalesce(h.s, 0) + coalesce(q.s, 0))::BIGINT AS score
FROM fit f CROSS JOIN prior pr LEFT JOIN scores h ON h.kind = 'host' AND h.unit = f.host LEFT JOIN scores q ON q.kind = 'path' AND q.unit = f.shape
"""
