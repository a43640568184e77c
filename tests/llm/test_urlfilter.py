"""URL filter: rules, the split against all splits, verdicts and edge cases."""

import random

from pyspark.sql import functions as F

from tabulon.llm import urlfilter

PAGES = "page_id long, url string, html string, host string, rule string, n int"


def all_splits(run):
    for mask in range(2 ** (len(run) - 1)):
        cut, parts = 0, []
        for i in range(len(run) - 1):
            if mask >> i & 1:
                parts.append(run[cut : i + 1])
                cut = i + 1
        yield [*parts, run[cut:]]


def test_split_is_the_cheapest_of_all():
    rnd = random.Random(5)
    for _ in range(60):
        run = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))
        known = {(i, n): rnd.choice((900_000, 1_500_000, 2_000_000)) for i in range(len(run)) for n in range(1, len(run) - i + 1) if rnd.random() < 0.4}

        def cost(parts, known=known):
            at, total = 0, 0
            for p in parts:
                total += known.get((at, len(p)), 3_000_000 + 1_000_000 * len(p))
                at += len(p)
            return total, len(parts), " ".join(parts)

        assert urlfilter.cheapest_split(run, known, 3_000_000) == min(all_splits(run), key=cost)


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.ORG/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/", "block"), "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "x://example.org/en/2": ("example.org", "/en/2", "org/", "allow"), "https://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "https://org/": ("org", "/", "org/", "allow"), "https://x.com/fr/a/b#c": ("x.com", "/fr/a/b", "com/fr/", "allow"), "https://x.com:80/de/": ("x.com:80", "/de/", None, None),
        "https://x.com/de/://y": ("x.com", "/de/://y", "com/de/", "block"), "https://x.org?a/b": ("x.org", "", None, None), "no scheme/de/": ("", "", None, None), "": ("", "", None, None), None: ("", "", None, None),
        "https://Ä.net/ÄB\nc": ("Ä.net", "/ÄB\nc", None, None),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string").select("url", urlfilter.host_of(F.col("url")).alias("h"), urlfilter.path_of(F.col("url")).alias("p"))
    found = df.select("*", urlfilter.ruled(F.col("h"), F.col("p")).alias("f")).collect()
    assert {r.url: (r.h, r.p, r.f.rule if r.f else None, r.f.verdict if r.f else None) for r in found} == cases


def test_words_beside_seeds_are_learned_and_joined_names_split(spark):
    text = "<p>free casino pills garden book river</p>" * 3
    hosts = ["freecasino", "cheapcasino", "cheappills"] * 4 + ["gardenbook", "riverbook", "gardenriver", "bookgarden"] * 6
    rows = [(i, f"https://{h}.net/en/{i}", text, "x", None, 1) for i, h in enumerate(hosts)]
    rows += [(100, "https://cheapfree.net/en/1", None, "x", None, 1), (101, "https://riverbook.net/en/1", "", "x", None, 1), (102, None, "", "x", None, 1),
             (103, "https://" + "gardenbook" * 3000 + ".net/" + "casino1" * 3000, "<" * 5000, "x", None, 1), (103, "https://cheapfree.net/en/1", None, "x", None, 1)]
    out = urlfilter.judged(spark.createDataFrame(rows, PAGES)).select("row.page_id", "row.n", "verdict").collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.verdict for r in out if r.page_id < 103}
    assert {i for i, v in got.items() if v == "block"} == set(range(12)) | {100}
    assert "block" in [r.verdict for r in out if r.page_id == 103]


def test_empty_table(spark):
    assert urlfilter.judged(spark.createDataFrame([], PAGES)).count() == 0
