"""Program labels and long cells, with literal expectations."""

from pyspark.sql import functions as F

from tabulon.functions import fields, programs

BAD = ["03quyIffb4u2KQDbqMZyE9.1", "0aegfNLd3WB.1", "1264456?p=8PUgDjlKBmu7iBeZYc", "kmj_hs=179&authuser=0&hl=ru", "bbz-nrfu-gne ; 308-а ; 02.03.2026", "yjw-wktj-mrf ; .com", "dr. VOLODYMYR SUDAKOV", "ауд. ; ЗАЛІК",
       "Rozklad ННІВТ 2 25 26", "асист.", ". Губіна К.Є", "3 курс", "ІК_ 884 766 8136 КД", "2 8 вересня (лекціі) 1 ии тиждень", "СІЧЕНЬ ЛЮТИИ", "АНГЛ.МОВА . ауд", "Економічна географія ; Управління розвитком ; туризму та рекреації",
       "English", "АНГЛ.МОВА", "Л-26год", "Коваль І. П."]
GOOD = {"Право ; Коваль І. П.": "Право", "Екологія": "Екологія", "Екологія моря": "Екологія моря"}


def test_labels_that_may_stand_and_may_not(spark):
    got = {r.label: r for r in programs.judged(spark.createDataFrame([(x,) for x in [*BAD, *GOOD]], "l string")).collect()}
    assert [x for x in BAD if not got[x].bad] == []
    assert {x: (got[x].candidate, got[x].bad) for x in GOOD} == {x: (name, False) for x, name in GOOD.items()}


def test_any_number_of_prefixes_and_parts(spark):
    many = " / ".join(f"Слово{k}" for k in range(1500))
    dated = "12.05.2024 9:00 " * 6 + "Логіка мови"
    one = lambda x, f: spark.createDataFrame([(x,)], "x string").select(f(F.col("x")).alias("y")).first()[0]
    assert one("Коваль І. П. / " + many, lambda t: fields.without_leading_teacher(t)[0]).count("/") == 1499
    subject, taken = (one(dated, lambda t, k=k: fields.without_prefixes(t)[k]) for k in (0, 1))
    assert subject == "Логіка мови" and len(taken) >= 6
    assert one("Логіка мови", lambda t: fields.without_prefixes(t)[1]) == []
