"""Column functions that clean fields, on small cases."""

import pytest
from pyspark.sql import functions as F

from tabulon.functions import fields
from tabulon.functions import segments as seg
from tabulon.functions.text import service_tokens

CASES = [
    (lambda t: fields.teacher_field(t), [("доц.; Коваль І. П.", "доц. Коваль І. П."), ("КовальІ. П. / Вовна О.В.", "Коваль І. П.; Вовна О.В."), ("проф", ""), ("Коваль І. П.; Коваль І. П.", "Коваль І. П.")]),
    (lambda t: fields.elective(t), [("Курс за вибором: Логіка мови + 2 пари", "Логіка мови"), ("Курс за вибором: 12", ""), ("Логіка", "")]),
    (lambda t: fields.unwrapped(t), [("Історія / філософії / (лекції)", "Історія філософії (лекції)"), ("Історія / Філософії / права", "Історія / Філософії / права"), ("а / б", "а / б")]),
    (lambda t: fields.without_leading_teacher(t)[0], [("Коваль І. П. / Логіка", "Логіка"), ("Коваль І. П. / ауд. 2", "Коваль І. П. / ауд. 2"), ("Логіка", "Логіка")]),
    (lambda t: fields.program_hint(t), [("примітка; 122 Комп'ютерні науки", "122 Комп'ютерні науки"), ("122 Науки та; про дані", "122 Науки та про дані"), ("122 Науки та", ""), ("122 А 126 Б", ""), ("", "")]),
    (lambda t: fields.program_name(t, F.lit(False)), [("постіиний", "Постійний"), ("cЛогіка", "C Логіка"), ("генетичнии аналіз", "Генетичний аналіз"), ("Право!", "Право")]),
    (lambda t: fields.program_name(t, F.lit(True)), [("Право", "")]),
    (lambda t: seg.is_subject_candidate(t).cast("string"), [("Логіка мови", "true"), ("ст.", "false"), ("ЛОГІКА", "false"), ("а, б", "true"), ("", "false")]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_fields(spark, case):
    f, pairs = CASES[case]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(pairs)], "i int, x string").withColumn("t", service_tokens(F.col("x")))
    got = [r.y for r in df.select("i", f(F.col("t")).alias("y")).orderBy("i").collect()]
    assert got == [want for _, want in pairs]
