"""Column functions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from occrisk.functions import ages, codes, rates, text
from occrisk.functions import labels as L


def apply(spark, values, build, kind="string"):
    """Results of ``build(col)`` for each value, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", build(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_activity_prefix(spark):
    assert apply(spark, ["111", "0", "86305", " 8630 ", None], text.activity_prefix) == ["0111", "0000", "8630", "8630", None]


def test_basic_cause(spark):
    assert apply(spark, ["B342", "I10X", "I10", " J47 ", None], codes.basic_cause) == ["B34.2", "I10.X", "I10", "J47", None]


def test_certificate_code(spark):
    got = apply(spark, ["*I10X", "**B342", "*I10X*E149", "*A0001", "*ab", "*", "*J69.0", None], codes.certificate_code)
    assert got == ["I10", "B34.2", None, "A0001", None, None, "J69.0", None]


def test_comorbidity_code(spark):
    got = apply(spark, ["i10x", "Z800", "U071", "A000123", "A0", " e149 ", "s720"], codes.comorbidity_code)
    assert got == ["I10", None, "U07.1", "A000123", None, "E14.9", None]


def test_dictionary_code(spark):
    assert apply(spark, ["A000", "A0001", "A00", " B342 "], codes.dictionary_code) == ["A00.0", "A00.01", "A00", "B34.2"]


def test_competence(spark):
    values = ["2022/05", "*****", "2022/5", None, "2022/05\n"]
    assert apply(spark, values, lambda c: text.competence_part(c, 1)) == [2022, None, None, None, None]
    assert apply(spark, values, lambda c: text.competence_part(c, 2)) == [5, None, None, None, None]


@pytest.mark.parametrize(
    "birth, event, age, band",
    [
        ("29/02/2000", "28/02/2001", 0, "0-17"),
        ("29/02/2000", "01/03/2001", 1, "0-17"),
        ("15/08/1990", "15/08/2020", 30, "25-34"),
        ("16/08/1990", "15/08/2020", 29, "25-34"),
        ("01/10/2020", "01/05/2020", 0, "0-17"),  # born 5 months after
        ("01/05/2022", "01/05/2020", -2, None),  # born 2 years after
        ("31/02/1990", "01/05/2020", None, None),
        ("{ñ class}", "01/05/2020", None, None),
        ("", "01/05/2020", None, None),
        (None, "01/05/2020", None, None),
        ("1/2/1890", "01/05/2021", 131, "65+"),
    ],
)
def test_age(spark, birth, event, age, band):
    df = spark.createDataFrame([(birth, event)], "b string, e string").select(
        ages.day_month_year(F.col("b")).alias("b"), ages.day_month_year(F.col("e")).alias("e")
    )
    got = df.select(ages.whole_years_between(F.col("e"), F.col("b")).alias("a"))
    assert got.select("a", ages.age_band(F.col("a"))).first() == (age, band)


def test_age_bands(spark):
    values = [0.0, 17.0, 17.5, 18.0, 64.0, 65.0, 130.0, 131.0, -1.0, float("nan"), None]
    closed = apply(spark, values, lambda c: ages.age_band(c, L.OLDEST_CREDIBLE_AGE), "double")
    assert closed == ["0-17", "0-17", None, "18-24", "55-64", "65+", "65+", None, None, None, None]
    assert apply(spark, [17, 18, 64, 65, 131], ages.age_band, "int") == ["0-17", "18-24", "55-64", "65+", "65+"]


def test_accident_type(spark):
    values = ["Típico", "TÃ\xadpico", "TRAJETO", " Doença", "Ignorado", "Outro", None]
    assert apply(spark, values, text.accident_type) == ["típico", "típico", "trajeto", "doença", "ignorado", "outro", None]


def test_says_yes(spark):
    assert apply(spark, ["SIM", "Sim ", "Não", None], text.says_yes) == [True, False, False, None]


def test_placeholders(spark):
    assert apply(spark, ["{ñ class}", " {x", "000000", "515105-Agente", " 1234 ", "", None], text.occupation_code) == [
        None, None, None, "515105", "1234", "", None,
    ]
    assert apply(spark, ["{ñ class}", " Corte ", None], text.placeholder_to_null) == [None, "Corte", None]


def test_lookup_takes_whole_key(spark):
    assert apply(spark, ["1", "2", "9", "1.0", None], lambda c: text.lookup(L.SIM_SEX, c)) == ["M", "F", None, None, None]
    flag = lambda c: text.lookup(L.SIM_WORK_ACCIDENT, F.left(F.trim(c), F.lit(1)))
    assert apply(spark, ["1", "1.0", " 2.0", "9", "3", None], flag) == ["Sim", "Sim", "Não", "Ignorado", None, None]
    assert apply(spark, ["A", "1"], lambda c: text.lookup(L.CHAPTER_LABEL, c, L.UNCLASSIFIED))[1] == L.UNCLASSIFIED


def test_strip_all(spark):
    assert apply(spark, ["\t a b \xa0", " \n", "x"], text.strip_all) == ["a b", "", "x"]


@pytest.mark.parametrize(
    "cause, flag, category",
    [
        ("X60", None, "Suicídio"),
        ("X84.9", "Não", "Suicídio"),
        ("X84.X", None, "Causa externa – Outra (X)"),
        ("X85", None, "Homicídio / Agressão"),
        ("Y09.9", None, "Homicídio / Agressão"),
        ("Y09.X", None, "Causa externa – Outra (Y)"),
        ("Y10", None, "Causa externa – Intenção indeterminada"),
        ("Y34.X", None, "Causa externa – Outra (Y)"),
        ("Y83.1", None, "Complicação de procedimento médico"),
        ("Y85", None, "Causa externa – Outra (Y)"),
        ("X59", None, "Causa externa – Outra (X)"),
        ("V01", None, "Acidental – Trânsito"),
        ("V01", "Sim", "Acidental – Trabalho"),
        ("X70", "Sim", "Acidental – Trabalho"),
        ("S72.0", "Sim", "Traumatismo / Lesão (S)"),
        ("W19", "Não", "Acidental – Queda / Afogamento"),
        ("T14", None, "Intoxicação / Queimadura / Complicação cirúrgica (T)"),
        ("Z80", None, "Fator situacional / Histórico (Z)"),
        ("U07.1", None, "Natural – XXII: Especial (COVID-19)"),
        ("I21.9", None, "Natural – IX: Cardiovascular"),
        ("1", None, "Não classificado"),
        (None, None, "Não classificado"),
    ],
)
def test_death_category(spark, cause, flag, category):
    df = spark.createDataFrame([(cause, flag)], "c string, f string")
    assert df.select(codes.death_category(F.col("c"), F.col("f"))).first()[0] == category


@pytest.mark.parametrize(
    "a, b, digits, want",
    [(1, 8, 2, 12.5), (1, 8, 1, 12.5), (1, 16, 1, 6.3), (1, 800, 2, 0.13), (0, 7, 2, 0.0), (1, 0, 2, None), (None, 3, 2, None), (3, None, 2, None), (2, 3, 2, 66.67)],
)
def test_share(spark, a, b, digits, want):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    assert df.select(rates.share_pct(F.col("a"), F.col("b"), digits)).first()[0] == want


def test_rate_halves_round_up(spark):
    df = spark.createDataFrame([(1, 16000), (1, 2000000)], "a bigint, b bigint")
    got = [r[0] for r in df.select(rates.rate_per_mille(F.col("a"), F.col("b"), 3)).collect()]
    assert got == [0.063, 0.001]
    assert [r[0] for r in df.select(rates.ppm(F.col("a"), F.col("b"))).collect()] == [63, 1]


def test_score_bands(spark):
    values = [2999, 3000, 5999, 6000, 10000, 14999, 15000, None]
    assert apply(spark, values, rates.base_score, "bigint") == [1, 2, 2, 3, 4, 4, 5, None]


@pytest.mark.parametrize(
    "rate, fatality, aggravator, score",
    [(3000, 10000, 0, 2), (3000, 10001, 1, 3), (20000, 20000, 1, 5), (None, 20000, 1, None), (None, None, 0, None), (100, None, 0, 1)],
)
def test_score(spark, rate, fatality, aggravator, score):
    df = spark.createDataFrame([(rate, fatality)], "r bigint, f bigint")
    got = df.select(rates.fatality_aggravator(F.col("f")), rates.risk_score(F.col("r"), F.col("f"))).first()
    assert got == (aggravator, score)


def test_rounding_before_the_limit(spark):
    """0.0029999 rounds to 0.003 at six digits and therefore scores 2."""
    df = spark.createDataFrame([(29999996, 10**10)], "a bigint, b bigint")
    assert df.select(rates.base_score(rates.ppm(F.col("a"), F.col("b")))).first()[0] == 2


def test_year_of_file(spark):
    names = [
        "https://x/D.SDA.PDA.005.CAT.202306.ZIP", "d.sda.pda.005.cat.202201.zip", "cat2018-comp01-02-03-2019.csv",
        "cat-copmp-04-05-06.zip", "notes.csv", "dir2020/notes.csv",
    ]
    assert apply(spark, names, text.year_of_file) == [2023, 2022, 2019, 2021, None, None]


def test_labels_are_complete():
    letters = {chr(c) for c in range(ord("A"), ord("Z") + 1)}
    assert set(L.CHAPTER_LABEL) == letters and set(L.CONDITION_LABEL) == letters
    assert set(L.COMORBIDITY_CHAPTER_LABEL) == set("ABCDEFGHIJKLMNOPQR")
    assert set(L.DEATH_BY_LETTER) | {"V", "W"} == letters
