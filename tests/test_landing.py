"""Landing files: layouts, archives, encodings, quarantine, failures."""

import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from occrisk.sources import dictionaries, landing, notices, records
from occrisk.streaming.landing import checkpoint_dir, land_new_files, landed

LAYOUT_A = (
    "Agente  Causador  Acidente;Data Acidente;CBO;CBO;CID-10;CID-10;CNAE2.0 Empregador;CNAE2.0 Empregador;"
    "Indica acidente;Natureza da Lesão;Sexo;Data Acidente;Espécie do benefício",
    [
        "Faca;2019/03;515105;Agente;S681;Ferimento;111;Cultivo;Sim;Corte;Feminino;05/03/2019;Pa",
        '"Serra; de mesa";2019/03; 515110 ;Agente;NA;;4120;Obras;Não;"Disse ""ai""";Masculino;06/03/2019;Pa',
        "Faca;2019/03;515105;Agente;S681;x;;Sem atividade;Sim;Corte;Feminino;05/03/2019;Pa",
        "Faca;2019/03;515105;Agente;S681;x;111;Sem data;Sim;Corte;Feminino;  ;Pa",
        "Faca;2019/03;515105;Agente;S681;x;111;Larga;Sim;Corte;Feminino;05/03/2019;Pa;sobra",
        "",
    ],
)
LAYOUT_B = (
    "Data Acidente;CBO;CID-10;CNAE2.0 Empregador;Indica Óbito Acidente;Data Acidente;Data Acidente;CNAE2.0 Empregador",
    ["2022/05;515105-Agente - de saúde;B34.2 Infecc p/Coronavirus;8630;Não;x;20/05/2022;Saúde"],
)
LAYOUT_C = (
    "CBO;CBO;CID-10;CID-10;CNAE2.0 Empregador;CNAE2.0 Empregador;Indica Óbito Acidente;Data Acidente",
    ["515105;Agente;B34.2;Infecção;8630;Saúde;Sim;05/06/2023", "515106;Agente;B34.2;Infecção;8630;Saúde;Sim;05-06-2023"],
)
BOTH_MARKERS = "CBO;CBO;CID-10;CNAE2.0 Empregador;Indica Óbito Acidente;Data Acidente;Data Acidente;Data Acidente"
NEITHER = "CBO;CID-10;CNAE2.0 Empregador;Indica acidente;Data Acidente"


def text_of(layout) -> bytes:
    header, lines = layout
    return "\n".join([header, *lines]).encode("latin-1") + b"\n"


def zip_to(path, member: str, content: bytes) -> None:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("leia-me.txt", "x")
        archive.writestr(member, content)


@pytest.fixture()
def directory(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "cat2018-comp01-2019.csv").write_bytes(text_of(LAYOUT_A))
    zip_to(folder / "D.SDA.PDA.005.CAT.202205.ZIP", "CAT.CSV", text_of(LAYOUT_B))
    zip_to(folder / "D.SDA.PDA.005.CAT.202306.ZIP", "CAT.csv", text_of(LAYOUT_C))
    (folder / "D.SDA.PDA.005.CAT.202307.ZIP").write_bytes(b"no archive")
    (folder / "cat-2020.csv").write_bytes("Coluna;Outra\n1;2\n".encode())
    (folder / "notes.csv").write_bytes(b"CBO;CID-10\n1;2\n")
    (folder / "cat-2010.csv").write_bytes(text_of(LAYOUT_A))
    (folder / "dicionario-2022.xlsx").write_bytes(b"x")
    return str(folder)


def test_listing_and_pruning(spark, directory):
    files = landing.listing(spark, directory)
    kept = landing.prune_files(files, 2018, 2025).select("file_name", "formato", "ano")
    assert rows(kept) == [
        ("D.SDA.PDA.005.CAT.202205.ZIP", "ZIP", 2022),
        ("D.SDA.PDA.005.CAT.202306.ZIP", "ZIP", 2023),
        ("D.SDA.PDA.005.CAT.202307.ZIP", "ZIP", 2023),
        ("cat-2020.csv", "CSV", 2020),
        ("cat2018-comp01-2019.csv", "CSV", 2019),
    ]
    plan = files.select("ano")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


EXPECTED_GOOD = [
    # agent, competence, date, occupation, diagnosis, activity, death flag, lesion, file
    ("Faca", "2019/03", "05/03/2019", "515105", "S681", "111", "Sim", "Corte", "cat2018-comp01-2019.csv"),
    ("Serra; de mesa", "2019/03", "06/03/2019", "515110", None, "4120", "Não", 'Disse "ai"', "cat2018-comp01-2019.csv"),
    (None, "2022/05", "20/05/2022", "515105", "B34.2", "8630", "Não", None, "D.SDA.PDA.005.CAT.202205.ZIP"),
    (None, "2023/06", "05/06/2023", "515105", "B34.2", "8630", "Sim", None, "D.SDA.PDA.005.CAT.202306.ZIP"),
    (None, None, "05-06-2023", "515106", "B34.2", "8630", "Sim", None, "D.SDA.PDA.005.CAT.202306.ZIP"),
]
SHOWN = [
    "agente_causador", "data_competencia", "data_acidente", "cbo", "cid_10", "cnae_empregador_cod", "indica_obito",
    "natureza_lesao", "_source_file",
]


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_notices_of_all_layouts(spark, directory, tmp_path):
    flagged, status = notices.read_notices(spark, directory, 2018, 2025, str(tmp_path / "work"))
    good, bad = notices.split_quarantine(flagged)
    assert good.columns == notices.NOTICE_COLUMNS
    assert rows(good.select(SHOWN)) == sorted(EXPECTED_GOOD, key=key)
    assert sorted(r[0] for r in bad.select("cnae_empregador_desc").collect()) == ["Larga", "Sem atividade", "Sem data"]
    got = {r["_source_file"]: (r["layout"], r["status"], r["error"]) for r in status.collect()}
    assert got["cat2018-comp01-2019.csv"] == ("A", "ok", None)
    assert got["D.SDA.PDA.005.CAT.202205.ZIP"] == ("B", "ok", None)
    assert got["D.SDA.PDA.005.CAT.202306.ZIP"] == ("C", "ok", None)
    assert got["D.SDA.PDA.005.CAT.202307.ZIP"][1:] == ("error", "File is not a zip file")
    assert got["cat-2020.csv"][1:] == ("error", "no header found")


def test_landing_job_is_repeatable(spark, directory, tmp_path):
    target = str(tmp_path / "out")
    for _ in range(2):
        good = notices.land_notices(spark, directory, target, 2018, 2025, "2024-01-31")
        assert good.count() == len(EXPECTED_GOOD)
    stored = spark.read.parquet(f"{target}/quarantine")
    assert rows(stored.groupBy("_source_file", F.col("run_date").cast("string")).count()) == [
        ("cat2018-comp01-2019.csv", "2024-01-31", 3)
    ]
    assert spark.read.parquet(f"{target}/work/manifest").count() == 5


def test_all_files_bad(spark, tmp_path):
    (tmp_path / "D.SDA.PDA.005.CAT.202307.ZIP").write_bytes(b"no archive")
    zip_to(tmp_path / "D.SDA.PDA.005.CAT.202308.ZIP", "other.txt", b"x")
    with pytest.raises(RuntimeError, match="no notice file"):
        notices.read_notices(spark, str(tmp_path), 2018, 2025, str(tmp_path / "work"))
    with pytest.raises(ValueError, match="no notice files"):
        notices.read_notices(spark, str(tmp_path), 2000, 2001, str(tmp_path / "work"))


@pytest.mark.parametrize(
    "header, layout",
    [(LAYOUT_A[0], "A"), (LAYOUT_B[0], "B"), (LAYOUT_C[0], "C"), (BOTH_MARKERS, "B"), (NEITHER, "C")],
)
def test_layout_detection(spark, header, layout):
    df = spark.createDataFrame([(header.split(";"),)], "h array<string>")
    assert df.select(notices.detect_layout(landing.rename_repeats(F.col("h")))).first()[0] == layout


def test_repeats_are_numbered(spark):
    df = spark.createDataFrame([(["a", "b", "a", "a", "b"],)], "h array<string>")
    assert df.select(landing.rename_repeats(F.col("h"))).first()[0] == ["a", "b", "a.1", "a.2", "b.1"]


def test_large_plain_file_is_split_and_loses_nothing(spark, tmp_path):
    lines = [f"{100000 + i};A;S00;x;8630;Saúde;Não;05/06/2023" for i in range(5000)]
    (tmp_path / "cat-2023.csv").write_bytes(text_of((LAYOUT_C[0], lines)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        flagged, _ = notices.read_notices(spark, str(tmp_path), 2023, 2023, str(tmp_path / "work"))
        assert records.text_lines(spark, str(tmp_path), landing.chosen(2023, 2023), "ISO-8859-1").rdd.getNumPartitions() > 3
        assert flagged.filter(~F.col("em_quarentena")).select("cbo").distinct().count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


WIDE = 70
TWINS = {
    # bytes that some line splitters take for line ends, quoted breaks, an inner quote, more columns than any fixed number
    "controls": "515105;Pon\x85to \x0b\x0c\x1c\x1d\x1e fim;B34.2;x;8630;Saúde;Sim;05/06/2023",
    "quoted_break": '515106;"Duas\nlinhas; com ""aspas""";B34.2;x;8630;Saúde;Sim;05/06/2023\n515107;A;B34.2;x;8630;Saúde;Sim;06/06/2023',
    "inner_quote": '515108;5" cano;B34.2;x;8630;Saúde;Sim;05/06/2023\n515109;6" cano;B34.2;x;;Saúde;Sim;05/06/2023',
    "crlf": "515110;A;B34.2;x;8630;Saúde;Sim;05/06/2023\r\n515111;B;B34.2;x;8630;Saúde;Sim;05/06/2023\r",
    "wide": "515112;A;B34.2;x;8630;Saúde;Sim;05/06/2023;" + ";".join(f"v{n}" for n in range(WIDE - 8)),
    "too_wide": "515113;A;B34.2;x;8630;Saúde;Sim;05/06/2023;" + ";".join(f"v{n}" for n in range(WIDE - 7)),
}


@pytest.mark.parametrize("kind", TWINS)
def test_plain_and_zipped_twins_are_equal(spark, tmp_path, kind):
    header = LAYOUT_C[0] + ";" + ";".join(f"Extra {n}" for n in range(WIDE - 8)) if "wide" in kind else LAYOUT_C[0]
    content = f"{header}\n{TWINS[kind]}\n".encode("latin-1")
    (tmp_path / "cat-2023.csv").write_bytes(content)
    (tmp_path / "cat-2022.CSV").write_bytes(text_of(LAYOUT_C))
    zip_to(tmp_path / "D.SDA.PDA.005.CAT.202306.ZIP", "CAT.CSV", content)
    flagged, status = notices.read_notices(spark, str(tmp_path), 2023, 2023, str(tmp_path / "work"))
    assert {r["status"] for r in status.collect()} == {"ok"}
    columns = [c for c in flagged.columns if c != "_source_file"]
    plain = rows(flagged.filter("_source_file like '%.csv'").select(columns))
    assert plain == rows(flagged.filter("_source_file like '%.ZIP'").select(columns))
    assert len(plain) == {"quoted_break": 2, "inner_quote": 2, "crlf": 2}.get(kind, 1)
    assert [r[-1] for r in plain].count(True) == {"inner_quote": 1, "too_wide": 1}.get(kind, 0)


def test_a_repaired_file_leaves_quarantine(spark, directory, tmp_path):
    target = str(tmp_path / "out")
    notices.land_notices(spark, directory, target, 2018, 2025, "2024-01-31")
    header, lines = LAYOUT_A
    (tmp_path / "landing" / "cat2018-comp01-2019.csv").write_bytes(text_of((header, lines[:2] + [lines[3]])))
    notices.land_notices(spark, directory, target, 2018, 2025, "2024-01-31")
    assert spark.read.parquet(f"{target}/quarantine").count() == 1


def test_diagnosis_files_in_windows_encoding(spark, tmp_path):
    sub = "SUBCAT;CLASSIF;DESCRICAO\nA000;;Cólera – “clássica” \nA0001;;Outra\nB34;;Curta\nX;;\n;;Sem código\n"
    cat = "CAT;CLASSIF;DESCRICAO\nA00;;Cólera\nB34;;Categoria\n"
    (tmp_path / "SUB.CSV").write_bytes(sub.encode("cp1252"))
    (tmp_path / "CAT.CSV").write_bytes(cat.encode("cp1252"))
    read = lambda name, code: landing.named_records(spark, str(tmp_path / name), [code, "DESCRICAO"])
    got = rows(dictionaries.diagnosis_dictionary(read("SUB.CSV", "SUBCAT"), read("CAT.CSV", "CAT")))
    assert got == [("A00", "Cólera"), ("A00.0", "Cólera – “clássica”"), ("A00.01", "Outra"), ("B34", "Curta")]


def test_risk_grades(spark):
    sheet = spark.createDataFrame(
        [
            (1, "Seção", "A", "1"), (2, "Subclasse", "01.11-3/01", " 3 "), (3, "Subclasse", "01.11-3/02", "4"),
            (4, "Subclasse", "41.20-4/00", None), (5, "Subclasse", "41.20-4/01", "2"),
        ],
        "linha int, nivel string, codigo string, gr string",
    )
    assert rows(dictionaries.risk_grades(sheet, F.col("linha"))) == [("01113", 3), ("41204", 2)]


def test_first_per_url(spark):
    df = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 2, "c")], "url string, rank int, name string")
    assert rows(landing.first_per_url(df, [F.col("rank")])) == [("u", 1, "a"), ("v", 2, "c")]


def test_streaming_landing_takes_each_file_once(spark, directory, tmp_path):
    target, checkpoint = str(tmp_path / "out"), checkpoint_dir(spark, "notices", str(tmp_path / "cp"))
    good = lambda first=2018: notices.split_quarantine(landed(spark, target, first, 2025))[0]
    land_new_files(spark, directory, target, checkpoint)
    assert rows(good().select(SHOWN)) == sorted(EXPECTED_GOOD, key=key)
    land_new_files(spark, directory, target, checkpoint)
    assert good().count() == len(EXPECTED_GOOD)
    zip_to(tmp_path / "landing" / "D.SDA.PDA.005.CAT.202401.ZIP", "CAT.CSV", text_of(LAYOUT_C))
    land_new_files(spark, directory, target, checkpoint)
    assert good().count() == len(EXPECTED_GOOD) + 2
    # a wider range finds the file of 2010, which an earlier run has taken
    assert good(2010).count() == len(EXPECTED_GOOD) + 4
    errors = {r[0] for r in spark.read.parquet(f"{target}/status").filter("error is not null").select("_source_file").collect()}
    assert errors == {"D.SDA.PDA.005.CAT.202307.ZIP", "cat-2020.csv"}
