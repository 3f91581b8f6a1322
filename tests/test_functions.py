from pyspark.sql import functions as F

from folioforge.functions import metadata as M
from folioforge.functions import text as T
from folioforge.operators import segmentation as S


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


def test_cleaning(spark):
    clean = lambda t: one(spark, T.clean_text("t"), t=t)
    assert clean(" a b c⁠d﻿") == "a b c d"
    assert clean("a\r\nb\fc d") == "a\n\nb\nc\nd"
    assert clean("a\n\n\n\nb\x07\x00") == "a\n\nb"
    assert one(spark, T.clean_text("t", True), t="a \t  b") == "a b"
    assert clean(None) is None and clean("") == ""


def test_forms(spark):
    assert one(spark, T.comparison_form("t"), t="  Ñandú, ÀÉ—x2\n") == "nandu ae x2"
    assert one(spark, T.token_count("t"), t="Hola, mundo_1 — x²") == 5
    assert one(spark, T.join_lines("t"), t="inter-\nnational law\nof  seas") == "international law of  seas"
    assert one(spark, T.audit_form("t"), t=" a\tb c\x01") == "abc"


def test_scripts_and_language(spark):
    texts = {"ru": "Привет мир", "ar": "مرحبا بالعالم", "ja": "これは日本語の文章です漢字", "zh": "这是中文文章", "ko": "안녕하세요", None: "short", "en": "the cat is on the table and the dog was with it for all of the day", "es": "el gato está en la mesa y el perro es de la casa que no es muy grande", "pt": "o gato não está na mesa e o cão é da casa que não é muito grande mas sim"}
    df = spark.createDataFrame([(k, v) for k, v in texts.items()], "want string, text string")
    for r in T.with_language(df).collect():
        assert r.language == r.want, r
    empty = T.with_language(spark.createDataFrame([("",), (None,)], "text string")).collect()
    assert all(r.script is None and r.language is None for r in empty)


def test_dates(spark):
    cases = {"May 21, 2026": ("2026-05-21", "exact"), "2018-06-01T15:48:40+00:00": ("2018-06-01", "exact"), "01/04/2025": (None, "ambiguous"), "13/04/2025": ("2025-04-13", "exact"), "04/13/2025": ("2025-04-13", "exact"), "2024": ("2024-01-01", "inferred"), "3 de março de 2020": ("2020-03-03", "exact"), "2020-02-31": (None, "absent"), "soon": (None, "absent"), None: (None, "absent"), " ": (None, "absent")}
    for raw, want in cases.items():
        x = one(spark, M.normalize_date("t"), t=raw)
        assert (x.date, x.confidence) == want, raw


def test_names(spark):
    name = lambda u: one(spark, M.standard_name("u", F.lit("AB")), u=u)
    assert name("https://x.org/a/Informe%20Él_2.PDF?y=1") == "AB_informe-el-2.pdf"
    assert name("http://x/ab-report") == "AB_report.pdf"
    assert name("http://x/a+b.docx") == "AB_a-b.docx"
    assert one(spark, M.pad_code(F.col("c")), c="7-21") == "007-21"


def test_any_of_takes_the_longest(spark):
    import re

    p = re.compile(rf"\b{T.any_of(['de', 'del', 'desde', 'a'])}\b")
    assert p.findall("del a desde de dell") == ["del", "a", "desde", "de"]


def test_segments():
    got = S.segment("TITLE HERE\nthis is a long para-\ngraph of text that goes on.\n\n- item one\n12\nFoot", frozenset({"Foot"}))
    assert [g[0] for g in got] == ["heading", "paragraph", "list_item", "caption", "caption"]
    assert got[1][1] == "this is a long paragraph of text that goes on." and got[4][2]
    assert S.segment("  \n") == [] and S.segment("a   b", tabular=True)[0][0] == "table_text"


def test_layout(spark):
    columns = "\n".join(("Left column text line here" if i % 2 else " " * 48 + "right column text line") for i in range(12))
    table = "\n".join(f"row {i:04d} of a table".ljust(24) + " " * 12 + "value of the row" for i in range(8))
    assert one(spark, S.is_multicolumn(F.col("t")), t=columns) and not one(spark, S.is_multicolumn(F.col("t")), t=table)
    assert one(spark, S.is_tabular(F.col("t")), t=table) and not one(spark, S.is_tabular(F.col("t")), t=columns)
    assert not one(spark, S.is_tabular(F.col("t")), t="")
