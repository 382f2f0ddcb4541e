"""Queries that read every row and whole texts, on a small fixture against brute force."""

import re

import pytest

from corvidex.plans import registry

TEXTS = {
    1: "uno\nx\ndos",
    2: "  línea\tcon \x01 control\r\ny más  ",
    3: None,
    4: "pala-\nbra\n\n\n\nfin",
    5: "Hoy el Grupo Norte " + "y sigue " * 60 + "hasta Puerto Viejo. La empresa Grupo Azul financia a Puerto Viejo, y luego ONU Regional firma con Grupo Azul.",
    6: 'comillas "dobles" y \\ barra',
}
NAMES = ["Ａｃｔａ_01.pdf", "Отчёт 2 - final.PDF", "a\u200bb_c.txt", "Informe\u0301 x.pdf", "plano_uno.pdf", None]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame([(i, t, "s", f"título {i}" if i % 2 else " ") for i, t in TEXTS.items()], "doc_id bigint, text string, source string, title string").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(n,) for n in NAMES + NAMES], "nombre_archivo string").write.parquet(f"{base}/chunks.parquet")
    return base


def got(spark, base, name):
    return [tuple(r) for r in registry.QUERIES[name](spark, base).collect()]


def cleaned(t):
    t = re.sub(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ", t)
    t = re.sub(r"(\w)-\n(\w)", r"\1\2", t)
    t = re.sub(r"\n{3,}", "\n\n", t)
    t = "".join(" " if c == "\n" and "\n" not in (t[k - 1 : k], t[k + 1 : k + 2]) else c for k, c in enumerate(t))
    return re.sub(r" *\n *", "\n", re.sub(r"[ \t\u00a0\u2007\u202f]+", " ", t)).strip()


def test_clean_reads_every_text(spark, tables):
    assert dict(got(spark, tables, "q_clean")) == {i: t if t is None else cleaned(t) for i, t in TEXTS.items()}


def test_json_fields_read_every_text(spark, tables):
    want = {i: "\n\n".join(p for p in ((f"título {i}" if i % 2 else ""), (t or "").strip(" ")) if p) for i, t in TEXTS.items()}
    assert dict(got(spark, tables, "q_json_fields")) == want


def test_names_of_every_script(spark, tables):
    want = {(n, re.sub(r"[_\-\s]+", "", n.lower()), re.sub(r"[_\s]+", "-", n.strip().lower())) for n in NAMES if n}
    rows = got(spark, tables, "q_norm_names")
    assert set(rows) == want and len(rows) == len(want)


def test_relations_of_whole_texts(spark, tables):
    rows = sorted(r for r in got(spark, tables, "q_graph_relations_between") if r[0] == 5)
    # Grupo Norte .. Puerto Viejo is too far apart; then ". La empresa ", " financia a ", ", y luego ", " firma con "
    assert [r[2] for r in rows] == [None, "coocurre_con", "financia", "coocurre_con", "acuerda_con"]
