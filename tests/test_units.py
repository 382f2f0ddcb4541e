"""Operators of pages, retrieval and planning on literal rows."""

from pyspark.sql import functions as F

from corvidex.functions import text as T
from corvidex.operators import evaluate, graph, layout, lexical
from corvidex.plans import inventory

SPAN = "doc_id int, page int, seq int, x0 double, y0 double, x1 double, y1 double, text string, size double, bold boolean, horizontal boolean, width double, height double"


def span(page, seq, x0, y0, text, size=10.0, bold=False, horizontal=True):
    return (1, page, seq, float(x0), float(y0), float(x0 + 100), float(y0 + size), text, size, bold, horizontal, 600.0, 800.0)


def test_page_units(spark):
    rows = [
        span(1, 1, 50, 20, "Título del informe", 20.0),
        span(1, 2, 50, 42, "en dos renglones", 20.0),
        span(1, 3, 50, 80, "Cuerpo uno"),
        span(1, 4, 160, 80, "sigue aquí"),
        span(1, 5, 50, 92, "y termina."),
        span(1, 6, 50, 110, "Nota de pie", 8.0),
        span(1, 7, 50, 130, "Sección", 10.0, True),
        span(1, 8, 50, 145, "Otro cuerpo con palabras de sobra."),
        span(1, 9, 550, 300, "GIRADO", 10.0, False, False),
        span(2, 10, 50, 20, "Continúa en otra página con más texto."),
        span(2, 11, 50, 60, "Capítulo", 20.0),
        span(2, 12, 50, 100, "Fin del cuerpo del documento."),
    ]
    got = [(r.page, r.kind, r.text, list(r.heading_path)) for r in layout.page_units(spark.createDataFrame(rows, SPAN)).orderBy("seq").collect()]
    title = "Título del informe en dos renglones"
    assert got == [
        (1, "heading", title, []),
        (1, "body", "Cuerpo uno sigue aquí y termina.", [title]),
        (1, "caption", "Nota de pie", [title]),
        (1, "heading", "Sección", [title]),
        (1, "body", "Otro cuerpo con palabras de sobra.", [title, "Sección"]),
        (2, "body", "Continúa en otra página con más texto.", [title, "Sección"]),
        (2, "heading", "Capítulo", []),
        (2, "body", "Fin del cuerpo del documento.", ["Capítulo"]),
    ]
    assert layout.page_units(spark.createDataFrame([], SPAN)).count() == 0


def test_index_ways_agree(spark, monkeypatch):
    """Terms matched within a row or joined give one index; so do feedback and expansion."""
    rows = [(1, "agua agua río minería"), (2, "río abajo la mina"), (3, None), (4, ""), (5, "informe de agua y minería ilegal")]
    chunks = spark.createDataFrame(rows, "chunk_id bigint, text string")
    queries = spark.createDataFrame([("q1", "minería del agua"), ("q2", None), ("q3", "río")], "query_id string, query string")

    def all_of():
        i = lexical.Index(chunks, queries)
        return [sorted(map(tuple, d.collect())) for d in (i.bm25(10), i.feedback_terms(2, 3), i.bm25(10, terms=i.expanded(2, 3)))]

    one = all_of()
    assert {(r[0], r[1]) for r in one[0]} == {("q1", 1), ("q1", 5), ("q3", 1), ("q3", 2)} and len(one[2]) >= len(one[0])
    monkeypatch.setattr(lexical, "ROW_TERMS", -1)
    assert all_of() == one


def test_graph_labels_by_the_text_between(spark):
    text = "Hoy Grupo Norte financia a Puerto Viejo, y Puerto Viejo " + "x" * 230 + " Alto Sur."
    c = spark.createDataFrame([(1, "d", text), (2, "d", None), (3, "d", "")], "chunk_id bigint, doc_id string, text string")
    m = graph.clean_mentions(graph.heuristic_mentions(c))
    kept = m.select("entity").distinct()
    got = {(r.a, r.b): r.relacion for r in graph.labelled_pairs(m, kept, c).collect()}
    assert got[("hoy grupo norte", "puerto viejo")] == "financia" and got[("alto sur", "hoy grupo norte")] == "coocurre_con"
    rows = spark.createDataFrame([("a", "b", i, f"d{i % 3}", "coocurre_con") for i in range(100)] * 2, "a string, b string, chunk_id bigint, doc_id string, relacion string")
    e = graph.edges(rows, 2).first()
    assert (e.peso, list(e.chunks), list(e.docs)) == (100, list(range(40)), ["d0", "d1", "d2"]) and graph.edges(rows, 101).count() == 0


def test_useful_and_matching_names(spark):
    rows = [("12 / 40", "body", False), ("uno dos tres", "body", False), ("uno dos tres cuatro", "body", True), ("1234 5678 90 a", "body", False), ("45%  mejor", "callout", True), ("—", "heading", False), (None, "body", False), (" ", None, False)]
    df = spark.createDataFrame(rows, "t string, k string, want boolean")
    assert all(r.got == r.want for r in df.select("want", T.is_useful(F.col("t"), F.col("k")).alias("got")).collect())
    names = spark.createDataFrame([("a/Informe_1.pdf", "informe-1.PDF", True), ("x1.pdf", "informe x1.pdf", True), ("b.pdf", "c.pdf", False), ("", "c.pdf", False)], "a string, b string, want boolean")
    assert all(r.got == r.want for r in names.select("want", evaluate.same_document(F.col("a"), F.col("b")).alias("got")).collect())


def test_fallback_ids_and_routing(spark):
    f = spark.createDataFrame([("b", None), ("a", "X"), ("c", "")], "path string, doc_id string")
    assert {tuple(r) for r in inventory.fallback_ids(f).select("path", "doc_id").collect()} == {("a", "X"), ("b", "DOC-00001"), ("c", "DOC-00002")}
    r = spark.createDataFrame([("./A",), ("a",), ("z",)], "path string")
    assert [x.path for x in inventory.routed_files(f, r).collect()] == ["a"]
