"""Sequential operators against small plain models and hand-computed values."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corvidex.functions import text as T
from corvidex.operators import chunking, diversify, evaluate, fusion, graph, layout, lexical, vector
from corvidex.sources import files


def test_sentences_keep_abbreviations():
    assert chunking.sentences("El Dr. Ruiz vio 3.5 casos. EE.UU. firmó. «Sí.» Fin") == ["El Dr. Ruiz vio 3.5 casos.", "EE.UU. firmó.", "«Sí.", "Fin"]
    assert chunking.sentences("a. b\n\nc") == ["a.", "b", "c"]
    assert chunking.sentences(None) == [] and chunking.sentences("") == []


def test_windows_overlap_and_limits():
    rng = random.Random(3)
    sent = [" ".join("w" * rng.randint(2, 9) for _ in range(rng.randint(4, 30))) + "." for _ in range(80)]
    out = chunking.Windower()(" ".join(sent))
    assert all(len(c) <= 1200 and len(c.split()) <= 240 for c in out)
    for a, b in zip(out, out[1:]):  # whole sentences are carried over, at most 350 characters of them
        tail = [s for s in chunking.sentences(b) if s in chunking.sentences(a)]
        assert tail and len(" ".join(tail)) <= 500
    assert {s for c in out for s in chunking.sentences(c)} == set(sent)


def test_windows_of_long_sentences():
    long = " ".join(["palabra"] * 180)  # about 1440 characters: alone, uncut
    huge = " ".join(["palabra"] * 400)  # beyond the hard cap: cut
    out = chunking.Windower()(f"{long}. {huge}. Fin corto.")
    assert out[0] == f"{long}." and all(len(x) <= 1000 or x == out[0] for x in out)
    assert out[-1].endswith("Fin corto.")


def test_limit_words():
    assert chunking.limit_words("", 5) == [] and chunking.limit_words("a b", 5) == ["a b"]
    assert chunking.limit_words("a b c. d e f. g", 4) == ["a b c.", "d e f. g"]
    assert [len(x.split()) for x in chunking.limit_words("x " * 23, 10)] == [10, 10, 3]


def test_dedupe_drops_copies_and_wordless_rows(spark):
    t = "uno dos tres cuatro cinco seis siete ocho nueve diez once doce"
    rows = [("q", 1, 3.0, 1, t), ("q", 2, 2.0, 2, t.upper() + "!"), ("q", 3, 1.5, 3, "..."), ("q", 4, 1.0, 4, "otra cosa distinta"), ("q", 5, 0.5, 5, None), ("q", 6, 0.4, 6, t)]
    df = spark.createDataFrame(rows, "query_id string, chunk_id bigint, score double, rank int, text string")
    assert [r.chunk_id for r in diversify.deduplicate(df, window=5).orderBy("place").collect()] == [1, 4, 6]


def test_mmr_prefers_new_text(spark):
    t = "uno dos tres cuatro cinco seis siete ocho nueve"
    rows = [("q", 1, 1.0, 1, t), ("q", 2, 0.99, 2, t), ("q", 3, 0.9, 3, "algo por completo distinto de lo de arriba y largo"), ("q", 4, 0.1, 4, "fin")]
    df = spark.createDataFrame(rows, "query_id string, chunk_id bigint, score double, rank int, text string")
    assert [r.chunk_id for r in diversify.mmr(df, n=2, window=4).orderBy("place").collect()] == [1, 3, 2, 4]


def ranking(spark, rows):
    return spark.createDataFrame([("q", *r) for r in rows], "query_id string, channel string, chunk_id bigint, score double")


def test_rrf_and_combsum_by_hand(spark):
    r = ranking(spark, [("a", 1, 9.0), ("a", 2, 5.0), ("b", 2, 1.0), ("b", 3, 1.0), ("z", 9, 1.0), ("a", 8, None)])
    got = {x.chunk_id: x.score for x in fusion.rrf(r, {"z": 0}).collect()}
    assert got == {1: round(1 / 61, 9), 2: round(1 / 62 + 1 / 61, 9), 3: round(1 / 62, 9)}
    assert {x.chunk_id: x.score for x in fusion.combsum(r, {"z": 0}).collect()} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_one_channel_passes_through(spark):
    r = ranking(spark, [("a", 1, 9.0), ("a", 2, 5.0)])
    assert [(x.chunk_id, x.score) for x in fusion.rrf(r).orderBy("rank").collect()] == [(1, 9.0), (2, 5.0)]


def test_min_score_never_empties(spark):
    r = ranking(spark, [("a", 1, 0.9), ("a", 2, 0.1), ("b", 3, 0.2), ("b", 4, 0.1)])
    assert {x.chunk_id for x in fusion.min_score(r, 0.5).collect()} == {1, 3, 4}


def test_document_modes(spark):
    rows = [("q", i, s, i, d) for i, (s, d) in enumerate([(1.0, "a"), (0.9, "b"), (0.8, "b"), (0.7, "c"), (0.6, "d")], 1)]
    df = spark.createDataFrame(rows, "query_id string, chunk_id bigint, score double, rank int, doc_id string")
    top = lambda mode, **k: [r.doc_id for r in fusion.documents(df, mode, **k).orderBy("rank").collect()]
    assert top("max") == ["a", "b", "c"] and top("sum")[0] == "b" and top("mean")[0] == "b" and top("rankdecay")[0] == "b"
    assert top("max", pool=1) == ["a", "b", "c"]  # filled up beyond the pool
    with pytest.raises(ValueError):
        fusion.documents(df, "median")


def test_measures_by_hand(spark):
    hits = spark.createDataFrame([("q", 1, False), ("q", 2, True), ("q", 3, True)], "query_id string, rank int, hit boolean")
    rel = spark.createDataFrame([("q", 3), ("none", 0), ("absent", 2)], "query_id string, relevant int")
    got = {r.query_id: r for r in evaluate.measures(hits, rel, 3).collect()}
    assert got["q"].f1 == round(2 / 3, 6) and got["q"].rr == 0.5 and got["q"].ceiling == 1.0
    assert got["none"].f1 == got["none"].ndcg == got["absent"].rr == 0.0


def test_violations_name_each_rule(spark):
    doc, frag = Row(rank=1, doc_id="a"), Row(rank=1, chunk_id=1, doc_id="a", text="x " * 300)
    line = spark.createDataFrame([("q", [doc, doc, doc], [frag] * 10)], "query_id string, documents array<struct<rank:int,doc_id:string>>, fragments array<struct<rank:int,chunk_id:bigint,doc_id:string,text:string>>")
    assert {r.problem for r in evaluate.violations(line).collect()} == {"repeated_document", "long_fragment"}


def test_xy_order_and_columns():
    left = [(0, y, 90, y + 15, f"l{y}") for y in (100, 120, 140)]
    right = [(110, y, 200, y + 15, f"r{y}") for y in (100, 120, 140)]
    title = (0, 0, 200, 30, "t" * 80)
    rows = [right[1], left[0], title, right[0], left[2], left[1], right[2]]
    assert [r[4] for r in layout.order_page(rows, 200, 300)] == [title[4], "l100", "l120", "l140", "r100", "r120", "r140"]
    assert layout.count_columns(left + right, 7) == 2


def test_furniture_goes_last_and_input_can_win():
    rows = [(0, 0, 190, 10, "88 89"), (0, 20, 90, 40, "a" * 60), (110, 20, 200, 40, "b" * 60)]
    assert layout.order_page(rows, 200, 300)[-1][4] == "88 89"
    narrow = [(0, 0, 97, 9, "a"), (0, 10, 97, 19, "b"), (103, 0, 200, 9, "c"), (103, 10, 200, 19, "d")]
    assert layout.order_page(narrow, 200, 300, trust_input=True) == narrow


def test_heading_trail(spark):
    rows = [("d", 1, 1, "heading", "A"), ("d", 2, 2, "heading", "B"), ("d", 3, 0, "body", "x"), ("d", 4, 2, "heading", "C"), ("d", 5, 0, "body", "y")]
    out = layout.heading_trail(spark.createDataFrame(rows, "doc_id string, seq int, level int, label string, text string")).orderBy("seq").collect()
    assert out[2].heading_path == ["A", "B"] and out[4].heading_path == ["A", "C"]


def test_bm25_ties_nulls_and_empty(spark):
    c = spark.createDataFrame([(1, "rio agua"), (2, "rio agua"), (3, None), (4, "")], "chunk_id bigint, text string")
    q = spark.createDataFrame([("q", "agua rio rio"), ("n", None)], "query_id string, query string")
    got = lexical.bm25(c, q).orderBy("rank").collect()
    assert [(r.query_id, r.chunk_id) for r in got] == [("q", 1), ("q", 2)] and got[0].score == got[1].score
    assert lexical.bm25(c.limit(0), q).count() == 0


def test_dense_ignores_null_and_zero_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (50, [2.0, 0.0])], "chunk_id bigint, embedding array<float>")
    q = v.where("chunk_id = 50").withColumnRenamed("chunk_id", "query_id")
    assert [r.chunk_id for r in vector.dense_topk(v, q, 2).orderBy("rank").collect()] == [1, 2]
    sent, vector.SENT_FLOATS = vector.SENT_FLOATS, 1
    try:
        assert [r.chunk_id for r in vector.dense_topk(v, q, 2).orderBy("rank").collect()] == [1, 2]
    finally:
        vector.SENT_FLOATS = sent


def test_entities_and_relations(spark):
    found = {(w, g) for w, g, _, _ in graph.spans_of("La ONU habló con Juan Pérez de Torre. Ayer vino NATO/OTAN.")}
    assert ("ONU", "ORG") in found and ("NATO/OTAN", "ORG") in found and ("Juan Pérez de Torre", "MISC") in found and ("Ayer", "MISC") not in found
    r = spark.createDataFrame([(" firmó un acuerdo con ",), ("x" * 221,), ("",)], "t string").select(T.relation_type(F.col("t")).alias("r")).collect()
    assert [x.r for x in r] == ["acuerda_con", None, "coocurre_con"]


def test_json_schemas():
    alert = '{"alerta_meta": {"codigo": "7", "municipios": "X"}, "body_paragraphs": ["' + "palabra " * 25 + '"]}'
    text, title, _ = files.json_document(alert)
    assert text.startswith("Alerta: 7. Municipios: X\n\n") and title == "Alerta 7 — X"
    assert files.json_document('{"title": "T", "body": "b", "content": "c", "url": "u"}') == ("T\n\nb", "T", {"url": "u"})
    assert files.json_document("{bad") == ("", "", {}) and files.json_document(None)[0] == ""


def test_clean_order(spark):
    raw = "a\x07b  inno-\nvación\nlínea\n\n\n\nfin \t x \n"
    assert spark.createDataFrame([(raw,)], "t string").select(T.clean(F.col("t")).alias("t")).first().t == "a b innovación línea\n\nfin x"


def test_exact_html(spark):
    df = spark.createDataFrame([("<p>a &amp; b</p><script>x</script><nav>n</nav>c",), (None,)], "t string")
    assert [r.t for r in df.select(files.html_exact("t").alias("t")).collect()] == ["a & b\nc", None]


def test_extract_keeps_going(spark):
    df = spark.createDataFrame([("ok", bytearray(b"x")), ("bad", bytearray(b""))], "path string, content binary")

    def provider():
        def run(content, path):
            if not content:
                raise ValueError("empty")
            return [content.decode()]

        return run

    out = {r.path: (r.text, r.error) for r in files.extract(df, provider).collect()}
    assert out == {"ok": ("x", None), "bad": (None, "ValueError: empty")}


def test_boilerplate_edges(spark):
    rows = [("d", p, f"Cabecera\nlínea {p}\n{p}") for p in range(4)] + [("e", 1, "Cabecera\nx"), ("n", 1, None)]
    out = {(r.doc_id, r.page): r.text for r in files.boilerplate_free(spark.createDataFrame(rows, "doc_id string, page int, text string")).collect()}
    assert out["d", 2] == "línea 2" and out["e", 1] == "Cabecera\nx" and out["n", 1] is None


def test_stream_ingest(spark, tmp_path):
    from corvidex.streaming.ingest import ingest_texts

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Una frase. Otra frase.")
    for _ in range(2):  # a second run finds nothing new
        ingest_texts(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_standins(spark):
    from corvidex.functions import providers

    df = spark.createDataFrame([(1, "agua del rio"), (2, None)], "id bigint, text string")
    got = {r.id: r.embedding for r in providers.encode_texts(df, "id", "text").collect()}
    assert abs(sum(x * x for x in got[1]) - 1) < 1e-5 and not any(got[2])
