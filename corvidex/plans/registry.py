"""Every query of the engine by name, with the SQL that checks it.

Conventions: a chunk is a row of ``chunks`` (repeated deliveries count once),
its document ``doc_id``; queries are ``retrieval_queries``; channel rankings are
``channel_scores``; a query's vector is that of a chunk whose id is divisible
by 50.  Scores are rounded before ranking, so summation order decides no tie.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..operators import chunking, diversify, evaluate, fusion, graph, layout, lexical, vector
from ..session import materialise, table
from ..sources import files as sources
from . import inventory, retrieval

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


# ---- inputs ----------------------------------------------------------------


def once(spark: SparkSession, base: str, *cols: str) -> DataFrame:
    """(chunk_id bigint, cols...) of ``chunks``, each chunk_id once.  Ids are
    counted first; only the few texts delivered twice are exchanged."""
    src = table(spark, base, "chunks").withColumn("cid", F.col("chunk_id").try_cast("bigint")).where("cid is not null")
    twice = src.groupBy("cid").agg(F.count("*").alias("n")).where("n > 1").select("cid")
    pick = lambda d: d.select(F.col("cid").alias("chunk_id"), *cols)
    return pick(src.join(twice, "cid", "left_anti")).unionByName(pick(src.join(twice, "cid", "left_semi")).dropDuplicates(["chunk_id"]))


def asked(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "retrieval_queries").select("query_id", "query").distinct()


def channels(spark: SparkSession, base: str) -> DataFrame:
    c = table(spark, base, "channel_scores")
    return c.select("query_id", "channel", F.col("chunk_id").try_cast("bigint").alias("chunk_id"), F.round("score", 9).alias("score")).where("score is not null").distinct()


def docs(spark: SparkSession, base: str, *cols: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", *cols)


def tok(c: str) -> str:
    stop = ", ".join(f"'{w}'" for w in T.STOPWORDS)
    return rf"list_filter({words(c)}, lambda t: length(t) > 1 AND t NOT IN ({stop}))"


def words(c: str, fold: bool = True) -> str:
    low = f"lower(coalesce({c}, ''))"
    return rf"list_filter(string_split(regexp_replace({f'strip_accents({low})' if fold else low}, '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' '), lambda w: w <> '')"


def grams_sql(w: str, n: int) -> str:
    """n-grams of the word list ``w`` (a column)."""
    return f"CASE WHEN len({w}) = 0 THEN [] ELSE list_distinct(list_transform(range(0, greatest(len({w}) - {n}, 0) + 1), lambda i: array_to_string({w}[i + 1:i + {n}], ' '))) END"


CH = "ch AS (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, doc_id, fuente, fenomeno, texto FROM chunks)"
RQ = "rq AS (SELECT DISTINCT query_id, query FROM retrieval_queries)"
CS = "cs AS (SELECT DISTINCT query_id, channel, CAST(chunk_id AS BIGINT) AS chunk_id, round(score, 9) AS score FROM channel_scores WHERE score IS NOT NULL)"
BM = f"""{CH}, {RQ}, qt AS (SELECT DISTINCT query_id, unnest({tok('query')}) AS term FROM rq),
tk AS (SELECT chunk_id, {tok('texto')} AS toks FROM ch), st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM tk),
po AS (SELECT term, chunk_id, dl, count(*) AS tf FROM (SELECT chunk_id, len(toks) AS dl, unnest(toks) AS term FROM tk) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3),
iw AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, avgdl FROM (SELECT term, count(*) AS df FROM po GROUP BY 1), st),
bs AS (SELECT query_id, chunk_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) AS score FROM po JOIN iw USING (term) JOIN qt USING (term) GROUP BY 1, 2),
bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM bs)"""


# ---- text ------------------------------------------------------------------


@query(f"SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, {tok('text')} AS t FROM documents)")
def q_tokenize(spark, base):
    t = docs(spark, base, T.tokenize(F.coalesce("text", F.lit(""))).alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"))


@query(f"SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({tok('text')}) AS term FROM documents) GROUP BY 1")
def q_term_freq(spark, base):
    t = docs(spark, base, F.explode(T.tokenize(F.coalesce("text", F.lit("")))).alias("term"))
    per = t.groupBy("term", "doc_id").agg(F.count("*").alias("c"))  # two steps: no distinct set of a hot term in one task
    return per.groupBy("term").agg(F.sum("c").alias("tf"), F.count("*").alias("df"))


@query(r"""SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g')) AS norm, CAST(floor(length(text) / 2.8) + 2 AS INT) AS tokens FROM documents""")
def q_norm_text(spark, base):
    return docs(spark, base, T.norm_text(F.col("text")).alias("norm"), T.estimate_tokens(F.col("text")).alias("tokens"))


def _clean_sql(c: str) -> str:
    """The steps of ``clean``; lone line breaks in two passes, since a one-character line would need lookaround."""
    t = rf"regexp_replace({c}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', ' ', 'g')"
    for pattern, to in ((r"'([\p{L}\p{N}_])-\n([\p{L}\p{N}_])'", r"'\1\2'"), (r"'([\p{L}\p{N}_])-\n([\p{L}\p{N}_])'", r"'\1\2'"), (r"'\n\n\n+'", "chr(10) || chr(10)"), (r"'(^|[^\n])\n([^\n]|$)'", r"'\1 \2'"), (r"'(^|[^\n])\n([^\n]|$)'", r"'\1 \2'"), (r"'[ \t\x{00A0}\x{2007}\x{202F}]+'", "' '"), ("' *\\n *'", "chr(10)"), (r"'^\s+|\s+$'", "''")):
        t = f"regexp_replace({t}, {pattern}, {to}, 'g')"
    return f"trim({t})"


@query(f"SELECT doc_id, {_clean_sql('text')} AS cleaned FROM documents")
def q_clean(spark, base):
    return docs(spark, base, T.clean(F.col("text")).alias("cleaned"))


@query("SELECT doc_id, replace(replace(replace(text, chr(133), ' '), chr(8232), ' '), chr(8233), ' ') AS text FROM documents")
def q_sanitize(spark, base):
    return docs(spark, base, T.sanitize(F.col("text")).alias("text"))


@query(r"""SELECT doc_id, CASE WHEN length(l) BETWEEN 11 AND 149 THEN l ELSE trim(regexp_replace(s, '[_\-]+', ' ', 'g')) END AS title FROM (
 SELECT doc_id, trim(string_split(regexp_replace(text, '^\s+', ''), chr(10))[1]) AS l, regexp_replace(string_split(file_name, '/')[-1], '\.[^.]*$', '') AS s FROM documents)""")
def q_guess_title(spark, base):
    return docs(spark, base, T.guess_title(F.col("text"), F.col("file_name")).alias("title"))


@query(r"""SELECT DISTINCT nombre_archivo AS name, regexp_replace(lower(nombre_archivo), '[_\-\s]+', '', 'g') AS doc_key, regexp_replace(lower(trim(nombre_archivo)), '[_\s]+', '-', 'g') AS inv_key FROM chunks WHERE nombre_archivo IS NOT NULL""")
def q_norm_names(spark, base):
    n = table(spark, base, "chunks").select(F.col("nombre_archivo").alias("name")).where("name is not null").distinct()
    return n.select("name", T.norm_doc(F.col("name")).alias("doc_key"), T.norm_name(F.col("name")).alias("inv_key"))


_ALIASED = [k.upper() for k in T.ENTITY_ALIASES]
_KEY = r"trim(regexp_replace(strip_accents(lower(trim(name))), '[^\p{L}\p{N}_]+', ' ', 'g'))"


@query(f"""SELECT entity, count(*) AS n FROM (SELECT CASE {_KEY} {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in T.ENTITY_ALIASES.items())} ELSE {_KEY} END AS entity
 FROM (SELECT unnest([source, {_ALIASED}[1 + doc_id % {len(_ALIASED)}]]) AS name FROM documents)) GROUP BY 1""")
def q_norm_entity(spark, base):
    """Names of sources, and names written as aliases."""
    alias = F.array(*[F.lit(a) for a in _ALIASED])[(F.col("doc_id") % len(_ALIASED)).cast("int")]
    n = docs(spark, base, F.explode(F.array("source", alias)).alias("name"))
    return n.select(T.norm_entity(F.col("name")).alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))


def _relation_sql(c: str) -> str:
    return f"CASE WHEN length({c}) > 220 THEN NULL " + " ".join(f"WHEN regexp_matches(lower({c}), '{p}') THEN '{n}'" for p, n in T.RELATIONS) + " ELSE 'coocurre_con' END"


@query(f"SELECT doc_id, line_no, {_relation_sql('line')} AS relacion FROM (SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))")
def q_graph_relation_type(spark, base):
    """Relation each line of a text names."""
    x = docs(spark, base, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return x.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), T.relation_type(F.col("line")).alias("relacion"))


@query()
def q_graph_relations_between(spark, base):
    """Relation of every two neighbouring mentions over whole texts."""
    gaps = graph.gaps(docs(spark, base, "text").withColumnRenamed("doc_id", "chunk_id"))
    return gaps.select(F.col("chunk_id").alias("doc_id"), "gap_no", T.relation_type(F.col("between")).alias("relacion"))


@query(r"""SELECT doc_id, k AS window_no, len(w[k * 260 + 1:k * 260 + 300]) AS n_words FROM (SELECT doc_id, w, unnest(range(0, greatest(CAST(ceil((len(w) - 300) / 260.0) AS INT), 0) + 1)) AS k
 FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL))""")
def q_windows(spark, base):
    w = docs(spark, base, "text").where("text is not null").select("doc_id", F.posexplode(T.windows(F.col("text"))).alias("window_no", "x"))
    n = F.size(F.filter(F.split(F.col("x.text"), " "), lambda t: t != ""))
    return w.select("doc_id", F.col("window_no").cast("bigint").alias("window_no"), n.cast("bigint").alias("n_words"))


@query("SELECT doc_id, concat_ws(' — ', nullif(title, ''), concat_ws('. ', nullif(source, ''), text)) AS embed FROM documents")
def q_embedding_text(spark, base):
    return docs(spark, base, T.embedding_text(F.col("title"), F.col("source"), F.col("text")).alias("embed"))


# ---- retrieval -------------------------------------------------------------


def _bm25(spark, base, k=10):
    c = once(spark, base, F.col("texto").alias("text"))
    return lexical.bm25(c, asked(spark, base), k)


@query(f"WITH {BM} SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM bm WHERE rank <= 10")
def q_bm25_topk(spark, base):
    return _bm25(spark, base).select("query_id", "chunk_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH {BM}, fb AS (SELECT query_id, chunk_id FROM bm WHERE rank <= 10),
ct AS (SELECT query_id, term, count(*) AS c FROM fb JOIN (SELECT chunk_id, unnest(list_distinct(toks)) AS term FROM tk) USING (chunk_id) GROUP BY 1, 2),
wt AS (SELECT query_id, term, round(coalesce(nullif(c * coalesce(idf, 0), 0), c), 9) AS weight FROM ct LEFT JOIN iw USING (term) WHERE (query_id, term) NOT IN (SELECT (query_id, term) FROM qt))
SELECT query_id, term, round(weight, 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, term) AS r FROM wt) WHERE r <= 10""")
def q_rm3_expand(spark, base):
    c = once(spark, base, F.col("texto").alias("text"))
    return lexical.rm3_terms(c, asked(spark, base)).select("query_id", "term", F.round("weight", 6).alias("weight"))


def _vectors(spark, base):
    v = table(spark, base, "chunk_vectors").where("embedding is not null")
    return v.dropDuplicates(["chunk_id"])


@query("""WITH v AS (SELECT chunk_id, any_value(embedding) AS e FROM chunk_vectors WHERE embedding IS NOT NULL GROUP BY 1),
s AS (SELECT q.chunk_id AS query_id, v.chunk_id, round(list_cosine_similarity(q.e::DOUBLE[], v.e::DOUBLE[]), 9) AS score FROM v q, v WHERE q.chunk_id % 50 = 0 AND q.chunk_id <> v.chunk_id)
SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s) WHERE rank <= 5""")
def q_dense_topk(spark, base):
    v = _vectors(spark, base)
    top = vector.dense_topk(v, v.where("chunk_id % 50 = 0").withColumnRenamed("chunk_id", "query_id"), 5)
    return top.select("query_id", "chunk_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


WEIGHTS = {"bm25": 0.5, "grafo": 0.5, "rerank": 0.0}
_W = "CASE channel WHEN 'bm25' THEN 0.5 WHEN 'grafo' THEN 0.5 WHEN 'rerank' THEN 0.0 ELSE 1.0 END"
RRF = f"""{CS}, live AS (SELECT *, {_W} AS w FROM cs WHERE {_W} > 0),
rr AS (SELECT *, row_number() OVER (PARTITION BY query_id, channel ORDER BY score DESC, chunk_id) AS r, (SELECT count(DISTINCT channel) FROM live l WHERE l.query_id = live.query_id) AS nc FROM live),
rs AS (SELECT query_id, chunk_id, round(sum(CASE WHEN nc > 1 THEN w / (60 + r) ELSE score END), 9) AS score FROM rr GROUP BY 1, 2),
rrf AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM rs)"""
COMB = f"""{CS}, live AS (SELECT *, {_W} AS w, min(score) OVER p AS lo, max(score) OVER p AS hi FROM cs WHERE {_W} > 0 WINDOW p AS (PARTITION BY query_id, channel)),
cb AS (SELECT query_id, chunk_id, round(sum(w * (score - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END), 9) AS score FROM live GROUP BY 1, 2),
comb AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM cb)"""
_OUT = "query_id, chunk_id, round(score, 6) AS score, rank"


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("query_id", "chunk_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(f"WITH {RRF} SELECT {_OUT} FROM rrf")
def q_rrf(spark, base):
    return _ranked(fusion.rrf(channels(spark, base), WEIGHTS))


@query(f"WITH {COMB} SELECT {_OUT} FROM comb")
def q_combsum(spark, base):
    return _ranked(fusion.combsum(channels(spark, base), WEIGHTS))


@query(f"WITH {CS} SELECT query_id, channel, chunk_id, round(score, 6) AS score FROM (SELECT *, max(score) OVER (PARTITION BY query_id, channel) AS top FROM cs) WHERE score >= 0.8 OR top < 0.8")
def q_min_score(spark, base):
    return fusion.min_score(channels(spark, base), 0.8).select("query_id", "channel", "chunk_id", F.round("score", 6).alias("score"))


_EXPECT = r"coalesce(CASE WHEN regexp_extract(query_id, '\d+') = '' THEN 0 WHEN CAST(regexp_extract(query_id, '\d+') AS BIGINT) <= 16 THEN 1 WHEN CAST(regexp_extract(query_id, '\d+') AS BIGINT) <= 32 THEN 2 ELSE 3 END, 0)"


def _boosted(lift: str) -> str:
    return f"""bo AS (SELECT query_id, chunk_id, round(CASE WHEN fenomeno = {_EXPECT} AND {_EXPECT} > 0 THEN {lift} ELSE score END, 9) AS score
 FROM (SELECT *, max(score) OVER (PARTITION BY query_id) - min(score) OVER (PARTITION BY query_id) AS span FROM rrf JOIN ch USING (chunk_id))),
boost AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM bo)"""


def _meta(spark, base):
    return once(spark, base, "doc_id", F.col("fenomeno").alias("phenomenon"))


def _boost(spark, base, boost, mode):
    fused = fusion.rrf(channels(spark, base), WEIGHTS).join(_meta(spark, base), "chunk_id")
    return fusion.phenomenon_boost(fused.withColumn("expected", fusion.expected_phenomenon(F.col("query_id"))), boost, mode)


@query(f"WITH {RRF}, {CH}, {_boosted('score + 0.2 * span')} SELECT {_OUT} FROM boost")
def q_boost_add(spark, base):
    return _ranked(_boost(spark, base, 0.2, "add"))


@query(f"WITH {RRF}, {CH}, {_boosted('score * 1.08')} SELECT {_OUT} FROM boost")
def q_boost_mul(spark, base):
    return _ranked(_boost(spark, base, 0.08, "multiply"))


def _rerank_sql(src: str, depth: int) -> str:
    return f"""ce AS (SELECT query_id, chunk_id, score AS ce FROM cs WHERE channel = 'rerank'),
hd AS (SELECT {src}.query_id, {src}.chunk_id, {src}.score, {src}.rank, ce, rank <= {depth} AS head FROM {src} LEFT JOIN ce ON {src}.query_id = ce.query_id AND {src}.chunk_id = ce.chunk_id),
hm AS (SELECT *, CASE WHEN head THEN round(0.5 / (10 + rank) + 0.5 / (10 + row_number() OVER (PARTITION BY query_id, head ORDER BY ce DESC NULLS LAST, rank)), 9) END AS mixed FROM hd),
ranked AS (SELECT query_id, chunk_id, coalesce(mixed, score) AS score, row_number() OVER (PARTITION BY query_id ORDER BY head DESC, mixed DESC NULLS LAST, rank) AS rank FROM hm)"""


def _ce(spark, base):
    return channels(spark, base).where("channel = 'rerank'").select("query_id", "chunk_id", F.col("score").alias("ce_score"))


@query(f"WITH {RRF}, {_rerank_sql('rrf', 40)} SELECT {_OUT} FROM ranked")
def q_rerank_blend(spark, base):
    fused = fusion.rrf(channels(spark, base), WEIGHTS)
    return _ranked(fusion.rerank(fused.join(_ce(spark, base), ["query_id", "chunk_id"], "left"), 40, 0.5))


def _docs_sql(src: str, agg: str, bonus: bool = True) -> str:
    factor = " * (1 + 0.02 * least(count(*) - 1, 3))" if bonus else ""
    return f"""pl AS (SELECT {src}.query_id, {src}.chunk_id, {src}.score, {src}.rank, ch.doc_id, row_number() OVER (PARTITION BY {src}.query_id, ch.doc_id ORDER BY rank) AS hit FROM {src} JOIN ch USING (chunk_id)),
sd AS (SELECT query_id, doc_id, round({agg}{factor}, 9) AS score, min(rank) AS first, 0 AS beyond FROM pl WHERE rank <= 30 GROUP BY 1, 2),
al AS (SELECT * FROM sd UNION ALL SELECT query_id, doc_id, NULL, min(rank), 1 FROM pl WHERE rank > 30 AND (query_id, doc_id) NOT IN (SELECT (query_id, doc_id) FROM sd) GROUP BY 1, 2)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY beyond, score DESC NULLS LAST, first, doc_id) AS rank FROM al) WHERE rank <= 3"""


def _docs(ranking: DataFrame, spark, base, mode: str) -> DataFrame:
    out = fusion.documents(ranking.join(once(spark, base, "doc_id"), "chunk_id"), mode)
    return out.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def _docagg(mode: str, agg: str, bonus: bool = True):
    def run(spark, base):
        return _docs(fusion.rrf(channels(spark, base), WEIGHTS), spark, base, mode)

    run.__name__ = f"q_docagg_{mode}"
    query(f"WITH {RRF}, {CH}, {_docs_sql('rrf', agg, bonus)}")(run)


_docagg("max", "max(score)")
_docagg("sum", "sum(CASE WHEN hit <= 3 THEN score END)")
_docagg("mean", "sum(CASE WHEN hit <= 3 THEN score END) / 3")
_docagg("rrf", "sum(CASE WHEN hit <= 3 THEN 1.0 / (60 + rank) END)")


@query(f"WITH {BM}, b3 AS (SELECT * FROM bm WHERE rank <= 60), {_docs_sql('b3', 'sum(pow(0.85, hit - 1) / (60 + rank))', False)}")
def q_docagg_rankdecay(spark, base):
    """The flagship: BM25 over all chunks, documents by decaying reciprocal ranks."""
    return _docs(_bm25(spark, base, 60), spark, base, "rankdecay")


def _hybrid(spark, base):
    c = once(spark, base, "doc_id", F.col("fenomeno").alias("phenomenon"), F.col("texto").alias("text"))
    s = retrieval.Settings(weights=WEIGHTS)
    return retrieval.retrieve(channels(spark, base), c, s, _ce(spark, base))


@query(f"WITH {RRF}, {CH}, {_boosted('score + 0.2 * span')}, {_rerank_sql('boost', 150)}, {_docs_sql('ranked', 'sum(pow(0.85, hit - 1) / (60 + rank))', False)}")
def q_retrieve_hybrid(spark, base):
    d = _hybrid(spark, base)["documents"]
    return d.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


DD = f"""hg AS (SELECT query_id, chunk_id, rank, {grams_sql('w', 8)} AS g FROM (SELECT ranked.query_id, ranked.chunk_id, ranked.rank, {words('texto')} AS w FROM ranked JOIN ch USING (chunk_id))),
hd2 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM hg WHERE rank <= 200 AND len(g) > 0),
near AS (SELECT a.query_id, a.n AS i, b.n AS j FROM hd2 a JOIN hd2 b ON a.query_id = b.query_id AND a.n < b.n WHERE len(list_intersect(a.g, b.g)) >= 0.45 * least(len(a.g), len(b.g))),
fold(query_id, n, kept) AS (SELECT query_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM (SELECT DISTINCT query_id FROM hd2)
 UNION ALL SELECT f.query_id, f.n + 1, CASE WHEN EXISTS (SELECT 1 FROM near x WHERE x.query_id = f.query_id AND x.j = f.n + 1 AND list_contains(f.kept, x.i)) THEN f.kept ELSE list_append(f.kept, f.n + 1) END FROM fold f JOIN (SELECT query_id, max(n) AS most FROM hd2 GROUP BY 1) m ON f.query_id = m.query_id WHERE f.n < m.most),
un AS (SELECT hd2.query_id, chunk_id, rank FROM hd2 JOIN (SELECT query_id, arg_max(kept, n) AS kept FROM fold GROUP BY 1) k ON hd2.query_id = k.query_id AND list_contains(kept, n) UNION ALL SELECT query_id, chunk_id, rank FROM hg WHERE rank > 200)"""


@query(f"WITH RECURSIVE {RRF}, {CH}, {_boosted('score + 0.2 * span')}, {_rerank_sql('boost', 150)}, {DD} SELECT query_id, chunk_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS place FROM un")
def q_dedupe(spark, base):
    return _hybrid(spark, base)["unique"].select("query_id", "chunk_id", "place")


@query()
def q_mmr(spark, base):
    c = once(spark, base, F.col("texto").alias("text"))
    head = fusion.rrf(channels(spark, base), WEIGHTS).join(c, "chunk_id")
    return diversify.mmr(head).select("query_id", "chunk_id", "place")


@query()
def q_fragments(spark, base):
    return _hybrid(spark, base)["fragments"]


@query()
def q_results(spark, base):
    r = _hybrid(spark, base)
    return evaluate.results(r["documents"], r["fragments"])


@query("""WITH r AS (SELECT doc_id AS query_id, doc_id % 4 <> 1 AS documents, doc_id % 5 = 0 AS repeated_document, doc_id % 3 <> 1 AS fragments, doc_id % 7 = 0 AS long_fragment, doc_id % 11 = 0 AS separator FROM documents)
SELECT query_id, problem FROM (UNPIVOT r ON documents, repeated_document, fragments, long_fragment, separator INTO NAME problem VALUE bad) WHERE bad""")
def q_validate(spark, base):
    """Result lines with planted faults: wrong numbers, a repeated document, a long piece, a separator."""
    i = F.col("doc_id")
    documents = F.transform(F.sequence(F.lit(1), (F.lit(2) + i % 4).cast("int")), lambda k: F.struct(k.alias("rank"), F.concat(F.lit("d"), F.when((i % 5 == 0) & (k == 2), F.lit(1)).otherwise(k)).alias("doc_id")))
    said = lambda k: F.concat(F.repeat(F.lit("x "), F.when((i % 7 == 0) & (k == 3), F.lit(250)).otherwise(F.lit(249))), F.lit("x"), F.when((i % 11 == 0) & (k == 2), F.lit("\u2028")).otherwise(F.lit("")))
    fragments = F.transform(F.sequence(F.lit(1), (F.lit(9) + i % 3).cast("int")), lambda k: F.struct(k.alias("rank"), k.alias("chunk_id"), F.lit("d").alias("doc_id"), said(k).alias("text")))
    lines = docs(spark, base).select(i.alias("query_id"), documents.alias("documents"), fragments.alias("fragments"))
    return evaluate.violations(lines)


@query("SELECT count(*) FILTER (doc_id_oficial IS NOT NULL AND doc_id_oficial <> '') AS filled, count(*) FILTER (regexp_matches(doc_id_oficial, '^F[123]-[A-Z0-9]+-\\d+$')) AS official, count(DISTINCT doc_id_oficial) AS distinct_ids FROM chunks")
def q_doc_ids(spark, base):
    c = F.col("doc_id_oficial")
    return table(spark, base, "chunks").agg(F.count_if(c != "").alias("filled"), F.count_if(c.rlike(r"^F[123]-[A-Z0-9]+-\d+$")).alias("official"), F.count_distinct(c).alias("distinct_ids"))


@query("""WITH a AS (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id FROM chunks), b AS (SELECT DISTINCT chunk_id FROM chunk_vectors)
SELECT 'right' AS side, count(*) AS missing FROM a WHERE chunk_id NOT IN (SELECT chunk_id FROM b) UNION ALL SELECT 'left', count(*) FROM b WHERE chunk_id NOT IN (SELECT chunk_id FROM a)""")
def q_alignment(spark, base):
    return evaluate.alignment(table(spark, base, "chunks").select(F.col("chunk_id").try_cast("bigint").alias("chunk_id")), table(spark, base, "chunk_vectors"), "chunk_id")


@query(rf"""SELECT chunk_id, kind, NOT regexp_matches(t, '^[\s\d.,:;|/\\\-–—•·()\[\]]*$') AND (kind IN ('callout', 'heading') OR (len(list_filter(string_split_regex(t, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) >= 4 AND length(regexp_replace(t, '\P{{Nd}}', '', 'g')) <= 0.5 * length(t))) AS useful
FROM (SELECT chunk_id, kind, coalesce(regexp_replace(texto, '^\s+|\s+$', '', 'g'), '') AS t FROM (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, coalesce(tipo, 'body') AS kind, texto FROM chunks))""")
def q_useful_units(spark, base):
    c = once(spark, base, F.coalesce("tipo", F.lit("body")).alias("kind"), F.col("texto").alias("text"))
    return c.select("chunk_id", "kind", T.is_useful(F.col("text"), F.col("kind")).alias("useful"))


@query(f"""WITH w AS (SELECT chunk_id, doc_id, posicion, {grams_sql('w', 8)} AS g FROM (SELECT chunk_id, doc_id, posicion, {words('texto')} AS w FROM (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, doc_id, posicion, texto FROM chunks))),
p AS (SELECT *, lag(g) OVER (PARTITION BY doc_id ORDER BY posicion, chunk_id) AS above FROM w)
SELECT chunk_id, round(CASE WHEN least(len(g), len(above)) > 0 THEN len(list_intersect(g, above)) / least(len(g), len(above)) ELSE 0 END, 6) AS containment FROM p WHERE above IS NOT NULL""")
def q_shingles_containment(spark, base):
    """How much of a chunk its neighbour above holds, by eight-word shingles."""
    c = once(spark, base, "doc_id", "posicion", F.col("texto").alias("text")).withColumn("g", T.shingles(F.coalesce("text", F.lit("")), 8))
    x = c.withColumn("above", F.lag("g").over(W.partitionBy("doc_id").orderBy("posicion", "chunk_id"))).where("above is not null")
    return x.select("chunk_id", F.round(T.containment(F.col("g"), F.col("above")), 6).alias("containment"))


_CN = "chunk_names AS (SELECT DISTINCT doc_id, nombre_archivo AS name FROM chunks WHERE nombre_archivo IS NOT NULL)"
_ND = lambda c: rf"regexp_replace(lower(string_split(replace({c}, chr(92), '/'), '/')[-1]), '[_\-\s]+', '', 'g')"


@query(f"WITH {_CN} SELECT DISTINCT doc_id, name, path, length({_ND('name')}) > 0 AND length({_ND('path')}) > 0 AND (suffix({_ND('name')}, {_ND('path')}) OR suffix({_ND('path')}, {_ND('name')})) AS same FROM chunk_names JOIN inventory USING (doc_id) WHERE path IS NOT NULL")
def q_document_match(spark, base):
    """Stored names against the inventory's paths: one ends with the other."""
    n = table(spark, base, "chunks").select("doc_id", F.col("nombre_archivo").alias("name")).where("name is not null").distinct()
    inv = table(spark, base, "inventory").select("doc_id", "path").where("path is not null").distinct()
    return n.join(inv, "doc_id").select("doc_id", "name", "path", evaluate.same_document(F.col("name"), F.col("path")).alias("same"))


RD = f"""{RRF}, {CH}, gc AS (SELECT query_id, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS r FROM cs WHERE channel = 'rerank') WHERE r BETWEEN 4 AND 8), rk AS (SELECT rrf.*, ch.doc_id FROM rrf JOIN ch USING (chunk_id)),
dr AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY min(rank)) AS rank FROM rk GROUP BY 1, 2)"""


def _judged(spark, base):
    """(ranking with doc_id, documents by best chunk, relevant chunks): the re-ranker's places 4 to 8 are relevant."""
    meta = once(spark, base, "doc_id")
    ranking = fusion.rrf(channels(spark, base), WEIGHTS).join(meta, "chunk_id")
    best = ranking.groupBy("query_id", "doc_id").agg(F.min("rank").alias("first"))
    documents = best.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("first")))
    good = lexical.top_k(channels(spark, base).where("channel = 'rerank'"), 8).where("rank >= 4").select("query_id", "chunk_id")
    return ranking, documents, good, good.join(meta, "chunk_id").select("query_id", "doc_id").distinct()


@query(f"""WITH {RD} SELECT q.query_id, d.doc_rank, f.frag_rank, p.pool_rank FROM (SELECT DISTINCT query_id FROM rk) q
LEFT JOIN (SELECT query_id, min(rank) AS doc_rank FROM dr WHERE (query_id, doc_id) IN (SELECT (query_id, doc_id) FROM gc JOIN ch USING (chunk_id)) GROUP BY 1) d USING (query_id)
LEFT JOIN (SELECT query_id, min(rank) FILTER (rank <= 10) AS frag_rank FROM rk JOIN gc USING (query_id, chunk_id) GROUP BY 1) f USING (query_id)
LEFT JOIN (SELECT query_id, min(rank) AS pool_rank FROM rk JOIN gc USING (query_id, chunk_id) GROUP BY 1) p USING (query_id)""")
def q_rank_diagnostics(spark, base):
    d = evaluate.diagnostics(*_judged(spark, base))
    return d.select("query_id", *[F.col(c).cast("bigint").alias(c) for c in ("doc_rank", "frag_rank", "pool_rank")])


@query(f"WITH {RD} SELECT query_id, count(DISTINCT doc_id) AS n_docs FROM rk WHERE rank <= 10 GROUP BY 1")
def q_distinct_documents(spark, base):
    return evaluate.distinct_documents(_judged(spark, base)[0])


# ---- retrieval from texts, both presets -------------------------------------

_SN = f"""sg AS (SELECT DISTINCT chunk_id, unnest({grams_sql('w', 2)}) AS entity FROM (SELECT chunk_id, {words('titulo')} AS w FROM (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, titulo FROM chunks) WHERE titulo IS NOT NULL)),
nm AS (SELECT entity FROM sg GROUP BY 1 HAVING count(*) >= 2 AND entity <> ''), nc AS (SELECT entity, chunk_id FROM sg WHERE entity IN (SELECT entity FROM nm)),
qn AS (SELECT query_id, ' ' || array_to_string({words('query')}, ' ') || ' ' AS q FROM rq), ht AS (SELECT DISTINCT query_id, entity FROM qn JOIN nm ON contains(q, ' ' || entity || ' ')),
lk AS (SELECT * FROM ht WHERE NOT EXISTS (SELECT 1 FROM ht o WHERE o.query_id = ht.query_id AND length(o.entity) > length(ht.entity) AND contains(o.entity, ht.entity))),
ep AS (SELECT x.entity AS a, y.entity AS b, count(*) AS peso FROM nc x JOIN nc y ON x.chunk_id = y.chunk_id AND x.entity < y.entity GROUP BY 1, 2),
gb AS (SELECT a AS entity, b AS other, peso FROM ep UNION ALL SELECT b, a, peso FROM ep),
gp AS (SELECT query_id, chunk_id, 1.0 AS part FROM lk JOIN nc USING (entity) UNION ALL SELECT query_id, chunk_id, 0.4 * least(peso, 10) / 10.0 FROM lk JOIN gb USING (entity) JOIN nc ON nc.entity = other),
gs AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT query_id, chunk_id, round(sum(part), 9) AS score FROM gp GROUP BY 1, 2))"""
_ALL = "SELECT query_id, 'bm25' AS channel, chunk_id, score FROM bm WHERE rank <= 1000 UNION ALL SELECT query_id, 'grafo', chunk_id, score FROM gs WHERE rank <= 1000 UNION ALL SELECT query_id, channel, chunk_id, score FROM c0 WHERE channel IN ('dense_a', 'dense_b')"


def _search_sql(fused: str, name: str, weights: str, lift: str, agg: str, bonus: bool) -> str:
    f = fused.replace(CS + ",", f"cs AS ({_ALL}),").replace(_W, weights)
    head = f"WITH {BM}, {_SN}, {CS.replace('cs AS', 'c0 AS')}, {f}"
    boost = _boosted(lift).replace("FROM rrf", f"FROM (SELECT * FROM {name} WHERE rank <= 1000)")
    return f"{head}, {boost}, {_docs_sql('boost', agg, bonus)}"


def _search(spark, base, settings):
    c = once(spark, base, "doc_id", F.col("fenomeno").alias("phenomenon"), F.col("texto").alias("text"))
    t = once(spark, base, "titulo").where("titulo is not null").select("chunk_id", F.explode(T.grams(T.all_words(F.col("titulo")), 2)).alias("entity")).distinct()
    # names and their chunks are stored once, as a search finds them
    t = materialise(t, "titles")
    names = materialise(t.groupBy("entity").agg(F.count("*").alias("df")).where("df >= 2 and entity <> ''").select("entity"), "names")
    where = materialise(t.join(names, "entity", "left_semi"), "node_chunks")
    e = materialise(graph.seed_pairs(where, graph.link(asked(spark, base), names)), "edge_rows")  # of the asked names
    dense = channels(spark, base).where("channel in ('dense_a', 'dense_b')")
    d = retrieval.search(c, asked(spark, base), settings, dense, names, where, e)["documents"]
    return d.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(_search_sql(RRF, "rrf", "CASE channel WHEN 'bm25' THEN 0.5 WHEN 'grafo' THEN 0.5 ELSE 1.0 END", "score + 0.2 * span", "sum(pow(0.85, hit - 1) / (60 + rank))", False))
def q_search_default(spark, base):
    """From texts to documents under the default settings."""
    return _search(spark, base, retrieval.PRESETS["code_default"])


@query(_search_sql(COMB, "comb", "CASE channel WHEN 'bm25' THEN 1.0 WHEN 'grafo' THEN 0.5 ELSE 1.0 END", "score * 1.08", "max(score)", True))
def q_search_submitted(spark, base):
    """From texts to documents under the settings once submitted."""
    return _search(spark, base, retrieval.PRESETS["readme_submitted"])


@query()
def q_search_feedback(spark, base):
    """The same with a second lexical pass over expanded queries."""
    return _search(spark, base, replace(retrieval.PRESETS["code_default"], rm3=True))


# ---- graph -----------------------------------------------------------------

MEN = "men AS (SELECT DISTINCT l_orderkey AS chunk_id, 'p' || l_partkey AS entity FROM lineitem), fr AS (SELECT entity, count(*) AS f FROM men GROUP BY 1), kp AS (SELECT entity, f FROM fr WHERE f >= 20 AND f <= greatest(1, floor(0.0025 * (SELECT count(DISTINCT l_orderkey) FROM lineitem))))"


def _mentions(spark, base):
    """Parts of an order as the entities of a chunk (frequency band set so that both edges cut)."""
    li = table(spark, base, "lineitem")
    m = li.select(F.col("l_orderkey").alias("chunk_id"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("entity"), F.when(F.col("l_partkey") % 2 == 0, "ORG").otherwise("MISC").alias("group")).distinct()
    n = li.agg(F.count_distinct("l_orderkey").alias("n"))
    return m, graph.kept_entities(m, n, 20, 0.0025)


@query(f"WITH {MEN} SELECT entity, CASE WHEN CAST(substring(entity, 2) AS BIGINT) % 2 = 0 THEN 'ORG' ELSE 'MISC' END AS tipo, f AS frecuencia FROM kp")
def q_graph_nodes(spark, base):
    return graph.nodes(*_mentions(spark, base))


EDG = f"""{MEN}, km AS (SELECT * FROM men WHERE entity IN (SELECT entity FROM kp)), pr AS (SELECT x.entity AS a, y.entity AS b, x.chunk_id FROM km x JOIN km y ON x.chunk_id = y.chunk_id AND x.entity < y.entity),
ed AS (SELECT a, b, 'coocurre_con' AS relacion, count(DISTINCT chunk_id) AS peso, array_to_string(list_sort(list_distinct(list(chunk_id)))[1:40], ',') AS chunks, array_to_string(list_sort(list_distinct(list(o_custkey)))[1:20], ',') AS docs
 FROM pr JOIN orders ON chunk_id = o_orderkey GROUP BY 1, 2)"""


def _edges(spark, base, min_bare=1):
    m, kept = _mentions(spark, base)
    owner = table(spark, base, "orders").select(F.col("o_orderkey").alias("chunk_id"), F.col("o_custkey").alias("doc_id"))
    return graph.edges(graph.pairs(m, kept).join(owner, "chunk_id").withColumn("relacion", F.lit("coocurre_con")), min_bare)


@query(f"WITH {EDG} SELECT * FROM ed")
def q_graph_edges(spark, base):
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return _edges(spark, base).select("a", "b", "relacion", "peso", joined("chunks"), joined("docs"))


@query(f"WITH {EDG} SELECT relacion, count(*) AS n, sum(peso) AS weight FROM ed WHERE peso >= 2 GROUP BY 1")
def q_graph_pruned(spark, base):
    return _edges(spark, base, 2).groupBy("relacion").agg(F.count("*").alias("n"), F.sum("peso").alias("weight"))


def _title_names(spark, base):
    """Names and where they stand: word pairs of titles found in two documents or more."""
    t = docs(spark, base, "title").where("title is not null").select("doc_id", F.explode(T.grams(T.all_words(F.col("title")), 2)).alias("entity"))
    t = t.distinct()
    names = t.groupBy("entity").agg(F.count("*").alias("df")).where("df >= 2").select("entity")
    return names, t.join(names, "entity", "left_semi").select("entity", F.col("doc_id").alias("chunk_id"))


TN = f"tg AS (SELECT DISTINCT doc_id, unnest({grams_sql('w', 2)}) AS entity FROM (SELECT doc_id, {words('title')} AS w FROM documents WHERE title IS NOT NULL)), nm AS (SELECT entity FROM tg GROUP BY 1 HAVING count(*) >= 2 AND entity <> ''), nc AS (SELECT entity, doc_id AS chunk_id FROM tg WHERE entity IN (SELECT entity FROM nm))"
LK = f"""{RQ}, qn AS (SELECT query_id, ' ' || array_to_string({words('query')}, ' ') || ' ' AS q FROM rq), ht AS (SELECT DISTINCT query_id, entity FROM qn JOIN nm ON contains(q, ' ' || entity || ' ')),
lk AS (SELECT * FROM ht WHERE NOT EXISTS (SELECT 1 FROM ht o WHERE o.query_id = ht.query_id AND length(o.entity) > length(ht.entity) AND contains(o.entity, ht.entity)))"""


@query(f"WITH {TN}, {LK} SELECT query_id, entity FROM lk")
def q_graph_link(spark, base):
    return graph.link(asked(spark, base), _title_names(spark, base)[0])


@query(f"""WITH {TN}, {LK}, pr AS (SELECT x.entity AS a, y.entity AS b, count(*) AS peso FROM nc x JOIN nc y ON x.chunk_id = y.chunk_id AND x.entity < y.entity GROUP BY 1, 2),
bo AS (SELECT a AS entity, b AS other, peso FROM pr UNION ALL SELECT b, a, peso FROM pr),
pt AS (SELECT query_id, chunk_id, 1.0 AS part FROM lk JOIN nc USING (entity) UNION ALL SELECT query_id, chunk_id, 0.4 * least(peso, 10) / 10.0 FROM lk JOIN bo USING (entity) JOIN nc ON nc.entity = other),
sc AS (SELECT query_id, chunk_id, round(sum(part), 9) AS score FROM pt GROUP BY 1, 2)
SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sc) WHERE rank <= 20""")
def q_graph_search(spark, base):
    names, where = _title_names(spark, base)
    where = materialise(where, "node_chunks")
    linked = materialise(graph.link(asked(spark, base), where.select("entity").distinct()), "linked")
    return _ranked(graph.graph_search(linked, where, graph.seed_pairs(where, linked), 20))


@query(f"WITH {TN}, {LK} SELECT (SELECT count(DISTINCT query_id) FROM rq) AS queries, (SELECT count(DISTINCT query_id) FROM lk) AS linked, (SELECT count(DISTINCT chunk_id) FROM lk JOIN nc USING (entity)) AS chunks")
def q_link_coverage(spark, base):
    names, where = _title_names(spark, base)
    a = asked(spark, base)
    return graph.link_coverage(a, graph.link(a, names), where)


@query()
def q_entities_heuristic(spark, base):
    m = graph.heuristic_mentions(once(spark, base, F.col("texto").alias("text")))
    return graph.clean_mentions(m).select("chunk_id", "entity", F.col("group").alias("tipo"), "start", "ordinal")


@query()
def q_graph_from_texts(spark, base):
    """Entity graph of all chunks: mentions, frequency band, relations of neighbouring mentions, edges."""
    c = once(spark, base, "doc_id", F.col("texto").alias("text"))
    # found once and stored: four branches below read the mentions, and four the pairs
    m = materialise(graph.clean_mentions(graph.heuristic_mentions(c)), "mentions")
    kept = materialise(graph.kept_entities(m, c.agg(F.count("*").alias("n"))).withColumn("e", F.monotonically_increasing_id()), "kept")
    rows = materialise(graph.labelled_pairs(m, kept, c), "pairs")
    e = graph.edges(rows, 2)  # of numbers; named at the end
    for end in ("a", "b"):
        e = e.withColumnRenamed(end, "e").join(kept.select("e", F.col("entity").alias(end)), "e").drop("e")
    return e.select("a", "b", "relacion", "peso", F.size("chunks").alias("n_chunks"), F.size("docs").alias("n_docs"))


# ---- evaluation ------------------------------------------------------------


def _items(spark, base):
    return table(spark, base, "benchmark").select("item_id", "gt_id", "text").distinct()


def _doc_texts(spark, base):
    return docs(spark, base, "text").select(F.col("doc_id").alias("chunk_id"), "text")


COV = f"""ig AS (SELECT item_id, gt_id, {grams_sql('w', 8)} AS g FROM (SELECT item_id, gt_id, {words('text', False)} AS w FROM benchmark)),
cg AS (SELECT DISTINCT doc_id AS chunk_id, unnest({grams_sql('w', 8)}) AS gram FROM (SELECT doc_id, {words('text', False)} AS w FROM documents)),
cov AS (SELECT item_id, chunk_id, round(count(*) / any_value(t), 9) AS coverage FROM cg JOIN (SELECT item_id, len(g) AS t, unnest(g) AS gram FROM ig) USING (gram) GROUP BY 1, 2)"""


@query(f"WITH {COV} SELECT item_id, chunk_id, round(coverage, 6) AS coverage FROM cov")
def q_eval_coverage(spark, base):
    return evaluate.gram_coverage(_items(spark, base), _doc_texts(spark, base)).withColumn("coverage", F.round("coverage", 6))


@query(f"""WITH {COV} SELECT item_id, round(coalesce(coverage, 0), 6) AS best, chunk_id, CASE WHEN coalesce(coverage, 0) >= 0.3 THEN 'indexed' WHEN coalesce(coverage, 0) >= 0.1 THEN 'partial' ELSE 'absent' END AS verdict
FROM (SELECT DISTINCT item_id FROM benchmark) LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY coverage DESC, chunk_id) AS r FROM cov) WHERE r = 1) USING (item_id)""")
def q_audit(spark, base):
    return evaluate.audit(_items(spark, base), _doc_texts(spark, base))


def _gt_queries(spark, base):
    """One query a ground-truth question: its first passage."""
    return _items(spark, base).groupBy(F.col("gt_id").alias("query_id")).agg(F.min_by("text", "item_id").alias("query"))


def _gt_run(spark, base, k1=1.2, b=0.75, depth=20):
    r = lexical.bm25(_doc_texts(spark, base), _gt_queries(spark, base), depth, k1, b)
    good = evaluate.gram_coverage(_items(spark, base), _doc_texts(spark, base)).where("coverage >= 0.3").join(_items(spark, base).select("item_id", F.col("gt_id").alias("query_id")), "item_id").select("query_id", "chunk_id").distinct()
    n = _gt_queries(spark, base).select("query_id").join(good.groupBy("query_id").agg(F.count("*").alias("c")), "query_id", "left").select("query_id", F.coalesce("c", F.lit(0)).alias("relevant"))
    hits = lambda ranking: ranking.join(good.withColumn("g", F.lit(True)), ["query_id", "chunk_id"], "left").select("query_id", "rank", F.coalesce("g", F.lit(False)).alias("hit"))
    return r, hits, n


def _eval_sql(k1: float, b: float) -> str:
    return f"""{COV}, gq AS (SELECT gt_id AS query_id, min_by(text, item_id) AS query FROM benchmark GROUP BY 1), qt AS (SELECT DISTINCT query_id, unnest({tok('query')}) AS term FROM gq),
tk AS (SELECT doc_id AS chunk_id, {tok('text')} AS toks FROM documents), st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM tk),
po AS (SELECT term, chunk_id, dl, count(*) AS tf FROM (SELECT chunk_id, len(toks) AS dl, unnest(toks) AS term FROM tk) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3),
iw AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, avgdl FROM (SELECT term, count(*) AS df FROM po GROUP BY 1), st),
bs AS (SELECT query_id, chunk_id, round(sum(idf * tf * ({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * dl / avgdl))), 9) AS score FROM po JOIN iw USING (term) JOIN qt USING (term) GROUP BY 1, 2),
rk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM bs) WHERE rank <= 20),
gd AS (SELECT DISTINCT gt_id AS query_id, chunk_id FROM cov JOIN benchmark USING (item_id) WHERE coverage >= 0.3),
rel AS (SELECT gq.query_id, count(chunk_id) AS relevant FROM gq LEFT JOIN gd USING (query_id) GROUP BY 1),
hp AS (SELECT query_id, count(*) FILTER (rank <= 10) AS found, sum(1 / log2(rank + 1.0)) FILTER (rank <= 10) AS dcg, min(rank) AS first FROM rk JOIN gd USING (query_id, chunk_id) GROUP BY 1),
pe AS (SELECT query_id, relevant, coalesce(found, 0) AS found, coalesce(dcg, 0) AS dcg, first FROM rel LEFT JOIN hp USING (query_id)),
ms AS (SELECT query_id, relevant, found,
 round(CASE WHEN relevant > 0 AND found > 0 THEN 2 * (found / 10.0) * (found / least(relevant, 10)) / (found / 10.0 + found / least(relevant, 10)) ELSE 0 END, 6) AS f1,
 round(CASE WHEN relevant > 0 THEN 2 * (least(relevant, 10) / 10.0) / (least(relevant, 10) / 10.0 + 1) ELSE 0 END, 6) AS ceiling,
 round(CASE WHEN relevant > 0 THEN dcg / list_sum(list_transform(range(1, greatest(least(relevant, 10), 1) + 1), lambda i: 1 / log2(i + 1.0))) ELSE 0 END, 6) AS ndcg,
 round(coalesce(1.0 / first, 0), 6) AS rr FROM pe)"""


@query(f"WITH {_eval_sql(1.2, 0.75)} SELECT * FROM ms")
def q_eval_measures(spark, base):
    r, hits, n = _gt_run(spark, base)
    return evaluate.measures(hits(r), n)


@query(f"WITH {_eval_sql(1.2, 0.75)} SELECT round(avg(f1), 6) AS f1, round(avg(ceiling), 6) AS ceiling, round(avg(ndcg), 6) AS ndcg, round(avg(rr), 6) AS rr, count(*) AS queries FROM ms")
def q_eval_macro(spark, base):
    r, hits, n = _gt_run(spark, base)
    return evaluate.macro(evaluate.measures(hits(r), n))


def _sweep_sql() -> str:
    """Every setting's fusion written out, measured against the re-ranker's first five."""
    one = []
    for name, src, sql, key in (("bm25", "rrf", RRF, "bm25"), ("graph", "comb", COMB, "grafo")):
        for w in (0.0, 1.0):
            body = sql.replace(_W, f"CASE channel WHEN '{key}' THEN {w} WHEN 'rerank' THEN 0.0 ELSE 1.0 END").replace(CS + ",", "")
            one.append(f"SELECT '{name}/{w}' AS config, query_id, chunk_id, rank FROM (WITH {body} SELECT * FROM {src})")
    return f"""{CS}, gd AS (SELECT query_id, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS r FROM cs WHERE channel = 'rerank') WHERE r <= 5), rl AS (SELECT query_id, count(*) AS relevant FROM gd GROUP BY 1),
al AS ({' UNION ALL '.join(one)}), hp AS (SELECT config, query_id, count(*) FILTER (rank <= 10) AS found, sum(1 / log2(rank + 1.0)) FILTER (rank <= 10) AS dcg, min(rank) AS first FROM al JOIN gd USING (query_id, chunk_id) GROUP BY 1, 2),
pe AS (SELECT c.config, rl.query_id, relevant, coalesce(found, 0) AS found, coalesce(dcg, 0) AS dcg, first FROM rl CROSS JOIN (SELECT DISTINCT config FROM al) c LEFT JOIN hp ON hp.config = c.config AND hp.query_id = rl.query_id),
ms AS (SELECT config, query_id, round(CASE WHEN relevant > 0 AND found > 0 THEN 2 * (found / 10.0) * (found / least(relevant, 10)) / (found / 10.0 + found / least(relevant, 10)) ELSE 0 END, 6) AS f1, round(CASE WHEN relevant > 0 THEN 2 * (least(relevant, 10) / 10.0) / (least(relevant, 10) / 10.0 + 1) ELSE 0 END, 6) AS ceiling,
 round(dcg / list_sum(list_transform(range(1, least(relevant, 10) + 1), lambda i: 1 / log2(i + 1.0))), 6) AS ndcg, round(coalesce(1.0 / first, 0), 6) AS rr FROM pe),
sw AS (SELECT config, round(avg(f1), 6) AS f1, round(avg(ceiling), 6) AS ceiling, round(avg(ndcg), 6) AS ndcg, round(avg(rr), 6) AS rr, count(*) AS queries FROM ms GROUP BY 1)"""


@query(f"WITH {_sweep_sql()} SELECT * FROM sw")
def q_sweep(spark, base):
    """Two grids of fusion settings over channels ranked once; hits are the re-ranker's first five."""
    ch = channels(spark, base)
    good = lexical.top_k(ch.where("channel = 'rerank'"), 5).select("query_id", "chunk_id")
    n = good.groupBy("query_id").agg(F.count("*").alias("relevant"))
    hits = lambda r: r.join(good.withColumn("g", F.lit(True)), ["query_id", "chunk_id"], "left").select("query_id", "rank", F.coalesce("g", F.lit(False)).alias("hit"))
    runs = {f"bm25/{w}": fusion.rrf(ch, {"bm25": w, "rerank": 0.0}) for w in (0.0, 1.0)} | {f"graph/{w}": fusion.combsum(ch, {"grafo": w, "rerank": 0.0}) for w in (0.0, 1.0)}
    return evaluate.sweep(runs, hits, n)


@query(f"WITH {_sweep_sql()} SELECT grid, config, rr FROM (SELECT *, string_split(config, '/')[1] AS grid, row_number() OVER (PARTITION BY string_split(config, '/')[1] ORDER BY rr DESC, ndcg DESC, config) AS r FROM sw) WHERE r = 1")
def q_sweep_best(spark, base):
    return evaluate.best_config(q_sweep(spark, base))


@query(f"""WITH {CS}, rk AS (SELECT *, row_number() OVER (PARTITION BY query_id, channel ORDER BY score DESC, chunk_id) AS rank FROM cs)
SELECT query_id, chunk_id, min(rank) AS best_rank, string_agg(DISTINCT channel, ',' ORDER BY channel) AS finders FROM rk WHERE rank <= 25 GROUP BY 1, 2""")
def q_pool(spark, base):
    ch = channels(spark, base)
    r = lexical.top_k(ch, 25, ("query_id", "channel"))
    names = ("dense_a", "dense_b", "bm25", "grafo", "rerank")
    return evaluate.pool({n: r.where(F.col("channel") == n) for n in names}).withColumn("best_rank", F.col("best_rank").cast("bigint"))


@query(f"""WITH qa AS (SELECT item_id, {grams_sql('w', 5)} AS g FROM (SELECT item_id, {words("upper(text)", False)} AS w FROM benchmark)), qb AS (SELECT item_id, unnest({grams_sql('w', 5)}) AS gram FROM (SELECT item_id, {words('text', False)} AS w FROM benchmark)),
sh AS (SELECT a.item_id AS gt_id, qb.item_id AS query_id, count(*) / any_value(t) AS o FROM (SELECT item_id, len(g) AS t, unnest(g) AS gram FROM qa) a JOIN qb USING (gram) GROUP BY 1, 2)
SELECT gt_id, query_id FROM (SELECT *, row_number() OVER (PARTITION BY gt_id ORDER BY o DESC, query_id DESC) AS r FROM sh WHERE o > 0.8) WHERE r = 1""")
def q_resolve_ids(spark, base):
    b = _items(spark, base)
    return evaluate.resolve_ids(b.select(F.col("item_id").alias("gt_id"), F.upper("text").alias("text")), b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query")))


# ---- sources ---------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def q_json_get(spark, base):
    return table(spark, base, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT doc_id, concat_ws(chr(10) || chr(10), nullif(trim(title, ' '), ''), nullif(trim(text, ' '), '')) AS body FROM documents")
def q_json_fields(spark, base):
    raw = F.to_json(F.struct("title", "text", F.col("text").alias("texto")))
    return docs(spark, base, "title", "text").select("doc_id", sources.json_fields(raw).alias("body"))


@query(f"SELECT CAST(doc_id AS VARCHAR) AS path, CAST(length(coalesce({_clean_sql('body')}, '')) AS INTEGER) AS n_chars, coalesce(trim(title), '') AS title FROM (SELECT doc_id, title, concat_ws(chr(10) || chr(10), nullif(trim(title), ''), nullif(text, '')) AS body FROM documents)")
def q_json_documents(spark, base):
    d = docs(spark, base, "title", "text")
    raw = d.select(F.col("doc_id").cast("string").alias("path"), F.to_json(F.struct("title", F.array("text").alias("paragraphs"))).alias("value"))
    return sources.read_json_documents(raw).select("path", F.length("text").alias("n_chars"), "title")


@query("SELECT c_custkey, 'c_custkey: ' || c_custkey || ' | c_name: ' || c_name || ' | c_nationkey: ' || c_nationkey || ' | c_mktsegment: ' || c_mktsegment || '.' AS line FROM customer")
def q_rows_to_text(spark, base):
    c = table(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return sources.rows_to_text(c, ["c_custkey"])


@query("""SELECT l_orderkey, l_linenumber, 'l_partkey: ' || l_partkey || ' | l_orderkey: ' || l_orderkey || ' | l_linenumber: ' || l_linenumber || ' | l_returnflag: ' || l_returnflag || '.' AS line
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""")
def q_rows_deduped(spark, base):
    li = table(spark, base, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag")
    return sources.rows_to_text(li, ["l_orderkey", "l_linenumber"], "l_partkey")


@query("""SELECT chunk_id, last_value(nullif(trim(titulo), '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY posicion, chunk_id ROWS UNBOUNDED PRECEDING) AS titulo
FROM (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, doc_id, posicion, titulo FROM chunks)""")
def q_filldown(spark, base):
    c = once(spark, base, "doc_id", "posicion", "titulo").withColumn("place", F.struct("posicion", "chunk_id"))
    return sources.fill_down(c, "titulo", "place", ("doc_id",)).select("chunk_id", "titulo")


@query("""WITH j AS (SELECT query_id, CAST(chunk_id AS BIGINT) AS chunk_id, CASE WHEN score > 0 THEN 1 ELSE 0 END AS grade FROM (SELECT DISTINCT * FROM channel_scores WHERE channel = 'rerank'))
SELECT * FROM j WHERE query_id IN (SELECT query_id FROM j WHERE grade > 0)""")
def q_judgments(spark, base):
    c = table(spark, base, "channel_scores").where("channel = 'rerank'").distinct()
    rows = c.select("query_id", F.col("chunk_id").try_cast("bigint").alias("chunk_id"), F.when(F.col("score") > 0, "1.0").when(F.col("score") < -3, "none").otherwise("0").alias("grade"))
    return sources.judgments(rows)


BP = rf"""{CH}, pg AS (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS page, fuente AS doc_id, texto AS text FROM chunks), ln AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM pg),
en AS (SELECT doc_id, unnest([l[1], l[-1]]) AS line FROM ln WHERE len(l) > 0), nn AS (SELECT doc_id, count(*) AS n FROM pg GROUP BY 1 HAVING count(*) >= 4),
bad AS (SELECT doc_id, list(line) AS bad FROM (SELECT en.doc_id, line FROM en JOIN nn USING (doc_id) WHERE length(line) < 120 GROUP BY en.doc_id, line, n HAVING count(*) >= 0.1 * n) GROUP BY 1)"""


@query(rf"""WITH {BP} SELECT page, CASE WHEN pg.doc_id NOT IN (SELECT doc_id FROM nn) THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []), trim(x)) AND NOT regexp_full_match(x, '\s*\d{{1,4}}\s*')), chr(10)) END AS text FROM pg LEFT JOIN bad USING (doc_id)""")
def q_boilerplate(spark, base):
    p = once(spark, base, F.col("fuente").alias("doc_id"), F.col("texto").alias("text")).withColumnRenamed("chunk_id", "page")
    return sources.boilerplate_free(p, 0.1).select("page", "text")


@query(f"SELECT doc_id, {_clean_sql("coalesce(title, '') || chr(10) || chr(10) || chr(10) || text")} AS text FROM documents WHERE text IS NOT NULL")
def q_html_extract(spark, base):
    d = docs(spark, base, "title", "text").where("text is not null")
    page = F.concat(F.lit("<html><head><title>"), F.coalesce("title", F.lit("")), F.lit("</title><script>var a=1;</script></head><body><nav>x</nav><p>"), F.regexp_replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), "\n\n", "</p><p>"), F.lit("</p></body></html>"))
    return d.select("doc_id", T.html_text(page).alias("text"))


# ---- planning --------------------------------------------------------------


#: Name patterns for the query.
EXCLUDED = ("*catalogo*.json", "*tiles-index.json", "*pubmed-*.csv", "*.pbf", "*reporte final*.pdf")


def _glob_sql(c: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({c}), '{inventory.glob_regex(p)}') THEN '{p}'" for p in EXCLUDED) + " ELSE '' END"


@query(f"SELECT p AS path, {_glob_sql('n')} AS pattern FROM (SELECT DISTINCT p, string_split(replace(p, chr(92), '/'), '/')[-1] AS n FROM (SELECT unnest([path, 'a/catalogo_x.JSON', 'b/x.pbf', 'c/PubMed-1.csv']) AS p FROM inventory) WHERE p IS NOT NULL)")
def q_exclude(spark, base):
    p = table(spark, base, "inventory").select(F.explode(F.array("path", F.lit("a/catalogo_x.JSON"), F.lit("b/x.pbf"), F.lit("c/PubMed-1.csv"))).alias("path")).where("path is not null").distinct()
    return p.select("path", inventory.excluded_by(F.col("path"), EXCLUDED).alias("pattern"))


@query("""WITH f AS (SELECT DISTINCT 'x/informe_' || doc_id || unnest(CASE doc_id % 3 WHEN 0 THEN ['-spa', '-chi', '_rus'] WHEN 1 THEN ['-chi', '-rus'] ELSE ['eng', '-por', '-fra'] END) || '.pdf' AS path, doc_id FROM documents)
SELECT path FROM f WHERE (doc_id % 3 = 0 AND (path LIKE '%-chi.pdf' OR path LIKE '%_rus.pdf')) OR (doc_id % 3 = 2 AND path LIKE '%-fra.pdf')""")
def q_translations(spark, base):
    kinds = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("-spa"), F.lit("-chi"), F.lit("_rus"))).when(F.col("doc_id") % 3 == 1, F.array(F.lit("-chi"), F.lit("-rus"))).otherwise(F.array(F.lit("eng"), F.lit("-por"), F.lit("-fra")))
    f = docs(spark, base).select("doc_id", F.explode(kinds).alias("kind")).select(F.concat(F.lit("x/informe_"), F.col("doc_id").cast("string"), "kind", F.lit(".pdf")).alias("path")).distinct()
    return inventory.redundant_translations(f)


PR = """pr AS (SELECT doc_id, source AS folder, 'F' || phenomenon || '/' || source || '/' || doc_id || '.' || file_format AS path, file_format AS format, CAST(coalesce(n_chars, 0) // 100 AS BIGINT) AS pages, CAST(coalesce(n_chars, 0) AS DOUBLE) AS chars_per_page,
 CAST(doc_id % 4 AS DOUBLE) AS images_per_page, doc_id % 5 AS multicolumn_pages, 6 AS sampled_pages, doc_id % 11 = 0 AS two_up FROM documents),
kl AS (SELECT *, CASE WHEN chars_per_page < 100 THEN CASE WHEN images_per_page >= 0.5 THEN 'scanned' ELSE 'empty' END WHEN chars_per_page < 400 THEN 'sparse' ELSE 'digital' END AS klass FROM pr)"""


def _profiles(spark, base):
    d = docs(spark, base, "source", "phenomenon", "file_format", "n_chars")
    n = F.coalesce("n_chars", F.lit(0))
    p = d.select(
        "doc_id",
        F.col("source").alias("folder"),
        F.concat(F.lit("F"), F.col("phenomenon").cast("string"), F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), "file_format").alias("path"),
        F.col("file_format").alias("format"),
        F.floor(n / 100).alias("pages"),
        n.cast("double").alias("chars_per_page"),
        (F.col("doc_id") % 4).cast("double").alias("images_per_page"),
        (F.col("doc_id") % 5).alias("multicolumn_pages"),
        F.lit(6).alias("sampled_pages"),
        (F.col("doc_id") % 11 == 0).alias("two_up"),
    )
    return p.withColumn("klass", inventory.triage_class())


@query(f"WITH {PR} SELECT doc_id, klass, chars_per_page < 2200 AND images_per_page >= 1 AND multicolumn_pages / 6 >= 0.4 AS design_heavy, two_up OR multicolumn_pages / 6 >= 0.3 AS complex_layout FROM kl")
def q_triage(spark, base):
    return _profiles(spark, base).select("doc_id", "klass", inventory.is_design_heavy().alias("design_heavy"), inventory.is_complex_layout().alias("complex_layout"))


@query(f"""WITH {PR} SELECT folder, count(*) FILTER (klass = 'digital') AS digital, count(*) FILTER (klass = 'sparse') AS sparse, count(*) FILTER (klass = 'scanned') AS scanned, count(*) FILTER (klass = 'empty') AS empty,
CAST(sum(CASE WHEN klass IN ('scanned', 'empty') THEN pages ELSE 0 END) AS BIGINT) AS ocr_pages, count(*) FILTER (multicolumn_pages > 0) AS multicolumn, count(*) FILTER (two_up) AS two_up FROM kl GROUP BY ROLLUP (folder)""")
def q_folder_report(spark, base):
    return inventory.folder_report(_profiles(spark, base))


@query(f"""WITH {PR}, rt AS (SELECT path, pages, CASE WHEN format IN ('jpg') THEN 'skip' WHEN format = 'pdf' AND klass IN ('scanned', 'empty') THEN 'ocr' WHEN format = 'pdf' AND (two_up OR multicolumn_pages / 6 >= 0.3) THEN 'layout' WHEN format = 'pdf' AND pages > 120 THEN 'shard' ELSE 'file' END AS route FROM kl),
ex AS (SELECT path, route, pages, unnest(CASE WHEN route = 'shard' THEN range(0, pages, 60) ELSE [0] END) AS first_page FROM rt WHERE route <> 'skip')
SELECT path, route, first_page, CASE WHEN route = 'shard' THEN least(first_page + 60, pages) ELSE pages END AS last_page, CASE WHEN route = 'shard' THEN least(first_page + 60, pages) - first_page ELSE pages END AS weight FROM ex""")
def q_plan_shards(spark, base):
    p = _profiles(spark, base).withColumn("routed", inventory.is_complex_layout()).withColumn("format", F.when(F.col("format") == "jpg", "img").otherwise(F.col("format")))
    out = inventory.plan(p)
    return out.select("path", "route", F.col("first_page").cast("bigint").alias("first_page"), "last_page", "weight")


@query(r"""WITH k AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(replace(path, chr(92), '/'), '/+', '/', 'g')), '^(\./|/)+', ''), '[_\s]+', '-', 'g') AS key FROM inventory WHERE path IS NOT NULL),
lu AS (SELECT key, min(doc_id) AS doc_id, min_by(phenomenon, doc_id) AS phenomenon, min_by(observatory, doc_id) AS observatory FROM k GROUP BY 1),
fi AS (SELECT DISTINCT ruta_relativa AS path, regexp_replace(regexp_replace(lower(regexp_replace(replace(ruta_relativa, chr(92), '/'), '/+', '/', 'g')), '^(\./|/)+', ''), '[_\s]+', '-', 'g') AS key FROM chunks WHERE ruta_relativa IS NOT NULL)
SELECT fi.path, lu.doc_id, coalesce(lu.phenomenon, try_cast(regexp_extract(string_split(fi.path, '/')[1], '[123]') AS INT), 0) AS phenomenon, lu.observatory FROM fi LEFT JOIN lu USING (key)""")
def q_inventory_join(spark, base):
    f = table(spark, base, "chunks").select(F.col("ruta_relativa").alias("path")).where("path is not null").distinct()
    return inventory.with_inventory(f, table(spark, base, "inventory"))


#: Recognition languages by parts of paths, for the query.
ROUTES = (("Instituto_", "spa"), ("Observatorio_", "spa+eng"), ("Centro_", "por"), ("Red_", "spa+por"), ("/pdfs/", "fra+rus"), ("Mirador_", "eng+spa"))
_CODES = {"spa": "es", "spa+eng": "es,en", "por": "pt", "spa+por": "es,pt", "fra+rus": "fr", "eng+spa": "en,es"}


@query(f"""SELECT path, languages, CASE languages {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _CODES.items())} END AS codes FROM (
 SELECT DISTINCT path, CASE {' '.join(f"WHEN contains(path, '{k}') THEN '{v}'" for k, v in ROUTES)} ELSE 'eng+spa' END AS languages FROM inventory WHERE path IS NOT NULL)""")
def q_language_route(spark, base):
    p = table(spark, base, "inventory").where("path is not null").select("path").distinct()
    lang = inventory.language_for(F.col("path"), ROUTES)
    return p.select("path", lang.alias("languages"), F.array_join(inventory.two_letter_codes(lang), ",").alias("codes"))


@query("SELECT path, CASE WHEN doc_id IS NULL OR pick THEN printf('DOC-%05d', row_number() OVER (ORDER BY path) - 1) ELSE doc_id END AS doc_id FROM (SELECT path, min(doc_id) AS doc_id, length(path) % 3 = 0 AS pick FROM inventory WHERE path IS NOT NULL GROUP BY path)")
def q_fallback_ids(spark, base):
    f = table(spark, base, "inventory").where("path is not null").groupBy("path").agg(F.min("doc_id").alias("doc_id"))
    return inventory.fallback_ids(f.withColumn("doc_id", F.when(F.length("path") % 3 != 0, F.col("doc_id"))))


@query(f"WITH {PR} SELECT f.path, klass, pages FROM (SELECT path FROM kl UNION ALL SELECT 'z/' || path FROM kl) f LEFT JOIN kl USING (path)")
def q_profile_join(spark, base):
    p = _profiles(spark, base)
    files = p.select("path").unionByName(p.select(F.concat(F.lit("z/"), "path").alias("path")))
    return inventory.with_profiles(files, p).select("path", "klass", "pages")


@query(f"WITH {PR} SELECT path FROM kl WHERE two_up")
def q_routed_files(spark, base):
    p = _profiles(spark, base)
    return inventory.routed_files(p.select("path"), p.where("two_up").select(F.concat(F.lit("./"), F.upper("path")).alias("path")))


@query("""SELECT folder, path, place FROM (SELECT *, row_number() OVER (ORDER BY turn, folder) AS place FROM (SELECT source AS folder, CAST(doc_id AS VARCHAR) AS path, row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS VARCHAR)) AS turn FROM documents)) WHERE place <= 50""")
def q_round_robin(spark, base):
    f = docs(spark, base, "source").select(F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("path"))
    return inventory.round_robin(f, 50).withColumn("place", F.col("place").cast("bigint"))


@query("""SELECT folder, wins, losses, mean_delta, wins > losses AND mean_delta > 0 AS choose FROM (SELECT source AS folder, count(*) FILTER (d > 1) AS wins, count(*) FILTER (d < -0.5) AS losses, round(avg(d), 6) AS mean_delta FROM (SELECT source, CAST(doc_id * 7 % 11 AS DOUBLE) / 2 - 2.5 AS d FROM documents) GROUP BY 1)""")
def q_extractor_choice(spark, base):
    d = docs(spark, base, "source").select(F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("path"), ((F.col("doc_id") * 7 % 11).cast("double") / 2 - 2.5).alias("delta"))
    return inventory.extractor_choice(d)


@query("SELECT path, doc_id FROM inventory WHERE doc_id NOT IN (SELECT doc_id FROM chunks WHERE doc_id IS NOT NULL) AND path IS NOT NULL GROUP BY ALL")
def q_files_without_chunks(spark, base):
    inv = table(spark, base, "inventory").where("path is not null").select("path", "doc_id").distinct()
    return inv.join(table(spark, base, "chunks").select("doc_id").distinct(), "doc_id", "left_anti").select("path", "doc_id")


# ---- chunking --------------------------------------------------------------


@query()
def q_sentences(spark, base):
    return docs(spark, base, F.posexplode(chunking.split_sentences(F.col("text"))).alias("seq", "sentence"))


@query()
def q_chunks(spark, base):
    return chunking.chunk_documents(docs(spark, base, "text", "source"))


@query()
def q_limit_pieces(spark, base):
    return docs(spark, base, F.posexplode(chunking.split_limit(F.col("text"), F.lit(100))).alias("seq", "piece"))


@query(rf"""WITH {CH.replace('fuente, fenomeno, texto', 'posicion, texto')} SELECT doc_id, text FROM (SELECT doc_id, string_agg(texto, chr(10) || chr(10) ORDER BY posicion, texto) AS text FROM ch WHERE texto IS NOT NULL GROUP BY 1)
WHERE len(list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) >= 20""")
def q_merge_shards(spark, base):
    return chunking.merge_shards(once(spark, base, "doc_id", F.col("posicion").alias("first_page"), F.col("texto").alias("text")))


@query("""SELECT chunk_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_page, posicion, chunk_id) - 1 AS position FROM (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, doc_id, posicion // 10 AS first_page, posicion FROM chunks)""")
def q_renumber(spark, base):
    c = once(spark, base, "doc_id", "posicion").withColumn("first_page", F.floor(F.col("posicion") / 10)).withColumn("posicion", F.struct("posicion", "chunk_id"))
    return chunking.renumber(c).select("chunk_id", F.col("position").cast("bigint").alias("position"))


@query("""SELECT chunk_id, row_number() OVER (ORDER BY doc_id, posicion, chunk_id) - 1 AS global_id FROM (SELECT DISTINCT CAST(chunk_id AS BIGINT) AS chunk_id, doc_id, posicion FROM chunks)""")
def q_global_ids(spark, base):
    c = once(spark, base, "doc_id", "posicion").withColumn("posicion", F.struct("posicion", "chunk_id"))
    return chunking.global_ids(c).select("chunk_id", "global_id")


@query()
def q_units(spark, base):
    u = once(spark, base, "doc_id", F.col("posicion").alias("unit_no"), F.coalesce("tipo", F.lit("body")).alias("kind"), F.col("texto").alias("text"), F.col("contexto").alias("context"), F.col("pagina").alias("page"))
    return chunking.chunk_units(u).select("doc_id", "position", "kind", "context", "page", "chunk_text")


@query()
def q_units_heading_trail(spark, base):
    c = once(spark, base, "doc_id", "posicion", "titulo", "texto", "tipo")
    items = c.select("doc_id", F.col("posicion").alias("seq"), (F.col("chunk_id") % 3 + 1).cast("int").alias("level"), F.when(F.col("tipo") == "callout", "heading").otherwise("body").alias("label"), F.coalesce("texto", F.lit("")).alias("text"))
    return layout.heading_trail(items).select("doc_id", "seq", "kind", F.size("heading_path").alias("depth"))


# ---- layout (blocks derived from line items: an order is a page) ------------

BK = """bk AS (SELECT l_orderkey // 8 AS doc_id, l_orderkey AS page, l_linenumber * 1000000 + l_partkey AS seq, CAST((l_partkey % 3) * 200 + l_suppkey % 20 AS DOUBLE) AS x0, CAST(l_linenumber * 100 AS DOUBLE) AS y0,
 CAST((l_partkey % 3) * 200 + l_suppkey % 20 + 120 + 20 * (l_partkey % 7) AS DOUBLE) AS x1, CAST(l_linenumber * 100 + 60 AS DOUBLE) AS y1, repeat('x', CAST(l_quantity AS INT)) AS text, 600.0 AS width, CASE WHEN l_orderkey % 2 = 0 THEN 400.0 ELSE 800.0 END AS height FROM lineitem)"""


def _blocks(spark, base):
    li = table(spark, base, "lineitem")
    x0 = ((F.col("l_partkey") % 3) * 200 + F.col("l_suppkey") % 20).cast("double")
    return li.select(
        F.floor(F.col("l_orderkey") / 8).alias("doc_id"), F.col("l_orderkey").alias("page"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("seq"), x0.alias("x0"), (F.col("l_linenumber") * 100).cast("double").alias("y0"),
        (x0 + 120 + 20 * (F.col("l_partkey") % 7)).alias("x1"), (F.col("l_linenumber") * 100 + 60).cast("double").alias("y1"), F.repeat(F.lit("x"), F.col("l_quantity").cast("int")).alias("text"), F.lit(600.0).alias("width"),
        F.when(F.col("l_orderkey") % 2 == 0, 400.0).otherwise(800.0).alias("height"),
    )


GU = "gp AS (SELECT doc_id, page, x0 - reach AS gap, reach + (x0 - reach) / 2 AS cut FROM (SELECT *, max(x1) OVER (PARTITION BY doc_id, page ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}) WHERE x0 > reach)"


@query(f"WITH {BK}, {GU.format(src='bk')} SELECT doc_id, page, cut, gap FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY gap DESC, cut) AS r FROM gp) WHERE r = 1 AND gap >= CAST(0.035 AS DOUBLE) * 600")
def q_gutter(spark, base):
    return layout.widest_cut(_blocks(spark, base), layout.GUTTER * F.col("width"))


FU = "fu AS (SELECT *, wide AND NOT bool_and(wide) OVER p AND count(*) OVER p > 1 AS furniture FROM (SELECT *, x1 - x0 > 0.35 * width AND length(text) < 50 AS wide FROM bk) WINDOW p AS (PARTITION BY doc_id, page))"


@query(f"WITH {BK}, {FU.replace('0.35', '0.60')} SELECT doc_id, page, seq, furniture FROM fu")
def q_furniture(spark, base):
    return layout.mark_furniture(_blocks(spark, base)).select("doc_id", "page", "seq", "furniture")


TU = f"""{BK}, {FU.replace('0.35', '0.60')}, co AS (SELECT * FROM fu WHERE NOT furniture), {GU.format(src='co')}, wc AS (SELECT doc_id, page, cut FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY gap DESC, cut) AS r FROM gp) WHERE r = 1 AND gap >= CAST(0.035 AS DOUBLE) * 600),
tu AS (SELECT pg.doc_id, pg.page, coalesce(width > height * 1.25 AND abs(cut - width / 2) <= width * 0.04, false) AS two_up FROM (SELECT doc_id, page, max(width) AS width, max(height) AS height FROM bk GROUP BY 1, 2) pg LEFT JOIN wc USING (doc_id, page))"""


@query(f"WITH {TU} SELECT * FROM tu")
def q_two_up(spark, base):
    return layout.two_up_pages(_blocks(spark, base))


@query(f"WITH {TU} SELECT doc_id, sum(CAST(two_up AS INT)) >= greatest(2, floor(count(*) * 0.3)) AS two_up FROM tu GROUP BY 1")
def q_two_up_documents(spark, base):
    return layout.two_up_documents(_blocks(spark, base))


@query(f"""WITH {BK}, c AS (SELECT *, (x0 + x1) / 2 AS centre FROM bk), s AS (SELECT *, CASE WHEN centre - lag(centre) OVER (PARTITION BY doc_id, page ORDER BY centre, seq) > width * 0.04 THEN 1 ELSE 0 END AS new FROM c),
k AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY centre, seq ROWS UNBOUNDED PRECEDING) AS col FROM s), g AS (SELECT *, CASE WHEN col <> lag(col) OVER (PARTITION BY doc_id, page ORDER BY seq) THEN 1 ELSE 0 END AS change FROM k)
SELECT doc_id, page, CAST(CASE WHEN count(*) < 3 OR max(col) = 0 THEN 0 ELSE greatest(0, sum(change) - max(col)) END AS BIGINT) AS excess FROM g GROUP BY 1, 2""")
def q_column_excess(spark, base):
    return layout.column_excess(_blocks(spark, base))


@query("""SELECT doc_id, page, size AS body_size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY chars DESC, size) AS r FROM (SELECT l_orderkey // 8 AS doc_id, l_orderkey AS page, 8 + l_partkey % 5 AS size, sum(CAST(l_quantity AS INT)) AS chars FROM lineitem GROUP BY 1, 2, 3)) WHERE r = 1""")
def q_font_mode(spark, base):
    s = table(spark, base, "lineitem").select(F.floor(F.col("l_orderkey") / 8).alias("doc_id"), F.col("l_orderkey").alias("page"), (F.col("l_partkey") % 5 + 8).alias("size"), F.repeat(F.lit("x"), F.col("l_quantity").cast("int")).alias("text"))
    return layout.body_font(s)


def _units(spark, base):
    kind = F.when(F.floor(F.col("seq") / 1000000) % 3 == 1, "heading").otherwise("callout")
    return _blocks(spark, base).withColumn("kind", kind).withColumn("text", F.concat(F.lit("h"), F.col("seq").cast("string")))


@query(f"""WITH {BK}, h AS (SELECT * FROM bk WHERE seq // 1000000 % 3 = 1), c AS (SELECT * FROM bk WHERE seq // 1000000 % 3 <> 1)
SELECT doc_id, page, seq, heading FROM (SELECT c.doc_id, c.page, c.seq, 'h' || h.seq AS heading, row_number() OVER (PARTITION BY c.doc_id, c.page, c.seq ORDER BY c.y0 - h.y1, h.seq) AS r FROM c JOIN h ON c.doc_id = h.doc_id AND c.page = h.page AND h.y1 <= c.y0 AND h.x0 < c.x1 AND h.x1 > c.x0) WHERE r = 1""")
def q_callout_context(spark, base):
    return layout.nearest_heading(_units(spark, base))


@query(f"WITH {TU} SELECT bk.doc_id, CASE WHEN two_up THEN bk.page * 2 - 1 + CAST((x0 + x1) / 2 >= width / 2 AS INT) ELSE bk.page END AS page, count(*) AS n FROM bk JOIN tu ON bk.doc_id = tu.doc_id AND bk.page = tu.page GROUP BY ALL")
def q_logical_pages(spark, base):
    b = _blocks(spark, base)
    return layout.logical_pages(b.join(layout.two_up_pages(b), ["doc_id", "page"])).groupBy("doc_id", "page").agg(F.count("*").alias("n"))


@query()
def q_xycut(spark, base):
    return layout.reading_order(_blocks(spark, base))


@query()
def q_page_columns(spark, base):
    return layout.page_columns(_blocks(spark, base))


@query()
def q_stat_callouts(spark, base):
    figure = F.floor(F.col("seq") / 1000000) % 3 == 1
    s = _blocks(spark, base).withColumn("size", F.when(figure, 24.0).otherwise(10.0)).withColumn("body_size", F.lit(10.0))
    return layout.stat_callouts(s.withColumn("text", F.when(figure, F.concat((F.col("seq") % 1000).cast("string"), F.lit("5%"))).otherwise(F.lit("of seed grants"))))


@query("SELECT l_orderkey AS order_no, l_linenumber AS seq, regexp_full_match(t, '[\\$€£]?\\s*[\\d.,]+\\s*[%kKmMbB+]?') AS stat FROM (SELECT *, CAST(CAST(l_quantity AS INT) AS VARCHAR) || CASE l_linenumber % 3 WHEN 0 THEN '%' WHEN 1 THEN ' words' ELSE 'M' END AS t FROM lineitem)")
def q_stat_number(spark, base):
    unit = F.when(F.col("l_linenumber") % 3 == 0, "%").when(F.col("l_linenumber") % 3 == 1, " words").otherwise("M")
    t = F.concat(F.col("l_quantity").cast("int").cast("string"), unit)
    return table(spark, base, "lineitem").select(F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("seq"), T.is_stat_number(t).alias("stat"))


_SPANS = f"""{BK}, sp AS (SELECT *, CASE l WHEN 1 THEN 16.0 WHEN 3 THEN 8.0 ELSE 10.0 END AS size, page % 5 <> 0 OR l <> 2 AS horizontal FROM (SELECT *, seq // 1000000 AS l FROM bk)),
bf AS (SELECT doc_id, page, size AS base FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY chars DESC, size) AS r FROM (SELECT doc_id, page, size, sum(length(text)) AS chars FROM sp GROUP BY 1, 2, 3)) WHERE r = 1),
ba AS (SELECT sp.*, base, round(y0 / greatest(base * 0.6, 1)) AS band FROM sp JOIN bf USING (doc_id, page) WHERE horizontal),
ru AS (SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page, band ORDER BY x0, seq ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, x0 - lag(x1) OVER (PARTITION BY doc_id, page, band ORDER BY x0, seq) > 3 * base AS apart FROM ba))"""


def _spans(spark, base):
    no = F.floor(F.col("seq") / 1000000)
    b = _blocks(spark, base)
    return b.withColumn("size", F.when(no == 1, 16.0).when(no == 3, 8.0).otherwise(10.0)).withColumn("bold", F.lit(False)).withColumn("horizontal", (F.col("page") % 5 != 0) | (no != 2))


@query(f"""WITH {_SPANS} SELECT doc_id, page, seq, text, CASE WHEN size >= base * 1.12 AND length(text) < 120 THEN 'heading' WHEN size <= base * 0.86 THEN 'caption' ELSE 'body' END AS kind
FROM (SELECT doc_id, page, min(seq) AS seq, string_agg(text, ' ' ORDER BY x0, seq) AS text, median(size) AS size, any_value(base) AS base FROM ru GROUP BY doc_id, page, band, run)""")
def q_visual_lines(spark, base):
    return layout.visual_lines(_spans(spark, base)).select("doc_id", "page", "seq", "text", layout.line_kind().alias("kind"))


@query()
def q_page_units(spark, base):
    return layout.page_units(_spans(spark, base)).select("doc_id", "seq", "page", "kind", F.size("heading_path").alias("depth"))


@query()
def q_document_profile(spark, base):
    return layout.document_profile(layout.page_columns(layout.text_blocks(_blocks(spark, base))))


# ---- extras, not a capability of the reference ------------------------------


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def q_loose_event_windows(spark, base):
    e = table(spark, base, "events")
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")).select("event_type", F.col("w.start").alias("hour"), "n")
