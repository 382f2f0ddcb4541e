"""Reading documents of many formats into one shape, and writing results.

Formats Spark reads itself are read by Spark; binary formats that need a
library (PDF, OCR, layout models) plug in as providers: a function from bytes
to page texts that runs in `mapInPandas` with one instance a worker.
"""

from __future__ import annotations

import html.parser
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types
from pyspark.sql.window import Window as W

from ..functions import text as T

# Format of each file suffix, and the words a document needs.
FORMAT_OF = {
    "pdf": "pdf", "html": "html", "htm": "html", "json": "json", "csv": "csv", "xlsx": "xlsx", "xls": "xlsx", "md": "md", "txt": "txt",
    "png": "img", "jpg": "img", "jpeg": "img", "webp": "img", "avif": "img", "pbf": "pbf",
}
MIN_WORDS = {"pbf": 8}
DEFAULT_MIN_WORDS = 20
# Text fields of JSON documents in order, and which are forms of one body.
HEAD_FIELDS = ("title", "titulo", "headline", "summary", "abstract", "resumen")
BODY_FIELDS = ("body_text", "body", "content", "contenido", "text", "texto", "body_paragraphs", "paragraphs", "parrafos")
META_FIELDS = ("url", "link", "date", "fecha", "published", "authors", "autor", "autores", "tags", "keywords", "source", "fuente", "lang", "idioma")
ALERT_LABELS = (("codigo", "Alerta"), ("tipo", "Tipo"), ("fecha_emision", "Fecha"), ("municipios", "Municipios"), ("tema_clave", "Tema"))
# Tile plumbing columns and keys rows are collapsed on.
TILE_COLUMNS = {"tile_zoom", "tile_x", "tile_y", "zoom", "z", "x", "y"}
DEDUPE_KEYS = ("au_ID_concatenated", "au_id_concatenated", "id_concatenated")


def scan(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """(path, format, content): files of known suffix below ``folder``; ``limit`` keeps the first by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    fmt = F.element_at(F.create_map(*[F.lit(x) for kv in FORMAT_OF.items() for x in kv]), T.suffix(F.col("path")))
    out = files.select("path", fmt.alias("format"), "length", "modificationTime", "content").where("format is not null")
    return out.orderBy("path").limit(limit) if limit else out


def enough_words(text: Column, fmt: Column) -> Column:
    least = F.lit(DEFAULT_MIN_WORDS)
    for f, n in MIN_WORDS.items():
        least = F.when(fmt == f, n).otherwise(least)
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) >= least


class _Visible(html.parser.HTMLParser):
    SKIP = {"script", "style", "nav", "footer", "header", "aside", "noscript"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.SKIP

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


@F.pandas_udf(types.StringType())
def html_exact(pages: pd.Series) -> pd.Series:
    """Visible text by a real parser, for pages the expression form is too coarse for."""

    def one(p):
        if p is None:
            return None
        v = _Visible()
        v.feed(p)
        return "\n".join(v.parts)

    return pages.map(one)


def leaves(value) -> Iterator[str]:
    """The strings of nested lists and objects, in order, blank ones left out."""
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, str):
            if v.strip():
                yield v
        elif isinstance(v, dict):
            todo.extend(reversed(list(v.values())))
        elif isinstance(v, list):
            todo.extend(reversed(v))


def flatten(value) -> str:
    """Strings of nested lists and objects as paragraphs."""
    return "\n\n".join(leaves(value))


class Shape:
    """A special schema as a list of fields: ``root`` holds an object (or a list of
    them), ``labels`` are its scalar fields with what is written before them,
    ``body`` the field of nested text beside or inside it."""

    def __init__(self, root: str, kind: type, labels: tuple[tuple[str, str], ...], body: str, inside: bool, joint: str, title: tuple[str, ...] = ()):
        self.root, self.kind, self.labels, self.body, self.inside, self.joint, self.title = root, kind, labels, body, inside, joint, title

    def read(self, data: dict) -> tuple[str, str] | None:
        """Text and title, None if the document has another shape or nothing in it."""
        held = data.get(self.root)
        if not isinstance(held, self.kind):
            return None
        paragraphs: list[str] = []
        for record in held if self.kind is list else [held]:
            if not isinstance(record, dict):
                continue
            said = {k: str(record.get(k, "")).strip() for k, _ in self.labels}
            head = ". ".join(f"{label}{said[k]}" for k, label in self.labels if said[k])
            body = flatten((record if self.inside else data).get(self.body) or []).strip()
            if body or not self.inside:
                paragraphs.append(self.joint.join(x for x in (head, body) if x))
        labels = dict(self.labels)
        title = " — ".join(f"{labels[k].rstrip(': ')} {said[k]}" if n == 0 else said[k] for n, k in enumerate(self.title) if said[k]) if self.title else ""
        text = "\n\n".join(x for x in paragraphs if x)
        return (text, title) if text or not self.inside else None


SHAPES = (
    Shape("alerta_meta", dict, tuple((k, f"{label}: ") for k, label in ALERT_LABELS), "body_paragraphs", False, "\n\n", ("codigo", "municipios")),
    Shape("sections", list, (("heading", ""),), "paragraphs", True, ". "),
)


def json_document(raw: str | None) -> tuple[str, str, dict[str, str]]:
    """(text, title, meta): special schemas first if they give 20 words, then known
    fields in order with one body only, then every string there is."""
    try:
        data = json.loads(raw or "")
    except ValueError:
        return "", "", {}
    data = {"items": data} if isinstance(data, list) else data if isinstance(data, dict) else {"text": data}
    for shape in SHAPES:
        got = shape.read(data)
        if got and len(got[0].split()) >= DEFAULT_MIN_WORDS:
            return got[0], got[1], {}
    found = {k: flatten(data[k]).strip() for k in (*HEAD_FIELDS, *BODY_FIELDS) if data.get(k)}
    parts = [found[k] for k in HEAD_FIELDS if found.get(k)] + [found[k] for k in BODY_FIELDS if found.get(k)][:1]
    title = str(data.get("title") or data.get("titulo") or "").strip()
    return "\n\n".join(parts) or flatten(data), title, {k: json.dumps(data[k], ensure_ascii=False) if not isinstance(data[k], str) else data[k] for k in META_FIELDS if data.get(k)}


def read_json_documents(raw: DataFrame) -> DataFrame:
    """raw(path, value) -> (path, text, title, meta); malformed JSON gives an empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [json_document(v) for v in b["value"]]
            yield pd.DataFrame({"path": b["path"], "text": [r[0] for r in rows], "title": [r[1] for r in rows], "meta": [r[2] for r in rows]})

    out = raw.select("path", "value").mapInPandas(run, "path string, text string, title string, meta map<string,string>")
    return out.withColumn("text", T.clean(F.col("text")))


def json_fields(value: Column) -> Column:
    """The generic field rule as an expression, for JSON of flat string fields."""
    get = lambda k: F.nullif(F.trim(F.get_json_object(value, f"$.{k}")), F.lit(""))
    parts = F.array(*[get(k) for k in HEAD_FIELDS], F.coalesce(*[get(k) for k in BODY_FIELDS]))
    return F.array_join(F.filter(parts, lambda x: x.isNotNull()), "\n\n")


def rows_to_text(df: DataFrame, order: list[str], dedupe: str | None = None) -> DataFrame:
    """One line a row, 'column: value | column: value.': blank values left out,
    tile columns dropped, rows collapsed on the first known key (first by ``order``)."""
    key = dedupe or next((k for k in DEDUPE_KEYS if k in df.columns), None)
    if key:
        df = df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")
    cols = [c for c in df.columns if c.lower() not in TILE_COLUMNS]
    value = lambda c: F.col(f"`{c}`").cast("string")
    pairs = F.concat_ws(" | ", *[F.when(F.trim(value(c)) != "", F.concat(F.lit(f"{c}: "), value(c))) for c in cols])
    return df.select(*order, pairs.alias("line")).where("line <> ''").withColumn("line", F.concat("line", F.lit(".")))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column a string; malformed lines dropped."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="DROPMALFORMED", multiLine=True)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query) of JSON lines (new line the only separator) with any of the known keys; empty ones dropped."""
    raw = spark.read.option("lineSep", "\n").text(path)
    get = lambda *ks: F.coalesce(*[F.get_json_object("value", f"$.{k}") for k in ks])
    out = raw.where(F.trim("value") != "").select(get("query_id", "id").alias("query_id"), F.trim(get("query", "text", "consulta", "pregunta")).alias("query"))
    return out.where("query_id is not null and query <> ''").orderBy("query_id")


def fill_down(rows: DataFrame, column: str, order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The last value seen above where ``column`` is null or blank."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(F.nullif(F.trim(column), F.lit("")), ignorenulls=True).over(w))


def judgments(rows: DataFrame) -> DataFrame:
    """(query_id, chunk_id, grade): blank or invalid grades 0; queries with a relevant row only."""
    x = rows.select("query_id", "chunk_id", F.coalesce(F.col("grade").try_cast("double").cast("int"), F.lit(0)).alias("grade"))
    good = x.where("grade > 0").select("query_id").distinct()
    return x.join(good, "query_id", "left_semi")


def extract(files: DataFrame, provider: Callable[[], Callable[[bytes, str], list[str]]]) -> DataFrame:
    """(path, page, text, error) of binary files through a provider, made once a
    worker; a file that fails gives one row with its error and stops nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = provider()
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    rows += [(path, i, t, None) for i, t in enumerate(engine(content, path))]
                except Exception as e:  # noqa: BLE001  one bad file must not end the job
                    rows.append((path, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "page", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, text string, error string")


def boilerplate_free(pages: DataFrame, threshold: float = 0.6, least_pages: int = 4, longest: int = 120) -> DataFrame:
    """pages(doc_id, page, text) without first or last lines that stand on at least
    ``threshold`` of a document's pages, and without bare page numbers.  Documents
    of fewer than ``least_pages`` pages stay as they are."""
    filled = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    x = pages.withColumn("_l", filled)
    ends = x.where(F.size("_l") > 0).select("doc_id", F.explode(F.array(F.col("_l")[0], F.element_at("_l", -1))).alias("line"))
    n = pages.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    often = ends.groupBy("doc_id", "line").agg(F.count("*").alias("c")).join(n, "doc_id").where((F.col("c") >= threshold * F.col("n")) & (F.length("line") < longest))
    bad = n.select("doc_id").join(often.groupBy("doc_id").agg(F.collect_set("line").alias("bad")), "doc_id", "left").select("doc_id", F.coalesce("bad", F.array().cast("array<string>")).alias("bad"))
    keep = F.filter(F.split("text", "\n"), lambda ln: ~F.array_contains("bad", F.trim(ln)) & ~ln.rlike(r"^\s*\d{1,4}\s*$"))
    return x.drop("_l").join(bad, "doc_id", "left").withColumn("text", F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n"))).drop("bad")
