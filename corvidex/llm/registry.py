"""Queries of the training-data problems and the SQL that checks them where SQL can."""

from __future__ import annotations

from .cut import p10_found, p10_rates
from .encode import encode_texts
from .language import p3_found, p3_segments
from .neardup import p5_classes, p5_found
from .neighbours import p1_found, p1_topk
from .leak import p9_found, p9_report
from .lookalike import p4_canonical, p4_found
from .rankfuse import p6_found, p6_ranking
from .scanned import p2_found, p2_repaired
from .repeated import _FROM, _TO, p7_blocks, p7_cleaned, p7_found
from .common import once, table


def p8_ids(spark, base):
    """Ids of every document.  Rows stored twice count once: only ids are counted,
    and only texts of repeated ids are exchanged."""
    docs = table(spark, base, "documents").select("doc_id", "text").where("doc_id is not null")
    return encode_texts(once(docs, "doc_id"))


QUERIES = {
    "p1_found": p1_found,
    "p1_topk": p1_topk,
    "p2_found": p2_found,
    "p2_repaired": p2_repaired,
    "p3_found": p3_found,
    "p3_segments": p3_segments,
    "p4_found": p4_found,
    "p4_canonical": p4_canonical,
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p6_found": p6_found,
    "p6_ranking": p6_ranking,
    "p7_found": p7_found,
    "p7_blocks": p7_blocks,
    "p7_cleaned": p7_cleaned,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_report": p9_report,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}

_P9 = r"""
WITH w AS (
  SELECT doc_id AS id, 'd' AS side, list_filter(string_split_regex(strip_accents(lower(text)), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT item_id, 'i', list_filter(string_split_regex(strip_accents(lower(text)), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark WHERE text IS NOT NULL),
g AS (SELECT DISTINCT id, side, array_to_string(ws[k:k+11], ' ') AS gram FROM (SELECT id, side, ws, unnest(range(1, len(ws) - 10)) AS k FROM w WHERE len(ws) >= 12))
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i ON d.gram = i.gram AND d.side = 'd' AND i.side = 'i'
"""

_P7 = rf"""
WITH l AS (
  SELECT DISTINCT chunk_id, fuente, k AS line_no, regexp_replace(translate(lower(ls[k]), '{_FROM}', '{_TO}'), '[^\p{{L}}]+', '', 'g') AS shape
  FROM (SELECT chunk_id, fuente, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT try_cast(chunk_id AS BIGINT) AS chunk_id, fuente, string_split(texto, chr(10)) AS ls FROM chunks WHERE texto IS NOT NULL))
  WHERE chunk_id IS NOT NULL),
s AS (SELECT fuente, count(DISTINCT try_cast(chunk_id AS BIGINT)) AS n FROM chunks GROUP BY fuente),
o AS (SELECT fuente, shape, count(DISTINCT chunk_id) AS docs FROM l WHERE shape <> '' GROUP BY fuente, shape)
SELECT DISTINCT l.chunk_id, CAST(l.line_no AS INTEGER) AS line_no FROM l
JOIN o ON l.shape = o.shape AND l.fuente IS NOT DISTINCT FROM o.fuente
JOIN s ON s.fuente IS NOT DISTINCT FROM o.fuente
WHERE o.docs >= 8 AND o.docs * 10 >= s.n
"""

ORACLE = {"p7_found": _P7, "p9_found": _P9}
