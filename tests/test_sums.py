"""Top k of sums against every score, and what reaches the exchange."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from corvidex.operators import graph, lexical, sums, vector


@pytest.mark.parametrize("k", [1, 7, 5000])
def test_top_sums_hold_the_best_and_little_more(spark, k):
    def features(b):
        c, f = lexical._lists(b.column(1))
        return f.astype(np.int64), c, lexical._lists(b.column(2))[1]

    rng = np.random.default_rng(1)
    rows = [(i, sorted(rng.choice(40, 5, replace=False).tolist()), rng.random(5).tolist()) for i in range(15_000)]
    stored = spark.createDataFrame(rows, "chunk_id bigint, f array<int>, v array<double>").repartition(2)  # blocks have 4,096 rows at most
    pairs = sorted({(int(q), int(f)) for q, f in zip(rng.integers(0, 30, 120), rng.integers(0, 40, 120))})
    got = sums.top_sums(stored, features, 40, sums.Groups(*np.array(pairs).T), k, len(rows)).collect()
    want = {}
    for q in {q for q, _ in pairs}:
        own = {f for p, f in pairs if p == q}
        scores = {i: sum(x for f, x in zip(fs, v) if f in own) for i, fs, v in rows}
        want[q] = sorted(((-s, i) for i, s in scores.items() if s > 0))[:k]
    for q, best in want.items():
        mine = sorted((-r.score, r.chunk_id) for r in got if r.q == q)
        assert [i for _, i in mine[:k]] == [i for _, i in best] and np.allclose([s for s, _ in mine[:k]], [s for s, _ in best])
        assert len(mine) <= max(2 * k, k + 60)


def test_a_term_counts_once_for_a_query_delivered_twice(spark):
    """Two texts under one query_id: its distinct terms, as in SQL."""
    c = spark.createDataFrame([(1, "rio agua"), (2, "mina"), (3, "sol")], "chunk_id bigint, text string")
    one = spark.createDataFrame([("q", "rio mina")], "query_id string, query string")
    two = one.unionByName(spark.createDataFrame([("q", "rio")], one.schema))
    rows = lambda q: sorted(map(tuple, lexical.bm25(c, q).collect()))
    assert rows(two) == rows(one)


def test_dense_block_in_bounded_memory():
    """2,000 queries against one batch of 10,000 vectors: all cosines at once would be 160 MB, and their sort more."""
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, (10_000, 8)).astype(np.float64) + 0.5  # many equal cosines
    block = pd.DataFrame({"chunk_id": rng.permutation(10_000), "embedding": list(v.astype(np.float32))})
    qi, qm = np.arange(2_000), rng.normal(size=(2_000, 8))
    qm /= np.linalg.norm(qm, axis=1, keepdims=True)
    tracemalloc.start()
    got = vector.best_of_block(qi, qm, block, 3, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    ids = block["chunk_id"].to_numpy()
    for q in range(0, 2_000, 97):
        s = np.round(u @ qm[q], 9)
        s[ids == q] = -np.inf
        assert got[got["query_id"] == q]["chunk_id"].tolist() == ids[np.lexsort((ids, -s))[:3]].tolist()
    assert len(got) == 6_000 and peak < 100e6


def test_every_entity_of_a_chunk_is_a_mention_and_pairs(spark):
    """A chunk of 20 names gives 20 mentions and all their pairs, beyond the twelve first."""
    names = [f"Grupo {a}{b}" for a in ("Norte", "Sur", "Este", "Oeste") for b in ("uno", "dos", "tres", "cinco", "seis")]
    c = spark.createDataFrame([(1, "d", "hoy " + ", ".join(names))], "chunk_id bigint, doc_id string, text string")
    m = graph.clean_mentions(graph.heuristic_mentions(c))
    assert sorted(r.ordinal for r in m.collect()) == list(range(1, 21))
    rows = graph.labelled_pairs(m, m.select("entity").distinct(), c).collect()
    assert len({(r.a, r.b) for r in rows}) == 190 and {r.doc_id for r in rows} == {"d"}


def test_graph_search_ways_agree(spark, monkeypatch):
    """Seeds sent or joined, edges of all entities or of the seeds: one ranking, that of every pair summed up."""
    rng = np.random.default_rng(3)
    where = sorted({(f"e{e}", int(c)) for e, c in zip(rng.integers(0, 12, 300) ** 2 // 12, rng.integers(0, 80, 300))})
    linked = [("q1", "e0"), ("q1", "e5"), ("q2", "e10"), ("q3", "e0")]
    held = {}
    for e, c in where:
        held.setdefault(c, set()).add(e)
    peso = {}
    for es in held.values():
        for a in es:
            for b in es - {a}:
                peso[a, b] = peso.get((a, b), 0) + 1
    want = []
    for q in ("q1", "q2", "q3"):
        own = [e for x, e in linked if x == q]
        scores = {c: round(sum((s in es) + sum(0.4 * min(peso[s, o], 10) / 10 for o in es if (s, o) in peso) for s in own), 9) for c, es in held.items()}
        want += [(q, c, s, k + 1) for k, (c, s) in enumerate(sorted(((c, s) for c, s in scores.items() if s > 0), key=lambda x: (-x[1], x[0]))[:9])]
    nodes, seeds = spark.createDataFrame(where, "entity string, chunk_id bigint"), spark.createDataFrame(linked, "query_id string, entity string")
    e = graph.seed_pairs(nodes, seeds)
    full = {(a, b): n for (a, b), n in peso.items() if a < b and {a, b} & {"e0", "e5", "e10"}}
    assert {(r.a, r.b): r.peso for r in e.collect()} == full
    run = lambda: sorted(tuple(r[c] for c in ("query_id", "chunk_id", "score", "rank")) for r in graph.graph_search(seeds, nodes, e, 9).collect())
    assert run() == sorted(want)
    monkeypatch.setattr(graph, "SENT_ROWS", -1)
    assert run() == sorted(want)
