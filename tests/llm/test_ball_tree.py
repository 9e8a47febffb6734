"""Ranked search against a plain loop over all documents, and the bounds of the tree's nodes."""

import math
import random
import re
from collections import Counter

import numpy as np

from panelforge.llm import ball_tree

SCHEMA = "doc_id long, text string, item_id int, terms string, query int, n int"


def plain_terms(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_force(docs, items, k=10):
    """Per item, in order: [(rank, doc_id, score)]."""
    words = [(i, plain_terms(t)) for i, t in docs]
    held = [w for _, w in words if w]
    n_docs, n_terms = len(held), sum(map(len, held))
    df = Counter(t for w in held for t in set(w))
    out = []
    for _, text in items:
        scored = []
        for i, w in words:
            tf, score = Counter(w), 0
            for t in plain_terms(text):
                if tf[t]:
                    m = 25 + (75 * len(w) * n_docs) // n_terms
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out.append([(r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])])
    return out


def corpus(rng):
    def text(n):
        return " ".join(f"w{min(rng.randrange(300), rng.randrange(300))}" for _ in range(n))
    docs = [(i, text(rng.randrange(1, 80))) for i in range(400)]
    docs += [(500 + i, docs[7][1]) for i in range(15)]  # ties beyond the tenth rank
    docs += [(None, docs[7][1]), (700, None), (701, ""), (702, " \n?!"), (703, "W1, w1-W1\tÉé \x00w2"), (704, "w9 " * 30000),
             (705, "w5"), (705, "w5"), (705, "w6")]
    items = [(i, text(rng.randrange(1, 25))) for i in range(30)]
    items += [(90, docs[7][1]), (91, None), (92, "... "), (93, "É w1 W1 w1"), (94, "absent words only"), (None, "w5 w6"),
              (95, docs[8][1]), (95, docs[8][1])]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1, "x", 2, 3) for d in docs], SCHEMA),
            spark.createDataFrame([(*i, 7, "x") for i in items], "item_id int, text string, rank int, doc_id string"))


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return {i: sorted(rows, key=str) for i, rows in out.items()}


def expected(docs, items):
    out = {}
    for (i, _), rows in zip(items, brute_force(docs, items)):
        if rows:
            out.setdefault(i, []).extend(rows)
    return {i: sorted(rows, key=str) for i, rows in out.items()}


def test_ranks_equal_brute_force(spark):
    docs, items = corpus(random.Random(5))
    d, i = frames(spark, docs, items)
    got = ball_tree.ranked_search(d.repartition(3), i)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert found(got) == expected(docs, items)


def test_blocks_of_queries_change_nothing(spark):
    docs, items = corpus(random.Random(6))
    d, i = frames(spark, docs[:150], items[:12])
    assert found(ball_tree.ranked_search(d, i, block_bytes=400)) == expected(docs[:150], items[:12])


def test_small_shards_change_nothing(spark, monkeypatch):
    docs, items = corpus(random.Random(7))
    monkeypatch.setattr(ball_tree, "SHARD_DOCS", 20)  # goes to the workers with the closure
    d, i = frames(spark, docs, items[:20])
    assert found(ball_tree.ranked_search(d.coalesce(1), i)) == expected(docs, items[:20])


def test_empty_tables(spark):
    docs, items = corpus(random.Random(8))
    d, i = frames(spark, docs[:5], items[:3])
    assert ball_tree.ranked_search(d.limit(0), i).collect() == []
    nothing = ball_tree.ranked_search(d, i.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
    no_words = d.selectExpr("doc_id", "cast(null as string) AS text")
    assert ball_tree.ranked_search(no_words, i).collect() == []


def test_malformed_text_is_replaced(spark):
    d = spark.sql("SELECT 1L AS doc_id, cast(X'77FF20616263' AS string) AS text UNION ALL SELECT 2L, 'other abc abc'")
    i = spark.sql("SELECT 'q' AS item_id, 'abc' AS text")
    assert {r.doc_id for r in ball_tree.ranked_search(d, i).collect()} <= {1, 2}
    odd = spark.sql("SELECT 'q' AS item_id, 'w�' AS text")
    assert [r.doc_id for r in ball_tree.ranked_search(d, odd).collect()] == [1]


def tree_of(rng, rows=600, terms=400):
    topics = [[rng.randrange(terms) for _ in range(30)] for _ in range(8)]
    entries = [sorted({rng.choice(rng.choice(topics[r % 8:r % 8 + 1])) for _ in range(rng.randrange(1, 20))})
               for r in range(rows)]
    lengths = np.array(list(map(len, entries)))
    flat = np.array([t for e in entries for t in e])
    weights = np.array([rng.randrange(1, 10 ** 10) for _ in flat], np.int64)
    return ball_tree.BallTree(lengths, flat, weights), entries, weights, lengths


def test_no_row_exceeds_the_bounds_of_its_nodes():
    rng = random.Random(9)
    tree, entries, weights, lengths = tree_of(rng)
    ends = np.cumsum(lengths)
    for _ in range(40):
        words = [rng.randrange(400) for _ in range(rng.randrange(1, 30))]
        query = ball_tree.Query.of(words, {t: t for t in range(400)})
        counts = Counter(words)
        scores = [sum(counts[t] * int(w) for t, w in zip(e, weights[end - len(e):end])) for e, end in zip(entries, ends)]
        bounds = tree.bounds(query)
        for node, (low, high) in enumerate(tree.spans):
            assert max(scores[r] for r in tree.order[low:high]) <= bounds[node]
        best = []
        tree.search(query, best, list(range(len(entries))), 10)
        want = sorted(((s, -r) for r, s in enumerate(scores) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want


def test_subtrees_are_pruned():
    rng = random.Random(10)
    tree, entries, _, _ = tree_of(rng, rows=2000)
    leaves = sum(1 for c in tree.children if c is None)
    query = ball_tree.Query.of(entries[3], {t: t for t in range(400)})
    assert tree.search(query, [], list(range(2000)), 10) < leaves / 2
