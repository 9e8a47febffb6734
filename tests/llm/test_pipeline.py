"""The pipeline's stages against brute force, and the registered queries on the smallest tables."""

import itertools
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from panelforge.sources.tables import read_table  # noqa: E402

from .test_operators import judged, removed_words, shingles  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents and of every stage, by doc_id."""
    docs = read_table(spark, SF, "documents")
    out, current = [{r.doc_id: r for r in docs.collect()}], docs
    for _, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, SF)
        rows = current.collect()
        out.append({r.doc_id: r for r in rows})
        assert len(rows) == len(out[-1])
        current = spark.createDataFrame(rows, current.schema)
    return out


def test_language_stage_keeps_texts_with_words(stages):
    gone = [stages[0][i].text for i in stages[0].keys() - stages[1].keys()]
    assert len(gone) <= 0.02 * len(stages[0])
    assert all(stages[1][i] == stages[0][i] for i in stages[1])


def test_language_stage_rejects_what_fits_no_language(spark):
    docs = read_table(spark, SF, "documents")
    planted = ["Это простой русский текст о погоде и о книгах. " * 5, "日本語の文章です。今日は天気がいいですね。" * 6,
               "هذا نص عربي بسيط عن الطقس والكتب " * 5, "Το ελληνικό κείμενο είναι εδώ για δοκιμή " * 5,
               "한국어 문장입니다 오늘 날씨 " * 6, "123 456 + 789 = ?", "", None, "\n \t"]
    rows = [(10 ** 6 + i, t, None, "planted", 0) for i, t in enumerate(planted)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, both, SF).collect()}
    no_letter = {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert kept == {r.doc_id for r in docs.collect()} - no_letter


def test_near_duplicate_stage(stages):
    texts = {i: shingles(r.text, 5) for i, r in stages[1].items()}
    linked = {i: {i} for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        inter = len(texts[a] & texts[b])
        if inter and 100 * inter >= 80 * len(texts[a] | texts[b]):
            both = linked[a] | linked[b]
            for i in both:
                linked[i] = both
    assert set(stages[2]) == {min(group) for group in linked.values()}


def test_substring_stage(stages):
    docs = [(i, r.text) for i, r in stages[2].items()]
    want = {i: (t if gone else stages[2][i].text) for i, _, gone, t in removed_words(docs) if t or not gone}
    assert {i: r.text for i, r in stages[3].items()} == want
    assert all(r.n_chars == len(r.text) for r in stages[3].values())


def test_decontamination_stage(stages, spark):
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    verdicts = judged([(i, r.text) for i, r in stages[3].items()], items)
    assert set(stages[4]) == {int(v[0]) for v in verdicts if not v[-1]}
    assert len(stages[4]) < len(stages[3])


def test_last_stage_encodes_every_text(stages, spark):
    assert stages[5].keys() == stages[4].keys()
    assert all(r.round_trip and r.n_chars == len(stages[4][i].text) for i, r in stages[5].items())
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.pieces_sha256 for r in rows} == {i: r.pieces_sha256 for i, r in stages[5].items()}


def test_stages_take_odd_rows(spark):
    """Null and empty texts go at the first stage; later stages bear them too."""
    schema = read_table(spark, SF, "documents").schema
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Some words here", "en", "s", 15),
                                  (3, "Some words here", "en", "s", 15), (None, "Without an id", None, None, 3)], schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= 5
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_near_duplicate_stage_keeps_one_row_of_repeats(spark):
    """Repeated rows, copies without an id, and several texts of one id."""
    def words(name, n=60):
        return " ".join(f"{name}{i}" for i in range(n))

    def near(text, *, at):
        parts = text.split()
        return " ".join([*parts[:at], "changed", *parts[at + 1:]])
    a, b, c, d, e, f = map(words, "abcdef")
    rows = [(3, a, "y", "s", 1), (3, a, "x", "s", 1), (3, a, "y", "s", 1), (5, a, "x", "s", 1), (5, a, "x", "s", 1), (6, near(a, at=0), "x", "s", 1)]
    rows += [(None, b, lang, "s", 1) for lang in ("z", "x", None, "y")] + [(None, a, "x", "s", 1)]
    rows += [(7, c, "x", "s", 1), (7, d, "x", "s", 1), (7, d, "x", "s", 1), (8, near(d, at=0), "x", "s", 1)]  # unlinked texts of one id
    rows += [(9, e, "x", "s", 1), (9, near(e, at=0), "x", "s", 1), (2, near(e, at=0), "x", "s", 1)]  # linked ones
    rows += [(10, f, "x", "s", 1), (10, near(near(f, at=0), at=59), "x", "s", 1), (11, near(f, at=0), "x", "s", 1)]
    rows += [(None, None, "x", "s", 1), (12, "", "x", "s", 0), (12, "", "x", "s", 0), (13, words("g"), "x", "s", 1)]
    docs = spark.createDataFrame(rows, read_table(spark, SF, "documents").schema).repartition(4)
    got = sorted((tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    tens = [r for r in got if r[0] == 10]
    assert len(tens) == 1 and tens[0] in rows
    want = [(3, a, "x", "s", 1), (None, b, None, "s", 1), (7, c, "x", "s", 1), (7, d, "x", "s", 1),
            (2, near(e, at=0), "x", "s", 1), *rows[-4:]]
    assert sorted((r for r in got if r[0] != 10), key=str) == sorted(want, key=str)


def test_registered_queries_return_their_whole_tables(spark):
    queries = __spark_entry__.queries()
    names = [n for n in queries if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    n_docs, n_pages = read_table(spark, SF, "documents").count(), read_table(spark, SF, "pages").count()
    n_items = read_table(spark, SF, "benchmark").count()
    for name in names:
        n = n_pages if name.startswith(("op1_", "op4_")) else 10 * n_items if name.startswith("op11_") else n_docs
        rows = queries[name](spark, SF)
        if name.startswith("op12_"):  # pieces: every document has some, and all its tokens lie in them
            rows = rows.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).filter("n = doc_tokens")
        assert rows.count() == n, name


def test_oracle_sql_agrees(spark):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    from panelforge.llm.oracle import ORACLE_SQL
    for name, sql in ORACLE_SQL.items():
        con.sql(sql).create_view(f"v_{name}")  # as the driver registers it
        df = __spark_entry__.queries()[name](spark, SF)
        columns = ", ".join(sorted(df.columns))
        want = sorted(con.sql(f"SELECT {columns} FROM v_{name}").fetchall(), key=str)
        got = sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)
        assert got == want, name


def test_prediction_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in read_table(spark, SF, "documents").collect()}
    rows = __spark_entry__.queries()["op6_language_id"](spark, SF).filter("held_out AND lang_pred <> 'und'").collect()
    assert sum(truth[r.doc_id] == r.lang_pred for r in rows) >= 0.9 * len(rows)
