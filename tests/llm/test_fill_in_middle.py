"""The transformation against plain string slicing, and exact round trips."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.llm import fill_in_middle as fim

TEXTS = [None, "", "\n", "\n\n", "one line", "a\nb\nc", "a\nb\nc\n", "é\nü🙂\n\nx", "<P> in it\nb", "<S>", "x<M>\ny", "<p>\n<s\n", "<\nP>\n<",
         ">\n>\n", "S>\nM>\n<", "r\r\nq\r", "long\n" * 30000, "no line end " * 20000, "\x00\n\x00"]


def sliced(doc_id, text, fim_percent=100, spm_percent=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def frame(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(6 * len(TEXTS))] + [(None, "a\nb"), (None, None), (3, "x\ny"), (3, "x\ny")]
    return rows, spark.createDataFrame([(*r, 1, "f", "o") for r in rows], "doc_id long, text string, n int, form string, output string")


@pytest.mark.parametrize("fim_percent, spm_percent", [(100, 50), (40, 100), (0, 0)])
def test_equals_slicing_and_restores(spark, fim_percent, spm_percent):
    rows, df = frame(spark)
    made = fim.restore_middle(fim.fill_in_middle(df.repartition(3), fim_percent=fim_percent, spm_percent=spm_percent))
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in made.collect()]
    want = [(i, *sliced(i, t, fim_percent, spm_percent), t or "") for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    forms = {r[2] for r in got}
    assert forms == ({"plain", "psm", "spm"} if fim_percent == 100 else {"plain", "spm"} if fim_percent else {"plain"})


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 9), st.text(alphabet=st.sampled_from("ab\n<>PSMé"), max_size=40))
def test_round_trip_of_any_text(doc_id, text):
    n, form, prefix, middle, output = fim.transformed(doc_id, text.encode())
    assert (n, form, prefix, middle, output.decode()) == sliced(doc_id, text)
    assert fim.restored(output, form).decode() == text


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_rotation_exchanges_blocks(raw, data):
    a, b, c = sorted(data.draw(st.integers(0, len(raw))) for _ in range(3))
    buffer = bytearray(raw)
    fim.rotate(buffer, a, b, c)
    assert bytes(buffer) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


def test_restore_keeps_other_columns(spark):
    rows = [(1, "psm", "<P>a<S>c<M>b", "x"), (2, None, "t", "y"), (3, "plain", None, None), (None, "spm", "<S>c<P>a<M>b", "x")]
    df = spark.createDataFrame(rows, "c1 int, kind string, raw string, restored string").toDF("c0", "kind", "raw", "restored")
    got = fim.restore_middle(df, "kind", "raw", "text").collect()
    assert [r.text for r in got] == ["abc", "t", "", "abc"]
    assert [tuple(r)[:4] for r in got] == [tuple(r) for r in rows]
    with pytest.raises(Exception, match="unknown form"):
        fim.restore_middle(df.withColumn("kind", F.lit("other")), "kind", "raw").collect()


def test_empty_table_and_malformed_text(spark):
    _, df = frame(spark)
    assert fim.fill_in_middle(df.limit(0)).collect() == []
    odd = spark.sql("SELECT 5L AS doc_id, cast(X'61FF0A62' AS string) AS text")
    row = fim.restore_middle(fim.fill_in_middle(odd)).first()
    assert row.restored == "a�\nb"
