"""Packed sequences against the tokenizer library, and the properties of differencing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm import packing
from panelforge.llm.packing import Piece


def library_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in tokenizer.encode_batch(text, add_special_tokens=False)]


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "\n", "é ü", "a b  c", "x\x1cy \x1c z", "don't 's 'll",
       "<|endoftext|>", "a <|endoftext|> b", "tail <|endoftext|>", "日本語 テキスト", "🙂 🙂🙂", "1 22 333", "\t\ttab  \t", "a　 b",
       "\x85 next", "end\r\n", "word " * 50, "?!? ... --", "​ zero", "᠎ old"]


def test_ids_equal_the_library():
    encode = packing.TokenIds(public_tokenizers.path(packing.RANKS))
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(ODD) for _ in range(rng.randrange(12))) for _ in range(300)]
    assert [ids.tolist() for ids in encode(texts)] == library_ids(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab' \n\t \x1c\x85é1.<|>"), max_size=30), max_size=6))
def test_ids_equal_the_library_on_white_space(texts):
    encode = packing._token_ids(public_tokenizers.path(packing.RANKS))
    assert [ids.tolist() for ids in encode(texts)] == library_ids(texts)


def documents(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "of", "x1", "Ünï", "?"]) for _ in range(rng.randrange(1, 900))))
            for i in range(120)]
    rows += [(200, None), (201, ""), (202, "long " * 9000), (None, "no id"), (3, "again 3"), (3, "again 3"), (203, "<|endoftext|>")]
    return rows, spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id long, text string, start int, ids string")


def check_pieces(rows, made, window=2048):
    """Every document's ids lie once in its pieces; every sequence is gapless and fits.  Returns the padding."""
    want = sorted(((i if i is not None else -1, tuple(ids + [1])) for (i, _), ids in
                   zip(rows, library_ids([t or "" for _, t in rows]))))
    by_doc, sequences = {}, {}
    for r in made:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc.setdefault((r.doc_id if r.doc_id is not None else -1, r.doc_tokens), []).append((r.start, tuple(ids)))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    # rows that repeat an id and a length are told apart by their order alone: compare the multisets of pieces
    got = []
    for (doc_id, tokens), parts in by_doc.items():
        copies = sum(1 for start, _ in parts if start == 0)
        text = tuple(t for _, ids in sorted(set(parts)) for t in ids)
        assert len(text) == tokens
        got += [(doc_id, text)] * copies
    assert sorted(got) == want
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_pieces_hold_every_id_once(spark):
    rows, df = documents(spark)
    made = packing.pack_documents(df.repartition(3)).collect()
    padding = check_pieces(rows, made)
    assert padding <= 0.01 * sum(r.length for r in made)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_small_blocks(spark, block):
    rows, df = documents(spark)
    made = packing.pack_documents(df, window=256, block_windows=block).collect()
    check_pieces(rows, made, 256)


def test_sequences_are_put_together(spark):
    rows, df = documents(spark)
    pieces = packing.pack_documents(df).cache()
    whole = packing.packed_sequences(pieces).collect()
    total = pieces.agg(F.sum("length")).first()[0]
    assert sum(s.n_tokens for s in whole) == total and all(4 * s.n_tokens == len(s.ids) for s in whole)
    one = whole[0]
    parts = sorted(pieces.filter(F.col("sequence_id") == one.sequence_id).collect(), key=lambda r: r.offset)
    assert bytes(one.ids) == b"".join(bytes(p.ids) for p in parts)
    crc = pieces.select("ids", F.crc32("ids").alias("crc")).first()
    assert crc.crc == zlib.crc32(bytes(crc.ids))


def test_empty_table_and_malformed_text(spark):
    _, df = documents(spark)
    assert packing.pack_documents(df.limit(0)).collect() == []
    odd = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    made = packing.pack_documents(odd).collect()
    assert sum(r.length for r in made) == len(library_ids(["a�b"])[0]) + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=60), st.integers(1, 12))
def test_differencing_deals_every_piece_once(sizes, windows):
    parts = packing.difference(sizes, windows)
    assert sorted(i for _, members in parts for i in members) == list(range(len(sizes)))
    assert all(total == sum(sizes[i] for i in members) for total, members in parts)
    assert len(parts) <= windows and [t for t, _ in parts] == sorted((t for t, _ in parts), reverse=True)
    # differencing is never worse than the largest piece above the mean
    assert parts[0][0] <= sum(sizes) / windows + max(sizes)


def test_differencing_known_case():
    assert [t for t, _ in packing.difference([8, 7, 6, 5, 4], 2)] == [16, 14]
    assert [t for t, _ in packing.difference([4, 5, 6, 7, 8], 3)] in ([11, 11, 8], [12, 10, 8])


def test_window_count_rises_where_capacity_is_exceeded():
    pieces = [Piece(i, 0, 6) for i in range(4)]
    windows = packing.level_windows(pieces, 10)
    assert all(sum(p.length for p in w) <= 10 for w in windows)
    assert sum(p.length for w in windows for p in w) == 24


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=50))
def test_packer_covers_every_token(lengths):
    packer = packing.Packer(256, 3)
    made = [s for i, n in enumerate(lengths) for s in packer.add(i, n)] + list(packer.close())
    held = sorted((p.doc, p.start, p.length) for s in made for p in s)
    for i, n in enumerate(lengths):
        at = 0
        for _, start, length in [h for h in held if h[0] == i]:
            assert start == at
            at += length
        assert at == n
    assert all(0 < sum(p.length for p in s) <= 256 for s in made)
