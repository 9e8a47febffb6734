"""The corpus operators against brute force on small frames, with the odd cases of every table."""

import gzip
import hashlib
import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm import decontaminate, importance, language_id, license_scan, minhash, pieces
from panelforge.llm import quality_rules, substring_dedup, token_counts, warc

SCHEMA = "doc_id long, text string, lang string, source string, text_key string, c0 int"


def frame(spark, texts, schema=SCHEMA):
    """(doc_id, text[, lang[, source]]) rows with extra columns whose names clash with inner ones."""
    return spark.createDataFrame(
        [(t[0], t[1], t[2] if len(t) > 2 else None, t[3] if len(t) > 3 else None, "x", 1) for t in texts], schema)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "One"), (905, "a b c"), (906, "é" * 30),
       (907, "x " * 6000), (908, "\x1c\x85 \xa0 q"), (None, "no id here " * 20), (909, "no id here " * 20)]


def corpus():
    rng = random.Random(3)
    out = list(ODD)
    base = sentence(rng, 300).split()
    for i in range(30):  # near copies of one text
        copy = list(base)
        for _ in range(rng.randrange(0, 8)):
            copy[rng.randrange(300)] = f"n{rng.randrange(99)}"
        out.append((i, " ".join(copy)))
    for i in range(30, 50):  # a shared passage inside others
        out.append((i, f"{sentence(rng, 40)} {' '.join(base[50:50 + rng.randrange(45, 160)])}\n{sentence(rng, 60)}"))
    out += [(i, sentence(rng, rng.randrange(1, 120))) for i in range(50, 70)]
    out += [(70, out[12][1]), (71, out[12][1]), (71, out[12][1])]
    return out


# ---- near duplicates

def shingles(text, k):
    w = words(lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_minhash_equals_brute_force(spark):
    docs = corpus()
    got = {(r.doc_id, r.text_key): r for r in minhash.near_duplicates(frame(spark, docs)).collect()}
    sets = [shingles(t, 4) for _, t in docs]
    ids = [i for i, _ in docs]
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in itertools.combinations(range(len(docs)), 2):
        inter = len(sets[a] & sets[b])
        if inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    rows = {}
    for r in got.values():
        rows.setdefault(r.doc_id, r)
    assert sum(1 for _ in minhash.near_duplicates(frame(spark, docs)).collect()) == len(docs)
    for i, (doc, _) in enumerate(docs):
        if doc is None:
            continue
        assert rows[doc].n_shingles == len(sets[i])
        assert rows[doc].component_id == (least[find(i)] if sets[i] else doc), doc
        assert rows[doc].kept == (rows[doc].component_id == doc)
    assert rows[None].component_id == 909 and not rows[None].kept  # shares its text with 909


def test_minhash_second_round_finds_links_that_no_bucket_head_has(spark):
    # a chain: each text shares most with the next one only
    rng = random.Random(8)
    long = [f"c{i}" for i in range(420)]
    docs = [(i, " ".join(long[i * 10:i * 10 + 200])) for i in range(20)] + [(50, sentence(rng, 100))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, docs)).collect()}
    assert all(got[i] == 0 for i in range(20)) and got[50] == 50


def test_minhash_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    union = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    left, right = (minhash.packed(minhash.minima(s)) for s in (union[:900], union[100:]))
    x = left ^ right
    differ = sum(bin(int((v | (v >> np.uint64(1))) & np.uint64(0x5555555555555555))).count("1") for v in x)
    estimate = ((1 - differ / minhash.MINIMA) - 0.25) / 0.75
    assert abs(estimate - 0.8) < 0.2
    assert minhash._cut(0.8) < 0.6


def test_drop_near_duplicates_keeps_columns_and_one_row(spark):
    docs = frame(spark, corpus())
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert 0 in kept and not set(range(1, 30)) & set(kept) and 900 in kept and None not in kept


# ---- substrings

def removed_words(docs, window=50):
    starts = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i:i + window])
                starts[key] = min(doc, starts.get(key, doc))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and starts[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_substring_removal_equals_brute_force(spark):
    docs = corpus()
    rows = substring_dedup.repeated_passages(frame(spark, docs)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows)
    want = sorted((str(d), n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in removed_words(docs))
    assert got == want
    assert sum(r.n_removed for r in rows) > 1000
    texts = {r.doc_id: r.kept_text for r in rows if r.kept_text is not None}
    assert texts == {d: t for d, _, g, t in removed_words(docs) if g}


def test_substring_longest_repeat(spark):
    rng = random.Random(4)
    passage = sentence(rng, 230, 10 ** 6)
    docs = [(1, f"{sentence(rng, 30, 10 ** 6)} {passage}"), (2, f"{passage} {sentence(rng, 70, 10 ** 6)}"),
            (3, " ".join(passage.split()[10:70]) + " end"), (4, sentence(rng, 90, 10 ** 6)), (5, "short"), (6, passage), (7, passage)]
    got = {r.doc_id: r.longest_repeat for r in substring_dedup.repeated_passages(frame(spark, docs)).collect()}
    assert got == {1: 200, 2: 200, 3: 50, 4: 0, 5: 0, 6: 200, 7: None}


def test_remove_repeats_keeps_the_rest_of_the_rows(spark):
    docs = frame(spark, corpus())
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    want = {d: t for d, _, g, t in removed_words(corpus()) if g}
    got = {r.doc_id: r.text for r in out.collect()}
    for doc, text in corpus():
        if doc in want:
            assert got.get(doc) == (want[doc] or None)
        else:
            assert got[doc] == text


def test_sliding_least():
    values = np.random.default_rng(2).integers(0, 99, 60).astype(np.uint64)
    for width in (1, 2, 7, 26):
        assert substring_dedup.sliding_least(values, width).tolist() == [
            min(values[i:i + width]) for i in range(60 - width + 1)]


# ---- decontamination

def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def judged(docs, items, window=13):
    out = []
    for doc, text in docs:
        w, hit, own = bench_words(text), set(), set()
        for item, phrase in items:
            p = bench_words(phrase)
            k = min(window, len(p))
            if not k:
                continue
            wanted = {tuple(p[i:i + k]) for i in range(len(p) - k + 1)}
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wanted:
                    hit.update(range(i, i + k))
                    own |= {str(item)} - {"None"}  # an item without an id hits, but is not named
        names = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(own), names, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes,shard_words", [(1 << 24, 1 << 18), (300, 50)])
def test_contamination_equals_brute_force(spark, block_bytes, shard_words):
    rng = random.Random(5)
    items = [(i, sentence(rng, rng.randrange(10, 60), 50)) for i in range(12)]
    items += [(20, "w1 w2 w1"), (21, "é"), (22, ""), (23, None), (None, "w1 w2"), (24, items[0][1]), (25, "Solo")]
    docs = ODD + [(i, f"{sentence(rng, rng.randrange(0, 400), 50)}, {items[i % 12][1].upper()}!{sentence(rng, 9, 50)}")
                  for i in range(25)] + [(30, "w1-w2 W1 w2 w1"), (31, "solo é"), (31, "nothing")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(frame(spark, docs), bench, block_bytes=block_bytes, shard_words=shard_words)
    rows = out.collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) \
        == judged(docs, items)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in rows)
    assert all(a.end < b.start for r in rows for a, b in zip(r.spans, r.spans[1:]))


def test_decontaminate_drops_only_contaminated_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = frame(spark, [(1, "Alpha, beta gamma"), (2, "x " * 100 + "alpha beta gamma"), (3, None), (4, "alpha beta")])
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == [2, 3, 4]
    empty = bench.limit(0)
    assert decontaminate.decontaminate(docs, empty).count() == 4


@pytest.mark.parametrize("block_bytes", [1 << 22, 20])
def test_items_without_an_id_hit(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    bench = spark.createDataFrame([(None, "one two three"), (None, "four five six seven"), (7, "eight nine"), (8, "ten eleven")],
                                  "item_id long, text string")
    docs = frame(spark, [(1, "one two three"), (2, "eight nine four five six seven"), (2, "clean"), (None, "ten eleven"),
                         (3, None), (4, "one two"), (5, "z " * 70 + "one two three ten eleven"), (1, "one two three")])
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.contaminated)
                 for r in decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect())
    assert got == [("1", 3, 3, 0, True), ("1", 3, 3, 0, True), ("2", 1, 0, 0, False), ("2", 6, 6, 1, True), ("3", 0, 0, 0, False),
                   ("4", 2, 0, 0, False), ("5", 75, 5, 1, True), ("None", 2, 2, 1, True)]
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(2, "clean"), (3, None), (4, "one two")]


def test_fm_index_finds_and_locates():
    rng = np.random.default_rng(6)
    sequence = rng.integers(1, 6, 500)
    index = decontaminate.FMIndex(sequence, 6, sample_every=7)
    phrases = [sequence[i:i + n] for i, n in ((0, 3), (100, 13), (497, 3), (20, 1))] + [np.array([5, 5, 5, 5, 5, 5, 5])]
    matrix = np.zeros((len(phrases), 13), np.int64)
    for i, p in enumerate(phrases):
        matrix[i, 13 - len(p):] = p
    lo, hi = index.search(matrix, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, lo, hi):
        want = [i for i in range(500 - len(p) + 1) if (sequence[i:i + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# ---- token counts

@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoded(bpe, text):
    return len(bpe.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_library_s_count(bpe):
    counter = token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    parts = ["a", "the", "thing", " ", "  ", "\n", "'", "'s", "'re", " 'll", "é", "漢字", "😀", "12", "!", "$$$", "<|endoftext|>",
             "<|endo", "\t", "\x1c", "\x85", "\xa0", "▁", "_", "tionment", "QUE"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert counter.table(text).tolist() == [encoded(bpe, text[:i]) for i in range(len(text) + 1)], text


def test_token_counts_query(spark, bpe):
    rng = random.Random(2)
    docs = ODD + [(1, sentence(rng, 1500)), (2, "aaaa" * 2000), (2, "other <|endoftext|> text")]
    out = token_counts.prefix_token_counts(frame(spark, docs), limit=300, tables=True).collect()
    texts = sorted((str(d), t or "") for d, t in docs)
    for (doc, text), r in zip(texts, sorted(out, key=lambda r: (str(r.doc_id), r.n_bytes))):
        if docs.count((r.doc_id, text)) and len([1 for d, _ in texts if d == doc]) == 1:
            assert (r.n_bytes, r.n_tokens) == (len(text.encode()), encoded(bpe, text))
            assert r.over_limit == (r.n_tokens > 300)
            fits = [i for i, n in enumerate(r.prefix_tokens) if n <= 300]
            assert r.chars_in_limit == fits[-1] and encoded(bpe, text[:fits[-1]]) <= 300


def test_token_counts_of_malformed_text(spark, bpe):
    df = spark.sql("SELECT 1L AS doc_id, cast(X'61FF20FF62' AS string) AS text UNION ALL SELECT 2L, 'x'")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.prefix_token_counts(df).collect()}
    assert got == {1: (9, encoded(bpe, "a\ufffd \ufffdb")), 2: (1, 1)}


def test_word_tables_equal_the_table_of_each_word(bpe):
    counter = token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(13)
    words = ["".join(rng.choice("abetionsßçê漢ж") for _ in range(rng.randrange(1, 15))) for _ in range(400)] + ["the", "don", "x" * 15]
    got = counter._word_differences([" " + w for w in words] + words)
    for i, word in enumerate([" " + w for w in words] + words):
        assert np.cumsum(got.row(np.array([i]))).tolist() == counter._chars(word), word
    stretches = ["a.\nB", "foo\nbar\nbaz!?", "x" * 40, "\n", "a\n\nb", "'s", "don't", "w.x", "é,\nß"] + words
    entries, place = counter._differences(stretches)
    for stretch, at in zip(stretches, place.tolist()):
        made = np.cumsum(entries.row(np.array([at]))).tolist()
        assert made == [encoded(bpe, " " + stretch[:n]) for n in range(len(stretch) + 1)] or stretch[:1].isspace()


# ---- pieces

@pytest.fixture(scope="module")
def lattice():
    return pieces.PieceLattice(public_tokenizers.path("piece_bpe_32k.model"))


def all_segmentations(lattice, text):
    incoming = lattice.forward(text)[1]

    def ending(end):
        if not end:
            return [(0, ())]
        return [(score + more, ids + own) for a, more, own in incoming[end] for score, ids in ending(a)]
    return ending(len(text))


@pytest.mark.parametrize("text", [" hello", "aaaaaaa", " the", "é▁x", "   x", " tionble", " 漢\n"])
def test_search_gives_the_n_best_of_all(lattice, text):
    everything = sorted(all_segmentations(lattice, text), key=lambda s: -s[0])
    (top, gap, ids), _ = lattice.best(text, lattice.forward(text[:3] + "other"))
    found = lattice.search(text, 5)
    assert [top - loss for loss, _ in found] == [s for s, _ in everything[:5]]
    assert found[0] == (0, ids) and set((top - loss, i) for loss, i in found) <= set(everything)
    assert len(found) < 2 or found[1][0] == gap


def test_whole_text_n_best_combines_its_stretches(lattice):
    text = "the of  thtion"
    everything = sorted((s for s, _ in all_segmentations(lattice, " " + text)), reverse=True)
    score, found = lattice.nbest(text, 4)
    assert [score - loss for loss, _ in found] == everything[:4]
    assert len({ids for _, ids in found}) == 4 and all(lattice.decode(ids) == text for _, ids in found)


def test_encode_pieces_round_trip(spark, lattice):
    docs = ODD + [(1, "Lead  and trail "), (2, " ▁ literal▁"), (3, "<s> not a control </s>"), (4, "日本語 テスト 😀")]
    rows = pieces.encode_pieces(frame(spark, docs)).collect()
    assert len(rows) == len(docs) and all(r.round_trip for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[900].n_pieces == by_id[901].n_pieces == by_id[900].score == 0
    for doc, text in docs:
        assert lattice.decode(by_id[doc].pieces) == (text or "")
        assert by_id[doc].losses[0] == 0 and list(by_id[doc].losses) == sorted(by_id[doc].losses)


def test_batched_viterbi_equals_the_lattice(lattice):
    rng = random.Random(12)
    texts = ["", " ", "  ", "é▁x", " \n", "日本語😀", "漢a", "aaaaaaaa", "😀😀x", "\x00", "a b", "  q", "x" * 63, "y" * 64, "the " * 40,
             "tionble" * 30]
    texts += ["".join(rng.choice("abethionßç漢😀1. ") for _ in range(rng.randrange(1, 63))) for _ in range(400)]
    scores, gaps, ids = lattice.best_of(texts)
    for i, text in enumerate(texts):
        assert (int(scores[i]), int(gaps[i]), tuple(ids.row(np.array([i])).tolist())) == lattice.best(" " + text)[0]
    assert [len(a) for a in lattice.best_of([])[:2]] == [0, 0]


def test_every_segmentation_decodes_to_its_text(spark, lattice):
    docs = [d for d in ODD if d[0] is not None] + [(1, "the of  thtion"), (2, "日本 テ😀 x"), (3, "one")]
    encoded = pieces.encode_pieces(frame(spark, docs))
    rows = pieces.decode_pieces(pieces.segmentations(encoded).withColumn("raw", F.lit(1)), "pieces", "text").collect()
    texts = {i: t or "" for i, t in docs}
    found = {}
    for r in rows:
        assert r.text == texts[r.doc_id]
        found.setdefault(r.doc_id, []).append((r.rank, r.score, tuple(r.pieces)))
    for i, text in texts.items():
        score, best = lattice.nbest(text)
        assert sorted(found[i]) == [(k + 1, score - loss, ids) for k, (loss, ids) in enumerate(best)]
        assert len({ids for _, _, ids in found[i]}) == len(best)


def test_decoding_odd_rows(spark):
    df = spark.createDataFrame([(1, [], 5), (2, None, 6), (3, [28705, None], 7)], "c1 int, c0 array<int>, decoded int")
    got = pieces.decode_pieces(df, "c0", "text").collect()
    assert [(r.c1, r.decoded, r.text) for r in got] == [(1, 5, ""), (2, 6, ""), (3, 7, "")]
    for bad in (-1, 40000):
        with pytest.raises(Exception, match="IndexError|no piece"):
            pieces.decode_pieces(spark.createDataFrame([([bad],)], "pieces array<int>")).collect()
    malformed = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    row = pieces.decode_pieces(pieces.encode_pieces(malformed)).first()
    assert row.round_trip and row.decoded == "a\ufffdb"


# ---- language

def labelled(n=240):
    rng = random.Random(7)
    alphabet = {"aa": "abcdeé", "bb": "uvwxyz", "cc": "ключи"}
    out = []
    for i in range(n):
        lang = rng.choice(sorted(alphabet))
        out.append((i, " ".join("".join(rng.choice(alphabet[lang]) for _ in range(5)) for _ in range(30)), lang, "s"))
    return out


def test_language_on_held_out_rows(spark):
    docs = frame(spark, labelled())
    network = language_id.train_language_model(docs, rows_per_language=60)
    assert network.labels == ["aa", "bb", "cc"]
    out = language_id.identify_language(docs, network)
    rows = out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score").collect()
    truth = {d: lang for d, _, lang, _ in labelled()}
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    again = language_id.train_language_model(docs.repartition(5), rows_per_language=60)
    assert all(np.array_equal(a, b) for a, b in zip(network.tables, again.tables))


def test_language_of_odd_texts(spark):
    docs = frame(spark, ODD + [(1, "123 !?"), (2, "x" * 5000)])
    network = language_id.train_language_model(frame(spark, labelled(40)), rows_per_language=20)
    rows = {r.doc_id: r for r in language_id.identify_language(docs, network).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (900, 901, 902, 1))
    assert rows[2].lang_pred in network.labels
    assert language_id.train_language_model(frame(spark, ODD)) is None  # no label
    assert {r.lang_pred for r in language_id.identify_language(docs, None).collect()} == {"und"}
    kept = language_id.keep_identified(docs, network, 0.0)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.lang_pred != "und"}


def test_fast_network_equals_training_form():
    network = language_id.ByteNetwork(["a", "b"])
    x = np.random.default_rng(3).integers(0, 256, (9, language_id.WINDOW_BYTES)).astype(np.uint8)
    assert np.allclose(network._pooled(x)[0], network._fast_pooled(x), atol=1e-4)


def small_network(rng, labels=("a", "b", "c")):
    network = language_id.ByteNetwork(list(labels))
    network.bias = [rng.normal(0, 0.2, b.shape).astype(np.float32) for b in network.bias]
    network.out_bias = rng.normal(0, 0.2, network.out_bias.shape).astype(np.float32)
    return network


def loop_probabilities(network, window):
    """One filter at a time over one place at a time."""
    hidden = []
    for table, bias in zip(network.tables, network.bias):
        width, _, filters = table.shape
        for f in range(filters):
            best = max(sum(float(table[k][window[i + k]][f]) for k in range(width)) for i in range(len(window) - width + 1))
            hidden.append(max(best + float(bias[f]), 0.0))
    z = [sum(h * float(network.out[i][c]) for i, h in enumerate(hidden)) + float(network.out_bias[c])
         for c in range(len(network.labels))]
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def test_network_equals_plain_loops():
    rng = np.random.default_rng(8)
    network = small_network(rng)
    for text in ("short", "é ü ñ " * 20, "exactly".ljust(192, "x"), "two windows " * 30, "z" * 1000):
        raw = text.encode()
        parts = [raw[i:i + 192] for i in range(0, len(raw), 192)]
        rows = [loop_probabilities(network, part.ljust(192, b" ")) for part in parts]
        want = [sum(len(p) * r[c] for p, r in zip(parts, rows)) / len(raw) for c in range(3)]
        assert np.allclose(language_id._mean(network, raw), want, atol=1e-5)


def test_network_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(9)
    network = small_network(rng)
    for name in ("tables", "bias"):
        setattr(network, name, [p.astype(np.float64) for p in getattr(network, name)])
    network.out, network.out_bias = network.out.astype(np.float64), network.out_bias.astype(np.float64)
    x = rng.integers(97, 105, (12, 30)).astype(np.uint8)
    y, weight = rng.integers(0, 3, 12), rng.uniform(0.5, 2, 12)

    def loss():
        pooled, _ = network._pooled(x)
        p = network._softmax(np.maximum(pooled, 0) @ network.out + network.out_bias)
        return float(-(weight * np.log(p[np.arange(12), y])).mean())

    params, grads = network.parameters(), network.gradients(x, y, weight)
    for param, grad in zip(params, grads):
        spots = [tuple(rng.integers(0, n) for n in param.shape) for _ in range(20)]
        spots += [tuple(i) for i in np.argwhere(np.abs(grad) == np.abs(grad).max())[:2]]
        for spot in spots:
            kept, step = param[spot], 1e-6
            param[spot] = kept + step
            up = loss()
            param[spot] = kept - step
            down = loss()
            param[spot] = kept
            assert abs((up - down) / (2 * step) - grad[spot]) < 1e-5


def test_training_windows_are_distinct_and_spread(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id.ByteNetwork, "train", lambda self, x, y, weight: seen.append((x, y)))
    text = "".join(f"{i:05d}x" for i in range(32 * 9))  # nine windows of 192 bytes, all different
    rows = [(n, text[:192 * n - 5], lang) for n, lang in ((2, "two"), (3, "three"), (9, "nine"), (1, "one"))]
    rows = [next((i, t, lang) for i in range(1000 * n, 1000 * n + 99) if zlib.crc32(str(i).encode()) % 3 != 1) for n, t, lang in rows]
    network = language_id.train_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {lang: {bytes(w).decode().rstrip() for w, k in zip(*seen[0]) if network.labels[k] == lang} for lang in network.labels}
    for n, chosen in (("one", (0,)), ("two", (0, 1)), ("three", (0, 1, 2)), ("nine", (0, 2, 4, 6))):
        whole = next(t for _, t, lang in rows if lang == n)
        assert got[n] == {whole[192 * w:192 * (w + 1)] for w in chosen}
    assert len(seen[0][0]) == 1 + 2 + 3 + 4


def test_limits_come_from_all_held_out_rows(spark):
    """A few odd texts among thousands of held-out rows move the limits."""
    rng = random.Random(17)
    network = small_network(np.random.default_rng(12))
    network.seen[:] = True
    network.seen[ord("z") * 256:] = False
    held = [i for i in range(12_000) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, " ".join("".join(rng.choice("abc") for _ in range(5)) for _ in range(4)), "a") for i in held]
    n_odd = len(rows) // 600
    rows[:n_odd] = [(i, "x" + "z" * k, "a") for k, (i, _, _) in enumerate(rows[:n_odd], 20)]
    df = spark.createDataFrame(rows + [(-1, "zz", None), (held[-1], "123", "a"), (held[-1], None, "a")],
                               "doc_id long, text string, lang string").repartition(5)
    figures = [(float(language_id._mean(network, t.encode()).max()), language_id.coverage(network, t.encode())) for _, t, _ in rows]
    score, covered = np.quantile(figures, 0.001, axis=0)
    got = language_id.rejection_limits(df, network)
    assert len(rows) > 3900 and covered < 0.1
    assert np.allclose(got, (1 / 3 + (score - 1 / 3) / 2, covered / 2), rtol=1e-9, atol=0)
    one = spark.createDataFrame(rows[:1], df.schema)
    assert np.allclose(language_id.rejection_limits(one, network), (1 / 3 + (figures[0][0] - 1 / 3) / 2, figures[0][1] / 2))
    assert language_id.rejection_limits(df.filter("lang IS NULL"), network) == (0.0, 0.0)


def test_refinement_learns_from_every_window(spark):
    rng = random.Random(18)
    rows = [(i, "".join(rng.choice("abcd " if i % 2 else "vwxyé ") for _ in range(rng.choice((5, 100, 192, 1500)))) + "a",
             "aa" if i % 2 else "bb") for i in range(90)]
    late = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows += [(late, "ab" * 900 + "QZ" + "ab" * 900, "aa"), (None, "no id JK", "bb"), (late, None, "aa"), (late, "42", "aa")]
    held = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 == 1)
    df = spark.createDataFrame(rows + [(held, "MN", "aa"), (late, "OP", None)], "doc_id long, text string, lang string")
    start = language_id.train_language_model(df, rows_per_language=3)
    known = [(i, t, lang) for i, t, lang in rows if t and t != "42" and (i is None or zlib.crc32(str(i).encode()) % 3 != 1)]
    order = {(r.doc_id, r.text): r.k for r in df.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k")).collect()}
    known.sort(key=lambda r: order[r[0], r[1]])

    def want(groups, block):
        """Weights by learning from each group of rows, block by block, averaged."""
        counts = Counter()
        for _, t, lang in known:
            counts[lang] += len(language_id.windows_of(t.encode()))
        weight = np.array([sum(counts.values()) / (2 * counts[lang]) for lang in start.labels], np.float32)
        copies = []
        for group in groups:
            made, n, x, y = start_copy(), 0, [], []
            for at, (_, t, lang) in enumerate(group, 1):
                x.extend(language_id.windows_of(t.encode()))
                y.extend([start.labels.index(lang)] * (len(x) - len(y)))
                if len(x) >= block or at == len(group):
                    for k in range(0, len(x), block):
                        chosen = np.array(y[k:k + block])
                        made.train(np.array(x[k:k + block]), chosen, weight[chosen], epochs=1, rate=language_id.REFINE_RATE)
                    n, x, y = n + len(x), [], []
            copies.append((n, made))
        return [sum(n * p.astype(float) for n, p in zip([n for n, _ in copies], places)) / sum(counts.values())
                for places in zip(*(c.parameters() for _, c in copies))]

    def start_copy():
        made = language_id.ByteNetwork(start.labels)
        for p, q in zip(made.parameters(), start.parameters()):
            p[...] = q
        return made

    whole = language_id.refine_language_model(df, start)
    assert all(np.allclose(p, q, atol=1e-5) for p, q in zip(whole.parameters(), want([known], 10 ** 6)))
    assert any(not np.array_equal(p, q) for p, q in zip(whole.parameters(), start.parameters()))
    pairs = {lang: Counter() for lang in start.labels}
    for _, t, lang in known:
        pairs[lang].update(zip(t.encode(), t.encode()[1:]))
    assert {divmod(int(i), 256) for i in np.flatnonzero(whole.seen)} == {p for c in pairs.values() for p in c}
    assert whole.seen[ord("Q") * 256 + ord("Z")] and whole.seen[ord("J") * 256 + ord("K")]
    assert not whole.seen[ord("M") * 256 + ord("N")] and not whole.seen[ord("O") * 256 + ord("P")]

    n_windows = sum(len(language_id.windows_of(t.encode())) for _, t, _ in known)
    parts = language_id.refine_language_model(df, start, shard_windows=n_windows // 4)
    shards = -(-n_windows // (n_windows // 4))
    groups = [[r for r in known if order[r[0], r[1]] % shards == g] for g in range(shards)]
    assert sum(map(bool, groups)) > 2
    assert all(np.allclose(p, q, atol=1e-5) for p, q in zip(parts.parameters(), want([g for g in groups if g], n_windows // 4)))
    again = language_id.refine_language_model(df.repartition(7), start, shard_windows=n_windows // 4)
    assert all(np.array_equal(p, q) for p, q in zip(parts.parameters(), again.parameters()))
    assert np.array_equal(parts.seen, whole.seen) and np.array_equal(again.seen, whole.seen)
    assert language_id.refine_language_model(df, None) is None
    assert language_id.refine_language_model(df.filter("lang IS NULL"), start) is start


def test_pairs_rare_in_every_label_are_not_known(spark):
    at = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "ab" * 60_000, "aa") for i in at[:9]] + [(at[9], "abQZab", "aa")]
    rows += [(at[10], "cdJKcd", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refined = language_id.refine_language_model(df, language_id.train_language_model(df))
    assert not refined.seen[ord("Q") * 256 + ord("Z")] and refined.seen[ord("J") * 256 + ord("K")]
    assert refined.seen[ord("a") * 256 + ord("b")]


def test_too_many_labels_raise(spark):
    df = spark.range(3 * language_id.MAX_LABELS).selectExpr("id AS doc_id", "'text' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError, match="labels"):
        language_id.train_language_model(df)


# ---- quality rules

def measures(text):
    w = words(text)
    triples = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), failed)


def test_rule_measures_equal_brute_force(spark):
    rng = random.Random(9)
    docs = ODD + [(1, "a b c a b c d " * 9), (2, "l1\nl2\nl1\n\n \nl1 "), (3, "#x*$%&|<> é漢😀"), (4, sentence(rng, 80, 12)),
                  (5, "a a a a"), (6, "\n" + sentence(rng, 60)), (6, "twice")]
    rows = quality_rules.rule_measures(frame(spark, docs)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in rows)
    assert got == sorted((str(d), *measures(t)) for d, t in docs)


def test_hosts_with_many_failures_are_rejected(spark):
    rng = random.Random(10)
    docs = [(i, sentence(rng, 80, 10 ** 6), "en", "good") for i in range(60)]
    docs += [(100 + i, sentence(rng, 80 if i < 3 else 5, 10 ** 6), "en", "bad") for i in range(60)]
    docs += [(200, "too short", "en", "tiny"), (201, sentence(rng, 80, 10 ** 6), "en", None)]
    rows = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, docs)).collect()}
    assert all(rows[i].kept for i in range(60)) and not any(rows[100 + i].kept for i in range(60))
    assert rows[100].host_rejected and not rows[100].base_failed
    assert not rows[200].host_rejected  # one failure is not enough against the prior
    assert rows[201].kept


# ---- importance

def test_importance_prefers_the_target_and_takes_k(spark):
    rng = random.Random(12)
    docs = [(i, sentence(rng, 60, 100)) for i in range(100)]
    docs += [(i, " ".join(f"z{rng.randrange(100)}" for _ in range(60))) for i in range(100, 200)]
    docs += [(300, None), (301, " ")]
    target = spark.createDataFrame([(i,) for i in range(0, 50)], "doc_id long")
    rows = importance.importance_sample(frame(spark, docs), target, keep_share=0.4).collect()
    kept = {r.doc_id for r in rows if r.kept}
    assert len(rows) == 202 and len(kept) == 80 and max(kept) < 100
    keys = sorted((r.gumbel_key for r in rows if r.n_ngrams), reverse=True)
    assert min(r.gumbel_key for r in rows if r.kept) == keys[79]
    again = importance.importance_sample(frame(spark, docs).repartition(7), target, keep_share=0.4).collect()
    assert {r.doc_id for r in again if r.kept} == kept


def test_importance_ratios_equal_counting(spark):
    docs = [(1, "a b a"), (2, "b c"), (3, None)]
    rows = {r.doc_id: r for r in importance.importance_sample(
        frame(spark, docs), spark.createDataFrame([(1,)], "doc_id long"), buckets=64).collect()}
    grams = {d: importance.ngram_buckets((t or "").encode(), 64) for d, t in docs}
    raw = np.bincount(np.concatenate(list(grams.values())), minlength=64)
    target = np.bincount(grams[1], minlength=64)
    ratio = np.log((target + .5) / (target.sum() + 32)) - np.log((raw + .5) / (raw.sum() + 32))
    for d in (1, 2):
        assert math.isclose(rows[d].log_ratio, ratio[grams[d]].mean(), rel_tol=1e-9)
    assert rows[3].n_ngrams == 0 and not rows[3].kept


def test_kth_largest(spark):
    rng = random.Random(13)
    values = [rng.randrange(1 << 51) for _ in range(300)] + [5] * 20
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    for k in (1, 17, 300, 320):
        assert importance.kth_largest(keys, k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(keys, 321) is None


# ---- licences

FILES = [
    (1, "repo/LICENSE", "Released under the MIT License."), (2, "repo/src/a.py", "import os\nx = 1"),
    (3, "repo/src/vendor/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.\n"),
    (4, "repo/src/vendor/deep/er/b.c", "int main"), (5, "repo/src/c.py", "# Licensed under the Apache License, Version 2.0.\nx = 1"),
    (6, "other/a.py", "nothing"), (7, "other/b.html", "<p>intro words</p><b>Licensed under CC BY-NC 4.0.</b>"),
    (8, "other/c.py", "more"), (9, None, "text"), (10, "top", None), (11, "repo2/src/x", ""), (2, "repo/src/a.py", "again"),
]


def test_license_inheritance(spark):
    df = spark.createDataFrame(FILES, "id long, p string, t string").withColumn("path", F.lit("clash"))
    rows = license_scan.license_scan(df, "id", "p", "t").collect()
    assert len(rows) == len(FILES)
    got = {r.file_id: (r.own_license, r.is_license_file, r.inherited_from, r.license) for r in rows}
    assert got[1] == ("MIT", True, None, "MIT")
    assert got[2] == (None, False, "repo", "MIT")
    assert got[4] == (None, False, "repo/src/vendor", "GPL-3.0")
    assert got[5][0] == "Apache-2.0" and got[5][2] is None
    assert got[7] == ("CC-BY-NC-4.0", False, None, "CC-BY-NC-4.0") and got[8] == (None, False, None, None)
    assert got[9][3] is None and got[10][3] is None and got[11][3] is None


def test_license_titles_license_a_hot_directory(spark):
    page = "<title>%s</title><p>some words of page %d</p>"
    rows = [(i, "host/hot/%d" % i, page % ("A title", i)) for i in range(300)]
    rows += [(300, "host/index", page % ("Released under the MIT License", 300)),
             (301, "host/hot/deep/x", page % ("Licensed under CC BY 4.0", 301)), (302, "host/hot/deep/y", page % ("Other", 302)),
             (303, "elsewhere/z", page % ("Other", 303))]
    df = spark.createDataFrame(rows, "id long, p string, t string")
    for titles in (True, False):
        out = license_scan.license_scan(df, "id", "p", "t", titles=titles).collect()
        assert len(out) == len(rows)
        got = {r.file_id: (r.is_license_file, r.inherited_from, r.license) for r in out}
        assert all(got[i] == ((False, "host", "MIT") if titles else (False, None, None)) for i in range(300))
        assert got[300] == (titles, None, "MIT") and got[303] == (False, None, None)
        assert got[302] == ((False, "host/hot/deep", "CC-BY-4.0") if titles else (False, None, None))


def test_license_cosine_equals_dense_vectors():
    texts = ["Released under the MIT License", "the work is under way", "MIT License license foo"]
    counts = Counter(t for text in texts for t in set(license_scan.terms_of(text)) & license_scan.template_terms())
    index = license_scan.TemplateIndex(counts, 3)

    def vector(text):
        return {t: n * (math.log(4 / (1 + counts.get(t, 0) if t in license_scan.template_terms() else 1)) + 1)
                for t, n in Counter(license_scan.terms_of(text)).items()}

    def cosine(a, b):
        return sum(a[t] * b.get(t, 0) for t in a) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    for text in texts:
        best = max(cosine(vector(text), vector(t)) for _, t in license_scan.TEMPLATES)
        assert math.isclose(index.best(license_scan.terms_of(text))[0], best)
    assert index.best([]) == (0.0, None)


def test_license_notices_across_lines_and_inside_sentences(spark):
    code = "\n".join(f"value_{i} = compute(value_{i - 1}, offset={i})" for i in range(1, 201))
    lesser = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
              "General Public License as published by the Free Software Foundation; either version 3 of the License, or "
              "(at your option) any later version.")
    notices = [*license_scan.TEMPLATES, ("LGPL-3.0", lesser), ("GPL-3.0", lesser.replace("Lesser ", ""))]
    texts = []
    for name, notice in notices:
        for width in (30, 60):
            texts.append((name, "\n".join(f"# {line}" for line in textwrap.wrap(notice, width)) + f"\n{code}"))
        texts.append((name, f"{code}\nCopyright 2021 The Example Authors and others. {notice}, see the file at the top "
                            f"of the tree for its details, or ask whoever gave you this file.\n{code}"))
    texts.append((None, code))
    df = spark.createDataFrame([(i, f"d{i}/a.py", t) for i, (_, t) in enumerate(texts)], "id long, p string, t string")
    got = {r.file_id: (r.own_license, r.score) for r in license_scan.license_scan(df, "id", "p", "t").collect()}
    for i, (name, text) in enumerate(texts):
        assert got[i][0] == name, text[:400]
        assert name is None or got[i][1] >= (0.99 if i < 3 * len(license_scan.TEMPLATES) else 0.85)


def test_license_runs_equal_brute_force():
    rng = random.Random(8)
    vocabulary = sorted(license_scan.template_terms()) + [f"z{i}" for i in range(9)]
    index = license_scan.TemplateIndex({t: rng.randrange(900) for t in vocabulary[::2]}, 1000)
    for _ in range(120):
        terms = [rng.choice(vocabulary[:rng.choice([5, 30, 99])]) for _ in range(rng.randrange(1, 120))]
        terms[9:9] = [t for t in license_scan.terms_of(rng.choice(license_scan.TEMPLATES)[1]) if rng.random() < 0.9]
        parts = [t for t in (terms[:7], terms[7:20], terms[20:]) if t]
        units = max(index.best(t)[0] for t in [*parts, terms])
        runs = max((index.best(terms[i:i + n])[0] for n in index.lengths for i in range(len(terms) - n + 1)), default=0)
        want = max(units, runs) if runs >= license_scan.THRESHOLD else units
        assert math.isclose(index.notice(parts)[0], want, abs_tol=1e-8)


def test_sampling_odds_follow_ratio_and_temperature(spark):
    """The first draw takes a row with odds exp(ratio / T)."""
    ratios, t, draws = [0.0, 0.01, 0.02], 0.01, 3000
    rows = spark.createDataFrame([(i, 77, r) for i, r in enumerate(ratios)], "doc_id long, text_key long, log_ratio double")
    keys = [(F.col("log_ratio") + t * importance.gumbel(seed)).alias(f"k{seed}") for seed in range(draws)]
    drawn = np.array([list(r) for r in rows.orderBy("doc_id").select(*keys).collect()])
    share = np.bincount(drawn.argmax(axis=0), minlength=3) / draws
    odds = np.exp(np.array(ratios) / t)
    assert np.allclose(share, odds / odds.sum(), atol=0.03)


def test_temperature_moves_from_top_k_to_uniform(spark):
    rng = random.Random(20)
    good = [(i, "good fine " * rng.randrange(5, 30)) for i in range(100)]
    poor = [(100 + i, "poor weak " * rng.randrange(5, 30)) for i in range(100)]
    df, ids = frame(spark, good + poor), spark.range(20).withColumnRenamed("id", "doc_id")

    def good_share(t):
        kept = importance.importance_sample(df, ids, keep_share=0.5, temperature=t).filter("kept").collect()
        assert len(kept) == 100
        return sum(r.doc_id < 100 for r in kept) / 100
    assert good_share(1e-6) == 1.0 and 0.35 < good_share(1000.0) < 0.65


def test_licenses_of_long_texts_and_deep_paths(spark):
    import time
    deep = "/".join(f"d{i % 7}" for i in range(100_000))
    rows = [(1, "a/LICENSE", "Licensed under the MIT License"), (2, "a/b/c/x.py", "code"), (3, "z/" + deep + "/x.py", "code"),
            (4, f"a/{deep}/x.py", "code"), (5, f"q/{deep}/LICENSE", "Licensed under CC BY 4.0"), (6, f"q/{deep}/e/f.py", None),
            (7, "q/f.py", ""), (8, "m/x", "<" * 1_000_000), (9, "m/y", "<b" * 500_000 + "\nLicensed under CC BY 4.0\n")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, path string, body string, folder string")
    start = time.time()
    got = {r.file_id: r for r in license_scan.license_scan(df, "page_id", "path", "body").collect()}
    assert time.time() - start < 60
    assert [got[i].license for i in range(1, 10)] == ["MIT", "MIT", None, "MIT", "CC-BY-4.0", "CC-BY-4.0", None, None, "CC-BY-4.0"]
    assert got[4].inherited_from == "a" and got[6].inherited_from == f"q/{deep}"


def test_licenses_of_malformed_text(spark):
    df = spark.sql("SELECT 1L AS id, 'f' AS path, cast(concat(X'FF0A', cast('Licensed under CC BY 4.0' AS binary)) AS string) AS body")
    assert license_scan.license_scan(df, "id", "path", "body").first().license == "CC-BY-4.0"


# ---- WARC

PAGES = [(5, "http://a/5", "p" * 200), (3, "http://a/3", "p" * 200), (9, "http://a/9", "p" * 200), (1, "http://a/1", "short"),
         (2, "http://a/2", "short"), (7, None, None), (8, "http://x/\r\nInjected: 1", "é" * 80), (None, "http://n", "p" * 200),
         (9, "http://a/9", "p" * 200), (10, "http://b", "q\r\n\r\nWARC/1.1\r\n" * 30), (6, "", "")]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(0))


def test_warc_round_trip(spark, tmp_path):
    root = f"file://{tmp_path}/a"
    manifest = warc.write_archives(pages(spark), root, shard_bytes=400, roll_bytes=300)
    rows = warc.read_archives(manifest, root, payloads=True).collect()
    assert len(rows) == len(PAGES) and all(r.intact for r in rows)
    assert sum(m.records for m in manifest.collect()) == len(PAGES) and manifest.count() > 2
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in rows)
    assert kinds[(3, "response", None)] == 1 and kinds[(5, "revisit", 3)] == 1
    assert kinds[(9, "revisit", 3)] == 2 and kinds[(None, "revisit", 3)] == 1
    assert kinds[(1, "response", None)] == kinds[(2, "response", None)] == 1
    html = {(p, hashlib.sha256((h or "").encode()).hexdigest()): h or "" for p, _, h in PAGES}
    for r in rows:
        assert r.payload_bytes == len(html[(r.page_id, r.payload_digest)].encode())
        if r.record_type == "response":
            assert bytes(r.payload).decode() == html[(r.page_id, r.payload_digest)]


def test_warc_files_are_the_same_in_every_run(spark, tmp_path):
    found = []
    for name, df in (("a", pages(spark)), ("b", pages(spark).repartition(5))):
        manifest = warc.write_archives(df, f"file://{tmp_path}/{name}", shard_bytes=400, roll_bytes=300)
        found.append(sorted((m.name, m.sha256, m.records) for m in manifest.collect()))
        assert {p.name for p in (tmp_path / name).glob("*.warc.gz")} == {m.name for m in manifest.collect()}
        warc._commit(manifest, f"file://{tmp_path}/{name}")  # again, as after a lost executor
    assert found[0] == found[1]


def test_warc_shards_follow_the_ids_at_any_range(spark):
    ids = [-2 ** 63, -7, -1, 0, 1, 2 ** 53, 2 ** 53 + 1, 2 ** 63 - 1]
    for part in (ids, [4, 5, 6, 7], [-2 ** 63, -2 ** 63 + 1]):
        df = spark.createDataFrame([(i, 10) for i in part] + [(None, 10)], "page_id long, payload_bytes long")
        shard, n = warc._sharded(df, 10)
        rows = df.select("page_id", shard.alias("shard")).collect()
        known = [r.shard for r in sorted((r for r in rows if r.page_id is not None), key=lambda r: r.page_id)]
        assert known == sorted(known) and set(known) == set(range(n)) and n > 1
        assert [r.shard for r in rows if r.page_id is None] == [0]


def test_warc_spreads_hot_and_missing_ids(spark, tmp_path):
    rows = [(None, f"http://n/{i}", f"page {i} " * 60) for i in range(40)] + [(7, f"http://s/{i}", f"other {i} " * 60) for i in range(40)]
    rows += [(7, "http://s/0", "other 0 " * 60), (None, "http://n/0", "page 0 " * 60), (8, "http://z", "small")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for name, parts in (("a", 1), ("b", 4)):
        manifest = warc.write_archives(df.repartition(parts), f"file://{tmp_path}/{name}", shard_bytes=2000)
        found.append(sorted((m.name, m.sha256, m.records) for m in manifest.collect()))
    assert found[0] == found[1]
    shards = Counter({m.shard: m.records for m in manifest.collect()})
    assert len(shards) > 8 and max(shards.values()) < 24
    read = warc.read_archives(manifest, f"file://{tmp_path}/b", payloads=True).collect()
    assert all(r.intact for r in read)
    kinds = Counter((r.page_id, r.record_type) for r in read)
    assert kinds == {(None, "response"): 40, (None, "revisit"): 1, (7, "response"): 40, (7, "revisit"): 1, (8, "response"): 1} \
        or kinds == {(None, "response"): 41, (7, "response"): 40, (7, "revisit"): 1, (8, "response"): 1}


def test_warc_paths_of_hadoop_schemes():
    cases = {"s3a://b/k": "s3://b/k", "s3n://b/k": "s3://b/k", "s3://b/k": "s3://b/k", "/local/x": "/local/x", "rel/x": "rel/x",
             "file:/x": "file:/x", "file:///x": "file:///x", "gs://b/k": "gs://b/k", "hdfs://n:1/x": "hdfs://n:1/x",
             "wasbs://c@a.host/x": "abfss://c@a.host/x", "abfss://c@a.host/x": "abfss://c@a.host/x"}
    for path, want in cases.items():
        assert warc.archive_uri(path) == want
    with pytest.raises(ValueError, match="cannot be written to oss"):
        warc.archive_uri("oss://b/k")


def test_warc_long_payloads(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "x\r\n" * 2_000_000), (2, "http://b", "x\r\n" * 2_000_000)],
                               "page_id long, url string, html string")
    got = sorted(warc.archive_round_trip(spark, df).collect())
    assert [(r.page_id, r.record_type, r.payload_bytes, r.intact) for r in got] == [
        (1, "response", 6_000_000, True), (2, "revisit", 6_000_000, True)]


def test_warc_members_are_plain_gzip_records(spark, tmp_path):
    manifest = warc.write_archives(pages(spark), f"file://{tmp_path}/a")
    data = b"".join(gzip.open(tmp_path / "a" / m.name).read() for m in manifest.collect())
    assert data.count(b"WARC-Type: ") == len(PAGES)
    uri = [line for line in data.split(b"\r\n") if line.startswith(b"WARC-Target-URI: http://x/")]
    assert uri == [b"WARC-Target-URI: http://x/ Injected: 1"]  # no header of its own


# ---- all

def test_operators_take_empty_tables(spark):
    docs = frame(spark, []).withColumn("n_chars", F.lit(0).cast("long"))
    bench = spark.createDataFrame([], "item_id long, text string")
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.drop_near_duplicates(docs).count() == 0
    assert substring_dedup.repeated_passages(docs).count() == 0
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert decontaminate.contamination(docs, bench).count() == 0
    assert token_counts.prefix_token_counts(docs).count() == 0
    assert pieces.encode_pieces(docs).count() == 0
    assert language_id.train_language_model(docs) is None
    assert language_id.identify_language(docs, None).count() == 0
    assert quality_rules.quality_rules(docs).count() == 0
    assert importance.importance_sample(docs, bench.select(F.col("item_id").alias("doc_id"))).count() == 0
    assert license_scan.license_scan(docs, "doc_id", "source", "text").count() == 0
    assert warc.archive_round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
