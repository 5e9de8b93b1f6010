import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import token_file as tf
from folio.llm import word_bpe
from folio.llm.shared import new_path
from tests.llm.helpers import DOCS, odd_docs, rows

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(word_bpe.default_path())


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=3000), st.integers(0, 5))
def test_block_round_trip(ids, seed):
    ids = np.array(ids, np.uint32)
    counts = np.bincount(ids)
    coder = tf.Coder(tf.frequencies(counts))
    cut = len(ids) // 3
    docs = [(None, cut, 6), (seed, len(ids) - cut, 6)]
    (block,) = tf.write_blocks(coder, [(ids, docs)])
    ((got_docs, got),) = tf.read_blocks(coder, [block])
    assert got_docs == docs and np.array_equal(got, ids)


def test_several_segments_and_damage():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 3 * tf.SEGMENT + 777).clip(0, 50_000).astype(np.uint32)
    coder = tf.Coder(tf.frequencies(np.bincount(ids)))
    (block,) = tf.write_blocks(coder, [(ids, [(5, len(ids), 6)])])
    assert np.array_equal(tf.read_blocks(coder, [block, block])[1][1], ids)
    bad = bytearray(block)
    bad[-3] ^= 1
    with pytest.raises(ValueError):
        tf.read_blocks(coder, [bytes(bad)])


def test_encoder_hands_over_whole_texts(monkeypatch):
    encoder, asked = tf.Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    library = encoder.library

    class Watched:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            assert how == {"add_special_tokens": False}
            return library.encode_batch_fast(texts, **how)

    monkeypatch.setattr(encoder, "library", Watched())
    texts = ["one two\n three", "", "one two\n three", "x" * 5_000 + " y"]
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder(texts)]
    assert asked == texts and got == [BYTES.encode(t, add_special_tokens=False).ids for t in texts]


def test_frequencies_keep_rare_ids():
    f = tf.frequencies(np.array([10**9, 1, 0, 1]))
    assert f.sum() == 1 << tf.PRECISION and f[1] == f[3] == 1 and f[2] == 0


def test_crc_combine():
    a, b = b"some bytes", b"and others" * 50
    assert tf.crc_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_file(spark, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK", 2 * tf.SEGMENT)
    docs = odd_docs() + [(40, "word " * 90_000, "en", "s", 0, "", "", 0.0), (None, "none " * 90_000, "en", "s", 0, "", "", 0.0), (-(1 << 63), "least", "en", "s", 0, "", "", 0.0)]
    out = new_path(spark, "test")
    tf.write(spark.createDataFrame(docs, DOCS), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    pieces = tf.read(spark, out)
    assert pieces.filter("flags <> 6").count() > 1
    got = sorted(map(tuple, tf.summary(pieces).collect()), key=lambda r: r[1])
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, text, *_ in docs:
        x = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(i, []).append((len(x), zlib.crc32(x.tobytes())))
    assert len(got) == len(docs) and [r[0] for r in got] == sorted((d[0] for d in docs), key=lambda i: (i is not None, i or 0))
    at = 0
    for i, start, n, crc in got:
        assert start == at and (n, crc) in want[i]
        at += n
    whole = {r.doc_id: r.ids for r in tf.read(spark, out, with_ids=True).filter("flags = 6").collect()}
    assert t.decode(whole[9][:-1]) == "one two"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n<|endoftext>\x00's")), max_size=60), max_size=5))
def test_encoder_is_the_library(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = [np.frombuffer(x, tf.encoder_for(path).kind).tolist() for x in tf.encoder_for(path)(texts)]
    assert got == [BYTES.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty_token_file(spark):
    out = new_path(spark, "test")
    tf.write(spark.createDataFrame([], DOCS), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert tf.summary(tf.read(spark, out)).count() == 0


def test_word_bpe_is_the_library(spark):
    t = Tokenizer.from_file(word_bpe.default_path())
    docs = odd_docs() + [(50, "it's we'll 123 ４５ ﬁ e\u0301 Ⅷ 你好，世界 a\x85b\u2028c \x1f " + "x" * 300 + " 'S 'T", "en", "s", 0, "", "", 0.0)]
    got = rows(word_bpe.digests(spark.createDataFrame(docs, DOCS), word_bpe.default_path()))
    want = []
    for i, text, *_ in docs:
        e = t.encode(text or "", add_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(e.ids), sha(" ".join(map(str, e.ids))), sha(t.decode(e.ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)
    assert word_bpe.digests(spark.createDataFrame([], DOCS), word_bpe.default_path()).count() == 0


@settings(max_examples=5000, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aA'sSzé1²\u0301\x1c\x85 <|Σ\u2028—")), max_size=40))
def test_word_bpe_any_text(text):
    t, bpe = LIBRARY, word_bpe.tokenizer(word_bpe.default_path())
    ids, decoded = bpe.encode(text)
    want = t.encode(text, add_special_tokens=False).ids
    assert ids == " ".join(map(str, want)) and decoded == t.decode(want, skip_special_tokens=False) == bpe.decode(want)


def test_word_bpe_every_character():
    bpe = word_bpe.tokenizer(word_bpe.default_path())
    texts = [x for c in range(0x110000) if not 0xD800 <= c < 0xE000 for x in (f"a{chr(c)}A", f"1{chr(c)}x", f"!{chr(c)}!")]
    for i in range(0, len(texts), 50_000):
        some = texts[i : i + 50_000]
        for x, (ids, _), e in zip(some, bpe.encode_all(some), LIBRARY.encode_batch(some, add_special_tokens=False), strict=True):
            assert ids == " ".join(map(str, e.ids)), x


def test_scan_and_heap_agree():
    bpe = word_bpe.tokenizer(word_bpe.default_path())
    for w in ("internationalization", "antidisestablishment", "zzzzaaaabbbb", "the", "a"):
        assert bpe._scan([w, w]) == 2 * bpe._heap(w)
    long = ["ab" * 400, "the" * 17]
    want = LIBRARY.encode_batch(long, add_special_tokens=False)
    assert [x.split() for x, _ in bpe.merge(long)] == [list(map(str, e.ids)) for e in want]


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(word_bpe, "STRETCH", 50)
    bpe = word_bpe.tokenizer(word_bpe.default_path())
    texts = ["", "word " * 200, "x" * 500 + " y", "a <|endoftext|>" * 30 + "\u2003\x1cz", "short"]
    for t, (ids, parts) in zip(texts, word_bpe._encoded(bpe, texts), strict=True):
        want = LIBRARY.encode(t, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and " ".join(parts) == LIBRARY.decode(want, skip_special_tokens=False)


def test_word_bpe_keeps_columns(spark):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    out = word_bpe.encode(docs, word_bpe.default_path(), ["doc_id", "score", "set_key"])
    assert out.columns == ["doc_id", "score", "set_key", "n_tokens", "ids", "decoded_sha256"] and out.count() == docs.count()
    with pytest.raises(ValueError):
        word_bpe.encode(docs.withColumnRenamed("score", "ids"), word_bpe.default_path(), ["ids"])
