import os
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import bpe, queries, token_io
from textloom.llm.common import VOCAB, Encoder, counter, pieces, tiktoken_encoding, whole_tokens
from textloom.llm.token_counts import token_counts
from textloom.storage import mounted, work_path

ENC = tiktoken_encoding(VOCAB)
ODD = ["", " ", "\n\n  x", "it's we'll I'd 'sx", "a_b __ _", "½ ²x 3x x3", "naïve x  y", "日本語 text", "\x1c a\x1fb", "é", "👍🏽 ok", "a\t \n b  ", "x" * 9000, " ".join(["word"] * 4000)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sdmtlve _½7é¼"), st.characters(codec="utf-8")), max_size=60))
def test_encoder_equals_tiktoken(t):
    e = Encoder()
    assert e.ids(t).tolist() == ENC.encode_ordinary(t)
    assert counter(VOCAB, whole_tokens(VOCAB)).count(t) == len(ENC.encode_ordinary(t))
    assert e.decode(e.raw(t)) == t


def test_every_character_is_cut_as_the_encoder_cuts_it():
    """Each code point of the first planes, among letters, digits, signs and spaces; unassigned ones too."""
    c = counter(VOCAB, whole_tokens(VOCAB))
    for lo in range(0, 0x20000, 64):
        t = "".join(f"a{x}1{x}!{x}'s {x}b {x} " for x in map(chr, range(lo, lo + 64)) if not 0xD800 <= ord(x) < 0xE000)
        assert c.count(t) == len(ENC.encode_ordinary(t)), hex(lo)


def test_shortcut_holds_in_texts_of_every_script():
    class Counted(type(counter(VOCAB, frozenset()))):
        def __missing__(self, piece):
            merged.append(piece)
            return super().__missing__(piece)

    merged = []
    text = "the quick brown fox says hello " * 200
    for odd in ("👍", "Привет", "日本", "\U000323b0"):  # the last is unknown to some versions of Unicode
        c = Counted(VOCAB, whole_tokens(VOCAB))
        assert c.count(text + odd + " " + text) == len(ENC.encode_ordinary(text + odd + " " + text))
    assert len(merged) <= 4 and all(len(m) < 12 for m in merged) and pieces("日本 x")[0] == "日本"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n'stab1,é  "), max_size=25), min_size=1, max_size=6))
def test_joins_are_repaired(parts):
    e = Encoder()
    for known in (lambda i: True, lambda i: i % 2, lambda i: i % 3 == 0):
        spans = [(p, e.raw(p) if known(i) else None) for i, p in enumerate(parts) if p] or [("", b"")]
        assert np.frombuffer(bpe.join_spans(e, spans), "<u4").tolist() == ENC.encode_ordinary("".join(parts))


def test_joins_of_long_texts_without_spaces_are_linear():
    """Chunks all known, a megabyte each: letters only, letters and signs, base64; about the time of encoding them whole."""
    r = random.Random(3)
    kinds = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(350_000)), "".join(chr(r.randrange(0x4E00, 0x9FA5)) + "，" * (i % 9 == 0) for i in range(300_000)), "".join(r.choice("ABCDEFabcdef0123456789+/") for _ in range(1_000_000))]
    for text in kinds:
        e = Encoder(most=1000)
        known, at = [], 0
        for c in bpe.chunks(text):
            known.append((at, len(c), e.raw(c.decode())))
            at += len(c)
        t = time.process_time()
        whole = e.raw(text)
        whole_s, t = time.process_time() - t, time.process_time()
        assert bpe.encode_with(e, text.encode(), known) == whole
        assert time.process_time() - t < 3 * whole_s + 2


def test_copies_are_encoded_once(spark, tmp_path, monkeypatch):
    """Calls of the encoder are counted over all workers: a text's copies, in one partition or several, cost its chunks once and small joins."""
    r = random.Random(7)
    text = " ".join("".join(r.choice("abcdefgh") for _ in range(7)) for _ in range(6000))

    class Noted(Encoder):
        def raw(self, t):
            with open(f"{tmp_path}/{os.getpid()}", "a") as f:
                f.write(f"{len(t)}\n")
            return super().raw(t)

    monkeypatch.setattr(bpe, "encoder", lambda path: Noted(path))
    for hot in (1000, 3):
        rows = [(i, text) for i in range(24)] + [(100 + i, f"own text {i}") for i in range(8)]
        got = bpe.bpe_encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), hot_share=1e-9, hot_least=hot).collect()
        assert {x.doc_id: list(x.token_ids) for x in got} == {i: ENC.encode_ordinary(t) for i, t in rows}
    done = sum(int(x) for p in tmp_path.iterdir() for x in p.read_text().split())
    assert len(text) < done < 2 * 3 * len(text)  # two runs; 24 copies each


def test_chunks_follow_content(docs):
    t = max((r.text for r in docs.collect()), key=len)
    a, b = set(bpe.chunks(t)), set(bpe.chunks("Quite another start. " + t))
    assert b"".join(bpe.chunks(t)).decode() == t and len(a & b) > 0.8 * len(a)
    assert all(len(c) <= bpe.MOST + 4 for c in a)


def test_bpe_query_against_whole_text_encoding(spark, docs):
    got = queries.op1_bpe(spark, "/root/testdata/sf0.001").collect()
    want = {r.doc_id: ENC.encode_ordinary(r.text) for r in docs.collect()}
    assert {r.doc_id: list(r.token_ids) for r in got} == want and all(r.round_trip for r in got) and len(got) == len(want)


def test_bpe_odd_rows(spark):
    r = random.Random(1)
    shared = " ".join(r.choice(["alpha", "beta,", "gamma's", "½", "日本"]) for _ in range(900))
    rows = [(i, t, "x", 1, b"z") for i, t in enumerate([*ODD, None, shared, "intro " + shared, shared, shared + "tail", None])] + [(None, shared, None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, k string, ck int, known binary")
    got = bpe.bpe_encode(df, out="token_ids").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "", r.k, r.ck, r.known) for r in got if r.doc_id is not None) == sorted((d is None, d or 0, t is None, t or "", k, c, n) for d, t, k, c, n in rows if d is not None)
    assert len(got) == len(rows)
    for r in got:
        assert (r.token_ids is None) if r.text is None else list(r.token_ids) == ENC.encode_ordinary(r.text)
    back = bpe.bpe_decode(bpe.bpe_encode(df, out="k"), ids="k").collect()
    assert all(r.decoded == r.text for r in back)
    assert bpe.bpe_encode(df.limit(0)).count() == 0
    low = bpe.bpe_encode(df.withColumnRenamed("k", "Token_IDs"))
    assert low.columns == ["doc_id", "text", "ck", "known", "token_ids"] and low.count() == len(rows)
    hot = bpe.bpe_encode(df, hot_share=1e-9, hot_least=1).collect()
    assert all((r.token_ids is None) if r.text is None else list(r.token_ids) == ENC.encode_ordinary(r.text) for r in hot) and len(hot) == len(rows)


def test_counts(spark, docs):
    for s in random.Random(2).sample(sorted(whole_tokens(VOCAB)), 200):
        assert len(ENC.encode_ordinary(s)) == 1
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate([*ODD, None, ODD[3]])], "doc_id long, text string, n_tokens int")
    got = token_counts(df).collect()
    assert [r.n_tokens for r in sorted(got, key=lambda r: r.doc_id)] == [None if t is None else len(ENC.encode_ordinary(t)) for t in [*ODD, None, ODD[3]]]
    assert token_counts(df.limit(0)).count() == 0
    q = {r.doc_id: r.n_tokens for r in queries.op9_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert q == {r.doc_id: len(ENC.encode_ordinary(r.text)) for r in docs.collect()}


def test_token_files(spark, docs, tmp_path):
    rows = [(i, t, 1) for i, t in enumerate([*ODD, None, ODD[3], ODD[3]])] + [(None, "null id", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file int").repartition(3)
    path = "file://" + str(tmp_path / "a")
    index = token_io.write_tokens(df, path)
    assert index.count() == len(rows)
    back = {r.doc_id: r for r in token_io.read_tokens(spark, path, index).collect()}
    for d, t, _ in rows:
        if t is None:
            assert back[d].frame is None and back[d].token_ids is None
        else:
            assert list(back[d].token_ids) == ENC.encode_ordinary(t) and back[d].n_tokens == len(back[d].token_ids)
    assert token_io.write_tokens(df.limit(0), "file://" + str(tmp_path / "b")).count() == 0
    one = index.where("doc_id = 3")
    assert token_io.read_tokens(spark, path, one).count() == 1


def test_token_file_layout_and_checksums(tmp_path):
    import zstandard

    p = str(tmp_path / "x.tokz")
    w = token_io.FrameWriter(p)
    for raw in (b"abcd" * 10, b"", b"wxyz" * 5000):
        w.add(raw)
    w.close()
    r = token_io.FrameReader(p)
    assert [r.frame(k) for k in (2, 1, 0)] == [b"wxyz" * 5000, b"", b"abcd" * 10]
    with pytest.raises(IndexError):
        r.frame(3)
    whole = zstandard.ZstdDecompressor().stream_reader(open(p, "rb"), read_across_frames=True).read()
    assert whole == b"abcd" * 10 + b"wxyz" * 5000
    data = bytearray(open(p, "rb").read())
    data[8] ^= 1
    open(p, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_io.FrameReader(p).frame(0)


def test_token_output_query(spark, docs):
    got = queries.op8_token_output(spark, "/root/testdata/sf0.001").collect()
    want = {r.doc_id: len(ENC.encode_ordinary(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert mounted(work_path(spark, "x")).startswith("/")
