import os

import pytest

from millrace.llm.tokens import DEFAULT_VOCABULARY, LONGEST_PIECE, Encoder, decode_ids, encode_texts, token_counts

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary file")

TEXTS = [
    "Hello world, it's 2024!", "", None, "   \n\n  x", "<|endoftext|> is text", "a" * 3000, "東京タワーへ行った。昨日は123円", "é ﬁ Ⅳ １２", "👩‍👩‍👧 ok",
    "\x00\x85᠎​　 ", "don't can't we'll", "ab " * 500, "ーン" * 40, "abc\r\ndef",
]


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch([x or "" for x in TEXTS], add_special_tokens=False)]


def test_equals_the_library():
    ids, counts = Encoder().encode(TEXTS)
    at, out = 0, []
    for n in counts:
        out.append(ids[at : at + n].tolist())
        at += n
    assert out == library()


def test_heap_and_recursive_query_agree():
    e = Encoder()
    for piece in (b"ab" * 450, "長い語の続き".encode() * 50, b"x" * LONGEST_PIECE, b"ababababab", "ーンーン".encode(), b" the quick", b"aaaaaaaaaaaaa"):
        e.known.clear()
        e._learn([piece])
        assert e.known[piece].tolist() == e._by_heap(piece)


def test_operator_keeps_rows_and_clashing_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "again")]
    nameless = spark.createDataFrame([(None, "x", "")], "doc_id bigint, text string, ids string")
    assert len(encode_texts(nameless).first().ids) == 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = encode_texts(df).collect()
    assert len(got) == len(rows)
    want = library()
    assert all(r.ids == want[r.doc_id] for r in got)
    counts = token_counts(df, "text", ["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in counts) == sorted((i, len(want[i])) for i, _, _ in rows)
    assert encode_texts(df.limit(0)).collect() == []


def test_decoding_is_the_round_trip(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, "\ud7ff\ue000\U0010ffff"])], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.text for r in decode_ids(encode_texts(df)).collect()}
    assert all(got[r.doc_id] == (r.text or "") for r in df.collect())
    odd = spark.createDataFrame([(1, None), (2, []), (None, [])], "doc_id bigint, ids array<int>")
    assert [r.text for r in decode_ids(odd).collect()] == [""] * 3 and decode_ids(odd.limit(0)).count() == 0
    cut = Encoder().encode(["👩"])[0][:1]
    assert "\ufffd" in Encoder().decode(cut, [1])[0].decode("utf-8", "replace")
    with pytest.raises(ValueError):
        Encoder().decode(Encoder().encode(["a"])[0] + 10**7, [1])
