import hashlib

import pytest

P = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from marketlens.llm import byte_bpe  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")
REF = tiktoken.Encoding("ref", pat_str=P.PATTERN, special_tokens={},
                        mergeable_ranks={e: i for i, e in enumerate(byte_bpe.read_ranks(PATH))})
ODD = ["", " ", "  ", "\n", " \n", "\n ", "a  b", "a \n b", "  a", "a  ", "it's we'll I'M", "\x1c a\x1f\x1eb", "\u3000x\u2028 y",
       "naïve Straße 日本語 한국어 🙂👍🏽", "1234567 3.14 x2", "\u00a0\u0085z", "<|endoftext|> <s>", "\x00\x01 \x7f", "ﬁ ½ ²",
       "a" * 30_000, "\t\tif x:\r\n\r\n  y\n", "ab " * 5_000]


def test_odd_texts_as_tiktoken():
    codec = byte_bpe.Codec.of(PATH, P.PATTERN)
    for text in ODD:
        ids = codec.encode(text)
        assert ids.tolist() == REF.encode_ordinary(text), repr(text[:40])
        assert codec.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs", "Cn", "Co"), max_codepoint=0x24F) | st.sampled_from(" \n\t'.x1é"), max_size=60))
def test_any_text_as_tiktoken(text):
    codec = byte_bpe.Codec.of(PATH, P.PATTERN)
    ids = codec.encode(text)
    assert ids.tolist() == REF.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_whole_table_with_nulls_and_repeats(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(1, None), (None, "null id"), (7, ""), (7, "")] + list(enumerate(ODD, 5000))
    got = byte_bpe.report(spark.createDataFrame(rows, "doc_id long, text string"), PATH, P.PATTERN).collect()
    def want(doc, text):
        ids = REF.encode_ordinary(text or "")
        sha = hashlib.sha256
        return (doc or -1, len(ids), sha(" ".join(map(str, ids)).encode()).hexdigest(), sha((text or "").encode()).hexdigest())
    assert sorted((r.doc_id or -1, *r[1:]) for r in got) == sorted(want(*r) for r in rows)


def test_keeps_columns_whatever_their_names(spark):
    df = spark.createDataFrame([("a b", 1, 2)], "text string, coded_text int, `x.y` int")
    out = byte_bpe.encode_decode(df, "text", PATH, P.PATTERN, "i", "d")
    assert out.columns == ["text", "coded_text", "x.y", "i", "d"]
    assert out.first()["i"] == REF.encode_ordinary("a b")
    assert byte_bpe.encode_decode(df.limit(0), "text", PATH, P.PATTERN).count() == 0
