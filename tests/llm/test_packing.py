import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from marketlens.llm import packing  # noqa: E402

PATH = P.path("word_bpe_49k.json")
ODD = ["", " ", "\n\t", "don't we'll IT'S", "ÀÉÎ naïve STRASSE ß", "İstanbul Σίσυφος ΟΔΟΣ", "日本語 한국어 🙂👍🏽", "x\x1cy\x1f z\x01q",
       "3.14 １２ ½ ²³", "<|endoftext|> <|startoftext|>x", "é ä ﬁ", "a" * 3000, "  b　c\x85d", "_-_ %%% $$",
       "ŉ ſ Ǆ ǅ", "ᾼ ῼ", "\x7f\x00 ​zero"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_words_encode_as_the_tokenizer_encodes_texts(tokenizer):
    tokenizer.encode_special_tokens = True
    words = packing.WordIds.of(PATH)
    for text in ODD:
        assert _ids(words.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs", "Cn", "Co"), max_codepoint=0x2FF) | st.sampled_from(" \n'.s1"), max_size=50))
def test_any_text_encodes_as_the_tokenizer_does(text):
    tok = packing.WordIds.of(PATH).tokenizer
    assert _ids(packing.WordIds.of(PATH).encode(text)) == tok.encode(text, add_special_tokens=False).ids


def _best(counts, first, capacity):
    sums = {first}
    for x, n in counts.items():
        for _ in range(n - (x == first)):
            sums |= {s + x for s in sums if s + x <= capacity}
    return max(sums)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 5), min_size=1, max_size=6))
def test_windows_are_filled_as_brute_force_fills_them(counts):
    first = max(counts)
    fill, uses = packing.fullest(counts, first, 64)
    assert fill == sum(x * k for x, k in uses.items()) == _best(counts, first, 64)
    assert all(k <= counts[x] for x, k in uses.items())


def _check(rows, docs, tokenizer, capacity):
    """Pieces are the documents, each id once; sequences are gapless and need no padding."""
    seqs, parts = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        parts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    want = []
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, ids))
    total = sum(len(ids) for _, ids in want)
    assert sum(r.length for r in rows) == total
    by_doc = {}
    for doc, ids in want:
        by_doc.setdefault((doc, len(ids)), []).append(ids)
    assert set(by_doc) == set(parts)
    for key, copies in by_doc.items():
        got = sorted(parts[key])
        covered = np.zeros(key[1], int)
        for start, length, crc in got:
            covered[start:start + length] += 1
            assert crc in {zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) for ids in copies}
        assert (covered == len(copies)).all()


def test_corpus_with_hot_lengths_nulls_and_repeats(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(1000 + i, "three hot words " * 30) for i in range(120)]            # one length for many
    docs += [(2000, None), (2001, ""), (2002, "long " * 20_000), (2003, "a"), (2003, "a"), (None, "no id")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, cls int, start string")
    _check(packing.pack(df.repartition(5), PATH).collect(), docs, tokenizer, 4096)


def test_one_length_only_and_empty_table(spark, tokenizer):
    docs = [(i, "word " * 47) for i in range(25)]                                # 48 ids each, no multiset fills 64
    df = spark.createDataFrame(docs, "doc_id long, text string")
    _check(packing.pack(df, PATH, capacity=64).collect(), docs, tokenizer, 64)
    assert packing.pack(df.limit(0), PATH).count() == 0
