"""Characters are split as the tokenizers' own libraries split them, those new or unassigned included."""

import pytest

P = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from marketlens.llm import letters  # noqa: E402
from marketlens.llm.byte_bpe import Codec, read_ranks  # noqa: E402
from marketlens.llm.packing import WordIds  # noqa: E402

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
REF = tiktoken.Encoding("ref", pat_str=P.PATTERN, special_tokens={},
                        mergeable_ranks={e: i for i, e in enumerate(read_ranks(RANKS))})
UNLIKE = sorted(letters.stand_ins(letters.by_tiktoken).keys() | letters.stand_ins(letters.by_tokenizers).keys())


def _texts(step=500):
    """All characters that are classed otherwise, and every 16th of the rest, between other classes."""
    every = "".join(map(chr, UNLIKE)) + letters.all_characters()[::16]
    for a in range(0, len(every), step):
        yield " ".join(f"x{c}7{c}'s.{c}" for c in every[a:a + step])


def test_characters_as_tiktoken():
    codec = Codec.of(RANKS, P.PATTERN)
    bad = [t[:30] for t in _texts() if codec.encode(t).tolist() != REF.encode_ordinary(t)]
    assert not bad


def test_characters_as_the_word_tokenizer():
    words = WordIds(WORDS)
    bad = [t[:30] for t in _texts() if words.encode(t) != words._plain(t)]
    assert not bad


ANY = st.text(st.characters(blacklist_categories=("Cs",)) | st.sampled_from(" \n\t'.x1é")
              | st.sampled_from([chr(c) for c in UNLIKE] or ["a"]), max_size=40)


@settings(max_examples=300, deadline=None)
@given(ANY)
def test_any_text_of_any_class(text):
    codec, words = Codec.of(RANKS, P.PATTERN), WordIds.of(WORDS)
    ids = codec.encode(text)
    assert ids.tolist() == REF.encode_ordinary(text) and codec.decode(ids) == text.encode()
    assert words.encode(text) == words._plain(text)
