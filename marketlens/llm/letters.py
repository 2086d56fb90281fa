"""Where module ``regex`` and a tokenizer's own library class a character differently.

Both follow Unicode, but not one version of it: letters and numerals that are new
in one are unassigned in the other.  The classes are asked of the library itself,
by splitting every code point once a process, but those of planes 4 to 13 and of the
private planes, which hold no letter or numeral in any version.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import regex

CLASSES = (r"\p{L}", r"\p{N}")
#: A character that all libraries class alike, for each class and for neither.
STAND_INS = ("é", "²", "¤")


@cache
def all_characters() -> str:
    """The code points that are classed, surrogates left out."""
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xF0000)]))


def by_tiktoken(pattern: str) -> str:
    """The characters that tiktoken matches by a class."""
    import tiktoken

    bytewise = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)},
                                 special_tokens={})
    return bytes(bytewise.encode_ordinary(all_characters())).decode()


def by_tokenizers(pattern: str) -> str:
    """The characters that module ``tokenizers`` matches by a class."""
    from tokenizers import Regex, pre_tokenizers

    others = pre_tokenizers.Split(Regex(f"[^{pattern}]+"), "removed")
    return "".join(piece for piece, _ in others.pre_tokenize_str(all_characters()))


@cache
def stand_ins(matched: Callable[[str], str]) -> dict[int, str]:
    """Code points that ``regex`` classes otherwise than the library: a stand-in of the library's class."""
    theirs = [set(matched(c)) for c in CLASSES]
    ours = [set(regex.findall(c, all_characters())) for c in CLASSES]
    unlike = set().union(*(a ^ b for a, b in zip(theirs, ours)))
    return {ord(c): next((s for s, own in zip(STAND_INS, theirs) if c in own), STAND_INS[-1]) for c in unlike}


def any_of(code_points) -> re.Pattern:
    """Finds any of these characters, and if one is beyond the first plane, all that are.

    ``re`` looks a character of the first plane up in a bitmap but walks through a list of
    others, so these are one range; what it finds too often is handled rightly, only slower.
    """
    near = "".join(re.escape(chr(c)) for c in sorted(code_points) if c < 0x10000)
    far = "\U00010000-\U0010ffff" if any(c >= 0x10000 for c in code_points) else ""
    return re.compile(f"[{near}{far}]" if code_points else r"(?!)")
