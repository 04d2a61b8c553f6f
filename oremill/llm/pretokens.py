"""Splitting text into the pre-tokens of a byte-level vocabulary, as its libraries do."""

from __future__ import annotations

import public_tokenizers
import regex
from tokenizers import pre_tokenizers

_PATTERN = regex.compile(public_tokenizers.PATTERN)

#: Scripts whose character classes have been the same in every Unicode version since the libraries' one.  Letters
#: outside may be newer to one library than to another; texts that hold some are split by the library itself, which is
#: slower and otherwise the same.  A test compares both ways over all code points.
_STABLE = regex.compile(
    r"[\u0000-՗א-תؠ-ۿऀ-ॣḀ-῿ - ₠-₿℀-↉"
    r"←-⏿─-➿　-ヿ一-鿯가-힣︀-️＀-￯\U0001f300-\U0001f64f]*"
)
_LIBRARY = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def split(text: str) -> list[str]:
    """The matches of the pattern, in order; joined they give the text again."""
    if text.isascii() or _STABLE.fullmatch(text):
        return _PATTERN.findall(text)
    return [text[start:end] for _, (start, end) in _LIBRARY.pre_tokenize_str(text)]
