"""Words of whole texts as bytes, for the operators that count them.

A word is a run of ASCII digits and letters and of anything beyond ASCII, with
A-Z lower-cased. In UTF-8 all bytes of a character beyond ASCII are 0x80 or
more, so the bytes can be cut without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from marquee.llm.tokens import release as release  # noqa: F401

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: every byte to itself, to lower case, or to the space that words are cut at
_TO_WORDS = bytes(
    b if b >= 0x80 or b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def words_of(texts: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text of a column; of a NULL none."""
    for value in texts.cast(pa.binary() if not pa.types.is_large_string(texts.type) else pa.large_binary()):
        text = value.as_py()
        yield split_words(text) if text else []
