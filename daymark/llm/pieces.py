"""The pieces into which ``word_bpe_49k.json`` splits a word, for words of characters below U+0250.

These characters do not compose, and what they are has not changed between versions of Unicode. The library's own tables
decide about all others.
"""

from __future__ import annotations

import regex

# Printable pieces of the vocabulary's pattern; case is folded before.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")
_BEYOND = "ɐ"


def simple_pieces(text: str) -> list[str] | None:
    """Pieces in lower case; None if the library has to be asked."""
    if text.isascii():
        return _PIECE.findall(text.lower())
    if max(text) < _BEYOND:
        # Character by character, because lower() looks at neighbours.
        return _PIECE.findall("".join([c.lower() for c in text]))
    return None


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1, else the next one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    return [chr(byte) if byte in own else chr(next(moved)) for byte in range(256)]
