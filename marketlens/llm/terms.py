"""Words of UTF-8 texts by byte classes."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text that are split at once.
SLICE = 1 << 22


def class_table(digits: bool) -> bytes:
    """A translation of bytes: A-Z to a-z, the rest of ASCII to blanks but a-z and, on
    demand, digits. Bytes beyond ASCII, so all other characters, stay."""
    out = bytearray(range(256))
    for b in range(128):
        char = chr(b)
        keep = char.isalpha() or (digits and char.isdigit())
        out[b] = ord(char.lower()) if keep else 0x20
    return bytes(out)


LETTERS = class_table(digits=False)
LETTERS_DIGITS = class_table(digits=True)


def words(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a slice at a time; a slice ends where a word ends."""
    if len(text) <= SLICE:
        yield text.translate(table).split()
        return
    rest = b""
    for at in range(0, len(text), SLICE):
        part = rest + text[at:at + SLICE].translate(table)
        cut = part.rfind(b" ") + 1
        rest = part[cut:]
        yield part[:cut].split()
    yield rest.split()
