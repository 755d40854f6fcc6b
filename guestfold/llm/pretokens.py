"""Words (pre-tokens) of a ``tokenizers`` file, split without the library where that is provably equal."""

from __future__ import annotations

import json
import re

from tokenizers import Tokenizer

#: Characters for which Python's and the library's classes and lower-casing agree, and which normalisation leaves alone:
#: ASCII without most controls, and composed Latin letters.  Any other character sends a text through the library.
UNSAFE = re.compile("[^\t-\r\x20-\x7e¡§«»¿À-ÖØ-öø-įĲ-ňŊ-ž]")
_LETTER = "A-Za-zÀ-ÖØ-öø-ž"
#: The split patterns of the two files, restricted to those characters.
SPLIT = {
    "byte": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+"),
    "word": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+"),
}


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0x100
    for b in range(256):
        out[b] = chr(b) if b in own else chr(extra)
        extra += b not in own
    return out


_TO_BYTE_CHARS = {i: c for i, c in enumerate(byte_chars())}


class Splitter:
    """Cuts a text into special strings and words of byte characters, as the tokenizer of ``path`` does."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        added = self.spec["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: added tokens with options are not supported")
        self.special = {t["content"]: t["id"] for t in added}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.word_end = self.spec["model"].get("end_of_word_suffix")
        self.fast = SPLIT["word" if self.word_end else "byte"]

    def pieces(self, text: str) -> list[tuple[str, bool]]:
        """(piece, whether it is a special string), in order."""
        if not self.special or not any(s in text for s in self.special):
            return [(text, False)]
        return [(x, i % 2 == 1) for i, x in enumerate(self._special.split(text)) if x]

    def words(self, piece: str) -> tuple[list[str], bool]:
        """Words of a piece, and whether they are raw text (:meth:`chars` turns them into byte characters)."""
        if not UNSAFE.search(piece):
            return self.fast.findall(piece.lower() if self.word_end else piece), True
        if self.tokenizer.normalizer:
            piece = self.tokenizer.normalizer.normalize_str(piece)
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)], False

    @staticmethod
    def chars(word: str) -> str:
        return word.encode().decode("latin-1").translate(_TO_BYTE_CHARS)
