"""Token ids of whole texts with a public tokenizer, through a word cache."""

from __future__ import annotations

import json
import re
import sys
from array import array

#: Entries of each word cache of one Python worker (about 250 bytes each); a full cache starts anew.
MAX_CACHED = 800_000

#: Of the tokenizer file: the stages for which pieces between blanks may be looked up one by one.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# blanks and characters below U+0250: composed already, with one lower case whatever stands beside them
_PLAIN = re.compile("[\n -~¡-¬®-įı-ɏ]++")


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= MAX_CACHED:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _little(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class TokenBytes:
    """``ids(text)``: the text's ids as little-endian unsigned 32-bit numbers.

    Same ids as ``Tokenizer.encode(text, add_special_tokens=False)``. For a
    tokenizer that splits at white space before anything else, pieces between
    blanks are encoded once and cached; any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        try:
            self.by_word = (
                [n["type"] for n in spec["normalizer"]["normalizers"]] == _NORMALIZERS
                and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == _WORDS
                and spec["pre_tokenizer"]["pretokenizers"][1]["type"] == "ByteLevel"
                and not spec["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"]
                and not spec["post_processor"]
                and not any(" " in t["content"] or "\n" in t["content"] or t["normalized"] for t in spec["added_tokens"])
            )
        except (KeyError, TypeError, IndexError):
            self.by_word = False
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.split = regex.compile(_WORDS).findall
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(rest)}}
        self.pieces = _Cache(self._piece)
        self.others = _Cache(self._other)

    def _whole(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """Ids of one word of the split pattern."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return _little([t.id for t in self.model.tokenize(word)])

    def _piece(self, piece: str) -> bytes:
        """Ids of what stands between two blanks of a plain lower-case text."""
        if piece.isalpha():
            return self._word(piece)
        if not piece:
            return b""
        if piece[-1] in ".," and piece[:-1].isalpha():
            return self.pieces[piece[:-1]] + self.pieces[piece[-1]]
        words = self.split(piece)
        return self._word(piece) if len(words) == 1 else b"".join(map(self.pieces.__getitem__, words))

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word:
            return self._whole(text)
        if _PLAIN.fullmatch(text) and not any(t in text for t in self.added):
            return b"".join(map(self.pieces.__getitem__, text.lower().replace("\n", " ").split(" ")))
        return b"".join(map(self.others.__getitem__, text.replace("\n", " ").split(" ")))

    def _other(self, piece: str) -> bytes:
        """The same for any text."""
        if piece and (not _PLAIN.fullmatch(piece) or any(t in piece for t in self.added)):
            return self._whole(piece)
        return self.pieces[piece.lower()]


_loaded: dict[str, TokenBytes] = {}


def tokenizer(path: str) -> TokenBytes:
    """One per worker and file."""
    if path not in _loaded:
        _loaded[path] = TokenBytes(path)
    return _loaded[path]
