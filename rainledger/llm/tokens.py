"""Token ids of whole texts by a public tokenizer's file, a word at a time.

A byte-level BPE file first cuts a text by its pattern and then merges inside each piece, so a
word's ids do not depend on its neighbours. Encoding each word once and joining the stored
ids gives the ids of the whole text several times faster than encoding the text.
"""

from __future__ import annotations

import json
from functools import lru_cache

import regex

MEMO_WORDS = 400_000  # entries of which a worker keeps twice as many, about 150 MB
#: What keeps a text from being cut at each space and line end: white space beside white space or of another kind.
_UNEVEN = ["  ", "\n\n", " \n", "\n ", "\x01"] + [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def default_tokenizer() -> str:
    """The driver's path of the vocabulary the queries use; it is the same on each executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE files write for each byte, by the usual rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo(dict):
    """Ids by word; a word that is not there yet is made when it is asked for."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self._make(word)
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The library finds the strings of the file's added tokens in a text before it cuts; texts that hold one go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        pre = content["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
            raise ValueError(f"{path} is not a byte-level vocabulary with the usual pattern")
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._added = [token["content"] for token in content.get("added_tokens", [])]
        self._pieces = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ).findall
        self._letters = _byte_letters()
        self._memo = _Memo(self._made)
        self._before: dict[str, bytes] = {}

    def _pieces_of(self, word: str) -> list[str]:
        """What the pattern cuts a word into; letters, or letters and one sign behind them, need no pattern."""
        bare = word[1:] if word[:1] == " " else word
        if bare.isalpha():
            return [word]
        if bare[:-1].isalpha() and not bare[-1].isalnum() and not bare[-1].isspace():
            return [word[:-1], word[-1]]
        return self._pieces(word)

    def _encode_word(self, word: str) -> bytes:
        pieces = self._pieces_of(word)
        return self._encode_piece(word) if len(pieces) == 1 else b"".join(map(self._recall, pieces))

    def _encode_piece(self, piece: str) -> bytes:
        tokens = self._model.tokenize(piece.encode().decode("latin-1").translate(self._letters))
        return b"".join([token.id.to_bytes(4, "little") for token in tokens])

    def _made(self, word: str) -> bytes:
        return self._before.get(word) or self._encode_word(word)

    def _recall(self, piece: str) -> bytes:
        ids = self._memo.get(piece) or self._before.get(piece) or self._encode_piece(piece)
        self._memo[piece] = ids
        return ids

    def _words(self, text: str) -> list[str]:
        """Neighbouring parts of a text between which the pattern always cuts."""
        if any(map(text.__contains__, _UNEVEN)):
            return self._pieces(text)
        return text.replace("\n", "\x01\n\x01").replace(" ", "\x01 ").split("\x01")

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [any(map(text.__contains__, self._added)) for text in texts]
        if len(self._memo) > MEMO_WORDS:  # what is met again comes back from there
            self._memo, self._before = _Memo(self._made), self._memo
        ids = self._memo.__getitem__
        return [self._by_library(t) if added else b"".join(map(ids, self._words(t))) for t, added in zip(texts, whole, strict=True)]

    def _by_library(self, text: str) -> bytes:
        return b"".join([token.to_bytes(4, "little") for token in self._tokenizer.encode(text, add_special_tokens=False).ids])


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per Python worker, kept from task to task."""
    return Encoder(path)
