"""Exact token ids of whole texts, with each distinct piece encoded once per worker.

Both public BPE vocabularies cut a text into pieces before merging, and no merge
crosses a piece.  A text is therefore split at white space by plain string code,
and the ids of each white-space piece come from a bounded cache; only a miss
reaches the ``tokenizers`` library.  Texts for which that split is not provably
the library's own (characters beyond Latin-1, special strings, unusual white
space) go to the library whole, so ids are always the library's.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from streetflow.llm.common import held

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"

#: Latin-1 letters and numbers as the split patterns of both files class them.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
#: Control characters that Python's str.split() takes for white space and the files don't.
NOT_SPACES = "\x1c\x1d\x1e\x1f"

#: Bytes of each of a worker's two piece caches; at the limit it starts anew.
CACHE_BYTES = 48 << 20
#: What an entry takes beside its letters and ids.
ENTRY_BYTES = 160


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def library(path: str):
    """The file's tokenizer with truncation and padding off; one per process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def specials(path: str) -> dict[str, int]:
    return {t.content: i for i, t in library(path).get_added_tokens_decoder().items()}


def latin1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Pieces(dict):
    """piece -> ids as little-endian uint16 bytes, filled on a miss."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.size = encode, most, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        self.size += len(piece) + len(ids) + ENTRY_BYTES
        if self.size > self.most:
            self.clear()
            self.size = len(piece) + len(ids) + ENTRY_BYTES
        self[piece] = ids
        return ids


class Encoder:
    """``ids16(text)``: the library's ids as uint16 bytes; vocabularies under 65,536 ids."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.path = path
        self.tok = library(path)
        if self.tok.get_vocab_size() > 65_536:
            raise ValueError("ids are kept as 16-bit numbers")
        self.marks = tuple(specials(path))
        self.model = self.tok.model
        self.spelling = byte_letters()
        self.words = _Pieces(self._word, cache_bytes)
        self.pieces = _Pieces(self._split, cache_bytes)

    def _library(self, text: str) -> bytes:
        return array("H", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def spell(self, word: str) -> str:
        """The word in byte letters, as the vocabulary has it."""
        if word.isascii() and word.isprintable() and " " not in word:
            return word
        return "".join(map(self.spelling.__getitem__, word.encode()))

    def _word(self, word: str) -> bytes:
        """Ids of one word that the file's normalizer and split leave as it is: merging alone is left to do."""
        return array("H", [t.id for t in self.model.tokenize(self.spell(word))]).tobytes()

    def _split(self, piece: str) -> bytes:
        raise NotImplementedError

    def plain(self, text: str) -> bool:
        return latin1(text) and not any(m in text for m in self.marks)

    def ids16(self, text: str) -> bytes:
        cut = self.cut(text)
        if cut is None:
            return self._library(text)
        return b"".join(map(self.pieces.__getitem__, cut))

    def cut(self, text: str) -> list[str] | None:
        raise NotImplementedError


class WordEncoder(Encoder):
    """``word_bpe_49k``: lower case, white space dropped, so white space separates pieces."""

    _words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")

    def cut(self, text: str) -> list[str] | None:
        if not self.plain(text) or any(c in text for c in NOT_SPACES):
            return None
        return text.split()

    def _split(self, piece: str) -> bytes:
        piece = piece.lower()
        if piece.isalpha():
            return self.words[piece]
        return b"".join(map(self.words.__getitem__, self._words.findall(piece)))


class ByteEncoder(Encoder):
    """``byte_bpe_50k``: a single space belongs to the piece after it."""

    _chunks = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
    _words = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
        f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
    )
    #: Where a space has white space beside it, cutting at spaces would part what belongs together.
    _odd = ("  ", " \n", "\n ", "\t", "\r", "\v", "\f", "\x85", "\xa0")

    def cut(self, text: str) -> list[str] | None:
        if not self.plain(text):
            return None
        if any(o in text for o in self._odd):
            return self._chunks.findall(text)
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)] if first else [*map(" ".__add__, rest)]

    def _split(self, piece: str) -> bytes:
        if piece[1:].isalpha() and piece[0] == " ":
            return self.words[piece]
        return b"".join(map(self.words.__getitem__, self._words.findall(piece)))


def encoder(path: str) -> Encoder:
    """One encoder per process and file: its caches last over the tasks of a worker's stage."""
    return held("bpe", path, lambda: new_encoder(path))


def new_encoder(path: str) -> Encoder:
    """The split is chosen by the file's own pre-tokenizer; another layout is refused.
    """
    import json

    pre = json.loads(library(path).to_str())["pre_tokenizer"]
    if pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return ByteEncoder(path)
    if pre["type"] == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
        return WordEncoder(path)
    raise ValueError(f"{path}: unknown pre-tokenizer")
