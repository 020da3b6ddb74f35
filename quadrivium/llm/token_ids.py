"""Token ids of whole texts through the tokenizers library, with bounded caches in each Python worker.

A text of Latin letters and ASCII blanks is cut into the pieces that the library's pattern makes by one search.  Any other
text is cut into chunks where no token can cross, and chunks into pieces.  Each piece goes to the library's model once
while it is remembered; so do the joined ids of chunks.  Both caches are bounded in bytes, a worker keeps those of one
tokenizer only, and no result depends on what they hold.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import regex

#: Bytes of a worker's cache of whole chunks, and of each of two generations of pieces unless a kind says otherwise.
CHUNK_BYTES, PIECE_BYTES = 24_000_000, 40_000_000
#: What an entry takes beside its characters and ids.
ENTRY_BYTES = 170
CACHED_CHARS = 64
SPACES = " \t\n\x0b\x0c\r"
#: White space beyond ASCII that the pre-tokenizing patterns know; such texts go to the library whole.
WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: A chunk takes the one space before it; of a run of white space, the last character is apart.
BYTE_CHUNKS = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?=[{SPACES}][^{SPACES}])|[{SPACES}](?=[^{SPACES}])|[{SPACES}]+")
WORD_CHUNKS = re.compile(f"[^{SPACES}]+")
#: Punctuation that never joins a token with the letters before it.
STOPS = frozenset(",.!?:;|")
BYTE_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same classes after lower-casing; white space is dropped.  The first knows ASCII only.
WORD_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\s]+")
WIDE_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Characters that compose with others, or have a lower case by rules of their own, begin here; so does white space.
LATIN = re.compile("[!-~\xa1-\u012f\u0131-\u024f]+")
#: Texts of such characters and ASCII blanks, and their pieces by the plain ``re`` module, which is faster on whole texts.
PLAIN = re.compile(f"[{SPACES}!-~\xa1-\u012f\u0131-\u024f]*")


def _of_category(kind: str) -> str:
    """Characters of a category among those of ``LATIN`` and their lower cases."""
    plain = [c for c in map(chr, range(0x250)) if LATIN.fullmatch(c)]
    return "".join(sorted({x for c in plain for x in c + c.lower() if unicodedata.category(x)[0] == kind}))


LETTER, NUMBER = _of_category("L"), _of_category("N")
PLAIN_BYTE_PIECES = re.compile(
    f" ?[{LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBER}]+| ?[^{SPACES}{LETTER}{NUMBER}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
PLAIN_WORD_PIECES = re.compile(f"[{LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d|[{NUMBER}]|[^{SPACES}{LETTER}{NUMBER}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + k)
    return [letters[b] for b in range(256)]


LETTERS = byte_letters()
#: The same for the characters whose code points are the bytes.
LETTER_OF = dict(enumerate(LETTERS))


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Pieces(dict):
    """piece -> its ids; a full generation becomes the old one, and what is met again moves back."""

    def __init__(self, tokenize, most: int):
        super().__init__()
        self.tokenize, self.most, self.old, self.held = tokenize, most, {}, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", [t.id for t in self.tokenize(self.key(piece))]).tobytes()
        if len(piece) <= CACHED_CHARS:
            if self.held > self.most:
                self.old, self.held = dict(self), 0
                self.clear()
            self[piece] = ids
            self.held += len(piece) + len(ids) + ENTRY_BYTES
        return ids

    def key(self, piece: str) -> str:
        """The piece in the letters of byte-level vocabularies."""
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", LETTERS[32])
        return piece.encode().decode("latin-1").translate(LETTER_OF)

    def forget(self) -> None:
        self.clear()
        self.old, self.held = {}, 0


class ChunkIds(dict):
    """chunk -> its ids as little-endian unsigned 32-bit integers."""

    piece_bytes = PIECE_BYTES

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)
        self.pieces, self.held = Pieces(self.tokenizer.model.tokenize, self.piece_bytes), 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        if len(chunk) <= CACHED_CHARS:
            if self.held > CHUNK_BYTES:
                self.clear()
                self.held = 0
            self[chunk] = ids
            self.held += len(chunk) + len(ids) + ENTRY_BYTES
        return ids

    def forget(self) -> None:
        self.clear()
        self.held = 0
        self.pieces.forget()

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def joined(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, chunk: str) -> bytes:
        raise NotImplementedError

    def ids(self, text: str) -> bytes:
        raise NotImplementedError


class ByteLevelIds(ChunkIds):
    """Byte-level BPE with the usual pre-tokenizing pattern and no normaliser."""

    def encode(self, chunk: str) -> bytes:
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isalpha():
            return self.pieces[chunk]
        if body[-1:] in STOPS and body[:-1].isalpha():
            return self.pieces[chunk[:-1]] + self.pieces[chunk[-1]]
        return self.whole(chunk) if "<|" in chunk else self.joined(BYTE_PIECES.findall(chunk))

    def ids(self, text: str) -> bytes:
        if "<|" in text:
            return self.whole(text)
        if PLAIN.fullmatch(text):
            return self.joined(PLAIN_BYTE_PIECES.findall(text))
        if WIDE_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, BYTE_CHUNKS.findall(text)))


class WordIds(ChunkIds):
    """BPE with word ends over lower-cased text; white space is dropped, so chunks are its gaps."""

    piece_bytes = 60_000_000  # its pieces are slow to make: the library's model searches merges up to a word's end

    def encode(self, chunk: str) -> bytes:
        if not LATIN.fullmatch(chunk) or "<|" in chunk:
            if chunk[-1:] in STOPS and chunk[:-1].isalpha():
                return self[chunk[:-1]] + self.pieces[chunk[-1]]
            return self.whole(chunk)
        low = chunk.lower()
        if low.isalpha():
            return self.pieces[low]
        if low[-1] in STOPS and low[:-1].isalpha():
            return self.pieces[low[:-1]] + self.pieces[low[-1]]
        return self.joined((WORD_PIECES if low.isascii() else WIDE_PIECES).findall(low))

    def ids(self, text: str) -> bytes:
        if "<|" in text:
            return self.whole(text)
        if PLAIN.fullmatch(text):
            return self.joined(PLAIN_WORD_PIECES.findall(text.lower()))
        return b"".join(map(self.__getitem__, WORD_CHUNKS.findall(text)))


_LOADED: dict[tuple[type, str], ChunkIds] = {}


def loaded(kind: type[ChunkIds], path: str) -> ChunkIds:
    """One instance per worker process, kept from task to task; only the one asked for last keeps its caches."""
    for key, other in _LOADED.items():
        if key != (kind, path):
            other.forget()
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]
