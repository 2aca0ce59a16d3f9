"""Token ids of whole texts, by a public tokenizer file of the ``tokenizers`` library.

Both tokenizer files cut a text into pre-tokens before any merge, and no
pre-token crosses certain places. Texts are cut at such places, ids of a piece
are looked up, and only pieces not seen lately go through the tokenizer, many in
one call. The ids are those of ``encode(text, add_special_tokens=False)``.

``spaced`` files (byte-level) keep the space before a word in its pre-token: a
text may be cut before a single space and around a single line feed, if the
neighbours are no white space. The others drop white space, so every white space
is such a place.
"""

from __future__ import annotations

import os
import re
import string
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DOUBLE_SPACE = re.compile(r"\s\s")
# white space in a row, or a mark after white space or another mark; begins with one class, which is searched fast
MARKS_IN_A_ROW = re.compile(r"[\W_](?:(?<=\s)\s|[^\w\s]|_)")
# lower case of these letters does not depend on their neighbours, and none of them composes
PLAIN_LATIN = re.compile(r"[^\x00-\u012f\u0131-\u024f]")
CUT = re.compile(r"(?<=\S)(?=[ ]\S)")
CONTROL_SPACE = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the tokenizers
MARKS = string.punctuation
GENERATION = 1 << 18
STRETCH = 1 << 20
AT_ONCE = 1 << 18


def byte_chars() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


BYTE_CHARS = byte_chars()


def marks_apart(text: str, cut: str) -> str:
    """With a cut before each comma or full stop that ends a word; none of them may stand next to another mark."""
    for mark in ",.":
        for end in " \n":
            text = text.replace(mark + end, cut + mark + end)
    return text[:-1] + cut + text[-1] if text[-1:] in (",", ".") else text


def stretches(texts: list[str]) -> Iterator[list[str]]:
    """Texts in lists of about ``STRETCH`` characters; a longer text is a list of its own."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > STRETCH:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


class PieceMemory(dict):
    """Ids of the pieces seen lately; looking up another one makes them.

    Two generations are kept: when the young one, the dictionary itself, is full
    it becomes the old one, and what is used again moves back. Memory is bounded;
    ids never depend on what is remembered.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(self) >= GENERATION:
            self.old = self.copy()
            self.clear()
        self[piece] = ids
        return ids


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, with a bounded memory of pieces."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenize = self.tokenizer.model.tokenize
        self.spaced = spaced
        self.known = PieceMemory(self.ids_of)
        self.tails: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def special(self, text: str) -> bool:
        return any(s in text for s in self.specials)

    def marked_cuts(self, text: str) -> str | None:
        """The text with a cut (white space, or a zero character in spaced files) where no pre-token can cross. None: not so simple."""
        if "\0" in text or self.special(text):
            return None
        if not self.spaced:
            if CONTROL_SPACE.search(text):
                return None
            if PLAIN_LATIN.search(text):
                return text
            text = text.lower()
            return text if MARKS_IN_A_ROW.search(text) else marks_apart(text, " ")
        if DOUBLE_SPACE.search(text):
            return None
        if not MARKS_IN_A_ROW.search(text):
            text = marks_apart(text, "\0")
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ")

    def one_by_one(self, text: str) -> bytes:
        """Ids of a text that cannot be cut so simply."""
        whole = "\0" in text or self.special(text) or not self.spaced
        return self.whole(text) if whole else b"".join(map(self.known.__getitem__, CUT.split(text)))

    def ids_of(self, piece: str) -> bytes:
        if not piece:
            return b""
        return self.word(piece) or self.marked(piece)

    def word(self, piece: str) -> bytes | None:
        """Ids of a piece of letters only, perhaps after a space: it is one pre-token. None for others."""
        if self.spaced:
            word = piece[1:] if piece[0] == " " else piece
        elif PLAIN_LATIN.search(piece):
            word = piece = self.tokenizer.normalizer.normalize_str(piece)
        else:
            word = piece = piece.lower()
        if not word.isalpha():
            return None
        if piece.isascii():
            chars = piece if word is piece else BYTE_CHARS[32] + word
        else:
            chars = piece.encode().decode("latin-1").translate(BYTE_CHARS)
        ids = [t.id for t in self.tokenize(chars)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def marked(self, piece: str) -> bytes:
        """Ids of any other piece; marks after letters are a pre-token of their own."""
        stem = piece.rstrip(MARKS)
        if stem and stem != piece and (ids := self.word(stem)) is not None:
            tail = piece[len(stem) :]
            if tail not in self.tails:
                if len(self.tails) >= GENERATION // 8:
                    self.tails.clear()
                self.tails[tail] = self.whole(tail)
            return ids + self.tails[tail]
        return self.whole(piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.marked_cuts(t) for t in texts]
        simple = (found for stretch in stretches([c for c in cut if c is not None]) for found in self.joined(stretch))
        return [self.one_by_one(t) if c is None else next(simple) for t, c in zip(texts, cut, strict=True)]

    def joined(self, cut: list[str]) -> Iterator[bytes]:
        """Ids of texts with marked cuts: each different piece is looked up once, its ids are put in all its places."""
        column = pa.array(cut, pa.large_string())
        parts = pc.split_pattern(column, "\0") if self.spaced else pc.utf8_split_whitespace(column)
        pieces = parts.values.dictionary_encode()
        ids = list(map(self.known.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(ids), "<u4")
        found = [np.empty(0, "<u4")]
        place = pieces.indices.to_numpy()
        for a in range(0, len(place), AT_ONCE):
            here = place[a : a + AT_ONCE]
            counts = lengths[here]
            ends = np.cumsum(counts)
            found.append(flat[np.arange(ends[-1]) + np.repeat(starts[here] - ends + counts, counts)])
        all_ids = np.concatenate(found)
        ends = np.cumsum(lengths[place])
        before = np.concatenate([[0], ends])[parts.offsets.to_numpy()].tolist()
        return (all_ids[a:b].tobytes() for a, b in zip(before[:-1], before[1:], strict=True))


ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaced: bool) -> PieceEncoder:
    """One encoder per Python worker and file."""
    if (path, spaced) not in ENCODERS:
        ENCODERS[path, spaced] = PieceEncoder(path, spaced)
    return ENCODERS[path, spaced]
