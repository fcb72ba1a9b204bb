"""Token ids of whole texts with the tokenizers library, each distinct word encoded once.

Words are told apart in Arrow's memory: texts are split by their bytes, equal words of a slice of
texts become one entry of a dictionary, and Python meets only those.
"""

from __future__ import annotations

import re
import struct
import sys
import types
from collections.abc import Iterator
from itertools import pairwise
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of Unicode, as the tokenizers' own patterns take it.
WHITE = r"\t-\r \x85\xa0  -     　"

#: The same without ASCII, for Arrow's patterns.
WIDE = WHITE.removeprefix(r"\t-\r ").replace(r"\x85\xa0", r"\x{85}\x{a0}")

#: A byte-level tokenizer never joins what these pieces separate: one leading blank goes with a
#: word, other white space stands apart.
BYTE_PIECES = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: A tokenizer that drops white space.
WORD_PIECES = r"[^\t-\r ]+"
#: Bytes of text that are split at a time; a longer text is a slice by itself.
SLICE_BYTES = 4 << 20


#: Letters that both kinds of tokenizer take as such, and that no normaliser but lower case changes.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: ASCII marks behind a word stand apart from it, but for the apostrophe.
PLAIN = re.compile(rf"( ?[{LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)").fullmatch
#: The same without marks.
WORD = re.compile(rf" ?[{LETTERS}]+").fullmatch


#: By byte: 1 for an ASCII letter, 2 for such a mark. Both kinds of tokenizer part the two.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[[b for b in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if b != 39]] = 2

#: Words that go through the model at a time, where they can be told apart again.
JOINED = 100
id_of = attrgetter("id")


def byte_letters() -> dict[int, str]:
    """Byte to the letter that stands for it in the vocabularies of byte-level tokenizers.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder(dict):
    """Encodes texts piece by piece and remembers up to `most` distinct pieces.

    The result is that of encoding the whole text, as no token of these tokenizers spans two
    pieces. Plain words go straight to the tokenizer's model, all else through its whole chain. A
    text with the string of a special token, which may stand across pieces, is encoded as a whole
    by `encode`; in a piece by itself such a string is ordinary text. Pieces of over 200
    characters are not remembered, so `most` bounds the bytes held too, at some 200 a piece.
    """

    def __init__(self, path: str, pieces: str, most: int = 400_000) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.special_strings = [
            t.content for t in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.split = re.compile(pieces).findall
        self.lower = pieces == WORD_PIECES
        #: Texts that `encode` takes piece by piece in Python, or as a whole.
        self.odd = "|".join([*map(re.escape, self.special_strings), *([] if self.lower else [f"[{WIDE}]"])])
        self.letters = byte_letters()
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(32)]
        # The letter of a byte that no text in UTF-8 has. It parts words where the model joins it to
        # nothing and does not mark where words end.
        self.gap = self.letters[255]
        holding = [i for t, i in self.tokenizer.get_vocab().items() if self.gap in t]
        alone = len(holding) == 1 and not self.tokenizer.model.end_of_word_suffix
        self.gap_id = holding[0] if alone else None
        self.most = most
        self.older: dict[str, bytes] = {}

    @staticmethod
    def of(path: str, pieces: str, most: int = 400_000) -> Encoder:
        """The encoder of this worker process, so that later tasks find what it remembers."""
        store = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
        if (path, pieces, most) not in vars(store):
            vars(store)[path, pieces, most] = Encoder(path, pieces, most)
        return vars(store)[path, pieces, most]

    def forget(self) -> None:
        """Keep what was met lately for one more half of `most`; the rest goes."""
        if len(self) * 2 >= self.most:
            self.older = dict(self)
            self.clear()

    def of_all(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of many distinct pieces; plain words not met yet are taken together."""
        found = list(map(self.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), 10_000):
            self.forget()
            block = new[at : at + 10_000]
            own, older = [pieces[i] for i in block], self.older
            self.update((piece, older[piece]) for piece in own if piece in older)
            words = [piece for piece in own if piece not in older and WORD(piece) and len(piece) <= 200]
            self.update(zip(words, self.of_words(words), strict=True))
            for i, ids in zip(block, map(self.__getitem__, own), strict=True):
                found[i] = ids
        return found

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each of many plain words."""
        texts, model = self.in_letters(words), self.tokenizer.model.tokenize
        if self.gap_id is None:
            found = [list(map(id_of, model(text))) for text in texts]
            return [self.pack[len(ids)](*ids) if len(ids) < 32 else packed(ids) for ids in found]
        flat: list[int] = []
        for at in range(0, len(texts), JOINED):
            flat += map(id_of, model(self.gap.join(texts[at : at + JOINED])))
            flat.append(self.gap_id)
        ids = np.array(flat, "<u4")
        stops, data = np.flatnonzero(ids == self.gap_id) * 4, ids.tobytes()
        starts = [0, *(stops[:-1] + 4).tolist()]
        return [data[a:b] for a, b in zip(starts, stops.tolist(), strict=False)]

    def in_letters(self, words: list[str]) -> list[str]:
        """Plain words as the tokenizer's model takes them."""
        if not words:
            return []
        text = "\0".join(words)
        text = text.lower() if self.lower else text
        return text.encode().decode("latin-1").translate(self.letters).split(self.letters[0])

    def __missing__(self, piece: str) -> bytes:
        self.forget()
        if (found := self.older.get(piece)) is not None:
            self[piece] = found
            return found
        plain = PLAIN(piece)
        if plain and plain[2]:
            found = self[plain[1]] + self[plain[2]]
        elif plain:
            (word,) = self.in_letters([piece])
            found = packed([t.id for t in self.tokenizer.model.tokenize(word)])
        else:
            found = packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= 200:
            self[piece] = found
        return found

    def whole(self, text: str) -> bytes:
        """Ids of a text by the library itself, special tokens included."""
        self.tokenizer.encode_special_tokens = False
        try:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        finally:
            self.tokenizer.encode_special_tokens = True
        return packed(ids)

    def encode(self, texts: list[str] | pa.Array, end: int) -> Iterator[np.ndarray]:
        """Ids of each text with the end id behind, as unsigned 32-bit integers, slice by slice."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        tail = np.array([end], "<u4")
        stops = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        borders = np.flatnonzero(np.diff(stops // SLICE_BYTES)) + 1
        for first, stop in pairwise([0, *borders.tolist(), len(texts)]):
            part = texts.slice(first, stop - first)
            odd = pc.match_substring_regex(part, self.odd)
            plain = iter(self.by_bytes(part.filter(pc.invert(odd))))
            for row, is_odd in enumerate(odd.to_pylist()):
                ids = self.one(part[row].as_py()) if is_odd else next(plain)
                yield np.concatenate([ids, tail])

    def one(self, text: str) -> np.ndarray:
        """Ids of one text, whatever it holds."""
        if any(s in text for s in self.special_strings):
            return np.frombuffer(self.whole(text), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, self.split(text))), "<u4")

    def by_bytes(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts whose only white space is ASCII and that hold no special token.

        Borders of pieces are those of the pattern: a piece starts where a text or white space
        starts, at the last white space before a word, and at a word that no blank leads. Between
        an ASCII letter and a mark there is one too, so that a word is met once with any marks.
        """
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        bounds = bounds.astype(np.int64)
        if bounds[0] == bounds[-1]:
            return [np.zeros(0, "<u4")] * len(texts)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds -= bounds[0]
        white = (data == 32) | (data >= 9) & (data <= 13)
        opens = np.zeros(len(data) + 1, bool)  # a text starts here, or all end
        opens[bounds] = True
        kind = KINDS[data]
        parted = kind[1:] + kind[:-1] == 3
        if self.lower:
            starts = ~white
            starts[1:] &= white[:-1] | opens[1:-1] | parted
            # White space is no part of a word: it goes, and all positions move up.
            moved = np.concatenate([[0], np.cumsum(~white)])
            starts, bounds, data = moved[np.flatnonzero(starts)], moved[bounds], data[~white]
        else:
            starts = opens[:-1].copy()
            starts[1:] |= white[1:] & ~white[:-1]
            starts[1:] |= ~white[1:] & white[:-1] & (data[:-1] != 32)
            starts[:-1] |= white[:-1] & ~white[1:] & ~opens[1:-1]
            starts[1:] |= parted
            starts = np.flatnonzero(starts)
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(
            pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        found = self.of_all(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = pieces.indices.to_numpy()
        length = size[which]
        stops = np.cumsum(length)
        # Where each piece's ids stand, less where they go.
        shift = (np.cumsum(size) - size)[which] - (stops - length)
        ids = ids[np.repeat(shift, length) + np.arange(stops[-1] if len(stops) else 0)]
        ends = np.concatenate([[0], stops])[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
