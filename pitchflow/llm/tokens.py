"""Token ids of whole texts, as the tokenizers library gives them, at the speed of a dictionary.

The byte-level tokenizers used here split a text into words before anything is
merged, and never merge over a place where a space stands before a character
that is no white space. A text is cut at these places, and every different
piece is encoded by the library once per worker; the pieces' ids, as bytes, are
then joined. Strings of special tokens split a text as in the library.
"""

from __future__ import annotations

import re
from codecs import charmap_decode
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept by one worker (about 100 bytes each), and the longest piece worth keeping.
PIECES, PIECE_CHARS = 600_000, 40
#: Bytes of texts whose pieces are numbered together.
TOGETHER = 8 << 20

#: Words of Latin letters with marks behind them, perhaps over a line end: how the library splits these is certain.
# Marks are the printable ones of ASCII but the apostrophe, which may begin a piece of its own with the letters behind it.
_ENDS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿŒœ]+", f"[{re.escape(_ENDS)}]*"
_SIMPLE = re.compile(f"({_LETTERS})({_MARKS})(?:\n({_LETTERS})({_MARKS}))?")
_CUT = re.compile(r"(?= \S)")
#: The byte-level alphabet: bytes that print stand for themselves, the others are numbered from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}
_ALPHABET = "".join(_CHARS[b] for b in range(256))


class Encoder:
    """``encode`` gives ids as little-endian 32-bit integers; ``decode`` the library's text for such ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._pieces: dict[str, bytes] = {}  # by the piece without its space
        self._others: dict[str, bytes] = {}  # by the whole piece
        self._missed = 0
        self._model = self.library.model.tokenize
        self._packed = [i.to_bytes(4, "little") for i in range(1 + max(self.library.get_vocab(with_added_tokens=True).values(), default=-1))]
        self._bytes: list[bytes] | None = None

    def forget(self) -> None:
        """Empties the tables of known pieces."""
        self._pieces, self._others, self._missed = {}, {}, 0

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        """Pieces as they stand, by the library."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """One word as the library's pre-tokenizer gives it to its model."""
        packed = self._packed
        return b"".join([packed[t.id] for t in self._model(charmap_decode(word.encode(), "strict", _ALPHABET)[0])])

    def _letters(self, word: str) -> bytes:
        """A word of ASCII letters with a space before it; the byte-level alphabet writes such letters as they are."""
        packed = self._packed
        return b"".join([packed[t.id] for t in self._model("Ġ" + word)])

    def _other(self, piece: str) -> bytes:
        got = self._others.get(piece)
        if got is None:
            got = self._whole([piece])[0]
            if len(piece) <= PIECE_CHARS and len(self._others) < PIECES // 8:
                self._others[piece] = got
        return got

    def _mark(self, marks: str) -> bytes:
        got = self._others.get(marks)
        if got is None:
            got = self._word(marks)
            if len(marks) <= PIECE_CHARS and len(self._others) < PIECES // 8:
                self._others[marks] = got
        return got

    def _new(self, piece: str) -> bytes:
        """A piece, written without its space, that isn't known yet."""
        word = piece.rstrip(_ENDS)
        if word.isascii() and word.isalpha():
            if len(word) == len(piece):
                return self._letters(word)
            return (self._pieces.get(word) or self._letters(word)) + self._mark(piece[len(word) :])
        simple = _SIMPLE.fullmatch(piece)
        if simple is None:
            return self._whole([" " + piece])[0]
        word, marks, word2, marks2 = simple.groups()
        out = self._pieces.get(word) or self._word(" " + word)
        if marks:
            out += self._mark(marks)
        if word2:
            out += self._mark("\n") + self._word(word2) + (self._mark(marks2) if marks2 else b"")
        return out

    def encode(self, text: str) -> bytes:
        if self._split is None:
            return self.encode_plain(text)
        parts = self._split.split(text) if any(s in text for s in self.special) else [text]
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if i % 2 else self.encode_plain(p) for i, p in enumerate(parts))

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if not text:
            return b""
        head, *pieces = text.split(" ")
        known = self._pieces
        got = list(map(known.get, pieces))
        found: dict[str, bytes] = {}
        at = -1
        # Only the places of unknown pieces are gone through.
        for _ in range(got.count(None)):
            at = got.index(None, at + 1)
            piece = pieces[at]
            ids = found.get(piece)
            if ids is None:
                if not piece or piece[0].isspace():
                    return b"".join(map(self._other, _CUT.split(text)))
                ids = found[piece] = self._new(piece)
            got[at] = ids
        self._keep(found)
        return (self._other(head) if head else b"") + b"".join(got)

    def _keep(self, found: dict[str, bytes]) -> None:
        known = self._pieces
        if found:
            if len(known) < PIECES:
                known.update(found if max(map(len, found)) <= PIECE_CHARS else {p: ids for p, ids in found.items() if len(p) <= PIECE_CHARS})
            else:
                # The texts may have changed since the table filled up: it starts anew after as many misses as it has places.
                self._missed += len(found)
                if self._missed > PIECES:
                    known.clear()
                    self._missed = 0

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """What ``encode`` gives, as integers, for each of many texts. Nulls are empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(texts):
            end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + TOGETHER, "right")))
            yield from self._together(texts.slice(start, end - start))
            start = end

    def _together(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The pieces of all texts are numbered in one pass and only different ones are looked up; ids are gathered by number."""
        parts = pc.split_pattern(texts, " ")
        offsets = np.asarray(parts.offsets).astype(np.int64)
        offsets -= offsets[0]
        flat = parts.flatten()
        numbered = flat.dictionary_encode()
        # No piece holds a space, so one long text can be split into them, which is faster than asking for each.
        every = pa.ListArray.from_arrays(pa.array([0, len(numbered.dictionary)], pa.int32()), numbered.dictionary)
        which, pieces = numbered.indices.to_numpy().astype(np.int64), pc.binary_join(every, " ")[0].as_py().split(" ")
        heads = offsets[:-1]
        inner = np.ones(len(which), bool)
        inner[heads] = False
        used, odd = np.zeros(len(pieces), bool), np.zeros(len(pieces), bool)
        used[which[inner]] = True
        got: list[bytes] = [ids or b"" for ids in map(self._pieces.get, pieces)]
        unknown = np.fromiter(map(len, got), np.int64, len(got)) == 0
        found: dict[str, bytes] = {}
        for k in np.flatnonzero(unknown & used).tolist():
            piece = pieces[k]
            if not piece or piece[0].isspace():
                odd[k] = True
            else:
                got[k] = found[piece] = self._new(piece)
        self._keep(found)
        # Texts with white space after a space, or with special tokens, are cut otherwise.
        alone = np.zeros(len(texts), bool)
        alone[np.repeat(np.arange(len(texts)), np.diff(offsets))[inner & odd[which]]] = True
        for token in self.special:
            alone |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        which[heads] = len(got) + np.arange(len(texts))
        got += [b"" if one or not head else self._other(head) for head, one in zip(flat.take(pa.array(heads)).to_pylist(), alone.tolist(), strict=True)]
        lengths = np.fromiter(map(len, got), np.int64, len(got)) // 4
        pool, first = np.frombuffer(b"".join(got), "<u4"), np.cumsum(lengths) - lengths
        each = lengths[which]
        ends = np.cumsum(each)
        ids = pool[np.repeat(first[which] - (ends - each), each) + np.arange(each.sum())]
        last = 0
        for k, (end, one) in enumerate(zip(ends[offsets[1:] - 1].tolist(), alone.tolist(), strict=True)):
            yield np.frombuffer(self.encode(texts[k].as_py()), "<u4") if one else ids[last:end]
            last = end

    def token_bytes(self) -> list[bytes]:
        """The bytes each id stands for. Byte-level vocabularies write bytes as printable characters."""
        if self._bytes is None:
            back = {c: b for b, c in _CHARS.items()}
            vocabulary = self.library.get_vocab(with_added_tokens=True)
            out = [b""] * (max(vocabulary.values()) + 1)
            for token, i in vocabulary.items():
                out[i] = token.encode() if token in self.special else bytes(back[c] for c in token)
            self._bytes = out
        return self._bytes

    def decode(self, ids: bytes) -> str:
        table = self.token_bytes()
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer file."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
