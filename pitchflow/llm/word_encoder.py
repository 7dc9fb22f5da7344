"""Token ids of whole texts for tokenizers that drop white space, a record batch at a time.

Such a tokenizer gives every stretch between white space the ids that the same
stretch gets alone, so a text's ids are those of its stretches put together.
Texts are cut at spaces and line ends (other white space stays inside a stretch
and goes to the library as it is); all stretches of a batch are numbered in one
pass, and the ids are gathered by index, so no Python code runs per word, only
per stretch not seen before. Of these, a word of Latin letters with marks behind
it goes to the library's model as its pre-tokenizer would hand it over, the word
and the marks each once; all others go to the library together.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pitchflow.llm.tokens import _CHARS, _LETTERS

#: A worker's table of stretches starts anew when it holds so many stretches or ids.
STRETCHES, IDS = 400_000, 4_000_000

_LATIN, _MARKS = re.compile(_LETTERS).fullmatch, ".,;:!?"


class WordEncoder:
    """``encode`` gives the ids of many texts as one array, and where each text's ids end."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if self._ids([" a\n b "])[0] != sum(self._ids(["a", "b"]), []):
            raise ValueError("the tokenizer does not drop white space")
        if any(" " in t.content or "\n" in t.content for t in self.library.get_added_tokens_decoder().values()):
            raise ValueError("a token of the tokenizer's own holds white space")
        self._model = self.library.model.tokenize
        self._clear()

    def _clear(self) -> None:
        self._known: dict[str, int] = {"": 0}
        self._parts: dict[str, bytes] = {}  # each is part of a stretch, so these are no more than the stretches and their marks
        # Where the ids of each known stretch lie in the pool.
        self._start, self._length, self._pool, self._filled = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32), 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        """A word in lower case, or marks, as the pre-tokenizer gives it to the model."""
        text = part if part.isascii() else part.encode().decode("latin-1").translate(_CHARS)
        got = array("I", [t.id for t in self._model(text)]).tobytes()
        self._parts[part] = got
        return got

    def _learn(self, stretches: list[str]) -> None:
        got: list[bytes] = []
        others, known = [], self._parts.get
        for s in stretches:
            word = s.rstrip(_MARKS)
            if not (word.isascii() and word.isalpha()) and not _LATIN(word):
                others.append(len(got))
                got.append(b"")
                continue
            low = word.lower()
            ids = known(low) or self._part(low)
            if len(word) < len(s):
                marks = s[len(word) :]
                ids += known(marks) or self._part(marks)
            got.append(ids)
        for k, ids in zip(others, self._ids([stretches[k] for k in others]), strict=True):
            got[k] = array("I", ids).tobytes()
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        first, n = len(self._known), int(sizes.sum())
        self._known.update(zip(stretches, range(first, first + len(stretches)), strict=True))

        def room(values: np.ndarray, size: int) -> np.ndarray:
            return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])

        self._start, self._length = room(self._start, first + len(got)), room(self._length, first + len(got))
        self._pool = room(self._pool, self._filled + n)
        self._start[first : first + len(got)] = self._filled + np.cumsum(sizes) - sizes
        self._length[first : first + len(got)] = sizes
        self._pool[self._filled : self._filled + n] = np.frombuffer(b"".join(got), np.uint32)
        self._filled += n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: text ``i`` has ``ids[ends[i - 1] : ends[i]]``. Null texts are empty."""
        if len(self._known) > STRETCHES or self._filled > IDS:
            self._clear()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        numbered = parts.flatten().dictionary_encode()
        # No stretch holds a line end, so one long text can be split into them, which is faster than asking for each.
        every = pa.ListArray.from_arrays(pa.array([0, len(numbered.dictionary)], pa.int32()), numbered.dictionary)
        stretches = pc.binary_join(every, "\n")[0].as_py().split("\n") if len(numbered.dictionary) else []
        known = self._known
        new = [s for s in stretches if s not in known]
        if new:
            self._learn(new)
        at = np.fromiter(map(known.__getitem__, stretches), np.int64, len(stretches))
        which = at[numbered.indices.to_numpy()]
        sizes = self._length[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._pool[np.repeat(self._start[which] - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.asarray(parts.offsets)[1:] - parts.offsets[0].as_py()]
        return ids, bounds


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per worker process and tokenizer file."""
    return WordEncoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
