"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts texts where their content says so, so equal
passages fall into equal chunks wherever they stand. A worker encodes a chunk
once and keeps its ids, a bounded number of bytes of them; documents that share
it take them from there. Where two chunks meet, merging may have gone
differently, so the join is encoded anew from a place in the left chunk to one
in the right, and the window widens until its first and last piece come out as
in the chunks themselves. The ids are exactly those of the whole text.

Nothing is shuffled: to move a chunk to another task would cost more than to
encode it there, so reuse is per worker. Texts are independent rows; memory is
bounded by the chunk table and the longest text.

Null texts are empty and have no ids. Special tokens written out in a text are
taken for special tokens, as the library does. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.llm.common import fresh, lean, quoted
from pitchflow.llm.tokens import Encoder, default_path, encoder

#: Bytes the rolling hash sees, a power of two, and the average length of a chunk, another.
WINDOW, AVERAGE = 32, 2048
#: Bytes of chunks and ids one worker keeps.
KEEP = 64 << 20
#: Bytes of ids that a task holds before it passes rows on.
HELD = 4 << 20

_FACTOR = 0x9E3779B1
_CUT = re.compile(r" (?=\S)")


def chunks(text: bytes, average: int = AVERAGE) -> list[bytes]:
    """UTF-8 ``text`` cut behind every window whose hash says so, never inside a character."""
    if len(text) <= WINDOW:
        return [text] if text else []
    data = np.frombuffer(text, np.uint8)
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(15)
    step, factor = 1, _FACTOR
    while step < WINDOW:  # the hash of 2n bytes from those of two times n
        h[step:] += (h[:-step] * np.uint32(factor)).copy()
        step, factor = 2 * step, factor * factor & 0xFFFFFFFF
    ends = np.flatnonzero((h[WINDOW - 1 :] >> np.uint32(7)) % np.uint32(average) == 0) + WINDOW
    ends = ends[ends < len(text)]
    inside = (data[ends] & 0xC0) == 0x80
    while inside.any():
        ends = ends + inside
        ends = ends[ends < len(text)]
        inside = (data[ends] & 0xC0) == 0x80
    cuts = [0, *np.unique(ends).tolist(), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class ChunkEncoder:
    """Encodes texts by chunks; keeps the least recently used chunks' ids within ``keep`` bytes."""

    def __init__(self, base: Encoder, keep: int = KEEP):
        self.base, self.keep, self.size = base, keep, 0
        self.known: OrderedDict[bytes, tuple] = OrderedDict()
        self.lengths = np.array([len(b) for b in base.token_bytes()])
        self.encoded = self.reused = 0

    def forget(self) -> None:
        """Empties the tables of known chunks and pieces."""
        self.known.clear()
        self.size = 0
        self.base.forget()

    def _chunk(self, chunk: bytes) -> tuple:
        """The chunk's text, ids, and the cuts of its text with their places in the ids: the first two and the last two."""
        got = self.known.get(chunk)
        if got is not None:
            self.known.move_to_end(chunk)
            self.reused += 1
            return got
        text = chunk.decode()
        ids = np.frombuffer(self.base.encode_plain(text), "<u4")
        cuts = [m.start() for m in _CUT.finditer(text)]
        if len(cuts) < 4:
            got = (text, ids, None)
        else:
            ends = np.cumsum(self.lengths[ids])
            at = [cuts[0], cuts[1], cuts[-2], cuts[-1]]
            byte = [len(text[:c].encode()) for c in at]
            place = [int(np.searchsorted(ends, b)) + 1 if b else 0 for b in byte]
            # A cut counts only if a token ends there.
            exact = all(b == 0 or (p <= len(ends) and ends[p - 1] == b) for b, p in zip(byte, place, strict=True))
            got = (text, ids, (at, place) if exact else None)
        self.encoded += 1
        self.known[chunk] = got
        self.size += 3 * len(chunk) + 300
        while self.size > self.keep:
            old, _ = self.known.popitem(last=False)
            self.size -= 3 * len(old) + 300
        return got

    def _plain(self, text: str) -> bytes:
        out: list[bytes] = []
        left: tuple | None = None  # the chunk on the left of the next join, whose ids up to its last but one cut are out
        open_text = ""  # what follows that cut, or all text so far if there was none
        for chunk in chunks(text.encode()):
            right = self._chunk(chunk)
            if right[2] is None:
                open_text += right[0]
                continue
            at, place = right[2]
            window = np.frombuffer(self.base.encode_plain(open_text + right[0][: at[1]]), "<u4")
            ahead = left[1][left[2][1][2] : left[2][1][3]] if left else window[:0]
            behind = right[1][place[0] : place[1]]
            agree = len(window) >= len(ahead) + len(behind) and np.array_equal(window[: len(ahead)], ahead)
            if agree and np.array_equal(window[len(window) - len(behind) :], behind):
                out += [window.tobytes(), right[1][place[1] : place[2]].tobytes()]
                open_text, left = right[0][at[2] :], right
            else:  # wider: the chunk joins the open text
                open_text += right[0]
        out.append(self.base.encode_plain(open_text))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of the whole text."""
        special = self.base.special
        if not any(s in text for s in special):
            return self._plain(text)
        parts = re.split("(" + "|".join(map(re.escape, special)) + ")", text)
        return b"".join(np.array([special[p]], "<u4").tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts))


_workers: dict[str, ChunkEncoder] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    """One per worker process and tokenizer file."""
    if path not in _workers:
        _workers[path] = ChunkEncoder(encoder(path))
    return _workers[path]


_KINDS = {
    "n_tokens": (T.LongType(), pa.int64()), "ids": (T.BinaryType(), pa.binary()), "decoded": (T.StringType(), pa.string()),
    "ids_sha256": (T.StringType(), pa.string()), "decoded_sha256": (T.StringType(), pa.string()),
}


def transcode(
    docs: DataFrame, outputs: Sequence[str] = ("n_tokens", "ids", "decoded"), text: str = "text", path: str | None = None, keep_text: bool = False,
    release: bool = False,
) -> DataFrame:
    """``docs`` with the chosen ``outputs``: ids of every whole text, their number, the text decoded from them, and digests of both.

    ``release`` empties a worker's tables at the end of each task: what comes after in the same workers has their memory.
    """
    path = path or default_path()
    passed = [n for n in docs.columns if n not in outputs and (keep_text or n != text)]
    schema = T.StructType([*[docs.schema[n] for n in passed], *[T.StructField(n, _KINDS[n][0]) for n in outputs]])
    decodes = any("decoded" in n for n in outputs)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chunk_encoder(path)
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in outputs}
            first = held = 0
            for row, value in enumerate(batch.column(len(passed)), 1):
                ids = own.encode(value.as_py() or "")
                held += len(ids)
                back = own.base.decode(ids) if decodes else ""
                made = {
                    "n_tokens": lambda ids=ids: len(ids) // 4, "ids": lambda ids=ids: ids, "decoded": lambda back=back: back,
                    "ids_sha256": lambda ids=ids: hashlib.sha256(ids).hexdigest(), "decoded_sha256": lambda back=back: hashlib.sha256(back.encode()).hexdigest(),
                }
                for n in outputs:
                    columns[n].append(made[n]())
                if held >= HELD or row == batch.num_rows:
                    arrays = [pa.array(columns[n], _KINDS[n][1]) for n in outputs]
                    yield pa.RecordBatch.from_arrays([*(x.slice(first, row - first) for x in batch.columns[: len(passed)]), *arrays], names=[*passed, *outputs])
                    columns = {n: [] for n in outputs}
                    first, held = row, 0
        if release:
            own.forget()

    return docs.select(*[F.col(quoted(n)) for n in passed], F.col(quoted(text)).alias(fresh(docs, "_body")[0])).mapInArrow(lean(coded) if release else coded, schema)
