"""Spelling variants of words, found through a reduced alphabet.

Two words are near if one inserted, deleted or replaced letter makes one of the
other. Letters are put into a few classes of about equal use; a word's reduced
form names the class of each of its letters. Words that are near have reduced
forms that are equal or one edit apart, and there are few symbols to insert or
to put in another's place, so the whole one-edit neighbourhood of a reduced
form can be written down and joined with the reduced vocabulary. What meets is
checked on the words themselves.

A pair would meet from both sides. The side that is longer, or has the lesser
symbol, writes it: deletions, replacements by greater symbols and the form
itself; insertions and lesser symbols are these pairs seen from the other word.
So each pair is met once, and nothing else is left out.

A reduced form travels as a number in the base of the alphabet. Numbers of
forms of up to some twenty letters are exact, longer ones run over and may
coincide, which the check sorts out. The alphabet grows with the eighth root of
the vocabulary, so that few words share a form at any size: on 367,521 words
the most frequent form has 27 words at six symbols. A form's words meet
through the join's key, whose frequent values adaptive execution splits.

Of a word's near words the most frequent one is its form, if it is much more
frequent; following forms leads to the root. Each step multiplies the count, so
a path of forms has at most 18 steps and doubling it five rounds.

Null texts have no words; a null id counts as an empty one; repeated rows count
as often as they stand. Very long runs of letters are words like others: their
neighbourhood grows with their length and travels as numbers. Ties of counts go
to the least word. No text gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import stored

#: Different words held by a task before they are passed on.
HELD = 200_000
#: Positions of reduced words worked at once.
TOGETHER = 1 << 18


def count_words(docs: DataFrame, min_chars: int = 7, min_count: int = 2, slips: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(word, n)``: maximal runs of Latin letters, A-Z lower-cased, of ``min_chars`` letters and ``min_count`` occurrences.

    ``slips`` puts spelling errors in, to have some to find: a run loses one
    letter in those documents where ``slips`` divides the hash of id and run.
    """
    long_runs = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}").findall
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text")).where("text IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return batch

        for batch in batches:
            for doc, value in zip(batch["doc"], batch["text"], strict=True):
                # Bytes lower-case A-Z only.
                runs = Counter(long_runs(value.as_buffer().to_pybytes().lower().decode()))
                if not slips:
                    held.update(runs)
                else:
                    start = zlib.crc32(f"{doc.as_py()}:".encode())
                    for run, n in runs.items():
                        h = zlib.crc32(run.encode(), start)
                        if h % slips == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_chars:
                                continue
                        held[run] += n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    words = rows.mapInArrow(counted, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_classes(words: DataFrame, symbols: int) -> dict[int, int]:
    """Code point to class, 1 to ``symbols``: letters by falling use, each to the class least used so far.

    One row per letter is collected, so the alphabet bounds it.
    """

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: Counter = Counter()
        for batch in batches:
            points, n = np.unique(_points(batch["word"].to_pylist()), return_counts=True)
            used.update(dict(zip(points.tolist(), n.tolist(), strict=True)))
        yield pa.record_batch({"letter": pa.array(used.keys(), pa.int64()), "n": pa.array(used.values(), pa.int64())})

    use = words.select("word").mapInArrow(letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    load, classes = [0] * symbols, {}
    for r in sorted(use, key=lambda r: (-r.n, r.letter)):
        least = min(range(symbols), key=lambda k: (load[k], k))
        classes[r.letter] = least + 1
        load[least] += r.n
    return classes


def _points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)


class Reduced:
    """Reduced words of one length as numbers, and their neighbourhoods. All arithmetic is modulo 2^64."""

    def __init__(self, classes: dict[int, int], symbols: int):
        self.symbols = symbols
        self.base = symbols + 1 + symbols % 2  # odd, so no digit is ever lost
        self.table = np.zeros(max(classes, default=0) + 1, np.uint64)
        self.table[list(classes)] = list(classes.values())

    def digits(self, words: list[str], length: int) -> np.ndarray:
        return self.table[_points(words)].reshape(len(words), length)

    def _powers(self, length: int) -> np.ndarray:
        return np.concatenate([[1], np.cumprod(np.full(max(length - 1, 0), self.base, np.uint64))]).astype(np.uint64)[:length]

    def numbers(self, digits: np.ndarray) -> np.ndarray:
        return (digits * self._powers(digits.shape[1])).sum(axis=1, dtype=np.uint64)

    def neighbours(self, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, number)``: replacements by greater symbols, and deletions, each once."""
        m, length = digits.shape
        powers, own = self._powers(length), self.numbers(digits)
        symbols = np.arange(1, self.symbols + 1, dtype=np.uint64)
        row, place, symbol = np.nonzero(digits[:, :, None] < symbols)
        replaced = own[row] + (symbols[symbol] - digits[row, place]) * powers[place]
        # Left of the deleted letter all stays, right of it all moves down by one place.
        stays = np.cumsum(digits * powers, axis=1, dtype=np.uint64) - digits * powers
        moved = np.concatenate([digits[:, 1:] * powers[:-1], np.zeros((m, 1), np.uint64)], axis=1)
        after = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        last = np.concatenate([digits[:, 1:] != digits[:, :-1], np.ones((m, 1), bool)], axis=1)  # of a run of one symbol
        row2, place2 = np.nonzero(last)
        return np.concatenate([row, row2]), np.concatenate([replaced, (stays + after)[row2, place2]])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """Rows of the same length together, few enough to work at once."""
    words = batch["word"].to_pylist()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        rows, step = np.flatnonzero(lengths == length), max(1, TOGETHER // max(length, 1))
        for k in range(0, len(rows), step):
            some = rows[k : k + step]
            yield length, some, [words[i] for i in some.tolist()]


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """``(id, word, n, id2, word2, n2)``: every two near words once. ``words`` has ``id, word, n``, ids and words unique."""
    classes = letter_classes(words, symbols)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Reduced(classes, symbols)
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.uint64)
            for length, rows, some in _by_length(batch):
                keys[rows] = tool.numbers(tool.digits(some, length))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns], names=["key", *batch.schema.names])

    def neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Reduced(classes, symbols)
        for batch in batches:
            ids = batch["id"].to_numpy()
            for length, rows, some in _by_length(batch):
                digits = tool.digits(some, length)
                row, keys = tool.neighbours(digits)
                own = tool.numbers(digits)
                yield pa.record_batch({
                    "key": pa.array(np.concatenate([own, keys]).view(np.int64)), "id": pa.array(np.concatenate([ids[rows], ids[rows][row]])),
                    "same": pa.array(np.arange(len(own) + len(keys)) < len(own)),
                })

    vocabulary = words.select("id", "word", "n")
    reduced = vocabulary.mapInArrow(keyed, "key long, id2 long, word2 string, n2 long")
    met = vocabulary.select("id", "word").mapInArrow(neighbourhoods, "key long, id long, same boolean").join(reduced, "key")
    met = met.where("NOT same OR id < id2").select("id", "id2", "word2", "n2")
    both = met.join(vocabulary, "id")
    return both.where(F.levenshtein("word", "word2", 1) == 1).select("id", "word", "n", "id2", "word2", "n2")


def symbols_for(words: int) -> int:
    return max(4, math.ceil(words ** (1 / 8)))


def group_variants(words: DataFrame, ratio: int = 10, symbols: int | None = None) -> DataFrame:
    """Per word ``word, form, root, n, n_near, form_n``; ``words`` has ``word`` (unique) and ``n``."""
    words = stored(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    pairs = near_pairs(words, symbols or symbols_for(words.count()))

    def side(me: str, other: str) -> str:
        # Only a much more frequent word can become the form; the most frequent and then least one does.
        much = f"if(n{other} >= {ratio} * n{me}, named_struct('less', -n{other}, 'word', word{other}), NULL)"
        return f"named_struct('id', id{me}, 'best', {much})"

    sides = pairs.select(F.explode(F.expr(f"array({side('', '2')}, {side('2', '')})")).alias("side")).select("side.*")
    near = sides.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    grouped = words.join(near, "id", "left").selectExpr("word", "best.word AS form", "n", "coalesce(n_near, 0L) AS n_near", "-best.less AS form_n")
    grouped = stored(grouped)
    roots = _roots(grouped.where("form IS NOT NULL").select("word", "form"))
    return grouped.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: every round follows the way found so far twice, until no way gets longer."""
    ways = stored(forms.selectExpr("word", "form AS root"))
    while True:
        further = ways.selectExpr("word AS root", "root AS further")
        longer = stored(ways.join(further, "root", "left").selectExpr("word", "coalesce(further, root) AS root", "further IS NOT NULL AS longer"))
        ways = longer.select("word", "root")
        if longer.where("longer").isEmpty():
            return ways


def variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, ratio: int = 10, slips: int = 0) -> DataFrame:
    """``group_variants`` of the words of ``docs``."""
    return group_variants(count_words(docs, min_chars, min_count, slips), ratio)
