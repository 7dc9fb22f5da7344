"""Phrases whose words stand together more often than alone, from FM-indexes of word ids.

Each task gathers texts of one language into shards of bounded size, numbers
the words of a shard and builds an index of it in both directions. A phrase is
an interval of the index; a step to the left or to the right turns the
intervals of all phrases of ``d`` words into those of ``d + 1`` words at once,
keeping the forward and the backward interval in step. Phrases are not longer
than ``max_words``, so suffixes are sorted that far only, which is all a step
looks at. A shard passes on each phrase of up to ``max_words - 1`` words (found
by steps to the left) with its count and the words that follow it (found by a
step to the right) with theirs.

The counts are summed across shards by the leading words: rows of one
beginning meet in a partition, one for each shard that has it. A beginning
below the threshold takes its continuations with it, before these are taken
apart. From then on there are only phrases that reach the threshold: scores,
the test against longer phrases, and the ranking are joins and sums of these,
and the ranking keeps a task's best before anything is shuffled.

Scores are exact: counts are multiplied as decimals of 38 digits.

A null text is empty; a null language is ``und``. Texts of any length are
worked whole; a longer text than a shard is a shard of its own. Repeated rows
count as often as they stand; ties of score and count go by the phrase. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import stored

#: Bytes of text in a shard.
SHARD = 7 << 20
UNKNOWN = "und"
#: Rows of a batch that a shard passes on.
ROWS = 50_000

# A-Z become a-z, what ends a piece becomes a line end, a tab becomes a space.
_PLAIN = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass
class Intervals:
    """Phrases of one length by their rows in both sorted orders, by rising forward rows."""

    words: int
    first: np.ndarray  # in the forward order
    back: np.ndarray  # in the backward order
    size: np.ndarray
    parent: np.ndarray  # which phrase of the step before
    symbol: np.ndarray  # the word added to it


class FMIndex:
    """Both directions of an FM-index over word ids from 1 on; 0 stands between pieces. Sorted as deep as phrases get."""

    def __init__(self, ids: np.ndarray, depth: int):
        # With a break at either end each word has as many rows before it as it has places.
        pad = np.zeros(depth + 1, np.int64)
        self.depth, self.padded = depth, np.concatenate([pad, ids, pad])
        self.at = np.arange(depth, depth + len(ids) + 2)
        self.forward, self.backward = self._sorted(1), self._sorted(-1)
        self.before, self.after = self.padded[self.forward - 1], self.padded[self.backward + 1]

    def _sorted(self, way: int) -> np.ndarray:
        """Positions by the words from there on, in this direction."""
        order = self.at
        for k in reversed(range(self.depth)):
            order = order[self._ranked(self.padded[order + way * k])[1]]
        return order

    @staticmethod
    def _ranked(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols in order, and the rows they stand in, equal ones by row: the place of a row is its LF mapping."""
        packed = np.sort(symbols << 32 | np.arange(len(symbols)))
        return packed >> 32, packed & 0xFFFFFFFF

    def single(self) -> Intervals:
        symbols = self.padded[self.forward]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if len(symbols) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([first, [len(symbols)]]))
        word = symbols[first]
        # Both orders begin with the word itself, so its rows are the same ones.
        return Intervals(1, *(x[word > 0] for x in (first, first, size, word, word)))

    def extend(self, phrases: Intervals, left: bool) -> Intervals:
        """All phrases with one more word before (or behind) them."""
        own, other, symbols = (phrases.first, phrases.back, self.before) if left else (phrases.back, phrases.first, self.after)
        of = np.full(len(symbols), -1, np.int64)
        rows = np.repeat(own - (np.cumsum(phrases.size) - phrases.size), phrases.size) + np.arange(int(phrases.size.sum()))
        of[rows] = np.repeat(np.arange(len(own)), phrases.size)
        del rows
        symbol, row = self._ranked(symbols)
        parent = of[row]
        del of, row
        place = np.flatnonzero((symbol > 0) & (parent >= 0))
        symbol, parent = symbol[place], parent[place]
        # By symbol, then by row: the rows of a phrase with one symbol stand together.
        new = np.flatnonzero(np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (parent[1:] != parent[:-1])])) if len(symbol) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([new, [len(symbol)]]))
        first, symbol, parent = place[new], symbol[new], parent[new]
        # In the other order a phrase's rows go by the added word; those with a break there come first.
        by = np.lexsort((symbol, parent))
        taken = np.cumsum(size[by])
        in_parent = np.bincount(parent, size, len(own)).astype(np.int64)
        begins = np.cumsum(in_parent) - in_parent
        far = np.empty(len(by), np.int64)
        far[by] = taken - size[by] - begins[parent[by]]
        far += other[parent] + (phrases.size - in_parent)[parent]
        fore, back = (first, far) if left else (far, first)
        turn = np.argsort(fore)
        return Intervals(phrases.words + 1, *(x[turn] for x in (fore, back, size, parent, symbol)))


def _heads(index: FMIndex, phrases: Intervals, words: pa.Array) -> pa.Array:
    """The phrases as text, read at their first row."""
    at = index.forward[phrases.first]
    columns = [words.take(pa.array(index.padded[at + k])) for k in range(phrases.words)]
    return columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")


def _with_counts(words: pa.Array, n: np.ndarray) -> pa.Array:
    """``word`` for one occurrence, else ``word<tab>n``."""
    counted = pc.binary_join_element_wise(words, pa.array(n).cast(pa.string()).cast(pa.binary()), b"\t")
    return pc.if_else(pa.array(n > 1), counted, words)


def shard_counts(texts: list[bytes], max_words: int) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array]]:
    """``(heads, counts, continuations)`` of a shard; the empty head counts all words.

    Continuations are words after a space each, so that taking them apart gives
    an empty word first, which stands for the head itself.
    """
    joined = pa.array([b" \n ".join(texts)], pa.large_binary())
    numbered = pc.split_pattern(joined, b" ").flatten().cast(pa.binary()).dictionary_encode()
    words = numbered.dictionary
    names = words.to_pylist()
    # Breaks become 0, empty words go.
    number = np.arange(1, len(names) + 1)
    if b"\n" in names:
        number[names.index(b"\n")] = 0
    found = numbered.indices.to_numpy()
    ids = number[found if b"" not in names else found[found != names.index(b"")]]
    del numbered, joined, found
    words = pa.concat_arrays([pa.array([b""], pa.binary()), words])
    yield pa.array([b""], pa.binary()), np.array([np.count_nonzero(ids)]), pa.array([b""], pa.binary())
    index = FMIndex(ids, max(1, max_words - 1))
    phrases = index.single()
    for k in range(1, max_words):
        if k > 1:
            phrases = index.extend(phrases, left=True)
        heads = _heads(index, phrases, words)
        if k < max_words - 1:
            yield heads, phrases.size, pa.array([b""] * len(heads), pa.binary())
            continue
        longer = index.extend(phrases, left=False)
        turn = np.lexsort((longer.symbol, longer.parent))
        n_own = np.bincount(longer.parent, minlength=len(heads))
        items = _with_counts(words.take(pa.array(longer.symbol[turn])), longer.size[turn])
        # Each head's list begins with the empty word.
        ends = np.cumsum(n_own + 1)
        places = np.ones(int(ends[-1]) if len(ends) else 0, bool)
        places[ends - n_own - 1] = False
        spread = np.where(places, np.cumsum(places), 0)
        items = pa.concat_arrays([pa.array([b""], pa.binary()), items]).take(pa.array(spread))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), items)
        yield heads, phrases.size, pc.binary_join(lists, b" ")


def counted(docs: DataFrame, max_words: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, head, n, next)`` of every shard."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def out(lang: str) -> Iterator[pa.RecordBatch]:
            del size[lang]
            for heads, n, tails in shard_counts(held.pop(lang), max_words):
                columns = [heads.cast(pa.string()), pa.array(n.astype(np.int64)), tails.cast(pa.string())]
                for k in range(0, len(n), ROWS):
                    some = [x.slice(k, ROWS) for x in columns]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some[0]), pa.string()), *some], names=["lang", "head", "n", "next"])

        for batch in batches:
            for own, value in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                plain = value.as_buffer().to_pybytes().translate(_PLAIN).replace(b"\n", b" \n ")
                if size.get(own, 0) + len(plain) > SHARD and own in held:
                    yield from out(own)
                held.setdefault(own, []).append(plain)
                size[own] = size.get(own, 0) + len(plain)
                if sum(size.values()) > 2 * SHARD:
                    yield from out(max(size, key=size.get))
        for own in list(held):
            yield from out(own)

    return rows.mapInArrow(shards, "lang string, head string, n long, next string")


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10) -> DataFrame:
    """``(lang, phrase, n_words, f)`` of all phrases of up to ``max_words`` words with ``f >= min_count``.

    The empty phrase, of no words, has a language's number of words.
    """
    rows = counted(docs, max_words).repartition("lang", "head")
    # A phrase is not more frequent than its beginning.
    often = rows.selectExpr("*", "sum(n) OVER (PARTITION BY lang, head) AS total").where(F.col("total") >= min_count)
    each = often.select("lang", "head", "n", F.explode(F.split("next", " ")).alias("item"))
    each = each.selectExpr(
        "lang", "head", "substring_index(item, '\\t', 1) AS word",
        "CASE WHEN item = '' THEN n WHEN instr(item, '\\t') > 0 THEN CAST(substring_index(item, '\\t', -1) AS BIGINT) ELSE 1L END AS n",
    )
    sums = each.groupBy("lang", "head", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    return sums.selectExpr(
        "lang", "if(word = '', head, concat(head, ' ', word)) AS phrase",
        "if(head = '', 0, 1 + length(head) - length(replace(head, ' ', '')) + int(word <> '')) AS n_words", "f",
    )


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, covered: int = 50, best: int = 2000) -> DataFrame:
    """Per language the ``best`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is cut after each of its words into two parts with counts ``l`` and
    ``r``; its score is the least ``floor(1000000 * a * a / (l * r))`` of its
    cuts. Phrases inside a longer one that has ``covered`` hundredths of their
    count are dropped.
    """
    counts = stored(phrase_counts(docs, max_words, min_count))
    parts = counts.where("n_words > 0").select("lang", "phrase", "f")
    found = counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    cuts = found.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, n_words - 1)")).alias("k"))
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", "concat_ws(' ', slice(w, 1, k)) AS head", "concat_ws(' ', slice(w, k + 1, size(w) - k)) AS rest")
    cuts = cuts.join(parts.selectExpr("lang", "phrase AS head", "f AS l"), ["lang", "head"]).join(parts.selectExpr("lang", "phrase AS rest", "f AS r"), ["lang", "rest"])
    exact = "CAST({} AS DECIMAL(38, 0))".format
    score = f"(CAST(1000000 AS DECIMAL(7, 0)) * {exact('a')} * {exact('a')}) DIV ({exact('l')} * {exact('r')})"
    scored = cuts.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "a").agg(F.expr("min(struct(score, k, l, r))").alias("cut"))

    # Every phrase inside a longer one, with the longer one's count; the longest phrases need no such row.
    inside = found.where("n_words > 2").select("lang", "a", "w", F.explode(F.expr("sequence(2, n_words - 1)")).alias("size"))
    inside = inside.select("lang", "a", F.explode(F.expr("transform(sequence(1, size(w) - size + 1), i -> concat_ws(' ', slice(w, i, size)))")).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {covered} * a")
    kept = kept.selectExpr("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = kept.withColumn("rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")).where(F.col("rank") <= best)
    words = counts.where("n_words = 0").selectExpr("lang", "f AS n")  # a row per language
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
