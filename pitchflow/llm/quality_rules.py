"""Line-first cleaning: rules judge single lines, then the document by what is left.

Each line of the whole text with at least one word is held against the rules
below. Failing lines go; a document whose lost lines held more than
``MAX_LOST`` of its word characters is rejected. Before that two plain rules on
the document apply: too few words, too many words in repeated 3-word windows.

With ``Limits(ends=True)``, as in the query, lines are judged by their ends too:
a line of ``short_words`` words or more must end with a terminal mark, and of
shorter ones no ``run`` or more in a row may go without, since unended short
lines are headings next to prose but a menu among themselves.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return. Null texts have no words and fail. Rows are
independent, so repeated rows get equal results and nothing is shuffled; a text
is held alone, so memory is bounded by the longest one. Extra columns stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.llm.common import fresh, quoted

MIN_WORDS = 50
MAX_LOST = 0.5

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?:;\"'”’)…。！？"
NAVIGATION = ("|", "»", "›", " > ", "•")
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "use cookies", "enable javascript",
    "subscribe to our newsletter", "click here", "sign up now", "log in to", "skip to content", "back to top", "powered by",
    "share on facebook", "share on twitter", "lorem ipsum",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "verwendet cookies", "zum newsletter anmelden", "nach oben",
    "tous droits réservés", "politique de confidentialité", "mentions légales", "utilise des cookies", "haut de page",
    "todos los derechos reservados", "política de privacidad", "aviso legal", "utiliza cookies", "volver arriba",
)
_SHOUT = re.compile(r"[!?]{2,}")


@dataclass(frozen=True)
class Limits:
    """``ends``: lines are judged by their ends. ``short_words``: a line of fewer words needs no end mark, unless it is one of
    ``run`` such lines in a row. ``shouts``: share of words before ``!!``. ``upper``: share of letters in upper case.
    ``symbols``: share of characters."""

    min_words: int = MIN_WORDS
    max_lost: float = MAX_LOST
    separators: int = 3
    shouts: float = 0.2
    upper: float = 0.6
    symbols: float = 0.1
    long_unended: int = 200
    ends: bool = False
    short_words: int = 10
    run: int = 3


def _unended(line: str) -> bool:
    return line.rstrip(" \t\n\x0b\x0c\r")[-1] not in TERMINAL


def menu_lines(lines: list[str], limits: Limits) -> set[int]:
    """The places of lines that stand in a run of short lines without end marks; lines without words don't end a run."""
    out: set[int] = set()
    held: list[int] = []
    for i, line in enumerate([*lines, None]):
        words = line.encode().split() if line is not None else []
        if line is not None and not words:
            continue
        if words and len(words) < limits.short_words and _unended(line):
            held.append(i)
            continue
        if len(held) >= limits.run:
            out.update(held)
        held = []
    return out


def line_fault(line: str, words: list[bytes], limits: Limits = Limits()) -> str | None:
    """The first rule the line fails, or None."""
    n = len(words)
    if max(line.count(mark) for mark in NAVIGATION) >= limits.separators:
        return "navigation"
    low = line.lower()
    if n <= 40 and any(phrase in low for phrase in BOILERPLATE):
        return "boilerplate"
    if n >= 4 and len(_SHOUT.findall(line)) > limits.shouts * n:
        return "punctuation"
    if n > limits.long_unended and not any(mark in line for mark in TERMINAL):
        return "punctuation"
    if limits.ends and n >= limits.short_words and _unended(line):
        return "punctuation"
    if sum(map(line.count, SYMBOLS)) > limits.symbols * len(line):
        return "symbols"
    letters = len(line) - line.count(" ")
    # Upper case letters; characters that merely count as such, like Roman numerals, are looked at only where it matters.
    if n >= 4 and sum(map(str.isupper, line)) > limits.upper * letters and sum(unicodedata.category(c) == "Lu" for c in line) > limits.upper * letters:
        return "upper case"
    return None


def measure(text: str | None, limits: Limits = Limits()) -> dict:
    """Counts, verdicts and the cleaned text of one document."""
    text = text or ""
    words = text.encode().split()  # bytes split at just the six characters that separate words
    n = len(words)
    triples: dict[tuple, int] = {}
    for t in zip(words, words[1:], words[2:], strict=False):
        triples[t] = triples.get(t, 0) + 1
    repeated, free = 0, 0
    if len(triples) < n - 2:
        for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)):
            if triples[t] > 1:
                repeated += i + 3 - max(i, free)
                free = i + 3
    seen, same, kept, lost, faults = set(), 0, [], 0, 0
    lines = text.split("\n")
    menus = menu_lines(lines, limits) if limits.ends else ()
    for i, line in enumerate(lines):
        own = line.encode().split()
        if not own:
            kept.append(line)
            continue
        same += line in seen
        seen.add(line)
        if i in menus or line_fault(line, own, limits):
            faults += 1
            lost += sum(map(len, own))
        else:
            kept.append(line)
    size = sum(map(len, words))
    failed = n < limits.min_words or 100 * repeated > 50 * n
    return {
        "n_words": n, "word_chars": len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": same, "n_repeat_words": repeated, "base_failed": failed, "n_bad_lines": faults,
        "lost": lost / size if size else 0.0, "kept": not failed and lost <= limits.max_lost * size, "clean_text": "\n".join(kept),
    }


_OUT = [
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()), ("n_bad_lines", T.LongType()), ("lost", T.DoubleType()),
    ("kept", T.BooleanType()), ("clean_text", T.StringType()),
]


def clean_lines(docs: DataFrame, text: str = "text", limits: Limits = Limits(), clean_text: bool = True) -> DataFrame:
    """``docs`` with the measures, the verdict ``kept`` and, if wanted, ``clean_text``. Columns of these names are replaced."""
    out = [(n, k) for n, k in _OUT if clean_text or n != "clean_text"]
    names = {n for n, _ in _OUT}
    passed = [n for n in docs.columns if n not in names and (clean_text or n != text)]
    schema = T.StructType([*[docs.schema[n] for n in passed], *[T.StructField(n, k) for n, k in out]])
    arrow = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64(), T.StringType(): pa.string()}

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py(), limits) for t in batch.column(len(passed))]
            columns = [pa.array([r[n] for r in rows], arrow[k]) for n, k in out]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed)], *columns], names=[*passed, *[n for n, _ in out]])

    return docs.select(*[F.col(quoted(n)) for n in passed], F.col(quoted(text)).alias(fresh(docs, "_body")[0])).mapInArrow(judged, schema)
