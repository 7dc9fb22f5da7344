"""Packing, spelling variants and collocations against brute force, and their defined results on awkward input."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitchflow.llm import collocations, packing, spelling
from pitchflow.llm.word_encoder import WordEncoder, default_path

SCHEMA = "doc_id long, text string, lang string"
CLASHING = ["id", "word", "n", "key", "head", "next", "part", "nth", "length", "rank", "phrase", "doc", "total", "best"]


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    rng = np.random.default_rng(11)
    words = [f"{a}{b}{c}" for a in ("thou", "andé", "Over") for b in ("rin", "sch", "t") for c in ("ation", "heit", "es", "ß")]
    use = 1 / np.arange(1, len(words) + 1)
    texts = []
    for _ in range(60):
        some = rng.choice(words, int(rng.integers(1, 400)), p=use / use.sum())
        marks = rng.choice([" ", ", ", ". ", "\n", "\t", "  "], len(some), p=[0.7, 0.1, 0.1, 0.04, 0.03, 0.03])
        texts.append("".join(x for pair in zip(some, marks) for x in pair))
    # Misspellings, of rare and frequent words.
    texts += [t.replace("ation", "atoin", 1).replace("heit", "heitt", 2).replace("Overrin", "Oberrin", 1) for t in texts[:30]]
    texts += [None, "", " \n\t ", "one", "x" * 7000, "x" * 7000, "y" + "x" * 6999, "aaaaaaaaa " * 30, "<|endoftext|> it's  2nd\x85x İ", texts[3], " ".join(texts[:40])]
    out = [(i, t, [None, "en", "de", "und", "fr\t"][min(i % 9, 4)]) for i, t in enumerate(texts)]
    return [*out, (7, texts[7], "en"), (None, texts[3], "en"), (None, texts[4], None), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(docs):
    return docs.withColumns({n: F.lit("x") for n in CLASHING})


# --- packing -------------------------------------------------------------------


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Room left in each sequence, document by document."""
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms[rooms.index(min(fitting))] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("capacity", [1, 2, 5, 16, 37, 100])
def test_ranges_are_best_fit_decreasing(capacity):
    rng = np.random.default_rng(capacity)
    for _ in range(40):
        lengths = rng.choice([1, capacity, max(1, capacity // 2), *rng.integers(1, capacity + 1, 6)], int(rng.integers(0, 150))).tolist()
        counts = Counter(lengths)
        ranges, n = packing.best_fit_decreasing(counts, capacity)
        rooms = [capacity] * n
        for length, pieces in sorted(counts.items(), reverse=True):
            own = [r for r in ranges if r.length == length]
            for rank in range(pieces):
                r = max((r for r in own if r.rank <= rank), key=lambda r: r.rank)
                sequence, nth = r.first + (rank - r.rank) // r.each, (rank - r.rank) % r.each
                assert r.offset + nth * length + rooms[sequence] == capacity
                rooms[sequence] -= length
        assert sorted(rooms) == best_fit(lengths, capacity)


def test_segment_tree():
    tree, rng, there = packing.Tightest(100), np.random.default_rng(0), set()
    for _ in range(2000):
        room = int(rng.integers(0, 101))
        if rng.random() < 0.5:
            there.add(room)
            tree.set(room, True)
        else:
            there.discard(room)
            tree.set(room, False)
        wanted = int(rng.integers(0, 101))
        assert tree.find(wanted) == min((r for r in there if r >= wanted), default=None)


def test_many_pieces_cost_no_more_than_few():
    few, _ = packing.best_fit_decreasing({n: 3 for n in range(1, 257)}, 256)
    many, n = packing.best_fit_decreasing({n: 3 * 10**11 + n for n in range(1, 257)}, 256)
    assert len(many) < 3 * len(few) + 1000
    assert n * 256 >= sum(k * (3 * 10**11 + k) for k in range(1, 257))


def test_too_long_a_piece_is_refused():
    with pytest.raises(ValueError):
        packing.best_fit_decreasing({9: 1}, 8)


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def test_word_encoder(rows):
    texts = [r[1] for r in rows] + ["'s it's ΑΣ Σ ΑΣ. ﬁ é é 漢字　x 12 345", "<|startoftext|>a<|endoftext|>", "\x1c\x1d a b\r\n"]
    own, lib = WordEncoder(default_path()), library()
    for _ in range(2):
        ids, ends = own.encode(pa.array(texts))
        for text, first, end in zip(texts, [0, *ends], ends):
            assert ids[first:end].tolist() == lib.encode(text or "", add_special_tokens=False).ids
    ids, ends = own.encode(pa.array(texts).slice(4, 3))
    assert [len(x) for x in (ids[: ends[0]], ids[ends[0] : ends[1]])] == [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts[4:6]]
    assert own.encode(pa.array([], pa.string()))[1].tolist() == []


def test_word_encoder_starts_anew(rows, monkeypatch):
    monkeypatch.setattr("pitchflow.llm.word_encoder.STRETCHES", 5)
    texts, own, lib = [r[1] or "" for r in rows][:20], WordEncoder(default_path()), library()
    for text in texts:
        assert own.encode(pa.array([text]))[0].tolist() == lib.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [64, 2048])
@pytest.mark.parametrize("extra", [False, True])
def test_pack(docs, rows, capacity, extra):
    lib, expected = library(), Counter()
    for doc, text, _ in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            expected[doc, k // capacity, k, np.array(ids[k : k + capacity], "<u4").tobytes()] += 1
    packed = packing.pack(clashing(docs) if extra else docs, capacity=capacity).persist()
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in got) == expected
    assert all(r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    used = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert sorted(capacity - n for n in used.values()) == best_fit([r.length for r in got], capacity)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert {k: len(v) // 4 for k, v in whole.items()} == dict(used)
    packed.unpersist()


# --- spelling variants -----------------------------------------------------------


def near(word: str) -> set[str]:
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + x + b[1:] for a, b in cuts if b for x in letters} | {a + x + b for a, b in cuts for x in letters}
    return out - {word}


def brute_words(rows, slips: int) -> Counter:
    counts: Counter = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def brute_variants(counts: Counter) -> dict:
    forms, sizes = {}, {}
    for word, n in counts.items():
        others = sorted((-counts[x], x) for x in near(word) & counts.keys()) if len(word) < 100 else [
            (-counts[x], x) for x in counts if len(x) == len(word) and sum(a != b for a, b in zip(x, word)) == 1
        ]
        sizes[word] = len(others)
        forms[word] = others[0][1] if others and -others[0][0] >= 10 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        out[word] = (word, forms[word], root, n, sizes[word], counts[forms[word]] if forms[word] else None)
    return out


@pytest.mark.parametrize("slips", [0, 3, 31])
@pytest.mark.parametrize("symbols", [2, None])
def test_variants(docs, rows, slips, symbols, monkeypatch):
    if symbols:
        monkeypatch.setattr(spelling, "symbols_for", lambda n: symbols)
    got = {r.word: tuple(r) for r in spelling.variants(clashing(docs), slips=slips).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    expected = brute_variants(brute_words(rows, slips))
    assert got == expected
    assert any(r[4] for r in expected.values())


def test_variants_of_made_words(spark):
    """Chains of forms, ties, runs of one letter, and words of every length up to 60."""
    rng, counts = np.random.default_rng(5), Counter()
    for n in (7, 8, 9, 25, 60):
        for _ in range(25):
            word = "".join(rng.choice([*"aabcé"], n))
            counts[word] += int(rng.integers(2, 2000))
            for x in rng.choice(sorted(near(word)), 6):
                if len(x) >= 7:
                    counts[str(x)] += int(rng.integers(2, 60))
    counts |= {"bbbbbbb": 4, "bbbbbbbb": 50, "bbbbbbbbb": 700, "bbbbbbbbbb": 9000, "cbbbbbbbb": 700}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(words).collect()}
    expected = brute_variants(counts)
    assert got == expected
    assert expected["bbbbbbb"][2] == "bbbbbbbbbb"


def test_neighbourhood_is_whole():
    """Two reduced words are one edit apart if and only if one of them writes the other down, and then once."""
    classes = {ord("a"): 1, ord("b"): 2, ord("c"): 3}
    tool, words = spelling.Reduced(classes, 3), [f"{i:b}".replace("0", "a").replace("1", "b") for i in range(1, 64)] + ["abc", "cba", "cbb", "abcabc", "abcabb"]
    number = {w: int(tool.numbers(tool.digits([w], len(w)))[0]) for w in words}
    written = {w: Counter(tool.neighbours(tool.digits([w], len(w)))[1].tolist()) for w in words}
    for a in words:
        for b in words:
            if a < b:
                apart = b in near(a)
                assert written[a][number[b]] + written[b][number[a]] == apart, (a, b)


# --- collocations ------------------------------------------------------------------


def brute_counts(rows, max_words: int) -> tuple[Counter, Counter]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, sizes = Counter(), Counter()
    for _, text, lang in rows:
        own = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[own] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[own, tuple(words[i : i + k])] += 1
    return counts, sizes


def brute_collocations(rows, max_words: int, min_count: int, covered: int, best: int) -> set:
    counts, sizes = brute_counts(rows, max_words)
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    dropped = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                if 100 * a >= covered * found[part]:
                    dropped.add(part)
    scored: dict = {}
    for (lang, words), a in found.items():
        if (lang, words) not in dropped:
            score, _, n_left, n_right = min(
                (1000000 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]])
                for k in range(1, len(words))
            )
            scored.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), n_left, n_right))
    out = set()
    for lang, items in scored.items():
        for rank, (score, a, phrase, n_left, n_right) in enumerate(sorted(items)[:best], 1):
            out.add((lang, rank, phrase.decode(), -a, n_left, n_right, sizes[lang], -score))
    return out


@pytest.mark.parametrize("max_words, min_count, covered, best, shard", [(3, 10, 50, 2000, None), (3, 2, 80, 20, 3000), (2, 3, 50, 50, 500), (4, 3, 60, 2000, 10_000)])
def test_collocations(docs, rows, monkeypatch, max_words, min_count, covered, best, shard):
    if shard:
        monkeypatch.setattr(collocations, "SHARD", shard)
    got = collocations.collocations(clashing(docs), max_words, min_count, covered, best)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_collocations(rows, max_words, min_count, covered, best)
    assert {tuple(r) for r in got.collect()} == expected
    assert expected


def test_scores_pass_64_bits(spark):
    exact = "CAST({} AS DECIMAL(38, 0))".format
    score = f"(CAST(1000000 AS DECIMAL(7, 0)) * {exact('a')} * {exact('a')}) DIV ({exact('l')} * {exact('r')})"
    a, n_left, n_right = 123_456_789_012, 987_654_321_098, 555_555_555_557
    row = spark.createDataFrame([(a, n_left, n_right)], "a long, l long, r long").selectExpr(f"{score} AS score").first()
    assert row.score == 1000000 * a * a // (n_left * n_right)


def test_fm_index_intervals():
    """Every interval, in both directions, holds just the places of its phrase."""
    rng = np.random.default_rng(2)
    ids = np.where(rng.random(600) < 0.15, 0, rng.integers(1, 6, 600))
    index = collocations.FMIndex(ids, 4)
    text = index.padded
    for steps in ([True, True, True], [False, False, False], [True, False, True], [False, True, False]):
        phrases = index.single()
        before = 0  # words added on the left so far
        for left in steps:
            phrases = index.extend(phrases, left)
            before += left
        seen = 0
        for first, back, size in zip(phrases.first, phrases.back, phrases.size):
            at = sorted(index.forward[first : first + size])
            phrase = tuple(text[at[0] : at[0] + 4])
            assert 0 not in phrase
            assert at == [i for i in index.at if tuple(text[i : i + 4]) == phrase]
            assert sorted(index.backward[back : back + size] - 3) == at
            seen += size
        assert seen == sum(0 not in text[i : i + 4] for i in index.at)


@pytest.mark.parametrize("operator", [packing.pack, spelling.variants, collocations.collocations])
def test_empty_and_null(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
    nulls = spark.createDataFrame([(None, None, None), (1, None, "en"), (2, "", None)], SCHEMA)
    got = operator(nulls).collect()
    assert len(got) == (3 if operator is packing.pack else 0)
