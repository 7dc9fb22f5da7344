"""The operators for training text against brute force, and their defined results on awkward input."""

from __future__ import annotations

import collections
import ctypes
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.llm import (
    bpe_chunks, chosen_path, common, fingerprints, line_dedup, mixing, paragraph_dedup, quality_classifier, quality_rules, repeated_bytes,
    shingles, token_store, tokens,
)

SCHEMA = "doc_id long, text string, source string"
WORDS = [a + b + c for a, b, c in itertools.product(("ba", "ti", "no", "ré", "su"), ("lan", "mer", "dos", "kü"), ("", "s", "ing", "ado"))]


def prose(rng: np.random.Generator, n: int) -> str:
    out, left = [], n
    while left > 0:
        k = int(min(left, rng.integers(4, 16)))
        out.append(" ".join(rng.choice(WORDS, k)).capitalize() + ". ")
        if rng.random() < 0.15:
            out.append("\n")
        left -= k
    return "".join(out).strip()


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    """Prose, copies, near copies, shared passages, and awkward texts."""
    rng = np.random.default_rng(3)
    texts = [prose(rng, int(rng.integers(20, 300))) for _ in range(40)]
    passage, line = prose(rng, 80).replace("\n", " "), "This line stands in many documents, word for word."
    for i in range(0, 36, 4):
        texts[i] += " " + passage + " " + prose(rng, 20)
    for i in range(1, 30, 3):
        texts[i] += "\n" + (line if i % 2 else "  " + line.upper() + "\t") + "\n" + prose(rng, 10)
    texts += [texts[5], texts[5], texts[6] + " End.", texts[7].replace("ba", "bo", 1), texts[8] + "\n" + texts[9]]
    base = prose(rng, 400)
    for i in range(12):
        words = base.split(" ")
        words[10 + 25 * i] = f"changed{i}"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t ", "one", "a b c d", "\n\n", "x " * 500, "ab" * 400, "é  zeit  zwei\x85 drei\x1c vier <|endoftext|> fünf", prose(rng, 3000)]
    out = [(i, t, [None, "src", "alt", "été"][i % 4]) for i, t in enumerate(texts)]
    return [*out, (7, texts[7], "src"), (None, texts[3], "src"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


CLASHING = ["id", "doc", "key", "n", "salt", "leaf", "_text", "_own", "hash", "gone", "lines", "_mix_h", "shard", "_bucket", "nth"]

OPERATORS = {
    "paragraphs": paragraph_dedup.drop_paragraphs,
    "rules": quality_rules.clean_lines,
    "fingerprints": fingerprints.compare_with_edits,
    "bytes": repeated_bytes.remove_repeats,
    "mixture": lambda d: mixing.mixture(mixing.mix(d, block_words=100)),
    "join": chosen_path.similarity_join,
    "one": lambda d: chosen_path.one_of_each_class(d, chosen_path.similarity_join(d)),
    "bpe": bpe_chunks.transcode,
    "lines": lambda d: line_dedup.drop_repeated_lines(d, line_dedup.LineIndex.build(d)),
    "quality": lambda d: quality_classifier.score(d, quality_classifier.Model(None, 0.5)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(docs, name):
    few = docs.where("doc_id < 6 OR doc_id IS NULL")
    plain = OPERATORS[name](few)
    more = OPERATORS[name](few.select("*", *[F.lit("x").alias(n) for n in CLASHING]))
    same = [c for c in plain.columns if c not in ("draw", "spans", "classes")]
    key = lambda r: tuple(map(str, r))
    assert sorted(plain.select(same).collect(), key=key) == sorted(more.select(same).collect(), key=key)


# --- shingles and components


def test_shingles_are_word_runs():
    texts = ["", "a", "a b", "a b c d e", "a  b\tc\nd e f", "é b c d e f", " a b c d e"]
    got = shingles.shingle_sets([t.encode() for t in texts])
    want = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.split()) else set() for t in texts]
    for a, b in itertools.product(range(len(texts)), repeat=2):
        assert len(np.intersect1d(got[a], got[b])) == len(want[a] & want[b])


def test_long_words_differ():
    texts = [("x" * 30 + c).encode() for c in "abc,."] + [b"x" * 30]
    hashes, counts = shingles.word_hashes(texts)
    assert len(set(hashes.tolist())) == 6 and counts.tolist() == [1] * 6


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    """Large sets: what the comparison takes beside the sets stays small, and blocks by items give the same links."""
    import tracemalloc

    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**63, 20_000, np.uint64))
    large = [np.unique(np.concatenate([base[: 19_000 - 5 * i], rng.integers(0, 2**63, 800, np.uint64)])) for i in range(200)]
    tracemalloc.start()
    counts = shingles.common_counts(large)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    assert counts[0, 7] == len(np.intersect1d(large[0], large[7])) and counts[3, 3] == len(large[3])
    sets = spark.createDataFrame([(bytes([i]), bytearray(x[:300].tobytes())) for i, x in enumerate(large[:60])], "id binary, items binary")
    sizes = sets.select("id", (F.length("items") / 8).cast("long").alias("n_items"))
    leaves = sets.select(F.lit(1).cast("long").alias("leaf"), "id")
    total = lambda df: {bytes(r.id): r.n for r in df.groupBy("id").agg(F.sum("links").alias("n")).collect()}
    whole = total(shingles.linked(leaves, sets, 0.8))
    monkeypatch.setattr(shingles, "BLOCK_ITEMS", 2500)
    assert total(shingles.linked(leaves, sets, 0.8, sizes=sizes)) == whole and len(whole) == 60


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(40)]
    got = shingles.common_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40))


def test_tasks_give_free_memory_back():
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("no glibc")

    def held():
        return next(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith("Pss_Anon")) >> 10

    def task(batches):
        yield from batches
        # Much is freed below a little that stays.
        parts = [bytes(1000 + i % 7) for i in range(120_000)]
        state["kept"] = parts[::500]
        state["full"] = held()

    state: dict = {}
    assert list(common.lean(task)(iter([1, 2]))) == [1, 2]
    assert held() < state["full"] - 90


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(1900, 2100)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges for x in e if e[0] != e[1]}


# --- 1 paragraphs


def shingle_set(text: str) -> set:
    w = text.encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(sets: list[set]) -> tuple[list[int], list[int]]:
    """The least member of each set's component, and the number of its links, by comparing all pairs."""
    part, links = list(range(len(sets))), [0] * len(sets)
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 5 * both >= 4 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            a, b = part[i], part[j]
            part = [min(a, b) if p in (a, b) else p for p in part]
    return part, links


def test_paragraphs(docs, rows):
    cut = lambda t: [w for *_, w in paragraph_dedup.paragraphs(t or "") if w is not None]
    known = list(dict.fromkeys(w for i, t, _ in rows if i is not None for w in cut(t)))
    part, _ = classes([shingle_set(w.decode()) for w in known])
    of = dict(zip(known, part, strict=True))
    keeper: dict = {}
    for i, t, _ in rows:
        for w in cut(t) if i is not None else []:
            keeper[of[w]] = min(keeper.get(of[w], i), i)
    want = collections.Counter()
    for i, t, _ in rows:
        kept, seen = [], set()
        for a, b, w in paragraph_dedup.paragraphs(t or ""):
            if w is not None and i is not None:
                if keeper[of[w]] != i or of[w] in seen:
                    continue
                seen.add(of[w])
            kept.append(t[a:b])
        want[(i, None if t is None else "".join(kept))] += 1
    got = paragraph_dedup.drop_paragraphs(docs).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == want
    assert sum(r.n_removed for r in got) > 20


def test_near_copies_of_lines(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    sentence = lambda: " ".join(word() for _ in range(15)).capitalize() + "."
    base = [" ".join(sentence() for _ in range(4)) for _ in range(6)]
    rows = []
    for i in range(24):
        words = base[i % 6].split(" ")
        if i >= 6:
            words[2 + i] = word()  # one inner word: Jaccard 0.84 as a line, under 0.4 as a sentence
        rows.append((i, "\n".join([" ".join(words), sentence()])))
    lines = [(i, x) for i, t in rows for x in t.split("\n")]
    part, links = classes([shingle_set(x) for _, x in lines])
    assert sum(links) > 12
    keeper: dict = {}
    for (i, _), p in zip(lines, part, strict=True):
        keeper[p] = min(keeper.get(p, i), i)
    got = {r.doc_id: r for r in paragraph_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: "\n".join(x for (j, x), p in zip(lines, part, strict=True) if j == i and keeper[p] == i) for i, _ in rows}
    assert {i: r.text.strip() for i, r in got.items()} == want
    assert sum(r.n_removed for r in got.values()) == 18


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.99), (0.5, 0.95), (0.9, 0.999)):
        bands, width = paragraph_dedup.tune_bands(threshold, recall)
        assert 1 - (1 - threshold**width) ** bands >= recall


def test_many_short_paragraphs_are_split_exactly():
    text = "One two three four five six seven eight. Short one!  And\nthen nine words follow here to make it long?\n"
    parts = list(paragraph_dedup.paragraphs(text))
    assert "".join(text[a:b] for a, b, _ in parts) == text
    assert [w is not None for *_, w in parts] == [True, False, False, True]


def unlike(rng: np.random.Generator, n: int, low: int, high: int) -> str:
    """``n`` words, none like the next, in sentences of ``low`` to ``high`` words."""
    out: list[str] = []
    while len(out) < n:
        out += ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(rng.integers(low, high + 1))]
        out[-1] += "."
    return " ".join(out[:n])


LENGTHS = [(2, 6), (1, 3), (4, 16), (20, 40), (900, 900)]


@pytest.mark.parametrize("low, high", LENGTHS)
def test_passages_hold_whole_units(low, high):
    rng = np.random.default_rng(low)
    for k in range(200):
        passage = unlike(rng, 50, low, high)
        a, b = (" ".join([unlike(rng, 37 + k % 9, low, high), passage, unlike(rng, 60, *LENGTHS[k % 5])]) for _ in range(2))
        cut = list(paragraph_dedup.passages([a, "", " \n", b.replace(" ", "  "), "é ü\n" + a]))
        assert ["".join(t[x:y] for x, y, _ in c) for t, c in zip([a, b.replace(" ", "  "), "é ü\n" + a], [cut[0], cut[3], cut[4]], strict=True)] == [a, b.replace(" ", "  "), "é ü\n" + a]
        assert all(w is not None and len(w.split()) >= 8 for *_, w in cut[0]) and max(len(w.split()) for *_, w in cut[0]) <= 48
        both = {w for *_, w in cut[0]} & {w for *_, w in cut[3]}
        assert any(w.decode() in passage for w in both)


def test_passages_inside_other_text_are_found(spark):
    rng = np.random.default_rng(6)
    rows, planted = [], [unlike(rng, 80, low, high) for low, high in LENGTHS]
    planted.append("\n".join(unlike(rng, 5, 5, 5) for _ in range(16)))
    for i in range(18):
        host = lambda: unlike(rng, 60, *LENGTHS[i % 5])
        rows.append((i, f"{host()} {planted[i % 6]} {host()}"))
    got = {r.doc_id: r.text for r in paragraph_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert (got[i] == t) if i < 6 else len(t.split()) - len(got[i].split()) >= 40


def test_leaves_do_not_meet_by_chance():
    hashes = np.random.default_rng(3).integers(0, 2**64, 12 * 200_000, np.uint64)
    leaves = paragraph_dedup._leaves(hashes, np.full(200_000, 12), 3, 1)
    assert len(np.unique(leaves)) == 600_000
    pack = paragraph_dedup._packed(leaves[:5000].T.reshape(-1), np.tile(np.arange(1, 5001, dtype=np.uint64), 3))
    items = np.concatenate([np.frombuffer(x.as_buffer(), paragraph_dedup._ITEM) for x in pack["pack"]])
    assert pack["bucket"].to_pylist() == sorted(set((leaves[:5000].reshape(-1) >> np.uint64(52)).tolist())) and len(items) == 15_000


def test_a_frequent_leaf_is_held_as_two_items():
    items = np.array([(7, k) for k in range(1, 1000)] + [(8, 5), (8, 5), (9, 6)], paragraph_dedup._ITEM)
    short, other, rest = paragraph_dedup._met(items)
    assert len(short) == 1001 and other.sum() == 999 and short[~other].tolist() == [5, 5]
    assert rest.tolist() == [(7, 1), (7, 999), (8, 5), (8, 5), (9, 6)]
    again, other, _ = paragraph_dedup._met(np.concatenate([rest, np.array([(9, 6), (7, 7)], paragraph_dedup._ITEM)]))
    assert sorted(zip(again.tolist(), other.tolist(), strict=True)) == [(1, True), (5, False), (5, False), (6, False), (6, False), (7, True), (999, True)]


def test_units_are_cut_and_hashed_together():
    """No digest per unit: texts of a batch are cut, told apart and made into sets at once, also where the cuts come from beside them."""
    rng = np.random.default_rng(15)
    kinds = ["a", "bc", "é", "end.", "x y z", " ", "  ", "\t", "\n", "\r\n", "one two three four five six seven eight.", ""]
    texts = [" ".join(rng.choice(kinds, rng.integers(0, 90))) for _ in range(300)] + ["", "\n", " \n ", "w " * 3000, "x" * 100_000]
    bodies = [t.encode() for t in texts]
    split = {"lines": r"\n", "sentences": r"\n|[.!?]+[ \t]+"}
    for units in ("lines", "sentences", "passages"):
        told: dict = {}
        own = paragraph_dedup._cut(bodies, units, 8)
        for k, text in enumerate(texts):
            parts = [own.part(u) for u in range(own.first[k], own.first[k + 1])]
            assert b"".join(parts) == text.encode() and all(parts)
            if units in split:
                ends = [0, *(m.end() for m in re.finditer(split[units], text)), len(text)]
                assert [p.decode() for p in parts] == [text[a:b] for a, b in itertools.pairwise(ends) if b > a]
            for short, part in zip(own.shorts[own.first[k] : own.first[k + 1]].tolist(), parts, strict=True):
                words = part.split()
                assert (short > 0) == (len(words) >= 8) and (not short or told.setdefault(short, words) == words)
        assert len(set(map(tuple, told.values()))) == len(told) > 20
        chosen = np.flatnonzero(own.shorts)[::2].tolist()
        got, want = own.shingles(chosen), shingles.shingle_hashes([own.part(u) for u in chosen])
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
        sets, sizes = paragraph_dedup._sets(*got)
        assert all(np.array_equal(a, b) for a, b in zip(np.split(sets, np.cumsum(sizes)[:-1]), shingles.shingle_sets([own.part(u) for u in chosen]), strict=True))
    again = paragraph_dedup._uncut(bodies, list(paragraph_dedup._cuts_of(bodies, 8)))
    assert again.body == own.body and all(np.array_equal(a, b) for a, b in zip(again[1:4], own[1:4], strict=True))


def test_a_full_filter_lets_little_more_through(spark):
    """Two bits of each short: at 16 bits a row under two per cent pass by chance, with one bit it is six."""
    shorts = np.random.default_rng(21).integers(1, 2**64, 104_000, np.uint64)
    wanted, others = shorts[:4000], shorts[4000:]
    marks = paragraph_dedup._marks(spark.createDataFrame([(int(x),) for x in wanted.view(np.int64)], "short long"))
    assert len(marks) * 8 == 1 << 16 and paragraph_dedup._among(marks, wanted).all()
    assert paragraph_dedup._among(marks, others).mean() < 0.02


def test_components_stop_when_all_hang_on_roots(spark, monkeypatch):
    """Stars take no round, a path takes some; each component has its least node as the root."""
    written = []
    monkeypatch.setattr(common, "stored", lambda df, stored=common.stored: written.append(1) or stored(df))
    for edges, rounds in (([(0, i) for i in range(1, 30)] + [(40, 41)], 0), ([(i, i + 1) for i in range(30)] + [(40, 41), (41, 42), (42, 40)], None)):
        written.clear()
        got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {n: 40 if n >= 40 else 0 for e in edges for n in e}
        assert len(written) == 1 if rounds == 0 else len(written) > 2


@pytest.mark.parametrize("often", [1000, 6])
def test_only_frequent_paragraphs_are_salted(spark, monkeypatch, often):
    monkeypatch.setattr(paragraph_dedup, "OFTEN", often)
    rng = np.random.default_rng(9)
    common, pairs = unlike(rng, 12, 12, 12), [unlike(rng, 12, 12, 12) for _ in range(20)]
    rows = [(i, "\n".join([common, pairs[i // 2], unlike(rng, 12, 12, 12)])) for i in range(40)]
    found = paragraph_dedup.paragraph_classes(spark.createDataFrame(rows, "doc long, text string"), units="lines")
    execution = found._jdf.queryExecution()
    assert execution.toRdd().count() == 40

    def exploded(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return exploded(plan.executedPlan())
        if plan.nodeName().endswith("QueryStage"):
            return exploded(plan.plan())
        own = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == "Generate" else 0
        return own + sum(exploded(plan.children().apply(i)) for i in range(plan.children().size()))

    # Each class has a row, and the one of 40 documents one for each salt if that is often.
    assert exploded(execution.executedPlan()) == 20 + (1 if often > 40 else paragraph_dedup.SALTS)
    assert {r.doc: sorted(p.keeper for p in r.places) for r in found.collect()} == {i: [0, i // 2 * 2] for i in range(40)}


def test_blocks_of_many_members_are_compared_together():
    rng = np.random.default_rng(14)
    base = rng.integers(0, 2**64, 20, np.uint64)
    sets = [np.unique(np.append(base[rng.random(20) < 0.93], rng.integers(0, 2**64, k % 3, np.uint64))) for k in range(62)]
    batch = pa.table({
        "leaf": pa.array([0] + [1] * 30 + [2] * 30 + [3], pa.int64()), "a": pa.array([0] * 62, pa.int32()), "b": pa.array([0] * 62, pa.int32()),
        "id": pa.array([bytes([k]) for k in range(62)]), "first": pa.array([True] * 62), "leaves": pa.array([[1]] * 31 + [[2]] * 31, pa.list_(pa.int64())),
        "items": pa.array([x.tobytes() for x in sets]),
    }).to_batches()[0]
    found: list = []
    assert [x["id"].to_pylist() for x in shingles._small_blocks(batch, 0.8, found)] == [[b"\0"], [bytes([61])]]
    want: collections.Counter = collections.Counter()
    for low in (1, 31):
        for i, j in itertools.combinations(range(low, low + 30), 2):
            if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])):
                want.update((i, j))
    assert {x[0]: n for x, n, _ in found} == want and 30 < sum(want.values()) < 2 * 870


@pytest.mark.parametrize("block", [3, 400])
def test_small_blocks_count_every_link(spark, block):
    rng = np.random.default_rng(12)
    base = [rng.integers(0, 2**64, 20, np.uint64) for _ in range(40)]
    sets = [np.unique(np.append(base[i % 40][rng.random(20) < 0.95], rng.integers(0, 2**64, i % 3, np.uint64))) for i in range(160)]
    leaves = [(int(leaf), i.to_bytes(2, "big")) for i in range(160) for leaf in (i % 40, 100 + i % 20, 200 + i // 4)]
    pairs = (spark.createDataFrame([(leaf, bytearray(x)) for leaf, x in leaves], "leaf long, id binary").coalesce(1),
             spark.createDataFrame([(bytearray(i.to_bytes(2, "big")), bytearray(x.tobytes())) for i, x in enumerate(sets)], "id binary, items binary"))
    batch = pa.table({
        "leaf": pa.array([0, 1, 1, 1, 2, 2, 3], pa.int64()), "a": pa.array([0] * 7, pa.int32()), "b": pa.array([0] * 7, pa.int32()),
        "id": pa.array([bytes([k]) for k in range(7)]), "first": pa.array([True] * 7), "leaves": pa.array([[1]] * 7, pa.list_(pa.int64())),
        "items": pa.array([base[k // 2].tobytes() for k in range(7)]),
    }).to_batches()[0]
    found: list = []
    rest = list(shingles._small_blocks(batch, 0.8, found))
    assert found == [(b"\2", 1, b"\2"), (b"\3", 1, b"\2"), (b"\4", 0, b"\4"), (b"\5", 0, b"\4")]  # these have met in leaf 1 before
    assert [x["id"].to_pylist() for x in rest] == [[b"\0"], [b"\6"]]
    links: collections.Counter = collections.Counter()
    for r in shingles.linked(*pairs, 0.8, block).collect():
        links[bytes(r.id)] += r.links
    where = collections.defaultdict(set)
    for leaf, x in leaves:
        where[x].add(leaf)
    own, want = [set(x.tolist()) for x in sets], collections.Counter()
    for (i, a), (j, b) in itertools.combinations(enumerate(where), 2):
        if where[a] & where[b] and 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
            want.update((a, b))
    assert +links == want and sum(want.values()) > 40


# --- 2 token store, 8 chunks


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokens.default_path())
    tool.no_truncation()
    tool.no_padding()
    return tool


def test_encoder_is_the_library(library):
    rng = np.random.default_rng(2)
    own, chunked = tokens.Encoder(tokens.default_path()), None
    chunked = bpe_chunks.ChunkEncoder(own)
    bits = [" ", "  ", "\n", "\t", "a", "b's", "'ll", " the", "é", "中", "1", "22", "!", "\r", "<|endoftext|>", "🙂", "\x0b", "\x1c", "\x85", "​", " \n", "Word.\nNext"]
    for _ in range(1500):
        text = "".join(rng.choice(bits, rng.integers(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids == np.frombuffer(chunked.encode(text), "<u4").tolist(), repr(text)
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_many_texts_together_are_the_library(library, monkeypatch):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(tokens, "TOGETHER", 200)
    bits = [" ", "  ", "\n", "\t", "a", "b's", " the", " the", "é", "中", "1", "\r", "<|endoftext|>", "🙂", "\x85", " \n", " Word.\nNext", " x"]
    texts = [None, "", *("".join(rng.choice(bits, rng.integers(0, 14))) for _ in range(800)), " the" * 300]
    own = tokens.Encoder(tokens.default_path())
    for part in (pa.array(texts), pa.array(texts).slice(5, 40), pa.array([], pa.string())):
        got = [x.tolist() for x in own.encode_all(part)]
        assert got == [library.encode(x or "", add_special_tokens=False).ids for x in part.to_pylist()]


def test_marks_behind_words_need_no_call_of_the_library(library, monkeypatch):
    own = tokens.Encoder(tokens.default_path())
    whole = []
    monkeypatch.setattr(own, "_whole", lambda texts, f=own._whole: whole.extend(texts) or f(texts))
    words = ["the", "Straße", "père", "zzqx"]
    ends = ["$$$", "%%", "***", "#", "|<>", ").", "-", '"', "_", "@\nnext]"]
    text = "start " + " ".join(w + e for w in words for e in ends) + " it's 3rd"
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert whole == [" it's", " 3rd", "start"]


def test_chunks_are_cut_by_content():
    rng = np.random.default_rng(4)
    shared = prose(rng, 3000).encode()
    a, b = bpe_chunks.chunks(prose(rng, 500).encode() + shared), bpe_chunks.chunks(prose(rng, 900).encode() + shared)
    assert len(set(a) & set(b)) > 3 and all(c.decode() for c in a + b)


def test_shared_chunks_are_encoded_once(library):
    rng = np.random.default_rng(6)
    shared, own = prose(rng, 6000), bpe_chunks.ChunkEncoder(tokens.Encoder(tokens.default_path()))
    for i in range(5):
        text = prose(rng, 50 + i) + shared + prose(rng, 40)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.reused > 3 * own.encoded / 2


def test_transcode(docs, rows, library):
    want = {}
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, t] = (len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False))
    for r in bpe_chunks.transcode(docs, keep_text=True).collect():
        assert (r.n_tokens, bytes(r.ids), r.decoded) == want[r.doc_id, r.text]


def test_token_store(spark, docs, rows, library, tmp_path):
    folder = str(tmp_path / "store")
    mark = token_store.write(docs, folder, shards=3)
    got = token_store.read(spark, folder).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (i, t, _) in zip(got, order, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, token_store.END]
        data = np.array(ids, "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (i, start, len(ids), zlib.crc32(data), data)
        start += len(ids)
    assert token_store.document(spark, folder, 4)[0].tolist() == [*library.encode(rows[4][1], add_special_tokens=False).ids, token_store.END]
    assert len(token_store.document(spark, folder, 7)) == 2 and token_store.document(spark, folder, 10**6) == []
    payload = bytes(spark.read.parquet(f"{folder}/blocks").where("dictionary = '" + mark + "'").first().payload)
    with pytest.raises(ValueError, match="another dictionary"):
        token_store.Block(payload, b"other")


def test_token_store_of_nothing(spark, tmp_path):
    token_store.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert token_store.read(spark, str(tmp_path / "none")).count() == 0


# --- 3 rules


def test_rules(docs, rows):
    word = re.compile(common.WORD)
    for r in quality_rules.clean_lines(docs).collect():
        t = next(t or "" for i, t, _ in rows if i == r.doc_id and (r.doc_id is not None or (t is None) == (r.n_words == 0)))
        words = word.findall(t)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if word.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(inside))
        assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words)) and not (r.kept and r.base_failed)


def test_bad_lines_go_first():
    rng = np.random.default_rng(5)
    good = [prose(rng, 20).replace("\n", " ") for _ in range(6)]
    text = "\n".join(["Home | News | Sport | Contact | About", *good[:3], "WIN!! BIG!! MONEY!! NOW!! CLICK!!", *good[3:], "© All rights reserved."])
    got = quality_rules.measure(text)
    assert got["n_bad_lines"] == 3 and got["kept"] and "|" not in got["clean_text"] and "WIN" not in got["clean_text"]
    mostly = "\n".join([f"a{i} | b{i} | c{i} | d{i} | e{i}" for i in range(30)] + good[:1])
    assert not quality_rules.measure(mostly)["kept"] and not quality_rules.measure(None)["kept"]


def test_lines_are_judged_by_their_ends():
    rng = np.random.default_rng(5)
    ends = quality_rules.Limits(ends=True)
    items = [" ".join(rng.choice(WORDS, 4)) + f" {i}" for i in range(20)]
    menu, spaced = "\n".join(items), "\n\n".join(items)
    fragments = "\n".join(" ".join([*rng.choice(WORDS, 20), f"it{i}"]) for i in range(6))
    for page in (menu, spaced, fragments):
        got = quality_rules.measure(page, ends)
        assert not got["base_failed"] and got["lost"] == 1 and not got["kept"]
    prose_lines = [" ".join(rng.choice(WORDS, 20)) + mark for mark in (".", "?", "!”", ".  ", ":", "…")]
    page = "\n".join(x for k, line in enumerate(prose_lines) for x in (f"Heading number {k}", "", line))
    got = quality_rules.measure(page, ends)
    assert got["kept"] and got["n_bad_lines"] == 0 and got["clean_text"] == page
    got = quality_rules.measure(menu + "\n" + page, ends)
    assert got["kept"] == (got["lost"] <= 0.5) and items[3] not in got["clean_text"] and prose_lines[0] in got["clean_text"]


def test_pages_without_a_sentence_are_rejected():
    """Pages of one item a line, of a notice in another language, and of Roman numerals, by the limits of the query."""
    ends = quality_rules.Limits(ends=True)
    items = "\n".join(f"Item{i} Page{i} Link{i} Section{i}" for i in range(20))
    notice = "\n".join(f"Abteilung{i} Nummer{i} Haus{i} Stadt{i}: Alle Rechte vorbehalten." for i in range(20))
    for page in (items, notice):
        got = quality_rules.measure(page, ends)
        assert not got["base_failed"] and got["n_bad_lines"] == 20 and not got["kept"]
    assert quality_rules.line_fault("Ⅰ Ⅱ Ⅲ Ⅳ.", [b""] * 4) is None and quality_rules.line_fault("AB CD EF GH.", [b""] * 4) == "upper case"


@pytest.mark.parametrize("name", ["op3_line_rules", "op7_chosen_path", "op9_line_dedup"])
def test_queries_equal_their_sql(spark, rows, tmp_path, name):
    """On the awkward texts above, with menus and fragments among them; ids are unique as in the given tables."""
    import duckdb

    from pitchflow.llm import queries

    rng = np.random.default_rng(6)
    own = [t for i, t, _ in rows if i is not None and i < 66]
    lines = [" ".join(rng.choice(WORDS, int(n))) + str(rng.choice(["", "", ".", "?  ", "”"])) for n in rng.integers(1, 30, 400)]
    own += ["\n".join(rng.choice([*lines, "", " \t"], int(n))) for n in rng.integers(1, 25, 60)]
    table = pa.table({"doc_id": pa.array(range(len(own)), pa.int64()), "text": pa.array(own, pa.string())})
    pq.write_table(table, f"{tmp_path}/documents.parquet")
    got = queries.QUERIES[name](spark, str(tmp_path))
    columns = sorted(got.columns)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want, key=repr)


# --- 4 fingerprints


def test_fingerprints(docs, rows):
    cut = re.compile(fingerprints.CUT)
    parts = lambda s: {x.strip(" ") for x in cut.split(s) if x.strip(" ")}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = collections.Counter()
    for k, (i, t) in enumerate(order):
        after, n = order[(k + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(parts(t), parts(edited)), 9), round(like(parts(t), parts(after)), 9)] += 1
    got = fingerprints.compare_with_edits(docs).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    assert len({r.fingerprint for r in got if r.doc_id in (5, 40, 41)}) <= 2


def test_fingerprints_alone_tell_the_difference(spark):
    # Only the returned tables are used, and n_lost and n_gained come out of them.
    rng = np.random.default_rng(2)
    line = lambda: " ".join(rng.choice(WORDS, 6))
    texts = ["\n".join(line() for _ in range(n)) for n in (0, 3, 20, 30, 40, 45, 90, 100, 600, 700)]
    texts += ["z " * 2000, "\n".join(line() for _ in range(55))]  # the last one's edited text has far fewer paragraphs
    got = fingerprints.compare_with_edits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    signed = lambda x: (int(x, 16) ^ 1 << 63) - (1 << 63)
    cells, known, folded = [], {}, 0
    for r in got:
        tables = [(x.split(" ") if x else ["8"]) for x in (r.fingerprint, r.edited_fingerprint)]
        sizes = [int(x[0], 16) for x in tables]
        assert all(x & (x - 1) == 0 for x in sizes)
        third, summed = min(sizes), {}
        folded += sizes[0] != sizes[1]
        for sign, size, (_, *table) in zip((1, -1), sizes, tables, strict=True):
            for cell, n, k, h in (x.split(":") for x in table):
                place = int(cell, 16) // size * third + int(cell, 16) % size % third
                old = summed.get(place, (0, 0, 0))
                summed[place] = old[0] + sign * int(n, 16), old[1] ^ signed(k), old[2] ^ signed(h)
        cells += [(r.doc_id, 0, third, c, 0, *x) for c, x in summed.items() if any(x)]
        known[r.doc_id] = r.n_lost, r.n_gained
    df = spark.createDataFrame(cells, "row long, pair int, s int, cell int, f long, n int, k long, h long")
    left = collections.defaultdict(collections.Counter)
    for r in fingerprints.peeled(df, keep=False).collect():
        left[r.row][min(r.cell, 0)] += abs(r.n)
    peeled = [i for i in known if not left[i][0]]
    assert len(peeled) >= 8 and folded
    assert all((left[i][-1], left[i][-2]) == known[i] for i in peeled)
    assert max(sum(known[i]) for i in peeled) > 100


def test_other_scripts_are_cut_too(spark):
    """One line without a Latin letter, with and without spaces: what is equal shows, and a text is like itself."""
    rng = np.random.default_rng(9)
    words = ["".join(map(chr, rng.integers(0x430, 0x44F, 6))) for _ in range(300)]
    texts = [gap.join(rng.choice(words, 2000)) for gap in (" ", "") for _ in range(4)]
    texts += ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 1500))) for _ in range(3)]
    got = fingerprints.compare_with_edits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    # Two thirds of a text's pieces are left, and a third of its own comes in: a half of all, less what lies on the seam.
    assert all(0.3 < r.near_edited < 0.7 for r in got), [r.near_edited for r in got]
    assert all(r.near_next < 0.1 for r in got), [r.near_next for r in got]


@pytest.mark.parametrize("tries", [4, 0])
def test_differences_of_any_size_are_recovered(spark, monkeypatch, tries):
    monkeypatch.setattr(fingerprints, "TRIES", tries)  # without a try the digests are compared
    rng = np.random.default_rng(9)
    pairs, want = [], {}
    for row, (same, a, b) in enumerate([(0, 0, 0), (50, 0, 1), (200, 5, 7), (100, 60, 10), (0, 400, 500), *[(i, i, 2 * i) for i in range(1, 40)]]):
        keys = [int(x) for x in rng.integers(-(2**62), 2**62, same + a + b)]
        left, right = keys[: same + a], keys[:same] + keys[same + a :]
        pairs.append((row, 0, left, right))
        want[row] = (set(left) - set(right), set(right) - set(left))
    df = spark.createDataFrame(pairs, "row long, pair int, a array<bigint>, b array<bigint>")
    got = {r.row: (set(r.lost), set(r.gained), r.only_a, r.only_b) for r in fingerprints.differences(df, keep=True).collect()}
    assert {k: got.get(k, (set(), set()))[:2] for k in want} == want
    assert all((len(x), len(y)) == (a, b) for x, y, a, b in got.values())


def test_a_table_too_small_gets_stuck(spark):
    keys = list(range(1, 400))
    df = spark.createDataFrame([(0, 0, keys, [])], "row long, pair int, a array<bigint>, b array<bigint>")
    cells = fingerprints.subtracted(df).where("cell % 2 = 0")  # half of its cells are missing
    assert fingerprints.peeled(cells).where("cell >= 0").count() > 0


# --- 5 bytes


@pytest.mark.parametrize("hot", [10**6, 2])
def test_repeated_bytes(docs, rows, hot):
    texts = {}
    for i, t, _ in rows:
        texts.setdefault((i is not None, i or 0, hashlib.md5((t or "").encode()).digest()), (i, (t or "").encode()))
    seen, want = set(), collections.Counter()
    for k in sorted(texts):
        i, body = texts[k]
        mark = np.zeros(len(body), bool)
        for j in range(len(body) - 99):
            part = body[j : j + 100]
            if part in seen:
                mark[j : j + 100] = True
            seen.add(part)
        spans = int(np.diff(mark.astype(int), prepend=0).clip(0).sum())
        left = bytes(b for b, m in zip(body, mark, strict=True) if not m)
        copies = sum(1 for a, t, _ in rows if a == i and (t or "").encode() == body)
        want[i, len(body), int(mark.sum()), spans, hashlib.sha256(left).hexdigest()] += copies
    got = repeated_bytes.remove_repeats(docs, hot=hot).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert sum(r.n_removed for r in got) > 3000


def test_frequent_anchors_shuffle_no_texts(spark, monkeypatch):
    rng = np.random.default_rng(9)
    texts = [prose(rng, 30) + " " + line + " " + prose(rng, 30) for line in [prose(rng, 40), prose(rng, 50)] for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plans = []
    monkeypatch.setattr(repeated_bytes, "stored", lambda df, f=repeated_bytes.stored: plans.append(df._jdf.queryExecution().executedPlan().toString()) or f(df))
    rows = lambda hot: sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in repeated_bytes.remove_repeats(docs, hot=hot).collect())
    few = rows(10**6)
    plans.clear()
    assert rows(3) == few and sum(n > 100 for _, n, _ in few) >= 20
    frequent = [p for p in plans if "left" in p]
    # The texts go from the scan to the Python step, with no exchange between.
    assert len(frequent) == 1 and re.search(r"MapInArrow(?:(?!Exchange)[^\n]*\n)*?[^\n]*Scan", frequent[0]) and "collect_list" not in frequent[0]


def test_short_repeats_show_wherever_they_stand(spark):
    """Strings of just the length and one less, at both ends of texts and inside: the hashes beside an anchor lose none of them."""
    rng = np.random.default_rng(8)
    noise = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passages, texts = [noise(n) for n in (90, 95, 99, 100, 101, 110) for _ in range(8)], []
    for passage in passages:
        body = passage.encode()[: len(passage)].decode(errors="ignore")
        texts += [body + noise(60), noise(70) + body, noise(50) + body + noise(50)]
    want, seen = {}, set()
    for i, t in enumerate(texts):
        body = t.encode()
        mark = np.zeros(len(body), bool)
        for j in range(len(body) - 99):
            if body[j : j + 100] in seen:
                mark[j : j + 100] = True
            seen.add(body[j : j + 100])
        want[i] = int(mark.sum())
    got = repeated_bytes.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == want
    assert sum(n > 0 for n in want.values()) > 30 and any(n == 100 for n in want.values())


def test_interval_tree():
    words = sorted([b"banana", b"bandana", b"ban", b"bat", b"cat", b"ban"])
    common_prefix = [repeated_bytes._common(a, b) for a, b in itertools.pairwise(words)]
    got = {(n, tuple(words[a : b + 1])) for n, a, b in repeated_bytes.intervals(common_prefix, 1)}
    assert got == {(3, (b"ban", b"ban", b"banana", b"bandana")), (2, (b"ban", b"ban", b"banana", b"bandana", b"bat"))}


def test_repeats_are_maximal_on_both_sides():
    lefts, rights = [b"xyzA", b"xyzB", b"xqqC"], [b"0123456789", b"0123456789", b"01234zzzzz"]
    got = {(left, right, tuple(sorted(m))) for left, right, m in repeated_bytes.maximal_repeats(lefts, rights, 6)}
    assert got == {(3, 10, (0, 1)), (1, 5, (0, 1, 2)), (3, 5, (0, 1))}


# --- 6 mixture


def test_targets_are_capped_and_reshared(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 10), ("d", 500), (None, 40), ("e", 0)]
    got = {r.source: r for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    order = sorted((s for s, _ in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    size, left, free, want = dict(sizes), sum(n for _, n in sizes), set(order), {}
    while True:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit > 3 * size[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * size[s]
            free.discard(s)
            left -= want[s]
    want |= {s: weight[s] * unit for s in free}
    assert {s: round(r.target, 6) for s, r in got.items()} == {s: round(t, 6) for s, t in want.items()}


def test_quotas_add_up_and_are_fair(spark):
    quotas = [1000, 3, 0, 250, 47]
    df = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    got = [r.quotas for r in mixing.split_quotas(df, 3).orderBy("shard").collect()]
    assert len(got) == 8 and [sum(x) for x in zip(*got, strict=True)] == quotas
    assert max(map(sum, got)) - min(map(sum, got)) <= 3
    spread = [[r.quotas[0] for r in mixing.split_quotas(df, 1, seed).where("shard = 0").collect()][0] for seed in range(30)]
    sd = (650 * 1000 / 1300 * 300 / 1300 * 650 / 1299) ** 0.5
    assert abs(np.mean(spread) - 500) < 4 * sd / 30**0.5 and 0.5 * sd < np.std(spread) < 1.6 * sd


def test_mixture(docs):
    mixed = mixing.mix(docs, block_words=60, levels=2, buckets=8)
    got = mixed.collect()
    assert len(got) == docs.count() and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), block_words=60, levels=2, buckets=8).collect()))
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        taken, size = sum(r.size * len(r.draws) for r in own), sum(r.size for r in own)
        assert own[0].source_size == size and abs(taken - own[0].target) <= 0.1 * own[0].target
        assert all(len(r.draws) <= 3 and (r.size > 0 or not r.draws) for r in own)
    assert mixing.mixture(mixed).count() == sum(len(r.draws) for r in got)


@pytest.mark.parametrize("seed", [20, 1, 2])
def test_a_dominant_document_is_no_miss(spark, seed):
    rows = [(0, "a", 60_000)] + [(i, "a", 500) for i in range(1, 81)] + [(1000 + i, "b", 1000) for i in range(160)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, n long"), size=F.col("n"), seed=seed, levels=1, buckets=8)
    for r in mixed.groupBy("source").agg(F.max("target").alias("target"), F.sum(F.col("size") * F.size("draws")).alias("taken")).collect():
        assert abs(r.taken - r.target) <= 0.01 * r.target


def test_rows_alike_but_for_their_text_are_drawn_alike_again(spark):
    rows = [(i // 4, "ab"[i % 2], "w " * (1 + i // 8), f"x{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, more string")
    first, again = (mixing.mix(d, block_words=60, levels=1, buckets=4).collect() for d in (df, df.repartition(7)))
    assert sorted(map(str, first)) == sorted(map(str, again))


# --- 7 join


def test_join(docs, rows):
    texts = list(dict.fromkeys(t or "" for _, t, _ in rows))
    part, links = classes([shingle_set(t) for t in texts])
    least: dict = {}
    for i, t, _ in rows:
        p = part[texts.index(t or "")]
        least[p] = min((x for x in (least.get(p), i) if x is not None), default=None)
    copies = collections.Counter(t or "" for _, t, _ in rows)
    want = collections.Counter((i, least[part[k]], copies[texts[k]], links[k]) for i, t, _ in rows for k in [texts.index(t or "")])
    got = chosen_path.similarity_join(docs).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.n_copies, r.n_links) for r in got) == want
    assert max(links) >= 11


def test_large_buckets_are_compared_in_blocks(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:k] + [f"own{n}"] + base[k + 1 :]) for n, k in enumerate(range(20, 180, 2))]
    sets = shingles.shingle_sets([t.encode() for t in texts])
    ids = [bytes([n]) for n in range(len(texts))]
    items = spark.createDataFrame([(bytearray(i), bytearray(s.tobytes())) for i, s in zip(ids, sets, strict=True)], "id binary, items binary")
    leaves = spark.createDataFrame([(leaf, bytearray(i)) for leaf in (1, 2, 3) for n, i in enumerate(ids) if n % leaf == 0], "leaf long, id binary")
    got = collections.Counter()
    for r in shingles.linked(leaves, items, 0.8, block=7).collect():
        got[bytes(r.id)] += r.links
    assert got == {i: len(ids) - 1 for i in ids}


@pytest.mark.parametrize("block", [5, 400])
def test_members_with_a_like_one_are_kept(spark, block):
    rng = np.random.default_rng(3)
    sketches = rng.integers(0, 1000, (30, 32))
    sketches[20:] = sketches[0]
    for n in range(20, 30):
        sketches[n, : n - 20] = -n  # up to nine coordinates of their own
    df = spark.createDataFrame([(bytearray([n]), x.tolist()) for n, x in enumerate(sketches)], "id binary, sketch array<int>")
    leaves = spark.createDataFrame([(1, bytearray([n])) for n in range(30)] + [(2, bytearray([n])) for n in range(20)], "leaf long, id binary")
    got = {(r.leaf, bytes(r.id)[0]) for r in shingles.likely(leaves, df, 15, block).collect()}
    assert got == {(1, n) for n in (0, *range(20, 30))}


def test_sketches_miss_next_to_nothing():
    rng = np.random.default_rng(4)
    assert (rng.binomial(chosen_path.SKETCH, 0.8, 300_000) < chosen_path.surely_equal(0.8)).mean() < 5e-5


def test_runs_reach_the_recall():
    runs = chosen_path.runs_for(0.995)
    assert 1 - (1 - chosen_path.survival(0.8, chosen_path.DEPTH)) ** runs >= 0.995


def test_one_of_each_class_stays(docs, rows):
    kept = chosen_path.one_of_each_class(docs, chosen_path.similarity_join(docs)).collect()
    part, _ = classes([shingle_set(t or "") for _, t, _ in rows])
    groups = collections.defaultdict(set)
    for (i, t, _), p in zip(rows, part, strict=True):
        groups[p if shingle_set(t or "") else t or ""].add(i)
    want = sorted(min((x for x in g if x is not None), default=-1) for g in groups.values())
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == want


# --- 9 lines


def brute_lines(rows: list[tuple], low: int) -> list[tuple]:
    strip = " \t\n\x0b\x0c\r"
    fold = {c: c + 32 for c in range(65, 91)}
    key = lambda x: x.strip(strip).translate(fold)
    where = collections.defaultdict(set)
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                where[key(x)].add(i)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or len(where.get(key(x), ())) < low or max(where[key(x)]) == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def result_lines(docs, index) -> list[tuple]:
    return sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in line_dedup.drop_repeated_lines(docs, index).collect()), key=str)


def test_lines(docs, rows):
    got = result_lines(docs, line_dedup.LineIndex.build(docs))
    assert got == brute_lines(rows, 5) and sum(r[3] for r in got) > 5


def test_lines_can_be_added_and_taken_back(spark, docs, rows):
    old, new = docs.where("doc_id % 3 <> 1"), docs.where("doc_id % 3 = 1")
    index = line_dedup.LineIndex.build(old, min_docs=3).insert(new)
    known = [r for r in rows if r[0] is not None]
    here = docs.where("doc_id IS NOT NULL")
    assert result_lines(here, index) == brute_lines(known, 3)
    gone = [10, 13, 41]
    back = index.delete(spark.createDataFrame([(i,) for i in gone], "x long"))
    left = [r for r in known if r[0] not in gone]
    assert result_lines(here.where(~F.col("doc_id").isin(gone)), back) == brute_lines(left, 3)


def test_a_change_writes_its_own_keys_only(spark, monkeypatch):
    written = []

    def counted(df):
        out = common.stored(df)
        written.append((sorted(out.columns), out.count()))
        return out

    line = lambda k: f"line {k} of forty characters and a little more"
    base = [(i, "\n".join(line(k) for k in range(i % 7, 200 + i % 7))) for i in range(20)]
    schema = "doc_id long, text string"
    index = line_dedup.LineIndex.build(spark.createDataFrame(base, schema), shards=8)
    monkeypatch.setattr(line_dedup, "stored", counted)
    more = [(100 + i, f"{line(3)}\n{line(1000)}") for i in range(6)]
    grown = index.insert(spark.createDataFrame(more, schema))
    rows = [n for names, n in written if "key" in names]
    assert rows == [12, 2] and max(n for names, n in written if "filter" in names) <= 1
    got = {tuple(r) for r in grown.compacted().counts.collect()}
    assert got == {tuple(r) for r in line_dedup.LineIndex.build(spark.createDataFrame(base + more, schema)).counts.collect()}
    written.clear()
    back = grown.delete(spark.createDataFrame([(100 + i,) for i in range(6)], "x long"))
    assert max(n for names, n in written if "key" in names) == 2
    assert {tuple(r) for r in back.counts.collect()} == {tuple(r) for r in index.counts.collect()}
    docs = spark.createDataFrame(base + more, schema)
    for index, rows in ((grown, base + more), (back, base)):
        assert result_lines(docs.where(F.col("doc_id").isin([i for i, _ in rows])), index) == brute_lines([(*r, None) for r in rows], 5)


def test_a_full_filter_is_built_anew(spark):
    line = lambda k: f"line {k} of forty characters and a little more"
    schema = "doc_id long, text string"
    small = [(i, line(0)) for i in range(5)]
    large = [(10 + i, "\n".join(line(k) for k in range(400))) for i in range(5)]
    index = line_dedup.LineIndex.build(spark.createDataFrame(small, schema), shards=2).insert(spark.createDataFrame(large, schema))
    rows = [(*r, None) for r in small + large]
    assert result_lines(spark.createDataFrame(small + large, schema), index) == brute_lines(rows, 5)


def test_cuckoo_filter():
    rng = np.random.default_rng(8)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    held = line_dedup.CuckooFilter.unpack(line_dedup.CuckooFilter.of(keys).pack())
    assert held.has(keys).all() and held.has(rng.integers(0, 2**63, 20000).astype(np.uint64)).mean() < 0.01
    for k in keys[:2500]:
        assert held.remove(int(k))
    assert held.has(keys[2500:]).all() and held.has(keys[:2500]).mean() < 0.01


# --- 10 classifier


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    x, owner, y = rng.normal(size=(9, quality_classifier.FEATURES)), np.array([0, 0, 1, 1, 1, 2, 3, 3, 3]), np.array([1.0, 0, 1, 0])
    shapes = {"E": (quality_classifier.FEATURES, 5), "e": 5, "V": (5, 3), "U": (5, 3), "w": 3, "c": 5, "b": 1}
    p = {k: rng.normal(0, 0.3, s) for k, s in shapes.items()}

    def loss(p):
        s = quality_classifier._forward(p, x, owner, 4)[-1]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for k, g in quality_classifier._gradients(p, x, owner, y).items():
        at = tuple(0 for _ in np.shape(p[k]))
        up, down = ({**p, k: p[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[at]) < 1e-6, k


def test_classifier_learns_and_scores_all(spark):
    rng = np.random.default_rng(2)
    good = [prose(rng, int(rng.integers(60, 300))) for _ in range(120)]
    bad = [" | ".join(rng.choice(WORDS, 80)) if i % 4 < 2 else " ".join(w.upper() + "!!" for w in rng.choice(WORDS, 80)) for i in range(60)]
    rows = [(i, t, "s") for i, t in enumerate([*good, *bad])] + [(500, None, None), (501, "", "s"), (None, "x", "s"), (3, good[3], "s")]
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(0, 180, 2)] + [(None, 1), (7, None)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality_classifier.fit(docs, labels)
    got = quality_classifier.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 180 and r.doc_id % 2]
    assert np.mean([r.predicted == int(r.doc_id < 120) for r in held]) > 0.95
    again = quality_classifier.score(docs, quality_classifier.fit(docs.repartition(5), labels)).collect()
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((str(r.doc_id), r.score) for r in again)
    none = quality_classifier.fit(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}
    assert T.DoubleType() == quality_classifier.score(docs, none).schema["score"].dataType
