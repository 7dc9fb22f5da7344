"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Sizes are summed per source; a source's target is its weight's share of the
   words to mix, at most ``MAX_EPOCHS`` times its own size. What that cuts off is
   shared among the others by weight until nobody is above.
2. A source's documents stand in a random order (a hash of the id). Passing
   over that order again and again until the target is met gives its stream;
   the stream is cut into blocks of about ``block_words``. The last, partial
   pass first settles its largest documents, those over a 64th of the source
   (63 at most), by subset sums, then takes the others in order up to what is
   left, and last the ones that fit into the rest.
3. The blocks are dealt to output shards by a splitting tree: a node's blocks
   go half to the left, half to the right, and how many of each source go left
   is one multivariate hypergeometric draw, as if the node's blocks had been
   shuffled and cut in the middle. So each shard gets whole-number quotas that
   add up exactly, and is a fair sample of the mixture.
4. Shards take consecutive, hence disjoint, runs of a source's permuted block
   numbers; inside a shard the rows are sorted by a hash.

Only DataFrame and SQL functions are used. The tree has one row per node with
an array over sources. Nothing but counts per (source, bucket) is ever brought
together: running sums are taken inside hash buckets of a source, so a source
that holds a third of all rows is spread over ``buckets`` tasks. Every draw is a
function of the seed and the data: a task that runs again, and a rerun, agree,
since rows are ordered by hash, id, size and a digest of their columns (maps
aside); what these leave tied is alike.

Null sources are one source, the last. A null or empty text has size 0 and is
never taken, nor is anything when all sizes are 0. Repeated rows are rows like
others. Extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import WORD, fresh, quoted, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20
#: Turns of filling the rest of a partial pass with one document each, and the steps of sums that its largest documents are told apart by.
FILLERS, STEPS = 3, 1000
#: A document of more than this part of its source is one of its largest; there are fewer than 64, a bit of a number for each.
LARGE = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, size)`` per source to ``(source, source_size, target)``.

    Capping is water filling: sources are ordered by how soon they reach their
    cap as all targets grow by weight, and a prefix of that order is capped. The
    prefix is found by running sums, without rounds. One row per source.
    """
    listed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    arrays = listed.agg(F.array_sort(F.collect_list(F.struct(
        F.col("source").isNull().alias("last"), F.col("source"), F.col("source_size")
    ))).alias("s"))
    w = ", ".join(f"{float(x)!r}D" for x in weights)
    weighed = arrays.selectExpr(
        f"posexplode(transform(s, (x, i) -> named_struct('source', x.source, 'size', x.source_size, 'w', array({w})[i % {len(weights)}])))"
        " AS (_n, x)"
    ).selectExpr("_n", "x.source AS source", "x.size AS source_size", "x.w AS w", f"{float(max_epochs)!r}D * x.size AS cap")
    ranked = weighed.selectExpr("*", "cap / w AS reach").agg(
        F.array_sort(F.collect_list(F.struct("reach", "_n", "source", "source_size", "w", "cap"))).alias("r"),
        F.sum("w").alias("all_w"), (F.sum("source_size") * F.lit(float(share))).alias("want"),
    )
    # level: words per unit of weight for those not capped, after capping the first k that overflow.
    level = """aggregate(r, named_struct('left', want, 'w', all_w, 'done', false), (a, x) -> if(a.done OR a.w <= 0 OR a.left / a.w <= x.reach,
        named_struct('left', a.left, 'w', a.w, 'done', true),
        named_struct('left', a.left - x.cap, 'w', a.w - x.w, 'done', false)))"""
    return ranked.selectExpr("r", f"{level} AS v").selectExpr(
        "inline(transform(r, x -> named_struct('source', x.source, 'source_size', x.source_size,"
        " 'target', if(x.cap <= 0, 0D, if(NOT v.done, x.cap, least(x.cap, x.w * v.left / v.w))))))"
    )


def _draw(k: str, n: str, total: str, u: str) -> str:
    """SQL for how many of ``k`` marked items are among ``n`` drawn from ``total``: the inverse of the distribution at ``u``.

    Probabilities are built up from the mode by the ratios of neighbours, over
    14 standard deviations to both sides; what lies beyond is below 1e-20.
    """
    low, high = f"greatest(0L, {n} + {k} - {total})", f"least({n}, {k})"
    mode = f"greatest({low}, least({high}, bigint(floor((({n}) + 1D) * (({k}) + 1D) / (({total}) + 2D)))))"
    sd = f"sqrt(greatest(1D, double({n}) * {k} / greatest({total}, 1) * ({total} - {k}) / greatest({total}, 1) * ({total} - {n}) / greatest({total} - 1, 1)))"
    span = f"named_struct('a', greatest({low}, {mode} - bigint(14 * {sd}) - 3), 'm', {mode}, 'b', least({high}, {mode} + bigint(14 * {sd}) + 3))"
    up = f"(double({k} - x + 1) * ({n} - x + 1)) / (double(x) * greatest({total} - {k} - {n} + x, 1))"
    down = f"(double(x + 1) * ({total} - {k} - {n} + x + 1)) / (double({k} - x) * ({n} - x))"
    return f"""element_at(transform(array({span}), g ->
        element_at(transform(array(named_struct(
            'up', if(g.b > g.m, aggregate(sequence(g.m + 1, g.b), array(1D), (a, x) -> concat(a, array(element_at(a, -1) * {up}))), array(1D)),
            'dn', if(g.a < g.m, aggregate(sequence(g.m - 1, g.a), array(1D), (a, x) -> concat(a, array(element_at(a, -1) * {down}))), array(1D)))),
        p -> g.a + aggregate(concat(reverse(slice(p.dn, 2, size(p.dn))), p.up),
            named_struct('left', {u} * (aggregate(p.up, 0D, (s, x) -> s + x) + aggregate(p.dn, -1D, (s, x) -> s + x)), 'at', 0L),
            (s, x) -> if(s.left < 0, s, named_struct('left', s.left - x, 'at', if(s.left - x < 0, s.at, s.at + 1))),
            s -> least(s.at, g.b - g.a))), 1)), 1)"""


def split_quotas(quotas: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """One row with ``quotas`` (array over sources) to ``(shard, quotas)`` for ``2 ** levels`` shards."""
    nodes = quotas.selectExpr("0L AS shard", "quotas")
    for level in range(levels):
        total, half = "aggregate(quotas, 0L, (s, x) -> s + x)", "_n"
        u = f"((xxhash64({seed}, {level}, shard, size(t.out)) & 4503599627370495L) + 0.5D) / 4503599627370496D"
        draw = _draw("k", "t.n", "t.total", u)
        step = f"""element_at(transform(array({draw}), d -> named_struct('total', t.total - k, 'n', t.n - d, 'out', concat(t.out, array(d)))), 1)"""
        left = f"""aggregate(quotas, named_struct('total', {total}, 'n', {half}, 'out', cast(array() AS array<bigint>)), (t, k) -> {step}, t -> t.out)"""
        nodes = (
            nodes.selectExpr("shard", "quotas", f"({total} + pmod(xxhash64({seed}, {level}, shard), 2)) div 2 AS _n")
            .selectExpr("shard", "quotas", f"{left} AS lefts")
            .selectExpr("shard", "explode(array(named_struct('s', 0L, 'q', lefts), named_struct('s', 1L, 'q', zip_with(quotas, lefts, (a, b) -> a - b)))) AS x")
            .selectExpr("shard * 2 + x.s AS shard", "x.q AS quotas")
        )
    return nodes


def _subset(large: str, part: str, size: str) -> str:
    """SQL for those of ``large`` that a partial pass over ``part`` words takes.

    What they leave is for the other documents, ``size`` less all the large ones;
    of the sums that leave neither too much nor too little the one nearest to the
    large documents' share is taken, else the nearest one. Sums are told apart by
    ``STEPS`` of the part, each kept with its set as the bits of a number.
    """
    step = f"greatest(1L, bigint({part} / {STEPS}))"
    every = f"""aggregate(sequence(0, size({large}) - 1), array(named_struct('s', 0L, 'm', 0L)), (sums, i) -> element_at(transform(
        array(array_sort(concat(sums, transform(filter(sums, t -> t.s <= {part}),
            t -> named_struct('s', t.s + {large}[i].size, 'm', t.m | shiftleft(1L, i)))))),
        z -> filter(z, (t, j) -> j = 0 OR t.s div {step} <> z[j - 1].s div {step})), 1))"""
    total = f"aggregate({large}, 0L, (s, x) -> s + x.size)"
    off = f"greatest(0D, t.s - {part}, {part} - ({size} - {total}) - t.s)"
    best = f"array_min(transform({every}, t -> named_struct('off', {off}, 'far', abs(t.s - {part} * {total} / {size}), 'm', t.m))).m"
    return f"if(size({large}) = 0, {large}, element_at(transform(array({best}), m -> filter({large}, (x, i) -> (m & shiftleft(1L, i)) <> 0)), 1))"


def _among(large: str, at: str) -> str:
    """SQL for the place of a document that starts at ``at`` when the ``large`` ones are left out."""
    return f"({at} - aggregate({large}, 0L, (s, x) -> s + if(x.at < {at}, x.size, 0L)))"


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, block_words: int = 50_000,
    levels: int = 4, buckets: int = 256, seed: int = SEED, doc_id: str = "doc_id", source: str = "source", size: Column | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``draws``: an array of ``(epoch, shard, block)``, one for each time it is taken.

    A document's draw belongs to the block in which it starts in its source's
    stream. A source's taken words miss its target by less than one of its smaller
    documents, and by far less where sizes are many, unless no choice of
    documents comes near it.
    """
    words = word_count(F.col("text")) if size is None else size
    names = [quoted(n) for n in docs.columns if n not in ("size", "source_size", "target", "draws")]
    h, b, at, key, words_of, tie = fresh(docs, "_mix_h", "_mix_b", "_mix_at", "_mix", "_mix_words", "_mix_t")
    hashed = F.xxhash64(F.lit(seed), F.col(doc_id))
    told = [quoted(f.name) for f in docs.schema.fields if not re.search("map<|variant|interval", f.dataType.simpleString())]
    wide = docs.withColumn(words_of, words).withColumn(h, hashed).withColumn(b, F.pmod(h, F.lit(buckets))).withColumn(tie, F.xxhash64(*told))
    narrow = stored(wide.selectExpr(f"{quoted(doc_id)} AS _id", f"{quoted(source)} AS source", f"{words_of} AS size", f"{h} AS _h", f"{b} AS _b", f"{tie} AS _t"))

    sums = stored(narrow.groupBy("source", "_b").agg(F.sum("size").alias("size")))
    running = "(PARTITION BY source ORDER BY _b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = sums.selectExpr("source", "_b", f"coalesce(sum(size) OVER {running}, 0L) AS _start")
    targets = stored(source_targets(sums, weights, share, max_epochs).selectExpr(
        "*", f"if(target <= 0, 0L, greatest(1L, bigint(ceil(target / {float(block_words)!r}D)))) AS quota",
        "if(target <= 0, 0L, bigint(floor(target / source_size))) AS full",
    ).withColumn("part", F.expr("target - full * source_size")))

    def placed(rows: DataFrame, plan: DataFrame, by: str, bucket: str, order: str, n: str) -> DataFrame:
        """``rows`` with their place in the source's order and the columns of ``plan``, all under new names."""
        info = starts.alias("x").join(plan.alias("p"), F.expr("x.source <=> p.source")).selectExpr(
            f"x.source AS {key}_s", f"x._b AS {key}_c", f"_start AS {key}_start", *[f"p.{n} AS {key}_{n}" for n in plan.columns if n != "source"]
        )
        inside = f"(PARTITION BY {by}, {bucket} ORDER BY {order}, {n} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        out = rows.selectExpr("*", f"coalesce(sum({n}) OVER {inside}, 0L) AS {at}")
        # A row per (source, bucket) on the right; the left side is large, and its hot sources are many buckets.
        same = F.expr(f"{by} <=> {key}_s AND {bucket} = {key}_c")
        return out.join(info, same, "left").withColumn(at, F.col(f"{key}_start") + F.col(at))

    # The part of an epoch that is left over: its largest documents by subset sums, of the others those that end before it does, and
    # then, ``FILLERS`` times, the largest other one that still fits; the last time the one that comes nearest.
    order = stored(placed(narrow, targets, "source", "_b", "_h, _id, _t", "size").where(f"size > 0 AND {key}_part > 0"))
    large = order.where(f"size > {key}_source_size div {LARGE}").groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), "size"))).alias("large")
    )
    none = "cast(array() AS array<struct<at: bigint, size: bigint>>)"
    settled = targets.where("part > 0").alias("t").join(large.alias("l"), F.expr("t.source <=> l.source"), "left").selectExpr(
        "t.source", "part", "source_size", f"coalesce(large, {none}) AS large"
    ).withColumn("chosen", F.expr(_subset("large", "part", "source_size")))
    settled = stored(settled.selectExpr(
        "source", "large", "transform(chosen, x -> x.at) AS chosen", "part - aggregate(chosen, 0L, (s, x) -> s + x.size) AS room",
    ))
    others = stored(order.where(f"size <= {key}_source_size div {LARGE}").alias("o").join(
        settled.alias("s"), F.expr("o.source <=> s.source")
    ).selectExpr("o.source", "size", "room", at, f"{_among('large', at)} AS _place"))
    fill = others.groupBy("source").agg(
        F.max(F.expr("if(_place + size <= room, _place + size, 0L)")).alias("got"), F.max("room").alias("room"),
        F.expr("cast(array() AS array<bigint>)").alias("fillers"),
    )
    for turn in range(FILLERS):
        fill = stored(fill)
        rest = others.alias("o").join(fill.alias("w"), F.expr("o.source <=> w.source")).where(
            f"_place + size > w.room AND NOT array_contains(fillers, {at})"
        )
        off = "abs(size - (w.room - got))"
        fits = f"{off} < w.room - got" if turn == FILLERS - 1 else "size <= w.room - got"
        best = rest.groupBy("o.source").agg(F.min(F.expr(f"if({fits}, struct({off} AS off, {at} AS at, size), NULL)")).alias("f"))
        fill = fill.alias("w").join(best.alias("b"), F.expr("w.source <=> b.source"), "left").selectExpr(
            "w.source", "got + coalesce(f.size, 0L) AS got", "room", "if(f IS NULL, fillers, concat(fillers, array(f.at))) AS fillers"
        )
    fill = settled.alias("s").join(fill.alias("w"), F.expr("s.source <=> w.source"), "left").selectExpr(
        "s.source", "large", "s.room", "concat(chosen, coalesce(fillers, cast(array() AS array<bigint>))) AS fillers"
    )
    filled = targets.alias("t").join(fill.alias("f"), F.expr("t.source <=> f.source"), "left")
    filled = filled.selectExpr("t.*", "coalesce(f.fillers, cast(array() AS array<bigint>)) AS fillers", f"coalesce(large, {none}) AS large", "room")

    ordered = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "quota")))
    quotas = targets.agg(ordered.alias("s")).selectExpr("transform(s, x -> x.quota) AS quotas", "transform(s, x -> x.source) AS sources")
    shares = split_quotas(quotas, levels, seed).selectExpr("shard", "posexplode(quotas) AS (n, q)")
    shares = shares.join(F.broadcast(quotas.selectExpr("posexplode(sources) AS (n, source)")), "n")
    # Running totals of a source's quotas in shard order: the block number at which each shard ends.
    ends = shares.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", "q"))).alias("qs")).selectExpr(
        "source", "aggregate(qs, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + x.q)), a -> slice(a, 2, size(a))) AS ends"
    )
    plan = stored(filled.alias("t").join(F.broadcast(ends).alias("e"), F.expr("t.source <=> e.source"), "left").selectExpr("t.*", "e.ends"))

    joined = placed(wide, plan, quoted(source), b, f"{h}, {quoted(doc_id)}, {tie}", words_of)
    early = f"{words_of} <= {key}_source_size div {LARGE} AND {_among(f'{key}_large', at)} + {words_of} <= {key}_room"
    more = f"{key}_part > 0 AND ({early} OR array_contains({key}_fillers, {at}))"
    epochs = f"if({words_of} = 0 OR {key}_target <= 0, 0, int({key}_full) + int({more}))"
    block = f"least({key}_quota - 1, bigint(floor((e * {key}_source_size + {at}) / {key}_target * {key}_quota)))"
    # A one-to-one map of block numbers: the factor is a prime beyond any quota.
    turned = f"pmod({block} * (2147483647L % {key}_quota) + {seed}, {key}_quota)"
    shard = f"size(filter({key}_ends, x -> x <= {turned}))"
    draws = f"transform(if({epochs} = 0, cast(array() AS array<int>), sequence(0, {epochs} - 1)), e -> named_struct('epoch', e, 'shard', {shard}, 'block', {turned}))"
    return joined.selectExpr(*names, f"{words_of} AS size", f"{key}_source_size AS source_size", f"{key}_target AS target", f"{draws} AS draws")


def mixture(mixed: DataFrame, doc_id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The mixture itself: one row per draw with its ``draw`` instead of ``draws``, shards apart and each in its own random order."""
    rows = mixed.select(*[quoted(n) for n in mixed.columns if n not in ("draw", "draws")], F.explode("draws").alias("draw"))
    order = F.xxhash64(F.lit(seed), F.col("draw.shard"), F.col("draw.epoch"), F.col(doc_id))
    return rows.repartition("draw.shard", "draw.block").sortWithinPartitions("draw.shard", order)
