"""The registered queries of this folder: each applies an operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.llm import (
    bpe_chunks, chosen_path, collocations, fingerprints, line_dedup, mixing, packing, paragraph_dedup, quality_classifier, quality_rules,
    repeated_bytes, spelling, token_store,
)
from pitchflow.llm.common import read, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op1_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder).select("doc_id", "text")
    out = paragraph_dedup.drop_repeats(docs)
    return out.withColumn("removed", F.col("n_removed") > 0).withColumnRenamed("text", "kept_text")


@query
def op2_token_store(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark)
    token_store.write(read(spark, folder).select("doc_id", "text"), out)
    return token_store.read(spark, out, ids=False)


@query
def op3_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.clean_lines(read(spark, folder).select("doc_id", "text"), limits=quality_rules.Limits(ends=True), clean_text=False)


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_edits(read(spark, folder).select("doc_id", "text"))


@query
def op5_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes.remove_repeats(read(spark, folder).select("doc_id", "text"), kept=False)


@query
def op6_mixture(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


@query
def op7_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.similarity_join(read(spark, folder).select("doc_id", "text"))


@query
def op8_chunk_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_chunks.transcode(read(spark, folder).select("doc_id", "text"), ("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder).select("doc_id", "text")
    cleaned = line_dedup.drop_repeated_lines(docs, line_dedup.LineIndex.build(docs, min_docs=5, min_chars=40))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL["op9_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
counted AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN counted USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


@query
def op10_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder).select("doc_id", "text")
    model = quality_classifier.fit(docs, read(spark, folder, "labels").where(~_held_out()))
    return quality_classifier.score(docs, model, keep_text=False).select("doc_id", _held_out().alias("held_out"), "score", "predicted")


SQL["op3_line_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
base AS (
  SELECT doc_id, len(w) AS n_words, length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, strlen(array_to_string(w, '')) AS size
  FROM words),
triples AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words WHERE len(w) > 2)),
often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM triples),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM often, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
    NOT regexp_matches(line, '[.!?:;"''”’)…。！？][\x20\x09-\x0D]*$') AS unended
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
stretches AS (
  SELECT *, unended AND len(w) < 10 AS short, sum(CASE WHEN unended AND len(w) < 10 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS stretch
  FROM lines),
runs AS (SELECT *, short AND count(*) FILTER (short) OVER (PARTITION BY doc_id, stretch) >= 3 AS menu FROM stretches),
judged AS (
  SELECT *, len(w) AS n, strlen(array_to_string(w, '')) AS chars,
    greatest(length(line) - length(replace(line, '|', '')), length(line) - length(replace(line, '»', '')),
      length(line) - length(replace(line, '›', '')), (length(line) - length(replace(line, ' > ', ''))) // 3,
      length(line) - length(replace(line, '•', ''))) >= 3
    OR (len(w) <= 40 AND len(list_filter(__PHRASES__, lambda x: contains(lower(line), x))) > 0)
    OR (len(w) >= 4 AND len(regexp_extract_all(line, '[!?]{2,}')) > 0.2::DOUBLE * len(w))
    OR (len(w) > 200 AND NOT regexp_matches(line, '[.!?:;"''”’)…。！？]'))
    OR (unended AND len(w) >= 10) OR menu
    OR length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 0.1::DOUBLE * length(line)
    OR (len(w) >= 4 AND length(regexp_replace(line, '[^\p{Lu}]', '', 'g')) > 0.6::DOUBLE * length(replace(line, ' ', ''))) AS bad
  FROM runs),
sums AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
    coalesce(sum(chars) FILTER (bad), 0) AS lost_chars
  FROM judged GROUP BY doc_id),
joined AS (
  SELECT base.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(lost_chars, 0) AS lost_chars
  FROM base LEFT JOIN sums USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_bad_lines,
  CASE WHEN size = 0 THEN 0.0::DOUBLE ELSE lost_chars::DOUBLE / size END AS lost,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5::DOUBLE * size AS kept
FROM joined
""".replace("__PHRASES__", "[" + ", ".join(f"'{x}'" for x in quality_rules.BOILERPLATE) + "]")


SQL["op7_chosen_path"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS text_id FROM documents),
t AS (SELECT text_id, min(text) AS text, min(doc_id) AS least, count(*) AS n_copies FROM d GROUP BY text_id),
w AS (SELECT text_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
s AS (
  SELECT DISTINCT text_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
sizes AS (SELECT text_id, count(*) AS k FROM s GROUP BY text_id),
pairs AS (SELECT a.text_id AS a, b.text_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.text_id <> b.text_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.text_id = a JOIN sizes y ON y.text_id = b WHERE 5 * shared >= 4 * (x.k + y.k - shared)),
reach(a, b) AS (SELECT text_id, text_id FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (SELECT a AS text_id, min(least) AS class_id FROM reach JOIN t ON t.text_id = b GROUP BY a),
counts AS (SELECT a AS text_id, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, d.text_id, class_id, n_copies, coalesce(n_links, 0) AS n_links
FROM d JOIN t USING (text_id) JOIN classes USING (text_id) LEFT JOIN counts USING (text_id)
"""


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read(spark, folder).select("doc_id", "text"), slips=31)


# A word loses its letter i; two words that share what is left after losing letter i have one letter replaced,
# a word that is what is left of another one is it with one letter deleted.
SQL["op11_spelling_variants"] = r"""
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, c, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 | (unicode(x) >> 6)::BIGINT, 128 | (unicode(x) & 63)::BIGINT] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, c, xor(list_reduce(list_concat([4294967295], b), lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, table_of),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS v
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.v = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.v = b.word),
near AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS best, max(m) AS most FROM pairs GROUP BY word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN best END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN near USING (word)),
way AS (
  SELECT word, word AS at FROM forms UNION SELECT way.word, forms.form FROM way JOIN forms ON way.at = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT way.word, way.at AS root FROM way JOIN forms ON way.at = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


@query
def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder).select("doc_id", "text"), ids=False)


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder).select("lang", "text"))


SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
words AS (SELECT lang, piece, unnest(w) AS x, unnest(range(len(w))) AS i FROM pieces WHERE len(w) > 0),
near AS (
  SELECT lang, x, lead(x, 1) OVER p AS y, lead(x, 2) OVER p AS z FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)),
f1 AS (SELECT lang, x, count(*) AS f FROM near GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM near WHERE y IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM near WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT p.lang, p.x || ' ' || p.y AS phrase, p.f AS a, 1 AS k, l.f AS l, r.f AS r,
    greatest((SELECT max(f) FROM f3 WHERE f3.lang = p.lang AND f3.x = p.x AND f3.y = p.y), (SELECT max(f) FROM f3 WHERE f3.lang = p.lang AND f3.y = p.x AND f3.z = p.y)) AS longer
  FROM f2 p JOIN f1 l ON l.lang = p.lang AND l.x = p.x JOIN f1 r ON r.lang = p.lang AND r.x = p.y WHERE p.f >= 10
  UNION ALL
  SELECT p.lang, concat_ws(' ', p.x, p.y, p.z), p.f, 1, l.f, r.f, NULL
  FROM f3 p JOIN f1 l ON l.lang = p.lang AND l.x = p.x JOIN f2 r ON r.lang = p.lang AND r.x = p.y AND r.y = p.z
  UNION ALL
  SELECT p.lang, concat_ws(' ', p.x, p.y, p.z), p.f, 2, l.f, r.f, NULL
  FROM f3 p JOIN f2 l ON l.lang = p.lang AND l.x = p.x AND l.y = p.y JOIN f1 r ON r.lang = p.lang AND r.x = p.z),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
