"""Registered queries of the corpus operators: thin forms with fixed parameters over whole tables."""

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, embedding_dedup, exact_dedup, language_model, licences, lines, mixing, packing, periodic, quality, repeats, simhash, toxicity
from .common import fold, table


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS name, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT name, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY name),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY name = '', name) - 1) % 3] AS weight, 2 * source_size AS cap FROM s),
r AS (SELECT *, CAST(cap AS DOUBLE) / weight AS ratio FROM w),
l AS (SELECT ratio, row_number() OVER o AS n, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
    - CAST(coalesce(sum(cap) OVER e, 0) AS DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS level FROM r
    WINDOW o AS (ORDER BY ratio, name), e AS (ORDER BY ratio, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT arg_min(level, n) AS level FROM l WHERE level <= ratio),
t AS (SELECT name, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM w, v),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(sum(d.size) OVER (PARTITION BY d.name ORDER BY d.k, d.doc_id, d.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN t ON d.name = t.name)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
    CAST(floor(target) AS BIGINT) // source_size * size
    + greatest(0, least(size, CAST(floor(target) AS BIGINT) % source_size - before)) END AS BIGINT) AS taken FROM p
"""


def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = language_model.train(docs.filter(fold("doc_id") != 1))
    return language_model.score(docs, model).withColumn("held_out", fold("doc_id") == 1)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), F.col("_score").alias("score"),
        F.col("_good").cast("int").alias("predicted"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = exact_dedup.mark_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return marked.withColumnRenamed("digest", "text_sha256")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents),
g AS (SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY content)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM d JOIN g USING (content)
"""


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    AND list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.9),
n AS (SELECT a, count(*) AS links FROM l GROUP BY a),
r(vec_id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.a, r.root FROM r JOIN l ON l.b = r.vec_id),
m AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id)
SELECT m.vec_id, coalesce(n.links, 0) AS n_links, component_id, m.vec_id = component_id AS kept FROM m LEFT JOIN n ON n.a = m.vec_id
"""


def op6_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(table(spark, folder, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda p: p["start"])
    named = F.transform("places", lambda p: p["label"])
    more = F.transform("spans", lambda s: s["label"])
    cover = F.array_max(F.transform("spans", lambda s: F.least(s["cover"], F.lit(1.0))))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(named, more)), ",").alias("labels"),
        F.coalesce(cover, F.lit(0.0)).alias("score"))


def licence_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The part of the licence scan that SQL can say: words and places of the phrases (-1: none)."""
    ends = [F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("first_word", "last_word")]
    return op6_licence_scan(spark, folder).select("doc_id", "n_words", "n_base", *ends, "base_labels")


def _phrase_places() -> str:
    parts = []
    for phrase, label in licences.PHRASES.items():
        words = phrase.split()
        list_ = ", ".join(f"'{w}'" for w in words)
        parts.append(f"SELECT r, i - 1 AS spot, '{label}' AS label FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - {len(words) - 1})) AS i FROM d) "
                     f"WHERE ws[i:i + {len(words) - 1}] = [{list_}]")
    return " UNION ALL ".join(parts)


LICENCE_PHRASES_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS ({_phrase_places()}),
g AS (SELECT r, count(*) AS n, min(spot) AS first, max(spot) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, coalesce(first, -1) AS first_word, coalesce(last, -1) AS last_word, coalesce(labels, '') AS base_labels
FROM d LEFT JOIN g USING (r)
"""


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path())


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "language")


def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) != max(doc_id)),
m AS (SELECT k.*, coalesce(f.first != doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id, r
"""


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokens(table(spark, folder, "documents").select("doc_id", "text"),
                                  tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def planted(name: str, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten repeat with a period from some word on, place and period by the id's crc32."""
    h = zlib.crc32(name.encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(table(spark, folder, "documents").select("doc_id", "text"), prepare=planted)
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("least"), r["start"].alias("start"), r["period"].alias("period"))))
    lines_of = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("b"),
                        F.sha2(F.array_join(lines_of, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", F.col("b.start").alias("start"), (-F.col("b.least")).alias("length"),
                       F.col("b.period").alias("period"), F.expr("-1000 * b.least div b.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


QUERIES = {
    "op1_mix_sources": (op1_mix_sources, OP1_SQL),
    "op2_lm_scores": (op2_lm_scores, None),
    "op3_quality": (op3_quality, None),
    "op4_exact_dedup": (op4_exact_dedup, OP4_SQL),
    "op5_embedding_near_dedup": (op5_embedding_near_dedup, OP5_SQL),
    "op6_licence_scan": (op6_licence_scan, None),
    "op7_pack_documents": (op7_pack_documents, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_repeated_passages": (op9_repeated_passages, None),
    "op10_simhash": (op10_simhash, None),
    "op11_line_dedup": (op11_line_dedup, OP11_SQL),
    "op12_token_alignment": (op12_token_alignment, None),
    "licence_phrases": (licence_phrases, LICENCE_PHRASES_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
