"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import codec, conversations, counts, embeddings, fim, langid, minhash, packing, planes, quality, sharding, substring, toxicity
from tessera.llm.common import materialise, new_path, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(f):
    QUERIES[f.__name__] = f
    return f


def part_of(key: str, parts: int):
    """crc32 of the id as text, modulo parts: how rows are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


@register
def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality.cascade(table(spark, sf_dir, "documents"), quality.RULES, figures=figures, first=(quality.TOO_SHORT, quality.REPETITIVE))
    return got.select("doc_id", *figures, F.col("first_failed").alias("base_failed"), "kept")


ORACLE["op2_quality_cascade"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT r, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT r, i, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c FROM p WINDOW x AS (PARTITION BY r ORDER BY i)),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g WHERE c IS NOT NULL),
rep AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM k WHERE n > 1) GROUP BY r),
q AS (SELECT r, i, lead(i, 7) OVER x AS far, concat_ws(' ', a, lead(a) OVER x, lead(a, 2) OVER x, lead(a, 3) OVER x, lead(a, 4) OVER x, lead(a, 5) OVER x, lead(a, 6) OVER x, lead(a, 7) OVER x) AS g FROM p WINDOW x AS (PARTITION BY r ORDER BY i)),
k8 AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM q WHERE far IS NOT NULL),
far AS (SELECT r, count(DISTINCT j) AS n_long_repeats FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM k8 WHERE n > 1) GROUP BY r),
top AS (SELECT r, max(n) AS n_top_pair FROM (SELECT r, count(*) AS n FROM g WHERE b IS NOT NULL GROUP BY r, a, b) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT s) AS n_dup_lines FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM d) WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_long_repeats, 0) AS n_long_repeats, coalesce(n_top_pair, 0) AS n_top_pair,
    length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]+', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-zÀ-ÖØ-öø-ÿ]+', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^!]+', '', 'g')) AS n_bangs
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN l USING (r) LEFT JOIN far USING (r) LEFT JOIN top USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * n_words OR 100 * n_upper > 60 * n_letters OR 100 * n_bangs > 50 * n_words
    OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR (100 * n_top_pair > 10 * n_words AND n_top_pair > 1) OR 100 * n_long_repeats > 40 * n_words) AS kept
FROM f
"""


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.filter(part_of("doc_id", 5) != 0))
    got = toxicity.score(docs.select("doc_id", "text"), lexicon)
    return got.select("doc_id", (part_of("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@register
def op8_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("doc_id", "text").alias("key"))
    got = sharding.shard_by_bytes(materialise(rows, "op8"), 24, "key", "size", order=("doc_id", "text_crc32"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@register
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(part_of("doc_id", 4) != 2))
    got = langid.identify(docs.select("doc_id", "text"), model)
    return got.select("doc_id", (part_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; public_tokenizers is part of the installation, not of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = planes.write(table(spark, sf_dir, "documents"), new_path(spark, "ids"), vocabulary("word_bpe_49k.json"), end_id=1)
    return planes.read(spark, files)


@register
def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), ids=False, digests=True)


@register
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = materialise(packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 2, 1024), "op9")
    got = packing.pack(pieces, 1024, order=("doc_id", "piece", "ids_crc32"))
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register
def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@register
def op7_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


@register
def op5_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), 20, keep=False)
    return got.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op5_seed_extend"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p, ws FROM w WHERE len(ws) >= 20),
g AS (SELECT doc_id, p, row_number() OVER (PARTITION BY list_aggregate(ws[p:p + 19], 'string_agg', ' ') ORDER BY doc_id, p) AS k FROM s),
c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(p, p + 20)) AS j FROM g WHERE k > 1) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(ws) AS n, coalesce(gone, []) AS gone, ws FROM w LEFT JOIN c USING (doc_id)),
x AS (SELECT doc_id, n, len(gone) AS gone_n, CASE WHEN len(gone) = 0 THEN ws ELSE list_transform(list_filter(list_zip(ws, range(1, n + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END AS k FROM f)
SELECT doc_id, n::BIGINT AS n_words, gone_n::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM x
"""


@register
def op11_array_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return got.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@register
def op12_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(rows), rows)


@register
def op13_event_scan_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    output, restored = digest(F.col("fim.output")), digest(fim.restore(F.col("fim.output"), F.col("fim.form")))
    return got.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", output.alias("output_sha256"), restored.alias("restored_sha256"))


ORACLE["op13_event_scan_fim"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:z], '') AS mid, array_to_string(u[z + 1:], '') AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS out FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(out) AS output_sha256, sha256(t) AS restored_sha256 FROM o
"""
