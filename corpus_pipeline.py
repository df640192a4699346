"""The corpus pipeline: five stages from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared folder
and reads it back as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, minhash, packing, substring, toxicity
from tessera.llm.common import discard, free_name, materialise, table
from tessera.llm.queries import vocabulary

#: A document stays if its language is known with this score at least.
LEAST_LANGUAGE_SCORE = 0.3
#: Documents scored at least this are toxic.
TOXIC_FROM = 0.5
#: Words of the shortest passage that is removed where it repeats.
REPEAT_WORDS = 50
CAPACITY, END = 1024, 2
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; null texts and texts without letters go. Learned from the documents' own lang column."""
    lang, score = free_name(docs, "_lang"), free_name(docs, "_score")
    got = langid.identify(docs, langid.fit(docs), lang=lang, score=score)
    return got.filter((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from labels does not find toxic."""
    score = free_name(docs, "_score")
    got = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), name=score)
    return got.filter(F.col(score) < TOXIC_FROM).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the one of the smallest id.

    Rows without an id all stay. Of rows that repeat an id and its text one stays, the least of them written as JSON;
    an id with several texts keeps one row of each, for none of them stands for the others.
    """
    groups = minhash.near_duplicates(docs, width=5, percent=80)
    gone = materialise(groups.filter(~F.col("kept")).select("doc_id").distinct(), "gone")
    repeated = materialise(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    several = kept.join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("k"), F.xxhash64("text").alias("h"), row.alias("r"), F.to_json(row).alias("j"))
    several = several.groupBy("k", "h").agg(F.min_by("r", "j").alias("r")).select("r.*")
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(several)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of REPEAT_WORDS words or more that start earlier; documents of which nothing is left go. n_chars follows the text."""
    got = substring.dedup(docs, REPEAT_WORDS)
    changed = F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        got = got.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return got.filter(~changed | (F.col("n_removed") < F.col("n_words"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of CAPACITY tokens."""
    pieces = materialise(packing.token_pieces(docs, vocabulary("byte_bpe_50k.json"), END, CAPACITY), "pieces")
    got = packing.pack(pieces, CAPACITY, order=("doc_id", "piece", "ids_crc32"))
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language", language), ("toxicity", nontoxic), ("near_duplicates", near_duplicates), ("repeats", repeats), ("packing", packed)]

#: Learned scores, hashes and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        got = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        if i:
            discard(docs)
        docs = got
    return docs
