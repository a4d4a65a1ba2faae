"""A corpus from documents: five stages, each on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline.llm import bpe, jaccard, langid, mixing, substrings
from sheafline.llm.staging import Tables

#: Share of the tokens that the mixture takes, and weights of its nodes; others weigh 1.
SHARE = 0.8
WEIGHTS = {("common",): 1.0, ("curated",): 2.0, ("common", "en"): 2.0, ("curated", "en"): 3.0}
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Ids of near duplicates that are broadcast at most (32 MB).
MOST_BROADCAST = 2_000_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` becomes the language found."""
    model = langid.fit(docs)
    found = docs.withColumn("found_language", langid.predict("text", model))
    kept = found.filter(~F.col("found_language.rejected"))
    return kept.withColumn("lang", F.col("found_language.lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Rows of that id with different texts all stay, and of those with one text one does. A row
    without an id stays. Texts are not shuffled but for ids of several rows: marks of ids
    are broadcast if there are no more than ``MOST_BROADCAST``, and joined by shuffle beyond that.
    """
    groups = jaccard.near_duplicates(docs.select("doc_id", "text"))
    found = F.struct(
        F.max(F.col("doc_id") != F.col("component_id")).alias("goes"), (F.count(F.lit(1)) > 1).alias("repeated")
    )
    # longer than the names of all columns, so equal to none
    mark = f"{max(docs.columns, key=len)}_"
    marks = groups.filter("doc_id is not null").groupBy("doc_id").agg(found.alias(mark))
    marks = marks.filter(F.col(f"{mark}.goes") | F.col(f"{mark}.repeated"))
    marked = docs.join(F.broadcast(marks) if marks.count() <= MOST_BROADCAST else marks, "doc_id", "left")
    stays = marked.filter(F.col(mark).isNull() | ~F.col(f"{mark}.goes"))
    several = F.col(mark).isNotNull()
    once = stays.filter(several).dropDuplicates(["doc_id", "text"])
    return stays.filter(~several).unionByName(once).select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; documents left without a word go."""
    cut = substrings.remove_repeated(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    kept = cut.filter((F.col("n_removed") < F.col("n_words")) | (F.col("n_removed") == 0))
    return kept.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mixture of domains, languages and sources by weight, each document once at most."""
    domain = F.when(F.col("source") == "src0", "common").otherwise("curated")
    levels = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return mixing.mix(docs, levels=levels, tokens=words, share=SHARE, weights=WEIGHTS).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    ids = bpe.encode("text", ranks=RANKS, pattern=public_tokenizers.PATTERN)
    encoded = docs.select("doc_id", "lang", "source", "text", ids.alias("ids"))
    decoded = encoded.withColumn("decoded", bpe.decode("ids", ranks=RANKS))
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Models, components and merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What passes between stages is a table in the checkpoint folder, deleted once the next one is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES[:-1]:
        tables = Tables(spark)
        docs = tables.stored(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        before = tables
    return STAGES[-1][1](spark, docs, sf_dir)
