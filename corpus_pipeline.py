"""From raw documents to token ids: quality rules, language, near-duplicates, a mix of the sources, encoding.

Each stage reads what its predecessor has written. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lithic.llm import language, minhash, mixing, pieces, quality
from lithic.sources.shared import stable

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Texts whose best language scores below this are in none of the languages learned.
LEAST_SCORE = 0.3


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands. Null and empty texts go."""
    into = unused(docs, "quality")
    return quality.rate(docs, into=into).where(F.col(into)["kept"]).drop(into)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that two thirds of the documents name.

    Texts without a letter go, and those too unlike all languages. Where no document names its language there is nothing
    to tell them apart by, and all stay.
    """
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    model = language.fit(docs.select("doc_id", "text", "lang"), learn)
    if not model.languages:
        return docs
    into = unused(docs, "language")
    known = (F.col(into)["lang_pred"] != language.UNKNOWN) & (F.col(into)["score"] >= LEAST_SCORE)
    return language.identify(docs, model, into=into).where(known).drop(into)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, and all that have no id."""
    classes = minhash.near_duplicates(docs.select("doc_id", "text"))
    gone = stable(classes.where(~F.col("kept")).select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def first_words(text: Column, n: Column) -> Column:
    """A text up to its ``n``-th word."""
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + mixing.WORD), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last pass that ends within a document has its first words alone.

    ``n_chars`` is that of the text. Rows that are alike in id and text share evenly what the mix takes of them.
    """
    names = {c: unused(docs, c) for c in ("id", "twin", "size", "taken", "copy")}
    key, twin, size, taken, copy = names.values()
    mixed = mixing.mix(docs.select("doc_id", "text", "source"), keep_twin=True)
    shares = mixed.groupBy("doc_id", "twin").agg(F.first("size").alias(size), F.floor(F.avg("taken")).alias(taken))
    shares = shares.where(F.col(taken) > 0).withColumnsRenamed({"doc_id": key, "twin": twin})
    own = mixing.twin("text")
    met = docs.join(shares, docs["doc_id"].eqNullSafe(shares[key]) & (own == shares[twin]))
    passes = F.expr(f"cast({taken} div {size} as int)")
    rest = F.col(taken) % F.col(size)
    whole = F.transform(F.sequence(F.lit(0), passes), lambda k: F.when(k < passes, F.col(size)).otherwise(rest))
    copies = met.withColumn(copy, F.explode(F.filter(whole, lambda n: n > 0)))
    cut = F.when(F.col(copy) == F.col(size), F.col("text")).otherwise(first_words(F.col("text"), F.col(copy)))
    copies = copies.withColumn("text", cut)
    return copies.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, little-endian unsigned 32-bit integers, and digests of them and of what they say."""
    encoded = pieces.with_pieces(docs.select("doc_id", "text", "lang", "source"), PIECES)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: Compression, trained models and token ids are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stable(stage(spark, docs, sf_dir))
    return docs
