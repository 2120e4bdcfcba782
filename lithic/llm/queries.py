"""The operators of this subpackage bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lithic.llm import (
    alignment,
    extraction,
    language,
    minhash,
    mixing,
    neighbours,
    pieces,
    preferences,
    quality,
    ranked,
    sharding,
    toxicity,
    warc,
)
from lithic.sources.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, of: int) -> Column:
    """The remainder that says which rows are held out."""
    return F.crc32(F.col(key).cast("string")) % of


@query
def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of preference pairs, whose rejected side ends with the answer of another conversation.

    Every answered conversation makes a pair, and its chosen side has all of its turns.
    """
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return preferences.aligned(*preferences.with_neighbours_answer(turns))


ORACLES["op1_preferences"] = """
WITH named AS (
  SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), answers AS (
  SELECT pair_id, turn AS last_turn, text AS answer FROM named WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC NULLS LAST) = 1
), places AS (
  SELECT *, row_number() OVER (ORDER BY pair_id) - 1 AS n, count(*) OVER () - 1 AS highest FROM answers
), ends AS (
  SELECT a.pair_id, a.last_turn, b.answer FROM places a
    JOIN places b ON b.n = CASE WHEN a.n = a.highest AND a.n % 2 = 0 THEN a.n - 1 ELSE xor(a.n, 1) END
), left_turns AS (
  SELECT n.* FROM named n JOIN ends USING (pair_id)
), right_turns AS (
  SELECT n.* FROM named n JOIN ends USING (pair_id) WHERE turn < last_turn
  UNION ALL SELECT pair_id, last_turn, 'assistant', answer FROM ends
), l AS (
  SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) - 1 AS place,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM left_turns
), r AS (
  SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) - 1 AS place,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM right_turns
), cut AS (
  SELECT pair_id, min(CASE WHEN l.role IS DISTINCT FROM r.role OR l.text IS DISTINCT FROM r.text THEN place END) AS stop
  FROM l FULL JOIN r USING (pair_id, place) GROUP BY pair_id
), parts AS (
  SELECT l.*, CASE WHEN stop IS NULL OR place < stop THEN 'prompt' ELSE 'chosen' END AS part FROM l JOIN cut USING (pair_id)
  UNION ALL SELECT r.*, 'rejected' FROM r JOIN cut USING (pair_id) WHERE place >= stop
)
SELECT pair_id, part, place, role, '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head,
       replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body,
       part <> 'prompt' AND role = 'assistant' AS trained
FROM parts"""


@query
def op2_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs.select("doc_id", "text", "lang"), fold("doc_id", 3) != 1)
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out, "language.*")


@query
def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, compression ratios and verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.rate(docs).select("doc_id", "quality.*")


@query
def op4_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from confirmed toxic and unlabelled ones of four fifths."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, model, into="score")
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as counts and digests."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.with_pieces(docs, PIECES).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op6_rendered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extracted(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    indexed = neighbours.index(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return neighbours.search(indexed, F.col("id") % 20 == 0)


@query
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as archives in which repeated payloads are revisits, read back and resolved."""
    pages = read(spark, sf_dir, "pages")
    records = pages.select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").alias("payload"))
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.deduplicate(records), path)
    number = lambda name: F.regexp_extract(name, r"<urn:record:(-?\d+)>", 1).try_cast("long")
    return warc.resolve(warc.read_archives(spark, path, payloads=False)).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes, split by source, language and length."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    return sharding.partition(docs, ("source", "lang", "n_chars"), shards=8)


@query
def op12_range_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item, by an index of all documents."""
    indexed = ranked.index(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return ranked.search(indexed, read(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLES["op12_range_maxima"] = r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT doc_id, r, len(terms) AS n, unnest(terms) AS term FROM lowered
), counts AS (
  SELECT doc_id, r, n, term, count(*) AS tf FROM words GROUP BY ALL
), stats AS (
  SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM lowered WHERE len(terms) > 0
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, stats GROUP BY term
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), scored AS (
  SELECT item_id, doc_id, r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term), stats GROUP BY ALL
), ranks AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranks WHERE rank <= 50"""


@query
def op13_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' encodings of every document fit each other, with counts over all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, (*BYTE_LEVEL, PIECES))
