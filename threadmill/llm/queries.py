"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm import (
    bytepair, covertree, hamming, jaccard, language, lexical, mixing, packing, quality, resampling, sanitise, sharding,
    toxicity,
)
from threadmill.llm.common import read, remainder, ship_package
from threadmill.llm.oracle import JACCARD_SQL, LEXICAL_SQL, RESAMPLE_SQL, TOP_SQL, mix_sql, pii_sql
from threadmill.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SHARDS = 24
BATCH_ROWS = 1000
#: Shares of the mix; all other sources share one part. Blocks have so many rows.
MIX_WEIGHTS = {"src0": 6, "src1": 4, "src2": 4, "src3": 3, "src4": 3, "src5": 2, "src6": 2} | {
    f"src{i}": 1 for i in range(7, 20)
}
MIX_BLOCK = 32


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark = prepare(spark)
        # Texts may be long; a batch for Python holds fewer of them than Spark's own default.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_pack(spark, sf_dir):
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER)


@query
def op2_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from labels outside the held-out quarter."""
    docs, held = read(spark, sf_dir, "documents").select("doc_id", "text"), remainder("doc_id", 4) == 2
    machine = toxicity.train(docs, read(spark, sf_dir, "labels"), ~held)
    out = toxicity.score(docs, machine)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_language(spark, sf_dir):
    """Language of every document, learned from languages outside the held-out fifth."""
    docs, held = read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), remainder("doc_id", 5) == 0
    scorer = language.train(docs, ~held)
    return language.predict(docs.select("doc_id", "text"), scorer).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score"
    )


@query
def op4_quality(spark, sf_dir):
    """Quality of every document, learned from labels outside the held-out third."""
    docs, held = read(spark, sf_dir, "documents").select("doc_id", "text"), remainder("doc_id", 3) == 1
    model = quality.train(docs, read(spark, sf_dir, "labels"), ~held)
    out = quality.score(docs, model)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_topk(spark, sf_dir):
    """The 10 greatest integer inner products of every hundredth vector."""
    return covertree.exact_top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 100, 10)


@query
def op6_jaccard(spark, sf_dir):
    """Every document's component of texts whose word 5-grams overlap by three quarters."""
    return jaccard.similarity_components(read(spark, sf_dir, "documents"))


@query
def op7_neighbours(spark, sf_dir):
    """The 5 nearest vectors found of every fiftieth."""
    return hamming.nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 50, 5)


@query
def op8_pii(spark, sf_dir):
    """Personal data of every document, and the words that reveal it."""
    found = sanitise.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base, terms = F.col("base_spans"), F.col("term_spans")

    def count(kind: int):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{sanitise.KINDS[kind]}")

    return found.select(
        "doc_id", *[count(k) for k in range(len(sanitise.KINDS))],
        F.sha2(sanitise.spans_text(base), 256).alias("base_sha256"),
        sanitise.spans_text(sanitise.all_spans(base, terms)).alias("spans"),
        F.size(terms).cast("long").alias("n_terms"),
    )


@query
def op9_shards(spark, sf_dir):
    """Shards 0 to 23 of all documents by the law ``key``."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = sharding.assign_shards(docs, "doc_id", SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op10_mix(spark, sf_dir):
    """Every document's place in the mix of sources."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, MIX_WEIGHTS, MIX_BLOCK)


@query
def op11_search(spark, sf_dir):
    """The 10 best documents of every benchmark item by their words."""
    found = lexical.index(read(spark, sf_dir, "documents"))
    return lexical.search(found, read(spark, sf_dir, "benchmark"), 10)


@query
def op12_resample(spark, sf_dir):
    """A tenth of the documents of 20 words or more, drawn by how much they are like the benchmark's texts."""
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 10)


@query
def op13_bytepair(spark, sf_dir):
    """Byte-pair ids of every document, and the bytes they stand for."""
    table = bytepair.share(spark, RANKS, public_tokenizers.PATTERN)
    docs = read(spark, sf_dir, "documents").select("doc_id", bytepair.encode(F.col("text"), table).alias("ids"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(bytepair.decode(F.col("ids"), table), 256).alias("decoded_sha256"),
    )


ORACLE["op5_topk"] = TOP_SQL
ORACLE["op6_jaccard"] = JACCARD_SQL
ORACLE["op8_pii"] = pii_sql()
ORACLE["op10_mix"] = mix_sql(MIX_WEIGHTS, MIX_BLOCK)
ORACLE["op11_search"] = LEXICAL_SQL
ORACLE["op12_resample"] = RESAMPLE_SQL
