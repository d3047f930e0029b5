"""A training corpus in five stages: language, near copies, personal data, mix, sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept; all
but the last return the columns of ``documents``. Rows and texts may be null, empty, very long
or repeated, other columns pass through, and an empty table gives empty results.
"""

from __future__ import annotations

import functools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm import jaccard, language, mixing, packing, sanitise
from threadmill.llm.common import read, ship_package
from threadmill.llm.queries import BATCH_ROWS, MIX_BLOCK, MIX_WEIGHTS, TOKENIZER
from threadmill.session import collect_garbage, discard, materialize, prepare, written_tables

#: A text whose language is less certain than this is rejected; guessing one of four gives 0.25.
LEAST_CERTAIN = 0.3


_left: list[str] = []


def stage(work):
    """A stage that first removes the intermediate tables of the one before, on disk and in memory.

    That one's result has been written and read again by then, so nothing needs them; tables that
    ``docs`` itself still reads are left.
    """

    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(_left, unless_read_by=docs)
        collect_garbage(spark)
        before = len(written_tables())
        out = work(spark, docs, sf_dir)
        _left[:] = written_tables()[before:]
        return out

    return run


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null and empty ones too) and texts of no clear language."""
    labelled = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scorer = language.train(labelled, F.lit(True))
    if scorer is None:
        # No labelled text teaches anything, so only texts without a letter can be rejected.
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = language.predict(docs.withColumnsRenamed({c: f"d_{c}" for c in docs.columns}), scorer, "d_text")
    kept = named.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_CERTAIN))
    return kept.select(*[F.col(f"d_{c}").alias(c) for c in docs.columns])


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked texts the document with the smallest id.

    Where ids are null or repeat, rows are numbered first and the smallest number stays.
    """
    ids = docs.agg(
        F.count("*").alias("rows"), F.count("doc_id").alias("ids"), F.count_distinct("doc_id").alias("distinct")
    ).first()
    if ids["rows"] == ids["ids"] == ids["distinct"]:
        groups = jaccard.similarity_components(docs)
        others = materialize(groups.where("doc_id <> component_id").select("doc_id"), "copies")
        if others.count() <= jaccard.BROADCAST_IDS:
            others = F.broadcast(others)
        return docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    numbered = docs.withColumnsRenamed({c: f"d_{c}" for c in docs.columns})
    numbered = materialize(numbered.withColumn("doc_id", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.similarity_components(numbered.select("doc_id", F.col("d_text").alias("text")))
    first = groups.where("doc_id = component_id").select("doc_id")
    return numbered.join(first, "doc_id", "left_semi").select(*[F.col(f"d_{c}").alias(c) for c in docs.columns])


@stage
def take_out_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and the words that reveal it; ``n_chars`` follows the text."""
    clean = sanitise.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Orders the rows, and the files they are written to, by the mix of sources."""
    return mixing.in_mix_order(docs, MIX_WEIGHTS, MIX_BLOCK)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs texts into sequences; of equally long pieces those come first that the mix has first."""
    try:
        # Files of a written table are numbered in their order.
        number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
        ordered = docs.withColumns({
            "_file": F.coalesce(F.try_to_number(number, F.lit("9999999999")).cast("long"), F.lit(0)),
            "_place": F.col("_metadata.row_index"),
        })
    except AnalysisException:
        ordered = docs.withColumns({"_file": F.lit(0).cast("long"), "_place": F.monotonically_increasing_id()})
    return packing.pack(ordered, TOKENIZER, order=("_file", "_place"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", take_out_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Tokenizing and the learned language model are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    _left.clear()  # the result of a run before may still be read
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = materialize(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
