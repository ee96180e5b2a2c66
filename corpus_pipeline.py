"""From raw documents to sampled token sequences, stage by stage.

Every stage works on all that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm.common import packed, quoted, read_table, unpacked
from beaconry.llm.decontaminate import decontaminate
from beaconry.llm.language_id import UNDETERMINED, fit_languages, predict_languages
from beaconry.llm.line_dedup import dedup_lines
from beaconry.llm.piece_sampling import load_pieces, sample_pieces
from beaconry.llm.simhash import one_of_each
from beaconry.session import materialize, tune

#: how far above an even guess between the languages the likeliest one's share of a document's words must be, of the way
#: from there to certainty
LEAST_LEAD = 1 / 15
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter (or no text) or no likely language."""
    model = fit_languages(docs)
    named = predict_languages(packed(docs, text=quoted("text")), model)
    even = 1 / max(1, len(model.labels))
    kept = named.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= even + LEAST_LEAD * (1 - even) - 1e-6))
    return unpacked(kept, docs.columns, {}, {})


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that ten or more documents share; ``n_chars`` follows the text."""
    cut = dedup_lines(packed(docs, text=quoted("text")))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return unpacked(cut, docs.columns, {c: v for c, v in changed.items() if c in docs.columns}, {})


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the one with the smallest id."""
    return one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every text, each decoded again: ``text_sha256`` is of the decoded text."""
    return sample_pieces(docs, load_pieces(PIECE_MODEL), decoded=True).select(
        F.col("key").alias("doc_id"), "rank", "ids", F.size("ids").cast("long").alias("n_pieces"), "log_prob",
        "log_inclusion", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("language_id", in_known_language),
    ("line_dedup", without_common_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece_sampling", as_pieces),
]

#: learned, hashed and sampled results cannot be put into SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
