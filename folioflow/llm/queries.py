"""The queries opN_<name> of this package: thin layers over its operators, on whole tables; ORACLE_SQL has SQL for some."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annular, chosen_path, common, decontam, fst_bpe, imatch, late_sessions, length_hist, main_text, ordinal, rans, suffix_dedup, toxicity, warc
from .common import table
from .oracle import ORACLE_SQL as ORACLE_SQL


def op1_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    got = toxicity.with_held_out(toxicity.scored(docs, model))
    spans = F.transform("sentences", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["p"].alias("p")))
    return got.select("doc_id", "held_out", "score", "predicted", "n_scored", spans.alias("offending"))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), inside=True)


def op3_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fst_bpe.encode_decode(docs, fst_bpe.build_lexicon(docs))


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    got = ordinal.scored(docs, model)
    return got.select("doc_id", common.held_out().alias("held_out"), "score", F.col("keep").cast("int").alias("predicted"), "expected_grade", "tails", "keep")


def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_hist.histogram(length_hist.token_counts(table(spark, sf_dir, "documents"), keep=()))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.against_edits(table(spark, sf_dir, "documents"))


def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.joined(table(spark, sf_dir, "documents")).drop("text_key", "root")


def op10_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.token_files(table(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.of_pages(spark, sf_dir)


def op12_annular_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annular.of_embeddings(spark, sf_dir)


def op13_late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_sessions.of_conversations(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_noisy_or_toxicity,
        op2_template_decontamination,
        op3_transducer_bpe,
        op4_ordinal_quality,
        op5_length_histogram,
        op6_suffix_dedup,
        op7_warc_index,
        op8_imatch_fingerprints,
        op9_chosen_path_join,
        op10_rans_token_files,
        op11_main_text,
        op12_annular_codes,
        op13_late_sessions,
    )
}
