"""A corpus pipeline: five stages over documents, each a DataFrame that is written as Parquet and read as the next one's docs.

Toxic documents go; one document of each near-duplicate class stays; repeated passages are cut; documents with
benchmark items go; what is left is encoded. Each stage works on all that its predecessor kept.

Defined cases, in every stage: null and empty texts are clean, have one class between them (of which one row stays), no
passages, no items and no ids; repeated rows are one class; a null doc_id takes part like any other; texts of any length
are worked on whole; an empty table stays empty; other columns, whatever their names, are kept up to the last stage.
Ties are those of the operators: the smallest doc_id, then the smallest text hash of a class stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import chosen_path, common, decontam, fst_bpe, suffix_dedup, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score stays under 0.5, by a model fitted on labels outside the held-out fifth."""
    return toxicity.without_toxic(docs, toxicity.train(docs, common.table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id."""
    return chosen_path.one_of_each(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur again."""
    return suffix_dedup.cut_texts(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontam.without(docs, common.table(spark, sf_dir, "benchmark"), inside=True)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of ids and the digests of ids and decoded text."""
    return fst_bpe.encode_decode(docs, fst_bpe.build_lexicon(docs), memo=300_000)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", repeated_passage_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Suffix sorting, components and BPE are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None
