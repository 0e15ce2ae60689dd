"""A training corpus from raw documents: each stage works on all rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the shared folder and gives
it to the next.  All but the last return the columns of ``documents``, and further columns of any name with their values.

Null and empty texts and texts without a letter go with the language stage; the others leave such rows as they are.  Rows alike in
doc_id and text are treated alike by the language, line and benchmark stages; of rows with one doc_id the near-duplicate
stage keeps one, and it keeps all rows without doc_id.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, language_id, line_dedup, ngram_jaccard, packing
from millrace.llm.common import ready, stored, table

#: Language models and token ids are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def _apart(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``docs`` with columns of the names that an operator writes kept under others."""
    return docs.withColumnsRenamed({c: f"__docs_{c}" for c in names if c in docs.columns})


def _returned(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` as they were named."""
    own = {c: f"__docs_{c}" for c in docs.columns if f"__docs_{c}" in out.columns}
    return out.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty; texts without letters go."""
    ready(spark)
    return _returned(language_id.accepted(_apart(docs, ("lang_pred", "score", "rejected"))), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows are taken out of the texts."""
    ready(spark)
    out = line_dedup.dedup(_apart(docs, ("n_lines", "removed")))
    return _returned(out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    ready(spark)
    return ngram_jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    ready(spark)
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of token sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [("language", language), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontaminated), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
