"""From raw documents to a mixed, tokenised corpus in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from citelight.llm import decontamination, language, minhash, mixing, queries, token_files
from citelight.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keep(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of every component the row with the smallest id and then text hash, null ids last, and all rows that stand alone.

    Rows are known by id and text, and null ids meet each other; equal rows are kept once.
    """
    rows = found.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    alone = F.when(F.col("component").isNull(), F.struct("doc_id", "text_hash"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "rows")
    kept = rows.groupBy("component", alone.alias("alone")).agg(F.min(place).alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"), F.col("first.rows").alias("_rows")
    )
    kept = staged(kept, "kept")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.xxhash64(F.col("text").cast("string")).eqNullSafe(F.col("_hash"))
    single = docs.join(kept.where("_rows = 1"), same, "left_semi")
    repeated = kept.where("_rows > 1")
    if not repeated.isEmpty():
        single = single.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
    return single.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without any (``und``) go."""
    model = language.train(queries.labelled(docs))
    return language.predict(model, docs.select(*COLUMNS)).where("lang_pred <> 'und'").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8)."""
    found = minhash.near_duplicates(docs, width=5, percent=80)
    return _keep(docs, found)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.scan(docs.select(*COLUMNS), bench).where("n_hit = 0").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a document as often as it is taken."""
    return mixing.materialise(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files, read back from them."""
    return queries.tokenised(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: The learned language models and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
