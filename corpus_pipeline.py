"""From raw documents to packed training sequences.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame whose result
is written and read again as the next one's ``docs``. All but the last return
the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.llm import mix, near_dup, pack, quality, spans, suffix_dedup
from daystream.llm.store import stage
from daystream.session import read_table

#: No SQL can express the classifier, the minhash or the tokenizer; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality classifier."""
    # the columns travel in a struct, so none can clash with the verdict's
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    out = quality.quality(rows, read_table(spark, sf_dir, "labels"), keep_columns=("row",))
    return out.filter("kept").select("row.*")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group; a row that occurs twice stays once."""
    kept = near_dup.near_duplicates(docs).filter("kept").select(F.col("uid").alias("kept_uid")).distinct()
    rows = docs.select(spans.uid().alias("own_uid"), F.struct(*docs.columns).alias("row"))
    return (rows.join(kept, F.col("own_uid") == F.col("kept_uid"), "left_semi")
            .dropDuplicates(["own_uid"]).select("row.*"))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat from an earlier one."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = suffix_dedup.suffix_dedup(docs, extra=rest)
    if not rest:
        return out.select(*docs.columns)
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or once to three times."""
    out = mix.systematic_mix(docs).filter("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens, with their ids."""
    return pack.pack(docs, pack.tokenizer_path(), special_tokens=True)


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("repeated strings", cut_repeated_strings),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
