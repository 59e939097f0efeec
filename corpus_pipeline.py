"""From raw documents to token ids: five stages, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import bpe, mixing, ngram_jaccard, pii, quality_classifier
from termloom.llm.queries import KEEP_FROM, TOKENIZER, quality_model
from termloom.session import staged


def _hidden(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with other names for columns that a stage would take for its own."""
    return docs.select(*[F.col(f"`{c}`").alias(f"__own_{c}" if c.lower() in names else c) for c in docs.columns])


def _shown(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of a ``_hidden`` table under the names of ``docs`` again."""
    held = set(rows.columns)
    return rows.select(*[F.col(f"`__own_{c}`" if f"__own_{c}" in held else f"`{c}`").alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Its labels are those of the tables, without the held-out fold.

    A null text is judged as an empty one. Without labels the score is a half and nothing stays.
    """
    scored = quality_classifier.score(_hidden(docs, "score"), quality_model(spark, sf_dir, docs))
    return _shown(scored.filter(F.col("score") >= KEEP_FROM), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id.

    Five words, 80 percent. Rows that repeat id and text become one row. Documents without
    words stay, and so do rows without an id.
    """
    found = ngram_jaccard.join_similar(docs, words=5, percent=80)
    first = found.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id IS NULL")).select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with placeholders for personal data; ``n_chars`` is that of the new text."""
    masked = pii.redact_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix takes, none of those that it leaves out."""
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"), mixing.place().alias("place"))
    plan = mixing.plan_mix(staged(sized, "mix-sizes"))
    own = _hidden(docs, "place", "copies", "copy", "source_size", "target")
    mixed = mixing.mix(own.withColumn("place", mixing.place()), plan)
    repeated = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return _shown(repeated, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with their number and the decoded text's digest."""
    path = public_tokenizers.path(TOKENIZER)
    decoded = bpe.encode(docs, path, keep=["doc_id", "lang", "source"], decoded=True)
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, "stage")
    return docs


#: Model scores and token ids can't be stated in SQL.
ORACLE_SQL = None
