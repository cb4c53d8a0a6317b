"""A corpus pipeline of five stages, from raw documents to packed training sequences.

Each stage works on all that the one before kept; all but the last return documents with their columns. Texts of any length
are taken whole, extra columns pass through under any names, and an empty table gives an empty one at every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm import language, line_dedup, minhash, mixing, packing
from narrata.llm.common import checkpoint_folder, fresh
from narrata.operators.cutting import remove

#: A raw byte's bits, bytes that a short text has free, and the probability from which on a prediction stands against a given language.
RAW_BITS, SLACK_BYTES, SURE = 8, 16, 0.99


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Documents of the learned languages stay; ``lang`` becomes the predicted language.

    A given language stays only where the prediction is less sure than ``SURE``. Packing fills a sequence from one language,
    so the prediction decides which documents meet there.

    Rejected are null, empty and letterless texts, texts that their best language codes no shorter than raw bytes (with
    ``SLACK_BYTES`` free, so that short texts stay), and, where ``languages`` are named, texts predicted as another one.
    Where no row can teach a language, only texts without a letter go. Rows that repeat an id are judged each by its text.
    """
    text = F.col("text").cast("string")
    model = language.fit(docs)
    if model is None:
        return docs.where(text.rlike(r"\p{L}"))
    told = fresh("language", docs.columns)
    found = language.identify(docs, model, out=told)
    best, size, sure = F.col(told)["lang_pred"], F.octet_length(text), F.col(told)["score"] >= SURE
    kept = found.where((best != language.UNDETERMINED) & (F.col(told)["rate"] * size <= RAW_BITS * (size + SLACK_BYTES)))
    if languages is not None:
        kept = kept.where(best.isin(*languages))
    return kept.select(*[F.when(sure | F.col(c).isNull(), best.cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "lang" else c for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen in an earlier document go; a document left without any visible character goes with them.

    Documents that lose no line stay as they are, null and empty ones too. Rows that repeat an id are one document and take
    nothing from each other; of a null id likewise.
    """
    told = fresh("line_dedup", docs.columns)
    shorter = line_dedup.drop_lines(docs, out=told)
    text = F.col("text")
    kept = shorter.where((F.col(told)["n_dropped"] == 0) | text.rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays.

    Null, empty and wordless texts and null ids are near to nothing and stay; rows that repeat an id share its lot.
    """
    name = fresh("gone", docs.columns)
    gone = minhash.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document whole, as often as its source's share asks: drawn without regard to its length.

    Null, empty and wordless texts hold nothing to mix and go. A null source is a source. Rows that repeat an id each count.
    """
    taken = mixing.copies(docs).where("times > 0")
    return taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_again")).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of the permitted lengths, each of one language, with ``lang`` and ``source``.

    Texts without words take no place; ids may repeat or be null.
    """
    return packing.pack(docs, within="lang", carry=("lang", "source"))


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: PPM code lengths, sketches, seeded blocks and best fit have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written as Parquet in the shared folder and read again.

    A stage's folder is removed when the next stage is written; the last one holds the rows returned.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            remove(spark, f"{folder}/{before}")
        before = name
    return docs
