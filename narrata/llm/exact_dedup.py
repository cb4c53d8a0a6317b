"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of characters. Equal blocks get equal integer names, different blocks
different ones: the distinct blocks are sorted and numbered. Then adjacent names are joined in pairs and the pairs are
named the same way, level by level, until a document is down to one name. Two documents with the same number of blocks
have the same last name exactly if their texts are equal, whatever any hash does.

Only the first naming moves text, once, and after map-side combination, so a text with a million copies travels once per
map task. A 64-bit hash then carries block names back to documents; hashes that stand for two different blocks are found
and these blocks are joined by content instead, so the hash saves traffic but decides nothing.

Nulls count as the empty text (one empty block). A null id never wins against another. Rows that repeat a whole document,
id included, all bear the winning id and all stay. No rows in, no rows out. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm.common import cut, table

BLOCK_CHARS = 4096


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, hashed: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest id of the equal texts), group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    pieces = F.when(text == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block_chars), F.lit(0)))
    exploded = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), pieces.alias("blocks"))
    blocks = exploded.select("doc_id", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block")).withColumn("h", hashed(F.col("block")))
    contents = docs.select(F.explode(pieces).alias("block")).select(hashed(F.col("block")).alias("h"), "block").distinct()

    names = cut(_numbered(contents, "h", "block").select("h", "name"))
    shared = names.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    places = blocks.select("doc_id", "sha", "n", "pos", "h")
    if shared.isEmpty():
        level = places.join(names, "h").drop("h")
    else:
        shared = cut(shared)
        own = cut(_numbered(contents.join(shared, "h", "left_semi"), "h", "block").withColumn("name", -1 - F.col("name")))
        level = places.join(names.join(shared, "h", "left_anti"), "h").drop("h").unionByName(blocks.join(own, ["h", "block"]).drop("h", "block"))
    level = cut(level)

    rows = level.where("n = 1").select("doc_id", "sha", "n", "name")
    heads = level.where("n > 1 and pos = 0").select("doc_id", "sha", "n")
    width = level.agg(F.max("n")).first()[0] or 1
    level, wide, ended = level.where("n > 1"), F.col("n"), []
    while width > 1:
        half = F.col("pos").bitwiseAND(1)
        pairs = cut(
            level.groupBy("doc_id", "sha", "n", F.shiftright("pos", 1).alias("at")).agg(
                F.max(F.when(half == 0, F.col("name"))).alias("left"), F.max(F.when(half == 1, F.col("name"))).alias("right")
            )
        )  # an odd last block has no right neighbour
        names = cut(_numbered(pairs.select("left", "right").distinct(), "left", "right"))
        named = pairs.join(names, (pairs["left"] == names["left"]) & pairs["right"].eqNullSafe(names["right"]))
        level = cut(named.select("doc_id", "sha", "n", F.col("at").alias("pos"), "name"))
        width, wide = (width + 1) // 2, F.ceil(wide / 2)
        ended.append(level.where(wide == 1).select("doc_id", "sha", "n", "name"))
        level = level.where(wide > 1)
    if ended:
        last = reduce(DataFrame.unionByName, ended)
        rows = rows.unionByName(
            heads.alias("d").join(last.alias("l"), F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.sha") == F.col("l.sha"))).select("d.doc_id", "d.sha", "d.n", "l.name")
        )
    groups = cut(rows.groupBy("n", "name").agg(F.max("doc_id").alias("most"), F.count("*").alias("size")).where("size > 1"))
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("most"))
    return rows.join(groups, ["n", "name"], "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
