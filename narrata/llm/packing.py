"""Packing documents into training sequences: best fit with several permitted lengths.

Documents longer than the largest permitted length are cut into pieces of that length; nothing is dropped. Pieces are dealt
over shards of bounded size by hash, and each shard is packed in one task, longest pieces first. A piece goes into the open
bin that it leaves least room in. Where none has room, a bin of the permitted length with the least cost per word it can
still get to hold is opened: a length costs itself plus a fixed amount a sequence, and what can be held is limited by the
words still to be packed, so long bins are opened while there is plenty and fitting ones at the end. At last each bin
is cut down to the shortest permitted length that holds its contents.

Where ``within`` names a column, a sequence holds documents of one value of it only (null is a value); ``carry`` names columns
that come along as strings. Only ids, lengths and these move, never texts. Null and empty texts and those without words give one row without a bin. Ties go by
a hash, then by id, so reruns agree. Rows that repeat an id are packed each; ids that are null likewise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import WORD, cut, table

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 64
SHARD_PIECES = 1500
KIND = "doc_id long, size long, piece int, start long, length long, bin_id long, bin_start long, capacity long"


def best_fit(sizes: list[int], lengths: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """For sizes in the order of packing (each from 1 to the largest length): bin and offset of each, and each bin's final length."""
    lengths = tuple(sorted(lengths))
    left, bins, used, room = sum(sizes), [], [], {}
    spaces = 0  # bit r is set while some open bin has room for exactly r words
    places, offsets = [], []
    for size in sizes:
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            own = room[space].pop()
            if not room[space]:
                spaces &= ~(1 << space)
        else:
            choice = min((c for c in lengths if c >= size), key=lambda c: ((c + overhead) / min(c, left), c))
            own, space = len(bins), choice
            bins.append(choice)
            used.append(0)
        places.append(own)
        offsets.append(used[own])
        used[own] += size
        left -= size
        if space > size:
            room.setdefault(space - size, []).append(own)
            spaces |= 1 << (space - size)
    return places, offsets, [next(c for c in lengths if c >= u) for u in used]


def _packer(lengths: tuple[int, ...], overhead: int, carry: tuple[str, ...]):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "drawn", "doc_id", "size", "piece"], ascending=[False, True, True, True, True], na_position="last", ignore_index=True)
        places, offsets, final = best_fit(group["length"].tolist(), lengths, overhead)
        group["bin_id"] = [(int(key[0]) << 32) + p for p in places]
        group["bin_start"] = offsets
        group["capacity"] = [final[p] for p in places]
        return group[["doc_id", "size", "piece", "start", "length", "bin_id", "bin_start", "capacity", *carry]]

    return run


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES,
    within: str | None = None, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per piece: doc_id, size (words of the document), piece, start, length, bin_id, bin_start, capacity, then ``carry``."""
    spark = docs.sparkSession
    ship_package(spark)
    longest = max(lengths)
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    kind = F.col(within).cast("string") if within else F.lit(None).cast("string")
    carried = [F.col(c).cast("string").alias(f"carry_{k}") for k, c in enumerate(carry)]
    sized = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("size"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), kind.alias("kind"), *carried))
    pieces = sized.where("size > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / longest))).alias("piece"))
    start = F.col("piece") * longest
    extra = tuple(f"carry_{k}" for k in range(len(carry)))
    pieces = pieces.select("doc_id", "size", F.col("piece").cast("int"), start.alias("start"), F.least(F.lit(longest), F.col("size") - start).alias("length"), F.xxhash64(F.lit(5), "doc_id", "text_hash", "piece").alias("drawn"), "kind", *extra)
    kinds = pieces.groupBy(F.col("kind").alias("of")).agg(F.greatest(F.lit(1), F.floor(F.count("*") / shard_pieces)).alias("shards"))
    # a row for each value of ``within``: shards are numbered through all values
    before = F.coalesce(F.sum("shards").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kinds = cut(kinds.withColumn("before", before))
    dealt = pieces.join(kinds, F.col("kind").eqNullSafe(F.col("of"))).withColumn("shard", (F.col("before") + F.pmod(F.xxhash64(F.lit(6), "doc_id", "drawn"), F.col("shards"))).cast("long"))
    packed = dealt.drop("kind", "of", "shards", "before").groupBy("shard").applyInPandas(_packer(tuple(lengths), overhead, extra), ", ".join([KIND, *(f"{c} string" for c in extra)]))
    none = sized.where("size = 0").selectExpr("doc_id", "size", "0 AS piece", "0L AS start", "0L AS length", "CAST(NULL AS long) AS bin_id", "CAST(NULL AS long) AS bin_start", "CAST(NULL AS long) AS capacity", *extra)
    return packed.unionByName(none).withColumnsRenamed(dict(zip(extra, carry, strict=True)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
