"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: the sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share all words; no target exceeds
``max_repeats`` times its source, and what is cut off is shared again by weight (solved in closed form: the common level at
which the capped sources and the rest together make up the total).

Blocks: the total is so many blocks of equal size. Highest quotients target / (2k + 1) give each source an integer number of
blocks, and within a source they give each shard its number by the shard's size. A shard is a bounded set of documents in
an order drawn from the seed; its words lie end to end and are cut into blocks, of which the quota is taken round after
round, the last incomplete round from a block drawn by the seed. A document's share is how far its words lie in the blocks
taken, so no quotient or block is ever a row: the work grows with documents and sources only.

Where documents have to stay whole, ``copies`` says how often each is taken: its source's target over its source's size is the
share of every document of the source, whatever its length, and a seeded systematic draw along the shares, carried over from
shard to shard, rounds them. The draw runs by length, so the words of a source come within about one document of its target.

Only the table of sources meets in one task (a row per source). A hot source is many shards, each of bounded size.
Null text: no words. A null source is a source of its own. Rows that repeat an id each count. Nothing in, nothing out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.llm.common import WORD, cut, table

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_WORDS = 50_000
SHARD_ROWS = 500
MAX_SHARDS = 65_536
SMALL_TABLE = 100_000
SEED = 20_240


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with source_no (from 0, in code-point order), total and target."""
    every = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn("source_no", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    tightest = every.orderBy("ratio", "source_no")
    before = F.coalesce(F.sum("cap").over(tightest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(tightest.rowsBetween(0, Window.unboundedFollowing))
    leveled = (
        capped.withColumn("total", F.sum("source_size").over(every)).withColumn("place", F.row_number().over(tightest)).withColumn("level", (F.col("total") - before) / after)
    )
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(every)["level"]
    return leveled.withColumn("target", F.least(F.col("weight") * first, F.col("cap").cast("double"))).select("source", "source_no", "source_size", "total", "target")


def apportion(df: DataFrame, group: list[str | Column], key: str, votes: str, seats: str, out: str) -> DataFrame:
    """``df`` with ``out``: the integer share of the group's ``seats`` by Sainte-Laguë on ``votes``; ties go to the smaller key.

    Rounding votes by the plain divisor leaves at most half a seat a row too many or too few; only quotients that can still
    matter, in all not many more than there are rows, are ranked.
    """
    whole = Window.partitionBy(*group)
    have = df.withColumn("_all", F.sum(votes).over(whole)).withColumn("_n", F.count("*").over(whole))
    plain = F.when((F.col("_all") > 0) & (F.col(seats) > 0), F.floor(F.col(votes) / F.col("_all") * F.col(seats) + 0.5)).otherwise(0).cast("long")
    have = have.withColumn("_plain", plain).withColumn("_left", F.when(F.col("_all") > 0, F.col(seats) - F.sum("_plain").over(whole)).otherwise(0))
    most = F.ceil(F.col(votes) / F.col("_all") * (F.abs("_left") + F.col("_n"))) + 1
    tries = F.when((F.col("_left") == 0) | (F.col(votes) <= 0), 0).otherwise(F.least(most, F.abs("_left"), F.when(F.col("_left") < 0, F.col("_plain")).otherwise(F.abs("_left"))))
    tried = have.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(tries, F.lit(0)).cast("long"))))
    seat = F.when(F.col("_left") > 0, F.col("_plain") + F.col("_k")).otherwise(F.col("_plain") - F.col("_k") + 1)
    quotient = F.col(votes) / (2 * seat - 1)
    better = F.when(F.col("_left") > 0, -quotient).otherwise(quotient)
    ranked = tried.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, F.col("_k") == 0).orderBy(better, F.col(key), F.col("_k"))))
    moved = F.sum(F.when((F.col("_k") > 0) & (F.col("_rank") <= F.abs("_left")), F.signum("_left")).otherwise(0)).cast("long")
    names = df.columns
    return ranked.groupBy(*names, "_plain").agg(moved.alias("_moved")).select(*names, (F.col("_plain") + F.col("_moved")).alias(out))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per input row: doc_id, text_hash, size, source_size, target (its source's), taken (words the mix takes)."""
    sized = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
            F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    every = Window.partitionBy(F.lit(0))
    aimed = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    aimed = aimed.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(least / 64))).cast("long"))
    aimed = aimed.withColumn("seats", F.round(F.col("total") / F.col("block")).cast("long"))
    shard_size = F.greatest(F.lit(shard_words), F.ceil(F.col("total") / MAX_SHARDS))
    aimed = cut(apportion(aimed, [F.lit(0)], "source_no", "target", "seats", "blocks").withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_size))))
    aim = aimed.withColumnRenamed("source", "aim_source").drop("seats", "total")
    aim = F.broadcast(aim) if aimed.count() <= SMALL_TABLE else aim
    drawn = F.xxhash64(F.lit(seed), "doc_id", "size")
    placed = sized.join(aim, F.col("source").eqNullSafe(F.col("aim_source"))).withColumn("drawn", drawn)
    placed = placed.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("shards")))
    shards = placed.groupBy("source_no", "shard", "block", "blocks").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(shards, ["source_no"], "shard", "shard_size", "blocks", "quota")
    there = F.ceil(F.col("shard_size") / F.col("block"))
    quotas = quotas.withColumn("there", F.greatest(there, F.lit(1))).withColumn("quota", F.least(F.col("quota"), F.col("there") * max_repeats))
    quotas = quotas.withColumn("rounds", F.floor(F.col("quota") / F.col("there"))).withColumn("rest", F.col("quota") - F.col("rounds") * F.col("there"))
    quotas = quotas.withColumn("first", F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"), F.col("there")))
    quotas = cut(quotas.select("source_no", "shard", "there", "rounds", "rest", "first"))
    ends = F.sum("size").over(Window.partitionBy("source_no", "shard").orderBy("drawn", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0))
    laid = placed.join(quotas, ["source_no", "shard"]).withColumn("end", ends).withColumn("start", F.col("end") - F.col("size"))
    inside = lambda lo, hi: F.greatest(F.lit(0), F.least("end", hi * F.col("block")) - F.greatest("start", lo * F.col("block")))
    stop = F.col("first") + F.col("rest")
    taken = F.col("rounds") * F.col("size") + inside(F.col("first"), F.least(stop, "there")) + inside(F.lit(0), F.greatest(stop - F.col("there"), F.lit(0)))
    return laid.select("doc_id", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken"))


def copies(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS, shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS, seed: int = SEED, out: str = "times",
) -> DataFrame:
    """doc (a row of ``docs``), and ``out``: how often the mix takes it whole. Rows without words are taken 0 times.

    Each row is taken floor or ceil of target / source_size times, in the mean over the seeds exactly that often.
    """
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    given = docs.select(F.struct(*docs.columns).alias("doc"), F.col(source_col).cast("string").alias("source"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("drawn"), size.alias("size"))
    # two classes of length each time it doubles
    given = given.withColumn("cls", F.floor(2 * F.log2(F.greatest(F.col("size"), F.lit(1)))).cast("int"))
    sized = cut(given.select("source", "drawn", "size", "cls"))
    classes = cut(sized.groupBy("source", "cls").agg(F.sum("size").alias("words"), F.count("*").alias("n")))
    aimed = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeats)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aim = aimed.select(F.col("source").alias("of"), "source_no", share.alias("share"))
    all_words, all_rows = classes.agg(F.sum("words"), F.sum("n")).first()
    most_words, most_rows = max(shard_words, -(-(all_words or 0) // MAX_SHARDS)), max(shard_rows, -(-(all_rows or 0) // MAX_SHARDS))
    shards = F.greatest(F.lit(1), F.ceil(F.col("words") / most_words), F.ceil(F.col("n") / most_rows))
    plan = cut(classes.join(aim, F.col("source").eqNullSafe(F.col("of"))).select("of", F.col("cls").alias("of_cls"), "source_no", "share", shards.alias("shards")))
    plan = F.broadcast(plan) if plan.count() <= SMALL_TABLE else plan

    def dealt(rows: DataFrame) -> DataFrame:
        own = rows.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("cls") == F.col("of_cls"))).drop("source", "of", "of_cls")
        return own.withColumn("shard", F.pmod(F.col("drawn"), F.col("shards")))

    counts = dealt(sized.where("size > 0")).groupBy("source_no", "cls", "shard").agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.partitionBy("source_no").orderBy("cls", "shard").rowsBetween(Window.unboundedPreceding, -1))
    before = cut(counts.select("source_no", "cls", "shard", F.coalesce(running, F.lit(0)).alias("before")))
    order = F.row_number().over(Window.partitionBy("source_no", "cls", "shard").orderBy("size", "drawn"))
    laid = dealt(given.where("size > 0")).join(before, ["source_no", "cls", "shard"]).withColumn("place", F.col("before") + order)
    phase = F.pmod(F.xxhash64(F.lit(seed + 3), "source_no"), F.lit(1 << 20)) / float(1 << 20)
    upto = lambda place: F.floor(F.col("share") * place + phase)
    taken = laid.select("doc", (upto(F.col("place")) - upto(F.col("place") - 1)).cast("int").alias(out))
    return taken.unionByName(given.where("size = 0").select("doc", F.lit(0).alias(out)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("text_hash")
