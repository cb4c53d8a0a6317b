"""Lines that several documents share, kept in the first document only.

Line keys are hashed to 128 bits, range-partitioned by hash and sorted by hash, document and position; a streaming window
then sees every key's first document before all later ones. A very common key is first dealt over salted sub-ranges, where
all but the first document of each sub-range lose the line; what is left of a key, at most one document a salt, meets in a
second pass. The result of both is a bitmap per document, stored as its non-zero 64-bit words, and only that goes back to
the texts.

Keys: the line stripped of U+0020 and U+0009 to U+000D at both ends, A-Z in lower case. A null or empty text is one empty
line. Repeated rows of one id are one document and take nothing from each other; null ids come after all others and form
one document. A text that loses all lines is returned empty. No rows in, no rows out. Other columns are passed through by
``drop_lines`` and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.llm.common import LOWER, UPPER, WHITE, ascii_lower, cut, partitions, table

MIN_CHARS = 10


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def dropped_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows of documents that lose lines: doc_id, text_hash, words (array of struct(word, bits), a set bit: the line goes)."""
    spark = docs.sparkSession
    n = partitions(spark)
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(_text(text_col)).alias("text_hash"), F.posexplode(F.split(_text(text_col), "\n", -1)).alias("pos", "line"))
    trimmed = F.btrim("line", F.lit(WHITE))
    keyed = lines.where(F.char_length(trimmed) >= min_chars).select(
        "doc_id", "text_hash", "pos", F.xxhash64(ascii_lower(trimmed)).alias("h1"), F.xxhash64(F.lit(7), ascii_lower(trimmed)).alias("h2")
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("pos")]
    later = lambda *key: ~F.col("doc_id").eqNullSafe(F.first("doc_id").over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    salted = cut(keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")))
    ranged = salted.repartitionByRange(n, "h1", "h2", "salt").withColumn("gone", later("h1", "h2", "salt"))
    ranged = cut(ranged.drop("salt"))
    rest = ranged.where(~F.col("gone")).withColumn("gone", later("h1", "h2")).where("gone")
    gone = ranged.where("gone").unionByName(rest).select("doc_id", "text_hash", "pos")
    words = gone.groupBy("doc_id", "text_hash", F.shiftright("pos", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, pos & 63))").alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, out: str = "line_dedup") -> DataFrame:
    """``docs`` with its text shortened, after all its columns the struct ``out``: n_lines, n_dropped, words."""
    maps = dropped_bitmaps(docs, id_col, text_col, min_chars).select(F.struct("doc_id", "text_hash").alias("line_key"), F.col("words").alias("line_words"))
    names = docs.columns
    keyed = docs.select(F.struct(*names).alias("doc"), F.col(id_col).alias("k"), F.xxhash64(_text(text_col)).alias("t"))
    joined = keyed.join(maps, F.col("k").eqNullSafe(F.col("line_key.doc_id")) & (F.col("t") == F.col("line_key.text_hash")), "left")
    # from the non-zero words to all words up to the last of them
    dense = """coalesce(flatten(transform(line_words, (w, i) ->
        concat(array_repeat(0L, w.word - if(i = 0, -1, element_at(line_words, greatest(i, 1)).word) - 1), array(w.bits)))), array())"""
    split = joined.withColumn("lines", F.split(F.coalesce(F.col("doc").getField(text_col).cast("string"), F.lit("")), "\n", -1)).withColumn("dense", F.expr(dense))
    kept = F.when(F.col("line_words").isNull(), F.col("lines")).otherwise(
        F.expr("filter(lines, (x, i) -> coalesce(getbit(get(dense, shiftright(i, 6)), i & 63), 0) = 0)")
    )
    cut_down = split.withColumn("kept", kept)
    kept_columns = [F.col("doc").getField(c).alias(c) if c != text_col else F.array_join("kept", "\n").alias(c) for c in names]
    figures = F.struct(F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.col("line_words").alias("words"))
    return cut_down.select(*kept_columns, figures.alias(out))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(docs).select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
  SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT r, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM lines),
marked AS (
  SELECT *, length(k) >= {MIN_CHARS} AND doc_id IS DISTINCT FROM min(doc_id) OVER (PARTITION BY k) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
