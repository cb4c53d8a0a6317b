"""Importance resampling towards a target distribution of hashed word n-grams.

Features of a text are all runs of 1 to ``width`` consecutive words; a feature's bucket is the crc32 of its bytes modulo
``buckets``. The log ratio of the target's smoothed bucket shares and the corpus's is a bucket's gain, in thousandths; the sum
over a text's features is its weight. Gumbel noise from each document's own id turns the highest scores into a draw without
replacement in proportion to exp(weight).

Identical texts are collapsed by grouping on the full text: features and weight are computed once a distinct text, corpus
counts are multiplied by the copies, and weights go back to the documents before the noise, which differs for copies.
Distinct texts are read twice, once for the counts and once for the weights; buckets are never stored. The crc32 of a run comes from
those of its words (crc32 is linear, so shifting by the bytes that follow is a table look-up), in NumPy.

What the driver sees: one row a bucket. Ranks come from a range partitioning by score: places within a range plus the sizes of
the ranges before it. Weights go back to documents by the SHA-256 of the grouped text.

A-Z alone are lower-cased; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Null, empty and wordless texts: no features, weight 0, never
drawn. Documents with fewer than ``least_words`` words are scored and not drawn. Ties go to the smaller id (null last), then the
smaller weight; equal rows get ranks of their own. A null id has the noise of the empty string. An empty target: every bucket's
share is even. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import LOWER, UPPER, cut, fresh, partitions, table

WIDTH, BUCKETS, LEAST_WORDS, PERCENT, SEED = 3, 10_000, 20, 5, 42
WORD11 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The reflected polynomial of crc32.
POLYNOMIAL = 0xEDB88320
#: Words handled at a time, and words remembered with their crc32.
BATCH_WORDS, MEMORY = 1 << 20, 1 << 19
SPACE = zlib.crc32(b" ")


def _shift_tables(powers: int = 31) -> np.ndarray:
    """Entry [b, j, v]: what 2^b zero bytes make of a crc32 whose byte j is v and whose other bytes are zero."""
    columns = np.array([1 << bit for bit in range(32)], dtype=np.uint32)
    for _ in range(8):  # one zero bit a time
        columns = (columns >> np.uint32(1)) ^ np.where(columns & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    tables = np.zeros((powers, 4, 256), dtype=np.uint32)
    values = np.arange(256)
    for b in range(powers):
        for j in range(4):
            for bit in range(8):
                tables[b, j] ^= np.where(values >> bit & 1, columns[8 * j + bit], np.uint32(0)).astype(np.uint32)
        columns = _look(tables[b], columns)
    return tables


def _look(t: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return t[0][crc & np.uint32(255)] ^ t[1][crc >> np.uint32(8) & np.uint32(255)] ^ t[2][crc >> np.uint32(16) & np.uint32(255)] ^ t[3][crc >> np.uint32(24)]


SHIFTS = _shift_tables()
#: The same for every number of zero bytes up to this one, laid out flat.
NEAR = 64


def _near_tables() -> np.ndarray:
    tables = np.zeros((NEAR, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], dtype=np.uint32)[:, None]
    for n in range(1, NEAR):
        tables[n] = _look(SHIFTS[0], tables[n - 1])
    return tables.reshape(-1)


NEAR_SHIFTS = _near_tables()


def followed(crc: np.ndarray, after: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """crc32 of two byte strings in a row, from those of both and the length of the second."""
    base = np.minimum(n_bytes, NEAR - 1).astype(np.int32) << 10
    out = after.copy()
    for j in range(4):
        out ^= NEAR_SHIFTS[base + (256 * j + (crc >> np.uint32(8 * j) & np.uint32(255)).astype(np.int32))]
    far = np.flatnonzero(n_bytes >= NEAR)
    if len(far):
        shifted, b, rest = crc[far], 0, n_bytes[far]
        while rest.any():
            own = np.flatnonzero(rest & 1)
            shifted[own] = _look(SHIFTS[b], shifted[own])
            b, rest = b + 1, rest >> 1
        out[far] = shifted ^ after[far]
    return out


class Features:
    """Buckets of texts; words are remembered with the crc32 of their bytes, that of a space and their bytes, and their length."""

    def __init__(self, width: int = WIDTH, buckets: int = BUCKETS):
        self.width, self.buckets = width, buckets
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.alone, self.later, self.length = np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def batches(self, texts: Iterator[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For texts in a row: the words of each; then of all their features the text's number in the row and the bucket."""
        sizes, words = [], []
        for text in texts:
            own = WORD11.findall(text.encode("utf-8", "replace").lower().decode()) if text else []  # bytes: A-Z alone
            sizes.append(len(own))
            words += own
            if len(words) >= BATCH_WORDS:
                yield self._buckets(np.array(sizes), words)
                sizes, words = [], []
        if sizes:
            yield self._buckets(np.array(sizes), words)

    def _remember(self, words: list[str]) -> None:
        if len(self.known) > MEMORY:
            self._forget()
        new = list(set(words).difference(self.known))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        data = [w.encode("utf-8", "replace") for w in new]
        self.alone = np.concatenate([self.alone, np.array([zlib.crc32(d) for d in data], np.uint32)])
        self.later = np.concatenate([self.later, np.array([zlib.crc32(d, SPACE) for d in data], np.uint32)])
        self.length = np.concatenate([self.length, np.array([len(d) + 1 for d in data], np.int64)])

    def _buckets(self, sizes: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._remember(words)
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int32, count=len(words))
        run, later, length = self.alone[at], self.later[at], self.length[at]
        text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        crcs, owners = [run], [text]
        for k in range(1, self.width):
            run = followed(run[:-1], later[k:], length[k:])
            inside = text[k:] == text[: len(text) - k]
            crcs.append(run[inside])
            owners.append(text[k:][inside])
        return sizes, np.concatenate(owners), np.concatenate(crcs) % np.uint32(self.buckets)


def _count(width: int, buckets: int):
    """Rows (text, copies) to (bucket, n): features in each bucket, copies counted."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, total = Features(width, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            copies, first = batch["copies"].to_numpy(), 0
            for sizes, owner, found in own.batches(iter(batch["text"])):
                total += np.bincount(found, weights=copies[first : first + len(sizes)][owner], minlength=buckets).astype(np.int64)
                first += len(sizes)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    return count


def _weigh(shared, width: int, buckets: int):
    """Rows (name, text) to (name, n_words, n_features, weight)."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, gains = Features(width, buckets), shared.value
        for batch in batches:
            first = 0
            for sizes, owner, found in own.batches(iter(batch["text"])):
                # sums of whole numbers far below 2^53 are exact in doubles
                weight = np.bincount(owner, weights=gains[found], minlength=len(sizes)).astype(np.int64)
                features = np.bincount(owner, minlength=len(sizes))
                yield pd.DataFrame({"name": batch["name"].iloc[first : first + len(sizes)].to_numpy(), "n_words": sizes, "n_features": features, "weight": weight})
                first += len(sizes)

    return weigh


def bucket_counts(texts: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, from rows (text, copies). The driver receives one row a bucket."""
    told = texts.select("text", "copies").mapInPandas(_count(width, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(buckets, dtype=np.int64)
    found[told["bucket"].to_numpy(dtype=np.int64)] = told["n"].to_numpy(dtype=np.int64)
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of add-one smoothed shares, in thousandths rounded down."""
    n, whole, aimed = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (whole + n) / ((s + 1) * (aimed + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id in thousandths, from the first 32 bits of the SHA-256 of ``seed:id``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, key: list[Column], percent: int, out: str = "rank") -> DataFrame:
    """``scored`` with the places of its first ``percent`` of rows by ``key`` as ``out``, from 1; null for the others.

    Rows are dealt by ranges of the key; a place is that within the range and the sizes of all ranges before it.
    """
    spark = scored.sparkSession
    part = fresh("part", scored.columns)
    dealt = cut(scored.repartitionByRange(partitions(spark), *key).withColumn(part, F.spark_partition_id()))
    sizes = dealt.groupBy(part).count().sort(part).collect()
    starts = np.cumsum([0, *(r["count"] for r in sizes)]).tolist()
    drawn = percent * starts[-1] // 100
    first = [(r[part], start) for r, start in zip(sizes, starts, strict=False) if start < drawn]
    if not first:
        return dealt.drop(part).withColumn(out, F.lit(None).cast("long"))
    start = F.element_at(F.create_map(*[F.lit(x) for pair in first for x in pair]), F.col(part))
    place = (F.row_number().over(Window.partitionBy(part).orderBy(*key)) + start).cast("long")
    inside = F.col(part).isin([p for p, _ in first])
    head = dealt.where(inside).withColumn(out, place).withColumn(out, F.when(F.col(out) <= drawn, F.col(out)))
    return head.unionByName(dealt.where(~inside).withColumn(out, F.lit(None).cast("long"))).drop(part)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = PERCENT, seed: int = SEED, width: int = WIDTH,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_features, weight, score, rank (null: not drawn)."""
    spark = docs.sparkSession
    ship_package(spark)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    collapse = lambda df, c: df.groupBy(text(c).alias("text")).agg(F.count("*").alias("copies"))
    texts = cut(collapse(docs, text_col))
    own = gains(bucket_counts(texts, width, buckets), bucket_counts(collapse(target, target_text), width, buckets))
    shared = spark.sparkContext.broadcast(own)
    named = texts.select(F.sha2("text", 256).alias("name"), "text")
    weights = cut(named.mapInPandas(_weigh(shared, width, buckets), "name string, n_words long, n_features long, weight long"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text(text_col), 256).alias("name"))
    scored = rows.join(weights, "name").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).drop("name")
    fits = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    drawn = ranked(scored.where(fits), order, percent)
    return drawn.unionByName(scored.where(~fits).withColumn("rank", F.lit(None).cast("long")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return told.select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 byte by byte: the table of 256 entries from its rule, then a fold over the bytes of each distinct run of words.
SQL = f"""
WITH crc_entries AS (
  SELECT list(list_reduce([v] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {POLYNOMIAL}) ELSE c >> 1 END) ORDER BY v) AS entries
  FROM (SELECT unnest(range(256)) AS v)),
worded AS (
  SELECT false AS aimed, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{{words}}') AS w FROM documents
  UNION ALL
  SELECT true, NULL, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{{words}}') FROM benchmark),
numbered AS (SELECT row_number() OVER () AS r, aimed, doc_id, w FROM worded),
grams AS (
  SELECT r, aimed, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS gram
  FROM numbered),
counted AS (SELECT r, aimed, gram, count(*) AS n FROM grams GROUP BY ALL),
hashed AS (
  SELECT gram, xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode(gram))), lambda i: (strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT gram, hex(encode(gram)) AS h FROM counted), crc_entries),
placed AS (SELECT r, aimed, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (gram) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (NOT aimed), 0) AS s, coalesce(sum(n) FILTER (aimed), 0) AS t FROM placed GROUP BY bucket),
gained AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + {BUCKETS}))::DOUBLE / ((s + 1) * (sum(t) OVER () + {BUCKETS}))::DOUBLE))::BIGINT AS gain FROM sums),
weighed AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM placed JOIN gained USING (bucket) WHERE NOT aimed GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM numbered LEFT JOIN weighed USING (r) WHERE NOT aimed),
placed_docs AS (
  SELECT *, CASE WHEN n_words >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) END AS place,
         count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS fit
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * fit // 100 THEN place END AS rank FROM placed_docs
""".replace("{words}", WORD11.pattern)
