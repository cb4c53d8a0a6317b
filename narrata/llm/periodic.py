"""Periodic runs of words, found by power-of-two naming, and texts without the repeats.

A run is a maximal stretch of words with smallest period q that is at least ``least`` words and ``times`` periods long.

Karp, Miller and Rosenberg's naming gives every stretch of 2^k words an integer, equal just where the words are: names of
one level are made from pairs of names of the level below. The longest common extension of two places is read off by
descending from the highest level, to the right and to the left, for all candidates at once in NumPy.

Candidates: a run of period q has at least max(least - q, (times - 1) q) consecutive places i where word i equals word i + q.
That number is never less than m = ceil(least (times - 1) / times), so with 2^k <= m every run holds, on a grid whose step leaves
room for 2^k words, a point i where the names of level k at i and i + q are equal. Only these grid points are extended; a run
found for a multiple of its period has the same ends and gives way to the smallest. A text in which no stretch of
2^k words occurs twice has no run and needs no candidates.

Names compare words themselves: no hashes, no suffix sorting. A document is one row and is handled by one task, in memory of
4 bytes a word for each level up to the longest repeated stretch.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. Null, empty and white texts: no words, no runs, an empty text. Runs may
overlap; a word goes if it stands in any of them after its first period. Repeated rows get the same answer. An empty table gives no
rows. Other columns pass through under any names.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import WORD, fresh, table

LEAST, TIMES = 24, 3
#: Candidate pairs handled at a time.
PAIRS = 1 << 21


def named(ids: np.ndarray, level: int) -> list[np.ndarray]:
    """Names of all stretches of 1, 2, 4, ... words, up to the highest level that repeats any; none if ``level`` repeats none."""
    names = [ids]
    while 2 ** len(names) <= len(ids):
        last, half = names[-1].astype(np.int64), 2 ** (len(names) - 1)
        different, own = np.unique(last[:-half] * (last.max() + 1) + last[half:], return_inverse=True)
        if len(different) == len(own):
            break
        names.append(own.astype(np.int32))
    return names if len(names) > level else []


def extension(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words from i on and from j on (or, not ``ahead``, before i and before j) are equal; i < j. Stretches twice the highest level's never are."""
    found, n = np.zeros(len(i), dtype=np.int64), len(names[0])
    for k in range(len(names) - 1, -1, -1):
        size = 2**k
        a, b = (i + found, j + found) if ahead else (i - found - size, j - found - size)
        fits = (b + size <= n) & (a >= 0)
        a, b = np.where(fits, a, 0), np.where(fits, b, 0)
        found += size * (fits & (names[k][a] == names[k][b]))
    return found


def runs(words: list[str], least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period), by start, then period."""
    n, none = len(words), np.zeros((0, 3), dtype=np.int64)
    if n < least:
        return none
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int32, count=n)
    level = int(np.log2(-(-least * (times - 1) // times)))
    names = named(ids, level)
    if not names:
        return none
    probe, size = names[level], 2**level
    periods = np.arange(1, n // times + 1)
    steps = np.maximum(least - periods, (times - 1) * periods) - size + 1
    points = np.maximum(0, -(-(n - periods - size + 1) // steps))
    ends, found = np.cumsum(points), []
    for first in range(0, int(ends[-1]), PAIRS):
        # numbers of grid points over all periods, and for each its period and its place
        number = np.arange(first, min(first + PAIRS, int(ends[-1])))
        row = np.searchsorted(ends, number, side="right")
        q, i = periods[row], (number - (ends - points)[row]) * steps[row]
        hit = probe[i] == probe[i + q]
        q, i = q[hit], i[hit]
        ahead, back = extension(names, i, i + q, True), extension(names, i, i + q, False)
        length = q + ahead + back
        long = length >= np.maximum(least, times * q)
        found.append(np.unique(np.stack([(i - back)[long], length[long], q[long]], axis=1), axis=0))
    found = np.unique(np.concatenate(found), axis=0)
    same = (found[1:, :2] == found[:-1, :2]).all(axis=1)  # sorted by start, length, period: the smallest period comes first
    found = found[np.concatenate([[True], ~same])] if len(found) else found
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapsed(words: list[str], found: np.ndarray) -> str:
    """The words that stand in no run after its first period."""
    if not len(found):
        return " ".join(words)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    return " ".join([w for w, depth in zip(words, np.cumsum(gone), strict=False) if not depth])


def collapse_runs(docs: DataFrame, text_col: str = "text", out: str = "repeats", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with the struct ``out``: n_words, runs (array of struct(start, length, period), by start, then period), collapsed."""
    ship_package(docs.sparkSession)
    word = re.compile(WORD)

    @F.pandas_udf("n_words long, start array<long>, length array<long>, period array<long>, collapsed string")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = word.findall(text or "")
            own = runs(words, least, times)
            rows.append((len(words), own[:, 0], own[:, 1], own[:, 2], collapsed(words, own)))
        return pd.DataFrame(rows, columns=["n_words", "start", "length", "period", "collapsed"])

    raw = fresh("raw", docs.columns)
    told = docs.withColumn(raw, found(F.col(text_col).cast("string")))
    r = F.col(raw)
    zipped = F.arrays_zip(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))
    return told.select(*docs.columns, F.struct(r["n_words"].alias("n_words"), zipped.alias("runs"), r["collapsed"].alias("collapsed")).alias(out))


def repeated_tail(text: Column, doc_id: Column) -> Column:
    """The contract's given: the tail of every tenth document, by hashed id, replaced by repeats of the words it begins with."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, g = F.size(words).cast("long"), F.floor(F.crc32(doc_id.cast("string").cast("binary")) / 10).cast("long")
    a = g % n
    p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("long")
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    chosen = (F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0) & text.rlike(WORD)
    return F.when(chosen, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), again), " ")).otherwise(text)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_tail(F.col("text"), F.col("doc_id")).alias("text"))
    told = collapse_runs(docs).select("doc_id", "repeats.runs", "repeats.collapsed")
    best = F.expr("reduce(runs, cast(NULL AS struct<start: bigint, length: bigint, period: bigint>), (b, r) -> if(b IS NULL OR r.length * b.period > b.length * r.period, r, b))")
    told = told.withColumn("best", best)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
