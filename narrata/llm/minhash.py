"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Texts with equal shingle sets are one class from the start. Each class has a sketch (see ``sketch``), cut into bands; classes
that share a band meet in its bucket. The numbers of bands and rows follow the threshold, so that a pair right at it is
missed with a probability below ``MISS``.

All pairs of a bucket with at most ``SMALL`` classes become candidates, a bounded number for each class. Larger buckets
would make pairs by the square: the classes that meet in them are joined to families. Sets of sizes too far apart can't
link, so a family is parted by size (neighbouring parts still meet), each part is dealt at random into chunks of about
``CHUNK`` classes, and every two chunks that can hold links are compared in one task, where a block of a matrix product
counts common shingles; the task returns no pairs but a spanning forest of its links. No candidate is left out.

All are decided on the full sets of words, not on hashes: the task numbers the words of its texts, so shingles are equal only
if their words are; hashes order candidates, and a class of equal sets is named by SHA-256 over its shingles. Components of
the links follow.

Null and empty texts and those without words have no shingles: they link with nothing. A null id is not compared and
stays; rows that repeat an id are one document, with the links of all its texts. Ties: the least id stands for a component.
Very long texts are taken whole. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import LOWER, UPPER, cut, table
from narrata.llm.sketch import Words, bands, exact_sets, numbered, shingles, signature, sketch
from narrata.operators.graph import components

MISS = 1e-6
SMALL = 16
CHUNK = 128
COLUMNS = 8192
#: Different words numbered before a task starts anew; words in all that a chunk, and a group of pairs, holds on average.
WORDS, CHUNK_WORDS, GROUP_WORDS = 200_000, 200_000, 400_000


def banding(percent: int) -> tuple[int, int]:
    """Rows and number of bands for a threshold in percent."""
    rows = 6 if percent >= 85 else 5 if percent >= 75 else 4
    return rows, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def _sketched(width: int, rows: int, count: int, hashed):
    def run(texts: pd.Series) -> pd.DataFrame:
        words, known, out = Words(hashed), {}, []
        for text in texts:
            if len(words) > WORDS:
                words = Words(hashed)
            ids = numbered(text, words)
            first, hashes = shingles(ids, width, words)
            name = signature(ids, first, width, words)
            if name not in known:
                if len(known) > 1000:
                    known.clear()
                known[name] = bands(sketch(hashes, rows * count), rows).astype(np.int64) if len(first) else np.empty(0, dtype=np.int64)
            out.append((len(first), name, known[name]))
        return pd.DataFrame(out, columns=["n", "sig", "bands"])

    return F.pandas_udf(run, "n long, sig binary, bands array<long>")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right."""
    held = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    total = np.zeros((len(left), len(right)), dtype=np.float64)
    for at in range(0, len(held), COLUMNS):
        part = held[at : at + COLUMNS]
        sides = []
        for side in (left, right):
            m = np.zeros((len(side), len(part)), dtype=np.float32)
            for i, s in enumerate(side):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], side="right")]
                k = np.searchsorted(part, s)
                k[k == len(part)] = 0
                m[i, k[part[k] == s]] = 1
            sides.append(m)
        total += sides[0] @ sides[1].T
    return total


def forest(ids_left: np.ndarray, ids_right: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the same nodes connected as all the linked cells do: of each node with the least it is connected to."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = find(int(ids_left[i])), find(int(ids_right[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(node, least) for node in list(root) if (least := find(node)) != node]


def _confirm(width: int, percent: int):
    """Links of a group of texts: of a block of a family, or of pairs (part -1), each lead with its partners."""

    def linked(sizes_a, sizes_b, shared):
        return 100 * shared >= percent * (sizes_a + sizes_b - shared)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sets, ids, right = exact_sets(list(group["text"]), width), group["cls"].to_numpy(), group["right"].to_numpy()
        sizes = np.array([len(s) for s in sets])
        if key[3] >= 0:
            left, other = np.flatnonzero(~right & (sizes > 0)), np.flatnonzero((right if right.any() else ~right) & (sizes > 0))
            if not len(left) or not len(other):
                return pd.DataFrame({"a": [], "b": []}, dtype="int64")
            shared = common([sets[i] for i in left], [sets[i] for i in other])
            cells = linked(sizes[left][:, None], sizes[other][None, :], shared) & (ids[left][:, None] != ids[other][None, :])
            links = forest(ids[left], ids[other], cells)
        else:
            links, leads = [], {}
            for i in np.flatnonzero(~right):
                leads.setdefault(ids[i], []).append(i)
            for j in np.flatnonzero(right):
                for i in leads.get(group["lead"].iat[j], ()):
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if sizes[i] and sizes[j] and linked(sizes[i], sizes[j], shared):
                        links.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def contracted(links: DataFrame) -> DataFrame:
    """Links of the same components, about one a node: a node's partners are tied to the least of them instead of to the node.

    ``links``: a, b, b the smaller. A node meets in many blocks, but their least members are few.
    """
    least = F.min("b").over(Window.partitionBy("a"))
    ties = links.distinct().withColumn("m", least).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return ties.where("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, small: int = SMALL, chunk: int = CHUNK, hashed=xxhash.xxh3_64_intdigest,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept. ``hashed`` gives a word's 64 bits for the sketches."""
    ship_package(docs.sparkSession)
    rows, count = banding(percent)
    text = F.col(text_col).cast("string")
    found = cut(docs.select(F.col(id_col).alias("doc_id"), _sketched(width, rows, count, hashed)(text).alias("s")).select("doc_id", "s.*"))
    compared = found.where("n > 0 AND doc_id IS NOT NULL")
    classes = compared.groupBy("sig").agg(F.min("doc_id").alias("cls"), F.first("bands").alias("bands"), F.first("n").alias("n"))
    part = F.floor(F.log("n") / float(math.log(100 / percent) * (1 + 1e-9))).cast("int")  # sets that link lie in one part or in neighbours
    met = cut(classes.select("cls", "n", part.alias("part"), F.explode("bands").alias("key")))
    buckets = cut(met.groupBy("key").agg(F.count("*").alias("c"), F.min("cls").alias("lead")).where("c > 1"))
    members = met.join(buckets, "key")

    together = members.where(F.col("c") <= small).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("cls", "part", "n"))).alias("g"))
    each = F.expr("filter(flatten(transform(g, (x, i) -> transform(slice(g, i + 2, size(g)), y -> struct(x.cls AS a, y.cls AS b, y.n AS n, abs(x.part - y.part) AS apart)))), p -> p.apart <= 1 AND p.a <> p.b)")
    pairs = cut(together.select(F.explode(each).alias("p")).groupBy("p.a", "p.b").agg(F.max("p.n").alias("n")))
    families = components(members.where((F.col("c") > small) & (F.col("cls") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("cls").alias("b")))

    none = F.lit(0).cast("long")
    batches = max(1, -(-2 * (pairs.agg(F.sum("n")).first()[0] or 0) // GROUP_WORDS))
    batch = F.pmod(F.xxhash64("a"), F.lit(batches))
    asked = pairs.select("a", F.col("a").alias("cls"), F.lit(False).alias("right")).distinct().unionByName(pairs.select("a", F.col("b").alias("cls"), F.lit(True).alias("right")))
    singly = asked.select(none.alias("component"), batch.alias("i"), none.alias("j"), F.lit(-1).alias("p"), F.lit(-1).alias("q"), "cls", F.col("a").alias("lead"), "right")

    sized = families.join(classes.select(F.col("cls").alias("node"), "n", part.alias("part")).groupBy("node", "part").agg(F.max("n").alias("words")), "node").withColumnRenamed("node", "cls")
    chunks = cut(sized.groupBy("component", "part").agg(F.ceil(F.greatest(F.count("*") / chunk, F.sum("words") / CHUNK_WORDS)).alias("n")))
    beside = lambda step, name: chunks.select("component", (F.col("part") - step).alias("part"), F.col("n").alias(name))
    known = chunks.join(beside(1, "above"), ["component", "part"], "left").join(beside(-1, "below"), ["component", "part"], "left")
    own = sized.join(known, ["component", "part"]).withColumn("own", F.pmod(F.xxhash64("cls"), "n"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<long>"))
    block = lambda p, q, i, j, right: F.struct(p.alias("p"), q.alias("q"), i.alias("i"), j.alias("j"), right.alias("right"))
    here, mine = F.col("part"), F.col("own")
    blocks = F.concat(
        F.transform(upto("n"), lambda o: block(here, here, F.least(mine, o), F.greatest(mine, o), mine > o)),
        F.transform(upto("above"), lambda o: block(here, here + 1, mine, o, F.lit(False))),
        F.transform(upto("below"), lambda o: block(here - 1, here, o, mine, F.lit(True))),
    )
    jointly = own.select("cls", "component", F.explode(blocks).alias("x")).select("component", "x.i", "x.j", "x.p", "x.q", "cls", F.lit(None).cast("long").alias("lead"), "x.right")

    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    work = singly.unionByName(jointly).join(texts, F.col("cls") == F.col("doc_id")).drop("doc_id")
    links = work.groupBy("component", "i", "j", "p", "q").applyInPandas(_confirm(width, percent), "a long, b long")
    joined = components(contracted(cut(links)))
    named = cut(compared.groupBy("sig").agg(F.min("doc_id").alias("cls")).join(joined.withColumnRenamed("node", "cls"), "cls", "left").select("sig", F.coalesce("component", "cls").alias("component_id")))
    grouped = compared.join(named, "sig").select("doc_id", "n", "component_id")
    alone = found.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


SQL = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
single AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.e = b.e AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(node, other) AS (SELECT a, b FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, s.s
"""
