"""Block naming, line dedup and mixing against SQL or brute force."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest
from comparing import same_rows
from pyspark.sql import functions as F

from narrata.llm import exact_dedup, line_dedup, mixing


def against_sql(df, docs, sql):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    same_rows(df, sql, con)


@pytest.mark.parametrize("block", [2, 7, 4096])
def test_exact_dedup_edges(edges, block):
    against_sql(exact_dedup.exact_duplicates(edges if block > 2 else edges.where("length(text) < 100 OR text IS NULL"), block_chars=block), edges if block > 2 else edges.where("length(text) < 100 OR text IS NULL"), exact_dedup.SQL)


def test_exact_dedup_survives_hash_collisions(edges):
    """With a hash of three values almost all blocks collide; names are still free of collisions."""
    against_sql(exact_dedup.exact_duplicates(edges, block_chars=4096, hashed=lambda c: F.pmod(F.xxhash64(c), F.lit(3))), edges, exact_dedup.SQL)
    short = edges.where("length(text) < 100")
    against_sql(exact_dedup.exact_duplicates(short, block_chars=4, hashed=lambda c: F.pmod(F.xxhash64(c), F.lit(2))), short, exact_dedup.SQL)


def test_exact_dedup_table(spark, small, duck):
    same_rows(exact_dedup.op6_exact_dedup(spark, small), exact_dedup.SQL, duck)


def test_exact_dedup_empty(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0


def lines_by_hand(rows, least=10):
    first = {}
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i or 0)
    for i, t in rows:
        for x in (t or "").split("\n"):
            first[key(x)] = min(first.get(key(x), (True, 1)), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup_edges(edges):
    got = line_dedup.drop_lines(edges, out="figures")
    rows = got.select("doc_id", "figures.n_lines", "figures.n_dropped", F.sha2("text", 256)).collect()
    assert Counter(tuple(r) for r in rows) == lines_by_hand([(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()])
    assert got.columns[:-1] == edges.columns


def test_line_dedup_many_lines(spark):
    """More than 64 lines a document, drops far apart, one line in every document."""
    rows = [(i, "\n".join(f"shared line number {k}" if k % (i + 2) == 0 else f"own line {i} {k}" for k in range(300)) + "\nthe very same last line") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.drop_lines(docs).select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("text", 256)).collect()
    assert Counter(tuple(r) for r in got) == lines_by_hand(rows)


def test_line_dedup_table(spark, small, duck):
    same_rows(line_dedup.op8_line_dedup(spark, small), line_dedup.SQL, duck)


def test_line_dedup_empty(empty):
    assert line_dedup.drop_lines(empty, out="f").count() == 0


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    """Share, cap, share the excess again until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        open_w = sum(w[s] for s in names if s not in capped)
        t = {s: most * sizes[s] if s in capped else rest * w[s] / open_w for s in names}
        over = {s for s in names if s not in capped and t[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return t
        capped |= over


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (i * 7919 % 97)), "en", f"s{i * i % 11}" if i % 5 else None) for i in range(4000)] + [(9000 + i, "tiny text", "en", "zz") for i in range(3)] + [(9100, None, "en", "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, shard_words=5000).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = defaultdict(int)
    for i, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = targets_by_hand(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.01 * t, 2), (s, taken[s], t)


def test_mixing_reruns_agree_and_edges(edges, empty):
    once = lambda: sorted(map(str, mixing.mix(edges.repartition(3)).collect()))
    assert once() == once() and len(once()) == edges.count()
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize("votes, seats", [([53, 24, 23], 7), ([1000, 1, 1, 1], 10), ([5, 5, 5], 4), ([0, 3], 5), ([7], 3), ([0, 0], 4), ([1, 1, 1, 1, 1, 1, 1], 3)])
def test_sainte_lague(spark, votes, seats):
    df = spark.createDataFrame([("g", i, v, seats) for i, v in enumerate(votes)], "g string, key int, votes long, seats long")
    got = {r.key: r.own for r in mixing.apportion(df, ["g"], "key", "votes", "seats", "own").collect()}
    want = dict.fromkeys(range(len(votes)), 0)
    for _ in range(seats if sum(votes) else 0):
        best = max(want, key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
        want[best] += 1
    assert got == want
