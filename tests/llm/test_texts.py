"""Resampling, periodic runs and token counts against SQL, brute force and the library."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from comparing import same_rows
from pyspark.sql import functions as F

from narrata.llm import periodic, resampling, token_counts


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def scored_by_hand(rows, target, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in rows], target))
    whole, aimed = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (whole + buckets) / ((s[b] + 1) * (aimed + buckets))))
    out = []
    for i, x in rows:
        words, own = features(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in own)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    return out


def resampled_by_hand(scored, percent=5, least=20):
    out = [list(r) for r in scored]
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    ranks = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


def told(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_crc_of_runs():
    parts = [b"", b"a", b"word", "hé 漢".encode(), b"x" * 70_001]
    for a in parts:
        for b in parts:
            crc = [np.array([zlib.crc32(x)], dtype=np.uint32) for x in (a, b)]
            assert resampling.followed(crc[0], crc[1], np.array([len(b)]))[0] == zlib.crc32(a + b)


def test_resampling_by_hand(spark, edges, monkeypatch):
    monkeypatch.setattr(resampling, "BATCH_WORDS", 50)
    rng = np.random.default_rng(3)
    rows = [(int(i % 250), " ".join(f"W{x}" for x in rng.integers(0, 60, rng.integers(0, 60)))) for i in range(300)]
    rows += [(1000 + i, rows[0][1] + " tail of the hot copies") for i in range(200)] + [(r.doc_id, r.text) for r in edges.collect()]
    rows += [(5000, "one two " * 15)] * 3
    target = ["w1 w2 w3 w4 W5", "w1 w2 w7", None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("name", "part", "score", "rank", "copies")})
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    scored = scored_by_hand(rows, target)
    for percent in (5, 100, 0):
        assert told(resampling.resample(docs, aims, percent=percent)) == resampled_by_hand(scored, percent=percent)
    assert told(resampling.resample(docs, aims.limit(0))) == resampled_by_hand(scored_by_hand(rows, []))
    assert resampling.resample(docs.limit(0), aims).count() == 0


def test_resampling_table(spark, small, duck):
    same_rows(resampling.op11_resampling(spark, small), resampling.SQL, duck)


def runs_by_hand(words, least=24, times=3):
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed_by_hand(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cases():
    rng = np.random.default_rng(4)
    for _ in range(150):
        base = [f"w{x}" for x in rng.integers(0, 3, rng.integers(1, 30))]
        yield (base * 12)[: rng.integers(0, 200)] + base[: rng.integers(0, 5)] + ["x"] * int(rng.integers(0, 40)) + (["y", "z"] * 20)[: rng.integers(0, 40)]
    for n in (23, 24, 25, 71, 72, 73):
        yield ["same"] * n
        yield [f"u{i}" for i in range(n // 3)] * 3
        yield [f"u{i}" for i in range(24)] * 3 + ["u0"]
    for size in (1, 2, 7, 8, 9, 100, 333):
        yield [f"a{i}" for i in range(50)] + [f"u{i % size}" for i in range(3 * size + 24)] + [f"u{i % size}" for i in range(3 * size)]
    a, b = ["a"], ["b"]
    for _ in range(12):
        a, b = a + b, a  # a Fibonacci word: very many repetitions
    yield a
    yield [f"w{x}" for x in rng.integers(0, 2, 400)]
    yield []


@pytest.mark.parametrize("least, times", [(24, 3), (4, 2), (9, 3), (1, 2), (40, 5)])
def test_runs_by_hand(least, times, monkeypatch):
    for pairs in (1 << 21, 97):
        monkeypatch.setattr(periodic, "PAIRS", pairs)
        for words in cases():
            found = periodic.runs(words, least, times)
            assert [tuple(r) for r in found.tolist()] == runs_by_hand(words, least, times)
            assert periodic.collapsed(words, found) == collapsed_by_hand(words, found.tolist())


def periodic_by_hand(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if i is None else zlib.crc32(str(i).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = runs_by_hand(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    tail = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, len(found), *tail, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed_by_hand(words, found)))


def test_periodic_query(spark, tmp_path, edges):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, rng.integers(0, 150)))) for i in range(300)] + [(i, " ".join(w)) for i, w in enumerate(cases(), 1000)]
    rows += [(r.doc_id, r.text) for r in edges.where("length(text) < 10000 OR text IS NULL").collect()] + [(7, "again and " * 40)] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in periodic.op12_periodic(spark, str(tmp_path)).collect())
    assert got == Counter(periodic_by_hand(i, t) for i, t in rows)
    assert sum(r[1] > 0 for r in got) > 100


def test_periodic_operator_keeps_columns(edges, empty):
    got = periodic.collapse_runs(edges, out="found")
    assert got.columns == [*edges.columns, "found"] and got.count() == edges.count()
    assert {r.n for r in got.where("doc_id IN (8, 9)").selectExpr("found.n_words AS n").collect()} == {120_000}
    assert periodic.collapse_runs(empty).count() == 0


def tokens_by_hand(texts, name="byte_bpe_50k.json"):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path(name))
    return [len(own.encode(t, add_special_tokens=False)) for t in texts]


ODD = ["", " ", "  a  b ", "a b  c", "don't we'll 'll ' l", "x ᠎ y᠎ z", "\n\n a\n b \n", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>  c <|endof text|>", "漢字 \U0001f600 é́ ", "1 22 333 4444", "\x1c a \x1d", "a" * 3000, " " * 3000, "\t" * 500 + "x", "ab " * 700]


def pieces(rng, n):
    parts = ["word ", "don't", "'ll", " ", "  ", "\n", "<|endoftext|>", "<|endo", "été ", "漢字", "\U0001f600", "123", "...", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "A-b_c ", "᠎", " ", " the", " and"]
    return "".join(parts[x] for x in rng.integers(0, len(parts), n))


def test_units_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", 40)
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        own = token_counts.Tokens("byte_bpe_50k.json", file.read())
    rng = np.random.default_rng(6)
    texts = ODD + [pieces(rng, int(n)) for n in rng.integers(1, 60, 3000)]
    for at in range(0, len(texts), 100):
        assert own.counts(texts[at : at + 100]) == tokens_by_hand(texts[at : at + 100])


def test_chunks_are_spliced(spark):
    """Small chunks and overlaps: contractions, special strings, white space and long words at the joints."""
    rng = np.random.default_rng(7)
    texts = ODD + [pieces(rng, int(n)) for n in rng.integers(50, 800, 120)] + ["a" * 5000 + " b" * 300, " " * 4000 + "x", "b " * 100 + "漢" * 3000 + "c d" * 90, "<|endoftext|>" * 300]
    texts += texts[:20]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x"), (3, None, "x")], "doc_id long, text string, key string")
    got = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), chunk=128, overlap=32)
    assert got.columns == ["doc_id", "text", "key", "tokens"]
    rows = got.collect()
    want = Counter(zip([*range(len(texts)), None, 3], [len(t.encode()) for t in texts] + [0, 0], tokens_by_hand(texts) + [0, 0], strict=True))
    assert Counter((r.doc_id, *r.tokens) for r in rows) == want


def test_alignment_fails_and_overlaps_widen(spark, monkeypatch):
    """A word longer than the overlap has no common beginning at first."""
    widths, whole = [], token_counts._spliced

    def seen(huge, shared, chunk, overlap):
        done = whole(huge, shared, chunk, overlap)
        widths.append((overlap, done.where("n_tokens IS NULL").count()))
        return done

    monkeypatch.setattr(token_counts, "_spliced", seen)
    texts = ["so " * 60 + "a" * 700 + " it goes" * 60, "plain words " * 80]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.tokens.n_tokens for r in token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), chunk=128, overlap=32).collect()}
    assert [got[0], got[1]] == tokens_by_hand(texts)
    assert widths[0] == (32, 1) and widths[1][0] == 128 and widths[-1][1] == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_run_whole(spark, name):
    texts = [t for t in ODD if len(t) < 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.tokens.n_tokens for r in token_counts.count_tokens(docs, public_tokenizers.path(name), chunk=64, overlap=16).collect()}
    if name.endswith(".model"):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        want = [len(own.encode(t)) for t in texts]
    else:
        want = tokens_by_hand(texts, name)
    assert [got[i] for i in range(len(texts))] == want


def test_token_counts_table_and_edges(spark, small, edges, empty):
    rows = token_counts.op13_token_counts(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = dict(zip(texts, tokens_by_hand(list(texts.values())), strict=True))
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {i: (len(t.encode()), want[i], want[i] > 512) for i, t in texts.items()}
    got = token_counts.count_tokens(edges, public_tokenizers.path("byte_bpe_50k.json"))
    assert Counter(r.tokens.n_tokens for r in got.collect()) == Counter(tokens_by_hand([r.text or "" for r in edges.collect()]))
    assert token_counts.count_tokens(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_resampling_sql_alone(small):
    """The SQL's crc32 is the usual one."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT 1 AS doc_id, 'ab é z' AS text")
    con.execute("CREATE TABLE benchmark AS SELECT 'ab' AS text")
    s = Counter(zlib.crc32(f.encode()) % 10_000 for f in features("ab é z")[1])
    t = Counter([zlib.crc32(b"ab") % 10_000])
    want = sum(n * math.floor(1000 * math.log((t[b] + 1) * 10_006 / ((s[b] + 1) * 10_001))) for b, n in s.items())
    assert con.execute(resampling.SQL).fetchall()[0][1:3] == (6, want)
