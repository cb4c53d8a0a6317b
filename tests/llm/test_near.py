"""Near duplicates of documents and vectors against brute force, and the pipeline's stages."""

import re

import duckdb
import numpy as np
import pytest
import xxhash
from comparing import same_rows
from pyspark.sql import functions as F

from narrata.llm import minhash, mixing, neighbours
from narrata.llm.sketch import Words, bands, exact_sets, numbered, shingles, signature, sketch


def test_sketch_estimates_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    for share in (0.5, 0.85, 0.95):
        n = int(1000 * 2 * share / (1 + share))
        other = np.concatenate([base[:n], rng.integers(0, 1 << 62, 1000 - n).astype(np.uint64)])
        agree = np.mean(sketch(base, 600) == sketch(other, 600))
        assert abs(agree - n / (2000 - n)) < 0.08
    for n in (1, 2, 3, 10):
        full = sketch(base[:n], 192)
        assert (full != ~np.uint64(0)).all() and (sketch(base[:n][::-1], 192) == full).all()
    assert len(bands(sketch(base, 192), 6)) == 32


def hand_set(text, width):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    used = min(width, len(found))
    return {tuple(found[i : i + used]) for i in range(len(found) - used + 1)} if used else set()


def test_shingles():
    texts = ["A b\tC", "a  B c", "a b", "a b c", "\u00c9 b c", "\u00e9 b c", "c b a", "a b a b a b", None, " \n", "a b c d e f a b c d"]
    for hashed in (xxhash.xxh3_64_intdigest, lambda word: len(word)):
        words, names, runs = Words(hashed), [], []
        for t in texts:
            ids = numbered(t, words)
            first, _ = shingles(ids, 3, words)
            runs.append(first)
            names.append(signature(ids, first, 3, words))
        assert [len(r) for r in runs] == [len(hand_set(t, 3)) for t in texts]
        for i, s in enumerate(texts):
            assert [names[i] == n for n in names] == [hand_set(s, 3) == hand_set(t, 3) for t in texts]
    for width in (3, 5, 9):
        found = exact_sets(texts, width)
        for s, x in zip(texts, found, strict=True):
            assert [len(np.intersect1d(x, y)) for y in found] == [len(hand_set(s, width) & hand_set(t, width)) for t in texts]


def by_hand(rows, width, percent):
    sets = [(i, hand_set(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((str(i), len(s), str(find(i) if i is not None else None)) for i, s in sets)


def told(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("small, chunk", [(16, 128), (2, 5)])
def test_near_duplicates_by_hand(spark, small, chunk):
    """Families of edited copies round the threshold, by pairs and by blocks of small chunks."""
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for size in (1, 2, 5, 30, 60):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, 120, rng.integers(0, 6)):
                text[at] = f"e{rng.integers(0, 5000)}"
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(i + k, " ".join(f"w{x}" for x in rng.integers(0, 5000, 80))) for k in range(60)] + [(3, "a b"), (500, "A B"), (501, "a b"), (502, None), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((3, 85), (5, 80)):
        assert told(minhash.near_duplicates(docs, width=width, percent=percent, small=small, chunk=chunk)) == by_hand(rows, width, percent)


def test_near_duplicates_with_colliding_hashes(spark):
    """Hashes of words that collide all the time make more candidates and never a wrong size, class or link."""
    rng = np.random.default_rng(6)
    rows = []
    for size in (1, 2, 6, 25):
        base = [f"w{x}" for x in rng.integers(0, 500, 60)]
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, 60, rng.integers(0, 4)):
                text[at] = f"e{rng.integers(0, 500)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, " ".join(f"w{x}" for x in rng.integers(0, 500, 40))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda word: sum(word) % 5
    assert told(minhash.near_duplicates(docs, width=3, percent=85, hashed=weak, chunk=8)) == by_hand(rows, 3, 85)


def test_near_duplicates_edges(edges, empty):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert told(minhash.near_duplicates(edges, width=3, percent=85)) == by_hand(rows, 3, 85)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_table(spark, small, duck):
    same_rows(minhash.op4_minhash(spark, small), minhash.SQL, duck)


def test_block_of_common_elements():
    rng = np.random.default_rng(2)
    left, right = ([np.unique(rng.integers(0, 30_000, n)) for n in rng.integers(1, 3000, 12)] for _ in range(2))
    assert (minhash.common(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, v string")


def against_sql(spark, rows):
    df = vectors(spark, rows)
    con = duckdb.connect()
    con.register("raw", df.select("vec_id", "label").toPandas().astype({"vec_id": "Int64", "label": "Int64"}))
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [(r[0], r[1], r[2]) for r in rows])
    same_rows(neighbours.near_vectors(df), neighbours.SQL, con)


def test_vectors_by_hand(spark):
    """Single pairs, loose and tight groups, exact copies, other labels, and vectors that can't be compared."""
    rng = np.random.default_rng(7)
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(32))
    rows, i = [], 0
    for size, noise in ((1, 0), (40, 0.004), (25, 0.03), (8, 0.0), *[(2, 0.02)] * 20, *[(1, 0.0)] * 150):
        base = unit()
        for _ in range(size):
            rows.append((i, (base + noise * rng.standard_normal(32)).tolist(), i % 2 if size == 8 else 1 if size > 2 else 0, "a", "b"))
            i += 1
    nan, inf = float("nan"), float("inf")
    rows += [(i + 1, None, 1, "", ""), (i + 2, [], 1, "", ""), (i + 3, [0.0] * 32, 1, "", ""), (i + 4, [nan] + [1.0] * 31, 1, "", ""), (i + 5, [inf] + [1.0] * 31, 1, "", ""), (i + 6, [1.0] * 32, None, "", ""), (i + 7, [1.0] * 31, 1, "", ""), (i + 8, [None] + [1.0] * 31, 1, "", ""), (i + 9, rows[0][1], rows[0][2], "", "")]
    against_sql(spark, rows)


def test_vectors_null_ids_repeats_and_none(spark):
    rows = [(1, [1.0, 0.0], 1, "", ""), (1, [1.0, 0.0], 1, "", ""), (2, [1.0, 0.01], 1, "", ""), (None, [1.0, 0.0], 1, "", ""), (3, [0.0, 1.0], 1, "", ""), (3, [1.0, 0.0], 2, "", "")]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in neighbours.near_vectors(vectors(spark, rows)).collect())
    assert got == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 2, "1", False), ("3", 0, "3", True), ("3", 0, "3", True), ("None", 0, "None", True)]
    assert neighbours.near_vectors(vectors(spark, rows).limit(0)).count() == 0


def test_vectors_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = neighbours.near_vectors(rows).cache()
    assert found.first().recall >= 0.9
    raw = rows.toPandas()
    links = found.toPandas().set_index("vec_id").n_links
    true = got = 0
    for _, part in raw.groupby("label"):
        x = np.stack(part.embedding.to_numpy()).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        n = (x @ x.T >= 0.98).sum(axis=1) - 1
        mine = links.loc[part.vec_id].to_numpy()
        assert (mine <= n).all()
        true, got = true + n.sum(), got + mine.sum()
    assert got >= 0.9 * true


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small).cache()
        seen[name] = (docs, out)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
    given, kept = seen["language"]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in given.collect() if any(c.isalpha() for c in r.text or "")}
    given, kept = seen["near_duplicates"]
    hand = by_hand([(r.doc_id, r.text) for r in given.collect()], 5, 80)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(i for i, _, c in hand if i == c)
    given, kept = seen["mixing"]
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in given.collect()}
    given, kept = seen["language"]
    before, after = ({r.doc_id: r.lang for r in df.collect()} for df in (given, kept))
    assert set(after) <= set(before) and all(after.values())
    given, packed = seen["packing"]
    own = {}
    for r in packed.where("bin_id IS NOT NULL").collect():
        assert own.setdefault(r.bin_id, r.lang) == r.lang
    assert {(r.doc_id, r.lang, r.source) for r in packed.collect()} == {(r.doc_id, r.lang, r.source) for r in given.collect()}
    assert sum(r.length for r in packed.collect()) == sum(len((r.text or "").split()) for r in given.collect())


def test_pipeline_edges(spark, edges, empty):
    import corpus_pipeline

    for table in (edges, empty):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "").cache()
            if name != "packing":
                assert docs.columns == table.columns
        if table is empty:
            assert docs.count() == 0
            continue
        ids = {r.doc_id for r in docs.where("bin_id IS NOT NULL").collect()}
        # letterless and null texts go, later lines and near copies too; what is left is packed or, by the mix, passed over
        assert ids and ids <= {None, 4, 5, 6, 8, 10, 11, 12} and 13 not in ids and 9 not in ids and 7 not in ids


def test_pipeline_mixing_keeps_long_documents(spark):
    """A hot source with a share of 0.1 keeps its words and its long documents; so does a source made only of those."""
    import corpus_pipeline

    long = [(i, " ".join(["w"] * (16_000 + 7 * i)), "en", "a") for i in range(60)]
    short = [(1000 + i, " ".join(["w"] * (i * 7919 % 900 + 1)), "en", "a") for i in range(1500)]
    alone = [(3000 + i, " ".join(["w"] * 60_000), "en", "d") for i in range(12)]
    rest = [(10_000 * (k + 1) + i, " ".join(["w"] * (i % 300 + 1)), "en", f"e{k:02d}") for k in range(16) for i in range(500)]
    rows = long + short + alone + rest
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.mix_sources(spark, docs, "").selectExpr("doc_id", "source", "size(split(text, ' ')) AS n").collect()
    size, longest, want, got = {}, {}, {}, {}
    for _, t, _, s in rows:
        size[s], longest[s] = size.get(s, 0) + len(t.split()), max(longest.get(s, 0), len(t.split()))
    aimed = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(size.items()), "source string, source_size long")).collect()}
    for r in kept:
        got[r.source] = got.get(r.source, 0) + r.n
    assert aimed["a"] / size["a"] < 0.25
    for s, t in aimed.items():
        assert abs(got.get(s, 0) - t) <= 2 * longest[s], (s, got.get(s, 0), t)
    share = sum(r.source == "a" and r.n > 10_000 for r in kept) / len(long)
    assert abs(share - aimed["a"] / size["a"]) <= 2 / len(long)


def test_pipeline_language_without_labels(spark):
    """Without a language to learn from, clean documents stay and only null and letterless texts go."""
    import corpus_pipeline

    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(["clean text", "ein Text", None, "", "12 !?", "\u6f22\u5b57"])], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 5}


def test_pipeline_language_parts(spark, middle):
    """Two languages part where one is wanted; what no language codes goes; a missing language is filled in; the rest stays."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{middle}/documents.parquet").where("lang IN ('de', 'fr')")
    top = 10_000_000
    odd = [(top + 1, "\u6f22\u5b57\u4eee\u540d\u4ea4\u3058\u308a\u6587\u306e\u6587\u7ae0\u3092\u66f8\u304f" * 3, None, "s", 1), (top + 2, "einheit erheit und der ungeach", None, "s", 1), (top + 3, "12 !", "de", "s", 1), (top + 4, "A.", None, "s", 1)]
    given = docs.unionByName(spark.createDataFrame(odd, docs.schema)).cache()
    kept = {r.doc_id: r for r in corpus_pipeline.identify_language(spark, given, "").collect()}
    clean = {r.doc_id: r.lang for r in docs.collect()}
    assert set(clean) <= set(kept) and set(kept) - set(clean) == {top + 2, top + 4}
    assert sum(kept[i].lang == lang for i, lang in clean.items()) >= 0.98 * len(clean) and kept[top + 2].lang == "de"
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") % 20 == 1, F.when(F.col("lang") == "de", "fr").otherwise("de")).otherwise(F.col("lang")))
    mended = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, wrong, "").collect()}
    odd = [i for i in clean if i % 20 == 1]
    assert odd and sum(mended[i] == clean[i] for i in odd) >= 0.9 * len(odd)
    german = {r.doc_id for r in corpus_pipeline.identify_language(spark, given, "", languages=("de",)).collect()}
    french = {r.doc_id for r in corpus_pipeline.identify_language(spark, given, "", languages=("fr",)).collect()}
    assert not german & french and german | french == set(kept)
    assert sum(clean.get(i) == "de" for i in german) >= 0.97 * len(german) and sum(clean.get(i) == "fr" for i in french) >= 0.97 * len(french)


def test_vectors_audit_sees_lost_links(spark, monkeypatch):
    """A dense group and many single vectors don't hide that the graph lost all links elsewhere; blocks then find them."""
    rng = np.random.default_rng(11)
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(32))
    rows = []
    for size, noise in ((400, 0.001), *[(2, 0.02)] * 8, *[(1, 0.0)] * 100):
        base = unit()
        rows += [(len(rows) + k, (base + noise * rng.standard_normal(32)).tolist(), 0, "a", "b") for k in range(size)]
    whole = neighbours.neighbour_graph
    monkeypatch.setattr(neighbours, "neighbour_graph", lambda *a: whole(*a).where("false"))
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    got = neighbours.near_vectors(vectors(spark, rows), tries=1).toPandas().sort_values("vec_id")
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert want[400:416].sum() >= 8 and got.n_links.tolist() == want.tolist() and got.recall.iloc[0] == 1.0


def test_vectors_audit_where_links_are_rarer_than_its_draw(spark, monkeypatch):
    """Two linked pairs among 602 vectors, an audit of one vector, and a graph that lost all: the links are found all the same."""
    rng = np.random.default_rng(13)
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(32))
    rows = [(i, unit().tolist(), 0, "a", "b") for i in range(598)]
    for _ in range(2):
        base = unit()
        rows += [(len(rows) + k, (base + 0.02 * rng.standard_normal(32)).tolist(), 0, "a", "b") for k in range(2)]
    whole = neighbours.neighbour_graph
    monkeypatch.setattr(neighbours, "neighbour_graph", lambda *a: whole(*a).where("false"))
    monkeypatch.setattr(neighbours, "DRAWS", 3)
    got = neighbours.near_vectors(vectors(spark, rows), audit=1, tries=1).toPandas().sort_values("vec_id")
    assert got.n_links.tolist() == [0] * 598 + [1] * 4 and got.recall.iloc[0] == 1.0
    alone = neighbours.near_vectors(vectors(spark, rows[:200]), audit=1).toPandas()
    assert (alone.n_links == 0).all() and (alone.recall == 1.0).all()


def test_vectors_at_the_threshold(spark):
    """Cosines of exactly 0.98 in doubles link, those just below do not."""
    at = [0.98, float(np.sqrt(1 - 0.98**2))]
    pairs = [([1.0, 0.0], at), ([1.0, 0.0], [np.nextafter(np.float32(at[0]), np.float32(0)), at[1]])]
    rows = [(2 * k + i, [float(np.float32(c)) for c in v], k, "", "") for k, pair in enumerate(pairs) for i, v in enumerate(pair)]
    against_sql(spark, [(*r[:1], r[1], *r[2:]) for r in rows] + [(10, [3.0, 4.0], 9, "", ""), (11, [3.0, 4.0], 9, "", ""), (12, [6.0, 8.0], 9, "", "")])


def test_vectors_in_blocks(spark, monkeypatch):
    """Big tight balls, a loose group and small families over several blocks: all counts as by brute force."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(12)
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(32))
    rows, near = [], unit()
    for size, noise, base in ((60, 0.004, near), (50, 0.004, near + 0.16 * unit()), (70, 0.028, unit()), *[(3, 0.02, unit()) for _ in range(12)], *[(1, 0.0, unit()) for _ in range(60)]):
        rows += [(len(rows) + k, (base + noise * rng.standard_normal(32)).tolist(), 0, "a", "b") for k in range(size)]
    against_sql(spark, rows)
