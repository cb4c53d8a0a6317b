"""The rule parser on sentences with known trees, its invariants, and triplets against nested loops."""

import time
from itertools import product

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from narrata.operators import extraction, parsing

GOLD = {
    "The UK Government announced new policies.": [("Government", "announced", "policies")],
    "Apple CEO Tim Cook met with Microsoft CEO Satya Nadella in Washington on Monday.": [("Cook", "met", "Nadella"), ("Cook", "met", "Washington"), ("Cook", "met", "Monday")],
    "The treaty was signed by the two presidents.": [],
    "The ministers have not signed the treaty in Paris.": [("ministers", "signed", "treaty"), ("ministers", "signed", "Paris")],
    "John and Mary bought a big house and sold the old car.": [("John", "bought", "house")],
    "She is a doctor.": [("She", "is", "she")],
    "The head of state visited Berlin.": [("head", "visited", "Berlin")],
    "Rain.": [],
    "12 people": [],
}


def trees(text):
    words = [m[0] for m in parsing._WORD.finditer(text)]
    return words, parsing.rule_parser(words)


def pairs_by_loops(words, tree):
    found = []
    for a, (pos, _, dep) in enumerate(tree):
        if dep != "ROOT" or pos not in ("VERB", "AUX"):
            continue
        subjects = [i for i, (_, h, d) in enumerate(tree) if h == a and d in extraction.SUBJECTS and i != a]
        preps = [i for i, (_, h, d) in enumerate(tree) if h == a and d == "prep"]
        objects = [i for i, (_, h, d) in enumerate(tree) if i != a and ((h == a and d in extraction.OBJECTS) or (d == "pobj" and h in preps))]
        for s, o in product(subjects, objects):
            sure = max(0.0, min(1.0, 0.8 - min(0.2, 0.2 * (abs(s - a) + abs(o - a)) / 20) + 0.1 + 0.1 * (tree[o][1] == a)))
            found.append((words[s], words[a], words[o], round(sure, 9)))
    return sorted(found)


def test_known_sentences():
    for text, want in GOLD.items():
        words, tree = trees(text)
        told = [(s, a, o) for s, a, o, _ in pairs_by_loops(words, tree)]
        assert sorted(told) == sorted(w for w in want if w[2] != "she"), text
    words, tree = trees("The treaty was signed by the two presidents.")
    assert {(w, d) for w, (_, _, d) in zip(words, tree, strict=True)} >= {("treaty", "nsubjpass"), ("was", "auxpass"), ("signed", "ROOT"), ("by", "agent"), ("presidents", "pobj")}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["The", "a", "Berlin", "Ann", "dogs", "met", "was", "signed", "by", "of", "in", "and", "quickly", "not", ",", "7", "new", "because", "is", "running", "zß"]), max_size=25))
def test_trees_are_whole_and_projective(words):
    tree = parsing.rule_parser(words)
    assert len(tree) == len(words) and sum(d == "ROOT" for _, _, d in tree) == (1 if words else 0)
    for i, (_, head, dep) in enumerate(tree):
        assert (head == i) == (dep == "ROOT") and dep
        seen, at = set(), i
        while tree[at][1] != at:
            assert at not in seen
            seen.add(at)
            at = tree[at][1]
    arcs = [(min(i, h), max(i, h)) for i, (_, h, _) in enumerate(tree) if i != h]
    assert not any(a < c < b < d for a, b in arcs for c, d in arcs)


WORDS = ["The", "a", "Berlin", "Ann", "dogs", "met", "Met", "was", "were", "signed", "seeing", "Running", "by", "By", "of", "in", "and", "quickly", "not", "never", ",", "7", "3.5", "new", "New", "famous", "because", "is", "_x", "zß", "can", "ed", "himself"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=18), max_size=70), st.sampled_from([1, 8, 48]))
def test_sentences_together_as_one_by_one(sentences, few):
    before, parsing.FEW_LEFT = parsing.FEW_LEFT, few
    try:
        texts = [" " + "  ".join(words) for words in sentences]
        rows = parsing._by_rules(pa.array(texts, pa.string()), pa.array(range(len(texts)), pa.int32())).to_pylist()
    finally:
        parsing.FEW_LEFT = before
    for k, (text, tokens) in enumerate(zip(texts, rows, strict=True)):
        found = list(parsing._WORD.finditer(text))
        assert [(t["i"], t["word"], t["start_char"]) for t in tokens] == [(i, m[0], k + m.start()) for i, m in enumerate(found)]
        assert [(t["pos"], t["head"], t["dep"]) for t in tokens] == parsing.rule_parser([m[0] for m in found])


def test_a_batch_is_parsed_together():
    """Under half the time of one sentence after the other."""
    texts = pa.array(["The man of state has signed a treaty and Ann met the famous dogs in Berlin."] * 3000)
    starts = pa.array([0] * 3000, pa.int32())

    def took(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    parsing._by_rules(texts, starts)
    one_by_one = lambda: [parsing.rule_parser(parsing._WORD.findall(t)) for t in texts.to_pylist()]
    assert min(took(lambda: parsing._by_rules(texts, starts)) for _ in range(3)) < 0.5 * min(took(one_by_one) for _ in range(3))


def test_parser_is_linear():
    def took(n):
        words = ["The", "man", "of", "state", "has", "signed", "a", "treaty", "and"] * n
        start = time.perf_counter()
        parsing.rule_parser(words)
        return time.perf_counter() - start

    took(500)
    assert min(took(4000) for _ in range(3)) < 4 * min(took(2000) for _ in range(3))


def test_triplets_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*GOLD, None, "", " \n ", "Ann met Bob.\nBob left Ann? “Yes.” She saw Rome", "x " * 3000])], "doc_id long, text string")
    sentences = parsing.parsed(docs.unionByName(extra)).cache()
    want, texts = [], {r.doc_id: r.text for r in docs.unionByName(extra).collect()}
    for r in sentences.collect():
        assert texts[r.doc_id][r.start_char : r.start_char + len(r.sentence)] == r.sentence
        words = [t.word for t in r.tokens]
        assert [texts[r.doc_id][t.start_char : t.start_char + len(t.word)] for t in r.tokens] == words and words == [m[0] for m in parsing._WORD.finditer(r.sentence)]
        tree = parsing.rule_parser(words)
        assert [(t.pos, t.head, t.dep) for t in r.tokens] == tree
        want += [(r.doc_id, r.sent, *p) for p in pairs_by_loops(words, tree) if p[3] >= 0.6]
    told = lambda df: sorted((r.doc_id, r.sent, r.subject.text, r.action.text, r.object.text, round(r.confidence, 9)) for r in df.collect())
    assert told(parsing.triplets_in(sentences)) == sorted(want) == told(parsing.triplets(parsing.token_table(sentences))) and len(want) > 20
    kept = parsing.relations(sentences).collect()
    assert {r.relation for r in kept} <= set(extraction.RELATIONS) and parsing.relations(sentences, ()).count() == parsing.token_table(sentences).where("pos <> 'PUNCT'").count()


@pytest.mark.parametrize("read", [parsing.token_table, parsing.relations, parsing.triplets_in])
def test_sentences_are_parsed_once(spark, read):
    docs = spark.createDataFrame([(1, "Ann met Bob.")], "doc_id long, text string")
    plan = read(parsing.parsed(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [_by_rules") == 1


def test_a_failing_parser_costs_its_sentence_only(spark):
    def picky(words):
        if "bad" in words:
            raise ValueError
        return parsing.rule_parser(words)

    docs = spark.createDataFrame([(1, "Ann met Bob. bad one. Bob met Ann.")], "doc_id long, text string")
    rows = {r.sent: len(r.tokens) for r in parsing.parsed(docs, parser=picky).collect()}
    assert rows == {0: 4, 1: 0, 2: 4}


@pytest.mark.parametrize("operator", [extraction.mentions, extraction.token_rows, lambda d: extraction.chunk_rows(d, size=256, overlap=32)])
def test_text_operators_are_linear(spark, operator):
    def took(n):
        docs = spark.createDataFrame([(1, " ".join(f"Word{i % 7} Bank x{i}" for i in range(n // 3)))], "doc_id long, text string").coalesce(1).cache()
        docs.count()
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            operator(docs).agg(F.count("*")).collect()
            best = min(best, time.perf_counter() - start)
        return best

    took(4000)
    assert took(64_000) < 2.2 * took(32_000) + 0.3
