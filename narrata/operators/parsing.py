"""Sentences, dependency tokens, relations and triplets.

A text becomes a row per sentence (one Arrow UDF) and a sentence its tokens with part of speech, relation and head (another);
no shuffle is needed, however long the text is. The default parser is an arc-eager transition system whose next step follows
from the parts of speech at the top of its stack and the front of its buffer, so it takes at most two steps a token. It stands in for
a neural parser, which can be given as ``parser``, and claims no model quality.

Null and blank texts have no sentences. A sentence whose parser fails has no tokens, as the rest of its document is worth more.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions.arrays import Structs
from narrata.functions.shipping import ship_package
from narrata.operators.extraction import OBJECTS, RELATIONS, SUBJECTS

log = logging.getLogger("narrata")

#: From words to (part of speech, head, relation) of each; a root is its own head.
Parser = Callable[[list[str]], list[tuple[str, int, str]]]

SENTENCE = Structs((("sent", "int"), ("start_char", "int"), ("sentence", "string")))
TOKEN = Structs((("i", "int"), ("word", "string"), ("start_char", "int"), ("pos", "string"), ("dep", "string"), ("head", "int")))
_END = re.compile(r"(?<=[.!?])[\"')\]]*\s+|\n+")
_WORD = re.compile(r"\d+(?:[.,]\d+)*|\w+(?:[-'’]\w+)*|[^\w\s]")

#: Closed classes and common forms that no ending tells.
LEXICON = {
    word: pos
    for pos, words in {
        "DET": "the a an this that these those every each some any no all both his her its their our my your",
        "ADP": "of in on at by for with from to into over under after before during against between through about as near across since until",
        "PRON": "he she it they we i you him them us me who which what",
        "AUX": "is are was were be been being am has have had do does did will would can could may might shall should must",
        "CCONJ": "and or but nor",
        "SCONJ": "because although while if when where whether",
        "ADV": "not never also again now then very soon here there still only just already",
        "VERB": "met meets meet said says say made makes make took takes take gave gives give won wins win held holds hold led leads lead left leaves leave told tells tell sent sends send bought buys buy "
        "sold sells sell built builds build signs sign announces announce plans visits visit calls called wants want began begins begin became becomes become went goes go came comes come saw sees see found finds find paid pays pay",
        "ADJ": "new old big small good bad high low long short first last next own other many few former public great",
    }.items()
    for word in words.split()
}
BE = frozenset("is are was were be been being am".split())
NEGATIONS, SKIPPED = ("not", "never"), ("ADV", "PART")
NOMINAL, NAMING, LEFT_OF_NOUN = ("NOUN", "PROPN", "PRON"), ("NOUN", "PROPN"), {"DET": "det", "ADJ": "amod", "NUM": "nummod"}


def tagged(words: list[str]) -> list[str]:
    """A part of speech for each word: closed classes, then case, digits and endings."""
    tags = []
    for i, word in enumerate(words):
        low = word.lower()
        before = tags[-1] if tags else ""
        if not word[0].isalnum():
            tag = "PUNCT"
        elif word[0].isdigit():
            tag = "NUM"
        elif low in LEXICON and not (word[0].isupper() and i and LEXICON[low] in ("VERB", "ADJ")):
            tag = LEXICON[low]
        elif word[0].isupper() and (i or (len(words) > 1 and words[1][0].isupper()) or not low.endswith(("ed", "ing", "ly"))):
            tag = "PROPN"
        elif low.endswith("ly"):
            tag = "ADV"
        elif low.endswith(("ed", "ing", "ise", "ize", "ify")):
            tag = "ADJ" if before in LEFT_OF_NOUN else "NOUN" if before == "ADP" and low.endswith("ing") else "VERB"
        elif low.endswith(("ous", "ful", "ive", "able", "ible", "ical", "less", "ish")):
            tag = "ADJ"
        else:
            tag = "NOUN"
        tags.append(tag)
    for i in range(1, len(tags)):  # what follows decides: an adjective before no noun is one itself
        if tags[i] == "ADJ" and tags[i - 1] in LEFT_OF_NOUN and (i + 1 == len(tags) or tags[i + 1] not in (*NAMING, "ADJ", "NUM")):
            tags[i] = "NOUN"
    if len(tags) > 1 and tags[0] == "NUM" == tags[1]:
        tags[1] = "NOUN"
    return tags


def _move(t: str, negation: bool, be: bool, p: str, named_after: bool, joined: bool, ing: bool, verb_follows: bool, of: bool, by: bool, open_after: bool, free: bool, adjacent: bool, passive_s: bool, passive_b: bool) -> tuple[str, str]:
    """The next step, from the top of the stack (``t`` its part of speech) and the front of the buffer (``p``)."""
    named_next = p in NAMING and named_after
    if p in ("PUNCT", "CCONJ"):
        return "point", "punct" if p == "PUNCT" else "cc"
    if free and p in NAMING and t in LEFT_OF_NOUN:
        return "left", LEFT_OF_NOUN[t]
    if free and p in NAMING and t in NAMING and adjacent:
        return "left", "compound"
    if free and t == "ADV" and p in ("VERB", "ADJ"):
        return "left", "neg" if negation else "advmod"
    if p == "VERB" and free and t == "AUX":
        return "left", "auxpass" if be and not ing else "aux"
    if (p == "VERB" or (p == "AUX" and not verb_follows)) and free and t in NOMINAL:
        return "left", "nsubjpass" if passive_b else "nsubj"
    if p == "VERB" and free and t == "SCONJ":
        return "left", "mark"
    if p in NOMINAL and joined and t in NOMINAL and not named_next:
        return "right", "conj"
    if p in NOMINAL and t in ("VERB", "AUX", "ADP"):
        return ("shift", "") if named_next else ("right", {"VERB": "dobj", "AUX": "attr", "ADP": "pobj"}[t])
    if p == "ADP" and (t in ("VERB", "AUX") or (t in NOMINAL and (free or of))):
        return "right", "agent" if passive_s and by else "prep"
    if p == "VERB" and t == "VERB":
        return "right", "conj" if joined else "xcomp"
    if p == "ADV" and t == "VERB" and not verb_follows:
        return "right", "advmod"
    if p == "ADJ" and t == "AUX" and open_after:
        return "right", "acomp"
    return ("shift", "") if free or p in LEFT_OF_NOUN or named_next and t in ("VERB", "AUX", "ADP") else ("reduce", "")


def rule_parser(words: list[str]) -> list[tuple[str, int, str]]:
    """Arc-eager parsing by fixed rules. Left arcs attach the top of the stack to the front of the buffer, right arcs the reverse."""
    tags, n = tagged(words), len(words)
    head, dep, stack, passive, b = [-1] * n, [""] * n, [], set(), 0

    def step(s: int, b: int) -> tuple[str, str]:
        top, front = words[s].lower(), words[b].lower()
        after = tags[b + 1] if b + 1 < n else ""
        j = b + 1
        while j < n and tags[j] in SKIPPED:
            j += 1
        return _move(
            tags[s], top in NEGATIONS, top in BE, tags[b], after in NAMING, b > 0 and tags[b - 1] == "CCONJ", front.endswith("ing"), j < n and tags[j] == "VERB",
            front == "of", front == "by", after not in (*NAMING, "ADJ"), head[s] < 0, s == b - 1, s in passive, b in passive,
        )

    while b < n:
        move, label = step(stack[-1], b) if stack else ("shift", "")
        if move == "left":
            s = stack.pop()
            head[s], dep[s] = b, label
            if label == "auxpass":
                passive.add(b)
            continue
        if move == "reduce":
            stack.pop()
            continue
        if move in ("right", "point"):
            head[b], dep[b] = stack[-1], label
        if move != "point":
            stack.append(b)
        b += 1
    free = [i for i in range(n) if head[i] < 0]
    root = next((i for kind in ("VERB", "AUX") for i in free if tags[i] == kind), free[0] if free else 0)
    for i in free:
        head[i], dep[i] = root, "dep"
    if n:
        dep[root] = "ROOT"
    return list(zip(tags, head, dep, strict=True))


#: What a word is on its own: parts of speech, then the endings whose part of speech follows from the word before.
_TAGS = ("PUNCT", "NUM", "PROPN", "ADV", "ADJ", "NOUN", "VERB", "DET", "ADP", "PRON", "AUX", "CCONJ", "SCONJ", "ED", "ING")
_TAG = {tag: i for i, tag in enumerate(_TAGS)}
_DEPS = ("", "dep", "ROOT", "punct", "cc", *LEFT_OF_NOUN.values(), "compound", "neg", "advmod", "auxpass", "aux", "nsubjpass", "nsubj", "mark", "conj", "dobj", "attr", "pobj", "agent", "prep", "xcomp", "acomp")
_DEP = {dep: i for i, dep in enumerate(_DEPS)}
_MOVES = ("shift", "reduce", "left", "right", "point")
_SHIFT, _REDUCE, _LEFT, _RIGHT, _POINT = range(5)
_SPLIT = re.compile(f"({_WORD.pattern})")
#: With fewer sentences left they go on one by one. Words whose forms are remembered.
FEW_LEFT, FORMS = 48, 200_000


def _of(tags: tuple[str, ...] | dict[str, str]) -> np.ndarray:
    return np.array([tag in tags for tag in _TAGS])


class _Forms(dict):
    """From a word to a number that tells its parts of speech (first, first before a capital, later) and what the steps ask of it."""

    def __missing__(self, word: str) -> int:
        low, upper = word.lower(), word[0].isupper()
        own = "ADV" if low.endswith("ly") else "ING" if low.endswith("ing") else "ED" if low.endswith(("ed", "ise", "ize", "ify")) else "ADJ" if low.endswith(("ous", "ful", "ive", "able", "ible", "ical", "less", "ish")) else "NOUN"
        name = "PROPN" if upper else own
        if not word[0].isalnum():
            tags = ("PUNCT",) * 3
        elif word[0].isdigit():
            tags = ("NUM",) * 3
        elif low in LEXICON:
            tags = (LEXICON[low], LEXICON[low], name if upper and LEXICON[low] in ("VERB", "ADJ") else LEXICON[low])
        else:
            tags = (own if low.endswith(("ed", "ing", "ly")) else name, name, name)
        number = 0
        for tag in tags:
            number = number * 16 + _TAG[tag]
        for mark in (upper, low in NEGATIONS, low in BE, low.endswith("ing"), low == "of", low == "by"):
            number = number * 2 + mark
        self[word] = number
        return number


_forms, _table = _Forms(), np.full(1 << 21, -1, dtype=np.int16)


def _looked_up(keys: np.ndarray) -> np.ndarray:
    """Moves and relations, 5 * relation + move; what was not met yet is asked of ``_move`` once."""
    told = _table[keys]
    if (told < 0).any():
        for key in np.unique(keys[told < 0]).tolist():
            bit = lambda i: bool(key >> i & 1)  # noqa: E731, B023
            move, dep = _move(_TAGS[key >> 17], bit(15), bit(16), _TAGS[key >> 11 & 15], bit(10), bit(9), bit(8), bit(7), bit(6), bit(5), bit(4), bit(3), bit(2), bit(1), bit(0))
            _table[key] = 5 * _DEP[dep] + _MOVES.index(move)
        told = _table[keys]
    return told


def _tagged(forms: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """What ``tagged`` tells, for the words of many sentences; first, last: whether a word is at an end of its sentence."""
    upper = forms >> 5 & 1
    before_upper = np.append(upper[1:], 0).astype(bool) & ~last
    tags = np.where(first, np.where(before_upper, forms >> 10 & 15, forms >> 14 & 15), forms >> 6 & 15)
    open_, ing = tags >= _TAG["ED"], tags == _TAG["ING"]
    at = np.flatnonzero(open_)
    if at.size:  # the first of a run follows from what stands before; after an adjective all are, else the rest are verbs
        leads = first[at] | ~open_[at - 1]
        lead = at[np.maximum.accumulate(np.where(leads, np.arange(at.size), 0))]
        before = np.where(first[lead], -1, tags[lead - 1])
        left = _of(LEFT_OF_NOUN)[before] & (before >= 0)
        noun = leads & ing[at] & (before == _TAG["ADP"])
        tags[at] = np.where(left, _TAG["ADJ"], np.where(noun, _TAG["NOUN"], _TAG["VERB"]))
    after, before = np.append(tags[1:], 0), np.concatenate([tags[:1], tags[:-1]])
    lone = (tags == _TAG["ADJ"]) & ~first & _of(LEFT_OF_NOUN)[before] & (last | ~_of((*NAMING, "ADJ", "NUM"))[after])
    second = np.concatenate([[False], first[:-1]]) & ~first
    counted = second & (tags == _TAG["NUM"]) & (before == _TAG["NUM"])
    return np.where(lone | counted, _TAG["NOUN"], tags)


def rule_parsed(forms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of parts of speech and relations, and heads, as ``rule_parser`` tells them, of sentences of ``counts`` words in a row.

    All sentences take their steps together; a step is looked up by what it depends on.
    """
    total, counts = len(forms), counts[counts > 0]
    ends = np.cumsum(counts)
    starts = ends - counts
    first, last = np.zeros(total, dtype=bool), np.zeros(total, dtype=bool)
    first[starts], last[ends - 1] = True, True
    tags = _tagged(forms, first, last)
    after, naming = np.append(tags[1:], 0), _of(NAMING)
    whole = np.append(np.where(_of(SKIPPED)[tags], total, np.arange(total)), total)
    following = np.minimum.accumulate(whole[::-1])[::-1][1:]  # the next word that is not skipped
    own_end = np.repeat(ends, counts)
    verb = (following < own_end) & (np.append(tags, 0)[following] == _TAG["VERB"])
    joined = ~first & (np.concatenate([[0], tags[:-1]]) == _TAG["CCONJ"])
    bits = (~last & naming[after], joined, forms >> 2 & 1, verb, forms >> 1 & 1, forms & 1, last | ~_of((*NAMING, "ADJ"))[after])
    front = tags.astype(np.int64) << 11
    for k, bit in enumerate(bits):
        front |= bit.astype(np.int64) << (10 - k)
    top = tags.astype(np.int64) << 17 | (forms >> 3 & 1) << 16 | (forms >> 4 & 1) << 15
    head, dep, below, passive = np.full(total, -1), np.zeros(total, dtype=np.int16), np.full(total, -1), np.zeros(total, dtype=np.int64)
    s, b, own = np.full(len(starts), -1), starts.copy(), np.arange(len(starts))
    while len(b) >= FEW_LEFT:
        told = _looked_up(top[s] | front[b] | (head[s] < 0) << 3 | (s == b - 1) << 2 | passive[s] << 1 | passive[b])
        told = np.where(s < 0, _SHIFT, told)
        move, label = told % 5, told // 5
        left, right, shift, point = move == _LEFT, move == _RIGHT, move == _SHIFT, move == _POINT
        head[s[left]], dep[s[left]] = b[left], label[left]
        passive[b[left & (label == _DEP["auxpass"])]] = 1
        tied = right | point
        head[b[tied]], dep[b[tied]] = s[tied], label[tied]
        pushed = right | shift
        below[b[pushed]] = s[pushed]
        s = np.where(pushed, b, np.where(left | (move == _REDUCE), below[s], s))
        b = b + (pushed | point)
        if (over := b >= ends[own]).any():
            s, b, own = s[~over], b[~over], own[~over]
    for top_of, at, k in zip(s.tolist(), b.tolist(), own.tolist(), strict=True):
        _go_on(top_of, at, int(starts[k]), int(ends[k]), top, front, head, dep, below, passive)
    free = np.flatnonzero(head < 0)
    rank = np.where(tags[free] == _TAG["VERB"], 0, np.where(tags[free] == _TAG["AUX"], 1, 2))
    sentence = np.searchsorted(ends, free, side="right")
    order = np.lexsort((free, rank, sentence))
    root = free[order[np.unique(sentence[order], return_index=True)[1]]] if total else free
    head[free], dep[free] = root[sentence], _DEP["dep"]
    dep[root] = _DEP["ROOT"]
    return tags, dep, head - np.repeat(starts, counts)


class _Steps(dict):
    def __missing__(self, key: int) -> tuple[int, int]:
        label, move = divmod(int(_looked_up(np.array([key]))[0]), 5)
        self[key] = move, label
        return move, label


_steps = _Steps()


def _go_on(s: int, b: int, start: int, stop: int, *arrays: np.ndarray) -> None:
    """The steps of one sentence from a state on: ``s`` the top of its stack, ``b`` the front of its buffer."""
    top, front, head, dep, below, passive = (a[start:stop].tolist() for a in arrays)
    s, b, n = s - start if s >= 0 else -1, b - start, stop - start
    head = [h - start if h >= 0 else -1 for h in head]
    below = [x - start if x >= 0 else -1 for x in below]
    while b < n:
        move, label = _SHIFT, 0
        if s >= 0:
            move, label = _steps[top[s] | front[b] | (head[s] < 0) << 3 | (s == b - 1) << 2 | passive[s] << 1 | passive[b]]
        if move == _LEFT:
            head[s], dep[s] = b, label
            if label == _DEP["auxpass"]:
                passive[b] = 1
        if move in (_LEFT, _REDUCE):
            s = below[s]
            continue
        if move in (_RIGHT, _POINT):
            head[b], dep[b] = s, label
        if move != _POINT:
            below[b], s = s, b
        b += 1
    arrays[2][start:stop] = [h + start if h >= 0 else -1 for h in head]
    arrays[3][start:stop] = dep


def _sentences(texts: pa.Array) -> pa.Array:
    rows = []
    for text in texts.to_pylist():
        own, at = [], 0
        for stop, after in [*((m.start(), m.end()) for m in _END.finditer(text or "")), (len(text or ""), None)]:
            if text and text[at:stop].strip():
                own.append((len(own), at, text[at:stop]))
            at = after
        rows.append(own)
    return SENTENCE.array(rows)


def _by_rules(sentences: pa.Array, starts: pa.Array) -> pa.Array:
    """What ``rule_parser`` tells, for all sentences of a batch together."""
    parts, words, pieces = [], [], []
    for text in sentences.to_pylist():
        found = _SPLIT.split(text)  # gap, word, gap, ..., gap
        parts += found
        words += found[1::2]
        pieces.append(len(found))
    pieces = np.array(pieces, dtype=np.int64)
    counts = pieces // 2
    ends = np.cumsum(pieces)
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
    inner = np.arange(len(parts)) - np.repeat(ends - pieces, pieces)
    begins = (offsets[:-1] - np.repeat(offsets[ends - pieces], pieces))[inner % 2 == 1] + np.repeat(np.asarray(starts, dtype=np.int64), counts)
    if len(_forms) > FORMS:
        _forms.clear()
    tags, dep, head = rule_parsed(np.fromiter(map(_forms.__getitem__, words), np.int64, len(words)), counts)
    column = lambda x: pa.array(x.astype(np.int32))
    columns = [column(inner[inner % 2 == 1] // 2), pa.array(words, pa.string()), column(begins), pa.array(_TAGS).take(column(tags)), pa.array(_DEPS).take(column(dep)), column(head)]
    tokens = pa.StructArray.from_arrays(columns, names=[name for name, _ in TOKEN.fields])
    return pa.ListArray.from_arrays(column(np.concatenate([[0], np.cumsum(counts)])), tokens)


def _parse(parser: Parser):
    """Declared nondeterministic, so that filters which Spark infers from what reads the tokens don't parse a second time."""
    if parser is rule_parser:
        return F.arrow_udf(_by_rules, TOKEN.sql).asNondeterministic()

    def parse(sentences: pa.Array, starts: pa.Array) -> pa.Array:
        rows = []
        for text, start in zip(sentences.to_pylist(), starts.to_pylist(), strict=True):
            found = list(_WORD.finditer(text))
            try:
                told = parser([m[0] for m in found])
                rows.append([(i, m[0], start + m.start(), pos, dep, head) for i, (m, (pos, head, dep)) in enumerate(zip(found, told, strict=True))])
            except Exception:  # noqa: BLE001 - the document's other sentences stay
                log.exception("a sentence could not be parsed")
                rows.append([])
        return TOKEN.array(rows)

    return F.arrow_udf(parse, TOKEN.sql).asNondeterministic()


def parsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parser: Parser = rule_parser) -> DataFrame:
    """A row per sentence: doc_id, sent, start_char, sentence, tokens (array of i, word, start_char, pos, dep, head)."""
    ship_package(docs.sparkSession)
    split = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.arrow_udf(_sentences, SENTENCE.sql)(F.col(text_col).cast("string"))).alias("s")).select("doc_id", "s.*")
    return split.withColumn("tokens", _parse(parser)(F.col("sentence"), F.col("start_char")))


def token_table(sentences: DataFrame) -> DataFrame:
    """A row per token: doc_id, sent, i, word, start_char, pos, dep, head."""
    return sentences.select("doc_id", "sent", F.explode("tokens").alias("t")).select("doc_id", "sent", "t.*")


def is_kept(relation: Column, pos: Column, kept: tuple[str, ...] = RELATIONS) -> Column:
    """Relations that are told: those of ``kept`` (all, if none are named) but of marks and spaces."""
    return ~pos.isin("PUNCT", "SPACE") & (relation.isin(*kept) if kept else F.lit(True))


def relations(sentences: DataFrame, kept: tuple[str, ...] = RELATIONS) -> DataFrame:
    """doc_id, sent, i, head, head_pos, dependent, dependent_pos, relation, confidence of the tokens that ``kept`` names."""
    rows = sentences.select("doc_id", "sent", "tokens", F.explode(F.filter("tokens", lambda t: is_kept(t["dep"], t["pos"], kept))).alias("t"))
    head = F.get("tokens", F.col("t.head"))
    return rows.select(
        "doc_id", "sent", F.col("t.i").alias("i"), head["word"].alias("head"), head["pos"].alias("head_pos"), F.col("t.word").alias("dependent"), F.col("t.pos").alias("dependent_pos"),
        F.col("t.dep").alias("relation"), F.lit(1.0).alias("confidence"),
    )


def _paired(rows: DataFrame, least: float) -> DataFrame:
    """From actions, subjects, objects and preps (arrays of tokens) of each sentence, all subjects with all objects of an action."""
    keep = [c for c in rows.columns if c not in ("actions", "subjects", "objects", "preps")]
    acts = rows.where((F.size("subjects") > 0) & (F.size("objects") > 0)).select("*", F.explode("actions").alias("a"))
    behind = F.transform(F.filter("preps", lambda p: p["head"] == F.col("a.i")), lambda p: p["i"])
    acts = acts.withColumn("behind", behind).withColumn("subjects", F.filter("subjects", lambda s: s["head"] == F.col("a.i")))
    meant = lambda o: (o["head"] == F.col("a.i")) | ((o["dep"] == "pobj") & F.array_contains("behind", o["head"]))
    both = acts.select(*keep, "a", F.explode("subjects").alias("s"), F.filter("objects", meant).alias("objects")).select(*keep, "a", "s", F.explode("objects").alias("o"))
    distance = F.abs(F.col("s.i") - F.col("a.i")) + F.abs(F.col("o.i") - F.col("a.i"))
    direct = F.when(F.col("o.head") == F.col("a.i"), 0.1).otherwise(0.0)
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.8) - F.least(F.lit(0.2), distance * 0.2 / 20) + 0.1 + direct))
    span = lambda c: F.struct(F.col(f"{c}.word").alias("text"), F.col(f"{c}.start_char").alias("start_char"), (F.col(f"{c}.start_char") + F.length(f"{c}.word")).alias("end_char"))
    out = both.select(*keep, span("s").alias("subject"), span("a").alias("action"), span("o").alias("object"), confidence.alias("confidence"))
    return out.where((F.col("confidence") >= least) & (F.length("subject.text") > 0) & (F.length("action.text") > 0) & (F.length("object.text") > 0))


def _roles(t) -> dict[str, Column]:
    """Which tokens can be action, subject, object and preposition."""
    return {"actions": (t["dep"] == "ROOT") & t["pos"].isin("VERB", "AUX"), "subjects": t["dep"].isin(*SUBJECTS), "objects": t["dep"].isin(*OBJECTS), "preps": t["dep"] == "prep"}


def triplets_in(sentences: DataFrame, least: float = 0.6) -> DataFrame:
    """doc_id, sent, sentence, subject, action, object, confidence of parsed sentences; all within the row."""
    of = lambda name: F.filter("tokens", lambda t: _roles(t)[name]).alias(name)
    return _paired(sentences.select("doc_id", "sent", "sentence", of("actions"), of("subjects"), of("objects"), of("preps")), least)


def triplets(tokens: DataFrame, least: float = 0.6) -> DataFrame:
    """The same from a row per token (doc_id, sent, i, word, start_char, pos, dep, head): one shuffle, which moves only tokens with a role."""
    fields = ("i", "word", "start_char", "pos", "dep", "head")
    roles = _roles({f: F.col(f) for f in fields})
    some = tokens.where(F.greatest(*[c.cast("int") for c in roles.values()]) > 0)
    return _paired(some.groupBy("doc_id", "sent").agg(*[F.collect_list(F.when(c, F.struct(*fields))).alias(n) for n, c in roles.items()]), least)
