"""Token counts of whole texts, huge ones in overlapping chunks that are spliced where they provably agree.

A text of up to ``chunk`` characters is encoded in one piece. A longer one is cut into chunks that overlap; each chunk is
encoded on its own, wherever Spark places it, with the offsets of its tokens. Two neighbours are spliced at the first
position in their overlap where both begin a pre-token. This is safe because the tokenizer's pre-tokens are found by a scan
from left to right that looks only ahead:

- the first chunk begins where the text does, so its pre-tokens are those of the text up to ``margin`` characters before its
  end (the scan looks ahead by a contraction at most, and a special string may begin within that margin);
- a chunk that begins a pre-token at a position where the text has one goes on as the text does, so from the splice on the
  same holds for the next chunk, and for all after it.

Tokens never cross pre-tokens, so the counts up to the splice of one chunk and from the splice on of the next one add up to
the whole text's. Where an overlap has no common beginning (one word or run of white space fills it), the texts concerned
are encoded again with overlaps four times as wide, at last as one chunk.

Inside a piece the same proof cuts at single spaces between visible characters, where a pre-token always begins; what stands
between two such cuts is encoded once for each different string and remembered, within a bound.

This is proven for byte-level BPE files with the usual pattern and no normaliser. For other ``.json`` files and for
sentencepiece models texts are encoded whole. Special strings inside a text become special tokens as the library's default has
it; none are added.

Null counts as empty: 0 bytes, 0 tokens. Repeated rows get equal counts; huge copies are encoded once. Null ids are rows as
others. An empty table gives no rows. Other columns pass through under any names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import cut, fresh, partitions, table

CHUNK, OVERLAP = 32_768, 1_024
TOKENIZER, LIMIT = "byte_bpe_50k.json", 512
#: Longest contraction with the characters its alternatives look at.
LOOKAHEAD = 3
#: A space between two visible characters (U+180E was white space in old tables).
CUT = re.compile(r"(?<=[^\s\u180e]) (?=[^\s\u180e])")
ODD = re.compile(r"^ | $| [\s\u180e]|[\s\u180e] ")
#: Bounds of what a worker remembers and of the characters it encodes at a time.
MEMORY, LONG_UNIT, BATCH_CHARS = 300_000, 64, 1 << 21


def scans_ahead(spec: dict) -> bool:
    """Are this ``.json`` file's pre-tokens found by a scan that looks only ahead?"""
    pre, model, post = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("post_processor")
    return (
        pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec.get("normalizer") is None
        and model.get("type") == "BPE" and not model.get("dropout") and model.get("unk_token") is None and (post is None or post["type"] == "ByteLevel")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in spec.get("added_tokens", []))
    )


class Tokens:
    """A tokenizer on an executor. ``margin``: how far before its end a chunk's pre-tokens are proven, None if they never are."""

    def __init__(self, name: str, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.margin, self.known = None, {}
        if name.endswith(".model"):
            import sentencepiece

            own = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.sizes = lambda texts: [len(ids) for ids in own.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        spec = json.loads(content)
        if scans_ahead(spec):
            spec["post_processor"] = None  # it would only trim offsets
            self.margin = LOOKAHEAD + max([0, *(len(t["content"]) for t in spec.get("added_tokens", []))])
        self.own = Tokenizer.from_str(json.dumps(spec))
        self.own.no_truncation()
        self.own.no_padding()
        self.sizes = lambda texts: [len(e) for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        if self.margin is None:
            return self.sizes(texts)
        units = [CUT.split(t) if ODD.search(t) else t.split(" ") for t in texts]
        firsts = self.sizes([u[0] for u in units])
        new = list(set().union(*(u[1:] for u in units)) - self.known.keys())
        self.known.update(zip(new, self.sizes([f" {u}" for u in new]), strict=True))
        size = self.known.__getitem__
        found = [first + sum(map(size, u[1:])) for first, u in zip(firsts, units, strict=True)]
        for u in new:
            if len(u) > LONG_UNIT:
                del self.known[u]
        if len(self.known) > MEMORY:
            self.known.clear()
        return found

    def beginnings(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Where pre-tokens begin after the first, the tokens before each, and all tokens."""
        found = self.own.encode(text, add_special_tokens=False)
        word = np.array(found.word_ids, dtype=np.int64)
        at = np.flatnonzero(word[1:] != word[:-1]) + 1
        return np.array([start for start, _ in found.offsets], dtype=np.int64)[at], at, len(word)


_loaded: dict[str, Tokens] = {}


def _tokens(shared) -> Tokens:
    name, content = shared.value
    if name not in _loaded:
        _loaded[name] = Tokens(name, content)
    return _loaded[name]


def _chunks(chunk: int, overlap: int):
    """Rows (key, text) to rows (key, k, last, start, body). Chunk k begins at k * step; all but the last reach ``overlap`` into the next."""

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = chunk - overlap
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                n = max(1, -(-(len(text) - overlap) // step))
                for at in range(0, n, 64):
                    ks = range(at, min(n, at + 64))
                    yield pd.DataFrame({"key": key, "k": list(ks), "last": [k == n - 1 for k in ks], "start": [k * step for k in ks], "body": [text[k * step : k * step + chunk] for k in ks]})

    return cut_up


def _sides(shared, overlap: int):
    """For each joint of two chunks, what either knows of it: the beginnings in the overlap and the tokens before them.

    Joint k lies between the chunks k - 1 and k; at joint 0 the last chunk tells its total, as a side with one beginning.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _tokens(shared)
        for batch in batches:
            rows = []
            for key, k, last, start, body in zip(batch["key"], batch["k"], batch["last"], batch["start"], batch["body"], strict=True):
                at, before, total = own.beginnings(body)
                if k:
                    left = at < overlap
                    rows.append((key, k, True, at[left] + start, before[left]))
                if last:
                    rows += [(key, 0, True, [0], [0]), (key, 0, False, [0], [total])]
                else:
                    right = (at >= len(body) - overlap) & (at <= len(body) - own.margin)
                    rows.append((key, k + 1, False, at[right] + start, before[right]))
            yield pd.DataFrame(rows, columns=["key", "joint", "later", "at", "before"])

    return encode


def _spliced(huge: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of the distinct texts (key, text), n_tokens null where a joint has no common beginning."""
    spark = huge.sparkSession
    pieces = huge.mapInPandas(_chunks(chunk, overlap), "key string, k long, last boolean, start long, body string")
    pieces = pieces.repartition(partitions(spark), "key", "k").dropDuplicates(["key", "k"])
    sides = pieces.mapInPandas(_sides(shared, overlap), "key string, joint long, later boolean, at array<long>, before array<long>")
    side = lambda later: F.max(F.when(F.col("later") == later, F.struct("at", "before")))  # noqa: E731 - copies are equal
    joints = sides.groupBy("key", "joint").agg(side(False).alias("a"), side(True).alias("b"))
    joints = joints.withColumn("splice", F.get(F.array_intersect("a.at", "b.at"), F.lit(0)))
    before = lambda s: F.get(F.col(f"{s}.before"), (F.array_position(f"{s}.at", F.col("splice")) - 1).cast("int"))
    share = F.when(F.col("splice").isNotNull(), before("a") - before("b"))
    return joints.groupBy("key").agg(F.sum(share).alias("sum"), F.bool_and(share.isNotNull()).alias("whole")).select("key", F.when(F.col("whole"), F.col("sum")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out: str = "tokens", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with the struct ``out``: n_bytes, n_tokens by the tokenizer file at ``path`` (of the driver; its content is broadcast)."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(path, "rb") as file:
        content = file.read()
    shared = spark.sparkContext.broadcast((os.path.basename(path), content))
    proven = not path.endswith(".model") and scans_ahead(json.loads(content))
    chunk, overlap = max(chunk, 4 * overlap), overlap

    @F.pandas_udf("long")
    def whole(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _tokens(shared)
        for texts in series:
            ends = np.cumsum(texts.str.len().to_numpy()) // BATCH_CHARS
            yield pd.concat([pd.Series(own.counts(part.tolist()), dtype="int64") for _, part in texts.groupby(ends, sort=False)] or [pd.Series(dtype="int64")])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    figures = lambda tokens: F.struct(F.octet_length(text).cast("long").alias("n_bytes"), tokens.alias("n_tokens"))
    short = docs.where(F.char_length(text) <= chunk) if proven else docs
    short = short.withColumn(out, figures(whole(text)))
    if not proven:
        return short
    long = docs.where(F.char_length(text) > chunk)
    named, left, found = long.select(F.sha2(text, 256).alias("key"), text.alias("text")), None, None
    while left is None or not left.isEmpty():
        part = named if left is None else named.join(left, "key", "left_semi")
        done = cut(_spliced(part, shared, chunk, overlap))
        told = done.where("n_tokens IS NOT NULL")
        found, left = told if found is None else found.unionByName(told), done.where("n_tokens IS NULL").select("key")
        overlap, chunk = 4 * overlap, max(chunk, 16 * overlap)
    key, n = fresh("key", docs.columns), fresh("n_tokens", docs.columns)
    counted = long.withColumn(key, F.sha2(text, 256)).join(found.select(F.col("key").alias(key), F.col("n_tokens").alias(n)), key, "left")
    return short.unionByName(counted.select(*docs.columns, figures(F.col(n)).alias(out)))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = count_tokens(docs, public_tokenizers.path(TOKENIZER)).select("doc_id", "tokens.*")
    return told.withColumn("over_limit", F.col("n_tokens") > LIMIT)
