"""Language identification by prediction by partial matching (PPM) over bytes.

Each language gets a variable-order byte context tree: counts of every byte after its 0 to 3 preceding bytes. A byte's exact
code length follows escape method C: in the longest context seen, a byte seen c times there costs log2((n + d) / c) bits and
an unseen one costs log2((n + d) / d) bits for the escape and then its price in the next shorter context (n: bytes counted in
the context, d: different ones; below the empty context all 256 bytes cost 8 bits; a context never seen costs nothing to
leave). The counts are frozen after training, so the price of a byte depends on four bytes alone and is computed once for
each different four in a batch. The language with the shortest code wins; the score is its posterior probability.

Training reads a bounded sample: of each language about ``sample_docs`` whole documents, those whose hashed id falls below
the language's rate. Statistics are counted on the executors; the driver receives one row per language and byte context.

With the language comes the rate, the bits its shortest code takes for each byte: raw bytes have 8, so a text at more is none of
the languages learned.

Null text or no letter (Unicode category L), the empty text among them: ``und``, score 0, no rate. No labelled row to learn from: all ``und``. A null id is
never learned from. Very long texts are priced in pieces and summed. Repeated rows get the same answer; of languages with equal
code lengths the first by code point wins. An empty table gives no rows. Other columns pass through under any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import held_out, may_learn, table

ORDER = 3
SAMPLE_DOCS = 1000
PIECE = 1 << 20
UNDETERMINED = "und"


def windows(data: bytes) -> np.ndarray:
    """Each byte with the three before it, as one integer; before the text stand line feeds."""
    b = np.frombuffer(b"\n" * ORDER + data, dtype=np.uint8).astype(np.uint32)
    n = len(b) - ORDER
    w = b[ORDER:].copy()
    for back in range(1, ORDER + 1):
        w |= b[ORDER - back : ORDER - back + n] << np.uint32(8 * back)
    return w


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            parts = held.setdefault(lang, [])
            parts.append(np.unique(windows(text.encode("utf-8", "replace")), return_counts=True))
            if len(parts) >= 64:
                held[lang] = [merged(parts)]
    for lang, parts in held.items():
        keys, counts = merged(parts)
        yield pd.DataFrame({"lang": lang, "w": keys.astype(np.int64), "c": counts})


class Model:
    """Frozen prices: per order the sorted byte strings seen, what each costs and what leaving each context costs."""

    def __init__(self, languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages, self.orders = languages, []
        for k in range(ORDER + 1):
            mask = np.uint32((1 << (8 * (k + 1))) - 1 if k < 3 else 0xFFFFFFFF)
            seen, left = {}, {}
            for lang in languages:
                w, c = counts[lang]
                keys, where = np.unique(w & mask, return_inverse=True)
                c = np.bincount(where, weights=c)
                contexts, inside = np.unique(keys >> np.uint32(8), return_inverse=True)
                n, d = np.bincount(inside, weights=c), np.bincount(inside).astype(float)
                seen[lang] = keys, np.log2((n + d)[inside] / c)
                left[lang] = contexts, np.log2((n + d) / d)
            self.orders.append((self._table(seen, np.nan), self._table(left, 0.0)))

    def _table(self, of: dict, fill: float) -> tuple[np.ndarray, np.ndarray]:
        keys = np.unique(np.concatenate([k for k, _ in of.values()]))
        cost = np.full((len(keys) + 1, len(self.languages)), fill)  # the last row: not seen in any language
        for i, lang in enumerate(self.languages):
            cost[np.searchsorted(keys, of[lang][0]), i] = of[lang][1]
        return keys, cost

    @staticmethod
    def _look(table: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
        keys, cost = table
        i = np.searchsorted(keys, at)
        i[i == len(keys)] = 0
        return cost[np.where(keys[i] == at, i, len(keys))]

    def prices(self, w: np.ndarray) -> np.ndarray:
        """Bits of each window's last byte in each language."""
        bits = np.full((len(w), len(self.languages)), 8.0)
        for k, (seen, left) in enumerate(self.orders):
            key = w & np.uint32((1 << (8 * (k + 1))) - 1) if k < 3 else w
            direct, escape = self._look(seen, key), self._look(left, key >> np.uint32(8))
            bits = np.where(np.isnan(direct), escape + bits, direct)
        return bits

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, in bits."""
        total = np.zeros((len(texts), len(self.languages)))
        group, size = [], 0

        def price():
            keys, where = np.unique(np.concatenate([w for _, w in group]), return_inverse=True)
            starts = np.cumsum([0] + [len(w) for _, w in group[:-1]])
            cost = self.prices(keys)
            for i in range(len(self.languages)):
                np.add.at(total[:, i], [row for row, _ in group], np.add.reduceat(cost[:, i][where], starts))

        for row, data in enumerate(texts):
            w = windows(data)
            for at in range(0, len(w), PIECE):
                group.append((row, w[at : at + PIECE]))
                size += len(group[-1][1])
                if size >= PIECE:
                    price()
                    group, size = [], 0
        if group:
            price()
        return total


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Learn from rows with a text and a language that may be learned from; None if there are none."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(may_learn(F.col("id")) & F.col("lang").isNotNull() & (F.col("text") != ""))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    rate = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_docs / n))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where((drawn < rate) | (rate >= 1.0)).select("lang", "text")
    counted = sample.mapInPandas(_count, "lang string, w long, c long").groupBy("lang", "w").agg(F.sum("c").alias("c")).toPandas()
    counts = {lang: (part["w"].to_numpy().astype(np.uint32), part["c"].to_numpy()) for lang, part in counted.groupby("lang")}
    return Model(sorted(counts), counts) if counts else None


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with the struct ``out``: lang_pred, score, rate (bits a byte)."""
    kind = "lang_pred string, score double, rate double"
    if model is None:
        return docs.withColumn(out, F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("rate")))
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(kind)
    def best(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        found = pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0, "rate": np.nan})
        rows = np.flatnonzero(texts.notna().to_numpy())
        if len(rows):
            data = [texts.iloc[i].encode("utf-8", "replace") for i in rows]
            bits = own.lengths(data)
            odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
            first = bits.argmin(axis=1)
            found.loc[rows, "lang_pred"] = np.array(own.languages, dtype=object)[first]
            found.loc[rows, "score"] = 1 / odds.sum(axis=1)
            found.loc[rows, "rate"] = bits.min(axis=1) / np.array([len(d) for d in data])
        return found

    text = F.col(text_col).cast("string")
    return docs.withColumn(out, best(F.when(text.rlike(r"\p{L}"), text)))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")
