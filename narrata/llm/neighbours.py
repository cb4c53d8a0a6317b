"""Near-duplicate embeddings by NN-descent.

Only vectors of equal labels are compared. First, vectors within half the threshold angle of a common pivot form a ball: by
the triangle inequality of angles all its members link with each other, so a dense group costs its size and not its square.
The pivots, single vectors among them, are the nodes of a neighbour graph over 256-bit sign sketches:

- start: the nodes sorted by several shuffles of their bits, each with its next entries;
- refine: neighbours of neighbours are new candidates, as long as one of the two links is new, and every node keeps its
  best; a list full of nodes near enough to link is saturated and grows; rounds end when the lists hardly change;
- edges whose balls can still hold a linked pair, by exact cosine, join balls to families; the vectors of a family are
  compared in matrix blocks of ``BLOCK`` in double precision, which yield each vector's number of links and a spanning forest,
  never a row for each link. So a saturated list loses nothing: its nodes are in one family, whatever the list holds;
- audit: for a bounded set of vectors, one of a ball, the links that leave the ball are counted against all vectors by brute
  force and the recall is averaged over the vectors that have such links; where links are too rare for a draw to hold some,
  vectors that other shuffles than the graph's show to be linked are asked, and only where those, which miss a single pair
  with a chance of ``MISS``, show none either is the recall 1 for want of any link that could be missed; below the wanted recall, further shuffles and rounds
  follow, and at last all pairs of pivots are compared in blocks.

Null, empty, zero or non-finite vectors and null labels link with nothing, nor do vectors of different lengths. A null id
is not compared. Repeated rows of an id with different vectors link as what they are; equal vectors are one ball. Ties: the
least id stands for a component. An empty table gives no rows; extra columns are ignored. The audit set's size, the sketch
width and the list length are parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import cut, table
from narrata.llm.minhash import contracted, forest
from narrata.operators.graph import components

COSINE = 0.98
WORDS = 4
SHUFFLES = 10
LIST = 6
ROUNDS = 4
AUDIT = 128
RECALL = 0.98
TRIES = 3
#: Sets of ``AUDIT`` vectors that are drawn at most until ``AUDIT`` with links are found; chance to miss an isolated pair at the start; pivots of a block.
DRAWS, MISS, BLOCK = 31, 0.005, 1024
SLACK, OTHER_SEED = 1e-6, 90_000


def _planes(size: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, count))


def _signed(words: int, seed: int):
    """Sign sketches as ``words`` integers."""

    def run(vectors: pd.Series) -> pd.Series:
        out = [None] * len(vectors)
        lengths = np.fromiter(map(len, vectors), dtype=np.int64, count=len(vectors))
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            bits = np.stack([vectors.iloc[i] for i in at]) @ _planes(int(size), 64 * words, seed) > 0
            packed = np.packbits(bits, axis=1).view(">u8").astype(np.uint64).view(np.int64)
            for i, row in zip(at, packed, strict=True):
                out[i] = row
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "array<long>")


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _cosine(x: str, y: str, nx: str, ny: str) -> Column:
    return _dot(x, y) / (F.col(nx) * F.col(ny))


def _angle(cosine: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def _shuffled(seed: int, words: int) -> list[Column]:
    """The bits of a sketch in another order: the words rotated and moved round, mixed by the seed."""
    rng = np.random.default_rng(seed)
    rotations, order = rng.integers(0, 64, words), rng.permutation(words)
    out = []
    for r, k in zip(rotations.tolist(), order.tolist(), strict=True):
        w = F.get("sketch", F.lit(int(k)))
        out.append(F.shiftleft(w, int(r)).bitwiseOR(F.shiftrightunsigned(w, 64 - int(r))) if r else w)
    return out


def _hamming(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, v: s + v)


def balls(vectors: DataFrame, cosine: float, words: int) -> DataFrame:
    """``vectors`` (id, label, v, norm, sketch) with pivot: the id of a vector at most half the threshold angle away."""
    half = F.lit(float(np.arccos(cosine)) / 2 - SLACK)
    keyed = vectors.select("id", "label", F.size("v").alias("dim"), F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.shiftrightunsigned(_shuffled(100 + t, words)[0], 44).alias("k")) for t in range(4)])).alias("b"))
    firsts = cut(keyed.groupBy("label", "dim", "b").agg(F.min("id").alias("pivot"), F.count("*").alias("c")).where("c > 1"))
    options = keyed.join(firsts, ["label", "dim", "b"]).where("pivot <> id").select("id", "pivot").distinct()
    sides = vectors.select(F.col("id").alias("pivot"), F.col("v").alias("pv"), F.col("norm").alias("pn"))

    def near(chosen: DataFrame) -> DataFrame:
        joined = chosen.join(vectors.select("id", "v", "norm"), "id").join(sides, "pivot")
        return joined.where(_angle(_cosine("v", "pv", "norm", "pn")) <= half).groupBy("id").agg(F.min("pivot").alias("pivot"))

    to = cut(near(options))
    for _ in range(2):  # a pivot that itself belongs to another ball hands over those that reach that one
        hand = to.select(F.col("id").alias("pivot"), F.col("pivot").alias("further"))
        longer = to.join(hand, "pivot").select("id", F.col("further").alias("pivot"))
        to = cut(to.unionByName(near(longer)).groupBy("id").agg(F.min("pivot").alias("pivot")))
    roots = to.select(F.col("id").alias("pivot")).distinct()
    settled = to.join(roots, "pivot", "left_anti").select(F.col("id").alias("m"), "pivot")
    return vectors.join(settled, F.col("id") == F.col("m"), "left").drop("m").withColumn("pivot", F.coalesce("pivot", "id"))


def _ranked(candidates: DataFrame, length: int, most: int, near: int) -> DataFrame:
    """The lists: each node's ``length`` best, up to ``most`` where those are near enough to link (a saturated list)."""
    by = Window.partitionBy("u").orderBy("d", "w", "fresh")
    single = candidates.withColumn("before", F.lag("w").over(by)).where("before IS NULL OR before <> w").drop("before")
    rank = single.withColumn("rank", F.row_number().over(by))
    return rank.where((F.col("rank") <= length) | ((F.col("d") <= near) & (F.col("rank") <= most)))


def met_when_sorted(nodes: DataFrame, words: int, shuffles: int, seed: int) -> DataFrame:
    """u, us, w, ws, d: each node with its next two in several sorted shuffles of the sketches' bits."""
    entries = []
    for t in range(shuffles):
        order = _shuffled(seed + t, words)
        entry = F.struct(F.lit(t).alias("t"), F.shiftrightunsigned(order[0], 56).alias("head"), *[x.alias(f"k{i}") for i, x in enumerate(order)])
        entries.append(entry)
    sorted_by = Window.partitionBy("label", "dim", "e.t", "e.head").orderBy(*[f"e.k{i}" for i in range(words)], "id")
    listed = nodes.withColumn("e", F.explode(F.array(*entries)))
    nexts = listed.select("id", "sketch", F.array(*[F.lead(F.struct("id", "sketch"), k).over(sorted_by) for k in (1, 2)]).alias("next"))
    start = nexts.select(F.col("id").alias("u"), F.col("sketch").alias("us"), F.explode("next").alias("n")).where("n IS NOT NULL")
    return start.select("u", "us", F.col("n.id").alias("w"), F.col("n.sketch").alias("ws"), _hamming("us", "n.sketch").alias("d"))


def neighbour_graph(nodes: DataFrame, words: int, shuffles: int, length: int, rounds: int, near: int, far: int, seed: int) -> DataFrame:
    """u, w: pairs of nodes whose sketches differ in at most ``far`` bits, met in sorted shuffles or by NN-descent.

    nodes: id, label, dim, sketch. The rows made in a round are bounded by the nodes and the square of the list length.
    """
    def both(pairs: DataFrame, fresh: bool) -> DataFrame:
        side = lambda u, w: F.struct(F.col(u).alias("u"), F.col(f"{u}s").alias("us"), F.col(w).alias("w"), F.col(f"{w}s").alias("ws"))
        return pairs.select("d", F.explode(F.array(side("u", "w"), side("w", "u"))).alias("x")).select("x.*", "d", F.lit(fresh).alias("fresh"))

    start = cut(met_when_sorted(nodes, words, shuffles, seed))
    lists = cut(_ranked(both(start, True), length, length, near))
    for turn in range(rounds):
        a, b = lists.where(F.col("rank") <= length).alias("a"), lists.where(F.col("rank") <= 2 * length).alias("b")
        hops = a.join(b, F.col("a.w") == F.col("b.u")).where((F.col("a.u") != F.col("b.w")) & (F.col("a.fresh") | F.col("b.fresh")))
        hops = hops.select(F.col("a.u").alias("u"), F.col("a.us").alias("us"), F.col("b.w").alias("w"), F.col("b.ws").alias("ws"), _hamming("a.us", "b.ws").alias("d"))
        old = lists.drop("rank").withColumn("fresh", F.lit(False))
        lists = cut(_ranked(old.unionByName(both(hops, True)), length, length << min(turn + 1, 2), near))
        figures = lists.agg(F.count("*").alias("n"), F.sum(F.col("fresh").cast("long")).alias("new")).first()
        if not figures["n"] or figures["new"] * 50 < figures["n"]:
            break
    pairs = start.select("u", "w", "d").unionByName(lists.select("u", "w", "d")).where(F.col("d") <= far)
    return pairs.select(F.least("u", "w").alias("u"), F.greatest("u", "w").alias("w")).distinct()


def _counted(queries: list[tuple], cosine: float):
    """Of each block of vectors: how many link with each query."""
    groups: dict[tuple, list[tuple[int, np.ndarray]]] = {}
    for q, label, v in queries:
        groups.setdefault((label, len(v)), []).append((q, np.asarray(v) / np.linalg.norm(v)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["v"].map(len)
            for key, part in batch.groupby([batch["label"], dims]):
                if key in groups:
                    x = np.stack(part["v"].to_numpy())
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    own = part["copies"].to_numpy() @ (x @ np.stack([v for _, v in groups[key]]).T >= cosine)
                    yield pd.DataFrame({"id": [q for q, _ in groups[key]], "n": own})

    return run


def _truth(grouped: DataFrame, nodes: DataFrame, cosine: float, audit: int, words: int, shuffles: int) -> list[tuple[int, int]]:
    """(id, links that leave its ball) by brute force, for ``audit`` vectors that have any, one of a ball.

    First of vectors drawn by a hash. Where too few of those have such links, of pivots that sketches sorted anew, by other
    shuffles than the graph's, show to be linked: each single linked pair is met there but with a chance of ``MISS``.
    """
    spark = grouped.sparkSession
    one = F.min(F.struct(F.xxhash64("least").alias("h"), "least", "label", "id")).alias("one")
    ids = [r["id"] for r in grouped.groupBy("pivot").agg(one).orderBy("one").limit(DRAWS * audit).select("one.id").collect()]
    ball, counted = nodes.select(F.col("id").alias("pivot"), "size"), grouped.select("label", "v", "copies")

    def linked(of: list[int]) -> list[tuple[int, int]]:
        drawn = spark.createDataFrame([(i,) for i in of], "q long")
        asked = grouped.join(F.broadcast(drawn), F.col("id") == F.col("q")).join(ball, "pivot").select("id", "label", "v", "size").collect()
        marks = [(r["id"], r["label"], r["v"]) for r in asked]
        n = {r["id"]: r["n"] for r in counted.mapInPandas(_counted(marks, cosine), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
        return [(r["id"], n[r["id"]] - r["size"]) for r in asked if n[r["id"]] > r["size"]]

    held, at, width = [], 0, 2 * audit
    while at < len(ids) and len(held) < audit:
        held += linked(ids[at : at + width])
        at, width = at + width, DRAWS * audit
    if ids and len(held) < max(1, audit // 4):
        met = cut(met_when_sorted(nodes.select("id", "label", "dim", "sketch"), words, shuffles, OTHER_SEED).select("u", "w").distinct())
        half = lambda s: nodes.select(F.col("id").alias(s), F.col("v").alias(f"v{s}"), F.col("norm").alias(f"n{s}"))
        close = met.join(half("u"), "u").join(half("w"), "w").where(_cosine("vu", "vw", "nu", "nw") >= cosine)
        found = close.select(F.explode(F.array("u", "w")).alias("id")).distinct()
        others = [r["id"] for r in found.orderBy(F.xxhash64(F.lit(5), "id")).limit(audit).collect()]
        known = {i for i, _ in held}
        held += linked([i for i in others if i not in known]) if others else []
    return held


def _block(cosine: float):
    """Of a block of a family of balls, or of several whole families: how many vectors each one links with, and a forest."""

    def compared(left: pd.DataFrame, right: pd.DataFrame | None) -> tuple[list[pd.DataFrame], list[tuple[int, int]]]:
        unit = lambda part: np.stack(part["v"].to_numpy()) / part["norm"].to_numpy()[:, None]
        x, other = unit(left), left if right is None else right
        linked = x @ (x if right is None else unit(right)).T >= cosine
        if right is None:
            np.fill_diagonal(linked, True)
        counts = [pd.DataFrame({"id": left["id"], "n": linked @ other["copies"].to_numpy()})]
        if right is not None:
            counts.append(pd.DataFrame({"id": right["id"], "n": left["copies"].to_numpy() @ linked}))
        return counts, forest(left["id"].to_numpy(), other["id"].to_numpy(), linked)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        counts, links = [], []
        for _, part in group.groupby("component"):
            right = part[part["right"]]
            alone = not len(right) and not part["paired"].iat[0]
            left = part[~part["right"]]
            if alone or (len(right) and len(left)):
                own, edges = compared(left, None if alone else right)
                counts += own
                links += edges
        edges = pd.DataFrame({"id": [a for a, _ in links], "n": -1, "other": [b for _, b in links]})
        out = pd.concat([*[c.assign(other=-1) for c in counts], edges], ignore_index=True)
        return out.astype({"id": "int64", "n": "int64", "other": "int64"})[["id", "n", "other"]]

    return run


def _family_links(members: DataFrame, cosine: float) -> DataFrame:
    """id, n, other: counts of links inside blocks (other -1) and links (n -1) for the members of families of balls.

    ``members``: component, pivot, size (of the ball), id, v, norm, copies. Balls of ``BLOCK`` vectors or more make chunks of
    their own, which are not compared with each other: a ball's vectors all link. The rest of a family is dealt over chunks.
    """
    big = F.when(F.col("n_ball") >= BLOCK, F.col("pivot")).otherwise(-1)
    balls_of = members.groupBy("component", "pivot").agg(F.count("*").alias("n_ball"))
    chunks = cut(balls_of.groupBy("component", big.alias("ball")).agg(F.ceil(F.sum("n_ball") / BLOCK).cast("int").alias("n"), F.sum("n_ball").alias("rows")))
    each = chunks.select("component", "ball", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    a, b = each.alias("a"), each.alias("b")
    before = (F.col("a.ball") < F.col("b.ball")) | ((F.col("a.ball") == F.col("b.ball")) & (F.col("a.k") <= F.col("b.k")) & (F.col("a.ball") == -1))
    met = a.join(b, F.col("a.component") == F.col("b.component")).where(before)
    paired = (F.col("a.ball") != F.col("b.ball")) | (F.col("a.k") != F.col("b.k"))
    met = met.select(F.col("a.component").alias("of"), F.col("a.ball").alias("b1"), F.col("a.k").alias("k1"), F.col("b.ball").alias("b2"), F.col("b.k").alias("k2"), paired.alias("paired"))
    sides = met.select("*", F.explode(F.when(F.col("paired"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("right"))
    sides = sides.select("of", "b1", "k1", "b2", "k2", "paired", "right", F.when(F.col("right"), F.col("b2")).otherwise(F.col("b1")).alias("mb"), F.when(F.col("right"), F.col("k2")).otherwise(F.col("k1")).alias("mk"))
    # families of one chunk are compared many in a group
    kinds = chunks.groupBy("component").agg(F.sum("n").alias("parts"), F.sum("rows").alias("rows")).select("component", (F.col("parts") == 1).alias("whole"), "rows")
    batches = max(1, -(-(kinds.where("whole").agg(F.sum("rows")).first()[0] or 0) // (4 * BLOCK)))
    dealt = members.join(balls_of, ["component", "pivot"]).withColumn("ball", big).join(chunks.select("component", "ball", "n"), ["component", "ball"]).withColumn("k", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    rows = dealt.join(sides, (F.col("component") == F.col("of")) & (F.col("ball") == F.col("mb")) & (F.col("k") == F.col("mk"))).join(kinds.select("component", "whole"), "component")
    batch = F.concat(F.lit("batch "), F.pmod(F.xxhash64("component"), F.lit(batches)).cast("string"))
    group = F.when(F.col("whole"), batch).otherwise(F.concat_ws(" ", "component", "b1", "k1", "b2", "k2"))
    work = rows.select(group.alias("grp"), "component", "paired", "right", "id", "v", "norm", "copies")
    return work.groupBy("grp").applyInPandas(_block(cosine), "id long, n long, other long")


def _all_pairs(nodes: DataFrame, theta: float) -> DataFrame:
    """u, w: all pivots of a label whose balls can hold a linked pair, in matrix blocks."""
    key = ["label", "dim"]
    blocks = nodes.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    dealt = nodes.select("id", *key, "v", "norm", "radius").join(blocks, key).withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    sides = dealt.withColumn("other", other).select("id", *key, "v", "norm", "radius", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        x, radius, ids, own = np.stack(part["v"].to_numpy()) / part["norm"].to_numpy()[:, None], part["radius"].to_numpy(), part["id"].to_numpy(), part["own"].to_numpy()
        a, b = np.flatnonzero(own == part["i"].iloc[0]), np.flatnonzero(own == part["j"].iloc[0])
        angle = np.arccos(np.clip(x[a] @ x[b].T, -1, 1))
        s, t = np.nonzero(angle <= theta + radius[a][:, None] + radius[b][None, :] + SLACK)
        u, w = ids[a[s]], ids[b[t]]
        keep = u < w if part["i"].iloc[0] == part["j"].iloc[0] else u != w
        return pd.DataFrame({"u": np.minimum(u, w)[keep], "w": np.maximum(u, w)[keep]})

    return sides.groupBy(*key, "i", "j").applyInPandas(run, "u long, w long")


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, words: int = WORDS,
    shuffles: int = SHUFFLES, length: int = LIST, rounds: int = ROUNDS, audit: int = AUDIT, recall: float = RECALL, tries: int = TRIES,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept, and recall (as audited, the same in all rows)."""
    ship_package(rows.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    given = rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), vector.alias("v"))
    finite = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    largest = F.array_max(F.transform("v", F.abs))
    scaled = given.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x / largest)))
    # different vectors are numbered in order, as rows may repeat an id; the numbers are fixed by the cut
    prepared = scaled.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    prepared = prepared.sortWithinPartitions("least", "label")
    classes = cut(prepared.withColumn("norm", F.sqrt(_dot("v", "v"))).withColumn("sketch", _signed(words, 1)("v")).withColumn("id", F.monotonically_increasing_id()))
    grouped = cut(balls(classes, cosine, words))

    theta, bits = float(np.arccos(cosine)), 64 * words
    share = theta / np.pi
    near = int(np.ceil(bits * share + 7 * np.sqrt(bits * share * (1 - share))))
    centre = classes.select(F.col("id").alias("pivot"), F.col("v").alias("pv"), F.col("norm").alias("pn"), F.col("sketch").alias("ps"))
    sized = grouped.where("id <> pivot").join(centre, "pivot").groupBy("pivot").agg(F.sum("copies").alias("more"), F.count("*").alias("beside"), F.max(_angle(_cosine("v", "pv", "norm", "pn"))).alias("radius"))
    nodes = grouped.where("id = pivot").join(sized, "pivot", "left").select("id", "label", F.size("v").alias("dim"), "v", "norm", "sketch", F.coalesce("radius", F.lit(0.0)).alias("radius"), (F.col("copies") + F.coalesce("more", F.lit(0))).alias("size"), (F.coalesce("beside", F.lit(0)) + 1).alias("balls"))
    nodes = cut(nodes)
    widest = nodes.agg(F.max("radius")).first()[0] or 0.0
    reach = min(1.0, (theta + 2 * widest) / np.pi)
    far = max(near, int(np.ceil(bits * reach + 7 * np.sqrt(bits * reach * (1 - reach))))) if widest else near
    # a pair shares the bits that part it from the others of its label in one shuffle with this chance
    largest_label = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    met = (1 - share) ** np.log2(max(2, largest_label))
    shuffles = max(shuffles, int(np.ceil(np.log(MISS) / np.log1p(-met))))
    truth = _truth(grouped, nodes, cosine, audit, words, shuffles)
    asked = rows.sparkSession.createDataFrame(truth, "q long, n long")
    found, seen = None, 0.0
    for attempt in range(tries + 1):
        if attempt < tries:
            edges = neighbour_graph(nodes.select("id", "label", "dim", "sketch"), words, shuffles, length, rounds, near, far, 1000 * (attempt + 1))
            found = cut(edges if found is None else edges.unionByName(found).distinct())
        else:
            found = cut(_all_pairs(nodes, theta))
        half = lambda s: nodes.select(F.col("id").alias(s), F.col("v").alias(f"v{s}"), F.col("norm").alias(f"n{s}"), F.col("radius").alias(f"r{s}"))
        close = found.join(half("u"), "u").join(half("w"), "w").where(_angle(_cosine("vu", "vw", "nu", "nw")) <= theta + F.col("ru") + F.col("rw") + SLACK)
        families = components(close.select("u", "w"), "u", "w").withColumnRenamed("node", "pivot")
        own = grouped.select("id", "pivot", "v", "norm", "copies").join(families, "pivot")
        told = cut(_family_links(own, cosine))
        counted = told.where("other < 0").groupBy(F.col("id").alias("a")).agg(F.sum("n").alias("n"))
        ball = nodes.select(F.col("id").alias("pivot"), "size", (F.col("balls") >= BLOCK).alias("big"))
        linked = F.when(F.col("n").isNull(), F.col("size")).otherwise(F.col("n") + F.when(F.col("big"), F.col("size")).otherwise(0))
        totals = cut(grouped.select("id", "label", "pivot").join(ball, "pivot").join(counted, F.col("id") == F.col("a"), "left").select("id", "size", linked.alias("linked")))
        share_found = F.least(F.lit(1.0), (F.col("linked") - F.col("size")) / F.col("n"))
        seen = asked.join(totals, F.col("q") == F.col("id")).agg(F.avg(share_found)).first()[0] if truth else 1.0
        if seen >= recall:
            break
    inside = grouped.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    ties = contracted(told.where("n < 0").select(F.col("id").alias("a"), F.col("other").alias("b")))
    joined = components(ties.unionByName(inside))
    whole = cut(totals.join(joined.withColumnRenamed("node", "id"), "id", "left").join(classes.select("id", "least"), "id").select("id", "linked", F.coalesce("component", "id").alias("whole"), "least"))
    heads = cut(whole.groupBy("whole").agg(F.min("least").alias("component_id")))
    back = classes.select("id", "label", "v").join(whole.join(heads, "whole"), "id").select(F.col("label").alias("l"), F.col("v").alias("x"), "linked", "component_id")
    usable_rows = scaled.where("ok").join(back, (F.col("label") == F.col("l")) & (F.col("v") == F.col("x")))
    out = usable_rows.select("vec_id", (F.col("linked") - 1).cast("long").alias("n_links"), "component_id")
    rest = scaled.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumn("recall", F.lit(seen).cast("double"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
       AND len([x FOR x IN e IF x <> 0]) > 0),
pairs AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
       WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(node, other) AS (SELECT a, b FROM pairs UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a),
least_of AS (SELECT node, min(other) AS m FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(m, v.vec_id)) AS component_id, 1.0::DOUBLE AS recall,
       v.vec_id = least(v.vec_id, coalesce(m, v.vec_id)) AS kept
FROM v LEFT JOIN degree ON a = v.vec_id LEFT JOIN least_of ON node = v.vec_id
"""
