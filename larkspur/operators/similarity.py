"""Vectors: embedding, nearest neighbours, prototypes, and diversified selection."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.stats import cosine
from larkspur.operators.blocks import BLOCK, meet
from larkspur.operators.greedy import REST, independent
from larkspur.session import written


def hashed_vector(text: str, dims: int = 384) -> list[float]:
    """Signed feature hashing of characters, bigrams and trigrams, of length 1; deterministic and offline."""
    out = np.zeros(dims)
    t = "".join(text.lower().split())
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            h = int.from_bytes(hashlib.blake2b(t[i : i + n].encode(), digest_size=8).digest(), "big")
            out[h % dims] += (1 if h >> 63 else -1) * (1.0 if n > 1 else 0.5)
    norm = np.linalg.norm(out)
    return (out / norm if norm else out).tolist()


@F.pandas_udf(T.ArrayType(T.FloatType()))
def embed(texts: pd.Series) -> pd.Series:
    """The default embedder, by distinct text within a batch."""
    known = {t: hashed_vector(t or "") for t in texts.unique()}
    return texts.map(known)


def embed_distinct(df: DataFrame, text: str, vector: str = "vector") -> DataFrame:
    """``df`` with vectors of a text column; each distinct text is encoded once."""
    known = df.select(text).distinct().withColumn(vector, embed(text))
    return df.join(known, text)


def _blocks(df: DataFrame, key: str, vector: str, n: int) -> DataFrame:
    return df.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("blk"), F.col(key).alias("key"), F.col(vector).alias("v"))


#: Blocks of a side of ``top_k`` while they hold no more than ``MOST_BLOCK`` rows.
PARTS, MOST_BLOCK = 16, 32768


def _parts(rows: int) -> int:
    return max(1, min(PARTS, -(-rows // BLOCK)), -(-rows // MOST_BLOCK))


#: Queries and rows that ``top_k`` multiplies at a time: few enough for their products to stay in a cache.
STRIP, ROWS = 256, 2048


def _best(a: np.ndarray, b: np.ndarray, mine: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` and the rounded similarities of the ``k`` best of each row of ``a``, ordered; equal ones by place in ``b``, and no key with itself.

    Single precision tells which products may be among them, less a margin for its error; these
    are computed anew.
    """
    x, y, margin = a.astype(np.float32), b.astype(np.float32), (a.shape[1] + 8) * 1.2e-7 + 1e-9
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    bar = np.full(len(a), -np.inf, np.float32)  # what a product must reach: none less than it can be among the best
    for j in range(0, len(b), ROWS):
        s = x @ y[j : j + ROWS].T
        if not j and s.shape[1] > k:
            least = np.partition(s, -k - 1, axis=1)[:, -k - 1]  # one of the k + 1 may be the row itself
            bar = np.where(least > 2 * margin, least - 2 * margin, -np.inf).astype(np.float32)
        at, to = np.nonzero(s >= bar[:, None])
        apart = mine[at] != other[j + to]
        at, to = at[apart], j + to[apart]
        new = (at, to, np.round(np.clip(np.einsum("ij,ij->i", a[at], b[to]), 0, 1), 9))
        at, to, found = (np.concatenate(p) for p in zip(held, new, strict=True))
        order = np.lexsort((to, -found, at))
        at, to, found = at[order], to[order], found[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        held = [p[rank < k] for p in (at, to, found)]
        last = rank == k - 1
        bar[at[last]] = np.where(found[last] > 0, found[last] - margin, -np.inf)
    return held[0], held[1], held[2]


def top_k(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, least: float = 0.0) -> DataFrame:
    """``query, neighbour, similarity, rank``: the ``k`` most similar rows of each query, itself left out.

    Queries and rows are cut into blocks; a task multiplies two blocks and keeps the best
    ``k`` of each query there, so what is shuffled on is ``k`` rows for each query and
    block.  A row is sent to every block of the other side: up to ``PARTS * MOST_BLOCK``
    rows these are no more than ``PARTS``, so the shuffle grows with the rows; the products are
    quadratic.  Equal similarities are ordered by key.  A product is looked at once, against
    the ``k``-th best that its query has so far; few pass, and only these are rounded and ordered.
    """
    n, m = _parts(rows.count()), _parts(queries.count())
    left = _blocks(queries, key, vector, m).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select("blk", "other", F.lit(0).alias("side"), "key", "v")
    right = _blocks(rows, key, vector, n).withColumn("mine", F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).select(F.col("mine").alias("blk"), F.col("blk").alias("other"), F.lit(1).alias("side"), "key", "v")
    kind = dict(rows.dtypes)[key]

    def run(rows: pa.Table) -> pa.Table:
        side, keys = rows["side"].to_numpy(), rows["key"].to_numpy()
        v = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
        q, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        r = r[np.argsort(keys[r], kind="stable")]
        a, b = (v[x].astype(np.float64) for x in (q, r))
        a, b = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) for x in (a, b))
        mine, other, out = keys[q], keys[r], [(keys[:0], keys[:0], np.zeros(0))]
        for i in range(0, len(q) if len(r) else 0, STRIP):
            at, to, found = _best(a[i : i + STRIP], b, mine[i : i + STRIP], other, k)
            near = found >= max(least, 0.0)
            out.append((mine[i + at[near]], other[to[near]], found[near]))
        return pa.table(dict(zip(("query", "neighbour", "similarity"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    part = left.union(right).groupBy("blk", "other").applyInArrow(run, f"query {kind}, neighbour {kind}, similarity double")
    w = Window.partitionBy("query").orderBy(F.col("similarity").desc(), "neighbour")
    return part.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def cell_centres(rows: DataFrame, key: str, vector: str, cells: int, sample: int = 20_000, rounds: int = 8) -> np.ndarray:
    """Centres of ``cells`` cells by k-means on at most ``sample`` rows, drawn by a hash of their key."""
    n = rows.count()
    drawn = rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < min(1_000_000, 1_200_000 * sample // max(n, 1) + 1)).select(key, vector).limit(sample).collect()
    v = np.array([r[vector] for r in sorted(drawn, key=lambda r: r[key])], np.float64)
    if not len(v):
        return v.reshape(0, 1)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    centres = v[np.linspace(0, len(v) - 1, min(cells, len(v))).astype(int)]
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, v)
        used = np.linalg.norm(total, axis=1) > 0
        centres[used] = total[used] / np.linalg.norm(total[used], axis=1, keepdims=True)
    return centres


def nearest_by_cells(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, *, cells: int = 256, probes: int = 64, least: float = 0.0) -> DataFrame:
    """As ``top_k``, by an inverted index of cells: each row lies in the cell of its nearest centre, and a query looks into ``probes`` cells.

    All rows are indexed, and neighbours in other cells are missed: recall is measured
    in the tests (0.9 at least) and rises with ``probes``.  A cell with many rows falls
    into blocks, of which each meets the cell's queries, so no cell is one task.  The
    centres are a table of ``cells`` rows, whatever the input; cells of about
    ``BLOCK`` rows, that is ``cells`` in proportion to the rows, keep the work linear.
    """
    spark, kind = rows.sparkSession, dict(rows.dtypes)[key]
    centres = spark.sparkContext.broadcast(cell_centres(rows, key, vector, cells).astype(np.float32))

    def placed(df: DataFrame, most: int) -> DataFrame:
        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def near(vectors: pd.Series) -> pd.Series:
            v = np.stack(vectors.to_list()).astype(np.float32)
            return pd.Series(list(np.argsort(-(v @ centres.value.T), axis=1, kind="stable")[:, :most].astype(np.int32)))

        return df.select(F.col(key).alias("key"), F.col(vector).alias("v"), F.explode(near(F.col(vector))).alias("cell"))

    index = placed(rows, 1)
    sizes = index.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # a row a cell
    right = index.join(F.broadcast(sizes), "cell").select("cell", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("part"), F.lit(1).alias("side"), "key", "v")
    left = placed(queries, probes).join(F.broadcast(sizes), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(0).alias("side"), "key", "v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, None

        def met(q: pd.DataFrame) -> pd.DataFrame:
            a = np.stack(q["v"].to_list()).astype(np.float64)
            a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
            s = np.round(np.clip(a @ held[1].T, 0, 1), 9)
            s[q["key"].to_numpy()[:, None] == held[0][None, :]] = -1
            best = np.argsort(-s, axis=1, kind="stable")[:, :k]
            at = np.repeat(np.arange(len(q)), best.shape[1])
            found = s[at, best.ravel()]
            return pd.DataFrame({"query": q["key"].to_numpy()[at], "neighbour": held[0][best.ravel()], "similarity": found})[found >= max(least, 0.0)]

        for pdf in batches:
            for cell, part in pdf[["cell", "part"]].drop_duplicates().itertuples(index=False):
                own = pdf[(pdf["cell"] == cell) & (pdf["part"] == part)]
                r, q = own[own["side"] == 1], own[own["side"] == 0]
                if (cell, part) != now:
                    now, held = (cell, part), None
                if len(r):  # a block's rows come first and may span batches
                    v = np.stack(r["v"].to_list()).astype(np.float64)
                    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                    keys = r["key"].to_numpy()
                    held = (keys, v) if held is None else (np.concatenate([held[0], keys]), np.concatenate([held[1], v]))
                for i in range(0, len(q), BLOCK):
                    if held is not None:
                        yield met(q.iloc[i : i + BLOCK])

    both = right.union(left).repartition("cell", "part").sortWithinPartitions("cell", "part", F.desc("side"), "key")
    part = both.mapInPandas(run, f"query {kind}, neighbour {kind}, similarity double")
    w = Window.partitionBy("query").orderBy(F.col("similarity").desc(), "neighbour")
    return part.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def mutual(neighbours: DataFrame) -> DataFrame:
    """Pairs ``a < b`` that are among each other's neighbours."""
    back = neighbours.select(F.col("query").alias("neighbour"), F.col("neighbour").alias("query"))
    return neighbours.join(back, ["query", "neighbour"]).where("query < neighbour").select(F.col("query").alias("a"), F.col("neighbour").alias("b"), "similarity")


#: Prototypes of one scoring; they are literals of its plan.
MOST_PROTOTYPES = 1000


def prototype_score(df: DataFrame, vector: str, prototypes: DataFrame, factor: float = 2.6) -> DataFrame:
    """``df`` with the best cosine to positive and to negative prototypes (``positive, v``) and 0.5 plus ``factor`` times their difference.

    The prototypes are a dictionary of a few rows, whatever the table; more than
    ``MOST_PROTOTYPES`` are an error.  No shuffle, and rows that repeat stay.
    """
    rows = prototypes.select("positive", F.col("v").cast("array<double>").alias("v")).limit(MOST_PROTOTYPES + 1).collect()
    if len(rows) > MOST_PROTOTYPES:
        raise ValueError(f"more than {MOST_PROTOTYPES} prototypes")

    def best(positive: bool) -> Column:
        all_of = [cosine(F.col(vector), F.array(*map(F.lit, r.v))) for r in rows if r.positive == positive]
        return F.greatest(*all_of) if len(all_of) > 1 else all_of[0] if all_of else F.lit(None).cast("double")

    out = df.withColumn("positive_similarity", best(True)).withColumn("negative_similarity", best(False))
    raw = 0.5 + (F.col("positive_similarity") - F.col("negative_similarity")) * factor
    return out.withColumn("semantic_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def mmr(df: DataFrame, keys: list[str], item: str, score: str, vector: str, quota: int, relevance: float = 0.75, candidates: int = 30) -> DataFrame:
    """Maximal marginal relevance for each of ``keys``: ``relevance`` of the score less the rest of the largest cosine to what is chosen.

    Only the best ``candidates`` of a group reach its task, so a group is bounded.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), item)
    best = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= candidates).drop("_n")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([score, item], ascending=[False, True]).reset_index(drop=True)
        v = np.stack(pdf[vector].to_list()).astype(float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        like, chosen = v @ v.T, []
        while len(chosen) < min(quota, len(pdf)):
            gain = relevance * pdf[score].to_numpy() - (1 - relevance) * (like[:, chosen].max(axis=1) if chosen else 0)
            gain[chosen] = -np.inf
            chosen.append(int(np.argmax(np.round(gain, 12))))
        out = pdf.loc[chosen, [*keys, item, score]].copy()
        out["mmr_rank"] = np.arange(1, len(chosen) + 1)
        return out

    kinds = dict(df.dtypes)
    return best.select(*keys, item, score, vector).groupBy(*keys).applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in (*keys, item, score)) + ", mmr_rank long")


def without_redundant(df: DataFrame, keys: list[str], item: str, score: str, vector: str, least: float = 0.95, rest: int = REST) -> DataFrame:
    """In order of falling score, then of item, an item goes if a kept one of its group is as similar as ``least``; every item is decided.

    ``greedy.independent`` over a join by angles: rows lie in the cell of their nearest
    centre; as angles are a metric, a row needs to look only into cells whose centre is no
    farther than the cell's radius and the angle of ``least``.  Nothing is missed.  A cell
    of a group is compared in blocks.  Of equal vectors of a group only the first is
    looked at, as it stands for the others.  A null score comes last.
    """
    if not 0 < least < 1:
        raise ValueError("least must lie between 0 and 1")
    spark = df.sparkSession
    columns = [*keys, item, score]
    group = F.concat_ws("\x1f", *(F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys))
    place = F.when(F.col(score).isNull(), float("inf")).when(F.isnan(F.col(score).cast("double")), float("-inf")).otherwise(-F.col(score).cast("double"))
    rows = df.select(F.struct(*columns).alias("_row"), F.monotonically_increasing_id().alias("_id"), group.alias("_g"), place.alias("_at"), F.col(item).alias("_item"), F.col(vector).cast("array<double>").alias("v"))
    rows = written(rows, "vectors")
    same = ["_g", F.xxhash64("v"), F.xxhash64(F.lit(1), "v")]
    some = F.exists("v", lambda x: x != 0)
    first = rows.where(some).groupBy(*same).agg(F.min(F.struct("_at", "_item", "_id")).alias("f")).select(F.col("f._id").alias("_id"))
    rows = rows.join(first, "_id", "left_semi").unionByName(rows.where(~some))
    rows = written(rows, "distinct")

    angle, n = float(np.arccos(least)), rows.count()
    made = cell_centres(rows, "_id", "v", min(MOST_CELLS, max(1, -(-n // CELL))))
    centres = spark.sparkContext.broadcast(made)
    placed = rows.select("*", _cell(centres)("v").alias("c")).select("*", "c.cell", "c.angle").drop("c")
    placed = written(placed, "placed")
    radius = np.full(max(1, len(made)), -np.inf)
    for r in placed.groupBy("cell").agg(F.max("angle").alias("r")).collect():  # a row a cell
        radius[r.cell] = r.r
    reached = _reached(centres, spark.sparkContext.broadcast(radius), angle + 1e-6)

    def compare(homes: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        a, b = (np.stack(x["v"].to_list()).astype(float) for x in (visitors, homes))
        a, b = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) for x in (a, b))
        found = np.zeros(len(a), bool)
        for i in range(0, len(a), BLOCK):
            for j in range(0, len(b), BLOCK):
                u, w = np.nonzero(a[i : i + BLOCK] @ b[j : j + BLOCK].T >= least)
                (at, own_at), (item_, own), (id_, own_id) = ((homes[c].to_numpy()[j + w], visitors[c].to_numpy()[i + u]) for c in ("_at", "_item", "_id"))
                found[i + u[(at < own_at) | ((at == own_at) & ((item_ < own) | ((item_ == own) & (id_ < own_id))))]] = True
        return visitors.loc[found, ["_id"]]

    need = ["_id", "_g", "_at", "_item", "v"]

    def blocked(visitors: DataFrame, homes: DataFrame) -> DataFrame:
        return meet(homes.select(*need, "cell"), visitors.select(*need, F.explode(reached("v")).alias("cell")), ["_g", "cell"], "_id", compare, "_id long", CELL)

    def one_by_one(left: DataFrame) -> DataFrame:
        kept = _one_by_one(left.select("_g", F.struct("_item", "_id").alias("_i"), (-F.col("_at")).alias("_s"), "v"), ["_g"], "_i", "_s", "v", least)
        return left.join(kept.select("_i._id"), "_id", "left_semi")

    return independent(placed, "_id", blocked, one_by_one, rest).select("_row.*")


#: Cells of a join by angles; their centres and radii are broadcast.
MOST_CELLS = 4096
#: Rows of a cell, and of a side of a comparison: each row is sent to every cell within reach, so large ones save shuffle.
CELL = 8192


def _cell(centres: Broadcast) -> Callable:
    @F.pandas_udf("cell int, angle double")
    def cell(vectors: pd.Series) -> pd.DataFrame:
        at = _angles(vectors, centres.value)
        best = at.argmin(axis=1)
        return pd.DataFrame({"cell": best.astype(np.int32), "angle": at[np.arange(len(at)), best]})

    return cell


def _reached(centres: Broadcast, radius: Broadcast, angle: float) -> Callable:
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def reached(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.flatnonzero(x).astype(np.int32) for x in _angles(vectors, centres.value) <= radius.value + angle])

    return reached


def _angles(vectors: pd.Series, centres: np.ndarray) -> np.ndarray:
    """Angles between vectors and centres; without centres there is one cell, as near to all."""
    if not len(centres):
        return np.zeros((len(vectors), 1))
    v = np.stack(vectors.to_list()).astype(float)
    return np.arccos(np.clip(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12) @ centres.T, -1, 1))


def _one_by_one(df: DataFrame, keys: list[str], item: str, score: str, vector: str, least: float) -> DataFrame:
    """``without_redundant`` as a loop: a group is one task, which holds the kept vectors."""
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, kept = None, []
        for pdf in batches:
            own = list(zip(*(pdf[k].astype(object).where(pdf[k].notna(), None) for k in keys), strict=True))
            cuts = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
            for lo, hi in ((i, min(i + BLOCK, end)) for start, end in zip(cuts, cuts[1:], strict=False) for i in range(start, end, BLOCK)):
                if own[lo] != group:
                    group, kept = own[lo], []
                v = np.stack(pdf[vector].iloc[lo:hi].to_list()).astype(float)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                free = np.ones(len(v), bool)
                for block in kept:
                    free[free] = (v[free] @ block.T).max(axis=1) < least
                chosen: list[int] = []
                for i in np.flatnonzero(free).tolist():
                    if not chosen or (v[chosen] @ v[i]).max() < least:
                        chosen.append(i)
                if chosen:
                    if kept and len(kept[-1]) + len(chosen) <= BLOCK:
                        kept[-1] = np.concatenate([kept[-1], v[chosen]])
                    else:
                        kept.append(v[chosen])
                yield pdf[[*keys, item, score]].iloc[[lo + i for i in chosen]]

    rows = df.select(*keys, item, score, vector).repartition(*(F.col(k) for k in keys)).sortWithinPartitions(*keys, F.col(score).desc(), item)
    return rows.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in (*keys, item, score)))


def resolution(best: DataFrame, exact: Column, alias: Column, conflict: Column, similarity: Column, accept: float = 0.93, review: float = 0.82) -> DataFrame:
    """``decision`` by the ladder exact, alias, vector match without conflict, review, unmapped."""
    ladder = F.when(exact, "EXACT").when(alias, "ALIAS").when((similarity >= accept) & ~conflict, "VECTOR_MATCH").when(similarity >= review, "REVIEW").otherwise("UNMAPPED")
    return best.withColumn("decision", ladder)
