"""Sequential greedy choices, in rounds: the rows are those of the loop, and no task holds a group.

``independent`` keeps an item unless an earlier kept one conflicts with it.  ``unions`` joins
the ends of edges one edge after another, each under conditions on the two clusters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.cluster import UnionFind
from larkspur.session import written

#: Undecided items, or edges, that one task may decide one after another once the rounds have left so few.
REST = 2000


def independent(items: DataFrame, key: str, blocked: Callable[[DataFrame, DataFrame], DataFrame], one_by_one: Callable[[DataFrame], DataFrame], rest: int = REST) -> DataFrame:
    """The ``items`` that a loop in their order keeps: those with which no earlier kept one conflicts.

    ``blocked(visitors, homes)`` gives the keys of visitors with an earlier conflicting row
    among the homes.  In a round, an undecided item without an earlier undecided conflict is
    kept, as all that could remove it is decided; those that conflict with it go.  Neither
    step needs pairs, so a dense group costs no more rows than it has.  ``one_by_one`` is the
    loop itself, for the ``rest``: a chain of conflicts would take a round a link.
    """
    open_, kept = written(items, "open"), []
    while True:
        held_up = written(blocked(open_, open_).select(key).distinct(), "held-up")
        fresh = written(open_.join(held_up, key, "left_anti"), "fresh")
        kept.append(fresh)
        waiting = open_.join(held_up, key, "left_semi")
        gone = blocked(waiting, fresh).select(key).distinct()
        open_ = written(waiting.join(gone, key, "left_anti").select(*items.columns), "open")
        left = open_.count()
        if left <= rest:
            break
    if left:
        kept.append(one_by_one(open_).select(*items.columns))
    out = kept[0].select(*items.columns)
    for more in kept[1:]:
        out = out.union(more.select(*items.columns))
    return out


def unions(edges: DataFrame, nodes: DataFrame, block: str, *, most: int = 0, near: float | None = None, rest: int = REST) -> DataFrame:
    """``block, node, cluster`` (its smallest node) by unions in order of falling ``score``, then of ``a``, then of ``b``.

    ``edges`` has ``block, a, b, score``; those with an end that isn't among the ``nodes``
    (``block, node``, once each) don't count.  A union is refused if its cluster would hold
    more than ``most`` nodes (0: no bound), two values of ``family`` (if ``nodes`` has that
    column; null is unknown and goes with any), or, with ``near``, a ``vector`` whose cosine
    to the mean of the cluster's vectors, each of length 1, is less.

    In a round, an edge that is the first at both its ends is decided: no earlier edge can
    still change either cluster.  Size, family and vectors lie on the clusters' roots; with
    ``near`` a root holds the vectors of its nodes, so ``most`` must bound them.  Edges
    within a cluster go, those that size or family refuse go before their turn, so that no
    other waits for them, and without ``near`` all but the first between two clusters: as
    clusters only grow, what was refused stays refused.  The rounds are as
    many as the longest chain of edges of which each waits for the one before; when no more
    than ``rest`` edges are left one task decides them in order.
    """
    if near is not None and not most:
        raise ValueError("near needs a bound on the nodes of a cluster")
    in_block = F.coalesce(F.col(block).cast("string"), F.lit("\0")).alias("_b")
    family = F.col("family") if "family" in nodes.columns else F.lit(None).cast("string")
    vectors = F.array(F.col("vector").cast("array<double>")) if near is not None else F.lit(None).cast("array<array<double>>")
    known = nodes.select(block, "node", in_block, F.monotonically_increasing_id().alias("id"), family.alias("family"), vectors.alias("vectors"))
    known = written(known, "nodes")
    ids = known.select("_b", "node", "id")
    at = F.struct((-F.col("score")).alias("s"), F.col("a").alias("a"), F.col("b").alias("b"))
    live = edges.select(in_block, "a", "b", at.alias("at")).join(ids.select("_b", F.col("node").alias("a"), F.col("id").alias("x")), ["_b", "a"]).join(ids.select("_b", F.col("node").alias("b"), F.col("id").alias("y")), ["_b", "b"])
    state = known.select(F.col("id").alias("root"), F.lit(1).cast("long").alias("size"), "family", "vectors")
    live = written(_apart(_open(live.where("x != y"), state, most), near is None), "edges")
    member = known.select("id", F.col("id").alias("root"))
    while (left := live.count()) > rest:
        first = live.select(F.col("x").alias("root"), "at").union(live.select("y", "at")).groupBy("root").agg(F.min("at").alias("at"))
        now = live.join(first.withColumnRenamed("root", "x"), ["x", "at"]).join(first.withColumnRenamed("root", "y"), ["y", "at"])
        ends = written(now.join(_side(state, "x"), "x").join(_side(state, "y"), "y").withColumn("joined", _allowed(most, near)), "ends")
        taken = ends.where("joined")
        merged = taken.select(F.col("x").alias("root"), (F.col("x_size") + F.col("y_size")).alias("size"), F.coalesce("x_family", "y_family").alias("family"), F.concat("x_vectors", "y_vectors").alias("vectors"))
        into = taken.select(F.col("y").alias("root"), F.col("x").alias("into"))
        state = written(state.join(taken.select(F.explode(F.array("x", "y")).alias("root")), "root", "left_anti").union(merged), "roots")
        into = taken.select(F.col("y").alias("root"), F.col("x").alias("into"))
        state = state.join(taken.select(F.explode(F.array("x", "y")).alias("root")), "root", "left_anti").union(merged)
        member = written(member.join(into, "root", "left").select("id", F.coalesce("into", "root").alias("root")), "members")
        open_ = live.join(ends.select("x", "y", "at"), ["x", "y", "at"], "left_anti")
        for end in ("x", "y"):
            open_ = open_.join(into.withColumnRenamed("root", end), end, "left").withColumn(end, F.coalesce("into", end)).drop("into")
        live = written(_apart(_open(open_.where("x != y"), state, most), near is None), "edges")
        # What no edge asks for any more goes, and most vectors with it after a few rounds.
        state = state.join(live.select(F.explode(F.array("x", "y")).alias("root")).distinct(), "root", "left_semi")
    if left:
        member = member.join(_rest(live, state, most, near), "root", "left").select("id", F.coalesce("into", "root").alias("root"))
    own = known.join(member, "id")
    least = own.groupBy("root").agg(F.min("node").alias("cluster"))
    return own.join(least, "root").select(block, "node", "cluster")


def _apart(edges: DataFrame, first_only: bool) -> DataFrame:
    """Edges with their ends in order, once each; only the first between two clusters if ``first_only``."""
    ends = edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "at")
    return ends.groupBy("x", "y").agg(F.min("at").alias("at")) if first_only else ends.distinct()


def _open(edges: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Edges that size and family don't refuse: clusters only grow and keep their family, so one that these refuse now is refused at its turn, too."""
    for end in ("x", "y"):
        edges = edges.join(_side(state, end).drop(f"{end}_vectors"), end)
    return edges.where(_fits(most)).select("x", "y", "at")


def _side(state: DataFrame, end: str) -> DataFrame:
    return state.select(F.col("root").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in ("size", "family", "vectors")))


def together(vectors: np.ndarray, near: float) -> bool:
    """Whether each of ``vectors`` is as near as that to their mean; all have length 1 first."""
    v = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    centre = v.mean(axis=0)
    norm = np.linalg.norm(centre)
    return bool(norm > 1e-12 and (v @ centre).min() / norm >= near)


def _fits(most: int) -> Column:
    kin = F.coalesce(F.col("x_family") == F.col("y_family"), F.lit(True))
    return kin & (F.col("x_size") + F.col("y_size") <= most) if most else kin


def _allowed(most: int, near: float | None) -> Column:
    fits = _fits(most)
    if near is None:
        return fits

    @F.pandas_udf(T.BooleanType())
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([together(np.stack([*x, *y]).astype(float), near) for x, y in zip(a, b, strict=True)], dtype=bool)

    return fits & F.when(fits, close("x_vectors", "y_vectors")).otherwise(False)


def _rest(live: DataFrame, state: DataFrame, most: int, near: float | None) -> DataFrame:
    """``root, into`` of the roots that the last edges join, one edge after another, in one task."""
    ends = live.join(_side(state, "x"), "x").join(_side(state, "y"), "y")
    rows = ends.select("x", "y", "at", *(f"{e}_{c}" for c in ("size", "family", "vectors") for e in ("x", "y"))).coalesce(1).sortWithinPartitions("at").drop("at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, family, vectors = {}, {}, {}

        def allowed(p: list, q: list) -> bool:
            both = [*p, *q]
            if len({family[i] for i in both} - {None}) > 1 or (most and sum(size[i] for i in both) > most):
                return False
            return near is None or together(np.stack([v for i in both for v in vectors[i]]).astype(float), near)

        found = UnionFind(0, allowed)
        for pdf in batches:
            for x, y, *own in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None):
                for held, of_x, of_y in zip((size, family, vectors), own[::2], own[1::2], strict=True):
                    held[x], held[y] = of_x, of_y
                found.union(x, y)
        pairs = [(i, root) for root, own in found.members.items() for i in own if i != root]
        yield pd.DataFrame(pairs, columns=["root", "into"])

    return rows.mapInPandas(run, "root long, into long")


def capped(edges: DataFrame, block: str, most: int = 0, family: str | None = None, rest: int = REST) -> DataFrame:
    """``unions`` of the ends of ``edges``, at most ``most`` in a cluster.

    With ``family``, ``edges`` has columns ``a_<family>`` and ``b_<family>``, and clusters never hold two families.
    The edges are computed once.
    """
    edges = written(edges, "edges")
    ends = [edges.select(block, F.col(e).alias("node"), (F.col(f"{e}_{family}") if family else F.lit(None).cast("string")).alias("family")) for e in ("a", "b")]
    nodes = ends[0].union(ends[1]).groupBy(block, "node").agg(F.max("family").alias("family"))
    return unions(edges, nodes, block, most=most, rest=rest)


def centroid_clusters(edges: DataFrame, nodes: DataFrame, block: str, *, most: int = 60, least: float = 0.80, rest: int = REST) -> DataFrame:
    """``unions`` that keep families apart and each member near the centroid: ``nodes`` has ``block, node, family, vector``."""
    return unions(edges, nodes, block, most=most, near=least, rest=rest)
