"""Joins of short texts by their ratio, with which no pair is lost.

A ratio of ``t`` leaves at most ``(1 - t)(m + n)`` characters of texts of m and n unmatched.
Each of them spoils one segment at most of the shorter text, so of one segment more than
that one stands whole in the other text, and no farther from its own place than there are
unmatched characters.  Texts meet in what their segments and substrings have in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.blocks import meet
from larkspur.operators.dedup import _codes, ratio_from
from larkspur.session import written


def unmatched(m: int, n: int, least: float) -> int:
    """Characters of texts of ``m`` and ``n`` that may have no match."""
    return int((1 - least) * (m + n) + 1e-9)


def longest_partner(m: int, least: float) -> int:
    """The length of the longest text that one of ``m`` characters can be like."""
    return int(m * (2 - least) / least + 1e-9)


def segments(m: int, least: float) -> list[tuple[int, int]]:
    """Starts and ends of the segments of a text of ``m`` characters; one may be empty if there are few characters."""
    parts = unmatched(m, longest_partner(m, least), least) + 1
    cuts = [m * i // parts for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def keys_of(text: str, least: float) -> set[str]:
    """What a text as the shorter one is found by: its length, and place and characters of each segment."""
    return {f"{len(text)}:{i}:{text[a:b]}" for i, (a, b) in enumerate(segments(len(text), least))}


def probes_of(text: str, least: float) -> set[str]:
    """The keys of all texts, no longer than this one, that it may be like."""
    n, out = len(text), set()
    for m in range(n, -1, -1):
        if longest_partner(m, least) < n:
            break
        shift = unmatched(m, n, least)
        for i, (a, b) in enumerate(segments(m, least)):
            out.update(f"{m}:{i}:{text[p : p + b - a]}" for p in range(max(0, a - shift), min(n - (b - a), a + shift) + 1))
    return out


#: Buckets in which characters are counted before texts are compared.
BUCKETS = 64


def _may_be_alike(own: list[str], other: list[str], least: float) -> np.ndarray:
    """Whether lengths and characters allow the ratio, for all pairs at once; characters of one bucket count as equal."""
    bags = [np.stack([np.bincount(_codes(t) % BUCKETS, minlength=BUCKETS) for t in texts]).astype(np.int32) for texts in (own, other)]
    m, n = (bag.sum(axis=1) for bag in bags)
    total = m[:, None] + n[None]
    common = np.zeros(total.shape, np.int32)
    for k in range(BUCKETS):
        x, y = bags[0][:, k], bags[1][:, k]
        if x.any() and y.any():
            common += np.minimum(x[:, None], y[None])
    return (2 * common >= least * total - 1e-9) & (2 * np.minimum(m[:, None], n[None]) >= least * total - 1e-9)


def similar_texts(df: DataFrame, text: str, least: float, block: str | None = None) -> DataFrame:
    """``a, b, ratio`` of all pairs of distinct texts, ``a < b``, whose ratio, as that of ``a`` to ``b``, is ``least`` or more.

    With ``block``, which is part of the result (as a string), of texts that have it in
    common, null too.  A null text is like nothing.  A key that many texts share is compared in blocks; pairs are compared
    under the first key that they share, by the length and the characters first.
    """
    if not 0.5 < least <= 1:
        raise ValueError("least must lie above 0.5")
    of_block = F.coalesce(F.col(block).cast("string"), F.lit("\0")) if block else F.lit("")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a text has hundreds of keys: small files are much work
    texts = written(df.where(F.col(text).isNotNull()).select(of_block.alias("_b"), F.col(text).alias("t")).distinct().repartition(parts), "texts")

    def keyed(probe: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            make = probes_of if probe else keys_of
            for pdf in batches:
                made = [sorted(make(t, least)) for t in pdf["t"]]
                yield pd.DataFrame({"_b": pdf["_b"], "t": pdf["t"], "k": made}).explode("k").dropna(subset=["k"])

        return texts.mapInPandas(run, "_b string, t string, k string")

    def compare(homes: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        out, key = [], homes["k"].iloc[0]
        own, other = homes["t"].tolist(), visitors["t"].tolist()
        keys, probes = [keys_of(t, least) for t in own], {}
        for i, j in zip(*np.nonzero(_may_be_alike(own, other, least)), strict=True):
            t, u = own[i], other[j]
            if t == u or (len(t) == len(u) and t > u):
                continue
            if j not in probes:
                probes[j] = probes_of(u, least)
            if min(keys[i] & probes[j]) == key:
                a, b = min(t, u), max(t, u)
                if (r := ratio_from(a, b, least)) >= least:
                    out.append((a, b, r, homes["_b"].iloc[0]))
        return pd.DataFrame(out, columns=["a", "b", "ratio", "_b"])

    found = meet(keyed(False), keyed(True), ["_b", "k"], "t", compare, "a string, b string, ratio double, _b string")
    return found.select(*([F.when(F.col("_b") != "\0", F.col("_b")).alias(block)] if block else []), "a", "b", "ratio")
