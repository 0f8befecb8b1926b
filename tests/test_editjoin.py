"""The join of texts by ratio against all pairs."""

from __future__ import annotations

import difflib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.operators import blocks, editjoin


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


@given(st.text("abc ", max_size=14), st.lists(st.tuples(st.integers(0, 14), st.sampled_from(["", "a", "b", "cc"])), max_size=4), st.sampled_from([0.6, 0.72, 0.78, 0.9, 1.0]))
@settings(max_examples=600, deadline=None)
def test_similar_texts_share_a_key(text, edits, least):
    other = text
    for at, new in edits:
        other = other[:at] + new + other[at + 1 :]
    short, long = sorted((text, other), key=len)
    if ratio(*sorted((text, other))) >= least and text != other:
        assert editjoin.keys_of(short, least) & editjoin.probes_of(long, least)


@pytest.mark.parametrize(("least", "block"), [(0.78, 1024), (0.78, 3), (0.92, 1024)])
def test_no_pair_is_lost(spark, monkeypatch, least, block):
    monkeypatch.setattr(editjoin, "meet", lambda *a: blocks.meet(*a, block=block))
    r = random.Random(6)
    words = ["高级", "java", "开发", "工程师", "数据", "平台", "经理", " ", "(北京)", "a"]
    titles = ["".join(r.choice(words) for _ in range(r.randrange(7))) for _ in range(70)] + ["x", "y", "xx", "xy", "", "xx"]
    rows = [(r.choice(["q", None]), t) for t in titles] + [("q", None), ("q", "java开发工程师数据平台"), ("q", "java开发工程师数据平台a")]
    df = spark.createDataFrame(rows, "k string, t string")
    own = {k: {t for b, t in rows if b == k and t is not None} for k in ("q", None)}
    expected = {(k, a, b): x for k, ts in own.items() for a in ts for b in ts if a < b and (x := ratio(a, b)) >= least}
    got = [((x.k, x.a, x.b), x.ratio) for x in editjoin.similar_texts(df, "t", least, "k").collect()]
    assert dict(got) == expected and len(got) == len(expected) > 0
    everything = {(a, b) for a in own["q"] | own[None] for b in own["q"] | own[None] if a < b and ratio(a, b) >= least}
    assert {(x.a, x.b) for x in editjoin.similar_texts(df, "t", least).collect()} == everything


def test_many_keys_are_not_broadcast(spark):
    """The files of repeated titles are tiny, their keys are millions: the join of the cells' sizes mustn't go by the files."""
    df = spark.range(200).selectExpr("concat('cold plate ', lpad(cast(id % 97 as string), 2, '0')) as t", "'x' as b")
    plan = editjoin.similar_texts(df, "t", 0.9, "b")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert "SortMergeJoin" in plan
