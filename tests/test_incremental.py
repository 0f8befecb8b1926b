"""Updated states against states built from the same tables."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import incremental as I

POSTINGS = "jd_id long, company_id long, role string, industry string, level string, posted_at timestamp, salary double"
MENTIONS = "jd_id long, seq int, skill_id string, category string, stack string, requirement string, status string, confidence double"
def _key():
    return F.concat_ws("|", "role", F.col("salary").cast("string"))


def _posting(rng, jd, newest=700):
    at = None if rng.random() < 0.1 else dt.datetime(2022, 1, 1) + dt.timedelta(days=rng.randrange(newest))
    return (jd, rng.choice([None, 1, 2, 3]), rng.choice(["r1", "r2", None]), rng.choice(["i", None]), "l", at, rng.choice([1.0, 2.0, 3.0]))


def _mentions(rng, jd):
    out = []
    for seq in range(rng.randrange(6)):
        out.append((jd, seq, rng.choice(["a", "b", "c", "d"]), "k", "s", rng.choice(["preferred", "required", None]), rng.choice(["VERIFIED", "ANALYSIS_ONLY", "REJECTED"]), rng.choice([None, 0.5, 0.8, 1.0])))
    return out


def _rows(df):
    return sorted(repr([round(v, 5) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))]) for r in df.collect())


def _same(spark, state, postings, mentions):
    fresh = I.built(*_frames(spark, postings, mentions), _key())
    for name in ("postings", "accepted", "templates", "votes", "support", "skills", "pairs"):
        assert _rows(getattr(state, name)) == _rows(getattr(fresh, name)), name
    assert _rows(I.snapshots(state)) == _rows(I.snapshots(fresh)) and _rows(I.profiles(state)) == _rows(I.profiles(fresh))


def _frames(spark, postings, mentions):
    return spark.createDataFrame(list(postings.values()), POSTINGS), spark.createDataFrame([m for ms in mentions.values() for m in ms], MENTIONS)


@pytest.mark.parametrize("seed", [1])
def test_inserts_updates_and_deletes_equal_a_full_build(spark, seed):
    rng = random.Random(seed)
    postings = {i: _posting(rng, i) for i in range(60)}
    mentions = {i: _mentions(rng, i) for i in range(60)}
    state = I.built(*_frames(spark, postings, mentions), _key())
    changed = {*rng.sample(range(60), 8), *range(60, 66)}
    for i in changed:
        if i % 3 == 0 and i < 60:
            del postings[i], mentions[i]
        else:
            postings[i], mentions[i] = _posting(rng, i, newest=900), _mentions(rng, i)  # the reference moves, too
    state = I.updated(state, spark.createDataFrame([(i,) for i in [*changed, None, 999]], "jd_id long"), *_frames(spark, postings, mentions), _key())
    _same(spark, state, postings, mentions)


def test_all_gone_and_back_again(spark):
    rng = random.Random(3)
    postings, mentions = {i: _posting(rng, i) for i in range(12)}, {i: _mentions(rng, i) for i in range(12)}
    ids = spark.createDataFrame([(i,) for i in postings], "jd_id long")
    full, none = _frames(spark, postings, mentions), _frames(spark, {}, {})
    empty = I.updated(I.built(*full, _key()), ids, *none, _key())
    _same(spark, empty, {}, {})
    _same(spark, I.updated(empty, ids, *full, _key()), postings, mentions)


def test_tables_are_not_broadcast_by_their_files(spark):
    """The files of a state are small, what they hold is not."""
    rng = random.Random(5)
    postings, mentions = _frames(spark, {jd: _posting(rng, jd) for jd in range(20)}, {jd: _mentions(rng, jd) for jd in range(20)})
    state = I.built(postings, mentions, _key(), parts=("pairs",))
    assert state.parts == ("pairs",) and state.votes is None and state.support is None
    assert _rows(state.pairs) == _rows(I.built(postings, mentions, _key()).pairs)
    for df in (I._votes(state.postings, state.accepted, state.templates, 0.35, 1), I._pairs(state.accepted, 1)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
