"""Streams of several batches against what one batch over all rows gives."""

from __future__ import annotations

import os
import random

import pytest

from larkspur.streaming import streams as ST

SCHEMA = "uid string, at long, seq long, body string, ts timestamp"
ORDER = ("at", "seq")


def _files(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "uid string, at long, seq long, body string").selectExpr("*", "timestamp_seconds(at) AS ts").coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):  # files are read in the order of their times
            if name.endswith(".parquet") and not name.startswith("b"):
                os.rename(f"{folder}/{name}", f"{folder}/b{i:03d}-{name}")
                os.utime(f"{folder}/b{i:03d}-{name}", (1_000_000 + 100 * i,) * 2)
        for name in os.listdir(folder):
            if name.endswith(".crc") or name == "_SUCCESS":
                os.remove(f"{folder}/{name}")
    return ST.file_stream(spark, folder, files_per_trigger=1)


def _batches(n=4, size=60):
    rng, seq, out = random.Random(5), 0, []
    for _ in range(n):
        rows = []
        for _ in range(size):
            seq += 1
            uid = rng.choice(["hot", "hot", "hot", "a", "b", "ü|", "", None])
            rows.append((uid, rng.choice([None, *range(20)]), seq, rng.choice([None, "", 'x"]\\', "é"])))
        out.append(rows)
    return out


def _key(row):
    return (-(2**63) if row[1] is None else row[1], row[2])


@pytest.mark.parametrize("late", [False, True])
def test_changes_are_those_of_each_batch(spark, tmp_path, late):
    batches = _batches()
    stream = _files(spark, str(tmp_path / "in"), batches)
    log = ST.run_to_table(ST.version_changes(stream, "uid", ORDER, late=late, most=2), str(tmp_path / "log"), str(tmp_path / "check"))
    got = sorted(((r.uid, r.kind, r.at, r.seq, r.body, r.observations if r.kind == "current" else None, tuple(r.history)) for r in log.collect()), key=repr)
    state, past, seen, want = {}, {}, {}, []
    for rows in batches:
        before = dict(state)
        for r in rows:
            if r[0] is None:
                continue
            seen[r[0]] = seen.get(r[0], 0) + 1
            if late and r[0] in before and _key(r)[0] < _key(before[r[0]])[0]:
                want.append((r[0], "late", *r[1:], None, ()))
            if r[0] not in state or _key(r) > _key(state[r[0]]):
                state[r[0]] = r
        for u, r in state.items():
            if before.get(u) != r:
                if u in before:
                    past[u] = [_key(before[u])[0], *past.get(u, [])][:2]
                want.append((u, "current", *r[1:], seen[u], tuple(past.get(u, []))))
    assert got == sorted(want, key=repr)
    now = ST.current_rows(log, "uid", ORDER).select("uid", "at", "seq", "body").collect()
    assert sorted(map(tuple, now), key=repr) == sorted(state.values(), key=repr)


def test_idle_keys_expire_and_come_back(spark, tmp_path):
    day = 86_400  # a watermark starts at the epoch, and what is no later is late
    batches = [[("a", 999 * day, 0, "u"), ("a", 1000 * day, 1, "x"), ("b", 1000 * day, 2, "y")], [("b", 1005 * day, 3, "z")], [("b", 1009 * day, 4, "w"), ("c", None, 5, "n")], [("a", 1010 * day, 6, "v")]]
    stream = _files(spark, str(tmp_path / "in"), batches)
    changes = ST.version_changes(stream, "uid", ORDER, idle_ms=3 * day * 1000, time="ts", grace="1 day")
    log = ST.run_to_table(changes, str(tmp_path / "log"), str(tmp_path / "check"))
    got = sorted((r.uid, r.kind, r.body) for r in log.collect())
    assert ("a", "expired", "x") in got and ("a", "current", "v") in got and ("c", "current", "n") not in got
    assert [g for g in got if g[0] == "b" and g[1] == "current"] == [("b", "current", "w"), ("b", "current", "y"), ("b", "current", "z")]
    assert sorted(r.body for r in ST.current_rows(log, "uid", ORDER).collect()) == ["v", "w"]  # a came back with fewer observations than it had


def test_changes_of_nothing_and_clashing_columns(spark, tmp_path):
    stream = _files(spark, str(tmp_path / "in"), [[]])
    log = ST.run_to_table(ST.version_changes(stream, "uid", ORDER), str(tmp_path / "log"), str(tmp_path / "check"))
    assert log.count() == 0 and ST.current_rows(log, "uid", ORDER).count() == 0
    with pytest.raises(ValueError, match="clash"):
        ST.version_changes(stream.withColumnRenamed("body", "Kind"), "uid", ORDER)


def test_windows_sessions_and_duplicates_over_batches(spark, tmp_path):
    hour = 3600
    batches = [[("a", 24, 1, "p"), ("a", 25, 2, "p")], [("a", 26, 3, "q"), ("b", 54, 4, "p")], [("a", 114, 5, "p")], [("b", 224, 6, "r"), ("a", 24, 7, "p")], [("a", 225, 8, "p")]]
    batches = [[(u, at * hour, n, b) for u, at, n, b in rows] for rows in batches]
    stream = _files(spark, str(tmp_path / "in"), batches).selectExpr("*", "cast(seq AS double) AS value")

    def run(df, name):
        return ST.run_to_table(df, str(tmp_path / name), str(tmp_path / f"{name}-check"))

    sessions = run(ST.sessions(stream, "uid", "90 minutes", grace="1 day"), "sessions").collect()
    # the second row of hour 24 comes behind the watermark of the batch before (30), and the last sessions are open still
    assert sorted((r.uid, r.n) for r in sessions) == [("a", 1), ("a", 3), ("b", 1)]
    slides = run(ST.window_counts(stream, "uid", "2 hours", "1 hour", grace="1 day"), "slides").collect()
    assert sum(r.n for r in slides) == 2 * 5 and {(r.end - r.start).total_seconds() for r in slides} == {2 * hour}
    once = run(ST.deduplicated(stream, ["uid", "body"], grace="1 day").select("uid", "body", "seq"), "once").collect()
    # hour 114 still meets the state of hour 24, hour 225 doesn't
    assert sorted((r.uid, r.body) for r in once) == [("a", "p"), ("a", "p"), ("a", "q"), ("b", "p"), ("b", "r")]
