"""Dictionary matching by the automaton and by joins against regular expressions."""

from __future__ import annotations

import random
import re

import pandas as pd
import pytest

from larkspur.operators import dictionary, evidence


def plain_first(text, alias, whole):
    pattern = re.escape(alias)
    if whole and alias.isascii():
        pattern = rf"(?<![A-Za-z0-9+#]){pattern}(?![A-Za-z0-9+#])"
    m = re.search(pattern, dictionary.simple_lower(text))
    return None if m is None else (m.start(), text[m.start() : m.end()])


@pytest.mark.parametrize("most_chars", [10_000, 0])
@pytest.mark.parametrize("whole", [True, False])
def test_occurrences(spark, most_chars, whole):
    r = random.Random(9)
    parts = ["Java", "java", "C++", "C", "#", "Spark SQL", "数据", "据分", " ", "-", "ab", "abab", "İx", "É", "."]
    texts = [(i, "".join(r.choice(parts) for _ in range(r.randrange(14)))) for i in range(60)] + [(98, None), (99, ""), (7, "java twice")]
    aliases = ["java", "JAVA", "c++", "c", "spark sql", "sql", "数据", "据分", "abab", "aba", "b", "é", "javascript", "", None, "java java"]
    df = spark.createDataFrame(texts, "id int, t string")
    words = spark.createDataFrame([(a,) for a in aliases], "a string")
    expected = sorted((i, a, *hit) for i, t in texts if t for a in {x.lower() for x in aliases if x} if (hit := plain_first(t, a, whole)))
    got = sorted((x.id, x.alias, x.at, x.raw) for x in dictionary.occurrences(df, "id", "t", words, "a", whole_words=whole, most_chars=most_chars).collect())
    assert got == expected and len(got) > 60


@pytest.mark.parametrize("most_chars", [10_000, 0])
def test_phrases_by_coverage(spark, most_chars):
    registry = spark.createDataFrame([("Java", "java"), ("Java", "Java 编程"), ("Spark", "spark"), ("Spark SQL", "spark sql"), ("SQL", "sql"), ("数据分析", "数据分析"), ("A", "xy"), ("B", "XY")], "name string, alias string")
    expected = {"JAVA!": ("Java", 1.0), "java编程能力": ("Java", 0.5), "熟悉 java 编程": ("Java", 6 / 8), "spark sql tuning": ("Spark SQL", 8 / 14), "spark and sql and more": (None, None), "数据分析能力": ("数据分析", 4 / 6), "javascript": (None, None), "xy z": ("A", 2 / 3), "": (None, None)}
    phrases = spark.createDataFrame([(p,) for p in [*expected, None, "xy z"]], "p string")
    got = {r.p: (r.name, r.coverage) for r in dictionary.resolved_phrases(phrases, "p", registry, "name", "alias", most_chars=most_chars).collect()}
    assert got == expected
    assert dictionary.resolved_phrases(phrases, "p", registry.limit(0), "name", "alias").where("name is not null").count() == 0


def test_longest_contained(spark):
    words = spark.createDataFrame([("java", "J"), ("javascript", "JS"), ("go", "G"), ("data", "D")], "a string, n string")
    titles = spark.createDataFrame([(1, "Senior JavaScript dev"), (2, "java data"), (3, "go"), (4, None), (2, "java data")], "id int, t string")
    for most in (10_000, 0):
        assert sorted(map(repr, ((r.id, r.n) for r in dictionary.longest_contained(titles, "t", words, "a", "n", most_chars=most).collect()))) == sorted(map(repr, [(1, "JS"), (2, "J"), (2, "J"), (3, None), (4, None)]))


def test_extraction_is_that_of_find_alias(spark):
    r = random.Random(4)
    skills = (evidence.Skill("java", ("Java", "java ee"), "x"), evidence.Skill("sql", ("sql", "spark sql", "SQL")), evidence.Skill("data", ("数据", "数据分析")), evidence.Skill("none", ()))
    parts = ["Java", " EE", "sql", "Spark SQL", "。", "数据", "分析", " ", "优先", "x", "\n"]
    texts = [(i, "".join(r.choice(parts) for _ in range(r.randrange(40)))) for i in range(80)]
    got = {(x.id, x.skill_id): (x.raw_term, x.requirement, x.evidence_quote) for x in evidence.extract(spark.createDataFrame(texts, "id int, t string"), skills, key="id", text_column="t").collect()}
    expected = {}
    for i, t in texts:
        for s in skills:
            if hit := evidence.find_alias(t, s.aliases):
                expected[i, s.skill_id] = hit[0], evidence.requirement(t, hit[1]), evidence.quote(t, hit[1], len(hit[0]))
    assert got == expected and len(got) > 60


def test_place_of_a_loose_hit():
    cases = [("负责 Java-Web 开发", "javaweb", 3), ("A - B", "ab", 0), ("x", "x", None), (None, "ab", None), ("ab", None, None), ("İ数 据", "数据", 1), ("no", "yes", None)]
    got = dictionary.normalized_place(pd.Series([c[0] for c in cases]), pd.Series([c[1] for c in cases]))
    assert [None if pd.isna(x) else x for x in got] == [c[2] for c in cases]
