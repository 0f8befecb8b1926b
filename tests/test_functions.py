from __future__ import annotations

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from larkspur.functions import stats
from larkspur.functions import text as X
from larkspur.functions import titles as T


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, clean", [(" a ", "a"), ("N/A", ""), ("null", ""), ("-", ""), ("﻿标题", "标题"), (None, ""), ("　x　", "x")])
def test_clean_value(spark, raw, clean):
    assert one(spark, X.clean_value(F.col("v")), v=raw) == clean


def test_normalize_and_ids(spark):
    assert one(spark, X.normalize_text(F.col("v")), v="C++ 工程师 (A.I)#1!") == "c++工程师a.i#1"
    import hashlib

    assert one(spark, X.stable_id("role", F.col("a"), F.col("b")), a=" x ", b="nan") == "role:" + hashlib.sha1(b"x|").hexdigest()[:16]
    assert one(spark, X.template_hash(F.col("v")), v="a 12 b") == one(spark, X.template_hash(F.col("v")), v="A 7b")


@pytest.mark.parametrize("raw, at", [("2025-05-01 10:00:00", (2025, 5, 1, 10)), ("2025/5/1", (2025, 5, 1)), ("2025年5月1日", (2025, 5, 1)), ("2025-05", (2025, 5, 1)), ("soon", None), ("2025-05-01T10:00:00Z", (2025, 5, 1, 10))])
def test_parse_datetime(spark, raw, at):
    assert one(spark, X.parse_datetime(F.col("v")), v=raw) == (datetime.datetime(*at) if at else None)


@pytest.mark.parametrize("title, exp, level", [("实习生", "", "实习/应届"), ("技术经理", "", "管理岗"), ("资深工程师", "3年", "专家"), ("高级工程师", "", "高级"), ("工程师", "5年", "高级"), ("工程师", "3-5年", "高级"), ("工程师", "3年", "中级"), ("工程师", "1年", "初级"), ("助理", "", "初级"), ("工程师", "", "未注明")])
def test_levels(spark, title, exp, level):
    assert one(spark, X.infer_level(F.col("t"), F.col("e"), F.lit("")), t=title, e=exp) == level


def test_decay(spark):
    at = lambda d: F.lit(datetime.datetime(*d)).cast("timestamp_ntz")
    assert one(spark, X.time_decay(at((2024, 1, 1)), at((2024, 12, 31)), 12)) == pytest.approx(0.5 ** (365 / 30.4375 / 12))
    assert one(spark, X.time_decay(F.lit(None).cast("timestamp_ntz"), at((2024, 1, 1)), 12)) == 1.0
    assert one(spark, X.time_decay(at((2025, 1, 1)), at((2024, 1, 1)), 12)) == 1.0


TITLES = [
    ("高级Java开发工程师（北京）", "Java开发工程师", []), ("产品经理（实习生）", "产品经理", []), ("AI算法工程师（大模型方向）", "算法工程师", ["大模型方向"]), ("软件开发工程师-后端方向", "软件工程师", ["后端方向"]),
    ("JAVA开发工程师", "Java开发工程师", []), ("算法工程师【AI方向】[深圳]", "算法工程师", ["AI方向"]), ("产品经理（AI方向，北京，15薪）", "产品经理", ["AI方向"]), ("急招 P6 资深 Java工程师", "Java开发工程师", []),
    ("Java开发工程师 10-20K", "Java开发工程师", []), ("数据分析师商业方向", "数据分析师", ["商业方向"]), ("外贸业务", "外贸业务", []), ("应届生（初级助理硬件工程师）", "助理硬件工程师", []), ("产品经理（供应链）", "产品经理", ["供应链"]), ("产品专员（杭州）", "产品经理", []),
]


@pytest.mark.parametrize("title, name, tags", TITLES)
def test_titles(title, name, tags):
    assert T.TitleNormalizer()(title) == (name, tags)


def test_role_rules_and_keys(spark):
    assert one(spark, T.role_title(F.col("t"), F.lit("x")), t="资深Golang后端") == "Go开发工程师"
    assert one(spark, T.role_title(F.col("t"), F.lit("x")), t="高级厨师（夜班）") == "厨师"
    assert one(spark, T.evolution_title(F.col("t")), t="急聘 高级大数据开发工程师（北京）-金融方向") == "大数据开发工程师"
    assert one(spark, T.responsibilities(F.col("t")), t="岗位职责：1、负责系统架构设计与开发；2、负责系统架构设计与开发；薪资福利优厚可以面谈；任职要求：本科") == ["负责系统架构设计与开发；"]


def test_tests_agree_with_enumeration():
    rng = random.Random(3)
    for _ in range(50):
        n1, n2 = rng.randint(1, 15), rng.randint(1, 15)
        x1, x2 = rng.randint(0, n1), rng.randint(0, n2)
        hits = x1 + x2
        p = {k: math.comb(n1, k) * math.comb(n2, hits - k) for k in range(max(0, hits - n2), min(n1, hits) + 1)}
        expected = sum(v for v in p.values() if v <= p[x1]) / sum(p.values())
        assert stats.fisher_exact(x1, n1, x2, n2) == pytest.approx(expected, rel=1e-9)
    assert stats.two_proportion(0, 0, 1, 2) == 1.0 and stats.two_proportion(0, 5, 0, 5) == 1.0
    assert stats.chosen_test(1, 10, 2, 10) == "fisher_exact" and stats.chosen_test(100, 400, 90, 400) == "two_proportion_z"


def test_bh_and_divergence(spark):
    rows = [(f, i, p) for f in "ab" for i, p in enumerate((0.01, 0.04, 0.03, 0.5))]
    q = {(r.f, r.i): r.q_value for r in stats.bh_qvalues(spark.createDataFrame(rows, "f string, i int, p double"), ["f"], "p", ["i"]).collect()}
    assert [q["a", i] for i in range(4)] == pytest.approx([0.04, 0.16 / 3, 0.16 / 3, 0.5])
    assert all(q[f, i] >= p for f, i, p in rows)
    d = spark.createDataFrame([("x", 1, 0), ("y", 0, 1)], "k string, l int, r int").withColumn("g", F.lit(1))
    assert stats.js_divergence(d, ["g"], "l", "r").first().divergence == pytest.approx(1.0)


def test_wilson(spark):
    lo, hi = stats.wilson(F.lit(5), F.lit(10))
    r = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (r.lo, r.hi) == pytest.approx((0.2366, 0.7634), abs=1e-4)


def test_display_title(spark):
    assert one(spark, T.display_title(F.col("t")), t="java与c++开发工程师 (devops)") == "Java与C++开发工程师 (DevOps)"


def test_a_text_is_gone_through_once(spark):
    """Grams and normalized text as by rule, and no use of the text is normalized anew."""
    import re

    from larkspur.functions import text as X

    texts = ["", None, " NaN﻿\n", "n﻿a", "N/A", "- ", "nan.", "none x", "İa工程 b#", "abc", "ab", "x" * 5 + "😀y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")

    def plain(t):
        t = (t or "").replace("﻿", "").strip().lower()
        return "" if t in X.BLANKS else re.sub("[^0-9a-z一-鿿+#.]", "", t)

    got = df.select("i", X.normalize_text(df.t).alias("n"), X.shingles(df.t).alias("g")).orderBy("i").collect()
    expected = [plain(t) for t in texts]
    assert [r.n for r in got] == expected
    assert [r.g for r in got] == [[n[i : i + 3] for i in range(len(n) - 2)] if len(n) > 3 else [n] * bool(n) for n in expected]
    assert str(X.shingles(df.t)).lower().count("regexp_replace") == 1


def test_blocks_of_the_exact_search_stay_few():
    """A row is sent to every block of the other side, so blocks grow before they multiply."""
    from larkspur.operators.similarity import MOST_BLOCK, PARTS, _parts

    assert [_parts(n) for n in (0, 1, 1025, 51_282, PARTS * MOST_BLOCK, PARTS * MOST_BLOCK + 1)] == [1, 1, 2, 16, 16, 17]


def test_all_of_a_long_text_is_cut_into_grams(spark, tmp_path):
    """Two texts that differ behind 12,000 characters have different grams, and the query and its SQL count all of them."""
    import duckdb

    from larkspur.plans import catalog

    texts = ["a" * 12_000 + "bcd", "a" * 12_000 + "efgh 1", "ab, " * 40_000, "x" * 12_002, "ab", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    last = df.where("doc_id < 2").orderBy("doc_id").select(F.element_at(X.shingles(df.text), -1).alias("g"), F.size(X.shingles(df.text)).alias("n")).collect()
    assert [(r.g, r.n) for r in last] == [("bcd", 12_001), ("gh1", 12_003)]
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    expected = {r[0]: r[2] for r in con.sql(catalog.ORACLE_SQL["text_functions"]).fetchall()}
    got = {r.doc_id: r.grams for r in catalog.QUERIES["text_functions"](spark, str(tmp_path)).collect()}
    assert got == expected == {0: 12_001, 1: 12_003, 2: 79_998, 3: 12_000, 4: 1, 5: 0, 6: 0}
