"""Domain admission: rule score, decision list, blend with a semantic score, confidence."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """Terms are matched in lower case, anywhere in the text."""

    positive_groups: dict[str, tuple[str, ...]]
    negative_groups: dict[str, tuple[str, ...]]
    technical_titles: tuple[str, ...]
    foreign_titles: tuple[str, ...]
    positive_industries: tuple[str, ...]
    negative_industries: tuple[str, ...]
    strong_families: tuple[str, ...] = ()
    accept: float = 0.62
    reject: float = 0.42
    least_groups: int = 1
    semantic_weight: float = 0.42
    prototypes: dict[str, tuple[str, ...]] = field(default_factory=dict)


#: A small policy for technology postings; real ones are longer and come as a parameter.
TECHNOLOGY = Policy(
    positive_groups={
        "software": ("软件系统", "系统开发", "接口", "微服务", "代码"),
        "programming": ("java", "python", "c++", "golang", "javascript", "spring"),
        "data_ai": ("数据仓库", "机器学习", "深度学习", "大模型", "算法"),
        "infrastructure": ("linux", "服务器", "网络安全", "kubernetes", "云平台"),
        "electronics": ("嵌入式", "单片机", "fpga", "芯片", "电路"),
        "digital_product": ("prd", "原型", "需求分析", "产品迭代"),
    },
    negative_groups={
        "finance_sales": ("保险", "理财", "贷款", "销售业绩"),
        "medicine": ("药品", "临床", "医疗器械"),
        "physical_product": ("食品", "服装", "化妆品", "肥料"),
        "business": ("人事", "行政", "财务", "客服"),
        "construction": ("施工", "造价", "土建"),
    },
    technical_titles=("软件工程师", "开发工程师", "程序员", "前端开发", "后端开发", "算法工程师", "测试工程师", "运维工程师"),
    foreign_titles=("保险顾问", "理财经理", "客户经理", "销售代表", "销售经理", "医药代表"),
    positive_industries=("计算机软件", "计算机硬件", "互联网", "信息技术", "通信"),
    negative_industries=("保险", "银行", "证券", "制药", "医疗器械", "食品"),
    strong_families=("ai", "backend", "client", "chip", "infrastructure", "quality"),
)


def _any(x: Column, terms: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | x.contains(t.lower())
    return out


def _groups(x: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    return F.array_compact(F.array(*(F.when(_any(x, terms), name) for name, terms in groups.items()))) if groups else F.array().cast("array<string>")


def structured(df: DataFrame, policy: Policy, *, title: str = "title", description: str = "description", industry: str = "industry", family: str | None = None, title_match: Column | None = None, taxonomy_match: Column | None = None) -> DataFrame:
    """``df`` with the matched groups, ``structured_score`` within 0 and 1, and ``hard_label`` (null where the rules don't decide).

    ``family`` is the taxonomy family of the declared role; the matches say whether the
    title agrees with that role, or with any role of the taxonomy.
    """
    t, text, ind = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in (title, description, industry))
    evidence = F.concat_ws(";", t, F.substring(text, 1, 3000))
    fam = F.coalesce(F.col(family), F.lit("")) if family else F.lit("")
    strong = fam.isin(*policy.strong_families) if policy.strong_families else F.lit(False)
    agrees, known = (F.coalesce(m, F.lit(False)) if m is not None else F.lit(False) for m in (title_match, taxonomy_match))
    df = df.withColumn("positive_groups", _groups(evidence, policy.positive_groups)).withColumn("negative_groups", _groups(evidence, policy.negative_groups))
    technical, foreign = _any(t, policy.technical_titles), _any(t, policy.foreign_titles)
    good, bad = _any(ind, policy.positive_industries), _any(ind, policy.negative_industries)
    pos, neg = F.size("positive_groups"), F.size("negative_groups")
    score = F.lit(0.38) + F.when(fam == "", -0.12).when(strong, 0.17).otherwise(0.08)
    score = score + F.when(agrees & strong, 0.16).when(agrees, 0.10).when(known, 0.08).otherwise(0.0)
    score = score + F.when(technical, 0.20).otherwise(0.0) + F.least(pos, F.lit(3)) * 0.105 + F.when(good, 0.08).otherwise(0.0)
    score = score - F.least(neg, F.lit(2)) * 0.13 - F.when(bad, 0.16).otherwise(0.0) - F.when(foreign & ~technical, 0.32).otherwise(0.0)
    df = df.withColumn("structured_score", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6))
    label = (
        F.when(foreign & ~technical & (pos <= 1), "NON_IT")
        .when(bad & ~technical & (pos == 0) & ~strong, "NON_IT")
        .when(strong & agrees & ~foreign, "IT")
        .when(technical & ((pos > 0) | good) & ~foreign, "IT")
        .when(known & good & ~bad & ~foreign, "IT")
        .when((pos >= 2) & good & ~foreign, "IT")
        .when((pos >= 2) & (F.col("structured_score") >= 0.68) & ~foreign, "IT")
    )
    return df.withColumn("hard_label", label)


def admitted(df: DataFrame, policy: Policy, semantic: str | None = None) -> DataFrame:
    """``structured`` rows with ``score``, ``label`` and ``confidence``; the semantic score, where there is one, is blended in for rows that no rule decides."""
    s, w = F.col("structured_score"), policy.semantic_weight
    blend = F.when(F.col("hard_label").isNull() & F.col(semantic).isNotNull(), s * (1 - w) + F.col(semantic) * w).otherwise(s) if semantic else s
    df = df.withColumn("score", F.round(blend, 6))
    label = F.coalesce("hard_label", F.when((F.col("score") >= policy.accept) & (F.size("positive_groups") >= policy.least_groups), "IT").when(F.col("score") <= policy.reject, "NON_IT").otherwise("UNCERTAIN"))
    df = df.withColumn("label", label)
    sure = F.when(F.col("label") != "UNCERTAIN", F.abs(F.col("score") - 0.5) * 2).otherwise(1 - F.abs(F.col("score") - 0.52) * 2)
    return df.withColumn("confidence", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sure)), 6))
