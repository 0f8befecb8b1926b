"""Job titles: configurable normalization to a name and tags, and the rules of evolution mining."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import bound, clean_value, first_rule, normalize_text, strip

#: Title patterns by precedence.
ROLE_RULES = [
    ("大模型|llm|语言模型", "大模型算法工程师"), ("自然语言|nlp", "自然语言处理工程师"), ("计算机视觉|机器视觉|图像算法|视觉算法|图像识别", "计算机视觉工程师"),
    ("机器学习", "机器学习工程师"), ("深度学习", "深度学习工程师"), ("算法", "算法工程师"), ("python.*(开发|工程师)|(开发|工程师).*python", "Python开发工程师"),
    ("java.*(开发|工程师)|(开发|工程师).*java", "Java开发工程师"), ("golang|go语言", "Go开发工程师"), (r"c\+\+|cpp", "C++开发工程师"), (r"\.net|c#", ".NET开发工程师"),
    ("后端|服务端", "后端开发工程师"), ("前端", "前端开发工程师"), ("数据产品", "数据产品经理"), ("平台产品", "平台产品经理"), ("产品助理|产品专员", "产品助理"), ("产品经理|产品主管", "产品经理"),
    ("数据分析", "数据分析师"), ("数据建模", "数据建模工程师"), ("etl", "ETL开发工程师"), ("bi工程师|商业智能", "BI工程师"), ("自动化测试|测试开发", "自动化测试工程师"),
    ("软件测试|测试工程师", "软件测试工程师"), ("运维", "运维工程师"), ("网络工程师|网络运维", "网络工程师"), ("嵌入式软件", "嵌入式软件工程师"), ("嵌入式硬件", "嵌入式硬件工程师"), ("硬件测试", "硬件测试工程师"), ("硬件工程师|硬件开发", "硬件工程师"),
]


#: Words that end the name of a whole role.
ROLE_WORDS = "工程师|架构师|设计师|分析师|产品经理|项目经理|顾问|专员|负责人|专家|主管|总监"


def role_title(title: Column, fallback: Column) -> Column:
    """The first rule's role; else the title without brackets and degree words; else the fallback."""
    rest = F.regexp_replace(F.regexp_replace(clean_value(title), "[（(].*?[）)]", ""), r"高级|资深|初级|中级|专家|实习|急聘|诚聘|招聘|\s+", "")
    rest = F.regexp_replace(rest, "^[-_/·,，。 ]+|[-_/·,，。 ]+$", "")
    rest = bound(rest, lambda t: F.when(F.length(t).between(2, 24), t).otherwise(fallback))
    return bound(normalize_text(title), lambda t: first_rule(t, ROLE_RULES, rest))


def evolution_title(title: Column) -> Column:
    """A clustering key: lower case, without brackets, direction, codes, pay, degree words and punctuation."""
    # Words that are no part of a role.
    noise = "急聘|急招|诚聘|高薪|直招|热招|五险一金|五险|一金|双休|周末双休|朝九晚五|不加班|包吃住|包吃包住|专人培训|带薪培训|校招|社招|应届生|实习生|储备"
    level = r"首席|资深|高级|中级|初级|助理|见习|senior|junior|lead|principal|sr\.?|jr\.?"
    role_end = "(?:工程师|开发|测试|架构师|设计师|分析师|算法|顾问|产品经理|项目经理|运维|实施|运营|专员|负责人|专家|主管|总监)$"
    t = F.regexp_replace(F.lower(strip(F.coalesce(title, F.lit("")))), r"[（(【\[][^()（）【】\[\]]{0,60}[)）】\]]", "")
    t = F.regexp_replace(t, r"\s*[-—–|｜]\s*[^-—–|｜]{1,40}(?:方向|业务|项目|岗位|团队|城市|地区)\s*$", "")
    whole = F.regexp_extract(t, rf"^(.+?(?:{ROLE_WORDS}|开发|测试|运维|实施|运营))\s*[-—–|｜/／\\、,，]\s*(?!.*(?:{ROLE_WORDS})\s*$).+$", 1)
    t = F.when(whole != "", whole).otherwise(t)
    parts = F.filter(F.transform(F.split(t, "[/／|｜]"), strip), lambda p: p.rlike(role_end))
    shortest = F.array_min(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    t = F.when(F.size(parts) >= 2, shortest).otherwise(t)
    for pattern in (noise, r"[（(]?\s*[jz]\d{3,}\s*[)）]?", r"\d+(?:-\d+)?(?:k|千|万)(?:/月|·\d+薪)?", rf"^\s*(?:(?:{level})\s*)+", rf"(?:{level})(?=工程师|开发|测试|设计|架构|算法|顾问|专员)", r"[\s\-—–·|/\\,，、;；:：()（）\[\]【】{}<>《》&＆]+"):
        t = F.regexp_replace(t, pattern, "")
    t = F.regexp_replace(F.regexp_replace(t, "(工程师)(?:部门)?工程师$", "$1"), "^[+＋]+|[+＋]+$", "")
    t = F.regexp_replace(t, "(岗位|职位|招聘)$", "")
    raised = t.rlike("(?:负责人|专家)$") & t.rlike("软件|硬件|测试|研发|开发|算法|系统|平台|数据") & ~t.contains("项目")
    return F.substring(F.when(raised, F.regexp_replace(t, "(?:负责人|专家)$", "工程师")).otherwise(t), 1, 80)


def responsibilities(text: Column, most: int = 8) -> Column:
    """The first distinct sentences of the duties, of 8 to 220 characters, without those on pay and formalities."""
    duties = F.element_at(F.split(F.coalesce(text, F.lit("")), "(?i)任职要求|岗位要求|职位要求|任职资格|我们希望你|资格要求", 2), 1)
    heading = r"(?i)^(岗位职责|工作职责|工作内容|主要职责|职位描述|职责描述)[:：]?\s*"
    cut = F.split(F.regexp_replace(strip(duties), heading, ""), r"[\r\n]+|(?<=[。；;])")
    clean = lambda s: F.regexp_replace(F.regexp_replace(F.regexp_replace(s, heading, ""), "^[ \t\\-—•·0-9.、）)]+|[ \t\\-—•·0-9.、）)]+$", ""), r"\s+", " ")
    kept = F.filter(F.transform(cut, clean), lambda s: F.length(s).between(8, 220) & ~s.rlike("薪资|福利|五险|公积金|双休|团建|年龄|投递|联系方式|招聘人数|上班时间"))
    return F.slice(F.array_distinct(kept), 1, most)


@dataclass(frozen=True)
class TitleConfig:
    """Terms and patterns that a title is cleaned by; ``synonyms`` map whole cleaned names."""

    locations: tuple[str, ...] = ("北京", "上海", "广州", "深圳", "杭州", "成都", "武汉", "南京", "西安", "苏州")
    recruitment: tuple[str, ...] = ("实习生", "应届生", "校招", "社招", "实习", "兼职", "全职")
    modifiers: tuple[str, ...] = ("急招", "急聘", "诚聘", "高薪", "资深", "高级", "中级", "初级", "首席", "热招", "直招")
    anchors: tuple[str, ...] = ("工程师", "分析师", "经理", "专员", "设计师", "架构师", "顾问", "程序员")
    patterns: tuple[str, ...] = (r"(?i)\d+(?:\.\d+)?\s*[-~]\s*\d+(?:\.\d+)?\s*[k万千](?:/月)?", r"\d+薪", r"(?i)\b[PTM]\d{1,2}\b", r"(?i)\b[JZ]\d{3,}\b")
    synonyms: dict[str, str] = field(default_factory=lambda: {"ai算法工程师": "算法工程师", "软件开发工程师": "软件工程师", "java开发工程师": "Java开发工程师", "java工程师": "Java开发工程师", "产品专员": "产品经理"})
    keep_unknown: bool = True


def _any_of(terms: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) or "(?!)", re.I)


class TitleNormalizer:
    """A title as a name and tags: brackets hold directions or noise, directions after a separator are tags."""

    _BRACKET = re.compile(r"[（(]([^（()）]*)[)）]|【([^【】]*)】|\[([^\[\]]*)\]|《([^《》]*)》")
    _DIRECTION = re.compile(r"[0-9A-Za-z+#.一-鿿]{1,30}(?:方向|领域)", re.I)
    _EDGE = " -_/,，、;；|｜"

    def __init__(self, config: TitleConfig = TitleConfig()) -> None:  # noqa: B008
        self.config = config
        self.noise = [*map(re.compile, config.patterns), _any_of(config.modifiers), _any_of(config.recruitment), _any_of(config.locations)]
        self.anchor = _any_of(config.anchors)
        self.synonyms = {re.sub(r"\s+", "", k).casefold(): v for k, v in config.synonyms.items()}

    def _clean(self, text: str) -> str:
        for p in self.noise:
            text = p.sub(" ", text)
        return " ".join(re.sub(r"[\s\-_—–/／|｜\\]+", " ", text).split()).strip(self._EDGE)

    def __call__(self, title: str | None) -> tuple[str, list[str]]:
        text, tags = (title or "").strip(), []
        while m := self._BRACKET.search(text):
            inside = next(g for g in m.groups() if g is not None)
            for piece in re.split(r"[,，、;；/|｜]", inside):
                cleaned = self._clean(piece)
                if cleaned and (self.config.keep_unknown or self._DIRECTION.fullmatch(cleaned)):
                    tags.append(cleaned)
            text = f"{text[: m.start()]} {text[m.end() :]}"
        words, name = self._clean(text).split(), []
        for word in words:
            ends = [m.end() for m in self.anchor.finditer(word)]
            rest = word[ends[-1] :] if ends else ""
            if rest not in ("", "方向", "领域") and self._DIRECTION.fullmatch(rest):
                name.append(word[: ends[-1]])
                tags.append(rest)
            elif len(words) > 1 and self._DIRECTION.fullmatch(word):
                tags.append(word)
            else:
                name.append(word)
        core = re.sub("(?:岗位|职位|招聘)$", "", " ".join(name)).strip()
        if not core:
            at = next((i for i, t in enumerate(tags) if self.anchor.search(t)), None)
            core = "" if at is None else tags.pop(at)
        seen: set[str] = set()
        unique = [t for t in tags if not (t.casefold() in seen or seen.add(t.casefold()))]
        return self.synonyms.get(re.sub(r"\s+", "", core).casefold(), core), unique


def title_udf(config: TitleConfig = TitleConfig()):  # noqa: B008
    """An Arrow UDF of ``TitleNormalizer``: a struct of ``name`` and ``tags``."""
    normalizer = TitleNormalizer(config)

    @F.pandas_udf(T.StructType([T.StructField("name", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))]))
    def normalized(titles: pd.Series) -> pd.DataFrame:
        known = {t: normalizer(t) for t in titles.unique()}
        return pd.DataFrame({"name": titles.map(lambda t: known[t][0]), "tags": titles.map(lambda t: known[t][1])})

    return normalized


#: How technical words are written in titles.
CASING = ("Java", "Python", "DataOps", "DevOps", "FAE", "AE", "NTN", "AI", "BI", "CAD", "CAE", "CAM", ".NET", "C++")


def display_title(key: Column) -> Column:
    """A clustering key as people write it."""
    out = strip(F.coalesce(key, F.lit("")))
    for word in CASING:
        out = F.regexp_replace(out, "(?i)" + re.escape(word), word)
    return F.substring(out, 1, 80)
