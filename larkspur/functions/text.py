"""Text, identity and date expressions: Column builders that stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings that mean "missing".
BLANKS = ("", "nan", "none", "null", "n/a", "-")
_SPACE = r"[\s\u0085   -     　]"


def strip(x: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(x, f"^{_SPACE}+|{_SPACE}+$", "")


def clean_value(x: Column) -> Column:
    """Trimmed, without byte-order marks; null and blank tokens become empty."""
    out = strip(F.translate(F.coalesce(x.cast("string"), F.lit("")), "﻿", ""))
    return F.when(F.lower(out).isin(*BLANKS), "").otherwise(out)


_LOOSE = _SPACE[:-1] + "\ufeff]*+"
#: A text that ``clean_value`` makes empty, in one look at its head: the groups keep what they have taken.
_BLANK = f"^{_LOOSE}(?:" + "|".join("\ufeff*".join(f"[{c}{c.upper()}]" if c.isalpha() else re.escape(c) for c in b) for b in BLANKS if b) + f")?+{_LOOSE}\\z"


#: Runs of the characters that normalization takes out of lower-cased texts; no more than a class of code points, alike in Java and Python.
OTHERS = "[^0-9a-z一-鿿+#.]+"


def lowered(x: Column) -> Column:
    """Lower case; empty if ``clean_value`` is."""
    t = F.coalesce(x.cast("string"), F.lit(""))
    return F.when(t.rlike(_BLANK), "").otherwise(F.lower(t))


def normalize_text(x: Column) -> Column:
    """Lower case; only ASCII letters and digits, CJK ideographs, plus, hash and full stop; empty if ``clean_value`` is.

    What that trims goes with the other characters, so a text is gone through once, by runs.
    """
    return F.regexp_replace(lowered(x), OTHERS, "")


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, which is computed once however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]


def stable_id(prefix: str, *parts: Column, length: int = 16) -> Column:
    """Identity of a graph entity: ``prefix:`` and the head of a SHA-1 over the cleaned parts."""
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha1(F.concat_ws("|", *(clean_value(p) for p in parts))), 1, length))


def evolution_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256), 1, 20)


def stable_hash(x: Column, length: int = 40) -> Column:
    return F.substring(F.sha2(F.coalesce(x.cast("string"), F.lit("")), 256), 1, length)


def text_hash(company: Column, role: Column, text: Column) -> Column:
    return F.sha2(F.concat_ws("|", normalize_text(company), normalize_text(role), normalize_text(text)), 256)


def template_hash(x: Column) -> Column:
    """Equal for texts that differ in white space and numbers only."""
    return F.sha2(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\s+", ""), "[0-9]+", "#"), 256)


def shingles(x: Column, width: int = 3) -> Column:
    """Character n-grams of the whole normalized text; a shorter text is its own single gram."""
    # Bound to a name, as Spark would normalize the text for each use of it anew.  A match of no
    # width at each place gives all grams in one pass; the text has no line ends.
    grams = lambda t: F.when(F.length(t) == 0, F.array().cast("array<string>")).when(F.length(t) <= width, F.array(t)).otherwise(F.regexp_extract_all(t, F.lit(f"(?=(.{{{width}}}))"), F.lit(1)))
    return bound(normalize_text(x), grams)


def hamming_similarity(a: Column, b: Column) -> Column:
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def simhash_bands(x: Column, bits: int = 16) -> Column:
    """The 64-bit hash cut into bands of ``bits``, lowest first."""
    return F.array(*(F.shiftrightunsigned(x, o).bitwiseAND((1 << bits) - 1) for o in range(0, 64, bits)))


def surface_form(x: Column) -> Column:
    """Without leading degree words, trailing ability words and bracketed remarks."""
    out = F.regexp_replace(clean_value(x), "[（(][^（）()]*[）)]", "")
    out = F.regexp_replace(out, "^(?:熟练掌握|熟悉|精通|掌握|了解|具备|具有|良好的|较强的|优秀的|熟练使用|熟练)+", "")
    return strip(F.regexp_replace(out, "(?:能力|经验|相关经验|技能|技术|知识)$", ""))


def infer_level(title: Column, experience: Column, description: Column) -> Column:
    """Seniority by ordered rules.  Years, where named, decide by their minimum."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in (title, experience)), F.substring(F.coalesce(description, F.lit("")), 1, 600)))
    years = F.array_min(F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)\s*年"), F.lit(1)), lambda y: y.cast("int")))
    # The words of each level, in order of precedence.
    return (
        F.when(text.rlike("实习|intern|应届|校招|在校"), "实习/应届")
        .when(text.rlike("总监|负责人|经理岗|主管|团队管理|部门管理|技术经理|研发经理"), "管理岗")
        .when(text.rlike("专家|资深|架构师|首席|principal|staff"), "专家")
        .when(text.rlike("高级|senior|5年以上|5-10年|8年以上|十年以上"), "高级")
        .when(years >= 5, "高级")
        .when(years >= 3, "中级")
        .when(years.isNotNull(), "初级")
        .when(text.rlike("初级|助理|专员"), "初级")
        .when(text.rlike("中级"), "中级")
        .otherwise("未注明")
    )


def first_rule(x: Column, rules: list[tuple[str, str]], otherwise: Column) -> Column:
    """The name of the first pattern that occurs in ``x``."""
    out = otherwise
    for pattern, name in reversed(rules):
        out = F.when(x.rlike(pattern), name).otherwise(out)
    return out


def parse_datetime(x: Column) -> Column:
    """Dates with dashes, slashes or 年月日, with or without a time; else null."""
    t = clean_value(x)
    for mark, by in (("/", "-"), ("年", "-"), ("月", "-"), ("日", " "), ("T", " ")):
        t = F.replace(t, F.lit(mark), F.lit(by))
    t = strip(F.regexp_replace(t, r"Z$|\.\d+$", ""))
    patterns = ("yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d", "yyyy-M")
    return F.coalesce(*(F.try_to_timestamp(t, F.lit(p)) for p in patterns)).cast("timestamp_ntz")


def quarter_label(x: Column) -> Column:
    return F.concat(F.year(x).cast("string"), F.lit("Q"), F.quarter(x).cast("string"))


def quarter_start(x: Column) -> Column:
    return F.date_format(F.trunc(x, "quarter"), "yyyy-MM-dd")


def month_label(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM")


def month_index(month: Column) -> Column:
    """Months since year 0 of a ``yyyy-MM`` label: consecutive months differ by one."""
    return (F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")).cast("long")


def time_decay(at: Column, reference: Column, half_life_months: float) -> Column:
    """Half-life decay by age in months of 30.4375 days; future and missing dates weigh 1."""
    days = F.greatest(F.lit(0.0), (F.unix_timestamp(reference.cast("timestamp")) - F.unix_timestamp(at.cast("timestamp"))) / F.lit(86400.0))
    return F.when(at.isNull(), 1.0).otherwise(F.pow(F.lit(0.5), days / 30.4375 / max(half_life_months, 0.1)))
