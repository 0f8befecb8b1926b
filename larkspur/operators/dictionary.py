"""Aliases of a dictionary in texts, whatever the size of either.

``occurrences`` is the primitive: where each alias first occurs in each text.  A dictionary
within ``MOST_CHARS`` becomes one automaton, which a worker builds once and runs over a text
in one pass; a larger one is joined with the texts by hashed grams, and no machine holds it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import normalize_text
from larkspur.session import written

#: Characters of all aliases of an automaton (about 100 bytes each in a worker).
MOST_CHARS = 400_000
#: Characters of a gram by which a larger dictionary meets the texts.
GRAM = 4
_WORD = re.compile(r"[A-Za-z0-9+#]")
_BEYOND_ASCII = r"[^\x00-\x7F]"


def simple_lower(text: str) -> str:
    """Lower case of as many characters: those whose lower case is longer stay as they are."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


@F.pandas_udf(T.StringType())
def lowered(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else simple_lower(t))


class Matcher:
    """An automaton over lower-case aliases; with ``whole_words``, ASCII ones count between other characters than word ones alone."""

    def __init__(self, aliases: tuple[str, ...], whole_words: bool = True) -> None:
        import ahocorasick

        self.automaton, self.whole = ahocorasick.Automaton(), whole_words
        for alias in aliases:
            if alias:
                self.automaton.add_word(alias, (alias, whole_words and alias.isascii()))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def first(self, text: str) -> dict[str, int]:
        """The first place of each alias in ``text``."""
        found: dict[str, int] = {}
        if not self.empty:
            for end, (alias, whole) in self.automaton.iter(simple_lower(text)):
                at = end + 1 - len(alias)
                if alias not in found and not (whole and _within_word(text, at, end + 1)):
                    found[alias] = at
        return found


def _within_word(text: str, start: int, end: int) -> bool:
    return bool((start and _WORD.match(text, start - 1)) or _WORD.match(text, end))


@lru_cache(maxsize=4)
def matcher(aliases: tuple[str, ...], whole_words: bool = True) -> Matcher:
    """One per worker and dictionary."""
    return Matcher(aliases, whole_words)


def occurrences(texts: DataFrame, key: str, text: str, dictionary: DataFrame, alias: str, *, whole_words: bool = True, most_chars: int = MOST_CHARS) -> DataFrame:
    """``key, alias, at, raw``: each alias (in lower case) with its first place in each text, from 0, and how it is written there.

    Case doesn't count.  With ``whole_words`` an ASCII alias counts only where no ASCII
    letter, digit, plus or hash stands beside it.  Null and empty texts and aliases match
    nothing; rows of ``texts`` that share a key are one text each.
    """
    words = written(dictionary.where(F.length(alias) > 0).select(lowered(F.col(alias)).alias("alias")).distinct(), "aliases")
    size = words.agg(F.coalesce(F.sum(F.length("alias")), F.lit(0)), F.max(F.length("alias")), F.bool_and(~F.col("alias").rlike(_BEYOND_ASCII))).first()
    rows = texts.where(F.length(text) > 0).select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    if size[0] <= most_chars:
        known = rows.sparkSession.sparkContext.broadcast(tuple(r.alias for r in words.collect()))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m = matcher(known.value, whole_words)
            for pdf in batches:
                found = [(k, a, at, t[at : at + len(a)]) for k, t in zip(pdf["key"], pdf["text"], strict=True) for a, at in m.first(t).items()]
                yield pd.DataFrame(found, columns=["key", "alias", "at", "raw"])

        return rows.mapInPandas(run, f"key {kind}, alias string, at int, raw string").withColumnRenamed("key", key)
    return _joined(rows, kind, words, size[1], whole_words, bool(size[2])).withColumnRenamed("key", key)


def _joined(rows: DataFrame, kind: str, words: DataFrame, longest: int, whole_words: bool, ascii_only: bool) -> DataFrame:
    """``occurrences`` by joins: places whose gram begins an alias, then those whose text of an alias' length is one.

    Each gram has the lengths of its aliases, not the aliases, so a place meets as many rows as there are such lengths.
    """
    starts_only = whole_words and ascii_only

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, (k, t) in enumerate(zip(pdf["key"], pdf["text"], strict=True)):
                low, out = simple_lower(t), []
                for at in range(len(t)):
                    starts = not (at and _WORD.match(t, at - 1))
                    if starts or not starts_only:
                        out.append((k, pdf["row"].iloc[i], at, starts, low[at : at + GRAM], low[at : at + longest + 1], t[at : at + longest]))
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=["key", "row", "at", "starts", "gram", "window", "raw"])
                        out = []
                yield pd.DataFrame(out, columns=["key", "row", "at", "starts", "gram", "window", "raw"])

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    placed = numbered.mapInPandas(places, f"key {kind}, row long, at int, starts boolean, gram string, window string, raw string")
    sizes = words.select(F.length("alias").alias("n"), F.substring("alias", 1, GRAM).alias("gram")).groupBy("gram").agg(F.collect_set("n").alias("lengths"))
    short = F.explode(F.expr(f"transform(sequence(1, least({GRAM}, length(gram))), k -> substring(gram, 1, k))"))  # an alias may be shorter than a gram
    near = placed.withColumn("gram", short).join(sizes, "gram").withColumn("n", F.explode("lengths")).where(F.length("gram") == F.least(F.lit(GRAM), F.col("n")))
    hit = near.where(F.length("window") >= F.col("n")).withColumn("alias", F.substring("window", F.lit(1), F.col("n"))).join(words, "alias")
    plain = ~F.col("alias").rlike(_BEYOND_ASCII)
    ends = ~F.substring("window", F.col("n") + 1, F.lit(1)).rlike("[A-Za-z0-9+#]")
    good = (~plain | (F.col("starts") & ends)) if whole_words else F.lit(True)
    first = hit.where(good).groupBy("key", "row", "alias").agg(F.min(F.struct("at", F.substring("raw", F.lit(1), F.col("n")).alias("raw"))).alias("f"))
    return first.select("key", "alias", "f.at", "f.raw")


def resolved_phrases(phrases: DataFrame, phrase: str, registry: DataFrame, name: str, alias: str, *, least: float = 0.5, most_chars: int = MOST_CHARS) -> DataFrame:
    """``phrase, name, alias, coverage`` of each distinct phrase: the registry entry that it stands for, or nulls.

    A phrase that equals an alias, both normalized, stands for its entry, with a coverage of 1.
    Otherwise each entry is judged by its longest alias within the phrase (of equally long
    ones the first), and the one whose alias covers most of the phrase's normalized
    characters counts, if it covers ``least`` of them; of equals that with the longer alias,
    then the first name.
    """
    own = phrases.where(F.col(phrase).isNotNull()).select(F.col(phrase).alias("phrase")).distinct()
    known = written(registry.where(F.length(alias) > 0).select(F.col(name).alias("name"), F.col(alias).alias("as_given"), lowered(F.col(alias)).alias("alias")), "registry")
    exact = own.withColumn("_n", normalize_text(F.col("phrase"))).where(F.length("_n") > 0).join(known.withColumn("_n", normalize_text(F.col("alias"))), "_n")
    exact = exact.groupBy("phrase").agg(F.min(F.struct("name", "alias")).alias("e"))
    found = occurrences(own.join(exact, "phrase", "left_anti").withColumn("_text", F.col("phrase")), "phrase", "_text", known, "alias", most_chars=most_chars)
    each = found.join(known.select("name", "alias").distinct(), "alias").groupBy("phrase", "name").agg(F.min_by(F.struct("alias", "raw"), F.struct(-F.length("alias"), F.col("alias"))).alias("a"))
    size = F.length(normalize_text(F.col("a.raw")))
    judged = each.select("phrase", "name", F.col("a.alias").alias("alias"), size.alias("n"), (size / F.greatest(F.lit(1), F.length(normalize_text(F.col("phrase"))))).alias("coverage")).where(F.col("coverage") >= least)
    best = judged.groupBy("phrase").agg(F.min_by(F.struct("name", "alias", "coverage"), F.struct(-F.col("coverage"), -F.col("n"), F.col("name"))).alias("b"))
    out = own.join(exact, "phrase", "left").join(best, "phrase", "left")
    return out.select(F.col("phrase").alias(phrase), F.coalesce("e.name", "b.name").alias("name"), F.coalesce("e.alias", "b.alias").alias("alias"), F.when(F.col("e.name").isNotNull(), 1.0).otherwise(F.col("b.coverage")).alias("coverage"))


def longest_contained(titles: DataFrame, title: str, dictionary: DataFrame, alias: str, name: str, least: int = 4, most_chars: int = MOST_CHARS) -> DataFrame:
    """``titles`` with the name of the longest alias, of ``least`` characters at least, within the title, else null; of equally long ones the last.

    Case doesn't count, and an alias may stand within a word.
    """
    words = written(dictionary.where(F.length(alias) >= least).select(lowered(F.col(alias)).alias("alias"), F.col(name).alias("_name")), "dictionary")
    own = titles.where(F.col(title).isNotNull()).select(F.col(title).alias("title")).distinct().withColumn("_text", F.col("title"))
    found = occurrences(own, "title", "_text", words, "alias", whole_words=False, most_chars=most_chars)
    longest = found.groupBy("title").agg(F.max_by("alias", F.struct(F.length("alias"), F.col("alias"))).alias("alias"))
    named = longest.join(words.groupBy("alias").agg(F.min("_name").alias("_name")), "alias").select(F.col("title").alias(title), F.col("_name").alias(name))
    return titles.join(named, title, "left")


def normalized_place(texts: pd.Series, terms: pd.Series) -> pd.Series:
    """Where in each text, from 0, the first match of the term begins when both are normalized as ``normalize_text`` does; null without one.

    The normalized text is kept with the place of each of its characters.  Terms of fewer than two normalized characters match nothing.
    """
    out = []
    for text, term in zip(texts, terms, strict=True):
        needle = "".join(_KEPT.findall((term or "").lower()))
        low = simple_lower(text or "")
        places = [m.start() for m in _KEPT.finditer(low)] if len(needle) > 1 else []
        at = "".join(low[p] for p in places).find(needle) if places else -1
        out.append(places[at] if at >= 0 else None)
    return pd.Series(out, dtype="Int32")


_KEPT = re.compile("[0-9a-z一-鿿+#.]")
#: ``normalized_place`` as a function of columns.
place_of = F.pandas_udf(normalized_place, T.IntegerType())

