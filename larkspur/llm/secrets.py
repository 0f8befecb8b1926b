"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text.  The ledger, a
Parquet folder, has one row for each blob and rule version that has been scanned, with
its findings.  A scan looks only at blobs that the ledger lacks under the present rule
version, appends them, and joins the findings back to all paths that hold the blob.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import BROADCAST_IDS, salted_join, shuffle_partitions, sub_batches, text_or_empty
from larkspur.llm.spans import SPANS_ARROW, SPANS_SQL, Span, ordered, spans_array


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The contract's three kinds, and well-known token formats.
BASE_RULES = (
    Rule("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # shorter runs can't pass, and runs don't overlap
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_password", r"://[A-Za-z0-9._%+-]+:[^\s/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES
BASE_KINDS = tuple(r.kind for r in BASE_RULES)


def rule_version(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def find(text: str, rules: tuple[Rule, ...] = RULES) -> list[Span]:
    """All findings of a text, by start, then by the order of the rules."""
    out = []
    for r in rules:
        for m in re.finditer(r.pattern, text):
            if len(m[r.group]) >= r.least:
                out.append((r.kind, m.start(), m.end()))
    return ordered(out, [r.kind for r in rules])


def read_ledger(spark: SparkSession, ledger: str, version: str) -> DataFrame | None:
    """Rows ``blob, spans`` of a rule version; None while there is no ledger."""
    try:
        found = spark.read.schema(f"blob binary, spans {SPANS_SQL}, rule_version string").parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.where(F.col("rule_version") == version).select("blob", "spans")


def scan(versions: DataFrame, ledger: str, *, keys: tuple[str, ...] = ("doc_id",), text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of every row of ``versions``: the ``keys``, ``blob`` and ``spans`` (empty without any).

    Null text counts as empty and has no findings.  Rows that repeat, also with the
    same or with null keys, each get a row.  An empty table gives an empty result.
    Columns that are not named are not read.  A run that fails appends nothing to the
    ledger; one at a time may append.
    """
    spark, version = versions.sparkSession, rule_version(rules)
    blob = F.unhex(F.sha2(text_or_empty(text_column), 256)).alias("blob")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A blob once for each task, packed for the shuffle."""
        seen: set[bytes] = set()
        for batch in batches:
            for part in sub_batches(batch, "text"):
                new = {}
                for key, text in zip(part.column("blob").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if key not in seen:
                        seen.add(key)
                        new[key] = zlib.compress(text.encode(), 1)
                yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), pa.array(list(new.values()), pa.binary())], names=["blob", "packed"])

    def findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            blobs, rows = [], []
            for key, packed in zip(batch.column("blob").to_pylist(), batch.column("packed"), strict=True):
                if key not in seen:
                    seen.add(key)
                    blobs.append(key)
                    rows.append(find(zlib.decompress(packed.as_buffer()).decode(), rules))
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), spans_array(rows).cast(SPANS_ARROW)], names=["blob", "spans"])

    blobs = versions.select(blob, text_or_empty(text_column).alias("text")).mapInArrow(once, "blob binary, packed binary")
    known = read_ledger(spark, ledger, version)
    if known is not None:
        blobs = blobs.join(known, "blob", "left_anti")
    new = blobs.repartition(shuffle_partitions(spark), "blob").mapInArrow(findings, f"blob binary, spans {SPANS_SQL}")
    new.withColumn("rule_version", F.lit(version)).write.mode("append").partitionBy("rule_version").parquet(ledger)
    paths = versions.select(*keys, blob)
    found = read_ledger(spark, ledger, version).where(F.size("spans") > 0)
    # Copies of one blob may be many paths: few findings are broadcast, else its paths are dealt out.
    few = (found.agg(F.sum(F.size("spans") + 1)).first()[0] or 0) <= BROADCAST_IDS
    joined = paths.join(F.broadcast(found), "blob", "left") if few else salted_join(paths, found, ["blob"], "left")
    return joined.select(*keys, "blob", F.coalesce("spans", F.array().cast(SPANS_SQL)).alias("spans"))
