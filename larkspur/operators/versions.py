"""Versioned raw records, snapshots with a pointer, retention."""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def content_hash(columns: list[str]) -> Column:
    """Of business fields alone, so that crawl metadata makes no new version."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def distinct_versions(observed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row for each key and content: first and last time seen, and how often."""
    rows = observed.withColumn("version_hash", content_hash(columns))
    return rows.groupBy(key, "version_hash").agg(F.min("observed_epoch").alias("first_seen"), F.max("observed_epoch").alias("last_seen"), F.count("*").alias("observations"))


def current(observed: DataFrame, key: str) -> DataFrame:
    """The version each key points at: the newest; of equal times the later arrival."""
    row = F.max_by(F.struct(*(F.col(c) for c in observed.columns)), F.struct("observed_epoch", "seq")).alias("_row")
    return observed.groupBy(F.col(key).alias("_key")).agg(row).where(F.col("_key").isNotNull()).select("_row.*")


def late(observed: DataFrame, key: str) -> DataFrame:
    """Observations that arrived after a newer one: kept as history, never current."""
    w = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return observed.withColumn("_top", F.max("observed_epoch").over(w)).where(F.col("observed_epoch") < F.col("_top")).drop("_top")


def unchanged(files: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("path", "signature")) -> DataFrame:
    """Files that no completed run has seen in this state."""
    return files.join(done.select(*keys).distinct(), list(keys), "left_anti")


def merged(table: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Upsert: of all rows of a key, old and new, the last by ``order``."""
    both = table.unionByName(updates)
    w = Window.partitionBy(key).orderBy(*(F.col(c).desc() for c in order))
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def replaced(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """All rows of the updated keys replaced by theirs."""
    return table.join(updates.select(key).distinct(), key, "left_anti").unionByName(updates)


def retained(rows: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(keep.select(*keys).distinct(), keys, "left_semi")


def orphans(dimension: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a dimension that no fact uses."""
    return dimension.join(facts.select(*keys).distinct(), keys, "left_anti")


def fingerprint(df: DataFrame) -> str:
    """Of the content, whatever the order of rows and columns: equal tables have equal fingerprints."""
    row = df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{sorted(df.columns)}:{row[0]}:{row[1]}".encode()).hexdigest()


def problems(tables: dict[str, DataFrame], unique: dict[str, list[str]], references: list[tuple[str, str, str, str]], floors: dict[str, Column]) -> DataFrame:
    """``problem, n`` of a snapshot: repeated keys, references without a target, rows under a floor.

    ``references`` are ``(table, column, target, column)``; ``floors`` say what rows of a table must hold.
    """
    out = []
    for name, keys in sorted(unique.items()):
        out.append(tables[name].groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").agg(F.count("*").alias("n")).select(F.lit(f"repeated:{name}").alias("problem"), "n"))
    for name, column, target, key in references:
        lost = tables[name].where(F.col(column).isNotNull()).join(tables[target].select(F.col(key).alias(column)).distinct(), column, "left_anti")
        out.append(lost.agg(F.count("*").alias("n")).select(F.lit(f"unknown:{name}.{column}").alias("problem"), "n"))
    for name, rule in sorted(floors.items()):
        out.append(tables[name].where(~F.coalesce(rule, F.lit(False))).agg(F.count("*").alias("n")).select(F.lit(f"floor:{name}").alias("problem"), "n"))
    return reduce(DataFrame.union, out)


def backfilled(table: DataFrame, values: DataFrame, key: str, column: str, locked: Column | None = None) -> DataFrame:
    """``table`` with ``column`` filled from ``values`` and the old value kept as ``<column>_before``; locked rows stay as they are."""
    new = values.select(key, F.col(column).alias("_new"))
    free = F.lit(True) if locked is None else ~F.coalesce(locked, F.lit(False))
    rows = table.join(new, key, "left").withColumn(f"{column}_before", F.col(column))
    return rows.withColumn(column, F.when(free & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(column))).drop("_new")


class SnapshotStore:
    """Tables by run below a folder that Spark can write; readers follow the last entry of a log of pointers.

    A run is named by its content and its attempt, so no file that a reader may hold is
    written again; publishing the active content is nothing.

    A run is staged, the rows that are read back are counted against those written, and
    only then is the pointer moved, by one committed write; so readers see the old run
    or the new one.  An entry of the log is never overwritten: of two writers that saw
    the same entry, the second fails.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    @staticmethod
    def run_id(tables: dict[str, DataFrame]) -> str:
        digest = hashlib.sha256("".join(f"{name}:{fingerprint(df)};" for name, df in sorted(tables.items())).encode())
        return digest.hexdigest()[:20]

    def stage(self, tables: dict[str, DataFrame]) -> str:
        run = f"{self.run_id(tables)}-{uuid.uuid4().hex[:8]}"
        for name, df in tables.items():
            path, seen = f"{self.root}/run={run}/{name}", Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
            if self.spark.read.schema(df.schema).parquet(path).count() != seen.get["rows"]:
                raise RuntimeError(f"{name}: not all rows were staged")
        return run

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("active string, history array<string>, version long").json(f"{self.root}/pointer")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def status(self) -> dict:
        log = self._log()
        row = None if log is None else log.orderBy(F.desc("version")).first()
        return {"version": 0, "active": None, "history": []} if row is None else {"version": row.version, "active": row.active, "history": list(row.history or [])}

    def publish(self, tables: dict[str, DataFrame], expected_version: int | None = None) -> str:
        """Stages and points.  With ``expected_version``, fails if the pointer has moved since."""
        now = self.status()
        if expected_version is not None and now["version"] != expected_version:
            raise RuntimeError(f"version {now['version']} instead of {expected_version}")
        if (now["active"] or "").startswith(f"{self.run_id(tables)}-"):
            return now["active"]
        run = self.stage(tables)
        self._point(now, run, [*now["history"], now["active"]] if now["active"] else now["history"])
        return run

    def _point(self, now: dict, run: str | None, history: list[str]) -> None:
        version = now["version"] + 1
        row = self.spark.createDataFrame([(run, history)], "active string, history array<string>")
        row.coalesce(1).write.mode("errorifexists").json(f"{self.root}/pointer/version={version}")

    def rollback(self) -> str:
        """To the run before; raises without one."""
        now = self.status()
        if not now["history"]:
            raise RuntimeError("no earlier run")
        self._point(now, now["history"][-1], now["history"][:-1])
        return now["history"][-1]

    def deactivate(self) -> None:
        now = self.status()
        self._point(now, None, [*now["history"], now["active"]] if now["active"] else now["history"])

    def read(self, name: str) -> DataFrame:
        run = self.status()["active"]
        if run is None:
            raise RuntimeError("no active run")
        return self.spark.read.parquet(f"{self.root}/run={run}/{name}")
