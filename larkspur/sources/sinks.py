"""Sinks: tables, graph files, per-role reports, manifests, redacted packages."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{root}/{name}")


def write_graph(nodes: dict[str, DataFrame], edges: dict[str, DataFrame], root: str) -> None:
    """A folder of CSV parts with headers for each label and relation."""
    for kind, tables in (("nodes", nodes), ("edges", edges)):
        for name, df in tables.items():
            df.write.mode("overwrite").option("header", True).csv(f"{root}/{kind}/{name}")


def import_script(nodes: dict[str, tuple[str, list[str]]], edges: dict[str, tuple[str, str, list[str]]]) -> str:
    """Cypher that loads ``write_graph``'s files: ``label: (key, columns)`` and ``relation: (from, to, columns)``."""
    lines = [f"CREATE CONSTRAINT IF NOT EXISTS FOR (n:{label}) REQUIRE n.{key} IS UNIQUE;" for label, (key, _) in nodes.items()]
    for label, (key, columns) in nodes.items():
        lines.append(f"LOAD CSV WITH HEADERS FROM 'file:///nodes/{label}.csv' AS r MERGE (n:{label} {{{key}: r.{key}}}) SET " + ", ".join(f"n.{c} = r.{c}" for c in columns) + ";")
    for relation, (left, right, columns) in edges.items():
        sets = " SET " + ", ".join(f"e.{c} = r.{c}" for c in columns) if columns else ""
        lines.append(f"LOAD CSV WITH HEADERS FROM 'file:///edges/{relation}.csv' AS r MATCH (a:{left} {{id: r.source}}), (b:{right} {{id: r.target}}) MERGE (a)-[e:{relation}]->(b){sets};")
    return "\n".join(lines) + "\n"


def write_reports(df: DataFrame, role: str, root: str) -> None:
    """One folder of CSV for each role."""
    df.repartition(role).write.mode("overwrite").partitionBy(role).option("header", True).csv(root)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def atomic_text(path: str, text: str) -> None:
    """Readers see the old content or the new."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(name, target)


def manifest(df: DataFrame, path: str) -> dict:
    """The single row of a summary as JSON."""
    row = df.limit(2).collect()
    if len(row) != 1:
        raise ValueError("a manifest has one row")
    atomic_text(path, json.dumps(row[0].asDict(), ensure_ascii=False, default=str, sort_keys=True))
    return row[0].asDict()


def append_column(df: DataFrame, name: str, value) -> DataFrame:
    """All rows and columns in their order, and one more column."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns), value.alias(name))


def escape_cell(value: object) -> str:
    return str("" if value is None else value).replace("|", r"\|").replace("\n", "<br>")


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A table of a bounded report as Markdown."""
    rows = df.limit(most).collect()
    head = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " - |" * len(df.columns)]
    return "\n".join([*head, *("| " + " | ".join(escape_cell(v) for v in r) + " |" for r in rows)]) + "\n"


def package(root: str, target: str, forbidden: tuple[str, ...] = ("raw_text", "description")) -> dict[str, str]:
    """Zips the files below ``root`` with a manifest of their SHA-256; raises if a CSV header holds a forbidden column."""
    found = {}
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(x for x in Path(root).rglob("*") if x.is_file() and not x.name.startswith((".", "_"))):
            if p.suffix == ".csv" and (bad := set(p.open(encoding="utf-8").readline().strip().split(",")) & set(forbidden)):
                raise ValueError(f"{p.name} holds {sorted(bad)}")
            name = str(p.relative_to(root))
            found[name] = hashlib.sha256(p.read_bytes()).hexdigest()
            z.write(p, name)
        z.writestr("manifest.json", json.dumps(found, sort_keys=True))
    return found


def verify_package(target: str) -> bool:
    with zipfile.ZipFile(target) as z:
        known = json.loads(z.read("manifest.json"))
        return all(hashlib.sha256(z.read(n)).hexdigest() == h for n, h in known.items()) and set(known) == set(z.namelist()) - {"manifest.json"}
