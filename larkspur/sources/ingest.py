"""Sources: posting files of any layout as one table of canonical fields."""

from __future__ import annotations

import codecs
import re
from fnmatch import translate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions.text import clean_value, parse_datetime, stable_hash

#: Header aliases of the canonical fields.
ALIASES: dict[str, tuple[str, ...]] = {
    "job_id": ("职位ID", "jobID", "job_id", "jobId", "position_id", "positionId", "id"),
    "company_id": ("companyID", "company_id", "companyId"),
    "title": ("原始职位名称", "职位名称", "job_name", "job_title", "title", "position_name"),
    "normalized_role": ("岗位名称", "归一化岗位名称", "normalized_role", "canonical_role"),
    "declared_role": ("岗位关键词", "declared_role", "source_role", "source_job_category"),
    "description": ("JD全文", "职位描述", "jd", "job_description", "description", "content"),
    "salary_max": ("最高工资", "salary_max", "max_salary"),
    "salary_min": ("最低工资", "salary_min", "min_salary"),
    "salary": ("薪水", "salary", "salary_text"),
    "location": ("工作地区", "location", "city", "work_location"),
    "city": ("城市", "job_city"),
    "tags": ("职位标签", "tags", "tags_list", "job_tags"),
    "company": ("公司全称", "company", "company_name"),
    "company_type": ("公司类型", "company_type"),
    "company_size": ("公司规模", "company_size"),
    "company_qualification": ("公司资历", "company_qualification"),
    "industry": ("公司行业", "行业类型", "industry", "industry_name"),
    "province": ("省份", "province"),
    "education": ("学历要求", "education", "education_requirement"),
    "experience": ("工作经验", "经验要求", "experience", "experience_requirement"),
    "posted_at": ("发布日期", "时间", "publish_time", "posted_at", "publishDate", "update_time"),
    "collected_at": ("采集时间", "collected_at", "crawled_at", "scraped_at"),
    "ability": ("能力提取结果", "能力分析结果", "ability_analysis", "analysis_result", "extracted_abilities"),
    "url": ("职位详情链接", "job_link", "link", "url", "job_url"),
    "search_city": ("搜索城市", "search_city"),
    "keyword": ("搜索关键词", "search_keyword"),
    "skill_tags": ("skill_tags", "skills"),
    "source": ("source_platform", "platform", "source", "site"),
}
#: The fields whose change makes a new version.
VERSIONED = ("title", "description", "company_id", "company", "company_type", "company_size", "company_qualification", "industry", "province", "city", "location", "education", "experience", "salary", "salary_min", "salary_max", "tags", "posted_at", "skill_tags")
#: Names beyond those, which come after them.
FURTHER: dict[str, tuple[str, ...]] = {"company": ("公司名称",), "education": ("学历",), "salary": ("薪资",), "location": ("工作地点",), "source": ("来源",), "ability": ("ability",)}
ENVELOPES = ("data", "jobs", "items", "results", "list")


def encoding_of(head: bytes) -> str:
    """From a byte-order mark, else the first of UTF-8 and GB18030 that decodes the bytes (a cut last character aside)."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")):
        if head.startswith(mark):
            return name
    for name in ("utf-8", "gb18030"):
        try:
            codecs.getincrementaldecoder(name)().decode(head)
            return name
        except UnicodeDecodeError:
            continue
    return "utf-8"


def discover(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".csv", ".json", ".jsonl"), include: str = "*") -> DataFrame:
    """``path, size, modified, signature, encoding`` of the files below ``root``, by Spark's own file listing.

    Temporary files go; the encoding is told on the executors from the first 8 KB of what
    Spark's reader of binary files loads, so a file must fit into a task.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.where(~name.startswith("~$") & ~name.startswith(".") & F.lower(name).rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"))

    @F.pandas_udf("string")
    def told(heads: pd.Series) -> pd.Series:
        return heads.map(lambda b: encoding_of(bytes(b)))

    modified = F.unix_millis("modificationTime")
    return kept.where(name.rlike(f"^{translate(include)}")).select("path", F.col("length").alias("size"), modified.alias("modified"), F.concat_ws(":", "length", modified).alias("signature"), told(F.substring("content", 1, 8192)).alias("encoding"))


def read_csv(spark: SparkSession, paths: list[str], encoding: str = "utf-8") -> DataFrame:
    """All columns as strings, with the file and its time.

    Encodings beyond Unicode and Latin-1 need ``spark.sql.legacy.javaCharsets``, which
    ``larkspur.session`` sets.
    """
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding).csv(paths)
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("file_time"))


def read_json(spark: SparkSession, paths: list[str], lines: bool = False) -> DataFrame:
    """Records of JSON lines, or of files that hold an array, an object, or an envelope around an array."""
    df = spark.read.option("multiLine", not lines).json(paths)
    kinds = dict(df.dtypes)
    wrapped = next((e for e in ENVELOPES if kinds.get(e, "").startswith("array<struct")), None)
    meta = (F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("file_time"))
    if wrapped:
        return df.select(F.explode(wrapped).alias("_r"), *meta).select("_r.*", "source_file", "file_time")
    return df.select("*", *meta)


def canonical(df: DataFrame, aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """The canonical fields, cleaned, and all other columns as JSON in ``extra_json``; fields without a column are empty.

    The first alias that holds a value wins, in the order of the table; headers are compared
    by ``folded``, and of headers that fold to one the last counts.
    """
    aliases = aliases or {f: names + FURTHER.get(f, ()) for f, names in ALIASES.items()}
    present = {folded(c): c for c in df.columns}
    used: set[str] = {"source_file", "file_time"}
    out: list[Column] = []
    for field, names in aliases.items():
        found = list(dict.fromkeys(present[folded(n)] for n in names if folded(n) in present))
        used.update(found)
        values = [F.nullif(clean_value(F.col(f"`{c}`")), F.lit("")) for c in found]
        out.append(F.coalesce(*values, F.lit("")).alias(field))
    rest = [c for c in df.columns if c not in used]
    pairs = F.map_filter(F.map_from_arrays(F.array(*(F.lit(c) for c in rest)), F.array(*(clean_value(F.col(f"`{c}`")) for c in rest))), lambda _, v: v != "") if rest else None
    extra = F.to_json(pairs) if rest else F.lit("{}")
    keep = [c for c in ("source_file", "file_time") if c in df.columns]
    return df.select(*out, extra.alias("extra_json"), *keep)


def folded(name: str) -> str:
    """A header without marks, white space, underscores, hyphens and case."""
    return re.sub(r"[\s_\-]+", "", name.replace("\ufeff", "")).lower()


def with_identity(df: DataFrame, namespace: str = "", default_platform: str = "unknown", business: tuple[str, ...] = VERSIONED) -> DataFrame:
    """``platform``, ``raw_uid``, ``version_id`` and ``observed_epoch`` of canonical rows.

    The platform is explicit, or told by the path, or the default; the version is of the
    business fields alone; the time is the collection's, the posting's or the file's.
    """
    path = F.lower(F.coalesce("source_file", F.lit(""))) if "source_file" in df.columns else F.lit("")
    told = F.when(path.contains("liepin"), "liepin").when(path.contains("boss"), "boss").when(path.contains("51job"), "51job").when(path.contains("lagou"), "lagou")
    platform = F.coalesce(F.nullif("source", F.lit("")), told, F.lit(default_platform))
    key = F.coalesce(F.nullif("job_id", F.lit("")), F.nullif("url", F.lit("")), F.concat_ws("|", "company", "title", "location"))
    uid = stable_hash(F.concat_ws("\x1f", F.lit(namespace), "platform", key), 40)
    version = F.sha2(F.concat_ws("\x1f", *sorted(business)), 256)
    seconds = lambda c: F.unix_timestamp(parse_datetime(F.col(c)).cast("timestamp"))
    observed = F.coalesce(seconds("collected_at"), seconds("posted_at"), F.unix_timestamp("file_time") if "file_time" in df.columns else F.lit(None).cast("long"))
    return df.withColumn("platform", platform).withColumn("raw_uid", uid).withColumn("version_id", F.concat("raw_uid", F.lit(":"), F.substring(version, 1, 32))).withColumn("observed_epoch", observed)


def usable(df: DataFrame) -> DataFrame:
    """Rows with a title or a description."""
    return df.where("coalesce(title, '') != '' or coalesce(description, '') != ''")


def ranked_sample(df: DataFrame, file: str, score: Column, index: str, most: int) -> DataFrame:
    """The ``most`` best rows of each file, in the file's order.  A sampling operator."""
    w = Window.partitionBy(file).orderBy(score.desc(), index)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n").orderBy(file, index)


def preflight(df: DataFrame) -> DataFrame:
    """Rows, rows without title and text, and a sample title for each file."""
    empty = F.count(F.when((F.col("title") == "") & (F.col("description") == ""), 1))
    return df.groupBy("source_file").agg(F.count("*").alias("rows"), empty.alias("unusable"), F.min(F.nullif("title", F.lit(""))).alias("sample_title"))


def has_columns(df: DataFrame, required: tuple[str, ...], optional: dict[str, object]) -> DataFrame:
    """``df`` with constants for absent optional columns; raises if a required one is absent."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    for name, value in optional.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df
