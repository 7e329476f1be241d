"""Files as tables: sources, catalogs, ground truth, vulnerability records, commit logs; report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Languages by extension, folders that are skipped.
LANGUAGES = {".py": "python", ".rs": "rust", ".js": "javascript", ".ts": "typescript", ".go": "go", ".sol": "solidity", ".c": "c", ".cpp": "cpp", ".wat": "wasm", ".java": "java"}
SKIPPED = r"/(\.[^/]+|node_modules|venv|__pycache__|target)/"


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """path, lang, content of the source files below path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ext = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    lang = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])[ext]
    return raw.filter(~F.col("path").rlike(SKIPPED)).select("path", lang.alias("lang"), F.decode("content", "UTF-8").alias("content")).filter("lang is not null")


def technique_csv(spark: SparkSession, path: str) -> DataFrame:
    """entry_id, tactic, label, definition; blanks trimmed, rows without an id dropped, of equal ids the last line counts."""
    raw = spark.read.option("header", True).option("multiLine", True).csv(path).withColumn("line", F.monotonically_increasing_id())
    label = F.coalesce(*[F.nullif(F.trim(f"`D3FEND Technique{s}`"), F.lit("")) for s in (" Level 1", " Level 0", "")], F.trim("ID"))
    rows = raw.select(F.trim("ID").alias("entry_id"), F.trim("`D3FEND Tactic`").alias("tactic"), label.alias("label"), F.trim("Definition").alias("definition"), "line").filter("entry_id <> ''")
    return rows.groupBy("entry_id").agg(F.max_by(F.struct("tactic", "label", "definition"), "line").alias("r")).select("entry_id", "r.*")


def control_json(spark: SparkSession, path: str) -> DataFrame:
    """control, relation, technique_id (after #), name, definition of result bindings; rows without control or technique dropped."""
    value = "struct<value:string>"
    schema = f"results struct<bindings:array<struct<Control:{value},Relation:{value},Defensive_Technique:{value},Technique:{value},CCI_Definition:{value}>>>"
    b = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("results.bindings").alias("b"))
    out = b.select(F.col("b.Control.value").alias("control"), F.col("b.Relation.value").alias("relation"), F.col("b.Defensive_Technique.value").alias("uri"), F.col("b.Technique.value").alias("name"), F.col("b.CCI_Definition.value").alias("definition"))
    return out.filter("control is not null and uri is not null").withColumn("technique_id", F.substring_index("uri", "#", -1)).drop("uri")


def ground_truth_json(spark: SparkSession, path: str, categories: list[str]) -> DataFrame:
    """vuln_id, category (other if unknown), cwe_id, location, lo, hi (both or neither)."""
    item = "struct<id:string,category:string,cwe_id:string,location:string,line_start:int,line_end:int>"
    v = spark.read.schema(f"vulnerabilities array<{item}>").option("multiLine", True).json(path).select(F.explode("vulnerabilities").alias("v")).select("v.*")
    both = F.col("line_start").isNotNull() & F.col("line_end").isNotNull()
    return v.select(F.col("id").alias("vuln_id"), F.when(F.col("category").isin(categories), F.col("category")).otherwise("other").alias("category"), "cwe_id", "location", F.when(both, F.col("line_start")).alias("lo"), F.when(both, F.col("line_end")).alias("hi"))


def vulnerability_json(spark: SparkSession, path: str) -> DataFrame:
    """cve_id (from the file's name), description, severity, language, pre, post."""
    schema = "description string, severity string, language string, patch struct<pre_patch:string,post_patch:string>"
    raw = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return raw.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("cve_id"), "description", "severity", "language", F.col("patch.pre_patch").alias("pre"), F.col("patch.post_patch").alias("post"))


def commit_log(spark: SparkSession, path: str) -> DataFrame:
    """hash|author|mail|date|subject lines; shorter ones are dropped, further bars belong to the subject."""
    parts = F.split("value", r"\|", 5)
    return spark.read.text(path).filter(F.size(parts) >= 5).select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(("commit_id", "author", "mail", "date", "message"))])


def ontology_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(technique_id, label, tactic, description) and (cwe_id, ordinal, technique_id) of an ontology; techniques without a tactic
    are ``unknown``. A file without one of its two parts gives an empty table."""
    technique = "struct<label:string,tactic:string,description:string>"
    raw = spark.read.schema(f"techniques map<string,{technique}>, cwe_mappings map<string,array<string>>").option("multiLine", True).json(path)
    techniques = raw.select(F.explode("techniques").alias("technique_id", "t")).select("technique_id", "t.label", F.coalesce("t.tactic", F.lit("unknown")).alias("tactic"), "t.description")
    mapped = raw.select(F.explode("cwe_mappings").alias("cwe_id", "t")).select("cwe_id", F.posexplode("t").alias("ordinal", "technique_id"))
    return techniques, mapped


def write_log(events: DataFrame, path: str) -> None:
    """One JSON object a line."""
    events.select(F.to_json(F.struct(*events.columns)).alias("value")).write.text(path)


def report(title: str, sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """ordinal, text: Markdown lines. A section is a heading and a frame (o, text) in the order of o."""
    out = None
    for i, (heading, lines) in enumerate(sections):
        head = lines.sparkSession.range(1).select(F.lit(i).alias("section"), F.lit("").alias("o"), F.lit(f"## {heading}").alias("text"))
        part = head.unionByName(lines.select(F.lit(i).alias("section"), F.concat(F.lit("-"), F.col("o").cast("string")).alias("o"), F.concat(F.lit("- "), "text").alias("text")))
        top = lines.sparkSession.range(1).select(F.lit(-1).alias("section"), F.lit("").alias("o"), F.lit(f"# {title}").alias("text"))
        out = top.unionByName(part) if out is None else out.unionByName(part)
    return out.select("section", "o", "text")
