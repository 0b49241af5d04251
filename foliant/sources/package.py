"""The content package: fourteen tables with keys, references and required columns, and the inventory that fills it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators import gates
from foliant.sources import sinks

# Tables in the order of their references, with keys, required columns, references and other unique columns.
TABLES: dict[str, dict] = {
    "package_metadata": {"key": ["key"], "required": ["value"]},
    "resource": {"key": ["resource_id"], "required": ["resource_type", "status"]},
    "resource_version": {"key": ["resource_id", "version"], "required": ["status", "compiler_version", "created_at"],
    "refers": [(["resource_id"], "resource")]},
    "resource_provenance": {"key": ["provenance_id"], "required": ["source_type"]},
    "specification_point": {"key": ["specification_point_id"], "required": ["specification_id"]},
    "revision_note": {"key": ["revision_note_id"],
    "required": ["resource_id", "version", "title", "content_path", "content_sha256", "status"],
    "refers": [(["resource_id", "version"], "resource_version")]},
    "revision_note_specification_point": {
        "key": ["revision_note_id", "specification_point_id"], "required": ["mapping_status"],
        "refers": [(["revision_note_id"], "revision_note"), (["specification_point_id"], "specification_point")]},
    "paper": {"key": ["paper_id"], "required": ["status"]},
    "paper_question": {"key": ["question_id"], "required": ["paper_id", "ordinal", "status"],
    "refers": [(["paper_id"], "paper")], "unique": [["paper_id", "ordinal"]]},
    "question_part": {"key": ["question_part_id"], "required": ["question_id", "anchor", "ordinal", "status"],
    "refers": [(["question_id"], "paper_question")], "unique": [["question_id", "ordinal"]]},
    "mark_scheme": {"key": ["mark_scheme_id"], "required": ["paper_id", "content_sha256", "status"],
    "refers": [(["paper_id"], "paper")]},
    "mark_point": {"key": ["mark_point_id"], "required": ["mark_scheme_id", "anchor", "status"],
    "refers": [(["mark_scheme_id"], "mark_scheme"), (["question_part_id"], "question_part")]},
    "parser_run": {"key": ["parser_run_id"], "required": ["source_sha256", "parser", "parser_version", "started_at",
    "status"]},
    "validation_finding": {"key": ["finding_id"],
    "required": ["entity_type", "entity_id", "severity", "code", "message", "status"]},
}
VALID = "VALIDATED"


def _id(columns: list[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def findings(tables: dict[str, DataFrame]) -> DataFrame:
    """What stops a package: unknown and missing tables, nulls in keys and required columns, repeated keys, references
    that nothing meets (null ones are free)."""
    spark = next(iter(tables.values())).sparkSession
    shape = [(t, "unknown_table") for t in tables if t not in TABLES] + [(t, "missing_table") for t in TABLES
        if t not in tables]
    out = [spark.createDataFrame([(t, c, "fail", "") for t, c in shape],
        "subject string, check_id string, severity string, detail string")]
    for name, rules in TABLES.items():
        if name not in tables:
            continue
        df, key = tables[name], rules["key"]
        lost = [c for c in [*key, *rules["required"]] if c not in df.columns]
        out.append(spark.createDataFrame([(name, f"missing_column:{name}", "fail", c) for c in lost], out[0].schema))
        held = [c for c in [*key, *rules["required"]] if c in df.columns]
        empty = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in held]))
        own = [c for c in key if c in df.columns]
        out.append(gates.findings(df.withColumn("_empty", empty).where(F.size("_empty") > 0), _id(own),
            f"required:{name}", "fail", F.array_join("_empty", ",")))
        for cols in [key, *rules.get("unique", [])]:
            if all(c in df.columns for c in cols):
                out.append(gates.findings(gates.repeated_keys(df.dropna(subset=cols), cols), _id(cols),
                    f"repeated:{name}", "fail", F.col("count")))
        for cols, of in rules.get("refers", []):
            if of in tables and all(c in df.columns and c in tables[of].columns for c in cols):
                out.append(gates.findings(gates.dangling(df, cols, tables[of]), _id(cols), f"dangling:{name}:{of}",
                    "fail", F.lit(of)))
    return gates.all_findings(out)


def write(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Each table as Parquet in the order of references, if there are no findings; the findings."""
    found = findings(tables)
    if found.isEmpty():
        for name in TABLES:
            tables[name].write.mode("overwrite").parquet(f"{path}/{name}")
    return found


def point_part(reference: Column) -> Column:
    """The part that a point's reference names: 2-a is part a; a bare number is the question's own, so null."""
    return F.nullif(F.regexp_extract(reference, r"^[^-]*-(.+)$", 1), F.lit(""))


def inventory_findings(papers: DataFrame, versions: DataFrame, points: DataFrame, identities: DataFrame) -> DataFrame:
    """What keeps papers from learners; none may be served while it has a finding.

    papers: paper_id, status, qp_document_id, ms_document_id; versions: paper_id, version_id, status, scheme_id,
    scheme_status; points: version_id; identities: paper_id, qp_document_id, ms_document_id as the canonical texts say.
    """
    off = lambda c: ~F.col(c).eqNullSafe(F.lit(VALID))
    bare = versions.join(points.select("version_id").distinct(), "version_id", "left_anti")
    known = identities.select("paper_id", F.col("qp_document_id").alias("qp"), F.col("ms_document_id").alias("ms"))
    bound = papers.join(known, "paper_id", "left")
    return gates.all_findings([
        gates.findings(papers.where(off("status")), F.col("paper_id"), "paper_status", "fail", F.col("status")),
        gates.findings(bound.where(~F.col("qp").eqNullSafe(F.col("qp_document_id"))), F.col("paper_id"),
        "paper_identity", "fail", F.col("qp")),
        gates.findings(bound.where(~F.col("ms").eqNullSafe(F.col("ms_document_id"))), F.col("paper_id"),
        "scheme_identity", "fail", F.col("ms")),
        gates.findings(versions.where(off("status")), F.col("version_id"), "version_status", "fail", F.col("status")),
        gates.findings(versions.where(F.col("scheme_id").isNull() | off("scheme_status")), F.col("version_id"),
        "scheme_status", "fail", F.col("scheme_status")),
        gates.findings(bare, F.col("version_id"), "no_points", "fail", F.lit(""))])


def inventory_points(points: DataFrame) -> DataFrame:
    """points (version_id, ord, reference) with anchor (MP- and the place where there is no reference) and part."""
    anchor = F.coalesce(F.col("reference"), F.concat(F.lit("MP-"), F.col("ord").cast("string")))
    return points.withColumn("anchor", anchor).withColumn("part",
        F.when(F.col("reference").isNotNull(), point_part(F.col("reference"))))


def rendered(elements: DataFrame) -> DataFrame:
    """(doc_id, markdown, sha256): elements in order, headings by their level, set apart by blank lines, ended by one break."""
    mark = F.when((F.col("kind") == "heading") & (F.coalesce("level", F.lit(0)) > 0),
        F.concat(F.repeat(F.lit("#"), F.col("level").cast("int")), F.lit(" "))).otherwise("")
    rows = F.sort_array(F.collect_list(F.struct("ord", F.concat(mark, F.coalesce("text", F.lit(""))).alias("t"))))
    out = elements.groupBy("doc_id").agg(F.concat(F.array_join(F.transform(rows, lambda x: x.t), "\n\n"),
        F.lit("\n")).alias("markdown"))
    return out.withColumn("sha256", F.sha2("markdown", 256))


def manifest(documents: DataFrame, assets: DataFrame, engine: str, version: Column | str = "unknown") -> DataFrame:
    """(doc_id, manifest): one JSON for each document with its digest, engine, assets in order and what was not fetched.

    documents: doc_id, role, sha256, n_pages; assets: doc_id, ord, name, sha256, bytes, reason (null: fetched).
    """
    v = F.lit(version) if isinstance(version, str) else version
    one = F.struct("ord", F.struct("name", "sha256", "bytes", "reason").alias("a"))
    listed = assets.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x.a).alias("all"))
    none = F.array().cast("array<struct<name:string,sha256:string,bytes:bigint,reason:string>>")
    held = documents.join(listed, "doc_id", "left").withColumn("all",
        F.coalesce(F.col("all").cast("array<struct<name:string,sha256:string,bytes:bigint,reason:string>>"), none))
    fields = held.select(
        "doc_id", F.lit(2).alias("manifest_version"), "role", "sha256", "n_pages", F.lit(engine).alias("engine"),
        v.alias("engine_version"),
        F.filter("all", lambda a: a.reason.isNull()).alias("assets"),
        F.transform(F.filter("all", lambda a: a.reason.isNotNull()),
        lambda a: F.struct(a["name"].alias("name"), a.reason.alias("reason"))).alias("unfetched"))
    names = [c for c in fields.columns if c != "doc_id"]
    return fields.select("doc_id", sinks.canonical_json(fields, names).alias("manifest"))


def linked_points(points: DataFrame, parts: DataFrame) -> DataFrame:
    """points (question_id, part, ..) with question_part_id: the part of that anchor; null for points of the question itself."""
    own = parts.groupBy("question_id", "anchor").agg(F.min("question_part_id").alias("question_part_id"))
    return points.join(own.withColumnRenamed("anchor", "part"), ["question_id", "part"], "left")
