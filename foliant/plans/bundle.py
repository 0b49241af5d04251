"""From folders of markdown to a bundle of tables: elements, papers, questions, schemes, entries, bindings, findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import markdown, papers, schemes, sittings
from foliant.operators.shared import written
from foliant.sources import readers

#: Name of a file without its role; the rest is the pair.
ROLE = r"^(.*)-(qp|ms)\.md$"


def build(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables, files set aside) of the markdown files below path.

    A pair is a folder and a name with one -qp.md and one -ms.md file; other files are set aside with a reason.
    Equal content has one doc_id, so copies of a file are read once.
    """
    found = readers.files(spark, path, "*.md")
    name = readers.base_name(F.col("path"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    docs = markdown.with_id(found).withColumn("role", F.regexp_extract(name, ROLE, 2)).withColumn("pair",
        F.concat_ws("/", folder, F.regexp_extract(name, ROLE, 1)))
    keyed = written(docs.where("role <> ''").select("doc_id", "pair", "role", "path", "checksum", "text"), "documents")
    counts = keyed.groupBy("pair").agg(F.count_if(F.col("role") == "qp").alias("nq"),
        F.count_if(F.col("role") == "ms").alias("nm"))
    paired = counts.where("nq = 1 and nm = 1").select("pair")
    aside = (docs.where("role = ''").select("path", F.lit("name").alias("reason"))
             .union(keyed.join(paired, "pair", "left_anti").select("path", F.lit("unpaired"))))
    own = keyed.join(paired, "pair")
    elements = written(markdown.elements(own.select("doc_id", "text").dropDuplicates(["doc_id"])), "elements")
    of = lambda role: own.where(F.col("role") == role).select("doc_id", "pair")
    qp = written(papers.drafted(elements.join(of("qp").select("doc_id").distinct(), "doc_id",
        "left_semi")).join(of("qp"), "doc_id"), "papers")
    ms = written(schemes.drafted(elements.join(of("ms").select("doc_id").distinct(), "doc_id",
        "left_semi")).join(of("ms"), "doc_id"), "schemes")
    questions = qp.select("pair", F.explode("questions").alias("q")).select("pair", "q.*")
    entries = ms.select("pair", F.posexplode("entries").alias("ord", "e")).select("pair", "ord", "e.*")
    p, s = qp.drop("questions"), ms.drop("entries")
    parts, whole, unmatched = sittings.bind(questions, entries)
    findings, marks = sittings.health(p, s, questions, entries), sittings.mark_findings(p, s, questions, entries)
    tables = {
        "documents": own.drop("text"), "elements": elements, "sections": markdown.sections(elements),
        "violations": markdown.violations(elements), "papers": p, "questions": questions, "schemes": s,
        "entries": entries,
        "parts": parts, "question_entries": whole.select("pair", "number", "question_id", "entry"),
        "unmatched": unmatched, "marks": marks, "findings": findings, "status": sittings.pair_status(findings),
        "review": sittings.review_queue(findings, marks)}
    return tables, aside


def write(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as Parquet below path."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
