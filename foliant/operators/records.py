"""Records of a paper for a bank: flags, bindings, canonical elements, markdown, manifests and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.operators import gates, lines, vectors

# Flags in their order.
FLAGS = ("no-paper", "paper-total-missing", "scheme-missing", "totals-differ", "points-do-not-close")
KINDS = ("heading", "paragraph", "list_item", "table", "figure", "equation")
SERIES = ("JAN", "JUN", "NOV")


def flags(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in the order of FLAGS, then as given."""
    names = [n for n in FLAGS if n in conditions] + [n for n in conditions if n not in FLAGS]
    return F.array_compact(F.array(*[F.when(conditions[n], F.lit(n)) for n in names]))


def paper_records(questions: DataFrame, schemes: DataFrame) -> DataFrame:
    """(doc_id, number, marks, ms_total, sum, verified, flags): questions joined with their schemes, both ways.

    questions: doc_id, number, total; schemes: doc_id, number, ms_total, sum.  verified: both totals are printed and
    equal, and the points close.
    """
    q = questions.select("doc_id", "number", "total", F.lit(1).alias("_q"))
    s = schemes.select("doc_id", "number", "ms_total", "sum", F.lit(1).alias("_s"))
    both = q.join(s, ["doc_id", "number"], "full_outer")
    differ = F.coalesce(F.col("total") != F.col("ms_total"), F.lit(False))
    marks = F.coalesce("total", "ms_total", "sum")
    found = flags({
        "no-paper": F.col("_q").isNull(), "paper-total-missing": F.col("_q").isNotNull() & F.col("total").isNull(),
        "scheme-missing": F.col("_s").isNull(),
        "totals-differ": differ, "points-do-not-close": F.col("_s").isNotNull()
        & ~F.coalesce(F.col("sum") == marks, F.lit(False))})
    out = both.withColumn("flags", found)
    return out.select("doc_id", "number", marks.alias("marks"), "ms_total", "sum",
        (F.size("flags") == 0).alias("verified"), "flags")


def part_points(parts: DataFrame, points: DataFrame) -> DataFrame:
    """parts (key, label) with the points (key, part, sub, ...) of that label: a-ii is part a, sub ii; a alone takes all of a."""
    p = parts.withColumn("_part", F.split("label", "-")[0]).withColumn("_sub",
        F.get(F.split("label", "-"), F.lit(1))).alias("p")
    x = points.alias("x")
    fits = (F.col("p.key") == F.col("x.key")) & (F.col("p._part") == F.col("x.part")) & (F.col("p._sub").isNull()
        | F.col("p._sub").eqNullSafe(F.col("x.sub")))
    return p.join(x, fits, "left").select("p.*",
        *[F.col(f"x.{c}").alias(f"point_{c}") for c in points.columns if c != "key"]).drop("_part", "_sub")


def correct_options(atoms: DataFrame, answers: DataFrame) -> DataFrame:
    """atoms (key, part, sub, ...) with the correct letter of answers (key, part, sub, letter); nulls match nulls."""
    a, b = atoms.alias("a"), answers.groupBy("key", "part", "sub").agg(F.min("letter").alias("letter")).alias("b")
    same = (F.col("a.key") == F.col("b.key")) & F.col("a.part").eqNullSafe(F.col("b.part")) & F.col("a.sub").eqNullSafe(F.col("b.sub"))
    return a.join(b, same, "left").select("a.*", "b.letter")


def attach_descriptions(figures: DataFrame, reports: DataFrame) -> DataFrame:
    """figures (doc_id, source_name) with description: by equal base name, else by the one report whose name it ends with."""
    base = lambda c: F.lower(F.element_at(F.split(c, "[/\\\\]"), -1))
    f = figures.withColumn("_b", base(F.col("source_name")))
    r = reports.withColumn("_b", base(F.col("name")))
    exact = r.groupBy("doc_id", "_b").agg(F.min_by("description", "name").alias("_exact"))
    keyed = f.withColumn("_s", F.element_at(F.split("_b", "[-_]"), -1))
    suffix = r.withColumn("_s", F.element_at(F.split("_b", "[-_]"), -1)).groupBy("doc_id",
        "_s").agg(F.min("description").alias("_d"), F.countDistinct("name").alias("_n"))
    joined = keyed.join(exact, ["doc_id", "_b"], "left").join(suffix, ["doc_id", "_s"], "left")
    return joined.withColumn("description", F.coalesce("_exact",
        F.when(F.col("_n") == 1, F.col("_d")))).select(*figures.columns, "description")


def canonical(blocks: DataFrame) -> DataFrame:
    """Elements of atoms' blocks (doc_id, number, part, ord, kind, text, page): ids and orders from 0, a section and group by question.

    An element's group_key is its question and part, so that no chunk crosses it.
    """
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("number", F.asc_nulls_first("part"), "ord")) - 1
    key = F.concat(F.lit("q"), F.lpad(F.col("number").cast("string"), 2, "0"),
        F.when(F.col("part").isNotNull(), F.concat(F.lit("-"), "part")).otherwise(""))
    out = blocks.withColumn("_n", place)
    return out.select("doc_id", F.col("_n").alias("ord"),
        F.concat(F.lit("e"), F.lpad(F.col("_n").cast("string"), 6, "0")).alias("element_id"), "kind", "text", "page",
        F.concat(F.lit("Question "), F.col("number").cast("string")).alias("section"), key.alias("group_key"))


def page_counts(elements: DataFrame) -> DataFrame:
    return elements.groupBy("doc_id").agg(F.max("page").alias("page_count"), F.count(F.lit(1)).alias("n_elements"))


def bank_markdown(blocks: DataFrame) -> DataFrame:
    """(doc_id, number, markdown): blocks of a question in order, parts headed by their letter, set apart by blank lines."""
    text = F.when(F.col("kind") == "figure", F.concat(F.lit("!["), F.coalesce("alt", F.lit("")), F.lit("]("), "text",
        F.lit(")"))).when(F.col("kind") == "list_item", F.concat(F.lit("- "), "text")).otherwise(F.col("text"))
    first = F.row_number().over(W.partitionBy("doc_id", "number", "part").orderBy("ord")) == 1
    line = F.when(F.col("part").isNotNull() & first,
        F.concat(F.lit("**("), "part", F.lit(")** "), text)).otherwise(text)
    rows = blocks.withColumn("_t", line).where("coalesce(_t, '') <> ''")
    return rows.groupBy("doc_id", "number").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord",
        "_t"))), lambda x: x["_t"]), "\n\n").alias("markdown"))


def validate(documents: DataFrame, elements: DataFrame, sections: DataFrame) -> DataFrame:
    """Findings on canonical documents, all collected: series, year and confidence ranges, kinds, section references, ids.

    documents: doc_id, series, year, page_count; elements: doc_id, element_id, ord, kind, page, confidence; sections:
    doc_id, section, element_ids.
    """
    at = F.col("doc_id")
    place = F.concat_ws("/", "doc_id", "element_id")
    out = [
        gates.findings(documents.where(F.col("series").isNotNull() & ~F.col("series").isin(*SERIES)), at, "series",
        "fail", F.col("series")),
        gates.findings(documents.where("year is not null and year not between 1990 and 2100"), at, "year", "fail",
        F.col("year")),
        gates.findings(elements.where(~F.col("kind").isin(*KINDS)), place, "kind", "fail", F.col("kind")),
        gates.findings(elements.where("confidence is not null and confidence not between 0 and 1"), place, "confidence",
        "fail", F.col("confidence")),
        gates.findings(elements.join(documents.select("doc_id", "page_count"),
        "doc_id").where("page is not null and (page < 1 or page > page_count)"), place, "page", "fail", F.col("page")),
        gates.findings(gates.repeated_keys(elements, ["doc_id", "element_id"]), place, "repeated_id", "fail",
        F.col("count"))]
    refs = sections.select("doc_id", "section", F.explode("element_ids").alias("element_id"))
    lost = refs.join(elements.select("doc_id", "element_id").distinct(), ["doc_id", "element_id"], "left_anti")
    out.append(gates.findings(lost, place, "section_reference", "fail", F.col("section")))
    return gates.all_findings(out)


def slices(rows: DataFrame, key: str, opens: Column) -> DataFrame:
    """(key, slice, first_line, last_line, n_lines): numbered lines from each opener to the line before the next."""
    marked = lines.islands(rows, key, ["line_no"], opens, "slice").where("slice > 0")
    return marked.groupBy(key, "slice").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"),
        F.count(F.lit(1)).alias("n_lines"))


def upgrade_manifest(manifests: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """manifests with the columns of a newer version added, and nulls of them filled; nothing is taken away."""
    out = manifests
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), value) if name in out.columns else value)
    return out


def append_log(log: DataFrame, entries: DataFrame) -> DataFrame:
    """log with entries of batches that it has not got: replaying a batch adds nothing."""
    new = entries.join(log.select("batch_id").distinct(), "batch_id", "left_anti")
    return log.unionByName(new.select(*log.columns))


def apply_embeddings(bank: DataFrame, fresh: DataFrame, key: str, dimension: int, revision: int) -> tuple[DataFrame,
        DataFrame]:
    """(updated bank, violations): new vectors are taken only if all have the dimension and belong to a row, each once."""
    wrong = vectors.check_dimension(fresh, "embedding", dimension).select(F.col(key).cast("string").alias("subject"),
        F.lit("dimension").alias("check_id"))
    lost = gates.dangling(fresh, [key], bank).select(F.col(key).cast("string"), F.lit("unknown"))
    twice = gates.repeated_keys(fresh, [key]).select(F.col(key).cast("string"), F.lit("repeated"))
    found = wrong.union(lost).union(twice)
    if not found.isEmpty():
        return bank, found
    new = fresh.select(key, F.col("embedding").alias("_e"))
    joined = bank.join(new, key, "left")
    return joined.withColumn("embedding", F.coalesce("_e", "embedding")).withColumn("embed_rev",
        F.when(F.col("_e").isNotNull(), F.lit(revision)).otherwise(F.col("embed_rev"))).select(*bank.columns), found


def reading_order(documents: DataFrame, arrays: list[str]) -> DataFrame:
    """(doc_id, ord, element_id, kind) of documents whose elements lie in an array for each kind, as one list by order."""

    def of(kind: str) -> Column:
        own = F.coalesce(kind, F.array().cast("array<struct<ord:int,element_id:string>>"))
        return F.transform(own, lambda x: F.struct(x.ord.alias("ord"), x.element_id.alias("element_id"),
            F.lit(kind).alias("kind")))

    return documents.select("doc_id", F.explode(F.array_sort(F.concat(*map(of, arrays)))).alias("e")).select("doc_id", "e.*")


def draft_points(points: DataFrame, pools: DataFrame, guidance: DataFrame) -> DataFrame:
    """Points of a draft: alternatives merged, a pool's rule before the text of its first point, guidance with the question's first.

    points: key, part, sub, ord, marks, text; pools: key, ord, rule; guidance: key, text (array).
    """
    from foliant.operators.atoms import merge_alternatives

    merged = merge_alternatives(points).join(pools.select("key", "ord", "rule"), ["key", "ord"],
        "left").join(guidance.select("key", F.col("text").alias("said")), "key", "left")
    first = F.row_number().over(W.partitionBy("key").orderBy("ord")) == 1
    said = F.when(first, F.coalesce("said", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    text = F.when(F.col("rule").isNotNull(), F.concat(F.lit("["), "rule", F.lit("] "), "text")).otherwise(F.col("text"))
    return merged.select("key", "part", "sub", "ord", "marks", text.alias("text"), "alternatives",
        said.alias("guidance"))
