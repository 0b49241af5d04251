"""Suites of gates over whole papers: marks, structure, assets, clean drafts, banks, reports.

Each suite gives findings (subject, check_id, severity, detail), one row for each check of a document, so that what
passed is on record too.  Tables are long, keyed by doc_id; a side that was not asked for is left out, and its check
with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.operators import gates

# The only new class of warning that cleaning may bring, and what reports must say.
REMOVED = "boilerplate-removed"
PROVENANCE = "llm-vision"
PAGE_ROLES = ("data-sheet", "cover", "photo-page", "instruction-page", "answer-grid", "content", "blank")
PAGE_FIELDS = ("doc", "page", "role", "has_question_content", "description", "provenance", "review_required")
FIGURE_FIELDS = ("png", "sha256", "doc", "page", "kind", "carries_answer", "description", "provenance")


def _checks(documents: DataFrame, name: str, ok: Column, detail: Column) -> DataFrame:
    return gates.findings(documents, F.col("doc_id"), name,
        F.when(F.coalesce(ok, F.lit(False)), "ok").otherwise("fail"), detail)


def _per_document(documents: DataFrame, counted: DataFrame) -> DataFrame:
    """documents with what was counted for them; documents without rows get nulls."""
    return documents.select("doc_id").join(counted, "doc_id", "left")


def same_maps(documents: DataFrame, a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Whether two (doc_id, number, total) tables hold the same map for each document; detail counts what differs."""
    x = a.select("doc_id", "number", F.col("total").alias("ta"), F.lit(True).alias("ia"))
    y = b.select("doc_id", "number", F.col("total").alias("tb"), F.lit(True).alias("ib"))
    both = x.join(y, ["doc_id", "number"], "full_outer")
    differ = F.col("ia").isNull() | F.col("ib").isNull() | ~F.col("ta").eqNullSafe(F.col("tb"))
    found = _per_document(documents, both.groupBy("doc_id").agg(F.count_if(differ).alias("n")))
    return _checks(found, name, F.coalesce("n", F.lit(0)) == 0, F.coalesce("n", F.lit(0)))


def marks(documents: DataFrame, paper: DataFrame, scheme: DataFrame, witnesses: DataFrame, sequence: DataFrame
        | None = None, second: DataFrame | None = None, reference: DataFrame | None = None) -> DataFrame:
    """Marks integrity of a paper and its scheme.

    paper: doc_id, number, total; scheme: doc_id, number, total, arithmetic_ok; witnesses: doc_id, value; sequence,
    second and reference: doc_id, number, total as the scheme's layout, a second reader of the paper and a known truth
    have them.  Totals that differ between paper and scheme are the source's, so they are for review.
    """
    known = paper.groupBy("doc_id").agg(F.count_if(F.col("total").isNull()).alias("missing"),
        F.sum("total").alias("sum"))
    out = [_checks(_per_document(documents, known), "paper_totals_present", F.col("missing") == 0, F.col("missing"))]
    seen = known.join(witnesses.groupBy("doc_id").agg(F.collect_set("value").alias("seen")), "doc_id", "left")
    out.append(_checks(_per_document(documents, seen), "paper_sum_is_printed", F.array_contains("seen", F.col("sum")),
        F.col("sum")))
    own = scheme.groupBy("doc_id").agg(F.count_if(F.col("total").isNull()).alias("missing"),
        F.count_if(~F.coalesce("arithmetic_ok", F.lit(False))).alias("open"))
    out.append(_checks(_per_document(documents, own), "scheme_totals_present", F.col("missing") == 0, F.col("missing")))
    out.append(_checks(_per_document(documents, own), "points_close", F.col("open") == 0, F.col("open")))
    for other, against, name in ((second, paper, "second_reader_agrees"), (sequence, scheme, "scheme_follows_layout")):
        if other is not None:
            out.append(same_maps(documents, against, other, name))
    if reference is not None:  # only what the reference names
        off = reference.join(paper.select("doc_id", "number", F.col("total").alias("own")), ["doc_id", "number"],
            "left").where(~F.col("own").eqNullSafe(F.col("total"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        out.append(_checks(_per_document(documents, off), "as_referenced", F.coalesce("n", F.lit(0)) == 0,
            F.coalesce("n", F.lit(0))))
    differ = paper.select("doc_id", "number", "total").join(scheme.select("doc_id", "number",
        F.col("total").alias("ms")), ["doc_id", "number"]).where(~F.col("total").eqNullSafe(F.col("ms")))
    out.append(gates.findings(differ, F.concat_ws("/", "doc_id", F.col("number").cast("string")), "totals_differ",
        "review", F.concat_ws("/", F.col("total").cast("string"), F.col("ms").cast("string"))))
    return gates.all_findings(out)


def structure(documents: DataFrame, scheme: DataFrame, paper: DataFrame | None = None) -> DataFrame:
    """Numbers 1 to n on each side, and as many on both (doc_id, number)."""
    out = []
    sides = {"scheme": scheme} | ({"paper": paper} if paper is not None else {})
    for name, rows in sides.items():
        order = gates.continuity(rows, "doc_id", "number")
        out.append(_checks(_per_document(documents, order), f"continuous_{name}", F.col("continuous"), F.col("n")))
    if paper is not None:
        n = lambda df, c: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(c))
        both = _per_document(documents, n(paper, "a").join(n(scheme, "b"), "doc_id", "full_outer"))
        out.append(_checks(both, "equal_counts", F.col("a") == F.col("b"), F.concat_ws("/", "a", "b")))
    return gates.all_findings(out)


def assets(documents: DataFrame, references: DataFrame, files: DataFrame, embedded: DataFrame) -> DataFrame:
    """Every reference (doc_id, path) has its file (doc_id, path), and as many files as were embedded (doc_id, n)."""
    lost = references.distinct().join(files.distinct(), ["doc_id", "path"],
        "left_anti").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lost"))
    n = files.groupBy("doc_id").agg(F.count(F.lit(1)).alias("files"))
    x = _per_document(documents, embedded).join(lost, "doc_id", "left").join(n, "doc_id", "left")
    none = F.lit(0)
    return gates.all_findings([
        _checks(x, "asset_files", F.coalesce("lost", none) == 0, F.coalesce("lost", none)),
        _checks(x, "asset_count", F.coalesce("files", none) == F.coalesce("n", none),
        F.concat_ws("/", F.coalesce("files", none), F.coalesce("n", none)))])


def completeness(documents: DataFrame, scheme: DataFrame, paper: DataFrame | None = None) -> DataFrame:
    """Scheme questions with points (doc_id, number, n_points); paper questions with pages and a prompt (n_pages, prompt)."""
    bare = scheme.where("coalesce(n_points, 0) = 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    out = [_checks(_per_document(documents, bare), "questions_have_points", F.col("n").isNull(),
        F.coalesce("n", F.lit(0)))]
    if paper is not None:
        empty = paper.groupBy("doc_id").agg(F.count_if(F.coalesce("n_pages", F.lit(0)) == 0).alias("pages"),
            F.count_if(F.coalesce(F.trim("prompt"), F.lit("")) == "").alias("prompts"))
        x = _per_document(documents, empty)
        out += [_checks(x, "questions_have_pages", F.coalesce("pages", F.lit(0)) == 0, F.col("pages")),
            _checks(x, "questions_have_prompts", F.coalesce("prompts", F.lit(0)) == 0, F.col("prompts"))]
    return gates.all_findings(out)


def scheme_only(documents: DataFrame, scheme: DataFrame, labels: DataFrame, references: DataFrame, files: DataFrame,
        embedded: DataFrame) -> DataFrame:
    """The suite of a scheme without a paper: its totals and sums, labels, numbers, assets and points.

    scheme: doc_id, number, total, arithmetic_ok, n_points; labels: doc_id, accounted.
    """
    own = scheme.groupBy("doc_id").agg(F.count_if(F.col("total").isNull()).alias("missing"),
        F.count_if(~F.coalesce("arithmetic_ok", F.lit(False))).alias("open"))
    x = _per_document(documents, own)
    out = [_checks(x, "scheme_totals_present", F.col("missing") == 0, F.col("missing")),
        _checks(x, "points_close", F.col("open") == 0, F.col("open"))]
    out.append(_checks(_per_document(documents, labels), "labels_accounted", F.col("accounted"), F.lit("")))
    return gates.all_findings([*out, structure(documents, scheme), assets(documents, references, files, embedded),
        completeness(documents, scheme)])


def verdicts(found: DataFrame) -> DataFrame:
    """(subject, verdict, failed): fail, pass with flags, or pass, of the checks of each document (the subject's first part)."""
    rows = found.withColumn("subject", F.element_at(F.split("subject", "/"), 1))
    g = rows.groupBy("subject").agg(F.array_sort(F.collect_set(F.when(F.col("severity") == "fail",
        F.col("check_id")))).alias("failed"), F.count_if(F.col("severity") == "review").alias("flags"))
    return g.select("subject", F.when(F.size("failed") > 0, "fail").when(F.col("flags") > 0,
        "pass with flags").otherwise("pass").alias("verdict"), "failed")


def warning_class(text: Column) -> Column:
    """What a warning is about: what stands before its first colon; removed furniture is a class of its own."""
    return F.when(F.contains(text, F.lit(REMOVED)),
        F.lit(REMOVED)).otherwise(F.trim(F.regexp_extract(text, r"^([^:]*)", 1)))


def cleaned(raw: dict[str, DataFrame], clean: dict[str, DataFrame], documents: DataFrame) -> DataFrame:
    """Whether a cleaned draft keeps what the raw one had.

    Both sides: questions (doc_id, number), parts (doc_id, number, label, marks; label is null for questions without
    parts), totals (doc_id, number, total), points (doc_id), warnings (doc_id, text), conflicts (doc_id, conflict).
      no_more_questions, no_more_points   counts do not grow,
      same_marks                          parts that both have carry the same marks,
      same_totals                         totals that both have are equal and none is new,
      no_new_warnings                     no class of warning comes more often, but for removed furniture,
      same_conflict                       a conflict of the paper's total is gone or as it was.
    """
    n = lambda df, c: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(c))
    out = []
    for name, check in (("questions", "no_more_questions"), ("points", "no_more_points")):
        x = _per_document(documents, n(raw[name], "a").join(n(clean[name], "b"), "doc_id", "full_outer"))
        out.append(_checks(x, check, F.coalesce("b", F.lit(0)) <= F.coalesce("a", F.lit(0)),
            F.concat_ws("/", F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0)))))
    a, b = raw["parts"].alias("a"), clean["parts"].alias("b")
    same = (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.number") == F.col("b.number")) & F.col("a.label").eqNullSafe(F.col("b.label"))
    off = a.join(b,
        same).where(~F.col("a.marks").eqNullSafe(F.col("b.marks"))).groupBy("a.doc_id").agg(F.count(F.lit(1)).alias("n"))
    out.append(_checks(_per_document(documents, off), "same_marks", F.col("n").isNull(), F.coalesce("n", F.lit(0))))
    t = clean["totals"].select("doc_id", "number",
        F.col("total").alias("b")).join(raw["totals"].select("doc_id", "number", F.col("total").alias("a"),
        F.lit(True).alias("had")), ["doc_id", "number"], "left")
    moved = t.where(F.col("had").isNull()
        | ~F.col("a").eqNullSafe(F.col("b"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    out.append(_checks(_per_document(documents, moved), "same_totals", F.col("n").isNull(), F.coalesce("n", F.lit(0))))
    classes = lambda df, c: df.groupBy("doc_id",
        warning_class(F.col("text")).alias("class")).agg(F.count(F.lit(1)).alias(c))
    more = (classes(clean["warnings"], "b").join(classes(raw["warnings"], "a"), ["doc_id", "class"],
        "left").where((F.col("b") > F.coalesce("a", F.lit(0))) & (F.col("class") != REMOVED))
            .groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("class")), ",").alias("classes")))
    out.append(_checks(_per_document(documents, more), "no_new_warnings", F.col("classes").isNull(),
        F.coalesce("classes", F.lit(""))))
    c = _per_document(documents, raw["conflicts"].select("doc_id",
        F.col("conflict").alias("a")).join(clean["conflicts"].select("doc_id", F.col("conflict").alias("b")), "doc_id",
        "full_outer"))
    out.append(_checks(c, "same_conflict", ~F.coalesce("b", F.lit(False)) | F.col("a").eqNullSafe(F.col("b")),
        F.concat_ws("/", F.col("a").cast("string"), F.col("b").cast("string"))))
    return gates.all_findings(out)


def bank(products: DataFrame, questions: DataFrame, parts: DataFrame, rebuilt: DataFrame | None = None) -> DataFrame:
    """What stops a bank: counts and marks off the products', repeated ids, papers without a record, another rebuild.

    products: doc_id, n_questions, marks; questions: doc_id, id, marks; parts: doc_id, id.  No findings: it may be
    written.  rebuilt are the questions of a second build.
    """
    own = questions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("marks"), F.lit(0)).alias("sum"))
    both = products.join(own, "doc_id", "full_outer")
    none = F.lit(0)
    out = [
        gates.findings(both.where(F.col("n_questions").isNull()), F.col("doc_id"), "unknown_paper", "fail", F.col("n")),
        gates.findings(both.where(F.col("n_questions").isNotNull() & (F.coalesce("n", none) != F.col("n_questions"))),
        F.col("doc_id"), "question_count", "fail", F.concat_ws("/", F.coalesce("n", none), "n_questions")),
        gates.findings(both.where(F.col("n_questions").isNotNull()
        & (F.coalesce("sum", none) != F.coalesce("marks", none))), F.col("doc_id"), "marks_total", "fail",
        F.concat_ws("/", F.coalesce("sum", none), F.coalesce("marks", none))),
        gates.findings(gates.repeated_keys(questions, ["id"]), F.col("id"), "repeated_question", "fail",
        F.col("count")), gates.findings(gates.repeated_keys(parts, ["id"]), F.col("id"), "repeated_part", "fail",
        F.col("count"))]
    if rebuilt is not None:
        lost = questions.exceptAll(rebuilt).select("doc_id").union(rebuilt.select(*questions.columns).exceptAll(questions).select("doc_id")).distinct()
        out.append(gates.findings(lost, F.col("doc_id"), "rebuild", "fail", F.lit("")))
    return gates.all_findings(out)


def _violations(pairs: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)) for wrong, name in pairs]))


def page_report(columns: list[str]) -> Column:
    """Violations of a report on a page; columns are those that the table of reports has."""
    c = lambda n: F.col(n) if n in columns else F.lit(None)
    missing = [(c(n).isNull(), f"missing:{n}") for n in PAGE_FIELDS]
    blank = lambda n: F.coalesce(F.trim(c(n).cast("string")), F.lit("")) == ""
    return _violations([
        *missing, (~F.coalesce(c("role"), F.lit("")).isin(*PAGE_ROLES), "role"),
        (~c("provenance").eqNullSafe(F.lit(PROVENANCE)), "provenance"),
        (c("has_question_content").cast("boolean") & blank("transcription_ref") & blank("content_note"),
        "content without transcription or note"), (blank("description"), "empty description")])


def figure_report(columns: list[str]) -> Column:
    """Violations of a report on a figure: an answer that a scheme's figure carries must be told."""
    c = lambda n: F.col(n) if n in columns else F.lit(None)
    blank = lambda n: F.coalesce(F.trim(c(n).cast("string")), F.lit("")) == ""
    return _violations([
        *[(c(n).isNull(), f"missing:{n}") for n in FIGURE_FIELDS],
        (~c("provenance").eqNullSafe(F.lit(PROVENANCE)), "provenance"),
        (c("carries_answer").cast("boolean") & (c("doc_kind").cast("string") == "MS") & blank("answer_note"),
        "answer without a note"), (blank("description"), "empty description")])


def assembled(preferred: DataFrame, fallback: DataFrame, totals: DataFrame, pools: DataFrame
        | None = None) -> tuple[DataFrame, DataFrame]:
    """(points, schemes): a question's points are the preferred reader's if that has any, else the other's.

    preferred and fallback: doc_id, number, ord, label, part, sub, marks, text; totals: doc_id, number, preferred and
    fallback totals as printed (`preferred`, `fallback`); pools: doc_id, number, label, pool, cap.  A pool gives its cap
    or what its points make, if that is less.  verified: the printed total of the side in use equals the sum.
    """
    key = ["doc_id", "number"]
    first = preferred.withColumn("provenance", F.lit("preferred"))
    rest = fallback.join(preferred.select(*key).distinct(), key, "left_anti").withColumn("provenance",
        F.lit("fallback"))
    points = first.unionByName(rest.select(*first.columns))
    pooled = points if pools is None else points.join(pools.select(*key, "label", "pool", "cap"), [*key, "label"], "left")
    cap, pool = (F.lit(None).cast("int"), F.lit(None).cast("string")) if pools is None else (F.col("cap"),
        F.col("pool"))
    g = pooled.groupBy(*key, "provenance", pool.alias("pool")).agg(F.sum("marks").alias("s"), F.max(cap).alias("cap"))
    sums = g.groupBy(*key, "provenance").agg(F.sum(F.when(F.col("pool").isNull(),
        F.col("s")).otherwise(F.least("s", "cap"))).alias("sum"))
    out = totals.join(sums, key, "left")
    printed = F.when(F.col("provenance") == "preferred", F.col("preferred")).otherwise(F.col("fallback"))
    total = F.coalesce("sum", F.lit(0))
    return points, out.select(*key, "provenance", printed.alias("printed"), total.alias("sum"),
        F.coalesce(printed == total, F.lit(False)).alias("verified"))


def scheme_elements(questions: DataFrame, points: DataFrame) -> DataFrame:
    """Canonical elements of a scheme: for each question a heading, its printed total, guidance, then its points.

    questions: doc_id, number, printed, verified, guidance; points: doc_id, number, ord, label, marks, text, allow,
    reject, ignore, notes, page.  (doc_id, ord, element_id, role, text, page, group_key); a question's page is its
    points' first, 1 without any.
    """
    q = questions.join(points.groupBy("doc_id", "number").agg(F.min("page").alias("page")), ["doc_id", "number"],
        "left").withColumn("page", F.coalesce("page", F.lit(1)))
    s = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs])
    n = F.col("number")
    row = lambda place, at, role, text: F.struct(F.lit(place).alias("place"), at.alias("at"), F.lit(role).alias("role"),
        text.alias("text"))
    heads = F.array(row(0, F.lit(0), "heading", s("Mark scheme for Question ", n)),
                    F.when(F.col("printed").isNotNull(), row(1, F.lit(0), "paragraph",
                    s("Question ", n, " printed total: ", F.col("printed"), " marks",
                    F.when(F.col("verified"), "").otherwise(" (verification FAILED)")))))
    guidance = F.transform(F.coalesce("guidance", F.array().cast("array<string>")), lambda g,
        i: F.struct(F.lit(2).alias("place"), i.alias("at"), F.lit("paragraph").alias("role"),
        s("Q", n, " guidance: ", g).alias("text")))
    head = q.select("doc_id", "number", "page", F.explode(F.concat(F.array_compact(heads),
        guidance)).alias("r")).select("doc_id", "number", "page", "r.*")
    listed = [F.when(F.size(k) > 0, s("\n", k, ": ", F.array_join(k, "; "))).otherwise("")
        for k in ("allow", "reject", "ignore")]
    notes = F.array_join(F.transform(F.coalesce("notes", F.array().cast("array<string>")), lambda x: s("\nnote: ", x)), "")
    text = F.concat(s("Q", n, " ", F.coalesce("label", F.lit("")), " (", F.coalesce("marks", F.lit(0)), " mark",
        F.when(F.coalesce("marks", F.lit(0)) == 1, "").otherwise("s"), "): ", F.coalesce("text", F.lit(""))), *listed, notes)
    body = points.select("doc_id", "number", F.coalesce("page", F.lit(1)).alias("page"), F.lit(3).alias("place"),
        F.col("ord").cast("int").alias("at"), F.lit("mark_point").alias("role"), text.alias("text"))
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("number", "place", "at")) - 1
    rows = head.unionByName(body).withColumn("ord", place)
    return rows.select("doc_id", "ord", F.concat(F.lit("e"),
        F.lpad(F.col("ord").cast("string"), 6, "0")).alias("element_id"), "role", "text", "page",
        s("q", n).alias("group_key"))


def atoms(documents: DataFrame, questions: DataFrame, parts: DataFrame, points: DataFrame, references: DataFrame,
        files: DataFrame) -> DataFrame:
    """The validator of atoms: schema, closure, census and assets in both directions.

    questions: doc_id, number, total, sum; parts: doc_id, number, part_id, marks; points: doc_id, number, marks, text;
    references and files: doc_id, path.
      schema        nulls where a value must be, marks below nought (one finding for each row),
      closure       parts with marks all known must make the question's total, and so must the points' sum,
      census        numbers are 1 to n and no part id comes twice,
      assets        a reference without a file, and a file that nothing refers to.
    """
    at = F.concat_ws("/", "doc_id", F.col("number").cast("string"))
    bad = lambda c: F.coalesce(F.col(c) < 0, F.lit(False))
    out = [
        gates.findings(questions.where(F.col("number").isNull() | bad("total")), at, "schema:question", "fail",
        F.col("total")),
        gates.findings(parts.where(F.col("part_id").isNull() | bad("marks")), at, "schema:part", "fail",
        F.col("part_id")),
        gates.findings(points.where(F.col("marks").isNull() | bad("marks")
        | (F.coalesce(F.trim("text"), F.lit("")) == "")), at, "schema:point", "fail", F.col("text"))]
    known = parts.groupBy("doc_id", "number").agg(F.sum("marks").alias("made"),
        F.count_if(F.col("marks").isNull()).alias("open"))
    whole = questions.join(known, ["doc_id", "number"]).where((F.col("open") == 0)
        & ~F.col("made").eqNullSafe(F.col("total")))
    out.append(gates.findings(whole, at, "closure:parts", "fail", F.concat_ws("/", "made", "total")))
    out.append(gates.findings(questions.where(~F.col("sum").eqNullSafe(F.col("total"))), at, "closure:points", "fail",
        F.concat_ws("/", "sum", "total")))
    order = _per_document(documents, gates.continuity(questions, "doc_id", "number")).where(~F.coalesce("continuous",
        F.lit(False)))
    out.append(gates.findings(order, F.col("doc_id"), "census:numbers", "fail", F.col("n")))
    out.append(gates.findings(gates.repeated_keys(parts.dropna(subset=["part_id"]), ["doc_id", "part_id"]),
        F.concat_ws("/", "doc_id", "part_id"), "census:parts", "fail", F.col("count")))
    key = ["doc_id", "path"]
    place = F.concat_ws("/", *key)
    out.append(gates.findings(references.distinct().join(files, key, "left_anti"), place, "assets:missing", "fail",
        F.lit("")))
    out.append(gates.findings(files.distinct().join(references, key, "left_anti"), place, "assets:unused", "review",
        F.lit("")))
    return gates.all_findings(out)


def corpus(pairs: DataFrame, manifest: DataFrame, files: DataFrame, anchors: DataFrame) -> DataFrame:
    """The check of a corpus: every pair has both files, files are as the manifest says, cleaned files have their raw one.

    pairs: key, qp, ms (paths, null if missing); manifest and files: path, sha256; anchors: path, raw_path.
    """
    from foliant.operators.corpus import verify_files

    lone = pairs.where(F.col("qp").isNull() | F.col("ms").isNull())
    listed = files.select(F.col("path").alias("raw_path")).distinct()
    adrift = anchors.join(listed, "raw_path", "left_anti")
    moved = verify_files(manifest, files)
    return gates.all_findings([
        gates.findings(lone, F.col("key"), "pair", "fail",
        F.when(F.col("qp").isNull(), "no paper").otherwise("no scheme")),
        gates.findings(moved, F.col("path"), "file", F.when(F.col("problem") == "stray", "review").otherwise("fail"),
        F.col("problem")),
        gates.findings(adrift, F.col("path"), "anchor", "fail", F.col("raw_path"))])
