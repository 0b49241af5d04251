"""From elements to retrieval: chunks, series, ungated questions and line-wise mark points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.functions.text import estimated_tokens, strip
from foliant.operators import lines

# Series names, and line formats of free mark schemes and papers.
SERIES_WORDS = (("january", "JAN"), ("june", "JUN"), ("summer", "JUN"), ("november", "NOV"))
SERIES_MONTHS = {"1": "JAN", "01": "JAN", "6": "JUN", "06": "JUN", "11": "NOV"}
ROMAN = r"i{1,3}|iv|vi{1,3}|v|ix|x"
NOISE = r"(?i)^(Turn over|BLANK PAGE|Advice|TOTAL FOR PAPER.*|Paper Reference.*|Questions and answers.*|You must have.*|There are.*questions.*|Answer ALL questions.*)\s*$"
TOTAL = r"(?i)[(*\s]*Total for Question\s+\d{1,2}\s*=\s*\d{1,3}\s*marks[^)]*\)?"


def chunks(elements: DataFrame, target: int = 300, most: int = 800) -> DataFrame:
    """(doc_id, chunk, content, content_sha256, page_start, page_end, element_ids, tokens) of elements with page and group_key.

    Elements go by page, order and id; blank ones are left out; a change of group closes a chunk.
    """
    used = elements.withColumn("text", strip(F.col("text"))).where("text <> ''").select("doc_id", "page", "ord",
        "element_id", "text", "group_key")
    packed = lines.pack_chunks(used, "doc_id", ["page", "ord", "element_id"], estimated_tokens(F.col("text")), target,
        most, "group_key")
    rows = F.sort_array(F.collect_list(F.struct("page", "ord", "element_id", "text")))
    g = packed.groupBy("doc_id", "chunk").agg(rows.alias("r"), F.min("page").alias("page_start"),
        F.max("page").alias("page_end"), F.sum(estimated_tokens(F.col("text"))).alias("tokens"))
    content = F.array_join(F.transform("r", lambda x: x.text), "\n")
    return g.select("doc_id", "chunk", content.alias("content"), F.sha2(content, 256).alias("content_sha256"),
        "page_start", "page_end", F.transform("r", lambda x: x.element_id).alias("element_ids"), "tokens")


def series(printed: Column, normalised: Column) -> Column:
    """struct(series, year): JAN, JUN or NOV by word or month number, else null; the year is given either way."""
    months = F.create_map(*[F.lit(x) for kv in SERIES_MONTHS.items() for x in kv])

    def of(c: Column) -> Column:
        low = F.lower(F.coalesce(c, F.lit("")))
        word = F
        for w, v in SERIES_WORDS:
            word = word.when(F.contains(low, F.lit(w)), F.lit(v))
        after = F.element_at(months, F.regexp_extract(low, r"(?:^|-)\d{4}-(\d{1,2})(?:-|$)", 1))
        before = F.element_at(months, F.regexp_extract(low, r"(?:^|-)(\d{1,2})-\d{4}(?:-|$)", 1))
        return F.coalesce(word.otherwise(F.lit(None)), after, before)

    year = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"\b(19\d{2}|20\d{2})\b", 1),
        F.lit("")).cast("int")
    return F.struct(F.coalesce(of(printed), of(normalised)).alias("series"),
        F.coalesce(year(printed), year(normalised)).alias("year"))


def loose_questions(rows: DataFrame) -> DataFrame:
    """(doc_id, island, number, text, marks, confidence): a numbered line opens a question, whatever number came before.

    rows: doc_id, line_no, raw.  Marks are the trailing (n) of its lines, summed; no window leaves a document.
    """
    clean = rows.withColumn("t", strip(F.col("raw"))).where(f"t <> '' and not (t rlike r'{NOISE}')")
    opens = F.col("t").rlike(r"^\*?\d{1,2}[.:]?\s+\S")
    marked = lines.islands(clean, "doc_id", ["line_no"], opens).where("island > 0")
    marks = F.sum(F.regexp_extract("t", r"\((\d{1,2})\)\s*$", 1).try_cast("int"))
    g = marked.groupBy("doc_id", "island").agg(F.sort_array(F.collect_list(F.struct("line_no", "t"))).alias("r"),
        marks.alias("marks"))
    first = F.col("r")[0]["t"]
    return g.select("doc_id", "island", F.regexp_extract(first, r"^\*?(\d{1,2})", 1).cast("int").alias("number"),
        F.array_join(F.transform("r", lambda x: x.t), "\n").alias("text"), "marks",
        F.when(F.col("marks").isNull(), 0.5).otherwise(0.7).alias("confidence"))


def loose_points(rows: DataFrame) -> DataFrame:
    """(doc_id, line_no, ref, ordinal, text, marks, confidence): mark points of line-wise schemes.

    A line gives its question, letter and roman, or carries on from the last ones: a roman the letter, M2 the whole
    reference, (b) the question.  Marks default to 1.
    """
    t = strip(F.regexp_replace(F.col("raw"), TOTAL, ""))
    clean = rows.withColumn("t", t).where(f"t <> '' and not (t rlike r'{NOISE}')")
    forms = [
        ("spaced", rf"^(\d{{1,2}})\s+([a-h])\s+(?:({ROMAN})\s+)?(?:M\d\s+)?(.*)$"),
        ("paren", rf"^(\d{{1,2}})\s*\(([a-h])\)(?:\(({ROMAN})\))?\s*(.*)$"),
        ("roman", rf"^()()({ROMAN})\s+(?:M\d\s+)?(.*)$"), ("more", r"^()()()M\d\s+(.*)$"),
        ("letter", r"^()\(([a-h])\)()\s*(.*)$"), ("bare", r"^(\d{1,2})()()\s+(?:M\d\s+)?(.+)$")]
    kind, pick = F, []
    for name, rx in forms:
        kind = kind.when(F.col("t").rlike(rx), F.lit(name))
    marked = clean.withColumn("kind", kind.otherwise(F.lit(None))).where("kind is not null")
    for i in range(4):
        c = F
        for name, rx in forms:
            c = c.when(F.col("kind") == name, F.regexp_extract("t", rx, i + 1))
        pick.append(F.nullif(c, F.lit("")))
    got = marked.withColumns({"q": pick[0], "p": pick[1], "r": pick[2], "body": strip(F.coalesce(pick[3], F.lit("")))})
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    number = got.withColumn("q", F.coalesce("q", F.last_value("q", F.lit(True)).over(w)))
    base = number.withColumn("base", F.when(F.col("kind").isin("spaced", "paren", "letter") & F.col("q").isNotNull(),
        F.concat_ws("-", "q", "p")))
    carried = base.withColumn("base", F.coalesce("base", F.last_value("base", F.lit(True)).over(w)))
    own = F.when(F.col("kind") == "bare", F.col("q")).when(F.col("kind") == "more",
        None).when(F.col("base").isNotNull(), F.concat_ws("-", "base", "r"))
    referred = carried.withColumn("ref", own).withColumn("ref",
        F.when(F.col("kind") == "more", F.last_value("ref",
        F.lit(True)).over(before)).otherwise(F.col("ref"))).where("ref is not null and body <> ''")
    said = F.coalesce(*[F.nullif(F.regexp_extract("body", rx, 1), F.lit(""))
        for rx in (r"=(\d)(?:\s|$)", r"\((\d)\)(?:\s|$)", r"(?i)(?:^|\s)(\d)\s*marks?(?:\s|$)")]).cast("int")
    said = F.when(said > 0, said)
    n = F.row_number().over(W.partitionBy("doc_id", "ref").orderBy("line_no"))
    return referred.select("doc_id", "line_no", "ref", n.alias("ordinal"), F.col("body").alias("text"),
        F.coalesce(said, F.lit(1)).alias("marks"), F.when(said.isNull(), 0.55).otherwise(0.7).alias("confidence"))


def cell_lines(elements: DataFrame) -> DataFrame:
    """(doc_id, ord, cell, line, text): the printed lines of tables' cells, in reading order, blank ones left out."""
    cells = elements.where("kind = 'table'").select("doc_id", "ord",
        F.posexplode(F.flatten("rows")).alias("cell", "said"))
    return cells.select("doc_id", "ord", "cell",
        F.posexplode(F.split("said", "\n")).alias("line", "text")).withColumn("text",
        strip(F.col("text"))).where("text <> ''")


def line_stream(elements: DataFrame) -> DataFrame:
    """(doc_id, line_no, raw): texts, and rows of tables as their cells set apart by a blank, as one stream of lines."""
    texts = F.when(F.col("kind") == "table", F.transform("rows",
        lambda r: F.regexp_replace(F.array_join(r, " "), r"\s+", " "))).otherwise(F.split(F.coalesce("text", F.lit("")), "\n"))
    rows = elements.select("doc_id", "ord", F.posexplode(texts).alias("at", "raw")).withColumn("raw",
        strip(F.col("raw"))).where("raw <> ''")
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("ord", "at")) - 1
    return rows.withColumn("line_no", place).select("doc_id", "line_no", "raw")
