"""Queries over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import identity, text
from foliant.operators import corpus, gates, lines, reconcile
from foliant.plans.registry import query, table

_WORDS = "list_sort([{}], lambda x: -length(x))"
_COMMANDS = "|".join(w for w, _ in text.command_words())
_TIERS = " ".join(f"WHEN w IN ({', '.join(repr(x) for x in ws)}) THEN '{t}'" for t,
    ws in (("low", text.LOW), ("middle", text.MIDDLE), ("high", text.HIGH)))


@query(r"""
WITH h AS (SELECT doc_id, sha256(text) AS checksum, sha256('sha256:' || sha256(text) || '|engine:foliant|version:1') AS h FROM documents)
SELECT doc_id, checksum, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
  || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS document_id FROM h
""")
def doc_identity(spark: SparkSession, d: str) -> DataFrame:
    sha = F.sha2("text", 256)
    return table(spark, d, "documents").select("doc_id", sha.alias("checksum"),
        identity.document_id(sha, F.lit("foliant"), F.lit("1")).alias("document_id"))


@query(r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(list_filter(ls, lambda x: trim(x) = '')) AS BIGINT) AS n_blank,
  CAST(list_max(list_transform(ls, lambda x: length(x))) AS INTEGER) AS longest FROM l
""")
def line_explode_stats(spark: SparkSession, d: str) -> DataFrame:
    ls = table(spark, d, "documents").select("doc_id", lines.split_lines(F.col("text")).alias("ls"))
    return ls.select("doc_id", F.size("ls").cast("long").alias("n_lines"),
        F.size(F.filter("ls", lambda x: F.trim(x) == "")).cast("long").alias("n_blank"),
        F.array_max(F.transform("ls", lambda x: F.length(x))).alias("longest"))


_DECODED = "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&amp;', '&')"


@query(f"""
SELECT page_id, {_DECODED.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title FROM pages
""")
def entity_decode_pages(spark: SparkSession, d: str) -> DataFrame:
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return table(spark, d, "pages").select("page_id", text.decode_entities(title).alias("title"))


@query(r"""
SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1,
  starts_with(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title_leads FROM pages
""")
def html_title_h1_extract(spark: SparkSession, d: str) -> DataFrame:
    title, h1 = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1), F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    return table(spark, d, "pages").select("page_id", title.alias("title"), h1.alias("h1"),
        h1.startswith(title).alias("title_leads"))


@query(r"""
WITH i AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS xs FROM pages)
SELECT page_id, CAST(unnest(range(0, len(xs))) AS INTEGER) AS item, unnest(list_transform(xs, lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g')))) AS text FROM i
""")
def html_list_items(spark: SparkSession, d: str) -> DataFrame:
    items = F.regexp_extract_all("html", F.lit("(?s)<li>(.*?)</li>"), F.lit(1))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(items).alias("item", "raw"))
    return rows.select("page_id", "item", F.trim(F.regexp_replace("raw", "<[^>]+>", "")).alias("text"))


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages
""")
def html_strip_text(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("html", "(?s)<(script|style)[^>]*>.*?</(script|style)>", " "),
        "(?s)<[^>]+>", " ")
    return table(spark, d, "pages").select("page_id", F.trim(F.regexp_replace(bare, r"\s+", " ")).alias("plain"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(range(0, len(ls))) AS line_no, unnest(ls) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
m AS (SELECT *, length(raw) BETWEEN 1 AND 40 AS h, sum(CASE WHEN length(raw) BETWEEN 1 AND 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS s FROM l)
SELECT doc_id, CAST(s AS BIGINT) AS section, max(CASE WHEN h THEN raw END) AS heading, CAST(min(line_no) AS INTEGER) AS first_line, count(CASE WHEN NOT h AND trim(raw) <> '' THEN 1 END) AS n_lines,
  coalesce(string_agg(CASE WHEN NOT h AND trim(raw) <> '' THEN raw END, chr(10) ORDER BY line_no), '') AS body FROM m WHERE s > 0 GROUP BY doc_id, s
""")
def page_sections(spark: SparkSession, d: str) -> DataFrame:
    return lines.sections(table(spark, d, "documents"), "doc_id", lambda x: F.length(x).between(1, 40))


@query(r"""
WITH m AS (SELECT doc_id, text, replace(replace(replace(replace(text, 'ble', '{1}'), 'th', '{2}'), 'é', 'e'), '|', '') AS a FROM documents)
SELECT doc_id, replace(replace(a, '{1}', 'BLE'), '{2}', 'T') AS mapped, length(replace(replace(a, '{1}', 'BLE'), '{2}', 'T')) - length(text) AS delta FROM m
""")
def char_map_normalise(spark: SparkSession, d: str) -> DataFrame:
    mapped = text.map_chars(F.col("text"), {"ble": "BLE", "th": "T", "é": "e", "|": ""})
    docs = table(spark, d, "documents").select("doc_id", "text", mapped.alias("mapped"))
    return docs.select("doc_id", "mapped", (F.length("mapped") - F.length("text")).cast("long").alias("delta"))


@query(r"""
WITH c AS (SELECT unnest(regexp_extract_all(text, '[^\x00-\x7F]')) AS ch FROM documents)
SELECT ch, count(*) AS n, unicode(ch) AS code_point FROM c GROUP BY ch
""")
def artifact_census(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[^\x00-\x7F]"),
        F.lit(0))).alias("ch"))
    return found.groupBy("ch").agg(F.count(F.lit(1)).alias("n")).withColumn("code_point", F.ascii("ch"))


@query(r"""
WITH t AS (SELECT 'all' AS batch, count(*) AS n_texts, sum(len(regexp_extract_all(text, '[\x{E000}-\x{F8FF}]'))) AS n_private,
  sum(len(regexp_extract_all(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]'))) AS n_controls FROM documents)
SELECT batch, n_texts, CAST(n_private AS BIGINT) AS n_private, CAST(n_controls AS BIGINT) AS n_controls, n_private + n_controls = 0 AS passed FROM t
""")
def intake_gate(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select(F.size(text.private_use(F.col("text"))).alias("p"),
        F.size(text.controls(F.col("text"))).alias("c"))
    g = t.agg(F.count(F.lit(1)).alias("n_texts"), F.sum("p").alias("n_private"), F.sum("c").alias("n_controls"))
    return g.select(F.lit("all").alias("batch"), "n_texts", "n_private", "n_controls",
        ((F.col("n_private") + F.col("n_controls")) == 0).alias("passed"))


_SENTENCES = r"string_split(regexp_replace({}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


@query(rf"""
WITH c AS (SELECT conv_id, turn, role, 'State ' || text AS t FROM conversations WHERE turn % 3 = 0 UNION ALL SELECT conv_id, turn, role, text || '. Show that ' || role FROM conversations WHERE turn % 3 <> 0),
s AS (SELECT conv_id, turn, role, list_filter(list_transform({_SENTENCES.format("trim(t)")}, lambda x: regexp_extract(lower(trim(x)), '^({_COMMANDS})(?:[ ,]|$)', 1)), lambda w: w <> '')[1] AS w FROM c)
SELECT conv_id, turn, w AS command_word, CASE {_TIERS} END AS tier FROM s
""")
def command_words(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("State "), "text")).otherwise(F.concat("text",
        F.lit(". Show that "), "role"))
    found = table(spark, d, "conversations").select("conv_id", "turn", text.command_word(t).alias("command_word"))
    return found.withColumn("tier", text.command_tier(F.col("command_word")))


@query(rf"""
WITH s AS (SELECT doc_id, trim({_SENTENCES.format("trim(text)")}[1]) AS f FROM documents)
SELECT doc_id, CASE WHEN length(f) <= 200 THEN f ELSE trim(regexp_replace(substr(f, 1, 200), '(?s) [^ ]*$', '')) END AS hint FROM s
""")
def first_sentence_hint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.summary_hint(F.col("text")).alias("hint"))


@query(r"""
WITH t AS (SELECT conv_id, turn, (ARRAY['Do not accept: ', 'Allow ', 'IGNORE - ', 'Reject ', ''])[1 + turn % 5] || text AS t FROM conversations)
SELECT conv_id, turn, CASE WHEN lower(t) LIKE 'do not accept%' OR lower(t) LIKE 'do not allow%' OR lower(t) LIKE 'reject%' THEN 'reject'
  WHEN lower(t) LIKE 'accept%' OR lower(t) LIKE 'allow%' THEN 'allow' WHEN lower(t) LIKE 'ignore%' THEN 'ignore' ELSE 'notes' END AS kind,
  regexp_replace(t, '(?i)^(?:do not accept|do not allow|reject|accept|allow|ignore)[ :—-]*', '') AS note FROM t
""")
def note_classifier(spark: SparkSession, d: str) -> DataFrame:
    lead = F.element_at(F.array(*[F.lit(x) for x in ("Do not accept: ", "Allow ", "IGNORE - ", "Reject ", "")]),
        (F.col("turn") % 5 + 1).cast("int"))
    t = F.concat(lead, "text")
    return table(spark, d, "conversations").select("conv_id", "turn", text.note_kind(t).alias("kind"),
        text.note_text(t).alias("note"))


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(text, '\.', ' (' || (1 + doc_id % 9) || ')', 'g') AS t FROM documents),
s AS (SELECT doc_id, string_split_regex(t, '\([0-9]{1,2}\)') AS xs, regexp_extract_all(t, '\(([0-9]{1,2})\)', 1) AS ms FROM t),
e AS (SELECT doc_id, unnest(range(1, len(xs) + 1)) AS i, unnest(xs) AS raw, unnest(list_resize(ms, len(xs))) AS m FROM s WHERE len(ms) > 0),
k AS (SELECT doc_id, i, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS raw, m FROM e),
f AS (SELECT doc_id, i, raw, m FROM k WHERE raw <> ''),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS o, count(m) OVER (PARTITION BY doc_id) AS c FROM f)
SELECT doc_id, CAST(o AS INTEGER) AS ordinal, raw, CAST(m AS INTEGER) AS marks FROM n WHERE c > 0
""")
def marker_split(spark: SparkSession, d: str) -> DataFrame:
    t = F.regexp_replace(F.col("text"), F.lit(r"\."),
        F.concat(F.lit(" ("), (F.col("doc_id") % 9 + 1).cast("string"), F.lit(")")))
    rows = table(spark, d, "documents").select("doc_id", F.explode(text.split_marks(t)).alias("p"))
    return rows.select("doc_id", "p.ordinal", "p.raw", "p.marks")


@query(r"""
WITH p AS (SELECT doc_id, list_transform(string_split_regex(text, '(?i)\bor\b'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS xs FROM documents)
SELECT doc_id, len(xs[1]) AS lead_chars, CAST(len(list_filter(xs[2:], lambda x: x <> '')) AS INTEGER) AS n_alternatives FROM p
""")
def alternatives_split(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "documents").select("doc_id", text.alternatives(F.col("text")).alias("a"))
    return found.select("doc_id", F.length(F.get("a", F.lit(0))).cast("long").alias("lead_chars"),
        (F.size("a") - 1).alias("n_alternatives"))


@query("""
SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS owner_turn FROM conversations
""")
def carry_forward_owner(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return reconcile.asof_owner(rows, "conv_id", "turn", F.col("role") == "user", F.col("turn"), "owner_turn")


@query("""
SELECT sha256(text) AS digest, min(doc_id) AS kept, count(*) AS n_copies FROM documents GROUP BY sha256(text)
""")
def dup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.first_copies(table(spark, d, "documents"), F.sha2("text", 256), "doc_id")


@query(r"""
WITH f AS (SELECT regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://(www\.|m\.|blog\.)?', ''), '[0-9]+(\.html)?/?$', '') AS fingerprint, CASE WHEN starts_with(url, 'https') THEN 's' ELSE 'p' END AS role, url FROM pages),
g AS (SELECT fingerprint, min(CASE WHEN role = 's' THEN url END) AS a, min(CASE WHEN role = 'p' THEN url END) AS b, count(CASE WHEN role = 's' THEN 1 END) AS na, count(CASE WHEN role = 'p' THEN 1 END) AS nb FROM f GROUP BY fingerprint)
SELECT fingerprint, CASE WHEN na = 1 AND nb = 1 THEN a END AS first, CASE WHEN na = 1 AND nb = 1 THEN b END AS second, CASE WHEN na = 1 AND nb = 1 THEN 'paired' WHEN na > 1 OR nb > 1 THEN 'ambiguous' ELSE 'unpaired' END AS status FROM g
""")
def fingerprint_pairing(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), r"^https?://(www\.|m\.|blog\.)?",
        ""), r"[0-9]+(\.html)?/?$", "")
    role = F.when(F.col("url").startswith("https"), "s").otherwise("p")
    return reconcile.unique_pairs(table(spark, d, "pages"), bare, role, "url", ("s", "p"))


@query("""
WITH c AS (SELECT conv_id, turn, role, greatest(1, (length(text) + 3) // 4) AS t FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM c),
r AS (WITH RECURSIVE p AS (
  SELECT conv_id, turn, i, t AS s, t > 800 AS alone, 1 AS chunk FROM o WHERE i = 1
  UNION ALL SELECT o.conv_id, o.turn, o.i, CASE WHEN o.t > 800 OR p.alone OR p.s + o.t > 300 THEN o.t ELSE p.s + o.t END, o.t > 800,
    p.chunk + CASE WHEN o.t > 800 OR p.alone OR p.s + o.t > 300 THEN 1 ELSE 0 END FROM p JOIN o ON o.conv_id = p.conv_id AND o.i = p.i + 1) SELECT * FROM p)
SELECT conv_id, turn, CAST(chunk AS INTEGER) AS chunk FROM r
""")
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return lines.pack_chunks(rows, "conv_id", ["turn"], text.estimated_tokens(F.col("text"))).select("conv_id", "turn",
        "chunk")


@query("""
WITH c AS (SELECT conv_id, turn, role, greatest(1, (length(text) + 3) // 4) AS t FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM c),
r AS (WITH RECURSIVE p AS (
  SELECT conv_id, turn, role, i, t AS s, t > 800 AS alone, 1 AS chunk FROM o WHERE i = 1
  UNION ALL SELECT o.conv_id, o.turn, o.role, o.i, CASE WHEN o.role <> p.role OR o.t > 800 OR p.alone OR p.s + o.t > 300 THEN o.t ELSE p.s + o.t END, o.t > 800,
    p.chunk + CASE WHEN o.role <> p.role OR o.t > 800 OR p.alone OR p.s + o.t > 300 THEN 1 ELSE 0 END FROM p JOIN o ON o.conv_id = p.conv_id AND o.i = p.i + 1) SELECT * FROM p)
SELECT conv_id, turn, CAST(chunk AS INTEGER) AS chunk FROM r
""")
def chunk_pack_grouped(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return lines.pack_chunks(rows, "conv_id", ["turn"], text.estimated_tokens(F.col("text")),
        group="role").select("conv_id", "turn", "chunk")


@query(r"""
WITH v AS (SELECT list_distinct(flatten(list(regexp_extract_all(lower(text), '[a-zà-ÿ]+')))) AS ws FROM benchmark),
t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-zà-ÿ]+')) AS ts FROM documents),
m AS (SELECT doc_id, ts, list_filter(ts, lambda x: NOT list_contains(ws, x)) AS u FROM t, v)
SELECT doc_id, CAST(len(ts) AS INTEGER) AS n_tokens, CAST(len(u) AS INTEGER) AS n_ungrounded, len(u) = 0 AS grounded FROM m
""")
def token_grounding(spark: SparkSession, d: str) -> DataFrame:
    tokens = lambda: F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-ÿ]+"), F.lit(0)))
    known = table(spark, d, "benchmark").select(F.explode(tokens()).alias("w")).distinct().withColumn("hit", F.lit(1))
    docs = table(spark, d, "documents").select("doc_id", tokens().alias("ts"))
    rows = docs.select("doc_id", F.explode_outer("ts").alias("w")).join(known, "w", "left")
    g = rows.groupBy("doc_id").agg(F.count("w").cast("int").alias("n_tokens"),
        F.count_if(F.col("w").isNotNull() & F.col("hit").isNull()).cast("int").alias("n_ungrounded"))
    return g.withColumn("grounded", F.col("n_ungrounded") == 0)


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw FROM documents), g AS (SELECT raw, count(DISTINCT doc_id) AS n FROM l WHERE trim(raw) <> '' GROUP BY raw)
SELECT l.doc_id, count(*) AS n_lines, count(CASE WHEN g.n = 1 THEN 1 END) AS n_own, count(CASE WHEN g.n > 1 THEN 1 END) AS n_shared FROM l JOIN g USING (raw) GROUP BY l.doc_id
""")
def line_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.explode_lines(table(spark, d, "documents"), "doc_id").where(F.trim("raw") != "")
    per = rows.groupBy(F.sha2("raw", 256).alias("line"), "doc_id").agg(F.count(F.lit(1)).alias("c"))
    owners = per.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return per.join(owners, "line").groupBy("doc_id").agg(F.sum("c").alias("n_lines"),
        F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("c"))), F.lit(0)).alias("n_own"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("c"))), F.lit(0)).alias("n_shared"))


@query("""
WITH f AS (SELECT d.lang, CASE WHEN l.doc_id IS NULL THEN 'review' WHEN l.toxic = 1 THEN 'fail' WHEN l.quality = 0 THEN 'review' ELSE 'ok' END AS s FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT lang, CASE WHEN count(CASE WHEN s = 'fail' THEN 1 END) > 0 THEN 'fail' WHEN count(CASE WHEN s = 'review' THEN 1 END) > 0 THEN 'review' ELSE 'ok' END AS status,
  count(CASE WHEN s = 'ok' THEN 1 END) AS n_ok, count(CASE WHEN s = 'review' THEN 1 END) AS n_review, count(CASE WHEN s = 'fail' THEN 1 END) AS n_fail FROM f GROUP BY lang
""")
def severity_rollup(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "documents").select("doc_id",
        "lang").join(table(spark, d, "labels").withColumn("has", F.lit(1)), "doc_id", "left")
    severity = F.when(F.col("has").isNull(), "review").when(F.col("toxic") == 1, "fail").when(F.col("quality") == 0,
        "review").otherwise("ok")
    return gates.roll_up(joined.withColumn("severity", severity), ["lang"])


@query(r"""
WITH o AS (SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
n AS (SELECT doc_id, lang, source, CAST(length(regexp_replace(text, '\s+', ' ', 'g')) AS BIGINT) AS n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1),
j AS (SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
  CASE WHEN o.doc_id IS NULL OR n.doc_id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN o.lang IS DISTINCT FROM n.lang THEN 'lang' END, CASE WHEN o.source IS DISTINCT FROM n.source THEN 'source' END, CASE WHEN o.n_chars IS DISTINCT FROM n.n_chars THEN 'n_chars' END) END AS columns
  FROM o FULL OUTER JOIN n ON o.doc_id = n.doc_id)
SELECT doc_id, change, columns FROM j WHERE change <> 'changed' OR columns <> ''
""")
def revision_diff(spark: SparkSession, d: str) -> DataFrame:
    """The labelled documents against the documents without copies and with white space collapsed."""
    docs = table(spark, d, "documents")
    old = docs.select("doc_id", "lang", "source", "n_chars").join(table(spark, d, "labels").select("doc_id").distinct(),
        "doc_id", "left_semi")
    sized = docs.select("doc_id", "lang", "source",
        F.length(F.regexp_replace("text", r"\s+", " ")).cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("digest"))
    first = sized.groupBy("digest").agg(F.min_by(F.struct("doc_id", "lang", "source", "n_chars"),
        "doc_id").alias("r")).select("r.*")
    return gates.changes(old, first, "doc_id", ["lang", "source", "n_chars"])


@query(r"""
WITH w AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
s AS (SELECT item_id, least(len(ws), 8) AS k, unnest(list_distinct(list_transform(range(1, greatest(len(ws) - 6, 2)), lambda i: array_to_string(ws[i:i + 7], ' ')))) AS g FROM w WHERE len(ws) > 0),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g FROM d, (SELECT DISTINCT k FROM s))
SELECT doc_id, item_id, count(*) AS n_hits FROM g JOIN s USING (k, g) GROUP BY doc_id, item_id
""")
def leakage_guard(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark passages of eight words in a row, or whole shorter items, that documents hold, whatever the white space."""
    return corpus.shared_passages(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id")


@query(r"""
SELECT doc_id, regexp_replace(regexp_replace(lower(trim(source)), '^src', 'Source '), '\s+', ' ', 'g') AS series, len(regexp_extract_all(text, '\$')) // 2 AS inline_math,
  greatest(1, (length(text) + 3) // 4) AS tokens, md5(text) AS md5 FROM documents
""")
def retrieval_metadata(spark: SparkSession, d: str) -> DataFrame:
    series = F.regexp_replace(F.regexp_replace(F.lower(F.trim("source")), "^src", "Source "), r"\s+", " ")
    return table(spark, d, "documents").select("doc_id", series.alias("series"),
        F.floor(F.regexp_count("text", F.lit(r"\$")) / 2).cast("long").alias("inline_math"),
        text.estimated_tokens(F.col("text")).cast("long").alias("tokens"), F.md5("text").alias("md5"))
