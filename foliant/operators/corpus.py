"""Keeping a corpus: planned edits, ledgers, checks of files against manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.identity import set_id

# Addresses of images in markdown.
IMAGE = r"(?:!\[[^\]]*\]\(([^)\s]+)|<img[^>]+src=['\"]([^'\"]+))"


def image_urls(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, url): each address that a text refers to, once."""
    found = F.concat(F.regexp_extract_all(text, F.lit(IMAGE), F.lit(1)),
        F.regexp_extract_all(text, F.lit(IMAGE), F.lit(2)))
    return docs.select(key, F.explode(F.array_distinct(F.filter(found, lambda x: x != ""))).alias("url"))


def rewrite_urls(docs: DataFrame, mapping: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with addresses replaced by local paths; mapping: key, url, path.  The longest address goes first."""
    pairs = mapping.groupBy(key).agg(F.sort_array(F.collect_list(F.struct((-F.length("url")).alias("n"), "url",
        "path"))).alias("_m"))
    joined = docs.join(pairs, key, "left")
    none = F.array().cast("array<struct<n:int,url:string,path:string>>")
    return joined.withColumn(text, F.aggregate(F.coalesce("_m", none), F.col(text), lambda s,
        x: F.replace(s, x.url, x.path))).drop("_m")


def plan_removal(docs: DataFrame, removals: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(edited docs, violations): a line that is nothing but a removed reference goes; one that only holds it is a violation.

    removals: key, url.  Nothing should be written while there are violations.
    """
    urls = removals.groupBy(key).agg(F.collect_set("url").alias("_u"))
    joined = docs.join(urls, key, "left").withColumn("_u", F.coalesce("_u", F.array().cast("array<string>")))
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"</?div[^>]*>", ""),
        r"^!\[[^\]]*\]\(|^<img[^>]+src=['\"]|['\"][^>]*/?>\s*$|\)\s*$", ""))
    holds = lambda x: F.exists("_u", lambda u: F.contains(x, u))
    pure = lambda x: F.exists("_u", lambda u: bare(x) == u)
    rows = joined.withColumn("_l", F.split(text, "\n"))
    edited = rows.withColumn(text, F.array_join(F.filter("_l", lambda x: ~pure(x)), "\n")).drop("_l", "_u")
    broken = rows.select(key, F.explode(F.filter("_l", lambda x: holds(x) & ~pure(x))).alias("line"))
    return edited, broken


def batch_id(deletions: DataFrame, column: str) -> DataFrame:
    """(batch_id, n): one id for a set of planned deletions, whatever their order."""
    return deletions.agg(set_id(F.collect_set(column)).alias("batch_id"), F.countDistinct(column).alias("n"))


def verify_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem): missing, changed (by checksum) and stray files."""
    m = manifest.select("path", F.col("sha256").alias("a"), F.lit(1).alias("im"))
    f = files.select("path", F.col("sha256").alias("b"), F.lit(1).alias("if"))
    problem = F.when(F.col("if").isNull(), "missing").when(F.col("im").isNull(),
        "stray").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return m.join(f, "path", "full_outer").withColumn("problem", problem).where("problem is not null").select("path",
        "problem")


def orphans(references: DataFrame, *ledgers: DataFrame) -> DataFrame:
    """(key.., url) that no ledger of known or removed addresses has."""
    known = ledgers[0].select("url")
    for x in ledgers[1:]:
        known = known.union(x.select("url"))
    return references.join(known.distinct(), "url", "left_anti")


def intake_pairs(records: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pairs, set aside) of records with kind (qp, ms or insert), sha256 and file.

    Copies by content are dropped first, the first file staying.  A key with one paper and one scheme is a pair; else
    its records are set aside as UNPAIRED or DUAL_COPY, inserts as INSERT.
    """
    one = records.groupBy(*key, "kind", "sha256").agg(F.min("file").alias("file"))
    main = one.where("kind in ('qp', 'ms')")
    g = main.groupBy(*key).agg(F.count_if(F.col("kind") == "qp").alias("nq"),
        F.count_if(F.col("kind") == "ms").alias("nm"), F.min(F.when(F.col("kind") == "qp", F.col("file"))).alias("qp"),
        F.min(F.when(F.col("kind") == "ms", F.col("file"))).alias("ms"))
    ok = g.where("nq = 1 and nm = 1").select(*key, "qp", "ms")
    reason = F.when((F.col("nq") > 1) | (F.col("nm") > 1), "DUAL_COPY").otherwise("UNPAIRED")
    bad = main.join(g.where("not (nq = 1 and nm = 1)").select(*key, reason.alias("reason")), key).select(*key, "kind",
        "file", "reason")
    return ok, bad.union(one.where("kind = 'insert'").select(*key, "kind", "file", F.lit("INSERT")))


def stable(runs: DataFrame, key: list[str], content: str) -> DataFrame:
    """(key.., n_runs, n_variants, stable): whether repeated runs gave the same content."""
    return runs.groupBy(*key).agg(F.count(F.lit(1)).alias("n_runs"),
        F.countDistinct(F.sha2(content, 256)).alias("n_variants")).withColumn("stable", F.col("n_variants") == 1)


def rollback(current: DataFrame, before: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """current with the columns put back to their before-images where there are any."""
    old = before.select(key, F.struct(*columns).alias("_b"))
    joined = current.join(old, key, "left")
    return joined.withColumns({c: F.when(F.col("_b").isNotNull(), F.col(f"_b.{c}")).otherwise(F.col(c))
        for c in columns}).select(*current.columns)


#: Rows of windows of items that are sent to every executor, some 50 MB; beyond that, documents' windows are shuffled.
SENT = 1_000_000


def shared_passages(docs: DataFrame, items: DataFrame, key: str, item: str, size: int = 8,
        text: str = "text") -> DataFrame:
    """(key, item, n_hits): how many different windows of `size` words of an item a document holds.

    Words are lower-cased and parted by any white space; windows overlap; an item of fewer words is one window.  Two
    hashes, 128 bits together, stand for a window.  Documents look their windows up in the items', where these are few
    enough to be sent, so that neither texts nor windows are shuffled.
    """
    bare = lambda c: F.array_remove(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[\x20\x09-\x0D]+"), "")

    def windows(n: int) -> Column:
        words = lambda i: [F.element_at("_w", i + k) for k in range(n)]
        both = F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1),
            lambda i: F.struct(F.xxhash64(*words(i)).alias("a"), F.xxhash64(F.lit("second"), *words(i)).alias("b")))
        return F.when(F.size("_w") >= n, both).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))

    own = items.select(item, bare(F.col(text)).alias("_w")).withColumn("_n", F.least(F.size("_w"), F.lit(size)))
    sizes = sorted(r[0] for r in own.where("_n > 0").select("_n").distinct().collect())  # at most `size`
    split = docs.select(key, bare(F.col(text)).alias("_w"))
    out = None
    for n in sizes:
        held = split.select(key, F.explode(windows(n)).alias("_g")).select(key, "_g.*")
        of = own.where(F.col("_n") == n).select(item, F.explode(windows(n)).alias("_g")).select(item, "_g.*").distinct()
        few = of.limit(SENT + 1).count() <= SENT
        found = held.join(F.broadcast(of) if few else of, ["a", "b"]).select(key, item, "a", "b").distinct()
        out = found if out is None else out.union(found)
    if out is None:
        return docs.select(key, F.lit(None).cast(dict(items.dtypes)[item]).alias(item),
            F.lit(0).cast("long").alias("n_hits")).limit(0)
    return out.groupBy(key, item).agg(F.count(F.lit(1)).alias("n_hits"))
