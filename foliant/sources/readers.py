"""Sources as DataFrames: files of markdown, layout pages, revision notes, engine JSON, archives, images."""

from __future__ import annotations

import itertools
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import identity
from foliant.operators.perdoc import per_document

# Front-matter keys that a revision note must have, and the chunk kinds of an engine's JSON.
NOTE_KEYS = ("note_id", "title", "source", "path", "updated_at", "spec_point_ids", "spec_point_codes", "guided_study")
NOTE_ID = re.compile(r"rn_[A-Za-z0-9]+")
CHUNKS = {"heading": "heading", "paragraph": "paragraph", "list item": "list_item", "caption": "paragraph",
    "table": "table", "image": "figure", "picture": "figure", "formula": "equation"}


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, content) of files below path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter",
        pattern).load(path).select("path", "length", "content")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def layout_pages(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, page, text): pages parted by form feeds; an empty last page is dropped."""
    pages = F.split(F.col(text), "\f", -1)
    kept = F.when(F.element_at(pages, -1) == "", F.slice(pages, 1, F.size(pages) - 1)).otherwise(pages)
    return docs.select(key, F.posexplode(kept).alias("page", "text")).withColumn("page", F.col("page") + 1)


def archive(found: DataFrame, pattern: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of (path, content): file names that the pattern's groups describe, and the rest."""
    name = base_name(F.col("path"))
    read = found.withColumn("file", name).withColumn("sha256", F.sha2("content", 256)).drop("content")
    fits = F.col("file").rlike(f"^(?:{pattern})$")
    groups = [F.nullif(F.regexp_extract("file", pattern, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)]
    return read.where(fits).select("*", *groups), read.where(~fits).withColumn("reason", F.lit("name"))


def images(found: DataFrame) -> DataFrame:
    """Asset records of (path, content): id by digest, media type by content, size, and whether the name disagrees."""
    name = base_name(F.col("path"))
    said = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    mime = identity.mime(F.col("content"))
    kind = F.regexp_replace(mime, "^image/", "")
    return found.select(
        F.concat(F.lit("img:"), F.sha2("content", 256)).alias("asset_id"), "path", name.alias("source_name"),
        F.sha2("content", 256).alias("sha256"), mime.alias("mime_type"), said.alias("declared_format"),
        (kind != F.when(said == "jpg", "jpeg").otherwise(said)).alias("format_mismatch"),
        identity.size_of_image(F.col("content")).alias("size"))


def resolve_assets(refs: DataFrame, assets: DataFrame, key: list[str], ref: str) -> DataFrame:
    """refs with asset path: first by relative path, else by a base name that only one asset has; never outside the folder.

    assets have relative_path.  status is resolved, ambiguous, missing or rejected (absolute, or with ..).
    """
    bad = F.col(ref).startswith("/") | F.array_contains(F.split(ref, "[/\\\\]"), "..")
    by_path = assets.select(F.col("relative_path").alias(ref), F.col("relative_path").alias("_p")).distinct()
    by_name = assets.select("relative_path").distinct().groupBy(base_name(F.col("relative_path")).alias("_n")).agg(F.count(F.lit(1)).alias("_c"),
        F.min("relative_path").alias("_q"))
    joined = refs.withColumn("_n", base_name(F.col(ref))).join(by_path, ref, "left").join(by_name, "_n", "left")
    path = F.when(bad, None).otherwise(F.coalesce("_p", F.when(F.col("_c") == 1, F.col("_q"))))
    status = F.when(bad, "rejected").when(path.isNotNull(), "resolved").when(F.col("_c") > 1,
        "ambiguous").otherwise("missing")
    return joined.withColumn("asset_path", path).withColumn("status", status).select(*refs.columns, "asset_path",
        "status")


def _note(text: str | None) -> dict:
    """Front matter and body; every violation is listed."""
    lines = (text or "").split("\n")
    problems: list[str] = []
    meta: dict[str, str] = {}
    if lines[0].strip() != "---" or "---" not in [x.strip() for x in lines[1:]]:
        return {"meta": [], "body": text or "", "violations": ["front matter missing or not closed"]}
    end = next(k for k, x in enumerate(lines[1:], 1) if x.strip() == "---")
    for k, line in enumerate(lines[1:end], 2):
        name, colon, value = line.partition(":")
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if not colon:
            problems.append(f"line {k}: not a key and a value")
        elif name.strip() in meta:
            problems.append(f"repeated key {name.strip()}")
        else:
            v = value.strip()
            meta[name.strip()] = v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'" else v
    problems += [f"missing key {k}" for k in NOTE_KEYS if not meta.get(k)]
    if meta.get("note_id") and not NOTE_ID.fullmatch(meta["note_id"]):
        problems.append("note_id is not rn_ and letters or digits")
    if meta.get("updated_at") and not re.fullmatch(r"\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?",
        meta["updated_at"]):
        problems.append("updated_at is no ISO time")
    return {"meta": list(meta.items()), "body": "\n".join(lines[end + 1 :]).strip("\n"), "violations": problems}


def notes(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, meta, body, violations) of revision notes."""
    return per_document(docs, [F.col(key).cast("string"), text], lambda k, t: [{key: k} | _note(t)],
        f"{key} string, meta map<string,string>, body string, violations array<string>")


def inline_list(value: Column) -> Column:
    """["a", "b"] as an array; any other text as an array of itself."""
    return F.when(F.trim(value).startswith("["), F.from_json(value, "array<string>")).when(F.trim(value) != "",
        F.array(F.trim(value))).otherwise(F.array().cast("array<string>"))


def with_sidecar(notes_: DataFrame, sidecars: DataFrame, schema_tag: str) -> tuple[DataFrame, DataFrame]:
    """(notes with their sidecar, sidecars set aside): joined on the note's id.

    A wrong tag, an unknown id, and all sidecars of a note but the first by text are set aside with a reason.
    """
    rank = "_rank" + "_" * sum(c.startswith("_rank") for c in sidecars.columns)
    ids = notes_.withColumn("note_id", F.element_at("meta", "note_id"))
    right = sidecars.where(F.col("schema") == schema_tag)
    lost = sidecars.where(~F.col("schema").eqNullSafe(F.lit(schema_tag))).withColumn("reason", F.lit("schema"))
    lone = right.join(ids.select("note_id").distinct(), "note_id", "left_anti").withColumn("reason", F.lit("note_id"))
    params = dict(sidecars.dtypes)["params"]
    text = F.to_json("params") if params.startswith(("struct", "map", "array")) else F.col("params").cast("string")
    ranked = right.withColumn(rank, F.row_number().over(Window.partitionBy("note_id").orderBy(text)))
    more = ranked.where(F.col(rank) > 1).drop(rank).join(ids.select("note_id").distinct(), "note_id",
        "left_semi").withColumn("reason", F.lit("repeated"))
    one = ranked.where(F.col(rank) == 1).select("note_id", F.col("params").alias("sidecar"))
    return ids.join(one, "note_id", "left"), lost.unionByName(lone).unionByName(more)


def _walk(doc: dict | None) -> tuple[list[dict], list[str]]:
    out: list[dict] = []
    skipped: list[str] = []

    def visit(chunk: dict) -> None:
        kind = str(chunk.get("type", "")).lower()
        if kind in CHUNKS:
            box = chunk.get("bounding box")
            rows = [[str(c.get("content") or " ".join(str(k.get("content", "")) for k in c.get("kids", [])))
                for c in r.get("cells", [])] for r in chunk.get("rows", [])] if kind == "table" else None
            out.append({
                "ord": len(out), "element_id": f"e{len(out):06d}", "kind": CHUNKS[kind],
                "level": chunk.get("heading level"), "text": chunk.get("content"), "rows": rows,
                "page": chunk.get("page number"), "source_name": chunk.get("source"),
                "box": {"x": box[0], "y": box[1], "width": box[2] - box[0], "height": box[3] - box[1]} if box
                and len(box) == 4 else None, "confidence": float(chunk.get("ai_score", 1.0))})
        elif kind and kind not in skipped and kind not in ("list", "text block", "header", "footer"):
            skipped.append(kind)
        for name in ("kids", "list items"):
            for x in chunk.get(name, []) if kind != "table" else []:
                visit(x)

    for c in (doc or {}).get("kids", []):
        visit(c)
    return out, skipped


def engine_json(docs: DataFrame, key: str, content: str = "json") -> DataFrame:
    """Elements of an engine's JSON tree, depth first; unknown kinds are passed over, what is below them is not."""
    schema = f"{key} string, ord int, element_id string, kind string, level int, text string, rows array<array<string>>, page int, source_name string, box struct<x:double,y:double,width:double,height:double>, confidence double"
    return per_document(docs, [F.col(key).cast("string"), content], lambda k,
        t: ({key: k} | r for r in _walk(json.loads(t) if t else None)[0]), schema)


def skipped_kinds(docs: DataFrame, key: str, content: str = "json") -> DataFrame:
    return per_document(docs, [F.col(key).cast("string"), content], lambda k,
        t: [{key: k, "skipped": _walk(json.loads(t) if t else None)[1]}], f"{key} string, skipped array<string>")


def crop_urls(markdown: Column, *more: Column) -> Column:
    """Image addresses of a response in first-seen order: markdown images, img tags, and bare ones of crops."""
    patterns = (r"!\[[^\]]*\]\(([^)\s]+)", r"<img[^>]+src=[\"']([^\"']+)",
        r"(https?://[^\s\"'<>)]+\.(?:png|jpe?g|webp)[^\s\"'<>)]*)")
    return F.array_distinct(F.concat(*[F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(p), F.lit(1))
        for c in (markdown, *more) for p in patterns]))


def reserve(names: list[str]) -> list[str]:
    """A name of its own for each, in order: itself, else with its place before it (p2_), else by its place alone."""
    used: set[str] = set()
    out = []
    for place, name in enumerate(names, 1):
        free = next(x for x in itertools.chain((name, f"p{place}_{name}", f"crop_{place}.bin"),
            (f"crop_{place}_{k}.bin" for k in itertools.count(1))) if x not in used)
        used.add(free)
        out.append(free)
    return out


def unique_names(df: DataFrame, folder: str, name: str, order: str) -> DataFrame:
    """(folder, order, unique_name) for each row: no two names of a folder are the same.

    A folder holds the images of one document (or pair), so its names are one row's work.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    listed = df.groupBy(F.col(folder).alias("f")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
        F.col(name).alias("n")))).alias("rows"))

    def make(f, rows):
        return [{folder: f, order: r["o"], "unique_name": n} for r, n in zip(rows, reserve([r["n"] for r in rows]))]

    return per_document(listed, ["f", "rows"], make,
        f"`{folder}` {kinds[folder]}, `{order}` {kinds[order]}, unique_name string")


def engine_version(version: Column) -> Column:
    """The version that an engine gives, trimmed; unknown where it gives none."""
    return F.coalesce(F.nullif(F.trim(version), F.lit("")), F.lit("unknown"))


def response_markdown(response: Column) -> Column:
    """struct(text, pages, problem) of a recognition service's JSON: md_results is a text or a list of pages.

    A response without it, with another kind of value, or with blank text is a problem, never an empty document.
    """
    raw = F.get_json_object(response, "$.md_results")
    listed = F.from_json(F.concat(F.lit('{"x":'), F.get_json_object(response, "$.md_results"), F.lit("}")),
        "struct<x:array<string>>").getField("x")
    kind = F.regexp_extract(response, r'"md_results"\s*:\s*(["\[{tfn0-9-])', 1)
    none = F.array().cast("array<string>")
    pages = F.when(kind == "[", F.coalesce(listed, none)).otherwise(none)
    text = F.when(kind == '"', raw).when(kind == "[", F.array_join(F.coalesce(listed, none), "\n\n"))
    problem = (F.when(F.coalesce(kind, F.lit("")).isin("", "n"), "no md_results").when(~kind.isin('"', "["),
        "unexpected type").when(F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit("")) == "", "empty"))
    return F.struct(F.when(problem.isNull(), text).alias("text"),
        F.when(problem.isNull(), pages).otherwise(none).alias("pages"), problem.alias("problem"))


def figure_name(url: Column) -> Column:
    """struct(source_name, format) of an address: the last part of its decoded path; an address that is none stays whole."""
    path = F.try_url_decode(F.replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1),
        F.lit("+"), F.lit("%2B")))
    name = base_name(F.coalesce(F.nullif(path, F.lit("")), url))
    return F.struct(name.alias("source_name"), F.nullif(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)),
        F.lit("")).alias("format"))
