"""python -m foliant INPUT OUTPUT: pairs of -qp.md and -ms.md files below INPUT become tables below OUTPUT.

python -m foliant --query NAME SF_DIR OUTPUT: one registered query, written as Parquet.

python -m foliant --dump MODE INPUT OUTPUT: what one step makes of the markdown files below INPUT, a JSON line for each
row, in order.  Modes: canonical (elements), qp, ms (drafts), points (mark points of schemes), glyphs (private-use and
control characters).  Unknown modes, names and arguments are errors.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _points(docs: DataFrame) -> DataFrame:
    from foliant.operators import markdown, schemes

    found = schemes.entries(markdown.elements(docs))
    return found.select("doc_id", "label", F.posexplode("points").alias("ord", "p")).select("doc_id", "label", "ord", "p.*")


def _glyphs(docs: DataFrame) -> DataFrame:
    from foliant.operators import glyphs

    return glyphs.census(docs, "doc_id", "text")


def _step(name: str) -> Callable[[DataFrame], DataFrame]:
    def run(docs: DataFrame) -> DataFrame:
        from foliant.operators import markdown, papers, schemes

        found = markdown.elements(docs)
        return found if name == "canonical" else papers.drafted(found) if name == "qp" else schemes.drafted(found)

    return run


#: What --dump can show: (doc_id, text) -> rows.
DUMPS: dict[str, Callable[[DataFrame], DataFrame]] = {"canonical": _step("canonical"), "qp": _step("qp"),
    "ms": _step("ms"), "points": _points, "glyphs": _glyphs}


def dump(spark: SparkSession, mode: str, path: str, output: str) -> None:
    """Rows of a step as JSON lines, in order of all their columns' text."""
    from foliant.operators import markdown
    from foliant.sources import readers

    docs = markdown.with_id(readers.files(spark, path, "*.md")).select("doc_id", "text").dropDuplicates(["doc_id"])
    rows = DUMPS[mode](docs)
    line = F.to_json(F.struct(*rows.columns))
    order = [c for c in ("doc_id", "ord", "label") if c in rows.columns]
    rows.select(*order, line.alias("value")).repartitionByRange(*order, "value").sortWithinPartitions(*order,
        "value").select("value").write.mode("overwrite").text(output)


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="foliant", description=__doc__)
    parser.add_argument("--query", help="name of a registered query")
    parser.add_argument("--dump", choices=sorted(DUMPS), help="one step, as JSON lines")
    parser.add_argument("input")
    parser.add_argument("output")
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("foliant").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.query:
        from foliant.plans.catalog import QUERIES

        if given.query not in QUERIES:
            parser.error(f"no query {given.query}")
        QUERIES[given.query](spark, given.input).write.mode("overwrite").parquet(given.output)
        return 0
    if given.dump:
        dump(spark, given.dump, given.input, given.output)
        return 0
    from foliant.plans import bundle

    tables, aside = bundle.build(spark, given.input)
    bundle.write(tables, given.output)
    for r in aside.collect():
        print(f"set aside: {r.path} ({r.reason})", file=sys.stderr)
    return int(spark.read.parquet(f"{given.output}/status").where("status = 'fail'").count() > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
