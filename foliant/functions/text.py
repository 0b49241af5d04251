"""Text functions: trimming, entities, character maps, command words, notes, mark points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity names, command words by tier, kinds of guidance and of notes by their beginning, in order.
ENTITIES = {"gt": ">", "lt": "<", "amp": "&", "quot": '"', "apos": "'"}
LOW = ("state", "name", "give", "identify", "label", "complete", "draw", "write", "plot", "circle", "tick",
    "put a cross", "select", "choose", "which")
MIDDLE = ("describe", "explain", "calculate", "deduce", "determine", "estimate", "predict", "sketch", "outline",
    "measure", "comment", "show that", "show", "find", "convert", "balance", "refer to", "look at")
HIGH = ("discuss", "justify", "evaluate", "compare", "contrast", "analyse", "analyze", "suggest", "interpret", "assess",
    "consider")
GUIDANCE = (("allow", "allow"), ("ignore", "ignore"), ("example calculation", "example-calculation"),
    ("example diagram", "example-diagram"), ("example graph", "example-diagram"), ("ecf", "ecf"))
NOTES = (("do not accept", "reject"), ("do not allow", "reject"), ("reject", "reject"), ("accept", "allow"),
    ("allow", "allow"), ("ignore", "ignore"))
PART_LABEL = r"^\(?[a-h]\)\s*"
ROMAN_LABEL = r"^\(?(?:i{1,3}|iv|v|vi{1,3}|ix|x)\)\s*"


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(x: Column) -> Column:
    """Without Unicode white space at either end (trim takes the space only)."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def collapse(x: Column) -> Column:
    """White space runs as one space, ends trimmed."""
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def code_point(cp: Column) -> Column:
    """The character of a code point; null for surrogates and beyond U+10FFFF."""
    byte = lambda v: F.unhex(F.lpad(F.hex(v.cast("long")), 2, "0"))
    tail = lambda s: byte((F.call_function("shiftright", cp, F.lit(s)) % 64) + 128)
    lead = lambda s, base: byte(F.call_function("shiftright", cp, F.lit(s)) + base)
    raw = (F.when(cp < 0x80, byte(cp)).when(cp < 0x800, F.concat(lead(6, 0xC0), tail(0)))
           .when(cp < 0x10000, F.concat(lead(12, 0xE0), tail(6), tail(0))).otherwise(F.concat(lead(18, 0xF0), tail(12),
           tail(6), tail(0))))
    return F.when((cp >= 0) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF), F.decode(raw, "UTF-8"))


def decode_entities(x: Column) -> Column:
    """Five named and all numeric character references, in one pass: what they give is not looked at again.

    References to surrogates or beyond Unicode stay as they are.
    """
    names = "|".join(ENTITIES)
    parts = F.regexp_extract_all(x, F.lit(rf"(?s)&#[xX][0-9a-fA-F]{{1,8}};|&#[0-9]{{1,9}};|&(?:{names});|[^&]+|&"),
        F.lit(0))
    named = F.create_map(*[v for k, c in ENTITIES.items() for v in (F.lit(f"&{k};"), F.lit(c))])

    def one(t: Column) -> Column:
        hexed = F.conv(F.regexp_extract(t, "^&#[xX]([0-9a-fA-F]+);", 1), 16, 10)
        number = F.when(F.lower(F.substring(t, 3, 1)) == "x",
            hexed).otherwise(F.regexp_extract(t, "^&#([0-9]+);", 1)).try_cast("long")
        return F.coalesce(F.when(t.startswith("&#"), code_point(number)).otherwise(F.element_at(named, t)), t)

    return F.when(F.contains(x, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(x)


def map_chars(x: Column, table: dict[str, str]) -> Column:
    """Left to right, the longest key of table first; its value is not looked at again; other characters stay.

    C0 controls but tab, line feed and return become a space, as in an intake normaliser.
    """
    keys = sorted(table, key=lambda k: (-len(k), k))
    quoted = "".join(r"\Q" + k + r"\E|" for k in keys)
    stops = "".join(sorted({rf"\x{{{ord(k[0]):X}}}" for k in keys}))
    # a run of characters that begin no key and are no control goes as one piece
    parts = F.regexp_extract_all(x, F.lit(rf"(?s){quoted}[^{stops}\x00-\x08\x0B\x0C\x0E-\x1F]+|."), F.lit(0))
    literal = F.create_map(*[F.lit(v) for k in keys
        for v in (k, table[k])]) if keys else F.create_map().cast("map<string,string>")
    one = lambda t: F.coalesce(F.element_at(literal, t),
        F.when(t.rlike(r"^[\x00-\x08\x0B\x0C\x0E-\x1F]$"), F.lit(" ")).otherwise(t))
    return F.array_join(F.transform(parts, one), "")


def private_use(x: Column) -> Column:
    """Private-use characters of the text, as often as they come."""
    return F.regexp_extract_all(x, F.lit(r"[\x{E000}-\x{F8FF}]"), F.lit(0))


def controls(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"), F.lit(0))


def sentences(x: Column) -> Column:
    """Split behind . ! ? and white space."""
    return F.split(F.regexp_replace(x, r"([.!?])\s+", "$1\u0001"), "\u0001")


def command_words() -> list[tuple[str, str]]:
    """(word, tier), longest first, then as listed."""
    both = [(w, t) for t, ws in (("low", LOW), ("middle", MIDDLE), ("high", HIGH)) for w in ws]
    return sorted(both, key=lambda p: -len(p[0]))


def command_word(x: Column) -> Column:
    """The command word that a sentence begins with, of the first sentence that does; the longest; null if none."""
    pattern = "^(" + "|".join(w for w, _ in command_words()) + ")(?:[ ,]|$)"
    bare = F.regexp_replace(F.regexp_replace(strip(x), PART_LABEL, ""), ROMAN_LABEL, "")
    hits = F.filter(F.transform(sentences(bare), lambda s: F.regexp_extract(F.lower(strip(s)), pattern, 1)),
        lambda w: w != "")
    return F.get(hits, F.lit(0))


def command_tier(word: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for p in command_words() for v in p]), word)


def summary_hint(x: Column, most: int = 200) -> Column:
    """First sentence, at most `most` characters, cut at the last space among these; null if there is none."""
    first = strip(F.get(sentences(strip(x)), F.lit(0)))
    return let(first, lambda s: F.nullif(F.when(F.length(s) <= most,
        s).otherwise(strip(F.regexp_replace(F.substring(s, 1, most), r"(?s) [^ ]*$", ""))), F.lit("")))


def guidance_kind(x: Column) -> Column:
    """Kind of a guidance line by its beginning: also dependent (MP..., dependent) and note."""
    low = F.lower(strip(x))
    listed = reduce(lambda acc, p: acc.when(low.startswith(p[0]), F.lit(p[1])), GUIDANCE, F)
    return listed.when(low.startswith("mp") & F.contains(low, F.lit("dependent")), "dependent").otherwise("note")


def note_kind(x: Column) -> Column:
    low = F.lower(strip(x))
    return reduce(lambda acc, p: acc.when(low.startswith(p[0]), F.lit(p[1])), NOTES, F).otherwise("notes")


def note_text(x: Column) -> Column:
    """The note without the beginning that gives its kind."""
    return F.regexp_replace(strip(x), "(?i)^(?:" + "|".join(p for p, _ in NOTES) + r")[ :\u2014-]*", "")


def split_marks(x: Column, marker: str = r"\(([0-9]{1,2})\)") -> Column:
    """array of struct(ordinal, raw, marks): text cut behind each marker; blank pieces are skipped, a tail has null marks.

    A text without a marker is not split: no points.
    """
    texts, marks = F.split(x, marker, -1), F.regexp_extract_all(x, F.lit(marker), F.lit(1))
    zipped = F.zip_with(texts, marks, lambda t, m: F.struct(strip(t).alias("raw"), m.cast("int").alias("marks")))
    kept = F.filter(zipped, lambda p: p.raw != "")
    points = F.transform(kept, lambda p, i: F.struct((i + 1).alias("ordinal"), p.raw.alias("raw"),
        p.marks.alias("marks")))
    unsplit = F.size(F.filter(kept, lambda p: p.marks.isNotNull())) == 0
    return F.when(unsplit, F.array().cast("array<struct<ordinal:int,raw:string,marks:int>>")).otherwise(points)


def alternatives(x: Column) -> Column:
    """Pieces of a point between the word or, trimmed, blank ones left out behind the first."""
    parts = F.transform(F.split(x, r"(?i)\bor\b"), strip)
    return F.filter(parts, lambda t, i: (i == 0) | (t != ""))


def mark_points(x: Column) -> Column:
    """Points of an answer: ordinal, text, marks, dependent_on, ecf, alternatives, any_two, reject, raw."""

    def point(p: Column) -> Column:
        refs = F.array_distinct(F.flatten(F.transform(
            F.regexp_extract_all(p.raw, F.lit(r"(?i)dependent on\s+([^)]*)"), F.lit(1)),
            lambda d: F.transform(F.regexp_extract_all(d, F.lit(r"(?i)\bMP\s?(\d+)"), F.lit(1)),
            lambda n: F.concat(F.lit("MP"), n)))))
        alts = alternatives(p.raw)
        return F.struct(
            p.ordinal.alias("ordinal"), F.get(alts, F.lit(0)).alias("text"), p.marks.alias("marks"),
            refs.alias("dependent_on"), p.raw.rlike(r"(?i)\becf\b").alias("ecf"),
            F.slice(alts, 2, F.greatest(F.size(alts) - 1, F.lit(0))).alias("alternatives"),
            p.raw.rlike(r"(?i)any\s+two\s+from").alias("any_two"),
            p.raw.rlike(r"(?i)do\s+not\s+accept|is\s+insufficient").alias("reject"), p.raw.alias("raw"))

    return F.transform(split_marks(x), point)


def collapse_spaced(x: Column) -> Column:
    """A line of single letters set apart, closed up (two or more spaces part words); other lines stay."""
    spaced = F.split(strip(x), " +")
    closed = F.array_join(F.transform(F.split(strip(x), "  +"), lambda w: F.replace(w, F.lit(" "), F.lit(""))), " ")
    return F.when((F.size(spaced) > 2) & F.forall(spaced, lambda t: F.length(t) == 1), closed).otherwise(x)


def inline_math_count(x: Column) -> Column:
    """Pairs of dollar signs that no backslash precedes."""
    return F.floor(F.regexp_count(x, F.lit(r"(?<!\\)\$")) / 2).cast("int")


def estimated_tokens(x: Column) -> Column:
    return F.greatest(F.lit(1), F.floor((F.length(x) + 3) / 4).cast("int"))


def suffix(label: Column) -> Column:
    """Part label as (a)(i): from a-i, a(i), (a)(i); a bare question number or *14 gives the empty suffix."""
    bare = F.regexp_replace(F.lower(strip(label)), r"^\*?[0-9]*", "")
    parts = F.regexp_extract_all(bare, F.lit("[a-z]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.lit("("), p, F.lit(")"))), "")


def correct_letter(x: Column) -> Column:
    """The letter that an answer names as correct, alone or in one of three phrases; null if none."""
    phrases = (r"^\(?([A-Ea-e])\)?[.:]?$",
        r"(?i)^(?:the\s+)?(?:only\s+)?correct\s+(?:answer\s+)?is[:\s]*\(?([A-E])\)?\)?[.:]?$",
        r"(?i)^(?:the\s+)?answer\s+is[:\s]*\(?([A-E])\)?\)?[.:]?$")
    return F.coalesce(*[F.nullif(F.regexp_extract(strip(x), p, 1), F.lit("")) for p in phrases])
