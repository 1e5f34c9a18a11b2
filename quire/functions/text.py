"""Token and line functions as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the token classes and the confusion tables.
MARKISH = r"^[^A-Za-z0-9]{0,3}$"
STRAY = r"^[|\\{}~_=<>]{1,3}$"
NOT_STRAY = r"[^|\\{}~_=<>\s]"
CHECK_BELOW, BAD_BELOW = 80, 60
CONFUSED = ("0158l|", "OISBII")
TO_DIGIT = ("OoIl|SB", "0011158")
HOURS = ("COMPLINE", "LAUDS", "MATINS", "NONE", "PRIME", "SEXT", "TERCE", "VESPERS")


def norm(t: Column) -> Column:
    """Lower case without signs at the edges; apostrophes stay."""
    return F.lower(F.regexp_replace(t, r"^[^\p{L}\p{N}_']+|[^\p{L}\p{N}_']+$", ""))


def markish(t: Column) -> Column:
    return t.rlike(MARKISH)


def stray(t: Column) -> Column:
    return t.rlike(STRAY)


def token_class(t: Column, conf: Column) -> Column:
    return F.when(markish(t) & stray(t), "stray").when(markish(t), "mark").when(conf < BAD_BELOW, "bad").when(conf < CHECK_BELOW, "check").otherwise("ok")


def unconfuse(t: Column) -> Column:
    return F.translate(t, *CONFUSED)


def to_digits(t: Column) -> Column:
    return F.translate(t, *TO_DIGIT)


def edits(a: Column, b: Column, cap: int = 2) -> Column:
    """Edit distance without regard to case, cap + 1 beyond the cap."""
    d = F.levenshtein(F.lower(a), F.lower(b), cap)
    return F.when(d < 0, cap + 1).otherwise(d)


def line_words(text: Column) -> Column:
    """Words of a line without its closing dots and colons."""
    return F.filter(F.split(F.regexp_replace(F.trim(text), r"[.:]+$", ""), r"\s+"), lambda w: w != "")


def keyed(text: Column, word: str, cap: int = 2) -> Column:
    """What follows a keyword, read loosely; null if the line does not start with it."""
    w = line_words(text)
    head = unconfuse(F.regexp_replace(F.element_at(w, 1), r"^\.+|\.+$", ""))
    return F.when((F.size(w) >= 2) & (edits(head, F.lit(word), cap) <= cap), F.array_join(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), " "))


def as_hour(text: Column, names: tuple[str, ...] = HOURS) -> Column:
    """The hour that a single upper-case word is within one edit of; the first named of several."""
    t = unconfuse(F.regexp_replace(F.trim(text), r"[.:]+$", ""))
    known = F.array(*[F.lit(h) for h in names])
    hits = F.filter(known, lambda h: edits(t, h, 1) <= 1)
    return F.when(t.rlike(r"^\S+$") & (t == F.upper(t)) & (t != F.lower(t)), F.try_element_at(hits, F.lit(1)))


def as_mark(token: Column, conf: Column) -> Column:
    """The versicle or response mark that a short token stands for, else null."""
    t = F.regexp_replace(F.trim(token), r"^\.+|\.+$", "")
    wordlike = (F.length(t) > 1) & t.rlike(r"^\p{L}+$")
    return (
        F.when((t == "") | (F.length(t) > 3), None)
        .when(t.contains("℟"), "<R>")
        .when(t.contains("℣"), "<V>")
        .when(F.upper(t).isin("A", "I", "O"), None)
        .when(wordlike & (conf.isNull() | (conf >= BAD_BELOW)), None)
        .when(t.rlike("(?i)[RKB]"), "<R>")
        .when(t.rlike("(?i)[VY©¥]"), "<V>")
    )


def classify_line(text: Column, layer: Column, x0: Column, x1: Column, left: Column, right: Column, clearing: Column) -> Column:
    """struct(kind, val) of a heading-like line, null for running text; the first rule that fits wins."""
    width = right - left
    short = (x1 - x0) < width * 0.85
    offcentre = F.when(width != 0, F.abs((x0 - left) - (right - x1)) / width).otherwise(1.0)
    psalm = F.regexp_replace(to_digits(keyed(text, "psalm")), r"\D", "")
    lesson = keyed(text, "lesson")
    parts = line_words(text)
    nocturn = (F.size(parts) == 2) & (edits(F.try_element_at(parts, F.lit(2)), F.lit("nocturn"), 2) <= 2)
    ant = F.regexp_extract(text, r"^Ant\.?\s*(\d+)\b", 1)
    hour = as_hour(text)
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    heading = short & (clearing >= 1.45) & (offcentre <= 0.20) & (words <= 8) & ~F.rtrim(text).rlike(r"[.:;,]$")

    def tag(kind, val):
        return F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), val.alias("val"))

    return (
        F.when(psalm.isNotNull() & (psalm != ""), tag("psalm", psalm))
        .when(lesson.rlike(r"^[ivxlcIVXLC1|]{1,6}\.?$"), tag("lesson", F.lower(unconfuse(F.regexp_replace(lesson, r"\.+$", "")))))
        .when(nocturn, tag("bheading", F.trim(text)))
        .when((layer == "red") & (ant != ""), tag("ant", ant))
        .when(hour.isNotNull(), tag("hour", hour))
        .when(heading, tag(F.when(layer == "red", "heading").otherwise("bheading"), text))
    )


def glob_regex(pattern: Column) -> Column:
    """An anchored regular expression for a file-name pattern with *, ? and [..]."""
    quoted = F.regexp_replace(pattern, r"([.+^$(){}|\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("[!"), F.lit("[^")), F.lit("$"))


def dehyphenate(text: Column) -> Column:
    """Words broken across a line end, put together."""
    return F.regexp_replace(text, r"(?<=\p{L})-\s*\n\s*(?=\p{L})", "")


def text_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([\p{L}]+(?:['’-][\p{L}]+)*)"), 1)


def reflow(text: Column) -> Column:
    """Lines joined into one paragraph; a hyphen goes only before a lower-case letter."""
    return F.regexp_replace(F.regexp_replace(text, r"-[ ]*\n[ ]*(?=\p{Ll})", ""), r"[ ]*\n[ ]*", " ")


def glyphs(text: Column) -> Column:
    """Typed R/ and V/ as their true signs."""
    r = F.regexp_replace(text, r"(?i)\bR\s*(?:/\.|\./|/)(?=\s|$)", "℟")
    return F.regexp_replace(r, r"(?i)\bV\s*(?:/\.|\./|/)(?=\s|$)", "℣")


def tag_safe(line: Column, tags: list[str]) -> Column:
    """A space before a line that looks like a tag and is none."""
    is_tag = F.regexp_extract(line, r"^\.(\S*)", 1).isin(*tags)
    return F.when(line.rlike(r"^\.[A-Za-z]") & ~is_tag, F.concat(F.lit(" "), line)).otherwise(line)


#: TeX for special characters and marks, in the order they are replaced.
TEX = (("\\", r"\textbackslash{}"), ("&", r"\&"), ("%", r"\%"), ("$", r"\$"), ("#", r"\#"), ("_", r"\_"), ("~", r"\textasciitilde{}"), ("^", r"\textasciicircum{}"), ("{", r"\{"), ("}", r"\}"))
TEX_MARKS = (("<V>", r"\vers{}"), ("<R>", r"\resp{}"), ("<*>", r"\med{}"), ("<?>", r"\unclear{}"))


def tex_escape(text: Column) -> Column:
    for char, tex in TEX:
        text = F.replace(text, F.lit(char), F.lit(tex))
    return F.when(F.ltrim(text).startswith("["), F.concat(F.lit("{}"), text)).otherwise(text)


def tex_marks(text: Column) -> Column:
    for mark, tex in TEX_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(tex))
    return F.regexp_replace(text, r"(?<!\S)\*(?!\S)", r"\\med{}")


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-|-$", "")


def split_boxes(x: Column, w: Column, parts: Column) -> Column:
    """Boxes (t, x, w) that share one box among words by their lengths; halves round to even."""
    span = F.length(F.array_join(parts, " "))
    gap = F.greatest(F.lit(1), F.bround(w / span).cast("int"))
    start = F.struct(F.array().cast("array<struct<t:string,x:int,w:int>>").alias("done"), x.cast("int").alias("at"))

    def add(acc, p):
        wide = F.greatest(F.lit(1), F.bround(w * F.length(p) / span).cast("int"))
        box = F.struct(p.alias("t"), acc["at"].alias("x"), wide.alias("w"))
        return F.struct(F.concat(acc["done"], F.array(box)).alias("done"), (acc["at"] + wide + gap).alias("at"))

    return F.aggregate(parts, start, add, lambda acc: acc["done"])


#: Signs folded to plain ones, and marks that count as spaces.
FOLDED = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "℟": " ", "℣": " "}


def plain_letters(text: Column) -> Column:
    """Decomposed (NFKD) without accents, quotes and ligatures folded, lower case; Spark has no normaliser."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(plain)

    return F.pandas_udf(run, "string")(text)


def plain(t: str | None) -> str | None:
    if t is None:
        return None
    return "".join(FOLDED.get(c, c) for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()
