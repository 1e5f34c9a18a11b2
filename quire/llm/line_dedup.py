"""Line dedup by overlapping windows of three lines, in DataFrame operations only.

Every three consecutive lines of a document form a window, known by two independent 64-bit
hashes.  Windows that occur more than once anywhere are found by one aggregation; all but the
first occurrence (least id, then position) are removed, by merging the line positions they cover.

Defined results: null text counts as empty; a text of fewer lines than a window never changes;
windows of blank lines alone are left alone; an occurrence that overlaps the first one in the
same document stays, so a run of one repeated line keeps a window's worth and drops the rest; rows
with a null id neither lose lines nor count as occurrences; repeated rows count as one occurrence
and share the verdict; a document whose lines all go keeps its row, with empty text; an empty
table gives no rows; other columns pass through, whatever their names; names of the report that
the table has already get underscores until they are new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialize, new_name

WINDOW = 3
#: A window that holds over so small a share of all windows is looked up apart; fewer than this many can.
HEAVY = 10_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """__id, __pos, __a, __b: every window that is not blank."""
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), lines_of(F.col(text_col)).alias("__lines")).where(F.size("__lines") >= window)
    hashed = lines.select("__id", F.transform("__lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(window), x).alias("b"), (F.trim(x) != "").alias("ink"))).alias("__h"))

    def at(i: Column) -> Column:
        parts = [F.element_at("__h", i + k + 1) for k in range(window)]
        ink = parts[0]["ink"]
        for p in parts[1:]:
            ink = ink | p["ink"]
        return F.struct(i.alias("__pos"), F.xxhash64(*[p["a"] for p in parts]).alias("__a"), F.xxhash64(*[p["b"] for p in parts]).alias("__b"), ink.alias("__ink"))

    return hashed.select("__id", F.inline(F.transform(F.sequence(F.lit(0), F.size("__h") - window), at))).where("__ink").drop("__ink")


def later_positions(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """__id, __covered: the line positions (from 0) that later occurrences of repeated windows cover."""
    found = materialize(windows(docs, id_col, text_col, window), "windows")
    repeated = materialize(found.groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct("__id", "__pos")).alias("__first")).where("__n > 1"), "repeated")
    floor = F.lit(found.count() / HEAVY)
    # Fewer than HEAVY windows of 40 bytes are above the floor: they are broadcast, so no task gets all places of one.
    heavy = repeated.where(F.col("__n") > floor).drop("__n")
    light = repeated.where(F.col("__n") <= floor).drop("__n")
    own = (F.col("__id") == F.col("__first.__id")) & (F.col("__pos") < F.col("__first.__pos") + window)
    rest = found.join(F.broadcast(heavy.select("__a", "__b")), ["__a", "__b"], "left_anti")
    later = found.join(F.broadcast(heavy), ["__a", "__b"]).unionByName(rest.join(light, ["__a", "__b"])).where(~own)
    starts = later.groupBy("__id").agg(F.collect_set("__pos").alias("__starts"))
    return starts.select("__id", F.array_distinct(F.flatten(F.transform("__starts", lambda p: F.sequence(p, p + window - 1)))).alias("__covered"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, report: bool = False) -> DataFrame:
    """``docs`` with the covered lines taken out of the text; ``report`` appends n_lines and n_removed."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    covered = later_positions(plain, "id", "text", window)
    # The table's own columns travel as one struct, so their names meet no other.
    joined = docs.select(F.struct("*").alias("row")).join(covered.hint("shuffle_hash"), F.col("row")[id_col] == F.col("__id"), "left")
    own = F.col("row")[text_col]
    lines = lines_of(own)
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__covered"))
    text = F.when(F.col("__covered").isNull(), own).otherwise(F.array_join(F.transform(keep, lambda i: F.element_at(lines, i + 1)), "\n"))
    columns = [(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    counts = {"n_lines": F.size(lines), "n_removed": F.coalesce(F.size("__covered"), F.lit(0))} if report else {}
    return joined.select(*columns, *[value.alias(new_name(name, docs.columns)) for name, value in counts.items()])
