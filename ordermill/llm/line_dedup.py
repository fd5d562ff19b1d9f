"""Line dedup: overlapping three-line windows, repeated ones removed wherever they come later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import let, merged_spans, stage, text_id, two_hashes


def line_windows(docs: DataFrame, doc_id: str, text: str, lines: int = 3) -> DataFrame:
    """One row per window of `lines` consecutive non-blank lines: _id, _text, _start, _end, _hash.

    _start and _end number the lines of the text from 0, blank ones included; _end is exclusive.
    Lines are compared without the spaces (U+0020) around them, as in the SQL: a tab or carriage return
    counts as part of its line, and a line that holds only these is not blank.
    """
    numbered = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("line")))
    held = docs.select(
        F.col(doc_id).alias("_id"),
        text_id(F.col(text)).alias("_text"),
        F.filter(numbered, lambda x: x["line"] != "").alias("_lines"),
    )
    starts = F.when(F.size("_lines") >= lines, F.sequence(F.lit(0), F.size("_lines") - lines))
    each = held.select("_id", "_text", "_lines", F.explode_outer(starts).alias("_i")).where("_i is not null")
    part = [F.get("_lines", F.col("_i") + k) for k in range(lines)]
    return each.select(
        "_id",
        "_text",
        part[0]["at"].alias("_start"),
        (part[-1]["at"] + 1).alias("_end"),
        two_hashes(*[p["line"] for p in part]).alias("_hash"),
    )


def _kept_lines(lines: Column, spans: Column) -> Column:
    """The lines outside the sorted, disjoint spans, joined again."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["_end"]))
    ends = F.concat(F.transform(spans, lambda s: s["_start"]), F.array(F.size(lines)))
    gaps = let(lines, lambda all_lines: F.zip_with(starts, ends, lambda a, b: F.slice(all_lines, a + 1, b - a)))
    return F.array_join(F.flatten(gaps), "\n")


def dedup_lines(
    docs: DataFrame, lines: int = 3, doc_id: str = "doc_id", text: str = "text", counts: bool = True
) -> DataFrame:
    """`docs` with later occurrences of repeated line windows cut from the text.

    With `counts`, adds the columns lines_removed and lines_total (long; any of that name are
    replaced).  A window is `lines` consecutive
    non-blank lines.  Its first occurrence, in the order of id (null last), text and place, stays;
    the lines that any other occurrence covers go, blank lines between them included.  Covered
    places are merged, so overlapping windows remove a line once.

    Texts with fewer than `lines` non-blank lines hold no window and stay as they are, as do null
    texts; a text whose lines all go becomes empty.  Rows with equal id and text count as one place
    and share the result.  All columns and rows of `docs` stay; an empty table gives an empty result.
    """
    found = stage(line_windows(docs, doc_id, text, lines), "line-windows")
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_text"), F.col("_start"))
    repeated = found.groupBy("_hash").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    repeated = repeated.where("_first != _last").select("_hash", "_first")
    later = found.join(repeated, "_hash").where(place != F.col("_first"))
    covered = merged_spans(later.dropDuplicates(["_id", "_text", "_start", "_end"]), ["_id", "_text"], "_start", "_end")
    cuts = covered.groupBy("_id", "_text").agg(F.array_sort(F.collect_list(F.struct("_start", "_end"))).alias("_cuts"))

    cuts = stage(cuts, "line-cuts")
    same = docs[doc_id].eqNullSafe(cuts["_id"]) & (text_id(docs[text]) == cuts["_text"])
    split, spans = F.split(docs[text], "\n", -1), cuts["_cuts"]
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["_end"] - s["_start"])
    shorter = F.when(spans.isNull(), docs[text]).otherwise(_kept_lines(split, spans)).alias(text)
    added = {"lines_removed": F.coalesce(removed, F.lit(0)), "lines_total": F.when(docs[text].isNull(), 0).otherwise(F.size(split))}
    # the hint keeps one plan at every size: texts and cuts are dealt by id, skew split at run time
    return docs.join(cuts.hint("merge"), same, "left").select(
        *[shorter if c == text else docs[c] for c in docs.columns if not (counts and c in added)],
        *[value.cast("long").alias(name) for name, value in added.items() if counts],
    )
