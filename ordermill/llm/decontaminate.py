"""Benchmark decontamination: a prefix-filtered set join of word shingles, verified word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import ascii_lower, merged_spans, stage, text_id

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # once A-Z are lower case
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # as written
SHINGLE = 3
SENT = 100_000  # windows up to which look-ups are broadcast, about 10 MB; beyond, both sides are shuffled


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def _shingle(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(length)])


def item_windows(items: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """Each window of each item: item_id, words (array), n."""
    held = items.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(text)).alias("_words"))
    last = F.greatest(F.size("_words") - window, F.lit(0))
    starts = F.when(F.size("_words") > 0, F.sequence(F.lit(1), last + 1))
    each = held.select("item_id", "_words", F.explode_outer(starts).alias("_s")).where("_s is not null")
    part = F.slice("_words", F.col("_s"), F.lit(window))
    return each.select("item_id", part.alias("words"), F.size(part).alias("n")).distinct()


def window_shingles(windows: DataFrame, length: int) -> DataFrame:
    """The shingles of the distinct windows: words, n, offset, shingle (a hash)."""
    each = windows.select("words", "n", F.explode(F.sequence(F.lit(0), F.col("n") - length)).alias("offset"))
    return each.withColumn("shingle", _shingle(F.col("words"), F.col("offset"), length))


def shingle_places(docs: DataFrame, length: int, window: int) -> DataFrame:
    """Every shingle of every document: _id, _text, pos, shingle, and the words around it.

    near holds the words from pos - lead on, as many as a window at any offset can reach.  The words
    of a text are made once; place, hash and look-up stay in one generated loop, which cuts `near`
    out only for a shingle that it finds.
    """
    held = docs.select("_id", text_id(F.col("_body")).alias("_text"), words_of(F.col("_body")).alias("_words"))
    starts = F.when(F.size("_words") >= length, F.sequence(F.lit(0), F.size("_words") - length))
    each = held.select("_id", "_text", "_words", F.explode_outer(starts).alias("pos"))
    lead = F.least(F.col("pos"), F.lit(window - 1))
    return each.select(
        "_id",
        "_text",
        "pos",
        _shingle(F.col("_words"), F.col("pos"), length).alias("shingle"),
        lead.alias("lead"),
        F.slice("_words", F.col("pos") - lead + 1, lead + window).alias("near"),
    ).where("pos is not null")


def _prefixes(places: DataFrame, windows: DataFrame, length: int, few: bool) -> DataFrame:
    """The rarest shingle in the corpus of each window that has all of its there: words, n, shingle, offset.

    Containment needs all shingles, so one is a sufficient prefix.
    """
    shingles = stage(window_shingles(windows, length), "leak-shingles")
    wanted, uses = shingles.select("shingle").distinct(), F.count(F.lit(1)).alias("uses")
    if few:
        counts = places.join(F.broadcast(wanted), "shingle", "left_semi").groupBy("shingle").agg(uses)
    else:  # counted before the join, so that no frequent shingle moves as often as it stands in the texts
        counts = places.groupBy("shingle").agg(uses).join(wanted, "shingle", "left_semi")
    counts = stage(counts, "leak-counts")
    rarest = F.min(F.struct("uses", "shingle", "offset"))
    prefix = shingles.join(counts, "shingle", "left").na.fill(0, ["uses"]).groupBy("words", "n").agg(rarest.alias("p"))
    return stage(prefix.where("p.uses > 0").select("words", "n", "p.shingle", "p.offset"), "leak-prefix")


def _met_on_the_way(places: DataFrame, prefix: DataFrame) -> DataFrame:
    """Occurrences by a broadcast of few prefixes: place, look-up and check are one pass over the texts."""
    start = F.col("pos") - F.col("offset")
    first = F.col("lead") - F.col("offset") + 1
    fits = (F.col("lead") >= F.col("offset")) & (F.size("near") >= first - 1 + F.col("n"))
    same = F.slice("near", F.greatest(first, F.lit(1)), F.col("n")) == F.col("words")
    found = places.join(F.broadcast(prefix), "shingle").where(fits & same)
    return found.select("_id", "_text", start.alias("start"), (start + F.col("n")).alias("end"), "words")


def _met_by_shuffle(docs: DataFrame, places: DataFrame, prefix: DataFrame) -> DataFrame:
    """The same by a plain join: shingles move without words, and only places of candidates return to their text."""
    start = (F.col("pos") - F.col("offset")).alias("start")
    hits = places.select("_id", "_text", "pos", "shingle").join(prefix, "shingle")
    hits = hits.select(F.col("_id").alias("_h_id"), F.col("_text").alias("_h_text"), start, "n", "words").where("start >= 0")
    hits = stage(hits.distinct(), "leak-candidates")
    held = docs.select("_id", text_id(F.col("_body")).alias("_text"), words_of(F.col("_body")).alias("_words"))
    of_text = held["_id"].eqNullSafe(hits["_h_id"]) & (held["_text"] == hits["_h_text"])
    found = held.join(hits, of_text).where(F.slice("_words", F.col("start") + 1, F.col("n")) == F.col("words"))
    return found.select("_id", "_text", "start", (F.col("start") + F.col("n")).alias("end"), "words")


def occurrences(docs: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """Every occurrence of a window in a document: _id, _text, start, end, words.

    Two passes over the documents count shingles and meet the prefixes, whatever the number of windows;
    up to SENT windows their look-ups are broadcast, more are joined by a shuffle.  Windows of fewer
    words than a shingle are shingles of their own length, with passes of their own.
    """
    length = F.least("n", F.lit(SHINGLE)).alias("length")
    distinct = stage(windows.select("words", "n", length).distinct(), "leak-distinct")
    id_type = docs.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, _text long, start int, end int, words array<string>"
    found = docs.sparkSession.createDataFrame([], schema)
    for r in sorted(distinct.groupBy("length").count().collect()):  # SHINGLE rows at most
        few = r["count"] <= SENT
        places = shingle_places(docs, r["length"], window)
        prefix = _prefixes(places, distinct.where(F.col("length") == r["length"]).select("words", "n"), r["length"], few)
        found = found.unionByName(_met_on_the_way(places, prefix) if few else _met_by_shuffle(docs, places, prefix))
    return found


def mark_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans.

    Words are runs of ASCII digits and letters and of anything beyond ASCII, with A-Z in lower case.
    A window is `window` consecutive words of an item, or a shorter item as a whole.  Document words
    inside any occurrence of a window are hit; hit_spans lists them as merged (start, end) word
    places.  n_items counts the items with an occurring window, items_sha256 is the hash of their
    ids, sorted as strings and comma-joined.

    The join: shingles of three words (or of a shorter window's length) of all documents are looked
    up among those of the items; their counts order the shingles by rarity, and only the rarest of a
    window makes candidates.  Offset and window length bound where it can start; the words decide.

    Null and empty texts have no words; items without words match nothing, items without id mark
    words without being listed; an id repeated among items counts once.  Repeated rows and null ids
    of `docs` are rows of their own; empty tables on either side give no hits.  Other columns are
    not read.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_body"))
    n_words = F.coalesce(F.regexp_count("_body", F.lit(WORD)), F.lit(0)).cast("long")
    base = rows.select("_id", text_id(F.col("_body")).alias("_text"), n_words.alias("n_words"))
    marks = document_marks(rows, items, window, item_id, item_text)
    same = base["_id"].eqNullSafe(marks["_m_id"]) & (base["_text"] == marks["_m_text"])
    ids = F.coalesce("_ids", F.array().cast("array<string>"))
    return base.join(marks, same, "left").select(
        F.col("_id").alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.col("_spans").alias("hit_spans"),
    )


def document_marks(rows: DataFrame, items: DataFrame, window: int, item_id: str, item_text: str) -> DataFrame:
    """One row per text (_id, _body) with a hit: _m_id, _m_text, n_hit, _spans, _ids."""
    windows = stage(item_windows(items, window, item_id, item_text), "leak-windows")
    found = occurrences(rows, windows, window)
    found = stage(found.dropDuplicates(["_id", "_text", "start", "words"]), "leak-found")
    keys = ["_id", "_text"]
    spans = merged_spans(found, keys, "start", "end").groupBy(*keys).agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"),
    )
    named = found.select(*keys, "words").distinct().join(windows.select("words", "item_id"), "words")
    named = named.groupBy(*keys).agg(F.collect_set("item_id").alias("_ids"))
    marks = spans.join(named, spans["_id"].eqNullSafe(named["_id"]) & (spans["_text"] == named["_text"]), "left")
    marks = marks.select(spans["_id"].alias("_m_id"), spans["_text"].alias("_m_text"), "n_hit", "_spans", "_ids")
    return stage(marks, "leak-marks")


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text holds no window of an item.

    Nulls, empty texts and repeated rows as in `mark_contaminated`: every row without a hit stays.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_body"))
    marks = document_marks(rows, items, window, item_id, item_text)
    same = docs[doc_id].eqNullSafe(marks["_m_id"]) & (text_id(docs[text]) == marks["_m_text"])
    return docs.join(marks, same, "left_anti")
