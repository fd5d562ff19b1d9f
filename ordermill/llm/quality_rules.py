"""Quality rules: a table of thresholds compiled into one projection of ratios, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import let, stage, unused

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
EDGES = ".,;:!?()\"'"  # stripped from a word before it is looked up among the stop words
# The ten stop words looked for in each language.
STOP_WORDS = (
    *"the be to of and that have with is for".split(),
    *"de la le et les des un une que dans".split(),
    *"der die und das von zu mit den im ist".split(),
    *"el en y los del las por con para una".split(),
)


class Rule(NamedTuple):
    """A measure of `measures` with the least and the most value that passes; None: no limit."""

    measure: str
    least: float | None = None
    most: float | None = None


MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RULES = (
    Rule("mean_word_chars", 3.0, 10.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("letter_share", 0.8, None),
    Rule("n_stop_words", 2, None),
    Rule("stop_share", 0.05, None),
    Rule("dup_line_share", None, 0.5),
    Rule("bullet_line_share", None, 0.9),
    Rule("ellipsis_line_share", None, 0.3),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words inside windows of `size` words that the text holds twice or more, the first one included.

    A text whose windows are all distinct is done after one hash set.  In others the windows are sorted
    by hash, equal neighbours give the repeated places, and a fold over the sorted places adds up
    what each covers beyond the one before.  Windows are compared by their 64-bit hash.
    """

    def places(hashes: Column) -> Column:
        def repeated(ranked: Column) -> Column:
            same = lambda e, i, k: F.coalesce(F.get(ranked, i + k)["h"] == e["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(ranked, lambda e, i: same(e, i, -1) | same(e, i, 1)), lambda e: e["at"]))

        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return let(F.sort_array(pairs), repeated)

    def covered(at: Column) -> Column:
        # every place but the last covers up to the next one, at most the window
        step = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(size)), F.lit(size)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, n: total + n)

    def count(hashes: Column) -> Column:
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, let(places(hashes), covered)).otherwise(F.lit(0).cast("long"))

    starts = F.when(F.size(words) > size, F.sequence(F.lit(0), F.size(words) - size))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.coalesce(let(hashed, count), F.lit(0).cast("long"))


def _count(words: Column, test) -> Column:
    return F.size(F.filter(words, test)).cast("long")


def _is_stop_word(word: Column) -> Column:
    return F.btrim(F.lower(word), F.lit(EDGES)).isin(*STOP_WORDS)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def measures(texts: DataFrame, body: str) -> DataFrame:
    """`texts` with counts and ratios of the text in column `body`; a null text counts as empty."""
    text = F.coalesce(F.col(body), F.lit(""))
    words, lines = F.col("_words"), F.col("_lines")
    trimmed = lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r"))
    counted = (
        texts.withColumns({"_words": words_of(text), "_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
        .withColumns(
            {
                "n_words": F.size(words).cast("long"),
                "word_chars": F.length(F.array_join(words, "")).cast("long"),
                "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                "n_repeat_words": repeated_words(words),
                "n_lines": F.size(lines).cast("long"),
                "n_letter_words": _count(words, lambda w: w.rlike(r"\p{L}")),
                "n_stop_words": _count(words, _is_stop_word),
                "n_bullet_lines": _count(lines, lambda x: trimmed(x).rlike(r"^[-*•]")),
                "n_ellipsis_lines": _count(lines, lambda x: trimmed(x).endswith("...") | trimmed(x).endswith("…")),
            }
        )
        .drop("_words", "_lines")
    )
    return counted.withColumns(
        {
            "mean_word_chars": _share("word_chars", "n_words"),
            "symbols_per_word": _share("n_symbols", "n_words"),
            "letter_share": _share("n_letter_words", "n_words"),
            "stop_share": _share("n_stop_words", "n_words"),
            "dup_line_share": _share("n_dup_lines", "n_lines"),
            "bullet_line_share": _share("n_bullet_lines", "n_lines"),
            "ellipsis_line_share": _share("n_ellipsis_lines", "n_lines"),
        }
    )


def failed_rules(rules: Sequence[Rule]) -> Column:
    """The compiled table: an array of the names of the measures that break their limits."""
    broken = []
    for rule in rules:
        limits = []
        if rule.least is not None:
            limits.append(F.col(rule.measure) < rule.least)
        if rule.most is not None:
            limits.append(F.col(rule.measure) > rule.most)
        for limit in limits:
            broken.append(F.when(limit, F.lit(rule.measure)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def judge_quality(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    min_words: int = MIN_WORDS,
    max_repeat_percent: float = MAX_REPEAT_PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of `docs`: doc_id, counts, base_failed, kept, the other measures and the failed rules.

    base_failed: fewer than `min_words` words, or more than `max_repeat_percent` of the words in repeated
    three-word windows.  kept: neither that nor any rule failed.  One scan, one projection, no
    shuffle: rows, repeated or not, are judged one by one, so ties and hot keys do not matter.  A null
    or empty text has no words and fails the base; an empty table gives an empty result.  Only the two
    named columns are read, whatever others are called.
    """
    measured = measures(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_body")), "_body")
    base = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat_percent) * F.col("n_words"))
    judged = measured.withColumns({"base_failed": base, "failed": failed_rules(rules)})
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept")
    rest = [c for c in judged.columns if c not in {*first, "_body"}]
    return judged.select(*first, kept, *rest)


def keep_good(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that `judge_quality` keeps, with the columns they came with.

    The verdicts are staged: a filter on them would be pushed into the projection and repeat its work.
    """
    whole = unused("_row", docs)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.col(f"`{text}`").alias("_body"))
    judged = stage(judge_quality(packed, doc_id=whole, text="_body", **options).select("doc_id", "kept"), "quality-verdicts")
    return judged.where("kept").select("doc_id.*")
