"""Spelling variant grouping: generated edits probe Bloom filters, positives meet the exact vocabulary in a join."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import ascii_lower, stage

RUN = r"[A-Za-zÀ-ÿ]+"
BREAK = r"[^A-Za-zÀ-ÿ]+"
BITS_PER_WORD = 16
BLOCK_BITS = 256  # a block is four lanes of 64 bits, with two bits of a word in each
LANES = 4
ROUND_WORDS = 4_000_000  # words in the filters of one round: 16 bits each, 8 MB in all
PROBES = 1 << 18  # edits that a task hashes at a time, 2 MB for each array of theirs


def damaged(doc_id: Column, run: Column, every: int) -> Column:
    """`run` without its code point crc32 % length, where `every` divides the crc32 of `<doc_id>:<run>`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int, min_count: int, every: int | None, doc_id: str, text: str) -> DataFrame:
    """word, n: the words of at least `min_length` code points with at least `min_count` occurrences."""
    runs = F.explode(F.split(ascii_lower(F.col(f"`{text}`")), BREAK, -1))
    each = docs.select(F.col(f"`{doc_id}`").alias("_id"), runs.alias("run")).where(F.length("run") >= min_length)
    word = F.col("run") if every is None else damaged(F.col("_id"), F.col("run"), every)
    counted = each.select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# --- hashing: a sum over positions, so that the hash of an edit follows from its word's in one step ------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits, so that every bit of the sum reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(points: np.ndarray) -> np.ndarray:
    return _mixed(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _places(length: int) -> np.ndarray:
    """An odd multiplier for each position."""
    return _mixed(np.arange(1, length + 1, dtype=np.uint64) << np.uint64(32)) | np.uint64(1)


def word_hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, given as rows of code points; unmixed sums."""
    return (_letters(points) * _places(points.shape[1])).sum(axis=1, dtype=np.uint64)


def replaced(points: np.ndarray, hashes: np.ndarray, at: slice, alphabet: np.ndarray) -> np.ndarray:
    """Hashes of the words with each position of `at` replaced by each letter: words x positions x letters."""
    step = _letters(alphabet)[None, None, :] - _letters(points[:, at])[:, :, None]
    return hashes[:, None, None] + step * _places(points.shape[1])[at][None, :, None]


def deleted(points: np.ndarray) -> np.ndarray:
    """Hashes of the words without each position: words x positions."""
    letters, length = _letters(points), points.shape[1]
    here = letters * _places(length)[None, :]
    moved = letters[:, 1:] * _places(length)[None, :-1]  # each letter one place to the left
    before = np.cumsum(here, axis=1) - here
    after = np.zeros_like(here)
    after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1)[:, ::-1]
    return before + after


# --- Bloom filters ---------------------------------------------------------------------------------------


class Filters(NamedTuple):
    """One blocked filter for each word length, one after the other in `blocks`."""

    first: dict[int, int]  # length -> its first block
    size: dict[int, int]  # length -> number of its blocks
    blocks: np.ndarray  # LANES words of 64 bits for each block


def block_sizes(lengths: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """First block and number of blocks of each length, from its number of words."""
    size = {length: max(64, -(-n * BITS_PER_WORD // BLOCK_BITS)) for length, n in sorted(lengths.items())}
    starts = np.concatenate(([0], np.cumsum(list(size.values())))).astype(np.int64)
    return dict(zip(size, starts.tolist())), size


def _spots(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and a second hash whose parts are its bits in the lanes."""
    # the high half picks the block, without a division
    block = ((_mixed(hashes) >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.astype(np.int64), _mixed(hashes + np.uint64(0xD6E8FEB86659FD93))


def _bits(spots: np.ndarray, lane: int) -> np.ndarray:
    """The two bits of each hash in a lane."""
    one, six = np.uint64(1), np.uint64(63)
    return (one << ((spots >> np.uint64(12 * lane)) & six)) | (one << ((spots >> np.uint64(12 * lane + 6)) & six))


def possible(filters: Filters, length: int, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter of `length` may hold the words of these hashes; never false for one it holds."""
    held = np.zeros(hashes.size, dtype=bool)
    if length in filters.size:
        block, spots = _spots(hashes.reshape(-1), filters.size[length])
        left = np.arange(hashes.size)
        for lane in range(LANES):  # most edits fail in the first lanes, and are not looked up again
            bits = _bits(spots, lane)
            passed = filters.blocks[filters.first[length] + block, lane] & bits == bits
            block, spots, left = block[passed], spots[passed], left[passed]
        held[left] = True
    return held.reshape(hashes.shape)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and code points of the words of each length."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        index = np.flatnonzero(lengths == length)
        joined = "".join(words[i] for i in index).encode("utf-32-le")
        yield index, np.frombuffer(joined, dtype="<u4").reshape(len(index), length)


def build_filters(words: DataFrame) -> Filters:
    """Filters of the words, of at most ROUND_WORDS; the driver gets blocks, some two bytes a word."""
    lengths = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    first, size = block_sizes(lengths)
    names = [f"lane{i}" for i in range(LANES)]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index, points in _by_length(batch.column(0).to_pylist()):
                block, spots = _spots(word_hashes(points), size[points.shape[1]])
                lanes = [pa.array(_bits(spots, i).view(np.int64)) for i in range(LANES)]
                columns = [pa.array(first[points.shape[1]] + block), *lanes]
                yield pa.RecordBatch.from_arrays(columns, ["block", *names])

    set_bits = words.select("word").mapInArrow(blocks, "block long, " + ", ".join(f"{n} long" for n in names))
    merged = set_bits.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names]).toPandas()
    table = np.zeros((sum(size.values()), LANES), dtype=np.uint64)
    table[merged["block"].to_numpy(np.int64)] = merged[names].to_numpy(np.int64).view(np.uint64)
    return Filters(first, size, table)


# --- neighbours ------------------------------------------------------------------------------------------


def probe_words(words: list[str], filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """(index, edit) for every edit of a word that the filters may hold.

    Edits are deletions, one for each run of equal letters, and replacements by a later letter: of every
    two near words one is such an edit of the other, and of one kind at one place only.
    """
    for index, points in _by_length(words):
        length = points.shape[1]
        rows = max(1, PROBES // (length * len(alphabet)))
        for start in range(0, len(index), rows):
            part, own = points[start : start + rows], index[start : start + rows]
            hashes = word_hashes(part)
            changes = np.ones(part.shape, dtype=bool)
            changes[:, 1:] = part[:, 1:] != part[:, :-1]
            if length > 1:
                for i, at in zip(*np.nonzero(possible(filters, length - 1, deleted(part)) & changes)):
                    word = words[own[i]]
                    yield int(own[i]), word[:at] + word[at + 1 :]
            columns = max(1, PROBES // (len(part) * len(alphabet)))
            for left in range(0, length if length in filters.size else 0, columns):
                at = slice(left, min(left + columns, length))
                later = alphabet[None, None, :] > part[:, at][:, :, None]
                for i, j, k in zip(*np.nonzero(possible(filters, length, replaced(part, hashes, at, alphabet)) & later)):
                    word, place = words[own[i]], left + j
                    yield int(own[i]), word[:place] + chr(alphabet[k]) + word[place + 1 :]


def probable_edits(words: DataFrame, filters: Filters, alphabet: np.ndarray) -> DataFrame:
    """word, n, edit for every edit of a word that passes the broadcast filters."""
    shared = words.sparkSession.sparkContext.broadcast((*filters, alphabet))  # plain values: executors need no package

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, letters = shared.value
        held = Filters(*parts)
        for batch in batches:
            texts, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found, size = [], 0
            for i, edit in probe_words(texts, held, letters):
                found.append((texts[i], counts[i], edit))
                size += len(edit) + len(texts[i])
                if size > 4_000_000 or len(found) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["word", "n", "edit"])
                    found, size = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["word", "n", "edit"])

    return words.select("word", "n").mapInArrow(probe, "word string, n long, edit string")


def near_pairs(words: DataFrame, round_words: int = ROUND_WORDS) -> DataFrame:
    """word, n, other, other_n: both directions of every two words one insertion, deletion or replacement apart.

    `words` (word, n) is staged and unique.  A vocabulary beyond `round_words` is dealt by hash over several
    rounds, each with filters of its part alone, so no broadcast grows with the vocabulary.  Only edits
    that pass are shuffled, and the join with the words themselves removes the filters' false positives.
    """
    letters = F.explode(F.array_distinct(F.split("word", "")))
    points = [ord(r[0]) for r in words.select(letters.alias("c")).where("c != ''").distinct().collect()]  # RUN's letters at most
    alphabet = np.array(sorted(points), dtype=np.uint32)
    total = words.count()
    rounds, found = max(1, -(-total // round_words)), []
    for r in range(rounds):
        own = words.where(F.pmod(F.xxhash64("word"), F.lit(rounds)) == r)
        probable = probable_edits(words, build_filters(own), alphabet)
        known = own.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
        found.append(probable.join(known, probable["edit"] == known["other"]).select("word", "n", "other", "other_n"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = stage(pairs, "spelling-pairs")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for words with a form (staged: word, form), following forms to the last one.

    A form occurs several times as often as its word, so chains are short; every round doubles the
    steps taken.
    """
    known = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = known.join(further, "root", "left")
        moved = stage(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        known = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return known


def group_variants(
    docs: DataFrame,
    min_length: int = 6,
    min_count: int = 5,
    ratio: int = 5,
    damage_every: int | None = None,
    round_words: int = ROUND_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the corpus, each with the form it varies.

    Words are maximal runs of letters of whole texts, A-Z lower-cased, with at least `min_length` code points and
    `min_count` occurrences (n).  Near words are one inserted, deleted or replaced code point apart; n_near
    counts them.  The form is the near word of largest n (ties: first in code-point order) if it occurs at
    least `ratio` times as often, else null; the root is the end of the chain of forms, or the word itself.
    With `damage_every`, one of so many occurrences loses a letter first, by a hash of id and run.

    A null or empty text has no words; a null id counts as empty text; repeated rows count again; an empty table
    gives an empty result.  Only the named columns are read.  Counting is a partial aggregate, so frequent words
    make no large task; a word has as many near words as edits, so neither do the joins.
    """
    if ratio < 2:
        raise ValueError("a form occurs more often than its variant")
    words = stage(vocabulary(docs, min_length, min_count, damage_every, doc_id, text), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("least"), F.col("other").alias("word")))
    near = near_pairs(words, round_words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.least")
    enough = form_n >= ratio * F.col("n")
    near = near.select("word", "n_near", F.when(enough, F.col("best.word")).alias("form"), F.when(enough, form_n).alias("form_n"))
    near = stage(near, "spelling-near")
    ends = roots(near.where("form is not null"))
    joined = words.join(near, "word", "left").join(ends, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
