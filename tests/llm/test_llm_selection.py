"""Importance resampling, spelling variants and quality rules against their plain definitions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_fixtures import make_docs, odd_pairs  # noqa: F401
from ordermill.llm import quality_rules, resample, spelling
from ordermill.llm.common import stage

TARGET = "item_id long, text string, doc_id string, _buckets string, rank long"


@pytest.fixture(scope="module")
def corpus(odd_pairs):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    docs = list(odd_pairs) + [(1000 + i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(300)]
    same = " ".join(word() for _ in range(30))
    docs += [(7, same)] * 40 + [(None, same)] * 40 + [(8, same), (8, same + " x")]  # repeated rows, a hot and a null id
    target = [" ".join(word() for _ in range(40)) for _ in range(10)] + [None, "", same]
    return docs, target


def targets(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", None) for i, t in enumerate(texts)], TARGET)


@pytest.mark.parametrize("options", [{}, {"longest": 2, "buckets": 50, "percent": 37, "min_words": 5}])
def test_resample(spark, make_docs, corpus, options):
    docs, target = corpus
    clashing = make_docs(docs).withColumns({c: F.lit("own") for c in ("_buckets", "rank", "weight", "_row", "low")})
    got = resample.resample(clashing, targets(spark, target), finish=8, **options).collect()
    expected = brute.resampled(docs, target, **options)
    # ties of id and score rank in any order: compare without ranks, then the ranked keys in order
    assert Counter(tuple(r)[:4] for r in got) == Counter(tuple(r[:4]) for r in expected)
    key = lambda rows: [(r[3], r[0]) for r in sorted((r for r in rows if r[4] is not None), key=lambda r: r[4])]
    assert key(got) == key(expected) and len(key(got)) > 10
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, len(key(got)) + 1))


def test_resample_of_empty_tables(spark, make_docs, corpus):
    docs, target = corpus
    assert resample.resample(make_docs([]), targets(spark, target)).count() == 0
    got = resample.resample(make_docs(docs), targets(spark, [])).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(tuple(r[:4]) for r in brute.resampled(docs, []))
    none = resample.resample(make_docs(docs), targets(spark, target), percent=0)
    assert none.where("rank is not null").count() == 0 and none.count() == len(docs)
    drawn = resample.draw(make_docs(docs), targets(spark, target), percent=100, min_words=1)
    assert drawn.columns == make_docs([]).columns and drawn.where("doc_id = 7").count() == 41
    assert drawn.where("doc_id is null").count() == sum(d is None for d, _ in docs)  # every row of a drawn id


@pytest.mark.parametrize("n", [1, 2, 5, 100, 5000])
def test_cutoff_is_exact_under_any_order(spark, n):
    """Sorted, constant and random scores over few and many partitions, with a small finish."""
    rng = random.Random(n)
    for scores in ([rng.randint(-5, 5) for _ in range(n)], list(range(n)), [3] * n):
        rows = [(s, rng.randint(0, 3), rng.randint(0, 2), i) for i, s in enumerate(scores)]
        keys = stage(spark.createDataFrame(rows, "low long, id long, text long, row long").repartition(7), "test-keys")
        for k in {1, max(1, n // 3), n}:
            assert resample.cutoff_key(keys, k, finish=3) == sorted(rows)[k - 1]
    assert resample.cutoff_key(keys, 0) is None


def test_each_round_discards_a_quarter(spark, monkeypatch):
    rows = [(i * i % 7919, 0, 0, i) for i in range(4000)]
    keys = stage(spark.createDataFrame(rows, "low long, id long, text long, row long").orderBy("low"), "test-keys")
    sizes, medians = [], resample.partition_medians
    monkeypatch.setattr(resample, "partition_medians", lambda k: sizes.append(k.count()) or medians(k))
    assert resample.cutoff_key(keys, 400, finish=10) == sorted(rows)[399]
    assert all(b <= 0.75 * a + 1 for a, b in zip(sizes, sizes[1:])) and len(sizes) > 4


@pytest.fixture(scope="module")
def misspelt(odd_pairs):
    rng = random.Random(13)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "ÀÉÿÿÿÿÿ"]
    words = []
    for s in stems:
        words += [s] * rng.randint(1, 60)
        for _ in range(rng.randint(0, 6)):
            i, c = rng.randrange(len(s)), rng.choice("abcdéz")
            v = rng.choice([s[:i] + s[i + 1 :], s[:i] + c + s[i:], s[:i] + c + s[i + 1 :]])
            words += [v] * rng.randint(1, 12)
    words += ["chaining"] * 200 + ["chainin"] * 35 + ["chaini"] * 6  # each the form of the next
    long = "q" * 3000
    words += [long] * 30 + [long + "r"] * 5 + [long[:-1] + "s"] * 6
    rng.shuffle(words)
    return list(odd_pairs) + [(i % 40, ", ".join(words[i::200]).title() if i % 3 else " ".join(words[i::200])) for i in range(200)]


@pytest.mark.parametrize("options", [{}, {"every": 7}, {"min_length": 2, "min_count": 2, "ratio": 2}])
def test_spelling(spark, make_docs, misspelt, options):
    named = {("damage_every" if k == "every" else k): v for k, v in options.items()}
    clashing = make_docs(misspelt).withColumns({c: F.lit("own") for c in ("word", "n", "_id", "run", "edit")})
    got = spelling.group_variants(clashing, **named).collect()
    expected = brute.spelling(misspelt, **options)
    assert Counter(map(tuple, got)) == Counter(expected)
    assert sum(r.form is not None for r in got) > 5 and any(r.root not in (r.form, r.word) for r in got)


def test_spelling_in_rounds(spark, make_docs, misspelt):
    """A vocabulary dealt over many rounds of filters gives the same pairs."""
    docs = make_docs(misspelt)
    one, many = spelling.group_variants(docs), spelling.group_variants(docs, round_words=20)
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, many.collect()))


def test_spelling_of_few_words(spark, make_docs):
    assert spelling.group_variants(make_docs([])).count() == 0
    assert spelling.group_variants(make_docs([(1, None), (2, ""), (3, "one two")])).count() == 0
    alone = spelling.group_variants(make_docs([(1, "letters " * 5)])).collect()
    assert list(map(tuple, alone)) == [("letters", None, "letters", 5, 0, None)]
    with pytest.raises(ValueError):
        spelling.group_variants(make_docs([]), ratio=1)


def test_edit_hashes_are_the_hashes_of_the_edits():
    words = ["abcde", "aabba", "éèêëa"]
    (_, points), = spelling._by_length(words)
    code = lambda w: spelling.word_hashes(np.array([[ord(c) for c in w]], dtype=np.uint32))[0]
    gone, alphabet = spelling.deleted(points), np.array([97, 122, 233], dtype=np.uint32)
    changed = spelling.replaced(points, spelling.word_hashes(points), slice(0, 5), alphabet)
    for i, w in enumerate(words):
        for p in range(5):
            assert gone[i, p] == code(w[:p] + w[p + 1 :])
            for k, c in enumerate(alphabet):
                assert changed[i, p, k] == code(w[:p] + chr(c) + w[p + 1 :])


def test_filters_hold_their_words_and_little_else(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 9))) for _ in range(20_000)})
    held, others = words[::2], words[1::2]
    filters = spelling.build_filters(stage(spark.createDataFrame([(w, 1) for w in held], "word string, n long"), "test-words"))
    passed = {name: 0 for name in ("held", "others")}
    for name, group in (("held", held), ("others", others)):
        for _, points in spelling._by_length(group):
            passed[name] += int(spelling.possible(filters, points.shape[1], spelling.word_hashes(points)).sum())
    assert passed["held"] == len(held) and passed["others"] < 0.02 * len(others)
    assert len(filters.blocks) * 32 < 4 * len(held) + 64 * 32 * 4


@pytest.fixture(scope="module")
def shaped(odd_pairs):
    rng = random.Random(17)
    prose = lambda n, k=40: " ".join(rng.choice(["the", "of,", "and", "de", "der", *[f"wort{i}" for i in range(k)]]) for _ in range(n))
    docs = list(odd_pairs) + [(2000 + i, prose(rng.randint(0, 120), rng.choice([2, 40, 2000]))) for i in range(80)]
    docs += [
        (3000, "a b c " * 40), (3001, "\n".join([prose(12)] * 8)), (3002, "\n".join("- " + prose(8) for _ in range(10))),
        (3003, "\n".join(prose(8) + " ..." for _ in range(10))), (3004, "### $$$ " + prose(60)), (3005, " ".join(f"{w}&&&" for w in prose(80).split())),
        (3006, "1 22 333 " * 30 + prose(60, 2000)), (3007, "xyzzy" * 5 + " " + " ".join(f"q{i}" * 4 for i in range(90))), (3008, "a a a a " * 30), (3009, "x\x0by z\r\n" * 30),
    ]
    return docs


def test_rules(spark, make_docs, shaped):
    clashing = make_docs(shaped).withColumns({c: F.lit("own") for c in ("kept", "n_words", "_body", "_words", "failed")})
    got = quality_rules.judge_quality(clashing).collect()
    expected = [(d, *brute.rule_counts(t)) for d, t in shaped]
    assert Counter(tuple(r)[:7] for r in got) == Counter(expected)
    assert all(r.kept == (not r.base_failed and not r.failed) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert "bullet_line_share" in by_id[3002].failed and "ellipsis_line_share" in by_id[3003].failed
    assert not by_id[3004].failed and "symbols_per_word" in by_id[3005].failed and "letter_share" in by_id[3006].failed
    assert {"n_stop_words", "stop_share"} <= set(by_id[3007].failed) and by_id[3001].base_failed
    assert Counter(r.base_failed for r in got)[False] > 40
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns and {r.kept for r in kept.collect()} == {"own"}
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(p for p, r in zip(shaped, map(brute.rule_counts, [t for _, t in shaped])) if by_id[p[0]].kept)


def test_rules_are_a_table(spark, make_docs):
    docs = make_docs([(1, "one two three"), (2, "#one #two"), (3, None)])
    only = [quality_rules.Rule("symbols_per_word", None, 0.5), quality_rules.Rule("n_words", 1, 3)]
    got = quality_rules.judge_quality(docs, only, min_words=0).collect()
    assert {r.doc_id: (r.kept, r.failed) for r in got} == {1: (True, []), 2: (False, ["symbols_per_word"]), 3: (False, ["n_words"])}
    assert quality_rules.judge_quality(docs, [], min_words=0).where("kept").count() == 3
    assert quality_rules.judge_quality(make_docs([])).count() == 0


def test_rules_on_a_million_characters(spark, make_docs):
    """One text of a million characters whose windows repeat, and one whose windows do not."""
    repeated = "lorem ipsum dolor sit amet consectetur " * 26_000
    distinct = " ".join(f"word{i}" for i in range(110_000))
    got = {r.doc_id: r for r in quality_rules.judge_quality(make_docs([(1, repeated), (2, distinct)])).collect()}
    assert got[1].n_repeat_words == got[1].n_words == 156_000 and got[1].base_failed
    assert got[2].n_repeat_words == 0 and not got[2].base_failed
