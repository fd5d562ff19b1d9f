"""Language, quality, licences and vectors: held-out accuracy, brute force and odd rows."""

import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from ordermill.llm import embeddings, language, licenses, quality
from ordermill.llm.components import components

SYLLABLES = {"aa": ["ba", "lo", "mi", "the"], "bb": ["sch", "ung", "ei", "zu"], "cc": ["ción", "ñ", "que", "os"]}


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        name = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 50))]
        rows.append((i, " ".join(words), name if rng.random() < 0.9 else None, name))
    rows += [(1000, None, "aa", "und"), (1001, "", None, "und"), (1002, "12 !? \n", "bb", "und"), (None, "ba lo mi ba lo", "zz", "aa")]
    rows += [(1003, "schung eischzu " * 20_000, None, "bb"), (5, rows[5][1], rows[5][2], rows[5][3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    return frame.withColumnsRenamed({"truth": "score"}), rows  # a clashing extra column


def test_language(tongues):
    frame, rows = tongues
    got = language.identify(frame, sample=240, landmarks=40).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    truth = {r[0]: r[3] for r in rows}
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} == {"aa", "bb", "cc", "und"}  # zz has no id to learn by
    assert all((r.lang_pred == "und") == (truth[r.doc_id] == "und") for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.99 * len(got)
    kept = language.keep_languages(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, t in truth.items() if t != "und"}


def test_language_without_labels(spark, tongues):
    frame, rows = tongues
    assert language.identify(frame.limit(0)).count() == 0
    blind = frame.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.identify(blind).collect()} == {("und", 0.0)}
    assert language.keep_languages(blind).count() == 0


def test_very_many_languages_and_a_hot_id(spark):
    """Five thousand labels, one id with a third of the rows: the sample keeps to its bound."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, f"{word()} {word()}", f"l{i % 5000}") for i in range(6000)]
    hot, same = [i for i in range(100) if not brute.held_out(i)][:2]
    rows += [(hot, f"{word()} {word()}", "l1") for _ in range(3000)] + [(same, "same text", "l2")] * 3000
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = language._training_rows(frame, 400, "doc_id", "text", "lang").collect()
    counts = Counter(r.lang for r in chosen)
    assert len(counts) <= language.MOST_LANGUAGES and max(counts.values()) <= 60 and len(chosen) == len(set(chosen))
    model = language.train(frame, sample=400, landmarks=40)
    assert len(model.languages) <= language.MOST_LANGUAGES and "l1" in model.languages
    got = language.identify(frame, sample=400, landmarks=40)
    assert got.count() == len(rows) and {r[0] for r in got.select("lang_pred").distinct().collect()} <= set(model.languages)


def test_short_texts_of_a_learned_language_stay(spark, tongues):
    frame, rows = tongues
    short = spark.createDataFrame([(5000 + n, r[1].split()[0][:2], None, None) for n, r in enumerate(rows) if r[2] and (r[1] or '').split()], frame.schema)
    lettered = short.where(language.has_letter(F.col("text")))
    kept = language.keep_languages(frame.union(lettered)).where("doc_id >= 5000")
    assert kept.count() == lettered.count() > 100
    assert language.keep_languages(frame.union(spark.createDataFrame([(9999, "漢字仮名", None, None)], frame.schema))).where("doc_id = 9999").count() == 0


def test_kernel_ridge_by_its_plain_form(spark, tongues):
    """The whole operator on few rows against kernel matrices of n-gram sets, all rows as landmarks."""
    frame, rows = tongues
    few = frame.where("doc_id < 80")
    got = {r.doc_id: r for r in language.identify(few, sample=100_000, landmarks=100_000, ridge=1e-3).collect()}
    learned = {(r.doc_id, r.text, r.lang) for r in few.collect() if r.lang and r.doc_id is not None and not brute.held_out(r.doc_id)}
    learned = [r for r in learned if any(c.isalpha() for c in r[1] or "")]
    held = np.stack([language.presence(t) for _, t, _ in learned]).astype(float)
    held /= np.sqrt(held.sum(axis=1, keepdims=True))
    names = sorted({lang for *_, lang in learned})
    y = np.array([[float(lang == n) for n in names] for *_, lang in learned])
    weight = (len(learned) / len(names) / y.sum(axis=0) * y).sum(axis=1)
    kernel = held @ held.T
    # weighted kernel ridge regression: alpha = (K + ridge * n * W^-1)^-1 y
    alpha = np.linalg.solve(kernel + 1e-3 * len(learned) * np.diag(1 / weight), y)
    for doc_id, text, _, _ in [r for r in rows if r[0] is not None and r[0] < 80]:
        if got[doc_id].lang_pred != "und":
            x = language.presence(text).astype(float)
            outputs = (x / np.sqrt(max(x.sum(), 1))) @ held.T @ alpha
            assert got[doc_id].score == pytest.approx(min(max(outputs.max(), 0), 1), abs=2e-3)
            best = np.sort(outputs)
            assert got[doc_id].lang_pred == names[outputs.argmax()] or best[-1] - best[-2] < 1e-3


def test_presence_follows_whole_letters():
    same = language.presence("Été, 12 été!! ###")
    assert (same == language.presence("été été")).all() and not (same == language.presence("ete")).all()
    assert language.presence("").sum() <= 3


def test_landmark_weights_equal_the_kernel_form():
    """One product with the folded weights is the kernel expansion over landmarks."""
    rng = np.random.default_rng(3)
    marks, weights = rng.random((5, language.SLOTS), dtype=np.float32), rng.random((5, 2), dtype=np.float32)
    texts = ["some text of words", "another one"]
    held = np.stack([language.presence(t) for t in texts]).astype(np.float32)
    norm = np.sqrt(held.sum(axis=1, keepdims=True))
    np.testing.assert_allclose(language.score_texts(texts, marks.T @ weights), (held @ marks.T) @ weights / norm, rtol=1e-4)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(700):
        good = rng.random() < 0.7
        words = [rng.choice(["house", "tree", "river", "stone", "light", "paper"]) + str(rng.randint(0, 99) if not good else "") for _ in range(rng.randint(20, 80))]
        text = " ".join(words) + "." if good else " ".join(w + rng.choice(["***", "!!", "&&"]) for w in words)
        docs.append((i, text, "q"))
        if rng.random() < 0.8:
            labels.append((i, int(good), 0))
    docs += [(900, None, None), (901, "", None), (None, "tree house", None), (902, "light " * 40_000, None), (3, docs[3][1], "q")]
    labels += [(901, None, 1), (None, 1, 1), (902, 7, 0), (5, 0, 0), (5, 1, 0), (5000, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, quality string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: q for i, q, _ in labels[:-6]},
        docs,
    )


def test_quality(judged):
    docs, labels, truth, rows = judged
    got = quality.score_quality(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_quality_rules_are_sparse_and_match_their_expression(spark, judged):
    docs, labels, truth, _ = judged
    measured = quality.with_statistics(docs, "text").join(labels.where("quality in (0, 1)").select("doc_id", "quality").withColumnRenamed("quality", "_label"), "doc_id")
    names = list(quality.statistics(docs["text"]))
    model = quality.train(measured, names, "_label")
    assert 0 < len(model.rules) < 100 and all(w for _, w in model.rules)
    for r in measured.withColumn("p", quality.score(model)).limit(50).collect():
        holds = lambda c: all((r[n] <= b) == low for n, low, b in c)
        total = model.intercept + sum(w for c, w in model.rules if holds(c))
        assert math.isclose(r.p, 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_quality_without_labels(judged):
    docs, labels, _, rows = judged
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert len({r.score for r in quality.score_quality(docs, labels.where("quality = 1")).collect()}) == 1
    assert quality.score_quality(docs.limit(0), labels).count() == 0


CODE = "import sys\nfor name in sys.argv:\n    print(open(name).read(), end=name * 2, file=out)\n"
FILES = [
    (1, "a/LICENSE", "\n".join(licenses.TEMPLATES["MIT"][:2])),
    (2, "a/b/x.py", "import os\n# nothing here"),
    (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\n" + CODE),
    (4, "a/b/c/z.py", None),
    (5, "a/d/COPYING", "Licensed under CC BY-NC 4.0."),
    (6, "a/d/e/f/g.txt", "plain words about a free tree"),
    (7, "top.txt", "no licence above the root"),
    (8, None, "released under the mit license"),
    (9, None, ""),
    (10, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\n" + CODE),
    (10, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\n" + CODE),
    (11, "q/long.txt", "free software under the public house " * 9000 + "\nReleased under the MIT License."),
    (None, "q/r.txt", "Released under\nthe MIT License"),
]


def test_licenses(spark):
    frame = spark.createDataFrame([(*f, "x", "y") for f in FILES], "doc_id long, path string, text string, license string, words string")
    got = licenses.scan_licenses(frame).collect()
    said = {(r.doc_id, r.path): (r.license, r.origin, r.license_dir) for r in got}
    assert len(got) == len(FILES)
    assert said[1, "a/LICENSE"][:2] == ("MIT", "header")
    assert said[2, "a/b/x.py"] == ("MIT", "inherited", "a") and said[4, "a/b/c/z.py"] == ("MIT", "inherited", "a")
    assert said[3, "a/b/y.py"] == said[10, "a/b/y.py"] == ("Apache-2.0", "header", None)
    assert said[6, "a/d/e/f/g.txt"] == ("CC-BY-NC-4.0", "inherited", "a/d")
    assert said[7, "top.txt"] == (None, None, None) and said[9, None] == (None, None, None)
    assert said[8, None] == ("MIT", "header", None) and said[11, "q/long.txt"] == ("MIT", "header", None)
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


def test_license_scores_equal_plain_cosines(spark):
    frame = spark.createDataFrame(FILES, "doc_id long, path string, text string")
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    sets = [set(words(t)) for _, _, t in FILES]
    known = {w for ts in licenses.TEMPLATES.values() for t in ts for w in words(t)}
    unseen = math.log(len(FILES) + 1) + 1
    idf = lambda w: math.log((len(FILES) + 1) / (sum(w in s for s in sets) + 1)) + 1 if w in known else unseen
    vector = lambda t: {w: n * idf(w) for w, n in Counter(words(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def best(text):
        v, found = vector(text), (0, "")
        for name, texts in licenses.TEMPLATES.items():
            for t in texts:
                u = vector(t)
                if v:
                    score = sum(x * u.get(w, 0) for w, x in v.items()) / norm(u) / norm(v)
                    found = max(found, (round(score, 6), name), key=lambda p: p[0])
        return found

    for r in licenses.scan_licenses(frame).where("origin = 'header'").collect():
        text = next(t for d, p, t in FILES if (d, p) == (r.doc_id, r.path))
        lines = max(best(line) for line in text.split("\n"))
        whole = best(text)
        reached = [s for s, at_least in ((lines, 0.7), (whole, 0.6)) if s[0] >= at_least]
        assert math.isclose(r.score, max(reached)[0], abs_tol=2e-6)


def wrapped(text, lead=" * "):
    return "\n".join(lead + line for line in textwrap.wrap(" ".join(text.split()), 60))


FULL = {name: texts[-1] for name, texts in licenses.TEMPLATES.items()}
GPL = next(t for t in licenses.TEMPLATES["GPL-3.0"] if "You should have received" in t and len(t) < 2000)
GPL_2 = GPL.replace("version 3", "version 2")
BSD_2 = "\n".join(line for line in FULL["BSD-3-Clause"].split("\n") if not re.search("Neither the name|may be used|without specific", line))
SPOKEN = [
    *((f"full/{name}/text.txt", "Copyright 2020 Some One\n\n" + wrapped(text, ""), name) for name, text in FULL.items()),
    ("h/gpl.c", "/*\n * frob - frobs the tree\n * Copyright (C) 2019 Some One\n *\n" + wrapped(GPL) + "\n */\n" + CODE, "GPL-3.0"),
    ("h/apache.py", "#!/usr/bin/python\n# Copyright 2020\n#\n" + wrapped(licenses.TEMPLATES["Apache-2.0"][3], "# ") + "\n" + CODE, "Apache-2.0"),
    ("h/mpl.js", wrapped(licenses.TEMPLATES["MPL-2.0"][2], "// ") + "\n" + CODE, "MPL-2.0"),
    ("h/gpl2.c", "/*\n" + wrapped(GPL_2) + "\n */\n" + CODE, None),
    ("h/lgpl.c", "/*\n" + wrapped(GPL.replace("General Public", "Lesser General Public")) + "\n */\n" + CODE, None),
    ("h/two.txt", "This work is licensed under the GNU General Public License, version 2.", None),
    ("h/sa.txt", "Licensed under CC BY-SA 4.0.", None),
    ("h/three.txt", "This work is licensed under a Creative Commons Attribution 3.0 Unported License.", None),
    ("h/mpl1.txt", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", None),
    ("h/isc.py", "# SPDX-License-Identifier: ISC\n" + CODE, None),
    ("h/either.py", "# SPDX-License-Identifier: MIT OR Apache-2.0\n" + CODE, "Apache-2.0"),
    ("b/text.txt", BSD_2, None),
    ("g/text.txt", FULL["GPL-3.0"].replace("Version 3, 29 June 2007", "Version 2, June 1991"), None),
    ("long.py", "# a remark\n" * 50_000 + CODE, None),
]


def test_whole_licences_wrapped_headers_and_unlisted_versions(spark):
    rows = [(i, f"{i}/{p}", t) for i, (p, t, _) in enumerate(SPOKEN)]
    rows += [(100 + i, f"{i}/full/{n}/a/b.py", CODE) for i, n in enumerate(FULL)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    said = {r.path: (r.license, r.origin) for r in got}
    expected = {f"{i}/{p}": (name, name and "header") for i, (p, _, name) in enumerate(SPOKEN)}
    expected |= {f"{i}/full/{n}/a/b.py": (n, "inherited") for i, n in enumerate(FULL)}
    assert said == expected


VECTORS = "vec_id long, embedding array<float>, label int, point string, links long"


def vector_rows(seed, dim=24):
    rng = np.random.default_rng(seed)
    rows, n = [], 0

    def add(vector, label):
        nonlocal n
        rows.append((n * 3 % 1001, None if vector is None else [float(x) for x in vector], label, "p", 1))
        n += 1

    for label in (0, 1, 2):
        for _ in range(40):
            add(rng.standard_normal(dim), label)
        for size, spread in ((30, 0.08), (12, 0.14), (5, 0.2)):
            centre = rng.standard_normal(dim)
            for _ in range(size):
                add(centre + spread * rng.standard_normal(dim), label)
    same = rng.standard_normal(dim).astype(np.float32)
    for label in (0, 0, 0, 1, None):
        add(same, label)
    add(same * 2, 0)
    for odd in (None, [], [0.0] * dim, [math.nan] * dim, [math.inf] + [1.0] * (dim - 1), same[:5], same[:5]):
        add(odd, 0)
    rows.append((2000, [None, 1.0], 0, None, None))
    rows.append((None, [float(x) for x in same], 0, None, None))
    return rows


@pytest.mark.parametrize("seed,chunk", [(1, 2048), (2, 7)])
def test_vectors(spark, seed, chunk):
    rows = vector_rows(seed)
    got = embeddings.near_vectors(spark.createDataFrame(rows, VECTORS), chunk=chunk).collect()
    usable = [
        i for i, (_, v, label, _, _) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    unit = {i: np.array(np.float32(rows[i][1]), dtype=float) for i in usable}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links, groups = Counter(), brute.Groups()
    for i in usable:
        for j in usable:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    least = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            r = groups.root(i)
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    expected = [(v[0], links[i], least.get(groups.root(i))) for i, v in enumerate(rows)]
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(expected)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and sum(links.values()) > 1000


def pairs_of(shown, blocks, plan):
    return {(i, j) for a, b in embeddings.colliding(shown, blocks, plan) for i, j in zip(a.tolist(), b.tolist())}


@pytest.mark.parametrize("counters", [1 << 20, 100])
def test_collisions_of_windows(counters, monkeypatch):
    """The counts of sorted windows are those of every pair compared, block by block, in tiles of any size."""
    monkeypatch.setattr(embeddings, "COUNTERS", counters)
    rng, plan = np.random.default_rng(5), embeddings.calibrated(0.98, 1000, 0.99)
    blocks = np.repeat([3, 9, 4, 7], [40, 1, 90, 2])
    shown = embeddings.shown_of(np.repeat(rng.standard_normal((7, 8)), 19, axis=0) / 3 + 0.05 * rng.standard_normal((133, 8)))
    shown[5:9] = (32767, -32768, 32767, -32768) * 4
    steps = math.ceil(plan.window / embeddings.STEP) + 1
    hits = (np.abs(shown[:, None].astype(int) - shown[None].astype(int)) <= steps).sum(axis=2)
    a, b = np.nonzero((hits >= plan.least) & (blocks[:, None] == blocks[None]))
    assert pairs_of(shown, blocks, plan) == {(i, j) for i, j in zip(a.tolist(), b.tolist()) if i < j} != set()


def test_a_pair_outside_one_window_alone_is_found():
    rng, plan = np.random.default_rng(8), embeddings.calibrated(0.98, 1000, 0.99)
    axes = embeddings._directions(24, embeddings.COUNTED, 1)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    for _ in range(100_000):
        a = unit(rng.standard_normal(24))
        b = unit(a + 0.19 * unit(rng.standard_normal(24)))
        gap = (b - a) @ axes
        if a @ b >= 0.981 and plan.window * 1.1 < gap[0] < plan.window * 1.5 and (np.abs(gap[1:]) <= plan.window).all():
            break
    else:
        raise AssertionError("no such pair")
    others = unit(rng.standard_normal((60_000, 24)))
    first = others @ axes[:, 0] - a @ axes[:, 0]
    others = others[(first > 0) & (first < gap[0] - plan.window)][:600]
    assert len(others) == 600
    shown = embeddings.shown_of(np.concatenate([[a, b], others]))
    assert (0, 1) in pairs_of(shown, np.zeros(len(shown), dtype=int), plan)


def test_recall_right_at_the_threshold(spark):
    """Four thousand pairs at cosine 0.98 to 0.981, none closer, among unrelated vectors: brute force tells the links."""
    rng, dim, n = np.random.default_rng(11), 64, 4000
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    first = unit(rng.standard_normal((n, dim)))
    aside = rng.standard_normal((n, dim))
    aside = unit(aside - (aside * first).sum(axis=1, keepdims=True) * first)
    c = rng.uniform(0.98, 0.981, (n, 1))
    vectors = np.concatenate([first, c * first + np.sqrt(1 - c * c) * aside, unit(rng.standard_normal((1000, dim)))])
    exact = unit(vectors.astype(np.float32).astype(float))
    a, b = np.nonzero(np.triu(exact @ exact.T >= 0.98, 1))
    true = {(i, j) for i, j in zip(a.tolist(), b.tolist())}
    rows = [(i, [float(x) for x in v], 0, None, None) for i, v in enumerate(vectors.astype(np.float32))]
    got = embeddings.near_vectors(spark.createDataFrame(rows, VECTORS)).where("not kept").collect()
    found = {(r.component_id, r.vec_id) for r in got}
    assert found <= true and len(true) > 3900
    assert len(found) >= 0.99 * len(true), len(found) / len(true)


def test_vectors_of_an_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_calibration_grows_gently():
    small, large = embeddings.calibrated(0.98, 1_000, 0.99), embeddings.calibrated(0.98, 10**9, 0.99)
    assert small.width < large.width <= 24 and small.tables < large.tables < 100 and small.least == large.least


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(i, i + 1) for i in range(500, 560)] + [(3, 3)]
    groups = brute.Groups()
    for a, b in links:
        groups.join(a, b)
    expected = {x: groups.root(x) for x in list(groups.up) if groups.root(x) != x}
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in got} == expected and len(got) == len(expected)
