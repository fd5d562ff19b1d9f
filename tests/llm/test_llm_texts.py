"""Decontamination, fingerprints, lines and personal data against their plain definitions."""

import hashlib
import random
from collections import Counter

import pytest

import brute
from llm_fixtures import make_docs, odd_pairs  # noqa: F401
from ordermill.llm.decontaminate import drop_contaminated, mark_contaminated
from ordermill.llm.line_dedup import dedup_lines
from ordermill.llm.pii import estimate, find_pii
from ordermill.llm.simhash import keep_one, linked, near_groups

ITEMS = "item_id long, text string, extra string"


def hashed(ids):
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


@pytest.fixture(scope="module")
def leaky(odd_pairs):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh") + rng.choice(["", "é", "É", "1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 7, 10, 11, 25])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "..."), (None, "no id here at all"), (3, "second text of three"), (30, "alpha Beta gamma")]
    docs = list(odd_pairs)
    for i in range(60):
        filler = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        _, a = rng.choice(items[:12])
        docs.append((500 + i, f"{filler[0]}, {a.upper()} {filler[1]}-{a.replace(' ', '; ')} {filler[2]}"))
    docs += [(700, "No ID here, at ALL"), (701, "a a a a a a a a a a a a"), (702, "second text of three")]
    return docs, items


@pytest.mark.parametrize("window", [10, 2, 4])
def test_contamination(spark, make_docs, leaky, window):
    docs, items = leaky
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    got = mark_contaminated(make_docs(docs), frame, window)
    expected = brute.contaminated(docs, items, window)
    assert Counter(tuple(r)[:6] for r in got.collect()) == Counter(expected)
    assert all(sum(e - s for s, e in r.hit_spans or []) == r.n_hit for r in got.collect())
    kept = drop_contaminated(make_docs(docs), frame, window)
    assert kept.columns == make_docs([]).columns
    clean = [d for d, row in zip(docs, expected) if not row[5]]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(clean)


def test_windows_beyond_a_broadcast(spark, make_docs, leaky, monkeypatch):
    docs, items = leaky
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    monkeypatch.setattr("ordermill.llm.decontaminate.SENT", 0)
    got = mark_contaminated(make_docs(docs), frame, 10)
    assert Counter(tuple(r)[:6] for r in got.collect()) == Counter(brute.contaminated(docs, items, 10))


def test_contamination_of_empty_tables(spark, make_docs, leaky):
    docs, items = leaky
    none, frame = spark.createDataFrame([], ITEMS), spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    assert mark_contaminated(make_docs([]), frame).count() == 0
    rows = mark_contaminated(make_docs(docs), none).collect()
    assert len(rows) == len(docs) and {(r.n_hit, r.items_sha256, r.contaminated) for r in rows} == {(0, hashed([]), False)}


@pytest.fixture(scope="module")
def copies(odd_pairs):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = list(odd_pairs)
    for family in range(8):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(150, 400))]
        for i in range(rng.randint(1, 25)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append((1000 + family * 100 + i, " ".join(text)))
    return docs


@pytest.mark.parametrize("shingle,most,chunk", [(3, 3, None), (1, 0, None), (3, 8, None)])
def test_fingerprint_groups(make_docs, copies, shingle, most, chunk):
    got = near_groups(make_docs(copies), shingle, most).collect()
    if shingle == 3:
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter(brute.simhash(copies, most))
    assert len(got) == len(copies)


def test_hot_blocks_are_dealt_out_whole(spark, copies):
    from ordermill.llm.components import components
    from ordermill.llm.simhash import near_links

    rng = random.Random(1)
    fps = sorted({rng.getrandbits(6) << 5 | rng.getrandbits(3) for _ in range(300)} | {rng.getrandbits(63) for _ in range(50)})
    points = spark.createDataFrame([(f,) for f in fps], "fp long")
    groups = brute.Groups()
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                groups.join(a, b)
    expected = {f: groups.root(f) for f in fps if groups.root(f) != f}
    for chunk in (4, 2048):
        got = components(near_links(points, 3, chunk), "a", "b").collect()
        assert {r.node: r.root for r in got} == expected


def test_pivots_lose_no_pair():
    import numpy as np

    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([seeds] + [seeds ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(4)])
    fps = np.unique(fps)
    keys = (fps % np.uint64(3)).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    fps, keys = fps[order], keys[order]
    a, b = linked(fps, keys, 3)
    got = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    expected = {
        frozenset((i, j))
        for i in range(len(fps))
        for j in range(i)
        if keys[i] == keys[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 3
    }
    assert got == expected and len(got) == len(a)


def test_one_of_each_group_stays(make_docs, copies):
    kept = keep_one(make_docs(copies))
    assert kept.columns == make_docs([]).columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    of = brute.simhash(copies)
    fps = {(d, t): f for (d, t), (_, f, _) in zip(copies, of)}
    component = {f: c for _, f, c in of}
    groups = {component[f] for f in component}
    assert set(rows) <= set(copies)
    assert sorted(component[fps[r]] for r in rows) == sorted(groups)  # one row for each
    assert all(d == component[fps[d, t]] for d, t in rows)


def test_fingerprints_of_empty_tables_and_idless_rows(make_docs):
    assert near_groups(make_docs([])).count() == 0 and keep_one(make_docs([])).count() == 0
    idless = [(None, "a b c d e"), (None, "a b c d e"), (None, "quite other words are here")]
    assert {r.component_id for r in near_groups(make_docs(idless)).collect()} == {None}
    assert sorted(r.text for r in keep_one(make_docs(idless)).collect()) == ["a b c d e", "quite other words are here"]


def test_lines(make_docs, odd_pairs):
    rng = random.Random(2)
    block = [f"line {i}" for i in range(9)]
    docs = list({d: (d, t) for d, t in odd_pairs if d is not None}.values())
    for i in range(40):
        a, n = rng.randint(0, 5), rng.randint(1, 6)
        parts = [f"own {i}"] * rng.randint(0, 2) + block[a : a + n] + rng.choice([[], ["", "  "]]) + [f"end {i}"] + block[:n]
        docs.append((300 + i, "\n".join(parts)))
    docs += [(400, "\n".join(["again"] * 9)), (401, "a\n\nb\n \nc\nd"), (402, " a\nb \nc"), (403, "a\nb")]
    got = dedup_lines(make_docs(docs))
    assert got.columns[:10] == make_docs([]).columns
    assert Counter((r.doc_id, r.text, r.lines_removed) for r in got.collect()) == Counter(brute.lines_kept(docs))


def test_lines_of_repeated_rows_and_empty_tables(make_docs):
    lines = "a\nb\nc\nd"
    got = dedup_lines(make_docs([(1, lines), (1, lines), (None, lines), (2, None)])).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter({(1, lines): 2, (None, ""): 1, (2, None): 1})
    assert dedup_lines(make_docs([])).count() == 0


PERSONAL = [
    (1, "mail a.b+c@x-y.example.com, a@b.c_d@e.f and x@@y@z.org; no@dot @at.com ..@a.b"),
    (2, "ip 1.2.3.4 and 256.1.1.1 and 1.2.3.4.5.6.7.8 and 001.02.3.0255 0000.0.0.0"),
    (3, "card 4111 1111 1111 1111, 4111-1111-1111-1112; 4111111111111111 4111111111111111, 5500000000000004."),
    (4, "call +1 (269) 555-3296 or +49 30 1234567 now, +1 2, +123456789012345678 +1 555"),
    (5, "+1 (269) 555-3296 4111111111111111 10.0.0.1 +1 (826) 555-4081 190.137.223.204 a@b.co"),
    (6, "é日本 \U0001f600 mail ü@x.de ab@x.de \U0001f600 +4930123456789é"),
    (7, None), (8, ""), (None, "n@o.id"), (9, "x@y.zz"), (9, "x@y.zz"), (10, "a" * 6_000), (11, "1" * 6_000), (12, "1 " * 6_000),
    (13, "a@b." * 3_000), (14, "1." * 6_000), (15, "+1" + " " * 6_000), (16, "john [at] mail [dot] example [dot] org"),
]


def test_personal_data(make_docs, odd_pairs):
    docs = PERSONAL + [(5000 + d, t) for d, t in odd_pairs if d is not None]
    got = find_pii(make_docs(docs)).collect()
    expected = []
    for d, t in docs:
        spans = brute.base_spans(t)
        n = Counter(k for k, _, _ in spans)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((d, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(listed.encode()).hexdigest()))
    assert Counter(tuple(r)[:6] for r in got) == Counter(expected)
    spans = {r.doc_id: [s for s in r.spans.split(",") if s] for r in got}
    for d, t in docs:
        assert {f"{k}:{a}:{b}" for k, a, b in brute.base_spans(t)} <= set(spans[d])
    run_together = PERSONAL[4][1]
    assert {run_together[int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans[5]} >= {
        "+1 (269) 555-3296", "4111111111111111", "+1 (826) 555-4081", "190.137.223.204"
    }
    assert find_pii(make_docs([])).count() == 0
    assert {r.spans for r in find_pii(make_docs([(1, "nothing here"), (2, None)])).collect()} == {""}


def test_estimate_finds_the_unreliable_labeler():
    rng = random.Random(6)
    seen = Counter()
    for _ in range(6000):
        true = rng.random() < 0.4
        said = [rng.random() < (r if true else 1 - r) for r in (0.95, 0.9, 0.85, 0.5)]
        seen["card", tuple(2 if s else 1 for s in said)] += 1
    chances, truth = estimate([(k, v, n) for (k, v), n in sorted(seen.items())])
    on_true = [chances[name][0] for name in ("format", "gazetteer", "context", "boundary")]
    assert abs(on_true[0] - 0.95) < 0.04 and abs(on_true[2] - 0.85) < 0.05 and abs(on_true[3] - 0.5) < 0.06
    assert all(0 <= t <= 1 for t in truth)
