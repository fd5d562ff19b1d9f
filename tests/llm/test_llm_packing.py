import random
import re
from itertools import combinations

import pytest

from llm_fixtures import make_docs, odd_pairs  # noqa: F401
from ordermill.llm.packing import best_boundaries, pack_documents


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram)


@pytest.mark.parametrize("seed", range(10))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = [(length, rng.randint(1, 9)) for length in rng.sample(range(1, 60), rng.randint(1, 9))]
    buckets = rng.randint(1, 5)
    bounds = best_boundaries(histogram, buckets)
    lengths = sorted(length for length, _ in histogram)
    least = min(
        padding(histogram, [*inner, lengths[-1]])
        for k in range(min(buckets, len(lengths)))
        for inner in combinations(lengths[:-1], k)
    )
    assert len(bounds) <= buckets and bounds[-1] == lengths[-1] and padding(histogram, bounds) == least


def check(pairs, rows, max_tokens, batch_tokens):
    tokens = sorted((str(d), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t in pairs)
    pieces, batches = {}, {}
    for r in rows:
        assert r.token_start == r.piece * max_tokens and r.n_tokens <= max_tokens
        pieces.setdefault(str(r.doc_id), []).append(r.n_tokens)
        if r.n_tokens == 0:
            assert (r.bucket, r.bucket_tokens, r.batch, r.batch_row) == (None,) * 4
        else:
            assert r.n_tokens <= r.bucket_tokens
            batches.setdefault((r.bucket, r.bucket_tokens, r.batch), []).append(r.batch_row)
    total = {}
    for d, n in tokens:
        total[d] = total.get(d, 0) + n
    assert {d: sum(p) for d, p in pieces.items()} == total
    last = {}
    for (bucket, size, batch), taken in batches.items():
        full = batch_tokens // size
        assert sorted(taken) == list(range(len(taken))) and len(taken) <= full
        last.setdefault((bucket, full), {})[batch] = len(taken)
    for (_, full), of in last.items():
        assert sorted(of) == list(range(len(of))) and all(n == full for b, n in of.items() if b < len(of) - 1)
    assert len({b for b, _ in last}) == len(last)


@pytest.mark.parametrize("max_tokens,batch_tokens,buckets", [(16, 64, 3), (2048, 16384, 8), (1, 1, 1)])
def test_odd_rows(make_docs, odd_pairs, max_tokens, batch_tokens, buckets):
    pairs = odd_pairs if max_tokens > 1 else odd_pairs[9:20]
    rows = pack_documents(make_docs(pairs), max_tokens, buckets, batch_tokens).collect()
    check(pairs, rows, max_tokens, batch_tokens)


def test_empty_and_blank_tables(make_docs):
    assert pack_documents(make_docs([])).count() == 0
    rows = pack_documents(make_docs([(1, None), (2, " ")])).collect()
    assert [(r.n_tokens, r.bucket) for r in rows] == [(0, None)] * 2


def test_wrong_budget(make_docs):
    with pytest.raises(ValueError):
        pack_documents(make_docs([]), max_tokens=10, batch_tokens=5)
