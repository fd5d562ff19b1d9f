import random
import statistics

from conftest import rows
from ordermill.operators import variety
from ordermill.plans import reports
from ordermill.sources import orders

GOLDEN = [
    ("04-01-22", "KA", "ST1", "A", "S"),
    ("04-02-22", "KA", "ST1", "A", "XXL"),
    ("04-03-22", "KA", "ST1", "B", "M"),
    ("04-03-22", "KA", "ST2", "C", "3XL"),
    ("04-03-22", "KA", "ST2", "F", "Free"),
    ("04-03-22", "KA", "ST3", "D", "XL"),
    ("04-03-22", "GOA", "ST3", "D", "XL"),
    ("bad", "KA", "ST2", "G", "3XL"),
    ("05-01-22", "KA", None, "H", "3XL"),
    ("05-01-22", "ka", "ST1", "A", "6XL"),
]
NAMES = ["Date", "ship-state", "Style", "SKU", "Size"]


def typed(raw_orders, data):
    return orders.variety_orders(raw_orders([dict(zip(NAMES, r)) for r in data]))


def test_median_variety(raw_orders):
    assert rows(reports.median_varieties(typed(raw_orders, GOLDEN))) == [("2022-04", "KA", 1.5), ("2022-05", "ka", 1.0)]


def test_style_variety_counts_every_sku_of_a_style_that_qualifies(raw_orders):
    styles = variety.style_variety(variety.sku_max_rank(typed(raw_orders, GOLDEN)))
    assert rows(styles, "state", "style", "variety", "max_rank") == [
        ("KA", "ST1", 2, 6),
        ("KA", "ST2", 1, 7),
        ("ka", "ST1", 1, 10),
    ]


def test_lower_rank_lets_more_styles_in(raw_orders):
    assert len(rows(reports.median_varieties(typed(raw_orders, GOLDEN), min_rank=5))) == 3


def test_delimiters_in_keys_do_not_drop_a_group(raw_orders):
    data = [("04-01-22", "KA", "A|B", "S|1", "XXL"), ("04-01-22", "KA", "A", "B|S|1", "XXL")]
    assert rows(reports.median_varieties(typed(raw_orders, data))) == [("2022-04", "KA", 1.0)]


def test_by_brute_force(raw_orders):
    rng, ranks = random.Random(11), {s: i for i, s in enumerate(["XS", "S", "M", "L", "XL", "XXL", "3XL"], 1)}
    data = [
        (f"0{rng.randint(4, 6)}-0{rng.randint(1, 9)}-22", rng.choice(["KA", "KA", "GOA"]), f"ST{rng.randint(1, 9)}",
         f"K{rng.randint(1, 12)}", rng.choice([*ranks, "Free"]))
        for _ in range(700)
    ]
    best = {}
    for date, state, style, sku, size in data:
        if size in ranks:
            skus = best.setdefault((f"2022-{date[:2]}", state), {}).setdefault(style, {})
            skus[sku] = max(skus.get(sku, 0), ranks[size])
    expected = []
    for (month, state), styles in best.items():
        counts = [len(s) for s in styles.values() if max(s.values()) >= 6]
        if counts:
            expected.append((month, state, float(statistics.median(counts))))
    assert rows(reports.median_varieties(typed(raw_orders, data))) == sorted(expected)
