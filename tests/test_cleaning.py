import pytest

from conftest import rows
from ordermill.operators import cleaning
from ordermill.plans import reports
from ordermill.schema import STATE_ALIASES, STATES

GOLDEN = [
    (" New Delhi", "x", "DELHI"),
    ("rajsthan", "x", "RAJASTHAN"),
    ("Orissa", "x", "ODISHA"),
    ("\tPB\xa0", "x", "PUNJAB"),
    ("AR", "ITANAGAR", "ARUNACHAL PRADESH"),
    ("ar", "Itanagar", "AR"),
    ("NL", "DIMAPUR", "NAGALAND"),
    ("NL", "x", "NL"),
    ("APO", "x", "APO"),
]
MISSING = [(None, "x"), ("NA", "x"), ("null", "x"), ("", "x")]


@pytest.fixture(scope="module")
def frame(spark):
    given = [(s, c) for s, c, _ in GOLDEN] + MISSING
    return spark.createDataFrame(given, "`ship-state` string, `ship-city` string")


def test_states_are_spelled_and_missing_ones_dropped(frame):
    assert rows(reports.clean_states(frame), "ship-state", "ship-city") == sorted((n, c) for _, c, n in GOLDEN)


def test_alias_tables_need_no_broadcast(spark, frame):
    expected = rows(reports.spell_states(frame), "ship-state", "ship-city")
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = reports.spell_states(frame)
        assert merged.columns == frame.columns
        assert rows(merged, "ship-state", "ship-city") == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


def test_unmapped(spark, frame):
    cleaned = reports.clean_states(frame)
    unmapped = cleaning.unmapped_states(cleaned, "ship-state", cleaning.known_states(spark))
    assert rows(unmapped) == [("APO", 1), ("AR", 1), ("NL", 1)]


def test_summary(frame):
    summary = cleaning.cleaning_summary(reports.spell_states(frame), "ship-state").first()
    assert tuple(summary) == (len(GOLDEN) + len(MISSING), len(GOLDEN), len(MISSING), 9)


def test_distinct_states_are_sorted(frame):
    names = [r[0] for r in cleaning.distinct_states(reports.clean_states(frame), "ship-state").collect()]
    assert names == sorted({n for _, _, n in GOLDEN})


def test_known_states(spark):
    known = cleaning.known_states(spark)
    assert known.count() == 45 and known.select("canon").distinct().count() == 36
    assert known.select("alias").distinct().count() == 45
    assert STATES == sorted(set(STATES)) and set(STATE_ALIASES.values()) <= set(STATES)


def test_blank_but_present_state_is_kept(spark):
    blank = spark.createDataFrame([("  ", "x")], "`ship-state` string, `ship-city` string")
    assert rows(reports.clean_states(blank)) == [("", "x")]


def test_counts_on_the_way(frame):
    """The counts come from the very write of the rows, and equal the summary of a scan of their own."""
    cleaned, counts = reports.clean_states_counted(frame)
    assert rows(cleaned, "ship-state", "ship-city") == rows(reports.clean_states(frame), "ship-state", "ship-city")
    assert counts.get == {"rows_in": len(GOLDEN) + len(MISSING), "rows_out": len(GOLDEN), "rows_removed": len(MISSING)}
