import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermill.schema import ORDER_COLUMNS
from ordermill.sources import orders, readers, writers

PROMO_FILE = 'index,Order ID,promotion-ids\n0,a,"P1,P2 ""q"", P3"\n1,b,\n2,c,"multi\nline"\n'


def line(**cells):
    """One CSV line of the order table."""
    named = {c.replace("-", "_").replace(" ", "_").lower(): c for c in ORDER_COLUMNS}
    cells = {named[k]: v for k, v in cells.items()}
    return ",".join(cells.get(c, "") for c in ORDER_COLUMNS)


def test_csv_quotes_and_line_ends(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(PROMO_FILE)
    frame = readers.read_csv(spark, str(tmp_path / "orders.csv"))
    assert frame.columns == ["index", "Order ID", "promotion-ids"]
    assert rows(frame, "index", "promotion-ids") == [("0", 'P1,P2 "q", P3'), ("1", None), ("2", "multi\nline")]


def test_csv_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("promotion-ids,Amount,SKU,Date,Unnamed: 22\n\"a,b\",5.5, k1 ,04-01-22,\n,x,K1,bad,\n")
    frame = orders.sku_orders(readers.read_csv(spark, str(tmp_path / "orders.csv")))
    assert rows(frame) == [("K1", dt.date(2022, 4, 1), 2, 5.5)]


def test_csv_blank_lines_are_dropped(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("index,Order ID\n1,a\n\n2,b\n")
    assert rows(readers.read_csv(spark, str(tmp_path / "orders.csv"), multi_line=False)) == [("1", "a"), ("2", "b")]


def test_lines_drop_headers_blanks_and_short_lines(spark, tmp_path):
    header = ",".join(ORDER_COLUMNS)
    text = "\n".join(
        [
            header,
            line(index="0", date="04-01-22", ship_state="KA", promotion_ids='"P1,P2 ""q"""'),
            "   ",
            header,
            "1,b,04-01-22,Shipped",
            header.replace("index", "row"),
            line(index="2", ship_state="GOA"),
            line(index="3", qty='"1,5"'),
            '4,"' + ",".join("abcdefghijklmnopqrstuvwxyz") + '"',
            "5" + "," * 16,
            "6" + "," * 17,
        ]
    )
    (tmp_path / "orders.csv").write_text(text)
    frame = readers.read_lines(spark, str(tmp_path / "orders.csv"))
    assert frame.columns == ORDER_COLUMNS
    assert rows(frame, "index", "ship-state", "promotion-ids") == [
        ("0", "KA", 'P1,P2 "q"'), ("2", "GOA", None), ("3", None, None), ("6", None, None)
    ]


def test_lines_and_csv_give_the_same_orders(spark, tmp_path):
    lines = [line(index=str(i), date=f"04-{i:02}-22", qty="1", status="Shipped", size="M", ship_state="KA") for i in range(1, 9)]
    (tmp_path / "orders.csv").write_text("\n".join([",".join(ORDER_COLUMNS), *lines]))
    path = str(tmp_path / "orders.csv")
    by_line, by_csv = readers.read_lines(spark, path), readers.read_csv(spark, path)
    assert rows(orders.window_orders(by_line)) == rows(orders.window_orders(by_csv))


def test_typed_columns_replace_those_that_differ_by_case(spark, raw_orders):
    raw = raw_orders([{"index": "7", "Date": "04-01-22", "Amount": "1.5", "SKU": "a", "ship-city": " blr ", "ship-state": "ka"}])
    typed = orders.promo_orders(raw)
    assert typed.first().asDict() == {
        "row_id": 7,
        "order_date": dt.date(2022, 4, 1),
        "status": None,
        "fulfilment": None,
        "courier_status": None,
        "service_level": None,
        "city": "BLR",
        "state": "KA",
        "amount": 1.5,
        "promotion_ids": None,
    }


def test_bad_values_give_null(spark, raw_orders):
    raw = raw_orders([{"index": "x", "Date": "99-99-99", "Amount": "n/a"}])
    typed = orders.promo_orders(raw).first()
    assert (typed.row_id, typed.order_date, typed.amount) == (None, None, None)


def test_parquet_folder_is_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_parquet(spark.range(5), path)
    writers.write_parquet(spark.range(3), path)
    assert readers.read_parquet(spark, path).count() == 3


def test_csv_folder_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([("a,b", 'q"x"'), ("c", None)], "x string, y string")
    writers.write_csv(frame, str(tmp_path / "out"))
    assert rows(readers.read_csv(spark, str(tmp_path / "out"))) == rows(frame)


def test_flat_csv_keeps_the_order(spark, tmp_path):
    target = tmp_path / "deep" / "out.csv"
    frame = spark.range(500).withColumn("k", (F.col("id") * 7919) % 500).repartition(7).orderBy("k").select("k")
    writers.write_flat_file(frame, str(target), "csv")
    assert target.read_text().split() == ["k", *map(str, range(500))]


def test_flat_parquet_is_replaced(spark, tmp_path):
    target = str(tmp_path / "out.parquet")
    for n in (5, 3):
        writers.write_flat_file(spark.range(n), target)
    assert (tmp_path / "out.parquet").is_file()
    assert readers.read_parquet(spark, target).count() == 3


def test_flat_file_of_an_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown format"):
        writers.write_flat_file(spark.range(1), str(tmp_path / "out.orc"), "orc")
    assert not (tmp_path / "out.orc").exists()


def test_csv_keeps_white_space(spark, tmp_path):
    frame = spark.createDataFrame([("  a b  ", "x\n"), ("\t", None), (None, " \n y"), ('"', ",\r\n,")], "x string, y string")
    writers.write_csv(frame, str(tmp_path / "out"))
    writers.write_flat_file(frame, str(tmp_path / "out.csv"), "csv")
    for path in ("out", "out.csv"):
        assert rows(readers.read_csv(spark, str(tmp_path / path))) == rows(frame)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_files_with_other_headers_fail(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("SKU,Amount\nk1,7\n")
    (tmp_path / "b.csv").write_text("Amount,SKU\n8,k2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path), multi_line).collect()
    (tmp_path / "b.csv").write_text("SKU,Amount\nk2,8\n")
    assert rows(readers.read_csv(spark, str(tmp_path), multi_line)) == [("k1", "7"), ("k2", "8")]


def test_flat_file_does_not_go_into_a_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="is a folder"):
        writers.write_flat_file(spark.range(1), str(tmp_path))
    assert list(tmp_path.iterdir()) == []


def fails_half_way(spark):
    # the second of two tasks fails once the first has written its file
    broken = F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("broken half-way")).cast("long"))
    return spark.range(0, 8, 1, 2).select(broken.alias("id"))


@pytest.mark.parametrize("kind", ["parquet", "csv", "flat"])
def test_a_failed_write_leaves_the_old_result(spark, tmp_path, kind):
    path = str(tmp_path / "out")
    write = {"parquet": writers.write_parquet, "csv": writers.write_csv, "flat": writers.write_flat_file}[kind]
    write(spark.range(5), path)
    with pytest.raises(Exception, match="broken half-way"):
        write(fails_half_way(spark), path)
    old = spark.read.csv(path, header=True) if kind == "csv" else spark.read.parquet(path)
    assert old.count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out"]


def test_a_frame_may_replace_the_folder_it_reads(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_parquet(spark.range(5), path)
    writers.write_parquet(spark.read.parquet(path).union(spark.range(5, 7)), path)
    assert spark.read.parquet(path).count() == 7


def test_a_replacement_that_stopped_between_its_renames_is_undone(spark, tmp_path):
    path, old = tmp_path / "out", tmp_path / f".out.old-{'0' * 32}"
    writers.write_parquet(spark.range(5), str(path))
    path.rename(old)
    writers.restore(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 5 and not old.exists()
    # one that stopped before the old folder was deleted is cleaned up
    writers.write_parquet(spark.range(9), str(old))
    writers.restore_inside(spark, str(tmp_path))
    assert spark.read.parquet(str(path)).count() == 5 and not old.exists()


def test_lines_left_out_are_landed_with_place_and_reason(spark, tmp_path):
    good = ",".join(["7", "o", "04-01-22", "Shipped", *[""] * 12, "panjim", "goa", "", "IN"])
    lines = {
        "a": [",".join(ORDER_COLUMNS), good, "", " \t", "1,2,3", good.replace("04-01-22", "04-32-22")],
        "b": [",".join(["row", *ORDER_COLUMNS[1:]]), good.replace("04-01-22", "02-31-22"), good.replace("04-01-22", "")],
    }
    for name, content in lines.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(content) + "\n")
    kept, left_out = readers.land_lines(spark, str(tmp_path / "*.csv"), str(tmp_path / "landed"))
    assert kept.columns == ORDER_COLUMNS and rows(kept, "Date", "ship-state") == [("02-31-22", "goa"), ("04-01-22", "goa")]
    found = [(r.file[-5:], r.reason, r.line) for r in left_out.collect()]
    assert sorted(found) == sorted(
        [("a.csv", "header", lines["a"][0]), ("a.csv", "blank", ""), ("a.csv", "blank", " \t"), ("a.csv", "short", "1,2,3"),
         ("a.csv", "date", lines["a"][5]), ("b.csv", "header", lines["b"][0]), ("b.csv", "date", lines["b"][2])]
    )
    assert {(r.block_start, r.block_length > 0) for r in left_out.collect()} == {(0, True)}
    assert kept.count() + left_out.count() == sum(map(len, lines.values()))
    # but for the unreadable dates, the lines are those of the plain reader
    plain = readers.read_lines(spark, str(tmp_path / "*.csv"))
    assert plain.count() == kept.count() + sum(reason == "date" for _, reason, _ in found)
    (tmp_path / "none.csv").write_text("")
    assert [f.count() for f in readers.land_lines(spark, str(tmp_path / "none.csv"), str(tmp_path / "landed"))] == [0, 0]


def enclosed(value, rng):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in ',"\n\r') or rng.random() < 0.2 else value


@pytest.fixture
def small_blocks(spark):
    sizes = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    default = {name: spark.conf.get(name) for name in sizes}
    for name, value in sizes.items():
        spark.conf.set(name, value)
    yield
    for name, value in default.items():
        spark.conf.set(name, value)


def test_records_with_line_ends_are_read_block_by_block(spark, tmp_path, small_blocks):
    """Files of some twenty blocks each, with line ends and quotes in many fields, some records over several blocks."""
    rng = random.Random(1)
    parts = ["a", "b", ",", '"', "\n", "\r\n", " ", "é", "\n\n"]
    for n, end in enumerate(["\n", "\r\n", "\n"]):
        rows_ = [[str(n * 1000 + i), *("".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 20]))) for _ in range(3))] for i in range(120)]
        rows_[60][2] = "line\n" * 300
        body = end.join(["id,a,b c,d`", *(",".join(enclosed(v, rng) for v in r) for r in rows_)]) + (end * n)
        (tmp_path / f"{n}.csv").write_bytes(body.encode())
    expected = readers.read_csv(spark, str(tmp_path))
    got = readers.read_records(spark, str(tmp_path))
    assert got.columns == expected.columns == ["id", "a", "b c", "d`"]
    plain = lambda df: sorted(map(tuple, df.collect()))
    assert plain(got.fillna("")) == plain(expected.fillna("")) and got.count() == 360
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 40


def test_records_of_odd_files(spark, tmp_path):
    for name, body in {"head": "x,y\n", "blank": "x,y\n\n1,2\n\n\n", "bom": "\ufeffx,y\r\n3,\"a\r\nb\"\r\n"}.items():
        (tmp_path / f"{name}.csv").write_text(body, newline="")
    assert rows(readers.read_records(spark, str(tmp_path))) == [("1", "2"), ("3", "a\nb")]
    (tmp_path / "other.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="different headers"):
        readers.read_records(spark, str(tmp_path)).collect()


def test_a_folder_is_moved_whole(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    writers.move_folder(spark, str(tmp_path / "a"), str(tmp_path / "deep" / "b"))
    assert spark.read.parquet(str(tmp_path / "deep" / "b")).count() == 3 and not (tmp_path / "a").exists()
    writers.move_folder(spark, str(tmp_path / "a"), str(tmp_path / "c"))  # nothing to move
    spark.range(3).write.parquet(str(tmp_path / "a"))
    with pytest.raises(OSError, match="cannot move"):
        writers.move_folder(spark, str(tmp_path / "a"), str(tmp_path / "deep" / "b"))
