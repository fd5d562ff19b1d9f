"""Reading the order table: CSV by header, bare CSV lines, Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions.text import trim_control
from ordermill.functions.values import parse_date_clamped
from ordermill.schema import ORDER_COLUMNS
from ordermill.session import stage
from ordermill.sources.writers import replace_folder


QUOTES = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header line, every column a string, columns taken by header name.

    Quoted fields may hold commas, doubled quotes and, with ``multi_line``, line ends.  Spark
    cannot split a multi-line file, so one task reads one file: keep such input in many files,
    or use `read_records`, or pass ``multi_line=False`` when no field holds a line end.  Of several files all have to bear the same header: one that differs fails the read.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"')
    # with a given schema, unless it is enforced, Spark compares the header of every file with it
    return reader.options(enforceSchema=False).schema(reader.csv(path).schema).csv(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """`read_csv` with line ends inside fields, by as many tasks as the files have blocks.

    A line end lies inside a field if an odd number of quotes comes before it in its file.  Every block
    of a file counts the quotes of its lines by themselves; the parities of the blocks, a row each, are
    added up over the file, and tell for each block how to read its counts.  Lines that are records are
    parsed as they are; only the parts of records with line ends are brought together.  A quote that
    is never closed makes one record of the rest of its file, here as in `read_csv`.
    """
    names = spark.read.options(header=True, multiLine=True, **QUOTES).csv(path).schema.names
    text = spark.read.option("lineSep", "\n").text(path)
    place = [F.col(f"_metadata.{column}").alias(name) for name, column in (("file", "file_path"), ("block", "file_block_start"))]
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))
    lines = text.select("value", *place, F.monotonically_increasing_id().alias("at"), odd.alias("odd"))

    block = Window.partitionBy("file", "block").orderBy("at")
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.coalesce(F.sum("odd").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("inside", F.pmod(inside, F.lit(2)))
    # where the record of a line starts, if its block begins outside (0) and inside (1) of a field
    starts = {f"start{p}": F.max(F.when(F.col("inside") == p, F.col("at"))).over(upto) for p in (0, 1)}
    lines = stage(lines.withColumns(starts), "lines")

    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.max("start0").alias("last0"), F.max("start1").alias("last1"))
    blocks = blocks.withColumn("open", F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)))
    last = F.when(F.col("open") == 0, F.col("last0")).otherwise(F.col("last1"))
    blocks = blocks.withColumn("last", last).withColumn("earlier", F.max("last").over(before))
    first = Window.partitionBy("file").orderBy("block")
    blocks = stage(blocks.select("file", "block", "open", "earlier", (F.row_number().over(first) == 1).alias("leads")), "blocks")

    start = F.coalesce(F.when(F.col("open") == 0, F.col("start0")).otherwise(F.col("start1")), F.col("earlier"))
    placed = lines.join(blocks, ["file", "block"]).withColumn("start", start)
    alone = (F.pmod(F.col("inside") + F.col("open"), F.lit(2)) == 0) & (F.col("odd") == 0)
    whole = placed.where(alone).select("file", "at", "value")
    parts = placed.where(~alone).groupBy("file", F.col("start").alias("at")).agg(F.collect_list(F.struct("at", "value")).alias("parts"))
    joined = F.concat_ws("\n", F.transform(F.sort_array("parts"), lambda part: part["value"]))
    records = whole.unionByName(parts.select("file", "at", joined.alias("value")))

    # like `read_csv`: in a file whose lines end in CR LF, so do the line ends inside its fields
    by_line = F.when(F.col("crlf"), F.replace("value", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))
    text_of = F.regexp_replace(by_line, "^\ufeff|\r$", "")
    ends = F.min_by(F.col("value").endswith("\r"), "at").alias("crlf")
    heads = stage(placed.where("leads").groupBy("file").agg(F.min("at").alias("head"), ends), "heads")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    row = F.from_csv(text_of, schema, {**QUOTES, "multiLine": "true"})
    parsed = records.where(~F.col("value").isin("", "\r")).join(heads, "file").select("at", "head", F.inline(F.array(F.struct(row.alias("row")))))
    header = F.struct(*[F.lit(name).alias(name) for name in names])
    wrong = F.raise_error(F.lit("CSV files with different headers"))
    is_head = F.col("at") == F.col("head")
    kept = F.when(~is_head, True).when(F.to_json("row") != F.to_json(header), wrong.cast("boolean")).otherwise(False)
    return parsed.where(kept).select("row.*")


def split_line(line: Column) -> Column:
    """A struct of the order columns parsed from one CSV line; a short line leaves nulls."""
    columns = ", ".join(f"`{name}` string" for name in ORDER_COLUMNS)
    return F.from_csv(line, columns, {"quote": '"', "escape": '"'})


def field_count(line: Column) -> Column:
    """Number of fields in a CSV line; an open quote runs to its end."""
    unquoted = F.regexp_replace(line, r'"[^"]*("|$)', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


def _header_line(line: Column) -> Column:
    return line.startswith("index,Order ID")


def _header_row(date: Column) -> Column:
    return trim_control(date).eqNullSafe("Date")


def _reaches_state(line: Column) -> Column:
    return field_count(line) > ORDER_COLUMNS.index("ship-state")


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Order columns from a text column of CSV lines.

    Header lines (wherever they stand), blank lines and lines that end before the state are left
    out.  A line whose state is empty stays; whether it counts is up to the analysis.
    """
    line = F.col(column)
    return (
        lines.filter((trim_control(line) != "") & ~_header_line(line) & _reaches_state(line))
        # as a generator the parser runs once per line; a filter on its columns would repeat it
        .select(F.inline(F.array(split_line(line))))
        .filter(~_header_row(F.col("Date")))
    )


def judged_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """`lines` with the struct ``order`` of the parsed columns and, where it is left out, the ``reason``.

    Reasons: "blank", "header", "short" (the line ends before the state), and "date": no day that the
    analyses can read.  The rows without a reason are those of `parse_lines` but for the last.
    """
    line = F.col(column)
    parsed = lines.select("*", F.inline(F.array(F.struct(split_line(line).alias("order")))))
    date = F.col("order").getField("Date")
    reason = (
        F.when(line.isNull() | (trim_control(line) == ""), "blank")
        .when(_header_line(line) | (_reaches_state(line) & _header_row(date)), "header")
        .when(~_reaches_state(line), "short")
        .when(parse_date_clamped(trim_control(date)).isNull(), "date")
    )
    return parsed.withColumn("reason", reason)


def land_lines(spark: SparkSession, path: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Land CSV lines as Parquet in one pass: the order table, and the lines left out of it.

    A line left out comes with its reason, its file and the offset and length of the block of the file
    that a task read it from.  Kept and left out lines together are the lines of the files.  The
    landed table takes the place of what was in ``folder`` once it is whole.
    """
    place = {"file": "file_path", "block_start": "file_block_start", "block_length": "file_block_length"}
    source = spark.read.text(path).select("value", *[F.col(f"_metadata.{c}").alias(name) for name, c in place.items()])
    judged = judged_lines(source).withColumn("kept", F.col("reason").isNull())
    # what a row does not need is null, and costs next to nothing in its column file
    left_out = [F.when(~F.col("kept"), F.col(c)).alias(f"_{c}") for c in ("reason", *place, "value")]
    orders = [F.when(F.col("kept"), F.col("order").getField(c)).alias(c) for c in ORDER_COLUMNS]
    landed = judged.select("kept", *left_out, *orders)
    replace_folder(spark, folder, lambda fresh: landed.write.partitionBy("kept").parquet(fresh))
    table = spark.read.schema(landed.schema).parquet(folder)
    rejected = [F.col(f"_{c}").alias("line" if c == "value" else c) for c in ("reason", *place, "value")]
    return table.where("kept").select(*[f"`{c}`" for c in ORDER_COLUMNS]), table.where("not kept").select(*rejected)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-wise CSV scan: every file is splittable, a quoted line end breaks its record."""
    return parse_lines(spark.read.text(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
