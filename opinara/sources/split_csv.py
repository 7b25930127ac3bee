"""Big CSV files with line breaks inside quotes, read by many tasks.

A quoted value may hold line breaks, so a line alone does not tell where a record starts;
the number of quotes before it does: an odd one means inside a value. Quotes are counted
per line, summed up within each split of a file and over the splits, of which there are
few. Lines of a record are then put together and parsed. Doubled quotes count twice and
change nothing, which is how a quote is escaped here.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line, record``: the text of each record, header and all, by the place of its first line.

    One shuffle of the lines, by split: a task holds a split at most, and of a record that
    spans several lines only that record. Blank lines outside values are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
        F.length(F.regexp_replace("value", '[^"]', "")).alias("quotes"),
    )
    split = Window.partitionBy("file", "block").orderBy("line")
    before = F.sum("quotes").over(split) - F.col("quotes")
    counted = lines.withColumn("before", before)
    # A row per split: its quotes are those before and on its last line.
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("own"))
    ahead = Window.partitionBy("file").orderBy("block")
    blocks = blocks.select("file", "block", (F.sum("own").over(ahead) - F.col("own")).alias("ahead"))
    placed = counted.join(blocks, ["file", "block"]).withColumn("open", (F.col("ahead") + F.col("before")) % 2 == 1)
    whole = ~F.col("open") & (F.col("quotes") % 2 == 0)
    single = placed.where(whole).select("file", "block", "line", F.col("value").alias("record"))
    # What is left are the lines of records of several lines; each starts where nothing is open.
    parts = placed.where(~whole)
    start = F.when(~F.col("open"), F.struct("block", "line"))
    own = F.last(start, ignorenulls=True).over(split)
    begun = parts.withColumn("own", own)
    # A record may go on from the splits before: the last start in any of them.
    last = begun.groupBy("file", "block").agg(F.max(start).alias("last"))
    earlier = F.max("last").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    last = last.select("file", "block", earlier.alias("earlier"))
    owned = begun.join(last, ["file", "block"]).withColumn("start", F.coalesce("own", "earlier"))
    joined = owned.groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("all"))
    several = joined.select(
        "file", "start.block", "start.line", F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("record")
    )
    ended = F.regexp_replace("record", r"\r\z", "")
    return single.unionByName(several).withColumn("record", F.regexp_replace(ended, r"\r\n", "\n")).where("record <> ''")


def read_split_csv(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """As ``spark.read.options(**options).csv(path)`` with a header and ``multiLine``, but splits are read apart.

    The header of the first file names the columns, as there; the first record of every
    file is a header.
    """
    names = spark.read.options(**options).csv(path).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    found = records(spark, path)
    first = found.groupBy("file").agg(F.min(F.struct("block", "line")).alias("first"))
    rows = found.join(first, "file").where(F.struct("block", "line") > F.col("first"))
    parsed = F.from_csv("record", schema, {k: v for k, v in options.items() if k not in ("header", "multiLine", "encoding")})
    return rows.select(parsed.alias("r")).select("r.*")
