"""Fund holdings files: a CSV table behind a preamble of unknown length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import col

_QUOTE = '"'


def is_header(line: Column | str) -> Column:
    """A line that names both a ticker-like and a name-like column."""
    u = F.upper(col(line))
    tick = F.lit(False)
    for k in fixed.HEADER_TICKER_WORDS:
        tick = tick | u.contains(k)
    name = F.lit(False)
    for k in fixed.HEADER_NAME_WORDS:
        name = name | u.contains(k)
    return tick & name


def separator(header: Column | str) -> Column:
    """Comma, else semicolon, else tab: the first that makes more than two columns."""
    h = col(header)
    return (
        F.when(F.size(F.split(h, ",")) > 2, F.lit(","))
        .when(F.size(F.split(h, ";")) > 2, F.lit(";"))
        .when(F.size(F.split(h, "\t")) > 2, F.lit("\t"))
    )


def cells_of(line: Column, sep: str) -> Column:
    """Cells of one CSV line; quotes protect separators and a doubled quote is a quote. Blank cells are NULL.

    Each match starts at a separator, so one is put in front of the line.
    """
    quoted = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{sep}("(?:[^"]|"")*"|[^{sep}]*)'), 1)
    bare = lambda c: F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit(_QUOTE))
    return F.transform(
        quoted,
        lambda c: F.nullif(F.when(c.startswith(_QUOTE) & c.endswith(_QUOTE) & (F.length(c) > 1), bare(c)).otherwise(c), F.lit("")),
    )


def records(lines: DataFrame, file: str, pos: str, line: str) -> DataFrame:
    """Physical lines put together to records: a line break inside quotes does not end one.

    A record starts where the quotes before it are even in number; a quote in the middle of a bare cell, as in
    `2" PIPE`, is text and not counted. The running count is one window over a file, which was one row before.
    """
    structural = F.regexp_replace(F.col(line), '(?<=[^",;\\t])"(?=[^",;\\t])', "")
    quotes = F.length(structural) - F.length(F.replace(structural, F.lit(_QUOTE), F.lit("")))
    before = Window.partitionBy(file).orderBy(pos)
    counted = lines.withColumn("_before", F.coalesce(F.sum(quotes).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = counted.withColumn("_record", F.sum((F.col("_before") % 2 == 0).cast("int")).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    others = [c for c in lines.columns if c not in (file, pos, line)]
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(pos, line))), lambda x: x[line]), "\n").alias(line)
    return numbered.groupBy(file, "_record").agg(F.min(pos).alias(pos), joined, *[F.first(c).alias(c) for c in others]).drop("_record")


def holdings_rows(lines: DataFrame, file: str = "file", pos: str = "pos", line: str = "line") -> DataFrame:
    """Data rows of many holdings files as (file, pos, lower-case header names, cells).

    `lines` holds one row per physical line. The header is the first matching line among the leading ones of
    each file; files without one give no rows. The header table has one row per file and joins back on file,
    so the lines of one huge file stay spread over tasks.
    """
    clean = lines.withColumn(line, F.regexp_replace(F.col(line), "^﻿|\r$", ""))
    heads = (
        clean.filter((F.col(pos) < fixed.HEADER_SCAN_LINES) & is_header(line))
        .groupBy(file)
        .agg(F.min_by(line, pos).alias("_head"), F.min(pos).alias("_head_pos"))
        .withColumn("_sep", separator("_head"))
        .filter(F.col("_sep").isNotNull())
    )
    body = records(clean.join(heads, file).filter(F.col(pos) > F.col("_head_pos")), file, pos, line)
    body = body.filter(F.trim(F.col(line)) != "")

    def by_sep(c: Column) -> Column:
        return (
            F.when(F.col("_sep") == ",", cells_of(c, ","))
            .when(F.col("_sep") == ";", cells_of(c, ";"))
            .otherwise(cells_of(c, "\t"))
        )

    names = F.transform(by_sep(F.col("_head")), lambda x: F.lower(F.trim(F.coalesce(x, F.lit("")))))
    wide = body.select(file, pos, names.alias("names"), by_sep(F.col(line)).alias("cells"))
    # A line with more cells than the header is malformed and skipped; a short one is padded by lookup.
    return wide.filter(F.size("cells") <= F.size("names"))


def read_holdings(spark: SparkSession, path: str) -> DataFrame:
    """A folder of holdings files. Fund files are small by nature; each is one row until it is split in lines.

    A file that is not valid UTF-8 is read as Latin-1.
    """
    text = F.col("content").cast("string")
    value = F.when(F.is_valid_utf8(text), text).otherwise(F.decode("content", "ISO-8859-1"))
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), value.alias("value"))
    return holdings_rows(raw.select("file", F.posexplode(F.split("value", "\n")).alias("pos", "line")))


def cell(candidates: list[str]) -> Column:
    """Value of the first candidate column that the file has, ignoring case."""
    wanted = list(dict.fromkeys(c.strip().lower() for c in candidates))
    at = F.coalesce(*[F.nullif(F.array_position("names", c), F.lit(0)) for c in wanted]).cast("int")
    return F.try_element_at(F.col("cells"), at)
