"""Landing: raw sheet grid to typed rows, declared totals, reference date,
fingerprints, lineage and the column contract (S1-S8, P0, W1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import base_name, strip
from lotguard.operators.sequence import number_within
from lotguard.session import written


def first_sheet(grid: DataFrame) -> DataFrame:
    """The rows of each workbook's first sheet. A workbook grid has
    ``sheet_no`` (0 is the first) and ``sheet_name``; a grid without
    ``sheet_no`` holds one sheet per batch."""
    return grid.where(F.col("sheet_no") == 0) if "sheet_no" in grid.columns else grid


def reference_sheet(grid: DataFrame) -> DataFrame:
    """The rows of each workbook's reference sheet, found by its name."""
    return grid.where(F.col("sheet_name") == K.REFERENCE_SHEET) if "sheet_no" in grid.columns else grid


def declared_totals(grid: DataFrame, presentation_rows: int = 2) -> DataFrame:
    """Per sheet, the declared number of data rows in the presentation
    rows, or null (also for a number beyond 64 bits, which no sheet reaches).
    An aggregate over at most ``presentation_rows`` rows per sheet."""
    return _declared(first_sheet(grid), presentation_rows)


def _declared(grid: DataFrame, presentation_rows: int) -> DataFrame:
    pres = grid.where(F.col("row_no") <= presentation_rows)
    text = F.concat_ws(" ", "cells")  # nulls skipped; the pattern allows any spacing
    per_sheet = pres.groupBy("batch_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("row_no", text.alias("t")))).getField("t"), " ").alias("_text")
    )
    found = F.regexp_extract("_text", K.TOTAL_PATTERN, 1)
    return per_sheet.select("batch_id", found.try_cast("bigint").alias("declared"))


def _within_declared(header_row: int):
    """Row below the header and within the declared total, if there is one."""
    return F.col("declared").isNull() | (F.col("row_no") - header_row <= F.col("declared"))


def reference_list(grid: DataFrame, header_row: int = K.REFERENCE_HEADER_ROW) -> DataFrame:
    """S4 from a reference-sheet grid: title row(s), header, data capped by
    the declared total; the ``lote_id`` column stripped, nulls and blanks
    dropped, distinct per batch. Output: batch_id, lote_id."""
    grid = reference_sheet(grid)
    hdr = grid.where(F.col("row_no") == header_row).select("batch_id", F.col("cells").alias("_hdr"))
    meta = hdr.join(_declared(grid, header_row - 1), "batch_id", "left")
    data = grid.where(F.col("row_no") > header_row).join(meta, "batch_id").where(_within_declared(header_row))
    ids = data.select("batch_id", strip(_cell("lote_id")).alias("lote_id"))
    return ids.where(F.col("lote_id").isNotNull() & (F.col("lote_id") != "")).distinct()


def reference_layout_check(grid: DataFrame, header_row: int = K.REFERENCE_HEADER_ROW) -> DataFrame:
    """S4 layout: a reference sheet without a lote_id column fails its batch
    with the original message. Output: batch_id, ok, message."""
    hdr = reference_sheet(grid).where(F.col("row_no") == header_row)
    ok = F.coalesce(F.array_contains("cells", "lote_id"), F.lit(False))
    return hdr.select("batch_id", ok.alias("ok"),
                      F.when(ok, F.lit("")).otherwise(F.lit(K.REFERENCE_MISSING_COLUMN)).alias("message"))


def _cell(name: str):
    pos = F.array_position("_hdr", name).cast("int")
    return F.when(pos > 0, F.try_element_at("cells", pos))


def sheet_to_table(grid: DataFrame, header_row: int = K.HEADER_ROW) -> DataFrame:
    """S1+S2+S3: promote the header row, cap at the declared total (counted
    before blank-row removal), drop all-null rows and re-index 0..n-1 per
    sheet. Output: batch_id, row_idx, sheet_row and the 8 contract columns."""
    grid = first_sheet(grid)
    # One row per sheet (header + declared cap) from one pass over its first
    # rows, joined to the data rows once.
    text = F.concat_ws(" ", "cells")
    top = grid.where(F.col("row_no") <= header_row).groupBy("batch_id").agg(
        F.max(F.when(F.col("row_no") == header_row, F.struct("cells"))).getField("cells").alias("_hdr"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("row_no") < header_row, F.struct("row_no", text.alias("t"))))).getField("t"), " ").alias("_text"),
    )
    meta = top.where(F.col("_hdr").isNotNull()).select(
        "batch_id", "_hdr", F.regexp_extract("_text", K.TOTAL_PATTERN, 1).try_cast("bigint").alias("declared"))
    data = grid.where(F.col("row_no") > header_row).join(meta, "batch_id").where(_within_declared(header_row))
    mapped = data.select(
        "batch_id", F.col("row_no").alias("sheet_row"),
        *[_cell(c).alias(c) for c in K.CONTRACT_COLUMNS],
    )
    # Written: numbering reads the rows twice, the join behind them is made once.
    kept = written(mapped.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in K.CONTRACT_COLUMNS])), "sheet-rows")
    return number_within(kept, ["batch_id"], "sheet_row", out="row_idx") \
        .select("batch_id", "row_idx", "sheet_row", *K.CONTRACT_COLUMNS)


def reference_date_of(sheet_name) -> F.Column:
    """S5: 'dd/mm/yyyy' from the first dd_mm_yyyy in the sheet name, else ''."""
    m = F.regexp_extract(sheet_name, K.DATE_PATTERN, 0)
    return F.when(m != "", F.concat_ws("/", *[F.regexp_extract(sheet_name, K.DATE_PATTERN, i) for i in (1, 2, 3)])) \
            .otherwise(F.lit(""))


def sheet_reference_dates(grid: DataFrame) -> DataFrame:
    return first_sheet(grid).select("batch_id", "sheet_name").distinct() \
        .select("batch_id", reference_date_of(F.col("sheet_name")).alias("reference_date"))


def fingerprint(content_col: str = "content"):
    """sha256, md5 and batch id of a content column (string or binary)."""
    sha = F.sha2(F.col(content_col), 256)
    return [sha.alias("sha256"), F.md5(F.col(content_col)).alias("md5"),
            F.concat(F.lit("batch-"), F.substring(sha, 1, 16)).alias("batch_id")]


def fingerprint_files(spark, path: str, glob: str = "*") -> DataFrame:
    """S6 over raw files: one row per file with base name, size, sha256, md5
    and batch id. Every file is digested whole; one that a task cannot hold
    (the reader's limit is 2 GB) fails the read with the file's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    content = F.col("content")
    sha = F.sha2(content, 256)
    return files.select(
        base_name("path").alias("source_file"),
        F.col("length"),
        sha.alias("sha256"),
        F.md5(content).alias("md5"),
        F.concat(F.lit("batch-"), F.substring(sha, 1, 16)).alias("batch_id"),
    )


def lineage(rows: DataFrame, source_hash: str = "source_hash") -> DataFrame:
    """source_row = row_idx + 4; item_id = hash:source_row."""
    source_row = (F.col("row_idx") + 4).cast("int")
    return rows.withColumn("source_row", source_row) \
        .withColumn("item_id", F.concat(F.col(source_hash), F.lit(":"), source_row.cast("string")))


def structure_check(headers: DataFrame) -> DataFrame:
    """P0 for many sheets: missing, extra and repeated columns, sorted; message
    as the original (empty when the contract holds)."""
    contract = F.array(*[F.lit(c) for c in K.CONTRACT_COLUMNS])
    missing = F.array_sort(F.array_except(contract, F.col("header")))
    # A name that comes again counts as an extra column: name.1, name.2, ...
    named = F.transform(F.col("header"), lambda x, i: F.struct(x.alias("x"), F.size(F.filter(F.slice(F.col("header"), 1, i), lambda y: y == x)).alias("n")))
    again = F.transform(F.filter(named, lambda e: e["n"] > 0), lambda e: F.concat(e["x"], F.lit("."), e["n"].cast("string")))
    extra = F.array_sort(F.concat(F.array_except(F.col("header"), contract), again))
    detail = F.concat_ws(
        "; ",
        F.when(F.size(missing) > 0, F.concat(F.lit(K.MISSING_LABEL), F.array_join(missing, ", "))),
        F.when(F.size(extra) > 0, F.concat(F.lit(K.EXTRA_LABEL), F.array_join(extra, ", "))),
    )
    ok = (F.size(missing) == 0) & (F.size(extra) == 0)
    return headers.select(
        "batch_id", ok.alias("ok"),
        F.when(ok, F.lit("")).otherwise(F.concat(F.lit(K.STRUCTURE_PREFIX), detail)).alias("message"),
    )
