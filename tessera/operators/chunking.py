"""Chunks with line provenance. Sections are cut inside the row: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import lines

#: A line of at most so many characters opens a section.
HEADING_CHARS = 60
#: Characters of a packed chunk, about.
CHUNK_CHARS = 800


def line_provenance(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line from 1, text) of every line."""
    found = docs.select(id_col, F.posexplode(lines(F.col(text_col))).alias("pos", "text"))
    return found.select(id_col, (F.col("pos") + 1).alias("line"), "text")


def section_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heading_chars: int = HEADING_CHARS) -> DataFrame:
    """(id, section from 1, line_start, line_end, text): a section begins at the
    first line and at every short line."""
    d = docs.select(id_col, lines(F.col(text_col)).alias("all"))
    number = F.sequence(F.lit(1), F.size("all"))
    d = d.withColumn("heads", F.filter(number, lambda i: (i == 1) | (F.length(F.element_at("all", i)) <= heading_chars)))
    d = d.withColumn("ends", F.concat(F.transform(F.slice("heads", 2, F.size("heads")), lambda i: i - 1), F.array(F.size("all"))))
    d = d.select(id_col, "all", F.posexplode(F.arrays_zip("heads", "ends")).alias("pos", "span"))
    text = F.array_join(F.slice("all", F.col("span.heads"), F.col("span.ends") - F.col("span.heads") + 1), "\n")
    return d.select(id_col, (F.col("pos") + 1).alias("section"), F.col("span.heads").alias("line_start"), F.col("span.ends").alias("line_end"), text.alias("text"))


def packed_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = CHUNK_CHARS) -> DataFrame:
    """Neighbouring whole lines put together up to about ``limit`` characters:
    a line belongs to the chunk in which it begins. Rows with equal or null ids
    stay apart, by their text, and rows that repeat both by a number."""
    found = docs.select(id_col, F.xxhash64(text_col).alias("_of"), F.posexplode(lines(F.col(text_col))).alias("line", "text"))
    # Everything below groups by these two and more: one shuffle.
    found = found.repartition(id_col, "_of").withColumn("_copy", F.row_number().over(Window.partitionBy(id_col, "_of", "line").orderBy("text")))
    upto = Window.partitionBy(id_col, "_of", "_copy").orderBy("line")
    found = found.withColumn("chunk", F.floor((F.sum(F.length("text") + 1).over(upto) - F.length("text") - 1) / limit))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n")
    made = found.groupBy(id_col, "_of", "_copy", "chunk").agg((F.min("line") + 1).alias("line_start"), (F.max("line") + 1).alias("line_end"), joined.alias("text"))
    return made.drop("_of", "_copy")


def code_chunks(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """(path, name, line_start, line_end, text): chunks of source files along
    the spans of their symbols, never fixed windows; what lies between them, or
    a whole file without symbols, is a chunk without a name unless it is blank.
    symbols: path, name, line_start, line_end."""
    spans = symbols.groupBy("path").agg(F.sort_array(F.collect_set(F.struct("line_start", "line_end", "name"))).alias("spans"))
    d = files.select("path", lines(F.col("content")).alias("all")).join(spans, "path", "left")
    d = d.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<line_start:int,line_end:int,name:string>>")))
    # Where the lines that no symbol covers begin, and the line before the next one begins.
    starts = F.concat(F.array(F.lit(1)), F.transform("spans", lambda s: s["line_end"] + 1))
    gaps = F.transform(starts, lambda a: F.struct(a.alias("line_start"), F.coalesce(F.array_min(F.transform(F.filter("spans", lambda s: s["line_end"] >= a), lambda s: s["line_start"])) - 1, F.size("all")).alias("line_end"), F.lit(None).cast("string").alias("name")))
    gaps = F.filter(F.array_distinct(gaps), lambda g: g["line_end"] >= g["line_start"])
    d = d.select("path", "all", F.inline(F.concat("spans", gaps)))
    text = F.array_join(F.slice("all", F.col("line_start"), F.col("line_end") - F.col("line_start") + 1), "\n")
    return d.select("path", "name", "line_start", "line_end", text.alias("text")).where(F.col("name").isNotNull() | (F.trim("text") != ""))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(content_id, id of the first, copies): equal texts have equal ids."""
    return docs.groupBy(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("content_id")).agg(F.min(id_col).alias(id_col), F.count("*").alias("copies"))
