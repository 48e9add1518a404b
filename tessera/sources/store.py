"""Readers and writers of corpora and derived tables."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared work folder and read it again: plans of loops
    stay short, and lost executors cost no more than one round."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The same rows in as many partitions as there are cores, if the table has
    fewer files: work on texts costs far more than moving them once. A large
    table has more files and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def state_of(spark: SparkSession, path: str) -> tuple:
    """What tells whether a table's files have changed; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return tuple(sorted(map(tuple, files.select(F.xxhash64("path", "modificationTime", "length").alias("x")).groupBy().agg(F.count("*"), F.bit_xor("x"), F.sum(F.shiftright("x", 20))).collect())))


def exists(spark: SparkSession, path: str, names: str = "*") -> bool:
    """Whether there are files (of such names) at or below a path."""
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(path).select("path").take(1))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def work_folder(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share: what
    ``spark.checkpoint.dir`` names. Where that is unset, a local session takes
    one in the warehouse; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def read_corpus(spark: SparkSession, root: str, snapshot: str, kinds: dict[str, str]) -> DataFrame:
    """Files of a pinned corpus. kinds: glob of file names -> kind of file.

    Undecodable bytes become replacement characters; every row carries the
    snapshot it was read from, and its path without the store's scheme, whose
    colon a citation could not hold.
    """
    parts = []
    for glob, kind in kinds.items():
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        parts.append(found.select(F.lit(snapshot).alias("snapshot"), F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "").alias("path"), F.lit(kind).alias("kind"), F.make_valid_utf8(F.col("content").cast("string")).alias("content")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).option("mode", "FAILFAST").json(path)


def snapshot_of(spark: SparkSession, manifest: str, name: str) -> str:
    """What a manifest pins a corpus to."""
    found = [r[0] for r in read_manifest(spark, manifest).where(F.col("name") == name).select("sha").distinct().take(2)]
    if len(found) != 1:
        raise ValueError(f"the manifest pins {name} {len(found)} times")
    return found[0]


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").json(path)


def read_chunks(spark: SparkSession, path: str, schema: str = schemas.CHUNKS) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_gold(spark: SparkSession, tunable: str, heldout: str) -> DataFrame:
    """Gold questions of both files with the ``split`` they belong to."""
    read = lambda path, split: spark.read.schema(schemas.GOLD).option("mode", "FAILFAST").json(path).withColumn("split", F.lit(split))
    return read(tunable, "tunable").unionByName(read(heldout, "heldout"))


def write_by_domain(df: DataFrame, path: str, domain: str = "domain", records: int = 1_000_000) -> None:
    """One folder per domain, files of at most ``records`` rows. Rows are dealt
    by domain and a salt, so a hot domain is written by several tasks."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    df.repartition(domain, salt).write.mode("overwrite").option("maxRecordsPerFile", records).partitionBy(domain).parquet(path)


def repack(spark: SparkSession, source: str, target: str, max_bytes: int = 25_000_000) -> None:
    """Rewrite a table so that no file exceeds about ``max_bytes``: rows per
    file follow from the mean stored size of a row."""
    df = spark.read.parquet(source)
    size = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).agg(F.sum("length")).first()[0] or 0
    rows = max(1, df.count())
    per_file = max(1, int(rows * max_bytes * 0.8 / max(size, 1)))
    df.repartition(max(1, -(-rows // per_file))).write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(target)


def html_text(html):
    """Column of visible text: scripts, styles, navigation, comments and ads go
    before tags do; block ends become line feeds; entities come last."""
    for pattern in (r"(?s)<script[^>]*>.*?</script>", r"(?s)<style[^>]*>.*?</style>", r"(?s)<nav[^>]*>.*?</nav>", r"(?s)<!--.*?-->", r'(?s)<div class="ad">.*?</div>', r"(?s)<head>.*?</head>"):
        html = F.regexp_replace(html, pattern, " ")
    html = F.regexp_replace(html, r"(?i)</?(p|br|h[1-6]|li|ul|div|article|section)[^>]*>", "\n")
    html = F.regexp_replace(html, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        html = F.replace(html, F.lit(entity), F.lit(char))
    html = F.regexp_replace(html, r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(html, r" ?\n[ \n]*", "\n"), r"^\s+|\s+$", "")


def page_sections(pages: DataFrame) -> DataFrame:
    """page_id, url, title, heading (first h1) and visible text."""
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    heading = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return pages.select("page_id", "url", title.alias("title"), heading.alias("heading"), html_text(F.col("html")).alias("text"))
