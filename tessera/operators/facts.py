"""Exact facts: extraction, names, lookups, and questions that need no search."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import folded, tokens

_DEFINITION = re.compile(r"^\s*(?:class|struct|enum)\s+(\w+)|^[\w:<>,&*\s~]*?\b([\w~]+(?:::[\w~]+)*)\s*\([^;{}]*\)\s*(?:const)?\s*\{", re.M)
_CALL = re.compile(r"\b([A-Za-z_]\w*(?:(?:::|\.|->)[A-Za-z_]\w*)*)\s*\(")
_NOT_CALLS = {"if", "for", "while", "switch", "return", "sizeof", "catch", "defined"}


_HIDDEN = re.compile(r'//[^\n]*|/\*.*?\*/|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'', re.S)


def _bare(content: str) -> str:
    """The content with comments and strings blanked out, line for line."""
    return _HIDDEN.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), content)


def _definitions(content: str) -> list[tuple[str, str, int, int]]:
    """(name, kind, first line, last line) of classes and function bodies, by
    matching braces outside comments and strings; a stand-in for a syntax tree
    where no parser is there."""
    out, content = [], _bare(content)
    for m in _DEFINITION.finditer(content):
        name, kind = (m[1], "class") if m[1] else (m[2], "function")
        if name in _NOT_CALLS:
            continue
        at, depth = content.find("{", m.start()), 0
        end = len(content)
        for i in range(max(at, 0), len(content)):
            depth += {"{": 1, "}": -1}.get(content[i], 0)
            if not depth and i > at:
                end = i
                break
        first = m.start() + len(m[0]) - len(m[0].lstrip())
        out.append((name, kind, content.count("\n", 0, first) + 1, content.count("\n", 0, end) + 1))
    return out


def extract_symbols(files: DataFrame) -> DataFrame:
    """(path, name, kind, line_start, line_end) of every definition in files
    (path, content); one file is one row, read in Arrow batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(p, *d) for p, c in zip(f["path"], f["content"]) for d in _definitions(c or "")]
            yield pd.DataFrame(rows, columns=["path", "name", "kind", "line_start", "line_end"])

    return files.select("path", "content").mapInPandas(run, "path string, name string, kind string, line_start int, line_end int")


def extract_calls(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """(src, dst, file, line): call sites inside function bodies. Names resolve
    by their last part to the definitions that are known."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"]):
                spans = [d for d in _definitions(content or "") if d[1] == "function"]
                lines = _bare(content or "").split("\n")
                for src, _, a, b in spans:  # only the lines of each body
                    for k in range(a, b + 1):
                        line = lines[k - 1]
                        if k > a or "{" in line:
                            rows += [(src, c, path, k) for c in _CALL.findall(line.split("{", 1)[-1] if a == k else line) if c not in _NOT_CALLS]
            yield pd.DataFrame(rows, columns=["src", "called", "file", "line"])

    sites = files.select("path", "content").mapInPandas(run, "src string, called string, file string, line int")
    last = F.element_at(F.split("called", r"::|\.|->"), -1)
    known = symbols.where("kind = 'function'").select(F.col("name").alias("dst"), F.element_at(F.split("name", "::"), -1).alias("last")).distinct()
    return sites.withColumn("last", last).join(known, "last").select("src", "dst", "file", "line")


def augment(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``first`` and what only ``second`` has, with ``origin``."""
    more = second.join(first.select(*keys), keys, "left_anti")
    return first.withColumn("origin", F.lit("first")).unionByName(more.withColumn("origin", F.lit("second")))


def extract_params(files: DataFrame) -> DataFrame:
    """Parameter notes of the form ``@Param: X``, ``@Range: lo hi``,
    ``@Units: u``, ``@Default: d``, one block of lines for each."""
    block = F.explode(F.regexp_extract_all("content", F.lit(r"(@Param: [^\n]*(?:\n[^\n]*@[A-Z][A-Za-z]*:[^\n]*)*)"), 1))
    get = lambda tag: F.nullif(F.trim(F.regexp_extract("block", rf"@{tag}: *([^\n]*)", 1)), F.lit(""))
    found = files.select("path", block.alias("block")).select("path", get("Param").alias("leaf"), get("Default").alias("dflt"), get("Units").alias("units"), F.split(get("Range"), r"\s+").alias("range"))
    bound = lambda k: F.try_element_at("range", F.lit(k)).try_cast("double")
    return found.select("path", "leaf", "dflt", bound(1).alias("lo"), bound(2).alias("hi"), "units")


def qualify(leaves: DataFrame, groups: DataFrame, on: list[str], group: str, leaf: str) -> DataFrame:
    """``full_name`` = group and leaf, nothing between. A leaf with several
    groups would be a false fact: it is left out and can be listed apart."""
    one = groups.groupBy(*on).agg(F.min(group).alias(group), F.count("*").alias("n")).where("n = 1").drop("n")
    return leaves.join(one, on).withColumn("full_name", F.concat(group, leaf))


def extract_messages(spark, path: str, protocol: str = "xml", row_tag: str = "message") -> DataFrame:
    """Message definitions of an XML file, or of all ``*.xml`` files under a
    folder: id, name and typed fields."""
    schema = "_id int, _name string, field array<struct<_name:string,_type:string,_VALUE:string>>"
    found = spark.read.format("xml").option("rowTag", row_tag).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").schema(schema).load(path)
    fields = F.transform(F.coalesce("field", F.array()), lambda f: F.struct(f["_name"].alias("name"), f["_type"].alias("type")))
    return found.select(F.lit(protocol).alias("protocol"), F.col("_id").alias("msg_id"), F.col("_name").alias("name"), fields.alias("fields"))


def parse_dsdl(files: DataFrame) -> DataFrame:
    """Message definitions of files named ``id.Name.uavcan``: a field a line."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = F.filter(F.transform(F.split("content", "\n"), lambda l: F.trim(F.regexp_replace(l, "#.*", ""))), lambda l: l.rlike(r"^[\w.\[\]<=]+\s+\w+$"))
    fields = F.transform(rows, lambda l: F.struct(F.element_at(F.split(l, r"\s+"), 2).alias("name"), F.element_at(F.split(l, r"\s+"), 1).alias("type")))
    return files.select(F.lit("dsdl").alias("protocol"), F.regexp_extract(name, r"^(\d+)\.", 1).try_cast("int").alias("msg_id"), F.regexp_extract(name, r"^(?:\d+\.)?(\w+)\.", 1).alias("name"), fields.alias("fields"))


def lookup(requests: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Facts of the keys asked for: a hash join, with the small side broadcast
    where the planner sees that it is small."""
    return requests.select(key).distinct().join(facts, key)


#: A name of code or of a parameter: whole words (of the letters and digits that
#: ``tokens`` has) joined by colons, dots or arrows. A word that begins with a
#: digit is taken whole too, so that no piece of it is left: a look behind would
#: see but half of a character beyond U+FFFF.
NAME = r"[\p{L}_~][\p{L}\p{N}_]*(?:(?:::|\.|->)[\p{L}_~][\p{L}\p{N}_]*)*|\p{N}[\p{L}\p{N}_]*"


def mentions(questions: DataFrame, names: DataFrame, id_col: str = "item_id", text_col: str = "text", name: str = "name") -> DataFrame:
    """Fact names that stand in questions as words or as qualified names
    (``Type::member``), in upper or lower case: an equi-join on what is folded.
    The name is returned as the facts have it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    said = F.array_distinct(F.concat(tokens(text), F.regexp_extract_all(folded(text), F.lit(NAME), 0)))
    words = questions.select(id_col, F.explode(said).alias("_said"))
    return words.join(names, F.col("_said") == folded(names[name])).drop("_said")


#: Which kind of fact a question's wording asks for, and when no word tells,
#: the order of preference.
ASKED = (("caller", r"(?i)\bcall(s|er|ers|ed|ing)?\b"), ("message", r"(?i)\b(message|msg|id)\b"), ("symbol", r"(?i)\b(file|defin\w*|declared?|implement\w*|where)\b"), ("parameter", r"(?i)\b(param\w*|defaults?|range|units?|values?)\b"))


def named_facts(params: DataFrame | None = None, symbols: DataFrame | None = None, messages: DataFrame | None = None, calls: DataFrame | None = None) -> DataFrame:
    """(name, kind, answer, file, line): what can be answered without a search.

    params: full_name or leaf, dflt, lo, hi, units, path; symbols: name, kind,
    path, line_start; messages: protocol, msg_id, name; calls: src, dst, file,
    line. A caller fact lists all callers of a name in order.
    """
    parts = []
    if params is not None:
        own = F.col("full_name") if "full_name" in params.columns else F.col("leaf")
        said = [F.concat(own, F.lit(":")), *(F.concat(F.lit(f" {label} "), F.col(c).cast("string"), F.lit(";")) for label, c in (("default", "dflt"), ("from", "lo"), ("to", "hi"), ("units", "units")))]
        parts.append(params.select(own.alias("name"), F.lit("parameter").alias("kind"), F.rtrim(F.concat_ws("", *said), F.lit(";")).alias("answer"), F.col("path").alias("file"), F.lit(1).alias("line")))
    if symbols is not None:
        parts.append(symbols.select("name", F.lit("symbol").alias("kind"), F.concat("name", F.lit(" is a "), F.col("kind"), F.lit(" in "), "path", F.lit(":"), F.col("line_start").cast("string")).alias("answer"), F.col("path").alias("file"), F.col("line_start").alias("line")))
    if messages is not None:
        parts.append(messages.select("name", F.lit("message").alias("kind"), F.concat("name", F.lit(" has id "), F.col("msg_id").cast("string"), F.lit(" in "), "protocol").alias("answer"), F.lit(None).cast("string").alias("file"), F.lit(None).cast("int").alias("line")))
    if calls is not None:
        own = calls.groupBy(F.col("dst").alias("name")).agg(F.sort_array(F.collect_set("src")).alias("callers"), F.min(F.struct("file", "line")).alias("at"))
        parts.append(own.select("name", F.lit("caller").alias("kind"), F.concat("name", F.lit(" is called by "), F.array_join("callers", ", ")).alias("answer"), F.col("at.file").alias("file"), F.col("at.line").cast("int").alias("line")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("answer is not null")


def direct_answers(questions: DataFrame, facts: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id, name, answer, file, line): one fact for each question that names
    one. The kind that the wording asks for comes first, then the longest name,
    then the order of kinds, then the name and the answer."""
    kind = F.col("kind") if "kind" in facts.columns else F.lit(None).cast("string")
    hits = mentions(questions.select(id_col, text_col), facts.withColumn("kind", kind), id_col, text_col).join(questions.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).distinct(), F.col(id_col) == F.col("_id"))
    asks, place = F.lit(False), F.lit(len(ASKED))
    for k, (name, pattern) in enumerate(ASKED):
        asks = asks | (F.coalesce(F.col("kind") == name, F.lit(False)) & F.regexp_like("_text", F.lit(pattern)))
        place = F.when(F.col("kind") == name, len(ASKED) - k).otherwise(place)
    best = F.min(F.struct((~asks).alias("a"), (-F.length("name")).alias("b"), place.alias("c"), "name", "answer", "file", "line"))
    return hits.groupBy(id_col).agg(best.alias("f")).select(id_col, "f.name", "f.answer", "f.file", "f.line")


def split_direct(questions: DataFrame, mentioned: DataFrame, id_col: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(questions that exact facts answer, the others)."""
    known = mentioned.select(id_col).distinct()
    return questions.join(known, id_col, "left_semi"), questions.join(known, id_col, "left_anti")
