"""Queries of the question-answering operators, with their SQL.

Questions are the benchmark passages, documents the corpus, a document's source
its domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators import answering, chunking, evaluation, facts, graph, indexing, lexical, retrieval
from tessera.operators.lexical import Index
from tessera.session import Options
from tessera.sources import store
from tessera.sources.store import table as t

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
OPTIONS = Options()


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# ------------------------------------------------------------------ SQL parts

_W = r"[^\p{L}\p{N}_]+"


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex(lower(coalesce({text}, '')), '{_W}'), lambda w: w <> '')"


_NORM = "' ' || array_to_string({}, ' ') || ' '"
DOCS = f"d AS (SELECT doc_id, source, text, {_words('text')} AS w FROM documents)"
TF = f"{DOCS}, tf AS (SELECT doc_id, source, term, count(*) AS tf FROM (SELECT doc_id, source, unnest(w) AS term FROM d) GROUP BY ALL), dl AS (SELECT doc_id, len(w)::BIGINT AS dl FROM d)"
QUESTIONS = f"q AS (SELECT item_id AS qid, text, {_words('text')} AS w FROM benchmark), qt AS (SELECT DISTINCT qid, unnest(w) AS term FROM q)"
STATS = "df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), g AS (SELECT count(*) AS n, avg(dl) AS a FROM dl)"
_IDF = "ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))"
_PART = f"{_IDF} * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / a))"
BM25 = f"WITH {TF}, {QUESTIONS}, {STATS}, s AS (SELECT qid, doc_id, round(sum({_PART}), 6) AS score FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN g GROUP BY qid, doc_id), r AS (SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))::INT AS rk FROM s), top AS (SELECT * FROM r WHERE rk <= 10)"
GOLD = f"gold AS (SELECT q.qid, d.doc_id FROM q JOIN d ON len(q.w) > 0 AND contains({_NORM.format('d.w')}, {_NORM.format('q.w')}))"
COVER = f"{BM25}, cov AS (SELECT top.qid, top.doc_id, top.score, top.rk, round(len(list_intersect(list_distinct(q.w), list_distinct(d.w))) / len(list_distinct(q.w))::DOUBLE, 6) AS coverage FROM top JOIN q USING (qid) JOIN d USING (doc_id))"
GATED = f"{COVER}, gated AS (SELECT * FROM cov WHERE coverage >= 0.9)"
EVIDENCE = f"""{GATED}, pairs AS (SELECT g.qid, g.rk, g.doc_id, d.source || '/' || d.doc_id AS file, q.w AS qw, string_split(d.text, chr(10)) AS all_lines FROM gated g JOIN d USING (doc_id) JOIN q USING (qid) WHERE g.rk <= 3),
rated AS (SELECT qid, rk, doc_id, file, i AS line, all_lines[i] AS text, len(list_intersect(list_distinct(qw), list_distinct({_words('all_lines[i]')}))) AS hits FROM (SELECT *, unnest(range(1, len(all_lines) + 1)) AS i FROM pairs)),
ev AS (SELECT qid, rk, doc_id, file, line::INT AS line, text FROM rated QUALIFY row_number() OVER (PARTITION BY qid, rk ORDER BY hits DESC, line) = 1)"""
ANSWERS = rf"""{EVIDENCE}, ans AS (SELECT qid, string_agg(regexp_replace(text, '[.!?]+\s*$', '') || ' [' || file || ':' || line || '].', ' ' ORDER BY rk) AS answer FROM ev GROUP BY qid)"""
PLANT = ANSWERS + """, planted AS (SELECT qid, answer || ' The limit is 421777 [' || (SELECT min(file || ':' || line) FROM ev e WHERE e.qid = ans.qid AND e.rk = (SELECT min(rk) FROM ev f WHERE f.qid = ans.qid)) || ']. See more [nowhere/1:999999]. It might be so [' || (SELECT min(file || ':' || line) FROM ev e WHERE e.qid = ans.qid AND e.rk = (SELECT min(rk) FROM ev f WHERE f.qid = ans.qid)) || ']. Nothing is cited here.' AS answer FROM ans)"""
SENTENCES = PLANT + r""", parts AS (SELECT qid, list_filter(string_split_regex(answer, '[.!?]\s+'), lambda s: trim(s) <> '') AS p FROM planted),
sen AS (SELECT qid, unnest(range(1, len(p) + 1))::INT AS pos, regexp_replace(unnest(p), '[.!?]+$', '') AS sentence FROM parts)"""
AUDIT = SENTENCES + r""", held AS (SELECT qid, list({'k': file || ':' || line, 't': text}) AS e FROM ev GROUP BY qid),
aud0 AS (SELECT sen.*, regexp_extract_all(sentence, '\[([^\[\]:]+:\d+)\]', 1) AS cites, list_distinct(regexp_extract_all(regexp_replace(sentence, '\[[^\[\]:]+:\d+\]', '', 'g'), '\d+(?:\.\d+)?')) AS nums, e FROM sen LEFT JOIN held USING (qid)),
aud1 AS (SELECT *, len(cites) = 0 AS uncited, len(list_filter(cites, lambda c: NOT list_contains(list_transform(e, lambda x: x.k), c))) > 0 AS bad_citation,
  regexp_matches(sentence, '(?i)\b(probably|might|perhaps|possibly|maybe|presumably|likely|seems|appears)\b') AS speculation,
  flatten(list_transform(list_filter(e, lambda x: list_contains(cites, x.k)), lambda x: regexp_extract_all(x.t, '\d+(?:\.\d+)?'))) AS have FROM aud0),
aud AS (SELECT qid, pos, sentence, uncited, bad_citation, speculation, len(list_filter(nums, lambda v: NOT list_contains(have, v))) > 0 AS bad_number FROM aud1),
audited AS (SELECT *, uncited OR bad_citation OR speculation OR bad_number AS struck FROM aud)"""
ROUTES = f"WITH {TF}, {QUESTIONS}, {STATS}, per AS (SELECT source AS domain, term, count(*) AS m FROM tf GROUP BY ALL), sz AS (SELECT source AS domain, count(*) AS dd FROM d GROUP BY 1), rs AS (SELECT qid, domain, round(sum({_IDF} * m / dd), 6) AS score FROM qt JOIN per USING (term) JOIN df USING (term) JOIN sz USING (domain) CROSS JOIN g GROUP BY ALL), routes AS (SELECT * FROM rs QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, domain) <= 3)"
ROUTED_TOP = f"{ROUTES}, s AS (SELECT qid, doc_id, round(sum({_PART}), 6) AS score FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN g WHERE EXISTS (SELECT 1 FROM routes r WHERE r.qid = qt.qid AND r.domain = tf.source) GROUP BY qid, doc_id), top AS (SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))::INT AS rk FROM s QUALIFY rk <= 10)"
AUDIT_ROUTED = ROUTED_TOP + AUDIT.removeprefix(BM25).replace("planted AS (SELECT qid, answer || ", "unused AS (SELECT qid, answer || ").replace("FROM planted)", "FROM ans)") + """, closed AS (SELECT qid, CASE WHEN count(*) FILTER (NOT struck) > 0 THEN string_agg(sentence, '. ' ORDER BY pos) FILTER (NOT struck) || '.' ELSE 'Not supported by the indexed corpus.' END AS answer, array_to_string(list(sentence ORDER BY pos) FILTER (struck), ' | ') AS struck FROM audited GROUP BY qid)"""
MENTIONS = f"WITH {DOCS}, {QUESTIONS}, names AS (SELECT w[1] AS name, min(doc_id) AS doc_id FROM d WHERE length(w[1]) >= 6 GROUP BY 1), men AS (SELECT qid, name, doc_id FROM qt JOIN names ON term = name)"


# ------------------------------------------------------------------ plan parts


def _questions(spark, d) -> DataFrame:
    return t(spark, d, "benchmark")


def _docs(spark, d) -> DataFrame:
    return store.spread(t(spark, d, "documents").select("doc_id", "source", "text"))


_INDEXES: dict = {}


def _index(spark, d) -> Index:
    """The stored index of ``documents``, made when a session first asks for it
    and again when the table's files have changed."""
    key = (spark.sparkContext.applicationId, d)
    state = store.state_of(spark, f"{d}/documents.parquet")
    if key not in _INDEXES or _INDEXES[key][0] != state:
        _INDEXES[key] = state, lexical.write(_docs(spark, d), store.work_folder(spark))
    return _INDEXES[key][1]


def _top(spark, d) -> DataFrame:
    return retrieval.bm25_topk(_questions(spark, d), _index(spark, d), OPTIONS.top_k, k1=OPTIONS.k1, b=OPTIONS.b)


def _gated(spark, d) -> DataFrame:
    return retrieval.gate(_top(spark, d), OPTIONS.rerank_min)


def _evidence(spark, d) -> DataFrame:
    return answering.evidence(_gated(spark, d), _questions(spark, d), _index(spark, d), OPTIONS.evidence)


def _planted(spark, d) -> tuple[DataFrame, DataFrame]:
    """Extractive answers with four faulty sentences added, and their evidence."""
    ev = store.written(_evidence(spark, d))  # small, and read several times
    first = ev.groupBy("qid").agg(F.min(F.struct("rk", F.concat("file", F.lit(":"), F.col("line").cast("string")).alias("k"))).alias("f")).select("qid", F.col("f.k").alias("k"))
    text = F.concat(F.col("answer"), F.lit(" The limit is 421777 ["), "k", F.lit("]. See more [nowhere/1:999999]. It might be so ["), "k", F.lit("]. Nothing is cited here."))
    return answering.extractive(ev).join(first, "qid").select("qid", text.alias("answer")), ev


def _audited(spark, d) -> DataFrame:
    return answering.audit(*_planted(spark, d))


def _mentions(spark, d) -> DataFrame:
    words = tokens(F.col("text"))
    first = _docs(spark, d).select("doc_id", F.try_element_at(words, F.lit(1)).alias("name")).where(F.length("name") >= 6)
    names = first.groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    return facts.mentions(_questions(spark, d), names).select(F.col("item_id").alias("qid"), "name", "doc_id")


def _edges(spark, d) -> DataFrame:
    return graph.link_edges(t(spark, d, "pages"))


# ------------------------------------------------------------------ sources


@query("SELECT doc_id, source, lang, n_chars, length(text)::INT AS size, md5(text) AS content_id FROM documents")
def scan_documents(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", F.length("text").alias("size"), F.md5(F.col("text").cast("binary")).alias("content_id"))


@query("SELECT doc_id::VARCHAR AS chunk_id, source AS domain, 'doc' AS source_kind, source || '/' || doc_id AS file, 1 AS line_start, len(string_split(text, chr(10)))::INT AS line_end, md5(text) AS content_id FROM documents")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = f"{store.work_folder(spark)}/chunks"
    chunks = _docs(spark, d).select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("source").alias("domain"), F.lit("doc").alias("source_kind"), F.concat_ws("/", "source", "doc_id").alias("file"), F.lit(1).alias("line_start"), F.size(F.split("text", "\n")).alias("line_end"), "text")
    store.write_chunks(chunks, path)
    return store.read_chunks(spark, path).withColumn("content_id", F.md5(F.col("text").cast("binary"))).drop("text")


@query("SELECT source AS domain, count(*) AS docs, count(DISTINCT doc_id) AS ids, min(doc_id) AS first FROM documents GROUP BY 1")
def domain_partition_counts(spark: SparkSession, d: str) -> DataFrame:
    path = f"{store.work_folder(spark)}/by_domain"
    store.write_by_domain(_docs(spark, d).select("doc_id", F.col("source").alias("domain")), path)
    return spark.read.parquet(path).groupBy("domain").agg(F.count("*").alias("docs"), F.countDistinct("doc_id").alias("ids"), F.min("doc_id").alias("first")).withColumn("domain", F.col("domain").cast("string"))


@query("SELECT label::VARCHAR AS domain, count(*) AS vectors, min(vec_id) AS first, round(sum(embedding[1]::DOUBLE), 4) AS total FROM embeddings GROUP BY 1")
def dense_store_by_domain(spark: SparkSession, d: str) -> DataFrame:
    """Vectors joined to their domains, stored a folder a domain, read back."""
    v, path = t(spark, d, "embeddings"), f"{store.work_folder(spark)}/vectors"
    domains = v.select("vec_id", F.col("label").cast("string").alias("domain"))
    store.write_by_domain(indexing.with_domain(v.select("vec_id", "embedding"), domains, "vec_id"), path)
    back = spark.read.parquet(path).groupBy("domain").agg(F.count("*").alias("vectors"), F.min("vec_id").alias("first"), F.round(F.sum(F.element_at("embedding", 1).cast("double")), 4).alias("total"))
    return back.withColumn("domain", F.col("domain").cast("string"))


@query(f"WITH {TF} SELECT source AS domain, count(DISTINCT doc_id) AS docs, (sum(tf))::BIGINT AS words, count(*) AS postings, count(DISTINCT term) AS terms FROM tf GROUP BY 1")
def lexical_index_stats(spark: SparkSession, d: str) -> DataFrame:
    return indexing.domain_statistics(_index(spark, d))


@query(f"WITH {TF} SELECT (SELECT count(*) FROM d) AS docs, count(*) AS postings, (sum(tf))::BIGINT AS words, count(DISTINCT term) AS terms FROM tf")
def lexical_index_build(spark: SparkSession, d: str) -> DataFrame:
    """Store a new index of ``documents`` and count what it holds."""
    index = lexical.write(_docs(spark, d), store.work_folder(spark))
    terms = index.postings.groupBy("term").agg(F.count("*").alias("n"), F.sum("tf").alias("tf"))
    held = terms.agg(F.sum("n").alias("postings"), F.sum("tf").alias("words"), F.count("*").alias("terms"))
    return index.sizes.agg(F.sum("docs").alias("docs")).crossJoin(held)  # one row each


@query(f"WITH {DOCS}, {QUESTIONS}, {GOLD} SELECT qid, doc_id FROM gold")
def gold_from_containment(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.gold_pairs(_questions(spark, d), _index(spark, d))


_STRIP = [r"(?s)<script[^>]*>.*?</script>", r"(?s)<style[^>]*>.*?</style>", r"(?s)<nav[^>]*>.*?</nav>", r"(?s)<!--.*?-->", r'(?s)<div class="ad">.*?</div>', r"(?s)<head>.*?</head>"]
_HTML = "html"
for _p in _STRIP:
    _HTML = f"regexp_replace({_HTML}, '{_p}', ' ', 'g')"
_HTML = f"regexp_replace(regexp_replace({_HTML}, '(?i)</?(p|br|h[1-6]|li|ul|div|article|section)[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')"
for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_a}', '{_b}')"
_HTML = rf"regexp_replace(regexp_replace(regexp_replace({_HTML}, '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS heading, {_HTML} AS text FROM pages")
def html_sections(spark: SparkSession, d: str) -> DataFrame:
    return store.page_sections(t(spark, d, "pages"))


# ------------------------------------------------------------------ facts


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)")
def exact_lookup(spark: SparkSession, d: str) -> DataFrame:
    asked = t(spark, d, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return facts.lookup(asked, t(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), "p_partkey")


@query("""
SELECT p_partkey, p_size, 'first' AS origin FROM part WHERE p_size <= 25
UNION ALL SELECT p_partkey, p_size, 'second' FROM part a WHERE p_size >= 20 AND NOT EXISTS (SELECT 1 FROM part b WHERE b.p_partkey = a.p_partkey AND b.p_size <= 25)""")
def augment_anti_union(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part").select("p_partkey", "p_size")
    return facts.augment(p.where("p_size <= 25"), p.where("p_size >= 20"), ["p_partkey"])


@query("""SELECT page_id AS src, dst, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages) GROUP BY ALL""")
def link_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


@query("SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def kv_extract(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT n_nationkey, r_name || n_name AS full_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def qualify_names(spark: SparkSession, d: str) -> DataFrame:
    groups = t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return facts.qualify(t(spark, d, "nation"), groups, ["n_regionkey"], "r_name", "n_name").select("n_nationkey", "full_name")


@query(f"{MENTIONS} SELECT qid, name, doc_id FROM men")
def entity_mention_join(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d)


@query("""SELECT s_suppkey, replace(r_name, ' ', '_') || '::' || n_name AS name, n_nationkey FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def entity_mention_names(spark: SparkSession, d: str) -> DataFrame:
    """Qualified names in other spellings inside questions: ``Asia::INDIA``."""
    nation, region = t(spark, d, "nation"), t(spark, d, "region")
    names = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.concat(F.replace("r_name", F.lit(" "), F.lit("_")), F.lit("::"), "n_name").alias("name"), "n_nationkey")
    asked = t(spark, d, "supplier").join(names, F.col("s_nationkey") == F.col("n_nationkey"))
    said = F.when(F.col("s_suppkey") % 2 == 0, F.initcap("name")).otherwise(F.lower("name"))
    questions = asked.select("s_suppkey", F.concat(F.lit("Who calls "), said, F.lit(", and from where?")).alias("text"))
    return facts.mentions(questions, names, "s_suppkey")


@query(f"{MENTIONS} SELECT qid AS item_id, CASE WHEN qid IN (SELECT qid FROM men) THEN 'direct' ELSE 'retrieve' END AS path FROM q")
def direct_vs_retrieve_split(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d).select("item_id")
    direct, rest = facts.split_direct(q, _mentions(spark, d).withColumnRenamed("qid", "item_id"))
    return direct.withColumn("path", F.lit("direct")).unionByName(rest.withColumn("path", F.lit("retrieve")))


# ------------------------------------------------------------------ chunks


@query("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents), x AS (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS line FROM l),
h AS (SELECT *, sum(CASE WHEN line = 1 OR length(a[line]) <= 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS section FROM x)
SELECT doc_id, section::INT AS section, min(line)::INT AS line_start, max(line)::INT AS line_end, string_agg(a[line], chr(10) ORDER BY line) AS text FROM h GROUP BY doc_id, section""")
def section_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.section_chunks(_docs(spark, d))


@query("SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1))::INT AS line, unnest(string_split(text, chr(10))) AS text FROM documents")
def chunk_line_provenance(spark: SparkSession, d: str) -> DataFrame:
    return chunking.line_provenance(_docs(spark, d))


@query("""
WITH x AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line, unnest(string_split(text, chr(10))) AS text FROM documents),
c AS (SELECT *, (sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line) - length(text) - 1) // 800 AS chunk FROM x)
SELECT doc_id, chunk::BIGINT AS chunk, min(line)::INT AS line_start, max(line)::INT AS line_end, string_agg(text, chr(10) ORDER BY line) AS text FROM c GROUP BY doc_id, chunk""")
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    return chunking.packed_chunks(_docs(spark, d))


@query("SELECT md5(text) AS content_id, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return chunking.exact_duplicates(_docs(spark, d))


# ------------------------------------------------------------------ graph


@query("""SELECT src, dst, n FROM (SELECT page_id AS src, dst, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages) GROUP BY ALL) WHERE dst IN (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) FROM pages WHERE page_id % 100 = 0)""")
def graph_callers(spark: SparkSession, d: str) -> DataFrame:
    """Who links to what the stated pages link to."""
    targets = graph.link_edges(t(spark, d, "pages").where("page_id % 100 = 0")).select("dst")
    return graph.callers(_edges(spark, d), targets).select("src", "dst", "n")


@query("""SELECT src, dst, n FROM (SELECT page_id AS src, dst, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages) GROUP BY ALL) WHERE src % 100 = 0""")
def graph_callees(spark: SparkSession, d: str) -> DataFrame:
    return graph.callees(_edges(spark, d), t(spark, d, "pages").where("page_id % 100 = 0").select(F.col("page_id").alias("src"))).select("src", "dst", "n")


@query("""
WITH e AS (SELECT DISTINCT page_id::VARCHAR AS src, dst FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages)),
b AS (SELECT src AS node, 0 AS i, 1 AS o FROM e UNION ALL SELECT dst, 1, 0 FROM e)
SELECT node, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree FROM b GROUP BY node""")
def graph_degree(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(_edges(spark, d))


@query("""
WITH RECURSIVE e AS (SELECT a.conv_id * 1000 + a.turn AS src, b.conv_id * 1000 + b.turn AS dst FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn IN (a.turn + 1, a.turn + 2)),
r AS (SELECT conv_id * 1000 AS source, conv_id * 1000 AS node, 0 AS depth FROM conversations WHERE turn = 0 UNION SELECT r.source, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 3)
SELECT source, node, min(depth)::INT AS depth FROM r GROUP BY ALL""")
def graph_reach(spark: SparkSession, d: str) -> DataFrame:
    """Turns within three steps of the first, a step being one turn or two."""
    c = t(spark, d, "conversations").select("conv_id", "turn")
    a = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("src"), "conv_id", F.explode(F.array(F.col("turn") + 1, F.col("turn") + 2)).alias("turn"))
    edges = a.join(c, ["conv_id", "turn"]).select("src", (F.col("conv_id") * 1000 + F.col("turn")).alias("dst"))
    return graph.reach(edges, c.where("turn = 0").select((F.col("conv_id") * 1000).alias("node")), 3)


@query("""
SELECT c_nationkey AS src_domain, s_nationkey AS dst_domain, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
WHERE c_nationkey <> s_nationkey GROUP BY ALL""")
def graph_cross_domain(spark: SparkSession, d: str) -> DataFrame:
    """Who orders from whom across nations: customers and suppliers are nodes."""
    li, o = t(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), t(spark, d, "orders").select("o_orderkey", "o_custkey")
    edges = li.join(o, li.l_orderkey == o.o_orderkey).select((-F.col("o_custkey") - 1).alias("src"), F.col("l_suppkey").alias("dst"))
    nodes = t(spark, d, "customer").select((-F.col("c_custkey") - 1).alias("node"), F.col("c_nationkey").alias("domain")).unionAll(t(spark, d, "supplier").select("s_suppkey", "s_nationkey"))
    return graph.cross_domain(edges, nodes)


# ------------------------------------------------------------------ indexing


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    return indexing.pending(_docs(spark, d).select("doc_id"), t(spark, d, "labels"), "doc_id")


@query(f"WITH {DOCS} SELECT doc_id, len(w)::BIGINT AS dl, len(list_distinct(w))::BIGINT AS distinct_terms FROM d")
def tokens_per_document(spark: SparkSession, d: str) -> DataFrame:
    return indexing.lengths(_docs(spark, d))


QUERIES["tokens"], ORACLES["tokens"] = QUERIES.pop("tokens_per_document"), ORACLES.pop("tokens_per_document")


@query(f"WITH {TF} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term")
def term_stats(spark: SparkSession, d: str) -> DataFrame:
    return indexing.term_statistics(_index(spark, d))


# ------------------------------------------------------------------ retrieval


@query(f"{ROUTES} SELECT qid, array_to_string(list(domain ORDER BY domain), ',') AS routed FROM routes GROUP BY qid")
def route_topm(spark: SparkSession, d: str) -> DataFrame:
    routes = retrieval.route(_questions(spark, d), _index(spark, d), OPTIONS.routed_domains)
    return routes.groupBy("qid").agg(F.array_join(F.sort_array(F.collect_set("domain")), ",").alias("routed"))


@query(f"{BM25} SELECT qid, doc_id, score, rk FROM top")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return _top(spark, d).drop("coverage")


@query("""
WITH p AS (SELECT a.vec_id AS qid, b.vec_id, round(list_sum(list_transform(range(1, 65), lambda i: a.embedding[i]::DOUBLE * b.embedding[i])), 6) AS score FROM embeddings a CROSS JOIN embeddings b WHERE a.vec_id % 100 = 0)
SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id))::INT AS rk FROM p QUALIFY rk <= 10""")
def dense_topk(spark: SparkSession, d: str) -> DataFrame:
    v = t(spark, d, "embeddings")
    return retrieval.dense_topk(v.where("vec_id % 100 = 0"), v, OPTIONS.top_k)


@query(None)
def ann_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall of the cell index against exact search, over the stated queries."""
    v = t(spark, d, "embeddings").select("vec_id", "embedding")
    q = v.where("vec_id % 100 = 0")
    exact = retrieval.dense_topk(q, v, OPTIONS.top_k)
    near = retrieval.ann_topk(q, *retrieval.ivf_cells(v), OPTIONS.top_k)
    both = exact.select("qid", "vec_id").join(near.select("qid", "vec_id", F.lit(1).alias("found")), ["qid", "vec_id"], "left")
    return both.agg(F.count("*").alias("wanted"), F.count("found").alias("found"), F.round(F.count("found") / F.count("*"), 4).alias("recall"))


@query(f"""{COVER}, c2 AS (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY coverage DESC, doc_id) AS rk FROM cov),
u AS (SELECT qid, doc_id, rk FROM top UNION ALL SELECT qid, doc_id, rk FROM c2), f AS (SELECT qid, doc_id, round(sum(1 / (60 + rk)::DOUBLE), 9) AS score FROM u GROUP BY ALL)
SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))::INT AS rk FROM f QUALIFY rk <= 10""")
def rrf_fuse(spark: SparkSession, d: str) -> DataFrame:
    """BM25 fused with the ranking by question coverage."""
    top = _top(spark, d)
    cov = top.drop("rk")
    return retrieval.rrf([top, retrieval.ranked(cov, "qid", "coverage", "doc_id", None)], OPTIONS.top_k)


@query(f"""{ROUTES}, s AS (SELECT qid, doc_id, round(sum({_PART}), 6) AS score FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN g WHERE EXISTS (SELECT 1 FROM routes r WHERE r.qid = qt.qid AND r.domain = tf.source) GROUP BY qid, doc_id)
SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))::INT AS rk FROM s QUALIFY rk <= 10""")
def bm25_routed_topk(spark: SparkSession, d: str) -> DataFrame:
    q, index = _questions(spark, d), _index(spark, d)
    return retrieval.bm25_topk(q, index, OPTIONS.top_k, retrieval.route(q, index, OPTIONS.routed_domains)).drop("coverage")


@query(f"{COVER} SELECT qid, doc_id, score, rk, coverage FROM cov")
def rerank_coverage(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.rerank(_top(spark, d), _questions(spark, d), _index(spark, d).texts)


@query(f"{GATED} SELECT qid, doc_id, score, rk, coverage FROM gated")
def relevance_gate(spark: SparkSession, d: str) -> DataFrame:
    return _gated(spark, d)


@query(f"{GATED} SELECT qid, '{answering.REFUSAL}' AS answer FROM q WHERE qid NOT IN (SELECT qid FROM gated)")
def refuse_unanswerable(spark: SparkSession, d: str) -> DataFrame:
    return answering.refused(_questions(spark, d), _gated(spark, d))


@query(f"{EVIDENCE} SELECT qid, rk, doc_id, file, line, text FROM ev")
def ground_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _evidence(spark, d)


@query(f"{ANSWERS} SELECT qid, answer FROM ans")
def extractive_answer(spark: SparkSession, d: str) -> DataFrame:
    return answering.generate(answering.grounded(_evidence(spark, d)))


@query(f"{GATED}, names AS (SELECT w[1] AS name FROM d WHERE length(w[1]) >= 6), men AS (SELECT qid FROM qt JOIN names ON term = name) SELECT qid, CASE WHEN qid IN (SELECT qid FROM men) THEN 'direct' WHEN qid IN (SELECT qid FROM gated) THEN 'extractive' ELSE 'refused' END AS mode FROM q")
def answer_modes(spark: SparkSession, d: str) -> DataFrame:
    return answering.modes(_questions(spark, d), _mentions(spark, d), _gated(spark, d))


RECORD = rf"""{AUDIT_ROUTED}
SELECT q.qid, coalesce(a.answer, '{answering.REFUSAL}') AS answer, CASE WHEN a.qid IS NULL OR a.answer = '{answering.REFUSAL}' THEN 'refused' ELSE 'extractive' END AS mode,
  coalesce(array_to_string(regexp_extract_all(a.answer, '\[([^\[\]:]+:\d+)\]', 1), ' '), '') AS citations, coalesce(a.struck, '') AS struck, coalesce(r.routed, '') AS routed
FROM q LEFT JOIN closed a USING (qid) LEFT JOIN (SELECT qid, array_to_string(list(domain ORDER BY domain), ',') AS routed FROM routes GROUP BY qid) r USING (qid)"""


@query(RECORD)
def answer_record(spark: SparkSession, d: str) -> DataFrame:
    """The record of every question: answer, mode, citations, what the audit
    struck, and the domains that were searched."""
    from tessera.plans.pipeline import ask

    record = ask(_questions(spark, d), _index(spark, d), OPTIONS)
    cited = F.array_join(F.transform("citations", lambda c: F.concat(c["file"], F.lit(":"), c["line"].cast("string"))), " ")
    return record.select("qid", "answer", "mode", cited.alias("citations"), F.array_join("struck", " | ").alias("struck"), F.array_join("routed", ",").alias("routed"))


# ------------------------------------------------------------------ audit


@query(f"{SENTENCES} SELECT qid, pos, sentence FROM sen")
def audit_sentences(spark: SparkSession, d: str) -> DataFrame:
    return answering.sentences(_planted(spark, d)[0])


def _flag(name: str, flag: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _audited(spark, d).where(flag).select("qid", "pos", "sentence")

    run.__doc__ = f"Sentences struck because of {flag}."
    QUERIES[name], ORACLES[name] = run, f"{AUDIT} SELECT qid, pos, sentence FROM audited WHERE {flag}"


for _name, _f in (("audit_numbers", "bad_number"), ("audit_citations", "bad_citation"), ("audit_speculation", "speculation"), ("audit_uncited", "uncited")):
    _flag(_name, _f)


@query(f"{AUDIT} SELECT qid, CASE WHEN count(*) FILTER (NOT struck) > 0 THEN string_agg(sentence, '. ' ORDER BY pos) FILTER (NOT struck) || '.' ELSE '{answering.REFUSAL}' END AS answer FROM audited GROUP BY qid")
def audit_fail_closed(spark: SparkSession, d: str) -> DataFrame:
    return answering.closed(_audited(spark, d)).select("qid", "answer")


@query(f"{AUDIT} SELECT qid, array_to_string(list(sentence ORDER BY pos) FILTER (struck), ' | ') AS struck FROM audited GROUP BY qid")
def audit_struck(spark: SparkSession, d: str) -> DataFrame:
    return answering.closed(_audited(spark, d)).select("qid", F.array_join("struck", " | ").alias("struck"))


# ------------------------------------------------------------------ evaluation

OUTCOMES = f"{GATED}, {GOLD}, o AS (SELECT q.qid, q.qid IN (SELECT qid FROM gold) AS can, q.qid IN (SELECT top.qid FROM top JOIN gold USING (qid, doc_id) WHERE rk = 1) AS hit, q.qid IN (SELECT qid FROM gated) AS did FROM q), oc AS (SELECT qid, CASE WHEN can THEN 'answerable' ELSE 'unanswerable' END AS type, CASE WHEN can THEN hit AND did ELSE NOT did END AS correct FROM o)"


def _outcomes(spark, d) -> DataFrame:
    q = _questions(spark, d)
    return evaluation.outcomes(q, evaluation.gold_pairs(q, _index(spark, d)), _top(spark, d), _gated(spark, d))


@query(f"{OUTCOMES} SELECT coalesce(type, 'all') AS type, count(*) AS n, count(*) FILTER (correct) AS n_correct, round(avg(correct::INT::DOUBLE), 6) AS accuracy FROM oc GROUP BY ROLLUP (type)")
def eval_accuracy_rollup(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.accuracy(_outcomes(spark, d))


@query(f"{BM25}, {GOLD}, b AS (SELECT qid, min(rk) AS rk FROM gold LEFT JOIN top USING (qid, doc_id) GROUP BY qid) SELECT k::INT AS k, count(*) AS n, count(*) FILTER (rk <= k) AS hits, round(count(*) FILTER (rk <= k) / count(*)::DOUBLE, 6) AS recall FROM b CROSS JOIN (SELECT unnest([1, 5, 10]) AS k) GROUP BY k")
def eval_recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.recall_at(evaluation.gold_pairs(_questions(spark, d), _index(spark, d)), _top(spark, d))


@query("SELECT item_id AS qid, CASE WHEN item_id % 2 = 0 THEN 'tunable' ELSE 'heldout' END AS split FROM benchmark")
def gold_split(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.split(_questions(spark, d))


@query(f"{OUTCOMES}, base AS (SELECT qid, CASE WHEN can THEN hit ELSE false END AS correct FROM o) SELECT CASE WHEN a.correct IS NOT DISTINCT FROM b.correct THEN 'same' WHEN coalesce(b.correct, false) THEN 'better' ELSE 'worse' END AS change, count(*) AS n FROM base a FULL JOIN oc b USING (qid) GROUP BY 1")
def eval_delta(spark: SparkSession, d: str) -> DataFrame:
    """What the gate changes against answering everything."""
    q, top = _questions(spark, d), _top(spark, d)
    gold = evaluation.gold_pairs(q, _index(spark, d))
    everything = evaluation.outcomes(q, gold, top, q.select(F.col("item_id").alias("qid")))
    return evaluation.delta(everything, _outcomes(spark, d))


_PLANTED_AT = "mx AS (SELECT qid, max(pos) AS m FROM audited GROUP BY qid)"


@query(f"{AUDIT}, {_PLANTED_AT}, x AS (SELECT a.struck, a.pos > mx.m - 4 AS bad FROM audited a JOIN mx USING (qid)) SELECT count(*) FILTER (bad AND struck) AS true_positive, count(*) FILTER (NOT bad AND struck) AS false_positive, count(*) FILTER (bad AND NOT struck) AS false_negative, count(*) FILTER (NOT bad AND NOT struck) AS true_negative FROM x")
def eval_audit_confusion(spark: SparkSession, d: str) -> DataFrame:
    audited = _audited(spark, d)
    last = audited.groupBy("qid").agg(F.max("pos").alias("m"))
    planted = last.select("qid", F.explode(F.sequence(F.col("m") - 3, "m")).alias("pos"), F.lit("planted").alias("fault"))
    return evaluation.confusion(audited, planted)
