"""Relational queries over the star schema and the events, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.store import table as t
from tessera.streaming.windows import events_in_utc, sessions, windowed

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with its SQL if there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 45 AND l_shipdate < TIMESTAMP '1997-01-01'")
def scan_pushdown(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").where("l_quantity > 45 and l_shipdate < timestamp_ntz '1997-01-01 00:00:00'").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("""
SELECT n_name, p_brand, count(*) AS n, sum(round(l_extendedprice * (1 - l_discount), 4)::DECIMAL(18, 4))::DOUBLE AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
GROUP BY n_name, p_brand""")
def join_star(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    o, c, n, p = (t(spark, d, x) for x in ("orders", "customer", "nation", "part"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(p, li.l_partkey == p.p_partkey)
    return j.groupBy("n_name", "p_brand").agg(F.count("*").alias("n"), F.sum(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).cast("decimal(18,4)")).cast("double").alias("revenue"))


@query("""
SELECT coalesce(a.k, b.k) AS nation, coalesce(a.customers, 0) AS customers, coalesce(b.suppliers, 0) AS suppliers
FROM (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1) a
FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal < 3000 GROUP BY 1) b ON a.k = b.k""")
def join_outer(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    b = t(spark, d, "supplier").where("s_acctbal < 3000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "nation", "full").fillna(0, ["customers", "suppliers"])


@query("""
SELECT c_custkey, 'buyer' AS kind FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)
UNION ALL SELECT c_custkey, 'idle' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def join_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    c, o = t(spark, d, "customer"), t(spark, d, "orders")
    own = c.c_custkey == o.o_custkey
    buyers = c.join(o.where("o_totalprice > 300000"), own, "left_semi").select("c_custkey", F.lit("buyer").alias("kind"))
    return buyers.unionAll(c.join(o, own, "left_anti").select("c_custkey", F.lit("idle").alias("kind")))


@query("""
WITH l AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM documents),
c AS (SELECT doc_id, ((line - 1) // 5) AS chunk, min(line) AS a, max(line) AS b FROM l GROUP BY ALL)
SELECT l.doc_id, l.line::INT AS line, c.chunk::BIGINT AS chunk FROM l JOIN c ON l.doc_id = c.doc_id AND l.line BETWEEN c.a AND c.b""")
def join_line_span(spark: SparkSession, d: str) -> DataFrame:
    """Lines met with the chunk spans that hold them: equal file, line between.
    Both sides are dealt by file and a band of 64 lines, so that a line of a
    long document meets a few spans and not all of them."""
    size, band = F.size(F.split("text", "\n")), lambda line: F.floor(line / 64)
    docs = t(spark, d, "documents").select("doc_id", size.alias("size"))
    spans = docs.select("doc_id", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / 5).cast("int"))).alias("chunk"))
    spans = spans.select("doc_id", F.col("chunk").cast("long").alias("chunk"), (F.col("chunk") * 5 + 1).alias("a"), F.least(F.col("chunk") * 5 + 5, "size").alias("b"))
    spans = spans.withColumn("band", F.explode(F.sequence(band(F.col("a")), band(F.col("b")))))
    lines = docs.select("doc_id", F.explode(F.sequence(F.lit(1), "size")).alias("line")).withColumn("band", band(F.col("line")))
    return lines.join(spans, ["doc_id", "band"]).where("line between a and b").select("doc_id", "line", "chunk")


@query("""
WITH v AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'view')
SELECT p.event_id, (SELECT max_by(v.value, (v.ts, v.event_id)) FROM v WHERE v.user_id = p.user_id AND v.ts <= p.ts) AS last_view
FROM events p WHERE p.event_type = 'purchase'""")
def join_asof(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase with its user's latest view so far: one shuffle by user, a
    running last value, no pairs."""
    e = t(spark, d, "events").where("event_type in ('view', 'purchase')")
    w = Window.partitionBy("user_id").orderBy("ts", F.when(F.col("event_type") == "view", 0).otherwise(1), "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("last_view", F.last(F.when(F.col("event_type") == "view", F.col("value")), ignorenulls=True).over(w))
    return e.where("event_type = 'purchase'").select("event_id", "last_view")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, round(avg(l_extendedprice), 4) AS price, min(l_discount) AS low, max(l_tax) AS high, count(DISTINCT l_partkey) AS parts
FROM lineitem GROUP BY ALL""")
def agg_basic(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.round(F.avg("l_extendedprice"), 4).alias("price"), F.min("l_discount").alias("low"), F.max("l_tax").alias("high"), F.countDistinct("l_partkey").alias("parts")
    )


@query("SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus, o_orderpriority)::BIGINT AS level, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders, true AS parts_near, true AS orders_near, true AS median_near FROM lineitem GROUP BY 1")
def agg_approx(spark: SparkSession, d: str) -> DataFrame:
    """Mergeable sketches beside the exact values: whether approximate distinct
    counts are within 15 % and an approximate median is within 1 % of ranks."""
    li = t(spark, d, "lineitem")
    some = li.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"), F.approx_count_distinct("l_partkey").alias("p"),
        F.hll_sketch_estimate(F.hll_sketch_agg("l_orderkey")).alias("o"), F.percentile_approx("l_extendedprice", 0.5).alias("m"), F.count("*").alias("n"),
    )
    below = li.join(F.broadcast(some.select("l_returnflag", "m")), "l_returnflag").groupBy("l_returnflag").agg(F.count_if(F.col("l_extendedprice") <= F.col("m")).alias("rank"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.15 * F.col(b)
    return some.join(below, "l_returnflag").select("l_returnflag", "parts", "orders", near("p", "parts").alias("parts_near"), near("o", "orders").alias("orders_near"), (F.abs(F.col("rank") / F.col("n") - 0.5) <= 0.01).alias("median_near"))


@query("""
SELECT * FROM (SELECT o_orderkey, o_custkey, (row_number() OVER w)::INT AS rn, (rank() OVER w)::INT AS rk, (dense_rank() OVER w)::INT AS dr FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) WHERE rn <= 3""")
def win_rank(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", F.row_number().over(w).alias("rn"), F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr")).where("rn <= 3")


@query("""
SELECT event_id, lag(value) OVER w AS before, lead(value) OVER w AS after, round(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS mean3,
  count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS day
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_frame(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t(spark, d, "events").select(
        "event_id", F.lag("value").over(w).alias("before"), F.lead("value").over(w).alias("after"), F.round(F.avg("value").over(w.rowsBetween(-2, 0)), 6).alias("mean3"),
        F.expr("count(*) over (partition by user_id order by ts range between interval 1 day preceding and current row)").alias("day"),
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topk_global(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("""
SELECT k, 'both' AS kind FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT k, 'customers' FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT k, 'any' FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def setops(spark: SparkSession, d: str) -> DataFrame:
    c, s = t(spark, d, "customer").select(F.col("c_nationkey").alias("k")), t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    kinds = (("both", c.intersect(s)), ("customers", c.exceptAll(s)), ("any", c.union(s).distinct()))
    parts = [x.select("k", F.lit(n).alias("kind")) for n, x in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TYPES = ["click", "login", "logout", "purchase", "view"]


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{x}') AS {x}" for x in _TYPES) + " FROM events GROUP BY user_id")
def pivot_events(spark: SparkSession, d: str) -> DataFrame:
    """The event types are listed, so no extra pass looks for them."""
    return t(spark, d, "events").groupBy("user_id").pivot("event_type", _TYPES).agg(F.count("event_id")).fillna(0)


@query("""
SELECT p_partkey, upper(p_name) AS up, left(p_name, 3) AS head, length(p_name)::INT AS size, replace(p_type, ' ', '_') AS kind, lpad(p_partkey::VARCHAR, 8, '0') AS code,
  regexp_extract(p_brand, '([0-9]+)', 1) AS number, concat_ws('/', p_brand, p_type) AS path, levenshtein(p_name, p_type)::INT AS far FROM part""")
def fn_string(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.left("p_name", F.lit(3)).alias("head"), F.length("p_name").alias("size"), F.replace("p_type", F.lit(" "), F.lit("_")).alias("kind"), F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("code"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("number"), F.concat_ws("/", "p_brand", "p_type").alias("path"), F.levenshtein("p_name", "p_type").alias("far"),
    )


@query("""
SELECT o_orderkey, date_trunc('month', o_orderdate)::TIMESTAMP AS month, year(o_orderdate)::INT AS y, quarter(o_orderdate)::INT AS q, dayofyear(o_orderdate)::INT AS doy,
  date_diff('day', DATE '1992-01-01', o_orderdate::DATE)::INT AS days, (o_orderdate::DATE + 30)::DATE::VARCHAR AS due, last_day(o_orderdate::DATE)::DATE::VARCHAR AS month_end FROM orders""")
def fn_date(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t(spark, d, "orders").select(
        "o_orderkey", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"), F.year(day).alias("y"), F.quarter(day).alias("q"), F.dayofyear(day).alias("doy"),
        F.datediff(day, F.lit("1992-01-01").cast("date")).alias("days"), F.date_add(day, 30).cast("string").alias("due"), F.last_day(day).cast("string").alias("month_end"),
    )


@query("""
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS lg, round(sqrt(l_quantity), 6) AS root, floor(l_extendedprice)::BIGINT AS lo, ceil(l_extendedprice)::BIGINT AS hi,
  round(power(l_discount, 2), 8) AS sq, (l_orderkey % 7)::BIGINT AS m, sign(l_tax - 0.04)::DOUBLE AS s, greatest(l_discount, l_tax) AS most FROM lineitem""")
def fn_math(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.ln("l_extendedprice"), 6).alias("lg"), F.round(F.sqrt("l_quantity"), 6).alias("root"), F.floor("l_extendedprice").alias("lo"), F.ceil("l_extendedprice").alias("hi"),
        F.round(F.pow("l_discount", F.lit(2)), 8).alias("sq"), (F.col("l_orderkey") % 7).alias("m"), F.signum(F.col("l_tax") - 0.04).alias("s"), F.greatest("l_discount", "l_tax").alias("most"),
    )


@query("""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)), 6) AS norm2, len(list_filter(embedding, lambda x: x > 0))::INT AS positive,
  round(list_max(embedding)::DOUBLE, 6) AS top, list_position(embedding, list_max(embedding))::BIGINT AS at, len(embedding)::INT AS dims FROM embeddings""")
def fn_array(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding")
    return t(spark, d, "embeddings").select(
        "vec_id", F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")), 6).alias("norm2"), F.size(F.filter(v, lambda x: x > 0)).alias("positive"),
        F.round(F.array_max(v).cast("double"), 6).alias("top"), F.array_position(v, F.array_max(v)).alias("at"), F.size(v).alias("dims"),
    )


@query("SELECT p_partkey, p_retailprice FROM part p WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)")
def subquery_corr(spark: SparkSession, d: str) -> DataFrame:
    """The correlated average becomes one aggregate and a join."""
    p = t(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    mean = p.groupBy("p_brand").agg(F.avg("p_retailprice").alias("mean"))
    return p.join(mean, "p_brand").where("p_retailprice > mean").select("p_partkey", "p_retailprice")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def win_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return windowed(events_in_utc(t(spark, d, "events")), "1 day").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""
SELECT w AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM (SELECT *, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS w FROM events) GROUP BY ALL""")
def win_sliding(spark: SparkSession, d: str) -> DataFrame:
    return windowed(events_in_utc(t(spark, d, "events")), "1 day", "12 hours").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""
WITH a AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM a)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM b GROUP BY user_id, s""")
def win_session(spark: SparkSession, d: str) -> DataFrame:
    out = sessions(events_in_utc(t(spark, d, "events")), "6 hours")
    return out.withColumn("session_start", F.col("session_start").cast("timestamp_ntz")).withColumn("session_end", F.col("session_end").cast("timestamp_ntz"))
