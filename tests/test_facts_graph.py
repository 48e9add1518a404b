from pyspark.sql import functions as F

from tessera.operators import chunking, facts, graph, indexing
from tessera.sources import store

CODE = """class Delay {
  int x;
};
int Filter::healthy() {
  return check(1);
}
void run(int a)
{
  if (a) { ekf.healthy(); }
  other(a);
}
// @Param: DELAY
// @DisplayName: Delay
// @Range: 0 250
// @Units: ms
// @Default: 60
"""


def files(spark):
    return spark.createDataFrame([("s", "a.cpp", "code", CODE), ("s", "empty.cpp", "code", None)], "snapshot string, path string, kind string, content string")


def test_symbols_calls_params_chunks(spark):
    symbols = facts.extract_symbols(files(spark)).cache()
    assert {(r.name, r.kind, r.line_start, r.line_end) for r in symbols.collect()} == {("Delay", "class", 1, 3), ("Filter::healthy", "function", 4, 6), ("run", "function", 7, 11)}
    calls = {(r.src, r.dst, r.line) for r in facts.extract_calls(files(spark), symbols).collect()}
    assert ("run", "Filter::healthy", 9) in calls
    p = facts.extract_params(files(spark)).collect()
    assert [(r.leaf, r.dflt, r.lo, r.hi, r.units) for r in p] == [("DELAY", "60", 0.0, 250.0, "ms")]
    chunks = {r.name: r.text for r in chunking.code_chunks(files(spark), symbols).collect()}
    assert chunks["Filter::healthy"].startswith("int Filter::healthy") and chunks["Filter::healthy"].endswith("}")


def test_qualify_leaves_out_ambiguous_groups(spark):
    leaves = spark.createDataFrame([(1, "A"), (2, "B")], "k int, leaf string")
    groups = spark.createDataFrame([(1, "G_"), (2, "H_"), (2, "I_")], "k int, grp string")
    assert [r.full_name for r in facts.qualify(leaves, groups, ["k"], "grp", "leaf").collect()] == ["G_A"]


def test_messages(spark, tmp_path):
    (tmp_path / "m.xml").write_text('<mavlink><messages><message id="7" name="HEART"><field type="uint8_t" name="a">x</field><field type="float" name="b"/></message></messages></mavlink>')
    m = facts.extract_messages(spark, f"file://{tmp_path}/m.xml").first()
    assert (m.msg_id, m.name, [(f.name, f.type) for f in m.fields]) == (7, "HEART", [("a", "uint8_t"), ("b", "float")])
    d = facts.parse_dsdl(spark.createDataFrame([("x/341.NodeStatus.uavcan", "# c\nuint32 uptime\nuint2 health # d")], "path string, content string")).first()
    assert (d.msg_id, d.name, [f.name for f in d.fields]) == (341, "NodeStatus", ["uptime", "health"])


def test_cycles_end(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    got = graph.reach(edges, spark.createDataFrame([("a",)], "node string"), 10)
    assert {(r.node, r.depth) for r in got.collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}


def test_augment_keeps_first(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert sorted(map(tuple, facts.augment(a, b, ["k"]).collect())) == [(1, "x", "first"), (2, "z", "second")]


def test_resume_twice_adds_nothing(spark):
    chunks = spark.createDataFrame([("1", "alpha beta"), ("2", None)], "chunk_id string, text string")
    done = indexing.embed(chunks, dims=16).cache()
    assert done.count() == 2 and indexing.pending(chunks, done, "chunk_id").count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.cpp").write_bytes(b"int x;\xff\n")
    (tmp_path / "gold.jsonl").write_text('{"qid":"1","question":"q","type":"t","expect":["a"]}\n')
    (tmp_path / "held.jsonl").write_text('{"qid":"2","question":"q","type":"t","expect":[]}\n')
    (tmp_path / "manifest.json").write_text('{"name":"repo","url":"u","sha":"abc"}\n')
    assert store.read_corpus(spark, f"file://{tmp_path}/src", "abc", {"*.cpp": "code"}).first().content == "int x;�\n"
    assert {r.split for r in store.read_gold(spark, f"file://{tmp_path}/gold.jsonl", f"file://{tmp_path}/held.jsonl").collect()} == {"tunable", "heldout"}
    assert store.read_manifest(spark, f"file://{tmp_path}/manifest.json").first().sha == "abc"


def test_repack_keeps_files_small(spark, tmp_path):
    spark.range(20000).withColumn("t", F.md5(F.col("id").cast("string"))).coalesce(1).write.parquet(f"file://{tmp_path}/a")
    store.repack(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/b", 200_000)
    assert max(p.stat().st_size for p in (tmp_path / "b").glob("*.parquet")) <= 200_000
    assert spark.read.parquet(f"file://{tmp_path}/b").count() == 20000


def test_build_all(spark, tmp_path):
    from tessera.plans.pipeline import build_all, build_index

    (tmp_path / "src" / "core").mkdir(parents=True)
    (tmp_path / "src" / "core" / "a.cpp").write_text(CODE)
    (tmp_path / "src" / "core" / "w.md").write_text("Title\n" + "long line " * 10 + "\nNext\nbody")
    out = f"file://{tmp_path}/out"
    build_all(spark, f"file://{tmp_path}/src", "abc", out)
    n = spark.read.parquet(f"{out}/vectors").count()
    build_index(spark, out)
    assert n >= 4 and spark.read.parquet(f"{out}/vectors").count() == n


def test_a_piece_of_a_word_is_no_mention(spark):
    names = spark.createDataFrame([("mentch",), ("Größe::wert",), ("Filter::healthy",)], "name string")
    asked = [(1, "wörmentch"), (2, "3mentch, 漢mentch"), (3, "mentchö"), (4, "ö.mentch"), (5, "größe::Wert?"), (6, "~Filter, xFilter::healthy"), (7, "(filter::HEALTHY)"), (8, "ömentch.x")]
    got = facts.mentions(spark.createDataFrame(asked, "item_id int, text string"), names).collect()
    assert sorted((r.item_id, r.name) for r in got) == [(4, "mentch"), (5, "Größe::wert"), (7, "Filter::healthy")]


def test_a_piece_behind_a_wide_digit_is_no_mention(spark):
    names = spark.createDataFrame([("mentch",), ("Filter::healthy",)], "name string")
    asked = [(1, "𝟙mentch"), (2, "𐄇mentch 𐐀mentch"), (3, "🙂mentch"), (4, "3.Filter::healthy"), (5, "𝟙Filter::healthy"), (6, "a.𝟙mentch")]
    got = facts.mentions(spark.createDataFrame(asked, "item_id int, text string"), names).collect()
    assert sorted((r.item_id, r.name) for r in got) == [(3, "mentch"), (4, "Filter::healthy")]
