import random

import corpus_pipeline
from tessera.llm import quality, simhash


def documents(spark):
    clean = [(i, " ".join(random.Random(i).choices([f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)], k=60)) + ".", "en", f"s{i % 3}", 1) for i in range(60)]
    copies = [(100 + i, clean[i][1], "en", "s0", 1) for i in range(5)]
    odd = [(200, None, "en", "s1", 1), (201, "12 34", None, None, None), (None, "some words that stand alone here", "en", "s1", 1), (None, "other words that nobody else has", "en", "s1", 1), (203, clean[7][1], "en", "s2", 1), (203, clean[7][1], "en", "s2", 1)]
    return spark.createDataFrame(clean + copies + odd, "doc_id long, text string, lang string, source string, n_chars long")


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.select("doc_id", "text").collect())


def test_stages(spark, tmp_path):
    labels = spark.createDataFrame([(i, int(i % 7 > 0)) for i in range(60)], "doc_id long, quality int")
    folder = f"file://{tmp_path}"
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = documents(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mix", "pack"]
    spoken = corpus_pipeline.identify_language(spark, docs, folder)
    assert spoken.columns == docs.columns and len(ids(docs)) - len(ids(spoken)) == 2  # null and without a letter
    good = corpus_pipeline.classify_quality(spark, spoken, folder)
    model = quality.fit(spoken, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0"))
    assert ids(good) == [r for r in ids(spoken) if quality.score_texts([r[2]], model)[0][0] >= quality.THRESHOLD]
    kept = corpus_pipeline.drop_near_duplicates(spark, spoken, folder)
    rows = ids(spoken)
    want, seen = [], []
    for r in rows:  # in order of ids, null last
        fp = simhash.fingerprint(r[2])
        if not any(bin(fp ^ s).count("1") <= 3 for s in seen):
            want.append(r)
        seen.append(fp)
    assert ids(kept) == want and kept.columns == docs.columns
    mixed = corpus_pipeline.mix_sources(spark, kept, folder)
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(want) and mixed.count() > kept.count()
    packed = corpus_pipeline.pack_sequences(spark, mixed, folder)
    assert packed.where("start = 0").count() == mixed.count()


def test_sequences_follow_the_curriculum(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = f"file://{tmp_path}/mixed"
    corpus_pipeline.mix_sources(spark, docs, "").write.parquet(path)
    packed = corpus_pipeline.pack_sequences(spark, spark.read.parquet(path), "").join(docs.select("doc_id", "source").distinct(), "doc_id").toPandas()
    filled = packed.groupby("sequence_id").length.sum()
    assert ((filled == 4096) | (filled & (filled - 1) == 0)).all()
    total = packed.length.sum()
    done = (filled.cumsum() - filled / 2) / total  # when each sequence is trained on
    packed["time"] = packed.sequence_id.map(done) * packed.length
    place = {s: k % 3 for k, s in enumerate(sorted(packed.source.unique()))}  # schedules: level, rising, falling
    by = packed.groupby(packed.source.map(place))[["time", "length"]].sum()
    mean = (by.time / by.length).to_dict()
    # A weight that rises from 0.5 to 1.5 has its mean at 7/12, one that falls at 5/12.
    assert mean[1] - mean[0] > 0.02 and mean[0] - mean[2] > 0.02 and mean[1] - mean[2] > 0.1, mean


def test_ordered_runs_are_bounded_and_ascend(spark, tmp_path):
    from tessera.llm import packing

    rows = [(i, " ".join(["word"] * (5000 if i == 3 else 40)), 0, i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f long, r long").coalesce(1)
    got = packing.pack(docs, capacity=64, shard_bytes=1600, order=("f", "r")).toPandas()
    run = got.groupby(got.sequence_id.map(lambda x: x >> packing.LOCAL_BITS))
    assert got.length.sum() == sum(len(t.split()) + 1 for _, t, _, _ in rows)
    assert got.groupby("sequence_id").length.sum().max() <= 64
    first = run.doc_id.min().sort_index()
    assert first.is_monotonic_increasing and len(first) > 5


def test_documents_without_an_order_are_packed(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")  # not one numbered file each
    few = docs.where("doc_id < 20")
    twice = spark.read.parquet(f"{sf}/documents.parquet", f"{sf}/documents.parquet")
    for frame in (docs, few, twice, docs.select("doc_id", "text")):
        packed = corpus_pipeline.pack_sequences(spark, frame, "")
        assert packed.where("start = 0").count() == frame.count()
    few.repartition(3).write.parquet(f"file://{tmp_path}/few")
    for frame in (spark.read.parquet(f"file://{tmp_path}/few"), spark.read.parquet(f"file://{tmp_path}/few").where("doc_id > 3").select("doc_id", "text")):
        packed = corpus_pipeline.pack_sequences(spark, frame, "")
        assert packed.where("start = 0").count() == frame.count()


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"file://{tmp_path}/labels.parquet")
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, f"file://{tmp_path}")
        assert docs.count() == 0
