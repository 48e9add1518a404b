import __spark_entry__


def test_every_line_meets_its_span(spark, tmp_path):
    texts = ["one line", "\n".join(map(str, range(23))), "", "a\nb\n"]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    found = __spark_entry__.queries()["join_line_span"](spark, folder).collect()
    want = [(i, n, (n - 1) // 5) for i, text in enumerate(texts) for n in range(1, text.count("\n") + 2)]
    assert sorted(map(tuple, found)) == want
