"""Every query with SQL against DuckDB; the others must run."""

import os

import pytest

import __spark_entry__
from oracle import duck, rows

NAMES = sorted(n for n in __spark_entry__.queries() if n != "pipeline" and not (n.startswith("op") and n[2].isdigit()))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, name):
    found = __spark_entry__.queries()[name](spark, sf).toPandas()
    sql = __spark_entry__.oracle_sql().get(name)
    if sql:
        want = duck(sql, sf)
        assert sorted(found.columns) == sorted(want.columns)
        assert rows(found) == rows(want)
    else:
        assert len(found)


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def agrees_on_pieces(spark, sf, folder, name):
    """The query and its SQL agree where a question only ends like a document's
    first word, behind a letter that is not ASCII or a digit."""
    for t in os.listdir(sf):
        if t not in ("documents.parquet", "benchmark.parquet"):
            os.symlink(f"{sf}/{t}", folder / t)
    docs = [(1, "mentch alpha beta"), (2, "strand gamma delta")]
    asked = [(1, "wörmentch"), (2, "3mentch zeta"), (3, "Who saw a mentch?"), (4, "gamma strandö"), (5, None)]
    spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(asked, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = __spark_entry__.queries()[name](spark, str(folder)).toPandas()
    assert rows(found) == rows(duck(__spark_entry__.oracle_sql()[name], str(folder)))
    return found


def test_a_piece_of_a_word_is_not_answered_directly(spark, sf, tmp_path):
    found = agrees_on_pieces(spark, sf, tmp_path, "direct_vs_retrieve_split")
    assert found.set_index("item_id")["path"].to_dict() == {3: "direct"} | dict.fromkeys((1, 2, 4, 5), "retrieve")


def test_a_piece_of_a_word_gives_no_direct_mode(spark, sf, tmp_path):
    found = agrees_on_pieces(spark, sf, tmp_path, "answer_modes")
    assert found.set_index("qid")["mode"].to_dict() == {3: "direct"} | dict.fromkeys((1, 2, 4, 5), "refused")


def agrees_on(spark, sf, folder, name, docs, asked):
    """The query's rows, equal to its SQL's, over these texts."""
    for t in os.listdir(sf):
        if t not in ("documents.parquet", "benchmark.parquet"):
            os.symlink(f"{sf}/{t}", folder / t)
    spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(asked, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = __spark_entry__.queries()[name](spark, str(folder)).toPandas()
    assert rows(found) == rows(duck(__spark_entry__.oracle_sql()[name], str(folder)))
    return found


def test_a_piece_behind_a_wide_digit_is_not_answered_directly(spark, sf, tmp_path):
    docs = [(1, "mentch alpha beta"), (2, "gamma delta")]
    asked = [(1, "\U0001d7d9mentch"), (2, "\U00010107mentch"), (3, "x.\U0001f100mentch"), (4, "\U0001f642mentch")]
    found = agrees_on(spark, sf, tmp_path, "direct_vs_retrieve_split", docs, asked)
    assert found.set_index("item_id")["path"].to_dict() == {1: "retrieve", 2: "retrieve", 3: "retrieve", 4: "direct"}


def test_modes_fold_case_letter_by_letter(spark, sf, tmp_path):
    docs = [(1, "ΟΔΥΣΣΕΥΣ alpha"), (2, "İstanbul beta"), (3, "gamma İZMİR")]
    asked = [(1, "ΟΔΥΣΣΕΥΣ'x"), (2, "οδυσσευς"), (3, "οδυσσευσ"), (4, "istanbul"), (5, "i̇stanbul"), (6, "İzmir gamma"), (7, "i̇zmi̇r")]
    found = agrees_on(spark, sf, tmp_path, "answer_modes", docs, asked)
    assert found.set_index("qid")["mode"].to_dict() == {1: "direct", 2: "refused", 3: "direct", 4: "direct", 5: "refused", 6: "extractive", 7: "refused"}


def test_a_document_without_an_id_gives_no_extractive_mode(spark, sf, tmp_path):
    docs = [(1, "abc delta"), (None, "xyz epsilon"), (None, "mentch zeta")]
    found = agrees_on(spark, sf, tmp_path, "answer_modes", docs, [(1, "delta"), (2, "epsilon"), (3, "mentch"), (4, "delta epsilon")])
    assert found.set_index("qid")["mode"].to_dict() == {1: "extractive", 2: "refused", 3: "direct", 4: "refused"}
