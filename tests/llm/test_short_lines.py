from voxloom.llm import lines, queries

LINES = ["theand thble reingwh thorin", "日本語の文章には空白がないので単語数では測れません", "les rech", "a", "== - =="]


def test_equal_lines_of_any_length_are_one(spark, tmp_path):
    """Lines repeat whatever their length, but for those without a letter or digit."""
    spark.createDataFrame([(i, "\n".join(LINES)) for i in range(3)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {x.doc_id: x.n_removed for x in queries.op3_lines(spark, str(tmp_path)).collect()} == {0: 0, 1: 4, 2: 4}


def test_least_words_and_characters_bound_the_fuzzy_step_alone(spark):
    rows = [(0, "one little line of words\nfour"), (1, "one little lime of words\nfour")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = lambda **o: [x.n_removed for x in lines.dedup_lines(docs, **o).orderBy("doc_id").collect()]
    assert removed() == [0, 2] and removed(min_words=6) == [0, 1] and removed(min_chars=40) == [0, 1]
