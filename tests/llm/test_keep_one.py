from voxloom.llm import simhash

from .conftest import order

RED, ONE = "red blue green grey black white", "one two three four five six"


def test_unrelated_components_of_one_id_each_keep_a_row(spark):
    """Several null ids, and one id on two unlike texts that is the smallest of both their components."""
    rows = [(None, "a b c d e f"), (None, "g h i j k l"), (None, "m n o p q r"), (1, ONE), (1, RED), (2, ONE), (3, RED), (3, RED)]
    out = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order(out.collect()) == order(rows[:5])
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert order((x.doc_id, x.component_id) for x in found) == order([(None, None)] * 3 + [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1)])
