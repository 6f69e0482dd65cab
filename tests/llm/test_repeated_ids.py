"""N-gram join: rows that repeat a doc_id with other texts are one document."""

from corpusmill.llm.ngram_join import jaccard_components


def _words(name, n=30):
    return " ".join(f"{name}{i}" for i in range(n))


def test_repeated_ids_join_their_classes(spark):
    a, b, c = _words("a"), _words("b"), _words("c")
    rows = [(3, a), (5, a), (5, b), (7, b), (8, c), (9, c), (9, c), (1, ""), (1, None)]
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (1, 1), (3, 3), (5, 3), (5, 3), (7, 3), (8, 8), (9, 8), (9, 8)]


def test_a_repeated_id_joins_classes_of_smaller_ids(spark):
    a, b = _words("a"), _words("b")
    rows = [(3, a), (4, b), (5, a), (5, b)]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(3, 3), (4, 3), (5, 3)}
