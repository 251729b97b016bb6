"""The automaton against plain search."""

import random

from folioloom.operators import containment as A

RNG = random.Random(6)
ANCHORS = sorted({"".join(RNG.choices("abc", k=RNG.randint(1, 6))) for _ in range(60)} | {"aaaa", "é😀", "abcabcabd"})
TEXTS = ["".join(RNG.choices("abcd", k=RNG.randint(0, 200))) for _ in range(60)] + ["", "xé😀x", "abcabcabcabd", "a" * 50]


def test_automaton_finds_all():
    automaton = A.Automaton(ANCHORS)
    for t in TEXTS:
        assert {ANCHORS[k] for k in automaton.held(t)} == {a for a in ANCHORS if a in t}
    assert A.Automaton([]).held("abc") == set()


def test_tables_in_one_block_and_in_many(spark):
    texts = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)] + [(999, None), (0, TEXTS[0])], "doc_id bigint, body string")
    named = [(f"k{k}", a) for k, a in enumerate(ANCHORS)] + [("again", ANCHORS[0]), ("none", None), ("empty", "")]
    anchors = spark.createDataFrame(named, "name string, words string")
    want = sorted((n, k) for n, a in named if a for k, t in [*enumerate(TEXTS), (0, TEXTS[0])] if a in t)
    for block in (A.BLOCK_LETTERS, 100):
        assert sorted(tuple(r) for r in A.containment(texts, anchors, "name", "words", "doc_id", "body", block).collect()) == want
    assert A.containment(texts, anchors.limit(0), "name", "words", "doc_id", "body").count() == 0


def test_numbering_review(spark):
    texts = spark.createDataFrame([("a", "Q14. what (A) one"), ("b", None), ("c", "x")], "doc string, text string")
    checks = [("a", 1, "Q1", "Q14", ["(A)", "(B)", None]), ("a", 2, "", "Q2", None), ("b", 1, "x", None, []), ("z", 1, "x", "", None)]
    got = A.numbering_review(spark.createDataFrame(checks, "doc string, check_no int, anchor string, label string, options array<string>"), texts)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 1, "option_absent", "(B)"), ("a", 2, "anchor_absent", ""), ("a", 2, "label_absent", "Q2"), ("b", 1, "anchor_absent", "x"), ("z", 1, "anchor_absent", "x"), ("c", None, "review_missing", "")], key=str
    )
