"""op2: what an item is when ids are null or stand for several texts."""

import random

from tidemark.llm import decontam


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(f"t{r.randrange(500)}" for _ in range(n))


def test_texts_under_one_id_are_sought_apart(spark, docs):
    one, two, none = prose(1, 30), prose(2, 30), prose(3, 20)
    items = spark.createDataFrame([(1, one), (1, two), (1, one), (None, none), (None, None), (2, two)], "item_id bigint, text string")
    rows = [(10, f"{prose(4, 50)} {one}"), (11, f"{two} {prose(5, 50)}"), (12, f"{one} {two}"), (13, f"{prose(6, 9)} {none}"), (14, prose(7, 60))]
    for size in (decontam.INDEX_BYTES, 1024):
        found = {r.doc_id: [(h.item_id, h.item_shingles, h.shared) for h in r.held] for r in decontam.search(docs(rows), items, ["doc_id"], index_bytes=size).collect()}
        assert found == {10: [(1, 26, 26)], 11: [(1, 26, 26), (2, 26, 26)], 12: [(1, 26, 26), (1, 26, 26), (2, 26, 26)], 13: [(None, 16, 16)], 14: []}
    got = {r.doc_id: (r.contaminated, r.n_items, r["items"]) for r in decontam.contaminated(docs(rows), items).collect()}
    assert got == {10: (True, 1, [1]), 11: (True, 2, [1, 2]), 12: (True, 2, [1, 2]), 13: (True, 1, [None]), 14: (False, 0, [])}
    assert [r.doc_id for r in decontam.clean(docs(rows), items).collect()] == [14]


def test_signatures_leave_few_candidates(spark, docs):
    items = spark.createDataFrame([(k, prose(k, 25 + k)) for k in range(40)], "item_id bigint, text string")
    texts = {k: prose(k, 25 + k).split() for k in range(40)}
    rows = [(k, f"{prose(500 + k, 80)} {' '.join(texts[k])} {prose(600 + k, 80)}") for k in range(10)]
    # half an item: below the threshold, and met only where its part holds a hash of the signature
    rows += [(100 + k, f"{prose(700 + k, 80)} {' '.join(texts[k][: len(texts[k]) // 2])}") for k in range(40)] + [(200 + k, prose(800 + k, 100)) for k in range(50)]
    x = decontam.funnel(docs(rows), items).first()
    assert (x.documents, x["items"], x.leaks) == (100, 40, 10) and 10 <= x.candidates <= 50
    sized = decontam.signatures(items).groupBy("item").agg({"size": "max", "in_signature": "max"}).collect()
    assert len(sized) == 40
    for r in decontam.signatures(items).groupBy("item", "size").pivot("in_signature", [True]).count().collect():
        assert r.size - r["true"] < 0.8 * r.size <= r.size  # what reaches the threshold has a hash of the signature
