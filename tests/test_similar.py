from caseloom.operators import duplicates
from caseloom.plans import catalogue


def _greedy(prints):
    """The plain loop over documents in order: (seed, doc_id)."""

    def similar(a, b):
        if a["page_count"] != b["page_count"]:
            return False
        if a["text_hash"] and a["text_hash"] == b["text_hash"]:
            return True
        return bool(a["size"] and b["size"]) and min(a["size"], b["size"]) / max(a["size"], b["size"]) > 0.9

    rows, taken, out = sorted(prints, key=lambda r: r["doc_id"]), set(), []
    for i, a in enumerate(rows):
        if a["doc_id"] not in taken:
            group = [b["doc_id"] for b in rows[i + 1 :] if b["doc_id"] not in taken and similar(a, b)]
            taken.update(group)
            out += [(a["doc_id"], x) for x in [a["doc_id"], *group] if group]
    return sorted(out)


def test_groups_of_the_table(spark, sf):
    want = _greedy(catalogue._prints(spark, sf).collect())
    assert sorted(map(tuple, catalogue.near_dup_groups(spark, sf).collect())) == want


def test_groups_by_size_and_hash(spark):
    rows = [(1, 1, 1000, "a"), (2, 1, 950, "b"), (3, 1, 880, "a"), (4, 1, 500, "b"), (5, 1, 900, None), (6, 1, 870, "c"), (7, 1, 0, None), (8, 1, 0, None), (9, 1, None, "d")]
    rows += [(10, 1, 0, "d"), (11, 1, 40, "e"), (12, 1, 44, None), (13, 2, 1000, "a"), (14, 2, 901, "z"), (15, 2, 900, "z"), (16, None, 900, "z"), (17, 1, 300, "f"), (18, 1, 300, "f"), (19, 1, 460, "q")]
    prints = spark.createDataFrame(rows, "doc_id long, page_count long, size long, text_hash string")
    want = _greedy([r.asDict() for r in prints.where("page_count IS NOT NULL").collect()])
    assert sorted(map(tuple, duplicates.similar_groups(prints).collect())) == want
