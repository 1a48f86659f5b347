import hashlib
from collections import defaultdict

import pytest

from ledgerflow.llm.content_sort import content_groups, drop_copies
from ledgerflow.llm.minhash import drop_near_duplicates

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HEAD = "same first bytes in every one of these texts "
ROWS = ([(i, HEAD + "hot") for i in range(400)] + [(1000 + i, HEAD + str(i % 90)) for i in range(300)]
        + [(2000, "Ä"), (2001, "ä"), (2002, "AbC"), (2003, "aBc"), (2004, None), (2005, ""), (2006, "x" * 300_000),
           (2007, "X" * 300_000), (2008, " "), (2010, "twice"), (2010, "twice"), (None, "aBC"), (None, "z"), (None, "z")])


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOW)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        left = 1
        for i in ids:
            kept = i == best and left == 1
            left -= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_equal_brute_force(frame, keep):
    got = content_groups(frame(ROWS, "doc_id long, text string", 5), keep=keep)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS, keep)


def test_hot_text_over_many_range_partitions(spark, frame):
    rows = [(i, "hot") for i in range(3000)] + [(5000 + i, f"cold {i}") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in content_groups(frame(rows, "doc_id long, text string", 7)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(got[i].keep_id == 0 and got[i].group_size == 3000 for i in range(3000))
    assert [i for i, r in got.items() if r.kept and i < 5000] == [0]
    assert all(r.kept and r.group_size == 1 for i, r in got.items() if i >= 5000)


def test_drop_copies_keeps_columns_and_one_row(frame):
    rows = [(i, t, "k", i) for i, t in ROWS]
    schema = "doc_id long, text string, head string, hash long"
    df = frame(rows, schema)
    got = drop_copies(df)
    assert got.schema == df.schema
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    want = sorted(((r[0], r[4]) for r in brute(ROWS, "smallest") if r[3]), key=repr)
    assert [(i, hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()) for i, t in kept] == want


def test_empty_table_and_bad_option(frame):
    empty = frame([], "doc_id long, text string")
    assert content_groups(empty).collect() == [] and drop_copies(empty).collect() == []
    with pytest.raises(ValueError):
        content_groups(empty, keep="any")


def test_columns_named_like_helpers_stay(frame):
    df = frame([(1, "A", "k", 5, 6, "i"), (2, "a", "l", 7, 8, "j"), (3, "b", "m", 9, 10, "o")],
               "doc_id long, text string, __key string, __n long, __set long, __id string")
    for drop in (drop_copies, lambda d: drop_near_duplicates(d)):
        assert sorted(map(tuple, drop(df).collect())) == [(1, "A", "k", 5, 6, "i"), (3, "b", "m", 9, 10, "o")]
