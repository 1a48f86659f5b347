import hashlib
import random
import re

import pytest

from ledgerflow.llm.decontam import remove_documents, remove_spans, report

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            k = min(10, len(iw))
            for a in range(len(iw) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == iw[a:a + k]:
                        hit.update(range(p, p + k))
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


RND = random.Random(2)
VOCAB = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "été", "日本"]
ITEMS = [(i, " ".join(RND.choice(VOCAB) for _ in range(n))) for i, n in enumerate([25, 14, 10, 9, 3, 30, 1])] + \
    [(20, "unique"), (21, ""), (22, None), (23, "... --"), (24, ITEM := "the same words " * 4), (25, ITEM), (None, "nobody")]
DOCS = [(i, " ".join(RND.choice(VOCAB[:20]) for _ in range(RND.randint(0, 60)))) for i in range(40)]
DOCS += [(100, "Intro: " + ITEMS[0][1].upper().replace(" ", " -- ") + " end."), (101, ITEMS[1][1] * 2), (102, None), (103, ""),
         (104, "!?"), (105, (ITEMS[5][1] + " ") * 400), (105, "again " + ITEM), (None, ITEMS[2][1]), (106, "not Unique?"),
         (107, ITEMS[0][1][5:] + "\n" + ITEMS[5][1])]


@pytest.mark.parametrize("max_set", [50_000, 3])
def test_report_equals_brute_force(frame, max_set):
    docs, items = frame(DOCS, "doc_id long, text string"), frame(ITEMS, "item_id long, text string")
    got = report(docs, items, max_set=max_set).collect()
    assert sorted(map(tuple, got), key=repr) == brute(DOCS, [x for x in ITEMS if x[0] is not None])


def test_documents_and_spans_removed(frame):
    schema = "doc_id long, text string, k int, pos string"
    docs = frame([(i, t, 1, "x") for i, t in DOCS], schema)
    items = frame([(i, t) for i, t in ITEMS if t is None or len(t) > 40], "item_id long, text string")
    hit = {(r[0], r[1]) for r in brute(DOCS, [x for x in ITEMS if x[1] and len(x[1]) > 40]) if r[5]}
    left = remove_documents(docs, items)
    assert left.schema == docs.schema
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == sorted(
        (i or -1, t or "") for i, t in DOCS if (i, len(words(t))) not in hit)
    cut = remove_spans(docs, items)
    by = {r.doc_id: r.text for r in cut.collect() if r.doc_id not in (105, None)}
    assert cut.schema == docs.schema and by[100] == "Intro: end." and by[102] is None and by[104] == "!?"
    assert not any(r.contaminated for r in report(cut, items).collect())


def test_empty_tables(frame):
    docs, none = frame(DOCS, "doc_id long, text string"), frame([], "item_id long, text string")
    assert not any(r.contaminated for r in report(docs, none).collect())
    assert remove_documents(docs, none).count() == len(DOCS)
    assert report(docs.limit(0), frame(ITEMS, "item_id long, text string")).collect() == []
