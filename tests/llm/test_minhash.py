import random
from collections import Counter

import pytest

from ledgerflow.llm import minhash
from ledgerflow.llm.minhash import drop_near_duplicates, near_duplicates

RND = random.Random(4)
VOCAB = [f"w{i}" for i in range(3000)]


def text(n):
    return [RND.choice(VOCAB) for _ in range(n)]


def changed(words, share):
    return [RND.choice(VOCAB) if RND.random() < share else w for w in words]


def rows():
    out, i = [], 0
    base = text(120)
    for _ in range(120):                                   # a large group of near copies around the threshold
        out.append((i := i + 1, " ".join(changed(base, RND.choice([0.005, 0.015, 0.03])))))
    for _ in range(25):
        one = text(RND.randint(1, 90))
        for _ in range(RND.randint(1, 5)):
            out.append((i := i + 1, " ".join(changed(one, RND.choice([0, 0.01, 0.02, 0.05])))))
    passage = text(40)
    out += [(i := i + 1, " ".join(text(25) + passage)) for _ in range(20)]
    out += [(i := i + 1, "The  Same\tthree") for _ in range(30)] + [(9001, None), (9002, ""), (9003, " \n"), (9004, "one"), (9005, "ONE"),
            (9006, "a b c d"), (9007, "a b c"), (9008, "É x"), (9009, "é x"), (9010, " ".join(base * 300)), (9010, "one"), (None, "one")]
    return out


def brute(data, width):
    sets = []
    for _, t in data:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(max(len(w) - width + 1, 1))) if w else frozenset())
    group = list(range(len(data)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return Counter((i, len(s), low.get(find(k)) if s else i, i is not None and i == (low.get(find(k)) if s else i))
                   for k, ((i, _), s) in enumerate(zip(data, sets)))


@pytest.mark.parametrize("width", [4])
def test_components_equal_brute_force(frame, width):
    data = [r for r in rows() if r[0] != 9010]
    df = frame([(i, t, 1, "k") for i, t in data], "doc_id long, text string, x int, rep string")
    assert Counter(map(tuple, near_duplicates(df, width).collect())) == brute(data, width)


def test_one_row_of_each_group_stays(frame):
    data = [(1, "a b c d e f g h", "x"), (2, "A b c d e f g  h", "y"), (3, "z", "x"), (None, "z", "n"), (4, None, "q"), (5, "", "q")]
    df = frame(data, "doc_id long, text string, y string")
    left = drop_near_duplicates(df)
    assert left.schema == df.schema and {r.doc_id for r in left.collect()} == {1, 3, None, 4, 5}
    empty = df.limit(0)
    assert near_duplicates(empty).collect() == [] and drop_near_duplicates(empty).collect() == []


def test_rows_of_one_id_with_different_texts(frame):
    data = rows() + [(9010, "a b c d"), (8000, "p q r s"), (8000, "t u v w x y"), (8001, "p q r s"), (8001, "P  q r s"), (7999, "t u v w x y")]
    df = frame([(i, t) for i, t in data], "doc_id long, text string")
    got = Counter(map(tuple, near_duplicates(df, 4).collect()))
    assert got == brute(data, 4) and sum(got.values()) == len(data)


def test_a_clean_row_stays_where_its_id_also_names_a_copy(frame):
    data = [(1, "a b c d e f"), (2, "A b c d e f"), (2, "quite another text than that"), (3, "quite another text than  that"), (4, "z")]
    left = drop_near_duplicates(frame(data, "doc_id long, text string"))
    assert sorted(map(tuple, left.collect())) == [(1, "a b c d e f"), (2, "quite another text than that"), (4, "z")]


def test_pairs_do_not_grow_with_the_square_of_a_group(frame, monkeypatch):
    """Half of a group of near copies links with its base, the other half differs a little too much."""
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    data = []
    for i in range(160):
        words = list(base)
        for k in rnd.sample(range(5, 145), 2 if i % 2 else 5):
            words[k] = f"own{i}-{k}"
        data.append((i, " ".join(words)))
    data.append((500, data[0][1] + " tail"))      # links with an outsider only
    made, real = [], minhash.stored

    def counted(df, name):
        got = real(df, name)
        if name == "minhash-pairs":
            made.append(got.count())
        return got
    monkeypatch.setattr(minhash, "stored", counted)
    got = Counter(map(tuple, near_duplicates(frame(data, "doc_id long, text string"), 4).collect()))
    assert got == brute(data, 4) and len({r[2] for r in got}) > 20
    assert made[-1] <= len(data), made
