import itertools
import random
import tracemalloc

import numpy as np

from ledgerflow.llm.crf_quality import LineField, _forward_backward, fit, line_features, score_column

GOOD = "The river runs past the old mill, and the road follows it. Nobody came today."
BAD = "BUY!! NOW!! ### $$$ CLICK!! HERE!! *** %%%"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    node, moves, starts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5, 9])
    good, log_z, expected = _forward_backward(node, starts, moves)
    want_moves = np.zeros((2, 2))
    for c, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        total, each, steps = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            p = np.exp(sum(node[a + t] * y[t] for t in range(b - a)) + sum(moves[y[t], y[t + 1]] for t in range(b - a - 1)))
            total += p
            each += p * np.array(y)
            for t in range(b - a - 1):
                steps[y[t], y[t + 1]] += p
        want_moves += steps / total
        assert np.allclose(good[a:b], each / total) and np.isclose(log_z[c], np.log(total))
    assert np.allclose(expected, want_moves)


def test_features_see_the_neighbouring_lines():
    x, starts, sizes = line_features(["one two\nthree", None, "a\n\nb"])
    assert starts.tolist() == [0, 2, 3, 6] and sizes.tolist() == [7, 5, 0, 1, 0, 1]
    alone, _, _ = line_features(["three"])
    assert not np.allclose(x[1], alone[0])


def documents(n=120):
    rnd = random.Random(1)
    out = []
    for i in range(n):
        line = GOOD if i % 3 else BAD
        out.append((i, "\n".join(" ".join(rnd.sample(line.split(), 6)) for _ in range(rnd.randint(1, 6)))))
    return out


def test_held_out_accuracy_and_edge_rows(frame):
    rows = documents()
    rows += [(500, None), (501, ""), (502, "\n\n"), (3, rows[3][1]), (None, GOOD), (503, (GOOD + "\n") * 4000)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 120, 2)] + [(None, 1, 0), (4, None, 0), (9999, 1, 1)]
    docs = frame([(i, t, 0.5, t) for i, t in rows], "doc_id long, text string, score double, quality string")
    field = fit(docs, frame(labels, "doc_id long, quality int, toxic int"))
    got = score_column(docs, field)
    assert got.columns == ["doc_id", "text", "quality", "score"]
    result = got.collect()
    assert len(result) == len(rows) and all(0 <= r.score <= 1 for r in result)
    by_id = {r.doc_id: r.score for r in result}
    assert all((by_id[i] >= .5) == (i % 3 > 0) for i in range(1, 120, 2))
    assert by_id[503] > .5 and by_id[500] == by_id[501]


def test_no_labels_one_class_empty_table(frame):
    docs = frame([(1, "a"), (2, None)], "doc_id long, text string")
    none = frame([], "doc_id long, quality int")
    assert {r.score for r in score_column(docs, fit(docs, none)).collect()} == {0.5}
    one = frame([(1, 1)], "doc_id long, quality int")
    field = fit(docs, one)
    assert isinstance(field, LineField) and {r.score for r in score_column(docs, field).collect()} == {1.0}
    assert score_column(docs.limit(0), field).collect() == []


def test_blocks_of_lines_do_not_change_features(monkeypatch):
    rnd = random.Random(4)
    texts = ["\n".join("".join(rnd.choice("ab .!9Üé\t") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 9))) for _ in range(30)]
    texts += [None, "", "\n", "same\nsame\n\nsame"]
    want = line_features(texts)
    for lines, chars in ((1, 1 << 18), (3, 1 << 18), (2048, 10)):
        monkeypatch.setattr("ledgerflow.llm.crf_quality.BLOCK_LINES", lines)
        monkeypatch.setattr("ledgerflow.llm.crf_quality.BLOCK_CHARS", chars)
        assert all(np.array_equal(a, b) for a, b in zip(line_features(texts), want))


def test_a_text_of_very_many_lines_in_bounded_memory():
    field = LineField(np.zeros(177, np.float32), np.ones(177, np.float32), np.full(177, 0.01, np.float32), 0.0, np.zeros((2, 2)))
    text = "\n".join("abcdefghij"[k % 10] for k in range(300_000))
    tracemalloc.start()
    assert 0 <= field.score([text])[0] <= 1
    assert tracemalloc.get_traced_memory()[1] < 200 << 20           # 970 MB with all features at once
    tracemalloc.stop()
