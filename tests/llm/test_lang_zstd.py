import random

from ledgerflow.llm.lang_zstd import _words, UNDETERMINED, fit, predict

WORDS = {"en": "the and of with that from this have were been which their would about there".split(),
         "de": "der die und mit nicht eine wurde werden auch zwischen haben über können für sind".split(),
         "fr": "le les des une dans pour avec être nous vous mais été sont cette leur".split()}


def rows(n=150, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = ["en", "en", "de", "fr"][i % 4]
        out.append((i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(15, 60))), lang))
    return out


def test_held_out_accuracy_and_margins(frame):
    data = rows()
    model = fit(frame([r for r in data if r[0] % 3], "doc_id long, text string, lang string"), sample_docs=20)
    assert [x for x, _ in model.passages][0] == "en"
    got = {r.doc_id: r for r in predict(frame(data, "doc_id long, text string, lang string"), model).collect()}
    held = [r for r in data if r[0] % 3 == 0]
    assert sum(got[i].lang_pred == lang for i, _, lang in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.accepted == (r.margin >= model.reject_margin) for r in got.values())


def test_edge_rows(frame):
    data = rows(60)
    train = data + [(200, None, "en"), (201, "x", None), (202, "", "xx")]
    model = fit(frame(train, "doc_id long, text string, lang string"))
    odd = [(1, None, "a"), (2, "", "b"), (3, "12 -- 34", None), (4, "der " * 200_000, "de"), (4, data[0][1].upper(), "z"),
           (None, data[2][1], "z")]
    got = predict(frame(odd, "doc_id long, text string, lang_pred string"), model).collect()
    assert len(got) == len(odd)
    by = {(r.doc_id, r.lang_pred) for r in got}
    assert {(1, UNDETERMINED), (2, UNDETERMINED), (3, UNDETERMINED), (4, "de"), (4, "en"), (None, "de")} == by
    nothing = fit(frame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in predict(frame(data, "doc_id long, text string, lang string"), nothing).collect()} == {UNDETERMINED}
    assert predict(frame([], "doc_id long, text string"), model).collect() == []


def test_letters_by_category():
    assert _words("हिन्दी 12 ²½①") == "हिन्दी" and _words("naïve e\u0301t") == "naïve e\u0301t"
    assert _words("² ½ ¼ ① 12 _ \u0301 !") == ""
