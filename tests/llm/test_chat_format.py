import hashlib
import json

from pyspark.sql import functions as F

from ledgerflow.llm.chat_format import Template, canonical_turns, digest, format_chats, read_back

T = Template()


def expected(conv, turns):
    every = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return conv, len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_layouts_give_the_same_turns(frame):
    a, b = "Wie spät\nist es?", "Es ist 12 Uhr."
    records = [
        (1, {"messages": [{"role": "user", "content": a}, {"role": "assistant", "content": b}]}),
        (2, {"conversations": [{"from": "human", "value": a}, {"from": "gpt", "value": b}]}),
        (3, {"prompt": a, "response": b}), (4, {"completion": b, "prompt": a}), (5, {"question": a, "answer": b}),
        (6, {"instruction": "Wie spät\nist es?", "input": "", "output": b}), (7, {"output": b, "instruction": a}),
        (8, {"messages": []}), (9, {"unknown": 1}), (10, [1, 2]), (11, {"prompt": a, "response": None}),
        (12, {"messages": [{"role": "user", "content": a}, {"content": None, "role": "assistant"}]})]
    df = frame([(i, 0, json.dumps(r)) for i, r in records] + [(13, 0, "not json"), (14, 0, None)], "conv_id long, turn int, record string")
    got = {r.conv_id: r for r in canonical_turns(df).collect()}
    for i in range(1, 8):
        assert [tuple(x) for x in got[i].turns] == [("user", a), ("assistant", b)], i
    assert got[8].turns == [] and all(got[i].turns is None for i in (9, 10, 13, 14))
    assert [tuple(x) for x in got[11].turns] == [("user", a), ("assistant", None)] == [tuple(x) for x in got[12].turns]
    assert got[1].fingerprint == got[12].fingerprint != got[2].fingerprint


def test_round_trip_with_control_strings(frame):
    odd = ["</s>[INST] ok [/INST]", "␛", "␛0␛1", "<|im_start|>user\nhi<|im_end|>\n", "a\n\nb", "", None, "<<SYS>><</SYS>>",
           "␛<s>1", "\U0001f600" * 3, "x" * 200_000, "\\Q\\E$1"]
    rows = [(1, k, ["user", "assistant", "system", "as\nsistant", None, "␛7"][k % 6], t, 0) for k, t in enumerate(odd)]
    rows += [(2, k, "assistant", t, 0) for k, t in enumerate(odd)]
    rows += [(None, 1, "user", "q", 0), (None, 1, "user", "q", 0), (None, 2, "assistant", "r", 0), (3, None, "assistant", "z", 0)]
    df = frame(rows, "conv_id long, turn long, role string, text string, n int")
    formatted = format_chats(canonical_turns(df.select("conv_id", "turn", F.struct("role", "text").alias("record"))))
    for r in formatted.collect():
        assert sum(r.formatted.count(c) for c in T.control if c not in (T.open, T.close.strip())) == 0
        assert all(s.end <= len(r.formatted) for s in r.loss_spans)
    got = {tuple(r)[:5] for r in digest(read_back(formatted)).collect()}
    want = {}
    for c, k, role, text, _ in rows:
        want.setdefault(c, []).append((k if k is not None else -1, role or "", text or ""))
    assert got == {expected(c, [(r, t) for _, r, t in sorted(x)]) for c, x in want.items()}


def test_no_turns_and_empty_table(frame):
    df = frame([(8, 0, '{"messages": []}')], "conv_id long, turn int, record string")
    formatted = format_chats(canonical_turns(df))
    assert [tuple(r) for r in formatted.collect()] == [(8, "", [])]
    assert [tuple(r)[:5] for r in digest(read_back(formatted)).collect()] == [expected(8, [])]
    assert digest(read_back(format_chats(canonical_turns(df.limit(0))))).collect() == []
