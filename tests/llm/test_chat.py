"""Operator 9: exact round trip."""

import hashlib

import numpy as np
from llm_helpers import rows_of, words

from wikisift.llm.chat import CONTROL, MARKERS, conversation_digests, escape, format_turns, loss_mask, read_turns, turn_ids, unescape
from wikisift.llm.tokens import encoder


def test_escape_round_trip(rng):
    pieces = [*CONTROL, "0", "a", "[", "]", "<", "</", "INST", "é", " ", "\n"]
    for _ in range(500):
        t = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert unescape(escape(t)) == t and not any(m in escape(t) for m in MARKERS)


def test_mask_and_read_back():
    enc = encoder()
    turns = [("system", "be <<SYS>> good"), ("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]"), ("tool", "␛0"), ("assistant", ""), ("assistant", "end")]
    ids = np.concatenate([p for r, t in turns for p in turn_ids(r, t, enc)]).astype(np.int64)
    got, shown, masked = read_turns(ids, loss_mask(ids, enc.size), enc)
    assert got == turns and masked == "</s>[INST] ok [/INST]end"
    assert shown.count("[INST]") == 1 and shown.count("<s>") == 3


def model(rows):
    out, by = [], {}
    for c, n, r, t in rows:
        by.setdefault(c, []).append((n is not None, n or 0, r is not None, r or "", t is not None, t or ""))
    size = {"system": 15, "user": 13, "assistant": 7}
    for c, v in by.items():
        v = [(x[3], x[5]) for x in sorted(v)]
        loss = "".join(t for r, t in v if r == "assistant")
        out.append((c, len(v), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in v).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    sum(len(escape(t)) + size.get(r, 26 + len(escape(r))) for r, t in v)))
    return sorted(out, key=repr)


def test_conversations(spark, rng, clash):
    rows = [(k, n, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["", None, words(rng, 20), rng.choice(CONTROL) * 3])) for k in range(40) for n in range(rng.randrange(1, 6))]
    rows += [(None, 0, "user", "x"), (None, None, None, None), (99, 0, "user", "tie"), (99, 0, "user", "tie"), (99, 0, "assistant", "b"), (100, 0, "assistant", "z" * 100_000)]
    rows += [(7777, n, "assistant" if n % 2 else "user", f"turn {n}") for n in range(1500)]  # one conversation of many batches
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert rows_of(conversation_digests(format_turns(clash(df))), *cols) == model(rows)
    assert conversation_digests(format_turns(df.where("false"))).count() == 0
