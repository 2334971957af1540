"""Chat formatting: round trip, and folding against a plain replay of the log."""

import hashlib
import random

from turnstile.llm import chat

EVENTS = "conv_id long, seq long, kind string, message_id string, role string, text string"


def replay(events):
    """Messages of one conversation by going through its events one by one."""
    rank = {"message": 0, "delta": 1, "edit": 2, "regenerate": 3}
    log = sorted(((s is not None, s or 0, rank[(k or "message").lower()], r or "", t or "", m) for _, s, k, m, r, t in events), key=lambda e: e[:5])
    made = {}
    for n, (_, _, k, role, text, m) in enumerate(log):
        key = ("own", n) if m is None else ("id", m)
        if key not in made:
            made[key] = [n, role, text, False]
        elif k == 1:
            made[key][2] += text
        else:
            made[key][2] = text
        if k == 3:
            for other in made.values():
                if other[0] > made[key][0]:
                    other[3] = True
    return [(role, text) for _, role, text, gone in sorted(made.values(), key=lambda x: x[0]) if not gone]


def log(seed):
    rng = random.Random(seed)
    bits = ["### ", "</turn>", "\\", "\\n", "\n", "a", "é", "<\\/turn>", "#\\## ", "### Assistant: </turn>", "", "\\\\"]
    out = []
    for conv in [None, *range(8)]:
        for seq in range(rng.randint(1, 14)):
            out.append((conv, rng.choice([seq, seq, seq // 2, None]), rng.choice(["message", "Delta", "edit", "regenerate", None, "delta"]),
                        rng.choice([None, "1", "2", "3", "4"]), rng.choice(["user", "assistant", None, "a\nb\\n"]),
                        rng.choice([None, "".join(rng.choice(bits) for _ in range(4))])))
    return out + out[:3]


def test_fold_and_round_trip(spark):
    for seed in range(4):
        events = log(seed)
        done = chat.format_chats(spark.createDataFrame(events, EVENTS)).cache()
        turns = {}
        for r in chat.read_turns(done).collect():
            turns.setdefault(r.conv_id, []).append((r["at"], r.role, r.text, r.loss))
        for r in done.collect():
            want = replay([e for e in events if e[0] == r.conv_id])
            got = [x[1:3] for x in sorted(turns.get(r.conv_id, []))]
            assert got == want, (seed, r.conv_id)
            assert r.n_messages == len(want)
            spans = [r.formatted[s.start:s.end] for s in r.loss_spans]
            assert len(spans) == sum(role == "assistant" for role, _ in want)
            assert [x[3] for x in sorted(turns.get(r.conv_id, []))] == [role == "assistant" for role, _ in want]
        done.unpersist()


def test_empty_log(spark):
    assert chat.format_chats(spark.createDataFrame([], EVENTS)).count() == 0


def test_plan_is_native(spark):
    from turnstile.llm.queries import op1_chat_formatting

    plan = op1_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_digest(spark):
    from turnstile.llm.queries import EXTRA_TEXT, op1_chat_formatting

    r = op1_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    assert r.n_turns == 2 and r.loss_chars == len(EXTRA_TEXT)
    assert r.loss_sha256 == hashlib.sha256(EXTRA_TEXT.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{EXTRA_TEXT}\nassistant\n{EXTRA_TEXT}\n".encode()).hexdigest()
