import hashlib
import random

import pytest
from airlake.llm import chat
from airlake.llm.queries import QUERIES
from llm_helpers import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows, span_tokens, history):
    """Formatted windows and digests of each conversation, one turn at a time."""
    out, convs = {}, {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, r or "", x or ""))
    for c, turns in convs.items():
        turns = [(r, x) for *_, r, x in sorted(turns)]
        system = turns[0][0] == "system"
        spans, at = [], 0
        for i, (r, x) in enumerate(turns):
            spans.append(at // span_tokens)
            at += 0 if system and i == 0 else len(x.split())
        esc = lambda s, more="": "".join("\\" + ch if ch in "\\#<" + more else ch for ch in s)
        form = [f"### {esc(r, chr(10))}\n{esc(x)}</turn>\n" for r, x in turns]
        chars = 0
        for s in sorted(set(spans)):
            own = [i for i, k in enumerate(spans) if k == s]
            old = set(range(max(0, own[0] - history), own[0])) | ({0} if system and own[0] > 0 else set())
            chars += sum(len(form[i]) for i in [*old, *own])
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss), chars)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_windows_against_brute_force(spark, seed):
    rng = random.Random(seed)
    bits = ["a ", "### assistant\n", " </turn>", "\\", "\n", "😀é ", "\\### Assistant: </turn> ok", "x" * 30, "<", "#"]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([*range(9), None]), rng.choice(["user", "assistant", "system", None, "a\nb", "#r\\"]),
             rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))])) for _ in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    for span, history in ((5, 2), (10_000, 1), (3, 0)):
        got = {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.windows(df, span, history)).collect()}
        assert got == brute(rows, span, history)


def test_masks_cover_each_assistant_text_once(spark):
    rows = [(1, 0, "system", "be kind"), *[(1, i, "user" if i % 2 else "assistant", f"text {i} " * 4) for i in range(1, 12)]]
    out = sorted(chat.windows(spark.createDataFrame(rows, SCHEMA), 12, 2).collect(), key=lambda r: r.span)
    assert len(out) > 2 and all(r.formatted.startswith("### system\nbe kind</turn>\n") for r in out)
    assert [r.formatted[m.start:m.end] for r in out for m in r["mask"]] == [x for _, _, r, x in rows if r == "assistant"]


def test_edge_rows(spark):
    assert chat.digests(chat.windows(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(1, 0, "user", "w " * 200_000), (1, 0, "user", "w " * 200_000), (1, 1, "assistant", "#" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS span", "1 AS place", "2 AS piece")
    assert {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.windows(df)).collect()} == brute(rows, chat.SPAN_TOKENS, chat.HISTORY)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in QUERIES["op8_chat"](spark, SF_SMALL).collect()}
    assert got == brute(rows, chat.SPAN_TOKENS, chat.HISTORY)
