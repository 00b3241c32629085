import random

import pytest

from joinery.llm import chat
from joinery.llm.queries import op5_chat
from .conftest import frame, sha
from pyspark.sql import functions as F


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learnt), sha(learnt))
    return out


def test_query_equals_brute_force(spark, corpus):
    rows = [tuple(r) for r in spark.read.parquet(f"{corpus.sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "</s>[INST] ok [/INST]"
    want = brute(rows + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    got = {r.conv_id: r for r in op5_chat(spark, corpus.sf_dir).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want
    assert got[-7].valid


HARD = ["[INST]", "a\\", "\\[INST]\\", "</s>", "x <", "[", " [/INST] ", "[ROLE:41] y [/ROLE]", "\\\\n\n</s", "[/SYS][SYS] ", "é[OUT] 日本 </s></s>", "$1 \\$", "", None, "[I[INST]NST]"]


def test_round_trip_of_control_strings(spark):
    rows = [(k, i, role, text) for k, shift in enumerate((0, 3, 7)) for i, text in enumerate(HARD[shift:] + HARD[:shift])
            for role in [["user", "assistant", "system", "tool ] x", None][(i + k) % 5]]]
    rows += [(None, None, "user", "null"), (None, 2, "assistant", "ids"), (None, 2, "assistant", "ids"), (9, 1, "user", "long " * 100_000), (9, 2, "assistant", "<" * 50_000)]
    df = frame(spark, [(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, Formatted int").repartition(4)
    out = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted")))
    got = {}
    for r in out.collect():
        learnt = "".join(t.text for t in r.turns if t.loss)
        got[r.conv_id] = (len(r.turns), sha("".join(f"{t.role}\n{t.text}\n" for t in r.turns)), len(learnt), sha(learnt))
        assert "".join(s.text for s in r.segments) == r.formatted and len(r.segments) == 3 * len(r.turns)
    assert got == brute(rows)


def random_template(rng):
    """Turns with closings of odd characters; None if they are refused."""
    marks = ["<", "|", "end", "$", "(", ")", "]", "[", "/", "*", "+", "?", ".", "{", "}", "^", " ", "\n", "é", "#", "&", "-"]
    close = lambda: "".join(rng.choice(marks) for _ in range(rng.randint(1, 5)))
    tags = rng.sample(["USER", "BOT", "S.Y*S", "a|b", "(x", "$1", "é"], 3)
    try:
        return chat.Template({r: chat.Turn(t, close(), r == "assistant") for r, t in zip(("system", "user", "assistant"), tags, strict=True)}, other_close=close())
    except ValueError:
        return None


def test_round_trip_of_any_template(spark):
    rng = random.Random(7)
    bot = chat.Template({"user": chat.Turn("USER", " <|end|>", False), "assistant": chat.Turn("BOT", " <|end|>", True)}, other_close=" <|end|>")
    templates = [bot, *[t for t in (random_template(rng) for _ in range(200)) if t][:25]]
    assert len(templates) > 15
    for template in templates:
        strings = [x for t in template.turns.values() for x in (f"[{t.tag}] ", t.close, t.close[:-1], t.close[1:])] + [template.other_close, "[ROLE:41] ", "\\", "$1", "a", " "]
        rows = [(k, i, rng.choice(["user", "assistant", "system", "tool", None]), "".join(rng.choice(strings) for _ in range(rng.randrange(7)))) for k in range(6) for i in range(8)]
        rows += [(9, 0, "user", "hi [BOT] x <|end|> y"), (9, 1, "assistant", "ok a|b end")]
        out = chat.format_chats(frame(spark, rows, "conv_id long, turn long, role string, text string").coalesce(1), template)
        got = {r.conv_id: [(t.role, t.text, t.loss) for t in r.turns] for r in out.withColumn("turns", chat.read_turns(F.col("formatted"), template)).collect()}
        want = {c: [(r or "", t, r == "assistant") for k, _, r, t in rows if k == c] for c in {r[0] for r in rows}}
        assert got == want, template


def test_ambiguous_templates_are_refused():
    turns = lambda **c: {r: chat.Turn(r.upper(), x, False) for r, x in c.items()}
    for bad in (turns(a="|"), turns(a="xx"), turns(a="a\\b"), turns(a=" end", b=" end."), turns(a="<|end|>", b="|><"), turns(a="abcd", b="bc")):
        with pytest.raises(ValueError):
            chat.Template(bad, other_close=" [/R]")
    for tags in (("ROLE:4A", "B"), ("", "B"), ("A] [B", "A")):
        with pytest.raises(ValueError):
            chat.Template({str(k): chat.Turn(t, "</s>", False) for k, t in enumerate(tags)})


def test_turn_order(spark):
    orders = {"su a": False, "ua": True, "sua": True, "uaua": True, "uu": False, "au": False, "u": False, "s": False, "suaua": True, "uxa": False}
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(k, i, names.get(c, "other"), "t") for k, o in enumerate(orders) for i, c in enumerate(o)]
    got = {r.conv_id: r.valid for r in chat.format_chats(frame(spark, rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == dict(enumerate(orders.values()))


def test_empty(spark):
    assert chat.format_chats(frame(spark, [(1, 1, "user", "x")], "conv_id long, turn long, role string, text string").filter("false")).count() == 0
