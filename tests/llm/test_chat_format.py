import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import CLASHES, SF_SMALL, long_text
from pyspark.sql import functions as F

from tokenmill.llm import chat_format as C
from tokenmill.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["", "<|im_end|>", "<|im_start|>user\n", "<\\|im_end|>", "<\\\\|", "<|", "|>", "<|endoftext|>", "\n", "<|im_end|>\n", "\\", "<|im_end", "plain", "é日本", "\r\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([*ODD, "user", "assistant"]), max_size=3).map("".join), st.lists(st.sampled_from(ODD), max_size=5).map("".join)), max_size=6))
def test_any_turns_read_back(turns):
    formatted, places, escaped = C.format_turns(turns)
    assert C.parse(formatted) == turns
    assert [C.unescape(formatted[a:b]) for a, b in places] == [text for _, text in turns]
    assert formatted.count(C.BEGIN) == formatted.count(C.END) == len(turns)
    if not any("<" in x or "\\" in x or "\n" in role for role, text in turns for x in (role, text)):
        assert escaped == 0


def test_only_conflicts_are_escaped():
    formatted, _, escaped = C.format_turns([("user", "a < b | c <| d"), ("assistant", "<|im_end|>"), ("user", "<\\|")])
    assert escaped == 2
    assert formatted == "<|im_start|>user\na < b | c <| d<|im_end|>\n<|im_start|>assistant\n<\\|im_end|><|im_end|>\n<|im_start|>user\n<\\\\|<|im_end|>\n"


@pytest.mark.parametrize("text", ["x", "<|im_start|>user", "<|im_start|>user\nx", "<|im_start|>user\nx<|im_end|>", "<|im_start|>a<|im_end|>\n",
                                  "<|im_start|>user\n<|im_start|>b\nx<|im_end|>\n", "<|im_start|>user\nx<|im_end|>\n ", "<|im_start|>user\n<|endoftext|><|im_end|>\n"])
def test_what_is_not_a_turn(text):
    with pytest.raises(C.NotATurn):
        C.parse(text)


def brute(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""), r[2] or "", r[3] or ""))
    convs[-1] += [((True, i, "", ""), role, "<|im_end|><|im_start|>assistant ok") for i, role in enumerate(["user", "assistant"])]
    out = []
    for conv, turns in convs.items():
        turns = [t[1:] for t in sorted(turns)]
        said = "".join(text for role, text in turns if role == "assistant")
        chars = len(C.format_turns(turns)[0])
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
        out.append((conv, len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest(), chars))
    return sorted(out, key=repr)


def check(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHES, "conv", "part", "formatted", "loss_spans"]})
    df.repartition(5).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    assert sorted(map(tuple, Q.op11_chat_format(spark, str(tmp_path)).collect()), key=repr) == brute(rows)


def edges():
    return [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", ""), (None, 0, "user", "no id"), (None, 0, "user", "no id"), (None, None, None, None),
            (2, 5, "assistant", long_text()), (2, 5, "assistant", "tie"), (2, 4, "assistant", "<|im_start|>x\\<\\|"), (3, 1, "a\nb\\<|im_end|>", "\n"),
            (4, 0, "system", "s"), (4, 0, "system", "s"), (4, 1, "assistant", "ÄÖ 日本"), (-1, 7, "user", "one more turn")]


def test_edges(spark, tmp_path):
    check(spark, tmp_path, edges())


def test_a_long_conversation_in_parts(spark, tmp_path, monkeypatch):
    rows = edges() + [(9, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 5)) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = C.format_conversations(df, part_chars=900).filter("conv_id = 9").collect()
    assert [p.part for p in parts] == list(range(len(parts))) and len(parts) > 20
    whole = C.format_conversations(df).filter("conv_id = 9").collect()
    assert len(whole) == 1 and whole[0].formatted == "".join(p.formatted for p in parts)
    assert sum(p.n_turns for p in parts) == 4000 and max(len(p.formatted) for p in parts) < 10_000
    monkeypatch.setattr(C.format_conversations, "__defaults__", (*C.format_conversations.__defaults__[:-1], 900))
    check(spark, tmp_path, rows)


def test_loss_spans_cover_the_chosen_roles(spark):
    rows = [(1, 0, "user", "u"), (1, 1, "tool", "t<|x|>"), (1, 2, "assistant", "a")]
    r = C.format_conversations(spark.createDataFrame(rows, SCHEMA), loss_roles=("tool", "assistant")).first()
    assert [r.formatted[s.start:s.end] for s in r.loss_spans] == ["t<\\|x|>", "a"] and r.n_escaped == 1


def test_empty_table(spark):
    assert C.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, Q.op11_chat_format(spark, SF_SMALL).collect()), key=repr) == brute(rows)
