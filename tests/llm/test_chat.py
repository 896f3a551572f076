import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelsieve.llm import chat, queries

SIGNS = ["\\", "<", ">", "s", "/", "[", "]", "INST", "TURN", "<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "<<SYS>>", "\n", "é", " ", "|", "<|im_end|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=30).map("".join), st.lists(st.sampled_from(SIGNS), max_size=8).map("".join))
def test_escapes_and_turns_round_trip(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)
    shown, at = chat.render(role, text)
    assert chat.parse(chat.BEGIN + shown + shown) == [(role, text)] * 2
    assert chat.unescape(shown[at : -len(chat.END)]) == text


turns = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]), st.lists(st.sampled_from(["a", "bb ", "</s>", "\\", "ü\n"]), max_size=12).map("".join)), max_size=25)


def cut(conversation, budget, history, segment=None):
    """Windows of one conversation, whole or in parts that are entered as the parts before them are left."""
    rows = []
    for number, (role, text) in enumerate(conversation):
        shown, at = chat.render(role, text)
        rows.append((number, role, max(1, len(text)), shown, at))
    system, held = [], 0
    for _, role, n, shown, _ in rows:
        held += n
        if role != "system" or held > int(budget * chat.SYSTEM_SHARE):
            break
        system.append((shown, n))
    if segment is None:
        return list(chat.windows(rows, 0, len(rows), system, budget, history)), system
    segment, out, at = max(segment, budget + history), [], 0
    for begin in range(0, len(rows), segment):
        end = min(begin + segment, len(rows))
        some = rows[max(0, begin - history) : end + budget]
        tokens = np.array([x[2] for x in some])
        entries, exits, counts = chat.leaves(tokens, some[0][0], begin, end, len(system), sum(n for _, n in system), budget, history)
        if at in entries:
            found = list(chat.windows(some, at, begin + segment, system, budget, history))
            assert len(found) == counts[at - begin]
            out += found
            at = exits[at - begin]
    assert at == len(rows)
    return out, system


@settings(max_examples=200, deadline=None)
@given(turns, st.integers(1, 60), st.integers(0, 30))
def test_windows_hold_each_turn_once(conversation, budget, history):
    found, system = cut(conversation, budget, history)
    back, targets = [], []
    for w in found:
        text = "".join(w.parts)
        assert len(text) == w.size
        every = chat.parse(text)
        back += every[w.repeated :]
        targets += [chat.unescape(text[a:b]) for a, b in w.mask]
        assert w.tokens <= budget or w.new == 1
        assert w.repeated == 0 or sum(max(1, len(t)) for _, t in every[len(system) : w.repeated]) <= history
    assert back == conversation
    assert targets == [t for r, t in conversation if r == "assistant"]
    lead = [chat.parse(chat.BEGIN + shown)[0] for shown, _ in system]
    assert all(chat.parse("".join(w.parts))[: len(lead)] == lead for w in found)


@settings(max_examples=200, deadline=None)
@given(st.lists(turns, max_size=8).map(lambda x: [t for some in x for t in some]), st.integers(1, 20), st.integers(0, 10))
def test_parts_give_the_windows_of_the_whole(conversation, budget, history):
    shown = lambda some: [("".join(w.parts), w.mask, w.repeated, w.tokens) for w in some]
    assert shown(cut(conversation, budget, history, 1)[0]) == shown(cut(conversation, budget, history)[0])


def expect(rows):
    out = {}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, own in by.items():
        own.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_over_all_conversations(spark, small):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", queries.OWN_TURN), (-1, 1, "assistant", queries.OWN_TURN)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.op8_chat_windows(spark, small).collect()}
    assert got == expect(rows)


def test_long_conversation_is_cut_alike_whatever_its_parts(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "system", "be brief")]
    rows += [(1, 10 * i * i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 7)) for i in range(2, 900)]
    rows += [(2, -5 + i, "user", "same") for i in range(3)] + [(3, None, "user", "none")] * 200 + [(2, 5, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = []
    for segment in (1, 4096):
        windows = chat.format_windows(df, None, 100, 50, segment)
        found.append(sorted(map(repr, windows.collect())))
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
        assert got == expect(rows)
    assert found[0] == found[1]
    later = windows.where("conv_id = 1 AND window = 20").first()
    assert later.repeated > 2 and chat.parse(later.text)[:2] == [("system", "be kind"), ("system", "be brief")]
    whole, _ = cut([(r, t) for _, _, r, t in rows[:900]], 10**6, 0)
    assert len(whole) == 1


def test_counts_tokens_by_vocabulary(spark, small):
    with open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb") as file:
        count = chat.counter(file.read())
    assert count(["hello world", ""]) == [2, 0]
    assert chat.counter(None)(["hello world", ""]) == [2, 0]


def test_odd_rows(spark):
    rows = [(1, None, "user", "a"), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (None, 3, "assistant", "z" * 300000), (4, 1, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1)).withColumn("kind", F.lit("k")).withColumn("mask", F.lit(0))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_windows(df)).collect()}
    assert got == expect(rows)
    assert chat.read_back(chat.format_windows(df.limit(0))).count() == 0
    assert re.match(r"<s>\[TURN\]", chat.format_windows(df).first().text)
