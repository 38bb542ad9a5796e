import hashlib
import random
from collections import defaultdict

from contactloom.llm import queries
from contactloom.llm.chat_windows import chat_windows, read_loss, read_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "\\</s>", "\\\\<s>x", "<s", "s>", "<<s>>", "", "\n", "a\n</s>\nb", "\\", "<<SYS>> <</SYS>>", "&amp;<", "é😀</s>"]


def talk(rnd, conv, turns):
    rows = [(conv, 0, "system", "be kind " * rnd.randrange(0, 5))] if rnd.random() < 0.5 else []
    for k in range(len(rows), turns):
        text = rnd.choice(NASTY) if rnd.random() < 0.4 else "word " * rnd.randrange(0, 60)
        rows.append((conv, k, rnd.choice(["user", "assistant", "tool\n<", "system"]), text))
    return rows


def read(df):
    """conv -> windows in order: (repeated, turns, loss texts, formatted, spans)."""
    out = defaultdict(list)
    rows = df.select("*", read_turns(df["formatted"]).alias("turns"), read_loss(df["formatted"], df["loss_spans"]).alias("loss")).collect()
    for r in sorted(rows, key=lambda r: r["window_start"]):
        out[r["conv_id"]].append((r["n_repeated"], [tuple(t) for t in r["turns"]], list(r["loss"]), r["formatted"], [tuple(s) for s in r["loss_spans"]]))
    return out


def test_every_turn_once_and_within_budget(spark):
    rnd = random.Random(12)
    rows = [r for c in range(40) for r in talk(rnd, c, rnd.randrange(1, 30))]
    want = defaultdict(list)
    for c, _, role, text in rows:
        want[c].append((role, text))
    got = read(chat_windows(spark.createDataFrame(rows, SCHEMA).repartition(4), budget=200, history=60))
    assert set(got) == set(want)
    for c, windows in got.items():
        said = [t for repeated, turns, *_ in windows for t in turns[repeated:]]
        assert said == want[c]
        assert [x for w in windows for x in w[2]] == [t for role, t in want[c] if role == "assistant"]
        done = []
        for n, (repeated, turns, _, formatted, _) in enumerate(windows):
            lead = want[c][0] if want[c][0][0] == "system" else None
            history = turns[:repeated]
            if lead and n:
                assert history[0] == lead
                history = history[1:]
            if history:
                assert done[-len(history) :] == history
            size = lambda t: -(-len(f"<s>{t[0]}\n{t[1]}\n</s>") // 4)
            assert sum(map(size, history)) <= 70  # escapes are counted as well
            fresh = turns[repeated:]
            if len(fresh) > 1 + (n == 0 and lead is not None):
                assert len(formatted) / 4 <= 200 + (size(lead) if lead else 0) + 10
            done += fresh


def test_a_long_conversation_spans_blocks(spark):
    rnd = random.Random(13)
    rows = talk(rnd, 5, 700)
    windows = read(chat_windows(spark.createDataFrame(rows, SCHEMA).repartition(4)))[5]
    assert [t for rep, turns, *_ in windows for t in turns[rep:]] == [r[2:] for r in rows] and len(windows) > 5
    assert any(w[0] for w in windows)


def test_edges(spark):
    rows = [(None, 0, "user", None), (None, None, None, "no number"), (1, 0, "assistant", None), (2, 0, "system", "alone"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (4, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tokens", "'x' as piece", "2 as s", "3 as c")
    got = read(chat_windows(df))
    assert {k: sum(len(w[1]) - w[0] for w in v) for k, v in got.items()} == {None: 2, 1: 1, 2: 1, 3: 2, 4: 1}
    assert got[1][0][2] == [""] and got[4][0][2] == ["long " * 50_000]
    assert chat_windows(df.limit(0)).count() == 0


def test_query_digests(spark, tmp_path):
    rnd = random.Random(14)
    rows = [r for c in range(6) for r in talk(rnd, c, rnd.randrange(1, 12))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    want = defaultdict(list)
    says = "</s>[INST] ok [/INST]"
    for c, _, role, text in [*rows, (-1, 0, "user", says), (-1, 1, "assistant", says)]:
        want[c].append((role, text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["conv_id"]: r for r in queries.op5_chat_windows(spark, str(tmp_path)).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss)) and got[c]["formatted_chars"] > 0
