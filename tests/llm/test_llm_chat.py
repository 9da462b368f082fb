import itertools

import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from quarry.llm import chat


def test_roles_and_texts_are_recovered_on_held_out_conversations(spark):
    turns = spark.read.parquet(f"{SF01}/conversations.parquet")
    got = {(r.conv_id, r.turn): r for r in chat.op9_chat(spark, SF01).collect()}
    held = turns.where("crc32(cast(cast(conv_id as string) as binary)) % 5 = 0").collect()
    right = sum((r.conv_id, r.turn) in got and got[r.conv_id, r.turn].role == r.role and got[r.conv_id, r.turn].content == r.text.strip() for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)
    r = next(iter(got.values()))
    assert r.rendered == f"<|im_start|>{r.role}\n{r.content}<|im_end|>\n"


@pytest.mark.parametrize("chunk", [3, 1000])
def test_chunked_viterbi_is_viterbi(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK", chunk)
    turns = spark.read.parquet(f"{SF01}/conversations.parquet").where("conv_id < 40")
    one = turns.withColumn("turn", F.col("conv_id") * 100 + F.col("turn")).withColumn("conv_id", F.lit(-1))  # a conversation over many chunks
    lines = chat.chunked(chat.transcripts(turns.unionByName(one)), 7)
    model = chat.train(lines)
    got = {}
    for r in chat.decode(lines, model).orderBy("conv_id", "turn", "tie", "idx").collect():
        got.setdefault(r.conv_id, []).append((r.symbol, r.state))
    _, moves, shows = model
    start = np.where(np.arange(len(moves)) == 0, 0.0, -np.inf)
    for rows in got.values():
        alpha, path, _, _ = chat.viterbi([s for s, _ in rows], moves, shows, start)
        assert [s for _, s in rows] == path
    assert len(got) == 1 + turns.select("conv_id").distinct().count()


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(1)
    moves, shows = np.log(rng.dirichlet(np.ones(3), 3)), np.log(rng.dirichlet(np.ones(4), 3))
    symbols = [0, 3, 1, 2, 2]
    start = np.array([0.0, -np.inf, -np.inf])

    def score(path):
        return sum(moves[a, b] + shows[b, s] for a, b, s in zip([0, *path], path, symbols))
    best = max(itertools.product(range(3), repeat=5), key=score)
    alpha, path, first, _ = chat.viterbi(symbols, moves, shows, start)
    assert path == list(best) and abs(alpha.max() - score(best)) < 1e-9 and first == 0


def test_markers():
    import re
    for line, word in (("User: hi", "User"), ("### Human: hi", "Human"), ("[assistant] x", "assistant"), ("<|system|> x", "system"), ("**Agent**: x", "Agent"),
                       ("Q: why", "Q")):
        assert re.match(chat.MARKER, line).group(1) == word
    for line in ("Just a line of text: not a marker", "word", "", "12: x"):
        assert not re.match(chat.MARKER, line)


def test_awkward_rows(spark):
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, "user", "first"), (None, 0, "user", "no conversation"),
            (2, 0, None, "no role"), (3, 0, "user", ""), (3, 1, "assistant", "User: quoted\n\nline " + "word " * 50_000)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, line string, state int")
    out = chat.parse(chat.transcripts(turns))
    got = out.collect()
    assert out.columns == ["conv_id", "turn", "role", "content", "rendered"]
    assert {r.conv_id for r in got} == {1, 2, 3, None}
    assert [r.content for r in sorted((r for r in got if r.conv_id is None), key=lambda r: r.turn)] == ["no conversation"]
    words = " ".join(r.content for r in got if r.conv_id == 3)
    assert words.count("word") == 50_000
    assert chat.parse(chat.transcripts(turns.limit(0))).collect() == []


def _dialogue(roles, n, text=lambda i, r: f"this is what {r} says in turn {i} about it", step=1):
    return [(c, t * step, roles[(c + t) % len(roles)], text(t, roles[(c + t) % len(roles)])) for c in range(n) for t in range(8)]


def test_every_role_is_learned(spark):
    roles = [f"role{i:02d}" for i in range(19)] + ["user", "Tool_call"]
    rows = _dialogue(roles, 120)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.role, r.content) for r in chat.parse(chat.transcripts(turns, unmarked=10**9)).collect()}
    assert set(chat.learned_roles(chat.transcripts(turns))) == set(roles)
    assert sum(got.get((c, t)) == (r, x) for c, t, r, x in rows) >= 0.99 * len(rows)


def test_words_before_a_colon_stay_unless_they_name_a_role(spark):
    rows = _dialogue(["user", "assistant"], 60, lambda i, r: f"Note: remember this, number {i}" if i % 3 else "Alice: said so\nTodo: later")
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.parse(chat.transcripts(turns)).collect()
    assert sum(r.content.count("Note:") for r in got) == sum(x.count("Note:") for *_, x in rows)
    assert sum(r.content.count("Alice:") for r in got) == sum(x.count("Alice:") for *_, x in rows)


def test_gaps_in_turn_numbers_change_nothing(spark):
    models = []
    for step in (1, 5):
        turns = spark.createDataFrame(_dialogue(["system", "user", "assistant"], 30, step=step), "conv_id long, turn long, role string, text string")
        lines = chat.transcripts(turns.withColumn("text", F.lit("same text")), unmarked=10**9)
        models.append(chat.train(chat.chunked(lines, 3)))
    assert models[0][0] == models[1][0] and np.allclose(models[0][1], models[1][1])


def test_transitions_do_not_depend_on_chunks(spark, monkeypatch):
    turns = spark.createDataFrame(_dialogue(["system", "user", "assistant"], 30), "conv_id long, turn long, role string, text string")
    whole = chat.train(chat.chunked(chat.transcripts(turns), 1))
    monkeypatch.setattr(chat, "CHUNK", 3)
    assert np.allclose(whole[1], chat.train(chat.chunked(chat.transcripts(turns), 5))[1])
