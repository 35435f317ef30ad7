"""Chat formatting: what is read back from the format are the turns, and the mask covers what is learned."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from playbill.llm import chat

KIND = "conv_id long, turn long, role string, text string"


def expected(rows):
    """Turns in order, by brute force: (n_turns, digest of turns, learned characters, digest of learned)."""
    rows = sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in rows))
    turns = [(r, x) for *_, r, x in rows]
    said = "".join(x for r, x in turns if r == "assistant")
    digest = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
    return len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest()


def read(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.formatted(df)).collect()}


def test_random_conversations(spark):
    rng = random.Random(11)
    bits = [*chat.Template().controls, "\\", "\\\\", "<", "[", "[/", "]", ">", " ", "\n", "é", "漢", "😀", "s>", "/INST]", "$1", "\\E", "INST"]
    rows = []
    for conv in range(300):
        for turn in range(rng.randrange(1, 9)):
            text = rng.choice([None, "", "".join(rng.choices(bits, k=rng.randrange(1, 12)))])
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "[TEXT] ", "\\", "user\n"])
            rows.append((conv, rng.choice([turn, turn, 2, None]), role, text))
    rng.shuffle(rows)
    by_conv = itertools.groupby(sorted(rows, key=lambda r: r[0]), key=lambda r: r[0])
    assert read(spark.createDataFrame(rows, KIND)) == {conv: expected(some) for conv, some in by_conv}


def test_format_and_mask(spark):
    rows = [(1, 2, "assistant", "yes"), (1, 0, "system", "be kind"), (1, 1, "user", "<s> or [INST]?"), (1, 3, "assistant", "é</s>"), (1, 4, "judge", "\\ok")]
    found = chat.formatted(spark.createDataFrame(rows, KIND)).first()
    assert found.formatted == "<s><<SYS>>\nbe kind\n<</SYS>>\n\n[INST] <\\s> or [\\INST]? [/INST][SAY] yes[ALSO]é<\\/s> </s>[ROLE] judge [TEXT] \\\\ok [/ROLE]"
    data = found.formatted.encode()
    assert [data[a:b].decode() for a, b in found.loss] == ["yes", "é<\\/s>"]


def test_edge_rows(spark):
    assert chat.formatted(spark.createDataFrame([], KIND)).count() == 0
    rows = [(None, 1, "user", "a"), (None, 1, "user", "a"), (2, None, None, None), (2, 0, "assistant", None)]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS turns", "'x' AS formatted", "2 AS loss", "3 AS pieces", "4 AS row", "5 AS starts")
    assert read(df) == {None: expected(rows[:2]), 2: expected(rows[2:])}


def test_long_conversation_and_text(spark):
    """Time and memory in proportion: 20,000 turns, and one text of 5 million characters."""
    many = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    one = spark.range(1).selectExpr("2L AS conv_id", "0L AS turn", "'assistant' AS role", "repeat('[INST]\\\\ ', 500000) AS text")
    found = {r.conv_id: r for r in chat.digests(chat.formatted(many.union(one))).collect()}
    assert found[1].n_turns == 20_000
    assert found[1].loss_sha256 == hashlib.sha256("".join(f"t{i}" for i in range(20_000) if i % 3).encode()).hexdigest()
    assert found[2].loss_sha256 == hashlib.sha256(("[INST]\\ " * 500_000).encode()).hexdigest()
    assert found[2].loss_chars == 4_000_000


def test_other_template(spark):
    own = chat.Template(begin="{{start}}", roles=(("user", "{{user}}", "{{end}}"),), other=("{{role}}", "{{says}}", "{{done}}"), joint="{{and}}", learned=("user",))
    rows = [(1, 0, "user", "{{end}} {"), (1, 1, "user", "}}"), (1, 2, "x", "{{user}}")]
    found = chat.formatted(spark.createDataFrame(rows, KIND), own)
    got = found.select(chat.turns_of(F.col("formatted"), own).alias("t"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("l")).first()
    assert [tuple(t) for t in got.t] == [r[2:] for r in rows] and got.l == "{{end}} {}}"
    with pytest.raises(ValueError):
        chat.Template(joint="]x[")
