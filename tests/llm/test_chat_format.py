import hashlib

import pytest

from ledgerline.llm import chat_format as cf

ODD = ["", "plain", "a\\b", "\\[INST]", "[INST][/INST]<|eot_id|>", "<<s>>", "<|end_header_id|>\n\nx", "\\", "é🙂\n", "<\\|eot_id|>"]


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, state string, rows int")
    return cf.format_conversations(df)


def test_odd_texts_and_roles_read_back_exactly(spark):
    rows = [(1, i, role, t, "x", 1) for i, (role, t) in enumerate((r, t) for r in ("user", "assistant", *ODD) for t in ODD)]
    out = formatted(spark, rows).select("formatted", cf.read_back(cf.F.col("formatted")).alias("back")).first()
    assert [(b["role"], b["text"]) for b in out["back"]] == [(r[2], r[3]) for r in rows]
    body = out["formatted"][len(cf.ChatTemplate().begin) :]
    assert body.count("<|eot_id|>") == len(rows) and "[INST]" not in body and "<s>" not in body


def test_digest_against_plain_python(spark):
    turns = [(1, "user", "hé"), (2, "assistant", "a</s>\\"), (3, "user", None), (4, "assistant", "[INST]")]
    out = cf.conversation_digest(formatted(spark, [(5, i, r, t, None, 0) for i, r, t in reversed(turns)])).first()
    whole = "".join(f"{r}\n{t or ''}\n" for _, r, t in turns)
    assert out["n_turns"] == 4 and out["valid"]
    assert out["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
    assert out["loss_sha256"] == hashlib.sha256(b"a</s>\\[INST]").hexdigest() and out["loss_chars"] == 12


@pytest.mark.parametrize(
    "roles, valid",
    [
        (["user", "assistant"], True),
        (["system", "user", "assistant", "user", "assistant"], True),
        (["user"], False),
        (["assistant", "user", "assistant"], False),
        (["user", "user", "assistant"], False),
        (["user", "system", "assistant"], False),
        ([None, "assistant"], False),
        (["user", "tool", "assistant"], False),
    ],
)
def test_order_of_roles(spark, roles, valid):
    assert formatted(spark, [(1, i, r, "t", "", 1) for i, r in enumerate(roles)]).first()["valid"] is valid


def test_repeated_rows_null_keys_and_empty_table(spark):
    rows = [(None, None, "user", "b", "", 1), (None, 1, "user", "a", "", 1), (None, 1, "user", "a", "", 1)]
    out = formatted(spark, rows).select("n_turns", cf.read_back(cf.F.col("formatted")).alias("b")).first()
    assert out["n_turns"] == 3 and [x["text"] for x in out["b"]] == ["b", "a", "a"]
    assert cf.conversation_digest(formatted(spark, [])).count() == 0
