"""Chat formatting: the fold, the round trip and awkward rows."""

import hashlib
import random

from newsloom.llm import chat
from newsloom.llm.registry import ORACLES, QUERIES
from tests.compare import differences, duck
from tests.llm.data import SF, rows_of, write

OP = QUERIES["op4_format_chats"]


def test_query_equals_sql(spark):
    assert not differences(OP(spark, SF).toArrow(), duck(SF).sql(ORACLES["op4_format_chats"]).to_arrow_table())


def test_round_trip_of_awkward_turns(spark, tmp_path):
    rng = random.Random(3)
    nasty = ["", None, "\\", "\\l", "\\b<", "</turn>\n", "<turn>assistant\n", "a\\\\l<b>\n\n", "\\n", "😀<", "x" * 50_000]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a\nb", "<turn>"]), rng.choice(nasty)) for c in (1, 2, None) for t in (3, 1, 2, 2, None)]
    rows += [(9, 0, "assistant", "same"), (9, 0, "assistant", "same")]
    got = {r["conv_id"]: r for r in rows_of(OP(spark, write(tmp_path, True, conversations=rows)))}
    rows += [(-7, 0, "user", chat.PLANTED), (-7, 1, "assistant", chat.PLANTED)]
    assert set(got) == {1, 2, None, 9, -7}
    low = lambda v: (v is not None, v if v is not None else 0)
    for conv, r in got.items():
        turns = sorted((t for t in rows if t[0] == conv), key=lambda t: (low(t[1]), (t[2] is not None, t[2] or ""), (t[3] is not None, t[3] or "")))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_log_folds_to_final_messages(spark):
    log = [
        (1, 1, 0, "delta", "user", "Hel"), (1, 1, 1, "delta", None, "lo"),
        (1, 2, 2, "delta", "assistant", "bad"), (1, 2, 3, "regenerate", None, "ignored"), (1, 2, 4, "delta", None, "go"), (1, 2, 5, "delta", None, "od"),
        (1, 3, 6, "delta", "user", "x"), (1, 1, 7, "edit", None, "Hi"), (1, 1, 8, "delta", None, "!"),
        (2, 1, 0, "regenerate", "assistant", None),
    ]
    events = spark.createDataFrame(log, "conv_id long, message int, seq int, kind string, role string, text string")
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.fold_events(events).collect()}
    assert got == {(1, 1): ("user", "Hi!"), (1, 2): ("assistant", "good"), (1, 3): ("user", "x"), (2, 1): ("assistant", "")}
    formatted = {r["conv_id"]: r for r in chat.format_chats(events).collect()}
    one = formatted[1]
    assert one["formatted"] == "<turn>user\nHi!</turn>\n<turn>assistant\ngood</turn>\n<turn>user\nx</turn>\n"
    assert ["".join(one["formatted"][s["start"] : s["start"] + s["n_chars"]]) for s in one["loss_spans"]] == ["good"]


def test_empty_log(spark, tmp_path):
    got = rows_of(OP(spark, write(tmp_path, conversations=[])))
    assert [r["conv_id"] for r in got] == [-7]
