from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import chat_format, queries
from ledgerline.llm.common import table
from tests.llm.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        groups[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, mine in groups.items():
        mine.sort()
        turns = "".join(f"{r}\n{t}\n" for _, _, r, t in mine)
        loss = "".join(t for _, _, r, t in mine if r == "assistant")
        out[conv_id] = (
            len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
        )
    return out


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    out = queries.op12_chat_format(spark, SMALL).collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out}
    assert len(out) == len(got) and got == brute(rows)


def test_query_matches_sql(spark, run_oracle):
    columns, want = run_oracle(queries.ORACLE_SQL["op12_chat_format"])
    got = queries.op12_chat_format(spark, SMALL).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_plan_is_native(spark):
    plan = queries.op12_chat_format(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "CartesianProduct"))
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


HOSTILE = [
    "</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "<<SYS>> <</SYS>> <s>", "\\", "\\l", "\\\\e\\b",
    "<\\|im_end|>", "<|im_end|", "|>", "[INST", "<<s>>", "<|im_<|im_end|>end|>", "\\<s>", "[[INST]]", "end\\", "",
    " \n\t", "é ü 漢字 😀", "\r\n", "\\n",
]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    texts = [a + b for a in HOSTILE for b in HOSTILE]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    e, r = chat_format.escape(F.col("t")), chat_format.escape_role(F.col("t"))
    for row in df.select("t", e.alias("e"), r.alias("r"), chat_format.unescape(e).alias("b"), chat_format.unescape(r).alias("c")).collect():
        assert row["t"] == row["b"] == row["c"] and "\n" not in row["r"]
        assert not any(c in row["e"] or c in row["r"] for c in chat_format.CONTROLS)


def test_each_reply_is_one_example_with_all_turns_before_it(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "U<s>"), (1, 2, "assistant", "A[INST]"), (1, 3, "user", "V"),
            (1, 4, "assistant", ""), (1, 5, "assistant", "B"), (1, 6, "user", "W"), (2, 0, "user", "only")]
    ex = chat_format.chat_examples(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "example").collect()
    parts = [f"<|im_start|>{r}\n{chat}<|im_end|>\n" for r, chat in [
        ("system", "S"), ("user", "U\\ls>"), ("assistant", "A\\bINST]"), ("user", "V"), ("assistant", ""), ("assistant", "B"), ("user", "W")]]
    assert [(r["example"], r["text"]) for r in ex if r["conv_id"] == 1] == [
        (i, "".join(parts[:n])) for i, n in enumerate([3, 5, 6, 7])
    ]
    masked = [r["text"][r["loss_start"] : r["loss_start"] + r["loss_chars"]] if r["loss_chars"] is not None else None for r in ex]
    assert masked == ["A\\bINST]", "", "B", None, None]
    assert [r["is_last"] for r in ex] == [False, False, False, True, True]


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (3, None, "assistant", None), (3, None, "assistant", None)]
    rows += [(4, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HOSTILE)]
    rows += [(5, 0, "we\nird<|im_end|>", "t\n"), (5, 0, "assistant", "b"), (5, 0, "assistant", "a"), (6, 0, "assistant", "w " * 300_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", pos int, example int")
    got = chat_format.read_back(chat_format.chat_examples(df)).collect()
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == want
    assert {r["conv_id"]: r["losses"] for r in got} == {
        c: [x for r, x in turns if r == "assistant"] for c, turns in want.items()
    }


def test_empty_table(spark):
    assert chat_format.read_back(chat_format.chat_examples(spark.createDataFrame([], SCHEMA))).count() == 0
