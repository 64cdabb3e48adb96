from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from ledgerline.llm import conversation_repair as repair
from ledgerline.llm import queries
from ledgerline.llm.common import table
from tests.llm.brute import SPACE
from tests.llm.conftest import SMALL


def visible(text):
    return text.strip(SPACE)


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        k = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv_id, turn)).encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(symbols):
    """Least (cost, audit) by recursion over suffixes; at most two rows are inserted at one place."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, q, inserted):
        ways = [(0, "")] if i == len(symbols) and q in ("", "a") else []
        if inserted < 2:
            for x in "ua":
                if (q, x) in step:
                    c, rest = best(i, step[q, x], inserted + 1)
                    ways.append((c + 2, "I" + rest))
        if i < len(symbols):
            initial, must_go, cut = symbols[i]
            c, rest = best(i + 1, q, 0)
            ways.append((c + 3, "D" + rest))
            if not must_go:
                for x, price, letter in ((initial, 0, "K"), ("u", 2, "R"), ("a", 2, "R")):
                    if (q, x) in step:
                        c, rest = best(i + 1, step[q, x], 0)
                        ways.append((c + price + cut, letter + rest))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def brute(rows, ids):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv_id in ids:
        mine = sorted(
            groups[conv_id],
            key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{r[2]}\0{r[3]}".encode()).digest()),
        )
        seen, symbols, n = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            blank = not visible(text)
            again = (role, text) in seen
            cut = not blank and visible(text)[-1] not in ".!?"
            seen.add((role, text))
            n[0] += blank
            n[1] += not blank and again
            n[2] += not blank and not again and cut
            symbols.append((role[:1], blank or again, int(cut and not again and not blank)))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit = cheapest(tuple(symbols))
        lines, state, at = [], "", iter(mine)
        for x in audit:
            row = next(at) if x != "I" else (None, None, None, "")
            if x == "D":
                continue
            role = row[2] if x == "K" else ("assistant" if state == "u" else "user")
            state = role[0]
            lines.append(f"{role}:{row[3]}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, *n, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest, lines)
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def check(spark, rows, piece_rows=repair.PIECE_ROWS):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report = repair.repair_report(df, piece_rows)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = brute(clean, {r[0] for r in rows})
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in report.collect()}
    assert got == {k: v[:7] for k, v in want.items()}
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.repaired_digests(df, report).collect()}
    assert digests == {k: v[7] for k, v in want.items()}
    turns = defaultdict(list)
    for r in sorted(repair.repaired_turns(df, report).collect(), key=lambda r: r["position"]):
        turns[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert {k: turns[k] for k in want} == {k: v[8] for k, v in want.items()}


def test_query_matches_brute_force(spark):
    for sf in (SMALL, "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
        want = brute(damage(rows), {r[0] for r in rows})
        out = queries.op11_conversation_repair(spark, sf)
        got = {r["conv_id"]: tuple(r[f] for f in [*FIELDS, "repaired_sha256"]) for r in out.collect()}
        assert got == {k: v[:8] for k, v in want.items()}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["One.", "Two!", "three", "Four?", "", " \t\n", None, "five  ", f"Six {t}.", f"seven {t}"])
            rows.append((c, rng.choice([t, t, t, t + 2, None]), role, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    check(spark, random_rows(seed, 120, 9))


def test_long_conversations_are_searched_in_pieces(spark):
    """Half of all rows in one conversation, the pieces being of three rows: same repair as in one piece."""
    long = [(7, *r[1:]) for r in random_rows(5, 40, 9)]
    check(spark, long + [(c + 100, *r) for c, *r in random_rows(6, 40, 9)], piece_rows=3)


def test_agenda_against_recursion():
    rng = random.Random(3)
    for _ in range(400):
        symbols = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randint(0, 12)))
        want = cheapest(tuple((s.lower(), s == "x", int(s.isupper())) for s in symbols))
        assert repair.repair_piece(symbols)[-1] == want


def test_clean_conversations_stay(spark):
    rows = [(1, t, r, f"Turn {t}.") for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    report = repair.repair_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in report.collect()] == [(1, 0, 0, 0, 0, 0, 0, "KKKKK")]


def test_nulls_ties_and_clashing_columns(spark):
    rows = [
        (None, None, "user", "a."), (None, 1, None, None), (1, None, "user", "x."), (1, None, "user", "x."),
        (2, 0, "user", "w " * 200_000 + "."), (2, 0, "assistant", "same."), (2, 0, "assistant", "same."),
        (3, 5, "assistant", "late"), (3, 9, "system", "s."), (4, 1, "user", ""),
    ]
    check(spark, rows)
    df = spark.createDataFrame(
        [(*r, 1, "x", 2) for r in rows],
        "conv_id long, turn long, role string, text string, cost int, audit string, print int",
    )
    plain = repair.repair_report(df.select("conv_id", "turn", "role", "text")).collect()
    assert sorted(map(str, repair.repair_report(df).collect())) == sorted(map(str, plain))


def test_empty_table_and_conversation_without_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_report(empty).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], empty.schema)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
