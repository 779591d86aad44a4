import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tests.llm.conftest import SF, rows_of
from tradelens.llm import repair

COLS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) over all edit sequences with at most two inserts in a row."""
    leads = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}

    @lru_cache(maxsize=None)
    def best(i, s, inserts):
        options = []
        if i == len(rows) and s in "03":
            options.append((0, "", ()))
        if inserts < 2:
            name = "assistant" if s == "2" else "user"
            cost, audit, lines = best(i, leads[s, name[0]], inserts + 1)
            options.append((cost + 3, "I" + audit, ((name, ""), *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = best(i + 1, s, 0)
            options.append((cost + 4, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                ways = [("R", 3, n) for n in ("user", "assistant")] + [("K", 0, role)]
                for letter, price, name in ways:
                    to = leads.get((s, name[:1]))
                    if to:
                        cost, audit, lines = best(i + 1, to, 0)
                        options.append((cost + price + more, letter + audit, ((name, text), *lines)))
        return min(options) if options else (1 << 60, "", ())
    for i in range(len(rows), 0, -1):  # from the back: no deep recursion
        for s in "0123":
            best(i, s, 0)
    return best(0, "0", 0)


def brute(rows):
    out, after = [], damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3]))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        judged, seen, count = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            judged.append((role, text, fault))
        initials = [r[0][:1] for r in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(tuple(judged)) if judged else (0, "", ())
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def invented(seed, convs=60, most=14):
    pick = random.Random(seed)
    rows = []
    for conv in range(convs):
        for _ in range(pick.randint(1, most)):
            rows.append((conv, pick.choice([None, *range(12)]), pick.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]),
                         pick.choice(["Hi.", "a b", "Fine!", "", None, " \t\n\x0b", "end. \r\n", "end.\xa0", "q?", "x" * 40_000 + "."])))
    rows += rows[:20] + [(None, 1, "user", "no id."), (None, None, "assistant", "ok."), (None, 5, "user", "no id.")]
    return rows


@pytest.mark.parametrize("bits", [0, 1, 10])
def test_digests_against_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = invented(bits)
    assert rows_of(repair.digests(spark.createDataFrame(rows, COLS))) == brute(rows)


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert rows_of(repair.digests(df)) == brute([tuple(r) for r in df.collect()])


def test_one_long_conversation_in_blocks(spark, monkeypatch):
    """Most rows belong to one conversation, many of them copies of each other."""
    monkeypatch.setattr(repair, "BLOCK_BITS", 3)
    pick = random.Random(5)
    rows = [(7, t, pick.choice(["user", "assistant", "system"]), pick.choice(["Same.", f"Text {t}.", "cut"])) for t in range(400)]
    rows += [(7, 50, "user", "copy.")] * 100 + [(8, 0, "user", "Hi.")]
    assert rows_of(repair.digests(spark.createDataFrame(rows, COLS).repartition(5))) == brute(rows)


def test_edits_give_the_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "tool", "Fine."), (1, 2, "system", "cut"), (2, 0, "assistant", "Late."), (2, 0, "assistant", "Late.")]
    df = repair.as_given(spark.createDataFrame(rows, COLS))
    got = repair.repair(df).orderBy("conv_id", "at", "step").drop("at", "step").collect()
    assert [tuple(r) for r in got] == [(1, "K", "user", "Hi.", 0), (1, "R", "assistant", "Fine.", 1), (1, "D", None, None, 2),
                                       (2, "I", "user", "", None), (2, "K", "assistant", "Late.", 0), (2, "D", None, None, 0)]


def test_empty_table_and_extra_columns(spark):
    assert repair.digests(spark.createDataFrame([], COLS)).count() == 0
    odd = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 9, 3)], COLS + ", plan string, copies int, At int")
    assert rows_of(repair.digests(odd)) == brute([(1, 0, "user", "Hi.")])
