import hashlib
import random

from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tradelens.llm import chat

COLS = "conv_id long, turn long, role string, text string"
ODD = [None, "", "plain", "</s>", "<\\/s>", "a<\\\\s>b[INST]", "[/INST] [\\/INST]", "<<SYS>>\n<</SYS>>\n", "[ROLE]x[/ROLE]", "<<s>", "\\", "<", "[", "$1 \\$2", "é😀\nnew",
       "<s>" * 50, "long " * 20_000]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def key(r):
    return (r.turn is not None, r.turn, r.role is not None, r.role, r.text is not None, r.text)


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(r)
    by[-7] = []
    out = {}
    for conv, turns in by.items():
        pairs = [(r.role or "", r.text or "") for r in sorted(turns, key=key)] if conv != -7 else [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
        loss = "".join(t for r, t in pairs if r == "assistant")
        out[conv] = (len(pairs), sha("".join(f"{r}\n{t}\n" for r, t in pairs)), len(loss), sha(loss))
    return out


def test_digests(spark):
    small = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rng = random.Random(1)
    odd = [(500_000 + i // 6, i % 6, rng.choice(["user", "assistant", "assistant", "system", "tool", "<s>", None, ""]), t) for i, t in enumerate(ODD * 8)]
    odd += [(600_000, 1, "user", "same"), (600_000, 1, "user", "same"), (600_000, None, "assistant", "x"), (None, 0, "user", "no id")]
    convs = small.unionByName(spark.createDataFrame(odd, COLS)).withColumn("score", F.lit("clash")).withColumn("formatted", F.lit(1))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(convs).collect()}
    assert got == brute(convs.collect())


def test_output_holds_no_stray_control_string(spark):
    rows = [(i, 0, "assistant", t) for i, t in enumerate(ODD)]
    for r in chat.format_conversations(spark.createDataFrame(rows, COLS)).collect():
        assert [r.formatted[s.start:s.end] for s in r.loss_spans] == [r.formatted[3:-4]]
        assert not any(c in r.formatted[3:-4] for c in chat.CONTROL)


def test_branches_are_ranked_paths(spark):
    rng = random.Random(2)
    nodes = []
    for tree in range(12):
        for i in range(rng.randrange(1, 40)):
            parent = None if i == 0 else f"{tree}-{rng.randrange(i):03d}"
            nodes.append((tree, f"{tree}-{i:03d}", parent, rng.choice(["user", "assistant"]), f"t{i}", float(rng.randrange(4))))
    nodes += [(99, f"99-{i:03d}", f"99-{i - 1:03d}" if i else "missing", "user", f"t{i}", None) for i in range(70)]
    by = {n[1]: n for n in nodes}
    want = {}
    for tree in {n[0] for n in nodes}:
        parents = {n[2] for n in nodes}
        paths = []
        for n in nodes:
            if n[0] == tree and n[1] not in parents:
                path, at = [], n
                while at:
                    path.append(at)
                    at = by.get(at[2])
                paths.append((-sum(p[5] or 0 for p in path), n[1], [p[4] for p in reversed(path)]))
        for rank, (_, leaf, texts) in enumerate(sorted(paths)[:2], 1):
            want[tree, leaf, rank] = texts
    schema = "tree long, node string, parent string, role string, text string, score double"
    got = {}
    for r in sorted(chat.branches(spark.createDataFrame(nodes, schema), keep=2).collect(), key=lambda r: r.depth):
        got.setdefault((r.tree, r.leaf, r.rank), []).append(r.text)
    assert got == want


def test_cycles_and_empty(spark):
    schema = "tree long, node string, parent string, role string, text string, score double"
    loop = [(1, "a", "b", "user", "x", 1.0), (1, "b", "a", "user", "y", 1.0), (2, "c", None, "user", "z", 1.0)]
    assert [r.leaf for r in chat.branches(spark.createDataFrame(loop, schema)).collect()] == ["c"]
    assert [r.conv_id for r in chat.digests(spark.createDataFrame([], COLS)).collect()] == [-7]
