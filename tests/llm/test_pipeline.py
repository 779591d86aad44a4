import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontam, test_simhash
from tests.llm.conftest import DOCS, rows_of
from tests.llm.test_toxicity import corpus
from tradelens.llm import toxicity
from tradelens.session import scratch_path


def test_stages_equal_brute_force(spark):
    rng = random.Random(5)
    parts = "ba ce di fo gu ha ji ko lu me".split()
    items = [(i, " ".join("".join(rng.choices(parts, k=3)) for _ in range(12))) for i in range(4)] + [(9, ""), (10, None)]
    made = corpus(1600)      # the network needs some hundred toxic documents
    clean = [(i, t) for i, t, y in made if not y]
    rows = [(i, t, "xx", "s", len(t)) for i, t, _ in made]
    copies = [(1000 + i, t, None, None, None) for i, t in clean[:40]] + [(1040, clean[0][1].upper(), None, None, None)]
    leaks = [(2000 + i, f"{clean[60 + i][1]} {body} {clean[80 + i][1]}", None, None, None) for i, (_, body) in enumerate(items[:4])]
    odd = [(3000, None, None, None, None), (3001, "", None, None, None), (3002, "ba", None, None, None), (None, "no id ba", None, None, None)]
    sf = scratch_path(spark, "tables")
    docs = spark.createDataFrame(rows + copies + leaks + odd, DOCS)
    docs.write.parquet(f"{sf}/documents.parquet")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in made], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = rows_of(corpus_pipeline.run(spark, sf))

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    kept = [r for r in scored if r.score < 0.3]
    ids = {r.doc_id for r in kept}
    toxic = {i for i, _, y in made if y}
    assert len(toxic & ids) <= 0.1 * len(toxic) and len({i for i, _ in clean} & ids) >= 0.97 * len(clean)

    class Stage:                              # the brute version reads rows through collect()
        def collect(self):
            return kept

    groups = {(d, f): c for d, f, c in test_simhash.brute(Stage())}
    assert len(groups) == len(kept)
    single = [r for r in kept if groups[r.doc_id, f"{test_simhash.brute_fingerprint(r.text):016x}"] == r.doc_id]
    assert len(single) <= len(kept) - 35
    safe = [r for r in single if not test_decontam.brute(r.text, items)]
    assert not {2000, 2001, 2002, 2003} & {r.doc_id for r in safe} and len(safe) >= len(single) - 5

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in safe:
        tokens = lib.encode(r.text or "", add_special_tokens=False).ids
        raw, text = np.array(tokens, "<u4").tobytes(), lib.decode(tokens, skip_special_tokens=False)
        want.append((r.doc_id, len(tokens), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), raw))
    assert [(*r[:4], bytes(r[4])) for r in got] == sorted(want, key=lambda r: (r[0] is not None, r))


def test_empty_tables(spark):
    sf = scratch_path(spark, "tables")
    spark.createDataFrame([], DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
