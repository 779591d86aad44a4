import random
import re

from tests.llm.conftest import DOCS, rows_of
from tradelens.llm import licenses


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text):
    """The same votes, spans and labels by plain loops."""
    words, base, labels, score = words_of(text), [], set(), 0.0
    found_base = set()
    for number, (own, label) in enumerate(licenses.all_templates()):
        steps = len(own) // licenses.WORDS_PER_STEP
        votes, places = {}, {}
        for j in range(len(own) - 1):
            places.setdefault(tuple(own[j:j + 2]), []).append(j)
        for i in range(len(words) - 1):
            for j in places.get(tuple(words[i:i + 2]), ()):
                votes.setdefault(i - j, []).append((i, j))
        spans, last = [], None
        for d in sorted(votes):
            if last is None or d - last > steps:
                spans.append([])
            spans[-1] += votes[d]
            last = d
        for span in spans:
            cover = len({j for _, j in span}) / (len(own) - 1)
            size = max(i for i, _ in span) - min(i for i, _ in span) + 1
            if cover == 1 if steps == 0 else cover >= licenses.COVER and size <= len(own) - 1 + 2 * steps:
                labels.add(label)
                score = max(score, cover)
                if number < len(licenses.BASE):
                    base.append(min(i for i, _ in span))
                    found_base.add(label)
    places = [i for phrase, _ in licenses.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    assert sorted(places) == sorted(base)
    return (len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(found_base)), ",".join(sorted(labels)), score)


def texts():
    rng = random.Random(6)
    out = ["MIT License", "mit license mit-license\x00MIT\nLicense", "the GNU General Public License and general public public license", "mit", "license mit", "É mit license K mit license",
           "general general public license", "Apache License " * 3000, "mit license" * 3]
    for whole, _ in licenses.all_templates():
        for edit in range(4):
            words = list(whole)
            if edit == 1:
                words[rng.randrange(len(words))] = "other"
            if edit == 2:
                words.insert(rng.randrange(len(words)), "added")
            if edit == 3:
                del words[rng.randrange(len(words))]
            out.append("see: " + ", ".join(words).upper() + ". Mit license; " * rng.randrange(3) + " end")
    return out


def test_scan_equals_brute_force(spark, docs):
    all_docs = docs.unionByName(spark.createDataFrame([(4_000_000 + i, t, None, None, None) for i, t in enumerate(texts())], DOCS)).withColumn("row", docs.doc_id).withColumn("label", docs.lang)
    want = sorted(((r.doc_id, *brute(r.text)) for r in all_docs.collect()), key=lambda r: tuple((x is not None, x) for x in r))
    got = rows_of(licenses.scan(all_docs))
    assert got == want
    assert {"mit", "gpl", "bsd", "lgpl", "cc"} <= {x for r in got for x in r[6].split(",")}


def test_whole_texts_with_edits(spark):
    """Texts of 200 words and more, some words changed, left out and added; half a text is none."""
    rng, rows = random.Random(9), []
    long = [(words, label) for words, label in licenses.all_templates() if len(words) > 150]
    assert max(len(w) for w, _ in long) > 200 and len(long) >= 2
    for words, label in long:
        for edits in (0, 6, 12):
            own = list(words)
            for _ in range(edits):
                at = rng.randrange(len(own))
                own[at:at + rng.randrange(2)] = rng.choice([["changed"], [], ["added", own[at]]])
            rows.append((len(rows), "start " * rng.randrange(50) + " ".join(own) + " end", label))
        rows.append((len(rows), " ".join(words[:len(words) // 2]), None))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, want string")).collect()}
    for doc, text, label in rows:
        assert tuple(got[doc]) == (doc, *brute(text))
        assert label is None or label in got[doc].labels.split(",") and got[doc].score >= 0.8


def test_plan_has_no_python_and_one_shuffle_of_matches(spark, docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2      # matches, then each document's few spans


def test_empty(empty):
    assert licenses.scan(empty).count() == 0
