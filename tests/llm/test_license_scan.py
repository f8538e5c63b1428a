import random

from helpers import odd_docs
from textflow.llm import license_scan as ls
from textflow.llm.words import words_of

TEMPLATES = (("t1", "alpha beta gamma delta epsilon"), ("t2", "beta beta zeta eta"), ("t3", "theta"), ("none", "..."))


def test_join_against_brute_force(spark):
    draw = random.Random(9)
    vocabulary = "alpha beta gamma delta epsilon zeta eta theta the of and in".split()
    docs = [(i, "\n\n".join(" ".join(draw.choice(vocabulary[k:]) for _ in range(draw.randint(0, 9)))
                            for k in (0, draw.randint(0, 8)))) for i in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for threshold in (0.5, 0.8, 1.0):
        got = {r["doc_id"]: (r["labels"], r["score"]) for r in ls.scan_licenses(frame, TEMPLATES, threshold, ls.PHRASES).collect()}
        for doc_id, text in docs:
            best = {}
            for block in text.split("\n\n"):
                have = set(words_of(block))
                for label, t in TEMPLATES:
                    own = set(words_of(t))
                    if own and len(own & have) / len(own) >= threshold:
                        best[label] = max(best.get(label, 0), len(own & have) / len(own))
            assert got[doc_id] == (sorted(best), max(best.values(), default=0.0)), (text, threshold)


def test_phrases(spark):
    texts = ["MIT License", "the mit-license, MIT\nLicense mit licenses", "apache license apache license cc by cc", "gnu general public gnu general public license",
             "cc by 4.0 CC-BY", "xmit license", "é mit license", "no", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = ls.scan_licenses(frame).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = [w.decode() for w in words_of(texts[r["doc_id"]])]
        places = [(i, label) for p, label in ls.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == sorted({label for _, label in places}) and set(r["base_labels"]) <= set(r["labels"])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert ls.scan_licenses(docs).count() == docs.count()
    assert ls.scan_licenses(docs.limit(0)).count() == 0
