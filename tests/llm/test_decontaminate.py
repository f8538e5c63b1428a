import random

import pytest

from helpers import odd_docs
from textflow.llm import decontaminate as dc
from textflow.llm.words import words_of


def brute(docs, items, window=10):
    out = {}
    for doc_id, text in docs:
        words, hit, names = words_of(text), set(), set()
        for item_id, item in items:
            own = words_of(item)
            m = min(window, len(own))
            for s in range(len(own) - m + 1 if own else 0):
                for i in range(len(words) - m + 1):
                    if words[i:i + m] == own[s:s + m]:
                        hit |= set(range(i, i + m))
                        names.add(item_id)
        out[doc_id] = (len(words), len(hit), sorted(map(str, names - {None})))
    return out


def run(docs, items, **options):
    found = dc.with_hits(docs, items, "found_", **options)
    return {r["doc_id"]: (r["found_"]["n_words"], r["found_"]["n_hit"], r["found_"]["items"]) for r in found.collect()}


@pytest.mark.parametrize("words_a_pass", [1_000_000, 12])
def test_against_brute_force(spark, words_a_pass):
    draw = random.Random(2)
    word = lambda: draw.choice("ab Cd, é-x 7 zz".split())
    items = [(i, " ".join(word() for _ in range(draw.randint(0, 14)))) for i in range(12)] + [(3, "a b"), (None, "zz zz 7 7"), (99, None)]
    docs = [(i, " ".join(word() for _ in range(draw.randint(0, 60)))) for i in range(40)]
    docs += [(100 + k, f"x {t}; {t} y") for k, (_, t) in enumerate(items)]
    got = run(spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"), words_a_pass=words_a_pass, window=4)
    assert got == brute(docs, items, 4)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    bench = spark.createDataFrame([(1, "plain text of a few words a second line of")], "item_id long, text string")
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([2, 3, 4, 5, 6, None, 7, 8, 9], key=str)
    assert dc.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert dc.decontaminate(docs.limit(0), bench).count() == 0
    empty = spark.createDataFrame([(1, ""), (2, None)], "item_id long, text string")
    assert dc.decontaminate(docs, empty).count() == docs.count()
