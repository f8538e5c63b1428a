import numpy as np
import pytest
import xxhash

from helpers import SF001, documents, odd_docs
from textflow.llm import simhash
from textflow.llm.components import components


def brute_print(text, k=3):
    words = [w.lower() for w in (text or "").encode().split()]
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def clustered(n, seed=0):
    draw = np.random.default_rng(seed)
    centres = [int(x) for x in draw.integers(0, 1 << 63, 12)]
    out = set()
    while len(out) < n:
        x = centres[draw.integers(len(centres))]
        for b in draw.choice(64, draw.integers(0, 7), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


def test_fingerprint_against_brute_force():
    for text in ["", None, "one", "one two", "A b C d", "x " * 500, "é É b\x0bc\x1cd"] + documents().text.head(40).tolist():
        assert simhash.fingerprint(text) == brute_print(text)


def test_long_text_in_steps(monkeypatch):
    text = documents().text.str.cat(sep=" ")[:60_000]
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 1000)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("max_pairs", [1 << 20, 64])
def test_trie_walk_finds_all_links(monkeypatch, max_pairs):
    monkeypatch.setattr(simhash, "MAX_PAIRS", max_pairs)
    values = np.array(clustered(400), dtype=np.uint64)
    found = set()
    for i, j in simhash.trie_links(values, np.array([[0, len(values), 0, len(values)]]), 0, 3):
        found |= {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    wanted = {(i, j) for j in range(len(values)) for i in range(j) if bin(int(values[i]) ^ int(values[j])).count("1") <= 3}
    assert found == wanted


@pytest.mark.parametrize("max_node", [8192, 7])
def test_components_against_brute_force(spark, max_node):
    values = clustered(500, 1)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    prints = spark.createDataFrame([(v,) for v in signed] * 2, "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(prints, 3, max_node)).collect()}
    wanted = brute_components(values)
    groups, expected = {}, {}
    for k, v in enumerate(signed):
        groups.setdefault(roots.get(v, v), set()).add(v)
        expected.setdefault(wanted[k], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(7, 7), (500, 501), (501, 500)], "u long, v long")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert all(roots[i] == 0 for i in range(1, 301)) and roots[501] == 500 and len(roots) == 301
    assert components(edges.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    rows = simhash.op7_simhash(spark, SF001).toPandas().sort_values("doc_id")
    docs = documents().sort_values("doc_id")
    prints = [brute_print(t) for t in docs.text]
    assert rows.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    ids = docs.doc_id.tolist()
    least = {}
    roots = brute_components(prints)
    for i, r in zip(ids, roots):
        least[r] = min(least.get(r, i), i)
    assert rows.component_id.tolist() == [least[r] for r in roots]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    empty = [r for r in rows if r["fp"] == 0]
    assert {r["doc_id"] for r in empty} == {2, 3, 4, None} and {r["component_id"] for r in empty} == {2}
    plain = [r["component_id"] for r in rows if r["doc_id"] == 1]
    assert plain == [1, 1]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == [1, 2, 5, 7, 8, 9]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    only_null = docs.where("doc_id IS NULL")
    assert simhash.keep_one(only_null).count() == 2
