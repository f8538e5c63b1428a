import hashlib
import math

import numpy as np
import xxhash

from helpers import SF001, documents, odd_docs
from textflow.llm import imatch as im
from textflow.llm.words import words_of


def test_lexicon_against_brute_force(spark, monkeypatch):
    docs = documents()
    counts = {}
    for t in docs.text:
        for w in set(words_of(t)):
            counts[w] = counts.get(w, 0) + 1
    n = len(docs)
    wanted = sorted(xxhash.xxh64_intdigest(w, im.SEED) for w, c in counts.items() if c > 1 and 0.02 * n <= c <= 0.2 * n)
    monkeypatch.setattr(im, "FLUSH_WORDS", 1000)
    assert im.lexicon(spark.read.parquet(f"{SF001}/documents.parquet"), 0.02, 0.2).tolist() == wanted


def test_query_against_brute_force(spark):
    rows = im.op10_imatch(spark, SF001).toPandas().set_index("doc_id")
    docs = documents().sort_values("doc_id", ascending=False)
    made = im.Imatch(im.lexicon(spark.read.parquet(f"{SF001}/documents.parquet")))
    texts, ids = docs.text.tolist(), docs.doc_id.tolist()
    assert len(rows) == len(ids)
    for k, (doc_id, text) in enumerate(zip(ids, texts)):
        after = texts[(k + 1) % len(texts)]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        row = rows.loc[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == made.fingerprint(text) and row.edited_fingerprint == made.fingerprint(edited)
        assert row.near_next == im.likeness(row.fingerprint, made.fingerprint(after))
    assert (rows.near_edited > rows.near_next).mean() > 0.8


def test_subsets_hash_only_band_words():
    lexicon = np.array(sorted(xxhash.xxh64_intdigest(f"w{i}".encode(), im.SEED) for i in range(3000)), dtype=np.uint64)
    made = im.Imatch(lexicon)
    a = " ".join(f"w{i}" for i in range(200))
    b = " ".join(f"W{i}," for i in reversed(range(200))) + " other unknown words w5"
    assert made.fingerprint(a) == made.fingerprint(b)
    assert im.likeness(made.fingerprint(a), made.fingerprint(a + " w2999")) > 0.8
    assert made.fingerprint("") == made.fingerprint(None) != made.fingerprint("no band")
    assert 0.0 <= im.likeness(made.fingerprint(""), made.fingerprint(a)) <= 1.0


def test_texts_that_share_only_drawn_words_differ():
    names = [f"w{i}" for i in range(3000)]
    made = im.Imatch(np.array(sorted(xxhash.xxh64_intdigest(w.encode(), im.SEED) for w in names), dtype=np.uint64))
    subsets = {w: made._look_up(w.encode())[1] for w in names}
    drawn = [w for w in names if any(im.SUBSETS[k] > 1 for k in subsets[w])]
    rest = [w for w in names if w not in set(drawn)]
    assert len(rest) > 1000  # words of the band that no sparse subset has
    a, b = " ".join(drawn[:2] + rest[:30]), " ".join(drawn[:2] + rest[30:60])
    assert made.fingerprint(a) != made.fingerprint(b) and im.likeness(made.fingerprint(a), made.fingerprint(b)) < 1.0
    # many drawn words: the whole band tells them apart
    a, b = " ".join(drawn[:50] + rest[:30]), " ".join(drawn[:50] + rest[30:60])
    assert made.fingerprint(a) != made.fingerprint(b)
    # no other word of the band: all distinct words do
    a, b = f"{drawn[0]} one text", f"{drawn[0]} another matter"
    assert made.fingerprint(a) != made.fingerprint(b) and made.fingerprint(a) == made.fingerprint(f"text {drawn[0]} one")


def test_equal_prints_on_given_texts_have_equal_band_words(spark):
    docs = documents()
    words = im.lexicon(spark.read.parquet(f"{SF001}/documents.parquet"))
    made, band = im.Imatch(words), set(words.tolist())
    by_print = {}
    for text in docs.text:
        of = frozenset(words_of(text))
        inside = frozenset(w for w in of if xxhash.xxh64_intdigest(w, im.SEED) in band)
        by_print.setdefault(made.fingerprint(text), set()).add(inside)
    assert all(len(v) == 1 for v in by_print.values())


def test_next_document_over_ranges_and_odd_rows(spark):
    use = lambda i, t, n: (i, t, n)
    texts = [(i, f"t{i}") for i in range(-3, 40, 3)] + [(12, "t12b"), (None, "n1"), (None, "n0")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    chain = sorted((t for t in texts if t[0] is not None), key=lambda t: (-t[0], t[1]))
    wanted = [(i, t, chain[(k + 1) % len(chain)][1]) for k, (i, t) in enumerate(chain)] + [(None, "n0", "n1"), (None, "n1", "t39")]
    for parts in (1, 3, 50):
        rows = im.beside_next(docs, use, "doc_id long, a string, b string", parts).collect()
        assert sorted(map(tuple, rows), key=repr) == sorted(wanted, key=repr)
    nulls = docs.where("doc_id IS NULL")
    assert sorted(map(tuple, im.beside_next(nulls, use, "doc_id long, a string, b string", 4).collect())) == [(None, "n0", "n1"), (None, "n1", "n0")]
    assert im.beside_next(docs.limit(0), use, "doc_id long, a string, b string", 4).count() == 0
    odd = odd_docs(spark)
    out = im.with_fingerprint(odd, "print_")
    assert out.columns == odd.columns + ["print_"] and out.count() == odd.count()
    assert im.beside_next(odd, use, "doc_id long, a string, b string", 4).count() == odd.count()
    assert math.isclose(im.likeness("a.b.", "a.c."), 0.5)
