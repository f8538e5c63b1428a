import hashlib
import re

import pytest

from helpers import SF001, documents, odd_docs
from textflow.llm import fill_middle as fim

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    """Tokens, form, parts and output straight from the contract."""
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else int(doc_id)}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:low], tokens[low:high], tokens[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_cut_splits_descriptors_at_any_place():
    whole = fim.PieceTable.of("hello world").joined(("marks", 0, 3)).joined(("text", 2, 5))
    text = str(whole)
    assert text == "hello world<P>llo" and len(whole) == len(text)
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            assert [str(p) for p in whole.cut(a, b)] == [text[:a], text[a:b], text[b:]]
    assert all(p.buffers is whole.buffers for p in whole.cut(1, 4))   # nothing is copied


def test_hash_streams_slices(monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 7)
    text = "żółć and \U0001F600 more " * 30
    table = fim.arranged(text, 11, 200, "spm")
    assert max(map(len, table.slices())) <= 7
    assert table.sha256() == hashlib.sha256(str(table).encode()).hexdigest()


@pytest.mark.parametrize("form", ["psm", "spm", "plain"])
def test_inverse_permutation_restores(form):
    for text in ("a", "ab<S c>", "<", "<S<<M", "x" * 1000, "żółć\n\x00\U0001F600"):
        for low in range(0, len(text) + 1, max(1, len(text) // 7)):
            for high in range(low, len(text) + 1, max(1, len(text) // 5)):
                out = fim.arranged(text, low, high, form)
                assert str(fim.restored(str(out), form)) == text


def test_odd_rows(spark):
    texts = [(1, "<P> inside"), (2, "a <M> b"), (3, "</S> <S"), (11, "one  two\tthree\r\n4 five"), (12, "żółć ßÉİ"),
             (None, None), (None, "no id at all"), (5, ""), (6, "word " * 60_000), (7, "\x00a\x1cb"), (8, "\U0001F600" * 9)]
    texts += [(k, f"text number {k} of several words") for k in range(20, 60)] * 2
    docs = odd_docs(spark, texts)
    rows = fim.read_back(fim.write_out(fim.describe(docs))).collect()
    assert len(rows) == len(texts)
    for row in rows:
        n, form, prefix, middle, output = brute(row.doc_id, row.text)
        assert (row.n, row.form, row.output, row.restored) == (n, form, output, row.text or "")
        assert len(row.pieces) <= 6
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fim.describe(docs.limit(0)).count() == 0


def test_rates_and_names_are_parameters(spark):
    docs = odd_docs(spark, [(k, f"text {k}") for k in range(50)])
    assert {r.f for r in fim.describe(docs, form="f", rate=100, spm_rate=100).collect()} == {"spm"}
    assert {r.form for r in fim.describe(docs, rate=0).collect()} == {"plain"}


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in fim.op13_fill_middle(spark, SF001).collect()}
    texts = documents()
    assert len(rows) == len(texts)
    for doc_id, text in zip(texts.doc_id, texts.text):
        n, form, prefix, middle, output = brute(doc_id, text)
        r = rows[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
