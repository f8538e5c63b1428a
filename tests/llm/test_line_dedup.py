import random
import time

from helpers import odd_docs
from textflow.llm import line_dedup
from textflow.llm.line_dedup import dedup_lines, drop_emptied, normal
from pyspark.sql import functions as F


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    """``docs``: (doc_id, text) by doc_id; texts after the removal of lines."""
    seen, out = [], {}
    for doc_id, text in docs:
        kept = []
        for raw in text.split("\n"):
            line = " ".join(raw.split()).lower()
            gone = bool(line) and any(line == s or (min(len(line), len(s)) >= 20 and abs(len(line) - len(s)) <= 1 and edits(line, s) <= 1) for s in seen)
            if line:
                seen.append(line)
            if not gone:
                kept.append(raw)
        out[doc_id] = "\n".join(kept)
    return out


def test_against_brute_force(spark):
    draw = random.Random(5)
    base = ["".join(draw.choice("abc d") for _ in range(draw.randint(18, 40))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(4):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 2)):
                at = draw.randrange(len(line))
                line[at:at + draw.randint(0, 1)] = draw.choice(["", "x", "y", "é"])
            lines.append("".join(line) if draw.random() > 0.1 else "")
        docs.append((i, "\n".join(lines)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = brute(docs)
    for limit in (1_000_000, 0):  # broadcast sides, shuffled sides
        got = {r["doc_id"]: r["text"] for r in dedup_lines(frame, broadcast_rows=limit).collect()}
        assert got == wanted


def test_larger_bounds_against_brute_force(spark):
    draw = random.Random(8)
    base = ["".join(draw.choice("abcd e") for _ in range(draw.choice([19, 25, 38, 41, 58, 61, 90]))) for _ in range(20)]
    docs = []
    for i in range(160):
        line = list(draw.choice(base))
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(line))
            line[at:at + draw.randint(0, 1)] = draw.choice(["", "x", "y", "é"])
        docs.append((i, "".join(line)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    lines = [(i, " ".join(t.split())) for i, t in docs]
    gone = {}
    for edits_ in (1, 2, 3):
        wanted = {i for k, (i, a) in enumerate(lines) if any(
            a == b or edits(a, b) <= min(edits_, min(len(a), len(b)) // 20) for _, b in lines[:k])}
        gone[edits_] = {r["doc_id"] for r in dedup_lines(frame, n_removed="gone", edits=edits_).where("gone > 0").collect()}
        assert gone[edits_] == wanted
    assert gone[1] < gone[2] < gone[3]


def test_one_character_more_less_or_other(spark):
    line = "the quick brown fox jumps over"
    docs = [(1, line), (2, line.replace("quick", "quack")), (3, line + "s"), (4, line[1:]), (5, line.replace("quick", "slow")),
            (6, "short line"), (7, "short lime"), (8, "short line"), (9, "THE  QUICK brown fox jumps over ")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["gone"]) for r in dedup_lines(frame, n_removed="gone").collect()}
    assert {i for i in got if got[i][1]} == {2, 3, 4, 8, 9}
    assert got[7][0] == "short lime" and got[5][0] == docs[4][1]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = dedup_lines(docs, "n_before", "n_gone")
    assert out.columns == docs.columns + ["n_before", "n_gone"]
    rows = out.collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r["text"])
    # the two rows of document 1 differ in other columns: the one with the smaller hash is the earlier
    assert sorted(by_id[1]) == ["", "Some plain text of a few words.\nA second line of the text."]
    twice = docs.where("doc_id = 9").union(docs.where("doc_id = 9"))  # wholly equal rows are one document
    assert [r["text"] for r in dedup_lines(twice).collect()] == ["Q" * 30] * 2
    assert by_id[2] == [None] and by_id[3] == [""] and by_id[4] == ["   \n\t \r\n"]
    assert sorted(by_id[None], key=str) == ["", None]  # later than doc 1, so its lines go
    kept = drop_emptied(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2
    assert dedup_lines(docs.limit(0)).count() == 0 and drop_emptied(docs.limit(0)).columns == docs.columns


def test_normal_form(spark):
    df = spark.createDataFrame([("  A\t b\x0bC ",)], "raw string").select(normal(F.col("raw")).alias("n"))
    assert df.first()["n"] == "a b c"


def variants(line, most=2):
    """The line with up to ``most`` characters left out."""
    found, last = {line}, {line}
    for _ in range(most):
        last = {s[:k] + s[k + 1:] for s in last for k in range(len(s))}
        found |= last
    return found


def test_crowded_parts_against_brute_force(spark, monkeypatch):
    """One large group of near copies: lines that share parts with hundreds of others."""
    draw = random.Random(11)
    base = "".join(draw.choice("abcdefgh ") for _ in range(47)).strip().ljust(47, "z")
    docs = []
    for i in range(420):
        line = list(base)
        for _ in range(draw.choice([1, 1, 2, 3])):
            at = draw.randrange(len(line))
            line[at:at + draw.randint(0, 1)] = draw.choice(["", "x", "yz", "éé", "b", "q"])
        docs.append((i, " ".join("".join(line).split())))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    by_variant, wanted = {}, set()
    for i, line in docs:
        mine = variants(line)
        near = {j for v in mine for j in by_variant.get(v, ())}
        if any(docs[j][1] == line or edits(docs[j][1], line) <= min(2, min(len(line), len(docs[j][1])) // 20) for j in sorted(near)):
            wanted.add(i)
        for v in mine:
            by_variant.setdefault(v, []).append(i)
    assert 100 < len(wanted) < 400
    for crowd, blocks in ((32, 16), (1, 16), (1, 5)):
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        monkeypatch.setattr(line_dedup, "BLOCKS", blocks)
        got = {r["doc_id"] for r in dedup_lines(frame, n_removed="gone", edits=2).where("gone > 0").collect()}
        assert got == wanted


def test_a_document_of_many_equal_lines(spark):
    frame = spark.createDataFrame([(1, "\n".join(["the same line"] * 100_000)), (2, "a\nb\n\nb")], "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: (r["text"], r["gone"]) for r in dedup_lines(frame, n_removed="gone").collect()}
    assert got == {1: ("the same line", 99_999), 2: ("a\nb\n", 1)}
    assert time.time() - began < 60
