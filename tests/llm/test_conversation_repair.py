import hashlib
import heapq
import itertools
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest

from helpers import SF001
from textflow.llm import conversation_repair as cr

WELL_FORMED = re.compile(r"(s?(ua)+)?")
SPACE = "[\x20\x09-\x0D]"


def cheapest(kinds):
    """Uniform-cost search over edit sequences: the least (cost, audit) of all whose
    roles are well formed, with those roles."""
    heap = [(0, "", 0, "")]
    while True:
        cost, audit, row, roles = heapq.heappop(heap)
        if row == len(kinds) and WELL_FORMED.fullmatch(roles):
            return cost, audit, roles
        if re.search("ss|uu|aa|us|as|sa|^a", roles):   # can't become well formed any more
            continue
        for role in "ua":
            heapq.heappush(heap, (cost + 2, audit + "I", row, roles + role))
        if row < len(kinds):
            kind = kinds[row]
            heapq.heappush(heap, (cost + 3, audit + "D", row + 1, roles))
            if kind not in "1234":
                extra = int(kind.isupper())
                for role in "ua":
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", row + 1, roles + role))
                if kind.lower() in "sua":
                    heapq.heappush(heap, (cost + extra, audit + "K", row + 1, roles + kind.lower()))


def drawn(seed, n, signs="suaxSUAX1234"):
    draw = np.random.default_rng(seed)
    return "".join(draw.choice(list(signs), n))


def roles_of(kinds, start, audit):
    return "".join(role for _, role, _ in cr.edits(kinds, start, audit))


def test_cheapest_edits_against_search():
    short = ["".join(k) for n in range(4) for k in itertools.product("suaUA1x", repeat=n)]
    for kinds in short + [drawn(s, 5) for s in range(60)] + [drawn(s, 6, "uuaaUs") for s in range(40)]:
        cost, audit, _ = cr.chosen([cr.parsed(kinds)])
        wanted = cheapest(kinds)
        assert (cost, audit) == wanted[:2], kinds
        assert roles_of(kinds, cr.START, audit) == wanted[2]


def test_any_split_gives_the_same_cell():
    """A full CYK chart, all splits of every span, against one split of each."""
    for seed in range(8):
        kinds = drawn(seed, 14)
        chart = {(i, i + 1): cr.leaf(k) for i, k in enumerate(kinds)}
        for size in range(2, len(kinds) + 1):
            for i in range(len(kinds) - size + 1):
                cells = [cr.combined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
                assert all(c == cells[0] for c in cells)
                chart[i, i + size] = cells[0]
        assert chart[0, len(kinds)] == cr.parsed(kinds)


def test_segments_are_combined_to_the_same_choice():
    for seed in range(20):
        kinds = drawn(seed, 37)
        whole = cr.chosen([cr.parsed(kinds)])
        bounds = [0, *sorted(np.random.default_rng(seed).choice(range(1, 37), seed % 7, replace=False).tolist()), 37]
        pieces = [kinds[a:b] for a, b in zip(bounds, bounds[1:])]
        cost, audit, parts = cr.chosen([cr.parsed(p) for p in pieces])
        assert (cost, audit) == whole[:2] and "".join(a for _, a in parts) == audit
        assert "".join(roles_of(p, start, a) for p, (start, a) in zip(pieces, parts)) == roles_of(kinds, cr.START, audit)
    assert cr.chosen([]) == (0, "", [(cr.START, "")])


def test_time_grows_with_the_length():
    began = time.time()
    cr.chosen([cr.parsed(drawn(1, 20_000))])
    assert time.time() - began < 20


def brute(rows, ids):
    """The contract's row of each conversation, from ``(conv_id, turn, role, text)``."""
    kept = {i: [] for i in ids}
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept[conv] += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, found in kept.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, kinds, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in found:
            kind = role[:1] if role[:1] and role[:1] in "sua" else "x"
            solid = re.sub(SPACE, "", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
                kind = kind.upper() if fault == "truncated" else "1"
            kinds += kind
        initials = "".join(r[1][:1] if r[1][:1] and r[1][:1] in "sua" else "x" for r in found)
        illegal = sum(initials[k:k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))
        turns = [r[0] for r in found if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, roles = cheapest(kinds)
        lines, at = [], 0
        for k, edit in enumerate(audit):
            row = None if edit == "I" else found[at]
            at += edit != "I"
            if edit != "D":
                name = {"u": "user", "a": "assistant"}.get(roles[len(lines)])
                lines.append(f"{row[1]}:{row[2]}" if edit == "K" else f"{name}:{row[2] if row else ''}")
        yield (conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def told(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    rows = pd.read_parquet(f"{SF001}/conversations.parquet")
    plain = [tuple(r) for r in rows[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    wanted = sorted(brute(plain, set(rows.conv_id)), key=repr)
    assert told(cr.op11_conversation_repair(spark, SF001)) == wanted


ODD = [(None, None, None, None), (None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (1, None, "assistant", "A."),
       (1, None, "assistant", "A."), (1, 3, "user", ""), (1, 5, "", "no role."), (1, 9, "tool", "x\n\t "), (2, 0, "system", "Only."),
       (3, 2, "user", "long " * 50_000), (3, 2, "assistant", "long " * 50_000 + "."), (3, 2, "user", "long " * 50_000),
       (4, 0, "user", "   "), (5, 7, "User", "Upper."), (6, -4, "umpire", "Kept?"), (6, 90, "author", "Kept!")]
ODD += [(7, k, ("user", "assistant")[k % 3 == 0], f"Turn {k % 5}{'.' * (k % 2)}") for k in range(14)]


@pytest.mark.parametrize("segment_rows", [4, 4096])
def test_odd_conversations(spark, tmp_dir, monkeypatch, segment_rows):
    monkeypatch.setattr(cr, "SEGMENT_ROWS", segment_rows)
    frame = spark.createDataFrame([(c, t, r, x, 1, "s") for c, t, r, x in ODD],
                                  "conv_id long, turn long, role string, text string, segment int, `a.b` string")
    frame.write.parquet(f"{tmp_dir}/conversations.parquet")
    assert told(cr.op11_conversation_repair(spark, tmp_dir)) == sorted(brute(ODD, {r[0] for r in ODD}), key=repr)


def test_empty_table(spark, tmp_dir):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    empty.write.parquet(f"{tmp_dir}/conversations.parquet")
    assert cr.op11_conversation_repair(spark, tmp_dir).count() == 0
    assert cr.repair(empty).turns.count() == 0


def test_one_hot_conversation_over_many_tasks(spark):
    """A conversation in many segments and tasks gives what it gives in one piece."""
    n = 3000
    frame = spark.range(n).selectExpr(
        "CAST(NULL AS long) AS conv_id", "id AS turn",
        "element_at(array('user','assistant','assistant','system','user'), CAST(hash(id) % 3 + 3 AS int)) AS role",
        "concat('text ', id % 700, if(id % 11 = 0, '', '.')) AS text")
    fixed = cr.repair(frame)
    report = fixed.report.collect()
    rows = sorted(((r.turn, r.role, r.text) for r in frame.collect()))
    seen, kinds = set(), ""
    for _, role, text in rows:
        kinds += "1" if (role, text) in seen else role[0].upper() if text[-1] != "." else role[0]
        seen.add((role, text))
    assert len(report) == 1
    assert (report[0].cost, report[0].audit) == cr.chosen([cr.parsed(kinds)])[:2]
    initials = "".join(r.role[0] for r in fixed.turns.orderBy("segment", "place").collect())
    assert WELL_FORMED.fullmatch(initials)
