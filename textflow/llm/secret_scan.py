"""Secret spans: fixed patterns, and a linear-chain conditional random field.

The field tags tokens as secret begin (B), inside (I) or outside (O). Tokens are
runs of ``[A-Za-z0-9+/_.=-]`` and single other characters; a token can be part of
a secret only if it has ``MIN_TOKEN`` or more characters, and a digit or a capital
after a small letter among them; all others, which is nearly all words, are O by
definition. Emission features are the token's shape, its neighbouring words and
figures of the whole file; transitions are learned between the three tags. As the
state at an O-only token is known, the Viterbi path of a whole text falls apart into
the paths of its runs of candidate tokens, which is how it is decoded: exactly, and
in time that follows the candidates.

No labels mark secrets, so the field learns from a bounded sample of documents: from
their pattern spans, and from copies into which secrets of many made-up shapes are
put, bare or behind words that the patterns don't know, beside as many decoys (dates,
numbers, paths, names of files and hosts) that are none. The neighbouring words are
hidden in a second copy of each example, so that neither shape nor context alone
decides.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col
from textflow.plans.catalog import table

MAX_TRAIN_DOCS = 2_000   # bound of the sample: the first documents by a hash of their id
MAX_TRAIN_RUNS = 4_000  # bound of the candidate runs learned from
MAX_RUN = 4              # longer runs are learned from in pieces (decoding has no bound)
PLANTED = 4              # secrets, and as many decoys, put into a document of the sample
MIN_TOKEN = 8
DIMS = 1 << 13           # hashed feature space
O, B, I = 0, 1, 2
KINDS = ("assign", "access", "hex", "crf")

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{MIN_TOKEN},}}")
_TELLING = re.compile(r"[0-9]|[a-z][A-Z]")
_NEIGHBOUR = re.compile(r"[^\W_]+|[=:\"'|,;@]")

_SPANS = "kinds array<string>, starts array<long>, ends array<long>"


def base_spans(text: str) -> list[tuple]:
    """``(start, kind index, end)`` of the fixed patterns, in that order.

    Access and hex patterns take the longest run at a place, so asking for the
    least length in the pattern drops just the failing matches. An assignment's
    failing match uses up its text, hence it is dropped after matching."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidate_runs(text: str) -> list[list[tuple]]:
    """Runs of candidate tokens ``(start, end)`` with only whitespace between."""
    runs: list[list[tuple]] = []
    for m in _CANDIDATE.finditer(text):
        if not _TELLING.search(text, m.start(), m.end()):
            continue
        if runs and text[runs[-1][-1][1]:m.start()].isspace():
            runs[-1].append(m.span())
        else:
            runs.append([m.span()])
    return runs


def _shape(token: str) -> list[str]:
    n = len(token)
    counts = {c: token.count(c) for c in set(token)}
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    upper = any(c.isupper() for c in token)
    lower = any(c.islower() for c in token)
    marks = sorted({c for c in token if not c.isalnum()})
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in token)
    short = re.sub(r"(.)\1+", r"\1", kinds)
    return [
        f"len{min(n // 8, 8)}", f"ent{int(entropy * 2)}", f"case{upper}{lower}", f"marks{''.join(marks)}",
        f"digits{int(4 * sum(c.isdigit() for c in token) / n)}", f"turns{min(len(short) // 4, 8)}",
        f"head{kinds[:4]}", f"tail{kinds[-3:]}", f"alldigits{token.isdigit()}", f"start{token[:3].lower()}",
    ]


def _words_before(text: str, at: int, n: int) -> list[str]:
    """The last ``n`` words before a place, however far they are."""
    size = 64
    while True:
        start = max(0, at - size)
        found = _NEIGHBOUR.findall(text[start:at])
        if start == 0 or len(found) > n:    # one more, as the first may be cut
            return [w.lower() for w in found[-n:]]
        size *= 4


def _words_after(text: str, at: int, n: int) -> list[str]:
    found = []
    for m in _NEIGHBOUR.finditer(text, at):
        found.append(m.group().lower())
        if len(found) == n:
            break
    return found


def features(text: str, runs: list[list[tuple]], context: bool = True) -> list[np.ndarray]:
    """Hashed feature indices of each token, one ``(tokens, features)`` array a run."""
    file_marks = [f"f_n{min(len(runs), 8)}", f"f_eq{min(text.count('='), 8)}", f"f_len{len(text).bit_length()}"]
    out = []
    for run in runs:
        rows = []
        for lo, hi in run:
            names = _shape(text[lo:hi])
            if context:
                before, after = _words_before(text, lo, 4), _words_after(text, hi, 2)
                before, after = ["<"] * (4 - len(before)) + before, after + [">"] * (2 - len(after))
                names += [f"b{4 - i}{w}" for i, w in enumerate(before)] + [f"n{w}" for w in before[1:]]
                names += [f"a{i}{w}" for i, w in enumerate(after)] + file_marks
            else:
                names += ["hidden"] * 12
            rows.append([zlib.crc32(x.encode("utf-8", "surrogatepass")) % DIMS for x in names])
        out.append(np.array(rows))
    return out


def viterbi(emit: np.ndarray, move: np.ndarray) -> list[int]:
    """Best tags of a run that stands between O tokens; I never follows O."""
    best = emit[0] + move[O]
    best[I] = -np.inf
    back = []
    for row in emit[1:]:
        step = best[:, None] + move
        step[O, I] = -np.inf
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + row
    tags = [int((best + move[:, O]).argmax())]
    for choice in reversed(back):
        tags.append(int(choice[tags[-1]]))
    return tags[::-1]


def gold(runs: list[list[tuple]], spans: list[tuple]) -> list[list[int]]:
    """Tags of the runs by the spans (sorted by start) that cover the tokens' ends."""
    out, ahead, open_ = [], 0, []
    for run in runs:
        tags, last = [], None
        for lo, hi in run:
            while ahead < len(spans) and spans[ahead][0] < hi:
                open_.append((spans[ahead][0], spans[ahead][2]))
                ahead += 1
            open_ = [x for x in open_ if x[1] >= hi]     # the others end before all tokens to come
            span = open_[0] if open_ else None
            tags.append(O if span is None else I if span == last else B)
            last = span
        out.append(tags)
    return out


# Made-up secrets and decoys: how each is drawn, from ``draw`` (a random.Random).
_SIGNS = {"62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "up": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
          "HEX": "0123456789ABCDEF", "low": "abcdefghijklmnopqrstuvwxyz0123456789", "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
          "9": "0123456789", "Aa": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"}


def _some(draw: random.Random, signs: str, low: int, high: int) -> str:
    return "".join(draw.choices(_SIGNS[signs], k=draw.randint(low, high)))


_SECRETS = (
    lambda d: _some(d, "62", 20, 48), lambda d: _some(d, "b64", 24, 64) + "=" * d.randint(0, 2), lambda d: _some(d, "HEX", 24, 40),
    lambda d: _some(d, "up", 20, 32), lambda d: _some(d, "low", 18, 40), lambda d: _some(d, "Aa", 20, 40),
    lambda d: f"{_some(d, 'low', 2, 4)}_{_some(d, 'low', 3, 5)}_{_some(d, '62', 16, 36)}",
    lambda d: f"{_some(d, 'low', 2, 4)}-{_some(d, '9', 8, 12)}-{_some(d, '62', 16, 24)}",
    lambda d: f"eyJ{_some(d, '62', 12, 24)}.eyJ{_some(d, '62', 16, 32)}.{_some(d, '62', 20, 43)}",
    lambda d: f"{_some(d, '62', 8, 12)}-{_some(d, '62', 8, 12)}", lambda d: f"{_some(d, '62', 10, 16)} {_some(d, '62', 10, 16)}",
    lambda d: "\n".join(_some(d, "b64", 32, 48) for _ in range(d.randint(2, 3))),
)
_DECOYS = (
    lambda d: f"{d.randint(1990, 2030)}-{d.randint(10, 12)}-{d.randint(10, 28)}", lambda d: f"{d.randint(2000, 2030)}-{d.randint(10, 12)}-{d.randint(10, 28)}T{d.randint(10, 23)}",
    lambda d: f"+{_some(d, '9', 8, 12)}", lambda d: f"{_some(d, '9', 3, 4)}-{_some(d, '9', 3, 4)}-{_some(d, '9', 3, 4)}", lambda d: _some(d, "9", 8, 16),
    lambda d: f"{d.randint(1, 40)}.{d.randint(0, 40)}.{d.randint(0, 999)}.{d.randint(100, 9999)}",
    lambda d: f"{d.choice(('report', 'image', 'chapter', 'invoice', 'section'))}{d.choice('-_.')}{_some(d, '9', 1, 6)}.{d.choice(('pdf', 'txt', 'html', 'jpeg'))}",
    lambda d: f"www{d.randint(1, 99)}.{d.choice(('example', 'server', 'library', 'archive'))}.{d.choice(('org', 'com', 'net'))}/{d.choice(('page', 'item', 'news'))}/{d.randint(1, 99999)}",
    lambda d: f"{d.choice(('get', 'set', 'load', 'parse', 'make'))}{d.choice(('User', 'File', 'Page', 'Item'))}{d.choice(('Name', 'List', 'Count', 'Data'))}",
    lambda d: f"{d.randint(1, 999)}.{_some(d, '9', 5, 9)}", lambda d: f"ISBN-{_some(d, '9', 10, 13)}",
    lambda d: f"{d.choice(('Mc', 'Mac', 'Von', 'De'))}{d.choice(('Donald', 'Gregor', 'Winter', 'Lander'))}{d.choice(('', 's', 'son'))}",
)
_BEFORE = ("", "", "auth ", "Bearer ", "key ", "credential: ", "pin = \"", "access ", "private key\n", "login:pass ", "use ", "is ")


def planted(text: str, draw: random.Random, n: int = PLANTED) -> tuple[str, list[tuple]]:
    """The text with ``n`` secrets and ``n`` decoys put in at spaces, and the spans
    ``(start, kind index, end)`` of the secrets."""
    spaces = [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
    puts = sorted((draw.choice(spaces), k) for k in range(2 * n))
    parts, spans, last, size = [], [], 0, 0
    for at, k in puts:
        lead = " " + draw.choice(_BEFORE)
        made = draw.choice(_SECRETS if k < n else _DECOYS)(draw)
        part = text[last:at] + lead + made + " "
        start = size + at - last + len(lead)
        if k < n:
            spans.append((start, 3, start + len(made)))
        parts.append(part)
        size, last = size + len(part), at
    return "".join(parts) + text[last:], spans


def train(runs: list[tuple], rounds: int = 120, rate: float = 0.3, ridge: float = 1e-3) -> tuple:
    """Weights ``(emission, transition)`` by gradient ascent on the field's
    log-likelihood (forward-backward, Adagrad). ``runs``: pairs of a feature
    array and tags. Without runs all weights are zero but a lean to O."""
    emission, move = np.zeros((DIMS, 3)), np.zeros((3, 3))
    if not runs:
        emission[:, O] = 1.0
        return emission, move
    longest = max(len(t) for _, t in runs)
    n, width = len(runs), runs[0][0].shape[1]
    index, tags = np.zeros((n, longest, width), int), np.zeros((n, longest), int)
    mask = np.zeros((n, longest), bool)
    for k, (x, t) in enumerate(runs):
        index[k, :len(t)], tags[k, :len(t)], mask[k, :len(t)] = x, t, True
    sizes = mask.sum(axis=1)
    rows = np.arange(n)
    target = np.eye(3)[tags] * mask[..., None]
    ban = np.zeros((3, 3))
    ban[O, I] = -1e9
    sum_e, sum_m = np.full_like(emission, 1e-8), np.full_like(move, 1e-8)
    for _ in range(rounds):
        scores, moves = emission[index].sum(axis=2), move + ban
        alpha, beta = np.zeros((n, longest, 3)), np.zeros((n, longest, 3))
        alpha[:, 0] = scores[:, 0] + moves[O]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves[None], axis=1) + scores[:, t]
        for t in range(longest - 1, -1, -1):
            last = (sizes - 1 == t)[:, None]
            after = (np.logaddexp.reduce(moves[None] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
                     if t + 1 < longest else 0.0)
            beta[:, t] = np.where(last, moves[:, O][None], after)
        total = np.logaddexp.reduce(alpha[rows, sizes - 1] + moves[:, O], axis=1)
        marginal = np.exp(np.clip(alpha + beta - total[:, None, None], -60, 0)) * mask[..., None]
        gap = target - marginal
        grad_e = np.stack([np.bincount(index.ravel(), np.repeat(gap[..., c].ravel(), width), DIMS) for c in range(3)], axis=1)
        grad_m = np.zeros_like(move)
        np.add.at(grad_m, (O, tags[:, 0]), 1.0)
        np.add.at(grad_m, (tags[rows, sizes - 1], O), 1.0)
        grad_m[O] -= marginal[:, 0].sum(axis=0)
        grad_m[:, O] -= marginal[rows, sizes - 1].sum(axis=0)
        for t in range(1, longest):
            on = mask[:, t]
            if on.any():
                np.add.at(grad_m, (tags[on, t - 1], tags[on, t]), 1.0)
                pair = alpha[on, t - 1, :, None] + moves[None] + (scores[on, t] + beta[on, t])[:, None, :]
                grad_m -= np.exp(np.clip(pair - total[on][:, None, None], -700, 0)).sum(axis=0)
        grad_e, grad_m = grad_e / n - ridge * emission, grad_m / n - ridge * move
        sum_e += grad_e ** 2
        sum_m += grad_m ** 2
        emission += rate * grad_e / np.sqrt(sum_e)
        move += rate * grad_m / np.sqrt(sum_m)
    return emission, move


def learn(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS, max_runs: int = MAX_TRAIN_RUNS) -> tuple:
    """The field's weights from a bounded sample: the first ``max_docs`` documents
    by a hash of their id, of which at most ``max_runs`` runs."""
    ids = (docs.select(col(docs, "doc_id").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect())
    spark = docs.sparkSession
    sample = spark.createDataFrame(ids, "doc_id long")

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"].fillna(""):
                mixed, put_in = planted(text, random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass"))))
                for version, spans in ((text, []), (mixed, put_in)):
                    runs = candidate_runs(version)
                    tags = gold(runs, sorted(base_spans(version) + spans))
                    for context in (True, False):
                        for x, t in zip(features(version, runs, context), tags):
                            rows += [(x[k:k + MAX_RUN].ravel().tolist(), t[k:k + MAX_RUN]) for k in range(0, len(t), MAX_RUN)]
            yield pd.DataFrame(rows, columns=["x", "t"])

    texts = docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").cast("string").alias("text"))
    found = (texts.join(F.broadcast(sample), "doc_id").mapInPandas(examples, "x array<int>, t array<int>")
             .orderBy(F.xxhash64("x", "t")).limit(max_runs).collect())
    return train([(np.array(r["x"]).reshape(len(r["t"]), -1), list(r["t"])) for r in found])


def spans_of(text: str | None, emission: np.ndarray, move: np.ndarray) -> list[tuple]:
    """``(start, kind index, end)``: the pattern spans, and the field's spans that
    touch none of them."""
    if not text:
        return []
    base = base_spans(text)
    found, ahead, reach = list(base), 0, 0
    runs = candidate_runs(text)
    for run, x in zip(runs, features(text, runs)):
        tags = viterbi(emission[x].sum(axis=1), move)
        for k, tag in enumerate(tags):
            if tag != B:
                continue
            stop = k
            while stop + 1 < len(tags) and tags[stop + 1] == I:
                stop += 1
            lo, hi = run[k][0], run[stop][1]
            # both lists ascend: pattern spans that begin before this one's end, and how far they reach
            while ahead < len(base) and base[ahead][0] < hi:
                reach = max(reach, base[ahead][2])
                ahead += 1
            if reach <= lo:
                found.append((lo, 3, hi))
    return sorted(found)


def secret_spans(docs: DataFrame, into: str, weights: tuple | None = None) -> DataFrame:
    """``docs`` with a struct column ``into`` of the spans of every whole text:
    ``kinds``, ``starts``, ``ends`` (code points, end exclusive), by start, then
    kind. A null or empty text has none; texts of any length are scanned whole, in
    time that follows their length; rows keep all their columns, repeated rows get
    equal spans; an empty table stays empty."""
    emission, move = learn(docs) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast((emission.astype(np.float64), move))

    @F.pandas_udf(_SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        emission, move = shared.value
        for texts in batches:
            found = [spans_of(t, emission, move) for t in texts]
            yield pd.DataFrame({"kinds": [[KINDS[k] for _, k, _ in f] for f in found],
                                "starts": [[s for s, _, _ in f] for f in found],
                                "ends": [[e for _, _, e in f] for f in found]})

    return docs.withColumn(into, scan(col(docs, "text").cast("string")))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string"))), ",")


@query("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_spans(docs, "found").select(
        "doc_id", F.arrays_zip("found.kinds", "found.starts", "found.ends").alias("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kinds"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kinds"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"), count("crf"))
