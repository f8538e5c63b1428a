"""SimHash near-duplicates by a binary trie self-join.

Fingerprints: the text's whole word shingles, hashed with XXH64, vote on each of
64 bits. Links: two fingerprints at most ``max_bits`` bits apart. The join walks
pairs of trie nodes together, adds up the bits in which their paths differ, and
drops a pair as soon as the sum exceeds the budget.

Spreading the trie over a cluster: of ``max_bits + 1`` equal blocks of bits at
least one is the same in two linked fingerprints. So the trie is built once for
each block, with that block's bits at its top; below the top only pairs of nodes
with the same block value are walked, and block values are what Spark
partitions by. Only distinct fingerprints take part (copies cost nothing more),
and a block value with more than ``max_node`` of them is cut into pieces by a
hash; every pair of pieces is then a pair of tries of its own, so that no task
holds more than two pieces and no link is lost.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name, row_hash, written
from textflow.llm.components import components
from textflow.plans.catalog import table

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BITS = 64
MAX_NODE = 8192          # distinct fingerprints below one trie top before it is cut into pieces
MAX_PAIRS = 1 << 20      # node pairs walked at once
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of a text (0 for a null text or one without
    words). Words are runs of other than ASCII whitespace, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    ones = np.zeros(BITS, dtype=np.int64)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    for start in range(0, n, SHINGLES_AT_ONCE):
        stop = min(n, start + SHINGLES_AT_ONCE)
        shifted = [words[start + i:stop + i] for i in range(k)]
        hashes = np.fromiter((digest(join(s), SEED) for s in zip(*shifted)), dtype="<u8", count=stop - start)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle_words: int = SHINGLE_WORDS):
    """The fingerprint of a text column as a (signed) long column."""

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.array([fingerprint(t, shingle_words) for t in batch], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return prints(text)


# --- the trie walk ----------------------------------------------------------

def trie_links(values: np.ndarray, pairs: np.ndarray, depth: int, budget: int):
    """Yield arrays ``(i, j)`` of positions of ``values`` whose bits differ in at
    most ``budget`` places.

    ``values`` (uint64) is ascending within each node. A row of ``pairs`` is a
    pair of nodes ``(lo1, hi1, lo2, hi2)`` -- ranges of ``values`` that agree in
    their first ``depth`` bits; equal ranges stand for a node with itself.
    Node pairs go down one bit at a time: children on the same side keep the
    sum of differing bits, children on opposite sides add one, and pairs over
    the budget end there. Two single leaves are compared at once."""
    ones_before: dict[int, np.ndarray] = {}

    def split(level: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if level not in ones_before:
            bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones_before[level] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        ones = ones_before[level]
        return hi - (ones[hi] - ones[lo])

    stack = [(depth, pairs.astype(np.int64), np.zeros(len(pairs), dtype=np.int64))]
    while stack:
        level, nodes, differ = stack.pop()
        if len(nodes) > MAX_PAIRS:
            half = len(nodes) // 2
            stack += [(level, nodes[:half], differ[:half]), (level, nodes[half:], differ[half:])]
            continue
        lo1, hi1, lo2, hi2 = nodes.T
        itself = (lo1 == lo2) & (hi1 == hi2)
        leaves = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        if (ends := leaves & ~itself).any():
            i, j = lo1[ends], lo2[ends]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            if near.any():
                yield i[near], j[near]
        if (ends := (level == BITS) & ~leaves & ~itself).any():  # equal values: not among distinct ones
            raise ValueError("values repeat")
        if not (go := ~leaves).any():
            continue
        lo1, hi1, lo2, hi2, itself, differ = lo1[go], hi1[go], lo2[go], hi2[go], itself[go], differ[go]
        mid1, mid2 = split(level, lo1, hi1), split(level, lo2, hi2)
        below = [
            (lo1, mid1, lo2, mid2, differ, None),
            (mid1, hi1, mid2, hi2, differ, None),
            (lo1, mid1, mid2, hi2, differ + 1, None),
            (mid1, hi1, lo2, mid2, differ + 1, ~itself),
        ]
        nodes, sums = [], []
        for a, b, c, d, s, only in below:
            keep = (a < b) & (c < d) & (s <= budget)
            if only is not None:
                keep &= only
            nodes.append(np.stack([a[keep], b[keep], c[keep], d[keep]], axis=1))
            sums.append(s[keep])
        nodes, sums = np.concatenate(nodes), np.concatenate(sums)
        if len(nodes):
            stack.append((level + 1, nodes, sums))


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of the pairs ``(i, j)`` in ``parent`` (smallest position as root)."""
    def find(x):
        while True:
            up = parent[x]
            if (parent[up] == up).all():
                return up
            parent[x] = parent[up]

    while len(i):
        a, b = find(i), find(j)
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _forest(budget: int, block_bits: int):
    """For ``mapInPandas`` over rows sorted by trie and value: the links found
    in each trie, as a forest of at most one edge a value."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        turned = rows["turned"].to_numpy().view(np.uint64)
        key = rows[["block", "top", "p", "q"]].to_numpy()
        side = rows["side"].to_numpy()
        new_trie = np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))
        new_node = new_trie | np.concatenate(([True], side[1:] != side[:-1]))
        starts = np.flatnonzero(new_node)
        ends = np.concatenate((starts[1:], [len(rows)]))
        p, q = key[starts, 2], key[starts, 3]
        alone = p == q
        first = np.flatnonzero(~alone & (side[starts] == 0))
        first = first[first + 1 < len(starts)]
        first = first[~new_trie[starts[first + 1]]]
        pairs = np.concatenate([
            np.stack([starts[alone], ends[alone], starts[alone], ends[alone]], axis=1),
            np.stack([starts[first], ends[first], starts[first + 1], ends[first + 1]], axis=1),
        ])
        parent = np.arange(len(rows))
        for i, j in trie_links(turned, pairs, block_bits, budget):
            _merge(parent, i, j)
        while (up := parent[parent] != parent).any():
            parent[up] = parent[parent[up]]
        hung = np.flatnonzero(parent != np.arange(len(rows)))
        value = rows["fp"].to_numpy()
        return pd.DataFrame({"u": value[hung], "v": value[parent[hung]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            # the last trie of a batch may go on in the next one
            last = batch[["block", "top", "p", "q"]].iloc[-1]
            same = (batch[["block", "top", "p", "q"]] == last).all(axis=1).to_numpy()
            cut = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut == 0 and held:
                prior = held[-1][["block", "top", "p", "q"]].iloc[-1]
                if (prior == last).all():
                    held.append(batch)
                    continue
                yield links(pd.concat(held, ignore_index=True))
                held = [batch]
                continue
            done = [*held, batch.iloc[:cut]]
            if sum(map(len, done)):
                yield links(pd.concat(done, ignore_index=True))
            held = [batch.iloc[cut:]]
        if held and sum(map(len, held)):
            yield links(pd.concat(held, ignore_index=True))

    return run


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, max_node: int = MAX_NODE) -> DataFrame:
    """``(u, v)``: edges between the distinct values of ``prints.fp`` (long) whose
    connected components are those of "at most ``max_bits`` bits apart"."""
    blocks = max_bits + 1
    block_bits = BITS // blocks
    distinct = prints.select("fp").where("fp IS NOT NULL").distinct()
    turns = [
        F.struct(
            F.lit(b).alias("block"),
            (F.shiftleft("fp", b * block_bits).bitwiseOR(F.shiftrightunsigned("fp", BITS - b * block_bits))
             if b else F.col("fp")).alias("turned"),
        )
        for b in range(blocks)
    ]
    turned = distinct.select("fp", F.explode(F.array(*turns)).alias("t")).select(
        "fp", "t.block", "t.turned",
        F.shiftrightunsigned("t.turned", BITS - block_bits).cast("int").alias("top"))
    pieces = (turned.groupBy("block", "top").count()
              .select("block", "top", F.ceil(F.col("count") / F.lit(max_node)).cast("int").alias("pieces")))
    # one more key column, so that AQE may split a large block value in the join
    sized = turned.join(pieces, ["block", "top"]).withColumn(
        "piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    paired = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "block", "top", "fp", "turned",
        F.least("piece", "other").alias("p"), F.greatest("piece", "other").alias("q"),
        (F.col("piece") > F.col("other")).cast("int").alias("side"))
    tries = paired.repartition("block", "top", "p", "q").sortWithinPartitions(
        "block", "top", "p", "q", "side", "turned")
    return tries.mapInPandas(_forest(max_bits, block_bits), "u long, v long")


def _rooted(docs: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """``(doc_id, row, fp, root, component_id)``, one row for each of ``docs``."""
    prints = written(docs.select(
        col(docs, "doc_id").alias("doc_id"), row_hash(docs).alias("row"),
        fingerprint_column(col(docs, "text").cast("string"), shingle_words).alias("fp")), "simhash")
    roots = components(near_links(prints, max_bits))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    hung = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = hung.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = hung.join(named, "root").select("fp", "root", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "row", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links,
    the document's own included. A null text counts as one without words:
    fingerprint 0, linked like any other. A null ``doc_id`` gets a row and never
    is a component's smallest unless no other is there (then it is null).
    Repeated rows each get a row; other columns are ignored; an empty table
    gives an empty one."""
    return _rooted(docs, shingle_words, max_bits).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each near-duplicate component: that with the
    smallest ``doc_id``, a null one last; of rows that repeat the id that with
    the smallest row hash, of wholly equal rows one. All columns are returned
    as they are."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    keep = (_rooted(docs, shingle_words, max_bits).groupBy("root").agg(first.alias("first"))
            .select(F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")).distinct())
    row = private_name(docs, "row")
    keyed = docs.withColumn(row, row_hash(docs))
    same = col(keyed, "doc_id").eqNullSafe(keep["keep_id"]) & (keyed[row] == keep["keep_row"])
    # AQE may make this a broadcast only below its own size threshold
    return keyed.join(keep, same, "left_semi").dropDuplicates(["doc_id", row]).drop(row)


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
