from helpers import ODD_TEXTS, odd_docs, SF01
from textflow.llm import mixing


def test_targets_against_rounds(spark):
    sizes = [("b", 10), ("a", 1000), (None, 7), ("é", 500), ("z", 3), ("c", 0), ("d", 90)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    ordered = sorted((s for s in sizes if s[0] is not None), key=lambda s: s[0]) + [(None, 7)]
    weight = {s: (5, 2, 1)[i % 3] for i, (s, _) in enumerate(ordered)}
    size, target, open_ = dict(sizes), {}, dict(sizes)
    left = 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
            del open_[s]
    target |= share
    assert set(got) == set(target)
    assert all(abs(got[s] - target[s]) < 1e-6 for s in target)


def test_taken_words_meet_the_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    first = mixing.mix(docs).toPandas()
    again = mixing.mix(docs.repartition(7, "n_chars")).toPandas()
    assert (first.taken <= 2 * first["size"]).all() and (first.taken >= 0).all()
    by = first.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken - by.target) <= 1).all()
    assert first.finish.is_monotonic_increasing
    key = ["doc_id", "taken", "finish"]
    assert first[key].sort_values("doc_id").reset_index(drop=True).equals(again[key].sort_values("doc_id").reset_index(drop=True))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = mixing.mix(docs)
    clash = {"size", "taken"}
    assert rows.columns == [c for c in docs.columns if c not in clash] + ["size", "source_size", "target", "taken", "finish"]
    got = rows.collect()
    assert len(got) == len(ODD_TEXTS)
    assert all(r["taken"] == 0 for r in got if not (r["text"] or "").strip(" \n\t\r"))
    assert {r["source"] for r in got} == {None, "s0", "s1", "s2"}
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, "s", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [r["taken"] for r in mixing.mix(blank).collect()] == [0, 0]


def test_equal_ids_and_missing_ids_give_the_same_mix_in_any_partitioning(spark):
    rows = [(None, "s", " ".join(f"w{k}" for _ in range(5 + k % 2))) for k in range(40)]
    rows += [(7, "t", f"a{k} b c") for k in range(30)] + [(k, "u", "x " * (k % 5)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    first, again = (sorted(((r.doc_id, r.text, r.taken) for r in mixing.mix(d).collect()), key=repr)
                    for d in (docs.coalesce(1), docs.repartition(9, "text").orderBy("text")))
    assert first == again and len(first) == len(rows)


def test_passes_come_at_target_rates(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    each, whole = mixing.passes(docs).toPandas(), mixing.mix(docs).toPandas()
    assert each.finish.is_monotonic_increasing and set(each["pass"]) == {1, 2} and (each.taken > 0).all()
    assert each.groupby("doc_id").taken.sum().to_dict() == whole[whole.taken > 0].set_index("doc_id").taken.to_dict()
    target = whole.groupby("source").target.first()
    largest = whole["size"].max()
    for part in (0.25, 0.5, 0.75):   # what finishes by then is that part of each source, but for one document
        so_far = each[each.finish <= part].groupby("source").taken.sum()
        assert (abs(so_far - part * target) <= largest + 1).all()
