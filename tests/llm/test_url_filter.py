import numpy as np
import pytest

from pyspark.sql import functions as F
from textflow.llm import url_filter as uf


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fits = [r for r in uf.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG", "http://a.example.org/", "https://x.example.org/es/1?q#f", "http://example.org/en/1",
        "http://example.org/en/19#a/b", "http://notexample.org/es/", "http://org/", "http://b.com/de/x", "http://b.com/fr/", "ftp://b.com?x=/de/",
        "http://h\n.net/p\nq?z", "http://É.net/es/", "://x.net/a", "a://b://c/d", "http://user@h.com:80/de/", "http://..net//"] + [
    f"http://s{i}.net/p{i % 7}" for i in range(300)]


@pytest.mark.parametrize("keys_a_shard, bytes_a_pass", [(200_000, 64 << 20), (40, 100)])
def test_verdicts(spark, keys_a_shard, bytes_a_pass):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] * 2, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("key", F.lit(2))
    listed = [f"s{i}.net" for i in range(0, 300, 3)] + ["s1.net /p1", "s2.net /p9", "net.absent", "", "com"]
    frame = spark.createDataFrame([(k,) for k in listed * 2 + [None]], "key string")
    rows = uf.judge_urls(pages, frame, keys_a_shard=keys_a_shard, bytes_a_pass=bytes_a_pass).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path = split(URLS[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        labels = host.split(".")
        keys = {".".join(labels[i:]) for i in range(len(labels))} | {f"{host} {path}"} if host else set()
        fit = rule(host, path)
        assert r["listed"] == bool(keys & set(listed)), URLS[r["page_id"]]
        assert r["rule"] == (fit and fit[0] + fit[1])
        assert r["verdict"] == (fit[2] if fit else "block" if keys & set(listed) else "allow")


def test_cascade_is_exact():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2, 30, 5000):
        h1, h2 = (draw.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        for share in (0.0, 0.01, 0.5, 1.0):
            listed = draw.random(n) < share
            levels = uf._unpacked(uf._packed(uf.build_cascade(h1, h2, listed)))
            assert (uf.in_cascade(levels, h1, h2) == listed).all()


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert uf.judge_urls(pages.limit(0), none).count() == 0
    assert [r["verdict"] for r in uf.judge_urls(pages, none).collect()] == ["allow"]
