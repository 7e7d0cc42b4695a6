import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartcast.llm import shard


def test_matrix_sums_and_law():
    rng = np.random.default_rng(1)
    for good, bad, n in ((5, 7, 6), (30, 3, 20), (1, 1, 1), (0, 9, 4), (400, 600, 100)):
        draws = np.array([shard.hypergeometric(rng, good, bad, n) for _ in range(4000)])
        mean = n * good / (good + bad)
        var = mean * bad / (good + bad) * (good + bad - n) / max(good + bad - 1, 1)
        assert abs(draws.mean() - mean) < 5 * (var / 4000) ** 0.5 + 1e-9 and abs(draws.var() - var) < 0.15 * var + 1e-9
    assert abs(shard.hypergeometric(rng, 10**11, 10**12, 10**9) / 10**9 - 1 / 11) < 1e-4
    parts, sizes = [50, 0, 13, 200], [88, 88, 87]
    m = np.array(shard.communication_matrix(parts, sizes, 3))
    assert m.sum(axis=1).tolist() == parts and m.sum(axis=0).tolist() == sizes and (m >= 0).all()


def _check(got, rows, n):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(by) <= set(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    size = [len(by[k]) for k in range(n)]
    assert max(size) - min(size) <= 1


def test_rows_in_shards(spark, monkeypatch):
    monkeypatch.setattr(shard, "ROWS", 40)
    rows = [(k, None if k % 9 == 0 else "é" * (k % 13)) for k in range(1000)] + [(None, "x")] * 300 + [(5, "éé")] * 3 + [(7, "long" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard.text_shards(df, 24).collect()
    _check(got, rows, 24)
    again = shard.text_shards(df.repartition(7), 24).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    other = shard.text_shards(df, 24, seed=9).collect()
    assert sorted(map(str, got)) != sorted(map(str, other))
    # neighbours don't stay together: the share of equal shards is that of chance
    at = {r.doc_id: (r.shard, r.slot) for r in got}
    same = sum(at[k][0] == at[k + 1][0] for k in range(999)) / 999
    assert same < 0.08
    assert abs(np.corrcoef(range(1000), [at[k][1] for k in range(1000)])[0, 1]) < 0.15


def test_few_rows_and_clashes(spark):
    for rows in ([], [(1, "a")], [(k, "b") for k in range(25)]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        _check(shard.text_shards(df, 24).collect(), rows, 24)
    with pytest.raises(ValueError):
        shard.place(spark.createDataFrame([(1, 2)], "a int, Slot int"), ["a"], 3)
    df = spark.createDataFrame([(k, "x") for k in range(50)], "a int, part_ string")
    assert shard.place(df, ["a"], 3).columns == ["a", "part_", "shard", "slot"]
