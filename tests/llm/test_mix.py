import random
import re

from cartcast.llm import mix


def _fill(sizes, weights, most=3):
    """Targets by capping and resharing until none is above."""
    total, capped = sum(sizes), {}
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        rest = total - sum(capped.values())
        t = {k: rest * weights[k] / sum(weights[j] for j in free) for k in free}
        over = [k for k in free if t[k] > most * sizes[k]]
        if not over:
            return [capped.get(k, t.get(k)) for k in range(len(sizes))]
        capped |= {k: most * sizes[k] for k in over}


def test_targets_and_takings(spark):
    rnd = random.Random(2)
    rows = []
    for s, n in (("b", 300), ("a", 10), ("é", 60), (None, 40), ("zz", 1), ("w/o", 2)):
        for _ in range(n):
            words = 0 if s == "w/o" else rnd.choice([0, 1, 5, 40, 300])
            rows.append((len(rows) if rnd.random() < 0.95 else None, rnd.choice([" ", "\n\t "]).join(["é?"] * words) if words or rnd.random() < 0.5 else None, s, 1))
    rows += [rows[0]] * 20 + [rows[320]] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    pieces, taken = mix.mix(df)
    got, again = taken.collect(), mix.mix(df.repartition(5))[1].collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.id), str(r.source), r.size) for r in got) == sorted((str(i), str(s), count(t)) for i, t, s, _ in rows)
    order = ["a", "b", "w/o", "zz", "é", None]
    size = {s: sum(count(t) for _, t, x, _ in rows if x == s) for s in order}
    want = dict(zip(order, _fill([size[s] for s in order], [5, 2, 1, 5, 2, 1]), strict=True))
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == size[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 0.5 + 1e-6
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
    p = pieces.toPandas()
    assert p.words.sum() == sum(r.taken for r in got) and p.slot.nunique() >= p.slot.max() * 0.95
    # every stretch of the mix holds the sources near their shares
    total = sum(want.values())
    for a in range(0, int(p.slot.max()), 200):
        part = p[(p.slot >= a) & (p.slot < a + 200)]
        if part.slot.nunique() == 200:
            for place, s in enumerate(order):
                assert abs(part[part.place == place].slot.nunique() / 200 - want[s] / total) < 0.06


def test_no_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r)[0:1] + (r.size, r.target, r.taken) for r in mix.mix(df)[1].collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mix.mix(df.limit(0))[1].collect() == []


def test_schedule_ranks(spark):
    goal = spark.createDataFrame([("a", 0, 10, 30.0, 0.0), ("b", 1, 70, 70.0, 30.0)], "source string, place int, source_size long, target double, below double")
    for n in (1, 2, 3, 100, 20_000):
        rows = sorted(mix.schedule(goal, n).collect())
        assert [r.slot for r in rows] == list(range(n))
        for place in (0, 1):
            assert [r["rank"] for r in rows if r.place == place] == list(range(sum(r.place == place for r in rows)))
        assert abs(sum(r.place == 0 for r in rows) - 0.3 * n) <= 2


def test_many_small_sources(spark):
    """2,000 sources of three words beside a large one: each takes its target, and they are spread over the mix."""
    rows = [(k, "one two three", f"s{k:05d}") for k in range(2000)] + [(5000 + k, "w " * 300, "zz") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    pieces, taken = mix.mix(df)
    got = taken.collect()
    small = [r for r in got if r.source != "zz"]
    assert len(small) == 2000 and all(abs(r.taken - r.target) <= 0.5 + 1e-6 for r in small) and min(r.taken for r in small) == 9
    assert abs(sum(r.taken for r in got) - 66_000) < 1000
    slots = sorted(r.slot for r in pieces.where("source <> 'zz'").select("slot").collect())
    top = pieces.agg({"slot": "max"}).first()[0]
    tenths = [sum(a <= s < a + top / 10 for s in slots) / len(slots) for a in (k * top / 10 for k in range(10))]
    assert min(tenths) > 0.05
