import random
import re

from cartcast.llm import jaccard


def brute(rows, n=5, percent=75):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()))
    up = {i: i for i, _ in sets if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def _rows(df, **kw):
    return sorted(((r[0], r[1], r[2]) for r in jaccard.near_duplicates(df, **kw).collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    passage = rnd.choices(words, k=40)
    rows, i = [], 0
    for _ in range(40):
        base = rnd.choices(words, k=rnd.choice([3, 5, 6, 8, 20, 60, 200]))
        if rnd.random() < 0.5:
            base = base[:10] + passage + base[10:]
        for _ in range(rnd.choice([1, 1, 2, 6])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            rows.append((i * 7 % 1009, rnd.choice([" ", "\n", "\t  "]).join(t).upper() if rnd.random() < 0.3 else " ".join(t)))
            i += 1
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (None, rows[0][1]), (2003, "one"), (2004, "ONE"), (2005, "É a"), (2006, "é a"), rows[0], rows[1]]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, node long")
    assert _rows(df) == brute(rows)


def test_chain_of_near_copies_and_large_tiles(spark):
    rnd = random.Random(4)
    t = [f"a{k}" for k in range(80)]
    rows = []
    for k in range(60):  # each differs from the one before by a word, the ends from each other by most
        t = [*t]
        t[(k * 7) % 80] = f"b{k}"
        rows.append((100 - k, " ".join(t)))
    shared = [f"s{k}" for k in range(12)]
    rows += [(1000 + k, " ".join(shared + rnd.choices(["x", "y", "z"], k=4))) for k in range(700)]
    rows += [(3000 + k, " ".join(f"u{rnd.randrange(10**6)}" for _ in range(30))) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(df) == brute(rows)


def test_blocks_of_a_tile(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    test_against_brute_force(spark)


def test_links_followed_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(5000)}" for _ in range(150)]
    rows = []
    for k in range(500):  # near copies, of which many pairs link and many don't
        t = [*base]
        for _ in range(min(12, int(rnd.expovariate(1 / 3)))):
            t[rnd.randrange(150)] = f"x{rnd.randrange(10**6)}"
        rows.append((k, " ".join(t)))
    followed, compared, components, kept = [], [], jaccard.components, jaccard.kept

    def spied(links):
        followed.append(links.count())
        return components(links)

    def written(df, name, **options):
        out = kept(df, name, **options)
        if name == "jaccard-more":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "components", spied)
    monkeypatch.setattr(jaccard, "kept", written)
    assert _rows(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    classes = len({t for _, t in rows})
    assert sum(followed) <= 2 * classes and compared[0] <= classes, (followed, compared, classes)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(df).collect() == []
    assert _rows(spark.createDataFrame([(5, None)], "doc_id long, text string")) == [(5, 0, 5)]
