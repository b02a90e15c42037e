import random
import re
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from cases import frame, rows, words  # noqa: E402

from newsledger.llm import components, embeddings, exact, minhash  # noqa: E402
from newsledger.llm.shared import stored  # noqa: E402


def roots(nodes, links):
    at = {n: n for n in nodes}

    def find(n):
        while at[n] != n:
            n = at[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    chosen = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 300)] + [(chosen.randrange(400, 600), chosen.randrange(600, 800)) for _ in range(250)] + [(900, 900)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = roots({n for link in links for n in link}, links)
    assert {r.node: r.component for r in got} == {n: c for n, c in want.items() if n != 900} and len(got) == len(want) - 1
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact(spark):
    docs = frame(spark)
    pairs = rows()
    for size in (16, 8192):
        got = exact.find(docs, size).collect()
        assert len(got) == len(pairs)
        groups = {}
        for i, t in pairs:
            groups.setdefault(t or "", []).append(i)
        sizes = sorted((len(g), max((i for i in g if i is not None), default=None) or -1) for g in groups.values() for _ in g)
        assert sorted((r.group_size, r.keep_id or -1) for r in got) == sizes
        assert sum(r.kept for r in got) == len(groups)
    kept = exact.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(groups)
    assert exact.find(frame(spark, [])).count() == 0 and exact.dedup(frame(spark, [])).count() == 0


def test_exact_is_native(spark):
    plan = exact.find(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(own[i:i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else ({tuple(own)} if own else set())


def expected_components(pairs):
    sets = [shingles(t) for _, t in pairs]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, roots(range(len(sets)), links)


def near_rows():
    chosen, out = random.Random(3), list(rows())
    base, passage, texts = words(50, 260).split(), words(51, 90), []
    for _ in range(330):  # more than a tile of near copies, each unlike the others
        own = list(base)
        for _ in range(chosen.randrange(1, 7)):
            own[chosen.randrange(len(own))] = f"w{chosen.randrange(10_000)}"
        texts.append(" ".join(own))
    texts += [words(1000 + k, 100) + " " + passage for k in range(60)] + [passage + " " + words(2000 + k, 30) for k in range(40)]
    chain = words(60, 400).split()
    texts += [" ".join(chain[20 * k:20 * k + 200]) for k in range(10)] + [" ".join(words(70, 9).split()[:n]) for n in range(1, 10)]
    return out + list(zip(range(100, 100 + len(texts)), texts))


def test_minhash(spark):
    pairs = near_rows()
    docs = frame(spark, pairs)
    got = minhash.find(docs).collect()
    sets, root = expected_components(pairs)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    want = sorted((i or -1, len(sets[k]), least.get(root[k], -1)) for k, (i, _) in enumerate(pairs))
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}
    assert minhash.find(frame(spark, [])).count() == 0


def test_lattice_decoder():
    points = np.random.default_rng(1).normal(size=(200, 8)) * 2
    home, around = embeddings.nearest_e8(points), embeddings.neighbours()
    assert around.shape == (240, 8) and np.allclose((around ** 2).sum(1), 2) and (2 * home % 1 == 0).all() and (home.sum(1) % 2 == 0).all()
    assert (((points - home) ** 2).sum(1) <= 1 + 1e-9).all()
    for v in around:
        assert (((points - home - v) ** 2).sum(1) >= ((points - home) ** 2).sum(1) - 1e-9).all()


def test_embeddings(spark):
    chosen = np.random.default_rng(2)
    unit = chosen.normal(size=(60, 24))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    vectors = list(unit) + [unit[0] * 3] * 4
    for k in range(700):  # more than a tile around one vector, some pairs on either side of the threshold
        vectors.append(unit[1] + chosen.normal(size=24) * chosen.uniform(0.005, 0.06))
    data = [(i, [float(x) for x in v], i % 2 if i < 60 else 1) for i, v in enumerate(vectors)]
    n = len(data)
    odd = [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 24, 1), (n + 3, [None] + [1.0] * 23, 1), (n + 4, [float("nan")] * 24, 1), (n + 5, [float("inf")] * 24, 1),
           (n + 6, data[1][1], None), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1), (None, data[3][1], 1), (n + 9, data[1][1], 0)]
    table = spark.createDataFrame([(*r, 1, 2) for r in data + odd], "vec_id long, embedding array<double>, label int, class int, cell int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(table).collect()}
    assert len(got) == len(data) + len(odd)
    m = np.array([v for _, v, _ in data])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    label = np.array([r[2] for r in data])
    close = (m @ m.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    root = roots(range(n), zip(*np.nonzero(close)))
    degrees = close.sum(1)
    degrees[3] += 1
    wrong = sum(int(got[i].n_links != degrees[i]) for i in range(n))
    assert wrong == 0
    assert all(got[i].component_id == root[i] and got[i].kept == (root[i] == i) for i in range(n))
    assert all((got[n + k].n_links, got[n + k].component_id) == (0, n + k) for k in (0, 1, 2, 3, 4, 5, 6, 9))
    assert got[n + 8].component_id == n + 7 and got[n + 7].n_links == 1
    assert got[None].component_id == 3 and not got[None].kept
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_components_of_few_links_take_few_tasks(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components, "stored", lambda df, name: made.append((name, stored(df, name))) or made[-1][1])
    links = [(k, k + 1) for k in range(0, 400) if k % 40] + [(1000, 1000 + k) for k in range(1, 200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    nodes = sorted({x for link in links for x in link})
    at = roots(range(len(nodes)), [(nodes.index(a), nodes.index(b)) for a, b in links])
    assert got == {x: nodes[at[k]] for k, x in enumerate(nodes)}
    assert all(len(df.inputFiles()) <= 1 for name, df in made if name != "links")


def test_minhash_keeps_families_of_one_component_out_of_round_two(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(minhash, "stored", lambda df, name: made.setdefault(name, stored(df, name)))
    seen = []
    monkeypatch.setattr(minhash, "components", lambda links: seen.append(links.filter("a <> b").count()) or components.components(links))
    base = words(80, 200).split()
    texts = [" ".join(base[:k] + [f"other{k}"] + base[k + 1:]) for k in range(0, 200, 5)]
    docs = frame(spark, list(enumerate(texts)))
    assert {r.component_id for r in minhash.find(docs).collect()} == {0}
    assert seen[0] > 0 and seen[1:] == [0] and made["families"].count() == 0
