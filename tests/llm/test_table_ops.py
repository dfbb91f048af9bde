"""Jaccard join, vectors, sharding, lines, URL filters and mixing against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.llm import components, jaccard, lines, mixing, sharding, urls, vectors


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(25)] + [(200, 200 + i) for i in range(30)] + [(7, 7)] * 3
    edges = spark.createDataFrame([*pairs, (None, 4), (5, None)], "a long, b long")
    got = {x.node: x.component for x in components.connected_components(edges).collect()}
    assert got == union(pairs, {n for p in pairs for n in p})
    assert components.connected_components(edges.limit(0)).count() == 0


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def plain_sets(rows, k=5):
    out = []
    for _, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        out.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def plain_groups(rows, k=5):
    sets = plain_sets(rows, k)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    top = union(links, range(len(rows)))
    first = {}
    for n, t in top.items():
        if rows[n][0] is not None:
            first[t] = min(first.get(t, rows[n][0]), rows[n][0])
    return Counter((rows[n][0], len(sets[n]), first.get(t) if sets[n] else rows[n][0]) for n, t in top.items())


def check_groups(make_docs, rows, k=5):
    got = jaccard.near_duplicate_groups(make_docs(rows).repartition(4), k).collect()
    assert Counter((g.doc_id, g.n_shingles, g.component_id) for g in got) == plain_groups(rows, k)


def test_jaccard_join_is_exact(make_docs, corpus):
    check_groups(make_docs, corpus)


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_join_of_small_sets_and_ties(make_docs, seed):
    """Short texts over few words: light sets, shared shingles, pairs right at the threshold."""
    r = random.Random(seed)
    base = [[r.choice("abcd") for _ in range(r.randint(1, 24))] for _ in range(25)]
    rows = []
    for i in range(160):
        w = list(r.choice(base))
        for _ in range(r.choice((0, 0, 1, 1, 2))):
            w[r.randrange(len(w))] = r.choice("abcdefgh")
        rows.append((i, " ".join(w), "s"))
    check_groups(make_docs, rows, k=2)


@pytest.mark.parametrize("boundary", [0, 6, 64])
def test_any_boundary_gives_the_same_links(make_docs, monkeypatch, boundary):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randint(2, 14))), "s") for i in range(120)]
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *a: boundary)
    check_groups(make_docs, rows, k=2)


def test_boundary_follows_the_cost():
    flat = np.ones(1 << jaccard.SKETCH_BITS, np.int64)
    hot = flat.copy()
    hot[:20] = 1_000_000
    assert jaccard.choose_boundary({8: 100}, hot, 75) > jaccard.choose_boundary({40: 100}, flat, 75) == 0
    assert jaccard.prefix_length(1, 75, 2) == 1 and jaccard.prefix_length(8, 75, 1) == 3


def test_keep_one_each(make_docs, corpus):
    docs = make_docs(corpus)
    kept = jaccard.keep_one_each(docs)
    want = [r for r in corpus if r[0] is None or (r[0], r[0]) in {(a, c) for a, _, c in plain_groups(corpus)}]
    assert kept.columns == docs.columns
    assert Counter(kept.select("doc_id", "text", "source").collect()) == Counter(want)
    assert jaccard.keep_one_each(docs.limit(0)).count() == 0


def test_keep_one_each_decides_by_row(make_docs):
    a, b = "one two three four five six seven", "alpha beta gamma delta epsilon zeta eta"
    kept = jaccard.keep_one_each(make_docs([(83, a, "s"), (83, b, "s"), (90, a, "s"), (5, b, "s")])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, b), (83, a)]


def plain_vectors(rows, threshold=0.9):
    ok = [i for i, (n, v) in enumerate(rows) if n is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in ok}
    links = [(i, j) for i in ok for j in ok if i < j and len(x[i]) == len(x[j])
             and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= threshold]
    n = Counter(i for p in links for i in p)
    top = union(links, range(len(rows)))
    first = {}
    for i, t in top.items():
        if rows[i][0] is not None:
            first[t] = min(first.get(t, rows[i][0]), rows[i][0])
    return Counter((rows[i][0], n[i], first.get(t)) for i, t in top.items())


@pytest.mark.parametrize("block", [1024, 40])
def test_vectors_against_brute_force(spark, block):
    r = np.random.default_rng(4)
    rows = [(i, r.standard_normal(32).tolist()) for i in range(150)]
    centre = r.standard_normal(32)
    rows += [(200 + i, (centre + 0.12 * r.standard_normal(32)).tolist()) for i in range(90)]  # tight: blocks count at once
    wide = r.standard_normal(32)
    rows += [(300 + i, (wide + 0.33 * r.standard_normal(32)).tolist()) for i in range(60)]  # around the threshold
    rows += [(400 + i, rows[3][1]) for i in range(5)] + [(400, rows[3][1])]
    rows += [(500, None), (501, []), (502, [0.0] * 32), (503, [float("nan")] + [1.0] * 31), (504, [None] + [1.0] * 31),
             (505, [float("inf")] * 32), (506, [1.0] * 16), (507, [2.0] * 16), (None, rows[3][1])]
    df = spark.createDataFrame([(n, v, 1, "x", 2) for n, v in rows], "vec_id long, embedding array<float>, label int, v string, size int")
    out = vectors.near_duplicates(df, vectors.PassParams(block=block, window=32, recall=0.999)).collect()
    got, want = Counter((o.vec_id, o.n_links, o.component_id) for o in out), plain_vectors(rows)
    total = lambda c: sum(n * k for (_, n, _), k in c.items())
    assert len(out) == len(rows) and total(got) <= total(want) and total(got) >= 0.97 * total(want)
    exact = lambda c: {x for x in c if x[0] is None or not 300 <= x[0] < 400}
    assert exact(got) == exact(want)
    assert all(o.kept == (o.vec_id is not None and o.vec_id == o.component_id) for o in out)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_in_a_crowded_direction(spark):
    """The production parameters where a third of the rows lie in one cone: planted pairs just above the threshold."""
    r = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(r.standard_normal((9000, 64)))
    x[:3000] = unit(x[:3000] + 1.2 * unit(r.standard_normal(64)))
    at = r.choice(3000, 400, replace=False)
    side = r.standard_normal((400, 64))
    side = unit(side - (side * x[at]).sum(axis=1, keepdims=True) * x[at])
    y = 0.905 * x[at] + np.sqrt(1 - 0.905 ** 2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([x, y]))]
    out = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    top = {o.vec_id: o.component_id for o in out.collect()}
    met = sum(top[int(i)] == top[9000 + k] for k, i in enumerate(at)) / len(at)
    assert met >= vectors.PassParams().recall, met


def cone(r, n, d):
    x = r.standard_normal((n, d))
    x[:n // 3] += 1.2 * r.standard_normal(d)
    return x


@pytest.mark.parametrize("shape", ["even", "cone", "common mean"])
def test_vectors_recall(spark, shape):
    """Every linked pair of brute force on three shapes of tables, with near copies at all cosines from 0.88 up."""
    r = np.random.default_rng(9)
    x = {"even": lambda: r.standard_normal((6000, 48)), "cone": lambda: cone(r, 6000, 48),
         "common mean": lambda: r.standard_normal((6000, 48)) + 1.0}[shape]()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    at = r.choice(6000, 600, replace=False)
    side = r.standard_normal((600, 48))
    side -= (side * x[at]).sum(axis=1, keepdims=True) * x[at]
    cos = r.uniform(0.88, 1, 600)[:, None]
    x = np.vstack([x, cos * x[at] + np.sqrt(1 - cos ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = {o.vec_id: o for o in vectors.near_duplicates(df.repartition(4)).collect()}
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    links, met = int(near.sum()), sum(o.n_links for o in out.values())
    assert met <= links and met >= 0.97 * links, (met, links)
    top = union(list(zip(*np.nonzero(np.triu(near)))), range(len(x)))
    for i, o in out.items():  # no component joins what brute force keeps apart
        assert top[i] == top[o.component_id]


def test_vector_codes_bound_the_cosine():
    r = np.random.default_rng(2)
    x = vectors._unit(np.vstack([r.standard_normal((400, 24)), 1e200 * r.standard_normal((4, 24)), 1e-200 * np.eye(24)[:4]]))
    codes = np.concatenate([vectors._codes(x), vectors._codes(x[::-1])])
    both = np.vstack([x, x[::-1]])
    p = vectors.PassParams(threshold=0.3, window=900)
    i, j, sure = vectors._window_links(codes, 0, p)
    exact = (both @ both.T >= 0.3)
    assert exact[i[sure], j[sure]].all()
    assert {(a, b) for a, b in zip(*np.nonzero(np.tril(exact, -1)))} <= set(zip(i, j))


def test_vector_ranges_meet_at_their_ends(spark):
    """Ranges of fewer rows than a window lose no neighbour."""
    r = np.random.default_rng(3)
    centre = r.standard_normal(16)
    rows = [(i, (centre + 0.05 * r.standard_normal(16)).tolist()) for i in range(700)]
    p, tmp = vectors.PassParams(window=64), vectors.Scratch(spark, "t_ends")
    classes = spark.createDataFrame(rows, "id long, v array<double>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = vectors._pass_edges(classes, 1, 0, p, tmp)
        top = union([(e.a, e.b) for e in edges.collect()], range(700))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(top.values()) == {0}


def test_passes_grow_slowly_with_rows():
    p = vectors.PassParams()
    assert p.passes(0) == p.passes(100) == 1 and p.passes(10**5) < p.passes(10**9) < 200


def test_sharding(make_docs, corpus):
    out = sharding.place(make_docs(corpus).repartition(5)).collect()
    assert len(out) == len(corpus)
    by_id, slots = defaultdict(set), defaultdict(list)
    for o in out:
        by_id[o.doc_id].add(o.shard)
        slots[o.shard].append(o.slot)
        assert o.law == "key" and 0 <= o.shard < 8 and o.grown_shard in (o.shard, 8)
    assert all(len(s) == 1 for s in by_id.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t, _ in corpus)
    assert Counter((o.doc_id, o["size"], o.text_crc32) for o in out) == want
    assert sharding.place(make_docs(corpus).limit(0)).count() == 0
    assert sharding.place(make_docs(corpus), keep=["doc_id"]).columns == ["doc_id", *sharding.ADDED]
    # slots follow the input, not the ids
    ordered = sharding.place(make_docs([(i % 3, str(i), "s") for i in range(90)]).coalesce(1)).collect()
    assert all([int(o.text) for o in sorted(ordered, key=lambda o: o.slot) if o.shard == s] == sorted(int(o.text) for o in ordered if o.shard == s)
               for s in range(8))


def test_tree_confines_movement(spark):
    ids = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    tree = sharding.even_tree(8)
    more = {**tree, "region1": {"rack2": {4: 1.0, 5: 3.0}, "rack3": tree["region1"]["rack3"]}}
    two = ids.select(sharding.shard_of(F.col("k"), tree).alias("a"), sharding.shard_of(F.col("k"), more).alias("b"))
    rows = two.groupBy("a", "b").count().collect()
    size = Counter()
    for r in rows:
        size[r.a] += r["count"]
        if r.a != r.b:  # only into the heavier region, rack and shard's subtrees
            assert r.b >= 4 and (r.a < 4 or r.b == 5 or r.a in (6, 7) and r.b in (4, 5))
    assert all(4600 < n < 5400 for n in size.values())
    weighted = Counter()
    for r in rows:
        weighted[r.b] += r["count"]
    assert abs(weighted[5] / 40_000 - 0.3) < 0.02
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("k"), {"r": {"k": {0: 0.0}}})


def plain_lines(rows, chars=40, least=5):
    held = defaultdict(set)
    key = lambda x: lower(x.strip(" \t\n\x0b\f\r"))
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= chars:
                held[key(x)].add(i)
    out = Counter()
    for i, t, _ in rows:
        ls = (t or "").split("\n")
        stay = [x for x in ls if i is None or len(held.get(key(x), ())) < least or max(held[key(x)]) == i]
        out[i, len(ls), len(ls) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()] += 1
    return out


def test_line_dedup(make_docs, corpus):
    long = "\n".join(f"a line of its own with the number {i % 400} and forty characters" for i in range(1500))
    rows = corpus + [(300 + i, long, "s") for i in range(6)] + [(400, long.upper() + "\n", "s")]
    out = lines.dedup_lines(make_docs(rows).repartition(4))
    got = out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("sha"), "key").collect()
    assert Counter((g.doc_id, g.n_lines, g.n_dropped, g.sha) for g in got) == plain_lines(rows)
    assert lines.dedup_lines(make_docs(rows).limit(0)).count() == 0
    assert max(len(r.drops) for r in out.where("drops is not null").collect()) <= 24  # 64 lines a word


def test_line_dedup_cuts_frequent_lines_into_blocks(spark, make_docs, corpus):
    docs = make_docs(corpus + [(300 + i, "\n" * (i * 70) + "one very frequent line that a great many documents hold", "s") for i in range(60)])
    whole, cut = (lines.drop_bitmaps(docs, block_rows=n).collect() for n in (1 << 13, 4))
    assert len(whole) > 80 and sorted(map(str, whole)) == sorted(map(str, cut))
    drops = {r.doc_id: r.drops for r in cut}
    assert 359 not in drops and all(sum(w.bit_count() for w in [x % (1 << 64) for x in drops[300 + i]]) == 1 for i in range(59))


def test_line_dedup_streams_sorted_ranges(make_docs, corpus, capsys):
    from tabflow.llm.scratch import Scratch

    plans, save = [], Scratch.save
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Scratch, "save", lambda self, df, name: (plans.append((name, df)), save(self, df, name))[1])
        lines.drop_bitmaps(make_docs(corpus))
    seen = dict(plans)["seen"]
    seen.explain("simple")
    plan = capsys.readouterr().out
    assert "rangepartitioning(k1" in plan and "Exchange hashpartitioning(k1" not in plan and plan.count("Window [") == 2


def test_line_dedup_of_very_many_lines(make_docs):
    text = "\n".join(f"a line of its own with the number {i} and forty characters" for i in range(160_000))
    out = lines.dedup_lines(make_docs([(i, text, "s") for i in range(5)])).select("doc_id", "n_dropped", F.length("kept").alias("n")).collect()
    assert {r.doc_id: (r.n_dropped, r.n) for r in out} == {i: (160_000, 0) if i < 4 else (0, len(text)) for i in range(5)}


def test_url_filters(spark):
    r = random.Random(8)
    hosts = ["a.b.example.com", "b.example.com", "c.example.org", "localhost", "10.0.3.4"]
    urls_ = [f"https://{h}/x" for h in hosts] + ["HTTP://u:p@B.Example.com.:80/?q", "not a url", None, ""]
    caps = [(i, r.choice(urls_), r.randrange(0, 400 * 86_400)) for i in range(400)] + [(900, urls_[0], None), (900, urls_[0], None)]
    hist = [(e, r.randrange(0, 380 * 86_400), bool(r.getrandbits(1))) for e in ["example.com", "b.example.com", "a.b.example.com", "localhost", "com"] for _ in range(9)]
    hist += [("example.org", 50, True), ("example.org", 50, False), ("3.4", 60, True), ("c.example.org", 86_400 * 30, True), (None, 1, True), ("x", None, True), ("y", 1, None)]
    cdf = spark.createDataFrame([(*c, "x", "y") for c in caps], "id long, url string, fetched long, entry string, since string")
    hdf = spark.createDataFrame(hist, "entry string, at long, listed boolean")

    def state(entry, at):
        past = sorted((t, v) for e, t, v in hist if e == entry and t is not None and v is not None and t <= at)
        if not past:
            return None
        turns = {}
        for t, v in past:
            turns[t] = turns.get(t, True) and v
        since = None
        for t in sorted(turns):
            since = (since if since is not None else t) if turns[t] else None
        return since

    def judged(url, at):
        m = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
        host = m[1].lower().rstrip(".") if m else None
        if host and at is not None:
            labels = host.split(".")
            for i in range(1 if host == "10.0.3.4" else max(1, len(labels) - 1)):
                entry = ".".join(labels[i:])
                if (s := state(entry, at)) is not None:
                    return host, True, entry, s
        return host, False, None, None

    got = Counter((g.id, g.host, g.blocked, g.entry, g.since) for g in urls.judge(cdf, hdf).collect())
    assert got == Counter((i, *judged(u, at)) for i, u, at in caps)
    assert sum(n for (_, _, b, _, _), n in got.items() if b) > 50
    assert urls.judge(cdf.limit(0), hdf).count() == 0 and not urls.judge(cdf, hdf.limit(0)).where("blocked").count()


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        left, w = budget - sum(full.values()), sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / w > 2 * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / w for s in rest}
        full |= {s: 2 * sizes[s] for s in over}


def test_mixing(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)
    docs = make_docs(corpus)
    out = mixing.mix(docs.repartition(4)).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    row = lambda o: (o.doc_id, o.source, o["size"], o.source_size, o.target, o.taken)
    assert Counter(map(row, out)) == Counter(map(row, again)) and len(out) == len(corpus)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((o.doc_id, o["size"]) for o in out) == Counter((i, size(t)) for i, t, _ in corpus)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for _, t, s in corpus:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want = plain_targets(sizes)
    for o in out:
        assert o.taken in (0, o["size"], 2 * o["size"]) and o.source_size == sizes[o.source]
        assert abs(o.target - want[o.source]) < 1e-6
        taken[o.source] += o.taken
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    total = sum(sizes.values())
    assert 1.5 * total - max(largest.values()) <= sum(taken.values()) <= 1.5 * total
    kept = mixing.take(docs)
    assert kept.columns == docs.columns
    times = Counter()
    for o in out:
        if o["size"]:
            times[o.doc_id, o["size"]] += o.taken // o["size"]
    assert Counter((k.doc_id, size(k.text)) for k in kept.collect()) == Counter({k: v for k, v in times.items() if v})


def test_mixing_without_ids(make_docs, monkeypatch):
    """A third of all rows has no id: alike rows are counted, not gathered, and still queue one by one."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    monkeypatch.setattr(mixing, "STRETCH", 7)
    r = random.Random(12)
    text = lambda n: " ".join(r.choice("abc") for _ in range(n))
    rows = [(None, text(r.randrange(0, 4)), r.choice("xy")) for _ in range(300)] + [(i, text(r.randrange(0, 9)), r.choice("xyz")) for i in range(600)]
    docs = make_docs(rows)
    out = mixing.mix(docs.repartition(5)).collect()
    size = lambda t: len(t.split())
    assert Counter((o.doc_id, o.source, o["size"]) for o in out) == Counter((i, s, size(t)) for i, t, s in rows)
    # queued in order of hash, id and size, one row after the other
    want, total = plain_targets(Counter({s: sum(size(t) for _, t, x in rows if x == s) for s in "xyz"})), sum(size(t) for _, t, _ in rows)
    queue = []
    for rank, s in enumerate("xyz"):
        own = sorted((hashlib.md5(b"" if i is None else str(i).encode()).hexdigest(), i or 0, size(t), i) for i, t, x in rows if x == s)
        whole, cum = sum(o[2] for o in own), 0
        for h, _, n, i in own:
            cum += n
            queue += [((e * whole + cum) / want[s], rank, e, cum, (i, s, n)) for e in range(2) if n]
    taken, used = Counter(), 0
    for *_, row in sorted(queue, key=lambda q: q[:4]):
        used += row[2]
        if used * 100 > total * mixing.PERCENT:
            break
        taken[row] += row[2]
    got = Counter()
    for o in out:
        got[o.doc_id, o.source, o["size"]] += o.taken
    assert +got == +taken
    kept = Counter((k.doc_id, k.source, size(k.text)) for k in mixing.take(docs).collect())
    assert kept == Counter({k: v // k[2] for k, v in taken.items()})


def test_mixing_of_nothing(make_docs, corpus):
    docs = make_docs(corpus)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.take(docs.limit(0)).count() == 0
    blank = mixing.mix(make_docs([(1, None, "a"), (2, "", None), (None, " ", "b")])).collect()
    assert len(blank) == 3 and all((b["size"], b.target, b.taken) == (0, 0.0, 0) for b in blank)
