"""Near-duplicate operators, top-k search and spans against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from corpus import prose

from kinbridge.llm import (
    buckets,
    components,
    rotated_codes,
    sentence_spans,
    simhash,
    topk,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def root_finder():
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    return root, join


# --- components ---------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(250)]
    pairs += [(i, i + 1) for i in range(1000, 1100)]  # a chain
    pairs += [(5000, 5000 + i) for i in range(200)]  # a hub
    root, join = root_finder()
    for a, b in pairs:
        join(a, b)
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = {r["node"]: r["root"] for r in components.connected_components(spark, edges).collect()}
    assert got == {x: root(x) for p in pairs for x in p if root(x) != x}


@pytest.mark.parametrize("file_edges, files", [(1 << 18, 1), (50, 2)])
def test_files_of_a_round_follow_its_edges(spark, monkeypatch, file_edges, files):
    monkeypatch.setattr(components, "FILE_EDGES", file_edges)
    edges = spark.createDataFrame([(0, i) for i in range(1, 101)], "u long, v long")
    was = {
        k: spark.conf.get(k)
        for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    }
    for k, v in zip(was, ("16", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        roots = components.connected_components(spark, edges)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(roots.inputFiles()) == files
    assert {r["node"]: r["root"] for r in roots.collect()} == {i: 0 for i in range(1, 101)}


# --- SimHash ----------------------------------------------------------------------------


def slow_print(text, width=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    runs = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def slow_components(ids, prints, distance=4):
    root, join = root_finder()
    for i in range(len(ids)):
        root(ids[i])
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                join(ids[i], ids[j])
    return {i: root(i) for i in ids}


def near_copies(rng, groups, copies):
    texts = []
    for _ in range(groups):
        words = prose(rng, 12).split()
        for _ in range(copies):
            some = list(words)
            some[rng.randrange(len(some))] = "changed"
            texts.append(" ".join(some))
    return texts


@pytest.mark.parametrize("text", ["", " ", "One", "ÄÖ A b C d É", "a b c d", "A a A a A a\x0b\x1c x"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == slow_print(text)


@pytest.mark.parametrize("block", [8192, 5])
def test_simhash_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(3)
    texts = [prose(rng, 6) for _ in range(60)] + near_copies(rng, 4, 20) + ["", None, "  "]
    rows = list(enumerate(texts, 10))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = simhash.with_component(spark, docs).collect()
    prints = {i: slow_print(t) for i, t in rows}
    assert {r["doc_id"]: r["print"] & (2**64 - 1) for r in got} == prints
    want = slow_components(list(prints), list(prints.values()))
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    kept = [r["doc_id"] for r in simhash.keep_one(spark, docs.union(docs)).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_one_row_of_every_component_stays_whatever_its_ids(spark):
    rng = random.Random(13)
    a, b, c, *clean = [prose(rng, 12) for _ in range(15)]
    rows = [(None, t) for t in clean]  # different texts without an id
    rows += [(3, b), (5, a), (5, b), (5, a)]  # id 5 repeats, once as a copy of id 3
    rows += [(None, c), (9, c), (None, None), (None, "")]
    docs = spark.createDataFrame(
        [(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, mark int"
    ).repartition(5)
    got = simhash.keep_one(spark, docs)
    assert got.columns == docs.columns
    found = sorted((str(r["doc_id"]), r["text"] or "") for r in got.collect())
    want = [(None, t) for t in clean] + [(3, b), (5, a), (9, c), (None, "")]
    assert found == sorted((str(i), t) for i, t in want)


@pytest.mark.parametrize("cost", [1, 10**9])
def test_thresholds_find_all_pairs_and_spend_the_distance(spark, monkeypatch, cost):
    """Whatever the costs suggest, pairs within the distance are connected."""
    monkeypatch.setattr(simhash, "PROBE_COST", cost)
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints):
        for flips in (1, 3, 4, 5):
            q = p
            for b in rng.sample(range(64), flips):
                q ^= 1 << b
            prints.append(q)
    signed = [simhash._signed(p) for p in prints]
    frame = spark.createDataFrame([(p,) for p in set(signed)], "print long")
    edges = [(r["u"], r["v"]) for r in simhash.near_edges(frame).collect()]
    root, join = root_finder()
    for a, b in edges:
        join(a, b)
    want = slow_components(signed, [p & (2**64 - 1) for p in signed])
    groups = lambda f: sorted(sorted(x) for x in _groups({p: f(p) for p in set(signed)}))
    assert groups(root) == groups(want.get)
    parts = simhash.search_plan(frame, 4)
    assert sum(t + 1 for _, t in parts) == 5
    bits = [b for group, _ in parts for b in group]
    assert len(bits) == len(set(bits))


def _groups(named):
    out = {}
    for x, name in named.items():
        out.setdefault(name, []).append(x)
    return out.values()


def test_thresholds_skip_a_part_that_all_share():
    # One part in which everything agrees, four that tell all apart.
    _, chosen = simhash.thresholds([13, 13, 13, 13, 12], [1e12, 1e6, 1e6, 1e6, 1e6], 10**6, 4)
    assert chosen[0] == -1
    assert sum(t + 1 for t in chosen) == 5


def test_correlated_bits_share_a_part():
    both, n = np.zeros((64, 64)), 1000
    np.fill_diagonal(both, 500)
    both[:] = np.where(both == 0, 250, both)
    for i in (0, 20, 40):
        for j in (0, 20, 40):
            both[i, j] = 500
    groups = simhash.bit_groups(both, n, 5)
    assert any({0, 20, 40} <= set(g) for g in groups)
    assert sorted(b for g in groups for b in g) == list(range(64))


def test_units_meet_every_pair_once(spark):
    rows = [(k, v) for k, n in ((1, 37), (2, 3), (3, 1)) for v in range(n)]
    frame = spark.createDataFrame(rows, "k long, v long")
    met = Counter()
    units = {}
    for r in buckets.in_units(frame, ["k"], "v", 5).collect():
        units.setdefault((r["k"], r["block_a"], r["block_b"]), []).append((r["own_block"], r["v"]))
    for (k, a, b), members in units.items():
        for i, (x, v) in enumerate(members):
            for y, w in members[:i]:
                if a == b or x != y:
                    met[k, *sorted((v, w))] += 1
    want = {(k, v, w) for k, n in ((1, 37), (2, 3)) for v in range(n) for w in range(v + 1, n)}
    assert set(met) == want and set(met.values()) == {1}


# --- vectors -------------------------------------------------------------------------


def some_vectors(rng, centres, each, dim=24):
    rows = []
    for c in range(centres):
        base = rng.standard_normal(dim)
        for _ in range(each):
            rows.append((base + 0.12 * rng.standard_normal(dim)).astype(np.float32))
    rows += [rng.standard_normal(dim).astype(np.float32) for _ in range(150)]
    return rows


@pytest.mark.parametrize("block", [2048, 7])
def test_vector_links(spark, monkeypatch, block):
    monkeypatch.setattr(rotated_codes, "BLOCK", block)
    monkeypatch.setattr(rotated_codes, "CELL_ROWS", 40)
    rng = np.random.default_rng(2)
    vectors = some_vectors(rng, 12, 9)
    vectors += vectors[:5] * 3  # exact copies
    labels = [int(i % 17 == 0) for i in range(len(vectors))]
    rows = [(i, [float(v) for v in x], labels[i]) for i, x in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in rotated_codes.near_duplicates(spark, frame).collect()}
    x = np.array(vectors, dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array(labels)
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.9 * near.sum()
    for i, row in got.items():
        assert row["n_links"] <= near[i].sum()
    root, join = root_finder()
    for i, j in zip(*np.nonzero(near), strict=True):
        join(int(i), int(j))
    same = sum(got[i]["component_id"] == root(i) for i in got)
    assert same >= 0.95 * len(got)


def far_pairs(rng, pairs, dim=24):
    """Pairs of cosine 0.935 in random directions, which fall into far cells."""
    x = rotated_codes._unit_rows(rng.standard_normal((pairs, dim)))
    y = rng.standard_normal((pairs, dim))
    y = rotated_codes._unit_rows(y - (x * y).sum(axis=1, keepdims=True) * x)
    return np.concatenate((x, 0.935 * x + np.sqrt(1 - 0.935**2) * y))


@pytest.mark.parametrize("block", [2048, 5])
def test_links_across_hundreds_of_cells(spark, monkeypatch, block):
    monkeypatch.setattr(rotated_codes, "BLOCK", block)
    monkeypatch.setattr(rotated_codes, "CELL_ROWS", 8)
    x = far_pairs(np.random.default_rng(6), 1000 if block > 5 else 150)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in rotated_codes.near_duplicates(spark, frame).collect()}
    near = rotated_codes._unit_rows(x) @ rotated_codes._unit_rows(x).T >= 0.93
    np.fill_diagonal(near, False)
    assert near.sum() >= len(x)
    assert {i: r["n_links"] for i, r in got.items()} == dict(enumerate(near.sum(axis=1)))


def test_every_near_pair_meets_in_one_cell():
    rng = np.random.default_rng(8)
    x = far_pairs(rng, 500)
    centres = rotated_codes._centres(x[rng.permutation(len(x))], 120)
    cells = rotated_codes.cells_to_visit(x, centres, 0.93)
    assert max(c[0] for c in cells) > 100
    for i in range(500):
        a, b = cells[i], cells[i + 500]
        assert (b[0] in a) + (a[0] in b) == (2 if a[0] == b[0] else 1)
    # Tight groups stay apart: the bound, not the number of cells, says what is visited.
    tight = rotated_codes._unit_rows(np.eye(24)[rng.integers(0, 24, 400)] + 0.02 * x[:400])
    visited = rotated_codes.cells_to_visit(tight, np.eye(24), 0.93)
    assert all(len(v) == 1 for v in visited)


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(4)
    x = rotated_codes._unit_rows(rng.standard_normal((300, 64)))
    centre = x[:40].mean(axis=0)
    codes = rotated_codes.Codes(x, centre)
    all_rows = np.arange(300)
    upper = codes.upper_cosine(all_rows, all_rows, float(centre @ centre))
    exact = x @ x.T
    off = ~np.eye(300, dtype=bool)
    assert (upper[off] >= exact[off]).mean() > 0.995
    # The bound prunes: hardly any unrelated pair needs exact recomputation.
    assert (upper[off] >= 0.93).mean() < 0.05


def slow_top(rows, k, modulus):
    """Every usable row is a candidate; a query leaves out its own row only."""
    usable = []
    for i, x in rows:
        if x is None or not x or any(v is None or not np.isfinite(v) for v in x):
            continue
        usable.append((i, [int(np.floor(float(np.float32(v)) * 1024)) for v in x]))
    out = []
    for at, (q, x) in enumerate(usable):
        if q is None or q % modulus:
            continue
        scores = [
            (-sum(a * b for a, b in zip(x, y, strict=True)), i is None, i or 0)
            for n, (i, y) in enumerate(usable)
            if n != at and len(y) == len(x)
        ]
        for rank, (score, no_id, i) in enumerate(sorted(scores)[:k], 1):
            held = max(-(2**63), min(2**63 - 1, -score))
            out.append((q, rank, None if no_id else i, held))
    return sorted(out, key=str)


@pytest.mark.parametrize("coordinate", [0.6, 0.0])
def test_top_k(spark, monkeypatch, coordinate):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "COORDINATE_COSINE", coordinate)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.standard_normal(8) * rng.exponential()).tolist()) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]  # ties
    rows += [(900, None), (901, [None] * 8), (910, [1e9] * 8), (920, [-1e9, 1e9] * 4), (930, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    got = topk.search(spark, frame, modulus=10, k=10).collect()
    assert sorted(map(tuple, got), key=str) == slow_top(rows, 10, 10)


def test_top_k_tells_rows_apart_by_number(spark):
    rows = [
        (100, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (None, [0.7, 0.0]), (None, [0.9, 0.0]),
        (100, [0.9, 0.0]), (200, [0.9, 0.1]), (0, [0.0, 0.0]), (-100, [0.1, 0.1]),
    ]
    schema = "vec_id long, embedding array<float>, row long, query long, bucket long, q binary"
    clashing = [(*r, 1, 2, 3, b"x") for r in rows]
    for k in (1, 3, 10):
        frame = spark.createDataFrame(clashing, schema).repartition(4)
        got = topk.search(spark, frame, modulus=100, k=k).collect()
        assert sorted(map(tuple, got), key=str) == slow_top(rows, k, 100)
    assert topk.search(spark, frame.limit(0)).collect() == []


def test_top_k_pairs_meet_before_their_vectors(spark):
    """No join by the vectors' length alone carries payloads."""
    frame = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(300)], "vec_id long, embedding array<float>")
    plan = topk.search(spark, frame)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [dim" not in plan and "CartesianProduct" not in plan


# --- spans -----------------------------------------------------------------------------


def slow_spans(parts):
    words = [p.split() for p in parts]
    enough = lambda a, b: b - a >= 3 and sum(map(len, words[a:b])) >= 25
    found = set()
    for a in range(len(parts)):
        b = next((b for b in range(a + 3, len(parts) + 1) if enough(a, b)), None)
        if b:
            found.add((a, b))
        s = next((s for s in range(a - 2, -1, -1) if enough(s, a + 1)), None)
        if s is not None:
            found.add((s, a + 1))
    return [(a, b, tuple(sum(words[a:b], []))) for a, b in sorted(found)]


def test_spans_against_brute_force(spark):
    rng = random.Random(11)
    passage = prose(rng, 9)
    long_one = " ".join(prose(rng, 9).replace(".", "").split())  # a sentence of many words
    texts = [prose(rng, rng.randint(1, 20)) for _ in range(30)]
    texts += [f"{prose(rng, 3)} {passage} {prose(rng, 2)}" for _ in range(5)]
    texts += [f"{prose(rng, 1)}\n{passage}\n\n{passage}" for _ in range(2)]
    texts += [f"{prose(rng, 2)} x {long_one} {prose(rng, 2)}" for _ in range(3)]
    texts += ["", None, "No. Yes. No.", "No. Yes. No."]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in sentence_spans.removed(docs, "n").collect()}
    first, all_parts = {}, {i: sentence_spans.sentences(t or "") for i, t in rows}
    for i, parts in all_parts.items():
        assert "".join(parts) == (texts[i] or "")
        for a, b, key in slow_spans(parts):
            first.setdefault(key, (i, a, b))
    for i, parts in all_parts.items():
        gone = set()
        for a, b, key in slow_spans(parts):
            if first[key] != (i, a, b):
                gone.update(range(a, b))
        want = "".join(p for j, p in enumerate(parts) if j not in gone)
        assert got[i] == (None if texts[i] is None else want)
    assert sum(passage in (t or "") for t in got.values()) == 1
    assert got[0] == texts[0]


@pytest.mark.parametrize("kind", ["sentences", "plain", "few words"])
def test_51_shared_words_hold_a_shared_span_whatever_is_around_them(kind):
    rng = random.Random(kind)
    for _ in range(1500):
        texts = [prose(rng, 40).split() for _ in range(3)]
        if kind == "plain":
            texts = [[w.strip(".").lower() for w in t] for t in texts]
        if kind == "few words":
            texts = [[rng.choice("abcdef") for _ in t] for t in texts]
        at = rng.randrange(30)
        shared = texts[0][at : at + 51]
        found = []
        for t in texts[1:]:
            cut = rng.randrange(3, 60)
            words = sentence_spans.split(" ".join([*t[:cut], *shared, *t[cut:]]))[1]
            _, _, h, g = sentence_spans.spans(words)
            found.append({*zip(h.tolist(), g.tolist(), strict=True)})
        assert found[0] & found[1]


def test_passages_repeated_among_rows_of_one_id_or_without_id_go(spark):
    rng = random.Random(17)
    rows = []
    for ids in ([None] * 3, [7] * 3, [None, 8, 8]):
        passage = prose(rng, 9)
        rows += [(i, f"{prose(rng, 2)} {passage} {prose(rng, 2)}", passage) for i in ids]
    rows.append(rows[0])  # a repeated row is the same document
    docs = spark.createDataFrame(rows, "doc_id long, text string, passage string").repartition(4)
    got = sentence_spans.removed(docs, "n").collect()
    assert len(got) == len(rows)
    for passage in {r[2] for r in rows}:
        held = {(r["doc_id"], r["text"]) for r in got if passage in r["text"]}
        assert len(held) == 1
        assert all(
            passage.split(". ")[4] not in r["text"]
            for r in got
            if r["passage"] == passage and (r["doc_id"], r["text"]) not in held
        )
