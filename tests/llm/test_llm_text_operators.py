"""Classifiers, spans, tokens, rollups, mixing and archives against plain computations."""

import hashlib
import random
import struct
from collections import Counter, defaultdict
from zlib import crc32

import public_tokenizers
import pytest
import tiktoken
from corpus import prose, tricky_documents, write_tables

from kinbridge.llm import bpe, mixing, quality, sentence_spans, token_rollup, toxicity, warc
from kinbridge.llm.bpe import parse_ranks, read_ranks
from kinbridge.llm.catalog import QUERIES, RANKS, TOKENIZER

PATTERN = public_tokenizers.PATTERN


def own_tiktoken():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=parse_ranks(read_ranks(RANKS)), special_tokens={}
    )


# --- classifiers -----------------------------------------------------------------------


def labelled(seed=3, n=600):
    """Documents of which a third are toxic by a word, and a third poor by their form."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text, toxic, good = prose(rng, rng.randint(4, 12)), int(i % 3 == 0), int(i % 3 != 1)
        if toxic:
            text += " You are a worthless blockhead. " + prose(rng, 2)
        if not good:
            text = "!!! ".join(text.upper().split()) + " 12345 $$$" * 10
        docs.append((i, text, "en", "abc"[i % 3], len(text)))
        labels.append((i, good, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def labelled_tables(spark, tmp_path_factory):
    docs, labels = labelled()
    folder = str(tmp_path_factory.mktemp("labelled"))
    return write_tables(spark, folder, documents=docs, labels=labels)


@pytest.mark.parametrize(
    ("name", "target", "bar"), [("op1_quality", 1, 0.3), ("op7_toxicity", 2, 0.5)]
)
def test_held_out_accuracy(spark, labelled_tables, name, target, bar):
    truth = {row[0]: row[target] for row in labelled()[1]}
    rows = QUERIES[name](spark, labelled_tables).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= bar)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


@pytest.mark.parametrize(("module", "target"), [(quality, "quality"), (toxicity, "toxic")])
def test_labels_of_fold_0_are_not_learnt(spark, module, target):
    docs, labels = labelled(n=200)
    flipped = [
        (i, 1 - g, 1 - t) if crc32(str(i).encode()) % 5 == 0 else (i, g, t) for i, g, t in labels
    ]
    frame = spark.createDataFrame([(d[0], d[1]) for d in docs], "doc_id long, text string")
    scores = []
    for known in (labels, flipped):
        table = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
        model = module.train(spark, frame, table)
        scored = module.with_score(spark, frame, model, "score").collect()
        scores.append({r["doc_id"]: r["score"] for r in scored})
    assert scores[0] == pytest.approx(scores[1], abs=1e-12)


# --- spans -----------------------------------------------------------------------------


@pytest.mark.parametrize("words", [51, 60, 90])
def test_no_passage_of_over_50_words_stays_in_two_documents(spark, words):
    """Passages begin and end inside sentences, or have no sentences at all."""
    rng = random.Random(words)
    texts = [prose(rng, rng.randint(5, 20)) for _ in range(120)]
    plain = " ".join(prose(rng, 20).replace(".", "").lower().split()[:words])
    mid = prose(rng, 30).split()
    mid = " ".join(mid[3 : 3 + words])
    planted = {"plain": plain, "mid": mid}
    if words == 90:  # runs of one word are cut every so many words, from where they began
        planted["same"] = " ".join(["and"] * words)
    for passage in planted.values():
        for _ in range(4):
            before = prose(rng, 3) + " " + " ".join(prose(rng, 1)[:-1].split()[:5])
            texts.append(f"{before} {passage} {prose(rng, 2).lower()}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in sentence_spans.removed(docs, "n").collect()}
    for name, passage in planted.items():
        # A run of one word repeats inside its first document, too.
        assert sum(passage in t for t in got.values()) == (name != "same"), name
    assert all(got[i] == texts[i] for i in range(120))  # clean documents are left alone


# --- byte-level BPE --------------------------------------------------------------------


def test_ids_and_bytes_equal_the_reference_tokenizer(spark):
    rng = random.Random(8)
    odd = ["", None, " ", "\n\n\t x", "a" * 5000, "é́ ß 漢字 \U0001f468‍\U0001f469", "\x1c\x1d \u0085"]
    odd += ["it's WE'LL 12345 1,000.00", "  lead", "trail  ", "\r\n\r\n", "x" * 399 + "yz" * 200]
    odd += ["".join(chr(rng.choice([9, 32, 97, 233, 0x4E2D, 0x1F600, 39, 49])) for _ in range(300)) for _ in range(20)]
    odd += [prose(rng, 30) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").repartition(3)
    coded = bpe.with_tokens(spark, docs, RANKS, PATTERN, "coded").select("doc_id", "coded.*")
    coder = own_tiktoken()
    rows = coded.collect()
    assert len(rows) == len(odd)
    for r in rows:
        text = odd[r["doc_id"]] or ""
        ids = coder.encode_ordinary(text)
        assert list(r["ids"]) == ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_remembered_pieces_are_bounded_by_bytes():
    """Texts of ever new pieces, some of them long, and of pieces that return."""
    rng = random.Random(12)
    coder, tiktoken_coder = bpe.Coder(read_ranks(RANKS), PATTERN), own_tiktoken()
    fresh = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    remember = 200
    for _ in range(12):
        texts = ["the same words again"] + [" ".join(fresh(n) for n in (3, 30, 390, 3000)) for _ in range(4)]
        found = list(coder.documents(texts, remember))
        for text, (ids, decoded) in zip(texts, found, strict=True):
            want = tiktoken_coder.encode_ordinary(text)
            assert ids == struct.pack(f"<{len(want)}I", *want)
            assert decoded == text.encode()
        assert coder.held == sum(map(coder._size, coder.ids)) and set(coder.ids) == set(coder.text)
        # What came with the last texts, and no more than the bound before them.
        assert coder.held <= remember * bpe.PIECE_BYTES + 4 * 4 * 5000


def test_texts_are_taken_in_groups_of_bounded_size():
    assert list(bpe._groups([], 3, 9)) == []
    assert list(bpe._groups([1] * 7, 3, 9)) == [(0, 3), (3, 6), (6, 7)]
    assert list(bpe._groups([5, 5, 20, 1, 1], 3, 9)) == [(0, 1), (1, 2), (2, 3), (3, 5)]
    assert list(bpe._groups([0, 0], 9, 9)) == [(0, 2)]


# --- token rollup ----------------------------------------------------------------------

CHANGES = "doc_id long, source string, lang string, version string, tokens long, change string"


def test_rollup_against_a_recount(spark, tmp_path):
    rng = random.Random(4)
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    state = {}
    for batch in range(5):
        ids = rng.sample(range(60), 25)
        rows = []
        for i in ids:
            kind = rng.choice(["insert", "delete", "revise"])
            place = (rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]))
            n = rng.choice([0, 5, 70, None])
            rows.append((i, *place, n, kind))
            if kind == "delete":
                state.pop((i, place[2]), None)
            else:
                state[i, place[2]] = (place[0], place[1], n or 0)
        changes = spark.createDataFrame(rows, CHANGES).repartition(3)
        assert rollup.apply(f"b{batch}", changes)
        assert not rollup.apply(f"b{batch}", changes)  # delivered again
        want = defaultdict(Counter)
        for (_, version), (source, lang, n) in state.items():
            want[source, lang, version].update(docs=1, tokens=n)
        got = {tuple(r[:3]): (r["docs"], r["tokens"]) for r in rollup.totals().collect()}
        assert got == {k: (c["docs"], c["tokens"]) for k, c in want.items()}


def test_an_interrupted_batch_is_not_read_and_can_be_repeated(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rows = spark.createDataFrame([(1, "a", "en", "v", 7, "insert")], CHANGES)
    rollup.apply("first", rows)
    half = spark.createDataFrame(
        [(2, "a", "en", "v", 1, 99)],
        "doc_id long, source string, lang string, version string, docs long, tokens long",
    )
    half.write.parquet(rollup._path("ledger", "second"))
    half.drop("doc_id").write.parquet(rollup._path("deltas", "second"))
    assert [r["tokens"] for r in rollup.totals().collect()] == [7]
    more = spark.createDataFrame([(2, "a", "en", "v", 5, "insert")], CHANGES)
    assert rollup.apply("second", more)
    assert [(r["docs"], r["tokens"]) for r in rollup.totals().collect()] == [(2, 12)]


@pytest.mark.parametrize("name", ["2026-01-01/a", "x*", "", "é?[1]", "12", "1e5"])
def test_rollup_batches_may_have_any_name(spark, tmp_path, name):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rows = spark.createDataFrame([(1, "a", "en", "v", 10, "insert")], CHANGES)
    assert rollup.apply(name, rows) and not rollup.apply(name, rows)
    assert rollup.apply(f"{name}2", rows)
    assert [(r["docs"], r["tokens"]) for r in rollup.totals().collect()] == [(1, 10)]


def test_rollup_batch_that_died_before_its_marker(spark, tmp_path, monkeypatch):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rows = spark.createDataFrame([(1, "a", "en", "v", 10, "insert")], CHANGES)

    def died(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(token_rollup.Rollup, "_commit", died)
        with pytest.raises(RuntimeError):
            rollup.apply("one", rows)
    assert not rollup.committed("one") and rollup.totals().collect() == []
    assert rollup.apply("one", rows)
    for success in (tmp_path / "rollup").rglob("*SUCCESS*"):
        success.unlink()  # as with marksuccessfuljobs=false
    assert not rollup.apply("one", rows)
    assert [(r["docs"], r["tokens"]) for r in rollup.totals().collect()] == [(1, 10)]


def test_rollup_last_change_of_a_batch_wins(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rows = [
        (1, "a", "en", "v", 20, "revise", 1), (1, "a", "en", "v", 30, "revise", 2),
        (2, "a", "en", "v", 5, "insert", 1), (2, "a", "en", "v", 0, "delete", 3),
        (3, "a", "en", "v", 0, "delete", 1), (3, "a", "en", "v", 7, "insert", 2),
        (None, "a", "en", "v", 1, "insert", 1), (None, "a", "en", "v", 2, "insert", 1),
    ]
    rollup.apply("b", spark.createDataFrame(rows, f"{CHANGES}, seq long"))
    assert [(r["docs"], r["tokens"]) for r in rollup.totals().collect()] == [(4, 40)]


def test_rollup_query_against_a_count(spark, tmp_path):
    folder = write_tables(spark, str(tmp_path / "docs"), documents=tricky_documents())
    coder, want = own_tiktoken(), defaultdict(Counter)
    for _, text, lang, source, _ in tricky_documents():
        want[source, lang, TOKENIZER].update(docs=1, tokens=len(coder.encode_ordinary(text or "")))
    got = {
        (r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"])
        for r in QUERIES["op4_token_rollup"](spark, folder).collect()
    }
    assert got == {k: (c["docs"], c["tokens"]) for k, c in want.items()}


# --- mixing ----------------------------------------------------------------------------


def slow_targets(sizes):
    """Targets by sharing the excess again until none is above its ceiling."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("counts", [(30, 400, 900), (5, 5, 2000, 40, 7), (300,)])
def test_mix_meets_its_targets(spark, monkeypatch, tmp_path, counts):
    monkeypatch.setattr(mixing, "WORDS_PER_SHARD", 4000)
    rng = random.Random(len(counts))
    names = ["é", "a", None, "Z", ""]
    docs, i = [], 0
    for name, n in zip(names, counts):
        for _ in range(n):
            docs.append((i, " ".join(["w"] * rng.randint(0, 40)), "en", name, 0))
            i += 1
    folder = write_tables(spark, str(tmp_path / "docs"), documents=docs)
    rows = QUERIES["op2_mix"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(docs)))
    size = {d[0]: len(d[1].split()) for d in docs}
    sizes = Counter()
    for d in docs:
        sizes[d[3]] += size[d[0]]
    want, taken = slow_targets(dict(sizes)), Counter()
    for r in rows:
        source = docs[r["doc_id"]][3]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[source])
        assert r["target"] == pytest.approx(want[source])
        assert r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 40
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = Counter(r["doc_id"] for r in mixing.mix(spark, frame).select("doc_id").collect())
    assert sum(size[d] * n for d, n in mixed.items()) == sum(taken.values())


@pytest.mark.parametrize("ids", ["none", "some", "one", "copies"])
def test_mix_draws_every_row_by_itself(spark, monkeypatch, tmp_path, ids):
    """Null and repeated ids, equal sizes, and equal rows that are a third of all."""
    monkeypatch.setattr(mixing, "WORDS_PER_SHARD", 4000)
    rng = random.Random(7)
    docs = []
    for i in range(1800):
        name = "ab"[i % 2]
        doc_id = {"none": None, "some": None if i % 3 else i, "one": 5, "copies": i}[ids]
        words = 10 + i % 2 if ids == "none" else rng.randint(1, 7)
        text = " ".join(f"w{rng.randint(0, 9)}" for _ in range(words))
        if ids == "copies" and i % 3 == 0:
            doc_id, text, name = 7, "the same text of six words", "b"
        docs.append((doc_id, text, "en", name, 0))
    folder = write_tables(spark, str(tmp_path / "docs"), documents=docs)
    rows = QUERIES["op2_mix"](spark, folder).collect()
    assert len(rows) == len(docs)
    sizes, taken = Counter(), Counter()
    for d in docs:
        sizes[d[3]] += len(d[1].split())
    want = slow_targets(dict(sizes))
    by_size = {n: s for s, n in sizes.items()}
    for r in rows:
        taken[by_size[r["source_size"]]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 10
    again = QUERIES["op2_mix"](spark, folder).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = mixing.mix(spark, frame)
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert words == sum(taken.values())


def test_shards_are_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(mixing, "WORDS_PER_SHARD", 300)
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 4)
    rows = [(i, "word " * 10, "en", "a", 0) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sizes = [len(p) for p in mixing.mix(spark, frame).rdd.glom().collect()]
    assert len(sizes) == 7 and sum(sizes) == 200 and min(sizes) >= 15


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_tree_spends_the_quotas_exactly(spark, shards):
    quota = [0, 1, 50, 4000, 3]
    root = spark.createDataFrame([(quota,)], "quota array<long>")
    leaves = mixing.quota_tree(root, shards).collect()
    assert sorted(r["shard"] for r in leaves) == list(range(shards))
    assert [sum(r["quota"][i] for r in leaves) for i in range(len(quota))] == quota
    sums = [sum(r["quota"]) for r in leaves]
    assert max(sums) - min(sums) <= 4


# --- WARC ------------------------------------------------------------------------------


def test_archives_with_records_inside_payloads(spark, tmp_path):
    """Payloads that hold whole records, at any place of the splits of a file."""
    rng = random.Random(6)
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    pages = []
    for i in range(300):
        body = "".join(rng.choices("abc \r\n", k=rng.randint(0, 600)))
        nested = inner.format(len(body), body) * rng.randint(0, 4)
        pages.append((i, f"http://x/{i}", rng.choice([nested, body, nested + "WARC/1.1\r\n", "é" * 120])))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    path = str(tmp_path / "warc")
    warc.write_archive(frame, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = {r["page_id"]: r for r in warc.read_archive(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(rows) == list(range(300))
    first = {}
    for i, _, html in pages:
        first.setdefault(html, i)
    for i, _, html in pages:
        r, data = rows[i], html.encode()
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == hashlib.sha256(data).hexdigest()
        again = len(data) >= 100 and first[html] != i
        assert r["record_type"] == ("revisit" if again else "response")
        assert r["refers_to"] == (first[html] if again else None)
