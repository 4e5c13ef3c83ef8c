"""Exact dedup, SimHash near-dedup, substring dedup and components against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import DOCS, components, exact_groups, frame, lower, messy, sha, simhash
from wardline.llm import components as C
from wardline.llm import exact_dedup, substring_dedup
from wardline.llm import simhash as S
from wardline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark, folder=SF):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


# ---------------------------------------------------------------- exact


def exact_answer(rows):
    out = []
    for text, ids in exact_groups(rows).items():
        known = [i for i in ids if i is not None]
        out += [(i, max(known, default=None), len(ids), sha(text)) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_exact_groups(spark, partitions):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)  # one round, and two
    try:
        got = exact_dedup.exact_groups(frame(spark, messy()).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(((r.id, r.keep_id, r.group_size, r.sha.hex()) for r in got), key=str) == exact_answer(messy())
    kept = [r for r in got if r.kept]
    assert len(kept) == len(exact_groups(messy()))  # one per text, though id 3 stands there twice
    assert all(r.id == r.keep_id for r in kept)


def test_exact_smallest(spark):
    got = exact_dedup.exact_groups(frame(spark, messy()), keep="smallest").collect()
    least = {sha(t): min((i for i in ids if i is not None), default=None) for t, ids in exact_groups(messy()).items()}
    assert all(r.keep_id == least[r.sha.hex()] for r in got)


def test_drop_exact_copies_keeps_all_columns(spark):
    df = frame(spark, messy())
    out = exact_dedup.drop_exact_copies(df)
    assert out.columns == df.columns
    rows = out.collect()
    groups = exact_groups(messy())
    assert sorted((lower(r.text) for r in rows)) == sorted(groups)
    assert all(r.doc_id == max((i for i in groups[lower(r.text)] if i is not None), default=None) for r in rows)


def test_exact_query(spark):
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in QUERIES["op9_exact_dedup"](spark, SF).collect()]
    assert sorted(got, key=str) == exact_answer(documents(spark))


# ---------------------------------------------------------------- SimHash


def simhash_answer(rows, distance=4):
    marks = {}
    for i, t, *_ in rows:
        marks.setdefault(simhash(t), []).append(i)
    keys = list(marks)
    of = components(range(len(keys)), [(a, b) for a in range(len(keys)) for b in range(a) if (keys[a] ^ keys[b]).bit_count() <= distance])
    least = {}
    for k, root in of.items():
        ids = [i for i in marks[keys[k]] if i is not None]
        if ids:
            least[root] = min(least.get(root, min(ids)), min(ids))
    # a fingerprint that only null ids have is no node
    out = []
    for k, root in of.items():
        ids = [i for i in marks[keys[k]] if i is not None]
        out += [(i, keys[k], least.get(root) if ids else None) for i in marks[keys[k]]]
    return sorted(out, key=str)


def test_simhash_groups(spark):
    got = S.simhash_groups(frame(spark, messy())).collect()
    assert sorted(((r.id, r.fingerprint & (2**64 - 1), r.component) for r in got), key=str) == simhash_answer(messy())


def test_simhash_query(spark):
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op2_simhash_near_dedup"](spark, SF).collect()]
    assert sorted(got, key=str) == simhash_answer(documents(spark))


def test_drop_near_copies(spark):
    df = frame(spark, messy())
    rows = S.drop_near_copies(df).collect()
    want = sorted({c for _, _, c in simhash_answer(messy()) if c is not None})
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in rows) == 1  # "only here" has no id and no copy


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_masks_meet_every_close_pair(blocks):
    rnd = random.Random(blocks)
    picks = [m & (2**64 - 1) for m in S.masks(blocks, 4)]
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in picks)


def test_bucket_links_of_a_dense_group(spark):
    """Hundreds of fingerprints within a few bits of each other, cut into tiles, and some far ones."""
    rnd = random.Random(2)
    centre = rnd.getrandbits(64)
    marks = {centre}
    while len(marks) < 400:
        m = centre
        for bit in rnd.sample(range(64), rnd.randrange(1, 4)):
            m ^= 1 << bit
        marks.add(m)
    marks |= {rnd.getrandbits(64) for _ in range(200)}
    marks = sorted(marks)
    rows = [(m - 2**64 if m >> 63 else m, i) for i, m in enumerate(marks)]
    want = components(range(len(marks)), [(a, b) for a in range(len(marks)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 4])
    df = spark.createDataFrame(rows, "mark long, node long")
    for tile in (4096, 50):
        links = S.bucket_links(df, 4, tile)
        of = {r.node: r.component for r in C.components(links).collect()}
        assert {n: of.get(n, n) for n in range(len(marks))} == want
        assert links.count() < 400 * 80  # a forest per bucket and tile, not all pairs


def test_forest_equals_union_find():
    rnd = np.random.default_rng(4)
    marks = rnd.integers(0, 2**63, 60, dtype=np.uint64)
    marks = np.concatenate([marks, marks ^ np.uint64(7), marks ^ np.uint64(7 << 20)])
    links = [(a, b) for a in range(len(marks)) for b in range(a) if int(marks[a] ^ marks[b]).bit_count() <= 4]
    assert dict(enumerate(S.forest(marks, 4).tolist())) == components(range(len(marks)), links)


# ---------------------------------------------------------------- components


@pytest.mark.parametrize("links", ["random", "chain", "star"])
def test_components(spark, links):
    rnd = random.Random(1)
    pairs = {
        "random": [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(200)] + [(500, 501)],
        "star": [(0, i) for i in range(1, 300)] + [(i, 0) for i in range(1, 50)],
    }[links]
    rows = [*pairs, (7, 7), (None, 3), (3, None), *pairs[:5]]  # self links, nulls and repeats count for nothing
    got = {r.node: r.component for r in C.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == components(nodes, [p for p in pairs if p[0] != p[1]])


# ---------------------------------------------------------------- substrings


def substring_answer(rows, span=50):
    out, seen = [], {}
    for i, t in sorted(((i, (t or "").encode()) for i, t, *_ in rows if i is not None), key=lambda x: x[0]):
        for p in range(len(t) - span + 1):
            seen.setdefault(t[p : p + span], i)
    for i, t, *_ in rows:
        t = (t or "").encode()
        gone = [False] * len(t)
        if i is not None:
            for p in range(len(t) - span + 1):
                if seen[t[p : p + span]] < i:
                    gone[p : p + span] = [True] * span
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        n_spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), n_spans, sha(kept)))
    return sorted(out, key=str)


def substring_rows(df):
    got = substring_dedup.remove_repeats(df).collect()
    return sorted(((r.id, r.n_bytes, r.n_removed, len(r.spans), sha(bytes(r.kept))) for r in got), key=str)


def test_substring_messy(spark):
    assert substring_rows(frame(spark, messy())) == substring_answer(messy())


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é"])
def test_substring_random(spark, alphabet):
    """Pasted passages of 40 to 200 characters, overlapping, in few letters, over ids in any order."""
    rnd = random.Random(len(alphabet))
    passages = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40, 200))) for _ in range(12)]
    rows = []
    for i in rnd.sample(range(-50, 50), 60):
        parts = [rnd.choice(passages) if rnd.random() < 0.6 else "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 120))) for _ in range(rnd.randrange(0, 6))]
        rows.append((i, "".join(parts), None))
    rows += [(5000, rows[3][1], None), (5000, rows[4][1] + "x", None), (5000, rows[4][1] + "x", None), (None, rows[5][1], None)]
    df = frame(spark, rows, clash=False)
    assert substring_rows(df.repartition(7)) == substring_answer(rows)


def test_substring_lots(spark, monkeypatch):
    """Many small lots, buckets and pieces give the same result."""
    monkeypatch.setattr(substring_dedup, "BUCKET", 500)
    rows = documents(spark)[:60]
    assert substring_rows(frame(spark, rows, clash=False)) == substring_answer(rows)


@pytest.mark.parametrize("hot", [1, 20])
def test_substring_hot_anchors(spark, monkeypatch, hot):
    """A passage in most documents, amid text of their own: its anchors' strings are dealt one by one."""
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rnd = random.Random(hot)
    passage = "".join(rnd.choice("abcdefgh é") for _ in range(150))
    own = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    rows = [(i, own(rnd.randrange(60)) + passage[rnd.randrange(9) :] + own(rnd.randrange(60)), None) for i in rnd.sample(range(500), 80)]
    rows += [(600 + i, own(200), None) for i in range(10)] + [(3, "a" * 300 + passage * 2, None), (3, passage, None), (None, passage, None), (900, "a" * 300, None)]
    assert substring_rows(frame(spark, rows, clash=False).repartition(5)) == substring_answer(rows)


def test_substring_hot_anchor_is_dealt():
    """No bucket gets the surroundings of a hot anchor; its strings spread over all."""
    rnd = random.Random(4)
    passage, own = "".join(rnd.choice("abcdefgh") for _ in range(150)), lambda: "".join(rnd.choice("abcdefgh") for _ in range(60))
    texts = [own() + passage + own() for _ in range(300)]
    first = pa.RecordBatch.from_pydict({"doc": list(range(300)), "text": texts})
    marks = list(substring_dedup._shared(1, 100)(substring_dedup._fingerprints(1)(iter([first]))))
    rows = pa.Table.from_batches(substring_dedup._marks(iter(marks))).sort_by("__doc").to_pydict()
    batch = pa.RecordBatch.from_pydict({"doc": rows["__doc"], "tag": [0] * 300, "text": texts, "marks": rows["marks"], "hot": rows["hot"]})
    out = pa.Table.from_batches(substring_dedup._strings(16)(iter([batch]))).to_pydict()
    sizes, grams = {}, Counter()
    for bucket, blob, kind in zip(out["bucket"], out["blob"], out["kind"], strict=True):
        if kind == substring_dedup.AROUND:
            ids, _, which, first, _, at, _ = substring_dedup._unpack(blob, "i8", "i8", "u4", "i8", "u1", "u1", "u1")
            grams.update(texts[d][p : p + substring_dedup.GRAM] for d, p in zip(ids[which].tolist(), (first + at).tolist(), strict=True))
        if kind == substring_dedup.SINGLE:
            sizes[bucket] = sizes.get(bucket, 0) + len(substring_dedup._unpack(blob, "i8", "i8", "i8", "u1")[0])
    assert max(grams.values(), default=0) <= 100
    assert len(sizes) == 16 and max(sizes.values()) < 2 * sum(sizes.values()) / 16


def test_anchors_cover_every_string():
    rnd = random.Random(9)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 400))) for _ in range(30)]
    text, first, count, at, _ = substring_dedup.anchors(texts)
    seen = {(t, p) for t, f, n in zip(text.tolist(), first.tolist(), count.tolist(), strict=True) for p in range(f, f + n)}
    assert seen == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 49)}
    assert (at - count >= -1).all() and (at <= 34).all()


def test_refine_equals_comparison():
    rnd = random.Random(3)
    body = np.frombuffer(bytes(rnd.choice(b"ab") for _ in range(40)) * 12 + bytes(rnd.choice(b"abc") for _ in range(500)), np.uint8)
    start, count = np.array([0, 40, 83, 500]), np.array([30, 20, 35, 35])
    owner, bucket = substring_dedup.refine(body, start, count)
    strings = [body[s + k : s + k + 50].tobytes() for s, n in zip(start, count, strict=True) for k in range(n)]
    assert owner.tolist() == [i for i, n in enumerate(count) for _ in range(n)]
    same = {}
    for s, b in zip(strings, bucket.tolist(), strict=True):
        assert same.setdefault(s, b) == b
    assert len(set(same.values())) == len(same)


def test_substring_query(spark):
    rows = documents(spark)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_substring_dedup"](spark, SF).collect()]
    assert sorted(got, key=str) == substring_answer(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_groups(empty).collect() == []
    assert exact_dedup.drop_exact_copies(empty).collect() == []
    assert S.simhash_groups(empty).collect() == []
    assert S.drop_near_copies(empty).collect() == []
    assert substring_dedup.remove_repeats(empty).collect() == []
