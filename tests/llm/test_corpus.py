"""Mixing, BPE, embeddings, chats, helpers and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import DOCS, components, frame, messy, sha, simhash
from wardline.llm import bpe, grid_join, mixing, quality, tool_chat
from wardline.llm.common import running_sum
from wardline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


# ---------------------------------------------------------------- helpers


def test_running_sum(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "a", "a", "b"]), i, rnd.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
    got = {r.i: r.s for r in running_sum(df, ["g"], ["i"], F.col("v"), "s").collect()}
    above, want = defaultdict(int), {}
    for g, i, v in rows:
        want[i] = above[g]
        above[g] += v
    assert got == want
    place = running_sum(df, [], [F.col("i").desc()], F.lit(1), "p")
    assert {r.i: r.p for r in place.collect()} == {i: 499 - i for i in range(500)}


# ---------------------------------------------------------------- mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(size: dict, share=1.5, cap=2.0) -> dict:
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, full = {}, set()
    goal = share * sum(size.values())
    while True:
        left = goal - sum(cap * size[s] for s in full)
        open_ = sum(weight[s] for s in size if s not in full)
        out = {s: cap * size[s] if s in full else weight[s] * left / open_ for s in size} if open_ else {s: cap * size[s] for s in size}
        over = {s for s in size if s not in full and out[s] > cap * size[s]}
        if not over:
            return out
        full |= over


def check_mix(rows, got):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += words(t)
    want = targets(size)
    source = defaultdict(list)
    for i, t, s in rows:
        source[i, words(t)].append(s)
    taken = defaultdict(int)
    for r in got:
        s = source[r.id, r.size][0]
        assert r.source_size == size[s]
        assert math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert len(got) == len(rows)
    for s in size:
        assert taken[s] == math.floor(want[s] + 1e-9)


def test_mixed_words(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join("w" * rnd.randrange(1, 4) for _ in range(rnd.choice([0, 1, 5, 40, 3000]))), rnd.choice(["a", "a", "a", "b", "c", "é", None, ""])) for i in range(300)]
    rows += [(1000, "x y z", "a"), (1000, "x y z", "a"), (None, "one two", "a"), (None, None, "b"), (1001, None, "empty")]
    df = frame(spark, rows)
    got = mixing.mixed_words(df.repartition(4)).collect()
    check_mix(rows, got)
    again = mixing.mixed_words(df.repartition(9)).collect()
    assert sorted((r.id or -1, r.size, r.taken) for r in got) == sorted((r.id or -1, r.size, r.taken) for r in again)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_schedule_is_even(spark, block):
    sources = spark.createDataFrame([(0, 5000), (1, 1300), (2, 0), (3, 77)], "sid long, quota long")
    rows = sorted(tuple(r) for r in mixing.slots(sources, block).select("slot", "sid", "nth").collect())
    n = {s: math.ceil(q / block) for s, q in ((0, 5000), (1, 1300), (2, 0), (3, 77))}
    total = sum(n.values())
    seen = defaultdict(int)
    for k, (_, s, nth) in enumerate(rows, 1):
        assert nth == seen[s]
        seen[s] += 1
        for x in n:  # low discrepancy: any start of the schedule has its share of every source
            assert abs(seen[x] - k * n[x] / total) <= 2 + math.log2(total + 1)
    assert {s: seen[s] for s in n} == n


def test_documents_come_in_the_weights_proportions(spark):
    """Documents of one block each, read by their first slot: any stretch has each source's share of the targets."""
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * mixing.BLOCK), rnd.choice("aaaaaabbc")) for i in range(240)]
    got = mixing.mixed_words(frame(spark, rows)).collect()
    assert all((r.first_slot is None) == (r.taken == 0) for r in got)
    target = {s: next(r.target for r in got if r.id == i) for i, _, s in rows}
    source = {i: s for i, _, s in rows}
    line = [source[r.id] for r in sorted((r for r in got if r.first_slot is not None), key=lambda r: r.first_slot)]
    for start in range(0, 60, 7):
        part = line[start : start + 60]
        for s in target:
            assert abs(part.count(s) / len(part) - target[s] / sum(target.values())) < 0.12


def test_mixed_rows(spark):
    df = frame(spark, messy())
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert all(words(r.text) for r in rows)
    times = defaultdict(int)
    for r in rows:
        times[r.doc_id, r.text] += 1
    assert max(times.values()) <= 4  # two passes, and id 3 stands there twice
    assert mixing.mixed_rows(spark.createDataFrame([], DOCS)).collect() == []
    assert mixing.mixed_words(spark.createDataFrame([], DOCS)).collect() == []
    assert mixing.mixed_words(frame(spark, [(1, None, None), (2, "", "a")])).select("taken").distinct().collect()[0].taken == 0


# ---------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange():
    rnd = random.Random(2)
    return [
        "", " ", "\n\n \n", "a" * 5000, "ab" * 3000, " " * 400, "日本語の文章" * 60, "\U0001f600" * 70, "don't we'll I'd", "1234567890" * 40, "<|endoftext|>",
        "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0xA0, 0x2FFF), rnd.randrange(0x1F300, 0x1F700)])) for _ in range(4000)),
        *("".join(rnd.choice("abcdeé ") for _ in range(rnd.randrange(1, 90))) for _ in range(200)),
    ]


def test_bpe_equals_tiktoken(reference, monkeypatch):
    with open(RANKS, "rb") as f:
        vocabulary = bpe.Vocabulary(f.read(), P.PATTERN)
    texts = strange()
    for _ in range(2):  # from the trees, then from the cache
        for text, ids in zip(texts, vocabulary.encode(texts), strict=True):
            assert ids.tolist() == reference.encode_ordinary(text)
            assert vocabulary.decode(ids) == text.encode()
    monkeypatch.setattr(bpe, "CACHE", 10)
    for text in texts[-50:]:
        assert vocabulary.encode([text])[0].tolist() == reference.encode_ordinary(text)
    for piece in (b"retitioning", "éléphant".encode(), b"aaaaaaaaaaaaaaaa", b"x"):  # both forms of the tree agree
        width = next(w for w in bpe.WIDTHS if len(piece) <= w)
        assert vocabulary.encode_long(piece) == np.frombuffer(vocabulary.encode_short([piece], width)[0], "<i4").tolist()


def test_bpe_frames(spark, reference):
    rows = [(i, t, None) for i, t in enumerate(strange())] + [(None, "no id", None), (7, None, None), (1, " ", None)]
    df = frame(spark, rows)
    coded = bpe.encode(df, RANKS, P.PATTERN)
    back = bpe.decode(coded, RANKS).collect()
    assert len(back) == len(rows)
    for r in back:
        assert list(r.ids) == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    got = {(r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, RANKS, P.PATTERN).collect()}
    want = set()
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.add((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == want
    assert bpe.round_trip(spark.createDataFrame([], DOCS), RANKS, P.PATTERN).collect() == []


# ---------------------------------------------------------------- embeddings


def near_answer(rows, threshold=0.93):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append((np.array(v, float) / max(map(abs, v)), label))
    links, counts = [], {}
    flat = [(i, v, lab) for i, vs in good.items() for v, lab in vs]
    for a, (i, v, x) in enumerate(flat):
        for b, (j, w, y) in enumerate(flat):
            if a != b and x == y and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links.append((i, j))
                counts[i] = counts.get(i, 0) + 1
    of = components({i for i, _, _ in rows if i is not None}, links)
    return sorted(((i, counts.get(i, 0) if i is not None else 0, of.get(i)) for i, _, _ in rows), key=str)


def test_near_vectors(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            centre = rnd.normal(size=16)
            rows += [(len(rows) + k, (centre + rnd.normal(size=16) * rnd.choice([0.05, 0.2, 0.5])).tolist(), label) for k in range(rnd.integers(1, 9))]
    n = len(rows)
    rows += [(n + k, rows[3][1], rows[3][2]) for k in range(20)]  # copies
    rows += [(n + 30, rows[3][1], 1 - rows[3][2]), (n + 31, rows[3][1], None), (n + 32, None, 0), (n + 33, [], 0), (n + 34, [0.0] * 16, 0)]
    rows += [(n + 35, [float("nan")] + [1.0] * 15, 0), (n + 36, [float("inf")] + [1.0] * 15, 0), (n + 37, [None] + [1.0] * 15, 0)]
    rows += [(n + 38, [1.0, 2.0], 0), (n + 39, [1.0, 2.1], 0), (n + 40, [-1e200, 1e200], 0), (n + 41, [-1e-200, 1e-200], 0)]
    rows += [(None, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("id", "group", "node", "cells")})
    for block, split in ((1024, 8), (8, 2)):  # one block per label, and three rounds of splitting
        monkeypatch.setattr(grid_join, "BLOCK", block)
        monkeypatch.setattr(grid_join, "SPLIT", split)
        got = sorted(((r.id, r.n_links, r.component) for r in grid_join.near_vectors(df.repartition(3)).collect()), key=str)
        assert got == near_answer(rows)
    assert grid_join.near_vectors(df.limit(0)).collect() == []


def test_distant_blocks_are_skipped(spark):
    rows = [("g", i, [float(i % 3)] * grid_join.LEAD, [float(i % 3) + 0.1] * grid_join.LEAD) for i in range(30)]
    blocks = spark.createDataFrame(rows, "group string, seq long, lo array<double>, hi array<double>")
    got = {(r.a, r.b) for r in grid_join.block_pairs(blocks, 0.5).collect()}
    assert got == {(a, b) for a in range(30) for b in range(a, 30) if a % 3 == b % 3}


def test_near_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op6_embedding_near_dedup"](spark, SF).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == near_answer(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


# ---------------------------------------------------------------- chats

TOOLS = {
    "find": {"properties": {"q": {"type": "string", "minLength": 2}, "n": {"type": "integer"}, "how": {"enum": ["a", "b"]}}, "required": ["q"], "additionalProperties": False},
    "sum": {"properties": {"xs": {"type": "array", "items": {"type": "number"}}}, "required": ["xs"]},
}


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(ident, content):
    return json.dumps({"tool_call_id": ident, "content": content})


def test_chats(spark):
    rows = [
        ("x", 0, "user", "hello"),
        ("x", 1, "tool", result("c1", {"b": 1, "a": "é"})),  # before its call
        ("x", 2, "assistant", call(("c1", "find", {"q": "ab", "n": 3}), ("c2", "sum", {"xs": [1, 2.5]}))),
        ("x", 3, "assistant", call(("c3", "find", {"q": {"$ref": "c4"}}))),  # needs the result of a later call
        ("x", 4, "assistant", call(("c4", "find", '{"q": "zz"}'))),  # arguments as a JSON string
        ("x", 5, "tool", result("c4", "done")),
        ("x", 6, "tool", result("c3", None)),
        ("x", 7, "tool", result("nobody", 1)),
        ("x", 8, "assistant", call(("c1", "find", {"q": "again"}))),
        ("y", 0, "assistant", call(("r1", "find", {"q": {"$ref": "r2"}}), ("r2", "find", {"q": {"$ref": "r1"}}))),  # a circle
        ("y", 1, "assistant", call(("b1", "find", {"n": 1}), ("b2", "find", {"q": "x"}), ("b3", "sum", {"xs": ["1"]}), ("b4", "no", {}), ("b5", "find", {"q": "abc", "z": 0}), (None, "find", {"q": "abc"}))),
        ("y", None, "system", None),
        ("y", 2, "tool", "{not json"),
        ("y", 2, "tool", "{not json"),
        (None, 0, "user", ""),
        (None, 0, None, "w " * 50_000),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumns({c: F.lit(0) for c in ("row", "kind", "position", "key", "id")})
    got = tool_chat.format_chats(df.repartition(4), TOOLS).collect()
    place = {(r.conv, r.kind, r.call_id, r.turn): r for r in got}
    for conv in ("x", "y", None):
        own = sorted(r.position for r in got if r.conv == conv)
        assert own == list(range(len(own)))
    status = {(r.conv, r.call_id, r.turn): r.status for r in got if r.kind == "call"}
    assert status["x", "c1", 2] == "answered" and status["x", "c2", 2] == "open" and status["x", "c1", 8] == "duplicate"
    assert status["y", "r1", 0] == status["y", "r2", 0] == "unresolved" and status["y", None, 1] == "open"
    at = lambda kind, ident, turn: place["x", kind, ident, turn].position
    assert at("call", "c1", 2) < at("result", "c1", 1)  # a result follows its call
    assert at("call", "c4", 4) < at("result", "c4", 5) < at("call", "c3", 3) < at("result", "c3", 6)
    assert place["x", "result", "nobody", 7].status == "orphan" and place["x", "result", "c3", 6].status == "linked"
    errors = {r.call_id: r.error for r in got if r.kind == "call" and r.turn == 1}
    assert errors == {"b1": "$.q: missing", "b2": "$.q: too short", "b3": "$.xs[0]: not number", "b4": "unknown tool", "b5": "$.z: unknown", None: "no id"}
    assert place["x", "call", "c4", 4].error is None and json.loads(place["x", "call", "c4", 4].json)["arguments"] == {"q": "zz"}
    for r in got:
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert '"content":{"a":"é","b":1}' in place["x", "result", "c1", 1].json
    assert tool_chat.format_chats(df.limit(0), TOOLS).collect() == []


@pytest.mark.parametrize(
    ("schema", "good", "bad"),
    [
        ({"minimum": 1, "maximum": 3}, [1, 3, "x"], [0, 4, 0.5]),
        ({"exclusiveMinimum": 1, "exclusiveMaximum": 3}, [2, 1.5], [1, 3]),
        ({"multipleOf": 0.1}, [0.3, 7], [0.25]),
        ({"maxLength": 2}, ["ab", 100], ["abc"]),
        ({"pattern": "^a+$"}, ["aa", 1], ["ab"]),
        ({"const": 1}, [1, 1.0], [True, 2]),
        ({"enum": [0, "a"]}, [0, "a"], [False]),
        ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["a", 5], [4]),
        ({"oneOf": [{"type": "integer"}, {"minimum": 5, "type": "number"}]}, [4, 5.5], [5, 4.5]),
        ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, [2], [0, 4]),
        ({"not": {"type": "string"}}, [1], ["a"]),
        ({"minItems": 1, "maxItems": 2, "uniqueItems": True}, [[1], [1, True]], [[], [1, 2, 3], [{"a": 1}, {"a": 1.0}]]),
        ({"minProperties": 1, "maxProperties": 1}, [{"a": 1}], [{}, {"a": 1, "b": 2}]),
        ({"properties": {"a": True}, "additionalProperties": {"type": "string"}}, [{"a": 1, "b": "x"}], [{"b": 1}]),
        ({"items": False}, [[]], [[1]]),
    ],
)
def test_schema_keywords(schema, good, bad):
    tool_chat.check_schema(schema, "t")
    assert [tool_chat.fault(v, schema) for v in good] == [None] * len(good)
    assert all(tool_chat.fault(v, schema) for v in bad)
    assert tool_chat.fault({"$ref": "call"}, schema) is None


def test_unchecked_keywords_are_refused(spark):
    for schema in ({"dependentRequired": {}}, {"properties": {"a": {"anyOf": [{"format": "date"}]}}}, {"type": "text"}):
        with pytest.raises(ValueError, match="t"):
            tool_chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), {"t": schema})


def test_chat_with_a_common_identifier(spark):
    """A thousand calls and a thousand results of one identifier make two thousand rows."""
    rows = [("x", i, "assistant", call(("c", "find", {"q": f"q{i}"}))) for i in range(1000)]
    rows += [("x", 1000 + i, "tool", result("c", i)) for i in range(1000)]
    got = tool_chat.format_chats(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), TOOLS)
    found = {r["status"]: r["count"] for r in got.groupBy("status").count().collect()}
    assert found == {"answered": 1, "duplicate": 999, "linked": 1000}


# ---------------------------------------------------------------- pipeline


def test_stages(spark, reference):
    """Each stage against brute force, on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    one, two, three, four, five = (f for _, f in corpus_pipeline.STAGES)

    kept = one(spark, docs, SF)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.score for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in scores.items() if s >= 0.5)

    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    last = {}
    for i, t, _ in rows:
        last[(t or "").encode().lower()] = max(i, last.get((t or "").encode().lower(), i))
    assert sorted(r.doc_id for r in two(spark, docs, SF).collect()) == sorted(last.values())

    marks = {i: simhash(t) for i, t, _ in rows}
    ids = sorted(marks)
    of = components(ids, [(a, b) for a in ids for b in ids if b < a and (marks[a] ^ marks[b]).bit_count() <= 4])
    assert sorted(r.doc_id for r in three(spark, docs, SF).collect()) == sorted(set(of.values()))

    mixed = four(spark, docs, SF)
    assert mixed.columns == docs.columns
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += words(t)
    want = targets(size)
    took = defaultdict(list)
    for r in mixed.collect():
        took[r.source].append(words(r.text))
    for s in size:  # the quota cuts one document a source, which stays whole
        assert want[s] - 1 <= sum(took[s]) <= want[s] + max(words(t) for _, t, x in rows if x == s)

    text = {r.doc_id: r.text for r in docs.collect()}
    for r in five(spark, docs, SF).collect():
        coded = reference.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(coded)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, coded)).encode()).hexdigest()
        assert r.decoded_sha256 == sha(text[r.doc_id].encode())


def test_stages_on_messy_rows(spark):
    docs = frame(spark, messy())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert rows, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).collect() == [], name


def test_pipeline(spark):
    import __spark_entry__ as entry

    got = entry.queries()["pipeline"](spark, SF)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(got.columns)
    assert got.count() > 0
    assert "pipeline" not in entry.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in entry.queries() if re.match(r"op\d+_", q)}


def test_pipeline_equals_chained_stages(spark, reference):
    """The pipeline's rows, as a multiset, against brute-force stages one after the other (scores taken from the classifier)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.score >= 0.5}
    rows = {r.doc_id: (r.text, r.source) for r in docs.collect() if r.doc_id in good}
    last = {}
    for i, (t, _) in rows.items():
        raw = (t or "").encode().lower()
        last[raw] = max(i, last.get(raw, i))
    ids = sorted(last.values())
    marks = {i: simhash(rows[i][0]) for i in ids}
    of = components(ids, [(a, b) for a in ids for b in ids if b < a and (marks[a] ^ marks[b]).bit_count() <= 4])
    size = defaultdict(int)
    line = []
    for i in sorted(set(of.values())):
        t, s = rows[i]
        size[s] += words(t)
        line.append((hashlib.md5(f"17|{i}".encode()).hexdigest(), words(t), i))
    quota = {s: math.floor(x + 1e-9) for s, x in targets(size).items()}
    at, want = defaultdict(int), []
    for _, n, i in sorted(line):
        t, s = rows[i]
        coded = reference.encode_ordinary(t or "")
        told = (i, len(coded), hashlib.sha256(",".join(map(str, coded)).encode()).hexdigest(), sha((t or "").encode()))
        want += [told] * sum(n > 0 and at[s] + k * size[s] < quota[s] for k in (0, 1))
        at[s] += n
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(want) > len(set(want)) > 20
    assert sorted(map(tuple, got)) == sorted(want)
