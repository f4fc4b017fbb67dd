"""Exact top-k, prefix trie and ranked lexical search against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from evenkeel.llm import lexical, mtree, prefixes
from evenkeel.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def clip(score):
    """Scores beyond 64 bits count as the largest or smallest long."""
    return max(-mtree.LARGEST, min(mtree.LARGEST, score))


def brute_top_k(rows, k):
    """rows: (vec_id, whole numbers) → {query's place: [(vec_id, score)]}."""
    out = {}
    for i, (q, x) in enumerate(rows):
        if q % 100 == 0:
            others = [(-clip(sum(map(int.__mul__, x, y))), v) for j, (v, y) in enumerate(rows) if j != i and len(x) == len(y)]
            out[i] = [(v, -s) for s, v in sorted(others)[:k]]
    return out


def clusters(n, width, spread, seed):
    draw = np.random.Generator(np.random.PCG64(seed))
    centres = draw.normal(size=(12, width))
    return np.floor(1024 * (centres[draw.integers(0, 12, n)] + spread * draw.normal(size=(n, width))))


@pytest.mark.parametrize("spread", [0.02, 0.3, 5.0])
def test_tree_search_equals_brute_force_and_skips_pages(spread, monkeypatch):
    monkeypatch.setattr(mtree, "LEAF", 32)
    monkeypatch.setattr(mtree, "FANOUT", 5)
    x = clusters(3000, 8, spread, 1)
    tree, q, order = mtree.Tree.build(x, 7), x[::100], np.arange(len(x))
    assert sorted(i for leaf in tree.leaves for i in leaf.tolist()) == list(range(len(x)))
    computed = []
    monkeypatch.setattr(mtree, "exact_scores", lambda a, b, f=mtree.exact_scores: computed.append(len(a) * len(b)) or f(a, b))
    row, entry, score = tree.search(q, 11, np.full(len(q), -mtree.LARGEST), order)
    for i in range(len(q)):
        s = (x @ q[i]).astype(np.int64)
        want = np.lexsort((order, -s))[:11]
        assert entry[row == i].tolist() == want.tolist() and score[row == i].tolist() == s[want].tolist()
    assert spread > 1 or sum(computed) < 0.7 * len(q) * len(x)
    limited = tree.search(q, 11, np.array([score[row == i].min() for i in range(len(q))]), order)
    assert all(np.array_equal(a, b) for a, b in zip(limited, (row, entry, score)))


def test_exact_scores_beyond_doubles_and_longs():
    draw = random.Random(3)
    for size in (2 ** 20, 2 ** 28, 2 ** 40, 2.0 ** 130):
        a = np.array([[float(draw.randint(-4, 4)) * size + (draw.randint(-9, 9) if size < 2 ** 53 else 0) for _ in range(5)] for _ in range(4)])
        want = [[max(-mtree.LARGEST, min(mtree.LARGEST, sum(int(x) * int(y) for x, y in zip(r, s)))) for s in a] for r in a]
        assert mtree.exact_scores(a, a).tolist() == want


def test_top_k_of_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_VECTORS", 60)  # many regions and trees
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 3)
    draw = random.Random(5)
    rows = [(i, [draw.uniform(-1, 1) + 3 * (i % 4 == j) for j in range(4)]) for i in range(700)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(1000, 1300)]  # copies, queries among them
    rows += [(100, [0.5, 0.5, 0.5, 0.5]), (100, rows[100][1]), (100, rows[100][1]), (200, [0.0] * 4)]  # an id again
    rows += [(300, [1.0, 2.0]), (301, [2.0, 1.0]), (1400, [7.0]), (1500, []), (1501, []), (1600, [3e38, 1.0, 0.0, 0.0]), (1601, [-3e38, 1.0, 0.0, 0.0])]
    bad = [(700, None), (800, [1.0, None, 0.0, 0.0]), (900, [float("nan"), 0.0, 0.0, 0.0]), (1, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id bigint, embedding array<float>, query_id string, rank int")
    vectors = mtree.quantised(df)
    got = collections.defaultdict(list)
    for r in mtree.exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), 10).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows]
    want = collections.defaultdict(list)
    for i, found in brute_top_k(whole, 10).items():
        want[whole[i][0]] += [(n + 1, v, s) for n, (v, s) in enumerate(found)]
    assert set(got) == {q for q in want if want[q]} and 1400 not in got and len(got[100]) == 40
    for q in got:
        assert sorted(got[q]) == sorted(want[q]), q
    assert mtree.exact_top_k(vectors.where("false"), vectors.where("false")).count() == 0


def brute_trie(convs):
    """{conv: [(role, text)]} → rows of all nodes."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    rows = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in below),
                     sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def rebuilt(convs, families=5, most=8):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        out[c] = convs.get(c - int(math.fmod(c, families)), [])[:h] + turns[h:]
    return out


TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, name string"


@pytest.mark.parametrize("runs", [(1, 10 ** 6), (3, 10 ** 6), (10 ** 6, 7), (10 ** 6, 10 ** 6)])
def test_trie_equals_brute_force(spark, runs):
    draw = random.Random(9)
    convs, rows = {}, []
    for c in list(range(-7, 150)) + [10 ** 12 + i for i in range(12)]:
        if c % 10 == 3:  # a family without its first conversation
            continue
        turns = [("user" if i % 2 == 0 else "assistant", draw.choice(["", "é", "ab", "long " * 3])) for i in range(draw.choice([1, 2, 3, 4, 9, 12]))]
        if c % 4 == 0:
            turns = [("user", "the same"), ("assistant", "of all")] * 3
        convs[c] = turns
        rows += [(c, i if i else None, r if r != "user" or i else r, t, 1, "n") for i, (r, t) in enumerate(turns)]
    rows.append((None, 1, "user", "no conversation", 1, "n"))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS)
    whole = prefixes.share_openings(prefixes.sequences(df))
    got = [tuple(r) for r in prefixes.prefix_trie(whole, *runs).collect()]
    assert collections.Counter(got) == collections.Counter(brute_trie(rebuilt(convs)))


def test_trie_of_nulls_ties_and_no_turns(spark):
    df = spark.createDataFrame([(1, 0, None, None, 1, ""), (1, 0, "user", "b", 1, ""), (1, 0, "user", "b", 1, ""), (2, None, "", "", 1, "")], TURNS)
    rows = {r["conv_id"]: [t["bytes"] for t in r["turns"]] for r in prefixes.sequences(df).collect()}
    assert sorted(rows[1]) == [0, 1, 1] and rows[2] == [0]
    whole = prefixes.share_openings(prefixes.sequences(df))
    assert prefixes.prefix_trie(whole.where("false")).count() == 0
    turnless = whole.selectExpr("conv_id", "slice(turns, 1, 0) AS turns")
    root = prefixes.prefix_trie(turnless).collect()
    assert [tuple(r) for r in root] == brute_trie({1: [], 2: []})
    deep = spark.createDataFrame([(c, i, "user", f"turn {i}", 1, "") for c in (5, 6) for i in range(900 + c)], TURNS)
    got = prefixes.prefix_trie(prefixes.sequences(deep)).collect()
    assert len(got) == 907 and max(r["saved_tokens"] for r in got) == sum(len(f"turn {i}") for i in range(905))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_ranks(docs, items, k=10):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n, total = sum(bool(t) for t in terms), sum(map(len, terms))
    df = collections.Counter(x for t in terms for x in set(t))
    out = []
    for item, text in items:
        asked = [t for t in TERM.findall((text or "").translate(LOWER)) if t in df]
        scored = []
        for (doc, _), held in zip(docs, terms):
            tf = collections.Counter(held)
            m = 25 + (75 * len(held) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in asked if tf[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if missing else doc, -s) for i, (s, missing, doc) in enumerate(sorted(scored)[:k])]
    return out


def test_lexical_ranks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 900)  # several blocks of items
    draw = random.Random(11)
    words = ["the", "of"] * 20 + [f"w{i}" for i in range(60)] + ["É", "é", "ÄB", "x9", "Ab"]
    text = lambda n: draw.choice([" ", "-", "\n"]).join(draw.choice(words) for _ in range(n))
    docs = [(i, text(draw.choice([1, 5, 30, 200]))) for i in range(400)]
    docs += [(7, docs[7][1]), (7, "w1 w1 w1"), (None, "w2 w3"), (None, "w2 w3"), (900, None), (901, ""), (902, " \x00-_"), (903, "w5 " * 30000)]
    items = [(i, text(draw.choice([1, 4, 30]))) for i in range(60)] + [(3, "w1 W1 w2"), (3, "w9"), (None, "w2 w3"), (70, None), (71, "nowhere"), (72, "")]
    d = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id bigint, text string, n int, rank string")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    got = [tuple(r) for r in lexical.rank_documents(d, q).collect()]
    assert collections.Counter(got) == collections.Counter(brute_ranks(docs, items))
    assert lexical.rank_documents(d.where("false"), q).count() == 0 and lexical.rank_documents(d, q.where("false")).count() == 0
    assert lexical.rank_documents(d.where("doc_id > 899 and doc_id < 903"), q).count() == 0


def test_limited_accumulators_lose_nothing():
    draw = np.random.Generator(np.random.PCG64(2))
    n, plan = 5000, []
    terms, docs, tfs = [], [], []
    for t, share in enumerate((0.004, 0.006, 0.02, 0.3, 0.6, 0.9)):
        some = np.flatnonzero(draw.random(n) < share)
        terms.append(np.full(len(some), t)), docs.append(some), tfs.append(draw.integers(1, 6, len(some)))
        plan.append((t, math.floor(1000 * math.log((2 * n + 2) / (2 * len(some) + 1)))))
    m = 25 + draw.integers(0, 200, n)
    index = lexical.Index(np.concatenate(terms), np.concatenate(docs), np.concatenate(tfs), m)
    score = np.zeros(n, np.int64)
    for (t, w), d, f in zip(plan, docs, tfs):
        score[d] += w * (10 ** 9 * f // (1000 * f + 8 * m[d]))
    ids = draw.permutation(n)
    want = np.lexsort((ids, -score))[:10]
    got, values = index.best(plan, 10, ids)
    assert got.tolist() == want.tolist() and values.tolist() == score[want].tolist()


def test_columns_of_the_new_queries(spark):
    want = {"op11_exact_top_k": "query_id rank vec_id score", "op13_lexical_search": "item_id rank doc_id score",
            "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"}
    for name, columns in want.items():
        kinds = dict(QUERIES[name](spark, FOLDER).dtypes)
        assert set(columns.split()) <= set(kinds) and kinds.get("rank", "int") == "int"
        assert all(kinds[c] == "bigint" for c in columns.split() if c not in ("rank", "ends_sha256"))
