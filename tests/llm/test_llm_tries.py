"""Conversation tries, clusters and languages against SQL, plain loops and held-out rows."""

import hashlib
import re
import zlib

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyward.llm import clustering, language, prefix_trie

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_centroid_clusters"])
def test_sql(spark, name):
    expected = oracle.sql_rows(oracle.connect(SMALL), entry.oracle_sql()[name])
    assert oracle.spark_rows(entry.queries()[name](spark, SMALL)) == expected


# --- tries ------------------------------------------------------------------------------------------------


def plain_trie(paths):
    """Nodes by walking every beginning: {(conv_id, depth): row}."""
    members, ends = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    children, leaves, saved = {}, {}, {}
    for key in members:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    for key, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] = leaves.get(key[:d], 0) + (key not in children)
            saved[key[:d]] = saved.get(key[:d], 0) + (len(held) - 1) * words
    out = {}
    for key, held in members.items():
        parent = min(members[key[:-1]]) if key else None
        end = hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest()
        out[min(held), len(key)] = (parent, len(held), children.get(key, 0), leaves[key], saved[key], end)
    return out


def found_trie(df):
    return {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in df.collect()
    }


def borrowed(turns):
    """The query's rule: the first turns of c - c % 20 instead of one's own."""
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def conversations(seed):
    """Copies, shared beginnings, long conversations, missing lenders."""
    rng = np.random.default_rng(seed)
    words = ["", "yes", "no \t maybe", "A longer\nanswer of words", "ü 日本", "  "]
    turns = {}
    for c in range(300):
        if 20 <= c < 40 or c % 20 == 0 and c % 60 == 0:
            continue
        n = 40 if c % 50 == 7 else rng.integers(1, 7)
        first = 0 if c % 3 else rng.integers(0, 6)  # most conversations begin alike
        turns[c] = [("user" if i % 2 == 0 else None, words[first] if i == 0 else words[rng.integers(0, 6)]) for i in range(n)]
        if c % 3 == 1:
            turns[c] = [("user", "copy"), (None, "of the same"), ("user", "words")]
    return turns


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cells", [1 << 3, 1 << 16])
def test_tries_of_many_copies(spark, monkeypatch, seed, cells):
    """Small blocks and, once, a sketch so small that it proves hardly anything."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    monkeypatch.setattr(prefix_trie, "cells_for", lambda n: cells)
    turns = conversations(seed)
    rows = [(c, i * 3 if i else None, role, text) for c, own in turns.items() for i, (role, text) in enumerate(own)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    clear = {c: [(role or "", text or "") for role, text in own] for c, own in turns.items()}
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    assert found_trie(prefix_trie.prefix_trie(df)) == plain_trie(clear)
    assert found_trie(prefix_trie.prefix_trie(df, 20, head, 3)) == plain_trie(borrowed(clear))


def test_tries_of_odd_rows(spark):
    rows = [
        (None, 1, "user", "no conversation"),
        (1, None, None, None),  # one turn without anything
        (1, 5, "user", "x y"),
        (2, 7, "user", "same"),
        (2, 7, "user", "same"),  # a repeated row is a turn of its own
        (-3, 1, "user", "long " * 50_000),
        (9_000_000_000, -4, "user", "same"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("z") for c in ("a", "b", "block", "rank", "depth", "length", "place", "words")})
    paths = {
        1: [("", ""), ("user", "x y")],
        2: [("user", "same")] * 2,
        -3: [("user", "long " * 50_000)],
        9_000_000_000: [("user", "same")],
    }
    nodes = prefix_trie.prefix_trie(df)
    assert found_trie(nodes) == plain_trie(paths)
    told = {(r.conv_id, r.depth): (r.role, r.text) for r in prefix_trie.with_texts(nodes, df).collect()}
    assert told[1, 2] == ("user", "x y") and told[1, 1] == ("", "") and told[-3, 0] == (None, None)
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    alone = found_trie(prefix_trie.prefix_trie(df.filter("conv_id = 2")))
    assert alone == plain_trie({2: paths[2]})


def test_tails_are_proven_and_not_shuffled(spark):
    """Of conversations that share their first turn only, three rows of each are shuffled, and few that the sketch takes for shared."""
    rows = [(c, i, "user", "hello" if i == 0 else f"{c} {i}") for c in range(200) for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    screened = prefix_trie._screened(prefix_trie.prefixes(prefix_trie.numbered(df)))
    assert screened.filter("not one or not parent_one").count() < 3 * 200 + 0.05 * len(rows)
    assert screened.filter("one and depth < 2").count() == 0


# --- clusters ---------------------------------------------------------------------------------------------


def plain_clusters(ids, points, k, rounds, seed):
    order = sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"{seed}:{ids[i]}".encode()).hexdigest())
    centres = [list(points[i]) for i in order[:k]]

    def assign():
        out = []
        for p in points:
            far = [sum((x - y) ** 2 for x, y in zip(p, c)) for c in centres]
            out.append(min(range(len(far)), key=lambda c: (far[c], c)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centres)):
            held = [p for p, o in zip(points, own) if o == c]
            if held:
                centres[c] = [sum(column) // len(held) for column in zip(*held)]
    own = assign()
    far = [sum((x - y) ** 2 for x, y in zip(p, centres[o])) for p, o in zip(points, own)]
    sums = {c: sum(f for f, o in zip(far, own) if o == c) for c in range(len(centres))}
    return {i: (o, f, sums[o], sum(far), centres[o]) for i, o, f in zip(ids, own, far)}


def found_clusters(df, **settings):
    rows = clustering.centroid_clusters(df, **settings).collect()
    return {r.vec_id: (r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in rows}


@pytest.mark.parametrize("spread", [3, 200])
def test_clusters(spark, spread):
    """Few different points (ties, equal centroids, empty clusters) and many."""
    rng = np.random.default_rng(spread)
    points = rng.integers(-spread, spread + 1, size=(400, 5))
    points[:130] = points[0]  # a third are copies
    rows = [(i, [float(x) / 1024 for x in p], 1) for i, p in enumerate(points.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int").repartition(5)
    expected = plain_clusters(range(400), points.tolist(), 8, 10, 3)
    assert found_clusters(df, dim=5) == expected
    assert found_clusters(df.filter("vec_id < 3"), dim=5) == plain_clusters(range(3), points[:3].tolist(), 8, 10, 3)


def test_later_rounds_scan_only_what_expired(spark, monkeypatch):
    counts = []
    scanned = clustering._Runs.scanned

    def counted(self, rows, centroids, offsets):
        new = scanned(self, rows, centroids, offsets)
        counts.append(new.count())
        return new

    monkeypatch.setattr(clustering._Runs, "scanned", counted)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16)) * 4
    rows = [(i, (centres[i % 8] + rng.normal(size=16)).tolist()) for i in range(4_000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    clustering.centroid_clusters(df, dim=16).count()
    assert counts[0] == 4_000 and counts[-1] < 400 and sum(counts[1:]) < 3 * 4_000


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.5]),
        (2, None),
        (3, []),
        (4, [1.0]),
        (5, [1.0, None]),
        (6, [nan, 1.0]),
        (7, [inf, 1.0]),
        (8, [1e30, 1.0]),
        (9, [0.5, -0.5]),
        (9, [2.0, 2.0]),
        (None, [2.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("z") for c in ("point", "was", "cluster", "expiry", "distance")})
    found = clustering.centroid_clusters(df, k=2, dim=2).collect()
    assert sorted((r.vec_id or 0, r.distance) for r in found) == [(0, 0), (1, 0), (9, 0), (9, 0)]
    assert clustering.centroid_clusters(df.limit(0)).count() == 0
    assert clustering.digests(clustering.centroid_clusters(df.filter("vec_id = 2"))).count() == 0


# --- languages --------------------------------------------------------------------------------------------


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    facts = {r.doc_id: r for r in docs.select("doc_id", "lang", "text").collect()}
    rows = entry.queries()["op13_languages"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(facts)
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        lettered = any(c.isalpha() for c in facts[r.doc_id].text or "")
        assert (r.lang_pred == "und") == (not lettered)
        if r.held_out and lettered:
            right.append(r.lang_pred == facts[r.doc_id].lang)
    assert len(right) > 200 and np.mean(right) > 0.97


def test_windows_cover_whole_texts():
    data = np.frombuffer(bytes(range(256)) * 9, np.uint8)
    offsets = np.array([0, 0, 5, 256, 257 + 256, 1200, len(data)])
    starts, sizes, first = language.windows(data, offsets)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        held = [(starts[j], starts[j] + sizes[j]) for j in range(first[i], first[i + 1])]
        assert held[0][0] == a and held[-1][1] == b and all(x <= y <= language.WINDOW + x for x, y in held)
        # Neighbours overlap, so that every run of the widest filter lies in one of them.
        assert all(y - x >= max(language.WIDTHS) - 1 for (_, y), (x, _) in zip(held, held[1:]))


def test_window_answers_are_the_plain_formula():
    rng = np.random.default_rng(3)
    rows = np.stack([np.r_[rng.integers(0, 256, n), np.full(language.WINDOW - n, language.PAD)] for n in (0, 3, 40, 256)]).astype(np.int16)
    net = language.train(["a", "b", "c"], rows, np.array([0, 1, 2, 1]), least_steps=2)
    for row, found in zip(rows, net.answers(rows)):
        features = []
        for f in range(len(language.WIDTHS) * language.FILTERS):
            width = language.WIDTHS[f // language.FILTERS]
            best = 0.0
            for i in range(language.WINDOW):
                seen = [net.embedding[row[i + k]] if i + k < len(row) else net.embedding[language.PAD] for k in range(width)]
                answer = sum(float(s @ net.kernel[k * language.DIM : (k + 1) * language.DIM, f]) for k, s in enumerate(seen))
                best = max(best, answer + float(net.bias[f]))
            features.append(best)
        z = np.array(features) @ net.weights + net.offsets
        assert np.allclose(found, z - np.log(np.exp(z).sum()), atol=1e-3)


def test_languages_of_odd_rows(spark):
    english, german = "the rain and the sun of this day ", "der Regen und die Sonne an diesem schönen Tag "
    rows = [(i, (english if i % 2 else german) * (1 + i % 5), "en" if i % 2 else "de") for i in range(200)]
    rows += [(300, None, "en"), (301, "", "de"), (302, "12 !? ...", "en"), (303, english * 20_000, None), (None, german, None)]
    rows += [(304, german, None), (304, german, None), (305, "日本語のテキスト", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.withColumns({c: F.lit("z") for c in ("hash", "out", "n", "rank", "last", "score", "lettered", "symbols")})
    found = {}
    for r in language.languages(df).collect():
        found.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert [found[i][0] for i in (300, 301, 302)] == [("und", 0.0)] * 3
    assert found[303][0][0] == "en" and found[None][0][0] == "de" and found[304][0] == found[304][1]
    assert found[305][0][0] in ("en", "de") and sum(map(len, found.values())) == len(rows)
    assert language.languages(df.limit(0)).count() == 0
    unlearned = language.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}
    single = language.languages(df.withColumn("lang", F.lit("en"))).filter("doc_id = 304").first()
    assert (single.lang_pred, single.score) == ("en", 1.0)
