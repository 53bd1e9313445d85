"""The registered queries against SQL or a brute-force version, on the small tables."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest

import __spark_entry__ as entry

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def texts(sf_dir):
    return dict(duckdb.connect().execute(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet'").fetchall())


def result(spark, name, sf_dir=TINY):
    return entry.queries()[name](spark, sf_dir)


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


@pytest.mark.parametrize("name", ["op1_decontamination", "op4_licenses"])
def test_sql(spark, name):
    expected = oracle.sql_rows(oracle.connect(SMALL), entry.oracle_sql()[name])
    assert oracle.spark_rows(result(spark, name, SMALL)) == expected


def test_toxicity_on_held_out_rows(spark):
    scored = result(spark, "op2_toxicity", SMALL).collect()
    labels = dict(duckdb.connect().execute(f"select doc_id, toxic from '{SMALL}/labels.parquet'").fetchall())
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    rows = [(r.score, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    pairs = [(a > b) + (a == b) / 2 for a, x in rows for b, y in rows if x == 1 and y == 0]
    assert len(scored) == len(texts(SMALL)) and np.mean(pairs) > 0.75  # some 300 labelled rows to learn from


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0


def pii_base(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            wrong = {
                "email": False,
                "ip": kind == "ip" and any(int(p) > 255 for p in m.group().split(".")),
                "card": not 13 <= len(digits) <= 19 or not luhn(digits),
                "phone": not 9 <= len(digits) <= 15,
            }
            if not wrong[kind]:
                out.append((kind, f"{kind}:{m.start()}:{m.end()}"))
    return out


def test_pii(spark):
    docs = texts(TINY)
    for r in result(spark, "op3_pii").collect():
        base = pii_base(docs.pop(r.doc_id))
        counts = collections.Counter(kind for kind, _ in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == sha([label for _, label in base])
        assert {label for _, label in base} <= set(filter(None, r.spans.split(",")))
    assert not docs


def secret_base(text):
    out = []
    for kind, (name, pattern, least, group) in enumerate(
        (
            ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
            ("access", r"AKIA[A-Z0-9]+", 18, 0),
            ("hex", r"[0-9a-f]+", 16, 0),
        )
    ):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                out.append((m.start(), kind, f"{name}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_secrets(spark):
    docs = texts(TINY)
    for r in result(spark, "op8_secrets").collect():
        base = secret_base(docs.pop(r.doc_id))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == sha([label for _, _, label in base])
        assert {label for _, _, label in base} <= set(filter(None, r.spans.split(",")))
    assert not docs


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = texts(TINY)
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in docs.items()}
    rows = result(spark, "op5_packing").collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    covered = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r["offset"], r.length))
    for parts in [*covered.values(), *sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    totals = [sum(n for _, n in parts) for parts in sequences.values()]
    assert max(totals) <= 4096 and sum(totals) > 0.97 * 4096 * (len(totals) - 1)


def test_token_counts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = texts(TINY)
    rows = collections.defaultdict(list)
    for r in result(spark, "op6_token_counts").collect():
        rows[r.doc_id].append(r)
    assert set(rows) == set(docs)
    for d, text in docs.items():
        found = sorted(rows[d], key=lambda r: r.section)
        encoding = tokenizer.encode(text, add_special_tokens=False)
        ends, at = [], 0
        for line in text.splitlines(keepends=True) if not re.search("[\r\v\f\x1c-\x1e\x85  ]", text) else []:
            at += len(line)
            ends.append(at)
        if not ends:
            continue
        assert [(r.start, r.end) for r in found] == list(zip([0, *ends], ends))
        counts = [0] * len(ends)
        for a, b in encoding.offsets:
            shares = [min(b, e) - max(a, s) for s, e in zip([0, *ends], ends)]
            counts[shares.index(max(shares))] += 1
        assert [r.n_tokens for r in found] == counts and found[0].doc_tokens == len(encoding.ids)


def shingle_sets(docs):
    out = {}
    for d, text in docs.items():
        words = re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
        out[d] = collections.Counter(runs)
    return out


def near_components(docs):
    sets = shingle_sets(docs)
    head = {d: d for d in docs}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = sum((sets[a] & sets[b]).values())
            if both and 10 * both >= 8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = root(a), root(b)
                head[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


def test_near_duplicates(spark):
    expected = near_components(texts(TINY))
    rows = result(spark, "op7_dart_minhash").collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def repeated(bodies, window=200):
    count = collections.Counter(b[i : i + window] for b in bodies for i in range(len(b) - window + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def test_repeated_strings(spark):
    docs = {d: t.encode() for d, t in texts(TINY).items()}
    expected = dict(zip(docs, repeated(list(docs.values()))))
    rows = result(spark, "op9_suffix_dedup").collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == {
        d: (*e[:3], hashlib.sha256(e[3]).hexdigest()) for d, e in expected.items()
    }


def test_embeddings(spark):
    rows = duckdb.connect().execute(f"select vec_id, label, embedding from '{TINY}/embeddings.parquet'").fetchall()
    vectors = np.array([r[2] for r in rows], float)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    alike = (vectors @ vectors.T >= 0.93) & np.equal.outer([r[1] for r in rows], [r[1] for r in rows])
    expected = {r[0]: int(n) - 1 for r, n in zip(rows, alike.sum(axis=1))}
    assert {r.vec_id: r.n_links for r in result(spark, "op10_embedding_dedup").collect()} == expected


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = texts_of(docs)
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        after = texts_of(docs)
        assert docs.columns == columns and set(after) <= set(before)
        sizes.append(len(after))
        if name == "near_duplicates":
            heads = near_components(before)
            assert set(after) == {d for d, head in heads.items() if d == head}
        if name == "decontamination":
            assert not spark_hits(spark, docs)
        if name == "secrets":
            assert set(after) == set(before)
            assert not any(secret_base(t) for t in after.values())
            assert all(after[d] == t for d, t in before.items() if not secret_base(t) and "[SECRET]" not in after[d])
    assert all(a >= b for a, b in zip(sizes, sizes[1:])) and sizes[-1] > 0.7 * sizes[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def spark_hits(spark, docs):
    """Contaminated documents by a plain scan of word windows."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    windows = set()
    for (text,) in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect():
        words = word.findall((text or "").translate(upper))
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    hits = []
    for d, text in texts_of(docs).items():
        words = word.findall(text.translate(upper))
        if any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1)):
            hits.append(d)
    return hits


def linked_groups(vectors, labels, least):
    """Links and smallest reachable row per row, by all pairs of equal label."""
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    links, head = np.zeros(len(units), int), list(range(len(units)))

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for label in set(labels.tolist()):
        at = np.flatnonzero(labels == label)
        alike = units[at] @ units[at].T >= least
        links[at] = alike.sum(axis=1) - 1
        for i, j in np.argwhere(np.triu(alike, 1)):
            x, y = root(at[i]), root(at[j])
            head[max(x, y)] = min(x, y)
    return links, [root(i) for i in range(len(units))]


def test_components_of_embeddings(spark):
    rows = duckdb.connect().execute(f"select vec_id, label, embedding from '{SMALL}/embeddings.parquet'").fetchall()
    ids = [r[0] for r in rows]
    links, heads = linked_groups(np.array([r[2] for r in rows], float), np.array([r[1] for r in rows]), 0.93)
    least = {}
    for i, head in zip(ids, heads):
        least[head] = min(least.get(head, i), i)
    found = {r.vec_id: r for r in result(spark, "op10_embedding_dedup", SMALL).collect()}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in found.items()} == {
        i: (n, least[head], i == least[head]) for i, n, head in zip(ids, links, heads)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_rare_links_are_all_found(spark, seed):
    """Two dozen pairs just above the limit among thousands of vectors that have no link."""
    from tallyward.llm import embeddings

    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(8_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    for i in range(24):
        aside = rng.normal(size=64)
        aside -= aside @ vectors[i] * vectors[i]
        vectors[-1 - i] = 0.935 * vectors[i] + (1 - 0.935**2) ** 0.5 * aside / np.linalg.norm(aside)
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    links, heads = linked_groups(vectors, np.ones(len(vectors), int), 0.93)
    assert sum(links) == 48
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert found == {i: (n, head) for i, (n, head) in enumerate(zip(links, heads))}


def test_tiny_and_huge_numbers_of_embeddings(spark):
    from tallyward.llm import embeddings

    rows = [(1, [1e-200, 0.0], 1), (2, [1e200, 1e190], 1), (3, [0.0, 5e-324], 1), (4, [3.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()} == {1: 2, 2: 2, 3: 0, 4: 2}
