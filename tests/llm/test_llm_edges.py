"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import textwrap

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_queries import near_components, pii_base, repeated, secret_base

from tallyward.llm import (
    decontaminate,
    embeddings,
    graph,
    licenses,
    minhash,
    packing,
    pii,
    secrets,
    suffixes,
    textwords,
    token_counts,
    toxicity,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = " ".join(f"word{i % 997}" for i in range(40_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [
    (1, "The same text of a few words, with token = \"0123456789abcdef0123\" and joe@site.org in it. " + PASSAGE),
    (2, "The same text of a few words, with token = \"0123456789abcdef0123\" and joe@site.org in it. " + PASSAGE),
    (2, "The same text of a few words, with token = \"0123456789abcdef0123\" and joe@site.org in it. " + PASSAGE),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, "9" * 30_000),
    (8, "Ünïcode ÄÖÜ straße Σίσυφος İstanbul 日本語 👍🏽 é " + PASSAGE),
    (None, "No id here. Released under the MIT License."),
    (9, "one two"),
    (10, "a.b.c." * 3_000 + "@" + ".x" * 5_000),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns that have the names of the operators' own."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    clashes = ["k1", "id", "node", "words", "bucket", "_text", "component", "spans", "score", "rank", "body"]
    return df.withColumns({c: F.lit("x") for c in clashes} | {"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long")})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, "one two"), (3, None), (4, "..."), (5, PASSAGE)], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 0, 0), (6, 1, None), (None, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_contamination(docs, nothing, items):
    rows = by_id(decontaminate.digests(decontaminate.contamination(docs, items)))
    assert [r.n_hit for r in rows[2]] == [60, 60] and rows[1][0].n_items == 2
    assert rows[9][0].n_hit == 2 and rows[8][0].n_hit == 60
    assert rows[9][0].items_sha256 == hashlib.sha256(b"2").hexdigest()
    for d in (3, 4, 5):
        assert (rows[d][0].n_words, rows[d][0].n_hit, rows[d][0].contaminated) == (0, 0, False)
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    # Without a broadcast the answer is the same.
    shuffled = by_id(decontaminate.digests(decontaminate.contamination(docs, items, broadcast_limit=0)))
    assert {d: sorted(map(tuple, r)) for d, r in shuffled.items()} == {d: sorted(map(tuple, r)) for d, r in rows.items()}


def test_toxicity(docs, nothing, labels):
    rows = by_id(toxicity.toxicity(docs, labels))
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert rows[3][0].score == rows[4][0].score == rows[5][0].score
    assert rows[2][0].score == rows[2][1].score
    assert toxicity.toxicity(nothing, labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == len(TEXTS)
    assert set(toxicity.without_toxic(docs, labels).columns) == set(docs.columns)


def test_toxicity_learns_a_word(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        toxic = i % 3 == 0
        words = [rnd.choice(["sun", "rain", "wind", "snow", "fog"]) for _ in range(30)]
        if toxic:
            words[rnd.randrange(30)] = "badword" + rnd.choice("abcdefgh") * rnd.randrange(1, 4)
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).join(df, "doc_id")
    right = scored.filter("held_out").select(((F.col("score") >= 0.5) == (F.col("toxic") == 1)).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.95


def test_toxicity_learns_from_every_labelled_row(spark):
    """A rare word of very long texts and of few rows among many, in several groups; thresholds of all kept-back rows."""
    rnd = random.Random(2)
    rows = []
    for i in range(1_200):
        toxic = i % 40 == 0
        words = [rnd.choice(["sun", "rain", "wind", "snow", "fog"]) for _ in range(14_000 if toxic else 20)]
        words[3] = "zzbad" if toxic else words[3]
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic"), group_words=100_000)
    again = {r.doc_id: r.score for r in found.collect()}
    least = min(again[i] for i, _, toxic in rows if toxic)
    assert least > max(again[i] for i, _, toxic in rows if not toxic)


def test_personal_spans(docs, nothing):
    rows = by_id(pii.digests(pii.personal_spans(docs)))
    for d, text in TEXTS:
        base = [label for _, label in pii_base(text or "")]
        assert {r.base_sha256 for r in rows[d]} == {hashlib.sha256(",".join(base).encode()).hexdigest()}
    assert pii.personal_spans(nothing).count() == 0


def test_looser_spans_are_learnt(spark):
    plain = [(i, f"mail me at joe{i}@site.com or call +1 (168) 555-52{i}") for i in range(10, 90)]
    loose = [(100, "contact by e-mail: ann (at) site (dot) org"), (101, "version 123-45-6789 of the order 415-555-1234")]
    found = by_id(pii.digests(pii.personal_spans(spark.createDataFrame(plain + loose, "doc_id long, text string"))))
    assert found[100][0].spans == "email:19:42" and found[101][0].spans == ""


def test_licenses(docs, nothing):
    rows = by_id(licenses.licenses(docs))
    assert rows[None][0].licenses == ["MIT"] and rows[3][0].licenses == [] and len(rows[2]) == 2
    assert licenses.licenses(nothing).count() == 0


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at", ["Apache-2.0"]),
        (" ".join(f"{licenses.SENTENCES[s]}." for s in ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse")), ["BSD-3-Clause"]),
        (" ".join(f"{licenses.SENTENCES[s]}." for s in ("bsd_redistribute", "bsd_source", "bsd_binary")), ["BSD-2-Clause"]),
        (" ".join(f"{licenses.SENTENCES[s]}." for s in ("bsd_source", "bsd_redistribute", "bsd_binary")), []),
        ("RELEASED under the mit license!  Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0", "MIT"]),
        ("A licence of no known kind.", []),
    ],
)
def test_license_rules(spark, text, expected):
    row = licenses.licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.licenses == expected


def test_wrapped_licenses(spark):
    def wrapped(names, width, sign="", first=""):
        blocks = [textwrap.fill(f"{first}{licenses.SENTENCES[n].rstrip(':.')}.", width) for n in names]
        return "\n".join((sign + line).rstrip() for line in "\n\n".join(["Copyright (c) 2020 Ann Other", *blocks]).split("\n"))

    kinds = {
        "MIT": ("mit_grant", "mit_notice", "mit_warranty"),
        "BSD-3-Clause": ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse"),
        "BSD-2-Clause": ("bsd_redistribute", "bsd_source", "bsd_binary"),
        "ISC": ("isc_grant",),
        "GPL-3.0-or-later": ("gpl_free", "gpl_hope", "gpl_see"),
        "GPL-2.0-or-later": ("gpl2_free", "gpl_hope", "gpl_see"),
        "Apache-2.0": ("apache_ref_you", "apache_comply", "apache_obtain", "apache_as_is", "apache_see"),
        "Unlicense": ("unlicense_free",),
    }
    rows = []
    for name, ids in kinds.items():
        for width in (30, 72, 80):
            for sign in ("", "# ", " * ", "// ", "    ", ";; ", "//! "):
                rows.append((name, " ".join(ids), wrapped(ids, width, sign)))
        rows.append((name, " ".join(ids), wrapped(ids, 72).replace("\n", "\r\n")))
    rows.append(("MIT", "mit_ref", "a line of prose\nReleased under the MIT License\nand one more"))
    rows.append(("", "", "text before Released under the MIT\nLicense and text behind"))
    rows.append(("", "", "Released under the MIT\n\nLicense"))
    rows.append(("MIT", "mit_grant mit_notice", wrapped(("mit_grant",), 72) + "\n\n" + "a b\nc d\n" * 9 + "\n" + wrapped(("mit_notice",), 72)))
    df = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: (",".join(r.licenses), r.sequence) for r in licenses.licenses(df).collect()}
    for i, (name, ids, text) in enumerate(rows):
        assert found[i] == (name, ids), text


def test_packing(docs, nothing):
    packed = packing.pack(docs, WORDS, 64)
    rows = packed.collect()
    assert sum(r.length for r in rows if r.doc_id in (3, 4, 5)) == 3  # the end ids
    whole = packing.sequences(packed)
    assert whole.agg(F.max("n_ids")).first()[0] <= 64
    assert whole.agg(F.sum(F.octet_length("ids"))).first()[0] == 4 * sum(r.length for r in rows)
    assert packing.pack(nothing, WORDS).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Zz.,'\"\n\té ÉßΣσİ1٣́̊ ẞ日👍!?-_<|>#"), max_size=60))
def test_chunks_have_the_tokenizers_ids(text):
    from tokenizers import Tokenizer

    global _encoder, _tokenizer
    if "_encoder" not in globals():
        _encoder, _tokenizer = packing.ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)
    ids = np.frombuffer(_encoder.ids(text.encode()), "<u4").tolist()
    assert ids == _tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_pack_plans(histogram):
    slots = packing.plan_packs(histogram, 64)
    fill = {}
    for length in histogram:
        ranks = sorted((a, b) for n, a, b, _, _ in slots if n == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == histogram[length]
        assert all(x[1] == y[0] for x, y in zip(ranks, ranks[1:]))
    for length, a, b, first, offset in slots:
        for s in range(first, first + b - a):
            fill.setdefault(s, []).append((offset, length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_token_counts(docs, nothing):
    found = token_counts.section_tokens(docs, BYTES, public_tokenizers.PATTERN)
    sums = found.groupBy("doc_id", "doc_tokens").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("sections")).collect()
    assert all(r.n in (r.doc_tokens, 2 * r.doc_tokens) for r in sums)  # doc 2 is there twice
    assert {r.doc_id: r.n for r in sums}[3] == 0
    two = token_counts.section_tokens(docs, BYTES, public_tokenizers.PATTERN, ("text", "lang"), by_line=False)
    assert {r.field for r in two.filter("doc_id = 4").collect()} == {"text", "lang"}
    assert token_counts.section_tokens(nothing, BYTES, public_tokenizers.PATTERN).count() == 0


def test_tokens_on_a_bound():
    ends, bounds = np.array([3, 8, 10]), np.array([4, 10])
    assert token_counts.attributed(ends, bounds, "most").tolist() == [1, 2]
    assert token_counts.attributed(ends, bounds, "start").tolist() == [2, 1]


def test_near_duplicates(docs, nothing, spark):
    rows = by_id(minhash.near_duplicates(docs))
    assert {r.component_id for r in rows[2]} == {1} and rows[1][0].kept
    assert all(rows[d][0].kept for d in (3, 4, 5, 6, 9))
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert minhash.near_duplicates(nothing).count() == 0


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Copies that mostly lie too far from each other, in tiles of a few rows."""
    monkeypatch.setattr(minhash, "TILE", 16)
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(0, 5)):
            words[rnd.randrange(120)] = f"e{rnd.randrange(40)}"
        texts[i] = " ".join(words)
    rows = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == near_components(texts)


def test_signatures_agree_as_often_as_sets_are_similar():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], rnd.integers(0, 2**63, 100, dtype=np.uint64)])
    signatures = minhash.dart_signatures(np.concatenate([a, b]), np.array([0, 400, 800]), 2048)
    assert abs((signatures[0] == signatures[1]).mean() - 300 / 500) < 0.05


def test_secret_spans(docs, nothing):
    rows = by_id(secrets.digests(secrets.secret_spans(docs)))
    for d, text in TEXTS:
        base = [label for _, _, label in secret_base(text or "")]
        assert {r.base_sha256 for r in rows[d]} == {hashlib.sha256(",".join(base).encode()).hexdigest()}
    assert secrets.secret_spans(nothing).count() == 0
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[3] is None and "0123456789abcdef" not in texts[1] and texts[6] == LONG


def test_guess_costs(spark):
    assert secrets.guess_cost("password") < secrets.guess_cost("p4ssw0rd1999") < 10 < secrets.guess_cost("xK9$vQ2!mZ7@")
    assert secrets.guess_cost("qwertyuiop") < 5 and secrets.guess_cost("aaaaaaaaaaaaaaa") < 4 and secrets.guess_cost("") == 0
    rows = [(1, "my password is xK9$vQ2!mZ7@pW here"), (2, "password: letmein1"), (3, "pwd = hunter")]
    found = by_id(secrets.digests(secrets.secret_spans(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert [found[i][0].spans for i in (1, 2, 3)] == ["value:15:29", "", ""]


def found_secrets(spark, texts):
    """Labels of the spans and the redacted text, by text."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.digests(secrets.secret_spans(df)).collect()}
    clean = {r.doc_id: r.text for r in secrets.redacted(df).collect()}
    return [(spans[i], clean[i]) for i in range(len(texts))]


def test_long_secrets(spark):
    rnd = random.Random(5)
    long = "".join(rnd.choices("abcdefghijkmnopQRSTUVWXYZ23456789!$%", k=600))
    late = "z" * 300 + long[:40]
    cheap = "z" * 100_000
    texts = [f"bearer: {long}", f"pwd={late} end", f"auth={cheap}", "pwd=" + "qw" * 50_000, "pwd=\u0130" + "abcdefgh" * 3]
    found = found_secrets(spark, texts)
    assert found[0] == ("value:8:608", "bearer: [SECRET]") and found[1] == ("value:4:344", "pwd=[SECRET] end")
    assert found[2] == ("", texts[2]) and found[3] == ("", texts[3])
    for value in ["", "hunter", "p4ssw0rd1999", "qwertyuiop", "qwqwqwqwqwzz", "abcabcabc!", "2001-02-03abc", long[:9], late[290:310]]:
        cost = secrets.guess_cost(value)
        for limit in (3.0, 6.0, 10.0, 30.0):
            assert secrets.guess_cost(value, limit) == (cost if cost < limit or not value else float("inf"))


def test_secrets_past_a_base_span(spark):
    texts = ["password=abcdefGHIJKL!Q9#zR7$mmX2 x", "api-key: 0123456789abcdef#Kq!Zr?Wv x", "password=abcdefGHIJKL x", "token=zzzzzzzzzzzzzz! x"]
    found = found_secrets(spark, texts)
    assert found[0] == ("assign:0:21,value:9:33", "[SECRET] x")
    assert found[1] == ("hex:9:25,value:9:34", "api-key: [SECRET] x")
    assert found[2] == ("assign:0:21", "[SECRET] x") and found[3] == ("assign:0:20", "[SECRET]! x")


def test_secrets_behind_longer_names(spark):
    key, odd = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "Xk9#vQ2!mL7$"
    names = ["AWS_SECRET_ACCESS_KEY=", "export MY.API-KEY_2 = ", "dbPassword: ", "PGPASSWORD=", "token_value is ", "x-authorization: "]
    names += ['"smtp_pass": "', "auth=", "my-auth is ", "passwordless.pwd_old:", "tokens." * 20_000 + "x="]
    plain = ["author: Christopher", "secretary: Montgomery", "tokenizer = SentencePieceUnigram", "the compass: Northwestern"]
    plain += ["authorization is unnecessarily late", "passage: Thermopylae", "token" * 20_000, "DB_PASSWORD=letmein1"]
    found = found_secrets(spark, [n + v for n in names for v in (key, odd)] + plain + [f"DB_PASSWD={odd}"])
    for i, n in enumerate(names):
        for j, v in enumerate((key, odd)):
            spans, clean = found[2 * i + j]
            assert f"value:{len(n)}:{len(n + v)}" in spans or spans.startswith("assign:"), n + v
            assert v not in clean and clean.endswith("[SECRET]"), n + v
    assert [f for f in found[2 * len(names) : -1]] == [("", t) for t in plain]
    assert found[-1] == ("value:10:22", "DB_PASSWD=[SECRET]")


def test_repeated_strings(docs, nothing, spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5_000)
    bodies = [(t or "").encode() for _, t in TEXTS]
    expected = repeated(bodies)
    found = suffixes.remove_repeats(docs)
    rows = sorted((str(r.doc_id), r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect())
    assert rows == sorted((str(d), e[1], e[2], e[3]) for (d, _), e in zip(TEXTS, expected))
    assert suffixes.repeats(nothing).count() == 0


def test_strings_repeated_at_all_distances(spark):
    rnd = random.Random(3)
    blocks = ["".join(rnd.choices("abcd", k=rnd.randrange(150, 420))) for _ in range(12)]
    texts = ["".join(rnd.choices("abcd", k=rnd.randrange(300))) + "".join(rnd.choices(blocks, k=3)) for _ in range(60)]
    texts += ["ab" * 700, "c" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df).collect()}
    assert rows == {i: e[1:] for i, e in enumerate(repeated([t.encode() for t in texts]))}


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "MEMBERS", 8)
    monkeypatch.setattr(embeddings, "VISITORS", 8)
    rnd = np.random.default_rng(2)
    centers = rnd.normal(size=(12, 16))
    rows = []
    for i in range(300):
        v = centers[i % 12] + rnd.normal(scale=0.08, size=16)
        rows.append((i, [float(x) for x in v], int(i % 12 % 2)))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(40)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, rows[0][1], None), (404, [1.0, None], 1)]
    rows += [(405, [], 1), (406, [1.0, 2.0], 1), (407, [2.0, 4.0], 1), (408, [float("inf"), 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    found = {r.vec_id: r for r in embeddings.near_vectors(df).collect()}
    links = {i: set() for i, _, _ in rows}
    for i, v, a in rows[:340] + rows[-3:-1]:
        for j, w, b in rows[:340] + rows[-3:-1]:
            if i != j and a == b and len(v) == len(w) and np.dot(v, w) >= 0.93 * np.linalg.norm(v) * np.linalg.norm(w):
                links[i].add(j)
    assert sum(r.n_links for r in found.values()) >= 0.99 * sum(map(len, links.values()))
    assert all(found[i].n_links <= len(links[i]) for i in links)
    assert found[407].component_id == 406 and all(found[i].kept and not found[i].n_links for i in (400, 401, 402, 403, 404, 405, 408))
    assert found[339].component_id == found[0].component_id == 0
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(70)] + [(i, i + 1) for i in range(100, 160)] + [(None, 3)]
    head = {x: x for pair in links for x in pair if x is not None}
    for _ in head:
        for a, b in links:
            if a is not None:
                head[a] = head[b] = min(head[a], head[b])
    found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: h for x, h in head.items() if any(x in p and p[0] != p[1] for p in links if None not in p)}


def test_vectors_with_links_in_many_cells(spark):
    rnd = np.random.default_rng(4)
    units = rnd.normal(size=(5_400, 8))
    units /= np.sqrt((units * units).sum(axis=1))[:, None]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(units)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(8)
    links = (units @ units.T >= -0.3).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in embeddings.near_vectors(df, least=-0.3).collect()}
    assert sum(found.values()) >= 0.998 * links.sum() and all(found[i] <= n for i, n in enumerate(links))
    with pytest.raises(RuntimeError, match="all 81 cells"):
        embeddings.near_vectors(df, least=-0.3, recall=1.1).collect()


GNU = (
    "This {what} is free software; you can redistribute it and/or\nmodify it under the terms of the GNU {kind} General Public\n"
    "License as published by the Free Software Foundation; either\nversion {version} of the License, or (at your option) any later version.\n"
)
BSD = (
    "Copyright (c) 1998, The Regents of the University.\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions\nare met:\n\n1. Redistributions of source code must retain the above copyright\n"
    "   notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright\n"
    "   notice, this list of conditions and the following disclaimer in the\n   documentation and/or other materials provided with the distribution.\n{last}"
)
LICENSE_CASES = [
    (GNU.format(what="library", kind="Library", version="2"), "LGPL-2.0-or-later"),
    (GNU.format(what="library", kind="Lesser", version="2.1"), "LGPL-2.1-or-later"),
    ("# " + GNU.format(what="library", kind="Lesser", version="2.1").replace("\n", "\n# "), "LGPL-2.1-or-later"),
    (GNU.format(what="program", kind="", version="2").replace("GNU  ", "GNU "), "GPL-2.0-or-later"),
    (GNU.format(what="program", kind="", version="4").replace("GNU  ", "GNU "), ""),
    (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "AGPL-3.0-or-later",
    ),
    ("prose. either version 2 of the License, or (at your option) any later version. prose", ""),
    (
        BSD.format(last="3. Neither the name of the University of Upper Somewhere nor the names of its\n   contributors may be used to endorse or "
        "promote products derived from this\n   software without specific prior written permission.\n"),
        "BSD-3-Clause",
    ),
    ("Copyright 2020 Jane. All rights reserved.", "Proprietary"),
    ("Copyright 2020 Jane.\nAll rights reserved.\n\nReleased under the MIT License.", "MIT"),
    ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"),
    ("/* SPDX-License-Identifier: (GPL-2.0-or-later OR MIT) */\nint x;", "GPL-2.0-or-later,MIT"),
    ("# SPDX-License-Identifier: Apache-2.0 AND BSD-3-Clause\n", "Apache-2.0,BSD-3-Clause"),
    ("# SPDX-License-Identifier: LicenseRef-Own\n", ""),
    ("This small tool is dual licensed under the MIT License or Apache-2.0.", "Apache-2.0,MIT"),
    ("Dual licensed under the Apache License, Version 2.0\nor the MIT license", "Apache-2.0,MIT"),
    ("dual licensed under the MIT License or something else", ""),
]


def license_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_license_notices(spark):
    found = {r.doc_id: ",".join(r.licenses) for r in licenses.licenses(license_frame(spark, [t for t, _ in LICENSE_CASES])).collect()}
    assert found == {i: name for i, (_, name) in enumerate(LICENSE_CASES)}


@pytest.mark.parametrize("marks", ["1. 2. 3.", "(1) (2) (3)", "a) b) c)", "* * *", "- - -"])
def test_numbered_conditions(spark, marks):
    one, two, three = marks.split()
    last = (
        "3. Neither the name of the University of Upper Somewhere nor the names of its\n   contributors may be used to endorse or promote "
        "products derived from this\n   software without specific prior written permission.\n"
    )
    texts = [BSD.format(last=last), BSD.format(last=""), BSD.format(last=last.replace("the University of Upper Somewhere", "Jane"))]
    for old, new in (("1.", one), ("2.", two), ("3.", three)):
        texts = [t.replace(f"\n{old} ", f"\n{new} ") for t in texts]
    found = {r.doc_id: ",".join(r.licenses) for r in licenses.licenses(license_frame(spark, texts)).collect()}
    assert found == {0: "BSD-3-Clause", 1: "BSD-2-Clause", 2: "BSD-3-Clause"}


def test_license_sql_on_wrapped_texts(spark):
    """The registered SQL says the same on notices over several lines."""
    import duckdb

    texts = [t for t, _ in LICENSE_CASES]
    for width in (30, 60, 80):
        for names in (("mit_grant", "mit_notice", "mit_warranty"), ("gpl2_free", "gpl_hope", "gpl_see"), ("apache_ref_you", "apache_comply")):
            texts.append("\n\n".join(textwrap.fill(f"{licenses.SENTENCES[n].rstrip(':.')}.", width) for n in names))
    texts += ["Released under the MIT License.\n" + "A sentence. " * n + "Licensed under CC BY 4.0." for n in range(2, 6)]
    texts += [None, "", "Released under the MIT\nLicense\nReleased under the MIT License", TEXTS[0][1]]
    documents = license_frame(spark, texts).toPandas()  # noqa: F841 (DuckDB reads it by name)
    expected = duckdb.sql(licenses.oracle_sql()).fetchall()
    found = licenses.licenses(license_frame(spark, texts)).collect()
    assert sorted((r.doc_id, r.sequence, ",".join(r.licenses), r.n_matches) for r in found) == sorted(expected)


def test_contamination_without_broadcast(spark, docs, items):
    """The shuffled form gives the same rows, also for long texts, equal rows and items of few words."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(4_000)]
    long = [" ".join(rng.choice(vocabulary, 20_000)) for _ in range(3)]
    more = [" ".join(t.split()[i : i + 25]) for t in long for i in (0, 9_000, 19_975)]
    texts = [(20 + i, t) for i, t in enumerate([*long, long[0], "x " + more[0] + " y", *more])]
    mine = docs.select("doc_id", "text").unionByName(spark.createDataFrame([*texts, texts[0]], "doc_id long, text string"))
    all_items = items.unionByName(spark.createDataFrame([(10 + i, t) for i, t in enumerate(more)], "item_id long, text string"))

    def found(limit):
        rows = decontaminate.contamination(mine, all_items, broadcast_limit=limit).collect()
        return sorted(((str(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids)) for r in rows))

    whole = found(1_000_000)
    assert found(0) == whole and len(whole) == mine.count()
    assert [r[2] for r in whole if r[0] == "20"] == [75, 75]


def test_shuffled_shingles_carry_no_words(spark):
    """Below the join with the item shingles a row has a key, a place and a shingle."""
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    keys = [F.xxhash64("doc_id").alias("k1"), F.xxhash64("text").alias("k2")]
    worded = decontaminate.with_words(docs.select("doc_id", *keys, F.col("text").alias("_text")), "_text")
    wanted = spark.createDataFrame([(1,)], "shingle long").hint("merge")
    plan = decontaminate._hits_by_shuffle(worded, wanted, [5], 10)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    joins = [i for i, line in enumerate(lines) if "Join Inner, (shingle" in line]
    below = lines[joins[0] + 1]
    assert "Project" in below and "words" not in below.split("Project", 1)[1]


def tile_of(texts, visitors):
    import pyarrow as pa

    blobs, nodes = [], []
    for text in texts:
        words, first = textwords.hashed_words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        hashes, places = textwords.shingles(words, first, 5)
        blobs.append(minhash._packed(minhash.weighted_units(hashes, places)))
        nodes.append(minhash._sequence_keys(words, first)[0].tobytes())
    table = pa.table({"node": pa.array(nodes, pa.binary()), "visitor": visitors, "units": pa.array(blobs, pa.binary())})
    return nodes, minhash._linked_tile(table, 80)


def test_tiles_of_long_texts_are_counted_in_blocks(monkeypatch):
    import tracemalloc

    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 10**9, 30_000)]
    texts = []
    for i in range(24):
        words = list(base) if i % 2 else [f"v{j}" for j in rng.integers(0, 10**9, 30_000)]
        for at in rng.integers(0, 30_000, 300):
            words[at] = f"x{i}-{at}"
        texts.append(" ".join(words))
    visitors = [i % 4 == 1 for i in range(24)]
    tracemalloc.start()
    nodes, found = tile_of(texts, visitors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    near = {nodes[i] for i in range(1, 24, 2)}
    assert set(found.column("a").to_pylist()) | set(found.column("b").to_pylist()) == near
    assert found.num_rows == len(near) - 1
    assert peak < 400e6  # a matrix of all their shared units would be much larger with hundreds of texts
    monkeypatch.setattr(minhash, "COLUMNS", 1_000)
    assert tile_of(texts, visitors)[1].num_rows == found.num_rows


@pytest.mark.parametrize("pairs_each", [0, 1, 64])
def test_wide_buckets_are_tiled(spark, monkeypatch, pairs_each):
    """With tiles of four, and buckets tiled that have more pairs than that; groups are as by brute force."""
    monkeypatch.setattr(minhash, "PAIRS_EACH", pairs_each)
    monkeypatch.setattr(minhash, "TILE", 4)
    monkeypatch.setattr(minhash, "TILE_UNITS", 300)
    rng = random.Random(2)
    base = [[f"t{k}w{i}" for i in range(60)] for k in range(3)]
    texts = {}
    for d in range(60):
        words = list(base[d % 3])
        for _ in range(d % 7):
            words[rng.randrange(60)] = f"z{rng.randrange(50)}"
        texts[d] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert found == near_components(texts)
