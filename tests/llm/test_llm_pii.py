"""What labelers, estimation and classifier make of labelled candidates."""

import random

import pytest
from pyspark.sql import functions as F

from tallyward.llm import pii

FIRST = "Maria Tobias Ingrid Wendell Oksana Farid".split()
LAST = "Keller Okafor Lindgren Marsh Duarte Novak".split()
PLACES = "Great Wall,Upper Street,Second Chapter,Blue River,Old Harbour,Long Winter".split(",")


def labelled_texts(seed):
    """(text, kind, real) with one candidate each."""
    rnd = random.Random(seed)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    filler = lambda: " ".join(rnd.choice(["so", "then", "it", "was", "here", "again"]) for _ in range(rnd.randrange(3, 9)))

    def bad_card():
        while True:
            number = "4" + digits(15)
            if sum((n * 2 - 9 if n * 2 > 9 else n * 2) if i % 2 else n for i, n in enumerate(map(int, reversed(number)))) % 10:
                return number

    rows = []
    for _ in range(40):
        first, last = rnd.choice(FIRST), rnd.choice(LAST)
        rows += [
            (f"contact {last.lower()}@mail.example.com soon", None, True),
            (f"you may call +1 555 {digits(3)} {digits(4)} today", None, True),
            (f"the host 10.{rnd.randrange(256)}.{rnd.randrange(256)}.7 is up", None, True),
            (f"write to {first.lower()} (at) example (dot) org please", "email", True),
            (f"my phone is 555-{rnd.randrange(200, 999)}-{digits(4)} now", "phone", True),
            (f"serial 555-{rnd.randrange(200, 999)}-{digits(4)} in part no list", "phone", False),
            (f"order number {bad_card()} was sent", "card", False),
            (f"yes Dr. {first} {last} came", "name", True),
            (f"dear {first} {last} we thank you", "name", True),
            (f"{filler()} {rnd.choice(PLACES)} {filler()}", "name", False),
            (f"{filler()} {rnd.choice(PLACES)} {filler()}", "name", False),
            (f"ssn {rnd.randrange(100, 600)}-{rnd.randrange(10, 99)}-{rnd.randrange(1000, 9999)} on file", "id", True),
            (f"figure 000-{rnd.randrange(10, 99)}-{rnd.randrange(1000, 9999)} of page two", "id", False),
        ]
    return rows


@pytest.fixture(scope="module")
def found(spark):
    rows = labelled_texts(3)
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "doc_id long, text string").repartition(4)
    spans = {r.doc_id: len(r.spans) - len(r.base) for r in pii.personal_spans(df).collect()}
    return df, rows, spans


def test_the_classifier_decides_on_looser_spans(found):
    _, rows, spans = found
    judged = [(kind, real, spans[i] > 0) for i, (_, kind, real) in enumerate(rows) if kind]
    for kind in ("email", "phone", "card", "name", "id"):
        right = [real == taken for k, real, taken in judged if k == kind]
        assert sum(right) >= 0.9 * len(right), kind
    assert all(spans[i] == 0 for i, (_, kind, _) in enumerate(rows) if kind is None)


def test_estimation_departs_from_the_majority(found):
    """Labelers get reliabilities of their own, and the answers are better than those of the majority of votes."""
    df, rows, spans = found
    votes = [f"v{i}" for i in range(pii.VOTES)]
    proposed = pii._proposed(df, "doc_id", "text").select("doc_id", F.explode(F.concat("base", "loose")).alias("s"))
    patterns = proposed.select("doc_id", "s.*").cache()
    counted = patterns.groupBy("kind", "length", *votes).agg(F.count("*").alias("n"))
    first = pii._sum_all(counted, pii.majority(), votes)
    _, last = pii.estimated(counted, 8)
    rates = [{v: c[v, 1][0] / max(sum(c[v, x][0] for x in (-1, 0, 1)), 1e-9) for v in votes} for c in (first, last)]
    assert len({round(x, 2) for x in rates[1].values()}) >= 3
    assert max(abs(rates[0][v] - rates[1][v]) for v in votes) > 0.02
    by_majority = {r.doc_id: r.p for r in patterns.filter("not base").select("doc_id", pii.majority().alias("p")).collect()}
    judged = [(real, spans[i] > 0, by_majority.get(i, 0) >= 0.9) for i, (_, kind, real) in enumerate(rows) if kind]
    assert sum(real == ours for real, ours, _ in judged) > sum(real == theirs for real, _, theirs in judged)


def test_given_names_come_from_the_corpus(spark):
    texts = ["Mr. Zebulon Carter spoke", "Mrs Zebulon Pike sang", "Dr. Quentin Moss left", "Prof. Quentin Moss", "Herr Solo Once", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    names = pii.given_names(df)
    assert {"Zebulon", "Quentin", *pii.GIVEN_NAMES} == set(names)
