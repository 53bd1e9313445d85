"""Personal data by weak supervision; DataFrame functions only.

Patterns propose candidate spans: the exact base forms, which always stay, and looser ones (written-out addresses,
numbers without a plus sign, card numbers with a wrong check digit, national numbers, two capitalised words). Labelers (check,
gazetteer, two of context, neighbours) vote yes, no or nothing on every candidate; none of them knows whether it is a
base form. Expectation-maximisation over the counts of vote patterns estimates how often each labeler votes how on real and
false spans; then a naive Bayes classifier of votes, kind and length is trained on the resulting probabilities and decides on
the looser candidates. The gazetteer of given names is the corpus's own: the words that stand between a title and a
capitalised word in several documents, beside a short fixed list.

Vote patterns are counted before anything else, so a round of estimation reads a table of a size that does not depend on
the corpus (3 votes to the power of 5 labelers, by kind and length class), and its sums are numbers in the next round's expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import stored
from tallyward.llm.spans import joined, labelled, with_located

KINDS = ("email", "ip", "card", "phone", "id", "name")

# Base patterns, possessive where nothing after them could give back, so that long runs need no backtracking. An address
# starts where its run of letters does, or where the match before ended inside the run.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Looser patterns.
_AT, _DOT = r"\x20?[(\[](?:at|AT)[)\]]\x20?", r"\x20?(?:[(\[](?:dot|DOT)[)\]]|\.)\x20?"
WRITTEN_EMAIL = rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}"
LOCAL_PHONE = r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
NATIONAL_ID = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
# Some frequent given names, top-level domains.
GIVEN_NAMES = (
    "Alice Anna Anne Carlos Charles Christine David Elena Elizabeth Emily Emma Francisco Hans James Jean John José "
    "Karl Klaus Laura Louis Maria Marie Mary Michael Paul Peter Pierre Robert Sarah Sophie Stefan Susan Thomas William"
).split()
TOP_DOMAINS = "com org net edu gov io de fr es eu uk info".split()
_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?)"
_CAPITAL = r"\p{Lu}\p{Ll}{1,30}"
NAME = rf"(?<![\p{{L}}])(?:{_TITLE}\.?\x20)?(?!{_TITLE}\x20){_CAPITAL}\x20{_CAPITAL}(?![\p{{L}}])"
TITLED = rf"(?<![\p{{L}}]){_TITLE}\.?\x20({_CAPITAL})\x20{_CAPITAL}(?![\p{{L}}])"
#: Given names of the corpus: in how many documents a word must stand behind a title, and how many are used, at most.
NAMED_IN, NAMES = 2, 10_000

# Words near a span that speak for or against its kind.
FOR = {
    "email": r"e-?mail|contact|write to|mailto|correo|courriel",
    "ip": r"\bip\b|address|host|server",
    "card": r"card|visa|mastercard|credit|karte|carte|tarjeta",
    "phone": r"phone|tel\b|tel\.|call|mobile|fax|telefon|téléphone|teléfono",
    "id": r"ssn|social security|national|passport|identity",
    "name": r"name|author|contact|dear|signed|herr|frau|madame|señor",
}
AGAINST = r"version|isbn|issn|doi|order|invoice|serial|part no|figure|table|page|chapter"
VOTES = 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """The check sum of card numbers, on a string of digits."""

    def worth(d: Column, i: Column) -> Column:
        n = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    each = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _ip_ok(value: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.char_length(short) <= 3) & (F.left(short, F.lit(3)).cast("int") <= 255)

    return F.forall(F.split(value, r"\."), small)


def _card_length(value: Column) -> Column:
    return F.char_length(_digits(value)).between(13, 19)


def _vote(yes: Column, no: Column | None = None) -> Column:
    against = F.lit(False) if no is None else F.coalesce(no, F.lit(False))
    return F.when(F.coalesce(yes, F.lit(False)), 1).when(against, -1).otherwise(0)


def given_names(docs: DataFrame, text: str = "text") -> list[str]:
    """The words that stand between a title and a capitalised word in ``NAMED_IN`` documents or more, most frequent first; at most
    ``NAMES``, and the fixed ones."""
    titled = docs.filter(F.col(text).rlike(rf"{_TITLE}\.?\x20")).select(
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(TITLED), F.lit(1)))).alias("word")
    )
    counted = titled.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= NAMED_IN)
    found = [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(NAMES).collect()]
    return sorted({*found, *GIVEN_NAMES})


def _candidates(spans: Column, kind: str, base: bool, names: list[str]) -> Column:
    """Spans with the votes of the labelers and a length class."""

    def one(s: Column) -> Column:
        value = s["value"]
        digits = _digits(value)
        n = F.char_length(digits)
        alone = F.left(s["after"], F.lit(1)).rlike(r"[\p{L}\p{Nd}]")
        glued = F.right(s["before"], F.lit(1)).rlike(r"[\p{L}\p{Nd}]")
        if kind == "email":
            check = _vote(~value.contains(".."), value.contains(".."))
            known = _vote(F.lower(F.regexp_extract(value, r"([A-Za-z]+)\W*$", 1)).isin(TOP_DOMAINS))
        elif kind == "ip":
            check = _vote(~value.rlike(r"(^|\.)0[0-9]"), value.rlike("^0+\\."))
            known = _vote(value.rlike(r"^(10|127|192\.168)\."))
        elif kind == "card":
            check = _vote(passes_luhn(digits), ~passes_luhn(digits))
            known = _vote(digits.rlike("^(4|5[1-5]|3[47]|6)"), digits.rlike("^0"))
        elif kind == "phone":
            check = _vote(n.between(9, 15), ~n.between(7, 15))
            known = _vote(digits.rlike("^(1|33|34|44|49)"))
        elif kind == "id":
            check = _vote(~value.rlike("^(000|666|9)|-00-|-0000$"), value.rlike("^(000|666|9)|-00-|-0000$"))
            known = _vote(F.lit(False))
        else:
            check = _vote(value.rlike(rf"^{_TITLE}\.?\x20"))
            given = F.regexp_extract(value, rf"({_CAPITAL})\x20{_CAPITAL}$", 1)
            known = _vote(F.array_contains(F.lit(names), given))
        near = F.lower(F.concat(s["before"], F.lit(" "), s["after"]))
        votes = (
            check,
            known,
            _vote(near.rlike(FOR[kind])),
            _vote(F.lit(False), F.lower(s["before"]).rlike(AGAINST)),
            _vote(~(alone | glued), alone | glued),
        )
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("label"),
            F.lit(base).alias("base"),
            F.least(F.floor(F.char_length(value) / 8), F.lit(4)).cast("int").alias("length"),
            *[v.alias(f"v{i}") for i, v in enumerate(votes)],
        )

    return F.transform(spans, one)


def _proposed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    names = given_names(docs, text)
    df = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.withColumn("_digit", F.col("_text").rlike("[0-9]"))
    forms = {
        "email": (EMAIL, F.col("_text").contains("@")),
        "ip": (IP, F.col("_digit")),
        "card": (CARD, F.col("_digit")),
        "phone": (PHONE, F.col("_text").contains("+")),
        "email2": (WRITTEN_EMAIL, F.col("_text").rlike(r"[(\[](?:at|AT)[)\]]")),
        "phone2": (LOCAL_PHONE, F.col("_digit")),
        "id": (NATIONAL_ID, F.col("_digit")),
        "name": (NAME, F.col("_text").rlike(rf"{_CAPITAL}\x20{_CAPITAL}")),
    }
    for name, (pattern, if_any) in forms.items():
        df = with_located(df, "_text", pattern, f"_{name}", if_any)
    number = F.filter("_card", lambda s: _card_length(s["value"]))
    df = (
        df.withColumn("_ip", F.filter("_ip", lambda s: _ip_ok(s["value"])))
        .withColumn("_number", number)
        .withColumn("_card", F.filter("_number", lambda s: passes_luhn(_digits(s["value"]))))
        .withColumn("_card2", F.filter("_number", lambda s: ~passes_luhn(_digits(s["value"]))))
        .withColumn("_phone", F.filter("_phone", lambda s: F.char_length(_digits(s["value"])).between(9, 15)))
    )
    base = [_candidates(F.col(f"_{k}"), k, True, names) for k in KINDS[:4]]
    loose = [
        _candidates(F.col(column), kind, False, names)
        for column, kind in (("_email2", "email"), ("_card2", "card"), ("_phone2", "phone"), ("_id", "id"), ("_name", "name"))
    ]
    df = df.select("doc_id", F.concat(*base).alias("base"), F.concat(*loose).alias("loose"))
    # A looser span gives way to a base one that it touches.
    apart = F.filter("loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return df.withColumn("loose", F.when(F.size("loose") > 0, apart).otherwise(F.col("loose")))


def _sum_all(patterns: DataFrame, weight: Column, features: list[str]) -> dict[tuple[str, int], tuple[float, float]]:
    """Weighted counts of each value of each feature among real and false spans, in one aggregation."""
    names, sums = [], []
    for f in features:
        low, high = (-1, 1) if f.startswith("v") else (0, len(KINDS) - 1)
        for value in range(low, high + 1):
            for real in (1, 0):
                share = weight if real else 1 - weight
                names.append((f, value, real))
                sums.append(F.coalesce(F.sum(F.when(F.col(f) == value, F.col("n") * share)), F.lit(0.0)))
    row = patterns.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    got = {name: float(row[i]) for i, name in enumerate(names)}
    return {(f, v): (got[f, v, 1], got[f, v, 0]) for f, v, r in names if r}


def _log_odds(counts: dict[tuple[str, int], tuple[float, float]], get) -> Column:
    """Naive Bayes log odds of a span from smoothed counts; ``get`` gives a feature's column."""
    features = list(dict.fromkeys(f for f, _ in counts))
    first = [c for (f, _), c in counts.items() if f == features[0]]
    odds = F.lit(math.log((sum(a for a, _ in first) + 1) / (sum(b for _, b in first) + 1)))
    for f in features:
        values = {v: c for (g, v), c in counts.items() if g == f}
        real, false = (sum(c[i] for c in values.values()) + len(values) for i in (0, 1))
        part = F.lit(0.0)
        for v, (a, b) in values.items():
            if f.startswith("v") and v == 0:  # a labeler that says nothing is no evidence
                continue
            part = F.when(get(f) == v, math.log((a + 1) / real) - math.log((b + 1) / false)).otherwise(part)
        odds = odds + part
    return odds


def majority() -> Column:
    """The first guess of a span's probability: the majority of the votes."""
    total = sum((F.col(f"v{i}") for i in range(VOTES)), F.lit(0))
    return F.when(total > 0, 0.9).when(total < 0, 0.1).otherwise(0.5)


def estimated(patterns: DataFrame, rounds: int) -> tuple[dict, dict]:
    """From counted vote patterns the classifier's weighted counts, and those of the labelers by expectation-maximisation."""
    votes = [f"v{i}" for i in range(VOTES)]
    weight, reliabilities = majority(), {}
    for _ in range(rounds):
        reliabilities = _sum_all(patterns, weight, votes)
        weight = 1 / (1 + F.exp(-_log_odds(reliabilities, F.col)))
    return _sum_all(patterns, weight, [*votes, "kind", "length"]), reliabilities


def personal_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = 8, least: float = 0.9
) -> DataFrame:
    """Per document: doc_id, base and spans, arrays of (kind, start, end, label) in order of kind and start.

    ``base`` has the base forms (the first four kinds), ``spans`` these and the looser candidates to which the classifier
    gives a probability of ``least`` or more.

    Defined results: a NULL or empty text has no spans; equal rows get equal results; a table without any candidate has
    none to learn from and keeps base spans only; an empty table gives no rows; other columns are ignored.
    """
    votes = [f"v{i}" for i in range(VOTES)]
    proposed = stored(_proposed(docs, doc_id, text), "proposed")
    patterns = stored(
        proposed.select(F.explode(F.concat("base", "loose")).alias("s"))
        .select("s.*")
        .groupBy("kind", "length", *votes)
        .agg(F.count("*").alias("n")),
        "patterns",
    )
    counts, _ = estimated(patterns, rounds)

    def accepted(s: Column) -> Column:
        return _log_odds(counts, lambda f: s[f]) >= math.log(least / (1 - least))

    keep = "array<struct<kind:int,start:int,end:int,label:string>>"

    def short(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"))).cast(keep)

    chosen = F.when(F.size("loose") > 0, F.filter("loose", accepted)).otherwise(F.col("loose"))
    return proposed.select(
        "doc_id",
        F.array_sort(short(F.col("base"))).alias("base"),
        F.array_sort(short(F.concat(F.col("base"), chosen))).alias("spans"),
    )


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``personal_spans``."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
