"""Secrets in texts: fixed forms, and values in a credential context that would take many guesses.

The fixed forms (base) are found with Spark's own functions. Values behind a credential word that such forms do not cover entirely
go, as a narrow table, to a guess-cost search in Python: the cheapest way to write the value as a row of dictionary words,
dates, repeats, keyboard walks, sequences and brute-force characters. A value is a secret if even the cheapest way
takes ``least`` guesses (a power of ten) or more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import small_batches
from tallyward.llm.spans import joined, labelled, with_located

KINDS = ("assign", "access", "hex", "value")

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# Runs are maximal, so a lower bound on their length drops just the short ones.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Credential words, anywhere in a name; not within plain words such as author, secretary, tokenizer, compass.
CREDENTIAL = (
    r"password|passwd|passphrase|passcode|passkey|(?<!com|by|tres|over|under|sur)pass(?![a-z])|pwd|"
    r"secret(?!ar[iy]|ion|iv|ed|ly)|token(?!i[sz](?:e|i|at))|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer"
)
AUTH = r"auth(?!or(?!i[sz])|entic(?!at))"
#: A name with a credential word, a sign of assignment and what follows up to white space or a quote. Names are taken whole
#: and looked into only before a sign, so that long ones cost no more; in prose ("is") auth is a word or part by itself.
CONTEXT = (
    r"(?<![A-Za-z0-9_.-])(?=[A-Za-z0-9_.-]++[\"']?(?:\x20{0,3}[:=]|\x20is\x20))(?:"
    rf"(?=[A-Za-z0-9_.-]*?(?i:{CREDENTIAL}|{AUTH}))[A-Za-z0-9_.-]++[\"']?\x20{{0,3}}[:=]\x20{{0,3}}|"
    rf"(?=[A-Za-z0-9_.-]*?(?i:{CREDENTIAL}|(?<![a-z])auth(?![a-z])))[A-Za-z0-9_.-]++[\"']?\x20is\x20)"
    r"[\"']?([^\s\"'`<>(){}\[\],;]{6,})"
)

# Frequent words and passwords, most frequent first, and the rows of a keyboard.
WORDS = (
    "password admin secret token welcome letmein login user test example changeme default master dragon monkey sunshine "
    "football baseball shadow hello love money summer winter spring autumn flower orange purple yellow green black white "
    "your this that with from have been none null true false none value string here name data file home info system "
    "server client public private access account email please config production staging development local root guest"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_RANK = {word: i + 1 for i, word in reversed(list(enumerate(WORDS)))}
_PLAIN = str.maketrans("@401!3$57", "aaoliesst")
_ALONG = {a + b for row in ROWS for a, b in zip(row, row[1:])}
_BESIDE = _ALONG | {pair[::-1] for pair in _ALONG}
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:19|20)\d\d")


def _char_cost(c: str) -> float:
    """log10 of the characters that a guesser would try in this place."""
    if c.isdigit():
        return 1.0
    if c.islower() and c.isascii():
        return math.log10(26)
    return math.log10(26 if c.isupper() and c.isascii() else 33)


def guess_cost(value: str, limit: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes; 0 for an empty one. From ``limit`` on, infinite.

    No span lowers the cost of what is before it, so prefixes that cost ``limit`` or more are not carried on.

    Spans cost: a word its rank (twice with capitals or look-alike characters), a date 365 times the years near, a repeat its
    unit times the count, a walk on the keyboard or through the alphabet its start, length and turns, anything else
    its characters. Each further span doubles the guesses.
    """
    n = len(value)
    lower = value.lower() if value.isascii() else "".join(c.lower()[0] for c in value)  # as long as the value
    plain = lower.translate(_PLAIN)
    best = [0.0] + [math.inf] * n
    furthest = 0
    for start in range(n):
        if start > furthest:
            break
        here = best[start] + (math.log10(2) if start else 0.0)
        if here >= limit:
            continue

        def reach(end: int, cost: float) -> None:
            nonlocal furthest
            if here + cost < min(best[end], limit):
                best[end] = here + cost
                furthest = max(furthest, end)

        reach(start + 1, _char_cost(value[start]))
        for size in range(3, min(12, n - start) + 1):
            word = lower[start : start + size]
            rank = _RANK.get(word) or _RANK.get(plain[start : start + size])
            if rank:
                changed = value[start : start + size] not in _RANK
                reach(start + size, math.log10(rank + 1) + (math.log10(2) if changed else 0.0))
        date = _DATE.match(value, start)
        if date:
            reach(date.end(), math.log10(100 * (365 if len(date.group()) > 4 else 1)))
        end, turns = _run(lower, start, (limit - here) / math.log10(4))
        for stop in range(start + 3, end + 1):
            reach(stop, math.log10(47 * (stop - start)) + turns * math.log10(4))
        for unit in range(1, min(8, (n - start) // 2) + 1):
            stop = start + unit
            while lower.startswith(lower[start : start + unit], stop):
                stop += unit
            if stop > start + max(unit, 2):
                reach(stop, sum(map(_char_cost, value[start : start + unit])) + math.log10((stop - start) // unit))
    return best[n]


def _run(lower: str, start: int, most: float) -> tuple[int, int]:
    """How far a walk over neighbouring keys or letters goes from ``start``, and its changes of kind; nowhere if above ``most``."""
    end, turns, before = start + 1, 0, ""
    while way := _way(lower[end - 1 : end + 1]):
        turns += bool(before) and way != before
        if turns > most:
            return start + 1, 0
        end, before = end + 1, way
    return end, turns


def _way(pair: str) -> str:
    """Along a row of keys, through the alphabet or the digits, either way; empty if neither."""
    if len(pair) < 2:
        return ""
    if pair in _BESIDE:
        return "keys" if pair in _ALONG else "keys back"
    step = ord(pair[1]) - ord(pair[0])
    return f"letters {step}" if abs(step) == 1 and pair.isascii() and pair.isalnum() else ""


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 10.0) -> DataFrame:
    """Per document: doc_id, base and spans, arrays of (kind, start, end, label).

    ``base`` has the fixed forms, by kind and start: assignments to a credential word with a value of 12 or more characters,
    access keys and long hexadecimal runs. ``spans`` adds values behind a credential word that take 10 ** ``least``
    guesses or more and that base spans do not cover entirely; they may overlap base spans. Values are taken and scored whole, whatever their length.

    Defined results: a NULL or empty text has no spans; equal rows get equal results; an empty table gives no rows; other
    columns are ignored.
    """
    return _spans(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")), ["doc_id"], least)


def redacted(docs: DataFrame, mark: str = "[SECRET]", text: str = "text", least: float = 10.0) -> DataFrame:
    """``docs`` with the union of its secret spans replaced by ``mark`` in the text; other texts and columns as they are.

    A column ``n_chars``, if there is one, is counted anew where the text has changed. NULL texts stay NULL.
    """
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    df = _spans(docs.select(whole, F.coalesce(F.col(text), F.lit("")).alias("_text")), ["_row", "_text"], least)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(got, s):
        fresh = s["start"] >= got["at"]  # else it overlaps the span before
        piece = F.concat(got["out"], F.substring("_text", got["at"] + 1, F.greatest(s["start"] - got["at"], F.lit(0))), F.lit(mark))
        return F.struct(F.greatest(got["at"], s["end"]).alias("at"), F.when(fresh, piece).otherwise(got["out"]).alias("out"))

    def finish(got):
        return F.concat(got["out"], F.substring("_text", got["at"] + 1, F.char_length("_text")))

    hit = F.size("spans") > 0
    df = df.withColumn("_new", F.when(hit, F.aggregate("spans", start, step, finish)))
    columns = []
    for c in docs.columns:
        old = F.col("_row").getField(c)
        if c == text:
            old = F.when(hit, F.col("_new")).otherwise(old)
        elif c == "n_chars":
            old = F.when(hit, F.char_length("_new").cast(docs.schema[c].dataType)).otherwise(old)
        columns.append(old.alias(c))
    return df.select(*columns)


def _spans(df: DataFrame, keep: list[str], least: float) -> DataFrame:
    """The columns ``keep`` with base and spans of ``_text``."""
    sign = F.col("_text").contains(":") | F.col("_text").contains("=")
    df = with_located(df, "_text", ASSIGN, "_assign", sign)
    df = with_located(df, "_text", ACCESS, "_access", F.col("_text").contains("AKIA"))
    df = with_located(df, "_text", HEX, "_hex", F.col("_text").rlike(HEX))
    df = with_located(df, "_text", CONTEXT, "_context", sign | F.col("_text").contains(" is "))
    long_enough = F.filter("_assign", lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 12)
    base = F.concat(
        labelled(long_enough, "assign", 0), labelled(F.col("_access"), "access", 1), labelled(F.col("_hex"), "hex", 2)
    )
    value = "array<struct<start:int,end:int,value:string>>"

    def held(s):
        found = F.regexp_extract(s["value"], CONTEXT, 1)
        return F.struct((s["end"] - F.char_length(found)).alias("start"), s["end"].alias("end"), found.alias("value"))

    df = df.withColumn("base", F.array_sort(base, _by_start)).withColumn("_values", F.transform("_context", held).cast(value))

    def uncovered(s):
        def cover(at, b):
            return F.when(b["start"] <= at, F.greatest(at, b["end"])).otherwise(at)

        return F.aggregate("base", s["start"], cover) < s["end"]

    apart = F.filter("_values", uncovered)
    df = df.select(*keep, "base", F.when(F.size("_values") > 0, apart).otherwise(F.col("_values")).alias("values"))
    df = df.withColumn("values", F.filter("values", lambda s: F.char_length(s["value"]) >= 6))
    costly = _costly(df, least)
    return costly.select(
        *keep,
        "base",
        F.array_sort(F.concat("base", labelled(F.col("values"), "value", 3)), _by_start).alias("spans"),
    )


def _by_start(a, b):
    """Order by start, then kind."""
    left, right = (F.struct(x["start"], x["kind"]) for x in (a, b))
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def _costly(df: DataFrame, least: float) -> DataFrame:
    """Keeps of ``values`` those that take enough guesses."""
    small_batches(df.sparkSession)

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("values")
            values = batch.column(at)
            kept = [
                None if row is None else [v for v in row if guess_cost(v["value"], least) >= least] for row in values.to_pylist()
            ]
            yield batch.set_column(at, batch.schema.field(at), pa.array(kept, values.type))

    return df.mapInArrow(cost, df.schema)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``secret_spans``."""

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in range(3)],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
