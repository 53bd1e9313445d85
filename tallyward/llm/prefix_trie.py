"""The trie of conversations' beginnings, with shared beginnings found by a count-min sketch.

1. Turns become digests with a place in their conversation. Places and running digests are taken in two levels (blocks of
   turns, then the blocks), so that a conversation of any length is many groups.
2. A count-min sketch counts the digests of all beginnings: two rows of cells, one per half of a digest, each cell 0, 1 or
   "2 and more". An estimate is never too low, so an estimate of one proves that a single conversation begins so.
3. Tails below a proven singleton are nodes of one conversation and are emitted where they are. Only beginnings that may
   be shared (and the first proven node of a conversation, to learn its parent) are shuffled and grouped exactly.

A node belongs to its smallest conversation (its owner). The nodes that a conversation owns are the end of its path, so
sums over a subtree are sums over the members of what each has from there on: no walk over the tree is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import stored

#: Turns of a conversation that are numbered together, and conversations whose ids are joined together.
BLOCK, IDS = 1024, 4096
#: The blocks of borrowed turns and of turns without a number; they come before all others.
BORROWED, NO_TURN = -(1 << 61), -(1 << 60)
#: Cells of a sketch row that travel together; the least and the most cells of a row.
PART, LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 16, 1 << 26
_WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["a", "b"]


def numbered(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns as conv_id, block, rank in the block (from 1), last (of the block), two 64-bit digests of role and text, words.

    Turns are ordered by ``turn``, NULL first; turns of one number by their digests. Rows without a conversation are left out.
    """
    said, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.expr(f"`{turn}` div {BLOCK}"), F.lit(NO_TURN)).alias("block"),
        F.xxhash64(said, what).alias("a"),
        F.xxhash64(F.lit(17), said, what).alias("b"),
        F.regexp_count(what, F.lit(_WORD)).cast("long").alias("words"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "a", "b")
    rows = rows.withColumns({"rank": F.row_number().over(inside).cast("long"), "last": F.lead("a").over(inside).isNull()})
    return stored(rows.drop("turn"), "turns")


def _places(turns: DataFrame, every: int, head: Column, most: int) -> DataFrame:
    """The first turns of each block and its last one, with what their conversation borrows.

    Adds before (turns in earlier blocks), length, head (turns that are replaced) and lent (the lender's first ``head`` turns).
    """
    c, last_rank = F.col("conv_id"), F.when(F.col("last"), F.col("rank")).otherwise(0)
    few = turns.filter(F.col("last") | (F.col("rank") <= max(most, 1)))
    few = few.withColumns({"lender": c - c % every if every else c, "head": head.cast("long")}).repartition("lender")
    mine = Window.partitionBy("lender", "conv_id")
    before = F.sum(last_rank).over(mine.orderBy("block", "rank").rowsBetween(Window.unboundedPreceding, -1))
    few = few.withColumns({"before": F.coalesce(before, F.lit(0)), "length": F.sum(last_rank).over(mine)})
    place = F.col("before") + F.col("rank")
    lends = (c == F.col("lender")) & (place <= most)
    step = F.struct(place.alias("place"), "a", "b", "words")
    lent = F.sort_array(F.collect_list(F.when(lends, step)).over(Window.partitionBy("lender")))  # at most ``most``
    few = few.withColumn("lent", F.filter(lent, lambda x: x["place"] <= F.col("head")))
    return stored(few.drop("lender", "words"), "places")


def _hashes(step) -> tuple[Column, Column]:
    a, b, place = (step[x] for x in ("a", "b", "place"))
    return F.xxhash64(a, b, place), F.xxhash64(b, place, a)


def _borrowed_path(lent: Column) -> Column:
    """For 0, 1, ... of the lent steps: depth, digest, the parent's digest, words of the last step, words so far."""
    zero = F.lit(0).cast("long")

    def add(got, x):
        ha, hb = _hashes(x)
        return F.struct(
            (got["depth"] + 1).alias("depth"),
            got["a"].bitwiseXOR(ha).alias("a"),
            got["b"].bitwiseXOR(hb).alias("b"),
            got["a"].alias("pa"),
            got["b"].alias("pb"),
            x["words"].alias("words"),
            (got["upto"] + x["words"]).alias("upto"),
        )

    none = F.lit(None).cast("long")
    fields = {"depth": zero, "a": zero, "b": zero, "pa": none, "pb": none, "words": zero, "upto": zero}
    root = F.struct(*[v.alias(k) for k, v in fields.items()])
    return F.transform(F.sequence(F.lit(0), F.size(lent)), lambda i: F.aggregate(F.slice(lent, 1, i), root, add))


def prefixes(turns: DataFrame, every: int = 0, head: Column | None = None, most: int = 0) -> DataFrame:
    """A row per conversation and depth (0 for none of its turns) with the digest of the beginning and of its parent.

    With ``every``, the first ``head`` turns (at most ``most``) of each conversation c are replaced by those of c - c % ``every``: a
    lender with fewer turns lends them all, an absent one none. The digest is the exclusive or of hashes of (turn, place), so
    that blocks of a conversation can be combined.
    """
    places = _places(turns, every, F.lit(0) if head is None else head, most)
    n = F.size("lent")
    blocks = places.filter("last").select("conv_id", "block", "before", "head", n.alias("n"))
    place = F.col("before") + F.col("rank")
    own = turns.join(blocks, ["conv_id", "block"]).filter(place > F.col("head"))
    own = own.select("conv_id", "block", (place - F.col("head") + F.col("n")).alias("place"), "a", "b", "words", "last")
    ha, hb = _hashes({x: F.col(x) for x in ("a", "b", "place")})
    so_far = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    runs = own.select("conv_id", "block", "place", "words", "last", ha.alias("ha"), hb.alias("hb"))
    runs = runs.withColumns(
        {"xa": F.bit_xor("ha").over(so_far), "xb": F.bit_xor("hb").over(so_far), "sum": F.sum("words").over(so_far)}
    )
    runs = stored(runs, "runs")

    path = _borrowed_path(F.col("lent"))
    length = n + F.greatest(F.col("length") - F.col("head"), F.lit(0))
    heads = places.filter(place == 1).select("conv_id", path.alias("path"), length.cast("long").alias("length"))
    end = F.element_at("path", -1)
    heads = heads.select(
        "conv_id", F.lit(BORROWED).alias("block"), end["a"].alias("xa"), end["b"].alias("xb"), end["upto"].alias("sum"), "path", "length"
    )
    sums = heads.unionByName(runs.filter("last").select("conv_id", "block", "xa", "xb", "sum"), allowMissingColumns=True)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("conv_id")
    zero = F.lit(0).cast("long")
    sums = sums.select(
        "conv_id",
        "block",
        *[F.coalesce(f(x).over(earlier), zero).alias(f"before_{x}") for f, x in ((F.bit_xor, "xa"), (F.bit_xor, "xb"), (F.sum, "sum"))],
        F.sum("sum").over(everything).alias("total"),
        F.max("length").over(everything).alias("length"),
        "path",
    )
    sums = stored(sums, "sums")
    a, b = F.col("xa").bitwiseXOR(F.col("before_xa")), F.col("xb").bitwiseXOR(F.col("before_xb"))
    rows = runs.join(sums.drop("path"), ["conv_id", "block"]).select(
        "conv_id",
        F.col("place").alias("depth"),
        a.alias("a"),
        b.alias("b"),
        a.bitwiseXOR(F.col("ha")).alias("pa"),
        b.bitwiseXOR(F.col("hb")).alias("pb"),
        "words",
        (F.col("sum") + F.col("before_sum")).alias("upto"),
        "total",
        "length",
    )
    first = sums.filter(F.col("block") == BORROWED).select("conv_id", "total", "length", F.inline("path"))
    return stored(rows.unionByName(first), "prefixes")


def cells_for(n: int) -> int:
    """Cells of a sketch row for ``n`` beginnings: four for each, a power of two between the limits."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (4 * n).bit_length()))


def shared_cells(prefixes: DataFrame, cells: int) -> np.ndarray:
    """For both rows of the sketch, packed bits of the cells that counted two or more beginnings.

    A task counts in 2 x ``cells`` bytes and hands on the bits of the parts it touched; the driver gets 2 x ``cells`` bits.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, cells), np.uint8)
        for batch in batches:
            for row, column in zip(seen, batch.columns):
                at, n = np.unique(column.to_numpy() & (cells - 1), return_counts=True)
                row[at] = np.minimum(row[at] + np.minimum(n, 2), 2)
        for i, row in enumerate(seen):
            parts = [(p, row[p : p + PART]) for p in range(0, cells, PART) if row[p : p + PART].any()]
            if parts:
                columns = [[i] * len(parts), [p // PART for p, _ in parts]]
                columns += [[np.packbits(x >= least).tobytes() for _, x in parts] for least in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    ["row", "part", "once", "twice"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, part, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                new = np.stack([np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)])
                old = held.get((row, part))
                held[row, part] = new if old is None else np.stack([old[0] | new[0], old[1] | new[1] | (old[0] & new[0])])
        keys = list(held)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int32()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([held[k][1].tobytes() for k in keys], pa.binary()),
            ],
            ["row", "part", "twice"],
        )

    counted = prefixes.select("a", "b").mapInArrow(count, "row int, part int, once binary, twice binary")
    merged = counted.repartition("row", "part").mapInArrow(merge, "row int, part int, twice binary")
    bits = np.zeros((2, cells // 8), np.uint8)
    width = min(PART, cells) // 8
    for r in merged.collect():  # 2 x cells bits in all
        bits[r["row"], r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["twice"], np.uint8)
    return bits


def _screened(prefixes: DataFrame) -> DataFrame:
    """Adds ``one`` (the sketch proves the beginning a singleton) and ``parent_one`` (its parent)."""
    cells = cells_for(prefixes.count())
    shared = prefixes.sparkSession.sparkContext.broadcast(shared_cells(prefixes, cells))  # at most MOST_CELLS / 4 bytes
    names = prefixes.columns
    own, parent = [names.index(x) for x in _KEY], [names.index(x) for x in ("pa", "pb")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value

        def proven(batch: pa.RecordBatch, columns: list[int]) -> np.ndarray:
            out = np.zeros(batch.num_rows, bool)
            for row, i in zip(bits, columns):
                at = batch.column(i).fill_null(0).to_numpy() & (cells - 1)
                out |= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
            return out

        for batch in batches:
            rootless = ~batch.column(parent[0]).is_null().to_numpy(zero_copy_only=False)
            columns = [*batch.columns, pa.array(proven(batch, own)), pa.array(proven(batch, parent) & rootless)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "one", "parent_one"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema)
    return stored(prefixes.mapInArrow(judge, f"{kinds}, one boolean, parent_one boolean"), "screened")


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids, comma-joined, per digest; ids of a range are joined first, then read as a stream."""
    chunk = F.expr(f"conv_id div {IDS}").alias("chunk")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = ends.groupBy("a", "b", chunk).agg(ids.alias("ids"))  # fewer than 2 x IDS ids each

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(ids.encode())
            yield rows(out)
        if key is not None:
            yield rows([(*key, digest.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["a", "b", "ends_sha256"]
        )

    ordered = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "chunk").select("a", "b", "ids")
    return ordered.mapInArrow(hashed, "a long, b long, ends_sha256 string")


def trie(beginnings: DataFrame) -> DataFrame:
    """The nodes of the trie of all ``prefixes``, the textless root (depth 0) included.

    Per node: conv_id (its smallest member: a conversation that begins so), depth, parent_conv_id (its parent's conv_id; NULL at
    the root), n_convs (members), n_children, n_leaves (childless nodes of its subtree), saved_tokens (over its subtree, members
    but one times the words of the last turn), ends_sha256 (lowercase hex of the ascending ids of the members that end
    here, comma-joined). (conv_id, depth) names a node; its text is that turn of that conversation.

    Defined results: conversations without turns are members of the root and end there; no conversations give no rows.
    Beginnings are told apart by 128 bits.
    """
    rows = _screened(beginnings)
    maybe, single = rows.filter("not one"), rows.filter("one")
    first = single.filter("not parent_one")
    above = (F.col("upto") - F.col("words")).alias("above")
    nodes = stored(
        maybe.groupBy(*_KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("length").alias("longest"),
            F.max(above).alias("above"),
            F.max("pa").alias("pa"),
            F.max("pb").alias("pb"),
        ),
        "nodes",
    )
    # What each conversation owns starts at its first node of its own; the words above that are shared with smaller ones.
    start = F.struct("depth", "above", "pa", "pb").alias("start")
    owned = nodes.select("conv_id", start, (F.col("longest") == F.col("depth")).alias("leaf"))
    owned = owned.unionByName(first.withColumn("above", above).select("conv_id", start, F.lit(True).alias("leaf")))
    owned = owned.groupBy("conv_id").agg(F.min("start").alias("start"), F.max("leaf").alias("leaf"))
    owned = owned.select("conv_id", "leaf", F.col("start.depth").alias("from"), "start.above", "start.pa", "start.pb")
    # Most conversations may leave the trie at the same node; adaptive execution splits such a key of this join.
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    owned = stored(owned.join(parents, ["pa", "pb"], "left").drop("pa", "pb"), "owned")

    shuffled = rows.filter("not one or not parent_one")
    shared_words = F.when(F.col("from").isNull(), F.col("total")).when(F.col("depth") < F.col("from"), F.col("above"))
    found = (
        shuffled.join(owned, "conv_id", "left")
        .groupBy(*_KEY)
        .agg(
            F.min(F.struct("conv_id", "from", "parent")).alias("owner"),
            F.max("depth").alias("depth"),
            F.count("*").alias("n_convs"),
            F.count_if((F.col("depth") < F.col("length")) & (F.col("from") <= F.col("depth") + 1)).alias("n_children"),
            F.count_if("leaf").alias("n_leaves"),
            F.sum(F.coalesce(shared_words - (F.col("upto") - F.col("words")), F.lit(0))).alias("saved_tokens"),
        )
    )
    ends = _end_digests(shuffled.filter("depth = length").select("conv_id", *_KEY))
    none = F.sha2(F.lit("").cast("binary"), 256)
    exact = found.join(ends, _KEY, "left").select(
        "owner.conv_id",
        "depth",
        F.when(F.col("depth") > F.col("owner.from"), F.col("owner.conv_id")).otherwise(F.col("owner.parent")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
    one, last = F.lit(1).cast("long"), F.col("depth") == F.col("length")
    tails = single.filter("parent_one").select(
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none).alias("ends_sha256"),
    )
    return exact.unionByName(tails)


def prefix_trie(
    turns: DataFrame, every: int = 0, head: Column | None = None, most: int = 0, **columns: str
) -> DataFrame:
    """The trie of a table of turns (see ``numbered``, ``prefixes`` and ``trie``); other columns are ignored."""
    return trie(prefixes(numbered(turns, **columns), every, head, most))


def with_texts(nodes: DataFrame, turns: DataFrame, **columns: str) -> DataFrame:
    """Adds role and text of each node's last turn (NULL at the root) to nodes of ``prefix_trie``."""
    conv, turn = columns.get("conv_id", "conv_id"), columns.get("turn", "turn")
    role, text = columns.get("role", "role"), columns.get("text", "text")
    said, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    order = Window.partitionBy(conv).orderBy(F.asc_nulls_first(turn), F.xxhash64(said, what), F.xxhash64(F.lit(17), said, what))
    spoken = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.row_number().over(order).cast("long").alias("depth"),
        said.alias("role"),
        what.alias("text"),
    )
    return nodes.join(spoken, ["conv_id", "depth"], "left")
