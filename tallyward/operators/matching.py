"""Two-table matching in event time: interval join and payment reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.timing import Span, floor_to, micros, span_micros
from tallyward.operators.slots import OWN, SLOT, SLOT_FACTOR, US, with_slots
from tallyward.streaming import slotted

# Bounds of the interval join, reconciliation tolerance, channel names.
JOIN_LOWER, JOIN_UPPER = "-3 seconds", "5 seconds"
RECONCILE_WITHIN = "5 seconds"
MATCHED, SINGLE_LEFT, SINGLE_RIGHT = "matched", "single-pay", "single-receipt"


def _packed(df: DataFrame, prefix: str) -> tuple[DataFrame, Column]:
    """Columns renamed with a prefix, and the expression that packs them back into one struct."""
    renamed = df.select([F.col(c).alias(prefix + c) for c in df.columns])
    return renamed, F.struct(*[F.col(prefix + c).alias(c) for c in df.columns])


# 0, or for a row that can't be matched a hash of it: it has a group of its own, so no other row sees it and none collects such rows.
_LONE = "_lone"


def _both_sides(left, right, on, left_ts, right_ts, left_seq=None, right_seq=None) -> DataFrame:
    """One row per row of either side: key, time, arrival number if asked for, side (0 or 1), ``_lone`` and the row as a struct."""

    def side(df: DataFrame, number: int, ts: str, seq: str | None) -> DataFrame:
        arrival = [] if seq is None else [F.col(seq).alias("_seq")]
        row = F.struct(*df.columns).alias(f"_row{number}")
        plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        lone = F.when(_matchable(on, ts), 0).otherwise(F.xxhash64(F.lit(number), *plain).bitwiseOR(F.lit(1)))
        return df.select(
            F.col(on).alias("_on"), F.col(ts).alias("_ts"), *arrival, F.lit(number).alias("_side"), lone.alias(_LONE), row
        )

    one, two = side(left, 0, left_ts, left_seq), side(right, 1, right_ts, right_seq)
    return one.unionByName(two, allowMissingColumns=True)


def _matchable(on: str, ts: str) -> Column:
    """A row without a key or a time matches nothing: it is a single on its own."""
    return F.col(on).isNotNull() & F.col(ts).isNotNull()


def _timed(both: DataFrame) -> DataFrame:
    """Rows of ``_both_sides`` with their time in microseconds, 0 where there is none."""
    return both.withColumn(US, F.coalesce(micros("_ts"), F.lit(0))).drop("_ts")


def _split_off(left, right, on, left_ts, right_ts, names):
    """The matchable rows of both sides, and the others as single rows ``names[0], names[1], channel``."""
    singles = []
    for df, ts, side in ((left, left_ts, 0), (right, right_ts, 1)):
        row, none = F.struct(*df.columns), F.lit(None)
        other = F.struct(*(right if side == 0 else left).columns)
        kind = (right if side == 0 else left).select(other.alias("o")).schema["o"].dataType
        columns = [row, none.cast(kind)] if side == 0 else [none.cast(kind), row]
        singles.append(
            df.filter(~_matchable(on, ts)).select(
                columns[0].alias(names[0]),
                columns[1].alias(names[1]),
                F.lit(SINGLE_LEFT if side == 0 else SINGLE_RIGHT).alias("channel"),
            )
        )
    kept = left.filter(_matchable(on, left_ts)), right.filter(_matchable(on, right_ts))
    return *kept, singles[0].unionByName(singles[1])


def _seconds(us: int) -> Column:
    return F.expr(f"INTERVAL '{us / 1e6:.6f}' SECOND")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    lower: Span = JOIN_LOWER,
    upper: Span = JOIN_UPPER,
    names: Sequence[str] = ("pay", "receipt"),
) -> DataFrame:
    """All pairs of equal ``on`` with ``right.ts`` in ``[left.ts + lower, left.ts + upper]``, as two structs.

    In batch both sides are keyed by (``on``, time slot) with slots four times as long as the interval: one left row in
    four meets a second slot, a right row lies in exactly one, so no pair is found twice, rows that
    are far apart in time are never compared, and a much used key is spread over its slots. So it is on streams (both
    sides watermarked); there the range condition also tells Spark when to drop state.
    """
    low, high = span_micros(lower), span_micros(upper)
    if low > high:
        raise ValueError("lower must not exceed upper")
    left, left_struct = _packed(left, "_l_")
    right, right_struct = _packed(right, "_r_")
    same_key = F.col("_l_" + on) == F.col("_r_" + on)
    width = max(SLOT_FACTOR * (high - low), 1)
    lus, rus = F.col("_l_us"), F.col("_r_us")
    probe = left.withColumn("_l_us", micros("_l_" + left_ts)).withColumn(
        "_l_slot",
        F.explode(
            F.sequence(floor_to(lus + F.lit(low), width), floor_to(lus + F.lit(high), width), F.lit(width))
        ),
    )
    build = right.withColumn("_r_us", micros("_r_" + right_ts)).withColumn("_r_slot", floor_to(rus, width))
    near = (rus >= lus + F.lit(low)) & (rus <= lus + F.lit(high))
    if left.isStreaming or right.isStreaming:
        lts, rts = F.col("_l_" + left_ts), F.col("_r_" + right_ts)
        near = (rts >= lts + _seconds(low)) & (rts <= lts + _seconds(high))
    joined = probe.join(build, same_key & (F.col("_l_slot") == F.col("_r_slot")) & near, "inner")
    return joined.select(left_struct.alias(names[0]), right_struct.alias(names[1]))


def with_partner_flag(
    left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, within: Span = RECONCILE_WITHIN
) -> DataFrame:
    """Every row of both sides once: ``_side`` (0 left, 1 right), ``_row0`` / ``_row1`` structs, ``has_partner``.

    Rows without a key or a time have none.

    A row has a partner iff the nearest row of the other side before or after it is close enough, so one
    sorted pass per (key, slot) answers it without forming pairs.
    """
    span = span_micros(within)
    rows = with_slots(_timed(_both_sides(left, right, on, left_ts, right_ts)), US, back=span, ahead=span)
    group = Window.partitionBy("_on", SLOT, _LONE)
    # Range frames: rows of the same instant are seen from both directions.
    before = group.orderBy(F.asc(US)).rangeBetween(Window.unboundedPreceding, 0)
    after = group.orderBy(F.desc(US)).rangeBetween(Window.unboundedPreceding, 0)

    def nearest(side: int, line) -> Column:
        return F.last(F.when(F.col("_side") == side, F.col(US)), ignorenulls=True).over(line)

    def near(gap: Column) -> Column:
        return F.coalesce(gap <= span, F.lit(False))

    def other(line) -> Column:
        return F.when(F.col("_side") == 0, nearest(1, line)).otherwise(nearest(0, line))

    flagged = rows.withColumn("_before", other(before)).withColumn("_after", other(after)).filter(OWN)
    partner = near(F.col(US) - F.col("_before")) | near(F.col("_after") - F.col(US))
    return flagged.select("_side", "_row0", "_row1", (partner & (F.col(_LONE) == 0)).alias("has_partner"))


def reconcile_pairs(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    within: Span = RECONCILE_WITHIN,
    names: Sequence[str] = ("pay", "receipt"),
) -> DataFrame:
    """Pairs at most ``within`` apart plus the unmatched rows of both sides: ``pay, receipt, channel``.

    On streams both sides are held per (key, slot) until the watermark closes the slot; in batch the slot join makes the pairs
    and one sorted pass finds the rest. With a repeated ``on`` every near pair is reported; ``reconcile`` uses each row once instead.
    """
    span = span_micros(within)
    if left.isStreaming or right.isStreaming:
        left, right, unmatched = _split_off(left, right, on, left_ts, right_ts, names)
        both = _both_sides(left, right, on, left_ts, right_ts)
        channels = (MATCHED, SINGLE_LEFT, SINGLE_RIGHT)
        matched = slotted.match_in_slots(both, "_on", "_ts", "_side", ["_row0", "_row1"], span, channels, names)
        return matched.unionByName(unmatched)
    pairs = interval_join(left, right, on, left_ts, right_ts, -span, span, names).withColumn("channel", F.lit(MATCHED))
    singles = with_partner_flag(left, right, on, left_ts, right_ts, within).filter(~F.col("has_partner"))
    return pairs.unionByName(
        singles.select(
            F.col("_row0").alias(names[0]),
            F.col("_row1").alias(names[1]),
            F.when(F.col("_side") == 0, SINGLE_LEFT).otherwise(SINGLE_RIGHT).alias("channel"),
        )
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    left_seq: str,
    right_seq: str,
    within: Span = RECONCILE_WITHIN,
    names: Sequence[str] = ("pay", "receipt"),
) -> DataFrame:
    """One-to-one matching, each row in exactly one result: ``pay, receipt, channel``.

    Per key the rows of both sides are taken in event-time order (ties: left first, then arrival). A row pairs
    with the row directly before it if that one is of the other side, at most ``within`` earlier and not
    already paired; otherwise it waits for the next row. A waiting row that the next one does not pair with is single.

    Whether a row pairs is decided by its place in a chain of rows that could pair with their predecessor (every
    second one does). Places are counted per (key, slot); only chains that run over a slot's edge need the
    count so far, which comes from one small row per such slot.
    """
    span = span_micros(within)
    both = _both_sides(left, right, on, left_ts, right_ts, left_seq, right_seq)
    rows = with_slots(_timed(both), US, back=span, ahead=span)
    line = Window.partitionBy("_on", SLOT, _LONE).orderBy(US, "_side", "_seq")

    def linked(neighbour, earlier, later) -> Column:
        near = (neighbour("_side").over(line) != F.col("_side")) & (later - earlier <= span)
        return F.coalesce(near & (F.col(_LONE) == 0), F.lit(False))

    seen = rows.select(
        "*",
        linked(F.lag, F.lag(US).over(line), F.col(US)).alias("_linked"),
        linked(F.lead, F.col(US), F.lead(US).over(line)).alias("_links_on"),
        F.lag("_row0").over(line).alias("_before0"),
        F.lag("_row1").over(line).alias("_before1"),
    ).filter(OWN)
    running = line.rowsBetween(Window.unboundedPreceding, 0)
    placed = seen.withColumn("_index", F.row_number().over(line)).withColumn(
        "_chain", F.max(F.when(~F.col("_linked"), F.col("_index"))).over(running)
    )
    # Slots a chain enters or leaves: rows, place of the last chain start, whether the first row is linked. Counting
    # the rows by side keeps this branch on the same columns as the main one, so that they share one shuffle.
    edges = (
        placed.groupBy("_on", SLOT, _LONE)
        .agg(
            (F.count("_row0") + F.count("_row1")).alias("_rows"),
            F.max("_chain").alias("_last_chain"),
            F.max_by("_links_on", "_index").alias("_leaves"),
            F.min_by("_linked", "_index").alias("_enters"),
        )
        .filter("_enters OR _leaves")
    )
    earlier = Window.partitionBy("_on").orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    counted = edges.withColumn("_rows_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    start = F.last(F.col("_rows_before") + F.col("_last_chain"), ignorenulls=True).over(earlier)
    carries = counted.select("_on", SLOT, _LONE, "_enters", (F.col("_rows_before") - start).alias("_carry")).filter("_enters")
    place = F.coalesce(F.col("_index") - F.col("_chain"), F.col("_carry") + F.col("_index"))
    paired = placed.join(carries.drop("_enters"), ["_on", SLOT, _LONE], "left").withColumn(
        "_pairs", F.pmod(place, F.lit(2)) == 1
    )
    is_left = F.col("_side") == 0
    return paired.filter(F.col("_pairs") | ~F.col("_links_on")).select(
        F.when(is_left, F.col("_row0")).when(F.col("_pairs"), F.col("_before0")).alias(names[0]),
        F.when(~is_left, F.col("_row1")).when(F.col("_pairs"), F.col("_before1")).alias(names[1]),
        F.when(F.col("_pairs"), MATCHED).when(is_left, SINGLE_LEFT).otherwise(SINGLE_RIGHT).alias("channel"),
    )


def _one_side(flagged: DataFrame, side: int, partnered: bool) -> DataFrame:
    wanted = F.col("has_partner") if partnered else ~F.col("has_partner")
    return flagged.filter((F.col("_side") == side) & wanted).select(f"_row{side}.*")


def left_without_partner(left, right, on, left_ts, right_ts, within: Span = RECONCILE_WITHIN) -> DataFrame:
    """Left rows with no right row near in time (single payments)."""
    return _one_side(with_partner_flag(left, right, on, left_ts, right_ts, within), 0, False)


def right_without_partner(left, right, on, left_ts, right_ts, within: Span = RECONCILE_WITHIN) -> DataFrame:
    """Right rows with no left row near in time (single receipts)."""
    return _one_side(with_partner_flag(left, right, on, left_ts, right_ts, within), 1, False)


def left_with_partner(left, right, on, left_ts, right_ts, within: Span = RECONCILE_WITHIN) -> DataFrame:
    """Left rows with at least one right row near in time, each once."""
    return _one_side(with_partner_flag(left, right, on, left_ts, right_ts, within), 0, True)
