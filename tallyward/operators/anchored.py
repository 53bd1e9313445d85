"""Timer-anchored failure groups.

The first failure of a key opens a group and starts a timer; failures join until the timer runs out; a
non-failure before that cancels the group. When the timer runs out with at least ``times`` failures the
group is reported, and the next failure opens a new one. Each group start depends on the one before, so
this is no window function. It is split up as follows.

* A failure opens a group for certain if the key's previous event is a non-failure or more than the
  span ago. Chains of groups start at these rows, independently of each other; failures standing alone
  between two such rows can never reach ``times`` and are dropped at once.
* What is left is keyed by (key, time slot). Only a chain that runs over a slot's edge needs anything from
  outside: the last group start of the slot before. Each slot is summarised as a function "group start I would
  begin with -> last group start I would end with", a few steps of a staircase. The functions of a block of slots are
  composed to one of the same kind, the blocks are walked once per key, and the results go back to the blocks and their slots.

So a key with nothing but failures, however many, is never collected: a task holds one slot of it, composes one block
of slots, or walks one small function per block. Staircases have few steps, as chains that start apart soon fall together; at
worst (failures at even intervals) as many as failures fit in a span.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.timing import Span, span_micros
from tallyward.operators.failures import GROUP_WITHIN, TIMER_MESSAGE
from tallyward.operators.slots import OWN, SLOT, US, slot_width, with_slots

MIN_TIMES = 2

_NONE = np.iinfo(np.int64).min
_NEVER = 1 << 62

# Slots whose functions are composed together.
_BLOCK_SLOTS = 1024
_BLOCK = "_block"


def _marked_failures(df: DataFrame, key: str, ts: str, seq: Sequence[str], failed: Column, times: int, span: int):
    """Failures that can be part of a reportable group, with ``_sure`` and ``_reset`` (next non-failure)."""
    rows = with_slots(df.select(key, ts, *seq, failed.alias("_failed")), ts, back=span, ahead=span)
    line = Window.partitionBy(key, SLOT).orderBy(US, *seq)
    seen = rows.select(
        "*",
        F.lag("_failed").over(line).alias("_prev_failed"),
        F.lag(US).over(line).alias("_prev_us"),
        F.lead("_failed").over(line).alias("_next_failed"),
        F.lead(US).over(line).alias("_next_us"),
    ).filter(F.col(OWN) & F.col("_failed"))
    follows = F.coalesce(F.col("_prev_failed") & (F.col(US) - F.col("_prev_us") <= span), F.lit(False))
    followed = F.coalesce(F.col("_next_failed") & (F.col("_next_us") - F.col(US) <= span), F.lit(False))
    marked = seen.select(
        key,
        US,
        *seq,
        (~follows).alias("_sure"),
        F.when(~F.col("_next_failed"), F.col("_next_us")).alias("_reset"),
        followed.alias("_followed"),
    )
    if times > 1:
        marked = marked.filter(~F.col("_sure") | F.col("_followed"))
    return marked.drop("_followed")


class _Slots:
    """Sorted rows of whole (key, slot) groups as flat arrays, with the next possible group start per row."""

    def __init__(self, pdf: pd.DataFrame, key: str, width: int, span: int):
        keys, slots = pdf[key], pdf[SLOT].to_numpy()
        new = np.ones(len(pdf), bool)
        new[1:] = (keys.to_numpy()[1:] != keys.to_numpy()[:-1]) | (slots[1:] != slots[:-1])
        self.starts = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        self.us = pdf[US].to_numpy()
        self.own = pdf[OWN].to_numpy(bool)
        self.sure = pdf["_sure"].to_numpy(bool)
        size = len(pdf)
        # One increasing axis for all groups: searches cannot run over into the next group.
        self.axis = self.group * np.int64(width + 2 * span + 1) + (self.us - slots)
        self.expires = np.searchsorted(self.axis, self.axis + span, side="right")
        border = np.where(self.sure | new, np.arange(size), size)
        following = np.full(size + 1, size)
        following[:size] = np.minimum.accumulate(border[::-1])[::-1]
        self.next = np.minimum(self.expires, following[1:])

    def own_group_start(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether index ``at`` is a row of ``group`` that belongs to the slot itself."""
        inside = at < len(self.us)
        safe = np.where(inside, at, 0)
        return inside & self.own[safe] & (self.group[safe] == group)


def _whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Arrow batches re-cut so that no (key, slot) group is split. Holds one batch and one group."""
    held = None
    for batch in batches:
        if held is not None and len(held):
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        last = batch.iloc[-1]
        tail = (batch[key] == last[key]).to_numpy() & (batch[SLOT] == last[SLOT]).to_numpy()
        cut = len(batch) - int(tail.sum())
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
        held = batch.iloc[cut:]
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def _edge_summaries(batches, key, width, span):
    """Per slot: the last group start it ends with, per group start it may begin with (NULL: any)."""
    for pdf in _whole_groups(batches, key):
        s = _Slots(pdf, key, width, span)
        own_sure = np.where(s.sure & s.own, np.arange(len(pdf)), -1)
        last_sure = np.maximum.reduceat(own_sure, s.starts)
        has_sure = last_sure >= 0
        # Slots with a certain group start end the same way whatever came in.
        fixed = last_sure[has_sure]
        # The others may begin at any own row up to the first one a span after the slot's start.
        late = s.us - pdf[SLOT].to_numpy() > span
        first_late = late & np.r_[True, ~late[:-1] | (s.group[1:] != s.group[:-1])]
        open_row = s.own & ~has_sure[s.group] & (~late | first_late)
        begin = np.r_[fixed, np.flatnonzero(open_row)]
        known = np.r_[np.ones(len(fixed), bool), np.zeros(len(begin) - len(fixed), bool)]
        end = begin.copy()
        while True:
            step = s.next[end]
            moving = s.own_group_start(step, s.group[end])
            if not moving.any():
                break
            end = np.where(moving, step, end)
        out = pd.DataFrame(
            {
                key: pdf[key].to_numpy()[begin],
                SLOT: pdf[SLOT].to_numpy()[begin],
                "_from": pd.array(np.where(known, 0, s.us[begin]), dtype="Int64"),
                "_to": s.us[end],
            }
        )
        out.loc[known, "_from"] = pd.NA
        yield _steps(out.drop_duplicates(), [key, SLOT])


def _steps(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """Rows of staircases (ascending ``_from`` per group) without those that the next row says as well."""
    same = rows["_to"].to_numpy()[:-1] == rows["_to"].to_numpy()[1:]
    for column in by:
        same &= rows[column].to_numpy()[:-1] == rows[column].to_numpy()[1:]
    return rows[~np.r_[same, False]] if len(rows) else rows


def _composed(batches, key, width, span):
    """Per (key, block): its slots' functions one after the other, as ``_from`` -> ``_to`` with its first and last slot.

    A block ends without a group start (``_to`` NULL) where none of its last slot's rows can begin one.
    """
    columns = [key, _BLOCK, "_first_slot", "_last_slot", "_from", "_to"]
    block, slot, first, entries, ends = None, None, None, None, None

    def done():
        ends_of = pd.array(np.where(ends == _NONE, 0, ends), dtype="Int64")
        ends_of[ends == _NONE] = pd.NA
        rows = pd.DataFrame({key: block[0], _BLOCK: block[1], "_first_slot": first, "_last_slot": slot, "_from": entries, "_to": ends_of})
        differs = np.r_[ends[:-1] != ends[1:], True]
        return rows[differs]

    for pdf in _whole_groups(batches, key):
        out = []
        keys, slots, blocks = pdf[key].to_numpy(), pdf[SLOT].to_numpy(), pdf[_BLOCK].to_numpy()
        begins = pdf["_from"].fillna(_NONE).to_numpy(dtype="int64")
        to = pdf["_to"].to_numpy(dtype="int64")
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (slots[1:] != slots[:-1])])
        for a, b in zip(new, np.r_[new[1:], len(pdf)]):
            here = (keys[a], blocks[a])
            # What a start before, none, or one too late for every row leads to.
            steps, after = begins[a:b], np.r_[to[a:b], _NONE]
            if here != block:
                if block is not None:
                    out.append(done())
                block, first = here, slots[a]
                entries, ends = np.r_[steps, _NEVER], after
            else:
                adjacent = slots[a] - slot == width
                late = np.where((ends == _NONE) | (not adjacent), _NONE, ends + span)
                place = np.where(late == _NONE, 0, np.searchsorted(steps, late, side="right"))
                ends = after[0 if steps[0] == _NONE else place] + np.zeros(len(ends), np.int64)
            slot = slots[a]
        if out:
            yield pd.concat(out)[columns]
    if block is not None:
        yield done()[columns]


def _block_carries(batches, key, width, span):
    """Walk the blocks of each key; give each the last group start before it as the end of a slot before its first."""
    current, last, outgoing, block, resolved, incoming = None, None, _NONE, None, False, _NONE
    for pdf in batches:
        found = []
        rows = zip(pdf[key], pdf[_BLOCK], pdf["_first_slot"], pdf["_last_slot"], pdf["_from"], pdf["_to"], strict=True)
        for k, at, first, end, begin, to in rows:
            if k != current or at != block:
                adjacent = k == current and last is not None and first - last == width
                incoming = outgoing if adjacent else _NONE
                current, block, last, outgoing, resolved = k, at, end, _NONE, False
                if incoming != _NONE:
                    found.append((k, at, first - width, incoming))
            if not resolved and (begin == _NONE or incoming == _NONE or begin > incoming + span):
                outgoing, resolved = (_NONE if pd.isna(to) else int(to)), True
        yield pd.DataFrame(found, columns=[key, _BLOCK, SLOT, "_to"])


def _carries(batches, key, width, span):
    """Walk the summaries of each key in slot order; give each slot the last group start before it."""
    current, slot, incoming, outgoing, resolved = None, None, _NONE, _NONE, False
    for pdf in batches:
        found = []
        for k, at, begin, end in zip(pdf[key], pdf[SLOT], pdf["_from"], pdf["_to"], strict=True):
            if k != current or at != slot:
                adjacent = k == current and slot is not None and at - slot == width
                incoming = outgoing if adjacent else _NONE
                current, slot, outgoing, resolved = k, at, _NONE, False
                if incoming != _NONE:
                    found.append((k, at, incoming))
            if not resolved and (pd.isna(begin) or incoming == _NONE or begin > incoming + span):
                outgoing, resolved = int(end), True
        yield pd.DataFrame(found, columns=[key, SLOT, "_carry"])


def _reports(batches, key, width, span, times):
    """Walk all chains of a batch side by side; the carries are rows that sort before their slot's rows."""
    for pdf in _whole_groups(batches, key):
        is_carry = pdf["_carry"].notna().to_numpy()
        new = np.ones(len(pdf), bool)
        new[1:] = (pdf[key].to_numpy()[1:] != pdf[key].to_numpy()[:-1]) | np.diff(pdf[SLOT].to_numpy()).astype(bool)
        group = np.cumsum(new) - 1
        carry = np.full(group[-1] + 1, _NONE)
        carry[group[is_carry]] = pdf["_carry"].to_numpy()[is_carry].astype("int64")
        pdf = pdf[~is_carry].reset_index(drop=True)
        s = _Slots(pdf, key, width, span)
        # First group start of each slot: its first row, or the first one after the carried group ran out.
        runs_out = s.axis[s.starts] - s.us[s.starts] + np.where(carry == _NONE, 0, carry) + span
        enter = np.where(carry == _NONE, s.starts, np.searchsorted(s.axis, runs_out, side="right"))
        sure_at = np.where(s.sure, np.arange(len(pdf)), len(pdf))
        enter = np.minimum(enter, np.minimum.reduceat(sure_at, s.starts))
        usable = s.own_group_start(enter, np.arange(len(s.starts)))
        usable &= ~s.sure[np.where(usable, enter, 0)]
        at = np.r_[np.flatnonzero(s.sure & s.own), enter[usable]]
        anchors, ends = [at], [s.next[at]]
        while True:
            step = s.next[at]
            go_on = s.own_group_start(step, s.group[at])
            go_on &= ~s.sure[np.where(go_on, step, 0)]
            at = step[go_on]
            if not len(at):
                break
            anchors.append(at)
            ends.append(s.next[at])
        anchor, end = np.concatenate(anchors), np.concatenate(ends)
        reset = pdf["_reset"].fillna(_NEVER).to_numpy(dtype="int64")[end - 1]
        keep = (end - anchor >= times) & (reset > s.us[anchor] + span)
        anchor, last = anchor[keep], end[keep] - 1
        yield pd.DataFrame({key: pdf[key].to_numpy()[anchor], "_first": s.us[anchor], "_last": s.us[last]})


def anchored_groups(
    df: DataFrame,
    key: str,
    ts: str,
    seq: Sequence[str],
    failed: Column,
    times: int = MIN_TIMES,
    within: Span = GROUP_WITHIN,
    message: str = TIMER_MESSAGE,
    block_slots: int = _BLOCK_SLOTS,
) -> DataFrame:
    """Groups of at least ``times`` failures collected while a timer of ``within`` runs.

    One row per group: ``key, first_fail_ts, last_fail_ts, msg``. A failure at exactly the timer's end still
    belongs to the group, and so does a cancelling event.
    """
    span = span_micros(within)
    width = slot_width(span)
    marked = _marked_failures(df, key, ts, seq, failed, times, span)
    rows = with_slots(marked, US, ahead=span, width=width)
    key_type = df.schema[key].dataType.simpleString()

    def sorted_slots(frame: DataFrame) -> DataFrame:
        return frame.repartition(key, SLOT).sortWithinPartitions(key, SLOT, US, *seq)

    summaries = sorted_slots(rows.select(key, SLOT, US, *seq, OWN, "_sure")).mapInPandas(
        lambda it: _edge_summaries(it, key, width, span),
        f"`{key}` {key_type}, {SLOT} bigint, _from bigint, _to bigint",
    )
    blocked = summaries.withColumn(_BLOCK, F.col(SLOT) - F.pmod(F.col(SLOT), F.lit(width * block_slots)))

    def sorted_blocks(frame: DataFrame) -> DataFrame:
        return frame.repartition(key, _BLOCK).sortWithinPartitions(key, _BLOCK, SLOT, F.asc_nulls_first("_from"))

    columns = f"`{key}` {key_type}, {_BLOCK} bigint, _first_slot bigint, _last_slot bigint, _from bigint, _to bigint"
    composed = sorted_blocks(blocked).mapInPandas(lambda it: _composed(it, key, width, span), columns)
    handed = (
        composed.repartition(key)
        .sortWithinPartitions(key, _BLOCK, "_from")
        .mapInPandas(
            lambda it: _block_carries(it, key, width, span), f"`{key}` {key_type}, {_BLOCK} bigint, {SLOT} bigint, _to bigint"
        )
    )
    carries = sorted_blocks(blocked.unionByName(handed, allowMissingColumns=True)).mapInPandas(
        lambda it: _carries(it, key, width, span), f"`{key}` {key_type}, {SLOT} bigint, _carry bigint"
    )
    markers = carries.withColumn(US, F.col(SLOT) - F.lit(1))
    reports = sorted_slots(
        rows.withColumn("_carry", F.lit(None).cast("bigint")).unionByName(markers, allowMissingColumns=True)
    ).mapInPandas(
        lambda it: _reports(it, key, width, span, times), f"`{key}` {key_type}, _first bigint, _last bigint"
    )
    return reports.select(
        key,
        F.timestamp_micros("_first").alias("first_fail_ts"),
        F.timestamp_micros("_last").alias("last_fail_ts"),
        F.lit(message).alias("msg"),
    )
