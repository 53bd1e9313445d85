"""Plain-Python definitions of the rules, for small random inputs.

Events are (key, time in seconds, arrival number, kind) tuples.
"""

from collections import defaultdict


def timelines(events):
    by_key = defaultdict(list)
    for key, t, seq, kind in sorted(events):
        by_key[key].append((t, seq, kind))
    return by_key


def window_counts(events, size, slide):
    counts = defaultdict(int)
    for key, t, _, _ in events:
        start = t // slide * slide
        while start > t - size:
            counts[(key, start + size)] += 1
            start -= slide
    return counts


def top_n(counts, n):
    ranked = defaultdict(list)
    for (key, end), cnt in counts.items():
        ranked[end].append((-cnt, key))
    return {
        (end, place, key, -cnt) for end, rows in ranked.items() for place, (cnt, key) in enumerate(sorted(rows)[:n], 1)
    }


def pairs(events, within):
    out = []
    for key, line in timelines(events).items():
        for (t0, _, k0), (t1, _, k1) in zip(line, line[1:], strict=False):
            if k0 == k1 == "fail" and t1 - t0 <= within:
                out.append((key, t0, t1))
    return sorted(out)


def relaxed(events, times, within):
    out = []
    for key, line in timelines(events).items():
        fails = [t for t, _, kind in line if kind == "fail"]
        out += [(key, a, b) for a, b in zip(fails, fails[times - 1 :], strict=False) if b - a < within]
    return sorted(out)


def strict(events, times, within):
    out = []
    for key, line in timelines(events).items():
        for i in range(len(line) - times + 1):
            run = line[i : i + times]
            if all(kind == "fail" for _, _, kind in run) and run[-1][0] - run[0][0] < within:
                out.append((key, run[0][0], run[-1][0]))
    return sorted(out)


def anchored(events, times, within):
    out = []
    for key, line in timelines(events).items():
        anchor = last = None
        seen = 0
        for t, _, kind in [*line, (10**12, 0, "end")]:
            if anchor is not None and t > anchor + within:
                if seen >= times:
                    out.append((key, anchor, last))
                anchor = None
            if kind != "fail":
                anchor = None
            elif anchor is None:
                anchor, last, seen = t, t, 1
            else:
                last, seen = t, seen + 1
    return sorted(out)


def followed_by(events, within):
    out = []
    for key, line in timelines(events).items():
        for i, (t, _, kind) in enumerate(line):
            if kind == "create":
                pay = next((u for u, _, k in line[i + 1 :] if k == "pay"), None)
                in_time = pay is not None and pay - t < within
                out.append((key, t, pay if in_time else None, "payed" if in_time else "timeout"))
    return sorted(out, key=str)


def cap(events, limit, day_of):
    seen = defaultdict(int)
    out = []
    for key, t, seq, _ in sorted(events, key=lambda e: (e[1], e[2])):
        place = seen[(key, day_of(t))] = seen[(key, day_of(t))] + 1
        if place <= limit + 1:
            out.append((seq, "passed" if place <= limit else "black-list"))
    return sorted(out)


def interval_pairs(left, right, low, high):
    return sorted((a[2], b[2]) for a in left for b in right if a[0] == b[0] and low <= b[1] - a[1] <= high)


def reconcile(left, right, within):
    """(left arrival, right arrival) with None for singles."""
    lines = defaultdict(list)
    for side, rows in enumerate((left, right)):
        for key, t, seq, _ in rows:
            lines[key].append((t, side, seq))
    out = []

    def single(row):
        return (row[2], None) if row[1] == 0 else (None, row[2])

    for line in lines.values():
        waiting = None
        for row in sorted(line):
            if waiting and waiting[1] != row[1] and row[0] - waiting[0] <= within:
                both = sorted((waiting, row), key=lambda r: r[1])
                out.append((both[0][2], both[1][2]))
                waiting = None
            else:
                if waiting:
                    out.append(single(waiting))
                waiting = row
        if waiting:
            out.append(single(waiting))
    return sorted(out, key=str)


def lateness(events, size, slide, delay, allowed):
    """Late flag and still-open window ends per arrival number, watermark in milliseconds."""
    out, highest = {}, None
    for _, t, seq, _ in sorted(events, key=lambda e: e[2]):
        mark = None if highest is None else (highest - delay) * 1000
        ends = []
        start = t // slide * slide
        while start > t - size:
            end = start + size
            if mark is None or end * 1000 - 1 + allowed * 1000 > mark:
                ends.append(end)
            start -= slide
        out[seq] = sorted(ends)
        highest = t if highest is None else max(highest, t)
    return out
