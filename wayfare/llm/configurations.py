"""Configuration linear program of bin packing over a histogram of lengths.

A configuration is a multiset of lengths that fits one bin. The program covers
every length's count with as few configurations as it can.

Multiplicative weights solve it. Each length has a price; a knapsack table gives
the dearest configuration at these prices and, read backwards from every length,
the dearest one that holds this length. Each round fills as many bins as the
dual bound of the prices says with those configurations, the dearer the more,
by a temperature; a length that they hold more often than it is needed loses
price, one they hold less often gains, both by a factor. The temperature falls
until the dual bound stands still or ``COLD`` is reached.

The rounds' average is the fractional cover. It is rounded down, single bins
are added by their fractions, and what is left over is priced anew. Beside it
every stage is completed greedily: the dearest configuration of what is left, as
often as it fits, at the prices reached, and at the last the few pieces left by
best fit. The completion with the fewest bins is the plan. Work depends on the
number of distinct lengths and the capacity, not on the number of pieces.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

Configuration = tuple[tuple[int, int], ...]  # (length, how often), longest first

#: Temperature of the first round and how fast it falls; a share of a configuration's worth.
WARM, FALL = 0.3, 0.55
#: Temperature at which prices are as good as they get, about the share of bins that they can be off by; half a bin is enough.
COLD = 0.0026
#: The dual bound stands still where twice the rounds raise it by less than this share.
STILL = 5e-4
#: Rounds before that is asked, and rounds whose average is the cover; the temperature falls on to a sixth in these.
FIRST, COVER, COVER_FALL = 64, 300, 6.0
#: Part of the temperature by which an uneven cover moves prices, and the most by which a length counts as over-covered.
STEP, OVER = 0.5, 4.0
#: No price lies further below the highest than this many factors of e, so that none is lost to rounding.
DEEP = 16.0
#: Configurations cheaper than the dearest by more than this many temperatures are left out.
REACH = 8
#: Lengths below this have a table of their own.
SHORT = 32
#: Of two fillings of one worth, the one with fewer, longer pieces wins.
BEND = 1e-4
#: Share above the dual bound at which a plan needs no other beside it.
NEAR = 2e-4


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per room: the highest worth, the length added last (-1: none), and the largest room below it that adds one.

    Lengths below ``SHORT`` come first, each by 1, 2, 4 ... copies over all rooms at once; then the others, over blocks of
    rooms, which look only at blocks before.
    """
    shorts = int(np.searchsorted(lengths, SHORT))
    best = np.zeros(2 * capacity + 1)  # the first ``capacity`` entries are of rooms below 0
    best[:capacity] = -np.inf
    rooms_up = best[capacity:]
    for length, price in zip(lengths[:shorts].tolist(), prices[:shorts].tolist()):
        while length <= capacity:
            rooms_up[length:] = np.maximum(rooms_up[length:], rooms_up[:-length] + price)
            length, price = 2 * length, 2 * price
    pick = np.full(capacity + 1, -1)
    if shorts:
        added = best[np.arange(capacity, 2 * capacity + 1)[:, None] - lengths[:shorts]] + prices[:shorts]
        rise = np.diff(rooms_up, prepend=0.0) > 1e-15
        pick[rise] = added.argmax(axis=1)[rise]
    if shorts < len(lengths):
        long, worth = lengths[shorts:], prices[shorts:]
        for room in range(int(long[0]), capacity + 1, int(long[0])):
            rooms = np.arange(room, min(room + int(long[0]), capacity + 1))
            fits = np.searchsorted(long, rooms[-1], side="right")
            value = best[(rooms + capacity)[:, None] - long[:fits]] + worth[:fits]
            k = value.argmax(axis=1)
            dear = value[np.arange(len(rooms)), k]
            only_short = rooms_up[rooms]
            so_far = np.maximum.accumulate(np.append(rooms_up[room - 1], np.maximum(dear, only_short)))
            rises = so_far[1:] > so_far[:-1] + 1e-15
            pick[rooms] = np.where(rises, np.where(dear >= only_short, k + shorts, pick[rooms]), -1)
            rooms_up[rooms] = so_far[1:]
    return rooms_up, pick, np.maximum.accumulate(np.where(pick >= 0, np.arange(capacity + 1), 0))


def _held(lengths: np.ndarray, pick: np.ndarray, at: np.ndarray, rooms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, length's number) of every piece in the dearest fillings of ``rooms``."""
    row, room = np.arange(len(rooms)), at[rooms]
    rows, items = [row[:0]], [row[:0]]
    while True:
        row, room = row[room > 0], room[room > 0]
        if not len(row):
            return np.concatenate(rows), np.concatenate(items)
        rows.append(row)
        items.append(pick[room])
        room = at[room - lengths[pick[room]]]


def dearest(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length stands in the configuration of the highest price."""
    _, pick, at = knapsack(lengths, prices, capacity)
    return np.bincount(_held(lengths, pick, at, np.array([capacity]))[1], minlength=len(lengths))


@dataclass
class Cover:
    """Prices at which no configuration costs more than one, their worth, and an average of rounds."""

    prices: np.ndarray
    bound: float = 0.0
    cold: float = 0.0
    rounds: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def configurations(self) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Distinct configurations as (lengths' numbers, how often), and their amounts."""
        made = np.cumsum([0, *(len(amount) for _, amount, _, _ in self.rounds)])
        tag, amount, items = (np.concatenate([r[i] for r in self.rounds]) for i in (0, 1, 3))
        rows = np.concatenate([r[2] + n for r, n in zip(self.rounds, made)])
        _, first, same = np.unique(tag, return_index=True, return_inverse=True)
        order = np.argsort(rows, kind="stable")
        rows, items = rows[order], items[order]
        ends = zip(np.searchsorted(rows, first), np.searchsorted(rows, first, side="right"))
        return [np.unique(items[a:b], return_counts=True) for a, b in ends], np.bincount(same, amount) / len(self.rounds)


def cover(lengths: np.ndarray, demand: np.ndarray, capacity: int, prices: np.ndarray, cold: float | None = None) -> Cover:
    """A fractional cover of ``demand`` by multiplicative weights, from ``prices``; at the temperature ``cold`` throughout
    if it is given."""
    tags = np.random.default_rng(0).integers(1, 2**62, len(lengths)).astype(np.uint64)  # a sum of tags names a configuration
    logs, out, marks, t, end = np.log(prices), Cover(prices), {}, 0, None
    if cold is not None:
        end, heat, fall = COVER, cold, 1.0
    while end is None or t < end:
        heat_now = WARM / (1 + t) ** FALL if end is None else heat * fall ** -(1 - (end - t) / COVER)
        prices = np.exp(logs)
        best, pick, at = knapsack(lengths, prices, capacity)
        bound = float(prices @ demand / best[capacity])
        if bound > out.bound:
            out.bound, out.prices = bound, prices / best[capacity]
        short = (prices + best[capacity - lengths]) / best[capacity] - 1
        near = np.flatnonzero(short >= -REACH * heat_now)
        rows, items = _held(lengths, pick, at, capacity - lengths[near])
        rows, items = np.append(rows, np.arange(len(near))), np.append(items, near)
        amount = (demand * prices)[near] * np.exp(short[near] / heat_now)
        amount *= out.bound / amount.sum()
        even = np.bincount(items, amount[rows], minlength=len(lengths)) / demand
        logs = logs - STEP * heat_now * np.clip(even - 1, -1, OVER)
        logs = np.maximum(logs, logs.max() - DEEP)
        logs -= np.log(np.exp(logs) @ demand / bound)
        if end is not None and t >= end - COVER // 2:
            tag = np.zeros(len(near), np.uint64)
            np.add.at(tag, rows, tags[items])
            out.rounds.append((tag, amount, rows, items))
        t += 1
        if end is None and (t & (t - 1) == 0 or t % 500 == 0):
            marks[t] = out.bound
            if heat_now <= max(COLD, 0.5 / out.bound) or t >= FIRST and out.bound <= marks.get(t // 2, 0.0) * (1 + STILL):
                end, heat, fall = t + COVER, heat_now, COVER_FALL
        out.cold = heat_now
    return out


def _add(plan: dict[Configuration, int], lengths: np.ndarray, numbers: np.ndarray, often: np.ndarray, times: int) -> None:
    key = tuple((int(lengths[k]), int(n)) for k, n in zip(numbers[::-1], often[::-1]))
    plan[key] = plan.get(key, 0) + times


def greedy(lengths: np.ndarray, left: np.ndarray, capacity: int, prices: np.ndarray) -> dict[Configuration, int]:
    """Whole configurations that hold exactly ``left``: the dearest one of what is left, as often as it fits; pieces that
    it asks for more often than they are there, and the last ones, go by best fit."""
    out: dict[Configuration, int] = {}
    left, prices = left.copy(), prices * (lengths / capacity) ** BEND
    while left.sum() > len(lengths):
        there = np.flatnonzero(left)
        open_lengths = there
        while len(open_lengths):
            taken = np.zeros(len(lengths), np.int64)
            taken[open_lengths] = dearest(lengths[open_lengths], prices[open_lengths], capacity)
            used = np.flatnonzero(taken)
            times = int((left[used] // taken[used]).min())
            if times:
                left[used] -= times * taken[used]
                _add(out, lengths, used, taken[used], times)
            # What runs out, and what is there less often than the configuration asks, waits for the next turn.
            open_lengths = open_lengths[left[open_lengths] >= np.maximum(taken[open_lengths], 1)]
        if (left[there] > 0).all():
            break
    for key, times in best_fit(lengths, left, capacity).items() if left.any() else ():
        out[key] = out.get(key, 0) + times
    return out


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[Configuration, int]:
    """Remaining pieces, longest first, each bin filled with what leaves the least room."""
    out: dict[Configuration, int] = {}
    left = left.copy()
    while left.any():
        first = int(np.flatnonzero(left)[-1])
        taken = np.zeros(len(lengths), np.int64)
        taken[first] = 1
        room = capacity - int(lengths[first])
        # Sums that the other pieces, each as often as it is there, can reach inside the room; from[s] is the last added.
        came = np.full(room + 1, -1)
        reach = np.zeros(room + 1, bool)
        reach[0] = True
        for k in np.flatnonzero(left)[::-1]:
            size, often = int(lengths[k]), int(left[k]) - int(k == first)
            for _ in range(min(often, room // size if size else 0)):
                new = np.flatnonzero(reach[:room + 1 - size]) + size
                new = new[~reach[new]]
                if not len(new):
                    break
                reach[new] = True
                came[new] = k
            if reach[room]:
                break
        total = int(np.flatnonzero(reach)[-1])
        while total:
            taken[came[total]] += 1
            total -= int(lengths[came[total]])
        used = np.flatnonzero(taken)
        taken[used] = np.minimum(taken[used], left[used])
        times = int((left[used] // taken[used]).min())
        left -= times * taken
        key = tuple((int(lengths[k]), int(taken[k])) for k in used[::-1])
        out[key] = out.get(key, 0) + times
    return out


def plan(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> dict[Configuration, int]:
    """Whole numbers of configurations that hold exactly ``demand``, all above 0."""
    held: dict[Configuration, int] = {}
    left, prices, best, bound, cold = demand.copy(), lengths / capacity, None, 0.0, None
    while left.any():
        there = np.flatnonzero(left)
        sizes = lengths[there]
        found = cover(sizes, left[there].astype(float), capacity, prices[there], cold)
        prices[there] = found.prices
        cold, bound = cold or found.cold, bound or max(found.bound, lengths @ demand / capacity)
        whole = held.copy()
        for key, times in greedy(sizes, left[there], capacity, found.prices).items():
            whole[key] = whole.get(key, 0) + times
        if best is None or sum(whole.values()) < sum(best.values()):
            best = whole
        before = left.sum()
        if sum(best.values()) <= np.ceil(bound) * (1 + NEAR) or before <= len(lengths):
            break
        configurations, amounts = found.configurations()
        for order, one in ((np.argsort(-amounts, kind="stable"), False), (np.argsort(-(amounts % 1), kind="stable"), True)):
            for i in order:
                numbers, often = configurations[i]
                times = min(1 if one else int(amounts[i]), int((left[there[numbers]] // often).min()))
                if times:
                    left[there[numbers]] -= times * often
                    _add(held, sizes, numbers, often, times)
        if left.sum() > 0.9 * before:
            break
    return best if left.any() or not held else min(best, held, key=lambda p: sum(p.values()))


def solve(counts: dict[int, int], capacity: int) -> list[tuple[Configuration, int]]:
    """Configurations with whole numbers of bins that hold exactly ``counts`` pieces of each length."""
    lengths = np.array(sorted(n for n, c in counts.items() if 0 < n < capacity and c > 0), np.int64)
    demand = np.array([counts[n] for n in lengths], np.int64)
    out = plan(lengths, demand, capacity) if len(lengths) else {}
    full = counts.get(capacity, 0)
    if full:
        out[((capacity, 1),)] = full
    return sorted(out.items(), key=lambda c: (-c[1], c[0]))
