"""Adaptive context-mixing range coder for token ids, many blocks at a time.

Every block starts with an empty model and its own coder state, so blocks are
independent; here one array element per block steps through all blocks together.

For the next id, order 2 (the two ids before it) and order 1 (the one before it) each
name the id that followed last time, with a confidence; order 0 holds adaptive counts of
id ranges. Adaptive counts kept per order-2 confidence, per order-1 confidence and per
last outcome are added up (mixed) to the odds that order 2, order 1 or neither is right;
in the third case the id's range is coded by the order-0 counts and its place in it evenly.
"""

from __future__ import annotations

import numpy as np

SLOT_BITS = 10
SLOTS = 1 << SLOT_BITS
SURE = 8
STEP = 24
MOST = 1 << 12
MOST_SUM = 1 << 15
# Order-0 counts take in what was seen, and all counts are held to these limits, at every so many ids.
PAUSE = 32
# Ids of a block that are brought into, or out of, the order of the steps at once.
STEPS = 64
# The interval of a block has STATE bits, and is widened by a digit when it is smaller than SMALL,
# or than SCANT before the place in a range is coded.
DIGIT = 32
STATE = 62
SMALL = 1 << STATE - DIGIT
SCANT = 1 << 16
WHOLE = (1 << DIGIT) - 1


def _ranges(ids: int) -> np.ndarray:
    """Lower ends of ranges of ids that widen with the id: frequent ids of a BPE file are small."""
    edges = [0]
    while edges[-1] < ids:
        edges.append(min(ids, edges[-1] + max(64, edges[-1] // 3)))
    return np.array(edges, dtype=np.int64)


IDS = 1 << 16
EDGES = _ranges(IDS)
WIDTH = np.diff(EDGES)
GROUPS = len(WIDTH)
RANGE_OF = np.repeat(np.arange(GROUPS), WIDTH).astype(np.uint8)
# A last "range" of every id that an order named: it has no place and leaves the interval as it is.
NAMED = GROUPS + 1
WIDTHS = np.concatenate([WIDTH, [1, 1]])
LOWEST = np.concatenate([EDGES, [0]])

# The counts of the three outcomes share an integer, 16 bits each: neither, order 2, order 1.
FIELD = (1 << 16) - 1
ONE_EACH = 1 | 1 << 16 | 1 << 32
TOO_MUCH = (~(MOST - 1) & FIELD) * ONE_EACH
HALVED = (FIELD >> 1) * ONE_EACH
GAIN = np.array([STEP, STEP << 16, STEP << 32], dtype=np.int64)

# What an entry's confidence becomes by a wrong name (first half) or a right one, as a difference.
TURN = np.array(
    [(t >> 1) - t for t in range(SURE)] + [min(t + 1, SURE - 1) - t for t in range(SURE)], dtype=np.int64
).astype(np.uint32)


def _divide(wide: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Quotients of integers of which none is negative."""
    return np.floor_divide(wide.view(np.uint64), total.view(np.uint64)).view(np.int64)


class _Model:
    """What the orders have seen so far, one column per block.

    An entry of an order's table is the id it names, times ``SURE``, and its confidence;
    an empty one names ``IDS``, which no id equals.
    """

    def __init__(self, blocks: int):
        self.blocks, self.step = blocks, 0
        self.entries = np.full(2 * blocks << SLOT_BITS, IDS * SURE, dtype=np.uint32)
        self.mixed = np.full(3 * blocks * SURE, 4 * ONE_EACH, dtype=np.int64)
        # Lower ends of the order-0 counts of every range of ids, and their total; then 0 and the total for NAMED.
        self.sums = np.repeat(np.arange(0, 2 * GROUPS + 5, 2, dtype=np.uint16)[:, None], blocks, axis=1)
        self._totals()
        # Where in the sums the ids since the last pause belong.
        self.seen: list[np.ndarray] = []
        self.one = self.two = np.zeros(blocks, dtype=np.int64)
        self.last = np.zeros(blocks, dtype=np.uint8)
        self._first(blocks)

    def _first(self, n: int) -> None:
        """Goes on with the first n blocks."""
        self.n, self.lane = n, np.arange(n, dtype=np.int64)
        self.base = (self.lane * 2 + np.arange(2)[:, None]) << SLOT_BITS
        self.row = (self.lane + self.blocks * np.arange(3)[:, None]) * SURE
        self.one, self.two, self.last = self.one[:n], self.two[:n], self.last[:n]
        self.at, self.rows = np.empty_like(self.base), np.empty_like(self.row)
        # Lower ends of the mixed odds of the three outcomes, and their total.
        self.odds = np.zeros((4, n), dtype=np.int64)

    def look(self, n: int) -> None:
        """Names and mixed odds for the next id of the first n blocks."""
        if n < self.n:
            self._first(n)
        at = self.at
        np.multiply(self.two, 60493, out=at[0])
        np.multiply(self.one, 40503, out=at[1])
        at[0] += at[1]
        at >>= 4
        at &= SLOTS - 1
        at += self.base
        self.named = self.entries.take(at)
        self.trust = self.named & SURE - 1
        np.add(self.row[:2], self.trust, out=self.rows[:2])
        np.add(self.row[2], self.last, out=self.rows[2])
        self.parts = self.mixed.take(self.rows)
        mixed = np.add.reduce(self.parts, axis=0)
        # Neither of two equal names is coded twice, and an empty entry names nothing.
        there = self.trust > 0
        there[1] &= (self.named[0] ^ self.named[1]) >= SURE
        _, none, two_of, total = self.odds
        np.bitwise_and(mixed, FIELD, out=none)
        mixed >>= 16
        np.bitwise_and(mixed, FIELD, out=two_of)
        two_of *= there[0]
        two_of += none
        mixed >>= 16
        mixed *= there[1]
        np.add(two_of, mixed, out=total)

    def learn(self, ids: np.ndarray) -> None:
        key = (ids * SURE).astype(np.uint32)
        hits = (self.named ^ key) < SURE
        turn = self.trust + (hits.view(np.uint8) << 3)
        self.entries[self.at.reshape(-1)] = np.where(turn > 2, self.named + TURN.take(turn), key + 1).reshape(-1)
        self.parts += GAIN.take(self.last)
        self.mixed[self.rows.reshape(-1)] = self.parts.reshape(-1)
        self.one, self.two = ids, self.one
        self.step += 1
        if self.step % PAUSE == 0:
            self._pause()

    def _pause(self) -> None:
        counts = np.bincount(np.concatenate(self.seen), minlength=(GROUPS + 3) * self.blocks)
        counts = counts[:GROUPS * self.blocks].reshape(GROUPS, self.blocks).astype(np.uint16)
        counts *= STEP
        sums = self.sums[:GROUPS + 1]
        sums[1:] += np.cumsum(counts, axis=0, dtype=np.uint16)
        self.seen = []
        full = np.flatnonzero(sums[GROUPS] > MOST_SUM)
        if len(full):
            counts = np.diff(sums[:, full], axis=0)
            sums[1:, full] = np.cumsum((counts >> 1) + 1, axis=0, dtype=np.uint16)
        self._totals()
        full = np.flatnonzero(self.mixed & TOO_MUCH)
        self.mixed[full] = (self.mixed[full] >> 1 & HALVED) + ONE_EACH

    def _totals(self) -> None:
        self.sums[NAMED], self.sums[NAMED + 1] = 0, self.sums[GROUPS]
        self.all = self.sums[GROUPS].astype(np.int64)


def _active(lengths: np.ndarray, longest: int) -> list[int]:
    """How many blocks have an id at each step."""
    return (len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest), side="right")).tolist()


def _payloads(lanes: list[np.ndarray], digits: list[np.ndarray], blocks: int) -> list[bytes]:
    """The digits of every block in the order in which they came, carries added to those before them."""
    lane, digit = np.concatenate(lanes), np.concatenate(digits)
    digit = digit[np.argsort(lane, kind="stable")]
    while len(over := np.flatnonzero(digit >> DIGIT)):
        digit[over] &= WHOLE
        digit[over - 1] += 1
    ends = np.cumsum(np.bincount(lane, minlength=blocks)) * 4
    whole = digit.astype("<u4").tobytes()
    return [whole[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


def encode_blocks(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """One payload per row of ``ids`` (blocks x longest), of which ``lengths`` ids count; longest rows first."""
    blocks, longest = ids.shape
    if not blocks:
        return []
    model = _Model(blocks)
    low, wide = np.zeros(blocks, dtype=np.int64), np.full(blocks, 1 << STATE, dtype=np.int64)
    lane_type = np.min_scalar_type(blocks)
    lanes: list[np.ndarray] = []
    digits: list[np.ndarray] = []

    def widen(ranges: np.ndarray, least: int) -> None:
        small = np.flatnonzero(ranges < least)
        if len(small):
            lost = low.take(small)
            lanes.append(small.astype(lane_type))
            digits.append(lost >> STATE - DIGIT)
            low[small] = (lost & SMALL - 1) << DIGIT
            ranges[small] = ranges.take(small) << DIGIT

    for t, n in enumerate(_active(lengths, longest)):
        if t % STEPS == 0:
            steps = np.ascontiguousarray(ids[:, t:t + STEPS].T, dtype=np.int64)
        model.look(n)
        now, lows, ranges = steps[t % STEPS, :n], low[:n], wide[:n]
        hits = (model.named ^ (now * SURE).astype(np.uint32)) < SURE
        model.last = outcome = hits[0].view(np.uint8) + ((hits[1] > hits[0]).view(np.uint8) << 1)
        rest = outcome == 0
        each = _divide(ranges, model.odds[3])
        at = outcome * np.int64(n) + model.lane
        start = model.odds.take(at)
        at += n
        lows += each * start
        each *= model.odds.take(at) - start
        group = RANGE_OF.take(now)
        place = now - EDGES.take(group)
        place *= rest
        group = np.where(rest, group, np.uint8(NAMED))
        at = group * np.int64(blocks) + model.lane
        model.seen.append(at)
        start = model.sums.take(at)
        each = _divide(each, model.all[:n])
        lows += each * start
        each *= model.sums.take(at + blocks) - start
        if each.min() < SCANT:
            widen(each, SCANT)
        each = _divide(each, WIDTHS.take(group))
        place *= each
        lows += place
        ranges[:] = each
        widen(ranges, SMALL)
        model.learn(now)
    for digit in (low >> STATE - DIGIT, (low & SMALL - 1) << 2):
        lanes.append(np.arange(blocks, dtype=lane_type))
        digits.append(digit)
    return _payloads(lanes, digits, blocks)


def decode_blocks(payloads: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """The ids of ``encode_blocks``, one row per payload."""
    blocks, longest = len(payloads), int(lengths[0]) if len(lengths) else 0
    if not blocks:
        return np.zeros((0, longest), dtype=np.uint32)
    sizes = np.array([len(payload) // 4 for payload in payloads])
    place = np.cumsum(sizes) - sizes
    words = np.frombuffer(b"".join([*payloads, bytes(8)]), "<u4")
    # A state is two digits less two bits, so those that follow begin within a digit.
    code = words.take(place).astype(np.int64) << 30 | words.take(place + 1) >> 2
    words = words[:-1] << 30 | words[1:] >> 2
    place += 1
    wide = np.full(blocks, 1 << STATE, dtype=np.int64)
    model = _Model(blocks)

    def widen(ranges: np.ndarray, least: int) -> None:
        small = np.flatnonzero(ranges < least)
        if len(small):
            at = place.take(small)
            code[small] = code.take(small) << DIGIT | words.take(at, mode="clip")
            at += 1
            place[small] = at
            ranges[small] = ranges.take(small) << DIGIT

    ids, steps = np.zeros((blocks, longest), dtype=np.uint32), np.zeros((STEPS, blocks), dtype=np.uint32)
    for t, n in enumerate(_active(lengths, longest)):
        model.look(n)
        ranges, codes = wide[:n], code[:n]
        ends = _divide(ranges, model.odds[3]) * model.odds
        named, other = codes >= ends[1], codes >= ends[2]
        model.last = named.view(np.uint8) + other.view(np.uint8)
        at = model.last * np.int64(n) + model.lane
        start = ends.take(at)
        at += n
        codes -= start
        each = ends.take(at) - start
        rest = ~named
        unit = _divide(each, model.all[:n])
        found = _divide(codes, unit).astype(np.uint16)
        below = model.sums[1:GROUPS + 1, :n] <= found
        group = np.where(rest, np.add.reduce(below.view(np.uint8), axis=0, dtype=np.uint8), np.uint8(NAMED))
        at = group * np.int64(blocks) + model.lane
        model.seen.append(at)
        start = model.sums.take(at)
        codes -= unit * start
        unit *= model.sums.take(at + blocks) - start
        if unit.min() < SCANT:
            widen(unit, SCANT)
        unit = _divide(unit, WIDTHS.take(group))
        inner = _divide(codes, unit)
        codes -= unit * inner
        ranges[:] = unit
        inner += LOWEST.take(group)
        now = np.where(rest, inner, np.where(other, model.named[1], model.named[0]) >> 3)
        steps[t % STEPS, :n] = now
        if t % STEPS == STEPS - 1 or t == longest - 1:
            ids[:, t // STEPS * STEPS:t + 1] = steps[:t % STEPS + 1].T
        widen(ranges, SMALL)
        model.learn(now)
    return ids
