"""Adaptive context-mixing range coder for token ids; many blocks are coded in lockstep.

Each block starts from nothing.  For every id, order 2 (the two ids before) and order 1 (the
id before) predict one id each, with a confidence of 0 to 7; order 0 is the
frequency table of the block so far.  The three are mixed: weights that adapt per pair of confidences
give the shares of the code range for order 2's id, order 1's id and the table,
which itself keeps a share for ids not seen yet: the part of the block that was seen once only, which is the Good-Turing
estimate of that chance.  The table learns from the 8th id on, whenever the block has grown by an eighth; what is new is
merged into it.  An id that it doesn't know is coded by its length in bits, by the counts of those lengths, which learn when the table does, and its plain bits.

The coder has a 48-bit range and writes 16-bit words; a carry is added to the word before
when a block is finished.  All lanes (blocks) take the same step at the same
time as numpy vectors, so a step costs a few dozen vector operations for hundreds of ids.  The encoder, which has all ids,
looks up what the table says of all steps up to its next change at once.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Ids in a block; blocks coded together.
BLOCK, LANES = 4096, 1024
#: Entries of an order's prediction table; ids before the frequency table learns first; its least and largest share for new ids (of 2**16).
SLOTS, FIRST, ESCAPE = 1024, 8, (512, 49152)
MAX_ID = (1 << 29) - 1
#: First weights by confidence (of 2**16): order 2's id, and order 1's id in what is left.
TWO, ONE = (256, 12288, 24576, 36864, 45056, 51200, 55296, 59392), (256, 8192, 16384, 24576, 32768, 38912, 45056, 51200)
#: Longest block: every id of a block needs a share of its table.
MOST = 1 << 15
_U = np.uint64
_RATE = 5
#: Multipliers of the hashes of contexts, and the shift to a slot.
_HASH, _SHIFT = (np.uint32(2654435761), np.uint32(2246822519)), 33 - SLOTS.bit_length()
#: Change of an entry by its confidence, without and with a hit: one more at most 7, or half (an entry of 0 or 1 goes).
_KEPT = np.array([0, 0, *((c >> 1) - c for c in range(2, 8)), 1, 1, 1, 1, 1, 1, 1, 0], np.int64).astype(np.uint32)


class _Table:
    """Order-0 frequencies (of 2**16) of the lanes' histories, for all lanes in one sorted array."""

    def __init__(self, lanes: int):
        self.lanes, self.t = lanes, 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._shares()

    def add(self, more: np.ndarray) -> None:
        """Learn the next ids (one row a step) of all lanes."""
        seen = np.sort(more.T, axis=1) | (np.arange(self.lanes, dtype=np.int64) << 32)[:, None]
        seen = seen.ravel()
        first = np.flatnonzero(np.concatenate(([True], seen[1:] != seen[:-1])))
        keys, counts = seen[first], np.diff(first, append=len(seen))
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        self.counts[at[known]] += counts[known]
        self.keys, self.counts = (np.insert(old, at[~known], new[~known]) for old, new in ((self.keys, keys), (self.counts, counts)))
        self.t += len(more)
        self._shares()

    def _shares(self) -> None:
        lane, t = self.keys >> 32, self.t
        once = np.bincount(lane[self.counts == 1], minlength=self.lanes)
        self.last = _known_share(once, t)  # where the share for new ids starts
        ends = np.cumsum(self.counts) - lane * t  # ids of a lane's history up to each entry's
        last = self.last[lane]
        self.start = (ends - self.counts) * last // max(t, 1)
        self.freq = ends * last // max(t, 1) - self.start
        #: Of every place in a lane's sorted history: its id, start and size.
        self.places = np.repeat((self.keys & 0xFFFFFFFF) << 33 | self.start << 17 | self.freq, self.counts)

    def of_slots(self, lane: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, known, id) of the entries that hold a slot."""
        last = self.last[lane]
        known = slot < last
        if not len(self.keys):
            return last, 65536 - last, known, slot
        # the last place whose start isn't behind the slot; doubles are exact here
        place = ((slot + 1) * self.t - 1) / np.maximum(last, 1)
        e = self.places[lane * self.t + np.minimum(place.astype(np.int64), self.t - 1)]
        return np.where(known, e >> 17 & 0xFFFF, last), np.where(known, e & 0x1FFFF, 65536 - last), known, e >> 33


def _known_share(once: np.ndarray, t: int) -> np.ndarray:
    """Share (of 2**16) of the ids that a lane's history of ``t`` ids holds, ``once`` of them just once."""
    if not t:
        return np.zeros(len(once), np.int64)
    fresh = np.clip(65536 * once // t, *ESCAPE)
    return 65536 - np.minimum(fresh, 65536 - t)  # leaves every known id a share


class _Counts:
    """The table of :class:`_Table` for the encoder, which knows a block's ids before: counts by their ranks."""

    def __init__(self, ids: np.ndarray):
        steps, lanes = ids.shape
        key = ids.T.astype(np.int64) << 15 | np.arange(steps)
        key.sort(axis=1)
        rank = np.zeros((lanes, steps), np.int32)
        np.cumsum(key[:, 1:] >> 15 != key[:, :-1] >> 15, axis=1, out=rank[:, 1:])
        width = int(rank.max(initial=0)) + 1
        rank += (np.arange(lanes, dtype=np.int32) * width)[:, None]
        key &= 32767
        at = np.empty((lanes, steps), np.int32)
        np.put_along_axis(at, key, rank, axis=1)
        #: Where each id of the block is counted, one row a step.
        self.at = at.T.copy()
        self.counts, self.t = np.zeros((lanes, width), np.int32), 0
        self._shares()

    def add(self, upto: int) -> None:
        """Learn the ids of all lanes up to a step."""
        self.counts += np.bincount(self.at[self.t:upto].ravel(), minlength=self.counts.size).reshape(self.counts.shape)
        self.t = upto
        self._shares()

    def _shares(self) -> None:
        self.last = _known_share(np.count_nonzero(self.counts == 1, axis=1), self.t)
        self.ends = np.cumsum(self.counts, axis=1, dtype=np.int32)

    def of_ids(self, lane: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, known) of ids counted at ``at``; those of unknown ids are of the share for new ids."""
        last, own, end = self.last[lane], self.counts.reshape(-1)[at], self.ends.reshape(-1)[at]
        known = own > 0
        start = (end - own) * last // max(self.t, 1)
        size = end * last // max(self.t, 1) - start
        return np.where(known, start, last), np.where(known, size, 65536 - last), known


class _Lengths:
    """Adaptive shares of the lengths in bits of ids that no table knows; they learn when the table does."""

    def __init__(self, wide: np.ndarray):
        self.counts = (np.arange(32) <= np.where(wide, 31, 16)[:, None]).astype(np.int64)
        self.learn(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def of_ids(self, lane: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of lengths."""
        start = self.ends[lane, length]
        return start, self.ends[lane, length + 1] - start

    def of_slots(self, lane: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, length) of the entries that hold a slot."""
        length = (self.ends[lane, 1:] <= slot[:, None]).sum(axis=1)
        return *self.of_ids(lane, length), length

    def learn(self, lane: np.ndarray, length: np.ndarray) -> None:
        np.add.at(self.counts, (lane, length), 1)
        total = np.cumsum(self.counts, axis=1)
        self.ends = np.zeros((len(total), 33), np.int64)
        self.ends[:, 1:] = (total << 16) // total[:, -1:]

    @staticmethod
    def plain(length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits below the leading one, the low 16 and those above."""
        rest = np.maximum(length - 1, 0)
        return np.minimum(rest, 16), np.maximum(rest - 16, 0)


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


class _Model:
    """Predictions and mixing weights of all lanes: row 0 is order 2, row 1 is order 1."""

    def __init__(self, lanes: int):
        rows = np.arange(2)[:, None]
        self.entries = np.zeros(2 * lanes * SLOTS, np.uint32)  # id and confidence
        ctx = np.arange(128)  # the confidences of order 2 and order 1, and whether their ids differ
        self.weights = np.concatenate([np.tile(np.array(w, np.int64)[at], lanes) for w, at in ((TWO, ctx >> 4), (ONE, ctx >> 1 & 7))])
        self.base, self.mix = ((np.arange(lanes) + rows * lanes) * k for k in (SLOTS, 128))
        self.a, self.hash = (np.zeros(lanes, np.uint32) for _ in range(2))  # the last id, the hash of the one before
        self.slots = np.zeros((2, lanes), np.uint32)

    def predict(self, n: int) -> tuple[np.ndarray, ...]:
        """Of the first ``n`` lanes: both orders' ids, the end of order 2's share, the size of order 1's (none if their ids don't differ)."""
        a, slots = self.a[:n], self.slots[:, :n]
        np.add(a * _HASH[0], self.hash[:n], out=slots[0])
        np.multiply(a, _HASH[1], out=slots[1])
        self.hash[:n] = slots[1]
        self.at = self.base[:, :n] + (slots >> _SHIFT)
        self.e = self.entries[self.at]
        self.ids, self.c = self.e >> 3, self.e & 7
        self.differ = self.ids[0] != self.ids[1]
        self.ctx = self.mix[:, :n] + ((self.c[0] << 3 | self.c[1]) << 1 | self.differ)
        self.w = self.weights[self.ctx]
        one = (65536 - self.w[0]) * self.w[1] >> 16
        np.maximum(one, 1, out=one)
        one *= self.differ
        return self.ids, self.w[0], one

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """Learn the next ids, given which orders had them."""
        n = len(ids)
        step = hit * 65505
        step += 31
        step -= self.w
        step >>= _RATE  # weights stay within 31 to 65505
        step[1] *= self.differ & ~hit[0]
        step += self.w
        self.weights[self.ctx] = step
        c = self.c | hit * np.uint32(8)
        e = self.e + _KEPT[c]
        np.copyto(e, ids << 3 | 1, where=c < 2)
        self.entries[self.at] = e
        self.a[:n] = ids


def _due(t: int) -> int:
    """When the table learns again that learnt at ``t`` ids."""
    return t + max(FIRST, t >> 3)


def _lanes(blocks: list[np.ndarray]) -> list[int]:
    """Order of the lanes: long blocks first, so that those still running are the first ones."""
    return sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))


def encode(blocks: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(bits of a plain id, code) of blocks of ids (0 to MAX_ID each)."""
    order = _lanes(blocks)
    sizes = np.array([len(blocks[i]) for i in order])
    lanes, steps = len(blocks), int(sizes[0]) if len(blocks) else 0
    if any(len(b) and not 0 <= b.min() <= b.max() <= MAX_ID for b in blocks):
        raise ValueError(f"ids must be from 0 to {MAX_ID}")
    ids = np.zeros((steps, lanes), np.uint32)
    for k, i in enumerate(order):
        ids[:sizes[k], k] = blocks[i]
    if steps > MOST:
        raise ValueError(f"a block holds at most {MOST} ids")
    wide = ids.max(axis=0, initial=0) > 65535
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 1 << 48, np.uint64)
    words, owners = [], []
    every = np.arange(lanes)

    def emit(lane):
        x = low[lane]
        words.append((x >> _U(32)).astype(np.uint32)), owners.append(lane.astype(np.uint16 if lanes <= 65536 else np.int32))
        low[lane] = (x & _U(0xFFFFFFFF)) << _U(16)

    model, lengths = _Model(lanes), _Lengths(wide)
    table = _Counts(ids) if lanes else None
    t = 0
    while t < steps:  # the ids up to where the table learns again
        more = min(_due(t), steps) - t
        start, freq = np.zeros((2, more, lanes), np.int64)
        miss = np.zeros((more, lanes), bool)
        running = np.searchsorted(-sizes, -np.arange(t, t + more))  # lanes with more ids
        for k, n in enumerate(running.tolist()):
            x = ids[t + k, :n]
            p, two, one = model.predict(n)
            hit = p == x
            other = ~hit[0]
            np.logical_and(other, ~hit[1], out=miss[k, :n])
            own = start[k, :n]
            np.multiply(two, other, out=own)
            own += one * miss[k, :n]
            freq[k, :n] = np.where(other, one, two)
            np.subtract(65536, own, out=freq[k, :n], where=miss[k, :n])
            model.learn(x, hit)
        # up to five shares an id, in order: of the mix, the table, the length, and its plain bits
        missed = np.flatnonzero(miss.ravel())
        lane = missed % lanes
        start2, freq2, known = table.of_ids(lane, table.at[t:t + more].reshape(-1)[missed])
        new, lane = missed[~known], lane[~known]
        x = ids[t:t + more].reshape(-1)[new].astype(np.int64)
        length = _bit_length(x)
        start3, freq3 = lengths.of_ids(lane, length)
        low_bits, high_bits = lengths.plain(length)
        rest = x - (1 << length >> 1)
        far = high_bits > 0
        count = (np.arange(lanes) < running[:, None]).astype(np.int16)
        flat = count.reshape(-1)
        flat[missed] += 1
        flat[new] += 2 + far
        place = np.cumsum(count, axis=0, dtype=np.int32)
        events = int(place[-1].max(initial=0))
        place -= count
        place *= lanes
        place += np.arange(lanes, dtype=np.int32)
        place = place.reshape(-1)
        starts, freqs = np.zeros(events * lanes, np.uint32), np.full(events * lanes, 65536, np.uint32)  # of none: the whole range
        if running[-1] < lanes:
            there = np.flatnonzero(count.reshape(-1))
            starts[place[there]], freqs[place[there]] = start.reshape(-1)[there], freq.reshape(-1)[there]
        else:
            starts[place], freqs[place] = start.reshape(-1), freq.reshape(-1)
        for own, k, s, f in ((missed, 1, start2, freq2), (new, 2, start3, freq3),
                             (new, 3, (rest & 0xFFFF) << (16 - low_bits), 65536 >> low_bits),
                             (new[far], 4, (rest >> 16 << (16 - high_bits))[far], (65536 >> high_bits)[far])):
            at = place[own] + k * lanes
            starts[at], freqs[at] = s, f
        for s, f in zip(starts.reshape(events, lanes), freqs.reshape(events, lanes)):
            size >>= _U(16)
            low += size * s
            size *= f
            small = np.flatnonzero(size < _U(1 << 32))
            if len(small):
                emit(small)
                size[small] <<= _U(16)
        lengths.learn(lane, length)
        t += more
        if t < steps:
            table.add(t)
    for _ in range(3):
        emit(every)
    owner = np.concatenate(owners).astype(np.int32) if lanes else np.zeros(0, np.int32)
    by_lane = np.argsort(owner, kind="stable")
    w = np.concatenate(words)[by_lane].astype(np.int64) if lanes else np.zeros(0, np.int64)
    while (carry := w >> 16).any():  # a lane's first word has none
        w &= 0xFFFF
        w[:-1] += carry[1:]
    ends = np.cumsum(np.bincount(owner, minlength=lanes)).tolist()
    w = w.astype("<u2")
    out: list = [None] * lanes
    for k, i in enumerate(order):
        out[i] = (32 if wide[k] else 16, w[ends[k - 1] if k else 0:ends[k]].tobytes())
    return out


def decode(coded: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    """Ids (uint32) of blocks given as (number of ids, bits of a plain id, code)."""
    order = sorted(range(len(coded)), key=lambda i: -coded[i][0])
    sizes = np.array([coded[i][0] for i in order], np.int64)
    lanes, steps = len(coded), int(sizes[0]) if len(coded) else 0
    wide = np.array([coded[i][1] > 16 for i in order], bool)
    words = np.frombuffer(b"".join(coded[i][2] for i in order), "<u2").astype(np.float64)
    at = np.cumsum([0] + [len(coded[i][2]) // 2 for i in order])[:-1].astype(np.int64)
    words = np.concatenate((words, np.zeros(4)))
    # whole numbers below 2**53, which doubles hold and divide exactly
    value = words[at] * 2.0 ** 32 + words[at + 1] * 65536 + words[at + 2] if lanes else np.zeros(0)
    at += 3
    size = np.full(lanes, 2.0 ** 48)
    ids = np.zeros((steps, lanes), np.uint32)

    def slots(lane):
        r = np.floor(size[lane] * 2.0 ** -16)
        return r, np.minimum(value[lane] / r, 65535).astype(np.int64)

    def take(lane, r, start, freq):
        left, r = value[lane] - r * start, r * freq
        small = np.flatnonzero(r < 2.0 ** 32)
        if len(small):
            own = small if isinstance(lane, slice) else lane[small]
            left[small] = left[small] * 65536 + words[np.minimum(at[own], len(words) - 1)]
            r[small] *= 65536
            at[own] += 1
        value[lane], size[lane] = left, r

    def plain(lane, bits):
        r, slot = slots(lane)
        got = slot >> (16 - bits)
        take(lane, r, got << (16 - bits), 65536 >> bits)
        return got

    model, table, lengths, due = _Model(lanes), _Table(lanes), _Lengths(wide), FIRST
    fresh: list = []
    running = np.searchsorted(-sizes, -np.arange(steps)).tolist()  # lanes with more ids
    for t, n in enumerate(running):
        if t == due:
            table.add(ids[table.t:t])
            if fresh:
                lengths.learn(*map(np.concatenate, zip(*fresh)))
                fresh.clear()
            due = _due(t)
        x = ids[t, :n]
        p, two, one = model.predict(n)
        r, slot = slots(slice(0, n))
        other, rest = slot >= two, two + one
        miss = slot >= rest
        start = two * other + one * miss
        take(slice(0, n), r, start, np.where(miss, 65536 - rest, np.where(other, one, two)))
        x[:] = np.where(other, p[1], p[0])
        lane = np.flatnonzero(miss)
        if len(lane):
            r, slot = slots(lane)
            start, freq, known, found = table.of_slots(lane, slot)
            take(lane, r, start, freq)
            x[lane] = found
            lane = lane[~known]
            if len(lane):
                r, slot = slots(lane)
                start, freq, length = lengths.of_slots(lane, slot)
                take(lane, r, start, freq)
                fresh.append((lane, length))
                low_bits, high_bits = lengths.plain(length)
                got = (1 << length >> 1) + plain(lane, low_bits)
                far = np.flatnonzero(high_bits)
                if len(far):
                    got[far] += plain(lane[far], high_bits[far]) << 16
                x[lane] = got
        model.learn(x, p == x)
    out: list = [None] * lanes
    for k, i in enumerate(order):
        out[i] = ids[:sizes[k], k].copy()
    return out


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo crc32's, bits reversed (bit 31 is the power 0)."""
    out = 0
    for k in range(32):
        if b >> (31 - k) & 1:
            out ^= a
        a = a >> 1 ^ (0xEDB88320 if a & 1 else 0)
    return out


def crc32_join(first: int, second: int, n_bytes: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the length of the second."""
    power, square, bits = 1 << 31, 1 << 30, 8 * n_bytes
    while bits:
        if bits & 1:
            power = _times(power, square)
        square, bits = _times(square, square), bits >> 1
    return _times(first, power) ^ second
