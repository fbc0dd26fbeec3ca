"""Bit predictors over hashed contexts, mixed by gated logistic weights and refined by an adaptive map.

A piece is a byte that isn't coded, and bytes that are: all of a text and an
end.  They are coded bit by bit.  The contexts are the last 1, 2, 3, 4 and 6
bytes, and the word so far with the white space after it, or, at the first
byte of a word, all of the word before; so contexts reach across white space.
Each context, with the bits of the current byte so far, is hashed to a slot
that holds how often a 0 and a 1 followed in training.  The logarithms of the
odds are summed with weights that a gate selects (place in the word, bit, and how
often the word's context has been seen); weights are learned online, by
gradient steps on coding cost.  At last a table
(previous byte, mixed odds) says what odds really meant, and both are averaged.

Every bit only depends on bytes before it, and those are known beforehand, so
many places are walked at once.  What a byte costs, and what is learned from
it, depends on its contexts only: among every STEP bytes, places with equal
contexts and bytes are found by sorting and dealt with once, as often as they
came.  Counting needs no places at all: a sort by the nearest bytes lays equal
contexts of every order side by side, each with the byte that followed, and
each is counted once.  Elsewhere, what contexts say is looked up once for
neighbours that share them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ORDERS = (1, 2, 3, 4, 6)
INPUTS = len(ORDERS) + 1
BITS = 20
SLOTS = 1 << BITS
#: Added to both counts of a slot; places and levels of trust that gates tell apart; places of a text walked at once.
PRIOR, PLACES, LEVELS, WINDOW = 0.3, 4, 4, 1 << 16
GATES = PLACES * 8 * LEVELS
#: Learning: rate, and distinct places of a step; one pass, whatever the size of the corpus.
RATE, LEARNED = 0.5, 4096
#: Bytes among which equal places are dealt with as one; distinct places walked at once elsewhere.
STEP, WALKED = 1 << 22, 1 << 14
#: Steps of learning for which what tables have is looked up at once.
TOGETHER = 16
#: Bits of the number of a place among them.
_LOW = 22
#: What costs are multiples of.
UNIT = 2.0**-30
#: Steps of the refining map, and how many observations its first guess is worth.
STEPS, GUESS = 33, 40.0
#: What lies before a piece; no UTF-8 text has that byte.
EDGE = 0xFF
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_R = 0xD6E8FEB86659FD93
_FREE = np.uint64((1 << 64) - 256)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32, EDGE]] = True
#: By byte, for its bits from the highest: the bits before in that half of the byte, after a one; the bit.
_NODES = np.array([[(16 | v) >> (4 - j) for v in half] for half in ([b >> 4 for b in range(256)], [b & 15 for b in range(256)]) for j in range(4)], np.int64)
_ONES = np.array([[b >> j & 1 for b in range(256)] for j in range(7, -1, -1)], np.uint8)
#: The same with the bits of a byte side by side; by place in the word, the gates of its bits.
_NODES_OF, _ONES_OF = np.ascontiguousarray(_NODES.T), np.ascontiguousarray(_ONES.T)
_GATES_OF = (np.arange(PLACES)[:, None] * 8 + np.arange(7, -1, -1)) * LEVELS
_ZEROS_OF = 1 - _ONES_OF.astype(np.float32)
#: The same as bits, each beyond a slot's: where tables have the slots for ones after those for zeros.
_NODES_BY_BIT = _NODES_OF + _ONES_OF * np.int64(SLOTS)
_NODES_BY_COUNT = _NODES_OF + _ONES_OF * np.int64(INPUTS * SLOTS)
#: By place in the word and half of a byte, where its rows of weights begin; gates of a half's bits by place, half and levels.
_HALVES = (np.arange(PLACES)[:, None] * 2 + np.arange(2)) * LEVELS**4
_PATTERN = (_GATES_OF.reshape(PLACES, 2, 1, 4) + (np.arange(LEVELS**4)[:, None] >> 2 * np.arange(4) & 3)).reshape(-1, 4)
#: Inputs whose contexts neighbours share even where places are scattered.
SHORT = 4
_HERE = np.arange(WINDOW)
_MIX = [np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for k in range(INPUTS)]


with np.errstate(over="ignore"):
    #: By byte, what its first half adds to the hash for the second.
    _HALF = ((np.arange(256, dtype=np.uint64) >> np.uint64(4)) + np.uint64(1)) * _B


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


#: Powers of an odd number and of its inverse modulo 2^64: hashes of all spans of a window come from one running sum.
_POWER, _BACK = _powers(_R, WINDOW), _powers(pow(_R, -1, 1 << 64), WINDOW)


class Window:
    """Places that are coded of some bytes: for each its piece, byte, byte before, place in the word, last bytes and word.

    Places may stand for several equal ones; times says for how many.
    """

    def __init__(self, piece: np.ndarray, byte: np.ndarray, place: np.ndarray, last: np.ndarray, word: np.ndarray, times: np.ndarray | None = None):
        self.piece, self.byte, self.place, self.last, self.word, self.times = piece, byte, place, last, word, times
        #: Bytes that were looked at for them.
        self.size = len(piece)

    @property
    def before(self) -> np.ndarray:
        return (self.last & np.uint64(255)).astype(np.int64)

    @property
    def hashes(self) -> list[np.ndarray]:
        """Hashes of the contexts."""
        return [_hash(self.last & np.uint64((1 << 8 * ORDERS[k]) - 1) if k < len(ORDERS) else self.word.copy(), k) for k in range(INPUTS)]

    def parts(self, size: int, scattered: bool = False) -> Iterator[Window]:
        """About size places at a time: neighbours, or scattered over all of them."""
        n = -(-len(self.byte) // size)
        for i in range(n):
            at = slice(i, None, n) if scattered else slice(i * size, (i + 1) * size)
            yield Window(self.piece[at], self.byte[at], self.place[at], self.last[at], self.word[at], self.times[at])

    def walk(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(gate without trust, bit, slots by input), each for all bits (highest first) of all places."""
        return _GATES_OF.take(self.place, axis=0).T, _ONES_OF.take(self.byte, axis=0).T, [_slots(h, self.byte, _NODES_OF).T for h in self.hashes]

    def odds(self, tables: np.ndarray, trust: np.ndarray, nodes: np.ndarray, shared: int, order: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """(what the table of each input has for all bits of a place, levels of the last input), places going first, in the order asked for.

        nodes: bits as they are counted into slots.  Neighbours that share a context and their byte share a look, for
        the first so many inputs.
        """
        x = []
        change = self.byte[1:] != self.byte[:-1]
        byte, last, word = (c if order is None else c.take(order) for c in (self.byte, self.last, self.word))
        for k in range(INPUTS):
            if k >= shared:
                slots = _slots(_hash(last & np.uint64((1 << 8 * ORDERS[k]) - 1) if k < len(ORDERS) else word.copy(), k), byte, nodes)
                x.append(tables[k].take(slots))
                continue
            context = self.last & np.uint64((1 << 8 * ORDERS[k]) - 1) if k < len(ORDERS) else self.word
            begin = np.concatenate([[True], change | (context[1:] != context[:-1])])
            at = np.flatnonzero(begin)
            slots = _slots(_hash(context.take(at), k), self.byte.take(at), nodes)
            run = np.cumsum(begin) - 1
            run = run if order is None else run.take(order)
            x.append(tables[k].take(slots).take(run, axis=0))
        levels = trust.take(slots)
        return x, levels if shared < INPUTS else levels.take(run, axis=0)


def _hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of contexts of an input, in place of these; the lowest byte is left free for the byte that follows."""
    with np.errstate(over="ignore"):
        h += _MIX[k]
        h *= _A
        h ^= h >> np.uint64(29)
        h *= _B
        h ^= h >> np.uint64(32)
        h &= _FREE
    return h


def _slots(h: np.ndarray, byte: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Slots of the eight bits of each byte after contexts of these hashes.

    A context has a hash for either half of the byte; the bits of a half are told apart in its last four bits, so
    their slots lie side by side in memory.
    """
    halves = np.empty((len(h), 2), np.uint64)
    with np.errstate(over="ignore"):
        np.right_shift(h, np.uint64(64 - BITS), out=halves[:, 0])
        g = _HALF.take(byte)
        g += h
        g *= _C
        g ^= g >> np.uint64(31)
        g *= _A
        np.right_shift(g, np.uint64(64 - BITS), out=halves[:, 1])
    out = nodes.take(byte, axis=0)
    out ^= np.repeat(halves.view(np.int64).ravel(), 4).reshape(-1, 8)
    return out


def windows(pieces: list[bytes], size: int = WINDOW) -> Iterator[Window]:
    """All coded places of the pieces, about `size` at a time; a long piece goes on in the next window with its contexts whole."""
    pad = bytes([EDGE]) * max(ORDERS)
    raw = np.frombuffer(pad + b"".join(pad[1:] + p for p in pieces) + bytes(8), np.uint8)
    lead, length = len(pad), np.array([len(p) + len(pad) - 1 for p in pieces], np.int64)
    ends = lead + np.cumsum(length)
    first = ends - length
    # the hash and the length of the word that reaches into the window
    carry, reach, was_space = 0, 0, True
    stop = len(raw) - 8
    with np.errstate(over="ignore"):
        for at in range(lead, stop, size):
            part = raw[at - lead : min(at + size, stop)]
            n = len(part) - lead
            own = part[lead:].astype(np.uint64)
            here = _HERE[:n]
            low, high = np.searchsorted(ends, (at, at + n - 1), side="right")
            within = np.minimum(ends[low : high + 1], at + n) - np.maximum(first[low : high + 1], at)
            piece = np.repeat(np.arange(low, high + 1, dtype=np.int32), within)
            space = _SPACE.take(part)
            space[lead - 1] = was_space
            # words begin after white space; so does each piece, with the bytes before it
            starts = ~space[lead:] & space[lead - 1 : -1]
            begun = first[low : high + 1] - at
            starts[begun[begun >= 0]] = True
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((own + np.uint64(1)) * _POWER[:n], out=total[1:])
            since = np.empty(n, np.int64)
            since[0] = -1
            np.maximum.accumulate(np.where(starts[:-1], here[:-1], -1), out=since[1:])
            word = total[:-1] - total.take(since, mode="clip")
            word *= _BACK.take(since, mode="clip")
            dist = here - since
            into = int(np.searchsorted(since, 0))
            if into:
                word[:into] = np.uint64(carry) + np.uint64(pow(_R, reach, 1 << 64)) * total[:into]
                dist[:into] = here[:into] + reach
            place = np.where(space[lead - 1 : -1], 0, np.minimum(dist, PLACES - 1)).astype(np.uint8)
            # one byte at the end of the pads isn't coded either
            coded = np.ones(n, bool)
            skipped = (begun[:, None] + np.arange(lead)).ravel()
            coded[skipped[(skipped >= 0) & (skipped < n)]] = False
            last = int(np.flatnonzero(starts)[-1]) if starts.any() else -1
            if last >= 0:
                carry, reach = int((total[n] - total[last]) * _BACK[last]), n - last
            else:
                carry, reach = (carry + pow(_R, reach, 1 << 64) * int(total[n])) % (1 << 64), reach + n
            was_space = bool(space[-1])
            # the bytes before a place, the nearest in the lowest bits
            context = np.ndarray((n,), "<u8", raw, at - lead, (1,)).byteswap() >> np.uint64(8 * (8 - lead))
            word ^= dist.view(np.uint64) << np.uint64(48)
            w = Window(piece[coded], part[lead:][coded], place[coded], context[coded], word[coded])
            w.size = n
            yield w


def _keys(w: Window, back: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of contexts and byte, what places are sorted by).

    The latter has five bits of the byte before, of the byte and of so many bytes before that, so that equal contexts are
    neighbours and slots are met in few places at a time, then as many as go below those of a hash of the contexts and the
    byte, above 22 that are free.  With five bytes, contexts of every length are neighbours, those of short words too.
    """
    with np.errstate(over="ignore"):
        key = w.last * _A
        key ^= key >> np.uint64(32)
        key += w.word
        key *= _B
        key ^= key >> np.uint64(29)
        key *= _C
        key += w.byte
        key *= _A
        key ^= key >> np.uint64(32)
        order = w.last & np.uint64(31)
        order <<= np.uint64(5)
        order |= w.byte & np.uint8(31)
        for i in range(1, back + 1):
            order <<= np.uint64(5)
            order |= w.last >> np.uint64(8 * i) & np.uint64(31)
        rest = 64 - _LOW - 5 * (back + 2)
        order <<= np.uint64(rest)
        order |= key >> np.uint64(64 - rest)
        order <<= np.uint64(_LOW)
    return key, order


def _distinct(piece: np.ndarray, near: np.ndarray, word: np.ndarray, key: np.ndarray, order: np.ndarray, times: np.ndarray, each: bool) -> tuple[Window, np.ndarray | None, np.ndarray]:
    n = len(key)
    order |= np.arange(n, dtype=np.uint64)
    order.sort()
    order &= np.uint64((1 << _LOW) - 1)
    order = order.view(np.int64)
    # where places that differ agree in what they are sorted by, equal ones may come in several runs
    begin = np.ones(n, bool)
    for i in range(0, n, WINDOW):
        k = key.take(order[i : i + WINDOW + 1])
        np.not_equal(k[1:], k[:-1], out=begin[i + 1 : i + len(k)])
    begins = np.flatnonzero(begin)
    number = np.diff(begins, append=n)
    once = bool((times == 1).all())
    pieces = piece.take(order) if each or not once else None
    weight = number.astype(np.float32) if once or not n else np.add.reduceat(times.take(pieces), begins).astype(np.float32)
    at = order.take(begins)
    last = near.take(at)
    byte, place = (last >> np.uint64(48)).astype(np.uint8), (last >> np.uint64(56)).astype(np.uint8)
    last &= np.uint64((1 << 48) - 1)
    return Window(piece.take(at), byte, place, last, word.take(at), weight), pieces, number


def distinct(pieces: list[bytes], times: np.ndarray | None = None, each: bool = False) -> Iterator[tuple[Window, np.ndarray | None, np.ndarray]]:
    """Of every STEP bytes, places with equal contexts and bytes as one, how many there are of each, and, with `each`, the pieces of all in that order."""
    times = np.ones(len(pieces)) if times is None else times
    # what costs come to doesn't depend on the order of places; what is learnt does, and scattered ones don't share long contexts
    back = 5 if each else 3
    most = min(STEP, sum(map(len, pieces)) + max(ORDERS) * len(pieces))
    held = [np.empty(most, kind) for kind in (np.int32, np.uint64, np.uint64, np.uint64, np.uint64)]
    n = size = 0
    for w in windows(pieces):
        for column, part in zip(held, (w.piece, w.last, w.word, *_keys(w, back)), strict=True):
            column[n : n + len(part)] = part
        # byte and place lie above the last bytes
        held[1][n : n + len(w.piece)] |= (w.place.astype(np.uint64) << np.uint64(8) | w.byte) << np.uint64(48)
        n, size = n + len(w.piece), size + w.size
        if size >= STEP:
            yield _distinct(*(c[:n] for c in held), times, each)
            n = size = 0
    if size:
        yield _distinct(*(c[:n] for c in held), times, each)


def _add(sorted_: np.ndarray, shift: int, k: int, times: float, flat: np.ndarray, hashes) -> None:
    """Add runs of values that are equal but for their lowest bits; hashes(values): the hashes of their contexts, and their bytes."""
    top = sorted_ >> np.uint64(shift) if shift else sorted_
    begins = np.concatenate([[0], np.flatnonzero(top[1:] != top[:-1]) + 1])
    number = np.diff(begins, append=len(sorted_)) * times
    own = flat[k * SLOTS :]
    for i in range(0, len(begins), WALKED):
        h, byte = hashes(sorted_.take(begins[i : i + WALKED]))
        at = _slots(h, byte, _NODES_BY_COUNT)
        np.add.at(own, at.ravel(), np.repeat(number[i : i + WALKED].astype(np.float32), 8))


def _nearest(order: int, k: int):
    """Hashes of contexts of an order, and bytes, from values of the byte before, the byte, and the bytes before that."""

    def hashes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        byte = (v >> np.uint64(40)).astype(np.uint8)
        context = v >> np.uint64(48)
        for back in range(1, order):
            context |= (v >> np.uint64(8 * (5 - back)) & np.uint64(255)) << np.uint64(8 * back)
        return _hash(context, k), byte

    return hashes


def _of_words(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return v & _FREE, (v & np.uint64(255)).astype(np.uint8)


def count(pieces: list[bytes], times: np.ndarray, counts: np.ndarray) -> None:
    """Add what the pieces say to counts, of shape (2, INPUTS, SLOTS)."""
    flat = counts.reshape(-1)
    for t in np.unique(times):
        own = [p for p, x in zip(pieces, times, strict=True) if x == t]
        most = min(STEP + WINDOW, sum(map(len, own)) + max(ORDERS) * len(own))
        near, words = np.empty((2, most), np.uint64)
        n = size = 0

        def add(near: np.ndarray, words: np.ndarray, t: float = float(t)) -> None:
            near.sort()
            for k, order in enumerate(ORDERS):
                _add(near, 8 * (6 - order), k, t, flat, _nearest(order, k))
            words.sort()
            _add(words, 0, INPUTS - 1, t, flat, _of_words)

        for w in windows(own):
            m = len(w.piece)
            # the byte before, the byte, the five bytes before that, the nearest first
            v = w.last.byteswap()
            v = (v & np.uint64(255 << 56)) >> np.uint64(8) | (v & np.uint64((1 << 56) - 1)) >> np.uint64(16)
            v |= w.byte.astype(np.uint64) << np.uint64(40)
            near[n : n + m] = v
            np.bitwise_or(_hash(w.word.copy(), INPUTS - 1), w.byte, out=words[n : n + m])
            n, size = n + m, size + w.size
            if size >= STEP:
                add(near[:n], words[:n])
                n = size = 0
        if n:
            add(near[:n], words[:n])


def level(seen: np.ndarray) -> np.ndarray:
    """How far a context is to be trusted: never seen, seen once or twice, a few times, often."""
    return (seen > 0.5).astype(np.uint8) + (seen > 2.5) + (seen > 15.5)


def odds(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the odds of a 1 in every slot, and the level of the longest context's slots."""
    return (np.log(counts[1] + PRIOR) - np.log(counts[0] + PRIOR)).astype(np.float32), level(counts[0, -1] + counts[1, -1])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def without_own(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds in every slot, of shape (INPUTS, 2 * SLOTS), and levels of the longest context's, as they were without one 0, then without one 1."""
    x = np.empty((INPUTS, 2, SLOTS), np.float32)
    for k in range(INPUTS):
        zero, one = counts[0, k], counts[1, k]
        x[k, 0] = np.log((one + np.float32(PRIOR)) / (np.maximum(zero - 1, 0) + np.float32(PRIOR)))
        x[k, 1] = np.log((np.maximum(one - 1, 0) + np.float32(PRIOR)) / (zero + np.float32(PRIOR)))
    zero, one = counts[0, -1], counts[1, -1]
    return x.reshape(INPUTS, 2 * SLOTS), np.concatenate([level(np.maximum(zero - 1, 0) + one), level(zero + np.maximum(one - 1, 0))])


def first_weights() -> np.ndarray:
    return np.full((GATES, INPUTS), 1.5 / INPUTS, np.float32)


def step_of(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 2) + STEPS // 2, 0, STEPS - 1).astype(np.int64)


def _by_pattern(weights: np.ndarray) -> list[np.ndarray]:
    """Weights of each input for half a byte: rows by place in the word, half and the levels of its four bits."""
    return [np.ascontiguousarray(weights[:, k]).take(_PATTERN) for k in range(INPUTS)]


def _mixed(x: list[np.ndarray], place: np.ndarray, levels: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Sums of what inputs say, with the weights of the gates; rows: _by_pattern(weights)."""
    four = levels.view("<u4")
    at = (four | four >> 6 | four >> 12 | four >> 18) & 255
    at = (at + _HALVES.take(place, axis=0)).ravel()
    z = rows[0].take(at, axis=0).reshape(levels.shape)
    z *= x[0]
    for k in range(1, INPUTS):
        part = rows[k].take(at, axis=0).reshape(levels.shape)
        part *= x[k]
        z += part
    return z


def learn(pieces: list[bytes], times: np.ndarray, counts: np.ndarray | None, weights: np.ndarray, seen: np.ndarray, own: tuple[np.ndarray, np.ndarray] | None = None) -> None:
    """One online pass over all places: weights move with every LEARNED distinct ones, each as often as it came.

    It also adds to seen, of shape (2, 256 * STEPS), how often bits and ones came with each byte before and
    step of mixed odds, as they were before the weights moved.  own: without_own(counts), where that is known; counts
    aren't asked for then.
    """
    odd, trust = own or without_own(counts)
    # what was unpickled has a type of its own, and adding in place is several times slower with that
    odd, trust = odd.view(np.float32), trust.view(np.uint8)
    for found, _, _ in distinct(pieces, times):
        # what many steps need is looked up at once, as neighbours; a step's places are scattered over all
        for many in found.parts(LEARNED * TOGETHER, scattered=True):
            steps = -(-len(many.byte) // LEARNED)
            order = np.concatenate([np.arange(i, len(many.byte), steps) for i in range(steps)])
            every, levels = many.odds(odd, trust, _NODES_BY_BIT, SHORT, order)
            places = many.place.take(order)
            byte, before, often = many.byte.take(order), many.before.take(order) * STEPS, many.times.take(order)
            end = 0
            for i in range(steps):
                begin, end = end, end + len(range(i, len(order), steps))
                at = slice(begin, end)
                x, y = [e[at] for e in every], _ONES_OF.take(byte[at], axis=0)
                t = np.repeat(often[at], 8).astype(np.float64)
                z = _mixed(x, places[at], levels[at], _by_pattern(weights))
                error = y - sigmoid(z)
                error *= often[at][:, None]
                # gates tell bits apart, so that those of a place don't wait for each other
                cells = (_GATES_OF.take(places[at], axis=0) + levels[at]).ravel()
                total = np.full(GATES, 50.0)
                np.add.at(total, cells, t)
                moves = np.zeros((INPUTS, GATES), np.float32)
                for k in range(INPUTS):
                    np.add.at(moves[k], cells, (x[k] * error).ravel())
                weights += (RATE * moves / total).T
                cell = step_of(z).ravel()
                cell += np.repeat(before[at], 8)
                np.add.at(seen[0], cell, t)
                t *= y.ravel()
                np.add.at(seen[1], cell, t)


def refining(seen: np.ndarray) -> np.ndarray:
    guess = np.tile(sigmoid((np.arange(STEPS) - STEPS // 2) / 2), 256)
    return ((seen[1] + GUESS * guess) / (seen[0] + GUESS)).astype(np.float32)


def cost(pieces: list[bytes], table: np.ndarray, trust: np.ndarray, weights: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """log10 of the probability of each piece; the same for equal pieces, whatever lies beside them."""
    out = np.zeros(len(pieces))
    rows = _by_pattern(weights.astype(np.float32))
    for found, piece, number in distinct(pieces, each=True):
        costs = []
        for w in found.parts(WALKED):
            x, levels = w.odds(table, trust, _NODES_OF, INPUTS)
            z = _mixed(x, w.place, levels, rows)
            cell = step_of(z).ravel()
            cell += np.repeat(w.before * STEPS, 8)
            p = sigmoid(z)
            p += refine.take(cell).reshape(p.shape)
            p *= np.float32(0.5)
            np.clip(p, np.float32(1e-7), np.float32(1 - 1e-7), out=p)
            # of a zero, what is left of one
            p -= _ZEROS_OF.take(w.byte, axis=0)
            p = np.abs(p, out=p).ravel()
            # products of four don't leave the range of float32
            p = p[0::2] * p[1::2]
            p = np.log(p[0::2] * p[1::2])
            costs.append(p[0::2] + p[1::2])
        # in units of which float64 sums are exact, so that their order doesn't matter
        each = np.rint(np.concatenate(costs) * (np.log10(np.e) / UNIT)) * UNIT
        out += np.bincount(piece, np.repeat(each, number), minlength=len(pieces))
    return out
