"""Adaptive context-mixing range coder for token ids; many blocks are coded at once, in step.

Each block is coded on its own from a reset model. The ids of a block are numbered as they are first met, and the coder
works on these numbers; the next free number stands for an id not met before. Order 0 is the distribution of the
numbers so far: counts of what came, one for a number met since the counts were last taken up, and a part for a new
id that follows the share of new ids in the last stretch. Counts are taken up after stretches that grow with the block.
Orders 1 and 2 predict the number that followed the last one and the last two when they were met last; the
predictions sit with a confidence in small hashed tables of the block. For every id the three are mixed by weights into
one distribution, and the mixture drives the range coder.

The new ids of a block follow its numbers in the same coder: each one's class (length in bits and the bit below the
highest) under an adaptive distribution of the block's new ids, then its other bits. So any id below 65536 can be coded.

A weight of order 1 or 2 moves towards the share of ids at which the order was right and no higher order was; weights
are kept for each confidence of both predictions, and whether they agree.

The coder has 64-bit bounds and moves 32 bits at a time; a carry is added to the words before it. All blocks of a batch
take a step together as numpy arrays, so Python's cost per step is shared by all blocks; what the encoder knows
beforehand it computes for a whole stretch at once. Every step uses whole numbers only and gives the same bytes on every
machine.

A coded block is the words of the range coder, 32 bits each, little-endian.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_TOKENS = 2048
# ids must be below this, and a block may not hold more of them
ID_SPACE = 1 << 16
IDS, WORDS = np.dtype("<u4"), np.dtype("<u4")

_LOW_RANGE = np.uint64(1 << 32)
_WORD = np.uint64(32)
_LOWER = np.uint64(0xFFFFFFFF)
_WIDEST = np.uint64(0xFFFFFFFFFFFFFFFF)

# a mixture has 2**_SCALE parts; weights are parts of 65536
_SCALE = np.uint64(24)
_TOTAL = 1 << 24
_LAST_PLACE = np.uint64(_TOTAL - 1)
# counts are taken up after so many ids at least, and a part of those before
_STRETCH, _GROWTH = 16, 2
_HASHED = 2048
_HASHED_MASK, _TOP_BITS = np.uint32(_HASHED - 1), np.uint32(21)
_MIX, _MIX_AGAIN = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)

# A state's two weights share one number: order 2 in the lower 16 bits, order 1 above; order 0 has what is left, a part
# in 64 at least. A weight loses a part in 32 of itself, and gains _GAIN when its order was right and no higher one was.
# A state is the confidence of order 2 times 4 plus that of order 1, and 16 more if both predict one number. No
# confidence is no prediction.
_STATES = 32
_GAIN = 2016
# by right orders (order 2 is the lower bit)
_GAINS = np.array([0, _GAIN, _GAIN << 16, _GAIN], dtype=np.uint32)
_LOSSES = 0x07FF07FF
_START = np.array([0, 12000, 24000, 30000])
_CODES = np.arange(_STATES) & 15
_STARTS = (_START[_CODES >> 2] + (_START[_CODES & 3] << 16)).astype(np.uint32)

# classes of new ids, and what one that came adds to their cumulative table, which learns for so many ids
_CLASSES = 32
_CLASS = np.arange(_CLASSES)
_FREE_BITS = np.maximum((_CLASS >> 1) - 1, 0).astype(np.uint64)
_CLASS_BEGINS = np.where(_CLASS < 2, _CLASS, (2 + (_CLASS & 1)) << np.maximum((_CLASS >> 1) - 1, 0))
_EDGES = np.arange(_CLASSES + 1, dtype=np.int16)[:, None]
_ONCE, _LEARNED = np.int16(4), 8000


_STRIP = 32


def _stretches(steps: int) -> Iterator[tuple[int, int]]:
    begin = 0
    while begin < steps:
        end = min(steps, begin + max(_STRETCH, begin // _GROWTH))
        yield begin, end
        begin = end


def _number_type(steps: int) -> np.dtype:
    """A type for numbers of a block times 4, and for places of its counts."""
    return np.dtype(np.int16 if steps < 1 << 13 else np.int32)


class _Counts:
    """Order 0: where each number's part begins, by number and block; the parts of a block are in order of the numbers.

    The numbers that can be added in a stretch have a place each from its beginning on; the first of them that is not
    in use stands for a new id.
    """

    def __init__(self, lanes: int, steps: int):
        self._type = _number_type(steps)
        self._lanes, self.lane = lanes, np.arange(lanes)
        # numbers in use, and those in use when the counts were taken up
        self.used = np.zeros(lanes, dtype=np.int32)
        self._known = self.used.astype(np.int64)
        # the part of a new id
        self.new = np.full(lanes, _STRETCH, dtype=np.int32)
        self._counts = np.zeros((0, lanes), dtype=self._type)

    def take_up(self, before: int, room: int) -> None:
        """Take up the counts of the last stretch; ``before`` ids have come, and ``room`` numbers may be added."""
        used = self.used.astype(np.int64)
        n = int(used.max())
        counts = np.zeros((n + room + 2, self._lanes), dtype=self._type)
        if before:
            counts[:n] = self._counts[:n]
            self.new = np.maximum((used - self._known) * before // self._room, 1).astype(np.int32)
        self._counts, self._flat, self._known, self._room = counts, counts.reshape(-1), used, room
        # a number that may be added has a place
        steps = np.maximum(counts, 1)
        edges = np.zeros_like(counts)
        for k in range(len(counts) - 1):
            np.add(edges[k], steps[k], out=edges[k + 1])
        self.edges = edges.reshape(-1)

    def count(self, places: np.ndarray) -> None:
        """Count numbers, one of each block, given their places."""
        counts = self._flat.take(places, mode="clip")
        counts += 1
        self._flat[places] = counts

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """Where the edges have the beginnings of numbers; those of the next numbers are a row further."""
        places = np.multiply(numbers, self._lanes, dtype=np.int64)
        places += self.lane
        return places

    def numbers(self, before: int, room: int) -> np.ndarray:
        """The number at each place of the counts of each block."""
        held = np.empty((self._lanes, before + room + 1), dtype=self._type)
        n = int(self._known.max())
        counts = self._counts[:n].T.reshape(-1)
        known = np.tile(np.arange(n, dtype=self._type), self._lanes)
        held[:, :before] = np.repeat(known, counts).reshape(self._lanes, before)
        held[:, before:] = self.used[:, None] + np.arange(room + 1, dtype=np.int32)
        return held


class _Orders:
    """Predictions and weights of all blocks of a batch; two rows stand for order 2 and order 1."""

    def __init__(self, lanes: int, steps: int):
        lane = np.arange(lanes)
        # entries are number * 4 + confidence: those of order 2 by block, then those of order 1 by place, as low numbers
        # are met most
        self._entries = np.zeros(lanes * 2 * _HASHED, dtype=_number_type(steps))
        self._first, self._lanes = np.stack([lane * _HASHED, lane + lanes * _HASHED]), lanes
        self._places = self._first.copy()
        self._weights = np.repeat(_STARTS, lanes)
        self._lane = lane
        self._spread = np.zeros(lanes, dtype=np.uint32)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """What the orders predict, and the weights of the state."""
        self._entry = self._entries.take(self._places, mode="clip")
        predicted = self._entry >> 2
        self._sure = self._entry & 3
        states = self._sure[0] << 2
        states |= self._sure[1]
        states |= (predicted[0] == predicted[1]).view(np.int8) << 4
        states = states.astype(np.int64)
        states *= self._lanes
        states += self._lane
        self._state = states
        self._weight = self._weights.take(states, mode="clip")
        return predicted, self._weight

    def learn(self, numbers: np.ndarray, same: np.ndarray) -> None:
        """Weights move, predictions are confirmed or replaced, and the next ones are looked for.

        ``same`` tells where the predictions are the numbers that came.
        """
        sure, entry = self._sure, self._entry
        right = sure > 0
        right &= same
        stays = sure > 1
        stays |= right
        right = right.view(np.int8)
        came = right[1] << 1
        came |= right[0]
        weight = self._weight
        kept = weight >> 5
        kept &= _LOSSES
        np.subtract(weight, kept, out=kept)
        kept += _GAINS.take(came, mode="clip")
        self._weights[self._state] = kept
        # a right one gains confidence, up to 3; a wrong one loses it, or is replaced when it has one or none
        right <<= 1
        right -= 1
        held = entry + right
        entry |= 3
        np.minimum(held, entry, out=held)
        fresh = numbers << 2
        fresh += 1
        self._entries[self._places.reshape(-1)] = np.where(stays, held, fresh).reshape(-1)
        spread = numbers.astype(np.uint32)
        low = spread & _HASHED_MASK
        np.multiply(low, self._lanes, out=self._places[1], dtype=np.int64)
        spread *= _MIX
        hashed = spread ^ self._spread
        hashed >>= _TOP_BITS
        np.add(self._first[0], hashed, out=self._places[0])
        self._places[1] += self._first[1]
        spread *= _MIX_AGAIN
        self._spread = spread


class _NewIds:
    """Distributions of the classes of new ids, by block."""

    def __init__(self, lanes: int):
        self._tables = np.repeat(_EDGES, lanes, axis=1)
        self._flat, self._lanes, self._lane = self._tables.reshape(-1), lanes, np.arange(lanes)
        self.total, self._times = _CLASSES, 0

    def at(self, places: np.ndarray) -> np.ndarray:
        """The class at each of the places of the first lanes."""
        ended = self._tables[1:, : len(places)] <= places
        return ended.view(np.uint8).sum(axis=0, dtype=np.uint8)

    def find(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where classes begin, and their parts."""
        at = classes * self._lanes
        at += self._lane[: len(classes)]
        begin = self._flat.take(at, mode="clip")
        at += self._lanes
        return begin.astype(np.uint64), (self._flat.take(at, mode="clip") - begin).astype(np.uint64)

    def learn(self, classes: np.ndarray) -> None:
        self._times += 1
        if self._times <= _LEARNED:
            after = (_EDGES > classes.astype(np.int16)).view(np.int8) * _ONCE
            self._tables[:, : len(classes)] += after
            self.total += int(_ONCE)


def _shares(weights: np.ndarray) -> np.ndarray:
    """The parts of the mixture that predictions of order 2 and order 1 add."""
    shares = np.empty((2, *weights.shape), dtype=np.uint32)
    np.bitwise_and(weights, 0xFFFF, out=shares[0])
    np.right_shift(weights, 16, out=shares[1])
    shares <<= 8
    return shares.view(np.int32)


def _quotient(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Whole quotients; exact, as both numbers are far below 2**53."""
    return (part / whole).astype(np.int32)


def _turned(table: np.ndarray) -> np.ndarray:
    """The transposed table, made in strips that stay in the processor's cache."""
    turned = np.empty(table.shape[::-1], dtype=table.dtype)
    for at in range(0, len(table), _STRIP):
        turned[:, at : at + _STRIP] = table[at : at + _STRIP].T
    return turned


def _most_first(n_new: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Lanes, those with most new ids first, and how many have a first one, a second one, and so on."""
    order = np.argsort(-n_new, kind="stable")
    most = int(n_new[order[0]])
    return order, (len(n_new) - np.cumsum(np.bincount(n_new, minlength=most + 1)))[:most].tolist()


def encoded(ids: np.ndarray, block_ids: int = BLOCK_TOKENS) -> list[bytes]:
    """The coded bytes of each block of ids; the last block may be shorter."""
    if not len(ids):
        return []
    if ids.max() >= ID_SPACE:
        raise ValueError(f"ids must be below {ID_SPACE}")
    lanes = -(-len(ids) // block_ids)
    last = len(ids) - (lanes - 1) * block_ids
    steps = block_ids if lanes > 1 else last
    if steps > ID_SPACE:
        raise ValueError(f"a block has at most {ID_SPACE} ids")
    numbers, new = np.zeros((lanes, steps), dtype=_number_type(steps)), np.zeros((lanes, steps), dtype=bool)
    at = np.arange(steps, dtype=numbers.dtype)
    first_places, number, backwards = np.zeros(ID_SPACE, dtype=at.dtype), np.zeros_like(at), at[::-1].copy()
    for lane in range(lanes):
        some = ids[lane * block_ids : (lane + 1) * block_ids].astype(np.int64)
        n = len(some)
        first_places[some[::-1]] = backwards[steps - n :]
        first = first_places.take(some, mode="clip")
        came = np.equal(first, at[:n], out=new[lane, :n]).nonzero()[0]
        number[came] = at[: len(came)]
        number.take(first, out=numbers[lane, :n], mode="clip")
    found = ids[np.flatnonzero(new.reshape(-1)[: len(ids)])].astype(np.int64)
    n_new = np.count_nonzero(new, axis=1)
    numbers, new = _turned(numbers), _turned(new)

    counts, orders, coder = _Counts(lanes, steps), _Orders(lanes, steps), _Encoder(lanes)
    ended = None
    for begin, end in _stretches(steps):
        counts.take_up(begin, end - begin)
        whole = begin + counts.new
        for at in range(begin, end, _STRIP):
            until = min(end, at + _STRIP)
            for k, (start, width) in enumerate(_parts(counts, orders, whole, numbers[at:until], new[at:until]), at):
                if k == last:
                    # the last block is complete; what its lane codes from here on is not kept
                    ended = coder.state(lanes - 1)
                coder.code(start, width)
        counts.used = counts.used + np.count_nonzero(new[begin:end], axis=0).astype(np.int32)
    if ended is not None:
        coder.back_to(lanes - 1, ended)

    order, active = _most_first(n_new)
    firsts = (np.cumsum(n_new) - n_new)[order]
    coder.deal(order)
    new_ids = _NewIds(lanes)
    for k, n in enumerate(active):
        coder.code_new(found.take(firsts[:n] + k, mode="clip"), new_ids)
    return coder.closed()


def _parts(counts: _Counts, orders: _Orders, whole: np.ndarray, came: np.ndarray, new: np.ndarray) -> Iterator[tuple]:
    """Where the parts of numbers begin in the mixtures, and how wide they are; ``whole`` is all of order 0."""
    places = counts.places(came)
    firsts = counts.edges.take(places, mode="clip").astype(np.int32)
    wide = counts.edges.take(places + len(whole), mode="clip") - firsts
    wide += new * (counts.new - 1)
    for k, number in enumerate(came):
        counts.count(places[k])
        predicted, weights = orders.predict()
        shares = _shares(weights)
        rest = _TOTAL - shares[0]
        rest -= shares[1]
        part = _quotient(rest, whole)
        same = predicted == number
        start, width = firsts[k], wide[k]
        start *= part
        width *= part
        added = shares * same
        width += added[0]
        width += added[1]
        shares *= predicted < number
        start += shares[0]
        start += shares[1]
        whole += new[k]
        orders.learn(number, same)
        yield start, width


class _Encoder:
    """Bounds and words of all blocks of a batch. The last word of a lane waits for carries; words before it may hold
    one more than a word, which moves on in the end."""

    def __init__(self, lanes: int):
        self._low, self._span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _WIDEST)
        self._waiting = np.zeros(lanes, dtype=np.uint64)
        self._lane = np.arange(lanes)
        self._lanes: list[np.ndarray] = []
        self._words: list[np.ndarray] = []

    def state(self, lane: int) -> tuple:
        return self._low[lane], self._span[lane], self._waiting[lane], len(self._words)

    def back_to(self, lane: int, state: tuple) -> None:
        """Undo what the lane has coded since."""
        self._low[lane], self._span[lane], self._waiting[lane], n = state
        for k in range(n, len(self._words)):
            stay = self._lanes[k] != lane
            self._lanes[k], self._words[k] = self._lanes[k][stay], self._words[k][stay]

    def deal(self, order: np.ndarray) -> None:
        """Put the lanes in another order."""
        self._low, self._span = self._low[order], self._span[order]
        self._waiting, self._lane = self._waiting[order], self._lane[order]

    def _moved(self, lanes: np.ndarray) -> None:
        at = self._low.take(lanes, mode="clip")
        self._lanes.append(self._lane.take(lanes, mode="clip"))
        self._words.append(self._waiting.take(lanes, mode="clip"))
        self._waiting[lanes] = at >> _WORD
        self._low[lanes] = at << _WORD
        self._span[lanes] = self._span.take(lanes, mode="clip") << _WORD

    def code(self, starts: np.ndarray, widths: np.ndarray) -> None:
        unit = self._span >> _SCALE
        np.multiply(unit, widths.astype(np.uint64), out=self._span)
        unit *= starts.astype(np.uint64)
        self._low += unit
        self._waiting += self._low < unit
        small = (self._span < _LOW_RANGE).nonzero()[0]
        if len(small):
            self._moved(small)

    def code_new(self, ids: np.ndarray, new_ids: _NewIds) -> None:
        """Code new ids of the first lanes."""
        n = len(ids)
        bits = np.frexp(ids.astype(np.float64))[1].astype(np.int64)
        free = np.maximum(bits - 2, 0)
        classes = np.where(ids < 2, ids, 2 * bits - 4 + (ids >> free))
        begin, part = new_ids.find(classes)
        unit = self._span[:n] // np.uint64(new_ids.total)
        added = unit * begin
        unit *= part
        unit >>= free.astype(np.uint64)
        added += unit * (ids - _CLASS_BEGINS.take(classes)).astype(np.uint64)
        self._low[:n] += added
        self._waiting[:n] += self._low[:n] < added
        self._span[:n] = unit
        small = (unit < _LOW_RANGE).nonzero()[0]
        if len(small):
            self._moved(small)
        new_ids.learn(classes)

    def closed(self) -> list[bytes]:
        """The bytes of each lane."""
        parts = [self._waiting, self._low >> _WORD, self._low & _LOWER]
        lanes = np.concatenate([*self._lanes, *[self._lane] * len(parts)])
        small = np.int16 if len(self._low) < 1 << 15 else np.int64
        words = np.concatenate([*self._words, *parts])[np.argsort(lanes.astype(small), kind="stable")]
        # a lane begins with a word that nothing is carried into
        while (carries := words >> _WORD).any():
            words &= _LOWER
            words[:-1] += carries[1:]
        ends = np.cumsum(np.bincount(lanes, minlength=len(self._low))).tolist()
        words = words.astype(WORDS)
        return [words[begin + 1 : end].tobytes() for begin, end in zip([0, *ends], ends, strict=False)]


def decoded(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block, given its bytes and number of ids."""
    if not coded:
        return []
    lanes, steps = len(coded), max(lengths)
    coder = _Decoder(coded)
    counts, orders = _Counts(lanes, steps), _Orders(lanes, steps)
    numbers = np.zeros((steps, lanes), dtype=_number_type(steps))
    n_new = np.zeros(lanes, dtype=np.int64)
    length = np.array(lengths)
    shorter, ended = set(lengths) - {steps}, []
    for begin, end in _stretches(steps):
        room = end - begin
        counts.take_up(begin, room)
        came = numbers[begin:end]
        edges, after, used = counts.edges, counts.lane + lanes, counts.used
        held, row = counts.numbers(begin, room).reshape(-1), np.arange(lanes) * (end + 1)
        more = counts.new - 1
        until, whole = np.full(lanes, begin, dtype=np.int32), begin + counts.new
        for k in range(room):
            if begin + k in shorter:
                # these blocks are complete; what their lanes read from here on is not kept
                some = np.flatnonzero(length == begin + k)
                n_new[some] = used[some]
                ended.append((some, coder.state(some)))
            predicted, weights = orders.predict()
            shares = _shares(weights)
            order2, order1 = shares
            rest = _TOTAL - order2
            rest -= order1
            part = _quotient(rest, whole)
            place = coder.place()
            # what predictions have added up to this place is taken off, that of order 2 first
            at = predicted.astype(np.int64)
            at *= lanes
            at += after
            off = edges.take(at, mode="clip") * part
            off -= 1
            off[0] += order1 * (predicted[1] <= predicted[0])
            for share, begins in zip(shares, off, strict=True):
                np.subtract(place, begins, out=begins)
                np.maximum(begins, 0, out=begins)
                np.minimum(begins, share, out=begins)
                place -= begins
            at = _quotient(place, part)
            np.minimum(at, until, out=at)
            number = held.take(row + at, out=came[k], mode="clip")
            at = counts.places(number)
            counts.count(at)
            start = edges.take(at, mode="clip").astype(np.int32)
            span = edges.take(at + lanes, mode="clip") - start
            new = number == used
            span += more * new
            start *= part
            span *= part
            same = predicted == number
            added = shares * same
            span += added[0]
            span += added[1]
            shares *= predicted < number
            start += order2
            start += order1
            coder.take(start, span)
            used += new
            until += new
            whole += new
            orders.learn(number, same)
    some = np.flatnonzero(length == steps)
    n_new[some] = counts.used[some]
    for some, state in ended:
        coder.back_to(some, state)

    order, active = _most_first(n_new)
    coder.deal(order)
    new_ids, found = _NewIds(lanes), np.zeros((lanes, max(len(active), 1)), dtype=IDS)
    columns = np.empty((len(active), lanes), dtype=IDS)
    for k, n in enumerate(active):
        columns[k, :n] = coder.new_ids(n, new_ids)
    found[order, : len(active)] = columns.T
    numbers = _turned(numbers)
    return [found[lane].take(numbers[lane, :n], mode="clip") for lane, n in enumerate(lengths)]


class _Decoder:
    """Spans and words of all blocks of a batch; a lane's code is told from its lower bound."""

    def __init__(self, coded: list[bytes]):
        lanes = len(coded)
        width = max(len(part) // WORDS.itemsize for part in coded) + 2
        words = np.zeros((lanes, width), dtype=WORDS)
        for lane, part in enumerate(coded):
            some = np.frombuffer(part, dtype=WORDS)
            words[lane, : len(some)] = some
        # lanes are at much the same word, so words of one place stand together
        self._words, self._lanes = words.T.ravel(), lanes
        self._last = np.arange(lanes) + (width - 1) * lanes
        self._code = (words[:, 0].astype(np.uint64) << _WORD) | words[:, 1]
        self._span = np.full(lanes, _WIDEST)
        self._next = np.arange(lanes) + 2 * lanes

    def state(self, lanes: np.ndarray) -> tuple:
        return self._code[lanes], self._span[lanes], self._next[lanes]

    def back_to(self, lanes: np.ndarray, state: tuple) -> None:
        self._code[lanes], self._span[lanes], self._next[lanes] = state

    def deal(self, order: np.ndarray) -> None:
        """Put the lanes in another order."""
        self._code, self._span = self._code[order], self._span[order]
        self._next, self._last = self._next[order], self._last[order]

    def _moved(self, lanes: np.ndarray) -> None:
        at = self._next.take(lanes, mode="clip")
        # a block that is complete runs on over its last word, a zero
        code = self._code.take(lanes, mode="clip") << _WORD
        code |= self._words.take(np.minimum(at, self._last.take(lanes, mode="clip")), mode="clip")
        self._code[lanes] = code
        at += self._lanes
        self._next[lanes] = at
        self._span[lanes] = self._span.take(lanes, mode="clip") << _WORD

    def place(self) -> np.ndarray:
        """Where each block's code lies in its mixture."""
        self._unit = self._span >> _SCALE
        place = self._code // self._unit
        np.minimum(place, _LAST_PLACE, out=place)
        return place.astype(np.int32)

    def take(self, starts: np.ndarray, widths: np.ndarray) -> None:
        unit = self._unit
        np.multiply(unit, widths.astype(np.uint64), out=self._span)
        unit *= starts.astype(np.uint64)
        self._code -= unit
        small = (self._span < _LOW_RANGE).nonzero()[0]
        if len(small):
            self._moved(small)

    def new_ids(self, n: int, new_ids: _NewIds) -> np.ndarray:
        """New ids of the first lanes."""
        code, total = self._code[:n], new_ids.total
        unit = self._span[:n] // np.uint64(total)
        place = np.minimum(code // unit, np.uint64(total - 1)).astype(np.int16)
        classes = new_ids.at(place).astype(np.int64)
        begin, part = new_ids.find(classes)
        free = _FREE_BITS.take(classes)
        code -= unit * begin
        unit *= part
        unit >>= free
        rest = np.minimum(code // unit, (np.uint64(1) << free) - np.uint64(1))
        code -= unit * rest
        self._span[:n] = unit
        small = (unit < _LOW_RANGE).nonzero()[0]
        if len(small):
            self._moved(small)
        new_ids.learn(classes)
        return _CLASS_BEGINS.take(classes) + rest.astype(np.int64)
