"""Word shingles and SuperMinHash signatures of many texts at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# bytes of text hashed at once; longer texts are taken in parts cut at white space
PART_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


class _Powers:
    """Powers of the hash base and of its inverse, as many as the longest part needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                table = np.full(max(n, PART_BYTES + 1), base, dtype=np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))


_POWERS = _Powers()


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a part."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    _POWERS.reach(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _POWERS.down[starts]
    return starts, mixed(hashes + (ends - starts).astype(np.uint64))


def _parts(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, each cut after white space."""
    begin = 0
    while len(text) - begin > PART_BYTES:
        end = begin + PART_BYTES
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


def _batches(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of texts in order with the index of each word's text; A-Z are lowered first."""
    waiting: list[bytes] = []
    first = size = 0
    for index, text in enumerate(texts):
        data = (text or "").encode().lower()
        if waiting and size + len(data) > PART_BYTES:
            yield _joined(waiting, first)
            waiting, first, size = [], index, 0
        waiting.append(data)
        size += len(data) + 1
    if waiting:
        yield _joined(waiting, first)


def _joined(texts: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
    if len(texts) == 1:
        hashes = np.concatenate([_word_hashes(part)[1] for part in _parts(texts[0])])
        return hashes, np.full(len(hashes), first, dtype=np.int64)
    starts, hashes = _word_hashes(b" ".join(texts))
    begins = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
    return hashes, np.searchsorted(begins, starts, side="right") - 1 + first


def shingle_sets(texts: Sequence[str | None], width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, sorted distinct shingle hashes of each) for runs of texts.

    A text with fewer words than ``width`` has one shingle, its whole sequence; a text without words has none.
    """
    done = 0
    for hashes, owners in _batches(texts):
        chain = mixed(hashes)
        n = len(hashes)
        for k in range(1, width):
            # after step k, chain[i] stands for words i - k to i
            chain = np.concatenate([chain[:1], mixed(hashes[1:] ^ (chain[:-1] * np.uint64(_BASE)))]) if n else chain
        last = int(owners[-1]) if n else done
        bounds = np.searchsorted(owners, np.arange(done, last + 2))
        sets = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if end - begin >= width:
                found = np.sort(chain[begin + width - 1 : end])
                keep = np.empty(len(found), dtype=bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                sets.append(found[keep])
            elif end > begin:
                whole = np.array([end - begin], dtype=np.uint64)
                for place in range(begin, end):
                    whole = mixed(hashes[place : place + 1] ^ whole)
                sets.append(whole)
            else:
                sets.append(np.empty(0, dtype=np.uint64))
        yield done, sets
        done = last + 1
    if done < len(texts):
        yield done, [np.empty(0, dtype=np.uint64)] * (len(texts) - done)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """SuperMinHash signatures, one row per set; rows of empty sets hold the greatest value.

    Each element goes through its own permutation of the signature's places. At step j it offers j plus a fraction to
    its j-th place, so a place filled at an earlier step is never beaten later. A set is finished at the first step
    that can't lower any place (early stopping). All elements of unfinished sets take a step together.
    """
    table = np.full((len(sets), size), _NEVER)
    flat = table.reshape(-1)
    elements = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    first = second = places = None
    for step in range(size):
        draw = mixed(elements + np.uint64((step + 1) * 0xD1B54A32D192ED03 % 2**64))
        pick = step + ((draw >> np.uint64(32)) % np.uint64(size - step)).astype(np.int64)
        if step == 0:
            place = first = pick
        elif step == 1:
            second = pick
            place = np.where(pick == first, 0, pick)
        else:
            if places is None:
                places = _after_two(first, second, size)
            rows = np.arange(len(pick))
            place = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[:, step]
        np.minimum.at(flat, owner * size + place, (np.uint64(step) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF)))
        open_sets = table.max(axis=1) >= (np.uint64(step + 1) << np.uint64(32))
        stay = open_sets[owner]
        if not stay.any():
            break
        if not stay.all():
            elements, owner = elements[stay], owner[stay]
            first = first[stay]
            second = second[stay] if second is not None else None
            places = places[stay] if places is not None else None
    return table


def _after_two(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """What the places of each element's permutation hold after two exchanges."""
    kind = np.uint8 if size <= 256 else np.uint16
    places = np.tile(np.arange(size, dtype=kind), (len(first), 1))
    rows = np.arange(len(first))
    for step, pick in enumerate((first, second)):
        moved = places[rows, pick].copy()
        places[rows, pick] = places[:, step]
        places[:, step] = moved
    return places


def band_keys(table: np.ndarray, rows_per_band: int) -> np.ndarray:
    """One 64-bit key per band of a signature; keys of different bands differ."""
    n_bands = table.shape[1] // rows_per_band
    cut = table[:, : n_bands * rows_per_band].reshape(len(table), n_bands, rows_per_band)
    keys = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), (len(table), n_bands)).copy()
    for k in range(rows_per_band):
        keys = mixed(keys ^ cut[:, :, k] * np.uint64(_BASE))
    return keys


def set_key(found: np.ndarray) -> bytes:
    """128-bit key of a set that doesn't depend on order."""
    total = np.add.reduce(mixed(found))
    other = np.bitwise_xor.reduce(mixed(found ^ np.uint64(0xA0761D6478BD642F)))
    return total.tobytes() + other.tobytes()


# (node, root, all shingles, shingles per node) of a block
Block = tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]
# shared shingles counted at once
_COUNTED_AT_ONCE = 1_000_000


def shared_counts(left: Block, right: Block) -> np.ndarray:
    """How many shingles each node of one block shares with each node of the other."""
    _, _, left_found, left_sizes = left
    _, _, right_found, right_sizes = right
    counts = np.zeros(len(left_sizes) * len(right_sizes), dtype=np.int32)
    order = np.argsort(right_found, kind="stable")
    sorted_found = right_found[order]
    right_rows = np.repeat(np.arange(len(right_sizes)), right_sizes)[order]
    first = np.searchsorted(sorted_found, left_found, side="left")
    held = np.searchsorted(sorted_found, left_found, side="right") - first
    left_rows = np.repeat(np.arange(len(left_sizes)), left_sizes)
    some = held > 0
    first, held, left_rows = first[some], held[some], left_rows[some]
    done = np.cumsum(held)
    begin = 0
    while begin < len(held):
        base = done[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(done, base + _COUNTED_AT_ONCE, side="right")))
        n = held[begin:end]
        total = int(n.sum())
        places = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[begin:end], n)
        cells = np.repeat(left_rows[begin:end], n) * len(right_sizes) + right_rows[places]
        counts += np.bincount(cells, minlength=len(counts)).astype(np.int32)
        begin = end
    return counts.reshape(len(left_sizes), len(right_sizes))


def links_between(left: Block, right: Block, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between nodes of different roots, as many as join the roots: a forest over them."""
    shared = shared_counts(left, right).astype(np.int64)
    union = left[3].astype(np.int64)[:, None] + right[3].astype(np.int64)[None, :] - shared
    names: dict[bytes, int] = {}
    left_roots = np.array([names.setdefault(root, len(names)) for root in left[1]])
    right_roots = np.array([names.setdefault(root, len(names)) for root in right[1]])
    alike = (100 * shared >= percent * union) & (left_roots[:, None] != right_roots[None, :])
    parent = list(range(len(names)))

    def top(root: int) -> int:
        while parent[root] != root:
            parent[root] = parent[parent[root]]
            root = parent[root]
        return root

    links = []
    rows, columns = np.nonzero(alike)
    # one link for each pair of roots is enough
    _, kept = np.unique(left_roots[rows] * len(names) + right_roots[columns], return_index=True)
    for row, column in zip(rows[kept].tolist(), columns[kept].tolist(), strict=True):
        a, b = top(left_roots[row]), top(right_roots[column])
        if a != b:
            parent[a] = b
            links.append((left[0][row], right[0][column]))
    return links
