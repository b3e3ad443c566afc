"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

Merge-type (BPE) models: the best-scored pair of neighbouring symbols whose joined form is a piece merges first, the left
one of equals. With dropout every candidate pair is skipped for good if a keyed hash of (seed, row key, place of the
occurrence, word, bounds of the pair) falls below ``dropout``; nothing is drawn at random, so a rerun gives the same ids.

Pieces never join across a blank followed by a letter, so text is cut into blanks-plus-word units. Without dropout equal
units of a slice are segmented once, in tables of numpy with a unit in each column (long units by a heap of their own). A
candidate is tested when it is the best of its unit; those that a better one takes a symbol from first need no test. With
dropout each occurrence draws its own skips; it shares a segmentation where all tests of that come out the same for it: the plain
one (if its unit comes more than once), then that of one of the occurrences that part from the plain one at the same test, then
once more so. The others are segmented each on its own.
Characters without a piece, and the blank mark itself, become byte pieces, so decoding gives back every text.

NULL texts are empty and have no ids. Repeated rows get equal ids. A NULL key counts as an empty one.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import arrow_map, held, mix64, share, text_chunks

MARK = "▁"
LONG = 48
#: Units taken together, those of one table, and candidates tested together.
TOGETHER, COLUMNS, TESTED = 1 << 16, 16_384, 1 << 18
#: Units of up to so many characters stand in one table.
WIDTHS = (4, 6, 8, 10, 13, 18, 28)
#: Times that occurrences which part at the same test share a segmentation before each of the others gets its own.
SHARED = 2
_UNIT = re.compile(r" +[^ \n]*|[^ \n]+|\n+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NONE, _GONE = np.int32(1 << 30), np.int32(-1 << 31)


@dataclass
class Vocabulary:
    """Arrays of a merge-type model: pair table (hashed slots), rank of each piece, ids of characters and bytes."""

    strings: list[bytes]
    pair_key: np.ndarray
    pair_to: np.ndarray
    rank: np.ndarray
    char_id: dict[int, int]
    byte_id: np.ndarray

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the joined piece, -1 where there is none. Unknown symbols are negative."""
        key = np.maximum((left.astype(np.int64) << np.int64(20)) | right, -1)
        mask = len(self.pair_key) - 1
        at = slots(key, mask)
        there = self.pair_key[at]
        out = np.where(there == key, self.pair_to[at], -1)
        open_ = np.flatnonzero((there != key) & (there != -1))
        at = at[open_]
        while len(open_):
            at = (at + 1) & mask
            there = self.pair_key[at]
            hit = there == key[open_]
            out[open_[hit]] = self.pair_to[at[hit]]
            go = ~hit & (there != -1)
            open_, at = open_[go], at[go]
        return out


def slots(key: np.ndarray, mask: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((key.view(np.uint64) * _ODD) >> np.uint64(32)).astype(np.int64) & mask


def vocabulary(pieces: list[str], scores: list[float], kinds: list[str]) -> Vocabulary:
    """``kinds``: 'normal', 'byte' or 'control' for each piece."""
    ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "normal"}
    pairs = {}
    for piece, at in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left * (1 << 20) + right] = at
    size = 1 << max(4, (4 * len(pairs)).bit_length())
    key, to = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
    names = np.array(list(pairs), dtype=np.int64)
    for k, s in zip(names.tolist(), slots(names, size - 1).tolist() if len(names) else []):
        while key[s] != -1:
            s = (s + 1) & (size - 1)
        key[s], to[s] = k, pairs[k]
    order = np.unique(-np.array(scores, dtype=np.float64), return_inverse=True)[1].astype(np.int64)
    strings, byte_id = [], np.full(256, -1, dtype=np.int64)
    for i, (piece, kind) in enumerate(zip(pieces, kinds)):
        if kind == "byte":
            value = int(piece[3:5], 16)
            byte_id[value] = i
            strings.append(bytes([value]))
        else:
            strings.append(piece.replace(MARK, " ").encode() if kind == "normal" else b"")
    chars = {(32 if p == MARK else ord(p)): i for p, i in ids.items() if len(p) == 1}
    if (byte_id < 0).any():
        raise ValueError("the model has no byte pieces, so not every text could be decoded")
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in ids):
        raise ValueError("pieces that join a word and a following blank are not supported")
    return Vocabulary(strings, key, to, order, chars, byte_id)


def load(path: str) -> Vocabulary:
    """Read a sentencepiece model file (on the driver; executors get the arrays)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(model.vocab_size())
    kinds = [
        "byte" if model.is_byte(i) else "control" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"
        for i in n
    ]
    return vocabulary([model.id_to_piece(i) for i in n], [model.get_score(i) for i in n], kinds)


def places(begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for the bounds of a candidate pair inside its unit."""
    with np.errstate(over="ignore"):
        return ((begin.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)) * _ODD


def kept(word: np.ndarray, place: np.ndarray, limit: np.ndarray | np.uint64) -> np.ndarray:
    """False where the candidate pair is skipped; ``word`` holds a hash of unit, occurrence and seed."""
    return (mix64(word ^ place) >> np.uint64(1)) >= limit


def limit_of(dropout: float) -> np.uint64:
    return np.uint64(int(dropout * (1 << 63)))


def segment(vocab: Vocabulary, ids: np.ndarray, owner: np.ndarray, hashed: np.ndarray, dropout: float, seen: list | None = None,
            tested: list | None = None, limits: np.ndarray | None = None):
    """Merge all units at once. ``ids`` per character (negative: unknown), ``owner`` the unit of each, in order.

    Each round tests the best pair of every unit, and merges or skips it. Returns ids and owners of the symbols that remain, in
    order. ``seen`` gets (owner, begin, middle, end) of all candidates that came up, skipped or not, and ``tested`` gets
    (owner, place, kept) of those that were the best of their unit once, in order. ``limits`` are those of every unit, if
    they differ.
    """
    if not len(ids):
        return ids, owner
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    who, lengths = owner[first], np.diff(np.append(first, len(ids)))
    if limits is None:
        limits = np.full(len(hashed), limit_of(dropout))
    left = np.full(len(ids), _GONE, dtype=np.int32)
    by_length = np.argsort(lengths, kind="stable")
    cuts = np.searchsorted(lengths[by_length], WIDTHS, side="right").tolist()
    for low, high in zip([0, *cuts], [*cuts, len(by_length)]):
        for k in range(low, high, COLUMNS):
            some = by_length[k : min(high, k + COLUMNS)]
            size = lengths[some]
            column = np.repeat(np.arange(len(some)), size)
            row = np.arange(len(column)) - np.repeat(np.cumsum(size) - size, size)
            flat = row + np.repeat(first[some], size)
            table = np.full((int(size[-1]) + 1, len(some)), _GONE, dtype=np.int32)
            table[row, column] = ids[flat]
            _merge_table(vocab, table, who[some], hashed, limits if dropout else None, seen, tested)
            left[flat] = table[row, column]
    stay = left != _GONE
    return left[stay].astype(np.int64), owner[stay]


def _merge_table(vocab: Vocabulary, table: np.ndarray, who: np.ndarray, hashed, limits, seen, tested) -> None:
    """Merge in place units of similar length, one in each column; the last row is free, merged symbols become _GONE."""
    rows, n = table.shape
    bits = (rows - 1).bit_length()
    # of the symbol that begins in a row: its end, and the joined piece and order of its pair with the next one; of an end: its begin
    ends = np.repeat(np.arange(1, rows + 1, dtype=np.int32), n)
    begins = np.repeat(np.arange(-1, rows - 1, dtype=np.int32), n)
    to = np.full((rows, n), -1, dtype=np.int32)
    to[:-1] = vocab.merged(table[:-1].ravel(), table[1:].ravel()).reshape(rows - 1, n)
    order = np.where(to >= 0, (vocab.rank[to] << bits) + np.arange(rows)[:, None], _NONE).astype(np.int32)
    if seen is not None:
        at, unit = np.nonzero(to >= 0)
        seen.append((who[unit], at, at + 1, at + 2))
    live, ids, to, flat_order = np.arange(n), table.ravel(), to.ravel(), order.ravel()
    while True:
        best = np.minimum.reduce(order, axis=0)
        unit = np.flatnonzero(best < _NONE)
        if not len(unit):
            break
        if 2 * len(unit) < len(best):  # go on with the units that have a pair left
            table[:, live] = ids.reshape(rows, -1)
            live, best = live[unit], best[unit]
            ids, ends, begins, to = (np.ascontiguousarray(x.reshape(rows, -1)[:, unit]).ravel() for x in (ids, ends, begins, to))
            order = np.ascontiguousarray(order[:, unit])
            flat_order, n, unit = order.ravel(), len(unit), np.arange(len(unit))
        else:
            best = best[unit]
        begin = best & ((1 << bits) - 1)
        at = begin * n + unit
        middle = ends[at]
        end = ends[middle * n + unit]
        if limits is not None:
            own = who[live[unit]]
            place = places(begin, middle, end)
            keep = kept(hashed[own], place, limits[own])
            if tested is not None:
                tested.append((own, place, keep))
            flat_order[at[~keep]] = _NONE
            unit, begin, middle, end, at = unit[keep], begin[keep], middle[keep], end[keep], at[keep]
        elif tested is not None:
            tested.append((who[live[unit]], places(begin, middle, end), np.ones(len(unit), dtype=bool)))
        made = to[at]
        ids[at] = made
        gone = middle * n + unit
        ids[gone], flat_order[gone] = _GONE, _NONE
        ends[at] = end
        begins[end * n + unit] = begin
        # only pairs with the new symbol change
        has = np.flatnonzero(begin)
        before = begins[at[has]]
        at_before = before * n + unit[has]
        pair = np.concatenate([at, at_before])
        joined = vocab.merged(np.concatenate([made, ids[at_before]]), np.concatenate([ids[end * n + unit], made[has]]))
        to[pair] = joined
        row = np.concatenate([begin, before])
        flat_order[pair] = np.where(joined >= 0, (vocab.rank[joined] << bits) + row, _NONE)
        if seen is not None:
            ok, owns = joined >= 0, who[live[np.concatenate([unit, unit[has]])]]
            next_row = ends[pair]
            seen.append((owns[ok], row[ok], next_row[ok], ends[next_row * n + np.concatenate([unit, unit[has]])][ok]))
    table[:, live] = ids.reshape(rows, -1)


def segment_long(vocab: Vocabulary, ids: list[int], hashed: np.uint64, dropout: float, seen: list | None = None,
                 tested: list | None = None, limit: np.uint64 | None = None) -> list[int]:
    """The same for one unit of any length, with an agenda."""
    limit = limit_of(dropout) if limit is None else limit
    n = len(ids)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    word = np.array([hashed], dtype=np.uint64)
    agenda: list[tuple[int, int, int, int, int, int, bool]] = []

    def offer(lefts: list[int]) -> None:
        pairs = np.array([(i, after[i]) for i in lefts], dtype=np.int64).reshape(-1, 2)
        a = np.array([ids[i] for i in pairs[:, 0]], dtype=np.int64)
        b = np.array([ids[i] for i in pairs[:, 1]], dtype=np.int64)
        to = vocab.merged(a, b)
        ends = np.array([end[i] for i in pairs[:, 1]], dtype=np.int64)
        pairs, ends, to = pairs[to >= 0], ends[to >= 0], to[to >= 0]
        if seen is not None:
            seen.append((pairs[:, 0], pairs[:, 1], ends))
        place = places(pairs[:, 0], pairs[:, 1], ends)
        keep = kept(word, place, limit) if dropout else np.ones(len(to), dtype=bool)
        for i, j, t, e, p, k in zip(pairs[:, 0].tolist(), pairs[:, 1].tolist(), to.tolist(), ends.tolist(), place.tolist(), keep.tolist()):
            heapq.heappush(agenda, (int(vocab.rank[t]), i, j, e, t, p, k))

    offer(list(range(n - 1)))
    while agenda:
        _, i, j, e, t, p, k = heapq.heappop(agenda)
        if not (alive[i] and after[i] == j and j < n and alive[j] and end[j] == e):
            continue
        if tested is not None:
            tested.append((p, k))
        if not k:
            continue
        ids[i], end[i], after[i], alive[j] = t, e, after[j], False
        if after[i] < n:
            before[after[i]] = i
        around = [k for k in (before[i], i) if k >= 0 and after[k] < n]
        if around:
            offer(around)
    return [x for x, a in zip(ids, alive) if a]


class Numbers(dict):
    """Numbers of keys, in the order in which they first come."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def encode(vocab: Vocabulary, texts: list[str], keys: list[bytes], dropout: float = 0.0, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order and the number of ids of each."""
    known = Numbers()
    numbers: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            units = _UNIT.findall(" " + text)
            numbers.extend(map(known.__getitem__, units))
            counts[i] = len(units)
    if not numbers:
        return np.zeros(0, dtype=np.int32), counts
    unit = np.array(numbers, dtype=np.int64)
    names = list(known)
    if not dropout:
        flat, sizes = _encode_units(vocab, names, np.zeros(len(names), np.uint64), 0.0)
        made = unit
    else:
        hashes = np.array([xxhash.xxh3_64_intdigest(u, seed) for u in names], dtype=np.uint64)
        stream = np.array([xxhash.xxh3_64_intdigest(k, seed) for k in keys], dtype=np.uint64)
        place = np.arange(len(unit)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            hashed = mix64(hashes[unit] + mix64(np.repeat(stream, counts) + place.astype(np.uint64) * _ODD))
        flat, sizes, made = _with_dropout(vocab, names, unit, hashed, dropout)
    begin = np.cumsum(sizes) - sizes
    each = sizes[made]
    ends = np.cumsum(each)
    gather = np.arange(int(ends[-1])) - np.repeat(ends - each, each) + np.repeat(begin[made], each)
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return flat[gather].astype(np.int32), np.diff(bounds)


def _with_dropout(vocab: Vocabulary, names: list[str], unit: np.ndarray, hashed: np.ndarray, dropout: float):
    """Ids and sizes of the segmentations made, and for each occurrence which of them is its own."""
    limit, total = limit_of(dropout), len(names)
    # a unit that comes once is segmented as its occurrence, others without skips
    often = np.bincount(unit, minlength=total) > 1
    any_of = np.zeros(total, dtype=np.int64)
    any_of[unit] = np.arange(len(unit))
    tested: list = []
    flat, sizes = _encode_units(vocab, names, hashed[any_of], dropout, None, tested, np.where(often, np.uint64(0), limit))
    flats, all_sizes = [flat], [sizes]
    made = unit.copy()
    rest = np.flatnonzero(often[unit])
    rest, parting = _partings(tested, rest, unit[rest], hashed, limit, total)
    for _ in range(SHARED):
        if not len(rest):
            break
        # of the occurrences that part from a segmentation at the same test, one goes first
        _, first, group = np.unique(parting, return_index=True, return_inverse=True)
        tested = []
        flat, sizes = _encode_units(vocab, [names[k] for k in unit[rest[first]].tolist()], hashed[rest[first]], dropout, None, tested)
        flats.append(flat)
        all_sizes.append(sizes)
        made[rest] = total + group
        total += len(first)
        rest, parting = _partings(tested, rest, group, hashed, limit, len(first))
    if len(rest):
        flat, sizes = _encode_units(vocab, [names[k] for k in unit[rest].tolist()], hashed[rest], dropout)
        flats.append(flat)
        all_sizes.append(sizes)
        made[rest] = total + np.arange(len(rest))
    return np.concatenate(flats), np.concatenate(all_sizes), made


def _partings(tested: list, which: np.ndarray, made: np.ndarray, hashed: np.ndarray, limit: np.uint64, n: int):
    """Of the occurrences ``which``, those for which a test of segmentation ``made`` turns out otherwise, and the first such test."""
    if not tested:
        return which[:0], which[:0]
    owner, place, keep = (np.concatenate(x) for x in zip(*tested))
    order = np.argsort(owner, kind="stable")
    place, keep = place[order], keep[order]
    number = np.bincount(owner, minlength=n)
    start = np.cumsum(number) - number
    each = number[made]
    ends = np.cumsum(each)
    out, tests = [which[:0]], [which[:0]]
    low = 0
    while low < len(which):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + TESTED, side="right")))
        size = each[low:high]
        who = np.repeat(which[low:high], size)
        at = np.arange(len(who)) + np.repeat(start[made[low:high]] - (ends[low:high] - size - done), size)
        other = np.flatnonzero(kept(hashed[who], place[at], limit) != keep[at])
        other = other[np.diff(who[other], prepend=-1) != 0]
        out.append(who[other])
        tests.append(at[other])
        low = high
    return np.concatenate(out), np.concatenate(tests)


def _encode_units(vocab: Vocabulary, units: list[str], hashed: np.ndarray, dropout: float, seen: list | None = None,
                  tested: list | None = None, limits: np.ndarray | None = None):
    """Ids of units in order and how many each has; ``seen`` and ``tested`` get the candidates as in ``segment``."""
    ids, sizes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for k in range(0, len(units), TOGETHER):
        some = slice(k, k + TOGETHER)
        found: list | None = None if seen is None else []
        tests: list | None = None if tested is None else []
        got = _encode_some(vocab, units[some], hashed[some], dropout, found, tests, None if limits is None else limits[some])
        ids.append(got[0])
        sizes.append(got[1])
        if seen is not None:
            seen.extend((who + k, *where) for who, *where in found)
        if tested is not None:
            tested.extend((who + k, *how) for who, *how in tests)
    return np.concatenate(ids), np.concatenate(sizes)


def _encode_some(vocab: Vocabulary, units: list[str], hashed: np.ndarray, dropout: float, seen, tested, limits):
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    lengths = np.array(list(map(len, units)), dtype=np.int64)
    distinct = np.flatnonzero(np.bincount(points))
    # an unknown character is -1 - its code point
    id_of = np.zeros(int(distinct[-1]) + 1, dtype=np.int64)
    id_of[distinct] = [vocab.char_id.get(p, -1 - p) if p != ord(MARK) else -1 - p for p in distinct.tolist()]
    ids = id_of[points]
    owner = np.repeat(np.arange(len(units)), lengths)
    long = lengths > LONG
    short = ~long[owner]
    got_ids, got_owner = segment(vocab, ids[short], owner[short], hashed, dropout, seen, tested, limits)
    if long.any():
        first = np.cumsum(lengths) - lengths
        parts, owners_ = [got_ids], [got_owner]
        for k in np.flatnonzero(long):
            found: list | None = None if seen is None else []
            tests: list | None = None if tested is None else []
            some = ids[first[k] : first[k] + lengths[k]].tolist()
            own = np.array(segment_long(vocab, some, hashed[k], dropout, found, tests, None if limits is None else limits[k]), dtype=np.int64)
            if seen is not None:
                seen.extend((np.full(len(where[0]), k), *where) for where in found)
            if tests:
                place, keep = zip(*tests)
                tested.append((np.full(len(tests), k), np.array(place, dtype=np.uint64), np.array(keep, dtype=bool)))
            parts.append(own)
            owners_.append(np.full(len(own), k))
        got_ids, got_owner = np.concatenate(parts), np.concatenate(owners_)
        order = np.argsort(got_owner, kind="stable")
        got_ids, got_owner = got_ids[order], got_owner[order]
    unknown = got_ids < 0
    if unknown.any():
        codes = [chr(-1 - p).encode("utf-8", "surrogatepass") for p in got_ids[unknown].tolist()]
        width = np.ones(len(got_ids), dtype=np.int64)
        width[unknown] = [len(c) for c in codes]
        out = np.repeat(got_ids, width)
        out[np.repeat(unknown, width)] = vocab.byte_id[np.frombuffer(b"".join(codes), dtype=np.uint8)]
        got_ids, got_owner = out, np.repeat(got_owner, width)
    return got_ids, np.bincount(got_owner, minlength=len(units))


def decode(vocab: Vocabulary, ids) -> bytes:
    """The text of a list of ids, without the blank that encoding puts in front."""
    return b"".join(map(vocab.strings.__getitem__, ids))[1:]


def add_ids(docs: DataFrame, vocab: Vocabulary, key: str = "doc_id", text: str = "text", out: str = "ids",
            dropout: float = 0.1, seed: int = 17, lossless: str | None = "lossless") -> DataFrame:
    """All columns of ``docs``, the ids of each text and whether decoding them gave the text back."""
    shared = share(docs, vocab)
    base = docs.drop(*[c for c in (out, lossless) if c])
    at, at_key = base.columns.index(text), base.columns.index(key)
    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    if lossless:
        fields.append(T.StructField(lossless, T.BooleanType()))

    def run(batches):
        model = held(shared)
        for batch in batches:
            for part, raw in text_chunks(batch, batch.schema.names[at], 1 << 20):
                keys = [b"" if k is None else str(k).encode() for k in part.column(at_key).to_pylist()]
                ids, counts = encode(model, [r.decode() for r in raw], keys, dropout, seed)
                ends = np.concatenate([[0], np.cumsum(counts)])
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))]
                names = [*part.schema.names, out]
                if lossless:
                    flat = ids.tolist()
                    same = [decode(model, flat[a:b]) == r for a, b, r in zip(ends[:-1].tolist(), ends[1:].tolist(), raw)]
                    columns.append(pa.array(same, pa.bool_()))
                    names.append(lossless)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(base, run, T.StructType([*base.schema.fields, *fields]))
