"""Benchmark decontamination: CGK random walks, bit-sampling LSH, exact edit distance.

A CGK walk reads a string with a pointer: step j puts out the byte under the
pointer and moves on by a random bit that depends on j and that byte.  Two
strings a few edits apart soon walk in step again, so edit distance becomes
Hamming distance between walks.  A key is a fixed random sample of a walk's
places; equal keys make candidates.

Walks start at every word of an item and at every word of a document, and the
distance of the two starts places a window of the item's size in the document.
An item's many words times ``REPEATS`` independent walks are repetitions.

Recall does not rest on words.  Runs of bytes are also looked up at every byte
of a document, spaces or not.  A short item is dealt into one piece more than
it may have edits, so that some piece is untouched and no window is missed; a
longer one is looked up by all its runs of the greatest length of which random
edits leave one untouched with probability ``TARGET``.  Bit-parallel distances
around the run, many at a time, leave few candidates, and every candidate
window, of walks or runs, is verified by exact edit distance.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .shingles import mix

#: Edits allowed, as a share of the item's bytes.
SHARE = 0.15
#: Steps of a walk and places sampled from it; an item uses the first tier in which some word has that many bytes after it.
TIERS = ((64, 12), (16, 6))
REPEATS = 3
#: Least chance that some run of an item stays untouched when SHARE of its bytes are edited at random places.
TARGET = 0.999
#: (bytes of an item, bytes of its runs) from which TARGET holds; a smaller item is dealt into pieces, which miss nothing.
RUNS = ((50, 8), (95, 10), (161, 12), (255, 14), (395, 16))
#: Pieces that are checked together, and bytes and edits of the part around a run that is checked.
GROUP = 5
PART = 64
LOOSE = 20
#: Places of a document, and candidates, that are taken at a time.
SPAN = 1 << 16
BATCH = 1 << 14
#: Bytes of items that a task holds at a time; a larger benchmark is taken in blocks, each against all documents.
ITEM_BYTES = 8 << 20

#: Size of the tables that tell which part keys some item has; a chance hit only costs the rest of a walk.
FILTER_BITS = 20
_FILTER_SHIFT = np.uint64(64 - FILTER_BITS)

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[0, *range(9, 14)]] = 32


def normalise(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A-Z lowered, runs of white space one space, none at the start; (bytes, offsets, place in raw).

    A zero byte stands after every text, where walks stop.
    """
    low = _CLEAN[raw]
    space = low == 32
    before = np.append(True, space[:-1]) if len(raw) else space
    head = np.zeros(len(raw), bool)
    head[at[:-1][np.diff(at) > 0]] = True
    keep = np.flatnonzero(~(space & (before | head)))
    ends = np.searchsorted(keep, at[1:])
    n = len(at) - 1
    out = np.zeros(len(keep) + n, np.uint8)
    body = np.ones(len(out), bool)
    stops = ends + np.arange(n)
    body[stops] = False
    out[body] = low[keep]
    place = np.zeros(len(out), np.int64)
    place[body] = keep
    place[stops] = at[1:]
    return out, np.append(0, stops + 1), place


def word_starts(clean: np.ndarray) -> np.ndarray:
    """Places of bytes that begin a word."""
    if not len(clean):
        return np.zeros(0, np.int64)
    before = np.append(0, clean[:-1])
    return np.flatnonzero(((before == 32) | (before == 0)) & (clean != 32) & (clean != 0))


class Walks:
    """The random bits and sampled places of one tier and repetition."""

    def __init__(self, tier: int, repeat: int) -> None:
        self.steps, take = TIERS[tier]
        g = np.random.default_rng((tier, repeat))
        self.moves = g.integers(0, 2, (self.steps, 256), np.int64)
        self.moves[:, 0] = 0  # the end of a text
        self.sampled = np.zeros(self.steps, bool)
        self.sampled[g.choice(self.steps, take, replace=False)] = True
        self.checks = [take // 3, 2 * take // 3] if take > 3 else []

    def keys(self, clean: np.ndarray, starts: np.ndarray, filters: list[np.ndarray] | None) \
            -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(start numbers, keys, part keys at the checks); with ``filters``, walks that no item can match end early."""
        at, live = starts.copy(), np.arange(len(starts))
        key, seen, parts = np.zeros(len(starts), np.uint64), 0, []
        for j in range(self.steps):
            c = clean[at]
            if self.sampled[j]:
                key = (key ^ c) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
                seen += 1
                if seen in self.checks:
                    if filters is None:
                        parts.append(key.copy())
                    else:
                        good = filters[self.checks.index(seen)][(key >> _FILTER_SHIFT).astype(np.int64)]
                        live, key, at, c = live[good], key[good], at[good], c[good]
            at += self.moves[j][c]
        return live, mix(key), parts


def _run_keys(words: np.ndarray, places: np.ndarray | slice, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` bytes at the places; ``words`` has eight bytes from each place on."""
    if length < 8:
        key = words[places] & np.uint64((1 << 8 * length) - 1)
    elif length == 8:
        key = words[places]
    else:
        key = words[places] * np.uint64(0xD6E8FEB86659FD93) + words[length - 8:][places]
    key = key * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    return key * np.uint64(0xBF58476D1CE4E5B9)


def _words(clean: np.ndarray) -> np.ndarray:
    """Eight bytes from every place on; zeros follow the end."""
    padded = np.append(clean, np.zeros(8, np.uint8))
    return np.ndarray(len(clean), "<u8", padded, 0, (1,)).astype(np.uint64)


class Runs:
    """Byte runs of items, by length, and the parts of the items around them; items end at a zero byte in ``clean``."""

    def __init__(self, clean: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        self.first = first
        self.sure = np.zeros(len(size), bool)  # items of which no window is missed
        places: dict[int, list[np.ndarray]] = defaultdict(list)
        owners: dict[int, list[np.ndarray]] = defaultdict(list)
        parts: list[tuple[int, int, int, int]] = []  # item, first byte, bytes, edits
        for i, (a, m) in enumerate(zip(first.tolist(), size.tolist())):
            if not m:
                continue
            most = int(SHARE * m)
            length = max((n for least, n in RUNS if m >= least), default=0)
            if length:
                lasts = max(0, m - PART)
                at = np.arange(m - length + 1)
                owner = np.clip((at + length // 2 - PART // 4) // (PART // 2), 0, -(-lasts // (PART // 2))) + len(parts)
                parts += [(i, a + min(b, lasts), min(m, PART), min(most, LOOSE))
                          for b in range(0, lasts + PART // 2, PART // 2)]
            else:
                self.sure[i] = True
                n = most + 1
                length = m // n
                at = np.arange(n) * m // n
                groups = np.array_split(at, -(-n // GROUP))
                owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups]) + len(parts)
                parts += [(i, a + int(g[0]), int(g[-1] - g[0]) + length, len(g) - 1) for g in groups]
            places[length].append(at + a)
            owners[length].append(owner)
        self.item, self.start, self.size, self.most = np.array(parts, np.int64).reshape(-1, 4).T
        self.masks = np.zeros((len(parts), 32), np.uint64)
        for j in range(PART):
            rows = np.flatnonzero(self.size > j)
            self.masks[rows, clean[self.start[rows] + j] & 31] |= np.uint64(1 << j)
        self.tables = []
        kind = np.int32 if len(clean) < 1 << 31 else np.int64
        words = _words(np.append(clean, np.zeros(16, np.uint8)))
        self.filters: dict[int, np.ndarray] = {}  # by the first eight bytes, or fewer, of the runs
        for length in sorted(places):
            place, owner = np.concatenate(places[length]), np.concatenate(owners[length])
            first_key = _run_keys(words, place, min(length, 8))
            seen = self.filters.setdefault(min(length, 8), np.zeros(1 << FILTER_BITS, bool))
            seen[(first_key >> _FILTER_SHIFT).view(np.int64)] = True
            key = _run_keys(words, place, length)
            order = np.argsort(key, kind="stable")
            keys, at = np.unique(key[order], return_index=True)
            known = np.zeros(1 << FILTER_BITS, bool)
            known[(keys >> _FILTER_SHIFT).view(np.int64)] = True
            self.tables.append((length, known, keys, np.append(at, len(key)), place[order].astype(kind),
                                owner[order].astype(kind)))

    def find(self, clean: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(items, places of runs in ``clean``, where the items begin if nothing is moved), for runs whose part is near enough."""
        edge = np.zeros(PART + LOOSE, np.uint8)
        text = np.concatenate([edge, clean & 31, edge, edge])
        ends = np.flatnonzero(clean == 0)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for x in self.hits(clean):
            held.append(x)
            if sum(len(y[0]) for y in held) >= BATCH:
                yield from self.verified(text, ends, held)
                held = []
        yield from self.verified(text, ends, held)

    def hits(self, clean: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(part, distance from it, place of the run in ``clean``) of every run that stands there, ``SPAN`` at most at a time."""
        padded = np.append(clean, np.zeros(16, np.uint8))
        for lo in range(0, len(clean), SPAN):
            count = min(SPAN, len(clean) - lo)
            words = _words(padded[lo:lo + count + 16])
            able = {n: np.flatnonzero(known[(_run_keys(words, slice(0, count), n) >> _FILTER_SHIFT).view(np.int64)])
                    for n, known in self.filters.items()}
            for length, known, keys, at, place, owner in self.tables:
                here = able[min(length, 8)]
                key = _run_keys(words, here, length)
                good = np.flatnonzero(known[(key >> _FILTER_SHIFT).view(np.int64)])
                here, key = here[good], key[good]
                i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                good = keys[i] == key
                here, i = here[good] + lo, i[good]
                total = np.append(0, np.cumsum(at[i + 1] - at[i]))
                for a in range(0, int(total[-1]), SPAN):
                    n = np.arange(a, min(a + SPAN, int(total[-1])))
                    hit = np.searchsorted(total, n, "right") - 1
                    entry = at[i[hit]] + n - total[hit]
                    yield owner[entry].astype(np.int64), here[hit] - place[entry], here[hit]

    def verified(self, text: np.ndarray, ends: np.ndarray, hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) \
            -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``find`` for some hits; a part and a distance count once in a text."""
        if hits:
            part, moved, run = (np.concatenate(x) for x in zip(*hits))
            place, text_no = (part << 36) + moved, np.searchsorted(ends, run)
            order = np.lexsort((text_no, place))
            place, text_no = place[order], text_no[order]
            once = order[np.append(True, (np.diff(place) != 0) | (np.diff(text_no) != 0))] if len(order) else order
            part, moved, run = part[once], moved[once], run[once]
            for b in range(0, len(part), BATCH):
                p, d = part[b:b + BATCH], moved[b:b + BATCH]
                near = np.flatnonzero(self.near(text, p, d))
                item = self.item[p[near]]
                yield item, run[b:b + BATCH][near], d[near] + self.first[item]

    def near(self, text: np.ndarray, part: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """Whether the bytes around a part's place may hold it with its edits; bytes count mod 32, in ``text`` with edges."""
        most, size = self.most[part], self.size[part]
        wide = int((size + 2 * most).max(initial=0))
        at = self.start[part] + moved - most + PART + LOOSE
        row, top = part * 32, (size - 1).astype(np.uint64)
        masks, one = self.masks.ravel(), np.uint64(1)
        up, down = np.full(len(part), -1, np.int64).view(np.uint64), np.zeros(len(part), np.uint64)
        score, best = size.copy(), size.copy()
        for j in range(wide):
            eq = masks[row + text[at + j]]
            x = eq | down
            flat = (((eq & up) + up) ^ up) | eq
            plus = down | ~(flat | up)
            minus = up & flat
            score += ((plus >> top) & one).view(np.int64) - ((minus >> top) & one).view(np.int64)
            np.minimum(best, score, out=best)
            plus <<= one
            up = (minus << one) | ~(x | plus)
            down = plus & x
        return best <= most


class Items:
    """Walk and run keys of a block of benchmark items, and the items to verify against."""

    def __init__(self, ids: list, texts: list[str | None]) -> None:
        raw = [(t or "").encode() for t in texts]
        clean, at, _ = normalise(np.frombuffer(b"".join(raw), np.uint8),
                                 np.append(0, np.cumsum([len(x) for x in raw], dtype=np.int64)))
        self.ids = ids
        self.texts = [clean[a:b - 1].tobytes().rstrip(b" ") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        size = np.array([len(t) for t in self.texts], np.int64)
        starts = word_starts(clean)
        item = np.searchsorted(at, starts, "right") - 1
        offset = starts - at[item]
        self.runs = Runs(clean, at[:-1], size)
        self.tables = []
        undone = (size > 0) & ~self.runs.sure
        for tier, (steps, _) in enumerate(TIERS):
            able = undone[item] & (offset + steps <= size[item])
            undone[item[able]] = False
            if not able.any():
                continue
            for repeat in range(REPEATS):
                walk = Walks(tier, repeat)
                _, key, parts = walk.keys(clean, starts[able], None)
                order = np.argsort(key, kind="stable")
                filters = []
                for p in parts:
                    f = np.zeros(1 << FILTER_BITS, bool)
                    f[(p >> _FILTER_SHIFT).astype(np.int64)] = True
                    filters.append(f)
                self.tables.append((walk, filters, key[order], item[able][order], offset[able][order]))

    def __getstate__(self):
        return self.ids, [t.decode("utf-8", "surrogateescape") for t in self.texts]

    def __setstate__(self, state):
        self.__init__(state[0], state[1])

    def find(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item number, edits, first byte, end) of the best window of every item found in a text."""
        clean, placed, source = normalise(raw, at)
        starts = word_starts(clean)
        shifts: dict[tuple[int, int], set[int]] = defaultdict(set)
        text = np.searchsorted(placed, starts, "right") - 1
        for walk, filters, keys, item, offset in self.tables:
            live, key, _ = walk.keys(clean, starts, filters)
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for i in np.flatnonzero(hi > lo).tolist():
                s = live[i]
                t = int(text[s])
                for k in range(int(lo[i]), int(hi[i])):
                    shifts[t, int(item[k])].add(int(starts[s] - placed[t] - offset[k]))
        for held, run, begin in self.runs.find(clean):
            for t, k, b in zip((np.searchsorted(placed, run, "right") - 1).tolist(), held.tolist(), begin.tolist()):
                shifts[t, k].add(b - int(placed[t]))
        out = []
        for (t, k), found in sorted(shifts.items()):
            body = clean[placed[t]:placed[t + 1] - 1].tobytes()
            best = nearest(self.texts[k], body, sorted(found), int(SHARE * len(self.texts[k])))
            if best:
                edits, a, b = best
                first = int(source[placed[t] + a] - at[t])
                last = int(source[placed[t] + b - 1] - at[t]) + 1 if b > a else first
                out.append((t, k, edits, first, last))
        return out


def nearest(item: bytes, body: bytes, shifts: list[int], most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the part of ``body`` nearest to ``item``, near one of the shifts, with at most ``most`` edits."""
    best, lo = None, 0
    while lo < len(shifts):
        hi = lo
        while hi + 1 < len(shifts) and shifts[hi + 1] - shifts[hi] <= 2 * most + 1:
            hi += 1
        a = max(0, shifts[lo] - most)
        part = body[a:shifts[hi] + len(item) + most]
        edits, end = _ends(item, part)
        if edits <= most and (best is None or edits < best[0]):
            # the start: the same search backwards from the end
            back, size = _ends(item[::-1], part[:end][::-1], edits)
            best = (edits, a + end - size, a + end)
        lo = hi + 1
    return best


def _ends(pattern: bytes, text: bytes, wanted: int | None = None) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a part of ``text``, and the first end of such a part (bit-parallel columns)."""
    m = len(pattern)
    masks: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        flat = (((eq & up) + up) ^ up) | eq
        plus = down | (~(flat | up) & full)
        minus = up & flat
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus <<= 1
        up = ((minus << 1) | ~(x | plus)) & full
        down = plus & x & full
        if score < best:
            best, end = score, j + 1
            if best == wanted:
                break
    return best, end


def item_blocks(benchmark: DataFrame) -> list[Items]:
    """The items in blocks of about ``ITEM_BYTES``, dealt by the hash of their ids; null and empty texts match nothing."""
    rows = benchmark.filter("text <> ''").selectExpr("cast(item_id as long) item_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // ITEM_BYTES)
    out = []
    for k in range(n):
        found = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()  # about ITEM_BYTES
        found.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        if found:
            out.append(Items([r.item_id for r in found], [r.text for r in found]))
    return out


_FOUND = "doc_id long, item_id long, edits long, start long, end long"


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, start, end (code points) for every benchmark item found in a document.

    One row per document row and item row, for its nearest window.  Null texts
    are empty and hold no item; an empty table on either side gives an empty result.
    """
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    out = docs.sparkSession.createDataFrame([], _FOUND)

    def finder(items: Items):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, raw, at in blocks(batches, "text"):
                found = items.find(raw, at)
                ids = rows.column("doc_id").to_pylist()
                before = np.append(0, np.cumsum((raw & 0xC0) != 0x80)) if found else None
                lines = [(ids[t], items.ids[k], e, int(before[at[t] + a] - before[at[t]]),
                          int(before[at[t] + b] - before[at[t]])) for t, k, e, a, b in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in lines], pa.int64()) for c in range(5)],
                    ["doc_id", "item_id", "edits", "start", "end"])
        return work

    parts = [docs.mapInArrow(finder(items), _FOUND) for items in item_blocks(benchmark)]
    for p in parts:
        out = p if p is parts[0] else out.unionByName(p)
    return out


def drop_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all columns, that hold no benchmark item."""
    def dropper(items: Items):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, raw, at in blocks(batches, "text"):
                bad = {x[0] for x in items.find(raw, at)}
                yield rows.filter(pa.array([i not in bad for i in range(rows.num_rows)], pa.bool_())) if bad else rows
        return work

    for items in item_blocks(benchmark):
        docs = docs.mapInArrow(dropper(items), docs.schema)
    return docs
