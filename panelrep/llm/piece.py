"""SentencePiece BPE encoding and decoding by vectorised merge rounds over flat numpy symbol arrays."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import blocks
from .wordcache import WordCache

SPACE = "▁"  # the tokenizer's mark for a space
_NONE = np.iinfo(np.int32).max
BLOCK = 2 << 20
#: Characters from which a word is cut where no piece reaches, and symbols from which what is left of it goes one merge
#: at a time from a heap: a round of all words would take only one of its places.
LONG_WORD, LONG_PART = 48, 384


class PieceModel:
    """Vocabulary and merge tables of a BPE model file with byte fallback and identity normalisation.

    ``merged(u, v)``: the piece that two neighbouring symbols make, if any.
    Symbols are piece ids, then single characters that are in pieces without
    being one, then all other characters.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = [not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)) for i in range(n)]
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.size = n
        ident = {p: i for i, p in enumerate(pieces) if plain[i]}
        score = np.array([lib.get_score(i) for i in range(n)])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        extra = sorted({c for p in ident for c in p} - ident.keys())
        symbol = ident | {c: n + i for i, c in enumerate(extra)}
        self.others = n + len(extra)  # then code points
        self.single = np.full(0x110000, -1, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.single[ord(s)] = i
        pairs = [(symbol[p[:k]], symbol[p[k:]], i) for p, i in ident.items() for k in range(1, len(p))
                 if p[:k] in symbol and p[k:] in symbol]
        u, v, to = (np.array(x, np.int64) for x in zip(*pairs))
        self._hash(u, v, to)
        # whether merging all places of a piece at once keeps the order of single merges:
        # no pair that the piece takes part in may come before it, and no other piece may tie with it
        first = np.full(self.others, _NONE, np.int64)
        np.minimum.at(first, u, self.rank[to])
        np.minimum.at(first, v, self.rank[to])
        own = self.rank[list(ident.values())]
        count = np.bincount(own, minlength=self.rank.max() + 1)
        self.safe = (first[:n] > self.rank) & (count[self.rank] == 1)
        # spaces only at the start of pieces: words can be encoded one by one
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in ident)
        self.inside = np.unique(np.array([ord(a) * 0x110000 + ord(b) for p in ident for a, b in zip(p, p[1:])], np.int64))
        self.byte_id = np.array([next((i for i in range(n) if lib.is_byte(i) and pieces[i] == f"<0x{b:02X}>"), -1)
                                 for b in range(256)], np.int32)
        out = [b"" if lib.is_control(i) else bytes([int(pieces[i][1:-1], 16)]) if lib.is_byte(i)
               else pieces[i].replace(SPACE, " ").encode() for i in range(n)]
        self.out_len = np.array([len(x) for x in out], np.int64)
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out = np.frombuffer(b"".join(out), np.uint8)
        self.pairs: dict[tuple[int, int], tuple[int, int]] | None = None
        self.cache = WordCache(self.encode_words, 350_000)

    def _hash(self, u: np.ndarray, v: np.ndarray, to: np.ndarray) -> None:
        """Two-probe table of the pairs: a slot of the first probe, else one of the second."""
        key, bits = u * self.others + v, 20
        while True:
            rest = np.arange(len(key))
            tables = []
            for multiplier in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                at = self._slot(key[rest], multiplier, bits)
                _, first = np.unique(at, return_index=True)
                keys, values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
                keys[at[first]], values[at[first]] = key[rest[first]], to[rest[first]]
                tables.append((multiplier, keys, values))
                rest = np.delete(rest, first)
            if not len(rest):
                self.tables, self.bits = tables, bits
                return
            bits += 1

    @staticmethod
    def _slot(key: np.ndarray, multiplier: int, bits: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(multiplier)) >> np.uint64(64 - bits)).astype(np.int64)

    def merged(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Piece ids of the pairs, -1 where they make none."""
        out = np.full(len(u), -1, np.int32)
        able = np.flatnonzero((u < self.others) & (v < self.others))
        key = u[able].astype(np.int64) * self.others + v[able]
        for multiplier, keys, values in self.tables:
            at = self._slot(key, multiplier, self.bits)
            hit = keys[at] == key
            out[able[hit]] = values[at[hit]]
            able, key = able[~hit], key[~hit]
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of words in which spaces are already marked."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(w) for w in words], np.int64)
        sym = self.single[text].astype(np.int64)
        unknown = sym < 0
        sym[unknown] = self.others + text[unknown]
        word = np.repeat(np.arange(len(words)), size)
        if len(size) and size.max() > LONG_WORD:
            part = self._parts(text, word, size)
            length = np.bincount(part)
            owner = word[np.cumsum(length) - length]
            long = np.flatnonzero(length > LONG_PART)
        else:
            part, owner, long = word, np.arange(len(words)), ()
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if len(long):
            at, live = np.append(0, np.cumsum(length)), np.ones(len(sym), bool)
            for p in long.tolist():
                found = self._one_by_one(sym[at[p]:at[p + 1]].tolist())
                done.append((np.full(len(found), p), np.array(found, np.int64)))
                live[at[p]:at[p + 1]] = False
            sym, part = sym[live], part[live]
        flat, order_part = self._rounds(sym, part, done)
        flat, order_word = self._fallback(flat, owner[order_part])
        raw = flat.astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(order_word, minlength=len(words))) * 4
        return [raw[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]

    def _parts(self, text: np.ndarray, word: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The part that every character belongs to: long words are cut between characters that no piece has together.

        No merge crosses such a cut, so the parts' merges are those of the word.
        """
        cut = np.append(False, word[1:] != word[:-1]) if len(word) else np.zeros(0, bool)
        able = np.flatnonzero((size[word[1:]] > LONG_WORD) & ~cut[1:]) + 1
        key = text[able - 1] * 0x110000 + text[able]
        at = np.minimum(np.searchsorted(self.inside, key), len(self.inside) - 1)
        cut[able[self.inside[at] != key]] = True
        return np.cumsum(cut)

    def _one_by_one(self, sym: list[int]) -> list[int]:
        """The merges of a long part in their order, lowest rank first and then leftmost, from a heap of its pairs."""
        if self.pairs is None:
            self.pairs = {(int(k) // self.others, int(k) % self.others): (int(self.rank[v]), int(v))
                          for _, keys, values in self.tables for k, v in zip(keys[keys >= 0], values[keys >= 0])}
        n, pairs = len(sym), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*found, i, sym[i], sym[i + 1]) for i in range(n - 1)
                if (found := pairs.get((sym[i], sym[i + 1]))) is not None]
        heap = [(r, i, u, v, to) for r, to, i, u, v in heap]
        heapq.heapify(heap)
        while heap:
            _, i, u, v, to = heapq.heappop(heap)
            j = after[i]
            if sym[i] != u or j >= n or sym[j] != v:
                continue  # one of the two is part of another piece by now
            sym[i], sym[j] = to, -1
            k, p = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (found := pairs.get((to, sym[k]))) is not None:
                    heapq.heappush(heap, (found[0], i, to, sym[k], found[1]))
            if p >= 0 and (found := pairs.get((sym[p], to))) is not None:
                heapq.heappush(heap, (found[0], p, sym[p], to, found[1]))
        return [s for s in sym if s >= 0]

    def _rounds(self, sym: np.ndarray, word: np.ndarray, done: list[tuple[np.ndarray, np.ndarray]]) \
            -> tuple[np.ndarray, np.ndarray]:
        """(symbols, their words) after all merges, in the words' order, with those that are done already."""
        to = self._pairs(sym, word)
        while len(sym):
            rank = np.where(to >= 0, self.rank[to], _NONE)
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            length = np.diff(starts, append=len(sym))
            live = np.repeat(best < _NONE, length)
            if not live.all():
                done.append((word[~live], sym[~live]))
                sym, word, to, rank = sym[live], word[live], to[live], rank[live]
                length, best = length[best < _NONE], best[best < _NONE]
                if not len(sym):
                    break
                starts = np.cumsum(length) - length
            here = rank == np.repeat(best, length)
            place = np.flatnonzero(here)
            # the leftmost place of each word; where it is safe, all places that do not overlap one before them
            begin = np.flatnonzero(np.diff(place, prepend=-2) != 1)
            run = np.arange(len(place)) - np.repeat(begin, np.diff(begin, append=len(place)))
            first = np.diff(word[place], prepend=-1) != 0
            # a run of overlapping places never spans words: the last symbol of a word begins no pair
            take = place[first | (self.safe[to[place]] & (run % 2 == 0))]
            sym[take] = to[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            moved = np.zeros(len(sym), bool)
            moved[take] = True
            moved[np.maximum(take - 1, 0)] = True
            sym, word, to, moved = sym[keep], word[keep], to[keep], moved[keep]
            fresh = moved | np.append(moved[1:], False)
            to[fresh] = self._pairs(sym, word, np.flatnonzero(fresh))
        order_word = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
        flat = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(order_word, kind="stable")
        return flat[order], order_word[order]

    def _pairs(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """What the symbols (at ``at``, or all) make with the next one of their word."""
        at = np.arange(len(sym)) if at is None else at
        out = np.full(len(at), -1, np.int32)
        inside = np.flatnonzero(at + 1 < len(sym))
        inside = inside[word[at[inside]] == word[at[inside] + 1]]
        out[inside] = self.merged(sym[at[inside]], sym[at[inside] + 1])
        return out

    def _fallback(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become their UTF-8 bytes' pieces, or the unknown id where there are none."""
        odd = np.flatnonzero(sym >= self.size)
        if not len(odd):
            return sym, word
        code = np.zeros(len(odd), np.int64)
        beyond = sym[odd] >= self.others
        code[beyond] = sym[odd[beyond]] - self.others
        if not beyond.all():
            back = {int(s): c for c, s in enumerate(self.single.tolist()) if s >= self.size}
            code[~beyond] = [back[int(s)] for s in sym[odd[~beyond]]]
        parts = [self.byte_id[list(chr(c).encode("utf-8", "surrogatepass"))] for c in code.tolist()]
        parts = [p if (p >= 0).all() else np.array([self.unknown]) for p in parts]
        count = np.ones(len(sym), np.int64)
        count[odd] = [len(p) for p in parts]
        ends = np.cumsum(count)
        out = np.repeat(sym, count)
        spot = np.concatenate([np.arange(e - c, e) for e, c in zip(ends[odd].tolist(), count[odd].tolist())])
        out[spot] = np.concatenate(parts)
        return out, np.repeat(word, count)

    def words(self, text: str) -> list[str]:
        """The text with a space before it, spaces marked, cut before each run of marks."""
        if not text:
            return []
        if not self.by_word:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " ":
            return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE)).split(" ")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of whole texts (null: empty), each with the begin and the end id."""
        begin, end = (np.array([x], "<u4").tobytes() for x in (self.begin, self.end))
        split = [self.words(t or "") for t in texts]
        known = self.cache.add({w for s in split for w in s})
        parts = [b"".join([begin, *map(known.__getitem__, s), end]) for s in split]
        at = np.append(0, np.cumsum([len(p) // 4 for p in parts], dtype=np.int64))
        return np.frombuffer(b"".join(parts), "<u4").astype(np.int64), at

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, offsets) of the texts of encoded ids: pieces joined, without the space put before a text."""
        size = self.out_len[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.out_at[ids] - (ends - size), size)
        raw = self.out[source]
        edge = np.append(0, ends)[at]
        first = edge[:-1][(np.diff(edge) > 0)]
        drop = first[raw[first] == 32] if len(first) else first
        keep = np.ones(total, bool)
        keep[drop] = False
        gone = np.searchsorted(drop, edge)
        return raw[keep], edge - gone


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


Finish = Callable[[PieceModel, np.ndarray, np.ndarray], list[pa.Array]]


def encode(docs: DataFrame, path: str, keep: list[str], finish: Finish, added: T.StructType) -> DataFrame:
    """Columns ``keep`` of every document, and what ``finish(model, ids, offsets)`` makes of the encoded texts.

    Null texts are empty and get the begin and end ids only.  Repeated rows are
    rows of their own; an empty table gives an empty result.
    """
    schema = T.StructType([*(docs.schema[c] for c in keep), *added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for rows, _, _ in blocks(batches, "text", BLOCK):
            ids, at = m.encode(rows.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *finish(m, ids, at)],
                                             [*keep, *added.names])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(work, schema)


def id_lists(m: PieceModel, ids: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """n_tokens and ids of each text."""
    return [pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))]


ID_LISTS = T.StructType().add("n_tokens", "long").add("ids", T.ArrayType(T.IntegerType()))


def digests(m: PieceModel, ids: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """n_tokens, sha256 of the ids and sha256 of the text decoded from them."""
    small, (raw, edge) = ids.astype("<u4"), m.decode(ids, at)
    return [pa.array(np.diff(at)),
            pa.array([hashlib.sha256(small[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]),
            pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())])]


DIGESTS = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
