"""Token ids in wavelet-matrix files: bit-planes with rank and select, one compressed file per shard.

``write`` puts whole documents, in ascending doc_id order, into shards of about
``SHARD_IDS`` ids.  A shard's file is a Parquet file with one row, written by
Spark so that any store and retried tasks work; its payload holds the
wavelet matrix and the documents' ids and lengths.  ``read`` opens the files
again and gives every document's ids back.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import blocks

#: A shard is closed by the document that brings it to so many ids.
SHARD_IDS = 1 << 20
#: Words whose ids a process remembers; beyond it those met once are forgotten, which costs time only.
KNOWN_WORDS = 750_000
#: Bytes of text that are encoded at a time.
TEXT_BYTES = 4 << 20
MAGIC = b"WMX2"
_BLOCK = 512  # bits per entry of the rank directory
#: Marks that are a piece of their own where they end a word after a letter.
MARKS = ".,;:!?"
#: Latin letters, as a regular expression has them between brackets.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


class WaveletMatrix:
    """Bit-planes of a sequence, highest bit first; zeros of a plane go left, ones right, both in order.

    A plane has a rank directory, the ones before every block of ``_BLOCK``
    bits, which is stored with it.  Planes of a file are opened when first used,
    each for itself.
    """

    def __init__(self, n: int, zeros: list[int], planes: list) -> None:
        self.n, self.zeros, self.planes = n, zeros, planes  # (packed bytes, directory), or as in the file
        self.bits = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        now = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        zeros, planes = [], []
        for k in reversed(range(max(1, top.bit_length()))):
            one = (now & now.dtype.type(1 << k)) != 0
            bits = np.zeros(-(-len(now) // _BLOCK) * (_BLOCK // 8), np.uint8)
            bits[:-(-len(now) // 8)] = np.packbits(one, bitorder="little")
            ones = np.bitwise_count(bits.view(np.uint64)).reshape(-1, _BLOCK // 64).sum(axis=1, dtype=np.uint32)
            planes.append((bits, np.append(np.uint32(0), np.cumsum(ones, dtype=np.uint32))))
            low = np.flatnonzero(~one)  # places are faster than masks here
            zeros.append(len(low))
            now = np.concatenate([now.take(low), now.take(np.flatnonzero(one))])
        return cls(len(ids), zeros, planes)

    def plane(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Plane k, from the top, as packed bytes (low bit first, whole blocks), and its rank directory."""
        if not isinstance(self.planes[k], tuple):
            raw = zstandard.ZstdDecompressor().decompress(self.planes[k])
            size = -(-self.n // _BLOCK) * (_BLOCK // 8)
            self.planes[k] = (np.frombuffer(raw, np.uint8, size), np.frombuffer(raw, "<u4", -1, size))
        return self.planes[k]

    def opened(self) -> list[int]:
        """The planes that have been opened."""
        return [k for k in range(self.bits) if isinstance(self.planes[k], tuple)]

    def _rank1(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones before positions ``at`` of plane k: the directory's count, and the block's words up to there."""
        bits, directory = self.plane(k)
        words = np.append(bits.view(np.uint64).reshape(-1, _BLOCK // 64), np.zeros((1, _BLOCK // 64), np.uint64), axis=0) \
            if (at >= len(bits) * 8).any() else bits.view(np.uint64).reshape(-1, _BLOCK // 64)
        block, rest = at // _BLOCK, (at % _BLOCK)[:, None] - 64 * np.arange(_BLOCK // 64)[None, :]
        mask = np.where(rest >= 64, ~np.uint64(0), (np.uint64(1) << np.clip(rest, 0, 63).astype(np.uint64)) - np.uint64(1))
        return directory[block].astype(np.int64) + np.bitwise_count(words[block] & mask).sum(axis=1, dtype=np.int64)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at positions."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for k in range(self.bits):
            ones = self._rank1(k, at)
            bit = self._rank1(k, at + 1) - ones
            out = out * 2 + bit
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return out

    def count(self, value: int, end: int | None = None) -> int:
        """How often ``value`` occurs before position ``end`` (default: in all)."""
        lo, hi = self._descend(value, self.n if end is None else end)
        return hi - lo

    def _descend(self, value: int, end: int) -> tuple[int, int]:
        if value < 0 or value >> self.bits:
            return 0, 0
        lo, hi = 0, end
        for k in range(self.bits):
            a, b = self._rank1(k, np.array([lo, hi])).tolist()
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if value >> (self.bits - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def select(self, value: int, which: int) -> int:
        """Position of occurrence ``which`` (from 0) of ``value``; -1 if there are not so many."""
        lo, hi = self._descend(value, self.n)
        at = lo + which
        if which < 0 or at >= hi:
            return -1
        for k in reversed(range(self.bits)):
            one = value >> (self.bits - 1 - k) & 1
            at = self._select(k, at - self.zeros[k] if one else at, one)
        return at

    def _select(self, k: int, which: int, one: int) -> int:
        lo, hi = 0, self.n - 1  # the first position with more than ``which`` such bits up to it
        while lo < hi:
            mid = (lo + hi) // 2
            ones = int(self._rank1(k, np.array([mid + 1]))[0])
            if (ones if one else mid + 1 - ones) > which:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, i) for i in range(self.count(value))]

    def decode(self) -> np.ndarray:
        """The whole sequence: the planes' orders undone from the lowest plane up."""
        now = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in reversed(range(self.bits)):
            one = np.unpackbits(self.plane(k)[0], count=self.n, bitorder="little").view(bool)
            out = np.empty_like(now)
            out[np.flatnonzero(one)] = now[self.zeros[k]:] | now.dtype.type(1 << (self.bits - 1 - k))
            out[np.flatnonzero(~one)] = now[:self.zeros[k]]
            now = out
        return now

    def to_bytes(self) -> bytes:
        press = zstandard.ZstdCompressor(level=1).compress
        parts = [press(b"".join(x.tobytes() for x in self.plane(k))) for k in range(self.bits)]
        head = struct.pack("<4sQB", MAGIC, self.n, self.bits)
        return b"".join([head, *(struct.pack("<QI", z, len(p)) for z, p in zip(self.zeros, parts)), *parts])

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[WaveletMatrix, int]:
        """The matrix, its planes still closed, and the bytes it took."""
        magic, n, bits = struct.unpack_from("<4sQB", raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        at = struct.calcsize("<4sQB")
        marks = [struct.unpack_from("<QI", raw, at + 12 * k) for k in range(bits)]
        at += 12 * bits
        planes = []
        for _, size in marks:
            planes.append(raw[at:at + size])
            at += size
        return cls(n, [z for z, _ in marks], planes), at


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A shard's payload: wavelet matrix, then documents' ids (and which are null) and lengths."""
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<i8").tobytes() + known.tobytes()
    return WaveletMatrix.build(ids).to_bytes() + struct.pack("<Q", len(doc_ids)) + zstandard.compress(docs, 1)


def unpack(raw: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """(matrix, documents' ids, their lengths) of a payload."""
    matrix, at = WaveletMatrix.from_bytes(raw)
    n, = struct.unpack_from("<Q", raw, at)
    docs = zstandard.decompress(raw[at + 8:])
    known = np.frombuffer(docs, np.uint8, n, 16 * n)
    found = [int(d) if k else None for d, k in zip(np.frombuffer(docs, "<i8", n).tolist(), known)]
    return matrix, found, np.frombuffer(docs, "<i8", n, 8 * n)


def _spelling() -> str:
    """The letter that byte-level models have for each byte, but a space for byte 0, which parts words here."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return " " + "".join(chr(b if b in seen else next(rest)) for b in range(256))[1:]


_SPELLING = _spelling()


class ByteBpe:
    """The tokenizers library, asked once for each word that it has not met lately.

    Its pre-tokenizer begins a new piece at every single space, so a text's
    ids are those of its words; a text with two spaces in a row is encoded whole.
    A mark at a word's end after a letter is a piece of its own as well, so a
    word is met with and without it once.  Words of Latin letters are one piece
    each and go to the library's model without its pre-tokenizer, spelled in the
    model's letters, one for each byte.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        before = spec.get("pre_tokenizer") or {}
        self.by_word = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and \
            not before.get("add_prefix_space") and before.get("use_regex", True) and \
            not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_mark = self.by_word and not any(re.search(f"[{LETTERS}][{MARKS}]", t) for t in added)
        self.by_letters = self.by_word and not any(re.fullmatch(f"[{LETTERS}]+", t) for t in added)
        self.plain = Tokenizer(self.lib.model)
        self.plain.pre_tokenizer = CharDelimiterSplit(" ")
        self.marks = np.concatenate(self._encode(list(MARKS))).astype(np.int64)
        self.by_mark = self.by_mark and len(self.marks) == len(MARKS)
        # a token's string has one character per byte (an added token's, for ASCII, too)
        size = {i: len(t) for t, i in self.lib.get_vocab(with_added_tokens=True).items()}
        self.token_bytes = np.array([size.get(i, 0) for i in range(max(size) + 1)], np.int64)
        self.known = pa.array([], pa.large_string())  # words that begin with a space, without it
        self.pool, self.start = np.zeros(0, "<u4"), np.zeros(1, np.int64)  # their ids, and where each word's begin
        self.met = np.zeros(0, bool)  # whether a later block had the word again

    def _encode(self, texts: list[str], plain: bool = False) -> list[np.ndarray]:
        lib = self.plain if plain else self.lib
        if plain:
            texts = [codecs.charmap_decode(t.encode(), "strict", _SPELLING)[0] for t in texts]
        return [np.array(e.ids, "<u4") for e in lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: pa.Array, plain: bool, together: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each word's end) of words that begin with a space, given without it.

        Many words are encoded at a time and told apart by their tokens' bytes;
        where that does not work out, the words of that text one by one.
        ``plain`` words are of Latin letters only.
        """
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        head, between = " ", "\0 " if plain else " "
        size = pc.binary_length(words).to_numpy().astype(np.int64) + 1
        names, pool, ends, done = words.to_pylist(), [], [], 0
        for lo in range(0, len(names), 32 * together):  # the library's results are many times the size of the words
            some = range(lo, min(len(names), lo + 32 * together), together)
            for k, ids in zip(some, self._encode([head + between.join(names[k:k + together]) for k in some], plain)):
                want, have = np.cumsum(size[k:k + together]), np.cumsum(self.token_bytes[ids])
                at = np.searchsorted(have, want)
                if len(have) and have[-1] == want[-1] and (have[at] == want).all():
                    at += 1
                else:
                    each = self._encode([head + w for w in names[k:k + together]], plain)
                    ids, at = np.concatenate(each), np.cumsum([len(e) for e in each])
                pool.append(ids)
                ends.append(at + done)
                done += len(ids)
        return np.concatenate(pool), np.concatenate(ends)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers; null and empty texts have none."""
        ids, n = self.encode_column(pa.array(texts, pa.large_string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(n)[:-1])] if len(n) else []

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words, each meant with a space before it, in the tables; unknown ones are added."""
        if len(self.known) + len(words) > KNOWN_WORDS:
            self._forget()
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(at.is_null())
        at = at.to_numpy(zero_copy_only=False).astype(np.float64)
        missing = np.isnan(at)
        self.met[at[~missing].astype(np.int64)] = True
        if len(new):
            plain = pc.match_substring_regex(new, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False) & self.by_letters
            at[missing] = len(self.known) + np.where(plain, np.cumsum(plain), plain.sum() + np.cumsum(~plain)) - 1
            for kind in (True, False):
                some = new.filter(pa.array(plain == kind))
                ids, ends = self._words(some, kind)
                self.known = pa.concat_arrays([self.known, some])
                self.pool = np.concatenate([self.pool, ids])
                self.start = np.concatenate([self.start, self.start[-1] + ends])
            self.met = np.concatenate([self.met, np.zeros(len(new), bool)])
        return at.astype(np.int64)

    def _forget(self) -> None:
        """Drops the words that no later block has had again; all, where the others are many."""
        keep = np.flatnonzero(self.met)
        keep = keep if len(keep) <= KNOWN_WORDS // 2 else keep[:0]
        size = self.start[keep + 1] - self.start[keep]
        ends = np.cumsum(size)
        self.pool = self.pool[np.repeat(self.start[keep] - (ends - size), size) + np.arange(size.sum())]
        self.known, self.start = self.known.take(pa.array(keep)), np.append(0, ends)
        self.met = np.zeros(len(keep), bool)

    def _cores(self, words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Words without the mark that ends them after a letter, and the id of that mark, -1 where there is none."""
        marks = np.full(len(words), -1, np.int64)
        if self.by_mark:
            ended = pc.match_substring_regex(words, f"[{LETTERS}][{MARKS}]$")
            last = pc.utf8_slice_codeunits(words.filter(ended), -1)
            which = pc.index_in(last, value_set=pa.array(list(MARKS), last.type)).to_numpy(zero_copy_only=False)
            marks[ended.to_numpy(zero_copy_only=False)] = self.marks[which.astype(np.int64)]
            words = pc.if_else(ended, pc.utf8_slice_codeunits(words, 0, -1), words)
        return words.dictionary_encode(), marks

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); null and empty texts have none.

        Arrow splits the texts, numbers their words and finds them among those
        that are known, so Python sees the new words only, and the first of each text.
        """
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, "\x00")) if self.by_word \
            else pc.not_equal(texts, "")
        pieces = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        at = pieces.offsets.to_numpy().astype(np.int64)
        words = pieces.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at -= at[0]
        cores, marks = self._cores(words.dictionary)
        number = self._learn(cores.dictionary)[cores.indices.to_numpy()][words.indices.to_numpy()]
        # a text's first word has no space before it
        first = words.indices.take(pa.array(at[:-1])).to_numpy()
        names, which = np.unique(first, return_inverse=True)
        heads = self._encode(words.dictionary.take(pa.array(names)).to_pylist())
        pool = np.concatenate([self.pool, *heads, np.zeros(1, "<u4")])  # the last is no word's
        start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(h) for h in heads])]).astype(np.int64)
        number[at[:-1]] = len(self.start) - 1 + which
        mark = marks[words.indices.to_numpy()]
        mark[at[:-1]] = -1
        marked = np.flatnonzero(mark >= 0)
        n = start[number + 1] - start[number]
        n[marked] += 1
        before = np.append(0, np.cumsum(n))
        ids = pool[np.repeat(start[number] - before[:-1], n) + np.arange(before[-1])]
        ids[before[marked + 1] - 1] = mark[marked]
        lengths = before[at[1:]] - before[at[:-1]]
        odd = odd.to_numpy(zero_copy_only=False)
        # other white space between two spaces is one piece with them
        blank = pc.match_substring_regex(words.dictionary, r"^[\s\pZ\x0b\x1c-\x1f\x{85}]+$").to_numpy(zero_copy_only=False)
        if blank.any():
            odd = odd | np.logical_or.reduceat(blank[words.indices.to_numpy()], at[:-1])
        whole = np.flatnonzero(odd)
        if len(whole):
            parts, ends = np.split(ids, np.cumsum(lengths)[:-1]), self._encode([texts[i].as_py() for i in whole.tolist()])
            for i, e in zip(whole.tolist(), ends):
                parts[i], lengths[i] = e, len(e)
            ids = np.concatenate(parts)
        return ids, lengths


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


_FILE = "part int, shard int, before long, n_ids long, payload binary"


def write(docs: DataFrame, target: str, path: str, end_id: int = 2, shard_ids: int = SHARD_IDS) -> None:
    """Encodes whole texts and writes them as shard files under ``target``, in ascending doc_id order.

    Rows are dealt into key ranges by (doc_id, hash of the text); shards of a
    range follow each other and ``before`` counts its ids before a shard.  Null
    ids come first, null texts have the end id only, repeated rows are rows of
    their own; an empty table writes an empty folder of files.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = tokenizer(path), TaskContext.get().partitionId()
        docs_, lengths, parts, held, before, shard = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([pack(docs_, lengths, ids)], pa.binary())],
                ["part", "shard", "before", "n_ids", "payload"])

        for rows, _, _ in blocks(batches, "text", TEXT_BYTES):
            ids, n = bpe.encode_column(rows.column("text"))
            ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
            ends, names, lo = np.cumsum(n), rows.column("doc_id").to_pylist(), 0
            while lo < len(n):
                start = int(ends[lo] - n[lo])
                # up to the document that fills the shard
                hi = min(len(n), int(np.searchsorted(ends, start + shard_ids - held, "left")) + 1)
                docs_ += names[lo:hi]
                lengths += n[lo:hi].tolist()
                parts.append(ids[start:ends[hi - 1]])
                held += int(ends[hi - 1]) - start
                lo = hi
                if held >= shard_ids:
                    yield close()
                    before, shard, held = before + held, shard + 1, 0
                    docs_, lengths, parts = [], [], []
            pa.default_memory_pool().release_unused()
        if docs_:
            yield close()

    tie = F.xxhash64("text")
    (docs.selectExpr("cast(doc_id as long) doc_id", "text").repartitionByRange("doc_id", tie)
     .sortWithinPartitions("doc_id", tie).mapInArrow(work, _FILE)
     .write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(target))


def read(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, decoded from the shard files.

    The ranges' totals that every task gets are one row per range: at most as
    many as the shuffle partitions of the session that wrote the files.
    """
    files = spark.read.schema(_FILE).parquet(target)
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("ids_before"))
    placed = files.join(F.broadcast(totals), "part").select((F.col("ids_before") + F.col("before")).alias("start"),
                                                            "payload")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, payload in zip(batch.column("start").to_pylist(), batch.column("payload")):
                matrix, docs, lengths = unpack(payload.as_py())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(begin + ends - lengths), pa.array(lengths.astype(np.int64)),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Writes the shard files into a scratch folder of the shared checkpoint folder and reads them back."""
    spark = docs.sparkSession
    target = f"{scratch_folder(spark, 'wavelet')}/ids"
    write(docs, target, path, end_id)
    return read(spark, target)
