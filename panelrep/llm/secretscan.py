"""Secret scans: all rules in one byte pass of a combined minimal automaton."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .automaton import Automaton, Rule
from .common import blocks

# The kinds of secrets, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 8,
         any_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", 12),  # 16 characters with AKIA
    Rule("hex", "", "[0-9a-f]", 32),
)
ADDED = (
    Rule("github", "gh[opsu]_", "[A-Za-z0-9]", 36),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
)
RULES = BASE + ADDED

DIGEST = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return Automaton(rules)


def spans_of(raw: np.ndarray, at: np.ndarray, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """Per text its (start, rule, end) in code points, by start and then rule."""
    out: list[list] = [[] for _ in range(len(at) - 1)]
    found = automaton(rules).spans(raw, at)
    if found:
        before = np.append(0, np.cumsum((raw & 0xC0) != 0x80))  # code points that begin before a byte
        for t, k, a, b in found:
            lo = int(at[t])
            out[t].append((int(before[lo + a] - before[lo]), k, int(before[lo + b] - before[lo])))
        for spans in out:
            spans.sort()
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end; code points, end exclusive) of every whole text.

    Null texts are empty; rows with null ids and repeated rows are rows of
    their own; an empty table gives an empty result; other columns are not read.
    """
    schema = T.StructType().add("doc_id", "long").add(
        "spans", T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long")))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            spans = [[{"kind": RULES[k].kind, "start": a, "end": b} for a, k, b in s] for s in spans_of(raw, at)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, sha256 of the base spans, and all spans as text."""
    def line(s) -> str:
        return ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in s)

    base = [r.kind for r in BASE]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = b.column("spans").to_pylist()
            own = [[x for x in s if x["kind"] in base] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array([sum(x["kind"] == k for x in s) for s in own], pa.int64())
                                       for k in base],
                 pa.array([hashlib.sha256(line(s).encode()).hexdigest() for s in own]),
                 pa.array([line(s) for s in spans])],
                ["doc_id", *[f"n_{k}" for k in base], "base_sha256", "spans"])

    return scanned.mapInArrow(work, DIGEST)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All columns and rows; in ``text`` every secret is replaced by ``mark`` and n_chars follows the new text.

    Spans of different kinds that overlap become one mark.
    """
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            found = spans_of(raw, at)
            if any(found):
                names = rows.schema.names
                texts = rows.column("text").to_pylist()
                sizes = rows.column("n_chars").to_pylist() if "n_chars" in names else None
                for i, spans in enumerate(found):
                    if not spans:
                        continue
                    out, last = [], 0
                    for a, _, b in spans:
                        if a >= last:
                            out += [texts[i][last:a], mark]
                        last = max(last, b)
                    texts[i] = "".join([*out, texts[i][last:]])
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                new = {"text": texts} | ({"n_chars": sizes} if sizes is not None else {})
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(new[c], rows.schema.field(c).type) if c in new else rows.column(c) for c in names],
                    schema=rows.schema)
            yield rows

    return docs.mapInArrow(work, schema)
