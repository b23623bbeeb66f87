"""Operator 7: exact removal of long repeated byte strings, within and across documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm import hashed
from palimpsest.llm.common import Sieve, cut_lineage, slices, with_workers


SLICE = 1 << 20  # bytes of text worked on at once; numpy needs some 30 times as many


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each ``w`` neighbours (of their upper bits; the leftmost of equals)."""
    n = len(h)
    bits = np.uint64(w.bit_length())
    size = -(-n // w) * w
    key = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    key[:n] = (h >> bits << bits) | (np.arange(n, dtype=np.uint64) % np.uint64(w))
    blocks = key.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    s = np.arange(n - w + 1)
    left, right = back[s], ahead[s + w - 1]
    to_right = (right >> bits) < (left >> bits)
    block = np.where(to_right, (s + w - 1) // w, s // w)
    return block * w + (np.where(to_right, right, left) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _units(col: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, or with ``words`` the hashes of its words, and the rows' offsets into them."""
    if not words:
        return hashed.bytes_of(col)
    w = hashed.Words(col, lower=False)
    return w.hash, np.append(0, np.cumsum(w.counts()))


class Spans:
    """Anchors of a text column, for strings of ``length`` bytes (with ``words``: of so many words, and so on for all below).

    Each string of ``length`` bytes has an anchor, the ``core``-byte piece of
    it with the least hash: equal strings have equal anchors at equal offsets,
    wherever they stand. The strings with one anchor start at neighbouring
    bytes ``first`` to ``last`` (offsets in the joined bytes of the column).
    ``piece`` is the hash of the anchor, ``whole`` that of all bytes of these
    strings together and of the anchor's place among them.
    """

    def __init__(self, col: pa.Array, length: int, core: int, words: bool = False):
        self.data, self.offsets = _units(col, words)
        self.length, self.n = length, len(self.data)
        self.sums = hashed.prefix_sums(self.data)
        self.inverse = hashed.powers(hashed._INVERSE, self.n + 1)
        empty = np.empty(0, np.int64)
        self.row, self.first, self.last, anchor = empty, empty, empty, empty
        if self.n >= length:
            piece = self.hash(np.arange(self.n - core + 1), core)
            at = sliding_argmin(piece, length - core + 1)
            row = np.searchsorted(self.offsets, np.arange(self.n - length + 1), side="right") - 1
            inside = np.flatnonzero(np.arange(self.n - length + 1) + length <= self.offsets[row + 1])
            at, row = at[inside], row[inside]
            new = np.ones(len(inside), bool)
            new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(inside)) - 1 if len(begin) else begin
            self.row, self.first, self.last, anchor = row[begin], inside[begin], inside[end], at[begin]
        self.piece = self.hash(anchor, core) if len(anchor) else np.empty(0, np.uint64)
        size = self.last - self.first + length
        self.whole = hashed.mix(self.hash(self.first, size) + (anchor - self.first).astype(np.uint64) * np.uint64(1 << 32) + size.astype(np.uint64))

    def hash(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return hashed.mix((self.sums[start + size] - self.sums[start]) * self.inverse[start])

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """A key of each row, from its id and its bytes (not for words)."""
        size = np.diff(self.offsets)
        h = hashed.mix((self.sums[self.offsets[1:]] - self.sums[self.offsets[:-1]]) * self.inverse[self.offsets[:-1]] + size.astype(np.uint64))
        return hashed.mix(h + hashed.mix(ids.astype(np.uint64))).astype(np.int64)


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _keys(col: pa.Array, ids: pa.Array) -> np.ndarray:
    s = Spans.__new__(Spans)
    data, s.offsets = hashed.bytes_of(col)
    s.sums, s.inverse = hashed.prefix_sums(data), hashed.powers(hashed._INVERSE, len(data) + 1)
    return s.keys(ids.to_numpy())


def _keyed(rows: DataFrame, sieve: Sieve | None = None, keep: bool = True) -> DataFrame:
    """``rows`` (``id``, ``text`` and others) with ``key`` in place of ``id``; with ``sieve`` those that may be in it (or not ``keep``: the others).

    One pass through Python does both, so that an executor runs one worker a task.
    """
    names = ["key", *rows.columns[1:]]

    def run(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            key = _keys(b.column(1), b.column(0))
            out = pa.RecordBatch.from_arrays([_i64(key), *b.columns[1:]], names=names)
            yield out.filter(pa.array(sieve.may_hold(key) == keep)) if sieve else out
    return rows.mapInArrow(run, rows.withColumnRenamed("id", "key").schema)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64))


def repeated_spans(docs: DataFrame, length: int = 400, core: int = 200, doc_id: str = "doc_id", text: str = "text",
                   words: bool = False) -> DataFrame:
    """Byte ranges covered by strings of ``length`` bytes that start anywhere else too: ``(key, spans)``.

    With ``words``, ``length`` and ``core`` count words (runs without ASCII white space, equal byte for byte; the
    white space between may differ), and the ranges are of the text's words by number.

    ``key`` names a document (id and bytes, see ``Spans.keys``); ``spans`` are
    its ranges as structs of ``start`` and ``end``, sorted, possibly overlapping.
    Documents without any are left out.

    Anchors (about one in half of ``length - core`` bytes) stand for the
    strings around them, and strings that share no anchor piece with another
    place are dropped by counting pieces. Anchors whose whole surroundings
    occur twice are repeated throughout; counting these too shrinks copies of
    any number to sums. Only at the edges of copies, where the piece occurs
    elsewhere but the surroundings don't, are the single strings counted, each
    against those of one place of every other surrounding of its piece.
    """
    with_workers(docs.sparkSession)
    d = _documents(docs, doc_id, text)

    def pieces(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            s = Spans(b.column(1), length, core, words)
            yield pa.RecordBatch.from_arrays([_i64(s.piece), _i64(s.whole)], names=["piece", "whole"])

    twice = cut_lineage(d.mapInArrow(pieces, "piece long, whole long").groupBy("piece")
             .agg(F.count("*").alias("places"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
             .where("places > 1").select("piece", (F.col("lo") != F.col("hi")).alias("mixed")))
    some = Sieve(twice, F.col("piece"))  # most pieces stand once and need not be shuffled again

    def anchors(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            s = Spans(b.column(1), length, core, words)
            key = _keys(b.column(1), b.column(0)) if words else s.keys(b.column(0).to_numpy())
            at = s.offsets[s.row]
            may = some.may_hold(s.piece.astype(np.int64))
            cols = [s.piece, s.whole, key[s.row], s.first - at, s.last - at]
            yield pa.RecordBatch.from_arrays([_i64(c[may]) for c in cols], names=["piece", "whole", "key", "first", "last"])

    found = cut_lineage(d.mapInArrow(anchors, "piece long, whole long, key long, first long, last long").join(twice, "piece"))
    # where all places of a piece have one surrounding they are copies; else the surroundings are counted
    counted = (found.where("mixed").groupBy("piece", "whole")
               .agg(F.count("*").alias("places"), F.min(F.struct("key", "first", "last")).alias("one")))
    counted = cut_lineage(counted)
    copies = (found.where("NOT mixed").select("key", "first", "last")
              .union(found.where("mixed").join(counted.where("places > 1").select("piece", "whole"), ["piece", "whole"]).select("key", "first", "last")))
    # edges: each surrounding of a mixed piece once, with its strings one by one
    asked = counted.select("one.*", (F.col("places") == 1).alias("edge")).groupBy("key").agg(
        F.collect_list(F.struct("first", "last", "edge")).alias("asked"))

    def strings(batches: Iterator, sieve: Sieve | None = None) -> Iterator:
        for b in slices(batches, 1, SLICE):
            data, offsets = _units(b.column(1), words)
            sums, inverse = hashed.prefix_sums(data), hashed.powers(hashed._INVERSE, len(data) + 1)
            ask = b.column(2)
            part = ask.flatten()
            of = np.repeat(np.arange(b.num_rows), ask.value_lengths().to_numpy())
            first, last = (part.field(k).to_numpy() for k in (0, 1))
            edge = part.field(2).to_numpy(zero_copy_only=False)
            n = last - first + 1
            which = np.repeat(np.arange(len(n)), n)
            start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[which]
            place = offsets[of[which]] + start
            h = hashed.mix((sums[place + length] - sums[place]) * inverse[place])
            take = np.arange(len(h))
            if sieve:  # the second time: strings of edges that may occur twice
                take = np.flatnonzero(edge[which] & sieve.may_hold(h.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([_i64(h[take]), b.column(0).take(pa.array(of[which[take]])), _i64(start[take])], names=["string", "key", "start"])
    asked = cut_lineage(asked)
    ddl = "string long, key long, start long"
    keyed = _keyed(d, Sieve(asked, F.col("key"))).dropDuplicates(["key"]).join(asked, "key")
    again = cut_lineage(keyed.mapInArrow(strings, ddl).groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string"))
    twice_there = Sieve(again, F.col("string"))
    edges = (keyed.mapInArrow(lambda batches: strings(batches, twice_there), ddl).join(again, "string")
             .select("key", F.col("start").alias("first"), F.col("start").alias("last")))
    return (copies.union(edges).select("key", "first", (F.col("last") + length).alias("end"))
            .groupBy("key").agg(F.sort_array(F.collect_set(F.struct(F.col("first").alias("start"), "end"))).alias("spans")))


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by ranges that are sorted by start."""
    out: list[tuple[int, int]] = []
    for a, z in zip(starts.tolist(), ends.tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _with_spans(docs: DataFrame, length: int, core: int, doc_id: str, text: str, words: int = 0) -> DataFrame:
    """The rows of ``docs`` (as struct ``r``) with ``text`` and their ``spans`` (null where nothing repeats).

    With ``words``, ``runs`` are the ranges of words covered by repeats of so many.
    """
    spans = cut_lineage(repeated_spans(docs, length, core, doc_id, text))
    if words:
        runs = cut_lineage(repeated_spans(docs, words, words // 2, doc_id, text, words=True))
        spans = cut_lineage(spans.join(runs.withColumnRenamed("spans", "runs"), "key", "full_outer"))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("r"))
    some = Sieve(spans, F.col("key"))  # documents without repeats are not shuffled
    cut, whole = (_keyed(rows, some, keep) for keep in (True, False))
    out = cut.join(spans, "key", "left").select("r", "text", *spans.columns[1:])
    return out.union(whole.select("r", "text", *[F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in spans.columns[1:]]))


def _runs(spans) -> list[tuple[int, int]]:
    if not spans.is_valid:
        return []
    v = spans.values
    return merged(v.field(0).to_numpy(), v.field(1).to_numpy())


def _word_runs(text, runs) -> list[tuple[int, int]]:
    """Byte ranges of runs of words, each with the white space after it (and before it, where the text begins with it)."""
    words = _runs(runs)
    if not words:
        return []
    w = hashed.Words(pa.array([text.as_py()], pa.string()))
    start = np.append(w.start, len(w.data))
    return [(int(start[a]) if a else 0, int(start[z])) for a, z in words]


def removal_report(docs: DataFrame, length: int = 400, core: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What removing repeated strings leaves: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, a row per row of ``docs``.

    A byte goes if a string of ``length`` bytes over it also starts anywhere
    else, in the same document or another; all places lose it, and strings are
    judged on the input. Null text is empty; texts shorter than ``length``
    keep everything; repeated rows are copies of each other.
    """
    rows = _with_spans(docs.select(doc_id, text), length, core, doc_id, text)

    def report(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            out = []
            for t, spans in zip(b.column(1), b.column(2)):
                raw = memoryview(t.as_buffer() or b"")
                runs, at, kept = _runs(spans), 0, hashlib.sha256()
                for a, z in runs:
                    kept.update(raw[at:a])
                    at = z
                kept.update(raw[at:])
                out.append((len(raw), sum(z - a for a, z in runs), len(runs), kept.hexdigest()))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([b.column(0).field(0), *[pa.array(c) for c in cols]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(report, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400, core: int = 200, words: int = 0) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` (same columns; ``n_chars``, where present, is counted anew).

    With ``words``, every run of so many words that stands anywhere else goes
    too, however few its bytes, with the white space after it; both are judged
    on the input. A character that a cut runs through goes whole. Rows that
    lose all their text are dropped.
    """
    rows = _with_spans(docs, length, core, "doc_id", "text", words)

    def cut(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            out, changed = [], []
            for t, spans, *more in zip(*b.columns[1:]):
                raw, at, parts = bytes(t.as_buffer() or b""), 0, []
                runs = _runs(spans)
                if more and more[0].is_valid:
                    ranges = sorted(runs + _word_runs(t, more[0]))
                    runs = merged(*(np.array(x) for x in zip(*ranges)))
                for a, z in runs:
                    parts.append(raw[at:a])
                    at = z
                parts.append(raw[at:])
                out.append("".join(p.decode("utf-8", "ignore") for p in parts) if runs else t.as_py())
                changed.append(bool(runs))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(changed)], names=["r", "t", "changed"])

    schema = T.StructType([rows.schema["r"], T.StructField("t", T.StringType()), T.StructField("changed", T.BooleanType())])
    done = rows.mapInArrow(cut, schema).where("NOT changed OR t <> ''")
    pick = {"text": F.col("t"), "n_chars": F.when(F.col("changed"), F.length("t")).otherwise(F.col("r.n_chars") if "n_chars" in docs.columns else None)}
    return done.select(*[(pick[c].cast(docs.schema[c].dataType) if c in pick else F.col(f"r.`{c}`")).alias(c) for c in docs.columns])
