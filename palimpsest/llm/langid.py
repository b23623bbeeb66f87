"""Operator 9: language identification by segmentation-marginalised unigrams over a fixed public vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import hashed
from palimpsest.llm.common import is_held_out, slices, with_workers
from palimpsest.llm.linear import score_column

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MAX_TRAIN = 2_000  # documents of each language used for the fit
SHORT = 24  # bytes of a word whose probability surely fits a double: its sum is made without logarithms
CELLS = 1 << 20  # numbers of lattices worked on at once, about
SLICE = 8 << 20  # bytes of text whose distinct words are scored together


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """All pieces of a ranked byte-level vocabulary file, and all single bytes."""
    with open(path, "rb") as f:  # on the driver only; tasks get the pieces by broadcast
        pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    return sorted({p for p in pieces if p} | {bytes([b]) for b in range(256)})


class Pieces:
    """Finds pieces by their hash: the polynomial of the bytes, and the length.

    Hashes are sorted; their upper bits name the few places where one can stand.
    """

    BITS = 20

    def __init__(self, pieces: list[bytes]):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - [len(p) for p in pieces]
        s, inverse = hashed.prefix_sums(data), hashed.powers(hashed._INVERSE, len(data) + 1)
        keys = hashed.mix((s[ends] - s[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        self.order = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.order]
        self.longest = max(len(p) for p in pieces)
        upper = (self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.start = np.searchsorted(upper, np.arange((1 << self.BITS) + 1)).astype(np.int32)
        self.most = int(np.diff(self.start).max())
        self.keys = np.append(self.keys, np.repeat(self.keys[-1:], self.most))  # a look beyond the last finds nothing new
        self.order = np.append(self.order, np.repeat(self.order[-1:], self.most))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where there is none."""
        at = self.start[(h >> np.uint64(64 - self.BITS)).astype(np.int64)]
        out = np.full(h.shape, -1, np.int32)
        for step in range(self.most):
            place = at + step if step else at
            hit = self.keys[place] == h
            out[hit] = self.order[place[hit]]
        return out


class Lattice:
    """All pieces inside words of one length, the rows of the byte matrix ``m``."""

    def __init__(self, m: np.ndarray, pieces: Pieces):
        self.size, self.n = m.shape
        self.pieces = pieces
        p = hashed.powers(hashed._BASE, self.n + 1)
        self.inverse = hashed.powers(hashed._INVERSE, self.n + 1)
        self.sums = np.zeros((self.size, self.n + 1), np.uint64)
        np.cumsum((m.astype(np.uint64) + np.uint64(1)) * p[:self.n], axis=1, out=self.sums[:, 1:], dtype=np.uint64)

    def spans(self, i: np.ndarray | int, j: np.ndarray | int) -> np.ndarray:
        """Numbers of the pieces from bytes ``i`` to ``j`` (one of them an array), a row a word."""
        i, j = np.atleast_1d(i), np.atleast_1d(j)
        return self.pieces.numbers(hashed.mix((self.sums[:, j] - self.sums[:, i]) * self.inverse[i] + (j - i).astype(np.uint64)))

    def ending(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        i = np.arange(max(0, j - self.pieces.longest), j)
        return i, self.spans(i, j)

    def starting(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        j = np.arange(i + 1, min(self.n, i + self.pieces.longest) + 1)
        return j, self.spans(i, j)


def log_sum(x: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials over the second axis."""
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def forward(lat: Lattice, logp: np.ndarray) -> np.ndarray:
    """``[j]``: log of the sum, over all segmentations of a word's first j bytes, of the products of piece probabilities.

    ``logp`` has a row per piece and minus infinity as its last row. Works in
    logarithms, so words of any length keep their value.
    """
    out = np.zeros((lat.n + 1, lat.size, logp.shape[1]))
    for j in range(1, lat.n + 1):
        i, piece = lat.ending(j)
        out[j] = log_sum(out[i].transpose(1, 0, 2) + logp[piece])
    return out


def last_forward(lat: Lattice, logp: np.ndarray) -> np.ndarray:
    """The last row of :func:`forward`; keeps no more rows than the longest piece is long."""
    window = np.zeros((1, lat.size, logp.shape[1]))
    for j in range(1, lat.n + 1):
        _, piece = lat.ending(j)
        now = log_sum(window.transpose(1, 0, 2) + logp[piece])
        window = np.concatenate((window[max(0, j + 1 - lat.pieces.longest) - max(0, j - lat.pieces.longest):], now[None]))
    return window[-1]


def short_forward(lat: Lattice, prob: np.ndarray) -> np.ndarray:
    """The same sum for words of at most ``SHORT`` bytes, which no product takes out of a double's range: exact without logarithms."""
    out = np.ones((lat.n + 1, lat.size, prob.shape[1]))
    for j in range(1, lat.n + 1):
        i, piece = lat.ending(j)
        out[j] = np.einsum("kwl,wkl->wl", out[i], prob[piece])
    return np.log(out[-1])


def expected_counts(lat: Lattice, logp: np.ndarray, weight: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` how often each piece is expected in the words, by language, each word counting ``weight`` times."""
    alpha = forward(lat, logp)
    beta = np.zeros_like(alpha)
    for i in range(lat.n - 1, -1, -1):
        j, piece = lat.starting(i)
        x = beta[j].transpose(1, 0, 2) + logp[piece]
        beta[i] = log_sum(x)
        np.add.at(total, piece, np.exp(x + (alpha[i] - alpha[-1])[:, None]) * weight[:, None])


def distinct_words(w: hashed.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of one occurrence of each distinct word, and the distinct number of every word."""
    _, first, number = np.unique(w.hash, return_index=True, return_inverse=True)
    return w.start[first], (w.end - w.start)[first], number


def by_length(w: hashed.Words, start: np.ndarray, length: np.ndarray, longest: int, langs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct words of one length, about ``CELLS`` numbers of their lattices at a time: their places and bytes, a space before each word."""
    for n in np.unique(length):
        who = np.flatnonzero(length == n)
        step = max(1, CELLS // (int(n + 1) * langs * min(int(n + 1), longest)))
        for lo in range(0, len(who), step):
            some = who[lo:lo + step]
            m = np.full((len(some), n + 1), 32, np.uint8)
            m[:, 1:] = w.data[start[some, None] + np.arange(n)]
            yield some, m


def word_logs(w: hashed.Words, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability by language of each distinct word, and the distinct number of every word."""
    start, length, number = distinct_words(w)
    langs = model["prob"].shape[1]
    logs = np.zeros((len(start), langs))
    with np.errstate(divide="ignore"):
        logp = np.log(model["prob"])
    for some, m in by_length(w, start, length, model["pieces"].longest, langs):
        lat = Lattice(m, model["pieces"])
        logs[some] = short_forward(lat, model["prob"]) if lat.n <= SHORT else last_forward(lat, logp)
    return logs, number


def sample_words(docs: DataFrame, lang: str, bound: int) -> tuple:
    """``(lang, word, n)``: how often the words of at most about ``bound`` documents of each language occur; and the languages."""
    sizes = {r[0]: r[1] for r in docs.groupBy(lang).count().collect()}  # a row a language
    chance = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int((1 << 20) * min(1.0, bound / n)))])
    if not sizes:
        return None, []
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < chance[F.col(lang)])

    def run(batches: Iterator) -> Iterator:
        for b in slices(batches, 1, SLICE):
            w = hashed.Words(b.column(1), lower=False)
            langs = b.column(0).dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False)[w.row]
            for c in np.unique(code):
                mine = np.flatnonzero(code == c)
                _, first, n = np.unique(w.hash[mine], return_index=True, return_counts=True)
                words = [w.data[w.start[i]:w.end[i]].tobytes() for i in mine[first]]
                yield pa.RecordBatch.from_arrays([pa.array([langs.dictionary[int(c)].as_py()] * len(n), pa.string()),
                                                  pa.array(words, pa.binary()), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])
    counted = some.select(F.col(lang).alias("lang"), F.col("text")).mapInArrow(run, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), sorted(sizes)


def train(docs: DataFrame, bound: int = MAX_TRAIN, vocabulary: str = VOCABULARY, rounds: int = 3, text: str = "text", lang: str = "lang") -> dict:
    """Piece probabilities of each language by expectation-maximisation over all segmentations.

    Learns from rows with text and a language that are not held out, at most
    about ``bound`` a language (chosen by a hash of the id). Tasks gather
    expected counts over whole words, letter case kept and with all pieces of
    the vocabulary; the driver gets one number a language and piece. Counts are
    smoothed towards those of all languages together and a small floor.
    """
    spark = with_workers(docs.sparkSession)
    known = docs.select("doc_id", F.col(text).alias("text"), F.col(lang).alias(lang)).where(
        F.col("text").isNotNull() & F.col(lang).isNotNull() & ~is_held_out(F.col("doc_id")))
    pieces = read_pieces(vocabulary)
    words, langs = sample_words(known, lang, bound)
    model = {"pieces": Pieces(pieces), "langs": langs}
    length = np.array([len(p) for p in pieces])
    flat = 0.02 ** length  # start: short pieces likely, each byte costs as much
    prob = np.tile((flat / flat.sum())[:, None], (1, len(langs)))
    if not langs:
        return model | {"prob": np.concatenate((prob, np.zeros((1, 0))))}
    words = words.repartition("lang", "word").persist()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model | {"prob": np.concatenate((prob, np.zeros((1, len(langs)))))})

        def expect(batches: Iterator, shared=shared) -> Iterator:
            m = shared.value
            code = {x: i for i, x in enumerate(m["langs"])}
            with np.errstate(divide="ignore"):
                logp = np.log(m["prob"])
            for b in slices(batches, 1):
                total = np.zeros((len(m["prob"]), len(code)))
                w = hashed.Words(b.column(1), np.zeros(256, bool), lower=False)
                start, length, number = distinct_words(w)
                weight = np.zeros((len(start), len(code)))
                which = np.array([code[x] for x in b.column(0).to_pylist()])
                np.add.at(weight, (number, which[w.row]), b.column(2).to_numpy()[w.row])
                for some, mat in by_length(w, start, length, m["pieces"].longest, len(code)):
                    expected_counts(Lattice(mat, m["pieces"]), logp, weight[some], total)
                total[-1] = 0
                p, c = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(total[p, c])], names=["p", "c", "n"])
        got = words.mapInArrow(expect, "p int, c int, n double").groupBy("p", "c").agg(F.sum("n").alias("n")).toPandas()
        count = np.zeros((len(pieces), len(langs)))
        count[got["p"], got["c"]] = got["n"]
        pooled = count.sum(axis=1) + 1e-3
        pooled = 0.99 * pooled / pooled.sum() + 0.01 * flat / flat.sum()
        strength = 200.0
        prob = (count + strength * pooled[:, None]) / (count.sum(axis=0) + strength)
        shared.unpersist()
    words.unpersist()
    return model | {"prob": np.concatenate((prob, np.zeros((1, len(langs)))))}


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every whole text.

    ``lang_pred`` is the language that gives the text the highest probability,
    summed over all segmentations of its words (the first by name on a tie);
    ``score`` is its share among all languages, equally likely beforehand. A
    text that is null or has no letter is ``und`` with score 0, as is any if
    nothing could be learned. Only the text counts.
    """
    spark = with_workers(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # vocabulary times languages, whatever the input
    langs = model["langs"]

    def run(col: pa.Array) -> list:
        if not langs:
            return [pa.array(["und"] * len(col)), np.zeros(len(col))]
        w = hashed.Words(col, lower=False)
        logs, number = word_logs(w, shared.value)
        total = np.stack([np.bincount(w.row, logs[number, k], minlength=len(col)) for k in range(len(langs))], axis=1)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [pa.array(np.array(langs, object)[best], pa.string()), share]
    out = score_column(docs.select("doc_id", text, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters")),
                       ["doc_id", "_letters"], text, "lang_pred string, score double", run, max_bytes=SLICE)
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                      F.when(F.col("_letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                      F.when(F.col("_letters"), F.col("score")).otherwise(0.0).alias("score"))


def identify_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return identify(docs, train(docs, vocabulary=vocabulary))
