"""Maximal periodic runs of words, on a harmonic grid.

A run with period p and four periods or more holds four neighbouring multiples of p. So for each p the grid of its multiples is
asked: from jp and (j+1)p, how far do the words agree forwards (suffix array, LCP and range minima), and how far backwards (the same
of the reversed words)? Both together are the run that covers the two places. A place whose word differs from that of the next
one has the answer 0, so only places are asked whose next three words on the grid are equal, and arrays are built for texts that have such places.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, slices, string_bytes

LEAST, EXPONENT = 6, 4
BLOCK = 32
#: Queries that are answered together, and bytes of a text that are cut into words together.
QUERIES, CHUNK = 1 << 18, 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """The different words of a text, and the number of each of its words among them."""
    known: dict[bytes, int] = {}
    parts, at = [np.zeros(0, np.int32)], 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.end() if gap else len(text)
        words = text[at:end].split()  # bytes are split at just these six characters
        for w in dict.fromkeys(words):
            known.setdefault(w, len(known))
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        at = end
    return list(known), np.concatenate(parts)


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the rank of each, by doubling the length that they are ordered by."""
    n = len(ids)
    rank, step = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(new[1:] != new[:-1])])
        if rank[order[-1]] == n - 1:
            return order, rank
        step *= 2


def common_prefixes(ids: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each place in the order, how many words its suffix shares with the one before it."""
    words, before = ids.tolist(), np.full(len(ids), -1, np.int64)
    before[order[1:]] = order[:-1]
    out, n, h = [0] * len(words), len(words), 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            h = 0
            continue
        while i + h < n and j + h < n and words[i + h] == words[j + h]:
            h += 1
        out[i] = h
        if h:
            h -= 1
    return np.array(out, np.int64)[order]


class Minima:
    """Least values of ranges: of blocks from either end, and of runs of blocks by powers of two, so that memory is a few times the values'."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // BLOCK)
        self.values = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        self.values[: len(values)] = values
        square = self.values.reshape(blocks, BLOCK)
        self.from_start = np.minimum.accumulate(square, axis=1).ravel()
        self.from_end = np.ascontiguousarray(np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [square.min(axis=1)]
        while 2 ** len(self.table) <= blocks:
            last, half = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least of values a to b, b included."""
        first, last = a // BLOCK, b // BLOCK
        out = np.minimum(self.from_end[a], self.from_start[b])
        inner = np.flatnonzero(last - first > 1)
        if len(inner):
            lo, hi = first[inner] + 1, last[inner]
            level = np.frexp((hi - lo).astype(np.float64))[1] - 1
            for k in np.unique(level):
                own = level == k
                at, row = inner[own], self.table[k]
                out[at] = np.minimum(out[at], np.minimum(row[lo[own]], row[hi[own] - 2**k]))
        one = np.flatnonzero(first == last)
        if len(one):
            x, y = a[one], b[one]
            least = self.values[x]
            for k in range(1, min(BLOCK, int((y - x).max(initial=0)) + 1)):
                least = np.minimum(least, self.values[np.minimum(x + k, y)])
            out[one] = least
        return out


class Extensions:
    """How many words agree from two places on."""

    def __init__(self, ids: np.ndarray):
        order, self.rank = suffix_array(ids)
        self.least = Minima(common_prefixes(ids, order, self.rank))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """i, j: different places; the end of the text agrees with nothing."""
        n, out = len(self.rank), np.zeros(len(i), np.int64)
        inside = np.flatnonzero((i < n) & (j < n))
        a, b = self.rank[i[inside]], self.rank[j[inside]]
        out[inside] = self.least(np.minimum(a, b) + 1, np.maximum(a, b))
        return out


def _grid(ids: np.ndarray):
    """(periods, places jp) where the words at jp, (j+1)p, (j+2)p and (j+3)p are equal: by the period up to the root of n, and by j for longer periods, of which
    each j has few, so that a text of n words takes about 2 sqrt(n) steps over n log n places."""
    n = len(ids)
    root, most = math.isqrt(n), n // EXPONENT
    for p in range(1, min(root, most) + 1):
        own = ids[::p]
        same = own[1:] == own[:-1]
        j = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(j):
            yield np.full(len(j), p), j * p
    low = root + 1
    for j in range(n // low + 1):
        high = min(most, (n - 1) // (j + 3))
        if high < low:
            break
        at = [ids[k * low : k * high + 1 : k] if k else np.full(high - low + 1, ids[0]) for k in range(j, j + 4)]
        p = np.flatnonzero((at[0] == at[1]) & (at[1] == at[2]) & (at[2] == at[3])) + low
        if len(p):
            yield p, j * p


def runs_of(ids: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) by start and period: every stretch with smallest period q and length >= max(6, 4 q) that neither neighbour extends."""
    n, found, held, rows = len(ids), [], 0, [np.zeros((0, 3), np.int64)]
    if n < LEAST:
        return rows[0]
    ahead = back = None

    def ask():
        nonlocal ahead, back
        if ahead is None:
            ahead, back = Extensions(ids), Extensions(ids[::-1])
        p, i = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
        for a in range(0, len(p), QUERIES):
            q, at = p[a : a + QUERIES], i[a : a + QUERIES]
            before, after = back(n - at, n - at - q), ahead(at, at + q)
            length = before + q + after
            good = length >= np.maximum(LEAST, EXPONENT * q)
            rows.append(np.unique(np.stack([at - before, length, q], axis=1)[good], axis=0))

    for part in _grid(ids):
        found.append(part)
        held += len(part[0])
        if held >= QUERIES:
            ask()
            found, held = [], 0
    if found:
        ask()
    every = np.unique(np.concatenate(rows), axis=0)  # by start, length, period
    if not len(every):
        return every
    least = np.concatenate([[True], (every[1:, :2] != every[:-1, :2]).any(axis=1)])  # a stretch counts with its smallest period
    every = every[least]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties by start, then period. Quotients of whole numbers under 2^26 differ as doubles where they differ."""
    if not len(runs):
        return None
    return tuple(int(x) for x in runs[np.lexsort((runs[:, 2], runs[:, 0], -(runs[:, 1] / runs[:, 2])))[0]])


def _texts(rows: pa.RecordBatch, column: int):
    flat, offsets = string_bytes(rows.column(column))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield flat[a:b].tobytes()


def _collapsed(names: list[bytes], ids: np.ndarray, runs: np.ndarray) -> bytes:
    return b" ".join(map(names.__getitem__, ids[kept_words(len(ids), runs)].tolist()))


def _digests(batches):
    for rows in slices(batches):
        out = []
        for text in _texts(rows, 1):
            names, ids = words_of(text)
            runs = runs_of(ids)
            top = strongest(runs)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist()).encode()
            start, length, period = top or (None, None, None)
            out.append((len(runs), start, length, period, top and 1000 * length // period, hashlib.sha256(listed).hexdigest(), hashlib.sha256(_collapsed(names, ids, runs)).hexdigest()))
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])], ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def run_digests(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> (doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256), a row for each document.

    Words are what stands between white space of ASCII. Null and empty texts have no words and no runs, and so the digests of nothing. Repeated rows each
    give a row, and ids may be null. One pass without a shuffle; a text of any length is one row's work, in memory of a few numbers a word.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(frugal(_digests, "periodic_runs"), "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def _found(batches):
    for rows in slices(batches):
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in runs_of(words_of(text)[1]).tolist()] for text in _texts(rows, 1)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))], ["doc_id", "runs"])


def find_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> (doc_id, runs array<struct<start, length, period>>), in words, by start and period; an empty array for texts without a run or null."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(frugal(_found, "periodic_runs"), "doc_id long, runs array<struct<start:long,length:long,period:long>>")


def collapse(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with all their columns; a text with runs becomes its words but those that repeat a run's first period, joined by one space. Others stay as they are."""
    at = documents.columns.index(text_col)

    def run(batches):
        for rows in slices(batches, column=text_col):
            new = []
            for text, old in zip(_texts(rows, at), rows.column(at), strict=True):
                names, ids = words_of(text)
                runs = runs_of(ids)
                new.append(_collapsed(names, ids, runs).decode() if len(runs) else old.as_py())
            yield rows.set_column(at, text_col, pa.array(new, pa.string()))

    return documents.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(frugal(run, "periodic_runs"), documents.withColumn(text_col, F.col(text_col).cast("string")).schema)


def repeated(text: Column, doc_id: Column) -> Column:
    """What the query gives the operator: of documents whose crc32 h of the decimal id is divisible by 10, the words from a = (h / 10) % n on
    become a repetition of the first 1 + (n - a) / (3 + (h / 10) % 8) of them. A null id changes nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0)

    def turned(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.slice(w, a + 1, p)
        # the first p words again and again, cut where the text ends
        again = F.slice(F.flatten(F.array_repeat(tail, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), again), " ")

    # one element, so that the words are made once
    changed = F.array_join(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, turned(w)).otherwise(F.lit(""))), "")
    return F.when(h % 10 == 0, changed).otherwise(text)
