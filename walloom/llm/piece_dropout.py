"""Merge-type subword encoding with seeded merge-dropout, and its inverse.

A text's characters are merged pair by pair, best piece first and leftmost first, as the vocabulary ranks them. Each candidate merge,
when its turn comes, is skipped for good if a hash keyed by the seed says so; what the hash is of is
the document, the position of the word in its text and the candidate's place in the word, so each occurrence of a word is cut on its own and a run is repeatable on any number of machines. Without
dropout the ids are those of the vocabulary's own encoder.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Lookup, frugal, mix, slices, string_bytes, worker_cache

MARK = "▁"
NONE = np.int32(2**30)
#: Words of more characters go through an agenda; units that a worker keeps; places that one pass of the lock step holds.
WIDE, KNOWN, BLOCK = 48, 200_000, 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary: pieces, their ranks, the merges that make them, and the ids of single bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        self.ids: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
        score = {i: model.get_score(i) for i in self.ids.values()}
        by_rank = sorted(self.ids.values(), key=lambda i: (-score[i], i))
        self.rank_id = np.array(by_rank, np.int32)
        rank = {i: r for r, i in enumerate(by_rank)}
        left, right, made = [], [], []
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank[i])
        self.merge = Lookup(self.pair(np.array(left), np.array(right)), np.array(made), int(NONE))
        long = [p for p in self.ids if len(p) > 1]
        self.longest = max(map(len, long))
        self.ranks, self.none = (np.uint16, np.uint16(65535)) if n < 65535 else (np.int32, NONE)
        #: Ranks of pieces by a hash of their characters, for all spans of many words at once.
        self.ranked = Lookup(np.array([self.spelling(p) for p in long], np.uint64), np.array([rank[self.ids[p]] for p in long]), int(NONE))
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        fixed = "".join(re.escape(c) for c in inside if c != MARK)
        #: A unit that no merge can leave: characters that no longer piece has stand alone, and a mark only begins pieces.
        self.units = re.compile(f"{MARK}*[{fixed}]+|{MARK}+|[^{MARK}{fixed}]")
        sizes = np.array([len(b) for b in self.bytes_of])
        self.begin, self.size = np.cumsum(sizes) - sizes, sizes
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((a.astype(np.uint64) + np.uint64(1)) * np.uint64(1 << 24) + b.astype(np.uint64) + np.uint64(1))

    @staticmethod
    def spelling(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = mix(h * _STEP + np.uint64(ord(c) + 1))
        return int(h[0])

    def spelled(self, ids: list[int]) -> list[int]:
        """Ids with the bytes of characters that are no piece; those are given as -1 - code point."""
        out: list[int] = []
        for i in ids:
            if i >= 0:
                out.append(i)
            else:
                out += self.byte_id[np.frombuffer(chr(-1 - i).encode("utf-8", "surrogatepass"), np.uint8)].tolist()
        return out


def pieces(path: str) -> Pieces:
    held = worker_cache("piece_dropout")
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def _place(begin, middle, end) -> np.ndarray:
    """A number for the merge of [begin, middle) with [middle, end), mixed."""
    begin, middle, end = (np.asarray(x, np.uint64) for x in (begin, middle, end))
    return mix(np.atleast_1d((begin << np.uint64(40)) + (middle << np.uint64(20)) + end) + np.uint64(0x1D8E4E27C47D124F))


#: Those of the merges in words of up to WIDE characters.
_PLACES = _place(np.arange(WIDE)[:, None, None], np.arange(WIDE + 1)[:, None], np.arange(WIDE + 1))


def _skips(key: np.ndarray, place: np.ndarray, rate: float) -> np.ndarray:
    """The keyed hash: whether a merge is skipped. Keys and places are mixed numbers already."""
    return (key ^ place) * _STEP < np.uint64(min(int(rate * 2**64), 2**64 - 1))


def _symbols(model: Pieces, unit: str) -> list[int]:
    return [model.ids.get(c, -1 - ord(c)) for c in unit]


def _agenda(model: Pieces, unit: str, key: np.ndarray, rate: float, trace: list | None = None) -> list[int]:
    """One long unit by an agenda of candidates. trace: where the places of the merges go."""
    ids = _symbols(model, unit)
    n = len(ids)
    after, before, end = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
    alive = [True] * n
    todo: list = []

    def push(pairs: list[tuple[int, int]]) -> None:
        pairs = [(a, b) for a, b in pairs if ids[a] >= 0 and ids[b] >= 0]
        if pairs:
            made = model.merge(model.pair(np.array([ids[a] for a, _ in pairs]), np.array([ids[b] for _, b in pairs])))
            for (a, b), r in zip(pairs, made.tolist(), strict=True):
                if r != NONE:
                    heapq.heappush(todo, (r, a, b, end[b], ids[a], ids[b]))

    push([(k, k + 1) for k in range(n - 1)])
    while todo:
        r, a, b, stop, x, y = heapq.heappop(todo)
        if not alive[a] or not alive[b] or after[a] != b or end[b] != stop or ids[a] != x or ids[b] != y:
            continue
        if rate and bool(_skips(key, _place(a, b, stop), rate)[0]):
            continue
        if trace is not None:
            trace.append((a, b, stop))
        ids[a], alive[b], after[a], end[a] = int(model.rank_id[r]), False, after[b], stop
        if after[b] < n:
            before[after[b]] = a
        push([p for p in ((before[a], a), (a, after[a])) if p[0] >= 0 and p[1] < n])
    return [ids[k] for k in range(n) if alive[k]]


def _spans(model: Pieces, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of words of equal length: ids of their characters (-1 - code for those that are no piece), and for [begin, end) the rank of
    the piece spelled so, by (word, begin, end)."""
    n, width = len(units), len(units[0])
    codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, width)
    known, back = np.unique(codes, return_inverse=True)
    ids = np.array([model.ids.get(chr(c), -1 - int(c)) for c in known], np.int32)[back].reshape(n, width)
    rank = np.full((n, width, width + 1), model.none, model.ranks)
    for begin in range(width - 1):
        h = mix(codes[:, begin].astype(np.uint64) + np.uint64(1))
        fine = ids[:, begin] >= 0
        for end in range(begin + 2, min(width, begin + model.longest) + 1):
            h = mix(h * _STEP + codes[:, end - 1].astype(np.uint64) + np.uint64(1))
            fine = fine & (ids[:, end - 1] >= 0)
            found = model.ranked(h)
            rank[:, begin, end] = np.where(fine & (found < NONE), found, model.none)
    return ids, rank


def _steps(model: Pieces, ids: np.ndarray, span: np.ndarray, which: np.ndarray, keys: np.ndarray, rate: float, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of words of one length together (which: their places in the tables of `_spans`): in each step every one makes its best merge
    that isn't skipped. Comes out as the ids of all occurrences end to end, and how many each has. trace: where each step's occurrences
    and the mixed places of their merges go."""
    n, width = len(which), ids.shape[1]
    flat, row_of, none = span.ravel(), which * (width * (width + 1)), model.none
    stop = np.tile(np.arange(1, width + 1), (n, 1))  # of the symbol that begins at a place
    before = np.tile(np.arange(-1, width - 1), (n, 1))  # where the symbol before it begins
    whole = np.ones((n, width), bool)

    def ranks(rows, begin, middle, end):
        found = flat[row_of[rows] + begin * (width + 1) + end]
        if rate:
            found = np.where(_skips(keys[rows], _PLACES[begin, middle, end], rate), none, found)
        return found

    rank = np.full((n, width), none, model.ranks)
    for k in range(width - 1):
        rank[:, k] = ranks(slice(None), k, k + 1, k + 2)
    rows = np.arange(n)
    while len(rows):
        best = rank[rows].argmin(axis=1)
        live = rank[rows, best] < none
        rows, a = rows[live], best[live]
        b = stop[rows, a]
        c = stop[rows, b]
        if trace is not None:
            trace.append((rows, _PLACES[a, b, c]))
        stop[rows, a], rank[rows, b], rank[rows, a], whole[rows, b] = c, none, none, False
        own = np.flatnonzero(c < width)
        r, x, y = rows[own], a[own], c[own]
        before[r, y] = x
        rank[r, x] = ranks(r, x, y, stop[r, y])
        own = np.flatnonzero(a > 0)
        r, x = rows[own], a[own]
        p = before[r, x]
        rank[r, p] = ranks(r, p, x, c[own])
    r, a = np.nonzero(whole)
    c = stop[r, a]
    rank_of = flat[row_of[r] + a * (width + 1) + c]
    return np.where(c - a == 1, ids[which[r], a], model.rank_id[np.minimum(rank_of, len(model.rank_id) - 1)]), whole.sum(axis=1)


def _ranges(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of runs, end to end."""
    ends = np.cumsum(counts)
    return np.repeat(begin - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Known:
    """Units that a Python worker has seen: their spans' ranks, what they come to without a skip, and the merges that an occurrence is then asked
    about. An occurrence that skips none of those comes to the same; the others go through the merges themselves. So the hash
    is of the occurrence, and only what doesn't depend on it is kept."""

    def __init__(self, model: Pieces):
        self.model = model
        literal = model.byte_id[np.frombuffer(MARK.encode(), np.uint8)].astype(np.int32)
        self.units, self.number = [LITERAL], {LITERAL: 0}
        self.size, self.row = np.full(1, WIDE + 1), np.zeros(1, np.int64)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.flat, self.counts, self.begin = literal, np.array([len(literal)]), np.zeros(1, np.int64)
        self.asked, self.n_asked, self.from_ = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _merged(self, of: np.ndarray, keys: np.ndarray, rate: float, traces: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of occurrences of units end to end, and how many each has. traces: where occurrences and the mixed places of their merges
        go, each one's in the order in which they are made."""
        sizes = self.size[of]
        blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for width in np.unique(sizes):
            own = np.flatnonzero(sizes == width)
            if width > WIDE:
                for i in own:
                    made: list[tuple[int, int, int]] = []
                    found = np.array(_agenda(self.model, self.units[of[i]], keys[i : i + 1], rate, made), np.int32)
                    blocks.append((own[own == i], found, np.array([len(found)])))
                    if traces is not None and made:
                        traces.append((np.full(len(made), i), _place(*zip(*made, strict=True))))
                continue
            for a in range(0, len(own), BLOCK // int(width)):
                part = own[a : a + BLOCK // int(width)]
                steps: list | None = None if traces is None else []
                blocks.append((part, *_steps(self.model, *self.tables[int(width)], self.row[of[part]], keys[part], rate, steps)))
                if traces is not None:
                    traces += [(part[rows], place) for rows, place in steps or []]
        counts = np.zeros(len(of), np.int64)
        for k, (own, ids, n) in enumerate(blocks):
            if (ids < 0).any():  # characters that are no piece become bytes
                spelled = [self.model.spelled(ids[e - m : e].tolist()) for e, m in zip(np.cumsum(n), n, strict=True)]
                n = np.array([len(x) for x in spelled])
                blocks[k] = (own, np.array([x for one in spelled for x in one], np.int32), n)
            counts[own] = n
        begin = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for own, ids, n in blocks:
            flat[_ranges(begin[own], n)] = ids
        return flat, counts

    def add(self, units: list[str]) -> None:
        sizes, row = np.fromiter(map(len, units), np.int64, len(units)), np.zeros(len(units), np.int64)
        for width in np.unique(sizes[sizes <= WIDE]).tolist():
            own = np.flatnonzero(sizes == width)
            made = [_spans(self.model, [units[k] for k in own[a : a + BLOCK // width**2]]) for a in range(0, len(own), BLOCK // width**2)]
            had = [self.tables[width]] if width in self.tables else []
            row[own] = (len(had[0][0]) if had else 0) + np.arange(len(own))
            self.tables[width] = tuple(np.concatenate(x) for x in zip(*had, *made, strict=True))
        first = len(self.units)
        self.units += units
        self.number.update(zip(units, range(first, len(self.units)), strict=True))
        self.size, self.row = np.concatenate([self.size, sizes]), np.concatenate([self.row, row])
        traces: list = []
        flat, counts = self._merged(np.arange(first, len(self.units)), np.zeros(len(units), np.uint64), 0.0, traces)
        rows = np.concatenate([np.zeros(0, np.int64), *(r for r, _ in traces)])
        place = np.concatenate([np.zeros(0, np.uint64), *(p for _, p in traces)])
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        self.asked = np.concatenate([self.asked, place[np.argsort(rows, kind="stable")]])
        self.n_asked = np.concatenate([self.n_asked, np.bincount(rows, minlength=len(units))])
        self.begin, self.from_ = np.cumsum(self.counts) - self.counts, np.cumsum(self.n_asked) - self.n_asked

    def encode(self, units: list[str], keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all occurrences end to end, and how many each has."""
        new = list({u for u in units if u not in self.number})
        if new:
            self.add(new)
        of = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        own = np.zeros(0, np.int64)
        if rate:
            n = self.n_asked[of]
            hit = _skips(np.repeat(keys, n), self.asked[_ranges(self.from_[of], n)], rate)
            own = np.unique(np.repeat(np.arange(len(units)), n)[hit])
        flat, counts, begin = self.flat, self.counts[of], self.begin[of]
        if len(own):
            more, sizes = self._merged(of[own], keys[own], rate)
            begin[own], counts[own] = len(flat) + np.cumsum(sizes) - sizes, sizes
            flat = np.concatenate([flat, more])
        return flat[_ranges(begin, counts)], counts


def _encoded(path: str, seed: int, rate: float):
    def run(batches):
        model, key = pieces(path), f"units of {path}"
        held = worker_cache("piece_dropout")
        for rows in slices(batches, 2 << 20):
            if key not in held or len(held[key].units) > KNOWN:
                held[key] = Known(model)
            split = [_units(model, t.as_py()) if t.is_valid and len(t.as_py()) else [] for t in rows.column(1)]
            n_units = np.array([len(units) for units in split])
            keys = _occurrence_keys(rows.column(2).to_numpy(), n_units, seed)
            ids, counts = held[key].encode([u for units in split for u in units], keys, rate)
            ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(n_units)])]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids))], ["doc_id", "ids"])

    return run


def _occurrence_keys(documents: np.ndarray, n_units: np.ndarray, seed: int) -> np.ndarray:
    """A key for each unit of each text: of the seed, the document's hash and the unit's position."""
    own = mix(documents.view(np.uint64) ^ mix(np.full(1, seed, np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return mix(np.repeat(own, n_units) ^ mix(_ranges(np.zeros(len(n_units), np.int64), n_units).astype(np.uint64) + np.uint64(1)))


#: Stands for a mark that the text itself holds: no unit has a mark after another character.
LITERAL = "x" + MARK


def _units(model: Pieces, text: str) -> list[str]:
    """Units of a text, with a space before it. Marks of its own go to byte pieces, so that they don't come back as spaces."""
    first, *rest = text.split(MARK)
    units = model.units.findall(MARK + first.replace(" ", MARK))
    for part in rest:
        units.append(LITERAL)
        units += model.units.findall(part.replace(" ", MARK))
    return units


def _decoded(path: str, most: int = 1 << 19):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            lists = batch.column(1)
            sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            part = (np.cumsum(sizes) - sizes) // most
            cuts = np.flatnonzero(np.diff(part)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if b > a:
                    rows = batch.slice(int(a), int(b - a))
                    yield pa.RecordBatch.from_arrays([rows.column(0), _texts(model, rows.column(1))], ["doc_id", "text"])

    return run


def _texts(model: Pieces, lists: pa.Array) -> pa.Array:
    """Bytes of all pieces laid end to end, without the space that encoding puts before a text."""
    counts = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    size = model.size[ids]
    ends = np.cumsum(size)
    data = model.flat[np.repeat(model.begin[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
    offsets = np.concatenate([np.zeros(1, np.int64), ends])[np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    head = offsets[:-1][filled]
    head = head[data[head] == 32] if len(head) else head
    keep = np.ones(len(data), bool)
    keep[head] = False
    data, offsets = data[keep], offsets - np.searchsorted(head, offsets, side="left")
    raw = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.as_py().decode("utf-8", "replace") for x in raw], pa.string())


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, seed: int = 0, rate: float = 0.1) -> DataFrame:
    """-> (doc_id, ids array<int>) for every row.

    rate: the share of candidate merges that are skipped; 0 gives the vocabulary's own encoding. Each occurrence of a word is cut on its own, by a hash
    of the seed, the document's id and the word's position in the text; equal rows are encoded equally. Characters that are no piece become bytes. A null or
    empty text has no ids. Words of up to WIDE characters go through merges in lock step, longer ones through an agenda.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col)).alias("h"))
    return rows.mapInArrow(frugal(_encoded(path or vocabulary_path(), seed, rate), "piece_dropout"), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """-> (doc_id, text) for every row: the inverse of encode for any rate, seed and variant. Null or no ids: an empty text."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(frugal(_decoded(path or vocabulary_path()), "piece_dropout"), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def _digested(path: str, inner):
    """Encoded rows with their texts, decoded again: counts and checksums for the registered query."""

    def run(batches):
        model = pieces(path)
        for batch in inner(batches):
            texts = _texts(model, batch.column(1))
            own = [x.values.to_numpy().astype("<u4").tobytes() if x.values is not None and len(x) else b"" for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in own], pa.int64()), pa.array([zlib.crc32(x) for x in own], pa.int64()), pa.array([zlib.crc32(t.as_py().encode()) for t in texts], pa.int64()), pa.array([len(t.as_py()) for t in texts], pa.int64())],
                ["doc_id", "n_ids", "ids_crc32", "text_crc32", "n_decoded_chars"],
            )

    return run


def round_trip(documents: DataFrame, seed: int = 0, rate: float = 0.1) -> DataFrame:
    """Encode and decode every text: (doc_id, n_ids, ids_crc32, text_crc32, n_decoded_chars), the last two of the decoded text."""
    path = vocabulary_path()
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
    return rows.mapInArrow(frugal(_digested(path, _encoded(path, seed, rate)), "piece_dropout"), "doc_id long, n_ids long, ids_crc32 long, text_crc32 long, n_decoded_chars long")
