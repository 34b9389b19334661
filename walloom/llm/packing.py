"""Packing of token sequences, balanced by attention cost."""

from __future__ import annotations

import base64
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, slices, worker_cache

LENGTH = 1024
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n^2, the second for attention within the piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 512
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: One document in so many keeps the ids of its rest, which may then be cut anywhere to fill what room others leave.
FILLER = 16
_TWO_SPACES = re.compile(r"\s\s")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str):
    """text -> ids, as tokenizers gives them for the byte-level BPE file with add_special_tokens=False.

    tiktoken runs the same vocabulary and merges, several times faster. Its second pattern lacks the look-ahead, which matters
    only where two white-space characters meet. Files of another form, and texts that hold a special token's string,
    go through tokenizers itself.
    """
    held = worker_cache("packing")
    if path not in held:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tiktoken
        from tokenizers import Tokenizer

        plain = Tokenizer.from_file(path)
        spec = json.loads(plain.to_str())
        special = [x["content"] for x in spec["added_tokens"]]
        slow = lambda text: plain.encode(text, add_special_tokens=False).ids
        parts = [spec["pre_tokenizer"]] if spec["pre_tokenizer"] else []
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or [p["type"] for p in parts] != ["ByteLevel"] or parts[0]["add_prefix_space"] or not parts[0].get("use_regex", True):
            held[path] = slow
            return slow
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        to_byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        ranks = {bytes(to_byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        simple = tiktoken.Encoding("simple", pat_str=pattern.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            if any(s in text for s in special):
                return slow(text)
            return (full if _TWO_SPACES.search(text) else simple).encode_ordinary(text)

        held[path] = encode
    return held[path]


def _pieces(path: str, length: int, end_id: int):
    """Rows of pieces: full sequences of a document, and what is left; fillers keep the ids of what is left."""

    def run(batches):
        encode = _encoder(path)
        for rows in slices(batches):
            ids = rows.column(0).to_pylist()
            out: list[tuple] = []
            for doc, text in zip(ids, rows.column(1), strict=True):
                tokens = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                filler = zlib.crc32(str(doc).encode()) % FILLER == 0
                for a in range(0, len(tokens), length):
                    piece = tokens[a : a + length].tobytes()
                    out.append((doc, a, len(piece) // 4, zlib.crc32(piece), len(tokens), piece if filler and len(piece) < 4 * length else None))
            *numbers, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(kept, pa.binary())], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return run


class Open:
    """Open sequences by remaining capacity; finds the one of least cost among those with enough of it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.heaps: list[list] = [[] for _ in range(self.leaves)]
        self.best: list = [None] * (2 * self.leaves)

    def _update(self, capacity: int) -> None:
        k = capacity + self.leaves
        self.best[k] = self.heaps[capacity][0] if self.heaps[capacity] else None
        k //= 2
        while k:
            a, b = self.best[2 * k], self.best[2 * k + 1]
            self.best[k] = a if b is None or (a is not None and a <= b) else b
            k //= 2

    def push(self, cost: float, sequence: int, capacity: int) -> None:
        heapq.heappush(self.heaps[capacity], (cost, sequence, capacity))
        self._update(capacity)

    def pop(self, least: int) -> tuple[float, int, int] | None:
        """The cheapest sequence that has room for `least`, taken out."""
        a, b, found = least + self.leaves, 2 * self.leaves, None
        while a < b:
            if a & 1:
                if self.best[a] is not None and (found is None or self.best[a] < found):
                    found = self.best[a]
                a += 1
            if b & 1:
                b -= 1
                if self.best[b] is not None and (found is None or self.best[b] < found):
                    found = self.best[b]
            a, b = a // 2, b // 2
        if found is not None:
            heapq.heappop(self.heaps[found[2]])
            self._update(found[2])
        return found


def balanced(lengths: np.ndarray, count: int, length: int, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Sequence and offset of each piece, and (cost, sequence, room) of the sequences with room. `count` sequences are opened first; then pieces, the
    longest first, go to the sequence of least cost that has room, or to a new one if none has."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    held = Open(length)
    for s in range(count):
        held.push(0.0, s, length)
    for k in order.tolist():
        n = int(lengths[k])
        found = held.pop(n)
        if found is None:
            found, count = (0.0, count, length), count + 1
        cost, s, room = found
        sequence[k], offset[k] = s, length - room
        if room > n:
            held.push(cost + linear * n + quadratic * n * n, s, room - n)
    return sequence, offset, sorted(x for heap in held.heaps for x in heap)


def poured(fillers: list[tuple], holes: list[tuple[float, int, int]], length: int, first_new: int) -> list[tuple]:
    """Rows of the fillers' pieces: each filler is cut wherever the hole that it is in ends; the cheapest sequence is filled first."""
    out, at = [], 0
    holes = [list(h) for h in holes]
    for doc, start, _, _, doc_tokens, ids in fillers:
        done, whole = 0, len(ids) // 4
        while done < whole:
            if at == len(holes):
                holes.append([0.0, first_new, length])
                first_new += 1
            _, s, room = holes[at]
            n = min(room, whole - done)
            out.append((doc, start + done, n, zlib.crc32(ids[4 * done : 4 * (done + n)]), doc_tokens, s, length - room))
            holes[at][2] -= n
            done += n
            at += holes[at][2] == 0
    return out


def _packed(length: int, linear: float, quadratic: float):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        lengths, spare = table["length"].to_numpy(), np.array(table["ids"].is_valid())
        full, rest = lengths == length, (lengths < length) & ~spare
        count = -(-int(lengths[~full].sum()) // length)
        s, offset, holes = balanced(lengths[rest], count, length, linear, quadratic)
        first = int(full.sum())
        used = max(count, int(s.max(initial=-1)) + 1)
        more = poured([tuple(r.values()) for r in table.filter(pa.array(spare)).select([*names, "ids"]).to_pylist()], holes, length, used)
        columns = [pa.chunked_array([*table[c].filter(pa.array(full)).chunks, *table[c].filter(pa.array(rest)).chunks, pa.array([r[k] for r in more], pa.int64())]) for k, c in enumerate(names)]
        sequence = np.concatenate([np.arange(first), s + first, np.array([r[5] + first for r in more], np.int64)])
        place = np.concatenate([np.zeros(first, np.int64), offset, np.array([r[6] for r in more], np.int64)])
        group = int(table["part"][0].as_py()) << 40
        return pa.table([*columns, group + sequence, place], names=[*names, "sequence_id", "offset"])

    return run


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH,
         end_id: int = END_ID, group_rows: int = 16384, linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """-> (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    A document's tokens (with end_id after them) fill whole sequences of their own as far as they go; what is left is packed with the
    rests of other documents. One rest in FILLER is held back and then cut to fill the room that the others leave, so that
    every group has one sequence with padding at most. Pieces are dealt by a hash of the document, the piece and the part of the input that it comes
    from into groups of about group_rows documents, so that an id which very many rows repeat is in many groups too; each group is packed
    by itself in one task of bounded memory; sequence ids are unique over all groups. Every
    other piece has its checksum from the tokenising pass, so only the fillers' ids are shuffled. A null text is an empty one: its end id alone.
    Rows that repeat an id, or have none, are packed each; no rows give no rows. doc_id must be a whole number or null.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    groups = max(1, -(-rows.select("doc_id").count() // group_rows))
    pieces = rows.mapInArrow(frugal(_pieces(path or vocabulary_path(), length, end_id), "packing"), PIECES + ", ids binary")
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.spark_partition_id()), F.lit(groups)))
    schema = PIECES + ", sequence_id long, offset long"
    return dealt.groupBy("part").applyInArrow(_packed(length, linear, quadratic), schema)
