"""Exact similarity join of word n-gram sets by parity sketches.

Every shingle hash flips bits of a sketch, so a shingle that two sets share cancels in the difference of their sketches,
and the Hamming distance of two sketches is at most the size of the sets' symmetric difference. For sets of a and b
shingles that link, that difference is at most D = (1 - j) / (1 + j) * (a + b). Two sketches serve:

* a wide one, per size band, in m > D segments: by the pigeonhole principle a linked pair agrees in m - D segments or
  more, so documents meet that have an equal segment that isn't empty (see `_keys` for segments that are empty);
* a short one of about one bit a shingle, 1024 at least, whose Hamming distance dismisses pairs before any text is
  read; of two widths the wider one is folded to the other by parity.

What is left is verified on the whole sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, frugal, mix, slices, stored, string_bytes
from .components import components, fitted, roots

BITS = 1024
SLICE = 512 << 10
#: Bytes that are hashed at once, and places in a word that have a factor of their own; further ones mix in the number of the round.
CHUNK, PLACES = 64 << 10, 4096
#: One set in so many shows which keys are common: those that LEAST of the sample have, the COMMON most common ones (a power of two).
SAMPLE, LEAST, COMMON = 64, 16, 1 << 16
_GAP = np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.arange(256, dtype=np.uint64) + np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), 32, 0).astype(np.uint64)
#: A number for each byte, equal for both cases of A-Z and 0 for white space; and an odd factor for each place in a word.
_VALUE = np.where(_GAP, np.uint64(0), mix(_LOWER + np.uint64(0x5BD1E995)))
_FACTOR = mix(np.arange(PLACES, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C55)) | np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """words: of a shingle. Two sets link when 100 * intersection >= percent * union."""

    words: int
    percent: int

    def most(self, total):
        """Largest symmetric difference of linked sets whose sizes sum to total."""
        return (100 - self.percent) * total // (100 + self.percent)

    def edges(self) -> np.ndarray:
        """First sizes of the bands: sizes at which only equal sets link, then each band 1.6 times the last."""
        first = next(s for s in range(1, 1000) if self.most(2 * s + 1) >= 1) + 1
        out = [1, first]
        while out[-1] < 2**40:
            out.append(max(out[-1] + 1, int(out[-1] * 1.6)))
        return np.array(out, np.int64)


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the words of texts laid end to end, by runs of CHUNK bytes with the open word carried over, so that
    working memory doesn't grow with a text. A word's hash is the sum of its bytes' numbers times the factors of their places."""
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    open_at, last, inside = 0, np.zeros(1, np.uint64), False
    for a in range(0, len(flat), CHUNK):
        value = _VALUE[flat[a : a + CHUNK]]
        member = value != 0
        begins = member.copy()
        begins[1:] &= ~member[:-1]
        begins[0] &= not inside
        border = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, a + len(value))] - a
        begins[border] = member[border]
        at = np.flatnonzero(begins)
        place = np.arange(len(value)) - np.concatenate([[open_at - a], at])[np.cumsum(begins)]
        value *= _FACTOR[place % PLACES]
        far = np.flatnonzero(place >= PLACES)
        if len(far):
            value[far] *= mix((place[far] // PLACES).astype(np.uint64)) | np.uint64(1)
        head = at[0] if len(at) else len(value)
        last += value[:head].sum(dtype=np.uint64)
        inside = bool(member[-1])
        if len(at):
            own = np.add.reduceat(value, at)
            hashes += [last, own[:-1]]
            last, open_at = own[-1:].copy(), a + int(at[-1])
            starts.append(at + a)
    found = np.concatenate(starts)
    return found, mix(np.concatenate([*hashes, last])[1:] + np.uint64(0xD6E8FEB86659FD93)) if len(found) else np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles of lower-cased words; all of a whole column at once."""
    flat, offsets = string_bytes(texts)
    starts, word = word_hashes(flat, offsets)
    first = np.searchsorted(starts, offsets)
    shingle = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        shingle = mix(shingle * np.uint64(0xA0761D6478BD642F) + word[k : k + len(shingle)]) if k else word[: len(shingle)].copy()
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            own = np.sort(shingle[a : b - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own)
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                h = mix(h * np.uint64(0xE7037ED1A0B428DB) + word[k : k + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(own: np.ndarray) -> int:
    """One number for a set: order-free sum and parity of its mixed hashes, with its size."""
    m = mix(own ^ np.uint64(0x5851F42D4C957F2D))
    both = np.array([m.sum(dtype=np.uint64) ^ mix(np.bitwise_xor.reduce(own, keepdims=True) + np.uint64(len(own)))[0]], np.uint64)
    return int(mix(both).view(np.int64)[0])


def _parity(own: np.ndarray) -> np.ndarray:
    """The short sketch: each shingle flips one bit. Halves of a sketch fold onto each other."""
    bits = max(BITS, 1 << (len(own) - 1).bit_length())
    bit = (mix(own ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(bit, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _folded(sketch: Column, other: Column) -> Column:
    """A sketch, folded once if it is wider than the other."""
    half = (F.size(sketch) / 2).cast("int")
    return F.when(F.size(sketch) > F.size(other), F.zip_with(F.slice(sketch, F.lit(1), half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(sketch)


def _segments(own: np.ndarray, m: int, trial: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and 64-bit parity words of the segments that aren't empty. The first trial deals shingles by the top bits
    of hashes that are sorted already."""
    hashes = own if not trial else np.sort(mix(own + np.uint64(trial)))
    number = ((hashes >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    start = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    return number[start], np.bitwise_xor.reduceat(mix(hashes ^ np.uint64(0x9FB21C651E98DF25)), start)


@lru_cache(4096)
def spare_segments(most: int, least: int) -> int:
    """Segments over most + 1: as many as a set of `least` shingles, the band's smallest, leaves empty in nearly every case."""
    extra = 1
    for _ in range(30):
        m = most + 1 + extra
        empty = m * math.exp(-least / m)
        new = min(math.ceil(empty + 3 * math.sqrt(empty)) + 1, most + 1)
        if new == extra:
            break
        extra = new
    return extra


def _keys(own: np.ndarray, rule: Rule, edges: np.ndarray, trials: int = 16) -> list[tuple[np.ndarray, int]]:
    """Join keys of a set in its own size band and, where larger sets of the next band can link, there too; and how many of them the set can do without.

    A band has D + 1 segments and a few more. A pair that agrees in no segment but empty ones has more empty
    segments than those few in both of its sets: such sets, and only they, give the keys of a further trial with other hashes too; after
    the last trial they share one key, so no pair is missed. A set with fewer empty segments than those few shares, with each set that it links
    with, at least one more key than the difference: it may leave out so many of its keys, if all sets leave out by one order.
    """
    size, out = len(own), []
    band = int(np.searchsorted(edges, size, side="right")) - 1
    for k in (band, band + 1):
        if k < 1 or (k > band and 100 * size < rule.percent * int(edges[k])):
            continue
        most = int(rule.most(2 * (int(edges[k + 1]) - 1)))
        spare = spare_segments(most, -(-rule.percent * int(edges[k]) // 100))
        for trial in range(trials + 1):
            salt = np.uint64((k * 64 + trial) * 0x9E3779B97F4A7C15 % 2**64)
            if trial == trials:
                out.append((mix(np.array([salt])), 0))
                break
            number, word = _segments(own, most + 1 + spare, trial)
            free = len(number) - most - 1
            out.append((mix(word ^ mix(number + salt)), max(0, free)))
            if free >= 0:
                break
    return out


@dataclass(frozen=True)
class Common:
    """Keys, sorted, that very many sets have: how many of the sample have them, and one set of those."""

    key: np.ndarray
    count: np.ndarray
    hub: np.ndarray

    def dealt(self, keys: np.ndarray, free: int, own: int) -> np.ndarray:
        """Keys as they are shuffled: even ones to meet under, and odd ones, spread by the set, that name the hub's place instead of
        gathering all sets in one task. The most common `free` of them are left out."""
        keys = keys & ~np.uint64(1)
        if not len(self.key):
            return keys
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        found = np.flatnonzero(self.key[at] == keys)
        if not len(found):
            return keys
        order = found[np.lexsort((keys[found], self.count[at[found]]))]
        left = order[: max(0, len(order) - free)]
        spread = mix(keys[left] ^ np.uint64(own % 2**64)) & ~np.uint64(2 * COMMON - 1)
        return np.concatenate([np.delete(keys, found), spread | (at[left].astype(np.uint64) << np.uint64(1)) | np.uint64(1)])


def _described(rule: Rule):
    def run(batches):
        edges = rule.edges()
        for rows in slices(batches, SLICE):
            sets = shingle_sets(rows.column(1), rule.words)
            n = pa.array([len(own) for own in sets], pa.int64())
            mark = [fingerprint(own) if len(own) else None for own in sets]
            sketch = pa.array([_parity(own) if len(own) else None for own in sets], pa.list_(pa.int64()))
            keys = [np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in _keys(own, rule, edges))]) & ~np.uint64(1) if len(own) and f % SAMPLE == 0 else None for own, f in zip(sets, mark, strict=True)]
            sampled = pa.array([k if k is None else k.view(np.int64) for k in keys], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), n, pa.array(mark, pa.int64()), sketch, sampled, rows.column(2)], ["doc_id", "n", "set", "sketch", "sampled", "alone"])

    return run


def _common(base: DataFrame) -> Common:
    """The most common keys by the sampled sets. Which ones are known as common changes the work only, never the result."""
    sampled = base.where("sampled is not null").select("set", F.explode("sampled").alias("key")).distinct()
    found = sampled.groupBy("key").agg(F.count("*").alias("n"), F.min("set").alias("hub")).where(F.col("n") >= LEAST).orderBy(F.desc("n"), "key").limit(COMMON).toArrow()
    key = found["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return Common(key[order], found["n"].to_numpy()[order], found["hub"].to_numpy()[order])


def _keyed(rule: Rule, shared):
    def run(batches):
        edges, common = rule.edges(), shared.value
        for rows in slices(batches, SLICE):
            key, mark, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], set()
            for own in shingle_sets(rows.column(0), rule.words):
                f = fingerprint(own) if len(own) else None
                if f is None or f in seen:
                    continue
                seen.add(f)
                found = [common.dealt(k, free, f) for k, free in _keys(own, rule, edges)]
                key += found
                mark += [np.full(len(k), f) for k in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(mark))], ["key", "set"])

    return run


def _mates(shared):
    """Rows sorted by (key, set) -> (a, b): the first set of each even key with each other one, the hub of each odd key with each."""

    def run(batches):
        hub = shared.value.hub
        key_before, first_before = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate([[True], key[1:] != key[:-1]])
            at = np.flatnonzero(new)
            first = own[at[np.cumsum(new) - 1]]
            if key_before == key[0]:
                first[: at[1] if len(at) > 1 else len(key)] = first_before
            key_before, first_before = key[-1], first[-1]
            odd = np.flatnonzero(key & 1)
            if len(odd):
                first[odd] = hub[(key[odd] & (2 * COMMON - 1)) >> 1]
            far = own != first
            pairs = np.unique(np.stack([first[far], own[far]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _verified(rule: Rule):
    """Rows sorted so that a group's hub comes first -> (a, b, linked) for each other row of the group."""

    def run(batches):
        hub_key, hub = None, None
        for rows in slices(batches, SLICE):
            group, salt, role, own_id = (rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("a", "salt", "role", "node"))
            a, b, linked = [], [], []
            for k, own in enumerate(shingle_sets(rows.column(rows.schema.get_field_index("text")), rule.words)):
                if not len(own) or fingerprint(own) != own_id[k]:
                    continue  # another row with the same document id
                if role[k] == 0:
                    hub_key, hub = (group[k], salt[k]), own
                elif hub_key == (group[k], salt[k]):
                    small, large = (own, hub) if len(own) < len(hub) else (hub, own)
                    at = np.searchsorted(large, small)
                    at[at == len(large)] = 0
                    both = int((large[at] == small).sum())
                    a.append(group[k])
                    b.append(own_id[k])
                    linked.append(100 * both >= rule.percent * (len(own) + len(hub) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame, alone: DataFrame | None, rule: Rule, group: int = 64) -> DataFrame:
    """pairs(a, b) of sets -> (a, b, linked). A class's text is that of its least id; of a class without ids it is found by the text's own hash, in `alone`. Members go to their hub in groups of about `group`, each with its own copy of
    the hub's text, so a hub with very many members is work for many tasks."""
    sized = pairs.groupBy("a").agg(F.ceil(F.count("*") / group).alias("groups"))
    salted = pairs.join(sized, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups")))
    hubs = salted.select("a", "salt").distinct().select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("node"))
    roles = hubs.union(salted.select("a", "salt", F.lit(1), "b"))
    need = checkpointed(roles.join(classes.select(F.col("set").alias("node"), "head", "alone"), "node"))
    need = fitted(need, need.count())
    named = need.where("head is not null").drop("alone")
    wanted = ["a", "salt", "role", "node", "text"]
    rows = texts.join(broadcast_if_small(named, named.count()), F.col("doc_id") == F.col("head")).select(*wanted)
    if alone is not None:
        rows = rows.union(alone.join(need.where("head is null").drop("head"), "alone").select(*wanted))
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    found = checkpointed(rows.mapInArrow(frugal(_verified(rule), "ngram_join"), "a long, b long, linked boolean").distinct())
    return fitted(found, found.count())


#: Before every pair that is left is verified, components are joined by FEW pairs of each, TURNS times.
FEW, TURNS = 4, 2


def _few(rows: np.ndarray, turn: int, few: int) -> np.ndarray:
    """Of pairs (a, b, component of a, component of b), those that are among the `few` least of one of their components, by a hash of pair and turn."""
    pair = rows[:, :2].view(np.uint64)
    order = mix(mix(pair[:, 0] + np.uint64(turn)) ^ pair[:, 1])
    of, at = rows[:, 2:].T.ravel(), np.tile(np.arange(len(rows)), 2)
    by = np.lexsort((order[at], of))
    first = np.flatnonzero(np.concatenate([[True], of[by][1:] != of[by][:-1]]))
    place = np.arange(len(by)) - np.repeat(first, np.diff([*first, len(by)]))
    return rows[np.unique(at[by][place < few])]


def _unresolved(rule: Rule, turn: int | None = None, few: int = FEW, block: int = 512):
    """Members of one hub, or of two tiles of them -> pairs in different components that the short sketch doesn't dismiss: a few for each
    component, or all where turn is None.

    Sketches are compared width by width: sets that link have widths equal or next to each other.
    """

    def run(key, table):
        _, ti, tj = (k.as_py() for k in key)
        own, part, n, here = (table[c].to_numpy() for c in ("b", "component", "n", "here"))
        lists = table["sketch"].combine_chunks()
        offset, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        width = np.diff(offset)
        found = [np.zeros((0, 4), np.int64)]

        def bits(rows: np.ndarray, least: int) -> np.ndarray:
            w = int(width[rows[0]])
            out = flat[offset[rows][:, None] + np.arange(w)]
            return out if w == least else out[:, : w // 2] ^ out[:, w // 2 :]

        for wa in np.unique(width):
            for wb in (wa // 2, wa, 2 * wa):
                left, right = np.flatnonzero((here == ti) & (width == wa)), np.flatnonzero((here == tj) & (width == wb))
                if not len(left) or not len(right):
                    continue
                x_bits, y_bits = bits(left, min(wa, wb)), bits(right, min(wa, wb))
                for p in range(0, len(left), block):
                    for q in range(0, len(right), block):
                        i, j = left[p : p + block], right[q : q + block]
                        most = rule.most(n[i][:, None] + n[j][None, :])
                        open_ = (part[i][:, None] != part[j][None, :]) & (np.abs(n[i][:, None] - n[j][None, :]) <= most)
                        if ti == tj:
                            open_ &= own[i][:, None] < own[j][None, :]
                        x, y = np.nonzero(open_)
                        for a in range(0, len(x), 1 << 14):
                            u, v = x[a : a + (1 << 14)], y[a : a + (1 << 14)]
                            near = np.bitwise_count(x_bits[p + u] ^ y_bits[q + v]).sum(axis=1) <= most[u, v]
                            k, m = i[u[near]], j[v[near]]
                            k, m = np.where(own[k] < own[m], k, m), np.where(own[k] < own[m], m, k)
                            found.append(np.stack([own[k], own[m], part[k], part[m]], axis=1))
                            if turn is not None and len(k):
                                found = [_few(np.unique(np.concatenate(found), axis=0), turn, few)]
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def similar_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, tile: int = 4096) -> DataFrame:
    """-> (doc_id, n_shingles, component_id) for every row; component_id is the smallest id reached by links, itself included.

    Rows whose sets are equal are one class, known by a 64-bit fingerprint, and only classes are compared. Keys are made in a
    pass of their own, as a table of them would outweigh the texts; they meet by a shuffle; of the classes under one key, each is paired with the first (never all with all).
    Keys that a sample shows to be common are left out by the sets that can do without them, and those that stay are dealt evenly. Pairs are verified on
    whole sets, first one pair for each class; where the links found so far leave members of a hub in different components, the
    pairs of that hub's members that are still apart pass the short sketch in tiles, and what it doesn't dismiss is verified too: first a few pairs of each component, which
    join most of a large group of near copies, then all that are left.
    So every two classes that share a key end up verified or in one component, and no link is lost.
    A null or empty text, or one without words, has n_shingles 0 and is linked with nothing. A row without an id links like any other, but a null id never is
    the smallest: its component_id is null only where it reaches no row with an id.
    """
    rule = Rule(words, percent)
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    mine = texts.withColumn("alone", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    base = stored(mine.mapInArrow(frugal(_described(rule), "ngram_join"), "doc_id long, n long, set long, sketch array<long>, sampled array<long>, alone long"))
    classes = checkpointed(base.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("head"), F.min("alone").alias("alone"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    # texts without an id, one of each, where a class has no other
    alone = None if classes.where("head is null").isEmpty() else stored(mine.where("doc_id is null").groupBy("alone").agg(F.first("text").alias("text")))
    shared = documents.sparkSession.sparkContext.broadcast(_common(base))  # COMMON keys at most
    keyed = texts.select("text").mapInArrow(frugal(_keyed(rule, shared), "ngram_join"), "key long, set long").repartition("key").sortWithinPartitions("key", "set")
    mates = checkpointed(keyed.mapInArrow(_mates(shared), "a long, b long").distinct())
    mates = fitted(mates, mates.count())

    side = lambda c: classes.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    a, b = F.col("sketch_a"), F.col("sketch_b")
    apart = F.aggregate(F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    most = F.floor((100 - percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    near = mates.join(side("a"), "a").join(side("b"), "b").where(F.abs(F.col("n_a") - F.col("n_b")) <= most).where(F.size(a).between(F.size(b) / 2, F.size(b) * 2) & (apart <= most))
    first = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    checked = _verify(first, classes, texts, alone, rule)
    parts = checkpointed(components(checked.where("linked").select("a", "b")))

    of = lambda df, c: df.join(parts.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")), c, "left").withColumn(f"of_{c}", F.coalesce(f"of_{c}", c))
    for turn in (*range(TURNS), None):
        labelled = of(of(mates, "a"), "b")
        open_hubs = labelled.where("of_a <> of_b").select("a").distinct()
        members = labelled.join(open_hubs, "a", "left_semi")
        members = members.select("a", "b", F.col("of_b").alias("component")).union(members.select("a", F.col("a").alias("b"), F.col("of_a").alias("component")).distinct())
        members = checkpointed(members.join(classes.select(F.col("set").alias("b"), "n", "sketch"), "b"))
        members = fitted(members, members.count(), 1 << 14)
        sized = members.groupBy("a").agg(F.ceil(F.count("*") / tile).cast("int").alias("m"))
        here = F.pmod(F.xxhash64("b"), F.col("m")).cast("int")
        dealt = members.join(sized, "a").withColumn("here", here).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        dealt = dealt.withColumn("ti", F.least("here", "o")).withColumn("tj", F.greatest("here", "o")).drop("o", "m")
        rest = checkpointed(dealt.groupBy("a", "ti", "tj").applyInArrow(_unresolved(rule, turn), "a long, b long").distinct())
        if not (pairs := rest.count()):
            break
        rest = fitted(rest, pairs)
        more = _verify(rest.join(checked.select("a", "b"), ["a", "b"], "left_anti"), classes, texts, alone, rule)
        checked = checked.union(more)
        parts = checkpointed(components(checked.where("linked").select("a", "b")))

    named = classes.select("set", "head").join(parts, F.col("set") == F.col("node"), "left").select("set", "head", F.coalesce("component", "set").alias("part"))
    least = named.groupBy("part").agg(F.min("head").alias("component_id"))
    named = named.join(least, "part").select("set", "component_id")
    return base.select("doc_id", F.col("n").alias("n_shingles"), "set").join(named, "set", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, but those that reach a smaller id by links.

    Rows that repeat an id count as one document and one of them stays. Rows without an id or without words all stay.
    """
    found = similar_documents(documents, id_col, text_col, words, percent)
    gone = checkpointed(found.where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct())
    kept = documents.join(broadcast_if_small(gone, gone.count()), id_col, "left_anti")
    twice = checkpointed(found.where("doc_id is not null").groupBy(F.col("doc_id").alias(id_col)).agg(F.count("*").alias("rows")).where(F.col("rows") > 1).select(id_col))
    if twice.isEmpty():
        return kept.select(*documents.columns)
    once = kept.join(twice, id_col, "left_semi").dropDuplicates([id_col])
    return kept.join(twice, id_col, "left_anti").select(*documents.columns).union(once.select(*documents.columns))
