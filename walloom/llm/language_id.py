"""Language identification by unigram pieces of a fixed vocabulary, summed over all segmentations.

Each language has a probability for every piece of a public vocabulary. A word's probability is the sum over all its
segmentations of the product of their pieces' probabilities, by the forward algorithm; a text's is that of its words. The probabilities are learned
by expectation maximisation on words and their counts, again over all segmentations (forward and backward).
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Lookup, checkpointed, frugal, mix, slices, worker_cache

#: At most so many labelled documents of each language are learned from, those of the least hash.
SAMPLE_ROWS, ROUNDS = 400, 3
#: Parts of the table of the sample's words, which the bound on the sample keeps small.
PARTS = 16
#: Words whose scores a Python worker keeps, and bytes of text that it takes at once.
KNOWN_WORDS, SLICE = 120_000, 2 << 20
#: Runs of more letters are scored in lock step, with a window of the forward sums, and aren't kept. Those of the sample are learned from in parts of LEARNED letters.
RUN, LEARNED, TOGETHER = 32, 256, 256
FLOOR, EVIDENCE = 1e-7, 25.0
LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"
_MULT = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[str]:
    """The vocabulary's pieces of letters, with or without the mark of a word's begin."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = {i for i in range(model.get_piece_size()) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if i not in special}
    return sorted(p for p in found if p and (p == MARK or LETTERS.fullmatch(p.removeprefix(MARK))))


def _key(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of character codes, read from the end."""
    h = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1] - 1, -1, -1):
        h = mix(h * _MULT + codes[:, k].astype(np.uint64) + np.uint64(1))
    return h


class Segmenter:
    """Finds the pieces in words; id 0 stands for a single character that is no piece, and -1 for no piece."""

    def __init__(self, pieces: list[str]):
        sizes = np.array([len(p) for p in pieces])
        keys = np.zeros(len(pieces), np.uint64)
        for n in np.unique(sizes):
            own = np.flatnonzero(sizes == n)
            keys[own] = _key(np.frombuffer("".join(pieces[k] for k in own).encode("utf-32-le"), np.uint32).reshape(len(own), n))
        self.find = Lookup(keys, np.arange(1, len(pieces) + 1), -1)
        self.size, self.longest = len(pieces) + 1, int(sizes.max(initial=1))

    def spans(self, codes: np.ndarray):
        """codes (n, L) -> for each end and length the piece of each word, as (begin, end, ids)."""
        for end in range(1, codes.shape[1] + 1):
            h = np.zeros(len(codes), np.uint64)
            for begin in range(end - 1, max(-1, end - self.longest - 1), -1):
                h = mix(h * _MULT + codes[:, begin].astype(np.uint64) + np.uint64(1))
                ids = self.find(h)
                if begin == end - 1:
                    ids = np.maximum(ids, 0)
                if (ids >= 0).any():
                    yield begin, end, ids

    def ending(self, codes: np.ndarray, n: int) -> np.ndarray:
        """codes (rows, longest - 1 + n), 0 where there is no letter -> for each length, row and one of the last n places the
        piece of that length that ends there."""
        out = np.full((self.longest, len(codes), n), -1, np.int32)
        h, there = np.zeros((len(codes), n), np.uint64), np.ones((len(codes), n), bool)
        for k in range(self.longest):
            part = codes[:, self.longest - 1 - k : self.longest - 1 - k + n]
            there &= part > 0
            h = mix(h * _MULT + part.astype(np.uint64) + np.uint64(1))
            found = self.find(h.ravel()).reshape(h.shape)
            out[k] = np.where(there, np.maximum(found, 0) if k == 0 else found, -1)
        return out


def segmenter_of(pieces: list[str]) -> Segmenter:
    """One for each vocabulary and Python worker."""
    key = (len(pieces), hash(tuple(pieces)))
    held = worker_cache("language_id")
    if held.get("vocabulary") != key:
        held.update(vocabulary=key, segmenter=Segmenter(pieces))
    return held["segmenter"]


def by_length(words: list[str]):
    """Marked words of equal length together: (places, codes)."""
    marked = [MARK + w for w in words]
    sizes = np.array([len(w) for w in marked])
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        codes = np.frombuffer("".join(marked[k] for k in own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), n)
        yield own, codes


@dataclass
class Model:
    """probability: (pieces + 1 and a last row of zeros, languages)."""

    languages: list[str]
    pieces: list[str]
    probability: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """log P(word) in each language, over all segmentations."""
        sizes = np.array([len(w) for w in words])
        if (sizes > RUN).any():
            out = np.zeros((len(words), len(self.languages)))
            for own, score in ((np.flatnonzero(sizes <= RUN), self.scores), (np.flatnonzero(sizes > RUN), self.long_scores)):
                if len(own):
                    out[own] = score([words[k] for k in own])
            return out
        segmenter = segmenter_of(self.pieces)
        table = self.table()
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for own, codes in by_length(words):
            for a in range(0, len(own), 8192):
                part = codes[a : a + 8192]
                forward = np.zeros((part.shape[1] + 1, len(part), len(self.languages)))
                forward[0] = 1
                for begin, end, ids in segmenter.spans(part):
                    some = np.flatnonzero(ids >= 0)
                    if len(some) == len(ids):
                        forward[end] += forward[begin] * table[ids]
                    else:
                        forward[end][some] += forward[begin][some] * table[ids[some]]
                out[own[a : a + 8192]] = np.log(forward[-1])
        return out

    def table(self) -> np.ndarray:
        """Probabilities with a row of zeros at the end, for no piece."""
        if not hasattr(self, "_table"):
            self._table = np.concatenate([self.probability, np.zeros((1, len(self.languages)))])
        return self._table

    def long_scores(self, words: list[str]) -> np.ndarray:
        """As scores, for words of any length: all words go on by one letter at a time, the forward sums are kept as far back as a piece can
        reach, and their scale is taken out after each letter."""
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        out = np.zeros((len(words), len(self.languages)))
        for a in range(0, len(order), TOGETHER):
            out[order[a : a + TOGETHER]] = self._in_step(words, order[a : a + TOGETHER])
        return out

    def _in_step(self, words: list[str], order: list[int]) -> np.ndarray:
        segmenter, table = segmenter_of(self.pieces), self.table()
        back = segmenter.longest
        sizes = np.array([len(words[k]) + 1 for k in order])
        raw = [np.frombuffer((MARK + words[k]).encode("utf-32-le", "surrogatepass"), np.uint32) for k in order]
        window = np.zeros((back, len(order), len(self.languages)))  # by how far back
        window[0] = 1
        total = np.zeros((len(order), len(self.languages)))
        at = 0
        while at < sizes[0]:
            live = int((sizes > at).sum())
            n = int(min(sizes[0] - at, max(1, 65536 // (live * back))))
            codes = np.zeros((live, back - 1 + n), np.uint32)
            for k in range(live):
                a, b = max(0, at - back + 1), min(at + n, sizes[k])
                codes[k, a - (at - back + 1) : b - (at - back + 1)] = raw[k][a:b]
            ids = segmenter.ending(codes, n)
            for step in range(n):
                live = int((sizes > at + step).sum())
                new = (window[:, :live] * table[ids[:, :live, step]]).sum(axis=0)
                total[:live] += np.log(new)
                window[1:, :live] = window[:-1, :live] / new
                window[0, :live] = 1
            at += n
        return total


def runs(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return LETTERS.findall(text.lower())


def _logs(spans: list, length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the forward and backward sums of n words at each place."""
    forward, backward = np.zeros((2, length + 1, n))
    for at, own in itertools.groupby(spans, key=lambda s: s[1]):
        before = forward[at - 1]
        forward[at] = before + np.log(sum(np.exp(forward[b] - before) * p for b, _, _, p in own))
    for at, own in itertools.groupby(sorted(spans, key=lambda s: -s[0]), key=lambda s: s[0]):
        after = backward[at + 1]
        backward[at] = after + np.log(sum(np.exp(backward[e] - after) * p for _, e, _, p in own))
    return forward, backward


def _expected(model: Model, languages: dict[str, int]):
    """Rows (lang, word, n) -> expected uses of each piece in each language."""

    def run(batches):
        segmenter = segmenter_of(model.pieces)
        total = np.zeros((segmenter.size, len(languages)))
        for batch in batches:
            lang = np.array([languages[x] for x in batch.column(0).to_pylist()], int)
            n = batch.column(2).to_numpy().astype(float)
            for own, codes in by_length(batch.column(1).to_pylist()):
                spans = [(b, e, np.maximum(ids, 0), model.probability[np.maximum(ids, 0), lang[own]] * (ids >= 0)) for b, e, ids in segmenter.spans(codes)]
                forward, backward = _logs(spans, codes.shape[1], len(own))
                for b, e, ids, p in spans:
                    np.add.at(total, (ids, lang[own]), n[own] * p * np.exp(forward[b] + backward[e] - forward[-1]))
        piece, which = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int64)), pa.array(which.astype(np.int64)), pa.array(total[piece, which])], ["piece", "language", "uses"])

    return run


def _counted(batches):
    for rows in slices(batches, SLICE):
        lang, word = [], []
        for code, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
            own = [w[a : a + LEARNED] for w in runs(text.as_py() or "") for a in range(0, len(w), LEARNED)]
            lang += [code] * len(own)
            word += own
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string())], ["lang", "word"])


def train(labelled: DataFrame, path: str | None = None, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Model | None:
    """Learn from labelled(doc_id, text, lang); None if there is nothing to learn from.

    The sample is at most sample_rows documents a language; their words are counted by Spark, every round's expected uses are
    summed by Spark, and the driver holds one number for each piece and language.
    """
    ids = labelled.where("lang is not null and text is not null").select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_rows).select("doc_id", "lang").distinct()
    texts = labelled.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")  # sample_rows a language
    counts = checkpointed(texts.mapInArrow(frugal(_counted, "language_id"), "lang string, word string").groupBy("lang", "word").agg(F.count("*").alias("n")).coalesce(PARTS))
    names = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not names:
        return None
    pieces = vocabulary(path or vocabulary_path())
    size = np.array([max(1, len(p.removeprefix(MARK))) for p in ["?", *pieces]], float)
    start = np.repeat((30.0**-size / (30.0**-size).sum())[:, None], len(names), axis=1)
    model = Model(names, pieces, start)
    for _ in range(rounds):
        uses = counts.mapInArrow(frugal(_expected(model, {x: k for k, x in enumerate(names)}), "language_id"), "piece long, language long, uses double").groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toArrow()
        total = np.full(start.shape, 1e-3)
        total[uses["piece"].to_numpy(), uses["language"].to_numpy()] += uses["uses"].to_numpy()
        probability = np.maximum(total / total.sum(axis=0), FLOOR)
        probability[0] = np.maximum(probability[0] / 1000, FLOOR)  # any character that is no piece shares this
        model = Model(names, pieces, probability)
    return model


def _predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. Words' scores are kept from batch to batch, a bounded number of them."""
    held = worker_cache("language_id")
    if held.get("of") is not model:
        held.update(of=model, place={}, scores=[])
    place: dict[str, int] = held["place"]
    if len(place) > KNOWN_WORDS:
        place.clear()
        held["scores"] = []
    words = [runs(t.as_py() or "") for t in texts]
    new = list({w for own in words for w in own if w not in place})
    long = [w for w in new if len(w) > RUN]
    new = [w for w in new if len(w) <= RUN] if long else new
    if new:
        place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
        held["scores"] = [np.concatenate([*held["scores"], model.scores(new)])]
    scores = held["scores"][0] if held["scores"] else np.zeros((0, len(model.languages)), np.float32)
    if long:
        place = place | {w: len(place) + k for k, w in enumerate(long)}
        scores = np.concatenate([scores, model.scores(long)])
    counts = np.array([len(own) for own in words])
    some = counts > 0
    total = np.zeros((len(words), len(model.languages)))
    if some.any():
        flat = np.fromiter((place[w] for own in words for w in own), np.int64, counts.sum())
        total[some] = np.add.reduceat(scores[flat].astype(np.float64), (np.cumsum(counts) - counts)[some], axis=0)
    total *= np.minimum(1, EVIDENCE / np.maximum(counts, 1))[:, None]
    share = np.exp(total - total.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    lang = [model.languages[k] if s else "und" for k, s in zip(best, some, strict=True)]
    return lang, np.where(some, share[np.arange(len(best)), best], 0.0)


def _predicted(shared):
    def run(batches):
        for rows in slices(batches, SLICE):
            lang, score = _predict(shared.value, rows.column(1))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return run


def _kept(shared, text_col: str, least: float):
    def run(batches):
        for rows in slices(batches, SLICE, text_col):
            lang, score = _predict(shared.value, rows.column(rows.schema.get_field_index(text_col)))
            yield rows.filter(pa.array((np.array(lang) != "und") & (score >= least)))

    return run


def keep_identified(documents: DataFrame, model: Model | None, text_col: str = "text", least: float = 0.4) -> DataFrame:
    """The rows, with all their columns, whose language is known with a score of `least`; none if no language was learned."""
    if model is None:
        return documents.limit(0)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # one number for each piece and language
    return documents.mapInArrow(frugal(_kept(shared, text_col, least), "language_id"), documents.schema)


def identify(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> (doc_id, lang_pred, score) for every row, from the text alone.

    score is the language's share of the probability, with the evidence of a long text held to that of EVIDENCE average words; ties go to the language first by name. A null text, one without letters, and any text when no language was learned:
    `und` with score 0. Every letter of a text counts. Repeated rows each give a row.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # one number for each piece and language
    return rows.mapInArrow(frugal(_predicted(shared), "language_id"), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def languages_of(documents: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out, and predict all: (doc_id, held_out, lang_pred, score)."""
    model = train(documents.where(~held_out()))
    return identify(documents, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
