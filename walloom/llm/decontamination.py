"""Benchmark decontamination by DataFrame expressions only: a hash set of the benchmark's n-grams meets every word window of the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WORDS = 10
#: Words of one row of the scan; a row holds the words of the windows that begin in it, and those that they reach into.
CHUNK = 2048
#: Bytes of benchmark windows that are broadcast at most; with more, both sides are shuffled by the windows' hashes.
BROADCAST = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD, _WORD_AS_WRITTEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; a null text has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_WORD), 0), F.array().cast("array<string>"))


def _hash(words: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(words)), *words)


def windows_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """-> (item_id string, window, size, h, words): every window of each item. An item of fewer words is one window, an item without words has none."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item_id"), words_of(F.col(text_col).cast("string")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - words + 1, F.lit(1)))
    rows = rows.select("item_id", F.explode(F.transform(starts, lambda k: F.slice("w", k, F.lit(words)))).alias("words"))
    sized = rows.select("item_id", "words", F.size("words").alias("size"), F.md5(F.array_join("words", " ")).alias("window"))
    by_size = F.coalesce(*(F.when(F.col("size") == n, _hash([F.get("words", F.lit(k)) for k in range(n)])) for n in range(1, words + 1)))
    return sized.select("item_id", "window", "size", by_size.alias("h"), "words")


def scan(documents: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """-> (row, doc_id, text_key, n_words, start, size, window): a row for each occurrence of a window, and one with null start for each document.

    windows: as `windows_of` gives them, stored. Texts are cut into runs of words, so that no row of the scan grows with a text, and each word
    becomes a row with those after it; its hash is looked up, and what is found is verified word by word in the same join.
    """
    grams = windows.select("window", "size", "h", "words").distinct()
    known = grams.groupBy("size").agg(F.sum(F.length(F.array_join("words", "")) + 100).alias("bytes")).collect()  # a row for each size
    lengths, small = sorted(r["size"] for r in known), sum(r["bytes"] for r in known) <= BROADCAST
    texts = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.select("row", "doc_id", F.md5(F.col("text")).alias("text_key"), words_of(F.col("text")).alias("w"))
    empty = F.struct(F.lit(0).alias("base"), F.array().cast("array<string>").alias("run"))
    runs = F.transform(F.sequence(F.lit(0), F.size("w") - 1, F.lit(CHUNK)), lambda k: F.struct(k.alias("base"), F.slice("w", k + 1, F.lit(CHUNK + words - 1)).alias("run")))
    runs = F.when((F.size("w") > 0) & F.lit(bool(lengths)), F.concat(F.array(empty), runs)).otherwise(F.array(empty))
    rows = rows.select("row", "doc_id", "text_key", F.size("w").cast("long").alias("n_words"), F.inline(runs))
    n = F.least(F.size("run"), F.lit(CHUNK))
    place = F.when(n > 0, F.sequence(F.col("base"), F.col("base") + n - 1)).otherwise(F.array().cast("array<int>"))
    held = [f"w{k}" for k in range(words)]
    zipped = F.arrays_zip(place.alias("start"), *(F.slice("run", F.lit(k + 1), n).alias(c) for k, c in enumerate(held)))
    each = rows.select("row", "doc_id", "text_key", "n_words", F.inline_outer(zipped).alias("start", *held))
    # A run's last words belong to the next run: only the windows that begin among its first CHUNK words are its own.
    each = each.where("start is null or w0 is not null")
    # What has no window of a size gets a number of its own for a hash, as nulls would all be shuffled to one task where the join shuffles.
    other = F.xxhash64("row", "start")
    hashes = [F.when(F.col(held[n - 1]).isNotNull(), _hash([F.col(c) for c in held[:n]])).otherwise(other) for n in lengths]
    if len(hashes) > 1:
        each = each.select("*", F.posexplode(F.array(*hashes)).alias("k", "key"))
    else:
        each = each.select("*", F.lit(0).alias("k"), *(h.alias("key") for h in hashes or [other]))
    same = [(F.col("size") <= k) | (F.col(c) == F.get("words", F.lit(k))) for k, c in enumerate(held)]
    on = F.col("key") == F.col("h")
    for x in same:
        on = on & x
    found = each.join(F.broadcast(grams) if small else grams, on, "left")
    found = found.where("window is not null or start is null and k = 0")
    return stored(found.select("row", "doc_id", "text_key", "n_words", "start", "size", "window"))


def _merged(spans: Column) -> Column:
    """Sorted spans struct<start, size> -> disjoint array<struct<start, end>>, those that touch or overlap as one."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["size"]
        apart = acc["end"].isNull() | (s["start"] > acc["end"])
        closed = F.when(acc["end"].isNotNull() & apart, F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["out"])
        return F.struct(closed.alias("out"), F.when(apart, s["start"]).otherwise(acc["start"]).alias("start"), F.when(apart, end).otherwise(F.greatest(acc["end"], end)).alias("end"))

    start = F.struct(none.alias("out"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
    return F.aggregate(spans, start, step, lambda acc: F.when(acc["end"].isNotNull(), F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(none))


def _covered(spans: Column) -> Column:
    """Words that sorted spans struct<start, size> cover."""

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["size"]
        return F.struct((acc["n"] + F.greatest(end - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])


def _spans(found: DataFrame, *by: str) -> DataFrame:
    """The places of a scan's occurrences, sorted: no more of them than a text has words, for each size of window."""
    places = found.where("start is not null").select(*by, "start", "size").distinct()
    return places.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans"))


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", words: int = WORDS) -> DataFrame:
    """-> (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), a row for each document.

    Null texts and texts without words have no hits. Repeated documents each give a row. A repeated item id counts as one item; items without an
    id mark words but aren't counted or listed. An empty benchmark marks nothing. Columns with other names are not read.
    """
    windows = stored(windows_of(benchmark, item_col, item_text, words))
    found = scan(documents, windows, id_col, text_col, words)
    hit = _spans(found, "row").select("row", _covered(F.col("spans")).cast("long").alias("n_hit"))
    named = windows.where("item_id is not null").select("window", "item_id").distinct()
    # The windows of a text are few texts' windows, and one window may be in many items: pairs meet by the window, once for each text.
    items = found.where("window is not null").select("row", "window").distinct().join(named, "window").select("row", "item_id").distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    every = found.where("start is null").select("row", "doc_id", "n_words")
    joined = every.join(hit, "row", "left").join(items, "row", "left")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, most_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", words: int = WORDS) -> DataFrame:
    """The documents, with all their columns, without what the benchmark holds: those with more than `most_share` of their words hit go, and the
    others lose the hit words, with what stands between them and before the first; all else stays as it was. Null texts stay null."""
    found = scan(documents, stored(windows_of(benchmark, item_col, item_text, words)), id_col, text_col, words)
    hit = _covered(F.col("spans"))
    spans = stored(_spans(found, "text_key", "n_words").select(F.col("text_key").alias("_key"), _merged(F.col("spans")).alias("_spans"), (hit > most_share * F.col("n_words")).alias("_gone")))
    size = spans.agg(F.coalesce(F.sum(F.size("_spans") * 8 + 64), F.lit(0))).first()[0]
    rows = documents.withColumn("_key", F.md5(F.col(text_col).cast("string")))
    rows = rows.join(F.broadcast(spans) if size <= BROADCAST else spans, "_key", "left").where("_gone is null or not _gone")
    text = F.col(text_col).cast("string")
    word, gaps = F.regexp_extract_all(text, F.lit(_WORD_AS_WRITTEN), 0), F.split(text, _WORD_AS_WRITTEN, -1)
    pieces = F.zip_with(gaps, word, lambda g, w: F.concat(g, F.coalesce(w, F.lit(""))))  # each word with what stands before it, then the end
    rows = rows.withColumn("_pieces", F.when(F.col("_spans").isNotNull(), pieces))
    starts = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda s: s["end"]))
    ends = F.concat(F.transform("_spans", lambda s: s["start"]), F.array(F.size("_pieces")))
    kept = F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice("_pieces", a + 1, b - a), ""))
    return rows.withColumn(text_col, F.when(F.col("_spans").isNotNull(), F.array_join(kept, "")).otherwise(text)).select(*documents.columns)
