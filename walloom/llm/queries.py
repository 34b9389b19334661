"""The registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from . import decontamination, language_id, ngram_join, packing, periodic_runs, piece_dropout, pii, quality, secret_scan, url_templates, vector_codes, vector_dedup, vector_topk
from .common import table


def op1_language_id(spark, sf_dir):
    return language_id.languages_of(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars")
    return quality.quality_of(documents, table(spark, sf_dir, "labels", "doc_id", "quality"))


def op3_piece_dropout(spark, sf_dir):
    return piece_dropout.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_secrets(spark, sf_dir):
    return secret_scan.secret_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_pii(spark, sf_dir):
    return pii.pii_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_ngram_join(spark, sf_dir):
    return ngram_join.similar_documents(table(spark, sf_dir, "documents", "doc_id", "text"), words=4, percent=85)


def op6_exact_topk(spark, sf_dir):
    return vector_topk.topk_query(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_url_filter(spark, sf_dir):
    return url_templates.judge(table(spark, sf_dir, "pages", "page_id", "url"))


def op10_vector_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.code_query(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op12_periodic_runs(spark, sf_dir):
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return periodic_runs.run_digests(documents.withColumn("text", periodic_runs.repeated(documents["text"], documents["doc_id"])))


def op13_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_REACH = """reach AS (SELECT {0} AS a, {0} AS b FROM n UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
 part AS (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a)"""


def _rounds_sql(rounds=6):
    """Lloyd rounds one after the other, each as three tables: distances to the codebooks' entries give codes, and these the next codebooks."""
    nearest = """a{0} AS MATERIALIZED (SELECT r, m, arg_min(e, {{'d': d, 'e': e}}) AS e, MIN(d) AS d FROM (SELECT r, p.m, c.e,
  CAST(list_sum(list_transform(range(1, len(p) + 1), lambda i: CAST(p[i] - c[i] AS HUGEINT) * (p[i] - c[i]))) AS HUGEINT) AS d FROM parts p JOIN c{0} c ON p.m = c.m) GROUP BY r, m)"""
    moved = """c{1} AS MATERIALIZED (SELECT c.m, c.e, coalesce(n.c, c.c) AS c FROM c{0} c LEFT JOIN (SELECT m, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT p.m, a.e, i, CAST(SUM(p.p[i]) AS HUGEINT) AS s, COUNT(*) AS n FROM parts p JOIN a{0} a ON p.r = a.r AND p.m = a.m, range(1, (SELECT MAX(len(p)) FROM parts) + 1) t(i) GROUP BY p.m, a.e, i)
  GROUP BY m, e) n ON c.m = n.m AND c.e = n.e)"""
    steps = ", ".join(f"{nearest.format(k)}, {moved.format(k, k + 1)}" for k in range(rounds))
    return f"""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 parts AS MATERIALIZED (SELECT r, m, v[m * len(v) // 8 + 1 : (m + 1) * len(v) // 8] AS p FROM v, range(8) t(m)),
 c0 AS MATERIALIZED (SELECT m, r - 1 AS e, p AS c FROM parts WHERE r <= 16), {steps}, {nearest.format(rounds)},
 coded AS (SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY m) AS code, CAST(SUM(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
 books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY m, e)) AS h FROM c{rounds})
 SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN coded USING (r), books"""


_RUNS = r"""WITH bytes AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_concat([ascii(c) + 256], repeat([-1], 8)))) AS steps FROM documents),
 hashed AS (SELECT r, doc_id, regexp_extract_all(t, '[^ 	-]+') AS w,
  xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(steps, lambda x: CAST(x AS BIGINT))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x - 256) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h FROM bytes),
 planted AS (SELECT r, doc_id, w, len(w) AS n, h, h // 10 AS g FROM hashed),
 d AS MATERIALIZED (SELECT r, doc_id, n, CASE WHEN h % 10 <> 0 OR n = 0 THEN w ELSE list_transform(range(0, n), lambda i: CASE WHEN i < g % n THEN w[i + 1] ELSE w[g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) + 1] END) END AS w FROM planted),
 x AS MATERIALIZED (SELECT r, n, unnest(range(0, n)) AS i, unnest(w) AS w FROM d),
 pairs AS (SELECT a.r, b.i - a.i AS p, a.i FROM x a JOIN x b ON a.r = b.r AND a.w = b.w AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
 stretches AS (SELECT r, p, MIN(i) AS s, COUNT(*) + p AS l FROM (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS k FROM pairs) GROUP BY r, p, k HAVING COUNT(*) + p >= greatest(6, 4 * p)),
 runs AS MATERIALIZED (SELECT r, s, l, MIN(p) AS p FROM stretches GROUP BY r, s, l),
 best AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(l AS DOUBLE) / p DESC, s, p) AS k FROM runs),
 listed AS (SELECT r, COUNT(*) AS c, string_agg(concat(s, ',', l, ',', p, chr(10)), '' ORDER BY s, p) AS t FROM runs GROUP BY r),
 gone AS (SELECT DISTINCT r, unnest(range(s + p, s + l)) AS i FROM runs),
 kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM x ANTI JOIN gone USING (r, i) GROUP BY r)
 SELECT doc_id, CAST(coalesce(c, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(l AS BIGINT) AS length, CAST(p AS BIGINT) AS period, CAST(1000 * l // p AS BIGINT) AS exponent_milli,
  sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
 FROM d LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON d.r = b.r LEFT JOIN listed ON d.r = listed.r LEFT JOIN kept ON d.r = kept.r"""


def oracle_sql():
    join = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS g FROM d),
 n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM s), x AS (SELECT doc_id, unnest(g) AS h FROM s),
 p AS (SELECT l.doc_id AS a, r.doc_id AS b, COUNT(*) AS c FROM x l JOIN x r ON l.h = r.h AND l.doc_id < r.doc_id GROUP BY ALL),
 e AS (SELECT a, b FROM p JOIN n l ON l.doc_id = a JOIN n r ON r.doc_id = b WHERE 100 * c >= 85 * (l.n_shingles + r.n_shingles - c)),
 both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), {_REACH.format("doc_id")}
 SELECT doc_id, n_shingles, component_id FROM n JOIN part ON doc_id = a"""
    search = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
 r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
 SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
    near = f"""WITH RECURSIVE n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
 both_ways AS (SELECT l.vec_id AS a, r.vec_id AS b FROM n l JOIN n r ON l.vec_id <> r.vec_id WHERE list_cosine_similarity(l.v, r.v) >= 0.9), {_REACH.format("vec_id")},
 links AS (SELECT a, COUNT(*) AS k FROM both_ways GROUP BY a)
 SELECT vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM n JOIN part ON vec_id = part.a LEFT JOIN links ON vec_id = links.a"""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    leaks = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS w FROM benchmark),
 g AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w] ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i+9]) END) AS g FROM b),
 lengths AS (SELECT DISTINCT len(g) AS n FROM g),
 x AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i+n-1])) AS g FROM d, lengths WHERE len(w) >= n),
 hits AS (SELECT DISTINCT r, i, n, x.g FROM x JOIN (SELECT DISTINCT g FROM g) k ON x.g = k.g),
 n AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
 items AS (SELECT r, list_sort(list(DISTINCT item_id)) AS items FROM hits JOIN g ON hits.g = g.g WHERE item_id IS NOT NULL GROUP BY r)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN items ON d.r = items.r"""
    return {"op11_vector_codes": _rounds_sql(), "op12_periodic_runs": _RUNS, "op13_decontamination": leaks, "op5_ngram_join": join, "op6_exact_topk": search, "op10_vector_dedup": near}
