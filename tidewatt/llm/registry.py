"""The operators as queries over the test tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatt.llm import (
    decontamination, language, licenses, minhash, packing, pages, periodic, private, quality, secrets, sharding,
    spelling, vectors,
)
from tidewatt.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.item_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.private_spans(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_spans(table(spark, sf_dir, "documents"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_scores(table(spark, sf_dir, "documents"))


def op10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.with_repeats(table(spark, sf_dir, "documents")))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_private": op2_private,
        "op3_packing": op3_packing,
        "op4_quality": op4_quality,
        "op5_minhash": op5_minhash,
        "op6_kd_sharding": op6_kd_sharding,
        "op7_licenses": op7_licenses,
        "op8_vectors": op8_vectors,
        "op9_language": op9_language,
        "op10_pages": op10_pages,
        "op11_periodic": op11_periodic,
        "op12_secrets": op12_secrets,
        "op13_spelling": op13_spelling,
    }


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           coalesce(list_filter(regexp_split_to_array({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> ''), []) AS w
    FROM documents),
b AS (
    SELECT item_id, list_filter(regexp_split_to_array({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark WHERE text IS NOT NULL),
grams AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM grams),
spans AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hits AS (SELECT s.r, s.i, s.n, g.item_id FROM spans s JOIN grams g ON s.n = g.n AND s.gram = g.gram),
covered AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT r, i, n FROM hits) h, unnest(range(i, i + n)) AS u(p) GROUP BY r),
items AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


OP5 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(list_filter(regexp_split_to_array({LOWERED}, '[\x20\x09-\x0D]+'), lambda w: w <> ''), []) AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
    FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT u, v FROM pairs JOIN n nu ON u = nu.doc_id JOIN n nv ON v = nv.doc_id
    WHERE 100 * shared >= 80 * (nu.n + nv.n - shared)),
reach AS (
    SELECT doc_id AS u, doc_id AS v FROM documents
    UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
c AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


OP8 = """
WITH RECURSIVE e AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
      AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
n AS (SELECT u, count(*) AS n FROM links GROUP BY u),
reach AS (
    SELECT vec_id AS u, vec_id AS v FROM embeddings
    UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
c AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n ON n.u = c.vec_id
"""


# The table of crc32 (polynomial 3988292384), and the hash of a list of bytes by it.
CRC_TABLE = """
crc AS (
    SELECT list(list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, k)
                ORDER BY k) AS t
    FROM range(256) AS r(k))"""
CRC = "xor(list_reduce({bytes}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)"
ID_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"


OP11 = rf"""
WITH {CRC_TABLE},
d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({CRC.format(bytes=ID_BYTES)}, 0) AS h,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS o
    FROM documents, crc),
a AS (SELECT *, len(o) AS n, h // 10 AS g, (h // 10) % greatest(len(o), 1) AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (
    SELECT r, n, unnest(range(0, n)) AS i, unnest(CASE WHEN h % 10 = 0 AND n > 0
           THEN list_select(o, list_transform(range(0, n), lambda i: 1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END))
           ELSE o END) AS w
    FROM p),
equal AS (
    SELECT x.r, y.i - x.i AS p, x.i FROM w x JOIN w y ON x.r = y.r AND x.w = y.w AND y.i > x.i WHERE y.i - x.i <= x.n // 3),
grouped AS (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS k FROM equal),
stretches AS (
    SELECT r, p, min(i) AS s, count(*) + p AS l FROM grouped GROUP BY r, p, k HAVING count(*) + p >= greatest(24, 3 * p)),
runs AS (SELECT r, s, l, min(p) AS p FROM stretches GROUP BY r, s, l),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', p, chr(10)), '' ORDER BY s, p) AS runs FROM runs GROUP BY r),
best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(l AS DOUBLE) / p DESC, s, p) = 1),
dropped AS (SELECT DISTINCT r, unnest(range(s + p, s + l)) AS i FROM runs),
kept AS (
    SELECT r, string_agg(w, ' ' ORDER BY i) AS text FROM (SELECT * FROM w ANTI JOIN dropped USING (r, i)) x GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
       1000 * best.l // best.p AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def rule_sql(place: int, rule: secrets.Rule) -> str:
    """All matches of a rule, the text between them, and the length of each match's body."""
    pattern, head = (f"({text})".replace("'", "''") for text in (rule.head + f"({rule.body})", rule.head))
    return f"""
    SELECT r, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least, m, regexp_split_to_array(text, '{pattern}') AS s,
           list_transform(m, lambda x: length(x) - length(regexp_extract(x, '^{head}'))) AS bodies
    FROM (SELECT r, text, regexp_extract_all(text, '{pattern}') AS m FROM d) AS x WHERE len(m) > 0"""


OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(rule_sql(k, rule) for k, rule in enumerate(secrets.RULES))}),
placed AS (
    SELECT r, place, kind, length(m[k]) AS size, bodies[k] >= least AS good,
           list_sum(list_transform(s[1:k], lambda x: length(x)))
           + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS start
    FROM matches, unnest(range(1, len(m) + 1)) AS u(k)),
spans AS (SELECT r, place, kind, start, concat(kind, ':', start, ':', start + size) AS span FROM placed WHERE good),
found AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (place > 2) AS n_added,
           string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY start, place) AS spans
    FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN found USING (r)
"""

RUN_BYTES = """list_transform(range(1, 2 * strlen(s), 2), lambda k: CAST(
    16 * (instr('0123456789ABCDEF', substr(hex(encode(s)), k, 1)) - 1)
    + instr('0123456789ABCDEF', substr(hex(encode(s)), k + 1, 1)) - 1 AS BIGINT))"""

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT doc_id, run, count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all({LOWERED}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) AS x
    WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
    SELECT run, c, {CRC.format(bytes=RUN_BYTES)} AS h
    FROM (SELECT run, c, concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run) AS s FROM runs) AS x, crc),
words AS (
    SELECT CASE WHEN h % 31 = 0 THEN concat(left(run, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, c
    FROM hashed),
vocabulary AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cut AS (
    SELECT DISTINCT word, k, concat(left(word, k), substr(word, k + 2)) AS short
    FROM vocabulary, unnest(range(0, length(word))) AS u(k)),
pairs AS (
    SELECT x.word AS u, y.word AS v FROM cut x JOIN cut y ON x.k = y.k AND x.short = y.short AND x.word <> y.word
    UNION SELECT x.word, v.word FROM cut x JOIN vocabulary v ON v.word = x.short
    UNION SELECT v.word, x.word FROM cut x JOIN vocabulary v ON v.word = x.short),
near AS (
    SELECT u, count(*) AS n_near, first(v ORDER BY n DESC, v) AS best, max(n) AS best_n
    FROM pairs JOIN vocabulary ON v = word GROUP BY u),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
           CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
    FROM vocabulary LEFT JOIN near ON u = word),
reach AS (
    SELECT word, word AS root, 0 AS steps FROM forms
    UNION ALL SELECT reach.word, forms.form, steps + 1 FROM reach JOIN forms ON forms.word = reach.root WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, steps) AS root FROM reach GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": OP1, "op5_minhash": OP5, "op8_vectors": OP8,
        "op11_periodic": OP11, "op12_secrets": OP12, "op13_spelling": OP13,
    }
