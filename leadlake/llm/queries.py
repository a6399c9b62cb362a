"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadlake.llm import (
    collocations, embedding_dedup, fill_middle, html_extract, mixing, pii, quality, secret_ledger, sentencepiece_codec, sharding,
    simhash, suffix_dedup, toxicity,
)
from leadlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark, sf_dir):
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_sharding(spark, sf_dir):
    return sharding.pack_into(table(spark, sf_dir, "documents"), 16)


@query
def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "finishes")


ORACLES["op9_mixing"] = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         row_number() OVER () AS row
  FROM documents),
sources AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place
    FROM sizes GROUP BY source)),
levels AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, place, source_size,
         least(cap, weight * max(CASE WHEN level <= cap / weight THEN level END) OVER ()) AS target
  FROM levels),
drawn AS (
  SELECT s.*, t.place, t.target, epoch,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(epoch AS VARCHAR)) AS key
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (1), (2)) e(epoch)
  WHERE size > 0),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY place ORDER BY epoch, key, doc_id, size, row
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done
  FROM drawn),
timed AS (
  SELECT *, least(size, CAST(floor(target) AS BIGINT) - (done - size)) AS words, least(done / target, 1.0) AS finish FROM summed),
reached AS (
  SELECT *, sum(words) OVER (ORDER BY finish, place, epoch, key, doc_id, size, row
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM timed WHERE words > 0),
taken AS (
  SELECT row, sum(words) AS taken FROM reached WHERE total <= (SELECT 1.5 * sum(size) FROM sizes) GROUP BY row)
SELECT s.doc_id, s.size, t.source_size, CAST(t.target AS DOUBLE) AS target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN taken k ON s.row = k.row
"""


@query
def op10_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op2_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op2_embedding_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS src, b.vec_id AS dst FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
   AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.dst FROM reach r JOIN links l ON r.other = l.src),
component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT src AS vec_id, count(*) AS n FROM links GROUP BY src)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


@query
def op6_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


@query
def op8_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"))


ORACLES["op1_suffix_dedup"] = """
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS data FROM documents),
prefixes AS (
  SELECT row, i, md5(data[i + 1:i + 400]) AS prefix FROM (
    SELECT row, data, unnest(range(0, CAST(octet_length(data) - 399 AS BIGINT))) AS i FROM texts
    WHERE octet_length(data) >= 400)),
repeated AS (SELECT prefix FROM prefixes GROUP BY prefix HAVING count(*) > 1),
hits AS (
  SELECT row, i, coalesce(i > lag(i) OVER (PARTITION BY row ORDER BY i) + 400, true) AS fresh
  FROM prefixes SEMI JOIN repeated USING (prefix)),
spans AS (
  SELECT row, min(i) AS a, max(i) + 400 AS b FROM (
    SELECT row, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY row ORDER BY i) AS span FROM hits)
  GROUP BY row, span),
pieces AS (
  SELECT row, a, b, CASE WHEN a > before THEN hex(data[before + 1:a]) ELSE '' END AS piece, data FROM (
    SELECT s.row, a, b, data, coalesce(lag(b) OVER (PARTITION BY s.row ORDER BY a), 0) AS before
    FROM spans s JOIN texts t ON s.row = t.row)),
kept AS (
  SELECT row, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(piece, '' ORDER BY a)
         || CASE WHEN max(b) < octet_length(any_value(data)) THEN hex(any_value(data)[max(b) + 1:octet_length(any_value(data))])
            ELSE '' END AS digits
  FROM pieces GROUP BY row)
SELECT doc_id, CAST(octet_length(data) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(k.digits), data)) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.row = k.row
"""


@query
def op12_fill_middle(spark, sf_dir):
    return fill_middle.report(table(spark, sf_dir, "documents"))


ORACLES["op12_fill_middle"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
  FROM documents),
drawn AS (
  SELECT *, len(lines) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4
  FROM texts),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(lines[1:c1], ''), '') AS p, coalesce(array_to_string(lines[c1 + 1:c2], ''), '') AS m,
         coalesce(array_to_string(lines[c2 + 1:n], ''), '') AS s
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query
def op13_secret_ledger(spark, sf_dir):
    return secret_ledger.report(table(spark, sf_dir, "documents"))


def _secret_sql() -> str:
    """Matches and the pieces between them, unnested and summed, give the offsets of each rule."""
    scans = []
    for place, rule in enumerate(secret_ledger.RULES):
        pattern = rule.pattern.decode().replace("(?<![A-Za-z0-9_-])", r"\b").replace(r"\"", '"').replace("'", "''")
        scans.append(f"""
  SELECT row, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least,
         unnest(regexp_split_to_array(text, '{pattern}')) AS gap,
         unnest(list_append(regexp_extract_all(text, '{pattern}', 0), NULL)) AS hit,
         unnest(list_append(regexp_extract_all(text, '{pattern}', {rule.group}), NULL)) AS body,
         generate_subscripts(list_append(regexp_extract_all(text, '{pattern}', 0), NULL), 1) AS i
  FROM texts WHERE regexp_matches(text, '{pattern}')""")
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS ({" UNION ALL ".join(scans)}),
ends AS (
  SELECT *, CAST(sum(length(gap) + length(coalesce(hit, ''))) OVER (
    PARTITION BY row, place ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop
  FROM pieces),
hits AS (
  SELECT row, place, kind, stop - length(hit) AS start, kind || ':' || (stop - length(hit)) || ':' || stop AS span
  FROM ends WHERE hit IS NOT NULL AND length(body) >= least),
found AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM hits GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN found f ON t.row = f.row
"""


ORACLES["op13_secret_ledger"] = _secret_sql()


@query
def op11_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS p FROM texts)),
tokens AS (SELECT lang, piece, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM pieces),
wide AS (
  SELECT lang, [w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p] AS words
  FROM tokens WINDOW p AS (PARTITION BY piece ORDER BY i)),
grams AS MATERIALIZED (
  SELECT lang, k, words[1:k] AS phrase, count(*) AS f FROM wide, range(1, 6) t(k)
  WHERE words[k] IS NOT NULL GROUP BY ALL HAVING k = 1 OR count(*) >= 100),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE k > 1),
keyed AS (SELECT row(lang, phrase) AS key, f FROM grams),
split AS (
  SELECT c.*, cut, row(lang, phrase[1:cut]) AS lkey, row(lang, phrase[cut + 1:]) AS rkey
  FROM candidates c, range(1, 5) t(cut) WHERE cut < k),
cuts AS (
  SELECT lang, phrase, k, s.f AS a, cut, l.f AS l, r.f AS r, n,
         CAST(1000 AS HUGEINT) * s.f * n // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM split s JOIN totals USING (lang) JOIN keyed l ON l.key = lkey JOIN keyed r ON r.key = rkey),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, f, phrase[i:i + w - 1] AS phrase
  FROM candidates, range(2, 5) t(w), range(1, 6) u(i) WHERE w < k AND i + w - 1 <= k),
inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN parts g
    ON g.lang = s.lang AND g.phrase = s.phrase AND 100 * g.f >= 100 * s.f),
ranked AS (
  SELECT *, array_to_string(phrase, ' ') AS text FROM lowest ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, text AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(text)) AS rank FROM ranked)
WHERE rank <= 2000
"""
