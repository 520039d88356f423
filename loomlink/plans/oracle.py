"""DuckDB SQL of the derived tables, and of expressions that many queries share."""

from __future__ import annotations

from loomlink.functions import text as tx

_NULLS = ", ".join("'" + t + "'" for t in tx.NULL_TOKENS)
SUFFIX = tx.SUFFIX


def normalized(e: str) -> str:
    """normalize_text in SQL; without mojibake repair, and joining initials two at a time, which is all the data needs."""
    e = f"CASE WHEN lower(regexp_replace({e}, '^\\s+|\\s+$', '', 'g')) IN ({_NULLS}) THEN NULL ELSE {e} END"
    e = f"regexp_replace({e}, '[\\x00-\\x1F\\x{{7F}}-\\x{{9F}}]', ' ', 'g')"
    e = f"replace(replace(replace(lower(strip_accents(replace({e}, 'ß', 'ss'))), '&', ' and '), chr(39), ''), '’', '')"
    for _ in range(2):
        e = f"regexp_replace({e}, '(^|[^a-z0-9_])([a-z0-9])\\.([a-z0-9])($|[^a-z0-9_])', '\\1\\2\\3\\4', 'g')"
    return f"nullif(trim(regexp_replace({e}, '[^a-z0-9]+', ' ', 'g')), '')"


_CANON = "CASE t " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in tx.LEGAL_RENAMED.items()) + " ELSE t END"
_ITEMS = "list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> '')"

RAW = """raw AS (
  SELECT doc_id, src, 'S' || src || '-' || doc_id AS entity_id,
    array_to_string(w[1:4], ' ') || CASE doc_id % 5 WHEN 0 THEN ' Ltd.' WHEN 1 THEN ' Inc' WHEN 2 THEN ' Pvt. Ltd.' ELSE '' END AS business_name,
    CASE WHEN doc_id % 29 = 0 THEN '' ELSE array_to_string(w[5:10], ' ') END AS business_address,
    CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'France' ELSE 'India' END AS country
  FROM (SELECT *, CAST(substr(source, 4) AS INTEGER) % 3 + 1 AS src,
    list_filter(string_split(replace(coalesce(text, ''), chr(10), ' '), ' '), lambda w: w <> '') AS w FROM documents))"""
REC = f"""rec AS (
  SELECT doc_id, src, entity_id, CASE WHEN regexp_matches(n, '{SUFFIX}') THEN regexp_extract(n, '{SUFFIX}', 1) ELSE n END AS name_norm,
    CASE WHEN regexp_matches(n, '{SUFFIX}') THEN array_to_string(list_transform(string_split(trim(regexp_extract(n, '{SUFFIX}', 2)), ' '), lambda t: {_CANON}), ' ') END AS legal_suffix,
    address_norm, country
  FROM (SELECT doc_id, src, entity_id, {normalized('business_name')} AS n, {normalized('business_address')} AS address_norm, country FROM raw))"""
TRUTH = f"""keyed AS (SELECT raw.doc_id, src, entity_id, array_to_string(string_split(k, ' ')[1:8], ' ') AS key
  FROM raw JOIN (SELECT doc_id, {normalized('text')} AS k FROM documents) d ON d.doc_id = raw.doc_id),
truth AS (
  SELECT r.entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids
  FROM (SELECT entity_id FROM raw WHERE src = 1) r LEFT JOIN (
    SELECT o.entity_id, array_to_string(list(t.entity_id ORDER BY t.doc_id), ',') AS ids
    FROM (SELECT key, arg_min(entity_id, doc_id) AS entity_id FROM keyed WHERE src = 1 AND key IS NOT NULL GROUP BY key) o
    JOIN keyed t ON t.key = o.key AND t.src > 1 GROUP BY o.entity_id) l ON l.entity_id = r.entity_id),
links AS (SELECT DISTINCT source1_entity_id, unnest({_ITEMS}) AS candidate_entity_id FROM truth),
lists AS (SELECT source1_entity_id AS ref, list_sort(list_distinct({_ITEMS})) AS ids FROM truth)"""
SCORED = """scored AS (
  SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, ((a.doc_id * 7919 + b.doc_id * 104729) % 1000) / 1000.0::DOUBLE AS score,
    ((a.doc_id * 31 + b.doc_id * 17) % 1000) / 1000.0::DOUBLE AS probability, CASE WHEN l.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label, a.doc_id AS r, b.doc_id AS c
  FROM raw a JOIN raw b ON a.src = 1 AND b.src > 1
  LEFT JOIN links l ON l.source1_entity_id = a.entity_id AND l.candidate_entity_id = b.entity_id
  WHERE a.doc_id // 100 = b.doc_id // 100 OR l.source1_entity_id IS NOT NULL)"""
DEC = """dec AS (
  SELECT source1_entity_id, candidate_entity_id, probability,
    CASE WHEN a.address_norm IS NOT NULL AND b.address_norm IS NOT NULL THEN ((r + c) % 100) / 100.0::DOUBLE END AS address_tfidf_cosine,
    CASE WHEN a.address_norm IS NOT NULL AND b.address_norm IS NOT NULL THEN ((r * 3 + c) % 100) / 100.0::DOUBLE END AS address_token_sort,
    CAST(a.address_norm IS NULL AS DOUBLE) AS source1_address_missing, CAST(b.address_norm IS NULL AS DOUBLE) AS candidate_address_missing,
    a.country AS source1_country, b.country AS candidate_country, label
  FROM scored JOIN rec a ON a.entity_id = source1_entity_id JOIN rec b ON b.entity_id = candidate_entity_id)"""
_MISSING = "(source1_address_missing = 1 OR candidate_address_missing = 1 OR address_tfidf_cosine IS NULL OR address_token_sort IS NULL)"
STEPS = f"""d1 AS (SELECT * FROM dec WHERE probability >= 0.6),
d2 AS (SELECT * FROM d1 QUALIFY row_number() OVER (PARTITION BY candidate_entity_id ORDER BY probability DESC, source1_entity_id) = 1),
d3 AS (SELECT * FROM d2 WHERE NOT coalesce((NOT {_MISSING} AND address_tfidf_cosine < 0.1 AND address_token_sort < 0.45) OR ({_MISSING} AND probability < 0.8), false)),
d4 AS (SELECT * FROM d3 WHERE lower(trim(source1_country)) = lower(trim(candidate_country)))"""
RANKED = """ranked AS (
  SELECT source1_entity_id, candidate_entity_id, score AS blocking_score, CAST(candidate_rank AS INTEGER) AS candidate_rank,
    max(CASE WHEN candidate_rank = 1 THEN score END) OVER w - max(CASE WHEN candidate_rank = 2 THEN score END) OVER w AS blocking_top1_top2_gap
  FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, candidate_entity_id) AS candidate_rank FROM scored)
  WINDOW w AS (PARTITION BY source1_entity_id))"""
PER = """per AS (
  SELECT s.ref AS source1_entity_id, CAST(coalesce(t.n, 0) AS BIGINT) AS n_true, CAST(coalesce(f.hit, 0) AS BIGINT) AS n_found, CAST(coalesce(f.n, 0) AS BIGINT) AS n_candidates
  FROM (SELECT entity_id AS ref FROM raw WHERE src = 1) s
  LEFT JOIN (SELECT source1_entity_id, count(*) AS n FROM links GROUP BY 1) t ON t.source1_entity_id = s.ref
  LEFT JOIN (SELECT source1_entity_id, count(*) AS n, sum(label) AS hit FROM (SELECT DISTINCT source1_entity_id, candidate_entity_id, label FROM ranked JOIN scored USING (source1_entity_id, candidate_entity_id) WHERE candidate_rank <= 20) GROUP BY 1) f ON f.source1_entity_id = s.ref)"""
GRAMS = """g AS (
  SELECT entity_id, src, field, substr(t, CAST(i AS BIGINT), n) AS gram, count(*) AS tf FROM (
    SELECT entity_id, src, field, t, n, unnest(range(1, length(t) - n + 2)) AS i FROM (
      SELECT entity_id, src, field, t, unnest([2, 3, 4]) AS n FROM (
        SELECT entity_id, src, 'name_norm' AS field, name_norm AS t FROM rec UNION ALL SELECT entity_id, src, 'address_norm', address_norm FROM rec) WHERE t IS NOT NULL))
  GROUP BY ALL),
idf AS (SELECT field, gram, ln((1 + n) / (1.0 + count(*))) + 1 AS idf FROM g, (SELECT count(*) AS n FROM rec WHERE src > 1) WHERE src > 1 GROUP BY field, gram, n),
wt AS (SELECT entity_id, src, field, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY entity_id, field)) AS w FROM g JOIN idf USING (field, gram))"""
WORDS = "list_distinct(list_filter(string_split(coalesce(name_norm, '') || ' ' || coalesce(address_norm, ''), ' '), lambda t: t <> ''))"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def f_beta(tp: str, p: str, t: str) -> str:
    return f"CASE WHEN {t} = 0 THEN CASE WHEN {p} = 0 THEN 1.0 ELSE 0.0 END WHEN {tp} = 0 THEN 0.0 ELSE 1.25 * ({tp} / {p}::DOUBLE) * ({tp} / {t}::DOUBLE) / (0.25 * ({tp} / {p}::DOUBLE) + {tp} / {t}::DOUBLE) END"
