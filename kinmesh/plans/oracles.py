"""The engine's queries as SQL that DuckDB runs on the raw tables, built from shared parts."""

from __future__ import annotations

from ..functions import rules as R
from ..operators.reports import KS
from .views import WITH


def _list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _case(var: str, mapping: dict) -> str:
    return f"CASE {var} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in mapping.items()) + f" ELSE {var} END"


def plain(c: str) -> str:
    t = f"translate(lower({c}), '{R.PUNCT_FROM}', '{R.PUNCT_TO.replace(chr(39), chr(39) * 2)}')"
    t = rf"regexp_replace({t}, '\s*&\s*', ' and ', 'g')"
    t = rf"regexp_replace({t}, '[^\p{{L}}\p{{N}}\p{{M}}\s''/#-]', ' ', 'g')"
    return rf"trim(regexp_replace({t}, '\s+', ' ', 'g'))"


def placeholder(c: str) -> str:
    v = rf"trim(regexp_replace(lower({c}), '\s+', ' ', 'g'))"
    return rf"({v} IN {_list(R.PLACEHOLDERS)} OR NOT regexp_matches({v}, '[\p{{L}}\p{{N}}]') OR regexp_matches({v}, '^0+$'))"


LATIN = [s for s in R.ALL_SUFFIXES if s.isascii()]
ALTERNATIVES = "|".join(s.replace(" ", "  ") for s in LATIN)
DOUBLED = "concat(' ', replace(regexp_replace(name_norm, '^m/s\\s+', ''), ' ', '  '), ' ')"
SOUND_FROM = "".join(c for c in "abcdefghijklmnopqrstuvwxyz" if c not in "hw")
_GROUP = {c: d for d, own in zip("123456", ("bfpv", "cgjkqsxz", "dt", "l", "mn", "r")) for c in own}
SOUND_TO = "".join(_GROUP.get(c, "0") for c in SOUND_FROM)
COLLAPSED = "code"
for _d in "0123456":
    COLLAPSED = f"regexp_replace({COLLAPSED}, '{_d}+', '{_d}', 'g')" if _d != "0" else COLLAPSED


def norm(table: str, more: str = "") -> str:
    """CTEs n_{table}: the normalised records of s1 or fr."""
    t = table
    units = rf"""list_concat(regexp_extract_all(addr_norm, '(?i)\b(?:{"|".join(R.UNIT_WORDS)})\b\.?\s*([0-9]+[a-z]?|[a-z]-?[0-9]+)', 1), regexp_extract_all(addr_norm, '#\s*([0-9]+[a-z]?)', 1))"""
    india, five = r"nullif(regexp_extract(addr_norm, '\b(\d{6})\b', 1), '')", r"nullif(regexp_extract(addr_norm, '\b(\d{5})\b', 1), '')"
    countries = "CASE s " + " ".join(f"WHEN '{s}' THEN [{', '.join(repr(c) for c in own)}]" for s, own in R.SUFFIX_COUNTRIES.items() if s.isascii()) + " END"
    landmark = " OR ".join(f"contains(concat(' ', addr_norm, ' '), ' {p} ')" for p in R.LANDMARKS)
    return rf"""
a_{t} AS (SELECT entity_id{more}, business_name, business_address, country, {placeholder("business_name")} AS name_missing, {placeholder("business_address")} AS addr_missing,
  {plain("business_name")} AS pn, {plain("business_address")} AS pa FROM {t}),
b_{t} AS (SELECT *, CASE WHEN name_missing THEN '' ELSE pn END AS name_norm, CASE WHEN addr_missing THEN '' ELSE
  array_to_string(list_transform(string_split(pa, ' '), lambda t: {_case("t", R.STREETS)}), ' ') END AS addr_norm,
  trim(regexp_replace(lower(country), '\s+', ' ', 'g')) AS country_norm FROM a_{t}),
c_{t} AS (SELECT *, list_sort(list_distinct(list_transform(regexp_extract_all({DOUBLED}, ' ({ALTERNATIVES}) ', 1), lambda s: replace(s, '  ', ' ')))) AS legal_suffixes,
  trim(regexp_replace(regexp_replace({DOUBLED}, ' ({ALTERNATIVES}) ', ' ', 'g'), '\s+', ' ', 'g')) AS stripped,
  {units} AS units, regexp_extract_all(addr_norm, '\b(\d+[a-z]?(?:/\d+[a-z]?)?)\b', 1) AS all_numbers,
  CASE WHEN country_norm IN {_list(R.USA + R.FRANCE)} THEN coalesce({five}, {india}) ELSE coalesce({india}, {five}) END AS postcode,
  ({landmark}) AS landmark_flag FROM b_{t}),
d_{t} AS (SELECT *, CASE WHEN stripped = '' THEN name_norm ELSE stripped END AS name_core,
  list_filter(all_numbers, lambda n: NOT list_contains(units, n))[1] AS house_number,
  list_sort(list_distinct(flatten(list_transform(legal_suffixes, lambda s: {countries})))) AS suffix_countries FROM c_{t}),
e_{t} AS (SELECT *, list_filter(list_transform(string_split(name_core, ' '), lambda t: {_case("t", R.VARIANTS)}), lambda t: t <> '') AS name_tokens,
  regexp_replace(strip_accents(name_core), '[^a-z]', '', 'g') AS letters FROM d_{t}),
f_{t} AS (SELECT *, concat(coalesce(nullif(translate(substr(letters, 1, 1), '{SOUND_FROM}', '{SOUND_TO}'), ''), '0'),
  translate(translate(substr(letters, 2), 'hw', ''), '{SOUND_FROM}', '{SOUND_TO}')) AS code FROM e_{t}),
n_{t} AS (SELECT *, CASE WHEN letters = '' THEN '' ELSE substr(rpad(concat(upper(substr(letters, 1, 1)), replace(substr({COLLAPSED}, 2), '0', '')),
  CAST(greatest(4, 1 + len(replace(substr({COLLAPSED}, 2), '0', ''))) AS INTEGER), '0'), 1, 6) END AS phonetic_key FROM f_{t})"""


NORMS = norm("s1") + "," + norm("fr", ", true_s1")

TOKENS = "list_filter(list_transform(regexp_split_to_array({c}, '\\s+'), lambda t: lower(trim(t, '.,;:!?()[]{{}}\"'''))), lambda t: t <> '')"
IDF = f"""
idf AS (SELECT token, count(*) AS df, ln(((SELECT count(*) FROM n_s1) + 1) / (count(*) + 1)) + 1 AS idf
  FROM (SELECT unnest(list_distinct({TOKENS.format(c="name_norm")})) AS token FROM n_s1) GROUP BY token)"""

GRAMS = """flatten(list_transform(string_split(name_norm, ' '), lambda w: flatten(list_transform([3, 4, 5], lambda k:
  CASE WHEN len(w) + 2 > k THEN list_transform(range(1, len(w) + 4 - k), lambda i: substr(concat(' ', w, ' '), i, k))
       WHEN len(w) + 2 = k OR k = 3 THEN [concat(' ', w, ' ')] ELSE [] END))))"""


def _unit(name: str, source: str) -> str:
    return f"""
{name}_tf AS (SELECT name_norm, term, count(*) AS tf FROM (SELECT name_norm, unnest({GRAMS}) AS term FROM (SELECT DISTINCT name_norm FROM {source} WHERE name_norm <> '')) GROUP BY ALL),
{name}_w AS (SELECT name_norm, term, tf * g.idf AS w FROM {name}_tf JOIN gram_idf g USING (term)),
{name}_u AS (SELECT a.name_norm, term, w / norm AS w FROM {name}_w a JOIN (SELECT name_norm, sqrt(sum(w * w)) AS norm FROM {name}_w GROUP BY 1) b ON a.name_norm = b.name_norm)"""


CHAR = f"""
gram_idf AS (SELECT term, ln(((SELECT count(*) FROM n_s1) + 1) / (sum(ids) + 1)) + 1 AS idf FROM (
  SELECT DISTINCT name_norm, ids, unnest({GRAMS}) AS term FROM (SELECT name_norm, count(*) AS ids FROM n_s1 WHERE name_norm <> '' GROUP BY 1)) GROUP BY term),
{_unit("gs", "n_s1")},{_unit("gf", "n_fr")},
char_names AS (SELECT q.name_norm AS asked, d.name_norm AS name, round(sum(q.w * d.w), 9) AS score FROM gf_u q JOIN gs_u d USING (term) GROUP BY 1, 2 HAVING round(sum(q.w * d.w), 9) >= 0.2),
char AS (SELECT frag_id, s1_id, score, rank FROM (
  SELECT f.entity_id AS frag_id, s.s1_id, s.score, s.rank FROM n_fr f JOIN (
    SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, s1_id) - 1 AS rank FROM (
      SELECT c.asked, m.entity_id AS s1_id, c.score FROM char_names c JOIN n_s1 m ON m.name_norm = c.name)) s ON f.name_norm = s.asked) WHERE rank < 50)"""

TEXT = "concat_ws(' ', name_norm, addr_norm)"
BM25 = f"""
bm_docs AS (SELECT entity_id AS s1_id, {TOKENS.format(c=TEXT)} AS words FROM n_s1),
bm_tf AS (SELECT s1_id, size, term, count(*) AS tf FROM (SELECT s1_id, len(words) AS size, unnest(words) AS term FROM bm_docs) GROUP BY ALL),
bm_stats AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM bm_docs),
bm_df AS (SELECT term, count(*) AS df FROM bm_tf GROUP BY 1),
bm_idf AS (SELECT term, mean, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM bm_df, bm_stats WHERE n < 1000 OR df <= 0.05 * n),
bm_index AS (SELECT term, s1_id, idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * size / mean)) AS w FROM bm_tf JOIN bm_idf USING (term)),
bm25 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frag_id ORDER BY score DESC, s1_id) - 1 AS rank FROM (
  SELECT frag_id, s1_id, round(sum(w), 9) AS score FROM (SELECT entity_id AS frag_id, unnest(list_distinct({TOKENS.format(c=TEXT)})) AS term FROM n_fr) JOIN bm_index USING (term) GROUP BY 1, 2)) WHERE rank < 50)"""


def _keys(t: str) -> str:
    return f"""
rare_{t} AS (SELECT DISTINCT entity_id, token FROM (
  SELECT entity_id, token, count(*) OVER (PARTITION BY entity_id) AS n,
    row_number() OVER (PARTITION BY entity_id ORDER BY round(coalesce(idf, (SELECT max(idf) FROM idf)), 9) DESC, pos) AS place
  FROM (SELECT entity_id, unnest(string_split(name_core, ' ')) AS token, unnest(range(1, len(string_split(name_core, ' ')) + 1)) AS pos FROM n_{t} WHERE name_core <> '') LEFT JOIN idf USING (token))
  WHERE place <= greatest(1, floor(n * 0.5))),
k_{t} AS (SELECT DISTINCT * FROM (
  SELECT 'pc_house' AS key_kind, postcode AS k1, house_number AS k2, entity_id FROM n_{t} WHERE postcode IS NOT NULL AND NOT addr_missing AND house_number IS NOT NULL
  UNION ALL SELECT 'pc_token', postcode, token, entity_id FROM n_{t} JOIN rare_{t} USING (entity_id) WHERE postcode IS NOT NULL AND NOT addr_missing
  UNION ALL SELECT 'metaphone_pc', phonetic_key, substr(postcode, 1, 3), entity_id FROM n_{t} WHERE postcode IS NOT NULL AND NOT addr_missing AND phonetic_key <> ''))"""


KEYS = f"""{_keys("s1")},{_keys("fr")},
k_size AS (SELECT key_kind, k1, k2, count(*) AS bucket FROM k_s1 GROUP BY ALL HAVING count(*) <= 200),
key_hits AS (SELECT f.entity_id AS frag_id, s.entity_id AS s1_id, bucket FROM k_fr f JOIN k_s1 s USING (key_kind, k1, k2) JOIN k_size USING (key_kind, k1, k2)),
keyed AS (SELECT frag_id, s1_id, round(max(1.0 / bucket), 9) AS score, 0 AS rank FROM key_hits GROUP BY 1, 2),
sure AS (SELECT DISTINCT frag_id, s1_id FROM key_hits WHERE bucket <= 5)"""


def fuse(name: str, k: int) -> str:
    return f"""
{name}_score AS (SELECT frag_id, s1_id, round(sum(1.0 / (60 + rank)), 9) AS rrf_score FROM (
  SELECT frag_id, s1_id, rank FROM char UNION ALL SELECT frag_id, s1_id, rank FROM bm25 UNION ALL SELECT frag_id, s1_id, rank FROM keyed) GROUP BY 1, 2),
{name}_cut AS (SELECT *, place < {k} AS kept FROM (SELECT s.*, u.s1_id IS NOT NULL AS sure, row_number() OVER (PARTITION BY s.frag_id ORDER BY rrf_score DESC, s.s1_id) - 1 AS place
  FROM {name}_score s LEFT JOIN sure u ON s.frag_id = u.frag_id AND s.s1_id = u.s1_id) WHERE place < {k} OR sure),
{name} AS (SELECT frag_id, s1_id, rrf_score, row_number() OVER (PARTITION BY frag_id ORDER BY kept DESC, CASE WHEN kept THEN place END, s1_id) - 1 AS rrf_rank, NOT kept AS forced FROM {name}_cut)"""


BLOCKED = f"{WITH},{NORMS},{IDF},{CHAR},{BM25},{KEYS},{fuse('fused', 25)}"
TRUTH = "truth AS (SELECT true_s1 AS s1_id, entity_id AS frag_id FROM fr WHERE true_s1 IS NOT NULL)"

PI = """
odds AS (SELECT frag_id, s1_id, p / (1 - p) AS w FROM (SELECT frag_id, s1_id, least(greatest(greatest(0.55 * pow(CAST(0.55 AS DOUBLE), rrf_rank), CAST(1e-6 AS DOUBLE)), 0.0), 1 - CAST(1e-12 AS DOUBLE)) AS p FROM fused)),
pi AS (SELECT frag_id, s1_id, w / (1.0 + sum(w) OVER (PARTITION BY frag_id)) AS pi, 1.0 / (1.0 + sum(w) OVER (PARTITION BY frag_id)) AS pi_null FROM odds)"""


def _pmf(q: str) -> str:
    grown = "list_transform(range(1, len(m) + 2), lambda i: coalesce(m[i], 0) * (1 - p[1]) + CASE WHEN i > 1 THEN m[i - 1] * p[1] ELSE 0 END)"
    return f"list_reduce(list_transform({q}, lambda x: [x]), lambda m, p: {grown}, [CAST(1 AS DOUBLE)])"


DECODE = f"""
live AS (SELECT s1_id, frag_id, pi, row_number() OVER (PARTITION BY s1_id ORDER BY round(pi, 12) DESC, frag_id) AS place FROM pi WHERE pi >= 0.02),
qs AS (SELECT s1_id, list(pi ORDER BY place) AS q FROM live GROUP BY 1),
ks AS (SELECT s1_id, q, unnest(range(0, len(q) + 1)) AS k FROM qs),
pm AS (SELECT s1_id, k, {_pmf("q[1:k]")} AS inn, {_pmf("q[k + 1:]")} AS rest FROM ks),
ef AS (SELECT s1_id, k, round(CASE WHEN k = 0 THEN rest[1] ELSE coalesce(list_sum(list_transform(range(2, len(inn) + 1), lambda a:
  list_sum(list_transform(range(1, len(rest) + 1), lambda b: inn[a] * rest[b] * 1.25 * (a - 1) / (0.25 * (a - 1 + b - 1) + k))))), 0) END, 12) AS ef FROM pm),
best AS (SELECT s1_id, k, ef FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY ef DESC, k) AS r FROM ef) WHERE r = 1),
chosen AS (SELECT l.s1_id, frag_id, pi, best.ef FROM live l JOIN best ON l.s1_id = best.s1_id WHERE place <= k),
predicted AS (SELECT s1_id, frag_id, pi FROM (SELECT *, row_number() OVER (PARTITION BY frag_id ORDER BY round(pi, 12) DESC, s1_id) AS r FROM chosen) WHERE r = 1)"""

#: Without the floor: all candidates enter.
DECODE_ALL = DECODE.replace(" WHERE pi >= 0.02", "")
DECODED = f"{BLOCKED},{PI},{DECODE},{TRUTH}"
SCORES = f"""{DECODED},
both_ AS (SELECT coalesce(t.s1_id, p.s1_id) AS s1_id, count(t.frag_id) AS t, count(p.frag_id) AS p, count(*) FILTER (WHERE t.frag_id IS NOT NULL AND p.frag_id IS NOT NULL) AS tp
  FROM truth t FULL JOIN predicted p ON t.s1_id = p.s1_id AND t.frag_id = p.frag_id GROUP BY 1),
scores AS (SELECT s1.entity_id AS s1_id, country, coalesce(t, 0) AS t, coalesce(p, 0) AS p, coalesce(tp, 0) AS tp,
  CASE WHEN coalesce(t, 0) = 0 AND coalesce(p, 0) = 0 THEN 1.0 ELSE 1.25 * coalesce(tp, 0) / (0.25 * coalesce(t, 0) + coalesce(p, 0)) END AS f FROM s1 LEFT JOIN both_ ON s1.entity_id = both_.s1_id)"""
HIT = "SELECT t.s1_id, t.frag_id, c.s1_id IS NOT NULL AS hit FROM truth t LEFT JOIN fused c ON t.s1_id = c.s1_id AND t.frag_id = c.frag_id"
CARD = "CASE WHEN t = 0 THEN 't=0' WHEN t = 1 THEN 't=1' WHEN t <= 4 THEN 't=2-4' ELSE 't>=5' END"
BLOCKED_T = f"{BLOCKED}, {TRUTH}"
VIEW_T = f"{WITH}, {TRUTH}"


def _bag(a: str, b: str) -> str:
    common = f"coalesce(list_sum(list_transform(list_distinct(string_split({a}, '')), lambda c: CASE WHEN c = '' THEN 0 ELSE least(len({a}) - len(replace({a}, c, '')), len({b}) - len(replace({b}, c, ''))) END)), 0)"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE 2.0 * {common} / (len({a}) + len({b})) END"


def _set(a: str, b: str) -> str:
    x, y = f"list_filter(string_split({a}, ' '), lambda t: t <> '')", f"list_filter(string_split({b}, ' '), lambda t: t <> '')"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE len(list_intersect({x}, {y})) / len(list_distinct(list_concat({x}, {y}))) END"


def _three(a: str, b: str) -> str:
    return f"CASE WHEN coalesce({a}, '') = '' OR coalesce({b}, '') = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE 2.0 END"


def _numbers(a: str) -> str:
    return rf"array_to_string(list_sort(list_distinct(regexp_extract_all({a}, '\d+'))), ',')"


def _sorted(a: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({a}, ' '), lambda t: t <> '')), ' ')"


PAIRS = f"""{BLOCKED},
pairs AS (SELECT c.*, count(*) OVER w AS cand_count, max(rrf_score) OVER w - rrf_score AS gap, f.name_norm AS fn, s.name_norm AS sn, f.name_core AS fc, s.name_core AS sc, f.name_tokens AS ft, s.name_tokens AS st,
  f.addr_norm AS fa, s.addr_norm AS sa, f.postcode AS fp, s.postcode AS sp, f.house_number AS fh, s.house_number AS sh, f.units AS fu, s.units AS su, f.legal_suffixes AS fl, s.legal_suffixes AS sl, f.country_norm AS fco, s.country_norm AS sco
  FROM fused c JOIN n_fr f ON c.frag_id = f.entity_id JOIN n_s1 s ON c.s1_id = s.entity_id WINDOW w AS (PARTITION BY frag_id))"""

TOKEN_IDF = """
tidf AS (SELECT token, ln(((SELECT count(*) FROM n_s1) + 1) / (count(*) + 1)) + 1 AS idf FROM (SELECT unnest(list_distinct(name_tokens)) AS token FROM n_s1) GROUP BY 1)"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalise_name_address"] = f"{WITH},{NORMS} SELECT entity_id, name_norm, addr_norm, country_norm FROM n_fr"
    q["legal_suffixes"] = f"{WITH},{NORMS} SELECT entity_id, name_core, array_to_string(legal_suffixes, ',') AS suffixes, array_to_string(suffix_countries, ',') AS countries FROM n_fr"
    q["name_tokens_phonetic"] = f"{WITH},{NORMS} SELECT entity_id, array_to_string(name_tokens, ' ') AS name_tokens, strip_accents(name_core) AS name_core_ascii, phonetic_key FROM n_fr"
    q["postcode_numbers"] = f"{WITH},{NORMS} SELECT entity_id, postcode, house_number, array_to_string(units, ',') AS units, array_to_string(all_numbers, ',') AS all_numbers, landmark_flag FROM n_fr"
    q["placeholder_flags"] = f"{WITH},{NORMS} SELECT entity_id, name_missing, addr_missing FROM n_fr"
    q["token_idf"] = f"{WITH},{NORMS},{IDF} SELECT token, df, round(idf, 6) AS idf FROM idf"
    q["high_df_tokens"] = f"""{WITH},{NORMS},{IDF}, o AS (SELECT token, df, row_number() OVER (ORDER BY df) - 1 AS i, count(*) OVER () AS n FROM idf)
SELECT token, df FROM idf WHERE df >= (SELECT min(df) FROM o WHERE i >= least(n - 1, floor(n * 0.99)))"""
    q["char_tfidf_topk"] = f"{WITH},{NORMS},{CHAR} SELECT frag_id, s1_id, floor(score * 1e6 + 1e-3) / 1e6 AS score, CAST(rank AS INTEGER) AS rank FROM char"
    q["bm25_topk"] = f"{WITH},{NORMS},{BM25} SELECT frag_id, s1_id, floor(score * 1e6 + 1e-3) / 1e6 AS score, CAST(rank AS INTEGER) AS rank FROM bm25"
    q["key_candidates"] = f"{WITH},{NORMS},{IDF},{KEYS} SELECT frag_id, s1_id, floor(score * 1e6 + 1e-3) / 1e6 AS score FROM keyed"
    q["confident_key_hits"] = f"{WITH},{NORMS},{IDF},{KEYS} SELECT frag_id, s1_id FROM sure"
    q["dense_topk"] = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
s AS (SELECT CAST(a.vec_id AS VARCHAR) AS frag_id, CAST(b.vec_id AS VARCHAR) AS s1_id, round(list_cosine_similarity(a.e, b.e), 9) AS score FROM v a, v b WHERE a.vec_id <> b.vec_id)
SELECT frag_id, s1_id, floor(score * 1e6 + 1e-3) / 1e6 AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY frag_id ORDER BY score DESC, s1_id) - 1 AS rank FROM s) WHERE rank < 10"""
    q["rrf_fusion"] = f"{BLOCKED} SELECT frag_id, s1_id, round(rrf_score, 6) AS rrf_score, CAST(rrf_rank AS INTEGER) AS rrf_rank, forced FROM fused"
    q["invert_candidates"] = f"{BLOCKED} SELECT s1_id, string_agg(DISTINCT frag_id, ',' ORDER BY frag_id) AS frag_ids FROM fused GROUP BY 1"
    q["pair_completeness"] = f"{BLOCKED_T}, h AS ({HIT}) SELECT count(*) AS true_pairs, count(*) FILTER (WHERE hit) AS found_pairs, round(count(*) FILTER (WHERE hit) / count(*), 6) AS pair_completeness FROM h"
    q["reduction_ratio"] = f"{BLOCKED} SELECT count(*) AS pairs, (SELECT count(*) FROM s1) AS n_s1, (SELECT count(*) FROM fr) AS n_frags, round(1 - count(*) / ((SELECT count(*) FROM s1) * (SELECT count(*) FROM fr)), 9) AS reduction_ratio FROM fused"
    per = f"{BLOCKED_T}, h AS ({HIT}), x AS (SELECT s1.entity_id AS s1_id, count(h.frag_id) AS t, count(*) FILTER (WHERE hit) AS tp FROM s1 LEFT JOIN h ON h.s1_id = s1.entity_id GROUP BY 1)"
    q["entity_ceiling"] = f"""{per} SELECT count(*) AS n, count(*) FILTER (WHERE t = 0) AS singletons, count(*) FILTER (WHERE t > 0 AND tp = t) AS "full", count(*) FILTER (WHERE t > 0 AND tp < t) AS "partial",
round((count(*) FILTER (WHERE t > 0 AND tp = t) + count(*) FILTER (WHERE t = 0)) / count(*), 6) AS entity_ceiling,
round(1 - coalesce(sum(CASE WHEN tp = 0 THEN 1.0 ELSE 1 - 1.25 * tp / (0.25 * t + tp) END) FILTER (WHERE t > 0 AND tp < t), 0) / count(*), 6) AS macro_f05_ceiling FROM x"""
    q["candidates_per_fragment"] = f"""{BLOCKED}, c AS (SELECT entity_id, count(s1_id) AS c FROM fr LEFT JOIN fused ON frag_id = entity_id GROUP BY 1), o AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i, count(*) OVER () AS n FROM c)
SELECT count(*) AS n, round(avg(c), 6) AS mean, min(c) AS least, max(c) AS most, count(*) FILTER (WHERE c = 0) AS n_zero, min(c) FILTER (WHERE i = floor(n * 0.5)) AS p50, min(c) FILTER (WHERE i = floor(n * 0.95)) AS p95 FROM o"""
    q["pc_vs_k"] = f"""{BLOCKED_T},{fuse('deep', max(KS))}, x AS (SELECT d.*, t.s1_id IS NOT NULL AS hit, u.s1_id IS NOT NULL AS sure FROM deep d LEFT JOIN truth t ON d.frag_id = t.frag_id AND d.s1_id = t.s1_id LEFT JOIN sure u ON d.frag_id = u.frag_id AND d.s1_id = u.s1_id)
SELECT CAST(k AS INTEGER) AS k, count(*) AS pairs, round(count(*) FILTER (WHERE hit) / (SELECT count(*) FROM truth), 6) AS pair_completeness, round(count(*) / (SELECT count(*) FROM fr), 6) AS per_fragment
FROM x, (SELECT unnest({KS}) AS k) WHERE (NOT forced AND rrf_rank < k) OR sure GROUP BY k"""
    q["ceilings_vs_k"] = f"""{BLOCKED_T},{fuse('deep', max(KS))}, ks AS (SELECT unnest({KS}) AS k),
h AS (SELECT t.s1_id, t.frag_id, CASE WHEN u.s1_id IS NOT NULL AND d.s1_id IS NOT NULL THEN 0 WHEN NOT d.forced THEN d.rrf_rank + 1 END AS least FROM truth t
  LEFT JOIN deep d ON d.frag_id = t.frag_id AND d.s1_id = t.s1_id LEFT JOIN sure u ON u.frag_id = t.frag_id AND u.s1_id = t.s1_id),
x AS (SELECT k, s1.entity_id, count(h.frag_id) AS t, count(*) FILTER (WHERE least <= k) AS tp FROM s1 CROSS JOIN ks LEFT JOIN h ON h.s1_id = s1.entity_id GROUP BY 1, 2)
SELECT CAST(k AS INTEGER) AS k, round(count(*) FILTER (WHERE tp = t) / count(*), 6) AS entity_ceiling,
  round(1 - sum(CASE WHEN tp = t THEN 0.0 WHEN tp = 0 THEN 1.0 ELSE 1 - 1.25 * tp / (0.25 * t + tp) END) / count(*), 6) AS macro_f05_ceiling FROM x GROUP BY 1"""
    q["truth_shape"] = f"{VIEW_T}, x AS (SELECT s1_id, count(*) AS t FROM truth GROUP BY 1) SELECT count(*) AS n_rows, count(*) AS n_masters, true AS lists, round(avg(t), 6) AS mean_t, max(t) AS max_t FROM x"
    q["blocking_gate"] = f"SELECT CAST(min(k) AS INTEGER) AS first_k FROM ({q['pc_vs_k']}) WHERE k <= 30 AND pair_completeness >= 0.99"
    q["blocking_slices"] = f"""{BLOCKED_T}, h AS ({HIT}), x AS (SELECT hit, 'country' AS slice, n.country_norm AS value FROM h JOIN n_s1 n ON n.entity_id = h.s1_id UNION ALL SELECT hit, 'vendor', split_part(frag_id, '-', 1) FROM h)
SELECT slice, value, count(*) AS true_pairs, round(count(*) FILTER (WHERE hit) / count(*), 6) AS pair_completeness FROM x GROUP BY 1, 2"""
    q["channel_reach"] = f"{BLOCKED} SELECT 'char' AS channel, count(DISTINCT frag_id) AS fragments, count(*) AS hits FROM char UNION ALL SELECT 'bm25', count(DISTINCT frag_id), count(*) FROM bm25 UNION ALL SELECT 'keys', count(DISTINCT frag_id), count(*) FROM keyed"
    branch = "[" + ", ".join(f"'{b}'" for b in R.BRANCHES) + "]"
    initials = "array_to_string(list_transform({x}, lambda t: substr(t, 1, 1)), '')"
    words = lambda c: f"list_filter(string_split({c}, ' '), lambda t: t <> '')"
    one = lambda x, y: f"(len({words(x)}) >= 2 AND list_contains({words(y)}, {initials.format(x=words(x))}))"
    differ = lambda a, b: f"len(list_filter({a}, lambda t: NOT list_contains({b}, t) AND list_contains({branch}, t))) > 0"
    q["pair_features_text"] = f"""{PAIRS} SELECT frag_id, s1_id, round({_bag('fn', 'sn')}, 6) AS name_ratio, round({_bag('fc', 'sc')}, 6) AS name_core_ratio, round({_set('fc', 'sc')}, 6) AS name_token_set,
round({_bag(_sorted('fc'), _sorted('sc'))}, 6) AS name_token_sort, round({_bag('fa', 'sa')}, 6) AS addr_ratio, round({_set('fa', 'sa')}, 6) AS addr_token_set FROM pairs"""
    # DuckDB compares bytes, the engine characters: each accented letter becomes a byte that no normalised name holds
    accents = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœßāēīōū"
    single = lambda c: "translate({}, '{}', {})".format(c, accents, " || ".join(f"chr({i})" for i in range(1, 9)) + " || '!$%()*+,.:;<=>?@[]^_`{|}~'")
    q["pair_name_jaro"] = f"{PAIRS} SELECT frag_id, s1_id, round(CASE WHEN fc = '' OR sc = '' THEN 0.0 ELSE jaro_winkler_similarity({single('fc')}, {single('sc')}) END, 6) AS name_jaro FROM pairs"
    q["pair_features_state"] = f"""{PAIRS} SELECT frag_id, s1_id, round(rrf_score, 6) AS rrf_score, CAST(rrf_rank AS DOUBLE) AS rrf_rank, {_three('fh', 'sh')} AS house_state, {_three(_numbers('fn'), _numbers('sn'))} AS name_number_match, {_three("array_to_string(fu, ',')", "array_to_string(su, ',')")} AS unit_state,
CASE WHEN coalesce(fp, '') = '' OR coalesce(sp, '') = '' THEN 0.0 WHEN fp = sp THEN 1.0 WHEN substr(fp, 1, 3) = substr(sp, 1, 3) THEN 2.0 ELSE 3.0 END AS postcode_state,
CASE WHEN len(fl) = 0 OR len(sl) = 0 THEN 0.0 WHEN list_has_any(fl, sl) THEN 1.0 ELSE 2.0 END AS suffix_state, CASE WHEN {one('fc', 'sc')} OR {one('sc', 'fc')} THEN 1.0 ELSE 0.0 END AS acronym,
CASE WHEN {differ('ft', 'st')} OR {differ('st', 'ft')} THEN 1.0 ELSE 0.0 END AS branch_word_conflict,
CAST(cand_count AS DOUBLE) AS cand_count, round(gap, 6) AS score_gap_to_best, CASE WHEN rrf_rank = 0 THEN 1.0 ELSE 0.0 END AS is_best_candidate,
CAST((SELECT count(*) FROM n_s1 m WHERE m.name_core = sc) AS DOUBLE) AS s1_share_name_core, CAST((SELECT count(*) FROM n_s1 m WHERE m.addr_norm = sa) AS DOUBLE) AS s1_share_address,
CASE WHEN starts_with(frag_id, 'S3-') THEN 1.0 ELSE 0.0 END AS vendor_is_s3, CASE WHEN fco = sco THEN 1.0 ELSE 0.0 END AS country_known FROM pairs"""
    q["pair_features_idf"] = f"""{PAIRS},{TOKEN_IDF}, u AS (SELECT frag_id, s1_id, ft, st, unnest(list_distinct(list_concat(ft, st))) AS token FROM pairs),
w AS (SELECT frag_id, s1_id, list_contains(ft, token) AND list_contains(st, token) AS both_in, coalesce(idf, (SELECT max(idf) FROM tidf)) AS w FROM u LEFT JOIN tidf USING (token))
SELECT frag_id, s1_id, round(coalesce(sum(w) FILTER (WHERE both_in), 0) / sum(w), 6) AS idf_jaccard, round(coalesce(sum(w) FILTER (WHERE both_in), 0), 6) AS idf_shared_sum,
round(coalesce(sum(w) FILTER (WHERE NOT both_in), 0), 6) AS idf_unshared_sum, round(coalesce(max(w) FILTER (WHERE both_in), 0), 6) AS idf_rarest_shared FROM w GROUP BY 1, 2"""
    q["softmax_null"] = f"{BLOCKED},{PI} SELECT frag_id, s1_id, round(pi, 6) AS pi, round(pi_null, 6) AS pi_null FROM pi"
    q["poisson_binomial"] = f"{BLOCKED},{PI},{DECODE} SELECT s1_id, unnest(range(0, len(m))) AS k, round(unnest(m), 6) AS p FROM (SELECT s1_id, {_pmf('q')} AS m FROM qs)"
    q["expected_f05_decode"] = f"{BLOCKED},{PI},{DECODE_ALL} SELECT s1_id, frag_id, round(pi, 6) AS pi, round(ef, 6) AS ef FROM chosen"
    q["exclusivity_guard"] = f"{DECODED} SELECT s1_id, frag_id, round(pi, 6) AS pi FROM predicted"
    q["submission_rows"] = f"{DECODED} SELECT s1.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT frag_id, ',' ORDER BY frag_id), '') AS matched_entity_ids FROM s1 LEFT JOIN predicted ON s1_id = entity_id GROUP BY 1"
    q["macro_f05"] = f"{SCORES} SELECT count(*) AS n, round(avg(f), 6) AS macro_f05, round(avg(f) FILTER (WHERE t = 0), 6) AS singleton_accuracy FROM scores"
    q["macro_f05_slices"] = f"{SCORES}, x AS (SELECT f, 'cardinality' AS slice, {CARD} AS value FROM scores UNION ALL SELECT f, 'country', lower(trim(country)) FROM scores) SELECT slice, value, count(*) AS n, round(avg(f), 6) AS macro_f05 FROM x GROUP BY 1, 2"
    q["vendor_breakdown"] = f"{DECODED} SELECT vendor, coalesce(max(a), 0) AS n_true, coalesce(max(b), 0) AS n_predicted FROM (SELECT split_part(frag_id, '-', 1) AS vendor, count(*) AS a, NULL AS b FROM truth GROUP BY 1 UNION ALL SELECT split_part(frag_id, '-', 1), NULL, count(*) FROM predicted GROUP BY 1) GROUP BY 1"
    q["country_report"] = f"{WITH}, r AS (SELECT split_part(entity_id, '-', 1) AS source, country FROM s1 UNION ALL SELECT split_part(entity_id, '-', 1), country FROM fr) SELECT source, country AS raw, lower(trim(country)) AS label, count(*) AS n FROM r GROUP BY ALL"
    q["unseen_labels"] = f"{WITH} SELECT DISTINCT lower(country) AS label FROM s1 EXCEPT SELECT DISTINCT lower(country) FROM s1 WHERE country <> 'France'"
    q["multi_owner"] = f"{WITH}, t AS (SELECT true_s1, substr(entity_id, 1, 9) AS g FROM fr WHERE true_s1 IS NOT NULL) SELECT g AS frag_id, count(DISTINCT true_s1) AS owners FROM t GROUP BY 1 HAVING count(DISTINCT true_s1) > 1"
    q["per_vendor_matches"] = f"{VIEW_T} SELECT vendor, count(*) AS masters, max(n) AS most FROM (SELECT s1_id, split_part(frag_id, '-', 1) AS vendor, count(*) AS n FROM truth GROUP BY 1, 2) GROUP BY 1"
    q["cardinality_histogram"] = f"{VIEW_T} SELECT t, count(*) AS n FROM (SELECT entity_id, count(frag_id) AS t FROM s1 LEFT JOIN truth ON s1_id = entity_id GROUP BY 1) GROUP BY 1"
    q["cardinality_by_country"] = f"""{VIEW_T}, x AS (SELECT entity_id, country, count(frag_id) AS t FROM s1 LEFT JOIN truth ON s1_id = entity_id GROUP BY 1, 2)
SELECT country, count(*) AS n, count(*) FILTER (WHERE t = 0) AS t0, count(*) FILTER (WHERE t = 1) AS t1, count(*) FILTER (WHERE t BETWEEN 2 AND 4) AS t2_4, count(*) FILTER (WHERE t >= 5) AS t5, round(count(*) FILTER (WHERE t = 0) / count(*), 6) AS singleton_rate FROM x GROUP BY ROLLUP (country)"""
    q["orphan_report"] = f"{WITH} SELECT split_part(entity_id, '-', 1) AS vendor, count(*) AS n, count(*) FILTER (WHERE true_s1 IS NULL) AS n_orphans, round(count(*) FILTER (WHERE true_s1 IS NULL) / count(*), 6) AS rate FROM fr GROUP BY 1"
    q["cross_country"] = f"{WITH}, f AS (SELECT entity_id AS frag_id, true_s1 AS s1_id, CASE WHEN regexp_matches(entity_id, '7$') THEN 'atlantis' ELSE lower(country) END AS frag_country FROM fr WHERE true_s1 IS NOT NULL) SELECT frag_id, s1_id, frag_country, lower(country) AS s1_country FROM f JOIN s1 ON s1_id = entity_id WHERE frag_country <> lower(country)"
    q["differing_tokens"] = f"""{WITH},{NORMS}, x AS (SELECT f.name_tokens AS f, s.name_tokens AS s FROM n_fr f JOIN n_s1 s ON f.true_s1 = s.entity_id),
y AS (SELECT 'added' AS kind, unnest(list_distinct(list_filter(f, lambda t: NOT list_contains(s, t)))) AS token FROM x UNION ALL SELECT 'dropped', unnest(list_distinct(list_filter(s, lambda t: NOT list_contains(f, t)))) FROM x) SELECT kind, token, count(*) AS n FROM y GROUP BY 1, 2"""
    q["script_census"] = r"""SELECT lang AS grp, CASE WHEN NOT regexp_matches(text, '\p{L}') THEN 'none' WHEN NOT regexp_matches(text, '[^\P{L}\p{Latin}]') THEN 'latin' ELSE 'mixed' END AS script, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, '[^\x00-\x7F]')) AS n_non_ascii FROM documents GROUP BY 1, 2"""
    q["placeholder_discovery"] = f"""{WITH}, v AS (SELECT 'business_address' AS "column", lower(trim(business_address)) AS value FROM fr UNION ALL SELECT 'business_name', lower(trim(business_name)) FROM fr), n AS (SELECT "column", count(*) AS total FROM v GROUP BY 1)
SELECT v."column", value, count(*) AS n, round(count(*) / any_value(total), 6) AS share FROM v JOIN n ON v."column" = n."column" WHERE len(value) <= 3 GROUP BY 1, 2 HAVING count(*) > 0.01 * any_value(total)"""
    q["literal_na_counts"] = f"""{WITH}, v AS (SELECT 'business_address' AS "column", lower(trim(business_address)) AS mark FROM fr UNION ALL SELECT 'business_name', lower(trim(business_name)) FROM fr) SELECT "column", mark, count(*) AS n FROM v WHERE mark IN {_list(R.NA_MARKS)} GROUP BY 1, 2"""
    q["scale_report"] = f"{WITH} SELECT split_part(entity_id, '-', 1) AS source, count(*) AS n FROM (SELECT entity_id FROM s1 UNION ALL SELECT entity_id FROM fr) GROUP BY 1"
    q["namespace_violations"] = f"""{WITH}, r AS (SELECT 'S2' AS source, entity_id FROM fr UNION ALL SELECT 'S3', entity_id FROM fr WHERE starts_with(entity_id, 'S3-'))
SELECT 'wrong_prefix' AS problem, source, entity_id FROM r WHERE NOT starts_with(entity_id, source || '-') UNION ALL
SELECT 'repeated', source, entity_id FROM r GROUP BY 1, 2, 3 HAVING count(*) > 1 UNION ALL SELECT 'shared', min(source), entity_id FROM r GROUP BY 3 HAVING count(DISTINCT source) > 1"""
    q["validator_violations"] = f"""{DECODED}, m AS (SELECT s1_id, frag_id FROM predicted UNION ALL SELECT s1_id, 'S2-unknown' FROM predicted WHERE s1_id LIKE '%7' GROUP BY 1)
SELECT 'missing_row' AS problem, entity_id AS s1_id, NULL AS detail FROM s1 ANTI JOIN m ON m.s1_id = s1.entity_id UNION ALL
SELECT 'unknown_id', s1_id, frag_id FROM m ANTI JOIN fr ON fr.entity_id = m.frag_id UNION ALL
SELECT 'not_a_candidate', s1_id, frag_id FROM m ANTI JOIN fused c ON c.s1_id = m.s1_id AND c.frag_id = m.frag_id"""
    return q
