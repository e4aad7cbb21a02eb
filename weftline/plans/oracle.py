"""The reference results in DuckDB SQL: common table expressions that build on each other, and a final SELECT for each query."""

from __future__ import annotations

#: Rows of a block at most: the reference's default, and one at which small tables have heavy blocks. Pairs of a company at most. Words left out.
LIMIT, SMALL, CAP, STOP = 200, 6, 200, ("red", "blue")

_COMP = """comp AS (
  SELECT CAST(p_partkey AS BIGINT) company_id, lower(p_name) company_name,
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE replace(lower(p_brand), '#', '') || '-' || CAST(p_size AS VARCHAR) || '.com' END domain_name,
    CASE WHEN p_partkey % 5 <> 0 THEN lower(p_type) END city, lower(p_brand) final_country,
    CAST(p_size AS INTEGER) current_employee_estimate, CAST(floor(p_retailprice) AS INTEGER) total_employee_estimate
  FROM part)"""

_BASE = r"""base AS (
  SELECT company_id, nullif(lower(trim(domain_name)), '') "domain", nullif(lower(trim(city)), '') city, nullif(lower(trim(final_country)), '') country,
    regexp_replace(lower(company_name), '[^a-z0-9\s]', '', 'g') name_spaces,
    regexp_replace(lower(company_name), '[^a-z0-9]', '', 'g') name_compact
  FROM comp)"""


def _key(kind: str, n: int, other: str, source: str = "base") -> str:
    return f"SELECT '{kind}' kind, left(name_compact, {n}) || '|' || {other} bkey, company_id FROM {source} WHERE length(name_compact) >= {n} AND {other} IS NOT NULL"


def _stage(i: int, limit: int) -> str:
    return f"""size{i} AS (SELECT kind, bkey, count(*) n FROM rows{i} GROUP BY kind, bkey),
kept{i} AS (SELECT r.* FROM rows{i} r JOIN size{i} s USING (kind, bkey) WHERE n BETWEEN 2 AND {limit}),
big{i} AS (SELECT r.*, n FROM rows{i} r JOIN size{i} s USING (kind, bkey) WHERE n > {limit})"""


def _blocks(limit: int) -> str:
    stop = ", ".join(f"'{w}'" for w in STOP)
    heavy = lambda kind, of: f"(SELECT * FROM base WHERE company_id IN (SELECT company_id FROM {of} WHERE kind = '{kind}'))"
    return f"""raw1 AS (SELECT 'domain' kind, "domain" bkey, company_id FROM base WHERE "domain" IS NOT NULL
  UNION ALL {_key('name3_country', 3, 'country')} UNION ALL {_key('compact5_city', 5, 'city')}),
rows1 AS (SELECT DISTINCT * FROM raw1),
{_stage(1, limit)},
rows2 AS (SELECT DISTINCT * FROM ({_key('name4_country', 4, 'country', heavy('name3_country', 'big1'))}
  UNION ALL {_key('compact7_city', 7, 'city', heavy('compact5_city', 'big1'))}
  UNION ALL SELECT 'domain_country', "domain" || '|' || country, company_id FROM {heavy('domain', 'big1')} WHERE "domain" IS NOT NULL AND country IS NOT NULL)),
{_stage(2, limit)},
cand AS (SELECT * FROM {heavy('name4_country', 'big2')}),
words AS (SELECT company_id, country, tok FROM (SELECT company_id, country, unnest(string_split(name_spaces, ' ')) tok FROM cand WHERE country IS NOT NULL)
  WHERE tok <> '' AND length(tok) >= 3 AND tok NOT IN ({stop})),
tdf AS (SELECT country, tok, count(*) df FROM words GROUP BY country, tok),
tokens AS (SELECT company_id, country, tok, df FROM (SELECT w.company_id, country, tok, df, row_number() OVER (PARTITION BY company_id ORDER BY df, tok) rn FROM words w JOIN tdf USING (country, tok)) WHERE rn = 1),
rows3 AS (SELECT DISTINCT * FROM (SELECT 'token_country' kind, tok || '|' || country bkey, company_id FROM tokens UNION ALL {_key('name6_country', 6, 'country', 'cand')})),
{_stage(3, limit)},
blocks AS (SELECT * FROM kept1 UNION ALL SELECT * FROM kept2 UNION ALL SELECT * FROM kept3),
heavy AS (SELECT * FROM big2 UNION ALL SELECT * FROM big3)"""


_PAIRS = f"""kinded AS (SELECT a.kind, a.bkey, a.company_id company_id_a, b.company_id company_id_b FROM blocks a JOIN blocks b ON a.kind = b.kind AND a.bkey = b.bkey AND b.company_id > a.company_id),
pairs AS (SELECT company_id_a, company_id_b FROM (SELECT *, row_number() OVER (PARTITION BY company_id_a ORDER BY company_id_b) rn FROM (SELECT DISTINCT company_id_a, company_id_b FROM kinded)) WHERE rn <= {CAP})"""


def _diff(c: str) -> tuple[str, str]:
    a, b = f"coalesce(a.{c}, 0)", f"coalesce(b.{c}, 0)"
    return f"abs({a} - {b})", f"CASE WHEN greatest({a}, {b}) > 0 THEN CAST(abs({a} - {b}) AS DOUBLE) / greatest({a}, {b}) END"


def _features() -> str:
    eq = lambda c: f"CAST(a.{c} IS NOT NULL AND a.{c} = b.{c} AS INTEGER)"
    pre = lambda n: f"CASE WHEN a.cn IS NOT NULL AND b.cn IS NOT NULL AND left(a.cn, {n}) = left(b.cn, {n}) THEN 1 ELSE 0 END"
    cur, tot = _diff("current_employee_estimate"), _diff("total_employee_estimate")
    return f"""norm AS (SELECT *, regexp_replace(lower(company_name), '[^a-z0-9]+', '', 'g') cn FROM comp),
features AS (SELECT company_id_a, company_id_b, {eq('domain_name')} domain_exact, {eq('final_country')} country_exact, {eq('city')} city_exact, {eq('company_name')} name_exact, {eq('cn')} name_compact_exact,
  {pre(4)} name_prefix4_eq, {pre(6)} name_prefix6_eq, {cur[0]} emp_cur_absdiff, {cur[1]} emp_cur_reldiff, {tot[0]} emp_tot_absdiff, {tot[1]} emp_tot_reldiff,
  CAST(a.domain_name IS NOT NULL AND b.domain_name IS NOT NULL AS INTEGER) both_have_domain, CAST(a.company_name IS NOT NULL AND b.company_name IS NOT NULL AS INTEGER) both_have_name,
  a.final_country country_a, b.final_country country_b, a.city city_a, b.city city_b
  FROM pairs p JOIN norm a ON a.company_id = company_id_a JOIN norm b ON b.company_id = company_id_b)"""


_MATCH = """weak AS (SELECT company_id_a, company_id_b, CASE
    WHEN coalesce(domain_exact = 1, false) OR (coalesce(country_exact = 1, false) AND name_prefix6_eq = 1 AND coalesce(emp_tot_reldiff, 1) <= 0.20) THEN 1
    WHEN coalesce(country_exact = 0, false) OR (name_prefix4_eq = 0 AND coalesce(emp_tot_reldiff, 1) >= 0.90) THEN 0 END label_weak FROM features),
scores AS (SELECT company_id_a, company_id_b, CAST(40 * coalesce(name_compact_exact, 0) + 20 * coalesce(domain_exact, 0) + 10 * coalesce(country_exact, 0) + 20 * coalesce(city_exact, 0) + 10 * coalesce(name_prefix6_eq, 0) AS DOUBLE) / 100.0 model_score FROM features),
matches AS (SELECT *, CASE WHEN model_score >= 0.90 THEN 'match' WHEN model_score <= 0.10 THEN 'nonmatch' ELSE 'review' END decision FROM scores),
labeled AS (SELECT company_id_a, company_id_b, CASE decision WHEN 'match' THEN 1 WHEN 'nonmatch' THEN 0 END label_weak FROM matches),
arcs AS (SELECT company_id_a x, company_id_b y FROM matches WHERE decision = 'match' UNION SELECT company_id_b, company_id_a FROM matches WHERE decision = 'match'),
reach AS (SELECT x node, x root FROM arcs UNION SELECT y, root FROM reach JOIN arcs ON node = x),
entity AS (SELECT node company_id, min(root) entity_id FROM reach GROUP BY node),
members AS (SELECT e.entity_id, c.* FROM entity e JOIN comp c USING (company_id)),
resolved AS (SELECT entity_id, count(*) sources_count, arg_min(domain_name, company_id) FILTER (domain_name IS NOT NULL) "domain",
  mode(final_country ORDER BY final_country) country, mode(city ORDER BY city) city, mode(lower(company_name) ORDER BY lower(company_name)) "name", round(avg(total_employee_estimate), 1) employees_avg
  FROM members GROUP BY entity_id),
esize AS (SELECT entity_id, count(*) n FROM entity GROUP BY entity_id)"""


def _mode(column: str, out: str) -> str:
    """The most frequent value, ties to the smallest."""
    return f"m_{out} AS (SELECT entity_id, v {out} FROM (SELECT entity_id, {column} v, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, {column}) rn FROM members WHERE {column} IS NOT NULL GROUP BY entity_id, {column}) WHERE rn = 1)"


_MATCH = _MATCH[: _MATCH.index("resolved AS")] + ",\n".join([_mode("final_country", "country"), _mode("city", "city"), _mode("lower(company_name)", "nm")]) + """,
resolved AS (SELECT entity_id, sources_count, "domain", country, city, nm "name", employees_avg FROM
  (SELECT entity_id, count(*) sources_count, arg_min(domain_name, company_id) FILTER (domain_name IS NOT NULL) "domain", round(avg(total_employee_estimate), 1) employees_avg FROM members GROUP BY entity_id)
  LEFT JOIN m_country USING (entity_id) LEFT JOIN m_city USING (entity_id) LEFT JOIN m_nm USING (entity_id)),
esize AS (SELECT entity_id, count(*) n FROM entity GROUP BY entity_id)"""


def _with(final: str, depth: int, limit: int) -> str:
    """depth: 1 companies, 2 blocks, 3 pairs, 4 features, 5 matches."""
    parts = [_COMP, _BASE + ",\n" + _blocks(limit), _PAIRS, _features(), _MATCH][:depth]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final


def _clean(source: str) -> str:
    nn = lambda c: f"CASE WHEN lower({c}) IN ('nan', 'null', 'n/a') THEN NULL ELSE {c} END"
    return rf"""WITH b AS ({source}),
t AS (SELECT company_id, year_founded, cur, tot, nullif(trim(size_range), '') size_range, {nn("nullif(trim(nm), '')")} nm, {nn("nullif(trim(dom), '')")} dom, {nn("nullif(trim(ind), '')")} ind,
  {nn("nullif(trim(li), '')")} li, {nn("nullif(trim(loc), '')")} loc, {nn("nullif(lower(trim(ctry)), '')")} ctry FROM b),
u AS (SELECT *, regexp_replace(lower(coalesce(li, '')), '^https?://', '') l0 FROM t),
clean AS (SELECT company_id, lower(nm) company_name,
  regexp_replace(regexp_replace(regexp_replace(lower(coalesce(dom, '')), '^https?://', ''), '^www\.', ''), '/+$', '') domain_name, lower(ind) industry,
  coalesce(regexp_replace(CASE WHEN starts_with(l0, 'linkedin.com/') OR starts_with(l0, 'www.linkedin.com/') THEN regexp_replace(l0, '^www\.', '')
    WHEN contains(l0, 'linkedin.com/') THEN regexp_extract(l0, '(linkedin\.com/.*)$', 1) ELSE nullif(l0, '') END, '/+$', ''), split_part(l0, '?', 1)) linkedin_url,
  year_founded, size_range, cur current_employee_estimate, tot total_employee_estimate,
  lower(nullif(trim(split_part(loc, ',', 1)), '')) city, lower(nullif(trim(split_part(loc, ',', 2)), '')) state,
  lower(coalesce(ctry, nullif(trim(split_part(loc, ',', 3)), ''))) final_country FROM u)
"""


_NO = "CAST(NULL AS INTEGER) year_founded, CAST(NULL AS INTEGER) cur"
_PAGES = f"SELECT CAST(page_id AS BIGINT) company_id, ' Page ' || page_id || ' ' nm, url dom, 'N/A' ind, 'n/a' size_range, 'Town , ' || left(url, 5) || ', CA ' loc, CAST(NULL AS VARCHAR) ctry, 'HTTPS://uk.linkedin.com/company/' || page_id || '/' li, {_NO}, CAST(NULL AS INTEGER) tot FROM pages"
_CUSTOMER = f"SELECT CAST(c_custkey AS BIGINT) company_id, c_name nm, CAST(NULL AS VARCHAR) dom, c_mktsegment ind, CAST(NULL AS VARCHAR) size_range, c_mktsegment || ', ,' || n_name loc, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE ' null ' END ctry, CAST(NULL AS VARCHAR) li, {_NO}, CAST(floor(c_acctbal) AS INTEGER) tot FROM customer JOIN nation ON c_nationkey = n_nationkey"

_B = "CAST({} AS BIGINT)"
_SIZES = "(SELECT kind, bkey, CAST(count(*) AS BIGINT) n FROM raw1 GROUP BY kind, bkey)"


def _counts(limit: int) -> str:
    return f"CAST(count(*) AS BIGINT) blocks_all, CAST(count(*) FILTER (n BETWEEN 2 AND {limit}) AS BIGINT) blocks_kept, CAST(count(*) FILTER (n > {limit}) AS BIGINT) blocks_heavy, CAST(count(*) FILTER (n < 2) AS BIGINT) blocks_single"


def _est(limit: int) -> str:
    return f"CAST(coalesce(sum(n * (n - 1) // 2) FILTER (n BETWEEN 2 AND {limit}), 0) AS BIGINT) est_pairs"


_BSTATS = "SELECT count(*) blocks_total, max(n) block_max, avg(n) block_avg, quantile_cont(n, 0.9) block_p90, CAST(sum(n * (n - 1) // 2) AS BIGINT) est_pairs FROM (SELECT kind, bkey, count(*) n FROM blocks GROUP BY kind, bkey)"
_VOTES = """votes AS (SELECT company_id_a, company_id_b, coalesce(name_prefix6_eq = 1 AND coalesce(emp_tot_reldiff, 1.0) <= 0.3 AND country_exact = 1, false) vote_same FROM features),
voted AS (SELECT *, CAST(CASE WHEN vote_same THEN 0.7 ELSE 0.6 END AS DOUBLE) confidence, CASE WHEN vote_same THEN '["same name prefix, size and country"]' ELSE '["weak evidence"]' END reasons_json FROM votes)"""
_ALL = "SELECT * FROM entity UNION ALL SELECT company_id, company_id FROM comp WHERE company_id NOT IN (SELECT company_id FROM entity)"
_AUDIT = """, cast_votes AS (SELECT company_id_a, company_id_b, coalesce(name_prefix6_eq = 1 AND coalesce(nullif(emp_tot_reldiff, 0), 1.0) <= 0.3 AND country_exact = 1, false) vote_same FROM features)
SELECT company_id_a, company_id_b, vote_same, CAST(CASE WHEN vote_same THEN 0.7 ELSE 0.6 END AS DOUBLE) vote_confidence, CASE WHEN vote_same THEN '["same name prefix, size and country"]' ELSE '["weak evidence"]' END reasons_json,
  '{"a":"' || coalesce(country_a, '') || '","b":"' || coalesce(country_b, '') || '"}' normalized_names_json, coalesce(country_exact, 0) country_exact, coalesce(name_prefix6_eq, 0) name_prefix6_eq,
  coalesce(nullif(emp_tot_reldiff, 0), CAST(1.0 AS DOUBLE)) emp_tot_reldiff, coalesce(model_score, CAST(-1.0 AS DOUBLE)) model_score
FROM features JOIN scores USING (company_id_a, company_id_b) JOIN cast_votes USING (company_id_a, company_id_b) WHERE model_score BETWEEN 0.35 AND 0.65 ORDER BY 1, 2 LIMIT 50000"""
_CASCADE = """SELECT company_id_a, company_id_b, model_score,
  CASE WHEN model_score >= 0.85 THEN 'match' WHEN model_score <= 0.15 THEN 'nonmatch' WHEN confidence >= 0.7 AND vote_same THEN 'match' WHEN confidence >= 0.7 THEN 'nonmatch' ELSE 'review' END decision,
  CASE WHEN model_score >= 0.85 OR model_score <= 0.15 THEN 'model' WHEN confidence >= 0.7 THEN 'vote' ELSE 'none' END decision_source
  FROM scores LEFT JOIN voted USING (company_id_a, company_id_b)"""


def _chain(limit: int) -> dict[str, str]:
    """Queries of the chain at a block limit."""
    sql = lambda final, depth: _with(final, depth, limit)
    feat = "SELECT * FROM features"
    ids = "(SELECT company_id_a company_id FROM pairs UNION SELECT company_id_b FROM pairs)"
    return {
        "blocks_stage1": sql("SELECT * FROM kept1", 2),
        "blocks_adaptive": sql("SELECT * FROM blocks", 2),
        "blocks_heavy": sql("SELECT * FROM heavy", 2),
        "blocks_refinement_log": sql("SELECT * FROM (" + " UNION ALL ".join(f"SELECT 'stage{i}' stage, kind, bkey, n FROM size{i} WHERE n > {limit}" for i in (1, 2, 3)) + ")", 2),
        "stage3_tokens": sql("SELECT company_id, country, tok, df FROM tokens", 2),
        "pairs_with_kind": sql("SELECT * FROM kinded", 3),
        "pairs_capped": sql("SELECT * FROM pairs", 3),
        "pair_features": sql(feat, 4),
        "features_shard_union": sql(feat, 4),
        "weak_labels": sql("SELECT * FROM weak", 5),
        "pair_scores_linear": sql("SELECT * FROM scores", 5),
        "scored_view": sql("SELECT f.*, model_score FROM features f LEFT JOIN scores USING (company_id_a, company_id_b)", 5),
        "pair_matches": sql("SELECT * FROM matches", 5),
        "pair_labels": sql("SELECT * FROM labeled", 5),
        "entities": sql("SELECT * FROM entity", 5),
        "entities_with_singletons": sql(_ALL, 5),
        "resolved": sql("SELECT * FROM resolved", 5),
        "resolved_with_singletons": sql("SELECT * FROM resolved", 5).replace("members AS (SELECT e.entity_id, c.* FROM entity e", f"members AS (SELECT e.entity_id, c.* FROM ({_ALL}) e"),
        "votes": sql("SELECT * FROM voted", 5).replace("WITH RECURSIVE ", "WITH RECURSIVE ", 1).replace("\nSELECT * FROM voted", ",\n" + _VOTES + "\nSELECT * FROM voted"),
        "votes_table": sql("@", 5).replace("\n@", ",\n" + _VOTES + "\n" + _AUDIT),
        "cascade": sql("@", 5).replace("\n@", ",\n" + _VOTES + "\n" + _CASCADE),
        "decision_counts": sql("@", 5).replace("\n@", ",\n" + _VOTES + "\nSELECT decision, count(*) n FROM (" + _CASCADE + ") GROUP BY decision"),
        "ambiguous_pairs": sql("SELECT company_id_a, company_id_b, model_score FROM features LEFT JOIN scores USING (company_id_a, company_id_b) WHERE model_score BETWEEN 0.35 AND 0.65 ORDER BY 1, 2 LIMIT 50000", 5),
        "q_block_stats": sql(_BSTATS, 2),
        "q_top_heavy": sql("SELECT DISTINCT kind, bkey, n FROM heavy ORDER BY n DESC, kind, bkey LIMIT 10", 2),
        "q_overlap": sql("SELECT count(*) total_companies, count(*) FILTER (k = 1) single_kind, count(*) FILTER (k > 1) multi_kind, round(CAST(100.0 AS DOUBLE) * count(*) FILTER (k > 1) / count(*), 2) pct_multi_kind FROM (SELECT company_id, count(DISTINCT kind) k FROM blocks GROUP BY 1)", 2),
        "q_kind_pairs": sql("SELECT a.kind kind_a, b.kind kind_b, count(*) shared_companies FROM (SELECT DISTINCT company_id, kind FROM blocks) a JOIN (SELECT DISTINCT company_id, kind FROM blocks) b ON a.company_id = b.company_id AND a.kind < b.kind GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20", 2),
        "q_score_stats": sql("SELECT (SELECT count(*) FROM features) features_count, count(*) scores_count, count(*) FILTER (model_score IS NULL) null_scores, coalesce(min(model_score), 0) score_min, coalesce(max(model_score), 0) score_max, coalesce(avg(model_score), 0) score_mean, coalesce(quantile_cont(model_score, 0.5), 0) score_median, coalesce(quantile_cont(model_score, 0.1), 0) score_p10, coalesce(quantile_cont(model_score, 0.9), 0) score_p90, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM features), 4) score_ratio FROM scores", 5),
        "q_label_counts": sql("SELECT count(*) FILTER (label_weak = 1) pos, count(*) FILTER (label_weak = 0) neg, count(*) FILTER (label_weak IS NULL) unlabeled FROM labeled", 5),
        "q_match_stats": sql("SELECT (SELECT count(*) FROM matches) total_pairs, (SELECT count(*) FROM labeled WHERE label_weak = 1) labeled_positive, (SELECT count(*) FROM labeled WHERE label_weak = 0) labeled_negative, CAST(coalesce(sum(n), 0) AS BIGINT) total_entities, count(*) unique_entity_ids, avg(n) avg_cluster_size, max(n) largest_cluster, count(*) FILTER (n = 1) singletons FROM esize", 5),
        "q_resolved_summary": sql("SELECT count(*) entities, CAST(coalesce(sum(n), 0) AS BIGINT) records, avg(n) avg_cluster, max(n) max_cluster, count(*) FILTER (n = 1) singletons, count(*) FILTER (n > 1) multi_member, round(CAST(100.0 AS DOUBLE) * count(*) FILTER (n = 1) / nullif(count(*), 0), 2) pct_singletons, (SELECT count(*) FROM resolved) resolved_rows FROM esize", 5),
        "q_pair_sanity": sql("SELECT count(*) total_pairs, count(DISTINCT company_id_a) distinct_a, count(DISTINCT company_id_b) distinct_b, count(DISTINCT company_id_a) + count(DISTINCT company_id_b) total_unique_ids, count(*) - count(DISTINCT (company_id_a, company_id_b)) duplicate_pairs FROM kinded", 3),
        "q_missing": sql(f"SELECT count(*) missing_companies FROM comp WHERE company_id NOT IN {ids}", 3),
        "q_orphan": sql(f"SELECT count(*) orphan_ids FROM {ids} WHERE company_id NOT IN (SELECT company_id FROM comp)", 3),
        "q_domain_exact_total": sql("SELECT CAST(sum(domain_exact) AS BIGINT) domain_exact_total FROM features", 4),
        "q_blocking_stats_overall": sql(f"SELECT {_counts(limit)}, max(n) FILTER (n BETWEEN 2 AND {limit}) kept_max, quantile_cont(n, 0.9) FILTER (n BETWEEN 2 AND {limit}) kept_p90, {_est(limit)}, (SELECT count(*) FROM comp) companies, (SELECT count(*) FROM pairs) actual_pairs FROM {_SIZES}", 3),
        "q_blocking_stats_by_kind": sql(f"SELECT kind, {_counts(limit)}, {_est(limit)} FROM {_SIZES} GROUP BY kind", 2),
        "q_block_sizes": sql(f"SELECT * FROM {_SIZES}", 2),
        "q_top_kept": sql(f"SELECT * FROM {_SIZES} WHERE n BETWEEN 2 AND {limit} ORDER BY n DESC, kind, bkey LIMIT 100", 2),
        "q_stage_counts": sql("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{s}' stage, count(*) n FROM {t}" for s, t in (("companies", "comp"), ("blocks", "blocks"), ("pairs", "pairs"), ("features", "features"), ("scores", "scores"), ("entities", "entity"))) + ")", 5),
        "q_dupes": sql("SELECT count(*) pairs_repeated, CAST(coalesce(sum(c - 1), 0) AS BIGINT) rows_extra FROM (SELECT company_id_a, company_id_b, count(*) c FROM kinded GROUP BY 1, 2 HAVING count(*) > 1)", 3),
    }


#: Queries that are also given at the limit SMALL, under names that end in it: at the default no block of the small test tables is heavy.
ALSO_SMALL = ("blocks_adaptive", "blocks_heavy", "blocks_refinement_log", "stage3_tokens", "pairs_capped", "resolved", "q_top_heavy", "q_blocking_stats_by_kind")


def oracle_sql() -> dict[str, str]:
    quality = """SELECT count(*) n_rows, count(*) FILTER (domain_name IS NULL) null_domains, count(*) FILTER (company_name IS NULL) null_names, count(*) FILTER (year_founded NOT BETWEEN 1800 AND 2100) years_out_of_range,
  count(*) FILTER (company_name <> lower(company_name)) names_not_lower, count(*) FILTER (regexp_matches(domain_name, '^https?://|^www[.]')) domains_with_scheme, count(*) FILTER (regexp_matches(linkedin_url, '^https?://')) profiles_with_scheme,
  count(*) FILTER (final_country <> lower(final_country)) countries_not_lower, count(*) FILTER (company_id IS NULL) null_ids, count(company_id) - count(DISTINCT company_id) repeated_ids FROM clean"""
    small = _chain(SMALL)
    return {
        "clean_pages": _clean(_PAGES) + "SELECT * FROM clean",
        "clean_customer": _clean(_CUSTOMER) + "SELECT * FROM clean",
        **_chain(LIMIT),
        **{f"{name}_{SMALL}": small[name] for name in ALSO_SMALL},
        "q_quality": _clean(_PAGES) + quality,
    }
