"""SQL that must give the same rows as the composed flows. What the layouts of the list pages must come to is stated here."""

from __future__ import annotations

from vaglio.plans.oracles import CANON, GATE, STREAKS, content_hash, part, strip
from vaglio.plans.world import LAYOUTS, PER_PAGE
from vaglio.plans.world import POOL as STRATEGIES


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


#: rs: the runs; pl: their pages, with what was brought; l and z: the links of each page, judged; okp: pages that the gate accepts.
WORLD = rf"""
{CANON},
rs AS (
  SELECT run_id::VARCHAR AS list_id, run_id, r.source_id, type, list_selector AS cached, host, 'https://' || host || '/elenco-' || run_id AS url,
    CASE WHEN type = 'rule' THEN 4 ELSE (length(label) + seq // 5) % 4 END AS layout, length(host) % 9 <> 0 AS allowed
  FROM scan_runs r JOIN (SELECT *, lower({part("coalesce(nullif(list_url, ''), url)", 2)}) AS host FROM sources) s ON s.id = r.source_id),
it AS (SELECT u.run_id, canonical, title, row_number() OVER (PARTITION BY u.run_id ORDER BY pos, candidate_id) - 1 AS k FROM u),
pl AS (
  SELECT rs.*, page, max(page) OVER (PARTITION BY run_id) AS last, (run_id % 29 = 0 AND page = 0) OR (run_id % 11 = 0 AND page = 1) AS gone
  FROM (SELECT DISTINCT run_id, k // {PER_PAGE} AS page FROM it) JOIN rs USING (run_id)),
l AS (SELECT rs.list_id || '/' || (k // {PER_PAGE}) AS list_id, k AS pos, canonical AS url, it.title, host AS domain FROM it JOIN rs USING (run_id)),
{GATE},
okp AS (
  SELECT split_part(list_id, '/', 1) AS list_id, split_part(list_id, '/', 2)::INT AS page, pos, url, nullif({strip('title')}, '') AS title
  FROM z WHERE reason = 'kept' QUALIFY count(*) OVER (PARTITION BY list_id) BETWEEN 2 AND 200),
finds(layout, selector) AS (VALUES {_values([(k, s) for k, s, *_ in LAYOUTS])}),
shapes(layout, shape) AS (VALUES (0, ''), (1, 'voce'), (2, 'scheda-avviso'), (3, ''), (4, 'voce')),
st0(strategy_id, list_selector, shape, times_worked, times_failed) AS (VALUES {_values(STRATEGIES)}),
strat AS (SELECT *, 'drupal:' || sha256(shape)[1:12] AS fingerprint, substr(strategy_id, 2)::INT AS pool_pos FROM st0)"""

#: tries: what is tried on each list that was brought, in order, and whether it is accepted; lad: the ladder's outcome.
LADDER = rf"""
fp AS (SELECT list_id, run_id, layout, cached, type, 'drupal:' || sha256(shape)[1:12] AS fingerprint FROM pl JOIN shapes USING (layout) WHERE page = 0 AND NOT gone AND allowed),
rk AS (
  SELECT list_id, strategy_id, list_selector, row_number() OVER (PARTITION BY list_id ORDER BY (strat.fingerprint IS DISTINCT FROM fp.fingerprint)::INT, times_worked DESC, pool_pos) AS rank
  FROM fp CROSS JOIN strat QUALIFY rank <= 10),
tr AS (
  SELECT list_id, 1 AS rung, 0 AS rank, NULL AS strategy_id, cached AS selector FROM fp WHERE coalesce(cached, '') <> ''
  UNION ALL SELECT list_id, 2, rank, strategy_id, list_selector FROM rk JOIN fp USING (list_id) WHERE list_selector IS DISTINCT FROM cached
  UNION ALL SELECT list_id, 3, 0, NULL, selector FROM fp JOIN finds USING (layout) WHERE run_id % 4 = 0),
tries AS (
  SELECT tr.*, (fp.layout, selector) IN (SELECT (layout, selector) FROM finds) AND list_id IN (SELECT list_id FROM okp WHERE page = 0) AS ok FROM tr JOIN fp USING (list_id)),
wn AS (SELECT list_id, min(rung * 1000 + rank) FILTER (ok) AS place FROM tries GROUP BY 1),
lad AS (
  SELECT fp.list_id, fp.fingerprint, w.rung, w.selector AS selector_used, w.strategy_id AS worked_strategy_id,
    coalesce((SELECT string_agg(t.strategy_id, ',' ORDER BY rank) FROM tries t WHERE t.list_id = fp.list_id AND t.rung = 2 AND NOT ok AND (place IS NULL OR 2000 + rank < place)), '') AS blamed
  FROM fp LEFT JOIN wn USING (list_id) LEFT JOIN tries w ON w.list_id = fp.list_id AND w.rung * 1000 + w.rank = place)"""

#: pg: the pages that each list's pager leads to; cand: the candidates, read: which pages were left unread.
PAGED = rf"""
pg AS (
  SELECT list_id, run_id, type, allowed, selector_used, CASE WHEN run_id % 11 = 0 AND last > 0 THEN 1 ELSE least(last + 1, 20) END AS pages
  FROM pl JOIN lad USING (list_id) WHERE page = 0 AND selector_used IS NOT NULL AND type IN ('html', 'html_js')),
fo AS (
  SELECT okp.*, row_number() OVER (PARTITION BY list_id, url ORDER BY page, pos) AS nth FROM okp JOIN pg USING (list_id) WHERE page < pages),
pn AS (
  SELECT pg.list_id, p.page, (SELECT count(*) FROM fo WHERE fo.list_id = pg.list_id AND fo.page < p.page AND nth = 1) AS before
  FROM pg, LATERAL (SELECT unnest(range(0, pages)) AS page) p),
cand AS (
  SELECT list_id, url, title, row_number() OVER (PARTITION BY list_id ORDER BY page, pos) AS k FROM fo JOIN pn USING (list_id, page) WHERE nth = 1 AND before < 60 QUALIFY k <= 60)"""

RULES = rf"""
ru AS (SELECT rs.*, v FROM rs CROSS JOIN (VALUES ('a'), ('b'), ('c'), ('d'), ('e'), ('f'), ('g')) AS t(v) WHERE type = 'rule'),
first AS (SELECT list_id, last FROM pl WHERE page = 0 AND NOT gone AND allowed),
rp AS (
  SELECT ru.list_id || v AS list_id, page, CASE v WHEN 'a' THEN 1 ELSE CASE WHEN run_id % 3 = 0 OR last = 0 OR run_id % 11 = 0 THEN 1 ELSE 2 END END AS pages, pos, url2, title
  FROM ru JOIN first USING (list_id) LEFT JOIN (SELECT list_id, page, pos, url AS url2, title FROM okp) o ON o.list_id = ru.list_id AND page < CASE v WHEN 'a' THEN 1 ELSE CASE WHEN run_id % 3 = 0 OR last = 0 OR run_id % 11 = 0 THEN 1 ELSE 2 END END
  WHERE v IN ('a', 'b')),
ra AS (
  SELECT ru.list_id || v AS list_id, 0 AS page, k AS pos, canonical AS url2, nullif({strip('it.title')}, '') AS title FROM ru JOIN it USING (run_id) WHERE v = 'c' AND allowed AND run_id % 5 <> 0),
rc AS (
  SELECT list_id, url2 AS url, arg_min(title, page * 100000 + pos) AS title, min(page * 100000 + pos) AS place
  FROM (SELECT list_id, page, pos, url2, coalesce(title, '') AS title FROM rp WHERE url2 IS NOT NULL UNION ALL SELECT list_id, page, pos, url2, coalesce(title, '') FROM ra) GROUP BY ALL),
rx AS (SELECT list_id, row_number() OVER (PARTITION BY list_id ORDER BY place) AS pos, url, nullif(title, '') AS title FROM rc)"""

#: dn: every page's newest candidate with what becomes of it.
DONE = rf"""
{CANON},
nc AS (
  SELECT u.source_id, candidate_id, canonical, title, text, type FROM u JOIN sources s ON s.id = u.source_id
  QUALIFY row_number() OVER (PARTITION BY u.source_id, canonical ORDER BY fetched_at DESC NULLS LAST, candidate_id) = 1),
pgs AS (SELECT canonical, min(candidate_id) AS pos, arg_min(coalesce(text, ''), candidate_id) AS t FROM nc GROUP BY 1),
tx AS (
  SELECT nc.source_id, candidate_id, canonical, type, sha256(canonical) AS url_hash, length(canonical) % 10 AS k,
    CASE WHEN type = 'api' THEN CASE WHEN coalesce(title, '') <> '' THEN 'Title: ' || title || chr(10) ELSE '' END || 'URL: ' || canonical
         WHEN pgs.pos % 23 <> 0 THEN array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), chr(10))[1:24000] END AS txt
  FROM nc JOIN pgs USING (canonical)),
ss AS (SELECT source_id, url_hash, content_hash, last_seen_at FROM page_snapshots QUALIFY row_number() OVER (PARTITION BY source_id, url_hash ORDER BY last_seen_at DESC NULLS LAST, coalesce(content_hash, '') DESC) = 1),
sta AS (
  SELECT tx.*, {content_hash('txt')} AS ch, CASE WHEN txt IS NULL THEN 'unfetched' WHEN ss.content_hash = {content_hash('txt')} THEN 'unchanged' WHEN txt = '' THEN 'blank' ELSE 'due' END AS state
  FROM tx LEFT JOIN ss USING (source_id, url_hash)),
cl AS (
  SELECT source_id, candidate_id, url_hash, nth, row_number() OVER (PARTITION BY source_id ORDER BY candidate_id, url_hash, nth) AS own
  FROM (SELECT *, unnest(CASE WHEN k IN (1, 2) THEN [1, 2] ELSE [1] END) AS nth FROM sta WHERE state = 'due')),
us AS (SELECT source_id, sum(least(count(*), 90)) OVER (ORDER BY source_id) - least(count(*), 90) AS before FROM cl GROUP BY source_id),
ad AS (SELECT source_id, candidate_id, bool_and(own <= 90 AND before + own <= 4000) AS room, count(*) FILTER (own <= 90 AND before + own <= 4000) AS calls FROM cl JOIN us USING (source_id) GROUP BY 1, 2),
dn AS (
  SELECT sta.*, coalesce(ad.calls, 0)::INT AS calls, CASE WHEN state <> 'due' THEN state WHEN NOT room THEN 'over_budget' WHEN k = 0 THEN 'rejected' WHEN k = 2 THEN 'failed' ELSE 'stored' END AS outcome
  FROM sta LEFT JOIN ad USING (source_id, candidate_id))"""

RESULTS = rf"""
ln AS (
  SELECT dn.*, CASE outcome WHEN 'unfetched' THEN 'could not fetch ' || canonical WHEN 'blank' THEN 'no text after cleaning: ' || canonical WHEN 'rejected' THEN 'not a grant page: ' || canonical
    WHEN 'failed' THEN 'extraction failed for ' || canonical || ': title: missing; relevance: score not in 0 to 1' END AS line, url_hash IN (SELECT url_hash FROM grants WHERE url_hash IS NOT NULL) AS known
  FROM dn JOIN sources s ON s.id = dn.source_id AND length(label) % 6 <> 0),
pr AS (
  SELECT source_id, count(*) FILTER (outcome = 'stored' AND NOT known) AS n, count(*) FILTER (outcome = 'stored' AND known) AS up, count(*) FILTER (type <> 'api') AS p, sum(calls) AS c,
    nullif(concat_ws(chr(10), string_agg(line, chr(10) ORDER BY candidate_id, line), CASE WHEN bool_or(outcome = 'over_budget') THEN 'call budget spent' END), '') AS log
  FROM ln GROUP BY 1),
rt AS (
  SELECT id AS source_id, label, CASE WHEN length(label) % 6 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN length(label) % 6 = 0 THEN 'could not fetch listing of [REDACTED]: ' || repeat('x', 1200) END AS error,
    coalesce(n, 0) AS new_count, coalesce(up, 0) AS updated_count, (1 + coalesce(p, 0))::BIGINT AS pages_fetched, coalesce(c, 0)::BIGINT AS llm_calls, log
  FROM sources LEFT JOIN pr ON pr.source_id = id)"""

ORACLES = {
    "fetched_pages": f"WITH {WORLD} SELECT rs.list_id, coalesce(rs.allowed AND NOT gone, false) AS brought, coalesce(rs.allowed AND page = 0, false) AS counted FROM rs LEFT JOIN pl ON pl.list_id = rs.list_id AND page = 0",
    "robots_allowed": f"WITH {WORLD} SELECT list_id FROM rs WHERE allowed",
    "ladder_run": f"WITH {WORLD}, {LADDER} SELECT * FROM lad",
    "scan_html": f"""
WITH {WORLD}, {LADDER}, {PAGED}
SELECT rs.list_id, CASE WHEN lad.list_id IS NULL THEN 'could not fetch listing' WHEN lad.rung IS NULL THEN 'every rung was tried and gated out' END AS error, lad.rung, lad.selector_used, worked_strategy_id, coalesce(blamed, '') AS blamed,
  coalesce(pages, 0) AS pages_scanned, (SELECT count(*) FROM cand WHERE cand.list_id = rs.list_id) AS candidates, coalesce((SELECT bool_or(before >= 60) FROM pn WHERE pn.list_id = rs.list_id), false) AS capped
FROM rs LEFT JOIN lad USING (list_id) LEFT JOIN pg USING (list_id) WHERE rs.type IN ('html', 'html_js')""",
    "scan_html_candidates": f"WITH {WORLD}, {LADDER}, {PAGED} SELECT list_id, k AS pos, url, title FROM cand",
    "selector_answers": f"""
WITH {WORLD} SELECT list_id, CASE WHEN run_id % 4 = 0 THEN selector END AS proposed,
  CASE run_id % 4 WHEN 0 THEN 'una lista' WHEN 1 THEN 'nessuna lista' ELSE 'implausible selector rejected: a[href^=javascript:]' END AS reasoning
FROM rs JOIN finds USING (layout) WHERE run_id % 4 < 3""",
    "pool_learning": f"""
WITH {WORLD}, {LADDER},
wk AS (SELECT worked_strategy_id AS strategy_id, count(*) AS n FROM lad WHERE worked_strategy_id IS NOT NULL GROUP BY 1),
fl AS (SELECT strategy_id, count(*) AS n FROM (SELECT unnest(string_split(blamed, ',')) AS strategy_id FROM lad) GROUP BY 1),
a AS (SELECT strat.*, times_worked + coalesce(wk.n, 0) AS tw, times_failed + coalesce(fl.n, 0) AS tf FROM strat LEFT JOIN wk USING (strategy_id) LEFT JOIN fl USING (strategy_id)),
nu AS (SELECT selector_used, fingerprint, count(*) AS n FROM lad WHERE rung IN (1, 3) GROUP BY 1, 2),
hd AS (SELECT nu.*, (SELECT min(strategy_id) FROM a WHERE a.list_selector = nu.selector_used AND a.fingerprint = nu.fingerprint) AS id FROM nu)
SELECT list_selector, a.fingerprint, (tw + coalesce(hd.n, 0))::BIGINT AS times_worked, tf::BIGINT AS times_failed FROM a LEFT JOIN hd ON hd.id = a.strategy_id
UNION ALL SELECT selector_used, fingerprint, n, 0 FROM hd WHERE id IS NULL""",
    "cached_selectors": f"""
WITH {WORLD}, {LADDER}, nr AS (SELECT source_id, max(run_id) AS run_id FROM scan_runs GROUP BY 1)
SELECT id, coalesce(selector_used, list_selector) AS list_selector FROM sources LEFT JOIN nr ON nr.source_id = id LEFT JOIN lad ON lad.list_id = nr.run_id::VARCHAR""",
    "scan_rules": f"""
WITH {WORLD}, {RULES}
SELECT ru.list_id || v AS list_id, CASE v WHEN 'd' THEN 'invalid rule: max_pages: not in 1 to 20' WHEN 'e' THEN 'rule is not JSON' WHEN 'f' THEN 'rule names no way to find items' WHEN 'g' THEN 'no rule'
    WHEN 'c' THEN CASE WHEN NOT allowed OR run_id NOT IN (SELECT run_id FROM it) THEN 'request failed' WHEN run_id % 5 = 0 THEN 'answer is not JSON' WHEN n.n IS NULL THEN 'rule found no candidates' END
    ELSE CASE WHEN first.list_id IS NULL THEN 'could not fetch listing' WHEN n.n IS NULL THEN 'rule found no candidates' END END AS error,
  v = 'c' AS api_style, coalesce((SELECT any_value(pages) FROM rp WHERE rp.list_id = ru.list_id || v), 0) AS pages_scanned, coalesce(n.n, 0) AS candidates
FROM ru LEFT JOIN first USING (list_id) LEFT JOIN (SELECT list_id AS key, count(*) AS n FROM rx GROUP BY 1) n ON key = ru.list_id || v""",
    "scan_rules_candidates": f"WITH {WORLD}, {RULES} SELECT list_id, pos, url, title FROM rx",
    "process_candidates": f"""
WITH {DONE}
SELECT source_id, candidate_id, outcome, calls, CASE WHEN outcome = 'stored' THEN 'Scheda ' || url_hash[1:8] END AS title,
  CASE WHEN outcome = 'stored' AND k = 1 THEN 'title: missing; deadline: no such day' WHEN outcome = 'failed' THEN 'no JSON object' END AS retry_errors,
  CASE WHEN outcome = 'failed' THEN 'title: missing; relevance: score not in 0 to 1' END AS message FROM dn""",
    "scanned_snapshots": f"""
WITH {DONE}, nw AS (SELECT source_id, url_hash, ch FROM dn WHERE outcome IN ('stored', 'rejected'))
SELECT coalesce(ss.source_id, nw.source_id) AS source_id, coalesce(ss.url_hash, nw.url_hash) AS url_hash, coalesce(ch, content_hash) AS content_hash,
  CASE WHEN nw.url_hash IS NOT NULL THEN '2030-01-01 00:00:00' ELSE rtrim(rtrim(strftime(last_seen_at, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') END AS last_seen_at, ss.source_id IS NULL AND ss.url_hash IS NULL AS is_new
FROM ss FULL JOIN nw ON ss.source_id IS NOT DISTINCT FROM nw.source_id AND ss.url_hash IS NOT DISTINCT FROM nw.url_hash""",
    "stored_grants": f"""
WITH {DONE},
g AS (SELECT * FROM grants QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY last_seen_at DESC NULLS LAST, grant_id DESC) = 1),
nw AS (SELECT * FROM dn WHERE outcome = 'stored' QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY source_id DESC, candidate_id DESC) = 1)
SELECT coalesce(g.url_hash, nw.url_hash) AS url_hash, coalesce(nw.source_id, g.source_id) AS source_id, CASE WHEN nw.url_hash IS NOT NULL THEN 'Scheda ' || nw.url_hash[1:8] ELSE g.title END AS title,
  CASE WHEN nw.url_hash IS NOT NULL THEN 'Training' ELSE g.category END AS category, CASE WHEN nw.url_hash IS NOT NULL THEN '2026-09-15' ELSE strftime(g.deadline, '%Y-%m-%d') END AS deadline,
  CASE WHEN g.found_at IS NOT NULL THEN rtrim(rtrim(strftime(g.found_at, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') WHEN nw.url_hash IS NOT NULL THEN '2030-01-01 00:00:00' END AS found_at, g.grant_id IS NULL AS is_new
FROM g FULL JOIN nw ON g.url_hash = nw.url_hash""",
    "run_results": f"WITH {DONE}, {RESULTS} SELECT source_id, status, new_count, updated_count, pages_fetched, llm_calls, length(log[1:5000])::INT AS log_length FROM rt",
    "run_totals": f"""
WITH {DONE}, {RESULTS}
SELECT CASE WHEN bool_or(status = 'error') THEN 'error' ELSE 'ok' END AS status, sum(new_count)::BIGINT AS new_count, sum(updated_count)::BIGINT AS updated_count, sum(pages_fetched)::BIGINT AS pages_fetched,
  sum(llm_calls)::BIGINT AS llm_calls, count(*) FILTER (status = 'error') AS errored FROM rt""",
    "source_status": f"WITH {DONE}, {RESULTS} SELECT id, rt.status AS last_status, error[1:1000] AS last_error, CASE WHEN rt.status = 'error' THEN coalesce(consecutive_errors, 0) + 1 ELSE 0 END AS consecutive_errors, '2030-01-01 00:00:00' AS last_scan_at FROM sources JOIN rt ON rt.source_id = id",
    "errored_sources": "SELECT id AS source_id FROM sources WHERE length(label) % 6 = 0",
    "run_log": "SELECT run_id, (repeat('r', (4960 + run_id % 60)::INT) || ' [REDACTED] [REDACTED] [REDACTED] fine')[1:5000] AS log FROM scan_runs",
    "rule_drafts": f"""
WITH {STREAKS},
d AS (SELECT DISTINCT source_id, label, length(label) % 4 AS k FROM st JOIN sources ON id = source_id WHERE streak = 1 AND type IN ('html', 'html_js')),
e AS (SELECT source_id, k IN (0, 3) AS ok, CASE k WHEN 0 THEN '[auto-draft after 1 consecutive errors] lista' WHEN 1 THEN 'rule rejected by validation: item_selector: forbidden token; max_pages: not in 1 to 20; method: only GET and POST'
    WHEN 2 THEN 'model found no grant list' ELSE '[auto-draft after 1 consecutive errors] ' END AS note, k FROM d),
o AS (SELECT id AS source_id FROM sources WHERE length(label) % 3 = 0),
p AS (
  SELECT coalesce(o.source_id, e.source_id) AS source_id, CASE WHEN e.source_id IS NOT NULL THEN 'drafted_rules/' || e.source_id || '.json' ELSE 'old' END AS path, CASE WHEN k = 0 THEN 'li.voce' END AS item_selector, o.source_id IS NULL AS opened
  FROM o FULL JOIN (SELECT * FROM e WHERE ok) e ON o.source_id = e.source_id)
SELECT coalesce(e.source_id, p.source_id) AS source_id, ok, note, path, item_selector, opened FROM e FULL JOIN p ON e.source_id = p.source_id""",
    "topics": f"""
WITH c AS (SELECT coalesce(list_filter(['Digital & Innovation', 'Sustainability', 'Startups & SMEs', 'Research & Development', 'Culture & Tourism', 'Internationalization', 'Training', 'Agriculture', 'Other'],
  lambda k: lower(k) = lower({strip('category')}))[1], 'Other') AS name, count(*) AS n FROM grants WHERE category IS NOT NULL GROUP BY 1)
SELECT sha256(name)[1:8] AS id, name, CASE WHEN n % 2 = 0 THEN 'su ' || name END AS description, NULL::VARCHAR AS keywords FROM c WHERE length(name) > 5""",
    "settings": "SELECT 1 AS id, 'daily' AS scan_frequency",
    "last_completed": "SELECT max(finished_at) AS finished_at FROM scan_runs HAVING max(finished_at) IS NOT NULL",
    "api_totals": f"""
WITH n AS (SELECT run_id, count(*) AS n FROM candidates GROUP BY 1)
SELECT run_id::VARCHAR AS source_id, least(5, CASE WHEN n % {PER_PAGE} = 0 THEN n // {PER_PAGE} ELSE n // {PER_PAGE} + 1 END)::INT AS pages_fetched, least(n, 5 * {PER_PAGE})::BIGINT AS rows, CASE WHEN n > {PER_PAGE} THEN n END AS total_reported FROM n""",
    "completions": """
WITH o AS (SELECT candidate_id, source_id, row_number() OVER (PARTITION BY source_id ORDER BY candidate_id) AS own FROM candidates),
b AS (SELECT o.*, sum((own <= 25)::INT) OVER (ORDER BY source_id, candidate_id ROWS UNBOUNDED PRECEDING) AS run FROM o),
s AS (SELECT candidate_id, own <= 25 AND run <= 900 AS ok, candidate_id % 5 AS k FROM b)
SELECT candidate_id, CASE WHEN NOT ok THEN 'over_budget' WHEN k = 4 THEN 'unavailable' WHEN k < 2 THEN 'invalid' ELSE 'ok' END AS status, CASE WHEN ok AND k = 2 THEN '{"a": 1}' WHEN ok AND k = 3 THEN '{"b": [2]}' END AS answer FROM s""",
    "p3_replay": f"""
WITH {CANON},
e AS (SELECT seq, max(max(coalesce(finished_at, started_at))) OVER (ORDER BY seq) AS cut FROM scan_runs GROUP BY seq),
v AS (SELECT candidate_id, source_id, canonical, {content_hash('text')} AS version, fetched_at, arrived_at FROM u),
w AS (
  SELECT seq, candidate_id, source_id, canonical, version FROM e JOIN v ON arrived_at <= cut WHERE seq % 4 <> 3
  QUALIFY row_number() OVER (PARTITION BY seq, source_id, canonical ORDER BY fetched_at DESC NULLS LAST, candidate_id) = 1),
x AS (SELECT w.*, lag(version) OVER by_page AS was, lag(seq) OVER by_page AS before FROM w WINDOW by_page AS (PARTITION BY source_id, canonical ORDER BY seq))
SELECT seq AS step, candidate_id FROM x WHERE before IS NULL OR was IS DISTINCT FROM version OR version IS NULL""",
}
