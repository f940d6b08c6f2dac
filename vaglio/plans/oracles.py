"""SQL that must give the same rows as the queries of the same names."""

from __future__ import annotations

from vaglio.plans.reference_queries import NOTICE_SHAPES
from vaglio.plans.world import PER_PAGE

#: Link texts that are no notices, and what no selector may hold.
CHROME = ("home", "contatti", "privacy", "cookie", "cookie policy", "accedi", "login", "registrati", "cerca", "menu", "torna su", "leggi tutto", "continua", "vai al contenuto", "mappa del sito", "note legali", "amministrazione trasparente", "seguici", "newsletter", "faq", "aiuto", "english", "italiano")
FORBIDDEN = ("javascript:", "<script", "expression(", "url(")

#: White space as a class, for a dialect whose \s is ASCII only.
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def part(c: str, n: int) -> str:
    return f"regexp_extract({c}, '{PARTS}', {n})"


#: u(candidate_id, ..., canonical): the candidates with their canonical URLs; their references are absolute, //host or /path.
CANON = rf"""
b AS (SELECT id AS source_id, coalesce(nullif(list_url, ''), url) AS base FROM sources),
r AS (
  SELECT c.*, base, regexp_replace({strip('c.url')}, '^((?i)https?://)(?:(?i)https?://)+', '\1') AS u0
  FROM candidates c JOIN b USING (source_id)),
j AS (
  SELECT r.*, {strip(f'''CASE WHEN {part('u0', 1)} <> '' THEN u0
      WHEN u0 LIKE '//%' THEN lower({part('base', 1)}) || ':' || u0
      ELSE lower({part('base', 1)}) || '://' || {part('base', 2)} || u0 END''')} AS u1
  FROM r),
k AS (
  SELECT j.*, regexp_replace({part('u1', 3)}, '/+$', '') AS p,
    array_to_string(list_filter(string_split({part('u1', 4)}, '&'),
      lambda x: x <> '' AND lower(string_split(x, '=')[1]) NOT IN ('utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid')), '&') AS q
  FROM j),
u AS (
  SELECT k.*, lower({part('u1', 1)}) || ':' || '//' || lower({part('u1', 2)}) || CASE p WHEN '' THEN '/' ELSE p END || CASE q WHEN '' THEN '' ELSE '?' || q END AS canonical
  FROM k)"""


def content_hash(c: str) -> str:
    return f"sha256(trim(regexp_replace({c}, '{WS}+', ' ', 'g')))"


def escaped(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '\"', '&quot;')"


def _wrapped(shape: str) -> str:
    head, tail = ("T", "X") if shape.index(">T<") < shape.index(">X<") else ("X", "T")
    sides = {"T": f"coalesce({escaped('title')}, '')", "X": f"coalesce({escaped('text')}, '')"}
    one, rest = shape.split(f">{head}<", 1)
    two, three = rest.split(f">{tail}<", 1)
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return " || ".join([quoted(one + ">"), sides[head], quoted("<" + two + ">"), sides[tail], quoted("<" + three)])


NOTICES = f"""
n AS (
  SELECT candidate_id AS page_id, candidate_id % 4 AS k, title, text, CASE candidate_id % 4 WHEN 0 THEN {_wrapped(NOTICE_SHAPES[0])} WHEN 1 THEN {_wrapped(NOTICE_SHAPES[1])}
    WHEN 2 THEN {_wrapped(NOTICE_SHAPES[2])} ELSE {_wrapped(NOTICE_SHAPES[3])} END AS html
  FROM candidates)"""

#: What a reader sees of each shape, stated and not computed.
SEEN = """
CASE k WHEN 0 THEN coalesce(title, '') || chr(10) || coalesce(text, '') || chr(10) || '©'
  WHEN 1 THEN 'Attività è l’ente € 5 ¬it; &lt;' || chr(10) || coalesce(text, '') || chr(10) || coalesce(title, '')
  WHEN 2 THEN coalesce(title, '') || chr(10) || 'e' || chr(10) || coalesce(text, '') || chr(10) || '€'
  ELSE coalesce(title, '') || chr(10) || coalesce(text, '') || chr(10) || '1' || chr(10) || 'fine "' || chr(39) || chr(39) || '<b>' END"""
LINES = f"array_to_string(list_filter(list_transform(string_split({SEEN}, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), chr(10))"
CLEAN = f"WITH {NOTICES}, v AS (SELECT page_id, html, {LINES} AS t FROM n)"


def stub(c: str) -> str:
    return f"CASE WHEN length({c}) >= 40 THEN ({c})[1:40] || '…' ELSE {c} END"


_T, _X = stub(f"coalesce({escaped('title')}, '')"), stub(f"coalesce({escaped('text')}, '')")
#: The structure of each shape as a model is given it, stated and not computed.
CONDENSED = f"""
SELECT page_id,
  regexp_replace(CASE k WHEN 0 THEN '<html><body><nav><a>Home</a></nav><header>h</header><div class="corpo riga is-open"><h1>' || {_T} || '</h1><!-- c --><p>' || {_X} || '</p></div><li class="voce nav__a1b2c3">&copy;</li><footer>f</footer></body></html>'
    WHEN 1 THEN '<BODY><nav><nav>a</nav>b</nav><div><li>' || {stub("'Attivit&agrave; &#232; l&rsquo;ente &euro; 5 &notit; &amp;lt;'")} || '</li><p>' || {_X} || '</p></div><article>' || {_T} || '</article></BODY>'
    WHEN 2 THEN '<body><p>' || {_T} || '</p><div class="k1 k2 k3 k4 k5 k6 k7 k8 k9">' || {_X} || '</div><section><b>&#x20AC;&nbsp;</b></section><link><form>b">modulo<p>aperto</p>'
    ELSE '<header>via</header><h2 id="t">' || {_T} || '</h2><div>' || {_X} || '</div><iframe>i</iframe><p>fine &quot;&#39;&apos;&lt;b&gt;</p>' END, '{WS}+', ' ', 'g')[1:18000] AS for_inference,
  regexp_replace(CASE k WHEN 0 THEN '<html><head><title>x</title></head><body><nav><a href=''/''>Home</a></nav><header>h</header><div class="corpo riga is-open"><h1>' || {_T} || '</h1><!-- c --><p>' || {_X} || '</p></div><li class="voce nav__a1b2c3">&copy;</li><footer>f</footer></body></html>'
    WHEN 1 THEN '<head><meta content=''WordPress 6'' name=''generator''></head><BODY class=x><nav><nav>a</nav>b</nav><div class=''corpo testo''><li class=voce>' || {stub("'Attivit&agrave; &#232; l&rsquo;ente &euro; 5 &notit; &amp;lt;'")} || '</li><p>' || {_X} || '</p></div><article class=''voce voce''>' || {_T} || '</article></BODY>'
    WHEN 2 THEN '<body><p>' || {_T} || '</p><div class="k1 k2 k3 k4 k5 k6 k7 k8 k9"><label>e</label>' || {_X} || '</div><section class=''k9 k9b ab''><b>&#x20AC;&nbsp;</b></section><link href=''/wp-content/a.css''><form><input value="a>b">modulo<p>aperto</p>'
    ELSE '<header>via</header><h2 id="t" style=''x''>' || {_T} || '</h2><div>' || {_X} || '</div><select><option>1</option></select><iframe>i</iframe><p>fine &quot;&#39;&apos;&lt;b&gt;</p>' END, '{WS}+', ' ', 'g')[1:16000] AS for_drafting
FROM n"""

#: z: the rows of l(list_id, pos, url, title, domain) with the gate's reasons.
GATE = f"""
s AS (SELECT l.*, list_filter(string_split({part('url', 3)}, '/'), lambda x: x <> '') AS seg FROM l),
d AS (
  SELECT s.*, array_to_string(seg[1:2], '/') AS prefix,
    CASE WHEN lower({strip('title')}) IN ({', '.join(f"'{c}'" for c in CHROME)}) THEN 'chrome'
         WHEN NOT (({part('url', 2)} = '' OR {part('url', 2)} = domain) AND len(seg) > 0 AND (len(seg) >= 2 OR {part('url', 4)} <> '')) THEN 'url_shape' END AS r1
  FROM s),
e AS (
  SELECT d.*, CASE WHEN r1 IS NULL AND row_number() OVER (PARTITION BY list_id, url, r1 IS NULL ORDER BY pos) > 1 THEN 'duplicate' ELSE r1 END AS r2 FROM d),
g AS (SELECT list_id, prefix, count(*) AS n, min(pos) AS first FROM e WHERE r2 IS NULL GROUP BY ALL),
h AS (SELECT g.*, row_number() OVER (PARTITION BY list_id ORDER BY n DESC, first) AS k FROM g),
i AS (SELECT list_id, sum(n) AS kept, max(n) FILTER (WHERE k = 1) AS top, max(prefix) FILTER (WHERE k = 1) AS dominant, coalesce(max(n) FILTER (WHERE k = 2), 0) AS second FROM h GROUP BY 1),
z AS (
  SELECT e.*, coalesce(r2, CASE WHEN kept >= 4 AND top >= 3 AND top >= 2 * second AND prefix <> dominant THEN 'incohesive' END, 'kept') AS reason
  FROM e LEFT JOIN i USING (list_id))"""

LISTED = f"""
WITH {CANON},
l AS (
  SELECT candidate_id, run_id::VARCHAR AS list_id, pos * 1000000000::BIGINT + candidate_id AS pos, canonical AS url, title, lower({part('base', 2)}) AS domain FROM u),
{GATE}"""

POOL = """
pool AS (
  SELECT id AS strategy_id, 'f' || (length(label) % 3) AS fingerprint, (length(list_selector) % 5)::INT AS times_worked, row_number() OVER (ORDER BY id) AS pool_pos
  FROM sources WHERE list_selector IS NOT NULL)"""
RANKS = f"""
{POOL},
pg AS (SELECT run_id AS page_id, 'f' || (run_id % 3) AS fingerprint FROM scan_runs),
top AS (SELECT * FROM pool ORDER BY times_worked DESC, pool_pos LIMIT 50),
rk AS (
  SELECT page_id, strategy_id, row_number() OVER (PARTITION BY page_id ORDER BY (top.fingerprint IS DISTINCT FROM pg.fingerprint)::INT, times_worked DESC, pool_pos) AS rank
  FROM pg CROSS JOIN top QUALIFY rank <= 10)"""

STREAKS = """
isl AS (SELECT source_id, seq, status, sum(CASE WHEN status = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY source_id ORDER BY seq) AS island FROM scan_runs),
st AS (SELECT source_id, seq, status, sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id, island ORDER BY seq) AS streak FROM isl)"""

TICKS = """
t0 AS (SELECT run_id, started_at AS now, lag(finished_at) OVER (PARTITION BY source_id ORDER BY seq) AS last FROM scan_runs),
t AS (SELECT run_id, now, last, unnest(['hourly', 'six_hourly', 'daily', 'weekly']) AS frequency FROM t0),
w AS (
  SELECT t.*, (now AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Rome' AS local FROM t),
ws AS (
  SELECT w.*, ((date_trunc('day', local) + to_hours(CASE frequency WHEN 'daily' THEN 6 ELSE (hour(local) // 6 * 6)::INT END)) AT TIME ZONE 'Europe/Rome') AT TIME ZONE 'UTC' AS window_start
  FROM w)"""

PAGER = """
pl AS (
  SELECT 'https://p.example/' || source_id || '/' || seq AS url, 'https://p.example/' || source_id || '/' || (CASE WHEN seq % 5 = 4 THEN seq - 3 ELSE seq + 1 END) AS next_url FROM scan_runs)"""

RESPONSES = f"""
g0 AS (
  SELECT grant_id, grant_id % 12 AS k, nullif(title, '') AS title, issuer, category, funding_text, deadline, CASE WHEN grant_id % 2 = 0 THEN 'valid' WHEN grant_id % 3 = 0 THEN 'not_a_grant' ELSE 'invalid_json' END AS s2 FROM grants),
resp AS (
  SELECT g0.*, CASE WHEN k IN (0, 3, 4) THEN 'invalid_json' WHEN k IN (1, 2) THEN 'not_a_grant' WHEN k BETWEEN 6 AND 10 OR length(coalesce(title, 'Senza')) > 500 OR length(issuer) > 300 THEN 'invalid' ELSE 'valid' END AS s1 FROM g0)"""

NOISE_WORDS = "bando|avviso|pubblico|contributi?|contributo|finanziamento|voucher|fondo|misura|anno|edizione|20[0-9][0-9]"

OUTCOMES = """
oc AS (
  SELECT s.*, coalesce(n.new_count, 0) AS new_count
  FROM scan_runs s LEFT JOIN (SELECT run_id, count(*) AS new_count FROM candidates GROUP BY 1) n USING (run_id))"""

NEWEST = f"""
vv AS (SELECT candidate_id, source_id, sha256(canonical) AS page, {content_hash('text')} AS version, fetched_at FROM u),
nw AS (SELECT * FROM vv QUALIFY row_number() OVER (PARTITION BY source_id, page ORDER BY fetched_at DESC, candidate_id) = 1),
led AS (
  SELECT source_id, lower(url_hash) AS page, lower(content_hash) AS old FROM page_snapshots WHERE url_hash IS NOT NULL AND source_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_id, lower(url_hash) ORDER BY last_seen_at DESC NULLS LAST, lower(content_hash) DESC NULLS LAST) = 1)"""

ORACLES = {
    "canonical_urls": f"WITH {CANON} SELECT candidate_id, canonical FROM u",
    "url_hashes": f"WITH {CANON} SELECT candidate_id, sha256(canonical) AS url_hash FROM u",
    "content_hashes": f"SELECT doc_id, {content_hash('text')} AS content_hash FROM documents",
    "clean_pages": f"{CLEAN} SELECT page_id, t[1:24000] AS text, strlen(html)::INT AS original_bytes, least(length(t), 24000)::INT AS text_length, length(t) > 24000 AS truncated FROM v",
    "clean_diagnostics": f"{CLEAN} SELECT page_id, strlen(html)::INT AS fetched_bytes, least(length(t), 24000)::INT AS cleaned_text_length, length(t) > 24000 AS truncated, t[1:500] AS cleaned_text_head FROM v",
    "gate_verdicts": f"""{LISTED}
SELECT list_id, count(*) AS candidates_before_gate, count(*) FILTER (reason = 'kept') AS candidates_accepted, count(*) FILTER (reason = 'chrome') AS rejected_chrome,
  count(*) FILTER (reason = 'url_shape') AS rejected_url_shape, count(*) FILTER (reason = 'duplicate') AS rejected_duplicate, count(*) FILTER (reason = 'incohesive') AS rejected_incohesive,
  CASE WHEN count(*) FILTER (reason = 'kept') > 200 THEN 'implausible_count_high' WHEN count(*) FILTER (reason = 'kept') < 2 THEN 'implausible_count_low' ELSE 'accepted' END AS gate_verdict
FROM z GROUP BY list_id""",
    "gate_accepted": f"{LISTED} SELECT list_id, candidate_id, url FROM z WHERE reason = 'kept' QUALIFY count(*) OVER (PARTITION BY list_id) BETWEEN 2 AND 200",
    "page_fingerprints": f"""
WITH c(k, platform, shape) AS (VALUES (0, 'unknown', 'corpo,riga,voce'), (1, 'wordpress', 'voce,corpo,testo'), (2, 'wordpress', ''), (3, 'unknown', ''))
SELECT candidate_id AS page_id, platform, platform || ':' || sha256(CASE k WHEN 2 THEN 'k9b' ELSE shape END)[1:12] AS fingerprint FROM candidates JOIN c ON k = candidate_id % 4""",
    "link_candidates": f"""
WITH {CANON}
SELECT run_id::VARCHAR AS list_id, (row_number() OVER (PARTITION BY run_id, source_id ORDER BY pos, candidate_id) - 1)::INT AS pos, canonical AS url, nullif({strip('title')}, '') AS title, 'ok' AS status FROM u""",
    "ladder_ranks": f"WITH {RANKS} SELECT page_id, strategy_id, rank FROM rk",
    "next_page": f"""
WITH r AS (
  SELECT run_id, max(last) AS last, 'https://' || lower({part("any_value(coalesce(nullif(list_url, ''), url))", 2)}) || '/elenco-' || run_id AS url FROM (SELECT run_id, (count(*) - 1) // {PER_PAGE} AS last FROM candidates GROUP BY 1) JOIN scan_runs USING (run_id) JOIN sources ON id = source_id
  WHERE type <> 'html_js' GROUP BY run_id)
SELECT url || CASE WHEN p > 1 THEN '?pagina=' || p ELSE '' END AS url, url || '?pagina=' || (p + 1) AS next_url FROM r, LATERAL (SELECT unnest(range(1, last + 1)) AS p)""",
    "page_walk": f"""
WITH RECURSIVE {PAGER},
wk(start, page_no, url, seen) AS (
  SELECT url, 1, url, [url] FROM pl WHERE url LIKE '%/1'
  UNION ALL
  SELECT wk.start, page_no + 1, pl.next_url, list_append(seen, pl.next_url) FROM wk JOIN pl USING (url)
  WHERE page_no < 20 AND NOT list_contains(seen, pl.next_url) AND pl.next_url IN (SELECT url FROM pl))
SELECT start, page_no, url FROM wk""",
    "p3_found": f"WITH {CANON}, {NEWEST} SELECT candidate_id FROM nw LEFT JOIN led USING (source_id, page) WHERE old IS DISTINCT FROM version OR old IS NULL",
    "snapshot_diff": f"""
WITH {CANON}, {NEWEST}
SELECT candidate_id, CASE WHEN led.page IS NULL THEN 'new' WHEN old IS NOT DISTINCT FROM version THEN 'unchanged' ELSE 'changed' END AS state
FROM nw LEFT JOIN led ON nw.source_id = led.source_id AND nw.page = led.page""",
    "snapshot_upsert": f"""
WITH {CANON}, {NEWEST},
o AS (SELECT * FROM page_snapshots QUALIFY row_number() OVER (PARTITION BY source_id, url_hash ORDER BY last_seen_at DESC NULLS LAST, coalesce(content_hash, '') DESC) = 1)
SELECT coalesce(o.source_id, nw.source_id) AS source_id, coalesce(o.url_hash, nw.page) AS url_hash, coalesce(nw.version, o.content_hash) AS content_hash,
  coalesce(nw.fetched_at, o.last_seen_at) AS last_seen_at, o.source_id IS NULL AS is_new
FROM o FULL JOIN nw ON o.source_id IS NOT DISTINCT FROM nw.source_id AND o.url_hash IS NOT DISTINCT FROM nw.page""",
    "grant_upsert": """
WITH b AS (SELECT max(started_at) AS began FROM scan_runs),
g AS (SELECT url_hash, source_id, title, found_at, last_seen_at, duplicate_of, grant_id, coalesce(found_at < began, true) AS known, coalesce(last_seen_at >= began, false) AS seen FROM grants, b),
o AS (SELECT * FROM g WHERE known QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY last_seen_at DESC NULLS LAST, grant_id DESC) = 1),
n AS (SELECT * FROM g WHERE NOT known OR seen QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY last_seen_at DESC NULLS LAST, grant_id DESC) = 1)
SELECT coalesce(o.url_hash, n.url_hash) AS url_hash, coalesce(n.source_id, o.source_id) AS source_id, coalesce(n.title, o.title) AS title, coalesce(o.found_at, n.found_at) AS found_at,
  coalesce(n.last_seen_at, o.last_seen_at) AS last_seen_at, coalesce(n.duplicate_of, o.duplicate_of) AS duplicate_of, o.grant_id IS NULL AS is_new
FROM o FULL JOIN n ON o.url_hash IS NOT DISTINCT FROM n.url_hash""",
    "title_normalise": rf"""
WITH a AS (SELECT grant_id, lower(title) AS t FROM grants),
b AS (SELECT grant_id, regexp_replace(regexp_replace(t, '(^|[^\pL\pN_])(?:{NOISE_WORDS})($|[^\pL\pN_])', '\1 \2', 'g'), '(^|[^\pL\pN_])(?:{NOISE_WORDS})($|[^\pL\pN_])', '\1 \2', 'g') AS t FROM a)
SELECT grant_id, trim(regexp_replace(regexp_replace(t, '[^\pL\pN\pM_\s]', ' ', 'g'), '{WS}+', ' ', 'g')) AS normalised FROM b""",
    "error_streaks": f"WITH {STREAKS} SELECT source_id, seq, status, streak FROM st",
    "autodraft_fires": f"WITH {STREAKS} SELECT source_id, seq FROM st JOIN sources ON id = source_id WHERE streak = 1 AND type IN ('html', 'html_js')",
    "schedule_windows": f"WITH {TICKS} SELECT run_id, frequency, window_start FROM ws WHERE frequency IN ('six_hourly', 'daily')",
    "schedule_gate": f"""
WITH {TICKS},
ok AS (
  SELECT ws.*, CASE WHEN frequency = 'weekly' OR last IS NULL THEN true WHEN frequency = 'hourly' THEN now - last >= INTERVAL 50 MINUTE
    WHEN frequency = 'daily' AND hour(local) < 6 THEN false ELSE last < window_start END AS run
  FROM ws)
SELECT run_id, frequency, run, CASE WHEN frequency = 'weekly' THEN 'unknown_frequency' WHEN last IS NULL THEN 'no_previous_scan'
  WHEN frequency = 'daily' AND hour(local) < 6 THEN 'before_hour' WHEN run THEN 'due' ELSE 'window_done' END AS reason
FROM ok""",
    "latest_run": "SELECT run_id, finished_at FROM scan_runs WHERE finished_at IS NOT NULL ORDER BY finished_at DESC, run_id LIMIT 1",
    "strategy_pool": f"WITH {POOL} SELECT strategy_id, times_worked FROM pool ORDER BY times_worked DESC, pool_pos LIMIT 50",
    "dedup_pool": "SELECT grant_id, source_id, title, strftime(deadline, '%Y-%m-%d') AS deadline FROM grants ORDER BY found_at DESC NULLS LAST, grant_id LIMIT 500",
    "active_sources": "SELECT id, label, CASE WHEN type IN ('rss', 'api', 'html', 'html_js', 'rule') THEN type ELSE 'html' END AS reader, coalesce(nullif(list_url, ''), url) AS page FROM sources WHERE active",
    "known_url_hashes": "SELECT DISTINCT source_id, url_hash FROM grants",
    "run_summary": f"""
WITH {OUTCOMES}
SELECT seq, count(*) AS sources, sum(new_count)::BIGINT AS new_count, CASE WHEN bool_or(status = 'error') THEN 'error' ELSE 'ok' END AS status,
  nullif(string_agg(concat_ws(': ', source_id, log), chr(10) ORDER BY source_id, concat_ws(': ', source_id, log)), '') AS log
FROM oc GROUP BY seq""",
    "source_outcomes": f"""
WITH {OUTCOMES}
SELECT source_id, count(*) FILTER (status = 'ok') AS ok_runs, count(*) FILTER (status = 'error') AS error_runs, count(*) FILTER (finished_at IS NULL) AS died, sum(new_count)::BIGINT AS candidates
FROM oc GROUP BY source_id""",
    "track_record": f"""
WITH {POOL},
e AS (SELECT source_id AS strategy_id, count(*) FILTER (status = 'ok') AS w, count(*) FILTER (status = 'error') AS f FROM scan_runs GROUP BY 1)
SELECT strategy_id, times_worked + coalesce(w, 0) AS times_worked, coalesce(f, 0) AS times_failed FROM pool LEFT JOIN e USING (strategy_id)""",
    "budget_admission": """
WITH c AS (
  SELECT r.seq AS run_key, c.source_id, candidate_id, row_number() OVER (PARTITION BY r.seq, c.source_id ORDER BY candidate_id) <= 12 AS in_budget
  FROM candidates c JOIN scan_runs r USING (run_id))
SELECT run_key, candidate_id, in_budget, in_budget AND sum(in_budget::INT) OVER (PARTITION BY run_key ORDER BY source_id, candidate_id ROWS UNBOUNDED PRECEDING) <= 200 AS admitted FROM c""",
    "source_budgets": """
WITH n AS (SELECT run_id, count(*) AS calls, (run_id % 40 + 1)::INT AS k FROM candidates GROUP BY 1),
b AS (SELECT run_id, calls, CASE WHEN k > 1 THEN greatest(10, 3 * (200 // k)) END AS budget FROM n)
SELECT run_id, budget, greatest(0, coalesce(CASE WHEN budget IS NOT NULL THEN least(200 - calls, budget - calls) END, 200 - calls)) AS remaining FROM b""",
    "relevance_topics": """
WITH s AS (SELECT grant_id, [round(abs(coalesce(relevance_score, 0.0) - k / 4.0), 6) FOR k IN [0, 1, 2]] AS r FROM grants)
SELECT grant_id, nullif(array_to_string(list_filter([CASE WHEN r[1] >= 0.5 THEN 't0' END, CASE WHEN r[2] >= 0.5 THEN 't1' END, CASE WHEN r[3] >= 0.5 THEN 't2' END], lambda x: x IS NOT NULL), ','), '') AS matched_topics, list_max(r) AS best_score FROM s""",
    "amount_parse": r"SELECT grant_id, try_cast(nullif(replace(replace(regexp_replace(funding_text, '[^\d,.]', '', 'g'), '.', ''), ',', '.'), '') AS DOUBLE) AS amount FROM grants",
    "category_coerce": f"""
SELECT grant_id, coalesce(list_filter(['Digital & Innovation', 'Sustainability', 'Startups & SMEs', 'Research & Development', 'Culture & Tourism', 'Internationalization', 'Training', 'Agriculture', 'Other'],
  lambda k: lower(k) = lower({strip('category')}))[1], 'Other') AS category FROM grants""",
    "deadline_coerce": rf"""
WITH d AS (SELECT grant_id, grant_id % 6 AS k, coalesce(strftime(deadline, '%Y-%m-%d'), 'n/d') AS day FROM grants),
r AS (SELECT grant_id, {strip("CASE k WHEN 0 THEN day[1:4] || '-02-30' WHEN 1 THEN 'entro il ' || day WHEN 2 THEN chr(160) || day || chr(10) WHEN 3 THEN day || 'T12:00' WHEN 4 THEN replace(day, '-', '/') ELSE day END")} AS t FROM d)
SELECT grant_id, CASE WHEN regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN strftime(try_cast(t AS DATE), '%Y-%m-%d') END AS deadline, regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(t AS DATE) IS NULL AS failed FROM r""",
    "requirements_clean": f"""
SELECT grant_id, array_to_string(coalesce(list_filter(list_transform(requirements, lambda x: {strip('x')}), lambda x: x IS NOT NULL AND x <> ''), [])[1:20], '|') AS requirements FROM grants""",
    "json_dig": """
WITH p AS (SELECT event_id, event_id % 5 AS k, coalesce(props, '{}') AS p FROM events),
j AS (SELECT event_id, k, CASE k WHEN 0 THEN '{"a": [{"b": ' || p || '}], "c": [1, 2]}' WHEN 1 THEN '{"a": {"b": [' || p || ', 5]}, "c": ["x"]}' WHEN 2 THEN '{"a": {"b": ' || p || '}, "c": {"d": "e"}}'
  WHEN 3 THEN '[{"a": {"b": ' || p || '}, "c": []}]' ELSE '{"a": 4, "z": ' || p || ', "c": "testo"}' END AS j FROM p)
SELECT event_id, CASE k WHEN 0 THEN json_extract_string(j, '$.a[0].b.k') WHEN 1 THEN json_extract_string(j, '$.a.b[0].k') WHEN 2 THEN json_extract_string(j, '$.a.b.k') WHEN 3 THEN json_extract_string(j, '$[0].a.b.k') END AS k,
  CASE k WHEN 0 THEN '1' WHEN 1 THEN 'x' WHEN 2 THEN '{"d":"e"}' WHEN 4 THEN 'testo' END AS c, json_extract_string(j, '$.a.x.y') AS missing FROM j""",
    "payload_text": """
WITH m AS (
  SELECT candidate_id, title, url, '{' || CASE WHEN pos % 2 = 0 THEN '"summary": "s' || pos || '", ' ELSE '"summary": "", ' END || '"metadata": {' || CASE pos % 3 WHEN 0 THEN '"callTitle": ["C' || candidate_id || '", "z"], "programmeDivision": [], "other": "no", '
    WHEN 1 THEN '"closingDate": null, "description": "d ' || candidate_id || '", ' ELSE '' END || '"budget": [' || candidate_id || '], "duration": "", "deadlineModel": "m"}}' AS j FROM candidates),
f AS (
  SELECT *, ['callTitle', 'description', 'destinationDetails', 'budget', 'deadlineDate', 'closingDate', 'deadlineModel', 'duration', 'programmeDivision', 'typesOfAction', 'callccm2Id'] AS names,
    [CASE json_type(j, '$.metadata.' || n) WHEN 'ARRAY' THEN json_extract_string(j, '$.metadata.' || n || '[0]') ELSE json_extract_string(j, '$.metadata.' || n) END
     FOR n IN ['callTitle', 'description', 'destinationDetails', 'budget', 'deadlineDate', 'closingDate', 'deadlineModel', 'duration', 'programmeDivision', 'typesOfAction', 'callccm2Id']] AS v FROM m)
SELECT candidate_id, array_to_string(list_filter(list_concat([CASE WHEN coalesce(title, '') <> '' THEN 'Title: ' || title END], list_transform(range(1, 12), lambda i: CASE WHEN coalesce(v[i], '') <> '' THEN names[i] || ': ' || v[i] END),
  [CASE WHEN coalesce(json_extract_string(j, '$.summary'), '') <> '' THEN 'Summary: ' || json_extract_string(j, '$.summary') END, 'URL: ' || coalesce(url, '')]), lambda x: x IS NOT NULL), chr(10)) AS text FROM f""",
    "extraction_validate": rf"""
WITH {RESPONSES}, l AS (SELECT *, s1 IN ('valid', 'not_a_grant') AS ok1 FROM resp)
SELECT grant_id, CASE WHEN ok1 THEN 1 ELSE 2 END AS attempt,
  CASE WHEN s1 = 'valid' OR (NOT ok1 AND s2 = 'valid') THEN 'stored' WHEN s1 = 'not_a_grant' OR (NOT ok1 AND s2 = 'not_a_grant') THEN 'rejected' ELSE 'quarantined' END AS outcome,
  CASE WHEN s1 = 'valid' THEN coalesce(title, 'Senza') WHEN NOT ok1 AND s2 = 'valid' THEN 'Secondo' END AS title,
  CASE WHEN s1 = 'valid' THEN coalesce(list_filter(['Digital & Innovation', 'Sustainability', 'Startups & SMEs', 'Research & Development', 'Culture & Tourism', 'Internationalization', 'Training', 'Agriculture', 'Other'],
    lambda c: lower(c) = lower({strip('category')}))[1], 'Other') WHEN NOT ok1 AND s2 = 'valid' THEN 'Other' END AS category,
  CASE WHEN s1 = 'valid' THEN try_cast(nullif(replace(replace(regexp_replace(funding_text, '[^\d,.]', '', 'g'), '.', ''), ',', '.'), '') AS DOUBLE) END AS funding_max, CASE WHEN s1 = 'valid' THEN strftime(deadline, '%Y-%m-%d') END AS deadline
FROM l""",
    "quarantine": f"WITH {RESPONSES} SELECT grant_id, s2 AS status FROM resp WHERE s1 NOT IN ('valid', 'not_a_grant') AND s2 NOT IN ('valid', 'not_a_grant')",
    "rule_validate": rf"""
WITH s AS (SELECT id, CASE WHEN length(label) % 4 = 0 THEN 'javascript:x' ELSE coalesce(list_selector, '') END AS sel, length(url) % 25 AS mp, CASE WHEN length(url) % 3 = 0 THEN 'delete' ELSE 'post' END AS m FROM sources),
o AS (SELECT s.*, NOT ({' OR '.join(f"contains(lower(sel), '{t}')" for t in FORBIDDEN)}) AND length(sel) <= 200 AND mp BETWEEN 1 AND 20 AND m = 'post' AS ok FROM s)
SELECT id, regexp_full_match(trim(sel), '[A-Za-z0-9\s.,#\[\]=''"_:()>+~*-]{{1,200}}') AND NOT (contains(lower(sel), 'javascript:') OR contains(lower(sel), 'expression(') OR contains(sel, '<') OR contains(lower(sel), '>alert') OR contains(lower(sel), 'url(')) AS safe,
  CASE WHEN ok THEN 'valid' ELSE 'invalid' END AS status, ok AND {strip('sel')} <> '' AS usable, false AS api_style, CASE WHEN ok THEN 'POST' END AS method, CASE WHEN ok THEN mp END AS max_pages FROM o""",
    "scrub_text": r"""
WITH m AS (SELECT doc_id, text || ' a.b@c.example hunter2hunter2-x hunter2hunter2 corto s' || 'k-' || repeat('a1', 12) || ' r' || 'e_' || repeat('a1', 12) || ' gh' || 'p_' || repeat('a1', 12) || ' github' || '_pat_' || repeat('a1', 12)
  || ' sb_' || 'secret_' || repeat('a1', 12) || ' ey' || 'J' || repeat('b2', 5) || '.' || repeat('c3', 5) || '.d4 Authorization: Bearer abc, fine' || chr(10) || 'Api-Key=xyz; ok' AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(replace(replace(t, 'hunter2hunter2-x', '[REDACTED]'), 'hunter2hunter2', '[REDACTED]'), '[\pL\pN_.+-]+@[\pL\pN_-]+\.[\pL\pN_.-]*[\pL\pN_]', '[REDACTED]', 'g') AS t FROM m),
b AS (SELECT doc_id, regexp_replace(t, '(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+|sb_(secret|publishable)_[A-Za-z0-9_-]+|\bsk-[A-Za-z0-9_-]{16,}|\bre_[A-Za-z0-9_-]{16,}|\bgh[pousr]_[A-Za-z0-9]{16,}|\bgithub_pat_[A-Za-z0-9_]{20,})', '[REDACTED]', 'g') AS t FROM a)
SELECT doc_id, regexp_replace(t, '(?i)\b(authorization|apikey|api[-_]?key)\s*[:=]\s*\S[^,;}\]"''\n]*', '\1: [REDACTED]', 'g') AS text FROM b""",
    "api_candidates": f"""
WITH {CANON}
SELECT run_id::VARCHAR AS run_id, canonical AS url, nullif({strip('title')}, '') AS title FROM u QUALIFY row_number() OVER (PARTITION BY run_id, canonical ORDER BY pos, candidate_id) = 1""",
    "rss_candidates": f"""
WITH {CANON}
SELECT run_id::VARCHAR AS run_id, (row_number() OVER (PARTITION BY run_id ORDER BY pos, candidate_id) - 1)::INT AS pos, canonical AS url, nullif({strip('title')}, '') AS title FROM u WHERE run_id % 4 <> 3""",
    "rss_outcomes": "SELECT run_id::VARCHAR AS run_id, CASE WHEN run_id % 4 = 3 THEN 0 ELSE count(*) END AS entries, CASE WHEN run_id % 4 = 3 THEN 'feed cannot be read' END AS error FROM candidates GROUP BY run_id",
    "condense_html": f"WITH {NOTICES} {CONDENSED}",
    "page_urls": """
SELECT id, k::INT AS page, CASE WHEN k > 1 AND coalesce(json_extract_string(api_config, '$.page_param'), '') <> ''
  THEN url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || json_extract_string(api_config, '$.page_param') || '=' || k ELSE url END AS page_url
FROM sources CROSS JOIN range(1, 6) AS r(k)""",
    "prompts": """
WITH t AS (SELECT string_agg('- id=t-' || type || ' name=' || type || ': ' || CASE WHEN n > 8 THEN 'da ' || n ELSE 'no description' END, chr(10) ORDER BY 't-' || type) AS t FROM (SELECT type, count(*) AS n FROM sources GROUP BY 1))
SELECT candidate_id, concat_ws(chr(10) || chr(10), 'URL: ' || url, 'TOPICS TO SCORE:' || chr(10) || CASE WHEN candidate_id % 7 <> 0 THEN t ELSE '(no topics defined — return an empty relevance array)' END, 'PAGE CONTENT:' || chr(10) || text) AS prompt FROM candidates, t""",
    "soft_duplicates": rf"""
WITH a AS (SELECT grant_id, source_id, date_trunc('month', deadline)::DATE AS month, lower(title) AS t FROM grants),
b AS (SELECT * REPLACE (regexp_replace(regexp_replace(t, '(^|[^\pL\pN_])(?:{NOISE_WORDS})($|[^\pL\pN_])', '\1 \2', 'g'), '(^|[^\pL\pN_])(?:{NOISE_WORDS})($|[^\pL\pN_])', '\1 \2', 'g') AS t) FROM a),
n AS (SELECT * REPLACE (trim(regexp_replace(regexp_replace(t, '[^\pL\pN\pM_\s]', ' ', 'g'), '{WS}+', ' ', 'g')) AS t) FROM b),
s AS (SELECT grant_id, source_id, month, array_to_string(list_sort(string_split(t, ' ')), ' ') AS x FROM n WHERE t <> '' AND month IS NOT NULL),
pr AS (
  SELECT q.grant_id, p.grant_id AS other, q.x AS x, p.x AS y FROM s q JOIN s p ON q.month = p.month AND q.grant_id <> p.grant_id AND q.source_id <> p.source_id
  WHERE q.grant_id % 50 = 0 AND least(length(q.x), length(p.x)) >= 0.8 * greatest(length(q.x), length(p.x))),
dp AS (SELECT DISTINCT x, y FROM pr),
lc AS (
  SELECT x, y, list_reduce(list_prepend(list_transform(range(0, length(y) + 1), lambda i: 0), list_transform(range(1, length(x) + 1), lambda i: [i])),
    lambda row, i: list_reduce(list_prepend([0], list_transform(range(1, length(y) + 1), lambda j: [j])),
      lambda acc, j: list_append(acc, CASE WHEN x[i[1]] = y[j[1]] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], acc[j[1]]) END)))[-1] AS lcs
  FROM dp),
sc AS (SELECT pr.grant_id, pr.other, round(200.0 * lcs / (length(x) + length(y)), 6) AS score FROM pr JOIN lc USING (x, y) WHERE 200.0 * lcs / (length(x) + length(y)) >= 90)
SELECT grant_id, other AS duplicate_of, score FROM sc QUALIFY row_number() OVER (PARTITION BY grant_id ORDER BY score DESC, other) = 1""",
}
