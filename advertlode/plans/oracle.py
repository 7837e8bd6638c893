"""SQL for DuckDB that states the expected result of each query.

Where the input is rendered, the SQL computes the rows from the table columns and does not read the rendering, so it
does not share the parsers' mistakes.
"""

from __future__ import annotations

SITE = "https://jobs.example.com"
RUN_TS = "2024-02-01T00:00:00Z"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _amount(x: str, mark: str = " ") -> str:
    return f"replace(format('{{:,}}', {x}), ',', '{mark}')"


EMPLOYER = """CASE c_custkey % 8 WHEN 0 THEN 'Forsvaret' WHEN 1 THEN 'PST'
    WHEN 2 THEN 'Politiets sikkerhetstjeneste, ' || c_mktsegment WHEN 3 THEN 'Nasjonal sikkerhetsmyndighet'
    WHEN 4 THEN c_name WHEN 5 THEN '  Førsvar-etaten!! ' || c_mktsegment WHEN 6 THEN 'Politiets Sikkerhetstjenst' END"""

NORMAL = """CASE c_custkey % 8 WHEN 0 THEN 'forsvaret' WHEN 1 THEN 'pst'
    WHEN 2 THEN 'politiets sikkerhetstjeneste ' || lower(c_mktsegment) WHEN 3 THEN 'nasjonal sikkerhetsmyndighet'
    WHEN 4 THEN lower(replace(c_name, '#', ' ')) WHEN 5 THEN 'forsvar etaten ' || lower(c_mktsegment)
    WHEN 6 THEN 'politiets sikkerhetstjenst' END"""

ADVERTS = f"""adv AS (
    SELECT o_orderkey AS k, c_custkey AS c, 'A' || o_orderkey AS listing_id, '{SITE}/stilling/' || o_orderkey AS source_url,
        'Rådgiver & analytiker ' || o_orderpriority AS title, trim({EMPLOYER}) AS employer_raw,
        {NORMAL} AS employer_normalized,
        CASE o_orderkey % 4 WHEN 0 THEN 'Oslo, Bergen' WHEN 1 THEN 'Oslo / Tromsø,Bodø' WHEN 2 THEN ', /' END AS places,
        CASE o_orderkey % 4 WHEN 0 THEN 'Oslo|Bergen' WHEN 1 THEN 'Oslo|Tromsø|Bodø' END AS locations,
        CASE WHEN o_orderkey % 2 = 0 THEN 'Fast' ELSE 'Midlertidig' END AS employment_type,
        (o_orderkey % 100 + 1) || '%' AS extent,
        strftime(o_orderdate, {ISO}) AS published_at,
        CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate + to_days((o_orderkey % 30)::INT), {ISO}) END AS updated_at,
        strftime(o_orderdate + to_days(30), {ISO}) AS apply_deadline,
        floor(o_totalprice)::BIGINT AS base, 400000 + floor(o_totalprice)::BIGINT % 300000 AS lo, lo + 50000 AS hi,
        o_orderkey % 6 AS pay, o_orderkey // 6 % 4 AS n_blocks
    FROM orders JOIN customer ON o_custkey = c_custkey),
paid AS (
    SELECT *,
        CASE WHEN pay IN (0, 5) THEN 'Lønn: kr ' || {_amount('lo')} || ' – ' || {_amount('hi')} || ' per år'
             WHEN pay = 1 THEN 'Lønn etter avtale' WHEN pay = 4 THEN 'Lønn: kr ' || {_amount('lo', '.')} END AS pay_text,
        CASE WHEN pay IN (0, 4, 5) THEN lo END AS pay_min,
        CASE WHEN pay IN (0, 5) THEN hi WHEN pay = 4 THEN lo END AS pay_max,
        CASE WHEN pay IN (2, 5) THEN ': kr ' || {_amount('lo - 1000')} || ' - NOK ' || {_amount('hi + 1000')} ELSE '' END AS own
    FROM adv),
marked AS (
    SELECT p.*, i, 1000 + (base + i * 17) % 9000 AS c1, 1000 + (base + i * 17 + 4500) % 9000 AS c2,
        ['Rådgiver', 'Konsulent', 'Overingeniør', 'Forsker'][(k + i) % 4 + 1] AS t1, (k + i) % 2 = 0 AS two
    FROM paid p, (SELECT unnest(range(3)) AS i) WHERE i < n_blocks),
blocks AS (
    SELECT *, 'Stillingskode ' || c1 || ' – ' || t1 ||
        CASE WHEN two THEN ' kode ' || c2 || ': Spesialrådgiver' || own ELSE own END AS block
    FROM marked
    UNION ALL BY NAME
    SELECT p.*, 0 AS i, 1000 + base % 9000 AS c1, 'Arkivar' AS t1, false AS two,
        concat_ws(' ', title, employer_raw, places, employment_type, extent, published_at, updated_at, apply_deadline,
                  pay_text, CASE WHEN k % 48 < 24 THEN 'Kode ' || (1000 + base % 9000) || ' – Arkivar' ELSE 'Ingen kode' END) AS block
    FROM paid p WHERE n_blocks = 0),
priced AS (
    SELECT *,
        CASE WHEN n_blocks > 0 AND pay IN (2, 5) THEN lo - 1000
             WHEN n_blocks = 0 AND pay IN (0, 5) THEN lo
             WHEN n_blocks = 0 AND pay <> 1 AND c % 8 = 4 AND c >= 100000 THEN c END AS own_min,
        CASE WHEN n_blocks > 0 AND pay IN (2, 5) THEN hi + 1000
             WHEN n_blocks = 0 AND pay IN (0, 5) THEN hi ELSE own_min END AS own_max,
        own_min IS NULL AND pay_text IS NOT NULL AS is_shared_salary
    FROM blocks WHERE n_blocks > 0 OR k % 48 < 24),
coded AS (
    SELECT *, c1 AS code, CASE WHEN n_blocks > 0 AND NOT two THEN t1 || own ELSE t1 END AS code_title FROM priced
    UNION ALL BY NAME
    SELECT *, c2 AS code, 'Spesialrådgiver' || own AS code_title FROM priced WHERE two),
rows AS (
    SELECT listing_id, code::VARCHAR AS job_code, code_title AS job_title, employer_normalized,
        CASE WHEN is_shared_salary THEN pay_min ELSE own_min END AS salary_min,
        CASE WHEN is_shared_salary THEN pay_max ELSE own_max END AS salary_max,
        CASE WHEN is_shared_salary THEN pay_text ELSE block END AS salary_text, is_shared_salary,
        published_at, updated_at, apply_deadline, source_url, '{RUN_TS}' AS scraped_at
    FROM coded)"""

LISTINGS = f"""WITH {ADVERTS}
SELECT listing_id, source_url, title, NULL::VARCHAR AS job_title, employer_raw, employer_normalized, locations,
    employment_type, extent, pay_text AS salary_text, published_at, updated_at, apply_deadline, '{RUN_TS}' AS scraped_at
FROM paid"""

ROWS = f"WITH {ADVERTS} SELECT * FROM rows"

ITEMS = f"""numbered AS (
    SELECT o_orderkey AS k, i, o_orderkey * 3 + i AS n, md5((o_orderkey * 3 + i)::VARCHAR) AS h,
        o_orderdate + to_days(i::INT) AS day
    FROM orders, (SELECT unnest(range(3)) AS i)),
items AS (
    SELECT k, i, n, n % 6 AS kind,
        concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS uuid,
        strftime(day, {ISO}) AS published_at,
        CASE WHEN n % 4 <> 0 THEN strftime(day + to_days((n % 5)::INT), {ISO}) END AS updated_at
    FROM numbered WHERE n % 6 <> 5),
summaries AS (
    SELECT *,
        CASE kind WHEN 0 THEN sha1('{SITE}/stilling/' || n % 1000 || '?a=' || n || '&b=2') WHEN 1 THEN 'J' || n
            WHEN 2 THEN (n + 1000000)::VARCHAR WHEN 3 THEN uuid ELSE 'ID-' || n END AS listing_id,
        '{SITE}' || CASE kind WHEN 0 THEN '/stilling/' || n % 1000 || '/?utm_source=liste&b=2&a=' || n
            WHEN 1 THEN '/detail?jobId=J' || n WHEN 2 THEN '/annonse/' || (n + 1000000) || '/vis'
            WHEN 3 THEN '/d/' || upper(uuid) ELSE '/stillinger/sok?visning=' || n || '#topp' END AS source_url,
        ['sha1_url', 'url_query', 'url_numeric', 'url_uuid', 'candidate'][kind + 1] AS provenance
    FROM items)"""

# The tables' own URLs have plain query values and no ids, so text functions are enough for them.
URLS = f"""urls AS (
    SELECT url, NULL AS k, -1 AS kind FROM pages
    UNION ALL
    SELECT CASE o_orderkey % 10
        WHEN 0 THEN 'HTTPS://Jobs.Example.com/stilling/' || o_orderkey % 90000 || '///?b=2&a=' || o_orderkey || '#x'
        WHEN 1 THEN '{SITE}/detail?jobId=J' || o_orderkey || '&id=&utm_term=q'
        WHEN 2 THEN '{SITE}/' || (o_orderkey + 1000000) || '/vis;v=1?gclid=1'
        WHEN 3 THEN '{SITE}/liste?p=' || (o_orderkey + 1000000)
        WHEN 4 THEN '{SITE}/u/4F8C1B2A-3d4e-5f60-a1b2-' || (o_orderkey + 100000000000) || '?id=7'
        WHEN 5 THEN '{SITE}/?q=r%C3%A5d+giver%zz&tom=&q=a*b~c&n=' || o_orderkey
        WHEN 6 THEN '{SITE}/s?id=a' || o_orderkey || '&id=b' || o_orderkey || '&uuid=z'
        WHEN 7 THEN '//jobs.example.com/x/' || o_orderkey || '?fbclid=1&UTM_source=2'
        WHEN 8 THEN '{SITE}/a;b/c;d?&&=v&k' || o_orderkey
        ELSE ' {SITE}/' || o_orderkey || '?listing_id=%20' || o_orderkey || '%20' END, o_orderkey, o_orderkey % 10
    FROM orders),
split AS (
    SELECT *, regexp_replace(url, '[?#].*$', '') AS front,
        list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_(source|medium|campaign|term|content)|gclid|fbclid)='))) AS params
    FROM urls),
canon AS (
    SELECT url, k, kind, CASE kind
        WHEN -1 THEN CASE WHEN regexp_matches(front, '^[a-z]+://[^/]*/$') THEN front ELSE rtrim(front, '/') END
            || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END
        WHEN 0 THEN 'https://Jobs.Example.com/stilling/' || k % 90000 || '?a=' || k || '&b=2'
        WHEN 1 THEN '{SITE}/detail?id=&jobId=J' || k
        WHEN 2 THEN '{SITE}/' || (k + 1000000) || '/vis'
        WHEN 5 THEN '{SITE}/?n=' || k || '&q=a%2Ab~c&q=r%C3%A5d+giver%25zz&tom='
        WHEN 7 THEN '//jobs.example.com/x/' || k || '?UTM_source=2'
        WHEN 8 THEN '{SITE}/a;b/c?=v&k' || k || '='
        WHEN 9 THEN '{SITE}/' || k || '?listing_id=+' || k || '+'
        ELSE url END AS canonical
    FROM split)"""

SALARY = f"""wage AS (
    SELECT l_orderkey % 13 AS kind, 300000 + floor(l_extendedprice * 7)::BIGINT AS lo, lo + 75000 AS hi FROM lineitem),
wording AS (
    SELECT *, CASE kind
        WHEN 0 THEN 'Lønn: kr ' || {_amount('lo')} || ' – ' || {_amount('hi')} || ' per år'
        WHEN 1 THEN 'Lønn: KR.' || {_amount('lo', '.')} WHEN 2 THEN 'Lønn ETTER avtale, kr ' || {_amount('lo')}
        WHEN 3 THEN 'NOK ' || {_amount('lo')} WHEN 4 THEN 'Lønn 12345'
        WHEN 5 THEN {_amount('hi')} || '-' || {_amount('lo')}
        WHEN 6 THEN 'kr. ' || {_amount('lo')} || '- ' || {_amount('hi')} WHEN 7 THEN '500 - ' || {_amount('lo')}
        WHEN 8 THEN 'kr. ' || {_amount('lo')} || ' til kr. ' || {_amount('hi')}
        WHEN 9 THEN 'kode 1111 – Konsulent ' || {_amount('lo')} WHEN 10 THEN 'tlf ' || lo
        WHEN 11 THEN replace({_amount('lo')}, ' ', chr(8239)) || ' kroner' ELSE 'ingen lønn oppgitt' END AS text
    FROM wage)"""

CODES = """line AS (
    SELECT l_orderkey % 9 AS kind, (1000 + l_partkey % 9000)::VARCHAR AS a, (1000 + l_suppkey % 9000)::VARCHAR AS b,
        l_linenumber::VARCHAR AS n FROM lineitem),
coded AS (
    SELECT *, CASE kind
        WHEN 0 THEN 'Stillingskode ' || a || ' – Førstekonsulent' || chr(10) || 'Kode ' || b || ' – Senioringeniør'
        WHEN 1 THEN 'Kode ' || a || ', kode ' || b || ' – Rådgiver'
        WHEN 2 THEN 'kode ' || a || ' og STILLINGSKODE' || b
        WHEN 3 THEN 'barkode ' || a || ' i rom ' || b
        WHEN 4 THEN 'Stillingskode 00' || n || ': Vikar; kode 00' || n || ' - Fast'
        WHEN 5 THEN 'kode ' || a || ' -   kode ' || b || '–Forsker '
        WHEN 6 THEN 'kode ' || a || '000 – for lang, nr ' || b
        WHEN 7 THEN 'Rom ' || a || ', tlf ' || b || '55' || n
        ELSE 'kode ' || a || ' – Konsulent – Lønn: kr 500 000 – 600 000' END AS text FROM line)"""

EMPLOYERS = f"""emp AS (
    SELECT c_custkey, {EMPLOYER} AS employer,
        CASE c_custkey % 3 WHEN 0 THEN 'Seniorrådgiver i Forsvarssektoren' WHEN 1 THEN 'Cyberforsvar-analytiker' END AS title,
        coalesce({NORMAL}, '') AS name
    FROM customer)"""

# Rule outcome by kind of employer; kinds 4, 6 and 7 match no rule.
RULE_TAG = "CASE c_custkey % 8 WHEN 0 THEN 'forsvar' WHEN 1 THEN 'pst' WHEN 2 THEN 'pst' WHEN 3 THEN 'nsm' WHEN 5 THEN 'forsvar' END"
RULE_WAY = """CASE c_custkey % 8 WHEN 0 THEN 'employer_prefix' WHEN 1 THEN 'employer_exact' WHEN 2 THEN 'employer_synonym'
    WHEN 3 THEN 'employer_synonym' WHEN 5 THEN 'employer_prefix' END"""

PHRASES = """phrases(tag, phrase, rank) AS (VALUES ('pst', 'pst', 1), ('pst', 'politiets sikkerhetstjeneste', 1),
    ('nsm', 'nsm', 2), ('nsm', 'nasjonal sikkerhetsmyndighet', 2), ('forsvar', 'forsvar', 3))"""

FUZZY = f"""sets AS (
    SELECT DISTINCT name, tag, phrase, rank, list_distinct(string_split(name, ' ')) AS a,
        list_distinct(string_split(phrase, ' ')) AS b
    FROM emp, phrases WHERE c_custkey % 8 IN (4, 6)),
parts AS (
    SELECT *, list_intersect(a, b) AS common_tokens, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ' ') AS x,
        array_to_string(list_sort(list_filter(b, lambda t: NOT list_contains(a, t))), ' ') AS y
    FROM sets)"""


def _fuzzy_result(scored: str, threshold: float) -> str:
    return f"""best AS (
    SELECT name, first(tag ORDER BY score DESC, rank) AS tag, max(score) AS score FROM {scored} GROUP BY name)
SELECT c_custkey, employer, title,
    coalesce({RULE_TAG}, CASE WHEN score >= {threshold} THEN tag END, CASE WHEN c_custkey % 3 = 0 THEN 'forsvar' END) AS org_tag,
    coalesce({RULE_WAY}, CASE WHEN score >= {threshold} THEN 'employer_fuzzy_' || tag END,
             CASE WHEN c_custkey % 3 = 0 THEN 'title_prefix_forsvar' END, 'none') AS provenance
FROM emp LEFT JOIN best USING (name)"""


UPDATES = f"""upd AS (
    SELECT 'L' || (user_id * 10 + regexp_extract(props, '[0-9]+')::INT % 10) AS listing_id, strftime(ts, {ISO}) AS last_seen_at,
        CASE event_type WHEN 'signup' THEN '' WHEN 'view' THEN NULL ELSE strftime(date_trunc('day', ts), {ISO}) END AS updated_at,
        CASE WHEN event_type = 'purchase' THEN sha1(event_id::VARCHAR) END AS detail_fingerprint,
        event_id AS seq, ts, ts < TIMESTAMP '2024-01-16' AS first_run
    FROM events)"""


def _state(where: str) -> str:
    """The state after all updates that meet the condition: it does not depend on how they were cut into runs."""
    return f"""SELECT listing_id, max(last_seen_at) AS last_seen_at,
    arg_max(updated_at, seq) FILTER (WHERE updated_at IS NOT NULL) AS updated_at,
    arg_max(detail_fingerprint, seq) FILTER (WHERE detail_fingerprint IS NOT NULL) AS detail_fingerprint
FROM upd WHERE {where} GROUP BY listing_id"""


DECIDED = f"""{UPDATES}, st AS ({_state('first_run')}),
decided AS (
    SELECT u.*, '{SITE}/stilling/' || u.listing_id || '?e=' || seq AS source_url, st.detail_fingerprint AS stored,
        CASE WHEN st.listing_id IS NULL THEN 'new' WHEN st.detail_fingerprint IS NULL THEN 'no_fingerprint'
            WHEN u.updated_at <> '' AND u.updated_at IS DISTINCT FROM st.updated_at THEN 'updated_at_changed' END AS reason
    FROM upd u LEFT JOIN st USING (listing_id) WHERE NOT first_run)"""

UNLIKE = f"""one AS (
    SELECT 'A' || o_orderkey AS listing_id, (o_orderkey % 9000)::VARCHAR AS job_code,
        CASE WHEN o_totalprice = floor(o_totalprice) THEN o_totalprice::BIGINT END AS salary_min,
        [600000, 600000, NULL, 700000][o_orderkey % 4 + 1]::BIGINT AS salary_max, o_orderkey % 2 = 0 AS is_shared_salary,
        NULL::VARCHAR AS scraped_at
    FROM orders),
two AS (
    SELECT 'B' || l_orderkey AS listing_id, NULL::VARCHAR AS job_code,
        CASE WHEN l_quantity = floor(l_quantity) THEN l_quantity::BIGINT END AS salary_min, l_partkey AS salary_max,
        true AS is_shared_salary, strftime(l_shipdate, {ISO}) AS scraped_at
    FROM lineitem),
unlike AS (
    SELECT listing_id, job_code, NULL::VARCHAR AS job_title, NULL::VARCHAR AS employer_normalized, salary_min, salary_max,
        NULL::VARCHAR AS salary_text, is_shared_salary, NULL::VARCHAR AS published_at, NULL::VARCHAR AS updated_at,
        NULL::VARCHAR AS apply_deadline, NULL::VARCHAR AS source_url, scraped_at
    FROM (SELECT * FROM one UNION ALL BY NAME SELECT * FROM two))"""


def _unescape(column: str) -> str:
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        column = f"replace({column}, '&{entity};', '{char}')"
    return column


def _encode(column: str) -> str:
    return f"replace(url_encode({column}), '%20', '+')"


FOLDED = "lower(strip_accents(text))"
PLAIN = f"replace(replace(replace({FOLDED}, 'ø', 'o'), 'æ', 'ae'), 'å', 'a')"
DOC_NORMAL = f"trim(regexp_replace({PLAIN}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"

ORACLE: dict[str, str] = {
    "advert_rows": ROWS,
    "advert_rows_per_code": f"""WITH {ADVERTS}, parts AS (
        SELECT *, n_blocks > 0 AND own <> '' AND contains(code_title, own) AS has_own,
            NOT has_own AND pay_text IS NOT NULL AS shared FROM coded)
    SELECT listing_id, code::VARCHAR AS job_code, code_title AS job_title, employer_normalized,
        CASE WHEN has_own THEN lo - 1000 ELSE pay_min END AS salary_min,
        CASE WHEN has_own THEN hi + 1000 ELSE pay_max END AS salary_max,
        CASE WHEN shared THEN pay_text ELSE code_title END AS salary_text, shared AS is_shared_salary,
        published_at, updated_at, apply_deadline, source_url, '{RUN_TS}' AS scraped_at FROM parts""",
    "advert_rows_extended": f"""WITH {ADVERTS} SELECT rows.*, '1.0' AS schema_version,
        CASE c % 8 WHEN 0 THEN 'forsvar' WHEN 1 THEN 'pst' WHEN 2 THEN 'politiets sikkerhetstjeneste' WHEN 3 THEN 'nasjonal sikkerhetsmyndighet'
            WHEN 5 THEN 'forsvar' WHEN 6 THEN 'politiets sikkerhetstjeneste' END AS matched_org_keyword,
        CASE c % 8 WHEN 0 THEN 7 / 9 WHEN 1 THEN 1.0 WHEN 2 THEN 1.0 WHEN 3 THEN 1.0 WHEN 5 THEN 1.0
            WHEN 6 THEN (100.0::DOUBLE - 100.0 * 2 / 54) / 100.0 END::DOUBLE AS match_confidence, NULL::VARCHAR AS salary_framework
        FROM rows JOIN adv USING (listing_id)""",
    "advert_listings": LISTINGS,
    "advert_blocks": f"WITH {ADVERTS} SELECT listing_id, i::INT AS block_no, block FROM blocks",
    "advert_locations": f"""WITH {ADVERTS}, places AS (
        SELECT listing_id, string_split(locations, '|') AS p FROM adv WHERE locations IS NOT NULL)
        SELECT listing_id, (unnest(range(len(p))))::INT AS place_no, unnest(p) AS place FROM places""",
    "page_fields": f"""SELECT page_id,
        nullif(trim({_unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)")}), '') AS title,
        nullif(trim({_unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}), '') AS job_title,
        nullif(trim({_unescape("regexp_extract(html, '<div class=.ad.>([^<]*)</div>', 1)")}, ' ' || chr(10)), '') AS employer_raw,
        NULL::VARCHAR AS salary_text FROM pages""",
    "page_links": f"""WITH links AS (
        SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS host,
            regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs FROM pages),
    numbered AS (
        SELECT page_id, (unnest(range(len(hrefs))))::INT AS item_no, host || {_unescape("unnest(hrefs)")} AS source_url FROM links)
    SELECT page_id, item_no, source_url, sha1(source_url) AS listing_id, 'sha1_url' AS provenance FROM numbered""",
    "page_items_function": f"""WITH links AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs FROM pages)
        SELECT page_id, (unnest(range(len(hrefs))))::INT AS item_no, {_unescape("unnest(hrefs)")} AS href FROM links""",
    "page_scan": "SELECT NULL::INT AS page_no, url, length(html)::BIGINT AS n_chars FROM pages WHERE html <> ''",
    "list_items": f"WITH {ITEMS} SELECT listing_id, source_url, published_at, updated_at, provenance FROM summaries",
    "search_frontier": f"""WITH s AS (
        SELECT *, greatest(1, c_custkey % 4 - 1) AS first,
            greatest(1, c_custkey % 4 - 1, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey % 4 END) AS last FROM customer),
    p AS (SELECT *, (unnest(range(first, last + 1)))::INT AS page_no FROM s)
    SELECT c_custkey, page_no, 'https://example.invalid/jobs/search?sector='
        || CASE WHEN c_custkey % 3 = 0 THEN 'kommune' ELSE 'state' END
        || '&open_only=' || CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END
        || '&page=' || CASE WHEN c_custkey % 3 = 1 THEN '99' ELSE page_no::VARCHAR END
        || CASE WHEN c_custkey % 5 <> 0 THEN '&q=' || {_encode("c_name || ' æ*~'")} ELSE '' END
        || CASE WHEN c_custkey % 3 = 1 THEN '&sort=' || lower(c_mktsegment) ELSE '' END AS url FROM p""",
    "url_canonical": f"WITH {URLS} SELECT url, canonical FROM canon",
    "url_site_id": f"""WITH {URLS} SELECT url, CASE
        WHEN kind = 4 THEN '4f8c1b2a-3d4e-5f60-a1b2-' || (k + 100000000000)
        WHEN kind IN (2, 3) THEN (k + 1000000)::VARCHAR WHEN k >= 100000 THEN k::VARCHAR
        WHEN kind = 9 AND k >= 1000 THEN '20' || k WHEN kind = 1 THEN 'J' || k WHEN kind = 6 THEN 'b' || k WHEN kind = 9 THEN ' ' || k || ' ' END AS site_id FROM canon""",
    "listing_keys": f"""WITH {URLS}, keyed AS (
        SELECT *, CASE WHEN kind = 4 THEN 'url_uuid' WHEN kind = 2 OR (kind IN (7, 9) AND k >= 100000) THEN 'url_numeric'
            WHEN kind IN (1, 6, 9) THEN 'url_query' ELSE 'sha1_url' END AS provenance FROM canon)
    SELECT url, CASE provenance WHEN 'url_uuid' THEN '4f8c1b2a-3d4e-5f60-a1b2-' || (k + 100000000000)
        WHEN 'url_numeric' THEN CASE WHEN kind = 2 THEN (k + 1000000)::VARCHAR ELSE k::VARCHAR END
        WHEN 'url_query' THEN CASE kind WHEN 1 THEN 'J' || k WHEN 6 THEN 'b' || k ELSE ' ' || k || ' ' END
        ELSE sha1(canonical) END AS listing_id, provenance FROM keyed""",
    "link_resolution": """WITH o AS (
        SELECT o_orderkey AS k, CASE o_orderkey % 2 WHEN 0 THEN 'https://a.example' ELSE 'http://b.example' END AS host,
            CASE o_orderkey % 2 WHEN 0 THEN '/x/' ELSE '/' END AS folder,
            CASE o_orderkey % 2 WHEN 0 THEN '/x/y' ELSE '' END AS path,
            CASE o_orderkey % 2 WHEN 0 THEN '?q=1' ELSE '' END AS query FROM orders)
    SELECT k AS o_orderkey, CASE k % 9
        WHEN 0 THEN 'https://c.example/' || k WHEN 1 THEN split_part(host, '/', 1) || '//c.example/' || k
        WHEN 2 THEN host || '/p/' || k WHEN 3 THEN host || path || '?r=' || k WHEN 4 THEN host || folder || 'z.html#s'
        WHEN 5 THEN host || '/' || k || '/v'
        WHEN 6 THEN host || path || query || CASE WHEN query <> '' THEN '#f' ELSE '' END
        WHEN 7 THEN host || path || query || '#t' ELSE 'mailto:a@b.example' END AS link FROM o""",
    "salary_ranges": f"""WITH {SALARY} SELECT text, CASE WHEN kind IN (2, 4, 9, 12) THEN NULL ELSE lo END AS salary_min,
        CASE WHEN kind IN (2, 4, 9, 12) THEN NULL WHEN kind IN (0, 5, 6) THEN hi ELSE lo END AS salary_max FROM wording""",
    "salary_ranges_extended": f"""WITH {SALARY} SELECT text,
        CASE WHEN kind IN (2, 4, 9, 12) THEN NULL WHEN kind = 7 THEN least(500000, lo) ELSE lo END AS salary_min,
        CASE WHEN kind IN (2, 4, 9, 12) THEN NULL WHEN kind IN (0, 5, 6, 8) THEN hi WHEN kind = 7 THEN greatest(500000, lo)
             ELSE lo END AS salary_max FROM wording""",
    "salary_frameworks": """SELECT CASE l_orderkey % 7
            WHEN 0 THEN 'Lønn etter Havneoverenskomsten for losene (HO' || l_linenumber || ') som los kode ' || l_partkey % 9000
            WHEN 1 THEN 'Lønnes etter regulativet, trinn ' || l_linenumber
            WHEN 2 THEN 'etter Hoved-tariffavtalen for skip nr ' || l_suppkey WHEN 3 THEN 'Lønn etter avtale'
            WHEN 4 THEN 'etter overenskomst: kr ' || (300000 + l_partkey) WHEN 5 THEN 'ETTER Kaiverksoverenskomst (K' || l_linenumber || ')'
            ELSE 'Dagen etter kom ' || l_linenumber END AS text,
        CASE l_orderkey % 7 WHEN 0 THEN 'Havneoverenskomsten for losene (HO' || l_linenumber || ')' WHEN 1 THEN 'regulativet'
            WHEN 2 THEN 'Hoved-tariffavtalen for skip nr' WHEN 5 THEN 'Kaiverksoverenskomst (K' || l_linenumber || ')' END AS framework
        FROM lineitem""",
    "grouped_amounts": """WITH a AS (SELECT round(l_extendedprice * 1000)::BIGINT AS amount, l_linenumber % 6 AS m FROM lineitem)
    SELECT replace(format('{:,}', amount), ',', [' ', '.', ',', chr(160), chr(8239), chr(8201)][m + 1]) AS text, amount FROM a""",
    "code_sets": f"""WITH {CODES} SELECT text, array_to_string(list_sort(list_distinct(CASE kind
        WHEN 4 THEN ['00' || n] WHEN 6 THEN [b] WHEN 7 THEN [a] WHEN 8 THEN [a, '500', '000', '600'] ELSE [a, b] END)), ',') AS codes
        FROM coded""",
    "code_sets_documents": """WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS word FROM documents),
    keyed AS (
        SELECT doc_id, unnest(regexp_extract_all(text, '(?i)(?:stillingskode|kode)\\s*(\\d{3,5})\\b', 1)) AS word FROM documents)
    SELECT DISTINCT doc_id, word AS code FROM (SELECT * FROM words UNION ALL SELECT * FROM keyed)
    WHERE regexp_full_match(word, '[0-9]{3,5}')""",
    "code_titles": f"""WITH {CODES}, pairs AS (
        SELECT text, CASE kind
            WHEN 0 THEN CASE WHEN a = b THEN [(a, 'Førstekonsulent')] ELSE [(a, 'Førstekonsulent'), (b, 'Senioringeniør')] END
            WHEN 1 THEN [(b, 'Rådgiver')] WHEN 2 THEN CASE WHEN a = b THEN [(a, NULL)] ELSE [(a, NULL), (b, NULL)] END
            WHEN 3 THEN [(a, NULL)] WHEN 4 THEN [('00' || n, 'Vikar;')]
            WHEN 5 THEN CASE WHEN a = b THEN [(a, NULL)] ELSE [(a, NULL), (b, 'Forsker')] END
            WHEN 6 THEN [] WHEN 7 THEN []
            ELSE [(a, 'Konsulent – Lønn: kr 500 000 – 600 000')] END AS p FROM coded),
    numbered AS (SELECT text, (unnest(range(len(p))))::INT AS pos, unnest(p) AS q FROM pairs)
    SELECT text, pos, q[1] AS job_code, q[2] AS job_title FROM numbered""",
    "accent_folding": "SELECT doc_id, md5(strip_accents(text)) AS md5 FROM documents",
    "org_normal": f"""WITH {EMPLOYERS} SELECT 'c' || c_custkey AS id, name AS normal FROM emp
        UNION ALL SELECT 'd' || doc_id, {DOC_NORMAL} FROM documents""",
    "org_tokens": f"""WITH words AS (SELECT unnest(string_split({DOC_NORMAL}, ' ')) AS token FROM documents)
        SELECT token, count(*) AS n FROM words WHERE token <> '' GROUP BY token""",
    "org_phrases": f"""WITH {EMPLOYERS} SELECT c_custkey, c_custkey % 8 IN (1, 2) AS has_pst, c_custkey % 8 = 3 AS has_nsm,
        c_custkey % 8 IN (0, 5) AS has_prefix FROM emp""",
    "org_rules": f"""WITH {EMPLOYERS} SELECT c_custkey, employer, title,
        coalesce({RULE_TAG}, CASE WHEN c_custkey % 6 = 0 THEN 'forsvar' END) AS org_tag,
        coalesce({RULE_WAY}, CASE WHEN c_custkey % 6 = 0 THEN 'title_prefix_forsvar' END, 'none') AS provenance FROM emp""",
    "org_fuzzy_jaccard": f"""WITH {EMPLOYERS}, {PHRASES}, {FUZZY}, scored AS (
        SELECT *, 100.0 * len(common_tokens) / len(list_distinct(list_concat(a, b))) AS score FROM parts),
        {_fuzzy_result('scored', 30.0)}""",
    "org_fuzzy_indel": f"""WITH RECURSIVE {EMPLOYERS}, {PHRASES}, {FUZZY},
    steps AS (
        SELECT x, y, 0 AS i, (1::BIGINT << length(y)) - 1 AS free FROM (SELECT DISTINCT x, y FROM parts)
        UNION ALL
        SELECT x, y, i + 1, ((free + (free & m)) | (free - (free & m))) & ((1::BIGINT << length(y)) - 1) FROM (
            SELECT *, list_sum(list_transform(range(length(y)), lambda j:
                CASE WHEN substr(y, j + 1, 1) = substr(x, i + 1, 1) THEN 1::BIGINT << j ELSE 0 END))::BIGINT AS m
            FROM steps WHERE i < length(x))),
    common AS (SELECT x, y, length(y) - bit_count(free) AS lcs FROM steps WHERE i = length(x)),
    scored AS (
        SELECT p.*, length(array_to_string(common_tokens, ' ')) AS s, length(p.x) AS la, length(p.y) AS lb,
            CASE WHEN s > 0 AND (la = 0 OR lb = 0) THEN 100.0 ELSE greatest(
                100.0 - 100.0 * (la + lb - 2 * coalesce(lcs, 0)) / (CASE WHEN s > 0 THEN 2 * s + 2 ELSE 0 END + la + lb),
                CASE WHEN s > 0 THEN 100.0 - 100.0 * (la + 1) / (2 * s + 1 + la) END,
                CASE WHEN s > 0 THEN 100.0 - 100.0 * (lb + 1) / (2 * s + 1 + lb) END) END AS score
        FROM parts p LEFT JOIN common USING (x, y)),
    {_fuzzy_result('scored', 50.0)}""",
    "org_scores": f"""WITH RECURSIVE {EMPLOYERS},
    listed(phrase, phrase_no) AS (VALUES ('pst', 0), ('politiets sikkerhetstjeneste', 1), ('nsm', 2), ('nasjonal sikkerhetsmyndighet', 3), ('forsvar', 4)),
    sets AS (
        SELECT DISTINCT name, phrase, phrase_no, list_filter(list_distinct(string_split(name, ' ')), lambda t: t <> '') AS a,
            list_distinct(string_split(phrase, ' ')) AS b FROM emp, listed),
    {FUZZY[FUZZY.index("parts AS"):]},
    -- The textbook table for the longest common subsequence, a row for each character of x.
    lcs AS (
        SELECT x, y, 0 AS i, list_transform(range(length(y) + 1), lambda j: 0::BIGINT) AS line FROM (SELECT DISTINCT x, y FROM parts)
        UNION ALL
        SELECT x, y, i + 1, list_reduce(list_prepend([0::BIGINT], list_transform(range(1, length(y) + 1), lambda j: [
            CASE WHEN substr(x, i + 1, 1) = substr(y, j, 1) THEN line[j] + 1 ELSE line[j + 1] END])),
            lambda done, new: list_append(done, greatest(done[len(done)], new[1])))
        FROM lcs WHERE i < length(x)),
    scored AS (
        SELECT p.*, length(array_to_string(common_tokens, ' ')) AS s, length(p.x) AS la, length(p.y) AS lb, line[length(p.y) + 1] AS common
        FROM parts p JOIN lcs ON lcs.x = p.x AND lcs.y = p.y AND i = length(p.x)),
    final AS (
        SELECT name, phrase_no, CASE WHEN len(a) = 0 THEN 0.0 WHEN s > 0 AND (la = 0 OR lb = 0) THEN 100.0 ELSE greatest(
            200.0 * (CASE WHEN s > 0 THEN s + 1 ELSE 0 END + common) / (CASE WHEN s > 0 THEN 2 * s + 2 ELSE 0 END + la + lb),
            CASE WHEN s > 0 THEN 200.0 * s / (2 * s + 1 + la) ELSE 0.0 END,
            CASE WHEN s > 0 THEN 200.0 * s / (2 * s + 1 + lb) ELSE 0.0 END) END::DOUBLE AS score FROM scored)
    SELECT c_custkey, phrase_no, round(score, 6) AS score FROM emp JOIN final USING (name)""",
    "org_explained": f"""WITH {EMPLOYERS} SELECT c_custkey,
        CASE c_custkey % 8 WHEN 0 THEN 'employer_prefix' WHEN 1 THEN 'employer_exact' WHEN 2 THEN 'employer_synonym' WHEN 3 THEN 'employer_synonym'
            WHEN 5 THEN 'employer_prefix' WHEN 6 THEN 'employer_fuzzy_pst' ELSE CASE WHEN c_custkey % 3 = 0 THEN 'title_prefix_forsvar' ELSE 'none' END END AS provenance,
        CASE c_custkey % 8 WHEN 1 THEN 'pst' WHEN 2 THEN 'politiets sikkerhetstjeneste' WHEN 3 THEN 'nasjonal sikkerhetsmyndighet' WHEN 0 THEN 'forsvar'
            WHEN 5 THEN 'forsvar' WHEN 6 THEN 'politiets sikkerhetstjeneste' ELSE CASE WHEN c_custkey % 3 = 0 THEN 'forsvar' END END AS matched_org_keyword,
        round(CASE c_custkey % 8 WHEN 1 THEN 1.0 WHEN 2 THEN 1.0 WHEN 3 THEN 1.0 WHEN 0 THEN 7 / 9 WHEN 5 THEN 1.0 WHEN 6 THEN 200.0 * (10 + 16) / 54 / 100
            ELSE CASE WHEN c_custkey % 3 = 0 THEN 7 / length('forsvarssektoren') END END::DOUBLE, 6) AS match_confidence FROM emp""",
    "org_table": f"""WITH {EMPLOYERS} SELECT c_custkey, employer,
        CASE WHEN k IN (0, 5) THEN 'forsvar' WHEN k IN (1, 2, 6) THEN 'pst' WHEN k = 3 THEN 'nsm' WHEN c_custkey % 16 = 4 THEN 'kunde ' || c_custkey END AS org_tag,
        CASE WHEN k = 1 THEN 'employer_exact' WHEN k IN (0, 2, 3, 5) OR c_custkey % 16 = 4 THEN 'employer_synonym' WHEN k = 6 THEN 'employer_fuzzy_pst'
            ELSE 'none' END AS provenance,
        CASE WHEN k IN (0, 5) THEN 'forsvar' WHEN k = 1 THEN 'pst' WHEN k IN (2, 6) THEN 'politiets sikkerhetstjeneste'
            WHEN k = 3 THEN 'nasjonal sikkerhetsmyndighet' WHEN c_custkey % 16 = 4 THEN name END AS matched_org_keyword,
        CASE WHEN k = 6 THEN round(26 / 27, 6) WHEN k IN (0, 1, 2, 3, 5) OR c_custkey % 16 = 4 THEN 1.0 END::DOUBLE AS match_confidence
        FROM (SELECT *, c_custkey % 8 AS k FROM emp)""",
    "org_phrase_pairs": """WITH names AS (SELECT DISTINCT lower(p_name) AS name FROM part),
        words AS (SELECT DISTINCT lower(substr(p_name, (1 + p_partkey % 5)::INT, (1 + p_partkey % 6)::INT)) AS phrase FROM part)
        SELECT name, phrase FROM names JOIN words ON phrase <> '' AND contains(name, phrase)""",
    "org_in_scope": f"""WITH {ADVERTS}, tagged AS (
        SELECT listing_id, title, employer_raw,
            CASE c % 8 WHEN 0 THEN 'forsvar' WHEN 1 THEN 'pst' WHEN 2 THEN 'pst' WHEN 3 THEN 'nsm' WHEN 5 THEN 'forsvar'
                WHEN 6 THEN 'pst' END AS org_tag,
            CASE c % 8 WHEN 0 THEN 'employer_prefix' WHEN 1 THEN 'employer_exact' WHEN 2 THEN 'employer_synonym'
                WHEN 3 THEN 'employer_synonym' WHEN 5 THEN 'employer_prefix' WHEN 6 THEN 'employer_fuzzy_pst' END AS provenance
        FROM adv) SELECT * FROM tagged WHERE org_tag IS NOT NULL""",
    "state_upsert": f"WITH {UPDATES} {_state('true')}",
    "state_from_summaries": f"""WITH {UPDATES}, a AS ({_state('true')}), b AS ({_state('first_run')})
        SELECT a.listing_id, CASE WHEN a.listing_id IN (SELECT listing_id FROM upd WHERE NOT first_run) THEN '{RUN_TS}'
            ELSE a.last_seen_at END AS last_seen_at, a.updated_at, b.detail_fingerprint FROM a LEFT JOIN b USING (listing_id)""",
    "fingerprints": "SELECT page_id, sha1(html) AS detail_fingerprint FROM pages",
    "fingerprint_lookup": f"WITH {DECIDED} SELECT listing_id, seq, stored AS detail_fingerprint FROM decided",
    "fingerprint_update": f"""WITH {UPDATES}, a AS ({_state('true')}), b AS ({_state('first_run')})
        SELECT b.listing_id, b.last_seen_at, b.updated_at, a.detail_fingerprint FROM b JOIN a USING (listing_id)""",
    "candidates": f"WITH {DECIDED} SELECT listing_id, reason, seq FROM decided WHERE reason IS NOT NULL",
    "candidates_full": f"WITH {UPDATES} SELECT listing_id, 'full' AS reason, seq FROM upd",
    "candidates_changed": f"""WITH {DECIDED}, hand AS (
        SELECT listing_id, min(detail_fingerprint) AS low, max(detail_fingerprint) AS high FROM decided GROUP BY listing_id),
    more AS (
        SELECT d.listing_id, seq, coalesce(reason, CASE WHEN low <> stored OR high <> stored THEN 'fingerprint_changed' END) AS reason
        FROM decided d LEFT JOIN hand USING (listing_id))
    SELECT listing_id, reason, seq FROM more WHERE reason IS NOT NULL""",
    "candidate_sources": f"""WITH {DECIDED}, firsts AS (
        SELECT listing_id, arg_min(source_url, seq) AS source_url FROM decided GROUP BY listing_id)
        SELECT listing_id, reason, seq, firsts.source_url FROM decided JOIN firsts USING (listing_id) WHERE reason IS NOT NULL""",
    "listings_unseen": f"WITH {DECIDED} SELECT listing_id, seq FROM decided WHERE listing_id NOT IN (SELECT listing_id FROM st)",
    "listings_seen": f"WITH {DECIDED} SELECT listing_id, seq FROM decided WHERE listing_id IN (SELECT listing_id FROM st)",
    "explode_arrays": f"""WITH o AS (SELECT *, unnest(range(1, o_orderkey % 4 + 1)) AS i FROM orders)
        SELECT 'A' || o_orderkey AS listing_id, (o_orderkey % 9000 + i)::VARCHAR AS job_code, NULL::VARCHAR AS job_title,
            'forsvaret' AS employer_normalized, o_orderkey * i AS salary_min, o_orderkey * 2 * i AS salary_max,
            'x' AS salary_text, i = 2 AS is_shared_salary, o_orderstatus AS published_at, NULL::VARCHAR AS updated_at,
            NULL::VARCHAR AS apply_deadline, o_orderpriority AS source_url, '{RUN_TS}' AS scraped_at FROM o""",
    "schema_align": f"WITH {UNLIKE} SELECT * FROM unlike",
    "row_ingestion": """SELECT o_orderkey,
        CASE k WHEN 0 THEN 'A' || o_orderkey WHEN 1 THEN o_orderkey::VARCHAR WHEN 2 THEN 'B' || o_orderkey END AS listing_id,
        CASE k WHEN 0 THEN o_orderkey::VARCHAR END AS job_code, CASE k WHEN 7 THEN 'Råd "' || o_orderkey || '"' END AS job_title,
        CASE k WHEN 0 THEN 600000 WHEN 1 THEN 700000 WHEN 7 THEN 9007199254740993 END::BIGINT AS salary_min,
        CASE k WHEN 1 THEN 750000 END::BIGINT AS salary_max, CASE k WHEN 0 THEN true WHEN 1 THEN false END AS is_shared_salary,
        CASE k WHEN 3 THEN 'not_json' WHEN 4 THEN 'not_object' WHEN 6 THEN 'missing' END AS problem,
        CASE k WHEN 2 THEN 'salary_min' WHEN 5 THEN 'listing_id,job_title,salary_min' WHEN 7 THEN 'is_shared_salary' ELSE '' END AS unfit
        FROM (SELECT *, o_orderkey % 8 AS k FROM orders)""",
    "stream_distinct": "SELECT DISTINCT 'L' || user_id AS listing_id, event_type AS job_code FROM events",
    "load_stamp": f"WITH {UNLIKE} SELECT listing_id, coalesce(scraped_at, '{RUN_TS}') AS scraped_at FROM unlike",
    "sink_runs": f"""WITH {UNLIKE}, stamps AS (SELECT unnest(['2024-01-01T00:00:00Z', '{RUN_TS}']) AS run),
        formats AS (SELECT unnest(['parquet', 'csv']) AS format)
        SELECT format, run, is_shared_salary, count(*) AS n FROM unlike, stamps, formats GROUP BY ALL""",
    "quality": f"""WITH {ADVERTS} SELECT count(*) AS total_rows, count(job_code) AS codes_present,
        count(job_code) / count(*) AS codes_pct, count(salary_min) AS salary_any_present,
        count(salary_min) / count(*) AS salary_any_pct, true AS schema_ok FROM rows""",
    "quality_duplicates": f"""WITH {UNLIKE}, keys AS (
        SELECT count(*) AS n FROM unlike GROUP BY listing_id, job_code)
        SELECT sum(n)::BIGINT AS total_rows, count(*) AS distinct_rows, (sum(n)::BIGINT - count(*)) / sum(n)::BIGINT AS duplicate_rate FROM keys""",
    "latest_rows": f"""WITH {UNLIKE}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY listing_id, job_code ORDER BY scraped_at DESC NULLS LAST,
            salary_min DESC NULLS LAST, salary_max DESC NULLS LAST) AS r FROM unlike)
        SELECT * EXCLUDE (r) FROM ranked WHERE r = 1""",
    "reason_counts": f"WITH {DECIDED} SELECT reason, count(*) AS n FROM decided WHERE reason IS NOT NULL GROUP BY reason",
    "efficiency": f"""WITH {UPDATES}, firsts AS (
        SELECT listing_id, arg_max(updated_at, seq) FILTER (WHERE updated_at IS NOT NULL) AS updated_at,
            count(detail_fingerprint) > 0 AS read FROM upd WHERE first_run GROUP BY listing_id),
    second AS (
        SELECT count(*) AS n FROM upd u LEFT JOIN firsts f USING (listing_id) WHERE NOT first_run AND (
            f.listing_id IS NULL OR NOT read OR (u.updated_at <> '' AND u.updated_at IS DISTINCT FROM f.updated_at)))
    SELECT run1_candidates, second.n AS run2_candidates, 1.0 - run2_candidates / run1_candidates AS reduction_ratio
    FROM (SELECT count(*) AS run1_candidates FROM upd WHERE first_run), second""",
    "run_summary": f"""WITH {ADVERTS}, {ITEMS}, counts AS (
        SELECT (SELECT count(*) FROM orders) AS pages, count(*) AS discovered,
            count(*) FILTER (WHERE NOT ((k % 2 = 0 AND kind = 2) OR kind = 4)) AS missing,
            (SELECT count(*) FROM rows) AS n FROM summaries)
    SELECT 1 AS run, pages, discovered, discovered AS new, 0::BIGINT AS updated, 0::BIGINT AS unchanged,
        0::BIGINT AS pending_fp, discovered AS candidates, missing AS failures, n AS rows FROM counts
    UNION ALL
    SELECT 2, pages, discovered, 0, 0, discovered - missing, missing, missing, missing, 0 FROM counts""",
    "stream_candidates": f"""WITH {UPDATES}, drops AS (
        SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS d FROM upd),
    st AS (
        SELECT b.d, listing_id, arg_max(updated_at, seq) FILTER (WHERE updated_at IS NOT NULL) AS updated_at,
            count(detail_fingerprint) > 0 AS read
        FROM drops, (SELECT unnest([1, 2]) AS d) b WHERE drops.d < b.d GROUP BY b.d, listing_id),
    decided AS (
        SELECT u.listing_id, seq, CASE WHEN st.listing_id IS NULL THEN 'new' WHEN NOT read THEN 'no_fingerprint'
            WHEN u.updated_at <> '' AND u.updated_at IS DISTINCT FROM st.updated_at THEN 'updated_at_changed' END AS reason
        FROM drops u LEFT JOIN st USING (d, listing_id))
    SELECT listing_id, reason, seq FROM decided WHERE reason IS NOT NULL""",
}
for _name, _same in (("sink_exploded_parquet", "advert_rows"), ("sink_exploded_csv", "advert_rows"),
                     ("stream_rows", "advert_rows"), ("sink_listings_parquet", "advert_listings"),
                     ("sink_listings_csv", "advert_listings"), ("state_commit", "state_upsert"),
                     ("state_buckets", "state_upsert"),
                     ("stream_state", "state_upsert"), ("stream_aggregate", "state_upsert"), ("stream_decisions", "candidates"), ("stream_versions", "state_upsert")):
    ORACLE[_name] = ORACLE[_same]

# The streams add up to one batch, in any split; of repeated pages the newest is read, whichever way they are matched.
ORACLE["stream_after_run"] = ORACLE["state_upsert"]
ORACLE["run_repeated_pages"] = f"""SELECT r.* EXCLUDE (run), m.match FROM ({ORACLE["run_summary"]}) r,
    (SELECT unnest(['exact', 'canonical']) AS match) m WHERE r.run = 1"""
