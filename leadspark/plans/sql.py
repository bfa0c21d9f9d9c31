"""The same queries in SQL, as DuckDB runs it on the same tables."""

from __future__ import annotations

import re

from ..functions.address import POSTCODES
from ..functions.email import INSIDE, SYNTAX
from ..operators.cache import TTL
from ..vocab import CALLING_CODES, CATEGORY_PRIORS, CATEGORY_TERMS, DENYLIST, FOUNDED, GENERIC_LOCAL_PARTS, INGREDIENTS, LANGUAGE_WORDS, MAILBOXES, NO_REPLY, NOT_NAMES, PARTICLES, PUBLIC_SUFFIXES, REVIEW_TIERS, SEARCHES, SIZES, SUFFIXES, TRACKING
from .queries import LEAD_SRC, NOW, YEAR

_SPACE = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _alt(words) -> str:
    return "|".join(re.sub(r"([.\\+*?\[^\]$(){}=!<>|:#/&-])", r"\\\1", w).replace(r"\=", "=").replace(r"\!", "!").replace(r"\<", "<").replace(r"\>", ">").replace(r"\:", ":").replace(r"\#", "#").replace(r"\/", "/").replace(r"\&", "&") for w in sorted(set(words), key=lambda w: (-len(w), w)))


def _in(words) -> str:
    return "(" + ", ".join(map(_q, words)) + ")"


def _list(words) -> str:
    return "[" + ", ".join(map(_q, words)) + "]"


def _map(d: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in d.items()) + "}"


SRC = f"(SELECT {', '.join(LEAD_SRC)} FROM cleaned_enriched)"


def _clean(c: str) -> str:
    return f"coalesce(trim(regexp_replace({c}, {_q(_SPACE + '+')}, ' ', 'g'), ' '), '')"


def _suffix(c: str) -> str:
    return f"trim(regexp_replace({c}, {_q('(?i) (?:' + _alt(SUFFIXES) + ')$')}, ''), ' ')"


def _class(c: str) -> str:
    t = f"lower(trim({c}, ' '))"
    return "coalesce(CASE " + " ".join(f"WHEN regexp_matches({t}, {_q(_alt(ws))}) THEN {_q(n)}" for n, ws in CATEGORY_TERMS.items()) + " ELSE 'other' END, 'other')"


def _number(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)"


def _postcode(c: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({c}, {_q('(' + p + ')')}, 1), '')" for p in POSTCODES) + ", '')"


def _phone(raw: str, region: str) -> str:
    """The columns t, digits, ... of a phone's parsing as a chain of selects over rows(id, raw, region)."""
    codes = dict(CALLING_CODES)
    return f"""
p1 AS (SELECT *, regexp_replace(trim({raw}, ' '), '\\(0\\)', '', 'g') AS t FROM rows_),
p2 AS (SELECT *, regexp_replace(t, '[^0-9]', '', 'g') AS digits, starts_with(regexp_replace(t, '^[(\\s]+', ''), '+') AS plus FROM p1),
p3 AS (SELECT *, starts_with(digits, '00') AS zeros, {_map({r: c for c, r in codes.items()})}[{region}] AS code, CASE WHEN {region} = 'IT' THEN digits ELSE regexp_replace(digits, '^0', '') END AS national FROM p2),
p4 AS (SELECT *, CASE WHEN plus THEN digits WHEN zeros THEN substr(digits, 3) WHEN code IS NOT NULL THEN code || national END AS whole FROM p3),
p5 AS (SELECT *, nullif(regexp_extract(whole, {_q('^(' + _alt(codes) + ')')}, 1), '') AS prefix FROM p4),
p6 AS (SELECT *, {_map(codes)}[prefix] AS country_, length(whole) - length(prefix) AS rest, substr(whole, length(prefix) + 1) AS local_ FROM p5),
p7 AS (SELECT *, coalesce(prefix IS NOT NULL AND rest BETWEEN 6 AND 13 AND length(whole) <= 15 AND NOT regexp_matches(local_, '^(0{{2,}}|1{{2,}}|2{{2,}}|3{{2,}}|4{{2,}}|5{{2,}}|6{{2,}}|7{{2,}}|8{{2,}}|9{{2,}})$'), false) AS ok, digits <> '' AS some_ FROM p6)"""


_E164 = "CASE WHEN some_ THEN '+' || coalesce(whole, digits) END"
_VALID = "coalesce(ok AND some_, false)"

_REGISTRABLE = _q(r"([^.]+\.(?:" + _alt(PUBLIC_SUFFIXES) + r"))\.?$")
_URL = f"""
u1 AS (SELECT *, CASE WHEN starts_with(trim(u, ' '), 'http://') OR starts_with(trim(u, ' '), 'https://') THEN trim(u, ' ') ELSE 'https://' || trim(u, ' ') END AS ut FROM urls_),
u2 AS (SELECT *, regexp_replace(regexp_replace(ut, '^https?://', ''), '#.*$', '') AS rest_ FROM u1),
u3 AS (SELECT *, lower(regexp_extract(rest_, '^([^/?]*)', 1)) AS host_, regexp_extract(rest_, '^[^/?]*([^?]*)', 1) AS path_, list_filter(string_split(regexp_extract(rest_, '^[^?]*\\?(.*)$', 1), '&'), lambda x: regexp_matches(x, '^[^=]+=.+$') AND lower(regexp_extract(x, '^([^=]*)', 1)) NOT IN {_in(TRACKING)}) AS pairs FROM u2),
u4 AS (SELECT *, regexp_replace('https://' || host_ || path_ || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(pairs, '&') ELSE '' END, '/+$', '') AS url_ FROM u3),
u5 AS (SELECT *, nullif(lower(regexp_extract(url_, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#\\s]+)', 1)), '') AS h FROM u4),
u6 AS (SELECT *, CASE WHEN h IS NULL THEN NULL WHEN regexp_matches(h, '^\\d{{1,3}}(\\.\\d{{1,3}}){{3}}$') THEN h || '.'
  WHEN regexp_extract(h, {_REGISTRABLE}, 1) <> '' THEN regexp_extract(h, {_REGISTRABLE}, 1)
  WHEN regexp_extract(h, '([^.]+\\.[^.]+)\\.?$', 1) <> '' THEN regexp_extract(h, '([^.]+\\.[^.]+)\\.?$', 1) ELSE h || '.' END AS domain_ FROM u5)"""


def _person(c: str) -> str:
    t = f"regexp_replace(coalesce({c}, ''), '\\([^)]*\\)', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)\\b(mr|mrs|ms|dr|prof)\\.?\\s+', '', 'g')"
    t = f"regexp_replace(translate({t}, '|/_', '   '), {_q(_SPACE + '+')}, ' ', 'g')"
    return f"regexp_replace({t}, '^[ ,.\\t\\n\\r-]+|[ ,.\\t\\n\\r-]+$', '', 'g')"


def _filled(c: str) -> str:
    t = f"trim(CAST({c} AS STRING), ' ')"
    return f"CASE WHEN {t} <> '' AND lower({t}) <> 'nan' THEN {t} END"


def _points() -> str:
    f = lambda c: f"CAST(coalesce(trim(CAST({c} AS STRING), ' ') <> '', false) AS INT)"
    n = lambda c: f"TRY_CAST(trim(CAST({c} AS STRING), ' ') AS DOUBLE)"
    return "CAST(" + " + ".join(f"10 * {f(c)}" for c in ("business_name", "category", "address", "phone_raw", "google_maps_url")) + f" + 15 * {f('website_raw')} + 10 * CAST(coalesce({n('rating')} > 0, false) AS INT) + 10 * CAST(coalesce(floor({n('reviews_count')}) > 0, false) AS INT) + 10 * CAST(coalesce({n('lat')} <> 0 AND {n('lon')} <> 0, false) AS INT) AS INT)"


_USABLE = """usable AS (SELECT * REPLACE (CASE WHEN regexp_matches(phone_e164, '^\\+[0-9]{11,15}$') AND NOT regexp_matches(phone_e164, '(0{8}|1{8}|9{8})') THEN phone_e164 END AS phone_e164,
  CASE WHEN contains(website_domain, '.') AND website_domain NOT IN (SELECT domain FROM shared_domains) THEN website_domain END AS website_domain) FROM cleaned_enriched)"""
_REACH = f"""{_USABLE},
keyed AS (SELECT source_row_id AS id, 'p' || phone_e164 AS k FROM usable WHERE phone_e164 IS NOT NULL UNION ALL SELECT source_row_id, 'd' || website_domain FROM usable WHERE website_domain IS NOT NULL),
edges AS (SELECT DISTINCT min(id) OVER (PARTITION BY k) AS a, id AS b FROM keyed),
ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a AS id, b AS other FROM ways UNION SELECT r.id, w.b FROM reach r JOIN ways w ON r.other = w.a),
comps AS (SELECT u.source_row_id AS id, least(u.source_row_id, coalesce(min(r.other), u.source_row_id)) AS component FROM usable u LEFT JOIN reach r ON u.source_row_id = r.id GROUP BY u.source_row_id)"""

_PAGES = """pages_ AS (SELECT doc_id, source, website_domain, coalesce(lang, '') AS lang_, '<html lang="' || coalesce(lang, '') || '"><head><title>' || coalesce(website_domain, '?') || ' &amp; more | Home</title></head><body>' || text || '<a href="https://www.linkedin.com/company/x">l</a></body></html>' AS html FROM documents)"""
_FLAT = """regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style|noscript)\\b[^>]*>.*?</(?:script|style|noscript)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', '', 'g')"""

_CACHE = "c AS (SELECT cache_key AS key, domain, provider, status, result_json AS result, error_reason, created_at, expires_at FROM enrichment_cache)"
_LATEST = f"{_CACHE}, latest AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY created_at DESC NULLS LAST, domain DESC NULLS LAST, provider DESC NULLS LAST, status DESC NULLS LAST, result DESC NULLS LAST, error_reason DESC NULLS LAST, expires_at DESC NULLS LAST) AS n FROM c) WHERE n = 1)"
_LIVE = "(expires_at IS NULL OR expires_at > TIMESTAMP '{now}') AND created_at > TIMESTAMP '{now}' - INTERVAL {days} DAY"

_SYNTAX_OK = f"regexp_matches(trim(email_raw, ' '), {_q(SYNTAX)})"
_STRICT = f"coalesce({_SYNTAX_OK} AND length(trim(email_raw, ' ')) <= 254 AND length(split_part(trim(email_raw, ' '), '@', 1)) <= 64 AND NOT regexp_matches(trim(email_raw, ' '), '^\\.|\\.@|\\.\\.'), false)"
_VERIFY = f"""v AS (SELECT source_row_id, lower(trim(coalesce(email_raw, ''), ' ')) AS e, {_STRICT.replace('email_raw', "lower(trim(coalesce(email_raw, ''), ' '))")} AS good, m.has_mx
  FROM cleaned_enriched l LEFT JOIN (SELECT lower(domain) AS d, bool_or(has_mx) AS has_mx FROM mx_lookup GROUP BY 1) m ON m.d = CASE WHEN contains(l.email_raw, '@') THEN split_part(lower(trim(l.email_raw, ' ')), '@', -1) ELSE '' END),
s AS (SELECT source_row_id, CASE WHEN e = '' THEN 'unverified' WHEN NOT good THEN 'invalid' WHEN has_mx = false THEN 'invalid' ELSE 'likely_valid' END AS verification_status, CASE WHEN e = '' THEN 'low' WHEN NOT good THEN 'high' WHEN has_mx = false THEN 'high' ELSE 'medium' END AS verification_confidence FROM v)"""


_MAILBOXES = f"""{_VERIFY},
asked AS (SELECT DISTINCT e FROM v WHERE e <> ''),
tried AS (SELECT e, unnest(range(len(hosts))) AS i FROM asked JOIN (SELECT lower(domain) AS d, hosts FROM mx_lookup) x ON split_part(e, '@', -1) = x.d),
said AS (SELECT e, i, [250, 550, 0, 451, 250][(length(e) + i) % 5 + 1] AS code, (length(e) + i) % 10 = 0 AS any_name FROM tried),
decided AS (SELECT e, arg_max(code, i) FILTER (code <> 451) AS code, arg_max(any_name, i) FILTER (code <> 451) AS any_name FROM said GROUP BY 1),
box AS (SELECT e, CASE WHEN code = 250 AND any_name THEN 'catch_all' WHEN code = 250 THEN 'verified' WHEN code = 550 THEN 'bounced' WHEN code = 0 THEN 'timeout' ELSE 'error' END AS status FROM decided),
w AS (SELECT v.*, CASE WHEN v.e <> '' AND good AND coalesce(has_mx, true) THEN coalesce(status, 'unverified') END AS smtp_status FROM v LEFT JOIN box ON v.e = box.e)"""


def _bucket(n: str) -> str:
    return f"CASE WHEN {n} IS NULL THEN NULL " + " ".join(f"WHEN {n} < {b} THEN {_q(name)}" for name, _, b in SIZES[:-1]) + f" ELSE {_q(SIZES[-1][0])} END"


_EMP = "regexp_replace(lower(trim(estimated_employees, ' ')), '^(?:~|≈|ca\\.?|circa|approx\\.?|approximately|about|around|etwa|rund|environ)\\s*', '')"
_RANGE = "'^(\\d+)\\s*(?:-|–|—|to|bis)\\s*(\\d+)'"
_COUNT = f"""CASE WHEN regexp_extract({_EMP}, {_RANGE}, 1) <> '' THEN (TRY_CAST(regexp_extract({_EMP}, {_RANGE}, 1) AS DOUBLE) + TRY_CAST(regexp_extract({_EMP}, {_RANGE}, 2) AS DOUBLE)) / 2
  WHEN regexp_extract({_EMP}, '^(\\d+)\\s*\\+', 1) <> '' THEN TRY_CAST(regexp_extract({_EMP}, '^(\\d+)\\s*\\+', 1) AS DOUBLE) * 1.5 ELSE TRY_CAST(nullif(regexp_extract({_EMP}, '^(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) END"""
_MIDS = {b: m for b, m, _ in SIZES}


def _mid(b: str) -> str:
    return f"CASE {b} " + " ".join(f"WHEN {_q(k)} THEN {m}" for k, m in _MIDS.items()) + " END"


def _prior(c: str, what: int) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower(coalesce({c}, '')), {_q(k)}) THEN {_q((k, b)[what])}" for k, b in CATEGORY_PRIORS.items()) + " END"


_SIZE = f"""a AS (SELECT source_row_id, reviews_count_normalized AS n, {_class('category')} AS cc, category FROM cleaned_enriched),
b AS (SELECT *, CASE WHEN n > 0 THEN CASE {' '.join(f"WHEN n >= {k} THEN {_q(v)}" for k, v in REVIEW_TIERS)} END END AS rb, coalesce({_prior('cc', 0)}, {_prior('category', 0)}) AS pk, coalesce({_prior('cc', 1)}, {_prior('category', 1)}) AS pb FROM a),
d AS (SELECT *, CASE WHEN rb IS NOT NULL AND pb IS NOT NULL THEN (2.0 * {_mid('rb')} + 1.5 * {_mid('pb')}) / 3.5 WHEN rb IS NOT NULL THEN {_mid('rb')} ELSE {_mid('pb')} END AS mean FROM b)"""

_WORDS = "list_filter(string_split_regex(trim(name_, ' '), " + _q(_SPACE + "+") + "), lambda w: w <> '')"

ORACLE: dict[str, str] = {
    "scan_union_canonical": "SELECT org_name AS business_name, industry AS category, org_address AS address, org_phone AS phone_raw, org_website AS website_raw, CAST(NULL AS STRING) AS email_raw, CAST(NULL AS STRING) AS city, 'orgs' AS source_file FROM provider_orgs UNION ALL SELECT business_name, category, address, phone_raw, website_normalized, email_raw, city, 'leads' FROM cleaned_enriched",
    "clean_leads": f"""WITH rows_ AS (SELECT *, CAST(NULL AS STRING) AS region_ FROM {SRC}), {_phone('phone_raw', 'region_')},
urls_ AS (SELECT *, CASE WHEN trim(website_raw, ' ') <> '' THEN website_raw END AS u FROM p7), {_URL},
z AS (SELECT *, {_clean('address')} AS adr FROM u6), y AS (SELECT *, CASE WHEN adr <> '' THEN list_transform(string_split(adr, ','), lambda x: trim(x, ' ')) END AS parts FROM z)
SELECT source_row_id, {_suffix(_clean('business_name'))} AS business_name, {_class(_clean('category'))} AS canonical_category, {_E164} AS phone_e164, CASE WHEN some_ THEN country_ END AS phone_country, {_VALID} AS phone_valid,
CASE WHEN u IS NOT NULL THEN url_ END AS website_normalized, CASE WHEN u IS NOT NULL THEN domain_ END AS website_domain, CASE WHEN {_number('rating')} IS NOT NULL THEN greatest(0.0, least(5.0, {_number('rating')})) END AS rating_normalized,
TRY_CAST(nullif(regexp_extract(translate(reviews_count, '(),', ''), '(\\d+)', 1), '') AS INT) AS reviews_count_normalized, parts[1] AS address_street, CASE WHEN adr <> '' THEN {_postcode('adr')} END AS address_postcode,
CASE WHEN len(parts) > 2 THEN parts[len(parts) - 1] WHEN len(parts) = 2 THEN parts[2] WHEN len(parts) = 1 THEN '' END AS address_city_component, CASE WHEN len(parts) > 2 THEN parts[len(parts)] WHEN len(parts) >= 1 THEN '' END AS address_country FROM y""",
    "clean_text_collapse": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
    "rating_reviews": f"SELECT source_row_id, CASE WHEN {_number('rating')} IS NOT NULL THEN greatest(0.0, least(5.0, {_number('rating')})) END AS rating, TRY_CAST(nullif(regexp_extract(translate(reviews_count, '(),', ''), '(\\d+)', 1), '') AS INT) AS reviews, CAST(trunc(TRY_CAST(trim(rating, ' ') AS DOUBLE)) AS INT) AS whole FROM {SRC}",
    "category_classes": f"SELECT source_row_id, {_class('category')} AS class FROM cleaned_enriched",
    "category_filter": f"SELECT source_row_id FROM (SELECT source_row_id, lower(coalesce(category, '')) AS c, {_class('category')} AS k FROM cleaned_enriched) WHERE contains(c, 'bakery') OR contains(c, 'tea') OR contains(c, 'beauty') OR k = 'beauty'",
    "city_country": "SELECT source_row_id, v.country FROM cleaned_enriched l LEFT JOIN (VALUES ('roslenfeld', 'DE'), ('qualauonne', 'FR'), ('pelranwald', 'IT'), ('ostsketal', 'ES'), ('nörhumales', 'PT'), ('lunlenveen', 'NL'), ('griskeau', 'PL')) v(city, country) ON lower(l.city) = v.city",
    "name_suffix": f"SELECT source_row_id, {_suffix(_clean('business_name'))} AS name, coalesce(trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(trim(business_name, ' ')), '[,.]', '', 'g'), '-', ' ', 'g'), ' '), {_q(' (?:' + _alt(s.replace('.', '').replace('/', '').replace('à', 'a') for s in SUFFIXES) + ')$')}, ''), ' '), '') AS match_key FROM cleaned_enriched",
    "address_components": f"SELECT source_row_id, p[1] AS street, CASE WHEN address <> '' THEN {_postcode('address')} END AS postcode, CASE WHEN len(p) > 2 THEN p[len(p) - 1] WHEN len(p) = 2 THEN p[2] WHEN len(p) = 1 THEN '' END AS city, CASE WHEN len(p) > 2 THEN p[len(p)] WHEN len(p) >= 1 THEN '' END AS country FROM (SELECT *, CASE WHEN address <> '' THEN list_transform(string_split(address, ','), lambda x: trim(x, ' ')) END AS p FROM cleaned_enriched)",
    "phone_numbers": f"WITH rows_ AS (SELECT source_row_id, phone_raw, phone_country FROM cleaned_enriched), {_phone('phone_raw', 'phone_country')} SELECT source_row_id, {_E164} AS e164, CASE WHEN some_ THEN coalesce(country_, phone_country) END AS country, {_VALID} AS valid FROM p7",
    "urls_normalized": f"WITH urls_ AS (SELECT org_id, org_website AS u FROM provider_orgs WHERE org_website IS NOT NULL), {_URL} SELECT org_id, url_ AS url, domain_ AS domain, coalesce(u = '' OR regexp_matches(regexp_extract(regexp_replace(regexp_replace(lower(trim(u, ' ')), '^https?://', ''), '^www\\.', ''), '^([^/]*)', 1), {_q('(?:^|\\.)(?:' + _alt(DENYLIST) + ')$')}), true) AS denied FROM u6",
    "person_names": f"""WITH n AS (SELECT source_row_id, {_person('decision_maker_name')} AS name_ FROM cleaned_enriched),
w AS (SELECT *, {_WORDS} AS words, trim(regexp_replace(name_, {_q(_SPACE + '+')}, ' ', 'g'), ' ') AS t FROM n),
b AS (SELECT *, list_filter(list_filter(list_transform(words, lambda x: lower(regexp_replace(x, '^[.,''-]+|[.,''-]+$', '', 'g'))), lambda x: x <> ''), lambda x: x NOT IN {_in(PARTICLES)}) AS meant FROM w)
SELECT source_row_id, name_ AS name, split_part(t, ' ', 1) AS first, CASE WHEN contains(t, ' ') THEN regexp_replace(t, '^\\S+ ', '') ELSE '' END AS last,
name_ <> '' AND NOT contains(name_, '@') AND NOT contains(lower(name_), 'http') AND NOT regexp_matches(name_, '\\d') AND len(words) BETWEEN 2 AND 5 AND len(list_filter(meant, lambda x: x IN {_in(NOT_NAMES)} OR NOT regexp_matches(x, '[A-Za-z]') OR length(x) < 2)) = 0 AND len(meant) >= 2 AS is_person FROM b""",
    "mail_functions": f"""SELECT source_row_id, coalesce({_SYNTAX_OK}, false) AS valid, {_STRICT} AS strict, CASE WHEN contains(email_raw, '@') THEN split_part(lower(trim(email_raw, ' ')), '@', -1) ELSE '' END AS domain, lower(split_part(trim(email_raw, ' '), '@', 1)) IN {_in(GENERIC_LOCAL_PARTS)} AS generic,
CASE WHEN NOT regexp_matches(l, '[._]') THEN '' WHEN f = '' THEN l ELSE replace(l, f, 'firstname') END AS pattern FROM (SELECT *, CASE WHEN contains(l, '.') THEN split_part(l, '.', 1) ELSE split_part(l, '_', 1) END AS f FROM (SELECT *, split_part(lower(trim(email_raw, ' ')), '@', 1) AS l FROM cleaned_enriched WHERE email_raw IS NOT NULL))""",
    "likely_mails": f"""SELECT source_row_id, CASE WHEN regexp_matches(d, '\\.[a-zA-Z]{{2,}}$') THEN array_to_string(list_sort(list_distinct(list_filter(list_transform(CASE WHEN own <> '' THEN list_prepend(own, {_list(MAILBOXES)}) ELSE {_list(MAILBOXES)} END, lambda b: b || '@' || d), lambda e: regexp_matches(e, {_q(SYNTAX)})))), ' ') ELSE '' END AS mails
FROM (SELECT source_row_id, lower(trim(website_domain, ' ')) AS d, substr(regexp_replace(lower(coalesce(business_name, '')), '[^a-z0-9]', '', 'g'), 1, 20) AS own FROM cleaned_enriched WHERE website_domain IS NOT NULL)""",
    "mails_in_texts": f"""SELECT doc_id, coalesce(string_agg(e, ' ' ORDER BY i), '') AS mails FROM (SELECT doc_id, e, min(i) AS i FROM (SELECT doc_id, unnest(list_transform(l, lambda x: lower(x))) AS e, unnest(range(len(l))) AS i FROM (SELECT doc_id, regexp_extract_all(concat_ws(' ', text, 'write to Sales@' || website_domain, 'or no-reply@x.example'), {_q(INSIDE)}) AS l FROM documents)) WHERE regexp_matches(e, {_q(SYNTAX)}) AND NOT regexp_matches(e, {_q('^(?:' + _alt(NO_REPLY) + ')')}) AND NOT contains(e, 'domain.com') GROUP BY doc_id, e) RIGHT JOIN documents USING (doc_id) GROUP BY doc_id""",
    "dedupe_exact": f"WITH RECURSIVE {_REACH} SELECT id AS source_row_id, component FROM comps",
    "dedupe_collapse": f"""WITH RECURSIVE {_REACH},
m AS (SELECT c.component, u.source_row_id, {_points().replace('website_raw', 'website_normalized').replace('google_maps_url', "'x'").replace('CAST(rating AS', 'CAST(rating_normalized AS').replace('CAST(reviews_count AS', 'CAST(reviews_count_normalized AS')}
  + 20 * CAST(coalesce(website_normalized <> '', false) AS INT) + 15 * CAST(coalesce(phone_valid, false) AS INT) + least(coalesce(reviews_count_normalized, 0) / 10.0, 50.0) + 10 * CAST(coalesce(rating_normalized >= 4, false) AS INT) AS merit FROM usable u JOIN comps c ON u.source_row_id = c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY merit DESC, source_row_id) AS k, CAST(count(*) OVER (PARTITION BY component) AS INT) AS n FROM m),
g AS (SELECT component, CAST(row_number() OVER (ORDER BY component) AS INT) AS gid FROM (SELECT DISTINCT component FROM r WHERE n > 1))
SELECT source_row_id, g.gid AS duplicate_group_id, n AS duplicate_count FROM r LEFT JOIN g USING (component) WHERE k = 1""",
    "completeness_scores": f"SELECT source_row_id, {_points()} AS points FROM {SRC}",
    "cache_latest": f"WITH {_LATEST} SELECT key, status, created_at FROM latest",
    "cache_keys": f"WITH {_CACHE} SELECT key, md5(domain || ':' || provider) AS made FROM c",
    "cache_lookup": f"WITH {_LATEST}, f AS (SELECT domain AS d, any_value(status) AS cached_status FROM latest WHERE provider = 'provider_a' AND {_LIVE.format(now=NOW, days=3650)} GROUP BY 1) SELECT source_row_id, cached_status FROM cleaned_enriched LEFT JOIN f ON website_domain = d",
    "cache_skip": f"WITH {_LATEST} SELECT source_row_id FROM cleaned_enriched WHERE website_domain <> '' AND website_domain NOT IN (SELECT domain FROM latest WHERE domain IS NOT NULL AND provider = 'provider_a' AND {_LIVE.format(now=NOW, days=3650)})",
    "cache_upsert": f"WITH {_LATEST}, fresh AS (SELECT DISTINCT md5(domain || ':' || provider) AS key FROM c WHERE status = 'failed') SELECT key, status, expires_at FROM latest WHERE key NOT IN (SELECT key FROM fresh) UNION ALL SELECT key, 'success', TIMESTAMP '{NOW}' + INTERVAL {TTL['success']} DAY FROM fresh",
    "cache_stats": f"WITH {_CACHE} SELECT count(*) AS total, count(DISTINCT domain) AS domains, count(DISTINCT provider) AS providers, {', '.join(f'''count_if(status = '{s}') AS {s}''' for s in TTL)}, count_if(expires_at <= TIMESTAMP '{NOW}') AS expired FROM c",
    "cache_cleanup": f"WITH {_CACHE} SELECT key, status, created_at FROM c WHERE (expires_at IS NULL OR expires_at > TIMESTAMP '{NOW}') AND coalesce(status <> 'failed', true)",
    "cache_failures": f"WITH {_LATEST} SELECT domain, provider FROM latest WHERE status = 'failed' AND {_LIVE.format(now=NOW, days=30)}",
    "verify_mails": f"WITH {_VERIFY} SELECT source_row_id, verification_status, verification_confidence FROM s",
    "verify_counts": f"WITH {_VERIFY} SELECT verification_status, count(*) AS n FROM s GROUP BY 1",
    "mail_preference": "SELECT * FROM (VALUES ('a', 'a.x,b.x,c.x'), ('b', 'd.x,c.x'), ('c', '')) AS t(domain, hosts)",
    "verify_mailboxes": f"""WITH {_MAILBOXES} SELECT source_row_id, smtp_status,
CASE WHEN e = '' THEN 'unverified' WHEN NOT good OR has_mx = false THEN 'invalid' WHEN smtp_status = 'verified' THEN 'verified' WHEN smtp_status = 'bounced' THEN 'invalid' ELSE 'likely_valid' END AS verification_status,
CASE WHEN e = '' THEN 'low' WHEN NOT good OR has_mx = false THEN 'high' WHEN smtp_status IN ('verified', 'bounced') THEN 'high' WHEN smtp_status = 'catch_all' THEN 'low' ELSE 'medium' END AS verification_confidence FROM w""",
    "mail_hosts": "SELECT domain, array_to_string(hosts, ',') AS hosts FROM mx_lookup",
    "page_language": f"""WITH {_PAGES}, f AS (SELECT doc_id, regexp_extract(html, '(?is)<html\\b[^>]*?\\blang\\s*=\\s*["'']?([A-Za-z-]+)', 1) AS l, lower({_FLAT}) AS t FROM pages_)
SELECT doc_id, CASE WHEN length(split_part(upper(l), '-', 1)) = 2 THEN split_part(upper(l), '-', 1) {' '.join(f"WHEN len(list_filter({_list(ws)}, lambda w: contains(t, w))) >= 2 THEN {_q(k)}" for k, ws in LANGUAGE_WORDS.items())} WHEN length(regexp_replace(t, '[^äöüß]', '', 'g')) > 10 THEN 'DE' END AS language FROM f""",
    "page_title": "SELECT doc_id, coalesce(website_domain, '?') || ' & more' AS title, 'https://www.linkedin.com/company/x' AS linkedin FROM documents",
    "page_age": f"""WITH {_PAGES}, f AS (SELECT doc_id, {_FLAT} AS t FROM pages_), y AS (SELECT doc_id, list_filter(list_transform(flatten([{', '.join(f"regexp_extract_all(t, {_q('(?i)' + p + '(\\d{4})')}, 1)" for p in FOUNDED)}, regexp_extract_all(t, '(?i)Od\\s+(\\d{{4}})\\s+roku', 1)]), lambda x: TRY_CAST(x AS INT)), lambda x: x BETWEEN 1900 AND {YEAR}) AS ys FROM f)
SELECT doc_id, CASE WHEN len(ys) > 0 THEN greatest(1, {YEAR} - list_min(ys)) END AS age FROM y""",
    "keyword_signals": f"SELECT doc_id, array_to_string(list_filter({_list(sorted(INGREDIENTS))}, lambda w: contains(lower(coalesce(text, '')), w))[1:5], ',') AS signals FROM documents",
    "size_estimates": f"""WITH {_SIZE} SELECT source_row_id, {_bucket('mean')} AS company_size_bucket, CASE WHEN rb IS NULL AND pb IS NULL THEN NULL WHEN rb IS NOT NULL AND pb IS NOT NULL THEN 'medium' ELSE 'low' END AS company_size_confidence,
CASE WHEN rb IS NOT NULL THEN 'review_count' WHEN pb IS NOT NULL THEN 'category_prior' END AS company_size_source, CASE WHEN rb IS NULL AND pb IS NULL THEN NULL ELSE concat_ws('; ', CASE WHEN rb IS NOT NULL THEN 'review_count:' || CAST(n AS STRING) || '_reviews' END, CASE WHEN pb IS NOT NULL THEN 'category_prior:' || pk || '→' || pb END) END AS company_size_evidence FROM d""",
    "employee_counts": f"SELECT source_row_id, n, {_bucket('n')} AS bucket FROM (SELECT source_row_id, {_COUNT} AS n FROM cleaned_enriched)",
    "slim_export": f"""WITH n AS (SELECT *, {_person(f"coalesce({_filled('decision_maker_name')}, '')")} AS name_ FROM cleaned_enriched),
w AS (SELECT *, {_WORDS} AS words, trim(regexp_replace(name_, {_q(_SPACE + '+')}, ' ', 'g'), ' ') AS t FROM n),
b AS (SELECT *, list_filter(list_filter(list_transform(words, lambda x: lower(regexp_replace(x, '^[.,''-]+|[.,''-]+$', '', 'g'))), lambda x: x <> ''), lambda x: x NOT IN {_in(PARTICLES)}) AS meant FROM w),
o AS (SELECT *, name_ <> '' AND NOT contains(name_, '@') AND NOT contains(lower(name_), 'http') AND NOT regexp_matches(name_, '\\d') AND len(words) BETWEEN 2 AND 5 AND len(list_filter(meant, lambda x: x IN {_in(NOT_NAMES)} OR NOT regexp_matches(x, '[A-Za-z]') OR length(x) < 2)) = 0 AND len(meant) >= 2 AS ok, split_part(lower(trim(email_raw, ' ')), ',', 1) AS mail_ FROM b)
SELECT coalesce({_filled('business_name')}, '') AS "companyName", CASE WHEN coalesce(regexp_matches(trim(mail_, ' '), {_q(SYNTAX)}), false) THEN mail_ ELSE '' END AS email, coalesce({_filled('website_normalized')}, {_filled('website_domain')}, '') AS website, coalesce({_filled('phone_e164')}, {_filled('phone_raw')}, '') AS phone,
CASE WHEN ok THEN split_part(t, ' ', 1) ELSE '' END AS "firstName", CASE WHEN ok AND contains(t, ' ') THEN regexp_replace(t, '^\\S+ ', '') ELSE '' END AS "lastName", coalesce({_filled('address')}, {_filled('city')}, '') AS location, coalesce({_filled('rating_normalized')}, '') AS rating, coalesce(CAST(reviews_count_normalized AS STRING), '') AS "reviewsCount", '' AS "jobTitle", '' AS department FROM o""",
    "search_queries": f"""SELECT business_name, category, city, website_domain, phone_e164 AS phone, {', '.join(f"{_q(t.split('{0}')[0])} || nm || {_q(t.split('{0}')[1])} AS {k}" for k, t in SEARCHES.items())}, CASE WHEN city <> '' THEN '"' || nm || '" "' || city || '"' END AS company_location, CASE WHEN category <> '' THEN '"' || nm || '" ' || category END AS company_industry
FROM (SELECT *, regexp_replace(trim(business_name, ' '), '^"+|"+$', '', 'g') AS nm FROM cleaned_enriched WHERE business_name IS NOT NULL AND business_name <> '')""",
    "report_totals": "SELECT count(*) AS total, CAST(coalesce(sum(duplicate_count), 0) AS BIGINT) AS records, CAST(coalesce(sum(duplicate_count), 0) - count(*) AS BIGINT) AS collapsed FROM cleaned_enriched",
    "report_histogram": "SELECT CAST(bin AS INT) AS bin, low, high, count(l.source_row_id) AS n FROM (VALUES (0, 0, 40), (1, 40, 60), (2, 60, 80), (3, 80, 100)) v(bin, low, high) LEFT JOIN cleaned_enriched l ON l.lead_quality_score > low AND l.lead_quality_score <= high GROUP BY ALL",
    "report_shares": "SELECT enrichment_status AS value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percent FROM cleaned_enriched GROUP BY 1",
    "report_fill": "WITH f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count_if({c} IS NOT NULL" + ("" if c in ("rating_normalized", "reviews_count_normalized") else f" AND trim({c}, ' ') <> ''") + ") AS n, count(*) AS a FROM cleaned_enriched" for c in ("business_name", "category", "address", "phone_e164", "website_domain", "email_raw", "rating_normalized", "reviews_count_normalized", "decision_maker_name", "website_language")) + ') SELECT "column", n, round(100.0 * n / greatest(a, 1), 1) AS percent FROM f',
    "report_top_cities": "SELECT city AS value, count(*) AS n FROM cleaned_enriched WHERE trim(city, ' ') <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
    "report_top_rows": "SELECT source_row_id, lead_quality_score FROM cleaned_enriched WHERE lead_quality_score >= 70 ORDER BY lead_quality_score DESC, source_row_id LIMIT 20",
    "report_decision_makers": "SELECT count_if(y) AS found, " + ", ".join(f"count_if(y AND decision_maker_confidence = '{c}') AS {c}" for c in ("high", "medium", "low")) + " FROM (SELECT *, coalesce(trim(decision_maker_name, ' ') <> '', false) AS y FROM cleaned_enriched)",
    "report_sizes": f"SELECT CAST(ord AS INT) AS ord, bucket, count(b) AS n FROM (VALUES (0, '1'), (1, '2-5'), (2, '6-20'), (3, '21-50'), (4, '51-200'), (5, '200+')) v(ord, bucket) LEFT JOIN (SELECT {_bucket('n')} AS b FROM (SELECT {_COUNT} AS n FROM cleaned_enriched)) ON b = bucket GROUP BY ALL",
}
