"""Check SQL: what each registered query must return, written for DuckDB."""

from __future__ import annotations

import re

from pressgauge import constants as C
from testbed.queries import PROSE_THEMES
from testbed.shared import with_clause
from testbed.tables import GIVEN

SPACE = "[\\t\\n\\x0B\\f\\r \\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"
HOST = r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^\s/:?#<>^|%@]+)(?:[/:?#]|$)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def html_text(x: str) -> str:
    for tag in ("script", "style"):
        x = f"regexp_replace({x}, '<{tag}[^>]*>[\\s\\S]*?</{tag}>', '', 'gi')"
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for entity, char in (("nbsp", " "), ("amp", "&"), ("lt", "<"), ("gt", ">")):
        x = f"replace({x}, '&{entity};', '{char}')"
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def host(x: str) -> str:
    return f"regexp_replace(lower(nullif(regexp_extract({x}, '{HOST}', 1), '')), '^www\\.', '')"


def domain_key(x: str) -> str:
    x = f"regexp_replace(nullif({x}, ''), '^https?://', '', 'i')"
    x = f"regexp_replace({x}, '^www\\.', '', 'i')"
    return f"trim(lower(regexp_replace({x}, '/.*$', '')))"


def language(x: str) -> str:
    sample = f"lower(substr({x}, 1, 500))"
    score = lambda cues: " + ".join(f"cast(contains({sample}, {quoted(c)}) as int)" for c in cues)
    arms = " ".join(f"when {score(cues)} >= {need} then '{code}'" for code, cues, need in C.LANGUAGE_CUES)
    return f"case {arms} else 'en' end"


def canonical(x: str, vocabulary) -> str:
    arms = " ".join(f"when {quoted(v.lower())} then {quoted(v)}" for v in vocabulary)
    return f"case trim(lower({x})) {arms} else nullif({x}, '') end"


def credibility(bias: str, fact: str) -> str:
    return (
        f"case when {bias} in ('Conspiracy-Pseudoscience', 'Extreme Right', 'Extreme Left') then 'DISPUTED' "
        f"when {fact} in ('Very Low', 'Low') then 'LOW' when {fact} in ('Very High', 'High') then 'HIGH' else 'MIXED' end"
    )


SCOPE = "scan_status = 'success' and in_distribution = true"
AVG = "cast(round(avg({0})) as int)"
DIM = f"(select *, {credibility('mbfc_bias', 'mbfc_factuality')} as mbfc_credibility from fx_labelled)"

FEED_RAW = """case dialect when 0 then strftime(published_at, '%a, %d %b %Y %H:%M:%S GMT')
   when 1 then strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') end"""
TOP_ITEMS = f"""select i.*, f.feed_url, f.name, f.domain, f.country, f.media_class, f.topic_class, {FEED_RAW} as published_raw
  from fx_feed_items i join fx_feeds f on f.ordinal = i.ordinal where i.pos <= 3 and i.url <> ''"""

DISCOVERY = f"select *, {host('url')} as article_domain from fx_discovery where {host('url')} is not null"

RECORDS = """select cast(floor(item_no / 50) as bigint) as payload_no,
  cast(row_number() over (partition by floor(item_no / 50) order by item_no) - 1 as int) as pos,
  source_url_normalized, url, domain, bias, factual_reporting, country from fx_corpus"""
NORM = f"""select *, {credibility('mbfc_bias', 'mbfc_factuality')} as mbfc_credibility, 'mbfc' as source from (
  select payload_no, pos, {domain_key("coalesce(nullif(source_url_normalized, ''), nullif(url, ''), domain)")} as domain,
    {canonical('bias', C.BIAS_LABELS)} as mbfc_bias,
    {canonical('factual_reporting', C.FACTUALITY_LABELS)} as mbfc_factuality,
    nullif(country, '') as mbfc_country from ({RECORDS}) r) n where domain <> ''"""
DEDUP = f"""select domain, mbfc_bias, mbfc_factuality, mbfc_country, mbfc_credibility, source from (
  select *, row_number() over (partition by domain order by payload_no, pos) as rn from ({NORM}) n) q where rn = 1"""
UPSERT = f"""select * from ({DEDUP}) a union all
  select * from fx_old_dimension where domain not in (select domain from ({DEDUP}) b)"""

WHY = """case when not broken then null when fault = 0 then 'response is not JSON' when fault = 1 then 'response is null'
   else 'spi_score is not an integer' end"""

FIRST = """select * from (select *, row_number() over (partition by content_hash
  order by fetched_at, phase, feed_ordinal, item_pos) as rn from fx_candidates) q where rn = 1"""
KNOWN = """select content_hash, case when min(r) = 1 then 'queued' else 'scanned' end as reason from (
  select content_hash, 1 as r from fx_known_queue union all select content_hash, 2 from fx_known_scans) k group by content_hash"""

AD_KEPT = """select * from (select *, trim(text) as t from fx_ad_nodes) n
  where length(t) > 20 and not regexp_matches(t, '^\\d+:\\d+') and not contains(t, 'Sponsored')"""
AD_CARDS = f"""select k.fetched_at, k.term, k.country, k.container_pos, k.ad_text,
    case when trim(coalesce(a.advertiser_name, '')) = '' then 'Unknown Advertiser' else trim(a.advertiser_name) end as advertiser_name
  from (select fetched_at, term, country, container_pos, string_agg(t, ' ' order by node_pos) as ad_text from ({AD_KEPT}) k
        group by fetched_at, term, country, container_pos) k
  join (select fetched_at, term, country, container_pos, max(advertiser_name) as advertiser_name from fx_ad_nodes
        group by fetched_at, term, country, container_pos) a
    on a.fetched_at = k.fetched_at and a.term = k.term and a.country = k.country and a.container_pos = k.container_pos
  where length(k.ad_text) >= 50"""
AD_TEXTS = f"""select fetched_at, term, country, container_pos, ad_text, advertiser_name from (
  select *, row_number() over (partition by fetched_at, term, country order by container_pos) as rn from ({AD_CARDS}) c) q where rn <= 5"""
AD_FALLBACK = f"""select fetched_at, term, country, container_pos, ad_text, 'Unknown Advertiser' as advertiser_name from (
  select *, row_number() over (partition by fetched_at, term, country order by container_pos) as rn from (
    select fetched_at, term, country, container_pos, regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g') as ad_text
    from fx_ad_blocks b where not exists (select 1 from ({AD_TEXTS}) p where p.fetched_at = b.fetched_at and p.term = b.term and p.country = b.country)) f
  where length(ad_text) >= 50 and not contains(ad_text, 'Log in') and not contains(ad_text, 'Facebook')) q where rn <= 5"""
ADS_TOPK = f"""select fetched_at, term, country, container_pos, ad_text, advertiser_name, term_ordinal, category, country_ordinal, cast(rn as int) as term_pos from (
  select a.*, t.term_ordinal, t.category, t.country_ordinal,
    row_number() over (partition by a.fetched_at, a.term order by t.country_ordinal, a.container_pos) as rn
  from (({AD_TEXTS}) union all ({AD_FALLBACK})) a join fx_terms t on t.term = a.term and t.country = a.country) q where rn <= 5"""
AD_URL = """concat('https://www.facebook.com/ads/library/?active_status=active&ad_type=all&country=', country,
   '&q=', replace(term, ' ', '%20'), '&media_type=all')"""
AD_CANDIDATES = f"""select sha256(ad_text) as content_hash, 'facebook_ad' as source_type, {AD_URL} as feed_url,
  advertiser_name as publisher_name, regexp_replace(lower(advertiser_name), '[^a-z0-9]', '', 'g') as publisher_domain,
  case country when 'US' then 'US' else 'UK' end as region,
  case country when 'US' then 'United States' else 'United Kingdom' end as country,
  'facebook_ad' as media_class, category as topic_class, {AD_URL} as article_url, 'facebook.com' as article_domain,
  substr(ad_text, 1, 200) as headline_text, ad_text as body_text, cast(length(ad_text) as int) as content_length,
  false as truncated, 'facebook_ad_body' as content_extraction_type, 'en' as language, 'assumed' as language_confidence,
  true as in_distribution, advertiser_name, term as search_term, country as ad_country,
  fetched_at, 2 as phase, term_ordinal as feed_ordinal, term_pos as item_pos
  from ({ADS_TOPK}) a"""

FEED_CANDIDATES = f"""select 'rss_article' as source_type, feed_url, name as publisher_name, domain as publisher_domain, country,
  media_class, topic_class, url as article_url, coalesce(nullif({host('url')}, ''), domain) as article_domain,
  title as headline_text, published_raw, fetched_at, 0 as phase, ordinal as feed_ordinal, pos as item_pos from ({TOP_ITEMS}) i"""
DISCOVERY_CANDIDATES = f"""select 'gdelt_article' as source_type, cast(null as varchar) as feed_url,
  coalesce(nullif(listed_domain, ''), article_domain) as publisher_name, article_domain as publisher_domain,
  cast(null as varchar) as country, 'GDELT Discovery' as media_class, theme as topic_class, url as article_url,
  article_domain, coalesce(title, '') as headline_text, strftime(seen_at, '%Y%m%dT%H%M%SZ') as published_raw,
  1 as phase, theme_ordinal as feed_ordinal, fetched_at, pos as item_pos, seen_at as published_at from ({DISCOVERY}) d"""
ALL_FIELDS = "source_type, publisher_name, publisher_domain, country, media_class, topic_class, article_url, article_domain, headline_text, phase"

QUEUE = f"""select * exclude (rn), 'pending' as status, 'vnext_haiku_2026_03' as analyzer_version,
  'v1.0' as taxonomy_version, 'crawler_v1.0' as prompt_version from (
  select *, row_number() over (partition by content_hash order by fetched_at, phase, feed_ordinal, item_pos) as rn from (
    select c.*, sha256(p.body) as content_hash, cast(length(p.body) as int) as content_length,
      cast(p.full_length as int) as content_length_full, length(p.body) >= 8000 as truncated,
      'html_strip' as content_extraction_type, {language('p.body')} as language, 'heuristic' as language_confidence,
      {language('p.body')} = 'en' as in_distribution, c.fetched_at as queued_at
    from (
      select * exclude (published_raw, published_at), published_at from (
        select *, try_strptime(published_raw, ['%a, %d %b %Y %H:%M:%S GMT', '%Y-%m-%dT%H:%M:%SZ']) as published_at
        from ({FEED_CANDIDATES}) f)
      union all by name
      select * exclude (published_raw) from ({DISCOVERY_CANDIDATES}) d) c
    join (select url, substr(full_text, 1, 8000) as body, length(full_text) as full_length from (
        select url, {html_text('html')} as full_text from fx_pages) t) p on p.url = c.article_url
    where length(p.body) >= 200
    union all by name select * exclude (body_text) from ({AD_CANDIDATES}) a) r) q
  where rn = 1 and content_hash not in (select content_hash from ({KNOWN}) k)"""

TACTIC_ROWS = """select content_hash as scan_id,
    cast(row_number() over (partition by content_hash order by event_id) - 1 as int) as tactic_pos, *
  from fx_tactic_objects"""
ROWS_V2 = f"""select scan_id, tactic_pos, o_code as tactic_code, coalesce(o_label, o_name) as tactic_label,
  o_severity as severity, coalesce(o_evidence, o_excerpt) as evidence_excerpt, taxonomy_version from ({TACTIC_ROWS}) t"""
VECTOR_CODE = "coalesce(o_name, o_tactic_code, 'unknown')"
VECTOR = f"""select content_hash, string_agg({VECTOR_CODE} || ':' ||
    case o_severity when 'critical' then 3 when 'warning' then 2 else 1 end, '|' order by event_id) as vector,
    count(*) as n from fx_tactic_objects group by content_hash"""
CURRENT = """select q.*, coalesce(l.last_status, q.status) as now_status from fx_queue q left join (
    select item_id, max_by(status, seq) as last_status from fx_status_events group by item_id) l on l.item_id = q.item_id"""

DOMAIN_WEEKLY = f"""select publisher_domain, publisher_name, media_class, region, country,
  date_trunc('week', scanned_at) as week, taxonomy_version, {AVG.format('spi_score')} as avg_spi,
  count(*) as scan_count, min(spi_score) as min_spi, max(spi_score) as max_spi
  from fx_scans where spi_score is not null and {SCOPE}
  group by publisher_domain, publisher_name, media_class, region, country, date_trunc('week', scanned_at), taxonomy_version"""
SCOPED_TACTICS = f"""select t.*, s.region, s.media_class, s.publisher_name, s.scanned_at, s.spi_score
  from fx_tactics t join fx_scans s on s.scan_id = t.scan_id where {SCOPE}"""
STATUS = """select item_id, max_by(status, seq) as status, max_by(processed_at, seq) as processed_at,
  arg_max_null(error_message, seq) as error_message, max(seq) as seq from {0} group by item_id"""

STORIES = """t as (select text, min(doc_id) as id from documents group by text),
        w as (select id, string_split_regex(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ') as w from t where trim(text) <> ''),
        g as (select distinct id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as gram from w),
        n as (select id, count(*) as n from g group by id),
        c as (select a.id as a, b.id as b, count(*) as c from g a join g b on a.gram = b.gram and a.id <> b.id group by all),
        l as (select a, b from c join n x on x.id = a join n y on y.id = b where c >= (x.n + y.n - c) * 0.8::double),
        r(id, other) as (select id, id from t union select r.id, l.b from r join l on l.a = r.other),
        p as (select id, min(other) as cluster_id from r group by id),"""
LINKS = f"""select distinct source, target from (
  select {host('url')} as source, {host('link')} as target from (
    select url, unnest(regexp_extract_all(html, 'href=["''](https?://[^"''\\s>]+)', 1)) as link from fx_linked_pages) l) x
  where source <> target"""
RINGS = f"""e as ({LINKS}),
  r(a, b) as (select source, target from e union select r.a, e.target from r join e on e.source = r.b),
  g as (select x.a as domain, least(x.a, min(x.b)) as ring from r x join r y on x.a = y.b and x.b = y.a group by x.a)"""
TACTIC_WEEKLY = f"""select tactic_code, tactic_label, date_trunc('week', scanned_at) as week, region, media_class,
        taxonomy_version, count(*) as occurrences, {AVG.format('spi_score')} as avg_spi_when_present
        from ({SCOPED_TACTICS}) t group by 1, 2, 3, 4, 5, 6"""
EVENTS = f"""select content_hash, 1 as step, 'processing' as status, cast(null as varchar) as error_message from fx_response_parts
        union all select content_hash, 2, case when broken then 'error' else 'done' end,
          {WHY} from fx_response_parts"""
SCANS_OUT = f"""select f.content_hash, f.content_hash as scan_id, f.source_type, f.publisher_name,
        f.article_domain as publisher_domain, case f.source_type when 'facebook_ad' then 'facebook.com' else f.article_domain end as article_domain,
        'v1.0' as taxonomy_version,
        case f.source_type when 'facebook_ad' then f.publisher_name end as advertiser_name,
        case f.source_type when 'facebook_ad' then 'term' end as search_term,
        case f.source_type when 'facebook_ad' then 'US' end as ad_country,
        p.spi_score, p.the_play, p.emotional_targets, p.blind_spots, p.the_verdict,
        d.mbfc_bias, d.mbfc_factuality, d.mbfc_credibility,
        case f.source_type when 'facebook_ad' then 'facebook_ad_scraper' else 'crawler' end as scan_source,
        f.source_type = 'gdelt_article' as gdelt_source,
        case f.source_type when 'facebook_ad' then 'copy_only' end as analysis_scope,
        'success' as scan_status, cast(null as double) as gdelt_tone, cast(v.n as int) as n_vector,
        f.source_type as media_class, 'US' as region, 'US' as country, true as in_distribution,
        f.fetched_at + interval 1 hour as scanned_at
        from ({FIRST}) f join fx_response_parts p on p.content_hash = f.content_hash
        left join {DIM} d on d.domain = f.article_domain
        left join ({VECTOR}) v on v.content_hash = f.content_hash where not p.broken"""

SQL: dict[str, str] = {
    "feed_items": f"""select f.feed_url, i.fetched_at, i.pos, i.title, i.url, {FEED_RAW} as published_raw,
        case when i.dialect < 2 then i.published_at end as published_at
        from fx_feed_items i join fx_feeds f on f.ordinal = i.ordinal""",
    "feed_items_topn": f"select feed_url, fetched_at, pos, title, url, published_raw from ({TOP_ITEMS}) t",
    "discovery_items": f"""select theme_ordinal, theme, fetched_at, pos, url, listed_domain, title,
        strftime(seen_at, '%Y%m%dT%H%M%SZ') as seendate, source_language, article_domain,
        case when source_language = 'Russian' then 'RU' end as country,
        case when tone_kind = 0 then tone end as gdelt_tone from ({DISCOVERY}) d""",
    "discovery_candidates": DISCOVERY_CANDIDATES,
    "discovery_topk": f"""select theme, fetched_at, pos, url, article_domain from (
        select *, row_number() over (partition by theme, fetched_at order by pos) as rn from ({DISCOVERY}) d) q where rn <= 5""",
    "enrichment_raw": RECORDS,
    "enrichment_norm": NORM,
    "enrichment_dedup": DEDUP,
    "response_fields": f"""select p.content_hash, p.taxonomy_version, p.spi_score, p.the_play, p.emotional_targets,
        p.blind_spots, p.the_verdict,
        case when p.broken or p.shape in ('missing', 'scalar') then null else coalesce(cast(t.n as int), 0) end as n_tactics,
        {WHY} as error_message
        from fx_response_parts p left join (select content_hash, count(*) as n from fx_response_tactics group by 1) t
          on t.content_hash = p.content_hash""",
    "search_term_grid": """select t.term_ordinal, t.term, t.category, t.country_ordinal, t.country, count(n.node_pos) as nodes
        from fx_terms t left join fx_ad_nodes n on n.term = t.term and n.country = t.country group by 1, 2, 3, 4, 5""",
    "feed_slice": """select f.ordinal as feed_ordinal, f.name as publisher_name, count(*) as items,
        case when f.ordinal <= 9 then 'A' else 'B' end as batch
        from fx_feed_items i join fx_feeds f on f.ordinal = i.ordinal group by 1, 2, 4""",
    "articles_with_feed": FEED_CANDIDATES,
    "collect_run_later": f"select source_type, article_url, feed_ordinal, item_pos, fetched_at from ({FEED_CANDIDATES}) f",
    "html_to_text": f"""select page_id, substr(t, 1, 8000) as body_text, cast(length(t) as int) as content_length_full
        from (select page_id, {html_text('html')} as t from pages) p""",
    "content_hash": "select doc_id, sha256(text) as content_hash from documents",
    "detect_language": f"""select doc_id, lang, 'heuristic' as confidence, lang = 'en' as in_distribution from (
        select doc_id, {language('text')} as lang from documents) d""",
    "truncation": """select doc_id, cast(least(length(text), 8000) as int) as content_length,
        length(text) >= 8000 as truncated from documents""",
    "content_min_length": "select doc_id, cast(length(text) as int) as content_length from documents where length(text) >= 200",
    "extract_domain": f"select page_id, {host('url')} as domain from fx_urls",
    "normalise_domain": f"""select page_id, {domain_key('url')} as domain,
        lower(regexp_replace(url, '^www\\.', '', 'i')) as lookup_key from fx_urls""",
    "normalise_bias": f"select item_no, {canonical('bias', C.BIAS_LABELS)} as mbfc_bias from fx_corpus",
    "normalise_factuality": f"""select item_no, {canonical('factual_reporting', C.FACTUALITY_LABELS)} as mbfc_factuality
        from fx_corpus""",
    "derive_credibility": f"select domain, {credibility('mbfc_bias', 'mbfc_factuality')} as mbfc_credibility from fx_labelled",
    "coalesce_falsy": """select item_no, case when source_url_normalized <> '' then source_url_normalized
        when url <> '' then url else domain end as chosen from fx_corpus""",
    "coalesce_nullish": """select item_no, case when source_url_normalized is not null then source_url_normalized
        when url is not null then url else domain end as chosen from fx_corpus""",
    "parse_published": """select doc_id, case when form < 4 then published_at end as published_at, form = 4 as published_bad
        from fx_dates""",
    "recent_items": """select event_id, ts from events where ts >= (select max(ts) from events) - interval 1 day""",
    "dedup_first_wins": f"select * exclude (rn, fetched_at) from ({FIRST}) f",
    "new_candidates": f"""select item_pos, source_type, content_hash from fx_candidates
        where content_hash not in (select content_hash from ({KNOWN}) k)""",
    "skip_reasons": f"""select c.item_pos, c.source_type, k.reason from fx_candidates c
        join ({KNOWN}) k on k.content_hash = c.content_hash""",
    "new_candidates_v1": """select item_pos, source_type, content_hash from fx_candidates
        where content_hash not in (select content_hash from fx_known_scans)""",
    "run_summary": f"""select source_type, outcome, skip_reason, count(*) as items from (
        select c.source_type, case when k.reason is null and c.rn = 1 then 'queued' else 'skipped' end as outcome,
          case when k.reason is null and c.rn = 1 then null else coalesce(k.reason, 'queued') end as skip_reason
        from (select *, row_number() over (partition by content_hash
                order by fetched_at, phase, feed_ordinal, item_pos) as rn from fx_candidates) c
        left join ({KNOWN}) k on k.content_hash = c.content_hash) o group by 1, 2, 3""",
    "theme_matches": " union all ".join(
        f"select doc_id, {quoted(theme)} as theme from documents where ("
        + " or ".join(f"contains(lower(text), {quoted(p.lower())})" for p in phrases)
        + ")"
        + (f" and contains(lower(text), {quoted(word.lower())})" if word else "")
        for theme, phrases, word in PROSE_THEMES + C.THEMES
    ),
    "scan_provenance": """select content_hash, source_type, item_pos, publisher_name,
        case source_type when 'facebook_ad' then 'facebook.com' else article_domain end as article_domain,
        case source_type when 'facebook_ad' then 'facebook_ad_scraper' else 'crawler' end as scan_source,
        source_type = 'gdelt_article' as gdelt_source,
        case source_type when 'facebook_ad' then 'copy_only' end as analysis_scope,
        case source_type when 'facebook_ad' then publisher_name end as advertiser_name,
        case source_type when 'facebook_ad' then 'term' end as search_term,
        case source_type when 'facebook_ad' then 'US' end as ad_country from fx_candidates""",
    "ad_texts": AD_TEXTS,
    "ad_cards_read": AD_TEXTS,
    "ad_fallback": AD_FALLBACK,
    "page_ads": f"({AD_TEXTS}) union all ({AD_FALLBACK})",
    "ads_topk": ADS_TOPK,
    "ad_candidates": AD_CANDIDATES,
    "all_candidates": f"""select {ALL_FIELDS}, cast(null as varchar) as region, cast(null as varchar) as search_term
          from ({FEED_CANDIDATES}) f
        union all select {ALL_FIELDS}, null, null from ({DISCOVERY_CANDIDATES}) d
        union all select {ALL_FIELDS}, region, search_term from ({AD_CANDIDATES}) a""",
    "ingest_summary": f"""select source_type, outcome, skip_reason, count(*) as items from (
        select c.source_type,
          case when c.body is null then 'error' when length(c.body) < 200 then 'too_short'
               when k.reason is null and c.rn = 1 then 'queued' else 'skipped' end as outcome,
          case when c.body is null or length(c.body) < 200 or (k.reason is null and c.rn = 1) then null
               else coalesce(k.reason, 'queued') end as skip_reason
        from (select i.source_type, p.body, sha256(p.body) as content_hash,
                row_number() over (partition by p.body order by fetched_at, phase, feed_ordinal, item_pos) as rn
              from (select source_type, article_url, fetched_at, phase, feed_ordinal, item_pos from ({FEED_CANDIDATES}) f
                    union all select source_type, article_url, fetched_at, phase, feed_ordinal, item_pos
                    from ({DISCOVERY_CANDIDATES}) d) i
              left join (select url, substr({html_text('html')}, 1, 8000) as body from fx_pages) p on p.url = i.article_url) c
        left join ({KNOWN}) k on k.content_hash = c.content_hash) o group by 1, 2, 3""",
    "queue_candidates": f"select * exclude (fetched_at) from ({QUEUE}) q",
    "enrichment_upsert": UPSERT,
    "enrichment_preview": f"""select domain, mbfc_bias, mbfc_factuality, mbfc_credibility from ({UPSERT}) u
        order by domain limit 5""",
    "enrichment_count": f"select count(*) as rows from ({DEDUP}) d",
    "scans_enriched": f"""select s.*, d.mbfc_bias as de_bias, d.mbfc_factuality as de_factuality,
        d.mbfc_credibility as de_credibility from fx_scans s left join {DIM} d on d.domain = s.article_domain""",
    "credibility_lookup": f"""select s.scan_id, s.article_domain, s.publisher_domain,
        case when a.domain is not null then a.mbfc_bias else p.mbfc_bias end as mbfc_bias,
        case when a.domain is not null then a.mbfc_factuality else p.mbfc_factuality end as mbfc_factuality,
        case when a.domain is not null then a.mbfc_credibility else p.mbfc_credibility end as mbfc_credibility
        from (select scan_id, publisher_domain,
                case when doc_id % 4 = 0 then 'WWW.unknown.example' else article_domain end as article_domain from fx_scans) s
        left join {DIM} a on a.domain = lower(regexp_replace(s.article_domain, '^www\\.', '', 'i'))
        left join {DIM} p on p.domain = lower(regexp_replace(s.publisher_domain, '^www\\.', '', 'i'))""",
    "credibility_lookup_exact": f"""select s.scan_id, s.article_domain, d.mbfc_bias, d.mbfc_factuality, d.mbfc_credibility
        from fx_scans s left join {DIM} d on d.domain = s.article_domain""",
    "enrichment_coverage": f"""select scan_id, article_domain, spi_score from fx_scans
        where article_domain in (select domain from {DIM} d)""",
    "score_by_credibility": f"""select d.mbfc_credibility as de_credibility, count(*) as scans,
        {AVG.format('s.spi_score')} as avg_spi from fx_scans s left join {DIM} d on d.domain = s.article_domain group by 1""",
    "tactic_vector": f"""select p.content_hash, v.vector from fx_response_parts p
        left join ({VECTOR}) v on v.content_hash = p.content_hash""",
    "tactic_rows": ROWS_V2,
    "tactic_rows_v1": f"""select scan_id, tactic_pos, nullif(o_code, '') as tactic_code,
        coalesce(nullif(o_label, ''), nullif(o_name, ''), case when is_text then text_value else '<object>' end) as tactic_label,
        nullif(o_severity, '') as severity, nullif(o_evidence, '') as evidence_excerpt, '1.0' as taxonomy_version
        from ({TACTIC_ROWS}) t""",
    "code_mismatch": f"""select count(*) as tactics,
        count(*) filter ({VECTOR_CODE} is distinct from o_code) as mismatches from fx_tactic_objects""",
    "scans_out": SCANS_OUT,
    "stream_scan_rows": SCANS_OUT,
    "tactics_out": f"select * replace ('v1.0' as taxonomy_version) from ({ROWS_V2}) t",
    "canonical_scans": """select content_hash, null as article_url, article_domain, publisher_domain, null as headline_text,
          null as published_at, null as content_length, analyzer_version, taxonomy_version, prompt_version from fx_scans
        union all select content_hash, article_url, article_domain, article_domain, article_title, article_published_at,
          content_length_chars, '1.0', '1.0', '1.0' from fx_legacy_scans""",
    "analysed_weekly": f"""select f.article_domain as publisher_domain, f.publisher_name, f.source_type as media_class, 'US' as region,
        'US' as country, date_trunc('week', f.fetched_at + interval 1 hour) as week, 'v1.0' as taxonomy_version,
        {AVG.format('p.spi_score')} as avg_spi, count(*) as scan_count, min(p.spi_score) as min_spi, max(p.spi_score) as max_spi
        from ({FIRST}) f join fx_response_parts p on p.content_hash = f.content_hash
        where not p.broken and p.spi_score is not null group by 1, 2, 3, 6""",
    "analysis_events": EVENTS,
    "stream_transitions": EVENTS,
    "domain_weekly_canonical": f"""({DOMAIN_WEEKLY}) union all
        select article_domain, publisher_name, media_class, region, country, date_trunc('week', scanned_at), '1.0',
          {AVG.format('spi_score')}, count(*), min(spi_score), max(spi_score)
        from fx_legacy_scans where spi_score is not null group by 1, 2, 3, 4, 5, 6""",
    "domain_integrity_weekly": DOMAIN_WEEKLY,
    "mart_refresh": DOMAIN_WEEKLY,
    "stream_weekly": DOMAIN_WEEKLY,
    "tactic_frequency_weekly": TACTIC_WEEKLY,
    "tactic_mart_refresh": TACTIC_WEEKLY,
    "stream_tactics_weekly": TACTIC_WEEKLY,
    "daily_health": f"""select date_trunc('day', scanned_at) as day, scan_status, count(*) as scans,
        {AVG.format('spi_score')} as avg_spi, count(*) filter (in_distribution = false) as out_of_dist
        from fx_scans group by 1, 2""",
    "version_profile": f"""select analyzer_version, taxonomy_version, prompt_version, in_distribution, count(*) as scans,
        count(spi_score) as scored, {AVG.format('spi_score')} as avg_spi, min(spi_score) as min_spi, max(spi_score) as max_spi
        from fx_scans group by 1, 2, 3, 4""",
    "top_tactics_by_publisher": f"""select publisher_name, tactic_code, occurrences, cast(position as int) as position from (
        select *, row_number() over (partition by publisher_name order by occurrences desc, tactic_code asc nulls first) as position
        from (select publisher_name, tactic_code, count(*) as occurrences from ({SCOPED_TACTICS}) t group by 1, 2) c) q
        where position <= 3""",
    "tactics_by_region": f"""select region, tactic_code, occurrences,
        round(occurrences / sum(occurrences) over (partition by region), 6) as share
        from (select region, tactic_code, count(*) as occurrences from ({SCOPED_TACTICS}) t group by 1, 2) c""",
    "tactic_spi_corr": f"""select c.tactic_code, count(h.scan_id) as scans_with, count(*) as scans,
        round(corr(case when h.scan_id is null then 0 else 1 end, s.spi_score), 6) as corr_spi
        from (select distinct tactic_code from ({SCOPED_TACTICS}) t where tactic_code is not null and spi_score is not null) c
        cross join (select scan_id, spi_score from fx_scans where {SCOPE} and spi_score is not null) s
        left join (select distinct scan_id, tactic_code from fx_tactics) h
          on h.scan_id = s.scan_id and h.tactic_code = c.tactic_code group by 1""",
    "tactic_rollup": """select substr(tactic_code, 1, 1) as prefix, tactic_code, count(*) as occurrences, 0 as level
          from fx_tactics where tactic_code is not null group by 1, 2
        union all select substr(tactic_code, 1, 1), null, count(*), 1 from fx_tactics where tactic_code is not null group by 1
        union all select null, null, count(*), 3 from fx_tactics where tactic_code is not null""",
    "emerging_tactics": f"""with counts as (
          select tactic_code, date_trunc('quarter', scanned_at) as quarter, count(*) as n
          from ({SCOPED_TACTICS}) t where tactic_code is not null group by 1, 2),
        quarters as (select unnest(generate_series(
            (select min(quarter) from counts),
            (select max(date_trunc('quarter', scanned_at)) from fx_scans where {SCOPE}), interval 3 month)) as quarter),
        grid as (select f.tactic_code, f.first_quarter, q.quarter from (
            select tactic_code, min(quarter) as first_quarter from counts group by 1) f
          join quarters q on q.quarter >= f.first_quarter)
        select g.tactic_code, g.quarter, coalesce(c.n, 0) as occurrences,
          coalesce(c.n, 0) - lag(coalesce(c.n, 0)) over (partition by g.tactic_code order by g.quarter) as change,
          g.quarter = g.first_quarter as first_seen
        from grid g left join counts c on c.tactic_code = g.tactic_code and c.quarter = g.quarter""",
    "queue_status": STATUS.format("fx_status_events"),
    "stream_status": STATUS.format(
        "(select * from fx_status_events where item_id in (select item_id from fx_queue))"
    ),
    "queue_depth": f"select count(*) filter (now_status = 'pending') as pending_items from ({CURRENT}) c",
    "claim_batch": f"""select item_id, content_hash, publisher_name, now_status as status, queued_at from ({CURRENT}) c
        where now_status = 'pending' order by queued_at asc nulls last, content_hash limit 80""",
    "analysis_summary": f"""select processed, scanned, errors, round(cast(scanned as double) * 0.006::double, 3) as est_cost, still_pending from (
        select count(*) as processed, count(*) filter (now_status = 'done') as scanned,
          count(*) filter (now_status = 'error') as errors,
          (select count(*) from ({CURRENT}) a where now_status = 'pending') as still_pending
        from ({CURRENT}) c where item_id in (select item_id from fx_status_events)) t""",
    "taxonomy_patterns": """select concat('doc', cast(file_no as string)) as path, pattern_id, substr(pattern_id, 1, 1) as prefix, name,
        concat(base_text, case when enhanced_layer is null then '' else
            concat(' Enhanced by Layer ', cast(enhanced_layer as string), ': "', enhanced_name, '" - more.') end,
          case when detection is null then '' else concat(' Detection: ', detection) end) as description,
        section, subsection from fx_patterns""",
    "taxonomy_attrs": """select concat('doc', cast(file_no as string)) as path, pattern_id, detection, enhanced_layer, enhanced_name,
        case when contains(name, '(Layer') then '2/3' end as name_layer from fx_patterns""",
    "display_names": """select concat('doc', cast(file_no as string)) as path, pattern_id, display_name, enhanced, source_layer
        from fx_patterns where display_name is not null""",
    "tactic_display": """select t.scan_id, t.event_id, t.tactic_code, t.severity, t.taxonomy_version,
        coalesce(n.display_name, t.tactic_label) as shown_name from fx_tactics t left join (
          select pattern_id, min(display_name) as display_name from fx_patterns where display_name is not null group by 1) n
        on n.pattern_id = t.tactic_code""",
    "audience_routing": """select r.audience, count(*) as patterns, cast(coalesce(sum(u.n), 0) as bigint) as occurrences from (
          select audience, concat(prefix, lpad(cast(unnest(generate_series(low, high)) as string), 2, '0')) as tactic_code
          from (values """
    + ", ".join(f"('{p}', {lo}, {hi}, '{a}')" for p, lo, hi, names in C.AUDIENCE_RANGES for a in names)
    + """) as v(prefix, low, high, audience)) r
        left join (select tactic_code, count(*) as n from fx_tactics group by 1) u on u.tactic_code = r.tactic_code group by 1""",
    "unknown_codes": """select tactic_code, count(*) as rows from fx_tactics
        where tactic_code is not null and tactic_code not in (select pattern_id from fx_patterns) group by 1""",
    "orphan_tactics": f"""select scan_id, event_id, tactic_code from fx_tactics
        where scan_id not in (select scan_id from fx_scans where {SCOPE})""",
    "cascade_delete": f"""select scan_id, event_id, tactic_code from fx_tactics
        where scan_id in (select scan_id from fx_scans where {SCOPE})""",
    "constraint_report": """select 'scan_id not null' as rule, count(*) filter (scan_id is null) as violations from fx_scans
        union all select 'publisher_domain not null', count(*) filter (publisher_domain is null) from fx_scans
        union all select 'spi_score not null', count(*) filter (spi_score is null) from fx_scans
        union all select 'region not null', count(*) filter (region is null) from fx_scans
        union all select 'in_distribution not null', count(*) filter (in_distribution is null) from fx_scans
        union all select 'scan_status accepted', count(*) filter (scan_status not in
          ('success', 'skipped', 'feed_error', 'analysis_error')) from fx_scans
        union all select 'region accepted', count(*) filter (region not in ('US', 'ZA', 'INT')) from fx_scans
        union all select 'media_class accepted', count(*) filter (media_class not in ('Broadsheet', 'Tabloid')) from fx_scans
        union all select 'content_hash unique', count(*) - count(distinct content_hash) from fx_scans
        union all select 'publisher_domain unique', count(*) from (
          select publisher_domain from fx_scans group by 1 having count(*) > 1) d""",
    "stream_dedup": "select distinct content_hash from fx_candidates",
    "stream_scans": """select p.content_hash, p.spi_score, p.the_verdict, coalesce(t.n, 0) as tactics
        from fx_response_parts p left join (select content_hash, count(*) as n from fx_response_tactics group by 1) t
          on t.content_hash = p.content_hash where not p.broken""",
    "volume_bursts": """with c as (select event_type as grp, date_trunc('hour', ts) as hour, count(*) as n from {events} group by 1, 2),
        g as (select grp, unnest(generate_series(min(hour), max(hour), interval 1 hour)) as hour from c group by grp),
        f as (select g.grp, g.hour, coalesce(c.n, 0) as n from g left join c on c.grp = g.grp and c.hour = g.hour),
        q as (select *, count(*) over w as seen, avg(n) over w as mean, stddev_pop(n) over w as spread from f
          window w as (partition by grp order by hour rows between 24 preceding and 1 preceding))
        select grp, hour, n, z from (select *, round((n - mean) / spread, 6) as z from q where seen >= 3 and spread > 0 and n > 0) t where z >= 2.0""",
    "citation_cycles": f"""with e as (select distinct source, target from (
          select {host('url')} as source, {host('link')} as target from (
            select url, unnest(regexp_extract_all(html, 'href=["''](https?://[^"''\\s>]+)', 1)) as link from fx_linked_pages) l) x
        where source <> target)
        select a.source as first, a.target as second from e a join e b on a.source = b.target and a.target = b.source
        where a.source < a.target""",
    "provenance_void": """select page_id, has_author, has_date, has_canonical, not (has_author or has_date or has_canonical) as void from (
        select page_id, regexp_matches(lower(html), '(name|property|itemprop|rel)=["\'\'](article:)?author["\'\']') as has_author,
          regexp_matches(lower(html), '<time[\\s>]|(property|itemprop)=["\'\'](article:published_time|datepublished)["\'\']') as has_date,
          regexp_matches(lower(html), 'rel=["\'\']canonical["\'\']') as has_canonical from {pages}) p""",
    "template_share": """with l as (select distinct doc_id, trim(line, ' ') as line from (
          select doc_id, unnest(string_split(text, chr(10))) as line from {documents}) x where trim(line, ' ') <> ''),
        c as (select line, count(*) as n from l group by line having count(*) >= 3)
        select doc_id, count(*) as lines, count(n) as templated, round(count(n) / count(*), 6) as share
        from l left join c using (line) group by doc_id""",
    "cue_hits": """select doc_id, cue, hits, round(hits * 1000 / greatest(words, 1), 6) as per_1000 from (
        select doc_id, cue, cast((length(low) - length(replace(low, lower(cue), ''))) // length(cue) as int) as hits,
          len(list_filter(regexp_split_to_array(low, '\\s+'), lambda x: x <> '')) as words
        from (select doc_id, lower(text) as low from {documents}) d,
          (values ('and the'), ('of the'), ('Que'), ('nicht')) as c(cue)) q where hits > 0""",
    "repetition_ratio": """with w as (select doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') as w from {documents}),
        g as (select doc_id, [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] as g from w)
        select doc_id, cast(len(g) as int) as grams,
          case when len(g) > 0 then round(1 - len(list_distinct(g)) / len(g), 6) else 0.0::double end as ratio from g""",
    "headline_overlap": """with t as (select doc_id,
          list_distinct(list_filter(regexp_split_to_array(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+'), lambda x: x <> '')) as h,
          list_distinct(list_filter(regexp_split_to_array(lower(substr(text, instr(text, chr(10)) + 1)), '[^a-z0-9]+'), lambda x: x <> '')) as b
          from {documents})
        select doc_id, cast(len(h) as int) as headline_words,
          case when len(h) > 0 then round(len(list_intersect(h, b)) / len(h), 6) end as overlap from t""",
    "run_counters": f"""with f as (select ordinal, run_no, run_no % 7 = 3 as bad, count(*) as n from fx_feed_items group by all),
        l as (select theme_ordinal, fetched_at, cast(floor(epoch(fetched_at) - 1704067200) / 3600 as bigint) % 5 = 1 as bad, count(*) as n from fx_discovery group by all)
        select 'feeds' as part, unnest(['payloads', 'errors', 'found']) as counter,
          unnest([count(*), count(*) filter (bad), cast(coalesce(sum(n) filter (not bad), 0) as bigint)]) as value from f
        union all select 'lists', unnest(['payloads', 'errors', 'found']),
          unnest([count(*), count(*) filter (bad), cast(coalesce(sum(n) filter (not bad), 0) as bigint)]) from l
        union all select 'ads', 'found', (select count(*) from ({AD_TEXTS}) a)""",
    "citation_rings": f"""with recursive {RINGS}
        select domain, ring, count(*) over (partition by ring) as ring_size from g""",
    "credibility_steps": f"""with recursive {RINGS},
        t as (select domain, mbfc_credibility as tier, list_position(['DISPUTED', 'LOW', 'MIXED', 'HIGH'], mbfc_credibility) as rank from {DIM} where mbfc_credibility is not null)
        select e.source, e.target, a.tier as source_tier, b.tier as target_tier, cast(a.rank - b.rank as int) as step,
          case when x.ring = y.ring then x.ring end as ring
        from e join t a on a.domain = e.source join t b on b.domain = e.target left join g x on x.domain = e.source left join g y on y.domain = e.target
        where a.tier <> b.tier""",
    "cue_rates": """with q as (select pattern_id, unnest(regexp_extract_all(regexp_replace(description, '[“”]', '"', 'g'), '"([^"]+)"', 1)) as phrase from fx_quoting_patterns),
        c as (select distinct pattern_id, regexp_extract_all(lower(phrase), '[\\p{L}\\p{N}'']+') as c from q),
        d as (select doc_id, regexp_extract_all(regexp_replace(lower(text), '[’]', '''', 'g'), '[\\p{L}\\p{N}'']+') as w from documents),
        p as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d),
        h as (select doc_id, pattern_id, count(*) as hits from p join c on p.w[p.i] = c.c[1] and p.w[p.i:p.i + len(c.c) - 1] = c.c where len(c.c) > 0 group by all)
        select doc_id, pattern_id, hits, round(hits * 1000 / len(w), 6) as per_1000 from h join d using (doc_id)""",
    "migration_by_cluster": f"""with recursive {STORIES}
        f as (select p.cluster_id, d.source as media_class, min(cast('2024-01-01 00:00:00' as timestamp)
              + to_hours(cast(floor(doc_id / 80) as int) + case when doc_id % 3 = 0 then 240 else 0 end)) as first_seen
            from documents d join t using (text) join p using (id) group by 1, 2)
        select cluster_id, media_class, first_seen, cast(row_number() over (partition by cluster_id order by first_seen, media_class) as int) as step
        from f qualify count(*) over (partition by cluster_id) > 1""",
    "coordinated_text": f"""with recursive {STORIES}
        s as (select p.cluster_id, d.source, cast('2024-01-01 00:00:00' as timestamp)
              + to_hours(cast(floor(doc_id / 80) as int) + case when doc_id % 3 = 0 then 240 else 0 end) as ts
            from documents d join t using (text) join p using (id)),
        o as (select *, coalesce(ts - lag(ts) over (partition by cluster_id order by ts) > interval 6 hour, true) as opens from s),
        u as (select *, sum(opens::int) over (partition by cluster_id order by ts) as session from o)
        select cluster_id, min(ts) as first_seen, max(ts) as last_seen, cast(epoch(max(ts)) - epoch(min(ts)) as bigint) as span_seconds,
            count(*) as items, count(distinct source) as sources
        from u group by cluster_id, session having count(distinct source) >= 2""",
    "semantic_consensus": """with recursive e as (select vec_id, label, embedding::double[] as v from embeddings),
        echo as (select vec_id as own, vec_id + (select count(*) from e) as vec_id, cast(vec_id % 7 as int) as label,
            case when vec_id % 3 = 0 then 0 else vec_id - vec_id % 4 end as of from e where vec_id % 4 > 0),
        a as (select vec_id, label, v from e union all
            select k.vec_id, k.label, list_transform(range(1, len(b.v) + 1), lambda i: b.v[i] + y.v[i] * (k.own % 4) * 0.125::double)
            from echo k join e b on b.vec_id = k.of join e y on y.vec_id = k.own),
        m as (select vec_id, v, sqrt(list_dot_product(v, v)) as norm from a),
        l as (select x.vec_id as a, y.vec_id as b from m x join m y on x.vec_id <> y.vec_id and list_dot_product(x.v, y.v) >= x.norm * y.norm * 0.9::double),
        r(id, other) as (select vec_id, vec_id from m union select r.id, l.b from r join l on l.a = r.other),
        p as (select id, min(other) as cluster_id from r group by id)
        select cluster_id, count(*) as items, count(distinct label) as voices
        from p join a on a.vec_id = p.id group by cluster_id having count(distinct label) >= 2""",
    "migration_trail": """select content_hash, media_class, first_seen, cast(step as int) as step from (
        select *, count(*) over (partition by content_hash) as classes,
          row_number() over (partition by content_hash order by first_seen, media_class) as step from (
            select content_hash, publisher_name as media_class, min(fetched_at) as first_seen from fx_candidates group by 1, 2) f) q
        where classes > 1""",
}


def oracle_sql() -> dict[str, str]:
    """Every check query with the derived tables it uses, ready for DuckDB."""
    ready = {}
    for name, sql in SQL.items():
        text = with_clause(sql)
        text = text.replace("{SHA}", "sha256")
        ready[name] = re.sub(r"\{(" + "|".join(GIVEN) + r")\}", r"\1", text)
    return ready
