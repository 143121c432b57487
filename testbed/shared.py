"""Derived input tables in SQL both engines understand.

``{documents}`` and the like name a given table, ``{SHA}`` is the engine's
SHA-256 function. Every table below covers all rows of the table it is derived
from; scores and labels are arithmetic on ids, not model output.
"""

from __future__ import annotations

import re

from pressgauge import constants as C

N_DOCS = "(select count(*) from {documents})"


def _sql(value: object) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _values(rows) -> str:
    """Rows as a chain of selects, which both dialects read alike."""
    return ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in rows)


TABLES: dict[str, str] = {
    # unique texts; the first document of a text gives its attributes
    "fx_texts": """
        select {SHA}(text) as content_hash, min(doc_id) as doc_id, min_by(source, doc_id) as source,
               min_by(lang, doc_id) as lang, min_by(n_chars, doc_id) as n_chars
        from {documents} group by {SHA}(text)""",
    "fx_scans": """
        select content_hash as scan_id, content_hash, doc_id, source as publisher_name,
          concat(source, '.example.com') as publisher_domain,
          case when doc_id % 10 = 0 then concat('www.', source, '.example.com')
               else concat(source, '.example.com') end as article_domain,
          case cast(substr(source, 4) as int) % 4 when 0 then 'Broadsheet' when 1 then 'Tabloid'
               when 2 then 'State Media' else 'Mainstream' end as media_class,
          case lang when 'en' then 'US' when 'de' then 'UK' when 'es' then 'ZA' else null end as region,
          case lang when 'en' then 'US' when 'de' then 'DE' when 'es' then 'ES' else 'FR' end as country,
          lang as language,
          case when doc_id % 19 = 0 then null else lang <> 'fr' end as in_distribution,
          case when doc_id % 17 = 0 then 'analysis_error' else 'success' end as scan_status,
          case when doc_id % 13 = 0 then null
               else cast((doc_id * 37 + n_chars) % 101 as int) end as spi_score,
          cast('2024-01-01 06:00:00' as timestamp)
            + interval '1' day * cast(doc_id % 480 as int) as scanned_at,
          case when doc_id % 2 = 0 then 'vnext_haiku_2026_03' else '1.0' end as analyzer_version,
          case when doc_id % 2 = 0 then 'v1.0' else '1.0' end as taxonomy_version,
          case when doc_id % 2 = 0 then 'crawler_v1.0' else '1.0' end as prompt_version
        from fx_texts""",
    "fx_event_docs": f"""
        select event_id, ts, event_type, props, event_id * 7 % {N_DOCS} as doc_id,
          case event_type when 'click' then 'F' when 'view' then 'M' when 'error' then 'R'
               when 'signup' then 'C' else 'A' end as letter
        from {{events}}""",
    "fx_tactics": """
        select s.scan_id, e.event_id,
          case when e.event_id % 23 = 0 then null
               when e.event_id % 29 = 0 then 'Z99'
               else concat(e.letter, lpad(cast(e.event_id % 17 + 1 as string), 2, '0')) end as tactic_code,
          e.event_type as tactic_label,
          case e.event_id % 4 when 0 then 'critical' when 1 then 'warning'
               when 2 then 'note' else null end as severity,
          s.taxonomy_version
        from fx_event_docs e join fx_scans s on s.doc_id = e.doc_id""",
    "fx_hosts": """
        select distinct regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www[.]', '') as host
        from {pages}""",
    "fx_sources": """
        select distinct source, cast(substr(source, 4) as int) as n from {documents}""",
    "fx_labelled": """
        select domain, mbfc_bias, mbfc_factuality from (
          select case n % 3 when 0 then concat('absent.', source, '.example.com')
                 else concat(source, '.example.com') end as domain,
            case n % 4 when 0 then null when 1 then 'Left' when 2 then 'Extreme Right' else 'Satire' end as mbfc_bias,
            case n % 5 when 0 then 'High' when 1 then 'Low' when 2 then null when 3 then 'Very High'
                 else 'Mixed' end as mbfc_factuality
          from fx_sources
          union all
          select host, case length(host) % 5 when 0 then 'Left' when 1 then 'Least Biased'
              when 2 then 'Extreme Left' when 3 then 'Satire' else null end,
            case length(host) % 3 when 0 then 'High' when 1 then 'Low' else 'Mixed' end
          from fx_hosts) x""",
    # raw credibility records, page records first, one record per source after them
    "fx_corpus": """
        select page_id as item_no,
          case page_id % 4 when 0 then url when 1 then '' else null end as source_url_normalized,
          case page_id % 4 when 1 then concat('HTTP://WWW.', substr(url, 1 + length(regexp_extract(url, '^[a-z]+://', 0))))
               when 2 then '' else url end as url,
          case when page_id % 12 = 6 then '' else 'plain.example.org/about' end as domain,
          case page_id % 12 when 0 then 'left' when 1 then 'LEFT-CENTER ' when 2 then 'Least Biased'
               when 3 then ' extreme right' when 4 then 'Conspiracy-Pseudoscience' when 5 then 'satire'
               when 6 then ' Pro-Science' when 7 then 'Centrist  ' when 8 then '' when 9 then null
               when 10 then 'Right' else 'EXTREME LEFT' end as bias,
          case page_id % 9 when 0 then 'VERY HIGH' when 1 then 'high ' when 2 then 'mostly factual'
               when 3 then 'Mixed' when 4 then 'low' when 5 then 'Very Low' when 6 then 'n/a'
               when 7 then 'Unrated' else null end as factual_reporting,
          case page_id % 3 when 0 then 'USA' when 1 then '' else null end as country
        from {pages}
        union all
        select 1000000000000 + n, concat('https://www.', source, '.example.com/'), null, null,
          'Least Biased', 'High', 'UK' from fx_sources""",
    "fx_old_dimension": """
        select host as domain, 'Right' as mbfc_bias, 'Mixed' as mbfc_factuality, 'USA' as mbfc_country,
               'MIXED' as mbfc_credibility, 'manual' as source from fx_hosts
        union all
        select concat('supplier', cast(s_suppkey as string), '.example.org'), 'Left', 'High', null, 'HIGH', 'manual'
        from {supplier}""",
    "fx_candidates": """
        select {SHA}(text) as content_hash,
          case doc_id % 3 when 0 then 'rss_article' when 1 then 'gdelt_article' else 'facebook_ad' end as source_type,
          cast('2024-01-01 00:00:00' as timestamp)
            + interval '1' hour * cast(floor(doc_id / 80) as int) as fetched_at,
          cast(doc_id % 3 as int) as phase, cast(substr(source, 4) as int) as feed_ordinal,
          doc_id as item_pos, source as publisher_name,
          concat('https://www.', source, '.example.com/a/', cast(doc_id as string)) as article_url,
          concat(source, '.example.com') as article_domain
        from {documents}""",
    "fx_known_queue": """
        select {SHA}(d.text) as content_hash from {documents} d join {labels} l on d.doc_id = l.doc_id
        where l.quality = 1""",
    "fx_known_scans": """
        select {SHA}(d.text) as content_hash from {documents} d join {labels} l on d.doc_id = l.doc_id
        where l.toxic = 1""",
    "fx_queue": f"""
        select doc_id as item_id, content_hash, source as publisher_name, 'pending' as status,
          case when doc_id % 11 = 0 then null else cast('2024-01-01 00:00:00' as timestamp)
            + interval '1' minute * cast(doc_id * 7919 % {N_DOCS} as int) end as queued_at
        from fx_texts""",
    "fx_status_events": """
        select doc_id as item_id, event_id as seq, cast(ts as timestamp) as processed_at,
          case event_type when 'view' then 'pending' when 'click' then 'processing' when 'error' then 'error'
               else 'done' end as status,
          case when event_type = 'error' then props end as error_message
        from fx_event_docs""",
    # what a response says about a text, before it is packed into JSON
    "fx_response_parts": """
        select content_hash, doc_id,
          case when doc_id % 2 = 0 then 'v1.0' else '1.0' end as taxonomy_version,
          doc_id % 31 = 0 as broken, case when doc_id % 31 = 0 then cast(floor(doc_id / 31) as bigint) % 5 end as fault,
          case when doc_id % 31 = 0 or doc_id % 13 = 0 then null
               else cast((doc_id * 37 + n_chars) % 101 as int) end as spi_score,
          case when doc_id % 31 = 0 or doc_id % 5 = 0 then null
               else concat('play ', source) end as the_play,
          case when doc_id % 31 = 0 then null else concat('targets ', lang) end as emotional_targets,
          case when doc_id % 31 = 0 or doc_id % 3 = 0 then null
               else concat('blind ', cast(n_chars as string)) end as blind_spots,
          case when doc_id % 31 = 0 then null
               else concat('verdict ', cast(doc_id as string)) end as the_verdict,
          case when doc_id % 7 = 1 then 'missing' when doc_id % 7 = 2 then 'empty'
               when doc_id % 7 = 3 then 'scalar' else 'array' end as shape
        from fx_texts""",
    "fx_response_tactics": """
        select r.content_hash, r.taxonomy_version, e.event_id, e.event_id % 8 as kind,
          concat(e.letter, lpad(cast(e.event_id % 17 + 1 as string), 2, '0')) as code,
          concat('label ', e.event_type) as label, concat('name ', e.event_type) as name,
          case e.event_id % 5 when 0 then 'critical' when 1 then 'warning' when 2 then 'note'
               when 3 then 'odd' else null end as severity,
          concat('seen ', cast(e.event_id as string)) as evidence
        from fx_event_docs e join fx_response_parts r on r.doc_id = e.doc_id
        where r.shape = 'array' and not r.broken""",
    # the same tactic objects field by field; NULL means the field is left out
    "fx_tactic_objects": """
        select content_hash, taxonomy_version, event_id, kind = 3 as is_text, label as text_value,
          case when kind in (0, 4, 6, 7) then code when kind = 5 then '' end as o_code,
          case when kind in (0, 6, 7) then label when kind = 5 then '' end as o_label,
          case when kind in (1, 4, 5, 6) then name end as o_name,
          case when kind in (2, 6) then code end as o_tactic_code,
          case when kind in (0, 1, 7) then severity when kind = 2 then 'odd' when kind = 5 then '' end as o_severity,
          case when kind = 0 then evidence when kind = 4 then '' end as o_evidence,
          case when kind in (1, 4) then evidence end as o_excerpt
        from fx_response_tactics""",
    "fx_feeds": f"""
        select * from (values {_values([(i, *f) for i, f in enumerate(C.FEEDS)])})
          as t(ordinal, feed_url, name, domain, country, media_class, topic_class)""",
    "fx_terms": f"""
        select * from (values {_values([(i, t, c, j, k) for i, (t, c) in enumerate(C.AD_TERMS) for j, k in enumerate(C.AD_COUNTRIES)])})
          as t(term_ordinal, term, category, country_ordinal, country)""",
    # items as they stand in the landed feed payloads: four per payload, three dialects
    "fx_feed_items": """
        select doc_id, cast(doc_id % 20 as int) as ordinal,
          cast(floor(doc_id / 80) as int) as run_no,
          cast('2024-01-01 00:00:00' as timestamp)
            + interval '1' hour * cast(floor(doc_id / 80) as int) as fetched_at,
          cast(floor(doc_id / 20) as int) % 4 + 1 as pos,
          cast((doc_id % 20 + floor(doc_id / 80)) as int) % 3 as dialect,
          case when doc_id % 8 = 5 then '' else concat('Item & <', cast(doc_id as string), '>') end as title,
          case when doc_id % 9 = 0 then ''
               else concat('https://www.', source, '.example.com/a/', cast(doc_id as string)) end as url,
          cast('2024-01-01 05:00:00' as timestamp)
            + interval '1' minute * cast(doc_id % 100000 as int) as published_at
        from {documents}""",
    # page sources of the feed items, beside the given pages; German items were not found under their URL
    "fx_pages": """
        select url, html from {pages}
        union all
        select concat(case when lang = 'de' then 'https://moved.' else 'https://www.' end, source, '.example.com/a/', cast(doc_id as string)),
          concat('<html><head><STYLE>p[m:0]</STYLE><script type="x">var t="</p>";</script></head><body><p>',
                 replace(replace(text, '&', '&amp;'), '<', '&lt;'), '</p>&nbsp;</body></html>')
        from {documents}""",
    # pages that cite the page before or after them, so that some domains cite each other
    "fx_linked_pages": """
        select a.page_id, a.url, concat('<a href="', b.url, '">x</a> ', a.html) as html
        from {pages} a join {pages} b on b.page_id = case when a.page_id % 3 = 0 then a.page_id + 1 else a.page_id - 1 end""",
    # patterns that quote phrases of the benchmark passages, which some documents repeat
    "fx_quoting_patterns": """
        select concat('Q', cast(item_id % 9 as string)) as pattern_id, item_id,
          concat('Detection: "', {FIRST_WORDS:2}, '", "', {FIRST_WORDS:4}, '." or “', {FIRST_WORDS:7}, '”; also "', {FIRST_WORDS:1}, '".') as description
        from {benchmark}""",
    # URLs of the given pages in the forms feeds and records hold them
    "fx_urls": """
        select page_id, case page_id % 7 when 0 then url when 1 then upper(url)
            when 2 then replace(url, '://', '://user:pw@') when 3 then replace(url, '.com/', '.com:8080/')
            when 4 then replace(replace(url, 'https://', ''), 'http://', 'www.www.')
            when 5 then replace(url, '://', '://www.under_score.')
            else replace(url, '.example', '. example') end as url
        from {pages}""",
    "fx_dates": """
        select doc_id, doc_id % 6 as form,
          cast('2024-01-01 05:00:00' as timestamp)
            + interval '1' minute * cast(doc_id % 100000 as int) as published_at
        from {documents}""",
    "fx_legacy_scans": """
        select {SHA}(html) as content_hash, url as article_url,
          concat('legacy', cast(page_id % 30 as string), '.example.com') as article_domain,
          concat('Headline ', cast(page_id as string)) as article_title,
          cast('2023-06-01 00:00:00' as timestamp)
            + interval '1' hour * cast(page_id % 9000 as int) as article_published_at,
          cast(length(html) as int) as content_length_chars, 'gdelt' as feed_name,
          concat('Legacy ', cast(page_id % 30 as string)) as publisher_name, 'Tabloid' as media_class,
          case when page_id % 2 = 0 then 'ZA' end as region, 'ZA' as country, cast(page_id % 101 as int) as spi_score,
          cast('2023-06-05 00:00:00' as timestamp)
            + interval '1' hour * cast(page_id % 9000 as int) as scanned_at
        from {pages}""",
    "fx_discovery": """
        select page_id, cast(floor(page_id / 5) as bigint) % 4 as theme_ordinal,
          case cast(floor(page_id / 5) as bigint) % 4 when 0 then 'Manipulation' when 1 then 'Disinfo'
               when 2 then 'Election' else 'Health Disinfo' end as theme,
          cast('2024-01-01 00:00:00' as timestamp)
            + interval '1' hour * cast(floor(page_id / 20) as int) as fetched_at,
          cast(page_id % 5 + 1 as int) as pos,
          case when page_id % 11 = 0 then '' when page_id % 13 = 0 then 'not a url' else url end as url,
          case when page_id % 6 = 0 then '' when page_id % 6 = 1 then null
               else concat('listed', cast(page_id as string), '.example.com') end as listed_domain,
          case when page_id % 8 = 0 then null else concat('Headline ', cast(page_id as string)) end as title,
          cast('2024-02-01 00:00:00' as timestamp)
            + interval '1' minute * cast(page_id % 100000 as int) as seen_at,
          page_id % 3 as tone_kind, cast(page_id % 40 - 20 as double) / 4 as tone,
          case when page_id % 5 = 0 then 'Russian' else 'English' end as source_language
        from {pages}""",
    "fx_ad_nodes": """
        select c.fetched_at, t.term, t.country, c.container_pos, c.node_pos, c.text, c.advertiser_name
        from (
          select conv_id % 40 as container_pos, turn as node_pos,
            cast('2024-01-01 00:00:00' as timestamp)
              + interval '1' hour * cast(floor(conv_id / 40) as int) as fetched_at, cast(conv_id % 10 as int) as term_no,
            cast(floor(conv_id / 10) as bigint) % 2 as country_no,
            case (conv_id + turn) % 9 when 0 then concat('12:30 ', text) when 1 then concat('Sponsored ', text)
                 when 2 then concat('  ', text, '  ') else text end as text,
            case when conv_id % 7 = 0 then null when conv_id % 7 = 1 then ' '
                 else concat('Brand No. ', cast(conv_id % 7 as string), ' & Co') end as advertiser_name
          from {conversations}) c
        join fx_terms t on t.term_ordinal = c.term_no and t.country_ordinal = c.country_no""",
    "fx_ad_blocks": """
        select d.fetched_at, t.term, t.country, d.container_pos, d.text
        from (
          select doc_id % 280 as container_pos,
            cast('2024-01-01 00:00:00' as timestamp)
              + interval '1' hour * cast(floor(doc_id / 280) as int) as fetched_at, cast(doc_id % 14 as int) as term_no,
            cast(floor(doc_id / 14) as bigint) % 2 as country_no,
            case doc_id % 6 when 0 then concat('Log in ', text) when 1 then concat(text, ' Facebook')
                 else text end as text
          from {documents}) d
        join fx_terms t on t.term_ordinal = d.term_no and t.country_ordinal = d.country_no""",
    # pattern definitions: 200 parts per document, ids unique within a document
    "fx_patterns": """
        select p_partkey, cast(floor(p_partkey / 200) as bigint) as file_no,
          cast(p_partkey % 200 as int) as place,
          concat(substr('FMBRSPACIO', cast(p_partkey % 10 as int) + 1, 1),
                 lpad(cast(cast(floor((p_partkey % 200) / 10) as int) as string), 2, '0')) as pattern_id,
          case when p_size % 6 = 0 then concat(p_name, ' (Layer 2/3: ', p_type, ')') else p_name end as name,
          case when p_size % 4 = 0 then cast(p_size % 3 + 2 as int) end as enhanced_layer,
          case when p_size % 4 = 0 then concat('The ', p_type) end as enhanced_name,
          case when p_size % 3 = 0 then concat('marks of ', p_brand, '.') end as detection,
          concat(p_type, ' of size ', cast(p_size as string), '.') as base_text,
          concat('GROUP ', cast(cast(floor((p_partkey % 200) / 50) as int) as string)) as section,
          concat(substr('ABCDEFGH', cast(floor((p_partkey % 200) / 25) as int) + 1, 1), '1: ', 'SUBGROUP ',
                 cast(cast(floor((p_partkey % 200) / 25) as int) as string)) as subsection,
          case when p_size > 40 then concat('The ', p_name) end as display_name,
          p_size % 2 = 0 as enhanced, concat(cast(p_size % 4 + 2 as string), '') as source_layer
        from {part}""",
}

# the first n words of a text, in SQL both engines read alike
TABLES["fx_quoting_patterns"] = re.sub(
    r"\{FIRST_WORDS:(\d)\}", lambda m: "regexp_extract(text, '^" + "[^ ]+ ?" * int(m[1]) + "', 0)", TABLES["fx_quoting_patterns"]
)

_NAME = re.compile(r"\bfx_\w+")


def with_clause(sql: str) -> str:
    """``sql`` preceded by the derived tables it uses, in dependency order."""
    needed: set[str] = set()
    todo = set(_NAME.findall(sql))
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= set(_NAME.findall(TABLES[name]))
    if not needed:
        return sql
    parts = ",\n".join(f"{name} as ({TABLES[name]})" for name in TABLES if name in needed)
    body = sql.strip()
    if body[:15].lower() == "with recursive ":
        return f"with recursive {parts},\n{body[15:]}"
    if body[:5].lower() == "with ":
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"
