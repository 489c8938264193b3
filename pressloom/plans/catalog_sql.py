"""The queries of :mod:`pressloom.plans.catalog` as ANSI SQL over the same tables, where SQL
can express them. Used to check results with another engine, never to compute them."""

from __future__ import annotations

from pressloom.constants import CATEGORIES, SUMMARY_FAILED, SUMMARY_MISSING
from pressloom.functions.text import BLANKS
from pressloom.plans.catalog import AS_OF, BASE_URL, TITLE
from pressloom.plans.tables import DOMAINS, GROUPS

_ARTICLES = """articles AS (
  SELECT page_id AS seq,
         trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title,
         trim(array_to_string(regexp_extract_all(html, '<p>(?:<b>)?([^<]+)', 1), ' ')) AS description,
         url,
         regexp_extract(url, '^https?://([^/?#:]+)', 1) AS source,
         regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         event_type
  FROM pages LEFT JOIN events ON event_id = page_id * 20)"""


def _strip(text: str) -> str:
    return f"trim({text}, '{BLANKS}')"


_RAW = f"""{_ARTICLES}, raw AS (
  SELECT seq,
         CASE seq % 11 WHEN 0 THEN NULL WHEN 1 THEN ' ' || chr(12288) || chr(9)
              WHEN 2 THEN ' [Removed]' || chr(10) ELSE chr(160) || title || ' ' || chr(10) END AS title,
         CASE seq % 11 WHEN 3 THEN '[REMOVED] ' WHEN 4 THEN NULL ELSE chr(9) || description END AS description,
         CASE seq % 11 WHEN 5 THEN '  ' ELSE url || ' ' END AS url,
         CASE seq % 11 WHEN 6 THEN NULL WHEN 7 THEN '' WHEN 8 THEN '  ' ELSE source END AS source_name,
         CASE WHEN seq % 11 <> 9 THEN published_at END AS published_at,
         CASE WHEN seq % 11 <> 10 THEN url || '#image' END AS image_url,
         lang, event_type
  FROM articles)"""

_VALID = f"""(
    {_strip("coalesce(title, '')")} <> '' AND {_strip("coalesce(url, '')")} <> ''
    AND lower({_strip("coalesce(title, '')")}) <> '[removed]'
    AND lower({_strip("coalesce(description, '')")}) <> '[removed]')"""

_COPIES = f"""{_ARTICLES}, copies AS (
  SELECT seq, title, url FROM articles
  UNION ALL SELECT seq + 1000000000000, title, upper(url) || '//' FROM articles)"""

_SPELT = f"""{_ARTICLES}, spelt AS (
  SELECT seq, CASE seq % 14
    WHEN 1 THEN substr(published_at, 1, 10) || 'T' || substr(published_at, 12, 8) || '+09:00'
    WHEN 2 THEN substr(published_at, 1, 10) || ' ' || substr(published_at, 12, 8)
    WHEN 3 THEN substr(published_at, 1, 10)
    WHEN 4 THEN substr(published_at, 1, 7)
    WHEN 5 THEN substr(published_at, 1, 10) || 'T' || substr(published_at, 12, 8) || '.250Z'
    WHEN 6 THEN ''
    WHEN 7 THEN 'on ' || substr(published_at, 1, 10)
    WHEN 8 THEN substr(published_at, 1, 10) || 't' || substr(published_at, 12, 8) || '+00:00'
    WHEN 9 THEN substr(published_at, 1, 10) || '_' || replace(substr(published_at, 12, 8), ':', '') || 'Z'
    WHEN 10 THEN substr(published_at, 1, 10) || 'T' || substr(published_at, 12, 8) || '+09:00:30'
    WHEN 11 THEN substr(published_at, 1, 10) || 'T' || substr(published_at, 12, 8) || '-23:59'
    WHEN 12 THEN strftime(CAST(substr(published_at, 1, 10) AS DATE), '%G-W%V-%u') || 'T' || substr(published_at, 12, 8) || 'Z'
    WHEN 13 THEN strftime(CAST(substr(published_at, 1, 10) AS DATE), '%GW%V%u')
    ELSE published_at END AS published_at, CAST(replace(published_at, 'Z', '') AS TIMESTAMP) AS meant
  FROM articles),
timed AS (
  SELECT seq, published_at,
         CASE WHEN seq % 14 IN (8, 9, 12) THEN meant
              WHEN seq % 14 = 10 THEN meant - INTERVAL 32430 SECOND
              WHEN seq % 14 = 11 THEN meant + INTERVAL 1439 MINUTE
              WHEN seq % 14 = 13 THEN date_trunc('day', meant)
              WHEN regexp_full_match(published_at,
                '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?(Z|\\+\\d{{2}}:\\d{{2}})?)?')
              THEN CAST(replace(published_at, '+09:00', 'Z') AS TIMESTAMP)
                   - CASE WHEN published_at LIKE '%+09:00' THEN INTERVAL 9 HOUR ELSE INTERVAL 0 HOUR END
         END AS ts
  FROM spelt)"""


def _hits(phrases: tuple[str, ...]) -> str:
    return " + ".join(
        f"(length(x) - length(replace(x, '{p}', ''))) // {len(p)}".replace("x", side)
        for p in (phrase.lower() for phrase in phrases)
        for side in ("lower(title)", "lower(description)")
    )


_MATCHES = f"""{_ARTICLES}, matches AS (
  SELECT * FROM ({" UNION ALL ".join(
    f"SELECT *, CAST({g} AS BIGINT) AS group_idx, CAST({_hits(p)} AS BIGINT) AS hits FROM articles"
    for g, p in enumerate(GROUPS))})
  WHERE hits > 0),
ranked AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
        PARTITION BY group_idx ORDER BY hits DESC, CAST(replace(published_at, 'Z', '') AS TIMESTAMP) DESC, seq) AS rank
    FROM matches) WHERE rank <= 10)"""

_CATEGORY_KEY = "CASE (seq // 9) % 7 " + " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _) in enumerate(CATEGORIES)) + " END"
_T = """'"title_ja": "訳 ' || regexp_replace(title, '[^A-Za-z0-9 ]', '', 'g') || '"'"""
_S = """'"summary_ja": "要約 ' || CAST(seq AS VARCHAR) || '"'"""
_C = f"""'"category": "' || {_CATEGORY_KEY} || '"'"""


def _reply(*parts: str) -> str:
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


_GOOD = _reply(_T, _S, _C)
_ATTEMPTS = f"""attempts AS (
  SELECT seq, CAST(1 AS BIGINT) AS attempt, CASE seq % 9 WHEN 8 THEN 'api_error' ELSE 'ok' END AS outcome,
         CASE seq % 9
           WHEN 1 THEN ' ```json' || chr(10) || {_GOOD} || chr(10) || '```' || chr(10) || 'Done.'
           WHEN 2 THEN {_reply(_S, _C)}
           WHEN 3 THEN {_reply(_T)}
           WHEN 4 THEN {_reply(_T, _S, "'" + '"category": "Equipment"' + "'")}
           WHEN 5 THEN {_reply(_T, _S, "'" + '"category": null' + "'")}
           WHEN 6 THEN 'Sorry, ' || {_GOOD}
           WHEN 7 THEN {_GOOD} || ' and more'
           WHEN 8 THEN NULL
           ELSE {_GOOD} END AS text
  FROM articles
  UNION ALL
  SELECT seq, 2, CASE seq % 9 WHEN 7 THEN 'ok' ELSE 'rate_limited' END,
         CASE seq % 9 WHEN 7 THEN '["title_ja"]' END
  FROM articles WHERE seq % 9 >= 6
  UNION ALL
  SELECT seq, 3, CASE seq % 9 WHEN 8 THEN 'api_error' ELSE 'ok' END,
         CASE seq % 9 WHEN 6 THEN {_GOOD} WHEN 7 THEN '{{''title_ja'': ''x''}}' END
  FROM articles WHERE seq % 9 >= 6),
bare AS (
  SELECT seq, attempt, outcome,
         CASE WHEN outcome <> 'ok' THEN NULL
              WHEN starts_with({_strip("text")}, '```')
              THEN regexp_extract({_strip("text")}, '^```[^\\n]*\\n((?s:.*?))\\n```', 1)
              ELSE {_strip("text")} END AS body
  FROM attempts),
parsed AS (
  SELECT seq, attempt, outcome, doc IS NOT NULL AS ok,
         coalesce(json_exists(doc, '$.title_ja'), false) AS has_title_ja,
         coalesce(json_exists(doc, '$.summary_ja'), false) AS has_summary_ja,
         coalesce(json_exists(doc, '$.category'), false) AS has_category,
         json_extract_string(doc, '$.title_ja') AS title_ja,
         json_extract_string(doc, '$.summary_ja') AS summary_ja,
         json_extract_string(doc, '$.category') AS category
  FROM (SELECT seq, attempt, outcome,
               CASE WHEN coalesce(json_valid(body), false) AND starts_with(body, '{{') THEN CAST(body AS JSON) END AS doc
        FROM bare)),
winners AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY attempt) AS rn FROM parsed WHERE ok)
  WHERE rn = 1),
picked AS (
  SELECT k.seq, w.attempt, w.ok, w.has_title_ja, w.has_summary_ja, w.has_category,
         w.title_ja, w.summary_ja, w.category,
         w.seq IS NULL AND k.last_failed AS aborted
  FROM (SELECT seq, bool_or(attempt = 3 AND outcome = 'api_error') AS last_failed FROM attempts GROUP BY seq) k
  LEFT JOIN winners w ON w.seq = k.seq)"""


def _label(column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORIES) + " ELSE 'その他' END"


_KNOWN = ", ".join(f"'{k}'" for k, _ in CATEGORIES)
_ENRICHED = f"""enriched AS (
  SELECT a.*,
         CASE WHEN p.ok AND p.has_title_ja THEN p.title_ja ELSE a.title END AS title_ja,
         CASE WHEN p.ok AND p.has_summary_ja THEN p.summary_ja
              WHEN p.ok THEN coalesce(nullif(a.description, ''), '{SUMMARY_MISSING}')
              ELSE coalesce(nullif(a.description, ''), '{SUMMARY_FAILED}') END AS summary_ja,
         CASE WHEN p.category IN ({_KNOWN}) THEN p.category ELSE 'other' END AS category
  FROM articles a LEFT JOIN picked p ON p.seq = a.seq)"""

_ISSUES = f"""{_ARTICLES}, {_ATTEMPTS}, {_ENRICHED},
issues AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY issue_date ORDER BY ts DESC, seq) AS position
    FROM (SELECT *, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS issue_date
          FROM (SELECT *, CAST(replace(published_at, 'Z', '') AS TIMESTAMP) AS ts FROM enriched)))
  WHERE position <= 20),
dimension(cat_ord, category, label) AS (
  VALUES {", ".join(f"(CAST({i} AS BIGINT), '{k}', '{v}')" for i, (k, v) in enumerate(CATEGORIES))}),
counted AS (
  SELECT i.issue_date, d.cat_ord, d.category, d.label,
         CAST(sum(CASE WHEN i.category = d.category THEN 1 ELSE 0 END) AS BIGINT) AS n
  FROM issues i CROSS JOIN dimension d GROUP BY ALL),
totals AS (SELECT issue_date, count(*) AS total_articles FROM issues GROUP BY issue_date),
texts AS (
  SELECT t.issue_date, total_articles,
         coalesce(string_agg(label || ': ' || CAST(n AS VARCHAR) || '件', ' ｜ ' ORDER BY cat_ord)
                  FILTER (WHERE n > 0), '') AS categories
  FROM totals t JOIN counted USING (issue_date) GROUP BY ALL)"""


def _japanese(date: str) -> str:
    return f"substr({date}, 1, 4) || '年' || substr({date}, 6, 2) || '月' || substr({date}, 9, 2) || '日'"


_SUFFIX = "replace(name, 'weekly-news-', '')"

ORACLES: dict[str, str] = {
    "src_responses": f"""WITH {_RAW}, kinds AS (
        SELECT seq // 10 AS group_idx, arg_min(event_type, seq) AS kind FROM raw GROUP BY 1)
      SELECT group_idx, row_number() OVER (PARTITION BY group_idx ORDER BY seq) - 1 AS pos,
             title, description, url, source_name, published_at, image_url
      FROM raw JOIN kinds ON seq // 10 = group_idx WHERE kind NOT IN ('error', 'purchase')""",
    "rejected_responses": f"""WITH {_RAW}
      SELECT seq // 10 AS group_idx, 'error' AS status, 'unexpectedError' AS code, false AS unreadable
      FROM raw GROUP BY 1 HAVING arg_min(event_type, seq) = 'error'""",
    "landed_responses": f"""WITH {_RAW}, kinds AS (
        SELECT seq // 10 AS group_idx, arg_min(event_type, seq) AS kind, count(*) AS n FROM raw GROUP BY 1)
      SELECT group_idx,
             CASE WHEN kind = 'error' THEN 'error' WHEN group_idx = 3 AND kind <> 'purchase' THEN 'ok' END AS status,
             CASE WHEN group_idx = 3 AND kind <> 'purchase' THEN true WHEN kind = 'error' THEN false END AS unreadable,
             CASE WHEN kind NOT IN ('error', 'purchase') AND group_idx <> 3 THEN n END AS records
      FROM kinds WHERE kind <> 'purchase'""",
    "failed_requests": f"WITH {_ARTICLES} SELECT seq FROM articles WHERE seq % 9 = 8",
    "project_articles": f"""WITH {_RAW}
      SELECT seq, lang, {_strip("title")} AS title, {_strip("coalesce(description, '')")} AS description,
             {_strip("url")} AS url, {_strip("coalesce(nullif(source_name, ''), 'Unknown')")} AS source,
             coalesce(published_at, '') AS published_at, image_url
      FROM raw WHERE {_VALID}""",
    "src_archive": f"""WITH {_ISSUES}
      SELECT issue_date, position, title, description, url, source, published_at,
             CAST(NULL AS VARCHAR) AS image_url, title_ja, summary_ja, category FROM issues""",
    "kw_group_match": f"WITH {_MATCHES} SELECT seq, group_idx, hits FROM matches",
    "date_window": f"""WITH {_ARTICLES} SELECT seq, published_at FROM articles
      WHERE CAST(substr(published_at, 1, 10) AS DATE) BETWEEN DATE '{AS_OF.window_start}' AND DATE '{AS_OF.window_end}'""",
    "lang_filter": "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en'",
    "domain_exclude": f"""WITH {_ARTICLES} SELECT seq, url, source FROM articles
      WHERE NOT ({" OR ".join(f"lower(source) = '{d}' OR lower(source) LIKE '%.{d}'" for d in DOMAINS)})""",
    "topk_per_group": f"WITH {_MATCHES} SELECT group_idx, rank, seq, hits FROM ranked",
    "union_groups": f"""WITH {_MATCHES}
      SELECT group_idx * 4294967296 + rank AS seq, seq AS article_id, title FROM ranked""",
    "valid_articles": f"WITH {_RAW} SELECT seq, title, description, url FROM raw WHERE {_VALID}",
    "funnel_counts": f"""WITH {_RAW}, flags AS (
        SELECT lang, {_VALID} AS valid, published_at IS NOT NULL AS dated FROM raw)
      SELECT 'group_' || lang AS stage, count(*) AS n FROM flags GROUP BY lang
      UNION ALL SELECT 'all', count(*) FROM flags
      UNION ALL SELECT 'valid', count(*) FROM flags WHERE valid
      UNION ALL SELECT 'dated', count(*) FROM flags WHERE valid AND dated""",
    "url_norm": f"WITH {_COPIES} SELECT seq, lower(rtrim(url, '/')) AS url_norm FROM copies",
    "dedup_url": f"""WITH {_COPIES} SELECT seq, url FROM (
        SELECT seq, url, row_number() OVER (PARTITION BY lower(rtrim(url, '/')) ORDER BY seq) AS rn FROM copies)
      WHERE rn = 1""",
    "parse_published": f"""WITH {_SPELT}
      SELECT seq, published_at, epoch_us(ts) AS micros,
             ts IS NOT NULL AND NOT regexp_matches(published_at, '(Z|[+]0.:00(:30)?|-23:59)$') AS assumed_utc
      FROM timed""",
    "sort_newest": f"""WITH {_SPELT}
      SELECT row_number() OVER (ORDER BY ts DESC NULLS LAST, seq) AS position, seq, published_at FROM timed""",
    "issue_topk": f"""WITH {_ARTICLES}
      SELECT row_number() OVER (ORDER BY published_at DESC, seq) AS position, seq, title, published_at
      FROM articles ORDER BY published_at DESC, seq LIMIT 20""",
    "request_table": f"""WITH {_ARTICLES}
      SELECT seq, 'Title: ' || title || chr(10) || 'Source: ' || source || chr(10)
             || CASE WHEN description <> '' THEN 'Description: ' || description || chr(10) ELSE '' END
             || 'URL: ' || url AS prompt
      FROM articles""",
    "strip_fence": f"""WITH shown AS (
        SELECT conv_id, turn, {_strip("CASE WHEN role = 'assistant' THEN chr(10) || '```text' || chr(10) || text || "
                                      "CASE WHEN turn > 1 THEN chr(10) || '```' || chr(10) || 'rest' ELSE '' END "
                                      "ELSE text END")} AS body
        FROM conversations),
      cut_up AS (SELECT *, list_slice(string_split(body, chr(10)), 2, 1000000000) AS rest FROM shown),
      ends AS (SELECT *, coalesce(list_position(list_transform(rest, lambda x: starts_with(x, '```')), true), 0) AS stop
               FROM cut_up)
      SELECT conv_id, turn, CASE WHEN NOT starts_with(body, '```') THEN body
        WHEN stop > 0 THEN array_to_string(list_slice(rest, 1, stop - 1), chr(10))
        ELSE array_to_string(rest, chr(10)) END AS content FROM ends""",
    "parse_response": f"""WITH {_ARTICLES}, {_ATTEMPTS}
      SELECT seq, attempt, ok, has_title_ja, has_summary_ja, has_category, title_ja, summary_ja, category FROM parsed""",
    "norm_category": f"""WITH {_ARTICLES}, {_ATTEMPTS}
      SELECT seq, category AS raw, CASE WHEN category IN ({_KNOWN}) THEN category ELSE 'other' END AS category
      FROM picked""",
    "pick_attempt": f"WITH {_ARTICLES}, {_ATTEMPTS} SELECT seq, attempt, title_ja, aborted FROM picked",
    "enrich_articles": f"""WITH {_ARTICLES}, {_ATTEMPTS}, {_ENRICHED}
      SELECT seq, title, description, url, source, lang, published_at, title_ja, summary_ja, category FROM enriched""",
    "category_label": f"""WITH {_ARTICLES}, {_ATTEMPTS}
      SELECT seq, category, {_label("category")} AS label FROM picked""",
    "jst_date": f"""WITH {_SPELT}
      SELECT seq, published_at,
             coalesce(strftime(ts + INTERVAL 9 HOUR, '%Y年%m月%d日'), published_at) AS published_label
      FROM timed""",
    "category_counts": f"WITH {_ISSUES} SELECT issue_date, cat_ord, category, label, n FROM counted",
    "category_badges": f"WITH {_ISSUES} SELECT issue_date, cat_ord, category, label, n FROM counted WHERE n > 0",
    "article_cards": f"""WITH {_ISSUES}
      SELECT issue_date, position, category, {_label("category")} AS label, title_ja, summary_ja, source,
             {_japanese("issue_date")} AS published_label, url FROM issues""",
    "issue_header": f"""WITH {_ISSUES}
      SELECT issue_date, {_japanese("issue_date")} AS issue_label,
             strftime(CAST(issue_date AS DATE) - INTERVAL 7 DAY, '%Y/%m/%d') AS period_start,
             replace(issue_date, '-', '/') AS period_end,
             CAST(substr(issue_date, 1, 4) AS BIGINT) AS year, total_articles FROM totals""",
    "issue_key": """SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS issue_date,
             'weekly-news-' || strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS name FROM events""",
    "archive_index": f"""WITH names AS (
        SELECT DISTINCT 'weekly-news-' || CASE event_id % 5
          WHEN 0 THEN strftime(ts, '%Y-%m-%d')
          WHEN 1 THEN CAST(year(ts) AS VARCHAR) || '-' || CAST(month(ts) AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR)
          WHEN 2 THEN 'special-' || event_type
          WHEN 4 THEN strftime(ts, '%Y-%m-%d') || '-extra'
          ELSE strftime(ts, '%Y-%m-31x') END AS name
        FROM events)
      SELECT name, name || '.html' AS file_name, row_number() OVER (ORDER BY name || '.html' DESC) AS rank,
             coalesce(strftime(CASE WHEN regexp_full_match({_SUFFIX}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')
                                    THEN try_cast({_SUFFIX} AS DATE) END, '%Y年%m月%d日号'), {_SUFFIX}) AS display_date
      FROM names ORDER BY rank""",
    "digest_category_text": f"WITH {_ISSUES} SELECT issue_date, categories FROM texts",
    "digest_preview": f"""WITH {_ISSUES}
      SELECT issue_date, position, title_ja, greatest(total_articles - 5, 0) AS remaining
      FROM issues JOIN totals USING (issue_date) WHERE position <= 5""",
    "digest_row": f"""WITH {_ISSUES}
      SELECT issue_date,
             '{TITLE} ' || {_japanese("issue_date")} || '号 — ' || CAST(total_articles AS VARCHAR) || '件の記事' AS subject,
             rtrim('{BASE_URL}', '/') || '/weekly-news-' || issue_date || '.html' AS report_url,
             total_articles, categories
      FROM texts""",
}

ORACLES |= {
    "src_issue_files": f"SELECT *, false AS unreadable FROM ({ORACLES['src_archive']})",
    "date_window_files": ORACLES["date_window"],
    "kw_group_match_many": ORACLES["kw_group_match"],
    "domain_exclude_listed": ORACLES["domain_exclude"],
    "category_counts_kept": ORACLES["category_counts"],
    "digest_preview_kept": ORACLES["digest_preview"],
    "digest_row_kept": ORACLES["digest_row"],
}
