"""The catalog's queries stated in SQL (DuckDB dialect), for comparison.

Written from the rules, not from the Spark code: keywords are tested one by
one, regulations and markets by plain regular expressions, the collapse by a
recursive walk down the ranking.
"""

from __future__ import annotations

from ..lexicon import (FINANCE_TERMS, GLOSSARY_PHRASES, GLOSSARY_SKIP, PILLARS,
                       SECTION_ORDER, STOPWORDS, TOPICS)
from ..schemas import CURATED_COLUMNS, LIST_COLUMNS, RAW_COLUMNS
from .article_view import AS_OF, SHORT_FROM, STORIES


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def barred(expr: str) -> str:
    return f"array_to_string({expr}, '|')"


# --- small expressions ------------------------------------------------------

_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
# Query parameters that only track.
_DROP = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source", "cmpid", "smid",
         "_hsenc", "_hsmi", "sh")


def canonical(u: str) -> str:
    """Canonical form of an absolute URL."""
    def decode(x: str) -> str:
        return f"url_decode(replace({x}, '+', ' '))"

    def encode(x: str) -> str:
        return f"replace(url_encode({x}), '%20', '+')"

    key = decode("split_part(p, '=', 1)")
    value = decode("CASE WHEN contains(p, '=') THEN substr(p, strpos(p, '=') + 1) ELSE '' END")
    low = f"lower({key})"
    keep = (f"p <> '' AND NOT ({low} IN ({', '.join(q(k) for k in _DROP)}) OR starts_with({low}, 'utm_') "
            f"OR starts_with({low}, 'ito') OR starts_with({low}, 'at_'))")
    query = (f"array_to_string([{encode(key)} || '=' || {encode(value)} "
             f"FOR p IN string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&') IF {keep}], '&')")
    path = f"rtrim(regexp_extract({u}, '{_SCHEME}//[^/?#]*([^?#]*)', 1), '/')"
    return (f"(CASE WHEN {u} <> '' THEN lower(regexp_extract({u}, '{_SCHEME}')) || '//' || "
            f"regexp_replace(lower(regexp_extract({u}, '{_SCHEME}//([^/?#]*)', 1)), '^www\\.', '') || "
            f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
            f"CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END END)")


def title_key(t: str) -> str:
    return f"coalesce(array_to_string(regexp_extract_all(lower({t}), '[a-z0-9]+'), ' '), '')"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(w)})" for w in words) + ")"


def names(tests: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {c} THEN {q(n)} END" for n, c in tests.items())
    return f"[x FOR x IN [{cases}] IF x IS NOT NULL]"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00')"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def day(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


# Words near an omnibus, regulations and their patterns.
_OMNIBUS_NEAR = "csrd|csddd|sfdr|esrs|taxonomy|sustainab"
REGULATION_SQL = {
    "CSRD": r"\bcsrd\b|corporate sustainability reporting directive",
    "CSDDD": r"\bcsddd\b|\bcs3d\b|corporate sustainability due diligence",
    "SFDR": r"\bsfdr\b|sustainable finance disclosure regulation",
    "EU_Taxonomy": r"eu taxonomy|taxonomy regulation",
    "ESRS": r"\besrs\b|european sustainability reporting standards",
    "CBAM": r"\bcbam\b|carbon border adjustment",
    "EUDR": r"\beudr\b|deforestation regulation",
    "EU_ETS": r"\beu ets\b|emissions trading system",
    "Green_Claims_Directive": r"green claims directive|empowering consumers directive",
    "SEC_Climate_Rule": r"sec climate(?:[- ]related)? (?:disclosure )?rule|climate disclosure rule",
    "California_SB253": r"\bsb[- ]?253\b|climate corporate data accountability",
    "California_SB261": r"\bsb[- ]?261\b",
    "IRA": r"inflation reduction act\b",
    "ISSB": r"\bissb\b|ifrs s1|ifrs s2|international sustainability standards board",
    "TCFD": r"\btcfd\b|task force on climate",
    "TNFD": r"\btnfd\b|taskforce on nature",
    "GRI": r"\bgri standards?\b|global reporting initiative",
    "Paris_Agreement": r"paris agreement",
    "UK_SDR": r"\bsdr\b|sustainability disclosure requirements",
}
_REG_TESTS = {n: f"regexp_matches(low, {q(p)})" for n, p in REGULATION_SQL.items()}
_REG_TESTS["Omnibus"] = (
    "(regexp_matches(low, 'omnibus (?:package|proposal|simplification|directive|regulation)"
    "|(?:simplification|sustainability) omnibus') OR "
    f"(regexp_matches(low, '\\bomnibus\\b') AND regexp_matches(low, '{_OMNIBUS_NEAR}')))")

# Words of the two markets.
_EU_WORDS = (r"european union|brussels|european commission|european parliament|european council"
             r"|european central bank|eurozone|germany|german\b|france|french\b|spain|spanish\b|italy"
             r"|italian\b|netherlands|dutch\b|poland|polish\b|sweden|swedish\b|denmark|danish\b|belgium"
             r"|ireland|irish\b|austria|portugal|finland|greece|czech|eu taxonomy")
_EU_SHORT = r"\b(?:EU|EBA|ESMA|EIOPA|ECB|CSRD|SFDR|ESRS|CBAM|EUDR|CSDDD)\b"
_US_WORDS = (r"united states|american\b|washington|congress|senate|white house|california|texas|new york"
             r"|biden|trump|federal reserve|inflation reduction act|state department|supreme court"
             r"|department of energy|environmental protection agency|securities and exchange commission")
_US_SHORT = r"\bU\.S\.|\b(?:US|USA|SEC|EPA|FERC|CFTC|FHFA|DOE|IRS|NOAA|SB[- ]?253|SB[- ]?261)\b"
# RE2 has no look-ahead: "green light" is blanked out before matching.
# Core vocabulary.
_CORE = (r"\besg\b|sustainab|\bclimate\b|\bcarbon\b|\bemissions?\b|net[-\s]zero|\bgreen\b|\brenewables?\b"
         r"|decarboni|\benvironmental\b|\bgovernance\b|\bbiodiversity\b|circular economy|\bfossil fuels?\b"
         r"|(?:energy|just|climate|low[-\s]carbon|green|net[-\s]zero) transition"
         r"|transition (?:plan|finance|risk|pathway)")


def _core_text(t: str) -> str:
    return f"regexp_replace({t}, '\\bgreen\\s+light', ' # ', 'g')"


# --- common table expressions -----------------------------------------------

def _pick(index: str, values) -> str:
    return f"{array(values)}[CAST({index} AS INT) + 1]"


_TITLE = (f"CASE WHEN doc_id % 101 = 0 THEN '' WHEN n_chars % 24 >= {SHORT_FROM} "
          f"THEN {_pick('n_chars % 24', [s[0] for s in STORIES])} "
          f"ELSE {_pick('n_chars % 24', [s[0] for s in STORIES])} || ' - ' || split_part(text, '.', 1) END")

CTES: dict[str, str] = {
    "joined": """SELECT d.*, CASE WHEN doc_id % 103 <> 0 THEN p.url END AS url,
        CAST(substr(source, 4) AS INT) AS no, TIMESTAMP '{as_of}' AS as_of
      FROM documents d JOIN pages p ON d.doc_id % (SELECT count(*) FROM pages) = p.page_id""",
    "articles0": f"""SELECT doc_id, n_chars, as_of, no, {_TITLE} AS title, url,
        CASE WHEN doc_id % 19 <> 0 THEN text || ' ' ||
          {_pick('(n_chars // 24) % 24', [s[1] for s in STORIES])} END AS summary,
        CASE WHEN doc_id % 4 <> 0 THEN 'Author ' || (doc_id % 97) END AS author,
        CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 53 = 0 THEN 'unknown' ELSE
          {iso("as_of - to_days(CAST(n_chars % 11 - 1 AS INT)) - to_minutes(doc_id * 37 % 1440)")} END AS published_at,
        CAST(NULL AS VARCHAR) AS published_raw,
        [x FOR x IN string_split({_pick('n_chars % 24', [s[2] for s in STORIES])}, '|') IF x <> ''] AS categories,
        source AS source_id, 'Source ' || no AS source_name,
        ['EU', 'US', 'GLOBAL'][no % 3 + 1] AS source_market,
        CASE WHEN no % 5 = 0 THEN 'regulator' WHEN no % 7 = 0 THEN 'ngo' ELSE 'media' END AS source_type,
        lang AS language, 'https://feeds.example/' || source || '/rss' AS feed_url,
        {iso("as_of - to_seconds(doc_id % 600)")} AS fetched_at,
        {canonical("url")} AS canonical_url FROM joined""",
    "articles": """SELECT *, substr(sha256(coalesce(canonical_url, url)), 1, 32) AS article_id,
        ' ' || coalesce(title, '') || ' ' || coalesce(summary, '') || ' ' ||
          array_to_string(categories, ' ') || ' ' AS raw_text,
        try_strptime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS published_ts,
        try_strptime(fetched_at, '%Y-%m-%dT%H:%M:%S+00:00') AS fetched_ts FROM articles0""",
    "lowered": "SELECT *, lower(raw_text) AS low FROM articles",
    "tagged": f"""SELECT *,
        {names({p: any_of('low', k) for p, k in PILLARS.items()})} AS esg_pillars,
        {names({n: _REG_TESTS[n] for n in sorted(_REG_TESTS)})} AS regulations,
        {names({t: any_of('low', TOPICS[t]) for t in sorted(TOPICS)})} AS topics,
        (source_market = 'EU' OR regexp_matches(low, {q(_EU_WORDS)})
          OR regexp_matches(raw_text, {q(_EU_SHORT)})) AS is_eu,
        (source_market = 'US' OR regexp_matches(low, {q(_US_WORDS)})
          OR regexp_matches(raw_text, {q(_US_SHORT)})) AS is_us,
        len(list_distinct(regexp_extract_all({_core_text('low')}, {q(_CORE)}))) AS core,
        coalesce(regexp_matches({_core_text('lower(title)')}, {q(_CORE)}), false) AS core_title,
        {title_key('title')} AS title_key FROM lowered""",
    "enriched": """SELECT *,
        CASE WHEN is_eu AND is_us THEN ['EU', 'US'] WHEN is_eu THEN ['EU']
             WHEN is_us THEN ['US'] ELSE ['GLOBAL'] END AS markets,
        CASE WHEN is_eu AND is_us THEN 'EU_US' WHEN is_eu THEN 'EU'
             WHEN is_us THEN 'US' ELSE 'GLOBAL' END AS primary_market,
        greatest(0, least(100, least(8 * core, 35) + CASE WHEN core_title THEN 20 ELSE 0 END
          + least(7 * len(esg_pillars), 21) + least(12 * len(regulations), 24)
          + least(3 * len(topics), 12)
          + CASE WHEN source_type = 'regulator' AND len(regulations) > 0 THEN 8 ELSE 0 END
          - CASE WHEN coalesce(summary, '') = '' THEN 5 ELSE 0 END)) AS points,
        CAST(points AS DOUBLE) / 100 AS relevance_score,
        coalesce(published_at, '') <> '' AS has_publish_date,
        coalesce(nullif(canonical_url, ''), title_key) AS dedupe_key,
        coalesce(published_ts, fetched_ts, as_of) AS event_ts,
        CAST(coalesce(published_ts, fetched_ts, as_of) AS DATE) AS published_date FROM tagged""",
    "gated": """SELECT * FROM enriched WHERE title <> '' AND url <> ''
        AND (published_ts IS NULL OR published_ts BETWEEN as_of - INTERVAL 7 DAY AND as_of + INTERVAL 12 HOUR)
        AND {gate}""",
    "url_best": "SELECT * FROM gated QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY {precedence}) = 1",
    "title_best": """SELECT *, count(*) OVER (PARTITION BY title_key, published_date) AS duplicate_count,
        row_number() OVER (PARTITION BY title_key, published_date ORDER BY {precedence}) AS rn FROM url_best""",
    "curated": """SELECT *, CAST(as_of AS DATE) AS ingest_date FROM title_best
        WHERE rn = 1 OR length(title_key) < 15""",
    "ranked": """SELECT *, row_number() OVER (ORDER BY relevance_score DESC, published_date, article_id) AS rk,
        {tokens} AS tokens FROM curated""",
    "near": """SELECT b.rk AS late, list(a.rk) AS earlier FROM ranked a JOIN ranked b ON a.rk < b.rk
        AND len(a.tokens) > 0 AND len(b.tokens) > 0
        AND len(list_intersect(a.tokens, b.tokens)) / least(len(a.tokens), len(b.tokens)) >= 0.375
        GROUP BY b.rk""",
    "walk": """SELECT CAST(0 AS BIGINT) AS rk, CAST([] AS BIGINT[]) AS kept
      UNION ALL
      SELECT w.rk + 1, CASE WHEN list_has_any(w.kept, coalesce(n.earlier, [])) THEN w.kept
             ELSE list_append(w.kept, w.rk + 1) END
      FROM walk w JOIN ranked r ON r.rk = w.rk + 1 LEFT JOIN near n ON n.late = r.rk""",
    "kept": "SELECT kept FROM walk ORDER BY rk DESC LIMIT 1",
    "sectioned": """SELECT *, CASE WHEN list_has_any(topics, ['sustainable_finance', 'carbon_markets'])
          AND fin >= 2 AND fin >= greatest(se, ss, sg) THEN 'Sustainable Finance'
        WHEN se = greatest(se, ss, sg) THEN 'Environment'
        WHEN sg = greatest(se, ss, sg) THEN 'Governance' ELSE 'Social' END AS section FROM strengths""",
    "story": """SELECT *, strftime(published_date, '%Y-%m-%d') || '/' || primary_market AS report_id,
        row_number() OVER (PARTITION BY published_date, primary_market
          ORDER BY relevance_score DESC, published_date, article_id) AS rank
        FROM sectioned QUALIFY rank <= 20""",
    "pool": """SELECT *, strftime(published_date, '%Y-%m-%d') || '/' || primary_market AS report_id,
        row_number() OVER (PARTITION BY published_date, primary_market
          ORDER BY relevance_score DESC, published_date, article_id) AS place, {tokens} AS tokens FROM sectioned""",
    "close": """SELECT b.report_id, b.place AS late, list(a.place) AS earlier FROM pool a JOIN pool b
        ON a.report_id = b.report_id AND a.place < b.place AND len(a.tokens) > 0 AND len(b.tokens) > 0
        AND len(list_intersect(a.tokens, b.tokens)) / least(len(a.tokens), len(b.tokens)) >= 0.375
        GROUP BY b.report_id, b.place""",
    "stroll": """SELECT DISTINCT report_id, CAST(0 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS chosen FROM pool
      UNION ALL
      SELECT w.report_id, w.place + 1, CASE WHEN list_has_any(w.chosen, coalesce(n.earlier, [])) THEN w.chosen
             ELSE list_append(w.chosen, w.place + 1) END
      FROM stroll w JOIN pool r ON r.report_id = w.report_id AND r.place = w.place + 1
      LEFT JOIN close n ON n.report_id = r.report_id AND n.late = r.place""",
    "answer": """SELECT conv_id, max(CASE WHEN turn % 4 = 0 THEN text END) AS a0, max(CASE WHEN turn % 4 = 1 THEN text END) AS a1,
        max(CASE WHEN turn % 4 = 2 THEN text END) AS a2, max(CASE WHEN turn % 4 = 3 THEN text END) AS a3
        FROM conversations GROUP BY conv_id""",
    "told": """SELECT s.*, a.a0, a.a1, a.a2, a.a3, a.conv_id, {block} AS block
        FROM story s LEFT JOIN answer a ON a.conv_id = (day(s.published_date) * 20 + s.rank) % ((SELECT max(conv_id) + 1 FROM conversations) * 5 // 4)""",
    "bullet": """SELECT report_id, rank, regexp_replace(trim(b), '^[-• ]+', '') AS bullet FROM (
        SELECT report_id, rank, CASE WHEN rank % 3 = 0 THEN ' - ' ELSE '• ' END || title || '  ' AS b FROM story)
        WHERE rank <= 8""",
    "block_text": """SELECT report_id, list_position({sections}, section) AS part, rank, block AS text FROM told
      UNION ALL SELECT DISTINCT report_id, list_position({sections}, section), 0, '## ' || section || chr(10) FROM told
      UNION ALL SELECT report_id, 0, 0, '## Executive Summary' || chr(10) || chr(10) ||
        string_agg('- ' || bullet, chr(10) ORDER BY rank) || chr(10) FROM bullet GROUP BY report_id""",
    "body": """SELECT report_id, trim(string_agg(text, chr(10) ORDER BY part, rank), chr(10) || ' ') AS markdown
        FROM block_text GROUP BY report_id""",
    "wanted": """SELECT report_id, unnest(terms) AS term, generate_subscripts(terms, 1) - 1 AS position
        FROM (SELECT report_id, {terms_of_markdown} AS terms FROM body)""",
    "glossary": """SELECT report_id, position, upper(term) AS term,
        rtrim('Meaning of ' || term || '..', '.') AS meaning FROM wanted WHERE length(term) % 5 <> 0""",
    "report": """SELECT b.report_id, CASE WHEN g.text IS NULL THEN b.markdown ELSE
          b.markdown || chr(10) || chr(10) || '## Terms Explained' || chr(10) || chr(10) || g.text END AS markdown
        FROM body b LEFT JOIN (SELECT report_id, string_agg('**' || term || '** - ' || meaning || '.', chr(10)
          ORDER BY position) AS text FROM glossary GROUP BY report_id) g USING (report_id)""",
    "damaged": """SELECT report_id, CASE CAST(substr(report_id, 9, 2) AS INT) % 6
        WHEN 0 THEN replace(markdown, '## Executive Summary', '## Overview')
        WHEN 1 THEN replace(markdown, 'What to watch next', 'Next')
        WHEN 2 THEN replace(markdown, 'https://', '')
        WHEN 3 THEN replace(replace(markdown, '## Terms Explained', '## Notes'), '2026-08', 'August')
        WHEN 4 THEN replace(markdown, '- •', '') ELSE markdown END AS markdown FROM report""",
    "feed": """SELECT source AS id, 'Source ' || no AS name, 'https://feeds.example/' || source || '/rss' AS url,
        ['EU', 'US', 'GLOBAL'][no % 3 + 1] AS market,
        CASE WHEN no % 5 = 0 THEN 'regulator' WHEN no % 7 = 0 THEN 'ngo' ELSE 'media' END AS source_type
        FROM (SELECT DISTINCT source, CAST(substr(source, 4) AS INT) AS no FROM documents)""",
    "fetches": """SELECT strftime(ts, '%Y-%m-%d') AS run_id, 'src' || (user_id % 17) AS source_id, ts,
        CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'not_modified' ELSE 'ok' END AS outcome,
        CASE WHEN event_type = 'error' THEN 'HTTPError: ' || props END AS error FROM events""",
    "item": """SELECT strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INT), '%Y-%m-%d') AS run_id, source AS source_id,
        CASE WHEN doc_id % 17 <> 0 THEN CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INT)
          - CAST(n_chars % 11 - 1 AS INT) AS TIMESTAMP) END AS published_ts FROM documents""",
    "run": "SELECT run_id, min(ts) AS started FROM fetches GROUP BY run_id",
    "feed_run": """SELECT f.run_id, f.source_id, 'https://feeds.example/' || f.source_id || '/rss' AS feed_url, f.outcome,
        CASE WHEN f.outcome = 'ok' THEN coalesce(i.n, 0) END AS articles_parsed,
        CASE WHEN f.outcome = 'ok' THEN coalesce(i.kept, 0) ELSE 0 END AS articles, f.error
      FROM (SELECT run_id, source_id, max_by(outcome, ts) AS outcome,
              max_by(coalesce(error, ''), ts) AS e, nullif(e, '') AS error FROM fetches GROUP BY ALL) f
      LEFT JOIN (SELECT i.run_id, i.source_id, count(*) AS n, count(*) FILTER (WHERE published_ts IS NULL
              OR published_ts BETWEEN started - INTERVAL 7 DAY AND started + INTERVAL 12 HOUR) AS kept
            FROM item i JOIN run r USING (run_id) GROUP BY ALL) i USING (run_id, source_id)""",
    "health": """SELECT f.id AS source_id, f.name, f.market, f.url,
        CASE WHEN coalesce(l.outcome, 'failed') = 'failed' THEN 'FAIL'
             WHEN coalesce(i.n, 0) > 0 THEN 'OK' ELSE 'EMPTY' END AS status,
        CASE WHEN coalesce(l.outcome, 'failed') = 'failed' THEN 0 ELSE coalesce(i.n, 0) END AS items,
        CASE WHEN l.outcome <> 'failed' THEN coalesce(i.dated, 0) END AS dated_items,
        CASE WHEN l.outcome <> 'failed' THEN i.newest END AS newest,
        CASE WHEN coalesce(l.outcome, 'failed') = 'failed' THEN coalesce(l.error, 'not fetched') END AS error
      FROM feed f
      LEFT JOIN (SELECT source_id, max_by(outcome, ts) AS outcome, max_by(error, ts) AS error
                 FROM (SELECT *  REPLACE (coalesce(error, '') AS error) FROM fetches) GROUP BY 1) l ON l.source_id = f.id
      LEFT JOIN (SELECT source_id, count(*) AS n, count(published_ts) AS dated,
                   strftime(max(published_ts), '%Y-%m-%dT%H:%M:%S+00:00') AS newest FROM item GROUP BY 1) i
        ON i.source_id = f.id""",
}


def _terms(t: str) -> str:
    digits = f"list_sort(list_distinct(regexp_extract_all({t}, '(?i)\\bscope\\s*([123])\\b', 1)))"
    found = (f"list_distinct(list_concat(list_concat("
             f"[x FOR x IN regexp_split_to_array({t}, '[^\\p{{L}}\\p{{N}}_]+') "
             f"IF regexp_full_match(x, '[A-Z]{{2,6}}') AND NOT list_contains({array(GLOSSARY_SKIP)}, x)], "
             f"[x FOR x IN {array(GLOSSARY_PHRASES)} IF contains(lower({t}), x)]), "
             f"CASE WHEN len({digits}) > 0 THEN ['Scope ' || array_to_string({digits}, ' and ') || ' emissions'] ELSE [] END))")
    return f"[s.t FOR s IN list_sort([{{'k': lower(x), 't': x}} FOR x IN {found}])]"


def _story_block() -> str:
    labels = ("What happened", "Why it matters", "Who may be affected", "What to watch next")
    points = " || ".join(
        f"chr(10) || '**{label}** - ' || coalesce(CASE WHEN a.a{i} <> '' THEN trim(a.a{i}) END, "
        "'Not stated in the source material.')" for i, label in enumerate(labels))
    return ("'### ' || s.title || chr(10) || " + points + " || chr(10) || chr(10) || 'Source: ' || s.source_name || ', ' || "
            "strftime(s.published_date, '%Y-%m-%d') || ' - ' || coalesce(nullif(s.canonical_url, ''), s.url) || chr(10)")


_FILL = {
    "as_of": AS_OF,
    "gate": "((source_type = 'regulator' AND len(regulations) > 0) OR (len(esg_pillars) > 0 AND points >= 15) OR points >= 30)",
    "precedence": ("CASE WHEN source_type = 'regulator' THEN 0 ELSE 1 END, relevance_score DESC, event_ts, article_id, "
                   "source_id, url, fetched_ts, md5(concat_ws(chr(10), title, summary))"),
    "tokens": ("list_distinct([regexp_replace(t, 's+$', '') FOR t IN regexp_extract_all(lower(coalesce(title, '') || ' ' || "
               f"coalesce(substr(summary, 1, 200), '')), '[a-z0-9$]+') IF length(t) > 2 AND NOT list_contains({array(STOPWORDS)}, t)])"),
    "sections": array(SECTION_ORDER),
    "terms_of_markdown": _terms("markdown"),
    "block": _story_block(),
}


def _count(words) -> str:
    return " + ".join(f"CAST(contains(low, {q(w)}) AS INT)" for w in words)


CTES["strengths"] = f"""SELECT *, {_count(PILLARS['E'])} AS se,
    {_count(PILLARS['S'])} + 2 * CAST(list_contains(topics, 'supply_chain') AS INT) AS ss,
    {_count(PILLARS['G'])} + 2 * CAST(list_contains(topics, 'reporting_disclosure') AS INT)
      + 2 * CAST(list_contains(topics, 'litigation_enforcement') AS INT)
      + 2 * CAST(list_contains(topics, 'greenwashing') AS INT) AS sg,
    {_count(FINANCE_TERMS)} AS fin FROM curated"""

_ORDER = ("joined", "articles0", "articles", "lowered", "tagged", "enriched", "gated", "url_best", "title_best",
          "curated", "strengths", "sectioned", "ranked", "near", "walk", "kept", "pool", "close", "stroll", "story", "answer", "told", "bullet",
          "block_text", "body", "wanted", "glossary", "report", "damaged", "feed", "fetches", "item", "run",
          "feed_run", "health")


# The walk reads these once per row of the ranking.
_KIND = {"pool": "MATERIALIZED", "close": "MATERIALIZED", "ranked": "MATERIALIZED", "near": "MATERIALIZED", "curated": "MATERIALIZED"}


def _fill(text: str) -> str:
    for name, value in _FILL.items():
        text = text.replace("{" + name + "}", value)
    return text


#: The stories of whole briefings, in place of those of the plain top 20.
_DISTINCT_STORY = """SELECT p.* EXCLUDE (place, tokens), row_number() OVER (PARTITION BY p.report_id ORDER BY p.place) AS rank
        FROM pool p JOIN (SELECT report_id, arg_max(chosen, place) AS chosen FROM stroll GROUP BY report_id) c
        ON c.report_id = p.report_id AND list_contains(c.chosen, p.place) QUALIFY rank <= 20"""


def with_ctes(last: str, select: str, **other: str) -> str:
    """The query after all common table expressions that it needs; ``other``
    replaces some of them."""
    parts_of = CTES | other
    needed, todo = set(), last.split()
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            body = " " + parts_of[name].replace(",", " ").replace("(", " ").replace(")", " ") + " "
            todo += [n for n in _ORDER if n != name
                     and (f"FROM {n} " in body or f"JOIN {n} " in body or f"FROM {n}\n" in body or f"JOIN {n}\n" in body)]
    parts = [f"{n} AS {_KIND.get(n, '')} (\n{_fill(parts_of[n])})" for n in _ORDER if n in needed]
    kind = "WITH RECURSIVE" if needed & {"walk", "stroll"} else "WITH"
    return f"{kind} " + ",\n".join(parts) + "\n" + _fill(select)


#: Points as hundredths of the linear model of the catalog.
_MODEL = CTES["enriched"].replace("AS points,", """AS plain_points,
        15000025 * len(esg_pillars) + 4000050 * len(regulations) + 125075 * len(topics)
          + CASE WHEN source_type = 'regulator' THEN 30000000 ELSE 0 END
          - CASE WHEN coalesce(summary, '') = '' THEN 7525 ELSE 0 END AS points,""")


def _curated_select(columns=CURATED_COLUMNS) -> str:
    out = []
    for c in columns:
        if c in LIST_COLUMNS:
            out.append(f"{barred(c)} AS {c}")
        elif c.endswith("_ts"):
            out.append(f"{stamp(c)} AS {c}")
        elif c.endswith("_date") and c != "has_publish_date":
            out.append(f"{day(c)} AS {c}")
        else:
            out.append(c)
    return "SELECT " + ", ".join(out) + " FROM curated"


_RAW_SELECT = ("SELECT " + ", ".join(f"{barred(c)} AS {c}" if c == "categories" else c for c in RAW_COLUMNS)
               + " FROM articles")
_AVG = "floor((2 * sum(points * 100) + 10 * count(*)) / (20 * count(*))) / 1000.0 AS avg_relevance"
_DIGEST = ("SELECT article_id, title, relevance_score, primary_market, source_name, "
           "strftime(published_date, '%Y-%m-%d') AS published_date, "
           "coalesce(nullif(array_to_string(esg_pillars, '/'), ''), '-') AS tags, "
           "array_to_string(regulations, ', ') AS regulation_names, "
           "coalesce(nullif(canonical_url, ''), url) AS link FROM curated {where} "
           "ORDER BY relevance_score DESC, event_ts DESC, article_id LIMIT 25")
_SLIM = ("SELECT title AS t, coalesce(nullif(canonical_url, ''), url) AS u, source_name AS s, source_type AS st, "
         f"{day('published_date')} AS d, primary_market AS m, {barred('esg_pillars')} AS p, {barred('topics')} AS tp, "
         f"{barred('regulations')} AS r, relevance_score AS sc, substr(coalesce(summary, ''), 1, 320) AS sm FROM curated")
_ODD = ("split_part(url, '#', 1) || CASE WHEN contains(split_part(url, '#', 1), '?') THEN '&' ELSE '?' END || "
        "'q=a*b~c%20d+e%zz&UTM_Medium=x&empty=&flag&&at_x=1&Ref=9&n=' || page_id || '#frag'")
_PLAIN = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
for _e, _c in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")):
    _PLAIN = f"replace({_PLAIN}, '{_e}', '{_c}')"
_EVENT = "date_trunc('second', ts)"
_WIRE = "CASE WHEN no % 4 = 3 THEN 'wire.example' ELSE source_name END"
_ANCHOR = ("nullif(trim(regexp_replace(replace(replace(replace(replace(replace(replace("
           "regexp_replace(regexp_replace({0}, '\\s+', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), "
           "'&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '\\s+', ' ', 'g')), '')")


def _relay_stripped(title: str, publisher: str | None) -> str:
    tail = f"trim(regexp_extract({title}, '(?s)^.*?\\s+-\\s+([^-]{{2,40}})$', 1))"
    cut = (f"CASE WHEN {tail} <> '' AND (contains({tail}, '.') OR len(regexp_split_to_array({tail}, '\\s+')) <= 4) "
           f"THEN trim(regexp_extract({title}, '(?s)^(.*?)\\s+-\\s+[^-]{{2,40}}$', 1)) ELSE {title} END")
    if publisher is None:
        return cut
    return (f"CASE WHEN ends_with({title}, ' - ' || {publisher}) THEN "
            f"trim(substr({title}, 1, length({title}) - length({publisher}) - 3)) ELSE {cut} END")


_AUDIT = """
SELECT report_id, 'summary_first' AS "check", 'opens with something else than ''## Executive Summary''' AS detail
  FROM damaged WHERE NOT starts_with(ltrim(markdown), '## Executive Summary')
UNION ALL SELECT report_id, 'bullet_count', 'the summary holds ' || n || ' points instead of 5 to 8' FROM (
  SELECT report_id, len(regexp_extract_all(string_split(markdown, '##')[2], '(?m)^\\s*[-*]\\s+\\S')) AS n FROM damaged
  WHERE contains(markdown, '##')) WHERE n NOT BETWEEN 5 AND 8
UNION ALL SELECT report_id, c, 'heading absent everywhere: ''' || l || '''' FROM damaged,
  (VALUES ('label_what_happened', 'What happened'), ('label_why_it_matters', 'Why it matters'),
          ('label_who_may_be_affected', 'Who may be affected'), ('label_what_to_watch_next', 'What to watch next')) v(c, l)
  WHERE NOT contains(lower(markdown), lower(l))
UNION ALL SELECT report_id, 'glossary', 'no heading ''## Terms Explained''' FROM damaged
  WHERE NOT contains(markdown, '## Terms Explained')
UNION ALL SELECT report_id, 'declined', n || ' points left unanswered'
  FROM (SELECT report_id, len(regexp_extract_all(markdown, '(?i)\\*\\*(?:Why it matters|Who may be affected|What to watch next)\\*\\*\\s*-\\s*(?:not stated|not specified|unclear|unknown|n/a)')) AS n FROM damaged) WHERE n > 0
UNION ALL SELECT report_id, 'urls', missing || '/' || n || ' story addresses not cited' FROM (
  SELECT s.report_id, count(*) AS n, count(*) FILTER (WHERE NOT contains(d.markdown, coalesce(nullif(s.canonical_url, ''), s.url))) AS missing
  FROM story s JOIN damaged d USING (report_id) GROUP BY 1) WHERE missing > 0
UNION ALL SELECT report_id, 'dates', missing || ' story dates not shown' FROM (
  SELECT s.report_id, count(DISTINCT s.published_date) FILTER (WHERE NOT contains(d.markdown, strftime(s.published_date, '%Y-%m-%d'))) AS missing
  FROM story s JOIN damaged d USING (report_id) GROUP BY 1) WHERE missing > 0"""

_PROMPT = ("'[' || rank || '] ' || title || chr(10) || '    source: ' || source_name || chr(10) || '    date: ' || "
           "strftime(published_date, '%Y-%m-%d') || chr(10) || {more} '    summary: ' || substr(coalesce(summary, ''), 1, 700)")
_PROMPT_MORE = ("'    market: ' || primary_market || chr(10) || '    pillars: ' || coalesce(nullif(array_to_string(esg_pillars, ', '), ''), 'none') "
                "|| chr(10) || '    regulations: ' || coalesce(nullif(array_to_string(regulations, ', '), ''), 'none') || chr(10) || ")


def statements() -> dict[str, str]:
    """SQL for every query of the catalog that has an equivalent."""
    tops = ("SELECT rk, article_id, title, relevance_score, published_date, section_rank AS rank FROM ("
            "SELECT *, row_number() OVER (ORDER BY rk) AS section_rank FROM ranked, kept WHERE list_contains(kept, rk)) "
            "WHERE section_rank <= 20")
    sql = {
        "canonical_urls": f"SELECT page_id, {canonical('url')} AS canonical_url, {canonical('odd')} AS odd_url "
                          f"FROM (SELECT *, {_ODD} AS odd FROM pages)",
        "article_ids": with_ctes("articles", "SELECT doc_id, article_id FROM articles"),
        "html_text": f"SELECT page_id, nullif(trim(regexp_replace({_PLAIN}, '\\s+', ' ', 'g')), '') AS plain FROM pages",
        "title_keys": with_ctes("articles", f"SELECT doc_id, {title_key('title')} AS title_key FROM articles"),
        "feed_dates": f"""SELECT event_id, {stamp(_EVENT)} AS rfc,
            {stamp(_EVENT + ' + INTERVAL 5 HOUR')} AS rfc_zone, {stamp(_EVENT)} AS iso_z,
            {stamp(_EVENT + ' - INTERVAL 2 HOUR')} AS iso_offset, strftime(ts, '%Y-%m-%d 00:00:00') AS iso_day,
            {stamp(_EVENT)} AS iso_tail, CAST(NULL AS VARCHAR) AS bad,
            {stamp(_EVENT + ' - INTERVAL 2 HOUR')} AS html FROM events""",
        "relay_titles": with_ctes("articles", f"""SELECT doc_id, {_relay_stripped("n", "source_name")} AS named,
            {_relay_stripped("d", None)} AS domain, {_relay_stripped("title", None)} AS plain
            FROM (SELECT *, title || ' - ' || source_name AS n, title || ' - news.example' AS d FROM articles)"""),
        "relay_urls": """SELECT page_id, 'https://news.google.com/rss/search?q=' || replace(url_encode('site:' ||
            regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^[a-z]+://', '') || ' (climate OR energy) when:7d'),
            '%2F', '/') || '&hl=en-GB&gl=GB&ceid=GB:en' AS relay_url FROM pages""",
        "pillar_tags": with_ctes("enriched", f"SELECT doc_id, {barred('esg_pillars')} AS esg_pillars FROM enriched"),
        "regulation_tags": with_ctes("enriched", f"SELECT doc_id, {barred('regulations')} AS regulations FROM enriched"),
        "topic_tags": with_ctes("enriched", f"SELECT doc_id, {barred('topics')} AS topics FROM enriched"),
        "market_tags": with_ctes("enriched", f"SELECT doc_id, {barred('markets')} AS markets, is_eu, is_us FROM enriched"),
        "relevance_scores": with_ctes("enriched", "SELECT doc_id, relevance_score, has_publish_date FROM enriched"),
        "custom_scores": with_ctes("enriched", "SELECT doc_id, CAST(len(esg_pillars) + len(topics) + len(regulations) "
                                               "AS DOUBLE) / 32 AS relevance_score FROM enriched"),
        "required_fields": with_ctes("articles", "SELECT doc_id FROM articles WHERE title <> '' AND url <> ''"),
        "window_filter": with_ctes("articles", f"""SELECT doc_id, {stamp('published_ts')} AS published_ts FROM articles
            WHERE published_ts IS NULL OR published_ts BETWEEN as_of - INTERVAL 7 DAY AND as_of + INTERVAL 12 HOUR"""),
        "relevance_gate": with_ctes("enriched", "SELECT doc_id, relevance_score FROM enriched WHERE {gate}"),
        "url_dedupe": with_ctes("enriched", f"""SELECT dedupe_key, doc_id, source_id, relevance_score, {stamp('event_ts')} AS event_ts
            FROM enriched WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY {{precedence}}) = 1"""),
        "title_dedupe": with_ctes("enriched", f"""SELECT title_key, {day('published_date')} AS published_date, doc_id, duplicate_count FROM (
            SELECT *, count(*) OVER (PARTITION BY title_key, published_date) AS duplicate_count,
              row_number() OVER (PARTITION BY title_key, published_date ORDER BY {{precedence}}) AS rn FROM (
              SELECT * FROM enriched WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY {{precedence}}) = 1))
            WHERE rn = 1 OR length(title_key) < 15"""),
        "curated_articles": with_ctes("curated", _curated_select()),
        "market_day": with_ctes("curated", f"""SELECT primary_market, {day('published_date')} AS published_date,
            count(*) AS article_count, {_AVG}, count(DISTINCT source_id) AS source_count FROM curated GROUP BY 1, curated.published_date"""),
        "model_market_day": with_ctes("curated", f"""SELECT primary_market, {day('published_date')} AS published_date,
            count(*) AS article_count, {_AVG}, count(DISTINCT source_id) AS source_count FROM curated GROUP BY 1, curated.published_date""",
                                      enriched=_MODEL),
        "model_top20": with_ctes("kept", f"SELECT rank, article_id, title, relevance_score, {day('published_date')} AS published_date FROM ({tops})",
                                 enriched=_MODEL),
        "by_regulation": with_ctes("curated", """SELECT regulation, primary_market, count(*) AS article_count FROM (
            SELECT unnest(regulations) AS regulation, primary_market FROM curated) GROUP BY 1, 2"""),
        "by_topic": with_ctes("curated", f"""SELECT topic, count(*) AS article_count, {_AVG} FROM (
            SELECT unnest(topics) AS topic, points FROM curated) GROUP BY 1"""),
        "by_pillar": with_ctes("curated", """SELECT pillar, primary_market, count(*) AS article_count FROM (
            SELECT unnest(esg_pillars) AS pillar, primary_market FROM curated) GROUP BY 1, 2"""),
        "by_source": with_ctes("curated", "SELECT source_name, count(*) AS article_count FROM curated GROUP BY 1"),
        "site_stats": with_ctes("curated", """SELECT 'market' AS dimension, primary_market AS key, count(*) AS n FROM curated GROUP BY 2
            UNION ALL SELECT 'source', source_name, count(*) FROM curated GROUP BY 2
            UNION ALL SELECT 'pillar', x, count(*) FROM (SELECT unnest(esg_pillars) AS x FROM curated) GROUP BY 2
            UNION ALL SELECT 'regulation', x, count(*) FROM (SELECT unnest(regulations) AS x FROM curated) GROUP BY 2"""),
        "site_summary": with_ctes("curated", f"""SELECT count(*) AS total, coalesce({day('min(published_date)')}, 'n/a') AS first_date,
            coalesce({day('max(published_date)')}, 'n/a') AS last_date, count(DISTINCT source_name) AS source_count FROM curated"""),
        "digest_top25": with_ctes("curated", _DIGEST.replace("{where}", "")),
        "digest_us": with_ctes("curated", _DIGEST.replace("{where}", "WHERE list_contains(markets, 'US')")),
        "slim_rows": with_ctes("curated", _SLIM),
        "article_search": with_ctes("curated", _SLIM + """ WHERE primary_market = 'EU_US' AND list_contains(esg_pillars, 'G')
            AND contains(lower(title || ' ' || substr(coalesce(summary, ''), 1, 320) || ' ' || array_to_string(regulations, ' ')
            || ' ' || array_to_string(topics, ' ')), 'climate')"""),
        "briefing_top20": with_ctes("kept", f"SELECT rank, article_id, title, relevance_score, {day('published_date')} AS published_date FROM ({tops})"),
        "briefing_top20_eu": with_ctes("ranked", """SELECT row_number() OVER (ORDER BY rk) AS rank, article_id, relevance_score
            FROM ranked WHERE list_contains(markets, 'EU') QUALIFY rank <= 20"""),
        "section_routing": with_ctes("sectioned", """SELECT article_id, se AS strength_e, ss AS strength_s, sg AS strength_g,
            fin AS strength_finance, section FROM sectioned"""),
        "token_signatures": with_ctes("articles", "SELECT doc_id, array_to_string(list_sort({tokens}), '|') AS tokens FROM articles"),
        "near_dup_pairs": with_ctes("kept", """SELECT b.article_id, a.article_id AS kept_id,
              len(list_intersect(a.tokens, b.tokens)) AS shared, least(len(a.tokens), len(b.tokens)) AS smaller
            FROM (SELECT late, list_min([x FOR x IN earlier IF list_contains(kept, x)]) AS leader FROM near, kept
                  WHERE NOT list_contains(kept, late)) l
            JOIN ranked b ON b.rk = l.late JOIN ranked a ON a.rk = l.leader"""),
        "near_dup_collapse": with_ctes("kept", "SELECT article_id FROM ranked, kept WHERE list_contains(kept, rk)"),
        "feed_items": with_ctes("articles", f"""SELECT article_id, {_ANCHOR.format("title")} AS title,
              trim(url) AS url, canonical_url, substr({_ANCHOR.format("summary")}, 1, 2000) AS summary, author,
              {iso('published_ts')} AS published_at,
              {date_text()} AS published_raw, {barred('list_sort(list_distinct(categories))')} AS categories, source_id,
              {_WIRE} AS source_name, source_market, source_type, 'en' AS language, feed_url, fetched_at
            FROM articles WHERE title <> '' AND url <> '' AND doc_id % 100 <> 7"""),
        "feed_filter": with_ctes("feed", "SELECT id, market, source_type FROM feed WHERE market IN ('EU', 'GLOBAL') AND source_type IN ('media', 'regulator')"),
        "live_feeds": with_ctes("feed", """SELECT id, url FROM feed WHERE url NOT IN (SELECT 'https://feeds.example/src' || (user_id % 40) || '/rss'
            FROM events WHERE event_type = 'error' AND json_extract_string(props, '$.k') = '9')"""),
        "feed_health": with_ctes("health", "SELECT * FROM health"),
        "healthy_feeds": with_ctes("health", "SELECT count(*) FILTER (WHERE status = 'OK') AS healthy, count(*) AS feeds FROM health"),
        "ingest_feed_stats": with_ctes("feed_run", "SELECT run_id, source_id, feed_url, outcome, articles_parsed, articles, error FROM feed_run"),
        "ingest_stats": with_ctes("feed_run", """SELECT run_id, count(*) AS feeds_requested,
            count(*) FILTER (WHERE outcome = 'ok') AS feeds_ok, count(*) FILTER (WHERE outcome = 'not_modified') AS feeds_not_modified,
            count(*) FILTER (WHERE outcome = 'failed') AS feeds_failed, CAST(coalesce(sum(articles_parsed), 0) AS BIGINT) AS articles_parsed,
            CAST(sum(articles) AS BIGINT) AS articles_in_window,
            coalesce(string_agg(concat_ws(' ', source_id, feed_url, error), '|' ORDER BY source_id) FILTER (WHERE outcome = 'failed'), '') AS failures
            FROM feed_run GROUP BY run_id"""),
        "batch_prompts": with_ctes("story", f"""SELECT report_id, CAST((rank + 4) // 5 AS INT) AS batch,
            string_agg({_PROMPT.replace('{more}', _PROMPT_MORE)}, chr(10) || chr(10) ORDER BY rank) AS payload FROM story GROUP BY 1, 2"""),
        "summary_prompts": with_ctes("story", """SELECT report_id, string_agg('- ' || title || ' (' || primary_market || ', ' ||
            strftime(published_date, '%Y-%m-%d') || '): ' || substr(coalesce(summary, ''), 1, 220), chr(10) ORDER BY rank) AS payload
            FROM story GROUP BY 1"""),
        "retry_prompts": with_ctes("told", f"SELECT report_id, rank, {_PROMPT.replace('{more}', '')} AS payload FROM told WHERE conv_id IS NULL"),
        "story_blocks": with_ctes("told", "SELECT report_id, rank, block FROM told"),
        "summary_bullets": with_ctes("bullet", "SELECT report_id, string_agg(bullet, '|' ORDER BY rank) AS bullets FROM bullet GROUP BY 1"),
        "section_groups": None,
        "report_text": with_ctes("report", "SELECT report_id, markdown FROM report"),
        "briefing_text": with_ctes("report", f"""SELECT report_id, '# Weekly sustainability report' || chr(10) || chr(10) ||
            '**Period:** last 7 days, ' || {day('first')} || ' to ' || {day('last')} || '  ' || chr(10) || '**Stories:** ' || n ||
            ', best first, retellings left out  ' || chr(10) || '**Outlets:** ' || names || '  ' || chr(10) ||
            '**Written:** 2026-08-14 12:00 UTC by `given-model`' || chr(10) || chr(10) || '---' || chr(10) || chr(10) ||
            markdown || chr(10) AS markdown FROM report JOIN (SELECT report_id, min(published_date) AS first,
              max(published_date) AS last, count(*) AS n, array_to_string(list_sort(list_distinct(list(source_name))), ', ') AS names
              FROM story GROUP BY report_id) USING (report_id)""", story=_DISTINCT_STORY),
        "briefing_audit": with_ctes("report", _AUDIT.replace("damaged", "report"), story=_DISTINCT_STORY),
        "report_glossary": with_ctes("glossary", "SELECT report_id, position, term, meaning FROM glossary"),
        "report_headers": with_ctes("story", f"""SELECT report_id, {day('min(published_date)')} || ' to ' || {day('max(published_date)')} AS "window",
            count(*) AS article_count, array_to_string(list_sort(list_distinct(list(source_name))), ', ') AS sources FROM story GROUP BY 1"""),
        "latest_report": with_ctes("report", """SELECT report_id, substr(report_id, 1, 10) AS report_date, markdown FROM report
            ORDER BY report_date DESC, report_id DESC LIMIT 1"""),
        "report_citations": with_ctes("told", """SELECT report_id, source_name AS name, strftime(published_date, '%Y-%m-%d') AS cited_date,
            coalesce(nullif(canonical_url, ''), url) AS url FROM told"""),
        "report_audit": with_ctes("damaged", _AUDIT).replace("WITH ", "WITH ", 1),
        "uncited_articles": with_ctes("damaged", """SELECT s.report_id, s.rank, s.article_id FROM story s JOIN damaged d USING (report_id)
            WHERE NOT contains(d.markdown, coalesce(nullif(s.canonical_url, ''), s.url))"""),
        "term_counts": with_ctes("articles", f"""SELECT term, count(*) AS doc_count FROM (
            SELECT unnest({_terms("concat_ws(' ', title, summary)")}) AS term FROM articles) GROUP BY 1"""),
        "landing_round_trip": with_ctes("articles", _RAW_SELECT),
        "landing_counts": with_ctes("articles", f"""SELECT {day("d")} AS ingest_date, strftime(d, '%Y%m%d') || 'T120000Z' AS run_id,
            count(*) + count(*) FILTER (WHERE doc_id % 50 = 3) AS lines, count(*) FILTER (WHERE doc_id % 50 = 3) AS corrupt,
            count(url) AS with_url FROM (SELECT *, DATE '2026-08-14' - CAST(doc_id % 3 AS INT) AS d FROM articles) GROUP BY d"""),
        "landing_quarantine": f"""SELECT {day("d")} AS ingest_date, strftime(d, '%Y%m%d') || 'T120000Z' AS run_id,
            '{{"article_id": "cut-' || doc_id || '", "title": "half' AS line, true AS in_place
            FROM (SELECT doc_id, DATE '2026-08-14' - CAST(doc_id % 3 AS INT) AS d FROM documents WHERE doc_id % 50 = 3)""",
        "curated_round_trip": with_ctes("curated", _curated_select()),
        "curated_jsonl": with_ctes("curated", _curated_select()),
        "curated_csv": with_ctes("curated", _curated_select()),
        "stored_rollup": None, "stored_rollups": None, "stored_run_stats": None, "stored_feed_stats": None,
        "ingest_window": with_ctes("articles", """SELECT doc_id, published_at FROM articles WHERE published_ts IS NULL
            OR published_ts BETWEEN as_of - INTERVAL 3 DAY AND as_of + INTERVAL 12 HOUR"""),
        "unexpired_articles": with_ctes("enriched", f"""SELECT article_id, source_id, {stamp('published_ts')} AS published_ts, duplicate_count
            FROM (SELECT *, count(*) OVER (PARTITION BY title_key, published_date) AS duplicate_count,
              row_number() OVER (PARTITION BY title_key, published_date ORDER BY {{precedence}}) AS rn FROM (
              SELECT * FROM enriched WHERE title <> '' AND url <> '' AND {{gate}}
                AND published_ts BETWEEN as_of - INTERVAL 5 DAY AND as_of + INTERVAL 60 HOUR
              QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY {{precedence}}) = 1))
            WHERE rn = 1 OR length(title_key) < 15"""),
        "incremental_curation": with_ctes("curated", _curated_select()),
        "parity_check": with_ctes("curated", f"SELECT count(*) AS incremental_rows, count(*) AS one_shot_rows, 0 AS unlike_rows FROM ({_curated_select()})"),
    }
    sql["stored_rollup"] = sql["by_topic"]
    sql["stored_run_stats"], sql["stored_feed_stats"] = sql["ingest_stats"], sql["ingest_feed_stats"]
    sql["stored_rollups"] = " UNION ALL ".join(
        f"SELECT '{name}' AS rollup, {key} AS key, article_count, {more} FROM ({sql[name.replace('by_market_day', 'market_day')]})"
        for name, key, more in (
            ("by_market_day", "primary_market || '|' || published_date", "avg_relevance, source_count"),
            ("by_regulation", "regulation || '|' || primary_market", "NULL AS avg_relevance, NULL AS source_count"),
            ("by_topic", "topic", "avg_relevance, NULL"),
            ("by_pillar", "pillar || '|' || primary_market", "NULL, NULL"), ("by_source", "source_name", "NULL, NULL")))
    ranked_top = ("SELECT t.rank, t.article_id, s.section FROM (" + tops + ") t JOIN sectioned s USING (article_id)")
    sql["section_groups"] = with_ctes(
        "kept sectioned", "SELECT section, string_agg(rank || ':' || article_id, '|' ORDER BY rank) AS stories FROM ("
        + ranked_top + ") GROUP BY 1")
    # Ranks, positions and sizes are 32-bit integers in Spark.
    for name, columns in {
        "briefing_top20": ("rank",), "briefing_top20_eu": ("rank",), "near_dup_pairs": ("shared", "smaller"),
        "retry_prompts": ("rank",), "story_blocks": ("rank",), "report_glossary": ("position",),
        "uncited_articles": ("rank",),
    }.items():
        casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in columns)
        sql[name] = f"SELECT * REPLACE ({casts}) FROM ({sql[name]})"
    return sql


def date_text() -> str:
    """Date as the snapshot of a document writes it."""
    rfc = "strftime(published_ts, '%a, %d %b %Y %H:%M:%S +0000')"
    zulu = "strftime(published_ts, '%Y-%m-%dT%H:%M:%SZ')"
    return f"CASE WHEN doc_id % 4 IN (0, 3) THEN {rfc} ELSE {zulu} END"
