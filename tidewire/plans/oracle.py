"""DuckDB twins of the catalog, written from the semantics and not from the Spark plans."""

from tidewire.plans import tables as B
from tidewire.operators.metrics import LATENCY_BOUNDS, QUANTILES


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _shown(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


_NOW = f"TIMESTAMP '{B.NOW}'"
_SPACES = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_CONTROLS = r"\x00-\x08\x0E-\x1F\x7F-\x{84}\x{86}-\x{9F}"


def _collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{_SPACES}]+', ' ', 'g'))"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')"


def _norm(text: str) -> str:
    plain = f"regexp_replace(nfc_normalize({text}), '[{_CONTROLS}]', '', 'g')"
    return f"lower({_collapse(plain)})"


def _hash(title: str, body: str) -> str:
    return f"'sha256:' || sha256({title} || chr(10) || {body})"


_NEWS = """news AS (
  SELECT '1.0.0' AS schema_version, 'doc-' || doc_id AS id, 'replay' AS source, source AS feed,
         split_part(text, chr(10), 1) AS title, text AS body, lang AS language,
         TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS published_at,
         TIMESTAMP '2024-01-01' + to_minutes(doc_id) + to_seconds(1) AS ingested_at,
         doc_id AS arrival_seq
  FROM documents)"""

_FLAWED = _NEWS + """, flawed AS (
  SELECT CASE WHEN arrival_seq % 16 = 1 THEN '0.9.0' ELSE schema_version END AS schema_version,
         CASE WHEN arrival_seq % 16 = 2 THEN '' ELSE id END AS id,
         CASE WHEN arrival_seq % 16 IN (3, 8) THEN 'blog' ELSE source END AS source,
         CASE WHEN arrival_seq % 16 IN (4, 8) THEN '' ELSE title END AS title,
         CASE WHEN arrival_seq % 16 = 5 THEN '' ELSE body END AS body,
         CASE WHEN arrival_seq % 16 = 6 THEN NULL ELSE published_at END AS published_at,
         CASE WHEN arrival_seq % 16 = 7 THEN TIMESTAMP '0001-01-01' ELSE ingested_at END
           AS ingested_at,
         language, feed, arrival_seq
  FROM news)"""

_RAW_ERROR = """CASE WHEN schema_version <> '1.0.0' THEN 'schema_version is not 1.0.0'
    WHEN id = '' THEN 'id is required'
    WHEN source NOT IN ('replay', 'gdelt', 'rss') THEN 'invalid source'
    WHEN title = '' THEN 'title is required'
    WHEN body = '' THEN 'body is required'
    WHEN published_at IS NULL THEN 'published_at is required'
    WHEN ingested_at = TIMESTAMP '0001-01-01' THEN 'ingested_at is required' END"""


def _evaluated(source: str, error: str) -> str:
    return f"""evaluated AS (
  SELECT arrival_seq, id, source, feed, language, published_at, ingested_at, t AS title,
         b AS body, error,
         CASE WHEN error IS NOT NULL THEN NULL
              WHEN t = '' AND b = '' THEN 'empty'
              WHEN length(b) < 20 THEN 'too_short'
              WHEN language IS NOT NULL AND language <> '' AND language <> 'en'
                THEN 'language' END AS reason,
         {_hash('t', 'b')} AS content_hash
  FROM (SELECT * EXCLUDE (title, body), {error} AS error, {_norm('title')} AS t,
               {_norm('body')} AS b FROM {source})),
 decided AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN 'error' WHEN reason IS NOT NULL THEN 'filtered'
    WHEN row_number() OVER (PARTITION BY content_hash, error IS NULL AND reason IS NULL
                            ORDER BY arrival_seq) = 1 THEN 'emit'
    ELSE 'duplicate' END AS decision
  FROM evaluated)"""


_CLEAN_NEWS = _NEWS + ", " + _evaluated("news", "CAST(NULL AS VARCHAR)")
_FLAWED_NEWS = _FLAWED + ", " + _evaluated("flawed", _RAW_ERROR)


def _in_list(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def _model_text(title: str, body: str) -> str:
    t, b = _strip(title), _strip(body)
    return (
        f"CASE WHEN {t} <> '' AND {b} <> '' THEN {t} || '. ' || {b} ELSE {t} || {b} END"
    )


def _lexicon(source: str) -> str:
    """CTEs ending in ``lex``: the source's rows with label, score and probabilities."""
    return f"""tok AS (
  SELECT *, regexp_extract_all(lower({_model_text('title', 'body')}), '[a-z'']+') AS tokens
  FROM {source}),
 cnt AS (
  SELECT *, len(list_filter(tokens, lambda w: w IN {_in_list(B.POSITIVE)}))::DOUBLE AS np,
         len(list_filter(tokens, lambda w: w IN {_in_list(B.NEGATIVE)}))::DOUBLE AS nn FROM tok),
 prob AS (
  SELECT *, CASE WHEN np + nn > 0 THEN np / (np + nn) * ((np + nn) / (np + nn + 2)) ELSE 0 END AS pp,
         CASE WHEN np + nn > 0 THEN nn / (np + nn) * ((np + nn) / (np + nn + 2)) ELSE 0 END AS pn
  FROM cnt),
 lex AS (
  SELECT *, 1.0::DOUBLE - (pp + pn) AS pz, pp - pn AS score,
         CASE WHEN pp >= pn AND pp >= 1.0::DOUBLE - (pp + pn) THEN 'positive'
              WHEN pn >= 1.0::DOUBLE - (pp + pn) THEN 'negative' ELSE 'neutral' END AS label
  FROM prob)"""


_SCORED = (
    _CLEAN_NEWS
    + ", emitted AS (SELECT * FROM decided WHERE decision = 'emit'), "
    + _lexicon("emitted")
)


def _mentions(source: str) -> str:
    """CTE ``mention``: (arrival_seq, pos, type, name) in first-seen order, deduplicated."""
    hints = (
        f"SELECT arrival_seq, 0 AS pos, 'ticker' AS type, 'VON' AS name FROM {source} "
        f"WHERE arrival_seq % 10 = 0 UNION ALL "
        f"SELECT arrival_seq, 1, 'ticker', upper(feed) FROM {source} WHERE arrival_seq % 10 = 0"
    )
    found = []
    for i, (ticker, company) in enumerate(B.GAZETTEER.items()):
        text = "lower(title || ' ' || body)"
        found.append(
            f"SELECT arrival_seq, {10 + 2 * i}, 'company', {_q(company)} FROM {source} "
            f"WHERE contains({text}, {_q(company.lower())})"
        )
        found.append(
            f"SELECT arrival_seq, {11 + 2 * i}, 'ticker', {_q(ticker)} FROM {source} WHERE "
            f"regexp_matches({text}, '(^|[^\\p{{L}}\\p{{N}}_]){ticker.lower()}($|[^\\p{{L}}\\p{{N}}_])')"
        )
    union = " UNION ALL ".join([hints, *found])
    return (
        f"mention AS (SELECT arrival_seq, min(pos) AS pos, type, name FROM ({union}) "
        f"GROUP BY arrival_seq, type, name)"
    )


_SERIES = f"""sample AS (
  SELECT 'ev-' || event_id AS item_id, event_type AS entity, value AS score, ts AS t_at,
         event_id AS seq FROM events)"""


def _rolling(window_seconds: int) -> str:
    """CTE ``rolled`` from ``sample(item_id, entity, score, t_at, seq)``, by plain self-joins."""
    return f"""stepped AS (
  SELECT *, row_number() OVER w AS rn, score - lag(score) OVER w AS v, lag(t_at) OVER w AS prev_at
  FROM sample WINDOW w AS (PARTITION BY entity ORDER BY t_at, seq)),
 base AS (
  SELECT c.entity, c.seq, count(p.v) AS nb, avg(p.v) AS mean, stddev_pop(p.v) AS sd,
         min(p.v) AS lo, max(p.v) AS hi
  FROM stepped c LEFT JOIN stepped p
    ON p.entity = c.entity AND p.rn < c.rn AND p.prev_at >= c.t_at - to_seconds({window_seconds})
  GROUP BY c.entity, c.seq),
 counted AS (
  SELECT c.entity, c.seq, count(*) AS n FROM stepped c JOIN stepped p
    ON p.entity = c.entity AND p.rn <= c.rn AND p.t_at >= c.t_at - to_seconds({window_seconds})
  GROUP BY c.entity, c.seq),
 rolled AS (
  SELECT s.item_id, s.entity, s.seq, s.score, s.t_at, n, nb, mean,
         CASE WHEN lo = hi THEN 0 ELSE sd END AS sd,
         CASE WHEN s.prev_at >= s.t_at - to_seconds({window_seconds}) THEN s.v END AS v
  FROM stepped s JOIN base USING (entity, seq) JOIN counted USING (entity, seq))"""


def _shock_rows(window_seconds: int, threshold: float, min_samples: int) -> str:
    return f"""shock AS (
  SELECT entity, item_id, (v - mean) / sd AS zscore, v AS velocity, mean AS mean_velocity,
         sd AS std_velocity, {window_seconds} AS window_seconds,
         {threshold}::DOUBLE AS threshold, score AS sentiment_score, t_at AS triggered_at
  FROM rolled WHERE n >= {min_samples} AND sd > 0 AND abs((v - mean) / sd) >= {threshold})"""


_EVENT_SHOCKS = (
    f"{_SERIES}, {_rolling(B.WINDOW_SECONDS)}, "
    f"{_shock_rows(B.WINDOW_SECONDS, B.THRESHOLD, 8)}"
)
_SHOCK_SHOWN = f"""entity, item_id, round(zscore, 6) AS zscore, round(velocity, 6) AS velocity,
  round(mean_velocity, 8) AS mean_velocity, round(std_velocity, 6) AS std_velocity,
  window_seconds::BIGINT AS window_seconds, threshold,
  round(sentiment_score, 6) AS sentiment_score, {_shown('triggered_at')} AS triggered_at"""

_RESULTS = """results AS (
  SELECT 'ev-' || event_id AS item_id,
         CASE WHEN user_id % 3 = 0 THEN 'replay' WHEN user_id % 3 = 1 THEN 'gdelt'
              WHEN event_id % 2 = 0 THEN 'rss' END AS source,
         CASE event_type WHEN 'signup' THEN 'positive' WHEN 'error' THEN 'negative'
              WHEN 'view' THEN 'neutral' WHEN 'click' THEN NULL ELSE event_type END
           AS sentiment_label,
         value AS sentiment_score, value / 1000 AS prob_positive, value / 2000 AS prob_negative,
         1 - value / 1000 AS prob_neutral,
         CASE WHEN event_id % 2 = 0 THEN 'lexicon' ELSE 'onnx' END AS model_name,
         event_id % 2 <> 0 AS quantized, ts - to_hours(1) AS published_at, ts AS inferred_at
  FROM events)"""

_LINES = f"""lines AS (
  SELECT arrival_seq,
         CASE WHEN arrival_seq % 10 = 4 THEN '1.0.0' ELSE schema_version END AS schema_version,
         CASE WHEN arrival_seq % 10 <> 4 THEN id END AS id,
         'replay' AS source,
         CASE WHEN arrival_seq % 10 NOT IN (4, 5) THEN title END AS title,
         CASE WHEN arrival_seq % 10 <> 4 THEN body END AS body,
         CASE WHEN arrival_seq % 10 <> 4 THEN language END AS language,
         CASE WHEN arrival_seq % 10 NOT IN (4, 7) THEN published_at END AS published_at,
         CASE WHEN arrival_seq % 10 IN (4, 7) THEN 'decode error'
              WHEN arrival_seq % 10 = 5 THEN 'title is required' END AS error
  FROM news WHERE arrival_seq % 10 <> 3)"""

_GDELT = f"""articles AS (
  SELECT arrival_seq, 'https://news.example/' || id AS url, title, feed,
         CASE WHEN arrival_seq % 7 = 0 THEN {_NOW} ELSE published_at END AS published_at, language
  FROM news
  UNION ALL
  SELECT arrival_seq, 'https://more.example/' || id, title, feed,
         CASE WHEN arrival_seq % 7 = 0 THEN {_NOW} ELSE published_at END, ''
  FROM news WHERE arrival_seq % 3 <> 0 AND arrival_seq % 5 <> 0),
 gdelt AS (
  SELECT arrival_seq, 'gdelt-' || substr(sha1(url), 1, 16) AS id, 'gdelt' AS source, feed, url,
         {_strip('title')} AS title, {_strip('title')} AS body, language, published_at
  FROM articles WHERE {_strip('title')} <> '')"""

_RSS = f"""rss_rows AS (
  SELECT arrival_seq,
         CASE WHEN arrival_seq % 2 = 0 THEN 'guid-' || id ELSE 'https://feed.example/' || id END
           AS uniq,
         'https://feed.example/rss/' || feed AS feed, 'https://feed.example/' || id AS url,
         {_strip('title')} AS title, {_collapse("'A&B ' || body")} AS body, language,
         published_at - to_hours(1) AS published_at
  FROM news
  UNION ALL
  SELECT arrival_seq, 'https://feed.example/rss/' || feed || '|' || {_strip("'Re: ' || title")},
         'https://feed.example/rss/' || feed, '', {_strip("'Re: ' || title")},
         {_strip("'Re: ' || title")}, language, {_NOW}
  FROM news),
 rss AS (
  SELECT arrival_seq, 'rss-' || substr(sha1(uniq), 1, 16) AS id, 'rss' AS source, feed, url,
         title, body, language, published_at
  FROM rss_rows WHERE title <> '')"""

_ATOM = f"""atom_rows AS (
  SELECT arrival_seq, id AS doc, 'https://atom.example/feed/' || feed AS feed,
         CASE WHEN arrival_seq % 3 <> 0 THEN 'https://atom.example/' || id
              ELSE 'https://atom.example/self/' || id END AS url,
         {_strip('title')} AS title,
         CASE WHEN arrival_seq % 4 = 0 THEN {_collapse('body')}
              ELSE {_collapse("'About ' || body")} END AS body,
         language, published_at
  FROM news),
 atom AS (
  SELECT arrival_seq,
         'rss-' || substr(sha1(CASE WHEN arrival_seq % 2 = 0 THEN 'tag:' || doc ELSE url END), 1, 16)
           AS id,
         'rss' AS source, feed, url, title, body, language, published_at
  FROM atom_rows WHERE title <> '')"""

_FEED_SHOWN = (
    f"arrival_seq, id, source, feed, url, title, body, language, "
    f"{_shown('published_at')} AS published_at, {_shown(_NOW)} AS ingested_at"
)

_BUCKETS = "buckets AS (" + " UNION ALL ".join(
    f"SELECT event_type AS variant, {bound} AS le, "
    f"count(*) FILTER (value / 100 <= {bound}) AS cumulative FROM events GROUP BY 1"
    for bound in [*(f"{b}::DOUBLE" for b in LATENCY_BOUNDS), "'infinity'::DOUBLE"]
) + ")"

_INCREASES = """moved AS (
  SELECT 'stage-' || (user_id % 3) AS stage, ts, (event_id % 1000)::DOUBLE AS value,
         lag((event_id % 1000)::DOUBLE) OVER (PARTITION BY user_id % 3, event_type
                                              ORDER BY ts, event_id) AS prev
  FROM events)"""

ORACLE_SQL: dict[str, str] = {
    "scan_replay": f"""WITH {_NEWS}, {_LINES}
SELECT arrival_seq, schema_version, id, source, title, body, language,
  {_shown('published_at')} AS published_at, {_shown(_NOW)} AS ingested_at, error FROM lines""",
    # Here nothing fills defaults or stamps a time, so every decodable line lacks ingested_at.
    "quarantine": f"""WITH {_NEWS}, labelled AS (
  SELECT arrival_seq, CASE
    WHEN arrival_seq % 10 IN (3, 4, 7) THEN 'decode error'
    WHEN arrival_seq % 10 = 6 THEN 'schema_version is not 1.0.0'
    WHEN arrival_seq % 10 = 5 THEN 'title is required'
    ELSE 'ingested_at is required' END AS error FROM news)
SELECT error, count(*) AS rows, min(arrival_seq) AS first_seq FROM labelled GROUP BY error""",
    "gdelt_articles": f"WITH {_NEWS}, {_GDELT} SELECT {_FEED_SHOWN} FROM gdelt",
    "rss_items": f"WITH {_NEWS}, {_RSS} SELECT {_FEED_SHOWN} FROM rss",
    "atom_entries": f"WITH {_NEWS}, {_ATOM} SELECT {_FEED_SHOWN} FROM atom",
    "feed_kind": """SELECT doc_id AS arrival_seq,
  CASE WHEN doc_id % 2 = 1 THEN 'rss' ELSE 'atom' END AS kind FROM documents""",
    "quarantine_feeds": """SELECT doc_id AS arrival_seq, 'decode error' AS error FROM documents
WHERE doc_id % 5 = 0""",
    "quarantine_gdelt": """SELECT doc_id AS arrival_seq, 'decode error' AS error FROM documents
WHERE doc_id % 7 = 0""",
    "unscorable": f"""WITH {_NEWS}
SELECT id AS item_id, CASE WHEN length({_model_text('title', 'body')}) % 11 = 0 THEN 'model error'
  ELSE '-' END AS error FROM news""",
    "fan_in_sources": f"""WITH {_NEWS}, {_LINES}, {_GDELT}, {_RSS}, {_ATOM}
SELECT source, language, count(*) AS items, sum(length(body))::BIGINT AS body_chars FROM (
  SELECT source, language, body FROM lines WHERE error IS NULL
  UNION ALL SELECT source, language, body FROM gdelt
  UNION ALL SELECT source, language, body FROM rss WHERE arrival_seq % 2 = 1
  UNION ALL SELECT source, language, body FROM atom WHERE arrival_seq % 2 = 0)
GROUP BY source, language""",
    "source_modes": f"""WITH {_NEWS}, {_LINES}, {_GDELT}
SELECT source, language, count(*) AS items, sum(length(body))::BIGINT AS body_chars FROM (
  SELECT source, language, body FROM lines WHERE error IS NULL
  UNION ALL SELECT source, language, body FROM gdelt) GROUP BY source, language""",
    "validate_raw": f"WITH {_FLAWED} SELECT arrival_seq, {_RAW_ERROR} AS error FROM flawed",
    "validate_processed": f"""WITH {_FLAWED}
SELECT arrival_seq, CASE WHEN schema_version <> '1.0.0' THEN 'schema_version is not 1.0.0'
    WHEN id = '' THEN 'id is required'
    WHEN arrival_seq % 5 = 0 THEN 'content_hash does not match sha256:<64 hex>'
    WHEN source NOT IN ('replay', 'gdelt', 'rss') THEN 'invalid source'
    WHEN title = '' THEN 'title is required'
    WHEN body = '' THEN 'body is required'
    WHEN published_at IS NULL THEN 'published_at is required'
    WHEN ingested_at = TIMESTAMP '0001-01-01' THEN 'ingested_at is required'
    WHEN arrival_seq % 11 = 0 THEN 'processed_at is required' END AS error FROM flawed""",
    "contract_strict": """SELECT doc_id AS arrival_seq, CASE doc_id % 9
    WHEN 1 THEN 'missing property: title' WHEN 2 THEN 'unknown property'
    WHEN 3 THEN 'malformed language' WHEN 4 THEN 'unknown source'
    WHEN 5 THEN 'wrong type: id' WHEN 6 THEN 'empty id' WHEN 7 THEN 'not a JSON object'
    WHEN 8 THEN 'wrong schema_version' END AS violation FROM documents""",
    "decode_processed": f"""WITH {_NEWS}
SELECT arrival_seq, CASE WHEN c <> 7 THEN id END AS id,
  CASE WHEN c <> 7 THEN {_hash('title', 'body')} END AS content_hash,
  CASE WHEN c <> 7 THEN title END AS title,
  CASE WHEN c NOT IN (5, 7) THEN {_shown('''CASE WHEN c = 4
    THEN published_at + to_milliseconds(250) - to_hours(2) ELSE published_at END''')} END
    AS published_at,
  CASE WHEN c <> 7 THEN {_shown(_NOW)} END AS processed_at,
  CASE WHEN c = 6 THEN feed || ',' || language ELSE '' END AS tickers,
  CASE c WHEN 1 THEN 'unsupported schema_version' WHEN 2 THEN 'missing required field: body'
    WHEN 5 THEN 'decode error' WHEN 7 THEN 'decode error' END AS error
FROM (SELECT *, arrival_seq % 8 AS c FROM news)""",
    "to_wire_json": f"""WITH {_NEWS}
SELECT id AS key, '{{"schema_version":"1.0.0","id":' || to_json(id) || ',"source":"replay","feed":'
  || to_json(feed) || ',"title":' || to_json(title) || ',"body":' || to_json(body)
  || ',"language":' || to_json(language) || ',"published_at":"' || {_iso('published_at')}
  || '","ingested_at":"' || {_iso('ingested_at')} || '"}}' AS value FROM news""",
    "process_decisions": f"""WITH {_FLAWED_NEWS}
SELECT arrival_seq, decision, reason, error FROM decided""",
    "process_news": f"""WITH {_CLEAN_NEWS}
SELECT '1.0.0' AS schema_version, id, content_hash, source, feed, title, body, language,
  {_shown('published_at')} AS published_at, {_shown('ingested_at')} AS ingested_at,
  {_shown(_NOW)} AS processed_at, arrival_seq FROM decided WHERE decision = 'emit'""",
    "dedup_content": f"""WITH {_NEWS}
SELECT min(arrival_seq) AS arrival_seq, content_hash
FROM (SELECT arrival_seq, {_hash('title', 'body')} AS content_hash FROM news)
GROUP BY content_hash""",
    "filter_reason": f"""WITH {_NEWS}, varied AS (
  SELECT arrival_seq, CASE WHEN arrival_seq % 13 = 0 THEN '' ELSE {_norm('title')} END AS t,
    CASE WHEN arrival_seq % 13 = 0 THEN '' ELSE {_norm('body')} END AS b,
    CASE WHEN arrival_seq % 7 <> 0 THEN language END AS l FROM news)
SELECT arrival_seq, CASE WHEN t = '' AND b = '' THEN 'empty' WHEN length(b) < 20 THEN 'too_short'
  WHEN l <> 'en' THEN 'language' END AS reason FROM varied""",
    "process_stats": f"""WITH {_FLAWED_NEWS}
SELECT count(*) AS consumed, count(*) FILTER (decision = 'emit') AS processed,
  count(*) FILTER (decision = 'duplicate') AS duplicates,
  count(*) FILTER (decision = 'filtered') AS filtered,
  count(*) FILTER (decision = 'error') AS errors FROM decided""",
    "filtered_by_reason": f"""WITH {_FLAWED_NEWS}
SELECT reason, count(*) AS dropped FROM decided WHERE reason IS NOT NULL GROUP BY reason""",
    "seen_anti_join": """WITH keyed AS (
  SELECT doc_id, 'rss-' || substr(sha1(lower(text)), 1, 16) AS id FROM documents)
SELECT min(doc_id) AS arrival_seq, id FROM keyed WHERE doc_id % 2 = 1
  AND id NOT IN (SELECT id FROM keyed WHERE doc_id % 2 = 0) GROUP BY id""",
    "normalize_text": f"""SELECT doc_id AS arrival_seq, {_norm('''CASE WHEN doc_id % 4 = 0
  THEN '  ' || chr(12288) || 'A' || chr(1) || chr(769) || text || chr(133) || chr(9) || chr(304)
       || chr(931) || ' ' || chr(7) || ' E' || chr(769) || ' ' ELSE text END''')} AS normalized
FROM documents""",
    "content_hash": f"""WITH {_NEWS}
SELECT arrival_seq, {_hash('title', 'body')} AS content_hash FROM news""",
    "hash_id": "SELECT page_id, 'gdelt-' || substr(sha1(url), 1, 16) AS id FROM pages",
    "normalize_lang": """SELECT doc_id AS arrival_seq, CASE doc_id % 7 WHEN 0 THEN 'en'
  WHEN 3 THEN '' WHEN 4 THEN '-en' WHEN 5 THEN 'french' ELSE lang END AS language FROM documents""",
    "clean_text": f"""SELECT page_id, {_collapse('''regexp_replace(replace(replace(replace(
    regexp_replace(html, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'),
    '&amp;?', '&', 'g')''')} AS text FROM pages""",
    "parse_feed_date": f"""WITH {_NEWS}
SELECT arrival_seq, {_shown('''CASE arrival_seq % 8
    WHEN 0 THEN published_at WHEN 1 THEN published_at
    WHEN 2 THEN published_at + to_minutes(150)
    WHEN 3 THEN published_at WHEN 4 THEN published_at
    WHEN 5 THEN published_at - to_minutes(330)
    WHEN 6 THEN published_at - to_hours(1) END''')} AS parsed FROM news""",
    "model_text": f"""WITH {_NEWS}
SELECT arrival_seq, CASE arrival_seq % 3 WHEN 0 THEN {_strip('body')} WHEN 1 THEN {_strip('title')}
  ELSE {_model_text('title', 'body')} END AS model_text FROM news""",
    "lexicon_tokens": """SELECT doc_id AS arrival_seq, len(t)::BIGINT AS n_tokens,
  array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z'']+') AS t FROM documents)""",
    "lexicon_sentiment": f"""WITH {_NEWS}, {_lexicon('news')}
SELECT arrival_seq, label, round(score, 6) AS score, round(pp, 6) AS prob_positive,
  round(pn, 6) AS prob_negative, round(pz, 6) AS prob_neutral FROM lex""",
    "softmax_label": """WITH l AS (
  SELECT vec_id, list_sum(list_filter(v, lambda x, i: i % 3 = 1)) AS a,
    list_sum(list_filter(v, lambda x, i: i % 3 = 2)) AS b,
    list_sum(list_filter(v, lambda x, i: i % 3 = 0)) AS c
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)),
 e AS (SELECT vec_id, exp(a - greatest(a, b, c)) AS n, exp(b - greatest(a, b, c)) AS z,
         exp(c - greatest(a, b, c)) AS p FROM l),
 s AS (SELECT vec_id, n / (n + z + p) AS pn, z / (n + z + p) AS pz, p / (n + z + p) AS pp FROM e)
SELECT vec_id, CASE WHEN pn >= pz AND pn >= pp THEN 'negative' WHEN pz >= pp THEN 'neutral'
    ELSE 'positive' END AS label, round(pp - pn, 6) AS score, round(pp, 6) AS prob_positive,
  round(pn, 6) AS prob_negative, round(pz, 6) AS prob_neutral FROM s""",
    "label_sign": f"""WITH {_RESULTS}
SELECT item_id, CASE sentiment_label WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0.0::DOUBLE
  WHEN 'negative' THEN -1.0::DOUBLE END AS sign FROM results""",
    "sentiment_results": f"""WITH {_SCORED}
SELECT id AS item_id, content_hash, source, label AS sentiment_label,
  round(score, 6) AS sentiment_score, round(pp, 6) AS prob_positive, round(pn, 6) AS prob_negative,
  round(pz, 6) AS prob_neutral, 'heuristic-lexicon-v1' AS model_name, false AS quantized,
  {_shown('published_at')} AS published_at,
  {_shown('published_at + to_seconds(5)')} AS inferred_at FROM lex""",
    "entity_sentiments": f"""WITH {_SCORED}, {_mentions('emitted')}
SELECT id AS item_id, name AS entity, type AS entity_type, round(score, 6) AS sentiment_score,
  {_shown('published_at')} AS published_at,
  {_shown('published_at + to_seconds(5)')} AS inferred_at
FROM lex JOIN mention USING (arrival_seq)""",
    "result_json": f"""WITH {_SCORED}, {_mentions('emitted')}
SELECT id, label AS sentiment_label, round(score, 6) AS sentiment_score,
  round(pp, 6) AS positive, round(pn, 6) AS negative, round(pz, 6) AS neutral,
  (SELECT count(*) FROM mention m WHERE m.arrival_seq = lex.arrival_seq) AS n_entities,
  false AS quantized,
  strftime(published_at + to_seconds(5), '%Y-%m-%dT%H:%M:%S+00:00') AS inferred_at FROM lex""",
    "extract_entities": f"""WITH {_NEWS}, {_mentions('news')}
SELECT id, coalesce(string_agg(type || ':' || name, '|' ORDER BY pos), '') AS entities
FROM news LEFT JOIN mention USING (arrival_seq) GROUP BY id""",
    "sentiment_velocity": """SELECT 'ev-' || event_id AS item_id, event_type AS entity,
  round(value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS velocity
FROM events""",
    "rolling_velocity_stats": f"""WITH {_SERIES}, {_rolling(B.WINDOW_SECONDS)}
SELECT item_id, n AS n_samples, nb AS n_baseline, round(v, 6) AS velocity,
  round(mean, 8) AS mean_velocity, round(sd, 6) AS std_velocity FROM rolled""",
    "shocks": f"WITH {_EVENT_SHOCKS} SELECT {_SHOCK_SHOWN} FROM shock",
    "document_shocks": f"""WITH {_SCORED}, {_mentions('emitted')}, sample AS (
  SELECT DISTINCT id AS item_id, name AS entity, score, published_at + to_seconds(5) AS t_at,
    arrival_seq AS seq FROM lex JOIN mention USING (arrival_seq)),
 {_rolling(6 * 3600)}, {_shock_rows(6 * 3600, 2.0, 8)}
SELECT {_SHOCK_SHOWN} FROM shock""",
    "recent_entity_samples": f"""SELECT {_shown('ts')} AS inferred_at, event_id AS arrival_seq,
  round(value, 6) AS sentiment_score FROM events WHERE event_type = 'purchase'
  AND ts BETWEEN TIMESTAMP '2024-01-17 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "recent_results": f"""WITH {_RESULTS}
SELECT item_id, source, sentiment_label, round(sentiment_score, 6) AS sentiment_score,
  round(prob_positive, 6) AS prob_positive, round(prob_negative, 6) AS prob_negative,
  round(prob_neutral, 6) AS prob_neutral, model_name, quantized,
  {_shown('published_at')} AS published_at, {_shown('inferred_at')} AS inferred_at
FROM (SELECT * FROM results ORDER BY inferred_at DESC, item_id LIMIT 500)""",
    "recent_shocks": f"""WITH {_EVENT_SHOCKS}
SELECT {_SHOCK_SHOWN} FROM (
  SELECT * FROM shock ORDER BY triggered_at DESC, entity, item_id LIMIT 100)""",
    "display_items": f"""WITH {_RESULTS}
SELECT {_shown('inferred_at')} AS inferred_at, source, sentiment_label,
  round(sentiment_score, 3) AS sentiment_score, item_id
FROM results ORDER BY results.inferred_at DESC, item_id LIMIT 100""",
    "display_shocks": f"""WITH {_EVENT_SHOCKS}
SELECT {_shown('triggered_at')} AS triggered_at, entity, round(zscore, 2) AS zscore,
  round(velocity, 3) AS velocity, round(sentiment_score, 3) AS sentiment_score, item_id
FROM (SELECT * FROM shock ORDER BY triggered_at DESC, entity, item_id LIMIT 200)""",
    "stream_process_news": f"""WITH {_CLEAN_NEWS}
SELECT content_hash, title, body, language FROM decided WHERE decision = 'emit'""",
    "stream_timeline": f"""SELECT {_shown('bucket')} AS bucket, round(avg(value), 8) AS avg_sentiment,
  count(*) AS volume
FROM (SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS bucket, value FROM events) GROUP BY bucket""",
    "model_fallback": f"""WITH {_NEWS}, {_lexicon('news')}
SELECT arrival_seq, 'heuristic-lexicon-v1' AS model_name, label, round(score, 6) AS score FROM lex""",
    "model_sentiment": f"""WITH {_NEWS}, w AS (
  SELECT arrival_seq, unnest(list_filter(string_split_regex(lower({_model_text('title', 'body')}),
    '\\s+'), lambda x: x <> '')) AS word FROM news),
 b AS (SELECT arrival_seq, ('0x' || substr(md5(word), 1, 4))::INT % 64 AS bucket FROM w),
 l AS (SELECT arrival_seq, 0.3141 + avg(((bucket * 37) % 23 - 11) / 2.0) AS neg,
         avg(((bucket * 37 + 11) % 23 - 11) / 2.0) AS neu,
         0.1234 + avg(((bucket * 37 + 22) % 23 - 11) / 2.0) AS pos FROM b GROUP BY arrival_seq),
 p AS (SELECT arrival_seq, coalesce(neg, 0.3141) AS neg, coalesce(neu, 0.0) AS neu, coalesce(pos, 0.1234) AS pos
       FROM news LEFT JOIN l USING (arrival_seq))
SELECT arrival_seq, CASE WHEN neg >= neu AND neg >= pos THEN 'negative' WHEN neu >= pos THEN 'neutral'
    ELSE 'positive' END AS label,
  round((exp(pos) - exp(neg)) / (exp(neg) + exp(neu) + exp(pos)), 6) AS score,
  round(exp(pos) / (exp(neg) + exp(neu) + exp(pos)), 6) AS prob_positive,
  round(exp(neg) / (exp(neg) + exp(neu) + exp(pos)), 6) AS prob_negative,
  round(exp(neu) / (exp(neg) + exp(neu) + exp(pos)), 6) AS prob_neutral FROM p""",
    "stream_replay_rate": f"""WITH {_NEWS}, {_LINES}
SELECT arrival_seq, true AS in_rate, id, error FROM lines""",
    "recent_samples_bulk": f"""WITH asks AS (
  SELECT DISTINCT event_type AS entity, date_trunc('hour', ts) AS as_of FROM events)
SELECT entity, {_shown('as_of')} AS as_of, {_shown('ts')} AS inferred_at, event_id AS arrival_seq,
  round(value, 6) AS sentiment_score
FROM asks JOIN events ON event_type = entity AND ts BETWEEN as_of - INTERVAL 2 HOURS AND as_of""",
    "stream_late_rows": """WITH r AS (
  SELECT doc_id, TIMESTAMP '2024-01-01' + to_minutes(doc_id - CASE WHEN doc_id % 7 = 0 THEN 4320
    WHEN doc_id % 5 = 0 THEN 75 ELSE 0 END) AS ts,
    doc_id * 8 // (SELECT max(doc_id) + 1 FROM documents) AS batch FROM documents),
 w AS (SELECT batch, max(max(ts)) OVER (
         ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark
       FROM r GROUP BY batch)
SELECT 'doc-' || doc_id AS id, coalesce(ts < mark, false) AS late FROM r JOIN w USING (batch)""",
    "stream_scored_tables": f"""WITH {_SCORED}, {_mentions('emitted')}
SELECT id AS item_id, label AS sentiment_label, round(score, 6) AS sentiment_score,
  (SELECT count(*) FROM mention m WHERE m.arrival_seq = lex.arrival_seq) AS n_entities FROM lex""",
    "stream_ingest": f"""WITH {_NEWS}, {_LINES}
SELECT id AS key, source FROM lines WHERE error IS NULL""",
    "stream_dedup": f"""WITH {_CLEAN_NEWS}
SELECT content_hash, length(body) AS body_chars FROM decided WHERE decision = 'emit'""",
    "label_distribution": f"""WITH {_RESULTS}
SELECT sentiment_label AS label, count(*) AS count FROM results
WHERE sentiment_label IS NOT NULL GROUP BY 1""",
    "source_distribution": f"""WITH {_RESULTS}
SELECT source, count(*) AS count FROM results WHERE source IS NOT NULL GROUP BY 1""",
    "global_stats": f"""WITH {_EVENT_SHOCKS}
SELECT (SELECT count(*) FROM events) AS total_scored, (SELECT count(*) FROM shock) AS total_shocks,
  (SELECT round(avg(value), 8) FROM events) AS avg_sentiment""",
    "kpis": f"""WITH {_EVENT_SHOCKS}, newest AS (
  SELECT * FROM events ORDER BY date_trunc('hour', ts) DESC, 'ev-' || event_id LIMIT 1)
SELECT (SELECT count(*) FROM events) AS total_scored,
  (SELECT count(*) FROM events WHERE date_trunc('hour', ts) >= {_NOW} - to_minutes(5)) AS scored_last_5m,
  (SELECT count(*) FROM shock) AS shocks_flagged,
  (SELECT round(avg(value), 8) FROM events) AS avg_sentiment,
  (SELECT CASE WHEN event_id % 2 = 0 THEN 'lexicon' ELSE 'onnx' END FROM newest) AS model_name,
  (SELECT event_id % 2 <> 0 FROM newest) AS quantized""",
    "sentiment_timeline": f"""WITH agg AS (
  SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS bucket, avg(value) AS a, count(*) AS n
  FROM events GROUP BY 1),
 spine AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 15 MINUTES)) AS bucket
           FROM agg)
SELECT {_shown('spine.bucket')} AS bucket, round(coalesce(a, 0), 8) AS avg_sentiment,
  coalesce(n, 0) AS volume FROM spine LEFT JOIN agg ON spine.bucket = agg.bucket""",
    "document_sentiment_mix": f"""WITH {_SCORED}
SELECT label, count(*) AS count FROM lex GROUP BY label""",
    "latency_histogram": f"""WITH {_BUCKETS}
SELECT variant, CASE WHEN le = 'infinity'::DOUBLE THEN '+Inf' ELSE le::VARCHAR END AS le, cumulative
FROM buckets""",
    "histogram_quantile": f"""WITH {_BUCKETS}, edges AS (
  SELECT *, coalesce(lag(le) OVER w, 0) AS lo, coalesce(lag(cumulative) OVER w, 0) AS c0,
    max(cumulative) OVER (PARTITION BY variant) AS total,
    max(CASE WHEN le < 'infinity'::DOUBLE THEN le END) OVER (PARTITION BY variant) AS top
  FROM buckets WINDOW w AS (PARTITION BY variant ORDER BY le)),
 hit AS (
  SELECT variant, quantile, arg_min(struct_pack(le := le, lo := lo, c0 := c0, c := cumulative,
      total := total, top := top), le) AS h
  FROM edges, (SELECT unnest([{', '.join(f'{q}::DOUBLE' for q in QUANTILES)}]) AS quantile)
  WHERE cumulative >= quantile * total GROUP BY variant, quantile)
SELECT variant, quantile, round(CASE WHEN h.le = 'infinity'::DOUBLE THEN h.top
    ELSE h.lo + (h.le - h.lo) * (quantile * h.total - h.c0) / (h.c - h.c0) END, 6) AS value FROM hit""",
    "counter_rate": f"""WITH {_INCREASES}
SELECT stage, {_shown("date_trunc('minute', ts)")} AS window_start,
  round(sum(CASE WHEN value < prev THEN value ELSE value - prev END) / 60, 6) AS per_second
FROM moved WHERE prev IS NOT NULL GROUP BY 1, 2""",
    "error_rate": f"""SELECT 'stage-' || (user_id % 3) AS stage,
  {_shown('time_bucket(INTERVAL 15 MINUTES, ts)')} AS window_start, count(*) AS handled,
  count(*) FILTER (event_type = 'error') AS errors,
  round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate
FROM events GROUP BY 1, 2""",
    "throughput_by_label": f"""WITH {_RESULTS}
SELECT {_shown('time_bucket(INTERVAL 15 MINUTES, inferred_at)')} AS window_start,
  sentiment_label AS label, count(*) AS scored FROM results GROUP BY 1, 2""",
    "consumer_lag": """WITH p AS (
  SELECT user_id, max(event_id) AS high,
    coalesce(max(event_id) FILTER (event_type = 'click'), -1) AS pos FROM events GROUP BY user_id)
SELECT 'topic-' || (user_id % 3) AS topic,
  coalesce(sum(CASE WHEN pos >= 0 THEN greatest(high - pos, 0) END), 0)::BIGINT AS lag
FROM p GROUP BY 1""",
    "latency_summary": """SELECT event_type AS variant, count(*) AS calls,
  round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms,
  round(avg(value), 6) AS mean_ms,
  round(sum(user_id % 16 + 1) / (sum(value) / 1000), 6) AS items_per_s
FROM events GROUP BY 1""",
    "variant_comparison": """WITH s AS (
  SELECT event_type AS variant, quantile_cont(value, 0.5) AS p50,
    sum(user_id % 16 + 1) / (sum(value) / 1000) AS rate FROM events GROUP BY 1)
SELECT round(a.p50 / b.p50, 6) AS p50_ratio, round(b.rate / a.rate, 6) AS throughput_ratio
FROM s a, s b WHERE a.variant = 'click' AND b.variant = 'view'""",
}
ORACLE_SQL["extract_entities_joined"] = ORACLE_SQL["extract_entities"]
ORACLE_SQL["stream_shocks"] = ORACLE_SQL["shocks"]
ORACLE_SQL["stream_process_stats"] = ORACLE_SQL["process_stats"]
ORACLE_SQL["stream_news_shocks"] = ORACLE_SQL["document_shocks"]
ORACLE_SQL["shocks_sliced"] = ORACLE_SQL["shocks"]
