"""DuckDB twins of the corpus queries that SQL can express, written from the contracts."""

from tidewire.llm import divergence, filter_audit
from tidewire.llm.license_scan import COVERAGE, DRIFTS, GRAM, LEAST_HELD, PHRASES, TEMPLATES
from tidewire.llm.line_dedup import MIN_SITES
from tidewire.llm.near_dedup import PERCENT
from tidewire.llm.quality_rules import Limits

_L = Limits()
_SPACES = "[\\x20\\x09-\\x0D]+"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_SPACES}'), lambda w: w <> '')"


def _rule(value: str, limit: float) -> str:
    return f"CASE WHEN {value} > {2 * limit} THEN 2 WHEN {value} > {limit} THEN 1 ELSE 0 END"


_PHRASES = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES)
_GRAMS = ", ".join(
    f"({i}, '{label}', {len(ws) - GRAM + 1}, {at}, '{' '.join(ws[at: at + GRAM])}')"
    for i, (label, ws) in enumerate((label, text.split()) for label, text in TEMPLATES)
    for at in range(len(ws) - GRAM + 1)
)

_DRIFT = "CASE " + " ".join(
    f"WHEN n_grams < {below} THEN {drift}" for below, drift in DRIFTS) + " END"

ORACLE_SQL: dict[str, str] = {
    "op1_host_quality_rules": f"""WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, {_words('text')} AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
       FROM t),
 starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
 windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS x FROM starts),
 twice AS (SELECT doc_id, unnest(list(i)) AS i FROM windows GROUP BY doc_id, x HAVING count(*) > 1),
 covered AS (SELECT doc_id, count(*) AS n FROM (
   SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
 c AS (SELECT doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         greatest(len(ls), 1) AS lines, greatest(len(ws), 1) AS words,
         len(regexp_extract_all(text, '\\p{{Lu}}{{2}}')) AS shouts
       FROM w LEFT JOIN covered USING (doc_id)),
 p AS (SELECT *, n_words < {_L.min_words} OR 100 * n_repeat_words > {_L.repeat_percent} * n_words
           AS base_failed,
         {_rule('n_symbols / words', _L.symbols_per_word)} + {_rule('shouts / words', _L.shouts_per_word)}
         + {_rule('n_dup_lines / lines', _L.dup_line_share)}
         + {_rule('n_repeat_words / words', _L.soft_repeat_share)}
         + CASE WHEN word_chars / words < {_L.word_length[0]} OR word_chars / words > {_L.word_length[1]}
           THEN 1 ELSE 0 END AS points FROM c),
 h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed OR points >= 2)::DOUBLE AS f
       FROM p GROUP BY source),
 m AS (SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square, sum(n) AS docs,
         count(*) AS hosts FROM h),
 k AS (SELECT mean, greatest({_L.prior_docs}, CASE
         WHEN square - mean * mean - mean * (1 - mean) * hosts / docs > 0
         THEN mean * (1 - mean) / (square - mean * mean - mean * (1 - mean) * hosts / docs) - 1
         ELSE docs / hosts END) AS weight FROM m),
 v AS (SELECT source, (f + weight * mean) / (n + weight) AS rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, points,
  CASE WHEN rate > {_L.rejected} THEN 'rejected' WHEN rate > {_L.watched} THEN 'watched'
    ELSE 'trusted' END AS host_verdict,
  NOT base_failed AND points <= CASE WHEN rate > {_L.rejected} THEN -1 WHEN rate > {_L.watched} THEN 0
    ELSE 1 END AS kept
FROM p JOIN v ON p.source IS NOT DISTINCT FROM v.source""",
    "op4_minhash_near_dedup": f"""WITH RECURSIVE w AS (
  SELECT doc_id, list_transform({_words("coalesce(text, '')")},
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws
  FROM documents),
 places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS x FROM places),
 n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
 common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
           WHERE 100 * shared >= {PERCENT} * (na.size + nb.size - shared)),
 reached AS (SELECT DISTINCT a AS doc_id, a AS other FROM links
             UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a),
 least AS (SELECT doc_id, min(other) AS root FROM reached GROUP BY doc_id)
SELECT w.doc_id, coalesce(size, 0) AS n_shingles, coalesce(root, w.doc_id) AS component_id,
  coalesce(root, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op5_license_scan": f"""WITH phrases(phrase, k, label) AS (VALUES {_PHRASES}),
 grams(template, label, n_grams, gram_at, gram) AS (VALUES {_GRAMS}),
 w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
 places AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
 base AS (SELECT doc_id, i - 1 AS place, label FROM places JOIN phrases
          ON array_to_string(ws[i:i + k - 1], ' ') = phrase),
 b AS (SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word,
         list_distinct(list(label)) AS labels FROM base GROUP BY doc_id),
 hits AS (SELECT DISTINCT doc_id, template, label, n_grams, gram_at, i - 1 - gram_at AS diagonal,
     {_DRIFT} AS drift,
     greatest(ceil({COVERAGE} * n_grams), least(n_grams, {LEAST_HELD})) AS least
   FROM places JOIN grams ON array_to_string(ws[i:i + {GRAM - 1}], ' ') = gram),
 votes AS (SELECT doc_id, template, drift, diagonal, count(*) AS n FROM hits GROUP BY ALL),
 bands AS (SELECT a.doc_id, a.template, a.diagonal AS band,
     arg_max(v.diagonal, 1000 * v.n - (v.diagonal - a.diagonal)) AS main
   FROM votes a JOIN votes v ON a.doc_id = v.doc_id AND a.template = v.template
     AND v.diagonal BETWEEN a.diagonal AND a.diagonal + a.drift
   GROUP BY a.doc_id, a.template, a.diagonal),
 placed AS (SELECT h.doc_id, h.template, label, n_grams, least, band, gram_at,
     gram_at + arg_min(diagonal, 1000 * abs(diagonal - main) + diagonal - band) AS place
   FROM hits h JOIN bands b ON h.doc_id = b.doc_id AND h.template = b.template
     AND h.diagonal BETWEEN band AND band + drift
   GROUP BY h.doc_id, h.template, label, n_grams, least, band, gram_at),
 ordered AS (SELECT *, max(place) OVER (PARTITION BY doc_id, template, band ORDER BY gram_at
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM placed),
 spans AS (SELECT doc_id, template, label, band, n_grams, count(*) AS held, min(place) AS first,
     max(place) + {GRAM - 1} AS last, count(*) / n_grams AS share
   FROM ordered WHERE reached IS NULL OR place > reached
   GROUP BY doc_id, template, label, band, n_grams, least HAVING count(*) >= least),
 held AS (SELECT * FROM spans s WHERE NOT EXISTS (SELECT 1 FROM spans t
   WHERE t.doc_id = s.doc_id AND t.label <> s.label AND s.first <= t.last AND t.first <= s.last
     AND (t.held > s.held OR (t.share > s.share AND t.held = s.held)
       OR (t.share = s.share AND t.held = s.held AND t.template < s.template)))),
 m AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(share) AS share FROM held
       GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(b.n, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_concat(coalesce(b.labels, []), coalesce(m.labels, []))), ','), '')
    AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op6_line_dedup": f"""WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
 b AS (SELECT *, trim(line, {_BLANKS}) AS bare FROM l),
 wide AS (SELECT bare, min(doc_id) AS first_doc FROM b WHERE bare <> '' GROUP BY bare
          HAVING count(DISTINCT source) >= {MIN_SITES})
SELECT doc_id,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first_doc IS NULL OR first_doc = doc_id), '')
    AS text,
  count(*) FILTER (bare <> '') AS n_lines,
  count(*) FILTER (first_doc IS NOT NULL AND first_doc <> doc_id) AS n_removed
FROM b LEFT JOIN wide USING (bare) GROUP BY doc_id""",
    "op11_filter_interaction_audit": f"""WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
 l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
       FROM labels GROUP BY doc_id),
 w AS (SELECT t.*, {_words('text')} AS ws,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS copy FROM t),
 f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < {filter_audit.MIN_WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < {filter_audit.DISTINCT_PERCENT} * len(ws)
            THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > {filter_audit.UPPER_PERCENT}
            * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '{filter_audit.SYMBOLS}') THEN 'D' ELSE '' END
         || CASE WHEN copy THEN 'E' ELSE '' END AS fails
       FROM w LEFT JOIN l USING (doc_id)),
 cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
           FROM f GROUP BY part, fails),
 letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
 orders AS (SELECT '' AS filter_order UNION ALL
            SELECT filter_order || x FROM orders, letters WHERE NOT contains(filter_order, x)),
 s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE length(filter_order) = 5),
 c AS (SELECT part, filter_order, step, n, good, toxic, fails, filter_order[step] AS x,
         length(translate(filter_order[1:step - 1], fails, '')) = step - 1 AS reaches FROM s, cells),
 m AS (SELECT part, filter_order, step::INT AS step, x,
         coalesce(sum(n) FILTER (reaches AND NOT contains(fails, x)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (reaches AND contains(fails, x)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (NOT reaches AND contains(fails, x)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = x), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (reaches AND contains(fails, x)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (reaches AND contains(fails, x)), 0)::BIGINT AS toxic_lost
       FROM c GROUP BY ALL)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM m""",
    "op12_source_divergence_audit": f"""WITH t AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
 w AS (SELECT d, lang, source,
         unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM t),
 kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term
          HAVING count(DISTINCT d) >= {divergence.MIN_DOCS}),
 v AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
 g AS (SELECT DISTINCT lang, source FROM t),
 c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
 totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source)
            GROUP BY lang, source),
 p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + {divergence.SCALE}::HUGEINT * (coalesce(n, 0) + 1) // (totals.total + v) AS p,
         1 + {divergence.SCALE}::HUGEINT * (lang_n + 1) // (v.total + v) AS q
       FROM totals JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
 sums AS (SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
 pairs AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
           FROM g a JOIN g b USING (lang) LEFT JOIN sums s
             ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
           WHERE a.source <> b.source),
 terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
           FROM p WHERE n > 0 AND p > q),
 ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT
              AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}""",
}
