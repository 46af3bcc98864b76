"""SQL of the corpus operators whose result SQL can compute, where it takes more than a few lines."""

from __future__ import annotations

from skymeter.llm import personal, phrases

# The base patterns as they are given; the others are the same for all engines.
_PLAIN = {"email": personal.EMAIL, "ip": personal.ADDRESS, "card": personal.CARD, "phone": personal.PHONE}
_KINDS = ",\n".join(
    f"({i}, '{k.name}', {k.base}, '{_PLAIN.get(k.name, k.pattern)}', {k.score}, '{k.words}', '{k.against}')"
    for i, k in enumerate(personal.KINDS)
)
_DIGITS = "translate(m, '+ ().-', '')"
_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_ALONE = "NOT regexp_matches(right(before, 1), '[A-Za-z0-9]') AND NOT regexp_matches(left(after, 1), '[A-Za-z0-9]')"
_ASCII = f"'{personal.UPPER}', '{personal.LOWER}'"

OP11_SQL = rf"""
WITH t AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
k(place, kind, base, pattern, points, words, against) AS (VALUES
{_KINDS}),
f AS (
  SELECT row_id, k.*, regexp_extract_all(text, pattern) AS found, regexp_split_to_array(text, pattern) AS gaps
  FROM t JOIN k ON regexp_matches(text, pattern)),
e AS (
  SELECT *, unnest(found) AS m, generate_subscripts(found, 1) AS i FROM f),
s AS (
  SELECT *, gaps[i] AS before, gaps[i + 1] AS after,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start,
         {_DIGITS} AS digits, translate(m, ' ', '') AS account,
         translate(right(gaps[i], {personal.BEFORE}) || ' ' || left(gaps[i + 1], {personal.AFTER}), {_ASCII}) AS near
  FROM e),
c AS (
  SELECT *, points + CASE WHEN regexp_matches(near, '(^|[^a-z])(' || words || ')([^a-z]|$)') THEN {personal.RAISED} ELSE 0 END
         - CASE WHEN regexp_matches(near, '(^|[^a-z])(' || against || ')([^a-z]|$)') THEN {personal.LOWERED} ELSE 0 END AS score,
    CASE kind
      WHEN 'email' THEN true
      WHEN 'ip' THEN regexp_matches(m, '^{_PART}([.]{_PART}){{3}}$')
      WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(digits)),
        lambda j: (substr(digits, length(digits) - j::INT, 1)::INT * (1 + j % 2)) % 10
                  + (substr(digits, length(digits) - j::INT, 1)::INT * (1 + j % 2)) // 10)) % 10 = 0
      WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
      WHEN 'iban' THEN {_ALONE} AND length(account) BETWEEN 15 AND 34 AND list_reduce(
        list_transform(string_split(substr(account, 5) || substr(account, 1, 4), ''),
                       lambda x: CASE WHEN ascii(x) < 65 THEN ascii(x) - 48 ELSE ascii(x) - 55 END),
        lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
      WHEN 'national_phone' THEN {_ALONE} AND NOT regexp_matches(right(before, 8), '[+][0-9]{{0,4}}[ .-]?[(]?$')
      WHEN 'international_phone' THEN {_ALONE} AND regexp_matches(left(after, {personal.AFTER}), '^[ ().-]+[0-9]')
      WHEN 'social_security' THEN {_ALONE} AND NOT regexp_matches(m, '^(000|666|9)|-00-|0000$') AND right(before, 1) <> '-'
    END AS confirmed
  FROM s),
r AS (
  SELECT row_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || (start + length(m)), ',' ORDER BY place, start) FILTER (base) AS base_spans,
         string_agg(kind || ':' || start || ':' || (start + length(m)), ',' ORDER BY place, start) AS spans,
         string_agg(score, ',' ORDER BY place, start) AS scores
  FROM c WHERE confirmed AND (base OR score >= {personal.LEAST_SCORE}) GROUP BY row_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base_spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM t LEFT JOIN r USING (row_id)
"""

OP12_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '{phrases.UNDETERMINED}') AS lang, translate(coalesce(text, ''), {_ASCII}) AS text FROM documents),
p AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words FROM p),
g AS (
  SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i
  FROM w CROSS JOIN (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS k) WHERE len(words) >= k),
f AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (
  SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= {phrases.LEAST_COUNT}),
inside AS (
  SELECT lang, phrase, words, f, j, unnest(range(1, k - j + 2)) AS i
  FROM c CROSS JOIN (SELECT unnest(range(2, {phrases.LONGEST})) AS j) WHERE j < k),
longer AS (
  SELECT lang, array_to_string(words[i:i + j - 1], ' ') AS phrase, max(f) AS f FROM inside GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN longer l ON l.lang = c.lang AND l.phrase = c.phrase
  WHERE l.f IS NULL OR 100 * l.f < {phrases.SUBSUMED_PER_CENT} * c.f),
cuts AS (
  SELECT lang, phrase, words, f AS a, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, ({phrases.SCALE}::HUGEINT * a // (l.f + r.f))::BIGINT AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {phrases.PHRASES_PER_LANGUAGE}
"""
