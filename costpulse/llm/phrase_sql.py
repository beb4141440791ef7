"""DuckDB text of the collocation query."""

from __future__ import annotations

from costpulse.llm import collocations as c

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _floored(l: str, r: str) -> str:
    return f"(1000000::HUGEINT * a * a) // ({l}::HUGEINT * {r})"


def collocations() -> str:
    return f"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                              '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, [x for x in string_split_regex(piece, '[ \\t]+') if x <> ''] AS w FROM docs),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM ws
  UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) FROM ws
  UNION ALL SELECT lang, 3, unnest(
      [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) FROM ws),
f AS (SELECT lang, k, phrase, lang || chr(9) || phrase AS key, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w
  FROM f WHERE k > 1 AND f >= {c.LEAST}),
parts AS (
  SELECT lang, k, phrase, a, 1 AS cut, lang || chr(9) || w[1] AS lk,
    lang || chr(9) || array_to_string(w[2:], ' ') AS rk FROM cand
  UNION ALL
  SELECT lang, k, phrase, a, 2, lang || chr(9) || array_to_string(w[1:2], ' '), lang || chr(9) || w[3]
  FROM cand WHERE k = 3),
cuts AS (SELECT p.*, l.f AS l, r.f AS r FROM parts p JOIN f l ON l.key = lk JOIN f r ON r.key = rk),
scored AS (SELECT *, {_floored("l", "r")} AS score FROM cuts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored),
inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase,
    a AS longer FROM cand WHERE k = 3),
covered AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN covered v ON v.lang = b.lang AND v.phrase = b.phrase AND b.k = 2
  WHERE nth = 1 AND (longer IS NULL OR 100 * longer < {c.COVERED} * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n,
  score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {c.TOP}"""
