"""DuckDB SQL of the quality rules, written from their definition."""

from marketlens.llm.quality_rules import FENCES, MAX_REPEAT_PERCENT, MIN_GROUP, MIN_WORDS, SPREADS

_RATIOS = {"symbols": "n_symbols * 1000 // n_words", "dup_lines": "n_dup_lines * 1000 // n_lines",
           "word_length": "word_chars * 1000 // n_words"}

_COUNTS = r"""
rows_ AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source FROM documents),
words AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM rows_),
grams AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
gram AS (SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM grams),
twice AS (SELECT rid, i FROM gram QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cover AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)),
                                  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM rows_),
m AS (SELECT rid, doc_id, lang, source, len(w) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words, len(l) AS n_lines
      FROM rows_ JOIN words USING (rid) JOIN lines USING (rid) LEFT JOIN cover USING (rid)),
long_ AS (SELECT * FROM m WHERE n_words >= {min_words}),
vals AS ({vals}),
buckets AS (SELECT lang, source, ratio, CASE WHEN v < 64 THEN v
                   ELSE (v >> CAST(len(bin(v)) - 6 AS BIGINT)) << CAST(len(bin(v)) - 6 AS BIGINT) END AS b FROM vals)
"""


def _fence(name: str, keys: str) -> str:
    by = f"{keys}, ratio" if keys else "ratio"
    picks = []
    for r, (least, lower) in FENCES.items():
        away = f"greatest({least}, (q50 - q10) * {SPREADS})"
        picks.append(f"max(CASE WHEN ratio = '{r}' THEN q50 + {away} END) AS {r}_most")
        if lower:
            picks.append(f"max(CASE WHEN ratio = '{r}' THEN q50 - {away} END) AS {r}_least")
    return f"""{name} AS (SELECT {keys + ', ' if keys else ''}max(total) AS total, {', '.join(picks)} FROM (
  SELECT {by}, count(*) AS total, quantile_disc(b, 0.10) AS q10, quantile_disc(b, 0.50) AS q50
  FROM buckets GROUP BY {by}) {'GROUP BY ' + keys if keys else ''})"""


def report_sql() -> str:
    vals = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS ratio, {e} AS v FROM long_" for r, e in _RATIOS.items())
    names = [f"{r}_most" for r in FENCES] + [f"{r}_least" for r, (_, low) in FENCES.items() if low]
    cuts = ", ".join(f"CASE WHEN own.total >= {MIN_GROUP} THEN own.{n} WHEN per_lang.total >= {MIN_GROUP} "
                     f"THEN per_lang.{n} ELSE corpus.{n} END AS {n}" for n in names)
    tests = " AND ".join(f"{e} {'<=' if n.endswith('_most') else '>='} {n}"
                         for n in names for r, e in _RATIOS.items() if n.rsplit("_", 1)[0] == r)
    return f"""WITH {_COUNTS.replace('{min_words}', str(MIN_WORDS)).replace('{vals}', vals)},
{_fence('own', 'lang, source')}, {_fence('per_lang', 'lang')}, {_fence('corpus', '')},
cuts AS (SELECT own.lang, own.source, {cuts} FROM own
         LEFT JOIN per_lang ON own.lang IS NOT DISTINCT FROM per_lang.lang LEFT JOIN corpus ON true),
j AS (SELECT m.*, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
             {', '.join('cuts.' + n for n in names)}
      FROM m LEFT JOIN cuts ON m.lang IS NOT DISTINCT FROM cuts.lang AND m.source IS NOT DISTINCT FROM cuts.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE coalesce({tests}, false) END AS kept FROM j"""
