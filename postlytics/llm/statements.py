"""SQL of the training-data queries, stated anew from their definitions."""

from __future__ import annotations

from postlytics.llm.licenses import BASE_PHRASES, MARKUP, TEXTS
from postlytics.llm.url_filter import RULES, Rule, Spread

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# what each notice of the license scan accepts, over words joined by blanks
NOTICE_PATTERNS = (
    ("apache-2.0", " licensed under the apache license( version)? 2 0 "),
    (
        "gpl-3.0",
        " licensed under( the terms of)? the gnu general public license"
        "( as published by the free software foundation)?( either)?( version)? v?3 ",
    ),
    ("gpl-2.0", " licensed under( the terms of)? the gnu general public license( version)? v?2 "),
    ("cc-by-4.0", " licensed under( a)? cc by 4 0 | licensed under a creative commons attribution 4 0( international)? license "),
    ("cc-by-nc-4.0", " licensed under( a)? cc by nc 4 0 "),
    ("cc-by-sa-4.0", " licensed under( a)? cc by sa 4 0 "),
    ("cc-by-nd-4.0", " licensed under( a)? cc by nd 4 0 "),
    ("cc-by-nc-sa-4.0", " licensed under( a)? cc by nc sa 4 0 "),
    ("cc-by-nc-nd-4.0", " licensed under( a)? cc by nc nd 4 0 "),
    ("cc-by-nc-4.0", " licensed under a creative commons attribution noncommercial 4 0( international)? license "),
    ("cc-by-sa-4.0", " licensed under a creative commons attribution sharealike 4 0( international)? license "),
    ("cc-by-nd-4.0", " licensed under a creative commons attribution noderivatives 4 0( international)? license "),
    (
        "cc-by-nc-sa-4.0",
        " licensed under a creative commons attribution noncommercial sharealike 4 0( international)? license ",
    ),
    (
        "cc-by-nc-nd-4.0",
        " licensed under a creative commons attribution noncommercial noderivatives 4 0( international)? license ",
    ),
    ("mit", " (released|licensed) under the( terms of the)? mit license "),
    ("copyright", " copyright( [^ ]+){1,8} all rights reserved "),
    ("all-rights-reserved", " all rights reserved "),
)


def _pattern(template: str) -> str:
    """What a template accepts as one pattern over words joined by blanks."""
    signs = {"beginOptional": "(", "endOptional": ")?"}
    found = ""
    for tag, word in MARKUP.findall(template):
        options = dict(part.split("=", 1) for part in tag.split(";")[1:])
        if options:
            found += f"( ({options['match'].replace('.+', '[^ ]+')})){{1,{options['max']}}}"
        else:
            found += signs[tag] if tag else f" {word}"
    return f"{found} "


def _starts(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words, 1))
    return f"list_filter(range(0, greatest(0, len(w) - {len(words) - 1})), lambda i: {same})"


def _joined(*labels: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(labels)}], lambda x: x IS NOT NULL))), ',')"


def license_scan() -> str:
    patterns = (*NOTICE_PATTERNS, *((label, _pattern(template)) for label, template in TEXTS))
    base = [f"CASE WHEN regexp_matches(line, ' {phrase} ') THEN '{label}' END" for phrase, label in BASE_PHRASES]
    own = [f"CASE WHEN regexp_matches(line, '{pattern}') THEN '{label}' END" for label, pattern in patterns]
    starts = " || ".join(_starts(phrase) for phrase, _ in BASE_PHRASES)
    return rf"""
        WITH words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), lines AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line, {starts} AS starts FROM words)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base,
          CAST(list_min(starts) AS BIGINT) AS first_word, CAST(list_max(starts) AS BIGINT) AS last_word,
          {_joined(*base)} AS base_labels, {_joined(*base, *own)} AS labels,
          CAST(CASE WHEN {_joined(*own)} <> '' THEN 1 WHEN len(starts) > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
        FROM lines"""


WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    words AS (
      SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM docs)
    ), windows AS (
      SELECT doc_id, i, [word, lead(word) OVER by_place, lead(word, 2) OVER by_place] AS three,
        lead(word, 2) OVER by_place IS NOT NULL AS whole
      FROM words WINDOW by_place AS (PARTITION BY doc_id ORDER BY i)
    ), again AS (
      SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows WHERE whole)
      WHERE n > 1
    ), repeats AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) r(k) GROUP BY doc_id
    ), lines AS (
      SELECT doc_id, line, count(*) AS times, any_value(len(regexp_extract_all(line, '{WORD}'))) AS n
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
      WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line
    ), judged AS (
      SELECT doc_id, times, n,
        (n <= 25 AND regexp_matches(line, '(?i)all rights reserved|copyright|©|\(c\) \d{{4}}|privacy policy|terms of (use|service)|cookie|javascript|subscribe|newsletter|sign (in|up)|log ?in\b|click here|read more|share (this|on)|powered by|back to top|skip to content'))
        OR (bars >= 3 AND bars * 5 >= n)
        OR (length(line) - length(regexp_replace(line, '[#*$%&|<>~^_={{}}\\]|!!+|\?\?+', '', 'g'))) * 100 > 12 * length(line)
        OR NOT regexp_matches(line, '[.,;:!?…。、！？；：؟।]') AS fails
      FROM (SELECT *, len(list_filter(regexp_extract_all(line, '{WORD}'),
                   lambda x: regexp_full_match(x, '[|»«›‹>•·/\\~:-]+'))) AS bars FROM lines)
    ), kept AS (
      SELECT doc_id, sum(times - 1) AS dups, sum(CASE WHEN fails THEN 0 ELSE n END) AS kept_words
      FROM judged GROUP BY doc_id
    ), counted AS (
      SELECT d.doc_id, len(regexp_extract_all(text, '{WORD}')) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(k.dups, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(k.kept_words, 0) AS kept_words
      FROM docs d LEFT JOIN repeats r USING (doc_id) LEFT JOIN kept k USING (doc_id)
    ), failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
      CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
      CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
      NOT base_failed AND 100 * kept_words >= 50 * n_words AS kept, CAST(kept_words AS BIGINT) AS kept_words
    FROM failed"""


def _host(rest: str) -> str:
    return f"translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _rest(url: str) -> str:
    return f"CASE WHEN position('://' IN {url}) > 0 THEN substr({url}, position('://' IN {url}) + 3) ELSE '' END"


def _spread(name: str, edges: str, seeds: str, settings: Spread) -> str:
    """CTEs `name`0 .. of the rounds; the last one holds the scores."""
    parts = [
        f"{name}_share AS (SELECT src, dst, {settings.damping} / count(*) OVER (PARTITION BY src) AS part FROM {edges})",
        f"{name}0 AS (SELECT host, 1.0::DOUBLE AS score FROM {seeds})",
    ]
    for k in range(1, settings.rounds + 1):
        parts.append(f"""{name}{k} AS (SELECT host, sum(score) AS score FROM (
            SELECT dst AS host, part * score AS score FROM {name}_share JOIN {name}{k - 1} ON src = host
            UNION ALL SELECT * FROM {name}0) GROUP BY host)""")
    return ", ".join(parts)


def url_filter(rules: tuple[Rule, ...] = RULES, settings: Spread = Spread()) -> str:
    fits = [
        (f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r)
        for r in sorted(rules, key=lambda r: -len(r.pattern))
    ]
    rule = " ".join(f"WHEN {test} THEN '{r.pattern}'" for test, r in fits)
    verdict = " ".join(f"WHEN {test} THEN '{r.verdict}'" for test, r in fits)
    link = r"""(?i)<a\s[^>]*?href\s*=\s*["'']?\s*((?:https?:)?//[^"''\s>]+)"""
    full = "CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END"
    return f"""
        WITH parts AS (
          SELECT page_id, html, {_host("rest")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM (SELECT page_id, html, coalesce({_rest("url")}, '') AS rest FROM pages)
        ), ruled AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS by_rule FROM parts),
        hosts AS (
          SELECT host, 2 * count_if(by_rule = 'allow') > count(*) AS good, 2 * count_if(by_rule = 'block') > count(*) AS bad
          FROM ruled WHERE host <> '' GROUP BY host
        ), good AS (SELECT host FROM hosts WHERE good), bad AS (SELECT host FROM hosts WHERE bad),
        edges AS (
          SELECT DISTINCT src, dst FROM (
            SELECT host AS src, {_host(_rest(full))} AS dst
            FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM parts))
          WHERE src <> dst AND src <> '' AND dst <> ''
        ), against AS (SELECT dst AS src, src AS dst FROM edges),
        {_spread("trust", "edges", "good", settings)}, {_spread("distrust", "against", "bad", settings)},
        flagged AS (
          SELECT d.host FROM distrust{settings.rounds} d LEFT JOIN trust{settings.rounds} t USING (host)
          WHERE d.score >= {settings.threshold} AND d.score > coalesce(t.score, 0)
        )
        SELECT page_id, ruled.host, path, rule,
          coalesce(by_rule, CASE WHEN flagged.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled LEFT JOIN flagged ON ruled.host = flagged.host"""


def collocations(least: int = 30, top: int = 2000) -> str:
    """Phrases of two to four words, counted one by one."""
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {size} AS size, unnest(list_transform(range(1, len(w) - {size} + 2),"
        f" lambda i: array_to_string(w[i : i + {size - 1}], ' '))) AS phrase FROM words"
        for size in range(1, 5)
    )
    cuts = "\n  UNION ALL ".join(
        f"SELECT lang, phrase, size, a, {k} AS k, array_to_string(w[:{k}], ' ') AS head, array_to_string(w[{k + 1}:], ' ') AS tail"
        f" FROM candidates WHERE size > {k}"
        for k in range(1, 4)
    )
    inner = "\n  UNION ALL ".join(
        f"SELECT lang, a, array_to_string(w[{i} : {i + size - 1}], ' ') AS phrase FROM candidates WHERE size = {longer}"
        for longer in (3, 4) for size in range(2, longer) for i in range(1, longer - size + 2)
    )
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  {grams}
), counts AS (
  SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND a >= {least}
), cuts AS (
  {cuts}
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.a AS l, t.a AS r, (2000000 * c.a) // (h.a + t.a) AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS outer_a FROM ({inner}) GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE outer_a IS NULL OR 100 * outer_a < 80 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {top}
"""
