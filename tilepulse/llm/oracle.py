"""DuckDB SQL of the registered queries that SQL can express.

The decontamination, the ranked search and the filter audit are: spans with positions, suffix
arrays, XXH64, networks and BPE are not. The first is written over plain windows (no hashes) and other regular expressions, as this
dialect has no look-around: a name is sought twice, for neighbours share the character between
them.
"""

from __future__ import annotations

from .decontaminate import MIN_LITERALS, MIN_WINDOWS, NUMBER_WORDS, UNITS, WINDOW

_UNITS = "|".join(sorted(UNITS, key=len, reverse=True))
_NAME = r"([\p{Ll}\p{Nd},;] )(\p{Lu}\p{Ll}[\p{L}\p{Nd}]*)"
_OPENER = r"(^|[^\p{L}\p{Nd}\x02])(\p{Lu}\p{Ll}[\p{L}\p{Nd}]*)"
_NUMBER = rf"(^|[^\p{{L}}\p{{Nd}}])([0-9]+)(?:[.,:/-]([0-9]+))?(?:[.,:/-]([0-9]+))?(?:[ -]?((?i:{_UNITS}))\b)?"
_WORDS = ", ".join(f"'{w}'" for w in NUMBER_WORDS)


def _tokens(text: str) -> str:
    """The tokens as structs: type (word, open, name or num) and filler."""
    named = rf"regexp_replace(coalesce({text}, ''), '[\x09-\x0D\x20]+', ' ', 'g')"
    for _ in range(2):
        named = rf"regexp_replace({named}, '{_NAME}', '\1' || chr(1) || 'name' || chr(2) || '\2', 'g')"
    opened = rf"regexp_replace({named}, '{_OPENER}', '\1' || chr(1) || 'open' || chr(2) || '\2', 'g')"
    counted = rf"regexp_replace({opened}, '{_NUMBER}', '\1' || chr(1) || 'num' || chr(2) || '\2p\3p\4u\5', 'g')"
    plain = rf"trim(regexp_replace(lower({counted}), '[^\p{{L}}\p{{Nd}}\x01\x02]+', ' ', 'g'), ' ')"
    kind = "CASE WHEN starts_with(t, chr(1)) THEN substr(split_part(t, chr(2), 1), 2) ELSE 'word' END"
    filler = "CASE WHEN starts_with(t, chr(1)) THEN split_part(t, chr(2), 2) ELSE t END"
    split = f"list_transform(string_split({plain}, ' '), lambda t: {{'kind': {kind}, 'filler': {filler}}})"
    number = f"s.kind IN ('word', 'open') AND s.filler IN ({_WORDS})"
    return f"list_transform({split}, lambda s: CASE WHEN {number} THEN {{'kind': 'num', 'filler': s.filler}} ELSE s END)"


def _windows(name: str, keys: str, table: str, lengths: str) -> str:
    """Windows of ``lengths`` (SQL) tokens in both readings of words that open sentences."""
    as_words = "list_transform(tokens, lambda s: CASE WHEN s.kind = 'open' THEN {'kind': 'word', 'filler': s.filler} ELSE s END)"
    template = "array_to_string(list_transform(own, lambda s: CASE s.kind WHEN 'word' THEN s.filler ELSE chr(1) || s.kind END), chr(3))"
    return f"""
{name}_tokens AS (SELECT {keys}, {_tokens("text")} AS tokens FROM {table}),
{name}_readings AS (
  SELECT {keys}, FALSE AS opened, {as_words} AS tokens FROM {name}_tokens
  UNION ALL SELECT {keys}, TRUE, tokens FROM {name}_tokens),
{name}_places AS (
  SELECT *, unnest(range(len(tokens) - size + 1)) AS pos
  FROM {name}_readings, (SELECT DISTINCT {lengths}) WHERE len(tokens) >= size),
{name}_cut AS (SELECT *, tokens[pos + 1 : pos + size] AS own FROM {name}_places),
{name}_windows AS (
  SELECT {keys}, pos, opened, size, len(tokens) AS n_tokens, own, {template} AS template FROM {name}_cut
  WHERE NOT opened OR size = {WINDOW} AND len(list_filter(own, lambda s: s.kind = 'open')) > 0)"""


_IS_SLOT = "lambda s: s.kind <> 'word'"
#: The rule of ``decontaminate``, over whole templates: which windows meet and tell, which fillers
#: are torn per alignment, which windows count.
_LEAKS = f"""
WITH item_sizes AS (
  SELECT DISTINCT least(len(tokens), {WINDOW}) AS size FROM (SELECT {_tokens("text")} AS tokens FROM benchmark)
  WHERE tokens[1].filler <> ''),
{_windows("b", "item_id", "benchmark", "size FROM item_sizes")},
index AS (SELECT * FROM b_windows WHERE size = {WINDOW} OR size = n_tokens AND own[1].filler <> ''),
{_windows("d", "doc_id, text", "documents", "size FROM item_sizes")},
sizes AS (SELECT item_id, count(DISTINCT pos) AS item_windows FROM index GROUP BY item_id),
met AS (
  SELECT d.doc_id, d.text, b.item_id, b.pos AS place, d.pos - b.pos AS diagonal,
         list_filter(list_transform(range(1, b.size + 1), lambda i: {{'kind': b.own[i].kind, 'a': b.own[i].filler, 'o': d.own[i].filler}}),
                     {_IS_SLOT}) AS slots
  FROM d_windows d JOIN index b ON d.template = b.template AND d.size = b.size AND d.opened = b.opened
  WHERE b.own = d.own OR b.size = {WINDOW} AND len(list_filter(b.own, {_IS_SLOT})) <= {WINDOW - MIN_LITERALS}),
pairs AS (
  SELECT DISTINCT doc_id, text, item_id, diagonal, s.kind AS kind, s.a AS a, s.o AS o
  FROM (SELECT doc_id, text, item_id, diagonal, unnest(slots) AS s FROM met)),
torn AS (
  SELECT doc_id, text, item_id, diagonal, kind, a FROM pairs
  GROUP BY ALL HAVING count(*) > 1),
torn_of AS (
  SELECT doc_id, text, item_id, diagonal, list(kind || chr(2) || a) AS torn, bool_or(kind <> 'open') AS typed
  FROM torn GROUP BY ALL),
judged AS (
  SELECT m.*, coalesce(t.typed, FALSE) AS broken,
         len(list_filter(slots, lambda s: s.a <> s.o AND list_contains(coalesce(t.torn, []), s.kind || chr(2) || s.a))) = 0 AS counts,
         len(list_filter(slots, lambda s: s.kind <> 'open')) > 0 AS filled,
         len(list_filter(slots, lambda s: s.a <> s.o)) = 0 AS own
  FROM met m LEFT JOIN torn_of t ON m.doc_id IS NOT DISTINCT FROM t.doc_id AND m.text = t.text
    AND m.item_id IS NOT DISTINCT FROM t.item_id AND m.diagonal = t.diagonal),
lined AS (
  SELECT doc_id, text, item_id, diagonal, count(DISTINCT place) FILTER (WHERE counts) AS n, bool_and(own) AS own
  FROM judged GROUP BY ALL HAVING NOT bool_or(broken) OR bool_or(counts AND filled))
SELECT l.doc_id, l.item_id, s.item_windows, max(l.n) AS n_windows, count(*) AS n_alignments, bool_or(own) AS exact
FROM lined l JOIN sizes s ON l.item_id = s.item_id
WHERE l.n >= least({MIN_WINDOWS}, s.item_windows)
GROUP BY l.doc_id, l.text, l.item_id, s.item_windows"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _terms(table: str, key: str) -> str:
    """One row per term of a text, with the number of its row; repeats stay."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
  SELECT r, {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{pattern}')) AS t
  FROM (SELECT row_number() OVER () AS r, {key}, text FROM {table})"""


_RANKED = f"""
WITH d AS ({_terms("documents", "doc_id")}),
q AS (SELECT DISTINCT * FROM ({_terms("benchmark", "item_id")})),
tf AS (SELECT r, doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
lens AS (SELECT r, count(*) AS n FROM d GROUP BY r),
stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lens),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), stats),
gains AS (
  SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // len))) AS g
  FROM tf JOIN lens USING (r) JOIN w USING (t), stats
  WHERE t IN (SELECT t FROM q)),
scored AS (
  SELECT q.r AS item_row, item_id, gains.r AS doc_row, doc_id, CAST(sum(g) AS BIGINT) AS score
  FROM q JOIN gains USING (t) GROUP BY ALL HAVING sum(g) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored)
WHERE rank <= 50"""

_WORDS_OF = r"list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_AUDIT = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, {_WORDS_OF} AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
docs AS (
  SELECT part,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > least, FALSE) AS e,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), FALSE) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), FALSE) AS toxic
  FROM words),
classes AS (
  SELECT part,
         CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
           || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
         count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM docs GROUP BY ALL),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE NOT contains(o, f)),
steps AS (
  SELECT o AS filter_order, CAST(s AS INTEGER) AS step, substr(o, s, 1) AS f, substr(o, 1, s - 1) AS prefix
  FROM orders, (SELECT unnest(range(1, 6)) AS s) WHERE length(o) = 5),
met AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS failing, fails = f AS alone,
         fails <> '' AND prefix <> '' AND len(list_intersect(string_split(fails, ''), string_split(prefix, ''))) > 0 AS gone
  FROM classes, steps),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""

ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": _LEAKS,
    "op12_ranked_search": _RANKED,
    "op13_filter_audit": _AUDIT,
}
