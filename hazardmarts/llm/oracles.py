"""DuckDB SQL for the queries whose results SQL can state; built from the same parameters."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from hazardmarts.llm.licenses import BASE, TEMPLATES, Template

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"

# Windows of three words are numbered within their text; a word is covered if one of up to three windows repeats.
QUALITY_COUNTS = rf"""
raw AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, t, regexp_extract_all(t, '{NOT_SPACE}') AS w FROM raw),
x AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
      FROM w, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM x) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) o(k) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{NOT_SPACE}')) AS l FROM w),
counts AS (
  SELECT w.r, w.t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(w.t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         length(regexp_replace(w.t, '[^A-Z]+', '', 'g')) AS upper,
         length(regexp_replace(w.t, '[^A-Za-z]+', '', 'g')) AS letters
  FROM w JOIN lines USING (r) LEFT JOIN covered USING (r)),
verdicts AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
           OR 10 * n_dup_lines > 4 * n_lines OR 2 * upper > letters AS rules_failed
  FROM counts)"""

QUALITY = f"""WITH {QUALITY_COUNTS}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT (base_failed OR rules_failed) AS kept
FROM verdicts JOIN raw USING (r)"""


def _escaped(column: str) -> str:
    return rf"replace(replace(replace({column}, '\', '\\'), '<', '<\'), '[', '[\')"


CHAT = f"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
told AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length({_escaped("role")}) + length({_escaped("text")}) + 10) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(chars AS BIGINT) AS formatted_chars
FROM told"""


def _starts(t: Template) -> str:
    """A list of (label, start, score) for every place where a template's key phrases stand."""
    fits = " AND ".join(f"w[s + {i + 1}] = '{t.words[i]}'" for i in t.key_places)
    share = " + ".join(f"CAST(w[s + {i + 1}] IS NOT DISTINCT FROM '{w}' AS INTEGER)" for i, w in enumerate(t.words))
    found = f"list_filter(range(0, len(w)), lambda s: coalesce({fits}, false))"
    return (
        f"list_transform({found}, lambda s: {{'label': '{t.label}', 'start': s, "
        f"'score': CAST({share} AS DOUBLE) / CAST({len(t.words)} AS DOUBLE)}})"
    )


def _labels(places: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_transform({places}, lambda x: x.label))), ',')"


def licences(base: Sequence[Template] = BASE, templates: Sequence[Template] = TEMPLATES) -> str:
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    nested = lambda ts: "list_concat(" + ", ".join(_starts(t) for t in ts) + ")"
    return rf"""WITH w AS (
  SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, {nested(base)} AS base, {nested(templates)} AS own FROM w)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(base) AS BIGINT) AS n_base,
       list_min(list_transform(base, lambda x: x.start)) AS first_word,
       list_max(list_transform(base, lambda x: x.start)) AS last_word,
       {_labels("base")} AS base_labels, {_labels("list_concat(base, own)")} AS labels,
       coalesce(list_max(list_transform(list_concat(base, own), lambda x: x.score)), 0.0) AS score
FROM p"""


WARC = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       if(bytes >= 1000 AND page_id IS DISTINCT FROM last, 'revisit', 'response') AS record_type,
       if(bytes >= 1000 AND page_id IS DISTINCT FROM last, last, NULL) AS refers_to
FROM g"""


def mixing(weights: Mapping[str, float], rest: float, source: str = "documents", seed: int = 1) -> str:
    """Poisson counts by a recursive distribution function per source, replicated and keyed."""
    whole = sum([*weights.values(), rest])
    named = ", ".join(f"('{s}', {share / whole!r}::DOUBLE)" for s, share in weights.items())
    bits = lambda n, *keys: "('0x' || substr(md5(concat_ws(':', '{}', {})), 1, 8))::BIGINT".format(
        n, ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    )
    return f"""WITH RECURSIVE shares(s, share) AS (SELECT * FROM (VALUES {named}, ('', {rest / whole!r}::DOUBLE)) v),
docs AS (SELECT d.*, if(source IN (SELECT s FROM shares), source, '') AS s FROM {source} d),
sizes AS (SELECT s, sum(length(coalesce(text, ''))) AS n FROM docs GROUP BY s),
rates AS (
  SELECT s, if(n > 0, share * CAST((SELECT sum(n) FROM sizes) AS DOUBLE) / CAST(n AS DOUBLE), 0.0::DOUBLE) AS rate
  FROM shares JOIN sizes USING (s)),
cdf AS (
  SELECT s, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rates
  UNION ALL
  SELECT s, rate, k + 1, term * (rate / (k + 1)), total + term * (rate / (k + 1)) FROM cdf WHERE total < 1 - pow(2, -34) AND k < 200),
drawn AS (SELECT docs.*, ({bits(seed, "doc_id")} + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u FROM docs),
counted AS (
  SELECT doc_id, text, lang, source, n_chars, cdf.rate, cdf.k AS copy
  FROM drawn JOIN cdf ON drawn.s = cdf.s AND cdf.total <= drawn.u)
SELECT doc_id, text, lang, source, n_chars, rate, copy, {bits(seed + 1, "doc_id", "copy")} AS mix_key FROM counted"""


AUDIT = rf"""WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}') AS w
  FROM documents),
l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         if(len(w) < 50, 'A', '') || if(100 * len(list_distinct(w)) < 65 * len(w), 'B', '')
         || if(100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t), 'C', '')
         || if(regexp_matches(t, '[#$%&*|]'), 'D', '')
         || if(coalesce(doc_id > min(d.doc_id) OVER (PARTITION BY t), min(d.doc_id) OVER (PARTITION BY t) IS NOT NULL), 'E', '')
         AS fails
  FROM d LEFT JOIN l USING (doc_id)),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY part, fails),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || c FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) f(c) WHERE NOT contains(o, c)),
steps AS (
  SELECT o, k AS step, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS earlier, substr(o, 1, k) AS applied
  FROM orders, (VALUES (1), (2), (3), (4), (5)) s(k) WHERE length(o) = 5),
counted AS (
  SELECT part, o, step, f,
         sum(n) FILTER (translate(fails, applied, '') = fails) AS kept,
         sum(n) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails) AS removed,
         sum(n) FILTER (contains(fails, f) AND translate(fails, earlier, '') <> fails) AS redundant,
         sum(n) FILTER (fails = f) AS unique_fails,
         sum(good) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails) AS good_lost,
         sum(toxic) FILTER (contains(fails, f) AND translate(fails, earlier, '') = fails) AS toxic_lost
  FROM cells, steps GROUP BY part, o, step, f)
SELECT part, o AS filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM counted"""


# The checksum by the bytes of the text and a table of 256 entries, worked out from the polynomial 0xEDB88320.
VARIANTS = rf"""WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, x: if(a & 1 = 1, xor(a >> 1, 3988292384), a >> 1)) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i)),
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
m AS (
  SELECT run, count(*) AS n, id FROM r GROUP BY run, id),
h AS (
  SELECT run, n, hex(encode(id || ':' || run)) AS x FROM m),
marked AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]))) AS mark
  FROM h, crc_table),
typed AS (
  SELECT if(mark % 97 = 0, left(run, mark % length(run)) || substr(run, mark % length(run) + 2), run) AS word, n FROM marked),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT DISTINCT word, n, i, left(word, i) || substr(word, i + 2) AS c
  FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.c = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.c = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM (SELECT DISTINCT * FROM pairs) GROUP BY word),
formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, if(near_n >= 2 * n, near, NULL) AS form, if(near_n >= 2 * n, near_n, NULL) AS form_n
  FROM words LEFT JOIN best USING (word)),
chain(word, tip) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = chain.tip WHERE form IS NOT NULL)
SELECT f.word, f.form, tip AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain ON chain.word = f.word JOIN formed e ON e.word = chain.tip WHERE e.form IS NULL"""
