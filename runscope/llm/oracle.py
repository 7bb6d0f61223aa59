"""SQL that the queries of this package are checked against.

Operators 1, 2, 4, 11 and 12 can be written in SQL as a whole. The others learn, segment, align or
discover what SQL cannot express, or add up logarithms whose last digits depend on the
order; they are tested against brute-force versions.
"""

from __future__ import annotations

from runscope.llm import phrase_index, quality_rules

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_PLAIN = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_SPACED.format(_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT u, v FROM common c JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other
),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN named USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_PHRASE_INDEX = f"""
WITH items AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, w[i : i + 9] AS terms
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT len(terms) AS n FROM windows),
words AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
places AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS terms
  FROM words, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)
),
found AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (terms)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS names
  FROM found GROUP BY doc_id
),
occurrences AS (SELECT doc_id, j, w[j] AS term FROM words, unnest(range(1, len(w) + 1)) AS t(j)),
frequency AS (SELECT term, count(*) AS n FROM occurrences GROUP BY term),
ordered AS (
  SELECT terms, o, terms[o] AS term, n, row_number() OVER (PARTITION BY terms ORDER BY n, o) AS rank
  FROM (SELECT DISTINCT terms FROM windows), unnest(range(1, len(terms) + 1)) AS t(o) LEFT JOIN frequency ON term = terms[o]
),
rarest AS (
  SELECT terms, arg_min(term, rank) AS term FROM ordered GROUP BY terms HAVING count(n) = count(*)
),
anchors AS (
  SELECT r.terms, doc_id, j, greatest(1, j - len(r.terms) - {phrase_index.SLACK}) AS low, j + len(r.terms) + {phrase_index.SLACK} AS high
  FROM rarest r JOIN occurrences USING (term)
),
near AS (
  SELECT DISTINCT terms, doc_id FROM (
    SELECT a.terms, a.doc_id, a.j, count(DISTINCT o.term) AS n
    FROM anchors a JOIN occurrences o ON o.doc_id = a.doc_id AND o.j BETWEEN a.low AND a.high AND list_contains(a.terms, o.term)
    GROUP BY ALL
  ) WHERE n = len(list_distinct(terms))
),
close_by AS (SELECT doc_id, count(DISTINCT item) AS n_near FROM near JOIN windows USING (terms) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN close_by USING (doc_id)
"""


def _quality_rules() -> str:
    value = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
        "repeat_word_share": "n_repeat_words / greatest(n_words, 1)",
        "upper_share": "n_upper / greatest(n_letters, 1)",
        "bangs_per_word": "n_bangs / greatest(n_words, 1)",
        "mean_word_above": "word_chars / greatest(n_words, 1)",
        "mean_word_below": "word_chars / greatest(n_words, 1)",
    }
    values = ",\n  ".join(f"('{r}', {v})" for r, v in value.items())
    rules = quality_rules.RULES
    grid = ", ".join(
        f"('{rule}', {'TRUE' if side == 'above' else 'FALSE'}, {k}, {cutoff}::DOUBLE)"
        for rule, (side, cutoffs) in rules.items()
        for k, cutoff in enumerate(cutoffs)
    )
    alpha, delta = quality_rules.ALPHA, quality_rules.DELTA
    count = "len(regexp_replace({}, '[^{}]', '', 'g'))"
    return rf"""
WITH cut AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, {_SPACED.format("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM cut, unnest(range(1, len(w) - 1)) AS t(i)
),
repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM windows, unnest(range(i, i + 3)) AS t(j) WHERE n > 1 GROUP BY doc_id
),
stats AS (
  SELECT doc_id, lang, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    {count.format("t", "#*$%&|<>")} AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    {count.format("t", "A-Z")} AS n_upper, {count.format("t", "A-Za-z")} AS n_letters, {count.format("t", "!?")} AS n_bangs
  FROM cut LEFT JOIN repeats r USING (doc_id)
),
measured AS (
  SELECT s.doc_id, s.lang, v.rule, v.value
  FROM stats s, LATERAL (VALUES
  {values}) AS v(rule, value)
),
grid(rule, above, k, cutoff) AS (VALUES {grid}),
refusals AS (
  SELECT doc_id, lang, rule, k, cutoff, CASE WHEN above THEN value > cutoff ELSE value < cutoff END AS refused
  FROM measured JOIN grid USING (rule)
),
held AS (
  SELECT r.lang, rule, k, cutoff, count(*) FILTER (quality = 1) AS n,
    count(*) FILTER (quality = 1 AND refused) AS good, count(*) FILTER (quality = 0 AND refused) AS bad
  FROM refusals r JOIN labels USING (doc_id) WHERE quality IN (0, 1) GROUP BY ALL
),
tested AS (
  SELECT *, CASE WHEN good >= n * {alpha} THEN 1.0 ELSE list_sum(list_transform(range(0, good + 1), lambda j:
    exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({alpha}) + (n - j) * ln(1 - {alpha})))) END AS p,
    {delta} / ({len(rules)} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM held))) AS level
  FROM held
),
certified AS (
  SELECT * FROM tested t WHERE NOT EXISTS (
    SELECT 1 FROM tested f WHERE f.lang IS NOT DISTINCT FROM t.lang AND f.rule = t.rule AND f.k <= t.k AND f.p > f.level)
),
chosen AS (
  SELECT lang, rule, arg_min(k, [good - bad, k]) AS k FROM certified WHERE bad > good GROUP BY lang, rule
),
out AS (
  SELECT DISTINCT r.doc_id FROM refusals r JOIN chosen c
  ON r.lang IS NOT DISTINCT FROM c.lang AND r.rule = c.rule AND r.k = c.k WHERE refused
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM out) AS kept
FROM stats
"""


# Table of the reversed polynomial 0xEDB88320 of CRC-32, and the checksum of an ASCII text.
_CRC_TABLE = """(
  SELECT list(v ORDER BY n) FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(n))
)"""


def _crc32(text: str) -> str:
    octets = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    return (
        f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), "
        "lambda a, b: xor(a >> 8, crc_table[CAST((xor(a, b) & 255) + 1 AS INT)])))"
    )


def _conversation_repair() -> str:
    """Dynamic programme over rows: by state a text of cost and edits that sorts as they do, with the repaired turns."""

    def plus(state: str, cost: str, edit: str, line: str) -> str:
        cost = f"lpad(CAST(CAST({state}.k[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0')"
        return f"CASE WHEN {state}.k IS NOT NULL THEN {{'k': {cost} || {state}.k[10:] || '{edit}', 'r': {line.format(state + '.r')}}} END"

    def least(*several: str) -> str:
        return f"list_min(list_filter([{', '.join(several)}], lambda x: x.k IS NOT NULL))"

    none = "CAST(NULL AS STRUCT(k VARCHAR, r VARCHAR[]))"
    user, assistant = (f"list_append({{}}, '{role}:')" for role in ("user", "assistant"))

    def closed(rows: str) -> str:
        with_user = least("u", *(plus(x, "2", "I", user) for x in "sya"))
        return f"""SELECT id, i, s, y, u, {least('a', plus('u', '2', 'I', assistant))} AS a
          FROM (SELECT id, i, s, y, a, {with_user} AS u FROM ({rows}))"""

    gone = "{}"
    kept, as_user, as_assistant = (f"list_append({{}}, {role} || ':' || text)" for role in ("role", "'user'", "'assistant'"))
    stays = "NOT must_go AND"

    def when(test: str, value: str) -> str:
        return f"CASE WHEN {stays} {test} THEN {value} END"

    def into(state: str, keeps: str, sources: str, role: str, initial: str) -> str:
        offers = [plus(f"d.{state}", "3", "D", gone)]
        offers += [when(f"initial = '{initial}'", plus(f"d.{x}", "more", "K", kept)) for x in keeps]
        offers += [when("TRUE", plus(f"d.{x}", "2 + more", "R", role)) for x in sources]
        return least(*offers)

    step = f"""SELECT d.id, d.i + 1 AS i, {into('s', '', '', '', '')} AS s, {into('y', 's', '', '', 's')} AS y,
      {into('u', 'sya', 'sya', as_user, 'u')} AS u, {into('a', 'u', 'u', as_assistant, 'a')} AS a
      FROM dp d JOIN flagged f ON f.id = d.id AND f.i = d.i + 1"""
    start = f"SELECT id, CAST(0 AS BIGINT) AS i, {{'k': '000000000', 'r': CAST([] AS VARCHAR[])}} AS s, {none} AS y, {none} AS u, {none} AS a FROM ids"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS crc_table),
marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(key)} % 20 AS kind FROM conversations, crc
),
ids AS (SELECT conv_id, row_number() OVER () AS id FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM marked JOIN ids ON ids.conv_id IS NOT DISTINCT FROM marked.conv_id, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS t(copy)
  WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body, role[1:1] AS initial FROM damaged
),
seen AS (
  SELECT *, body = '' AS is_blank, row_number() OVER (PARTITION BY id, role, text ORDER BY i) > 1 AS is_seen,
    body[-1:] NOT IN ('.', '!', '?') AS is_cut, lag(initial) OVER (PARTITION BY id ORDER BY i) || initial AS pair
  FROM placed
),
flagged AS (
  SELECT *, is_blank OR is_seen AS must_go, CASE WHEN is_cut THEN 1 ELSE 0 END AS more FROM seen
),
dp AS ({closed(start)} UNION ALL {closed(step)}),
ends AS (
  SELECT id, max(i) AS n, arg_max({least('s', 'a')}, i) AS best FROM dp GROUP BY id
),
counts AS (
  SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
    count(*) FILTER (NOT is_blank AND is_seen) AS duplicate, count(*) FILTER (NOT must_go AND is_cut) AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY id
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.k[1:9] AS BIGINT) AS cost, best.k[10:] AS audit,
  sha256(array_to_string(best.r, chr(10))) AS repaired_sha256
FROM ids JOIN ends USING (id) LEFT JOIN counts USING (id)
"""


_CONVERSATION_TRIE = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS crc_table),
lists AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
own AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, turns, {_crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM lists, crc
),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[: o.h], o.turns[o.h + 1 :]) AS turns
  FROM own o LEFT JOIN lists b ON b.conv_id = o.base
),
prefixes AS (
  SELECT conv_id, d AS depth, turns[: d] AS path, d = len(turns) AS ends FROM rebuilt, unnest(range(0, len(turns) + 1)) AS t(d)
),
nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN any_value(depth) > 0 THEN (count(*) - 1) * strlen(any_value(path)[-1].t) ELSE 0 END AS saved,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM prefixes GROUP BY path
),
linked AS (SELECT *, CASE WHEN depth > 0 THEN path[: depth - 1] END AS parent FROM nodes),
children AS (SELECT parent AS path, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c ON c.path = l.path),
sums AS (
  SELECT path[: d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM counted, unnest(range(0, depth + 1)) AS t(d) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM counted n JOIN sums s ON s.path = n.path LEFT JOIN nodes p ON p.path = n.parent
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_duplicates": _NEAR_DUPLICATES,
        "op2_phrase_index": _PHRASE_INDEX,
        "op4_quality_rules": _quality_rules(),
        "op11_conversation_repair": _conversation_repair(),
        "op12_conversation_trie": _CONVERSATION_TRIE,
    }
