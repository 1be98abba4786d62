"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from clickspark.llm import chat, licenses, quality, urls
from clickspark.llm.text import LOWER, UPPER

_LOWER = f"'{UPPER}', '{LOWER}'"
_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    copyright_line = licenses.COPYRIGHT_LINE.replace("(?md)", "(?m)")
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(translate({text}, {_LOWER}), {_quoted(copyright_line)}, '', 'g'), "
            rf"'{licenses.PUNCTUATION}', ' ', 'g'), ' ?\n ?', chr(10), 'g'), ' ' || chr(10))")


def _spelled(flat: str) -> str:
    for spelling, same in licenses.SPELLINGS:
        flat = rf"regexp_replace({flat}, '\b{spelling}\b', '{same}', 'g')"
    return flat


def _flat(canon: str) -> str:
    return rf"trim(regexp_replace({canon}, '\n+', ' ', 'g'))"


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.KNOWN_LICENSES)

OP1 = f"""
WITH known AS (SELECT sha256({_spelled(_flat(_canonical('t')))}) AS digest, min(id) AS license_id
               FROM (VALUES {_KNOWN}) v(id, t) GROUP BY 1),
canon AS (SELECT doc_id, {_canonical('text')} AS c FROM documents),
whole AS (SELECT doc_id, sha256({_spelled(_flat('c'))}) AS text_digest,
                 coalesce(len(list_filter(string_split(c, chr(10)), lambda x: x <> '')), 0)::BIGINT AS n_lines FROM canon),
lines AS (SELECT doc_id, unnest(string_split(c, chr(10))) AS line FROM canon),
found AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses
          FROM (SELECT doc_id, sha256({_spelled('line')}) AS digest FROM lines WHERE line <> '') JOIN known USING (digest)
          GROUP BY doc_id)
SELECT doc_id, text_digest, n_lines, license_id AS license, coalesce(line_licenses, '') AS line_licenses
FROM whole LEFT JOIN known ON text_digest = digest LEFT JOIN found USING (doc_id)
"""

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FOUR = "chr(9) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT rid, g FROM tri GROUP BY rid, g HAVING count(*) > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n FROM tri JOIN twice USING (rid, g), (VALUES (0), (1), (2)) v(o) GROUP BY rid),
base AS (
  SELECT rid, doc_id, source, len(ws)::BIGINT AS n_words, length(translate(t, {_BLANK}, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda x: trim(x, {_BLANK}) <> ''))
     - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: trim(x, {_BLANK}) <> ''))))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    regexp_replace(regexp_replace(translate(translate(t, {_LOWER}), {_FOUR}, '    '), ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g') AS norm
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid)),
texts AS (SELECT DISTINCT source, norm FROM base),
lines AS (SELECT DISTINCT source, norm, trim(l) AS line, len(string_split(trim(l), ' ')) AS words
          FROM (SELECT source, norm, unnest(string_split(norm, chr(10))) AS l FROM texts) WHERE trim(l) <> ''),
hosts AS (SELECT source, count(*) AS host_docs FROM texts GROUP BY source),
over AS (SELECT l.source, line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
         GROUP BY l.source, line, host_docs HAVING count(*) > {quality.MIN_DOCS} AND count(*) * count(*) > CAST({quality.GROWTH} AS DOUBLE) * host_docs),
sums AS (SELECT l.source, norm, sum(words)::BIGINT AS total,
                coalesce(sum(words) FILTER (WHERE o.line IS NOT NULL), 0)::BIGINT AS gone
         FROM lines l LEFT JOIN over o ON o.line = l.line AND o.source IS NOT DISTINCT FROM l.source GROUP BY l.source, norm),
judged AS (SELECT b.*, coalesce(total, 0) AS line_total, coalesce(gone, 0) AS line_removed,
             n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
           FROM base b LEFT JOIN sums s ON s.norm = b.norm AND s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line_total, line_removed, base_failed,
  NOT base_failed AND line_total - line_removed >= {quality.MIN_LEFT} * line_total AS kept
FROM judged
"""


def _host(u: str) -> str:
    return f"translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), {_LOWER})"


def _path(u: str) -> str:
    return f"regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _key(u: str) -> str:
    query = (f"trim(regexp_replace(regexp_replace(regexp_extract({u}, '(?s)^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1), "
             r"'([?&])utm_[^&=]*(=[^&]*)?', '\1', 'g'), '[?&]+', '&', 'g'), '&')")
    return (f"CASE WHEN instr({u}, '://') > 0 THEN regexp_replace(regexp_replace({_host(u)}, '^www\\.', ''), ':[0-9]*$', '') "
            f"|| regexp_replace({_path(u)}, '/+$', '') || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END")


def _case(column: str) -> str:
    longest = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if column == 'rule' else v}'"
        for h, p, v in longest) + " END"


OP8 = f"""
WITH p AS (SELECT page_id, coalesce({_host('url')}, '') AS host, coalesce({_path('url')}, '') AS path, {_key('url')} AS key FROM pages),
listed AS (SELECT DISTINCT key FROM p WHERE key IS NOT NULL AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT page_id, host, path, {_case('rule')} AS rule,
  coalesce({_case('verdict')}, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  listed.key IS NOT NULL AS listed
FROM p LEFT JOIN listed ON p.key = listed.key
"""


def _written(text: str) -> str:
    for raw, written in chat.ESCAPES:
        text = f"replace({text}, '{raw}', '{written}')"
    return text


OP10 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
m AS (SELECT *, coalesce(lag(role) OVER o = role, false) AS same FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = '{chat.ASSISTANT}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{chat.ASSISTANT}'), '')) AS loss_sha256,
  sum(length({_written('text')}) + CASE WHEN same THEN {len(chat.PART)}
      ELSE {len(chat.HEAD) + len(chat.COLON) + len(chat.END)} + length(replace({_written('role')}, chr(10), '\\n')) END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

def _best(*paths: str) -> str:
    return f"list_min([{', '.join(paths)}])"


def _edit(path: str, cost: str, initial: str, said: str = "''") -> str:
    return f"{{'c': {path}.c + {cost}, 'a': {path}.a || '{initial}', 't': {path}.t || {said}}}"


_NO_PATH = "{'c': 1000000000, 'a': '', 't': ''}"


def _if(condition: str, path: str) -> str:
    return f"CASE WHEN {condition} THEN {path} ELSE {_NO_PATH} END"


def _row_edits(kept: str, froms: tuple[str, ...], state: str, role: str) -> str:
    """Best way to a state over the next row: delete it there, keep or rerole it."""
    return _best(_edit(state, "4", "D"), *[
        _if(f"fault <> 1 AND kind = '{kept}'", _edit(f, "fault", "K", "role || ':' || text || chr(10)")) for f in froms], *[
        _if("fault <> 1", _edit(f, "3 + fault", "R", f"'{role}:' || text || chr(10)")) for f in froms if role])


#: CRC-32 by its byte table, then the lattice row by row: the cheapest path to each
#: state of the role pattern, of equal ones the one whose initials sort first.
#: ``fault`` is 1 for rows that must go, 3 (its cost) for truncated ones, else 0.
OP12 = f"""
WITH RECURSIVE crc(i, k, v) AS (SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM crc WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS code FROM conversations, tab),
ids AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM src)),
d AS (SELECT k, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM src JOIN ids ON src.conv_id IS NOT DISTINCT FROM ids.conv_id, range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
n AS (SELECT *, left(role, 1) AS kind, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text)) AS n FROM d),
r AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS first,
  coalesce((lag(kind) OVER (PARTITION BY k ORDER BY n) || kind) NOT IN ('su', 'ua', 'au'), false) AS illegal FROM n),
f AS (SELECT *, CASE WHEN first IN ('blank', 'duplicate') THEN 1 WHEN first = 'truncated' THEN 3 ELSE 0 END AS fault FROM r),
path(k, i, v0, v1, v2, v3) AS (
  SELECT k, 0::BIGINT, {{'c': 0, 'a': '', 't': ''}}, {_NO_PATH}, {{'c': 3, 'a': 'I', 't': 'user:' || chr(10)}},
    {{'c': 6, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} FROM ids
  UNION ALL
  SELECT k, n, n0, n1, c2, {_best('n3', _edit('c2', '3', 'I', "'assistant:' || chr(10)"))} FROM (
    SELECT *, {_best('n2', *[_edit(x, '3', 'I', "'user:' || chr(10)") for x in ('n0', 'n1', 'n3')])} AS c2 FROM (
      SELECT k, n, {_edit('v0', '4', 'D')} AS n0, {_row_edits('s', ('v0',), 'v1', '')} AS n1,
        {_row_edits('u', ('v0', 'v1', 'v3'), 'v2', 'user')} AS n2, {_row_edits('a', ('v2',), 'v3', 'assistant')} AS n3
      FROM path JOIN f USING (k) WHERE n = i + 1))),
best AS (SELECT k, arg_max({_best('v0', 'v3')}, i) AS p FROM path GROUP BY k)
SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (WHERE first = 'blank')::BIGINT AS blank, count(*) FILTER (WHERE first = 'duplicate')::BIGINT AS duplicate,
  count(*) FILTER (WHERE first = 'truncated')::BIGINT AS truncated, count(*) FILTER (WHERE illegal)::BIGINT AS illegal,
  any_value(p.c)::BIGINT AS cost, any_value(p.a) AS audit, sha256(any_value(left(p.t, greatest(length(p.t) - 1, 0)))) AS repaired_sha256
FROM ids JOIN best USING (k) LEFT JOIN f USING (k) GROUP BY k, conv_id
"""

ORACLE_SQL = {"op1_license_scan": OP1, "op2_quality_rules": OP2, "op8_url_filter": OP8, "op10_chat_format": OP10,
              "op12_structure_repair": OP12}
