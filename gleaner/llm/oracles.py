"""DuckDB SQL of the queries that SQL can express."""

STOP = (
    "the of and to a in is that for it as was with be by on are this from at or an have not you "
    "der die das und in zu den von mit ist des sich auf für im dem nicht ein eine als auch es an "
    "le la les de des et en un une du que qui dans pour est pas sur au par avec il ce "
    "el los las y del se con una por no su para lo como más o"
)

QUALITY = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, t,
    list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
placed AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i+1], words[i+2], words[i+3], words[i+4]) AS n
  FROM placed),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1)
  GROUP BY doc_id),
counts AS (
  SELECT doc_id,
    len(words) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: regexp_matches(w, '\\pL'))) AS letter_words,
    len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]'))) AS latin,
    len(list_filter(words, lambda w: list_contains(string_split('{STOP}', ' '), lower(w)))) AS stops,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper
  FROM split LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
    OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR n_symbols / n_words > 0.2 OR letter_words / n_words < 0.5 OR upper / word_chars > 0.6
    OR (n_lines > 0 AND n_dup_lines / n_lines > 0.45) OR (n_words >= 200 AND 2 * latin >= n_words AND stops / n_words < 0.005)) AS kept
FROM counts
"""

# A turn reads "<turn:" role ">" text "</turn>", with one more character for each "\\" and "<" (in roles also ">").
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(role) + length(text) + length(role) - length(regexp_replace(role, '[\\<>]', '', 'g'))
    + length(text) - length(regexp_replace(text, '[\\<]', '', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Units are white space and the word behind it; digits of a digest of seed and id choose the cuts and the form.
FILL_IN_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n,
    ('0x' || substr(hex, 1, 8))::BIGINT % (len(u) + 1) AS h1, ('0x' || substr(hex, 9, 8))::BIGINT % (len(u) + 1) AS h2,
    ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4
  FROM units),
cut AS (
  SELECT doc_id, n, t, array_to_string(u[:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
    array_to_string(u[greatest(h1, h2) + 1:], '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
    ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""

# CRC-32 bit by bit; then what is cheapest from turn i on, from each state of the grammar (start, after system, user, assistant):
# structs of cost, audit and the repaired lines, whose order is that of cost, then audit.
REPAIR = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS b)),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
summed AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    lag(left(role, 1)) OVER w AS ahead, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text), copy)),
judged AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND again AS duplicate, trimmed = '' OR again AS go,
    trimmed <> '' AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated,
    i > 1 AND ahead || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed),
todo AS (
  SELECT conv_id, n + 1 AS i, {'c': 0, 'a': '', 't': ''} AS v0, {'c': 6, 'a': 'II', 't': concat('user:', chr(10), 'assistant:', chr(10))} AS v1,
    {'c': 3, 'a': 'I', 't': 'assistant:' || chr(10)} AS v2, {'c': 0, 'a': '', 't': ''} AS v3
  FROM judged GROUP BY conv_id, n
  UNION ALL
  SELECT conv_id, i,
    list_min([d0, {'c': d2.c + 3, 'a': 'I' || d2.a, 't': concat('user:', chr(10), d2.t)},
      {'c': d3.c + 6, 'a': 'II' || d3.a, 't': concat('user:', chr(10), 'assistant:', chr(10), d3.t)}]),
    list_min([d1, {'c': d2.c + 3, 'a': 'I' || d2.a, 't': concat('user:', chr(10), d2.t)},
      {'c': d3.c + 6, 'a': 'II' || d3.a, 't': concat('user:', chr(10), 'assistant:', chr(10), d3.t)}]),
    list_min([d2, {'c': d3.c + 3, 'a': 'I' || d3.a, 't': concat('assistant:', chr(10), d3.t)}]),
    list_min([d3, {'c': d2.c + 3, 'a': 'I' || d2.a, 't': concat('user:', chr(10), d2.t)}])
  FROM (
    SELECT conv_id, i, list_min([x0] || to_user || CASE WHEN go THEN [] WHEN initial = 's' THEN [kept1] WHEN initial = 'u' THEN [kept2] ELSE [] END) AS d0,
      list_min([x1] || to_user || CASE WHEN NOT go AND initial = 'u' THEN [kept2] ELSE [] END) AS d1,
      list_min([x2] || to_assistant || CASE WHEN NOT go AND initial = 'a' THEN [kept3] ELSE [] END) AS d2,
      list_min([x3] || to_user || CASE WHEN NOT go AND initial = 'u' THEN [kept2] ELSE [] END) AS d3
    FROM (
      SELECT t.conv_id, t.i - 1 AS i, go, initial,
        {'c': v0.c + 4, 'a': 'D' || v0.a, 't': v0.t} AS x0, {'c': v1.c + 4, 'a': 'D' || v1.a, 't': v1.t} AS x1,
        {'c': v2.c + 4, 'a': 'D' || v2.a, 't': v2.t} AS x2, {'c': v3.c + 4, 'a': 'D' || v3.a, 't': v3.t} AS x3,
        CASE WHEN go THEN [] ELSE [{'c': v2.c + 3 + e, 'a': 'R' || v2.a, 't': concat('user:', text, chr(10), v2.t)}] END AS to_user,
        CASE WHEN go THEN [] ELSE [{'c': v3.c + 3 + e, 'a': 'R' || v3.a, 't': concat('assistant:', text, chr(10), v3.t)}] END AS to_assistant,
        {'c': v1.c + e, 'a': 'K' || v1.a, 't': concat(role, ':', text, chr(10), v1.t)} AS kept1,
        {'c': v2.c + e, 'a': 'K' || v2.a, 't': concat(role, ':', text, chr(10), v2.t)} AS kept2,
        {'c': v3.c + e, 'a': 'K' || v3.a, 't': concat(role, ':', text, chr(10), v3.t)} AS kept3
      FROM todo t JOIN (SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS e FROM judged) j
        ON j.conv_id IS NOT DISTINCT FROM t.conv_id AND j.i = t.i - 1))),
reports AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.c, 0)::BIGINT AS cost,
  coalesce(v0.a, '') AS audit, sha256(coalesce(left(v0.t, length(v0.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN reports ON reports.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN (SELECT * FROM todo WHERE i = 1) best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
"""

SQL = {"op3_chat_format": CHAT, "op4_quality_rules": QUALITY, "op11_fill_in_middle": FILL_IN_MIDDLE,
       "op12_conversation_repair": REPAIR}


def oracles() -> dict[str, str]:
    return dict(SQL)
