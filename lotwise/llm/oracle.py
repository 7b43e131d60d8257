"""DuckDB SQL for the operators that SQL can express, by query name."""

from __future__ import annotations

from lotwise.llm import license_scan as lic

OP1 = r"""
WITH normal AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM normal WINDOW w AS (PARTITION BY text_sha256)
"""


def op2() -> str:
    texts = [(text.split(), label, True) for text, label in lic.BASE_PHRASES.items()]
    texts += [(text.split(), label, False) for label, many in lic.TEMPLATES.items() for text in many]
    grams = ",\n".join(
        f"('{' '.join(w[at : at + lic.GRAM])}', {k}, {at}, '{label}', {base}, {len(w) - lic.GRAM + 1})"
        for k, (w, label, base) in enumerate(texts)
        for at in range(len(w) - lic.GRAM + 1)
    )
    near = ", ".join(f"({k}, {lic.near_of(len(w) - lic.GRAM + 1)})" for k, (w, _, _) in enumerate(texts))
    # One row per thing that a span of the template must hold: any of these places.
    asked = ", ".join(f"({k}, {places})" for k, (own, numbers) in enumerate(lic.demands(texts)) for places in ([own] if own else []) + numbers)
    return rf"""
WITH known(gram, template, spot, label, base, n_grams) AS (VALUES {grams}),
nearness(template, near) AS (VALUES {near}),
asked(template, places) AS (VALUES {asked}),
worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - {lic.GRAM} + 2, 1))) AS i FROM worded
),
hits AS (
  SELECT p.doc_id, k.template, k.label, k.base, k.n_grams, p.i - 1 - k.spot AS diagonal, k.spot
  FROM (SELECT doc_id, i, {" || ' ' || ".join(f"words[i + {k}]" for k in range(lic.GRAM))} AS gram FROM places) p
  JOIN known k USING (gram)
),
votes AS (
  SELECT doc_id, template, label, base, n_grams, diagonal, list(DISTINCT spot) AS found FROM hits GROUP BY ALL
),
begun AS (
  SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER w > near, true) THEN 1 ELSE 0 END AS starts
  FROM votes JOIN nearness USING (template) WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM begun
),
spans AS (
  SELECT doc_id, template, label, base, n_grams, span, min(diagonal) AS start,
         list_distinct(flatten(list(found))) AS spots
  FROM numbered GROUP BY doc_id, template, label, base, n_grams, span
),
unmet AS (
  SELECT DISTINCT s.doc_id, s.template, s.span FROM spans s JOIN asked a USING (template) WHERE NOT list_has_any(s.spots, a.places)
),
verified AS (
  SELECT *, base AND found = n_grams AS place, (base AND found = n_grams) OR (NOT base AND met AND found / n_grams >= {lic.ENOUGH}) AS holds
  FROM (SELECT s.*, len(spots) AS found, u.span IS NULL AS met
        FROM spans s LEFT JOIN unmet u ON u.doc_id IS NOT DISTINCT FROM s.doc_id AND u.template = s.template AND u.span = s.span)
),
summed AS (
  SELECT doc_id, count(*) FILTER (place) AS n_base, min(start) FILTER (place) AS first_word,
         max(start) FILTER (place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (holds) AS labels,
         max(CASE WHEN base THEN place::INT::DOUBLE WHEN met THEN found / n_grams END) AS score
  FROM verified GROUP BY doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM worded w LEFT JOIN summed USING (doc_id)
"""


def op4(weights: dict[str, float], default: float, seed: int) -> str:
    listed = ", ".join(f"('{k}', {v!r})" for k, v in sorted(weights.items()))
    number = lambda text: f"('0x' || substr(md5({text}), 1, 13))::BIGINT"
    return f"""
WITH listed(source, weight) AS (VALUES {listed}),
counts AS (
  SELECT d.source, count(*) AS n, any_value(coalesce(l.weight, {default!r})) AS weight
  FROM documents d LEFT JOIN listed l USING (source) GROUP BY d.source
),
rates AS (
  SELECT source, weight::DOUBLE / sum(weight::DOUBLE) OVER () * (sum(n) OVER ())::DOUBLE / n AS rate FROM counts
),
terms AS (
  SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
  FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::INT + 1)) AS k FROM rates)
),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
numbers AS (
  SELECT d.doc_id, d.source, {number(f"'{seed}:' || d.doc_id")} / 4503599627370496.0 AS u FROM documents d
),
copies AS (
  SELECT n.doc_id, n.source, (SELECT count(*) FROM cdf c WHERE c.source = n.source AND c.below <= n.u) AS copies
  FROM numbers n
),
each AS (SELECT doc_id, unnest(range(1, copies + 1)) AS copy_no FROM copies WHERE copies > 0)
SELECT e.doc_id, e.copy_no, {number(f"'{seed}:' || e.doc_id || ':' || e.copy_no")} AS mix_key,
       d.text, d.lang, d.source, d.n_chars
FROM each e JOIN documents d USING (doc_id)
"""

#: crc32 of an ASCII text, by its polynomial: a table of 256 remainders made by the rule, then one look-up per byte.
CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(9), lambda r, k: CASE WHEN k = 0 THEN r WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, b)
              ORDER BY b) AS remainders
  FROM range(256) bytes(b)
)"""


def crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT),
      lambda r, b: xor(r >> 8, remainders[xor(r & 255, b) + 1]), 4294967295), 4294967295)"""


OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
shown AS (
  SELECT doc_id, lang, (n_chars::HUGEINT + 1)::VARCHAR AS more, crc32 % 7 = 0 AS tampered,
         [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS fields
  FROM (SELECT d.*, {crc32("doc_id::VARCHAR")} AS crc32 FROM documents d, crc_table)
),
leaves AS (
  SELECT doc_id, lang, sha256(array_to_string(list_transform(fields, lambda v: coalesce(strlen(v)::VARCHAR || ':' || v, '-')), '')) AS leaf,
         CASE WHEN tampered THEN sha256(array_to_string(list_transform(list_concat(fields[1:3], [more], fields[5:]),
           lambda v: coalesce(strlen(v)::VARCHAR || ':' || v, '-')), '')) END AS changed
  FROM shown
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
),
lower_tree AS (
  SELECT lang, 0 AS level, place, leaf AS digest, n FROM ranked
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 1) // 2)
  FROM lower_tree WHERE n > 1 GROUP BY lang, level, place // 2
),
tops AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n, level AS height
  FROM lower_tree WHERE n = 1
),
upper_tree AS (
  SELECT 0 AS level, place, digest, n FROM tops
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 1) // 2)
  FROM upper_tree WHERE n > 1 GROUP BY level, place // 2
),
beside AS (
  SELECT lang, level, xor(place, 1) AS place, digest FROM lower_tree WHERE n > 1
),
folded AS (
  SELECT r.doc_id, r.leaf, r.lang, r.place, t.height, t.digest AS subroot, t.place AS top, 0 AS level,
         coalesce(r.changed, r.leaf) AS digest, '' AS proof
  FROM ranked r JOIN tops t ON t.lang IS NOT DISTINCT FROM r.lang
  UNION ALL
  SELECT f.doc_id, f.leaf, f.lang, f.place // 2, f.height, f.subroot, f.top, f.level + 1,
         sha256(CASE WHEN f.place % 2 = 1 THEN coalesce(b.digest, '') || f.digest ELSE f.digest || coalesce(b.digest, '') END),
         f.proof || coalesce(b.digest, '')
  FROM folded f LEFT JOIN beside b ON b.lang IS NOT DISTINCT FROM f.lang AND b.level = f.level AND b.place = f.place
  WHERE f.level < f.height
),
folded_up AS (
  SELECT doc_id, leaf, subroot, top AS place, 0 AS level, digest, proof FROM folded WHERE level = height
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.place // 2, f.level + 1,
         sha256(CASE WHEN f.place % 2 = 1 THEN coalesce(u.digest, '') || f.digest ELSE f.digest || coalesce(u.digest, '') END),
         f.proof || coalesce(u.digest, '')
  FROM folded_up f LEFT JOIN upper_tree u ON u.level = f.level AND u.place = xor(f.place, 1)
  WHERE f.level < (SELECT max(level) FROM upper_tree)
)
SELECT f.doc_id, f.leaf, f.subroot, u.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = u.digest AS verified
FROM folded_up f, (SELECT digest FROM upper_tree WHERE n = 1) u
WHERE f.level = (SELECT max(level) FROM upper_tree)
"""

#: Edits by the state before a row: start 0, after system 1, user 2, assistant 3; what is needed of the row's initial.
OP11 = rf"""
WITH RECURSIVE {CRC_TABLE},
numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit
  FROM conversations, crc_table
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM numbered WHERE hit > 0
),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, row_number() OVER w AS place
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
),
looked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM looked GROUP BY conv_id
),
insertable(of, "to", letters, cost, line) AS (
  VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
         (0, 2, 'I', 3, 'user:'), (1, 2, 'I', 3, 'user:'), (2, 3, 'I', 3, 'assistant:'), (3, 2, 'I', 3, 'user:')
),
edit(of, "to", letter, cost, needs, new_role) AS (
  SELECT s, s, 'D', 4, NULL::VARCHAR, NULL::VARCHAR FROM range(4) states(s)
  UNION ALL VALUES (0, 2, 'R', 3, NULL::VARCHAR, 'user'), (1, 2, 'R', 3, NULL, 'user'), (2, 3, 'R', 3, NULL, 'assistant'), (3, 2, 'R', 3, NULL, 'user'),
         (0, 1, 'K', 0, 's', NULL::VARCHAR), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL), (3, 2, 'K', 0, 'u', NULL)
),
ways AS (
  SELECT conv_id, 0::BIGINT AS place, 0 AS state, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS way FROM counted
  UNION ALL
  SELECT w.conv_id, w.place + 1, e."to", min({{
           'cost': (w.way).cost + i.cost + e.cost + CASE WHEN e.letter <> 'D' AND l.fault = 'truncated' THEN 3 ELSE 0 END,
           'audit': (w.way).audit || i.letters || e.letter,
           'lines': list_concat((w.way).lines, CASE WHEN i.letters = '' THEN [] ELSE [i.line] END,
                    CASE WHEN e.letter = 'D' THEN [] ELSE [coalesce(e.new_role, l.role) || ':' || l.text] END)}})
  FROM ways w JOIN looked l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.place = w.place + 1
  JOIN insertable i ON i.of = w.state
  JOIN edit e ON e.of = i."to" AND (e.needs IS NULL OR e.needs = l.initial) AND (e.letter = 'D' OR l.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.place, e."to"
),
finished AS (
  SELECT w.conv_id, min({{'cost': (w.way).cost + i.cost, 'audit': (w.way).audit || i.letters,
                        'lines': list_concat((w.way).lines, CASE WHEN i.letters = '' THEN [] ELSE [i.line] END)}}) AS way
  FROM ways w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place
  JOIN insertable i ON i.of = w.state AND i."to" IN (0, 3)
  GROUP BY w.conv_id
)
SELECT v.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
       coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce((f.way).cost, 0)::BIGINT AS cost,
       coalesce((f.way).audit, '') AS audit, sha256(coalesce(array_to_string((f.way).lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM v.conv_id
"""
