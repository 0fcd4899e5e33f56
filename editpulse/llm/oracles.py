"""The registered queries of this subpackage in DuckDB SQL, where SQL can say it."""

from __future__ import annotations

from editpulse.llm.licenses import TEMPLATES

ORACLES: dict[str, str] = {}

_MIX_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES["op9_source_mix"] = f"""
WITH rows AS (
  SELECT doc_id, source, {_MIX_WORDS}::BIGINT AS size, doc_id::VARCHAR AS id,
         md5(concat_ws('|', 'mix', doc_id::VARCHAR, md5(text))) AS print
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source
), weighted AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 3.0::DOUBLE AS top
  FROM sizes
), shares AS (
  SELECT *, ((SELECT sum(source_size) FROM sizes)::DOUBLE
             - coalesce(sum(top) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share,
         row_number() OVER up AS place
  FROM weighted WINDOW up AS (ORDER BY top / weight, source NULLS LAST)
), targets AS (
  SELECT source, source_size, least(top, (SELECT arg_min(share, place) FROM shares WHERE share * weight <= top) * weight) AS target
  FROM shares
), ranked AS (
  SELECT rows.*, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS times,
         (('0x' || substr(print, 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM rows JOIN targets ON rows.source IS NOT DISTINCT FROM targets.source
), odds AS (
  SELECT *, floor(times) AS whole, times - floor(times) AS p FROM ranked
), ordered AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM odds
), upto AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, id NULLS FIRST, size, print) AS words FROM ordered
)
SELECT doc_id, size, source_size, target,
       (size * (whole::BIGINT + coalesce((words - size / 2.0::DOUBLE <= target - source_size * whole AND rank IS NOT NULL)::INT, 0)))::BIGINT AS taken
FROM upto
"""

ORACLES["op3_exact_top_k"] = """
WITH rows AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
  SELECT vec_id, unnest(generate_series(1, len(v))) AS i, unnest(v) AS x FROM rows
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c USING (i)
  WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
  GROUP BY ALL
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scores
QUALIFY rank <= 5
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# crc32 of the bytes of a string, by steps of one byte over a table made here.
_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS crc_step
)"""


def _crc32(text: str) -> str:
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    steps = f"list_reduce(list_prepend(4294967295, list_transform({pairs}, lambda b: ('0x' || b)::BIGINT)), lambda c, b: xor(crc_step[(xor(c, b) & 255) + 1], c >> 8))"
    return f"xor({steps}, 4294967295)"


ORACLES["op11_spelling_variants"] = f"""
WITH {_CRC}, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{_UPPER}', '{_LOWER}') AS run
  FROM documents
), sums AS (
  SELECT run, {_crc32("concat(doc_id::VARCHAR, ':', run)")} AS h FROM runs, crc_table
), results AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word FROM sums
), words AS (
  SELECT word, count(*)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5
), cut AS (
  SELECT DISTINCT word, n, i, word[:i - 1] AS head, word[i + 1:] AS tail FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.head || c.tail
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.head || c.tail
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (
  WITH RECURSIVE chain(word, root, form) AS (
    SELECT word, word, form FROM forms
    UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.form = f.word
  ) SELECT word, root FROM chain WHERE form IS NULL
) r ON f.word = r.word
"""

ORACLES["op12_conversation_trie"] = f"""
WITH {_CRC}, own AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT o.*, ({_crc32("conv_id::VARCHAR")} % 9)::INT AS h FROM own o, crc_table
), whole AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[:a.h], a.turns[a.h + 1:]) AS turns
  FROM shared a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), depths AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM whole
), nodes AS (
  SELECT depth, turns[:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CASE WHEN len(turns) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM depths GROUP BY ALL
), known AS (
  SELECT n.*, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(prefix[depth][2]) ELSE 0 END AS saved,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[:n.depth] = n.prefix) AS n_children
  FROM nodes n
), sums AS (
  SELECT a.depth, a.prefix, sum(b.saved)::BIGINT AS saved_tokens, sum((b.n_children = 0)::INT)::BIGINT AS n_leaves
  FROM known a JOIN known b ON b.depth >= a.depth AND b.prefix[:a.depth] = a.prefix GROUP BY ALL
)
SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, sha256(k.ends) AS ends_sha256
FROM known k JOIN sums s ON s.depth = k.depth AND s.prefix = k.prefix
LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.prefix = k.prefix[:k.depth - 1]
"""

_PASSAGE_WORDS = ", ".join(
    f"({number}, '{label}', {base}, '{word}', {place}, {key})"
    for number, template in enumerate(TEMPLATES)
    for _, label, base, word, place, key in template.rows(number)
)

ORACLES["op13_license_scan"] = f"""
WITH template_words(template, label, base, word, nth, key) AS (VALUES {_PASSAGE_WORDS}),
rows AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), places AS (
  SELECT row, unnest(range(0, len(words))) AS place, unnest(words) AS word FROM rows
), hits AS (
  SELECT row, template, place - nth AS start, count(*) AS matched, sum(key::INT) AS key_matched
  FROM places JOIN template_words USING (word) GROUP BY ALL
), lengths AS (
  SELECT template, any_value(label) AS label, any_value(base) AS base, count(*) AS length, sum(key::INT) AS key_length
  FROM template_words GROUP BY template
), passages AS (
  SELECT row, label, base, start, matched / length AS score FROM hits JOIN lengths USING (template) WHERE key_matched = key_length
), by_row AS (
  SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM passages GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM rows LEFT JOIN by_row USING (row)
"""

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op5_jaccard_join"] = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS s
  FROM cut
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared >= 90 * (a.n + b.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS root FROM cut
  UNION
  SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.doc_id
)
SELECT doc_id, coalesce((SELECT n FROM sizes WHERE sizes.doc_id = reach.doc_id), 0)::BIGINT AS n_shingles,
       min(root) AS component_id,
       (SELECT count(*) FROM links WHERE links.x = reach.doc_id)::BIGINT AS n_links
FROM reach GROUP BY doc_id
"""

_PLAIN_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op4_decontamination"] = f"""
WITH docs AS (
  SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, {_PLAIN_WORDS} AS w FROM benchmark
), wanted AS (
  SELECT DISTINCT item, least(len(w), 10) AS k,
         unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, greatest(len(w) - 8, 2))]) AS s
  FROM items WHERE len(w) > 0
), seen AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w
  FROM docs, (SELECT DISTINCT k FROM wanted) WHERE len(w) >= k
), places AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM seen
), hits AS (
  SELECT doc_id, item, k, i FROM places JOIN wanted USING (k, s)
), words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT doc_id, k, i FROM hits)) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLES["op1_suffix_dedup"] = """
WITH bytes AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents
), strings AS (
  SELECT doc_id, i, b[i + 1:i + 50] AS s
  FROM (SELECT doc_id, b, unnest(range(0, greatest(n - 49, 0))) AS i FROM bytes)
), firsts AS (
  SELECT s, min(doc_id) AS least FROM strings GROUP BY s HAVING count(*) > 1
), hits AS (
  SELECT DISTINCT doc_id, i FROM strings JOIN firsts USING (s) WHERE least < doc_id
), marked AS (
  SELECT doc_id, i, (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) + 50)::INT AS opens FROM hits
), runs AS (
  SELECT doc_id, min(i) AS low, max(i) + 50 AS high
  FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM runs
  UNION ALL
  SELECT doc_id, coalesce(max(high), 0), max(n) FROM bytes LEFT JOIN runs USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, unhex(string_agg(hex(b[low + 1:high]), '' ORDER BY low)) AS rest
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
), counts AS (
  SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(rest) AS kept_sha256
FROM bytes JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


def _doubled(levels: int = 12, width: int = 13) -> str:
    """Windows that another document has too, at each length made of two of half of it."""
    steps = []
    for level in range(levels):
        shift = width << (level - 1) if level else 0
        made = (
            "SELECT doc_id, i, hash(s) AS h FROM windows"
            if not level
            else f"SELECT a.doc_id, a.i, hash(a.h, b.h) AS h FROM shared{level - 1} a "
            f"JOIN shared{level - 1} b ON a.doc_id = b.doc_id AND b.i = a.i + {shift}"
        )
        steps.append(f"""made{level} AS MATERIALIZED ({made}), shared{level} AS MATERIALIZED (
  SELECT * FROM made{level} WHERE h IN (SELECT h FROM made{level} GROUP BY h HAVING min(doc_id) <> max(doc_id)))""")
    return ",\n".join(steps)


ORACLES["op10_substring_dedup"] = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM docs)
), firsts AS (
  SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM (SELECT DISTINCT doc_id, i FROM windows JOIN firsts USING (s) WHERE least < doc_id)
), placed AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), {_doubled()}, levels AS (
  {" UNION ALL ".join(f"SELECT DISTINCT doc_id, {13 << level} AS words FROM shared{level}" for level in range(12))}
)
SELECT doc_id, len(w)::BIGINT AS n_words,
       (SELECT count(*) FROM gone WHERE gone.doc_id = docs.doc_id)::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256,
       coalesce((SELECT max(words) FROM levels WHERE levels.doc_id = docs.doc_id), 0)::INT AS level_words
FROM docs LEFT JOIN kept USING (doc_id)
"""
