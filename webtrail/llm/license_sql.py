"""DuckDB SQL of the licence scan's query."""

from webtrail.llm.license_scan import FILE_SHARE, FUNCTION_WORDS, LICENCE_NAME, MIN_TERMS, TEMPLATES, THRESHOLD

_VALUES = ", ".join("({}, '{}', '{}')".format(i, x, t.replace("'", "''")) for i, (x, t) in enumerate(TEMPLATES))
_FUNCTION = ", ".join(f"'{x}'" for x in sorted(FUNCTION_WORDS))
_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"

LICENSE_SQL = f"""
WITH templates(template, license, t) AS (VALUES {_VALUES}),
tw AS (SELECT template, license, unnest({_TERMS.format('t')}) AS term FROM templates),
words AS (SELECT template, license, term, count(*) AS tf FROM tw GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM words),
files AS (SELECT doc_id AS id, coalesce(source, 'unknown') || '/d' || (doc_id // 1000) || '/d' || (doc_id // 50) || '/'
          || doc_id || '.txt' AS path, text AS t FROM documents),
terms AS (SELECT id, path, {_TERMS.format('t')} AS ts FROM files),
df AS (SELECT v.term, count(d.term) AS df FROM vocab v LEFT JOIN
       (SELECT unnest(list_distinct(ts)) AS term FROM terms) d ON v.term = d.term GROUP BY v.term),
weights AS (SELECT term, ln(((SELECT count(*) FROM files) + 1.0) / (df + 1.0)) + 1.0 AS idf FROM df),
raw AS (SELECT template, license, term, tf * idf AS w FROM words JOIN weights USING (term)),
vectors AS (SELECT license, template, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS tw FROM raw),
lines AS (SELECT id, path, i - 1 AS line_no, {_TERMS.format('ls[i]')} AS ts
          FROM (SELECT id, path, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT id, path, string_split(t, chr(10)) AS ls FROM files))),
picked AS (SELECT id, path, line_no, len(ts) AS n_words, ts FROM lines
           WHERE len(list_intersect(list_distinct(ts), (SELECT list(term) FROM vocab WHERE term NOT IN ({_FUNCTION})))) >= {MIN_TERMS}),
counted AS (SELECT id, path, line_no, n_words, term, count(*) AS tf
            FROM (SELECT id, path, line_no, n_words, unnest(ts) AS term FROM picked) GROUP BY ALL),
weighed AS (SELECT c.*, tf * coalesce(idf, (SELECT avg(idf) FROM weights)) AS w FROM counted c LEFT JOIN weights USING (term)),
norms AS (SELECT id, path, line_no, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
dots AS (SELECT id, path, line_no, n_words, license, template, sum(w * tw) AS dot FROM weighed JOIN vectors USING (term) GROUP BY ALL),
scored AS (SELECT id, path, line_no, n_words, license, round(dot / norm, 6) AS cosine FROM dots JOIN norms USING (id, path, line_no)),
best AS (SELECT id, path, line_no, n_words, license, cosine FROM scored WHERE cosine >= {THRESHOLD}
         QUALIFY row_number() OVER (PARTITION BY id, path, line_no ORDER BY cosine DESC, license) = 1),
own AS (SELECT id, path, license, cosine, line_no, sum(n_words) OVER (PARTITION BY id, path) AS licensed FROM best
        QUALIFY row_number() OVER (PARTITION BY id, path ORDER BY cosine DESC, license, line_no) = 1),
state AS (SELECT s.id, s.path, o.license AS own_license, o.cosine AS own_cosine, o.line_no AS own_line,
          o.license IS NOT NULL AND (regexp_matches(lower(split_part(s.path, '/', -1)), '{LICENCE_NAME}')
                                     OR o.licensed >= {FILE_SHARE} * s.words) AS is_license_file
          FROM (SELECT id, path, sum(coalesce(len(ts), 0)) AS words FROM terms GROUP BY id, path) s
          LEFT JOIN own o ON s.id = o.id AND s.path = o.path),
covers AS (SELECT array_to_string(string_split(path, '/')[:-2], '/') AS dir, own_license AS cover FROM state WHERE is_license_file
           QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_cosine DESC, path) = 1),
above AS (SELECT id, path, d AS depth, array_to_string(parts[:d], '/') AS dir
          FROM (SELECT id, path, parts, unnest(range(0, len(parts))) AS d
                FROM (SELECT id, path, string_split(path, '/') AS parts FROM state WHERE own_license IS NULL))),
nearest AS (SELECT id, path, cover, a.dir FROM above a JOIN covers c ON a.dir = c.dir
            QUALIFY row_number() OVER (PARTITION BY id, path ORDER BY depth DESC) = 1)
SELECT s.id AS doc_id, s.path, own_license, own_cosine, own_line, is_license_file, cover AS inherited_license,
       dir AS inherited_from, coalesce(own_license, cover) AS license
FROM state s LEFT JOIN nearest n ON s.id = n.id AND s.path = n.path
"""
