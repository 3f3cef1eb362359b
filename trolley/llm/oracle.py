"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

from trolley.llm.centroids import CENTROIDS, DIMENSIONS, ROUNDS, SCALE, SEED
from trolley.llm.licenses import NO_RIGHTS, TEMPLATES, TERM, THRESHOLD
from trolley.llm.queries import FOLDER
from trolley.llm.quality_rules import COVERED_PERCENT, LEAST, LONGEST, MIN_WORDS, WINDOW, WINDOW_PERCENT

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP1 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<turn ' || replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>') || '>' || chr(10)
        || replace(replace(text, '\', '\\'), '<', '\<') || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP2 = f"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM tokens)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (shingle)
    JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(s.n) + any_value(t.n) - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""

OP6 = """
WITH vectors AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
        list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""

OP7 = f"""
WITH lines AS (
    SELECT doc_id, unnest(split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(split(coalesce(text, ''), chr(10)), 1) AS no
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS line_key FROM lines
), owners AS (
    SELECT line_key, min(doc_id) AS owner FROM keyed WHERE length(line_key) >= 10
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT doc_id, line, no, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed LEFT JOIN owners USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


_TEMPLATES = " UNION ALL ".join(f"SELECT '{name}' AS licence, '{text}' AS text" for name, text in TEMPLATES.items())
OP8 = f"""
WITH files AS (
    SELECT doc_id, text, concat_ws('/', coalesce(source, ''), coalesce(lang, ''), doc_id // {FOLDER},
        CASE WHEN doc_id % {FOLDER} = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END) AS path FROM documents
), templates AS (
    SELECT licence, term, count(*) AS tf FROM (
        SELECT licence, lower(unnest(regexp_extract_all(text, '{TERM}'))) AS term FROM ({_TEMPLATES}))
    GROUP BY ALL
), total AS (SELECT count(*) AS n FROM files
), df AS (
    SELECT term, count(DISTINCT doc_id) AS df FROM (
        SELECT doc_id, lower(unnest(regexp_extract_all(text, '{TERM}'))) AS term FROM files)
    WHERE term IN (SELECT term FROM templates) GROUP BY term
), idf AS (
    SELECT DISTINCT term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM templates LEFT JOIN df USING (term), total
), units AS (
    SELECT licence, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY licence)) AS unit FROM templates JOIN idf USING (term)
), lines AS (
    SELECT doc_id, unnest(split(text, chr(10))) AS line, generate_subscripts(split(text, chr(10)), 1) AS no FROM files
), found AS (
    SELECT doc_id, no, term, count(*) AS tf FROM (
        SELECT doc_id, no, lower(unnest(regexp_extract_all(line, '{TERM}'))) AS term FROM lines)
    GROUP BY ALL
), weighed AS (
    SELECT doc_id, no, term, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM found LEFT JOIN idf USING (term), total
), scores AS (
    SELECT doc_id, no, licence, round(dot / norm, 6) AS score
    FROM (SELECT doc_id, no, licence, sum(w * unit) AS dot FROM weighed JOIN units USING (term) GROUP BY ALL)
    JOIN (SELECT doc_id, no, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL) USING (doc_id, no)
), own AS (
    SELECT doc_id, licence AS own_licence, score AS own_score FROM scores WHERE score >= {THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY licence = '{NO_RIGHTS}', score DESC, licence, no) = 1
), named AS (
    SELECT doc_id, path, own_licence, own_score, split(path, '/') AS parts FROM files LEFT JOIN own USING (doc_id)
), holders AS (
    SELECT array_to_string(parts[1:len(parts) - 1], '/') AS dir, arg_min(own_licence, doc_id) AS licence
    FROM named WHERE parts[len(parts)] = 'LICENSE' AND own_licence <> '{NO_RIGHTS}' GROUP BY dir
)
SELECT n.path, n.doc_id, own_licence, own_score, coalesce(own_licence, licence) AS licence,
    CASE WHEN own_licence IS NULL THEN dir END AS inherited_from
FROM named n LEFT JOIN holders ON dir = array_to_string(parts[1:len(parts) - 1], '/')
"""



def _round(i: int) -> str:
    """Round i: every vector to its nearest centroid, then the floor of the mean of each component."""
    return f"""
, a{i} AS MATERIALIZED ({_assigned(i)}), s{i} AS (
    SELECT cluster, part, sum(x[part])::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM a{i}, range(1, {DIMENSIONS + 1}) AS r(part) GROUP BY ALL
), m{i} AS (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY part) AS c FROM s{i} GROUP BY cluster
), c{i + 1} AS MATERIALIZED (SELECT j, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} ON j = cluster)"""


def _assigned(i: int) -> str:
    return f"""
    SELECT vec_id, x, (best).j::INT AS cluster, (best).d AS distance FROM (
        SELECT vec_id, x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'j': j}}) AS best
        FROM vectors, c{i} GROUP BY vec_id, x)"""


OP11 = f"""
WITH vectors AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS j, x AS c FROM vectors
    QUALIFY j < {CENTROIDS}
) {''.join(map(_round, range(ROUNDS)))}, final AS MATERIALIZED ({_assigned(ROUNDS)})
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM final JOIN c{ROUNDS} ON j = cluster
"""


def _repeated(size: int) -> str:
    """Words of each document in windows of ``size`` words that it has twice or more."""
    return f"""
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(range(first, first + {size})) AS place FROM (
            SELECT doc_id, unnest(range(1, len(w) - {size - 2})) AS first,
                unnest(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS gram
            FROM words WHERE len(w) >= {size})
        QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1)
    GROUP BY doc_id"""


OP12 = f"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), base AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS own
    FROM words
), windows AS ({_repeated(WINDOW)}), runs AS ({_repeated(LEAST)}), long AS ({_repeated(LONGEST + 1)}), measured AS (
    SELECT doc_id, n_words, word_chars, n_symbols, (len(own) - len(list_distinct(own)))::BIGINT AS n_dup_lines,
        coalesce(windows.n, 0) AS n_repeat_words, coalesce(runs.n, 0) AS n_covered, long.n IS NOT NULL AS too_long
    FROM base LEFT JOIN windows USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN long USING (doc_id)
), judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {WINDOW_PERCENT} * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT too_long AND 100 * n_covered <= {COVERED_PERCENT} * n_words AS kept
FROM judged
"""

SQL = {"op1_chat_format": OP1, "op2_jaccard": OP2, "op6_neighbours": OP6, "op7_line_dedup": OP7, "op8_licenses": OP8, "op11_centroids": OP11, "op12_quality_rules": OP12}
