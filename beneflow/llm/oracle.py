"""DuckDB texts of the queries that SQL can express."""

EXACT_TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Items of fewer words than a window are one window of their own length, so documents are cut into
# windows of every length that occurs.
DECONTAMINATION = r"""
WITH item_words AS (
    SELECT item_id::VARCHAR AS id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), item_windows AS (
    SELECT DISTINCT id, least(13, len(w)) AS n, array_to_string(list_slice(w, pos, pos + least(13, len(w)) - 1), ' ') AS part
    FROM item_words, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(pos)
    WHERE len(w) > 0
), doc_windows AS (
    SELECT doc_id, pos, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS part
    FROM doc_words, (SELECT DISTINCT n FROM item_windows) AS lengths, unnest(range(1, len(w) - n + 2)) AS t(pos)
), found AS (
    SELECT doc_id, pos, n, id FROM doc_windows JOIN item_windows USING (n, part)
), hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT DISTINCT doc_id, pos, n FROM found) AS f, unnest(range(pos, pos + n)) AS t(word) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Targets: a source is at its limit if the water level of all with a smaller limit per weight reaches it.
# Seats: the highest quotients of all possible seats, first over sources, then over a source's shards.
MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS key
    FROM documents
), summed AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, n_rows, (row_number() OVER (ORDER BY source NULLS LAST) - 1)::INTEGER AS src FROM summed
), numbered AS (
    SELECT *, 1 + src % 3 AS weight, 3 * source_size AS cap, 3.0::DOUBLE * source_size / (1 + src % 3) AS level
    FROM weighed
), levels AS (
    SELECT *, (sum(source_size) OVER ())::BIGINT AS whole,
           coalesce(sum(cap) OVER below, 0)::BIGINT AS cap_below, (sum(weight) OVER up)::BIGINT AS weight_up
    FROM numbered WHERE source_size > 0
    WINDOW below AS (ORDER BY level, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           up AS (ORDER BY level, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), limited AS (
    SELECT *, (whole - cap_below) * weight > cap * weight_up AS full_up FROM levels
), shared AS (
    SELECT (whole - cap_below) AS rest, weight_up FROM limited WHERE NOT full_up ORDER BY level, src LIMIT 1
), aimed AS (
    SELECT n.source, n.src, n.source_size,
           CASE WHEN n.source_size = 0 THEN 0.0::DOUBLE WHEN l.full_up THEN n.cap::DOUBLE
                ELSE (s.rest * n.weight)::DOUBLE / s.weight_up END AS target,
           greatest(1, (greatest(n.source_size, n.n_rows) + 799999) // 800000) AS sub
    FROM numbered n LEFT JOIN limited l USING (src) LEFT JOIN shared s ON true
), placed AS (
    SELECT doc_id, size, key, src, source_size, target,
           ('0x' || substr(key, 1, 8))::BIGINT % (16 * sub) AS bucket,
           (('0x' || substr(key, 1, 8))::BIGINT % (16 * sub)) // sub AS shard
    FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source
), ends AS (
    SELECT *, (sum(size) OVER (PARTITION BY src, shard ORDER BY bucket, key, doc_id, size
                               ROWS UNBOUNDED PRECEDING))::BIGINT AS e
    FROM placed
), shards AS (
    SELECT src, shard, sum(size)::BIGINT AS total FROM placed GROUP BY src, shard HAVING sum(size) > 0
), source_seats AS (
    SELECT src, count(*) AS seats FROM (
        SELECT src, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, src, seat) AS place
        FROM aimed, unnest(range(3 * source_size)) AS t(seat)
    ) WHERE place <= (SELECT sum(source_size) FROM aimed) GROUP BY src
), shard_seats AS (
    SELECT src, shard, count(*) AS quota FROM (
        SELECT src, shard, seats,
               row_number() OVER (PARTITION BY src ORDER BY total::DOUBLE / (2 * seat + 1) DESC, shard, seat) AS place
        FROM shards JOIN source_seats USING (src), unnest(range(3 * total)) AS t(seat)
    ) WHERE place <= seats GROUP BY src, shard
), ranges AS (
    SELECT src, shard, quota // total AS rounds, start AS a1, least(start + quota % total, total) AS b1,
           greatest(0, start + quota % total - total) AS b2
    FROM (SELECT *, 64 * (('0x' || substr(md5('17:' || src || ':' || shard), 1, 8))::BIGINT % ((total + 63) // 64)) AS start
          FROM shards JOIN shard_seats USING (src, shard))
)
SELECT doc_id, size, source_size, target,
       CASE WHEN rounds IS NULL THEN 0  -- least and greatest pass over NULL
            ELSE rounds * size + greatest(0, least(b1, e) - greatest(a1, e - size))
                 + greatest(0, least(b2, e) - (e - size)) END::BIGINT AS taken
FROM ends LEFT JOIN ranges USING (src, shard)
"""

# The checksum bit by bit over a table of 256, as DuckDB has none. Two words of one length are near if they are
# equal without the same place; of lengths that differ by one, if the longer without some place is the shorter.
SPELLING = r"""
WITH RECURSIVE bits AS (
    SELECT b AS byte, 0 AS round, b::BIGINT AS c FROM range(256) AS t(b)
    UNION ALL
    SELECT byte, round + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM bits WHERE round < 8
), crc AS (
    SELECT list(c ORDER BY byte) AS codes FROM bits WHERE round = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295::BIGINT, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(
            range(1, strlen(hex(concat(doc_id, ':', run))) // 2 + 1),
            lambda i: ('0x' || substr(hex(concat(doc_id, ':', run)), 2 * i - 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]))) AS h
    FROM counted, crc
), typed AS (
    SELECT CASE WHEN h % 97 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
    FROM hashed
), known AS (
    SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), without AS (
    SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest
    FROM known, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
    SELECT a.word, b.word AS near, b.n FROM without a JOIN without b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT w.word, k.word, k.n FROM without w JOIN known k ON k.word = w.rest
    UNION SELECT k.word, w.word, w.n FROM without w JOIN known k ON k.word = w.rest
), chosen AS (
    SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place,
           count(*) OVER (PARTITION BY word) AS n_near
    FROM near
), formed AS (
    SELECT k.word, k.n, coalesce(c.n_near, 0)::BIGINT AS n_near, CASE WHEN c.n >= 2 * k.n THEN c.near END AS form,
           CASE WHEN c.n >= 2 * k.n THEN c.n END::BIGINT AS form_n
    FROM known k LEFT JOIN chosen c ON c.word = k.word AND c.place = 1
), walked AS (
    SELECT word, word AS root, form AS ahead FROM formed
    UNION ALL
    SELECT w.word, f.word, f.form FROM walked w JOIN formed f ON f.word = w.ahead
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM walked WHERE ahead IS NULL) USING (word)
"""

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM documents, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t(piece)
), totals AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang
), frequent AS (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*)::HUGEINT AS a
    FROM pieces, unnest(range(1, 6)) AS t(k), unnest(range(1, len(w) - k + 2)) AS s(i)
    GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, phrase, a, cut, array_to_string(list_slice(string_split(phrase, ' '), 1, cut), ' ') AS head,
           array_to_string(list_slice(string_split(phrase, ' '), cut + 1, k), ' ') AS tail
    FROM frequent, unnest(range(1, k)) AS t(cut)
), scored AS (
    SELECT c.lang, c.phrase, c.a, h.a AS l, t.a AS r, n, (1000::HUGEINT * c.a * n) // (h.a * t.a) AS score,
           row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000::HUGEINT * c.a * n) // (h.a * t.a), cut) AS place
    FROM cuts c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head
    JOIN frequent t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals ON totals.lang = c.lang
), inner_parts AS (
    SELECT lang, array_to_string(list_slice(string_split(phrase, ' '), i, i + m - 1), ' ') AS phrase, max(a) AS most
    FROM frequent, unnest(range(2, k)) AS t(m), unnest(range(1, k - m + 2)) AS s(i) GROUP BY ALL
), kept AS (
    SELECT s.* FROM scored s LEFT JOIN inner_parts p ON p.lang = s.lang AND p.phrase = s.phrase
    WHERE place = 1 AND (most IS NULL OR 100 * most < 100 * a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


def _url_templates(depth: int = 6) -> str:
    """The tree level by level: CTE ``level<d>`` holds the shapes with their first d template segments.

    SQL has a level written out for each segment of the longest path; no given table has one of more than two.
    """
    segments = [f"s{d}" for d in range(1, depth + 2)]
    rule = lambda host, path: (
        f"((host = '{host}' OR suffix(host, '.{host}')) AND prefix(path, '{path}'))"
    )
    # Longest first.
    rules = [("example.org", "/en/1", "block"), ("example.org", "/es/", "block"), ("com", "/de/", "block"),
             ("com", "/fr/", "allow"), ("org", "/", "allow")]
    whens = lambda what: " ".join(f"WHEN {rule(h, p)} THEN '{what(h, p, v)}'" for h, p, v in rules)
    parts = ["""parsed AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages)""",
    f"""judged AS (
    SELECT *, CASE {whens(lambda h, p, v: h + p)} END AS rule, CASE {whens(lambda h, p, v: v)} END AS ruled,
           list_filter(string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/'), lambda s: s <> '') AS parts
    FROM parsed)""",
    f"""pages_by_shape AS (
    SELECT *, {', '.join(f"coalesce(parts[{d}], '') AS s{d}" for d in range(1, depth + 1))},
           CASE WHEN len(parts) > {depth} THEN '**' ELSE '' END AS s{depth + 1}
    FROM judged)""",
    f"""level0 AS (
    SELECT host, {', '.join(segments)}, count(*) AS n, count(*) FILTER (ruled = 'allow') AS good,
           count(ruled) AS labelled
    FROM pages_by_shape GROUP BY ALL)"""]  # fmt: skip
    for d in range(1, depth + 1):
        node = ", ".join(["host", *[f"t{i}" for i in range(1, d)]])
        tail = f"concat_ws('/', {', '.join(segments[d:])})"
        parts.append(f"""tails{d} AS MATERIALIZED (
    SELECT {node}, s{d}, {tail} AS tail, sum(n)::DOUBLE AS n, sum(good)::DOUBLE AS good,
           sum(labelled)::DOUBLE AS labelled FROM level{d - 1} GROUP BY {node}, s{d}, {tail}),
branches{d} AS (
    SELECT {node}, s{d}, sum(n) AS n_b, sum(good) AS good_b, sum(labelled) AS labelled_b FROM tails{d} GROUP BY {node}, s{d}),
nodes{d} AS (
    SELECT {node}, sum(n_b) AS n_p, sum(good_b) AS good_p, sum(labelled_b) AS labelled_p, count(*) AS children
    FROM branches{d} GROUP BY {node}),
node_tails{d} AS (SELECT {node}, tail, sum(n) AS n_t FROM tails{d} GROUP BY {node}, tail),
distances{d} AS (
    SELECT {node}, s{d}, n_b, good_b, labelled_b, n_p, children,
           CASE WHEN labelled_p > 0 THEN good_p / labelled_p ELSE 0 END AS rate,
           (sum(abs(n / n_b - n_t / n_p)) + 1 - sum(n_t / n_p)) / 2 AS distance
    FROM (SELECT {node}, s{d}, tail, n FROM tails{d}) JOIN branches{d} USING ({node}, s{d}) JOIN nodes{d} USING ({node})
         JOIN node_tails{d} USING ({node}, tail)
    GROUP BY ALL),
level{d} AS MATERIALIZED (
    SELECT level{d - 1}.*, CASE WHEN s{d} <> '' AND ((children >= 16 AND n_b < n_p * 0.05)
               OR (distance <= 0.2 + 1 / sqrt(n_b)
                   AND NOT (good_b - labelled_b * rate) ** 2 > labelled_b * rate * (1 - rate) * 3.84))
           THEN '*' ELSE s{d} END AS t{d}
    FROM level{d - 1} JOIN distances{d} USING ({node}, s{d}))""")
    parts.append(f"""pure0 AS (
    SELECT host, (sum(good) + 10 * (SELECT (sum(good) + 1) / (sum(labelled) + 2)::DOUBLE FROM level{depth}))
                 / (sum(labelled) + 10)::DOUBLE AS purity FROM level{depth} GROUP BY host)""")
    for d in range(1, depth + 1):
        above = ", ".join(["host", *[f"t{i}" for i in range(1, d)]])
        parts.append(f"""pure{d} AS (
    SELECT {above}, t{d}, {f"CASE WHEN t{d - 1} = '' THEN purity ELSE " if d > 1 else ""}(g + 10 * purity) / (l + 10)::DOUBLE{" END" if d > 1 else ""} AS purity
    FROM (SELECT {above}, t{d}, sum(good) AS g, sum(labelled) AS l FROM level{depth} GROUP BY {above}, t{d})
         JOIN pure{d - 1} USING ({above}))""")
    node = ", ".join(["host", *[f"t{i}" for i in range(1, depth + 1)]])
    return f"""WITH {', '.join(parts)}
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM pages_by_shape LEFT JOIN (SELECT host, {', '.join(segments)}, purity FROM level{depth} JOIN pure{depth} USING ({node}))
     USING (host, {', '.join(segments)})
"""


URL_TEMPLATES = _url_templates()

# Base 32 of the 40 hexadecimal digits: five at a time are four characters.
ZIP_WARC = """
WITH digested AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
    SELECT hex, min(page_id) AS first FROM digested GROUP BY hex
), named AS (
    SELECT page_id, payload_bytes, first, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER,
               1)), '') AS payload_digest
    FROM digested JOIN firsts USING (hex)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM named
"""

# Sets by all pairs that share a shingle; components by the smallest id reachable.
JACCARD_JOIN = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')))
        END AS s
    FROM split
), tokens AS MATERIALIZED (
    SELECT doc_id, len(s) AS n, unnest(s) AS token FROM shingled
), pairs AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, pairs.b FROM reached JOIN pairs ON reached.b = pairs.a
), components AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
), classes AS (
    SELECT doc_id, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(s)) END AS class_id FROM shingled
), class_links AS (
    SELECT ca.class_id, any_value(a) AS doc_id, count(DISTINCT cb.class_id) AS n_links
    FROM pairs JOIN classes ca ON a = ca.doc_id JOIN classes cb ON b = cb.doc_id
    WHERE ca.class_id <> cb.class_id GROUP BY ca.class_id
), component_sums AS (
    SELECT component_id, sum(n_links) // 2 AS component_links FROM class_links JOIN components USING (doc_id) GROUP BY component_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links,
       coalesce(component_links, 0)::BIGINT AS component_links
FROM shingled JOIN components USING (doc_id) JOIN classes USING (doc_id)
     LEFT JOIN (SELECT class_id, n_links FROM class_links) USING (class_id) LEFT JOIN component_sums USING (component_id)
"""
