"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

# Rules and terms stand here in full, so that the comparison does not share them with the code.
OP7 = """
WITH terms(term, weight) AS (VALUES
        ('adult', 100), ('casino', 100), ('casinos', 100), ('kasino', 100), ('escort', 100), ('escorts', 100),
        ('hentai', 100), ('malware', 100), ('phishing', 100), ('porn', 100), ('porno', 100), ('pornos', 100),
        ('pornografia', 100), ('pornographie', 100), ('viagra', 100), ('cialis', 100), ('warez', 100), ('xxx', 100),
        ('camgirls', 100), ('hardcore', 60), ('erotic', 60), ('erotik', 60), ('erotica', 60), ('erotique', 60),
        ('nude', 60), ('nudes', 60), ('naked', 60), ('nackt', 60), ('desnuda', 60), ('nue', 40),
        ('sex', 80), ('sexe', 80), ('sexo', 80), ('sexy', 60), ('milf', 80), ('fetish', 60),
        ('fetisch', 60), ('strip', 40), ('stripper', 60), ('cams', 50), ('webcam', 40), ('livecam', 60),
        ('dating', 50), ('flirt', 50), ('singles', 40), ('hookup', 60), ('swinger', 80), ('bet', 50),
        ('bets', 60), ('betting', 60), ('wetten', 50), ('apuestas', 60), ('paris', 10), ('poker', 60),
        ('slots', 60), ('slot', 40), ('roulette', 60), ('ruleta', 60), ('blackjack', 60), ('bingo', 50),
        ('jackpot', 60), ('lotto', 50), ('lottery', 50), ('loterie', 50), ('loteria', 50), ('gambling', 80),
        ('bonus', 40), ('bonos', 40), ('win', 40), ('winner', 40), ('gewinn', 40), ('ganar', 40),
        ('gagner', 40), ('prize', 40), ('free', 40), ('gratis', 40), ('gratuit', 40), ('kostenlos', 40),
        ('cheap', 40), ('billig', 40), ('barato', 40), ('deals', 40), ('discount', 40), ('rabatt', 40),
        ('promo', 30), ('coupon', 30), ('loan', 50), ('loans', 50), ('kredit', 50), ('payday', 60),
        ('forex', 60), ('bitcoin', 40), ('crypto', 40), ('invest', 30), ('pills', 60), ('pillen', 60),
        ('pharmacy', 50), ('rx', 40), ('steroids', 80), ('weightloss', 60), ('crack', 60), ('cracked', 60),
        ('keygen', 80), ('serial', 40), ('nulled', 80), ('torrent', 60), ('torrents', 60), ('pirate', 50),
        ('hack', 50), ('hacked', 60), ('hacks', 60), ('cheats', 50), ('exploit', 60), ('spyware', 80),
        ('trojan', 80), ('botnet', 80), ('spam', 50), ('ads', 40), ('adserver', 60), ('banner', 30),
        ('popup', 50), ('track', 30), ('tracker', 40), ('clickbait', 60), ('linkfarm', 80), ('farm', 30),
        ('replica', 60), ('fake', 50)),
rules(verdict, host, path) AS (VALUES
        ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
lowered AS (
    SELECT page_id, url, coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS u,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM lowered),
urls AS (SELECT DISTINCT u FROM parts),
hits AS (
    SELECT u, count(*) FILTER (weight >= 100) AS strict_terms, count(*) FILTER (weight < 100) AS soft_terms,
        coalesce(sum(weight) FILTER (weight < 100), 0) AS soft_weight
    FROM urls JOIN terms ON contains(u, term) AND regexp_matches(u, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])')
    GROUP BY u),
ruled AS (
    SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id)
SELECT page_id, host, path, rule, coalesce(strict_terms, 0)::INT AS strict_terms, coalesce(soft_terms, 0)::INT AS soft_terms,
    coalesce(soft_weight, 0)::INT AS soft_weight,
    coalesce(verdict, CASE WHEN strict_terms > 0 OR (soft_terms >= 2 AND soft_weight >= 100) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN hits USING (u) LEFT JOIN ruled USING (page_id)
"""

OP1 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
        THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
sized AS (SELECT doc_id, gram, n FROM grams JOIN sizes USING (doc_id)),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM sized a JOIN sized b ON a.gram = b.gram AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
    SELECT x, x FROM edges UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
    coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

OP10 = """
WITH pages_read AS (
    SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages),
bits AS (
    SELECT page_id, first_id, strlen(payload) AS payload_bytes, array_to_string(list_transform(range(1, 41), lambda i:
        substr('0000000100100011010001010110011110001001101010111100110111101111',
            4 * strpos('0123456789abcdef', substr(sha1(payload), i, 1)) - 3, 4)), '') AS b
    FROM pages_read)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
        + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT)
        + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT)
        + CAST(substr(b, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM bits
"""

_ROUND = """
near{i} AS MATERIALIZED (
    SELECT rid, arg_min(c, d::HUGEINT * 8 + c) AS c
    FROM (SELECT v.rid, m.c, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - m.v[i]) * (v.v[i] - m.v[i])))::BIGINT AS d
        FROM whole v, centre{i} m) GROUP BY rid),
sums{i} AS MATERIALIZED (
    SELECT c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM whole JOIN near{i} USING (rid)) GROUP BY c, i),
centre{j} AS MATERIALIZED (
    SELECT c, coalesce(moved.v, centre{i}.v) AS v
    FROM centre{i} LEFT JOIN (
        SELECT c, list((CASE WHEN s < 0 THEN -((n - 1 - s) // n) ELSE s // n END)::BIGINT ORDER BY i) AS v FROM sums{i} GROUP BY c) moved USING (c)),"""

OP11 = f"""
WITH whole AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centre0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1)::INT AS c, v
    FROM whole QUALIFY c < 8),
{"".join(_ROUND.format(i=i, j=i + 1) for i in range(10))}
last AS MATERIALIZED (
    SELECT v.vec_id, arg_min(v.c, d::HUGEINT * 8 + v.c) AS cluster, min(d) AS distance
    FROM (SELECT v.rid, v.vec_id, m.c, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - m.v[i]) * (v.v[i] - m.v[i])))::BIGINT AS d
        FROM whole v, centre10 m) v GROUP BY v.rid, v.vec_id)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(centre10.v, ',')) AS centroid_sha256
FROM last JOIN centre10 ON cluster = c
"""

OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
    SELECT lang, k AS len, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM starts, range(1, 6) lengths(k) WHERE i + k - 1 <= len(w)),
counts AS MATERIALIZED (SELECT lang, len, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY lang, len, phrase),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE len = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE len >= 2 AND f >= 100),
cuts AS (
    SELECT c.lang, c.len, c.phrase, c.a, k, x.f AS l, y.f AS r, n, (1000 * c.a * n) // (x.f * y.f) AS score
    FROM (SELECT *, unnest(range(1, len)) AS k FROM candidates) c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
    JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT DISTINCT lang, part, a FROM (
        SELECT c.lang, c.a, array_to_string(w[i:i + k - 1], ' ') AS part
        FROM candidates c, range(2, 5) sizes(k), range(1, 5) places(i) WHERE k < c.len AND i + k - 1 <= c.len)),
kept AS (
    SELECT * FROM lowest p WHERE NOT EXISTS (
        SELECT 1 FROM inside q WHERE q.lang = p.lang AND q.part = p.phrase AND 100 * q.a >= 100 * p.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""

ORACLE = {"op1_near_dedup": OP1, "op7_urls": OP7, "op10_warc": OP10, "op11_centroids": OP11, "op12_collocations": OP12}
