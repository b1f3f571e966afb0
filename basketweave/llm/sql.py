"""SQL for the queries that SQL can express, as DuckDB reads it.

The others have none: edit distance within a window (1), patterns that look around
them (3), approximate search (4), fitted models (5, 9), a tokenizer (6) and compressed
files (10). Their tests hold them against brute force.
"""

from __future__ import annotations

from collections.abc import Sequence

from basketweave.llm import minhash, mixing, urls
from basketweave.llm.common import WORD

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates() -> str:
    """All pairs that share a shingle, and the closure of the links."""
    n = minhash.SHINGLE
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1),
    lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS g
  FROM w WHERE len(w) > 0),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM g AS a JOIN g AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN s AS x ON x.doc_id = a JOIN s AS y ON y.doc_id = b
  WHERE 100 * p.c >= {minhash.SIMILARITY} * (x.n + y.n - p.c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN s ON s.doc_id = c.doc_id"""


def mixing_order(entropy: float, repeats: float) -> str:
    """Bisection by a recursive query, then running totals over blocks and groups."""
    steps = mixing.ROUNDS * (mixing.SPLITS.bit_length() - 1)
    seed = mixing.SEED

    def number(text: str) -> str:
        return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"

    def before(value: str, by: str, order: str) -> str:
        return f"sum({value}) OVER (PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING) - {value}"

    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n,
    coalesce('s' || source, '') AS src FROM documents),
k AS (SELECT *, concat_ws('|', doc_id, n) AS k FROM d),
s AS (SELECT src, sum(n)::BIGINT AS t, count(*) AS c FROM k GROUP BY src),
a AS (SELECT sum(t)::BIGINT AS whole FROM s),
p AS (SELECT list(t / whole) FILTER (t > 0) AS ps FROM s, a),
bis AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, mid, most / z > {repeats} OR ln(z) - mid * ws / z >= {entropy} * ln(len(ps)) AS up FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS mid, ps,
        list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2))) AS z,
        list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2) * ln(x))) AS ws,
        list_max(list_transform(ps, lambda x: pow(x, (lo + hi) / 2) / x)) AS most
      FROM bis, p WHERE i < {steps}))),
e AS (SELECT hi AS e FROM bis WHERE i = {steps}),
x AS (SELECT *, CASE WHEN t > 0 THEN pow(t / whole, e) ELSE 0 END AS r FROM s, a, e),
q AS (
  SELECT src, t, round(r / (SELECT sum(r) FROM x) * whole)::BIGINT AS quota, ceil(c / {mixing.BLOCK_DOCS})::BIGINT AS b
  FROM x),
y AS (
  SELECT *, CASE WHEN t > 0 THEN greatest(ceil(quota / t), 1) ELSE 1 END::BIGINT AS epochs,
    ceil(b / {mixing.GROUP_BLOCKS})::BIGINT AS g FROM q),
o AS (SELECT k.*, t, quota, epochs, g, {number(f"concat_ws('|', '{seed}', k)")} % b AS blk FROM k JOIN y USING (src)),
f AS (
  SELECT src, blk, blk % g AS grp, unnest(range(epochs)) AS e, s FROM (
    SELECT src, blk, g, epochs, sum(n)::BIGINT AS s FROM o GROUP BY ALL)),
h AS (SELECT src, e, grp, sum(s)::BIGINT AS gs FROM f GROUP BY ALL),
i AS (SELECT *, {before("gs", "src, e", f"md5(concat_ws('|', '{seed}', src, e, grp)), grp")} AS bg FROM h),
j AS (SELECT *, {before("s", "src, e, grp", f"md5(concat_ws('|', '{seed}', src, e, blk)), blk")} AS bb FROM f),
l AS (SELECT j.src, j.e, blk, bg + bb + j.e * t AS start FROM j JOIN i USING (src, e, grp) JOIN y USING (src)),
m AS (
  SELECT doc_id, source, n, quota, e,
    start + {before("n", "o.src, e, o.blk", f"md5(concat_ws('|', '{seed}', e, k)), k")} AS pos
  FROM o JOIN l ON l.src = o.src AND l.blk = o.blk WHERE start <= quota)
SELECT doc_id, source, n AS mix_tokens, e AS mix_epoch,
  CASE WHEN quota > 0 THEN pos::BIGINT / quota ELSE 0.0 END AS mix_position
FROM m WHERE pos < quota OR (n = 0 AND pos = quota)"""


def url_verdicts(rules: Sequence[urls.Rule]) -> str:
    """Rules as a join, and one common table for each round of PageRank."""
    values = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    host = r"translate(regexp_extract({}, '(?s)^.*?://([^/?#]*)', 1), " + f"'{UPPER}', '{LOWER}')"
    link = urls.LINK.replace("'", "''")
    d = urls.DAMPING
    rounds = ["r0 AS MATERIALIZED (SELECT host, good AS t, bad AS d FROM s)"]
    for n in range(urls.MAX_ROUNDS):
        rounds.append(
            f"""r{n + 1} AS MATERIALIZED (
  SELECT host, {d} * coalesce(mt, 0) + (1 - {d} + {d} * (1 - (SELECT coalesce(sum(mt), 0) FROM m{n}))) * good AS t,
    {d} * coalesce(md, 0) + (1 - {d} + {d} * (1 - (SELECT coalesce(sum(md), 0) FROM m{n}))) * bad AS d
  FROM s LEFT JOIN m{n} USING (host))"""
        )
        rounds.insert(
            len(rounds) - 1,
            f"""m{n} AS MATERIALIZED (SELECT host, sum(mt) AS mt, sum(md) AS md FROM (
  SELECT dst AS host, t * go AS mt, 0 AS md FROM w JOIN r{n} ON host = src
  UNION ALL SELECT src, 0, d * back FROM w JOIN r{n} ON host = dst) GROUP BY host)""",
        )
    return f"""
WITH u AS (
  SELECT page_id, html, coalesce({host.format("url")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS n FROM pages),
rule(verdict, h, p) AS (VALUES {values}),
f AS (
  SELECT u.n, arg_max(h || p, len(h || p)) AS rule, arg_max(verdict, len(h || p)) AS verdict
  FROM u JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY u.n),
j AS (SELECT u.page_id, host, path, rule, verdict FROM u LEFT JOIN f USING (n)),
e AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT host AS src, coalesce({host.format("CASE WHEN starts_with(l, '//') THEN 'x:' || l ELSE l END")}, '') AS dst FROM (
      SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS l FROM u) WHERE regexp_matches(l, '{urls.ABSOLUTE}'))
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
w AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS go, n / sum(n) OVER (PARTITION BY dst) AS back FROM e),
z AS (
  SELECT host, count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad
  FROM j WHERE host <> '' GROUP BY host
  UNION ALL SELECT src, 0, 0 FROM e UNION ALL SELECT dst, 0, 0 FROM e),
s AS MATERIALIZED (
  SELECT host, sum(good) / greatest((SELECT sum(good) FROM z), 1) AS good,
    sum(bad) / greatest((SELECT sum(bad) FROM z), 1) AS bad FROM z GROUP BY host),
{", ".join(rounds)}
SELECT page_id, j.host, path, rule, coalesce(verdict,
  CASE WHEN r.d > 0 AND r.d > {urls.LIMIT} * (r.t + r.d) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN r{urls.MAX_ROUNDS} AS r ON r.host = j.host"""


def phrases(top: int, longest: int = 3, least: int = 10, absorbed: int = 50) -> str:
    """Phrases by their cohesion; every n-gram is listed, so for small tables."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, unnest([w[i:i + k] FOR k IN range(0, {longest}) IF i + k <= len(w)]) AS phrase FROM starts),
f AS (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, any_value(phrase) AS w, count(*) AS f
  FROM grams GROUP BY lang, array_to_string(phrase, ' ')),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(w) = 1 GROUP BY lang),
found AS (SELECT * FROM f WHERE len(w) > 1 AND f >= {least}),
cuts AS (SELECT lang, phrase, w, f AS a, unnest(range(1, len(w))) AS k FROM found),
parts AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
    CAST(1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:len(c.w)], ' ')),
best AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, f, w, unnest(range(1, len(w))) AS i FROM found WHERE len(w) > 2),
absorbing AS (
  SELECT lang, array_to_string(part, ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, unnest([w[i:j] FOR j IN range(i + 1, len(w) + 1) IF j - i < len(w) - 1]) AS part FROM inside)
  GROUP BY lang, array_to_string(part, ' ')),
kept AS (
  SELECT b.* FROM best b LEFT JOIN absorbing x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE x.longer IS NULL OR 100 * x.longer < {absorbed} * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT k.lang, row_number() OVER (
      PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
    phrase, a, l, r, n, score
  FROM kept k JOIN n ON n.lang = k.lang)
WHERE rank <= {top}"""
