"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from ballast.llm import host_trust, secret_ledger


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    base = {r.kind for r in secret_ledger.BASE}
    parts = []
    for place, rule in enumerate(secret_ledger.RULES):
        # In RE2 (?i) also folds letters beyond ASCII, so the cases are spelled out.
        pattern = rule.pattern
        for word in ("password", "passwd", "secret", "token", "api", "key"):
            cases = "".join(f"[{c.upper()}{c}]" for c in word)
            pattern = pattern.replace(word, cases) if rule.kind == "assign" else pattern
        p = _quoted(pattern.replace("(?i:", "(?:"))
        parts.append(
            f"""
    SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.kind in base} AS base,
      unnest(list_filter(list_transform(range(1, len(hits) + 1), lambda i: {{
        'start': list_sum(list_transform(gaps[:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0),
        'size': length(hits[i]), 'value': length(vals[i])}}), lambda x: x.value >= {rule.least})) AS s
    FROM (SELECT doc_id, regexp_extract_all(t, {p}, 0) AS hits,
      regexp_extract_all(t, {p}, {rule.group}) AS vals, string_split_regex(t, {p}) AS gaps FROM d)"""
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
told AS (SELECT doc_id, kind, base, s.start AS pos, place,
    kind || ':' || s.start::BIGINT || ':' || (s.start + s.size)::BIGINT AS span FROM found)
SELECT d.doc_id,
  count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY pos, place) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY pos, place), '') AS spans
FROM d LEFT JOIN told ON d.doc_id = told.doc_id GROUP BY d.doc_id"""


COPIES = r"""
WITH n AS (SELECT doc_id,
  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)"""


def _hosts() -> str:
    host = (
        "translate(regexp_extract(coalesce({0}, ''), '(?s)^.*?://([^/?#]*)', 1), "
        f"'{host_trust.UPPER}', '{host_trust.LOWER}')"
    )
    ruled = [
        (f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r)
        for r in sorted(host_trust.RULES, key=lambda r: -len(r.name))
    ]
    rule = " ".join(f"{w} THEN '{r.name}'" for w, r in ruled)
    verdict = " ".join(f"{w} THEN '{r.verdict}'" for w, r in ruled)

    def spread(name: str, seed: str, src: str, dst: str) -> str:
        d = host_trust.DAMPING
        steps = [
            f"{name}_e AS MATERIALIZED (SELECT {src} AS a, {dst} AS b, "
            f"weight / sum(weight) OVER (PARTITION BY {src}) AS share FROM edges)",
            f"{name}_0 AS MATERIALIZED (SELECT host, {1 - d!r} * {seed} AS r FROM seeds WHERE {seed} > 0)",
        ]
        for i in range(host_trust.STEPS):
            steps.append(
                f"{name}_{i + 1} AS MATERIALIZED (SELECT host, sum(r) AS r FROM (SELECT * FROM {name}_0 "
                f"UNION ALL SELECT b, {d!r} * r * share FROM {name}_{i} JOIN {name}_e ON host = a) GROUP BY host)"
            )
        return ", ".join(steps)

    n = host_trust.STEPS
    return f"""
WITH p AS MATERIALIZED (SELECT page_id, html, {host.format("url")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
j AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS own FROM p),
seeds AS MATERIALIZED (SELECT host, avg(CASE WHEN own = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS good,
  avg(CASE WHEN own = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS bad FROM j WHERE host <> '' GROUP BY host),
links AS (SELECT src, {host.format("link")} AS dst FROM (SELECT host AS src, page_id,
  unnest(regexp_extract_all(coalesce(html, ''), {_quoted(host_trust.LINK)}, 1)) AS link FROM p)
  GROUP BY page_id, src, dst),
chains AS (SELECT list_transform(range(1, greatest(len(l), 2)), lambda i: array_to_string(l[i:], '.')) AS c
  FROM (SELECT DISTINCT string_split(host, '.') AS l FROM p WHERE host <> '')),
family AS (SELECT DISTINCT x.a AS a, x.b AS b FROM (SELECT unnest(list_transform(range(1, len(c)),
  lambda i: {{'a': c[i], 'b': c[i + 1]}})) AS x FROM chains)),
edges AS MATERIALIZED (SELECT src, dst, count(*)::DOUBLE AS weight FROM (SELECT * FROM links
  UNION ALL SELECT a, b FROM family UNION ALL SELECT b, a FROM family)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
{spread("t", "good", "src", "dst")},
{spread("u", "bad", "dst", "src")}
SELECT page_id, j.host AS host, path, rule, coalesce(own, CASE WHEN u_{n}.r > 0
  AND round(u_{n}.r / (u_{n}.r + coalesce(t_{n}.r, 0)), {host_trust.DIGITS}) > {host_trust.SHARE}
  THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN t_{n} ON j.host = t_{n}.host LEFT JOIN u_{n} ON j.host = u_{n}.host"""


TRIE = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, turn,
    sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'name': name, 'words': len(list_filter(
      string_split_regex(x, '[\x20\x09-\x0D]+'), lambda w: w <> ''))} ORDER BY turn NULLS FIRST, name[:32]) AS turns,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(c::VARCHAR, ''), lambda y: ord(y)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda z, k: xor(z >> 1, 3988292384 * (z & 1))))) % 4 AS h
  FROM t GROUP BY c),
seqs AS MATERIALIZED (SELECT o.c AS c, coalesce(b.turns[:o.h], []) || o.turns[o.h + 1:] AS turns
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 20),
each AS (SELECT c, unnest(range(0, len(turns) + 1)) AS depth, turns,
    list_transform(turns, lambda y: y.name) AS names FROM seqs),
nodes AS MATERIALIZED (SELECT array_to_string(names[:depth], '') AS id, depth,
    array_to_string(any_value(names)[:depth - 1], '') AS up, any_value(names)[:depth] AS names,
    min(c) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth = 0 THEN 0 ELSE any_value(turns)[depth].words END AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM each GROUP BY id, depth),
kids AS (SELECT up, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
leaves AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.up = n.id AND k.depth = n.depth),
below AS (SELECT array_to_string(names[:a], '') AS id, a AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
    sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM leaves) GROUP BY ALL)
SELECT l.conv_id AS conv_id, l.depth AS depth, p.conv_id AS parent_conv_id, l.n_convs AS n_convs, n_children,
  n_leaves, saved_tokens, l.ends_sha256 AS ends_sha256
FROM leaves l JOIN below b ON b.id = l.id AND b.depth = l.depth
LEFT JOIN nodes p ON p.id = l.up AND p.depth = l.depth - 1"""


NEGATIVES = """
WITH v AS MATERIALIZED (SELECT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS comps
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same,
    list_sum(list_transform(range(1, len(a.comps) + 1), lambda i: a.comps[i] * r.comps[i]))::BIGINT AS score
  FROM v a, v r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same),
f AS (SELECT p.anchor_id AS anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, n ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
  WHERE n <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_ledger": _secrets(),
        "op4_host_trust": _hosts(),
        "op5_block_naming": COPIES,
        "op11_prefix_trie": TRIE,
        "op13_rns_negatives": NEGATIVES,
    }
