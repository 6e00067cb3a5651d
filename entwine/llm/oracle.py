"""DuckDB SQL that gives the rows of those queries of the subpackage that SQL can express, over whole tables."""

from __future__ import annotations

from . import decontaminate, repeats, secrets

#: Characters of a private area that mark where a match begins and ends.
_OPEN, _SHUT = "chr(57344)", "chr(57345)"


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
_VALUE = "[A-Za-z0-9+/_.=-]+"
_ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?{_VALUE}"""
#: By kind: pattern, value of a match m, and what a match must pass.
_FINDERS = {
    "assign": (_ASSIGN, rf"""regexp_extract(m, '^(?:{_NAMES})["'']?\x20*[:=]\x20*["'']?({_VALUE})$', 1)""", "length(v) >= 8"),
    "access": ("AKIA[A-Z0-9]+", "m", "length(v) >= 16"),
    "hex": ("[0-9a-f]{32,}", "m", "true"),
    "jwt": (secrets.EXTRA["jwt"][0].pattern, "m", "true"),
    "prefixed": (secrets.EXTRA["prefixed"][0].pattern, "m", "true"),
    "block": (secrets.BLOCK.replace("(", "(?:", 1), rf"""regexp_replace(regexp_extract(m, '^{secrets.BLOCK}$', 1), '\s', '', 'g')""", "true"),
    "base64": ("[A-Za-z0-9+/_-]{40,}={0,2}", "m", "len(list_distinct(string_split(v, ''))) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')"),
}


def _found(kind: str) -> str:
    """(r, owner, kind, rank, a, b, v): matches with their places. Each match is put between two marks, the text is
    cut at the first, and the lengths of the cuts give the places."""
    pattern, value, passes = _FINDERS[kind]
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT r, owner, '{kind}' AS kind, {list(_FINDERS).index(kind)} AS rank, a, a + length(m) AS b, v FROM (
      SELECT *, {value} AS v FROM (
        SELECT r, owner, k, split_part(cut, {_SHUT}, 1) AS m,
               sum(length(cut) - CASE WHEN k = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY k) - (length(cut) - CASE WHEN k = 1 THEN 0 ELSE 1 END) AS a
        FROM (SELECT r, owner, unnest(cuts) AS cut, generate_subscripts(cuts, 1) AS k
              FROM (SELECT r, owner, string_split(regexp_replace(t, '({quoted})', {_OPEN} || '\\1' || {_SHUT}, 'g'), {_OPEN}) AS cuts FROM d))
      ) WHERE k > 1
    ) WHERE {passes}"""


def op2() -> str:
    joined = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank)"
    base = "kind IN (" + ", ".join(f"'{k}'" for k in secrets.BASE) + ")"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
    found AS ({" UNION ALL ".join(_found(k) for k in _FINDERS)}),
    owners AS (SELECT v, count(DISTINCT owner) AS n FROM found GROUP BY v),
    kept AS (SELECT found.*, owners.n AS n FROM found JOIN owners USING (v) WHERE {base} OR owners.n <= {secrets.MOST_OWNERS}),
    per AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)},
                   {joined} FILTER ({base}) AS base, {joined} AS spans, count(*) FILTER (n > {secrets.MOST_OWNERS}) AS n_copied FROM kept GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied
    FROM d LEFT JOIN per USING (r)"""


def op3() -> str:
    n = repeats.LENGTH
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, {2 * n})) AS s FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {n - 1})) AS i FROM d WHERE length(h) >= {2 * n})),
    twice AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
    hit AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w SEMI JOIN twice USING (s)),
    run AS (SELECT r, i, sum(CASE WHEN before IS NULL OR before + {n} < i THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM hit),
    span AS (SELECT r, k, min(i) AS a, max(i) + {n} AS b FROM run GROUP BY r, k),
    edge AS (SELECT r, k, a, b, lead(a) OVER (PARTITION BY r ORDER BY k) AS next FROM span),
    kept AS (SELECT r, count(*) AS spans, sum(b - a) AS gone, min(a) AS first, string_agg(CASE WHEN next IS NULL THEN substr(h, 2 * b + 1) ELSE substr(h, 2 * b + 1, 2 * (next - b)) END, '' ORDER BY k) AS rest FROM edge JOIN d USING (r) GROUP BY r)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
           sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE substr(h, 1, 2 * first) || rest END)) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""


def op7() -> str:
    """All places at which a word of a text equals one of an item, counted along their diagonals."""
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""
    WITH dw AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT doc_id, {words} AS ws FROM documents)),
    iw AS (SELECT item_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT item_id, {words} AS ws FROM benchmark)),
    same AS (SELECT doc_id, item_id, n, d.pos - i.pos AS shift, i.pos AS pos FROM dw d JOIN iw i ON d.word = i.word),
    near AS (SELECT doc_id, item_id, n, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY pos RANGE BETWEEN {decontaminate.OVERLAP - 1} PRECEDING AND CURRENT ROW) AS agree FROM same),
    hit AS (SELECT DISTINCT doc_id, item_id FROM near WHERE agree >= CASE WHEN n < {decontaminate.SHORT} THEN n ELSE ceil(least({decontaminate.OVERLAP}, n) * {decontaminate.SHARE}) END),
    per AS (SELECT doc_id, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS item_ids FROM hit GROUP BY doc_id)
    SELECT doc_id, item_ids IS NOT NULL AS contaminated, coalesce(item_ids, '') AS item_ids FROM documents LEFT JOIN per USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_secrets": op2(), "op3_repeats": op3(), "op7_decontaminate": op7()}
