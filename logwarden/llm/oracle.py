"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from logwarden.llm.secret_scan import KINDS, REACH, ROLE, STRONG, WEAK

WHITE_SPACE = r"[\x20\x09-\x0D]+"

OP9 = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '{WHITE_SPACE}', '', 'g') AS content
  FROM documents),
best AS (
  SELECT content, count(*) AS group_size,
         arg_min(doc_id, (-chars, doc_id)) AS keep_id
  FROM d GROUP BY content)
SELECT d.doc_id, keep_id, group_size, d.doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(content) AS text_sha256
FROM d JOIN best USING (content)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kind: str, pattern: str, group: int, least: int) -> str:
    p, rank = _quoted(pattern), KINDS.index(kind)
    gaps = f"[length(x) for x in string_split_regex(text, {p})]"
    longs = f"[length(x) for x in regexp_extract_all(text, {p}, 0)]"
    counted = f"[length(x) for x in regexp_extract_all(text, {p}, {group})]"
    return (
        f"SELECT doc_id, {rank} AS rank, (sum(gap) OVER w + sum(long) OVER w - long)::INT AS start,"
        f" (sum(gap) OVER w + sum(long) OVER w)::INT AS stop, counted >= {least} AS good FROM ("
        f"SELECT doc_id, generate_subscripts({longs}, 1) AS i, unnest({longs}) AS long, unnest({counted}) AS counted,"
        f" unnest(({gaps})[:len({longs})]) AS gap FROM docs WHERE regexp_matches(text, {p}))"
        f" WINDOW w AS (PARTITION BY doc_id ORDER BY i)")


def _op5() -> str:
    parts = "\nUNION ALL ".join(_spans(*rule) for rule in STRONG + WEAK)
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    roles = "[" + ", ".join(f"'{ROLE[k]}'" for k in KINDS) + "]"
    counts = ", ".join(f"count(*) FILTER (rank = {i}) AS n_{rule[0]}" for i, rule in enumerate(STRONG))
    near = (f"SELECT 1 FROM parts p WHERE p.doc_id = w.doc_id AND ({roles})[p.rank + 1] = '%s'"
            f" AND p.start - w.stop <= {REACH} AND w.start - p.stop <= {REACH}")
    has_id, has_secret = f"EXISTS ({near % 'identifier'})", f"EXISTS ({near % 'secret'})"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, rank, start, stop, ({kinds})[rank + 1] || ':' || start || ':' || stop AS said
          FROM ({parts}) WHERE good),
linked AS (
  SELECT * FROM parts w WHERE rank >= {len(STRONG)} AND CASE ({roles})[rank + 1]
    WHEN 'identifier' THEN {has_secret} WHEN 'secret' THEN {has_id} ELSE {has_id} AND {has_secret} END),
base AS (
  SELECT doc_id, {counts}, string_agg(said, ',' ORDER BY start, rank) AS said
  FROM parts WHERE rank < {len(STRONG)} GROUP BY doc_id),
everything AS (
  SELECT doc_id, string_agg(said, ',' ORDER BY start, rank) AS said
  FROM (SELECT * FROM parts WHERE rank < {len(STRONG)} UNION ALL SELECT * FROM linked) GROUP BY doc_id),
links AS (SELECT doc_id, count(*) AS n FROM linked GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{rule[0]}, 0) AS n_{rule[0]}" for rule in STRONG)},
       sha256(coalesce(base.said, '')) AS base_sha256, coalesce(everything.said, '') AS spans,
       coalesce(links.n, 0) AS n_linked
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN everything USING (doc_id) LEFT JOIN links USING (doc_id)"""


#: Levels that the SQL twin writes out: 16 to this power leaves a source, and sources.
MERKLE_LEVELS = 6


def _op11() -> str:
    def said(c: str) -> str:
        return (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END")

    leaf = " || ".join(said(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = ("xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform("
           "range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),"
           " lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),"
           " lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))")
    parts = [f"""
docs AS (
  SELECT doc_id, source, sha256({leaf} || {said("text")}) AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN
           sha256({leaf} || {said("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
         END AS tampered FROM documents),
l0 AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, leaf AS h,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n FROM docs)"""]

    def tower(name: str) -> None:
        for k in range(MERKLE_LEVELS):
            parts.append(f"""
{name}{k + 1} AS (
  SELECT tree, idx // 16 AS idx, any_value((n + 15) // 16) AS n, sha256(string_agg(h, '' ORDER BY idx)) AS h
  FROM {name}{k} WHERE n > 1 GROUP BY tree, idx // 16)""")
        for k in range(MERKLE_LEVELS):
            parts.append(f"""
{name}s{k} AS (
  SELECT tree, idx, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k} WHERE n > 1 WINDOW w AS (PARTITION BY tree, idx // 16 ORDER BY idx))""")

    tower("l")
    ends = " UNION ALL ".join(f"SELECT tree, h FROM l{k} WHERE n = 1" for k in range(MERKLE_LEVELS + 1))
    parts.append(f"""
ends AS ({ends}),
t0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, h FROM ends)""")
    tower("t")
    root = " UNION ALL ".join(f"SELECT h FROM t{k} WHERE n = 1" for k in range(MERKLE_LEVELS + 1))

    def ascent(before: str, name: str) -> str:
        for k in range(MERKLE_LEVELS):
            parts.append(f"""
{name}{k + 1} AS (
  SELECT d.* REPLACE (
    CASE WHEN s.n IS NULL THEN proof ELSE proof || before || after END AS proof,
    CASE WHEN s.n IS NULL THEN folded ELSE sha256(before || folded || after) END AS folded, d.idx // 16 AS idx)
  FROM {before} d LEFT JOIN {name[1]}s{k} s ON s.tree = d.tree AND s.idx = d.idx)""")
            before = f"{name}{k + 1}"
        return before

    parts.append("""
pl0 AS (SELECT doc_id, leaf, tree, idx, '' AS proof, coalesce(tampered, leaf) AS folded FROM l0)""")
    last = ascent("pl0", "pl")
    parts.append(f"""
pt0 AS (SELECT p.* REPLACE (0 AS tree, p.tree AS idx), ends.h AS subroot FROM {last} p JOIN ends ON ends.tree = p.tree)""")
    last = ascent("pt0", "pt")
    return "WITH" + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM {last}, (SELECT max(h) AS root FROM ({root}))"""


ORACLE: dict[str, str] = {"op5_secret_scan": _op5(), "op9_exact_dedup": OP9, "op11_merkle": _op11()}
