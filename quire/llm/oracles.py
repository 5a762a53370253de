"""SQL of the manifest and of the trie."""

from __future__ import annotations


def crc32_of(text: str) -> str:
    """crc32 of a text of ASCII characters, bit by bit."""
    step = "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: "
            f"list_reduce(list_prepend(xor(a, b), range(8)), {step})), 4294967295::BIGINT)")


def merkle_sql(levels: int = 5, source_levels: int = 4) -> str:
    """Trees of up to 16 ** levels leaves."""
    def leaf(text: str) -> str:
        one = [f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
               for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(one)})"

    def up(name: str, keys: str, n: int) -> list[str]:
        out = []
        for k in range(n):
            out.append(f"{name}{k + 1} AS (SELECT {keys}i // 16 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) "
                       f"ELSE min(h) END AS h, (max(n) + 15) // 16 AS n FROM {name}{k} GROUP BY {keys}i // 16)")
            run = f"OVER (PARTITION BY {keys}i // 16 ORDER BY i ROWS BETWEEN"
            out.append(f"{name}s{k} AS (SELECT {keys}i, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                       f"coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})")
        return out

    folded = "given"
    for side, n in (("t", levels), ("f", source_levels)):
        for k in range(n):
            folded = f"CASE WHEN {side}s{k}.n > 1 THEN sha256({side}s{k}.l || ({folded}) || {side}s{k}.r) ELSE ({folded}) END"
    proof = " || ".join(f"{side}s{k}.l || {side}s{k}.r" for side, n in (("t", levels), ("f", source_levels)) for k in range(n))
    joins = "".join(f" JOIN ts{k} ON ts{k}.s = t0.s AND ts{k}.i = t0.i // {16 ** k}" for k in range(levels))
    joins += f" JOIN t{levels} ON t{levels}.s = t0.s JOIN f0 ON f0.s = t0.s"
    joins += "".join(f" JOIN fs{k} ON fs{k}.i = f0.i // {16 ** k}" for k in range(source_levels))
    touched = f"doc_id IS NOT NULL AND {crc32_of('coalesce(doc_id, 0)::VARCHAR')} % 5 = 0"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return "WITH " + ", ".join([
        f"d AS (SELECT doc_id, coalesce('+' || source, '') AS s, {leaf('text')} AS h, {leaf('given')} AS given "
        f"FROM (SELECT *, CASE WHEN {touched} THEN {lower} ELSE text END AS given FROM documents))",
        "t0 AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS i, "
        "count(*) OVER (PARTITION BY s) AS n FROM d)", *up("t", "s, ", levels),
        f"f0 AS (SELECT s, h, row_number() OVER (ORDER BY s) - 1 AS i, count(*) OVER () AS n FROM t{levels})",
        *up("f", "", source_levels),
        f"all_rows AS (SELECT t0.doc_id, t0.h AS leaf, t{levels}.h AS subroot, f{source_levels}.h AS root, "
        f"sha256({proof}) AS proof_sha256, {folded} AS folded_root FROM t0{joins} CROSS JOIN f{source_levels})",
    ]) + " SELECT *, folded_root = root AS verified FROM all_rows"


def trie_sql() -> str:
    digest = "sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""
WITH t AS (SELECT conv_id, turn, {digest} AS h, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, h) AS own FROM t GROUP BY 1),
h AS (SELECT *, conv_id - conv_id % 5 AS base, {crc32_of('conv_id::VARCHAR')} % 9 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(c.own[1:h.h], h.own[h.h + 1:]) AS s FROM h LEFT JOIN c ON c.conv_id = h.base),
p AS (SELECT conv_id, len(s) AS n, d, sha256(to_json(s[1:d])::VARCHAR) AS k,
             CASE WHEN d > 0 THEN sha256(to_json(s[1:d - 1])::VARCHAR) END AS pk,
             CASE WHEN d > 0 THEN octet_length(encode(s[d].t)) ELSE 0 END AS b
      FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
nodes AS (SELECT d, k, min(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, min(b) AS b,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256
          FROM p GROUP BY d, k),
kids AS (SELECT pk AS k, count(*) AS n_children FROM nodes GROUP BY pk),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
totals AS (SELECT p.k, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * f.b)::BIGINT AS saved_tokens
           FROM full_nodes f JOIN p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.k)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, totals.n_leaves,
       totals.saved_tokens, f.ends_sha256
FROM full_nodes f JOIN totals ON totals.k = f.k LEFT JOIN nodes up ON up.k = f.pk"""
