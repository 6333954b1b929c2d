"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from sendero.llm.manifest import ARITY
from sendero.llm.secrets import (CANDIDATE, COPIED_OWNERS, COPIED_REPOSITORIES, DISTINCT, KINDS, LEAST, MIXED, PLACEHOLDERS,
                                 SHAPES, VALUE)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(number: int, shape: str) -> str:
    """``(doc_id, source, kind, m, pos)``: the matches of a shape, ``pos`` the code points before each."""
    return f"""SELECT doc_id, source, {number} AS kind, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS pos
        FROM (SELECT doc_id, source, unnest(ms) AS m, unnest(gaps[:len(ms)]) AS gap, unnest(range(len(ms))) AS i
              FROM (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), {_quoted(shape)}) AS ms,
                           string_split_regex(coalesce(text, ''), {_quoted(shape)}) AS gaps FROM documents))"""


def _joined(what: str, order: str = "start, kind") -> str:
    names = "[" + ", ".join(map(_quoted, [*KINDS, "found"])) + "]"
    return f"coalesce(string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY {order}) FILTER ({what}), '')"


SECRETS = f"""WITH base AS (
      SELECT *, CASE WHEN kind = 0 THEN regexp_extract(m, {_quoted(SHAPES["assign"])}, 2) ELSE m END AS v, pos AS start
      FROM ({" UNION ALL ".join(_matches(i, SHAPES[k]) for i, k in enumerate(KINDS))})),
    reported AS (SELECT doc_id, source, kind, start, start + length(m) AS stop, trim(v, '.') AS v FROM base
      WHERE length(v) >= [{", ".join(str(LEAST[k]) for k in KINDS)}][kind + 1]),
    other AS (SELECT doc_id, source, kind, pos + length(m) - length(ltrim(m, '.')) AS start, trim(m, '.') AS v
      FROM ({_matches(len(KINDS), f"{VALUE}{{{CANDIDATE},}}")})),
    every AS (SELECT * FROM reported UNION ALL
      SELECT doc_id, source, kind, start, start + length(v) AS stop, v FROM other AS o
      WHERE length(v) >= {CANDIDATE} AND regexp_matches(v, '[0-9]')
        AND NOT EXISTS (SELECT 1 FROM reported AS r WHERE r.doc_id = o.doc_id AND r.start < o.start + length(o.v) AND r.stop > o.start)),
    judged AS (SELECT *, regexp_matches(v, '[0-9]') AND regexp_matches(lower(v), '[a-z]') AND len(list_distinct(string_split(v, ''))) >= {DISTINCT}
        AND NOT regexp_matches(lower(v), '{"|".join(PLACEHOLDERS)}') AS looks,
        length(v) >= {MIXED} AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AS mixed FROM every),
    candidates AS (SELECT * FROM judged WHERE kind < {len(KINDS)} OR looks),
    owned AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT (source, doc_id)) AS repositories, bool_or(kind < {len(KINDS)}) AS known
      FROM candidates GROUP BY v),
    told AS (SELECT c.*, known, owners, CASE WHEN repositories >= {COPIED_REPOSITORIES} AND owners >= {COPIED_OWNERS} THEN 'copied'
        WHEN looks THEN 'live' ELSE 'plain' END AS state FROM candidates AS c JOIN owned USING (v)),
    kept AS (SELECT * FROM told WHERE kind < {len(KINDS)} OR (state = 'live' AND (known OR (mixed AND owners = 1))))
    SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(KINDS))},
      sha256({_joined(f"kind < {len(KINDS)}")}) AS base_sha256, {_joined("kind >= 0")} AS spans,
      {_joined("state = 'live'")} AS live, {_joined("state = 'copied'")} AS copied
    FROM documents AS d LEFT JOIN kept AS k ON k.doc_id = d.doc_id GROUP BY d.doc_id"""


def _encoded(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_encoded, ["doc_id", "source", "lang", "n_chars", text])) + ")"


#: The unsigned crc32 of a number's decimal digits.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda r, b: list_reduce(list_concat([xor(r, b)], range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

# t: nodes of the trees of sources, s: nodes of the tree of subroots; lv 0 holds the leaves, n is the level's size.
MANIFEST = f"""WITH RECURSIVE l AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
        count(*) OVER (PARTITION BY source) AS n, {_leaf("text")} AS leaf,
        CASE WHEN {CRC32} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS shown FROM documents),
    t AS (SELECT 0 AS lv, source, i, n, leaf AS h FROM l UNION ALL
        SELECT lv + 1 AS lv, source, i, n, h FROM (SELECT lv, source, i // {ARITY} AS i, (n + {ARITY - 1}) // {ARITY} AS n, sha256(string_agg(h, '' ORDER BY t.i)) AS h
          FROM t WHERE n > 1 GROUP BY lv, source, t.i // {ARITY}, n)),
    tops AS (SELECT source, lv AS depth, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j, count(*) OVER () AS n FROM t WHERE n = 1),
    s AS (SELECT 0 AS lv, j AS i, n, h FROM tops UNION ALL
        SELECT lv + 1 AS lv, i, n, h FROM (SELECT lv, i // {ARITY} AS i, (n + {ARITY - 1}) // {ARITY} AS n, sha256(string_agg(h, '' ORDER BY s.i)) AS h
          FROM s WHERE n > 1 GROUP BY lv, s.i // {ARITY}, n)),
    path AS (SELECT l.doc_id, t.lv, t.i, t.h, l.i // ({ARITY} ** t.lv)::BIGINT AS own
             FROM l JOIN tops ON tops.source IS NOT DISTINCT FROM l.source
             JOIN t ON t.source IS NOT DISTINCT FROM l.source AND t.lv < depth AND t.i // {ARITY} = l.i // ({ARITY} ** (t.lv + 1))::BIGINT
             UNION ALL SELECT l.doc_id, depth + s.lv, s.i, s.h, j // ({ARITY} ** s.lv)::BIGINT
             FROM l JOIN tops ON tops.source IS NOT DISTINCT FROM l.source
             JOIN s ON s.n > 1 AND s.i // {ARITY} = j // ({ARITY} ** (s.lv + 1))::BIGINT),
    runs AS (SELECT doc_id, lv, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS ahead,
               coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS behind FROM path GROUP BY 1, 2),
    proofs AS (SELECT doc_id, string_agg(ahead || behind, '' ORDER BY lv) AS proof FROM runs GROUP BY 1),
    f AS (SELECT doc_id, 0 AS lv, shown AS h FROM l UNION ALL
          SELECT f.doc_id, f.lv + 1, sha256(ahead || h || behind) FROM f JOIN runs ON runs.doc_id = f.doc_id AND runs.lv = f.lv),
    folded AS (SELECT doc_id, arg_max(h, lv) AS h FROM f GROUP BY 1),
    root AS (SELECT h FROM s WHERE n = 1)
    SELECT l.doc_id, leaf, tops.h AS subroot, root.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded.h AS folded_root,
      folded.h = root.h AS verified
    FROM l JOIN tops ON tops.source IS NOT DISTINCT FROM l.source JOIN folded ON folded.doc_id = l.doc_id
    LEFT JOIN proofs ON proofs.doc_id = l.doc_id, root"""
