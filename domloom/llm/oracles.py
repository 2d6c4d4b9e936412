"""DuckDB SQL for the operators that SQL can express, on the same tables, by plain means."""

from __future__ import annotations

from functools import reduce

from domloom.llm.licenses import _NOTICE, KNOWN, SPELLINGS

_LOW = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    plain = f"regexp_replace(regexp_replace({_LOW.format(column)}, {_quoted(_NOTICE)}, chr(10), 'g'), '[\\x00-/:-`{{-\\x7f©®™“”‘’–—]+', ' ', 'g')"
    plain = plain.replace("{{", "{")
    spaced = f"replace(' ' || {plain} || ' ', ' ', '  ')"
    same = reduce(lambda c, v: f"replace({c}, ' {v[0].replace(' ', '  ')} ', ' {v[1].replace(' ', '  ')} ')", SPELLINGS, spaced)
    return f"trim(replace({same}, '  ', ' '), ' ')"


_VALUES = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)

_LEAF = "sha256(concat(" + ", ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in ("doc_id", "source", "lang", "n_chars", "{text}")) + "))"
# CRC-32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
          lambda c, d: list_reduce([xor(c, d)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _tree(name: str, rows: str) -> str:
    """All levels of the trees over ``rows`` (key, rank, n, digest)."""
    return f"""{name}(key, lvl, rank, n, digest) AS (SELECT key, 0, rank, n, digest FROM {rows}
          UNION ALL SELECT key, lvl + 1, rank // 8, (max(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank)) FROM {name} WHERE n > 1 GROUP BY key, lvl, rank // 8)"""


def _path(rows: str, tree: str) -> str:
    """The digests left and right of each row's node on every level."""
    return f"""SELECT p.key, p.rank, l.lvl, coalesce(string_agg(l.digest, '' ORDER BY l.rank) FILTER (l.rank < p.rank >> (3 * l.lvl)), '') AS a,
            coalesce(string_agg(l.digest, '' ORDER BY l.rank) FILTER (l.rank > p.rank >> (3 * l.lvl)), '') AS b
          FROM {rows} p JOIN {tree} l ON l.key = p.key AND l.n > 1 AND l.rank // 8 = p.rank >> (3 * l.lvl + 3) GROUP BY ALL"""


ORACLES = {
    "op1_repeated_passages": """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        starts AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM h)),
        first AS (SELECT s, min(doc_id) AS m FROM starts GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM starts JOIN first USING (s) WHERE doc_id > m),
        spans AS (SELECT doc_id, count(*) AS n, count(*) FILTER (before IS NULL OR before < j - 1) AS k
          FROM (SELECT doc_id, j, lag(j) OVER (PARTITION BY doc_id ORDER BY j) AS before FROM gone) GROUP BY doc_id),
        bytes AS (SELECT doc_id, j, substr(x, 2 * j + 1, 2) AS b FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2)) AS j FROM h)),
        kept AS (SELECT doc_id, string_agg(b, '' ORDER BY j) AS k FROM bytes ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
        SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(spans.n, 0)::BIGINT AS n_removed, coalesce(spans.k, 0)::BIGINT AS n_spans,
          sha256(unhex(coalesce(kept.k, ''))) AS kept_sha256
        FROM h LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op4_license_scan": f"""WITH ours AS (SELECT doc_id, sha256({_canonical('text')}) AS digest FROM documents),
        known AS (SELECT digest, min(license) AS license FROM (SELECT license, sha256({_canonical('text')}) AS digest FROM (VALUES {_VALUES}) t(license, text)) GROUP BY digest)
        SELECT doc_id, digest, license FROM ours LEFT JOIN known USING (digest)""",
    "op12_merkle_manifest": f"""WITH RECURSIVE leaves AS (
          SELECT doc_id, coalesce('=' || lang, '-') AS key, {_LEAF.format(text='text')} AS digest,
            CASE WHEN {_CRC} % 3 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM documents),
        placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank, count(*) OVER (PARTITION BY key) AS n FROM leaves),
        {_tree('levels', 'placed')},
        subroots AS (SELECT '' AS key, key AS of, digest, row_number() OVER (ORDER BY key) - 1 AS rank, count(*) OVER () AS n FROM levels WHERE n = 1),
        {_tree('upper', 'subroots')},
        steps AS ({_path('placed', 'levels')} UNION ALL
          SELECT p.key, p.rank, 1000 + u.lvl, u.a, u.b FROM placed p JOIN subroots s ON s.of = p.key JOIN ({_path('subroots', 'upper')}) u ON u.rank = s.rank),
        paths AS (SELECT key, rank, string_agg(a || b, '' ORDER BY lvl) AS proof, list(a || '|' || b ORDER BY lvl) AS steps FROM steps GROUP BY ALL),
        folded AS (SELECT p.doc_id, p.digest AS leaf, s.digest AS subroot, (SELECT digest FROM upper WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
            list_reduce([coalesce(p.other, p.digest)] || coalesce(steps, []), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
          FROM placed p JOIN subroots s ON s.of = p.key LEFT JOIN paths t ON t.key = p.key AND t.rank = p.rank)
        SELECT *, folded_root = root AS verified FROM folded""",
    "op10_minhash_components": f"""WITH RECURSIVE w AS (
          SELECT doc_id, list_filter(regexp_split_to_array({_LOW.format('text')}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
        reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.doc_id),
        comps AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id, c = doc_id AS kept FROM comps LEFT JOIN n USING (doc_id)""",
}
