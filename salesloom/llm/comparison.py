"""SQL that must give the same rows as the queries of this subpackage, where SQL can say it."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, source AS host, coalesce(text, '') AS text, {_WORDS} AS words
    FROM documents
),
windows AS (
    SELECT row_id, pos, array_to_string(list_slice(words, pos, pos + 7), ' ') AS eight
    FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS pos FROM docs WHERE len(words) >= 8)
),
repeated AS (
    SELECT row_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY row_id, eight) AS n FROM windows) WHERE n > 1
),
covered AS (
    SELECT row_id, count(DISTINCT pos + step) AS n_repeat_words
    FROM repeated, (SELECT unnest(range(0, 8)) AS step)
    GROUP BY row_id
),
worded AS (
    SELECT row_id, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM docs
),
counts AS (
    SELECT d.row_id, doc_id, host,
        len(words) AS n_words,
        coalesce(list_sum([length(w) for w in words]), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM docs d JOIN worded USING (row_id) LEFT JOIN covered USING (row_id)
),
ruled AS (
    SELECT *,
        n_words < 20 AS short,
        100 * n_repeat_words > 30 * n_words AS repeats,
        100 * n_symbols > 10 * n_words AS symbols,
        100 * n_dup_lines > 30 * n_lines AS dup_lines
    FROM counts
),
failures AS (
    SELECT host, rule, count(*) AS n, count(*) FILTER (failed) AS f
    FROM (UNPIVOT ruled ON short, repeats, symbols, dup_lines INTO NAME rule VALUE failed)
    WHERE host IS NOT NULL
    GROUP BY host, rule
),
spread AS (
    SELECT rule, avg(f / n) AS mean, coalesce(var_samp(f / n), 0) AS var FROM failures GROUP BY rule
),
priors AS (
    SELECT rule, mean, CASE WHEN var > 0 THEN greatest(mean * (1 - mean) / var - 1, 1) ELSE 1 END AS strength
    FROM spread
),
hosts AS (
    SELECT host, max((f + mean * strength) / (n + strength)) > 0.5 AS failing
    FROM failures JOIN priors USING (rule)
    GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    short OR repeats AS base_failed,
    NOT (short OR repeats) AND NOT (coalesce(failing, false) AND (symbols OR dup_lines)) AS kept,
    coalesce(failing, false) AS host_failed
FROM ruled LEFT JOIN hosts USING (host)
"""

MINHASH = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + 4), ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other
),
components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, docs.doc_id = component_id AS kept
FROM docs JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# Two hexadecimal digits are a byte; a place is the number of bytes before it.
SUBSTRINGS = r"""
WITH docs AS (
    SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS coded FROM documents
),
starts AS (
    SELECT doc_id, pos, hash(substr(coded, 2 * pos + 1, 100)) AS fifty
    FROM (SELECT doc_id, coded, unnest(range(0, length(coded) // 2 - 49)) AS pos FROM docs WHERE length(coded) >= 100)
),
found AS (
    SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY fifty) AS first_doc FROM starts)
    WHERE first_doc < doc_id
),
opened AS (
    SELECT *, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, true) AS opens FROM found
),
numbered AS (
    SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM opened
),
spans AS (
    SELECT doc_id, span, min(pos) AS low, max(pos) + 50 AS high FROM numbered GROUP BY doc_id, span
),
pieces AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before FROM spans
),
cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed,
        string_agg(substr(coded, 2 * before + 1, 2 * (low - before)), '' ORDER BY low)
            || substr(any_value(coded), 2 * max(high) + 1) AS rest
    FROM pieces JOIN docs USING (doc_id)
    GROUP BY doc_id
)
SELECT doc_id, length(coded) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, coded))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""


def _merkle(depth: int = 10, fanout: int = 8) -> str:
    """Trees of up to ``fanout ** depth`` leaves, a level at a time; those of one node already are carried on."""
    byte = "list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, "
        f"[ascii(d)::UBIGINT FOR d IN string_split(doc_id::VARCHAR, '')]), lambda x, y: {byte}))"
    )

    def framed(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(framed(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""leaves AS MATERIALIZED (
    SELECT doc_id, lang, leaf, now, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
    FROM (SELECT doc_id, lang, {leaf('text')} AS leaf,
        {leaf(f"CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END")} AS now FROM documents)
)""",
        "n0 AS MATERIALIZED (SELECT coalesce('=' || lang, '') AS grp, rank AS pos, leaf AS digest FROM leaves)",
    ]

    def rise(start: str, prefix: str, levels: int) -> None:
        for level in range(levels):
            this, up = start if level == 0 else f"{prefix}{level}", f"{prefix}{level + 1}"
            parts.append(
                f"""{up} AS MATERIALIZED (
    SELECT grp, pos // {fanout} AS pos,
        CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
    FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {this}) GROUP BY grp, pos // {fanout}
)"""
            )
            parts.append(
                f"""{up}_runs AS MATERIALIZED (
    SELECT x.grp, x.pos,
        coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS lefts,
        coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS rights,
        any_value(x.n) = 1 AS done
    FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {this}) x
    JOIN {this} y ON x.grp = y.grp AND x.pos // {fanout} = y.pos // {fanout}
    GROUP BY x.grp, x.pos
)"""
            )

    rise("n0", "n", depth)
    parts.append(
        f"m0 AS MATERIALIZED (SELECT 'all' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, grp AS lang, digest FROM n{depth})"
    )
    rise("m0", "m", depth)
    parts.append(
        f"""f0 AS (SELECT doc_id, leaf, coalesce('=' || lang, '') AS grp, rank AS pos, now AS folded, '' AS proof FROM leaves)"""
    )

    def fold(prefix: str, step: int, level: int, group: str, keep: str) -> None:
        parts.append(
            f"""f{step} AS MATERIALIZED (
    SELECT doc_id, leaf, {keep} f.{group}, f.pos // {fanout} AS pos,
        CASE WHEN done THEN folded ELSE sha256(lefts || folded || rights) END AS folded,
        proof || lefts || rights AS proof
    FROM f{step - 1} f JOIN {prefix}{level}_runs r ON f.{group} = r.grp AND f.pos = r.pos
)"""
        )

    for level in range(1, depth + 1):
        fold("n", level, level, "grp", "")
    parts.append(
        f"""f{depth + 1} AS (
    SELECT doc_id, leaf, m0.digest AS subroot, m0.grp AS grp, m0.pos AS pos, folded, proof
    FROM f{depth} f JOIN m0 ON f.grp = m0.lang
)"""
    )
    for level in range(1, depth + 1):
        fold("m", depth + 1 + level, level, "grp", "subroot,")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT doc_id, leaf, subroot, m{depth}.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
    folded = m{depth}.digest AS verified
FROM f{2 * depth + 1} f JOIN m{depth} ON f.grp = m{depth}.grp
"""
    )


MERKLE = _merkle()
