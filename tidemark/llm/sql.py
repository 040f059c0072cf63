"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import string

from tidemark.llm import rules, sharding, urls

WORDS = r"'[^\x20\x09-\x0D]+'"


def lowered(text: str) -> str:
    return f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def url_filter(rule_list: tuple[urls.Rule, ...], order: int = urls.ORDER) -> str:
    ranked = sorted(rule_list, key=lambda r: (-len(r.text), r.text))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ranked]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, ranked, strict=True))
    ruled = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, ranked, strict=True))
    sizes = range(1, order + 2)
    figures = ("allow", "block", "allow_n", "allow_kinds", "block_n", "block_kinds", "all_kinds")
    by_size = ", ".join(f"coalesce(max({c}) FILTER (size = {k}), 0) AS {c}_{k}" for k in sizes for c in figures)

    def smoothed(kind: str) -> str:
        p = f"(({kind}_1 + 1)::DOUBLE / ({kind}_n_1 + all_kinds_1 + 1))"
        steps = [f"p_1 AS (SELECT *, {p} AS p FROM by_size)"]
        for k in sizes[1:]:
            n, types = f"{kind}_n_{k}", f"{kind}_kinds_{k}"
            steps.append(f"p_{k} AS (SELECT * EXCLUDE p, CASE WHEN {n} > 0 THEN ({kind}_{k} + {types} * p) / ({n} + {types}) ELSE p END AS p FROM p_{k - 1})")
        return f"(WITH {', '.join(steps)} SELECT run, p AS {kind} FROM p_{order + 1})"

    kinds = ", ".join(f"coalesce(sum(n) FILTER (ruled = '{k}'), 0) AS {k}" for k in urls.KINDS)
    totals = ", ".join(f"sum({k}) AS {k}_n, count(*) FILTER ({k} > 0) AS {k}_kinds" for k in urls.KINDS)
    return f"""
    WITH rest AS (
        SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, coalesce({lowered("url")}, '') AS text, {lowered("regexp_extract(rest, '^[^/?#]*')")} AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
    ), judged AS (SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM parts),
    urls AS MATERIALIZED (
        SELECT *, row_number() OVER () AS id, substr(md5(text), 1, 1) IN ({', '.join(f"'{c}'" for c in urls.HELD_BACK)}) AS held
        FROM (SELECT text, ruled, count(*) AS n FROM judged WHERE text <> '' GROUP BY 1, 2)
    ), runs AS MATERIALIZED (
        SELECT id, ruled, held, n, unnest(list_transform(range(1, length(text) + 1), lambda i: substr(repeat(chr({ord(urls.START)}), {order}) || text, i, {order + 1}))) AS run FROM urls
    ), longest AS (SELECT run, {kinds} FROM runs WHERE ruled IS NOT NULL AND NOT held GROUP BY 1),
    ends AS MATERIALIZED (SELECT substr(run, {order + 2} - size) AS part, sum(allow) AS allow, sum(block) AS block FROM longest, range(1, {order + 2}) s(size) GROUP BY 1),
    contexts AS MATERIALIZED (SELECT substr(part, 1, length(part) - 1) AS context, {totals}, count(*) AS all_kinds FROM ends GROUP BY 1),
    asked AS (SELECT run, size, substr(run, {order + 2} - size) AS part FROM (SELECT DISTINCT run FROM runs WHERE ruled IS NULL OR held), range(1, {order + 2}) s(size)),
    joined AS (SELECT run, size, allow, block, c.* FROM asked LEFT JOIN ends USING (part) LEFT JOIN contexts c ON context = substr(part, 1, size - 1)),
    by_size AS MATERIALIZED (SELECT run, {by_size} FROM joined GROUP BY 1),
    deltas AS (
        SELECT run, CAST(round_even((ln(allow) - ln(block)) * {urls.UNIT}, 0) AS INT) AS d
        FROM {smoothed("allow")} JOIN {smoothed("block")} USING (run)
    ), scored AS (
        SELECT text, ruled, n, CAST(floor(least(greatest(total::DOUBLE / {urls.UNIT} / length(text), -{urls.LIMIT}), {urls.LIMIT}) * {urls.STEPS}) AS INT) AS step
        FROM urls JOIN (SELECT id, sum(d) AS total FROM runs JOIN deltas USING (run) GROUP BY 1) USING (id) WHERE ruled IS NULL OR held
    ), steps AS (
        SELECT step, {kinds} FROM scored WHERE ruled IS NOT NULL GROUP BY 1
    ), errors AS (
        SELECT CAST(ceil((step + coalesce(lag(step) OVER (ORDER BY step), step)) / 2) AS INT) AS cut,
               round(coalesce(sum(allow) OVER w, 0) / nullif(sum(allow) OVER (), 0) + 1 - coalesce(sum(block) OVER w, 0) / nullif(sum(block) OVER (), 0), 9) AS error
        FROM steps WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), least AS (SELECT cut AS least FROM errors WHERE error IS NOT NULL ORDER BY error, cut LIMIT 1)
    SELECT page_id, host, path, rule,
           coalesce(j.ruled, CASE WHEN coalesce(step, 0) < (SELECT least FROM least) THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged j LEFT JOIN (SELECT text, step FROM scored WHERE ruled IS NULL) s USING (text)
    """


def near_duplicates(width: int, percent: int) -> str:
    return f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, {WORDS}) AS ws FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(ws[i : i + {width - 1}], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {width - 2}, least(len(ws), 1) + 1))) AS i FROM words)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)
    ), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT doc_id AS node, doc_id AS other FROM documents
        UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
    ), least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least ON least.node = d.doc_id
    """


def warc() -> str:
    alphabet = string.ascii_uppercase + "234567"
    # Five hexadecimal digits are 20 bits, four base32 digits.
    group = "CAST('0x' || substr(digest, 5 * g + 1, 5) AS BIGINT)"
    digits = " || ".join(f"substr('{alphabet}', CAST(({group} >> {s}) & 31 AS INT) + 1, 1)" for s in (15, 10, 5, 0))
    return f"""
    WITH rows AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
    largest AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS original FROM rows)
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string(list_transform(range(8), lambda g: {digits}), '') AS payload_digest,
           CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> original THEN original END AS refers_to
    FROM largest
    """


def quality_rules() -> str:
    fails = " + ".join(f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(rules.RULES))
    gone = " OR ".join(f"({r.fails})" for r in rules.RULES if r.name in rules.STANDARD.rules)
    base = " OR ".join(f"({r.fails})" for r in rules.RULES if r.name in rules.BASE.rules)
    return rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)
    ), repeats AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY 1
    ), measures AS (
        SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
               CASE WHEN len(ws) = 0 THEN 0 ELSE length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) END AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
               len(list_distinct(ws)) AS n_distinct_words, length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks,
               coalesce(list_max(list_transform(ws, lambda w: strlen(w))), 0) AS longest_word
        FROM texts LEFT JOIN repeats USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed, NOT ({gone}) AS kept,
           CAST({fails} AS BIGINT) AS failed
    FROM measures
    """


def shards(names: tuple[str, ...]) -> str:
    table = sharding.lookup_table(names)
    slot = f"CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) % {sharding.SLOTS} AS INT)"
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""
    WITH placed AS (SELECT doc_id, {slot} AS slot FROM documents)
    SELECT doc_id, slot, ([{listed}])[{table}[slot + 1] + 1] AS shard FROM placed
    """


def vector_codes(parts: int, entries: int, rounds: int) -> str:
    """For vectors of one length."""

    def nearest(book: str) -> str:
        distance = "list_sum(list_transform(range(len(part)), lambda i: (part[i + 1] - entry[i + 1]) * (part[i + 1] - entry[i + 1])))"
        best = f"min(CAST({distance} AS BIGINT) * {entries} + e)"
        return f"SELECT nr, p, part, {best} AS best FROM parts JOIN {book} USING (p) GROUP BY ALL"

    steps = []
    for k in range(rounds):
        steps.append(f"near_{k} AS ({nearest(f'book_{k}')})")
        steps.append(f"""means_{k} AS (
        SELECT p, e, list(mean ORDER BY i) AS mean FROM (
            SELECT p, best % {entries} AS e, i, CAST(floor(sum(part[i]) / count(*)) AS BIGINT) AS mean
            FROM (SELECT p, best, part, unnest(range(1, len(part) + 1)) AS i FROM near_{k}) GROUP BY 1, 2, 3
        ) GROUP BY ALL
    )""")
        steps.append(f"book_{k + 1} AS (SELECT p, e, coalesce(mean, entry) AS entry FROM book_{k} LEFT JOIN means_{k} USING (p, e))")
    return f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS nr, vec_id, label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS (
        SELECT nr, p, ints[p * len(ints) // {parts} + 1 : (p + 1) * len(ints) // {parts}] AS part FROM kept, range({parts}) AS r(p)
    ), book_0 AS (SELECT p, nr AS e, part AS entry FROM parts WHERE nr < {entries}),
    {", ".join(steps)},
    last AS ({nearest(f"book_{rounds}")}),
    coded AS (
        SELECT nr, string_agg(lower(format('{{:02x}}', best % {entries})), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
        FROM last GROUP BY 1
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM book_{rounds}) AS codebooks_sha256
    FROM coded JOIN kept USING (nr)
    """
