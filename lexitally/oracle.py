"""The same queries in SQL for DuckDB, over views named like the tables.

RE2 has no Unicode `\\s`, so the 29 whitespace code points are written out.
"""

from __future__ import annotations

# Unicode whitespace as Python's str.split() sees it.
_SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
_CR, _LF, _TAB = "chr(13)", "chr(10)", "chr(9)"


def _tokens(source: str, keep: str = "") -> str:
    return (f"SELECT * FROM (SELECT {keep} unnest(regexp_split_to_array(text, '{_SPACE}')) AS word "
            f"FROM {source}) WHERE word <> ''")


def _words(source: str = "documents") -> str:
    return f"SELECT word, count(*) AS n FROM ({_tokens(source)}) GROUP BY word"


_CODE_POINTS = (f"SELECT doc_id, c FROM (SELECT doc_id, unnest(string_split(text, '')) AS c "
                f"FROM documents) WHERE c NOT IN ('', {_CR}, {_LF})")
_KEY = "printf('U+%04X', unicode(c))"


def _lf(text: str) -> str:
    return f"replace(replace({text}, {_CR} || {_LF}, {_LF}), {_CR}, {_LF})"


def _extremes(counts: str) -> str:
    return (f"(SELECT 'MIN' AS which, word, n FROM ({counts}) ORDER BY n, word LIMIT 1) UNION ALL "
            f"(SELECT 'MAX' AS which, word, n FROM ({counts}) ORDER BY n DESC, word LIMIT 1)")


def _manifest(text: str = "text") -> str:
    return (f"SELECT 'doc' || doc_id || '.txt' AS name, strlen({text})::BIGINT AS bytes, "
            f"sha256({text}) AS sha256 FROM documents")


def _normal(text: str) -> str:
    bare = f"regexp_replace({text}, '^\\x{{FEFF}}', '')"
    return f"regexp_replace({_lf(bare)}, '([^\\n])\\z|\\A\\z', '\\1\n')"


def _fingerprint(files: str) -> str:
    return (f"SELECT coalesce(sum(bytes), 0)::BIGINT AS total_bytes, count(*) AS n_files, "
            f"substr(min(sha256), 1, 16) AS least_hash FROM ({files})")


def _digest(counts: str) -> str:
    row = ("sha256(strlen(word)::VARCHAR || ':' || word || ',' || "
           "strlen(n::VARCHAR)::VARCHAR || ':' || n::VARCHAR)")
    sums = ", ".join(
        f"coalesce(sum((('0x' || substr(h, {15 * i + 1}, 15))::BIGINT >> {20 * j}) & 1048575), 0)"
        for i in range(4) for j in range(3))
    return (f"SELECT n_rows, sha256(n_rows || ',' || array_to_string(w, ',')) AS digest FROM ("
            f"SELECT count(*) AS n_rows, [{sums}] AS w FROM (SELECT {row} AS h FROM ({counts})))")


def _tree(counts: str, digits: int) -> str:
    """Digests of the rows below each prefix of their word's hash."""
    row = ("sha256(strlen(word)::VARCHAR || ':' || word || ',' || "
           "strlen(n::VARCHAR)::VARCHAR || ':' || n::VARCHAR)")
    key = "sha256(strlen(word)::VARCHAR || ':' || word)"
    sums = ", ".join(
        f"sum((('0x' || substr(h, {15 * i + 1}, 15))::BIGINT >> {20 * j}) & 1048575)"
        for i in range(4) for j in range(3))
    return (f"SELECT prefix, depth, n_rows, sha256(n_rows || ',' || array_to_string(w, ',')) AS digest FROM ("
            f"SELECT substr(k, 1, depth) AS prefix, depth::INTEGER AS depth, count(*) AS n_rows, [{sums}] AS w FROM ("
            f"SELECT {key} AS k, {row} AS h, unnest(range({digits + 1})) AS depth FROM ({counts})) GROUP BY ALL)")


_NEARLY = f"""SELECT word, CASE WHEN word LIKE 'Z%' AND n = 1 THEN 2 ELSE n END AS n
  FROM ({_words()}) WHERE NOT (word LIKE 'Z%' AND n = 2)"""

_FILES = """SELECT doc_id // 1000 AS bucket, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes,
  sha256(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY ALL"""

_RUNS = """SELECT CASE WHEN user_id % 2 = 0 THEN 'hadoop' ELSE 'spark' END AS framework,
  CASE WHEN user_id % 3 = 0 THEN 1 ELSE 2 END AS nodes, event_type AS job,
  event_id AS repetition, value AS seconds, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS exit_code,
  event_type <> 'error' AS verified FROM events"""

_SUMMARY = f"""SELECT framework, nodes, job, count(seconds) AS runs, round(median(seconds), 6) AS median,
  round(min(seconds), 6) AS min, round(max(seconds), 6) AS max
  FROM ({_RUNS}) WHERE verified AND exit_code = 0 GROUP BY ALL"""


def _pair(over: str, base: str, other: str, rest: str, result: str) -> str:
    return (f"SELECT {rest}, b.median AS base, o.median AS other, {result} "
            f"FROM (SELECT * FROM ({_SUMMARY}) WHERE {over} = {base}) b "
            f"JOIN (SELECT * FROM ({_SUMMARY}) WHERE {over} = {other}) o USING ({rest})")


_LABELLED = ("SELECT 'doc' || doc_id || CASE WHEN toxic = 1 THEN '.bak' ELSE '.txt' END AS name "
             "FROM labels")
_HOST = "regexp_extract(url, '^https?://([^/]+)/', 1)"
_NO_FINAL = "CASE WHEN a[-1] = '' THEN a[:-2] ELSE a END"
_PARTS = " UNION ALL ".join(_words(t) for t in ("documents", "benchmark", "conversations"))
_BENCH = "SELECT item_id, strlen(text)::BIGINT AS bytes, sha256(text) AS sha256 FROM benchmark"

SQL: dict[str, str] = {
    "lines": f"""SELECT doc_id, (unnest(range(1, len(a) + 1)) - 1)::INTEGER AS line_no, unnest(a) AS line
        FROM (SELECT doc_id, {_NO_FINAL} AS a
              FROM (SELECT doc_id, string_split({_lf('text')}, {_LF}) AS a FROM documents))""",
    "tokens": _tokens("documents", "doc_id,"),
    "chars": f"SELECT doc_id, {_KEY} AS ch, count(*) AS n FROM ({_CODE_POINTS}) GROUP BY doc_id, c",
    "chars_arrow": f"SELECT doc_id, {_KEY} AS ch, count(*) AS n FROM ({_CODE_POINTS}) GROUP BY doc_id, c",
    "word_count": _words(),
    "char_count": f"SELECT {_KEY} AS ch, count(*) AS n FROM ({_CODE_POINTS}) GROUP BY c",
    "char_count_arrow": f"SELECT {_KEY} AS ch, count(*) AS n FROM ({_CODE_POINTS}) GROUP BY c",
    "minmax": _extremes(_words()),
    "merge_counts": f"SELECT word, sum(n)::BIGINT AS n FROM ({_PARTS}) GROUP BY word",
    "merge_extremes": _extremes(_words()),
    "scaled_counts": f"SELECT word, n * 14 AS n FROM ({_words('benchmark')})",
    "strip_eol": f"SELECT doc_id, rtrim(text || {_CR} || {_LF}, {_CR} || {_LF}) AS text FROM documents",
    "normalize_text": f"""SELECT doc_id, {_normal('raw')} AS text FROM (SELECT doc_id, chr(65279) ||
        replace(text, {_LF}, CASE WHEN doc_id % 2 = 0 THEN {_CR} || {_LF} ELSE {_CR} END) AS raw
        FROM documents)""",
    "valid_documents": """SELECT doc_id, strlen(text)::BIGINT AS bytes FROM documents
        WHERE contains(upper(text), 'LICENSE') AND strlen(text) >= 1000""",
    "format_counts": f"SELECT word || {_TAB} || n AS value FROM ({_words()})",
    "parse_counts": f"""SELECT word AS key, CASE WHEN n % 5 IN (3, 4) THEN n END AS n,
        CASE WHEN n % 5 < 2 THEN 'arity' WHEN n % 5 = 2 THEN 'integer' END AS problem
        FROM ({_words()})""",
    "write_counts": f"SELECT word || {_TAB} || n AS value FROM ({_words()})",
    "read_counts": _words(),
    "manifest": _manifest(),
    "corpus_totals": f"""SELECT count(*) AS n_files, coalesce(sum(bytes), 0)::BIGINT AS total_bytes
        FROM ({_manifest()})""",
    "fingerprint": _fingerprint(_manifest()),
    "fingerprint_diff": f"""SELECT l.total_bytes = r.total_bytes AND l.n_files = r.n_files
          AND l.least_hash = r.least_hash AS equal,
        l.total_bytes AS left_total_bytes, l.n_files AS left_n_files, l.least_hash AS left_least_hash,
        r.total_bytes AS right_total_bytes, r.n_files AS right_n_files, r.least_hash AS right_least_hash
        FROM ({_fingerprint(_manifest())}) l, ({_fingerprint(_manifest(_normal('text')))}) r""",
    "replicate": f"""WITH b AS ({_BENCH}),
          k AS (SELECT ((1048576 + sum(bytes) - 1) // sum(bytes))::BIGINT AS copies FROM b)
        SELECT printf('doc%d-copy%03d.txt', item_id, copy) AS name, copy, item_id, bytes, sha256
        FROM b, (SELECT unnest(range(copies)) AS copy FROM k)""",
    "shards": """SELECT doc_id, bytes, idx, (idx % 2)::INTEGER AS shard FROM (
        SELECT doc_id, strlen(text)::BIGINT AS bytes, row_number() OVER (ORDER BY doc_id) - 1 AS idx
        FROM documents)""",
    "listing_diff": f"""WITH l AS ({_LABELLED}), d AS ({_manifest()})
        SELECT 'unlisted' AS kind, name FROM d WHERE name NOT IN (SELECT name FROM l)
        UNION SELECT 'undeclared', name FROM l WHERE name NOT IN (SELECT name FROM d)""",
    "missing_files": f"""SELECT DISTINCT name FROM ({_LABELLED})
        WHERE name NOT IN (SELECT name FROM ({_manifest()}))""",
    "content_diff": f"""SELECT name, a.bytes AS actual_bytes, a.sha256 AS actual_sha256,
          e.bytes AS expected_bytes, e.sha256 AS expected_sha256
        FROM ({_manifest()}) a JOIN ({_manifest("replace(text, 'License', 'Licence')")}) e USING (name)
        WHERE a.bytes <> e.bytes OR a.sha256 <> e.sha256""",
    "duplicate_keys": f"""SELECT sha256, count(*) AS n FROM ({_manifest()})
        GROUP BY sha256 HAVING count(*) > 1""",
    "verify_counts": f"""WITH a AS MATERIALIZED ({_words()}), s AS (
          SELECT word, n AS actual_n, NULL::BIGINT AS expected_n FROM a UNION ALL
          SELECT CASE WHEN n = 7 THEN 'x-' || word ELSE word END, NULL, CASE WHEN n = 5 THEN n + 1 ELSE n END
          FROM a WHERE n <> 3)
        SELECT CASE WHEN max(expected_n) IS NULL THEN 'extra' WHEN max(actual_n) IS NULL THEN 'missing'
          ELSE 'wrong' END AS kind, word, max(actual_n) AS actual_n, max(expected_n) AS expected_n
        FROM s GROUP BY word HAVING max(actual_n) IS DISTINCT FROM max(expected_n)""",
    "verify_summary": f"""SELECT true AS verified, n_rows AS n_actual, n_rows AS n_expected,
        0::BIGINT AS n_violations, digest FROM ({_digest(_words())})""",
    "canonical_digest": _digest(_words()),
    "timing_summary": _SUMMARY,
    "error_bars": f"""SELECT framework, nodes, job, median, round(median - min, 6) AS below,
        round(max - median, 6) AS above FROM ({_SUMMARY})""",
    "unverified_runs": f"SELECT * FROM ({_RUNS}) WHERE NOT (verified AND exit_code = 0)",
    "speedup": _pair("nodes", "1", "2", "framework, job",
                     "round(b.median / o.median, 6) AS speedup"),
    "step_cost": _pair("job", "'view'", "'purchase'", "framework, nodes",
                       "round(o.median - b.median, 6) AS cost"),
    "scaling_fit": f"""SELECT framework, nodes, regr_count(y, x)::BIGINT AS runs,
          round(regr_intercept(y, x), 6) AS fixed, round(1.0 / regr_slope(y, x), 6) AS throughput
        FROM (SELECT framework, nodes, repetition::DOUBLE AS x,
                5 + repetition * 0.01::DOUBLE + seconds / 100 AS y
              FROM ({_RUNS}) WHERE verified AND exit_code = 0) GROUP BY framework, nodes""",
    "completeness": """WITH d AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL),
          g AS (SELECT lang, 'src' || i AS source FROM (SELECT unnest(['de', 'en', 'es', 'it']) AS lang),
                (SELECT unnest(range(20)) AS i))
        SELECT coalesce(d.lang, g.lang) AS lang, coalesce(d.source, g.source) AS source,
          coalesce(n, 0)::BIGINT AS n, g.lang IS NOT NULL AS expected
        FROM d FULL JOIN g ON d.lang = g.lang AND d.source = g.source
        WHERE coalesce(n, 0) <> 12 OR g.lang IS NULL""",
    "run_ids": """SELECT event_id,
        strftime(ts, '%Y%m%dT%H%M%SZ') || '-' || event_type || '-' || user_id || 'n' AS run_id FROM events""",
    "task_participation": """SELECT 'app-' || user_id AS log,
          'node' || json_extract_string(props, '$.k') AS host, count(*) AS tasks
        FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL""",
    "job_ids": rf"""SELECT DISTINCT {_HOST} AS log,
        unnest(regexp_extract_all(url, '\b[a-z]+/\d+\b')) AS id FROM pages""",
    "attempt_hosts": f"""SELECT regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS log, {_HOST} AS host,
          sum(CASE WHEN starts_with(url, 'https') THEN 2 ELSE 1 END)::BIGINT AS tasks
        FROM pages GROUP BY ALL""",
    "log_context": """SELECT 'run-' || event_id AS log,
        json_extract_string(props, '$.k')::INTEGER AS k FROM events""",
    "live_hosts": """SELECT count(DISTINCT user_id) AS hosts, 150::BIGINT AS expected,
        count(DISTINCT user_id) = 150 AS complete FROM events WHERE event_type = 'click'""",
    "expected_answers_arrow": _words(),
    "file_listing_arrow": f"SELECT bucket, bytes FROM ({_FILES})",
    "file_hashes_arrow": _FILES,
    "file_pieces_arrow": _FILES,
    "digest_tree": _tree(_words(), 2),
    "digest_tree_diff": f"""SELECT coalesce(a.prefix, b.prefix) AS prefix, coalesce(a.depth, b.depth) AS depth,
          coalesce(a.n_rows, 0) AS left_rows, coalesce(b.n_rows, 0) AS right_rows
        FROM ({_tree(_words(), 3)}) a FULL JOIN ({_tree(_NEARLY, 3)}) b ON a.prefix = b.prefix
        WHERE a.digest IS DISTINCT FROM b.digest""",
    "branch_violations": f"""SELECT CASE WHEN n = 2 THEN 'extra' ELSE 'wrong' END AS kind, word, n AS actual_n,
          CASE WHEN n = 1 THEN 2::BIGINT END AS expected_n FROM ({_words()}) WHERE word LIKE 'Z%' AND n <= 2""",
    "timing_rejects": f"""WITH r AS (SELECT *, repetition % 10 AS k, repetition // 1000 AS bucket FROM ({_RUNS})),
          l AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY repetition) + 1 AS line,
            concat_ws(',', framework, nodes, job, repetition) AS head,
            concat_ws(',', CASE WHEN k = 1 THEN 'oops' ELSE repetition::VARCHAR END, exit_code,
              CASE WHEN k = 2 THEN 'maybe' ELSE verified::VARCHAR END, '', '') AS rest FROM r)
        SELECT bucket, line, CASE k WHEN 1 THEN 'seconds' WHEN 2 THEN 'verified' ELSE 'fields' END AS problem,
          CASE k WHEN 3 THEN head WHEN 4 THEN head || ',' || rest || ',more' ELSE head || ',' || rest END AS value
        FROM l WHERE k BETWEEN 1 AND 4""",
    "event_rejects": """WITH l AS (SELECT event_id, event_id // 1000 AS bucket,
            row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS line,
            '{"Event":"SparkListenerTaskEnd","Stage ID":' || event_id || '}' AS e FROM events)
        SELECT bucket, line, 'event' AS problem, CASE WHEN event_id % 3 = 0 THEN e[:-2] ELSE e || ' ' || e END AS value
        FROM l WHERE event_id % 3 = 0 OR event_id % 5 = 0""",
    "timings_appended": f"SELECT * REPLACE (repetition::INTEGER AS repetition) FROM ({_RUNS})",
}
