"""For every registered query the SQL that gives the same rows on the same tables."""

from __future__ import annotations

_LINES = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents)"""

_WORDS = r"""words AS (
  SELECT doc_id, term FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS term FROM documents)
  WHERE term <> '')"""

_LINE_TOKENS = _LINES + r""", toks AS (
  SELECT DISTINCT doc_id, line_no, token FROM (
    SELECT doc_id, line_no, unnest(regexp_split_to_array(line, '[ \t\n\r\f]+')) AS token FROM lines)
  WHERE token <> '')"""

_PAIRS = _LINE_TOKENS + """, marg AS (
  SELECT token AS w, count(*) AS n FROM toks GROUP BY 1),
frequent AS (SELECT * FROM marg WHERE n >= 10),
kept AS (SELECT t.* FROM toks t JOIN frequent f ON f.w = t.token),
pairs AS (
  SELECT a.token AS x, b.token AS y, count(*) AS nxy
  FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.token <> b.token
  GROUP BY 1, 2 HAVING count(*) >= 10)"""


def _pmi(total: str) -> str:
    source = "frequent" if total == "frequent" else "marg"
    return _PAIRS + f""", pmi AS (
  SELECT x, y, score, round(score, 6) AS pmi FROM (
    SELECT p.x, p.y,
           log10(p.nxy::double * (SELECT sum(n)::bigint FROM {source}) / (a.n::double * b.n)) AS score
    FROM pairs p JOIN frequent a ON a.w = p.x JOIN frequent b ON b.w = p.y))"""


_TF = r"""tf AS (
  SELECT term, doc_id, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\v\f\r]+')) AS term FROM documents)
  WHERE term <> '' GROUP BY 1, 2)"""

_EVENTS = """ev AS (
  SELECT event_id AS id, user_id::varchar AS user_name, date_trunc('second', ts) AS time,
         event_type, event_type || ' ' || props AS text
  FROM events)"""

_IN_RANGE = "time > TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-20'"
_KEYWORD = "regexp_matches(text, '(?i)(Error|PURCH)')"

_EDGES = """edges AS (
  SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem
  UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem)"""

_GRAPH = "nodes AS (SELECT o_orderkey AS id FROM orders), " + _EDGES

_PART_GRAPH = """nodes AS (SELECT p_partkey AS id FROM part),
edges AS (SELECT l_partkey AS src, l_orderkey AS dst FROM lineitem)"""


def _steps(graph: str, steps: int, mode: str = "standard", last_mass: bool = False) -> str:
    """The PageRank steps unrolled: r0, then per step q, m and r."""
    if mode == "standard":
        jump = "0.15::double + 0.85::double * (q + m)"
    else:
        jump = "0.15::double * (1 - q) + q + m"
    parts = [
        graph,
        "deg AS (SELECT src, count(*)::double AS d FROM edges GROUP BY 1)",
        "sources AS (SELECT unnest([1, 2, 3])::bigint AS source)",
        "r0 AS (SELECT id, source, CASE WHEN id = source THEN 1::double ELSE 0::double END AS p"
        " FROM nodes CROSS JOIN sources)",
    ]
    for i in range(1, steps + 1):
        parts.append(f"""q{i} AS (
  SELECT r.id, r.source, coalesce(g.q, 0::double) AS q FROM r0 r LEFT JOIN (
    SELECT e.dst AS id, r.source, sum(r.p / d.d) AS q
    FROM r{i - 1} r JOIN edges e ON e.src = r.id JOIN deg d ON d.src = r.id GROUP BY 1, 2) g
  ON g.id = r.id AND g.source = r.source)""")
        parts.append(f"m{i} AS (SELECT source, 1 - sum(q) AS m FROM q{i} GROUP BY 1)")
        if i < steps or not last_mass:
            parts.append(f"""r{i} AS (
  SELECT id, q{i}.source, CASE WHEN id = q{i}.source THEN {jump} ELSE 0.85::double * q END AS p
  FROM q{i} JOIN m{i} ON m{i}.source = q{i}.source)""")
    return "WITH " + ",\n".join(parts)


def _nine_digits(value: str) -> str:
    return f"floor({value} * 1e9::double + 0.317::double) / 1e9::double"


def _ranks(graph: str, steps: int, mode: str = "standard") -> str:
    return _steps(graph, steps, mode) + f"\nSELECT id, source, {_nine_digits('p')} AS p FROM r{steps}"


def _having(term: str) -> str:
    return f"SELECT doc_id FROM tf WHERE term = '{term}'"


_Q4 = (
    f"((({_having('to')}) UNION ({_having('and')})) UNION (({_having('in')}) INTERSECT"
    f" ({_having('a')}))) INTERSECT ({_having('the')})"
)
_BATCH = {
    "q1": f"({_having('the')}) INTERSECT ({_having('of')})",
    "q2": f"(({_having('the')}) UNION ({_having('of')})) INTERSECT ({_having('and')})",
    "q3": f"(({_having('in')}) UNION ({_having('nosuchword')})) INTERSECT ({_having('a')})",
    "q4": _Q4,
    "q5": f"({_having('nosuchword')}) INTERSECT ({_having('the')})",
}
_HITS = "hits AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS query_id, doc_id FROM ({sql})" for name, sql in _BATCH.items()
) + ")"

_TERMS = "('the', 'of', 'and', 'nosuchword')"


def _ordinals() -> str:
    """The two places among all terms and among alphabetic terms."""
    out = []
    for kind in ("all", "alphabetic"):
        only = "" if kind == "all" else " WHERE regexp_full_match(term, '[A-Za-z]+')"
        ranked = (
            "SELECT term, n, row_number() OVER (ORDER BY term) AS up,"
            " row_number() OVER (ORDER BY term DESC) AS down"
            f" FROM (SELECT term, count(*) AS n FROM words{only} GROUP BY 1)"
        )
        out.append(
            f"SELECT '{kind}' AS kind, CASE WHEN up = 1 THEN 'first' ELSE 'third to last' END AS place,"
            f" term, n FROM ({ranked}) WHERE up = 1 OR down = 3"
        )
    return f"WITH {_WORDS} " + " UNION ALL ".join(out)


def _positions(places: list[int]) -> str:
    """The terms at places from the start and, if negative, from the end, of both kinds."""
    listed = ", ".join(map(str, places))
    return f"""WITH {_WORDS}, counts AS (SELECT term, count(*) AS n FROM words GROUP BY 1),
kinds AS (
  SELECT 'all' AS kind, term, n FROM counts
  UNION ALL SELECT 'alphabetic', term, n FROM counts WHERE regexp_full_match(term, '[A-Za-z]+')),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY term) AS up,
         -row_number() OVER (PARTITION BY kind ORDER BY term DESC) AS down FROM kinds)
SELECT kind, position, term, n
FROM ranked JOIN (SELECT unnest([{listed}])::bigint AS position) ON position IN (up, down)"""


_BROKEN = _EVENTS + """, lines AS (
  SELECT *, CASE id % 11
           WHEN 0 THEN 'x' || whole WHEN 1 THEN replace(whole, '+0000', '+0000?')
           WHEN 2 THEN whole || chr(9) || 'more' ELSE whole END AS line
  FROM (SELECT *, concat_ws(chr(9), id, user_name,
          CASE WHEN event_type <> 'signup' THEN strftime(time, '%a %b %d %H:%M:%S +0000 %Y') END,
          CASE WHEN event_type NOT IN ('signup', 'error') THEN text END) AS whole FROM ev)),
judged AS (
  SELECT *, CASE WHEN len(f) < 4 THEN 'too few fields' WHEN len(f) > 4 THEN 'too many fields'
                 WHEN NOT regexp_full_match(f[1], '[0-9]+') THEN 'id is no number'
                 WHEN f[3] LIKE '%?%' THEN 'no valid time' END AS reason
  FROM (SELECT *, string_split(line, chr(9)) AS f FROM lines))"""


ORACLES: dict[str, str] = {
    "tokens_per_doc": f"""WITH {_WORDS}
SELECT d.doc_id, count(w.term) AS n_tokens
FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id GROUP BY 1""",
    "line_tokens": f"WITH {_LINE_TOKENS} SELECT doc_id, line_no, token FROM toks",
    "word_count_all": f"WITH {_WORDS} SELECT term, count(*) AS n FROM words GROUP BY 1",
    "word_count_alpha": f"""WITH {_WORDS}
SELECT term, count(*) AS n FROM words WHERE regexp_full_match(term, '[A-Za-z]+') GROUP BY 1""",
    "unique_terms": f"""WITH {_WORDS}
SELECT 'all' AS kind, count(DISTINCT term) AS n_terms, count(*) AS n_tokens FROM words
UNION ALL
SELECT 'alphabetic', count(DISTINCT term), count(*) FROM words
WHERE regexp_full_match(term, '[A-Za-z]+')""",
    "term_ordinals": _ordinals(),
    "terms_by_position": _positions([2, 100, 1000, 5000, -2, -100, -1000, -5000]),

    "token_marginals": f"WITH {_LINE_TOKENS} SELECT token AS w, count(*) AS n FROM toks GROUP BY 1",
    "cooc_pairs": f"WITH {_PAIRS} SELECT x, y, nxy FROM pairs",
    "cooc_stripes": f"""WITH {_PAIRS}
SELECT p.x, 0::bigint AS part, f.n AS nx, string_agg(p.y || ':' || p.nxy, ',' ORDER BY p.y) AS stripe
FROM pairs p JOIN frequent f ON f.w = p.x GROUP BY p.x, f.n""",
    "pmi_pairs": f"WITH {_pmi('frequent')} SELECT x, y, pmi FROM pmi",
    "pmi_stripes": f"WITH {_pmi('all')} SELECT x, y, pmi FROM pmi",
    "pmi_pair_total": f"WITH {_PAIRS} SELECT count(*) AS n_pairs FROM pairs",
    "pmi_top_pair": f"""WITH {_pmi('frequent')}
SELECT x, y, pmi FROM pmi ORDER BY score DESC, x, y LIMIT 1""",
    "pmi_top_neighbors": f"""WITH {_pmi('frequent')}, ranked AS (
  SELECT x, y, pmi, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS rank
  FROM pmi WHERE x IN ('the', 'der', 'que', 'nosuchword'))
SELECT x, y, pmi, rank FROM ranked WHERE rank <= 3""",

    "term_doc_tf": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "term_stats": f"""WITH {_TF}
SELECT term, sum(tf)::bigint AS cf, count(*) AS df FROM tf GROUP BY 1""",
    "inverted_index": f"""WITH {_TF}
SELECT term, doc_id // 65536 AS block, string_agg(doc_id || ':' || tf, ',' ORDER BY doc_id) AS postings
FROM tf GROUP BY 1, 2""",
    "index_wide_row": f"""WITH {_TF}
SELECT term, doc_id // 65536 AS block, string_agg(doc_id || ':' || tf, ',' ORDER BY doc_id) AS cells
FROM tf GROUP BY 1, 2""",
    "index_wide_row_lookup": f"WITH {_TF} SELECT term, doc_id, tf FROM tf WHERE term = 'the'",
    "keyed_table_lookup": f"""WITH {_TF}
SELECT term, doc_id, tf FROM tf WHERE term IN (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\v\\f\\r]+')) FROM benchmark)""",
    "replaced_counts": f"WITH {_WORDS} SELECT term, count(*) AS n FROM words GROUP BY 1",
    "stored_index_lookup": f"WITH {_TF} SELECT term, doc_id, tf FROM tf WHERE term IN {_TERMS}",
    "postings_gaps": f"""WITH {_TF}
SELECT term, doc_id // 65536 AS block,
       row_number() OVER (PARTITION BY term, doc_id // 65536 ORDER BY doc_id) - 1 AS at,
       doc_id - lag(doc_id, 1, 0) OVER (PARTITION BY term ORDER BY doc_id) AS gap, tf
FROM tf""",
    "postings_gaps_decoded": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "tf_histogram": f"""WITH {_TF}
SELECT term, tf, count(*) AS n_docs FROM tf WHERE term IN {_TERMS} GROUP BY 1, 2""",
    "postings_lookup": f"WITH {_TF} SELECT term, doc_id, tf FROM tf WHERE term = 'the'",
    "postings_multi_lookup": f"WITH {_TF} SELECT term, doc_id, tf FROM tf WHERE term IN {_TERMS}",
    "missing_terms": f"""WITH {_TF}
SELECT term FROM (SELECT unnest(['the', 'of', 'and', 'nosuchword']) AS term)
WHERE term NOT IN (SELECT term FROM tf)""",
    "postings_with_text": f"""WITH {_TF}
SELECT t.term, t.doc_id, t.tf, d.text
FROM tf t JOIN documents d ON d.doc_id = t.doc_id WHERE t.term = 'from'""",
    "boolean_and": f"WITH {_TF} ({_having('the')}) INTERSECT ({_having('and')})",
    "boolean_or": f"WITH {_TF} ({_having('the')}) UNION ({_having('nosuchword')})",
    "boolean_postfix": f"WITH {_TF} {_Q4}",
    "boolean_batch": f"WITH {_TF}, {_HITS} SELECT query_id, doc_id FROM hits",
    "ordinal_index": f"""WITH {_TF}, placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents)
SELECT term, ordinal // 256 AS block, string_agg(ordinal || ':' || tf, ',' ORDER BY ordinal) AS postings
FROM tf JOIN placed ON placed.doc_id = tf.doc_id GROUP BY 1, 2""",
    "boolean_fetch": f"""WITH {_TF}, {_HITS}
SELECT h.doc_id, d.text FROM hits h JOIN documents d ON d.doc_id = h.doc_id WHERE h.query_id = 'q4'""",
    "boolean_preview": f"""WITH {_TF}, {_HITS}
SELECT h.query_id, h.doc_id, substr(d.text, 1, 80) AS preview
FROM hits h JOIN documents d ON d.doc_id = h.doc_id""",

    "events_from_tsv": f"WITH {_EVENTS} SELECT id, user_name, time, text FROM ev",
    "parse_event_time": f"WITH {_EVENTS} SELECT id, time FROM ev",
    "ragged_event_lines": f"""WITH {_EVENTS}
SELECT id, user_name, time, CASE WHEN event_type <> 'error' THEN text END AS text
FROM ev WHERE event_type <> 'signup'""",
    "checked_event_lines": f"""WITH {_BROKEN}
SELECT f[1]::bigint AS id, f[2] AS user_name, time, f[4] AS text FROM judged WHERE reason IS NULL""",
    "rejected_event_lines": f"WITH {_BROKEN} SELECT line, reason FROM judged WHERE reason IS NOT NULL",
    "hourly_counts_range": f"""WITH {_EVENTS}
SELECT strftime(date_trunc('hour', time), '%m/%d %H') AS hour, count(*) AS n
FROM ev WHERE {_IN_RANGE} GROUP BY date_trunc('hour', time)""",
    "hourly_counts_keyword": f"""WITH {_EVENTS}
SELECT strftime(date_trunc('hour', time), '%m/%d %H') AS hour, count(*) AS n
FROM ev WHERE {_IN_RANGE} AND {_KEYWORD} GROUP BY date_trunc('hour', time)""",
    "hourly_counts_unpadded": f"""WITH {_EVENTS}
SELECT strftime(time, '%-m/%-d %-H') AS hour, count(*) AS n
FROM ev WHERE event_type <> 'signup' GROUP BY 1""",
    "hourly_counts_keyword_unpadded": f"""WITH {_EVENTS}
SELECT strftime(time, '%-m/%-d %-H') AS hour, count(*) AS n
FROM ev WHERE event_type NOT IN ('signup', 'error') AND {_KEYWORD} GROUP BY 1""",

    "adjacency_edges": """SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem
UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem""",
    "graph_build": _steps(_GRAPH, 0) + "\nSELECT id, source, p FROM r0",
    "graph_stats": f"""WITH {_GRAPH}
SELECT (SELECT count(*) FROM nodes) AS n_nodes, count(*) AS n_edges,
       count(DISTINCT src) AS n_active_nodes FROM edges""",
    "graph_duplicate_nodes": """SELECT o_custkey AS id, count(*) AS n FROM orders
GROUP BY 1 HAVING count(*) > 1""",
    "graph_partition": f"""WITH {_GRAPH}
SELECT src, dst, count(*) OVER (PARTITION BY src) AS degree FROM edges""",
    "ppr_mass_step": _steps(_GRAPH, 2, last_mass=True)
    + f"\nSELECT id, source, {_nine_digits('q')} AS q FROM q2",
    "ppr_missing_mass": _steps(_GRAPH, 2, last_mass=True)
    + f"\nSELECT source, {_nine_digits('m')} AS m FROM m2",
    "ppr_missing_structure": f"""WITH {_PART_GRAPH}
SELECT dst AS id, count(*) AS n_messages FROM edges
WHERE dst NOT IN (SELECT id FROM nodes) GROUP BY 1""",
    "ppr_step_stats": _steps(_PART_GRAPH, 1) + """, sent AS (
  SELECT e.dst FROM r1 r JOIN edges e ON e.src = r.id WHERE r.p > 0)
SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges,
       count(*) AS n_sent, count(*) FILTER (WHERE dst IN (SELECT id FROM nodes)) AS n_received,
       count(DISTINCT dst) FILTER (WHERE dst NOT IN (SELECT id FROM nodes)) AS n_missing
FROM sent""",
    "ppr_step_standard": _ranks(_GRAPH, 2),
    "ppr_step_compat": _ranks(_GRAPH, 2, "compat"),
    "ranks_of_stored_graph": _ranks(_GRAPH, 2),
    "ranks_of_bucketed_graph": _ranks(_GRAPH, 2),
    "ppr_statistics": _steps(_GRAPH, 2) + """, moved AS (""" + " UNION ALL ".join(
        f"SELECT {i + 1}::bigint AS step, id, source FROM r{i} WHERE p > 0" for i in range(3)) + """)
SELECT step, count(DISTINCT (m.id, m.source)) AS n_moving,
       count(*) FILTER (WHERE e.dst IN (SELECT id FROM nodes)) AS n_messages
FROM moved m JOIN edges e ON e.src = m.id GROUP BY step""",
    "ppr_resumed": _ranks(_GRAPH, 3),
    "ppr_iterate": _ranks(_GRAPH, 5),
    "ppr_iterate_compat": _ranks(_GRAPH, 5, "compat"),
    "ppr_log_rank": _steps(_GRAPH, 3) + """
SELECT id, source, CASE WHEN p = 0 THEN '-infinity'::double ELSE round(ln(p), 6) END AS log_p
FROM r3""",
    "ppr_top_k": _steps(_GRAPH, 5) + f""", ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(p, 13) DESC, id) AS rank FROM r5),
cut AS (SELECT source, rank, id, {_nine_digits('round(p, 13)')} AS p FROM ranked WHERE rank <= 10)
SELECT source, rank, id, p, round(p::decimal(12, 9), 5)::varchar AS p_text FROM cut""",
}
