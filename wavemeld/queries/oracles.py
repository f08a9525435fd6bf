"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from wavemeld.queries.maps import CODES, LABELLED, WAVES, WORDS
from wavemeld.queries.registry import NEW_STAMP, OLD_STAMP
from wavemeld.spec import EMPTY_KEYWORDS, KEYWORD_PREFIX, KEYWORD_SUFFIX, MIN_KEYWORD

ORACLES: dict[str, str] = {}


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def snake(expr: str) -> str:
    return f"regexp_replace(regexp_replace(lower({expr}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def number(expr: str) -> str:
    """A text as a number, as the double cast reads it."""
    return (f"CASE WHEN regexp_full_match({expr}, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*') "
            f"THEN TRY_CAST(trim({expr}) AS DOUBLE) END")


def whole(expr: str) -> str:
    """A number truncated to an integer, NULL outside the integer range."""
    return f"CASE WHEN {expr} > -2147483648 AND {expr} < 2147483648 THEN CAST(trunc({expr}) AS INTEGER) END"


def shortest(expr: str) -> str:
    """The text form of a number: integral values without a fraction."""
    return f"CASE WHEN {expr} = trunc({expr}) THEN CAST(CAST({expr} AS BIGINT) AS VARCHAR) ELSE CAST({expr} AS VARCHAR) END"


def recoded(expr: str, var: str) -> str:
    cases = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in WAVES[var].recodes)
    return f"CASE {expr} {cases} ELSE {expr} END"


# -- matching of document words ---------------------------------------------------------

WORD_ROWS = f"""words AS MATERIALIZED (
  SELECT dataset, ordinal, {snake('word')} AS raw_name FROM (
    SELECT CAST(doc_id AS VARCHAR) AS dataset, CAST(generate_subscripts(w, 1) - 1 AS BIGINT) AS ordinal, unnest(w) AS word
    FROM (SELECT doc_id, string_split_regex(text, '[ \\t\\n\\r]+') AS w FROM documents))
  WHERE {snake('word')} <> '')"""

COLUMNS = WORD_ROWS + """,
cols AS MATERIALIZED (SELECT dataset, raw_name, min(ordinal) AS ordinal FROM words GROUP BY dataset, raw_name),
names AS MATERIALIZED (SELECT DISTINCT raw_name FROM cols)"""

ALIASES = "aliases(ord, alias, canonical) AS (VALUES " + ", ".join(
    f"({i}, {text(a)}, {text(c)})" for i, a, c in WORDS.aliases) + ")"

FUZZY = """subs AS MATERIALIZED (
  SELECT DISTINCT a.ord, a.canonical, substr(lower(a.alias), CAST(p.i AS INTEGER), CAST(q.l AS INTEGER)) AS s
  FROM aliases a, range(1, 40) p(i), range(0, 40) q(l)
  WHERE p.i <= length(a.alias) + 1 AND q.l <= length(a.alias) - p.i + 1),
fuzzy AS MATERIALIZED (
  SELECT n.raw_name, arg_min(s.canonical, s.ord) AS canonical FROM names n JOIN subs s
    ON abs(length(s.s) - length(n.raw_name)) <= (15 * length(n.raw_name) + 99) // 100
   AND levenshtein(n.raw_name, s.s) <= (15 * length(n.raw_name) + 99) // 100
  GROUP BY n.raw_name)"""


def _plain_pattern(pattern: str) -> str:
    body = pattern.removeprefix(KEYWORD_PREFIX).removesuffix(KEYWORD_SUFFIX)
    return f"(^|[^a-z0-9])({body})([^a-z0-9]|$)"


PATTERNS = "patterns(ord, canonical, pattern) AS (VALUES " + ", ".join(
    f"({i}, {text(c)}, {text(_plain_pattern(p))})" for i, (c, p) in enumerate(WORDS.patterns)) + ")"
KEYWORD_HITS = """hits AS MATERIALIZED (
  SELECT n.raw_name, p.ord, p.canonical FROM names n JOIN patterns p ON regexp_matches(n.raw_name, p.pattern))"""
KEYWORDS = "keywords(canonical, ord, keyword) AS (VALUES " + ", ".join(
    f"({text(v.name)}, {i}, {text(k)})" for v in WORDS.variables for i, k in enumerate(v.plain_keywords)) + ")"
FIRED = """fired AS MATERIALIZED (
  SELECT h.raw_name, h.canonical, coalesce(
    (SELECT k.keyword FROM keywords k WHERE k.canonical = h.canonical AND contains(lower(h.raw_name), lower(k.keyword))
     ORDER BY length(k.keyword) DESC, k.ord LIMIT 1), '(pattern)') AS keyword FROM hits h)"""


def _first(source: str) -> str:
    """The earliest column of a dataset gets a canonical."""
    return (f"SELECT dataset, ordinal, raw_name, canonical FROM ({source}) "
            "QUALIFY row_number() OVER (PARTITION BY dataset, canonical ORDER BY ordinal) = 1")


def match_ctes(layers: tuple[str, ...]) -> str:
    """Winners of the layers, each layer in its own way.

    The keyword layer runs a round per canonical: the first column that still
    has a free candidate takes it.
    """
    parts, won = [COLUMNS, ALIASES], []
    if "exact" in layers:
        parts.append("exact_won AS MATERIALIZED (" + _first(
            "SELECT c.*, a.canonical FROM cols c JOIN aliases a ON c.raw_name = a.alias") + ")")
        won.append("SELECT *, 'exact' AS layer FROM exact_won")
    if "fuzzy" in layers:
        left = "SELECT c.*, f.canonical FROM cols c JOIN fuzzy f USING (raw_name)"
        if won:
            left += """ WHERE NOT EXISTS (FROM exact_won e WHERE e.dataset = c.dataset AND e.ordinal = c.ordinal)
              AND NOT EXISTS (FROM exact_won e WHERE e.dataset = c.dataset AND e.canonical = f.canonical)"""
        parts += [FUZZY, f"fuzzy_won AS MATERIALIZED ({_first(left)})"]
        won.append("SELECT *, 'fuzzy' AS layer FROM fuzzy_won")
    if "keyword" in layers:
        parts += [PATTERNS, KEYWORD_HITS, KEYWORDS, FIRED]
        before = " UNION ALL ".join(won) or "SELECT *, NULL AS canonical, NULL AS layer FROM cols WHERE false"
        before = f"SELECT dataset, ordinal, raw_name, canonical, layer FROM ({before})"
        parts.append(f"won_0 AS MATERIALIZED ({before})")
        for i in range(len(WORDS.patterns)):
            parts.append(f"""won_{i + 1} AS MATERIALIZED (
  SELECT * FROM won_{i} UNION ALL
  SELECT dataset, ordinal, raw_name, canonical, 'keyword' FROM (
    SELECT c.dataset, c.ordinal, c.raw_name, h.canonical, h.ord FROM cols c JOIN hits h USING (raw_name)
    WHERE NOT EXISTS (FROM won_{i} w WHERE w.dataset = c.dataset AND w.ordinal = c.ordinal)
      AND NOT EXISTS (FROM won_{i} w WHERE w.dataset = c.dataset AND w.canonical = h.canonical))
  QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY ordinal, ord) = 1)""")
        parts.append(f"won AS (FROM won_{len(WORDS.patterns)})")
        keyword = "(SELECT f.keyword FROM fired f WHERE f.raw_name = won.raw_name AND f.canonical = won.canonical)"
    else:
        parts.append("won AS (SELECT * FROM (" + " UNION ALL ".join(won) + "))")
        keyword = "''"
    parts.append(f"""log AS MATERIALIZED (
  SELECT dataset, ordinal, raw_name, canonical,
         CASE layer WHEN 'keyword' THEN 'keyword [' || {keyword} || ']' ELSE layer END AS method,
         CASE layer WHEN 'exact' THEN 'high' WHEN 'fuzzy' THEN 'medium' ELSE 'low' END AS confidence,
         layer <> 'exact' AS needs_review FROM won)""")
    parts.append("""unmatched AS MATERIALIZED (
  SELECT dataset, ordinal, raw_name FROM cols c
  WHERE NOT EXISTS (FROM won w WHERE w.dataset = c.dataset AND w.ordinal = c.ordinal))""")
    return "WITH " + ",\n".join(parts)


ALL = match_ctes(("exact", "fuzzy", "keyword"))
ACTION = """CASE WHEN method = 'exact' THEN 'Renamed to canonical' WHEN method = 'fuzzy' THEN 'Renamed — verify spelling'
  WHEN method LIKE 'keyword%' THEN 'Predicted — must verify' WHEN method = 'unmatched'
  THEN 'DROPPED — not in canonical set' ELSE 'Unknown' END"""
BADGE = """CASE WHEN method = 'exact' THEN 'Exact' WHEN method = 'fuzzy' THEN 'Fuzzy'
  WHEN method LIKE 'keyword%' THEN 'Predicted' WHEN method = 'unmatched' THEN 'Unmatched' ELSE 'Unknown' END"""
YEAR = "CAST(2000 + length(d.lang) + d.n_chars % 7 AS INTEGER)"
WITH_UNMATCHED = """(FROM log UNION ALL
  SELECT dataset, ordinal, raw_name, NULL, 'unmatched', 'none', true FROM unmatched)"""


def audit_rows(stamp: str, source: str = WITH_UNMATCHED, where: str = "") -> str:
    return f"""SELECT l.dataset, {YEAR} AS year, l.raw_name, l.canonical, l.method, l.confidence, l.needs_review,
  {ACTION} AS action, '{stamp}' AS logged_at, l.ordinal
  FROM {source} l LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = l.dataset {where}"""


AUDIT = ALL + f",\naudit AS MATERIALIZED ({audit_rows(NEW_STAMP)})\n"

ORACLES["match_exact"] = match_ctes(("exact",)) + "\nFROM log"
ORACLES["match_fuzzy"] = f"WITH {COLUMNS},\n{ALIASES},\n{FUZZY}\nSELECT raw_name, canonical AS fuzzy FROM fuzzy"
ORACLES["match_keyword"] = match_ctes(("keyword",)) + "\nFROM log"
ORACLES["match_claim"] = match_ctes(("exact", "fuzzy")) + "\nFROM log"
ORACLES["keyword_attribution"] = (f"WITH {COLUMNS},\n{PATTERNS},\n{KEYWORD_HITS},\n{KEYWORDS},\n{FIRED}\n"
                                  "SELECT raw_name, canonical, keyword FROM fired")
ORACLES["match_columns"] = ALL + "\nFROM log"
ORACLES["match_compile"] = ALL + "\nSELECT dataset, raw_name, canonical FROM log WHERE raw_name <> canonical"
ORACLES["match_unmatched"] = ALL + "\nFROM unmatched"
TIERS = """tiers AS (
  SELECT dataset, ordinal, CASE WHEN method LIKE 'keyword%' THEN 'keyword' ELSE method END AS tier,
         raw_name || ' -> ' || canonical || CASE WHEN method LIKE 'keyword%' THEN ' matched by ' || method ELSE '' END AS entry
  FROM log UNION ALL SELECT dataset, ordinal, 'unmatched', raw_name FROM unmatched)"""
ORACLES["match_report"] = ALL + f""",\n{TIERS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY dataset, tier ORDER BY ordinal) AS nth,
                    count(*) OVER (PARTITION BY dataset, tier) AS n FROM tiers)
SELECT dataset, tier, n, CASE WHEN tier = 'unmatched' THEN (nth - 1) // 5 + 1 ELSE nth END AS line,
       string_agg(entry, ', ' ORDER BY nth) AS text FROM numbered GROUP BY 1, 2, 3, 4"""
ORACLES["match_report_lines"] = ALL + f""",\n{TIERS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY dataset, tier ORDER BY ordinal) AS nth FROM tiers)
SELECT dataset, tier, CASE WHEN tier = 'unmatched' THEN (nth - 1) // 5 + 1 ELSE nth END AS line,
       string_agg(entry, ', ' ORDER BY nth) AS text FROM numbered GROUP BY 1, 2, 3"""
ORACLES["normalise_names"] = f"""SELECT id, name, {snake('name')} AS normalised FROM (
  SELECT 'page ' || page_id AS id, url AS name FROM pages
  UNION ALL SELECT 'part ' || p_partkey, p_brand || ' / ' || p_name FROM part)"""
ORACLES["unique_column_names"] = f"""WITH {WORD_ROWS},
nth AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY dataset, raw_name ORDER BY ordinal) - 1 AS j FROM words),
taken AS MATERIALIZED (
  SELECT dataset, base AS raw_name, k - row_number() OVER (PARTITION BY dataset, base ORDER BY k) AS free_before FROM (
    SELECT DISTINCT dataset, regexp_extract(raw_name, '^(.*)_([1-9][0-9]{{0,8}})$', 1) AS base,
           TRY_CAST(regexp_extract(raw_name, '^(.*)_([1-9][0-9]{{0,8}})$', 2) AS BIGINT) AS k
    FROM nth WHERE j = 0) WHERE k IS NOT NULL)
SELECT n.dataset, n.ordinal, CASE WHEN j = 0 THEN n.raw_name ELSE n.raw_name || '_' || (j + count(t.free_before)) END AS raw_name
FROM nth n LEFT JOIN taken t ON t.dataset = n.dataset AND t.raw_name = n.raw_name AND t.free_before < n.j
GROUP BY n.dataset, n.ordinal, n.raw_name, n.j"""

# -- audit and report ---------------------------------------------------------------------

ORACLES["audit_unmatched_rows"] = ALL + f"\nSELECT * FROM {WITH_UNMATCHED}"
ORACLES["audit_annotate"] = ALL + "\n" + audit_rows(NEW_STAMP, "log")
ORACLES["audit_sort"] = AUDIT + """SELECT dataset, raw_name, confidence, needs_review FROM audit
ORDER BY needs_review DESC, list_position(['none', 'low', 'medium', 'high'], confidence), dataset, ordinal"""
ORACLES["audit_log"] = AUDIT + "FROM audit"
ORACLES["audit_upsert"] = ALL + f"""
SELECT * EXCLUDE (ordinal) FROM (
  {audit_rows(OLD_STAMP, where="WHERE d.lang <> 'en'")}
  UNION ALL {audit_rows(NEW_STAMP, where="WHERE d.lang = 'en'")})"""
ORACLES["audit_master_files"] = AUDIT + f"""
SELECT d.lang AS dataset, a.year, a.dataset || '/' || a.raw_name AS raw_name, a.canonical, a.method, a.confidence,
       a.needs_review, a.action, CASE WHEN d.lang = 'en' THEN '{NEW_STAMP}' ELSE '{OLD_STAMP}' END AS logged_at
FROM audit a JOIN documents d ON CAST(d.doc_id AS VARCHAR) = a.dataset"""
ORACLES["audit_by_method"] = AUDIT + "SELECT method, count(*) AS n FROM audit GROUP BY method ORDER BY n DESC, method"
ORACLES["audit_review_counts"] = AUDIT + """SELECT dataset, year, count(*) AS n FROM audit WHERE needs_review
GROUP BY dataset, year ORDER BY year, dataset"""
ORACLES["audit_review_total"] = AUDIT + "SELECT count(*) FILTER (needs_review) AS n_review FROM audit"
ORACLES["audit_predicted"] = AUDIT + """SELECT dataset, year, raw_name, canonical, method FROM audit
WHERE method LIKE 'keyword%'"""
ORACLES["report_badges"] = AUDIT + f"SELECT dataset, raw_name, method, {BADGE} AS badge FROM audit"
ORACLES["report_kpis"] = AUDIT + f"""SELECT count(*) AS n_total, count(*) FILTER (b = 'Exact') AS n_exact,
  count(*) FILTER (b = 'Fuzzy') AS n_fuzzy, count(*) FILTER (b = 'Predicted') AS n_predicted,
  count(*) FILTER (b = 'Unmatched') AS n_unmatched, count(*) FILTER (needs_review) AS n_review,
  count(DISTINCT dataset) AS n_datasets FROM (SELECT *, {BADGE} AS b FROM audit)"""
ORACLES["report_method_counts"] = AUDIT + f"SELECT {BADGE} AS badge, count(*) AS n FROM audit GROUP BY 1"
ORACLES["report_per_dataset"] = AUDIT + f"""SELECT dataset, year, count(*) AS total, count(*) FILTER (b = 'Exact') AS exact,
  count(*) FILTER (b = 'Fuzzy') AS fuzzy, count(*) FILTER (b = 'Predicted') AS predicted,
  count(*) FILTER (b = 'Unmatched') AS unmatched, count(*) FILTER (needs_review) AS needs_review
FROM (SELECT *, {BADGE} AS b FROM audit) GROUP BY dataset, year ORDER BY year, dataset"""
ORACLES["report_review_checklist"] = AUDIT + f"""SELECT dataset, year, raw_name, canonical, method, {BADGE} AS badge, action
FROM audit WHERE needs_review"""
ORACLES["report_full_log"] = AUDIT + f"""SELECT dataset, year, raw_name, canonical, method, confidence, needs_review,
  {BADGE} AS badge, action, logged_at FROM audit"""
ORACLES["report_unmatched"] = AUDIT + "SELECT dataset, year, raw_name FROM audit WHERE method = 'unmatched'"

# -- sources ------------------------------------------------------------------------------

ORACLES["scan_csv"] = "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem"
ORACLES["scan_tsv"] = "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders"
ORACLES["scan_orc"] = "SELECT * FROM events"
ORACLES["scan_csv_text"] = "SELECT * FROM documents"
ORACLES["manifest_separators"] = """SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate),
  o_orderpriority || '; ' || o_custkey || ', or | ' || o_orderkey AS note, o_orderstatus || '.csv' AS dataset FROM orders"""
RAGGED_ROWS = """r AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'even.csv' ELSE 'odd.csv' END AS dataset,
    CASE WHEN o_orderkey % 5 = 0 THEN 'extra_cells' WHEN o_orderkey % 7 = 0 THEN 'missing_cells' END AS kind,
    o_orderstatus AS status, o_orderpriority AS priority FROM orders)"""
ORACLES["malformed_rows"] = f"""WITH {RAGGED_ROWS}
SELECT dataset, kind, CASE kind WHEN 'extra_cells' THEN 4 ELSE 2 END::INTEGER AS cells, 3::INTEGER AS columns,
  CAST(o_orderkey AS VARCHAR) AS first_cell, CASE kind WHEN 'extra_cells'
    THEN o_orderkey || ',' || status || ',' || priority || ',' || o_orderkey ELSE o_orderkey || ',' || status END AS record
FROM r WHERE kind IS NOT NULL"""
ORACLES["malformed_issues"] = f"""WITH {RAGGED_ROWS}
SELECT dataset, '(file)' AS variable, kind AS issue_type, count(*) || CASE kind
    WHEN 'extra_cells' THEN ' row(s) with more cells than the header; the extra cells are kept in malformed_rows only.'
    ELSE ' row(s) with fewer cells than the header; the missing ones are read as NA.' END AS detail,
  count(*) AS n_bad, '' AS bad_values FROM r WHERE kind IS NOT NULL GROUP BY dataset, kind"""
ORACLES["ragged_merged"] = f"""WITH {RAGGED_ROWS}
SELECT DISTINCT CASE dataset WHEN 'even.csv' THEN 2020 ELSE 2021 END::INTEGER AS year, CAST(o_orderkey AS INTEGER) AS key,
  status, CASE WHEN kind IS DISTINCT FROM 'missing_cells' THEN priority END AS priority, dataset FROM r"""
ORACLES["manifest_scan"] = """SELECT 'wave=' || year(o_orderdate) || '.csv' AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year,
  * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders"""

# -- variable map -------------------------------------------------------------------------

DEFINITIONS = """definitions AS (
  SELECT CAST(p_partkey AS INTEGER) AS ord, 'var_' || p_partkey AS canonical,
    [p_name, p_type || ' ' || p_size, p_brand || '-' || p_type] AS aliases,
    ['NA', ' ' || p_type, p_type, CAST(p_size AS VARCHAR), 'c++ (' || p_size, p_brand] AS keywords,
    CASE WHEN p_size > 20 THEN 'integer' END AS type, p_name AS label, CAST(p_size AS VARCHAR) AS size,
    p_brand, p_type, p_name, p_size FROM part)"""
ORACLES["spec_alias_table"] = f"""WITH {DEFINITIONS},
forms AS (SELECT ord, canonical, 0 AS form, generate_subscripts(aliases, 1) AS pos, unnest(aliases) AS alias FROM definitions),
both_forms AS (FROM forms UNION ALL SELECT ord, canonical, 1, pos, {snake('alias')} FROM forms)
SELECT alias, arg_min(canonical, ord) AS canonical FROM both_forms GROUP BY alias"""
ORACLES["spec_type_table"] = f"WITH {DEFINITIONS} SELECT canonical, coalesce(type, 'character') AS type FROM definitions"
ORACLES["spec_label_table"] = f"WITH {DEFINITIONS} SELECT canonical, label FROM definitions"
VALUES = f"""value_rows AS (
  SELECT canonical, 0 AS ord, size AS code, p_size <= 25 AS whole, p_type AS label FROM definitions UNION ALL
  SELECT canonical, 1, CASE WHEN p_size > 25 THEN p_brand ELSE '77' END, p_size <= 25, p_name FROM definitions)"""
ORACLES["spec_value_table"] = f"""WITH {DEFINITIONS}, {VALUES}
SELECT canonical, ord, code, CASE WHEN whole THEN 'integer' ELSE 'character' END AS code_type, label FROM value_rows"""
ORACLES["spec_recode_table"] = f"""WITH {DEFINITIONS}
SELECT canonical, p_brand AS raw_value, CAST(p_size AS INTEGER) AS new_value FROM definitions
UNION ALL SELECT canonical, p_type, NULL FROM definitions"""
ORACLES["spec_missing_table"] = f"""WITH {DEFINITIONS}
SELECT canonical, CAST(p_size AS INTEGER) AS code FROM definitions UNION SELECT canonical, 99 FROM definitions"""
ORACLES["spec_keyword_pattern"] = f"""WITH {DEFINITIONS},
cleaned AS (SELECT canonical, list_transform(list_filter(list_transform(keywords, lambda k: lower(trim(k))),
    lambda k: k NOT IN ({', '.join(map(text, EMPTY_KEYWORDS))}) AND length(k) >= {MIN_KEYWORD}),
    lambda k: regexp_replace(k, '([.^$*+?()\\[{{\\\\|])', '\\\\\\1', 'g')) AS w FROM definitions),
one AS (SELECT canonical, list_filter(w, lambda k, i: list_position(w, k) = i) AS w FROM cleaned)
SELECT canonical, '{KEYWORD_PREFIX}' || array_to_string(w, '|') || '{KEYWORD_SUFFIX}' AS pattern FROM one WHERE len(w) > 0"""

# -- cells --------------------------------------------------------------------------------

ORACLES["rename_columns"] = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus AS status, l_shipdate FROM lineitem"""
ORACLES["select_canonical"] = "SELECT l_linenumber AS line, l_quantity AS quantity, l_linestatus AS status FROM lineitem"
ORACLES["recode_values"] = f"""SELECT o_orderkey, {recoded('o_orderstatus', 'status')} AS status,
  {recoded('o_orderpriority', 'priority')} AS priority, NULL AS quantity FROM orders
UNION ALL SELECT l_orderkey, NULL, NULL, CASE WHEN l_quantity = 18 THEN 99 ELSE l_quantity END FROM lineitem"""
ORACLES["recode_join"] = f"SELECT o_orderkey, {recoded('o_orderpriority', 'priority')} AS priority FROM orders"
ORACLES["missing_codes"] = """SELECT l_orderkey, l_partkey, nullif(l_linenumber, 7) AS line, nullif(l_quantity, 7) AS quantity
FROM lineitem"""
RAW_NUMBERS = """raw AS (SELECT event_id, value, CASE event_type
  WHEN 'click' THEN CAST(value AS VARCHAR) WHEN 'view' THEN ' ' || value || ' ' WHEN 'signup' THEN value || 'd'
  WHEN 'error' THEN value || 'e2' ELSE '-' || value END AS text FROM events)"""
ORACLES["coerce_integer"] = f"""WITH {RAW_NUMBERS}, parsed AS (SELECT event_id, value, {number('text')} AS t FROM raw)
SELECT event_id, {whole('value')} AS from_double, {whole('t')} AS from_text,
  CASE WHEN event_id * 1000000 < 2147483648 THEN CAST(event_id * 1000000 AS INTEGER) END AS from_long FROM parsed"""
ORACLES["coerce_double"] = f"""WITH {RAW_NUMBERS}
SELECT event_id, {number('text')} AS from_text, CAST(event_id AS DOUBLE) AS from_long FROM raw"""
ORACLES["coerce_string"] = f"""SELECT l_orderkey, l_linenumber, {shortest('l_quantity')} AS quantity,
  {shortest('l_discount')} AS discount, CASE WHEN l_discount > 0.05::DOUBLE THEN 'TRUE' ELSE 'FALSE' END AS discounted,
  CAST(l_partkey AS VARCHAR) AS part FROM lineitem"""
ORACLES["coerce_logical"] = """SELECT doc_id, toxic <> 0 AS from_int, CASE WHEN doc_id % 2 = 0 THEN quality = 1
  WHEN quality = 1 THEN NULL ELSE false END AS from_text FROM labels"""

# The waves under canonical names, recoded.
ORDERS = f"""o AS (SELECT {recoded('o_orderstatus', 'status')} AS status, o_totalprice AS amount,
  {recoded('o_orderpriority', 'priority')} AS priority FROM orders)"""
ITEMS = f"""i AS (SELECT l_linenumber AS line, CASE WHEN l_quantity = 18 THEN 99 ELSE l_quantity END AS quantity,
  l_extendedprice AS amount, l_discount AS discount, {recoded('l_linestatus', 'status')} AS status,
  l_shipdate AS shipped FROM lineitem)"""
PRIORITY_LOSS = """SELECT 'priority' AS variable, count(*) AS n_bad, count(DISTINCT priority) AS n_distinct,
  string_agg(DISTINCT priority, '|' ORDER BY priority) AS bad_values FROM o WHERE try_cast(priority AS INTEGER) IS NULL"""
ORACLES["coercion_profile"] = f"WITH {ORDERS} {PRIORITY_LOSS}"
ORACLES["coercion_counts"] = f"""WITH lines AS (
  SELECT lang, unnest(string_split_regex(text, '[ \\t\\n\\r]+')) AS line FROM documents),
lost AS (SELECT lang, line FROM (SELECT lang, line, {number('line')} AS d FROM lines)
         WHERE d IS NULL OR d <= -2147483648 OR d >= 2147483648)
SELECT lang, 'line' AS variable, count(*) AS n_bad, count(DISTINCT line) AS n_distinct,
  CASE WHEN count(DISTINCT line) > 5 THEN 6 ELSE count(DISTINCT line) END AS n_shown FROM lost GROUP BY lang"""
ORACLES["safe_coerce"] = f"""WITH {ORDERS}, {ITEMS}
SELECT CAST(status AS INTEGER) AS status, amount, priority, NULL AS line, NULL AS quantity, NULL AS discount,
  NULL AS shipped FROM o
UNION ALL SELECT CAST(status AS INTEGER), amount, NULL, line, CAST(trunc(quantity) AS INTEGER), discount <> 0, shipped FROM i"""
SKIP = """SELECT 'shipped' AS variable, 'coercion_skip' AS issue_type,
  'Unknown target type ''datestamp''; column left as-is.' AS detail, 0 AS n_bad, '' AS bad_values"""
# Cells of line items that the cast to the map's type would lose.
ITEM_LOSS = """SELECT variable, 'coercion_failure' AS issue_type, 'Target: ' || target || '. ' || count(*) || ' value(s) -> NA: '
    || array_to_string(list_sort(list(DISTINCT value))[:5], ', ') || CASE WHEN count(DISTINCT value) > 5 THEN ', ...' ELSE '' END
    || '. Column kept as ' || kept || '.' AS detail, count(*) AS n_bad,
    array_to_string(list_sort(list(DISTINCT value))[:5], '|') || CASE WHEN count(DISTINCT value) > 5 THEN '|...' ELSE '' END
      AS bad_values
  FROM (SELECT 'status' AS variable, 'integer' AS target, 'character' AS kept, status AS value FROM i
          WHERE status IS NOT NULL AND try_cast(status AS INTEGER) IS NULL
        UNION ALL SELECT 'line', 'integer', 'integer', CAST(line AS VARCHAR) FROM i
          WHERE line IS NOT NULL AND try_cast(line AS INTEGER) IS NULL
        UNION ALL SELECT 'quantity', 'integer', 'numeric', CAST(quantity AS VARCHAR) FROM i
          WHERE quantity IS NOT NULL AND try_cast(trunc(quantity) AS INTEGER) IS NULL)
  GROUP BY variable, target, kept"""
ORACLES["coercion_issues"] = f"WITH {ITEMS} {ITEM_LOSS} UNION ALL ({SKIP} FROM lineitem LIMIT 1)"
UNDECLARED = """undeclared AS (
  SELECT 'orders' AS wave, 'status' AS variable, CAST(status AS INTEGER) AS value FROM o WHERE status NOT IN ('1', '2')
  UNION ALL SELECT 'orders', 'priority', try_cast(priority AS INTEGER) FROM o
    WHERE try_cast(priority AS INTEGER) NOT IN (1, 2, 3, 5)
  UNION ALL SELECT 'lineitem', 'status', CAST(status AS INTEGER) FROM i WHERE status NOT IN ('1', '2')
  UNION ALL SELECT 'lineitem', 'line', line FROM i WHERE line NOT IN (1, 2, 3, 4, 5))"""
ORACLES["value_conformance"] = f"""WITH {ORDERS}, {ITEMS}, {UNDECLARED}
SELECT wave, variable, CAST(value AS VARCHAR) AS value, count(*) AS n FROM undeclared GROUP BY ALL"""


def value_issues(wave: str) -> str:
    valid = " ".join(f"WHEN '{v.name}' THEN '{', '.join(v.codes)}'" for v in WAVES.variables if v.values)
    return f"""SELECT variable, 'unexpected_values' AS issue_type,
  'Values not declared in YAML: ' || string_agg(DISTINCT CAST(value AS VARCHAR), ', ' ORDER BY CAST(value AS VARCHAR))
    || '. Valid set: ' || CASE variable {valid} END || '.' AS detail,
  count(*) AS n_bad, string_agg(DISTINCT CAST(value AS VARCHAR), '|' ORDER BY CAST(value AS VARCHAR)) AS bad_values
  FROM undeclared WHERE wave = '{wave}' GROUP BY variable"""


LOSS_ISSUE = f"""SELECT variable, 'coercion_failure' AS issue_type, 'Target: integer. ' || n_bad || ' value(s) -> NA: '
  || replace(bad_values, '|', ', ') || '. Column kept as character.' AS detail, n_bad, bad_values FROM ({PRIORITY_LOSS})"""
ORACLES["issues_table"] = f"WITH {ORDERS}, {ITEMS}, {UNDECLARED} {LOSS_ISSUE} UNION ALL {value_issues('orders')}"
ITEM_ISSUES = f"{value_issues('lineitem')} UNION ALL ({SKIP} FROM lineitem LIMIT 1)"
ORACLES["issues_stamp"] = f"""WITH {ORDERS}, {ITEMS}, {UNDECLARED}
SELECT *, 'lineitem' AS dataset, 2024 AS year, '{NEW_STAMP}' AS logged_at FROM ({ITEM_ISSUES})"""
ORACLES["inject_year"] = "SELECT *, 2023 AS year FROM customer"
ORACLES["dedupe_rows"] = "SELECT DISTINCT l_linenumber, l_returnflag, l_linestatus, l_discount FROM lineitem"
ORACLES["drop_empty_rows"] = f"""WITH {ITEMS}
SELECT nullif(line, 7) AS line, nullif(quantity, 7) AS quantity, 2024 AS year FROM i
WHERE NOT (line = 7 AND quantity = 7)"""
CLEAN_ORDERS = "SELECT DISTINCT CAST(status AS INTEGER) AS status, amount, priority, 2023 AS year FROM o"
CLEAN_ITEMS = f"""SELECT DISTINCT l_linenumber AS line,
  CAST(CASE WHEN l_quantity = 18 THEN 99 ELSE l_quantity END AS INTEGER) AS quantity, l_extendedprice AS amount,
  l_discount <> 0 AS discount, CAST({recoded('l_linestatus', 'status')} AS INTEGER) AS status,
  strftime(l_shipdate, '%Y-%m-%d') AS shipped, 2024 AS year FROM lineitem"""
ORACLES["clean_dataset"] = f"WITH {ORDERS} {CLEAN_ORDERS}"
ORACLES["clean_dataset_missing"] = f"""SELECT DISTINCT * REPLACE (nullif(line, 7) AS line, nullif(quantity, 7) AS quantity)
FROM ({CLEAN_ITEMS})"""
ORACLES["clean_dataset_issues"] = f"WITH {ORDERS}, {ITEMS}, {UNDECLARED} {ITEM_ISSUES}"
ORACLES["valid_semi"] = "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_linenumber BETWEEN 1 AND 5"
ORACLES["unexpected_anti"] = """SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_linenumber NOT BETWEEN 1 AND 5
GROUP BY l_linenumber"""
ORACLES["merge_tables"] = f"""WITH {ORDERS}
SELECT year, status, amount, priority, NULL AS line, NULL AS quantity, NULL AS discount, NULL AS shipped FROM ({CLEAN_ORDERS})
UNION ALL SELECT year, status, amount, NULL, line, quantity, discount, shipped FROM ({CLEAN_ITEMS})"""
ORACLES["merge_mixed_types"] = f"""SELECT NULL AS year, {shortest('l_quantity')} AS answer, CAST(l_linenumber AS DOUBLE) AS code
FROM lineitem UNION ALL SELECT 2023, o_orderstatus, o_totalprice / 2 FROM orders
UNION ALL SELECT NULL, CASE WHEN toxic = 1 THEN 'TRUE' ELSE 'FALSE' END, CAST(quality AS DOUBLE) FROM labels"""

# -- summaries and labels -------------------------------------------------------------------

LINE_LABEL = "CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN 'Line ' || l_linenumber END"
ORACLES["label_decode"] = f"SELECT l_orderkey, l_partkey, l_linenumber, {LINE_LABEL} AS label FROM lineitem"
ORACLES["sum_up"] = """SELECT l_linenumber, count(*) AS n,
  round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM lineitem GROUP BY l_linenumber"""
STATUS_LABELS = " ".join(f"WHEN {text(raw)} THEN {text(dict(CODES['o_orderstatus'].values)[str(new)])}"
                         for raw, new in CODES["o_orderstatus"].recodes)
ORACLES["sum_up_category"] = f"""SELECT CASE o_orderstatus {STATUS_LABELS} END AS o_orderstatus, count(*) AS n,
  round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM orders GROUP BY orders.o_orderstatus"""
ORACLES["validate_structure"] = """SELECT count(*) AS n_rows, 'l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, '
  || 'l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate' AS columns FROM lineitem"""
ORACLES["missingness"] = f"""WITH {ITEMS}, m AS (SELECT count(*) AS n, count(*) FILTER (line = 7) AS a,
  count(*) FILTER (quantity = 7) AS b FROM i),
p AS (SELECT 0 AS ordinal, 'line' AS variable, round_even(100.0::DOUBLE * a / n, 1) AS pct_missing FROM m
  UNION ALL SELECT 1, 'quantity', round_even(100.0::DOUBLE * b / n, 1) FROM m UNION ALL SELECT 2, 'status', 0.0 FROM m)
SELECT *, pct_missing > 50 AS high FROM p"""
ORACLES["conformance_report"] = f"""WITH {ORDERS}, {ITEMS}, {UNDECLARED}, found AS (
  SELECT variable, string_agg(DISTINCT CAST(value AS VARCHAR), ', ' ORDER BY CAST(value AS VARCHAR)) AS unexpected, count(*) AS n
  FROM undeclared WHERE wave = 'lineitem' GROUP BY variable)
SELECT v.variable, v.valid, coalesce(f.unexpected, '') AS unexpected, coalesce(f.n, 0) AS n_bad, f.n IS NULL AS passed
FROM (VALUES ('status', '1, 2'), ('line', '1, 2, 3, 4, 5')) v(variable, valid) LEFT JOIN found f USING (variable)"""
ORACLES["validation_full"] = f"""WITH {ORDERS}, {ITEMS}, {UNDECLARED},
found AS (SELECT variable, CAST(value AS VARCHAR) AS value, count(*) AS n FROM undeclared WHERE wave = 'lineitem' GROUP BY ALL),
per AS (SELECT variable, count(*) AS codes, sum(n) AS cells, string_agg(value, ', ' ORDER BY value) AS listed FROM found
        GROUP BY variable),
m AS (SELECT count(*) AS n, count(*) - count(status) AS status, count(*) - count(line) AS line,
        count(*) - count(amount) AS amount, count(*) - count(quantity) AS quantity, count(*) - count(discount) AS discount,
        (SELECT count(*) - count(l_shipdate) FROM lineitem) AS shipped FROM i),
p AS (SELECT variable, round_even(100.0::DOUBLE * missing / n, 1) AS pct
      FROM (UNPIVOT m ON status, line, amount, quantity, discount, shipped INTO NAME variable VALUE missing))
SELECT 'structure' AS "check", 'line, quantity, amount, discount, status, shipped' AS variable,
  CAST(n AS VARCHAR) AS found, NULL AS value FROM m
UNION ALL SELECT 'missing', variable, pct || ' ' || CAST(pct > 50 AS VARCHAR), NULL FROM p
UNION ALL SELECT 'conformance', v.variable, coalesce(per.codes, 0) || ' ' || coalesce(per.cells, 0) || ' '
  || CAST(per.codes IS NULL AS VARCHAR), coalesce(per.listed, '')
FROM (VALUES ('status'), ('line')) v(variable) LEFT JOIN per USING (variable)
UNION ALL SELECT 'code', variable, CAST(n AS VARCHAR), value FROM found"""
MAX_QUANTITY = max(int(c) for c in LABELLED["l_quantity"].codes)
ORACLES["labels_invalid"] = f"""SELECT 'l_linenumber' AS variable, CAST(l_linenumber AS VARCHAR) AS value, count(*) AS n
FROM lineitem WHERE l_linenumber NOT BETWEEN 1 AND 5 GROUP BY 2
UNION ALL SELECT 'l_quantity', {shortest('l_quantity')}, count(*) FROM lineitem
WHERE l_quantity NOT BETWEEN 1 AND {MAX_QUANTITY} OR l_quantity <> trunc(l_quantity) GROUP BY 2"""
ORACLES["labels_lenient"] = f"""SELECT l_orderkey, l_partkey,
  CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN l_linenumber END AS l_linenumber,
  CASE WHEN l_quantity BETWEEN 1 AND {MAX_QUANTITY} AND l_quantity = trunc(l_quantity) THEN CAST(l_quantity AS INTEGER) END
    AS l_quantity, l_tax FROM lineitem"""
ORACLES["labels_strict"] = "FROM labels"
ORACLES["labels_strict_error"] = """SELECT '''l_linenumber'' contains values not defined in its value labels: '
  || string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ', ' ORDER BY CAST(l_linenumber AS VARCHAR)) AS message
FROM lineitem WHERE l_linenumber NOT BETWEEN 1 AND 5"""
ORACLES["label_attributes"] = f"""SELECT column_name AS name,
  CASE column_name WHEN 'l_linenumber' THEN 'Line number' WHEN 'l_quantity' THEN 'Quantity' WHEN 'l_tax' THEN 'Tax' END AS label,
  CASE column_name
    WHEN 'l_linenumber' THEN (SELECT string_agg(i || ' Line ' || i, '<br>' ORDER BY i) FROM range(1, 6) r(i))
    WHEN 'l_quantity' THEN (SELECT string_agg(i || ' ' || i || ' pieces', '<br>' ORDER BY i) FROM range(1, {MAX_QUANTITY + 1}) r(i))
    ELSE '' END AS value_labels
FROM (DESCRIBE lineitem)"""
ORACLES["load_map"] = f"""WITH {DEFINITIONS}, {VALUES}
SELECT canonical, CAST(ord AS INTEGER) AS ord, code, label FROM value_rows"""
ORACLES["codebook"] = f"""WITH {DEFINITIONS}, {VALUES}
SELECT canonical, string_agg(code || ' ' || label, '<br>' ORDER BY ord) AS value_labels FROM value_rows GROUP BY canonical"""
ORACLES["codebook_counts"] = f"""SELECT 'l_linenumber' AS canonical, CAST(r.i - 1 AS INTEGER) AS ord, CAST(r.i AS VARCHAR) AS code,
  'Line ' || r.i AS label, count(l_linenumber) AS n FROM range(1, 6) r(i) LEFT JOIN lineitem ON l_linenumber = r.i GROUP BY r.i
UNION ALL SELECT 'l_quantity', CAST(r.i - 1 AS INTEGER), CAST(r.i AS VARCHAR), r.i || ' pieces', count(l_quantity)
FROM range(1, {MAX_QUANTITY + 1}) r(i) LEFT JOIN lineitem ON l_quantity = r.i GROUP BY r.i"""

# -- text -----------------------------------------------------------------------------------

ORACLES["safe_labels"] = "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') AS safe FROM pages"
ORACLES["fix_encode_double"] = "SELECT doc_id, translate(text, 'aeoE', 'åæøÆ') AS text FROM documents"
# A part in Latin-1 loses the accent of í, and has it kept where all of it was written as UTF-8.
ORACLES["fix_encode_bytes"] = """WITH d AS (
  SELECT doc_id, lang, translate(text, 'aeoEi', 'åæøÆí') AS t FROM documents),
h AS (SELECT *, substr(t, 1, length(t) // 2) AS a, substr(t, length(t) // 2 + 1) AS b FROM d),
latin AS (SELECT *, NOT regexp_matches(t, '[^\\x00-\\x{FF}]') AS whole, NOT regexp_matches(a, '[^\\x00-\\x{FF}]') AS part FROM h)
SELECT doc_id, CASE WHEN lang = 'en' THEN t
  WHEN doc_id % 2 = 0 THEN CASE WHEN whole THEN replace(t, 'í', 'i') ELSE t END
  ELSE CASE WHEN part THEN replace(a, 'í', 'i') ELSE a END || b END AS text FROM latin"""

# -- whole job ------------------------------------------------------------------------------

YEARLY = f"""y AS (SELECT 'wave=' || year(o_orderdate) || '.csv' AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST({recoded('o_orderstatus', 'status')} AS INTEGER) AS status, o_totalprice AS amount,
  nullif({recoded('o_orderpriority', 'priority')}, '5') AS priority FROM orders)"""
ORACLES["harmonise_merged"] = f"WITH {YEARLY} SELECT DISTINCT year, status, amount, priority, dataset FROM y"
ORACLES["harmonise_issues"] = f"""WITH {YEARLY}
SELECT dataset, 'priority' AS variable, 'coercion_failure' AS issue_type, 'Target: integer. ' || count(*)
  || ' value(s) -> NA: 4-NOT SPECIFIED. Column kept as character.' AS detail, count(*) AS n_bad,
  '4-NOT SPECIFIED' AS bad_values FROM y WHERE priority = '4-NOT SPECIFIED' GROUP BY dataset
UNION ALL SELECT dataset, 'status', 'unexpected_values', 'Values not declared in YAML: 3. Valid set: 1, 2.', count(*), '3'
FROM y WHERE status = 3 GROUP BY dataset"""
ORACLES["harmonise_codes"] = f"""WITH {YEARLY}
SELECT dataset, 'status' AS variable, CAST(status AS VARCHAR) AS value, count(*) AS n FROM y WHERE status NOT IN (1, 2)
GROUP BY dataset, status"""
ORACLES["harmonise_audit"] = f"""WITH {YEARLY}, d AS (SELECT DISTINCT dataset, year FROM y),
c(raw_name, canonical, method, confidence, needs_review, action, ordinal) AS (VALUES
  ('o_orderkey', NULL, 'unmatched', 'none', true, 'DROPPED — not in canonical set', 0),
  ('o_custkey', NULL, 'unmatched', 'none', true, 'DROPPED — not in canonical set', 1),
  ('o_orderstatus', 'status', 'exact', 'high', false, 'Renamed to canonical', 2),
  ('o_totalprice', 'amount', 'exact', 'high', false, 'Renamed to canonical', 3),
  ('o_orderdate', NULL, 'unmatched', 'none', true, 'DROPPED — not in canonical set', 4),
  ('o_orderpriority', 'priority', 'exact', 'high', false, 'Renamed to canonical', 5))
SELECT d.dataset, d.year, c.raw_name, c.canonical, c.method, c.confidence, c.needs_review, c.action,
  '{NEW_STAMP}' AS logged_at, CAST(c.ordinal AS BIGINT) AS ordinal FROM d, c"""

# -- results read back ------------------------------------------------------------------------

ORACLES["write_merged"] = f"WITH {YEARLY} SELECT DISTINCT year, status, amount, priority FROM y"
ORACLES["write_dataset_files"] = f"""WITH {YEARLY}
SELECT DISTINCT year, status, amount, priority, replace(replace(dataset, '=', '_'), '.', '_') || '_clean' AS dataset FROM y"""
ORACLES["match_log_files"] = ORACLES["harmonise_audit"].replace(", CAST(c.ordinal AS BIGINT) AS ordinal", "")
ORACLES["conformance_many_codes"] = """SELECT DISTINCT 'key' AS variable, CAST(o_orderkey AS VARCHAR) AS code
FROM orders WHERE o_orderkey <> 1"""
ORACLES["conformance_first_codes"] = """WITH c AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey <> 1)
SELECT 'key' AS variable, '1' AS valid, (SELECT string_agg(k, ',' ORDER BY k) FROM (FROM c ORDER BY k LIMIT 50)) AS unexpected,
  (SELECT count(*) FROM c) AS n_codes, (SELECT count(*) FROM lineitem WHERE l_orderkey <> 1) AS n_bad,
  (SELECT count(*) FROM c) = 0 AS passed"""
