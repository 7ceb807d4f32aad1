"""The same results as plain SQL over the same tables, written for another engine."""

from __future__ import annotations

from reportgrid.config import CHAPTERS, ReportConfig
from reportgrid.functions.cells import WHITESPACE
from reportgrid.functions.months import MONTHS
from reportgrid.functions.names import BAD_TOKENS
from reportgrid.plans import views as V

CFG = ReportConfig()
WS = "'" + WHITESPACE + "'"


NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def lst(items) -> str:
    return "[" + ", ".join("'" + str(i).replace("'", "''") + "'" for i in items) + "]"


def inn(items) -> str:
    return "(" + ", ".join("'" + str(i).replace("'", "''") + "'" for i in items) + ")"


def norm(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL OR lower(trim({c}, {WS})) = 'nan' THEN '' ELSE trim({c}, {WS}) END)"


def joined(x: str) -> str:
    return f"coalesce(array_to_string(list_transform({x}, lambda v_: coalesce(v_, '∅')), '|'), '')"


def digits(t: str) -> str:
    return f"regexp_full_match(translate({t}, '%,.-', ''), '\\p{{Nd}}+')"


DOC_ROWS = """doc_split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
doc_words AS (SELECT doc_id, line_no, string_split(line, ' ') AS w FROM doc_split),
doc_chunks AS (SELECT doc_id, line_no, unnest(range((len(w) + 7) // 8)) AS k, w FROM doc_words),
doc_rows AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, k) - 1 AS INTEGER) AS row_idx,
         list_resize(w[k * 8 + 1 : k * 8 + 8], 8, '') AS cells FROM doc_chunks)"""

NOISY = DOC_ROWS + """,
noisy AS (
  SELECT doc_id, row_idx, list_transform(range(8), lambda i:
    CASE (row_idx + i) % 7 WHEN 0 THEN chr(9) || cells[i + 1] || '  ' WHEN 1 THEN ' NaN'
         WHEN 2 THEN NULL WHEN 3 THEN '  ' ELSE cells[i + 1] END) AS cells FROM doc_rows)"""

EMPTIES = f"len(list_filter(cells, lambda c: {norm('c')} = ''))"


def header_like(tokens) -> str:
    known = lst(sorted({t.lower().strip() for t in tokens}))
    numeric = f"len(list_filter(vals, lambda v: {digits('v')}))"
    words = "list_distinct(flatten(list_transform(vals, lambda v: string_split(v, ' '))))"
    unknown = f"len(list_filter({words}, lambda w: NOT list_contains({known}, w)))"
    return f"(len(vals) > 0 AND {numeric} * 2 <= len(vals) AND {unknown} <= 1)"


def filled(cells: str) -> str:
    return f"list_filter(list_transform({cells}, lambda c: {norm('c')}), lambda v: v <> '')"


def has_word(words) -> str:
    tests = " OR ".join(f"contains(lower(c), '{w.lower()}')" for w in words)
    return f"len(list_filter(cells, lambda c: {tests})) > 0"


DOC_FLAGS = DOC_ROWS + f""",
doc_vals AS (SELECT *, list_transform({filled('cells')}, lambda v: lower(v)) AS vals FROM doc_rows),
flags AS (SELECT doc_id, row_idx, cells, {EMPTIES} / 8.0 AS ratio, {header_like(V.DOC_TOKENS)} AS hdr,
          {has_word(V.DOC_WORDS)} AS w1, {has_word(V.DOC_WORDS_NEXT)} AS w2 FROM doc_vals)"""


def prior(threshold: float) -> str:
    before = "OVER (PARTITION BY doc_id ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""SELECT *, max(CASE WHEN ratio < {threshold} THEN row_idx END) {before} AS last_dense,
      max(CASE WHEN ratio < {threshold} AND NOT hdr THEN row_idx END) {before} AS last_data FROM flags"""


DOC_CAND = DOC_FLAGS + f""",
p AS ({prior(0.85)}),
sparse_pts AS (
  SELECT doc_id, row_idx AS point FROM (
    SELECT *, lead(ratio) OVER (PARTITION BY doc_id ORDER BY row_idx) AS next_ratio FROM p)
  WHERE ratio >= 0.85 AND coalesce(next_ratio, 0) < 0.85 AND last_dense IS NOT NULL AND hdr),
hits AS (
  SELECT doc_id, 1 AS kind, row_idx FROM flags WHERE w1 AND NOT hdr
  UNION ALL SELECT doc_id, 2, row_idx FROM flags WHERE w2 AND NOT hdr),
targets AS (
  SELECT h.doc_id, h.kind, CASE WHEN a.hdr THEN a.row_idx WHEN a.ratio < 0.5 THEN NULL
                                WHEN b.hdr THEN b.row_idx END AS t
  FROM hits h JOIN flags a ON a.doc_id = h.doc_id AND a.row_idx = h.row_idx + 1
  LEFT JOIN flags b ON b.doc_id = h.doc_id AND b.row_idx = h.row_idx + 2),
word_pts AS (
  SELECT t.doc_id, t.kind, coalesce(p.last_dense, -1) + 1 AS point, count(*) AS hits
  FROM targets t JOIN p ON p.doc_id = t.doc_id AND p.row_idx = t.t
  WHERE p.last_data IS NOT NULL GROUP BY ALL)"""


def greedy(source: str, keys: str, distance: int = 5, tag: str = "g") -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    cols = ", ".join(f"a.{k}" for k in keys.split(", "))
    return f"""{tag}_next AS (
  SELECT {cols}, a.point, min(b.point) AS nxt FROM {source} a JOIN {source} b
  ON {on} AND b.point >= a.point + {distance} GROUP BY ALL),
{tag} AS (
  SELECT {keys}, min(point) AS point FROM {source} GROUP BY ALL
  UNION ALL SELECT {cols}, b.nxt FROM {tag} a JOIN {tag}_next b ON {on} AND a.point = b.point)"""


DOC_CHOSEN = DOC_CAND + """,
all_pts AS (SELECT doc_id, 0 AS kind, point, 1 AS hits FROM sparse_pts
            UNION ALL SELECT doc_id, kind, point, hits FROM word_pts),
page AS (SELECT doc_id, count(*) AS n FROM doc_rows GROUP BY 1),
best AS (SELECT doc_id, min(kind) AS kind FROM all_pts GROUP BY 1),
mine AS (SELECT a.*, sum(hits) OVER (PARTITION BY a.doc_id) AS total, n FROM all_pts a
         JOIN best USING (doc_id, kind) JOIN page USING (doc_id)),
thick AS (SELECT doc_id, kind, point FROM mine WHERE kind > 0 AND total > n / 5.0),
""" + greedy("thick", "doc_id, kind") + """,
chosen AS (SELECT doc_id, kind, point FROM g
           UNION ALL SELECT doc_id, kind, point FROM mine WHERE kind = 0 OR total <= n / 5.0)"""


def sql_rows(rows) -> str:
    return "[" + ", ".join(lst(r) for r in rows) + "]"


PAIRS = f"""pairs AS (
  SELECT o_orderkey AS id, o_custkey,
    list_transform(range(8), lambda i: CASE WHEN i = (o_orderkey // 8) % 8
      THEN {lst(V.SPARE_CELLS)}[o_custkey % 5 + 1]
      ELSE {sql_rows(V.FIRST_ROWS)}[o_orderkey % 8 + 1][i + 1] END) AS row1,
    {sql_rows(V.SECOND_ROWS)}[o_custkey % 6 + 1] AS row2 FROM orders)"""


def token_class(t: str) -> str:
    return f"""CASE WHEN {t} = '' THEN 'EMPTY' WHEN regexp_full_match({t}, '\\p{{Nd}}{{4}}') THEN 'YEAR'
      WHEN {t} IN ('%', 'pct', 'percent') THEN 'PCT'
      WHEN contains({t}, '/000') OR contains({t}, 'k€') OR contains({t}, 'k eur') OR contains({t}, 'mn') THEN 'UNIT'
      WHEN contains({t}, 'eur') OR contains({t}, '€') OR contains({t}, 'usd') OR contains({t}, '$')
        OR contains({t}, 'gbp') THEN 'CUR' ELSE 'TXT' END"""


# one record per pair and position, labels normalised
CELLS = PAIRS + f""",
pos AS (SELECT id, o_custkey, unnest(range(8)) AS i, row1, row2 FROM pairs),
cells AS (SELECT id, CAST(i AS INTEGER) AS i, {norm('row1[i + 1]')} AS r1, {norm('row2[i + 1]')} AS r2 FROM pos),
filled AS (SELECT *, lower(r2) AS t2,
  coalesce(last_value(nullif(r1, '') IGNORE NULLS) OVER (PARTITION BY id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS fl,
  coalesce(first_value(nullif(r1, '') IGNORE NULLS) OVER (PARTITION BY id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), '') AS fr FROM cells)"""


def row_score(col: str) -> str:
    return f"""(100 * count(*) FILTER ({col} = '') + 2 * count(*) FILTER (i > 0 AND {col} <> {col}_prev)
      + 50 * count(*) FILTER (i = 7 AND {col} = ''))"""


SMART = CELLS + f""",
prevs AS (SELECT *, lag(fl) OVER (PARTITION BY id ORDER BY i) AS fl_prev,
                 lag(fr) OVER (PARTITION BY id ORDER BY i) AS fr_prev,
                 lag(r1) OVER (PARTITION BY id ORDER BY i) AS r1_prev,
                 lag(r2) OVER (PARTITION BY id ORDER BY i) AS r2_prev FROM filled),
scores AS (SELECT id, {row_score('fl')} AS sl, {row_score('fr')} AS sr, {row_score('r1')} AS s1,
                  {row_score('r2')} AS s2 FROM prevs GROUP BY id),
smart AS (SELECT f.id, f.i, f.r1, f.r2, CASE WHEN s.sr < s.sl THEN f.fr ELSE f.fl END AS a
          FROM filled f JOIN scores s ON f.id = s.id)"""

GRAMS = CELLS + f""",
sig AS (SELECT id, i, r1, {token_class('t2')} AS c FROM filled),
runs AS (SELECT id, i, c, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2, lead(c, 3) OVER w AS c3
         FROM sig WINDOW w AS (PARTITION BY id ORDER BY i)),
grams AS (SELECT id, 2 AS n, i, c || ',' || c1 AS gram FROM runs WHERE c1 IS NOT NULL
  UNION ALL SELECT id, 3, i, c || ',' || c1 || ',' || c2 FROM runs WHERE c2 IS NOT NULL
  UNION ALL SELECT id, 4, i, c || ',' || c1 || ',' || c2 || ',' || c3 FROM runs WHERE c3 IS NOT NULL),
rep AS (SELECT g.id, g.n, g.gram, g.i FROM grams g JOIN
  (SELECT id, n, gram FROM grams GROUP BY ALL HAVING count(*) >= 2) r
  ON g.id = r.id AND g.n = r.n AND g.gram = r.gram)"""

# blocks left after overlaps are gone: the next block starts at the first run past the end
BLOCKS = GRAMS + """,
step AS (SELECT a.id, a.n, a.gram, a.i, min(b.i) AS nxt FROM rep a JOIN rep b
  ON a.id = b.id AND a.n = b.n AND a.gram = b.gram AND b.i >= a.i + a.n GROUP BY ALL),
blk AS (SELECT id, n, gram, min(i) AS i FROM rep GROUP BY ALL
  UNION ALL SELECT a.id, a.n, a.gram, s.nxt FROM blk a JOIN step s
  ON a.id = s.id AND a.n = s.n AND a.gram = s.gram AND a.i = s.i)"""

CHOSEN = BLOCKS + """,
pairb AS (SELECT id, 2 AS n, 'CUR,PCT' AS gram, i, true AS forced FROM grams WHERE gram = 'CUR,PCT'),
every AS (SELECT id, n, gram, i, false AS forced FROM blk UNION ALL SELECT id, n, gram, i, forced FROM pairb),
fit AS (SELECT e.id, e.n, e.gram, e.forced, e.i, count(*) FILTER (s.r1 = '') AS empties,
   count(DISTINCT nullif(s.r1, '')) AS labels
   FROM every e JOIN sig s ON s.id = e.id AND s.i BETWEEN e.i AND e.i + e.n - 1 GROUP BY ALL),
tot AS (SELECT id, n, gram, forced, sum(CASE WHEN labels > 0 THEN empties ELSE 0 END) AS fillable,
   count(*) * n AS coverage, sum(greatest(labels - 1, 0)) * 10 AS penalty, min(i) AS first_i,
   list(i ORDER BY i) AS starts,
   CASE WHEN contains(gram, 'PCT') AND contains(gram, 'CUR') THEN 3 WHEN contains(gram, 'PCT') THEN 2
        WHEN contains(gram, 'CUR') THEN 1 ELSE 0 END AS prio
   FROM fit GROUP BY id, n, gram, forced),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY forced DESC, fillable DESC, coverage DESC,
   prio DESC, penalty, n DESC, first_i) AS rk FROM tot WHERE NOT forced OR fillable > 0),
best AS (SELECT p.id, coalesce(r.forced, false) AS forced, CAST(coalesce(r.fillable, 0) AS INTEGER) AS fillable,
   CAST(coalesce(r.n, 0) AS INTEGER) AS n, coalesce(r.starts, []) AS starts,
   coalesce(r.coverage / 8.0, 0.0) AS coverage, r.gram
   FROM pairs p LEFT JOIN ranked r ON r.id = p.id AND r.rk = 1)"""


def name_of(first: str, second: str, i: str) -> str:
    text = f"CASE WHEN {second} <> '' AND {first} <> '' THEN {second} || ' ' || {first} ELSE {second} || {first} END"
    return (
        f"CASE WHEN {second} || {first} = '' THEN 'col_' || {i} "
        f"ELSE replace(replace(lower({text}), ' ', '_'), '%', 'pct') END"
    )


NAMES = PAIRS + f""",
named AS (SELECT id, o_custkey, list_transform(range(8), lambda i:
  {name_of(norm('row1[i + 1]'), norm('row2[i + 1]'), 'i')}) AS names FROM pairs)"""


def unique(x: str) -> str:
    return f"len(list_distinct({x})) = len({x})"


def segment_in(name: str, tokens) -> str:
    return f"list_has_any(string_split(lower({name}), '_'), {lst(t.lower() for t in tokens)})"


def with_name(names: str, at: int, value: str) -> str:
    return f"list_concat(list_concat({names}[1:{at}], ['{value}']), {names}[{at + 2}:])"


def default_rules(names: str) -> str:
    """The two naming rules as nested choices on one list."""
    one = f"(CASE WHEN {unique(with_name(names, 0, 'item_agg'))} THEN {with_name(names, 0, 'item_agg')} ELSE {names} END)"
    return one


def second_rule(names: str) -> str:
    put = with_name(names, 1, "item_agg_2")
    return f"(CASE WHEN {segment_in(names + '[2]', ['december', 'ytd'])} AND {unique(put)} THEN {put} ELSE {names} END)"


def list_score(names: str) -> str:
    return (
        f"1000 * (len({names}) - len(list_distinct({names}))) "
        f"+ 50 * len(list_filter({names}, lambda x: starts_with(x, 'col_')))"
    )


INFER = SMART + ", " + CHOSEN[len(CELLS) + 1:].lstrip(", \n") + f""",
blocked AS (SELECT s.id, s.i, s.r1, s.r2, s.a, b.forced, b.fillable, b.coverage, b.n,
    list_filter(b.starts, lambda x: x <= s.i AND s.i < x + b.n) AS mine,
    len(b.starts) > 0 AND (b.fillable > 0 OR b.coverage >= 0.40) AS usable
  FROM smart s JOIN best b ON b.id = s.id),
anchored AS (SELECT k.*, CASE WHEN len(mine) = 0 OR r1 <> '' THEN a ELSE coalesce(
    first_value(nullif(r1, '') IGNORE NULLS) OVER w, first_value(nullif(a, '') IGNORE NULLS) OVER w, a) END AS b
  FROM blocked k WINDOW w AS (PARTITION BY id, mine ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
two AS (SELECT id, list({name_of('a', 'r2', 'i')} ORDER BY i) AS na, list({name_of('b', 'r2', 'i')} ORDER BY i) AS nb,
    list(a ORDER BY i) AS la, list(b ORDER BY i) AS lb, bool_or(usable) AS usable, bool_or(forced) AS forced,
    max(fillable) AS fillable, max(coverage) AS coverage FROM anchored GROUP BY id),
rule1 AS (SELECT * REPLACE ({default_rules('na')} AS na, {default_rules('nb')} AS nb) FROM two),
rule2 AS (SELECT * REPLACE ({second_rule('na')} AS na, {second_rule('nb')} AS nb) FROM rule1),
judged AS (SELECT *, coalesce(usable AND (({list_score('nb')}) < ({list_score('na')}) OR (({list_score('nb')}) = ({list_score('na')})
    AND nb <> na AND (forced OR fillable > 0 OR coverage >= 0.60))), false) AS use_block FROM rule2),
head1 AS (SELECT id, list_transform({filled('row1')}, lambda v: lower(v)) AS vals FROM pairs),
head2 AS (SELECT id, list_transform({filled('row2')}, lambda v: lower(v)) AS vals FROM pairs),
ok AS (SELECT id FROM head1 WHERE {header_like(CFG.header_tokens)}
       INTERSECT SELECT id FROM head2 WHERE {header_like(CFG.header_tokens)}),
inferred AS (SELECT p.id, p.o_custkey, CASE WHEN use_block THEN nb ELSE na END AS names,
    CASE WHEN use_block THEN lb[1] ELSE la[1] END AS period_agg, use_block
  FROM pairs p LEFT JOIN (SELECT * FROM judged WHERE id IN (SELECT id FROM ok)) j ON j.id = p.id)"""


def eu(cents: str) -> str:
    return (
        f"(CASE WHEN {cents} < 0 THEN '-' ELSE '' END || replace(format('{{:,}}', abs({cents}) // 100), ',', '.') "
        f"|| ',' || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0'))"
    )


KEY = "(l_orderkey + l_linenumber)"
SALES = f"""sales AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN {KEY} % 17 = 0 THEN 'n.s.' WHEN {KEY} % 19 = 0 THEN ''
    ELSE {eu('CAST(round(l_extendedprice * 100) AS BIGINT)')} END AS price,
  CASE WHEN {KEY} % 23 = 0 THEN 'x%' WHEN {KEY} % 29 = 0 THEN NULL
    ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' END AS discount,
  CASE WHEN {KEY} % 3 = 0 THEN 'n.a.%' ELSE CAST(CAST(round(l_tax * 1000) AS INTEGER) AS VARCHAR) || ',5 %' END AS tax,
  CASE WHEN {KEY} % 2 = 0 THEN 'part ' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS part,
  CASE WHEN {KEY} % 31 = 0 THEN 'null' WHEN {KEY} % 37 = 0 THEN ' n.s.' ELSE l_returnflag END AS flag,
  CAST(NULL AS VARCHAR) AS blank FROM lineitem)"""


def not_sentinel(c: str) -> str:
    return f"CASE WHEN {c} IN (' ', '', 'n.s.', 'null', 'n.s') THEN NULL ELSE {c} END"


CLEAN = SALES + ", clean AS (SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{not_sentinel(c)} AS {c}" for c in V.SALES_COLUMNS
) + " FROM sales)"


def number(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{NUMBER_TEXT}') THEN try_cast({text} AS DOUBLE) END"


def pct(c: str) -> str:
    return f"({number(f'trim(replace(replace({c}, chr(37), chr(32)[2:]), chr(44), chr(46)), {WS})')}) / 100"


def eu_number(c: str) -> str:
    return number(f"replace(replace({c}, '.', ''), ',', '.')")


LONG = CLEAN + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS name, {c} AS text, l_orderkey * 10 + l_linenumber AS index FROM clean"
    for c in V.SALES_COLUMNS
) + "), parsed AS (SELECT *, " + pct("text") + " AS p, " + eu_number("text") + """ AS e FROM long),
prof AS (SELECT name, count(text) AS n_values, count(*) FILTER (contains(text, '%')) AS n_percent,
  count(*) FILTER (regexp_matches(text, '\\p{Nd}')) AS n_digit,
  count(*) FILTER (text IS NOT NULL AND p IS NULL) AS lost_percent,
  count(*) FILTER (text IS NOT NULL AND e IS NULL) AS lost_number, count(*) AS n_rows FROM parsed GROUP BY name),
kinds AS (SELECT name, n_percent * 2 >= n_values AND lost_percent * 10 <= n_rows AS is_pct,
  n_digit * 2 >= n_values AND lost_number * 10 <= n_rows AS is_num FROM prof WHERE n_values > 0)"""

SPOILED = CLEAN + f""", spoiled AS (SELECT l_orderkey, l_linenumber, l_orderkey % 40 AS doc,
  CASE WHEN l_orderkey % 4 = 0 AND l_linenumber % 2 = 0 THEN 'none%' ELSE discount END AS discount,
  CASE WHEN l_orderkey % 5 = 0 AND l_linenumber % 2 = 0 THEN '4 or 5' ELSE price END AS price FROM clean),
measured AS (SELECT *, {pct('discount')} AS dp, {eu_number('discount')} AS dn, {pct('price')} AS pp, {eu_number('price')} AS pn FROM spoiled),
counted AS (SELECT doc, count(*) AS n, count(discount) AS d_values, count(price) AS p_values,
  count(*) FILTER (contains(discount, '%')) AS d_pct, count(*) FILTER (contains(price, '%')) AS pr_pct,
  count(*) FILTER (regexp_matches(discount, '\\p{{Nd}}')) AS d_dig, count(*) FILTER (regexp_matches(price, '\\p{{Nd}}')) AS p_dig,
  count(*) FILTER (discount IS NOT NULL AND dp IS NULL) AS d_lost_p, count(*) FILTER (discount IS NOT NULL AND dn IS NULL) AS d_lost_n,
  count(*) FILTER (price IS NOT NULL AND pp IS NULL) AS p_lost_p, count(*) FILTER (price IS NOT NULL AND pn IS NULL) AS p_lost_n
  FROM measured GROUP BY doc),
by_doc AS (SELECT *, d_pct * 2 >= d_values AND d_lost_p * 10 <= n AS is_pct, d_dig * 2 >= d_values AND d_lost_n * 10 <= n AS d_num,
  pr_pct * 2 >= p_values AND p_lost_p * 10 <= n AS p_pct, p_dig * 2 >= p_values AND p_lost_n * 10 <= n AS is_num FROM counted)"""

MONTH_VALUES = ", ".join(f"('{k}', {v})" for k, v in MONTHS.items())
PERIODS = f"""months(name, m) AS (VALUES {MONTH_VALUES}),
labels AS (SELECT o_orderkey, o_custkey, CASE o_orderkey % 7 WHEN 0 THEN 'YTD'
  WHEN 1 THEN strftime(o_orderdate, '%b') || '-2024' WHEN 2 THEN {lst(V.ITALIAN)}[month(o_orderdate)]
  WHEN 3 THEN NULL WHEN 4 THEN ' ' || upper(monthname(o_orderdate)) || ' '
  WHEN 5 THEN 'Q' || quarter(o_orderdate) ELSE monthname(o_orderdate) || ' /x' END AS period_agg FROM orders),
starts AS (SELECT l.*, make_date(2025, m.m, 1) AS start FROM labels l LEFT JOIN months m
  ON m.name = lower(string_split_regex(trim(l.period_agg, {WS}), '[\\s,/_-]+')[1]))"""

CHAPTER_VALUES = ", ".join(
    f"({n}, '{c}', '{s}', {lo}, {hi})"
    for n, (c, s, (lo, hi)) in enumerate((c, s, r) for c, subs in CHAPTERS.items() for s, r in subs.items())
)
CHAPTER = f"""ranges(ord, capitolo, sottocapitolo, lo, hi) AS (VALUES {CHAPTER_VALUES}),
spread AS (SELECT ord, capitolo, sottocapitolo, unnest(range(lo, hi + 1)) AS page_num FROM ranges),
chapter AS (SELECT page_num, arg_max(capitolo, ord) AS capitolo, arg_max(sottocapitolo, ord) AS sottocapitolo
  FROM spread GROUP BY 1)"""

# The report, straight from the orders: what the grids were made of.
FACTS = CHAPTER + """,
lines AS (SELECT o_custkey AS doc_id, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS side,
    CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS line, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    o_orderdate >= TIMESTAMP '1998-07-01' AS late FROM orders),
sums AS (SELECT doc_id, side, line, sum(CASE WHEN late THEN cents ELSE 0 END)::BIGINT AS a25,
    sum(CASE WHEN late THEN 0 ELSE cents END)::BIGINT AS a24
  FROM (SELECT * FROM lines UNION ALL SELECT doc_id, side, 9, cents, late FROM lines
        UNION ALL SELECT c_custkey, unnest([0, 1]), 9, 0, true FROM customer) GROUP BY ALL),
wide AS (SELECT DISTINCT doc_id, line, unnest([0, 1]) AS side FROM sums WHERE doc_id % 2 = 1),
grid AS (SELECT doc_id, side, line, a25, a24 FROM sums WHERE doc_id % 2 = 0
  UNION ALL SELECT w.doc_id, w.side, w.line, s.a25, s.a24 FROM wide w LEFT JOIN sums s
    ON s.doc_id = w.doc_id AND s.side = w.side AND s.line = w.line),
marked AS (SELECT g.*, g.doc_id % 20 AS fault, c.c_name, n.n_name, c.c_mktsegment,
    CASE line WHEN 1 THEN 'URGENT' WHEN 2 THEN 'Pharma' WHEN 3 THEN 'MEDIUM' WHEN 4 THEN 'Diagnostic'
              WHEN 5 THEN 'LOW' ELSE 'TOTAL' END AS label,
    CASE WHEN (g.doc_id % 7 = 0) = (g.side = 0) THEN 'YTD' ELSE 'December' END AS period
  FROM grid g JOIN customer c ON c.c_custkey = g.doc_id JOIN nation n ON n.n_nationkey = c.c_nationkey),
labelled AS (SELECT *, last_value(CASE WHEN line IN (2, 4) THEN label END IGNORE NULLS) OVER
    (PARTITION BY doc_id, side ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp,
    row_number() OVER (PARTITION BY doc_id ORDER BY side, line) - 1 AS ord FROM marked),
shown AS (SELECT *, fault = 4 AND side = 1 AS bare FROM labelled
  WHERE fault NOT IN (6, 12) AND NOT (fault IN (8, 10) AND side = 1))"""

FACT_SELECT = """SELECT doc_id, CAST(doc_id % 80 AS INTEGER) AS page_num, ch.capitolo, ch.sottocapitolo,
  upper(c_name) AS page_title, upper(n_name) AS page_subtitle,
  CASE WHEN doc_id % 2 = 1 THEN NULL WHEN side = 0 THEN upper(c_mktsegment)
       WHEN doc_id % 3 > 0 OR fault = 4 THEN 'ONCOLOGY' END AS page_subtitle_1,
  CASE WHEN doc_id % 2 = 1 THEN 0 ELSE side END AS table_id,
  CASE WHEN bare THEN NULL WHEN period = 'December' THEN 'MONTH' ELSE period END AS period_desc,
  CASE WHEN doc_id % 7 = 0 AND (side = 0 OR bare) THEN DATE '2026-03-01' ELSE DATE '2025-12-01' END AS period_start,
  CASE WHEN fault = 16 AND side = 1 THEN CASE WHEN line % 2 = 0 THEN 'HI' ELSE 'LO' END END AS item_agg_2,
  grp AS item_agg_1, CASE WHEN NOT bare THEN label END AS item_agg,
  CASE WHEN NOT bare AND NOT (fault = 16 AND side = 1) THEN a24 / 100.0 END AS "2024_act",
  CASE WHEN NOT bare THEN a25 / 100.0 END AS "2025_act",
  CASE WHEN NOT bare THEN (a25 + a24) / 100.0 END AS "2025_bdg",
  CASE WHEN NOT bare THEN (a25 - a24) / 100.0 END AS eur_vs_act,
  CASE WHEN NOT bare AND NOT (fault = 2 AND line = 1) THEN (a25 % 97 - 48) / 100.0 END AS pct_vs_act,
  CASE WHEN NOT bare AND fault <> 18 AND NOT (fault = 14 AND side = 1) THEN -a24 / 100.0 END AS eur_vs_bdg,
  CASE WHEN NOT bare AND NOT (fault = 14 AND side = 1) THEN (a24 % 89) / 100.0 END AS pct_vs_bdg,
  CASE WHEN fault = 14 AND side = 1 THEN -a24 / 100.0 END AS eur_delta,
  CASE WHEN fault = 14 AND side = 1 THEN (a24 % 89) / 100.0 END AS pct_delta,
  'run-' || (doc_id % 4) AS run_id,
  TIMESTAMP '2026-01-05 10:00:00' + to_seconds(doc_id % 10) AS timestamp_utc
FROM shown LEFT JOIN chapter ch ON ch.page_num = doc_id % 80"""

PART_NAMES = f"""CASE WHEN fault = 4 AND side = 1 OR fault = 6 AND side = 0 THEN []
  WHEN side = 1 AND fault = 16 THEN {lst(['item_agg', 'item_agg_2', '2025_act', '2025_bdg', 'eur_vs_act', 'pct_vs_act', 'eur_vs_bdg', 'pct_vs_bdg'])}
  WHEN side = 1 AND fault = 8 THEN list_concat(['euro/000_' || lower(period)], {lst(['2025_act', '2025_act', '2025_bdg', 'eur_vs_act', 'pct_vs_act', 'eur_vs_bdg', 'pct_vs_bdg'])})
  WHEN side = 1 AND fault IN (10, 14) THEN list_concat({lst(['item_agg', '2025_act', '2024_act', '2025_bdg', 'eur_vs_act', 'pct_vs_act'])},
    CASE fault WHEN 10 THEN ['eur_vs_bdg*', 'pct_vs_bdg*'] ELSE ['eur_delta', 'pct_delta'] END)
  ELSE {lst(['item_agg', '2025_act', '2024_act', '2025_bdg', 'eur_vs_act', 'pct_vs_act', 'eur_vs_bdg', 'pct_vs_bdg'])} END"""

# Where each part's data rows stand in its page, and what it is called.
PARTS = FACTS + f""",
sizes AS (SELECT doc_id, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1 FROM labelled GROUP BY 1),
sides AS (SELECT s.*, doc_id % 20 AS fault, doc_id % 2 = 1 AS wide, c_mktsegment, unnest([0, 1]) AS side
  FROM sizes s JOIN customer c ON c.c_custkey = s.doc_id WHERE doc_id % 20 <> 12),
period AS (SELECT *, CASE WHEN (doc_id % 7 = 0) = (side = 0) THEN 'YTD' ELSE 'December' END AS period,
  CASE WHEN fault = 6 THEN 3 ELSE 5 END AS first0 FROM sides),
part_list AS (SELECT doc_id, fault, side, period, CASE WHEN wide THEN 0 ELSE side END AS table_id,
  CASE WHEN NOT wide THEN 1 ELSE 11 + side END AS part_id, CASE WHEN wide THEN 1 END AS parent_id,
  CASE WHEN wide THEN 4 WHEN side = 0 THEN first0 ELSE first0 + n0 + CASE WHEN doc_id % 3 > 0 OR fault = 4 THEN 1 ELSE 0 END
    + CASE WHEN fault = 4 THEN 0 ELSE 2 END END AS first_data,
  CASE WHEN side = 0 THEN n0 ELSE n1 END AS n_data,
  CASE WHEN wide THEN NULL WHEN side = 0 THEN upper(c_mktsegment) WHEN doc_id % 3 > 0 OR fault = 4 THEN 'ONCOLOGY' END AS page_subtitle_1,
  {PART_NAMES} AS names FROM period)"""

ERRORS = """errs AS (SELECT c_custkey AS doc_id, CAST(c_custkey % 80 AS INTEGER) AS page,
  CASE c_custkey % 20 WHEN 10 THEN 18 ELSE 8 END AS n_col,
  CASE c_custkey % 20 WHEN 12 THEN 'NARROW_GRID: the grid has fewer columns than configured'
    WHEN 6 THEN 'NO_HEADER: no header rows and no earlier header on the page'
    WHEN 8 THEN 'NO_ITEM_AGG: the names do not hold the item column exactly once'
    WHEN 10 THEN 'BAD_CHARS_IN_COLNAMES: [''eur_vs_bdg*'', ''pct_vs_bdg*'']' END AS e_des FROM customer)"""


def q(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}" if ctes else select


CHECKED = NAMES + f""",
checked AS (SELECT id, id % 100 AS page_num, list_concat(['run_id', 'page_num'], names) AS n FROM named),
found AS (SELECT *, list_filter(n, lambda x, i: len(list_filter(n, lambda y: y = x)) > 1
      AND list_position(n, x) = i) AS dup,
  list_filter(n, lambda x: regexp_full_match(trim(x, {WS}),
    '\\d{{4}}|[+-]?\\d+([.,]\\d+)?%|[+-]?\\d{{1,3}}(\\.\\d{{3}})*|[+-]?\\d+([.,]\\d+)?')) AS num,
  list_filter(n, lambda x: regexp_matches(x, '[^\\p{{L}}\\p{{N}}_\\s]')) AS bad,
  list_filter(n, lambda x: regexp_matches(x, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({"|".join(BAD_TOKENS)})([^\\p{{L}}\\p{{N}}_]|$)')) AS tok
  FROM checked),
issued AS (SELECT *, concat_ws('|', CASE WHEN len(dup) > 0 THEN 'DUPLICATE_COLS' END,
  CASE WHEN len(num) > 0 THEN 'NUMERIC_COLNAMES' END, CASE WHEN len(bad) > 0 THEN 'BAD_CHARS' END,
  CASE WHEN len(tok) > 0 THEN 'BAD_TOKENS' END) AS issues FROM found)"""


def quoted(x: str) -> str:
    return f"'[' || array_to_string(list_transform({x}, lambda v: '''' || v || ''''), ', ') || ']'"


def rules_pre(source: str) -> str:
    """The registered rules one by one: two fixed names, then the placeholder."""
    hits = f"len(list_filter(n2, lambda x: {segment_in('x', ['act', 'bdg'])}))"
    put = (
        "list_transform(n2, lambda x: array_to_string(list_transform(string_split(x, '_'), "
        "lambda s: CASE WHEN lower(s) IN ('act', 'bdg') THEN 'val' ELSE s END), '_'))"
    )
    return f"""s1 AS (SELECT *, {default_rules('names')} AS n1 FROM {source}),
s2 AS (SELECT *, {second_rule('n1')} AS n2 FROM s1),
s3 AS (SELECT *, CASE WHEN {hits} >= 3 AND {unique(put)} THEN {put} ELSE n2 END AS n3 FROM s2)"""


def oracles() -> dict[str, str]:
    title = f"array_to_string({filled('cells')}, ' ')"
    run = "sum(CASE WHEN ratio < 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY row_idx)"
    out = {
        "grid_scan": q(DOC_ROWS + """, ends AS (SELECT doc_id, max(row_idx) AS m FROM doc_rows
                         WHERE len(list_filter(cells, lambda c: c <> '')) > 0 GROUP BY doc_id)""",
                       f"SELECT doc_id, row_idx, CAST(doc_id % 4 + 5 AS INTEGER) AS n_col, "
                       f"{joined('cells[1:doc_id % 4 + 5]')} AS cells FROM doc_rows JOIN ends USING (doc_id) WHERE row_idx <= m"),
        "page_config_join": q(DOC_ROWS + """, cfg AS (SELECT doc_id, quality * 3 + toxic * 2 + 5 AS n_col FROM labels)""",
                              f"""SELECT doc_id, row_idx, CAST(n_col AS INTEGER) AS n_col, n_col > 8 AS narrow,
              {joined('list_resize(cells, n_col)')} AS cells FROM doc_rows JOIN cfg USING (doc_id)"""),
        "cell_norm": q(NOISY, f"SELECT doc_id, row_idx, {joined(f'list_transform(cells, lambda c: {norm("c")})')} AS cells FROM noisy"),
        "empty_cells": q(NOISY, f"""SELECT doc_id, row_idx, array_to_string(list_transform(cells, lambda c:
              CASE WHEN {norm('c')} = '' THEN '1' ELSE '0' END), '') AS empty_flags FROM noisy"""),
        "row_empty_ratio": q(NOISY, f"SELECT doc_id, row_idx, {EMPTIES} / 8.0 AS ratio FROM noisy"),
        "numeric_cells": q(SALES, "SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"{digits(c)} AS {c}_numeric" for c in V.SALES_COLUMNS[:5]) + " FROM sales"),
        "header_rows": q(DOC_FLAGS, "SELECT doc_id, row_idx, hdr AS is_header FROM flags"),
        "token_class": q(CELLS, f"""SELECT id, string_agg({token_class('lower(r1)')}, '|' ORDER BY i) AS classes1,
              string_agg({token_class('lower(r2)')}, '|' ORDER BY i) AS classes2 FROM cells GROUP BY id"""),
        "token_hits": q(NAMES, f"""SELECT id, coalesce(array_to_string(list_filter(list_transform(range(8), lambda i:
              CASE WHEN {segment_in('names[i + 1]', ['december', 'act', 'pct'])} THEN CAST(i AS VARCHAR) END),
              lambda x: x IS NOT NULL), '|'), '') AS hits FROM named"""),
        "name_build": q(NAMES, f"SELECT id, {joined('names')} AS names FROM named"),
        "month_start": q(PERIODS, "SELECT o_orderkey, start AS month_start, strftime(start, '%d/%m/%Y') AS month_text FROM starts"),
        "half_similarity": q(PAIRS + f""", h AS (SELECT id, {filled('row1[1:4]')} AS a1, {filled('row1[5:8]')} AS b1,
              {filled('row2[1:4]')} AS a2, {filled('row2[5:8]')} AS b2 FROM pairs)""",
              "SELECT id, " + ", ".join(
              f"""CASE WHEN least(len(a{k}), len(b{k})) = 0 THEN 0.0 ELSE len(list_filter(range(1, least(len(a{k}), len(b{k})) + 1),
              lambda i: a{k}[i] = b{k}[i])) / least(len(a{k}), len(b{k})) END AS similarity{k}""" for k in (1, 2)) + " FROM h"),
        "null_sentinels": q(CLEAN, "SELECT * FROM clean"),
        "pct_parse": q(SALES, "SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"{pct(c)} AS {c}" for c in ("discount", "tax", "part")) + " FROM sales"),
        "eu_number_parse": q(SALES, "SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"{eu_number(c)} AS {c}" for c in ("price", "discount", "part")) + " FROM sales"),
        "ts_utc_naive": """SELECT event_id, ts
              - CASE WHEN event_id % 3 = 1 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS ts_utc FROM events""",
        "final_projection": q(SALES, f"""SELECT {eu_number('price')} AS price, tax, CAST(NULL AS VARCHAR) AS absent,
              l_linenumber, l_orderkey FROM sales"""),
        "positional_rename": q(SALES, 'SELECT l_orderkey, l_linenumber, price AS "2025_act", part AS item_agg FROM sales'),
        "keyword_rows": q(DOC_FLAGS, f"SELECT doc_id, row_idx, {joined('cells')} AS cells FROM flags WHERE w1"),
        "sparse_rows": q(DOC_FLAGS, "SELECT doc_id, row_idx, ratio >= 0.85 AS very_sparse FROM flags WHERE ratio >= 0.5"),
        "page_title": q(DOC_FLAGS + f""", lead_rows AS (SELECT *, {run} AS dense, {title} AS txt FROM flags)""",
              """SELECT doc_id, nullif(upper(coalesce(string_agg(nullif(txt, ''), ' | ' ORDER BY row_idx)
                FILTER (dense = 0 AND row_idx < 3), '')), '') AS title,
              CAST(count(*) FILTER (dense = 0 AND row_idx < 3) AS INTEGER) AS taken FROM lead_rows GROUP BY doc_id"""),
        "drop_title_rows": q(DOC_FLAGS + f", lead_rows AS (SELECT *, {run} AS dense FROM flags)",
              """SELECT doc_id, row_idx, row_number() OVER (PARTITION BY doc_id ORDER BY row_idx) - 1 AS new_idx
              FROM lead_rows WHERE dense > 0 OR row_idx >= 3"""),
        "sparse_runs": q(DOC_FLAGS + """, isl AS (SELECT doc_id, row_idx, row_idx - row_number() OVER
              (PARTITION BY doc_id ORDER BY row_idx) AS grp FROM flags WHERE ratio >= 0.5)""",
              'SELECT doc_id, min(row_idx) AS "first", max(row_idx) AS "last" FROM isl GROUP BY doc_id, grp'),
        "backtrack_title": q(DOC_FLAGS + f", p AS ({prior(0.5)})",
              "SELECT doc_id, row_idx, CASE WHEN last_dense IS NULL THEN 0 ELSE row_idx END AS title_start FROM p"),
        "backtrack_run": q(DOC_FLAGS + f", p AS ({prior(0.5)})",
              "SELECT doc_id, row_idx, coalesce(last_dense, -1) + 1 AS run_start FROM p"),
        "has_data_before": q(DOC_FLAGS + f", p AS ({prior(0.5)})",
              "SELECT doc_id, row_idx, last_data IS NOT NULL AS has_data FROM p"),
        "split_points_sparse": q(DOC_CAND, "SELECT doc_id, point FROM sparse_pts"),
        "split_points_keyword": q(DOC_CAND, "SELECT doc_id, kind, point, hits FROM word_pts"),
        "split_cascade": q(DOC_CHOSEN, "SELECT doc_id, kind, point FROM chosen"),
        "min_distance_points": q(DOC_FLAGS + ", pts AS (SELECT doc_id, row_idx AS point FROM flags WHERE w1), "
              + greedy("pts", "doc_id"), "SELECT doc_id, point FROM g"),
        "split_tables": q(DOC_CHOSEN + """, cut AS (SELECT r.doc_id, r.row_idx, count(c.point) AS table_id,
              coalesce(max(c.point), 0) AS start FROM doc_rows r LEFT JOIN chosen c
              ON c.doc_id = r.doc_id AND c.point <= r.row_idx AND c.point > 0 GROUP BY ALL)""",
              "SELECT doc_id, row_idx, CAST(table_id AS INTEGER) AS table_id, row_idx - start AS new_idx FROM cut"),
        "side_by_side": q(PAIRS + f""", d AS (SELECT id, list_concat(row1, list_transform(row1, lambda c:
                CASE WHEN id % 3 > 0 THEN c ELSE 'x' END)) AS h1, list_concat(row2, list_transform(range(8), lambda i:
                CASE WHEN id % 5 > 0 OR i > 1 THEN row2[i + 1] ELSE 'y' END)) AS h2 FROM pairs),
              f AS (SELECT id, h1, {filled('h1[1:8]')} AS a1, {filled('h1[9:16]')} AS b1,
                {filled('h2[1:8]')} AS a2, {filled('h2[9:16]')} AS b2 FROM d),
              s AS (SELECT id, h1, """ + ", ".join(
                f"""coalesce(len(list_filter(range(1, least(len(a{k}), len(b{k})) + 1), lambda i: a{k}[i] = b{k}[i]))
                / nullif(least(len(a{k}), len(b{k})), 0), 0) AS s{k}""" for k in (1, 2)) + " FROM f)",
              f"""SELECT id, 1 AS part_id, CAST(NULL AS INTEGER) AS parent_id, {joined('h1')} AS first_row FROM s
                WHERE NOT (s1 >= 0.6 AND s2 >= 0.95)
              UNION ALL SELECT id, 11, 1, {joined('h1[1:8]')} FROM s WHERE s1 >= 0.6 AND s2 >= 0.95
              UNION ALL SELECT id, 12, 1, {joined('h1[9:16]')} FROM s WHERE s1 >= 0.6 AND s2 >= 0.95"""),
        "group_label_ffill": """WITH g AS (SELECT p_brand, p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_type
              ELSE p_name END AS item FROM part) SELECT *, last_value(CASE WHEN item IN ('ECONOMY', 'SMALL') THEN item END
              IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS item_agg_1 FROM g""",
        "fill_left_right": q(CELLS, """SELECT id, string_agg(fl, '|' ORDER BY i) AS fill_left,
              string_agg(fr, '|' ORDER BY i) AS fill_right FROM filled GROUP BY id"""),
        "fill_score": q(SMART, "SELECT id, CAST(s1 AS INTEGER) AS score1, CAST(s2 AS INTEGER) AS score2 FROM scores"),
        "smart_fill": q(SMART, "SELECT id, string_agg(a, '|' ORDER BY i) AS filled FROM smart GROUP BY id"),
        "ngram_repeats": q(GRAMS, """SELECT id, gram, string_agg(CAST(i AS VARCHAR), '|' ORDER BY i) AS starts
              FROM rep GROUP BY id, n, gram"""),
        "overlap_removal": q(BLOCKS, """SELECT id, gram, string_agg(CAST(i AS VARCHAR), '|' ORDER BY i) AS starts
              FROM blk WHERE n = 2 GROUP BY id, gram"""),
        "block_context": q(CELLS + """, b AS (SELECT id, i, r1,
                CASE WHEN i IN (1, 2) THEN 1 WHEN i IN (4, 5) THEN 4 WHEN i IN (6, 7) THEN 6 END AS s FROM cells),
              f AS (SELECT id, s, count(*) FILTER (r1 = '') AS e, count(DISTINCT nullif(r1, '')) AS l FROM b
                WHERE s IS NOT NULL GROUP BY id, s)""",
              """SELECT id, CAST(sum(CASE WHEN l > 0 THEN e ELSE 0 END) AS INTEGER) AS fillable,
              CAST(sum(e) AS INTEGER) AS covered, CAST(sum(greatest(l - 1, 0)) * 10 AS INTEGER) AS penalty FROM f GROUP BY id"""),
        "best_block": q(CHOSEN, """SELECT id, forced, fillable, n, coalesce(array_to_string(list_transform(starts,
              lambda s: CAST(s AS VARCHAR)), '|'), '') AS starts, round(coverage, 6) AS coverage, gram FROM best"""),
        "block_fill": q(CELLS + """, b AS (SELECT *, CASE WHEN i IN (0, 1) THEN 0 WHEN i IN (4, 5) THEN 4
                WHEN i IN (6, 7) THEN 6 ELSE 100 + i END AS s FROM filled),
              f AS (SELECT *, CASE WHEN r1 <> '' OR s >= 100 THEN fl ELSE coalesce(
                first_value(nullif(r1, '') IGNORE NULLS) OVER w, first_value(nullif(fl, '') IGNORE NULLS) OVER w, fl) END AS v
                FROM b WINDOW w AS (PARTITION BY id, s ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""",
              "SELECT id, string_agg(v, '|' ORDER BY i) AS filled FROM f GROUP BY id"),
        "name_score": q(NAMES, f"SELECT id, CAST({list_score('names')} AS INTEGER) AS score FROM named"),
        "naming_rules": q(NAMES + ", " + rules_pre("named"), f"""SELECT id, {joined('n3')} AS pre,
              {joined(f"CASE WHEN {unique(with_name('names', 2, 'third'))} THEN {with_name('names', 2, 'third')} ELSE names END")}
              AS post FROM s3"""),
        "header_infer": q(INFER, f"SELECT id, CASE WHEN names IS NOT NULL THEN {joined('names')} END AS names, period_agg, use_block FROM inferred"),
        "header_fallback": q(INFER + """,
              parts AS (SELECT o_custkey AS page_num, id AS seq, names AS own, CASE WHEN id % 9 = 0 THEN 7 ELSE 8 END AS width
                FROM inferred),
              named2 AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY page_num ORDER BY seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS names FROM parts),
              errs AS (SELECT *, CASE WHEN names IS NULL THEN 'NO_HEADER' WHEN len(names) <> width THEN 'HEADER_WIDTH'
                WHEN len(list_filter(names, lambda x: x = 'item_agg')) <> 1 THEN 'NO_ITEM_AGG' END AS error FROM named2)""",
              f"""SELECT page_num, seq, error, coalesce(count(error) OVER (PARTITION BY page_num ORDER BY seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS reached,
              CASE WHEN names IS NOT NULL THEN {joined('names')} END AS names FROM errs"""),
        "dup_names": q(NAMES, f"""SELECT id, {joined('list_filter(names, lambda x, i: len(list_filter(names, lambda y: y = x)) > 1 AND list_position(names, x) = i)')}
              AS dup FROM named"""),
        "numeric_names": q(SALES, "SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"""regexp_full_match(trim({c}, {WS}), '\\d{{4}}|[+-]?\\d+([.,]\\d+)?%|[+-]?\\d{{1,3}}(\\.\\d{{3}})*|[+-]?\\d+([.,]\\d+)?') AS {c}"""
            for c in ("price", "discount", "part", "flag")) + " FROM sales"),
        "bad_names": q(DOC_ROWS, """SELECT doc_id, row_idx,
              len(list_filter(names, lambda x: regexp_matches(x, '[^\\p{L}\\p{N}_\\s]'))) AS bad_chars,
              len(list_filter(names, lambda x: regexp_matches(x, '(?i)(^|[^\\p{L}\\p{N}_])(the|de|of|un)([^\\p{L}\\p{N}_]|$)')))
              AS bad_tokens FROM (SELECT *, list_transform(cells, lambda x: x || ['', chr(101) || chr(769), 'm²', '½', 'a‿b', 'é'][row_idx % 6 + 1])
                AS names FROM doc_rows)"""),
        "qc_summary": q(CHECKED, f"""SELECT id AS idx, CAST(page_num AS INTEGER) AS page, CAST(len(n) AS INTEGER) AS n_col, issues <> '' AS is_problem, issues,
              CAST(len(dup) AS INTEGER) AS dup_n, CAST(len(num) AS INTEGER) AS numeric_n,
              CAST(len(bad) AS INTEGER) AS bad_chars_n, CAST(len(tok) AS INTEGER) AS bad_tokens_n,
              {joined('dup[1:3]')} AS dup_cols, {joined('num[1:3]')} AS numeric_cols, {joined('bad[1:3]')} AS bad_chars_cols,
              {joined('tok[1:3]')} AS bad_token_cols FROM issued"""),
        "qc_events": q(CHECKED, " UNION ALL ".join(
            f"""SELECT id, CAST(page_num AS INTEGER) AS page, CAST(len(n) AS INTEGER) AS n_col, '{text}: ' || {quoted(col)} AS e_des FROM issued WHERE len({col}) > 0"""
            for col, text in (("dup", "DUPLICATE_COLS"), ("num", "NUMERIC_COLNAMES"), ("bad", "BAD_CHARS_IN_COLNAMES"),
                              ("tok", "BAD_TOKENS_IN_COLNAMES")))),
        "quarantine": q(CHECKED, """SELECT l_orderkey AS id, l_linenumber, l_quantity,
              EXISTS (SELECT 1 FROM issued i WHERE i.id = l_orderkey AND i.issues <> '') AS quarantined FROM lineitem"""),
        "union_widen": q(SALES + ", " + PERIODS, """SELECT l_orderkey AS key, price, flag, NULL::VARCHAR AS period_agg, NULL::VARCHAR AS tax FROM sales
              UNION ALL SELECT o_orderkey, NULL, NULL, period_agg, NULL FROM labels
              UNION ALL SELECT l_orderkey, NULL, flag, NULL, tax FROM sales"""),
        "row_ordinal": """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS ordinal FROM orders""",
        "column_profile": q(LONG, "SELECT name, n_values, n_percent, n_digit, lost_percent, lost_number FROM prof WHERE n_values > 0"),
        "smart_percent": q(CLEAN, f"SELECT l_orderkey, l_linenumber, price, {pct('discount')} AS discount, tax, part, flag, blank FROM clean"),
        "smart_numeric": q(CLEAN, f"SELECT l_orderkey, l_linenumber, {eu_number('price')} AS price, discount, tax, part, flag, blank FROM clean"),
        "lost_values": q(LONG, """SELECT name AS "column", index, text AS or_val FROM parsed
              WHERE text IS NOT NULL AND p IS NULL AND name IN (SELECT name FROM kinds WHERE is_pct)"""),
        "period_start": q(PERIODS + """,
              firsts AS (SELECT o_custkey, period_agg, min(o_orderkey) AS f, min(start) AS start FROM starts GROUP BY 1, 2),
              dated AS (SELECT *, coalesce(last_value(start IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY f
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), DATE '2026-03-01') AS period_start FROM firsts)""",
              """SELECT l.o_orderkey, l.period_agg, d.period_start FROM labels l JOIN dated d
              ON d.o_custkey = l.o_custkey AND d.period_agg IS NOT DISTINCT FROM l.period_agg"""),
        "period_desc": q(PERIODS, f"""SELECT o_orderkey, CASE WHEN trim(lower(period_agg), {WS}) IN (SELECT name FROM months)
              THEN 'MONTH' ELSE period_agg END AS period_desc FROM labels"""),
        "chapter_lookup": q(CHAPTER, """SELECT p_partkey, p_size + 28 AS page_num, c.capitolo, c.sottocapitolo
              FROM part LEFT JOIN chapter c ON c.page_num = p_size + 28"""),
        "chapter_ranges": """SELECT o_orderkey, o_orderkey AS page_num,
              CASE WHEN o_orderkey BETWEEN 400000 AND 999999995 OR o_orderkey BETWEEN 100 AND 20000 OR o_orderkey = 7 THEN 'odd'
                WHEN o_orderkey BETWEEN 0 AND 1000000000 THEN 'all' END AS capitolo,
              CASE WHEN o_orderkey BETWEEN 400000 AND 999999995 THEN 'far' WHEN o_orderkey BETWEEN 3000 AND 20000 THEN 'mid'
                WHEN o_orderkey = 7 THEN 'one' WHEN o_orderkey BETWEEN 100 AND 4999 THEN 'low'
                WHEN o_orderkey BETWEEN 0 AND 1000000000 THEN 'all' END AS sottocapitolo FROM orders""",
        "merged_profile": q(LONG, """SELECT name, n_values, n_percent, n_digit, lost_percent, lost_number,
              (SELECT count(*) FROM lineitem) AS n_rows FROM prof WHERE n_values > 0"""),
        "table_replace": q(SALES, """SELECT l_orderkey, l_linenumber, part FROM sales s
              WHERE NOT (l_orderkey % 5 = 0 AND EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = s.l_orderkey AND x.l_linenumber > 1))
              UNION ALL SELECT l_orderkey, l_linenumber, 'again' FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber > 1"""),
        "report_facts": q(FACTS, FACT_SELECT),
        "report_from_cells": q(FACTS, FACT_SELECT),
        "smart_percent_by_doc": q(SPOILED, f"""SELECT l_orderkey, l_linenumber, s.doc, CASE WHEN is_pct THEN {pct('discount')} END AS discount,
              CASE WHEN NOT coalesce(is_pct, false) THEN discount END AS discount_text FROM spoiled s LEFT JOIN by_doc d ON d.doc = s.doc"""),
        "smart_numeric_by_doc": q(SPOILED, f"""SELECT l_orderkey, l_linenumber, s.doc, CASE WHEN is_num THEN {eu_number('price')} END AS price,
              CASE WHEN NOT coalesce(is_num, false) THEN price END AS price_text FROM spoiled s LEFT JOIN by_doc d ON d.doc = s.doc"""),
        "losses_by_doc": q(SPOILED, """SELECT doc, 'discount' AS name, CASE WHEN is_pct THEN 'percent' WHEN d_num THEN 'number' ELSE 'text' END AS kind,
                CASE WHEN is_pct THEN d_lost_p WHEN d_num THEN d_lost_n ELSE 0 END AS lost FROM by_doc WHERE d_values > 0
              UNION ALL SELECT doc, 'price', CASE WHEN p_pct THEN 'percent' WHEN is_num THEN 'number' ELSE 'text' END,
                CASE WHEN p_pct THEN p_lost_p WHEN is_num THEN p_lost_n ELSE 0 END FROM by_doc WHERE p_values > 0"""),
        "table_sink": q(SALES, "SELECT * FROM sales"),
        "file_sink": q(SALES, """SELECT l_orderkey, l_linenumber, part, tax, CAST(k AS INTEGER) AS sink FROM sales, range(3) AS u(k)"""),
        "quarantine_sink": q(PARTS, """SELECT doc_id, CAST(doc_id % 80 AS INTEGER) AS page_num, count(*) AS parts,
              CAST(sum(n_data) AS BIGINT) AS n_rows, CAST(sum(n_data) * 8 AS BIGINT) AS n_cells FROM part_list
              WHERE fault = 10 AND side = 1 AND n_data > 0 GROUP BY doc_id"""),
        "quarantine_manifest": q(PARTS, """SELECT doc_id, CAST(doc_id % 80 AS INTEGER) AS page_num, 1 AS part_idx,
              CAST(n_data * 8 AS BIGINT) AS n_cells, CAST(first_data AS INTEGER) AS first_row,
              CAST(first_data + n_data - 1 AS INTEGER) AS last_row FROM part_list WHERE fault = 10 AND side = 1 AND n_data > 0"""),
        "written_report": q(FACTS + ", " + ERRORS + """,
              n AS (SELECT 'facts' AS output, (SELECT count(*) FROM shown) AS n UNION ALL
                SELECT 'qc_summary', (SELECT sum(CASE WHEN c_custkey % 20 IN (6, 12) THEN 0 WHEN c_custkey % 20 = 8 THEN 1 ELSE 2 END)
                  FROM customer)::BIGINT UNION ALL
                SELECT 'errors', (SELECT count(*) FROM errs WHERE e_des IS NOT NULL) UNION ALL
                SELECT 'quarantine', (SELECT count(*) FROM customer WHERE c_custkey % 20 = 10))""",
              "SELECT output, n AS forecast, n AS written, true AS agrees FROM n"),
        "report_errors": q(ERRORS, "SELECT * FROM errs WHERE e_des IS NOT NULL"),
        "errors_from_cells": q(ERRORS, "SELECT * FROM errs WHERE e_des IS NOT NULL"),
        "report_parts": q(PARTS, f"""SELECT doc_id, table_id, part_id, CAST(parent_id AS INTEGER) AS parent_id,
              CAST(first_data AS INTEGER) AS first_data, CAST(n_data AS INTEGER) AS n_data,
              page_subtitle_1, CASE WHEN len(names) > 0 THEN period END AS period_agg, {joined('names')} AS names,
              CASE WHEN fault = 6 AND side = 0 THEN 'NO_HEADER' WHEN fault = 8 AND side = 1 THEN 'NO_ITEM_AGG' END AS error,
              NOT (fault = 6 OR fault = 8 AND side = 1) AS emitted, fault IN (8, 10) AND side = 1 AS is_problem FROM part_list"""),
        "refined_parts": q(PARTS + f""",
              texts AS (SELECT *, row_number() OVER (PARTITION BY doc_id, side ORDER BY line) - 1 AS at,
                CASE WHEN a25 IS NULL THEN [label, '', '', '', '', '', '', ''] ELSE
                [label, {eu('a25')}, {eu('a24')}, {eu('(a25 + a24)')}, {eu('(a25 - a24)')},
                 CASE WHEN fault = 2 AND line = 1 THEN 'n.a.%' ELSE (a25 % 97 - 48) || '%' END,
                 CASE WHEN fault = 18 THEN 'n.s.' ELSE {eu('(-a24)')} END, (a24 % 89) || '%'] END AS plain FROM labelled),
              cells AS (SELECT t.doc_id, t.at + p.first_data AS row_idx, p.table_id, p.part_id, t.grp AS item_agg_1, p.names,
                CASE WHEN t.fault = 16 AND t.side = 1 THEN list_concat(list_concat([label, CASE WHEN line % 2 = 0 THEN 'HI' ELSE 'LO' END],
                  plain[2:2]), plain[4:8]) ELSE plain END AS v
                FROM texts t JOIN part_list p ON p.doc_id = t.doc_id AND p.side = t.side
                WHERE NOT (t.fault = 6 OR t.fault = 8 AND t.side = 1))""",
              "SELECT doc_id, CAST(row_idx AS INTEGER) AS row_idx, table_id, part_id, item_agg_1, unnest(names) AS name, unnest(v[1:len(names)]) AS value FROM cells"),
        "report_lost_values": q(FACTS, """SELECT doc_id, 'pct_vs_act' AS "column", ord AS index, 'n.a.%' AS or_val
              FROM shown WHERE fault = 2 AND line = 1"""),
        "run_report": q(FACTS + ", " + ERRORS, """SELECT (SELECT count(*) FROM shown) AS facts_rows, 24 AS facts_columns,
              (SELECT sum(CASE WHEN c_custkey % 20 IN (6, 12) THEN 0 WHEN c_custkey % 20 = 8 THEN 1 ELSE 2 END)
                FROM customer)::BIGINT AS qc_summary_rows,
              (SELECT count(*) FROM customer WHERE c_custkey % 20 = 10) AS quarantine_parts,
              (SELECT count(*) FROM errs WHERE e_des IS NOT NULL) AS errors_rows"""),
    }
    return out
