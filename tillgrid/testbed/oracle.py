"""The same queries as plain SQL over the driver's tables, for comparison with the Spark results."""

from __future__ import annotations


def money(cents: str) -> str:
    return (
        f"((CASE WHEN {cents} < 0 THEN '-' ELSE '' END) || (abs({cents}) // 100)::VARCHAR || '.' || "
        f"lpad((abs({cents}) % 100)::VARCHAR, 2, '0'))"
    )


def store_name(s: str) -> str:
    return (
        f"(CASE {s} % 4 WHEN 0 THEN 'Store ' || {s} || ' – Mall' WHEN 1 THEN 'Parade''s Store ' || {s} "
        f"WHEN 2 THEN 'Store/ ' || {s} || ' [North]' ELSE 'STORE - ' || {s} END)"
    )


def sanitized(name: str) -> str:
    marks = f"regexp_replace({name}, '[\\\\/*?:\"<>|]', '_', 'g')"
    return f"coalesce(nullif(trim(regexp_replace({marks}, '[\\s_]+', '_', 'g'), '_'), ''), 'unknown_location')"


def hub_name(c: str) -> str:
    return (
        f"(CASE {c} % 5 WHEN 0 THEN 'Hub ' || {c} WHEN 1 THEN 'Hub [' || {c} || '] East' "
        f"WHEN 2 THEN 'HUB''S - ' || {c} WHEN 3 THEN 'Shop ' || {c} || ' ' ELSE 'hub ' || {c} || '-x' END)"
    )


def portal_name(c: str) -> str:
    return (
        f"(CASE WHEN {c} % 11 = 0 THEN 'Annex ' || ({c} // 100) WHEN {c} % 5 = 0 THEN 'Hub ' || {c} "
        f"WHEN {c} % 5 = 1 THEN 'hub ' || {c} || ' east' WHEN {c} % 5 = 2 THEN 'Hub''s-' || {c} "
        f"WHEN {c} % 5 = 3 THEN ' Shop ' || {c} WHEN {c} % 3 = 0 THEN 'Depot ' || {c} ELSE 'HUB ' || {c} || ' X' END)"
    )


def norm_a(name: str) -> str:
    return f"replace(replace(replace(lower({name}), '''', ''), '-', ''), ' ', '')"


def norm_b(name: str) -> str:
    return f"lower(regexp_replace({name}, '[\\s\\-''\\[\\]]', '', 'g'))"


def number(text: str) -> str:
    return (
        f"(CASE WHEN regexp_full_match({text}, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*') "
        f"THEN try_cast(trim({text}) AS DOUBLE) END)"
    )


def to_int(text: str) -> str:
    return f"coalesce(trunc({number(text)})::BIGINT, 0)"


def to_money(text: str) -> str:
    digits = f"regexp_replace({text}, '[^0-9.\\-]', '', 'g')"
    return f"round_even(coalesce({number(digits)}, 0.0), 2)"


def new_date(text: str) -> str:
    return f"coalesce(strftime(try_strptime({text}, '%d/%m/%Y'), '%d-%b-%Y'), {text})"


def present(cell: str) -> str:
    return f"nullif({cell}, '')"


# ---- reports ---------------------------------------------------------------------------------

_ITEMS = """
items AS (
  SELECT 'loc' || s || '-' || (p // 10000) AS file_id, t.*,
         coalesce(p_name, '?') || (CASE WHEN p % 9 = 0 THEN ', "XL"' ELSE '' END) AS name
  FROM (
    SELECT l_suppkey AS s, l_partkey AS p, sum(l_quantity::BIGINT)::BIGINT AS qty,
           sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS gross,
           (sum(round(l_extendedprice * 100)::BIGINT * round(l_discount * 100)::BIGINT)::BIGINT // 100) AS disc,
           max(l_shipdate)::DATE AS last_day
    FROM lineitem GROUP BY ALL
  ) t LEFT JOIN part ON p_partkey = p
)"""


def _pad(*cells: str) -> str:
    return "[" + ", ".join([*cells, *["''"] * (13 - len(cells))]) + "]"


_NET = money("((gross - disc) * 100 // 105)")
_AFTER = money("(gross - disc)")
_ITEM = _pad(
    "name", "p::VARCHAR", "'1'", "'1'",
    "CASE WHEN p % 7 = 0 THEN qty || '.9' WHEN p % 23 = 0 THEN '1,234' ELSE qty::VARCHAR END", "'0'",
    money("(gross * 100 // 105)"), money("(-(disc // 21))"),
    f"CASE WHEN p % 6 = 1 THEN 'AED ' || {_NET} ELSE {_NET} END", money("gross"),
    f"CASE WHEN p % 6 = 2 THEN '(' || {money('disc')} || ')' WHEN p % 6 = 3 THEN '' ELSE {money('(-disc)')} END",
    f"CASE WHEN p % 6 = 4 THEN {_AFTER} || ' AED' ELSE {_AFTER} END",
    f"CASE s % 4 WHEN 1 THEN 'till ' || (p % 5) WHEN 2 THEN {money('disc')} WHEN 3 THEN 'x' ELSE '' END",
)
_HEADER = _pad(
    "'Menu Item Name'", "CASE WHEN s % 13 = 12 THEN 'Item No' ELSE 'Menu Item #' END", "'Menu Item Def'",
    "'Price Level'", "' Qty Sold '", "'Returns'", "'Net VAT before Disc.'", "'Discounts VAT'", "'Net VAT after Disc.'",
    "'Gross before Disc.'", "'Discounts'", "CASE WHEN s % 5 = 4 THEN 'Gross (old)' ELSE 'Gross after Disc.' END",
    "CASE s % 4 WHEN 1 THEN 'Cashier' WHEN 2 THEN 'Discounts' WHEN 3 THEN '' ELSE 'Unnamed: 12' END",
)
_DAY = "CASE WHEN s % 11 = 3 THEN strftime(last_day, '%Y-%m-%d') ELSE strftime(last_day, '%d/%m/%Y') END"
_TOTALS = _pad("'Totals:'", "''", "'1'", "'1'", "qty::VARCHAR", "'0'", "''", "''", "''", money("gross"),
               money("(-disc)"), money("(gross - disc)"))

GRID = f"""{_ITEMS},
reports AS (
  SELECT file_id, s, max(last_day) AS last_day, sum(qty)::BIGINT AS qty, sum(gross)::BIGINT AS gross, sum(disc)::BIGINT AS disc
  FROM items GROUP BY ALL
),
placed AS (
  SELECT file_id, s, -200 AS place, {_pad("'Business Dates'", "'01/01/1990'")} AS cells FROM reports WHERE s % 11 = 7
  UNION ALL SELECT file_id, s, -199, {_pad("'Business Dates'", _DAY)} FROM reports WHERE s % 11 <> 5
  UNION ALL SELECT file_id, s, -198, {_pad("'Locations'", store_name("s"))} FROM reports
  UNION ALL SELECT file_id, s, -197, {_pad("'Revenue Centers'", store_name("s"))} FROM reports
  UNION ALL SELECT file_id, s, -196, {_pad("'Menu Items'", "'All'")} FROM reports
  UNION ALL SELECT file_id, s, -100 + i, {_pad("'Filter ' || i", "'All'")}
    FROM reports, unnest(range(1, 26)) AS u(i) WHERE i <= (CASE WHEN s % 17 = 16 THEN 25 ELSE s % 3 END)
  UNION ALL SELECT file_id, s, -50, {_pad()} FROM reports
  UNION ALL SELECT file_id, s, -49, {_HEADER} FROM reports
  UNION ALL SELECT file_id, s, -48, {_TOTALS} FROM reports
  UNION ALL SELECT file_id, s, p * 2, {_pad("'-- section ' || p || ' --'", "'Section'")} FROM items WHERE p % 25 = 0
  UNION ALL SELECT file_id, s, p * 2 + 1, {_ITEM} FROM items
),
grid AS (
  SELECT file_id, s, row_number() OVER (PARTITION BY file_id ORDER BY place) - 1 AS row_idx, cells FROM placed
)"""

META = f"""{GRID},
found AS (
  SELECT file_id, any_value(s) AS s,
         min(row_idx) FILTER (WHERE trim(cells[1]) = 'Menu Item Name' AND row_idx < 20) AS hit
  FROM grid GROUP BY file_id
),
dated AS (
  SELECT grid.file_id, max_by(trim(cells[2]), row_idx) AS day
  FROM grid JOIN found USING (file_id)
  WHERE trim(cells[1]) = 'Business Dates' AND row_idx < coalesce(hit, 20) GROUP BY grid.file_id
),
meta AS (
  SELECT found.file_id, found.s, coalesce(hit, 0) AS header_row, coalesce(day, '') AS business_date
  FROM found LEFT JOIN dated USING (file_id)
),
raw_header AS (
  SELECT file_id, generate_subscripts(cells, 1) - 1 AS position, trim(unnest(cells)) AS name
  FROM grid JOIN meta USING (file_id) WHERE row_idx = header_row
),
header AS (
  SELECT file_id, position,
         name || (CASE WHEN nth > 1 THEN '.' || (nth - 1) ELSE '' END) AS name
  FROM (SELECT *, row_number() OVER (PARTITION BY file_id, name ORDER BY position) AS nth FROM raw_header)
  WHERE name <> '' AND NOT starts_with(name, 'Unnamed:')
)"""


def _place(name: str) -> str:
    return f"max(position) FILTER (WHERE name = '{name}') + 1"


def _cell(place: str) -> str:
    return present(f"cells[{place}]")


# Item rows of all reports: cells by the position of their column in the report's own header.
ITEM_ROWS = f"""{META},
places AS (
  SELECT file_id, {_place('Menu Item #')} AS k, {_place('Menu Item Name')} AS n, {_place('Qty Sold')} AS q,
         {_place('Discounts')} AS d, {_place('Net VAT after Disc.')} AS x, {_place('Gross after Disc.')} AS g,
         {_place('Cashier')} AS cashier, {_place('Discounts.1')} AS discounts_1, {_place('Gross (old)')} AS gross_old
  FROM header GROUP BY file_id
),
body AS (
  SELECT grid.file_id, meta.s, row_idx, cells, places.*, business_date
  FROM grid JOIN meta USING (file_id) JOIN places USING (file_id) WHERE row_idx > header_row
),
item_rows AS (SELECT * FROM body WHERE {number("cells[k]")} IS NOT NULL)"""

MAPPED = f"""
{to_int(_cell('k'))} AS "POS Item ID *", {_cell('n')} AS "POS Item Name", {to_int(_cell('q'))} AS "Sold QTY *",
{to_money(_cell('d'))} AS "Total Discount Value", {to_money(_cell('x'))} AS "Total sales excl. tax *",
CASE WHEN g IS NOT NULL THEN {to_money(_cell('g'))} END AS "Total sales incl. tax *\""""
INJECTED = f"""{new_date('business_date')} AS "Sales Date *", '' AS "Order ID", '' AS "Sales Type Code\""""
ITEM_SALES = f"WITH {ITEM_ROWS} SELECT file_id, row_idx, {INJECTED}, {MAPPED} FROM item_rows"


def business_day(file_name: str) -> str:
    """ISO date, else the raw text; a report without a date has a day of its own, named by its file."""
    return (
        "coalesce(strftime(try_strptime(business_date, '%d/%m/%Y'), '%Y-%m-%d'), nullif(business_date, ''), "
        f"'undated_' || {sanitized(file_name)})"
    )


RAW_NAME = f"('20260416T102300_' || substr(md5(file_id), 1, 8) || '_' || {sanitized(store_name('s'))} || '_raw.csv')"
PLACE_NAME = f"({store_name('s')} || ' menu ' || regexp_extract(file_id, '-([0-9]+)$', 1))"
INGEST_NAME = f"('20260416T102300_a1b2c3d4_' || {sanitized(PLACE_NAME)} || '_raw.csv')"

KNOWN_RAW = [
    "Menu Item Name", "Menu Item #", "Qty Sold", "Discounts", "Net VAT after Disc.", "Gross after Disc.",
    "Menu Item Def", "Price Level", "Returns", "Net VAT before Disc.", "Discounts VAT", "Gross before Disc.",
]
_KNOWN_SQL = ", ".join(f"('{n}')" for n in KNOWN_RAW)
_LABEL_SQL = (
    "(CASE s_suppkey % 17 WHEN 3 THEN 'N/A' WHEN 5 THEN 'LOCATION CLOSED ' WHEN 7 THEN 'Location Name not mentioned yet' "
    "WHEN 9 THEN '  ' WHEN 11 THEN 'no sales for now' WHEN 13 THEN 'Not in use' "
    "ELSE 'Label: ' || s_suppkey || ' / ' || s_name END)"
)
DIM = f"dim AS (SELECT s_suppkey AS ordinal, {store_name('s_suppkey')} AS pos_name, {_LABEL_SQL} AS label FROM supplier)"
ACTIVE = f"""{DIM},
active AS (
  SELECT * FROM dim WHERE trim(label) <> ''
  AND lower(trim(label)) NOT IN ('n/a', 'not in use', 'location closed', 'no sales for now')
  AND NOT starts_with(lower(trim(label)), 'location name not mentioned')
)"""
CODES = f"""codes AS (
  SELECT c_custkey AS ordinal, 'C' || c_custkey AS code, c_name || ' - ' || c_mktsegment AS label,
         {hub_name('c_custkey')} AS pos_name FROM customer
)"""
WORKPLACES = f"""listed AS (SELECT c_custkey AS seq, {portal_name('c_custkey')} AS name, c_custkey AS id FROM customer),
workplaces AS (
  SELECT trim(name) AS name, max_by(id, seq) AS id, min(seq) AS first_seq FROM listed GROUP BY trim(name)
),
by_norm AS (SELECT {norm_b('name')} AS norm, min_by(id, first_seq) AS id FROM workplaces GROUP BY 1)"""
REQUESTS = f"""requests AS (
  SELECT o_orderkey, CASE o_orderkey % 7 WHEN 4 THEN upper(name) WHEN 5 THEN replace(name, ' ', '  ')
         WHEN 6 THEN 'Unknown ' || (o_custkey % 10) ELSE name END AS pos_name
  FROM (SELECT o_orderkey, o_custkey, {hub_name('o_custkey')} AS name FROM orders)
)"""
RESOLVED = f"""{REQUESTS}, {WORKPLACES},
resolved AS (
  SELECT o_orderkey, pos_name, coalesce(w.id, b.id) AS workplace_id,
         CASE WHEN w.id IS NOT NULL THEN 'exact' WHEN b.id IS NOT NULL THEN 'normalised' END AS matched_by
  FROM requests LEFT JOIN workplaces w ON w.name = pos_name LEFT JOIN by_norm b ON b.norm = {norm_b('pos_name')}
)"""
OPTIONS = f"""{REQUESTS},
options AS (SELECT c_custkey AS ordinal, trim({portal_name('c_custkey')}) AS option FROM customer),
o0 AS (SELECT option AS k, min_by(option, ordinal) AS option FROM options GROUP BY 1),
o1 AS (SELECT lower(option) AS k, min_by(option, ordinal) AS option FROM options GROUP BY 1),
o2 AS (SELECT {norm_a('option')} AS k, min_by(option, ordinal) AS option FROM options GROUP BY 1),
matched AS (
  SELECT o_orderkey, pos_name, coalesce(o0.option, o1.option, o2.option) AS option,
         CASE WHEN o0.k IS NOT NULL THEN 'exact' WHEN o1.k IS NOT NULL THEN 'case' WHEN o2.k IS NOT NULL THEN 'normalised' END AS matched_by
  FROM requests LEFT JOIN o0 ON o0.k = pos_name LEFT JOIN o1 ON o1.k = lower(pos_name)
  LEFT JOIN o2 ON o2.k = {norm_a('pos_name')}
)"""
CODE_REQUESTS = """code_requests AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN 'X' || o_custkey ELSE 'C' || (o_custkey // 10) END AS code,
         (DATE '2024-01-01' + (o_orderkey % 30)::INT)::DATE AS report_date FROM orders
)"""

# ---- KPI -------------------------------------------------------------------------------------

_EVENT_CATEGORIES = {"click": "juice", "view": "coffee", "purchase": "sandwich", "signup": "breakfast"}
CATEGORIES = [
    "juice", "sandwich", "shake", "coffee", "loyalty_card", "breakfast", "salad", "counter_product", "topping", "misc",
]
_CENTS = "round(value * 100)::BIGINT"
KPI = f"""daily AS (
  SELECT user_id AS workplace_id, ts::DATE AS report_date, sum({_CENTS})::BIGINT AS cents, count(*) AS n, max(value) AS top,
  {", ".join(f"coalesce(sum({_CENTS}) FILTER (WHERE event_type = '{e}'), 0)::BIGINT AS cents_{e}, count(*) FILTER (WHERE event_type = '{e}') AS n_{e}" for e in [*_EVENT_CATEGORIES, 'error'])}
  FROM events GROUP BY 1, 2
),
kpi AS (
  SELECT *, (k % 29 = 0 OR k % 31 = 0 OR k % 37 = 0) AS is_empty
  FROM (SELECT *, workplace_id + day(report_date) AS k FROM daily)
)"""


def _category_columns() -> str:
    events = {c: e for e, c in _EVENT_CATEGORIES.items()}
    out = []
    for c in CATEGORIES:
        e, title = events.get(c), c.replace("_", " ").title()
        figures = (
            [f"cents_{e} / 100", f"n_{e}::DOUBLE", f"CASE WHEN n_{e} > 0 THEN cents_{e} * 100 / cents ELSE 0 END", f"n_{e} * 100 / n"]
            if e else ["0"] * 4
        )
        for name, value in zip(("Turnover", "Products", "TO %", "Prod %"), figures):
            out.append(f'({value})::DOUBLE AS "{title} {name}"')
    return ", ".join(out)


def _discount_columns() -> str:
    out = ['n_error::DOUBLE AS "Disc Neighbour Products"', '(n_error * 100 / n)::DOUBLE AS "Disc Neighbour %"']
    for label in ("Disc Employee", "Disc Loyalty", "Disc Emp Meal"):
        out += [f'0::DOUBLE AS "{label} Products"', f'0::DOUBLE AS "{label} %"']
    return ", ".join(out)


_KPI_BASE = """(cents / 100)::DOUBLE AS "Turnover", n::DOUBLE AS "Products", 0::DOUBLE AS "Employees",
top::DOUBLE AS "PHP Max", (cents / (n * 100))::DOUBLE AS "Avg Turnover", 0::DOUBLE AS "Avg Products\""""
_KPI_MEAL = """(CASE WHEN n_error > 1 THEN n_error ELSE 0 END)::DOUBLE AS "Emp Meal Products",
(CASE WHEN n_error > 1 THEN n_error * 100 / n ELSE 0 END)::DOUBLE AS "Emp Meal %\""""
KPI_CODES = f"""{CODES}, {WORKPLACES},
known AS (
  SELECT codes.*, coalesce(w.id, b.id) AS workplace_id FROM codes
  LEFT JOIN workplaces w ON w.name = pos_name LEFT JOIN by_norm b ON b.norm = {norm_b('pos_name')}
)"""
KPI_ROWS = f"WITH {KPI}, {KPI_CODES} SELECT {{columns}} FROM kpi JOIN known USING (workplace_id) WHERE NOT is_empty"
_KPI_KEYS = 'report_date::VARCHAR AS "Date", code AS "Code", label AS "Location", pos_name AS "POS Name"'
KPI_WIDE = KPI_ROWS.format(columns=f"{_KPI_KEYS}, {_KPI_BASE}, {_category_columns()}, {_discount_columns()}, {_KPI_MEAL}")
KPI_STATUS = f"""{KPI}, {KPI_CODES}, {CODE_REQUESTS},
kpi_status AS (
  SELECT r.o_orderkey, r.code, r.report_date::VARCHAR AS report_date, known.workplace_id,
         known.workplace_id IS NOT NULL AND kpi.workplace_id IS NOT NULL AS ok,
         CASE WHEN known.code IS NULL THEN 'unknown code' WHEN known.workplace_id IS NULL THEN 'workplace not found'
              WHEN kpi.workplace_id IS NULL THEN 'empty report' ELSE '' END AS reason
  FROM code_requests r LEFT JOIN known ON known.code = r.code
  LEFT JOIN kpi ON kpi.workplace_id = known.workplace_id AND kpi.report_date = r.report_date AND NOT is_empty
)"""

# ---- runs ------------------------------------------------------------------------------------

RESULTS = """results AS (
  SELECT o_orderkey AS ordinal, 'Store ' || o_custkey AS pos_name,
         CASE WHEN o_custkey % 10 = 0 THEN 'A label that is longer than the forty-five characters shown ' || o_custkey
              ELSE 'Label ' || (o_custkey % 97) END AS label,
         o_orderstatus = 'F' AS ok, o_orderstatus = 'O' AS no_data,
         (CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 2 ELSE 2 + o_orderkey % 3 END)::INT AS stage,
         CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'No data for Store ' || o_custkey
              ELSE 'Report did not finish rendering for Store ' || o_custkey || ' with priority ' || o_orderpriority END AS error,
         CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice)::BIGINT ELSE 0 END AS row_count,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d-%b-%Y') ELSE '' END AS business_date,
         CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'no_data' ELSE 'failed' END AS status
  FROM orders
)"""
COUNTS = """counts AS (
  SELECT count(*) FILTER (WHERE status = 'ok') AS succeeded, count(*) FILTER (WHERE status = 'no_data') AS no_data,
         count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total, coalesce(bool_or(ok), false) AS success,
         coalesce(min_by(business_date, ordinal) FILTER (WHERE business_date <> ''), '') AS report_date
  FROM results
)"""
_STATUS_TEXT = """CASE WHEN ok THEN '✅  ' || format('{:,}', row_count) || ' rows' WHEN no_data THEN '–  no data'
ELSE '❌  ' || substr(error, 1, 40) END"""
LANDED = f"""landed AS (
  SELECT o_orderkey AS file_id, o_orderdate AS modified_at,
    CASE WHEN o_orderkey % 50 = 0 THEN 'notes ' || o_orderkey || '.txt' ELSE
      strftime(o_orderdate, '%Y%m%dT%H%M%S') || '_' || substr(md5(o_orderkey::VARCHAR), 1, 8)
      || (CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE '_' || {sanitized(store_name('o_custkey'))} END) || '_raw.'
      || (CASE o_orderkey % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'XLSX' ELSE 'xlsx' END) END AS file_name,
    CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE floor(o_totalprice)::BIGINT END AS length
  FROM orders
)"""
_RAW = "^(\\d{8}T\\d{6}_[0-9a-f]{8})_?(.*)_raw\\.(\\w+)$"
PROVENANCE = f"""{LANDED},
provenance AS (
  SELECT *, nullif(regexp_extract(file_name, '{_RAW}', 1), '') AS run_id,
         nullif(regexp_extract(file_name, '{_RAW}', 2), '') AS location_tag,
         lower(regexp_extract(file_name, '\\.(\\w+)$', 1)) AS suffix FROM landed
)"""


def _ending(key: str) -> str:
    return (
        f"(CASE {key} % 9 WHEN 0 THEN chr(10) || 'Showing 10 rows' WHEN 1 THEN chr(10) || 'found 0 Rows' "
        f"WHEN 2 THEN chr(10) || 'There is NO DATA' ELSE '' END)"
    )


_NO_DATA = "no data|no rows|\\b0 rows|there is no data"
_NO_DATA_LOOSE = "no data|no rows|0 rows|there is no data"
_LAND = f"SELECT file_id, row_idx, len(cells) AS n_cells, array_to_string(cells, '|') AS line FROM grid"


def _report_subject(label: str, day: str) -> str:
    return f"'POS Sales Report — ' || {label} || ' — ' || {day}"


STATUS_ROWS = f"""{ITEM_ROWS},
keyless AS (SELECT file_id FROM meta WHERE file_id NOT IN (SELECT file_id FROM header WHERE name = 'Menu Item #')),
counted AS (SELECT file_id, count(*) AS n FROM item_rows GROUP BY file_id),
statuses AS (
  SELECT {PLACE_NAME} AS pos_name, 'Label ' || file_id AS label, file_id NOT IN (FROM keyless) AS ok, false AS no_data,
         CASE WHEN file_id IN (FROM keyless) THEN 3 ELSE 4 END AS stage,
         CASE WHEN file_id IN (FROM keyless) THEN 'missing column: Menu Item #' ELSE '' END AS error, coalesce(n, 0)::BIGINT AS row_count,
         CASE WHEN n IS NULL THEN '' ELSE business_date END AS business_date,
         CASE WHEN file_id IN (FROM keyless) THEN 'failed' ELSE 'ok' END AS status,
         s * 1000000 + regexp_extract(file_id, '-([0-9]+)$', 1)::BIGINT AS ordinal
  FROM meta LEFT JOIN counted USING (file_id) WHERE s % 17 NOT IN (3, 5, 7, 9, 11, 13)
)"""

SQL: dict[str, str] = {
    # sources and sinks
    "src_csv_grid": f"WITH {GRID} {_LAND}",
    "src_csv_split": f"WITH {GRID} {_LAND}",
    "src_xlsx_grid": f"WITH {GRID} SELECT file_id, row_idx, rtrim(array_to_string(cells, '|'), '|') AS line FROM grid",
    "dim_location": f"WITH {DIM} SELECT * FROM dim",
    "dim_code": f"WITH {CODES} SELECT * FROM codes",
    "kpi_extract": f"""WITH {KPI} SELECT workplace_id, report_date::VARCHAR AS report_date, NOT is_empty AS has_entry,
        CASE WHEN NOT is_empty THEN cents / 100 END AS turnover FROM kpi""",
    "workplace_pages": f"""WITH {WORKPLACES} SELECT seq, name, id,
        (count(*) OVER (PARTITION BY seq // 500))::INT AS entries FROM listed""",
    "pages_complete": f"""WITH {WORKPLACES} SELECT count(DISTINCT seq // 500) AS pages, count(*) AS entries,
        count(*) % 500 <> 0 AS complete FROM listed""",
    "page_gaps": """WITH listed AS (SELECT c_custkey // 10 AS p, count(*) AS entries FROM customer GROUP BY 1),
        placed AS (SELECT p + 2 + p // 5 + 3 * (p // 11) AS page, entries, p % 13 = 5 AS twice FROM listed),
        ordered AS (SELECT *, lag(page, 1, -1) OVER (ORDER BY page) AS before, max(page) OVER () AS last FROM placed)
        SELECT 'missing' AS kind, before + 1 AS first_page, page - 1 AS last_page FROM ordered WHERE page - before > 1
        UNION ALL SELECT 'double', page, page FROM ordered WHERE twice
        UNION ALL SELECT 'short', page, page FROM ordered WHERE entries < 10 AND page <> last""",
    "kpi_rejects": f"""WITH {KPI} SELECT workplace_id, report_date::VARCHAR AS report_date,
        CASE WHEN k % 29 = 0 THEN 'no_data' WHEN k % 31 = 0 THEN 'failed' WHEN k % 37 = 0 THEN 'no_data' ELSE 'failed' END AS outcome,
        CASE WHEN k % 29 = 0 THEN 'empty report' WHEN k % 31 = 0 THEN 'malformed payload' WHEN k % 37 = 0 THEN 'empty report' ELSE 'malformed payload' END AS reason
        FROM kpi WHERE is_empty OR k % 11 = 0""",
    "latest_file": f"""WITH {PROVENANCE} SELECT location_tag, suffix,
        max_by(file_id, (modified_at, file_name)) AS file_id FROM provenance
        WHERE location_tag IS NOT NULL GROUP BY 1, 2""",
    "empty_files": f"""WITH {LANDED} SELECT file_name FROM landed WHERE length = 0""",
    "file_provenance": f"WITH {PROVENANCE} SELECT file_id, file_name, run_id, location_tag, suffix FROM provenance",
    "sink_report": f"""WITH {ITEM_ROWS}, {ACTIVE},
        located AS (SELECT * FROM item_rows JOIN active ON ordinal = item_rows.s)
        SELECT file_id, row_idx, {INJECTED}, {MAPPED}, {business_day(RAW_NAME)} AS business_day,
        {sanitized('label')} AS location_key FROM located""",
    "report_slice": f"""WITH {ITEM_ROWS}, {ACTIVE},
        located AS (SELECT *, {business_day(RAW_NAME)} AS business_day FROM item_rows JOIN active ON ordinal = item_rows.s)
        SELECT file_id, row_idx, business_day, {sanitized('label')} AS location_key FROM located
        WHERE ordinal % 3 = 0 AND business_day >= '1998-08-01' AND business_day < '1998-12-01'""",
    "sink_kpi": KPI_WIDE,
    "audit_rows": f"""WITH {ITEM_ROWS},
        keyless AS (SELECT file_id FROM meta WHERE file_id NOT IN (SELECT file_id FROM header WHERE name = 'Menu Item #'))
        SELECT meta.file_id AS file, 'transform' AS stage, 'export' AS step, 'run-1' AS run_id, 0::BIGINT AS duration_ms,
        'all' AS location, CASE WHEN meta.file_id IN (FROM keyless) THEN 'error' ELSE 'ok' END AS outcome,
        count(item_rows.row_idx) AS rows, '2026-04-16T10:23:00.000000' AS ts
        FROM meta LEFT JOIN item_rows ON item_rows.file_id = meta.file_id GROUP BY ALL""",
    "ingest_incremental": f"""WITH {ITEM_ROWS}
        SELECT file_id, row_idx, {INJECTED}, {MAPPED}, {business_day(INGEST_NAME)} AS business_day,
        {sanitized("('Label ' || file_id)")} AS location_key
        FROM item_rows WHERE s % 17 NOT IN (3, 5, 7, 9, 11, 13)""",
    "ingest_outcomes": f"""WITH {META}, keyless AS (SELECT file_id FROM meta WHERE file_id NOT IN (SELECT file_id FROM header WHERE name = 'Menu Item #'))
        SELECT file_id, business_date,
        CASE WHEN file_id IN (FROM keyless) THEN 'failed' WHEN s % 17 IN (3, 5, 7, 9, 11, 13) THEN 'unmatched' ELSE 'accepted' END AS outcome,
        CASE WHEN file_id IN (FROM keyless) THEN 'missing column: Menu Item #' ELSE '' END AS error FROM meta""",
    "sales_status": f"""WITH {STATUS_ROWS} SELECT * EXCLUDE (status, ordinal) FROM statuses""",
    "sales_digest": f"""WITH {STATUS_ROWS}, counts AS (
        SELECT count(*) FILTER (WHERE status = 'ok') AS succeeded, count(*) FILTER (WHERE status = 'no_data') AS no_data,
               count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total FROM statuses),
        first_date AS (SELECT coalesce(min_by(business_date, ordinal) FILTER (WHERE business_date <> ''), '') AS report_date FROM statuses)
        SELECT unnest(['Daily Run Summary — ' || report_date, 'Run ID: run-1', '', '  ✅  Succeeded : ' || succeeded,
        '  –   No data   : ' || no_data, '  ❌  Failed    : ' || failed, '  Total         : ' || total, '', repeat('─', 60),
        rpad('Location', 45, ' ') || '   Rows  Status', repeat('─', 60)]) AS line FROM counts, first_date
        UNION ALL SELECT rpad(substr(label, 1, 45), 45, ' ') || '  ' || {_STATUS_TEXT} FROM statuses""",
    "sales_audit": f"""WITH {ITEM_ROWS}, keyless AS (SELECT file_id FROM meta WHERE file_id NOT IN (SELECT file_id FROM header WHERE name = 'Menu Item #'))
        SELECT 'transform' AS stage, 'take_up' AS step, (SELECT count(*) FROM meta)::BIGINT AS files, (SELECT count(*) FROM item_rows)::BIGINT AS rows,
        0::BIGINT AS rejects, (SELECT count(*) FROM keyless)::BIGINT AS failed""",
    # projections and filters
    "header_clean": f"WITH {META} SELECT file_id, position, name FROM header",
    "strip_totals": f"WITH {ITEM_ROWS} SELECT file_id, row_idx, cells[k] AS item FROM body WHERE {_cell('k')} IS NOT NULL",
    "strip_subheaders": f"WITH {ITEM_ROWS} SELECT file_id, row_idx, cells[k] AS item FROM item_rows",
    "row_ordinal": f"""WITH {ITEM_ROWS} SELECT file_id, row_idx,
        row_number() OVER (PARTITION BY file_id ORDER BY row_idx) - 1 AS ordinal FROM item_rows""",
    "project_spec": f"WITH {ITEM_ROWS} SELECT file_id, row_idx, {MAPPED} FROM item_rows",
    "inject_date": f"""WITH {ITEM_ROWS} SELECT file_id, row_idx, {new_date('business_date')} AS "Sales Date *" FROM item_rows""",
    "inject_empty": f"""WITH {ITEM_ROWS} SELECT file_id, row_idx, '' AS "Order ID", '' AS "Sales Type Code" FROM item_rows""",
    "cast_int": f"""SELECT l_orderkey, l_linenumber, txt, {to_int('txt')} AS amount FROM (
        SELECT *, CASE l_linenumber WHEN 1 THEN l_quantity::BIGINT::VARCHAR WHEN 2 THEN '-' || l_quantity::BIGINT || '.75'
        WHEN 3 THEN ' ' || l_quantity::BIGINT || ' ' WHEN 4 THEN '1,' || l_quantity::BIGINT WHEN 5 THEN l_quantity::BIGINT || 'd'
        WHEN 6 THEN l_quantity::BIGINT || 'e2' END AS txt FROM lineitem)""",
    "cast_money": f"""SELECT l_orderkey, l_linenumber, txt, {to_money('txt')} AS amount FROM (
        SELECT *, CASE l_linenumber WHEN 1 THEN m WHEN 2 THEN 'AED ' || m WHEN 3 THEN '(' || m || ')' WHEN 4 THEN '-' || m || ' %'
        WHEN 5 THEN '--' || m WHEN 6 THEN 'AED. ' || m WHEN 7 THEN '' END AS txt
        FROM (SELECT *, {money('(round(l_extendedprice * 100)::BIGINT)')} AS m FROM lineitem))""",
    "reorder_extras": f"""WITH {ITEM_ROWS} SELECT file_id, row_idx, {INJECTED}, {MAPPED}, {_cell('cashier')} AS "Cashier",
        {_cell('discounts_1')} AS "Discounts.1", {_cell('gross_old')} AS "Gross (old)" FROM item_rows""",
    "active_locations": f"WITH {ACTIVE} SELECT * FROM active",
    "pick_location": f"""WITH {DIM} SELECT * FROM dim WHERE lower(pos_name) = 'parade''s store 5' ORDER BY ordinal LIMIT 1""",
    "pick_codes": f"WITH {CODES}, {CODE_REQUESTS} SELECT * FROM codes WHERE code IN (SELECT code FROM code_requests)",
    "kpi_empty": f"WITH {KPI} SELECT workplace_id, report_date::VARCHAR AS report_date FROM kpi WHERE is_empty",
    "kpi_flatten": KPI_WIDE,
    "kpi_categories": KPI_ROWS.format(columns=f"{_KPI_KEYS}, {_category_columns()}"),
    "kpi_discounts": KPI_ROWS.format(columns=f"{_KPI_KEYS}, {_discount_columns()}"),
    "date_range": """SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM orders
        WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01'""",
    "no_data_flag": f"""SELECT kind, id, regexp_matches(txt, '{_NO_DATA}', 'i') AS no_data,
        regexp_matches(txt, '{_NO_DATA_LOOSE}', 'i') AS no_data_loose FROM (
        SELECT 'document' AS kind, doc_id AS id, text || {_ending('doc_id')} AS txt FROM documents
        UNION ALL SELECT 'page', page_id, html || {_ending('page_id')} FROM pages)""",
    "run_status": f"WITH {RESULTS} SELECT ordinal, pos_name, stage, row_count, business_date, status FROM results",
    "kpi_status": f"WITH {KPI_STATUS} SELECT * FROM kpi_status",
    "missing_key_files": f"""WITH {META} SELECT file_id, 'missing column: Menu Item #' AS error FROM meta
        WHERE file_id NOT IN (SELECT file_id FROM header WHERE name = 'Menu Item #')""",
    # joins
    "attach_label": f"""WITH {DIM} SELECT l_orderkey, l_linenumber, {store_name('l_suppkey')} AS pos_name, label
        FROM lineitem LEFT JOIN dim ON dim.pos_name = {store_name('l_suppkey')}""",
    "resolve_exact": f"WITH {REQUESTS}, {WORKPLACES} SELECT o_orderkey, pos_name, id AS workplace_id FROM requests JOIN workplaces ON name = pos_name",
    "resolve_cascade": f"WITH {RESOLVED} SELECT * FROM resolved",
    "resolve_unmatched": f"WITH {RESOLVED} SELECT o_orderkey, pos_name FROM resolved WHERE workplace_id IS NULL",
    "option_cascade": f"WITH {OPTIONS} SELECT * FROM matched",
    "option_unmatched": f"WITH {OPTIONS} SELECT o_orderkey, pos_name FROM matched WHERE option IS NULL",
    "unknown_codes": f"WITH {CODES}, {CODE_REQUESTS} SELECT o_orderkey, code, report_date::VARCHAR AS report_date FROM code_requests WHERE code NOT IN (SELECT code FROM codes)",
    "result_labels": f"""WITH {CODES}, {CODE_REQUESTS} SELECT o_orderkey, r.code, coalesce(label, r.code) AS label
        FROM code_requests r LEFT JOIN codes ON codes.code = r.code""",
    # aggregations, windows, limits
    "detect_header": f"WITH {META} SELECT file_id, header_row FROM meta",
    "detect_business_date": f"WITH {META} SELECT file_id, business_date FROM meta",
    "status_counts": f"WITH {RESULTS}, {COUNTS} SELECT succeeded, no_data, failed, total, success FROM counts",
    "kpi_counts": f"""WITH {KPI_STATUS} SELECT report_date, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS fail,
        count(*) AS total FROM kpi_status GROUP BY 1""",
    "report_date": f"WITH {RESULTS}, {COUNTS} SELECT report_date FROM counts",
    "workplace_dedup": f"WITH {WORKPLACES} SELECT * FROM workplaces",
    "dim_counts": f"""WITH {ACTIVE}, {CODES}, {WORKPLACES} SELECT 'locations' AS what, count(*) AS n FROM dim
        UNION ALL SELECT 'active locations', count(*) FROM active UNION ALL SELECT 'codes', count(*) FROM codes
        UNION ALL SELECT 'workplaces', count(*) FROM workplaces""",
    "failed_list": f"WITH {RESULTS} SELECT stage, pos_name, error FROM results WHERE status = 'failed'",
    "list_locations": f"WITH {ACTIVE} SELECT *, row_number() OVER (ORDER BY ordinal) AS number FROM active",
    "limit_locations": f"WITH {ACTIVE} SELECT * FROM active ORDER BY ordinal LIMIT 25",
    # set operations
    "spec_diff": f"""WITH {META}, spec(name) AS (VALUES {_KNOWN_SQL}),
        want AS (SELECT file_id, spec.name FROM meta, spec), have AS (SELECT file_id, name FROM header)
        SELECT *, 'spec' AS only_in FROM (FROM want EXCEPT ALL FROM have)
        UNION ALL SELECT *, 'report' FROM (FROM have EXCEPT ALL FROM want)""",
    "spec_required": f"""WITH {META}, spec(name) AS (VALUES ('Menu Item #'), ('Menu Item Name'), ('Gross after Disc.'))
        SELECT file_id, spec.name FROM meta, spec EXCEPT SELECT file_id, name FROM header""",
    # scalar functions
    "sanitize": f"""SELECT c_custkey, name, {sanitized('name')} AS safe FROM (
        SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_name || ': a/b\\c' WHEN 1 THEN '  _' || c_name || '??' WHEN 2 THEN '<*> '
        WHEN 3 THEN c_name || '  –  "x" | y' ELSE {hub_name('c_custkey')} END AS name FROM customer)""",
    "norm_a": f"SELECT c_custkey, {norm_a(hub_name('c_custkey'))} AS norm FROM customer",
    "norm_b": f"SELECT c_custkey, {norm_b(hub_name('c_custkey'))} AS norm FROM customer",
    "date_reformat": f"""SELECT l_orderkey, l_linenumber, txt, {new_date('txt')} AS shown FROM (
        SELECT *, CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y') WHEN 2 THEN day(l_shipdate) || '/' || month(l_shipdate) || '/' || year(l_shipdate)
        WHEN 3 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 4 THEN '31/02/' || year(l_shipdate) WHEN 5 THEN '' WHEN 6 THEN 'nan'
        ELSE strftime(l_shipdate, '%d/%m/%Y') END AS txt FROM lineitem)""",
    "kpi_long_labels": f"""WITH {KPI} SELECT workplace_id, report_date::VARCHAR AS report_date, category, category_label,
        turnover::DOUBLE AS turnover, products::DOUBLE AS products, tp::DOUBLE AS turnover_percentage, pp::DOUBLE AS product_percentage FROM (
        {" UNION ALL ".join(f"SELECT workplace_id, report_date, '{c}' AS category, '{c.title()}' AS category_label, cents_{e} / 100 AS turnover, n_{e} AS products, cents_{e} * 100 / cents AS tp, n_{e} * 100 / n AS pp FROM kpi WHERE NOT is_empty AND n_{e} > 0" for e, c in _EVENT_CATEGORIES.items())})""",
    "kpi_message": KPI_ROWS.format(columns=(
        "code, report_date::VARCHAR AS report_date, 'Daily POS report for ' || label || ' (' || pos_name || ')' || chr(10) || 'Date: ' || "
        "report_date || chr(10) || chr(10) || 'Turnover: ' || " + money("cents") + " || ' SAR' || chr(10) || 'Products: ' || n || chr(10) AS message")),
    "sales_message": f"""WITH {RESULTS} SELECT ordinal, 'Hi,' || chr(10) || chr(10) || (CASE WHEN ordinal % 5 <> 0
        THEN 'Please find attached the daily POS Sales Report for:' || chr(10) || chr(10) || '  • Location : ' || label || chr(10) || '  • Date     : ' || business_date
          || chr(10) || '  • Rows     : ' || format('{{:,}}', row_count) || chr(10) || '  • File     : ' || {sanitized('label')} || '.csv' || chr(10) || '  • Run ID   : run-1'
        ELSE 'Please find attached the daily POS Sales Report for ' || business_date || '.' || chr(10) || chr(10) || '  • Rows: ' || format('{{:,}}', row_count)
          || chr(10) || '  • File: ' || {sanitized('label')} || '.csv' || chr(10) || '  • Run ID: run-1' END)
        || chr(10) || chr(10) || 'This report was generated automatically by the report pipeline.' || chr(10) || chr(10) || 'Regards,' || chr(10) || 'report pipeline' AS message
        FROM results WHERE ok""",
    "kpi_digest_head": f"""WITH {KPI_STATUS}, c AS (SELECT count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS fail, count(*) AS total FROM kpi_status)
        SELECT (row_number() OVER () - 1)::INT AS position, line FROM (SELECT unnest(['Daily Run Summary — 2024-01-31', '  ✅ Succeeded : ' || ok,
        '  ❌ Failed    : ' || fail, '  Total       : ' || total, '', repeat('─', 50)]) AS line FROM c)""",
    "digest_lines": f"WITH {RESULTS} SELECT label, ordinal, rpad(substr(label, 1, 45), 45, ' ') || '  ' || {_STATUS_TEXT} AS line FROM results",
    "digest_head": f"""WITH {RESULTS}, {COUNTS} SELECT (row_number() OVER () - 1)::INT AS position, line FROM (
        SELECT unnest(['Daily Run Summary — ' || report_date, 'Run ID: run-1', '', '  ✅  Succeeded : ' || succeeded,
        '  –   No data   : ' || no_data, '  ❌  Failed    : ' || failed, '  Total         : ' || total, '', repeat('─', 60),
        rpad('Location', 45, ' ') || '   Rows  Status', repeat('─', 60)]) AS line FROM counts)""",
    "digest_subject": f"""WITH {RESULTS}, {COUNTS} SELECT ordinal, {_report_subject('label', 'business_date')} AS subject FROM results WHERE status = 'ok'
        UNION ALL SELECT -1, '[Summary] Run — ' || report_date || ' — ' || succeeded || '/' || total || ' OK' FROM counts""",
    "kpi_digest": f"""WITH {KPI_STATUS} SELECT o_orderkey AS ordinal, (CASE WHEN ok THEN '✅' ELSE '❌' END) || '  ' || rpad(r.code, 8, ' ') || '  ' || coalesce(c.label, r.code) AS line
        FROM kpi_status r LEFT JOIN codes c ON c.code = r.code""",
    "output_name": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'sales_report_' || day || '_run-1'
        ELSE {sanitized(store_name('o_custkey'))} || '_' || day END AS name, 'C' || o_custkey || '_' || day AS kpi_name
        FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)""",
    # the whole item-sales job
    "item_sales": ITEM_SALES,
    "item_sales_text": ITEM_SALES,
}
