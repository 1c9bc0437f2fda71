"""Shared pieces of the oracle SQL: the derived documents, stated relationally."""

# `charges` of a line: missing on line 7, may be empty.
LINES = """
lines AS (
  SELECT 'lines_' || (l_partkey % 20) AS collection,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, *,
         CASE WHEN l_linenumber <> 7 THEN list_filter(
           [{'kind': 'discount', 'amount': l_discount}, {'kind': 'tax', 'amount': l_tax}],
           lambda c: c.amount > 0) END AS charges
  FROM lineitem)
"""

# (collection, doc, path, type, num, txt): every flattened node of the line documents.
LINE_NODES = LINES + """,
line_rows AS (SELECT row_number() OVER () AS doc, * FROM lines),
charge_rows AS (SELECT collection, doc, unnest(charges) AS c FROM line_rows),
nodes AS (
  SELECT collection, doc, '$._id' AS path, 'string' AS type, NULL::DOUBLE AS num, id AS txt FROM line_rows
  UNION ALL SELECT collection, doc, '$.status', 'string', NULL, l_returnflag FROM line_rows
  UNION ALL SELECT collection, doc, '$.qty', 'number', l_quantity, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.price', 'number', l_extendedprice, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.item', 'object', NULL, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.item.part', 'number', l_partkey, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.item.supp', 'number', l_suppkey, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.charges', 'array', NULL, NULL FROM line_rows WHERE charges IS NOT NULL
  UNION ALL SELECT collection, doc, '$.charges.kind', 'string', NULL, c.kind FROM charge_rows
  UNION ALL SELECT collection, doc, '$.charges.amount', 'number', c.amount, NULL FROM charge_rows
  UNION ALL SELECT collection, doc, '$.flags', 'array', NULL, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.flags[*]', 'string', NULL, unnest([l_returnflag, l_linestatus]) FROM line_rows
  UNION ALL SELECT collection, doc, '$.empty', 'array', NULL, NULL FROM line_rows
  UNION ALL SELECT collection, doc, '$.mixed', 'string', NULL, 'even' FROM line_rows WHERE l_linenumber % 2 = 0
  UNION ALL SELECT collection, doc, '$.mixed', 'number', l_linenumber, NULL FROM line_rows WHERE l_linenumber % 2 <> 0)
"""

# One index per part; `shape` decides its key document.
PART_INDEXES = """
shapes(shape, paths, ascs, is_text, is_spatial, is_hashed) AS (VALUES
  (0, ['status'], [true], false, false, false),
  (1, ['status', 'item.part'], [false, true], false, false, false),
  (2, ['qty', 'price'], [true, false], false, false, false),
  (3, ['charges.amount'], [true], false, false, false),
  (4, ['status', 'charges.kind'], [true, false], false, false, false),
  (5, ['charges.kind', 'flags'], [true, true], false, false, false),
  (6, ['item'], [true], false, false, false),
  (7, ['nope', 'status'], [true, true], false, false, false),
  (8, []::VARCHAR[], []::BOOLEAN[], false, false, true),
  (9, ['loc'], [true], false, true, false),
  (10, []::VARCHAR[], []::BOOLEAN[], true, false, false),
  (11, ['flags'], [true], false, false, false),
  (12, ['charges'], [true], false, false, false),
  (13, ['_id'], [true], false, false, false),
  (14, ['mixed'], [true], false, false, false),
  (15, ['empty', 'status'], [true, true], false, false, false),
  (16, ['$**'], [true], false, false, false)),
ix AS (
  SELECT 'lines_' || (p_partkey % 20) AS collection, 'ix_' || p_partkey AS index_name, p_partkey,
         p_partkey % 5 = 0 AS is_unique, (p_partkey % 7 = 0 AND p_partkey % 5 <> 0) AS is_ttl, s.*,
         s.shape IN (10, 16) AS is_search
  FROM part JOIN shapes s ON s.shape = p_partkey % 17)
"""

# What index planning should say about each shape.
PART_PLAN = PART_INDEXES + """,
first_search AS (SELECT collection, min(index_name) AS first_name FROM ix WHERE is_search AND NOT is_ttl GROUP BY 1),
planned AS (
  SELECT ix.*, f.first_name,
    CASE WHEN is_ttl THEN 'ttl' WHEN is_search THEN 'json_search' WHEN shape = 9 THEN 'geo_json'
         WHEN shape = 13 THEN 'primary_key' WHEN shape = 8 THEN 'sharded'
         WHEN shape IN (3, 11) THEN 'simple_mv' WHEN shape = 4 THEN 'compound_mv'
         WHEN len(paths) = 1 THEN 'simple' ELSE 'compound' END AS kind,
    CASE WHEN is_ttl THEN 'ttl' WHEN is_search AND index_name > first_name THEN 'merged search index'
         WHEN shape = 8 THEN 'sharded' WHEN shape = 5 THEN 'parallel arrays' WHEN shape = 6 THEN 'object'
         WHEN shape = 7 THEN 'unknown type' WHEN shape = 14 THEN 'multitype'
         WHEN shape IN (12, 15) THEN 'orphan array' ELSE '' END AS reasons
  FROM ix LEFT JOIN first_search f USING (collection)),
plan AS (
  SELECT *, CASE WHEN reasons IN ('ttl', 'merged search index') THEN 'skipped'
                 WHEN reasons <> '' THEN 'failed' ELSE 'build' END AS status
  FROM planned)
"""

# Exact record length of an order in the derived dump.
ORDER_BYTES = """
(5 + (5 + CASE WHEN o_orderkey < 2147483648 THEN 4 ELSE 8 END)
   + (9 + CASE WHEN o_custkey < 2147483648 THEN 4 ELSE 8 END)
   + (13 + strlen(o_orderstatus)) + 15 + 14 + (15 + strlen(o_orderpriority)))
"""


def _at(dx: str, dy: str) -> str:
    return f"{{x: (x + {dx} + 540) % 360 - 180, y: greatest(-90.0, least(90.0, y + {dy}))}}"


# (id, part, k, x1, y1, x2, y2): edges of the derived paths and areas, the second end moved across the date line.
SHAPES = f"""
spots AS (SELECT event_id AS id, event_id AS n, (user_id % 360 - 180)::DOUBLE AS x, greatest(-90.0, least(90.0, value)) AS y FROM events),
corners AS (
  SELECT id, 'path' AS shape, [{_at("0", "0")}, {_at("n % 37 - 18", "n % 23 - 11")}, {_at("n % 61 - 30", "-(n % 19)")}] AS c
  FROM spots WHERE n % 5 <> 0 AND n % 7 <> 0
  UNION ALL SELECT id, 'area', [{_at("0", "0")}, {_at("2 + n % 11", "0")}, {_at("2 + n % 11", "3 + n % 5")}, {_at("0", "3 + n % 5")}, {_at("0", "0")}]
  FROM spots),
steps AS (SELECT id, shape, unnest(list_zip(c[:-2], c[2:])) AS e FROM corners),
edges AS (SELECT id, shape, e[1].x AS x1, e[1].y AS y1, e[2].y AS y2, CASE WHEN e[2].x - e[1].x > 180 THEN e[2].x - 360
  WHEN e[2].x - e[1].x < -180 THEN e[2].x + 360 ELSE e[2].x END AS x2 FROM steps)"""


def _merged(step: int) -> str:
    """Cells of one level up: those whose four children are there."""
    return f"""
up{step} AS (SELECT id, k - 1 AS k, code >> 2 AS code FROM cells{step} WHERE k > 0 GROUP BY ALL HAVING count(*) = 4),
cells{step + 1} AS (SELECT * FROM up{step}),
left{step} AS (SELECT * FROM cells{step} c WHERE NOT EXISTS (
  SELECT 1 FROM up{step} u WHERE u.id = c.id AND u.code = c.code >> 2))"""


# (id, lo, hi): the covering of every path.
PATH_CELLS = f"""{SHAPES},
boxes AS (SELECT id, least(max(greatest(x1, x2)) - min(least(x1, x2)),
    max(greatest(x1, x2) + CASE WHEN x1 < 0 THEN 360 ELSE 0 END) - min(least(x1, x2) + CASE WHEN x1 < 0 THEN 360 ELSE 0 END)) AS width,
  max(greatest(y1, y2)) - min(least(y1, y2)) AS height FROM edges WHERE shape = 'path' GROUP BY id),
leveled AS (SELECT id, len([k FOR k IN range(1, 21) IF greatest(width / 360, height / 180) * pow(2, k) <= 8]) AS k FROM boxes),
sized AS (SELECT e.*, k, (1::BIGINT << k) AS n FROM edges e JOIN leveled USING (id) WHERE shape = 'path'),
columns_of AS (SELECT *, unnest(range(floor((least(x1, x2) + 180) / 360 * n)::BIGINT, floor((greatest(x1, x2) + 180) / 360 * n)::BIGINT + 1)) AS c FROM sized),
clipped AS (SELECT *, greatest(least(x1, x2), c * 360 / n - 180) AS a, least(greatest(x1, x2), (c + 1) * 360 / n - 180) AS b FROM columns_of),
heights AS (SELECT *, CASE WHEN x1 = x2 THEN y1 ELSE y1 + (a - x1) * (y2 - y1) / (x2 - x1) END AS ya,
  CASE WHEN x1 = x2 THEN y2 ELSE y1 + (b - x1) * (y2 - y1) / (x2 - x1) END AS yb FROM clipped),
rows_of AS (SELECT id, k, ((c % n) + n) % n AS c, unnest(range(
    least(greatest(floor((least(ya, yb) - 1e-9 + 90) / 180 * n), 0), n - 1)::BIGINT,
    least(greatest(floor((greatest(ya, yb) + 1e-9 + 90) / 180 * n), 0), n - 1)::BIGINT + 1)) AS r FROM heights),
cells0 AS (SELECT DISTINCT id, k, list_sum([(((c >> b) & 1) << (2 * b)) + (((r >> b) & 1) << (2 * b + 1)) FOR b IN range(20)])::BIGINT AS code
  FROM rows_of),{",".join(_merged(s) for s in range(4))},
covered AS ({" UNION ALL ".join(f"SELECT * FROM left{s}" for s in range(4))} UNION ALL SELECT * FROM cells4)"""
