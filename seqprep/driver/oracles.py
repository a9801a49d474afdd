"""DuckDB SQL for the registered queries, written from the operator definitions."""

from __future__ import annotations

from seqprep.contract import HASHED_FEATURES

# -- fixture views ----------------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT user_id::VARCHAR || '-' || strftime(ts, '%Y%m%d') AS user_id,
         floor(k * k / 100)::BIGINT::VARCHAR AS item_id,
         k::VARCHAR AS canonical_listing_id,
         event_type, epoch_us(ts) AS event_us, epoch_us(ts) // 1000000 AS timestamp, event_id,
         'r' || (user_id % 2)::VARCHAR AS region
  FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events)
)"""

USER_EVENTS = (
    EVENTS.replace("ev AS", "day_ev AS")
    + ", ev AS (SELECT * REPLACE (split_part(user_id, '-', 1) AS user_id) FROM day_ev)"
)

RAW_EVENTS = """
raw AS (
  SELECT event_id,
         CASE WHEN k % 10 = 3 THEN k::VARCHAR || ' ' ELSE k::VARCHAR END AS listing,
         CASE WHEN k % 20 = 5 THEN '  ' WHEN k % 20 = 6 THEN '  s' || user_id::VARCHAR || ' '
              ELSE 's' || user_id::VARCHAR END AS session,
         CASE WHEN k % 25 = 7 THEN NULL ELSE epoch_us(ts) // 1000 END AS ms,
         event_type
  FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events)
)"""

VERSIONS = """
versions AS (
  SELECT l_partkey::VARCHAR AS id, l_linestatus = 'O' AS active, l_shipdate, l_orderkey,
         l_linenumber, l_extendedprice, l_quantity, 'r' || (l_suppkey % 3)::VARCHAR AS region
  FROM lineitem
)"""


def _coordinate(start: int, zero_at: int) -> str:
    return f"""
    CASE WHEN key % 50 IN ({zero_at}, 0) THEN '0' WHEN key % 51 = {zero_at} THEN 'abc'
         WHEN key % 53 = {zero_at} THEN NULL
         ELSE '-' || ({start} + key % 20)::VARCHAR || '.' || lpad((key % 1000)::VARCHAR, 3, '0') END"""


ITEMS = f"""
parts AS (
  SELECT *, p_partkey AS key, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2
  FROM part
), texts AS (
  SELECT key::VARCHAR AS canonical_listing_id,
    {_coordinate(5, 11)} AS lat_region,
    {_coordinate(35, 13)} AS lon_region,
    CASE WHEN key % 13 = 0 THEN ' ' ELSE lpad((key * 7919 % 100000)::VARCHAR, 8, '3') END AS zip_code,
    CASE WHEN key % 17 <> 0 THEN p_brand END AS neighborhood,
    CASE WHEN key % 3 <> 0 THEN p_size * 10.0 END AS usable_areas,
    CASE WHEN key % 4 <> 0 THEN p_size * 12.5 - 100.0 END AS total_areas,
    p_size AS bedrooms,
    CASE WHEN key % 5 <> 0 THEN p_size % 4 END AS bathrooms,
    CASE WHEN key % 6 <> 0 THEN p_size % 3 END AS suites,
    CASE WHEN key % 7 <> 0 THEN p_size % 5 - 1 END AS parking_spaces,
    CASE WHEN key % 9 <> 0 THEN p_retailprice END AS price,
    p_type AS unit_type,
    CASE key % 8 WHEN 0 THEN NULL
      WHEN 1 THEN '[''' || w1 || ''', '' ' || w2 || ' '', None]'
      WHEN 2 THEN '(''' || w1 || ''', "' || w2 || '", 7)'
      WHEN 3 THEN 'garbage(' || w1
      WHEN 4 THEN '[''' || w1 || ''', ''' || w1 || ''',]'
      WHEN 5 THEN '[]'
      ELSE '[''' || w1 || ''', ''' || w2 || ''']' END AS amenities,
    CASE key % 7 WHEN 0 THEN NULL WHEN 1 THEN ' sell ' WHEN 2 THEN 'SALE' WHEN 3 THEN 'rental'
      WHEN 4 THEN 'RENTAL' WHEN 5 THEN 'Sale' ELSE 'RENTAL' END AS business_type,
    CASE key % 5 WHEN 0 THEN 'RESIDENTIAL' WHEN 1 THEN 'residential ' WHEN 2 THEN 'COMMERCIAL'
      WHEN 3 THEN 'MIXED' ELSE NULL END AS usage_type
  FROM parts
), numbers AS (
  SELECT *, try_cast(lat_region AS DOUBLE) AS lat, try_cast(lon_region AS DOUBLE) AS lon,
    upper(trim(coalesce(business_type, 'None'))) AS b, upper(trim(coalesce(usage_type, 'None'))) AS u
  FROM texts
), items AS (
  SELECT *,
    CASE WHEN u IN ('RESIDENTIAL', 'COMMERCIAL')
         THEN (CASE WHEN b = 'SELL' THEN 'SALE' ELSE b END) || '_' || u ELSE 'OTHER' END AS market_segment,
    CASE WHEN lat IS NULL OR lon IS NULL OR (lat = 0 AND lon = 0) THEN 0
         ELSE 13 * 72057594037927936 + floor((lon + 180) / 360 * 8192)::BIGINT * 268435456
              + floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 8192)::BIGINT END::BIGINT AS h3_res6,
    CASE WHEN lat IS NULL OR lon IS NULL OR (lat = 0 AND lon = 0) THEN 0
         ELSE 14 * 72057594037927936 + floor((lon + 180) / 360 * 16384)::BIGINT * 268435456
              + floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 16384)::BIGINT END::BIGINT AS h3_res7
  FROM numbers
)"""

# -- session chain ----------------------------------------------------------------------------


def _runs(session: str = "user_id", item: str = "item_id") -> str:
    return f"""
marked AS (
  SELECT *, CASE WHEN lag({item}) OVER w IS NULL OR {item} <> lag({item}) OVER w
                   OR event_type <> lag(event_type) OVER w THEN 1 ELSE 0 END AS new_run
  FROM ev WINDOW w AS (PARTITION BY {session} ORDER BY event_us, event_id)
), numbered AS (
  SELECT *, (sum(new_run) OVER (PARTITION BY {session} ORDER BY event_us, event_id
                                ROWS UNBOUNDED PRECEDING))::BIGINT AS run_seq
  FROM marked
), runs AS (
  SELECT {session}, min({item}) AS item_id, min(event_type) AS event_type,
         min(timestamp) AS timestamp, count(*) AS intensity, run_seq
  FROM numbered GROUP BY {session}, run_seq
)"""


def _length(name: str, source: str, low: int, high: int, session: str = "user_id") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (n, rn) FROM (
    SELECT *, count(*) OVER (PARTITION BY {session}) AS n,
           row_number() OVER (PARTITION BY {session} ORDER BY timestamp DESC, run_seq DESC) AS rn
    FROM {source})
  WHERE n >= {low} AND rn <= {high}
)"""


def _chain(
    low: int,
    high: int,
    support: int,
    session: str = "user_id",
    within: str = "",
    item: str = "item_id",
) -> str:
    group = f"{within}, item_id" if within else "item_id"
    part = f"PARTITION BY {within}" if within else ""
    return f"""{_runs(session, item)}, {_length('sized', 'runs', low, high, session)}, frequent AS (
  SELECT * FROM sized
  WHERE ({group}) IN (SELECT ({group}) FROM sized GROUP BY {group} HAVING count(*) >= {support})
), {_length('kept', 'frequent', low, high, session)}, sessions AS (
  SELECT *, dense_rank() OVER ({part} ORDER BY user_id) AS session_id_numeric,
         dense_rank() OVER ({part} ORDER BY item_id) AS item_id_numeric
  FROM kept
)"""


_SESSION_COLUMNS = """SELECT user_id, item_id, event_type, timestamp, intensity, run_seq,
       session_id_numeric, item_id_numeric FROM sessions"""

REGIONAL = f"""WITH {EVENTS}, {_chain(3, 50, 20, 'region, user_id', 'region')}, merged AS (
  SELECT dense_rank() OVER (ORDER BY region, user_id) AS uid,
         dense_rank() OVER (ORDER BY region, item_id) AS sid,
         item_id AS canonical_listing_id, event_type, timestamp, intensity, run_seq AS pos, region
  FROM kept
)"""

# -- sequence dataset -------------------------------------------------------------------------

MODEL = f"""WITH {EVENTS}, {_chain(2, 50, 5, item='canonical_listing_id')}, {ITEMS}, frame AS (
  SELECT session_id_numeric AS uid, item_id_numeric AS sid, event_type AS behavior, timestamp,
         run_seq AS pos, intensity, coalesce(market_segment, 'OTHER') AS market_segment,
         coalesce(lat, 0.0) AS latitude, coalesce(lon, 0.0) AS longitude
  FROM sessions LEFT JOIN items ON items.canonical_listing_id = sessions.item_id
), active AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY timestamp, pos) AS position,
           count(*) OVER (PARTITION BY uid) AS group_size
    FROM frame)
  WHERE group_size >= 3
), codes(name, code) AS (
  VALUES ('click', 1), ('error', 2), ('purchase', 3), ('signup', 4), ('view', 5)
), dense AS (
  SELECT dense_rank() OVER (ORDER BY uid)::INTEGER AS uid,
         dense_rank() OVER (ORDER BY sid)::INTEGER AS sid,
         code AS behavior,
         dense_rank() OVER (ORDER BY market_segment)::INTEGER AS market_segment,
         intensity, latitude, longitude, position, group_size,
         CASE WHEN position = group_size AND behavior = 'purchase' THEN 'val' ELSE 'train' END AS split
  FROM active JOIN codes ON name = behavior
)"""


def _sequences(chunk: str) -> str:
    def joined(expression: str) -> str:
        return f"string_agg(({expression})::VARCHAR, ',' ORDER BY position)"

    return f"""{MODEL}
SELECT uid AS user, split, {chunk} AS chunk, {joined('sid')} AS items,
       {joined('behavior')} AS behaviors, {joined('intensity')} AS intensity,
       {joined('market_segment')} AS segments,
       {joined('round(latitude * 1000)::BIGINT')} AS latitudes,
       {joined('round(longitude * 1000)::BIGINT')} AS longitudes
FROM dense GROUP BY ALL"""


# -- item features ----------------------------------------------------------------------------

_ATOM = r"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|-?(?:0|[1-9][0-9]*)(?:[.][0-9]+)?|None|True|False)"""
_LIST = rf"(?s)^\[\s*(?:{_ATOM}(?:\s*,\s*{_ATOM})*\s*,?\s*)?\]$"
_TUPLE = rf"(?s)^\(\s*(?:{_ATOM}(?:\s*,|(?:\s*,\s*{_ATOM})+\s*,?)\s*)?\)$"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PARSED = f"""
parsed AS (
  SELECT canonical_listing_id, CASE
    WHEN regexp_matches(amenities, {_quoted(_LIST)}) OR regexp_matches(amenities, {_quoted(_TUPLE)})
    THEN list_filter(list_transform(regexp_extract_all(amenities, {_quoted(_ATOM)}),
      lambda t: upper(trim(CASE WHEN t[1] IN ('''', '"') THEN t[2:-2] ELSE t END))), lambda t: t <> '')
    ELSE [] END AS amenities
  FROM items
)"""

# Model items: every ordered part.
ALIGNED = f"""{ITEMS}, {PARSED}, model AS (
  SELECT l_partkey AS sid, row_number() OVER (ORDER BY l_partkey)::INTEGER AS dense_id
  FROM (SELECT DISTINCT l_partkey FROM lineitem)
), aligned AS (
  SELECT model.dense_id, items.* EXCLUDE (amenities), parsed.amenities
  FROM model JOIN items ON items.canonical_listing_id = sid::VARCHAR
  JOIN parsed ON parsed.canonical_listing_id = items.canonical_listing_id
)"""

TOP_AMENITIES = """
top_amenities AS (
  SELECT value, count, rank FROM (
    SELECT value, count(*) AS count,
           row_number() OVER (ORDER BY count(*) DESC, value)::INTEGER AS rank
    FROM (SELECT unnest(amenities) AS value FROM {source}) GROUP BY value)
  WHERE rank <= 7
)"""


def _cell(name: str, value: str, source: str = "aligned", where: str = "") -> str:
    return (
        f"SELECT dense_id, {name} AS name, round(({value})::FLOAT::DOUBLE, 3) AS value "
        f"FROM {source} {where}"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _logs() -> str:
    parts = []
    for name in ("price", "usable_areas", "total_areas"):
        parts.append(_cell(f"'log1p_{name}'", f"CASE WHEN {name} >= 0 THEN ln(1 + {name}) ELSE 0 END"))
        parts.append(
            _cell(f"'missing_{name}'", f"CASE WHEN {name} IS NULL OR {name} < 0 THEN 1 ELSE 0 END")
        )
    return _union(parts)


def _counts() -> str:
    parts = []
    for name in ("bedrooms", "bathrooms", "suites", "parking_spaces"):
        parts.append(_cell(f"'{name}'", f"coalesce({name}, 0)"))
        parts.append(_cell(f"'missing_{name}'", f"CASE WHEN {name} IS NULL THEN 1 ELSE 0 END"))
    return _union(parts)


def _coordinates() -> str:
    parts = []
    for name, column in (("latitude", "lat"), ("longitude", "lon")):
        parts.append(_cell(f"'{name}'", f"coalesce({column}, 0)"))
        parts.append(
            _cell(f"'missing_{name}'", f"CASE WHEN coalesce({column}, 0) = 0 THEN 1 ELSE 0 END")
        )
    return _union(parts)


_CATEGORIES = ("business_type", "usage_type", "unit_type", "market_segment")


def _one_hot() -> str:
    return _union(
        [_cell(f"'{name}=' || {name}", "1", where=f"WHERE {name} IS NOT NULL") for name in _CATEGORIES]
    )


_AMENITY_CELLS = _cell(
    "'amenity=' || value",
    "CASE WHEN list_contains(amenities, value) THEN 1 ELSE 0 END",
    "aligned CROSS JOIN top_amenities",
)


def _bucket(name: str, buckets: int) -> str:
    text = f"nullif(trim({name}::VARCHAR), '')"
    return f"(('0x' || substr(sha256({text}), 1, 16))::UBIGINT % {buckets})::INTEGER"


def _hashed() -> str:
    parts = []
    for name, buckets in HASHED_FEATURES.items():
        bucket = _bucket(name, buckets)
        parts.append(
            _cell(f"coalesce('{name}_hash_' || {bucket}::VARCHAR, 'missing_{name}')", "1")
        )
    return _union(parts)


def _columns() -> str:
    """Every vector position with its name, in block order."""
    fixed = [
        name
        for column in ("price", "usable_areas", "total_areas")
        for name in (f"log1p_{column}", f"missing_{column}")
    ]
    for column in ("bedrooms", "bathrooms", "suites", "parking_spaces"):
        fixed += [column, f"missing_{column}"]
    fixed += ["latitude", "longitude", "missing_latitude", "missing_longitude"]
    parts = [f"SELECT 0 AS block, {place} AS slot, '{name}' AS name" for place, name in enumerate(fixed)]
    for block, name in enumerate(_CATEGORIES, start=1):
        parts.append(
            f"SELECT {block}, row_number() OVER (ORDER BY count(*) DESC, {name}), '{name}=' || {name} "
            f"FROM aligned WHERE {name} IS NOT NULL GROUP BY {name}"
        )
    parts.append("SELECT 5, rank, 'amenity=' || value FROM top_amenities")
    for block, (name, buckets) in enumerate(HASHED_FEATURES.items(), start=6):
        parts.append(f"SELECT {block}, -1, 'missing_{name}'")
        parts.append(f"SELECT {block}, i, '{name}_hash_' || i::VARCHAR FROM range({buckets}) t(i)")
    return f"""{ALIGNED}, {TOP_AMENITIES.format(source='aligned')}, columns AS (
  SELECT (row_number() OVER (ORDER BY block, slot) - 1)::INTEGER AS position, name
  FROM ({_union(parts)})
)"""


MATRIX = f"""WITH {_columns()}, cells AS (
  {_union([_logs(), _counts(), _coordinates(), _one_hot(), _AMENITY_CELLS, _hashed()])}
)"""

POSITIONS = f"""{MATRIX}
SELECT dense_id, (SELECT count(*) FROM columns)::INTEGER AS width,
       count(*) AS non_zero, sum(position)::BIGINT AS position_sum
FROM cells JOIN columns USING (name) WHERE value <> 0 GROUP BY dense_id
UNION ALL SELECT 0, (SELECT count(*) FROM columns)::INTEGER, 0, 0"""

STATS = f"""WITH {_columns()}
SELECT (SELECT count(*) + 1 FROM model) AS rows, (SELECT count(*) FROM model) AS num_items,
       (SELECT count(*) FROM columns)::INTEGER AS min_width,
       (SELECT count(*) FROM columns)::INTEGER AS max_width,
       0::BIGINT AS not_finite, 0::BIGINT AS padding_not_zero"""

# -- checks -----------------------------------------------------------------------------------


def _offenders(name: str, keys: str) -> str:
    """``keys`` selects the offending keys as text in column ``key``."""
    return f"""SELECT '{name}' AS check_name, count(DISTINCT key) AS violations,
  coalesce((SELECT string_agg(key, '|' ORDER BY key)
            FROM (SELECT DISTINCT key FROM ({keys}) ORDER BY key LIMIT 5)), '') AS examples
FROM ({keys})"""


CHECKS = f"""WITH {EVENTS}, {ALIGNED}, faulty AS (
  SELECT CASE WHEN event_type <> 'error' THEN canonical_listing_id END AS canonical,
         length(item_id) - 2 AS intensity FROM ev
), conflicting AS (
  SELECT DISTINCT length(canonical_listing_id) AS sid, canonical_listing_id FROM ev
)
{_union([
    _offenders('unknown_behavior', "SELECT event_type AS key FROM ev WHERE event_type = 'error'"),
    "SELECT 'bad_intensity', count(*) FILTER (intensity < 0), '' FROM faulty",
    "SELECT 'smap_not_contiguous', 1, ''",
    _offenders('sid_not_in_events',
               "SELECT sid::VARCHAR AS key FROM model WHERE sid NOT IN (SELECT sid FROM conflicting)"),
    _offenders('item_not_in_catalog', "SELECT 'x' || item_id AS key FROM ev"),
    _offenders('duplicate_canonical',
               "SELECT l_suppkey::VARCHAR AS key FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1"),
    "SELECT 'null_event_key', count(*) FILTER (canonical IS NULL), '' FROM faulty",
    _offenders('sid_conflict',
               "SELECT sid::VARCHAR AS key FROM conflicting GROUP BY sid HAVING count(*) > 1"),
    _offenders('empty_region',
               "SELECT 'r' || n_nationkey::VARCHAR AS key FROM nation "
               "WHERE 'r' || n_nationkey::VARCHAR NOT IN (SELECT region FROM ev)"),
    "SELECT 'no_rows', 0, ''",
    "SELECT 'target_absent', 1, ''",
    "SELECT 'matrix_invariant', 0, ''",
])}"""

_ACTIVE = """newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
      ORDER BY l_shipdate DESC NULLS LAST, {ties}) AS rn FROM versions WHERE active)
  WHERE rn = 1
)"""
_ALL_TIES = "l_orderkey, l_linenumber, l_extendedprice, l_quantity, region"

_JOINED = f"""WITH {RAW_EVENTS}
SELECT event_id, nullif(trim(session), '') AS anonymized_session_id,
       p_partkey::VARCHAR AS canonical_listing_id, event_type, ms AS event_ms
FROM raw JOIN part ON p_partkey::VARCHAR = listing
WHERE event_type IN ('click', 'purchase', 'view')"""

_RARE = f"""WITH {EVENTS}, {_runs()}
SELECT * FROM runs WHERE item_id IN (SELECT item_id FROM runs GROUP BY item_id HAVING count(*) >= 80)"""

_PRICE = "l_extendedprice::DECIMAL(12,2)::VARCHAR"

LINEITEM_TYPES = {
    "l_discount": "double",
    "l_extendedprice": "double",
    "l_linenumber": "int",
    "l_linestatus": "string",
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_quantity": "double",
    "l_returnflag": "string",
    "l_shipdate": "timestamp_ntz",
    "l_suppkey": "bigint",
    "l_tax": "double",
}
_DIGEST = " || ".join(
    f"'{name}:{kind}:' || coalesce(length({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-') || ';'"
    for name, kind in LINEITEM_TYPES.items()
)
FINGERPRINT = f"""
WITH d AS (SELECT md5({_DIGEST}) AS digest FROM lineitem)
SELECT count(*) AS rows, bit_xor(('0x' || substr(digest, 1, 15))::BIGINT) AS hash_xor,
       sum(('0x' || substr(digest, 18, 15))::BIGINT)::HUGEINT::VARCHAR AS hash_sum
FROM d"""

UNTIMED = f"""WITH {USER_EVENTS.replace("ev AS (SELECT * REPLACE", "long_ev AS (SELECT * REPLACE")}, ev AS (
  SELECT * REPLACE (-timestamp AS timestamp, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type) FROM long_ev
), {_runs().replace(
    "min(event_type) AS event_type",
    "arg_min(event_type, (event_us, event_id)) FILTER (event_type IS NOT NULL) AS event_type",
)} SELECT * FROM runs"""

ORACLES: dict[str, str] = {
    "q_item_columns": f"""WITH {ITEMS}
SELECT canonical_listing_id, lat_region, lon_region, zip_code, neighborhood, usable_areas::DOUBLE AS usable_areas, total_areas::DOUBLE AS total_areas, bedrooms,
       bathrooms, suites, parking_spaces, price::DOUBLE AS price, unit_type, amenities, business_type, usage_type, h3_res6, h3_res7
FROM items""",
    "q_regional_loads": f"""WITH {VERSIONS}
SELECT region, CASE WHEN active THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, count(*) AS rows
FROM versions WHERE region <> 'r1' OR active GROUP BY ALL""",
    "q_incremental_load": """
WITH v AS (
  SELECT 'r' || (l_suppkey % 3) AS region, l_partkey::VARCHAR AS id, l_shipdate AS moment, l_orderkey, l_linenumber
  FROM lineitem WHERE l_linestatus = 'O'
), newest AS (
  SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY region, id ORDER BY moment DESC, l_orderkey, l_linenumber) = 1
)
SELECT region, id AS anonymized_listing_id, epoch_us(moment) // 1000000 AS updated_s, l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY region ORDER BY id) AS listing_id_numeric
FROM newest""",
    "q_regional_scan": """
WITH v AS (
  SELECT 'r' || (l_suppkey % 3) AS region, l_partkey::VARCHAR AS part, l_orderkey AS o, l_linenumber AS n,
         CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
  FROM lineitem
)
SELECT region, part AS anonymized_listing_id, CASE WHEN o % 50 NOT IN (3, 7) THEN status END AS status,
       CASE WHEN o % 50 NOT IN (3, 7) THEN o::VARCHAR END AS updated_at,
       CASE WHEN o % 50 NOT IN (3, 7) THEN n::VARCHAR END AS price,
       CASE o % 50 WHEN 3 THEN part || ',' || status
                   WHEN 7 THEN part || ',' || status || ',' || o || ',' || n || ',x,y' END AS rejected
FROM v""",
    "q_load_metrics": """
WITH v AS (
  SELECT 'r' || (l_suppkey % 3) AS region, l_orderkey % 50 IN (3, 7) AS bad, l_linestatus = 'O' AS active FROM lineitem
)
SELECT 'load-1' AS load, 'listings' AS stage, region, metric, rows FROM (
  SELECT region, 'lines' AS metric, count(*) AS rows FROM v GROUP BY region
  UNION ALL SELECT region, 'rejected', count(*) FILTER (bad) FROM v GROUP BY region
  UNION ALL SELECT region, 'listings', count(*) FILTER (active AND NOT bad) FROM v GROUP BY region
)""",
    "q_sorted_sink": f"""WITH {EVENTS}
SELECT user_id, count(*) AS rows, count(DISTINCT user_id) AS files, count(*) FILTER (user_id IS NULL) AS late
FROM ev GROUP BY user_id""",
    "q_run_collapse_untimed": UNTIMED,
    "q_run_collapse_untimed_hot": UNTIMED,
    "q_clean_numeric": f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber
  WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE {_PRICE}::DOUBLE END AS price
FROM lineitem""",
    "q_clean_int": """
SELECT l_orderkey, l_linenumber, l_partkey, (CASE l_linenumber
  WHEN 2 THEN -l_partkey WHEN 3 THEN NULL WHEN 4 THEN 0 WHEN 5 THEN NULL ELSE l_partkey END)::INTEGER
  AS bedrooms
FROM lineitem""",
    "q_clean_dates": """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber IN (1, 2) THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS dt,
  CASE WHEN l_linenumber IN (1, 2) THEN NULL
       ELSE epoch_us(date_trunc('day', l_shipdate)) // 1000000
            + CASE WHEN l_linenumber = 3 THEN 45296 ELSE 0 END END AS updated_s
FROM lineitem""",
    "q_blank_ids": f"""WITH {RAW_EVENTS}
SELECT event_id, nullif(trim(listing), '') AS anonymized_listing_id,
       nullif(trim(session), '') AS anonymized_session_id
FROM raw""",
    "q_epoch_ms": f"""WITH {RAW_EVENTS}
SELECT event_id, trim(session) AS user_id, ms // 1000 AS timestamp, ms AS event_ms
FROM raw WHERE ms IS NOT NULL AND trim(session) <> '' AND trim(listing) <> ''""",
    "q_geo_cells": f"WITH {ITEMS} SELECT canonical_listing_id, h3_res6, h3_res7 FROM items",
    "q_market_segment": f"WITH {ITEMS} SELECT canonical_listing_id, market_segment FROM items",
    "q_latest_listing": f"""WITH {VERSIONS}, {_ACTIVE.format(key='id', ties='l_orderkey, l_linenumber')}
SELECT id AS anonymized_listing_id, l_orderkey, l_linenumber,
       epoch_us(l_shipdate) // 1000000 AS updated_s
FROM newest""",
    "q_listing_id_map": f"""WITH {VERSIONS}
SELECT id AS anonymized_listing_id, id AS canonical_listing_id,
       row_number() OVER (ORDER BY id) AS listing_id_numeric
FROM (SELECT DISTINCT id FROM versions WHERE active)""",
    "q_regional_listing_ids": f"""WITH {VERSIONS}
SELECT region, id AS anonymized_listing_id, id AS canonical_listing_id,
       row_number() OVER (PARTITION BY region ORDER BY id) AS listing_id_numeric
FROM (SELECT DISTINCT region, id FROM versions WHERE active)""",
    "q_unique_items": f"""WITH {VERSIONS}, {_ACTIVE.format(key='region, id', ties=_ALL_TIES)}
SELECT substr(region, 2, 1)::INTEGER AS region_order, id AS canonical_listing_id,
       l_orderkey, l_linenumber
FROM newest
QUALIFY row_number() OVER (PARTITION BY id ORDER BY region) = 1""",
    "q_events_join_catalog": _JOINED,
    "q_events_join_catalog_salted": _JOINED,
    "q_run_collapse": f"WITH {EVENTS}, {_runs()} SELECT * FROM runs",
    "q_run_collapse_hot": f"WITH {USER_EVENTS}, {_runs()} SELECT * FROM runs",
    "q_session_length": f"WITH {EVENTS}, {_runs()}, {_length('sized', 'runs', 3, 5)} SELECT * FROM sized",
    "q_session_length_long": (
        f"WITH {USER_EVENTS}, {_runs()}, {_length('sized', 'runs', 62, 1000)} SELECT * FROM sized"
    ),
    "q_rare_items": _RARE,
    "q_rare_items_salted": _RARE,
    "q_item_support": f"""WITH {EVENTS}, {_runs()}
SELECT item_id, count(*) AS support FROM runs GROUP BY item_id""",
    "q_session_chain": f"WITH {EVENTS}, {_chain(3, 5, 60)} {_SESSION_COLUMNS}",
    "q_session_chain_hot": f"WITH {USER_EVENTS}, {_chain(3, 40, 30)} {_SESSION_COLUMNS}",
    "q_dense_session_ids": f"""WITH {EVENTS}
SELECT user_id, row_number() OVER (ORDER BY user_id) AS session_id_numeric
FROM (SELECT DISTINCT user_id FROM ev)""",
    "q_region_merge": f"{REGIONAL} SELECT * FROM merged",
    "q_merge_stats": f"""{REGIONAL}
SELECT count(*) AS rows, count(DISTINCT uid) AS sessions, count(DISTINCT sid) AS items FROM merged""",
    "q_enriched_events": f"{MODEL} SELECT * FROM frame",
    "q_min_events": f"""{MODEL}
SELECT uid, sid, behavior, timestamp, pos, position, group_size FROM active""",
    "q_positions_hot": f"""WITH {USER_EVENTS}
SELECT user_id, event_us, event_id,
       row_number() OVER (PARTITION BY user_id ORDER BY event_us, event_id) AS position,
       count(*) OVER (PARTITION BY user_id) AS group_size
FROM ev""",
    "q_densify": f"{MODEL} SELECT uid, sid, behavior, market_segment, position FROM dense",
    "q_densify_salted": f"{MODEL} SELECT uid, sid, behavior, market_segment, position FROM dense",
    "q_dataset_maps": f"""{MODEL}
SELECT 'umap' AS map, uid::VARCHAR AS key, row_number() OVER (ORDER BY uid)::INTEGER AS id
FROM (SELECT DISTINCT uid FROM active)
UNION ALL SELECT 'smap', sid::VARCHAR, row_number() OVER (ORDER BY sid)::INTEGER
FROM (SELECT DISTINCT sid FROM active)
UNION ALL SELECT DISTINCT 'bmap', name, code FROM active JOIN codes ON name = behavior
UNION ALL SELECT 'segmap', market_segment, row_number() OVER (ORDER BY market_segment)::INTEGER
FROM (SELECT DISTINCT market_segment FROM active)""",
    "q_holdout_split": f"{MODEL} SELECT uid, position, behavior, split FROM dense",
    "q_split_stats": f"""{MODEL}
SELECT count(DISTINCT uid) AS sessions, count(DISTINCT sid) AS items, count(*) AS rows,
       count(*) FILTER (split = 'val') AS val_num,
       (SELECT string_agg(b::VARCHAR, ',' ORDER BY b) FROM (SELECT DISTINCT behavior AS b FROM dense))
         AS behaviors
FROM dense""",
    "q_sequences": _sequences("0"),
    "q_sequences_chunked": _sequences("(CASE WHEN split = 'val' THEN 0 ELSE (position - 1) // 2 END)::INTEGER"),
    "q_list_parse": f"""WITH {ITEMS}, {PARSED}
SELECT canonical_listing_id, array_to_string(amenities, '|') AS amenities FROM parsed""",
    "q_vocabulary": f"""WITH {ITEMS} {_union([
    f"SELECT '{name}' AS column, {name} AS value, count(*) AS count, "
    f"row_number() OVER (ORDER BY count(*) DESC, {name}) AS rank "
    f"FROM items WHERE {name} IS NOT NULL GROUP BY {name}"
    for name in ('neighborhood', 'unit_type', 'business_type')])}""",
    "q_topk_amenities": f"""WITH {ITEMS}, {PARSED}, {TOP_AMENITIES.format(source='parsed')}
SELECT * FROM top_amenities""",
    "q_hash_bucket": f"""WITH {ITEMS}
SELECT canonical_listing_id, {', '.join(
    f'{_bucket(name, buckets)} AS {name}_bucket' for name, buckets in HASHED_FEATURES.items())}
FROM items""",
    "q_item_alignment": f"""WITH {ALIGNED}
SELECT dense_id, canonical_listing_id, market_segment FROM aligned""",
    "q_feat_log": f"WITH {ALIGNED} {_logs()}",
    "q_feat_count": f"WITH {ALIGNED} {_counts()}",
    "q_feat_coord": f"WITH {ALIGNED} {_coordinates()}",
    "q_feat_onehot": f"WITH {ALIGNED} {_one_hot()}",
    "q_feat_onehot_salted": f"WITH {ALIGNED} {_one_hot()}",
    "q_feat_amenity": f"WITH {ALIGNED}, {TOP_AMENITIES.format(source='aligned')} {_AMENITY_CELLS}",
    "q_feat_hash": f"WITH {ALIGNED} {_hashed()}",
    "q_feature_columns": f"WITH {_columns()} SELECT position, name FROM columns",
    "q_feature_matrix": POSITIONS,
    "q_feature_dense_view": POSITIONS,
    "q_feature_sparse": f"""{MATRIX}
SELECT dense_id, position, name, value FROM cells JOIN columns USING (name) WHERE value <> 0""",
    "q_feature_stats": STATS,
    "q_feature_sparse_stats": STATS,
    "q_checks": CHECKS,
    "q_fingerprint": """
SELECT l_returnflag AS load, count(*) AS rows, true AS adds_up,
       count(*) FILTER (l_orderkey % 97 = 5 AND l_linenumber = 1 AND l_tax IS NOT NULL) > 0 AS change_found
FROM lineitem GROUP BY l_returnflag""",
    "q_fingerprint_portable": FINGERPRINT,
    "q_pruned_pairs": """
SELECT DISTINCT l_partkey AS sid, l_suppkey::VARCHAR AS canonical_listing_id FROM lineitem""",
}

_BY_REGION = "'r' || (l_suppkey % 3)::VARCHAR"
_BY_STATUS = "CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'INACTIVE' END"


def _answer(request: str, part: str, source: str, refused: str = "NULL::VARCHAR") -> str:
    return f"SELECT '{request}' AS request, {part} AS part, count(*) AS rows, {refused} AS refused FROM {source} GROUP BY ALL"


def _refused(request: str, reason: str) -> str:
    return f"SELECT '{request}', NULL, NULL, '{reason}'"


ORACLES |= {
    "q_united_loads": f"""
SELECT region, count(*) AS rows, count(*) FILTER (load = 'first') AS quantities,
       (sum(l_orderkey) FILTER (load = 'second'))::BIGINT AS orders
FROM (SELECT {_BY_REGION} AS region, l_orderkey FROM lineitem)
JOIN (VALUES ('r0', 'first'), ('r1', 'second'), ('r2', 'first'), ('r2', 'second')) AS loads(region, load) USING (region)
GROUP BY region""",
    "q_source_layout": _union([
        _answer("all regions", _BY_REGION, "lineitem"),
        _answer("one region", _BY_REGION, "lineitem WHERE l_suppkey % 3 = 1"),
        _refused("unknown region", "FileNotFoundError"),
        _refused("unknown column", "MissingColumns"),
    ]),
    "q_overwrite_guard": _union([
        _answer("first", _BY_STATUS, "lineitem WHERE l_linestatus = 'O'"),
        _answer("again", _BY_STATUS, "lineitem WHERE l_linestatus = 'O'", "'PATH_ALREADY_EXISTS'"),
        _answer("forced", _BY_STATUS, "lineitem WHERE l_linestatus <> 'O'"),
    ]),
    "q_parameter_bounds": _union([
        _answer("3 to 5", "event_type", f"({ORACLES['q_session_length']})"),
        _refused("1 to 5", "min session length must be at least 2"),
        _refused("6 to 5", "max session length must be at least the min session length"),
    ]),
}
