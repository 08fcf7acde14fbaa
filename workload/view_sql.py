"""The views of ``views`` as DuckDB SQL, and a helper to prefix a query with them."""

from beatgrid.vocabulary import CRIME_TYPES, OUTCOMES


def sql_list(labels) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in labels) + "]"


_CRIMES = sql_list([*CRIME_TYPES, "Unlisted type"])
_OUTCOMES = sql_list([*OUTCOMES, "Unlisted outcome"])

VIEWS = {
    "inc": """
        SELECT CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS crime_id,
               strftime(l_shipdate, '%Y-%m') AS month,
               'Force ' || CAST(l_suppkey % 40 AS VARCHAR) AS reported_by,
               'Force ' || CAST(l_suppkey % 40 AS VARCHAR) AS falls_within,
               CASE WHEN l_suppkey % 14 = 0 THEN '' ELSE CAST(l_suppkey % 180 AS VARCHAR) END AS longitude,
               CASE WHEN l_suppkey % 14 = 0 THEN '' ELSE CAST(l_suppkey % 90 AS VARCHAR) END AS latitude,
               'On or near "Road", ' || CAST(l_partkey AS VARCHAR) AS location,
               CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS area_code,
               CASE WHEN l_suppkey % 14 = 0 THEN '' ELSE 'N' || CAST(l_suppkey AS VARCHAR) END AS area_name,
               l_returnflag AS crime_type,
               CASE WHEN l_partkey % 3 = 0 THEN '' ELSE l_linestatus END AS outcome,
               '' AS context
        FROM lineitem""",
    "st": """
        SELECT crime_id, month, longitude, latitude, area_code, area_name, crime_type, outcome FROM inc""",
    "scored": """
        SELECT *, CASE WHEN crime_id = '' OR month = '' OR longitude = '' OR latitude = ''
                         OR area_code = '' OR area_name = '' OR crime_type = '' THEN 0
                       WHEN outcome = '' THEN 1 ELSE 2 END AS score
        FROM st""",
    "sized": """
        SELECT *, count(*) OVER (PARTITION BY crime_id, month) AS n_key,
               max(score) OVER (PARTITION BY crime_id, month) AS best
        FROM scored""",
    "rec": """
        SELECT CAST(o_custkey AS VARCHAR) AS area_code,
               'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS area_name,
               strftime(o_orderdate, '%Y-%m') AS month,
               substr(strftime(o_orderdate, '%Y-%m'), 1, 4) AS year,
               o_orderpriority AS crime_type, o_orderstatus AS outcome
        FROM orders""",
    "labelled": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS area_code, strftime(l_shipdate, '%Y') AS year,
               ({_CRIMES})[1 + l_partkey % {len(CRIME_TYPES) + 1}] AS crime_type,
               ({_OUTCOMES})[1 + (l_orderkey + l_linenumber) % {len(OUTCOMES) + 1}] AS outcome
        FROM lineitem""",
    "xwalk": """
        SELECT CAST(c_custkey AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS oa_code,
               CASE WHEN c_custkey % 11 = 0 THEN 'U' || CAST(c_custkey AS VARCHAR)
                    ELSE CAST(c_custkey AS VARCHAR) END AS small_code,
               CASE WHEN c_custkey % 11 = 0 THEN 'Unlisted ' || c_name ELSE c_name END AS small_name,
               CAST(n_nationkey AS VARCHAR) AS mid_code, n_name AS mid_name,
               CAST(r_regionkey AS VARCHAR) AS district_code, r_name AS district_name,
               '' AS district_name_alt
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey, range(1, 4) t(k)""",
    "xw": """
        SELECT DISTINCT small_code, small_name, mid_code, mid_name, district_code, district_name
        FROM xwalk""",
    "xwalk2": """
        SELECT * FROM xwalk UNION ALL
        SELECT oa_code, small_code, small_name, mid_code, mid_name, '-', NULL, district_name_alt FROM xwalk WHERE oa_code LIKE '%7-1'""",
    "placed": """
        SELECT rec.*, mid_code, mid_name, district_code, district_name
        FROM rec LEFT JOIN xw ON area_code = small_code AND area_name = small_name""",
    "rates_text": """
        SELECT CASE WHEN c_custkey % 100 = 99 THEN 'Column Total'
                    WHEN c_custkey % 19 = 0 THEN 'Unlisted ' || c_name ELSE c_name END AS district,
               CAST(year AS INTEGER) AS year,
               CASE (c_custkey * 7 + year) % 13 WHEN 0 THEN '!' WHEN 1 THEN '-' WHEN 2 THEN '~'
                    ELSE CAST((20 + (c_custkey * 31 + (year - 1995) * 17) % 120) // 10 AS VARCHAR) || '.'
                         || CAST((20 + (c_custkey * 31 + (year - 1995) * 17) % 120) % 10 AS VARCHAR)
               END AS rate,
               CAST(50 + (c_custkey * 13 + year * 5) % 400 AS VARCHAR) AS population
        FROM customer, range(1995, 2002) t(year)""",
    "rates": """
        SELECT district, year, TRY_CAST(rate AS DOUBLE) AS rate, TRY_CAST(population AS DOUBLE) AS population
        FROM rates_text
        WHERE coalesce(rate, '') NOT IN ('!', '-', '~', '*', '#') AND district <> 'Column Total'""",
    "dcounts": """
        SELECT area_name AS district, CAST(year AS INTEGER) AS year, count(*) AS "count"
        FROM rec GROUP BY ALL""",
    "skel": """
        SELECT CASE WHEN c_custkey % 23 = 0 THEN 'Unlisted ' || c_name ELSE c_name END AS district,
               CAST(year AS INTEGER) AS year
        FROM customer, range(1995, 2002) t(year)""",
    "merged": """
        SELECT district, year, "count", rate, population
        FROM dcounts FULL OUTER JOIN rates_text USING (district, year)""",
    "frame": """
        SELECT * FROM (
            SELECT district, year, CAST("count" AS DOUBLE) AS "count",
                   TRY_CAST(rate AS DOUBLE) AS rate, TRY_CAST(population AS DOUBLE) AS population
            FROM skel LEFT JOIN merged USING (district, year)
            WHERE coalesce(rate, '') NOT IN ('!', '-', '~', '*', '#') AND district <> 'Column Total')
        WHERE "count" IS NOT NULL AND rate IS NOT NULL AND population IS NOT NULL""",
    "boundary": """
        SELECT p_partkey // 8 AS shape_id,
               'Customer#' || lpad(CAST(p_partkey // 8 AS VARCHAR), 9, '0') AS name,
               p_partkey AS seq,
               CAST(400000 + (p_partkey * 37) % 90000 AS DOUBLE) AS x,
               CAST(200000 + (p_partkey * 53) % 90000 AS DOUBLE) AS y
        FROM part""",
    "shapes": "SELECT DISTINCT shape_id, name FROM boundary",
    "clusters": """
        SELECT CASE WHEN c_custkey % 13 = 0 THEN 'Unlisted ' || c_name ELSE c_name END AS district,
               CAST(20 + (c_custkey * 31) % 120 AS DOUBLE) / 10 AS rate,
               CAST(c_custkey % 977 AS DOUBLE) AS crime,
               CAST(nullif(c_custkey % 7, 0) AS INTEGER) AS cluster
        FROM customer""",
    "file_names": """
        SELECT DISTINCT 'in/' || strftime(o_orderdate, '%Y-%m') || '/' || strftime(o_orderdate, '%Y-%m')
               || '-force' || CAST(o_custkey % 25 AS VARCHAR) || '-'
               || (['street', 'outcomes', 'stop-and-search', 'notes'])[1 + o_orderkey % 4] || '.csv' AS path
        FROM orders""",
}
NEEDS = {
    "xwalk2": ["xwalk"], "st": ["inc"], "scored": ["st"], "sized": ["scored"], "xw": ["xwalk"], "placed": ["rec", "xw"],
    "rates": ["rates_text"], "dcounts": ["rec"], "merged": ["dcounts", "rates_text"],
    "frame": ["skel", "merged"], "shapes": ["boundary"],
}


def with_views(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the named views, their needs, and further named steps."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} AS ({VIEWS[name]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
