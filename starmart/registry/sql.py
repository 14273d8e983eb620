"""SQL pieces shared by the oracles: the test tables seen as a star."""

from __future__ import annotations

FACT_PARTS = """
line_agg AS (
  SELECT l_orderkey,
         count(*) FILTER (WHERE l_returnflag = 'R') AS killed,
         count(*) FILTER (WHERE l_returnflag = 'A') AS serious,
         count(*) FILTER (WHERE l_returnflag = 'N') AS slight,
         count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey
),
first_line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
  WHERE rn = 1
),
fact_staging AS (
  SELECT o_orderkey AS id_accident, n_regionkey AS id_pays, CAST(o_orderdate AS DATE) AS date,
         o_custkey AS id_lieu,
         CASE WHEN f.l_orderkey IS NOT NULL
              THEN f.l_orderkey || '-' || f.l_linenumber || '-' || f.l_partkey || '-' || f.l_suppkey
         END AS id_usager,
         f.l_partkey AS id_vehicule,
         CAST(coalesce(killed, 0) AS BIGINT) AS nb_tues,
         CAST(coalesce(serious, 0) AS BIGINT) AS nb_blesses_graves,
         CAST(coalesce(slight, 0) AS BIGINT) AS nb_blesses_legers,
         CAST(coalesce(killed + serious + slight, 0) AS BIGINT) AS nb_victimes_total,
         CAST(coalesce(n_lines, 1) AS BIGINT) AS nb_vehicules,
         CAST(coalesce(3 * killed + 2 * serious + slight, 0) AS DOUBLE) AS indice_gravite
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN line_agg a ON a.l_orderkey = o_orderkey
  LEFT JOIN first_line f ON f.l_orderkey = o_orderkey
),
fact AS (SELECT * FROM fact_staging WHERE id_usager IS NOT NULL AND id_vehicule IS NOT NULL)"""

WEATHER_PARTS = """
weather_raw AS (
  SELECT n_regionkey AS id_pays, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(l_quantity) AS DOUBLE) / count(*) - 5.0::DOUBLE AS temp_max,
         CAST(min(l_quantity) AS DOUBLE) AS temp_min,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) - 3.2::DOUBLE AS precipitations,
         10.0::DOUBLE * CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) - 1.0::DOUBLE AS vent
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2
),
weather AS (
  SELECT *, CASE WHEN coalesce(precipitations, 0) > 2.0 THEN 'pluie'
                 WHEN vent >= 40 THEN 'vent_fort'
                 WHEN temp_max >= 20 THEN 'ensoleille' ELSE 'nuageux' END AS conditions
  FROM weather_raw
)"""

COUNTRY_PARTS = """
country AS (SELECT r_regionkey AS id_pays, upper(substr(r_name, 1, 2)) AS code_pays, r_name AS nom_pays FROM region)"""

PLACE_PARTS = """
place AS (
  SELECT c_custkey AS id_lieu, n_regionkey AS id_pays,
         CASE WHEN n_regionkey <= 1 THEN n_name END AS departement,
         CASE WHEN n_regionkey > 1 THEN c_mktsegment END AS district,
         c_mktsegment AS type_route
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

PERSON_PARTS = """
person AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id_usager,
         n_regionkey AS id_pays,
         CASE WHEN min(l_linestatus) = 'O' THEN 'Male' ELSE 'Female' END AS sexe,
         CASE min(l_returnflag) WHEN 'R' THEN 'Killed' WHEN 'A' THEN 'Seriously injured'
              ELSE 'Slightly injured' END AS gravite,
         CASE WHEN l_linenumber <= 3 THEN 'Driver' WHEN l_linenumber <= 5 THEN 'Passenger'
              ELSE 'Pedestrian' END AS cat_usager
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, n_regionkey
)"""

# Easter by the usual Gregorian rule, holidays as in the calendar plan.
HOLIDAY_PARTS = """
easter_h AS (
  SELECT y, y % 19 AS a,
         (19 * (y % 19) + y // 100 - (y // 100) // 4 - (y // 100 - (y // 100 + 8) // 25 + 1) // 3 + 15) % 30 AS h
  FROM (SELECT CAST(unnest(generate_series(1900, 2100)) AS INTEGER) AS y)
),
easter_l AS (
  SELECT *, (32 + 2 * ((y // 100) % 4) + 2 * ((y % 100) // 4) - h - (y % 100) % 4) % 7 AS l FROM easter_h
),
easter AS (
  SELECT y, make_date(y, CAST(p // 31 AS INTEGER), CAST(p % 31 + 1 AS INTEGER)) AS e
  FROM (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS p FROM easter_l)
),
holiday AS (
  SELECT 'FR' AS country, make_date(y, m, d) AS date
  FROM easter, (VALUES (1,1),(5,1),(5,8),(7,14),(8,15),(11,1),(11,11),(12,25)) AS f(m, d)
  UNION SELECT 'FR', CAST(e + n AS DATE) FROM easter, (VALUES (1),(39),(50)) AS o(n)
  UNION SELECT 'UK', CAST(e + n AS DATE) FROM easter, (VALUES (-2),(1)) AS o(n)
  UNION SELECT 'UK', d FROM (SELECT CAST(make_date(y, 5, 1) + k AS DATE) AS d FROM easter, (SELECT unnest(range(7))::INTEGER AS k)) WHERE isodow(d) = 1
  UNION SELECT 'UK', d FROM (SELECT CAST(make_date(y, 5, 25) + k AS DATE) AS d FROM easter, (SELECT unnest(range(7))::INTEGER AS k)) WHERE isodow(d) = 1
  UNION SELECT 'UK', d FROM (SELECT CAST(make_date(y, 8, 25) + k AS DATE) AS d FROM easter, (SELECT unnest(range(7))::INTEGER AS k)) WHERE isodow(d) = 1
  UNION SELECT 'UK', make_date(y, m, d) FROM easter, (VALUES (1,1),(12,25),(12,26)) AS f(m, d)
  UNION SELECT 'UK', CAST(make_date(y, m, d) + CASE isodow(make_date(y, m, d)) WHEN 6 THEN sat WHEN 7 THEN sun ELSE 0 END AS DATE)
        FROM easter, (VALUES (1,1,2,1),(12,25,2,2),(12,26,2,2)) AS f(m, d, sat, sun)
  UNION SELECT 'UK', CAST(x AS DATE) FROM (VALUES ('1999-12-31'),('2002-06-03'),('2011-04-29'),('2012-06-05')) AS o(x)
)"""

CALENDAR_PARTS = (
    HOLIDAY_PARTS
    + """,
days AS (
  SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders)
),
calendar AS (
  SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS id_date, date,
         CAST(year(date) AS INTEGER) AS annee, CAST(month(date) AS INTEGER) AS mois,
         CAST(day(date) AS INTEGER) AS jour, CAST(NULL AS INTEGER) AS heure,
         CASE WHEN month(date) IN (12, 1, 2) THEN 'Hiver' WHEN month(date) IN (3, 4, 5) THEN 'Printemps'
              WHEN month(date) IN (6, 7, 8) THEN 'Ete' ELSE 'Automne' END AS saison,
         isodow(date) >= 6 AS est_weekend,
         date IN (SELECT date FROM holiday WHERE country = 'FR') AS est_jour_ferie
  FROM days
)"""
)


def with_parts(*parts: str, query: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + query


def round2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"
