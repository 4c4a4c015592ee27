"""DuckDB SQL giving the expected result of each contract query.

Each statement reads the driver's tables directly (views ``orders``,
``lineitem``, …) and computes what the Spark query must return, including
the dirt the Spark side injects while building pages, files and archives.
Column names and types match :mod:`sentinela.plans.queries`.
"""

from __future__ import annotations

from sentinela.fixed import MONTHS, TEXT_REPAIRS


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _orders_by_nation() -> str:
    return (
        "o AS (SELECT o_orderpriority || '/' || (c_custkey // 2000) AS disease, CAST(year(o_orderdate) AS INTEGER) AS y, "
        "CAST(month(o_orderdate) AS INTEGER) AS m, o_orderstatus AS st, c_nationkey AS nk "
        "FROM orders JOIN customer ON o_custkey = c_custkey)"
    )


def _kind(alias: str) -> str:
    """Layout of a (disease, year) page: the disease's latest year partial."""
    latest = f"(SELECT max(o2.y) FROM o AS o2 WHERE o2.disease = {alias}.disease)"
    return f"CASE WHEN {alias}.y = {latest} THEN 'partial' WHEN {alias}.y % 2 = 0 THEN 'wide' ELSE 'shifted' END"


HTML_TABLE_EXTRACT = """
WITH c AS (
  SELECT c_nationkey AS page_nation, CAST(c_custkey // 50 AS BIGINT) AS page_block, c_custkey, c_name,
         CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents, c_mktsegment
  FROM customer)
SELECT page_nation, page_block, CAST(-1 AS INTEGER) AS row_index,
       'Cliente' AS c0, 'Cliente' AS c1, 'Saldo' AS c2, 'Segmento' AS c3
FROM c GROUP BY page_nation, page_block
UNION ALL
SELECT page_nation, page_block,
       CAST(row_number() OVER (PARTITION BY page_nation, page_block ORDER BY c_custkey) - 1 AS INTEGER),
       CAST(page_nation AS VARCHAR), c_name, cents, c_mktsegment || ' & ' || CAST(page_nation AS VARCHAR)
FROM c
"""


def _layout_extract() -> str:
    counts = []
    cols = []
    for m in range(1, 13):
        counts += [
            f"count(*) FILTER (WHERE m = {m}) AS v{3 * m - 2}",
            f"count(*) FILTER (WHERE m = {m} AND st = 'F') AS v{3 * m - 1}",
            f"count(*) FILTER (WHERE m = {m} AND st = 'O') AS v{3 * m}",
        ]
    for k in range(1, 37):
        cols.append(
            f"CASE WHEN kind = 'partial' AND {k} > 15 THEN '0' WHEN v{k} = 0 THEN '0' "
            f"ELSE CAST(v{k} AS VARCHAR) END AS coluna_{k}"
        )
    return f"""
WITH {_orders_by_nation()},
cnt AS (SELECT disease, y, nk, {", ".join(counts)} FROM o GROUP BY disease, y, nk),
r AS (SELECT cnt.*, n_name, {_kind("cnt")} AS kind
      FROM cnt JOIN nation ON nk = n_nationkey JOIN region ON n_regionkey = r_regionkey
      WHERE r_name = 'AMERICA')
SELECT disease,
       CASE WHEN kind = 'shifted' THEN CAST(nk AS VARCHAR) || ' ' || n_name ELSE n_name END AS coluna_0,
       {", ".join(cols)},
       CAST(y AS VARCHAR) AS coluna_37
FROM r
"""


UNZIP_MEMBERS = """
SELECT 'orders_' || year(o_orderdate) || '_' || (o_orderkey // 5000) || '.zip' AS archive,
       'orders_' || year(o_orderdate) || '_' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
         || '_' || (o_orderkey // 5000) || '.csv' AS name,
       CAST(row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate), o_orderkey // 5000
                               ORDER BY o_orderkey) - 1 AS INTEGER) AS line_no,
       concat_ws(';', o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d')) AS line
FROM orders
"""

DELIMITED_CLEAN = """
WITH l AS (
  SELECT *, 'lineitem_' || strftime(l_shipdate, '%Y-%m') || '_' || (l_orderkey // 2000) || '.CSV' AS name,
         CAST(8 + row_number() OVER (PARTITION BY strftime(l_shipdate, '%Y-%m'), l_orderkey // 2000
                                     ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity,
                                              l_extendedprice, l_discount, l_tax) AS INTEGER) AS line_no
  FROM lineitem)
SELECT name, line_no,
       CASE WHEN l_linenumber = 7 THEN 'lixo' ELSE strftime(l_shipdate, '%Y/%m/%d') END AS data,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_discount END AS precipitacao_total,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END AS pressao_atmosferica_max,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS pressao_atmosferica_min,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_tax END AS temp_max,
       CASE WHEN l_linenumber = 4 OR l_partkey % 10 = 0 THEN NULL ELSE l_quantity - 10 END AS temp_min,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_partkey % 100 AS DOUBLE) END AS umidade_relativa_ar
FROM l WHERE l_linenumber NOT IN (5, 6)
"""

DELIMITED_SPLIT = DELIMITED_CLEAN.replace("l_orderkey // 2000", "l_orderkey // 100000").replace("AS INTEGER) AS line_no", "AS BIGINT) AS line_no")

QUOTED_BREAKS = r"""
WITH o AS (SELECT o_orderkey AS k, o_custkey, o_totalprice, o_orderstatus,
                  'notas_' || year(o_orderdate) || '_' || (o_orderkey // 100000) || '.csv' AS name,
                  'nota ' || o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || 'segue' ELSE '' END
                    || CASE WHEN o_orderkey % 7 = 0 THEN ' "dito"' ELSE '' END || CASE WHEN o_orderkey % 11 = 0 THEN '; outro' ELSE '' END
                    || CASE WHEN o_orderkey % 13 = 0 THEN chr(10) || chr(10) || 'fim' ELSE '' END AS note,
                  1 + (o_orderkey % 5 = 0)::INT + 2 * (o_orderkey % 13 = 0)::INT + (o_orderkey % 17 = 0)::INT AS lines FROM orders),
r AS (SELECT *, coalesce(sum(lines) OVER (PARTITION BY name ORDER BY k, o_custkey, o_totalprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM o),
f AS (SELECT name, sum(lines) AS lines FROM o GROUP BY name)
SELECT name, CAST(3 + before AS BIGINT) AS line_no, CAST(k AS VARCHAR) AS c0, note AS c1, o_orderstatus AS c2 FROM r
UNION ALL SELECT name, CAST(2 AS BIGINT), 'chave', 'nota', 'estado' FROM f
UNION ALL SELECT name, CAST(3 + lines AS BIGINT), 'aberta;"sem fim', 'X', NULL FROM f
UNION ALL SELECT name, CAST(4 + lines AS BIGINT), 'ultima', 'linha', 'Z' FROM f
"""

INFERRED_LAYER = """
WITH m AS (SELECT max(o_orderkey) AS last FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey ELSE -1 END AS inteiro_com_falta, o_totalprice,
       CASE WHEN o_orderkey = last THEN 'n/d?' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS texto_tardio,
       o_orderkey % 2 = 0 AS par,
       CASE WHEN o_orderkey = last THEN CAST(7.5 AS DOUBLE) ELSE CAST(o_orderkey % 10 AS DOUBLE) END AS decimal_tardio,
       strftime(o_orderdate, '%Y-%m-%d') AS data
FROM orders, m
"""

REPLACE_DICTIONARY = """
WITH d AS (SELECT 'k' || (2 * i) AS old, CASE WHEN i % 10 <> 0 THEN 'v' || i END AS new FROM range(100000) t(i)),
c AS (SELECT o_orderkey, o_totalprice, 'k' || (o_orderkey % 300000) AS p, CASE WHEN o_custkey % 5 <> 0 THEN 'k' || (o_custkey % 7) END AS s FROM orders)
SELECT o_orderkey, o_totalprice, CASE WHEN d1.old IS NOT NULL THEN d1.new ELSE p END AS primeira,
       CASE WHEN d2.old IS NOT NULL THEN d2.new ELSE s END AS segunda
FROM c LEFT JOIN d d1 ON p = d1.old LEFT JOIN d d2 ON s = d2.old
"""

LAYOUTS_BY_NAME = "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN (p_partkey % 200) % {i} = 0 OR (p_partkey + {i}) % 11 = 0 THEN '0' ELSE p_size || '/{i}' END AS col_{i}" for i in range(2, 10)
) + " FROM part"

DATE_FORMATS = """
WITH o AS (SELECT o_custkey % 50 AS fonte, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d,
                  CASE WHEN o_orderkey % 17 = 0 THEN 2 WHEN ((o_custkey % 50) % 2 = 0) <> (o_orderkey % 10 = 3) THEN 0 ELSE 1 END AS f FROM orders),
v AS (SELECT fonte, arg_min(f, o_orderkey * 4 + f) AS first FROM o GROUP BY fonte)
SELECT o.fonte, o_orderkey, o_totalprice, CASE WHEN f < 2 AND (first = 2 OR f = first) THEN strftime(d, '%Y-%m-%d') END AS data FROM o JOIN v ON o.fonte = v.fonte
"""

YEARLY_WINDOWS = """
WITH oc AS (SELECT o_orderdate, o_orderstatus, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey),
b AS (SELECT c_nationkey, n_name AS cidade, CAST(min(o_orderdate) AS DATE) AS s,
             last_day(CAST(max(o_orderdate) AS DATE)) AS e
      FROM oc JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey, n_name),
w AS (SELECT c_nationkey, cidade, s, e,
             CAST(unnest(generate_series(date_trunc('year', s), date_trunc('year', e), INTERVAL 1 YEAR)) AS DATE) AS y
      FROM b),
x AS (SELECT c_nationkey, cidade, greatest(y, s) AS window_start,
             least(CAST(y + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE), e) AS window_end FROM w)
SELECT cidade, window_start, window_end,
       'INMET_' || cidade || '_' || strftime(window_start, '%d-%m-%Y') || '_A_' || strftime(window_end, '%d-%m-%Y') || '.CSV' AS name,
       EXISTS (SELECT 1 FROM oc WHERE oc.c_nationkey = x.c_nationkey AND oc.o_orderstatus = 'P'
               AND year(oc.o_orderdate) = year(x.window_start)) AS found
FROM x
"""

LAYER_ROUNDTRIP = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem
"""

PUBLISH_REPLACE = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ano_mes, o_orderstatus, count(*) AS qtd
FROM orders GROUP BY ALL
"""

RENAME_LABEL = """
SELECT c_custkey AS id_cliente, c_name AS nome, c_nationkey AS nacao, c_acctbal AS saldo_conta,
       c_mktsegment, 'cliente' AS caso
FROM customer
"""

REGION_FILTER_STRIP = """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, r_name
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT c_custkey,
             CASE c_custkey % 3 WHEN 0 THEN r_name WHEN 1 THEN lower(r_name) ELSE r_name || ' ' END AS regiao,
             CASE c_custkey % 4 WHEN 0 THEN c_nationkey || ' ' || c_name WHEN 1 THEN c_name
                                WHEN 2 THEN c_nationkey || '  ' || c_name
                                ELSE 'a ' || c_nationkey || ' ' || c_name END AS municipio
      FROM c)
SELECT c_custkey, regiao, regexp_replace(municipio, '^[0-9]+ ', '') AS municipio
FROM x WHERE upper(regiao) = 'ASIA'
"""

MONTHS_TO_ROWS = """
SELECT n_name AS municipio_resid,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS ano_mes,
       CAST(count(*) + CASE WHEN c_nationkey % 5 = 0 THEN 9007199254740992 ELSE 0 END AS BIGINT) AS casos
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, c_nationkey, make_date(year(o_orderdate), month(o_orderdate), 1)
"""

DAILY_ROLLUP = """
WITH h AS (SELECT l_linenumber AS ln, CAST(l_shipdate AS DATE) AS d, day(l_shipdate) = 13 AS void,
                  l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
SELECT d AS data,
       round(coalesce(sum(CASE WHEN void THEN NULL ELSE l_quantity END), 0), 6) AS precipitacao_total,
       round(max(CASE WHEN void THEN NULL ELSE l_extendedprice END), 6) AS pressao_atmosferica_max,
       round(min(CASE WHEN void THEN NULL ELSE l_discount END), 6) AS pressao_atmosferica_min,
       round(max(CASE WHEN void THEN NULL ELSE l_tax END), 6) AS temp_max,
       round(min(CASE WHEN void THEN NULL ELSE l_quantity END), 6) AS temp_min,
       round(avg(CASE WHEN void OR ln = 3 THEN NULL ELSE l_quantity END), 6) AS umidade_relativa_ar
FROM h WHERE ln <> 7 GROUP BY d
"""


def _union_layouts() -> str:
    names = list(MONTHS)
    filters = ", ".join(f"count(*) FILTER (WHERE m = {i}) AS {n}" for i, n in enumerate(names, start=1))
    cols = ", ".join(
        f"CASE WHEN y = (SELECT max(oc2.y) FROM oc AS oc2 WHERE oc2.nacao = cnt.nacao) AND {i} > 5 THEN '0' "
        f"WHEN {n} = 0 THEN '0' ELSE CAST({n} AS VARCHAR) END AS {n}"
        for i, n in enumerate(names, start=1)
    )
    return f"""
WITH oc AS (SELECT n_name AS nacao, year(o_orderdate) AS y, month(o_orderdate) AS m
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
cnt AS (SELECT nacao, y, {filters} FROM oc GROUP BY nacao, y)
SELECT nacao, CAST(y AS VARCHAR) AS ano, {cols} FROM cnt
"""


def _replace_values() -> str:
    good = _sql_list(TEXT_REPAIRS.values())
    bad = _sql_list(TEXT_REPAIRS.keys())
    n = len(TEXT_REPAIRS)
    return f"""
SELECT p_partkey,
       CASE WHEN p_size % 2 = 0 THEN {bad}[p_partkey % {n} + 1] ELSE {good}[p_partkey % {n} + 1] END AS cidade_original,
       {good}[p_partkey % {n} + 1] AS cidade_mapa,
       {good}[p_partkey % {n} + 1] AS cidade_auto
FROM part
"""


def _monthly_spine(src: str, key: str, cols: list[str]) -> str:
    avgs = ", ".join(f"avg({c}) AS {c}" for c in cols)
    outs = ", ".join(f"round(coalesce(mo.{c}, 0), 6) AS {c}" for c in cols)
    return f"""
monthly AS (SELECT {key}, CAST(date_trunc('month', d) AS DATE) AS m, {avgs} FROM {src} GROUP BY ALL),
b AS (SELECT {key}, min(m) AS lo, max(m) AS hi FROM monthly GROUP BY ALL),
spine AS (SELECT {key}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS m FROM b)
SELECT spine.{key}, spine.m AS data, {outs}
FROM spine LEFT JOIN monthly mo ON spine.{key} = mo.{key} AND spine.m = mo.m
"""


MONTHLY_MEAN_FILLED = """
WITH daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, coalesce(sum(o_totalprice), 0) AS total,
                      max(o_totalprice) AS maior, min(o_totalprice) AS menor, avg(o_totalprice) AS media
               FROM orders GROUP BY ALL),
""" + _monthly_spine("daily", "o_custkey", ["total", "maior", "menor", "media"])

LENIENT_NUMBER = """
SELECT event_id,
       CASE event_id % 10 WHEN 4 THEN value WHEN 5 THEN CAST(1000 AS DOUBLE) WHEN 7 THEN CAST(0.5 AS DOUBLE)
                          WHEN 9 THEN value ELSE CAST(NULL AS DOUBLE) END AS numero
FROM events
"""


MONTHLY_MEAN_ALL = """
WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS total, max(o_totalprice) AS maior FROM orders GROUP BY ALL),
monthly AS (SELECT CAST(date_trunc('month', d) AS DATE) AS m, avg(total) AS total, avg(maior) AS maior FROM daily GROUP BY ALL),
spine AS (SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m FROM monthly)
SELECT spine.m AS data, round(coalesce(total, 0), 6) AS total, round(coalesce(maior, 0), 6) AS maior
FROM spine LEFT JOIN monthly ON spine.m = monthly.m
"""

SORTED_MONTHS = f"""
WITH {_orders_by_nation()},
towns AS (SELECT DISTINCT disease, y, nk FROM o JOIN nation ON nk = n_nationkey JOIN region ON n_regionkey = r_regionkey
          WHERE r_name = 'AMERICA'),
s AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
SELECT 'casos' AS saida, CAST(12 * count(*) AS BIGINT) AS linhas, CAST(0 AS BIGINT) AS fora_de_ordem FROM towns
UNION ALL
SELECT 'medias', CAST(12 * (year(hi) - year(lo)) + month(hi) - month(lo) + 1 AS BIGINT), CAST(0 AS BIGINT) FROM s
"""

PAGES_FROM_FILES = f"""
WITH {_orders_by_nation()},
page AS (SELECT disease, y, count(DISTINCT nk) AS towns, {_kind("o")} AS kind FROM o GROUP BY disease, y)
SELECT CASE ascii(disease) % 3 WHEN 0 THEN 'dengue' WHEN 1 THEN 'chikungunya' ELSE 'zika' END AS disease,
       CAST(y + 30 AS INTEGER) AS year, count(*) AS paginas,
       CAST(sum(5 + towns + CASE WHEN kind = 'shifted' THEN 1 ELSE 0 END) AS BIGINT) AS linhas
FROM page GROUP BY ALL
"""

LAND_ALL_MEMBERS = """
WITH l AS (SELECT 'SE_XX_A' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') || 'B' || (l_orderkey // 200000) AS cidade,
                  l_suppkey // 25 AS block, l_orderkey // 200000 AS part, CAST(l_shipdate AS DATE) AS d FROM lineitem),
b AS (SELECT cidade, last_day(max(d)) AS e FROM l GROUP BY cidade),
f AS (SELECT DISTINCT cidade, block, part, year(d) AS y FROM l),
m AS (SELECT y || '_' || block || '_' || part || '.zip' AS archive, y, cidade,
             'INMET_' || cidade || '_01-01-' || y || '_A_' || strftime(least(make_date(y, 12, 31), e), '%d-%m-%Y') || '.CSV' AS name
      FROM f JOIN b USING (cidade)),
a AS (SELECT DISTINCT archive, y FROM m)
SELECT archive, y || '/' || name AS member, name, cidade, true AS lido FROM m
UNION ALL
SELECT archive, y || '/notas.csv', 'notas.csv', '__other__', true FROM a
UNION ALL
SELECT archive, 'LEIA-ME.txt', 'LEIA-ME.txt', '__other__', true FROM a
"""

CASES_LAYERS = f"""
WITH {_orders_by_nation()},
cnt AS (SELECT disease, y, nk, m, count(*) AS n FROM o GROUP BY ALL),
present AS (SELECT DISTINCT disease, y, nk FROM o),
r AS (SELECT p.disease, p.y, p.nk, n_name, {_kind("p")} AS kind
      FROM present p JOIN nation ON p.nk = n_nationkey JOIN region ON n_regionkey = r_regionkey
      WHERE r_name = 'AMERICA'),
rm AS (SELECT r.*, CAST(unnest(range(1, 13)) AS INTEGER) AS mm FROM r)
SELECT CASE WHEN kind = 'shifted' THEN CAST(rm.nk AS VARCHAR) || ' ' || n_name ELSE n_name END AS municipio_resid,
       make_date(rm.y, rm.mm, 1) AS ano_mes,
       CAST(CASE WHEN kind = 'partial' AND rm.mm > 5 THEN 0 ELSE coalesce(cnt.n, 0) END AS BIGINT) AS qtd_casos,
       rm.disease AS caso
FROM rm
LEFT JOIN cnt ON cnt.disease = rm.disease AND cnt.y = rm.y AND cnt.nk = rm.nk AND cnt.m = rm.mm
"""

CLIMATE_LAYERS = """
WITH l AS (
  SELECT 'SE_XX_A' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') || 'B' || (l_orderkey // 200000) AS cidade, CAST(l_shipdate AS DATE) AS d,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_discount END AS p,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END AS pmax,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS pmin,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_tax END AS tmax,
         CASE WHEN l_linenumber = 4 OR l_partkey % 10 = 0 THEN NULL ELSE l_quantity - 10 END AS tmin,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_partkey % 100 AS DOUBLE) END AS u
  FROM lineitem WHERE l_linenumber NOT IN (5, 6, 7)),
daily AS (SELECT cidade, d, coalesce(sum(p), 0) AS precipitacao_total, max(pmax) AS pressao_atmosferica_max,
                 min(pmin) AS pressao_atmosferica_min, max(tmax) AS temp_max, min(tmin) AS temp_min,
                 avg(u) AS umidade_relativa_ar
          FROM l GROUP BY ALL),
""" + _monthly_spine(
    "daily", "cidade",
    ["precipitacao_total", "pressao_atmosferica_max", "pressao_atmosferica_min", "temp_max", "temp_min", "umidade_relativa_ar"],
)


CLIMATE_DAMAGED = CLIMATE_LAYERS.replace("FROM lineitem WHERE", """FROM lineitem
  WHERE NOT (year(l_shipdate) = (SELECT year(min(l_shipdate)) + 1 FROM lineitem) AND l_suppkey // 25 = 0 AND l_orderkey // 200000 = 0) AND""")

CASES_RERUN = f"SELECT * FROM ({CASES_LAYERS}) WHERE caso NOT LIKE '1-URGENT%'"


ORACLE_SQL: dict[str, str] = {
    "html_table_extract": HTML_TABLE_EXTRACT,
    "layout_extract": _layout_extract(),
    "unzip_members": UNZIP_MEMBERS,
    "land_stream": UNZIP_MEMBERS,
    "delimited_clean": DELIMITED_CLEAN,
    "yearly_windows": YEARLY_WINDOWS,
    "layer_roundtrip": LAYER_ROUNDTRIP,
    "publish_replace": PUBLISH_REPLACE,
    "rename_label": RENAME_LABEL,
    "region_filter_strip": REGION_FILTER_STRIP,
    "months_to_rows": MONTHS_TO_ROWS,
    "daily_rollup": DAILY_ROLLUP,
    "union_layouts": _union_layouts(),
    "replace_values": _replace_values(),
    "monthly_mean_filled": MONTHLY_MEAN_FILLED,
    "lenient_number": LENIENT_NUMBER,
    "cases_layers": CASES_LAYERS,
    "cases_rerun": CASES_RERUN,
    "cases_incremental": CASES_LAYERS,
    "pages_from_files": PAGES_FROM_FILES,
    "land_all_members": LAND_ALL_MEMBERS,
    "monthly_mean_all": MONTHLY_MEAN_ALL,
    "sorted_months": SORTED_MONTHS,
    "climate_layers": CLIMATE_LAYERS,
    "climate_damaged": CLIMATE_DAMAGED,
    "delimited_split": DELIMITED_SPLIT,
    "quoted_breaks": QUOTED_BREAKS,
    "inferred_layer": INFERRED_LAYER,
    "replace_dictionary": REPLACE_DICTIONARY,
    "layouts_by_name": LAYOUTS_BY_NAME,
    "date_formats": DATE_FORMATS,
}
