"""Source-shaped adapter views over the driver's star-schema test tables.

The jobs read SAP/MySQL-shaped tables (FIXTURES.md section 1). The test
data is a TPC-H-like star schema, so each source table is given here as one
SQL view over it. The text is written once and runs unchanged in Spark SQL
and in DuckDB: Spark binds ``{name}`` placeholders to DataFrames, the
oracle turns them into CTE names. The views only shape rows into the source
schema; they do none of the jobs' work.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def lp(expr: str, n: int) -> str:
    return f"lpad(cast({expr} AS string), {n}, '0')"


def _day(expr: str, days: int) -> str:
    return f"cast({expr} AS date)" + (f" + {days}" if days else "")


def dtx(expr: str, days: int = 0) -> str:
    """compact yyyyMMdd text of a timestamp/date expression plus ``days``"""
    return f"replace(cast({_day(expr, days)} AS string), '-', '')"


def dash(expr: str, days: int = 0) -> str:
    """yyyy-MM-dd text of a timestamp/date expression plus ``days``"""
    return f"cast({_day(expr, days)} AS string)"


def mixed(key: str, expr: str) -> str:
    """compact text for even keys, dashed text for odd keys"""
    return f"CASE WHEN {key} % 2 = 0 THEN {dtx(expr)} ELSE {dash(expr)} END"


# The views of one table together keep all rows of it (the hour meter readings
# are dealt to two complementary feeds). Partners that are missing in
# real sources (parts without a text, requisition items without a PO, orders
# without a status profile) are modelled by keys or languages that nothing
# references, so the outer-join and NULL paths of the jobs get data. The second
# branches of three UNIONs add rows of a kind the first branch does not have.
VIEWS: dict[str, str] = {}

# ---- purchasing -----------------------------------------------------------
VIEWS["ekko"] = f"""
SELECT {lp('o_orderkey', 10)} AS ebeln,
       {lp('o_custkey', 10)} AS lifnr,
       {mixed('o_orderkey', 'o_orderdate')} AS bedat,
       'U' || cast(o_custkey % 10 AS string) AS ernam,
       '20' || substr(o_orderpriority, 1, 1) AS ekgrp,
       CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE '' END AS frgrl
FROM {{orders}}"""

# Item grain of lineitem, aggregated with numeric buffers only (so the
# aggregation is hash based): quantities are whole numbers, so their double
# sum is exact; amounts are summed in cents; the return flag is ranked A<N<R.
ITEM_AGG = """SELECT l_orderkey, l_linenumber, max(l_partkey) AS mp, sum(l_quantity) AS q,
         min(l_extendedprice) AS minp, sum(cast(round(l_extendedprice * 100) AS bigint)) AS cents,
         max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS rf
  FROM {lineitem}"""

VIEWS["ekpo"] = f"""
SELECT {lp('l_orderkey', 10)} AS ebeln,
       {lp('l_linenumber * 10', 5)} AS ebelp,
       CASE WHEN l_linenumber = 7 THEN {lp('l_orderkey + 9000000', 10)}
            ELSE {lp('l_orderkey + 5000000', 10)} END AS banfn,
       {lp('l_linenumber * 10', 5)} AS bnfpo,
       CASE WHEN l_orderkey % 31 = 0 THEN '000000000000000000' ELSE {lp('mp', 18)} END AS matnr,
       'item ' || cast(mp AS string) AS txz01,
       cast(q AS decimal(13,3)) AS menge,
       'UN' AS meins,
       CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE cast(minp AS decimal(11,2)) END AS netpr,
       cast(cast(cents AS decimal(18,0)) / 100 AS decimal(13,2)) AS netwr,
       CASE rf WHEN 1 THEN 'K' WHEN 2 THEN '' ELSE 'F' END AS knttp,
       CASE (l_orderkey + l_linenumber) % 11 WHEN 0 THEN 'L' WHEN 1 THEN NULL ELSE '' END AS loekz
FROM ({ITEM_AGG} GROUP BY l_orderkey, l_linenumber) g"""

VIEWS["eban"] = f"""
SELECT {lp('g.l_orderkey + 5000000', 10)} AS banfn,
       {lp('g.l_linenumber * 10', 5)} AS bnfpo,
       CASE WHEN g.l_orderkey % 31 = 0 THEN '000000000000000000' ELSE {lp('g.mp', 18)} END AS matnr,
       'req item ' || cast(g.mp AS string) AS txz01,
       cast(g.q AS decimal(13,3)) AS menge,
       cast(g.minp AS decimal(11,2)) AS preis,
       '20' || cast(g.l_orderkey % 5 + 1 AS string) AS ekgrp,
       'U' || cast((o.o_custkey + 1) % 10 AS string) AS ernam,
       {mixed('o.o_orderkey', 'o.o_orderdate')} AS badat,
       CASE g.rf WHEN 1 THEN 'A' WHEN 2 THEN 'P' ELSE NULL END AS knttp,
       CASE WHEN g.l_orderkey % 13 = 0 THEN 'X' ELSE '' END AS loekz
FROM ({ITEM_AGG} GROUP BY l_orderkey, l_linenumber) g JOIN {{orders}} o ON g.l_orderkey = o.o_orderkey"""

VIEWS["ebkn"] = f"""
SELECT {lp('l_orderkey + 5000000', 10)} AS banfn, {lp('l_linenumber * 10', 5)} AS bnfpo,
       {lp('l_orderkey', 12)} AS aufnr, {lp('l_suppkey', 10)} AS kostl
FROM {{lineitem}}"""

VIEWS["ekkn"] = f"""
SELECT {lp('l_orderkey', 10)} AS ebeln, {lp('l_linenumber * 10', 5)} AS ebelp,
       {lp('l_orderkey', 12)} AS aufnr, {lp('l_suppkey', 10)} AS kostl
FROM {{lineitem}}"""

VIEWS["ekbe"] = f"""
SELECT CASE WHEN l_linestatus = 'F' THEN {lp('l_orderkey', 10)} ELSE {lp('l_orderkey + 9000000', 10)} END AS ebeln, {lp('l_linenumber * 10', 5)} AS ebelp,
       CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS vgabe,
       cast(l_quantity AS decimal(13,3)) AS menge
FROM {{lineitem}}"""

VIEWS["eket"] = f"""
SELECT {lp('l_orderkey', 10)} AS ebeln, {lp('l_linenumber * 10', 5)} AS ebelp,
       {mixed('l_linenumber', 'l_shipdate')} AS eindt
FROM {{lineitem}}"""

VIEWS["lfa1"] = f"""
SELECT {lp('c_custkey', 10)} AS lifnr, c_name AS name1 FROM {{customer}}"""

VIEWS["makt"] = f"""
SELECT CASE WHEN p_partkey % 10 = 9 THEN 'X' || {lp('p_partkey', 17)} ELSE {lp('p_partkey', 18)} END AS matnr,
       'P' AS spras, p_name AS maktx
FROM {{part}}
UNION ALL
SELECT {lp('p_partkey', 18)} AS matnr, CASE WHEN p_size % 2 = 0 THEN 'PT' ELSE 'E' END AS spras,
       p_name || CASE WHEN p_size % 2 = 0 THEN ' PT' ELSE ' EN' END AS maktx
FROM {{part}}"""

VIEWS["mara"] = f"""
SELECT {lp('p_partkey', 18)} AS matnr, p_type AS matkl, 'G' || cast(p_partkey AS string) AS scm_matid_guid16
FROM {{part}}"""

VIEWS["eqkt"] = f"""
SELECT {lp('c_custkey', 18)} AS equnr, 'P' AS spras, c_name AS eqktx FROM {{customer}}
UNION ALL
SELECT {lp('c_custkey', 18)} AS equnr, CASE WHEN c_nationkey % 2 = 0 THEN 'PT' ELSE 'E' END AS spras,
       c_name || CASE WHEN c_nationkey % 2 = 0 THEN ' PT' ELSE ' EN' END AS eqktx
FROM {{customer}}"""

# ---- maintenance orders ---------------------------------------------------
VIEWS["afih"] = f"""
SELECT {lp('o_orderkey', 12)} AS aufnr,
       CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE {lp('o_custkey', 18)} END AS equnr,
       {lp('o_custkey % 25', 8)} AS gewrk,
       CASE o_orderkey % 3 WHEN 0 THEN 'PRP1' WHEN 1 THEN 'OFI1' ELSE 'OUT' END AS ilart,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            WHEN o_orderkey % 7 = 1 THEN '0' || substr(o_orderpriority, 1, 1)
            ELSE substr(o_orderpriority, 1, 1) END AS priok,
       {lp('o_custkey % 20', 8)} AS maintordpersonresponsible
FROM {{orders}}"""

VIEWS["aufk"] = f"""
SELECT {lp('o_orderkey', 12)} AS aufnr,
       'OR' || {lp('o_orderkey', 12)} AS objnr,
       'Ordem ' || cast(o_orderkey AS string) AS ktext,
       {mixed('o_orderkey', 'o_orderdate')} AS erdat,
       'U' || cast(o_custkey % 10 AS string) AS ernam,
       'U' || cast((o_custkey + 3) % 10 AS string) AS aenam,
       'PM0' || cast(o_orderkey % 6 AS string) AS auart,
       CASE WHEN o_custkey % 2 = 0 THEN {lp('o_custkey % 100', 10)} ELSE {lp('o_custkey % 100', 7)} END AS kostl,
       CASE WHEN o_orderstatus <> 'O' THEN {dtx('o_orderdate', 2)} END AS idat1,
       CASE WHEN o_orderstatus = 'F' THEN {dtx('o_orderdate', 20)} END AS idat2,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN {dtx('o_orderdate', 30)} END AS idat3,
       CASE WHEN o_orderkey % 29 = 0 THEN 'X' ELSE '' END AS loekz,
       'X' AS phas0,
       CASE WHEN o_orderstatus <> 'O' THEN 'X' ELSE '' END AS phas1,
       CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE '' END AS phas2,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'X' ELSE '' END AS phas3
FROM {{orders}}"""

VIEWS["crhd"] = f"""
SELECT {lp('n_nationkey', 8)} AS objid,
       CASE n_nationkey % 3 WHEN 0 THEN 'WCA' WHEN 1 THEN 'WCB' ELSE 'OTH' END
         || cast(n_nationkey AS string) AS arbpl
FROM {{nation}}"""

VIEWS["pa0001"] = f"""
SELECT {lp('s_suppkey % 40', 8)} AS pernr, s_name AS ename FROM {{supplier}}"""

VIEWS["afko"] = f"""
SELECT {lp('o_orderkey', 12)} AS aufnr,
       {dtx('o_orderdate')} AS gstrp,
       {dtx('o_orderdate', 10)} AS gltrp,
       CASE WHEN o_orderstatus <> 'O' THEN {dtx('o_orderdate', 1)} END AS gstri,
       CASE WHEN o_orderstatus = 'F' THEN {dtx('o_orderdate', 12)} END AS getri,
       {lp('o_orderkey', 10)} AS aufpl,
       {lp('o_orderkey', 10)} AS rsnum
FROM {{orders}}"""

VIEWS["afvc"] = f"""
SELECT {lp('l_orderkey', 10)} AS aufpl, {lp('l_linenumber', 8)} AS aplzl,
       CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE {lp('l_linenumber * 10', 4)} END AS vornr,
       'Operacao ' || cast(l_partkey AS string) AS ltxa1,
       {lp('l_suppkey % 25', 8)} AS arbid,
       'OV' || {lp('l_orderkey', 10)} || {lp('l_linenumber', 8)} AS objnr
FROM {{lineitem}}"""

VIEWS["afvv"] = f"""
SELECT {lp('l_orderkey', 10)} AS aufpl, {lp('l_linenumber', 8)} AS aplzl,
       cast(l_quantity AS decimal(7,1)) AS arbei
FROM {{lineitem}}"""

VIEWS["jest"] = f"""
SELECT 'OR' || {lp('l_orderkey', 12)} AS objnr,
       CASE l_linenumber % 4 WHEN 0 THEN 'I0001' WHEN 1 THEN 'I0002' WHEN 2 THEN 'E0001' ELSE 'E0002' END AS stat,
       CASE l_returnflag WHEN 'R' THEN 'X' WHEN 'A' THEN NULL ELSE '' END AS inact
FROM {{lineitem}}
UNION ALL
SELECT 'OV' || {lp('l_orderkey', 10)} || {lp('l_linenumber', 8)} AS objnr,
       CASE l_linestatus WHEN 'F' THEN 'I0009' ELSE 'I0045' END AS stat,
       CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE '' END AS inact
FROM {{lineitem}}
UNION ALL
SELECT 'OV' || {lp('l_orderkey', 10)} || {lp('l_linenumber', 8)} AS objnr, 'I0002' AS stat, '' AS inact
FROM {{lineitem}} WHERE l_returnflag = 'A'"""

# status text tables are small code lists
VIEWS["tj02t"] = """
SELECT * FROM (VALUES ('I0001', 'P', 'ABER'), ('I0002', 'P', 'LIB'), ('I0002', 'PT', 'LIBT'),
                      ('I0009', 'P', 'CONF'), ('I0045', 'P', 'ENTE'), ('I0001', 'E', 'CRTD'))
  AS t(istat, spras, txt04)"""

VIEWS["tj30t"] = """
SELECT * FROM (VALUES ('E0001', 'Z1', 'P', 'AGMT', 'Aguardando material'),
                      ('E0002', 'Z1', 'P', 'EXEC', CAST(NULL AS string)),
                      ('E0001', 'Z1', 'E', 'WAIT', 'Waiting for material'),
                      ('E0001', 'Z2', 'P', 'OUTR', 'Outro perfil'))
  AS t(estat, stsma, spras, txt04, txt30)"""

VIEWS["jsto"] = f"""
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'OX' ELSE 'OR' END || {lp('o_orderkey', 12)} AS objnr,
       CASE WHEN o_orderkey % 5 = 0 THEN ' Z1 ' ELSE 'Z1' END AS stsma
FROM {{orders}}"""

VIEWS["resb"] = f"""
SELECT {lp('l_orderkey', 10)} AS rsnum, {lp('l_linenumber', 4)} AS rspos,
       CASE WHEN l_orderkey % 43 = 0 THEN '' ELSE {lp('l_partkey', 18)} END AS matnr,
       cast(l_quantity AS decimal(13,3)) AS bdmng,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE cast(l_quantity * l_discount AS decimal(13,3)) END AS enmng,
       'PL01' AS werks,
       CASE l_suppkey % 3 WHEN 0 THEN 'L01' WHEN 1 THEN 'L02' ELSE 'L09' END AS lgort,
       CASE WHEN l_linenumber % 2 = 0 THEN '201' ELSE '261' END AS bwart,
       CASE WHEN l_partkey % 17 = 0 THEN 'Item não estocável' WHEN l_partkey % 23 = 0 THEN NULL
            ELSE 'Separar ' || cast(l_partkey AS string) END AS sgtxt,
       'REC' || cast(l_suppkey AS string) AS wempf,
       'Doca ' || cast(l_suppkey % 4 AS string) AS ablad,
       'RS' || {lp('l_orderkey', 10)} || {lp('l_linenumber', 4)} AS objnr,
       CASE l_linenumber % 5 WHEN 0 THEN 'X' WHEN 1 THEN NULL ELSE '' END AS xloek,
       CASE WHEN l_linestatus = 'F' THEN 'X' ELSE '' END AS kzear,
       CASE l_returnflag WHEN 'R' THEN 'N' WHEN 'A' THEN 'L' ELSE NULL END AS postp,
       CASE WHEN l_tax > 0.04 THEN 'X' ELSE '' END AS xwaok,
       {lp('l_orderkey', 12)} AS aufnr,
       'UN' AS meins,
       {dtx('l_shipdate')} AS bdter,
       cast(l_extendedprice AS decimal(11,2)) AS gpreis,
       {lp('l_orderkey + 5000000', 10)} AS banfn,
       {lp('l_linenumber * 10', 5)} AS bnfpo
FROM {{lineitem}}"""

VIEWS["rkpf"] = f"""
SELECT {lp('o_orderkey', 10)} AS rsnum,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE {lp('o_orderkey', 12)} END AS aufnr,
       {dtx('o_orderdate')} AS rsdat,
       'U' || cast(o_custkey % 10 AS string) AS usnam,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'U' || cast((o_custkey + 3) % 10 AS string) END AS lastchangedbyuser,
       CASE WHEN o_orderkey % 4 = 0 THEN '0.0000000' ELSE {dtx('o_orderdate', 3)} || '103000.0000000' END
         AS lastchangedatetime
FROM {{orders}}"""

VIEWS["rsadd"] = f"""
SELECT {lp('l_orderkey', 10)} AS rsnum, {lp('l_linenumber', 4)} AS rspos,
       CASE WHEN l_orderkey % 2 = 0 THEN {dtx('l_shipdate')} END AS creadat
FROM {{lineitem}}"""

VIEWS["lips"] = f"""
SELECT CASE WHEN l_linestatus = 'F' THEN {lp('l_orderkey', 10)} ELSE {lp('l_orderkey + 9000000', 10)} END AS rsnum, {lp('l_linenumber', 4)} AS rspos,
       {lp('l_orderkey * 10 + l_linenumber', 10)} AS vbeln
FROM {{lineitem}}"""

VIEWS["t003p"] = """
SELECT 'PM0' || cast(r_regionkey AS string) AS auart, 'P' AS spras, 'Tipo ' || r_name AS txt FROM {region}
UNION ALL
SELECT 'PM0' || cast(r_regionkey AS string) AS auart, 'E' AS spras, 'Type ' || r_name AS txt FROM {region}"""

VIEWS["csks"] = f"""
SELECT CASE WHEN s_suppkey % 2 = 0 THEN {lp('s_suppkey', 10)} ELSE {lp('s_suppkey', 7)} END AS kostl,
       {lp('s_suppkey % 7', 10)} AS prctr
FROM {{supplier}}"""

VIEWS["cepct"] = f"""
SELECT DISTINCT {lp('s_suppkey % 7', 10)} AS prctr, 'Lucro ' || cast(s_suppkey % 7 AS string) AS ltext
FROM {{supplier}}"""

VIEWS["anlh"] = f"""
SELECT ' ' || {lp('s_suppkey', 7)} || ' ' AS anln1, 'Ativo ' || s_name AS anlhtxt FROM {{supplier}}"""

VIEWS["usr21"] = f"""
SELECT DISTINCT 'U' || cast(c_custkey % 10 AS string) AS bname, {lp('c_custkey % 10', 10)} AS persnumber
FROM {{customer}}"""

VIEWS["adrp"] = f"""
SELECT DISTINCT {lp('c_custkey % 10', 10)} AS persnumber, 'Usuario ' || cast(c_custkey % 10 AS string) AS name_text
FROM {{customer}}"""

VIEWS["aqua"] = f"""
SELECT 'G' || cast(l_partkey AS string) AS matid,
       CASE l_returnflag WHEN 'N' THEN ' ' WHEN 'A' THEN 'L1' ELSE NULL END AS charg,
       'P-' || cast(l_suppkey % 5 AS string) AS lgpla,
       cast(l_quantity AS decimal(31,14)) AS quan,
       CASE WHEN l_linestatus = 'F' THEN 'WH1' ELSE 'WH2' END AS lgnum
FROM {{lineitem}}"""

VIEWS["ztwf_log_wf"] = f"""
SELECT CASE WHEN l_partkey % 3 = 0 THEN ' ' ELSE '' END || {lp('l_orderkey', 10)} || {lp('l_linenumber', 4)} AS chave,
       CASE l_returnflag WHEN 'A' THEN 'APROVADO' WHEN 'R' THEN 'REPROVADO' ELSE '' END AS acao,
       CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE {dtx('l_shipdate')} END AS data,
       CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE {lp('l_partkey % 24', 2)} || ':00:00' END AS hora
FROM {{lineitem}}
UNION ALL
SELECT {lp('l_orderkey', 10)} || {lp('l_linenumber', 4)} AS chave, 'PENDENTE' AS acao,
       {dtx('l_shipdate', 1)} AS data, NULL AS hora
FROM {{lineitem}} WHERE l_linestatus = 'O'"""

VIEWS["mseg"] = f"""
SELECT CASE WHEN l_linestatus = 'F' THEN {lp('l_orderkey', 12)} ELSE {lp('l_orderkey + 9000000', 12)} END AS aufnr, {lp('l_orderkey * 10 + l_linenumber', 10)} AS mblnr,
       CASE WHEN l_linenumber % 2 = 0 THEN '261' ELSE '262' END AS bwart,
       {dtx('l_shipdate')} AS budat_mkpf, {lp('l_partkey', 18)} AS matnr,
       'Consumo ' || cast(l_partkey AS string) AS sgtxt,
       cast(l_quantity AS decimal(13,3)) AS menge, 'UN' AS meins,
       cast(l_extendedprice AS decimal(13,2)) AS dmbtr
FROM {{lineitem}}"""

VIEWS["pm_order_view"] = f"""
SELECT {lp('o_custkey', 18)} AS n_equipamento,
       {lp('o_orderkey', 12)} AS n_ordem,
       CASE o_orderkey % 4 WHEN 0 THEN 'PRP' WHEN 1 THEN 'OFI' WHEN 2 THEN NULL ELSE 'INS' END AS cod_tipo_atividade,
       CASE o_orderkey % 4 WHEN 0 THEN 'Preparacao' WHEN 1 THEN 'Oficina'
            WHEN 2 THEN CASE WHEN o_orderkey % 8 = 2 THEN 'PREPARO geral' ELSE 'Servico de OFICINA' END
            ELSE 'Inspecao' END AS tipo_atividade,
       substr(o_orderpriority, 3) AS prioridade,
       CASE o_orderstatus WHEN 'O' THEN 'ABER' WHEN 'P' THEN 'EXEC' ELSE 'ENCE' END AS status_usuario,
       CASE o_custkey % 3 WHEN 0 THEN 'WCA' WHEN 1 THEN 'WCB' ELSE 'OTH' END
         || cast(o_custkey % 10 AS string) AS cod_centro_trabalho,
       CASE WHEN o_orderkey % 61 = 0 THEN '0000-00-00' ELSE {dash('o_orderdate')} END AS data_criacao,
       CASE WHEN o_orderstatus <> 'O' THEN 'X' ELSE '' END AS liberada,
       CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE '' END AS encerrada_tecnicamente,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'X' ELSE '' END AS encerrada_comercialmente,
       'PM0' || cast(o_orderkey % 6 AS string) AS cod_tipo_ordem,
       'Tipo ' || cast(o_orderkey % 6 AS string) AS tipo_ordem,
       'Texto ' || cast(o_orderkey AS string) AS texto_breve,
       substr(o_orderpriority, 1, 1) AS cod_prioridade,
       CASE o_orderstatus WHEN 'O' THEN 'E0001' ELSE 'E0002' END AS cod_status_usuario,
       'LOC-' || cast(o_custkey % 13 AS string) AS local_instalacao,
       'G' || cast(o_custkey % 4 AS string) AS cod_grupo_plan,
       'Grupo ' || cast(o_custkey % 4 AS string) AS grupo_plan,
       {lp('o_orderkey', 12)} AS n_nota,
       {lp('o_custkey % 20', 8)} AS cod_responsavel,
       'Resp ' || cast(o_custkey % 20 AS string) AS responsavel,
       'U' || cast((o_custkey + 5) % 10 AS string) AS cod_ultimo_modificador,
       'u' || cast((o_custkey + 5) % 10 AS string) || '@example.com' AS email_ultimo_modificador,
       CASE WHEN o_orderkey % 5 = 0 THEN '0000-00-00' ELSE {dash('o_orderdate', 4)} END AS data_ultima_modificacao,
       '10:30:00' AS hora_ultima_modificacao,
       CASE WHEN o_orderkey % 5 = 0 THEN '0000-00-00' ELSE {dash('o_orderdate', 4)} || ' 10:30:00' END
         AS datetime_ultima_modificacao,
       CASE WHEN o_orderkey % 3 = 0 THEN 'PL' || cast(o_custkey AS string) END AS n_plano_manutencao,
       'SM' || cast(o_orderkey % 97 AS string) AS n_solicitacao_manutencao,
       'IT' || cast(o_orderkey % 89 AS string) AS n_item_manutencao,
       {lp('o_orderkey', 12)} AS n_ultima_ordem,
       CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE '' END AS aberta,
       CASE WHEN o_orderstatus <> 'O' THEN {dash('o_orderdate', 2)} ELSE '0000-00-00' END AS data_liberada,
       CASE WHEN o_orderstatus = 'F' THEN {dash('o_orderdate', 20)} ELSE '0000-00-00' END AS data_encerrada_tecnicamente,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN {dash('o_orderdate', 30)} ELSE '0000-00-00' END
         AS data_encerrada_comercialmente,
       CASE WHEN o_orderkey % 29 = 0 THEN 'X' ELSE '' END AS marcado_eliminacao,
       CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS check_pipefy,
       {dash('o_orderdate')} AS dt_inicio_base,
       {dash('o_orderdate', 10)} AS dt_fim_base,
       CASE WHEN o_orderkey % 9 = 0 THEN '0000-00-00' ELSE {dash('o_orderdate', 15)} END AS dt_venc_final
FROM {{orders}}"""

# ---- yard, telemetry, receipts, approvals ---------------------------------
VIEWS["fi_ativos"] = f"""
SELECT c_mktsegment AS bu, 'EQP' || cast(c_custkey AS string) AS asset_number, c_name AS descricao,
       'CH' || {lp('c_custkey', 8)} AS chassi, 'Marca ' || cast(c_nationkey AS string) AS marca,
       'Modelo ' || cast(c_custkey % 17 AS string) AS modelo, c_mktsegment AS tipo,
       cast(c_custkey % 5 * 10 AS string) || 't' AS grupo,
       cast(1990 + c_custkey % 30 AS int) AS ano_fabricacao,
       CASE WHEN c_acctbal > 0 THEN 'Ativo' ELSE 'Inativo' END AS status_ativo,
       'LOC-' || cast(c_nationkey AS string) AS local_instalacao
FROM {{customer}}"""

VIEWS["uca_yard"] = f"""
SELECT CASE WHEN o_orderkey % 53 = 0 THEN NULL
            WHEN o_orderkey % 9 = 0 THEN lower('eqp' || cast(o_custkey AS string)) || ' '
            ELSE 'EQP' || cast(o_custkey AS string) END AS asset_no,
       'Tipo ' || o_orderpriority AS tipo_equipamento,
       ' marca ' || cast(o_custkey % 7 AS string) AS marca,
       'modelo ' || cast(o_custkey % 11 AS string) AS modelo,
       'Cliente ' || cast(o_custkey % 50 AS string) AS cliente,
       o_orderstatus AS situacao,
       o_orderdate AS created_at_form,
       cast(o_totalprice AS decimal(12,2)) AS horimetro,
       CASE o_orderkey % 4 WHEN 0 THEN 'N1 - Alpha' WHEN 1 THEN 'North Hub'
            WHEN 2 THEN 'S1 - Beta' ELSE 'S2 - Gamma' END AS filial,
       CASE o_orderstatus WHEN 'F' THEN 'Entrada' WHEN 'O' THEN 'Saída'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Saida' ELSE 'Entrada' END END AS tipo_relatorio
FROM {{orders}}
UNION ALL
SELECT 'EQP' || cast(o_custkey AS string) AS asset_no, 'Tipo ' || o_orderpriority AS tipo_equipamento,
       ' marca ' || cast(o_custkey % 7 AS string) AS marca, 'modelo ' || cast(o_custkey % 11 AS string) AS modelo,
       'Cliente ' || cast(o_custkey % 50 AS string) AS cliente, 'DUP' AS situacao,
       o_orderdate AS created_at_form, cast(o_totalprice AS decimal(12,2)) AS horimetro,
       'N1 - Delta' AS filial, 'Entrada' AS tipo_relatorio
FROM {{orders}} WHERE o_orderpriority = '1-URGENT'"""

VIEWS["hourmeter"] = f"""
SELECT CASE WHEN l.l_partkey % 97 = 0 THEN ''
            WHEN l.l_linenumber = 3 THEN lower('eqp' || cast(o.o_custkey AS string))
            ELSE 'EQP' || cast(o.o_custkey AS string) END AS asset_code,
       o.o_orderdate AS event_datetime,
       CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE cast(l.l_quantity * 10 AS decimal(12,2)) END
         AS equipment_hourmeter,
       cast(l.l_quantity * 2 AS decimal(12,2)) AS panel_hourmeter,
       'CT' || cast(l.l_suppkey AS string) AS contract,
       l.l_shipdate AS updated_at
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag <> 'R'"""

VIEWS["hourmeter_invalid"] = f"""
SELECT CASE WHEN l.l_linenumber = 2 THEN 'eqp' || cast(o.o_custkey AS string) || ' '
            WHEN l.l_suppkey % 10 = 0 THEN 'TRK' || cast(l.l_suppkey AS string)
            ELSE 'EQP' || cast(o.o_custkey AS string) END AS asset_code,
       o.o_orderdate AS event_datetime,
       cast(0 - l.l_quantity AS decimal(12,2)) AS hourmeter,
       'TRK' || cast(l.l_suppkey % 3 AS string) AS source,
       CASE WHEN l.l_linestatus = 'F' THEN 'HOURMETER_NEGATIVE' ELSE 'HOURMETER_JUMP' END AS error_code
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'R'"""

VIEWS["receipts"] = f"""
SELECT CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN {lp('o_orderkey', 8)} ELSE NULL END
         AS requisicao_de_compra_os,
       o_custkey AS requisicao_de_compra_id,
       CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE '' END || cast(o_orderkey % 5000 AS string) AS pedido,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS data_recebimento
FROM {{orders}}"""

VIEWS["requisitions"] = f"""
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE {lp('c_custkey * 7', 10)} END AS numero_pedido_gerado
FROM {{customer}}"""

VIEWS["approvals"] = f"""
SELECT CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END || {lp('user_id', 10)} AS numeropedido,
       'Aprovador ' || cast(event_id % 7 AS string) AS nomeaprovador,
       {dash('ts')} AS datainicio,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE {lp('hour(ts)', 2)} || ':00:00' END AS horarioinicioaprovacao,
       CASE WHEN event_type IN ('purchase', 'click') THEN {lp('(hour(ts) + 1) % 24', 2)} || ':30:00' END
         AS horariofinalaprovacao,
       CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'view' THEN 'READY' WHEN 'purchase' THEN 'COMPLETED'
            WHEN 'error' THEN 'FAILED' ELSE CASE WHEN event_id % 2 = 0 THEN 'CANCELLED' ELSE 'ON_HOLD' END END AS statusfluxoaprovacao,
       CASE WHEN event_type IN ('purchase', 'click') THEN {dash('ts')} END AS datafinal
FROM {{events}}"""


def _deps(sql: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(sql) if f]


def closure(names: Iterable[str]) -> list[str]:
    """Views needed for ``names`` in dependency order (views only)."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out or n in BASE_TABLES:
            return
        for d in _deps(VIEWS[n]):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def load_base(spark: SparkSession, sf_dir: str, names: Iterable[str] = BASE_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def star_tables(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Source-shaped DataFrames ``names`` built from the parquet tables in ``sf_dir``."""
    needed = closure(names)
    base_needed = sorted({d for n in needed for d in _deps(VIEWS[n]) if d in BASE_TABLES})
    frames: dict[str, DataFrame] = load_base(spark, sf_dir, base_needed)
    for n in needed:
        sql = VIEWS[n]
        frames[n] = spark.sql(sql, **{d: frames[d] for d in set(_deps(sql))})
    return {n: frames[n] for n in names}


def oracle_ctes(names: Iterable[str]) -> str:
    """``WITH`` clause defining ``names`` (and their dependencies) for DuckDB."""
    parts = []
    for n in closure(names):
        sql = VIEWS[n]
        body = sql.format(**{d: d for d in _deps(sql)})
        parts.append(f"{n} AS ({body}\n)")
    return "WITH " + ",\n".join(parts)
