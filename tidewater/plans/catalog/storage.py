"""Catalogue: jobs that are about stored data (B4 to B6 staging, B22 publishing, K2 to K15 over existing targets, S5, A6, B39).

Driver tables are written out as the files a job finds, the job runs on them, and the query returns what it has stored, read back.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import distinct_counts
from tidewater.plans import energy, projects, sport
from tidewater.plans.catalog import Tables, register
from tidewater.session import shared_dir
from tidewater.sources import (PathPart, evolve_table, publish, read_evolved, read_table, read_target, read_version, write_audited, write_table)
from tidewater.sources.snapshots import stage_version
from tidewater.streaming.incremental import reprocess_years

COST_EXPORT = {"hidro": "string", "year": "int", "mes": "int", "barnom": "bigint", "valor": "double"}


@register("marginal_cost_staging", """
SELECT 'cmg' || l_returnflag AS tabla, 'E' || CAST(l_linenumber AS VARCHAR) AS hidrologia, CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(month(l_shipdate) AS INTEGER) AS mes,
       l_partkey AS nombre_barra, l_extendedprice AS valor, '01-' || CAST(month(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) AS VARCHAR) AS fecha,
       CAST(year(l_shipdate) AS INTEGER) AS year_partition, 'E' || CAST(l_linenumber AS VARCHAR) AS escenario_partition, '1999' AS "yearParticion"
FROM lineitem
""")
def marginal_cost_staging(spark, d):
    """B4, both halves: lines as exports of one scenario (line number) and one table (return flag) per folder; one staging run routes them to
    three tables, of which each goes through ``projected_marginal_cost``."""
    raw, staging = shared_dir(spark, "cost_exports"), shared_dir(spark, "cost_staging")
    li = Tables(spark, d).lineitem
    esc = F.concat(F.lit("E"), F.col("l_linenumber").cast("string"))
    exports = li.select(esc.alias("hidro"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("mes"), F.col("l_partkey").alias("barnom"),
                        F.col("l_extendedprice").alias("valor"), esc.alias("esc"), F.concat(F.lit("cmg"), "l_returnflag", F.lit("_x")).alias("t"))
    write_table(exports, raw, fmt="csv", sep=";", compression="none", partition_by=["esc", "t"])
    parts = {"escenario_partition": PathPart(0, after="esc="), "tabla": PathPart(1, after="t=", before="_")}
    energy.stage_marginal_cost(spark, raw, staging, COST_EXPORT, 1997, parts, sep=";")
    out = None
    for name in ("cmgA", "cmgN", "cmgR"):
        staged = read_target(spark, staging, "tabla", name, ["year_partition", "escenario_partition"])
        done = energy.projected_marginal_cost(staged.drop("year_partition", "escenario_partition"), load_year=1999).withColumn("tabla", F.lit(name))
        out = done if out is None else out.unionByName(done)
    return out


@register("supply_staging", """
WITH w AS (
  SELECT o_orderpriority AS escenario, 'Región ' || CAST(o_custkey % 7 AS VARCHAR) AS region, 'T ' || o_orderstatus AS tecnologia,
         CAST(year(o_orderdate) AS BIGINT) AS ano, CAST(o_custkey AS BIGINT) AS potencia,
         CASE WHEN o_orderstatus = 'F' THEN 'X' WHEN o_orderstatus = 'P' THEN 'P' END AS tipo_plp FROM orders),
k AS (SELECT * FROM w WHERE tipo_plp IS DISTINCT FROM 'X'),
grid AS (SELECT * FROM (SELECT DISTINCT escenario FROM k) CROSS JOIN (SELECT DISTINCT region FROM k) CROSS JOIN (SELECT DISTINCT tecnologia FROM k)
         CROSS JOIN (SELECT unnest(generate_series(min(ano), max(ano))) AS ano FROM k)),
s AS (SELECT escenario, region, tecnologia, ano, sum(potencia) AS potencia FROM k GROUP BY ALL)
SELECT g.escenario, g.region, g.tecnologia, g.ano, CAST(coalesce(s.potencia, 0) AS BIGINT) AS potencia, g.ano AS year, '1999' AS "yearParticion"
FROM grid g LEFT JOIN s ON g.escenario = s.escenario AND g.region = s.region AND g.tecnologia = s.tecnologia AND g.ano = s.ano
""")
def supply_staging(spark, d):
    """B5, both halves: orders as a works plan with raw headers; the plan is staged typed and with cleaned names, and
    densified by ``projected_supply``."""
    raw, staging = shared_dir(spark, "supply_exports"), shared_dir(spark, "supply_staging")
    o = Tables(spark, d).orders
    kind = F.when(F.col("o_orderstatus") == "F", "X").when(F.col("o_orderstatus") == "P", "P")
    plan = o.select(F.concat(F.lit("T "), "o_orderstatus").alias("a"), F.concat(F.lit("Región "), (F.col("o_custkey") % 7).cast("string")).alias("b"),
                    F.col("o_orderkey").cast("string").alias("c"), F.col("o_custkey").alias("e"), F.lit("B").alias("f"), kind.alias("g"),
                    F.year("o_orderdate").alias("h"), F.col("o_orderpriority").alias("i")).toDF(*energy.SUPPLY_EXPORT)
    write_table(plan, f"{raw}/2021/plan", fmt="csv", sep=";", compression="none")
    energy.stage_supply(spark, raw, staging, 1997, name_part="part-", sep=";")
    works = read_target(spark, staging, "tabla", "plan_de_obras", ["year"]).drop("year")
    return energy.projected_supply(works, load_year=1999).select("escenario", "region", "tecnologia", "ano", "potencia", "year", "yearParticion")


@register("demand_staging", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'alto' ELSE 'medio' END AS escenario, CAST(o_orderkey AS VARCHAR) AS nombre_barra_proyeccion, o_orderpriority AS nombre_barra,
       CAST(year(o_orderdate) AS INTEGER) AS year, 'm' || CAST(month(o_orderdate) AS VARCHAR) AS nombre_mes, CAST(month(o_orderdate) AS INTEGER) AS mes,
       o_totalprice AS medida_horaria, CAST(NULL AS VARCHAR) AS registro_romano, o_orderpriority AS registro_numerico,
       CAST(year(o_orderdate) AS VARCHAR) AS anio, '1999' AS "yearParticion"
FROM orders
""")
def demand_staging(spark, d):
    """B6, both halves: orders as exports of two tables, one folder per table and year; one staging run, then the two tables tagged
    and appended by ``projected_demand``."""
    raw, staging = shared_dir(spark, "demand_exports"), shared_dir(spark, "demand_staging")
    o = Tables(spark, d).orders
    given = {"BARRA_PROYECCION": F.col("o_orderkey").cast("string"), "nombre_barra": F.col("o_orderpriority"), "Año": F.year("o_orderdate"),
             "Tag_Mes": F.concat(F.lit("m"), F.month("o_orderdate").cast("string")), "Mes": F.month("o_orderdate"), "MedidaHoraria2": F.col("o_totalprice"),
             "Reg. Num": F.col("o_orderpriority")}
    rows = o.select(*[given.get(c, F.lit(None).cast(t)).alias(c) for c, t in energy.DEMAND_EXPORT.items()],
                    F.year("o_orderdate").alias("y"), F.when(F.col("o_orderstatus") == "F", "alto").otherwise("medio").alias("t"))
    write_table(rows, f"{raw}/plan/demanda", fmt="csv", sep=";", compression="none", partition_by=["y", "t"])
    energy.stage_demand(spark, raw, staging, {"year": PathPart(2, after="y="), "tabla": PathPart(3, after="t=")}, sep=";")
    keep = ["barra_proyeccion", "nombre_barra", "ano", "tag_mes", "mes", "MedidaHoraria2", "reg_rom_", "reg_num"]
    tables = {name: read_target(spark, staging, "tabla", name, ["year"]).select(*keep) for name in ("alto", "medio")}
    return energy.projected_demand(tables, load_year=1999)


@register("schema_evolution", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority,
       o_orderstatus
FROM orders
""")
def schema_evolution(spark, d):
    """K6/K7: orders appended in three writes to one partitioned target: 32-bit keys and floats first, then without a column, then with
    wider types and a new column. Read through the catalog table that follows the schema."""
    path, table = shared_dir(spark, "evolved"), "tidewater_evolved_" + shared_dir(spark, "t").rsplit("-", 1)[-1]
    o = Tables(spark, d).orders
    narrow = [F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("o_custkey"), F.col("o_totalprice").cast("float").alias("o_totalprice")]
    kept = {"path": path, "partition_by": ["o_orderstatus"], "table": table}
    evolve_table(o.where("o_orderstatus = 'F'").select(*narrow, "o_orderdate", "o_orderstatus"), **kept)
    evolve_table(o.where("o_orderstatus = 'P'").select(*narrow, "o_orderstatus"), **kept)
    evolve_table(o.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"), **kept)
    schema = read_evolved(spark, path).schema
    out = spark.table(table)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
    spark.sql(f"DROP TABLE {table}")
    return read_evolved(spark, path)


REPLACE_AS_OF = "1998-02-20"


@register("partition_replace", f"""
WITH o AS (SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders),
y AS (SELECT DISTINCT year FROM o WHERE make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) BETWEEN DATE '1997-11-01' AND DATE '{REPLACE_AS_OF}')
SELECT o_orderkey, CASE WHEN year IN (SELECT year FROM y) THEN o_totalprice ELSE 0.0::DOUBLE END AS monto, year, month FROM o
""")
def partition_replace(spark, d):
    """A stored target of all orders with amount 0; the whole years that need it at a February date, found in the source's folder
    names, are computed again and replace their partitions, all other partitions stay."""
    raw, target = shared_dir(spark, "orders_raw"), shared_dir(spark, "orders_target")
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_totalprice").alias("monto"), F.date_format("o_orderdate", "yyyy").alias("year"),
                                       F.date_format("o_orderdate", "MM").alias("month"))
    write_table(o, raw, partition_by=["year", "month"])
    write_table(o.withColumn("monto", F.lit(0.0)), target, partition_by=["year", "month"])
    reprocess_years(spark, raw, target, lambda rows: rows, REPLACE_AS_OF)
    return spark.read.schema("o_orderkey bigint, monto double, year string, month string").parquet(target)


@register("write_metrics", """
SELECT 'orders' AS table_name, 'analytics' AS stage, DATE '2001-09-01' AS fecha, CAST(count(*) AS BIGINT) AS n_rows, 'OK' AS status,
       CAST(NULL AS VARCHAR) AS error, CAST(max(o_orderdate) AS DATE) AS mark, CAST(count(*) AS BIGINT) AS n_stored FROM orders
""")
def write_metrics(spark, d):
    """The audit row and mark observed while orders are written by status, beside the count of what is stored."""
    path = shared_dir(spark, "observed")
    row = write_audited(Tables(spark, d).orders, path, "orders", "analytics", "2001-09-01", mark=F.to_date("o_orderdate"), partition_by=["o_orderstatus"])
    return row.withColumn("n_stored", F.lit(spark.read.parquet(path).count()).cast("bigint"))


def _merge_sql(n: int, snapshot: str, as_of: str) -> str:
    """One run of the insolvency merge: from ``h{n}`` and the list of orders where ``snapshot`` holds to ``h{n + 1}``."""
    return f"""
s{n} AS (SELECT rut, rol, fecha AS fecha_publicacion, k FROM src WHERE {snapshot}),
open{n} AS (SELECT DISTINCT k FROM h{n} WHERE proceso_finalizado IS NULL),
fin{n} AS (SELECT k FROM open{n} WHERE k NOT IN (SELECT k FROM s{n})),
added{n} AS (SELECT * FROM s{n} WHERE k NOT IN (SELECT k FROM open{n})),
m{n} AS (SELECT rut, rol, k, fecha_publicacion, CASE WHEN rut IN (SELECT k FROM fin{n}) THEN '{as_of}' ELSE fecha_ejecucion END AS fecha_ejecucion,
                CASE WHEN rut IN (SELECT k FROM fin{n}) THEN true ELSE proceso_finalizado END AS proceso_finalizado, razon_social, estado FROM h{n}
         UNION ALL SELECT rut, rol, k, fecha_publicacion, CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM added{n}),
h{n + 1} AS (SELECT m.rut, m.rol, m.k, m.fecha_publicacion, m.fecha_ejecucion, m.proceso_finalizado, coalesce(r.c_name, m.razon_social) AS razon_social,
                    CASE WHEN r.c_name IS NOT NULL THEN 'ACTIVO' ELSE m.estado END AS estado
             FROM m{n} m LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS c, c_name FROM customer WHERE c_acctbal > 0 AND CAST(c_custkey AS VARCHAR) IN (SELECT k FROM added{n})) r
             ON m.rut = r.c)"""


@register("insolvency_publish", f"""
WITH src AS (SELECT rut, rol, fecha, estado_o, coalesce(rut, 'CORRECCION:' || rol) AS k FROM (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS rut, CAST(o_orderkey AS VARCHAR) AS rol,
         CAST(o_orderdate AS DATE) AS fecha, o_orderstatus AS estado_o FROM orders)),
h1 AS (SELECT rut, rol, k, fecha AS fecha_publicacion, CAST(NULL AS VARCHAR) AS fecha_ejecucion, CASE WHEN estado_o = 'F' THEN true END AS proceso_finalizado,
              CAST(NULL AS VARCHAR) AS razon_social, CAST(NULL AS VARCHAR) AS estado FROM src WHERE fecha < DATE '1996-01-01'),
{_merge_sql(1, "fecha >= DATE '1995-01-01' AND fecha < DATE '1998-01-01'", "1998-01-01")},
{_merge_sql(2, "fecha >= DATE '1997-01-01'", "2001-09-01")}
SELECT rut, rol, fecha_publicacion, fecha_ejecucion, proceso_finalizado, razon_social, estado, 3 AS version FROM h3
""")
def insolvency_publish(spark, d):
    """B22 with its output: orders before 1996 published as the first history, then two daily runs that read the newest version and
    publish the next one; between them a run that died after writing. The newest version is returned."""
    t, path = Tables(spark, d), shared_dir(spark, "insolvencies")
    rut = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey").cast("string"))
    day = F.to_date("o_orderdate")
    rows = t.orders.select(rut.alias("rut"), F.col("o_orderkey").cast("string").alias("rol"), day.alias("fecha_publicacion"),
                           F.lit(None).cast("string").alias("fecha_ejecucion"), F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("proceso_finalizado"))
    listed = rows.select("rut", "rol", F.date_format("fecha_publicacion", "dd/MM/yyyy").alias("fecha_publicacion"), F.year("fecha_publicacion").alias("y"))
    registry = t.customer.select(F.col("c_custkey").cast("string").alias("rut"), F.col("c_name").alias("razon_social"),
                                 F.when(F.col("c_acctbal") > 0, "ACTIVO").otherwise("INACTIVO").alias("estado"), F.col("c_custkey").alias("orden"))
    publish(rows.where(F.year("fecha_publicacion") < 1996), path, None)
    cols = ["razon_social", "estado"]
    projects.publish_insolvency(path, listed.where("y between 1995 and 1997").drop("y"), registry, "1998-01-01", registry_cols=cols)
    stage_version(rows.withColumn("rut", F.lit("lost")), path)
    version = projects.publish_insolvency(path, listed.where("y >= 1997").drop("y"), registry, "2001-09-01", registry_cols=cols)
    return read_version(spark, path).withColumn("version", F.lit(version))


@register("group_file_appends", """
WITH k AS (SELECT 0 AS a, 'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS k FROM part
           UNION ALL SELECT 1, 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') FROM supplier
           UNION ALL SELECT 2, 'C' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') FROM customer),
i AS (SELECT a, k, (row_number() OVER (PARTITION BY a ORDER BY k) - 1) // 30 AS g FROM k),
b AS (SELECT a, g, string_agg('''' || k || '''', ', ' ORDER BY k) AS items FROM i GROUP BY a, g),
n AS (SELECT row_number() OVER (ORDER BY a, g) - 1 AS grupo, items FROM b)
SELECT CAST(grupo AS BIGINT) AS grupo, '(' || items || ');grupo' || CAST(grupo AS VARCHAR) AS linea, CAST(grupo AS BIGINT) AS lugar FROM n
""")
def group_file_appends(spark, d):
    """Meter groups of parts, then of suppliers, then of customers appended to one text target; numbers go on where the
    stored ones end. ``lugar`` is each line's place in the files, read in the order of their names."""
    path, t = shared_dir(spark, "groups"), Tables(spark, d)
    sources = [("overwrite", "P", t.part, "p_partkey"), ("append", "S", t.supplier, "s_suppkey"), ("append", "C", t.customer, "c_custkey")]
    for mode, letter, table, key in sources:
        readings = table.select(F.concat(F.lit(letter), F.lpad(F.col(key).cast("string"), 7, "0")).alias("NOINS"), F.lit(2).alias("NOINTERVALS"), F.lit(1).alias("IS_ACTIVE"))
        energy.write_group_file(energy.meter_batches(readings), path, mode)
    lines = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("f"), F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("n", "linea"))
    before = lines.groupBy("f").agg(F.count(F.lit(1)).alias("c")).select("f", (F.sum("c").over(Window.orderBy("f")) - F.col("c")).alias("b"))
    stored = energy.read_group_file(spark, path)
    return stored.join(lines.join(before, "f").select("linea", (F.col("b") + F.col("n")).alias("lugar")), "linea").select("grupo", "linea", "lugar")


@register("distinct_counts", """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag || l_linestatus END AS k, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_l_partkey,
       CAST(count(DISTINCT l_suppkey) AS BIGINT) AS n_l_suppkey, CAST(count(DISTINCT l_shipdate) AS BIGINT) AS n_l_shipdate
FROM lineitem GROUP BY 1
""")
def distinct_counts_q(spark, d):
    """Exact distinct counts of three columns by a key that holds a third of all rows."""
    li = Tables(spark, d).lineitem
    keyed = li.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.concat("l_returnflag", "l_linestatus")))
    return distinct_counts(keyed, ["k"], ["l_partkey", "l_suppkey", "l_shipdate"])


MATCH_SQL = """SELECT o_orderkey AS id, c.c_mktsegment AS home_team, o.o_orderpriority AS away_team,
         CAST(floor(o.o_totalprice / 100000) AS INTEGER) AS home_score, CAST(floor(c.c_acctbal / 2000) AS INTEGER) AS away_score, o_orderstatus = 'F' AS neutral
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


def _matches(spark, d):
    t = Tables(spark, d)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("c_mktsegment").alias("home_team"), F.col("o_orderpriority").alias("away_team"),
        F.floor(F.col("o_totalprice") / 100000).cast("int").alias("home_score"), F.floor(F.col("c_acctbal") / 2000).cast("int").alias("away_score"),
        (F.col("o_orderstatus") == "F").alias("neutral"))


@register("match_rows", f"""
WITH m AS ({MATCH_SQL})
SELECT home_team AS team, 'local' AS side, CASE WHEN home_score > away_score THEN 'gana' ELSE 'empate' END AS outcome, * FROM m WHERE home_score >= away_score
UNION ALL
SELECT away_team, 'visitante', CASE WHEN away_score > home_score THEN 'gana' ELSE 'empate' END, * FROM m WHERE away_score >= home_score
""")
def match_rows(spark, d):
    """The rows of won and drawn matches per team and side, in one pass over the matches."""
    return sport.outcome_rows(_matches(spark, d))


@register("match_home_sums", f"""
WITH m AS ({MATCH_SQL})
SELECT home_team, CAST(sum(id) AS BIGINT) AS id, CAST(sum(home_score) AS BIGINT) AS home_score, CAST(sum(away_score) AS BIGINT) AS away_score,
       CAST(sum(CASE WHEN neutral THEN 1 ELSE 0 END) AS BIGINT) AS neutral FROM m GROUP BY home_team
""")
def match_home_sums(spark, d):
    """B39 (A3): every numeric column of the matches at home summed per team."""
    return sport.home_sums(_matches(spark, d))


@register("nested_folders", """
SELECT p_partkey, p_name, p_retailprice FROM part
""")
def nested_folders(spark, d):
    """Parts written below folders of different depths and read back by one recursive read."""
    base, p = shared_dir(spark, "nested"), Tables(spark, d).part.select("p_partkey", "p_name", "p_retailprice")
    for folder, rows in (("a/b/c", p.where("p_retailprice < 1200")), ("a/d", p.where("p_retailprice >= 1200 and p_retailprice < 1500")), ("e", p.where("p_retailprice >= 1500"))):
        write_table(rows, f"{base}/{folder}")
    return read_table(spark, base, recursive=True)


@register("typed_overwrite", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber, TRY_CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate, 4 AS n_files
FROM lineitem
""")
def typed_overwrite(spark, d):
    """A stored target replaced as a whole by lines with columns cast on write, in four files."""
    path, t = shared_dir(spark, "typed"), Tables(spark, d)
    write_table(t.orders, path)
    write_table(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"), path, files=4,
                casts={"string": ["l_orderkey"], "int": ["l_quantity"], "date": ["l_shipdate"]})
    back = spark.read.parquet(path)
    files = back.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return back.withColumn("n_files", F.lit(files))
