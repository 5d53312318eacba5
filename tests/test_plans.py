"""Named jobs on small frames with the schemas of FIXTURES.md (all values invented)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.plans import employment, energy, finance, membership, monitor, projects, sport

D = dt.date
TS = dt.datetime


def test_real_generation_fact(spark):
    mk = spark.createDataFrame
    meas = mk([(10, 1, 5, 1.0), (10, 1, 7, 2.0), (10, 1, None, 9.0), (11, 1, 1, 3.0), (12, 1, 1, 4.0)],
              "key_id long, reported_time_id long, audit_id long, value double")
    key = mk([(10, 1, "k10", '{"max_tol": 50}', 1), (11, 72, "k11", "{}", 1), (12, 5, "k12", "{}", 1)],
             "id long, key_type_id long, name string, params string, company_id long")
    kc = mk([(10,), (11,), (12,)], "key_id long")
    time = mk([(1, D(2023, 1, 1), 3)], "id long, date date, hour int")
    kt = mk([(1, 100), (72, 100), (5, 100)], "id long, key_unit_id long")
    ku = mk([(100, "MW")], "id long, natural_key string")
    kn = mk([(10, 1), (11, 1), (12, 1)], "key_id long, node_id long")
    node = mk([(1, "Central A", 3), (2, "Solar", 1)], "id long, description string, node_type_id int")
    edge = mk([(1, 2)], "src_id long, dst_id long")
    company = mk([(1,)], "id long")
    plants = mk([("Central A", 7)], "centralnombre string, id_propietario long")
    owners = mk([(7, "Owner SA")], "id_empresa long, empresanombre string")
    out = energy.real_generation(meas, key, kc, time, kt, ku, kn, node, edge, company, plants, owners)
    got = rows(out, "Idcentral", "valor", "potencia_maxima", "Tipo_Tecnologia", "Propietario")
    assert got == [(10, 2.0, "50", "Solar", "Owner SA"), (11, 3.0, None, "Solar", "Owner SA")]


def test_programmed_marginal_cost_keeps_smallest_audit(spark):
    prog = spark.createDataFrame([(1, "2023-01-02", 10, 5.0, 1, 3), (2, "2023-01-02", 10, 6.0, 1, 2),
                                  (3, "2023-01-02", 10, 7.0, 1, None), (4, "2023-01-02", 11, 8.0, 1, 1)],
                                 "id long, date string, key_id long, value double, reported_time_id long, audit_id long")
    keys = spark.createDataFrame([(10, 92, "B1"), (11, 50, "B2")], "id long, key_type_id long, name string")
    out = energy.programmed_marginal_cost(prog, keys)
    assert out.columns == ["ID_BARRA", "ID_CONCEPTO_UNIDAD", "ID_TIEMPO", "V_COSTOMARGINALPROGRAMADO", "FECHA_REPORTE"]
    assert [tuple(r) for r in out.collect()] == [(10, 92, 1, 6.0, "2023-01-02")]


def test_projected_supply_and_demand(spark):
    works = spark.createDataFrame([("E1", "R1", "Solar", 2030, 10, "P"), ("E1", "R1", "Solar", 2032, 5, None),
                                   ("E1", "R2", "Eolica", 2031, 7, "X")],
                                  "escenario string, region string, tecnologia string, ano int, potencia long, tipo_plp string")
    out = energy.projected_supply(works)
    got = rows(out, "region", "tecnologia", "ano", "potencia")
    assert len(got) == 3 and ("R1", "Solar", 2031, 0) in got
    dem = energy.projected_demand({"base": spark.createDataFrame([(1.0,)], "Demanda double"),
                                   "alta": spark.createDataFrame([(2.0,)], "Demanda double")}, {"Demanda": "demanda"})
    assert rows(dem, "escenario", "demanda") == [("alta", 2.0), ("base", 1.0)]
    cmg = energy.projected_marginal_cost(spark.createDataFrame([("H1", 2030, 3, "B")], "hidro string, year int, mes int, barnom string"))
    assert cmg.first()["fecha"] == "01-3-2030" and {"hidrologia", "anio", "nombre_barra"} <= set(cmg.columns)
    dem = energy.projected_demand({"m": spark.createDataFrame([(2030, "x")], "ano int, tag_mes string")}, load_year=2028).first()
    assert (dem["year"], dem["anio"], dem["nombre_mes"], dem["yearParticion"]) == (2030, "2030", "x", "2028")


def test_installation_attributes(spark):
    ents = spark.createDataFrame([(1, "c1"), (1, "c1"), (2, "c2")], "id_configuracion long, nombre string")
    vals = spark.createDataFrame([(1, "Potencia", "10"), (1, "Potencia", "12"), (2, "Tension", "220")],
                                 "id_configuracion long, conceptonombre string, fta_datovalortexto string")
    wide, dupes = energy.installation_attributes(ents, vals, "id_configuracion", ["Potencia", "Tension", "Otro"])
    assert rows(wide) == [(1, "c1", "12", None, None), (2, "c2", None, "220", None)]
    assert dupes.count() == 1


def test_meter_batches_and_group_file(spark, tmp_dir):
    data = [(i, f"M{i:03d}", 2 if i % 7 else 1, 1) for i in range(70)] + [(99, "M001", 2, 1), (100, "Z", 5, 0)]
    df = spark.createDataFrame(data, "ID_READING_DETAIL long, NOINS string, NOINTERVALS int, IS_ACTIVE int")
    out = sorted(energy.meter_batches(df).collect(), key=lambda r: r["grupo"])
    assert [r["n_keys"] for r in out] == [30, 30]
    assert out[0]["linea"].startswith("('M001', 'M002', 'M003', 'M004', 'M005', 'M006', 'M008'")
    assert out[1]["linea"].endswith(";grupo1")
    path = os.path.join(tmp_dir, "g")
    energy.write_group_file(energy.meter_batches(df), path)
    assert len(spark.read.text(path).collect()) == 2


def test_month_to_date_and_layers(spark, tmp_dir):
    base = os.path.join(tmp_dir, "gen")
    df = spark.createDataFrame([(1.0, "2023-03-01"), (2.0, "2023-03-05"), (3.0, "2023-02-28"), (4.0, "2023-03-09")],
                               "v double, fecha string")
    df.write.partitionBy("fecha").parquet(base)
    out = energy.month_to_date_export(spark, base, "2023-03-06", csv_path=os.path.join(tmp_dir, "csv"),
                                      tsv_path=os.path.join(tmp_dir, "tsv"))
    assert sorted(r["v"] for r in out.collect()) == [1.0, 2.0]
    raw, stg = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "stg")
    for p in ["a/x", "a/y", "b"]:
        os.makedirs(os.path.join(raw, p))
        open(os.path.join(raw, p, "f.bin"), "w").write("1")
    os.makedirs(os.path.join(stg, "a/x"))
    open(os.path.join(stg, "a/x", "f.bin"), "w").write("1")
    assert rows(energy.layer_completeness(spark, raw, stg)) == [("a/y",), ("b",)]


def test_company_dimension(spark):
    emp = spark.createDataFrame([("1", 1, "Metropolitana"), ("2", 1, "Biobío"), ("3", 0, "X"), ("4", 1, "Maule")],
                                "rut string, estado int, nom_region string")
    ign = spark.createDataFrame([("4",)], "rut string")
    act = spark.createDataFrame([("1", 3)], "rut string, persona_lista long")
    usr = spark.createDataFrame([("1", 2, 1, D(2023, 3, 20)), ("2", 0, 0, D(2023, 2, 15))],
                                "rut string, vistas_cv long, descarga_cv long, fecha_alta date")
    soc = spark.createDataFrame([("2",)], "rut string")
    out = {r["rut"]: r for r in employment.company_dimension(emp, ign, act, usr, soc, "2023-04-01",
                                                             capital_region="Metropolitana").collect()}
    assert set(out) == {"1", "2"}
    assert out["1"]["status"] == "ACTIVO" and out["1"]["uso"] is True and out["1"]["santiago_region"] == "Santiago"
    assert out["2"]["status"] == "CASI INACTIVO" and out["2"]["uso"] is False and out["2"]["socio"] == 1


def test_workers_brackets_and_dedup(spark):
    t = spark.createDataFrame([
        ("2023-01-02", "123", "k", "Albañil", "Sin experiencia", "R", "C", 30, "M"),
        ("2023-01-01", "123", "k", "Albañil", "De 0 a 1 año", "R", "C", 31, "H"),
        ("2023-01-01", "9", "1", "Gasfiter", None, "R", "C", None, None)],
        "fecha_registro string, num_documento string, digito_verificador string, ocupacion string, "
        "rango_experiencia string, region string, comuna string, edad int, sexo string")
    of = spark.createDataFrame([("Albañil",)], "oficio string")
    es = spark.createDataFrame([("Albañil", "Obra gruesa")], "ocupacion string, especialidad string")
    ce = spark.createDataFrame([("123K", "Fundación")], "rut string, fundacion_social string")
    out = {r["rut"]: r for r in employment.workers(t, of, es, ce).collect()}
    assert out["123k"]["tramo_de_edad"] == "Entre 31 y 40" and out["123k"]["OrdenTramoEdad"] == 2
    assert out["123k"]["fundacion_social"] == "Fundación" and out["123k"]["genero"] == "Hombres"
    assert out["91"]["tramo_de_edad"] == "Mayor a 60" and out["91"]["especialidad"] == "Sin Información"
    assert out["91"]["OrdenRangoExperiencia"] is None


def test_activity_by_month(spark):
    dl = spark.createDataFrame([(1, D(2023, 1, 5)), (1, D(2023, 1, 6)), (2, D(2023, 2, 1))], "id_usuario long, fecha date")
    inv = spark.createDataFrame([(1, D(2023, 1, 9)), (3, D(2023, 1, 9))], "id_usuario long, fecha date")
    empty = spark.createDataFrame([], "id_usuario long, fecha date")
    uc = spark.createDataFrame([(1, "R1"), (1, "R1")], "id_usuario long, rut_empresa string")
    out = employment.activity_by_month(spark, dl, inv, empty, empty, uc, "2023-01-01", "2023-03-01")
    assert rows(out, "periodo", "id_usuario", "cvs_descargados", "invitaciones", "rut_empresa") == [
        (2023001, 1, 2, 1, "R1"), (2023002, 2, 1, None, None)]


def _bne(spark):
    mk = spark.createDataFrame
    return dict(
        users=mk([(1, "ana", "11"), (2, "bob", "22")], "ID long, NOM_USUARIO string, RUT string"),
        ubicac=mk([(1, 10), (2, 20)], "ID_EMPRESARIO_USUARIOS long, ID_UBIC_REL long"),
        relac=mk([(10, 100), (20, 200)], "ID long, ID_EMPRESARIO long"),
        empresario=mk([(100, "R100", 5, 13), (200, "R200", None, 8)], "ID long, RUT string, ID_COMUNA long, ID_REGION long"),
        sectores=mk([(100, 1), (200, 2)], "ID_EMPRESARIO long, ID_SECTOR long"),
        downloads=mk([(1000, 1, None, 3, TS(2023, 1, 5, 10)), (1001, 1, 7, 2, TS(2023, 1, 5, 11)),
                      (1002, 2, 8, 1, TS(2023, 1, 6, 9))],
                     "ID long, ID_EMP_USUARIO long, ID_LISTA long, NUM_CV int, FEC_ALTA timestamp"),
    )


def test_downloads_by_day_place_and_company_users(spark):
    b = _bne(spark)
    mk = spark.createDataFrame
    comunas = mk([(5, "Ñuñoa")], "ID long, NOMBRE string")
    regiones = mk([(13, "Metropolitana")], "ID long, NOMBRE string")
    det = mk([(1000, 50), (1000, 51)], "ID_DESCARGA_CV long, ID_PERSONA long")
    per = mk([(50,), (51,)], "ID long")
    po = mk([(50, 1)], "ID_PERSONA long, ID_OCUPACION long")
    oc = mk([(1, "Albañil")], "ID long, DESCRIPCION string")
    out = employment.downloads_by_day_place(b["users"], b["ubicac"], b["relac"], b["empresario"], b["sectores"],
                                            b["downloads"], comunas, regiones, det, per, po, oc)
    assert rows(out, "fecha_alta", "ocupacion", "total") == [(D(2023, 1, 5), "Albañil", 1), (D(2023, 1, 5), None, 2)]
    empresas = mk([("R100", 1)], "RUT string, ESTADO int")
    excluded = mk([("R999",)], "rut string")
    cu = employment.company_user_activity(b["users"], b["ubicac"], b["relac"], b["empresario"], b["sectores"],
                                          b["downloads"], empresas, excluded)
    got = rows(cu, "ID_LISTA", "VISTAS_CV", "DESCARGA_CV", "FECHA_ALTA_MES")
    assert got == [(7, 1, 2, D(2023, 1, 1)), (None, 1, -2, D(2023, 1, 1))]


def test_education_levels(spark):
    mk = spark.createDataFrame
    per = mk([(1, "11", "1", 1, 5), (2, "22", "2", 2, None), (3, "33", None, 99, None), (4, "44", "4", 1, 5)],
             "ID long, NUM_DOCUMENTO string, DIGITO_VERIFICADOR string, ID_REGION long, ID_COMUNA long")
    media = mk([(1,), (1,), (2,), (3,)], "ID_PERSONA long")
    cursos = mk([(1,)], "ID_PERSONA long")
    sup = mk([], "ID_PERSONA long")
    reg = mk([(1, "Metropolitana"), (2, "Bío Bío"), (99, "MIGRACION")], "ID long, NOMBRE string")
    com = mk([(5, "Ñuñoa")], "ID long, NOMBRE string")
    geo = mk([("Nunoa", "Metropolitana de Santiago")], "comuna string, region string")
    out = {r["rut"]: r for r in employment.education_levels(per, media, cursos, sup, reg, com, geo).collect()}
    assert set(out) == {"111", "222"}
    assert out["111"]["region"] == "Metropolitana de Santiago" and out["111"]["tiene_cursos"] is True
    assert out["222"]["region"] == "Biobío" and out["222"]["tiene_ed_superior"] is False


def test_small_employment_jobs(spark):
    mk = spark.createDataFrame
    ev = mk([(5,), (5,), (3,)], "EVALUACION int")
    assert rows(employment.evaluations_count(ev)) == [(3, 1), (5, 2)]
    b = _bne(spark)
    lists = mk([(7, 1), (8, 2), (9, 1)], "ID long, ID_EMP_USUARIO long")
    inv = mk([(7,), (7,)], "ID_LISTA long")
    lu = employment.list_usage(lists, b["users"], b["ubicac"], b["relac"], b["empresario"], b["sectores"],
                               b["downloads"], inv)
    assert rows(lu, "lista", "persona_lista", "numero_cv_descargados") == [(7, 2, 2), (8, None, 1), (9, None, 0)]
    views = mk([("R1", 3), ("R2", 4), ("R3", 5)], "RUT string, TOTAL long")
    emp = mk([("R1", 1), ("R2", 0)], "RUT string, ESTADO int")
    exc = mk([("R3",)], "rut string")
    r = employment.downloads_reconciliation(views, emp, exc).first()
    assert (r["total_vistas"], r["filas"]) == (7, 3)


def test_membership_jobs(spark):
    mk = spark.createDataFrame
    soc = mk([(1, "activo", "Entidad gremial", None, None, "CONCEPCIÓN", "1-9")],
             "PER_ID long, ESTADO string, ACTIVIDADES string, COMITE_PRINCIPAL string, ENTIDAD string, CAMARA string, RUT string")
    st = membership.member_staging(soc, {"per_id": "idpersona"}).first()
    assert (st["estado"], st["is_entidad"], st["zona"], st["comite_principal"], st["entidad"]) == (
        "ACTIVO", "SI", "Zona Sur", "Sin Comité Principal", "NO")
    assert len(st["rut_hash"]) == 64 and st["idpersona"] == 1
    personas = mk([(1, "José Luis", "Pérez", None, "2000-01-01", "1990-06-15", None),
                   (2, "Ana", None, "Soto", "2010-01-01", "2010-01-01", None)],
                  "per_id long, nombre string, apellido_paterno string, apellido_materno string, fecha_creacion string, "
                  "fecha_nacimiento string, fecha_defuncion string")
    gm = mk([("JOSE", "M"), ("ana", "F")], "nombre string, sexo_inferido string")
    members = mk([("2", "ACTIVA", "ACTIVA", "Consejo Regional"), ("1", "INACTIVA", "ACTIVA", "Consejo Regional")],
                 "per_id string, estado_participacion string, estado_grupo string, nombre_grupo string")
    roles = mk([(2, 106, "ACTIVA", "Activo"), (1, 75, "INACTIVA", "Activo")], "per_id long, id_rol int, estado_relacion string, estado_socio string")
    pr = {r["per_id"]: r for r in membership.person_record(personas, gm, members, roles, "2023-01-01").collect()}
    assert (pr[1]["is_consejero_regional"], pr[1]["is_personal_camara"], pr[1]["is_relacionado_socio"], pr[1]["is_difunto"]) == (False, True, False, "NO")
    assert (pr[2]["is_personal_camara"], pr[2]["is_relacionado_socio"]) == (False, True)
    assert pr[1]["sexo_inferido"] == "M" and pr[1]["nombre_completo"] == "José Luis Pérez "
    assert pr[1]["edad"] == 33 and pr[1]["is_fecha_nacimiento_valida"] is True
    assert pr[2]["edad"] == 13 and pr[2]["is_fecha_nacimiento_valida"] is False and pr[2]["is_consejero_regional"] is True
    gt = mk([(1, "Ana", "Soto", None, "P", "R", "00012", "K", "0013", "9", "Grupo 1")],
            "per_id long, per_nom_0 string, per_ape_pat_1 string, per_ape_mat_15 string, per_nom_11 string, "
            "per_ape_pat_12 string, per_rut_3 string, per_dv_4 string, per_rut_16 string, per_dv_17 string, gru_nom string")
    w = membership.working_group_members(gt).first()
    assert (w["socio_nombre"], w["rut"], w["persona_nombre"], w["persona_rut"]) == ("Ana Soto ", "12-K", "P R ", "13-9")


def test_attendance_jobs(spark):
    mk = spark.createDataFrame
    df = mk([(1, D(2023, 1, 1), 1, "Reunión", 1, 2023, 1), (1, D(2023, 1, 8), 0, "Reunión", 2, 2023, 1),
             (2, D(2022, 1, 3), 1, "Sesión SUSPENDIDA", None, 2022, 1)],
            "reuid long, reufecini date, asiasis int, reunom string, sexo int, year int, month int")
    a = rows(membership.attendance(df), "reuid", "reufecini", "str_asistencia", "is_nombre_valido", "periodo")
    assert a == [(1, D(2023, 1, 8), "NO", True, "20231"), (2, D(2022, 1, 3), "SI", False, "20221")]
    r = membership.attendance_rolling(df, "2023-06-15")
    assert r.count() == 2
    roles = mk([("1-9", "12", "5", "2023-01-02")], "RUT string, NUMERO_SOCIO string, ID_RELACION string, FECHA_RELACION string")
    ro = membership.roles_staging(roles).first()
    assert ro["numero_socio"] == 12 and ro["fecha_relacion"] == D(2023, 1, 2) and len(ro["rut_hash"]) == 64
    req = membership.requests_staging(mk([("2023-01-02 10:00:00", None, "x")], "FECHA string, FECHA_RESOLUCION string, NUMERO_SOCIO string")).first()
    assert req["fecha"] == D(2023, 1, 2) and req["numero_socio"] is None
    pos = membership.positions(mk([(1, "a"), (2, "b")], "IdCargo long, `Nombre Cargo` string"),
                               mk([("1", "Presidente"), ("2", None)], "IdCargo string, Cargo_Directivo string"))
    assert "idcargo" in pos.columns and rows(pos, "idcargo", "es_alto_cargo") == [(1, True), (2, None)]
    g = membership.group_names(mk([("x" * 89,), ("y" * 90,)], "descripcion string"))
    assert rows(g, "is_descripcion_corta", "largo_descripcion") == [(False, 90), (True, 89)]
    assert membership.pass_through(mk([(1,)], "ID_X long"), {"id_x": "id"}).columns == ["id"]


def test_member_totals(spark):
    mk = spark.createDataFrame
    soc = mk([("ABC", 1, 1, "S1")], "rut string, c_custkey long, c_nationkey int, c_mktsegment string")
    emp = mk([("Def", 2)], "rut string, c_nationkey int")
    reg = mk([(1, "uno")], "c_nationkey int, nacion string")
    ins = mk([("def",)], "rut string")
    orders = mk([("abc", 1.5), ("ABC", 2.0)], "rut string, o_totalprice double")
    out = {r["rut"]: r for r in membership.member_totals(soc, emp, reg, ins, orders).collect()}
    assert out["abc"]["n_pedidos"] == 2 and out["abc"]["monto"] == 3.5 and out["abc"]["nacion"] == "uno"
    assert out["def"]["insolvente"] is True and out["def"]["segmento"] == "Sin Información"


def test_finance_jobs(spark):
    mk = spark.createDataFrame
    t = mk([("1.234,5", "x", "10,5", "2,5", "05-03-2023 10:00", "01-03-2023", "31-02-2023 x", "gran OBRA", "a", "b", "c", "d")],
           "CANTIDAD_ADJUDICADA string, PRESUPUESTO string, TOTAL_ADJUDICADO string, PRECIO_UNITARIO string, "
           "ADJUDICACION string, PUBLICACION string, CIERRE string, LIC_NOMBRE string, LIC_DESCRIP string, "
           "STENDERCLIENTFULLNAME string, FULLNAME string, COMPETIDOR string")
    r = finance.tenders_staging(t).first()
    assert (r["cantidad_adjudicada"], r["presupuesto"], r["total_adjudicado"], r["precio_unitario"]) == (1234, None, 10, 2)
    assert r["adjudicacion"] == D(2023, 3, 5) and r["cierre"] is None and r["lic_nombre"] == "Gran obra"
    assert r["periodo_num"] == "202303" and r["periodo"] == "mar - 2023"
    po = mk([("P1", "100", "nan", "2023-07-15", "IVA_EXE"), ("P2", "x", "ok", "2023-01-01", None)],
            "a string, b string, c string, d string, e string")
    projects_df = mk([("P1", "Proyecto Uno")], "proyecto_pedido string, proyecto string")
    out = finance.purchase_orders_staging(spark, po, ["proyecto_pedido", "total_neto", "glosa", "fecha_cont_em", "codigo_impuesto"],
                                          {"double": ["total_neto"]}, ["fecha_cont_em"], projects_df)
    got = {r["proyecto_pedido"]: r for r in out.collect()}
    assert got["P1"]["glosa"] is None and got["P1"]["total_con_impuesto"] == 100.0
    assert got["P1"]["fecha_cont_em_mes_spa"] == "Julio" and got["P1"]["proyecto"] == "Proyecto Uno"
    assert got["P2"]["total_neto"] is None and got["P2"]["fecha_cont_em_mes_spa"] == "Enero"


def test_financial_summary(spark):
    mk = spark.createDataFrame
    ledger = mk([("C1", "A1", "FRN01", TS(2023, 1, 2), 1.0, 0.0, 0.0, 0.0, 2023),
                 ("C9", "A9", "FN02", TS(2023, 1, 3), 2.0, 0.0, 0.0, 0.0, 2023)],
                "distributionrulecode1 string, accountcode string, projectcode string, postingdate timestamp, "
                "debit_lc double, credit_lc double, debit_sc double, credit_sc double, year int")
    accounts = mk([("A1",)], "codigo string")
    chambers = mk([(3, "SANTIAGO")], "id long, descripcion string")
    time = mk([(20230102, D(2023, 1, 2))], "id long, date date")
    cur = mk([(D(2023, 1, 2), 1.0, 2.0)], "fecha date, uf double, dolar double")
    com = mk([(9, "C1")], "id long, codigo_sap string")
    codes = mk([("Santiago", "C1")], "camara string, id_camara_sap string")
    out = {r["id"]: r for r in finance.financial_summary(ledger, accounts, chambers, time, cur, com, codes, "2023-02-01").collect()}
    assert out["A1"]["id_camara"] == 3 and out["A1"]["id_comite"] == 9 and out["A1"]["is_project"] == "Fondo Regional/Proyecto impacto"
    assert out["A9"]["id_camara"] == 99999999 and out["A9"]["id_cuenta_sap"] == "99999999" and out["A9"]["id_fecha"] is None
    assert out["A9"]["is_project"] == "Proyecto impacto" and out["A9"]["debit_lc_usd"] == 0


def test_monitor_jobs(spark):
    mk = spark.createDataFrame
    runs = mk([("arn:x:stateMachine:SF-A", TS(2023, 1, 1, 10), TS(2023, 1, 1, 10, 5), "SUCCEEDED"),
               ("arn:x:stateMachine:SF-A", TS(2023, 1, 2, 10), None, "RUNNING"),
               ("arn:x:stateMachine:SF-B", TS(2023, 1, 1, 9), TS(2023, 1, 1, 9, 0, 30), "TIMED_OUT")],
              "stateMachineArn string, startDate timestamp, stopDate timestamp, status string")
    rep = {r["Statemachine"]: r for r in monitor.process_report(runs, {"arn:x:stateMachine:SF-A": "Proceso A"}).collect()}
    assert rep["SF-A"]["Estado"] == "🏃" and rep["SF-A"]["Duración"] is None and rep["SF-A"]["Nombre Proceso / Fuente"] == "Proceso A"
    assert rep["SF-B"]["Estado"] == "TIMED_OUT" and rep["SF-B"]["Duración"] == 30.0
    met = mk([("f1", TS(2023, 1, 1, 1), 0.0), ("f1", TS(2023, 1, 1, 5), 2.0), ("f2", TS(2023, 1, 1, 1), 0.0)],
             "function string, Timestamp timestamp, Sum double")
    de = {r["Nombre Función"]: r for r in monitor.daily_errors(met, {"f1": "uno"}).collect()}
    assert de["f1"]["Estado"] == "❌" and de["f1"]["Cantidad de errores"] == 2.0 and de["f2"]["Estado"] == "✅"


def test_project_jobs(spark):
    mk = spark.createDataFrame
    ms = mk([("P", "T1", "h1", "Cabecera", "l", "g", True, "2023-01-01", "2023-02-01", None, None),
             ("P", "T1", "h2", "Diseño", "l", "g", False, "2023-01-05", "2023-03-01", "2023-01-06", None),
             ("P", "T1", "h3", None, "l", "g", None, "2023-01-03", "2023-01-04", None, "2023-04-01")],
            "id_proyecto string, id_tablero string, id_hito string, nombre_hito string, nombre_lider_hito string, "
            "gerencia_hito string, is_finalizado boolean, fecha_planificada_inicio string, fecha_planificada_fin string, "
            "fecha_real_inicio string, fecha_real_fin string")
    out = projects.project_milestones(ms)
    s = out.where(F.col("nombre_hito") == projects.SUMMARY_LABEL).first()
    assert out.count() == 3 and s["id_proyecto"] == "PT1" and s["is_finalizado"] is False
    assert s["fecha_planificada_inicio"] == D(2023, 1, 3) and s["fecha_real_fin"] == D(2023, 4, 1)
    hist = mk([("r1", "a", D(2022, 1, 1), None, None)],
              "rut string, rol string, fecha_publicacion date, fecha_ejecucion string, proceso_finalizado boolean")
    new = mk([("r2", "b", "07/11/2022")], "rut string, rol string, fecha_publicacion string")
    reg = mk([("r2", "Dos", "M", "C", "S", True, "ACTIVO", 1)],
             "rut string, razon_social string, tamano_de_empresa string, rubro_economico string, "
             "subrubro_economico string, socio boolean, estado string, orden int")
    cols = projects.REGISTRY_COLS + ("socio",)
    merged = {r["rut"]: r for r in projects.insolvency_merge(hist, new, reg, "2022-11-07", registry_cols=cols).collect()}
    assert merged["r1"]["proceso_finalizado"] is True and merged["r2"]["fecha_publicacion"] == D(2022, 11, 7)
    assert merged["r2"]["razon_social"] == "Dos" and merged["r2"]["socio"] is True
    ins = mk([("r1", 1), ("r1", 2), ("r2", 1)], "rut string, n int")
    regs = mk([("r1", "ACTIVO", 1, "a"), ("r1", "ACTIVO", 2, "b"), ("r1", "INACTIVO", 3, "c"), ("r2", "INACTIVO", 1, "d")],
              "rut string, estado string, orden int, nombre string")
    assert rows(projects.active_insolvencies(ins, regs, "orden"), "rut", "n", "nombre") == [("r1", 1, "b"), ("r1", 2, "b")]
    roles = mk([(1, 10, 106, "ACTIVA"), (2, 20, 106, "INACTIVA"), (3, 30, 5, "ACTIVA")],
               "per_id long, numero_socio long, id_rol int, estado_relacion string")
    people = mk([(1, "1-9", "Ana", "22", "99", "a@x")],
                "per_id long, rut string, nombre_completo string, telefono_comercial string, "
                "telefono_movil_comercial string, email_comercial string")
    rep = projects.representatives(roles, people).collect()
    assert len(rep) == 1 and rep[0]["id_socio"] == 10 and rep[0]["celular_comercial"] == "99"


def test_sport_jobs(spark):
    mk = spark.createDataFrame
    res = mk([("A", "B", 2, 1), ("B", "A", 0, 0), ("C", "A", 1, 3)], "home_team string, away_team string, home_score int, away_score int")
    tab = {r["team"]: r for r in sport.team_table(res).collect()}
    assert (tab["A"]["wins"], tab["A"]["draws"], tab["A"]["goals"], tab["A"]["played"]) == (2, 1, 5, 3)
    assert tab["B"]["draws"] == 1  # away draws are counted (corrected order)
    goals = mk([(f"s{i}", "t", "2020-01-01", True) for i in range(25)] + [("x", "t", "2020-01-01", True), ("x", "u", None, True), ("z", "t", "2020-01-01", False)],
               "scorer string, team string, date string, penalty boolean")
    got = rows(sport.penalty_scorers(goals), "scorer", "team", "date")
    assert len(got) == 27 and ("x", "t", 1) in got and ("x", "u", 0) in got


def test_member_registry_job(spark):
    mk = spark.createDataFrame
    members = mk([("R1",), ("R2",), ("R3",)], "rut string")
    registry = mk([("r1", "Uno SA", "CONSTRUCCION", "CONSTRUCCION DE EDIFICIOS", "PJ", None, "Mediana", "T1", 3),
                   ("r2", "Dos SA", None, "OTRO", "PJ", "Tramo 2", "Chica", None, None)],
                  "rut string, razon_social string, rubro_economico string, subrubro_economico string, "
                  "tipo_de_contribuyente string, tramo_de_facturacion_txt string, tamano_de_empresa string, "
                  "tramo_trabajadores string, tramo_capital_propio_positivo int")
    manual = mk([("R3", "Tres Ltda")], "rut string, razon_social string")
    ins = mk([("r2",), ("R2",)], "rut string")
    comp = mk([("R1", "ACTIVO", "SANTIAGO")], "rut string, estado string, camara_casa_matriz string")
    out = {r["rut"]: r for r in membership.member_registry(members, registry, manual, ins, comp, 2021).collect()}
    assert set(out) == {"r1", "r2", "r3"}
    assert out["r1"]["grupo_caenes"] == "CONSTRUCCIÓN DE EDIFICIOS" and out["r1"]["socio"] is True
    assert out["r1"]["tramo_capital_propio_txt"] == "3. 25 < y <= 50UF" and out["r1"]["tramo_de_facturacion_txt"] == "No Informado"
    assert out["r2"]["insolvente"] is True and out["r2"]["rubro_economico"] == "Valor por Defecto"
    assert out["r2"]["tramo_capital_propio_txt"] == "Sin Información" and out["r2"]["socio"] is False
    assert out["r3"]["razon_social"] == "Tres Ltda" and out["r3"]["commercial_year"] == 2021


def test_company_dimension_geography_and_registry(spark):
    mk = spark.createDataFrame
    emp = mk([("1k", 1, "Metropolitana", "Ñuñoa"), ("2", 1, "Maule", "Migración")],
             "rut string, estado int, nom_region string, nom_comuna string")
    empty_rut = mk([], "rut string")
    act = mk([], "rut string, persona_lista long")
    usr = mk([], "rut string, vistas_cv long, descarga_cv long, fecha_alta date")
    geo = mk([(13, "Nunoa"), (13, "ÑUÑOA")], "id_geo long, comuna string")
    reg = mk([("1-K", "Grande")], "rut string, tamano_de_empresa string")
    out = {r["rut"]: r for r in employment.company_dimension(emp, empty_rut, act, usr, empty_rut, "2023-01-01",
                                                             geography=geo, registry=reg).collect()}
    assert out["1K"]["id_camara"] == 13 and out["1K"]["tamano_de_empresa"] == "Grande"
    assert out["2"]["nom_comuna"] == "Sin Información" and out["2"]["id_camara"] is None


def test_workers_geography(spark):
    mk = spark.createDataFrame
    t = mk([("2023-01-01", "1", "k", "A", None, "R", "Ñuñoa", 20, "M"), ("2023-01-01", "2", "k", "A", None, "R", "Talca", 20, "M"),
            ("2023-01-01", "3", "k", "A", None, "R", "Nada", 20, "M")],
           "fecha_registro string, num_documento string, digito_verificador string, ocupacion string, "
           "rango_experiencia string, region string, comuna string, edad int, sexo string")
    none = mk([], "oficio string")
    esp = mk([], "ocupacion string, especialidad string")
    ces = mk([], "rut string, fundacion_social string")
    geo = mk([("1", "Nunoa"), ("7", "TALCA")], "id_geo string, comuna string")
    out = {r["rut"]: r["santiago_region"] for r in employment.workers(t, none, esp, ces, geography=geo).collect()}
    assert out == {"1k": "Santiago", "2k": "Regiones", "3k": "Sin información"}


def _sheet_tables(spark, entity_key):
    mk = spark.createDataFrame
    inst = mk([(100, 5, 1), (101, 5, 2), (102, 9, 1), (200, 10, 1)], f"id_instalacion long, id_instalaciontipo int, {entity_key} long")
    applied = mk([(1000, 100), (1001, 101), (1002, 102), (2000, 200)], "id_ftaplicada long, id_instalacion long")
    adata = mk([("50 MW", 1, 1000), ("220 kV", 2, 1000), ("60 MW", 1, 1001), ("x", 1, 1002), ("61 MW", 1, 1001),
                ("S1", 1, 2000), ("S2", 1, 2000)], "fta_datovalortexto string, id_fte_dato long, id_ftaplicada long")
    std = mk([(1, 10), (2, 20)], "id_fte_dato long, id_datotecnico long")
    tech = mk([(10, 791), (20, 792)], "id_datotecnico long, id_concepto long")
    conc = mk([(791, "Potencia"), (792, "Tension")], "id_concepto long, conceptonombre string")
    comp = mk([(7, "CC Norte"), (8, "Dueño SA")], "id_empresa long, empresanombre string")
    groups = mk([(9, "Grupo Uno")], "id_grupo long, gruponombre string")
    return inst, applied, adata, std, tech, conc, comp, groups


def test_unit_configurations(spark):
    mk = spark.createDataFrame
    configs = mk([(1, 50, "U1", "1", "NEM1", "d1"), (2, 50, "U2", "2", "NEM2", "d2"), (3, 51, "U3", "3", None, None)],
                 "id_configuracion long, id_central long, configuracionnombre string, configuracionnumero string, "
                 "configuracionnemotecnico string, configuraciondescripcion string")
    plants = mk([(50, 8, 9, 7, "Central A")], "id_central long, id_propietario long, id_coordinado long, "
                                              "id_centrocontrol long, centralnombre string")
    sheet, dupes = energy.unit_configurations(configs, plants, *_sheet_tables(spark, "id_configuracion"),
                                              concept_ids=[791, 792], attributes=["Potencia", "Tension", "Otro"])
    got = {r["id"]: r for r in sheet.collect()}
    assert sheet.count() == 3
    assert (got[1]["Potencia"], got[1]["Tension"], got[1]["nombre centro control"], got[1]["nombre coordinado"]) == (
        "50 MW", "220 kV", "CC Norte", "Grupo Uno")
    assert got[2]["Potencia"] == "61 MW" and got[3]["Potencia"] is None and got[3]["nombre central"] is None
    assert rows(dupes, "configuracionnombre", "conceptonombre", "n") == [("U2", "Potencia", 2)]


def test_substations(spark):
    mk = spark.createDataFrame
    subs = mk([(1, 7, 8, None, "SE1", "1", "N1", "d", "C1")],
              "id_subestacion long, id_centrocontrol long, id_propietario long, id_coordinado long, "
              "subestacionnombre string, subestacionnumero string, subestacionnemotecnico string, "
              "subestaciondescripcion string, subestacioncodigo string")
    t = _sheet_tables(spark, "id_subestacion")
    sheet, dupes = energy.substations(subs, *t, concept_ids=[791], attributes=["Potencia"], order_by="fta_datovalortexto")
    r = sheet.collect()
    assert len(r) == 1 and r[0]["Potencia"] == "S1" and r[0]["id_coordinado"] == "" and r[0]["nombre propietario"] == "Dueño SA"


def _exports(base, files):
    for key, text in files.items():
        os.makedirs(os.path.dirname(os.path.join(base, key)), exist_ok=True)
        with open(os.path.join(base, key), "w", encoding="utf-8") as f:
            f.write(text)


def test_staging_halves_of_the_projections(spark, tmp_dir):
    from tidewater.sources import read_target
    raw, staging = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "staging")
    _exports(raw, {"plan/cmg/2021/Húmedo/cmg_2021.csv": "hidro,year,mes,barnom,valor\nH1,2030,3,B1,5.5\nH1,x,3,B1,\n", "plan/cmg/2021/Seco/barras_1.csv": "hidro,year,mes,barnom,valor\nS,2031,12,B2,1\n"})
    cols = {"hidro": "string", "year": "int", "mes": "int", "barnom": "string", "valor": "double"}
    energy.stage_marginal_cost(spark, raw, staging, cols, 2019)
    cost = read_target(spark, staging, "tabla", "cmg", ["year_partition", "escenario_partition"])
    assert rows(cost, "hidro", "year", "valor", "year_partition", "escenario_partition") == [("H1", 2030, 5.5, "2019", "Húmedo"), ("H1", None, None, "2019", "Húmedo")]
    assert read_target(spark, staging, "tabla", "barras").count() == 1
    energy.stage_marginal_cost(spark, raw, staging, cols, 2019)            # again: partitions are replaced
    assert read_target(spark, staging, "tabla", "cmg").count() == 2

    raw, staging = os.path.join(tmp_dir, "raw2"), os.path.join(tmp_dir, "staging2")
    head = ",".join(energy.SUPPLY_EXPORT)
    _exports(raw, {"a/b/Plan_de_Obras.csv": f"{head}\nSolar,Norte,P1,10,B,X,2030,E1\nSolar,Norte,P2,7,B,,2030,E1\nEólica,Norte,P3,5,B,T,2032,E1\n", "a/b/otro.csv": f"{head}\nGas,Sur,P9,1,B,T,2030,E1\n"})
    energy.stage_supply(spark, raw, staging, 2019)
    works = read_target(spark, staging, "tabla", "plan_de_obras", ["year"])
    assert works.count() == 3 and set(works.columns) == {"tecnologia", "region", "nombre_plp", "potencia", "barra_plp", "tipo_plp", "ano", "escenario", "year"}
    assert rows(energy.projected_supply(works.drop("year")), "tecnologia", "ano", "potencia") == [("Eólica", 2030, 0), ("Eólica", 2031, 0), ("Eólica", 2032, 5), ("Solar", 2030, 7), ("Solar", 2031, 0), ("Solar", 2032, 0)]

    raw, staging = os.path.join(tmp_dir, "raw3"), os.path.join(tmp_dir, "staging3")
    line = ["B1", "N1", "2030", "Ene", "1", "t", "s", "c", "r", "0.5", "2.5", "3.5", "M", "E", "p", "q", "x", "y", "1", "XIII", "13"]
    _exports(raw, {f"plan/demanda/{y}/{t}/x.csv": ",".join(energy.DEMAND_EXPORT) + "\n" + ",".join(line) + "\n" for y in (2020, 2021) for t in ("medio", "alto")})
    energy.stage_demand(spark, raw, staging)
    medio = read_target(spark, staging, "tabla", "medio", ["year"])
    assert rows(medio, "year") == [("2020",), ("2021",)]
    out = energy.projected_demand({"escenario_medio": medio.drop("year")}).first()
    assert (out["nombre_barra_proyeccion"], out["medida_horaria"], out["registro_romano"], out["registro_numerico"], out["year"]) == ("B1", 2.5, "XIII", "13", 2030)


def test_group_file_goes_on_where_it_ended(spark, tmp_dir):
    path = os.path.join(tmp_dir, "groups")
    frame = lambda p, n: spark.createDataFrame([(f"{p}{i:04d}", 2, 1) for i in range(n)], "NOINS string, NOINTERVALS int, IS_ACTIVE int")
    energy.write_group_file(energy.meter_batches(frame("A", 61)), path, "append")
    energy.write_group_file(energy.meter_batches(frame("B", 1)), path, "append")
    energy.write_group_file(energy.meter_batches(frame("C", 1000)), path, "append")
    lines = []
    for folder, _, names in sorted(os.walk(path)):
        for n in sorted(x for x in names if x.startswith("part-")):
            lines += open(os.path.join(folder, n)).read().splitlines()
    assert [x.split(";")[1] for x in lines] == [f"grupo{i}" for i in range(3 + 1 + 34)]
    assert lines[3] == "('B0000');grupo3" and lines[4].startswith("('C0000', ") and lines[-1].startswith("('C0990', ")
    assert [r["grupo"] for r in energy.read_group_file(spark, path).orderBy("grupo").collect()] == list(range(38))
    energy.write_group_file(energy.meter_batches(frame("D", 31)), path)
    assert energy.read_group_file(spark, path).count() == 2


def test_outcome_rows_and_home_sums(spark):
    from tidewater.plans import sport
    data = [(1, "A", "B", 2, 1, True), (2, "B", "A", 0, 3, False), (3, "A", "C", 1, 1, True), (4, "C", "A", 2, 2, None), (5, "A", "B", None, 1, False), (6, "B", "C", 0, 1, True)]
    m = spark.createDataFrame(data, "id int, home_team string, away_team string, home_score int, away_score int, neutral boolean")
    assert rows(sport.outcome_rows(m, "A"), "id", "side", "outcome") == [(1, "local", "gana"), (2, "visitante", "gana"), (3, "local", "empate"), (4, "visitante", "empate")]
    assert sport.outcome_rows(m).count() == 7 and sport.outcome_rows(m).columns[3:] == m.columns
    assert rows(sport.home_sums(m, "A"), "home_team", "id", "home_score", "away_score", "neutral") == [("A", 9, 3, 3, 2)]
    assert sport.home_sums(m).count() == 3


def test_insolvency_runs_are_published(spark, tmp_dir):
    from tidewater.sources import publish, read_version
    path = os.path.join(tmp_dir, "ins")
    reg = spark.createDataFrame([("3", "tres", "ACTIVO", 1)], "rut string, razon_social string, estado string, orden int")
    publish(spark.createDataFrame([("1", "r1", None, None), ("2", "r2", None, None)], "rut string, rol string, fecha_ejecucion string, proceso_finalizado boolean")
            .withColumn("fecha_publicacion", F.lit(None).cast("date")), path, None)
    new = lambda *ids: spark.createDataFrame([(i, f"r{i}", "02/01/2023") for i in ids], "rut string, rol string, fecha_publicacion string")
    cols = ["razon_social", "estado"]
    assert projects.publish_insolvency(path, new("2", "3"), reg, "2023-01-03", registry_cols=cols) == 2
    assert projects.publish_insolvency(path, new("3"), reg, "2023-01-04", registry_cols=cols) == 3
    got = {r["rut"]: (r["fecha_ejecucion"], r["proceso_finalizado"], r["razon_social"]) for r in read_version(spark, path).collect()}
    assert got == {"1": ("2023-01-03", True, None), "2": ("2023-01-04", True, None), "3": (None, None, "tres")}
    assert read_version(spark, path, 1).count() == 2
