"""Project and insolvency jobs: milestones with roll-up rows (B37), insolvency snapshot merge
(B22), active insolvencies joined to the registry (B41), representatives (B38)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import parse_date
from tidewater.functions.names import rename
from tidewater.functions.rules import not_in_keep_null
from tidewater.operators.history import snapshot_merge
from tidewater.operators.relational import lookup_join
from tidewater.operators.reshape import rollup_rows
from tidewater.operators.versions import latest_by
from tidewater.sources.snapshots import current_version, publish, read_version

# Milestone names that are not milestones.
KEEP_OUT = ["Antecedentes", "Antecedentes de Proyecto", "Antecedentes de Proyectos", "Antecedentes del Proyecto",
            "Cabecera"]
SUMMARY_LABEL = "H0: Fecha Proyectos"
DATE_COLS = ["fecha_planificada_inicio", "fecha_planificada_fin", "fecha_real_inicio", "fecha_real_fin"]


def project_milestones(milestones: DataFrame, order_by: str = "id_hito", keep_out: Sequence[str] = KEEP_OUT) -> DataFrame:
    """B37 (F4, X17, A16, U1): irrelevant milestones dropped (null names kept), project id =
    project + board, one summary row per project appended (earliest starts, latest ends,
    finished unless a milestone is explicitly unfinished, owner fields cleared)."""
    df = milestones.where(not_in_keep_null("nombre_hito", list(keep_out)))
    df = df.withColumn("id_proyecto", F.concat("id_proyecto", "id_tablero"))
    df = df.withColumns({c: F.to_date(c) for c in DATE_COLS})
    return rollup_rows(df, "id_proyecto", mins=["fecha_planificada_inicio", "fecha_real_inicio"],
                       maxs=["fecha_planificada_fin", "fecha_real_fin"], done_col="is_finalizado",
                       label_col="nombre_hito", label=SUMMARY_LABEL,
                       cleared=["nombre_lider_hito", "gerencia_hito", "id_hito"], order_by=order_by)


REGISTRY_COLS = ("razon_social", "tamano_de_empresa", "rubro_economico", "subrubro_economico", "estado")


def insolvency_merge(history: DataFrame, new: DataFrame, registry: DataFrame, as_of,
                     finished_by: str = "id", open_only: bool = False,
                     registry_cols: Sequence[str] = REGISTRY_COLS) -> DataFrame:
    """B22 (T1, X16, J10, J11, U2, D3, J3): today's insolvency list merged into the history.

    Publication dates of the new list are parsed from ``dd/MM/yyyy``; registry attributes
    (active rows only, last row per id by ``orden``; ``registry_cols``, e.g. a member flag column)
    are attached to the newly added ids.
    History is also an input of what replaces it: ``publish_insolvency`` publishes the result as the next version.
    """
    new = new.withColumn("fecha_publicacion", parse_date("fecha_publicacion", "dd/MM/yyyy"))
    return snapshot_merge(history, new, as_of, finished_by=finished_by, open_only=open_only, registry=registry,
                          registry_cols=list(registry_cols),
                          registry_filter=F.col("estado") == "ACTIVO", registry_order="orden")


def publish_insolvency(target: str, new: DataFrame, registry: DataFrame, as_of, **options) -> int:
    """B22 with its output: the newest published history of ``target`` merged with today's list and published as the next version, whose
    number is returned. A run that dies before its one commit step leaves the former version in place and can simply be run again; one that another
    run overtakes raises ``Outdated``. The first history is published with ``sources.publish``."""
    spark = new.sparkSession
    version = current_version(spark, target)
    return publish(insolvency_merge(read_version(spark, target, version), new, registry, as_of, **options), target, version)


def active_insolvencies(insolvencies: DataFrame, registry: DataFrame, order_by: str) -> DataFrame:
    """B41 (F1, D3, J3): every insolvency of a company whose registry has an active row, with the attributes of
    the last active one by ``order_by`` (columns of the registry)."""
    last = latest_by(registry.where(F.col("estado") == "ACTIVO"), ["rut"], order_by)
    return lookup_join(insolvencies, last, "rut").where(F.col("estado") == "ACTIVO")


REPRESENTATIVE_ROLE = 106
REPRESENTATIVE_RENAMES = {"per_id": "id_persona", "numero_socio": "id_socio", "nombre_completo": "nombre",
                          "telefono_movil_comercial": "celular_comercial", "email_comercial": "mail_comercial"}


def representatives(roles: DataFrame, people: DataFrame, role_id: int = REPRESENTATIVE_ROLE) -> DataFrame:
    """B38 (S2, F2, J3, P2): active relations of one role, people's contact data looked up
    (pruned to the listed columns), renamed to the dimension's names."""
    r = roles.select("per_id", "numero_socio", "id_rol", "estado_relacion").where(
        (F.col("id_rol") == role_id) & (F.col("estado_relacion") == "ACTIVA"))
    p = people.select("per_id", "rut", "nombre_completo", "telefono_comercial", "telefono_movil_comercial",
                      "email_comercial")
    out = rename(lookup_join(r, p, "per_id"), REPRESENTATIVE_RENAMES)
    return out.select("id_socio", "id_persona", "rut", "nombre", "telefono_comercial", "celular_comercial",
                      "mail_comercial")
