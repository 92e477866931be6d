"""ANSI SQL of every registered query, for a second engine over the same tables.

Written from the meaning of each query and not from its plan: personal aliases
are resolved by key here, types by CASE, sheets from the long rows they came from.
"""

from __future__ import annotations

import re

from airgauge.plans.catalog import HUBS, LINKS, SATELLITES
from airgauge.plans.questions import QUESTIONS

CUT = "TIMESTAMP '1998-01-05'"
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# name -> text; a CTE may use those above it
CTES = {
    "planta": """
        SELECT n_name AS planta_canon, 'Planta ' || n_name AS nombre_planta, r_name AS area,
               'Sector ' || n_nationkey AS sector
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "punto": """
        SELECT s_suppkey AS punto_nro, n_name AS planta_canon, 'Planta ' || n_name AS nombre_planta,
               'MG_' || (s_suppkey // 3) AS maquina_gen_codigo,
               'MG_' || (s_suppkey // 3) || '_C' || (s_suppkey % 5) AS componente_codigo_full,
               s_name AS nombre_punto, 'Punto ' || s_name AS descripcion_punto,
               CASE WHEN s_acctbal >= 0 THEN 'real' ELSE 'sintetico' END AS tipo_punto,
               'Máquina ' || (s_suppkey // 3) AS maquina_gen_nombre,
               CASE (s_suppkey // 3) % 4 WHEN 0 THEN 'correa' WHEN 1 THEN 'harnero' WHEN 2 THEN 'alimentador'
                    ELSE 'chancador' END AS tipo_maquina_gen,
               'Generadora ' || (s_suppkey // 3) AS descripcion
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "celda": """
        SELECT l_suppkey AS punto_nro, CAST(isoyear(l_shipdate) AS INTEGER) AS anio,
               CAST(week(l_shipdate) AS INTEGER) AS semana_nro,
               max(l_quantity) / 10 AS concentracion_mg_m3, max(CAST(l_shipdate AS DATE)) AS fecha_medicion,
               lpad(CAST(min(l_linenumber) + 6 AS VARCHAR), 2, '0') || ':00' AS hora_inicio,
               lpad(CAST(max(l_linenumber) + 12 AS VARCHAR), 2, '0') || ':30' AS hora_termino,
               min(l_orderkey) AS primera_orden, max(l_orderkey) AS ultima_orden
        FROM lineitem GROUP BY 1, 2, 3""",
    "celda1": f"""
        SELECT l_suppkey AS punto_nro, CAST(isoyear(l_shipdate) AS INTEGER) AS anio,
               CAST(week(l_shipdate) AS INTEGER) AS semana_nro,
               min(l_quantity) / 10 AS concentracion_mg_m3, max(CAST(l_shipdate AS DATE)) AS fecha_medicion,
               lpad(CAST(min(l_linenumber) + 6 AS VARCHAR), 2, '0') || ':00' AS hora_inicio,
               lpad(CAST(max(l_linenumber) + 12 AS VARCHAR), 2, '0') || ':30' AS hora_termino,
               min(l_orderkey) AS primera_orden, max(l_orderkey) AS ultima_orden
        FROM lineitem WHERE l_shipdate < {CUT} GROUP BY 1, 2, 3""",
    "mediciones": """
        SELECT c.* EXCLUDE (primera_orden, ultima_orden), p.* EXCLUDE (punto_nro), 'medido' AS estado,
               CAST(NULL AS VARCHAR) AS motivo_no_medicion
        FROM celda c LEFT JOIN punto p USING (punto_nro)""",
    "mediciones1": """
        SELECT c.* EXCLUDE (primera_orden, ultima_orden), p.* EXCLUDE (punto_nro), 'medido' AS estado,
               CAST(NULL AS VARCHAR) AS motivo_no_medicion
        FROM celda1 c LEFT JOIN punto p USING (punto_nro)""",
    "personas": """
        SELECT CAST(c_custkey AS VARCHAR) AS dni, 'RUN' AS tipo_dni, 'PAIS_' || c_nationkey AS dni_pais_emisor,
               c_name || ' ' || c_mktsegment AS nombre_completo,
               CASE c_custkey % 3 WHEN 0 THEN 'tecnico' WHEN 1 THEN 'operador' ELSE 'contratista' END AS tipo_persona
        FROM customer""",
    "mediciones_personas": """
        SELECT punto_nro, anio, semana_nro, rol, p.dni, p.tipo_dni, p.dni_pais_emisor
        FROM (SELECT punto_nro, anio, semana_nro, 'operador' AS rol, primera_orden AS orden FROM celda
              UNION ALL SELECT punto_nro, anio, semana_nro, 'tecnico', ultima_orden FROM celda) r
        JOIN orders ON o_orderkey = r.orden JOIN personas p ON p.dni = CAST(o_custkey AS VARCHAR)""",
    "mediciones_personas1": """
        SELECT punto_nro, anio, semana_nro, rol, p.dni, p.tipo_dni, p.dni_pais_emisor
        FROM (SELECT punto_nro, anio, semana_nro, 'operador' AS rol, primera_orden AS orden FROM celda1
              UNION ALL SELECT punto_nro, anio, semana_nro, 'tecnico', ultima_orden FROM celda1) r
        JOIN orders ON o_orderkey = r.orden JOIN personas p ON p.dni = CAST(o_custkey AS VARCHAR)""",
    "equipos": """
        SELECT s_suppkey AS maquina_nro,
               'PLT-' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || CASE WHEN s_suppkey % 4 < 2 THEN '-SCP-' ELSE '-SVE-' END
               || CASE s_suppkey % 4 WHEN 0 THEN 'HDP' WHEN 1 THEN 'CDS' WHEN 2 THEN 'VEX' ELSE 'VIN' END
               || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') || '-MEC' AS ubicacion_tecnica,
               'Equipo ' || s_name AS equipo_denom, r_name AS sector, n_name AS planta_canon,
               CASE s_suppkey % 4 WHEN 0 THEN 'HDP' WHEN 1 THEN 'CDS' WHEN 2 THEN 'VEX' ELSE 'VIN' END AS tipo_equipo,
               CASE WHEN s_suppkey % 4 < 2 THEN 'abatidor_polvo' ELSE 'renovacion_aire' END AS familia_equipo
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "equipos1": "SELECT * FROM equipos",
    "cobertura": """
        SELECT p.s_suppkey AS punto_nro, e.ubicacion_tecnica
        FROM equipos e JOIN supplier p ON p.s_suppkey IN (e.maquina_nro, e.maquina_nro + 1, e.maquina_nro + 7)""",
    "lineas": """
        SELECT l_orderkey, min(l_suppkey) AS maquina_nro, count(*) AS lineas, max(l_linenumber) AS mayor_linea,
               sum(l_linenumber) AS suma_linea, sum(l_quantity) AS cantidad,
               CAST(sum(CAST(l_quantity * (1 + l_tax) AS DECIMAL(18,4))) AS DOUBLE) AS cantidad_real,
               max(l_discount) AS mayor_descuento
        FROM lineitem GROUP BY 1""",
    "ordenes_base": """
        SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_orderkey AS VARCHAR) AS orden_nro, e.ubicacion_tecnica,
               e.equipo_denom, e.planta_canon, o_orderpriority AS ot_texto_breve,
               l.cantidad AS hh_planificadas, l.lineas * 2.0 AS duracion_planificada,
               CAST(l.lineas AS INTEGER) AS personal_prog, l.cantidad_real AS hh_reales,
               CAST(l.suma_linea AS DOUBLE) AS duracion_real, l.mayor_linea AS personal_real,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS cumpl_prog,
               l.mayor_descuento AS adherencia_prog, CAST(isoyear(o_orderdate) AS INTEGER) AS anio,
               CAST(week(o_orderdate) AS INTEGER) AS semana_nro, CAST(o_orderdate AS DATE) AS inicio_programado,
               e.equipo_denom AS denom_ubic_tecnica,
               CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS UBIGINT) % 4 AS cubo,
               CAST(NULL AS VARCHAR) AS fecha_inicio_extrema, CAST(NULL AS VARCHAR) AS fecha_liberacion,
               CAST(NULL AS VARCHAR) AS clase_orden, CAST(NULL AS VARCHAR) AS clase_actividad_pm,
               CAST(NULL AS VARCHAR) AS status_sistema
        FROM orders LEFT JOIN lineas l ON l.l_orderkey = o_orderkey LEFT JOIN equipos e USING (maquina_nro)""",
    "ordenes": """
        SELECT *, CASE WHEN cumpl_prog = 1 THEN inicio_programado END AS dia_ejecutado,
               CASE WHEN cumpl_prog = 0 THEN CASE cubo WHEN 0 THEN 'Falta de repuestos' WHEN 1 THEN 'Falta de personal'
                    WHEN 2 THEN 'Reprogramado por operaciones' ELSE 'Equipo en uso productivo' END END AS motivo_no_ejecucion,
               CASE WHEN cumpl_prog = 0 THEN CAST(CASE cubo WHEN 0 THEN 0.9 WHEN 1 THEN 0.7 WHEN 2 THEN 0.5 ELSE 0.6 END
                    AS DOUBLE) END AS peso_motivo,
               CASE WHEN cumpl_prog = 0 THEN inicio_programado + 7 END AS fecha_reprogramacion
        FROM ordenes_base""",
    "ordenes1": f"""
        SELECT * REPLACE (CAST(NULL AS INTEGER) AS cumpl_prog), CAST(NULL AS DATE) AS dia_ejecutado,
               CAST(NULL AS VARCHAR) AS motivo_no_ejecucion, CAST(NULL AS DOUBLE) AS peso_motivo,
               CAST(NULL AS DATE) AS fecha_reprogramacion
        FROM ordenes_base WHERE o_orderdate < {CUT}""",
    "ordenes_personas": """
        SELECT orden_nro, dni, tipo_dni, dni_pais_emisor
        FROM ordenes JOIN personas ON dni = CAST(o_custkey AS VARCHAR)""",
    "ordenes_personas1": """
        SELECT orden_nro, dni, tipo_dni, dni_pais_emisor
        FROM ordenes1 JOIN personas ON dni = CAST(o_custkey AS VARCHAR)""",
    "componentes": """
        SELECT 'MG_' || (s_suppkey // 3) || '_C' || (s_suppkey % 5) AS componente_codigo,
               'Componente MG_' || (s_suppkey // 3) || '_C' || (s_suppkey % 5) AS componente_nombre,
               CASE WHEN s_suppkey % 2 = 0 THEN 'CHUTE' ELSE 'FALDON' END AS tipo_componente,
               CAST(s_suppkey % 2 AS INTEGER) AS nivel_jerarquia, 'A_componente_correa' AS familia_causa,
               'MG_' || (s_suppkey // 3) AS maquina_gen_codigo,
               CASE WHEN s_suppkey % 2 = 1 THEN 'MG_' || ((s_suppkey - 1) // 3) || '_C' || ((s_suppkey - 1) % 5) END
               AS componente_padre_codigo
        FROM supplier""",
    "componentes_estado": """
        SELECT 'MG_' || (s_suppkey // 3) || '_C' || (s_suppkey % 5) AS componente_codigo,
               CASE WHEN s_acctbal < 0 THEN 'defectuoso' ELSE 'operativo' END AS estado_actual,
               CASE WHEN s_acctbal < 0 THEN 'grave' ELSE 'ninguna' END AS severidad, DATE '2001-12-31' AS fecha_inspeccion
        FROM supplier""",
    "condiciones_observadas": """
        SELECT user_id AS punto_nro, upper(event_type) AS condicion_codigo, CAST(isoyear(ts) - 24 AS INTEGER) AS anio,
               CAST(week(ts) AS INTEGER) AS semana_nro,
               CASE WHEN max(value) >= 100 THEN 'grave' WHEN max(value) >= 50 THEN 'medio' ELSE 'leve' END AS severidad
        FROM events GROUP BY 1, 2, 3, 4""",
    "condiciones_tipo": """
        SELECT DISTINCT upper(event_type) AS condicion_codigo, 'Condición ' || event_type AS condicion_nombre,
               CAST(length(event_type) / 10.0 AS DOUBLE) AS peso_causa_default,
               'PR_' || upper(substr(event_type, 1, 1)) AS problema_raiz_codigo
        FROM events""",
    "condiciones_problema": "SELECT condicion_codigo, problema_raiz_codigo FROM condiciones_tipo",
    "problemas": """
        SELECT DISTINCT problema_raiz_codigo, 'Problema ' || substr(problema_raiz_codigo, 4, 1) AS problema_raiz_nombre,
               CASE WHEN substr(problema_raiz_codigo, 4, 1) IN ('E', 'S') THEN 'A_componente_correa'
                    WHEN substr(problema_raiz_codigo, 4, 1) = 'P' THEN 'B_maqctrl_falla' ELSE 'C_ambiental_aseo' END AS familia_causa
        FROM condiciones_tipo""",
    "tipos_equipo": "SELECT DISTINCT tipo_equipo AS tipo_equipo_codigo, familia_equipo FROM equipos",
    "plantas_tipos": "SELECT planta_canon, tipo_equipo AS tipo_equipo_codigo FROM equipos",
    "plantas": "SELECT * FROM planta",
    "calendario": """
        SELECT CAST(d AS DATE) AS fecha_inicio_semana, CAST(d AS DATE) + 6 AS fecha_fin_semana,
               CAST(isoyear(d) AS INTEGER) AS anio, CAST(week(d) AS INTEGER) AS semana_nro,
               CAST(quarter(CAST(d AS DATE) + 6) AS INTEGER) AS trimestre, CAST(month(CAST(d AS DATE) + 6) AS INTEGER) AS mes
        FROM generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2030-12-30', INTERVAL 7 DAY) g(d)""",
    "semanas": "SELECT * FROM calendario",
    # --- marts ---
    "ranking_semanal": """
        SELECT planta_canon, nombre_planta, punto_nro, nombre_punto, descripcion_punto, tipo_punto, maquina_gen_codigo,
               maquina_gen_nombre, anio, semana_nro, fecha_inicio_semana, fecha_fin_semana, fecha_medicion, hora_inicio,
               hora_termino, concentracion_mg_m3, estado, motivo_no_medicion, 'fiscalizacion' AS ambito
        FROM mediciones LEFT JOIN calendario USING (anio, semana_nro)""",
    "promedios_planta": """
        SELECT planta_canon, nombre_planta, anio, semana_nro, count(*) AS n_mediciones,
               CAST(CAST(sum(CAST(concentracion_mg_m3 AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS DECIMAL(18,3)) AS promedio_mg_m3,
               CAST(max(concentracion_mg_m3) AS DECIMAL(18,3)) AS maximo_mg_m3,
               CAST(min(concentracion_mg_m3) AS DECIMAL(18,3)) AS minimo_mg_m3, 'fiscalizacion' AS ambito
        FROM mediciones GROUP BY 1, 2, 3, 4""",
    "responsables": """
        SELECT punto_nro, anio, semana_nro, max(CASE WHEN rol = 'operador' THEN nombre_completo END) AS operador_panel,
               max(CASE WHEN rol = 'tecnico' THEN nombre_completo END) AS tecnico_higiene
        FROM mediciones_personas JOIN personas USING (dni, tipo_dni, dni_pais_emisor) GROUP BY 1, 2, 3""",
    "detalle_medicion": """
        SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, fecha_inicio_semana, fecha_fin_semana,
               fecha_medicion, hora_inicio, hora_termino, concentracion_mg_m3, estado, motivo_no_medicion,
               operador_panel, tecnico_higiene, 'fiscalizacion' AS ambito
        FROM ranking_semanal LEFT JOIN responsables USING (punto_nro, anio, semana_nro)""",
    "cobertura_semanal": """
        SELECT planta_canon, maquina_gen_codigo, maquina_gen_nombre, tipo_maquina_gen, punto_nro, nombre_punto, anio,
               semana_nro, fecha_inicio_semana, fecha_fin_semana, fecha_medicion, concentracion_mg_m3, estado,
               'fiscalizacion' AS ambito
        FROM mediciones LEFT JOIN calendario USING (anio, semana_nro)""",
    "ventanas_temporales": """
        SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, fecha_inicio_semana, fecha_fin_semana,
               concentracion_mg_m3, estado, 'fiscalizacion' AS ambito
        FROM mediciones LEFT JOIN calendario USING (anio, semana_nro)""",
    "tendencias": """
        SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, concentracion_mg_m3, estado,
               'fiscalizacion' AS ambito FROM mediciones""",
    "causa_raiz": """
        SELECT m.planta_canon, m.punto_nro, m.nombre_punto, m.anio, m.semana_nro, m.concentracion_mg_m3,
               'condicion' AS tipo_causa, t.condicion_nombre AS causa_descripcion, t.condicion_nombre, o.condicion_codigo,
               o.severidad, p.problema_raiz_nombre, substr(p.familia_causa, 1, 1) AS familia_causa,
               m.componente_codigo_full AS componente_codigo, k.componente_nombre, k.tipo_componente,
               s.estado_actual AS estado_componente, CAST(NULL AS VARCHAR) AS equipo_denom,
               CAST(NULL AS VARCHAR) AS tipo_equipo, CAST(NULL AS VARCHAR) AS familia_equipo,
               CAST(NULL AS VARCHAR) AS ot_relacionada, CAST(NULL AS VARCHAR) AS motivo_no_ejecucion,
               CAST(NULL AS DATE) AS fecha_reprogramacion, t.peso_causa_default AS peso_causa,
               t.peso_causa_default >= 0.80 AS es_causa_principal, 'fiscalizacion' AS ambito
        FROM mediciones m JOIN condiciones_observadas o USING (punto_nro, anio, semana_nro)
        LEFT JOIN condiciones_tipo t USING (condicion_codigo) LEFT JOIN problemas p USING (problema_raiz_codigo)
        LEFT JOIN componentes k ON k.componente_codigo = m.componente_codigo_full
        LEFT JOIN componentes_estado s ON s.componente_codigo = m.componente_codigo_full
        UNION ALL
        SELECT m.planta_canon, m.punto_nro, m.nombre_punto, m.anio, m.semana_nro, m.concentracion_mg_m3, 'mantencion',
               o.ot_texto_breve, NULL, NULL, NULL, 'Máquina de control detenida', 'B', NULL, NULL, NULL, NULL,
               e.equipo_denom, e.tipo_equipo, e.familia_equipo, o.orden_nro, o.motivo_no_ejecucion,
               o.fecha_reprogramacion, o.peso_motivo, o.peso_motivo >= 0.80, 'mantencion'
        FROM ordenes o JOIN equipos e USING (ubicacion_tecnica) JOIN cobertura c USING (ubicacion_tecnica)
        JOIN mediciones m ON m.punto_nro = c.punto_nro AND m.anio = o.anio AND m.semana_nro = o.semana_nro
        WHERE o.cumpl_prog = 0""",
    "ot": """
        SELECT o.orden_nro, o.ot_texto_breve, o.ubicacion_tecnica, e.equipo_denom, e.tipo_equipo, e.familia_equipo,
               e.sector, e.planta_canon, 'Planta ' || e.planta_canon AS nombre_planta, o.anio, o.semana_nro,
               o.inicio_programado, o.hh_planificadas, o.duracion_planificada, o.personal_prog, o.hh_reales,
               o.personal_real, o.duracion_real, o.cumpl_prog, o.adherencia_prog, o.dia_ejecutado,
               o.motivo_no_ejecucion, o.peso_motivo, o.fecha_reprogramacion, c.punto_nro, u.nombre_punto, o.o_custkey,
               'mantencion' AS ambito
        FROM ordenes o JOIN equipos e USING (ubicacion_tecnica) LEFT JOIN cobertura c USING (ubicacion_tecnica)
        LEFT JOIN punto u ON u.punto_nro = c.punto_nro""",
    "no_ejecucion_ot": """
        SELECT * EXCLUDE (hh_reales, personal_real, duracion_real, adherencia_prog, dia_ejecutado, o_custkey)
        FROM ot WHERE cumpl_prog = 0""",
    "ejecucion_ot": """
        SELECT ot.* EXCLUDE (motivo_no_ejecucion, peso_motivo, fecha_reprogramacion, o_custkey),
               p.nombre_completo AS responsable_nombre, p.tipo_persona AS responsable_tipo
        FROM ot LEFT JOIN personas p ON p.dni = CAST(o_custkey AS VARCHAR) WHERE cumpl_prog = 1""",
    "ot_en_curso": """
        SELECT * EXCLUDE (hh_reales, personal_real, duracion_real, adherencia_prog, dia_ejecutado, motivo_no_ejecucion,
                          peso_motivo, fecha_reprogramacion, o_custkey)
        FROM ot WHERE cumpl_prog IS NULL OR cumpl_prog = 0""",
    "limites_fecha": """
        SELECT date_trunc('week', min(l_shipdate)) AS primero, date_trunc('week', max(l_shipdate)) AS ultimo FROM lineitem""",
    "rejilla": """
        SELECT p.punto_nro, c.*
        FROM punto p, calendario c, limites_fecha f
        WHERE c.fecha_inicio_semana BETWEEN CAST(f.primero AS DATE) AND CAST(f.ultimo AS DATE)""",
}

_WORD = re.compile(r"[a-z_0-9]+")


def sql(body: str) -> str:
    """`body` with the CTEs it names, and those they name, in order."""
    wanted: set[str] = set()
    pending = [body]
    while pending:
        for word in set(_WORD.findall(pending.pop())) & CTES.keys():
            if word not in wanted:
                wanted.add(word)
                pending.append(CTES[word])
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in CTES.items() if name in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body


DOUBLES = {
    "concentracion_mg_m3", "peso_causa_default", "hh_reales", "duracion_real", "adherencia_prog", "peso_motivo",
    "hh_planificadas", "duracion_planificada",
}


def md5_of(cols, prefix: str = "") -> str:
    parts = []
    for col in cols:
        value = f"CAST({prefix}{col} AS DECIMAL(18,6))" if col in DOUBLES else f"{prefix}{col}"
        parts.append(f"coalesce(CAST({value} AS VARCHAR), '{NULL_TOKEN}')")
    return "md5(" + " || '-' || ".join(parts) + ")"


def first_batch(source: str) -> str:
    return f"{source}1" if f"{source}1" in CTES else source


def _keys_by_load(key, sources, not_null=()) -> str:
    """Distinct keys with the load (1 or 2) that brings them first."""
    where = " AND ".join(f"{c} IS NOT NULL" for c in not_null) or "TRUE"
    cols = ", ".join(key)
    parts = [f"SELECT {cols}, 1 AS carga FROM {first_batch(s)} WHERE {where}" for s in sources]
    parts += [f"SELECT {cols}, 2 AS carga FROM {s} WHERE {where}" for s in sources]
    return f"SELECT {cols}, min(carga) AS carga FROM ({' UNION ALL '.join(parts)}) x GROUP BY {cols}"


def hub_sql(h) -> str:
    return sql(
        f"SELECT {md5_of(h.key)} AS huella_registro, {', '.join(h.key)}, carga FROM ({_keys_by_load(h.key, h.sources)}) k"
    )


def link_sql(l) -> str:
    cols = list(dict.fromkeys([*l.key, *[c for m in l.members.values() for c in m]]))
    members = ", ".join(f"{md5_of(c)} AS {name}" for name, c in l.members.items())
    keys = _keys_by_load(cols, (l.source,), l.not_null)
    return sql(f"SELECT {md5_of(l.key)} AS huella_registro, {members}, {', '.join(cols)}, carga FROM ({keys}) k")


def satellite_sql(s) -> str:
    where = s.where or "TRUE"
    attrs = ", ".join(s.attributes)

    def rows(source: str) -> str:
        return (
            f"SELECT DISTINCT {md5_of(s.key)} AS huella_registro, {md5_of(s.attributes)} AS _huella_contenido, {attrs} "
            f"FROM {source} WHERE {where}"
        )

    a, b = rows(first_batch(s.source)), rows(s.source)
    return sql(
        f"SELECT *, 1 AS version_seq, 1 AS carga FROM ({a}) a UNION ALL "
        f"SELECT n.*, CASE WHEN v.huella_registro IS NULL THEN 1 ELSE 2 END, 2 FROM ({b}) n LEFT JOIN ({a}) v "
        f"ON v.huella_registro = n.huella_registro "
        f"WHERE v.huella_registro IS NULL OR v._huella_contenido <> n._huella_contenido"
    )


def _avg(col: str) -> str:
    return f"CAST(CAST(sum(CAST({col} AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS DECIMAL(18,3))"


WEIGHTED = "CAST(CAST(sum(promedio_mg_m3 * n_mediciones) AS DOUBLE) / nullif(sum(n_mediciones), 0) AS DECIMAL(18,3))"
RANK = (
    "planta_canon, punto_nro, nombre_punto, maquina_gen_nombre, anio, semana_nro, fecha_medicion, concentracion_mg_m3, "
    "estado, ambito"
)


def _window(event: str, name: str, frame: str = "ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING") -> str:
    return f"""
        SELECT planta_canon, anio, semana_inicio, semana_fin, CAST({name} AS BIGINT) AS {name} FROM (
          SELECT *, row_number() OVER (PARTITION BY planta_canon ORDER BY {name} DESC, anio, semana_inicio) AS lugar FROM (
            SELECT planta_canon, anio, semana_nro AS semana_inicio, semana_nro + 3 AS semana_fin,
                   sum(n) OVER (PARTITION BY planta_canon, anio ORDER BY semana_nro {frame}) AS {name}
            FROM (SELECT planta_canon, anio, semana_nro, count(*) AS n FROM ventanas_temporales WHERE {event}
                  GROUP BY 1, 2, 3) s) w) r WHERE lugar = 1"""


def _span(event: str) -> str:
    return f"""
        SELECT punto_nro, anio, min(semana_nro) AS desde, max(semana_nro) AS hasta, count(*) AS n_eventos, planta_canon
        FROM ventanas_temporales WHERE {event} GROUP BY punto_nro, anio, planta_canon"""


def _latest_done(cols: str) -> str:
    return f"""
        SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY equipo_denom
          ORDER BY anio DESC, semana_nro DESC, orden_nro, punto_nro NULLS FIRST) AS lugar FROM ejecucion_ot) t
        WHERE lugar = 1"""


HIGH = "concentracion_mg_m3 >= 2.5"
LOW = "estado = 'medido' AND concentracion_mg_m3 BETWEEN 0.01 AND 1.0"

QUESTION_SQL = {
    "P1": f"""SELECT {RANK} FROM ranking_semanal
        WHERE anio * 100 + semana_nro = (SELECT max(anio * 100 + semana_nro) FROM ranking_semanal WHERE estado = 'medido')
        ORDER BY concentracion_mg_m3 DESC, punto_nro LIMIT 1""",
    "P2": f"""SELECT {RANK} FROM ranking_semanal
        WHERE anio * 100 + semana_nro = (SELECT max(anio * 100 + semana_nro) FROM ranking_semanal WHERE estado = 'medido')
          AND concentracion_mg_m3 > 0
        ORDER BY concentracion_mg_m3, punto_nro LIMIT 1""",
    "P3": f"""SELECT planta_canon, ambito, CAST(sum(n_mediciones) AS BIGINT) AS n_mediciones, {WEIGHTED} AS promedio_mg_m3,
        max(maximo_mg_m3) AS maximo_mg_m3, min(minimo_mg_m3) AS minimo_mg_m3 FROM promedios_planta GROUP BY 1, 2""",
    "P4": f"""SELECT planta_canon, ambito, CAST(sum(n_mediciones) AS BIGINT) AS n_mediciones, {WEIGHTED} AS promedio_mg_m3,
        max(maximo_mg_m3) AS maximo_mg_m3, min(minimo_mg_m3) AS minimo_mg_m3, grouping(planta_canon) = 1 AS es_total
        FROM promedios_planta GROUP BY ROLLUP(planta_canon), ambito""",
    "P5": f"""SELECT planta_canon, ambito, CAST(sum(n_mediciones) AS BIGINT) AS n_mediciones, {WEIGHTED} AS promedio_mg_m3,
        max(maximo_mg_m3) AS pico_mg_m3 FROM promedios_planta GROUP BY 1, 2
        ORDER BY promedio_mg_m3 DESC, planta_canon LIMIT 1""",
    "P6": f"""SELECT planta_canon, ambito, CAST(sum(n_mediciones) AS BIGINT) AS n_mediciones, {WEIGHTED} AS promedio_mg_m3,
        min(minimo_mg_m3) AS minimo_mg_m3 FROM promedios_planta WHERE promedio_mg_m3 > 0 GROUP BY 1, 2
        ORDER BY promedio_mg_m3, planta_canon LIMIT 1""",
    "P7": """SELECT c.punto_nro, c.anio, c.semana_nro, tipo_causa, causa_descripcion, condicion_codigo, condicion_nombre,
        severidad, problema_raiz_nombre, familia_causa, ot_relacionada, peso_causa, es_causa_principal, planta_canon, ambito
        FROM causa_raiz c JOIN (
          SELECT punto_nro, anio, semana_nro, row_number() OVER (PARTITION BY punto_nro
            ORDER BY concentracion_mg_m3 DESC, anio, semana_nro) AS lugar
          FROM causa_raiz WHERE concentracion_mg_m3 >= 2.5) s
        ON s.punto_nro = c.punto_nro AND s.anio = c.anio AND s.semana_nro = c.semana_nro AND s.lugar = 1""",
    "P8": """SELECT punto_nro, nombre_punto, equipo_denom, tipo_equipo, familia_equipo, ot_relacionada, motivo_no_ejecucion,
        fecha_reprogramacion, planta_canon, anio, semana_nro, ambito FROM causa_raiz
        WHERE familia_causa = 'B' AND ot_relacionada IS NOT NULL""",
    "P9": """SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, fecha_medicion, hora_inicio, hora_termino,
        concentracion_mg_m3, estado FROM detalle_medicion""",
    "P10": """SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, fecha_medicion, operador_panel,
        tecnico_higiene FROM detalle_medicion""",
    "P11": """SELECT p.planta_canon, r.punto_nro, p.nombre_punto, r.anio, r.semana_nro, r.fecha_inicio_semana,
        'no_medido' AS estado, 'sin_registro' AS motivo_no_medicion
        FROM rejilla r JOIN punto p USING (punto_nro)
        WHERE NOT EXISTS (SELECT 1 FROM celda c WHERE c.punto_nro = r.punto_nro AND c.anio = r.anio
                          AND c.semana_nro = r.semana_nro)""",
    "P12": """SELECT DISTINCT planta_canon, maquina_gen_nombre, punto_nro, nombre_punto, concentracion_mg_m3, fecha_medicion,
        anio, semana_nro FROM cobertura_semanal WHERE estado = 'medido'""",
    "P13": _window(HIGH, "n_altos_ventana"),
    "P14": _span(HIGH),
    "P15": _span(LOW),
    "P16": _window(LOW, "n_bajos_ventana"),
    "P17": f"""WITH_RISING SELECT t.planta_canon, round(t.pendiente, 6) AS pendiente, round(t.r2, 6) AS r2, m.punto_nro,
        m.nombre_punto, {_avg('m.concentracion_mg_m3')} AS promedio_punto
        FROM (SELECT planta_canon, regr_slope(prom, semana_nro) AS pendiente, regr_r2(prom, semana_nro) AS r2
              FROM (SELECT planta_canon, semana_nro,
                           CAST(sum(CAST(concentracion_mg_m3 AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS prom
                    FROM tendencias WHERE estado = 'medido' GROUP BY 1, 2) s
              GROUP BY 1 HAVING count(*) >= 2 AND regr_slope(prom, semana_nro) > 0
              ORDER BY pendiente DESC, planta_canon LIMIT 1) t
        JOIN tendencias m ON m.planta_canon = t.planta_canon WHERE m.estado = 'medido' GROUP BY 1, 2, 3, 4, 5""".replace(
        "WITH_RISING ", ""
    ),
    "P18": _latest_done(
        "punto_nro, nombre_punto, equipo_denom, orden_nro, ot_texto_breve, inicio_programado, anio, semana_nro, hh_reales, "
        "responsable_nombre, planta_canon"
    ),
    "P19": """SELECT punto_nro, nombre_punto, equipo_denom, orden_nro, anio, semana_nro, responsable_nombre, planta_canon
        FROM ejecucion_ot""",
    "P20": """SELECT punto_nro, nombre_punto, orden_nro, equipo_denom, anio, semana_nro,
        personal_real AS personas_que_trabajaron, personal_prog AS personas_planificadas, planta_canon FROM ejecucion_ot""",
    "P21": _latest_done(
        "punto_nro, nombre_punto, equipo_denom, orden_nro, inicio_programado AS fecha_planificada, anio, semana_nro, "
        "planta_canon"
    ),
    "P22": """SELECT punto_nro, nombre_punto, orden_nro, equipo_denom, ot_texto_breve, anio, semana_nro, hh_planificadas,
        hh_reales, duracion_planificada, duracion_real, hh_reales - hh_planificadas AS desviacion_hh, planta_canon
        FROM ejecucion_ot""",
    "P23": """SELECT punto_nro, nombre_punto, orden_nro, equipo_denom, ot_texto_breve, inicio_programado AS fecha_original,
        motivo_no_ejecucion, fecha_reprogramacion, anio, semana_nro, planta_canon FROM no_ejecucion_ot
        WHERE fecha_reprogramacion IS NOT NULL""",
    "P24": """SELECT punto_nro, nombre_punto, equipo_denom, ubicacion_tecnica, tipo_equipo, familia_equipo, planta_canon,
        orden_nro, ot_texto_breve, inicio_programado AS fecha_programada, motivo_no_ejecucion, fecha_reprogramacion, anio,
        semana_nro FROM no_ejecucion_ot""",
    "P25": """SELECT punto_nro, nombre_punto, orden_nro, ot_texto_breve, equipo_denom, planta_canon, inicio_programado, anio,
        semana_nro FROM ot_en_curso
        WHERE anio * 100 + semana_nro = (SELECT max(anio * 100 + semana_nro) FROM ot_en_curso)""",
    "P26": """SELECT punto_nro, nombre_punto, orden_nro, ot_texto_breve, equipo_denom, ubicacion_tecnica, planta_canon,
        tipo_equipo, inicio_programado, hh_planificadas, anio, semana_nro FROM ot_en_curso""",
}

BAND = """CASE WHEN concentracion_mg_m3 < 0.25 THEN 'bajo' WHEN concentracion_mg_m3 < 0.5 THEN 'controlado'
    WHEN concentracion_mg_m3 < 2.5 THEN 'alerta' WHEN concentracion_mg_m3 < 5 THEN 'peligroso' ELSE 'critico' END"""

EARLIER_SQL = {
    "B1": f"""SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, concentracion_mg_m3,
        {BAND} AS etiqueta_semaforo, CAST(2.5 AS DOUBLE) AS limite_interno_mg_m3,
        round(concentracion_mg_m3 / CAST(2.5 AS DOUBLE), 2) AS veces_sobre_limite
        FROM (SELECT *, max(anio * 100 + semana_nro) OVER (PARTITION BY planta_canon) AS ultima FROM ranking_semanal) t
        WHERE anio * 100 + semana_nro = ultima AND concentracion_mg_m3 >= 2.5""",
    "B3": """SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, fecha_medicion, concentracion_mg_m3,
        operador_panel, tecnico_higiene, hora_inicio, hora_termino
        FROM (SELECT *, row_number() OVER (PARTITION BY planta_canon
              ORDER BY concentracion_mg_m3 DESC, anio, semana_nro, punto_nro) AS lugar FROM detalle_medicion) t
        WHERE lugar = 1""",
    "B4": f"""SELECT planta_canon, punto_nro, nombre_punto, anio, semana_nro, concentracion_mg_m3,
        {BAND} AS etiqueta_semaforo, operador_panel, tecnico_higiene FROM detalle_medicion
        WHERE anio * 100 + semana_nro = (SELECT max(anio * 100 + semana_nro) FROM detalle_medicion)""",
}

ANNUAL = f"""SELECT planta_canon AS planta, anio, count(DISTINCT semana_nro) AS semanas_medidas,
    count(DISTINCT punto_nro) AS puntos_medidos, {_avg('concentracion_mg_m3')} AS concentracion_promedio_mg_m3,
    CAST(max(concentracion_mg_m3) AS DECIMAL(18,3)) AS concentracion_max_mg_m3,
    CAST(min(concentracion_mg_m3) AS DECIMAL(18,3)) AS concentracion_min_mg_m3,
    count(CASE WHEN concentracion_mg_m3 >= 2.5 THEN 1 END) AS registros_sobre_limite, count(*) AS total_registros,
    round(CAST(count(CASE WHEN concentracion_mg_m3 >= 2.5 THEN 1 END) AS DOUBLE) * 100 / count(*), 2) AS pct_sobre_limite,
    CAST(2.5 AS DOUBLE) AS limite_interno_mg_m3 FROM cobertura_semanal GROUP BY 1, 2"""

TREND = """SELECT planta_canon, anio, pendiente_mg_m3_por_semana, r2,
    CASE WHEN pendiente_mg_m3_por_semana > 0.005 THEN 'creciente' WHEN pendiente_mg_m3_por_semana < -0.005 THEN 'decreciente'
         WHEN pendiente_mg_m3_por_semana IS NOT NULL THEN 'estable' END AS tendencia,
    n_puntos, promedio_planta_mg_m3
    FROM (SELECT planta_canon, anio, CASE WHEN count(*) >= 2 THEN round(regr_slope(prom, semana_nro), 6) END
                 AS pendiente_mg_m3_por_semana, CASE WHEN count(*) >= 2 THEN round(regr_r2(prom, semana_nro), 6) END AS r2
          FROM (SELECT planta_canon, anio, semana_nro,
                       CAST(sum(CAST(concentracion_mg_m3 AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS prom
                FROM tendencias GROUP BY 1, 2, 3) s GROUP BY 1, 2) a
    JOIN (SELECT planta_canon, anio, count(DISTINCT punto_nro) AS n_puntos, """ + _avg("concentracion_mg_m3") + """
          AS promedio_planta_mg_m3 FROM tendencias GROUP BY 1, 2) b USING (planta_canon, anio)"""

REPORT_SQL = {
    "concentracion_anual": ANNUAL,
    "ot_no_ejecutadas": """SELECT DISTINCT orden_nro, ot_texto_breve, equipo_denom, ubicacion_tecnica, tipo_equipo,
        familia_equipo AS familia, planta_canon, anio, semana_nro, inicio_programado, motivo_no_ejecucion,
        fecha_reprogramacion FROM no_ejecucion_ot""",
    "tendencias_planta": TREND,
}

KPI_SQL = {
    "concentracion_maxima_ultima_jornada": """SELECT planta_canon AS planta, nombre_punto AS punto_evaluacion, punto_nro,
        concentracion_mg_m3 AS valor_actual,
        CASE WHEN concentracion_mg_m3 >= 2.5 THEN 'sobre_limite' ELSE 'bajo_limite' END AS estado_limite,
        CAST(2.5 AS DOUBLE) AS limite_interno_mg_m3, anio, semana_nro AS semana,
        CASE WHEN concentracion_mg_m3 >= 3 THEN 'critico' WHEN concentracion_mg_m3 >= 2 THEN 'warning' ELSE 'ok' END AS nivel
        FROM cobertura_semanal
        WHERE anio * 100 + semana_nro = (SELECT max(anio * 100 + semana_nro) FROM cobertura_semanal)""",
    "pct_sobre_limite_anual": f"""SELECT planta, anio, pct_sobre_limite AS valor_actual, registros_sobre_limite,
        total_registros, limite_interno_mg_m3,
        CASE WHEN pct_sobre_limite >= 15 THEN 'critico' WHEN pct_sobre_limite >= 5 THEN 'warning' ELSE 'ok' END AS nivel
        FROM ({ANNUAL}) a""",
    "puntos_criticos_ultima_jornada": """SELECT planta, valor_actual, puntos_totales,
        CASE WHEN valor_actual >= 3 THEN 'critico' WHEN valor_actual >= 1 THEN 'warning' ELSE 'ok' END AS nivel
        FROM (SELECT planta_canon AS planta, count(CASE WHEN concentracion_mg_m3 >= 2.5 THEN 1 END) AS valor_actual,
                     count(*) AS puntos_totales FROM cobertura_semanal
              WHERE anio * 100 + semana_nro = (SELECT max(anio * 100 + semana_nro) FROM cobertura_semanal)
              GROUP BY 1) t""",
}

# columns that leave the marts as doubles
MART_DOUBLES = ("promedio_mg_m3", "maximo_mg_m3", "minimo_mg_m3")


def question_sql(qid: str) -> str:
    return sql(QUESTION_SQL[qid])


assert QUESTION_SQL.keys() == QUESTIONS.keys()
HUB_SQL = {h.name: hub_sql(h) for h in HUBS}
LINK_SQL = {l.name: link_sql(l) for l in LINKS}
SATELLITE_SQL = {s.name: satellite_sql(s) for s in SATELLITES}


# --- everything else -----------------------------------------------------------

SHEET_LABEL = """CASE WHEN s_suppkey % 2 = 0 THEN upper(replace(s_name, '#', '   #'))
    ELSE replace(s_name, '#', '   #') || '  ' END"""

CTES["celda_personas"] = """
    SELECT c.*, p.planta_canon AS planta, p.nombre_punto,
           CASE WHEN c.primera_orden % 2 = 0 THEN '  CUSTOMER#' || lpad(CAST(a.o_custkey AS VARCHAR), 9, '0') || ' '
                ELSE 'P-' || a.o_custkey END AS operador_alias,
           CASE WHEN c.ultima_orden % 2 = 0 THEN '  CUSTOMER#' || lpad(CAST(b.o_custkey AS VARCHAR), 9, '0') || ' '
                ELSE 'P-' || b.o_custkey END AS tecnico_alias,
           CAST((date_diff('day', DATE '1990-01-01', c.fecha_medicion) // 7) // 52 AS INTEGER) AS bloque,
           CAST((date_diff('day', DATE '1990-01-01', c.fecha_medicion) // 7) % 52 + 1 AS INTEGER) AS pos
    FROM celda c JOIN punto p USING (punto_nro) JOIN orders a ON a.o_orderkey = c.primera_orden
    JOIN orders b ON b.o_orderkey = c.ultima_orden"""
CTES["encabezado"] = """
    SELECT planta, bloque, pos, CAST(max(semana_nro) AS VARCHAR) AS semanas, CAST(max(fecha_medicion) AS VARCHAR) AS fecha,
           max(operador_alias) AS operador, max(tecnico_alias) AS tecnico, max(hora_inicio) AS hora_inicio,
           max(hora_termino) AS hora_termino, CAST(max(semana_nro) + 1100 AS VARCHAR) AS tph
    FROM celda_personas GROUP BY 1, 2, 3"""
CTES["hoja_larga"] = f"""
    SELECT planta, bloque, 'Semanas' AS etiqueta, 'column' || lpad(CAST(pos AS VARCHAR), 2, '0') AS _col_posicion, semanas AS valor FROM encabezado
    UNION ALL SELECT planta, bloque, 'Fecha medicion', 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), fecha FROM encabezado
    UNION ALL SELECT planta, bloque, 'Operador Panel', 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), operador FROM encabezado
    UNION ALL SELECT planta, bloque, 'Técnico Higiene', 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), tecnico FROM encabezado
    UNION ALL SELECT planta, bloque, 'Hora inicio', 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), hora_inicio FROM encabezado
    UNION ALL SELECT planta, bloque, 'Hora termino', 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), hora_termino FROM encabezado
    UNION ALL SELECT planta, bloque, 'Tratamiento tph', 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), tph FROM encabezado
    UNION ALL SELECT planta, bloque, {SHEET_LABEL}, 'column' || lpad(CAST(pos AS VARCHAR), 2, '0'), CAST(concentracion_mg_m3 AS VARCHAR)
              FROM celda_personas JOIN supplier ON s_suppkey = punto_nro"""
CTES["hoja_ordenes"] = """
    SELECT 'OT-' || o_orderkey AS orden_nro,
           'equipo   NRO ' || (maquina_nro // 2) AS equipo_denom, o_orderpriority AS ot_texto_breve,
           'P-' || o_custkey AS responsable, CAST(NULL AS VARCHAR) AS pto_trabajo_ejecutor, cantidad AS hh_planificadas,
           CAST(lineas AS DOUBLE) AS duracion_planificada, CAST(lineas AS INTEGER) AS personal_prog,
           cantidad_real AS hh_reales, CASE WHEN lineas > 1 THEN CAST(suma_linea AS DOUBLE) END AS duracion_real,
           CAST(mayor_linea + 1 AS INTEGER) AS personal_real,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS cumpl_prog, mayor_descuento AS adherencia_prog,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha_inicio_extrema, 2026 AS anio, 19 AS semana_nro,
           CASE WHEN lineas IS NOT NULL AND isodow(o_orderdate) <= 6 THEN DATE '2026-05-04' + CAST(isodow(o_orderdate) - 1 AS INTEGER)
                ELSE DATE '2026-05-04' END AS dia,
           CAST(('0x' || substr(md5('OT-' || o_orderkey), 1, 8)) AS UBIGINT) % 4 AS cubo, maquina_nro
    FROM orders LEFT JOIN lineas ON l_orderkey = o_orderkey"""
CTES["nombres_repetidos"] = """
    SELECT ubicacion_tecnica, planta_canon, maquina_nro // 2 AS nombre FROM equipos"""
CTES["ordenes_nombradas"] = """
    SELECT h.orden_nro, h.maquina_nro // 2 AS nombre, e.planta_canon AS planta_hoja
    FROM hoja_ordenes h LEFT JOIN equipos e USING (maquina_nro)"""
CTES["concedido"] = """
    SELECT c_name AS user_id, c_custkey, n_name, r_name,
           CASE c_custkey % 5 WHEN 0 THEN 'Público' WHEN 1 THEN 'Interno' WHEN 2 THEN 'Restringido'
                WHEN 3 THEN 'Solo gerencias' END AS nivel
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
CTES["permisos"] = """
    SELECT c.user_id, 'planta' AS dimension, n.n_name AS value
    FROM concedido c JOIN nation n ON (c.c_custkey % 7 = 0 AND n.n_name = c.n_name)
      OR (c.c_custkey % 7 <> 0 AND n.n_regionkey = (SELECT r_regionkey FROM region r WHERE r.r_name = c.r_name))
    WHERE c.c_custkey % 11 <> 0
    UNION ALL SELECT user_id, 'ambito', 'fiscalizacion' FROM concedido WHERE c_custkey % 3 IN (0, 1)
    UNION ALL SELECT user_id, 'ambito', 'mantencion' FROM concedido WHERE c_custkey % 3 IN (0, 2)
    UNION ALL SELECT user_id, 'clasificacion', nivel FROM concedido WHERE nivel IS NOT NULL"""
CTES["ejecucion_v"] = (
    f"SELECT {md5_of(('orden_nro',))} AS huella_registro, cumpl_prog, hh_reales, 1 AS version_seq FROM ordenes1 UNION ALL "
    f"SELECT {md5_of(('orden_nro',))}, n.cumpl_prog, n.hh_reales, CASE WHEN v.orden_nro IS NULL THEN 1 ELSE 2 END "
    "FROM ordenes n LEFT JOIN (SELECT orden_nro FROM ordenes1) v USING (orden_nro) "
    "WHERE v.orden_nro IS NULL OR n.cumpl_prog IS NOT NULL"
)
CTES["celda_texto"] = """
    SELECT punto_nro || '_' || anio || '_' || semana_nro AS chunk_id, 'Punto ' || punto_nro || ', semana ' || semana_nro
           || ' de ' || anio || ': ' || concentracion_mg_m3 || ' mg/m³ el ' || fecha_medicion || '.' AS texto FROM celda"""
CTES["celda_texto1"] = CTES["celda_texto"] + "1"
CTES["centros"] = "SELECT label AS query_id, count(*) AS n FROM embeddings GROUP BY 1"
CTES["centro_pos"] = """
    SELECT label AS query_id, i, CAST(sum(CAST(embedding[i] AS DECIMAL(20,10))) AS DOUBLE) / count(*) AS x
    FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2"""
CTES["centro"] = "SELECT query_id, list(x ORDER BY i) AS v FROM centro_pos GROUP BY 1"
CTES["puntaje"] = """
    SELECT query_id, vec_id, label, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS lugar
    FROM (SELECT c.query_id, e.vec_id, e.label, list_cosine_similarity(c.v, CAST(e.embedding AS DOUBLE[])) AS score
          FROM centro c, embeddings e) s"""


def _as_text(pieces, replaced) -> str:
    """A chunk template as an SQL expression."""
    import string

    def fill(text: str) -> str:
        parts = []
        for literal, name, _, _ in string.Formatter().parse(text):
            if literal:
                parts.append("'" + literal.replace("'", "''") + "'")
            if name:
                parts.append(f"coalesce(CAST({replaced.get(name, name)} AS VARCHAR), 'None')")
        return " || ".join(parts) or "''"

    if isinstance(pieces, str):
        return fill(pieces)
    out = []
    for p in pieces:
        if isinstance(p, str):
            out.append(fill(p))
        else:
            field, yes, no = p
            out.append(
                f"CASE WHEN coalesce(CAST({field} AS VARCHAR), '') NOT IN ('', 'false') THEN {fill(yes)} ELSE {fill(no)} END"
            )
    return " || ".join(out)


def _token(col: str) -> str:
    return f"CASE WHEN {col} IS NOT NULL THEN 'PII_' || sha256('sal' || {col}) END"


def chunks_sql(qid: str) -> str:
    q = QUESTIONS[qid]
    replaced = {c: f"({_token(c)})" for c in q.pii}
    key = " || '_' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in q.key)
    scope = "ambito" if q.scope.startswith("column:") else f"'{q.scope}'"
    pii = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in q.pii) or "0"
    return sql(
        f"SELECT {key} AS chunk_id, '{qid}' AS regla_id, '{q.mart}' AS medallon_id, planta_canon AS planta, "
        f"{scope} AS ambito, {pii} AS n_pii, -1 AS valido_hasta, {_as_text(q.template, replaced)} AS texto "
        f"FROM ({QUESTION_SQL[qid]}) a"
    )


REASON = """CASE WHEN cumpl_prog = 0 THEN CASE cubo WHEN 0 THEN 'Falta de repuestos' WHEN 1 THEN 'Falta de personal'
    WHEN 2 THEN 'Reprogramado por operaciones' ELSE 'Equipo en uso productivo' END END AS motivo_no_ejecucion,
    CASE WHEN cumpl_prog = 0 THEN CAST(CASE cubo WHEN 0 THEN 0.9 WHEN 1 THEN 0.7 WHEN 2 THEN 0.5 ELSE 0.6 END AS DOUBLE) END
    AS peso_motivo, CASE WHEN cumpl_prog = 0 THEN dia + 7 END AS fecha_reprogramacion"""

SHEET_ORDERS = f"""SELECT * EXCLUDE (dia, cubo, maquina_nro), strftime(dia, '%Y-%m-%dT00:00:00Z') AS inicio_programado,
    CASE WHEN cumpl_prog = 1 THEN dia END AS dia_ejecutado, {REASON} FROM hoja_ordenes"""

CELL_KEY = "punto_nro, anio, semana_nro, concentracion_mg_m3"

CHUNK_COUNT = " UNION ALL ".join(
    f"SELECT '{i}' AS regla_id, count(*) AS filas FROM ({QUESTION_SQL[i]}) a" for i in QUESTION_SQL
)


CTES["cobertura_visible"] = """SELECT * FROM cobertura_semanal WHERE planta_canon IN
    (SELECT value FROM permisos WHERE user_id = 'Customer#000000001' AND dimension = 'planta')"""


def governed_sql(name: str, plant: str = "planta_canon") -> str:
    return f"""SELECT * FROM ({REPORT_SQL[name]}) r WHERE {plant} IN
        (SELECT value FROM permisos WHERE user_id = 'Customer#000000001' AND dimension = 'planta')"""


OTHER_SQL = {
    "mart_causa_raiz_argmax": """SELECT * REPLACE (coalesce(peso_causa = max(peso_causa)
        OVER (PARTITION BY punto_nro, anio, semana_nro), FALSE) AS es_causa_principal) FROM causa_raiz""",
    "measurement_bridge": """SELECT planta_canon, nombre_planta, punto_nro, nombre_punto, m.maquina_gen_codigo,
        tipo_maquina_gen, componente_codigo_full, tipo_componente, estado_actual AS estado_componente, anio, semana_nro,
        fecha_inicio_semana, concentracion_mg_m3, estado
        FROM mediciones m LEFT JOIN calendario USING (anio, semana_nro)
        LEFT JOIN componentes k ON k.componente_codigo = m.componente_codigo_full
        LEFT JOIN componentes_estado s ON s.componente_codigo = m.componente_codigo_full""",
    "question_p13_by_calendar_weeks": _window(HIGH, "n_altos_ventana", "RANGE BETWEEN CURRENT ROW AND 3 FOLLOWING"),
    "dust_bands": f"""SELECT {CELL_KEY},
        CASE WHEN concentracion_mg_m3 < 0.25 THEN 1 WHEN concentracion_mg_m3 < 0.5 THEN 2 WHEN concentracion_mg_m3 < 2.5
             THEN 3 WHEN concentracion_mg_m3 < 5 THEN 4 ELSE 5 END AS nivel,
        CASE WHEN concentracion_mg_m3 < 0.25 THEN 'azul' WHEN concentracion_mg_m3 < 0.5 THEN 'verde'
             WHEN concentracion_mg_m3 < 2.5 THEN 'amarillo' WHEN concentracion_mg_m3 < 5 THEN 'rojo' ELSE 'negro' END AS color,
        {BAND} AS etiqueta, concentracion_mg_m3 >= 2.5 AS sobre_limite FROM celda""",
    "sheet_unpivot": "SELECT * FROM hoja_larga",
    "sheet_header_rows": """SELECT planta, bloque, 'column' || lpad(CAST(pos AS VARCHAR), 2, '0') AS _col_posicion, CAST(semanas AS INTEGER) AS semana_nro
        FROM encabezado""",
    "sheet_metadata": """SELECT planta, bloque, 'column' || lpad(CAST(pos AS VARCHAR), 2, '0') AS _col_posicion, fecha AS fecha_str, operador AS operador_alias,
        tecnico AS tecnico_alias, hora_inicio, hora_termino FROM encabezado""",
    "sheet_value_rows": f"""SELECT planta, bloque, 'column' || lpad(CAST(pos AS VARCHAR), 2, '0') AS _col_posicion, trim({SHEET_LABEL}) AS punto_evaluacion,
        concentracion_mg_m3 FROM celda_personas JOIN supplier ON s_suppkey = punto_nro""",
    "sheet_to_measurements": """SELECT c.planta, c.punto_nro, c.anio, c.semana_nro, c.concentracion_mg_m3,
        h.fecha AS fecha_medicion, trim(h.operador) AS operador_alias, trim(h.tecnico) AS tecnico_alias, h.hora_inicio,
        h.hora_termino FROM celda_personas c JOIN encabezado h USING (planta, bloque, pos)""",
    "sheets_union": """SELECT planta, CASE WHEN CAST(substr(_col_posicion, 7) AS INTEGER) <= 26 THEN 'antes' ELSE 'despues' END
        AS hoja, count(*) AS celdas FROM hoja_larga GROUP BY 1, 2""",
    "point_names_resolved": "SELECT l_suppkey AS punto_nro, count(*) AS lineas FROM lineitem GROUP BY 1",
    "dense_measurements": """SELECT r.punto_nro, r.anio, r.semana_nro, r.fecha_inicio_semana, c.concentracion_mg_m3,
        CASE WHEN c.punto_nro IS NULL THEN 'no_medido' ELSE 'medido' END AS estado,
        CASE WHEN c.punto_nro IS NULL THEN 'sin_registro' END AS motivo_no_medicion
        FROM rejilla r LEFT JOIN celda c USING (punto_nro, anio, semana_nro)""",
    "orders_normalized": SHEET_ORDERS,
    "orders_from_csv": SHEET_ORDERS,
    "machines_by_name": """SELECT orden_nro, CASE WHEN n = 1 THEN u END AS ubicacion_tecnica,
        CASE WHEN n = 1 THEN p END AS planta_canon, coalesce(n > 1, FALSE) AS nombre_ambiguo
        FROM ordenes_nombradas LEFT JOIN (SELECT nombre, count(*) AS n, min(ubicacion_tecnica) AS u, min(planta_canon) AS p
          FROM nombres_repetidos GROUP BY 1) k USING (nombre)""",
    "machines_by_name_and_plant": """SELECT orden_nro, planta_hoja AS planta_canon, CASE WHEN n = 1 THEN u END
        AS ubicacion_tecnica, coalesce(n > 1, FALSE) AS nombre_ambiguo
        FROM ordenes_nombradas LEFT JOIN (SELECT nombre, planta_canon AS planta_hoja, count(*) AS n,
          min(ubicacion_tecnica) AS u FROM nombres_repetidos GROUP BY 1, 2) k USING (nombre, planta_hoja)""",
    "equipment_codes": "SELECT ubicacion_tecnica, tipo_equipo, familia_equipo, planta_canon FROM equipos",
    # summer time of the zone in January: three hours behind UTC
    "local_times": """SELECT event_id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') AS utc FROM events""",
    "week_calendar": """SELECT c.*, n AS lecturas FROM calendario c JOIN (SELECT CAST(date_trunc('week', l_shipdate) AS DATE)
        AS fecha_inicio_semana, count(*) AS n FROM lineitem GROUP BY 1) l USING (fecha_inicio_semana)""",
    "mart_table": "SELECT * FROM tendencias",
    "overwritten_table": f"SELECT {CELL_KEY} FROM celda",
    "appended_table": f"""SELECT {CELL_KEY} FROM celda1 UNION ALL SELECT {CELL_KEY} FROM celda c WHERE NOT EXISTS
        (SELECT 1 FROM celda1 a WHERE a.punto_nro = c.punto_nro AND a.anio = c.anio AND a.semana_nro = c.semana_nro)""",
    "report_json": ANNUAL,
    "table_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, count(*) AS filas, {m} AS minimo, count(*) >= {m} AS cumple FROM {t}"
        for t, m in (
            ("region", 5), ("nation", 0), ("customer", 0), ("supplier", 0), ("part", 0), ("orders", 0), ("lineitem", 1000),
            ("events", 0), ("documents", 0), ("embeddings", 0), ("pages", 0), ("benchmark", 0), ("labels", 0),
            ("conversations", 0),
        )
    ),
    "vector_table": """SELECT vec_id, 64 AS dimension, 'cosine' AS distancia, round(CAST(embedding[1] AS DOUBLE), 6) AS primera,
        array_to_string(list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',') AS componentes
        FROM embeddings WHERE len(embedding) = 64""",
    "rejected_vectors": """SELECT CASE WHEN embedding IS NULL THEN 'nulo' ELSE 'dimension' END AS rechazo, count(*) AS filas
        FROM embeddings WHERE embedding IS NULL OR len(embedding) <> 32 GROUP BY 1""",
    "versions_current": "SELECT * FROM ejecucion_v QUALIFY row_number() OVER (PARTITION BY huella_registro ORDER BY version_seq DESC) = 1",
    "versions_as_of": f"SELECT {md5_of(('orden_nro',))} AS huella_registro, cumpl_prog, hh_reales, 1 AS version_seq FROM ordenes1",
    "versions_closed": f"""SELECT v.*, CASE WHEN s.huella_registro IS NOT NULL AND v.version_seq = 1
          THEN '2024-01-01 00:00:00' ELSE '2024-01-08 00:00:00' END AS valid_from,
        CASE WHEN s.huella_registro IS NOT NULL AND v.version_seq = 1 AND d.huella_registro IS NOT NULL
          THEN '2024-01-08 00:00:00' END AS valid_to
        FROM ejecucion_v v LEFT JOIN (SELECT {md5_of(('orden_nro',))} AS huella_registro FROM ordenes1) s USING (huella_registro)
        LEFT JOIN (SELECT huella_registro FROM ejecucion_v WHERE version_seq = 2) d USING (huella_registro)""",
    "snapshot_orders": """SELECT o.orden_nro, o.ot_texto_breve, NULL AS cumpl_prog, o.hh_reales, '2024-01-01 00:00:00'
          AS snap_valid_from, CASE WHEN n.cumpl_prog IS NOT NULL THEN '2024-01-08 00:00:00' END AS snap_valid_to
        FROM ordenes1 o JOIN ordenes n USING (orden_nro)
        UNION ALL SELECT n.orden_nro, n.ot_texto_breve, n.cumpl_prog, n.hh_reales, '2024-01-08 00:00:00', NULL
        FROM ordenes n LEFT JOIN (SELECT orden_nro AS k FROM ordenes1) o ON o.k = n.orden_nro
        WHERE o.k IS NULL OR n.cumpl_prog IS NOT NULL""",
    "snapshot_orders_key_only": """SELECT n.orden_nro, n.ot_texto_breve, CASE WHEN o.k IS NULL THEN n.cumpl_prog END AS cumpl_prog,
        n.hh_reales, CASE WHEN o.k IS NULL THEN '2024-01-08 00:00:00' ELSE '2024-01-01 00:00:00' END AS snap_valid_from,
        CAST(NULL AS VARCHAR) AS snap_valid_to
        FROM ordenes n LEFT JOIN (SELECT orden_nro AS k FROM ordenes1) o ON o.k = n.orden_nro""",
    "snapshot_orders_current": "SELECT orden_nro, ot_texto_breve, cumpl_prog, hh_reales FROM ordenes",
    "component_hierarchy": """SELECT c.componente_codigo, c.componente_padre_codigo, p.componente_padre_codigo AS abuelo_codigo
        FROM componentes c LEFT JOIN componentes p ON p.componente_codigo = c.componente_padre_codigo""",
    "people_roles": "SELECT * FROM mediciones_personas",
    "grants_expanded": "SELECT * FROM permisos",
    "report_by_user": f"""SELECT p.user_id, count(*) AS filas, CAST(sum(total_registros) AS BIGINT) AS registros
        FROM ({ANNUAL}) a JOIN permisos p ON p.dimension = 'planta' AND p.value = a.planta
        JOIN permisos s ON s.user_id = p.user_id AND s.dimension = 'ambito' AND s.value = 'fiscalizacion' GROUP BY 1""",
    "points_by_level": """SELECT user_id, count(*) AS puntos FROM concedido JOIN supplier ON
        CASE WHEN s_acctbal < 0 THEN 4 WHEN s_acctbal < 3000 THEN 3 WHEN s_acctbal < 6000 THEN 2 ELSE 1 END <= c_custkey % 5 + 1
        WHERE nivel IS NOT NULL GROUP BY 1""",
    "report_for_user_concentracion_anual": governed_sql("concentracion_anual", "planta"),
    "report_for_user_ot_no_ejecutadas": governed_sql("ot_no_ejecutadas"),
    "report_for_user_tendencias_planta": governed_sql("tendencias_planta"),
    "chunk_hashes": "SELECT CAST(doc_id AS VARCHAR) AS chunk_id, substr(sha256(text), 1, 16) AS hash_contenido, lang AS idioma FROM documents",
    "chunks_valid": """SELECT CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN doc_id % 5 = 0 THEN n_chars ELSE -1 END
        AS valido_hasta, substr(sha256(text), 1, 16) AS hash_contenido FROM documents WHERE doc_id % 5 <> 0 OR n_chars > 2000""",
    "chunks_forgotten": """SELECT CAST(doc_id AS VARCHAR) AS chunk_id, substr(sha256(text), 1, 16) AS hash_contenido
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "chunks_labelled": "SELECT source AS fuente, count(*) AS chunks FROM documents WHERE lang = 'es' GROUP BY 1",
    "chunks_upserted": """SELECT chunk_id, substr(sha256(texto), 1, 16) AS hash_contenido, texto, 1 AS carga FROM celda_texto1
        UNION ALL SELECT chunk_id, substr(sha256(texto), 1, 16), texto, 2 FROM celda_texto c
        WHERE NOT EXISTS (SELECT 1 FROM celda_texto1 a WHERE a.chunk_id = c.chunk_id AND a.texto = c.texto)""",
    "chunk_counts": f"""SELECT regla_id, filas, 1 AS minimo, 50 AS maximo, filas BETWEEN 1 AND 50 AS cumple
        FROM ({CHUNK_COUNT}) c""",
    "pii_tokens": f"""SELECT campo, {_token('valor')} AS token, valor FROM (SELECT 'dni' AS campo, dni AS valor FROM personas
        UNION SELECT 'nombre_completo', nombre_completo FROM personas) x""",
    "people_tokenized": f"""SELECT {_token('a')} AS alias_fuente, {_token('n')} AS nombre_completo, t AS tipo_persona, 2 AS n_pii
        FROM (SELECT c_name AS a, nombre_completo AS n, tipo_persona AS t FROM customer JOIN personas
                ON dni = CAST(c_custkey AS VARCHAR)
              UNION ALL SELECT 'p-' || dni, nombre_completo, tipo_persona FROM personas) x""",
    "texts_protected": "SELECT doc_id, text AS texto, 28 AS sobrecarga FROM documents",
    "nearest_vectors": "SELECT query_id, vec_id, round(score, 6) AS score, lugar FROM puntaje WHERE lugar <= 10",
    "nearest_vectors_scored": "SELECT query_id, count(*) AS cercanos FROM puntaje WHERE lugar <= 10 AND score >= 0.3 GROUP BY 1",
    "nearest_vectors_recall": """SELECT query_id, n AS relevantes, h AS encontrados, round(CAST(h AS DOUBLE) / n, 6) AS recall
        FROM (SELECT label AS query_id, count(*) AS n FROM embeddings GROUP BY 1) a
        JOIN (SELECT query_id, count(CASE WHEN label = query_id AND lugar <= 50 THEN 1 END) AS h FROM puntaje GROUP BY 1) b
        USING (query_id)""",
    "weekly_stream": """SELECT CAST(date_trunc('week', ts) AS DATE) AS fecha_inicio_semana, event_type, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS suma, min(value) AS minimo, max(value) AS maximo
        FROM events GROUP BY 1, 2""",
    "landing_stream": f"""SELECT {md5_of(('punto_nro', 'condicion_codigo', 'anio', 'semana_nro'))} AS huella_registro, *,
        1 AS version_seq FROM condiciones_observadas""",
}


# fmt: off
# Columns whose type differs between engines, and the common form they are compared in:
# D a date as ISO text, N a decimal as a double, by query.
OUTPUT_FORMS = {
    "mart_ranking_semanal": {"fecha_inicio_semana": "D", "fecha_fin_semana": "D", "fecha_medicion": "D"},
    "mart_promedios_planta": {"promedio_mg_m3": "N", "maximo_mg_m3": "N", "minimo_mg_m3": "N"},
    "mart_detalle_medicion": {"fecha_inicio_semana": "D", "fecha_fin_semana": "D", "fecha_medicion": "D"},
    "mart_cobertura_semanal": {"fecha_inicio_semana": "D", "fecha_fin_semana": "D", "fecha_medicion": "D"},
    "mart_ventanas_temporales": {"fecha_inicio_semana": "D", "fecha_fin_semana": "D"},
    "mart_causa_raiz": {"fecha_reprogramacion": "D"},
    "mart_no_ejecucion_ot": {"inicio_programado": "D", "duracion_planificada": "N", "fecha_reprogramacion": "D"},
    "mart_ejecucion_ot": {"inicio_programado": "D", "duracion_planificada": "N", "dia_ejecutado": "D"},
    "mart_ot_en_curso": {"inicio_programado": "D", "duracion_planificada": "N"},
    "question_p01_highest_point": {"fecha_medicion": "D"},
    "question_p02_lowest_point": {"fecha_medicion": "D"},
    "question_p03_plant_average": {"promedio_mg_m3": "N", "maximo_mg_m3": "N", "minimo_mg_m3": "N"},
    "question_p04_all_plants_average": {"promedio_mg_m3": "N", "maximo_mg_m3": "N", "minimo_mg_m3": "N"},
    "question_p05_highest_plant": {"promedio_mg_m3": "N", "pico_mg_m3": "N"},
    "question_p06_lowest_plant": {"promedio_mg_m3": "N", "minimo_mg_m3": "N"},
    "question_p08_why_not_maintained": {"fecha_reprogramacion": "D"},
    "question_p09_when_measured": {"fecha_medicion": "D"},
    "question_p10_who_measured": {"fecha_medicion": "D"},
    "question_p11_why_not_measured": {"fecha_inicio_semana": "D"},
    "question_p12_machines_measured": {"fecha_medicion": "D"},
    "question_p17_rising_plant": {"promedio_punto": "N"},
    "question_p18_last_maintenance": {"inicio_programado": "D"},
    "question_p21_last_maintenance_date": {"fecha_planificada": "D"},
    "question_p22_planned_versus_real": {"duracion_planificada": "N"},
    "question_p23_rescheduled": {"fecha_original": "D", "fecha_reprogramacion": "D"},
    "question_p24_not_maintained_on_time": {"fecha_programada": "D", "fecha_reprogramacion": "D"},
    "question_p25_orders_in_progress": {"inicio_programado": "D"},
    "question_p26_work_of_orders": {"inicio_programado": "D"},
    "question_b3_plant_peak": {"fecha_medicion": "D"},
    "report_concentracion_anual": {"concentracion_promedio_mg_m3": "N", "concentracion_max_mg_m3": "N", "concentracion_min_mg_m3": "N"},
    "report_ot_no_ejecutadas": {"inicio_programado": "D", "fecha_reprogramacion": "D"},
    "report_tendencias_planta": {"promedio_planta_mg_m3": "N"},
    "satellite_detalle_componente_estado": {"fecha_inspeccion": "D"},
    "satellite_detalle_medicion": {"fecha_medicion": "D"},
    "satellite_detalle_ot_ejecucion": {"dia_ejecutado": "D"},
    "satellite_detalle_ot_no_ejecucion": {"fecha_reprogramacion": "D"},
    "satellite_detalle_ot_programacion": {"inicio_programado": "D", "duracion_planificada": "N"},
    "satellite_detalle_semana": {"fecha_inicio_semana": "D", "fecha_fin_semana": "D"},
    "mart_causa_raiz_argmax": {"fecha_reprogramacion": "D"},
    "measurement_bridge": {"fecha_inicio_semana": "D"},
    "dense_measurements": {"fecha_inicio_semana": "D"},
    "orders_normalized": {"dia_ejecutado": "D", "fecha_reprogramacion": "D"},
    "orders_from_csv": {"dia_ejecutado": "D", "fecha_reprogramacion": "D"},
    "week_calendar": {"fecha_inicio_semana": "D", "fecha_fin_semana": "D"},
    "report_json": {"concentracion_promedio_mg_m3": "N", "concentracion_max_mg_m3": "N", "concentracion_min_mg_m3": "N"},
    "report_for_user_concentracion_anual": {"concentracion_promedio_mg_m3": "N", "concentracion_max_mg_m3": "N", "concentracion_min_mg_m3": "N"},
    "report_for_user_ot_no_ejecutadas": {"inicio_programado": "D", "fecha_reprogramacion": "D"},
    "report_for_user_tendencias_planta": {"promedio_planta_mg_m3": "N"},
    "weekly_stream": {"fecha_inicio_semana": "D"},
}
# fmt: on


def oracle_sql() -> dict[str, str]:
    """SQL per registered query, in the output form of `registry.plain`."""
    out = {}
    for name, body in bodies().items():
        forms = OUTPUT_FORMS.get(name, {})
        if forms:
            casts = ", ".join(f"CAST({c} AS {'VARCHAR' if f == 'D' else 'DOUBLE'}) AS {c}" for c, f in forms.items())
            body = f"SELECT * REPLACE ({casts}) FROM (\n{body}\n) salida"
        out[name] = body
    from airgauge import oracles_history

    out["satellite_bucketed"] = out["satellite_detalle_medicion"]
    out["not_measured_from_store"] = next(s for n, s in out.items() if n.startswith("question_p11_"))
    return out | oracles_history.bodies()


def bodies() -> dict[str, str]:
    """SQL per registered query, before the output types are unified."""
    from airgauge.plans.marts import MARTS
    from airgauge.registry import slug

    out = {f"mart_{m}": sql(f"SELECT * FROM {m}") for m in MARTS}
    for qid in QUESTIONS:
        out[f"question_{slug(qid)}"] = sql(QUESTION_SQL[qid])
        out[f"chunks_{slug(qid)}"] = chunks_sql(qid)
    names = {"B1": "over_limit_last_session", "B3": "plant_peak", "B4": "last_session"}
    out.update({f"question_{b.lower()}_{names[b]}": sql(EARLIER_SQL[b]) for b in names})
    out.update({f"report_{n}": sql(s) for n, s in REPORT_SQL.items()})
    out.update({f"kpi_{n}": sql(s) for n, s in KPI_SQL.items()})
    visible = {n: s.replace("cobertura_semanal", "cobertura_visible") for n, s in KPI_SQL.items()}
    out.update({f"kpi_{n}_for_user": sql(s) for n, s in visible.items()})
    out.update({f"hub_{n}": s for n, s in HUB_SQL.items()})
    out.update({f"link_{n}": s for n, s in LINK_SQL.items()})
    out.update({f"satellite_{n}": s for n, s in SATELLITE_SQL.items()})
    out.update({n: sql(s) for n, s in OTHER_SQL.items()})
    out["chunks_json"] = out[f"chunks_{slug('P14')}"]
    return out
