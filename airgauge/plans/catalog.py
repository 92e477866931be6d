"""The history model: every hub, link and satellite as a declaration."""

from __future__ import annotations

from airgauge.operators.history import Hub, Link, Satellite

PERSON = ("dni", "tipo_dni", "dni_pais_emisor")
WEEK = ("anio", "semana_nro")
POINT_WEEK = ("punto_nro", *WEEK)

# Buckets of tables that grow with readings and orders; those with a week in their key have one per week.
GROWING = 16

# Names, keys and attributes of the stored tables.
HUBS = (
    Hub("entidad_componente_estructural", ("componente_codigo",), ("componentes",)),
    Hub("entidad_condicion_tipo", ("condicion_codigo",), ("condiciones_tipo",)),
    Hub("entidad_maquina_control_polvo", ("ubicacion_tecnica",), ("equipos",)),
    Hub("entidad_maquina_generadora", ("maquina_gen_codigo",), ("mediciones",)),
    Hub("entidad_orden_trabajo", ("orden_nro",), ("ordenes",), GROWING),
    Hub("entidad_persona", PERSON, ("personas",)),
    Hub("entidad_planta", ("planta_canon",), ("mediciones", "equipos")),
    Hub("entidad_problema_raiz", ("problema_raiz_codigo",), ("problemas",)),
    Hub("entidad_punto_medicion", ("punto_nro",), ("mediciones",)),
    Hub("entidad_semana", WEEK, ("mediciones", "ordenes")),
    Hub("entidad_tipo_equipo_ctrl", ("tipo_equipo_codigo",), ("tipos_equipo",)),
)

LINKS = (
    Link(
        "relacion_componente_maqgen",
        ("componente_codigo", "maquina_gen_codigo"),
        {"ent_componente_estructural_hk": ("componente_codigo",), "ent_maquina_generadora_hk": ("maquina_gen_codigo",)},
        "componentes",
        ("maquina_gen_codigo",),
    ),
    Link(
        "relacion_componente_padre",
        ("componente_codigo", "componente_padre_codigo"),
        {
            "ent_componente_estructural_hijo_hk": ("componente_codigo",),
            "ent_componente_estructural_padre_hk": ("componente_padre_codigo",),
        },
        "componentes",
        ("componente_padre_codigo",),
    ),
    Link(
        "relacion_condicion_observada",
        ("punto_nro", "condicion_codigo", *WEEK),
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_condicion_tipo_hk": ("condicion_codigo",), "ent_semana_hk": WEEK},
        "condiciones_observadas",
        buckets=GROWING,
    ),
    Link(
        "relacion_condicion_problema",
        ("condicion_codigo", "problema_raiz_codigo"),
        {"ent_condicion_tipo_hk": ("condicion_codigo",), "ent_problema_raiz_hk": ("problema_raiz_codigo",)},
        "condiciones_problema",
    ),
    Link(
        "relacion_medicion",
        POINT_WEEK,
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_semana_hk": WEEK},
        "mediciones",
        buckets=GROWING,
    ),
    Link(
        "relacion_medicion_persona",
        (*POINT_WEEK, *PERSON, "rol"),
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_semana_hk": WEEK, "ent_persona_hk": PERSON},
        "mediciones_personas",
        buckets=GROWING,
    ),
    Link(
        # a machine's own plant; the plant of its orders comes from here and not
        # from the plants its type occurs in
        "relacion_maqctrl_planta",
        ("ubicacion_tecnica", "planta_canon"),
        {"ent_maquina_control_polvo_hk": ("ubicacion_tecnica",), "ent_planta_hk": ("planta_canon",)},
        "equipos",
        ("planta_canon",),
    ),
    Link(
        # carries the week, which the marts over orders need
        "relacion_ot_maqctrl",
        ("orden_nro", "ubicacion_tecnica", *WEEK),
        {
            "ent_orden_trabajo_hk": ("orden_nro",),
            "ent_maquina_control_polvo_hk": ("ubicacion_tecnica",),
            "ent_semana_hk": WEEK,
        },
        "ordenes",
        ("ubicacion_tecnica",),
        buckets=GROWING,
    ),
    Link(
        "relacion_ot_responsable",
        ("orden_nro", *PERSON),
        {"ent_orden_trabajo_hk": ("orden_nro",), "ent_persona_hk": PERSON},
        "ordenes_personas",
        buckets=GROWING,
    ),
    Link(
        "relacion_planta_tipo_equipo",
        ("planta_canon", "tipo_equipo_codigo"),
        {"ent_planta_hk": ("planta_canon",), "ent_tipo_equipo_ctrl_hk": ("tipo_equipo_codigo",)},
        "plantas_tipos",
        ("tipo_equipo_codigo",),
    ),
    Link(
        "relacion_punto_componente",
        ("punto_nro", "componente_codigo_full"),
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_componente_estructural_hk": ("componente_codigo_full",)},
        "mediciones",
        ("componente_codigo_full",),
    ),
    Link(
        "relacion_punto_maqctrl",
        ("punto_nro", "ubicacion_tecnica"),
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_maquina_control_polvo_hk": ("ubicacion_tecnica",)},
        "cobertura",
    ),
    Link(
        "relacion_punto_maqgen",
        ("punto_nro", "maquina_gen_codigo"),
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_maquina_generadora_hk": ("maquina_gen_codigo",)},
        "mediciones",
        ("maquina_gen_codigo",),
    ),
    Link(
        "relacion_punto_planta",
        ("punto_nro", "planta_canon"),
        {"ent_punto_medicion_hk": ("punto_nro",), "ent_planta_hk": ("planta_canon",)},
        "mediciones",
        ("planta_canon",),
    ),
)

SATELLITES = (
    Satellite(
        "detalle_componente",
        ("componente_codigo",),
        ("componente_nombre", "tipo_componente", "nivel_jerarquia", "familia_causa"),
        "componentes",
    ),
    Satellite(
        "detalle_componente_estado",
        ("componente_codigo",),
        ("estado_actual", "severidad", "fecha_inspeccion"),
        "componentes_estado",
    ),
    Satellite(
        "detalle_condicion_estado",
        ("punto_nro", "condicion_codigo", *WEEK),
        ("severidad",),
        "condiciones_observadas",
        buckets=GROWING,
    ),
    Satellite("detalle_condicion_tipo", ("condicion_codigo",), ("condicion_nombre", "peso_causa_default"), "condiciones_tipo"),
    Satellite(
        "detalle_maquina_control_polvo",
        ("ubicacion_tecnica",),
        ("equipo_denom", "tipo_equipo", "familia_equipo", "sector"),
        "equipos",
    ),
    Satellite(
        "detalle_maquina_generadora",
        ("maquina_gen_codigo",),
        ("maquina_gen_nombre", "tipo_maquina_gen", "descripcion"),
        "mediciones",
        "maquina_gen_codigo is not null",
    ),
    Satellite(
        "detalle_medicion",
        POINT_WEEK,
        ("concentracion_mg_m3", "fecha_medicion", "hora_inicio", "hora_termino", "estado", "motivo_no_medicion"),
        "mediciones",
        buckets=GROWING,
    ),
    Satellite(
        "detalle_ot_descr",
        ("orden_nro",),
        ("ot_texto_breve", "denom_ubic_tecnica", "clase_orden", "clase_actividad_pm"),
        "ordenes",
        buckets=GROWING,
    ),
    Satellite(
        "detalle_ot_ejecucion",
        ("orden_nro",),
        ("cumpl_prog", "hh_reales", "personal_real", "duracion_real", "adherencia_prog", "dia_ejecutado"),
        "ordenes",
        buckets=GROWING,
    ),
    Satellite(
        "detalle_ot_no_ejecucion",
        ("orden_nro",),
        ("motivo_no_ejecucion", "peso_motivo", "fecha_reprogramacion"),
        "ordenes",
        "cumpl_prog = 0",
        buckets=GROWING,
    ),
    Satellite(
        "detalle_ot_programacion",
        ("orden_nro",),
        (
            "inicio_programado",
            "fecha_inicio_extrema",
            "fecha_liberacion",
            "hh_planificadas",
            "duracion_planificada",
            "personal_prog",
            "status_sistema",
        ),
        "ordenes",
        buckets=GROWING,
    ),
    Satellite("detalle_persona", PERSON, ("nombre_completo", "tipo_persona"), "personas"),
    Satellite("detalle_planta", ("planta_canon",), ("nombre_planta", "area", "sector"), "plantas"),
    Satellite("detalle_problema_raiz", ("problema_raiz_codigo",), ("problema_raiz_nombre", "familia_causa"), "problemas"),
    Satellite(
        "detalle_punto_medicion",
        ("punto_nro",),
        ("nombre_punto", "descripcion_punto", "tipo_punto"),
        "mediciones",
    ),
    Satellite(
        "detalle_semana",
        WEEK,
        ("fecha_inicio_semana", "fecha_fin_semana", "trimestre", "mes"),
        "semanas",
    ),
    # A link keeps every pair that ever was. These hold, per driving key, the pair that holds now; a pair
    # that comes back is a version again.
    Satellite("vigencia_maqctrl_planta", ("ubicacion_tecnica",), ("planta_canon",), "equipos", "planta_canon is not null"),
    Satellite("vigencia_ot_maqctrl", ("orden_nro",), ("ubicacion_tecnica", *WEEK), "ordenes", "ubicacion_tecnica is not null", buckets=GROWING),
    Satellite("vigencia_ot_responsable", ("orden_nro",), PERSON, "ordenes_personas", buckets=GROWING),
    Satellite(
        "vigencia_punto_componente", ("punto_nro",), ("componente_codigo_full",), "mediciones", "componente_codigo_full is not null"
    ),
    Satellite("vigencia_punto_maqgen", ("punto_nro",), ("maquina_gen_codigo",), "mediciones", "maquina_gen_codigo is not null"),
    Satellite("vigencia_punto_planta", ("punto_nro",), ("planta_canon",), "mediciones", "planta_canon is not null"),
)

# Keys that hold several rows at once: an order's operations.
ROW_SETS = (
    Satellite(
        "detalle_ot_operaciones",
        ("orden_nro",),
        ("ot_texto_breve", "ubicacion_tecnica", "hh_planificadas", "hh_reales", "personal_prog", "personal_real", "cumpl_prog", "inicio_programado"),
        "ordenes",
        several=True,
    ),
)

HUB = {h.name: h for h in HUBS}
LINK = {l.name: l for l in LINKS}
SATELLITE = {s.name: s for s in SATELLITES}
