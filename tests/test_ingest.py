import csv
from datetime import date

from pyspark.sql import functions as F

from airgauge.operators.orders import ORDER_COLUMNS, OrderSheet
from airgauge.plans import ingest as ing
from airgauge.plans import questions as q
from airgauge.plans.frames import Lazy
from airgauge.plans.marts import MARTS, build_marts, stored_marts
from airgauge.operators import history as h
from airgauge.operators import multi_active as ma
from airgauge.plans import vault
from airgauge.plans.catalog import SATELLITE
from airgauge.plans.vault import frames_from_history
from airgauge.sources.landing import REFERENCE_SCHEMAS, read_if_present

DAYS = {f"2026-05-{d} 00:00:00": date(2026, 5, d) for d in range(18, 25)}
SHEET = OrderSheet(DAYS, 2026, 19)

# invented rows
REFERENCES = {
    "puntos_catalogo": [
        ["Punto Uno (1)", 1, "Nodo 3500", "G1", "C1", "Punto Uno", "d", "real", "Correa 1", "correa", "x"],
        ["Punto Dos (2)", 2, "Nodo 3500", "G2", "C2", "Punto Dos", "d", "real", "Correa 2", "correa", "x"],
    ],
    "equipos_ventilacion_catalogo": [["X-SCP-HDP01-MEC", "Humectador 1", "HDP", "abatidor_polvo", "S", "Nodo 3500", "", ""]],
    "personas_alias": [["Ana", "1", "RUN", "Chile", "Ana Uno", "tecnico"], ["Taller", "9", "RUN", "Chile", "Taller SA", "empresa"]],
    "plantas_descripcion": [["Nodo 3500", "Planta Nodo", "Nodo", "Nodo"]],
    "componentes_estructurales": [["G1_C1", "chute", "CHUTE", 0, "A_componente_correa", "G1", ""]],
    "componentes_estado_semanal": [["G1_C1", "defectuoso", "grave", "2026-05-07", 2026, 19]],
    "condiciones_tipo": [["ROTO", "Chute roto", "grave", 0.9]],
    "condiciones_problema": [["ROTO", "A_CHUTE"]],
    "condiciones_observadas": [[1, "ROTO", 2026, 19, "grave"]],
    "problemas_raiz": [["A_CHUTE", "Chute dañado", "A_componente_correa", "d"]],
    "punto_maqctrl_cobertura": [[1, "X-SCP-HDP01-MEC"]],
    "tipos_equipo_ctrl": [["HDP", "Humectador", "abatidor_polvo"]],
}


def write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])


def landing(folder, last="3.5", done="0", two="", more=()):
    write(folder / "Nodo.csv", ["etiqueta", "column70", "column71"], [
        ["Semanas", "18", "19"], ["Fecha", "2026-04-30", "2026-05-07"], ["Operador", "ana", ""],
        ["punto  uno (1)", "1.0", last], ["Punto Dos (2)", "0.1", two], ["Desconocido", "2", "2"], ["Tph", "1500", "1600"],
    ])
    names = [*ORDER_COLUMNS.values(), *DAYS]
    row = dict.fromkeys(names, "")
    row |= {"Orden": "ot1", "Denominación": "humectador  1", "Txt.brv.": "Mantención", "Responsable": "Taller",
            "CumplProg": done, "HorasHombreProg.": "4", "HorasHombreReal": "5", "2026-05-20 00:00:00": "4"}
    write(folder / "Programa.csv", names, [list(row.values()), *[list((row | x).values()) for x in more]])


def test_files_to_answers_and_a_second_week(spark, tmp_path):
    refs, root = tmp_path / "refs", str(tmp_path / "root")
    for name, rows in REFERENCES.items():
        write(refs / f"{name}.csv", [x.split()[0] for x in REFERENCE_SCHEMAS[name].split(", ")], rows)

    def load(day, **kw):
        folder = tmp_path / f"landing{day}"
        landing(folder, **kw)
        now = F.lit(f"2026-05-{day}").cast("timestamp")
        found = ing.ingest(spark, str(folder), str(refs), root, SHEET, now, dense=False)
        assert {k for k, v in found.items() if v} == {"puntos_nodo", "programa_general"}
        f = frames_from_history(spark, root)
        return Lazy({n: lambda b=b: b(f) for n, b in MARTS.items()})

    m = load(11)
    top = q.QUESTIONS["P1"].run(m).first()
    assert (top.punto_nro, top.concentracion_mg_m3, top.semana_nro, top.planta_canon) == (1, 3.5, 19, "Nodo 3500")
    assert m["ranking_semanal"].count() == 3  # the unknown label and the tonnage row are not points
    causes = {r.tipo_causa: r for r in q.QUESTIONS["P7"].run(m, punto=1).collect()}
    assert causes["condicion"].es_causa_principal and causes["mantencion"].ot_relacionada == "OT1"
    assert q.QUESTIONS["P10"].run(m, punto=1).first().operador_panel == "Ana Uno"
    assert q.QUESTIONS["P24"].run(m).first().fecha_programada == date(2026, 5, 6)
    assert q.QUESTIONS["P19"].run(m).count() == 0

    m = load(18, last="4.5", done="1.0")
    assert q.QUESTIONS["P1"].run(m).first().concentracion_mg_m3 == 4.5
    assert m["ranking_semanal"].count() == 3
    assert q.QUESTIONS["P24"].run(m).count() == 0
    assert q.QUESTIONS["P19"].run(m).first().responsable_nombre == "Taller SA"
    versions = spark.read.parquet(f"{root}/detalle_medicion")
    assert versions.count() == 4 and versions.agg(F.max("version_seq")).first()[0] == 2

    build_marts(frames_from_history(spark, root), f"{root}/marts")
    stored = stored_marts(spark, f"{root}/marts")
    for name in MARTS:
        assert stored[name].select(*m[name].columns).exceptAll(m[name]).count() == 0 and stored[name].count() == m[name].count()
    assert q.QUESTIONS["P1"].run(stored).first().concentracion_mg_m3 == 4.5
    why = q.QUESTIONS["P7"].run(stored, punto=1)
    plan = why._jdf.queryExecution().executedPlan().toString()
    assert why.count() == q.QUESTIONS["P7"].run(m, punto=1).count() and "detalle_medicion" not in plan


def test_not_measured_cells_and_several_operations(spark, tmp_path):
    """A load marks what was not measured until its reading comes; an order keeps all its operations."""
    refs, root = tmp_path / "refs", str(tmp_path / "root")
    for name, rows in REFERENCES.items():
        write(refs / f"{name}.csv", [x.split()[0] for x in REFERENCE_SCHEMAS[name].split(", ")], rows)
    second = {"Txt.brv.": "Limpieza", "HorasHombreProg.": "2"}

    def load(day, **kw):
        landing(tmp_path / f"landing{day}", **kw)
        ing.ingest(spark, str(tmp_path / f"landing{day}"), str(refs), root, SHEET, F.lit(f"2026-05-{day}").cast("timestamp"))
        cells = h.current_version(spark.read.parquet(f"{root}/detalle_medicion")).groupBy("estado").count().collect()
        sets = spark.read.parquet(f"{root}/detalle_ot_operaciones")
        now = sorted((r.ot_texto_breve, r.hh_planificadas, r.copias) for r in ma.current_set(sets).collect())
        return {r.estado: r["count"] for r in cells}, now, sets.agg(F.max("version_seq")).first()[0]

    two = [("Limpieza", 2.0, 1), ("Mantención", 4.0, 1)]
    assert load(11, more=[second]) == ({"medido": 3, "no_medido": 1}, two, 1)
    frames = frames_from_history(spark, root)
    build_marts(frames, f"{root}/marts", ["detalle_medicion"])
    [why] = q.QUESTIONS["P11"].run(stored_marts(spark, f"{root}/marts")).collect()
    assert (why.punto_nro, why.anio, why.semana_nro, why.motivo_no_medicion) == (2, 2026, 19, "sin_registro")
    assert load(25, two="0.7", more=[second, second]) == ({"medido": 4}, [("Limpieza", 2.0, 2), ("Mantención", 4.0, 1)], 2)
    build_marts(frames_from_history(spark, root), f"{root}/marts", ["detalle_medicion"])
    assert q.QUESTIONS["P11"].run(stored_marts(spark, f"{root}/marts")).count() == 0
    # an edition that a lost job left half way does not count
    spark.range(1).write.parquet(f"{root}/marts/edicion=2/detalle_medicion")
    assert stored_marts(spark, f"{root}/marts")["detalle_medicion"].count() == 4


def test_a_blanked_reading_is_taken_back(spark, tmp_path):
    """A corrected sheet leaves a cell blank: its reading ends, once, and a later reading ends that."""
    refs, root = tmp_path / "refs", str(tmp_path / "root")
    for name, rows in REFERENCES.items():
        write(refs / f"{name}.csv", [x.split()[0] for x in REFERENCE_SCHEMAS[name].split(", ")], rows)

    def load(day, dense, **kw):
        landing(tmp_path / f"landing{day}", **kw)
        ing.ingest(spark, str(tmp_path / f"landing{day}"), str(refs), root, SHEET, F.lit(f"2026-05-{day}").cast("timestamp"), dense=dense)
        f = frames_from_history(spark, root)
        cells = {(r.punto_nro, r.semana_nro): (r.estado, r.concentracion_mg_m3) for r in f["medicion"].collect()}
        return cells, spark.read.parquet(f"{root}/detalle_medicion").count()

    full = {(1, 18): ("medido", 1.0), (1, 19): ("medido", 3.5), (2, 18): ("medido", 0.1), (2, 19): ("medido", 0.7)}
    gone = full | {(2, 19): ("no_medido", None)}
    assert load(11, True, two="0.7") == (full, 4)
    assert load(18, True, two="") == (gone, 5)
    assert load(19, False, two="") == (gone, 5)  # the same sheet again, dense or not
    assert load(25, True, two="s/m") == (gone, 5)  # no number is no reading
    assert load(26, False, two="0.7") == (full, 6)
    # nothing of week 19 is left but one point's reading
    assert load(27, False, two="", last="") == (gone | {(1, 19): ("no_medido", None)}, 8)


def test_labels_outside_the_catalogue_are_kept_as_rejects(spark, tmp_path):
    refs, root = tmp_path / "refs", str(tmp_path / "root")
    for name, rows in REFERENCES.items():
        write(refs / f"{name}.csv", [x.split()[0] for x in REFERENCE_SCHEMAS[name].split(", ")], rows)

    def load(day):
        landing(tmp_path / f"landing{day}")
        ing.ingest(spark, str(tmp_path / f"landing{day}"), str(refs), root, SHEET, F.lit(f"2026-05-{day}").cast("timestamp"), dense=False)
        rows = spark.read.parquet(f"{root}/rechazos/mediciones").collect()
        counts = spark.read.parquet(f"{root}/rechazos/mediciones_por_etiqueta").collect()
        return sorted((r.planta, r.punto_evaluacion, r.semana_nro, r.concentracion_mg_m3) for r in rows), [tuple(r) for r in counts]

    want = [("Nodo 3500", "Desconocido", 18, 2.0), ("Nodo 3500", "Desconocido", 19, 2.0)]
    assert load(11) == (want, [("Nodo 3500", "Desconocido", 2)])
    assert load(18) == (want, [("Nodo 3500", "Desconocido", 2)])  # the same sheets again: the same state
    known = REFERENCES["puntos_catalogo"]
    unknown = ["Desconocido", 3, "Nodo 3500", "G2", "C2", "Punto Tres", "d", "real", "Correa 2", "correa", "x"]
    write(refs / "puntos_catalogo.csv", [x.split()[0] for x in REFERENCE_SCHEMAS["puntos_catalogo"].split(", ")], [*known, unknown])
    assert load(25) == ([], [])


def test_frames_after_moves(spark, tmp_path):
    """A point, a machine, an order and a person in charge move, and one comes back: one row per key, always the last."""
    root = str(tmp_path / "root")
    point = "punto_nro int, planta_canon string, maquina_gen_codigo string, componente_codigo_full string"
    point += ", nombre_punto string, descripcion_punto string, tipo_punto string"

    def load(day, plant, machine_plant, machine, week, person):
        loads = {
            "mediciones": ([(1, plant, "G1", "G1_C1", "p", "d", "real")], point),
            "equipos": ([("M1", machine_plant), ("M2", "B")], "ubicacion_tecnica string, planta_canon string"),
            "ordenes": ([("O1", machine, 2026, week)], "orden_nro string, ubicacion_tecnica string, anio int, semana_nro int"),
            "ordenes_personas": ([("O1", *person)], "orden_nro string, dni string, tipo_dni string, dni_pais_emisor string"),
        }
        sources = {n: spark.createDataFrame(rows, schema) for n, (rows, schema) in loads.items()}
        now = F.lit(f"2026-06-{day:02d}").cast("timestamp")
        for name in SATELLITE:
            if name.startswith("vigencia_"):
                stored = read_if_present(spark, f"{root}/{name}")
                vault.satellite_rows(name, sources, stored, now).write.mode("append").parquet(f"{root}/{name}")
        return {n: h.current_version(spark.read.parquet(f"{root}/{n}")) for n in SATELLITE if n.startswith("vigencia_")}

    chile, peru = ("7", "RUN", "Chile"), ("7", "DNI", "Perú")
    moves = [("A", "A", "M1", 20, chile), ("B", "B", "M2", 21, peru), ("A", "B", "M1", 20, chile), ("A", "B", "M1", 20, chile)]
    for day, (plant, machine_plant, machine, week, person) in enumerate(moves, 1):
        now = load(day, plant, machine_plant, machine, week, person)
        assert [r.planta_canon for r in now["vigencia_punto_planta"].collect()] == [plant]
        assert [(r.ubicacion_tecnica, r.semana_nro) for r in now["vigencia_ot_maqctrl"].collect()] == [(machine, week)]
        assert [(r.dni, r.tipo_dni, r.dni_pais_emisor) for r in now["vigencia_ot_responsable"].collect()] == [person]
        assert sorted(r.planta_canon for r in now["vigencia_maqctrl_planta"].collect()) == sorted([machine_plant, "B"])
    assert spark.read.parquet(f"{root}/vigencia_punto_planta").count() == 3


def test_two_people_with_one_number(spark):
    rows = [("O1", "7", "RUN", "Chile"), ("O1", "7", "DNI", "Perú")]
    src = spark.createDataFrame(rows, "orden_nro string, dni string, tipo_dni string, dni_pais_emisor string")
    links = vault.link_rows("relacion_ot_responsable", {"ordenes_personas": src}, None, F.current_timestamp())
    assert links.select(h.KEY).distinct().count() == 2
