"""Sources and sinks: text landings, reference tables, marts, JSON outputs, audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    """One declared source. Columns not listed are taken from the file's header, as text."""

    name: str
    path: str
    columns: tuple[str, ...] = ()
    format: str = "csv"
    not_null: tuple[str, ...] = ()
    pattern: str = "overwrite"
    snapshot_key: tuple[str, ...] = ()
    check_cols: tuple[str, ...] | None = None
    tags: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), c not in self.not_null) for c in self.columns])


# Names and types of the reference tables.
REFERENCE_SCHEMAS = {
    "calendario_semanas": "anio int, semana_nro int, fecha_inicio_semana date, fecha_fin_semana date, trimestre int, mes int",
    "componentes_estado_semanal": "componente_codigo string, estado_actual string, severidad string, fecha_inspeccion date, anio int, semana_nro int",
    "componentes_estructurales": "componente_codigo string, componente_nombre string, tipo_componente string, nivel_jerarquia int, familia_causa string, maquina_gen_codigo string, componente_padre_codigo string",
    "condiciones_observadas": "punto_nro int, condicion_codigo string, anio int, semana_nro int, severidad string",
    "condiciones_problema": "condicion_codigo string, problema_raiz_codigo string",
    "condiciones_tipo": "condicion_codigo string, nombre string, severidad_default string, peso_causa_default double",
    "equipos_ventilacion_catalogo": "ubicacion_tecnica string, equipo_denom string, tipo_equipo string, familia_equipo string, sector string, planta_canon string, orden_sap_ejemplo string, fuente string",
    "personas_alias": "alias_fuente string, dni string, tipo_dni string, dni_pais_emisor string, nombre_completo string, tipo_persona string",
    "plantas_descripcion": "planta_canon string, nombre_planta string, area string, sector string",
    "problemas_raiz": "problema_raiz_codigo string, nombre string, familia string, descripcion string",
    "punto_maqctrl_cobertura": "punto_nro int, ubicacion_tecnica string",
    "puntos_catalogo": "punto_evaluacion string, punto_nro int, planta_canon string, maquina_gen_codigo string, componente_codigo string, nombre_punto string, descripcion_punto string, tipo_punto string, maquina_gen_nombre string, tipo_maquina_gen string, descripcion string",
    "semaforo_polvo_respirable": "nivel int, concentracion_min_mg_m3 double, concentracion_max_mg_m3 double, color string, etiqueta string, es_sobre_limite_interno boolean",
    "tipos_equipo_ctrl": "tipo_equipo_codigo string, nombre string, familia string",
}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Looked up through Hadoop, so any file system of the cluster works."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()


def scan_csv(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Every column as text. With declared columns no pass over the data is needed for a schema."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    if spec.columns:
        reader = reader.schema(spec.schema).option("enforceSchema", False)
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(spec.path)


def scan_optional(spark: SparkSession, spec: SourceSpec) -> tuple[DataFrame, bool]:
    """The source, or an empty frame with its columns, and whether it was there."""
    if path_exists(spark, spec.path):
        return scan_csv(spark, spec), True
    return spark.createDataFrame([], spec.schema), False


def scan_all(spark: SparkSession, specs: Iterable[SourceSpec]) -> tuple[DataFrame, dict[str, bool]]:
    """Present sources stacked by column name, tagged with source name and tags; and the report."""
    frames, report = [], {}
    for spec in specs:
        df, present = scan_optional(spark, spec)
        report[spec.name] = present
        if present:
            frames.append(df.withColumns({**{k: F.lit(v) for k, v in spec.tags.items()}, "_fuente": F.lit(spec.name)}))
    if not frames:
        raise FileNotFoundError(f"none of the declared sources is present: {sorted(report)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), report


def load_reference(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A reference table with its declared types. Its size decides how it joins, not a hint."""
    return spark.read.schema(REFERENCE_SCHEMAS[name]).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_mart(df: DataFrame, path: str, by: Sequence[str] = ("anio",), max_rows_per_file: int = 10_000_000) -> None:
    """A mart partitioned for pruning.

    Rebalancing by the partition columns keeps files few, and AQE splits the
    share of a year that holds most rows over several tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).partitionBy(*by).parquet(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def new_rows(df: DataFrame, stored: DataFrame | None, key: Sequence[str]) -> DataFrame:
    return df if stored is None else df.join(stored.select(*key), list(key), "left_anti")


def append_new(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Append the rows whose key is not stored. A rerun after a lost job adds only what is missing."""
    new_rows(df, read_if_present(df.sparkSession, path), key).write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def audit_counts(tables: Mapping[str, DataFrame], limits: Mapping[str, int] | None = None) -> DataFrame:
    """Rows per table in one plan, with the expected minimum if one is given."""
    limits = limits or {}

    def one(name: str, df: DataFrame) -> DataFrame:
        low: Column = F.lit(limits.get(name, 0)).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("tabla"), "filas", low.alias("minimo"), (F.col("filas") >= low).alias("cumple")
        )

    return reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in tables.items()])


def ensure_vector_table(spark: SparkSession, path: str, size: int, id_type: str = "bigint") -> DataFrame:
    """An empty vector table if there is none yet; an existing one must hold vectors of `size`."""
    if not path_exists(spark, path):
        schema = f"vec_id {id_type}, embedding array<float>, dimension int, distancia string"
        empty = spark.createDataFrame([], schema)
        empty.write.parquet(path)
        return spark.read.schema(schema).parquet(path)
    table = spark.read.parquet(path)
    other = table.where((F.col("dimension") != size) | (F.size("embedding") != size)).limit(1).count()
    if other:
        raise ValueError(f"{path} holds vectors of another size than {size}")
    return table


def append_vectors(df: DataFrame, path: str, size: int) -> None:
    """Append vectors of the table's size whose id is not stored yet."""
    rows = df.where(F.size("embedding") == size).select(
        "vec_id",
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.lit(size).alias("dimension"),
        F.lit("cosine").alias("distancia"),
    )
    append_new(rows, path, ["vec_id"])
