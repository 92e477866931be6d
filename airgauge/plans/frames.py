"""The canonical frames marts are built from, by natural key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

# Literals of the stored model.
MEASURED = "medido"
DONE, NOT_DONE = 1, 0
ROLE_OPERATOR, ROLE_TECHNICIAN = "operador", "tecnico"
ROLES = {ROLE_OPERATOR: "operador_alias", ROLE_TECHNICIAN: "tecnico_alias"}
SCOPE_INSPECTION, SCOPE_MAINTENANCE = "fiscalizacion", "mantencion"
STOPPED_MACHINE = "Máquina de control detenida"


SUBJECTS = (
    "medicion",
    "punto",
    "planta",
    "maquina_gen",
    "semana",
    "medicion_persona",
    "persona",
    "orden",
    "orden_responsable",
    "maquina_control",
    "cobertura",
    "componente",
    "condicion_observada",
    "condicion_tipo",
    "condicion_problema",
    "problema_raiz",
)


class Lazy(Mapping):
    """Frames by name, each planned once, when first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def replaced(self, **frames: DataFrame) -> Lazy:
        return type(self)({**self._makers, **{k: lambda v=v: v for k, v in frames.items()}})


class Frames(Lazy):
    """Current state of the history, one frame per subject, as attributes.

    Grain: medicion one row per (punto_nro, anio, semana_nro); orden one row per
    (orden_nro, ubicacion_tecnica, anio, semana_nro); every other frame one row
    per key, except the N:M frames cobertura and condicion_observada.
    """

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        missing = set(SUBJECTS) - set(makers)
        if missing:
            raise ValueError(f"no frame for {sorted(missing)}")
        super().__init__(makers)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]
