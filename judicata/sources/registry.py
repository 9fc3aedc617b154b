"""Source registry (SRC-14): a static dimension of the public sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Public justice-statistics sources (id, name, institution, address, format, periodicity).
SOURCES = [
    ("poder_judicial", "Carga procesal por corte y especialidad", "Poder Judicial del Peru - Subgerencia de Estadistica",
     "https://www.pj.gob.pe/wps/wcm/connect/Estadisticas/", "xlsx", "anual"),
    ("ministerio_publico", "Carga fiscal e indicadores de criminalidad",
     "Ministerio Publico - Observatorio de Criminalidad", "https://www.mpfn.gob.pe/observatorio_criminalidad/", "xlsx", "anual"),
    ("jnj", "Nombramientos, ratificaciones, sanciones y rotaciones de magistrados",
     "Junta Nacional de Justicia (JNJ)", "https://www.gob.pe/jnj", "pdf", "continua"),
    ("inei", "Seguridad ciudadana, criminalidad y poblacion (ENAPRES / INPE / proyecciones)",
     "INEI (con INPE para poblacion penitenciaria)", "https://proyectos.inei.gob.pe/microdatos/", "csv", "anual"),
    ("minjus", "Defensa publica y acceso a la justicia",
     "MINJUSDH - Direccion General de Defensa Publica y Acceso a la Justicia", "https://www.gob.pe/minjus", "xlsx", "anual"),
]


def source_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, "id string, nombre string, institucion string, url string, formato string, periodicidad string")
