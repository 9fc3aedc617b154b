"""Indicator formulas (IND-*), each defined once.

Every ratio is a ``try_divide`` so a zero denominator gives null (the
source's None rule), never an exception under ANSI mode and never the
prototype's ``max(den, 1)``.  Inputs are cast to double before dividing so
the arithmetic is identical to an independent SQL engine's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(num, den) -> Column:
    return F.try_divide(_d(num), _d(den))


def pct(num, den) -> Column:
    return F.try_divide(_d(num) * F.lit(100.0), _d(den))


def clearance_ratio(resueltos, ingresos) -> Column:          # IND-1
    return ratio(resueltos, ingresos)


def clearance_pct(resueltos, ingresos) -> Column:            # IND-1, percent form
    return pct(resueltos, ingresos)


def congestion(pendientes, ingresos, resueltos) -> Column:   # IND-2
    return ratio(_d(pendientes) + _d(ingresos), resueltos)


def backlog_ratio(pendientes, resueltos) -> Column:          # IND-3 (mora)
    return ratio(pendientes, _d(pendientes) + _d(resueltos))


def load_per_judge(ingresados, jueces) -> Column:            # IND-4
    return ratio(ingresados, jueces)


def per_thousand(ingresados, poblacion_miles) -> Column:     # IND-5
    return ratio(ingresados, poblacion_miles)


def active_cases(pendientes, ingresados, resueltos) -> Column:  # IND-6
    return F.col(pendientes) + F.col(ingresados) - F.col(resueltos) if isinstance(pendientes, str) \
        else pendientes + ingresados - resueltos


def caseload(pendientes_inicio, ingresos) -> Column:         # IND-7
    return (F.col(pendientes_inicio) if isinstance(pendientes_inicio, str) else pendientes_inicio) + \
        (F.col(ingresos) if isinstance(ingresos, str) else ingresos)


def pending_rate_pct(pendientes_fin, carga) -> Column:       # IND-8
    return pct(pendientes_fin, carga)


def disposition_time(pendientes, resueltos) -> Column:       # IND-9 (an estimate, not a delay)
    return F.try_divide(_d(pendientes) * F.lit(365.0), _d(resueltos))


def productivity(resueltos, jueces) -> Column:               # IND-10
    return ratio(resueltos, jueces)


def saturation(carga, capacidad) -> Column:                  # IND-11
    return ratio(carga, capacidad)


def appeal_rate(apelados, sentenciados) -> Column:           # IND-12
    return ratio(apelados, sentenciados)


def share(part, total) -> Column:                            # IND-13, IND-18
    return ratio(part, total)


def model_lift(mae, baseline_mae) -> Column:                 # IND-17
    return F.lit(1.0) - ratio(mae, baseline_mae)


def budget_execution(ejecutado, asignado) -> Column:         # IND-19
    return ratio(ejecutado, asignado)
