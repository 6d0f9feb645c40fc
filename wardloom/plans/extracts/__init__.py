"""The eighteen target tables; each module has ``build(catalog, params)``."""

from __future__ import annotations

from wardloom.plans.extracts import (
    administration,
    bloods,
    demographics,
    diagnoses,
    emergency,
    episodes,
    icu_admissions,
    icu_medication,
    icu_organsupport,
    icu_procedures,
    microbiology,
    observations,
    orders,
    prescribing,
    procedures,
    risk_factors,
    transfers,
    virology,
)

#: target table -> job
EXTRACTS = {
    "demographics": demographics.build,
    "blood_test": bloods.build,
    "virology": virology.build,
    "orders": orders.build,
    "observations": observations.build,
    "administration": administration.build,
    "prescribing": prescribing.build,
    "microbiology_test": microbiology.build,
    "transfer": transfers.build,
    "procedures": procedures.build,
    "diagnosis": diagnoses.build,
    "episodes": episodes.build,
    "emergency": emergency.build,
    "icu_admissions": icu_admissions.build,
    "icu_organsupport": icu_organsupport.build,
    "icu_medication": icu_medication.build,
    "icu_procedures": icu_procedures.build,
    "riskfactors": risk_factors.build,
}
