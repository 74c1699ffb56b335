"""Which diagnosis rows date which substance.  Fixed values; rules are independent."""

from __future__ import annotations

from dataclasses import dataclass

OPIOID_NAMES: tuple[str, ...] = ("Opiate", "Opioid", "Methadone", "Heroin", "Fentanyl")
METHAMPHETAMINE_NAME = "Methamp"


@dataclass(frozen=True)
class DiagnosisRule:
    """A row counts if its code list holds ``code`` or its name one of ``names``,
    and the name holds none of ``excluded``."""

    column: str
    code: str | None = None
    names: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()


SUBSTANCE_RULES: tuple[DiagnosisRule, ...] = (
    DiagnosisRule("ALCOHOL_DX_DATE", "F10"),
    DiagnosisRule("OPIOID_DX_DATE", "F11", names=OPIOID_NAMES),
    DiagnosisRule("CANNABIS_DX_DATE", "F12"),
    DiagnosisRule("SEDATIVE_DX_DATE", "F13"),
    DiagnosisRule("COCAINE_DX_DATE", "F14"),
    DiagnosisRule("OTHER_STIMULANT_DX_DATE", "F15", excluded=(METHAMPHETAMINE_NAME,)),
    DiagnosisRule("METHAMPHETAMINE_DX_DATE", names=(METHAMPHETAMINE_NAME,)),
    DiagnosisRule("HALLUCINOGEN_DX_DATE", "F16"),
    DiagnosisRule("NICOTINE_DX_DATE", "F17"),
    DiagnosisRule("INHALANT_DX_DATE", "F18"),
    DiagnosisRule(
        "OTHER_PSYCHOACTIVE_DX_DATE", "F19", excluded=(*OPIOID_NAMES, METHAMPHETAMINE_NAME)
    ),
)
