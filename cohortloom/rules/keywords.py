"""Drug, site, status and race keyword lists.  Fixed values."""

# Hepatitis C treatment, generic names as used in drug class titles.
HEPATITIS_DRUGS: tuple[str, ...] = (
    "BOCEPREVIR", "DACLATASVIR", "DASABUVIR", "ELBASVIR", "GLECAPREVIR", "GRAZOPREVIR",
    "INTERFERON ALFA", "LEDIPASVIR", "OMBITASVIR", "PARITAPREVIR", "PEGINTERFERON",
    "PIBRENTASVIR", "SIMEPREVIR", "SOFOSBUVIR", "TELAPREVIR", "VELPATASVIR", "VOXILAPREVIR",
)

# Brand names that also turn up in self-reported medication lists.
HEPATITIS_BRANDS: tuple[str, ...] = (
    "DAKLINZA", "INCIVEK", "INFERGEN", "MAVYRET", "OLYSIO", "PEGASYS", "ZEPATIER",
)

CANCELED = "Canceled"
ARV_SUBCLASS = "RETROVIRAL"
HEPATITIS_B_CLASS = "HEPATITIS B TREATMENT AGENTS"
PREP_CODES: tuple[str, ...] = ("J05AR03", "J05AR17")

NALOXONE_CODES: tuple[str, ...] = ("V03AB15",)
BUPRENORPHINE_CODES: tuple[str, ...] = ("N07BC01", "N07BC51")
EMERGENCY_LOCATION = "JPS EMERGENCY"

ERRONEOUS = "ERRONEOUS"
CARE_SITES: tuple[str, ...] = ("HEALING WINGS", "TRUE WORTH", "CORRECTIONAL FACILITY")

HISPANIC_GROUP = "Hispanic, Latino or Spanish ethnicity"
HISPANIC = "Hispanic"
BLACK = "BLACK"
WHITE = "CAUCASIAN"
OTHER_RACES: tuple[str, ...] = ("ASIAN", "INDIAN", "HAWAIIAN", "OTHER")
NH_BLACK = "NH Black"
NH_OTHER = "NH Other"
NH_WHITE = "NH White"

IN_REGISTRY = "HIVCOR"
EXCLUDED = "Excluded"

# Component names that mark a laboratory row as hepatitis C related (read upper-cased).
HEPATITIS_COMPONENT_NAMES: tuple[str, ...] = ("HCV", "HEPATITIS C")
