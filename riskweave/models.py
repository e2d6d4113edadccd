"""Fixed values of the two 2019 model versions and the ``ModelSpec`` built from them.

A spec is plain data.  Operators turn it into column expressions; nothing here
touches Spark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from riskweave.functions.bitset import BitSet

# --------------------------------------------------------------------------
# These must equal the published models for the results to agree.
# --------------------------------------------------------------------------

# Age on 1 February of the payment year; one band per sex ("f" = 2, "m" = 1).
# suffix, lowest age, highest age (None = open), only for model E
AGE_BANDS = (
    ("0_34", 1, 34, False),
    ("35_44", 35, 44, False),
    ("45_54", 45, 54, False),
    ("55_59", 55, 59, False),
    ("60_64", 60, 63, False),
    ("65", 65, 65, True),
    ("66", 66, 66, True),
    ("67", 67, 67, True),
    ("68", 68, 68, True),
    ("69", 69, 69, True),
    ("65_69", 65, 69, False),
    ("70_74", 70, 74, False),
    ("75_79", 75, 79, False),
    ("80_84", 80, 84, False),
    ("85_89", 85, 89, False),
    ("90_94", 90, 94, False),
    ("95_gt", 95, None, False),
)
# Age 64 belongs to "60_64" when the original entitlement code is not 0, and to "65"
# when it is 0, whatever the model.
AGE_SPLIT_BY_ENTITLEMENT = 64
BAND_AT_SPLIT_OTHER = "60_64"
BAND_AT_SPLIT_OLD_AGE = "65"
SEX_PREFIXES = (("f", 2), ("m", 1))
ORIGINALLY_DISABLED = (("originallydisabled_female", 2), ("originallydisabled_male", 1))

HCCS_V22 = (
    1, 2, 6, 8, 9, 10, 11, 12, 17, 18, 19, 21, 22, 23, 27, 28, 29, 33, 34, 35, 39, 40, 46, 47,
    48, 54, 55, 57, 58, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 80, 82, 83, 84, 85, 86, 87, 88,
    96, 99, 100, 103, 104, 106, 107, 108, 110, 111, 112, 114, 115, 122, 124, 134, 135, 136, 137,
    157, 158, 161, 162, 166, 167, 169, 170, 173, 176, 186, 188, 189,
)
HCCS_ADDED_V23 = (56, 59, 60, 138)

# A present parent drops its children.
DROPS_V22 = {
    8: (9, 10, 11, 12),
    9: (10, 11, 12),
    10: (11, 12),
    11: (12,),
    17: (18, 19),
    18: (19,),
    27: (28, 29, 80),
    28: (29,),
    46: (48,),
    54: (55,),
    57: (58,),
    70: (71, 72, 103, 104, 169),
    71: (72, 104, 169),
    72: (169,),
    82: (83, 84),
    83: (84,),
    86: (87, 88),
    87: (88,),
    99: (100,),
    103: (104,),
    106: (107, 108, 161, 189),
    107: (108,),
    110: (111, 112),
    111: (112,),
    114: (115,),
    134: (135, 136, 137),
    135: (136, 137),
    136: (137,),
    157: (158, 161),
    158: (161,),
    166: (80, 167),
}
DROPS_ADDED_V23 = {
    54: (56,),
    55: (56,),
    57: (59, 60),
    58: (59, 60),
    59: (60,),
    134: (138,),
    135: (138,),
    136: (138,),
    137: (138,),
}

# Groups of categories that interactions refer to ("any of").
CANCER = (8, 9, 10, 11, 12)
DIABETES = (17, 18, 19)
SUBSTANCE_V22 = (54, 55)
SUBSTANCE_V23 = (54, 55, 56)
PSYCHIATRIC_V22 = (57, 58)
PSYCHIATRIC_V23 = (57, 58, 59, 60)
RESPIRATORY_ARREST = (82, 83, 84)
COPD_CF = (110, 111, 112)
RENAL_V22 = (134, 135, 136, 137)
RENAL_V23 = (134, 135, 136, 137, 138)
PRESSURE_ULCER = (157, 158)

# Rules: a tuple of groups that must all be hit, and whether Disabled = 1 is also needed.
# "institutional Medicaid" and "never" are the two rules without categories.
INSTITUTIONAL_MEDICAID = "institutional Medicaid"
NEVER = "never"

# label V22, label V23, groups V22, groups V23 (None = as V22), needs Disabled V22, V23
INTERACTIONS = (
    ("hcc47_gcancer", "HCC47_gCancer", ((47,), CANCER), None, False, False),
    ("hcc85_gdiabetesmellit", "HCC85_gDiabetesMellit", ((85,), DIABETES), None, False, False),
    ("hcc85_gcopdcf", "HCC85_gCopdCF", ((85,), COPD_CF), None, False, False),
    ("hcc85_grenal", "HCC85_gRenal_V23", ((85,), RENAL_V22), ((85,), RENAL_V23), False, False),
    ("grespdepandarre_gcopdcf", "grespDepandArre_gCopdCF",
     (RESPIRATORY_ARREST, COPD_CF), None, False, False),
    ("hcc85_hcc96", "HCC85_HCC96", ((85,), (96,)), None, False, False),
    ("gsubstanceabuse_gpsychiatric", "disable_substAbuse_psych_V23",
     (SUBSTANCE_V22, PSYCHIATRIC_V22), (SUBSTANCE_V23, PSYCHIATRIC_V23), False, True),
    ("ltimcaid", "LTIMCAID", INSTITUTIONAL_MEDICAID, None, False, False),
    ("origds", "ORIGDS", NEVER, None, False, False),
    ("disabled_hcc85", "DISABLED_HCC85", ((85,),), None, True, True),
    ("disabled_pressure_ulcer", "DISABLED_PRESSURE_ULCER", (PRESSURE_ULCER,), None, True, True),
    ("disabled_hcc161", "DISABLED_HCC161", ((161,),), None, True, True),
    ("disabled_hcc39", "DISABLED_HCC39", ((39,),), None, True, True),
    ("disabled_hcc77", "DISABLED_HCC77", ((77,),), None, True, True),
    ("disabled_hcc6", "DISABLED_HCC6", ((6,),), None, True, True),
    ("chf_gcopdcf", "CHF_gCopdCF", ((85,), COPD_CF), None, False, False),
    ("gcopdcf_card_resp_fail", "gCopdCF_CARD_RESP_FAIL",
     (RESPIRATORY_ARREST, COPD_CF), None, False, False),
    ("sepsis_pressure_ulcer", "SEPSIS_PRESSURE_ULCER", ((2,), PRESSURE_ULCER), None, False, False),
    ("sepsis_artif_openings", "SEPSIS_ARTIF_OPENINGS", ((2,), (188,)), None, False, False),
    ("art_openings_pressure_ulcer", "ART_OPENINGS_PRESS_ULCER",
     ((188,), PRESSURE_ULCER), None, False, False),
    ("diabetes_chf", "DIABETES_CHF", ((85,), DIABETES), None, False, False),
    ("gcopdcf_asp_spec_bact_pneum", "gCopdCF_ASP_SPEC_B_PNEUM",
     ((114,), COPD_CF), None, False, False),
    ("asp_spec_bact_pneum_pres_ulc", "ASP_SPEC_B_PNEUM_PRES_ULC",
     ((114,), PRESSURE_ULCER), None, False, False),
    ("sepsis_asp_spec_bact_pneum", "SEPSIS_ASP_SPEC_BACT_PNEUM",
     ((2,), (114,)), None, False, False),
    ("schizophrenia_gcopdcf", "SCHIZOPHRENIA_gCopdCF", ((57,), COPD_CF), None, False, False),
    ("schizophrenia_chf", "SCHIZOPHRENIA_CHF", ((57,), (85,)), None, False, False),
    ("schizophrenia_seizures", "SCHIZOPHRENIA_SEIZURES", ((57,), (79,)), None, False, False),
)

# Category labels have three digits.
MAX_LABELLED = 999

SERVICE_YEAR = 2018
AGE_DATE = dt.date(2019, 2, 1)
CODING_INTENSITY_MILLIS = 941  # 0.941
NORMALIZATION_MILLIS = {"v22": 1041, "v23": 1038}  # 1.041 and 1.038

COMMUNITY_MODELS = ("CN", "CP", "CF")
INSTITUTIONAL_MODEL = "I"
NEW_ENROLLEE_MODEL = "E"

PARTIAL_DUAL_CODES = ("01", "03", "05", "06")
FULL_DUAL_CODES = ("02", "04", "08", "10")

PHYSICIAN_CLAIM_TYPES = ("4700",)
INPATIENT_BILL_TYPES = ("11", "41")
OUTPATIENT_BILL_TYPES = ("12", "13", "43", "71", "73", "76", "77", "85")
SUBMISSION_PROVIDER_TYPES = ("01", "02")

# --------------------------------------------------------------------------
# End of the fixed values.
# --------------------------------------------------------------------------

# Column names that several modules share.
CLAIM = "clm_cntl_num"
# Part of the key of tables that ``sources.buckets`` writes.
CLAIM_SLOT = "claim_slot"


@dataclass(frozen=True)
class ClaimRules:
    """Which claims the filters accept; claim types and bill types are the caller's to edit.

    ``years`` limits the filters to claims with a through date in one of these years; without
    any, a line only has to fall in a year of the procedure list.
    """

    physician_types: tuple[str, ...] = PHYSICIAN_CLAIM_TYPES
    inpatient_bills: tuple[str, ...] = INPATIENT_BILL_TYPES
    outpatient_bills: tuple[str, ...] = OUTPATIENT_BILL_TYPES
    years: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        for code in self.physician_types:
            if not code or code != code.strip():
                raise ValueError(f"claim type {code!r} is empty or has blanks around it")
        for code in self.inpatient_bills + self.outpatient_bills:
            if len(code) != 2 or not code.isalnum():
                raise ValueError(f"a bill type has two letters or digits, not {code!r}")


@dataclass(frozen=True)
class Interaction:
    label: str
    groups: tuple[tuple[int, ...], ...] | str
    disabled_only: bool


def closed_drops(drops: Mapping[int, Sequence[int]]) -> dict[int, tuple[int, ...]]:
    """Every parent with all that it drops, directly or through a child; a cycle is an error."""
    closed: dict[int, tuple[int, ...]] = {}

    def below(parent: int, path: tuple[int, ...]) -> tuple[int, ...]:
        if parent in path:
            chain = " -> ".join(map(str, (*path[path.index(parent):], parent)))
            raise ValueError(f"hierarchy rules form a cycle: {chain}")
        if parent not in closed:
            found = set(drops.get(parent, ()))
            for child in drops.get(parent, ()):
                found.update(below(child, (*path, parent)))
            closed[parent] = tuple(sorted(found))
        return closed[parent]

    return {parent: below(parent, ()) for parent in drops if drops[parent]}


@dataclass(frozen=True)
class ModelSpec:
    """Everything that distinguishes one model version (or one payment year)."""

    version: str
    hccs: tuple[int, ...]
    drops: dict[int, tuple[int, ...]]
    interactions: tuple[Interaction, ...]
    normalization_millis: int
    coding_intensity_millis: int = CODING_INTENSITY_MILLIS
    service_year: int = SERVICE_YEAR
    age_date: dt.date = AGE_DATE

    def __post_init__(self) -> None:
        if len(set(self.hccs)) < len(self.hccs):
            raise ValueError(f"a category occurs twice: {sorted(self.hccs)}")
        if out := [h for h in self.hccs if not 0 <= h <= MAX_LABELLED]:
            raise ValueError(f"category numbers have up to three digits, not {out}")
        named = set(self.drops) | {c for cs in self.drops.values() for c in cs}
        named |= {h for i in self.interactions if not isinstance(i.groups, str)
                  for g in i.groups for h in g}
        if not named <= set(self.hccs):
            raise ValueError(f"rules name unknown categories: {sorted(named - set(self.hccs))}")
        upper = [label.upper() for label in self.labels]
        if twice := {label for label in upper if upper.count(label) > 1}:
            raise ValueError(f"labels occur twice: {sorted(twice)}")
        # Rules are applied all at once, to the set as it was, so they have to be closed.
        object.__setattr__(self, "drops", closed_drops(self.drops))

    @cached_property
    def categories(self) -> BitSet:
        """Where each category stands in the words of a person's set."""
        return BitSet(self.hccs)

    @cached_property
    def features(self) -> BitSet:
        """Where demographic variables and interactions stand in the words ``extra``."""
        return BitSet(demographic_labels() + tuple(i.label for i in self.interactions))

    @property
    def hcc_labels(self) -> tuple[str, ...]:
        return tuple(f"HCC{h:03d}" for h in self.hccs)

    @property
    def labels(self) -> tuple[str, ...]:
        """Every output variable in report order: demographics, categories, interactions."""
        return demographic_labels() + self.hcc_labels + tuple(i.label for i in self.interactions)


def band_labels() -> tuple[str, ...]:
    return tuple(sex + band[0] for sex, _ in SEX_PREFIXES for band in AGE_BANDS)


def demographic_labels() -> tuple[str, ...]:
    return band_labels() + tuple(label for label, _ in ORIGINALLY_DISABLED)


def _v22() -> ModelSpec:
    return ModelSpec(
        version="v22",
        hccs=HCCS_V22,
        drops=DROPS_V22,
        interactions=tuple(
            Interaction(label, groups, disabled)
            for label, _, groups, _, disabled, _ in INTERACTIONS
        ),
        normalization_millis=NORMALIZATION_MILLIS["v22"],
    )


def _v23() -> ModelSpec:
    parents = sorted(DROPS_V22.keys() | DROPS_ADDED_V23.keys())
    return ModelSpec(
        version="v23",
        hccs=tuple(sorted(HCCS_V22 + HCCS_ADDED_V23)),
        drops={p: DROPS_V22.get(p, ()) + DROPS_ADDED_V23.get(p, ()) for p in parents},
        interactions=tuple(
            Interaction(label, changed or groups, disabled)
            for _, label, groups, changed, _, disabled in INTERACTIONS
        ),
        normalization_millis=NORMALIZATION_MILLIS["v23"],
    )


CLAIM_RULES = ClaimRules()
V22 = _v22()
V23 = _v23()
