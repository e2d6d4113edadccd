"""Input tables: column name, type, and whether the column is a join key."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    key: bool = False
    required: bool = True
    aliases: tuple[str, ...] = ()
    #: Digits of a code that is written with leading zeros; a number is padded to them.
    digits: int = 0


CLAIMS = (
    Field("clm_cntl_num", "string", key=True, required=False),
    Field("clm_line_num", "int", required=False),
    Field("hicn", "string", key=True, required=False),
    Field("clm_thru_dt", "date"),
    Field("clm_type_cd", "string", required=False),
    Field("clm_fac_type_cd", "string", required=False),
    Field("clm_srvc_clsfctn_type_cd", "string", required=False),
    Field("type_of_bill", "string", required=False),
    Field("hcpcs_cd", "string", key=True, required=False),
    Field("diag", "string", key=True, required=False),
    Field("raps_riskeligible", "int", required=False),
    Field("eds_riskeligible", "int", required=False),
    Field("provider_type", "string", required=False, digits=2),
)
DIAGNOSES = (
    Field("hicn", "string", key=True),
    Field("diag", "string", key=True),
)
CPT_LIST = (
    Field("hcpcs_cpt_code", "string", key=True, aliases=("hcpcs_cpt",)),
    Field("cy", "int"),
)
ELIGIBILITY = (
    Field("hicn", "string"),
    Field("dob", "date"),
    Field("sex", "int"),
    Field("orec", "int"),
    Field("medicaid", "int"),
    Field("model", "string", key=True),
)
MAPPING = (
    Field("diag", "string", key=True),
    Field("hcc", "int"),
)
WEIGHTS = (
    Field("lookup_key", "string", key=True),
    Field("variable", "string", key=True),
    Field("coef", "decimal(18,9)"),
)
