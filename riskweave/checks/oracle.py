"""SQL formulation of every query, run by another engine on the same tables.

It is written apart from the operators on purpose: categories, drops and interactions are
rows that are joined, where the engine works on bit sets, and its rule tables are stated
again here instead of being read from the model specs.
"""

from __future__ import annotations

from collections.abc import Iterable

from riskweave.checks import fixtures

# --------------------------------------------------------------------------
# Fixed values of the two model versions.
# --------------------------------------------------------------------------

HCCS = {
    "v22": (
        1, 2, 6, 8, 9, 10, 11, 12, 17, 18, 19, 21, 22, 23, 27, 28, 29, 33, 34, 35, 39, 40, 46,
        47, 48, 54, 55, 57, 58, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 80, 82, 83, 84, 85, 86,
        87, 88, 96, 99, 100, 103, 104, 106, 107, 108, 110, 111, 112, 114, 115, 122, 124, 134,
        135, 136, 137, 157, 158, 161, 162, 166, 167, 169, 170, 173, 176, 186, 188, 189,
    ),
    "v23": (
        1, 2, 6, 8, 9, 10, 11, 12, 17, 18, 19, 21, 22, 23, 27, 28, 29, 33, 34, 35, 39, 40, 46,
        47, 48, 54, 55, 56, 57, 58, 59, 60, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 80, 82, 83,
        84, 85, 86, 87, 88, 96, 99, 100, 103, 104, 106, 107, 108, 110, 111, 112, 114, 115, 122,
        124, 134, 135, 136, 137, 138, 157, 158, 161, 162, 166, 167, 169, 170, 173, 176, 186, 188,
        189,
    ),
}

# parent: dropped children
DROPS = {
    "v22": {
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
    },
    "v23": {
        8: (9, 10, 11, 12),
        9: (10, 11, 12),
        10: (11, 12),
        11: (12,),
        17: (18, 19),
        18: (19,),
        27: (28, 29, 80),
        28: (29,),
        46: (48,),
        54: (55, 56),
        55: (56,),
        57: (58, 59, 60),
        58: (59, 60),
        59: (60,),
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
        134: (135, 136, 137, 138),
        135: (136, 137, 138),
        136: (137, 138),
        137: (138,),
        157: (158, 161),
        158: (161,),
        166: (80, 167),
    },
}

# label, groups of which each must be hit, only when disabled
INTERACTIONS = {
    "v22": (
        ("hcc47_gcancer", ((47,), (8, 9, 10, 11, 12)), False),
        ("hcc85_gdiabetesmellit", ((85,), (17, 18, 19)), False),
        ("hcc85_gcopdcf", ((85,), (110, 111, 112)), False),
        ("hcc85_grenal", ((85,), (134, 135, 136, 137)), False),
        ("grespdepandarre_gcopdcf", ((82, 83, 84), (110, 111, 112)), False),
        ("hcc85_hcc96", ((85,), (96,)), False),
        ("gsubstanceabuse_gpsychiatric", ((54, 55), (57, 58)), False),
        ("ltimcaid", (), False),
        ("origds", (), False),
        ("disabled_hcc85", ((85,),), True),
        ("disabled_pressure_ulcer", ((157, 158),), True),
        ("disabled_hcc161", ((161,),), True),
        ("disabled_hcc39", ((39,),), True),
        ("disabled_hcc77", ((77,),), True),
        ("disabled_hcc6", ((6,),), True),
        ("chf_gcopdcf", ((85,), (110, 111, 112)), False),
        ("gcopdcf_card_resp_fail", ((82, 83, 84), (110, 111, 112)), False),
        ("sepsis_pressure_ulcer", ((2,), (157, 158)), False),
        ("sepsis_artif_openings", ((2,), (188,)), False),
        ("art_openings_pressure_ulcer", ((188,), (157, 158)), False),
        ("diabetes_chf", ((85,), (17, 18, 19)), False),
        ("gcopdcf_asp_spec_bact_pneum", ((114,), (110, 111, 112)), False),
        ("asp_spec_bact_pneum_pres_ulc", ((114,), (157, 158)), False),
        ("sepsis_asp_spec_bact_pneum", ((2,), (114,)), False),
        ("schizophrenia_gcopdcf", ((57,), (110, 111, 112)), False),
        ("schizophrenia_chf", ((57,), (85,)), False),
        ("schizophrenia_seizures", ((57,), (79,)), False),
    ),
    "v23": (
        ("HCC47_gCancer", ((47,), (8, 9, 10, 11, 12)), False),
        ("HCC85_gDiabetesMellit", ((85,), (17, 18, 19)), False),
        ("HCC85_gCopdCF", ((85,), (110, 111, 112)), False),
        ("HCC85_gRenal_V23", ((85,), (134, 135, 136, 137, 138)), False),
        ("grespDepandArre_gCopdCF", ((82, 83, 84), (110, 111, 112)), False),
        ("HCC85_HCC96", ((85,), (96,)), False),
        ("disable_substAbuse_psych_V23", ((54, 55, 56), (57, 58, 59, 60)), True),
        ("LTIMCAID", (), False),
        ("ORIGDS", (), False),
        ("DISABLED_HCC85", ((85,),), True),
        ("DISABLED_PRESSURE_ULCER", ((157, 158),), True),
        ("DISABLED_HCC161", ((161,),), True),
        ("DISABLED_HCC39", ((39,),), True),
        ("DISABLED_HCC77", ((77,),), True),
        ("DISABLED_HCC6", ((6,),), True),
        ("CHF_gCopdCF", ((85,), (110, 111, 112)), False),
        ("gCopdCF_CARD_RESP_FAIL", ((82, 83, 84), (110, 111, 112)), False),
        ("SEPSIS_PRESSURE_ULCER", ((2,), (157, 158)), False),
        ("SEPSIS_ARTIF_OPENINGS", ((2,), (188,)), False),
        ("ART_OPENINGS_PRESS_ULCER", ((188,), (157, 158)), False),
        ("DIABETES_CHF", ((85,), (17, 18, 19)), False),
        ("gCopdCF_ASP_SPEC_B_PNEUM", ((114,), (110, 111, 112)), False),
        ("ASP_SPEC_B_PNEUM_PRES_ULC", ((114,), (157, 158)), False),
        ("SEPSIS_ASP_SPEC_BACT_PNEUM", ((2,), (114,)), False),
        ("SCHIZOPHRENIA_gCopdCF", ((57,), (110, 111, 112)), False),
        ("SCHIZOPHRENIA_CHF", ((57,), (85,)), False),
        ("SCHIZOPHRENIA_SEIZURES", ((57,), (79,)), False),
    ),
}
INSTITUTIONAL_MEDICAID = {"v22": "ltimcaid", "v23": "LTIMCAID"}
NORMALIZATION = {"v22": 1041, "v23": 1038}

# suffix, from age, to age, only for new enrollees
BANDS = """
    ('0_34', 1, 34, false), ('35_44', 35, 44, false), ('45_54', 45, 54, false),
    ('55_59', 55, 59, false), ('60_64', 60, 63, false), ('65', 65, 65, true),
    ('66', 66, 66, true), ('67', 67, 67, true), ('68', 68, 68, true), ('69', 69, 69, true),
    ('65_69', 65, 69, false), ('70_74', 70, 74, false), ('75_79', 75, 79, false),
    ('80_84', 80, 84, false), ('85_89', 85, 89, false), ('90_94', 90, 94, false),
    ('95_gt', 95, 9999, false)
"""
BAND_SUFFIXES = (
    "0_34", "35_44", "45_54", "55_59", "60_64", "65", "66", "67", "68", "69", "65_69",
    "70_74", "75_79", "80_84", "85_89", "90_94", "95_gt",
)

# --------------------------------------------------------------------------
# End of the fixed values.
# --------------------------------------------------------------------------

VERSIONS = ("v22", "v23")


def _hccs(version: str) -> tuple[int, ...]:
    return HCCS[version]


def _drop_pairs(version: str) -> list[tuple[int, int]]:
    return [(parent, child) for parent, found in DROPS[version].items() for child in found]


def _parents(version: str) -> list[int]:
    return sorted(DROPS[version])


def _rules(version: str) -> tuple[tuple[str, tuple[tuple[int, ...], ...], bool], ...]:
    return INTERACTIONS[version]


def _band_labels() -> list[str]:
    return [sex + suffix for sex in "fm" for suffix in BAND_SUFFIXES]


def _demographic_labels() -> list[str]:
    return [*_band_labels(), "originallydisabled_female", "originallydisabled_male"]


def _labels(version: str) -> list[str]:
    hccs = [f"HCC{n:03d}" for n in _hccs(version)]
    return [*_demographic_labels(), *hccs, *(label for label, _, _ in _rules(version))]


def _in(numbers: Iterable[int]) -> str:
    return f"({', '.join(map(str, numbers))})"


def _values(rows: list[tuple]) -> str:
    return ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in row) + ")"
        for row in rows
    )


def _flags(labels: list[str], column: str = "label") -> str:
    """0/1 columns from rows: was there a row with this label?"""
    return ",\n ".join(
        f"cast(coalesce(bool_or({column} = '{label}'), false) as int) as {label.lower()}"
        for label in labels
    )


_TABLES = {n: n for n in ("customer", "orders", "lineitem")}
_INPUTS = {
    "eligibility": fixtures.ELIGIBILITY,
    "claim_lines": fixtures.CLAIM_LINES,
    "claims": fixtures.CLAIMS,
    "mapping": fixtures.MAPPING,
    "cpt_list": fixtures.CPT_LIST,
    "dual_status": fixtures.DUAL_STATUS,
    "further_dx": fixtures.FURTHER_DX,
    "claim_lines_mixed_bill": fixtures.CLAIM_LINES_MIXED_BILL,
    "given": fixtures.ELIGIBILITY_MIXED_CASE,
}

# The filters with their codes and the years they are limited to.
_FILTERS = """
coded as (
 select l.*, {tob} as tob,
  exists (select 1 from cpt_list c
          where c.hcpcs_cpt_code = l.hcpcs_cd and c.cy = extract(year from l.clm_thru_dt)) as listed
 from {lines} l where {years}),
physician as (select distinct clm_cntl_num from coded where clm_type_cd in ({types}) and listed),
inpatient as (select distinct clm_cntl_num from coded where tob in ({inpatient})),
outpatient as (
 select distinct clm_cntl_num from coded where tob in ({outpatient}) and listed),
eds_all as (
 select clm_cntl_num from physician union select clm_cntl_num from inpatient
 union select clm_cntl_num from outpatient)"""
_USUAL = {
    "tob": "clm_fac_type_cd || clm_srvc_clsfctn_type_cd",
    "lines": "claim_lines",
    "years": "true",
    "types": "'4700'",
    "inpatient": "'11', '41'",
    "outpatient": "'12', '13', '43', '71', '73', '76', '77', '85'",
}
_CLAIM_FILTERS = _FILTERS.format(**_USUAL)
_FLAGS = """
select e.clm_cntl_num, p.clm_cntl_num is not null as physician,
 i.clm_cntl_num is not null as inpatient, o.clm_cntl_num is not null as outpatient
from eds_all e left join physician p using (clm_cntl_num)
left join inpatient i using (clm_cntl_num) left join outpatient o using (clm_cntl_num)"""

_PERSONS = """
person as (select hicn, dob, sex, orec, medicaid, model from eligibility where hicn is not null),
aged as (
 select *, cast(floor((date '2019-02-01' - dob) * 4 / 1461.0) as int) as age from person),
featured as (
 select *, case when age < 65 and orec in (1, 2, 3) then 1 else 0 end as disabled from aged),
keyed as (
 select *, case
   when model in ('CN', 'CP', 'CF') then model || cast(disabled as varchar)
   when model = 'I' then 'I'
   when model = 'E' and age <= 64 then 'E' || cast(medicaid as varchar) || '0'
   when model = 'E' then 'E' || cast(medicaid as varchar) || cast(orec as varchar)
  end as lookup_key
 from featured)"""

_DEMOGRAPHICS = f"""
sexes as (select * from (values ('f', 2), ('m', 1)) s(prefix, sex)),
bands as (select * from (values {BANDS}) b(suffix, low, high, only_e)),
demographic as (
 select hicn, prefix || suffix as label
 from featured join sexes using (sex)
 join bands on age between low and high and (not only_e or model = 'E')
 union all
 select hicn, prefix || case when orec = 0 then '65' else '60_64' end
 from featured join sexes using (sex) where age = 64 and orec is not null
 union all
 select hicn, case sex when 2 then 'originallydisabled_female' else 'originallydisabled_male' end
 from featured where orec = 1 and sex in (1, 2))"""

_FURTHER = """
 union
 select upper(rtrim(hicn)), replace(upper(rtrim(diag)), '.', '') from further_dx
 where diag is not null and hicn is not null)"""

_DIAGNOSES = {
    "v22": """
dx as (
 select distinct hicn, replace(diag, '.', '') as diag from claims
 where extract(year from clm_thru_dt) = 2018 and raps_riskeligible = 1
  and diag is not null and hicn is not null)""",
    "v23": """
dx as (
 select hicn, replace(diag, '.', '') as diag from claims
 where extract(year from clm_thru_dt) = 2018 and clm_cntl_num in (select clm_cntl_num from eds_all)
  and diag is not null and hicn is not null
 union
 select hicn, replace(diag, '.', '') from claims
 where extract(year from clm_thru_dt) = 2018 and provider_type in ('01', '02')
  and diag is not null and hicn is not null)""",
}


def _model(version: str) -> str:
    """Categories before and after the hierarchies, interactions, all variables as rows."""
    rules = [
        (label, group, n, len(groups), disabled)
        for label, groups, disabled in _rules(version)
        for group, numbers in enumerate(groups)
        for n in numbers
    ]
    return f"""
dx_hcc as (select hicn, dx.diag, hcc from dx join mapping on dx.diag = mapping.diag
 where hcc is not null),
before as (
 select distinct hicn, hcc from dx_hcc join person using (hicn) where hcc in {_in(_hccs(version))}),
drops as (select * from (values {_values(_drop_pairs(version))}) d(parent, child)),
dropped as (select b.hicn, d.child as hcc from before b join drops d on b.hcc = d.parent),
remaining as (select hicn, hcc from before except select hicn, hcc from dropped),
rules as (
 select * from (values {_values(rules)}) r(label, grp, hcc, n_groups, only_disabled)),
interaction as (
 select hicn, label
 from before join rules using (hcc) join featured using (hicn)
 where not only_disabled or disabled = 1
 group by hicn, label, n_groups having count(distinct grp) = n_groups
 union all
 select hicn, '{INSTITUTIONAL_MEDICAID[version]}' from featured where medicaid = 1 and model = 'I'),
labels as (
 select * from (values {_values(list(enumerate(_labels(version), 1)))}) l(i, label)),
variables as (
 select hicn, label from demographic
 union all select hicn, 'HCC' || lpad(cast(hcc as varchar), 3, '0') from remaining
 union all select hicn, label from interaction)"""


def _score(version: str) -> str:
    """Sums in whole thousandths, rounded half up in integers."""
    d = NORMALIZATION[version]
    return f"""
weights as ({fixtures.WEIGHTS}),
sums as (
 select hicn, sum(cast(coef * 1000 as bigint)) as k
 from keyed join variables using (hicn) join labels using (label)
 join weights using (lookup_key, i)
 group by hicn),
scored as (
 select hicn, lookup_key,
  cast(coalesce((2 * k * 941 + {d}) // {2 * d}, 0) as double) / 1000 as cms_risk_score
 from keyed left join sums using (hicn))"""


def _query(inputs: list[str], ctes: list[str], select: str) -> str:
    tables = [f"{n} as ({_INPUTS[n].format(**_TABLES)})" for n in inputs]
    return f"with {', '.join([*tables, *ctes])}\n{select}"


def _claim_query(select: str) -> str:
    return _query(["claim_lines", "cpt_list"], [_CLAIM_FILTERS], select)


def _flags_query(inputs: list[str], **changed: str) -> str:
    return _query(inputs, [_FILTERS.format(**(_USUAL | changed))], _FLAGS)


def _person_query(select: str) -> str:
    return _query(["eligibility"], [_PERSONS, _DEMOGRAPHICS], select)


def _dx_query(version: str, select: str) -> str:
    """Queries that need diagnoses but no person."""
    if version == "v22":
        return _query(["claims", "mapping"], [_DIAGNOSES["v22"]], select)
    return _query(
        ["claims", "claim_lines", "cpt_list", "mapping"],
        [_CLAIM_FILTERS, _DIAGNOSES["v23"]], select,
    )


def _model_query(version: str, select: str, scored: bool = False, further: bool = False) -> str:
    inputs = ["eligibility", "claims", "mapping"]
    ctes = [_PERSONS, _DEMOGRAPHICS]
    if version == "v23":
        inputs += ["claim_lines", "cpt_list"]
        ctes += [_CLAIM_FILTERS]
    dx = _DIAGNOSES[version]
    if further:
        inputs += ["further_dx"]
        dx = dx.removesuffix(")") + _FURTHER
    ctes += [dx, _model(version)]
    return _query(inputs, [*ctes, _score(version)] if scored else ctes, select)


def _hcc_labels(version: str) -> list[str]:
    return [f"HCC{n:03d}" for n in _hccs(version)]


def _interaction_labels(version: str) -> list[str]:
    return [label for label, _, _ in _rules(version)]


_RESULT = """
select hicn, lookup_key, cms_risk_score,
 coalesce(string_agg(label, '|' order by i), '') as variables
from scored left join variables using (hicn) left join labels using (label)
group by hicn, lookup_key, cms_risk_score"""


def _raised(query: str, changes: dict[str, str]) -> str:
    """A query with some of its texts replaced; each has to be there."""
    for old, new in changes.items():
        assert old in query, old
        query = query.replace(old, new)
    return query


def _mixed_case() -> str:
    """Persons are joined in key form, and their identifier is reported as given."""
    keyed = _model_query("v22", _RESULT, scored=True)
    given = _query(["given"], [f"result as ({keyed})"], """
select given.hicn, result.* exclude (hicn)
from result join given on upper(rtrim(given.hicn)) = result.hicn""")
    return given


def _repeated_persons() -> str:
    """Second rows are persons of their own with the diagnoses of the first, marked by '#'."""
    marked = "select hicn || '#' as hicn, {columns} from ({rows}) m"
    second = marked.format(columns="dob, sex, orec, medicaid, model",
                           rows=fixtures.SECOND_ROWS.format(**_TABLES))
    lines = marked.format(columns="clm_thru_dt, diag, raps_riskeligible",
                          rows=fixtures.CLAIMS.format(**_TABLES))
    single = "select hicn, clm_thru_dt, diag, raps_riskeligible from ({}) c".format(
        fixtures.CLAIMS.format(**_TABLES))
    tables = [
        f"eligibility as ({fixtures.ELIGIBILITY.format(**_TABLES)} union all {second})",
        f"claims as ({single} union all {lines})",
        f"mapping as ({fixtures.MAPPING})",
    ]
    ctes = [_PERSONS, _DEMOGRAPHICS, _DIAGNOSES["v22"], _model("v22"), _score("v22")]
    return (f"with {', '.join([*tables, *ctes, f'result as ({_RESULT})'])}\n"
            "select replace(hicn, '#', '') as hicn, result.* exclude (hicn) from result")


def _both() -> str:
    queries = (
        f"select '{version}' as version, r.* exclude (lookup_key)"
        f" from ({_model_query(version, _RESULT, scored=True)}) r"
        for version in VERSIONS
    )
    return " union all ".join(queries)


def _explained(version: str) -> str:
    """Every variable before the hierarchies, what dropped it, and what it adds."""
    return """
select hicn, label as hcc, coalesce(by_name, '') as dropped_by,
 cast(cast(coef * 1000 as bigint) * 1000000 as double) / 1000000000 as coefficient,
 case when by_name is null and coef is not null
  then cast(cast(coef * 1000 as bigint) * 1000000 as double) / 1000000000 else 0 end as contribution
from (
 select hicn, label, null as by_name from variables
 union all
 select hicn, 'HCC' || lpad(cast(d.child as varchar), 3, '0'),
  string_agg('HCC' || lpad(cast(d.parent as varchar), 3, '0'), '|' order by d.parent)
 from before b join before c using (hicn) join drops d on d.parent = b.hcc and d.child = c.hcc
 group by hicn, d.child) found
join keyed using (hicn) join labels using (label) left join weights using (lookup_key, i)"""


def _version_queries(version: str) -> dict[str, str]:
    labelled = "'hcc' || lpad(cast(hcc as varchar), 3, '0')"
    hccs = [label.lower() for label in _hcc_labels(version)]
    parents = ", ".join(
        f"cast(coalesce(bool_or(hcc = {n}), false) as int) as cc_{n:02d}" for n in _parents(version)
    )
    snapshot = f"select hicn, {parents} from person left join before using (hicn) group by hicn"
    before = f"(select hicn, {labelled} as label from before)"
    assembled = f"""
select p.hicn, a.* exclude (hicn), s.* exclude (hicn), d.* exclude (hicn), i.* exclude (hicn),
 p.sex, p.dob, p.age, p.disabled, p.model, p.lookup_key,
 cast(case when p.orec = 1 and p.age <= 64 then 0 else p.orec end as int) as orec,
 cast(0 as double) as cms_risk_score
from keyed p
join (select hicn, {_flags(hccs)}
      from person left join {before} using (hicn) group by hicn) a using (hicn)
join ({snapshot}) s using (hicn)
join (select hicn, {_flags(_demographic_labels())}
      from person left join demographic using (hicn) group by hicn) d using (hicn)
join (select hicn, {_flags(_interaction_labels(version))}
      from person left join interaction using (hicn) group by hicn) i using (hicn)"""
    pivot = "select hicn, {flags} from person left join {rows} using (hicn) group by hicn"
    return {
        f"dx_to_hcc_{version}": _dx_query(version, """
select hicn, dx.diag, case when hcc between 0 and 999
  then 'HCC' || lpad(cast(hcc as varchar), 3, '0') end as hcc
from dx join mapping on dx.diag = mapping.diag where hcc is not null"""),
        f"hcc_flags_{version}": _model_query(
            version, pivot.format(flags=_flags(hccs), rows=before)),
        f"hierarchy_snapshot_{version}": _model_query(version, snapshot),
        f"interactions_{version}": _model_query(version, pivot.format(
            flags=_flags(_interaction_labels(version)), rows="interaction")),
        f"apply_hierarchies_{version}": _model_query(version, pivot.format(
            flags=_flags(hccs), rows=f"(select hicn, {labelled} as label from remaining)")),
        f"assemble_{version}": _model_query(version, assembled),
        f"risk_score_{version}": _model_query(
            version, "select hicn, lookup_key, cms_risk_score from scored", scored=True),
        f"bene_score_{version}": _model_query(
            version, "select hicn, cms_risk_score from scored", scored=True),
        f"bene_hcc_{version}": _model_query(
            version, "select hicn, label as hcc from variables"),
        f"bene_hcc_explained_{version}": _model_query(version, _explained(version), scored=True),
        f"run_{version}": _model_query(version, _RESULT, scored=True),
    }


def oracle_sql() -> dict[str, str]:
    bands = _flags(_band_labels())
    originally = _flags(["originallydisabled_female", "originallydisabled_male"])
    shared = {
        "eds_physician": _claim_query("select clm_cntl_num from physician"),
        "eds_inpatient": _claim_query("select clm_cntl_num from inpatient"),
        "eds_outpatient": _claim_query("select clm_cntl_num from outpatient"),
        "eds_all": _claim_query("select clm_cntl_num from eds_all"),
        "eds_lists_of_years": _flags_query(
            ["claim_lines", "cpt_list"],
            years="extract(year from l.clm_thru_dt) in (2016, 2018, 2019)"),
        "eds_lists_edited": _flags_query(
            ["claim_lines", "cpt_list"], types="'4000'", inpatient="'12'",
            outpatient="'77', '13', '99'"),
        "eds_lists_mixed_bill": _flags_query(
            ["claim_lines_mixed_bill", "cpt_list"], lines="claim_lines_mixed_bill",
            tob="coalesce(nullif(rtrim(clm_fac_type_cd || clm_srvc_clsfctn_type_cd), ''),"
                " substr(type_of_bill, 1, 2))"),
        "run_v22_mixed_case": _mixed_case(),
        "run_v22_repeated_persons": _repeated_persons(),
        "run_v22_null_coefficient": _raised(
            _model_query("v22", _RESULT, scored=True),
            {"join weights using (lookup_key, i)":
             "join weights using (lookup_key, i) where lookup_key <> 'CN0'"}),
        "run_v22_from_rules": _model_query("v22", _RESULT, scored=True),
        "run_both": _both(),
        "result_tables_v22": _model_query("v22", """
select hicn, cms_risk_score, n_variables, first_variable
from scored left join (
 select hicn, count(*) as n_variables, min(label) as first_variable from variables group by hicn)
using (hicn)""", scored=True),
        "eds_eligible_claims": _claim_query("select clm_cntl_num from eds_all"),
        "flag_eds_eligible": _query(["claims", "claim_lines", "cpt_list"], [_CLAIM_FILTERS], """
select c.*, case when e.clm_cntl_num is not null then 1 else 0 end as eds_riskeligible
from claims c left join eds_all e on c.clm_cntl_num = e.clm_cntl_num"""),
        "prepare_person": _person_query("select * from person"),
        "duplicate_hicn": f"""
select hicn, count(*) as row_count
from ({fixtures.ELIGIBILITY_PER_ORDER.format(**_TABLES)}) p
group by hicn having count(*) > 1""",
        "dual_status_class": _query(["dual_status"], [], """
select hicn, dual_status_cd, case when cast(dual_status_cd as int) in (1, 3, 5, 6) then 'partial'
 when cast(dual_status_cd as int) in (2, 4, 8, 10) then 'full' end as dual_status_class
from dual_status"""),
        "age_disabled": _person_query("select * from featured"),
        "orec_adjusted": _person_query("""
select *, case when orec = 1 and age <= 64 then 0 else orec end as orec_adjusted from featured"""),
        "demographic_bands": _person_query(
            f"select hicn, {bands} from person left join demographic using (hicn) group by hicn"),
        "originally_disabled": _person_query(
            f"select hicn, {originally} from person left join demographic using (hicn) "
            "group by hicn"),
        "lookup_key": _person_query("select * from keyed"),
        "run_v22_extra_dx": _model_query("v22", _RESULT, scored=True, further=True),
        "dx_raps_v22": _dx_query("v22", "select hicn, diag from dx"),
        "dx_eds_raps_v23": _dx_query("v23", "select hicn, diag from dx"),
    }
    for version in VERSIONS:
        shared |= _version_queries(version)
    return shared
