"""Code maps of the published datasets.

Every map is a simple ``CASE x WHEN k THEN v ... ELSE x`` in the source
statements: unmapped codes pass through unchanged (``map_code``), or fall
to a constant default (``map_code(..., default=...)``).  The maps compile
to a chain of ``CASE WHEN`` inside whole-stage codegen -- no UDF, no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source statements; do not edit)
# ---------------------------------------------------------------------------

# job title code -> title text
JOB_TITLES: dict[str, str] = {
    "T010": "一般職員",
    "T020": "單位主管(不含財務單位)",
    "T030": "協理",
    "T040": "副總經理",
    "T050": "企業負責人",
    "T060": "董事、監察人",
    "T070": "財務主管(含外國企業在本地所設分公司之財務主管)",
    "T080": "總經理/執行長(含外國企業在本地所設分公司之General Manager)",
    "T090": "有權代表公司簽章人員",
    "T100": "院長",
    "T110": "校長",
}

# pay source code -> source text
PAY_SOURCES: dict[str, str] = {
    "1": "工作/營業收入",
    "2": "投資/業外收入",
    "3": "退休收入",
    "4": "貸款",
    "5": "解除或終止契約",
    "6": "保單借款",
    "7": "存款",
}

# customer risk level -> rating
CUSTOMER_RISK: dict[str, str] = {"00": "1", "30": "3"}

# industry risk (lookup DATA1) -> rating
INDUSTRY_RISK: dict[str, str] = {"00": "1", "30": "3"}

# country risk level -> rating ('40' passes through unchanged, as in the source)
COUNTRY_RISK: dict[str, str] = {"10": "1", "20": "2", "25": "2", "30": "3", "90": "4"}

# identification type -> ID_TYPE (anything else -> '3')
ID_TYPES: dict[str, str] = {"1": "1", "2": "2"}
ID_TYPE_DEFAULT = "3"

# sex -> GENDER (anything else, NULL included -> '3')
GENDERS: dict[str, str] = {"M": "1", "F": "2"}
GENDER_DEFAULT = "3"

# relation types of the related-party datasets
REL_AGENT = 1
REL_REPRESENTATIVE = 2
REL_RESPONSIBLE = 3
REL_INSURED_NATURAL = 4
REL_BENEFICIARY_NATURAL = 5
REL_INSURED_CORPORATE = 8
REL_BENEFICIARY_CORPORATE = 9

# contact types of the contact datasets
CONTACT_ADDRESS_MAIN = "1"
CONTACT_ADDRESS_MAIL = "2"
CONTACT_PHONE1 = "3"
CONTACT_PHONE2 = "4"
CONTACT_MOBILE = "5"
CONTACT_EMAIL = "6"

# ---------------------------------------------------------------------------


def map_code(col: Column, mapping: dict[str, str], default: Column | str | None = None
             ) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END``; default = ``col`` itself.

    A NULL input matches no key and yields the default (``col`` -> NULL).
    """
    expr = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    other = col if default is None else (F.lit(default) if isinstance(default, str) else default)
    if expr is None:
        return other
    return expr.otherwise(other)


def job_title(col: Column) -> Column:
    return map_code(col, JOB_TITLES)


def pay_source_text(col: Column) -> Column:
    return map_code(col, PAY_SOURCES)


def customer_risk(col: Column) -> Column:
    return map_code(col, CUSTOMER_RISK)


def industry_risk(col: Column) -> Column:
    return map_code(col, INDUSTRY_RISK)


def country_risk(col: Column) -> Column:
    return map_code(col, COUNTRY_RISK)


def id_type(col: Column) -> Column:
    return map_code(col, ID_TYPES, ID_TYPE_DEFAULT)


def gender(col: Column) -> Column:
    return map_code(col, GENDERS, GENDER_DEFAULT)

