"""Run parameters of the daily batch.

The source statements read the wall clock (``CURRENT_DATE()``) both to decide
which policies are in force and to stamp ``LAST_MODIFIED_DATE``.  A batch that
is re-run, or checked against an oracle, needs that date as an explicit
parameter; ``RunParams.as_of`` is it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values of the published datasets (must equal the source statements):
#   source tag of the subsidiary          : INS
#   constant creation stamp of every row  : 2024-08-16
#   parameter id of the industry risk map : RISK_INDUSTRY_TYPE
#   in-force policy status                : 7
#   identification type of a corporation  : 4
#   identification types of persons       : 1, 2, 3
SOURCE_TAG = "INS"
CREATE_DATE = dt.date(2024, 8, 16)
INDUSTRY_RISK_PARAM = "RISK_INDUSTRY_TYPE"
POLICY_IN_FORCE = "7"
CORPORATE_ID_TYPES = ("4",)
NATURAL_ID_TYPES = ("1", "2", "3")

# Business date of the fixture tables (orders run 1995-01-01 .. 2001-08-01).
FIXTURE_AS_OF = dt.date(2001, 6, 1)


@dataclass(frozen=True)
class RunParams:
    """Business date and constants of one run."""

    as_of: dt.date  # no default: a run without a business date is a mistake
    create_date: dt.date = CREATE_DATE
    source_tag: str = SOURCE_TAG
    policy_status: str = POLICY_IN_FORCE
    industry_param: str = INDUSTRY_RISK_PARAM


# Only for the fixture tables (registered queries, bench, tests).
FIXTURE_PARAMS = RunParams(as_of=FIXTURE_AS_OF)
