"""Declared schemas of landed documents, as DDL. Nothing is inferred."""

from __future__ import annotations

# Landed documents -----------------------------------------------------------

FRED_DOC = "observations ARRAY<STRUCT<date: STRING, value: STRING>>"

_BEA_RECORD = "STRUCT<LineNumber: STRING, TimePeriod: STRING, DataValue: STRING, LineDescription: STRING, METRIC_NAME: STRING>"
# One schema for the API answer (wrapped, may carry an Error) and for the archived form (bare).
# Error is text, so that whatever shape it has is kept as its JSON.
BEA_DOC = (
    f"BEAAPI STRUCT<Results: STRUCT<Data: ARRAY<{_BEA_RECORD}>, Error: STRING>>, "
    f"table_key STRING, data ARRAY<{_BEA_RECORD}>"
)

_BLS_POINT = (
    "STRUCT<year: STRING, period: STRING, periodName: STRING, value: STRING, footnotes: ARRAY<STRUCT<code: STRING>>>"
)
_BLS_SERIES = f"ARRAY<STRUCT<seriesID: STRING, data: ARRAY<{_BLS_POINT}>>>"
BLS_DOC = (
    f"status STRING, message ARRAY<STRING>, Results STRUCT<series: {_BLS_SERIES}>, "
    f"series {_BLS_SERIES}, start_year INT, end_year INT"
)
