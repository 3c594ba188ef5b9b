"""Reserved values of the warehouse."""

# Results must carry exactly these.
NA_ID = -99
NA_TEXT = "NA_GDW"
ERROR_ID = 0
ERROR_TEXT = "NA_ERR"
NULL_DATE_ID = "0"
UNKNOWN_DATE = "1900-12-31 00:00:00"
DIM_OPEN_END = "9999-12-31 23:59:59"
FACT_OPEN_END = "9999-12-31 11:59:59"
ACTIVE = "A"
INACTIVE = "I"
TEXT_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
DATE_ID_FORMAT = "yyyyMMdd"
RECORD_ERROR = "ERROR"
RECORD_RESOLVED = "RESOLVED"
RECORD_SUPERSEDED = "SUPERSEDED"
