"""Schemas of fetched pages, half records and event records.

A missing value is always NULL inside the engine. The text markers of the published records
(empty text or ``N/A``) are put in only by ``operators.records.conform``.
"""

from __future__ import annotations

from pyspark.sql import types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("page_kind", T.StringType()),  # list, detail or fee
        T.StructField("lang", T.StringType()),  # en or zh
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

# What one page can say about an event. A half record is one page's contribution; the record of an
# event is its first page's half overlaid with its second page's half.
HALF_FIELDS = {
    "event_name_eng": "string",
    "event_name_chi": "string",
    "start_date": "date",
    "end_date": "date",
    "dates": "array<date>",
    "fetch_date": "timestamp",
    "description_eng": "string",
    "description_chi": "string",
    "event_type_eng": "string",
    "event_type_chi": "string",
    "location_eng": "string",
    "location_chi": "string",
    "fee": "string",
    "organiser_eng": "string",
    "organiser_chi": "string",
    "link_eng": "string",
    "link_chi": "string",
    "extract_ok": "boolean",
}

DATE_FIELDS = ("start_date", "end_date", "dates")

# Text fields of the record, in the order of publication.
TEXT_FIELDS = (
    "event_name_eng",
    "event_name_chi",
    "description_eng",
    "description_chi",
    "event_type_eng",
    "event_type_chi",
    "location_eng",
    "location_chi",
    "fee",
    "organiser_eng",
    "organiser_chi",
    "link_eng",
    "link_chi",
)

EVENT_COLUMNS = (
    "event_id",
    "event_name_eng",
    "event_name_chi",
    "start_date",
    "end_date",
    "dates",
    "fetch_date",
    "description_eng",
    "description_chi",
    "event_type_eng",
    "event_type_chi",
    "location_eng",
    "location_chi",
    "fee",
    "fee_amount",
    "organiser_eng",
    "organiser_chi",
    "link_eng",
    "link_chi",
    "extract_ok",
    "source",
)
