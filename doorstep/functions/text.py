"""Text, date and JSON helpers."""

from pyspark.sql import Column, functions as F, types as T

from doorstep.schema import EVENT_TIME_FORMAT, STATUS_UPDATE


def window_start_hour(window: str = "delivery_window") -> Column:
    """First hour of a window label such as ``Morning (9-12)``; NULL when there is none."""
    return F.regexp_extract(window, r"\((\d+)-", 1).try_cast("int")


def id_prefix(column: str, length: int = 8) -> Column:
    return F.substring(column, 1, length)


def date_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def days_before(column: str, days: int) -> Column:
    return F.date_sub(column, days)


def one_decimal(column: str) -> Column:
    return F.round(column, 1)


def ingest_stamp() -> Column:
    """Wall clock of the batch or micro-batch that reads the row."""
    return F.current_timestamp()


def json_text(*columns: str | Column) -> Column:
    """Row as one JSON object; timestamps keep their microseconds and carry no zone."""
    return F.to_json(F.struct(*columns), {"timestampFormat": EVENT_TIME_FORMAT})


def json_fields(value: str, schema: T.StructType, corrupt: str) -> Column:
    """Parsed JSON object, with the raw text kept in ``corrupt`` when it does not fit ``schema``."""
    open_schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return F.from_json(value, open_schema, {"columnNameOfCorruptRecord": corrupt})


def status_update_payload(
    delivery_id: str = "delivery_id",
    reason: str = "failure_reason",
    attempt: str = "attempt_number",
    partner_id: str = "customer_id",
    status: str = "FAILED",
) -> Column:
    """JSON body that reports one attempt's outcome back to the partner platform."""
    values = [F.col(delivery_id), F.lit(status), F.col(reason), F.col(attempt), F.col(partner_id)]
    return json_text(*[v.alias(f.name) for v, f in zip(values, STATUS_UPDATE)])
