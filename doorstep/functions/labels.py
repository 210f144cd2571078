"""Buckets, flags and relabelling."""

from pyspark.sql import Column, functions as F

from doorstep.schema import (
    HIGH_RISK_ADDRESSES,
    MORNING,
    TERMINAL_STATUSES,
    VALUE_CEILING,
    VALUE_EDGES,
    VALUE_LABELS,
    VALUE_LABELS_RS,
)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return repr(value) if isinstance(value, int) else "'" + value.replace("'", "\\'") + "'"


def lookup(column: str, values: dict, default=None) -> Column:
    """The entry of a small fixed table for each value of ``column``."""
    arms = " ".join(f"WHEN {_literal(key)} THEN {_literal(v)}" for key, v in values.items())
    return F.expr(f"CASE {column} {arms} ELSE {_literal(default)} END")


def _left_closed(value: Column, labels: list[str]) -> Column:
    """Label of the first edge above ``value``; the last label takes the rest, NULL included."""
    arms = [F.when(value < edge, label) for edge, label in zip(VALUE_EDGES, labels)]
    return F.coalesce(*arms, F.lit(labels[-1]))


def value_bucket_labels(value: str = "order_value") -> Column:
    return _left_closed(F.col(value), VALUE_LABELS)


def value_bucket_labels_rs(value: str = "order_value") -> Column:
    return _left_closed(F.col(value), VALUE_LABELS_RS)


def value_bucket_code_sql(value: str = "order_value") -> str:
    """Right-closed code ``(0, 500] -> 0 .. (3000, 10000] -> 3`` as SQL; NULL outside that range.

    Text rather than a Column because the feature pipeline persists it in a SQLTransformer.
    """
    upper = [*VALUE_EDGES, VALUE_CEILING]
    arms = " ".join(f"WHEN {value} <= {edge} THEN {code}" for code, edge in enumerate(upper))
    return f"CASE WHEN {value} <= 0 THEN NULL {arms} END"


def value_bucket_code(value: str = "order_value") -> Column:
    return F.expr(value_bucket_code_sql(value))


def high_risk_flag(
    address: str = "address_type",
    window: str = "delivery_window",
    preference: str = "has_delivery_preference",
) -> Column:
    """1 for a flat or hostel, in the morning, with no preference on file."""
    risky_place = F.col(address).isin(HIGH_RISK_ADDRESSES)
    return (risky_place & (F.col(window) == MORNING) & (F.col(preference) == 0)).cast("int")


def flag_label(flag: str, labels: tuple[str, str]) -> Column:
    """Text for a 0/1 flag, given as (label of 0, label of 1)."""
    return F.when(F.col(flag) == 0, labels[0]).when(F.col(flag) == 1, labels[1])


def is_terminal(status: str = "status") -> Column:
    return F.col(status).isin(TERMINAL_STATUSES)


def status_class(status: str = "status") -> Column:
    return (
        F.when(F.col(status) == "DELIVERED", "success")
        .when(is_terminal(status), "unsuccessful")
        .otherwise("in progress")
    )
