"""Date and amount of a gift as one whole number that sorts like the pair, unknown values first.

A minimum or maximum of such numbers stays a hash aggregate, where a pair would need all gifts sorted
first. Exact for amounts of decimal(19,4) and dates up to the year 70,000; beyond, Spark reports an
overflow.
"""

from __future__ import annotations

# Places for dates (microseconds, moved above zero) and amounts (ten-thousandths, likewise); 0 is unknown.
DATE_ZERO = 3 * 10**17
DATE_SPAN = 4 * 10**18
AMOUNT_ZERO = 10**19 + 1
AMOUNT_SPAN = 4 * 10**19


def _date_place(when: str) -> str:
    days = f"unix_date(CAST({when} AS DATE)) * 86400000000L"
    time = f"hour({when}) * 3600000000L + minute({when}) * 60000000L"
    seconds = f"CAST(extract(SECOND FROM {when}) * 1000000 AS BIGINT)"
    return f"CAST(coalesce({days} + {time} + {seconds} + {DATE_ZERO}L, 0L) AS DECIMAL(19,0))"


def _amount_place(amount: str) -> str:
    return f"coalesce(CAST({amount} * 10000 AS DECIMAL(20,0)) + {AMOUNT_ZERO}BD, 0BD)"


def date_amount_key(when: str, amount: str) -> str:
    """Sorts by date, then amount."""
    return f"CAST({_date_place(when)} * {AMOUNT_SPAN}BD + {_amount_place(amount)} AS DECIMAL(38,0))"


def amount_date_key(amount: str, when: str) -> str:
    """Sorts by amount, then date."""
    return f"CAST({_amount_place(amount)} * {DATE_SPAN}BD + {_date_place(when)} AS DECIMAL(38,0))"


def _date_at(place: str) -> str:
    seconds = f"CAST(({place} - {DATE_ZERO}BD) * 0.000001BD AS DECIMAL(18,6))"
    moved = f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    return f"CASE WHEN {place} <> 0 THEN {moved} END"


def date_of_date_key(key: str) -> str:
    return _date_at(f"CAST({key} DIV {AMOUNT_SPAN}BD AS DECIMAL(19,0))")


def amount_of_date_key(key: str) -> str:
    place = f"CAST({key} % {AMOUNT_SPAN}BD AS DECIMAL(20,0))"
    value = f"CAST(({place} - {AMOUNT_ZERO}BD) * 0.0001BD AS DECIMAL(19,4))"
    return f"CASE WHEN {place} <> 0 THEN {value} END"


def date_of_amount_key(key: str) -> str:
    return _date_at(f"CAST({key} % {DATE_SPAN}BD AS DECIMAL(19,0))")
