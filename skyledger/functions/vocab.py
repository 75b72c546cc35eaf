"""Controlled vocabularies and the one operator that applies them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


@dataclass(frozen=True)
class Vocab:
    terms: dict[str, tuple[str, ...]]
    default: str | None = None  # None keeps the value itself

    def spellings(self) -> list[str]:
        return [word for words in self.terms.values() for word in words]


# Canonical term, then every accepted spelling.
BOOKING_CHANNEL = Vocab(
    {
        "MOBILE_APP": ("APP", "MOBILE", "MOBILE_APP"),
        "CALL_CENTER": ("CALLCENTER", "CALL_CENTER", "PHONE"),
        "AGENCY": ("AGENT", "AGENCY"),
    },
    "WEB",
)
CUSTOMER_SEGMENT = Vocab(
    {
        "BUSINESS": ("BUSINESS", "CORPORATE"),
        "LOYALTY": ("LOYAL", "LOYALTY"),
        "RETURNING": ("RETURNING", "REPEAT"),
    },
    "NEW",
)
_BOOKING_STATUS = {
    "CONFIRMED": ("CONFIRMED", "CONF", "BOOKED", "COMPLETE"),
    "CANCELLED": ("CANCELLED", "CANCELED", "VOID", "CNCL"),
    "PENDING": ("PENDING", "PEND", "IN_PROGRESS", "AWAITING_PAYMENT"),
}
BOOKING_STATUS = Vocab(_BOOKING_STATUS, "PENDING")
BOOKING_STATUS_FEATURE = Vocab(_BOOKING_STATUS, None)
PAYMENT_STATUS = Vocab(
    {
        "PAID": ("PAID", "SUCCESS", "SETTLED"),
        "FAILED": ("FAILED", "DECLINED", "ERROR", "FAIL"),
        "REFUNDED": ("REFUNDED", "REFUND", "CHARGEBACK"),
    },
    "FAILED",
)
PAYMENT_METHOD = Vocab(
    {
        "CREDIT_CARD": ("CREDIT_CARD", "CC", "VISA", "MASTERCARD"),
        "DEBIT_CARD": ("DEBIT_CARD", "DC"),
        "PAYPAL": ("PAYPAL", "PAY_PAL"),
        "BANK_TRANSFER": ("BANK_TRANSFER", "TRANSFER"),
    },
    "UNKNOWN",
)
BOOKING_EVENT_TYPE = Vocab(
    {
        "BOOKING_CREATED": ("CONFIRMED",),
        "BOOKING_CANCELLED": ("CANCELLED",),
        "BOOKING_UPDATED": ("PENDING",),
    },
    "BOOKING_UPDATED",
)
PAYMENT_EVENT_TYPE = Vocab(
    {
        "PAYMENT_CAPTURED": ("PAID",),
        "PAYMENT_FAILED": ("FAILED",),
        "PAYMENT_REFUNDED": ("REFUNDED",),
    },
    "PAYMENT_UPDATED",
)


def map_vocab(c: Column | str, vocab: Vocab) -> Column:
    """Canonical term of an already normalised token."""
    value = _col(c)
    out = None
    for term, words in vocab.terms.items():
        hit = value.isin(list(words))
        out = F.when(hit, term) if out is None else out.when(hit, term)
    return out.otherwise(value if vocab.default is None else F.lit(vocab.default))
