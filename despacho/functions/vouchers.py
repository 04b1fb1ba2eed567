"""Voucher prefixes, document types and associated vouchers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Voucher prefixes and the document codes the receiver expects.
INVOICED_PREFIXES = ("FA", "NC", "ND", "PE")
CREDIT_PREFIX = "NC"
DEBIT_PREFIXES = ("ND",)
ORDER_PREFIXES = ("FR", "FA", "PE")  # FR never passes INVOICED_PREFIXES
ORDER_PREFIXES_LEGACY = ("FA", "PE")
DEFAULT_CUSTOMER_TYPE = 8


def prefix(voucher: Column) -> Column:
    return F.left(voucher, F.lit(2))


def is_invoiced_kind(voucher: Column) -> Column:
    """Whether the prefix is a reported one, in a form that the parquet scan takes as a filter."""
    return reduce(or_, (voucher.startswith(p) for p in INVOICED_PREFIXES))


def document_type(net: Column, voucher: Column) -> Column:
    """OR / DE for a net that is not negative, by prefix; CR for all the rest, NULL net included."""
    return (
        F.when((net >= 0) & prefix(voucher).isin(*ORDER_PREFIXES), "OR")
        .when((net >= 0) & prefix(voucher).isin(*DEBIT_PREFIXES), "DE")
        .otherwise("CR")
    )


def document_type_legacy(net: Column, voucher: Column) -> Column:
    """As ``document_type`` with the older codes FC / ND / NC."""
    return (
        F.when((net >= 0) & prefix(voucher).isin(*ORDER_PREFIXES_LEGACY), "FC")
        .when((net >= 0) & prefix(voucher).isin(*DEBIT_PREFIXES), "ND")
        .otherwise("NC")
    )


def associated_voucher(voucher: Column, reference: Column) -> Column:
    """The reference of a credit note, '' for other vouchers; never NULL."""
    return F.coalesce(F.when(prefix(voucher) == CREDIT_PREFIX, reference), F.lit(""))


def associated_voucher_legacy(reference: Column) -> Column:
    """The reference where it is itself a credit note, else NULL."""
    return F.when(prefix(reference) == CREDIT_PREFIX, reference)


def customer_type_or_default(code: Column) -> Column:
    return F.coalesce(code, F.lit(DEFAULT_CUSTOMER_TYPE))
