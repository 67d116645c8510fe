"""Segmentation rules: one Column in terms of others.

Arguments that come from the right side of a left join are NULL on unmatched
rows.  ``*matched`` arguments are boolean; NULL counts as unmatched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from segmill.functions.codes import (
    MISSING,
    MISSING_OR_NA,
    NOT_AVAILABLE,
    caret_fix,
    clean_code,
    is_missing,
)


def subgroup_id(related_org: Column, org: Column) -> Column:
    """Related organisation, or ``<org>~UNK`` where it is missing (NULL if org is NULL)."""
    return F.when(
        is_missing(related_org, MISSING_OR_NA), F.concat(org, F.lit("~UNK"))
    ).otherwise(related_org)


def group_plan_code(
    source: Column, product: Column, prefix_sources: Sequence[str] = ("823",), length: int = 3
) -> Column:
    """Product prefix for sources that number plans by prefix, else the whole product."""
    return F.when(
        source.isin(*prefix_sources), F.substring(product, 1, length)
    ).otherwise(product)


def plan_group_id(
    plan_matched: Column, plan_value: Column, product_matched: Column, product_value: Column
) -> Column:
    """Plan table first (as it is, NULL included), then the product's cleaned id, then NA."""
    return (
        F.when(plan_matched, plan_value)
        .when(product_matched, clean_code(product_value, MISSING_OR_NA, transform=caret_fix))
        .otherwise(F.lit(NOT_AVAILABLE))
    )


def plan_category(plan_matched: Column, plan_value: Column, own_value: Column) -> Column:
    """The plan table's category, else the row's own cleaned one."""
    return F.when(plan_matched, caret_fix(plan_value)).otherwise(
        clean_code(own_value, MISSING_OR_NA, transform=caret_fix)
    )


def network_id(value: Column) -> Column:
    return clean_code(value, MISSING_OR_NA, transform=caret_fix)


def service_type(
    dental_count: Column, vision_count: Column, plan_type: Column, product_type: Column
) -> Column:
    """DEN, VIS, plan type, product type or NA; a NULL count is not a hit."""
    fallback = F.coalesce(product_type, F.lit(NOT_AVAILABLE))
    raw = (
        F.when(dental_count != 0, F.lit("DEN"))
        .when(vision_count != 0, F.lit("VIS"))
        .when(is_missing(plan_type), fallback)
        .otherwise(F.upper(plan_type))
    )
    return clean_code(raw, null_is_missing=False)


def original_service_type(plan_type: Column, product_type: Column) -> Column:
    """As ``service_type`` without counts, but the *product* type decides.

    A missing product type, or a NULL plan type, selects the product type; a
    plan type that holds a sentinel is only replaced by the last cleaning.
    """
    fallback = F.coalesce(product_type, F.lit(NOT_AVAILABLE))
    by_product = is_missing(product_type, null_is_missing=False) | plan_type.isNull()
    raw = F.when(by_product, fallback).otherwise(F.upper(plan_type))
    return clean_code(raw, null_is_missing=False)


def plan_id(
    ref_matched: Column, package_id_ind: Column, package_nbr_ind: Column,
    package_id: Column, package_nbr: Column,
) -> Column:
    """Package number where the plan reference keys plans by number alone, else package id."""
    by_number = ref_matched & package_id_ind.isNull() & package_nbr_ind.isNotNull()
    return F.when(by_number, package_nbr).otherwise(package_id)


@dataclass(frozen=True)
class OverrideRule:
    """Fixed values of the pharmacy override flag."""

    flag: str = "Y"
    principal_type: str = "06"
    admin_sources: tuple[str, ...] = ("886", "868")
    restricted_admin: str = "LUM"
    restricted_products: tuple[str, ...] = ("PPONHSKMPVHA", "PPONSMKMPVHS")
    product_sources: tuple[str, ...] = ("867", "878")
    excluded_prefixes: tuple[str, ...] = ("HM", "RX")
    excluded_products: tuple[str, ...] = (
        "PPFS", "PPFT", "PPFU", "PPFV", "PPH3", "PPH4", "PPH5", "PPH6",
        "PPHA", "PPHB", "PPHD", "PPHE", "PPHP", "PPHR", "PPHS", "PPHT",
        "PPMC", "PPMI", "PPMM", "PPMS", "PPR3", "PPR4", "PPR5", "PPR6",
        "PPRA", "PPRB", "PPRD", "PPRE", "PPXE", "PPXF", "PPXG", "PPXH",
    )


def override_flag(
    flag: Column, product_matched: Column, principal_type: Column,
    source: Column, admin: Column, product: Column, rule: OverrideRule = OverrideRule(),
) -> Column:
    """Y where flag, product match, principal type and one of two source rules hold, else N.

    A NULL admin code or product leaves its source rule undecided, hence N.
    """
    by_admin = source.isin(*rule.admin_sources) & (
        (admin != rule.restricted_admin) | product.isin(*rule.restricted_products)
    ) & admin.isNotNull()
    by_product = source.isin(*rule.product_sources) & ~product.isin(*rule.excluded_products)
    for prefix in rule.excluded_prefixes:
        by_product = by_product & ~product.like(f"{prefix}%")
    common = (flag == rule.flag) & product_matched & (principal_type == rule.principal_type)
    return F.when(common & (by_admin | by_product), F.lit("Y")).otherwise(F.lit("N"))


def linked_org(matched: Column, link_type: Column, org: Column, wanted_type: str) -> Column:
    """Cleaned organisation of a link of the wanted type, else NA."""
    return F.when(
        matched & (F.trim(link_type) == wanted_type), caret_fix(org)
    ).otherwise(F.lit(NOT_AVAILABLE))


def funding_code(matched: Column, rollup: Column, default: str = "I") -> Column:
    return F.when(matched & rollup.isNotNull(), F.upper(rollup)).otherwise(F.lit(default))


def primary_coverage(
    month_code: Column, order: Column, other_primary: Sequence[str] = ("P", "PA")
) -> Column:
    """N unless another carrier is primary for the month and is not first in order."""
    # The sentinels are outside other_primary, so one test covers both.
    not_other = month_code.isNull() | ~month_code.isin(*other_primary)
    return F.when(not_other | (order == 1), F.lit("N")).otherwise(F.lit("Y"))


def medicare(
    insurance_type: Column, order: Column, types: Sequence[str] = ("MDCR", "MEDCR")
) -> Column:
    return F.when(insurance_type.isin(*types) & (order == 1), F.lit("Y")).otherwise(F.lit("N"))


def when_matched(matched: Column, value: Column, default: str = "N") -> Column:
    """The joined value, NULL included, on matched rows; the default on the others."""
    return F.when(matched, value).otherwise(F.lit(default))
