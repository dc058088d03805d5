"""Declarative data-quality rules compiled to Column expressions.

A rule set is one filter plus one projection, whatever its length, so a cleansed
scan stays a single code-generated stage with no Python in it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and the date shape the sales data must satisfy.
ORDER_ID = r"^[A-Z]{2}-\d{4}-\d{6}$"
CUSTOMER_ID = r"^[A-Z]{2}-\d{5}$"
PRODUCT_ID = r"^[A-Z]{3}-[A-Z]{2}-\d{8}$"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^(?:\+1\s?)?(\(?\d{3}\)?[\s.-]?)\d{3}[\s.-]?\d{4}$"
POSTAL_CODE = r"^\d{5}(-\d{4})?$"
NOT_IN_CUSTOMER_NAME = r"[^a-zA-Z\s]"
NOT_IN_PRODUCT_NAME = r"[^\x00-\x7F]+"
DATE_SHAPE = r"^\d{2}/\d{2}/\d{4}$"
DATE_FORMAT = "dd/MM/yyyy"

# Opt-in pair that also takes one-digit days and months.
RELAXED_DATE_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4}$"
RELAXED_DATE_FORMAT = "d/M/yyyy"


@dataclass(frozen=True)
class RequireMatch:
    """Keep only rows whose column matches; a NULL drops the row."""

    column: str
    pattern: str

    @property
    def name(self) -> str:
        return f"{self.column} does not match"

    def predicate(self) -> Column:
        return F.col(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class Strip:
    """Delete every match of the pattern."""

    column: str
    pattern: str

    def value(self) -> Column:
        return F.regexp_replace(self.column, self.pattern, "")


@dataclass(frozen=True)
class NullUnlessMatch:
    """Keep the value if it matches, else NULL."""

    column: str
    pattern: str

    def value(self) -> Column:
        return F.when(F.col(self.column).rlike(self.pattern), F.col(self.column))


@dataclass(frozen=True)
class ParseDate:
    """Text to date if it has the shape and is a real day, else NULL."""

    column: str
    format: str = DATE_FORMAT
    shape: str = DATE_SHAPE

    def value(self) -> Column:
        return F.when(
            F.col(self.column).rlike(self.shape), F.try_to_date(self.column, self.format)
        )


Rule = RequireMatch | Strip | NullUnlessMatch | ParseDate


def order_rules(
    date_format: str = DATE_FORMAT,
    date_shape: str = DATE_SHAPE,
    *,
    customer_id: str = CUSTOMER_ID,
    product_id: str = PRODUCT_ID,
) -> tuple[Rule, ...]:
    """Rules for raw orders, for files with dates or ids of another form."""
    return (
        RequireMatch("order_id", ORDER_ID),
        RequireMatch("customer_id", customer_id),
        RequireMatch("product_id", product_id),
        ParseDate("order_date", date_format, date_shape),
        ParseDate("ship_date", date_format, date_shape),
    )


def customer_rules(customer_id: str = CUSTOMER_ID) -> tuple[Rule, ...]:
    """Rules for raw customers."""
    return (
        RequireMatch("customer_id", customer_id),
        Strip("customer_name", NOT_IN_CUSTOMER_NAME),
        NullUnlessMatch("email", EMAIL),
        NullUnlessMatch("phone", PHONE),
        NullUnlessMatch("postal_code", POSTAL_CODE),
    )


def product_rules(product_id: str = PRODUCT_ID) -> tuple[Rule, ...]:
    """Rules for raw products."""
    return (
        RequireMatch("product_id", product_id),
        Strip("product_name", NOT_IN_PRODUCT_NAME),
    )


RULES = MappingProxyType(
    {
        "raw_orders": order_rules(),
        "raw_customers": customer_rules(),
        "raw_products": product_rules(),
    }
)


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Filter by the match rules, then rewrite the cleansed columns in place."""
    rules = tuple(rules)
    required = [rule.predicate() for rule in rules if isinstance(rule, RequireMatch)]
    rewrites = [rule for rule in rules if not isinstance(rule, RequireMatch)]
    values = {rule.column: rule.value() for rule in rewrites}
    if len(values) < len(rewrites):
        raise ValueError("more than one rewriting rule for a column")
    if required:
        df = df.filter(reduce(and_, required))
    return df.withColumns(values) if values else df


#: Columns of judged rows: the names of the rules a row failed, and whether it failed none.
FAILED, ACCEPTED = "failed_rules", "accepted"
_CLEAN = "clean_"


def judge_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """All rows, each with the match rules it failed, and its cleansed values beside its own.

    Written by `accepted`, one pass over the rows gives both what `accepted_rows` and what
    `rejected_rows` read. A NULL fails a match rule, as in `apply_rules`.
    """
    rules = tuple(rules)
    required = [rule for rule in rules if isinstance(rule, RequireMatch)]
    rewrites = [rule for rule in rules if not isinstance(rule, RequireMatch)]
    if len({rule.column for rule in rewrites}) < len(rewrites):
        raise ValueError("more than one rewriting rule for a column")
    failed = F.array_compact(
        F.array(*(
            F.when(~F.coalesce(rule.predicate(), F.lit(False)), F.lit(rule.name))
            for rule in required
        ))
    ) if required else F.array().cast("array<string>")
    return (
        df.select("*", failed.alias(FAILED), *(
            rule.value().alias(_CLEAN + rule.column) for rule in rewrites
        ))
        .withColumn(ACCEPTED, F.size(FAILED) == 0)
    )


def accepted_rows(judged: DataFrame) -> DataFrame:
    """What `apply_rules` keeps, from judged rows."""
    names = [c for c in judged.columns if c not in (FAILED, ACCEPTED)]
    rewritten = {c.removeprefix(_CLEAN) for c in names if c.startswith(_CLEAN)}
    return judged.filter(ACCEPTED).select(
        *(F.col(_CLEAN + c).alias(c) if c in rewritten else F.col(c)
          for c in names if not c.startswith(_CLEAN))
    )


def rejected_rows(judged: DataFrame) -> DataFrame:
    """The rows that failed a rule, as they came, with the names of all rules they failed."""
    names = [c for c in judged.columns if c != ACCEPTED and not c.startswith(_CLEAN)]
    return judged.filter(~F.col(ACCEPTED)).select(*names)


def rules_for(table: str, rules: Iterable[Rule] | None = None) -> tuple[Rule, ...]:
    """The given rules, or those registered for `table`."""
    if rules is None:
        if table not in RULES:
            raise ValueError(f"no quality rules for '{table}'; known: {', '.join(RULES)}")
        rules = RULES[table]
    return tuple(rules)


def cleanse(df: DataFrame, table: str, rules: Iterable[Rule] | None = None) -> DataFrame:
    """Apply the rule set registered for `table`, or the given one."""
    return apply_rules(df, rules_for(table, rules))
