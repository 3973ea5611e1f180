"""Rules, maps and lists that steer the operators. No business value lives in operator code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RegionRules:
    """Country lists folded into a region; ``standalone`` countries are their own region."""

    groups: Mapping[str, Sequence[str]]
    standalone: Sequence[str] = ()
    other: str = "Other"

    def region(self, country: Column) -> Column:
        chain = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, countries in self.groups.items():
            chain = chain.when(country.isin(list(countries)), name)
        return chain.when(country.isin(list(self.standalone)), country).otherwise(self.other)


# The country names, in warehouse spelling, that make up the LATAM region.
LATAM_COUNTRIES = (
    "Argentina", "Brazil", "Chile", "Colombia", "Mexico", "Peru", "Anguilla",
    "Antigua And Barbuda", "Aruba", "Bahamas", "Barbados", "Belize", "Bermuda", "Bolivia",
    "Bonaire", "Cayman Islands", "Costa Rica", "Curacao", "Dominica", "Dominican Republic",
    "Ecuador", "El Salvador", "Falkland Islands (Malvinas)", "French Guiana", "Grenada",
    "Guadeloupe", "Guatemala", "Guyana", "Haiti", "Honduras", "Jamaica", "Martinique",
    "Montserrat", "Netherlands Antilles", "Nicaragua", "Panama", "Paraguay", "Puerto Rico",
    "Saint Barthlemy", "Saint Kitts And Nevis", "Saint Lucia", "Saint Martin (French Part)",
    "Saint Vincent and the Grenadines", "Sint Maarten (Dutch Part)",
    "South Georgia And The South Sandwich Islands", "Suriname", "Trinidad And Tobago",
    "Turks And Caicos Islands", "Uruguay", "Venezuela", "Virgin Islands",
)

DEFAULT_REGIONS = RegionRules(groups={"LATAM": LATAM_COUNTRIES}, standalone=("Canada",))


def exclude_firms(firm: Column, firms: Sequence) -> Column | None:
    """Predicate keeping firms outside the list, or None when the list is empty.

    SQL three-valued logic on purpose: with a non-empty list a NULL firm is not kept.
    """
    return ~firm.isin(list(firms)) if firms else None


def literal(value: str | int | float) -> str:
    """A configuration value as a SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


@dataclass(frozen=True)
class TagRule:
    """Conditions, all of which a sales event must meet to carry ``tag``; None means any value."""

    tag: str
    event_type: str | None = None
    offering: str | None = None
    category: str | None = None
    product: str | None = None
    product_not: str | None = None
    offer_contains: tuple[str, ...] = ()
    offer_contains_any_case: tuple[str, ...] = ()
    keep_excluded_firms: bool = True

    def condition(self, excluded_firms: Sequence = ()) -> str:
        """The rule as SQL text over the booking columns."""
        terms = [f"{name} = {literal(value)}"
                 for name in ("event_type", "offering", "category", "product")
                 if (value := getattr(self, name)) is not None]
        if self.product_not is not None:
            terms.append(f"product <> {literal(self.product_not)}")
        terms += [f"contains(offer_name, {literal(s)})" for s in self.offer_contains]
        terms += [f"contains(lower(offer_name), {literal(s.lower())})"
                  for s in self.offer_contains_any_case]
        if not self.keep_excluded_firms and excluded_firms:
            terms.append(f"firm_id NOT IN ({', '.join(map(literal, excluded_firms))})")
        if not terms:
            raise ValueError(f"rule {self.tag} has no condition")
        return f"({' AND '.join(terms)})"

    def predicate(self, excluded_firms: Sequence = ()) -> Column:
        return F.expr(self.condition(excluded_firms))

    def covers(self, other: TagRule) -> bool:
        """True when every row ``other`` matches is certainly matched by this rule as well."""
        def free_or_same(name: str) -> bool:
            return getattr(self, name) in (None, getattr(other, name))

        product_ok = (free_or_same("product_not")
                      or other.product not in (None, self.product_not))
        return (all(map(free_or_same, ("event_type", "offering", "category", "product")))
                and product_ok
                and set(self.offer_contains) <= set(other.offer_contains)
                and set(self.offer_contains_any_case) <= set(other.offer_contains_any_case)
                and (self.keep_excluded_firms or not other.keep_excluded_firms))


def broadest(rules: Sequence[TagRule]) -> list[TagRule]:
    """The rules no other rule covers: together they match the same rows as all of them."""
    kept: list[TagRule] = []
    for i, rule in enumerate(rules):
        if not any(other.covers(rule) and not (rule.covers(other) and j > i)
                   for j, other in enumerate(rules) if j != i):
            kept.append(rule)
    return kept


@dataclass(frozen=True)
class CancelRules:
    """Which accounts count as cancelled; compare ``operators.owners.cancel_eligibility``."""

    countries: Sequence[str]
    super_channel: str
    channels: Sequence[str]
    excluded_subscription: str = "Trial"


@dataclass(frozen=True)
class OwnerRules:
    """How owner names become team labels."""

    division_teams: Mapping[str, str]
    segment_teams: Mapping[str, str]
    overrides: Mapping[str, str] = field(default_factory=dict)
    # Substrings that mark an owner as a service account.
    system_markers: Sequence[str] = ("integration", "placeholder")
    unmanaged: str = "Unmanaged"
    drop: str = "DROP"


@dataclass(frozen=True)
class MotionRules:
    """Inputs of the run-rate versus agent-added split."""

    direct_division: str
    agent_offer_ids: Sequence[str]
    agent_category: str = "AGENT"
    run_rate: str = "Runrate"
    agent_added: str = "Agent Added"


@dataclass(frozen=True)
class ProductRules:
    """Product names and families behind the 0/1 product flags."""

    advanced_product: str
    core_family: str
    payroll_families: Sequence[str]
    payroll_family_recent: str


@dataclass(frozen=True)
class OpportunityRules:
    # Stage names of the opportunity source, and the word in the names of lines that
    # are no sale of their own.
    won_stage: str = "Closed Won"
    closed_stages: Sequence[str] = ("Closed Won", "Closed Lost")
    late_stages: Sequence[str] = ("Commit", "Value")
    excluded_name_part: str = "upgrade"
    # Ordered (regular expression, group); the NULL-name group sits before ``after_null``.
    groups: Sequence[tuple[str, str]] = ()
    groups_after_null: Sequence[tuple[str, str]] = ()
    no_line: str = "No Product Line"
    default_group: str = "Core"
