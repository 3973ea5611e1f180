"""Tagging by an index over the rules, for rule lists of any length.

``events.multi_rule_tag`` asks every rule of every row. Most rules begin with equalities, so here
the rules are grouped by which fields they fix, and within a group by the values; a row looks up its
own values once per group, and only the rules found there are asked for the rest of their
conditions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalweave.config import TagRule

FIELDS = ("event_type", "offering", "category", "product")
_REST = ("array<struct<tag:string,product_not:string,contains:array<string>,"
         "any_case:array<string>,open:boolean>>")


def fixed_fields(rule: TagRule) -> tuple[str, ...]:
    return tuple(f for f in FIELDS if getattr(rule, f) is not None)


def _rest(rule: TagRule) -> tuple:
    """What is left to ask of a row that has the rule's fixed values."""
    return (rule.tag, rule.product_not, list(rule.offer_contains),
            [s.lower() for s in rule.offer_contains_any_case], rule.keep_excluded_firms)


def index(df: DataFrame, rules: Sequence[TagRule]) -> list[tuple[tuple[str, ...], DataFrame]]:
    """(fixed fields, table of their values and the rules that have them) for each group of rules.

    The tables hold the configured rules and nothing else.
    """
    groups: dict[tuple[str, ...], dict[tuple, list[tuple]]] = {}
    for rule in rules:
        rule.condition()  # an error for a rule without a condition
        fields = fixed_fields(rule)
        values = tuple(str(getattr(rule, f)) for f in fields)
        groups.setdefault(fields, {}).setdefault(values, []).append(_rest(rule))
    spark = df.sparkSession
    return [(fields, spark.createDataFrame(
        [(*values, rest) for values, rest in by.items()],
        ", ".join([*(f"{f} string" for f in fields), f"rules {_REST}"])))
        for fields, by in groups.items()]


def _holds(rule: Column, excluded_firms: Sequence) -> Column:
    """The conditions of a rule beside its fixed values, with SQL's treatment of nulls."""
    name, lower = F.col("offer_name"), F.lower("offer_name")
    terms = (rule["product_not"].isNull() | (F.col("product") != rule["product_not"]))
    terms &= F.forall(rule["contains"], lambda s: F.contains(name, s))
    terms &= F.forall(rule["any_case"], lambda s: F.contains(lower, s))
    if excluded_firms:
        terms &= rule["open"] | ~F.col("firm_id").isin(list(excluded_firms))
    return terms


def matching_tags(df: DataFrame, rules: Sequence[TagRule], excluded_firms: Sequence = ()
                  ) -> DataFrame:
    """``df`` with ``tags``, the tags of all rules that match a row, in no particular order."""
    columns, found = df.columns, []
    for i, (fields, table) in enumerate(index(df, rules)):
        found.append(f"rules_{i}")
        table = F.broadcast(table.withColumnRenamed("rules", found[-1]))  # the configured rules
        df = (df.join(table, list(fields), "left") if fields else
              df.withColumn(found[-1], table.select(found[-1]).scalar()))
    none = F.array().cast(_REST)
    asked = F.concat(*[F.coalesce(c, none) for c in found]) if found else none
    hit = F.filter(asked, lambda r: F.coalesce(_holds(r, excluded_firms), F.lit(False)))
    return df.select(*columns, F.transform(hit, lambda r: r["tag"]).alias("tags"))


def multi_rule_tag(df: DataFrame, rules: Sequence[TagRule], excluded_firms: Sequence = ()
                   ) -> DataFrame:
    """The rows of ``events.multi_rule_tag``: one per rule that a row matches, its tag in
    ``table_type``. The work per row grows with the rules that share its values, and with the
    kinds of fixed fields (16 at most), but not with the number of rules."""
    tagged = matching_tags(df, rules, excluded_firms)
    return tagged.withColumn("table_type", F.explode("tags")).drop("tags")
