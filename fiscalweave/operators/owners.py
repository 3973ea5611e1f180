"""Account owners: who owns an account now, and which team that owner belongs to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.config import CancelRules, OwnerRules, RegionRules
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.functions.measures import not_future
from fiscalweave.functions.text import email_alias, normalize_name, token_key
from fiscalweave.operators.events import (OPEN_END, cancel_contract, in_period, join_calendar,
                                          period_calendar)
from fiscalweave.operators.joins import left_lookup
from fiscalweave.sources.sinks import rewritten
from fiscalweave.sources.tables import sheet_as_table

# -- ownership -------------------------------------------------------------------------------------


def owner_history_rows(history: DataFrame) -> DataFrame:
    """Live owner intervals only."""
    return history.filter((F.col("type") == "Owner") & ~F.col("isdeleted")).select(
        "account", "user_id", "start_date", "end_date")


def _recency(*tie_break: str) -> Column:
    return F.struct(F.coalesce(F.col("end_date"), F.lit(OPEN_END)), F.col("start_date"),
                    *[F.col(c) for c in tie_break])


def latest_owner(history: DataFrame) -> DataFrame:
    """The owner per account: an open interval first, then the latest end, then the latest start.

    An aggregate with a map-side combine rather than a row number, so an account holding a third
    of the history does not end up in one sort.
    """
    picked = F.max_by(F.struct("user_id", "start_date", "end_date"), _recency("user_id"))
    return (owner_history_rows(history).groupBy("account").agg(picked.alias("o"))
            .select("account", "o.*"))


def current_agents(agents: DataFrame, as_of: dt.date) -> DataFrame:
    return agents.filter(F.col("rec_end") > F.lit(as_of)).select(
        "agent_id", F.col("name").alias("agent_name"))


def join_coerced_key(users: DataFrame, agents: DataFrame, how: str = "left") -> DataFrame:
    """Users joined to agents on a text key that may not be numeric; bad text matches nothing."""
    keyed = users.withColumn("agent_id", F.col("federation_id").try_cast("bigint"))
    return keyed.join(agents, "agent_id", how)


def user_names(users: DataFrame, agents: DataFrame, as_of: dt.date) -> DataFrame:
    """user_id and the names of the current agent versions behind it."""
    return (join_coerced_key(users, current_agents(agents, as_of))
            .select(F.col("id").alias("user_id"), "agent_name"))


def join_owner_chain(companies: DataFrame, accounts: DataFrame, history: DataFrame,
                     users: DataFrame, agents: DataFrame, as_of: dt.date,
                     unmanaged: str = "Unmanaged") -> DataFrame:
    """Company to owner intervals to owner names, all left: one row per interval.

    A company without an account, interval, user or agent is 'Unmanaged'. The live intervals and the
    reduced ones per firm are written once, since their keys are counted before they are joined.
    """
    # One account may hold a large share of the history, one firm of the companies.
    keyed = accounts.select(F.col("company_id").alias("firm_id"), F.col("id").alias("account"))
    live = rewritten(owner_history_rows(history), "owner-history")
    owned = (left_lookup(keyed, live, ["account"])
             .join(user_names(users, agents, as_of), "user_id", "left")
             .select("firm_id", "start_date", "end_date", "user_id", "agent_name"))
    return (left_lookup(companies, rewritten(owned, "owner-intervals"), ["firm_id"])
            .withColumn("account_owner", F.coalesce("agent_name", F.lit(unmanaged)))
            .drop("agent_name"))


def firm_owners(accounts: DataFrame, history: DataFrame, users: DataFrame, agents: DataFrame,
                as_of: dt.date) -> DataFrame:
    """One row per firm with its current owner, built from the dimensions alone."""
    chain = (accounts.select(F.col("company_id").alias("firm_id"), F.col("id").alias("account"))
             .join(latest_owner(history), "account", "left")
             .join(user_names(users, agents, as_of), "user_id", "left"))
    picked = F.max_by(F.struct("agent_name", "user_id"), _recency("user_id", "agent_name"))
    return chain.groupBy("firm_id").agg(picked.alias("o")).select(
        "firm_id", F.col("o.agent_name").alias("agent_name"))


# -- cancels ---------------------------------------------------------------------------------------


def cancel_eligibility(status: DataFrame, rules: CancelRules, as_of: dt.date) -> DataFrame:
    """Active cancels of attached accounts that had logged in before. NULL types are not kept."""
    return status.filter(
        F.col("country").isin(list(rules.countries))
        & (F.col("super_channel") == rules.super_channel)
        & F.col("channel").isin(list(rules.channels))
        & (F.col("subscription_type") != rules.excluded_subscription)
        & F.col("firm_id").isNotNull()
        & F.col("cancel_date").isNotNull()
        & (F.col("first_login") < F.col("cancel_date"))
        & not_future(F.col("cancel_date"), as_of))


def cancel_events(account_status: DataFrame, company_status: DataFrame, accounts: DataFrame,
                  history: DataFrame, users: DataFrame, agents: DataFrame, rule: FiscalRule,
                  rules: CancelRules, regions: RegionRules, as_of: dt.date, fy: int,
                  qtr: int | None = None, unmanaged: str = "Unmanaged") -> DataFrame:
    """Cancelled accounts with their present owner, one row per account, by cancel week.

    The owner chain is reduced to one row per firm first, so the account rows meet a single
    lookup instead of four fanning joins; a firm holding many accounts is split by that lookup.
    """
    # Both sides are cut to the period or the eligible rows before they meet.
    company = in_period(company_status, "cancel_date", rule, fy, qtr)
    status = account_status.filter(F.col("sold_date").isNotNull()).join(company, "account_id")
    status = cancel_eligibility(status, rules, as_of)
    # One row per account; which source row wins matters only if a source repeats an account.
    status = status.groupBy("account_id").agg(
        F.max(F.struct("cancel_date", "firm_id", "country")).alias("s")).select("account_id", "s.*")
    owned = status.join(firm_owners(accounts, history, users, agents, as_of), "firm_id", "left")
    owned = owned.withColumn("account_owner", F.coalesce("agent_name", F.lit(unmanaged)))
    owned = join_calendar(owned, period_calendar(owned, rule, fy, qtr), fy, qtr, "cancel_date")
    return cancel_contract(owned.withColumn("team_raw", F.lit(None).cast("string")), regions)


# -- roster ----------------------------------------------------------------------------------------


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Value of a configuration map, NULL for an unknown key."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def roster_names(roster: DataFrame, rules: OwnerRules) -> DataFrame:
    """Every spelling of every mappable roster row: (row_no, variant_no, name, team)."""
    sheet = sheet_as_table(roster, ["Segment", "Agent", "L3", "AgentEmail"], "Agent")
    division = F.trim(F.regexp_replace("L3", r"\s+", " "))
    team = F.coalesce(_lookup(rules.division_teams, division),
                      _lookup(rules.segment_teams, F.upper(F.trim("Segment"))))
    variants = F.array(F.trim("Agent"), email_alias(F.trim("AgentEmail")))
    return (sheet.select(F.col("row_no").cast("bigint").alias("row_no"), team.alias("team"),
                         F.posexplode(variants).alias("variant_no", "name"))
            .filter(F.col("team").isNotNull() & F.col("name").isNotNull()))


def roster_keys(roster: DataFrame, rules: OwnerRules) -> DataFrame:
    """(kind, key, team): exact name keys, and token keys that point to one team only.

    Where spellings collide, the last roster row wins an exact key; a token key claimed by two
    teams is dropped.
    """
    names = roster_names(roster, rules)
    keyed = names.select(
        "team", F.struct("row_no", "variant_no").alias("pos"),
        F.explode(F.create_map(F.lit("exact"), normalize_name(F.col("name")),
                               F.lit("token"), token_key(F.col("name")))).alias("kind", "key"))
    return (keyed.groupBy("kind", "key")
            .agg(F.max_by("team", "pos").alias("team"),
                 (F.min("team") != F.max("team")).alias("ambiguous"))
            .filter((F.col("kind") == "exact") | ~F.col("ambiguous"))
            .select("kind", "key", "team"))


# -- classification --------------------------------------------------------------------------------


def _norm(name: str) -> str:
    """``normalize_name`` for configuration keys."""
    for old, new in ((",", " "), (".", " "), ("'", ""), ("’", "")):
        name = name.replace(old, new)
    return " ".join(name.split()).lower()


def with_owner_outcome(events: DataFrame, keys: DataFrame, rules: OwnerRules,
                       owner: str = "account_owner") -> DataFrame:
    """Events with the team of their owner and the outcome; team is NULL when it is dropped.

    Precedence: override (which may drop), exact key, token key, service account or the literal
    'unmanaged'; everybody else is dropped. The keys come from a directory of people, so both
    lookups are normally broadcast and the events are not shuffled at all.
    """
    named = events.withColumns({"_norm": normalize_name(F.col(owner)),
                                "_tok": token_key(F.col(owner))})
    exact = keys.filter("kind = 'exact'").select(F.col("key").alias("_norm"),
                                                 F.col("team").alias("_exact"))
    token = keys.filter("kind = 'token'").select(F.col("key").alias("_tok"),
                                                 F.col("team").alias("_token"))
    norm, found = F.col("_norm"), F.coalesce("_exact", "_token")
    override = _lookup({_norm(k): v for k, v in rules.overrides.items()}, norm)
    system = norm == rules.unmanaged.lower()
    for marker in rules.system_markers:
        system = system | F.contains(norm, F.lit(marker))
    team = (F.when(override == rules.drop, F.lit(None).cast("string"))
            .when(override.isNotNull(), override).when(found.isNotNull(), found)
            .when(system, rules.unmanaged))
    matched = named.join(exact, "_norm", "left").join(token, "_tok", "left")
    outcome = (F.when(F.col("team").isNull(), "dropped")
               .when(F.col("team") == rules.unmanaged, "unmanaged").otherwise("matched"))
    return (matched.withColumn("team", team).select(*events.columns, "team")
            .withColumn("outcome", outcome))


def classify_owner(events: DataFrame, keys: DataFrame, rules: OwnerRules) -> DataFrame:
    """Events with team_raw set from their owner; rows of dropped owners leave."""
    return (with_owner_outcome(events, keys, rules).filter(F.col("team").isNotNull())
            .withColumn("team_raw", F.col("team")).select(*events.columns))


def classify_audit(classified: DataFrame) -> DataFrame:
    """Row and owner counts per outcome."""
    return classified.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.coalesce("account_owner", F.lit(""))).alias("n_owners"))


def top_owners(classified: DataFrame, outcomes: Sequence[str], n: int = 40) -> DataFrame:
    """Most frequent owner names of each outcome, ranked on counts per name."""
    rank = F.row_number().over(W.partitionBy("outcome").orderBy(F.desc("n"), "account_owner"))
    return (classified.filter(F.col("outcome").isin(list(outcomes)))
            .groupBy("outcome", "account_owner").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("rank", rank).filter(F.col("rank") <= n))
