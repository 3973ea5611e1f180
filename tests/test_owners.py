import datetime as dt

import pytest

from fiscalweave.config import CancelRules, OwnerRules, RegionRules
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import owners as ow

D = dt.date
OPEN = D(2999, 12, 31)
AS_OF = D(2000, 6, 15)
OWNERS = OwnerRules(
    division_teams={"North L3": "North", "South L3": "South"}, segment_teams={"EST": "East"},
    overrides={"Kim O'Hara": "South", "Max Gone": "DROP", "Sync Integration": "East"})
ROSTER = "row_no string, Segment string, Agent string, L3 string, AgentEmail string"


def roster(spark, *rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], ROSTER)


def keys(spark, *rows):
    got = ow.roster_keys(roster(spark, *rows), OWNERS)
    return {(r.kind, r.key): r.team for r in got.collect()}


def test_division_first_then_segment(spark):
    got = keys(spark, ("est", "Ann Lee", " North   L3 ", ""), (" est ", "Bob Ray", "", None),
               ("?", "Cy Fox", "Elsewhere", ""), ("est", "  ", "North L3", "x@y"))
    assert got == {("exact", "ann lee"): "North", ("token", "ann lee"): "North",
                   ("exact", "bob ray"): "East", ("token", "bob ray"): "East"}


def test_email_variant_and_reordering(spark):
    got = keys(spark, ("", "Lee Ann", "North L3", "ann_lee@x.org"))
    assert got == {("exact", "lee ann"): "North", ("exact", "ann lee"): "North",
                   ("token", "ann lee"): "North"}


def test_last_row_wins_exact_and_ambiguous_tokens_drop(spark):
    got = keys(spark, ("", "Ann Lee", "North L3", ""), ("", "Ann Lee", "South L3", ""))
    assert got == {("exact", "ann lee"): "South"}
    same = keys(spark, ("", "Ann Lee", "North L3", ""), ("", "Lee Ann", "North L3", ""))
    assert same[("token", "ann lee")] == "North"


@pytest.mark.parametrize("order", [1, -1])
def test_token_keys_ignore_row_order(spark, order):
    people = [("", "Ann Lee", "North L3", ""), ("", "Lee, Ann", "South L3", ""),
              ("", "Bo Day", "South L3", "")][::order]
    got = keys(spark, *people)
    assert {k: t for (kind, k), t in got.items() if kind == "token"} == {"bo day": "South"}


CASES = {
    "Ann Lee": ("North", "matched"), "LEE,  Ann": ("North", "matched"),
    "kim ohara": ("South", "matched"), "Max Gone": (None, "dropped"),
    "Data Integration": ("Unmanaged", "unmanaged"), "AB_Placeholder X": ("Unmanaged", "unmanaged"),
    "Sync Integration": ("East", "matched"), "Unmanaged": ("Unmanaged", "unmanaged"),
    "Unmanaged Person": (None, "dropped"), "Stranger": (None, "dropped"), "": (None, "dropped"),
    None: (None, "dropped"),
}


def test_classification(spark):
    df = spark.createDataFrame([(n, "?") for n in CASES] + [("Ann Lee", "?")],
                               "account_owner string, team_raw string")
    k = ow.roster_keys(roster(spark, ("", "Ann Lee", "North L3", ""),
                              ("", "Max Gone", "North L3", "")), OWNERS)
    classified = ow.with_owner_outcome(df, k, OWNERS)
    assert {r.account_owner: (r.team, r.outcome) for r in classified.collect()} == CASES
    assert classified.count() == len(CASES) + 1
    kept = ow.classify_owner(df, k, OWNERS)
    assert kept.columns == df.columns and kept.count() == 8
    audit = {r.outcome: (r.n_rows, r.n_owners) for r in ow.classify_audit(classified).collect()}
    assert audit == {"matched": (5, 4), "unmanaged": (3, 3), "dropped": (5, 4)}
    top = ow.top_owners(classified, ["matched", "unmanaged"], 1).select("account_owner", "n", "rank")
    assert {tuple(r) for r in top.collect()} == {("Ann Lee", 2, 1), ("AB_Placeholder X", 1, 1)}


HISTORY = "account bigint, user_id bigint, type string, start_date date, end_date date, isdeleted boolean"


def history(spark, *rows):
    return spark.createDataFrame(rows, HISTORY)


def test_latest_owner(spark, rows):
    h = history(
        spark, (1, 10, "Owner", D(2000, 1, 1), D(2000, 5, 1), False),
        (1, 11, "Owner", D(1999, 1, 1), None, False),         # open beats later start
        (1, 12, "Owner", D(1999, 6, 1), None, True),          # deleted
        (1, 13, "Team", D(2001, 1, 1), None, False),          # not an owner
        (2, 20, "Owner", D(2000, 1, 1), None, False), (2, 21, "Owner", D(2000, 2, 1), None, False),
        (3, 30, "Owner", None, D(2000, 1, 1), False), (3, 31, "Owner", D(1990, 1, 1), D(2000, 1, 1), False),
        (4, 40, "Team", D(2000, 1, 1), None, False))
    assert rows(ow.latest_owner(h).select("account", "user_id")) == [(1, 11), (2, 21), (3, 31)]


STATUS = ("account_id bigint, first_login date, firm_id bigint, sold_date date, country string, "
          "super_channel string, channel string, subscription_type string, cancel_date date")
RULES = CancelRules(["Here"], "S", ["a", "b"])


def account(i, **kw):
    base = dict(account_id=i, first_login=D(2000, 1, 1), firm_id=1, sold_date=D(2000, 1, 1),
                country="Here", super_channel="S", channel="a", subscription_type="Paid",
                cancel_date=D(2000, 5, 3))
    return tuple((base | kw).values())


VARIANTS = [
    account(0), account(1, country="There"), account(2, super_channel="T"), account(3, channel="c"),
    account(4, subscription_type="Trial"), account(5, subscription_type=None),
    account(6, firm_id=None), account(7, cancel_date=None),
    account(8, first_login=D(2000, 5, 3)), account(9, first_login=None),
    account(10, cancel_date=AS_OF), account(11, cancel_date=D(2000, 6, 16)),
    account(12, sold_date=None), account(13, firm_id=99), account(14, firm_id=2)]


def test_eligibility(spark):
    df = spark.createDataFrame(VARIANTS, STATUS)
    kept = {r.account_id for r in ow.cancel_eligibility(df, RULES, AS_OF).collect()}
    assert kept == {0, 10, 12, 13, 14}


def test_cancel_events(spark, rows):
    df = spark.createDataFrame(VARIANTS, STATUS)
    accounts = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "id bigint, company_id bigint, parent_id bigint")
    h = history(spark, (1, 7, "Owner", D(2000, 1, 1), None, False),
                (2, 8, "Owner", D(2000, 1, 1), None, False))
    users = spark.createDataFrame([(7, "70"), (8, "x80")], "id bigint, federation_id string")
    agents = spark.createDataFrame([(70, "Old Name", D(1990, 1, 1), AS_OF), (70, "Ann Lee", D(1990, 1, 1), OPEN),
                                    (80, "Nobody", D(1990, 1, 1), OPEN)],
                                   "agent_id bigint, name string, rec_start date, rec_end date")
    status = df.select("account_id", "first_login", "firm_id", "sold_date")
    company = df.drop("first_login", "firm_id", "sold_date")
    got = ow.cancel_events(status, company, accounts, h, users, agents, FiscalRule(), RULES,
                           RegionRules({"R": ["Here"]}), AS_OF, 2000)
    assert rows(got.select("account_id", "account_owner", "fweek", "region")) == [
        ("0", "Ann Lee", 40, "R"), ("10", "Ann Lee", 46, "R"), ("13", "Unmanaged", 40, "R"),
        ("14", "Unmanaged", 40, "R")]
    chain = ow.join_owner_chain(status, accounts, h, users, agents, AS_OF)
    assert chain.count() == len(VARIANTS)
