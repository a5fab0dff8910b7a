"""CRM side: transaction fact, pipeline TCV and reference preparation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.fiscal import fiscal_period
from ..functions.rules import (milestone_type_name, override_if_key_present,
                               override_if_present)
from ..operators.aggregates import sum_by
from ..operators.dedup import distinct_rows, latest_per_key
from ..operators.joins import JoinSpec, auto_broadcast_bytes, enrich, fits_broadcast, left_enrich
from ..operators.projection import add_prefix, project_lenient, rename_map
from ..operators.skew import SHARE, few_rows, key_profile
from ..sources.readers import flatten_parent


# Left keys that are often null (transactions without account, project or
# milestone) are salted over this many shuffle keys.
NULL_SALT = 256


def _spec(right, left_on, right_on, right_suffix, broadcast=False):
    return JoinSpec(right, left_on, right_on, ("", right_suffix), broadcast=broadcast,
                    null_salt=NULL_SALT, salt_on=("Trx_Id",))


# The transaction enrichment chain. The right suffix depends on the
# role of the joined table (owner of the opportunity, opportunity of the
# milestone's line item, everything else). The original's last step (user
# as milestone group owner) produced only columns it then discarded, so it
# is left out; it would only matter if user ids were not unique.
CRM_CHAIN = (
    _spec("Ref_Acct", "Trx_Account__c", "Acct_Id", "_Acct"),
    _spec("Ref_User", "Acct_OwnerId", "User_Id", "_Acct", broadcast=True),
    _spec("Ref_Opps", "Trx_Opportunity__c", "Opps_Id", "_Acct"),
    _spec("Ref_Proj", "Trx_Project__c", "Proj_Id", "_Acct"),
    _spec("Ref_Mile", "Trx_Milestone__c", "Mile_Id", "_Acct"),
    _spec("Ref_User", "Opps_OwnerId", "User_Id", "_Opps", broadcast=True),
    _spec("Ref_Order", "Mile_Order__c", "Order_Id", "_Acct"),
    _spec("Ref_Oppline", "Mile_Opportunity_Line_Item_Id__c", "Oppline_Id", "_Acct"),
    _spec("Ref_Opps", "Oppline_OpportunityId", "Opps_Id", "_MileOpp"),
)


class _Prefixed(dict):
    """CRM objects with their source prefix, prefixed on first access."""

    def __init__(self, objects: Mapping[str, DataFrame]):
        super().__init__()
        self._objects = objects

    def __missing__(self, name):
        df = add_prefix(self._objects[name], K.CRM_PREFIXES[name])
        self[name] = df
        return df

    def materialise(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in K.CRM_PREFIXES if n in self._objects}


def prefixed(objects: Mapping[str, DataFrame]) -> _Prefixed:
    """Every CRM object with its source prefix on every column (P5)."""
    return _Prefixed(objects)


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])


TRANSACTION_KEYS = ("Trx_Account__c", "Trx_Opportunity__c", "Trx_Project__c", "Trx_Milestone__c")
NARROW_FIRST = ("Trx_Project__c", "Trx_Account__c", "Trx_Opportunity__c", "Trx_Milestone__c")


def hot_transaction_keys(fact: DataFrame, fraction: float = 0.01, share: float = SHARE) -> dict[str, tuple]:
    """The hot values of the transaction fact's four keys, sketched in one pass over a
    sample. They decide how the joins are carried out, not what comes out."""
    sample = fact.sample(fraction, seed=17) if fraction < 1 else fact
    found = key_profile(sample, {k: F.col(k) for k in TRANSACTION_KEYS}, share)
    return {k: tuple(v for v in values if v is not None) for k, values in found.items()}


# Rows without a key go past the shuffle of its join from this share of the fact on.
BARE_SHARE = 1 / 8


def bare_transaction_keys(fact: DataFrame, fraction: float = 0.01, share: float = BARE_SHARE) -> tuple[str, ...]:
    """Those of the transaction fact's keys that are null in so many rows of a sample.
    They decide how the joins are carried out, not what comes out."""
    sample = fact.sample(fraction, seed=17) if fraction < 1 else fact
    one = sample.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(k).isNull()).alias(k) for k in TRANSACTION_KEYS]).first()
    return tuple(k for k in TRANSACTION_KEYS if one["n"] and one[k] >= one["n"] * share)


def _salt_columns(fact: DataFrame) -> tuple[str, ...]:
    """What salts of the fact are made of: columns that its result keeps, not the id,
    which would go through every shuffle for that alone."""
    kept = tuple(c for c in ("Trx_Order_Number__c", "Trx_Product_Number__c", "Trx_Transaction_Amount__c") if c in fact.columns)
    return kept or ("Trx_Id",)


def dimension_first_join(cat: Mapping[str, DataFrame], hot: Mapping[str, tuple] | None = None,
                         bare: Sequence[str] = ()) -> DataFrame:
    """The J2 chain with the dimension-to-dimension lookups done first.

    Owner lookups only read account or opportunity columns, and the
    milestone's order, line item and line-item opportunity only read
    milestone columns, so they are joined into three dimension tables
    (sized by CRM records, not by transactions) before the fact is touched:
    the transaction fact is then shuffled for four joins instead of nine.
    Column names are those the sequential chain gives. Equivalent to the
    sequential chain because CRM record ids are primary keys (never null),
    so no null-to-null match can arise between dimensions. ``hot``: values of the
    fact's keys that are split off where a join has to shuffle. ``bare``: keys that many
    rows of the fact lack. Where a join of the first or the last of the keys has to
    shuffle, and no record lacks its id, such rows match nothing and do not go through it.
    """
    users = cat["Ref_User"]
    acct = left_enrich(cat["Ref_Acct"], users, "Acct_OwnerId", "User_Id", null_salt=NULL_SALT, salt_on=("Acct_Id",))
    opps = left_enrich(cat["Ref_Opps"], _suffixed(users, "_Opps"), "Opps_OwnerId", "User_Id_Opps",
                       null_salt=NULL_SALT, salt_on=("Opps_Id",))
    mile = left_enrich(cat["Ref_Mile"], cat["Ref_Order"], "Mile_Order__c", "Order_Id", null_salt=NULL_SALT,
                       salt_on=("Mile_Id",))
    mile = left_enrich(mile, cat["Ref_Oppline"], "Mile_Opportunity_Line_Item_Id__c", "Oppline_Id",
                       null_salt=NULL_SALT, salt_on=("Mile_Id",))
    mile = left_enrich(mile, _suffixed(cat["Ref_Opps"], "_MileOpp"), "Oppline_OpportunityId",
                       "Opps_Id_MileOpp", null_salt=NULL_SALT, salt_on=("Mile_Id",))
    # What a join adds goes through the shuffles of the next ones: narrow tables come first.
    rights = dict(zip(TRANSACTION_KEYS, ((acct, "Acct_Id"), (opps, "Opps_Id"), (cat["Ref_Proj"], "Proj_Id"), (mile, "Mile_Id")),
                      strict=True))
    fact = cat["Fact_Trx"]
    salt_on = _salt_columns(fact)
    records = dict(zip(TRANSACTION_KEYS, ("Ref_Acct", "Ref_Opps", "Ref_Proj", "Ref_Mile"), strict=True))

    def add(f: DataFrame, key: str) -> DataFrame:
        right, on = rights[key]
        return left_enrich(f, right, key, on, null_salt=NULL_SALT, salt_on=salt_on, hot_values=(hot or {}).get(key, ()))

    def goes_past(key: str) -> bool:
        right, on = rights[key]
        return (key in bare and not fits_broadcast(right, auto_broadcast_bytes(right))
                and few_rows(cat[records[key]].where(F.col(on).isNull()), 0))

    def with_and_without(f: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        return f.where(F.col(key).isNotNull()), f.where(F.col(key).isNull())

    def without(f: DataFrame, key: str) -> DataFrame:
        return f.select("*", *[F.lit(None).cast(c.dataType).alias(c.name) for c in rights[key][0].schema])

    first, *middle, last = NARROW_FIRST
    first_past, last_past = goes_past(first), goes_past(last)

    def to_the_last(f: DataFrame) -> DataFrame:
        if first_past:
            some, none = with_and_without(f, first)
            f = add(some, first).unionByName(without(none, first))
        else:
            f = add(f, first)
        for key in middle:
            f = add(f, key)
        return f

    if not last_past:
        return add(to_the_last(fact), last)
    some, none = with_and_without(fact, last)
    return add(to_the_last(some), last).unionByName(without(to_the_last(none), last))


def transaction_fact(objects: Mapping[str, DataFrame], chain=None, profile: float = 0.0) -> DataFrame:
    """CRM transactions with account, owners, opportunity, project,
    milestone, order and milestone opportunity; milestone values override
    opportunity values; months become fiscal periods.

    ``chain`` (e.g. ``CRM_CHAIN``) runs the enrichment as the original's
    sequential list of joins; by default the equivalent dimension-first
    plan is used, with the hot keys and the often missing ones that a sketch of the
    part ``profile`` of the fact finds.
    """
    cat = prefixed(objects)
    sketched = profile and chain is None
    hot = hot_transaction_keys(cat["Fact_Trx"], profile) if sketched else None
    bare = bare_transaction_keys(cat["Fact_Trx"], profile) if sketched else ()
    f = enrich(cat["Fact_Trx"], cat, chain) if chain is not None else dimension_first_join(cat, hot, bare)
    f = project_lenient(rename_map(f, K.CRM_FINAL_COLUMNS, keep_unmapped=False),
                        list(K.CRM_FINAL_COLUMNS.values()))
    return f.withColumns({
        "Opp_Num": override_if_present("MileOppLine_OppNum", "Opp_Num"),
        "Opp_CloseMonth": fiscal_period(override_if_present("MileOppLine_MonthClose", "Opp_CloseMonth")),
        "Opp_Prob": override_if_key_present("MileOppLine_OppNum", "MileOppLine_OppProb", "Opp_Prob"),
        "Opp_Stage": override_if_present("MileOppLine_OppStage", "Opp_Stage"),
        "Trx_OrderNum": override_if_present("Order_Name", "Trx_OrderNum"),
        "Opp_Type": override_if_present("MileOppLine_OppType", "Opp_Type"),
        "Opps_Amount": override_if_key_present("MileOppLine_OppNum", "MileOppLine_OppAmount", "Opps_Amount"),
        "Mile_Type": milestone_type_name("Mile_Type"),
        "Trx_Month": fiscal_period("Trx_Month"),
    })


def pipeline_tcv(fact: DataFrame) -> DataFrame:
    """C4: unweighted pipeline value per opportunity and offering.

    Pipeline transactions are summed per (opportunity, offering); rows with
    a null key are left out (dataframe grouping) and zero or null totals
    dropped. The opportunity's attributes are re-attached from the distinct
    attribute rows of all transactions, so an opportunity seen with two
    accounts yields two rows (as in the original).
    """
    pipe = fact.where(F.col("Trx_Type").isin(K.PIPELINE_TRANSACTION_TYPE))
    tot = sum_by(pipe, ["Opp_Num", "Trx_Offering"], "Trx_Amount", drop_null_keys=True, nonzero=True)
    ref = distinct_rows(fact, list(K.PIPELINE_REF_FIELDS))
    out = left_enrich(tot, ref, "Opp_Num", "Opp_Num")
    return out.withColumnRenamed("Trx_Amount", "TCV_UnWPL")


def bill_party_ref(acct: DataFrame) -> DataFrame:
    """Accounts with a party id, the id cast to a number (a bad id
    fails the job, as it did in the original)."""
    return (acct.where(F.col("Acct_Party_ID__c").isNotNull())
            .withColumn("Acct_Party_ID__c", F.col("Acct_Party_ID__c").cast("long")))


def parent_ref(prnt: DataFrame) -> DataFrame:
    """Parents with a registry id."""
    return prnt.where(F.col("Prnt_Registry_ID__c").isNotNull())


def offering_ref(offr: DataFrame) -> DataFrame:
    """One offering per product number, from its latest month."""
    return latest_per_key(offr, "Offr_Product_Number__c", "Offr_Transaction_Month__c",
                          ["Offr_Offering__c"])


def opportunity_ref(opps: DataFrame) -> DataFrame:
    """Opportunities with the close month as a fiscal period."""
    return opps.withColumn("Opps_Month_Close__c", fiscal_period("Opps_Month_Close__c"))


def opportunity_account_ref(opp_acct: DataFrame) -> DataFrame:
    """Opportunity number -> account id, from the nested parent, or from
    a flat file that has the account's id in its place."""
    return flatten_parent(opp_acct, "Opportunity__c", "Account", "Id",
                          "OppsAcct_Opportunity__c", "OppsAcct_Account")
