"""Attribute order-side facts to accounts, opportunities and owners."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import account_fallback, account_source
from ..operators.fanout import fanout_forecast
from ..operators.joins import (DEFAULT_BROADCAST_CEILING, DeriveSpec, JoinSpec, auto_broadcast_bytes, enrich,
                               fits_broadcast, left_enrich)
from ..operators.skew import SHARE, few_rows, key_profile


ACCOUNT_IDS = ("OppsAcct_Account", "Acct_Id", "Prnt_Id")


def derive_account(df: DataFrame) -> DataFrame:
    """The account id to use: opportunity account, else bill-to account,
    else parent account, else 'unmapped'; and which one it was."""
    return df.withColumns({"acct_src": account_source(*ACCOUNT_IDS),
                           "Final_AcctID": account_fallback(*ACCOUNT_IDS)})


# The order-fact enrichment chain. Null keys match null keys (as in the
# original); users and offerings are small dimensions and are broadcast
# behind a size check, the rest is left to the optimizer and AQE. Steps
# whose left key is often null (hold rows without an order, orders without an
# opportunity, unmapped accounts) salt those rows over NULL_SALT shuffle keys,
# by a hash of the amount alone, so that the salt reads no further column.
NULL_SALT = 256
SALT_ON = ("Amount",)


def _step(right, left_on, right_on, suffixes=("_x", "_y"), broadcast=False, hot_values=()):
    return JoinSpec(right, left_on, right_on, suffixes, broadcast=broadcast, null_salt=NULL_SALT,
                    hot_values=hot_values, salt_on=SALT_ON)


PARTY_KEY = "party_key"

ORDER_CHAIN = (
    _step("Ref_BillParty", PARTY_KEY, "Acct_Party_ID__c"),
    _step("reforderopp", "ORDER_HEADER_ID", "ORDER_HEADER_ID"),
    _step("Ref_Opps_Acct", "OPPORTUNITY_ID", "OppsAcct_Opportunity__c"),
    _step("Ref_Prnt", "PARTYNUMBER_AKA_REGISTRYID", "Prnt_Registry_ID__c"),
    DeriveSpec(derive_account, "account", ACCOUNT_IDS),
    _step("Ref_Acct", "Final_AcctID", "Acct_Id", ("_Bill2map", "_Final"), hot_values=("unmapped",)),
    _step("Ref_User", "Acct_OwnerId_Final", "User_Id", broadcast=True),
    _step("Ref_Opps", "OppsAcct_Opportunity__c", "Opps_Opportunity__c"),
    _step("Ref_Offr", "PRODUCT_NUMBER_CONCAT", "Offr_Product_Number__c", broadcast=True),
    _step("Ref_User", "Opps_OwnerId", "User_Id", ("_x", "_Opps"), broadcast=True),
)


def attribute_orders(fact: DataFrame, catalog: Mapping[str, DataFrame], chain=ORDER_CHAIN,
                     broadcast_ceiling: int = DEFAULT_BROADCAST_CEILING) -> DataFrame:
    """Run the enrichment chain over one order-side fact. The bill-to party
    of a hold row is an account number in text; only the join key is a
    number (null where the text is none)."""
    keyed = with_party_key(fact)
    if _is_order_chain(chain):
        out = _opportunities_first(keyed, catalog, chain, broadcast_ceiling)
        if out is not None:
            return out.drop(PARTY_KEY)
    return enrich(keyed, catalog, chain, broadcast_ceiling).drop(PARTY_KEY)


def _is_order_chain(chain) -> bool:
    """Whether these are the steps of ``ORDER_CHAIN``, whatever their hot values."""
    return (len(chain) == len(ORDER_CHAIN) and all(
        replace(s, hot_values=()) == replace(o, hot_values=()) if isinstance(s, JoinSpec) and isinstance(o, JoinSpec) else s == o
        for s, o in zip(chain, ORDER_CHAIN)))


def _opportunities_first(fact: DataFrame, catalog: Mapping[str, DataFrame], chain, ceiling: int) -> DataFrame | None:
    """The rows and columns of ``enrich(fact, catalog, chain)`` for the steps of
    ``ORDER_CHAIN``, with fewer and narrower shuffles of the fact.

    The opportunity's account and the opportunity itself are looked up by columns that
    come from the order map alone, so the order map meets them first, and the fact is
    shuffled for the three together once. Rows without an opportunity meet the
    opportunities without a number by broadcast, and are multiplied by them only after
    the last shuffle. None where the opportunities are small enough to broadcast (then no
    step of these shuffles the fact) or too many lack a number."""
    joins = {i: s for i, s in enumerate(chain) if isinstance(s, JoinSpec)}
    party, orders, opp_account, parent, account, user, opp, offering, opp_user = joins.values()
    limit = auto_broadcast_bytes(fact)
    if all(fits_broadcast(catalog[s.right], limit) for s in (opp_account, opp)):
        return None
    tags = {id(s): f"__{n}_" for n, s in enumerate(joins.values())}

    def tagged(spec, df=None, more=""):
        df = catalog[spec.right] if df is None else df
        return df.toDF(*[more + tags[id(spec)] + c for c in df.columns])

    def name(spec, c):
        return tags[id(spec)] + c

    def numbered(spec):
        return F.col(f"`{spec.right_on}`").isNotNull()

    def add(df, right, spec, left_on, **how):
        salts = {"null_salt": spec.null_salt, "hot_values": spec.hot_values, "salt_on": spec.salt_on}
        return left_enrich(df, right, left_on, name(spec, spec.right_on), broadcast=spec.broadcast,
                           broadcast_ceiling=ceiling, **{**salts, **how})

    # Opportunities without a number, as accounts' and as opportunities' rows.
    bare = {id(s): catalog[s.right].where(~numbered(s)) for s in (opp_account, opp)}
    counts = bare[id(opp_account)].agg(F.count(F.lit(1)).alias("n"), F.count("OppsAcct_Account").alias("accounts")).first()
    if not few_rows(bare[id(opp_account)]) or not few_rows(bare[id(opp)]):
        return None

    # The order map with its opportunities; one without a number waits for the bare ones.
    by_order = tagged(orders)
    for spec, key in ((opp_account, name(orders, opp_account.left_on)), (opp, name(opp_account, opp.left_on))):
        right = tagged(spec, catalog[spec.right].where(numbered(spec)))
        by_order = add(by_order, right, spec, key, salt_on=(name(orders, orders.right_on),),
                       few_hot=None if spec.hot_values else True)

    df = add(fact, tagged(party), party, party.left_on)
    df = add(df, tagged(parent), parent, parent.left_on)
    no_null = not orders.hot_values and few_rows(catalog[orders.right].where(F.col(orders.right_on).isNull()), 0)
    df = add(df, by_order, orders, orders.left_on, few_hot=True if no_null else None)

    ids = [name(opp_account, "OppsAcct_Account"), name(party, "Acct_Id"), name(parent, "Prnt_Id")]
    lacking = F.col(name(orders, opp_account.left_on)).isNull()

    def meet_bare(df, spec, right, key):
        """Rows without the key and the bare rows, which are not shuffled."""
        other = tagged(spec, right, "__bare")
        df = df.join(F.broadcast(other), F.col(key).eqNullSafe(F.col("__bare" + name(spec, spec.right_on))), "left")
        return df.withColumns({c.removeprefix("__bare"): F.coalesce(c, c.removeprefix("__bare"))
                               for c in other.columns if c.removeprefix("__bare") in df.columns})

    def with_account(df, key, **how):
        return add(df, tagged(account), account, key, **how)

    def derived(df):
        return df.withColumns({"__acct_src": account_source(*ids), "__Final_AcctID": account_fallback(*ids)})

    accounts = bare[id(opp_account)]
    found = None
    if counts["n"] and counts["accounts"] == counts["n"]:
        # All have an account: its row is found for them, and rows without an opportunity
        # go through the shuffle of the accounts without a key.
        wanted = accounts.select(F.col("OppsAcct_Account").alias("__wanted")).distinct()
        some = catalog[account.right].join(F.broadcast(wanted), F.col(account.right_on) == F.col("__wanted"), "left_semi")
        if few_rows(some, 10_000 // counts["n"]):
            found = accounts.join(F.broadcast(tagged(account, some)), F.col("OppsAcct_Account") == F.col(name(account, account.right_on)), "left")
    if found is not None:
        df = df.withColumn("__key", F.when(~lacking, account_fallback(*ids)))
        df = with_account(df, "__key", null_safe=False)
        mine = [c for c in accounts.columns]
        other = found.select(*[F.col(c).alias(name(opp_account, c)) for c in mine], *[c for c in found.columns if c not in mine])
        other = other.toDF(*["__bare" + c for c in other.columns])
        df = df.join(F.broadcast(other), F.col(name(orders, opp_account.left_on)).eqNullSafe(
            F.col("__bare" + name(opp_account, opp_account.right_on))), "left")
        df = df.withColumns({c.removeprefix("__bare"): F.coalesce(c, c.removeprefix("__bare")) for c in other.columns})
        df = derived(df)
    elif counts["accounts"]:
        df = derived(meet_bare(df, opp_account, accounts, name(orders, opp_account.left_on)))
        df = with_account(df, "__Final_AcctID")
    else:
        df = with_account(derived(df), "__Final_AcctID")
        df = meet_bare(df, opp_account, accounts, name(orders, opp_account.left_on))
    df = meet_bare(df, opp, bare[id(opp)], name(opp_account, opp.left_on))
    df = add(df, tagged(user), user, name(account, "Acct_OwnerId"))
    df = add(df, tagged(offering), offering, offering.left_on)
    df = add(df, tagged(opp_user), opp_user, name(opp, "Opps_OwnerId"))

    # The names that the chain gives: the fact's columns, then each step's.
    made = list(fact.columns)
    for spec in chain:
        if isinstance(spec, DeriveSpec):
            made += ["__acct_src", "__Final_AcctID"]
        else:
            made += [name(spec, c) for c in catalog[spec.right].columns if c != spec.left_on]
    plain = [replace(s, null_salt=0, broadcast=False, unique=False) if isinstance(s, JoinSpec) else s for s in chain]
    names = enrich(fact, catalog, plain).columns
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(made, names, strict=True)])


def with_party_key(fact: DataFrame) -> DataFrame:
    """The fact with its bill-to party as a number."""
    return fact.withColumn(PARTY_KEY, F.col("BILL_TO_PARTY_ID").try_cast("long"))


def order_fanout(fact: DataFrame, catalog: Mapping[str, DataFrame], chain=ORDER_CHAIN) -> DataFrame:
    """The rows that each step of the chain will make of a fact (``fanout``)."""
    return fanout_forecast(with_party_key(fact), catalog, chain)


def hot_chain(fact: DataFrame, catalog: Mapping[str, DataFrame], chain=ORDER_CHAIN, fraction: float = 0.01,
              share: float = SHARE) -> tuple:
    """The chain with the hot keys of each of its shuffle steps as ``hot_values``.

    The steps' left keys are sketched all at once, in one pass of the plain chain
    over a sample of the fact: keys of a step can come from the steps before. The
    sample decides only which keys are split off, not what comes out. A chain
    whose right tables are all small enough to broadcast is returned as it is."""
    limit = auto_broadcast_bytes(fact)
    shuffled = [i for i, s in enumerate(chain) if isinstance(s, JoinSpec) and s.null_salt > 1
                and isinstance(s.left_on, str) and not fits_broadcast(catalog[s.right], limit)]
    if not shuffled:
        return chain
    df = fact.sample(fraction, seed=17) if fraction < 1 else fact
    df = with_party_key(df)
    for i, spec in enumerate(chain):
        if i in shuffled:
            df = df.withColumn(f"__key_{i}", F.col(f"`{spec.left_on}`"))
        df = enrich(df, catalog, [replace(spec, null_salt=0, unique=False) if isinstance(spec, JoinSpec) else spec])
    found = key_profile(df, {str(i): F.col(f"__key_{i}") for i in shuffled}, share)
    return tuple(replace(s, hot_values=tuple(dict.fromkeys([*s.hot_values, *(v for v in found[str(i)] if v is not None)])))
                 if i in shuffled else s for i, s in enumerate(chain))


def attributed_fact(name: str, order_src: Mapping[str, DataFrame], crm_src: Mapping[str, DataFrame],
                    chain=ORDER_CHAIN, broadcast_ceiling: int = DEFAULT_BROADCAST_CEILING,
                    profile: float = 0.0) -> DataFrame:
    """One order-side fact (``revfact`` or ``tcv``) after the chain; order and CRM tables
    share one catalog, as the chain reads both. ``profile``: the part of the fact
    whose keys are sketched before (``hot_chain``); none by default."""
    cat = ChainMap(order_src, crm_src)
    fact = order_src[name]
    return attribute_orders(fact, cat, hot_chain(fact, cat, chain, profile) if profile else chain, broadcast_ceiling)


def attributed_facts(order_src: Mapping[str, DataFrame], crm_src: Mapping[str, DataFrame], **how) -> tuple[DataFrame, DataFrame]:
    """(revenue fact, TCV fact) after the chain."""
    return attributed_fact("revfact", order_src, crm_src, **how), attributed_fact("tcv", order_src, crm_src, **how)


def null_fanout(catalog: Mapping[str, DataFrame], chain=ORDER_CHAIN, fail: bool = False) -> DataFrame:
    """For each step of a chain, the rows of its right table with a
    null key. Null keys match null keys, so each left row with a null key
    comes out that many times. ``fail`` raises where it is more than once."""
    out = None
    for n, spec in enumerate(s for s in chain if isinstance(s, JoinSpec) and s.null_safe):
        keys = [spec.right_on] if isinstance(spec.right_on, str) else list(spec.right_on)
        null = reduce(lambda x, y: x | y, [F.col(f"`{k}`").isNull() for k in keys])
        one = catalog[spec.right].where(null).agg(F.count(F.lit(1)).alias("null_rows")).select(
            F.lit(n + 1).alias("step"), F.lit(spec.right).alias("right_table"), "null_rows")
        out = one if out is None else out.unionByName(one)
    if fail:
        bad = out.where("null_rows > 1").collect()  # one row for each step at most
        if bad:
            raise ValueError("null keys multiply rows: " + ", ".join(f"{r.right_table} x{r.null_rows}" for r in bad))
    return out


def chain_from_config(entries, derives=None) -> tuple:
    """Build a chain from join entries in the original's JSON shape:
    ``{"src", "right", "left_on", "right_on", "suf1", "suf2"}``. An entry
    with ``src == "func"`` becomes the derive step named by its ``right``
    in ``derives`` (default: the account derivation for any name)."""
    derives = derives or {}
    out = []
    for e in entries:
        if e.get("src") == "func":
            out.append(DeriveSpec(derives.get(e.get("right"), derive_account), e.get("right", "derive")))
        else:
            e = dict(e)
            if e["left_on"] == "BILL_TO_PARTY_ID":  # text in hold rows; see attribute_orders
                e["left_on"] = PARTY_KEY
            out.append(JoinSpec.from_dict({"null_salt": NULL_SALT, "salt_on": SALT_ON, "hot_values": ("unmapped",), **e}))
    return tuple(out)

