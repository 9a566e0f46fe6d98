"""The loyalty jobs on customers as cards, nations as merchants, parts as products and order lines as transactions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cases.base import AS_OF, case, number, tables
from millrace.plans import loyalty, steps
from millrace.scratch import scratch_path
from millrace.sources import locator

I, S, L, D = T.IntegerType(), T.StringType(), T.LongType(), T.DecimalType(18, 2)


def schema(**columns):
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# ---- cards ------------------------------------------------------------------

CARD_TEXT = [n for n in loyalty.CARD_COLUMNS if not n.endswith("Key") and n not in ("IsTest", "JoinDate")]


def raw_cards(spark, sf):
    """Customers as raw cards: most attributes are absent, three dates are text."""
    customer, orders = tables(spark, sf, "customer", "orders")
    issued = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    rows = customer.join(issued, F.col("c_custkey") == F.col("o_custkey"), "left")
    given = {
        "CARD_NUM": F.concat(F.lit("K"), "c_custkey"), "CARD_STATUS": F.col("c_mktsegment"), "FIRST_NAME_ENG": F.col("c_name"),
        "MEMBER_ID": F.concat(F.lit("M"), F.expr("c_custkey div 3")), "PROVINCE": F.col("c_nationkey").cast("string"),
    }
    text = F.date_format("first", "dd/MM/yyyy HH:mm:ss")
    return rows.select(
        *[given.get(n, F.lit(None).cast("string")).alias(n) for n in loyalty._CARD_RAW],
        text.alias("CARD_USSUED_DATE"), F.when(F.expr("c_custkey % 5 = 0"), "soon").otherwise(text).alias("CARD_EXPIRE_DATE"),
        text.alias("JoinDate"), F.coalesce(F.col("first"), F.lit("2024-01-01 20:00:00").cast("timestamp_ntz")).alias("CreatedDateTime"))


def test_cards(spark, sf):
    return tables(spark, sf, "orders").filter("o_totalprice > 400000").select(F.concat(F.lit("K"), "o_custkey").alias("cardnum"))


_CARDS = """
first as (select o_custkey, min(o_orderdate) as f from orders group by 1),
staged as (
  select c_custkey, 'K' || c_custkey as card, c_mktsegment as status, 'M' || (c_custkey // 3) as member, c_name as name,
    cast(c_nationkey as varchar) as province, f + interval 7 hours as issued,
    case when c_custkey % 5 <> 0 then f + interval 7 hours end as expires, coalesce(f, timestamp '2024-01-01 20:00:00') + interval 7 hours as loaded,
    case when exists (select 1 from orders o where o.o_custkey = c_custkey and o_totalprice > 400000) then 1 else 0 end as is_test
  from customer left join first on c_custkey = o_custkey)
"""


@case(f"""
with {_CARDS} select card, status, member, name, province, is_test, cast(strftime(issued, '%Y%m%d') as integer) as issued_day,
  cast(strftime(expires, '%Y%m%d') as integer) as expire_day, cast(strftime(loaded, '%Y%m%d') as integer) as load_day,
  cast(strftime(loaded, '%H%M%S') as integer) as load_time, strftime(issued, '%Y-%m-%d %H:%M:%S') as joined from staged""")
def card_staging(spark, sf):
    staged = loyalty.stage_cards(raw_cards(spark, sf), test_cards(spark, sf))
    return staged.select(*[F.col(a).alias(b) for a, b in {
        "CardNum": "card", "CardStatus": "status", "MemberID": "member", "FirstNameEng": "name", "Province": "province", "IsTest": "is_test",
        "CardIssuedDateKey": "issued_day", "CardExpireDateKey": "expire_day", "LoadDateKey": "load_day", "LoadTimeKey": "load_time",
        "JoinDate": "joined"}.items()])


def card_dimension(spark, sf):
    """Every second card is known: some with another status, some with another name, some also closed."""
    customer = tables(spark, sf, "customer")
    extra = ["StartDateKey", "StartTimeKey", "EndDateKey", "EndTimeKey", "CardProfileKey", "LastStatusMember"]
    fields = [T.StructField(n, S if n in CARD_TEXT or n == "JoinDate" else I) for n in loyalty.CARD_COLUMNS]
    whole = T.StructType(fields + [T.StructField(n, I) for n in extra] + [T.StructField("RegisSS", S), T.StructField("TRF_ETL", S)])

    def rows(keep, status, offset, start, end):
        given = {
            "CardNum": F.concat(F.lit("K"), "c_custkey"), "CardStatus": status, "MemberID": F.concat(F.lit("M"), F.expr("c_custkey div 3")),
            "FirstNameEng": F.when(F.expr("c_custkey % 6 = 0"), "before").otherwise(F.col("c_name")), "Province": F.col("c_nationkey").cast("string"),
            "StartDateKey": F.lit(start), "StartTimeKey": F.lit(0), "EndDateKey": F.lit(end), "EndTimeKey": F.lit(end) * 0,
            "CardProfileKey": F.col("c_custkey") * 2 + offset, "LastStatusMember": F.lit(0), "RegisSS": F.when(F.expr("c_custkey % 4 = 0"), "X"),
            "IsTest": F.lit(0), "CardIssuedDateKey": F.lit(20200101)}
        text = [n for n in CARD_TEXT if n not in given]
        filled = dict.fromkeys(text, F.lit("NA"))
        return customer.filter(keep).select(*[(given | filled).get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in whole])

    dim = rows("c_custkey % 2 = 0", F.when(F.expr("c_custkey % 8 = 0"), "Old").otherwise(F.col("c_mktsegment")), 0, 20230101, None)
    return dim.unionByName(rows("c_custkey % 10 = 0", F.lit("Older"), 1, 20220101, 20221231))


# In SQL only the columns that carry something.
_NUMBERED = f"""
with {_CARDS},
keys as (select staged.*, cast(strftime(issued, '%Y%m%d') as integer) as issued_day, cast(strftime(expires, '%Y%m%d') as integer) as expire_day from staged),
dim as (
  select c_custkey, 'K' || c_custkey as card, case when c_custkey % 8 = 0 then 'Old' else c_mktsegment end as status, 'M' || (c_custkey // 3) as member,
    case when c_custkey % 6 = 0 then 'before' else c_name end as name, 20230101 as start_day, cast(null as integer) as end_day,
    cast(c_custkey * 2 as integer) as profile, case when c_custkey % 4 = 0 then 'X' end as regis, 20200101 as issued_day, true as na from customer where c_custkey % 2 = 0
  union all
  select c_custkey, 'K' || c_custkey, 'Older', 'M' || (c_custkey // 3), case when c_custkey % 6 = 0 then 'before' else c_name end, 20220101, 20221231,
    cast(c_custkey * 2 + 1 as integer), case when c_custkey % 4 = 0 then 'X' end, 20200101, true from customer where c_custkey % 10 = 0),
-- status step
j as (select d.*, k.card as hit, k.status as new_status, k.name as new_name, k.issued_day as new_issued, k.card is not null and k.status <> d.status as chg
      from dim d left join keys k on d.card = k.card and d.end_day is null),
two as (
  select c_custkey, card, status, member, name, start_day, case when chg then 20240615 else end_day end as end_day, profile, regis, issued_day from j
  union all
  select c_custkey, card, new_status, member, new_name, 20240615, null, null, null, new_issued from j where chg),
-- attribute step: known open rows lack join and expiry keys or have another name, fresh ones lack the 'NA' texts, so all of them change
one as (
  select t.c_custkey, t.card, case when k.card is not null then k.status else t.status end as status, t.member,
    case when k.card is not null then k.name else t.name end as name, start_day, end_day, profile,
    case when k.card is null then regis end as regis, case when k.card is not null then k.issued_day else t.issued_day end as issued_day
  from two t left join keys k on t.card = k.card and t.end_day is null
  union all
  select c_custkey, card, status, member, name, 20240615, null, null, null, issued_day from keys where c_custkey % 2 = 1),
numbered as (
  select * from one where profile is not null
  union all
  select c_custkey, card, status, member, name, start_day, end_day,
    cast((select max(profile) from dim) + row_number() over (order by card, start_day) as integer), regis, issued_day from one where profile is null)
"""
_PROFILE = _NUMBERED + """
select card, status, member, name, start_day, end_day, profile, regis, issued_day,
  case when end_day is null and row_number() over (partition by member order by start_day desc, issued_day desc nulls last, profile desc) = 1 then 1 else 0 end as latest
from numbered
"""


@case(_PROFILE)
def card_profile(spark, sf):
    staged = loyalty.stage_cards(raw_cards(spark, sf), test_cards(spark, sf))
    updated = loyalty.update_cards(card_dimension(spark, sf), staged, AS_OF)
    return updated.select(*[F.col(a).alias(b) for a, b in {
        "CardNum": "card", "CardStatus": "status", "MemberID": "member", "FirstNameEng": "name", "StartDateKey": "start_day",
        "EndDateKey": "end_day", "CardProfileKey": "profile", "RegisSS": "regis", "CardIssuedDateKey": "issued_day", "LastStatusMember": "latest"}.items()])


# ---- transactions -----------------------------------------------------------

FACT = schema(
    TxnId=S, CardProfileKey=I, ProductKey=I, MerchandiseKey=I, TransDateKey=I, TransTimeKey=I, ProcessDateKey=I, TransType=S, TransSubType=S,
    TransStatus=S, CancelledTxnId=S, Amount=D, PointBeforeAward=D, AwardPoint=D, RedeemPoint=D, RemainingPoint=D, TerminalId=S, MemberID=S,
    TransYearKey=I, TransMonthKey=I)


def raw_transactions(spark, sf):
    """An order is a transaction of its customer's card; two of its attributes are sometimes absent."""
    orders = tables(spark, sf, "orders")
    none = F.lit(None).cast("string")
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    return orders.select(
        F.concat(F.lit("T"), "o_orderkey").alias("TXN_ID"), F.concat(F.lit("K"), "o_custkey").alias("CARD_NUM"),
        F.when(F.expr("o_orderkey % 11 <> 0"), F.concat(F.lit("P"), F.expr("o_orderkey % 60"))).alias("PRODUCT_ID"),
        F.when(F.expr("o_orderkey % 4 <> 0"), F.concat(F.lit("R"), F.expr("o_orderkey % 30"))).alias("MERCHANT_ROW_ID"),
        F.when(F.expr("o_orderkey % 9 <> 0"), F.col("o_orderstatus")).alias("TRANS_STATUS"), F.lit("ACCRUAL").alias("TRANS_TYPE"), F.lit("Product").alias("TRANS_SUB_TYPE"),
        none.alias("CANCELLED_TXN_ID"), none.alias("TERMINAL_ID"), F.concat(F.lit("M"), F.expr("o_custkey div 3")).alias("MEMBER_ID"),
        cents.alias("AMOUNT"), cents.alias("POINT_BEFORE_AWARD"), F.lit(10).cast("decimal(18,2)").alias("AWARD_POINT"),
        F.when(F.expr("o_orderkey % 7 <> 0"), F.lit(3)).cast("decimal(18,2)").alias("REDEEM_POINT"), F.lit(None).cast("decimal(18,2)").alias("REMAINING_POINT"),
        F.col("o_orderdate").alias("CREATED"), F.col("o_orderdate").alias("LAST_UPD"), F.col("o_orderdate").alias("LoadDateTime"),
        F.when(F.expr("o_orderkey % 13 <> 0"), F.col("o_orderdate")).alias("PROCESS_DATE"), (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey") % 24)).alias("TRANS_DATE"))


def _programme(spark, sf):
    """Products, the mapping of their codes, and merchants."""
    nation, part = tables(spark, sf, "nation", "part")
    products = part.select((F.expr("p_partkey % 60")).cast("int").alias("ProductKey")).distinct().withColumn(
        "ProductGroup", F.when(F.expr("ProductKey % 2 = 0"), "POINT").otherwise("LUBE"))
    mapping = products.filter("ProductKey % 7 <> 0").select(
        F.lit("LOYAL").alias("SourceName"), F.lit("TRANSACTION").alias("SourceFile"),
        F.concat(F.lit("P"), "ProductKey").alias("SourceKey"), F.col("ProductKey").alias("MappingKey"))
    # Transactions without a product code use code 0.
    nil = mapping.filter("MappingKey = 1").withColumns({"SourceKey": F.lit("0"), "MappingKey": F.lit(0)})
    merchants = nation.select(F.concat(F.lit("R"), "n_nationkey").alias("RowId"), F.col("n_nationkey").cast("int").alias("MerchandiseKey"))
    merchants = merchants.unionByName(merchants.filter("MerchandiseKey = 0").withColumns({"RowId": F.lit("NA"), "MerchandiseKey": F.lit(999)}))
    return products, mapping.unionByName(nil), merchants


def _resolved(spark, sf):
    cards = tables(spark, sf, "customer").filter("c_custkey % 10 <> 3").select(
        F.concat(F.lit("K"), "c_custkey").alias("CardNum"), F.col("c_custkey").cast("int").alias("CardProfileKey"), F.lit(None).cast("int").alias("EndDateKey"))
    products, mapping, merchants = _programme(spark, sf)
    groups = loyalty.product_groups(mapping, products, "LOYAL")
    return loyalty.resolve_transactions(raw_transactions(spark, sf), cards, groups, merchants)


_TXN = """
raw as (
  select o_orderkey as k, o_custkey, case when o_orderkey % 11 <> 0 then o_orderkey % 60 end as p, case when o_orderkey % 4 <> 0 then 'R' || (o_orderkey % 30) end as shop,
    o_orderdate + interval 7 hours as d, o_orderdate + (o_orderkey % 24 + 7) * interval 1 hour as td,
    cast(o_totalprice as decimal(18,2)) as amount, case when o_orderkey % 7 <> 0 then cast(3 as decimal(18,2)) end as redeem, o_orderstatus as status from orders),
prod as (select distinct cast(p_partkey % 60 as integer) as m, case when p_partkey % 60 % 2 = 0 then 'POINT' else 'LUBE' end as grp from part where p_partkey % 60 % 7 <> 0),
s1 as (select raw.*, c_custkey as card from raw left join customer on o_custkey = c_custkey and c_custkey % 10 <> 3),
s2 as (select s1.*, case when card is not null then case when p is null then 0 else m end end as m, case when p is null then 'POINT' else grp end as grp
       from s1 left join prod on p = m),
s3 as (select s2.*, case when grp = 'POINT' and (m <> 38 or shop is null) then 'NA' else shop end as shop2 from s2),
s4 as (select s3.*, case when shop2 = 'NA' then 999 else n_nationkey end as merchant from s3 left join nation on shop2 = 'R' || n_nationkey),
txn as (select *, case when card is null then 'Mismatch MembershipKey' when m is null then 'Mismatch ProductKey' when merchant is null then 'Mismatch MerchandiseKey' end as error from s4)
"""


@case(f"""
with {_TXN}
select 'T' || k as txn, cast(card as integer) as card, cast(m as integer) as product, merchant, cast(strftime(td, '%Y%m%d') as integer) as day, cast(strftime(td, '%H%M%S') as integer) as clock,
  case when k % 13 = 0 then 20180101 else cast(strftime(d, '%Y%m%d') as integer) end as process_day, case when k % 9 = 0 then 'NA' else status end as status,
  cast(amount + 10 - coalesce(redeem, 0) as double) as remaining, cast(coalesce(redeem, 0) as double) as redeem, 'NA' as terminal, 'M' || (o_custkey // 3) as member,
  cast(strftime(td, '%Y') as integer) as year, cast(strftime(td, '%m') as integer) as month from txn where error is null""")
def transaction_load(spark, sf):
    rows = loyalty.transaction_rows(_resolved(spark, sf).matched, FACT)
    rows = rows.withColumns({"RemainingPoint": number("RemainingPoint"), "RedeemPoint": number("RedeemPoint")})
    return rows.select(*[F.col(a).alias(b) for a, b in {
        "TxnId": "txn", "CardProfileKey": "card", "ProductKey": "product", "MerchandiseKey": "merchant", "TransDateKey": "day", "TransTimeKey": "clock",
        "ProcessDateKey": "process_day", "TransStatus": "status", "RemainingPoint": "remaining", "RedeemPoint": "redeem", "TerminalId": "terminal", "MemberID": "member",
        "TransYearKey": "year", "TransMonthKey": "month"}.items()])


@case(f"with {_TXN} select 'T' || k as txn, error from txn where error is not null")
def transaction_rejects(spark, sf):
    return _resolved(spark, sf).rejected.select(F.col("TXN_ID").alias("txn"), F.col("Error").alias("error"))


@case(f"""
with {_TXN},
fact as (select 'T' || k as txn, 'fact' as origin from txn where error is null and k % 3 <> 0),
today as (select 'T' || o_orderkey as txn, 'today' as origin from orders where o_orderkey % 100 = 1),
fresh as (select 'T' || k as txn from txn where error is null and k % 2 = 0)
select txn, case when txn in (select txn from fresh) then 'UPDATED' else 'NOT MATCHED' end as action from
  (select txn from fact union all select txn from today)
union all select txn, 'INSERT' from fresh where txn not in (select txn from fact) and txn not in (select txn from today)""")
def transaction_merge(spark, sf):
    rows = loyalty.transaction_rows(_resolved(spark, sf).matched, FACT)
    number_of = F.substring("TxnId", 2, 20).cast("bigint")
    fact = rows.filter(number_of % 3 != 0)
    today = raw_transactions(spark, sf).select(F.col("TXN_ID").alias("TxnId")).filter(number_of % 100 == 1)
    merged = loyalty.merge_transactions(fact, today, rows.filter(number_of % 2 == 0), action="action")
    return merged.select(F.col("TxnId").alias("txn"), "action")


@case(f"""
with {_TXN},
old as (select 'T' || k as txn, 'Mismatch ProductKey' as error from txn where k % 5 = 0),
fresh as (select 'T' || k as txn, error from txn where error is not null),
merged as (select coalesce(old.txn, fresh.txn) as txn, coalesce(fresh.error, old.error) as error from old full join fresh on old.txn = fresh.txn)
select * from merged where txn not in (select 'T' || k from txn where error is null)""")
def transaction_quarantine(spark, sf):
    split = _resolved(spark, sf)
    old = raw_transactions(spark, sf).filter(F.substring("TXN_ID", 2, 20).cast("bigint") % 5 == 0).select("TXN_ID", F.lit("Mismatch ProductKey").alias("Error"))
    fact = loyalty.transaction_rows(split.matched, FACT)
    return loyalty.merge_rejects(old, split, fact).toDF("txn", "error")


# ---- registrations ----------------------------------------------------------

# A line is a transaction; a fifth of the products registers a card, another fifth is a purchase.
_LINES = """
lines as (
  select 'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || cast(l_quantity as integer) as txn, cast(o_custkey as integer) as profile,
    case l_partkey % 5 when 0 then 38 when 1 then 41 else 7 end as product, cast(strftime(l_shipdate, '%Y%m%d') as integer) as day,
    cast((l_linenumber * 10000 + l_quantity) as integer) as clock, cast(l_suppkey as integer) as shop, l_returnflag
  from lineitem join orders on l_orderkey = o_orderkey),
signed as (select * from (select 'K' || (profile // 2) as card, *, row_number() over (partition by profile // 2 order by day, clock, txn) as r from lines
  where product = 38) where r = 1)
"""


def _lines(spark, sf):
    line, orders = tables(spark, sf, "lineitem", "orders")
    joined = line.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = F.expr("l_partkey % 5")
    return joined.select(
        F.concat(F.lit("T"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))).alias("TxnId"),
        F.col("o_custkey").cast("int").alias("CardProfileKey"), F.when(kind == 0, 38).when(kind == 1, 41).otherwise(7).alias("ProductKey"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("TransDateKey"), (F.col("l_linenumber") * 10000 + F.col("l_quantity")).cast("int").alias("TransTimeKey"),
        F.col("l_suppkey").cast("int").alias("MerchandiseKey"), F.lit("t").alias("TerminalId"), F.lit(1).alias("AwardPoint"),
        F.lit("ACCRUAL").alias("TransType"), F.lit("Product").alias("TransSubType"), F.when(F.col("l_returnflag") == "R", "Void").otherwise("Processed").alias("TransStatus"),
        F.when(F.col("l_returnflag") == "A", "NA").otherwise("C").alias("CancelledTxnId"), F.concat(F.lit("M"), F.expr("o_custkey div 3")).alias("MemberID"))


def _register_schema():
    return schema(cardnum=S, RegisterationTxnId=S, RegistrationProcessDateKey=I, RegistrationProcessTimeKey=I, FirstTransTxnId=S,
                  FirstTransProcessDateKey=I, FirstTransProcessTimeKey=I, MerchandiseKey=I, LastUpdDateKey=I, LastUpdTimeKey=I, MemberID=S,
                  RegisMerchandiseKey=I, RegisTerminalId=S)


def _cards(spark, sf):
    """Two profile rows per card number, as history gives."""
    return tables(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("CardProfileKey"), F.concat(F.lit("K"), F.expr("c_custkey div 2")).alias("CardNum"),
        F.concat(F.lit("M"), F.expr("c_custkey div 3")).alias("MemberID"), F.col("c_mktsegment").alias("CardStatus"),
        F.when(F.expr("c_custkey % 2 = 0"), 20230101).alias("EndDateKey"), F.lit(20200101).alias("JoinDateKey"),
        F.when(F.expr("c_custkey % 5 = 0"), "KNOWN").alias("RegisSS"))


def _register(spark, sf):
    cards = _cards(spark, sf).select(F.col("CardNum").alias("cardnum")).distinct().filter("cast(substring(cardnum, 2) as int) % 3 <> 0")
    known = cards.withColumn("RegisterationTxnId", F.when(F.expr("cast(substring(cardnum, 2) as int) % 4 = 0"), "T-old"))
    names = _register_schema()
    old = F.col("RegisterationTxnId").isNotNull()
    given = {"cardnum": F.col("cardnum"), "RegisterationTxnId": F.col("RegisterationTxnId"), "RegistrationProcessDateKey": F.when(old, 19960101), "RegistrationProcessTimeKey": F.when(old, 507)}
    return known.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in names])


_REGISTER = f"""
with {_LINES},
cards as (select distinct 'K' || (c_custkey // 2) as card, c_custkey // 2 as n from customer),
reg as (select card, case when n % 3 <> 0 and n % 4 = 0 then 'T-old' else s.txn end as txn, case when n % 3 <> 0 and n % 4 = 0 then 19960101 else s.day end as day,
  case when n % 3 <> 0 and n % 4 = 0 then 507 else s.clock end as clock, case when n % 3 <> 0 and n % 4 = 0 then null else 20240615 end as changed,
  case when n % 3 <> 0 and n % 4 = 0 then null else s.shop end as shop, n from cards left join signed s using (card))
"""


@case(_REGISTER + "select card, txn, day, clock, changed, shop from reg")
def card_registration(spark, sf):
    done = loyalty.register_cards(_register(spark, sf), _cards(spark, sf), _lines(spark, sf), AS_OF)
    return done.select(*[F.col(a).alias(b) for a, b in {"cardnum": "card", "RegisterationTxnId": "txn", "RegistrationProcessDateKey": "day",
                                                        "RegistrationProcessTimeKey": "clock", "LastUpdDateKey": "changed", "RegisMerchandiseKey": "shop"}.items()])


@case(_REGISTER + """,
later as (select reg.card, l.txn, l.day, l.clock, row_number() over (partition by reg.card order by l.day, l.clock, l.txn) as r
  from reg join lines l on reg.card = 'K' || (l.profile // 2) and reg.day * 1000000::bigint + reg.clock < l.day * 1000000::bigint + l.clock
  where l.product = 41 and l_returnflag <> 'R')
select reg.card, reg.txn, later.txn as first_txn, later.day as first_day from reg left join later on reg.card = later.card and r = 1""")
def first_purchase(spark, sf):
    cards, lines = _cards(spark, sf), _lines(spark, sf)
    registered = loyalty.register_cards(_register(spark, sf), cards, lines, AS_OF)
    products = tables(spark, sf, "part").select(
        F.when(F.expr("p_partkey % 2 = 0"), 41).otherwise(7).alias("ProductKey"), F.lit("OTHER").alias("ProductGroup"), F.lit(1).alias("used"))
    done = loyalty.first_purchases(registered, cards, lines, loyalty.purchase_products(products, "used"), AS_OF)
    return done.select(*[F.col(a).alias(b) for a, b in {"cardnum": "card", "RegisterationTxnId": "txn", "FirstTransTxnId": "first_txn",
                                                        "FirstTransProcessDateKey": "first_day"}.items()])


@case(_REGISTER + """
select reg.card, case when reg.txn is not null and changed = 20240615 and c.c_custkey is not null then 'M' || (c.c_custkey // 3) end as member from reg
left join customer c on c.c_custkey // 2 = reg.n and c.c_custkey % 2 = 1 and c.c_custkey // 3 <> 7""")
def member_backfill(spark, sf):
    cards = _cards(spark, sf)
    registered = loyalty.register_cards(_register(spark, sf), cards, _lines(spark, sf), AS_OF)
    return loyalty.backfill_members(registered, cards, AS_OF, "M7").select(F.col("cardnum").alias("card"), F.col("MemberID").alias("member"))


# ---- merchants, products, terminals, labels, flags, items ------------------------


def _terminals(spark, sf):
    customer = tables(spark, sf, "customer")

    def rows(keep, mid, status):
        return customer.filter(keep).select(F.concat(F.lit("t"), "c_custkey").alias("TID"), mid.alias("MID"), status.alias("TID_Status"),
                                            F.lit("2024-01-01 20:00:00").cast("timestamp_ntz").alias("LoadDate"), F.lit("2024-01-01 20:00:00").cast("timestamp_ntz").alias("UpdateDate"))

    target = rows("c_custkey % 2 = 0", F.concat(F.lit("m"), "c_nationkey"), F.nullif("c_mktsegment", F.lit("BUILDING")))
    moved = F.when(F.expr("c_custkey % 9 = 0"), "moved").otherwise(F.concat(F.lit("M"), "c_nationkey"))
    return target, rows("c_custkey % 3 = 0 or c_custkey % 2 = 1", moved, F.nullif("c_mktsegment", F.lit("FURNITURE")))


@case("""
with d as (select c_custkey as k, 'M' || c_nationkey as mid, nullif(c_mktsegment, 'BUILDING') as st from customer where c_custkey % 2 = 0),
s as (select c_custkey as k, case when c_custkey % 9 = 0 then 'MOVED' else 'M' || c_nationkey end as mid, nullif(c_mktsegment, 'FURNITURE') as st from customer where c_custkey % 3 = 0 or c_custkey % 2 = 1),
j as (select coalesce(d.k, s.k) as k, d.k as dk, s.k as sk, d.mid as dm, s.mid as sm, d.st as ds, s.st as ss,
  d.k is null or (s.k is not null and (d.mid <> s.mid or d.st is distinct from s.st)) as chg from d full join s on d.k = s.k)
select 'T' || k as tid, case when chg then sm else dm end as mid, case when chg then ss else ds end as status,
  case when chg then 20240102 else 20240101 end as load_day, case when dk is null then 'INSERT' when chg then 'UPDATE' when sk is null then 'SAME IN TARGET' else 'SAME IN MATCHED' end as action from j""")
def terminal_dimension(spark, sf):
    target, source = _terminals(spark, sf)
    done = loyalty.update_terminals(target, source, action="action")
    return done.select(F.col("TID").alias("tid"), F.col("MID").alias("mid"), F.col("TID_Status").alias("status"),
                       F.date_format("LoadDate", "yyyyMMdd").cast("int").alias("load_day"), "action")


@case("""
with src as (select cast(c_custkey as varchar) as id, nullif(c_mktsegment, 'BUILDING') as loc, c_name as mid from customer where c_custkey % 7 <> 0),
t as (select cast(c_custkey as varchar) as id, c_mktsegment as loc, case when c_custkey % 4 = 0 then 'x' else c_name end as mid, cast(c_custkey as integer) as k from customer where c_custkey % 2 = 0 or c_custkey % 7 = 0),
m as (select coalesce(t.id, src.id) as id, case when src.id is not null then src.loc else t.loc end as loc, case when src.id is not null then src.mid else t.mid end as mid, k,
  case when t.id is null or (src.id is not null and (t.loc is distinct from src.loc or t.mid <> src.mid)) then 20240615 else 20240101 end as loaded from t full join src on t.id = src.id)
select id, loc, mid, loaded, k as merchandise_key from m where k is not null
union all select id, loc, mid, loaded, cast((select max(k) from t) + row_number() over (order by id) as integer) from m where k is null""")
def merchant_dimension(spark, sf):
    customer = tables(spark, sf, "customer")
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    same = {name: F.lit(None).cast("string") for name in loyalty._MERCHANT_SAME}
    raw = {**{theirs: F.lit("a") for theirs in loyalty._MERCHANT_NAMES.values()}, "LOC": F.nullif("c_mktsegment", F.lit("BUILDING")), "MID": F.col("c_name")}
    staged = customer.filter("c_custkey % 7 <> 0").select(
        F.concat(F.lit(" "), "c_custkey").alias("ROW_ID"), *[v.alias(n) for n, v in {**raw, **same}.items()], moment.alias("LAST_UPD"), moment.alias("MID_CreateDate"))
    own = {**{mine: F.lit("a") for mine in loyalty._MERCHANT_NAMES}, "Loc": F.col("c_mktsegment"), "Mid": F.when(F.expr("c_custkey % 4 = 0"), "x").otherwise(F.col("c_name"))}
    keys = {"LastUpdDateKey": 20240101, "LastUpdTimeKey": 0, "MID_CreateDate": 20240101, "MID_CreateTime": 0, "LoadDateKey": 20240101, "LoadTimeKey": 0}
    dimension = customer.filter("c_custkey % 2 = 0 or c_custkey % 7 = 0").select(
        F.col("c_custkey").cast("string").alias("RowId"), F.col("c_custkey").cast("int").alias("MerchandiseKey"),
        *[v.alias(n) for n, v in {**own, **same}.items()], *[F.lit(v).alias(n) for n, v in keys.items()])
    done = loyalty.update_merchants(dimension, staged, AS_OF)
    return done.select(F.col("RowId").alias("id"), F.col("Loc").alias("loc"), F.col("Mid").alias("mid"), F.col("LoadDateKey").alias("loaded"), F.col("MerchandiseKey").alias("merchandise_key"))


@case("""
with t as (select cast(p_partkey as varchar) as id, cast(p_partkey + 5 as integer) as k from part where p_partkey % 3 = 0 or p_partkey % 5 = 0),
j as (select p.p_partkey, t.k, p_name from (select * from part where p_partkey % 5 <> 0) p left join t on cast(p.p_partkey as varchar) = t.id)
select k as product_key, cast(p_partkey as varchar) as id, p_name as name, 20240101 as created from j where k is not null
union all select cast((select max(k) from t) + row_number() over (order by cast(p_partkey as varchar)) as integer), cast(p_partkey as varchar), p_name, 20240101 from j where k is null""")
def product_dimension(spark, sf):
    part = tables(spark, sf, "part")
    moment = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    staged = part.filter("p_partkey % 5 <> 0").select(F.concat("p_partkey", F.lit(" ")).alias("ROW_ID"), F.col("p_name").alias("NAME"), F.lit("u").alias("CREATED_BY"),
                                                     moment.alias("CREATED"), moment.alias("LAST_UPD"), moment.alias("LoadDateTime"))
    dimension = part.filter("p_partkey % 3 = 0 or p_partkey % 5 = 0").select(
        (F.col("p_partkey") + 5).cast("int").alias("ProductKey"), F.col("p_partkey").cast("string").alias("rowid"), F.lit("old").alias("Name"), F.lit("u").alias("CreatedBy"),
        *[F.lit(0).alias(n) for n in ("CreatedDateKey", "CreatedTimeKey", "LastUpdDateKey", "LastUpdTimeKey", "LoadDateKey", "LoadTimeKey")])
    done = loyalty.update_products(dimension, staged)
    return done.select(F.col("ProductKey").alias("product_key"), F.col("rowid").alias("id"), F.col("Name").alias("name"), F.col("CreatedDateKey").alias("created"))


_LABEL = loyalty.StationLabel("C7", "NATION_1", "IN", "OUT")


@case(f"""
with cards as (select c_custkey, 'K' || (c_custkey // 2) as card, 'M' || (c_custkey // 3) as member, c_mktsegment as status,
  case when c_custkey % 2 = 0 then 20230101 end as ended, case when c_custkey % 5 = 0 then 'KNOWN' end as regis from customer),
reg as (select distinct 'K' || (c_custkey // 2) as card, c_custkey // 2 % 30 as shop, case when c_custkey // 2 % 2 = 0 then 20240615 end as changed from customer where c_custkey // 2 % 3 <> 0),
label as (select n_nationkey as shop, case when 'C' || n_nationkey = 'C7' or substr(n_name, 1, 8) = 'NATION_1' then 'IN' else 'OUT' end as l from nation),
c1 as (select card, member, l from cards join reg using (card) left join label using (shop) where ended is null and member <> 'M7' and status <> 'BUILDING' and changed = 20240615),
f1 as (select member, l from (select *, row_number() over (partition by member order by card, l) as r from c1) where r = 1),
v1 as (select f1.member, case when n = 0 then l when n = 1 then one else 'ERR' end as v from f1
  join (select member, count(distinct regis) as n, min(regis) as one from cards where status <> 'BUILDING' group by 1) using (member)),
k2 as (select cards.* exclude (regis), case when v1.member is not null then v else regis end as regis from cards left join v1 using (member)),
c2 as (select card, member, l from k2 join reg using (card) left join label using (shop) where ended is null and member <> 'M7' and status <> 'BUILDING' and regis is null),
f2 as (select member, l from (select *, row_number() over (partition by member order by card, l) as r from c2) where r = 1),
v2 as (select f2.member, case when n = 0 then l when n = 1 then one else 'ERR' end as v from f2
  join (select member, count(distinct regis) as n, min(regis) as one from k2 where status <> 'BUILDING' group by 1) using (member))
select c_custkey, case when v2.member is not null then v else regis end as regis from k2 left join v2 using (member)""")
def registration_labels(spark, sf):
    customer, nation = tables(spark, sf, "customer", "nation")
    cards = _cards(spark, sf).withColumn("CardStatus", F.when(F.col("CardStatus") == "BUILDING", "New").otherwise(F.col("CardStatus")))
    half = F.expr("cast(c_custkey div 2 as int)")
    register = customer.select(half.alias("n")).distinct().filter("n % 3 <> 0").select(
        F.concat(F.lit("K"), "n").alias("cardnum"), (F.col("n") % 30).alias("RegisMerchandiseKey"), F.when(F.expr("n % 2 = 0"), 20240615).alias("LastUpdDateKey"))
    merchants = nation.select(F.col("n_nationkey").alias("MerchandiseKey"), F.concat(F.lit("C"), "n_nationkey").alias("CustomerCode"),
                              F.concat(F.lit(" "), "n_name").alias("MidNameEn"))
    done = loyalty.update_station_labels(cards, register, merchants, "M7", AS_OF, _LABEL, _LABEL)
    return done.select(F.col("CardProfileKey").cast("bigint").alias("c_custkey"), F.col("RegisSS").alias("regis"))


@case(f"""
with {_LINES} select c_custkey, case when 'M' || (c_custkey // 3) in (select 'M' || (profile // 3) from lines where product = 41 and l_returnflag = 'A') then 'Y' end as flag from customer""")
def member_flags(spark, sf):
    products = tables(spark, sf, "part").select(F.when(F.expr("p_partkey % 2 = 0"), 41).otherwise(7).alias("ProductKey"), F.lit(1).alias("used")).distinct()
    cards = _cards(spark, sf).withColumn("Flag", F.lit(None).cast("string"))
    done = loyalty.flag_members(cards, _lines(spark, sf), products, 41, "used", "Flag")
    return done.select(F.col("CardProfileKey").cast("bigint").alias("c_custkey"), F.col("Flag").alias("flag"))


@case("""
with t as (select o_orderkey as k, o_orderpriority as p from orders where o_orderkey % 2 = 0), s as (select o_orderkey as k, case when o_orderkey % 6 = 0 then '' else o_orderstatus end as p from orders where o_orderkey % 3 = 0 or o_orderkey % 2 = 1)
select cast(coalesce(s.k, t.k) as varchar) as id, case when s.k is not null then s.p else t.p end as kind, case when s.k is not null then 20240101 else 1 end as expires,
  case when t.k is null then 'INSERT' when s.k is null then 'SAME' else 'UPDATE' end as action from t full join s on t.k = s.k""")
def accrual_items(spark, sf):
    orders = tables(spark, sf, "orders")
    fact = orders.filter("o_orderkey % 2 = 0").select(F.concat(F.lit(" "), "o_orderkey").alias("PointItem_RowID"), F.col("o_orderpriority").alias("kind"), F.lit(1).alias("Expiration_Date"))
    staged = orders.filter("o_orderkey % 3 = 0 or o_orderkey % 2 = 1").select(F.concat("o_orderkey", F.lit(" ")).alias("PointItem_RowID"), F.when(F.expr("o_orderkey % 6 <> 0"), F.col("o_orderstatus")).alias("kind"),
                                                       F.lit(20240101).alias("EXPIRATION_DT"))
    return loyalty.merge_accrual_items(fact.unionByName(fact), staged, action="action").toDF("id", "kind", "expires", "action")


@case("""
select cast(o_orderkey as varchar) as id, cast(case when o_orderkey % 3 = 0 or o_orderkey % 2 = 1 then strftime(o_orderdate, '%Y') else '0000' end as varchar) as year_key from orders""")
def redemption_items(spark, sf):
    orders = tables(spark, sf, "orders")
    moment = F.lit("1990-01-01").cast("timestamp_ntz")
    fact = orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("REDEEM_ROW_ID"), moment.alias("TRANSACTION_DATE"), F.lit("0000").alias("YearKey"))
    staged = orders.filter("o_orderkey % 3 = 0 or o_orderkey % 2 = 1").select(F.col("o_orderkey").cast("string").alias("REDEEM_ROW_ID"), F.col("o_orderdate").alias("TXN_DT"))
    return loyalty.merge_redemption_items(fact, staged).select(F.col("REDEEM_ROW_ID").alias("id"), F.col("YearKey").alias("year_key"))


@case("""select o_orderkey, case when cast(strftime(o_orderdate, '%Y%m%d') as integer) >= 19980615 then 'today' else 'before' end as part from orders""")
def transaction_split(spark, sf):
    orders = tables(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("TransDateKey"))
    today, before = loyalty.split_transactions(orders, "1998-06-14 20:00:00")
    return today.select("o_orderkey", F.lit("today").alias("part")).unionByName(before.select("o_orderkey", F.lit("before").alias("part")))


# ---- history -------------------------------------------------------------------

HISTORY = schema(TxnId=L, Amount=D, TransYearKey=I, TransMonthKey=I, TransType=S, TransStatus=S)


def _history_rows(spark, sf):
    """Orders as transactions; a month stands for its quarter."""
    orders = tables(spark, sf, "orders")
    return orders.select(F.col("o_orderkey").alias("TxnId"), F.col("o_totalprice").cast("decimal(18,2)").alias("Amount"), F.year("o_orderdate").alias("TransYearKey"),
                         F.quarter("o_orderdate").alias("TransMonthKey"), F.lit("ACCRUAL").alias("TransType"), F.col("o_orderstatus").alias("TransStatus"))


@case("""
with rows as (select o_orderkey as txn, cast(o_totalprice as decimal(18,2)) as amount, cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as month,
  o_orderstatus as status from orders)
select txn, cast(case when year in (1995, 1996) and txn % 3 = 0 then -amount else amount end as double) as amount, year, month,
  case when year in (1995, 1996) and txn % 3 = 0 then 'Cancelled' else status end as status from rows""")
def loyalty_history_merge(spark, sf):
    """Two years' transactions come again with another status, some for the first time: their rows change partition, the other years' lie untouched."""
    rows = _history_rows(spark, sf)
    again = (F.col("TransYearKey").isin(1995, 1996)) & (F.col("TxnId") % 3 == 0)
    kept = locator.History(spark, scratch_path(spark, "history"), HISTORY, "TxnId", loyalty.TXN_PARTITIONS, buckets=16)
    kept.merge(rows.filter(~(again & (F.col("TxnId") % 2 == 0))))
    kept.merge(rows.filter(again).withColumns({"TransStatus": F.lit("Cancelled"), "Amount": (-F.col("Amount")).cast("decimal(18,2)")}))
    return kept.rows().select(F.col("TxnId").alias("txn"), number("Amount").alias("amount"), F.col("TransYearKey").alias("year"), F.col("TransMonthKey").alias("month"),
                              F.col("TransStatus").alias("status"))


# ---- the whole load ----------------------------------------------------------------


@case(_NUMBERED + "," + _TXN.replace("select raw.*, c_custkey as card from raw left join customer on o_custkey = c_custkey and c_custkey % 10 <> 3",
                                     "select raw.*, profile as card from raw left join numbered on 'K' || o_custkey = numbered.card and end_day is null") + """
select 'T' || k as txn, cast(card as integer) as card, cast(m as integer) as product, merchant, cast(amount + 10 - coalesce(redeem, 0) as double) as remaining from txn where error is null
union all select 'T' || o_orderkey, -1, -1, -1, 0.0 from orders where (o_orderkey % 100 = 1) and 'T' || o_orderkey not in (select 'T' || k from txn where error is null)""")
def loyalty_chain_fact(spark, sf):
    """Cards, transactions, registrations and members in their order; the run stops after the cards and goes on where it stopped."""
    root = scratch_path(spark, "loyalty")
    products, mapping, merchants = _programme(spark, sf)
    old = raw_transactions(spark, sf).select(F.col("TXN_ID").alias("TxnId")).filter(F.substring("TxnId", 2, 20).cast("bigint") % 100 == 1)
    none = {"CardProfileKey": F.lit(-1), "ProductKey": F.lit(-1), "MerchandiseKey": F.lit(-1), "RemainingPoint": F.lit(0)}
    fact = old.select(*[(F.col("TxnId") if f.name == "TxnId" else none.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in FACT])
    rejects = spark.createDataFrame([], schema(TXN_ID=S, Error=S))
    start = {"merchants": merchants, "products": products.withColumn("used", F.lit(1)), "cards": card_dimension(spark, sf), "fact": fact, "rejects": rejects,
             "register": spark.createDataFrame([], _register_schema())}
    given = loyalty.Arrivals(cards=raw_cards(spark, sf), test_cards=test_cards(spark, sf), transactions=raw_transactions(spark, sf), mapping=mapping)
    todo = loyalty.load_steps(given, loyalty.Rules("LOYAL", "M7", "used"), AS_OF)
    steps.run_steps(spark, root, "20240615", todo[:1], start)
    done = steps.run_steps(spark, root, "20240615", todo, start)["fact"]
    return done.select(F.col("TxnId").alias("txn"), F.col("CardProfileKey").alias("card"), F.col("ProductKey").alias("product"), F.col("MerchandiseKey").alias("merchant"),
                       number("RemainingPoint").alias("remaining"))
