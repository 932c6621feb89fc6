"""Panel routing, prices, fallbacks, valorisation, period split."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.operators import pricing, quality
from tradeloom.plans import valorise
from verification import views
from verification.registry import FLOAT, query

SPECIAL = " or ".join(f"sellout_dm like '{p}'" for p in pricing.SPECIAL_FAMILY_PATTERNS)
FLAG = f"""case when coalesce(quantity, 0) <= 0 or coalesce(fx_transaction_lc, 0) <= 0 then 1
  when {SPECIAL} then 2 else 0 end"""

LINES = f"""
lines as (
  select *, year(date) as _year, case when month(date) <= 6 then 'H1' else 'H2' end as _semester,
    upper(trim(destination_country)) as _dest_key,
    case when channel in ('Wholesale', 'Fabbricante') then
        case when company_type in ('manufacturer', 'transparence') then 'sellin_producer'
          when company_type = 'dealer' then 'sellin_dealer' else 'unrouted' end
      when channel is null then 'unrouted' else 'sellout' end as panel_segment,
    {FLAG} as flag
  from {{valued_facts}})"""


def lines(i):
    return pricing.split_panel(pricing.with_price_columns(i.valued_facts))


def stored_lines(i):
    """Lines for plans that scan the harmonised table several times."""
    return pricing.split_panel(pricing.with_price_columns(i.stored("valued_facts")))


def _flag():
    return pricing.anomaly_flag(
        F.col("fx_transaction_lc"), F.col("quantity"), F.col("sellout_dm")
    )


@query(
    "sellin_sellout_split",
    f"""with {LINES} select order_key, line_no, item_code, company, channel, panel_segment
    from lines""",
)
def sellin_sellout_split(i):
    return lines(i).select(
        "order_key", "line_no", "item_code", "company", "channel", "panel_segment"
    )


@query(
    "special_family_flag",
    f"select distinct item_code, sellout_dm, {SPECIAL} as is_special from {{valued_facts}}",
)
def special_family_flag(i):
    return i.valued_facts.select(
        "item_code", "sellout_dm", pricing.is_special_family(F.col("sellout_dm")).alias("is_special")
    ).distinct()


@query(
    "anomaly_flag",
    f"""with {LINES} select order_key, line_no, item_code, company, flag as is_no_media
    from lines where panel_segment = 'sellin_producer'""",
)
def anomaly_flag(i):
    return valorise.flag_producers(lines(i).filter("panel_segment = 'sellin_producer'")).select(
        "order_key", "line_no", "item_code", "company", "is_no_media"
    )


@query(
    "homogeneous_price",
    f"""with {LINES}
    select company, item_code, _dest_key, billing_currency, _year, _semester,
      sum(fx_transaction_lc) / sum(quantity) as pm_omogeneo
    from lines where panel_segment = 'sellin_producer' and flag = 0
    group by all having sum(fx_transaction_lc) / sum(quantity) > 0""",
    {"pm_omogeneo": FLOAT},
)
def homogeneous_price(i):
    producers = valorise.flag_producers(lines(i).filter("panel_segment = 'sellin_producer'"))
    return pricing.unit_price(producers.filter("is_no_media = 0"))


# Fallbacks are checked on family prices of one submission, asked for by all lines.
FAMILY_KEYS = ("sellout_dm", "_dest_key", "billing_currency")
FAMILY_PRICES = f"""{LINES},
prices as (
  select sellout_dm, _dest_key, billing_currency, _year, _semester,
    sum(fx_transaction_lc) / sum(quantity) as pm_omogeneo
  from lines where flag = 0
  group by all having sum(fx_transaction_lc) / sum(quantity) > 0),
asked as (
  select l.order_key, l.line_no, l.item_code, l.company, l.sellout_dm, l._dest_key,
    l.billing_currency, l._year, l._semester, p.pm_omogeneo as own_price
  from lines l left join prices p
    using (sellout_dm, _dest_key, billing_currency, _year, _semester))"""


def _family_prices(i):
    """Lines with their own price, and the prices of all usable lines, whatever their submission and channel."""
    keys = [*FAMILY_KEYS, *pricing.PERIOD]
    prices = pricing.unit_price(lines(i).filter(_flag() == 0), keys)
    asked = lines(i).select("order_key", "line_no", "item_code", "company", *keys)
    return asked.join(prices, keys, "left"), prices


CHAIN = ", ".join(f"('{a}', '{b}', {n})" for n, (a, b) in enumerate(pricing.GEO_FALLBACKS))


@query(
    "geo_price_fallback",
    f"""with {FAMILY_PRICES},
    chain(needs, offer, rank) as (values {CHAIN}),
    offers as (
      select p.sellout_dm, c.needs as _dest_key, p.billing_currency, p._year, p._semester,
        arg_min(p.pm_omogeneo, c.rank) as geo_price
      from prices p join chain c on c.offer = p._dest_key group by all)
    select a.order_key, a.line_no, a.item_code, a.company, a._dest_key,
      coalesce(a.own_price, o.geo_price) as pm_omogeneo
    from asked a left join offers o
      using (sellout_dm, _dest_key, billing_currency, _year, _semester)""",
    {"pm_omogeneo": FLOAT},
)
def geo_price_fallback(i):
    asked, prices = _family_prices(i)
    return pricing.geo_fallback(asked, prices, keys=FAMILY_KEYS).select(
        "order_key", "line_no", "item_code", "company", "_dest_key", "pm_omogeneo"
    )


ASOF = """
select a.order_key, a.line_no, a.item_code, a.company, a._year, a._semester,
  coalesce(a.own_price, p.pm_omogeneo) as pm_omogeneo
from asked a asof left join (
    select *, _year * 2 + case when _semester = 'H2' then 1 else 0 end as idx from prices) p
  on a.sellout_dm = p.sellout_dm and a._dest_key = p._dest_key
    and a.billing_currency = p.billing_currency
    and a._year * 2 + case when a._semester = 'H2' then 1 else 0 end >= p.idx"""


@query("temporal_price_fallback", f"with {FAMILY_PRICES} {ASOF}", {"pm_omogeneo": FLOAT})
def temporal_price_fallback(i):
    asked, prices = _family_prices(i)
    return pricing.asof_price(asked, prices, FAMILY_KEYS).select(
        "order_key", "line_no", "item_code", "company", "_year", "_semester", "pm_omogeneo"
    )


@query(
    "newest_price_fallback",
    f"""with {FAMILY_PRICES},
    newest as (
      select sellout_dm, _dest_key, billing_currency,
        arg_max(pm_omogeneo, _year * 2 + case when _semester = 'H2' then 1 else 0 end) as price
      from prices group by all)
    select a.order_key, a.line_no, a.item_code, a.company, a._year, a._semester,
      coalesce(a.own_price, n.price) as pm_omogeneo
    from asked a left join newest n using (sellout_dm, _dest_key, billing_currency)""",
    {"pm_omogeneo": FLOAT},
)
def newest_price_fallback(i):
    asked, prices = _family_prices(i)
    return pricing.asof_price(asked, prices, FAMILY_KEYS, allow_future=True).select(
        "order_key", "line_no", "item_code", "company", "_year", "_semester", "pm_omogeneo"
    )


RETAIL = """
retail as (
  select sellout_dm, _year, _semester, sum(fx_transaction_lc) / sum(quantity) as avg_retail_price
  from lines where company_type = 'dealer' and channel = 'Retail' and sellout_dm is not null
    and fx_transaction_lc > 0 and quantity > 0
  group by all having sum(fx_transaction_lc) / sum(quantity) > 0)"""


@query("avg_retail_price", f"with {LINES}, {RETAIL} select * from retail", {"avg_retail_price": FLOAT})
def avg_retail_price(i):
    return pricing.retail_price(lines(i))


MARKUP = """
producer as (
  select sellout_dm, _year, _semester, sum(fx_transaction_lc) / sum(quantity) as price
  from lines where panel_segment = 'sellin_producer' and flag = 0
  group by all having sum(fx_transaction_lc) / sum(quantity) > 0),
markups as (
  select r.*, r.avg_retail_price / p.price as markup
  from retail r left join producer p using (sellout_dm, _year, _semester))"""


@query(
    "retail_markup",
    f"with {LINES}, {RETAIL}, {MARKUP} select * from markups",
    {"avg_retail_price": FLOAT, "markup": FLOAT},
)
def retail_markup(i):
    tagged = lines(i)
    producers = valorise.flag_producers(tagged.filter("panel_segment = 'sellin_producer'"))
    return pricing.markup(pricing.retail_price(tagged), producers)


# A usable producer line sells its own key, so its price is never missing here and no
# neighbour is asked. Flagged lines take the latest price up to their own semester.
VALORISED = f"""{LINES}, {RETAIL}, {MARKUP},
own_prices as (
  select company, item_code, _dest_key, billing_currency, _year, _semester,
    _year * 2 + case when _semester = 'H2' then 1 else 0 end as idx,
    sum(fx_transaction_lc) / sum(quantity) as price
  from lines where panel_segment = 'sellin_producer' and flag = 0
  group by all having sum(fx_transaction_lc) / sum(quantity) > 0),
producers as (
  select l.*, case when l.flag = 2 then l.fx_transaction_lc / l.quantity else o.price end
      as pm_omogeneo,
    m.avg_retail_price, m.markup
  from lines l asof left join own_prices o
    on l.company = o.company and l.item_code = o.item_code and l._dest_key = o._dest_key
      and l.billing_currency = o.billing_currency
      and l._year * 2 + case when l._semester = 'H2' then 1 else 0 end >= o.idx
  left join markups m on m.sellout_dm = l.sellout_dm and m._year = l._year
    and m._semester = l._semester
  where l.panel_segment = 'sellin_producer'),
dealers as (
  select l.*, case when m.markup > 0 then m.avg_retail_price / m.markup end as pm_omogeneo,
    m.avg_retail_price, m.markup
  from lines l left join markups m on m.sellout_dm = l.sellout_dm and m._year = l._year
    and m._semester = l._semester
  where l.panel_segment = 'sellin_dealer'),
valued as (
  select *, flag as is_no_media,
    case flag when 1 then 0 when 2 then fx_transaction_lc else quantity * pm_omogeneo end
      as amount_homogeneous,
    case flag when 1 then 0 when 2 then fx_transaction_lc else quantity * pm_omogeneo end
      as amount_sellout
  from producers
  union all by name
  select *, 0 as is_no_media, quantity * pm_omogeneo as amount_homogeneous,
    quantity * pm_omogeneo * markup as amount_sellout
  from dealers)"""
PRICE_DIGITS = {
    "pm_omogeneo": FLOAT, "avg_retail_price": FLOAT, "markup": FLOAT,
    "amount_homogeneous": FLOAT, "amount_sellout": FLOAT,
}
VALUED_COLUMNS = (
    "order_key", "line_no", "item_code", "company", "is_no_media", "pm_omogeneo",
    "avg_retail_price", "markup", "amount_homogeneous", "amount_sellout",
)


@query("valorize", f"with {VALORISED} select {', '.join(VALUED_COLUMNS)} from valued", PRICE_DIGITS)
def valorize(i):
    return valorise.valued_sellin(stored_lines(i)).select(*VALUED_COLUMNS)


@query(
    "valuation_coverage",
    f"""with {VALORISED}
    select *, ((with_pm * 2000 + total) // (2 * total)) / 10.0 as pm_pct from (
      select company_type, company, count(*) as total, count(pm_omogeneo) as with_pm,
        count(amount_homogeneous) as valorized, count(amount_sellout) as with_sellout,
        count(*) filter (is_no_media = 3) as without_price
      from valued group by all) c""",
)
def valuation_coverage(i):
    return quality.valuation_coverage(valorise.valued_sellin(stored_lines(i)))


views.VIEWS["consolidation"] = """
    select lower(s_name) as company, ' ' || c_name as customer,
      case when c_custkey % 2 = 0 then 'WHOLESALE' else 'fabbricante ' end as channel_class,
      (c_custkey + s_suppkey) % 3 = 0 as consolidare_panel
    from {lineitem} join {orders} on l_orderkey = o_orderkey
    join {customer} on o_custkey = c_custkey join {supplier} on l_suppkey = s_suppkey
    where l_linenumber = 1"""

OVERLAP = """
overlap as (
  select upper(trim(company)) as k1, upper(trim(customer)) as k2,
    upper(trim(channel_class)) as k3, max(consolidare_panel) as consolidare_panel
  from {consolidation} group by all)"""


@query(
    "panel_overlap",
    f"""with {OVERLAP}
    select f.order_key, f.line_no, f.item_code, f.company, o.consolidare_panel
    from {{facts}} f left join overlap o on upper(trim(f.company)) = o.k1
      and upper(trim(f.customer)) = o.k2 and upper(trim(f.channel)) = o.k3""",
)
def panel_overlap(i):
    return pricing.overlap(i.facts, i.consolidation).select(
        "order_key", "line_no", "item_code", "company", "consolidare_panel"
    )


SPLIT = """
parts as (
  select *, 0 as months, case when company_type = 'dealer' then 1.0::double
      when time_frames = 'quarterly' then 0.5 else 0.7826::double end as share from {source}
  union all
  select *, case when time_frames = 'quarterly' then 3 else 6 end as months,
    case when time_frames = 'quarterly' then 0.5 else 0.2174::double end as share
  from {source} where company_type <> 'dealer'),
split as (
  select * replace (case when months = 0 then date
      else cast(date_trunc('month', date + to_months(months)) as date) end as date,
      quantity * share as quantity),
    year(date) || '_' || case when month(date) <= 6 then 'H1' else 'H2' end as _original_period
  from parts)"""


@query(
    "period_split",
    f"""with {SPLIT.replace('{source}', '{facts}')}
    select order_key, line_no, item_code, company, date, quantity, _original_period from split""",
    {"quantity": 6},
)
def period_split(i):
    return pricing.split_periods(i.facts).select(
        "order_key", "line_no", "item_code", "company", "date", "quantity", "_original_period"
    )


REFERENCE_PRICE = """
reference_prices as (
  select company, item_code, _dest_key, billing_currency,
    arg_max(pm_omogeneo, (date, pm_omogeneo)) as price
  from valued where pm_omogeneo is not null group by all)"""


@query(
    "sellout_reference_price",
    f"""with {VALORISED}, {REFERENCE_PRICE}
    select company, item_code, _dest_key, billing_currency, price as _reference_price
    from reference_prices""",
    {"_reference_price": FLOAT},
)
def sellout_reference_price(i):
    return pricing.reference_price(valorise.valued_sellin(stored_lines(i)))


@query(
    "sellout_valorized",
    f"""with {VALORISED}, {REFERENCE_PRICE}, {OVERLAP}
    select s.order_key, s.line_no, s.item_code, s.company,
      case when s.fx_transaction_lc is null then 3 else s.flag end as is_no_media,
      case when s.fx_transaction_lc is null then null when s.flag = 1 then 0
        else s.fx_transaction_lc end as amount_sellout,
      r.price as pm_omogeneo, o.consolidare_panel
    from lines s left join reference_prices r using (company, item_code, _dest_key, billing_currency)
    left join overlap o on upper(trim(s.company)) = o.k1 and upper(trim(s.customer)) = o.k2
      and upper(trim(s.channel)) = o.k3
    where s.panel_segment = 'sellout'""",
    {"amount_sellout": FLOAT, "pm_omogeneo": FLOAT},
)
def sellout_valorized(i):
    tagged = stored_lines(i)
    valued = pricing.valorize_sellout(
        tagged.filter("panel_segment = 'sellout'"), valorise.valued_sellin(tagged)
    )
    return pricing.overlap(valued, i.consolidation).select(
        "order_key", "line_no", "item_code", "company", "is_no_media", "amount_sellout",
        "pm_omogeneo", "consolidare_panel",
    )


@query(
    "panel_valorized",
    f"""with {VALORISED}, {SPLIT.replace('{source}', 'valued')},
    split_amounts as (
      select *, amount_homogeneous * share as homogeneous, amount_sellout * share as sold from split)
    select panel_segment, company_type, _original_period, date, count(*) as n,
      count(amount_homogeneous) as valued, sum(quantity) as quantity,
      sum(homogeneous) as amount_homogeneous, sum(sold) as amount_sellout
    from split_amounts group by all
    union all
    select panel_segment, company_type,
      year(date) || '_' || case when month(date) <= 6 then 'H1' else 'H2' end, date, count(*), 0,
      sum(quantity), null, null
    from lines where panel_segment in ('sellout', 'unrouted') group by all""",
    {"quantity": 4, "amount_homogeneous": FLOAT, "amount_sellout": FLOAT},
)
def panel_valorized(i):
    return (
        valorise.valorise_panel(i.stored("valued_facts"))
        .groupBy("panel_segment", "company_type", "_original_period", "date")
        .agg(
            F.count("*").alias("n"),
            F.count("amount_homogeneous").alias("valued"),
            F.sum("quantity").alias("quantity"),
            F.sum("amount_homogeneous").alias("amount_homogeneous"),
            F.sum("amount_sellout").alias("amount_sellout"),
        )
    )
