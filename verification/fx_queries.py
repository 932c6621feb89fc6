"""Currency references, rate normalisation, conversion, event classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.operators import classify, fx, quality
from tradeloom.plans import rates, reference
from tradeloom.session import cut_lineage
from verification.registry import FLOAT, query

COUNTRY_CURRENCY = """
country_currency as (
  select distinct t.id as id_time, t.year, t.semester, t.quarter, t.month, c.id as id_country,
    trim(c.country_name) as country_name, upper(trim(c.country_name)) as country_join_key,
    u.id as id_currency, upper(trim(u.currency_code)) as currency_target,
    upper(trim(u.currency_code)) as local_currency
  from {countries_currencies} l join {countries} c on c.id = l.id_country
  join {currencies} u on u.id = l.id_currency join {times} t on t.id = l.id_time
  where t.month between 1 and 12)"""


def _country_currency(i):
    return reference.country_currency(i.countries_currencies, i.countries, i.currencies, i.times)


@query("ref_country_currency", f"with {COUNTRY_CURRENCY} select * from country_currency")
def ref_country_currency(i):
    return _country_currency(i)


RATES = """
quoted as (
  select q.id, q.id_time, t.year, t.semester, t.quarter, t.month, t.id_time_frame,
    q.id_currency_base, b.currency_code as currency_base, q.id_currency_target,
    c.currency_code as currency_target,
    try_cast(replace(trim(q.exchange_rate), ',', '.') as double) as number
  from {quotes} q join {times} t on t.id = q.id_time and t.id_time_frame = 4
  join {currencies} b on b.id = q.id_currency_base
  join {currencies} c on c.id = q.id_currency_target),
rates as (
  select id as id_exchange_rate, id_time, year, semester, quarter, month, id_time_frame,
    id_currency_base, currency_base, id_currency_target, currency_target,
    case when number > 0 then number end as exchange_rate
  from quoted
  qualify row_number() over (partition by year, month, currency_base, currency_target
    order by id) = 1)"""


def _rates(i):
    return reference.exchange_rates(i.quotes, i.currencies, i.times)


@query("ref_exchange_rates", f"with {RATES} select * from rates")
def ref_exchange_rates(i):
    return _rates(i)


# Same-code redenomination configured for the test countries.
SAME_CODE = ((2000, 3, "NATION_5", "VES", "VES"), (1999, 6, "NATION_7", "SYP", "SYP"))
EVENT_VALUES = ", ".join(
    f"('{a}', '{b}', {'null' if f is None else f'{f}::double'}, '{e}')"
    for a, b, f, e in fx.CURRENCY_EVENTS
)
SAME_CODE_VALUES = ", ".join(f"({y}, {m}, '{c}', '{a}', '{b}')" for y, m, c, a, b in SAME_CODE)

CLEAN = f"""{RATES}, {COUNTRY_CURRENCY},
events(currency_predecessor, currency_successor, factor, event_type) as (values {EVENT_VALUES}),
same_code(year, month, country_name, currency_predecessor, currency_successor) as (
  values {SAME_CODE_VALUES}),
clean as (
  select distinct year, month, currency_target as currency_base, currency_base as currency_target,
    exchange_rate
  from rates where exchange_rate > 0),
by_country as (
  select distinct c.year, c.month, c.currency_base, c.currency_target, u.country_name,
    c.exchange_rate, 'df_original' as source
  from clean c join country_currency u on u.year = c.year and u.month = c.month
    and u.local_currency = c.currency_target
  where c.currency_base in ('EUR', 'USD')
    and not (c.year = 1998 and c.month = 8 and c.currency_target = 'VEF'))"""
EXCLUDE = ((1998, 8, "VEF"),)


def _clean(i):
    return fx.clean_rates(_rates(i))


def _fx_country(i):
    return fx.fx_country(_clean(i), _country_currency(i), EXCLUDE)


@query("fx_country", f"with {CLEAN} select * from by_country", {"exchange_rate": FLOAT})
def fx_country(i):
    return _fx_country(i)


SWITCHES = f"""{CLEAN},
last_use as (
  select country_name, currency_target, max(make_date(year, month, 1)) as last_period
  from by_country group by 1, 2),
sequenced as (
  select *, lead(currency_target) over (partition by country_name
    order by last_period, currency_target) as currency_successor from last_use),
switches as (
  select s.*, e.factor, e.event_type from (
    select year(last_period) as year, month(last_period) as month, country_name,
      currency_target as currency_predecessor, currency_successor
    from sequenced where currency_successor is not null
    union all select * from same_code) s
  join events e using (currency_predecessor, currency_successor))"""


def _switches(i):
    return fx.currency_switches(
        cut_lineage(_fx_country(i)), fx.switches_table(i.spark, SAME_CODE), fx.events_table(i.spark)
    )


@query("currency_switches", f"with {SWITCHES} select * from switches")
def currency_switches(i):
    return _switches(i)


@query(
    "unconfigured_switches",
    f"""with {SWITCHES}
    select year(last_period) as year, month(last_period) as month, country_name,
      currency_target as currency_predecessor, currency_successor
    from sequenced s where currency_successor is not null and not exists (
      select 1 from events e where e.currency_predecessor = s.currency_target
        and e.currency_successor = s.currency_successor
        and e.event_type <> 'currency_union')""",
)
def unconfigured_switches(i):
    # Unions are withheld from the configuration so that there is something to report.
    events = fx.events_table(i.spark).filter(F.col("event_type") != fx.UNION_EVENT)
    return fx.unconfigured_switches(_fx_country(i), events)


FACTORS = f"""{SWITCHES},
factors as (
  select year, month, country_name, currency_predecessor,
    first(currency_successor) over (partition by country_name order by year desc, month desc)
      as currency_successor,
    factor, event_type,
    product(factor) over (partition by country_name, currency_successor order by year, month
      rows between current row and unbounded following) as factor_cum
  from switches)"""


@query("fx_cumulative_factor", f"with {FACTORS} select * from factors", {"factor_cum": FLOAT})
def fx_cumulative_factor(i):
    return fx.cumulative_factor(_switches(i))


REDENOMINATED = f"""{FACTORS},
redenominated as (
  select distinct p.year, p.month, f.currency_predecessor as currency_base,
    f.currency_successor as currency_target, f.country_name, 1.0 / f.factor_cum as exchange_rate,
    f.event_type, 'df_redenomination' as source
  from factors f join by_country p on p.country_name = f.country_name
    and p.currency_target = f.currency_predecessor
  where f.factor_cum is not null
    and make_date(p.year, p.month, 1) <= make_date(f.year, f.month, 1))"""


def steps(i):
    return rates.fx_steps(
        _rates(i), _country_currency(i), fx.switches_table(i.spark, SAME_CODE),
        fx.events_table(i.spark), EXCLUDE,
    )


@query("fx_redenomination", f"with {REDENOMINATED} select * from redenominated", {"exchange_rate": FLOAT})
def fx_redenomination(i):
    return steps(i).redenominated


NORMALISED = f"""{REDENOMINATED},
normalised as (
  select distinct * from (
    select f.year, f.month, f.currency_base,
      coalesce(r.currency_target, f.currency_target) as currency_target, f.country_name,
      coalesce(f.exchange_rate * r.exchange_rate, f.exchange_rate) as exchange_rate,
      r.event_type, f.source
    from by_country f left join redenominated r on r.year = f.year and r.month = f.month
      and r.country_name = f.country_name and r.currency_base = f.currency_target) joined
  where currency_base <> currency_target)"""


@query("fx_backcalc", f"with {NORMALISED} select * from normalised", {"exchange_rate": FLOAT})
def fx_backcalc(i):
    return steps(i).normalised


INVERSE = """
inverted as (
  select distinct f.year, f.month, f.currency_target as currency_base,
    f.currency_base as currency_target, l.country_name, 1.0 / f.exchange_rate as exchange_rate,
    coalesce(f.event_type, l.event_type) as event_type, 'df_inverted' as source
  from normalised f left join (
    select distinct year, month, currency_target, country_name, event_type from normalised) l
    on l.year = f.year and l.month = f.month and l.currency_target = f.currency_base
  where not (f.currency_target = 'EUR' and f.currency_base = 'USD')
    and not (f.currency_target = 'USD' and f.currency_base = 'EUR')
    and not (coalesce(f.event_type, '') = 'currency_union' and f.currency_target in ('EUR', 'USD'))
    and not (coalesce(l.event_type, '') = 'currency_union' and f.currency_base in ('EUR', 'USD')))"""


@query("fx_inverse", f"with {NORMALISED}, {INVERSE} select * from inverted", {"exchange_rate": FLOAT})
def fx_inverse(i):
    return fx.inverse(steps(i).normalised)


CROSS = """
usd as (
  select distinct year, month, currency_target, country_name, exchange_rate, event_type
  from normalised where currency_base = 'USD'),
crossed as (
  select distinct b.year, b.month, b.currency_target as currency_base, t.currency_target,
    t.country_name, t.exchange_rate / b.exchange_rate as exchange_rate,
    case when b.event_type is not null and t.event_type is not null then 'synthetic_cross'
      else coalesce(t.event_type, b.event_type) end as event_type,
    'df_all_combination' as source
  from usd b join usd t on b.year = t.year and b.month = t.month
  where b.currency_target <> t.currency_target and b.currency_target not in ('EUR', 'USD')
    and not (t.currency_target in ('EUR', 'USD')
      and coalesce(t.event_type, '') <> 'currency_union'))"""


@query("fx_cross", f"with {NORMALISED}, {CROSS} select * from crossed", {"exchange_rate": FLOAT})
def fx_cross(i):
    return fx.cross(steps(i).normalised)


ALL_RATES = f"""{NORMALISED}, {INVERSE}, {CROSS},
every as (
  select * from normalised union all by name select * from inverted
  union all by name select * from crossed union all by name select * from redenominated)"""


@query(
    "fx_legacy",
    f"""with {ALL_RATES},
    usd_rates as (
      select distinct year, month, currency_target as currency, exchange_rate from clean
      where currency_base = 'USD'),
    in_use as (select distinct year, month, currency_target as currency from clean)
    select distinct b.year, b.month, b.currency as currency_base, t.currency as currency_target,
      (case when t.currency = 'USD' then 1.0 else rt.exchange_rate end) /
      (case when b.currency = 'USD' then 1.0 else rb.exchange_rate end) as exchange_rate,
      'df_legacy' as source
    from in_use b join in_use t on b.year = t.year and b.month = t.month and b.currency <> t.currency
    left join usd_rates rb on rb.year = b.year and rb.month = b.month and rb.currency = b.currency
    left join usd_rates rt on rt.year = b.year and rt.month = b.month and rt.currency = t.currency
    left join (select distinct currency_predecessor, event_type from events) e
      on e.currency_predecessor = b.currency
    where b.currency not in (select currency_base from every where source <> 'df_redenomination')
      and b.currency not in ('EUR', 'USD')
      and not (t.currency in ('EUR', 'USD') and coalesce(e.event_type, '') = 'currency_union')
      and (t.currency = 'USD' or rt.exchange_rate is not null) and rb.exchange_rate is not null""",
    {"exchange_rate": FLOAT},
)
def fx_legacy(i):
    done = steps(i)
    return fx.legacy(done.clean, fx.events_table(i.spark), cut_lineage(done.all_rates()))


FRAMES = """
  select year, time_frame, period_value, {keys}, avg(exchange_rate) as exchange_rate
  from (select *, unnest(['month', 'quarter', 'semester', 'year']) as time_frame,
      unnest([month, (month - 1) // 3 + 1, case when month <= 6 then 1 else 2 end, year])
        as period_value
    from {source}) framed
  group by all"""


def frames_sql(source: str, keys: str) -> str:
    return FRAMES.replace("{source}", source).replace("{keys}", keys)


NORMALISED_FRAMES = frames_sql("every", "currency_base, currency_target, country_name")


@query("fx_time_frames", f"with {ALL_RATES} {NORMALISED_FRAMES}", {"exchange_rate": FLOAT})
def fx_time_frames(i):
    return fx.time_frames(steps(i).all_rates(), fx.NORMALISED_KEYS)


REPORTING_FRAMES = frames_sql(
    """(select * from every where currency_target in ('EUR', 'USD')
      and coalesce(event_type, '') <> 'currency_union')""",
    "currency_base, currency_target",
)


@query("fx_reporting", f"with {ALL_RATES} {REPORTING_FRAMES}", {"exchange_rate": FLOAT})
def fx_reporting(i):
    return fx.reporting_rates(steps(i).all_rates())


@query(
    "fx_validate",
    f"""with {RATES}
    select (select count(*) from rates) as row_count,
      (select count(*) from rates where exchange_rate is null or exchange_rate <= 0)
        as invalid_rates,
      (select count(*) from (select 1 from rates group by year, month, currency_target
        having count(*) > 1) d) as duplicate_keys""",
)
def fx_validate(i):
    return fx.validate(_rates(i), ["year", "month", "currency_target"])


@query(
    "fx_coverage",
    f"""with {RATES}
    select cast(year as varchar) as subject, min(month) as low, max(month) as high,
      count(distinct month) as months_available, count(*) as rate_rows
    from rates group by year
    union all
    select currency_target, min(year), max(year), null, count(*) from rates
    group by currency_target""",
)
def fx_coverage(i):
    quoted = _rates(i)
    years = fx.coverage_by_year(quoted).select(
        F.col("year").cast("string").alias("subject"),
        F.col("min_month").alias("low"), F.col("max_month").alias("high"),
        "months_available", "rate_rows",
    )
    targets = fx.coverage_by_target(quoted).select(
        F.col("currency_target").alias("subject"),
        F.col("min_year").alias("low"), F.col("max_year").alias("high"),
        F.lit(None).cast("long").alias("months_available"), F.col("rate_count").alias("rate_rows"),
    )
    return years.unionByName(targets)


# --------------------------------------------------------------------------- conversion

LOCAL = """
local_by_month as (
  select year, month, country_join_key, min(local_currency) as local_currency
  from country_currency group by all)"""


@query(
    "local_currency",
    f"""with {COUNTRY_CURRENCY}, {LOCAL}
    select f.order_key, f.line_no, f.item_code, f.company, l.local_currency
    from {{facts}} f left join local_by_month l on l.year = year(f.date)
      and l.month = month(f.date) and l.country_join_key = upper(trim(f.destination_country))""",
)
def local_currency(i):
    return fx.add_local_currency(i.facts, _country_currency(i)).select(
        "order_key", "line_no", "item_code", "company", "local_currency"
    )


CONVERTED = f"""{ALL_RATES}, {LOCAL},
monthly_rates as (
  select year, month, country_name, currency_base, currency_target,
    avg(exchange_rate) as rate from every group by all),
converted as (
  select f.* exclude (local_currency), l.local_currency,
    case when f.billing_currency = l.local_currency then 1.0 else r.rate end as billing_local_fx,
    f.sales * case when f.billing_currency = l.local_currency then 1.0 else r.rate end
      as sales_local_currency
  from {{facts}} f left join local_by_month l on l.year = year(f.date)
    and l.month = month(f.date) and l.country_join_key = upper(trim(f.destination_country))
  left join monthly_rates r on r.year = year(f.date) and r.month = month(f.date)
    and upper(r.country_name) = upper(trim(f.destination_country))
    and r.currency_base = f.billing_currency and r.currency_target = l.local_currency)"""


def converted(i):
    return fx.convert_sales(
        i.facts, _country_currency(i), fx.time_frames(steps(i).all_rates(), fx.NORMALISED_KEYS)
    )


@query(
    "fx_convert",
    f"""with {CONVERTED}
    select order_key, line_no, item_code, company, billing_currency, local_currency,
      billing_local_fx, sales_local_currency from converted""",
    {"billing_local_fx": FLOAT, "sales_local_currency": FLOAT},
)
def fx_convert(i):
    return converted(i).select(
        "order_key", "line_no", "item_code", "company", "billing_currency", "local_currency",
        "billing_local_fx", "sales_local_currency",
    )


@query(
    "fx_conversion_coverage",
    f"""with {CONVERTED}
    select *, rows_with_sales - rows_converted as rows_not_converted,
      ((rows_converted * 20000 + rows_with_sales) // (2 * rows_with_sales)) / 100.0 as coverage_pct
    from (select count(sales) as rows_with_sales, count(sales_local_currency) as rows_converted
      from converted) c""",
)
def fx_conversion_coverage(i):
    return quality.fx_coverage(converted(i))


@query(
    "missing_rates",
    f"""with {CONVERTED}
    select company, year(date) as year, month(date) as month, billing_currency, local_currency,
      count(*) as n
    from converted where sales is not null and billing_currency is not null
      and local_currency is not null and billing_local_fx is null group by all""",
)
def missing_rates(i):
    return quality.missing_rates(converted(i))


# -------------------------------------------------------------------------- event types

EVENTS = """
signed as (
  select *, case when sales = 0 then null else sales end as s,
    case when coalesce(quantity, volumes) = 0 then null else coalesce(quantity, volumes) end as q
  from {facts}),
typed as (
  select *, case when s is null and q is null then 'empty'
    when s > 0 and q > 0 then 'commercial_sale' when s < 0 and q < 0 then 'return'
    when s < 0 and q is null then 'rebate' when s is null and q > 0 then 'freebie'
    when s > 0 and q is null then 'service'
    when (s > 0 and q < 0) or (s < 0 and q > 0) then 'accounting_adjustment'
    else 'anomaly' end as sales_event_type
  from signed)"""


@query(
    "event_type",
    f"with {EVENTS} select order_key, line_no, item_code, company, sales_event_type from typed",
)
def event_type(i):
    return classify.add_event_type(i.facts).select(
        "order_key", "line_no", "item_code", "company", "sales_event_type"
    )


@query(
    "event_distribution",
    f"""with {EVENTS}
    select sales_event_type, count(*) as n,
      ((count(*) * 20000 + sum(count(*)) over ()) // (2 * sum(count(*)) over ())) / 100.0 as pct
    from typed group by 1""",
)
def event_distribution(i):
    return quality.event_distribution(classify.add_event_type(i.facts))


@query(
    "dq_domain",
    """select channel, count(*) as n from {facts}
    where channel is null or channel not in ('Wholesale', 'Fabbricante') group by 1""",
)
def dq_domain(i):
    return quality.outside_domain(i.facts, "channel", ["Wholesale", "Fabbricante"])


@query(
    "dq_unparseable",
    """select id, id_time, exchange_rate from {quotes}
    where trim(exchange_rate) <> ''
      and try_cast(replace(trim(exchange_rate), ',', '.') as double) is null""",
)
def dq_unparseable(i):
    return quality.unparseable(i.quotes, "exchange_rate").select("id", "id_time", "exchange_rate")


@query(
    "dq_duplicates",
    f"""with {RATES}
    select year, month, currency_base, count(*) as row_count,
      count(distinct currency_target) as value_count,
      string_agg(distinct currency_target, ',' order by currency_target) as "values"
    from rates group by 1, 2, 3 having count(*) > 1""",
)
def dq_duplicates(i):
    return quality.duplicates(_rates(i), ["year", "month", "currency_base"], "currency_target")


