"""Gold marts, quality gates and masking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.functions.masking import mask_customer
from tradeloom.operators import quality
from tradeloom.plans import marts
from verification.registry import query

LATEST = """
latest as (
  select company, date_trunc('month', date) as m, max(submission_id) as newest
  from {valued_facts} group by all),
curated as (
  select f.*, cast(date_trunc('month', f.date) as date) as reporting_month,
    year(f.date) as year, month(f.date) as month,
    case when month(f.date) <= 6 then 'H1' else 'H2' end as semester
  from {valued_facts} f join latest l
    on f.company = l.company and date_trunc('month', f.date) = l.m
    and f.submission_id = l.newest)"""


@query(
    "latest_submission",
    f"""with {LATEST}
    select order_key, line_no, item_code, company, date, submission_id, sales, quantity
    from curated""",
)
def latest_submission(i):
    return marts.latest_submission(i.valued_facts).select(
        "order_key", "line_no", "item_code", "company", "date", "submission_id", "sales", "quantity"
    )


@query(
    "sellout_curated",
    f"""with {LATEST}
    select company, company_type, customer, destination_country, channel, order_key, line_no,
      item_code, date, submission_id, reporting_month, year, month, semester, quantity,
      sales_local_currency,
      case when quantity > 0 then
        round(sales_local_currency / quantity, 2) end as sales_per_unit
    from curated""",
)
def sellout_curated(i):
    return marts.curate(i.valued_facts).select(
        "company", "company_type", "customer", "destination_country", "channel", "order_key",
        "line_no", "item_code", "date", "submission_id", "reporting_month", "year", "month",
        "semester", "quantity", "sales_local_currency", "sales_per_unit",
    )


@query(
    "company_kpi",
    f"""with {LATEST},
    monthly as (
      select reporting_month, year, semester, company, local_currency as currency,
        sum(quantity) as total_quantity, sum(sales_local_currency) as total_sales,
        count(distinct item_code) as active_products,
        count(distinct destination_country) as active_markets,
        count(distinct customer) as active_customers
      from curated group by all),
    trended as (
      select *, lag(total_sales) over (partition by company, currency order by reporting_month)
        as previous_month_sales
      from monthly)
    select *, total_sales - previous_month_sales as sales_delta_vs_previous_month,
      case when previous_month_sales <> 0
        then round((total_sales / previous_month_sales - 1) * 100, 2) end as sales_growth_pct
    from trended""",
    {
        "total_quantity": 4, "total_sales": 2, "previous_month_sales": 2,
        "sales_delta_vs_previous_month": 2, "sales_growth_pct": 2,
    },
)
def company_kpi(i):
    return marts.company_kpi(marts.curate(i.valued_facts))


@query(
    "product_kpi",
    f"""with {LATEST}
    select year, semester, item_code, local_currency as currency,
      sum(quantity) as total_quantity, sum(sales_local_currency) as total_sales,
      round(sum(sales_local_currency) / nullif(sum(quantity), 0), 2) as avg_sales_per_unit,
      count(distinct destination_country) as markets_reached,
      count(distinct customer) as active_customers
    from curated group by all""",
    {"total_quantity": 4, "total_sales": 2, "avg_sales_per_unit": 2},
)
def product_kpi(i):
    return marts.product_kpi(marts.curate(i.valued_facts))


@query(
    "market_kpi",
    f"""with {LATEST}
    select reporting_month, year, semester, destination_country, channel,
      local_currency as currency, sum(quantity) as total_quantity,
      sum(sales_local_currency) as total_sales, count(distinct company) as active_companies,
      count(distinct item_code) as active_products, count(distinct customer) as active_customers
    from curated group by all""",
    {"total_quantity": 4, "total_sales": 2},
)
def market_kpi(i):
    return marts.market_kpi(marts.curate(i.valued_facts))


@query(
    "gold_quality_checks",
    f"""with {LATEST}
    select 'gold_not_empty' as check_name, count(*) > 0 as passed from curated
    union all select 'date_complete', count(*) filter (date is null) = 0 from curated
    union all select 'company_complete', count(*) filter (company is null) = 0 from curated
    union all select 'submission_complete', count(*) filter (submission_id is null) = 0 from curated
    union all select 'single_submission_per_company_month', count(*) = 0 from (
      select company, reporting_month from curated group by all
      having count(distinct submission_id) > 1) v
    union all select 'quantity_non_negative', count(*) filter (quantity < 0) = 0 from curated""",
)
def gold_quality_checks(i):
    return quality.gold_checks(marts.curate(i.valued_facts))


@query(
    "constraint_violations",
    """select order_key, line_no, item_code, quantity, 'valid_quantity' as violation
    from {facts} where quantity < 0""",
)
def constraint_violations(i):
    return quality.constraint_violations(i.facts).select(
        "order_key", "line_no", "item_code", "quantity", "violation"
    )


@query(
    "mask_customer",
    """select order_key, line_no, item_code,
      case when company_type = 'dealer' then customer
        else 'CUSTOMER_' || right(sha256(customer), 10) end as customer
    from {facts}""",
)
def mask(i):
    privileged = F.col("company_type") == "dealer"
    return i.facts.select(
        "order_key", "line_no", "item_code",
        mask_customer(F.col("customer"), privileged).alias("customer"),
    )
