"""Mapping-driven import, the harmonised table, remaining quality reports and streams."""

from __future__ import annotations

import datetime
from dataclasses import replace

from pyspark.sql import functions as F

from tradeloom.functions.companies import canonical_company
from tradeloom.operators import fx, lookup, quality
from tradeloom.plans import harmonise, marts
from tradeloom.session import cut_lineage, in_slice, in_slices, shared_folder
from tradeloom.sources import mapping
from tradeloom.streaming import files, resubmissions
from verification import fx_queries as rates
from verification import lookup_queries as lookups
from verification import views
from verification.registry import FLOAT, query

V = views.VIEWS

# ------------------------------------------------------------------------ legacy import

# Each line number dates its line in another way: three date layouts, month, quarter,
# half-year, year only.
V["legacy_source"] = """
    select l_orderkey as `Order No.`, l_linenumber as `Line`,
      case l_linenumber when 1 then cast(cast(l_shipdate as date) as string)
        when 2 then lpad(cast(day(l_shipdate) as string), 2, '0') || '/'
          || lpad(cast(month(l_shipdate) as string), 2, '0') || '/' || cast(year(l_shipdate) as string)
        when 3 then cast(cast(l_shipdate as date) as string) || 'T10:30:00' end as `Invoice Date`,
      case when l_linenumber = 4 then 'M' || lpad(cast(month(l_shipdate) as string), 2, '0') end as `Month`,
      case when l_linenumber = 5
        then 'q' || cast(cast(floor((month(l_shipdate) + 2) / 3) as int) as string) end as `Quarter`,
      case when l_linenumber = 6
        then 'H' || case when month(l_shipdate) <= 6 then '1' else '2' end end as `Half`,
      'FY' || cast(year(l_shipdate) as string) as `Fiscal Year`,
      case when l_partkey % 2 = 0 then cast(l_partkey as string) end as `Item Code`,
      'P' || cast(l_partkey as string) as `Item Code (old)`,
      cast(l_quantity as string) as `Qty`,
      case when l_linenumber = 7 then 'n.d.' else cast(l_extendedprice as string) end as `Gross Sales`,
      s_name as `Dealer`
    from {lineitem} join {supplier} on l_suppkey = s_suppkey"""
MAPPING_ROWS = [
    ("order_no", "order_key", "BIGINT"), ("Line", "line_no", "INTEGER"),
    ("invoice date", "date", "DATE"), ("MONTH", "month", "VARCHAR"),
    ("quarter", "quarter", "VARCHAR"), ("half", "semester", "VARCHAR"),
    ("fiscal-year", "year", "VARCHAR"), ("item code", "item_code", "varchar"),
    ("Item Code Old", "item_code", "VARCHAR"), ("qty", "quantity", "DECIMAL"),
    ("Gross Sales", "gross_sales", "DOUBLE"), ("dealer", "company", "TEXT"),
    ("dealer ", "company", "TEXT"), ("", "ignored", "TEXT"),
]

LEGACY = """
legacy as (
  select l_orderkey as order_key, l_linenumber as line_no,
    case when l_linenumber <= 3 then cast(l_shipdate as date)
      when l_linenumber = 4 then cast(date_trunc('month', l_shipdate) as date)
      when l_linenumber = 5 then cast(date_trunc('quarter', l_shipdate) as date)
      when l_linenumber = 6 then make_date(year(l_shipdate),
        case when month(l_shipdate) <= 6 then 1 else 7 end, 1)
      else make_date(year(l_shipdate), 1, 1) end as date,
    case when l_linenumber <= 4 then 'month' when l_linenumber = 5 then 'quarter'
      when l_linenumber = 6 then 'half-year' else 'year' end as time_frames,
    case when l_partkey % 2 = 0 then l_partkey || '' else 'P' || l_partkey end as item_code,
    l_quantity as quantity, case when l_linenumber <> 7 then l_extendedprice end as gross_sales,
    s_name as company
  from {lineitem} join {supplier} on l_suppkey = s_suppkey)"""


@query(
    "legacy_import",
    f"""with {LEGACY}
    select *, null::double as volumes, null::varchar as data_matrix, 'sell-out' as data_collection,
      'sell-out' as project, 'legacy_company.parquet' as file_name, 'legacy-1' as batch_id
    from legacy""",
)
def legacy_import(i):
    return mapping.import_mapped(
        i.legacy_source, mapping.read_mapping(MAPPING_ROWS), "legacy_company.parquet", "legacy-1"
    )


@query(
    "legacy_import_template",
    f"""with {LEGACY}
    select date, null::int as source_row_id, company, null::varchar as item_description,
      null::varchar as product_family_level_1, null::varchar as brand_company, item_code,
      null::varchar as channel_raw, null::varchar as customer, null::varchar as sales_country,
      null::varchar as is_saliva_ejector, null::varchar as gross_sales_currency, quantity,
      gross_sales, time_frames, null::double as volumes, null::varchar as data_matrix,
      'sell-out' as data_collection, 'sell-out' as project, 'company_027.parquet' as file_name
    from legacy""",
)
def legacy_import_template(i):
    known = [row for row in MAPPING_ROWS if row[1] not in ("order_key", "line_no")]
    return mapping.import_mapped(
        i.legacy_source,
        mapping.read_mapping(known),
        "company_027.parquet",
        template=mapping.TEMPLATE,
        forced_null=mapping.TEMPLATE_FORCED_NULL,
    )


V["mapping_table"] = """
    select p_brand || '-' || cast(p_size as string) as original_field, lower(p_type) as proposed_field,
      case when p_size % 2 = 0 then 'VARCHAR' else ' varchar ' end as data_types_found from {part}"""


@query(
    "mapping_conflicts",
    """select lower(replace(replace(original_field, '#', ''), '-', '')) as field_key,
      count(distinct (trim(proposed_field), upper(trim(data_types_found)))) as mapping_count
    from {mapping_table} group by 1
    having count(distinct (trim(proposed_field), upper(trim(data_types_found)))) > 1""",
)
def mapping_conflicts(i):
    return quality.mapping_conflicts(i.mapping_table)


# --------------------------------------------------------------------------- harmonised


def references(i):
    steps = rates.steps(i)
    return harmonise.References(
        dictionary=i.country_dictionary,
        countries=i.countries,
        aliases=i.country_aliases,
        companies=lookup.dim_company(i.company_names, canonical_company),
        country_currency=cut_lineage(rates._country_currency(i)),
        fx=cut_lineage(fx.time_frames(steps.all_rates(), fx.NORMALISED_KEYS)),
        products=lookups.master(i),
        customers=i.customer_reference,
    )


V["common_rows"] = """
    select date, upper(company) as company, company_type, company_item_code, item_code,
      item_description, customer_raw, destination_country_raw, channel_raw, time_frames, volumes,
      quantity, sales, billing_currency, cast(null as string) as data_matrix,
      'sell-out' as data_collection, 'sell-out' as project,
      file_name || '/' || cast(order_key as string) || '/' || cast(line_no as string) as file_name
    from {facts}"""


def harmonised(i, result):
    """``result`` of the harmonised rows. The lines are stored once, by slices of orders; products and customers are
    matched within a company, so one slice of canonical companies is harmonised at a time."""
    count = i.slices()
    unused = ("local_currency", "submission_id", "sellout_dm", "batch_id")

    def prepare():
        by_order = {"lineitem": F.col("l_orderkey"), "orders": F.col("o_orderkey")}
        return references(i), i.stored_in_slices("facts", unused, **by_order)

    def of_companies(n, refs, lines):
        def own(df):
            return df.where(in_slice(canonical_company(F.col("company")), n, count))

        part = i.with_frames(facts=own(lines))
        known = replace(refs, products=own(refs.products), customers=part.customer_reference)
        return result(
            harmonise.harmonise(part.common_rows, known, "batch-7", datetime.datetime(2024, 3, 1), 20240301000000000)
        )

    return in_slices(i.spark, count, of_companies, prepare)


HARMONISED = f"""{lookups.COUNTRY_LOOKUP}, {rates.ALL_RATES}, {rates.LOCAL}, {lookups.MASTER},
{lookups.BEST_REFERENCE}, {rates.EVENTS.replace('{facts}', '{common_rows}')},
monthly_rates as (
  select year, month, country_name, currency_base, currency_target,
    avg(exchange_rate) as rate from every group by all),
company_types as (
  select upper(trim(name)) as name, arg_min(type, id) as type from ({lookups.DIM_COMPANY}) d
  where type is not null group by 1),
harmonised as (
  select h.company, coalesce(t.type, h.company_type) as company_type, h.date, h.time_frames,
    trim(h.destination_country_raw) as destination_country_raw, g.country as destination_country,
    coalesce(trim(g.country) = '', true) as _missing_destination_country, h.customer_raw,
    b.customer, b.country, h.channel_raw, b.channel, h.item_code, h.company_item_code,
    h.item_description,
    coalesce(lower(trim(h.item_description)) <> lower(trim(p.description)), false) as is_new_description,
    p.mc_code as master_code, p.brand, p.prefix_code, p.father_name, p.pack, p.inner_count,
    p.inner_qty, p.pack_measure_unit, p.measure, p.feature, p.extra,
    case when p.item_code is null then 'New'
      when lower(trim(h.item_description)) <> lower(trim(p.description)) then 'Description Changed'
      else 'Matched' end as classification_status,
    l.local_currency,
    case when h.billing_currency = l.local_currency then 1.0 else r.rate end as billing_local_fx,
    h.sales * case when h.billing_currency = l.local_currency then 1.0 else r.rate end
      as sales_local_currency,
    h.billing_currency, h.sales_event_type, h.volumes, h.quantity, h.sales, h.data_matrix,
    h.data_collection, h.project, h.file_name
  from typed h
  left join looked_up g on g.country_raw = trim(h.destination_country_raw)
  left join company_types t on t.name = upper(trim(h.company))
  left join local_by_month l on l.year = year(h.date) and l.month = month(h.date)
    and l.country_join_key = upper(trim(g.country))
  left join monthly_rates r on r.year = year(h.date) and r.month = month(h.date)
    and upper(r.country_name) = upper(trim(g.country))
    and r.currency_base = h.billing_currency and r.currency_target = l.local_currency
  left join master p on p.company = h.company and p.item_code = h.item_code
  left join best b on b.k1 is not distinct from upper(trim(h.company))
    and b.k2 is not distinct from upper(trim(g.country))
    and b.k3 is not distinct from upper(trim(h.customer_raw)))"""


@query(
    "harmonized",
    f"""with {HARMONISED}
    select *, 'batch-7' as batch_id, 20240301000000000 as submission_id from harmonised""",
    {"billing_local_fx": FLOAT, "sales_local_currency": FLOAT},
)
def harmonized(i):
    return harmonised(i, lambda found: found.facts.drop("submission_ts"))


@query(
    "coverage_summary",
    f"""with {HARMONISED}
    select *, ((utility_matched_rows * 20000 + total_rows) // (2 * total_rows)) / 100.0
        as utility_match_pct
    from (select company, count(*) as total_rows,
        count(*) filter (coalesce(customer, destination_country, channel) is not null)
          as utility_matched_rows,
        count(*) filter (coalesce(customer, destination_country, channel) is null)
          as utility_unmatched_rows,
        count(*) filter (classification_status = 'Matched') as products_matched,
        count(*) filter (classification_status = 'New') as new_products,
        count(*) filter (sales is not null and sales_local_currency is null) as rows_without_fx,
        min(date) as min_date, max(date) as max_date, sum(sales) as total_sales,
        sum(quantity) as total_quantity
      from harmonised group by company) c""",
    {"total_sales": 2, "total_quantity": 2},
)
def coverage_summary(i):
    """A company's rows are all in one slice, which is summed up as it is harmonised."""
    return harmonised(i, lambda found: quality.coverage_summary(found.facts))


@query(
    "dq_row_preserved",
    """select count(*) as rows_before, count(*) as rows_after, true as passed from {facts}""",
)
def dq_row_preserved(i):
    dim = lookup.dim_company(i.company_names, canonical_company)
    enriched = lookup.enrich_customer_channel(
        lookup.enrich_company_type(i.facts, dim), i.customer_reference
    )
    return quality.row_preserved(i.facts, enriched)


@query(
    "dq_write_count",
    """select count(*) as expected, count(*) as written, true as passed from (
      select distinct company, item_code from {facts}) t""",
)
def dq_write_count(i):
    products = i.facts.select("company", "item_code").distinct()
    folder = f"{shared_folder(i.spark)}/written-{_run_id(i)}"
    products.write.mode("overwrite").parquet(folder)
    return quality.write_count(products, i.spark.read.parquet(folder))


@query(
    "dq_nulls",
    """select 'channel' as column_name, count(*) filter (channel is null) as null_count from {facts}
    union all select 'quantity', count(*) filter (quantity is null) from {facts}
    union all select 'sales', count(*) filter (sales is null) from {facts}
    union all select 'company', count(*) filter (company is null) from {facts}""",
)
def dq_nulls(i):
    return quality.null_counts(i.facts, ["channel", "quantity", "sales", "company"])


@query(
    "unmapped_report",
    """select channel_raw, count(*) as record_count from {facts}
    where channel_raw is not null and channel is null group by 1""",
)
def unmapped_report(i):
    return quality.unmapped_report(i.facts, "channel_raw", "channel")


# One expected company for each nation never reports.
ABSENT = "concat('Absent ', n_name)"


@query(
    "expected_sources",
    f"""with present as (
      select distinct company from {{facts}} where date between date '1998-07-01' and date '1998-12-31'),
    expected as (
      select s_name as company from {{supplier}} where s_acctbal > 0
      union all select {ABSENT} from {{nation}})
    select company, 'missing' as status from expected
    where company not in (select company from present)
    union all
    select company, 'unexpected' from present
    where company not in (select company from expected)""",
)
def expected_sources(i):
    expected = i.supplier.filter("s_acctbal > 0").select(F.col("s_name").alias("company"))
    absent = i.nation.select(F.expr(ABSENT).alias("company"))
    return quality.expected_sources(i.facts, expected.unionByName(absent), 1998, "H2")


@query(
    "source_audit",
    f"""select 'landing_' || lower(name) as table_name,
      case when name in (select company from {{facts}}) then 'found' else 'missing' end as status
    from (select s_name as name from {{supplier}} union all select {ABSENT} from {{nation}}) expected""",
)
def source_audit(i):
    def named(df, column):
        return df.select(F.concat(F.lit("landing_"), F.lower(column)).alias("table_name"))

    expected = i.supplier.select(F.col("s_name").alias("name")).unionByName(
        i.nation.select(F.expr(ABSENT).alias("name"))
    )
    return quality.source_audit(named(expected, "name"), named(i.facts, "company"))


# ------------------------------------------------------------------------------ streams


def _run_id(i) -> str:
    """Name for this run's folders below the shared folder."""
    return i.spark.range(1).select(F.uuid()).first()[0]


@query(
    "file_registry",
    "select t || '.parquet' as file_name, t as company_name, 'parquet' as file_extension, "
    "'batch-1' as batch_id from (values "
    + ", ".join(f"('{name}')" for name in views.TABLES)
    + ") tables(t)",
)
def file_registry(i):
    root = f"{shared_folder(i.spark)}/registry-{_run_id(i)}"
    found = files.register_files(
        i.spark,
        i.folder,
        "batch-1",
        f"{root}/table",
        f"{root}/checkpoint",
        r"^([a-z]+)",
        pathGlobFilter="*.parquet",
        recursiveFileLookup="true",
        maxFilesPerTrigger="1000",
    )
    return found.select("file_name", "company_name", "file_extension", "batch_id")


@query(
    "resubmission_stream",
    """with newest as (
      select company, date_trunc('month', date) as m, max(submission_id) as newest
      from {facts} group by all)
    select f.order_key, f.line_no, f.company, f.item_code, f.date, f.submission_id, f.quantity
    from {facts} f join newest n on n.company = f.company
      and n.m = date_trunc('month', f.date) and n.newest = f.submission_id""",
)
def resubmission_stream(i):
    root = f"{shared_folder(i.spark)}/resubmissions-{_run_id(i)}"
    rows = i.facts.select(
        "order_key", "line_no", "company", "item_code", "date", "submission_id", "quantity",
        marts.month_start(F.col("date")).alias("reporting_month"),
    )
    # Each submission lands in its own folder; the stream picks up one file at a time.
    rows.write.partitionBy("submission_id").parquet(f"{root}/landing")
    stream = (
        i.spark.readStream.schema(rows.schema)
        .option("maxFilesPerTrigger", "1")
        .parquet(f"{root}/landing")
    )
    current = resubmissions.apply_resubmissions(
        stream, f"{root}/table", f"{root}/checkpoint", ["company", "reporting_month"], "submission_id"
    )
    return current.drop("reporting_month")
