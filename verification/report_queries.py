"""Reshaping of report sheets; the sheets are laid out from the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.functions import text
from tradeloom.operators import quality, reports
from tradeloom.session import in_slice, in_slices
from verification import views
from verification.registry import query

V = views.VIEWS

# ------------------------------------------------------------------- named rows of a sheet

V["flat_rows"] = """
    select 'F' || cast(c_nationkey as string) as file_id, o_orderkey + 1 as row_idx,
      cast(o_orderkey as string) as ordine, cast(cast(o_orderdate as date) as string) as data,
      cast(cast(o_totalprice as decimal(18, 2)) as string) as importo, o_orderpriority as note
    from {orders} join {customer} on o_custkey = c_custkey"""
V["flat_cells"] = " union all ".join(
    f"""select file_id, row_idx, {index} as col_idx, {name} as text from {{flat_rows}}
    union all select 'F' || cast(n_nationkey as string), 0, {index}, '{head}' from {{nation}}"""
    for index, name, head in (
        (0, "ordine", " Ordine"), (1, "data", "DATA "), (2, "importo", "Importo"), (3, "note", "Altro"),
    )
)


@query(
    "cells_to_rows",
    "select file_id, row_idx, ordine, data, importo, cast(null as varchar) as sconto from {flat_rows}",
)
def cells_to_rows(i):
    return reports.cells_to_rows(i.flat_cells, ["ordine", "data", "importo", "sconto"])


# ------------------------------------------------------------------------- monthly sheets

_MONTHS = ",\n".join(
    f"coalesce(replace(cast(cast(sum(case when m = {n} then amount end) as decimal(18, 2)) as string), "
    f"'.', ','), '-') as {name}"
    for n, name in enumerate(reports.MONTH_COLUMNS, 1)
)
# Quantities miss the A lines and values the N lines, so some keys are in one file only.
V["month_lines"] = """
    select s_nationkey as k, year(l_shipdate) as y, month(l_shipdate) as m, 'quantity' as metric,
      l_partkey, p_name, p_type, l_quantity as amount
    from {lineitem} join {supplier} on l_suppkey = s_suppkey join {part} on l_partkey = p_partkey
    where l_returnflag <> 'A'
    union all
    select s_nationkey, year(l_shipdate), month(l_shipdate), 'value', l_partkey, p_name, p_type,
      l_extendedprice
    from {lineitem} join {supplier} on l_suppkey = s_suppkey join {part} on l_partkey = p_partkey
    where l_returnflag <> 'N'"""
_FILE = "'company_027_n' || cast(k as string) || '_market_' || metric || '_' || cast(y as string) || '.xlsx'"
V["month_sheet"] = f"""
    select {_FILE} as file_name, p_type as famiglia,
      ' ' || p_name || '   pz (' || cast(l_partkey as string) || ' ' || cast(k as string) || ' )' as articolo,
      {_MONTHS}
    from {{month_lines}} group by k, y, metric, l_partkey, p_name, p_type
    union all
    select {_FILE} as file_name, null as famiglia, 'TOTALE Total' as articolo, {_MONTHS}
    from {{month_lines}} group by k, y, metric"""

LONG = """
long_lines as (
  select 'company_027_n' || k || '_market_' || y as dataset_key, make_date(y, m, 1) as date,
    l_partkey || '' || k as item_code,
    trim(p_name || ' pz') as item_description, p_type as item_family, true as is_panel,
    case metric when 'quantity' then 'quantity' else 'gross_sales' end as metric_type,
    'company_027_n' || k || '_market_' || metric || '_' || y || '.xlsx' as file_name,
    sum(amount) as value
  from {month_lines} group by all)"""


def _long(i):
    kept = reports.drop_total_rows(i.stored("month_sheet"), ["famiglia", "articolo"])
    named = kept.withColumns(
        {
            **reports.dataset_metadata(F.col("file_name")),
            "item_code": text.trailing_code(F.col("articolo")),
            "item_description": text.without_trailing_code(F.col("articolo")),
        }
    ).withColumnRenamed("famiglia", "item_family")
    keep = [
        "dataset_key", "year", "item_code", "item_description", "item_family", "is_panel",
        "metric_type", "file_name",
    ]
    long = reports.unpivot_months(named, keep)
    return long.withColumn("date", F.make_date("year", "month", F.lit(1))).drop("year", "month")


@query(
    "drop_total_rows",
    """select distinct 'company_027_n' || k || '_market_' || metric || '_' || y || '.xlsx' as file_name,
      l_partkey as part_key from {month_lines}""",
)
def drop_total_rows(i):
    code = F.split(F.regexp_extract("articolo", r"\(([^()]*)\)\s*$", 1), " ")[0].try_cast("long")
    return reports.drop_total_rows(i.stored("month_sheet"), ["famiglia", "articolo"]).select(
        "file_name", code.alias("part_key")
    )


@query("unpivot_months", f"with {LONG} select * from long_lines where value <> 0", {"value": 2})
def unpivot_months(i):
    return _long(i)


MERGED = f"""{LONG},
merged as (
  select coalesce(q.dataset_key, v.dataset_key) as dataset_key, coalesce(q.date, v.date) as date,
    coalesce(q.item_code, v.item_code) as item_code,
    coalesce(q.item_description, v.item_description) as item_description,
    coalesce(q.item_family, v.item_family) as item_family,
    coalesce(q.is_panel, v.is_panel) as is_panel,
    coalesce(q.value, 0) as quantity, coalesce(round(v.value, 2), 0) as gross_sales,
    concat_ws(' | ', q.file_name, v.file_name) as file_name
  from (select * from long_lines where metric_type = 'quantity') q
  full outer join (select * from long_lines where metric_type = 'gross_sales') v
    using (dataset_key, date, item_code))"""


@query("merge_metric_files", f"with {MERGED} select * from merged", {"quantity": 2, "gross_sales": 2})
def merge_metric_files(i):
    return reports.merge_metric_files(_long(i))


@query(
    "key_coverage",
    f"""with {LONG}
    select dataset_key, date, item_code,
      case when max(metric_type) = 'quantity' then 'gross_sales' else 'quantity' end as missing_in
    from long_lines group by 1, 2, 3 having count(distinct metric_type) = 1""",
)
def key_coverage(i):
    return reports.key_coverage(_long(i))


@query(
    "control_totals",
    f"""with {MERGED}
    select count(*) as row_count, sum(cast(quantity as decimal(38, 12)))::double as quantity,
      sum(cast(gross_sales as decimal(38, 12)))::double as gross_sales from merged""",
    {"quantity": 2, "gross_sales": 2},
)
def control_totals(i):
    totals = quality.control_totals(reports.merge_metric_files(_long(i)))
    return totals.withColumns({c: F.col(c).cast("double") for c in ("quantity", "gross_sales")})


@query(
    "load_reconciliation",
    """with added as (select * from {facts} where batch_id = 'batch-2')
    select metric, amount::double as expected, amount::double as loaded, true as passed from (
      select 'row_count' as metric, count(*)::double as amount from added
      union all select 'quantity', sum(quantity)::decimal(38, 2) from added
      union all select 'sales', sum(sales)::decimal(38, 2) from added) t""",
    {"expected": 2, "loaded": 2},
)
def load_reconciliation(i):
    columns = ("quantity", "sales")
    batch = i.facts.filter("batch_id = 'batch-2'")
    landing = i.facts.filter("batch_id <> 'batch-2'")
    before = quality.totals_of_same_files(landing, batch, columns)
    after = quality.totals_of_same_files(landing.unionByName(batch), batch, columns)
    outcome = quality.reconcile(before, quality.control_totals(batch, columns), after, columns)
    return outcome.withColumns({c: F.col(c).cast("double") for c in ("expected", "loaded")})


@query(
    "dq_invalid_numeric",
    """select 'quantity' as column_name, count(*) filter (quantity is null) as invalid_count from {facts}
    union all select 'sales', count(*) filter (sales is null) from {facts}
    union all select 'volumes', count(*) filter (volumes is null) from {facts}""",
)
def dq_invalid_numeric(i):
    return quality.invalid_numeric(i.facts, ["quantity", "sales", "volumes"])


# --------------------------------------------------------------------------- file names


@query(
    "filename_metadata",
    """select o_orderkey as file_key, 'Company_' || lpad(o_custkey % 40 || '', 3, '0') as company,
      'Italy' as country,
      case o_orderkey % 3 when 0 then 'distributor' when 1 then 'direct_sales' end as channel,
      year(o_orderdate) as year,
      case when o_orderkey % 2 = 0 then 'quarterly' when o_orderkey % 7 = 0 then 'semi-annual'
        else 'monthly' end as period_type,
      case when o_orderkey % 2 = 0 then cast(date_trunc('quarter', o_orderdate) as date)
        when o_orderkey % 7 = 0 then make_date(year(o_orderdate),
          case when month(o_orderdate) <= 6 then 1 else 7 end, 1)
        else cast(date_trunc('month', o_orderdate) as date) end as date
    from {orders}""",
)
def filename_metadata(i):
    found = reports.filename_metadata(F.col("file_name"))
    return i.registry.select(
        "file_key", *[found[n].alias(n) for n in ("company", "country", "channel", "year", "period_type", "date")]
    )


# ------------------------------------------------------------------------- flat exports

V["flat_a"] = """
    select l_orderkey as order_key, l_linenumber as line_no, l_partkey as part_key,
      case when l_linenumber = 5 then '1.202'
        else lpad(cast(month(l_shipdate) as string), 2, '0') || '.' || cast(year(l_shipdate) as string)
        end as month_text,
      cast(year(l_shipdate) as string) as year_no, cast(month(l_shipdate) as string) as month_no,
      ' ' || lower(n_name) as country,
      case c_mktsegment when 'BUILDING' then '00 Domestic Trade Sales'
        when 'FURNITURE' then '02 Export Trade Sales' else c_mktsegment end as account_group,
      cast(l_partkey as string) || '  ' || p_name || ' ' as material,
      p_type || ' ' as key_product, p_brand as product_planning,
      cast(c_custkey as string) || '  ' || c_name as sold_to,
      case when l_linenumber = 6 then 'n/a' else cast(cast(l_extendedprice as decimal(18, 2)) as string)
        end as gross_sales, 'EUR' as gross_sales_currency,
      case when l_linenumber = 7 then '' else cast(cast(l_quantity as decimal(18, 1)) as string) end
        as quantity, 'PC' as quantity_uom, 'SO' || cast(n_regionkey as string) as sales_organization,
      'OF' || cast(n_nationkey as string) as sales_office, substr(p_brand, 1, 7) as business_unit,
      l_returnflag as line_of_business, l_linestatus as pac1, cast(p_size as string) as pac23,
      'C' || cast(n_nationkey as string) as country_code,
      case when l_linenumber = 3 then '-' else cast(cast(l_tax as decimal(6, 4)) as string) end as sales_packet,
      'PCK' as sales_packet_currency,
      cast(cast(p_retailprice as decimal(18, 2)) as string) as gross_avg_price, 'EUR' as gross_avg_price_currency,
      case when l_linenumber = 2 then '' else cast(cast(l_discount as decimal(6, 2)) as string) end
        as packet_avg_price, 'USD' as packet_avg_price_currency,
      'company_011_' || cast(n_nationkey as string) || '.xlsx' as file_name,
      l_tax as tax, l_discount as discount, p_retailprice as retail, p_size as size,
      l_returnflag as returned, l_linestatus as status, n_nationkey as k, n_regionkey as region,
      l_shipdate as shipped, l_extendedprice as price,
      l_quantity as sold, p_name, p_type, p_brand, c_custkey, c_name, n_name, c_mktsegment
    from {lineitem} join {orders} on l_orderkey = o_orderkey
    join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
    join {part} on l_partkey = p_partkey"""


@query(
    "flat_report_a",
    """select cast(date_trunc('month', shipped) as date) as date, 'COMPANY_011' as company,
      'N' || lower(substr(n_name, 2)) as country,
      case c_mktsegment when 'BUILDING' then 'direct_sales' when 'FURNITURE' then 'distribution' end
        as channel,
      part_key || '' as item_code, p_name as item_description, p_type || '/' || p_brand as categories,
      c_custkey || '' as customer_code, c_name as customer,
      case when line_no <> 6 then price end as gross_sales, 'EUR' as gross_sales_currency,
      account_group as customer_account_assignment_group, 'SO' || region as sales_organization,
      'OF' || k as sales_office, p_brand[1:7] as business_unit, returned as line_of_business, status as pac1,
      size || '' as pac23, 'C' || k as country_code,
      case when line_no <> 3 then round(tax, 2) end as sales_packet, 'PCK' as sales_packet_currency,
      retail as gross_avg_price, 'EUR' as gross_avg_price_currency,
      case when line_no <> 2 then discount end as packet_avg_price, 'USD' as packet_avg_price_currency,
      'company_011_' || k || '.xlsx' as file_name,
      case when line_no = 7 then 0 else cast(sold as int) end as quantity, 'PC' as quantity_uom
    from {flat_a}""",
    {"sales_packet": 2, "gross_avg_price": 2, "packet_avg_price": 2},
)
def flat_report_a(i):
    parsed = reports.flat_report_a(i.flat_a, "COMPANY_011")
    return parsed.withColumn("categories", F.array_join("item_categories", "/")).drop(
        "item_categories"
    )


V["flat_b"] = """
    select l_linenumber + (l_orderkey % 100000) * 10 as sheet_row,
      'company_039_n' || cast(n_nationkey as string) || '.xlsx' as file_name,
      substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(l_shipdate) * 3 - 2, 3) || ' '
        || lpad(cast(day(l_shipdate) as string), 2, '0') || '  ' || cast(year(l_shipdate) as string)
        || ' 10:00:00:000AM' as fecha,
      case when n_nationkey = 0 then 'ESPAÑA ' else ' ' || n_name end as nombre,
      cast(l_partkey as string) || case when l_linenumber % 2 = 0 then '.0' else '' end as item,
      ' ' || p_name || '  ' || p_type as producto,
      case when c_custkey % 5 = 0 then ' ' else replace(c_name, '#', '  ') end as cliente,
      lpad(cast(c_custkey as string), 5, '0') as postal_code,
      ' Type  ' || p_type || ' ' as descripcion, cast(l_suppkey as string) || '.0' as codfabricante,
      p_brand || '  ' as marca, case when c_custkey % 7 = 0 then '  ' else 'Town  of ' || n_name end as localida,
      cast(n_nationkey as string) || '.00' as codprovincia, ' ' || n_name as provincia,
      'C' || cast(n_nationkey as string) || ' ' as codpais, l_returnflag || ' ' as serie,
      cast(l_orderkey as string) || '.0' as document, cast(l_linenumber as string) as linea,
      'Tarifa   ' || l_linestatus as tarifa, l_suppkey as supplier, p_brand, l_returnflag as returned,
      l_linestatus as status, l_orderkey as order_key,
      cast(cast(l_quantity as int) as string) as unidades,
      cast(cast(l_extendedprice as decimal(18, 2)) as string) as precio,
      case when l_linenumber = 3 then 'libre' else cast(cast(l_discount as decimal(4, 2)) as string) end
        as cargo,
      l_shipdate as shipped, l_linenumber as line_no, l_partkey as part_key, l_quantity as sold,
      l_extendedprice as price, l_discount as charge, n_nationkey as k, n_name, p_name, p_type,
      c_name, c_custkey
    from {lineitem} join {orders} on l_orderkey = o_orderkey
    join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
    join {part} on l_partkey = p_partkey"""


@query(
    "flat_report_b",
    """select *, gross_sales * (1 + sales_charge) as gross_sales_with_charges from (
      select cast(shipped as date) as date, sheet_row + 2 as source_row_id,
        'company_039_n' || k || '|' || (sheet_row + 2) as source_key,
        'COMPANY_039|' || part_key as company_item_code, 'COMPANY_039' as company,
        part_key || '' as item_code, p_name || ' ' || p_type as item_description,
        case when c_custkey % 5 <> 0 then replace(c_name, '#', ' ') end as customer_raw,
        lpad(c_custkey || '', 5, '0') as postal_code, 'Type ' || p_type as product_family_level_1,
        supplier || '' as manufacturer_item_code, p_brand as brand_company,
        case when c_custkey % 7 <> 0 then 'Town of ' || n_name end as locality, k || '' as province_code,
        n_name as province, 'C' || k as country_code, returned as series, order_key || '' as document_number,
        line_no || '' as product_line, 'Tarifa ' || status as price_list, cast(null as varchar) as clean_customer,
        cast(null as varchar) as channel_raw, cast(null as varchar) as data_matrix,
        case when k = 0 then 'Spain' else 'N' || lower(substr(n_name, 2)) end as country_raw,
        case when k = 0 then 'Spain' else 'N' || lower(substr(n_name, 2)) end as destination_country_raw,
        round(sold * price, 2) as gross_sales, case when line_no = 3 then 0 else charge end as sales_charge,
        'month' as time_frames, cast(null as double) as volumes, sold as quantity,
        'sell-out' as data_collection, 'sell-out' as project, file_name
      from {flat_b}) t""",
    {"gross_sales": 2, "gross_sales_with_charges": 4},
)
def flat_report_b(i):
    return reports.flat_report_b(i.flat_b, "COMPANY_039")


# ------------------------------------------------------------------- family / brand sheets

_TYPE = (
    "case {c} when 'ECONOMY' then 0 when 'LARGE' then 1 when 'MEDIUM' then 2 when 'PROMO' then 3 "
    "when 'SMALL' then 4 else 5 end"
)
V["brand_lines"] = """
    select 'S' || cast(s_nationkey as string) || '-' || cast(year(l_shipdate) as string) as file_id,
      p_type as family, %s as t, p_size %% 4 as q,
      p_brand as brand, cast(substr(p_brand, 7) as int) as b, sum(l_quantity) as quantity
    from {lineitem} join {supplier} on l_suppkey = s_suppkey join {part} on l_partkey = p_partkey
    group by s_nationkey, year(l_shipdate), p_type, p_size %% 4, p_brand""" % _TYPE.replace(
    "{c}", "p_type"
)
# A head row per subfamily with the total of its brands; only even ones end in a placeholder.
V["brand_sheet"] = """
    select file_id, t * 1000000 + q * 10000 + b as row_idx, cast(null as string) as familia,
      ' ' || brand as label, quantity as value from {brand_lines}
    union all
    select h.file_id, h.t * 1000000 + h.q * 10000 as row_idx,
      case when h.q = f.first_q then h.family || ' ' end as familia,
      'Sub ' || cast(h.q as string) as label, h.total as value
    from (select file_id, family, t, q, sum(quantity) as total from {brand_lines}
      group by file_id, family, t, q) h
    join (select file_id, t, min(q) as first_q from {brand_lines} group by file_id, t) f
      on f.file_id = h.file_id and f.t = h.t
    union all
    select distinct file_id, t * 1000000 + q * 10000 + 9999, cast(null as string),
      'MARCA 9 (rellenar con nombre de la marca)', cast(null as double)
    from {brand_lines} where q % 2 = 0"""


@query(
    "block_segments",
    """select file_id, t * 1000000 + q * 10000 + b as row_idx, family, 'Sub ' || q as subfamily, brand,
      quantity from {brand_lines}""",
)
def block_segments(i):
    return reports.block_segments(i.stored("brand_sheet"))


# The title of a family sheet is its country, two of them written in Spanish and in capitals.
V["brand_files"] = """
    select distinct s_nationkey as k, 'S' || cast(s_nationkey as string) || '-' || cast(year(l_shipdate) as string) as file_id,
      'Company_' || cast(s_nationkey as string) || '_global_' || cast(year(l_shipdate) as string) || '_' ||
        case s_nationkey % 4 when 0 then 'q3' when 1 then 'H2' when 2 then '11' else 'q1' end || '.xlsx' as file_name
    from {lineitem} join {supplier} on l_suppkey = s_suppkey"""
V["brand_titles"] = """
    select file_id, 1 as row_idx, 0 as col_idx, case when k = 3 then ' ESPA\u00d1A ' else ' ' || n_name end as text
    from {brand_files} join {nation} on k = n_nationkey
    union all select file_id, 0, 0, 'Report' from {brand_files}
    union all select file_id, 1, 1, 'other' from {brand_files}"""


@query(
    "brand_landing",
    """select cast(left(split_part(file_name, '_', 4), 4) || case k % 4 when 0 then '-07-01' when 1 then '-07-01'
        when 2 then '-11-01' else '-01-01' end as date) as date,
      'Company_' || k as company, case when k = 3 then 'Spain' else country end as country,
      brand as item_description, family || '/Sub ' || q as categories, quantity,
      case k % 4 when 1 then 'semi-annual' when 2 then 'monthly' else 'quarterly' end as period_type, file_name,
      t * 1000000 + q * 10000 + b as row_idx
    from {brand_lines} join {brand_files} using (file_id)
    join (select n_nationkey as k, array_to_string(list_transform(string_split(lower(n_name), ' '),
      lambda w: upper(w[1]) || w[2:]), ' ') as country from {nation}) n using (k)""",
)
def brand_landing(i):
    files = i.brand_files.join(reports.sheet_countries(i.brand_titles), "file_id")
    rows = reports.brand_landing(reports.block_segments(i.stored("brand_sheet"), 2_000), files)
    return rows.withColumn("categories", F.array_join("item_categories", "/")).drop("item_categories")


# ---------------------------------------------------------------------------- spanned grid

V["span_leaves"] = """
    select distinct l_suppkey as s, p_type, %s as t, p_brand, cast(substr(p_brand, 7) as int) as b
    from {lineitem} join {part} on l_partkey = p_partkey""" % _TYPE.replace("{c}", "p_type")
V["span_cells"] = """
    select distinct cast(s as string) as file_id, 0 as row_idx, 0 as cell_idx, 1 as colspan,
      2 as rowspan, 'corner' as text, cast(null as double) as num from {span_leaves}
    union all
    select cast(s as string), 0, t + 1, count(*), 1, p_type, cast(null as double)
    from {span_leaves} group by s, t, p_type
    union all
    select cast(s as string), 1, t * 100 + b, 1, 1, p_brand, cast(null as double) from {span_leaves}
    union all
""" + "\n    union all\n".join(
    f"""    select cast(l_suppkey as string), 2 + l_partkey, {c}, {2 if c == 1 else 1}, 1,
      'cell {c}', {'sum(l_quantity)' if c else 'cast(null as double)'}
    from {{lineitem}} group by l_suppkey, l_partkey"""
    for c in range(3)
)


@query(
    "span_expand",
    """with leaves as (
      select *, row_number() over (partition by s order by t, b) as col from {span_leaves}),
    body as (select l_suppkey as s, l_partkey, sum(l_quantity) as total from {lineitem} group by all)
    select distinct s || '' as file_id, r as row_idx, 0 as col_idx, 'corner' as text,
      null::double as num from leaves, unnest([0, 1]) as u(r)
    union all select s || '', 0, col, p_type, null from leaves
    union all select s || '', 1, col, p_brand, null from leaves
    union all select s || '', l_partkey + 2, c, case c when 0 then 'cell 0' when 3 then 'cell 2'
        else 'cell 1' end, case when c > 0 then total end
      from body, unnest([0, 1, 2, 3]) as u(c)""",
)
def span_expand(i):
    """A file is a supplier's; of many lines, one slice of files is worked through at a time."""
    count = i.slices()

    def of_files(n):
        return reports.span_expand(i.sliced(n, count, lineitem=F.col("l_suppkey")).stored("span_cells"))

    return in_slices(i.spark, count, of_files)


# ----------------------------------------------------------------------------- matrix export

_SEGMENT = (
    "case c_mktsegment when 'AUTOMOBILE' then 0 when 'BUILDING' then 1 when 'FURNITURE' then 2 "
    "when 'HOUSEHOLD' then 3 else 4 end"
)
V["matrix_lines"] = f"""
    select cast(s_nationkey * 10000 + year(l_shipdate) as string) as file_id,
      (s_nationkey + year(l_shipdate)) % 2 as odd, {_TYPE.replace('{c}', 'p_type')} as t, p_type,
      cast(substr(p_brand, 7) as bigint) as b, p_brand, l_partkey, p_name,
      month(l_shipdate) as m, {_SEGMENT} as s, c_mktsegment,
      sum(l_extendedprice) as sales, sum(l_quantity) as quantity
    from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
    join {{customer}} on o_custkey = c_custkey join {{supplier}} on l_suppkey = s_suppkey
    join {{part}} on l_partkey = p_partkey
    group by s_nationkey, year(l_shipdate), p_type, p_brand, l_partkey, p_name,
      month(l_shipdate), c_mktsegment"""
_TYPE_ROW = "5 + cast(t as bigint) * 1000000000000"
_BRAND_ROW = f"{_TYPE_ROW} + b * 10000000000"
_LEAF_ROW = f"{_BRAND_ROW} + l_partkey * 12 + m"
V["matrix_rows"] = f"""
    select distinct file_id, odd, {_TYPE_ROW} as row_idx, '' as month_text,
      lpad(cast(t + 1 as string), 2, '0') as code, p_type as description from {{matrix_lines}}
    union all
    select distinct file_id, odd, {_BRAND_ROW}, '',
      lpad(cast(t + 1 as string), 2, '0') || lpad(cast(b as string), 2, '0'), p_brand
    from {{matrix_lines}}
    union all
    select distinct file_id, odd, {_LEAF_ROW}, cast(m as string),
      'A' || cast(l_partkey as string) || 'XY', p_name from {{matrix_lines}}
    union all
    select distinct file_id, odd, 9000000000000, '', 'Overall Result', '' from {{matrix_lines}}"""
# Scenario, code and name heads change places between files.
_HEADS = """
    select file_id, 0 as row_idx, c as col_idx, metric as text from {matrix_columns}
    union all select file_id, case when odd = 1 then 3 else 1 end, c, 'ACT 25' from {matrix_columns}
    union all select file_id, 2, c, partner_code from {matrix_columns}
    union all select file_id, case when odd = 1 then 1 else 3 end, c, partner_name from {matrix_columns}
    union all select file_id, 4, c, unit from {matrix_columns}"""
V["matrix_columns"] = """
    select distinct file_id, odd, 4 + 2 * s as c, 'Gross Sales' as metric,
      cast(1000 + s as string) as partner_code, c_mktsegment as partner_name, 'EUR' as unit
    from {matrix_lines}
    union all
    select distinct file_id, odd, 5 + 2 * s, 'Quantity', cast(1000 + s as string), c_mktsegment,
      case when s % 2 = 0 then '* 1 000 PC' else 'PC' end from {matrix_lines}
    union all
    select distinct file_id, odd, 14, 'Gross Sales', 'Overall Result', 'Overall Result', 'EUR'
    from {matrix_lines}"""
V["matrix_cells"] = f"""
    select file_id, row_idx, col_idx, text, cast(null as double) as num from ({_HEADS}) heads
    union all select file_id, row_idx, 0, month_text, cast(null as double) from {{matrix_rows}}
    union all select file_id, row_idx, 2, code, cast(null as double) from {{matrix_rows}}
    union all select file_id, row_idx, 3, description, cast(null as double) from {{matrix_rows}}
    union all select file_id, {_LEAF_ROW}, 4 + 2 * s, '-', sales from {{matrix_lines}}
    union all select file_id, {_LEAF_ROW}, 5 + 2 * s, '-', quantity from {{matrix_lines}}
    union all select file_id, {_LEAF_ROW}, 14, '-', sum(sales) from {{matrix_lines}}
      group by file_id, t, b, l_partkey, m"""


@query(
    "header_roles",
    """select distinct file_id, case when odd = 1 then 3 else 1 end as scenario_row, 2 as code_row,
      case when odd = 1 then 1 else 3 end as name_row from {matrix_lines}""",
)
def header_roles(i):
    return reports.header_roles(i.stored("matrix_cells"))


def _by_files(i, build):
    """``build`` over the sheets. All their relations are made of the matrix lines, which are therefore stored first;
    files are independent, so of many lines one slice of files is laid out and read at a time."""
    count = i.slices()

    def of_files(n, lines):
        return build(i.with_frames(matrix_lines=lines.where(in_slice(F.col("file_id"), n, count))))

    return in_slices(
        i.spark, count, of_files, lambda: (i.stored_in_slices("matrix_lines", lineitem=F.col("l_partkey")),)
    )


def _categories(leaves):
    return leaves.withColumn("categories", F.array_join("item_categories", "/")).drop("item_categories")


def _matrix_long(cells):
    leaves = reports.hierarchy_leaves(_sheet_rows(cells))
    return reports.matrix_to_long(cells, leaves, reports.header_roles(cells))


def _sheet_rows(cells):
    def at(column):
        return F.max(F.when(F.col("col_idx") == column, F.col("text")))

    return (
        cells.filter((F.col("row_idx") >= reports.HEADER_ROWS) & (F.col("col_idx") < 4))
        .groupBy("file_id", "row_idx")
        .agg(at(0).alias("month_text"), at(2).alias("code"), at(3).alias("description"))
    )


@query(
    "hierarchy_leaves",
    f"""select distinct file_id, {_LEAF_ROW} as row_idx, m || '' as month_text,
      'A' || l_partkey || 'XY' as code, p_name as description, p_type || '/' || p_brand as categories
    from {{matrix_lines}}""",
)
def hierarchy_leaves(i):
    return _by_files(i, lambda own: _categories(reports.hierarchy_leaves(_sheet_rows(own.stored("matrix_cells")))))


@query(
    "matrix_to_long",
    f"""select file_id, {_LEAF_ROW} as row_idx, m || '' as month_text, 'A' || l_partkey || 'XY' as code,
      p_name as description, p_type || '/' || p_brand as categories, 'A' || l_partkey as item_code,
      1000 + s || '' as partner_id, c_mktsegment as customer_raw, sales as gross_sales,
      quantity * case when s % 2 = 0 then 1000 else 1 end as quantity
    from {{matrix_lines}}""",
    {"gross_sales": 2, "quantity": 2},
)
def matrix_to_long(i):
    return _by_files(i, lambda own: _categories(_matrix_long(own.stored("matrix_cells"))))


V["matrix_files"] = """
    select distinct file_id, 'Company_' || cast(floor(cast(file_id as bigint) / 10000) as bigint) || '_italy_' ||
      case when odd = 1 then 'directsales_' else 'distributor_' end ||
      cast(cast(file_id as bigint) % 10000 as string) || '_q4.mhtml' as file_name
    from {matrix_lines}"""


@query(
    "matrix_landing",
    f"""select make_date(cast(cast(file_id as bigint) % 10000 as int), cast(m as int), 1) as date,
      {_LEAF_ROW} as source_row_id,
      replace(file_name, '.mhtml', '') || '|' || case when odd = 1 then 'direct_sales' else 'distributor' end ||
        '|' || ({_LEAF_ROW}) || '|' || (1000 + s) as source_key,
      split_part(file_name, '_italy', 1) || '|A' || l_partkey as company_item_code,
      split_part(file_name, '_italy', 1) as company, p_name as item_description, 'Maker' as brand_company,
      'A' || l_partkey as item_code, case when odd = 1 then 'direct_sales' else 'distributor' end as channel_raw,
      c_mktsegment as customer_raw, cast(null as varchar) as clean_customer, cast(null as varchar) as country_raw,
      'Italy' as destination_country_raw, 'EUR' as gross_sales_currency, 'month' as time_frames,
      cast(null as double) as volumes, quantity * case when s % 2 = 0 then 1000 else 1 end as quantity,
      sales as gross_sales, cast(null as varchar) as data_matrix, 'sell-out' as data_collection,
      'sell-out' as project, file_name
    from {{matrix_lines}} join {{matrix_files}} using (file_id)""",
    {"gross_sales": 2, "quantity": 2},
)
def matrix_landing(i):
    return _by_files(
        i, lambda own: reports.matrix_landing(_matrix_long(own.stored("matrix_cells")), own.matrix_files, "Maker")
    )
