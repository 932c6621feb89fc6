"""Registry, country, company, customer and product lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.functions.companies import canonical_company
from tradeloom.operators import classify, lookup, quality
from tradeloom.operators.joins import measured
from tradeloom.operators.surrogate import with_surrogate
from tradeloom.plans import reference
from tradeloom.session import cut_lineage, in_slice, in_slices
from tradeloom.sources import mapping, registry, sinks
from verification import views
from verification.registry import query

CANONICAL = """case when upper(trim({c})) in ('COMPANY_045', 'COMPANY_GROUP_002') then 'COMPANY_GROUP_002'
  when upper(trim({c})) in ('COMPANY_001', 'COMPANY_070', 'COMPANY_GROUP_001') then 'COMPANY_GROUP_001'
  else upper(trim({c})) end"""


def canonical_sql(column: str) -> str:
    return CANONICAL.replace("{c}", column)


# ------------------------------------------------------------------------------ batches


@query(
    "latest_batch",
    """select batch_id from {registry} where lower(company_name) = 'company_007'
    order by ingestion_time desc, batch_id desc limit 1""",
)
def latest_batch(i):
    return registry.latest_batch(i.registry, "COMPANY_007")


@query(
    "batch_rows",
    """select file_key, file_name, company_name from {registry}
    where batch_id = 'batch-013' and company_name = 'company_013'""",
)
def batch_rows(i):
    return registry.batch_rows(i.registry, "batch-013", "Company_013").select(
        "file_key", "file_name", "company_name"
    )


@query(
    "batch_companies",
    "select distinct company_name from {registry} where batch_id = 'batch-013'",
)
def batch_companies(i):
    return registry.batch_companies(i.registry, "batch-013")


@query(
    "submission_id",
    """select batch_id,
      cast(strftime(max(ingestion_time), '%Y%m%d%H%M%S%g') as bigint) as submission_id
    from {registry} group by batch_id""",
)
def submission_id(i):
    return registry.submission(i.registry).select("batch_id", "submission_id")


# ------------------------------------------------------------------------------ sources

FIELD_MAPS = {
    "landing_company_040": {
        "date": "date", "company": "company", "company_type": "company_type",
        "company_item_code": "company_item_code", "item_code": "item_code",
        "item_description": "item_description", "customer_raw": "customer_raw",
        "destination_country_raw": "destination_country_raw", "channel_raw": "channel_raw",
        "time_frames": "time_frames", "volumes": "volumes", "quantity": "quantity",
        "sales": "sales", "billing_currency": "billing_currency", "project": "sell-out",
        "file_name": "file_name",
    },
    "landing_company_027": {
        "date": "date", "company": "COMPANY_045", "company_type": "dealer",
        "item_code": "item_code", "customer_raw": "customer", "time_frames": "semi-annual",
        "quantity": "quantity", "sales": "sales", "billing_currency": "EUR",
        "data_collection": "sell-out", "file_name": "file_name",
    },
}

COMMON_A = """
  select date, upper(company) as company, company_type, company_item_code, item_code,
    item_description, customer_raw, destination_country_raw, channel_raw, time_frames, volumes,
    quantity, sales, billing_currency, cast(null as varchar) as data_matrix,
    cast(null as varchar) as data_collection, 'sell-out' as project, file_name
  from {facts}"""
COMMON_B = """
  select date, 'COMPANY_GROUP_002' as company, 'dealer' as company_type,
    cast(null as varchar) as company_item_code, item_code, cast(null as varchar) as item_description,
    customer as customer_raw, cast(null as varchar) as destination_country_raw,
    cast(null as varchar) as channel_raw, 'semi-annual' as time_frames,
    cast(null as double) as volumes, quantity, sales, 'EUR' as billing_currency,
    cast(null as varchar) as data_matrix, 'sell-out' as data_collection,
    cast(null as varchar) as project, file_name
  from {facts}"""


@query("map_to_common_schema", COMMON_A)
def map_to_common_schema(i):
    return mapping.to_common(i.facts, FIELD_MAPS["landing_company_040"])


@query(
    "multi_source_union",
    f"{COMMON_A} where batch_id = 'batch-1' union all {COMMON_B} where batch_id = 'batch-1'",
)
def multi_source_union(i):
    landings = {
        "landing_company_040": i.facts, "landing_company_027": i.facts, "landing_company_099": None,
    }
    return mapping.union_sources(landings, FIELD_MAPS, "batch-1")


@query(
    "insert_only_merge",
    """select order_key, line_no, company, item_code, date, customer, channel from {facts} s
    where date >= date '1999-01-01' and not exists (
      select 1 from {facts} t where t.date < date '1999-01-01' and t.company is not distinct from s.company
        and t.item_code is not distinct from s.item_code
        and t.channel is not distinct from s.channel)""",
)
def insert_only_merge(i):
    target = i.facts.filter("date < date '1999-01-01'")
    source = i.facts.filter("date >= date '1999-01-01'")
    return sinks.insert_only(target, source, ["company", "item_code", "channel"]).select(
        "order_key", "line_no", "company", "item_code", "date", "customer", "channel"
    )


@query(
    "replace_period",
    """select order_key, line_no, item_code, year(date) || '' as period, 'old' as version
    from {facts} where year(date) < 1998 or year(date) > 1999
    union all
    select order_key, line_no, item_code, year(date) || '' as period, 'new' as version
    from {facts} where year(date) in (1998, 1999)""",
)
def replace_period(i):
    rows = i.facts.select(
        "order_key", "line_no", "item_code", F.year("date").cast("string").alias("period")
    )
    old = rows.withColumn("version", F.lit("old"))
    new = rows.filter("period in ('1998', '1999')").withColumn("version", F.lit("new"))
    return sinks.replace_period(old, new, "period")


# ---------------------------------------------------------------------------- companies


@query(
    "canonical_company",
    f"select id, {canonical_sql('company_name')} as company from {{company_names}}",
)
def canonical(i):
    return i.company_names.select("id", canonical_company(F.col("company_name")).alias("company"))


DIM_COMPANY = f"""select id, {canonical_sql('company_name')} as name,
  case when manufacturer then 'manufacturer' when dealer then 'dealer' end as type, active,
  cast(data_creation as date) as create_date from {{company_names}}"""


@query("dim_company", DIM_COMPANY)
def dim_company(i):
    return lookup.dim_company(i.company_names, canonical_company)


@query(
    "company_type_enrich",
    f"""with dim as ({DIM_COMPANY}),
    types as (select upper(trim(name)) as name, arg_min(type, id) as type from dim
      where type is not null group by 1)
    select f.order_key, f.line_no, f.item_code, f.company,
      coalesce(t.type, f.company_type) as company_type
    from {{facts}} f left join types t on upper(trim(f.company)) = t.name""",
)
def company_type_enrich(i):
    dim = lookup.dim_company(i.company_names, canonical_company)
    return lookup.enrich_company_type(i.facts, dim).select(
        "order_key", "line_no", "item_code", "company", "company_type"
    )


# ---------------------------------------------------------------------------- countries

COUNTRY_LOOKUP = """
raws as (
  select distinct trim(destination_country_raw) as country_raw from {facts}
  where trim(destination_country_raw) <> ''),
dict as (select distinct upper(trim(country_raw)) as k, id_country from {country_dictionary}),
names as (select id, trim(country_name) as country from {countries}),
mapped as (
  select r.country_raw, d.id_country, n.country, a.country_iso_name, n2.id as alias_id
  from raws r left join dict d on upper(r.country_raw) = d.k
  left join names n on n.id = d.id_country
  left join {country_aliases} a on upper(trim(a.alias)) = upper(r.country_raw)
  left join names n2 on upper(n2.country) = upper(a.country_iso_name)),
looked_up as (
  select country_raw, case when country is null then coalesce(id_country, alias_id)
      else id_country end as id_country,
    coalesce(country, country_iso_name) as country
  from mapped)"""


@query("country_lookup", f"with {COUNTRY_LOOKUP} select * from looked_up")
def country_lookup(i):
    return lookup.standardise_country(
        i.facts, "destination_country_raw", i.country_dictionary, i.countries, i.country_aliases
    )


@query(
    "unknown_value_staging",
    f"""with {COUNTRY_LOOKUP}
    select upper(country_raw) as country_join_key, country_raw, country_iso_name,
      alias_id as id_country, 0 as validated, 'PENDING' as validation_status
    from mapped where country is null
      and upper(country_raw) not in (select 'NATION_' || (n_nationkey + 1) from {{nation}}
        where n_nationkey % 10 = 8)
    qualify row_number() over (partition by upper(country_raw)
      order by country_raw nulls first, country_iso_name nulls first, alias_id nulls first) = 1""",
)
def unknown_value_staging(i):
    staged = i.nation.filter("n_nationkey % 10 = 8").select(
        F.concat(F.lit("NATION_"), (F.col("n_nationkey") + 1).cast("string")).alias(
            "country_join_key"
        )
    )
    found = lookup.unknown_countries(
        i.facts, "destination_country_raw", i.country_dictionary, i.countries, i.country_aliases
    )
    return lookup.stage_unknown(found, staged).drop("username", "created_at", "source_table")


# ---------------------------------------------------------------------------- customers

views.VIEWS["channels"] = """
    select min(c_custkey) % 7 + cast(length(c_mktsegment) as bigint) * 10 as id,
      c_mktsegment || ' ' as channel_name
    from {customer} where c_mktsegment <> 'MACHINERY' group by c_mktsegment"""
views.VIEWS["channel_texts"] = """
    select c.c_custkey as customer_key,
      case when c.c_custkey % 3 = 0 then ' ' || cast(h.id as string)
        when c.c_custkey % 3 = 1 then lower(c.c_mktsegment) else c.c_mktsegment || ' ' end
        as channel_raw
    from {customer} c left join {channels} h on trim(h.channel_name) = c.c_mktsegment"""
# Reference with rivals per key: other spellings, unvalidated and less complete rows.
# Customers of the machinery segment have not been seen before.
views.VIEWS["customer_reference"] = """
    select cast(order_key * 8 + line_no as bigint) as utility_id,
      case when order_key % 2 = 0 then lower(company) else company || ' ' end as company,
      destination_country_raw, cast(1 as bigint) as id_destination_country, destination_country,
      customer_raw,
      case when order_key % 5 = 0 then null else customer end as customer,
      cast(null as string) as country_raw, cast(null as bigint) as id_country,
      case when order_key % 7 = 0 then null else destination_country end as country,
      channel_raw, cast(2 as bigint) as id_channel, channel,
      case when order_key % 9 = 0 then null else order_key % 4 = 0 end as validated
    from {facts} where channel_raw <> 'MACHINERY'"""

BEST_REFERENCE = """
ranked as (
  select *, row_number() over (
    partition by upper(trim(company)), upper(trim(destination_country)), upper(trim(customer_raw))
    order by validated desc nulls last,
      (customer is not null)::int + (country is not null)::int + (channel is not null)::int desc,
      utility_id, channel_raw) as rank
  from {customer_reference}),
best as (
  select * exclude (rank), upper(trim(company)) as k1, upper(trim(destination_country)) as k2,
    upper(trim(customer_raw)) as k3
  from ranked where rank = 1)"""


@query(
    "best_reference_row",
    f"""with {BEST_REFERENCE}
    select k1, k2, k3, utility_id, validated, customer, country, channel from best""",
)
def best_reference_row(i):
    return lookup.best_reference(i.customer_reference).select(
        F.col("_key_company").alias("k1"),
        F.col("_key_destination_country").alias("k2"),
        F.col("_key_customer_raw").alias("k3"),
        "utility_id", "validated", "customer", "country", "channel",
    )


@query(
    "customer_channel_enrich",
    f"""with {BEST_REFERENCE}
    select f.order_key, f.line_no, f.item_code, f.company, b.customer, b.country, b.channel
    from {{facts}} f left join best b on upper(trim(f.company)) is not distinct from b.k1
      and upper(trim(f.destination_country)) is not distinct from b.k2
      and upper(trim(f.customer_raw)) is not distinct from b.k3""",
)
def customer_channel_enrich(i):
    return lookup.enrich_customer_channel(i.facts, i.customer_reference).select(
        "order_key", "line_no", "item_code", "company", "customer", "country", "channel"
    )


@query(
    "new_reference_rows",
    f"""with {COUNTRY_LOOKUP}, {BEST_REFERENCE},
    asked as (
      select trim(company) as company, trim(destination_country) as destination_country,
        trim(customer_raw) as customer_raw,
        min(trim(destination_country_raw)) as destination_country_raw,
        min(trim(channel_raw)) as channel_raw
      from {{facts}} group by 1, 2, 3),
    unmatched as (
      select a.* from asked a where not exists (select 1 from best b
        where upper(a.company) is not distinct from b.k1
          and upper(a.destination_country) is not distinct from b.k2
          and upper(a.customer_raw) is not distinct from b.k3))
    select (select max(utility_id) from {{customer_reference}}) + row_number() over (
        order by coalesce(u.company, ''), coalesce(u.destination_country, ''),
          coalesce(u.customer_raw, '')) as utility_id,
      u.company, u.destination_country_raw, l.id_country as id_destination_country,
      l.country as destination_country, u.customer_raw, u.channel_raw, false as validated
    from unmatched u left join looked_up l on l.country_raw = u.destination_country_raw""",
)
def new_reference_rows(i):
    return lookup.new_reference_rows(
        i.facts, i.customer_reference, i.country_dictionary, i.countries, i.country_aliases
    ).select(
        "utility_id", "company", "destination_country_raw", "id_destination_country",
        "destination_country", "customer_raw", "channel_raw", "validated",
    )


@query(
    "surrogate_keys",
    """select order_key, line_no, item_code, company, n,
      100 + row_number() over (order by company, item_code, order_key, line_no) as utility_id
    from (select order_key, line_no, item_code, company, count(*) as n
      from {facts} group by all) distinct_rows""",
)
def surrogate_keys(i):
    rows = i.facts.groupBy("order_key", "line_no", "item_code", "company").agg(
        F.count("*").alias("n")
    )
    order = [F.col(c) for c in ("company", "item_code", "order_key", "line_no")]
    return with_surrogate(rows, order, start=100)


CHANNEL_LOOKUP = """
  left join (select upper(trim(channel_name)) as k, min(id) as id, min(trim(channel_name)) as channel
    from {channels} group by 1) hn on hn.k = upper(trim(t.channel_raw))
  left join (select cast(id as varchar) as k, min(id) as id, min(trim(channel_name)) as channel
    from {channels} group by 1) hi on hi.k = trim(t.channel_raw)"""


@query(
    "channel_lookup",
    f"""select t.customer_key, t.channel_raw, coalesce(hn.id, hi.id) as id_channel,
      coalesce(hn.channel, hi.channel) as channel
    from {{channel_texts}} t {CHANNEL_LOOKUP}""",
)
def channel_lookup(i):
    return lookup.lookup_channel(i.channel_texts, i.channels)


REFERENCE_FIELDS = """
fields as (
  select distinct * from (
    select upper(trim(company)) as company, trim(destination_country_raw) as destination_country_raw,
      trim(customer_raw) as customer_raw, trim(customer) as customer,
      cast(null as varchar) as country_raw, trim(channel_raw) as channel_raw
    from {facts}
    union all
    select 'COMPANY_GROUP_002', null, lower(c_name), c_name, n_name, null
    from {customer} join {nation} on c_nationkey = n_nationkey) both_landings)"""


def _reference_fields(i):
    other = i.customer.join(i.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower("c_name").alias("wholesale_customer"),
        F.col("c_name").alias("Customer_Clean"),
        F.col("n_name").alias("Country"),
    )
    landings = {
        "landing_company_040": i.facts.withColumnRenamed("customer", "clean_customer"),
        "landing_company_045": other,
    }
    return reference.collect_reference_fields(landings, {})


@query(
    "ref_customers_channels",
    f"""with {REFERENCE_FIELDS},
    base as (
      select company, destination_country_raw, customer_raw, min(customer) as customer,
        min(country_raw) as country_raw, min(channel_raw) as channel_raw
      from fields group by 1, 2, 3),
    raws as (select distinct x as country_raw from (
      select destination_country_raw as x from base union all select country_raw from base) u
      where x is not null and x <> ''),
    {COUNTRY_LOOKUP[COUNTRY_LOOKUP.index('dict as'):]},
    by_key as (
      select upper(country_raw) as k, min(country) as country, min(id_country) as id_country
      from looked_up group by 1),
    numbered as (
      select t.*, d.id_country as id_destination_country, d.country as destination_country,
        c.id_country, c.country, coalesce(hn.id, hi.id) as id_channel,
        coalesce(hn.channel, hi.channel) as channel,
        row_number() over (order by t.company, t.destination_country_raw nulls first,
          t.customer_raw nulls first) as utility_id
      from base t left join by_key d on d.k = upper(t.destination_country_raw)
      left join by_key c on c.k = upper(t.country_raw) {CHANNEL_LOOKUP})
    select utility_id, company, destination_country_raw, id_destination_country,
      destination_country, customer_raw, customer, country_raw, id_country, country, channel_raw,
      id_channel, channel, true as validated
    from numbered""",
)
def ref_customers_channels(i):
    return reference.customer_channel_ref(
        _reference_fields(i), i.country_dictionary, i.countries, i.country_aliases, i.channels
    )


@query(
    "dq_conflicts",
    f"""with {REFERENCE_FIELDS},
    corrected as (
      select * from fields
      union all
      select 'COMPANY_GROUP_002', null, lower(c_name), case when c_custkey % 14 = 0 then upper(c_name) else c_name end,
        n_name, c_mktsegment
      from {{customer}} join {{nation}} on n_nationkey = (c_nationkey + 1) % 25 where c_custkey % 7 = 0)
    select company, customer_raw, count(distinct customer) as n_customer_values,
      count(distinct country_raw) as n_country_raw_values,
      count(distinct channel_raw) as n_channel_raw_values
    from corrected group by 1, 2
    having count(distinct customer) > 1 or count(distinct country_raw) > 1
      or count(distinct channel_raw) > 1""",
)
def dq_conflicts(i):
    """Customers that moved, some spelled anew, are reported a second time; each is a conflict."""
    moved = i.customer.join(i.nation, F.col("n_nationkey") == (F.col("c_nationkey") + 1) % 25).where("c_custkey % 7 = 0")
    again = moved.select(
        F.lit("COMPANY_GROUP_002").alias("company"),
        F.lower("c_name").alias("customer_raw"),
        F.when(F.col("c_custkey") % 14 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("customer"),
        F.col("n_name").alias("country_raw"),
        F.col("c_mktsegment").alias("channel_raw"),
    )
    fields = _reference_fields(i).unionByName(again, allowMissingColumns=True)
    return quality.conflicts(fields, ["company", "customer_raw"], ["customer", "country_raw", "channel_raw"])


@query(
    "dq_ambiguous_key",
    """select upper(trim(customer)) as lookup_key, count(distinct destination_country_raw) as value_count
    from {facts} where customer is not null group by 1
    having count(distinct destination_country_raw) > 1
    union all
    select upper(trim(company)) as lookup_key, count(distinct destination_country_raw) as value_count
    from {facts} where company is not null group by 1
    having count(distinct destination_country_raw) > 1""",
)
def dq_ambiguous_key(i):
    from pyspark.sql.functions import col

    def found(name):
        key = F.upper(F.trim(col(name)))
        return lookup.ambiguous_keys(i.facts, key, "destination_country_raw")

    return found("customer").unionByName(found("company"))


# ----------------------------------------------------------------------------- products

# Promotional parts are not in the master, so their lines stay unclassified.
views.VIEWS["products"] = """
    select distinct l_partkey * 100000 + l_suppkey as id,
      s_name || '|' || cast(l_partkey as string) as company_item_code, l_partkey, l_suppkey
    from {lineitem} join {supplier} on l_suppkey = s_suppkey
    join {part} on l_partkey = p_partkey where p_type <> 'PROMO'"""
views.VIEWS["brands"] = "select min(p_partkey) as id, p_brand as brand from {part} group by p_brand"
views.VIEWS["prefix_codes"] = (
    "select min(p_partkey) as id, p_type as prefix_code from {part} group by p_type"
)
views.VIEWS["father_names"] = (
    "select min(p_partkey) as id, p_name as father_name from {part} group by p_name"
)
views.VIEWS["packs"] = (
    "select p_size as id, 'Box of ' || cast(p_size as string) as pack from {part} group by p_size"
)
views.VIEWS["features"] = (
    "select p_size as id, 'F' || cast(p_size as string) as feature from {part} "
    "where p_size % 2 = 0 group by p_size"
)
views.VIEWS["measures"] = (
    "select p_size as id, cast(p_size as string) || ' mm' as measure from {part} group by p_size"
)
_VERSION = """
    select r.id * 10 + {v} as id, r.id as id_prod, {v} as version,
      {description} as description,
      r.l_suppkey as id_dealer, b.id as id_brand, t.id as id_prefix_code, n.id as id_father_name,
      p.p_size as id_mc, p.p_size as id_pack, p.p_size as id_feature, p.p_size as id_measure
    from {{products}} r join {{part}} p on r.l_partkey = p.p_partkey
    left join {{brands}} b on b.brand = p.p_brand
    left join {{prefix_codes}} t on t.prefix_code = p.p_type
    left join {{father_names}} n on n.father_name = p.p_name"""
# Every product has a first version; parts of odd size have a second one.
views.VIEWS["product_versions"] = (
    _VERSION.format(v=1, description="p.p_name")
    + " union all "
    + _VERSION.format(v=2, description="p.p_name || ' II'")
    + " where p.p_size % 2 = 1"
)
views.VIEWS["master_code"] = """
    select p_size as id, p_size % 5 as id_mc_lvl1, p_size % 7 as id_mc_lvl2, p_size as id_mc_lvl3
    from {part} group by p_size"""
for _level, _modulus in ((1, 5), (2, 7), (3, 1000)):
    views.VIEWS[f"mc_lvl{_level}"] = (
        f"select p_size % {_modulus} as id, p_size % {_modulus} as code from {{part}} "
        f"where p_size % 11 <> {_level} group by 1, 2"
    )
views.VIEWS["pack_qty"] = """
    select id * 2 + 1 as id, id as id_prod_version, 1 as inner_count, 1.5e0 as inner_qty,
      id_pack % 3 as id_pack_measure_unit from {product_versions}
    union all
    select id * 2, id, 2, 3.0e0, id_pack % 3 from {product_versions} where id_pack % 2 = 0"""
views.VIEWS["pack_measure_units"] = (
    "select p_size % 3 as id, 'U' || cast(p_size % 3 as string) as measure_unit from {part} "
    "where p_size % 3 <> 2 group by 1, 2"
)
# Product attributes of several value types; size 5 has no value and drops out.
views.VIEWS["attributes"] = """
    select p_partkey as id_prod, cast(1 as int) as id_prod_extra_attrib_field,
      cast(p_size as bigint) as id_prod_extra_attrib_allowed_val, cast(null as string) as val_text,
      cast(null as decimal(10, 2)) as val_decimal, cast(null as int) as val_integer,
      cast(null as boolean) as val_boolean, cast(null as date) as val_date,
      cast(null as string) as source_raw_val from {part}
    union all
    select p_partkey, 2, null, null, cast(p_retailprice as decimal(10, 2)), null, null, null, null from {part}
    union all
    select p_partkey, 3, null, null, null, case when p_size = 5 then null else p_size end, null, null, null
    from {part}
    union all
    select l_partkey, 4, null, null, null, null, null, cast(l_shipdate as date), null
    from {lineitem} where l_linenumber = 1
    union all
    select p_partkey, 5, null, null, null, null, p_size > 20, null, 'x' from {part}"""
views.VIEWS["attribute_fields"] = """
    select distinct l_linenumber as id, 'field_' || cast(9 - l_linenumber as string) as field_code
    from {lineitem}"""
views.VIEWS["allowed_values"] = """
    select distinct cast(p_size as bigint) as id, 'Size ' || cast(p_size as string) as val_label
    from {part} where p_size % 4 <> 0"""

EXTRAS = """
extras as (
  select id_prod, string_agg(field_code || '=' || val, '; ' order by field_code, val) as extra
  from (
    select a.id_prod, f.field_code, coalesce(v.val_label, a.val_text,
        cast(a.val_decimal as varchar), cast(a.val_integer as varchar),
        cast(a.val_boolean as varchar), strftime(a.val_date, '%Y-%m-%d'), a.source_raw_val) as val
    from {attributes} a join {attribute_fields} f on f.id = a.id_prod_extra_attrib_field
    left join {allowed_values} v on v.id = a.id_prod_extra_attrib_allowed_val) pairs
  where val is not null group by id_prod)"""


def _extras(i):
    return reference.product_extras(i.attributes, i.attribute_fields, i.allowed_values)


@query("product_extras", f"with {EXTRAS} select * from extras")
def product_extras(i):
    return _extras(i)


MASTER = (
    EXTRAS.replace("select id_prod, string_agg", "select id_prod as part_key, string_agg")
    + """,
versions as (
  select *, row_number() over (partition by id_prod order by version desc, id desc) as rank
  from {product_versions}),
pack_first as (
  select *, row_number() over (partition by id_prod_version order by id) as rank from {pack_qty}),
master as (
  select upper(split_part(r.company_item_code, '|', 1)) as company,
    split_part(r.company_item_code, '|', 2) as item_code, v.description,
    c.company_name as customer, b.brand, t.prefix_code, n.father_name,
    concat_ws('_', lpad(cast(m1.code as varchar), 2, '0'), lpad(cast(m2.code as varchar), 2, '0'),
      lpad(cast(m3.code as varchar), 2, '0')) as mc_code,
    p.pack, q.inner_count, q.inner_qty, u.measure_unit as pack_measure_unit, f.feature, m.measure,
    e.extra
  from versions v join {products} r on r.id = v.id_prod
  left join {company_names} c on c.id = v.id_dealer
  left join {brands} b on b.id = v.id_brand
  left join {prefix_codes} t on t.id = v.id_prefix_code
  left join {father_names} n on n.id = v.id_father_name
  left join {master_code} mc on mc.id = v.id_mc
  left join {mc_lvl1} m1 on m1.id = mc.id_mc_lvl1
  left join {mc_lvl2} m2 on m2.id = mc.id_mc_lvl2
  left join {mc_lvl3} m3 on m3.id = mc.id_mc_lvl3
  left join {packs} p on p.id = v.id_pack
  left join pack_first q on q.id_prod_version = v.id and q.rank = 1
  left join {pack_measure_units} u on u.id = q.id_pack_measure_unit
  left join {features} f on f.id = v.id_feature
  left join {measures} m on m.id = v.id_measure
  left join extras e on e.part_key = r.l_partkey
  where v.rank = 1)"""
)


MASTER_TABLES = (
    "brands", "prefix_codes", "father_names", "packs", "features", "measures",
    "master_code", "mc_lvl1", "mc_lvl2", "mc_lvl3", "pack_measure_units",
)


def master(i):
    """The product master. Products, their owners and extras are stored once; all other steps know a product by its
    id, so of many lines one slice of ids is worked through at a time."""
    count = i.slices()

    def prepare():
        products = i.stored_in_slices("products", lineitem=F.col("l_partkey"))
        item = F.split_part("company_item_code", F.lit("|"), F.lit(2))
        owners = in_slices(
            i.spark, count, lambda n: reference.product_owners(products.where(in_slice(item, n, count)))
        )
        tables = {name: measured(getattr(i, name)) for name in MASTER_TABLES}
        tables["companies"] = measured(i.company_names.select("id", "company_name"))
        return products, owners, tables, cut_lineage(_extras(i), "zstd")

    def of_ids(n, products, owners, tables, extras):
        own = i.with_frames(products=products.where(in_slice(F.col("id"), n, count)))
        named = own.products.select(F.col("id"), F.col("l_partkey").alias("id_prod")).join(extras, "id_prod")
        own = own.with_frames(product_versions=own.stored("product_versions"))
        return reference.product_master(
            own.product_versions,
            products,
            tables | {"pack_qty": own.stored("pack_qty")},
            named.select(F.col("id").alias("id_prod"), "extra"),
            owners.where(in_slice(F.col("id_prod"), n, count)),
        )

    return in_slices(i.spark, count, of_ids, prepare)


@query("dim_product_master", f"with {MASTER} select * from master")
def dim_product_master(i):
    return master(i)


CLASSIFIED = f"""{MASTER},
classified as (
  select f.*, m.brand as brand_found, m.mc_code, m.extra,
    case when m.item_code is null then 'New'
      when lower(trim(f.item_description)) <> lower(trim(m.description)) then 'Description Changed'
      else 'Matched' end as classification_status
  from {{facts}} f left join master m
    on upper(trim(f.company)) = m.company and upper(trim(f.item_code)) = upper(trim(m.item_code)))"""


@query(
    "product_classify",
    f"""with {CLASSIFIED}
    select order_key, line_no, company, item_code, brand_found as brand, mc_code, extra,
      classification_status, classification_status = 'Description Changed' as is_new_description
    from classified""",
)
def product_classify(i):
    """Lines and the master meet on the item, so one slice of items is worked through at a time."""
    count = i.slices()

    def of_items(n, known):
        def own(df):
            return df.where(in_slice(classify.item_key(F.col("item_code")), n, count))

        return classify.classify_product(own(i.facts), own(known)).select(
            "order_key", "line_no", "company", "item_code", "brand", "mc_code", "extra",
            "classification_status", "is_new_description",
        )

    return in_slices(i.spark, count, of_items, lambda: (master(i),))


@query(
    "product_to_classify",
    f"""with {CLASSIFIED}, ranked as (
      select *, row_number() over (partition by company, item_code
        order by date, file_name, item_description) as rank
      from classified where classification_status = 'New')
    select company, item_code, item_description as description, date as first_received_date,
      file_name as source_file, 'sell-out' as search_type, 'New' as status
    from ranked where rank = 1""",
)
def product_to_classify(i):
    return classify.new_products(classify.classify_product(i.facts, master(i))).drop("created_date")
