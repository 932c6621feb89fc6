"""Input relations derived from the provided tables.

Each relation is one SQL text that Spark and DuckDB read alike, so both sides of a check
start from the same rows. ``{name}`` refers to a table or to another relation. Only inputs
are defined here; what is being checked is written twice, elsewhere.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

COUNTRY = (
    "case {n}.n_nationkey when 0 then 'Spain' when 1 then 'Portugal' when 2 then 'Italy' "
    "when 3 then 'Iberia' when 4 then 'Andorra' else {n}.n_name end"
)


def country(alias: str) -> str:
    return COUNTRY.replace("{n}", alias)


# Currency of nation k before and after its switch month (2 and 3 never switch here).
CURRENCY_BEFORE = (
    "case k when 0 then 'EUR' when 1 then 'EUR' when 2 then 'USD' when 3 then 'HRK' "
    "when 4 then 'BYR' when 5 then 'VEF' when 6 then 'USD' when 7 then 'SYP' when 8 then 'MRO' "
    "else 'N' || lpad(cast(k as string), 2, '0') end"
)
CURRENCY_AFTER = (
    "case k when 3 then 'EUR' when 4 then 'BYN' when 5 then 'VES' when 6 then 'ZWL' "
    "when 8 then 'MRU' else " + CURRENCY_BEFORE + " end"
)
SWITCH_MONTH = "case k when 3 then 199801 when 4 then 199707 when 5 then 199901 when 6 then 199806 else 199804 end"


def currency(relation: str, month: str) -> str:
    """Currency in ``month`` (a yyyymm number) by a joined row of ``nation_currency``."""
    return (
        f"case when {month} <= {relation}.switch_ym then {relation}.code_before "
        f"else {relation}.code_after end"
    )


def yyyymm(date: str) -> str:
    return f"(year({date}) * 100 + month({date}))"


VIEWS: dict[str, str] = {
    "nation_currency": f"""
        select k, {SWITCH_MONTH} as switch_ym, {CURRENCY_BEFORE} as code_before,
          {CURRENCY_AFTER} as code_after
        from (select n_nationkey as k from {{nation}}) keys""",
    # Report lines in harmonised form; signs, zeros and NULLs make every event class occur.
    "facts": f"""
        select l.l_orderkey as order_key, l.l_linenumber as line_no,
          cast(l.l_shipdate as date) as date,
          s.s_name as company,
          case l.l_suppkey % 3 when 0 then 'manufacturer' when 1 then 'dealer'
            else 'transparence' end as company_type,
          s.s_name || '|' || cast(l.l_partkey as string) as company_item_code,
          cast(l.l_partkey as string) as item_code,
          case when l.l_orderkey % 11 = 5 then p.p_name || ' (new)' else upper(p.p_name) end
            as item_description,
          c.c_name as customer, lower(c.c_name) as customer_raw,
          case when c.c_custkey % 4 = 0 then '  ' || upper({country('n')})
            else {country('n')} || ' ' end as destination_country_raw,
          {country('n')} as destination_country,
          case c.c_mktsegment when 'BUILDING' then 'Wholesale' when 'FURNITURE' then 'Wholesale'
            when 'AUTOMOBILE' then 'Fabbricante' when 'HOUSEHOLD' then 'Retail'
            else null end as channel,
          c.c_mktsegment as channel_raw,
          case when o.o_orderpriority = '1-URGENT' then 'quarterly' else 'semi-annual' end
            as time_frames,
          case when l.l_linenumber = 7 and l.l_orderkey % 4 = 0 then 2.0e0 else null end as volumes,
          case when l.l_linenumber = 7 then null when l.l_linenumber = 6 then 0.0e0
            when l.l_returnflag = 'R' then -l.l_quantity else l.l_quantity end as quantity,
          case when l.l_orderkey % 10 = 0 then null when l.l_orderkey % 10 = 1 then 0.0e0
            when l.l_orderkey % 10 = 2 or l.l_returnflag = 'R' then -l.l_extendedprice
            else l.l_extendedprice end as sales,
          {currency('sc', yyyymm('l.l_shipdate'))} as billing_currency,
          {currency('nc', yyyymm('l.l_shipdate'))} as local_currency,
          case l.l_returnflag when 'N' then 20240101000000000 when 'A' then 20240201000000000
            else 20240301000000000 end as submission_id,
          case when p.p_size % 10 = 0 then 'SP_' || cast(p.p_size as string)
            when p.p_size % 10 = 1 then 'A_99' when p.p_size % 10 = 2 then '14_2'
            else p.p_type || '_' || p.p_brand end as sellout_dm,
          'batch-' || cast(l.l_orderkey % 5 as string) as batch_id,
          'file-' || cast(l.l_suppkey as string) || '.xlsx' as file_name
        from {{lineitem}} l join {{orders}} o on l.l_orderkey = o.o_orderkey
        join {{customer}} c on o.o_custkey = c.c_custkey
        join {{nation}} n on c.c_nationkey = n.n_nationkey
        join {{supplier}} s on l.l_suppkey = s.s_suppkey
        join {{part}} p on l.l_partkey = p.p_partkey
        join {{nation_currency}} sc on sc.k = s.s_nationkey
        join {{nation_currency}} nc on nc.k = n.n_nationkey""",
    # Facts with their value in local currency; some rows found no rate.
    "valued_facts": """
        select f.*, case when f.order_key % 17 = 3 then null else f.sales * 1.23457219e0 end
            as sales_local_currency,
          case when f.order_key % 17 = 3 then null else f.sales * 1.23457219e0 end
            as fx_transaction_lc
        from {facts} f""",
    # File registry: one file per order.
    "registry": """
        select 'batch-' || lpad(cast(o_orderkey % 97 as string), 3, '0') as batch_id,
          o_orderdate as ingestion_time,
          'company_' || lpad(cast(o_custkey % 40 as string), 3, '0') as company_name,
          'company_' || lpad(cast(o_custkey % 40 as string), 3, '0') || '_italy_'
            || case o_orderkey % 3 when 0 then 'distributor_' when 1 then 'directsales_' else '' end
            || cast(year(o_orderdate) as string) || '_'
            || case when o_orderkey % 2 = 0
                 then 'q' || cast(cast(floor((month(o_orderdate) + 2) / 3) as int) as string)
               when o_orderkey % 7 = 0
                 then 'h' || case when month(o_orderdate) <= 6 then '1' else '2' end
               else lpad(cast(month(o_orderdate) as string), 2, '0') end
            || '.xlsx' as file_name,
          o_orderkey as file_key
        from {orders}""",
    # Company names with alias-group members, mixed case and spaces.
    "company_names": """
        select s_suppkey as id,
          case s_suppkey % 10 when 0 then ' company_001' when 1 then 'Company_045 '
            when 2 then 'company_070' when 3 then 'COMPANY_GROUP_002' else lower(s_name) end
            as company_name,
          s_suppkey % 3 = 0 as manufacturer, s_suppkey % 2 = 0 as dealer,
          s_acctbal > 0 as active, '2024-01-15' as data_creation
        from {supplier}""",
    "countries": f"""
        select n_nationkey as id, ' ' || {country('n')} as country_name from {{nation}} n""",
    # Spellings the dictionary knows: every fifth nation is left to the aliases.
    "country_dictionary": f"""
        select n_nationkey as id_country, upper({country('n')}) as country_raw
        from {{nation}} n where n_nationkey % 5 <> 4
        union all
        select n_nationkey as id_country, ' ' || lower({country('n')}) as country_raw
        from {{nation}} n where n_nationkey % 5 = 0""",
    # Nation 4 has an alias whose country is not listed, nation 24 no alias at all.
    "country_aliases": f"""
        select {country('n')} as alias,
          case when n_nationkey = 4 then 'Principality' else {country('n')} end as country_iso_name
        from {{nation}} n where n_nationkey % 5 = 4 and n_nationkey <> 24""",
    "nation_months": f"""
        select distinct n.n_nationkey as k, {yyyymm('o.o_orderdate')} as ym
        from {{orders}} o join {{customer}} c on o.o_custkey = c.c_custkey
        join {{nation}} n on c.c_nationkey = n.n_nationkey""",
    "currencies": """
        select min(id) as id, code as currency_code from (
          select k as id, code_before as code from {nation_currency}
          union all select 100 + k as id, code_after as code from {nation_currency}) c
        group by code""",
    "times": f"""
        select distinct {yyyymm('o_orderdate')} as id, year(o_orderdate) as year,
          case when month(o_orderdate) <= 6 then 1 else 2 end as semester,
          cast(floor((month(o_orderdate) + 2) / 3) as int) as quarter,
          month(o_orderdate) as month, 4 as id_time_frame
        from {{orders}}
        union all
        select distinct year(o_orderdate) as id, year(o_orderdate) as year, cast(null as int),
          cast(null as int), cast(null as int), 1 as id_time_frame
        from {{orders}}""",
    "countries_currencies": f"""
        select m.k as id_country, c.id as id_currency, m.ym as id_time
        from {{nation_months}} m join {{nation_currency}} nc on nc.k = m.k
        join {{currencies}} c on c.currency_code = {currency('nc', 'm.ym')}""",
    # One quote per order: local currency against EUR or USD, with unreadable ones.
    "quotes": f"""
        select o.o_orderkey as id, {yyyymm('o.o_orderdate')} as id_time,
          b.id as id_currency_base, t.id as id_currency_target,
          case when o.o_orderkey % 50 = 7 then 'abc' when o.o_orderkey % 50 = 8 then '0'
            when o.o_orderkey % 50 = 9 then '-1,5' when o.o_orderkey % 50 = 10 then ' '
            else replace(cast(cast(1 + n.n_nationkey + (o.o_orderkey % 97) * 0.01
              as decimal(18, 4)) as string), '.', ',') end as exchange_rate
        from {{orders}} o join {{customer}} c on o.o_custkey = c.c_custkey
        join {{nation}} n on c.c_nationkey = n.n_nationkey
        join {{nation_currency}} nc on nc.k = n.n_nationkey
        join {{currencies}} b on b.currency_code = {currency('nc', yyyymm('o.o_orderdate'))}
        join {{currencies}} t on t.currency_code = case when o.o_custkey % 2 = 0 then 'EUR' else 'USD' end""",
}


def expand(name: str, seen: dict[str, str] | None = None) -> dict[str, str]:
    """The relation and everything it needs, in dependency order, for a WITH clause."""
    seen = {} if seen is None else seen
    if name in TABLES or name in seen:
        return seen
    text = VIEWS[name]
    for dependency in re.findall(r"\{(\w+)\}", text):
        expand(dependency, seen)
    # Spark quotes names with back-ticks, DuckDB with double quotes.
    seen[name] = re.sub(r"\{(\w+)\}", r"\1", text).replace("`", '"')
    return seen


def with_clause(text: str) -> str:
    """DuckDB statement for ``text`` with the relations it names as common table expressions."""
    seen: dict[str, str] = {}
    for dependency in re.findall(r"\{(\w+)\}", text):
        expand(dependency, seen)
    body = re.sub(r"\{(\w+)\}", r"\1", text).strip()
    if not seen:
        return body
    parts = ",\n".join(f"{name} as ({sql})" for name, sql in seen.items())
    if body.lower().startswith("with "):
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"


def frame(spark: SparkSession, folder: str, name: str, built: dict[str, DataFrame]) -> DataFrame:
    """A table or relation as a DataFrame; ``built`` keeps those already defined."""
    if name not in built:
        if name in TABLES:
            built[name] = spark.read.parquet(f"{folder}/{name}.parquet")
        else:
            text = VIEWS[name]
            needs = set(re.findall(r"\{(\w+)\}", text))
            built[name] = spark.sql(text, **{n: frame(spark, folder, n, built) for n in needs})
    return built[name]
