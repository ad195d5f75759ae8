"""The queries as SQL, for a comparison with an independent engine."""

from __future__ import annotations

_CLEAN = """INVOICENO, STOCKCODE, DESCRIPTION, QUANTITY, UNITPRICE, COUNTRY, FECHA_INVOICE,
    HORA_MINUTO_VARCHAR, FECHA_DE_CARGA, HORA_DE_CARGA"""

_BRONZE = "INVOICENO, STOCKCODE, DESCRIPTION, QUANTITY, INVOICEDATE, UNITPRICE, CUSTOMERID, COUNTRY"

_STORED_QUANTITY = "cast(QUANTITY as decimal(38,0)) as QUANTITY"

_PRELUDE = f"""
with invoice as (
  select
    case when l_returnflag = 'R' then 'C' else '' end || cast(l_orderkey as varchar) as INVOICENO,
    case when l_partkey % 211 <> 0 then cast(l_partkey as varchar) end as STOCKCODE,
    case when p_partkey % 50 <> 0 then p_name end as DESCRIPTION,
    cast(case when (l_returnflag = 'R' and l_linenumber <> 1) or (l_returnflag = 'A' and l_linenumber = 7)
      then -l_quantity else l_quantity end as integer) as QUANTITY,
    case when o_orderkey % 101 = 0 then 'not a date' else
      strftime(o_orderdate + to_hours(cast(o_orderkey % 24 as integer))
        + to_minutes(cast(o_orderkey % 60 as integer)), '%-m/%-d/%Y %-H:%M') end as INVOICEDATE,
    l_extendedprice / l_quantity as UNITPRICE,
    o_custkey as CUSTOMERID,
    case when c_custkey % 97 <> 0 then n_name end as COUNTRY,
    l_linestatus as LINESTATUS,
    cast(l_shipdate as date) as SHIPDATE,
    l_discount as DISCOUNT,
    l_tax as TAX,
    l_linenumber as LINENUMBER
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
),
dated as (
  select *,
    cast(try_strptime(INVOICEDATE, '%m/%d/%Y %H:%M') as date) as FECHA_INVOICE,
    strftime(try_strptime(INVOICEDATE, '%m/%d/%Y %H:%M'), '%H:%M') as HORA_MINUTO_VARCHAR
  from invoice
),
typed as (
  select INVOICENO, STOCKCODE, coalesce(DESCRIPTION, 'SIN_DESCRIPCION') as DESCRIPTION,
    try_cast(cast(QUANTITY as varchar) as decimal(10,2)) as QUANTITY,
    try_cast(cast(UNITPRICE as varchar) as decimal(10,2)) as UNITPRICE,
    COUNTRY, FECHA_INVOICE, HORA_MINUTO_VARCHAR,
    date '2024-01-31' as FECHA_DE_CARGA, '12:34' as HORA_DE_CARGA
  from dated
  where INVOICENO is not null and STOCKCODE is not null and QUANTITY is not null
    and UNITPRICE is not null and COUNTRY is not null
),
silver as (
  select * from typed where not (QUANTITY < 0 and starts_with(INVOICENO, 'C'))
),
cancelled as (
  select * from typed where QUANTITY < 0 and starts_with(INVOICENO, 'C')
),
line as (
  select *, INVOICENO || '_' || STOCKCODE as K from silver
),
stored_line as (
  select * from line where FECHA_INVOICE < date '1998-01-01'
),
date_dim as (
  select row_number() over (order by K, FECHA_INVOICE, HORA_MINUTO_VARCHAR) - 1 as INVOICE_DATE_ID,
    K as FK_INVOICENO_STOCKCODE, FECHA_INVOICE, HORA_MINUTO_VARCHAR as HORA_MINUTO,
    FECHA_DE_CARGA, HORA_DE_CARGA
  from line where FECHA_INVOICE is not null
),
country_dim as (
  select row_number() over (order by K, COUNTRY) - 1 as COUNTRY_ID,
    K as FK_INVOICENO_STOCKCODE, COUNTRY, FECHA_DE_CARGA, HORA_DE_CARGA
  from line
),
product_dim as (
  select row_number() over (order by K, STOCKCODE) - 1 as PRODUCT_ID,
    K as FK_INVOICENO_STOCKCODE, STOCKCODE, FECHA_DE_CARGA, HORA_DE_CARGA
  from line
),
fact_line as (
  select row_number() over (order by K, QUANTITY, UNITPRICE) - 1 as INVOICE_FACT_ID, * from line
)
"""


def _after(sql: str) -> str:
    return _PRELUDE + sql


def _unseen(columns: str, source: str, stored: str) -> str:
    return _after(
        f"select {columns} from {source} where not exists "
        f"(select 1 from {stored} as s where s.INVOICENO = {source}.INVOICENO)"
    )


def _unseen_dim(id_col: str, columns: str, order: str, valid: str = "true") -> str:
    return _after(
        f"""select (select count(*) from stored_line) + row_number() over (order by K, {order}) - 1 as {id_col},
          K as FK_INVOICENO_STOCKCODE, {columns}, FECHA_DE_CARGA, HORA_DE_CARGA
        from line where {valid} and K not in (select K from stored_line)"""
    )


def _star(facts: str, dates: str, countries: str, products: str, on: str) -> str:
    return f"""
      select f.INVOICE_FACT_ID, f.K as PK_INVOICENO_STOCKCODE, p.PRODUCT_ID, c.COUNTRY_ID, d.INVOICE_DATE_ID,
        cast(f.QUANTITY as decimal(38,0)) as QUANTITY, f.UNITPRICE, f.FECHA_DE_CARGA, f.HORA_DE_CARGA
      from {facts} as f
      join {dates} as d on f.K = d.FK_INVOICENO_STOCKCODE {on.format('d.FECHA_INVOICE = f.FECHA_INVOICE and d.HORA_MINUTO = f.HORA_MINUTO_VARCHAR')}
      join {countries} as c on f.K = c.FK_INVOICENO_STOCKCODE {on.format('c.COUNTRY = f.COUNTRY')}
      join {products} as p on f.K = p.FK_INVOICENO_STOCKCODE {on.format('p.STOCKCODE = f.STOCKCODE')}
    """


def _key_grain(id_col: str, dim: str, attributes: str) -> str:
    return f"""(select row_number() over (order by FK_INVOICENO_STOCKCODE, {attributes}) - 1 as {id_col},
        FK_INVOICENO_STOCKCODE, {attributes}
      from (select distinct FK_INVOICENO_STOCKCODE, {attributes} from {dim}))"""


def oracle_sql() -> dict[str, str]:
    stored_bronze = "(select * from dated where FECHA_INVOICE < date '1998-01-01')"
    fact_columns = """K as PK_INVOICENO_STOCKCODE, QUANTITY, UNITPRICE, FECHA_INVOICE,
      HORA_MINUTO_VARCHAR as HORA_MINUTO, COUNTRY, STOCKCODE, FECHA_DE_CARGA, HORA_DE_CARGA"""
    date_rows = """K as FK_INVOICENO_STOCKCODE, FECHA_INVOICE, HORA_MINUTO_VARCHAR as HORA_MINUTO,
      FECHA_DE_CARGA, HORA_DE_CARGA"""
    stored_columns = _CLEAN.replace("QUANTITY", _STORED_QUANTITY)
    changes = [
        ("LINESTATUS", "string", "STRING"),
        ("SHIPDATE", "date", "STRING"),
        ("DISCOUNT", "float", "FLOAT"),
        ("TAX", "double", "STRING"),
        ("LINENUMBER", "int", "NUMBER"),
    ]
    bronze_columns = [c.strip() for c in _BRONZE.split(",")]
    return {
        "bronze": _after(f"select {_BRONZE} from invoice"),
        "bronze_project": _after(f"select {_BRONZE} from invoice"),
        "silver_dates": _after("select INVOICENO, STOCKCODE, INVOICEDATE, FECHA_INVOICE, HORA_MINUTO_VARCHAR from dated"),
        "audit_stamp": _after(
            "select INVOICENO, STOCKCODE, date '2024-01-31' as FECHA_DE_CARGA, '12:34' as HORA_DE_CARGA from invoice"
        ),
        "silver_required": _after(
            f"""select {_BRONZE} from invoice where INVOICENO is not null and STOCKCODE is not null
            and QUANTITY is not null and UNITPRICE is not null and COUNTRY is not null"""
        ),
        "silver_fill": _after(
            "select "
            + _BRONZE.replace("DESCRIPTION", "coalesce(DESCRIPTION, 'SIN_DESCRIPCION') as DESCRIPTION")
            + " from invoice"
        ),
        "silver_cast": _after(
            """select INVOICENO, STOCKCODE, try_cast(cast(QUANTITY as varchar) as decimal(10,2)) as QUANTITY,
            try_cast(cast(UNITPRICE as varchar) as decimal(10,2)) as UNITPRICE from invoice"""
        ),
        "silver_typed": _after(f"select {_CLEAN} from typed"),
        "silver_route": _after(
            f"""select {_CLEAN}, case when QUANTITY < 0 and starts_with(INVOICENO, 'C') then 'INVOICE_CANCELLED_SILVER'
            when not (QUANTITY < 0 and starts_with(INVOICENO, 'C')) then 'INVOICE_SILVER' end as ROUTE from typed"""
        ),
        "silver_invoices": _after(f"select {_CLEAN} from silver"),
        "silver_cancelled": _after(f"select {_CLEAN} from cancelled"),
        "incr_bronze": _unseen(_BRONZE, "invoice", stored_bronze),
        "incr_silver": _unseen(_CLEAN, "silver", "stored_line"),
        "incr_cancelled": _unseen(
            _CLEAN, "cancelled", "(select * from cancelled where FECHA_INVOICE < date '1998-01-01')"
        ),
        "gold_invoice": _after(f"select {stored_columns} from silver"),
        "incr_gold": _unseen(stored_columns, "silver", "stored_line"),
        "gold_cancelled": _after(f"select {stored_columns} from cancelled"),
        "natural_key": _after(
            "select INVOICENO, STOCKCODE, INVOICENO || '_' || STOCKCODE as INVOICENO_STOCKCODE from invoice"
        ),
        "surrogate_ids": _after(
            """select (select count(*) from stored_line) - 1 + row_number() over
              (order by K, QUANTITY, UNITPRICE, FECHA_INVOICE nulls first) as INVOICE_FACT_ID,
              K as PK_INVOICENO_STOCKCODE, QUANTITY, UNITPRICE, FECHA_INVOICE
            from line where K not in (select K from stored_line)"""
        ),
        "dim_date": _after("select * from date_dim"),
        "dim_country": _after("select * from country_dim"),
        "dim_product": _after("select * from product_dim"),
        "incr_date_dim": _unseen_dim(
            "INVOICE_DATE_ID",
            "FECHA_INVOICE, HORA_MINUTO_VARCHAR as HORA_MINUTO",
            "FECHA_INVOICE, HORA_MINUTO_VARCHAR",
            "FECHA_INVOICE is not null",
        ),
        "incr_country_dim": _unseen_dim("COUNTRY_ID", "COUNTRY", "COUNTRY"),
        "incr_product_dim": _unseen_dim("PRODUCT_ID", "STOCKCODE", "STOCKCODE"),
        "gold_fact": _after(_star("fact_line", "date_dim", "country_dim", "product_dim", "")),
        "gold_fact_per_line": _after(
            _star(
                "fact_line",
                _key_grain("INVOICE_DATE_ID", "date_dim", "FECHA_INVOICE, HORA_MINUTO"),
                _key_grain("COUNTRY_ID", "country_dim", "COUNTRY"),
                _key_grain("PRODUCT_ID", "product_dim", "STOCKCODE"),
                "and {}",
            )
        ),
        "incr_fact": _after(
            _star(
                """(select (select count(*) from stored_line) - 1
                    + row_number() over (order by K, QUANTITY, UNITPRICE) as INVOICE_FACT_ID, *
                  from line where K not in (select K from stored_line))""",
                "date_dim",
                "country_dim",
                "product_dim",
                "",
            )
        ),
        "distinct_rows": _after(f"select distinct {fact_columns} from line"),
        "reject_not_null": _after(
            f"select {date_rows}, 'FECHA_INVOICE,HORA_MINUTO' as REJECT_REASON from line where FECHA_INVOICE is null"
        ),
        "check_pk": _after(
            "select K as FK_INVOICENO_STOCKCODE, count(*) as REPEATS from line group by K having count(*) > 1"
        ),
        "check_fk": _after(
            """select K as PK_INVOICENO_STOCKCODE, QUANTITY, UNITPRICE from line
            where K not in (select K from line where FECHA_INVOICE is not null)"""
        ),
        "load_profile": _after(
            " union all ".join(
                f"select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count from invoice"
                for c in bronze_columns
            )
        ),
        "bronze_csv_roundtrip": _after(f"select {_BRONZE} from invoice"),
        "table_scan": _after(f"select {stored_columns} from silver"),
        "connector_load": _after(f"select {stored_columns} from silver"),
        "append_idempotent": _after(f"select {_BRONZE} from invoice"),
        "bronze_first_load": _after(f"select {_BRONZE}, LINENUMBER from invoice"),
        "schema_evolve_append": _after(
            f"""select {_BRONZE}, LINESTATUS, SHIPDATE, TAX, LINENUMBER from dated
              where INVOICENO not in (select INVOICENO from {stored_bronze})
            union all
            select {_BRONZE}, null, null, null, null from dated
              where INVOICENO in (select INVOICENO from {stored_bronze})"""
        ),
        "bronze_csv_by_name": _after(
            f"""select {_BRONZE}, cast(LINENUMBER as varchar) as LINENUMBER from dated
              where INVOICENO not in (select INVOICENO from {stored_bronze})
            union all
            select {_BRONZE}, null from dated where INVOICENO in (select INVOICENO from {stored_bronze})"""
        ),
        "stream_csv_by_name": _after(
            f"""select {_BRONZE}, cast(LINENUMBER as varchar) as LINENUMBER from dated
              where INVOICENO not in (select INVOICENO from {stored_bronze})
            union all
            select {_BRONZE}, null from dated where INVOICENO in (select INVOICENO from {stored_bronze})"""
        ),
        **dict.fromkeys(
            ("bronze_csv_headers", "stream_csv_headers"),
            _after(
                f"""select * exclude (THIRD) replace (case when THIRD = 2 then null else COUNTRY end as COUNTRY,
                  case when THIRD = 1 then LINENUMBER end as LINENUMBER,
                  case when THIRD = 2 then LINESTATUS end as LINESTATUS)
                from (select {_BRONZE}, cast(LINENUMBER as varchar) as LINENUMBER, LINESTATUS,
                  cast(replace(INVOICENO, 'C', '') as bigint) % 3 as THIRD from dated)"""
            ),
        ),
        "distinct_products": _after("select distinct STOCKCODE, COUNTRY from silver"),
        "emptiness_probe": _after(
            """select 'INVOICE' as table_name, not exists (select 1 from invoice) as is_empty
            union all select 'INVOICE_GOLD', true union all select 'COUNTRY_DIM', true"""
        ),
        "schema_diff": _after(
            " union all ".join(
                f"""select '{c}' as column_name, '{spark}' as spark_type, '{warehouse}' as warehouse_type,
                count({c}) as filled from invoice"""
                for c, spark, warehouse in changes
            )
        ),
        "layered_run": _after(
            """select K as PK_INVOICENO_STOCKCODE, FECHA_INVOICE, HORA_MINUTO_VARCHAR as HORA_MINUTO, COUNTRY, STOCKCODE,
              cast(QUANTITY as decimal(38,0)) as QUANTITY, UNITPRICE, FECHA_DE_CARGA
            from line where FECHA_INVOICE is not null"""
        ),
        "bronze_types_kept": _after(
            f"""select INVOICENO, STOCKCODE, coalesce(DESCRIPTION, 'SIN_DESCRIPCION') as DESCRIPTION,
              try_cast(case when INVOICENO in (select INVOICENO from {stored_bronze}) then cast(QUANTITY as varchar)
                when CUSTOMERID % 3 = 0 then cast(QUANTITY + 0.5 as varchar) else cast(QUANTITY as varchar) end
                as decimal(10,2)) as QUANTITY,
              case when INVOICENO not in (select INVOICENO from {stored_bronze}) and CUSTOMERID % 7 = 0 then null
                else try_cast(cast(UNITPRICE as varchar) as decimal(10,2)) end as UNITPRICE,
              COUNTRY, FECHA_INVOICE, HORA_MINUTO_VARCHAR, date '2024-01-31' as FECHA_DE_CARGA, '12:34' as HORA_DE_CARGA
            from dated where INVOICENO is not null and STOCKCODE is not null and QUANTITY is not null
              and UNITPRICE is not null and COUNTRY is not null"""
        ),
        "fact_by_map": _after(
            """select K as PK_INVOICENO_STOCKCODE, FECHA_INVOICE, HORA_MINUTO_VARCHAR as HORA_MINUTO, COUNTRY, STOCKCODE,
              cast(QUANTITY as decimal(38,0)) as QUANTITY, UNITPRICE, FECHA_DE_CARGA
            from line where FECHA_INVOICE is not null"""
        ),
        "dimension_map": _after(
            """select distinct K as FK_INVOICENO_STOCKCODE, FECHA_INVOICE, HORA_MINUTO_VARCHAR as HORA_MINUTO, COUNTRY,
              STOCKCODE, case when FECHA_INVOICE is not null then true end as INVOICE_DATE_ID_FITS,
              true as COUNTRY_ID_FITS, true as PRODUCT_ID_FITS from line"""
        ),
        "ids_by_load": _after(
            " union all ".join(
                f"""select '{table}' as TABLE_NAME, case when K in (select K from stored_line) then 0 else 1 end
                  as LOAD_NUMBER, count(*) as ROW_COUNT, count(*) as ID_COUNT from ({rows}) group by all"""
                for table, rows in (
                    ("INVOICE_DATE_DIM", "select distinct K, FECHA_INVOICE, HORA_MINUTO_VARCHAR from line where FECHA_INVOICE is not null"),
                    ("COUNTRY_DIM", "select distinct K, COUNTRY from line"),
                    ("PRODUCT_DIM", "select distinct K, STOCKCODE from line"),
                    ("INVOICE_FACT_TABLE", "select K from line where FECHA_INVOICE is not null"),
                )
            )
        ),
        "check_declared": _after(
            """, late as (select * from line where FECHA_INVOICE is not null and K not in (select K from stored_line))
            select 'INVOICE_FACT_TABLE' as TABLE_NAME, 'late' as LOAD, 'PRIMARY KEY' as CONSTRAINT_TYPE,
              'INVOICE_FACT_ID' as COLUMN_NAME, '-7' as KEY_VALUE, REASON, count(*) as ROW_COUNT
            from late, (values ('REPEATED', 2), ('NOT LEASED', 1)) as r(REASON, least_rows)
            where QUANTITY = 7 group by REASON, least_rows having count(*) >= least_rows
            union all
            select 'INVOICE_FACT_TABLE', 'late', 'FOREIGN KEY', 'PRODUCT_ID', cast(-cast(QUANTITY as bigint) as varchar),
              'NO PARENT', count(*) from late where QUANTITY between 10 and 12 group by QUANTITY
            union all
            select 'COUNTRY_DIM', 'late', 'PRIMARY KEY', 'COUNTRY_ID', null, 'NOT LEASED', count(*)
            from (select distinct K, COUNTRY from line where COUNTRY = 'FRANCE' and K not in (select K from stored_line))
            having count(*) > 0"""
        ),
        "stream_resumed": _after(
            " union all ".join(
                f"select '{table}' as TABLE_NAME, count(*) as ROW_COUNT, count(distinct {key}) as KEY_COUNT from ({rows})"
                for table, key, rows in (
                    ("INVOICE", "INVOICENO", "from invoice"),
                    ("INVOICE_SILVER", "INVOICENO", "from silver"),
                    ("INVOICE_CANCELLED_SILVER", "INVOICENO", "from cancelled"),
                    ("INVOICE_GOLD", "INVOICENO", "from silver"),
                    ("INVOICE_CANCELLED_GOLD", "INVOICENO", "from cancelled"),
                    ("INVOICE_DATE_DIM", "K", "select distinct K, FECHA_INVOICE, HORA_MINUTO_VARCHAR from line where FECHA_INVOICE is not null"),
                    ("COUNTRY_DIM", "K", "select distinct K, COUNTRY from line"),
                    ("PRODUCT_DIM", "K", "select distinct K, STOCKCODE from line"),
                    ("DIMENSION_MAP", "K", "select distinct K, FECHA_INVOICE, HORA_MINUTO_VARCHAR, COUNTRY, STOCKCODE from line"),
                    ("INVOICE_FACT_TABLE", "K", "from line where FECHA_INVOICE is not null"),
                    ("RESOLVED", "K", "from line where FECHA_INVOICE is not null"),
                )
            )
        ),
        "stream_incremental": _after(f"select {stored_columns} from silver"),
    }
