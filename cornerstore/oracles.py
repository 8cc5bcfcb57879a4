"""The queries as ANSI SQL over the same tables, written independently of the Spark code."""

from __future__ import annotations

RAW = """raw as (
  select l_orderkey * 10 + l_linenumber as order_id, c_name as customer_name, p_name as product,
    p_type as category,
    cast(case when l_returnflag = 'R' and l_linenumber = 7 then -p_retailprice else p_retailprice end
      as decimal(12,2)) as price,
    cast(case when l_linenumber = 6 and l_returnflag = 'N' then 0 else l_quantity end as int) as quantity,
    case when n_nationkey = 3 then '  ' else concat(' ', n_name, ' ') end as city,
    cast(o_orderdate as date) as order_date, l_shipdate as updated_at,
    concat('b', lpad(cast(l_partkey as varchar), 8, '0')) as batch_id
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey)"""

CLEAN = RAW + """, clean as (
  select order_id, trim(customer_name) as customer_name, trim(product) as product,
    trim(category) as category, price, quantity, trim(city) as city, order_date, updated_at, batch_id,
    cast(order_date as timestamp) as ingested_at,
    cast(price * quantity as decimal(18,2)) as total_amount
  from raw)"""

VALID = CLEAN + """, valid as (
  select * from clean where price >= 0 and quantity > 0 and city <> '')"""

SILVER = VALID + """, silver as (
  select * from valid
  qualify row_number() over (partition by order_id
    order by updated_at desc, ingested_at desc, batch_id desc) = 1)"""

# In the pipeline all rows of a run share ingest time and batch id.
RUN_ORDER = "order by updated_at desc, total_amount desc, product desc, category desc"
RUN_SILVER = VALID + f""", silver as (
  select * from valid qualify row_number() over (partition by order_id {RUN_ORDER}) = 1)"""

LAKE = CLEAN + """, lake as (
  select order_id, customer_name, product, category, price, quantity, city, order_date, updated_at, total_amount
  from clean where price >= 0 and quantity > 0)"""

CUT = "updated_at < timestamp '2000-01-01 00:00:00'"
EVENT_CUT = "updated_at < timestamp '2024-01-15 00:00:00'"


def _lake_latest(name: str, where: str = "true") -> str:
    return f""", {name} as (
  select * from lake where {where}
  qualify row_number() over (partition by order_id
    order by updated_at desc, price desc, product desc, quantity desc) = 1)"""


AVERAGE = (
    "cast(((((2 * cast(sum({x}) * 100 as hugeint) * 10000 + count({x})) // (2 * count({x}))) + 5000) // 10000)"
    " * cast(0.01 as decimal(3,2)) as decimal({p},2))"
)


def _kpis(customers: str = "count(distinct customer_name)", orders: str = "count(*)") -> str:
    average = AVERAGE.format(x="total_amount", p=20)
    return f"""cast(sum(total_amount) as decimal(20,2)) as total_revenue, {orders} as order_count,
  cast(sum(quantity) as bigint) as units_sold, {average} as average_order_value,
  {customers} as distinct_customers, timestamp '2024-06-01 00:00:00' as last_refreshed_at"""


CDC = """cdc as (
  select concat('O', cast(user_id as varchar)) as order_id,
    case when k % 10 = 9 then null else concat('C', cast(user_id % 20 as varchar)) end as customer_id,
    concat('Customer ', cast(user_id % 20 as varchar)) as customer_name,
    concat('C', cast(user_id % 20 as varchar), '@Shop', cast(event_id % 3 as varchar), '.example')
      as customer_email,
    concat('P', cast(user_id % 7 as varchar)) as product_id,
    concat('Product ', cast(user_id % 7 as varchar)) as product_name,
    event_type as category, concat('S', cast(user_id % 5 as varchar)) as store_id,
    ts as order_timestamp, ts as updated_at, k as quantity,
    case when event_id % 50 = 7 then -value else value end as unit_price,
    case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' when 'view' then 'REFRESH'
      else 'UPDATE' end as operation
  from (select *, cast(regexp_extract(props, '"k": *([0-9]+)', 1) as int) as k from events))"""

JUDGED = CDC + """, judged as (
  select order_id, customer_id, customer_name, customer_email, product_id, product_name, category, store_id,
    order_timestamp, updated_at, quantity, cast(unit_price as decimal(12,2)) as unit_price, operation,
    case when customer_id is null or quantity is null or unit_price is null then 'missing_required_field'
      when quantity <= 0 then 'non_positive_quantity'
      when unit_price < 0 then 'negative_unit_price' end as quality_reason,
    cast(quantity * cast(unit_price as decimal(12,2)) as decimal(14,2)) as total_amount
  from cdc)"""

GOOD = JUDGED + ", good as (select * exclude (quality_reason) from judged where quality_reason is null)"
CHANGES = GOOD + ", changes as (select * from good where operation in ('INSERT', 'UPDATE', 'DELETE'))"
HISTORY = CHANGES + """, history as (
  select * exclude (operation) from (
    select *, updated_at as "__START_AT",
      lead(updated_at) over (partition by order_id order by updated_at) as "__END_AT"
    from changes) where operation <> 'DELETE')"""

STAGED_COLUMNS = """order_id, customer_id, customer_name, lower(customer_email) as customer_email, product_id,
  product_name, category, store_id, order_timestamp, cast(order_timestamp as date) as order_date, quantity,
  unit_price, total_amount, updated_at"""


def _staged(name: str, where: str = "true") -> str:
    return f""", {name} as (
  select {STAGED_COLUMNS} from (
    select *, row_number() over (partition by order_id order by updated_at desc) as rn
    from changes where {where}) where rn = 1 and operation <> 'DELETE')"""


FACT = "order_id, customer_id, product_id, store_id, order_date, order_timestamp, quantity, unit_price, total_amount, updated_at"

_FACT_ROWS = f""", fresh as (
  select {FACT} from late
  where updated_at > (select coalesce(max(updated_at), timestamp '1900-01-01') from early)), fct as (
  select {FACT} from early where order_id not in (select order_id from fresh)
  union all select {FACT} from fresh)"""

FCT = CHANGES + _staged("early", EVENT_CUT) + _staged("late") + _FACT_ROWS
# All orders of one customer and of one product are deleted after the last event.
FCT_AFTER_DELETES = (
    CHANGES + _staged("early", EVENT_CUT) + _staged("late", "customer_id <> 'C3' and product_id <> 'P3'") + _FACT_ROWS
)

DIM_CUSTOMER = """select customer_id, arg_max(customer_name, updated_at) as customer_name,
  arg_max(customer_email, updated_at) as customer_email, min(order_timestamp) as first_order_at,
  max(order_timestamp) as latest_order_at from {rows} group by customer_id"""
DIM_PRODUCT = """select product_id, arg_max(product_name, updated_at) as product_name,
  arg_max(category, updated_at) as category, max(updated_at) as last_updated_at from {rows} group by product_id"""


def _reasons(rules: dict[str, str]) -> str:
    parts = ", ".join(f"case when {failed} then '{name}' end" for name, failed in rules.items())
    return f"concat_ws(',', {parts})"


MEDALLION_REASONS = _reasons(
    {
        "customer_name_is_blank": "customer_name = ''",
        "product_is_blank": "product = ''",
        "category_is_blank": "category = ''",
        "city_is_blank": "city = ''",
        "price_is_null": "price is null",
        "price_is_negative": "price < 0",
        "quantity_is_null": "quantity is null",
        "quantity_is_not_positive": "quantity <= 0",
        "updated_at_is_null": "updated_at is null",
    }
)
LAKE_REASONS = _reasons(
    {
        "blank_customer": "customer_name = ''",
        "blank_product": "product = ''",
        "invalid_price": "price is null or price < 0",
        "invalid_quantity": "quantity is null or quantity <= 0",
        "missing_order_date": "order_date is null",
    }
)

FINGERPRINT = """sha256(concat('{"order_id":', cast(order_id as varchar), ',"customer_name":"', customer_name,
  '","product":"', product, '","category":"', category, '","price":', cast(price as varchar),
  ',"quantity":', cast(quantity as varchar), ',"city":"', city,
  '","source_updated_at":"', strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%g'),
  '","source_ingested_at":"', strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%g'),
  '","source_ingestion_date":"', strftime(order_date, '%Y-%m-%d'),
  '","source_batch_id":"', batch_id, '"}'))"""

SILVER_OUT = """order_id, customer_name, product, category, price, quantity, city, total_amount,
  updated_at as source_updated_at, batch_id as source_batch_id"""

PRODUCTS = SILVER + f", products as (select product, category, {_kpis()} from silver group by product, category)"
RANKED = PRODUCTS + """, ranked as (
  select cast(dense_rank() over (order by total_revenue desc, product asc) as int) as sales_rank, product, category,
    total_revenue, order_count, units_sold, average_order_value, last_refreshed_at from products)"""


def _dimension(key: str, columns: str) -> str:
    return "with " + LAKE + f""", early as (
  select *, cast(row_number() over (order by {columns}) as bigint) as {key}
  from (select distinct {columns} from lake where {CUT})), fresh as (
  select distinct {columns} from lake except select {columns} from early)
select {key}, {columns} from early
union all
select cast((select max({key}) from early) + row_number() over (order by {columns}) as bigint) as {key},
  {columns} from fresh"""


STAR_FACT = "with " + LAKE + _lake_latest("sales") + """, c as (
  select customer_name, row_number() over (order by customer_name) as customer_id
  from (select distinct customer_name from sales)), p as (
  select product, category, row_number() over (order by product, category) as product_id
  from (select distinct product, category from sales)), t as (
  select city, row_number() over (order by city) as city_id from (select distinct city from sales))
select order_id, customer_id, product_id, city_id, price, quantity
from sales join c using (customer_name) join p using (product, category) join t using (city)"""


def _grown(name: str, key: str, columns: str) -> str:
    """Members of the early sales numbered first, new members of the late sales after them."""
    return f""", {name} as (
  select {columns}, row_number() over (order by late, {columns}) as {key}
  from (select {columns}, min(case when {CUT} then 0 else 1 end) as late from sales group by {columns}))"""


STAR_LOAD = (
    "with " + LAKE + _lake_latest("sales")
    + _grown("c", "customer_id", "customer_name")
    + _grown("p", "product_id", "product, category")
    + _grown("t", "city_id", "city")
    + """
select order_id, customer_id, product_id, city_id, price, quantity
from sales join c using (customer_name) join p using (product, category) join t using (city)"""
)

REVENUE = "cast(sum({a}) as decimal(28,2)) as revenue"


def _revenue_of(dataset: str, keys: str) -> str:
    return f"""select '{dataset}' as dataset, count(*) as row_count, {REVENUE.format(a='total_revenue')}
  from (select {keys}, sum(total_amount) as total_revenue from silver group by {keys})"""


JSON_SALE = """concat('{"order_id":', cast(order_id as varchar), ',"product":"', product, '","price":',
  cast(price as varchar), ',"quantity":', cast(quantity as varchar), ',"city":"', city, '"}')"""

_CHECK = """, c1 as (
  select customer_id, arg_max(customer_name, updated_at) as customer_name,
    arg_max(customer_email, updated_at) as customer_email from {early} group by customer_id), c2 as (
  select customer_id, arg_max(customer_name, updated_at) as customer_name,
    arg_max(customer_email, updated_at) as customer_email from {late} group by customer_id)
select c1.*, timestamp '2024-06-01 00:00:00' as valid_from,
  case when c2.customer_id is not null and (c1.customer_name is distinct from c2.customer_name
    or c1.customer_email is distinct from c2.customer_email) then timestamp '2024-07-01 00:00:00' end as valid_to
from c1 left join c2 using (customer_id)
union all
select c2.*, timestamp '2024-07-01 00:00:00', cast(null as timestamp)
from c2 left join c1 using (customer_id)
where c1.customer_id is null or c1.customer_name is distinct from c2.customer_name
  or c1.customer_email is distinct from c2.customer_email"""
SNAPSHOT_CHECK = "with " + GOOD + _CHECK.format(early=f"(select * from good where {EVENT_CUT})", late="good")
MODEL_SNAPSHOT = "with " + CHANGES + _staged("early", EVENT_CUT) + _staged("late") + _CHECK.format(early="early", late="late")

CHANGE_STAMP = "with " + LAKE + _lake_latest("before", CUT) + _lake_latest("latest") + """, after as (
  select order_id, customer_name, product, category, price, quantity, city,
    case when quantity >= 10 then updated_at end as updated_at from latest)
select a.order_id, a.customer_name, a.product, a.category, a.price, a.quantity, a.city,
  case when b.order_id is null then coalesce(a.updated_at, timestamp '2024-06-01 00:00:00')
    when a.customer_name is distinct from b.customer_name or a.product is distinct from b.product
      or a.category is distinct from b.category or a.price is distinct from b.price
      or a.quantity is distinct from b.quantity or a.city is distinct from b.city
      then timestamp '2024-06-01 00:00:00'
    else b.updated_at end as updated_at
from after a left join before b on a.order_id = b.order_id"""

MART = """select f.order_date, f.store_id, p.category, count(distinct f.order_id) as order_count,
  cast(sum(f.quantity) as bigint) as units_sold, cast(sum(f.total_amount) as decimal(18,2)) as gross_sales,
  {average} as average_order_value
from {fact} f left join {product} p using (product_id) group by f.order_date, f.store_id, p.category"""


def _mart(fact: str, product: str) -> str:
    return MART.format(fact=fact, product=product, average=AVERAGE.format(x="f.total_amount", p=18))


MERGED = LAKE + _lake_latest("target", "quantity >= 25") + _lake_latest("source", "quantity < 25") + """, merged as (
  select t.* from target t left join source s on t.order_id = s.order_id
  where s.order_id is null or s.updated_at < t.updated_at
  union all
  select s.* from source s left join target t on t.order_id = s.order_id
  where t.order_id is null or s.updated_at >= t.updated_at)"""

LAKE_RUN = LAKE + _lake_latest("first_run", CUT) + _lake_latest("second_run", f"not ({CUT})") + """, lakehouse as (
  select * from second_run
  union all select * from first_run where order_id not in (select order_id from second_run))"""

DAILY = """select order_date, category, cast(sum(total_amount) as decimal(20,2)) as total_revenue,
  count(distinct order_id) as order_count, cast(sum(quantity) as bigint) as units_sold
from {rows} group by order_date, category"""

# The run's watermark is the greatest (time, id) before the cut, so the second
# run sees exactly the rows from the cut on.
REPORT = f"""with {RUN_SILVER}, parts as (
  select case when {CUT} then 'initial' else 'incremental' end as run, * from clean), early as (
  select * from valid where {CUT} qualify row_number() over (partition by order_id {RUN_ORDER}) = 1)
select run, count(*) as bronze_count,
  count(*) filter (where price >= 0 and quantity > 0 and city <> '') as valid_batch_count,
  count(*) filter (where not (price >= 0 and quantity > 0 and city <> '')) as quarantined_count,
  case run when 'initial' then (select count(*) from early) else (select count(*) from silver) end as silver_count,
  cast(case run when 'initial' then (select sum(total_amount) from early)
    else (select sum(total_amount) from silver) end as decimal(28,2)) as silver_revenue,
  'passed' as status
from parts group by run"""



def _line(name: str, failures: str) -> str:
    return f"select '{name}' as check_name, cast(({failures}) as bigint) as failures"


def _lines(ctes: str, lines: list[str]) -> str:
    return f"with {ctes}, lines as ({' union all '.join(lines)}) select check_name, failures, failures = 0 as passed from lines"


def _off_revenue(keys: str) -> str:
    return f"""select count(*) from (select sum(total) as total from (
  select {keys}, sum(total_amount) as total from silver group by {keys}))
  where total is distinct from (select sum(total_amount) from silver)"""


# Every check computed again from the tables, for the rows from the cut on.
GATE = _lines(
    RUN_SILVER + f""", batch as (select * from clean where not ({CUT})), good as (
  select * from valid where not ({CUT})), bad as (
  select * from batch where not (price >= 0 and quantity > 0 and city <> '')), newest as (
  select * from good qualify row_number() over (partition by order_id {RUN_ORDER}) = 1)""",
    [
        _line("bronze_not_empty", "select case when count(*) > 0 then 0 else 1 end from batch"),
        _line(
            "valid_plus_rejected_is_bronze",
            "select abs((select count(*) from batch) - (select count(*) from good) - (select count(*) from bad))",
        ),
        _line(
            "quarantine_count",
            f"""select abs((select count(*) from bad) - (select count(*) from batch
  where {MEDALLION_REASONS} <> ''))""",
        ),
        _line(
            "silver_orders_unique",
            "select count(*) from (select order_id from silver group by order_id having count(*) > 1)",
        ),
        _line(
            "silver_rows_valid",
            """select count(*) from silver where price < 0 or quantity <= 0 or city = ''
  or total_amount is distinct from price * quantity""",
        ),
        _line(
            "batch_reached_silver",
            """select count(*) from newest n left join silver s on n.order_id = s.order_id
  where s.updated_at is null or s.updated_at < n.updated_at""",
        ),
        _line(
            "quarantine_matches",
            f"""select count(*) from (select {FINGERPRINT} from bad
  except all select {FINGERPRINT} from batch where {MEDALLION_REASONS} <> '')""",
        ),
        _line(
            "gold_revenue_matches",
            " + ".join(f"({_off_revenue(k)})" for k in ("category", "city", "product, category", "customer_name")),
        ),
    ],
)


# The same checks over layers that were damaged on purpose.
GATE_DAMAGED = _lines(
    RUN_SILVER + f""", batch as (select * from clean where not ({CUT})), good as (
  select * from valid where not ({CUT})), bad as (
  select * from batch where {MEDALLION_REASONS} <> ''), stored as (select * from bad where order_id % 7 <> 0), newest as (
  select * from good qualify row_number() over (partition by order_id {RUN_ORDER}) = 1), damaged as (
  select * replace (case when order_id % 17 = 0 then -price else price end as price) from (
    select * from silver where order_id % 11 <> 0 union all select * from silver where order_id % 13 = 0))""",
    [
        _line("bronze_not_empty", "select case when count(*) > 0 then 0 else 1 end from batch"),
        _line(
            "valid_plus_rejected_is_bronze",
            "select abs((select count(*) from batch) - (select count(*) from good) - (select count(*) from stored))",
        ),
        _line("quarantine_count", "select count(*) from bad where order_id % 7 = 0"),
        _line(
            "silver_orders_unique",
            "select count(*) from (select order_id from damaged group by order_id having count(*) > 1)",
        ),
        _line(
            "silver_rows_valid",
            """select count(*) from damaged where price < 0 or quantity <= 0 or city = ''
  or total_amount is distinct from price * quantity""",
        ),
        _line(
            "batch_reached_silver",
            """select count(*) from newest n left join damaged d on n.order_id = d.order_id
  where d.updated_at is null or d.updated_at < n.updated_at""",
        ),
        _line("quarantine_matches", "select count(*) from bad where order_id % 7 = 0"),
        _line(
            "gold_revenue_matches",
            """select count(*) from (
    select sum(total_amount) as total from silver where category <> 'ECONOMY'
    union all select sum(total_amount) from silver union all select sum(total_amount) from silver
    union all select sum(total_amount) from silver)
  where total is distinct from (select sum(total_amount) from damaged)""",
        ),
    ],
)


def _null_line(model: str, column: str) -> str:
    return _line(f"{model}.{column}.not_null", f"select count(*) from {model} where {column} is null")


def _unique_line(model: str, column: str) -> str:
    return _line(
        f"{model}.{column}.unique",
        f"select count(*) from (select {column} from {model} group by {column} having count(*) > 1)",
    )


def _model_tests(fact: str) -> str:
    return _lines(
        fact
        + ", stg_current_orders as (select * from late)"
        + f", dim_customer as ({DIM_CUSTOMER.format(rows='late')}), dim_product as ({DIM_PRODUCT.format(rows='late')})"
        + ", fct_sales as (select * from fct)"
        + f", mart_daily_sales as ({_mart('fct', 'dim_product')})",
        [
            *(_null_line("stg_current_orders", c) for c in ("order_id", "customer_id", "product_id", "total_amount")),
            _unique_line("stg_current_orders", "order_id"),
            _null_line("dim_customer", "customer_id"),
            _unique_line("dim_customer", "customer_id"),
            _null_line("dim_product", "product_id"),
            _unique_line("dim_product", "product_id"),
            _null_line("fct_sales", "order_id"),
            _unique_line("fct_sales", "order_id"),
            *(
                _line(
                    f"fct_sales.{k}_id.known",
                    f"select count(distinct {k}_id) from fct_sales where {k}_id not in (select {k}_id from dim_{k})",
                )
                for k in ("customer", "product")
            ),
            _line(
                "fct_sales.sales_positive",
                "select count(*) from fct_sales where quantity <= 0 or unit_price < 0 or total_amount < 0",
            ),
            _null_line("mart_daily_sales", "order_date"),
            _null_line("mart_daily_sales", "gross_sales"),
        ],
    )


MODEL_TESTS = _model_tests(FCT)


ORACLES: dict[str, str] = {
    "incremental_scan": f"""with {RAW}
select order_id, customer_name, product, category, price, quantity, city, updated_at from raw
where updated_at > timestamp '2000-01-01 00:00:00'
  or (updated_at = timestamp '2000-01-01 00:00:00' and order_id > 70000)""",
    "watermark_max": f"""with {RAW}
select epoch_us(updated_at) as updated_at_us, order_id from raw
order by updated_at desc, order_id desc limit 1""",
    "incremental_table_scan": """select l_orderkey, l_linenumber, l_shipdate, l_quantity from lineitem
where l_shipdate > timestamp '2000-01-01 00:00:00'
  or (l_shipdate = timestamp '2000-01-01 00:00:00' and l_orderkey > 7000)""",
    "classify_reasons": f"""with {CLEAN}
select order_id, batch_id as source_batch_id, updated_at as source_updated_at, price, quantity, city,
  total_amount, {MEDALLION_REASONS} as reasons from clean where {MEDALLION_REASONS} <> ''""",
    "classify_merged": f"""with {CLEAN}
select order_id, updated_at, product, price, quantity, city, total_amount, {LAKE_REASONS} as reasons
from clean where {LAKE_REASONS} <> ''""",
    "classify_first_match": f"""with {JUDGED}
select order_id, updated_at, quantity, unit_price, quality_reason, quality_reason is null as is_valid,
  total_amount from judged""",
    "valid_orders": f"with {GOOD} select * from good",
    "quarantined_orders": f"with {JUDGED} select * from judged where quality_reason is not null",
    "expected_operations": f"with {CHANGES} select order_id, updated_at, operation from changes",
    "dropped_operations": f"""with {GOOD}
select count(*) filter (where operation not in ('INSERT', 'UPDATE', 'DELETE')) as dropped, count(*) as seen from good""",
    "record_fingerprint": f"""with {CLEAN}
select order_id, batch_id as source_batch_id, updated_at as source_updated_at,
  {FINGERPRINT} as record_fingerprint from clean""",
    "line_amounts": f"""with {RAW}
select order_id, batch_id, cast(trunc(price) as int) as price, quantity,
  cast(trunc(price) as int) * quantity as total_amount from raw""",
    "dedup_latest": f"with {SILVER} select {SILVER_OUT} from silver",
    "dedup_single_order": f"with {LAKE} {_lake_latest('latest')} select * from latest",
    "rank_products": f"with {RANKED} select * from ranked",
    "top_products_k": f"with {RANKED} select * from ranked where sales_rank <= 25",
    "ordered_history": f"""with {HISTORY}
select order_id, "__START_AT", "__END_AT", total_amount from history order by order_id, "__START_AT" """,
    "kpi_overall": f"with {SILVER} select 'all_retail_sales' as metric_scope, {_kpis()} from silver",
    "kpi_category": f"with {SILVER} select category, {_kpis()} from silver group by category",
    "kpi_city": f"with {SILVER} select city, {_kpis()} from silver group by city",
    "kpi_product": f"with {PRODUCTS} select * from products",
    "kpi_customer": f"""with {SILVER} select customer_name, {_kpis()},
  count(distinct product) as distinct_products from silver group by customer_name""",
    "kpi_all_versions": f"""with {VALID}
select category, {_kpis(orders='count(distinct order_id)')} from valid group by category""",
    "kpi_grouping_sets": f"""with {SILVER}
select 'overall' as scope, null as category, null as city, null as product, null as customer_name, {_kpis()} from silver
union all select 'category', category, null, null, null, {_kpis()} from silver group by category
union all select 'city', null, city, null, null, {_kpis()} from silver group by city
union all select 'product', category, null, product, null, {_kpis()} from silver group by category, product
union all select 'customer', null, null, null, customer_name, {_kpis()} from silver group by customer_name""",
    "daily_category_sales": f"with {LAKE} {_lake_latest('latest')} " + DAILY.format(rows="latest"),
    "daily_store_sales": f"""with {GOOD}
select cast(order_timestamp as date) as order_date, store_id, category, count(distinct order_id) as order_count,
  cast(sum(quantity) as bigint) as units_sold, cast(sum(total_amount) as decimal(25,2)) as gross_sales
from good group by 1, 2, 3""",
    "stg_current_orders": f"""with {HISTORY} select {STAGED_COLUMNS} from history where "__END_AT" is null""",
    "dim_customer": f"with {GOOD} " + DIM_CUSTOMER.format(rows="good"),
    "dim_product": f"with {GOOD} " + DIM_PRODUCT.format(rows="good"),
    "fct_sales": f"with {FCT} select * from fct",
    "mart_daily_sales": f"""with {GOOD}, dim as ({DIM_PRODUCT.format(rows='good')}),
fact as (select *, cast(order_timestamp as date) as order_date from good)
""" + _mart("fact", "dim"),
    "merge_upsert": f"with {MERGED} select * from merged",
    "merge_incremental": f"with {LAKE}" + _lake_latest("target", CUT) + _lake_latest("newest")
    + """, late as (select * replace (-order_id as order_id) from target where quantity < 10),
source as (select * from newest union all select * from late),
fresh as (select * from source where updated_at > (select max(updated_at) from target))
select * from target where order_id not in (select order_id from fresh)
union all select * from fresh""",
    "snapshot_merge": f"with {SILVER} select {SILVER_OUT} from silver",
    "control_merge": f"""with {RAW}, marks as (
  select category, updated_at, order_id, {CUT} as early, row_number() over (
    partition by category, {CUT} order by updated_at desc, order_id desc) as rn from raw), best as (
  select *, row_number() over (partition by category order by early) as pick from marks where rn = 1)
select category, updated_at, order_id from best where pick = 1""",
    "sales_upsert": f"with {LAKE_RUN} select order_id, customer_name, product, category, price, quantity, city, "
    "cast(price * quantity as decimal(23,2)) as total_amount from lakehouse",
    "scd2_history": f"with {HISTORY} select * from history",
    "scd2_current": f"""with {HISTORY} select * from history where "__END_AT" is null""",
    "snapshot_check": SNAPSHOT_CHECK,
    "change_stamp": CHANGE_STAMP,
    "star_dim_customer": _dimension("customer_id", "customer_name"),
    "star_dim_product": _dimension("product_id", "product, category"),
    "star_dim_city": _dimension("city_id", "city"),
    "star_fact": STAR_FACT,
    "star_load": STAR_LOAD,
    "dq_counts": f"""with {CLEAN} select count(*) as input_rows,
  count(*) filter (where price >= 0 and quantity > 0 and city <> '') as valid_rows,
  count(*) filter (where not (price >= 0 and quantity > 0 and city <> '')) as rejected_rows from clean""",
    "dq_counts_merged": f"""with {CLEAN} select count(*) as input_rows,
  count(*) filter (where price >= 0 and quantity > 0) as valid_rows,
  count(*) filter (where not (price >= 0 and quantity > 0)) as rejected_rows from clean""",
    "dq_unique": f"with {RAW} select order_id, count(*) as row_count from raw group by order_id having count(*) > 1",
    "dq_not_null": f"with {CDC} "
    + " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_rows from cdc"
        for c in ("order_id", "customer_id", "product_id", "order_timestamp", "quantity")
    ),
    "dq_null_rows": f"with {CDC} select order_id, updated_at, store_id from cdc where customer_id is null",
    "dq_relationships": """with lines as (select l_partkey from lineitem
  union all select -l_partkey from lineitem where l_linenumber = 7)
select l_partkey, count(*) as row_count from lines
where l_partkey not in (select p_partkey from part) group by l_partkey""",
    "dq_positive": f"""with {JUDGED} select order_id, updated_at, quantity, unit_price, total_amount
from judged where quantity <= 0 or unit_price < 0 or total_amount < 0""",
    "dq_silver_rules": f"""with {CLEAN}
select order_id, batch_id as source_batch_id, price, quantity, city, total_amount from clean
where city = '' or price < 0 or quantity <= 0 or total_amount is distinct from price * quantity""",
    "dq_lineage": f"""with {SILVER}, early as (
  select * from valid where {CUT} qualify row_number() over (partition by order_id
    order by updated_at desc, ingested_at desc, batch_id desc) = 1)
select s.order_id, s.updated_at as batch_updated_at, e.updated_at as silver_updated_at
from silver s left join early e on s.order_id = e.order_id
where e.updated_at is null or e.updated_at < s.updated_at""",
    "dq_fingerprint_diff": f"""with {CLEAN}, bad as (
  select *, {FINGERPRINT} as record_fingerprint from clean where not (price >= 0 and quantity > 0 and city <> ''))
select record_fingerprint, cast(sum(case when {CUT} then -1 else 1 end) as bigint) as surplus
from bad group by record_fingerprint having sum(case when {CUT} then -1 else 1 end) <> 0""",
    "dq_revenue": f"""with {SILVER}
select 'silver' as dataset, count(*) as row_count, {REVENUE.format(a='total_amount')} from silver
union all {_revenue_of('category_sales', 'category')} union all {_revenue_of('city_sales', 'city')}
union all {_revenue_of('product_sales', 'product, category')}
union all {_revenue_of('customer_sales', 'customer_name')}""",
    "dq_one_value": f"""with {RAW} select min(order_date) as least, max(order_date) as greatest,
  min(order_date) = max(order_date) as agrees from raw""",
    "dq_count_match": f"""with {CLEAN} select cast(sum(case when price >= 0 and quantity > 0 and city <> ''
  then 1 else -1 end) as bigint) as surplus from clean""",
    "union_snapshot": f"with {LAKE} {_lake_latest('early', CUT)} select * from early union all "
    f"select * from lake where not ({CUT})",
    "except_all_diff": """select l_partkey, l_linenumber from lineitem
except all select l_partkey, l_linenumber from lineitem where l_returnflag = 'N'""",
    "json_publish": f"with {RAW} select {JSON_SALE} as value from raw",
    "json_parse": """select event_id, cast(regexp_extract(props, '"k": *([0-9]+)', 1) as int) as k from events""",
    "json_rescue": f"""with {CDC}
select order_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') as updated_at, quantity, unit_price, operation,
  concat('{{"channel":"', category, '"}}') as _rescued_data from cdc""",
    "json_dead_letters": f"""with {CDC}
select concat('{{"quantity":', cast(quantity as varchar), ',"updated_at":"',
  strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f'), '"}}') as value from cdc where customer_id is null""",
    "csv_roundtrip": f"""with {RAW}
select order_id, customer_name, product, category, price, quantity, city, batch_id from raw""",
    "csv_inferred": f"with {RAW} select cast(order_id as int) as order_id, product, quantity, batch_id from raw",
    "json_landing": f"with {CDC} select order_id, customer_id, quantity, unit_price, operation from cdc",
    "seed_if_absent": f"with {RAW} select order_id, product, quantity, updated_at, batch_id from raw where {CUT}",
    "bronze_batches": f"""with {RAW}
select order_id, customer_name, product, category, price, quantity, city, updated_at,
  date '2024-06-01' as ingestion_date, '007' as batch_id from raw where {CUT}""",
    "quarantine_write": f"""with {CLEAN}
select order_id, {FINGERPRINT} as record_fingerprint, 'batch-1' as batch_id
from clean where not (price >= 0 and quantity > 0 and city <> '')""",
    "snapshot_publish": f"with {LAKE} {_lake_latest('latest')} select * from latest",
    "bucket_upsert": f"with {MERGED} select * from merged",
    "bucket_deltas": f"with {MERGED} select * from merged",
    "parts_merge": f"with {LAKE}" + _lake_latest("target", CUT) + _lake_latest("newest")
    + """, fresh as (select * from newest where updated_at > (select max(updated_at) from target))
select * from target where order_id not in (select order_id from fresh)
union all select * from fresh""",
    "csv_seed": f"with {RAW} select order_id, product, quantity, updated_at, batch_id from raw where {CUT}",
    "table_append": f"with {LAKE} select order_id, product, updated_at, total_amount, category from lake",
    "table_replace": f"with {LAKE} {_lake_latest('latest')} " + DAILY.format(rows="latest"),
    "stream_parquet": f"""with {RAW} select order_id, customer_name, product, category, price, quantity, city,
  updated_at, batch_id, cast(price * quantity as decimal(23,2)) as total_amount from raw""",
    "stream_upsert": f"""with {RAW} select order_id, customer_name, product, category, price, quantity, city,
  updated_at, batch_id, cast(price * quantity as decimal(23,2)) as total_amount from raw
qualify row_number() over (partition by order_id order by updated_at desc, batch_id desc) = 1""",
    "stream_bronze": f"""with {CDC}
select order_id, customer_id, strftime(order_timestamp, '%Y-%m-%d %H:%M:%S.%f') as order_timestamp, quantity,
  unit_price, operation, concat('{{"channel":"', category, '"}}') as _rescued_data, true as has_source_file,
  true as has_ingest_time from cdc""",
    "stream_changes": f"""with {CHANGES} select order_id, customer_id, updated_at, operation, total_amount,
  concat('{{"channel":"', category, '"}}') as _rescued_data from changes""",
    "stream_quarantine": f"""with {JUDGED} select order_id, updated_at, quality_reason, operation
from judged where quality_reason is not null""",
    "compacted_changes": f"""with {CHANGES} select order_id, customer_id, updated_at, operation, total_amount,
  concat('{{"channel":"', category, '"}}') as _rescued_data from changes""",
    "compacted_quarantine": f"""with {JUDGED} select order_id, updated_at, quality_reason, operation
from judged where quality_reason is not null""",
    "stream_dropped": f"""with {GOOD} select order_id, updated_at, operation from good
where operation not in ('INSERT', 'UPDATE', 'DELETE')""",
    "stream_history": f"with {HISTORY} select * from history",
    "stream_scd2": f"with {HISTORY} select * from history",
    "stream_of_table": f"""with {CDC} select order_id, updated_at, operation, quantity from cdc
where operation in ('INSERT', 'UPDATE', 'DELETE')""",
    "medallion_silver": f"""with {RUN_SILVER}
select order_id, customer_name, category, city, total_amount, updated_at as source_updated_at from silver""",
    "medallion_gold": f"""with {RUN_SILVER}, gold as (select category, {_kpis()} from silver group by category)
select * exclude (last_refreshed_at) from gold""",
    "medallion_report": REPORT,
    "quality_gate": GATE,
    "quality_gate_damaged": GATE_DAMAGED,
    "lakehouse_silver": f"with {LAKE_RUN} select * from lakehouse",
    "lakehouse_restart": f"with {LAKE} {_lake_latest('latest')} select * from latest",
    "lakehouse_gold": f"with {LAKE_RUN} " + DAILY.format(rows="lakehouse"),
    "cdc_history_late": f"with {HISTORY} select * from history",
    "cdc_daily_sales": f"""with {HISTORY}
select cast(order_timestamp as date) as order_date, store_id, category, count(distinct order_id) as order_count,
  cast(sum(quantity) as bigint) as units_sold, cast(sum(total_amount) as decimal(25,2)) as gross_sales
from history where "__END_AT" is null group by 1, 2, 3""",
    "cdc_daily_sales_late": f"""with {HISTORY}
select cast(order_timestamp as date) as order_date, store_id, category, count(distinct order_id) as order_count,
  cast(sum(quantity) as bigint) as units_sold, cast(sum(total_amount) as decimal(25,2)) as gross_sales
from history where "__END_AT" is null group by 1, 2, 3""",
    "model_graph": f"with {FCT}, dim as ({DIM_PRODUCT.format(rows='late')}) " + _mart("fct", "dim"),
    "model_tests": MODEL_TESTS,
    "model_tests_after_deletes": _model_tests(FCT_AFTER_DELETES),
    "model_snapshot": MODEL_SNAPSHOT,
}
