"""DuckDB twins of ``browsekit.sources.fixtures`` as CTE bodies.

The driver registers the raw parquet tables as views; each oracle query
prepends the derived views it needs with ``with_views``.
"""

from __future__ import annotations

import re

RUN = "TIMESTAMP '2024-01-30 12:00:00'"
LAST_RUN = "TIMESTAMP '2024-01-30 11:00:00'"


def ms(ts_sql: str) -> str:
    return f"(epoch_us({ts_sql}) // 1000)"


VIEWS: dict[str, str] = {
    "dim_product_variants": """
        select p_partkey as id,
          lpad(cast(p_partkey // 4 as varchar), 7, '0') as product_style_code,
          lpad(cast((p_partkey // 2) % 2 + 1 as varchar), 2, '0') as group_code,
          lpad(cast(p_partkey % 2 + 1 as varchar), 2, '0') as color_code,
          case when p_type in ('STANDARD', 'PROMO') then 'Shoes'
               when p_type = 'SMALL' then 'Mens Shoes'
               when p_type = 'ECONOMY' then 'Womens Shoes'
               when p_type = 'MEDIUM' then 'Bags' else 'Belts' end as category,
          case when p_partkey % 5 = 0 then replace(p_name, ' ', '  ') else p_name end as product_name,
          p_brand as material,
          split_part(p_name, ' ', 1) as color,
          split_part(p_name, ' ', 1) as filter_color,
          cast(p_size as varchar) as edition_code,
          'R' || cast(p_partkey % 3 as varchar) as factory_region,
          'img/' || cast(p_partkey as varchar) || '.jpg' as variant_primary_image,
          p_partkey // 2 as product_id,
          p_retailprice as retail_usd,
          cast(DATE '2018-01-01' + cast(p_partkey % 1500 as integer) as date) as plan_date,
          case when p_partkey % 3 = 0 then null
               else '{"shortDescription":"' || p_name || '"}' end as group_creative
        from part""",
    "sku_n": """
        select p_partkey as id, s, p_partkey * 5 + s as n
        from part cross join (select unnest(range(5)) as s)""",
    "dim_product_skus": """
        select id as product_variant_id, lpad(cast(n as varchar), 12, '0') as upc,
          cast(s + 35 as varchar) as identifier,
          cast(case when n % 7 = 0 then 2 else 1 end as integer) as damage_level_id
        from sku_n""",
    "active_products": """
        select lpad(cast(n as varchar), 12, '0') as upc, cast(id as varchar) as pvid,
          case when id % 4 = 3 then 'inactive' else 'active' end as active_flag
        from sku_n where n % 11 <> 0""",
    "category_page_product_map": """
        select * from (values ('moccasins', '0000001_01'), ('pumps', '0000002_02'),
                              ('sandals', '0000003_01')) t(category, pid)""",
    "email_uuids": """
        select 'u' || cast(user_id as varchar) as uuid,
          'user' || cast(case when user_id % 10 = 3 then user_id - 1 else user_id end as varchar)
            || '@example.com' as email
        from (select distinct user_id from events) d
        union all
        select 'u' || cast(user_id as varchar), 'alias' || cast(user_id as varchar) || '@example.com'
        from (select distinct user_id from events) d where user_id % 10 = 0""",
    "clickstream_page_views": """
        select 'u' || cast(user_id as varchar) as user_uuid,
          ms as timestamp,
          's' || cast(user_id as varchar) || '_' || cast(ms // 86400000 as varchar) as session_id,
          case when event_type = 'signup' then 'shop.example'
               when event_type = 'purchase' then 'other.example'
               else 'www.shop.example' end as host,
          case when event_type = 'signup'
                 then 'cgid=' || (['moccasins', 'pumps', 'mens-sneakers', 'boots'])[k % 4 + 1] || '&sz=12'
               when event_type = 'error' then 'src=home'
               when event_type = 'click' then 'pid=' || act || '?q=1'
               else 'pid=' || act || '&src=mail' end as query_string,
          'https://www.shop.example/' || act || '.html' ||
            case when k % 3 = 0 then ''
                 else '#!/color/' || lpad(cast(k % 2 + 1 as varchar), 2, '0') ||
                      case when k % 5 = 0 then 'x7y?z=1' else '/v' end end as url
        from (select user_id, event_type, epoch_us(ts) // 1000 as ms, k,
                lpad(cast(g // 2 as varchar), 7, '0') || '_' || lpad(cast(g % 2 + 1 as varchar), 2, '0') as act
              from (select *, k + 100 * (user_id // 20) as g
                    from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) r) e) x""",
    "orders_fact": """
        select case when o_custkey % 3 = 0 then 'guest' when o_custkey % 2 = 0 then 'User' else 'user' end
                 || cast(o_custkey as varchar) || '@example.com' as billing_email,
          o_orderkey as order_id, o_orderdate as order_date,
          lpad(cast(l_partkey * 5 + l_linenumber % 5 as varchar), 12, '0') as sales_order_sku
        from orders join lineitem on o_orderkey = l_orderkey""",
    "inventory_entries": """
        select 2 as id, n // 500 as part, n, lpad(cast(n as varchar), 12, '0') as sku,
          case when n % 97 = 0 then null else (n * 7) % 5 end as qty
        from sku_n
        union all
        select 2, 1000000000 + n // 12500, n, lpad(cast(n as varchar), 12, '0'),
          case when n % 97 = 0 then null when n % 50 = 0 then 9 else 0 end
        from sku_n where n % 50 in (0, 1)
        union all
        select 1, n // 500, n, lpad(cast(n as varchar), 12, '0'), 1 from sku_n
        union all
        select 3, n // 500, n, lpad(cast(n as varchar), 12, '0'), 5 from sku_n""",
    "inventory_events": """
        select cast(id as bigint) as id, part,
          case when id = 3 then 'inventory.audit' else 'inventory.publish' end as type,
          '[' || string_agg(case when qty is null then '{"sku":"' || sku || '"}'
                                 else '{"sku":"' || sku || '","qty":' || cast(qty as varchar) || '}' end,
                            ',' order by n) || ']' as event
        from inventory_entries group by id, part""",
    "inventory_reply": """
        select '{' || string_agg('"' || lpad(cast(n as varchar), 12, '0') || '":{"stock_level":'
                                 || cast((n * 7) % 5 as varchar) || '}', ',' order by n) || '}' as reply
        from sku_n group by n // 500""",
    "send_model_output": """
        select 'user' || cast(user_id as varchar) || '@example.com' as email,
          value / 500 as prob, ts as timestamp,
          cast(json_extract_string(props, '$.k') as integer) % 2 = 0 as send_flag
        from events where event_type = 'purchase'""",
    "send_params": """
        select * from (values
          ('time_since_browse', 150000.0::double, 120000.0::double, -0.8::double),
          ('cgid_count', 2.0, 2.0, 0.3),
          ('pdp_count', 4.0, 3.0, 0.5),
          ('count', 6.0, 4.0, 0.2),
          ('lifetime_orders', 10.0, 6.0, 0.4),
          ('days_since_last_order', 1500.0, 800.0, -0.3),
          ('bias', 0.0, 1.0, 0.1)) t(feature, mean, scale, weight)""",
}

DEPS: dict[str, tuple[str, ...]] = {
    "dim_product_skus": ("sku_n",),
    "active_products": ("sku_n",),
    "inventory_entries": ("sku_n",),
    "inventory_events": ("inventory_entries",),
    "inventory_reply": ("sku_n",),
}


def _order(names, extra: dict[str, str]):
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in DEPS.get(n, ()):
            visit(d)
        body = extra.get(n, VIEWS.get(n))
        for other in list(VIEWS) + list(extra):
            if other != n and re.search(rf"\b{re.escape(other)}\b", body or ""):
                visit(other)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every derived view (and extra CTE) it mentions."""
    extra = dict(ctes or {})
    text = body + " " + " ".join(extra.values())
    wanted = [n for n in list(VIEWS) + list(extra) if re.search(rf"\b{re.escape(n)}\b", text)]
    order = _order(wanted, extra)
    parts = [f"{n} as ({extra.get(n, VIEWS.get(n))})" for n in order]
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
