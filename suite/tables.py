"""Sides of the registered comparisons.

Each side is a whole table, or a table with changes injected at known keys
(``%`` picks which rows get a change; no row is left out of a comparison to
make it smaller).  The text is standard SQL that both Spark and the checking
database read; ``{orders}`` stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# conditions on lines, some of which follow from others
LINE_FLAGS = [
    "l_linestatus = 'O'", "l_linenumber between 2 and 3", "l_returnflag = 'R'", "(l_quantity > 25) <> (l_discount > 0.05)",
    "l_quantity > 25", "l_quantity > 10", "l_discount > 0.05", "l_tax > 0.04", "l_extendedprice > 30000", "l_linenumber > 3",
    "l_linenumber > 1", "l_partkey % 2 = 0",
]

SIDES = {
    "orders": "select * from {orders}",
    "orders_changed": """
        select o_orderkey, o_custkey,
               case when o_orderkey % 83 = 11 then null else o_orderstatus end o_orderstatus,
               case when o_orderkey % 89 = 7 then o_totalprice + 1 else o_totalprice end o_totalprice,
               o_orderdate, o_orderpriority
        from {orders} where o_orderkey % 97 <> 5
        union all
        select o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        from {orders} where o_orderkey % 101 = 3""",
    "orders_hot_key": """
        select case when o_orderkey % 3 = 1 then 7 when o_orderkey % 89 = 8 then null else o_orderkey end o_orderkey,
               o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from {orders}""",
    "orders_copies_source": """
        select * from {orders}
        union all select * from {orders} where o_orderkey % 103 = 2
        union all select * from {orders} where o_orderkey % 107 = 4
        union all select * from {orders} where o_orderkey % 107 = 4
        union all select * from {orders} where o_orderkey % 113 = 8
        union all select * from {orders} where o_orderkey % 127 = 9""",
    "orders_copies_target": """
        select * from {orders}
        union all select * from {orders} where o_orderkey % 103 = 2
        union all select * from {orders} where o_orderkey % 107 = 4
        union all select * from {orders} where o_orderkey % 109 = 6
        union all select * from {orders} where o_orderkey % 127 = 9
        union all select * from {orders} where o_orderkey % 127 = 9""",
    "customer_empty_source": """
        select case when c_custkey % 53 = 4 then null else c_custkey end k,
               case when c_custkey % 53 = 4 then null else c_name end n,
               case when c_custkey % 53 = 4 then null else c_acctbal end a,
               case when c_custkey % 53 = 4 then null else c_nationkey end nk,
               case when c_custkey % 53 = 4 then null else c_mktsegment end m from {customer}""",
    "customer_empty_target": """
        select case when c_custkey % 59 = 4 then null else c_custkey end k,
               case when c_custkey % 59 = 4 then null else c_name end n,
               cast(null as double) a,
               case when c_custkey % 59 = 4 then null else c_nationkey end nk,
               case when c_custkey % 59 = 4 then null else c_mktsegment end m from {customer}""",
    "lineitem_flags": f"""
        select {", ".join(f"case when {test} then 1 else 0 end as f{i}" for i, test in enumerate(LINE_FLAGS))}
        from {{lineitem}}""",
    "customer_null_key": """
        select case when c_custkey % 50 = 0 then null else c_custkey end c_custkey,
               case when c_custkey % 50 = 0 then null else c_name end c_name, c_nationkey,
               case when c_custkey % 50 = 0 then null else c_acctbal end c_acctbal, c_mktsegment from {customer}""",
    "customer_null_key_changed": """
        select case when c_custkey % 50 = 0 then null else c_custkey end c_custkey,
               case when c_custkey % 50 = 0 then null else c_name end c_name,
               case when c_custkey % 41 = 3 then c_nationkey + 1 else c_nationkey end c_nationkey,
               case when c_custkey % 50 = 0 then null else c_acctbal end c_acctbal, c_mktsegment from {customer} where c_custkey % 37 <> 2""",
    "orders_text": """
        select cast(o_orderkey as string) k,
               case when o_orderstatus = 'F' then 'True' else '0' end b,
               cast(o_totalprice as string) n,
               substr(cast(o_orderdate as string), 1, 10) d,
               o_orderpriority t from {orders}""",
    "orders_flags": """
        select o_orderkey k, case when o_orderstatus = 'F' then 1 else 0 end b, o_totalprice n,
               o_orderdate d, o_orderpriority t from {orders}""",
    "orders_us": """
        select o_orderkey, concat(' ', cast(o_totalprice as string)) n, o_orderpriority t,
               concat(substr(cast(o_orderdate as string), 6, 2), '/', substr(cast(o_orderdate as string), 9, 2), '/',
                      substr(cast(o_orderdate as string), 1, 4)) d from {orders}""",
    "orders_csv_lines": """
        select o_orderkey, concat(cast(o_orderkey as string), ',', cast(o_custkey as string),
               case when o_orderkey % 97 = 5 then '' else concat(',', o_orderstatus) end, ',"',
               case when o_orderkey % 7 = 1 then 'two\nlines, ""x""' else o_orderpriority end,
               case when o_orderkey % 101 = 9 then '' else '"' end, case when o_orderkey % 89 = 3 then ',more' else '' end) line
        from {orders}""",
    "orders_exact": """
        select o_orderkey, cast(concat('12345678901234567890', lpad(cast(o_orderkey as string), 8, '0'), '.',
                                       lpad(cast(o_orderkey % 100 as string), 2, '0')) as decimal(38,2)) amount,
               o_custkey from {orders}""",
    "orders_exact_text": """
        select cast(o_orderkey as string) o_orderkey,
               concat('12345678901234567890', lpad(cast(o_orderkey as string), 8, '0'),
                      case when o_orderkey % 89 = 3 then lpad(cast(o_orderkey % 100 as string), 2, '0')
                           when o_orderkey % 83 = 7 then concat('.', lpad(cast((o_orderkey + 1) % 100 as string), 2, '0'))
                           else concat('.', lpad(cast(o_orderkey % 100 as string), 2, '0'), '0') end,
                      case when o_orderkey % 89 = 3 then 'e-2' else '' end) amount,
               cast(case when o_orderkey % 101 = 9 then o_custkey + 1 else o_custkey end as string) o_custkey from {orders}""",
    "orders_dates": "select o_orderkey, o_orderdate as loaded, o_orderdate as shipped from {orders}",
    "orders_dates_text": """
        select o_orderkey,
               concat(substr(cast(o_orderdate as string), 1, 10), case when o_orderkey % 61 = 4 then 'T00:00:01.500' else 'T00:00:00.000' end) loaded,
               concat(substr(cast(o_orderdate as string), 1, 10), case when o_orderkey % 67 = 5 then ' 02:00:01+02:00' else ' 02:00:00+02:00' end) shipped
        from {orders}""",
    "orders_days": "select o_orderkey, o_orderdate d1, o_orderdate d2, o_orderdate d3, o_orderdate d4, o_orderdate d5, concat(cast(o_orderkey % 12 + 1 as string), '.', cast(o_custkey % 12 + 1 as string), '.2024') d6 from {orders}",
    "orders_day_texts": """
        select o_orderkey, date_format(o_orderdate + make_dt_interval(if(o_orderkey % 61 = 4, 1, 0)), 'd.M.yyyy') d1,
               date_format(o_orderdate, 'MMMM d, yyyy') d2,
               date_format(o_orderdate + make_dt_interval(if(o_orderkey % 67 = 5, 1, 0)), 'yyyy/M/d H:mm') d3,
               date_format(o_orderdate, 'd MMM yyyy') d4, date_format(o_orderdate, 'M/d/yyyy h:mm a') d5, concat(cast(o_orderkey % 12 + 1 as string), '.', cast(o_custkey % 12 + 1 as string), '.2024') d6 from {orders}""",
    "customer_positions": "select c_custkey c1, c_name c0, c_nationkey, c_acctbal, c_mktsegment from {customer}",
    "customer_positions_changed": """
        select c_custkey c1, c_name c0, case when c_custkey % 41 = 3 then c_nationkey + 1 else c_nationkey end c_nationkey,
               c_acctbal, c_mktsegment from {customer}""",
    "customer_renamed": """
        select c_custkey code, case when c_custkey % 41 = 3 then upper(c_name) else c_name end title,
               c_nationkey, c_acctbal, c_mktsegment from {customer}""",
    "customer_int": "select cast(c_custkey as int) c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from {customer}",
    "orders_text_us": """
        select concat(cast(o_orderkey as string), '.0') k,
               case when o_orderkey % 79 = 5 then 'FALSE' when o_orderstatus = 'F' then 'TRUE' else 'false' end b,
               cast(case when o_orderkey % 73 = 9 then o_totalprice + 2 else o_totalprice end as string) n,
               concat(substr(cast(o_orderdate as string), 6, 2), '/', substr(cast(o_orderdate as string), 9, 2), '/',
                      substr(cast(o_orderdate as string), 1, 4)) d,
               case when o_orderkey % 71 = 6 then upper(concat(o_orderpriority, 'x')) else o_orderpriority end t
        from {orders} where o_orderkey % 97 <> 5""",
    "lineitem": "select * from {lineitem}",
    "lineitem_changed": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               case when l_partkey % 67 = 1 then l_quantity + 1 else l_quantity end l_quantity,
               l_extendedprice, l_discount,
               case when l_suppkey % 31 = 2 then null else l_tax end l_tax,
               case when l_orderkey % 43 = 4 then 'X' else l_returnflag end l_returnflag,
               l_linestatus, l_shipdate
        from {lineitem} where l_orderkey % 97 <> 5""",
    "lineitem_few_changes": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               case when l_orderkey % 1009 = 5 then l_quantity + 1 else l_quantity end l_quantity,
               l_extendedprice, l_discount,
               case when l_orderkey % 1499 = 8 then null else l_tax end l_tax,
               l_returnflag, l_linestatus, l_shipdate
        from {lineitem} where l_orderkey % 1753 <> 6
        union all
        select l_orderkey + 10000000, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
               l_linestatus, l_shipdate
        from {lineitem} where l_orderkey % 1297 = 3""",
    "documents": "select doc_id, text, lang, source, n_chars from {documents}",
    "documents_changed": """
        select doc_id, case when doc_id % 29 = 3 then concat(text, ' ') else text end text,
               case when doc_id % 31 = 4 then upper(lang) else lang end lang, source, n_chars
        from {documents} where doc_id % 41 <> 7""",
    "pages": "select * from {pages}",
    "pages_changed": """
        select page_id, case when page_id % 23 = 2 then concat(url, '/') else url end url,
               case when page_id % 19 = 1 then replace(html, '<p>', '<P>') else html end html
        from {pages}""",
    "embeddings": "select vec_id, embedding, label from {embeddings}",
    "embeddings_changed": """
        select vec_id, case when vec_id % 17 = 3 then null else embedding end embedding,
               case when vec_id % 13 = 2 then label + 1 else label end label
        from {embeddings} where vec_id % 47 <> 1""",
    "conversations": "select conv_id, turn, role, text from {conversations}",
    "conversations_changed": """
        select conv_id, turn, case when conv_id % 9 = 1 and turn = 0 then upper(role) else role end role, text
        from {conversations} where conv_id % 31 <> 6""",
    "conversation_maps": """
        select conv_id, map_from_entries(collect_list(struct(turn, map('text', text, 'role', role)))) turns, count(*) n
        from (select conv_id, turn, max(role) role, max(text) text from {conversations} where turn is not null group by conv_id, turn)
        group by conv_id""",
    "conversation_maps_changed": """
        select conv_id, map_from_entries(reverse(collect_list(struct(turn, map('role', role, 'text',
               if(conv_id % 17 = 3 and turn = 1, concat(text, '!'), text)))))) turns, count(*) n
        from (select conv_id, turn, max(role) role, max(text) text from {conversations} where turn is not null group by conv_id, turn)
        where conv_id % 23 <> 5 group by conv_id""",
    "labels": "select doc_id, quality, toxic from {labels}",
    "labels_text": """
        select cast(doc_id as string) doc_id,
               case when quality = 1 then 'True' else '0' end quality,
               case when doc_id % 11 = 4 then null when toxic = 1 then 'TRUE' else 'false' end toxic
        from {labels}""",
    "events": "select event_id, ts, user_id, event_type, value, props from {events}",
    "events_tokens": """
        select cast(event_id as string) event_id, event_type,
               case when event_id % 13 = 1 then 'NA' when event_id % 13 = 2 then 'null' when event_id % 13 = 3 then ''
                    when event_id % 13 = 4 then 'NAN' else cast(value as string) end value
        from {events}""",
    "customer": "select * from {customer}",
    "customer_narrow": """
        select cast(c_custkey as int) c_custkey, substr(c_name, 1, 12) c_name, c_nationkey,
               cast(c_acctbal as float) c_acctbal, concat(c_mktsegment, '+') c_mktsegment from {customer}""",
}


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def side(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text = SIDES[name]
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{t: read(spark, sf, t) for t in used})


def sql(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", SIDES[name])


def with_sides(src: str, tgt: str) -> str:
    return f"with s as ({sql(src)}), t as ({sql(tgt)})"
