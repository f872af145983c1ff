"""The registered queries as SQL for the checking database."""

from __future__ import annotations

from itertools import combinations

from suite.tables import sql, with_sides

ORACLES = {}
SAMPLES = 5
FP1 = with_sides("orders", "orders_changed")
FP2 = with_sides("orders_copies_source", "orders_copies_target")
FP3 = with_sides("customer_empty_source", "customer_empty_target")
DAY = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def day(name, alias=None):
    return f"{DAY.format(name)} as {alias or name.split('.')[-1]}"


ORACLES["project_pair"] = f"""
with t as ({sql('orders_changed')})
select o_orderkey as "O_ORDERKEY", o_custkey as "O_CUSTKEY", o_totalprice as "O_TOTALPRICE" from t"""

ORACLES["project_unequal_lists"] = f"""
with t as ({sql('orders_changed')})
select o_custkey as "O_ORDERKEY", o_orderkey as "O_CUSTKEY", o_orderpriority as "O_ORDERPRIORITY" from t"""

ORACLES["display_names"] = """
with raw as (
  select p_partkey, unnest(string_split(p_type || '_' || replace(p_name, ' ', '_') || '_' || lower(p_brand), '_')) as w,
         generate_subscripts(string_split(p_type || '_' || replace(p_name, ' ', '_') || '_' || lower(p_brand), '_'), 1) as i
  from part)
select p_partkey, string_agg(upper(substr(w, 1, 1)) || lower(substr(w, 2)), '_' order by i) as display_name
from raw group by p_partkey"""

ORACLES["distinct_rows"] = "select distinct text, lang from documents"

ORACLES["drop_empty_rows"] = f"""
select * from ({sql('customer_empty_source')}) where k is not null or n is not null or a is not null"""

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORDER_OUT = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {day('o_orderdate')}, o_orderpriority"

ORACLES["count_copies"] = f"""
select {ORDER_OUT}, n as copies from (
  select {ORDER_COLUMNS}, count(*) as n from ({sql('orders_copies_source')}) group by all)"""

ORACLES["count_copies_by_digest"] = ORACLES["count_copies"]

ORACLES["null_tokens"] = f"""
select event_id, event_type,
       case when value in ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
                           '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') then null else value end as value
from ({sql('events_tokens')})"""

ORACLES["count_validation"] = f"""
{FP1}, c as (select (select count(*) from s) as source_count, (select count(*) from t) as target_count)
select *, case when source_count = target_count then 'Pass' else 'Fail' end as result from c"""

ORACLES["empty_row_balance"] = f"""
{FP3}, c as (
  select (select count(*) from s where k is null and n is null and a is null) as source_empty,
         (select count(*) from t where k is null and n is null and a is null) as target_empty)
select source_empty, target_empty,
       greatest(target_empty - source_empty, 0)::bigint as extra_in_target,
       greatest(source_empty - target_empty, 0)::bigint as missing_in_target from c"""

ORACLES["null_populated_columns"] = f"""
{FP3}, c as (
  select 'n' as column_name, (select count(n) from s) as source_values, (select count(n) from t) as target_values
  union all select 'a', (select count(a) from s), (select count(a) from t))
select * from c where source_values > 0 and target_values = 0"""

ORACLES["surplus_duplicates"] = f"""
select {ORDER_OUT}, n - 1 as surplus from (
  select {ORDER_COLUMNS}, count(*) as n from ({sql('orders_copies_source')}) group by all having count(*) > 1)"""

SURPLUS = f"""{FP2},
sd as (select {ORDER_COLUMNS}, count(*) - 1 as surplus from s group by all having count(*) > 1),
td as (select {ORDER_COLUMNS}, count(*) - 1 as surplus from t group by all having count(*) > 1)"""

ORACLES["surplus_totals"] = f"""
{SURPLUS}
select 'source' as side, sum(surplus)::bigint as surplus_rows, count(*) as duplicate_groups from sd
union all select 'target', sum(surplus)::bigint, count(*) from td"""

GROUPS = f"""{SURPLUS},
g as (
  select coalesce(sd.o_orderkey, td.o_orderkey) as o_orderkey, sd.surplus as source_surplus, td.surplus as target_surplus,
         case when td.surplus is null then 'DUPLICATES_ONLY_SOURCE' when sd.surplus is null then 'DUPLICATES_ONLY_TARGET'
              when sd.surplus = td.surplus then 'DUPLICATES_EQUAL' when sd.surplus > td.surplus then 'DUPLICATES_PARTIAL'
              else 'DUPLICATES_EXTRA_LOADED' end as code
  from sd full outer join td on sd.o_orderkey = td.o_orderkey)"""
ORACLES["duplicate_groups"] = f"{GROUPS} select * from g"
ORACLES["duplicate_classes"] = f"{GROUPS} select code, count(*) as groups from g group by code"

FINDING = """select '{check}' as check_name, {severity} as severity, {code} as code, {column} as source_column,
  {target} as target_column, {n} as n, {key} as key_text, {sv} as source_value, {tv} as target_value"""


def finding(check, code, n="cast(null as bigint)", severity="'error'", column=None, target=None, key=None, sv=None, tv=None):
    text = "cast(null as varchar)"
    return FINDING.format(check=check, code=code, n=n, severity=severity, column=column or text, target=target or column or text,
                          key=key or text, sv=sv or text, tv=tv or text)


ORACLES["duplicates_extra"] = f"""
with td as (select count(*) - 1 as surplus from ({sql('orders_copies_target')}) group by {ORDER_COLUMNS} having count(*) > 1)
{finding('Duplicate Validation', "'EXTRA_DUPLICATES'", 'sum(surplus)::bigint')} from td"""
ORACLES["duplicates_not_loaded"] = f"""
with sd as (select count(*) - 1 as surplus from ({sql('orders_copies_source')}) group by {ORDER_COLUMNS} having count(*) > 1)
{finding('Duplicate Validation', "'DUPLICATES_NOT_LOADED'", 'sum(surplus)::bigint', "'warning'")} from sd"""
ORACLES["duplicates_both_sides"] = f"""
{GROUPS}
{finding('Duplicate Validation', 'code', 'count(*)', "case when code in ('DUPLICATES_EQUAL', 'DUPLICATES_PARTIAL') then 'warning' else 'error' end")}
from g group by code"""

# -- keys

ORACLES["key_is_unique"] = """
with k as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all)
select sum(n)::bigint as row_count, count(*) as distinct_keys, count(*) filter (n > 1) as repeated_keys,
       count(*) filter (l_orderkey is null or l_linenumber is null) as null_keys,
       count(*) filter (n > 1) = 0 as is_unique from k"""


def declared(table, *key):
    cols = ", ".join(key)
    filled = " and ".join(f"{k} is not null" for k in key)
    return f"""
with d as (select distinct * from {table}), k as (select {cols}, count(*) as n from d where {filled} group by {cols})
select case when max(n) = 1 then 1 else 2 end::integer as status, sum(n)::bigint as keyed_rows, count(*) as distinct_keys from k"""


ORACLES["declared_key_violated"] = declared("lineitem", "l_orderkey", "l_linenumber")
ORACLES["declared_key_copies"] = declared(f"({sql('orders_copies_source')})", "o_orderkey")
ORACLES["declared_key_check"] = declared("conversations", "conv_id", "turn")


def first_key(source, columns, width):
    """First column set by size and list order without nulls that is unique
    over the distinct rows, then the same ignoring rows with a null."""
    tests, ordinal = [], 0
    for strict in (True, False):
        for size in range(1, width + 1):
            for combo in combinations(columns, size):
                ordinal += 1
                filled = " and ".join(f"{c} is not null" for c in combo)
                name = ",".join(combo)
                origin = "discovered" if strict else "discovered_ignoring_nulls"
                value = f"row({', '.join(combo)})"
                ok = f"count(distinct {value}) filter ({filled}) = count(*) filter ({filled}) and count(*) filter ({filled}) > 0"
                if strict:
                    ok += f" and count(*) filter ({filled}) = count(*)"
                tests.append(f"select {ordinal} as o, '{name}' as key_columns, '{origin}' as origin, {ok} as ok from d")
    return f"""
with d as (select distinct * from ({source})), tests as ({' union all '.join(tests)})
select key_columns, origin, (select count(*) from d) as row_count from tests where ok order by o limit 1"""


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORACLES["discover_key"] = first_key("select * from orders", [c.strip() for c in ORDER_COLUMNS.split(",")], 2)
ORACLES["discover_composite_key"] = first_key("select * from lineitem", LINE_COLUMNS, 2)
FLAGS = [f"f{i}" for i in range(12)]
ORACLES["discover_flag_key"] = f"""
with d as (select distinct * from ({sql('lineitem_flags')})),
b as (select {' + '.join(f'{2 ** (11 - i)} * {c}' for i, c in enumerate(FLAGS))} as v from d),
m as (select unnest(range(1, 4096))::integer as m),
u as (select m from b, m group by m having count(distinct v & m) = count(*)),
k as (select m from u order by bit_count(m), m desc limit 1)
select concat_ws(',', {', '.join(f"case when m & {2 ** (11 - i)} > 0 then '{c}' end" for i, c in enumerate(FLAGS))}) as key_columns,
       'discovered' as origin, (select count(*) from d) as row_count from k"""
ORACLES["discover_nullable_key"] = first_key(sql("customer_null_key"), ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], 3)
ORACLES["discover_text_key"] = first_key("select * from conversations", ["conv_id", "turn", "role", "text"], 4)

# -- value classes

ORACLES["infer_value_classes"] = f"""
{with_sides('orders_text', 'orders_flags')},
f as (
  select count(*) filter (not lower(b) in ('1', '0', 'true', 'false')) as b_bool,
         count(*) filter (try_cast(k as double) is null and k is not null) as k_num,
         count(*) filter (not lower(n) in ('1', '0', 'true', 'false')) as n_bool,
         count(*) filter (try_cast(n as double) is null and n is not null) as n_num,
         count(*) filter (not lower(d) in ('1', '0', 'true', 'false')) as d_bool,
         count(*) filter (try_strptime(d, '%Y-%m-%d') is null and d is not null) as d_date,
         count(*) filter (not lower(t) in ('1', '0', 'true', 'false')) as t_bool,
         count(k) as k, count(b) as b, count(n) as n, count(d) as d, count(t) as t from s),
g as (select count(k) as k, count(b) as b, count(n) as n, count(d) as d, count(t) as t,
             count(*) filter (b not in (0, 1)) as b_bool, count(*) filter (n not in (0, 1)) as n_bool from t)
select 'k' as column_name, case when k_num = 0 then 'numeric' else 'string' end as kind, f.k as source_values, g.k as target_values from f, g
union all select 'b', case when f.b_bool = 0 or g.b_bool = 0 then 'boolean' else 'string' end, f.b, g.b from f, g
union all select 'n', case when f.n_bool = 0 or g.n_bool = 0 then 'boolean' when n_num = 0 then 'numeric' else 'string' end, f.n, g.n from f, g
union all select 'd', case when d_bool = 0 then 'boolean' when d_date = 0 then 'date' else 'string' end, f.d, g.d from f, g
union all select 't', case when t_bool = 0 then 'boolean' else 'string' end, f.t, g.t from f, g"""

ORACLES["infer_label_classes"] = f"""
{with_sides('labels', 'labels_text')},
f as (select count(doc_id) as d, count(quality) as q, count(toxic) as x,
             count(*) filter (quality not in (0, 1)) as qb, count(*) filter (toxic not in (0, 1)) as xb from s),
g as (select count(doc_id) as d, count(quality) as q, count(toxic) as x,
             count(*) filter (try_cast(doc_id as double) is null) as dn,
             count(*) filter (lower(quality) not in ('1', '0', 'true', 'false')) as qb,
             count(*) filter (lower(toxic) not in ('1', '0', 'true', 'false')) as xb from t)
select 'doc_id' as column_name, case when g.dn = 0 then 'numeric' else 'string' end as kind, f.d as source_values, g.d as target_values from f, g
union all select 'quality', case when f.qb = 0 or g.qb = 0 then 'boolean' else 'string' end, f.q, g.q from f, g
union all select 'toxic', case when f.xb = 0 or g.xb = 0 then 'boolean' else 'string' end, f.x, g.x from f, g"""

ORACLES["class_statistics"] = f"""
with s as ({sql('orders_text')}), l as (
  select unnest(['k', 'b', 'n', 'd', 't']) as column_name, unnest([k, b, n, d, t]) as v from s)
select column_name, count(v) as value_count,
       count(*) filter (v is not null and lower(v) not in ('1', '0', 'true', 'false')) as not_boolean,
       count(*) filter (v is not null and try_cast(v as double) is null) as not_number,
       count(*) filter (v is not null and try_strptime(v, '%Y-%m-%d') is null) as not_iso_date
from l group by column_name"""


def boolean_text(c):
    t = f"lower(cast({c} as varchar))"
    return f"case when {t} in ('1', 'true') then 'true' when {t} in ('0', 'false') then 'false' else {t} end"


ORACLES["normalize_boolean"] = f"""
with t as ({sql('labels_text')})
select t.doc_id, {boolean_text('t.quality')} as quality, {boolean_text('t.toxic')} as toxic, {boolean_text('l.quality')} as flag
from t join labels l on cast(l.doc_id as varchar) = t.doc_id"""
ORACLES["normalize_numeric"] = f"""
select o_orderkey as k, try_cast(trim(n) as double) as n, try_cast(t as double) as not_a_number
from ({sql('orders_us')})"""
ORACLES["normalize_date"] = f"""
select o_orderkey, strftime(try_strptime(d, '%m/%d/%Y'), '%Y-%m-%d %H:%M:%S') as d,
       strftime(try_strptime(t, '%m/%d/%Y'), '%Y-%m-%d %H:%M:%S') as not_a_date from ({sql('orders_us')})"""

# -- reconciliation

OC = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
JOINED = f"""{FP1}, j as (
  select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey, s.o_orderkey is not null as in_source, t.o_orderkey is not null as in_target,
         {', '.join(f's.{c} as source__{c}, t.{c} as target__{c}' for c in OC)}
  from s full outer join t on s.o_orderkey = t.o_orderkey)"""
DATES = "* replace ({}, {})".format(
    day("source__o_orderdate"), day("target__o_orderdate"))
ORACLES["reconcile"] = f"{JOINED} select {DATES} from j"
ORACLES["only_in_source"] = f"{JOINED} select o_orderkey, source__o_custkey, source__o_totalprice from j where not in_target"
ORACLES["only_in_target"] = f"{JOINED} select o_orderkey, target__o_custkey, target__o_totalprice from j where not in_source"
ORACLES["matched_rows"] = f"{JOINED} select o_orderkey, source__o_totalprice, target__o_totalprice from j where in_source and in_target"
ORACLES["extra_record_counts"] = f"""
{JOINED} select count(*) filter (not in_target) as only_in_source, count(*) filter (not in_source) as only_in_target from j"""

ORACLES["reconcile_hot_target"] = f"""
{with_sides('orders', 'orders_hot_key')}, j as (
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey, s.o_custkey is not null as in_source, t.o_custkey is not null as in_target,
       {', '.join(f's.{c} as source__{c}, t.{c} as target__{c}' for c in OC)}
from s full outer join t on s.o_orderkey = t.o_orderkey)
select {DATES} from j"""

ORACLES["reconcile_by_buckets_hot_target"] = ORACLES["reconcile_hot_target"]

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
LINE_VALUES = [c for c in LINE_COLUMNS if c not in LINE_KEY]
LINE_PAIR = with_sides("lineitem", "lineitem_few_changes")
LINE_JOINED = f"""{LINE_PAIR}, j as (
  select {', '.join(f'coalesce(s.{k}, t.{k}) as {k}' for k in LINE_KEY)}, s.l_orderkey is not null as in_source, t.l_orderkey is not null as in_target,
         {', '.join(f's.{c} as source__{c}, t.{c} as target__{c}' for c in LINE_VALUES)}
  from s full outer join t on {' and '.join(f's.{k} = t.{k}' for k in LINE_KEY)})"""
LINE_DAY = "* replace ({})".format(day("l_shipdate"))
ORACLES["reconcile_by_buckets"] = f"{LINE_JOINED} select {LINE_DAY} from j"
ORACLES["differences_by_buckets"] = f"""{LINE_JOINED} select {LINE_DAY} from j
where not (in_source and in_target) or {' or '.join(f'source__{c} is distinct from target__{c}' for c in LINE_VALUES)}"""


def surplus(pair, columns, date):
    """Both directions of EXCEPT ALL with the number of copies."""
    names = ", ".join(columns)
    return f"""
{pair}, a as (select {names}, count(*) as n from (select {names} from s except all select {names} from t) group by all),
b as (select {names}, count(*) as n from (select {names} from t except all select {names} from s) group by all)
select * replace ({day(date)}) from (
  select {names}, n as surplus_in_source, 0::bigint as surplus_in_target from a union all select {names}, 0::bigint, n from b)"""


ORACLES["difference_by_cells"] = surplus(LINE_PAIR, LINE_COLUMNS, "l_shipdate")
ORACLES["difference_by_cells_with_copies"] = surplus(FP2, ["o_orderkey", *OC], "o_orderdate")


def differs(c):
    return f"in_source and in_target and source__{c} is distinct from target__{c}"


def per_column(columns, item, sep=" union all "):
    return sep.join(item(i, c) for i, c in enumerate(columns))


ORACLES["mismatch_counts"] = f"""
{JOINED}, c as ({per_column(OC, lambda i, c: f"select '{c}' as column_name, count(*) filter ({differs(c)}) as mismatches from j")})
select * from c where mismatches > 0"""


def sample(c):
    number = lambda v: v if c in ("o_totalprice", "o_custkey") else f"try_cast({v} as double)"
    text = "source__o_orderstatus" if c == "o_orderstatus" else "cast(null as varchar)"
    if c == "o_orderdate":
        number = lambda v: "cast(null as double)"
    return f"""select '{c}' as column_name, o_orderkey, cast(row_number() over (order by o_orderkey) as integer) as example,
      cast({number('source__' + c)} as double) as source_number, cast({number('target__' + c)} as double) as target_number,
      {text} as source_text from j where {differs(c)}"""


ORACLES["mismatch_samples"] = f"""
{JOINED}, c as ({per_column(OC, lambda i, c: sample(c))}) select * from c where example <= {SAMPLES}"""

ORACLES["except_all_diff"] = f"""
{FP1}, a as (select {ORDER_COLUMNS}, count(*) as n from (select * from s except all select * from t) group by all),
b as (select {ORDER_COLUMNS}, count(*) as n from (select * from t except all select * from s) group by all)
select {ORDER_OUT}, n as surplus_in_source, 0::bigint as surplus_in_target from a
union all select {ORDER_OUT}, 0::bigint, n from b"""


def table_differences(src, tgt, key, columns):
    on = " and ".join(f"s.{k} = t.{k}" for k in key)
    k = key[0]
    items = [f"select 'only_in_source' as fact, count(*) filter (tk is null) as n from j",
             f"select 'only_in_target', count(*) filter (sk is null) from j"]
    items += [f"select '{c}', count(*) filter (sk is not null and tk is not null and s_{c} is distinct from t_{c}) from j"
              for c in columns]
    return f"""
{with_sides(src, tgt)}, j as (
  select s.{k} as sk, t.{k} as tk, {', '.join(f's.{c} as s_{c}, t.{c} as t_{c}' for c in columns)}
  from s full outer join t on {on})
{' union all '.join(items)}"""


ORACLES["document_differences"] = table_differences(
    "documents", "documents_changed", ["doc_id"], ["text", "lang", "source", "n_chars"])
ORACLES["page_differences"] = table_differences("pages", "pages_changed", ["page_id"], ["url", "html"])
ORACLES["nested_differences"] = table_differences(
    "embeddings", "embeddings_changed", ["vec_id"], ["embedding", "label"])
ORACLES["conversation_differences"] = table_differences(
    "conversations", "conversations_changed", ["conv_id", "turn"], ["role", "text"])

# -- the data check as a whole

DATA = "Data Validation"


def data_rows():
    parts = [
        finding(DATA, "'EXTRA_IN_SOURCE'", "count(*)") + " from j where not in_target",
        finding(DATA, "'EXTRA_IN_TARGET'", "count(*)") + " from j where not in_source",
    ]
    for c in OC:
        name = f"'{c.upper()}'"
        parts.append(finding(DATA, "'MISMATCH_COUNT'", "count(*)", column=name) + f" from j where {differs(c)}")
        shown = lambda v: day(v, "x")[: -len(" as x")] if c == "o_orderdate" else f"cast({v} as varchar)"  # noqa: E731,B023
        parts.append(
            "select * from (" + finding(DATA, "'VALUE_MISMATCH'", column=name, key="'O_ORDERKEY=' || o_orderkey",
                                        sv=shown("source__" + c), tv=shown("target__" + c))
            + f" from j where {differs(c)} order by o_orderkey limit {SAMPLES})")
    return " union all ".join(f"({p})" for p in parts)


ORACLES["data_findings"] = f"""
{JOINED}, c as ({data_rows()}) select * from c where n is null or n > 0"""


def keyed_findings(src, tgt, key, columns, compare=None, shown=None, local=()):
    """Findings of distinct non-empty sides joined on a key; rows whose key holds a null match as whole rows.

    ``key`` maps a column to (source, target) expressions; ``compare`` and ``shown`` give the comparison
    and the two texts of a column where they are not plain.
    """
    compare = compare or (lambda c: f"s_{c} is distinct from t_{c}")
    shown = shown or (lambda c: (f"cast(s_{c} as varchar)", f"cast(t_{c} as varchar)"))
    every = [*key, *columns]
    filled = " or ".join(f"{c} is not null" for c in every)
    row = "concat_ws('|', " + ", ".join(f"coalesce(cast({{0}}.{c} as varchar), 'null')" for c in every) + ")"
    exprs = key.values()
    on = " and ".join(f"{a} is not distinct from {b}" for a, b in exprs)
    whole = [f"case when {' or '.join(f'{e[i]} is null' for e in exprs)} then {row.format(side)} end" for i, side in enumerate("st")]
    on += f" and {whole[0]} is not distinct from {whole[1]}"
    both = "sin and tin and"
    key_text = " || ',' || ".join(f"'{k.upper()}=' || {shown(k)[0]}" for k in key)
    parts = [finding(DATA, "'EXTRA_IN_SOURCE'", "count(*)") + " from j where tin is null",
             finding(DATA, "'EXTRA_IN_TARGET'", "count(*)") + " from j where sin is null"]
    for c in columns:
        sv, tv = shown(c)
        parts.append(finding(DATA, "'MISMATCH_COUNT'", "count(*)", column=f"'{c.upper()}'") + f" from j where {both} ({compare(c)})")
        parts.append("select * from (" + finding(DATA, "'VALUE_MISMATCH'", column=f"'{c.upper()}'", key=key_text, sv=sv, tv=tv)
                     + f" from j where {both} ({compare(c)}) order by {', '.join(f's_{k}' for k in key)}, {sv} nulls first, {tv} nulls first limit {SAMPLES})")
    return f"""
with rs as ({sql(src)}), rt as ({sql(tgt)}),
s as (select distinct *, true as sin from rs where {filled}), t as (select distinct *, true as tin from rt where {filled}),
j as (select {', '.join(f's.{c} as s_{c}, t.{c} as t_{c}' for c in every)}, sin, tin from s full outer join t on {on}),
c as ({' union all '.join(f'({p})' for p in [*parts, *local])})
select * from c where n is null or n > 0"""


def same(*key):
    return {k: (f"s.{k}", f"t.{k}") for k in key}


def with_days(*dates):
    return lambda c: tuple(DAY.format(f"{p}_{c}") if c in dates else f"cast({p}_{c} as varchar)" for p in "st")


ORACLES["repeated_target_findings"] = keyed_findings(
    "orders", "orders_hot_key", same("o_orderkey"), OC, shown=with_days("o_orderdate"), local=[
        finding(DATA, "'TARGET_KEY_NOT_UNIQUE'", severity="'warning'", column="'O_ORDERKEY'")
        + " where exists (select 1 from t where o_orderkey is not null group by o_orderkey having count(*) > 1)"])

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
ORACLES["lineitem_findings"] = keyed_findings(
    "lineitem", "lineitem_changed", same(*LINE_KEY), [c for c in LINE_COLUMNS if c not in LINE_KEY], shown=with_days("l_shipdate"))

TEXT_RULES = {
    "b": "(case when s_b = 1 then 'true' else 'false' end) is distinct from lower(t_b)",
    "n": "s_n is distinct from cast(t_n as double)",
    "d": "s_d is distinct from strptime(t_d, '%m/%d/%Y')",
    "t": "s_t is distinct from t_t",
}
TEXT_SHOWN = {"b": ("case when s_b = 1 then 'true' else 'false' end", "lower(t_b)"),
              "d": (DAY.format("s_d"), DAY.format("strptime(t_d, '%m/%d/%Y')"))}
ORACLES["text_against_typed"] = keyed_findings(
    "orders_flags", "orders_text_us", {"k": ("s.k", "cast(cast(t.k as double) as bigint)")}, ["b", "n", "d", "t"], TEXT_RULES.get,
    lambda c: TEXT_SHOWN.get(c, (f"cast(s_{c} as varchar)", f"cast(t_{c} as varchar)")))

CUSTOMER_REST = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORACLES["null_key_findings"] = keyed_findings("customer_null_key", "customer_null_key_changed", same("c_custkey"), CUSTOMER_REST)

EMPTY = "select count(*) from {} where k is null and n is null and a is null and nk is null and m is null"
ORACLES["empty_and_null_findings"] = keyed_findings(
    "customer_empty_source", "customer_empty_target", same("k"), ["n", "a", "nk", "m"], local=[
        finding(DATA, f"'{code}_EMPTY_RECORDS'", "greatest(({}) - ({}), 0)".format(*(EMPTY.format(r) for r in sides)))
        for code, sides in (("EXTRA", ("rt", "rs")), ("MISSING", ("rs", "rt")))] + [
        finding(DATA, "'NULL_POPULATED'", column="'A'") + " where (select count(a) from rs) > 0 and (select count(a) from rt) = 0"])

# -- datatypes

ORACLES["observed_metadata"] = """
select 0::integer as ordinal, 'doc_id' as column_name, 'BIGINT' as data_type, 0::integer as char_len, 19::integer as num_precision, 10::integer as num_radix
union all select 1, 'text', 'VARCHAR', (select max(length(text)) from documents)::integer, 0, 0
union all select 2, 'lang', 'VARCHAR', (select max(length(lang)) from documents)::integer, 0, 0
union all select 3, 'source', 'VARCHAR', (select max(length(source)) from documents)::integer, 0, 0
union all select 4, 'n_chars', 'BIGINT', 0, 19, 10"""

CUSTOMER_TYPES = {  # column: (source spark type, target spark type)
    "c_custkey": ("bigint", "int"), "c_name": ("string", "string"), "c_nationkey": ("int", "int"),
    "c_acctbal": ("double", "float"), "c_mktsegment": ("string", "string"),
}
NAMES = {
    "SQLSERVER": {"bigint": "BIGINT", "int": "INT", "double": "FLOAT", "float": "REAL", "string": "VARCHAR"},
    "SNOWFLAKE": {"bigint": "NUMBER", "int": "NUMBER", "double": "FLOAT", "float": "FLOAT", "string": "TEXT"},
    "SPARK": {"bigint": "BIGINT", "int": "INT", "double": "DOUBLE", "float": "FLOAT", "string": "STRING"},
}
FAMILY = {"BIGINT": "N", "INT": "N", "FLOAT": "A", "REAL": "A", "DOUBLE": "A", "VARCHAR": "C", "STRING": "C"}
MAPPED = {"INT": "NUMBER", "FLOAT": "FLOAT", "REAL": "FLOAT", "VARCHAR": "TEXT"}
LENGTHS = {"bigint": (19, 10), "int": (10, 10), "double": (53, 2), "float": (24, 2), "string": (0, 0)}


def datatype_sql(source, target):
    rows = []
    for c, (a, b) in CUSTOMER_TYPES.items():
        st, tt = NAMES[source][a], NAMES[target][b]
        if source == target == "SNOWFLAKE":
            sa, ta = st, tt
        elif source == target:
            sa, ta = FAMILY[st], FAMILY[tt]
        elif source == "SQLSERVER":
            sa, ta = MAPPED.get(st), tt
        else:
            sa, ta = st, MAPPED.get(tt)
        (sp, sr), (tp, tr) = LENGTHS[a], LENGTHS[b]
        if source != target:
            if source == "SQLSERVER" and tt == "FLOAT":
                tp, tr = 53, 2
            if source == "SNOWFLAKE" and st == "FLOAT":
                sp, sr = 53, 2
        chars = lambda df: f"(select max(length({c})) from {df})" if a == "string" else "0"  # noqa: E731,B023
        lit = lambda v: f"'{v}'" if v else "cast(null as varchar)"
        rows.append(f"select '{c}' as column_name, '{st}' as source_type, '{tt}' as target_type, {lit(sa)} as sa, {lit(ta)} as ta, "
                    f"{chars('customer')} > {chars('n')} or {sp} > {tp} or {sr} > {tr} as longer")
    named = "true" if source == target and source != "SNOWFLAKE" else "false"
    return f"""
with n as ({sql('customer_narrow')}), r as ({' union all '.join(rows)})
select column_name, source_type, target_type, 'TYPE_UNMAPPED' as code from r where sa is null or ta is null
union all select column_name, source_type, target_type, 'TYPE_MISMATCH' from r
  where sa <> ta or (sa = ta and longer and {named} and source_type <> target_type)
union all select column_name, source_type, target_type, 'TRUNCATION' from r where sa = ta and longer"""


ORACLES["datatype_same_system"] = datatype_sql("SQLSERVER", "SQLSERVER")
ORACLES["datatype_snowflake"] = datatype_sql("SNOWFLAKE", "SNOWFLAKE")
ORACLES["datatype_cross_system"] = datatype_sql("SQLSERVER", "SNOWFLAKE")
ORACLES["datatype_cross_system_back"] = datatype_sql("SNOWFLAKE", "SQLSERVER")
ORACLES["datatype_spark"] = datatype_sql("SPARK", "SPARK")

# -- files, manifest, report

ORACLES["csv_source"] = """
select cast(c_custkey as varchar) as "C_CUSTKEY", case when c_custkey % 7 <> 3 then c_name end as "C_NAME",
       cast(c_nationkey as varchar) as "C_NATIONKEY", cast(c_acctbal as varchar) as "C_ACCTBAL",
       c_mktsegment as "C_MKTSEGMENT" from customer"""
ORACLES["csv_line_breaks"] = """
select cast(page_id as varchar) as "PAGE_ID", url as "URL", nullif(html, '') as "HTML" from pages"""
CSV_LINES = f"""
with l as (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, line,
                  1 + sum(1 + length(line) - length(replace(line, chr(10), ''))) over (order by o_orderkey) as behind
           from ({sql('orders_csv_lines').replace(chr(92) + 'n', "' || chr(10) || '").replace('string', 'varchar')}) join orders using (o_orderkey)),
r as (select *, cast(behind - (length(line) - length(replace(line, chr(10), ''))) as bigint) as pos, case
        when o_orderkey % 101 = 9 then 'a quoted field is not closed'
        when o_orderkey % 97 = 5 and o_orderkey % 89 <> 3 then 'fewer fields than the header'
        when o_orderkey % 89 = 3 and o_orderkey % 97 <> 5 then 'more fields than the header' end as reason from l)"""
ORACLES["csv_bad_records"] = f"""{CSV_LINES}
select pos as line, reason, line as record from r where reason is not null and (reason not like 'a %' or line not like '%' || chr(10) || '%')
union all select pos + u.i, reason, u.piece from r, (select unnest(string_split(line, chr(10))) as piece, generate_subscripts(string_split(line, chr(10)), 1) - 1 as i, o_orderkey as k from r) u
where k = o_orderkey and reason like 'a %' and line like '%' || chr(10) || '%'"""
ORACLES["csv_good_records"] = f"""{CSV_LINES}
select cast(o_orderkey as varchar) as "O_ORDERKEY", cast(o_custkey as varchar) as "O_CUSTKEY",
       case when o_orderkey % 97 = 5 then case when o_orderkey % 7 = 1 then 'two' || chr(10) || 'lines, "x"' else o_orderpriority end else o_orderstatus end as "O_ORDERSTATUS",
       case when o_orderkey % 97 = 5 then 'more' when o_orderkey % 7 = 1 then 'two' || chr(10) || 'lines, "x"' else o_orderpriority end as "O_ORDERPRIORITY"
from r where reason is null"""
ORACLES["csv_against_table"] = ORACLES["data_findings"]


def changed_cells(key, cells):
    """Findings of a pair in which only the given cells (column, table, condition, values) differ."""
    parts = []
    for column, table, where, sv, tv in cells:
        name = f"'{column.upper()}'"
        parts.append(finding(DATA, "'MISMATCH_COUNT'", "count(*)", column=name) + f" from {table} where {where}")
        parts.append("select * from (" + finding(DATA, "'VALUE_MISMATCH'", column=name, key=f"'{key.upper()}=' || {key}", sv=sv, tv=tv)
                     + f" from {table} where {where} order by {key} limit {SAMPLES})")
    return f"select * from ({' union all '.join(f'({p})' for p in parts)}) where n is null or n > 0"


def amount(k):
    return f"""rtrim(concat('12345678901234567890', lpad(cast(o_orderkey as varchar), 8, '0'), '.',
      lpad(cast({k} % 100 as varchar), 2, '0')), '0')"""


# an amount that ends in .00 keeps the zeros before its point
WHOLE = "concat('12345678901234567890', lpad(cast(o_orderkey as varchar), 8, '0'))"
AMOUNT = "case when {0} % 100 = 0 then " + WHOLE + " else {1} end"
ORACLES["exact_decimals"] = changed_cells("o_orderkey", [
    ("amount", "orders", "o_orderkey % 83 = 7 and o_orderkey % 89 <> 3", AMOUNT.format("o_orderkey", amount("o_orderkey")),
     AMOUNT.format("(o_orderkey + 1)", amount("(o_orderkey + 1)"))),
    ("o_custkey", "orders", "o_orderkey % 101 = 9", "cast(o_custkey as varchar)", "cast(o_custkey + 1 as varchar)"),
])
STAMP = "strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:0"
ORACLES["dates_with_fraction_and_zone"] = changed_cells("o_orderkey", [
    ("loaded", "orders", "o_orderkey % 61 = 4", STAMP + "0'", STAMP + "1.5'"),
    ("shipped", "orders", "o_orderkey % 67 = 5", STAMP + "0'", STAMP + "1'"),
])
ORACLES["derived_date_layouts"] = changed_cells("o_orderkey", [
    (d, "orders", f"o_orderkey % {m} = {k}", DAY.format("o_orderdate"), DAY.format("o_orderdate + interval 1 day"))
    for d, m, k in (("d1", 61, 4), ("d3", 67, 5))
]) + " union all " + finding(DATA, "'DATE_AMBIGUOUS'", severity="'warning'", column="'D6'")
CHANGED_TURNS = "select distinct conv_id from conversations where turn = 1 and conv_id % 17 = 3 and conv_id % 23 <> 5 and text is not null"
ORACLES["map_findings"] = f"""select * from (
{finding(DATA, "'MISMATCH_COUNT'", "count(*)", column="'TURNS'")} from ({CHANGED_TURNS})
union all {finding(DATA, "'EXTRA_IN_SOURCE'", "count(*)")} from (select distinct conv_id from conversations where turn is not null and conv_id % 23 = 5)
) where n > 0"""
ORACLES["declared_key_outside"] = changed_cells("c0", [
    ("c_nationkey", f"({sql('customer_positions')})", "c1 % 41 = 3", "cast(c_nationkey as varchar)", "cast(c_nationkey + 1 as varchar)"),
]) + " union all " + finding(DATA, "'KEY_NOTE'", severity="'info'", column="'C1'", target="cast(null as varchar)",
                             sv="'declared key is outside the compared columns'")


def report_row(check, result, reason, source="ORDERS", target="ORDERS_CHANGED"):
    return (f"select '{source}' as source_table, '{target}' as target_table, '{check}' as \"Validation_type\", "
            f"{result} as \"Validation_Result\", {reason} as \"Reason\"")


SHOWN = {"o_custkey": "O_Custkey", "o_orderstatus": "O_Orderstatus", "o_totalprice": "O_Totalprice",
         "o_orderdate": "O_Orderdate", "o_orderpriority": "O_Orderpriority"}
ORACLES["full_report"] = f"""
{JOINED}, m as (
  {per_column(OC, lambda i, c: f"select {i} as o, '{SHOWN[c]}' as shown, count(*) as n from j where {differs(c)}")}),
x as (select (select count(*) from s) as sc, (select count(*) from t) as tc,
             (select count(*) from j where not in_target) as only_s, (select count(*) from j where not in_source) as only_t,
             (select string_agg(shown || ' = ' || n, ', ' order by o) from m where n > 0) as diffs),
v as (select *, case when only_s + only_t > 0 or diffs is not null then 'Fail' else 'Pass' end as dv from x)
{report_row('Count validation', "case when sc = tc then 'Pass' else 'Fail' end", "'source count = ' || sc || ', target count = ' || tc")} from v
union all {report_row('Data Validation', "dv", "only_s || ' extra records in source'")} from v where only_s > 0
union all {report_row('Data Validation', "dv", "only_t || ' extra records in target'")} from v where only_t > 0
union all {report_row('Data Validation', "dv", "'mismatch count by column: ' || diffs")} from v where diffs is not null
union all {report_row('Datatype Validation', "'Pass'", "''")}
union all {report_row('Duplicate Validation', "'Pass'", "''")}"""

COUNTED = f"""{JOINED}, x as (
  select (select count(*) from j where not in_target) as only_s, (select count(*) from j where not in_source) as only_t,
         (select count(*) from s) as sc, (select count(*) from t) as tc),
m as ({per_column(OC, lambda i, c: f"select count(*) as n from j where {differs(c)}")})"""


def data_row_count(samples):
    return (f"(select (only_s > 0)::bigint + (only_t > 0)::bigint from x) + (select (sum(n) > 0)::bigint from m) "
            f"+ (select sum(least(n, {samples}))::bigint from m)")


def changed_label(c):
    return f"""count(*) filter ({boolean_text('a.' + c)} is distinct from {boolean_text('b.' + c)})"""


DUPLICATE_REASONS = {
    "DUPLICATES_EQUAL": "'warning: ' || n || ' duplicate records are the same on both sides'",
    "DUPLICATES_PARTIAL": "'warning: ' || n || ' duplicate records are partially loaded'",
    "DUPLICATES_EXTRA_LOADED": "n || ' duplicate records are loaded too often'",
    "DUPLICATES_ONLY_SOURCE": "n || ' duplicate records did not reach target'",
    "DUPLICATES_ONLY_TARGET": "n || ' duplicate records exist only in target'",
}
ORACLES["duplicate_report"] = f"""
{GROUPS}, n as (select code, count(*) as n from g group by code)
{report_row('Duplicate Validation', "'Fail'",
            'case code ' + ' '.join(f"when '{c}' then {r}" for c, r in DUPLICATE_REASONS.items()) + ' end', 'S', 'T')} from n"""


def passed(checks, source, target, table):
    """Report rows of a pair without any difference."""
    count = f"(select 'source count = ' || count(*) || ', target count = ' || count(*) from {table})"
    return [report_row(c, "'Pass'", count if c == "Count validation" else "''", source, target) for c in checks]


FILE_CHECKS = ("Count validation", "Data Validation", "Duplicate Validation")
ORACLES["truncation_report"] = " union all ".join(
    passed(FILE_CHECKS, "S", "T", "customer")
    + [report_row("Datatype Validation", "'Pass'", "'warning: values may be truncated in C_Custkey'", "S", "T")])


def failed_data(source, target, counts):
    """The data row of a pair that differs in the counted columns only (name -> number)."""
    shown = ", ".join(f"case when {n} > 0 then '{name} = ' || {n} end" for name, n in counts.items())
    some = " + ".join(counts.values())
    return report_row("Data Validation", f"case when {some} > 0 then 'Fail' else 'Pass' end",
                      f"case when {some} > 0 then 'mismatch count by column: ' || concat_ws(', ', {shown}) else '' end", source, target)


def not_read(source, target, reason):
    return report_row("Data Validation", "'Fail'", f"'{reason}'", source, target)


LABEL_PAIR = ("labels.parquet", "TL_LABELS_TEXT")
NAME_PAIR = ("TL_CUSTOMER_RENAMED", "TL_CUSTOMER")
MANIFEST_ROWS = (
    passed(("Count validation", "Duplicate Validation"), *LABEL_PAIR, "labels")
    + [f"select * from ({failed_data(*LABEL_PAIR, {'Quality': 'q', 'Toxic': 'x'})} from l)"]
    + passed(FILE_CHECKS, "customer.parquet", "customer.parquet", "customer")
    + passed(FILE_CHECKS, "TL_ORDERS", "orders.parquet", "orders")
    + passed(("Count validation", "Datatype Validation", "Duplicate Validation"), *NAME_PAIR, "customer")
    + [f"select * from ({failed_data(*NAME_PAIR, {'Title': 'n'})} from r)",
       not_read("TL_LABELS", "nothing.parquet", "FILE_NOT_FOUND"), not_read("TL_NOTHING", "labels.parquet", "TABLE_NOT_FOUND")]
)
ORACLES["manifest_report"] = f"""
with l as (
  select {changed_label('quality')} as q, {changed_label('toxic')} as x
  from labels a join ({sql('labels_text')}) b on cast(a.doc_id as varchar) = b.doc_id),
r as (select count(*) as n from customer where c_custkey % 41 = 3 and upper(c_name) <> c_name),
o as ({ORACLES['full_report'].replace("'ORDERS'", "'TL_ORDERS'").replace("'ORDERS_CHANGED'", "'TL_ORDERS_CHANGED'")})
select source_table as source, target_table as target, "Validation_type" as check_name, "Validation_Result" as result, "Reason" as reason
from (select * from o union all {' union all '.join(MANIFEST_ROWS)})"""

ORACLES["report_sinks"] = f"""
{COUNTED}, r as (
  select 'Count validation' as check_name, case when sc = tc then 'Pass' else 'Fail' end as result, 1::bigint as n from x
  union all select 'Data Validation', 'Fail', {data_row_count(1)}
  union all select 'Datatype Validation', 'Pass', 1
  union all select 'Duplicate Validation', 'Pass', 1)
select sink, check_name, result, (n * copies)::bigint as report_rows
from r, (select 'csv' as sink, 2 as copies union all select 'parquet', 1)"""
ORACLES["resumed_report"] = ORACLES["manifest_report"]
