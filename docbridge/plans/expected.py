"""Expected answers: for each query of the catalogue that SQL can express, the SQL that DuckDB runs on the same tables."""

ORACLE_SQL: dict[str, str] = {
    "action_index": r"""
select cast(json_object('index',json_object('_index','customer','_id',cast(c_custkey as varchar))) as varchar)||chr(10)||cast(json_object('c_custkey',c_custkey,'c_name',c_name,'c_nationkey',c_nationkey,'c_acctbal',c_acctbal,'c_mktsegment',c_mktsegment) as varchar) line from customer
""",
    "action_create": r"""
select cast(json_object('create',json_object('_index','orders','_id',cast(o_orderkey as varchar))) as varchar)||chr(10)||cast(json_object('o_orderkey',o_orderkey,'o_custkey',o_custkey,'o_orderstatus',o_orderstatus,'o_totalprice',o_totalprice,'o_orderdate',(epoch_us(o_orderdate)//1000),'o_orderpriority',o_orderpriority) as varchar) line from orders
""",
    "action_delete_routing": r"""
select case when o_orderstatus='F' then cast(json_object('delete',json_object('_index','orders','_id',cast(o_orderkey as varchar))) as varchar) else cast(json_object('index',json_object('_index','orders','_id',cast(o_orderkey as varchar))) as varchar)||chr(10)||cast(json_object('o_orderkey',o_orderkey,'o_custkey',o_custkey,'o_orderstatus',o_orderstatus,'o_totalprice',o_totalprice,'o_orderdate',(epoch_us(o_orderdate)//1000),'o_orderpriority',o_orderpriority) as varchar) end line from orders
""",
    "action_autoid": r"""
select cast(json_object('index',json_object('_index','nation')) as varchar)||chr(10)||cast(json_object('n_nationkey',n_nationkey,'n_name',n_name,'n_regionkey',n_regionkey) as varchar) line from nation
""",
    "drop_fields": r"""
select cast(json_object('c_custkey',c_custkey,'c_name',c_name,'c_mktsegment',c_mktsegment) as varchar) src from customer
""",
    "ntz_epoch_floor": r"""
select event_id,(epoch_us(ts)//1000) ms from events
""",
    "date_epoch": r"""
select l_orderkey,cast(l_shipdate::date-date '1970-01-01' as bigint)*86400000 ms from lineitem
""",
    "nested_temporal": r"""
select event_id,cast(json_object('s',json_object('t',(epoch_us(ts)//1000)),'a',[(epoch_us(ts)//1000),(epoch_us(ts)//1000)+86400000],'m',json_object('k',(epoch_us(ts)//1000))) as varchar) j from events
""",
    "nonfinite_to_null": r"""
select event_id,case when event_id%7=0 or event_id%11=0 then null else value end v from events
""",
    "null_fields_kept": r"""
select cast(json_object('o_orderkey',o_orderkey,'st',nullif(o_orderstatus,'F')) as varchar) j from orders
""",
    "binary_base64": r"""
select c_custkey,to_base64(encode(repeat(c_name,6))) b from customer
""",
    "float_short_repr": r"""
with e as (select vec_id,generate_subscripts(embedding,1)-1 i,unnest(embedding) f from embeddings),
p as (select *,case when f<0 then '-' else '' end g,cast(abs(f) as varchar) s from e),
q as (select *,ltrim(replace(split_part(s,'e',1),'.',''),'0') d,case when contains(s,'e') then cast(split_part(s,'e',2) as int) else -(length(s)-1-length(ltrim(substr(s,3),'0'))) end x from p)
select vec_id,cast(i as int) i,case when abs(f)>=0.001 or f=0 then cast(f as varchar) else g||d[1]||'.'||(case when length(d)=1 then '0' else d[2:] end)||'E'||x end f from q
""",
    "variant_to_string": r"""
select event_id,cast(json_object('k',cast(props::json->>'$.k' as int)) as varchar) p from events
""",
    "interval_to_string": r"""
select event_id,'INTERVAL '''||(event_id%5+1)||' 02:03:04'' DAY TO SECOND' i from events
""",
    "array_of_struct": r"""
select conv_id,cast(json_object('conv_id',conv_id,'turns',list({'turn':turn,'role':role,'text':text} order by turn,role,text)) as varchar) j from conversations group by conv_id
""",
    "chunking": r"""
with t as (select o_orderkey//4000 part,(row_number() over(partition by o_orderkey//4000 order by o_orderkey)-1)//500 c,o_orderkey from orders) select part,cast(c as bigint) chunk,count(*) docs,min(o_orderkey) lo,max(o_orderkey) hi from t group by part,c
""",
    "upsert_last_write_wins": r"""
select id,l_partkey,l_suppkey,l_quantity from (select concat(cast(l_orderkey as varchar),'-',cast(l_linenumber as varchar)) id,l_partkey,l_suppkey,l_quantity,row_number() over(partition by l_orderkey,l_linenumber order by l_shipdate desc,l_partkey desc,l_suppkey desc,l_quantity desc,l_extendedprice desc) rn from lineitem) t where rn=1
""",
    "create_dedup": r"""
with e as (select o_orderkey from orders where o_orderkey%3=0) select case when e.o_orderkey is null then 'written' else 'ignored' end outcome,count(*) n from orders o left join e on o.o_orderkey=e.o_orderkey group by 1
""",
    "delete_404_noop": r"""
with del as (select o_orderkey+(case when o_orderkey%4=0 then 100000000 else 0 end) id from orders) select case when o.o_orderkey is null then 'ignored' else 'deleted' end outcome,count(*) n from del left join orders o on o.o_orderkey=del.id group by 1
""",
    "classify": r"""
select op,st,case when st between 200 and 299 then case when op='delete' then 'deleted' else 'written' end when op='delete' and st=404 then 'ignored' when op='create' and st=409 then 'ignored' else 'error' end outcome,count(*) n from (select event_id,user_id,case event_id%3 when 0 then 'index' when 1 then 'create' else 'delete' end op,case event_id%7 when 0 then 200 when 1 then 201 when 2 then 404 when 3 then 409 when 4 then 429 when 5 then 400 else 503 end st from events) r group by 1,2,3
""",
    "reject_buckets": r"""
select case when st=429 then 'rejected_429' when st=409 then 'rejected_409' when st between 400 and 499 then 'rejected_4xx_other' else 'rejected_5xx' end bucket,count(*) n from (select event_id,user_id,case event_id%3 when 0 then 'index' when 1 then 'create' else 'delete' end op,case event_id%7 when 0 then 200 when 1 then 201 when 2 then 404 when 3 then 409 when 4 then 429 when 5 then 400 else 503 end st from events) r where not(st between 200 and 299) and case when st between 200 and 299 then case when op='delete' then 'deleted' else 'written' end when op='delete' and st=404 then 'ignored' when op='create' and st=409 then 'ignored' else 'error' end<>'ignored' group by 1
""",
    "retry_budget": r"""
select case when k<=3 then 'written' else 'error' end outcome,count(*) n,cast(sum(least(k,3)) as bigint) docs_retried from (select event_id%6 k from events) t group by 1
""",
    "merge_signed": r"""
with p as (select user_id%8 part,count(*)+(case when user_id%8=1 then 5 else 0 end) total,sum(case when case when st between 200 and 299 then case when op='delete' then 'deleted' else 'written' end when op='delete' and st=404 then 'ignored' when op='create' and st=409 then 'ignored' else 'error' end='written' then 1 else 0 end) w,sum(case when case when st between 200 and 299 then case when op='delete' then 'deleted' else 'written' end when op='delete' and st=404 then 'ignored' when op='create' and st=409 then 'ignored' else 'error' end='deleted' then 1 else 0 end) d,sum(case when case when st between 200 and 299 then case when op='delete' then 'deleted' else 'written' end when op='delete' and st=404 then 'ignored' when op='create' and st=409 then 'ignored' else 'error' end='ignored' then 1 else 0 end) i,sum(case when case when st between 200 and 299 then case when op='delete' then 'deleted' else 'written' end when op='delete' and st=404 then 'ignored' when op='create' and st=409 then 'ignored' else 'error' end='error' then 1 else 0 end)+(case when user_id%8=2 then 5 else 0 end) e from (select event_id,user_id,case event_id%3 when 0 then 'index' when 1 then 'create' else 'delete' end op,case event_id%7 when 0 then 200 when 1 then 201 when 2 then 404 when 3 then 409 when 4 then 429 when 5 then 400 else 503 end st from events) r group by user_id%8) select cast(sum(total) as bigint) total_input,cast(sum(w) as bigint) written,cast(sum(d) as bigint) deleted,cast(sum(i) as bigint) ignored,cast(sum(e) as bigint) errors,cast(sum(greatest(total-w-d-i-e,0)) as bigint) unaccounted,cast(sum(greatest(w+d+i+e-total,0)) as bigint) overcounted from p
""",
    "error_samples": r"""
select part,event_id,op,st from (select *,row_number() over(partition by part order by event_id) rn from (select event_id,event_id//4000 part,case event_id%3 when 0 then 'index' when 1 then 'create' else 'delete' end op,case event_id%7 when 0 then 200 when 1 then 201 when 2 then 404 when 3 then 409 when 4 then 429 when 5 then 400 else 503 end st from events) r where st>=300 and not(op='delete' and st=404) and not(op='create' and st=409)) t where rn<=20
""",
    "send_stats": r"""
select event_id//4000 part,count(*) n,cast(sum(user_id) as bigint) bytes,round(sum(value),2) busy,round(quantile_cont(value,0.5),6) p50,round(quantile_cont(value,0.95),6) p95,round(max(value),6) max from events where value is not null group by 1
""",
    "slice_cover": r"""
select event_id%5 slice,count(*) n,cast(sum(event_id) as bigint) s from events group by 1
""",
    "paging": r"""
with t as (select event_id//4000 part,event_id%3 sl,(row_number() over(partition by event_id//4000,event_id%3 order by event_id)-1)//1000 pg,event_id from events) select part,sl,cast(pg as bigint) pg,count(*) n,max(event_id) search_after from t group by part,sl,pg
""",
    "dsl_bool": r"""
select event_id,event_type,value from events where event_type='error' and value>=5 and value<50 and not(user_id in (1,2,3))
""",
    "typed_roundtrip": r"""
select o_orderkey,o_custkey,o_orderstatus,o_totalprice,date_trunc('millisecond',o_orderdate) o_orderdate,o_orderpriority from orders
""",
    "bool_parse": r"""
with t as (select event_id,case event_id%6 when 0 then ' TRUE ' when 1 then 'y' when 2 then 'No' when 3 then '0' when 4 then 'maybe' else '' end sv from events) select event_id,case when lower(trim(sv)) in ('true','t','1','yes','y') then 'true' when lower(trim(sv)) in ('false','f','0','no','n') then 'false' else 'mismatch' end r from t
""",
    "int_width_guard": r"""
select l_orderkey,l_linenumber,case when v<>floor(v) then 'not_integer' when v not between -32768 and 32767 then 'out_of_range' else 'ok' end r from (select l_orderkey,l_linenumber,case when l_linenumber%2=0 then l_extendedprice else l_quantity*l_partkey end v from lineitem) t
""",
    "scalar_as_array": r"""
select event_id,cast(case when event_id%2=0 then 1 else 2 end as int) n from events
""",
    "cdc_latest": r"""
select user_id,event_id,event_type='error' as is_delete from (select *,row_number() over(partition by user_id order by ts desc nulls last,event_id desc) rn from events) t where rn=1
""",
    "source_vs_indexed": r"""
select event_type,round(sum(value),2) src_sum,cast(sum(cast(trunc(value) as bigint)) as bigint) idx_sum from events group by event_type
""",
    "ignore_above": r"""
select lang,cast(sum(case when length(text)>256 then 1 else 0 end) as bigint) not_indexed,count(*) n from documents group by lang
""",
    "external_version": r"""
with old as (select user_id,max(ts) v from events where event_id%2=0 group by user_id), inc as (select user_id,max(ts) v from events where event_id%2=1 group by user_id) select inc.user_id,case when old.user_id is null or inc.v>=old.v then 'written' else 'conflict' end outcome from inc left join old on inc.user_id=old.user_id
""",
    "index_roundtrip": r"""
select o_orderkey,o_custkey,o_orderstatus,o_totalprice,date_trunc('millisecond',o_orderdate) o_orderdate,o_orderpriority from orders
""",
    "store_lifecycle": r"""
select o_orderkey,o_custkey,o_orderstatus,o_totalprice,date_trunc('millisecond',o_orderdate) o_orderdate,o_orderpriority from orders where o_orderstatus not in ('F','O')
""",
    "streaming_sink": r"""
select * from nation
""",
    "ship_accounting": r"""
select count(*) total_input,count(*) written,cast(0 as bigint) deleted,cast(0 as bigint) ignored,cast(0 as bigint) errors,cast(0 as bigint) unaccounted,cast(0 as bigint) overcounted,cast(count(*) filter (o_orderkey%10=0) as bigint) docs_retried,cast(count(*) filter (o_orderkey%10=0) as bigint) rejected_429 from orders
""",
    "external_version_sink": r"""
select user_id,date_trunc('millisecond',max(ts)) ts from events group by user_id
""",
}
