"""The operators' queries over whole tables, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    codebooks, exact_dedup, licenses, minhash_dedup, mixing, packing, pivots, sketches, surrogates, tool_calls, topk, toxicity, url_filter, vectors,
)
from tidemark.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))


TOOLS = [
    tool_calls.Tool("search", {"query": "string", "limit": "integer"}, frozenset({"query"})),
    tool_calls.Tool("calculate", {"values": "array", "operation": "string", "note": "string"}, frozenset({"values", "operation"})),
    tool_calls.Tool("fetch", {"url": "string", "retries": "integer", "options": "object"}, frozenset({"url"})),
]


def tool_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as tool chats, as the table holds none.

    Each assistant turn becomes a call that waits for the assistant turn before it and the one before that, each later user turn a result of the turn before
    it. Ids start again every four turns, so what is meant is the latest call of an id; a call in turn 2 waits for one that is not there. The whole text is an argument of the call, or a part of one; its length decides the tool, and which arguments are missing, of a wrong type or unknown. All other
    rows go along as they are: null texts in the roles of calls and results, other roles, and first user turns.
    """
    size, turn = F.length("text"), F.col("turn")
    call_id = lambda back: F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), F.pmod(turn - back, F.lit(4)))
    said = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    search = F.to_json(F.struct(F.col("text").alias("query"), (size % 50).alias("limit")))
    numbers = F.when(size % 7 == 0, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(F.concat(F.lit("[ "), size, F.lit(", "), turn, F.lit(" ]")))
    calculate = F.concat(F.lit('{"values": '), numbers, F.lit(', "operation": "sum", "note": '), said, F.lit("}"))
    fetch = F.concat(
        F.lit('{"retries": '), turn, F.lit(', "options": {"zip": true, "title": '), said, F.lit(', "accept": ["text", null]}'),
        F.when(size % 5 == 0, "").otherwise(F.concat(F.lit(', "url": "https://example.com/'), size, F.lit('"'))),
        F.when(size % 11 == 0, ', "extra": null').otherwise(""), F.lit("}"))
    arguments = F.when(size % 3 == 0, search).when(size % 3 == 1, calculate).otherwise(fetch)
    name = F.when(size % 3 == 0, "search").when(size % 3 == 1, "calculate").otherwise("fetch")
    missing = F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-none"))
    after = F.when(turn >= 5, F.array(call_id(2), call_id(4))).when(turn >= 3, F.array(call_id(2))).when(turn == 2, F.array(missing))
    call = F.struct(call_id(0).alias("id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    result = F.struct(call_id(1).alias("tool_call_id"), F.col("text").alias("content"))
    chats = table(spark, folder, "conversations")
    is_call = F.coalesce(F.expr("text is not null and role = 'assistant'"), F.lit(False))
    is_result = F.coalesce(F.expr("text is not null and role = 'user' and turn > 0"), F.lit(False))
    as_call = chats.where(is_call).select("conv_id", "turn", "role", F.to_json(F.struct(F.array(call).alias("tool_calls"))).alias("text"))
    as_result = chats.where(is_result).select("conv_id", "turn", F.lit("tool").alias("role"), F.to_json(result).alias("text"))
    role = F.when(F.expr("text is null and role = 'user' and turn > 0"), "tool").otherwise(F.col("role")).alias("role")
    others = chats.where(~is_call & ~is_result).select("conv_id", "turn", role, "text")
    return as_call.unionByName(as_result).unionByName(others)


@query("""
with recursive chats as (select *, length(text) n from conversations where text is not null),
calls as (select conv_id, turn, 'call-' || conv_id || '-' || turn % 4 id, row_number() over (partition by conv_id, turn % 4 order by turn) nth, n,
    case n % 3 when 0 then 'search' when 1 then 'calculate' else 'fetch' end as name,
    case n % 3 when 0 then '{"limit":' || n % 50 || ',"query":' || to_json(text) || '}'
               when 1 then '{"note":' || to_json(text) || ',"operation":"sum","values":' || case when n % 7 = 0 then '"' || n || '"' else '[' || n || ',' || turn || ']' end || '}'
               else '{' || case when n % 11 = 0 then '"extra":null,' else '' end || '"options":{"accept":["text",null],"title":' || to_json(text) || ',"zip":true},"retries":' || turn
                    || case when n % 5 = 0 then '' else ',"url":"https://example.com/' || n || '"' end || '}' end as arguments,
    case when n % 3 = 1 and n % 7 = 0 then 'type:values'
         when n % 3 = 2 then concat_ws(',', case when n % 5 = 0 then 'missing:url' end, case when n % 11 = 0 then 'unknown:extra' end) else '' end errors
    from chats where role = 'assistant'),
asked as (select conv_id, turn, unnest(case when turn >= 5 then [2, 4] when turn >= 3 then [2] when turn = 2 then [3] else [] end) back from calls),
waits as (select a.conv_id, a.turn, a.back, max(p.turn) as parent from asked a left join calls p on p.conv_id = a.conv_id and p.turn < a.turn and p.turn % 4 = (a.turn - a.back) % 4 group by all),
steps as (select conv_id, turn, 0 as level from calls c where not exists (select 1 from waits w where w.conv_id = c.conv_id and w.turn = c.turn and w.parent is not null)
          union select w.conv_id, w.turn, d.level + 1 from waits w join steps d on d.conv_id = w.conv_id and d.turn = w.parent),
depth as (select conv_id, turn, max(level) as level from steps group by all),
met as (select conv_id, turn, count(parent) = count(*) waits_for from waits group by all),
given as (select r.conv_id, r.turn, 'call-' || r.conv_id || '-' || (r.turn - 1) % 4 id, r.text as content, max(c.turn) as of_turn
          from chats r left join calls c on c.conv_id = r.conv_id and c.turn < r.turn and c.turn % 4 = (r.turn - 1) % 4 where r.role = 'user' and r.turn > 0 group by all),
results as (select conv_id, id, of_turn, min(turn) as turn, arg_min(content, turn) as content, count(*) as results from given group by all),
j as (select coalesce(c.conv_id, r.conv_id) conv_id, coalesce(c.id, r.id) call_id, c.nth, c.name, c.turn, c.arguments, c.errors, d.level, r.turn result_turn, r.results,
    case when c.id is null then 'orphan_result' when r.id is null then 'no_result' else 'linked' end status, m.waits_for,
    '{' || concat_ws(',', '"arguments":' || c.arguments, '"id":' || to_json(coalesce(c.id, r.id)), '"name":' || to_json(c.name), '"result":' || to_json(r.content)) || '}' record
    from calls c full join results r on c.conv_id = r.conv_id and c.turn = r.of_turn left join depth d on d.conv_id = c.conv_id and d.turn = c.turn
    left join met m on m.conv_id = c.conv_id and m.turn = c.turn)
select conv_id, call_id, nth, name, turn, status, waits_for, level::bigint as level, arguments, coalesce(errors, '') as errors, result_turn,
       coalesce(results, 0)::bigint as results, sha256(record) record_sha256 from j
""")
def op2_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    linked = tool_calls.link_tool_calls(tool_messages(spark, folder), TOOLS)
    return linked.select(*[F.concat_ws(",", c).alias(c) if c == "errors" else F.sha2(c, 256).alias("record_sha256") if c == "record" else c for c in linked.columns])


@query("""
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id vec_id, list_inner_product(q.e, c.e)::bigint score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
""")
def op3_threshold_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.numbered(topk.scaled(table(spark, folder, "embeddings").select("vec_id", "embedding")))
    return topk.top_k(vectors, vectors.where("id % 100 = 0"), k=10)


URL_RULES = [
    url_filter.rule("allow", "org/"), url_filter.rule("block", "example.org/es/"), url_filter.rule("block", "example.org/en/1"),
    url_filter.rule("allow", "com/fr/"), url_filter.rule("block", "com/de/"),
]


@query("""
with rules(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest as (select page_id, case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end r from pages),
parts as (select page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) path from rest),
fits as (select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as verdict
         from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule, coalesce(verdict, 'allow') as verdict
from parts left join fits using (page_id)
""")
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    lexicon = toxicity.learn(docs, table(spark, folder, "labels").where(~held_out))
    found, verdict = toxicity.scored(docs.select("doc_id", "text"), lexicon)
    return found.select(
        "doc_id", held_out.alias("held_out"), verdict["score"].alias("score"), (verdict["score"] >= 0.7).cast("int").alias("predicted"),
        verdict["hits"].alias("hits"))


@query("""
with t as (select doc_id, length(coalesce(text, '')) n,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) h from documents),
w as (select doc_id, h, count(*) over (partition by h) c, first_value(doc_id) over (partition by h order by n desc, doc_id) k from t)
select doc_id, k as keep_id, c::bigint as group_size, doc_id = k as kept, h as text_sha256 from w
""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op7_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents").select("doc_id", "text", "source"))


@query()
def op8_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    sequences = packing.with_checksum(packing.packed(table(spark, folder, "documents").select("doc_id", "text"), marks=True))
    return sequences.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


#: Only to keep this query repeatable: a real key is a secret of whoever runs the replacement.
PII_KEY = b"query key"


@query()
def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    found = surrogates.replaced(table(spark, folder, "documents").select("doc_id", "text"), PII_KEY)
    return found.select("_row.doc_id", "_row.text", F.size("_found").alias("entities"))


def _finite(scale: int) -> str:
    return f"""select *, list_transform(embedding, lambda x: floor({scale} * x::double)) v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""


def _floored(total: str, count: str) -> str:
    """Integer division that goes down."""
    return f"(({total} - (({total} % {count}) + {count}) % {count}) // {count})"


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, width: int = 8, scale: int = 4096) -> str:
    """Full scans of all entries in every round, one step of the WITH list each."""
    steps = [f"x as materialized (select vec_id, label, p, v[p * {width} + 1:p * {width} + {width}] v from ({_finite(scale)}) e, range({parts}) r(p))",
             f"b0 as materialized (select p, row_number() over (partition by p order by vec_id) - 1 k, v from x "
             f"qualify row_number() over (partition by p order by vec_id) <= {entries})"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (select vec_id, any_value(label) as label, p, any_value(x.v) v,
    min((list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v) + list_inner_product(b.v, b.v))::bigint * {entries} + k) m
    from x join b{r} b using (p) group by vec_id, p)""")
        if r < rounds:
            steps.append(f"""s{r} as materialized (select p, m % {entries} k, i, sum(v[i])::bigint s, count(*) n from a{r}, range(1, {width + 1}) t(i) group by all)""")
            steps.append(f"""b{r + 1} as materialized (select b.p, b.k, coalesce(any_value(u.v), any_value(b.v)) v from b{r} b left join
    (select p, k, list(({_floored('s', 'n')})::double order by i) v from s{r} group by p, k) u on u.p = b.p and u.k = b.k group by b.p, b.k)""")
    last = f"""books as (select sha256(string_agg(v[i]::bigint::varchar, ',' order by p, k, i)) h from b{rounds}, range(1, {width + 1}) t(i)),
rows_of as (select vec_id, any_value(label) as label, string_agg(printf('%02x', (m % {entries})::int), '' order by p) code, sum(m // {entries})::bigint as error from a{rounds} group by vec_id)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h codebooks_sha256 from rows_of, books"""
    return "with " + ",\n".join(steps) + ",\n" + last


@query(codes_sql())
def op11_active_entry_codes(spark: SparkSession, folder: str) -> DataFrame:
    found, books = codebooks.compress(table(spark, folder, "embeddings").select("vec_id", "label", "embedding"))
    rows = found.select("row.vec_id", "row.label", F.lower(F.hex("codes")).alias("code"), "error")
    totals = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def clusters_sql(count: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, seed: str = "2:") -> str:
    steps = [f"x as materialized (select vec_id, v from ({_finite(scale)}) e where len(v) = {width})",
             f"c0 as materialized (select row_number() over (order by sha256('{seed}' || vec_id)) - 1 k, v from x order by k limit {count})"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (select vec_id, any_value(x.v) v,
    min((list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, c.v) + list_inner_product(c.v, c.v))::bigint * {count} + k) m from x, c{r} c group by vec_id)""")
        if r < rounds:
            steps.append(f"s{r} as materialized (select m % {count} k, i, sum(v[i])::bigint s, count(*) n from a{r}, range(1, {width + 1}) t(i) group by all)")
            steps.append(f"""c{r + 1} as materialized (select c.k, coalesce(any_value(u.v), any_value(c.v)) v from c{r} c left join
    (select k, list(({_floored('s', 'n')})::double order by i) v from s{r} group by k) u on u.k = c.k group by c.k)""")
    last = f"""names as (select k, sha256(string_agg(v[i]::bigint::varchar, ',' order by i)) h from c{rounds}, range(1, {width + 1}) t(i) group by k)
select vec_id, (m % {count})::int as cluster, m // {count} as distance, (sum(m // {count}) over (partition by m % {count}))::bigint cluster_inertia,
    (sum(m // {count}) over ())::bigint inertia, h centroid_sha256 from a{rounds} join names on k = m % {count}"""
    return "with " + ",\n".join(steps) + ",\n" + last


@query(clusters_sql())
def op12_laesa_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found, clusters = pivots.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    rows = stored(found)
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    each = [sums.get(k, 0) for k in range(len(clusters.centroids))]
    number = F.col("cluster")
    return rows.select(
        "row.vec_id", number, "distance", vectors.by_number(number, each).cast("long").alias("cluster_inertia"),
        F.lit(sum(each)).cast("long").alias("inertia"), vectors.by_number(number, clusters.sha256).cast("string").alias("centroid_sha256"))


@query()
def op13_scaled_sketches(spark: SparkSession, folder: str) -> DataFrame:
    found = sketches.beside_edited(table(spark, folder, "documents").select("doc_id", "text"))
    own, edited, following = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", F.col("edited").alias("edited_sha256"), own, edited,
        sketches.containment(own, edited).alias("near_edited"), sketches.containment(own, following).alias("near_next"))
