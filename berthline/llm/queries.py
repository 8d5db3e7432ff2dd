"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from berthline.llm import ann, chat, decontam, langid, negatives, packing, pii, prefix_trie, secret_scan, sharding, simhash, toxicity, url_rules
from berthline.llm.base import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(run: Query) -> Query:
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


SHARD_BYTES = 64 << 20
# A limit that small tables reach, so that buckets split.
SMALL_SHARD_BYTES = 64 << 10

_CONVERSATIONS = """
conversations_and_planted as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
"""


@_query("op1_extendible_shards", sharding.oracle(SHARD_BYTES))
def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES, key=["source"], spread=["doc_id"])


@_query("small_shards", sharding.oracle(SMALL_SHARD_BYTES))
def _small_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards under a limit that splits buckets at any size of the table."""
    return sharding.shard(table(spark, sf_dir, "documents"), SMALL_SHARD_BYTES, key=["source"], spread=["doc_id"])


@_query("op2_multi_index_neighbours")
def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"))
    return ann.neighbours(vectors, asked, k=20)


@_query("op3_secret_scan")
def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


@_query("op4_language_id")
def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(table(spark, sf_dir, "documents"))


@_query("op5_personal_data")
def _personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_query(
    "op6_chat_format",
    f"""
with {_CONVERSATIONS},
placed as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before from conversations_and_planted),
measured as (
  select *, case when before = role then {len(chat.NEXT)}
      else {len(chat.OPEN + chat.TEXT + chat.CLOSE)} + length(regexp_replace(replace(role, '\\', '\\\\'), '({chat._CONTROL})', '\\\\\\1', 'g')) end as markup,
    length(regexp_replace(replace(text, '\\', '\\\\'), '({chat._CONTROL})', '\\\\\\1', 'g')) as body
  from placed)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast({len(chat.BEGIN + chat.FINISH)} + sum(markup + body) as bigint) as formatted_chars
from measured group by conv_id
""",
)
def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], told.schema)
    return chat.digests(chat.format_chats(told.unionByName(planted)))


@_query("op7_toxicity")
def _toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query(
    "op8_decontamination",
    f"""
with item_words as (
  select distinct coalesce(cast(item_id as varchar), 'null') as item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{decontam.WORD}') as words from benchmark),
windows as (
  select distinct item_id, least(len(words), {decontam.WINDOW}) as size,
    array_to_string(words[s:s + least(len(words), {decontam.WINDOW}) - 1], ' ') as gram
  from item_words, unnest(range(1, greatest(len(words) - {decontam.WINDOW}, 0) + 2)) as t(s) where len(words) > 0),
doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{decontam.WORD}') as words
  from documents),
grams as (
  select doc_id, size, s, array_to_string(words[s:s + size - 1], ' ') as gram
  from doc_words, (select distinct size from windows), unnest(range(1, len(words) - size + 2)) as t(s) where len(words) >= size),
hits as (select doc_id, item_id, s, size from grams join windows using (size, gram)),
hit_words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(s, s + size)) as t(p) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as listed
  from (select distinct doc_id, item_id from hits) group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from doc_words left join hit_words using (doc_id) left join items using (doc_id)
""",
)
def _contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digests(found)


@_query("op9_best_fit_packing")
def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), near_copies=True)


@_query("op10_simhash_groups")
def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    return found.select("doc_id", simhash.fingerprint_hex(found["fp"]).alias("fingerprint"), "component_id")


@_query(
    "op11_hard_negatives",
    """
with parts as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * cast(x as double)) for x in embedding] as c
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
  select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id, cast(list_dot_product(a.c, r.c) as bigint) as score
  from parts a join parts r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
""",
)
def _negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query(
    "op12_url_filter",
    f"""
with given(rule_host, rule_path, rule_verdict) as (values {", ".join(map(str, URL_RULES))}),
cut as (
  select url, [{", ".join(f"regexp_extract(url, '{url_rules.URL}', {n})" for n in range(1, 6))}] as part, url like '%://%' as whole
  from (select distinct url from pages where url is not null)),
lowered as (
  select url, translate(part[2], '{url_rules.UPPER}', '{url_rules.LOWER}') as host, part[3] as path,
    list_distinct(case when whole then ['s:' || x for x in [translate(part[1], '{url_rules.UPPER}', '{url_rules.LOWER}')] if x <> '']
      || ['h:' || x for x in string_split(translate(part[2], '{url_rules.UPPER}', '{url_rules.LOWER}'), '.') if x <> '']
      || ['p:' || x for x in string_split(part[3], '/') if x <> ''] || ['q:' || x for x in string_split(part[4], '&') if x <> '']
      || ['f:' || x for x in [part[5]] if x <> ''] else [] end) as tokens
  from cut),
fitting as (
  select url, rule_host || rule_path as rule, rule_verdict from lowered join given
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  qualify row_number() over (partition by url order by length(rule) desc, rule desc, rule_verdict desc) = 1),
urls as (select * from lowered left join fitting using (url)),
totals as (
  select count(*) as total, count(*) filter (rule_verdict = 'block') as blocked, count(*) filter (rule_verdict = 'allow') as allowed,
    greatest({url_rules.LEAST_URLS}, cast(ceil(count(*) * {url_rules.LEAST_PER_MILLE} / 1000.0) as bigint)) as least from urls),
each as (select url, rule_verdict, unnest(tokens) as token from urls),
frequent as (
  select token, greatest(
      case when any_value(blocked) > 0 then abs(cast(count(*) filter (rule_verdict = 'block') as double) * any_value(total) - cast(count(*) as double) * any_value(blocked)) end,
      case when any_value(allowed) > 0 then abs(cast(count(*) filter (rule_verdict = 'allow') as double) * any_value(total) - cast(count(*) as double) * any_value(allowed)) end) as telling
  from each, totals group by token having count(*) >= any_value(least)),
transactions as (
  select url, any_value(rule_verdict) as rule_verdict, list_sort(list(token)) as items from (
    select url, rule_verdict, token from each join frequent using (token)
    qualify row_number() over (partition by url order by telling desc, token) <= {url_rules.TOKENS_PER_URL}) group by url),
subsets as (
  select rule_verdict, [items[i] for i in range(1, len(items) + 1) if (mask >> (i - 1)) & 1 = 1] as needed
  from transactions, unnest(range(1, 1 << len(items))) as t(mask)),
counted as (
  select needed, count(*) as n, count(*) filter (rule_verdict = 'block') as block, count(*) filter (rule_verdict = 'allow') as allow from subsets group by needed),
mined as (
  select needed, n, verdict, hits from (unpivot counted on block, allow into name verdict value hits), totals
  where hits >= least and 100 * hits >= {url_rules.CONFIDENCE} * n),
guessed as (
  select url, verdict as guess, array_to_string(needed, ' ') as evidence from urls join mined on rule is null and list_has_all(tokens, needed)
  qualify row_number() over (partition by url order by cast(hits as double) / cast(n as double) desc, hits desc, verdict desc, evidence desc) = 1)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule, coalesce(rule_verdict, guess, 'allow') as verdict, evidence
from pages left join urls using (url) left join guessed using (url)
""",
)
def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


# crc32 of a decimal in SQL: a byte is put in by xor, each -1 takes one bit out.
_CRC32 = """xor(list_reduce(
    flatten([[4294967295]] || [[cast(ascii(ch) as bigint), -1, -1, -1, -1, -1, -1, -1, -1] for ch in string_split(cast(conv_id as varchar), '')]),
    lambda crc, t: case when t >= 0 then xor(crc, t) when crc % 2 = 1 then xor(crc // 2, 3988292384) else crc // 2 end), 4294967295)"""


@_query(
    "op13_prefix_trie",
    f"""
with told as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as place from told),
ids as (
  select conv_id, conv_id - conv_id % 5 as head_id, {_CRC32} % 9 as h from (select distinct conv_id from told)),
rebuilt as (
  select i.conv_id, place, role, text from ids i join own o on o.conv_id = i.head_id and place <= h
  union all select i.conv_id, place + least(h, coalesce(n, 0)) - h, role, text
  from ids i join own o on o.conv_id = i.conv_id and place > h left join (select conv_id, count(*) as n from own group by conv_id) c on c.conv_id = head_id),
chained as (
  select conv_id, place as depth, octet_length(encode(text)) as bytes,
    sha256(string_agg(sha256(length(role) || ':' || role || text), ',') over (partition by conv_id order by place rows unbounded preceding)) as node
  from rebuilt
  union all select conv_id, 0, 0, 'root' from ids),
lengths as (select conv_id, max(depth) as length from chained group by conv_id),
linked as (
  select c.*, l.length, lag(node) over (partition by c.conv_id order by depth) as parent from chained c join lengths l using (conv_id)),
nodes as (
  select node, any_value(depth) as depth, min(conv_id) as conv_id, any_value(parent) as parent, count(*) as n_convs,
    any_value(bytes) as bytes, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (depth = length), '')) as ends_sha256
  from linked group by node),
childless as (select node, node not in (select parent from nodes where parent is not null) as leaf from nodes),
below as (
  select up.node, count(*) filter (leaf) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens
  from nodes n join childless using (node) join linked up on up.conv_id = n.conv_id and up.depth <= n.depth group by up.node),
families as (select parent as node, count(*) as n_children from nodes where parent is not null group by parent)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
  cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
from nodes n join below using (node) left join families using (node) left join nodes p on p.node = n.parent
""",
)
def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(convs)).drop("digest")
