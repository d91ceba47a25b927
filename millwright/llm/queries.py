"""Registered queries of the numbered operators and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import alignment, bpe, credentials, decontaminate, merkle, packing, quality, sharding, simhash, suffix, topk, toxicity, warc
from millwright.llm.common import table

VOCABULARY, BYTE_LEVEL, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed package of public tokenizers keeps a vocabulary, by default that of op10."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint")
    rows = table(spark, sf_dir, "documents").select("doc_id", sharding.hashed(F.col("doc_id")).alias("hash"), size.alias("bytes"))
    return sharding.assign(rows).drop("hash").withColumnRenamed("bytes", "row_bytes")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{credentials.BASE[k]}")
    return found.select(
        "doc_id",
        *(count(k) for k in range(len(credentials.BASE))),
        F.sha2(credentials.spelled(F.col("base")), 256).alias("base_sha256"),
        credentials.spelled(F.col("spans")).alias("spans"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents"), with_kept=False).drop("kept")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_LEVEL))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_topk": op2_topk,
    "op3_credentials": op3_credentials,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_suffix": op7_suffix,
    "op8_quality": op8_quality,
    "op9_winnowing": op9_winnowing,
    "op10_bpe": op10_bpe,
    "op11_packing": op11_packing,
    "op12_alignment": op12_alignment,
    "op13_merkle": op13_merkle,
}

OP4_SQL = """
with page as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), first as (
    select *, min(page_id) over (partition by payload_digest) as least from page
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id is distinct from least then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id is distinct from least then least end as refers_to
from first
"""

OP9_SQL = r"""
with doc as (
    select row_number() over () as rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), item as (
    select coalesce(cast(item_id as varchar), '') as item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), win as (
    select distinct item, least(10, len(w)) as size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
    from (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from item where len(w) > 0)
), sizes as (select distinct size from win),
starts as (
    select rid, size, w, unnest(range(1, len(w) - size + 2)) as i
    from doc, sizes where len(w) >= size
), hit as (
    select s.rid, s.size, s.i, win.item
    from (select rid, size, i, array_to_string(w[i : i + size - 1], ' ') as win from starts) s join win using (size, win)
), words as (
    select rid, count(distinct p) as n_hit
    from (select rid, unnest(range(i, i + size)) as p from (select distinct rid, i, size from hit)) group by rid
), names as (
    select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct rid, item from hit) group by rid
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (rid) left join names using (rid)
"""

OP2_SQL = """
with vec as (
    select vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::double)::bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    group by vec_id
), pair as (
    select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda t: t[1] * t[2]))::bigint as score
    from vec q join vec c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from pair qualify rank <= 10
"""

OP3_SQL = r"""
with doc as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
cut as (
    {cuts}
), each as (
    select rid, k, g, h, unnest(range(1, len(h) + 1)) as i from cut
), place as (
    select rid, k, h[i] as m,
           cast(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) as bigint) as s
    from each
), span as (
    select rid, k, s, s + length(m) as e from place
    where case k when 0 then length(regexp_extract(m, '{assign}', 2)) >= 6
                 when 1 then length(m) >= 20 when 2 then length(m) >= 24
                 when 5 then regexp_matches(m, '[0-9]') and regexp_matches(m, '[a-z]') and regexp_matches(m, '[A-Z]')
                 else true end
), link as (
    select distinct w.rid, w.k, w.s, w.e from span w join span o using (rid)
    where ((w.k in (3, 4) and o.k in (0, 1, 2)) or (w.k = 5 and o.k in (1, 3, 4)))
      and o.s <= w.e + 200 and o.e >= w.s - 200
      and not (o.s >= w.s and o.e <= w.e) and not (o.s <= w.s and o.e >= w.e)
), total as (select * from span where k < 3 union all select * from link),
kind as (select unnest(['assign', 'access', 'hex', 'name', 'endpoint', 'bare']) as name, unnest(range(0, 6)) as k),
sums as (
    select rid, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
           string_agg(name || ':' || s || ':' || e, ',' order by s, k) filter (k < 3) as base,
           string_agg(name || ':' || s || ':' || e, ',' order by s, k) as spans
    from total join kind using (k) group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from doc left join sums using (rid)
"""


def _op3_sql() -> str:
    quoted = {k: p.replace("'", "''") for k, p in (credentials.PATTERNS | {"access": credentials.ACCESS, "hex": credentials.HEX}).items()}
    cuts = "\n    union all\n    ".join(
        f"select rid, {i} as k, string_split_regex(t, '{quoted[k]}') as g, regexp_extract_all(t, '{quoted[k]}') as h "
        f"from doc where regexp_matches(t, '{quoted[k]}')"
        for i, k in enumerate(credentials.KINDS)
    )
    return OP3_SQL.replace("{cuts}", cuts).replace("{assign}", quoted["assign"])


OP1_SQL = """
with doc as (
    select doc_id, octet_length(encode(coalesce(text, ''))) as row_bytes,
           ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as h
    from documents
), sums as (
    select d, h >> (60 - d) as p, sum(row_bytes) as shard_bytes, count(*) as shard_rows
    from doc, range(0, 61) t(d) group by all
), shard as (
    select d, p, shard_bytes, shard_rows from sums
    where shard_bytes <= {limit} and (d = 0 or exists (select 1 from sums u where u.d = sums.d - 1 and u.p = sums.p >> 1 and u.shard_bytes > {limit}))
)
select doc_id, row_bytes, shard_bytes, shard_rows, case when d = 0 then '' else lpad(bin(p), d::integer, '0') end as shard
from doc join shard on (h >> (60 - d)) = p
"""

OP13_SQL = r"""
with recursive doc as (
    select row_number() over () as rid, doc_id, source, text,
           concat(case when doc_id is null then '-' else octet_length(encode(doc_id::varchar)) || ':' || doc_id end,
                  case when source is null then '-' else octet_length(encode(source)) || ':' || source end,
                  case when lang is null then '-' else octet_length(encode(lang)) || ':' || lang end,
                  case when n_chars is null then '-' else octet_length(encode(n_chars::varchar)) || ':' || n_chars end) as head,
           list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
               lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]::bigint[]),
                   lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)) as crc
    from documents
), field as (
    select *, case when text is null then '-' else octet_length(encode(text)) || ':' || text end as whole,
           case when text is null then '-' else octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), '') end as cut
    from doc
), leaf as (
    select rid, doc_id, source, sha256(head || whole) as leaf,
           case when xor(crc, 4294967295::bigint) % 2 = 0 then sha256(head || cut) else sha256(head || whole) end as tampered
    from field
), node as (
    select 0 as lvl, source, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
           count(*) over (partition by source) as n, leaf as d, rid
    from leaf
    union all
    select lvl + 1, source, i // 3, (n + 2) // 3, sha256(string_agg(d, '' order by i)), null
    from (select * from node where n > 1) group by lvl, source, i // 3, n
), subroot as (
    select source, d, max(lvl) over () + 1 as base, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n
    from node where n = 1
), upper as (
    select base as lvl, i, n, d from subroot
    union all
    select lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(d, '' order by i))
    from (select * from upper where n > 1) group by lvl, i // 3, n
), root as (select d from upper where n = 1
), way as (
    select a.rid, s.lvl, s.i, s.d, a.i // power(3, s.lvl)::bigint as own
    from (select * from node where lvl = 0) a
    join node s on s.source is not distinct from a.source and s.n > 1 and s.i // 3 = a.i // power(3, s.lvl + 1)::bigint
    union all
    select a.rid, s.lvl, s.i, s.d, b.i // power(3, s.lvl - b.base)::bigint
    from (select * from node where lvl = 0) a
    join subroot b on b.source is not distinct from a.source
    join upper s on s.n > 1 and s.i // 3 = b.i // power(3, s.lvl - b.base + 1)::bigint
), step as (
    select rid, lvl, coalesce(string_agg(d, '' order by i) filter (i < own), '') as before, coalesce(string_agg(d, '' order by i) filter (i > own), '') as after
    from way group by rid, lvl
), path as (
    select rid, string_agg(before || after, '' order by lvl) as proof, list({'before': before, 'after': after} order by lvl) as steps
    from step group by rid
), fold as (
    select rid, 1 as k, tampered as d from leaf
    union all
    select rid, k + 1, sha256(steps[k].before || d || steps[k].after) from fold join path using (rid) where k <= len(steps)
), last as (select rid, arg_max(d, k) as folded_root from fold group by rid)
select doc_id, leaf, s.d as subroot, root.d as root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = root.d as verified
from leaf join subroot s on s.source is not distinct from leaf.source cross join root left join path using (rid) join last using (rid)
"""

SQL: dict[str, str] = {"op1_sharding": OP1_SQL.format(limit=sharding.LIMIT), "op2_topk": OP2_SQL, "op3_credentials": _op3_sql(), "op4_warc": OP4_SQL, "op9_winnowing": OP9_SQL, "op13_merkle": OP13_SQL}
