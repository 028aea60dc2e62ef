"""Registered queries of the operators, and their expected results as DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provwatch.llm import (
    bottom_k_dedup,
    conversation_trie,
    cross_tokenizer_alignment,
    language_ppm,
    lattice_lm,
    multi_index_hashing,
    sentencepiece_viterbi,
    string_tiling,
    substring_anchors,
    token_count_cache,
    toxicity_neighbours,
    warc_archives,
    wrapper_induction,
)
from provwatch.llm.holding_out import held_out
from provwatch.llm.tokenizers_public import TokenizerFile, public_path
from provwatch.sources.sinks import work_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return multi_index_hashing.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_bottom_k_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k_dedup.near_duplicates(_table(spark, folder, "documents"), shingle=4, percent=80)


def _piece_model() -> TokenizerFile:
    return TokenizerFile.read(public_path("piece_bpe_32k.model"))


def op3_sentencepiece_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    encoded = sentencepiece_viterbi.encode_texts(_table(spark, folder, "documents").select("doc_id", "text"), _piece_model())
    return encoded.select(
        "doc_id",
        "n_ids",
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.coalesce("text", F.lit("")).eqNullSafe(F.coalesce("decoded", F.lit(""))).alias("round_trip"),
    )


def op4_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = string_tiling.contamination(docs, _table(spark, folder, "benchmark"))
    return found.select("doc_id", "contaminated", F.size("items").alias("n_items"), "items")


def op5_toxicity_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(~held_out(F.col("doc_id"), 3, 1))
    model = toxicity_neighbours.fit(docs, labels)
    scored = toxicity_neighbours.score_texts(docs, model, threshold=0.7)
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted", "evidence")


def op6_language_ppm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id"), 4, 2))
    trees = language_ppm.train(docs.where("not held_out"))
    return language_ppm.predict(docs.drop("lang"), trees).drop("text")


def op7_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id"), 7, 2)).withColumn("taught", ~F.col("held_out"))
    return lattice_lm.score_texts(docs, _piece_model(), classes="lang").drop("lang")


def op8_token_count_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Over a cache of its own for the run, so that the whole table is counted."""
    docs = _table(spark, folder, "documents")
    return token_count_cache.token_counts(docs, _piece_model(), work_folder(spark, "token-count-cache"), limit=4096)


def op9_wrapper_induction(spark: SparkSession, folder: str) -> DataFrame:
    found = wrapper_induction.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_anchors.remove_repeats(_table(spark, folder, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op11_lockstep_alignment(spark: SparkSession, folder: str) -> DataFrame:
    bytes_ = TokenizerFile.read(public_path("byte_bpe_50k.json"))
    return cross_tokenizer_alignment.alignment_report(_table(spark, folder, "documents"), bytes_, _piece_model())


def op12_warc_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the archives of all pages, then reads every record back."""
    archives = work_folder(spark, "warc")
    warc_archives.write_archives(_table(spark, folder, "pages"), archives, least=100)
    found = warc_archives.read_archives(spark, archives)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_euler_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.shared_head_trie(_table(spark, folder, "conversations"))


# Words of the word pattern: runs of bytes other than the six ASCII blanks.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_OP2_SQL = rf"""
with recursive d as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws from documents),
starts as (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) as i from d where len(ws) > 0),
sh as (select distinct doc_id, hash(array_to_string(ws[i:i + 3], ' ')) as s from starts),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
    select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
edge as (select a, b from links union all select b, a from links),
reach as (
    select doc_id as v, doc_id as component from d
    union
    select edge.b, reach.component from reach join edge on edge.a = reach.v where reach.component < edge.b),
named as (select v, min(component) as component_id from reach group by v)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from d left join n using (doc_id) join named on named.v = d.doc_id
"""

_OP10_SQL = f"""
with d as (select doc_id, {_WORDS} as ws from documents),
starts as (select doc_id, ws, unnest(generate_series(1, len(ws) - 34)) as i from d where len(ws) >= 35),
windows as (select doc_id, i, array_to_string(ws[i:i + 34], ' ') as w from starts),
repeated as (select w from windows group by w having count(*) > 1),
covered as (
    select distinct doc_id, i + k as pos
    from windows join repeated using (w), generate_series(0, 34) as g(k)),
placed as (select doc_id, unnest(ws) as word, unnest(generate_series(1, len(ws))) as pos from d),
kept as (
    select doc_id, string_agg(word, ' ' order by pos) as kept, count(*) as n
    from placed anti join covered using (doc_id, pos) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)
"""

_OP12_SQL = """
with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as digest from pages),
f as (select digest, min(page_id) as first_id from p where n >= 100 group by digest)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
       case when n >= 100 and page_id is distinct from first_id and first_id is not null then 'revisit' else 'response' end
           as record_type,
       case when n >= 100 and page_id is distinct from first_id then first_id end as refers_to
from p left join f using (digest)
"""

# crc32 of the decimal id, byte by byte and bit by bit; turns of equal number follow their digests.
_OP13_SQL = """
with turns as (
    select conv_id as c, turn, length(coalesce(text, '')) as chars,
           md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as m
    from conversations where conv_id is not null),
placed as (
    select c, m, chars, row_number() over (partition by c order by turn nulls first, substr(m, 1, 30)) - 1 as i,
           count(*) over (partition by c) as n
    from turns),
ids as (
    select c, n, c - c % 100 as base,
           (xor(list_reduce(list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::hugeint),
                lambda a, b: list_reduce(list_transform(range(8), lambda x: x::hugeint),
                    lambda x, i: xor(x >> 1, case when x % 2 = 1 then 3988292384 else 0 end), xor(a, b)),
                4294967295::hugeint), 4294967295::hugeint) % 6)::bigint as h
    from placed where i = 0),
sized as (
    select ids.*, least(h, coalesce(source.n, 0)) as taken
    from ids left join (select c as base, n from ids) source using (base)),
rebuilt as (
    select s.c, i as pos, m, chars from sized s join placed p on p.c = s.base and i < taken
    union all
    select s.c, taken + i - h, m, chars from sized s join placed p on p.c = s.c and i >= h),
prefixes as (
    select c, pos + 1 as depth, chars, sha256(string_agg(m, '') over w) as k from rebuilt
    window w as (partition by c order by pos rows between unbounded preceding and current row)),
members as (
    select c, depth, chars, k, coalesce(lag(k) over (partition by c order by depth), '') as parent from prefixes
    union all
    select c, 0, 0, '', null from ids),
nodes as (
    select depth, k, any_value(parent) as parent, min(c) as conv_id, count(*) as n_convs, any_value(chars) as chars
    from members group by depth, k),
children as (select depth - 1 as depth, parent as k, count(*) as n from nodes where depth > 0 group by 1, 2),
counted as (
    select nodes.*, coalesce(n, 0) as n_children from nodes left join children using (depth, k)),
sums as (
    select m.depth, m.k, sum((u.n_children = 0)::int) as n_leaves, sum((u.n_convs - 1) * u.chars) as saved
    from counted u join members m on m.c = u.conv_id and m.depth <= u.depth group by 1, 2),
ends as (
    select depth, k, string_agg(c::varchar, ',' order by c) as cs from members
    where (c, depth) in (select c, max(depth) from members group by c) group by 1, 2)
select v.conv_id::bigint as conv_id, v.depth::bigint as depth, p.conv_id::bigint as parent_conv_id,
       v.n_convs::bigint as n_convs, v.n_children::bigint as n_children, n_leaves::bigint as n_leaves,
       saved::bigint as saved_tokens, sha256(coalesce(cs, '')) as ends_sha256
from counted v join sums using (depth, k) left join ends using (depth, k)
left join nodes p on p.depth = v.depth - 1 and p.k = v.parent
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_multi_index_hashing": op1_multi_index_hashing,
        "op2_bottom_k_dedup": op2_bottom_k_dedup,
        "op3_sentencepiece_viterbi": op3_sentencepiece_viterbi,
        "op4_string_tiling": op4_string_tiling,
        "op5_toxicity_neighbours": op5_toxicity_neighbours,
        "op6_language_ppm": op6_language_ppm,
        "op7_lattice_lm": op7_lattice_lm,
        "op8_token_count_cache": op8_token_count_cache,
        "op9_wrapper_induction": op9_wrapper_induction,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_lockstep_alignment": op11_lockstep_alignment,
        "op12_warc_dictionary": op12_warc_dictionary,
        "op13_euler_trie": op13_euler_trie,
    }


def llm_sql() -> dict[str, str]:
    return {
        "op2_bottom_k_dedup": _OP2_SQL,
        "op10_substring_dedup": _OP10_SQL,
        "op12_warc_dictionary": _OP12_SQL,
        "op13_euler_trie": _OP13_SQL,
    }
