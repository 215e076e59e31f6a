"""One registered query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import quality_classifier
from lakeops.llm.common import documents, id_bucket, table
from lakeops.llm.decontaminate import decontaminate
from lakeops.llm.language import identify
from lakeops.llm.lexical_search import search
from lakeops.llm.line_dedup import dedup_lines
from lakeops.llm.merkle import manifest
from lakeops.llm.packing import pack_documents
from lakeops.llm.quality_rules import apply_rules
from lakeops.llm.sharding import shard
from lakeops.llm.simhash import near_duplicates
from lakeops.llm.substring_dedup import remove_repeated_windows
from lakeops.llm.suffix_dedup import remove_repeats
from lakeops.llm.url_filters import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


#: host, path prefix, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark, table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op9_url_filters"] = """
with parts as (
  select page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
rules(rule, rule_host, rule_path, verdict) as (values
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
fits as (
  select p.page_id, p.host, p.path, r.rule, r.verdict,
         row_number() over (partition by p.page_id order by length(r.rule) desc nulls last) as place
  from parts p left join rules r
    on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where place = 1
"""


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLES["op8_decontamination"] = r"""
with doc_words as (
  select doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select item_id, w, least(len(w), 10) as n,
               unnest(range(1, (len(w) - least(len(w), 10) + 2)::bigint)) as i from item_words where len(w) > 0)),
doc_windows as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, (len(w) - n + 2)::bigint)) as i
        from doc_words, (select distinct n from item_windows) where len(w) >= n)),
hits as (select doc_id, item_id, i, n from doc_windows join item_windows using (n, win)),
hit_words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hits) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, radius=2)


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    return identify(documents(spark, sf_dir), held_out).select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), id_bucket(F.col("doc_id"), 5) == 0
    weights = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return (quality_classifier.score(docs, weights)
            .select("doc_id", held_out.alias("held_out"), "score", "predicted"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(documents(spark, sf_dir), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), with_text=False)


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLES["op11_lexical_search"] = r"""
with doc_terms as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents where text is not null),
sizes as (select doc_id, len(w)::bigint as n from doc_terms where len(w) > 0),
totals as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from sizes),
counts as (select doc_id, term, count(*)::bigint as tf from (select doc_id, unnest(w) as term from doc_terms) group by 1, 2),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
  from counts, totals group by term, n_docs),
asked as (
  select item_id, term, count(*)::bigint as times
  from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark where text is not null) group by 1, 2),
scored as (
  select item_id, doc_id,
         sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::bigint as score
  from asked join weights using (term) join counts using (term) join sizes using (doc_id), totals group by 1, 2),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
           from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op12_substring_dedup"] = r"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, sha256(array_to_string(w[i:i + 19], ' ')) as win
  from (select doc_id, w, unnest(range(1, (len(w) - 18)::bigint)) as i from words where len(w) >= 20)),
placed as (select doc_id, i, row_number() over (partition by win order by doc_id, i) as place from windows),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 20)) as p from placed where place > 1)),
spread as (select doc_id, unnest(w) as word, unnest(range(1, (len(w) + 1)::bigint)) as p from words),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as rest, count(*) as n
  from spread anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from words left join kept using (doc_id)
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


def _merkle_sql(source_levels: int, top_levels: int) -> str:
    """The trees level by level: as many as 16 ** levels documents of a source, and sources, need."""
    def field(name: str, value: str | None = None) -> str:
        shown = f"({value or name})::varchar"
        return f"case when {name} is null then '-' else octet_length(encode({shown}))::varchar || ':' || {shown} end"

    def leaf(text: str | None = None) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars"))) + f" || {field('text', text)})"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # crc32 of the digits: -1 stands for one step of the division, other entries are added first
    steps = "flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint] || list_value(-1,-1,-1,-1,-1,-1,-1,-1)))"
    crc = (f"xor(list_reduce([4294967295::bigint] || {steps}, lambda a, x: case when x >= 0 then xor(a, x) "
           "when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295)")
    parts = [
        f"base as (select doc_id, source, {leaf()} as leaf, {leaf(lowered)} as lowered, {crc} as crc from documents)",
        "rows as (select *, case when crc % 5 = 0 then lowered else leaf end as cand, "
        "row_number() over (partition by source order by doc_id, leaf) - 1 as i0, row_number() over () as row_id from base)",
        "s0 as (select source, i0 as i, leaf as d, count(*) over (partition by source) as n from rows)"]

    def tower(name: str, keys: str, levels: int) -> None:
        on = " and ".join(f"p.{k} is not distinct from r.{k}" for k in keys.split(", "))
        for k in range(levels):
            parts.append(f"{name}{k + 1} as (select {keys}, i // 16 as i, case when n > 1 then sha256(string_agg(d, '' order by i)) "
                         f"else any_value(d) end as d, (n + 15) // 16 as n from {name}{k} group by {keys}, n, i // 16)")
            parts.append(f"{name}r{k} as (select {keys}, i // 16 as b, list(d order by i) as run from {name}{k} where n > 1 "
                         f"group by {keys}, i // 16)")
            left, right = "array_to_string(run[1:pos % 16], '')", "array_to_string(run[pos % 16 + 2:], '')"
            start = {"s": "(select *, i0 as pos, '' as sib, cand as cur from rows)",
                     "t": "(select p0.* exclude (pos), top.i as pos, one from {last} p0 join t0 top on p0.source is not distinct from top.source)"}
            before = start[name].format(last=f"sp{source_levels - 1}") if k == 0 else f"{name}p{k - 1}"
            parts.append(f"{name}p{k} as (select p.* exclude (pos, sib, cur), pos // 16 as pos, "
                         f"case when run is null then sib else sib || {left} || {right} end as sib, "
                         f"case when run is null then cur else sha256({left} || cur || {right}) end as cur "
                         f"from {before} p left join {name}r{k} r on {on} and p.pos // 16 = r.b)")

    tower("s", "source", source_levels)
    parts.append(f"t0 as (select 1 as one, source, d, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n from s{source_levels})")
    tower("t", "one", top_levels)
    return (f"with {', '.join(parts)} select p.doc_id, p.leaf, s.d as subroot, t.d as root, sha256(p.sib) as proof_sha256, "
            f"p.cur as folded_root, p.cur = t.d as verified from tp{top_levels - 1} p "
            f"join s{source_levels} s on p.source is not distinct from s.source, t{top_levels} t")


ORACLES["op13_merkle_manifest"] = _merkle_sql(5, 3)
