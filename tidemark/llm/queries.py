"""One query per operator over the whole given tables, with SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, line_dedup, merkle, near_dedup, packing, periodic_runs, perplexity, preference, quality_rules, substring_dedup, token_counts, top_k, word_bpe
from .common import LOWER, UPPER, ascii_lower

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


LINE_DEDUP_SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), repeated as (
  select key, min(doc_id) as first_doc from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), judged as (
  select k.doc_id, k.pos, k.line, (r.key is not null and k.doc_id > r.first_doc) as dropped
  from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from judged group by doc_id
"""


@query("op4_line_dedup", LINE_DEDUP_SQL)
def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SUBSTRING_DEDUP_SQL = """
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
), windows as (
  select doc_id, s, array_to_string(w[s : s + 12], ' ') as seq
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as s from words where len(w) >= 13)
), firsts as (
  select seq, min(doc_id) as first_doc from windows group by seq having min(doc_id) < max(doc_id)
), removed as (
  select distinct doc_id, p from (
    select w.doc_id, unnest(range(s, s + 13)) as p
    from windows w join firsts f on w.seq = f.seq where w.doc_id > f.first_doc)
), kept as (
  select a.doc_id, a.p, a.word, r.p is not null as gone
  from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from words) a
  left join removed r on a.doc_id = r.doc_id and a.p = r.p
), counted as (
  select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed,
         string_agg(word, ' ' order by p) filter (where not gone) as kept
  from kept group by doc_id
)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from documents d left join counted c on d.doc_id = c.doc_id
"""


@query("op2_substring_dedup", SUBSTRING_DEDUP_SQL)
def substring_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup.dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_packing")
def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), 2048, end_id=0)
    done = packing.pack(pieces, 2048)
    return done.select(F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


QUALITY_SQL = """
with base as (
  select doc_id, coalesce(text, '') as t, string_split(coalesce(text, ''), chr(10)) as lines,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), lines as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from base
), worded as (
  select *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') as w,
         row_number() over (partition by doc_id, line order by pos) as nth
  from lines where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), by_line as (
  select doc_id, count(*) filter (where nth > 1) as n_dup_lines,
         coalesce(sum(len(w)) filter (where
           len(regexp_extract_all(line, '[\\x20\\x09-\\x0D](\\||»|›|·|•|>|/)([\\x20\\x09-\\x0D]|$)')) + 1 >= 3
           or regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'PHRASES')
           or len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.25 * len(w)
           or (len(w) >= 8 and not regexp_matches(line, '[.!?…:;"''”’»)\\]。！？]([\\x20\\x09-\\x0D]|$)'))
         ), 0) as lost
  from worded group by doc_id
), windows as (
  select doc_id, s, array_to_string(w[s : s + 4], ' ') as seq
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as s from base where len(w) >= 5)
), twice as (
  select doc_id, s from (select *, count(*) over (partition by doc_id, seq) as n from windows) where n > 1
), repeats as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(s, s + 5)) as p from twice) group by doc_id
), counted as (
  select b.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(r.n, 0) as n_repeat_words, coalesce(lost, 0) as n_words_lost
  from base b left join by_line l on b.doc_id = l.doc_id left join repeats r on b.doc_id = r.doc_id
)
select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words_lost <= 0.3 * n_words as kept
from counted
""".replace("PHRASES", quality_rules.PATTERN.replace("'", "''"))


@query("op7_quality_rules", QUALITY_SQL)
def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    done = quality_rules.apply_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return done.drop("text", "kept_text")


@query("op6_word_bpe")
def word_bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    done = word_bpe.encode_texts(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_file("word_bpe_49k.json"))
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )


@query("op1_token_counts")
def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = token_counts.count_tokens(docs, tokenizer_file("byte_bpe_50k.json"))
    return done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@query("op9_top_k", TOP_K_SQL)
def top_k_query(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


PREFERENCE_SQL = """
with replies as (
  select conv_id, max(turn) as last_turn, max_by(text, turn) as own from conversations where role = 'assistant' group by conv_id
), pairs as (
  select a.conv_id, a.last_turn, a.own, b.own as other
  from replies a join replies b on b.conv_id = a.conv_id + 1 - 2 * (a.conv_id % 2)
), turns as (
  select c.conv_id as pair_id, c.turn, c.role, c.text as c_text,
         case when c.turn = p.last_turn then p.other else c.text end as r_text,
         row_number() over (partition by c.conv_id order by c.turn) as pos
  from conversations c join pairs p on c.conv_id = p.conv_id
  where c.turn < p.last_turn or (c.turn = p.last_turn and c.role = 'assistant')
), cut as (
  select pair_id, coalesce(min(pos) filter (where c_text <> r_text) - 1, count(*)) as n from turns group by pair_id
), placed as (
  select t.*, n, '<|' || role || '|>' || chr(10) as head from turns t join cut using (pair_id)
), measured as (
  select *,
    coalesce(sum(length(head) + length(c_text) + 1) over (partition by pair_id, pos > n order by pos rows between unbounded preceding and 1 preceding), 0) as c_at,
    coalesce(sum(length(head) + length(r_text) + 1) over (partition by pair_id, pos > n order by pos rows between unbounded preceding and 1 preceding), 0) as r_at
  from placed
)
select pair_id, any_value(n) as n_prompt_turns,
  coalesce(string_agg(head || c_text || chr(10), '' order by pos) filter (where pos <= n), '') as prompt,
  coalesce(string_agg(head || c_text || chr(10), '' order by pos) filter (where pos > n), '') as chosen,
  coalesce(string_agg(head || r_text || chr(10), '' order by pos) filter (where pos > n), '') as rejected,
  coalesce(string_agg((c_at + length(head))::bigint || '-' || (c_at + length(head) + length(c_text))::bigint, ',' order by pos) filter (where pos > n and role = 'assistant'), '') as chosen_mask,
  coalesce(string_agg((r_at + length(head))::bigint || '-' || (r_at + length(head) + length(r_text))::bigint, ',' order by pos) filter (where pos > n and role = 'assistant'), '') as rejected_mask,
  count(*) filter (where pos > n) = 0 as is_identical
from measured group by pair_id
"""


@query("op8_preference_format", PREFERENCE_SQL)
def preference_query(spark: SparkSession, folder: str) -> DataFrame:
    done = preference.format_preferences(preference.swapped_replies(table(spark, folder, "conversations")))

    def spelled(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")

    return done.select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        spelled("chosen_spans").alias("chosen_mask"),
        spelled("rejected_spans").alias("rejected_mask"),
        "is_identical",
    )


@query("op10_near_dedup")
def near_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, folder, "documents").select("doc_id", "text"))


@query("op5_quality_classifier")
def quality_classifier_query(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1 and toxic = 0")
    return perplexity.classify(table(spark, folder, "documents").select("doc_id", "text", "lang"), trusted)


DECONTAMINATION_SQL = f"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{decontamination.WORD}') as w from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{decontamination.WORD}') as w from benchmark
), windows as (
  select distinct item_id, m, array_to_string(w[s : s + m - 1], ' ') as seq
  from (select item_id, w, least(len(w), 10) as m, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from items where len(w) > 0)
), places as (
  select doc_id, m, s, array_to_string(w[s : s + m - 1], ' ') as seq
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as s from docs, (select distinct m from windows) where len(w) >= m)
), hits as (
  select doc_id, item_id, s, m from places join windows using (m, seq)
), words as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(s, s + m)) as p from hits) group by doc_id
), found as (
  select doc_id, count(distinct item_id) as n, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from hits group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(h.n, 0) as n_hit, coalesce(f.n, 0) as n_items,
       sha256(coalesce(f.ids, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from docs d left join words h on d.doc_id = h.doc_id left join found f on d.doc_id = f.doc_id
"""


@query("op11_decontamination", DECONTAMINATION_SQL)
def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = decontamination.decontaminate(docs, table(spark, folder, "benchmark"))
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where one document in ten has its words from a place on repeated in turn."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("w").cast("long")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    word = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.alias("g")).select(
        "doc_id", F.when(n > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text")
    )


@query("op12_periodic_runs")
def periodic_runs_query(spark: SparkSession, folder: str) -> DataFrame:
    done = periodic_runs.find_runs(with_planted_runs(table(spark, folder, "documents")))
    spelled = F.array_join(F.transform("runs", lambda r: F.concat(F.array_join(r.cast("array<string>"), ","), F.lit("\n"))), "")
    best = F.array_sort(
        "runs",
        lambda x, y: F.when(x[1] != y[1], F.signum(y[1] - x[1])).when(x[0] != y[0], F.signum(x[0] - y[0])).otherwise(F.signum(x[2] - y[2])).cast("int"),
    )
    return done.withColumn("best", F.get(best, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best")[0].alias("start"),
        F.col("best")[1].alias("length"),
        F.col("best")[2].alias("period"),
        F.floor(1000 * F.col("best")[1] / F.col("best")[2]).alias("exponent_milli"),
        F.sha2(spelled, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


#: The unsigned CRC-32 of ``doc_id`` in decimals, bit by bit.
CRC32_SQL = """xor(list_reduce([4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
      lambda a, b: list_reduce([xor(a, b)] || range(8), lambda d, i: if(d % 2 = 1, xor(d >> 1, 3988292384), d >> 1))), 4294967295)"""


def _levels_sql(name: str, levels: int) -> str:
    """From ``<name>0`` up: a row's node, its version and its proof, level by level, while several nodes are left."""
    return ", ".join(
        f"""{name}{k}_w as (
  select grp, pos, count(*) over (partition by grp) = 1 as alone,
         coalesce(string_agg(digest, '') over (partition by grp, pos // 8 order by pos rows between unbounded preceding and 1 preceding), '') as lft,
         coalesce(string_agg(digest, '') over (partition by grp, pos // 8 order by pos rows between 1 following and unbounded following), '') as rgt
  from (select distinct grp, pos, digest from {name}{k - 1})
), {name}{k} as (
  select d.* replace (if(alone, digest, sha256(lft || digest || rgt)) as digest, if(alone, folded, sha256(lft || folded || rgt)) as folded,
                      proof || lft || rgt as proof, if(alone, pos, pos // 8) as pos)
  from {name}{k - 1} d join {name}{k}_w w using (grp, pos)
)"""
        for k in range(1, levels + 1)
    )


def _manifest_sql(levels: int) -> str:
    """SQL for groups of up to ``8 ** levels`` rows."""

    def leaf(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({f}::varchar) || ':' || {f}, '-')" for f in fields) + ")"

    return f"""
with leaves as (
  select doc_id, coalesce('=' || lang, '-') as tree, {leaf("text")} as leaf,
         if(coalesce({CRC32_SQL} % 3 = 0, false), {leaf(f"translate(text, '{UPPER}', '{LOWER}')")}, {leaf("text")}) as folded
  from documents
), s0 as (
  select *, tree as grp, leaf as digest, '' as proof, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos
  from leaves
), {_levels_sql("s", levels)}, t0 as (
  select * replace ('' as grp, dense_rank() over (order by tree) - 1 as pos), digest as subroot from s{levels}
), {_levels_sql("t", 3)}
select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = digest as verified from t3
"""


@query("op13_merkle_manifest", _manifest_sql(6))
def merkle_query(spark: SparkSession, folder: str) -> DataFrame:
    done = merkle.manifest(
        table(spark, folder, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        changes={"text": ascii_lower(F.col("text"))},
        where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
    )
    return done.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("path", ""), 256).alias("proof_sha256"),
        F.col("version_root").alias("folded_root"),
        (F.col("version_root") == F.col("root")).alias("verified"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline_query(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
