"""Registered queries of this subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import bucket_of, picked

#: Vocabulary files of public tokenizers; read on the driver, never copied here.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_PAIR_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_hmm_score")
def op1(spark, sf):
    from . import hmm

    docs = picked(table(spark, sf, "documents"), "doc_id", "text")
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 7) == 2, F.lit(False))
    return hmm.score(docs, ~held_out).select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def held_out_in(docs: DataFrame) -> Column:
    return F.coalesce(bucket_of(F.col("doc_id"), 5) == 0, F.lit(False))


@query("op3_toxicity")
def op3(spark, sf):
    from . import toxicity

    docs, labels = picked(table(spark, sf, "documents"), "doc_id", "text"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels.where(~held_out_in(labels)), "toxic")
    return toxicity.score(docs, model).select(
        "doc_id", held_out_in(docs).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


@query("op8_compression_quality")
def op8(spark, sf):
    from . import compression

    docs, labels = picked(table(spark, sf, "documents"), "doc_id", "text"), table(spark, sf, "labels")
    model = compression.train(docs, labels.where(~held_out_in(labels)), "quality")
    return compression.score(docs, model).select(
        "doc_id", held_out_in(docs).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def _sql_words(text: str) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{letters}', '{letters.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op6_decontamination",
    f"""
with d as (select row_number() over () as rid, doc_id, {_sql_words('text')} as w from documents),
b as (select cast(item_id as varchar) as item, {_sql_words('text')} as w from benchmark),
win as (select distinct item, array_to_string(w[i:i + 12], ' ') as s, least(len(w), 13) as n
  from (select item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) as i from b where len(w) > 0)),
pos as (select rid, n, i, array_to_string(w[i:i + n - 1], ' ') as s
  from (select rid, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, (select distinct n from win) where len(w) >= n)),
hit as (select rid, i, pos.n, item from pos join win on pos.s = win.s and pos.n = win.n),
cov as (select rid, count(distinct p) as n_hit from (select rid, unnest(generate_series(i, i + n - 1)) as p from hit) group by rid),
its as (select rid, list_sort(list(distinct item)) as items from hit group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, cast(coalesce(len(items), 0) as bigint) as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join cov using (rid) left join its using (rid)""",
)
def op6(spark, sf):
    from .decontaminate import contamination

    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op2_probminhash_classes")
def op2(spark, sf):
    from .probminhash import classes

    return classes(table(spark, sf, "documents"))


@query("op4_merge_dropout")
def op4(spark, sf):
    from . import pieces

    docs = picked(table(spark, sf, "documents"), "doc_id", "text")
    return pieces.add_ids(docs, pieces.load(PIECE_MODEL)).select("doc_id", F.size("ids").alias("n_ids"), "ids", "lossless")


@query("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


@query("op7_main_text")
def op7(spark, sf):
    from . import webpages

    pages = picked(table(spark, sf, "pages"), "page_id", "url", "html")
    return webpages.main_text(pages, webpages.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


@query(
    "op10_impact_topk",
    """
with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.rid as qid, q.vec_id as query_id, c.vec_id, c.rid,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q, v c where q.vec_id % 100 = 0 and q.rid <> c.rid),
r as (select *, row_number() over (partition by qid order by score desc, vec_id, rid) as n from s)
select query_id, cast(n as int) as rank, vec_id, score from r where n <= 10""",
)
def op10(spark, sf):
    from .topk import search

    vectors = picked(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 100 == 0)


@query("op9_training_order")
def op9(spark, sf):
    from . import shards

    docs = picked(table(spark, sf, "documents"), "doc_id", "text")
    ranks = shards.read_ranks(BYTE_PAIR_RANKS)
    path = shards.shard_path(spark)
    sequences, files, _ = shards.materialise(docs, ranks, len(ranks), path)
    on_disk = shards.read_back(files, path).select("slot", "in_place", F.col("number").alias("on_disk"), "crc32")
    # one row per sequence on both sides; the small index that ``on_disk`` is read by says nothing of its size
    return sequences.join(on_disk.hint("merge"), "slot").select(
        "slot", F.col("number").alias("sequence"), "shard", "record", "n_tokens", F.col("keys").alias("doc_ids"),
        (F.col("in_place") & (F.col("on_disk") == F.col("number"))).alias("in_place"), "crc32",
    )


@query("op5_role_repair")
def op5(spark, sf):
    from .chat import format_chats

    return format_chats(table(spark, sf, "conversations"))


# crc32 of a text's bytes, bit by bit
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, [('0x' || x)::bigint for x in regexp_extract_all(hex(encode({text})), '..')]),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, _: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)),
  4294967295)"""


@query(
    "op13_spelling_variants",
    f"""
with recursive runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as run from documents),
once as (select run, {_SQL_CRC.format(text="coalesce(cast(doc_id as varchar), '') || ':' || run")} as h, n
  from (select doc_id, run, count(*) as n from runs where length(run) >= 7 group by all)),
w as (select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, sum(n) as n
  from once group by 1 having length(word) >= 7 and sum(n) >= 2),
less as (select word, n, -1 as i, word as part from w union all
  select word, n, i, left(word, i) || substr(word, i + 2) from (select word, n, unnest(generate_series(0, length(word) - 1)) as i from w)),
pairs as (select distinct a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.part = b.part
  where a.word <> b.word and (a.i = b.i or a.i = -1 or b.i = -1)),
best as (select word, count(*) as n_near, min(struct_pack(less := -other_n, other := other)) as best from pairs group by word),
t as (select w.word, cast(w.n as bigint) as n, coalesce(n_near, 0) as n_near,
    case when -best.less >= 10 * w.n then best.other end as form, case when -best.less >= 10 * w.n then cast(-best.less as bigint) end as form_n
  from w left join best using (word)),
chain as (select word, word as root, form as onward from t union all
  select chain.word, t.word, t.form from chain join t on chain.onward = t.word)
select t.word, form, root, n, n_near, form_n from t join chain on t.word = chain.word where onward is null""",
)
def op13(spark, sf):
    from .spelling import variants

    return variants(table(spark, sf, "documents"))


def _sql_leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text)]
    return f"sha256({' || '.join(parts)})"


def _sql_next(digests: str) -> str:
    return f"[sha256(array_to_string({digests}[3 * i + 1 : 3 * i + 3], '')) for i in generate_series(0, (len({digests}) - 1) // 3)]"


def _sql_steps(levels: str, place: str) -> str:
    """What stands before and after a node in its run, parted by a bar."""
    at = f"({place} // cast(pow(3, lvl) as bigint))"
    return f"array_to_string(d[{at} // 3 * 3 + 1 : {at}], '') || '|' || array_to_string(d[{at} + 2 : {at} // 3 * 3 + 3], '') as step"


@query(
    "op12_merkle_manifest",
    f"""
with recursive parity as (select *, {_SQL_CRC.format(text="cast(doc_id as varchar)")} % 2 = 0 as odd from documents),
leaves as (select doc_id, coalesce('s' || source, 'n') as tree, {_sql_leaf('text')} as leaf,
  {_sql_leaf("case when odd then replace(text, chr(10), '') else text end")} as altered from parity),
places as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, row_number() over () as rid from leaves),
low as (select tree, 0 as lvl, list(leaf order by place) as d from places group by tree
  union all select tree, lvl + 1, {_sql_next('d')} from low where len(d) > 1),
subs as (select tree, d[1] as subroot, row_number() over (order by tree) - 1 as rank from low where len(d) = 1),
high as (select 0 as lvl, list(subroot order by rank) as d from subs
  union all select lvl + 1, {_sql_next('d')} from high where len(d) > 1),
steps as (select rid, lvl, {_sql_steps('low', 'place')} from places join low using (tree) where len(d) > 1
  union all select rid, 1000 + lvl, {_sql_steps('high', 'rank')} from places join subs using (tree), high where len(d) > 1),
paths as (select rid, list(step order by lvl) as path from steps group by rid),
done as (select doc_id, leaf, subroot, (select d[1] from high where len(d) = 1) as root,
  sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) as proof_sha256,
  list_reduce(list_prepend(altered, coalesce(path, [])), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) as folded_root
  from places join subs using (tree) left join paths using (rid))
select *, folded_root = root as verified from done""",
)
def op12(spark, sf):
    from . import merkle

    columns = ("doc_id", "source", "lang", "n_chars", "text")
    text = F.col("text")
    cut = (bucket_of(F.col("doc_id"), 2) == 0) & text.contains("\n")
    altered = F.when(cut, merkle.leaf_of(*[F.col(c) for c in columns[:-1]], F.replace(text, F.lit("\n"), F.lit(""))))
    rows = merkle.manifest(table(spark, sf, "documents"), columns, altered=altered)
    rows = rows.withColumn("folded_root", merkle.fold(F.coalesce("altered", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op11_cross_parsing")
def op11(spark, sf):
    from . import langid

    docs = picked(table(spark, sf, "documents"), "doc_id", "text", "lang")
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.train(docs, ~held_out)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
